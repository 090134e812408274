"""Fit rows to the master table's contract and set aside those that do not fit.

Columns are best fitted in the sources, before the joins repeat them: an order's times
are then read once, not once per item and payment, and typed values are shuffled
instead of texts. Fitting a joined frame gives the same rows.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, StructField, StructType, VarcharType

from cartloom.functions.amounts import fit_amount
from cartloom.functions.dates import loose_timestamp
from cartloom.functions.missing import column_or
from cartloom.operators.skew import SkewProfile, left_join, spread
from cartloom.schemas import MASTER

REASON = "reject_reason"
SOURCE_ROW = "source_row"
_MISFIT = "_misfit"  # suffix: rank and reason of the first column that does not fit
_TEXTS = "_texts"  # suffix: source texts as JSON, only where fitting loses some


def _fit(field: StructField, dtype: DataType) -> tuple[Column, Column, str]:
    """The contract value of a column, when it does not fit, and why."""
    raw = F.col(field.name)
    if isinstance(field.dataType, VarcharType):
        text, limit = raw.cast("string"), field.dataType.length
        return text, F.length(text) > limit, f"longer than {limit}"
    if isinstance(field.dataType, DecimalType):
        return *fit_amount(raw, dtype, field.dataType), "out of range"
    moment = loose_timestamp(raw, dtype)
    return moment, raw.isNotNull() & moment.isNull(), "not a timestamp"


def fit(df: DataFrame, name: str) -> DataFrame:
    """Replace contract columns by fitted values; note misfits in columns named after `name`.

    Unreadable amounts become NULL, as missing ones are.
    """
    fields = [(rank, f) for rank, f in enumerate(MASTER.fields) if f.name in df.columns]
    values, misfits, lost = {}, [], []
    for rank, field in fields:
        value, misfit, why = _fit(field, df.schema[field.name].dataType)
        values[field.name] = value
        note = F.struct(F.lit(rank).alias("rank"), F.lit(f"{field.name}: {why}").alias("why"))
        misfits.append(F.when(misfit, note))
        lost.append(misfit | (F.col(field.name).isNotNull() & value.isNull()))
    texts = F.to_json(F.struct(*[F.col(f.name).cast("string").alias(f.name) for _, f in fields]))
    any_lost = F.coalesce(F.greatest(*lost, F.lit(False)), F.lit(False))
    return df.select(
        *[values.get(c, F.col(c)).alias(c) for c in df.columns],
        F.coalesce(*misfits).alias(name + _MISFIT),
        F.when(any_lost, texts).alias(name + _TEXTS),
    )


def fit_sources(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: fit(df, f"_{name}") for name, df in frames.items()}


def load_master(master: DataFrame) -> DataFrame:
    """Contract columns plus reject_reason and, for rejects, the source row as JSON.

    Missing or unreadable amounts become 0; a column the master lacks becomes NULL.
    The reason names the first column that does not fit.
    """
    if not any(c.endswith(_MISFIT) for c in master.columns):
        master = fit(master, "")
    misfits = [F.col(c) for c in master.columns if c.endswith(_MISFIT)]
    texts = [F.col(c) for c in master.columns if c.endswith(_TEXTS)]
    first = F.least(*misfits) if len(misfits) > 1 else misfits[0]

    def source_text(name):
        kept = [F.get_json_object(t, f"$.{name}") for t in texts]
        return F.coalesce(*kept, column_or(master, name).cast("string")).alias(name)

    source_row = F.to_json(F.struct(*[source_text(name) for name in MASTER.names]))
    return master.select(
        *[_loaded(master, field).alias(field.name) for field in MASTER.fields],
        first["why"].alias(REASON),
        F.when(first.isNotNull(), source_row).alias(SOURCE_ROW),
    )


def _loaded(master: DataFrame, field: StructField) -> Column:
    default = 0 if isinstance(field.dataType, DecimalType) else None
    dtype = "string" if isinstance(field.dataType, VarcharType) else field.dataType
    return column_or(master, field.name, default, dtype).cast(dtype)


def fit_summary(summary: DataFrame, contract: StructType) -> DataFrame:
    """A summary's columns as the contract types them, and why a row does not fit, if so."""
    values, misfits = [], []
    for field in contract.fields:
        raw = F.col(field.name)
        if isinstance(field.dataType, VarcharType):
            values.append(raw)
            misfit, why = F.length(raw) > field.dataType.length, f"longer than {field.dataType.length}"
        else:
            values.append(raw.try_cast(field.dataType).alias(field.name))
            misfit, why = raw.isNotNull() & values[-1].isNull(), "out of range"
        misfits.append(F.when(misfit, f"{field.name}: {why}"))
    return summary.select(*values, F.coalesce(*misfits).alias(REASON))


def accepted(loaded: DataFrame) -> DataFrame:
    return loaded.filter(F.col(REASON).isNull()).select(MASTER.names)


def rejected(loaded: DataFrame) -> DataFrame:
    """Reason and source texts of the rows that do not fit.

    Columns that do fit may show their fitted form, such as 100.00 for 1e2.
    """
    texts = ", ".join(f"{name} string" for name in MASTER.names)
    rows = loaded.filter(F.col(REASON).isNotNull())
    return rows.select(REASON, F.from_json(SOURCE_ROW, texts).alias("r")).select(REASON, "r.*")


def reject_samples(rejects: DataFrame, per_reason: int = 5) -> DataFrame:
    """Some rejects of each reason, those of smallest hash, with their rank from 1.

    A reason may have any share of all rows: each task passes on per_reason rows of it at
    most, and only those meet. Equal rows have equal hashes and fill places one by one.
    """
    texts = F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in MASTER.names])
    rows = rejects.withColumn("row_hash", F.md5(texts))
    place = Window.partitionBy(REASON).orderBy("row_hash", *MASTER.names)
    ranked = rows.withColumn("rank", F.row_number().over(place))
    return ranked.filter(F.col("rank") <= per_reason)


def _fitting(name: str) -> Column:
    return F.col(f"_{name}{_MISFIT}").isNull()


def _tally(df: DataFrame, name: str, key: str) -> DataFrame:
    """Rows per key, and how many of them fit; combined before the shuffle."""
    fit_rows = F.count_if(_fitting(name)).alias(f"{name}_fit")
    return df.groupBy(key).agg(F.count("*").alias(f"{name}_rows"), fit_rows)


def outcome_counts(fitted: dict[str, DataFrame], skew: SkewProfile) -> DataFrame:
    """One row (merged, order_master, order_master_rejects): the rows load_master() makes of
    the joined fitted sources, loads and rejects, without joining them row by row.

    A joined row is loaded if all its parts fit. So an order makes the product of its
    matches' counts, a missing side counting as one fitting row, and as many of these
    load as the product of the fitting ones.
    """
    orders = fitted["orders"].select("order_id", "customer_id", _fitting("orders").alias("_fit"))
    by_order = skew.hot("order_id", "orders")
    base = spread(orders, "orders", by_order)
    base = base.join(_tally(fitted["customers"], "customers", "customer_id"), "customer_id", "left")
    sides = {name: _tally(fitted[name], name, "order_id") for name in ("order_items", "payments")}
    joined = left_join(base, sides, by_order)
    one = F.lit(1).cast("long")
    rows, fit_rows = one, F.col("_fit").cast("long")
    for name in ("customers", *sides):
        rows = rows * F.coalesce(f"{name}_rows", one)
        fit_rows = fit_rows * F.coalesce(f"{name}_fit", one)
    merged, loaded = (F.coalesce(F.sum(x), F.lit(0)) for x in (rows, fit_rows))
    return joined.agg(merged.alias("merged"), loaded.alias("order_master")).withColumn(
        "order_master_rejects", F.col("merged") - F.col("order_master")
    )
