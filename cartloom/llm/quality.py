"""Quality rules: word and repetition counts, and lines that many documents of a host share.

All of it is DataFrame functions. Text is read once; what is shuffled are line hashes.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.llm.common import WORD, let, table
from cartloom.plans.staging import stage

WINDOW = 8  # words
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
MAX_DOCS = 20  # a line in more documents of one host is removed
MAX_REMOVED_PERCENT = 70  # of a document's characters; beyond it is depleted
SALTS = 16


def _repeat_words(words: Column) -> Column:
    """Words inside windows that stand in the text twice or more, the first one included."""

    def covered(at: Column) -> Column:
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        add = F.aggregate(
            at,
            start,
            lambda a, p: F.struct(
                (a["n"] + F.least(F.lit(WINDOW), p + WINDOW - a["end"])).alias("n"),
                (p + WINDOW).alias("end"),
            ),
        )
        return add["n"]

    def twice(found: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(found, k)["h"] == x["h"], F.lit(False))
        again = F.filter(found, lambda x, k: same(x, k - 1) | same(x, k + 1))
        return covered(F.sort_array(F.transform(again, lambda x: x["i"])))

    def count(hashes: Column) -> Column:
        placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(
            let(F.sort_array(placed), twice)
        )

    starts = F.sequence(F.lit(1), F.size(words) - (WINDOW - 1))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    return F.when(F.size(words) < WINDOW, 0).otherwise(let(hashes, count))


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 15), 16, 10).cast("long")


def measure(docs: DataFrame) -> DataFrame:
    """One row per document: id, host, base counts, and its normalised lines as (h, chars, at)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    normal = F.regexp_replace(F.lower("_text"), r"[ \t\r\x0B\f]{2,}|[\t\r\x0B\f]", " ")
    rows = docs.select(F.col("doc_id"), F.col("source").alias("_host"), text.alias("_text")).select(
        "*",
        F.regexp_extract_all("_text", F.lit(WORD), 0).alias("_words"),
        F.filter(F.split("_text", "\n"), lambda x: x.rlike(WORD)).alias("_lines"),
        F.transform(F.split(normal, "\n"), lambda x: F.trim(x)).alias("_normal"),
    )
    placed = F.transform("_normal", lambda x, i: F.struct(x.alias("line"), i.alias("at")))
    return rows.select(
        F.monotonically_increasing_id().alias("_uid"),
        "doc_id",
        "_host",
        F.size("_words").cast("long").alias("n_words"),
        F.aggregate("_words", F.lit(0), lambda a, w: a + F.length(w)).cast("long").alias("word_chars"),
        (F.size(F.split("_text", r"[#*$%&|<>]", -1)) - 1).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("_words")).cast("long").alias("n_repeat_words"),
        F.aggregate("_normal", F.lit(0), lambda a, x: a + F.length(x)).cast("long").alias("_chars"),
        F.transform(
            F.filter(placed, lambda x: x["line"].rlike(WORD)),
            lambda x: F.struct(
                _line_hash(x["line"]).alias("h"), F.length(x["line"]).alias("chars"), x["at"].alias("at")
            ),
        ).alias("_found"),
        F.xxhash64("_text").alias("_doc"),
        F.xxhash64("_host", "_text").alias("_k1"),
        F.xxhash64("_text", "_host").alias("_k2"),
    )


def judge(docs: DataFrame, max_docs: int = MAX_DOCS, removed_percent: int = MAX_REMOVED_PERCENT):
    """measure() plus base_failed, kept and _flagged, the positions of lines that go or null.

    A normalised line (lower case, white space runs as one space, trimmed) that
    holds a word goes where more than max_docs distinct documents of its host hold it.
    Documents are told apart by a hash of their whole text, so that exact copies of one
    document, which are another operator's work, count once. A document that loses more
    than removed_percent of its characters is depleted.

    A null text is empty, a null host a host like any other. Repeated rows are judged
    alike. An empty table gives an empty result.
    """
    rows = stage(measure(docs), "measured")
    lines = rows.select("_uid", "_host", "_doc", F.inline("_found"))
    # Rows of a very common line are spread by the document before they are counted.
    shared = (
        lines.select("_host", "h", "_doc")
        .distinct()
        .groupBy("_host", "h")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") > max_docs)
    )
    # A very common line is one join key, so its rows are dealt over salts.
    spread = shared.select(
        "_host", "h", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    )
    salted = lines.select(
        "_uid", "_host", "h", "chars", "at", F.pmod(F.xxhash64("_uid"), F.lit(SALTS)).cast("int").alias("_salt")
    )
    mine, theirs = salted.alias("x"), spread.alias("y")
    hit = mine.join(
        theirs,
        (F.col("x.h") == F.col("y.h"))
        & (F.col("x._salt") == F.col("y._salt"))
        & F.col("x._host").eqNullSafe(F.col("y._host")),
        "left_semi",
    )
    removed = hit.groupBy("_uid").agg(
        F.sum("chars").alias("_removed"), F.collect_list("at").alias("_flagged")
    )
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    depleted = 100 * F.coalesce("_removed", F.lit(0)) > removed_percent * F.col("_chars")
    return (
        rows.drop("_found", "_doc")
        .join(removed, "_uid", "left")
        .withColumn("base_failed", base_failed)
        .withColumn("kept", ~F.col("base_failed") & ~depleted)
    )


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def op6_quality_rules(spark, sf_dir):
    return judge(table(spark, sf_dir, "documents")).select("doc_id", *BASE, "base_failed", "kept")


def without_lines(text: Column, flagged: Column) -> Column:
    """The text without the lines at the flagged positions."""

    def rest(lines: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(lines) - 1)
        return F.transform(F.array_except(at, flagged), lambda i: F.get(lines, i))

    return F.array_join(let(F.split(text, "\n"), rest), "\n")


def keep_good(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: rejected documents go, and of the others the lines above the limit;
    n_chars, where there is one, is counted anew for those. A verdict depends on text and
    source alone, so a hash of both finds its rows again."""
    judged = judge(docs).filter("NOT kept OR _flagged IS NOT NULL")
    verdicts = judged.groupBy("_k1", "_k2").agg(
        F.first("kept").alias("_kept"), F.first("_flagged").alias("_flagged")
    )
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(
        F.struct("*").alias("_row"),
        F.xxhash64("source", text).alias("_k1"),
        F.xxhash64(text, "source").alias("_k2"),
    )
    good = keyed.join(verdicts, ["_k1", "_k2"], "left").filter("coalesce(_kept, true)")
    clean = F.when(
        F.col("_flagged").isNotNull(),
        without_lines(F.col("_row.text").cast("string"), F.col("_flagged")),
    )
    new = {"text": F.col("_clean"), "n_chars": F.length("_clean")}
    return good.withColumn("_clean", clean).select(
        *[
            (F.coalesce(new[c].cast(kind), F.col("_row")[c]) if c in new else F.col("_row")[c]).alias(c)
            for c, kind in docs.dtypes
        ]
    )


OP6_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS uid, doc_id, source, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words FROM d
), grams AS (
  SELECT uid, i, words[i:i + 7] AS g
  FROM (SELECT uid, words, unnest(range(1, len(words) - 6)) AS i FROM w)
), again AS (
  SELECT uid, i FROM grams QUALIFY count(*) OVER (PARTITION BY uid, g) > 1
), rep AS (
  SELECT uid, count(DISTINCT i + k) AS n FROM again, range(0, 8) r(k) GROUP BY uid
), raw_lines AS (
  SELECT uid, unnest(string_split(t, chr(10))) AS line FROM d
), dup AS (
  SELECT uid, count(*) - count(DISTINCT line) AS n FROM raw_lines
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY uid
), normal AS (
  SELECT uid, source, trim(regexp_replace(lower(line), '[ \\t\\r\\x0B\\f]+', ' ', 'g')) AS line
  FROM raw_lines JOIN d USING (uid)
), chars AS (
  SELECT uid, sum(length(line)) AS chars FROM normal GROUP BY uid
), lines AS (
  SELECT uid, source, line FROM normal WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
), shared AS (
  SELECT lines.source, line FROM lines JOIN d USING (uid)
  GROUP BY lines.source, line HAVING count(DISTINCT md5(t)) > {MAX_DOCS}
), removed AS (
  SELECT uid, sum(length(line)) AS n FROM lines x
  WHERE EXISTS (SELECT 1 FROM shared s WHERE s.line = x.line AND s.source IS NOT DISTINCT FROM x.source)
  GROUP BY uid
), counted AS (
  SELECT w.uid, doc_id, len(words)::BIGINT AS n_words,
    coalesce(list_sum([length(x) FOR x IN words]), 0)::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
    coalesce(removed.n, 0) AS removed, chars.chars
  FROM w LEFT JOIN dup USING (uid) LEFT JOIN rep USING (uid) LEFT JOIN removed USING (uid)
    LEFT JOIN chars USING (uid)
), judged AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * removed <= {MAX_REMOVED_PERCENT} * chars AS kept
FROM judged
"""
