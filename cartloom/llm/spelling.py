"""Spelling variants: words one edit apart, by a frontier of states that walks a trie of tables.

The trie holds every word twice, forwards and backwards, and only where two words part or
one ends does it have a node: an edge carries the letters up to the next such node. One
edit lies in the first or the second half of a word, and the other half is common to both
words. So a word starts at the node where its first half ends, and once more, backwards,
where its last half begins: the dense top of the trie, where every word would meet every
other, is never entered, and no table of it is built.

A state is (word, position, node, edits). Level by level the states are joined with the
edge table and follow an edge exactly, with one letter replaced or with one left out;
insertions are omissions seen from the longer word. A state that ends with one edit where
a word ends has found a neighbour.
"""

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.llm.common import table
from cartloom.plans.staging import stage

MIN_LENGTH, MIN_COUNT = 7, 2
FORM_RATIO = 10  # a form is at least so many times as frequent
MISSPELT = 31  # fixed value: the contract's share of runs that lose a letter
HELD_WORDS = 200_000  # words a task counts before it sends them on
RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % MIN_LENGTH)


def misspelt(doc_id, run: str) -> str:
    """The run without one letter, for one run in MISSPELT, as the contract asks."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    return run if h % MISSPELT else run[: h % len(run)] + run[h % len(run) + 1 :]


def vocabulary(docs: DataFrame, change=None, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of docs(doc_id, text): lower-cased runs of letters of MIN_LENGTH and more
    that occur min_count times at least, after change(doc_id, run) where it is given.

    A null or empty text has no words; the runs of a row without doc_id are not changed;
    repeated rows count again; other columns are ignored. Tasks add up before the shuffle.
    """

    def run(batches):
        held = Counter()

        def flush():
            rows = pa.RecordBatch.from_pydict({"word": list(held), "n": pa.array(held.values(), pa.int64())})
            held.clear()
            return rows

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                lowered = (text.as_py() or "").encode().lower().decode()  # A to Z alone
                found = Counter(RUN.findall(lowered))
                if change is None or doc_id is None:
                    held.update(found)
                else:
                    for word, n in found.items():
                        held[change(doc_id, word)] += n
                if len(held) > HELD_WORDS:
                    yield flush()
        if held:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    counted = rows.mapInArrow(run, "word string, n long").filter(F.length("word") >= MIN_LENGTH)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _paths(words: DataFrame) -> DataFrame:
    """(id, side, depth, node, next, tail): for each word and direction the nodes from its
    half on. A node is named by a hash of the letters that lead to it; next is the code
    point that follows, 0 at the word's end, where tail holds the letters since the half."""

    def run(batches):
        for batch in batches:
            out = []
            for key, word in zip(batch.column("id").to_pylist(), batch.column("word").to_pylist(), strict=True):
                n = len(word)
                for side, (letters, low) in enumerate(((word, n // 2), (word[::-1], n - n // 2))):
                    name = xxhash.xxh3_64(letters[:low].encode(), seed=side)
                    for depth in range(low, n):
                        out.append((key, side, depth, name.intdigest(), ord(letters[depth]), None))
                        name.update(letters[depth].encode())
                    out.append((key, side, n, name.intdigest(), 0, letters[low:]))
            key, side, depth, node, after, tail = zip(*out, strict=True) if out else [()] * 6
            yield pa.RecordBatch.from_pydict({
                "id": pa.array(key, pa.int64()),
                "side": pa.array(side, pa.int32()),
                "depth": pa.array(depth, pa.int32()),
                "node": pa.array(np.array(node, np.uint64).view(np.int64)),
                "next": pa.array(after, pa.int32()),
                "tail": pa.array(tail, pa.string()),
            })

    kinds = "id long, side int, depth int, node long, next int, tail string"
    return words.select("id", "word").mapInArrow(run, kinds)


def _bit(code: str) -> Column:
    """One of 63 bits for a code point, the lowest for 0: letters may share one."""
    return F.expr(f"shiftleft(1L, cast({code} % 63 AS int))")


def trie(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges (side, node, depth, label, child, onward, ends) and the states in which
    words(id, word) start.

    depth is that of node. ends is the word that ends at a child without children; a word
    that ends where others go on has an edge of its own, without a label and a child.
    onward has a bit for each letter that follows the child, see _bit().
    """
    paths = stage(_paths(words), "paths")
    nodes = paths.groupBy("side", "node").agg(
        F.min("next").alias("a"), F.max("next").alias("b"), F.bit_or(_bit("next")).alias("onward")
    )
    kept = nodes.filter("a <> b OR a = 0").select("side", "node", "onward", (F.col("b") == 0).alias("leaf"))
    steps = paths.join(kept, ["side", "node"]).select(
        "id", "side", F.struct("depth", "node", "leaf", "onward", "tail").alias("step")
    )
    walks = steps.groupBy("id", "side").agg(F.sort_array(F.collect_list("step")).alias("walk"))
    walks = stage(
        walks.select("id", "side", "walk", F.element_at("walk", -1)["tail"].alias("tail")), "walks"
    )
    last = F.element_at("walk", -1)
    low = last["depth"] - F.length("tail")

    def edge(at: Column, step: Column) -> Column:
        after = F.get("walk", at + 1)
        ends = F.when(after.isNull() | after["leaf"], F.col("id"))
        return F.struct(
            step["node"].alias("node"),
            step["depth"].alias("depth"),
            F.when(after.isNull(), "")
            .otherwise(F.substring("tail", step["depth"] - low + 1, after["depth"] - step["depth"]))
            .alias("label"),
            after["node"].alias("child"),
            after["onward"].alias("onward"),
            ends.alias("ends"),
        )

    made = F.transform("walk", lambda step, at: edge(at, step))
    # A leaf's own end is told by the edge that leads to it.
    made = F.when(last["leaf"], F.slice(made, F.lit(1), F.size(made) - 1)).otherwise(made)
    edges = stage(walks.select("side", F.inline(made)).distinct(), "edges")
    first = F.element_at("walk", 1)
    starts = walks.select(
        F.col("id").alias("word"),
        "side",
        first["depth"].alias("position"),
        first["node"].alias("node"),
        first["depth"].alias("depth"),
        F.lit(0).alias("edits"),
        F.substring("tail", first["depth"] - low + 1, F.length("tail")).alias("rest"),
    )
    return edges, starts.filter("rest <> ''")


def _followed(states: DataFrame, edges: DataFrame) -> DataFrame:
    """One level: every state along every edge of its node, (state, found)."""
    size, rest = F.length("label"), F.col("rest")
    exact = F.startswith("rest", "label")
    pure = F.col("edits") == 0

    def one_edit(letters: int) -> Column:
        """The rest's beginning, that much longer than the label, becomes it by one edit."""
        begin = F.substring(rest, F.lit(1), size + letters)
        long_enough = F.length("rest") >= size + letters
        return pure & ~exact & long_enough & (F.levenshtein(begin, F.col("label"), 1) == 1)

    def state(holds: Column, taken: Column, edits: Column) -> Column:
        left = F.substring(rest, taken + 1, F.length("rest"))
        # A word ends here: with its one edit made, or with one letter left to omit.
        there = F.when((edits + F.length(left) == 1) & F.col("ends").isNotNull(), F.col("ends"))
        made = F.struct(
            (F.col("position") + taken).cast("int").alias("position"),
            F.col("child").alias("node"),
            (F.col("depth") + size).cast("int").alias("depth"),
            edits.cast("int").alias("edits"),
            left.alias("rest"),
            there.alias("found"),
        )
        return F.when(holds, made)

    ways = F.array(
        state(exact, size, F.col("edits")),
        state(one_edit(0), size, F.lit(1)),
        state(one_edit(1), size + 1, F.lit(1)),
    )
    met = states.join(edges.drop("depth"), ["side", "node"]).filter(exact | pure)
    out = met.select("word", "side", "child", "onward", "ends", F.inline(ways))
    # From a child without children only those go on that have found its word, and stop;
    # with its edit made, a state goes on where its next letter does.
    follows = (F.col("edits") == 0) | (F.col("onward").bitwiseAND(_bit("ascii(rest)")) != 0)
    alive = F.col("found").isNotNull() | (F.col("child").isNotNull() & F.col("ends").isNull() & follows)
    kept = out.filter(F.col("position").isNotNull() & alive)
    return kept.select("word", "side", "position", "node", "depth", "edits", "rest", "found")


def neighbours(words: DataFrame) -> DataFrame:
    """(word, near), both ways, for all ids of words(id, word) that are one edit apart.

    Each level is a written table. Its number is bounded by the nodes on a path, not by a
    word's letters. A busy node is no single task: adaptive execution splits the states of
    this inner join, and a node has at most an edge a letter.
    """
    edges, states = trie(words)
    found = []
    while (low := states.agg(F.min("depth")).first()[0]) is not None:
        level = stage(_followed(states, edges.filter(F.col("depth") >= low)), "level")
        found.append(level.filter("found IS NOT NULL").select("word", F.col("found").alias("near")))
        states = level.filter("found IS NULL").drop("found")
    pairs = words.select(F.col("id").alias("word"), F.col("id").alias("near")).limit(0)
    for part in found:
        pairs = pairs.unionAll(part)
    turned = pairs.select(F.col("near").alias("word"), F.col("word").alias("near"))
    return pairs.unionAll(turned).filter("word <> near").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of links (word, form): chains are cut in half until all ends are reached.

    A form is FORM_RATIO times as frequent as its word, so chains are short and never close.
    """
    roots = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = roots.join(onward, "root", "left")
        jumped = stage(jumped.select("word", F.coalesce("next", "root").alias("root"), "next"), "roots")
        roots = jumped.drop("next")
        if jumped.filter("next IS NOT NULL").isEmpty():
            return roots


def grouped(words: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for words(word, n), each word once.

    Near words differ by one inserted, deleted or replaced code point. The form is the
    near word of largest n, ties by code points, if that is at least `ratio` times the
    word's; the root is the last form that is reached. Words of any length and script are
    welcome; a word without near words is its own root; an empty table gives an empty one.
    Nodes are named by 64 bits, so links are held against the words themselves.
    """
    words = stage(words.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "words")
    other = words.select(F.col("id").alias("near"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    mine = words.select(F.col("id").alias("word"), F.col("word").alias("own"))
    links = neighbours(words).join(other, "near").join(mine, "word")
    links = links.filter(F.levenshtein("own", "other", 1) == 1)
    best = F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other"), F.col("near")))
    near = links.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    rows = words.select(F.col("id").alias("word"), F.col("word").alias("text"), "n")
    rows = rows.join(near, "word", "left")
    has_form = -F.col("best.n") >= ratio * F.col("n")
    rows = stage(
        rows.select(
            "word",
            "text",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            *[F.when(has_form, value).alias(name) for name, value in (
                ("form", F.col("best.near")), ("form_text", F.col("best.other")), ("form_n", -F.col("best.n"))
            )],
        ),
        "forms",
    )
    roots = _roots(rows.filter("form IS NOT NULL").select("word", "form"))
    ends = words.select(F.col("id").alias("root"), F.col("word").alias("root_text"))
    named = roots.join(ends, "root").select("word", "root_text")
    return rows.join(named, "word", "left").select(
        F.col("text").alias("word"),
        F.col("form_text").alias("form"),
        F.coalesce("root_text", "text").alias("root"),
        "n",
        "n_near",
        "form_n",
    )


def op11_spelling_variants(spark, sf_dir):
    """Variant groups of the words of all documents; one run in MISSPELT loses a letter first.

    Nulls, odd texts, repeated rows and empty tables: as vocabulary() and grouped() say.
    """
    return grouped(vocabulary(table(spark, sf_dir, "documents"), misspelt))


#: crc32 goes byte by byte through a table of 256 entries, itself made by eight shifts.
OP11_SQL = f"""
WITH steps AS (
  SELECT list(list_reduce(list_prepend(b, range(0, 8)), lambda x, k:
    CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) ORDER BY b) AS t
  FROM (SELECT b::BIGINT AS b FROM range(0, 256) r(b))
), runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
  ) WHERE length(run) >= {MIN_LENGTH} GROUP BY ALL
), hashed AS (
  SELECT runs.*, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
      range(0, octet_length(encode(doc_id || ':' || run))),
      lambda i: ('0x' || substr(hex(encode(doc_id || ':' || run)), 2 * i + 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM runs, steps
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % {MISSPELT} = 0 THEN substr(run, 1, (h % length(run))::BIGINT)
      || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n FROM hashed
  ) WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(n) >= {MIN_COUNT}
), holes AS (
  SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, unnest(range(0, length(word))) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS near FROM holes a JOIN holes b USING (i, rest) WHERE a.word <> b.word
  UNION SELECT h.word, w.word FROM holes h JOIN words w ON h.rest = w.word
  UNION SELECT w.word, h.word FROM holes h JOIN words w ON h.rest = w.word
), counted AS (
  SELECT near.word, count(*) AS n_near, max(n) AS best,
    arg_min(near, struct_pack(a := -n, b := encode(near))) AS form
  FROM near JOIN words ON near.near = words.word GROUP BY near.word
), formed AS (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best >= {FORM_RATIO} * n THEN form END AS form,
    CASE WHEN best >= {FORM_RATIO} * n THEN best END AS form_n
  FROM words LEFT JOIN counted USING (word)
), chain AS (
  WITH RECURSIVE c AS (
    SELECT word, word AS root, 0 AS d FROM formed
    UNION ALL SELECT c.word, f.form, d + 1 FROM c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL
  ) SELECT word, arg_max(root, d) AS root FROM c GROUP BY word
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN chain USING (word)
"""
