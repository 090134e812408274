"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing names."""

import itertools
import random
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_llm_queries import brute_targets, simhash, smallest

from cartloom.llm import chat, html_text, metric_join, mixing, packing, quality, sharding, simhash as sim, token_files, toxicity
from cartloom.llm.common import first_by_hash
from cartloom.llm.components import components
from cartloom.llm.tokens import Encoder, tokenizer_path
from cartloom.plans.staging import staged_folder

STAGES = {
    "quality": quality.keep_good,
    "simhash": sim.keep_one,
    "mixing": mixing.mix_documents,
}


@pytest.mark.parametrize("name", STAGES)
def test_stages_keep_the_columns(spark, odd, none, name):
    assert STAGES[name](spark, odd, "").columns == odd.columns
    assert STAGES[name](spark, none, "").count() == 0
    STAGES[name](spark, odd, "").collect()


def test_toxicity(spark, odd, none):
    labels = odd.filter("doc_id < 100").select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    toxic = odd.withColumn("text", F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("you utter scumbag "), "text")).otherwise(F.col("text")))
    net = toxicity.train(toxic, labels)
    got = toxicity.scored(toxic, net)
    assert got.select("row.*").columns == odd.columns and got.count() == odd.count()
    scores = got.select("row.doc_id", "score").collect()
    assert all(0 <= s <= 1 for _, s in scores)
    right = [(s >= 0.5) == (d % 3 == 0) for d, s in scores if d is not None and 0 <= d < 120]
    assert sum(right) > 0.9 * len(right)
    assert len({s for d, s in scores if d == 304}) == 1
    for marked in (labels.filter("toxic = 0"), labels.limit(0)):  # nothing to learn from
        flat = toxicity.scored(odd, toxicity.train(odd, marked)).filter("score >= 0.5")
        assert flat.count() == 0
    assert toxicity.scored(none, net).count() == 0


def test_a_very_long_text_is_scored_whole(monkeypatch):
    net = toxicity.Net()
    vectors = np.random.default_rng(0).standard_normal((1000, toxicity.DIM)).astype(np.float32)
    whole = net.logit(vectors)
    monkeypatch.setattr(toxicity, "CHUNK", 64)
    assert net.logit(vectors) == pytest.approx(whole, rel=1e-5)


def test_quality_of_odd_rows(odd, none):
    got = quality.judge(odd)
    assert got.count() == odd.count() and quality.judge(none).count() == 0
    of = {r["doc_id"]: r for r in got.collect()}
    assert [of[300][c] for c in quality.BASE] == [0] * 5 and of[300]["base_failed"]
    assert [of[301][c] for c in quality.BASE] == [0] * 5
    assert of[303]["n_words"] == 40_000 and not of[303]["base_failed"]


def test_repeated_windows_against_brute_force(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 60))) for _ in range(40)]
    texts += [" ".join(map(str, range(30))) + " " + " ".join(map(str, range(12)))]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    for r in quality.measure(docs).collect():
        w = texts[r["doc_id"]].split()
        seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        covered = {i + k for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for k in range(8)}
        assert r["n_repeat_words"] == len(covered)


def test_shared_lines_of_one_host(spark):
    rng = random.Random(2)
    own = lambda: " ".join(str(rng.random()) for _ in range(12))
    shared = "this very line stands  on every page of the host"
    rows = [(i, f"{own()}\n{own()}\n{shared.upper() if i % 2 else shared}", "h1") for i in range(40)]
    rows += [(100 + i, "\n".join([shared] + [f"{shared} again {k}" for k in range(8)] + ["one two three " * 2 + str(i)]), "h1") for i in range(40)]
    rows += [(200 + i, "\n".join([own() for _ in range(3)]), "h2") for i in range(5)]
    copy = "\n".join(own() for _ in range(6))
    rows += [(300 + i, copy, "h2") for i in range(60)]  # copies of one document are one document
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(docs).collect()}
    assert all(kept[i] for i in kept if not 100 <= i < 200) and not any(kept[100 + i] for i in range(40))


def test_simhash_of_odd_rows(odd, odd_rows, none):
    got = [tuple(r) for r in sim.near_duplicates(odd).collect()]
    prints = [simhash(t) for _, t, _, _ in odd_rows]
    links = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    best = smallest(range(len(prints)), links)
    groups = defaultdict(list)
    for i, (d, *_) in enumerate(odd_rows):
        groups[best[i]].append(d)
    low = {k: min((d for d in v if d is not None), default=None) for k, v in groups.items()}
    want = [(d, f"{prints[i]:016x}", low[best[i]]) for i, (d, *_) in enumerate(odd_rows)]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert sim.near_duplicates(none).count() == 0


@pytest.mark.parametrize("n, bits", [(10, 4), (10, 0), (10, 1), (10, 6), (1 << 30, 4)])
def test_every_link_is_found(spark, n, bits):
    rng = random.Random(n + bits)
    prints = {rng.getrandbits(64) for _ in range(20)}
    for p in list(prints):
        for _ in range(8):
            flips = rng.sample(range(64), rng.randint(0, bits + 2))
            prints.add(p ^ sum(1 << f for f in flips))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    got = {frozenset(r) for r in sim.links(spark.createDataFrame([(p,) for p in signed], "bits long"), n, bits).collect()}
    want = {frozenset((a, b)) for a in signed for b in signed if a < b and ((a ^ b) % (1 << 64)).bit_count() <= bits}
    assert got == want


@pytest.mark.parametrize("rows, n", [(0, 5), (50, 80), (20_000, 30)])
def test_a_sample_is_the_rows_of_smallest_hash(spark, rows, n):
    df = spark.range(rows, numPartitions=4)
    got = [r["id"] for r in first_by_hash(df, "id", n).collect()]
    assert got == [r["id"] for r in df.orderBy(F.xxhash64("id"), "id").limit(n).collect()]


def test_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 50)] + [(rng.randint(2000, 2100), rng.randint(2000, 2100)) for _ in range(60)] + [(5, 5)]
    got = {r["id"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    best = smallest({x for p in links for x in p}, links)
    ends = {x for a, b in links if a != b for x in (a, b)}
    assert set(got) == ends
    assert all((got[a] == got[b]) == (best[a] == best[b]) for a in ends for b in list(ends)[:40])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_mixing_of_odd_rows(odd, none):
    got = mixing.mix(odd, lane_rows=7)
    rows = got.collect()
    assert len(rows) == odd.count() and mixing.mix(none).count() == 0
    assert all(0 <= r["copies"] <= 3 for r in rows)
    again = mixing.mix(odd.repartition(3), lane_rows=7).collect()
    count = lambda rs: Counter((r["row"]["doc_id"], r["size"], r["copies"]) for r in rs)
    assert count(rows) == count(again)
    taken, goal, small = Counter(), {}, defaultdict(list)
    for r in rows:
        s = r["row"]["source"]
        taken[s] += r["size"] * r["copies"]
        goal[s] = r["target"]
        small[s].append(r["size"])
    for s in goal:  # the last open document is a small one unless one document is most of the source
        if max(small[s]) < sum(small[s]) / 3:
            assert abs(taken[s] - goal[s]) <= max(small[s])


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 10, "b": 10, "c": 10},
        {"a": 1, "b": 99, None: 0},
        {"a": 0},
        {},
        {f"s{i:02}": 3**i for i in range(12)} | {None: 40},
    ],
)
def test_targets(spark, sizes):
    rows = [(s, n, 1) for s, n in sizes.items()]
    classes = spark.createDataFrame(rows, "src string, size long, n long")
    got = {r["_src"]: r for r in mixing.source_plans(classes, mixing.WEIGHTS, 3, 10).collect()}
    want = brute_targets(sizes)
    assert {s: r["target"] for s, r in got.items()} == pytest.approx(want)
    for s, r in got.items():
        assert 0 <= r["p"] < 1 and (r["whole"] + r["p"]) * sizes[s] == pytest.approx(want[s])


@pytest.mark.parametrize(
    "docs",
    [
        [(40, 0.3), (11, 0.3), (10, 0.3), (3, 0.3), (3, 0.3), (0, 0.3)],
        [(10, 0.5), (8, 0.95), (6, 0.05), (5, 0.9), (3, 0.1), (3, 0.5), (0, 0.7)],
        [(1000, 0.2), (7, 0.8), (7, 0.6), (1, 0.9)],
        [(5, 0.0), (4, 1.0), (2, 0.25)],
    ],
)
def test_every_document_keeps_its_probability(docs):
    """Means over many seeds, of equal and of unequal probabilities."""
    sizes, p = np.array([s for s, _ in docs]), np.array([x for _, x in docs])
    runs, rng, taken = 20_000, random.Random(5), np.zeros(len(docs))
    for _ in range(runs):
        got = mixing.settle(sizes, p, rng)
        assert sizes @ got == pytest.approx(sizes @ p) and sum((got > 0) & (got < 1)) <= 1
        taken += [rng.random() < x for x in got]
    assert (abs(taken / runs - p) <= 4 * (p * (1 - p) / runs) ** 0.5).all()


def test_mixing_of_a_class_of_many_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "REPEATS", 7)
    same = [(1, "a b c", "s", {"k": 1})] * 50 + [(1, "a b c", "s", None)] * 3
    rows = same + [(i, "d e", "t", None) for i in range(2, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size map<string,int>")
    got = mixing.mix(docs, lane_rows=5).collect()
    assert Counter(r["row"]["doc_id"] for r in got) == Counter(r[0] for r in rows)
    for s in "st":
        mine = [r for r in got if r["row"]["source"] == s]
        assert abs(sum(r["size"] * r["copies"] for r in mine) - mine[0]["target"]) <= 3
    fifty = [r["copies"] for r in got if r["row"]["size"]]
    assert len(fifty) == 50 and max(fifty) - min(fifty) <= 1


@pytest.mark.parametrize("lane_rows, near", [(5, 40), (100, 5)])  # off by one document; by a small one
def test_levels_keep_words_and_expectations(spark, monkeypatch, lane_rows, near):
    monkeypatch.setattr(mixing, "FAN_IN", 4)
    docs = spark.range(600).select(
        F.col("id").alias("doc_id"),
        F.array_join(F.array_repeat(F.lit("w"), (F.col("id") % 40 + 1).cast("int")), " ").alias("text"),
        F.when(F.col("id") < 400, "a").otherwise("b").alias("source"),
    )
    rows = mixing.mix(docs, lane_rows=lane_rows).collect()
    for s in "ab":
        mine = [r for r in rows if r["row"]["source"] == s]
        assert abs(sum(r["size"] * r["copies"] for r in mine) - mine[0]["target"]) <= near
    a = [r for r in rows if r["row"]["source"] == "a"]
    mean = a[0]["target"] / a[0]["source_size"]
    for low, high in ((0, 10), (10, 25), (25, 41)):  # no size is favoured
        part = [r["copies"] for r in a if low < r["size"] <= high]
        assert sum(part) / len(part) == pytest.approx(mean, abs=0.2)


def brute_bins(lengths, capacity):
    """Fewest bins, by trying everything."""
    best = len(lengths)

    def go(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + lengths[i] <= capacity and bins[k] not in bins[:k]:
                go(i + 1, bins[:k] + [bins[k] + lengths[i]] + bins[k + 1 :])
        go(i + 1, [*bins, lengths[i]])

    go(0, [])
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_bounds_and_best_fit(lengths):
    lengths.sort(reverse=True)
    fewest = brute_bins(lengths, 20)
    assert packing.lower_bound(np.bincount(lengths, minlength=21)) <= fewest
    bins, offsets, used = packing.best_fit(lengths, 20)
    assert len(used) >= fewest and used.max() <= 20
    for k in range(len(used)):
        at = 0
        for i in np.flatnonzero(bins == k):
            assert offsets[i] == at
            at += lengths[i]
    tree = sharding.best_fit_decreasing(lengths, 20)
    assert len(set(tree)) == len(used)
    assert all(sum(n for n, b in zip(lengths, tree, strict=True) if b == k) <= 20 for k in set(tree))


def test_lanes_exchange_until_the_bound(spark):
    rng = random.Random(6)
    items = spark.createDataFrame([(i, rng.choice([700, 650, 1024, 333, 90, 2048, 5])) for i in range(900)], "k int, length long")
    rows = packing.pack(items, lane_pieces=40).collect()
    assert sorted(r["k"] for r in rows) == list(range(900))
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        assert [o for o, _ in sorted(b)] == np.cumsum([0] + [n for _, n in sorted(b)])[:-1].tolist()
        assert sum(n for _, n in b) <= 2048
    whole = packing.best_fit(sorted((r["length"] for r in rows), reverse=True), 2048)[2]
    assert len(bins) <= len(whole) + 2  # what one lane of everything takes


def test_packing_of_odd_rows(odd, odd_rows, none):
    pieces = packing.pieces(odd, tokenizer_path(), 256, with_ids=True)
    packed = packing.pack(pieces, 256)
    rows = packed.collect()
    encode = Encoder(tokenizer_path())
    want = Counter((d, zlib.crc32(encode.ids(t) + bytes(4))) for d, t, _, _ in odd_rows if len(encode.ids(t)) < 1000)
    assert want == Counter((r["doc_id"], r["ids_crc32"]) for r in rows if r["start"] == 0 and r["piece"] == 0 and (r["doc_id"] != 303))
    ids = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(packed).collect()}
    for r in rows:
        assert ids[r["sequence_id"]][4 * r["offset"] : 4 * (r["offset"] + r["length"])] == bytes(r["ids"])
    assert packing.pack(packing.pieces(none, tokenizer_path())).count() == 0


ODD_TEXTS = st.lists(st.sampled_from([*"ab'st  \n\t.é漢\xa0\u2003\r1!", "<|endoftext|>"]), max_size=40).map("".join)


@settings(max_examples=200, deadline=None)
@given(ODD_TEXTS)
def test_ids_are_the_tokenizers(text):
    encode = test_ids_are_the_tokenizers.__dict__.setdefault("encoder", Encoder(tokenizer_path()))
    encode.compared = 1 << 30
    want = encode.tokenizer.encode(text, add_special_tokens=False).ids
    assert encode.ids(text) == np.array(want, "<u4").tobytes()


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-(2**63), 2**63 - 1)), st.integers(0, 3000), st.sampled_from([1, 300, 50_257, 2**32])), max_size=6))
def test_blocks_round_trip(docs):
    rng = np.random.default_rng(len(docs))
    ids = [rng.integers(0, top, n, dtype=np.uint64).astype("<u4").tobytes() for _, n, top in docs]
    data = token_files.encode_file([d for d, _, _ in docs], ids)
    got = list(token_files.decode_file(data))
    assert [(d, x) for d, _, x in got] == [(d, x) for (d, _, _), x in zip(docs, ids, strict=True)]


def test_outliers_are_exceptions():
    few = np.full(1024, 7, np.uint32)
    few[[3, 1000]] = 2**31
    assert len(token_files.encode_blocks(few)[0]) == 8 + 2 * 6  # width 0 and two exceptions
    assert len(token_files.encode_blocks(np.arange(1024, dtype=np.uint32))[0]) == 8 + 1024 * 10 // 8


def test_token_files_of_odd_rows(spark, odd, odd_rows, none, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_IDS", 500)
    for docs, n in ((odd, len(odd_rows)), (none, 0)):
        folder = f"{staged_folder(spark)}/odd-tokens-{n}"
        index = token_files.write_token_files(docs, folder, tokenizer_path())
        if not n:
            assert index.count() == 0
            continue
        rows = token_files.read_token_files(spark, folder).join(index, "file").collect()
        rows.sort(key=lambda r: (r["begin"] + r["at"]))
        assert len(rows) == n and len({r["file"] for r in rows}) > 3
        at = 0
        for r in rows:
            assert r["begin"] + r["at"] == at
            at += len(r["ids"]) // 4
        order = [r["doc_id"] for r in rows]
        assert order == sorted(order, key=lambda d: (d is not None, d or 0))
        encode = Encoder(tokenizer_path())
        assert Counter((r["doc_id"], bytes(r["ids"])) for r in rows) == Counter((d, encode.ids(t) + bytes(4)) for d, t, _, _ in odd_rows)


def test_shards_beside_a_large_group_are_near_equal():
    rng = random.Random(8)
    sizes = sorted([5000, 3000, *(rng.randint(1, 60) for _ in range(600))], reverse=True)
    shards = sharding.into_shards(sizes, 10)
    held = Counter()
    for n, k in zip(sizes, shards, strict=True):
        held[k] += n
    small = [n for k, n in held.items() if n not in (5000, 3000)]
    assert set(held) == set(range(10)) and max(small) - min(small) <= 60
    assert sharding.into_shards([], 3) == [] and sharding.into_shards([7], 3) == [0]
    assert sorted(sharding.into_shards([4, 4, 4], 3)) == [0, 1, 2]


def test_sharding_of_odd_rows(odd, odd_rows, none):
    rows = sharding.shard(odd, 4).collect()
    assert len(rows) == len(odd_rows) and sharding.shard(none, 4).count() == 0
    slots, homes = defaultdict(list), defaultdict(set)
    text = {d: t or "" for d, t, _, _ in odd_rows}
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        homes[text[r["row"]["doc_id"]]].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(len(h) == 1 for h in homes.values())


def test_pooling_is_the_largest_response_of_every_window():
    net = toxicity.Net()
    rng = np.random.default_rng(3)
    net.bias = [rng.standard_normal(toxicity.FILTERS).astype(np.float32) for _ in toxicity.WIDTHS]
    for words in (0, 1, 2, 3, 40):
        vectors = rng.standard_normal((words, toxicity.DIM)).astype(np.float32)
        want = []
        for width, filters, bias in zip(toxicity.WIDTHS, net.filters, net.bias, strict=True):
            for f in range(toxicity.FILTERS):
                best = 0.0
                for at in range(words - width + 1):
                    terms = (
                        float(vectors[at + j, d]) * float(filters[j * toxicity.DIM + d, f])
                        for j in range(width)
                        for d in range(toxicity.DIM)
                    )
                    best = max(best, sum(terms) + float(bias[f]))
                want.append(best)
        assert np.allclose(net.pooled(vectors)[0], want, atol=1e-5)


def test_components_are_doubles_whatever_their_type(spark):
    big = 1 << 24  # in single precision big + 1 is big, and the cosine below is 0.5 ** 0.5
    df = spark.createDataFrame([(1, [big + 1, big]), (2, [1, 0]), (3, [0, 0])], "vec_id long, embedding array<bigint>")
    for kind in ("int", "bigint", "decimal(12,0)", "double"):
        typed = df.selectExpr("vec_id", f"CAST(embedding AS array<{kind}>) AS embedding")
        got = metric_join.near_vectors(typed, cosine=0.5**0.5 + 1e-8).collect()
        assert {r["vec_id"]: r["component_id"] for r in got} == {1: 1, 2: 1, 3: 3}, kind


def test_vectors_of_odd_rows(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((60, 6))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(100 + i, (3 * v + 0.02 * rng.standard_normal(6)).tolist()) for i, v in enumerate(base[:30])]
    rows += [(200 + i, base[0].tolist()) for i in range(50)] + [(7, base[7].tolist())] * 2
    sound = list(rows) + [(400, [1.0, 2.0]), (401, [2.0, 4.0]), (402, [1e200, 1e-200])]
    odd = [(500, None), (501, []), (502, [0.0] * 6), (503, [1.0, None, 0.0, 0.0]), (504, [float("nan")] * 6), (505, [float("inf")] + [0.0] * 5)]
    df = spark.createDataFrame([(*r, 1, 2) for r in sound + odd], "vec_id long, embedding array<double>, links int, root int")

    def cosine(x, y):
        x, y = np.array(x), np.array(y)
        x, y = x / np.abs(x).max(), y / np.abs(y).max()
        return x @ y / np.linalg.norm(x) / np.linalg.norm(y)

    n = len(sound)
    links = [(i, j) for i in range(n) for j in range(i) if len(sound[i][1]) == len(sound[j][1]) and cosine(sound[i][1], sound[j][1]) >= 0.9]
    best = smallest(range(n), links)
    count = Counter(x for p in links for x in p)
    low = defaultdict(list)
    for i in range(n):
        low[best[i]].append(sound[i][0])
    want = [(sound[i][0], count[i], min(low[best[i]])) for i in range(n)] + [(k, 0, k) for k, _ in odd]
    for pivots, block in ((None, 2048), (20, 4), (1, 7)):
        got = metric_join.near_vectors(df, pivots=pivots, block=block).collect()
        assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == sorted(want)
        assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
    assert metric_join.near_vectors(df.limit(0)).count() == 0


LONG = " ".join(f"word{i % 977}" for i in range(30_000))
PAGES = [
    (1, "u", None), (2, "u", ""), (3, "u", "<p>&lt;b&gt; &amp;amp;"), (4, None, "<article><p>a &eacute;\n\n b<p>c</article><footer>x</footer>"),
    (5, "u", "<body><article><h1>T<b>it</b>le</h1><p>one<br>two</p><script>var a='</p>';</script><style>p{}</style></article></body>"),
    (5, "u", "<<<>>><a <b></c>"), (None, "u", f"<article><p>{LONG}</p></article>"),
]


def test_pages_of_odd_rows(spark):
    pages = spark.createDataFrame([(*p, 1, 2) for p in PAGES], "page_id long, url string, html string, text int, row int")
    sample = "<html><head><title>t</title></head><body><nav><ul><li><a href='/'>go</a></li></ul></nav><article><h1>Some title</h1><p>Text of it, quite long.</p></article><footer>&copy; me</footer></body></html>"
    chain = html_text.fit_pages([sample] * 5, 200)
    got = [(r["page_id"], r["text"]) for r in html_text.extract(pages, chain).select("row.page_id", "text").collect()]
    found = dict(got)
    assert len(got) == len(PAGES) and found[1] == found[2] == ""
    assert found[4] == "a é b c" and found[None] == LONG
    assert any(t == "Title one two" for p, t in got if p == 5)
    assert html_text.extract(pages.limit(0), chain).count() == 0
    assert html_text.train(pages.limit(0)).decode([]) == []


def test_viterbi_is_the_best_labelling():
    from itertools import product

    rng = np.random.default_rng(2)
    chain = html_text.Chain({f"f{i}": float(w) for i, w in enumerate(rng.standard_normal(8))}, rng.standard_normal((2, 2)))
    for _ in range(30):
        page = [[f"f{k}" for k in rng.integers(0, 8, 3)] for _ in range(6)]

        def score(labels, page=page):
            own = sum(sum(chain.weights[f] for f in fs) * y for fs, y in zip(page, labels, strict=True))
            return own + sum(chain.moves[a, b] for a, b in zip(labels, labels[1:], strict=False))

        assert score(chain.decode(page)) == pytest.approx(max(map(score, product((0, 1), repeat=6))))


def test_layouts_not_trained_on():
    rng = random.Random(77)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta."]) for _ in range(rng.randint(3, 40))) for _ in range(200)]
    chain = html_text.fit_pages([f"<body><article><p>{t}</p></article></body>" for t in texts[:50]])
    wrong = total = 0
    for _ in range(150):
        blocks = html_text.leaf_blocks(html_text.LayoutPage(texts, rng).html())
        labels = chain.decode([f for _, f, _ in blocks])
        wrong += sum(y != (x == "1") for y, (_, _, x) in zip(labels, blocks, strict=True))
        total += len(blocks)
    assert wrong < 0.02 * total


def test_chat_layouts(spark):
    both = [("user", "hi <|end|> &lt; [x]"), ("assistant", "yes\n</s>")]
    said = "array<struct<role:string,content:string>>"
    frames = [
        spark.createDataFrame([(1, i, r, t, 9) for i, (r, t) in enumerate(both)][::-1], "conv_id long, turn int, role string, text string, other int"),
        spark.createDataFrame([(1, both)], f"conv_id long, messages {said}"),
        spark.createDataFrame([(1, [("human", both[0][1]), ("gpt", both[1][1])])], "conv_id long, conversations array<struct<from:string,value:string>>"),
        *(
            spark.createDataFrame([(1, both[0][1], both[1][1])], f"conv_id long, {a} string, {b} string")
            for a, b in (("prompt", "response"), ("prompt", "completion"), ("question", "answer"), ("instruction", "output"))
        ),
    ]
    rows = [chat.digests(chat.format_turns(chat.canonical_turns(f))).collect() for f in frames]
    assert all(r == rows[0] for r in rows) and len(rows[0]) == 1 and rows[0][0]["loss_chars"] == 8
    mixed = frames[1].unionByName(frames[3].withColumn("conv_id", F.lit(2).cast("long")), allowMissingColumns=True)
    got = chat.digests(chat.format_turns(chat.canonical_turns(mixed))).collect()
    assert len(got) == 2 and len({tuple(r)[1:] for r in got} | {tuple(rows[0][0])[1:]}) == 1
    with pytest.raises(ValueError, match="no layout"):
        chat.canonical_turns(frames[3].drop("prompt"))


SAID = "array<struct<role:string,content:string>>"
COLUMN_TYPES = {"turn": "int", "messages": SAID, "conversations": "array<struct<from:string,value:string>>"}
VALUES = {"turn": 0, "role": "user", "messages": [("user", "m")], "conversations": [("human", "c")]}


def layout_columns(layout):
    return list(dict.fromkeys(chat._column(p) for p in layout.paths))


def one_record(spark, columns, **values):
    row = {c: VALUES.get(c, f"the {c}") for c in columns} | values
    schema = ", ".join(f"{c} {COLUMN_TYPES.get(c, 'string')}" for c in columns)
    return spark.createDataFrame([(1, *(row[c] for c in columns))], f"conv_id long, {schema}")


@pytest.mark.parametrize("key", chat.LAYOUTS)
def test_every_layout_beside_the_fields_of_every_other(spark, key):
    """Fields of other layouts, filled or null, never stop a table; null ones change nothing."""
    mine = layout_columns(chat.LAYOUTS[key])
    want = chat.canonical_turns(one_record(spark, mine)).collect()
    for other in chat.LAYOUTS.values():
        extra = [c for c in layout_columns(other) if c not in mine]
        if not extra:
            continue
        both = [*extra, *mine]
        got = chat.canonical_turns(one_record(spark, both, **dict.fromkeys(extra)))
        covers = {*both} == {*layout_columns(other)}  # then the table is one of that layout
        found = [r for r in got.collect() if r["text"]] if covers else got.collect()
        assert [r["text"] for r in found] == [r["text"] for r in want]
        filled = chat.canonical_turns(one_record(spark, both))
        assert filled.columns == ["conv_id", "turn", "role", "text"] and filled.count() >= 1


def test_nulls_beside_fields_of_other_layouts(spark):
    texts = lambda df: [r["text"] for r in chat.canonical_turns(df).orderBy("turn").collect()]
    rows = ["turn", "role", "text"]
    for extra in ("system", "content", "input", "prompt"):
        for value in (None, "x"):
            assert texts(one_record(spark, [*rows, extra], **{extra: value})) == ["the text"]
    assert texts(one_record(spark, [*rows, "input"], input=None, text=None)) == [""]
    union = ["messages", "prompt", "response"]
    assert texts(one_record(spark, union, messages=None, response=None)) == ["the prompt", ""]
    assert texts(one_record(spark, union, messages=None, prompt=None)) == ["", "the response"]
    assert texts(one_record(spark, union, prompt=None, response=None)) == ["m"]
    assert texts(one_record(spark, union, messages=None, prompt=None, response=None)) == []
    assert chat.canonical_turns(one_record(spark, union).limit(0)).count() == 0


def test_names_in_other_case_and_nested_extras(spark):
    twice = spark.createDataFrame([(1, 0, "user", "no", "yes")], "conv_id long, turn int, role string, Text string, text string")
    assert chat.canonical_turns(twice).first()["text"] == "yes"
    upper = spark.createDataFrame([(1, "p", "r")], "Conv_ID long, PROMPT string, Response string")
    assert [r["text"] for r in chat.canonical_turns(upper).collect()] == ["p", "r"]
    wide = spark.createDataFrame([(1, [("user", "hello", 0.5)], "x")], "conv_id long, messages array<struct<role:string,content:string,weight:double>>, `a.b` string")
    assert [tuple(r) for r in chat.canonical_turns(wide).collect()] == [(1, 0, "user", "hello")]
    plain = spark.createDataFrame([(1, 0, "user", "t", "not an array")], "conv_id long, turn int, role string, text string, messages string")
    assert chat.canonical_turns(plain).first()["text"] == "t"


def test_chat_of_odd_rows(spark):
    rows = [(1, 1, "assistant", None), (1, None, None, "x"), (1, 1, "assistant", None), (None, 0, "user", "&amp;lt; &lsqb;"), (2, 0, "user", LONG), (3, 0, "<|said|>", "<|turn|><|said|><|end|>"), (4, 0, "assistant", "é\U0001f600" * 3)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = chat.format_turns(turns)
    back = formatted.select("conv_id", chat.parse_formatted(F.col("formatted")).alias("t")).collect()
    found = {r["conv_id"]: [tuple(t) for t in r["t"]] for r in back}
    assert found[1] == [("", "x"), ("assistant", ""), ("assistant", "")] and found[None] == [("user", "&amp;lt; &lsqb;")]
    assert found[2] == [("user", LONG)] and found[3] == [("<|said|>", "<|turn|><|said|><|end|>")]
    digests = {r["conv_id"]: r for r in chat.digests(formatted).collect()}
    assert digests[4]["loss_chars"] == 6 and digests[1]["loss_chars"] == 0 and digests[1]["n_turns"] == 3
    assert chat.digests(chat.format_turns(turns.limit(0))).count() == 0


# --- training of the chain over blocks


def brute_loss(chain, pages):
    """Penalised negative log-likelihood a page, over all labellings of every page."""
    w, moves, loss = chain.weights, chain.moves, 0.0
    for page in pages:
        own = [sum(w[f] for f in fs) for fs, _ in page]

        def score(ys, own=own):
            return sum(o for o, y in zip(own, ys, strict=True) if y) + sum(moves[a, b] for a, b in zip(ys, ys[1:], strict=False))

        scores = [score(ys) for ys in itertools.product((0, 1), repeat=len(page))]
        loss += np.logaddexp.reduce(scores) - score([y for _, y in page])
    return loss / len(pages) + html_text.RIDGE / 2 * (sum(x * x for x in w.values()) + (moves**2).sum())


def test_training_ends_where_the_likelihood_is_highest(monkeypatch):
    monkeypatch.setattr(html_text, "RATE", 0.002)  # small steps, to end near the top
    rng = random.Random(8)
    pages = [[(["bias", *rng.sample("abcd", rng.randint(0, 3))], rng.randint(0, 1)) for _ in range(rng.randint(1, 7))] for _ in range(12)]
    chain = html_text.train_chain([[], *pages], 30_000)
    for f in chain.weights:
        ends = [brute_loss(html_text.Chain(chain.weights | {f: chain.weights[f] + d}, chain.moves), pages) for d in (1e-4, -1e-4)]
        assert abs(ends[0] - ends[1]) / 2e-4 < 1e-4
    for place in itertools.product((0, 1), repeat=2):
        step = np.zeros((2, 2))
        step[place] = 1e-4
        ends = [brute_loss(html_text.Chain(chain.weights, chain.moves + d * step), pages) for d in (1, -1)]
        assert abs(ends[0] - ends[1]) / 2e-4 < 1e-4


def test_the_end_of_a_long_page_is_learnt():
    page = [(["bias", "early"], 1)] * 700 + [(["bias", "late"], 0)] * 300
    chain = html_text.train_chain([page] * 3)
    assert chain.decode([["bias", "early"]] * 700 + [["bias", "late"]] * 300) == [1] * 700 + [0] * 300
    assert html_text.train_chain([]).decode([["bias"]]) == [0]


def test_many_features_take_memory_by_block():
    def page(i):
        names = "".join(f'<p class="n{chr(97 + k % 26)}{chr(97 + k // 26)}{chr(97 + i % 26)}{chr(97 + i // 26)}">word</p>' for k in range(120))
        return f"<body><article>{names}</article></body>"

    tracemalloc.start()
    chain = html_text.fit_pages([page(i) for i in range(150)], 50)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(chain.weights) > 10_000 and most < 500e6


def test_deep_pages_are_read_in_linear_time():
    html = "".join(f"<div>t{i}" for i in range(8000)) + "</p></b>" * 8000
    before = time.process_time()
    assert len(html_text.leaf_blocks(html)) == 8000
    assert time.process_time() - before < 2
