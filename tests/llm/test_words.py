"""Spelling variants, periodic runs and language-model scores against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter
from pathlib import Path

import compare
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from test_llm_queries import SMALL, rows

from cartloom.llm import ngram_bloom, periodic, spelling
from cartloom.plans.staging import shared_folder

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return (text or "").encode().split()


# --- spelling variants


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    a, b = sorted((a, b), key=len)
    at = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def groups(counts, ratio=10):
    """What grouped() promises, by comparing all words with all."""
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = set()
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return out


def grouped(spark, counts, **options):
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    return spelling.grouped(words, **options)


def test_variants_of_dense_words(spark):
    rng = random.Random(5)
    counts = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 7))): rng.choice([1, 1, 2, 15, 300]) for _ in range(700)}
    got = [tuple(r) for r in grouped(spark, counts).collect()]
    assert len(got) == len(counts) and set(got) == groups(counts)


def test_variants_of_runs_of_one_letter_and_long_words(spark):
    rng = random.Random(6)
    long_word = "".join(rng.choice("abcdefgh") for _ in range(3000))
    counts = {"a" * n: 10 ** (n % 6) for n in range(1, 25)}
    counts |= {long_word: 50, long_word[:1700] + long_word[1701:]: 5, long_word[:-1]: 4, "x" + long_word: 500, long_word[:10] + "z" + long_word[11:]: 1}
    assert {tuple(r) for r in grouped(spark, counts).collect()} == groups(counts)


def test_roots_at_the_end_of_chains(spark):
    counts = {"lettering"[:9 - k]: 10 ** (3 + k) for k in range(5)} | {"apart": 7}
    got = {r["word"]: r["root"] for r in grouped(spark, counts).collect()}
    assert {w: r for w, r in got.items() if w != "apart"} == dict.fromkeys([w for w in counts if w != "apart"], "lette")
    assert got["apart"] == "apart"


def test_no_words(spark, odd, none):
    assert grouped(spark, {"alone": 1}).first() == ("alone", None, "alone", 1, 0, None)
    assert spelling.grouped(spelling.vocabulary(none, spelling.misspelt)).count() == 0


def test_vocabulary_of_odd_rows(odd, odd_rows, monkeypatch):
    monkeypatch.setattr(spelling, "HELD_WORDS", 5)
    want = Counter()
    for d, text, *_ in odd_rows:
        for run in spelling.re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{d}:{run}".encode())
            if h % 31 == 0 and d is not None:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            want[run] += 1
    got = {r["word"]: r["n"] for r in spelling.vocabulary(odd, spelling.misspelt).collect()}
    assert got == {w: n for w, n in want.items() if len(w) >= 7 and n >= 2}


# --- periodic runs


def brute_runs(w, min_words, min_exponent):
    found = {}
    for q in range(1, len(w) // min_exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(min_words, min_exponent * q):
                found.setdefault((i, j + q), q)  # the smallest period of a stretch comes first
            i = max(j, i + 1)
    return [
        (a, b - a, q)
        for (a, b), q in sorted(found.items(), key=lambda x: (x[0][0], x[1]))
        if not any(w[a : b - p] == w[a + p : b] for p in range(1, q))
    ]


@settings(max_examples=300, deadline=None)
@given(st.data())
def test_runs(data):
    w = data.draw(st.lists(st.integers(0, data.draw(st.integers(0, 3))), max_size=70))
    for _ in range(data.draw(st.integers(0, 3))):
        part = data.draw(st.lists(st.integers(0, 3), min_size=1, max_size=9))
        w += part * data.draw(st.integers(1, 6)) + part[: data.draw(st.integers(0, 8))]
    for least, exponent in ((24, 3), (4, 2), (9, 3), (1, 2)):
        got = periodic.runs(np.array(w, np.int64), least, exponent)
        assert [tuple(r) for r in got.tolist()] == brute_runs(w, least, exponent)


def test_common_extensions():
    rng = random.Random(1)
    s = [rng.randint(1, 2) for _ in range(300)] + [1] * 80
    tree = periodic.SuffixTree(s)
    i, j = np.array([(a, b) for a in range(len(s) + 1) for b in range(0, len(s) + 1, 7) if a != b]).T

    def brute(a, b):
        n = 0
        while max(a, b) + n < len(s) and s[a + n] == s[b + n]:
            n += 1
        return n

    assert tree.common(i, j).tolist() == [brute(a, b) for a, b in zip(i.tolist(), j.tolist(), strict=True)]


def digests(doc_id, text, change):
    w = words_of(text)
    if change and doc_id is not None and w:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        if h % 10 == 0:
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    found = brute_runs(w, 24, 3) if len(w) < 5000 else [tuple(r) for r in periodic.runs(np.unique(w, return_inverse=True)[1]).tolist()]
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    top = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    return (
        len(found),
        *(top or (None,) * 3),
        top and 1000 * top[1] // top[2],
        sha("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()),
        sha(b" ".join(x for i, x in enumerate(w) if i not in gone)),
    )


def test_op12(spark):
    docs = compare.connect(SMALL).execute("SELECT doc_id, text FROM documents").fetchall()
    got = {r["doc_id"]: r for r in rows(spark, "op12_periodic_runs")}
    names = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    assert len(got) == len(docs) and sum(r["n_runs"] > 0 for r in got.values()) > 10
    for d, text in docs:
        assert tuple(got[d][c] for c in names) == digests(d, text, True)


def test_runs_of_odd_rows(odd, odd_rows, none):
    got = Counter((r["doc_id"], len(r["runs"]), r["collapsed"]) for r in periodic.periodic_runs(odd).collect())
    assert got == Counter((d, 0, b" ".join(words_of(t)).decode()) for d, t, *_ in odd_rows)
    assert periodic.periodic_runs(none).count() == 0


def test_a_long_periodic_text(spark):
    rng = random.Random(2)
    part = [str(rng.randint(0, 40)) for _ in range(97)]
    text = " ".join(["before", *part * 200, *part[:5], "after"])
    docs = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    one, two = periodic.periodic_runs(docs).orderBy("doc_id").collect()
    assert [tuple(r) for r in one["runs"]] == [(1, 97 * 200 + 5, 97)] and two["runs"] == []
    assert one["collapsed"].split() == ["before", *part, "after"]


# --- language-model scores


def tokens(text):
    return [w.lower() for w in words_of(text)] + [None]


def model(docs):
    counts = Counter()
    for d, t in docs:
        if d is not None and zlib.crc32(str(d).encode()) % 7 != 2:
            counts.update(tokens(t))
    return counts


def check_base(got, docs):
    counts = model(docs)
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for d, t in docs:
        w = tokens(t)
        base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)
        held = d is None or zlib.crc32(str(d).encode()) % 7 == 2
        want[d, held, len(w), sum(counts[x] > 0 for x in w), n, round(base, 5)] += 1
    names = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")
    assert Counter((*(r[c] for c in names), round(r["base_score"], 5)) for r in got) == want


def test_op13(spark):
    docs = compare.connect(SMALL).execute("SELECT doc_id, text FROM documents").fetchall()
    got = rows(spark, "op13_lm_scoring")
    check_base(got, docs)
    held = [r for r in got if r["held_out"]]
    size = sum(r["n_tokens"] for r in held)
    assert sum(r["score"] for r in held) / size > sum(r["base_score"] for r in held) / size + 0.2


def exact_score(docs, text):
    """The same model with exact levels in place of the filter."""
    grams = Counter()
    for d, t in docs:
        if zlib.crc32(str(d).encode()) % 7 != 2:
            w = [0, *tokens(t)]
            grams.update((x,) for x in w)
            grams.update(zip(w, w[1:], strict=False))
    counts = model(docs)
    unit = 1 / (sum(counts.values()) + len(counts) + 1)
    level = lambda g: ngram_bloom.COUNTS[np.searchsorted(ngram_bloom.LEVELS, grams[g], side="right")]
    w, m, out = [0, *tokens(text)], ngram_bloom.SMOOTHING, 0.0
    for a, b in zip(w, w[1:], strict=False):
        p = (level((b,)) + 1) * unit
        out += math.log10((min(level((a, b)), level((a,))) + m * p) / (level((a,)) + m))
    return out


def test_scores_are_the_models_but_for_the_filters_errors(spark, monkeypatch):
    docs = compare.connect(SMALL).execute("SELECT doc_id, text FROM documents").fetchall()
    monkeypatch.setattr(ngram_bloom, "BITS", 60.0)  # hardly any error
    got = {r["doc_id"]: r["score"] for r in rows(spark, "op13_lm_scoring")}
    for d, t in docs[:60]:
        assert got[d] == pytest.approx(exact_score(docs, t), rel=1e-3)


def test_routed_scores_equal_broadcast_ones(spark, odd, odd_rows, monkeypatch):
    monkeypatch.setattr(ngram_bloom, "SEGMENT_TOKENS", 2000)
    monkeypatch.setattr(ngram_bloom, "PROBED_ROWS", 700)
    monkeypatch.setattr(ngram_bloom, "GROUP_TOKENS", 300)
    for order in (2, 3):
        one = [tuple(r) for r in ngram_bloom.score(odd, order).collect()]
        two = [tuple(r) for r in ngram_bloom.score(odd, order, broadcast_bytes=0).collect()]
        key = lambda r: (r[0] is None, *r[:1], *r[2:])
        for a, b in zip(sorted(one, key=key), sorted(two, key=key), strict=True):
            assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-12)
    check_base([dict(zip(("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"), r, strict=False)) for r in two], [r[:2] for r in odd_rows])


def test_routed_scores_take_less_than_four_times_the_input_on_disk(spark, tmp_path):
    rng = np.random.default_rng(5)
    kinds = ["".join(rng.choice(list("abcdefghijkl"), rng.integers(2, 8))) for _ in range(20_000)]
    at = np.minimum(rng.zipf(1.3, (1000, 400)), len(kinds)) - 1
    texts = [(i, " ".join(kinds[k] for k in row)) for i, row in enumerate(at.tolist())]
    spark.createDataFrame(texts, "doc_id long, text string").repartition(2).write.parquet(str(tmp_path / "docs"))
    folder = Path(shared_folder(spark).removeprefix("file:"))

    def sizes():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        shuffled = {Path(found.apply(i).getPath()) for i in range(found.size()) if found.apply(i).getName().startswith("shuffle")}
        return {f: f.stat().st_size for f in shuffled | {f for f in folder.rglob("*") if f.is_file()} if f.exists()}

    before = sizes()
    docs = spark.read.parquet(str(tmp_path / "docs"))
    assert ngram_bloom.score(docs, broadcast_bytes=0).agg({"score": "sum"}).first()[0] < 0
    taken = sum(size for f, size in sizes().items() if f not in before)
    assert taken < 4 * sum(f.stat().st_size for f in (tmp_path / "docs").glob("*.parquet"))


def test_a_longer_context_predicts_better(spark, odd):
    whole = lambda order: sum(r["score"] for r in ngram_bloom.score(odd, order).collect() if not r["held_out"])
    assert whole(1) < whole(2) < whole(3)


def test_no_training_rows(spark, none):
    assert ngram_bloom.score(none).count() == 0
    held = spark.createDataFrame([(d, "a b") for d in range(40) if zlib.crc32(str(d).encode()) % 7 == 2], "doc_id long, text string")
    for bound in (0, 1 << 20):
        got = ngram_bloom.score(held, broadcast_bytes=bound).collect()
        assert got and all(r["held_out"] and r["n_known"] == 0 and r["score"] == r["base_score"] == 0 for r in got)


def test_the_filter_is_never_too_low_and_seldom_too_high():
    rng = np.random.default_rng(0)
    key, strange = (rng.integers(0, 1 << 64, 20_000, dtype=np.uint64) for _ in range(2))
    level = rng.integers(1, 6, len(key))
    size = int(ngram_bloom.BITS * level.sum())
    bits = np.zeros(-(-size // 8) * 8, bool)
    for q in range(1, 6):
        for place in ngram_bloom._places(key[level >= q], q, size):
            bits[place.astype(np.int64)] = True
    held = ngram_bloom.Filter.of([(0, size, np.packbits(bits, bitorder="little").tobytes())], 1)
    found = held.levels(key)
    assert (found >= level).all() and (found > level).mean() < 0.05
    assert (held.levels(strange) > 0).mean() < 0.05


def test_levels_grow_by_their_base():
    got = ngram_bloom.LEVELS
    assert got[:6].tolist() == [1, 2, 3, 4, 5, 7] and (np.diff(got) > 0).all()
    assert (got[20:-1] * ngram_bloom.BASE * 1.01 >= got[21:]).all()
