"""What the operators must not leave out."""

from collections import Counter

from pyspark.sql import functions as F

import numpy as np
import pytest

from cartloom.llm import html_text, packing, quality, sharding
from cartloom.llm.tokens import Encoder, tokenizer_path
from cartloom.plans.staging import staged_folder

LICENCE = [" ".join(f"licence{k}word{i}" for i in range(7)) for k in range(10)]
TEXTS = "doc_id long, text string, source string"


def test_boilerplate_counts_by_document(spark):
    """Documents that share most of their lines are still as many documents."""
    rows = [(i, "\n".join([*LICENCE, f"own line of document {i}, unlike all the others"]), "h") for i in range(200)]
    rows += [(1000 + i, "\n".join(LICENCE), "copies") for i in range(60)]  # one document
    docs = spark.createDataFrame(rows, TEXTS)
    got = {r["doc_id"]: r for r in quality.judge(docs).collect()}
    assert not any(r["base_failed"] for r in got.values())
    assert not any(got[i]["kept"] for i in range(200)) and all(got[1000 + i]["kept"] for i in range(60))
    few = {r["kept"] for r in quality.judge(docs.filter("doc_id < 20")).collect()}
    assert few == {True}


def test_lines_above_the_limit_leave_the_text(spark):
    shared = "This line  stands on every page"
    own = [[f"Own{i}x{k} line " + " ".join(f"p{i}w{k}x{j}" for j in range(9)) for k in range(3)] for i in range(30)]
    rows = [(i, "\n".join([shared.upper() if i % 2 else shared, *o[:2], "", shared, o[2], ""]), "h", 7) for i, o in enumerate(own)]
    rows += [(100, "\n".join([*own[0], shared]), "other", 7), (101, "\n".join([*own[0], shared]), None, 7)]
    docs = spark.createDataFrame(rows, TEXTS + ", n_chars long")
    got = {r["doc_id"]: r for r in quality.keep_good(spark, docs, "").collect()}
    for i, o in enumerate(own):
        want = "\n".join([*o[:2], "", o[2], ""])
        assert (got[i]["text"], got[i]["n_chars"]) == (want, len(want))
    assert all(tuple(got[i]) == (i, rows[i - 70][1], rows[i - 70][2], 7) for i in (100, 101))


def test_short_lines_count(spark):
    menu = [f"menü {k} 主页{k}" for k in range(30)]
    rows = [(i, "\n".join([*menu, f"page {i}"]), "h") for i in range(40)]
    rows += [(100 + i, "\n".join([*menu, f"page {i}"]), "small") for i in range(20)]
    got = {r["doc_id"]: r for r in quality.judge(spark.createDataFrame(rows, TEXTS)).collect()}
    assert not any(r["base_failed"] for r in got.values())
    assert not any(got[i]["kept"] for i in range(40)) and all(got[100 + i]["kept"] for i in range(20))


@pytest.mark.parametrize("blank", [" ", "\n"])
def test_a_very_long_run_of_blanks_is_encoded(blank):
    encoder = Encoder(tokenizer_path())
    text = "a" + 1_500_000 * blank + "b"
    want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert encoder.ids(text) == np.array(want, "<u4").tobytes()
    assert len(encoder.ids("and on")) == 8  # goes on after a panic


def test_added_tokens_have_the_ids_of_the_file():
    from tokenizers import Tokenizer

    encoder, plain = Encoder(tokenizer_path()), Tokenizer.from_file(tokenizer_path())
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x  <|endoftext|>\n\n <|endoftext|><|endoftext|>é", "<|endoftext"]
    for compared in (0, 1 << 30):
        encoder.compared = compared
        for text in texts:
            want = plain.encode(text, add_special_tokens=False).ids
            assert encoder.ids(text) == np.array(want, "<u4").tobytes()
    assert encoder.ids(texts[0]) == np.array([64, 220, 50256, 275], "<u4").tobytes()


def test_shards_hold_the_documents(spark, odd, odd_rows, none, monkeypatch):
    monkeypatch.setattr(sharding, "TASK_BYTES", 500)
    folder = f"{staged_folder(spark)}/shards-of-odd-rows"
    slim = odd.select("doc_id", "text")
    sharding.write_shards(slim, folder, 4)
    rows = sharding.read_shards(spark, folder, "struct<doc_id: bigint>").collect()
    assert Counter((r["row"]["doc_id"], r["text"]) for r in rows) == Counter((d, t) for d, t, _, _ in odd_rows)
    placed = Counter((r["row"]["doc_id"], r["text"], r["shard"], r["slot"]) for r in sharding.shard(slim, 4).collect())
    assert placed == Counter((r["row"]["doc_id"], r["text"], r["shard"], r["slot"]) for r in rows)
    sharding.write_shards(none, f"{folder}-none", 4)
    assert sharding.read_shards(spark, f"{folder}-none", "struct<doc_id: bigint>").count() == 0


def test_large_groups_move_to_several_tasks(spark):
    texts = ["hot"] * 900 + [None] * 300 + [""] * 300 + [f"text {i}" for i in range(1500)]
    table = f"{staged_folder(spark)}/hot-texts"
    spark.createDataFrame([(i % 700, t) for i, t in enumerate(texts)], "doc_id long, text string").write.parquet(table)
    docs, folder = spark.read.parquet(table), f"{staged_folder(spark)}/hot-shards"
    row = sharding.write_shards(docs, folder, 6)
    rows = sharding.read_shards(spark, folder, row).collect()
    assert Counter((r["row"]["doc_id"], r["text"]) for r in rows) == Counter((i % 700, t) for i, t in enumerate(texts))
    homes = {}
    for r in rows:
        assert homes.setdefault(r["text"] or "", r["shard"]) == r["shard"]
    written = spark.read.parquet(folder).where("text = 'hot'").groupBy("_metadata.file_name").count().collect()
    assert len(written) > 10 and max(r["count"] for r in written) < 200
    again = sharding.shard(docs, 6).collect()
    assert Counter((r["row"], r["text"], r["shard"], r["slot"]) for r in again) == Counter(map(tuple, rows))


def test_driver_rows_do_not_grow_with_the_lanes(spark, monkeypatch):
    seen, into_shards = [], sharding.into_shards

    def counted(sizes, shards):
        seen.append(len(sizes))
        return into_shards(sizes, shards)

    monkeypatch.setattr(sharding, "into_shards", counted)
    monkeypatch.setattr(sharding, "MIN_LANES", 4)
    monkeypatch.setattr(sharding, "BLOCKS_PER_SHARD", 8)
    docs = spark.range(6000).selectExpr("id AS doc_id", "repeat('x', int(id % 13)) || id AS text").coalesce(1)
    held = []
    for groups in (1500, 150):  # groups of a lane: four lanes, then forty
        monkeypatch.setattr(sharding, "LANE_GROUPS", groups)
        rows = sharding.shard(docs, 5).collect()
        assert sorted(r["row"]["doc_id"] for r in rows) == list(range(6000))
        held.append(Counter())
        for r in rows:
            held[-1][r["shard"]] += r["size"]
    assert max(seen) <= 2 * 8 * 5 + 4
    assert all(max(h.values()) <= 1.02 * sum(h.values()) / 5 for h in held)


def test_sequences_hold_the_ids(spark, odd, odd_rows, none):
    folder = f"{staged_folder(spark)}/sequences-of-odd-rows"
    found = packing.written(odd, folder)
    whole = {r["sequence_id"]: bytes(r["ids"]) for r in found.collect()}
    assert max(map(len, whole.values())) <= 4 * packing.CAPACITY
    rows = packing.pack_documents(spark, odd, "").collect()
    encode = Encoder(tokenizer_path()).ids
    ids = {t: encode(t) + bytes(4) for _, t, _, _ in odd_rows}
    assert sum(map(len, whole.values())) == sum(len(ids[t]) for _, t, _, _ in odd_rows)
    parts = Counter((r["doc_id"], r["start"], bytes(r["ids"])) for r in rows)
    want = Counter()
    for d, t, _, _ in odd_rows:
        n = len(ids[t]) // 4
        cuts = [0, *range(n % 2048 or 2048, n + 1, 2048)]
        want.update((d, a, ids[t][4 * a : 4 * b]) for a, b in zip(cuts, cuts[1:], strict=False))
    assert parts == want
    assert packing.written(none, f"{folder}-none").count() == 0


@pytest.mark.parametrize(
    "html",
    [
        "<html><head><title>t</title><body><p>one<p>two</body></html>",
        "<html><head><title>t</title><meta name=a><p>one</p><div>two</div>",
        "<head><title>t</title></head><body><button>go<p>one</p><div>two</div></body>",
        "<body><select><option>x<option>y<div>one</div><p>two</p></body>",
        "<body><p>one</p><svg><title>x</title><p>no</p></svg><button>go</button><template><p>no</p></template><p>two</p>",
        "<head><noscript><p>no</p></noscript><title>t</title><body><p>one</p><p>two</p>",
        "<head><title>t</title>one<p>two",
        "<body><button><div>no</div></button><p>one</p><button>go<p>two</p></body>",
    ],
)
def test_hidden_elements_left_open_end(html):
    assert [text for text, _, _ in html_text.leaf_blocks(html)] == ["one", "two"]


@pytest.mark.parametrize("fill_tokens", [1, 3000, 1 << 30])
def test_sequences_of_lanes_of_any_size(spark, odd, odd_rows, fill_tokens):
    folder = f"{staged_folder(spark)}/sequences-{fill_tokens}"
    rows = packing.cut(packing.written(odd, folder, 300, fill_tokens), with_ids=True).collect()
    encode = Encoder(tokenizer_path()).ids
    want = Counter()
    for d, t, _, _ in odd_rows:
        ids = encode(t) + bytes(4)
        cuts = packing._cuts(len(ids) // 4, 300)
        want.update((d, k, ids[4 * a : 4 * b]) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)))
    assert Counter((r["doc_id"], r["piece"], bytes(r["ids"])) for r in rows) == want
    used = Counter()
    for r in rows:
        used[r["sequence_id"]] += r["length"]
    assert max(used.values()) <= 300
    whole = packing.best_fit(sorted((len(k[2]) // 4 for k in want.elements()), reverse=True), 300)[2]
    assert len(used) <= 1.02 * len(whole) + 2
    again = packing.cut(packing.written(odd, f"{folder}-again", 300, fill_tokens)).collect()
    assert {(r["sequence_id"], r["offset"], r["ids_crc32"]) for r in again} == {(r["sequence_id"], r["offset"], r["ids_crc32"]) for r in rows}
