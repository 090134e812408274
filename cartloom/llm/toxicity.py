"""Toxicity: a convolutional text classifier over hashed word embeddings.

A word's embedding is the sum of hashed rows for the word and for its first letters, so
inflected forms share what they begin with. Filters of several widths slide over the
words, each filter's largest response is pooled, and a logistic layer weighs them.
It is trained here, in numpy, on a bounded sample of labelled rows, then thresholds are
calibrated by language: the language is told from the text's own function words, and a
score of 0.5 is that language's threshold.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.llm.common import first_by_hash, table

ROWS, DIM = 1 << 20, 8  # hashed embedding rows and their length
STARTS = (3, 4, 5, 7)  # letters of a word's beginning that are hashed besides the word
WIDTHS, FILTERS = (1, 2, 3), 8
PER_CLASS = 1500  # most labelled rows of either class to learn from, toxic ones
CLEAN_SHARE = 2  # clean rows for each toxic one, at most
CALIBRATE = 5  # one in so many of the sampled rows sets thresholds instead
EPOCHS, RATE, DECAY = 8, 0.08, 1e-4
FOLDS = 5  # fixed value: rows of fold 0 are held out
CHUNK = 65_536  # words convolved at once
KNOWN = 300_000  # words a task remembers
FEWEST = 15  # rows of a class that a language's own threshold needs

# Frequent function words that tell the languages apart.
FUNCTION_WORDS = {
    "en": ("the", "of", "and", "to", "is", "that", "for", "was", "with"),
    "de": ("der", "die", "und", "das", "ist", "nicht", "ein", "zu", "von"),
    "fr": ("le", "les", "et", "des", "est", "une", "du", "dans", "pour", "qui"),
    "es": ("el", "los", "las", "y", "del", "por", "con", "una", "para", "se"),
}
LANGUAGE = {w.encode(): k for k, words in enumerate(FUNCTION_WORDS.values()) for w in words}
OTHER = len(FUNCTION_WORDS)
MARKS = b".,;:!?\"'()[]{}*#$%&|<>-_~"


def words_of(text: str | None) -> list[bytes]:
    return [w for w in (x.strip(MARKS) for x in (text or "").lower().encode().split()) if w]


def language(words: list[bytes]) -> int:
    counts = np.zeros(OTHER + 1, int)
    for w in words:
        k = LANGUAGE.get(w)
        if k is not None:
            counts[k] += 1
    return int(counts.argmax()) if counts.any() else OTHER


def hashed(word: bytes) -> list[int]:
    """Rows of the word and its beginnings; a shorter word repeats its own row of zeros."""
    letters = word.decode(errors="ignore")
    rows = [1 + zlib.crc32(word + b"$") % (ROWS - 1)]
    for n in STARTS:
        start = letters[:n].encode() + b"^"
        rows.append(1 + zlib.crc32(start) % (ROWS - 1) if len(letters) >= n else 0)
    return rows


class Net:
    """Embeddings, filters per width, and the logistic layer."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.rows = (0.02 * rng.standard_normal((ROWS, DIM))).astype(np.float32)
        self.rows[0] = 0
        self.filters = [
            (rng.standard_normal((w * DIM, FILTERS)) / np.sqrt(w * DIM)).astype(np.float32)
            for w in WIDTHS
        ]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = (0.5 * rng.standard_normal(len(WIDTHS) * FILTERS)).astype(np.float32)
        self.base = 0.0
        self.threshold = np.zeros(OTHER + 1)

    def pooled(self, vectors: np.ndarray, places: bool = False):
        """Largest response of every filter (at least 0), and where; over the words in chunks."""
        best, where = [], []
        for width, filters, bias in zip(WIDTHS, self.filters, self.bias, strict=True):
            top, at = np.zeros(FILTERS, np.float32), np.full(FILTERS, -1)
            for start in range(0, len(vectors) - width + 1, CHUNK):
                part = vectors[start : start + CHUNK + width - 1]
                n = len(part) - width + 1
                windows = np.concatenate([part[j : j + n] for j in range(width)], axis=1)
                response = windows @ filters + bias
                peak = response.max(axis=0)
                if places:
                    at = np.where(peak > top, start + response.argmax(axis=0), at)
                top = np.maximum(top, peak)
            best.append(top)
            where.append(at)
        return np.concatenate(best), where

    def logit(self, vectors: np.ndarray) -> float:
        return float(self.pooled(vectors)[0] @ self.out + self.base)


def _train(net: Net, docs: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> None:
    """Logistic loss, classes weighed alike, by AdaGrad. A doc is its words' hashed rows."""
    rng = np.random.default_rng(seed)
    toxic = labels.sum()
    weight = len(labels) / 2 / np.where(labels == 1, max(1, toxic), max(1, len(labels) - toxic))
    seen_rows = np.full((ROWS, 1), 1e-2, np.float32)
    seen = [np.full_like(f, 1e-1) for f in net.filters]
    seen_bias = [np.full_like(b, 1e-1) for b in net.bias]
    seen_out, seen_base = np.full_like(net.out, 1e-1), 1e-1
    for _ in range(EPOCHS):
        for i in rng.permutation(len(docs)):
            rows = docs[i]
            vectors = net.rows[rows].sum(axis=1) if len(rows) else np.zeros((0, DIM), np.float32)
            pooled, where = net.pooled(vectors, places=True)
            z = float(pooled @ net.out + net.base)
            slope = weight[i] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[i])
            if abs(slope) < 1e-3:
                continue
            back = slope * net.out
            step = slope * pooled + DECAY * net.out
            seen_out += step**2
            net.out -= RATE * step / np.sqrt(seen_out)
            seen_base += slope**2
            net.base -= RATE * slope / np.sqrt(seen_base)
            for k, width in enumerate(WIDTHS):
                for f in np.flatnonzero(where[k] >= 0):
                    g, at = back[k * FILTERS + f], where[k][f]
                    window = vectors[at : at + width].ravel()
                    into = (g * net.filters[k][:, f]).reshape(width, DIM)
                    step = g * window + DECAY * net.filters[k][:, f]
                    seen[k][:, f] += step**2
                    net.filters[k][:, f] -= RATE * step / np.sqrt(seen[k][:, f])
                    seen_bias[k][f] += g**2
                    net.bias[k][f] -= RATE * g / np.sqrt(seen_bias[k][f])
                    for j in range(width):
                        own = rows[at + j][rows[at + j] > 0]
                        seen_rows[own] += (into[j] ** 2).mean()
                        net.rows[own] -= RATE * into[j] / np.sqrt(seen_rows[own])
    # Rows no sampled text has hold noise only.
    used = np.zeros(ROWS, bool)
    for rows in docs:
        used[rows.ravel()] = True
    used[0] = False
    net.rows[~used] = 0


def _best_threshold(logits: np.ndarray, labels: np.ndarray) -> float:
    """The logit between neighbours with the best recalls, that of clean rows counting twice."""
    order = np.argsort(logits)
    logits, labels = logits[order], labels[order]
    below = np.concatenate([[0], np.cumsum(labels == 0)]) / max(1, (labels == 0).sum())
    above = 1 - np.concatenate([[0], np.cumsum(labels == 1)]) / max(1, (labels == 1).sum())
    edges = np.concatenate([[logits[0] - 1], (logits[1:] + logits[:-1]) / 2, [logits[-1] + 1]])
    good = 2 * below + above
    best = np.flatnonzero(good >= good.max() - 1e-12)
    return float(edges[best].mean()) if len(best) else 0.0


def fit(sample: list[tuple[str, int]]) -> Net:
    """A net from (text, label) rows. Every CALIBRATE-th row of a class sets thresholds."""
    net, known = Net(), {}
    docs, labels, tongues, turn, spared = [], [], [], [0, 0], []
    for text, label in sample:
        words = words_of(text)
        rows = [known[w] if w in known else known.setdefault(w, hashed(w)) for w in words]
        docs.append(np.array(rows, np.int64).reshape(-1, 1 + len(STARTS)))
        labels.append(label)
        tongues.append(language(words))
        turn[label] += 1
        spared.append(turn[label] % CALIBRATE == 0)
    labels, tongues, spared = np.array(labels, int), np.array(tongues, int), np.array(spared, bool)
    if not 0 < labels.sum() < len(labels):  # nothing to tell apart
        net.out[:] = 0
        net.base = -1.0 if not labels.sum() else 1.0
        return net
    learn = np.flatnonzero(~spared)
    _train(net, [docs[i] for i in learn], labels[learn])
    # With few rows, thresholds are set on all of them.
    test = np.flatnonzero(spared) if (labels[spared] == 1).sum() >= FEWEST else np.arange(len(docs))
    logits = np.array([net.logit(net.rows[docs[i]].sum(axis=1)) for i in test])
    overall = _best_threshold(logits, labels[test])
    for k in range(OTHER + 1):
        mine = tongues[test] == k
        own = labels[test][mine]
        enough = min((own == 1).sum(), (own == 0).sum()) >= FEWEST
        net.threshold[k] = _best_threshold(logits[mine], own) if enough else overall
    return net


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(FOLDS))


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Net:
    """A net from labelled rows outside fold 0: the first of each class by a hash of doc_id,
    at most per_class toxic ones and CLEAN_SHARE as many clean ones."""
    marked = labels.filter("toxic IN (0, 1)").select("doc_id", F.col("toxic").cast("int"))
    usable = marked.filter(fold(F.col("doc_id")) != 0)
    toxic = first_by_hash(usable.filter("toxic = 1"), "doc_id", per_class)
    clean = first_by_hash(usable.filter("toxic = 0"), "doc_id", CLEAN_SHARE * per_class)
    chosen = toxic.unionAll(clean)
    rows = docs.select("doc_id", F.col("text").cast("string")).join(F.broadcast(chosen), "doc_id")
    order = (F.xxhash64("doc_id"), "doc_id", "toxic", "text")
    sample = rows.orderBy(*order).limit((1 + CLEAN_SHARE) * per_class).collect()
    return fit([(r["text"], r["toxic"]) for r in sample])


def scorer(spark, net: Net):
    """A column function: text to a score from 0 to 1; null and empty texts get one too."""
    model = spark.sparkContext.broadcast(net)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        net, known, table = model.value, {}, np.zeros((KNOWN + 1, DIM), np.float32)
        for batch in texts:
            out = []
            for text in batch:
                words = words_of(text)
                rows = list(map(known.get, words))
                if None in rows:
                    new = list({w for w, r in zip(words, rows, strict=True) if r is None})
                    if len(known) + len(new) > KNOWN:
                        known.clear()
                        new = list(set(words))
                    if len(new) > KNOWN:  # a text of so many words is looked up alone
                        vectors = np.array([net.rows[hashed(w)].sum(axis=0) for w in words])
                        out.append(net.logit(vectors) - net.threshold[language(words)])
                        continue
                    begin = len(known)
                    known.update(zip(new, range(begin, begin + len(new)), strict=True))
                    own = np.array([hashed(w) for w in new])
                    table[begin : begin + len(new)] = net.rows[own].sum(axis=1)
                    rows = [known[w] for w in words]
                vectors = table[np.array(rows, np.int64)]
                out.append(net.logit(vectors) - net.threshold[language(words)])
            logits = np.clip(np.array(out, np.float64), -500, 500)
            yield pd.Series(1 / (1 + np.exp(-logits)))

    return score


def scored(docs: DataFrame, net: Net) -> DataFrame:
    """docs(doc_id, text, ...) as (row, score): row holds all columns of docs.

    A score depends on the whole text alone; repeated rows score alike.
    """
    score = scorer(docs.sparkSession, net)
    return docs.select(F.struct("*").alias("row"), score(F.col("text").cast("string")).alias("score"))


def op1_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    net = train(docs, table(spark, sf_dir, "labels"))
    score = scorer(spark, net)
    rows = docs.select("doc_id", score(F.col("text").cast("string")).alias("score"))
    return rows.select(
        "doc_id",
        (fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_civil(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents predicted toxic go."""
    net = train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored(docs, net).filter("score < 0.5").select("row.*")
