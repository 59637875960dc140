"""Toxicity: maximum-scoring segment search over token log-odds.

`fit` learns, from a bounded sample of labelled documents, each token's log-odds of standing in a toxic rather than a clean
document, with an informative Dirichlet prior proportional to the token's frequency in both. What is counted, for tokens
and totals alike, is different contexts (the words before and after), as the words of a text that was copied often would
else pass for toxic. Log-odds of either sign count where they are MIN_Z deviations from zero; other tokens have none. All
tokens' scores are lowered by one amount so that a clean text's walk falls by MIN_FALL a token on average, as extreme-value
statistics need. `segments` finds every maximal-scoring segment of a text in one scan (Ruzzo and Tompa). A segment's
significance is its E-value (Karlin and Altschul): lambda and K are fitted to the clean sample, E = K n exp(-lambda s). A
document's score is a logistic function, fitted on the sample, of its significant segments' evidence.

Only words enter a score: labels, language, source and doc_id never do. The sample is the `fit_rows` training labels with
the smallest hash of doc_id (a documented bound for fitting; every document is scored); it is read once and written to the
shared folder for the passes over it, and the model holds no more tokens than stand MIN_COUNT times in it. Labels that are
null, or that name no document, are left out; a doc_id labelled twice takes the larger label, and labels count as 0 or 1.
Without labels of both kinds nothing is toxic (score 0). Null and empty texts hold no segment and take the score of a text
without toxic words. Repeated rows give one row each, an empty table gives an empty result. Columns other than doc_id, text,
toxic are ignored. Very long texts are scanned whole, in time linear in their words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loopweaver.llm.common import rows_where, stash, table, trimmed, unstash, whole_rows

#: Labelled rows that the classifier is fitted on, at most.
FIT_ROWS = 20_000
#: Weight of the Dirichlet prior, as a share of all contexts counted.
PRIOR = 0.1
MIN_Z, MIN_COUNT = 2.5, 4
#: Least fall of a clean text's walk, per token on average.
MIN_FALL = 0.15
#: E-value under which a segment is significant.
MAX_E = 0.1
FOLDS = 5

_WORD = bytes(c if c in b"abcdefghijklmnopqrstuvwxyz'" or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


@dataclass
class Model:
    """What scoring needs. odds: log-odds of the tokens that have some; drift: what every token's score is raised by (below
    zero)."""

    odds: dict[bytes, float]
    drift: float = -MIN_FALL
    lam: float = 1.0
    k: float = 0.1
    weights: tuple[float, ...] = (-20.0, 0.0, 0.0)


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased words without ASCII punctuation."""
    return (text or "").encode().translate(_WORD).split()


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, end, score) of a walk, given each token's score.

    Linear: each candidate holds the walk's height before and after it, and merges with the nearest earlier candidate that
    starts lower when that one ends lower too.
    """
    out: list[tuple[int, int, float, float, int]] = []  # start, end, height before, height after, nearest candidate that starts lower
    up = np.flatnonzero(scores > 0)
    height = np.cumsum(scores)
    for i, high, gain in zip(up.tolist(), height[up].tolist(), scores[up].tolist(), strict=True):
        start, low = i, high - gain
        while True:
            j = len(out) - 1
            while j >= 0 and out[j][2] >= low:
                j = out[j][4]
            if j < 0 or out[j][3] >= high:
                out.append((start, i + 1, low, high, j))
                break
            start, low = out[j][0], out[j][2]
            del out[j:]
    return [(a, b, high - low) for a, b, low, high, _ in out]


def passages(model: Model, text: str | None) -> tuple[int, list[tuple[int, int, float]]]:
    """Number of a text's tokens and its segments, in token positions."""
    words = tokens(text)
    get = model.odds.get
    return len(words), segments(np.fromiter((get(w, 0.0) for w in words), float, len(words)) + model.drift)


def evidence(model: Model, n: int, found: list[tuple[int, int, float]]) -> tuple[float, float]:
    """Of a text of n tokens: minus the log of the best segment's E-value, and the sum over its significant segments."""
    best, total, worst = 0.0, 0.0, math.log(MAX_E)
    for _, _, s in found:
        e = math.log(model.k * max(n, 1)) - model.lam * s
        best = max(best, -e)
        if e <= worst:
            total -= e
    return best, total


def probability(model: Model, n: int, found: list[tuple[int, int, float]]) -> float:
    b, t = evidence(model, n, found)
    w = model.weights
    z = w[0] + w[1] * math.log1p(b) + w[2] * math.log1p(t)
    return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


def fold(doc_id) -> F.Column:
    """crc32 of doc_id as text, modulo the number of folds; fold 0 is held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def fit(documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """The model from at most fit_rows training labels."""
    spark = documents.sparkSession
    d = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic is not null")
    picked = d.where(fold(F.col("doc_id")) != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    chosen = spark.createDataFrame([tuple(r) for r in picked.collect()], "doc_id bigint, toxic int")  # bounded by fit_rows, 12 bytes a row
    texts = stash(documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("doc_id is not null").join(F.broadcast(chosen), "doc_id").select("toxic", "text"), "toxic-sample")
    contexts = texts.mapInArrow(trimmed(_contexts), "toxic int, word binary, context bigint").distinct()
    counts = stash(contexts.groupBy("word").agg(*(F.count_if(F.col("toxic") == k).alias(f"c{k}") for k in (0, 1))), "toxic-words")
    n0, n1 = (float(x or 0) for x in counts.agg(F.sum("c0"), F.sum("c1")).first())
    model = Model({})
    if n0 and n1:
        found = log_odds(counts, n1, n0).collect()  # tokens of the sample with MIN_COUNT contexts or more
        model.odds = {bytes(r["word"]): float(r["odds"]) for r in found}
        model.drift = -max(0.0, sum(r["odds"] * r["c0"] for r in found) / n0 + MIN_FALL)
        rows = texts.mapInArrow(lambda batches: _walks(model, batches), "toxic int, n bigint, segments array<double>").collect()  # at most fit_rows
        model = calibrate(model, [(int(r[0]), int(r[1]), list(r[2])) for r in rows])
    unstash(texts)
    unstash(counts)
    return model


def log_odds(counts: DataFrame, n1: float, n0: float) -> DataFrame:
    """word, c0 and odds of the words whose log-odds are clearly not zero. counts: c1 and c0 of each word, of n1 and n0 in all."""
    prior, all_prior = PRIOR * (F.col("c1") + F.col("c0")), PRIOR * (n1 + n0)
    odds = lambda c, n: F.log((c + prior) / (F.lit(n + all_prior) - c - prior))
    seen = counts.where(F.col("c1") + F.col("c0") >= MIN_COUNT).select("word", "c0", (odds(F.col("c1"), n1) - odds(F.col("c0"), n0)).alias("odds"), F.sqrt(1 / (F.col("c1") + prior) + 1 / (F.col("c0") + prior)).alias("sd"))
    return seen.where(F.abs("odds") >= MIN_Z * F.col("sd")).select("word", "c0", "odds")


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different contexts in which each word stands, by label."""
    import xxhash

    def emit(seen: set) -> pa.RecordBatch:
        cols = list(zip(*seen, strict=True)) or [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int32(), pa.binary(), pa.int64()), strict=True)], names=["toxic", "word", "context"])

    seen: set = set()
    for b in batches:
        for t, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            w = [b"", *tokens(text.as_py()), b""]
            seen.update((min(1, max(0, t)), x, xxhash.xxh64_intdigest(w[i] + b" " + w[i + 2]) - 2**63) for i, x in enumerate(w[1:-1]))
            if len(seen) >= 50_000:  # what repeats beyond that meets in the shuffle
                yield emit(seen)
                seen = set()
    yield emit(seen)


def _walks(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [passages(model, t.as_py()) for t in b.column(1)]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([n for n, _ in rows], pa.int64()), pa.array([[s for *_, s in f] for _, f in rows], pa.list_(pa.float64()))], names=["toxic", "n", "segments"])


def calibrate(model: Model, rows: list[tuple[int, int, list[float]]]) -> Model:
    """lambda and K from the clean rows' best segments, then the logistic weights from all rows."""
    clean = [(n, max(s)) for t, n, s in rows if not t and s]
    n_clean = sum(1 for t, *_ in rows if not t)
    if clean and n_clean:
        # Best scores of clean texts over the least one fall off as exp(-lambda s): lambda by maximum likelihood.
        s = np.array([x for _, x in clean])
        low = s.min()
        model.lam = float(min(20.0, 1 / max(1e-3, (s - low).mean())) if len(s) > 1 else 1.0)
        # K so that the expected number of such segments in all clean texts is what was seen.
        length = sum(n for t, n, _ in rows if not t)
        model.k = float(len(clean) / max(1.0, length) * math.exp(min(50.0, model.lam * low)))
    else:
        model.lam, model.k = 1.0, 1e-4
    x, y = [], []
    for t, n, s in rows:
        b, total = evidence(model, n, [(0, 0, v) for v in s])
        x.append((1.0, math.log1p(b), math.log1p(total)))
        y.append(min(1, max(0, t)))
    a, y = np.array(x), np.array(y, float)
    w, ridge = np.zeros(a.shape[1]), np.diag([1e-6, 1e-2, 1e-2])
    for _ in range(50):  # Newton steps of ridge logistic regression
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + ridge, a.T @ (y - p) - ridge @ w)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    model.weights = tuple(map(float, w))
    return model


def score(documents: DataFrame, model: Model) -> DataFrame:
    """Per document: score, number of significant passages, and the best one's token positions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for t in b.column(1):
                n, found = passages(model, t.as_py())
                good = [s for s in found if math.log(model.k * max(n, 1)) - model.lam * s[2] <= math.log(MAX_E)]
                top = max(good, key=lambda s: s[2], default=(None, None, None))
                out.append((probability(model, n, found) if model.odds else 0.0, len(good), top[0], top[1]))
            cols = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cols[0], pa.float64()), *(pa.array(c, pa.int64()) for c in cols[1:])], names=["doc_id", "score", "n_passages", "passage_start", "passage_end"])

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(trimmed(run), "doc_id bigint, score double, n_passages bigint, passage_start bigint, passage_end bigint")


def clean_rows(documents: DataFrame, model: Model) -> DataFrame:
    """The rows of documents that score below 0.5, each judged by its own text."""
    return rows_where(documents.select(whole_rows(documents)), lambda texts: [not model.odds or probability(model, *passages(model, t.as_py())) < 0.5 for t in texts])


def op3_toxic_passages(spark, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    scored = score(documents, fit(documents, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (F.coalesce(fold(F.col("doc_id")), F.lit(1)) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_passages", "passage_start", "passage_end")
