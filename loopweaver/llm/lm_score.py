"""Stupid-backoff scores from corpus counts.

The count table of all n-grams up to ORDER is partitioned by hash (`count_table` gives it as rows). Rows of it would be
mostly n-grams that occur once, so for scoring they travel packed: documents are gathered into blocks of BLOCK_BYTES; a block explodes its n-grams, aggregates them and
sends each hash partition one packed run of its distinct hashes with their counts. A partition sums the runs of all blocks
into its share of the count table, joins the table to each run, and sends back a packed run of corpus counts in the same
order. This happens in ROUNDS, each for a range of the hashes, so that only a part of the requests is on disk at once.
The block, brought together with its answers, reads off every occurrence's counts and sums per document. An n-gram
reaches a partition once per block however common it is, partitions hold about PARTITION_GRAMS n-grams at any corpus
size. A run is sent only where a block has n-grams for a partition, so the number of runs never exceeds the blocks'
distinct n-grams and what is sent grows with these, however many partitions there are.

Scores leave the document itself out: its own occurrences are subtracted from the corpus counts, else no n-gram would ever
be unseen. For a word w after context c the score is count(c w) / count(c) if count(c w) > 0, else ALPHA times the score
after the context without its first word; for single words it is count(w) / N, with N the other documents' words, or
1 / (N + 1) if no other document holds w. log_score sums logs over a document's words.

Words are runs of bytes other than ASCII white space, lower-cased in A-Z. Null and empty texts have no words, a log_score
of 0 and a null mean. Repeated rows count as further documents, and each gives a row. An empty table gives an empty
result. Columns other than doc_id and text are ignored; texts are read whole. Words are told apart by hashes of 128 bits,
n-grams by a hash of HASH_BITS that orders them and a check hash of 32 bits more: at 30 GB, with about
2^34 n-grams, the chance that any two share both is about 2^-28.
"""

from __future__ import annotations

import contextlib
import functools
import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loopweaver.llm.common import stash, table, trimmed, unstash

ORDER, ALPHA = 3, 0.4
BLOCK_BYTES = 6 << 20
PARTITION_GRAMS = 3_000_000
#: Bits of the hash that orders n-grams; the check hash has 32 more.
HASH_BITS = 63
#: Ranges of hashes that are counted one after another.
ROUNDS = 2
_ODD = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def numbered(texts: list[bytes]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """The number of every word of the texts, one after another; the words by number; and each text's words."""
    ids: defaultdict[bytes, int] = defaultdict(count().__next__)
    found = []
    for t in texts:
        words = words_of(t)
        found.append(np.fromiter(map(ids.__getitem__, words), np.int32, len(words)))
    return np.concatenate([np.zeros(0, np.int32), *found]), list(ids), np.array([len(x) for x in found], np.int64)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """Two hashes of each word."""
    from xxhash import xxh3_128_digest

    return np.frombuffer(b"".join(map(xxh3_128_digest, words)), "<u8").reshape(-1, 2)


def gram_hashes(words: np.ndarray, doc: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Hashes and check hashes of all n-grams, orders one after another, and for each order the position of its n-grams' last words."""
    out: tuple[list[np.ndarray], list[np.ndarray]] = ([], [])
    at = []
    shorter = [np.zeros(len(doc), np.uint64) for _ in words]  # hashes of the n-grams one word shorter, by last word
    for n in range(1, ORDER + 1):
        last = np.arange(n - 1, len(doc))
        last = last[doc[last] == doc[last - (n - 1)]]
        for k, lane in enumerate(words):
            h = np.full(len(last), n, np.uint64) if n == 1 else shorter[k][last - 1]
            h = _mix(h * np.uint64(_ODD) + lane[last])
            if n < ORDER:
                shorter[k] = np.zeros(len(doc), np.uint64)
                shorter[k][last] = h
            out[k].append((h >> np.uint64(32)).astype(np.uint32) if k else h >> np.uint64(64 - bits))
        at.append(last)
    return np.concatenate(out[0]), np.concatenate(out[1]), at


def distinct(hashes: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by hash and check hash, and whether each n-gram in this order differs from the one before."""

    def differs(order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x, y = hashes[order], checks[order]
        other = np.ones(len(order), bool)
        other[1:] = x[1:] != x[:-1]
        new = other.copy()
        new[1:] |= y[1:] != y[:-1]
        return new, new & ~other

    order = np.argsort(hashes)
    new, shared = differs(order)
    if shared.any():  # different n-grams under one hash
        order = np.lexsort((checks, hashes))
        new = differs(order)[0]
    return order, new


def _inverse(order: np.ndarray, new: np.ndarray) -> np.ndarray:
    """For each n-gram its number among the distinct ones."""
    out = np.empty(len(order), np.int32)
    out[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    return out


@functools.cache
def _zstd():
    import zstandard

    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _squeeze(x: np.ndarray) -> bytes:
    """Non-negative numbers as planes of bytes, as many as the largest needs, compressed where that can pay."""
    width = max(1, -(-int(x.max()).bit_length() // 8)) if len(x) else 1
    planes = np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()
    return bytes([width]) + planes if len(x) < 256 else bytes([width + 8]) + _zstd()[0].compress(planes)


def _expand(raw: bytes) -> np.ndarray:
    width, planes = raw[0], raw[1:]
    if width > 8:
        width, planes = width - 8, _zstd()[1].decompress(planes)
    planes = np.frombuffer(planes, np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel()


def blocks(documents: DataFrame) -> DataFrame:
    """block, words and body: documents gathered as they are read; a body holds their ids and numbered words, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        ids: list[int | None] = []
        texts: list[bytes] = []
        size = 0

        def emit() -> pa.RecordBatch:
            import pickle

            import zstandard

            words, names, sizes = numbered(texts)
            body = pickle.dumps((ids, sizes, _squeeze(words), zstandard.ZstdCompressor(level=3).compress(b"\n".join(names))))
            return pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().hex]), pa.array([len(words)], pa.int64()), pa.array([body], pa.binary())], names=["block", "words", "body"])

        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                raw = (t.as_py() or "").encode()
                if texts and size + len(raw) > BLOCK_BYTES:
                    yield emit()
                    ids, texts, size = [], [], 0
                ids.append(i)
                texts.append(raw)
                size += len(raw)
        if ids:
            yield emit()

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(trimmed(run), "block string, words bigint, body binary")


def _open(body: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """A block's document ids, two hashes of every word, and the document each is in."""
    import pickle

    import zstandard

    ids, sizes, words, names = pickle.loads(body)
    hashes = word_hashes(zstandard.ZstdDecompressor().decompress(names).split(b"\n"))
    at = _expand(words).astype(np.int64)
    return ids, np.stack([hashes[at, k] for k in (0, 1)]), np.repeat(np.arange(len(ids)), sizes)


def _bounds(partitions: int, bits: int) -> np.ndarray:
    """Least hash of each partition and the end of the last."""
    return np.array([(i << bits) // partitions for i in range(partitions + 1)], np.uint64)


def requests(gathered: DataFrame, partitions: int, bits: int, parts: range) -> DataFrame:
    """block, part, hashes, checks and counts: a packed run of each block's distinct n-grams for each of these hash partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = _bounds(partitions, bits)[parts.start : parts.stop + 1]
        for b in batches:
            for block, body in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                grams, checks, _ = gram_hashes(*_open(body.as_py())[1:], bits)
                here = (grams >= bounds[0]) & (grams < bounds[-1])
                grams, checks = grams[here], checks[here]
                order, new = distinct(grams, checks)
                at = np.flatnonzero(new)
                counts = np.diff(at, append=len(order))
                grams, checks = grams[order[at]], checks[order[at]]
                del order, new, at, here
                cut = np.searchsorted(grams, bounds)
                rows = []
                for k in np.flatnonzero(np.diff(cut)).tolist():
                    s, e = cut[k], cut[k + 1]
                    rows.append((parts[k], _squeeze(np.diff(grams[s:e], prepend=bounds[k])), checks[s:e].astype("<u4").tobytes(), _squeeze(counts[s:e])))
                kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
                cols = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([pa.array([block] * len(rows), pa.string()), *cols], names=["block", "part", "hashes", "checks", "counts"])

    return gathered.select("block", "body").mapInArrow(trimmed(run), "block string, part int, hashes binary, checks binary, counts binary")


def _summed(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A partition's share of the count table: for its runs' n-grams one after another their number among the distinct
    ones, hash and check hash; the distinct ones' counts; and where runs end."""
    runs = [np.cumsum(_expand(x)) for x in group["hashes"]]
    ends = np.cumsum([len(r) for r in runs])
    hashes = np.concatenate(runs)
    del runs
    checks = np.concatenate([np.frombuffer(x, "<u4") for x in group["checks"]])
    inverse = _inverse(*distinct(hashes, checks))
    return inverse, hashes, checks, np.bincount(inverse, np.concatenate([_expand(x) for x in group["counts"]])).astype(np.uint64), ends


def _answer(group: pd.DataFrame) -> pd.DataFrame:
    """Corpus counts of each run's n-grams: the partition's share of the count table joined to every run."""
    inverse, _, _, counts, ends = _summed(group)
    return pd.DataFrame({"block": group["block"], "part": group["part"], "totals": [_squeeze(x) for x in np.split(counts[inverse], ends[:-1])]})


def _share(group: pd.DataFrame) -> pd.DataFrame:
    """The partition's share of the count table as rows."""
    inverse, hashes, checks, counts, _ = _summed(group)
    first = np.zeros(len(counts), np.int64)
    first[inverse[::-1]] = np.arange(len(inverse))[::-1]
    return pd.DataFrame({"gram": hashes[first].astype(np.int64), "check": checks[first].astype(np.int64), "n": counts.astype(np.int64)})


def _score(total_words: int, bits: int):
    def run(blocks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        found: list[pd.DataFrame] = []
        for body in blocks["body"]:
            ids, words, doc = _open(body)
            n = np.bincount(doc, minlength=len(ids)).astype(np.int64)
            totals = np.concatenate([_expand(x) for x in answers.sort_values("part")["totals"]]).astype(np.int64) if len(answers) else np.zeros(0, np.int64)
            grams, checks, at = gram_hashes(words, doc, bits)
            del words
            inverse = _inverse(*distinct(grams, checks))
            del grams, checks
            counts = np.zeros((ORDER + 1, len(doc)), np.int64)  # of the n-gram that ends at each word
            lo = 0
            for k, a in enumerate(at, 1):
                own = inverse[lo : lo + len(a)]
                # Occurrences of the same n-gram in the same document are left out.
                _, same, times = np.unique(doc[a] * np.int64(max(1, len(totals))) + own, return_inverse=True, return_counts=True)
                counts[k, a] = totals[own] - times[same]
                lo += len(a)
            del inverse, totals
            others = (total_words - n[doc]).astype(float)
            score = np.where(counts[1] > 0, np.log(np.maximum(counts[1], 1)) - np.log(np.maximum(others, 1)), -np.log(others + 1))
            for k in range(2, ORDER + 1):
                context = np.concatenate([[0], counts[k - 1, :-1]])  # ends one word earlier
                deep = np.zeros(len(doc), bool)
                deep[at[k - 1]] = True
                seen = np.log(np.maximum(counts[k], 1)) - np.log(np.maximum(context, 1))
                score = np.where(deep, np.where(counts[k] > 0, seen, math.log(ALPHA) + score), score)
            sums = np.bincount(doc, score, len(ids))
            known = np.bincount(doc, counts[ORDER] > 0, len(ids)).astype(np.int64)
            found.append(pd.DataFrame({"doc_id": pd.array(ids, "Int64"), "n_words": n, "n_seen": known, "log_score": sums, "mean_log": pd.array([s / k if k else None for s, k in zip(sums, n, strict=True)], "Float64")}))
        return pd.concat(found) if found else pd.DataFrame({"doc_id": [], "n_words": [], "n_seen": [], "log_score": [], "mean_log": []})

    return run


@contextlib.contextmanager
def _shuffles_end_with_their_query(spark: SparkSession) -> Iterator[None]:
    """Have Spark delete the shuffle files of what is run inside when it is done."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _partitions(total_words: int) -> int:
    return max(1, math.ceil(total_words * ORDER / PARTITION_GRAMS))


def count_table(documents: DataFrame) -> DataFrame:
    """gram, check and n: how often each n-gram of up to ORDER words occurs in the corpus, under its two hashes (those of
    gram_hashes() over word_hashes()). The table that score() joins, a row each instead of packed."""
    gathered = stash(blocks(documents), "blocks")
    partitions = _partitions(int(gathered.agg(F.sum("words")).first()[0] or 0))
    asked = requests(gathered, partitions, HASH_BITS, range(partitions))
    return asked.groupBy("part").applyInPandas(trimmed(_share), "gram bigint, check bigint, n bigint")


def score(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, n_seen (words whose n-gram of ORDER words other documents hold), log_score and mean_log of each row."""
    gathered = stash(blocks(documents), "blocks")
    total = gathered.agg(F.sum("words")).first()[0] or 0
    partitions = _partitions(int(total))
    size = math.ceil(partitions / ROUNDS)
    rounds = []
    with _shuffles_end_with_their_query(documents.sparkSession):
        for low in range(0, partitions, size):
            asked = requests(gathered, partitions, HASH_BITS, range(low, min(low + size, partitions)))
            rounds.append(stash(asked.groupBy("part").applyInPandas(trimmed(_answer), "block string, part int, totals binary"), "counts"))
        answers = functools.reduce(DataFrame.unionByName, rounds)
        scored = gathered.select("block", "body").groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(trimmed(_score(int(total), HASH_BITS)), "doc_id bigint, n_words bigint, n_seen bigint, log_score double, mean_log double")
        out = stash(scored, "scores")
    for x in (gathered, *rounds):
        unstash(x)
    return out


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score(table(spark, sf_dir, "documents"))
    return scored.withColumns({c: F.round(c, 6) for c in ("log_score", "mean_log")})
