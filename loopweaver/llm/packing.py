"""Packing along a space-filling curve.

Words are hashed into a vector of VECTOR_DIMS signed counts per document; a fixed projection takes it to AXES dimensions,
and the Hilbert curve through their grid gives the key. Documents are range-partitioned and sorted by key, ties by a hash of
doc_id and then by place, so that equal documents, and equal rows, stay neighbours yet spread over partitions where they
are many. Each partition encodes its
documents in that order, ends each with END_ID, and cuts the stream every SEQUENCE ids; the rest of a partition becomes
sequences whose lengths are powers of two, which need no padding. Sequences hold a stretch of the curve: neighbours are
packed together.

Texts are shuffled once, before they are encoded; a task holds one Arrow batch and the sequence it fills. Nulls and empty
texts are END_ID alone. Repeated rows are packed once each, one after another. An empty table gives an empty result.
Columns other than doc_id and text are ignored; texts are encoded whole.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loopweaver.llm.common import table, trimmed

VOCABULARY = "byte_bpe_50k.json"
SEQUENCE, END_ID = 1024, 0
VECTOR_DIMS, AXES, BITS = 64, 3, 16
#: Bytes, as Spark estimates them, of a partition that is packed in one task, at most about.
PARTITION_BYTES = 64 << 20
#: Bytes of text hashed at once.
_STEP = 1 << 18
_PROJECTION = np.random.default_rng(271_828).standard_normal((VECTOR_DIMS, AXES))
_ODD = 0x9E3779B97F4A7C15


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# Keys


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) < n:
        back = pow(_ODD, -1, 1 << 64)
        _POWERS[:] = [np.cumprod(np.full(n, x, np.uint64)) for x in (_ODD, back)]
    return _POWERS[0], _POWERS[1]


def _word_counts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Signed counts of hashed words of texts that lie in data one after another, each followed by a blank."""
    up, back = _powers(len(data))
    blank = data <= 32
    inside = np.concatenate([[False], ~blank, [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, stop = edge[::2], edge[1::2]
    low = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint64)
    total = np.concatenate([[np.uint64(0)], np.cumsum((low + np.uint64(1)) * up[: len(data)])])
    h = (total[stop] - total[start]) * back[start]
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    doc = np.searchsorted(ends, start, side="right")
    at = doc * VECTOR_DIMS + (h >> np.uint64(58)).astype(np.int64)
    sign = np.where((h >> np.uint64(57)) & np.uint64(1), 1.0, -1.0)
    return np.bincount(at, sign, len(ends) * VECTOR_DIMS).reshape(len(ends), VECTOR_DIMS)


def document_vectors(texts: list[bytes]) -> np.ndarray:
    """Unit vectors of hashed words; zero for texts without words. A text longer than a step is hashed in pieces cut at blanks."""
    out = np.zeros((len(texts), VECTOR_DIMS))
    held: list[tuple[int, bytes]] = []
    size = 0

    def flush() -> None:
        nonlocal held, size
        if held:
            data = np.frombuffer(b" ".join(t for _, t in held) + b" ", np.uint8)
            ends = np.cumsum([len(t) + 1 for _, t in held])
            np.add.at(out, [i for i, _ in held], _word_counts(data, ends))
        held, size = [], 0

    for i, t in enumerate(texts):
        at = 0
        while at < len(t):
            stop = min(len(t), at + _STEP)
            if stop < len(t):
                cut = max(t.rfind(b" ", at, stop), t.rfind(b"\n", at, stop))
                stop = cut + 1 if cut >= at else stop
            held.append((i, t[at:stop]))
            size += stop - at
            at = stop
            if size >= _STEP:
                flush()
    flush()
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-300)


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place along the Hilbert curve of each row of grid coordinates (Skilling's transform, by rows)."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for b in range(bits - 1, 0, -1):
        q = 1 << b
        p = q - 1
        for i in range(n):
            hit = (x[i] & q) != 0
            swap = np.where(hit, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(hit, x[0] ^ p, x[0] ^ swap)
            if i:
                x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        t = np.where(x[n - 1] & (1 << b), t ^ ((1 << b) - 1), t)
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def curve_keys(texts: list[bytes]) -> np.ndarray:
    """Hilbert key of each text."""
    x = document_vectors(texts) @ _PROJECTION
    # Coordinates of unit vectors are about standard normal: a logistic curve spreads them over the grid.
    cells = np.clip(np.floor((1 << BITS) / (1 + np.exp(-1.702 * np.clip(x, -8, 8)))), 0, (1 << BITS) - 1)
    return hilbert_key(cells)


def _key_udf():
    @F.pandas_udf("bigint")
    def key(texts: pd.Series) -> pd.Series:
        return pd.Series(curve_keys([(t or "").encode() for t in texts]))

    return key


# Ids


class Encoder:
    """Ids as the vocabulary's own tokenizer gives them, special tokens' strings included.

    Where each merge makes the next id, merging by id is the same as merging by rank, and tiktoken does it several times as
    fast; otherwise, and for texts that its pattern matcher refuses, the tokenizer itself is asked.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.fast = self._ranked(path)

    def _ranked(self, path: str):
        import public_tokenizers
        import tiktoken

        from loopweaver.llm.bpe import byte_letters

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        pre = spec.get("pre_tokenizer") or {}
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        plain = {t: i for t, i in vocab.items() if t not in added}
        usual = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and spec.get("normalizer") is None
        if not usual or any(vocab.get(a + b) != 256 + i for i, (a, b) in enumerate(pairs)) or len(plain) != 256 + len(pairs):
            return None
        letters = byte_letters()
        ranks = {bytes(letters[c] for c in t): i for t, i in plain.items()}
        return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)

    def ids(self, text: str) -> np.ndarray:
        if self.fast is not None:
            try:
                return self.fast.encode_to_numpy(text, allowed_special="all")
            except ValueError:
                pass
            except BaseException as e:  # the matcher's panics derive from BaseException, under a type that can't be imported
                if type(e).__name__ != "PanicException":
                    raise
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)


_encoders: dict[str, Encoder] = {}


def encoder(path: str | None = None) -> Encoder:
    path = path or vocabulary_path()
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


# Sequences


def pieces(stream: Iterator[tuple[int | None, np.ndarray]], first_sequence: int) -> Iterator[tuple]:
    """(doc_id, start, ids, document's ids, sequence, offset) of documents packed one after another.

    What fills no whole sequence at the end is held back, then dealt into sequences whose lengths are powers of two.
    """
    sequence, at = first_sequence, 0
    tail: list[list] = []
    for doc_id, ids in stream:
        start = 0
        while start < len(ids):
            n = min(SEQUENCE - at, len(ids) - start)
            tail.append([doc_id, start, ids[start : start + n], len(ids)])
            start, at = start + n, at + n
            if at == SEQUENCE:
                o = 0
                for d, s, x, total in tail:
                    yield d, s, x, total, sequence, o
                    o += len(x)
                tail, at, sequence = [], 0, sequence + 1
    while tail:
        left = sum(len(x) for _, _, x, _ in tail)
        room, o = 1 << (left.bit_length() - 1), 0
        while o < room:
            d, s, x, total = tail[0]
            n = min(len(x), room - o)
            yield d, s, x[:n], total, sequence, o
            o += n
            if n == len(x):
                tail.pop(0)
            else:
                tail[0] = [d, s + n, x[n:], total]
        sequence += 1


_FIELDS = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]


def _bytes(df: DataFrame) -> int:
    """Spark's estimate of a table's size; 0 where it has none."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return size if size < 1 << 60 else 0


def pack(documents: DataFrame, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids if asked for."""
    fields = _FIELDS + [("ids", pa.list_(pa.int32()))] * with_ids
    d = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    # The last column spreads rows that agree in id and text.
    keyed = d.withColumn("key", _key_udf()("text")).withColumn("tie", F.xxhash64("doc_id")).withColumn("row", F.monotonically_increasing_id())
    # As many partitions as the texts need; where the session has more set, Spark may merge small ones.
    need = -(-_bytes(documents) // PARTITION_BYTES)
    more = [need] if need > int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")) else []
    ordered = keyed.repartitionByRange(*more, "key", "tie", "row").sortWithinPartitions("key", "tie", "doc_id").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        end = np.array([END_ID], np.uint32)
        documents = ((i, np.concatenate([e.ids(t.as_py()), end])) for b in batches for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True))
        held: list[tuple] = []
        emit = lambda: pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(list(zip(*held, strict=True)) or [()] * len(fields), fields, strict=True)], names=[n for n, _ in fields])
        for doc_id, start, ids, total, sequence, offset in pieces(documents, TaskContext.get().partitionId() << 40):
            held.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, sequence, offset, *([ids.astype(np.int32)] * with_ids)))
            if len(held) >= 5_000:
                yield emit()
                held = []
        yield emit()

    return ordered.mapInArrow(trimmed(run), "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint" + ", ids array<int>" * with_ids)


def op7_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
