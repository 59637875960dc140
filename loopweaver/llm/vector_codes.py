"""Vector code compression: product codes whose nearest codebook entries are found by VA-file filtering.

Components become integers, floor(256 x). Vectors are cut into PARTS consecutive parts, as equal as can be (the first ones
are longer where the number of dimensions is no multiple), and each part position has a codebook of ENTRIES entries. It
starts as that part of the vectors with the smallest vec_ids; each round assigns every part to its nearest entry and moves
each entry to the componentwise floor of its parts' mean; entries without parts stay.

The nearest entry is found as in a VA-file. Every coordinate of the entries is quantised to CELL_BITS bits; for each query a
table of its least and largest squared distance to each cell of each coordinate is made, and the sums that an entry's cells
look up there bound its distance from below and above. Only entries whose lower bound doesn't pass the least upper bound are
refined, with integer distances; ties go to the lower index.

All arithmetic is in integers. A round sends back one row of sums for each task, part and entry, so that what is shuffled
and what the driver holds (the codebooks: ENTRIES vectors) doesn't grow with the input.

Vectors that are null, empty, or hold null or non-finite components are left out, and so are those with a component of
2^22 / sqrt(dimensions) or more, whose squared distances need not fit into a long. Vectors of each number of dimensions
have codebooks of their own. Repeated rows count and are coded once each; among equal vec_ids the start is chosen by the
components in order, and a null vec_id comes last. With fewer vectors than ENTRIES codebooks are shorter. An empty table
gives an empty result; columns other than vec_id, label and embedding are ignored, and a table without a label has nulls.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loopweaver.llm.chunks import checked
from loopweaver.llm.common import stash, table, trimmed, unstash

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
CELL_BITS = 4
#: Vectors that are compared at a time.
BLOCK = 2048

#: A codebook for each part position: entries by components.
Books = list[np.ndarray]


def cuts(dims: int, parts: int) -> list[tuple[int, int]]:
    """First and last component (exclusive) of each part."""
    size, longer = divmod(dims, parts)
    at = [0]
    for k in range(parts):
        at.append(at[-1] + size + (k < longer))
    return list(zip(at[:-1], at[1:], strict=True))


class VaFile:
    """The entries of one codebook, quantised."""

    def __init__(self, entries: np.ndarray, bits: int = CELL_BITS):
        self.entries, n = entries, 1 << bits
        k, width = entries.shape
        low, high = entries.min(0), entries.max(0)
        # Cells of equal width over a coordinate's range; their bounds are those of the entries in them.
        self.cell = np.minimum((entries - low) * n // np.maximum(high - low, 1), n - 1)
        self.low, self.high = np.zeros((width, n), np.int64), np.zeros((width, n), np.int64)
        for d in range(width):
            for c in np.unique(self.cell[:, d]).tolist():
                inside = entries[self.cell[:, d] == c, d]
                self.low[d, c], self.high[d, c] = inside.min(), inside.max()

    def bounds(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the squared distances, by query and entry, summed over look-up tables."""
        q = x[:, :, None]
        below, above = self.low[None] - q, q - self.high[None]
        least = np.maximum(np.maximum(below, above), 0) ** 2
        most = np.maximum(np.abs(below), np.abs(above)) ** 2
        lower, upper = np.zeros((len(x), len(self.entries)), np.int64), np.zeros((len(x), len(self.entries)), np.int64)
        for d in range(x.shape[1]):
            lower += least[:, d, self.cell[:, d]]
            upper += most[:, d, self.cell[:, d]]
        return lower, upper

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Index of, and squared distance to, each query's nearest entry; and how many entries were refined."""
        lower, upper = self.bounds(x)
        row, entry = np.nonzero(lower <= upper.min(1, keepdims=True))
        far = ((x[row] - self.entries[entry]) ** 2).sum(1)
        first = np.searchsorted(row, np.arange(len(x)))  # every query has the entry of the least upper bound
        best = np.minimum.reduceat(far, first)
        return np.minimum.reduceat(np.where(far == best[row], entry, len(self.entries)), first), best, len(row)


def assign(x: np.ndarray, books: Books, files: list[VaFile] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Entries (vectors by parts) and squared distances summed over parts."""
    files = files or [VaFile(b) for b in books]
    code, error = np.zeros((len(x), len(books)), np.int64), np.zeros(len(x), np.int64)
    for k, (a, b) in enumerate(cuts(x.shape[1], len(books))):
        if a == b:
            continue  # a part without components is at its first entry
        for s in range(0, len(x), BLOCK):
            code[s : s + BLOCK, k], far, _ = files[k].nearest(x[s : s + BLOCK, a:b])
            error[s : s + BLOCK] += far
    return code, error


def integers(vectors: DataFrame) -> DataFrame:
    """vec_id, label, dims and v, the components as integers, of the vectors that are coded."""
    label = F.col("label") if "label" in vectors.columns else F.lit(None).cast("int")
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), label.alias("label"), F.col("embedding").cast("array<double>").alias("e"))
    limit = F.lit(float(1 << 22)) / F.sqrt(F.greatest(F.size("e"), F.lit(1)))
    fits = F.coalesce((F.size("e") > 0) & F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit)), F.lit(False))
    # The condition is part of the value, so that no component is turned into an integer before it is known to fit.
    v = F.when(fits, F.transform("e", lambda x: F.floor(x * SCALE).cast("bigint")))
    return rows.select("vec_id", "label", F.size("e").alias("dims"), v.alias("v")).where("v is not null")


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of an array column of one length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def _by_dims(b: pa.RecordBatch, column: str) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = b.column(column).to_numpy(zero_copy_only=False)
    for d in np.unique(dims).tolist():
        yield d, b if len(np.unique(dims)) == 1 else b.filter(pa.array(dims == d))


def _moved(rows: DataFrame, books: dict[int, Books]) -> dict[int, Books]:
    """The codebooks after one round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = {d: [VaFile(b) for b in bs] for d, bs in books.items()}
        sums = {d: [np.zeros(b.shape, np.int64) for b in bs] for d, bs in books.items()}
        counts = {d: [np.zeros(len(b), np.int64) for b in bs] for d, bs in books.items()}
        for batch in batches:
            for d, b in _by_dims(batch, "dims") if batch.num_rows else ():
                x = matrix(b.column("v"), d)
                code, _ = assign(x, books[d], files[d])
                for k, (lo, hi) in enumerate(cuts(d, len(books[d]))):
                    np.add.at(sums[d][k], code[:, k], x[:, lo:hi])
                    counts[d][k] += np.bincount(code[:, k], minlength=len(counts[d][k]))
        out = [(d, k, e, int(counts[d][k][e]), sums[d][k][e].tolist()) for d in books for k in range(len(books[d])) for e in np.flatnonzero(counts[d][k]).tolist()]
        yield pa.RecordBatch.from_arrays([*(pa.array([r[i] for r in out], pa.int64()) for i in range(4)), pa.array([r[4] for r in out], pa.list_(pa.int64()))], names=["dims", "part", "entry", "n", "sums"])

    partial = rows.select("dims", "v").mapInArrow(trimmed(run), "dims bigint, part bigint, entry bigint, n bigint, sums array<bigint>")
    flat = partial.select("dims", "part", "entry", "n", F.posexplode("sums").alias("at", "s"))
    total = flat.groupBy("dims", "part", "entry", "at").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    out = {d: [b.copy() for b in bs] for d, bs in books.items()}
    for r in total.collect():  # as many rows as the codebooks have components
        out[r["dims"]][r["part"]][r["entry"], r["at"]] = int(r["s"]) // r["n"]
    return out


def fit(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> dict[int, Books]:
    """Codebooks of each number of dimensions of integers(). One small job for each such number, and one for each round."""
    books: dict[int, Books] = {}
    for r in rows.select("dims").distinct().collect():
        first = rows.where(F.col("dims") == r["dims"]).orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).select("v").collect()
        x = np.array([f["v"] for f in first], np.int64)
        books[r["dims"]] = [x[:, a:b].copy() for a, b in cuts(r["dims"], parts)]
    for _ in range(rounds if books else 0):
        books = _moved(rows, books)
    return books


def digest(books: Books) -> str:
    """SHA-256 of all components by part, entry and position, in decimal."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def encode(rows: DataFrame, books: dict[int, Books]) -> DataFrame:
    """vec_id, label, dims, code (two hex digits for each part) and error of integers()."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = {d: [VaFile(b) for b in bs] for d, bs in books.items()}
        for batch in batches:
            for d, b in _by_dims(batch, "dims") if batch.num_rows else ():
                code, error = assign(matrix(b.column("v"), d), books[d], files[d])
                hexed = [c.tobytes().hex() for c in code.astype(np.uint8)]
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("vec_id", "label", "dims")), pa.array(hexed, pa.string()), pa.array(error)], names=["vec_id", "label", "dims", "code", "error"])

    return rows.mapInArrow(trimmed(run), T.StructType([*(rows.schema[c] for c in ("vec_id", "label", "dims")), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]))


def decode(codes: DataFrame, books: dict[int, Books]) -> DataFrame:
    """codes (dims, code and others) with v, the integers that the codes stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, b in _by_dims(batch, "dims") if batch.num_rows else ():
                at = np.frombuffer(bytes.fromhex("".join(b.column("code").to_pylist())), np.uint8).reshape(b.num_rows, -1)
                x = np.concatenate([book[at[:, k]] for k, book in enumerate(books[d])], axis=1)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(list(x), pa.list_(pa.int64()))], names=[*b.schema.names, "v"])

    return codes.mapInArrow(trimmed(run), T.StructType([*codes.schema.fields, T.StructField("v", T.ArrayType(T.LongType()))]))


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error (of all vectors with an equal label, nulls together) and codebooks_sha256."""
    spark = vectors.sparkSession
    rows = stash(integers(vectors), "integers")
    books = fit(rows, parts, entries, rounds)
    codes = stash(encode(rows, books), "codes")
    by_label = stash(codes.groupBy(F.col("label").alias("l")).agg(F.sum("error").alias("label_error")), "label-errors")
    shas = spark.createDataFrame([(d, digest(b)) for d, b in books.items()], "d int, codebooks_sha256 string")
    out = codes.join(checked(by_label), F.col("label").eqNullSafe(F.col("l")), "left").join(F.broadcast(shas), F.col("dims") == F.col("d"))
    out = stash(out.select("vec_id", "code", "error", "label_error", "codebooks_sha256"), "compressed")
    for x in (rows, codes, by_label):
        unstash(x)
    return out


def op12_va_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(table(spark, sf_dir, "embeddings"))
