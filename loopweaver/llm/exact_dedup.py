"""Exact dedup: an extendible-hash index of texts on shared files.

A text is normalised by lower-casing A-Z. Its key is the first 64 bits of the SHA-256 of its bytes; keys only route and
chain, and texts count as equal when their bytes are.

The directory divides the range of keys into buckets by their leading bits. A bucket whose texts take more than a capacity
is split by one more bit, and where its local depth reaches the global depth the directory doubles, until no bucket that
holds two keys is overfull. A bucket's slots of the directory are consecutive, so that the directory is kept as one row per
bucket (first key and local depth) and looked up by binary search, and doubling it costs nothing. A bucket overfull by one
key cannot be split: it gets pages, which different tasks work off.

Every owner task has a range of keys: some neighbouring buckets, or one page. It streams their entries in the order of
keys, chains the different texts of a key (collisions too) and compares bytes. What it writes is the index: one row for each
chained text and, beside it, the members. Chains of pages of one key are merged afterwards, FAN pages at a time, from one
text per page and class. Before the shuffle each scan task folds equal texts into one entry with their doc_ids, as many as
fit into WINDOW_BYTES, so that a text that makes up a third of all rows travels once for each such window.

`add` brings further documents into an index: only texts of the index whose keys come again are compared.

A null text is an empty one. Rows without doc_id are members like others; where a group has no doc_id at all its keep_id is
null. Of equal texts the largest doc_id stays; rows that repeat a doc_id with its text are alike, and rows without doc_id
stay only where no row of their group has one. Texts of any length are compared whole; a task holds the different texts of
one key, and one window. An empty table gives an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loopweaver.llm.chunks import checked
from loopweaver.llm.common import stash, table, trimmed

#: Bytes of texts in a bucket, at most; of large inputs the 2^19th part, so that the directory stays within some 2^20 buckets.
CAPACITY = 64 << 20
MOST_BUCKETS = 1 << 19
#: Bytes of texts, and doc_ids, that a scan task folds together.
WINDOW_BYTES, WINDOW_ROWS = 16 << 20, 100_000
#: Pages of a key that are merged at a time.
FAN = 64
#: Least key; keys are signed, in the order of their leading bits.
FIRST = -(1 << 63)


def key_of(digest: bytes, bits: int = 64) -> int:
    """The key of a text with this SHA-256; fewer bits make more collisions."""
    return int.from_bytes(digest[:8], "big", signed=True) >> (64 - bits) << (64 - bits)


@dataclass(frozen=True)
class Directory:
    """Buckets in the order of their keys: first key, local depth, bytes (-1: not counted yet), and whether they hold two keys."""

    first: np.ndarray
    depth: np.ndarray
    size: np.ndarray
    mixed: np.ndarray

    @property
    def global_depth(self) -> int:
        """The directory has two to the power of this many slots."""
        return int(self.depth.max())

    def bucket(self, keys: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, keys, side="right") - 1

    def split(self, which: np.ndarray, bits: np.ndarray) -> Directory:
        """The directory with each of these buckets split by so many bits."""
        first, depth = [np.delete(self.first, which)], [np.delete(self.depth, which)]
        for k, n in zip(which.tolist(), bits.tolist(), strict=True):
            step = 1 << (64 - int(self.depth[k]) - n)
            first.append(np.array([int(self.first[k]) + i * step for i in range(1 << n)], np.int64))
            depth.append(np.full(1 << n, self.depth[k] + n))
        fresh = sum(len(x) for x in first[1:])
        order = np.argsort(np.concatenate(first), kind="stable")
        all_of = lambda old, new: np.concatenate([np.delete(old, which), np.full(fresh, new)])[order]
        return Directory(np.concatenate(first)[order], np.concatenate(depth)[order], all_of(self.size, -1), all_of(self.mixed, False))

    def owners(self, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
        """First owner and pages of each bucket, and how many owners there are. Neighbouring buckets share an owner up to the
        capacity; every page of a bucket of one key has its own."""
        pages = np.where(self.mixed, 1, np.maximum(1, -(-self.size // capacity)))
        start, owner, held = [], -1, capacity + 1
        for size, n in zip(self.size.tolist(), pages.tolist(), strict=True):
            if n > 1 or held + size > capacity:
                owner, held = owner + 1, 0
            start.append(owner)
            owner, held = owner + n - 1, held + size
        return np.array(start, np.int64), pages, owner + 1


EMPTY = Directory(np.array([FIRST]), np.array([0]), np.array([-1]), np.array([False]))


def _counted(keys: DataFrame, directory: Directory) -> Directory:
    """The directory with all buckets counted that are not. keys: key, size."""
    first, due = directory.first, directory.size < 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, least, most = np.zeros(len(first), np.int64), np.full(len(first), (1 << 63) - 1), np.full(len(first), FIRST)
        for b in batches:
            key, n = b.column(0).to_numpy(), b.column(1).to_numpy()
            at = np.searchsorted(first, key, side="right") - 1
            np.add.at(size, at, n)
            np.minimum.at(least, at, key)
            np.maximum.at(most, at, key)
        hit = np.flatnonzero(due & (least <= most))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (hit, size[hit], least[hit], most[hit])], names=["bucket", "size", "least", "most"])

    rows = keys.select("key", "size").mapInArrow(run, "bucket bigint, size bigint, least bigint, most bigint")
    size, mixed = np.where(due, 0, directory.size), directory.mixed.copy()
    for r in rows.groupBy("bucket").agg(F.sum("size").alias("size"), (F.min("least") < F.max("most")).alias("mixed")).collect():  # a row per bucket
        size[r["bucket"]], mixed[r["bucket"]] = r["size"], r["mixed"]
    return Directory(first, directory.depth, size, mixed)


def grow(keys: DataFrame, capacity: int, directory: Directory = EMPTY) -> tuple[Directory, int]:
    """The directory, and the capacity that holds for it: overfull buckets of several keys are split round by round. A bucket
    takes as many bits at once as evenly spread keys need."""
    directory = _counted(keys, Directory(directory.first, directory.depth, np.full(len(directory.first), -1), directory.mixed))
    capacity = max(capacity, int(directory.size.sum()) // MOST_BUCKETS)
    while (over := np.flatnonzero((directory.size > capacity) & directory.mixed)).size:
        bits = np.ceil(np.log2(directory.size[over] / capacity)).astype(np.int64)
        directory = _counted(keys, directory.split(over, np.clip(bits, 1, 64 - directory.depth[over])))
    return directory, capacity


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))


def keys_of(documents: DataFrame, bits: int = 64) -> DataFrame:
    """key and size in bytes of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(0).to_pylist()
            keys = [key_of(hashlib.sha256(t.lower()).digest(), bits) for t in texts]  # bytes.lower() changes A-Z only
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([len(t) for t in texts], pa.int64())], names=["key", "size"])

    return _texts(documents).select("text").mapInArrow(trimmed(run), "key bigint, size bigint")


_ENTRY = "owner int, key bigint, cls bigint, sha binary, text binary, ids array<bigint>"


def entries(documents: DataFrame, directory: Directory, capacity: int, bits: int = 64) -> DataFrame:
    """Folded texts with their doc_ids and the owner they go to."""
    start, pages, _ = directory.owners(capacity)
    first, most_bytes, most_rows = directory.first, WINDOW_BYTES, WINDOW_ROWS

    def folded(window: dict[bytes, list]) -> pa.RecordBatch:
        shas = [hashlib.sha256(t).digest() for t in window]
        keys = np.array([key_of(s, bits) for s in shas], np.int64)
        at = np.searchsorted(first, keys, side="right") - 1
        some = np.array([next((i for i in ids if i is not None), 0) for ids in window.values()], np.int64)
        page = (some * np.int64(0x9E3779B97F4A7C1 | 1) >> 20) % pages[at]  # windows of one text are dealt over its pages
        columns = [pa.array(start[at] + page, pa.int32()), pa.array(keys), pa.nulls(len(keys), pa.int64()), pa.array(shas, pa.binary()), pa.array(list(window), pa.binary()), pa.array(list(window.values()), pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, names=["owner", "key", "cls", "sha", "text", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        window: dict[bytes, list] = {}
        held = rows = 0
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                t = t.lower()
                if (ids := window.get(t)) is None:
                    window[t] = [i]
                    held += len(t)
                else:
                    ids.append(i)
                rows += 1
                if held >= most_bytes or rows >= most_rows:
                    yield folded(window)
                    window, held, rows = {}, 0, 0
        if window:
            yield folded(window)

    return _texts(documents).mapInArrow(trimmed(run), _ENTRY)


def _chained(rows: DataFrame, node: str, *more: str) -> DataFrame:
    """key, node, chain, text and more of rows that come by key and node: equal bytes get one number, in the order of first
    rows, and only the first row keeps its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple | None = None
        chain: dict[int, list[tuple[bytes, int]]] = {}
        count = 0
        for b in batches:
            numbers, kept = [], []
            for key, at, text in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if (key, at) != now:
                    now, chain, count = (key, at), {}, 0
                found = next((n for t, n in chain.get(len(text), ()) if t == text), None)
                kept.append(text if found is None else None)
                if found is None:
                    chain.setdefault(len(text), []).append((text, count))
                    found, count = count, count + 1
                numbers.append(found)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(numbers, pa.int64()), pa.array(kept, pa.binary()), *(b.column(3 + i) for i in range(len(more)))], names=["key", node, "chain", "text", *more])

    kinds = dict(rows.dtypes)
    return rows.select("key", node, "text", *more).mapInArrow(trimmed(run), ", ".join([f"key bigint, {node} {kinds[node]}, chain bigint, text binary", *(f"{c} {kinds[c]}" for c in more)]))


def _merged(chained: DataFrame, paged: DataFrame, pages: int) -> tuple[DataFrame, DataFrame]:
    """What the chains of pages come to: key, page, chain and the class's number cls; and the classes' texts with the number
    they had in the index, if any. FAN pages of a key meet at a time."""
    level = chained.where("text is not null").join(paged, "owner").select("key", "page", "chain", "text", "sha", "cls")
    total, wide = None, pages
    while True:
        up = level.withColumn("parent", F.expr(f"page div {FAN}"))
        up = up.repartition("key", "parent").sortWithinPartitions("key", "parent", "page", "chain").withColumnRenamed("chain", "below")
        up = stash(_chained(up, "parent", "page", "below", "sha", "cls"), "pages")
        step = up.select("key", "page", F.col("below").alias("chain"), F.col("parent").alias("p"), F.col("chain").alias("c"))
        if total is None:
            total = step
        else:
            step = step.select("key", F.col("page").alias("p"), F.col("chain").alias("c"), F.col("p").alias("p2"), F.col("c").alias("c2"))
            total = total.join(step, ["key", "p", "c"]).select("key", "page", "chain", F.col("p2").alias("p"), F.col("c2").alias("c"))
        level = up.where("text is not null").select("key", F.col("parent").alias("page"), "chain", "text", "sha", "cls")
        wide = -(-wide // FAN)
        if wide == 1:
            return total.select("key", "page", "chain", F.col("c").alias("number")), level


@dataclass(frozen=True)
class Index:
    """An index of texts: its directory, and staged tables of keys (key, size), classes (key, cls, sha, text) and members
    (key, cls, sha, ids)."""

    directory: Directory
    keys: DataFrame
    classes: DataFrame
    members: DataFrame
    bits: int = 64

    @staticmethod
    def of(documents: DataFrame, capacity: int = CAPACITY, bits: int = 64) -> Index:
        return _indexed(documents, None, capacity, bits)

    def add(self, documents: DataFrame, capacity: int = CAPACITY) -> Index:
        """An index of these documents too. What this one staged stays, and is part of the new one."""
        return _indexed(documents, self, capacity, self.bits)

    def rows(self) -> DataFrame:
        """doc_id, keep_id, group_size, kept and text_sha256 of every document."""
        of = self.members.groupBy("key", "cls").agg(F.sum(F.size("ids")).alias("n"), F.max(F.array_max("ids")).alias("top"), F.count(F.lit(1)).alias("parts"))
        several = stash(of.where("parts > 1").select("key", "cls", "n", "top"), "groups")
        one = F.col("n").isNull()
        rows = self.members.join(checked(several), ["key", "cls"], "left")
        rows = rows.select(F.when(one, F.array_max("ids")).otherwise(F.col("top")).alias("keep_id"), F.coalesce("n", F.size("ids")).cast("bigint").alias("group_size"), F.lower(F.hex("sha")).alias("text_sha256"), F.explode("ids").alias("doc_id"))
        return rows.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def _indexed(documents: DataFrame, old: Index | None, capacity: int, bits: int) -> Index:
    spark = documents.sparkSession
    fresh = stash(keys_of(documents, bits), "keys")
    keys = old.keys.union(fresh) if old else fresh
    directory, capacity = grow(keys, capacity, old.directory if old else EMPTY)
    start, pages, n_owners = directory.owners(capacity)
    rows = entries(documents, directory, capacity, bits)
    if old:
        again = old.classes.join(fresh.select("key").distinct(), "key", "left_semi")
        first = directory.first

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                at = np.searchsorted(first, b.column("key").to_numpy(), side="right") - 1
                columns = [pa.array(start[at], pa.int32()), *(b.column(c) for c in ("key", "cls", "sha", "text")), pa.array([[]] * b.num_rows, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["owner", "key", "cls", "sha", "text", "ids"])

        rows = rows.union(again.select("key", "cls", "sha", "text").mapInArrow(place, _ENTRY))
    # An entry goes to its owner by number; there a key's old texts come first, in the order of their numbers.
    owned = rows.repartitionById(n_owners, F.col("owner")).sortWithinPartitions("owner", "key", F.asc_nulls_last("cls"), "sha")
    chained = stash(_chained(owned, "owner", "cls", "sha", "ids"), "index", "zstd")
    split = np.flatnonzero(pages > 1)
    if len(split):
        paged = F.broadcast(spark.createDataFrame([(int(start[k]) + p, p) for k in split.tolist() for p in range(int(pages[k]))], "owner int, page bigint"))  # as many as capacities in the input
        total, level = _merged(chained, paged, int(pages.max()))
        numbers = stash(total, "numbers")
        of = chained.join(paged, "owner", "left").join(checked(numbers), ["key", "page", "chain"], "left")
        members = of.select("key", F.coalesce("number", "chain").alias("cls"), "sha", "ids")
        texts = chained.join(paged, "owner", "left_anti").where("text is not null").select("key", "chain", "cls", "sha", "text").union(level.select("key", "chain", "cls", "sha", "text"))
    else:
        members = chained.select("key", F.col("chain").alias("cls"), "sha", "ids")
        texts = chained.where("text is not null").select("key", "chain", "cls", "sha", "text")
    members, classes = members.where(F.size("ids") > 0), texts.where("cls is null").select("key", F.col("chain").alias("cls"), "sha", "text")
    return Index(directory, keys, old.classes.union(classes) if old else classes, old.members.union(members) if old else members, bits)


def deduplicate(documents: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of each row."""
    index = Index.of(documents)
    return stash(index.rows(), "exact")


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(table(spark, sf_dir, "documents"))
