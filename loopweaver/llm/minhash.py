"""MinHash near-dedup over word shingles.

A document's set is its distinct 5-word shingles, as 64-bit hashes. One pass over the texts gives each document the size
and a 128-bit digest of its set, BANDS * ROWS minima of universal hashes, and from them BANDS band keys. Documents with
equal digests have equal sets and are one class; only class representatives go on.

Two sets at the least similarity share a band key but for a chance of (1 - 0.75^5)^64, under 1e-7. A pair becomes a
candidate if the signatures agree well enough (true pairs lie six deviations above that bar), and a link if the full sets,
made again from the texts, meet the threshold. Components come from alternating stars.

Classes are linked in three rounds, so that no bucket's pairs are listed: first each class with one smaller class of a
bucket it is in; then, in buckets that still hold several components, the candidates that make a forest of the best
agreement between components. These join nearly all of a group of copies. What the forests connect, verified or not, is a
group that holds every remaining candidate; last, in groups that still hold several components, the full sets are compared.
In both rounds the members of a bucket's or group's largest component only pass the others, never each other, so that a
few stragglers cost one pass over a large group; tasks hold a bounded chunk of the others (chunks.py). Only pairs within a
component go unverified.

A null doc_id links with nothing, is its own component (null) and kept. Null, empty and wordless texts have an empty set
and link with nothing. Rows that repeat a doc_id take the component of their own text. An empty table gives an empty
result. Columns other than doc_id and text are ignored, and texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loopweaver.llm.chunks import checked, deal, work
from loopweaver.llm.common import stash, table, trimmed, unstash
from loopweaver.llm.components import connected_components

WORDS, PERCENT = 5, 75
BANDS, ROWS = 64, 5
#: Share of agreeing minima from which two sets are compared in full.
AGREE = 0.60
#: Members of a bucket that a task holds, and that it streams past them, at most about.
CHUNK, PART = 2_000, 100_000
#: Shingles of a group's sets that a task holds (8 bytes each, twice), and that it streams past them, at most about.
CHUNK_SHINGLES, PART_SHINGLES = 1 << 20, 1 << 24
#: Bits, at most, of the broadcast map that tells which texts are to be read again; 8 for each at least, else a join tells.
MAP_BITS = 1 << 26
_BITS_PER_MAP = 8 * 4096
KEPT_WORDS = 200_000
_RNG = np.random.default_rng(5_640_075)
_A, _B = (_RNG.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1) for _ in range(2))
_C = _RNG.integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)
_POWERS = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(WORDS)], np.uint64)
_kept: dict[bytes, int] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    kept = _kept
    if len(kept) > KEPT_WORDS:
        kept.clear()
    for w in set(words).difference(kept):
        kept[w] = xxhash.xxh3_64_intdigest(w)
    return np.fromiter(map(kept.__getitem__, words), np.uint64, len(words))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the 5-word shingles of a text, or of its whole sequence if that is shorter."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = word_hashes(words)
    if len(h) < WORDS:
        return mix((h * _POWERS[: len(h)]).sum(keepdims=True) + np.uint64(len(h)))
    n = len(h) - WORDS + 1
    s = h[:n] * _POWERS[0]
    for k in range(1, WORDS):
        s = s + h[k : k + n] * _POWERS[k]
    return np.unique(mix(s + np.uint64(WORDS)))


def signature(hashes: np.ndarray) -> np.ndarray:
    """BANDS * ROWS minima of universal hashes of a non-empty set."""
    low, high = hashes.astype(np.uint32), (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for s in range(0, len(hashes), 512):
        x = low[s : s + 512, None] * _A
        x += high[s : s + 512, None] * _B
        np.minimum(out, x.min(0), out)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    x = (sig.reshape(BANDS, ROWS).astype(np.uint64) * _C).sum(1) + np.arange(BANDS, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)
    return mix(x).view(np.int64)


def digest(hashes: np.ndarray) -> tuple[int, int]:
    import xxhash

    d = xxhash.xxh3_128_intdigest(hashes.tobytes())
    return (d >> 64) - (1 << 63), (d & ((1 << 64) - 1)) - (1 << 63)


def _table(schema: list[tuple[str, pa.DataType]], rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(cols, schema, strict=True)], names=[n for n, _ in schema])


_SKETCH = [("doc_id", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("bands", pa.binary()), ("sig", pa.binary())]


def sketches(documents: DataFrame) -> DataFrame:
    """doc_id, set size n, digest d1 d2, band keys and the signature's low bytes (null for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                s = shingles(text.as_py())
                if len(s):
                    sig = signature(s)
                    rows.append((doc_id, len(s), *digest(s), band_keys(sig).tobytes(), sig.astype(np.uint8).tobytes()))
                else:
                    rows.append((doc_id, 0, 0, 0, None, None))
            yield _table(_SKETCH, rows)
        _kept.clear()

    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(trimmed(run), "doc_id bigint, n bigint, d1 bigint, d2 bigint, bands binary, sig binary")


def _band_rows(classes: DataFrame) -> DataFrame:
    """key and rep: a row for each class and band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = np.frombuffer(b"".join(b.column(1).to_pylist()), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.repeat(b.column(0).to_numpy(), BANDS))], names=["key", "rep"])

    return classes.select("rep", "bands").mapInArrow(run, "key bigint, rep bigint")


def _agreeing(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs u, v whose signatures agree."""
    own = lambda x: classes.select(F.col("rep").alias(x), F.col("sig").alias(f"sig_{x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s, t = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint8).reshape(b.num_rows, -1) for i in (2, 3))
            ok = (s == t).mean(1) >= AGREE if b.num_rows else np.zeros(0, bool)
            yield b.select([0, 1]).filter(pa.array(ok))

    return pairs.join(own("u"), "u").join(own("v"), "v").select("u", "v", "sig_u", "sig_v").mapInArrow(run, "u bigint, v bigint")


def _sets(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """rep and set (sorted 64-bit hashes) of the classes in wanted (rep, d1, d2; staged), made from the texts.

    A map of bits tells which texts may be meant, as large as their number needs but no larger than MAP_BITS; beyond what
    that can tell apart, a join on doc_id does. The digest then tells exactly.
    """
    n = wanted.count()
    bits = max(_BITS_PER_MAP, 1 << (16 * n).bit_length())
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("doc_id is not null")
    held = None
    if 8 * n > MAP_BITS:
        docs = docs.join(wanted.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").select("doc_id", "text", F.lit(0).cast("bigint").alias("at"))
    else:
        bits = min(bits, MAP_BITS)
        place = F.pmod(F.xxhash64("doc_id"), F.lit(bits))
        rows = wanted.select(F.col("rep").alias("doc_id")).select(place.alias("at")).distinct().groupBy(F.floor(F.col("at") / _BITS_PER_MAP).alias("part")).agg(F.bitmap_construct_agg((F.col("at") % _BITS_PER_MAP).cast("bigint")).alias("bits")).collect()
        full = np.zeros(bits // 8, np.uint8)
        for part, b in rows:
            full[part * 4096 : part * 4096 + len(b)] = np.frombuffer(bytes(b), np.uint8)
        held = documents.sparkSession.sparkContext.broadcast(full.tobytes())  # MAP_BITS / 8 bytes at most
        docs = docs.select("doc_id", "text", place.alias("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.frombuffer(held.value if held else b"\x01", np.uint8)
        for b in batches:
            at = b.column(2).to_numpy()
            rows = []
            for i in np.flatnonzero((seen[at >> 3] >> (at & 7).astype(np.uint8)) & 1):
                s = shingles(b.column(1)[int(i)].as_py())
                if len(s):
                    rows.append((*digest(s), s.tobytes()))
            yield _table([("d1", pa.int64()), ("d2", pa.int64()), ("set", pa.binary())], rows)
        _kept.clear()

    made = docs.mapInArrow(trimmed(run), "d1 bigint, d2 bigint, set binary")
    return made.join(wanted, ["d1", "d2"]).select("rep", "set").dropDuplicates(["rep"])


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs u, v whose full sets meet the threshold."""
    own = lambda x: sets.select(F.col("rep").alias(x), F.col("set").alias(f"set_{x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for s, t in zip(b.column(2), b.column(3), strict=True):
                x, y = np.frombuffer(s.as_buffer(), np.uint64), np.frombuffer(t.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            yield b.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    return pairs.join(own("u"), "u").join(own("v"), "v").select("u", "v", "set_u", "set_v").mapInArrow(run, "u bigint, v bigint")


def _apart(members: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The members of groups that hold several components, with `minor`: whether outside the group's largest; and the
    staged table of those groups."""
    per = members.groupBy(key, "comp").agg(F.count(F.lit(1)).alias("n"))
    groups = per.groupBy(key).agg(F.max(F.struct("n", "comp")).alias("top"), F.count(F.lit(1)).alias("comps")).where("comps > 1")
    groups = stash(groups.select(key, F.col("top.comp").alias("major")), "majors")
    return members.join(checked(groups), key).withColumn("minor", F.col("comp") != F.col("major")).drop("major"), groups


class _Roots(dict):
    """Union-find over components."""

    def root(self, c: int) -> int:
        while (k := self.get(c, c)) != c:
            self[c] = self.get(k, k)
            c = self[c]
        return c

    def join(self, c: int, d: int) -> bool:
        c, d = self.root(c), self.root(d)
        if c != d:
            self[c] = d
        return c != d


_LINK = [("u", pa.int64()), ("v", pa.int64())]


class _Bucket:
    """Members of a bucket that a task holds, and the forest of the best agreement between components found so far."""

    def __init__(self, key: tuple, held: list[pa.RecordBatch]):
        rows = [self._rows(b) for b in held]
        self.rep, self.comp, self.sig = (np.concatenate([r[k] for r in rows]) for k in range(3))
        self.edges: list[tuple[float, int, int, int, int]] = []
        if key[-1] == 0:
            self._compare(self.rep, self.comp, self.sig, True)

    @staticmethod
    def _rows(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return b.column(4).to_numpy(), b.column(5).to_numpy(), np.frombuffer(b"".join(b.column(6).to_pylist()), np.uint8).reshape(b.num_rows, -1)

    def _compare(self, rep: np.ndarray, comp: np.ndarray, sig: np.ndarray, same: bool) -> None:
        for i in range(len(self.rep)):
            others = np.flatnonzero(comp != self.comp[i])
            others = others[others > i] if same else others
            if len(others):
                agree = (sig[others] == self.sig[i]).mean(1)
                good = agree >= AGREE
                for j, x in zip(others[good].tolist(), agree[good].tolist(), strict=True):
                    self.edges.append((-x, int(min(self.rep[i], rep[j])), int(max(self.rep[i], rep[j])), int(self.comp[i]), int(comp[j])))
            if len(self.edges) > 100_000:
                self._thin()
        self._thin()

    def _thin(self) -> None:
        roots = _Roots()
        self.edges = [e for e in sorted(self.edges) if roots.join(e[3], e[4])]

    def meet(self, others: pa.RecordBatch) -> None:
        self._compare(*self._rows(others), False)

    def result(self) -> pa.RecordBatch:
        return _table(_LINK, [e[1:3] for e in self.edges])


def _across(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Agreeing pairs of members of one bucket but different components, of these a forest between components with the best
    agreement first. members: key, rep, comp, sig, minor. Only agreeing pairs leave a task."""
    ordered, sizes = deal(members.select("key", "rep", "comp", "sig", "minor"), ["key"], "rep", F.col("minor"), CHUNK, PART)
    return ordered.drop("minor").mapInArrow(trimmed(work(1, _Bucket)), "u bigint, v bigint").distinct(), sizes


class _Group:
    """Sets of a group's members that a task holds, as their shingles in order with the set that each is in."""

    def __init__(self, key: tuple, held: list[pa.RecordBatch]):
        rows = [self._rows(b) for b in held]
        self.rep, self.comp = (np.concatenate([r[k] for r in rows]) for k in range(2))
        sets = [x for r in rows for x in r[2]]
        self.size = np.array([len(x) for x in sets])
        every, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), self.size)
        order = np.argsort(every, kind="stable")
        self.shingles, self.owner = every[order], owner[order]
        self.roots = _Roots()
        self.links: list[tuple[int, int]] = []
        if key[-1] == 0:
            for j, x in enumerate(sets):
                self._compare(int(self.rep[j]), int(self.comp[j]), x, j)

    @staticmethod
    def _rows(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        return b.column(4).to_numpy(), b.column(5).to_numpy(), [np.frombuffer(x.as_buffer(), np.uint64) for x in b.column(6)]

    def _compare(self, rep: int, comp: int, own: np.ndarray, before: int) -> None:
        """One set with the held ones that stand before a place."""
        lo, hi = np.searchsorted(self.shingles, own, "left"), np.searchsorted(self.shingles, own, "right")
        hit = hi > lo
        sizes = (hi - lo)[hit]
        ends = np.cumsum(sizes)
        at = np.repeat(lo[hit] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
        both = np.bincount(self.owner[at], minlength=len(self.rep))[:before]
        good = (self.comp[:before] != comp) & (100 * both >= PERCENT * (self.size[:before] + len(own) - both))
        for i in np.flatnonzero(good).tolist():
            if self.roots.join(int(self.comp[i]), comp):
                self.links.append((int(self.rep[i]), rep))

    def meet(self, others: pa.RecordBatch) -> None:
        for rep, comp, own in zip(*self._rows(others), strict=True):
            self._compare(int(rep), int(comp), own, len(self.rep))

    def result(self) -> pa.RecordBatch:
        return _table(_LINK, self.links)


def _within(members: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links between members of one group but different components, as a forest for each task. members: group, rep, comp,
    minor, n."""
    rows = members.join(sets, "rep").select("group", "rep", "comp", "set", "minor", "n")
    ordered, sizes = deal(rows, ["group"], "rep", F.col("minor"), CHUNK_SHINGLES, PART_SHINGLES, F.col("n"))
    return ordered.drop("minor", "n").mapInArrow(trimmed(work(1, _Group)), "u bigint, v bigint"), sizes


def classes_of(sketched: DataFrame) -> DataFrame:
    """rep (smallest doc_id), n, d1, d2, bands and sig of each different non-empty set."""
    some = sketched.where("n > 0 and doc_id is not null")
    return some.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sig").alias("sig"))


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row."""
    made: list[DataFrame] = []

    def keep(df: DataFrame, what: str) -> DataFrame:
        made.append(stash(df, what))
        return made[-1]

    sketched = keep(sketches(documents), "sketches")
    classes = keep(classes_of(sketched), "classes")
    bands = _band_rows(classes)
    leads = bands.groupBy("key").agg(F.min("rep").alias("lead"), F.max("rep").alias("last")).where("lead < last").select("key", "lead")
    shared = keep(bands.join(leads, "key"), "shared")

    first = shared.where("rep <> lead").groupBy(F.col("rep").alias("u")).agg(F.min("lead").alias("v"))
    pairs = keep(_agreeing(first, classes), "pairs")
    ends = lambda p: p.select(F.col("u").alias("rep")).union(p.select(F.col("v").alias("rep"))).distinct()
    keys = classes.select("rep", "d1", "d2")
    sets = keep(_sets(documents, keep(ends(pairs).join(keys, "rep"), "wanted")), "sets")
    links = keep(_verified(pairs, sets), "links")
    comps = connected_components(links)
    made.append(comps)

    comp_of = lambda df: df.join(comps, F.col("rep") == F.col("node"), "left").drop("node").withColumn("comp", F.coalesce("component", "rep")).drop("component")
    members, open_keys = _apart(keep(comp_of(shared.select("key", "rep")), "members"), "key")
    more, sizes = _across(members.join(classes.select("rep", "sig"), "rep"))
    more = keep(more, "pairs")
    made += [open_keys, sizes]
    if more.head(1):
        missing = keep(ends(more).join(sets.select("rep"), "rep", "left_anti").join(keys, "rep"), "wanted")
        sets = sets.union(keep(_sets(documents, missing), "sets"))
        links = links.union(keep(_verified(more, sets), "links"))
        groups = connected_components(links.union(more))
        comps = connected_components(links)
        made += [groups, comps]
        groups = groups.select(F.col("node").alias("rep"), F.col("component").alias("group"))
        members, apart = _apart(keep(comp_of(groups), "members"), "group")
        last, sizes = _within(members.join(classes.select("rep", "n"), "rep"), sets)
        last = keep(last, "links")
        made += [apart, sizes]
        if last.head(1):
            comps = connected_components(links.union(last))
            made.append(comps)
    of_class = classes.select("d1", "d2", "rep").join(comps, F.col("rep") == F.col("node"), "left").select(F.col("d1").alias("c1"), F.col("d2").alias("c2"), F.coalesce("component", "rep").alias("comp"))
    rows = sketched.select("doc_id", "n", "d1", "d2").join(of_class, (F.col("d1") == F.col("c1")) & (F.col("d2") == F.col("c2")) & (F.col("n") > 0) & F.col("doc_id").isNotNull(), "left")
    out = rows.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("comp", "doc_id").alias("component_id"))
    out = stash(out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))), "near-duplicates")
    for x in made:
        unstash(x)
    return out


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
