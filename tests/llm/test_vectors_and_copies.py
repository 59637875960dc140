"""Exact dedup, vector codes and hard negatives: brute force and SQL on small tables, and odd rows."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest

pytest.importorskip("loopweaver.llm.queries")

from loopweaver.llm import chunks, exact_dedup, hard_negatives, oracles, queries, vector_codes  # noqa: E402

SF = "/root/testdata/sf0.001"
CLASH = {c: "x" for c in ("key", "n", "cls", "ids", "sha", "owner", "page", "chain", "size", "bucket", "keep_id", "kept", "v", "dims", "code", "error", "l", "d", "e", "cell", "low", "high", "slot", "rank", "role", "score", "own_label", "at")}


def clashing(df):
    from pyspark.sql import functions as F

    return df.withColumns({k: F.lit(v) for k, v in CLASH.items() if k not in df.columns})


def rows_of(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


@pytest.mark.parametrize("name", ["op11_exact_dedup", "op12_va_codes", "op13_hard_negatives"])
def test_queries_against_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    sql = con.sql(getattr(oracles, name.split("_")[0].upper()))
    names = sorted(sql.columns)
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == names
    assert rows_of(got, *names) == sorted((tuple(r) for r in sql.select(*names).fetchall()), key=str)


# 11

COPIES = ["one two", "ONE two", "Éa", "éa", "ÉA", "", None, "x" * 3000, "X" * 3000, *(f"text {k % 7} " + "y" * (k % 5 * 400) for k in range(60)), *["hot copy " * 50] * 150]


def copies(spark, rows=None):
    rows = [(k, t) for k, t in enumerate(COPIES)] if rows is None else rows
    return clashing(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5))


def equal_groups(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").encode().lower()].append(i)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(t).hexdigest()) for i in ids]
    return sorted(out, key=str)


NAMES = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@pytest.mark.parametrize(("capacity", "bits"), [(1 << 26, 64), (4000, 64), (4000, 3), (1000, 1)])
def test_copies_whatever_the_directory(spark, monkeypatch, capacity, bits):
    monkeypatch.setattr(exact_dedup, "WINDOW_ROWS", 7)
    monkeypatch.setattr(exact_dedup, "FAN", 3)
    monkeypatch.setattr(chunks, "BROADCAST_GROUPS", 2)
    rows = list(enumerate(COPIES))
    index = exact_dedup.Index.of(copies(spark), capacity, bits)
    assert rows_of(index.rows(), *NAMES) == equal_groups(rows)
    assert index.classes.count() == len({(t or "").encode().lower() for t in COPIES})
    if capacity < 1 << 20:
        _, pages, owners = index.directory.owners(capacity)
        assert index.directory.global_depth > 0 and pages.max() > 3 and owners > pages.max()
    parts = [copies(spark, rows[k::3]) for k in range(3)]
    grown = exact_dedup.Index.of(parts[0], capacity, bits).add(parts[1], capacity).add(parts[2], capacity)
    assert rows_of(grown.rows(), *NAMES) == equal_groups(rows)
    assert grown.classes.count() == index.classes.count()


def test_directory_splits_only_what_is_overfull(spark):
    keys = spark.createDataFrame([(k << 58, 100) for k in range(-32, 0)] + [(5 << 40, 5000), ((5 << 40) + 1, 10)], "key bigint, size bigint")
    directory, capacity = exact_dedup.grow(keys, 1000)
    assert capacity == 1000 and directory.first[0] == exact_dedup.FIRST and (np.diff(directory.first) > 0).all()
    widths = [1 << (64 - int(d)) for d in directory.depth]
    assert [int(f) + w for f, w in zip(directory.first[:-1], widths, strict=False)] == directory.first[1:].tolist() and int(directory.first[-1]) + widths[-1] == 1 << 63
    assert directory.global_depth == 64 and directory.depth.min() <= 4
    over = (directory.size > capacity).nonzero()[0]
    assert [int(directory.size[k]) for k in over] == [5000] and not directory.mixed[over].any() and directory.size.sum() == 32 * 100 + 5010


def test_copies_among_odd_rows(spark):
    long = "Word " * 60_000
    rows = [(None, "a"), (None, "A"), (1, None), (2, ""), (2, ""), (3, long), (4, long.lower()), (5, "b"), (None, "B"), (7, "\x00İ"), (8, "\x00i̇")]
    got = exact_dedup.deduplicate(copies(spark, rows))
    assert rows_of(got, *NAMES) == sorted([(i, k, n, i == k, h) for i, k, n, _, h in equal_groups(rows)], key=str)
    assert exact_dedup.deduplicate(copies(spark, [])).collect() == []


# 12


def coded(x, k=64, parts=16, rounds=2):
    """Codes, errors and books of integer vectors, compared with every entry."""
    cut = vector_codes.cuts(x.shape[1], parts)
    books = [x[:k, a:b].copy() for a, b in cut]

    def assign():
        far = [((x[:, None, a:b] - e[None]) ** 2).sum(2) for (a, b), e in zip(cut, books, strict=True)]
        return np.stack([f.argmin(1) for f in far], 1), sum(f.min(1) for f in far)

    for _ in range(rounds):
        code, _ = assign()
        for p, (a, b) in enumerate(cut):
            for e in range(len(books[p])):
                if (code[:, p] == e).any():
                    books[p][e] = x[code[:, p] == e, a:b].sum(0) // (code[:, p] == e).sum()
    return (*assign(), books)


def vectors(spark, rows):
    return clashing(spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>"))


@pytest.mark.parametrize(("n", "dims"), [(400, 32), (10, 48), (90, 16), (200, 37), (80, 5)])
def test_codes_against_all_entries(spark, n, dims):
    rng = np.random.default_rng(n)
    x = rng.normal(size=(n, dims)) * rng.choice([0.01, 1, 100], (n, 1))
    x[n // 2 :] = x[rng.integers(0, n // 2, n - n // 2)]  # ties
    labels = [None if k % 5 == 0 else k % 3 for k in range(n)]
    got = {r["vec_id"]: r for r in vector_codes.compress(vectors(spark, [(k, labels[k], v.tolist()) for k, v in enumerate(x)])).collect()}
    code, error, books = coded(np.floor(256 * x).astype(np.int64))
    assert [got[k]["code"] for k in range(n)] == [bytes(c.tolist()).hex() for c in code] and [got[k]["error"] for k in range(n)] == error.tolist()
    assert {r["codebooks_sha256"] for r in got.values()} == {hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()}
    assert all(got[k]["label_error"] == sum(int(e) for e, v in zip(error, labels, strict=True) if v == labels[k]) for k in range(n))


def test_bounds_hold_and_filter():
    rng = np.random.default_rng(3)
    entries, x = rng.integers(-300, 300, (64, 4)), rng.integers(-300, 300, (500, 4))
    far = ((x[:, None] - entries[None]) ** 2).sum(2)
    f = vector_codes.VaFile(entries)
    lower, upper = f.bounds(x)
    assert (lower <= far).all() and (far <= upper).all()
    at, best, refined = f.nearest(x)
    assert at.tolist() == far.argmin(1).tolist() and best.tolist() == far.min(1).tolist() and refined < 500 * 64 / 8


def test_codes_round_trip(spark):
    x = np.random.default_rng(4).normal(size=(50, 32))
    rows = vector_codes.integers(vectors(spark, [(k, 1, v.tolist()) for k, v in enumerate(x)]))
    books = vector_codes.fit(rows)  # as many entries as vectors: nothing is lost but to moves of the entries
    for r in vector_codes.decode(vector_codes.encode(rows, books), books).join(rows.select("vec_id", rows["v"].alias("was")), "vec_id").collect():
        assert sum((a - b) ** 2 for a, b in zip(r["v"], r["was"], strict=True)) == r["error"]


def test_codes_of_odd_vectors(spark):
    inf = float("inf")
    rows = [(1, 1, None), (2, 1, []), (3, 1, [1.0, None]), (4, 1, [1.0, float("nan")]), (5, 1, [inf, 0.0]), (6, 1, [1e300, 0.0]), (7, 1, [0.5, -0.5]), (7, 1, [0.5, -0.5]), (None, None, [0.0, 0.0]), (8, 2, [1e5, -1e5]), (9, 2, [0.0] * 3)]
    got = rows_of(vector_codes.compress(vectors(spark, rows)), "vec_id", "code", "error", "label_error")
    assert [(r[0], r[2], r[3]) for r in got] == sorted([(7, 0, 0), (7, 0, 0), (None, 0, 0), (8, 0, 0), (9, 0, 0)], key=lambda r: str((r[0], 0)))
    assert {len(r[1]) for r in got} == {32}
    assert vector_codes.compress(vectors(spark, [])).collect() == []
    assert rows_of(vector_codes.compress(vectors(spark, rows[6:7]).drop("label")), "vec_id", "label_error") == [(7, 0)]


# 13


def mined(rows):
    sound = {}
    for i, label, e in sorted(rows, key=lambda r: str(r)):
        if i is not None and label is not None and e and all(v is not None and np.isfinite(v) for v in e):
            sound[i] = min(sound.get(i, (label, len(e), [int(np.floor(256 * v)) for v in e])), (label, len(e), [int(np.floor(256 * v)) for v in e]))
    out = []
    for a, (la, da, va) in sound.items():
        if a % 50:
            continue
        score = {i: sum(x * y for x, y in zip(va, v, strict=True)) for i, (_, d, v) in sound.items() if d == da and i != a}
        for p in sorted((i for i in score if sound[i][0] == la), key=lambda i: (-score[i], i))[:5]:
            fit = [i for i in score if sound[i][0] != la and 50 * score[p] <= 100 * score[i] <= 95 * score[p]]
            out += [(a, p, r + 1, i, score[p], score[i]) for r, i in enumerate(sorted(fit, key=lambda i: (-score[i], i))[:3])]
    return sorted(out, key=str)


MINED = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def some_vectors(n=1500, dims=12, seed=6):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(25, dims))
    x = base[rng.integers(0, 25, n)] + rng.normal(size=(n, dims)) * 0.4
    x[n // 2 : n // 2 + 200] = x[0]  # many ties
    return [(k, int(v), e.tolist()) for k, (v, e) in enumerate(zip(rng.integers(0, 4, n), x, strict=True))]


@pytest.mark.parametrize("small", [False, True])
def test_negatives_against_all_pairs(spark, monkeypatch, small):
    if small:
        for name, value in {"SEEDS": 40, "CELL_ROWS": 100, "HELD": 7, "PART": 300}.items():
            monkeypatch.setattr(hard_negatives, name, value)
        monkeypatch.setattr(chunks, "BROADCAST_GROUPS", 2)
    rows = some_vectors()
    assert rows_of(hard_negatives.mine(vectors(spark, rows)), *MINED) == mined(rows)


def test_nodes_are_pruned(monkeypatch):
    monkeypatch.setattr(hard_negatives, "LEAF_ANCHORS", 2)
    monkeypatch.setattr(hard_negatives, "LEAF_ROWS", 64)
    rng = np.random.default_rng(8)
    base = rng.normal(size=(40, 8)) * 300
    x = np.floor(np.repeat(base, 100, 0) + rng.normal(size=(4000, 8)) * 5)
    ids, labels, anchors = np.arange(4000), np.arange(4000) % 2, np.arange(0, 4000, 50)
    s = hard_negatives.Search(anchors, labels[anchors], x[anchors], np.arange(80), np.full(80, hard_negatives.NONE + 1), np.full(80, -(hard_negatives.NONE + 1)), 5, True)
    s.meet(ids, labels, x)
    assert s.scored < 80 * 4000 / 2
    want, found, _ = s.results()
    score = x[anchors] @ x.T
    for k, a in enumerate(anchors):
        rest = [i for i in range(4000) if i != a and labels[i] == labels[a]]
        assert sorted(found[want == k].tolist()) == sorted(sorted(rest, key=lambda i: (-score[k, i], i))[:5])


def test_negatives_of_odd_rows(spark):
    rows = [(0, 1, [1.0, 1.0]), (0, 1, [1.0, 1.0]), (0, 2, [5.0, 5.0]), (1, 1, [1.0, 1.0]), (2, 2, [0.9, 0.9]), (3, 3, [0.9, 0.9]), (4, 1, [-1.0, 0.0]), (5, None, [0.9, 0.9]), (None, 1, [1.0, 1.0]), (6, 2, None), (7, 2, []), (8, 2, [0.8, None])]
    rows += [(9, 2, [0.8, float("inf")]), (10, 2, [0.8, 0.8, 0.8]), (50, 9, [1.0, 1.0]), (100, 4, [0.5] * 3), (101, 4, [0.5] * 3), (102, 5, [0.4] * 3), (150, 7, [1e5, 2e5]), (151, 7, [1e5, 2e5]), (152, 8, [0.9e5, 1.8e5])]
    got = rows_of(hard_negatives.mine(vectors(spark, rows)), *MINED)
    assert got == mined(rows) and {r[0] for r in got} == {0, 100, 150}
    assert hard_negatives.mine(vectors(spark, [])).collect() == []
