"""Corpus operators: brute force on small tables, and nulls, empty and long texts, ties, repeated rows, empty tables and
extra columns with clashing names."""

import hashlib
import io
import math
import os
import re
import zlib
from collections import Counter

import numpy as np
import pytest

pytest.importorskip("loopweaver.llm.queries")

from loopweaver.llm import bpe, chunks, components, embed_dedup, licenses, lm_score, minhash, packing, quality, secrets, toxicity, warc  # noqa: E402

SF = "/root/testdata/sf0.001"
# Columns that the operators use themselves under these names.
CLASH = {c: "x" for c in ("key", "n", "rep", "comp", "u", "v", "node", "component", "label", "block", "part", "cell", "path", "bytes", "digest", "start", "rank", "end", "score", "kept", "sig", "at", "tie", "_rejected", "_key", "_d", "_k", "_spans", "sound", "e")}
LONG = "word " * 60_000 + "tail"
ODD = [(None, "no id at all in this row of words", "en"), (1, None, None), (2, "", "en"), (3, " \n\t ", "en"), (4, "one two three", "xx"), (4, "one two three", "xx"), (5, "One TWO three", "de"), (6, LONG, "en"), (7, "<|endoftext|> é 日本 👩‍👩‍👧\x00\x1c", "fr"), (8, "same id", "en"), (8, "other text under it", "en")]


def clashing(df):
    from pyspark.sql import functions as F

    return df.withColumns({k: F.lit(v) for k, v in CLASH.items() if k not in df.columns})


@pytest.fixture(scope="module")
def odd(spark):
    return clashing(spark.createDataFrame(ODD, "doc_id bigint, text string, lang string"))


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def by_text(rows, *names):
    return [tuple(r[n] for n in names) for r in rows]


# 1


def vectors(spark, rows):
    return clashing(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"))


def test_embeddings_against_all_pairs(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 24))
    x = np.concatenate([base[rng.integers(0, 40, 300)] + rng.normal(size=(300, 24)) * rng.choice([0.05, 0.2, 0.35], (300, 1)), base[:10], base[:10] * 3]).astype(np.float32)
    got = {r["vec_id"]: r for r in embed_dedup.deduplicate(vectors(spark, [(i, v.tolist()) for i, v in enumerate(x)])).collect()}
    y = x.astype(float)
    n = np.linalg.norm(y, axis=1)
    link = y @ y.T / n[:, None] / n[None, :] >= 0.95
    np.fill_diagonal(link, False)
    assert [got[i]["n_links"] for i in range(len(x))] == link.sum(1).tolist()
    comp = np.arange(len(x))
    for _ in range(len(x)):
        comp = np.array([min(comp[i], comp[link[i]].min(initial=i)) for i in range(len(x))])
    assert [got[i]["component_id"] for i in range(len(x))] == comp.tolist()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_many_near_copies_in_one_chunk():
    """Links are counted by tiles; the forest spans, with one link fewer than vectors."""
    rng = np.random.default_rng(7)
    n, dims = 6000, 64
    raw = rng.normal(size=dims) + rng.normal(size=(n, dims)) * 0.05
    raw[-1] = -raw[0]
    weight = rng.integers(1, 4, n)
    cell = embed_dedup.Cell(0, np.arange(n), weight, raw, 0.95)
    cell.meet_own()
    u, v = cell.forest.links()
    x = raw / np.linalg.norm(raw, axis=1, keepdims=True)
    near = (x @ embed_dedup.rotation(64))[:, :8]
    dist = (near**2).sum(1)[:, None] + (near**2).sum(1)[None, :] - 2 * near @ near.T
    link = (x @ x.T >= 0.95) & (dist <= cell.budget[0])
    np.fill_diagonal(link, False)
    assert cell.counts.tolist() == (link @ weight).tolist() and len(u) == len(v) == n - 2
    parent = np.arange(n)
    for a, b in zip(u, v, strict=True):
        parent[parent == parent[b]] = parent[a]
    assert len(set(parent[:-1])) == 1 and parent[-1] == n - 1


def test_tiles_of_both_kinds_agree(spark, monkeypatch):
    for dense in (0.0, 1.0):
        monkeypatch.setattr(embed_dedup, "DENSE", dense)
        test_embeddings_against_all_pairs(spark)


def test_small_tasks_and_tiles_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "TASK_ROWS", 40)
    monkeypatch.setattr(embed_dedup, "OTHER_ROWS", 25)
    monkeypatch.setattr(embed_dedup, "TILE", 7)
    monkeypatch.setattr(chunks, "BROADCAST_GROUPS", 3)
    test_embeddings_against_all_pairs(spark)


@pytest.mark.parametrize("axes", [1, 3, 8])
def test_links_do_not_depend_on_the_grid(spark, monkeypatch, axes):
    monkeypatch.setattr(embed_dedup, "grid_axes", lambda rows, dims: min(dims, axes))
    test_embeddings_against_all_pairs(spark)


def test_same_id_other_dimensions_and_huge_components(spark):
    rows = [(5, [1.0, 0.0]), (5, [1.0, 0.01]), (6, [0.0, 1.0]), (7, [1.0, 0.0, 0.0]), (3, [2.0, 0.01, 0.0]), (8, [1e200, 1e200]), (9, [1e200, 1.01e200]), (10, [1e-300, 1e-300]), (11, [1.0])]
    d = clashing(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    got = sorted(by_text(embed_dedup.deduplicate(d).collect(), "vec_id", "n_links", "component_id", "kept"))
    assert got == [(3, 1, 3, True), (5, 1, 5, True), (5, 1, 5, True), (6, 0, 6, True), (7, 1, 3, False), (8, 2, 8, True), (9, 2, 8, False), (10, 2, 8, False), (11, 0, 11, True)]


def test_unsound_vectors_link_with_nothing(spark):
    rows = [(1, None), (2, [0.0, 0.0]), (3, [1.0, None]), (4, [1.0, float("nan")]), (5, [1.0, float("inf")]), (6, [1.0]), (7, [1.0, 1.0]), (8, [2.0, 2.0]), (8, [2.0, 2.0]), (9, [])]
    got = sorted(by_text(embed_dedup.deduplicate(vectors(spark, rows)).collect(), "vec_id", "n_links", "component_id", "kept"))
    assert got == [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6)] + [(7, 1, 7, True), (8, 1, 7, False), (8, 1, 7, False), (9, 0, 9, True)]
    assert embed_dedup.deduplicate(vectors(spark, [])).count() == 0


# 2


def exact_components(rows):
    sets = []
    for _, t, *_ in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            b = len(sets[i] & sets[j])
            if b and 100 * b >= 75 * len(sets[i] | sets[j]):
                a, c = sorted((root(i), root(j)), key=lambda k: rows[k][0])
                up[c] = a
    return {r[0]: (len(s), rows[root(i)][0]) for i, (r, s) in enumerate(zip(rows, sets, strict=True))}


def test_near_duplicates_against_all_pairs(spark):
    rng = np.random.default_rng(2)
    rows, k = [], 0
    for _ in range(12):
        base = [f"w{x}" for x in rng.integers(0, 5000, 80)]
        for _ in range(8):
            w = list(base)
            for at in rng.integers(0, 80, rng.integers(0, 6)):
                w[at] = f"z{rng.integers(0, 9999)}"
            rows.append((k, " ".join(w).upper() if k % 3 else " ".join(w)))
            k += 1
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(clashing(spark.createDataFrame(rows, "doc_id bigint, text string"))).collect()}
    assert got == exact_components(rows)


def test_near_duplicates_of_odd_rows(spark, odd):
    got = sorted(by_text(minhash.near_duplicates(odd).collect(), "doc_id", "n_shingles", "component_id", "kept"), key=str)
    assert (None, 5, None, True) in got and (1, 0, 1, True) in got and (3, 0, 3, True) in got
    assert got.count((4, 1, 4, True)) == 2 and (5, 1, 4, False) in got and len(got) == len(ODD)
    assert minhash.near_duplicates(odd.limit(0)).count() == 0


def test_groups_are_compared_in_chunks(spark, monkeypatch):
    for name, value in (("CHUNK", 2), ("PART", 3), ("CHUNK_SHINGLES", 150), ("PART_SHINGLES", 200), ("MAP_BITS", 8)):
        monkeypatch.setattr(minhash, name, value)
    monkeypatch.setattr(chunks, "BROADCAST_GROUPS", 1)
    test_near_duplicates_against_all_pairs(spark)


def chain(n):
    words = [f"w{x}" for x in range(n * 4 + 60)]
    return [(i, " ".join(words[i * 4 : i * 4 + 60])) for i in range(n)]  # shingles 4 or 8 apart: 52 of 60, 48 of 64


@pytest.mark.parametrize("chunk", [1 << 20, 150])
def test_sets_within_a_group_against_all_pairs(spark, monkeypatch, chunk):
    monkeypatch.setattr(minhash, "CHUNK_SHINGLES", chunk)
    monkeypatch.setattr(minhash, "PART_SHINGLES", 4 * chunk)
    rows = chain(40)
    sets = {i: minhash.shingles(t) for i, t in rows}
    comp = {i: 0 if i < 12 else 30 if i >= 36 else i for i in sets}
    members, _ = minhash._apart(spark.createDataFrame([(7, i, comp[i], len(s)) for i, s in sets.items()] + [(8, 900 + i, 900, 5) for i in range(3)], "group bigint, rep bigint, comp bigint, n bigint"), "group")
    assert members.where("group = 8").count() == 0 and members.where("not minor").count() == 12
    found, _ = minhash._within(members, spark.createDataFrame([(i, s.tobytes()) for i, s in sets.items()], "rep bigint, set binary"))
    links = [(r["u"], r["v"]) for r in found.collect()]
    assert all(100 * len(np.intersect1d(sets[u], sets[v])) >= 75 * len(np.union1d(sets[u], sets[v])) and comp[u] != comp[v] for u, v in links)
    up = minhash._Roots()
    for u, v in [*links, *((i, c) for i, c in comp.items() if i < 12 or i >= 36)]:
        up.join(u, v)
    assert len({up.root(i) for i in sets}) == 1


def test_buckets_give_the_best_forest(spark, monkeypatch):
    monkeypatch.setattr(minhash, "CHUNK", 3)
    monkeypatch.setattr(minhash, "PART", 4)
    rng = np.random.default_rng(8)
    base = rng.integers(0, 256, 320, dtype=np.uint8)
    sig = [np.where(rng.random(320) < 0.85, base, rng.integers(0, 256, 320, dtype=np.uint8)) for _ in range(30)]
    comp = [0 if i < 11 else i // 3 for i in range(30)]
    members, _ = minhash._apart(spark.createDataFrame([(5, i, c, s.tobytes()) for i, (c, s) in enumerate(zip(comp, sig, strict=True))], "key bigint, rep bigint, comp bigint, sig binary"), "key")
    found, _ = minhash._across(members)
    links = {(r["u"], r["v"]) for r in found.collect()}
    pairs = sorted((-(sig[i] == sig[j]).mean(), i, j) for i in range(30) for j in range(i + 1, 30) if comp[i] != comp[j] and (sig[i] == sig[j]).mean() >= minhash.AGREE)
    up = minhash._Roots()
    best = {(i, j) for _, i, j in pairs if up.join(comp[i], comp[j])}
    assert pairs and best <= links <= {(i, j) for _, i, j in pairs}


def test_a_chain_of_near_duplicates_is_one_component(spark):
    rows = chain(30)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == exact_components(rows)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 3), (2, 1)]
    got = dict(by_text(components.connected_components(spark.createDataFrame(edges, "u bigint, v bigint")).collect(), "node", "component"))
    assert got == {**{i: 1 for i in range(1, 61)}, **{k: 100 for k in range(100, 140)}}
    assert components.connected_components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


# 3


def test_segments_are_all_maximal_ones():
    rng = np.random.default_rng(0)

    def brute(x):
        """Recursively the best segment, then the best left and right of it."""
        if not x:
            return []
        c = np.concatenate([[0], np.cumsum([v for _, v in x])])
        best = max(((c[b] - c[a], -(b - a), a, b) for a in range(len(x)) for b in range(a + 1, len(x) + 1)), key=lambda t: (round(t[0], 9), t[1]))
        if best[0] <= 1e-12:
            return []
        _, _, a, b = best
        return brute(x[:a]) + [(x[a][0], x[b - 1][0] + 1, best[0])] + brute(x[b:])

    for _ in range(60):
        n = int(rng.integers(1, 25))
        s = [float(v) if rng.random() < 0.4 else -float(rng.choice([0.3, 0.1, 0.7])) for v in rng.random(n) * 2]
        got = toxicity.segments(np.array(s))
        want = brute(list(enumerate(s)))
        assert [(a, b, round(v, 9)) for a, b, v in got] == [(a, b, round(v, 9)) for a, b, v in want]


def toxic_corpus(spark):
    rng = np.random.default_rng(3)
    docs, labels = [], []
    for i in range(400):
        w = [chr(97 + x % 26) + chr(97 + x // 26) for x in rng.integers(0, 300, 40)]  # words of letters: digits part words
        bad = i % 5 == 1
        if bad:
            w[int(rng.integers(0, 40))] = str(rng.choice(["vile", "nasty", "awful"])) + "."
        docs.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    return clashing(spark.createDataFrame(docs, "doc_id bigint, text string")), clashing(spark.createDataFrame(labels + [(None, 1), (9999, 1), (3, None)], "doc_id bigint, toxic int"))


def test_toxic_passages_are_learnt_and_found(spark, odd):
    docs, labels = toxic_corpus(spark)
    model = toxicity.fit(docs, labels)
    assert {w for w, x in model.odds.items() if x > 0} == {b"vile", b"nasty", b"awful"} and model.drift < 0
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    assert all((r["score"] >= 0.5) == (i % 5 == 1) for i, r in got.items())
    hit = got[1]
    assert toxicity.tokens(docs.where("doc_id = 1").first()["text"])[hit["passage_start"]] in model.odds
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] < 0.5 for r in rows)
    assert toxicity.score(docs, toxicity.fit(docs, labels.where("toxic = 0"))).agg({"score": "max"}).first()[0] == 0
    assert toxicity.score(odd.limit(0), model).count() == 0


def test_fit_and_score_against_brute_force(spark):
    docs, labels = toxic_corpus(spark)
    model = toxicity.fit(docs, labels)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    toxic = {}
    for r in labels.collect():
        if r["doc_id"] in texts and r["toxic"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5:
            toxic[r["doc_id"]] = max(r["toxic"], toxic.get(r["doc_id"], 0))
    contexts = {(toxic[i], w[k], w[k - 1], w[k + 1]) for i in toxic for w in [["", *re.findall("[a-z']+", texts[i]), ""]] for k in range(1, len(w) - 1)}
    c = {k: Counter(x[1] for x in contexts if x[0] == k) for k in (0, 1)}
    n = {k: sum(c[k].values()) for k in (0, 1)}
    odds = {}
    for w in {*c[0], *c[1]}:
        a = 0.1 * (c[0][w] + c[1][w])
        d = [math.log((c[k][w] + a) / (n[k] + 0.1 * (n[0] + n[1]) - c[k][w] - a)) for k in (0, 1)]
        if c[0][w] + c[1][w] >= 4 and abs(d[1] - d[0]) >= toxicity.MIN_Z * math.sqrt(sum(1 / (c[k][w] + a) for k in (0, 1))):
            odds[w] = d[1] - d[0]
    assert {k.decode(): v for k, v in model.odds.items()} == pytest.approx(odds)
    assert model.drift == pytest.approx(-max(0, sum(v * c[0][w] for w, v in odds.items()) / n[0] + 0.15))
    for r in toxicity.score(docs, model).collect():
        w = re.findall("[a-z']+", texts[r["doc_id"]])
        walk = [odds.get(x, 0) + model.drift for x in w]
        found = []
        while any(x > 0 for x in walk):  # the best stretch of what is left, again and again
            best = max(((sum(walk[a:b]), a - b, a, b) for a in range(len(walk)) for b in range(a + 1, len(walk) + 1)), default=(0,))
            if best[0] <= 0:
                break
            found.append(best[0])
            walk[best[2] : best[3]] = [-1e9] * (best[3] - best[2])
        e = [math.log(model.k * len(w)) - model.lam * s for s in found]
        b, t = max([0, *(-x for x in e)]), sum(-x for x in e if x <= math.log(0.1))
        z = model.weights[0] + model.weights[1] * math.log1p(b) + model.weights[2] * math.log1p(t)
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-6)


def test_held_out_fold(spark):
    got = toxicity.op3_toxic_passages(spark, SF).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.5) for r in got)


# 4

FORMS = [("assign", r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6), ("access", r"AKIA[A-Z0-9]+", 0, 20), ("hex", r"[0-9a-f]+", 0, 24)]


def base_spans(text):
    found = [(m.start(), k, m.end(), name) for k, (name, form, g, least) in enumerate(FORMS) for m in re.finditer(form, text or "") if len(m[g]) >= least]
    return ",".join(f"{n}:{s}:{e}" for s, _, e, n in sorted(found))


SECRET_TEXTS = ["日 password=abcdef 👩 token: 'x' API_KEY : \"zzzzzz\" secret == \"yyyyyy\"", "AKIA" + "A" * 16 + " secret=" + "0af" * 9, "tokentoken=aaaaaa password:password=bbbbbb", "a" * 24 + "g" + "b" * 23, "AKIAAKIA" + "B" * 12, None, "", "password=" * 50, "Password = AKIA" + "Z" * 20]


def test_base_spans_equal_regular_expressions(spark):
    df = clashing(spark.createDataFrame(list(enumerate(SECRET_TEXTS)), "doc_id bigint, text string"))
    got = {r["doc_id"]: r for r in secrets.scan(df).select("doc_id", "n_assign", secrets.written(secrets.F.col("base")).alias("base")).collect()}
    assert [got[i]["base"] for i in range(len(SECRET_TEXTS))] == [base_spans(t) for t in SECRET_TEXTS]


def test_texts_with_many_secrets(spark, odd):
    text = " ".join(f"password=abc{k:05d}x" for k in range(3000))
    rows = secrets.scan(spark.createDataFrame([(1, text)], "doc_id bigint, text string"))
    got = rows.select("n_assign", secrets.written(rows["spans"]).alias("spans")).first()
    assert got["n_assign"] == 3000 and got["spans"] == base_spans(text)
    got = secrets.scan(odd)
    assert {(r[0], r[1]) for r in got.select(got["n_assign"] + got["n_access"] + got["n_hex"], secrets.written(got["spans"])).collect()} == {(0, "")}


def test_hints_need_their_complement(spark, odd):
    near, far = " x " * 20, " x " * 300
    texts = ["access_key_id=bob99", "access_key_id=bob99" + near + "secret=hunter22", "access_key_id=bob99" + far + "secret=hunter22", "https://a.b/c" + near + "client_id=alice" + near + "token=abcdef12", "https://a.b/c" + near + "token=abcdef12", "aB3" * 13 + "c", "client_id=alice " + "aB3" * 13 + "c"]
    df = spark.createDataFrame([*enumerate(texts), (1, texts[1]), (1, texts[0]), (None, texts[1])], "doc_id bigint, text string")
    rows = secrets.scan(clashing(df)).select("doc_id", secrets.written(secrets.F.col("spans")).alias("s")).collect()
    kinds = {}
    for r in rows:
        kinds.setdefault(r["doc_id"], []).append([x.split(":")[0] for x in r["s"].split(",") if x])
    assert kinds[0] == [[]] and kinds[2] == [["assign"]] and kinds[4] == [["assign"]] and kinds[5] == [[]]
    assert sorted(kinds[1]) == [[], ["identifier", "assign"], ["identifier", "assign"]] and kinds[None] == [["identifier", "assign"]]
    assert kinds[3] == [["endpoint", "identifier", "assign"]] and kinds[6] == [["identifier", "random"]]
    assert secrets.scan(odd).count() == len(ODD) and secrets.scan(odd.limit(0)).count() == 0


def test_links_equal_an_interval_join_by_brute_force(spark):
    rng = np.random.default_rng(8)
    pad = lambda n: (" x" * (n // 2 + 1))[: n - 1] + " "
    texts = ["https://" + "u" * 992 + pad(10) + "client_id=alice" + pad(20) + "secret=hunter22", pad(390) + "aB3d" * 10 + pad(400) + "client_id=alice", "client_id=alice" + pad(400) + "aB3d" * 10]
    forms = ["client_id=alice", "user_name=" + "b" * 700, "aB3d" * 10, "https://" + "u" * 1500, "https://a.b/c", "secret=hunter22", "0af" * 300, "AKIA" + "Q" * 16]
    for _ in range(150):
        texts.append("".join(pad(int(rng.choice([5, 150, 380, 399, 400, 401, 420, 800]))) + str(rng.choice(forms)) for _ in range(rng.integers(2, 6))))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    names = [k[0] for k in (*secrets.STRONG, *secrets.HINTS)]
    want = {}
    for r in secrets.parts(df).collect():
        found = [(p["start"], p["rank"], p["end"]) for k in names for p in r[k]]
        spans = [p for p in found if p[1] < 3]
        for s, k, e in found:
            others = [(names[q], a < e and s < b and q < 3) for a, q, b in found if (a, q) != (s, k) and a <= e + secrets.SCOPE and b >= s - secrets.SCOPE]
            is_id, is_key = any(n in ("access", "identifier") for n, _ in others), any(n in ("assign", "hex", "random") for n, _ in others)
            if k >= 3 and not any(x for _, x in others) and {"identifier": is_key, "random": is_id, "endpoint": is_id and is_key}[names[k]]:
                spans.append((s, k, e))
        want[r["doc_id"]] = sorted(spans)
    got = {r["doc_id"]: [(p["start"], p["rank"], p["end"]) for p in r["spans"]] for r in secrets.scan(df).collect()}
    assert got == want and [names[k] for _, k, _ in got[0]] == ["endpoint", "identifier", "assign"] and len(got[1]) == 2 and len(got[2]) == 2


@pytest.mark.parametrize("text", ["x:80 a" + ".b" * 100_000, "a." * 100_000, "password" * 20_000, "\"'" * 100_000, "://" * 60_000, "AKIA" * 50_000, "9" * 200_000, "aB3" * 60_000, "access_key_" * 20_000])
def test_no_text_overflows_a_pattern(spark, text):
    d = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    found = secrets.scan(d).first()
    spans = [(p["start"], p["end"]) for p in found["spans"]]
    assert secrets.redact(d).first()["text"] == masked_by_hand(text, spans)


def masked_by_hand(text, spans):
    out, at = [], 0
    for s, e in sorted(spans):
        if s >= at:
            out += [text[at:s], secrets.MASK]
        at = max(at, e)
    return "".join(out) + text[at:]


def test_names_with_ports(spark):
    """The one-run form of a dotted name equals labels joined by dots."""
    rng = np.random.default_rng(11)
    texts = ["".join(rng.choice(list("ab-..::8089 9"), 60)) for _ in range(3000)] + ["a.b:80", "a..b:80.c.d:443", ".a.b:80", "a.b.:80", "a:80", "-.-:12345", "a.b:123456", "a.b:8"]
    import re

    labels = re.compile(r"(?<![A-Za-z0-9.-])[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+:[0-9]{2,5}(?![0-9])")
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: [(p["start"], p["end"]) for p in r["endpoint"]] for r in secrets.parts(d).select("doc_id", "endpoint").collect()}
    assert got == {k: [m.span() for m in labels.finditer(t)] for k, t in enumerate(texts)} and sum(map(len, got.values())) > 100


def test_masking_equals_slices(spark):
    rng = np.random.default_rng(12)
    rows = []
    for k in range(60):
        n = int(rng.integers(0, 9000))
        text = "".join(rng.choice(list("ab é😀\n"), n))
        spans = sorted((int(s), int(min(n, s + rng.integers(1, 2000 if k % 3 else 40)))) for s in rng.integers(0, max(1, n), rng.integers(0, 600 if k % 2 else 4)) if n)
        rows.append((k, text, [(s, 0, e) for s, e in spans]))
    d = spark.createDataFrame(rows, "doc_id bigint, text string, spans array<struct<start:bigint,rank:int,end:bigint>>")
    got = {r[0]: r[1] for r in d.select("doc_id", secrets.masked(d["text"], d["spans"])).collect()}
    assert got == {k: masked_by_hand(t, [(s, e) for s, _, e in spans]) for k, t, spans in rows}


@pytest.mark.parametrize("few", [True, False])
def test_redaction_of_linked_hints(spark, monkeypatch, few):
    if not few:
        monkeypatch.setattr(secrets, "BROADCAST_GROUPS", 1)
    rows = [(k, t) for k, t in enumerate(["client_id: someone9 then password=abcdef1", "client_id: someone9 alone", "see db.host.net:5432 user_name=anna99 token=zzzzzz9", None, "", "client_id: someone9 then password=abcdef1"] * 2)] + [(None, "client_id: other99 secret=qwerty7"), (None, "client_id: other99 secret=qwerty7")]
    d = clashing(spark.createDataFrame(rows, "doc_id bigint, text string"))
    spans = {(r["doc_id"], r["key"]): [(p["start"], p["end"]) for p in r["spans"]] for r in secrets.scan(d).collect()}
    keys = {(r[0], r[1]): r[2] for r in d.select("doc_id", secrets.F.coalesce("text", secrets.F.lit("")), secrets.F.xxhash64(secrets.F.coalesce("text", secrets.F.lit("")))).collect()}
    want = [(str(i), t if t is None else masked_by_hand(t, spans[(i, keys[(i, t or "")])])) for i, t in rows]
    got = sorted(((str(r["doc_id"]), r["text"]) for r in secrets.redact(d).collect()), key=str)
    assert got == sorted(want, key=str) and any("[secret] then" in (t or "") for _, t in got)


def test_redaction_masks_spans_only(spark):
    df = spark.createDataFrame([(i, t, len(t or "")) for i, t in enumerate(SECRET_TEXTS)], "doc_id bigint, text string, n_chars int")
    got = {r["doc_id"]: r for r in secrets.redact(clashing(df)).collect()}
    assert set(got[0].asDict()) == set(clashing(df).columns)
    assert got[0]["text"] == "日 [secret] 👩 token: 'x' [secret]\" secret == \"yyyyyy\"" and got[0]["n_chars"] == len(got[0]["text"]) and got[5]["text"] is None
    assert got[1]["text"] == "[secret] [secret]" and got[3]["text"] == "[secret]g" + "b" * 23


# 5


def brute_scores(rows):
    grams = []
    for _, t, *_ in rows:
        w = (t or "").encode().lower().split()
        grams.append((w, Counter(tuple(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1))))
    total = sum((c for _, c in grams), Counter())
    words = sum(len(w) for w, _ in grams)
    out = []
    for w, c in grams:
        rest = lambda g: total[g] - c[g]  # noqa: B023, E731

        def s(g):
            if len(g) == 1:
                return math.log(rest(g) / (words - len(w))) if rest(g) else -math.log(words - len(w) + 1)
            return math.log(rest(g) / rest(g[:-1])) if rest(g) else math.log(0.4) + s(g[1:])

        out.append((len(w), round(sum(s(tuple(w[max(0, k - 2) : k + 1])) for k in range(len(w))), 5)))
    return out


def test_scores_against_counting(spark, documents, monkeypatch):
    rows = [tuple(r) for r in documents.select("doc_id", "text").limit(60).collect()] + [(-1, None), (-2, ""), (-3, "the THE the"), (-4, "the"), (-4, "the")]
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(lm_score, "PARTITION_GRAMS", 9_000)
    got = lm_score.score(clashing(spark.createDataFrame(rows, "doc_id bigint, text string"))).collect()
    assert sorted((r["doc_id"], r["n_words"], round(r["log_score"], 5)) for r in got) == sorted((i, n, s) for (i, _), (n, s) in zip(rows, brute_scores(rows), strict=True))
    assert next(r for r in got if r["doc_id"] == -2)["mean_log"] is None


def test_scores_tell_ngrams_apart(spark, documents, monkeypatch):
    # No word occurs twice, so no n-gram of a document is in another.
    rows = [(i, " ".join(f"w{x}" for x in range(i * 250_000, (i + 1) * 250_000))) for i in range(4)]
    assert [r["n_seen"] for r in lm_score.score(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()] == [0] * 4
    # Neither does an n-gram's count depend on those that share its hash.
    monkeypatch.setattr(lm_score, "HASH_BITS", 8)
    test_scores_against_counting(spark, documents, monkeypatch)


def test_count_table_holds_every_ngram(spark, documents, monkeypatch):
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(lm_score, "PARTITION_GRAMS", 9_000)
    rows = [r[0] for r in documents.select("text").limit(40).collect()]
    grams = Counter()
    for t in rows:
        w = (t or "").encode().lower().split()
        grams.update(tuple(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1))
    got = lm_score.count_table(spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")).collect()
    assert sorted(r["n"] for r in got) == sorted(grams.values()) and len({(r["gram"], r["check"]) for r in got}) == len(grams)


def test_packed_numbers_come_back():
    for x in ([], [0], [1 << 63], list(range(300)), [(1 << 40) + i for i in range(70)]):
        assert lm_score._expand(lm_score._squeeze(np.array(x, np.uint64))).tolist() == x


def test_scores_of_odd_rows(spark, odd):
    assert lm_score.score(odd).count() == len(ODD) and lm_score.score(odd.limit(0)).count() == 0


# SQL


@pytest.mark.parametrize("name", ["op1_embedding_dedup", "op2_minhash_dedup", "op5_lm_score", "op10_warc_round_trip"])
def test_query_equals_sql(spark, name):
    import duckdb

    from loopweaver.llm import queries

    df = queries.QUERIES[name](spark, SF)
    names = sorted(df.columns)
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet{'/*.parquet' if os.path.isdir(f'{SF}/{t}.parquet') else ''}')")
    want = c.execute(f"SELECT {', '.join(names)} FROM ({queries.ORACLE[name]})").fetchall()
    assert sorted(map(str, map(tuple, df.select(names).collect()))) == sorted(map(str, want)) and want


# 6


def js(p, q):
    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    m = [(a + b) / 2 for a, b in zip(p, q, strict=True)]
    kl = lambda x: sum(a * math.log2(a / b) for a, b in zip(x, m, strict=True) if a)
    return math.sqrt(max(0, (kl(p) + kl(q)) / 2))


def brute_class(c):
    if c == "\n":
        return "newline"
    if c in " \t\r\x0b\x0c":
        return "blank"
    if ord(c) < 32:
        return "control"
    if ord(c) >= 128:
        return "latin" if ord(c) < 0x400 else "wide" if ord(c) < 0x10000 else "astral"
    kinds = (("lower", c.islower()), ("upper", c.isupper()), ("digit", c.isdigit()), ("stop", c in ".,;:!?"), ("quote", c in "'\"()-"), ("symbol", c in "#*$%&|<>"))
    return next((k for k, hit in kinds if hit), "mark")


def test_quality_verdicts_against_brute_force(spark, documents):
    from pyspark.sql import functions as F

    junk = [(10**6 + k, t, "en") for k, t in enumerate(["qx " * 3 + " ".join(f"zq{a}{b}" for a in "abcdefgh" for b in "ijklmnopqrst"), "#$% " * 120 + "the of", "the of and to " * 30])]
    docs = documents.select("doc_id", "text", F.when(F.col("doc_id") % 17 == 0, None).otherwise(F.col("lang")).alias("lang")).union(spark.createDataFrame(junk, "doc_id bigint, text string, lang string"))
    rows = [tuple(r) for r in docs.collect()]
    bare = {i: re.findall(r"[a-z'\x80-\U0010ffff]+", fold_ascii(text)) for i, text, _ in rows}
    seen = {i: Counter(w) for i, w in bare.items()}
    common, hist, refs = {}, {}, {}
    for lang in {r[2] for r in rows} | {None}:
        own = [i for i, _, x in rows if lang is None or x == lang]
        found = Counter(w for i in own for w in seen[i])
        often = [w for w in found if found[w] >= max(5, 0.2 * len(own))]
        common[lang] = sorted(often, key=lambda w: (-found[w], w.encode()))[:32]
        for i, text, x in rows:
            if lang is None or x == lang:
                kinds = Counter(map(brute_class, text or ""))
                hits = [seen[i][w] for w in common[lang]]
                hist[(i, lang)] = [kinds[k] for k in quality.CLASSES], [*hits, len(bare[i]) - sum(hits)]
        refs[lang] = [[sum(x) for x in zip(*(hist[(i, lang)][k] for i in own), strict=True)] for k in (0, 1)]
    got = {r["doc_id"]: r for r in quality.quality_rules(docs).collect()}
    reasons = Counter()
    for i, text, lang in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        windows = Counter(zip(words, words[1:], words[2:], strict=False))
        often = {k + o for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for o in range(3)}
        failed = len(words) < 50 or 100 * len(often) > 50 * len(words)
        mine = hist[(i, lang)]
        far = [js(mine[k], refs[lang][k]) if sum(mine[k]) else 0 for k in (0, 1)]
        ref, none = refs[lang][1], [0] * len(common[lang]) + [1]
        expected = sum(mine[1]) * (1 - ref[-1] / sum(ref))
        lacks = expected >= quality.GUARD_COMMON and far[1] >= min(js(none, ref), js(mine[1], none))
        bad = [n for n, hit in (("class", far[0] > 0.25), ("word", far[1] > 0.6), ("lacks", lacks)) if hit]
        kept = not failed and (len(words) < quality.GUARD_WORDS or not bad)
        reasons.update(bad if not failed else ["base"])
        assert (got[i]["base_failed"], got[i]["kept"]) == (failed, kept), i
        assert got[i]["class_distance"] == pytest.approx(far[0], abs=1e-6) and got[i]["word_distance"] == pytest.approx(far[1], abs=1e-6)
    assert reasons["base"] and reasons["class"] and reasons["lacks"]
    # The pipeline's filter keeps the same rows.
    assert sorted(r["doc_id"] for r in quality.good_rows(docs).collect()) == sorted(i for i, r in got.items() if r["kept"])


def test_common_words_are_learnt(spark):
    rng = np.random.default_rng(9)
    makes = lambda words, k: [(k + i, " ".join(rng.choice(words + [f"{w}{chr(97 + x)}" for w in words[:3] for x in range(26)], 200, p=[0.5 / len(words)] * len(words) + [0.5 / 78] * 78)), "qq" if k < 1000 else "rr") for i in range(40)]
    one, two = ["ba", "ko", "mi", "tu", "re", "sa"], ["xel", "vor", "nim", "pag", "dus", "fir"]
    swapped = [(i + 5000, t, "rr" if lang == "qq" else "qq") for i, t, lang in (makes(one, 0)[:1] + makes(two, 1000)[:1])]
    docs = spark.createDataFrame(makes(one, 0) + makes(two, 1000) + swapped, "doc_id bigint, text string, lang string")
    known = {r["ref_lang"]: r for r in quality.languages(docs).collect()}
    assert set(one) <= {bytes(w).decode() for w in known["qq"]["common"]} and len(known["qq"]["common"]) == 32 and len(known["rr"]["ref_words"]) == 33 and set(known) == {"qq", "rr", None}
    got = {r["doc_id"]: r["kept"] for r in quality.quality_rules(docs).collect()}
    assert [i for i, k in got.items() if not k] == [5000, 6000]


def brute_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    tri = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {t for t, n in Counter(tri).items() if n > 1}
    inside = {i + k for i, t in enumerate(tri) if t in often for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


def test_quality_counts(spark, documents, odd):
    rows = [tuple(r) for r in documents.select("doc_id", "text", "lang").collect()]
    got = sorted(by_text(quality.quality_rules(documents).collect(), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
    assert got == sorted((i, *brute_quality(t)) for i, t, _ in rows)
    got = quality.quality_rules(odd).collect()
    assert sorted(by_text(got, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == sorted(brute_quality(t) for _, t, _ in ODD)
    assert not any(r["kept"] for r in got) and quality.quality_rules(odd.limit(0)).count() == 0


def test_quality_verdicts_follow_the_distance(spark):
    rng = np.random.default_rng(1)
    plain = [(i, " ".join(rng.choice(["the", "of", "stone", "river", "and", "to", "green"], 120)), "en") for i in range(80)]
    junk = [(1000, "#$% " * 120 + "a b c", "en"), (1001, " ".join(f"{x}|{x}|" for x in range(200)), "en")]
    got = {r["doc_id"]: r for r in quality.quality_rules(spark.createDataFrame(plain + junk, "doc_id bigint, text string, lang string")).collect()}
    assert not got[1000]["kept"] and not got[1001]["kept"] and got[1001]["class_distance"] > 0.4
    assert all(got[i]["kept"] for i in range(80) if not got[i]["base_failed"])


def test_junk_of_plain_letters_is_rejected(spark):
    rng = np.random.default_rng(7)
    plain = [(i, " ".join(rng.choice(["the", "of", "and", "to", "in", *(f"stone{chr(97 + x)}" for x in range(15))], 150)), "en") for i in range(80)]
    letters = lambda: "".join(rng.choice(list("abcdefghij"), 6))
    junk = [(1000, " ".join(letters() for _ in range(150)), "en"), (1001, " ".join(["the", *(letters() for _ in range(149))]), "en"), (1002, " ".join(letters() if k % 4 else "una" for k in range(150)), "en")]
    # A language whose texts share no words is not judged by them; one that does is, whatever its words.
    other = [(2000 + i, " ".join(letters() for _ in range(150)), "xx") for i in range(20)]
    got = {r["doc_id"]: r for r in quality.quality_rules(spark.createDataFrame(plain + junk + other, "doc_id bigint, text string, lang string")).collect()}
    assert [i for i, r in got.items() if not r["kept"] and not r["base_failed"]] == [1000, 1001, 1002]


def test_every_language_has_its_own_reference(spark, monkeypatch):
    monkeypatch.setattr(quality, "WORDS_AT_ONCE", 7)
    rng = np.random.default_rng(9)
    text = lambda letters: " ".join("".join(rng.choice(list(letters), 5)) for _ in range(150))
    rows = [(100 * k + i, text("abcdefgh"), f"l{k:02}") for k in range(70) for i in range(3)] + [(9000 + i, text("бвгджзкл"), "zz") for i in range(2)] + [(9100, text("abcdefgh"), None), (9101, text("бвгджзкл"), None), (9102, text("abcdefgh"), "*"), (9103, text("abcdefgh"), "")]
    got = {r["doc_id"]: r for r in quality.quality_rules(spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)).collect()}
    assert len(got) == len(rows) and [i for i, r in got.items() if not r["kept"]] == [9101]
    classes = {i: np.array(quality.text_features(t, [])[5]) for i, t, _ in rows}
    assert abs(got[9000]["class_distance"] - quality.jensen_shannon(classes[9000][None], classes[9000] + classes[9001])[0]) < 1e-12
    assert abs(got[9101]["class_distance"] - quality.jensen_shannon(classes[9101][None], sum(classes.values()))[0]) < 1e-12


def test_jensen_shannon():
    assert quality.jensen_shannon(np.array([[1, 1], [2, 0], [0, 0]]), np.array([5, 5])).round(6).tolist() == [0, round(math.sqrt(1 - 0.75 * math.log2(3) + 0.5), 6), 0]


# 7


def check_packing(rows, pieces):
    e = packing.encoder()
    ids = [(i, tuple([*e.tokenizer.encode(t or "", add_special_tokens=False).ids, 0])) for i, t, *_ in rows]
    sums: dict = {}
    for r in pieces:
        sums.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], r["doc_id"], r["start"], tuple(r["ids"]), r["doc_tokens"], r["ids_crc32"]))
    held: dict = {}
    for s in sums.values():
        at = 0
        for o, n, i, start, x, total, crc in sorted(s):
            assert o == at and len(x) == n and zlib.crc32(np.array(x, "<u4").tobytes()) == crc
            held.setdefault(i, Counter())[(start, x, total)] += 1
            at += n
        assert at <= 1024 and (at == 1024 or at & (at - 1) == 0)
    for i in {i for i, _ in ids}:
        want = Counter(x for k, x in ids if k == i)
        have = held[i]
        assert sum(len(x) * n for (_, x, _), n in have.items()) == sum(len(x) * n for x, n in want.items())
        if len(want) == 1 and sum(want.values()) == 1:
            assert tuple(v for _, x, _ in sorted(have) for v in x) == next(iter(want))


def test_packing_holds_every_id_once(spark, documents, odd):
    check_packing([tuple(r) for r in documents.select("doc_id", "text").collect()], packing.pack(documents, with_ids=True).collect())
    check_packing(ODD, packing.pack(odd, with_ids=True).collect())
    assert packing.pack(odd.limit(0)).count() == 0


def test_partitions_grow_with_the_texts(spark, documents, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(packing, "PARTITION_BYTES", max(1, packing._bytes(documents) // 12))
    got = packing.pack(documents)
    assert got.select(F.shiftright("sequence_id", 40)).distinct().count() in (12, 13)
    assert got.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t")).where("n <> t").count() == 0


def test_pieces_follow_the_curve(spark, documents, monkeypatch):
    """Within a partition documents begin in the order of their keys, worked out again, and partitions are ranges of keys."""
    monkeypatch.setattr(packing, "PARTITION_BYTES", max(1, packing._bytes(documents) // 5))
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in documents.select("doc_id", "text").collect()}
    key = dict(zip(texts, np.asarray(packing.curve_keys(list(texts.values()))).tolist(), strict=True))
    begun: dict = {}
    for r in sorted((r["sequence_id"], r["offset"], r["doc_id"]) for r in packing.pack(documents).where("start = 0").collect()):
        begun.setdefault(r[0] >> 40, []).append(key[r[2]])
    assert len(begun) > 3 and sum(map(len, begun.values())) == len(texts)
    along = [k for p in sorted(begun) for k in begun[p]]
    assert along == sorted(along) and len(set(along)) > len(along) / 2


def test_equal_rows_are_spread(spark):
    from pyspark.sql import functions as F

    rows = [(None, "the same text in every row")] * 400 + [(7, "the same text in every row")] * 400
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = packing.pack(spark.createDataFrame(rows, "doc_id bigint, text string")).withColumn("part", F.shiftright("sequence_id", 40))
        parts = got.groupBy("part").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert 4 <= len(parts) and max(r["count"] for r in parts) < 400 and got.agg({"length": "sum"}).first()[0] == got.select("doc_tokens").first()[0] * 800


def test_fast_encoder_equals_the_tokenizer():
    e = packing.encoder()
    assert e.fast is not None
    for t in ["", " a  b\n\n c\t", "don't I'LL", "x" * 2000, " " * 3000 + "y", "<|endoftext|>z<|endoftext|>", "日本 é👩‍👩‍👧\x00\x85"]:
        assert e.ids(t).tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids


def test_hilbert_curve_steps_by_one():
    x = np.array([[a, b, c] for a in range(8) for b in range(8) for c in range(8)])
    k = packing.hilbert_key(x, 3)
    assert sorted(k) == list(range(512)) and (np.abs(np.diff(x[np.argsort(k)], axis=0)).sum(1) == 1).all()


def test_vectors_do_not_depend_on_neighbours_or_steps(monkeypatch):
    texts = [b"a b c", b"", b"The the THE", b"zz " * 500, b"q"]
    whole = packing.document_vectors(texts)
    assert np.allclose(whole, np.concatenate([packing.document_vectors([t]) for t in texts]))
    monkeypatch.setattr(packing, "_STEP", 64)
    assert np.allclose(packing.document_vectors(texts), whole) and packing.curve_keys([b"x", b"x"]).tolist()[0] == packing.curve_keys([b"y", b"x"]).tolist()[1]


# 8


def bpe_texts(documents):
    rng = np.random.default_rng(4)
    pool = list("aZ'sß éÉ́  \n\t<|>#9½👩日‍İΣ\x1f\x7f\x00ͅſ\ue000stredvml") + ["<|startoftext|>", "<|endoftext|>", "　", "'s", "'ll", "'re"]
    return [r[0] for r in documents.select("text").collect()] + [x[1] for x in ODD] + ["".join(rng.choice(pool, rng.integers(1, 30))) for _ in range(2000)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_bpe_equals_the_tokenizer(documents, name):
    from tokenizers import Tokenizer

    path = bpe.vocabulary_path(name)
    t = Tokenizer.from_file(path)
    texts = bpe_texts(documents)
    c = bpe.Codec(path)
    assert c.cut and c.words_only == (name == bpe.VOCABULARY)
    found = [list(bpe._documents(c, [(x or "").encode() for x in texts[i : i + 400]])) for i in range(0, len(texts), 400)]
    for text, ids in zip(texts, [x for f in found for x in f], strict=True):
        want = t.encode(text or "", add_special_tokens=False).ids
        assert ids == want, text
        assert c.decode(ids).decode() == t.decode(want, skip_special_tokens=False)


def test_bpe_queries(spark, odd):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.vocabulary_path())
    rows = bpe.round_trip_digests(odd).collect()
    assert len(rows) == len(ODD) and bpe.round_trip_digests(odd.limit(0)).count() == 0
    r = next(r for r in rows if r["doc_id"] == 2)
    assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (0, hashlib.sha256(b"").hexdigest(), hashlib.sha256(b"").hexdigest())
    ids = bpe.encode_documents(odd)
    assert {(r["doc_id"], r["text"]) for r in bpe.decode_documents(ids).collect()} == {(i, t.decode(t.encode(x or "", add_special_tokens=False).ids, skip_special_tokens=False)) for i, x, _ in ODD}


def test_another_normalizer_or_decoder_is_seen(tmp_path):
    import json

    from tokenizers import Tokenizer

    spec = json.loads(open(bpe.vocabulary_path(), encoding="utf-8").read())
    spec["normalizer"], spec["decoder"] = {"type": "NFC"}, {"type": "BPEDecoder", "suffix": "</w>"}
    path = str(tmp_path / "other.json")
    open(path, "w", encoding="utf-8").write(json.dumps(spec))
    c, t = bpe.Codec(path), Tokenizer.from_file(path)
    assert c.cut and not c.words_only and not c.joins
    for text in ("Hello, World's end", "ÉTÉ <|endoftext|> x", ""):
        want = t.encode(text, add_special_tokens=False).ids
        assert c.encode(text) == want and c.decode(want).decode() == t.decode(want, skip_special_tokens=False)


def test_kept_entries_are_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 10)
    c, fresh = bpe.Codec(bpe.vocabulary_path()), bpe.Codec(bpe.vocabulary_path())
    for k in range(8):
        text = " ".join(f"w{k}{x}" for x in range(8)) + " w00 w01 <|endoftext|>"
        sizes, ids = c.batch([text.encode(), b"", b"w00"])
        assert ids.tolist() == fresh.tokenizer.encode(text, add_special_tokens=False).ids + fresh.tokenizer.encode("w00", add_special_tokens=False).ids and sizes[1] == 0
        assert all(len(g[0]) <= 21 for pool in (c.runs, c.last, c.inner) for g in (pool.now, pool.before))


def test_cuts_are_certain():
    c = bpe.Codec(bpe.vocabulary_path())
    for w in ("ßzüqj", "hello", "xqzjkvw"):
        raw = np.frombuffer(w.encode(), np.uint8)
        ends = np.zeros(len(raw), bool)
        ends[-1] = True
        starts, sizes, ids = c._fragments(raw, ends)
        assert ids.tolist() == c.tokenizer.encode(w, add_special_tokens=False).ids
        assert [not c.joined[raw[i - 1], raw[i]] for i in range(1, len(raw))] == [i in starts for i in range(1, len(raw))]


# 9


def test_license_phrases_and_templates(spark, odd):
    texts = ["Under the MIT-License; mit license. (MIT) license", "CC\nBY and ccby", "prefix " + licenses.TEMPLATES["bsd-notice"].upper().replace(" ", "\n", 3), licenses.TEMPLATES["bsd-notice"][:60], "The Apache Licenses"]
    got = {r["doc_id"]: r for r in licenses.scan(clashing(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))).collect()}
    assert (got[0]["n_base"], got[0]["first_word"], got[0]["last_word"], got[0]["base_labels"]) == (3, 2, 6, "mit") and got[0]["score"] == 1
    assert (got[1]["n_base"], got[1]["base_labels"]) == (1, "cc-by")
    assert got[2]["base_labels"] == "" and got[2]["labels"] == "bsd-notice" and got[2]["score"] >= 0.9
    assert got[3]["labels"] == "" and got[3]["score"] == 0 and got[3]["first_word"] is None and got[4]["n_base"] == 0
    assert licenses.scan(odd).count() == len(ODD) and licenses.scan(odd.limit(0)).count() == 0


def brute_templates(text, templates, containment=licenses.CONTAINMENT, slack=licenses.SLACK):
    ws, out = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold_ascii(text)), {}
    for k, t in templates.items():
        tw = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold_ascii(t))
        n, want = math.ceil(slack * len(tw)), set(tw)
        best = max((len(want.intersection(ws[i : i + n])) for i in range(max(1, len(ws) - n + 1))), default=0)
        if best >= math.ceil(containment * len(want) - 1e-9) and best:
            out[k] = best / len(want)
    return out


def fold_ascii(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_containment_join_loses_nothing():
    rng = np.random.default_rng(6)
    names = [f"w{i}" for i in range(30)]
    templates = {f"t{k}": " ".join(rng.choice(names, rng.integers(3, 12))) for k in range(8)}
    index = licenses.Index({n.encode(): int(c) for n, c in zip(names, rng.integers(0, 50, 30), strict=True)}, templates, 0.7)
    for _ in range(1000):
        ws = [*rng.choice([*names, *[f"x{i}" for i in range(rng.integers(1, 200))]], rng.integers(0, 120))]
        assert licenses.find(index, [w.encode() for w in ws]) == pytest.approx(brute_templates(" ".join(ws), templates, 0.7))
    # Every filter leaves out some pairs, and verification some of the rest.
    seen = index.seen
    assert seen["prefix"] > seen["length"] > seen["position"] > seen["met"] > 0


def test_license_scan_against_brute_force(spark, documents):
    rows = [r[0] for r in documents.select("text").collect()]
    rows += [x[1] for x in ODD]
    long = licenses.TEMPLATES["mit-text"].split()
    rows += ["\n".join(long), " ".join(x for i in range(0, len(long), 10) for x in [*long[i : i + 10], "\n"]), " ".join(f"{w} {'x ' * 300}" for w in "copyright all rights reserved".split()), "\n".join("Copyright All rights reserved".split())]
    got = licenses.scan(spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")).collect()
    assert len(got) == len(rows)
    for r in got:
        text = fold_ascii(rows[r["doc_id"]])
        ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
        base = [(i, label) for i in range(len(ws)) for p, label in licenses.PHRASES.items() if ws[i : i + len(p.split())] == p.split()]
        more = brute_templates(text, licenses.TEMPLATES)
        names = {x for _, x in base}
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(ws), len(base), base[0][0] if base else None, base[-1][0] if base else None)
        assert (r["base_labels"], r["labels"]) == (",".join(sorted(names)), ",".join(sorted(names | more.keys())))
        assert r["score"] == pytest.approx(1.0 if base else max(more.values(), default=0.0))
    by_id = {r["doc_id"]: r["labels"].split(",") for r in got}
    n = len(rows) - 4
    assert "mit-text" in by_id[n] and "mit-text" in by_id[n + 1] and by_id[n + 2] == [""] and by_id[n + 3] == ["all-rights-reserved"]


# 10


def pages(spark, rows):
    return clashing(spark.createDataFrame(rows, "page_id bigint, url string, html string"))


def test_archives_round_trip_and_split(spark):
    rows = [(i, f"http://x/{i}", f"x{i % 3}" * (600 if i % 2 else 100)) for i in range(40)] + [(None, None, None), (None, "u", "x1" * 600), (7, "u", "x1" * 600), (99, "u\r\nX: y", "é" * 500), (50, "u", "WARC/1.0\r\n\r\n" + "\x1f\x00" * 900)]
    manifest = warc.write(pages(spark, rows).coalesce(2))
    newest = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 1000:
            newest[h] = max(i, newest.get(h, -1))
    want = []
    for i, _, h in rows:
        raw = (h or "").encode()
        to = newest.get(h)
        revisit = to is not None and (i is None or i < to)
        want.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", to if revisit else None))
    for size in (97, 400, 1 << 20):
        got = warc.read(manifest, size).collect()
        assert sorted(by_text(got, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"), key=str) == sorted(want, key=str)
    assert all(bytes(r["payload"]) == next(h or "" for i, _, h in rows if i == r["page_id"]).encode() for r in got if r["record_type"] == "response" and r["page_id"] is not None)
    assert warc.read(warc.write(pages(spark, []))).count() == 0


def test_many_copies_are_joined_by_salted_digests(spark, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_GROUPS", 1)
    monkeypatch.setattr(warc, "SALTS", 3)
    test_archives_round_trip_and_split(spark)


def test_records_are_read_in_linear_time(monkeypatch):
    """Bytes read from the file and bytes given to the inflater, not seconds."""

    class Counting(io.BytesIO):
        bytes_read = 0

        def read(self, *args):
            out = super().read(*args)
            Counting.bytes_read += len(out)
            return out

    fed = []
    make = zlib.decompressobj

    class Inflater:
        def __init__(self, *args):
            self.inner = make(*args)

        def decompress(self, data, *args):
            fed.append(len(data))
            return self.inner.decompress(data, *args)

        def __getattr__(self, name):
            return getattr(self.inner, name)

    monkeypatch.setattr(warc.zlib, "decompressobj", Inflater)
    work = {}
    for n in (2, 8):
        data = warc.record(1, "u", np.random.default_rng(n).bytes(n << 20)) + warc.record(2, "u", b"b")
        Counting.bytes_read = 0
        fed.clear()
        got = [warc.page_of(warc.parse(r)[0]["warc-record-id"]) for r in warc.owned(Counting(data), 0, len(data), len(data))]
        assert got == [1, 2] and fed
        work[n] = (Counting.bytes_read / len(data), sum(fed) / len(data))
    assert max(work[8]) < 3 and all(b < 1.5 * a + 0.1 for a, b in zip(work[2], work[8], strict=True))


def test_places_of_magic_across_steps():
    data = b"ab" + b"xyz" * 3 + b"q" * 7 + b"xyz"
    for step in (3, 4, 5, 64):
        source = warc.Source(io.BytesIO(data), 1, len(data), step)
        assert [source.find(b"xyz", at, len(data)) for at in range(1, len(data))] == [data.find(b"xyz", at) for at in range(1, len(data))]
        assert source.find(b"xyz", 12, 18) == -1 and source.find(b"xyz", 12, 19) == 18
    assert warc.arrow_uri("s3a://b/k") == "s3://b/k" and warc.arrow_uri("file:///x") == "file:///x" and warc.arrow_uri("/x") == "/x"


def test_scratch_leaves_only_its_result(spark, tmp_path):
    import os

    from loopweaver.llm import common, queries

    before = set(os.listdir(common.shared_dir(spark).removeprefix("file://")))
    for name in queries.QUERIES:
        if name != "op2_minhash_dedup":
            out = queries.QUERIES[name](spark, SF)
            left = set(os.listdir(common.shared_dir(spark).removeprefix("file://"))) - before
            assert len({x for x in left if not x.startswith(".")}) <= 1 and out.count(), (name, left)
            common.unstash(out)


def test_headers_of_any_length_are_read(spark):
    url = "http://x/" + np.random.default_rng(10).bytes(1_500_000).hex()
    got = warc.read(warc.write(pages(spark, [(1, url, "a"), (2, "u", "b")])), 100_000).collect()
    assert sorted((r["page_id"], r["url"] == url, bytes(r["payload"])) for r in got) == [(1, True, b"a"), (2, False, b"b")]


def test_false_magic_is_not_a_record():
    good = [warc.record(i, "u", bytes([i % 256]) * 50) for i in range(20)]
    noise = warc.MAGIC + b"\x00" * 30 + zlib.compress(b"WARC/1.0\r\n") + warc.MAGIC
    data = b"".join(noise + r for r in good)
    for size in (1, 13, 64, 10_000):
        got = [warc.page_of(warc.parse(r)[0]["warc-record-id"]) for s in range(0, len(data), size) for r in warc.owned(io.BytesIO(data), s, min(len(data), s + size), len(data))]
        assert got == list(range(20))
