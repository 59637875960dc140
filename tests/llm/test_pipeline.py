"""The pipeline's stages, against brute force where they can be, and over odd rows."""

import numpy as np
import pytest

pytest.importorskip("corpus_pipeline")

import corpus_pipeline as pipeline  # noqa: E402
from loopweaver.llm import minhash, quality, secrets, toxicity  # noqa: E402
from loopweaver.llm.common import stash  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages_filter_and_keep_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, kept = docs.columns, {}
    for name, stage in pipeline.STAGES[:4]:
        before = docs
        docs = stash(stage(spark, docs, SF))
        assert docs.columns == names and docs.schema == before.schema
        kept[name] = {r[0] for r in docs.select("doc_id").collect()}
        if name == "quality rules":
            assert kept[name] == {r["doc_id"] for r in quality.quality_rules(before).where("kept").collect()}
        if name == "toxicity":
            model = toxicity.fit(before, spark.read.parquet(f"{SF}/labels.parquet"))
            assert kept[name] == {r["doc_id"] for r in toxicity.score(before, model).where("score < 0.5").collect()} and len(kept[name]) < before.count()
        if name == "near-dedup":
            assert kept[name] == {r["doc_id"] for r in minhash.near_duplicates(before).where("kept").collect()}
        if name == "secret scans":
            assert docs.count() == before.count() and secrets.scan(docs).where("size(base) > 0").count() == 0
            assert docs.where("n_chars <> length(text)").count() == before.where("n_chars <> length(text)").count()
    pieces = stash(pipeline.STAGES[4][1](spark, docs, SF))
    assert {r[0] for r in pieces.select("doc_id").distinct().collect()} == kept["secret scans"]


def test_dedup_of_repeated_and_nameless_rows(spark):
    long = " ".join(f"{a}{b}" for a in "abcdefgh" for b in "ijklmnopqrst")
    other = " ".join(reversed(long.split()))
    third = " ".join(x + "q" for x in long.split())
    rows = [(None, third, "z"), (None, third, "z"), (1, other, "b"), (2, long, "c"), (2, long, "a"), (5, long, "a"), (7, third, "y"), (7, other, "x")]
    for extra in ([], [(9, "one two", "k"), (9, "one two", "j")]):
        got = sorted(pipeline.dedup_stage(spark, spark.createDataFrame(rows + extra, "doc_id bigint, text string, lang string"), SF).collect(), key=str)
        want = [(None, third, "z"), (None, third, "z"), (1, other, "b"), (2, long, "a"), (7, third, "y"), (7, other, "x"), *extra[1:]]
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_a_very_long_text_passes_every_stage(spark, tmp_path):
    rng = np.random.default_rng(1)
    words = "the of and to a in is that with was river stone light green walk table under seven north open".split()
    text = " ".join(f"{w}{chr(97 + x)}" if x < 12 else w for w, x in zip(rng.choice(words, 120_000), rng.integers(0, 26, 120_000), strict=True)) + " password=abcdef1"
    docs = spark.createDataFrame([(1, text, "en", len(text))], "doc_id bigint, text string, lang string, n_chars bigint")
    spark.createDataFrame([(1, 0)], "doc_id bigint, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    now = docs
    for _, stage in pipeline.STAGES[:4]:
        now = stash(stage(spark, now, str(tmp_path)))
    r = now.collect()
    assert len(r) == 1 and r[0]["text"] == text.replace("password=abcdef1", "[secret]") and r[0]["n_chars"] == len(r[0]["text"])
    pieces = pipeline.STAGES[4][1](spark, now, str(tmp_path)).collect()
    assert sum(p["length"] for p in pieces) == pieces[0]["doc_tokens"]


def test_run_leaves_only_its_result(spark):
    import os

    from loopweaver.llm import common

    folder = common.shared_dir(spark).removeprefix("file://")
    before = set(os.listdir(folder))
    out = pipeline.run(spark, SF)
    assert len({x for x in set(os.listdir(folder)) - before if not x.startswith(".")}) == 1 and out.count()


def test_odd_rows_and_empty_tables_pass(spark, tmp_path):
    long = " ".join(f"{a}{b}" for a in "abcdefgh" for b in "ijklmnopqrst")
    rows = [(None, long, "en"), (1, None, "en"), (2, "", None), (3, long + " end", "en"), (3, long + " end", "en"), (4, "other " + " ".join(f"{b}{a}x" for a in "abcdefgh" for b in "ijklmnopqrst") + " password=abcdef1", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").selectExpr("*", "'s' source", "cast(length(text) as bigint) n_chars", "'x' _rejected", "1 key", "2 `a.b`")
    spark.createDataFrame([(3, 0), (4, 0)], "doc_id bigint, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for start in (docs, docs.limit(0)):
        now = start
        for _, stage in pipeline.STAGES[:4]:
            now = stash(stage(spark, now, str(tmp_path)))
            assert now.columns == docs.columns
        got = sorted((r["doc_id"] or -1, r["text"][-8:]) for r in now.collect())
        assert got == ([] if start is not docs else [(-1, long[-8:]), (3, (long + " end")[-8:]), (4, "[secret]")])
        assert {r["doc_id"] or -1 for r in pipeline.STAGES[4][1](spark, now, str(tmp_path)).collect()} == {i for i, _ in got}
