"""Queries against their SQL, files from end to end, the command line and the stream."""

import gzip

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
from loopweaver.__main__ import main, params
from loopweaver.operators import cluster, moments
from loopweaver.params import Params
from loopweaver.plans import analysis, catalog
from loopweaver.sources import contacts, fixture
from loopweaver.sources.store import MomentStore, ScoreStore
from loopweaver.streaming import ingest

SF = "/root/testdata/sf0.001"
CHECKED = ["bin_contacts", "distance_histogram", "graph_degree", "fused_zscore", "diag_trimmed_zscore", "hic_input", "fused_background", "local_background", "significances", "neighbor_means", "density_clusters", "bh_fdr_by_distance", "validate_counts", "student_p_values", "summit_nms", "connected_candidates", "zscore_pivot", "rwr_q1", "window_size_fractions", "hic_input_all", "paired_tstat", "paired_tstat_from_rows", "bh_fdr_chrom_ranged", "density_clusters_by_joins", "summits_by_rounds", "connected_by_stars", "summit_scores", "validate_incomplete", "knee_clusters", "diag_zscore_by_value", "outlier_count", "outlier_count_from_rows"]


def rows(names, table):
    return sorted(tuple(repr(round(x, 9)) if isinstance(x, float) else repr(x) for x in r) for r in table)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, name):
    df = catalog.QUERIES[name](spark, SF)
    names = sorted(df.columns)
    c = duckdb.connect()
    c.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{SF}/lineitem.parquet'")
    got = c.execute(f"SELECT {', '.join(names)} FROM ({catalog.ORACLE[name]})").fetchall()
    assert rows(names, df.select(names).collect()) == rows(names, got)


def test_sliding_window_query_slides(spark):
    """Every pair of the band once, as in one window, but with values of several."""
    whole, slid = ({(r["cell"], r["chrom"], r["i"], r["j"]): r["v"] for r in catalog.QUERIES[q](spark, SF).where("cell <= 3").collect()} for q in ("rwr_inverse", "rwr_sliding_window"))
    assert slid.keys() == whole.keys() and catalog.QUERIES["rwr_sliding_window"](spark, SF).where("cell <= 3").count() == len(slid)
    assert any(abs(v - whole[k]) > 1e-9 for k, v in slid.items())


def test_entry_lists_queries_and_sql():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert "bin_contacts" in entry.queries()


def test_files_end_to_end(spark, tmp_path):
    """Text files in, loops out; the same loops as from the tables, and a second run takes up the first."""
    cells = tmp_path / "cells"
    cells.mkdir()
    data: dict = {}
    for r in fixture.contacts(spark, SF).collect():
        data.setdefault(r["cell"], []).append(f"x\t{r['chr1']}\t{r['pos1']}\t{r['chr2']}\t{r['pos2']}\n")
    for cell, lines in data.items():
        with gzip.open(cells / f"{cell}.txt.gz", "wt") as f:
            f.writelines(lines)
    (cells / "notes.md").write_text("not a cell")
    (tmp_path / "sizes").write_text("chr1 2000000\nchr2\t2000000\nchrX 5\n")
    (tmp_path / "regions.bed").write_text("")
    argv = ["-i", f"{cells}", "-o", f"{tmp_path}/out", "-l", f"{tmp_path}/sizes", "-s", ".txt.gz", "-g", "hg19", "--max-chrom-number", "2", "--dist", "6e5", "--candidate-upper-distance", "6e5", "--filter-file", f"{tmp_path}/regions.bed"]
    p = params(argv)
    analysis.run(spark, p, log=lambda x: None)
    analysis.run(spark, p, log=lambda x: None)
    want = {(r["chrom"], r["i"], r["j"], r["summit"]) for r in analysis.loops(fixture.contacts(spark, SF), fixture.PARAMS).collect()}
    got = {(r["chrom"], r["i"], r["j"], r["summit"]) for r in spark.read.parquet(f"{tmp_path}/out/postprocessed").collect()}
    assert got == want and got
    final = spark.read.option("sep", "\t").option("header", True).csv(f"{tmp_path}/out/final/combined.postprocessed.all_candidates.bedpe")
    assert len(final.columns) == 20 and final.count() == len(want)
    assert len(spark.read.option("sep", "\t").option("header", True).csv(f"{tmp_path}/out/final/combined.postprocessed.summits.bedpe").columns) == 17
    assert len(spark.read.option("sep", "\t").csv(f"{tmp_path}/out/hic/allChr.hic.input").columns) == 9
    # The text forms that other tools read, by name, and what reads them back.
    out = tmp_path / "out"
    assert {x.name for x in (out / "binned_text").glob("*.bedpe")} == {f"{c}.bedpe" for c in data}
    same = lambda a, b: sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    binned = spark.read.parquet(f"{out}/binned").selectExpr("cell", "chrom", "i", "j")
    assert same(contacts.binned_bedpe(spark, f"{out}/binned_text", p), binned)
    z = ScoreStore(spark, f"{out}/rwr").read().selectExpr("cell", "chrom", "i", "j", "round(z, 9)")
    assert same(contacts.normalised_bedpe(spark, f"{out}/rwr_text", p).selectExpr("cell", "chrom", "i", "j", "round(z, 9)"), z)
    for name, columns in (("nofilter", 18), ("candidates", 18), ("clustered", 21)):
        assert len(spark.read.option("sep", "\t").option("header", True).csv(f"{out}/postprocessed_text/combined.{name}.bedpe").columns) == columns
    assert any("interaction: done" in r[0] for r in spark.read.text(f"{out}/log").collect())
    # A cell and chromosome taken away is found missing.
    assert main(["validate", *argv], spark) == 0
    import shutil

    folder = next((out / "rwr").glob("run=*/chrom=chr2"))
    left = next(folder.glob("bucket=*"))
    rows = spark.read.parquet(str(left))
    cell = rows.first()["cell"]
    rows.where(rows["cell"] == cell).limit(10).unionByName(rows.where(rows["cell"] != cell)).write.parquet(f"{tmp_path}/few")
    shutil.rmtree(left)
    shutil.move(f"{tmp_path}/few", left)
    shutil.rmtree(next(folder.parent.glob("chrom=chr1")))
    assert main(["validate", *argv], spark) == 1
    missing = spark.read.option("sep", "\t").option("header", True).csv(f"{out}/missing").collect()
    assert {(r["cell"], r["chrom"], r["rows"]) for r in missing} == {(cell, "chr2", "10"), *((str(c), "chr1", "0") for c in data)}


NAMES = ["001", "01", "1", "1.1", "1.10", "2020-01-01", "c_a", "true"]


def cell_files(spark, folder, names):
    """A contact list for each name, from different cells of the fixture; the sizes of its chromosomes beside them."""
    folder.mkdir(exist_ok=True)
    rows = fixture.contacts(spark, SF).collect()
    for k, name in enumerate(sorted(NAMES)):
        if name in names:
            mine = [r for r in rows if r["cell"] == k + 1]
            (folder / f"{name}.txt").write_text("".join(f"x\t{r['chr1']}\t{r['pos1']}\t{r['chr2']}\t{r['pos2']}\n" for r in mine))
    (folder.parent / "sizes").write_text("chr1 2000000\nchr2 2000000\n")


def names_run(spark, tmp_path, out, *steps):
    analysis.run(spark, params(["-i", f"{tmp_path}/in", "-o", f"{tmp_path}/{out}", "-l", f"{tmp_path}/sizes", "-s", ".txt", "--chrom", "chr1 chr2", "--dist", "6e5", "--candidate-upper-distance", "6e5", "--no-text", "--steps", *steps]), log=lambda x: None)


def test_cells_keep_their_names_and_come_in_batches(spark, tmp_path):
    """Names that look like numbers, dates or booleans stay text and apart, also where only some of them are done."""
    cell_files(spark, tmp_path / "in", NAMES[:5])
    names_run(spark, tmp_path, "two", "bin", "rwr", "hic", "interaction")
    first = ScoreStore(spark, f"{tmp_path}/two/rwr").runs()
    cell_files(spark, tmp_path / "in", NAMES)
    names_run(spark, tmp_path, "two", "bin", "rwr", "hic", "interaction", "postprocess")
    store, kept = ScoreStore(spark, f"{tmp_path}/two/rwr"), MomentStore(spark, f"{tmp_path}/two/rwr_moments")
    assert len(first) == 1 and len(store.runs()) == 2 and set(first) < set(store.runs()) and kept.runs() == store.runs()
    assert {r["cell"] for r in store.read().select("cell").distinct().collect()} == set(NAMES)
    names_run(spark, tmp_path, "one", "bin", "rwr", "hic", "interaction", "postprocess")
    both = [[(r["chrom"], r["i"], r["j"], r["outlier_count"], round(r["tstat"], 6), round(r["fdr_chrom"], 9)) for r in spark.read.parquet(f"{tmp_path}/{d}/interactions").orderBy("chrom", "i", "j").collect()] for d in ("one", "two")]
    assert both[0] == both[1] and len(both[0]) > 10_000
    assert store.append(store.read().limit(0)) is None and len(store.runs()) == 2 and len(list((tmp_path / "two" / "rwr").glob("run=*"))) == 2
    # A run that broke off before its manifest is not read, and a cell scored again is refused.
    before = store.read().count()
    again = store.read().where("cell = '01' and chrom = 'chr1'").select("cell", "chrom", "i", "j", "z", "nb")
    again.selectExpr("chrom", "0 bucket", "cell", "i", "j", "z", "nb").write.partitionBy("chrom", "bucket").parquet(f"{tmp_path}/two/rwr/run=broken")
    assert store.read().count() == before
    store.append(again)
    with pytest.raises(ValueError, match="01 .chr1."):
        kept.catch_up(store, fixture.PARAMS.max_rwr_bins + 1, 1.96)


def test_heat_map_tools_run_where_given(spark, tmp_path):
    from dataclasses import replace

    from loopweaver.sources import sinks

    tool = tmp_path / "tool"
    tool.write_text("#!/bin/sh\nfor last; do :; done\necho \"$@\" > \"$last\"\n")
    tool.chmod(0o755)
    sinks.tsv(spark.range(3), f"{tmp_path}/hic/allChr.hic.input", header=False)
    said: list[str] = []
    p = replace(fixture.PARAMS, cool_tool=str(tool), chrom_sizes="sizes", genome="hg19")
    sinks.heat_maps(spark, f"{tmp_path}/hic/allChr.hic.input", p, said.append)
    assert "cload pairs" in (tmp_path / "hic" / "combined.allChr.cool").read_text() and "no .hic file" in said[0]
    sinks.heat_maps(spark, f"{tmp_path}/hic/allChr.hic.input", replace(p, no_hic=True, no_cool=True), said.append)
    assert len(said) == 2


def test_imputed_matrices_are_normalised(spark, tmp_path):
    import numpy as np

    m = np.triu(np.random.default_rng(2).random((80, 80)), 1)
    (tmp_path / "in").mkdir()
    np.savez(tmp_path / "in" / "c1.npz", m + m.T)
    assert main(["normalise", "-t", "npz", "-i", f"{tmp_path}/in", "-o", f"{tmp_path}/z", "--chrom", "chr1", "--dist", "2e5", "--compress-rwr"], spark) == 0
    assert [x.name for x in (tmp_path / "z").glob("c1*")] == ["c1.chr1.normalized.rwr.bedpe.gz"]
    got = contacts.normalised_bedpe(spark, f"{tmp_path}/z", Params()).collect()
    v = np.sort([m[i, i + 3] for i in range(5, 72)])[::-1]
    kept = v[max(0, round(0.01 * len(v)) - 1) :]
    z = {(r["i"], r["j"]): r["z"] for r in got}
    assert abs(z[20, 23] - (m[20, 23] - kept.mean()) / kept.std()) < 1e-9 and max(j for _, j in z) == 74
    with pytest.raises(SystemExit):
        main(["normalise", "-t", "npz", "-i", "x", "-o", "y"], spark)


def test_stream_with_a_bound_on_its_state(spark, tmp_path):
    src = fixture.contacts(spark, SF).selectExpr("cast(cell as string) cell", "chr1", "pos1", "chr2", "pos2")
    src.limit(800).coalesce(1).write.parquet(f"{tmp_path}/in")
    ingest.bin_stream(ingest.contact_stream(spark, f"{tmp_path}/in"), fixture.PARAMS, f"{tmp_path}/out", f"{tmp_path}/cp", within="2 days").awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out")
    assert got.count() == got.distinct().count() > 0


def test_cell_names(spark):
    df = spark.createDataFrame([("file:/a/b/x.1_contacts.txt.gz",)], "p string")
    name = lambda s, **k: df.select(contacts.cell_name(df["p"], s, **k)).first()[0]
    assert name("_contacts.txt.gz") == "x.1" and name("") == "x.1_contacts.txt.gz" and name("", literal=False) == "x1_contactstxtgz"


def test_chromosomes():
    assert contacts.wanted_chroms(Params(genome="hg38"))[-1] == "chr22" and contacts.wanted_chroms(Params(genome="mm10"))[-1] == "chr19"
    assert contacts.wanted_chroms(Params(chrom="chr3 chrX")) == ["chr3", "chrX"]
    with pytest.raises(ValueError):
        contacts.wanted_chroms(Params(genome="zz"))


def test_steps_may_be_quoted():
    assert params(["-i", "a", "-o", "b", "-l", "c", "--steps", "bin rwr"]).steps == ("bin", "rwr")


def test_npz_matrices(spark, tmp_path):
    import numpy as np

    np.savez(tmp_path / "c1.npz", np.array([[0, 2.0], [2.0, 0]]))
    assert [tuple(r) for r in contacts.imputed_npz(spark, str(tmp_path), "chr1").collect()] == [("c1", "chr1", 0, 1, 2.0)]


@pytest.mark.parametrize("save", ["savez", "savez_compressed"])
@pytest.mark.parametrize("order", ["C", "F"])
def test_one_large_matrix_is_read_by_many_tasks(spark, tmp_path, save, order):
    import numpy as np

    rng = np.random.default_rng(1)
    m = np.where(rng.random((301, 301)) < 0.2, rng.normal(size=(301, 301)), 0)
    getattr(np, save)(tmp_path / "001.npz", np.asarray(m.astype(np.float32), order=order))
    d = contacts.imputed_matrices(spark, str(tmp_path), "npz", "chr7", stretch_bytes=20 * 301 * 4)
    assert d.rdd.getNumPartitions() == 16
    i, j = np.nonzero(np.triu(m.astype(np.float32), 1))
    assert sorted(map(tuple, d.collect())) == [("001", "chr7", a, b, float(np.float32(m[a, b]))) for a, b in zip(i.tolist(), j.tolist(), strict=True)]


def test_matrices_of_other_chromosomes_are_not_opened(spark, tmp_path):
    import numpy as np

    np.savez(tmp_path / "a.b.chr1.npz", np.ones((3, 3)))
    (tmp_path / "a.b.chr2.npz").write_bytes(b"no matrix")
    d = contacts.imputed_npz(spark, str(tmp_path), chroms=["chr1", "chr9"])
    assert [tuple(r) for r in d.orderBy("i", "j").collect()] == [("a.b", "chr1", 0, 1, 1.0), ("a.b", "chr1", 0, 2, 1.0), ("a.b", "chr1", 1, 2, 1.0)]
    assert contacts.imputed_npz(spark, str(tmp_path), chroms=["chr3"]).count() == 0
    with pytest.raises(Exception, match="(?i)zip"):
        contacts.imputed_npz(spark, str(tmp_path)).count()


def test_sorted_text_is_joined_from_ranges(spark, tmp_path):
    from loopweaver.sources import sinks

    d = spark.range(0, 5000, 1, 7).selectExpr("concat('chr', id % 3) chr1", "(id * 7919) % 5000 x1", "id y1", "cast(null as double) v")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # as many ranges as set
    try:
        for header in (True, False):
            sinks.tsv(d.orderBy("chr1", "x1", "y1"), f"{tmp_path}/one", header)
            sinks.sorted_tsv(d, sinks.PLACE, f"{tmp_path}/many", header)
            one, many = (next((tmp_path / x).glob("part-*")).read_bytes() for x in ("one", "many"))
            assert one == many and not (tmp_path / "many_parts").exists() and len(list((tmp_path / "many").glob("part-*"))) == 1
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sinks.sorted_tsv(d.limit(0), sinks.PLACE, f"{tmp_path}/none")
    assert next((tmp_path / "none").glob("part-*")).read_text() == "chr1\tx1\ty1\tv\n"


def test_stream_is_distinct_across_batches(spark, tmp_path):
    src = fixture.contacts(spark, SF).selectExpr("cast(cell as string) cell", "chr1", "pos1", "chr2", "pos2")
    src.coalesce(1).write.parquet(f"{tmp_path}/in")
    q = lambda: ingest.bin_stream(ingest.contact_stream(spark, f"{tmp_path}/in"), fixture.PARAMS, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    q()
    src.limit(500).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    q()
    assert spark.read.parquet(f"{tmp_path}/out").count() == catalog.QUERIES["bin_contacts"](spark, SF).count()


def test_hdf5_values_are_read_in_stretches(monkeypatch):
    """By a stand-in for the file, as h5py may be missing: a partition for each stretch of each cell."""
    import contextlib

    import numpy as np

    from loopweaver.sources import matrices

    at = np.array([[k + d, k] if k % 2 else [k, k + d] for k in range(40) for d in (1, 3)])
    file = {"coordinates": at, "cell_1": np.arange(80.0), "cell_20": -np.arange(80.0), "other": np.zeros(3)}
    monkeypatch.setattr(matrices, "_hdf5_file", lambda path: contextlib.nullcontext(file))
    monkeypatch.setattr(matrices, "files", lambda path, suffix: [f"{path}/a.h5"])
    reader = matrices.MatrixReader({"path": "/x", "kind": "hdf5", "chrom": "chr3", "stretchbytes": "240"})
    parts = reader.partitions()
    assert len(parts) == 6 and {(p.cell, p.start, p.stop) for p in parts} == {(c, s, min(80, s + 30)) for c in ("cell_1", "cell_20") for s in (0, 30, 60)}
    got = [tuple(r.values()) for p in parts for b in reader.read(p) for r in b.to_pylist()]
    assert sorted(got) == sorted((c, "chr3", int(min(q)), int(max(q)), float(v)) for c in ("cell_1", "cell_20") for q, v in zip(at, file[c], strict=True))
    assert [p.path for p in matrices.MatrixReader({"path": "/x", "kind": "hdf5", "chrom": "chr3", "chroms": "chr4"}).partitions()] == [""]


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["hic_score", "hic_input", "hic_input_all"])
def test_scores_of_places_come_from_folded_outliers(spark, name):
    """No row of a cell leaves its task, and backgrounds are not taken for outliers."""
    plan = plan_of(catalog.QUERIES[name](spark, SF))
    assert "stretch" in plan and " z#" not in plan and ",z#" not in plan.replace(" ", "")


def test_outliers_without_background():
    i, j = np.array([5, 5, 6, 70]), np.array([6, 7, 8, 90])
    held = [moments.Held(fixture.PARAMS.max_rwr_bins + 1, 1.96) for _ in range(2)]
    for z in ([3.0, 0.0, 1.0, 2.5], [2.0, -3.0, 1.97, 0.0]):
        for h, nb in zip(held, (np.zeros(4), np.full(4, np.nan)), strict=True):
            assert not list(h.take("chr1", i, j, np.array(z), nb, once=True))
    for k, s in held[0].stretches.items():
        assert np.array_equal(s.a[:2], held[1].stretches[k].a[:2]) and not held[1].stretches[k].a[2:].any()


@pytest.mark.parametrize("name", ["validate_counts", "validate_incomplete", "outlier_count_from_rows", "fused_zscore"])
def test_queries_on_z_take_no_background(spark, name):
    assert "nb#" not in plan_of(catalog.QUERIES[name](spark, SF))


def test_scores_at_places(spark):
    """The scores of some places equal those of all, and no others leave the tasks; places off the band have none."""
    values = catalog._counts(spark, SF).where("cell < 4")
    some = [("chr1", 5, 6), ("chr1", 5, 70), ("chr1", 30, 55), ("chr1", 193, 194), ("chr2", 71, 96), ("chr2", 71, 96), ("chr1", 4, 9), ("chr1", 5, 71), ("chr1", 190, 195), ("chr1", 9, 9), ("chr3", 30, 55)]
    places = spark.createDataFrame(some, "chrom string, i bigint, j bigint")
    got = analysis.scores_at(values, places, fixture.PARAMS)
    want = cluster.summit_scores(places, analysis.from_values(values, fixture.PARAMS))
    assert rows(got.columns, got.collect()) == rows(got.columns, want.select(got.columns).collect()) and want.count() == 20
    none = analysis.scores_at(values, places.where("i < 0"), fixture.PARAMS)
    assert none.count() == 0 and none.schema == got.schema


def test_loops_read_contacts_once(spark):
    """Cells are counted from the places, and pairs that repeat aren't dropped by a shuffle of their own."""
    read = spark.sparkContext.accumulator(0)
    given = fixture.contacts(spark, SF)
    schema = given.schema

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    want = given.count()
    analysis.loops(given.mapInArrow(counted, schema), fixture.PARAMS).collect()
    assert read.value == want


def test_background_takes_runs(spark):
    """What scores give the background has a row for each bin of a cell, not one for each place, and its rows are made last."""
    by_runs = catalog._scored(spark, SF, by_runs=True)
    each = by_runs.groupBy("cell", "chrom").count().collect()
    assert each and {r["count"] for r in each} == {189}
    plan = [x.strip(" :+-") for x in plan_of(catalog.QUERIES["local_background"](spark, SF)).splitlines()]
    kinds = [x.split()[0] for x in plan if x.split()[0] in ("Generate", "MapInArrow")]
    assert kinds == ["Generate", "MapInArrow", "MapInArrow"]


@pytest.mark.parametrize("digits", [6, 8, 9])
def test_rounding_is_that_of_sql(spark, digits):
    """Halves, what is next to them, and values that are too large, too small or no numbers."""
    half = 0.5 / 10**digits
    near = [1 / 128, 3 / 128, 2.5, 1 / 256, 1 / 1024, 1 / 2048, half, np.nextafter(half, 0), np.nextafter(half, 1), 3 * half, 1.0000005, 0.1 + 0.2, 123456.7890125, 1e-300, 5e-324, 0.0]
    values = [float(s * x) for x in [*near, 1e9, 2.0**52, 4.6e15, 1e300, 1.7976931348623157e308, float("inf"), *np.random.default_rng(0).normal(size=300)] for s in (1, -1)]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in values], "x double").coalesce(1).select(catalog._round(catalog.F.col("x"), digits)).collect()]
    want = [duckdb.execute(f"SELECT round(CAST(? AS DOUBLE), {digits})", [x]).fetchone()[0] for x in values]
    assert [x for x in zip(values, got, want) if x[1] != x[2]] == []
    odd = spark.createDataFrame([(None,), (float("nan"),)], "x double").select(catalog._round(catalog.F.col("x"), digits)).collect()
    assert odd[0][0] is None and np.isnan(odd[1][0])
