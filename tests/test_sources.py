"""Pages, metadata, loads under a contract, exports and the landing stream, on files that the tests write."""

import json

import pytest
from pyspark.sql import functions as F

from concord.operators import conform, contracts
from concord.sources import pages, sinks
from concord.streaming import landing


@pytest.fixture
def layer(tmp_path):
    folder = tmp_path / "pages"
    folder.mkdir()
    for k in range(3):
        features = [{"type": "Feature", "properties": {"objectid": 10 * k + i, "pin": f"p{i}", "acres": "1.5", "extra": 1}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}} for i in range(4)]
        (folder / f"{k}.json").write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    meta = tmp_path / "meta.json"
    meta.write_text(json.dumps({"name": "L", "maxRecordCount": 4, "extent": {"spatialReference": {"wkid": 102749, "latestWkid": 2927}}, "editingInfo": {"lastEditDate": 1700000000000}, "fields": [{"name": "OBJECTID", "type": "esriFieldTypeOID"}, {"name": "PIN", "type": "esriFieldTypeString", "domain": {"type": "codedValue", "name": "pins", "codedValues": [{"code": "p1", "name": "one"}, {"code": 2, "name": "two"}]}}, {"name": "ODD", "type": "esriFieldTypeBlob"}]}))
    return folder, meta


def test_features(spark, layer):
    folder, _ = layer
    schema = pages.declared_schema([("OBJECTID", "esriFieldTypeOID"), ("PIN", "esriFieldTypeString")])
    rows = pages.read_features(spark, str(folder), schema)
    assert rows.columns == ["objectid", "pin", "geom"] and rows.count() == 12
    g = rows.first().geom
    assert [(p.x, p.y) for p in g[0][0]] == [(0, 0), (1, 0), (1, 1), (0, 0)]


def test_attribute_pages_and_seeds(spark, tmp_path):
    """Tables without geometry publish ``attributes``; a seed keeps its codes as text."""
    (tmp_path / "0.json").write_text(json.dumps({"features": [{"attributes": {"objectid": 1, "pin": "a"}}, {"attributes": {"objectid": 2}}]}))
    schema = pages.declared_schema([("OBJECTID", "esriFieldTypeOID"), ("PIN", "esriFieldTypeString")])
    rows = pages.read_features(spark, str(tmp_path / "0.json"), schema, key="attributes", geometry=False)
    assert rows.columns == ["objectid", "pin"] and sorted(map(tuple, rows.collect()), key=str) == [(1, "a"), (2, None)]
    (tmp_path / "seed.csv").write_text("code,label,note\n007,Seven,\n,none,x\n")
    assert sorted(map(tuple, pages.read_seed(spark, str(tmp_path / "seed.csv")).collect()), key=str) == [("007", "Seven", None), (None, "none", "x")]


def test_jdbc_windows():
    """A window for each partition, but never more connections than allowed."""
    assert pages.jdbc_windows("k", 1, 100, 10, 64) == {"partitionColumn": "k", "lowerBound": "1", "upperBound": "101", "numPartitions": "10"}
    assert pages.jdbc_windows("k", 1, 10**9, 10, 64)["numPartitions"] == "64" and pages.jdbc_windows("k", 5, 5, 10, 64)["numPartitions"] == "1"


def test_recorded_edits_of_what_is_missing(spark):
    from concord.operators import vintage

    spark.createDataFrame([("a", "2024-01-02 00:00:00")], "layer string, edited string").createOrReplaceTempView("recorded_layers")
    assert vintage.recorded_edits(spark, "recorded_layers", "layer", "edited").count() == 1
    for name, column in (("recorded_layers", "nosuch"), ("no_such_table", "edited")):
        recorded = vintage.recorded_edits(spark, name, "layer", column)
        remote = spark.createDataFrame([("a",)], "layer string").withColumn("edited_at", F.current_timestamp())
        assert recorded.count() == 0 and vintage.freshness(remote, recorded, "layer").first().reason == "never_recorded"


def test_layers(spark):
    df = spark.range(3).withColumnRenamed("id", "k")
    kept = sinks.materialise(df, "kept_layer")
    assert spark.table("kept_layer").count() == 3 and "parquet" in kept._jdf.queryExecution().executedPlan().toString().lower()
    assert sinks.as_view(df.where("k > 0"), "seen_layer").count() == 2 and spark.table("seen_layer").count() == 2


def test_snapshot_replaces_the_one_before(spark, tmp_path):
    import os

    a, b = spark.range(2).toDF("k"), spark.createDataFrame([(2, None), (1, "x")], "k int, v string")
    sinks.export({"a": a, "b": b}, str(tmp_path), small=("b",))
    assert json.loads(next((tmp_path / "json_array" / "b").glob("part*")).read_text()) == [{"k": 1, "v": "x"}, {"k": 2, "v": None}]
    sinks.export({"b": b}, str(tmp_path))
    assert os.listdir(tmp_path / "parquet") == ["b"] and os.listdir(tmp_path / "json") == []


def test_rows_without_ids_are_not_gathered(spark):
    from concord.operators.findings import feature_ids
    from concord.operators.records import flag_duplicates

    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None)], "k int, uid string")
    ids = {r.k: r.feature_id for r in feature_ids(df, "p-", "uid", F.col("k"), [F.col("k")]).collect()}
    assert ids == {1: "p-a#2", 2: "p-a#1", 3: "p-no-id:3", 4: "p-no-id:4"}
    assert {r.k: r.duplicate_id for r in flag_duplicates(df, "uid").collect()} == {1: True, 2: True, 3: False, 4: False}


def test_metadata(spark, layer):
    meta = pages.read_metadata(spark, str(layer[1]))
    snap = pages.field_snapshot(meta, "2026-01-01 00:00:00").collect()
    assert {(r.field_name, r.crs, r.max_record_count) for r in snap} == {(n, 2927, 4) for n in ("OBJECTID", "PIN", "ODD")}
    assert str(snap[0].source_last_edit_at) == "2023-11-14 22:13:20"
    assert {(r.field_name, r.code, r.label) for r in pages.coded_values(meta, "2026-01-01 00:00:00").collect()} == {("PIN", "p1", "one"), ("PIN", "2", "two")}
    assert pages.crs_violations(meta, {"L": 2927}).count() == 0 and pages.crs_violations(meta, {"L": 2926}).count() == 1
    assert pages.declared_schema([("ODD", "esriFieldTypeBlob")])["odd"].dataType.simpleString() == "string"


def test_names_and_coercion(spark):
    assert pages.safe_names(["A", "SHAPE"], "shape") == ["a", "geom"]
    for bad in (["a", "A"], ["1x"], ["a;drop"]):
        with pytest.raises(ValueError):
            pages.safe_names(bad)
    df = spark.createDataFrame([("7", "x")], "a string, gone string")
    out = pages.coerce(df, pages.declared_schema([("A", "esriFieldTypeInteger"), ("B", "esriFieldTypeDouble")]))
    assert out.columns == ["a", "b"] and tuple(out.first()) == (7, None)


def test_windows(spark):
    w = pages.windows(spark, 3, 12, 4)
    assert [(r.start, r.stop) for r in w.orderBy("start").collect()] == [(3, 7), (7, 11), (11, 13)]
    rows = spark.range(0, 20).withColumnRenamed("id", "k")
    assert [r.k for r in pages.scan_windows(rows, "k", w, "k % 2 = 0").orderBy("k").collect()] == [4, 6, 8, 10, 12]


def test_windows_of_equal_counts(spark):
    rows = spark.range(0, 20_000).select((F.col("id") * F.col("id") * 7).alias("k"))
    w = [(r.start, r.stop) for r in pages.equal_windows(rows, "k", 20).orderBy("start").collect()]
    assert w[0][0] == 0 and all(a[1] == b[0] for a, b in zip(w, w[1:])) and w[-1][1] == 7 * 19_999**2 + 1
    starts = [a for a, _ in w]
    n = [r["count"] for r in rows.groupBy(pages.window_start(F.col("k"), starts).alias("s")).count().collect()]
    assert len(n) == 20 and sum(n) == 20_000 and max(n) <= 1_100 and min(n) >= 900
    got = {r.k: r.s for r in spark.createDataFrame([(-1,), (0,), (starts[7] - 1,), (starts[7],), (10**12,)], "k long").select("k", pages.window_start(F.col("k"), starts).alias("s")).collect()}
    assert got == {-1: None, 0: 0, starts[7] - 1: starts[6], starts[7]: starts[7], 10**12: starts[-1]}
    assert pages.equal_windows(rows.limit(0), "k", 4).count() == 0
    assert [tuple(r) for r in pages.equal_windows(spark.createDataFrame([(5,)] * 9, "k long"), "k", 4).collect()] == [(5, 6)]


def test_page_source_opens_only_the_windows_that_a_filter_wants(spark, tmp_path):
    from concord.sources import feature_pages

    rows = spark.range(0, 1000).select(F.col("id").alias("objectid"), F.concat(F.lit("n"), F.col("id").cast("string")).alias("pin"), F.expr("id div 100").alias("window"))
    layer = {"name": "L", "geometryType": None, "objectIdField": "OBJECTID", "fields": [{"name": "OBJECTID", "type": "esriFieldTypeOID"}, {"name": "PIN", "type": "esriFieldTypeString"}, {"name": "GONE", "type": "esriFieldTypeDouble"}]}
    root = str(tmp_path / "p")
    feature_pages.write_pages(rows, root, layer, "objectid")
    read = lambda: feature_pages.read_pages(spark, root)
    assert read().columns == ["objectid", "pin", "gone", "page"] and read().count() == 1000 and read().rdd.getNumPartitions() == 10
    for where, pages_read, n in (("objectid = 250", 1, 1), ("objectid > 99 and objectid <= 300", 3, 201), ("objectid in (5, 105)", 2, 2), ("objectid >= 950", 1, 50), ("objectid < 0", 1, 0), ("pin = 'n7'", 10, 1), ("objectid between 120 and 130 and pin like 'n12%'", 1, 10)):
        df = read().where(where)
        assert (df.rdd.getNumPartitions(), df.count()) == (pages_read, n), where
    # A page that isn't wanted may be missing or broken.
    next((tmp_path / "p" / "pages" / "window=9").glob("part*")).write_text("{")
    assert read().where("objectid < 900").count() == 900
    with pytest.raises(Exception):
        read().count()


def test_pages_are_written_and_listed_in_one_pass(spark, tmp_path):
    from concord.sources import feature_pages

    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    values = [(1, "a"), (2, "a"), (3, "b/c %"), (4, None), (5, "é"), (6, ""), (None, "n")]
    rows = spark.createDataFrame(values, "objectid long, window string").repartition(2)
    layer = {"name": "L", "geometryType": None, "objectIdField": "OBJECTID", "fields": [{"name": "OBJECTID", "type": "esriFieldTypeOID"}]}
    root = str(tmp_path / "p")
    spark.sparkContext.setJobGroup("pages", "")
    try:
        feature_pages.write_pages(rows.mapInArrow(count, rows.schema), root, layer, "objectid")
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    status = spark.sparkContext.statusTracker()
    stages = {i for job in status.getJobIdsForGroup("pages") for i in status.getJobInfo(job).stageIds}
    dealt = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert reads.value == 7 and dealt in [status.getStageInfo(i).numTasks for i in stages if status.getStageInfo(i)]
    back = feature_pages.read_pages(spark, root)
    assert {r.objectid for r in back.collect()} == {1, 2, 3, 4, 5, 6, None} and back.count() == 7 and back.where("objectid = 3").count() == 1
    assert {(r.k, r.window) for r in spark.read.option("inferSchema", False).json(f"{root}/pages").selectExpr("explode(features.properties.OBJECTID) k", "window").collect()} == {(k, w or None) for k, w in values}
    held = sorted((r.low, r.high, r.n) for r in spark.read.json(f"{root}/manifest").where("low is not null").collect())
    assert held == [(1, 2, 2), (3, 3, 1), (4, 4, 1), (5, 5, 1), (6, 6, 1)] and not list((tmp_path / "p/pages").rglob(".*"))
    with pytest.raises(Exception):  # there are pages already
        feature_pages.write_pages(rows, root, layer, "objectid")
    assert feature_pages.read_pages(spark, root).count() == 7


def test_pages_of_a_write_that_fails_or_is_empty(spark, tmp_path):
    from concord.sources import feature_pages

    layer = {"name": "L", "geometryType": None, "objectIdField": "OBJECTID", "fields": [{"name": "OBJECTID", "type": "esriFieldTypeOID"}]}
    rows = spark.range(0, 400, 1, 4).select(F.col("id").alias("objectid"), F.expr("id div 10").alias("window"))
    none, broken = str(tmp_path / "none"), str(tmp_path / "broken")
    feature_pages.write_pages(rows.where("objectid < 0"), none, layer, "objectid")
    assert feature_pages.read_pages(spark, none).count() == 0 and landing.page_stream(spark, f"{none}/pages", pages.declared_schema([("OBJECTID", "esriFieldTypeOID")])).isStreaming
    with pytest.raises(Exception):
        feature_pages.write_pages(rows.withColumn("pin", F.expr("if(objectid = 399, raise_error('x'), 'y')")), broken, layer, "objectid")
    assert not list((tmp_path / "broken").rglob("part*"))


def test_page_values_that_do_not_fit(spark, tmp_path):
    from pyspark.sql import types as T

    from concord.sources.feature_pages import _fit, _parts
    from pyspark.sql.pandas.types import to_arrow_type

    for kind, value, want in ((T.IntegerType(), "7", 7), (T.IntegerType(), "x", None), (T.IntegerType(), 1.5, None), (T.ShortType(), 40_000, None), (T.LongType(), None, None), (T.DoubleType(), "1.5", 1.5), (T.DoubleType(), {}, None), (T.StringType(), 3, "3"), (T.IntegerType(), 3.0, 3), (T.IntegerType(), float("nan"), None)):
        assert _fit(value, to_arrow_type(kind)) == want
    assert _parts({"type": "Polygon", "coordinates": [[[0, 1], [2, 3]]]}) == [[[{"x": 0.0, "y": 1.0}, {"x": 2.0, "y": 3.0}]]] and _parts(None) is None and _parts({"type": "Point", "coordinates": [1, 2]}) is None


def test_a_load_reads_its_rows_once(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    df = spark.range(0, 500, 1, 4).mapInArrow(count, "id long")
    report = sinks.contracted_load(df, str(tmp_path), "t", "v1", "id", 500)
    assert report.ok and (report.rows, report.distinct_keys, report.null_keys) == (500, 500, 0) and reads.value == 500


def test_changed_sources_alone_are_replaced(spark, tmp_path):
    path = str(tmp_path / "s")
    rows = lambda v: spark.createDataFrame([("a", v), ("b", v), ("c", v)], "src string, v int")
    rows(1).write.partitionBy("src").parquet(path)
    times = lambda: {f: f.stat().st_mtime_ns for f in (tmp_path / "s").rglob("part*") if "src=b" not in str(f)}
    before = times()
    decisions = spark.createDataFrame([("a", False), ("b", True), ("c", False), ("d", True)], "src string, changed boolean")
    assert sinks.publish_changed(rows(2), decisions, path, "src") == ["b", "d"]
    assert times() == before and {r.src: r.v for r in spark.read.parquet(path).collect()} == {"a": 1, "b": 2, "c": 1}
    assert sinks.publish_changed(rows(3), decisions.where("not changed"), path, "src") == []


def test_lookup_reads_few_row_groups(spark, tmp_path):
    import pyarrow.parquet as pq

    path = str(tmp_path / "c")
    x, y = F.col("id") * 7919 % 10_007, F.col("id") * 104_729 % 10_009
    rows = spark.range(0, 40_000).select("id", F.struct(*[c.cast("double").alias(n) for n, c in (("x0", x), ("y0", y), ("x1", x + 20), ("y1", y + 20))]).alias("box"), F.repeat(F.sha2(F.col("id").cast("string"), 512), 8).alias("load"))
    sinks.store_clustered(rows, path, files=8, group_bytes=1 << 19)
    groups = [pq.ParquetFile(f).metadata.row_group(i) for f in (tmp_path / "c").glob("part*") for i in range(pq.ParquetFile(f).metadata.num_row_groups)]
    px, py = 5000.0, 2500.0

    def may_hold(g):
        s = {g.column(i).path_in_schema: g.column(i).statistics for i in range(g.num_columns)}
        return s["x0"].min <= px and s["x1"].max >= px and s["y0"].min <= py and s["y1"].max >= py

    assert len(groups) >= 40 and sum(map(may_hold, groups)) <= 0.05 * len(groups)
    near = sinks.near_point(spark, path, px, py)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = near._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert all(f"({c},5000.0)" in pushed for c in ("x0", "x1")) and all(f"({c},2500.0)" in pushed for c in ("y0", "y1")) and sorted(near.columns) == ["box", "id", "load"]
    held = rows.where((F.col("box.x0") <= px) & (F.col("box.x1") >= px) & (F.col("box.y0") <= py) & (F.col("box.y1") >= py))
    assert sorted(r.id for r in near.collect()) == sorted(r.id for r in held.collect())
    sinks.store_clustered(rows.limit(0), path)
    assert sinks.near_point(spark, path, px, py).count() == 0


def test_contracted_load_swaps_only_what_is_sound(spark, tmp_path):
    root = str(tmp_path)
    good, bad = spark.range(5), spark.createDataFrame([(1,), (1,), (None,)], "id long")
    assert sinks.contracted_load(good, root, "t", "v1", "id", 5).ok
    for df, expected in ((bad, None), (good, 6), (good.limit(0), None)):
        with pytest.raises(sinks.ContractError):
            sinks.contracted_load(df, root, "t", "v2", "id", expected)
        assert sinks.current(spark, root, "t").count() == 5
    assert not list(tmp_path.glob("t/__loading*"))
    sinks.contracted_load(spark.range(7), root, "t", "v2", "id")
    assert sinks.current(spark, root, "t").count() == 7
    with pytest.raises(sinks.ContractError):  # a version is never written twice
        sinks.contracted_load(spark.range(9), root, "t", "v2", "id")
    assert sinks.current(spark, root, "t").count() == 7 and sinks.check_load(good, "nokey").ok


def test_history_and_export(spark, tmp_path):
    run = lambda k: spark.range(2).withColumn("captured_at", F.lit(k))
    for k in ("a", "b"):
        sinks.append_history(run(k), str(tmp_path / "h"))
    assert spark.read.parquet(str(tmp_path / "h")).groupBy("captured_at").count().count() == 2
    shapes = spark.range(3).withColumn("geom", F.lit(None).cast(sinks.GEOMETRY))
    for _ in range(2):
        sinks.export({"s": shapes}, str(tmp_path / "e"), small=("s",), features={"s": "geom"})
    assert spark.read.parquet(str(tmp_path / "e/parquet/s")).columns == ["id"]
    assert spark.read.csv(str(tmp_path / "e/csv/s"), header=True).count() == 3
    assert spark.read.parquet(str(tmp_path / "e/features/s")).columns == ["id", "geom_json"]


def test_landing_takes_each_page_once(spark, layer, tmp_path):
    folder, _ = layer
    schema = pages.declared_schema([("OBJECTID", "esriFieldTypeOID")])
    target, check = str(tmp_path / "t"), str(tmp_path / "c")
    for expected in (12, 12):
        landing.land_available(landing.page_stream(spark, str(folder), schema), target, check).awaitTermination()
        assert spark.read.parquet(target).count() == expected
    (folder / "9.json").write_text((folder / "0.json").read_text())
    landing.land_available(landing.page_stream(spark, str(folder), schema), target, check).awaitTermination()
    assert spark.read.parquet(target).count() == 16


def test_a_stream_lists_many_folders_in_few_tasks(spark, tmp_path):
    for k in range(100):
        (tmp_path / "pages" / f"window={k}").mkdir(parents=True)
        (tmp_path / "pages" / f"window={k}" / "0.json").write_text(json.dumps({"features": [{"properties": {"objectid": k}}]}))
    status, schema = spark.sparkContext.statusTracker(), pages.declared_schema([("OBJECTID", "esriFieldTypeOID")])
    spark.sparkContext.setJobGroup("listing", "")
    try:
        stream = landing.page_stream(spark, str(tmp_path / "pages"), schema, files_a_batch=40)
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    tasks = [status.getStageInfo(i).numTasks for job in status.getJobIdsForGroup("listing") for i in status.getJobInfo(job).stageIds]
    assert tasks and max(tasks) <= 4 * spark.sparkContext.defaultParallelism
    landing.land_available(stream, str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    assert sorted(r.objectid for r in spark.read.parquet(str(tmp_path / "t")).collect()) == list(range(100))


def test_manifest_checks(spark):
    source = conform.Source("X", "x", "id", {"name": "label", "n": "size + 1", "flag": "nosuch > 1"})
    assert conform.missing_columns(source, ["ID", "size"]) == ["label"]
    df = spark.createDataFrame([(1, "a", 2)], "id int, label string, size int")
    assert [t for t, _ in conform.broken_expressions(df, source)] == ["flag"]


def test_contracts(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 2)], "s string, n int")
    counts = contracts.violation_counts({"nn": contracts.expect_not_null(df, "n"), "u": contracts.expect_unique(df, "s"), "v": contracts.expect_values(df, "s", ["a"]), "t": contracts.expect_true(df, F.col("n") > 1)}, {"t": "warn"})
    assert {r.contract: (r.severity, r.violations) for r in counts.collect()} == {"nn": ("error", 1), "u": ("error", 1), "v": ("error", 1), "t": ("warn", 2)}
    staged = spark.createDataFrame([("a",)] * 3 + [("b",)], "s string")
    kept = spark.createDataFrame([("a", 2), ("b", 1)], "s string, source_record_count long")
    lost = spark.createDataFrame([("a", 1)], "s string, source_record_count long")
    assert contracts.row_conservation(staged, kept, lost, "s").count() == 0
    assert [r.s for r in contracts.row_conservation(staged, kept, lost.limit(0), "s").collect()] == ["a"]
    assert [r.s for r in contracts.reject_rate(staged, lost, "s", 0.3).collect()] == ["a"]
