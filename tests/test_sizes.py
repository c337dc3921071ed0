"""What keeps queries within their limits on larger tables, seen in their plans."""

import pytest

from pyspark.sql import functions as F

from concord.operators import reconcile, records, scorecard
from concord.plans import conforming, mapping, scoring


@pytest.mark.parametrize("made", [mapping.rectangles, mapping.odd_shapes, mapping.looped_shapes])
def test_shapes_of_a_small_file_are_the_work_of_many_tasks(spark, sf, made):
    assert made(spark, sf).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1


def test_findings_broadcast_no_rows_with_lists_or_shapes(spark, sf):
    ours = mapping._origins(spark, sf)[0]
    assert "BroadcastExchange" not in ours._jdf.queryExecution().sparkPlan().toString()


def test_shapes_are_repaired_once_for_all_contracts(spark, sf):
    plan = mapping.geometry_contracts(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan


def test_scorecard_layers_hold_what_blocks_read(spark, sf, monkeypatch):
    kept = []
    monkeypatch.setattr(scoring, "materialise", lambda df, name: kept.append(df) or df)
    scoring._layers(spark, sf)
    for layer in kept:
        plan = layer._jdf.queryExecution().optimizedPlan().toString()
        assert "Expand" not in plan and "distinct" not in plan
        assert not {"record_key", "ours_status_variants"} & set(layer.columns)


def test_duplicates_are_counted_without_joining_rows(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (2, "a"), (None, "a"), (None, "a"), (None, "c"), (3, "c"), (3, "c")], "k int, s string")
    got = records.count_duplicates(rows, "k", "s")
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    want = records.flag_duplicates(rows, "k").groupBy("s", "duplicate_id").agg(F.count("*").alias("n_rows"), F.countDistinct("k").alias("n_keys"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) == [("a", False, 3, 1), ("a", True, 1, 1), ("b", True, 2, 1), ("c", False, 1, 0), ("c", True, 2, 1)]


def test_checks_of_rows_that_stand_for_several(spark):
    rows = spark.createDataFrame([("s", 1, 2), ("s", 2, 3), ("s", 1, 5), ("t", None, 7)], "source string, k int, n int")
    checks = {"one": F.when(F.col("k") == 1, "yes"), "known": F.when(F.col("k").isNull(), "no").otherwise("yes")}
    got = sorted(map(tuple, scorecard.record_checks(rows, "source", checks, n="n").collect()))
    assert got == [("s", "known", "yes", 10), ("s", "one", "yes", 7), ("t", "known", "no", 7)]
    assert sorted(map(tuple, scorecard.record_checks(rows, "source", checks).collect())) == [("s", "known", "yes", 3), ("s", "one", "yes", 2), ("t", "known", "no", 1)]


def test_equal_shapes_are_repaired_once_for_the_scorecard(spark, sf, monkeypatch):
    seen = []
    monkeypatch.setattr(scoring, "repair", lambda df, **kw: seen.append(df) or df.withColumn("valid", F.lit(True)).withColumn("geometry_repaired", F.lit(False)))
    monkeypatch.setattr(scoring, "materialise", lambda df, name: df)
    monkeypatch.setattr(scoring, "odd_shapes", lambda spark, sf: mapping.odd_shapes(spark, sf).where("p_partkey < 50").withColumn("p_partkey", F.lit(3)).withColumn("geom", F.array().cast("array<array<array<struct<x:double,y:double>>>>")))
    scoring._long(spark, sf, *scoring._layers(spark, sf))
    assert [tuple(r)[2] for r in seen[0].collect()] == [50]


def test_merged_geometry_broadcasts_nothing(spark, sf):
    assert "BroadcastExchange" not in mapping.merged_geometry(spark, sf)._jdf.queryExecution().sparkPlan().toString()


def test_rows_are_not_copied_for_each_distinct_counter(spark):
    rows = spark.createDataFrame([(1, "b", 2, 1.0), (1, "a", 2, 2.0), (1, "b", None, 4.0), (1, "b", 2, 1.0), (2, None, None, None), (None, "z", 1, 9.0)], "k int, t string, y int, v double")
    fields = [reconcile.Comparable("t"), reconcile.Comparable("y"), reconcile.Comparable("v", "sum")]
    got = reconcile.collapse(rows, "k", fields, "ours")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan
    assert sorted(map(tuple, got.collect())) == [(1, 4, "a", 2, 2, 1, 8.0), (2, 1, None, 0, None, 0, None)]


def test_duplicate_ids_join_no_rows(spark, sf):
    assert "Join" not in conforming.duplicate_ids(spark, sf)._jdf.queryExecution().optimizedPlan().toString()


def test_pairs_of_records_are_made_where_their_shapes_meet(spark, sf):
    """Above the join in the grid nothing is joined or moved: members come out of the lists that both sides have there."""
    plan = mapping.overlap_pairs(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    boxes = plan[: plan.index("MapInArrow")]
    assert "Generate explode(members_b" in boxes and boxes.count("Join") == 1
    assert boxes.rindex("Generate explode(members_") < boxes.index("Join")


def test_dealing_of_boxes_is_not_done_twice(spark, sf):
    import re

    from concord.operators import overlap

    _, classes = overlap.shape_classes(mapping.rectangles(spark, sf), "p_partkey", "p_brand", parent="parent", stacked="stacked")
    plan = overlap.candidate_pairs(classes, "shape", "p_brand", 4.0)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\bExchange ", plan)) == 2


def test_findings_keep_no_list_of_all_parents_in_reach(spark, sf, tmp_path, monkeypatch):
    """Many shapes of one source that overlap: each table that is kept on the way has no more rows than there are shapes."""
    from concord.operators import overlap

    part = spark.range(2000).selectExpr("id AS p_partkey", "'B' AS p_brand", "if(id % 7 = 0, 'ECONOMY', 'LARGE') AS p_type", "int(id * 13 % 50 + 1) AS p_size")
    part.write.parquet(str(tmp_path / "part.parquet"))
    spark.read.parquet(f"{sf}/supplier.parquet").write.parquet(str(tmp_path / "supplier.parquet"))
    kept, keep = [], overlap.materialise
    monkeypatch.setattr(overlap, "materialise", lambda df, name: kept.append(keep(df, name)) or kept[-1])
    ours = mapping._origins(spark, str(tmp_path))[0]
    assert kept and max(k.count() for k in kept) <= 2000
    assert ours.agg(F.sum("n_counterparts")).first()[0] > 4000
