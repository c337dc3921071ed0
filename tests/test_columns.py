"""Golden vectors of the column functions."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from concord.functions import columns as C
from concord.operators import findings, reconcile, records, vintage
from concord.operators.reconcile import Comparable


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) if v is not None else F.lit(None).cast("string").alias(k) for k, v in values.items()])
    return row.select(column.alias("out")).first()["out"]


@pytest.mark.parametrize(
    "text, five, four",
    [("98108-2743", "98108", "2743"), ("98402", "98402", None), ("982037-870", "98203", None), ("99000-", "99000", None), ("99003--", "99003", None), ("0000", None, None), ("00000", "00000", None), ("599223", "59922", None), (None, None, None)],
)
def test_zip(spark, text, five, four):
    assert one(spark, C.zip5(F.col("a")), a=text) == five
    assert one(spark, C.zip4(F.col("a")), a=text) == four


@pytest.mark.parametrize("ours, theirs, status", [(None, None, "both_null"), (None, "x", "ours_absent"), ("x", None, "theirs_absent"), ("Bellevue", "BELLEVUE ", "agree"), ("a", "b", "disagree")])
def test_field_status(spark, ours, theirs, status):
    assert one(spark, C.field_status(F.col("a"), F.col("b"), text=True), a=ours, b=theirs) == status


def test_keys(spark):
    key = C.record_key(C.namespaced_id(F.lit("053"), F.col("id")), [F.col("a"), F.col("b")])
    assert one(spark, key, id="123456", a="A", b=None) == "053-123456|A|~"
    assert one(spark, key, id=None, a="A", b=None) is None
    got, recovered = C.recovered_key(F.col("k"), F.col("id"), "^([0-9]{3})-")
    assert one(spark, got, k=None, id="003-12") == "003" and one(spark, recovered, k=None, id="003-12") is True


def test_rounding_ratio_range(spark):
    assert [one(spark, C.rounded_to_long(F.lit(x))) for x in (0.5, 1.5, 2.5, -2.5)] == [0, 2, 2, -2]
    assert one(spark, C.ratio(F.lit(1.0), F.lit(0.0))) is None
    assert one(spark, C.tri_state(F.lit(None).cast("boolean"))) == "not_measurable"
    assert one(spark, C.out_of_range(F.col("a"), "98000", "99499"), a="97000") is True
    assert one(spark, C.out_of_range(F.col("a"), "98000", "99499"), a=None) is False
    assert one(spark, C.without_code(F.col("a")), a="12 - Farm 3 - x") == "Farm 3 - x"


@pytest.mark.parametrize("part, whole, pct", [(613322, 613322 + 21171 + 2043 + 693, 96.25), (326847, 326847 + 1481 + 869 + 504, 99.13), (306149, 306149 + 7648 + 1030 + 214, 97.18), (213360, 213360 + 256 + 782 + 403, 99.33), (9239, 636536, 1.45), (4596, 314827 + 4596, 1.44), (1, 0, None)])
def test_percent(spark, part, whole, pct):
    assert one(spark, C.percent(F.lit(part), F.lit(whole))) == pct


def test_signature_takes_new_columns_and_writes_numbers_alike(spark):
    a = spark.createDataFrame([(1, 2.0, "x")], "a int, b double, c string")
    b = spark.createDataFrame([(1, Decimal(2), "x")], "a long, b decimal(10,2), c string")
    sig = lambda d, *out: d.select(C.row_signature(d, out).alias("s")).first().s
    assert sig(a) == sig(b) and sig(a.withColumn("d", F.lit(1))) != sig(a) and sig(a.withColumn("d", F.lit(1)), "D") == sig(a)


def test_null_key_guard(spark):
    rows = spark.createDataFrame([(None, "s1", 1), (None, "s1", None), (None, "s2", 3), ("k", "s3", None), ("k", "s4", None)], "key string, sig string, v int")
    got = sorted((r.key or "", r.v or 0, r.source_record_count) for r in records.merge_records(rows, "key", "sig", {"v": "sum"}).collect())
    assert got == [("", 1, 2), ("", 3, 1), ("k", 0, 2)]


def test_drift_is_no_disagreement(spark):
    fields = [Comparable("name", text=True), Comparable("value", "sum", drift=True), Comparable("code", incomparable=True)]
    side = lambda rows: spark.createDataFrame(rows, "uid string, name string, value long, code string")
    out = reconcile.reconcile(side([("a", "x", 1, "p"), ("b", "y", 1, "p"), ("c", "z", 1, "p"), (None, "q", 1, "p")]), side([("a", "X ", 2, "q"), ("b", "n", 1, "p"), ("d", "m", 1, "p")]), "uid", fields)
    got = {r.uid: (r.reconciliation_class, r.value_drift) for r in out.collect()}
    assert got == {"a": ("both_match", True), "b": ("both_differ", False), "c": ("ours_only", False), "d": ("theirs_only", False)}


def test_name_codes(spark):
    names = spark.createDataFrame([("27", "Grays Harbor"), ("1", "Adams")], "code string, label string")
    rows = spark.createDataFrame([("1",), ("11",), ("GraysHarbor",), ("Nowhere",)], "value string")
    got = {r.value: (r.code, r.resolved_from_name) for r in vintage.resolve_codes(rows, "value", names, 3).collect()}
    assert got == {"1": ("001", False), "11": ("011", False), "GraysHarbor": ("027", True), "Nowhere": (None, True)}


def test_freshness(spark):
    remote = spark.createDataFrame([("a", None), ("b", 5), ("c", 5), ("d", 5)], "layer string, edited_at long")
    recorded = spark.createDataFrame([("a", 1), ("c", 4), ("c", 3), ("d", 5)], "layer string, edited_at long")
    got = {r.layer: (r.reason, r.changed) for r in vintage.freshness(remote, recorded, "layer").collect()}
    assert got == {"a": ("remote_unknown", True), "b": ("never_recorded", True), "c": ("edited", True), "d": ("unchanged", False)}
    assert vintage.should_run(vintage.freshness(remote.where("layer = 'd'"), recorded, "layer")).first().run is False
    assert vintage.should_run(vintage.freshness(remote.limit(0), recorded, "layer")).first().run is True


def test_counterparts_and_ids(spark):
    rows = spark.createDataFrame([(1, k, float(k), k == 3) for k in range(1, 8)] + [(1, 7, 9.5, False), (2, 1, 2.5, False)], "rec int, other int, area double, flag boolean")
    got = {r.rec: r for r in findings.counterparts(rows, ["rec"], "other", "area", {"flag": F.col("flag")}).collect()}
    assert got[1].counterparts == "7 (10); 6 (6); 5 (5); 4 (4); 3 (3)" and got[1].n_counterparts == 7 and got[1].flag
    assert got[2].counterparts == "1 (2)" and not got[2].flag
    ids = findings.feature_ids(spark.createDataFrame([("u", 1.0, 1), ("u", None, 2), ("v", 1.0, 3)], "uid string, area double, k int"), "p-", "uid", F.col("area"), [F.col("k")])
    assert {r.k: r.feature_id for r in ids.collect()} == {2: "p-u#1", 1: "p-u#2", 3: "p-v"}
