"""Pages, metadata, loads and publication, on folders written from the tables and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..operators import conform
from ..operators import findings as X
from ..operators import vintage as V
from ..sources import feature_pages as FP
from ..sources import pages as P
from ..sources import sinks as S
from ..streaming import landing
from .common import table
from .mapping import rectangles

SIZE = 100


def _layer(name: str, fields: list[tuple[str, str]], geometry: str | None) -> dict:
    return {"name": name, "geometryType": geometry, "maxRecordCount": SIZE, "objectIdField": "OBJECTID", "extent": {"spatialReference": {"wkid": 102749, "latestWkid": 2927}}, "fields": [{"name": n, "type": t} for n, t in fields]}


def _part_pages(spark: SparkSession, sf_dir: str) -> str:
    """Parts as feature pages of 100 keys; sizes are published as text, and some aren't numbers."""
    r = rectangles(spark, sf_dir)
    size = F.when(F.col("p_partkey") % 17 == 0, F.lit("n/a")).otherwise(F.col("p_size").cast("string"))
    rows = r.select(F.col("p_partkey").alias("objectid"), F.when(F.col("p_partkey") % 10 != 0, F.col("p_brand")).alias("brand"), size.alias("size"), F.expr("p_size / 4").alias("acres"), F.lit("x").alias("undeclared"), "geom")
    root = S.scratch_folder(spark, "pages")
    rows = rows.withColumn("window", F.expr(f"objectid div {SIZE}"))
    layer = _layer("parts", [("OBJECTID", "esriFieldTypeOID"), ("BRAND", "esriFieldTypeString"), ("SIZE", "esriFieldTypeInteger"), ("ACRES", "esriFieldTypeDouble"), ("ABSENT", "esriFieldTypeDate")], "esriGeometryPolygon")
    FP.write_pages(rows, root, layer, "objectid", geom="geom")
    return root


def page_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature pages through the data source: declared types, values that don't fit, and only the pages that a filter on the key wants."""
    rows = FP.read_pages(spark, _part_pages(spark, sf_dir)).where("objectid >= 250 and objectid < 1100")
    g = F.col("geom")
    return rows.groupBy("page").agg(F.count("*").alias("n"), F.min("objectid").alias("low"), F.max("objectid").alias("high"), F.count("brand").alias("n_brands"), F.sum("size").alias("size"), F.sum("acres").alias("acres"), F.count("absent").alias("n_absent"), F.sum(G.area(g)).alias("area"), F.sum(F.size(g)).alias("n_parts")).drop("page")


PAGE_SCAN = f"""
SELECT count(*) AS n, min(p_partkey) AS low, max(p_partkey) AS high, count(CASE WHEN p_partkey % 10 <> 0 THEN p_brand END) AS n_brands,
       CAST(sum(CASE WHEN p_partkey % 17 <> 0 THEN p_size END) AS BIGINT) AS size, sum(p_size / 4) AS acres, CAST(0 AS BIGINT) AS n_absent, CAST(sum(p_size * p_size) AS DOUBLE) AS area, count(*) AS n_parts
FROM part WHERE p_partkey >= 250 AND p_partkey < 1100 GROUP BY p_partkey // {SIZE}
"""


def attribute_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A layer without geometry: its pages have attributes."""
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("objectid"), F.col("s_name").alias("label"), F.col("s_acctbal").alias("balance"), F.expr(f"s_suppkey div {SIZE}").alias("window"))
    root = S.scratch_folder(spark, "attributes")
    FP.write_pages(s, root, _layer("suppliers", [("OBJECTID", "esriFieldTypeOID"), ("LABEL", "esriFieldTypeString"), ("BALANCE", "esriFieldTypeDouble")], None), "objectid", properties="attributes")
    return FP.read_pages(spark, root).select("objectid", "label", "balance")


def equal_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of keys with gaps: as many rows in each, within a tenth; every row in one."""
    o = table(spark, sf_dir, "orders").select((F.col("o_orderkey") * F.col("o_orderkey")).alias("k"))  # ever wider gaps
    n = 8
    w = P.equal_windows(o, "k", n)
    starts = [r.start for r in w.orderBy("start").collect()]  # eight numbers
    counted = o.groupBy(P.window_start(F.col("k"), starts).alias("start")).agg(F.count("*").alias("rows"))
    total = F.sum("rows")
    return w.join(counted, "start", "left").agg(F.count("*").alias("n_windows"), total.alias("n_rows"), (F.max("rows") <= 1.1 * total / n).alias("none_too_large"), (F.min("rows") >= 0.9 * total / n).alias("none_too_small"))


EQUAL_WINDOWS = "SELECT CAST(8 AS BIGINT) AS n_windows, count(*) AS n_rows, true AS none_too_large, true AS none_too_small FROM orders"


def _metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A layer for each region, with a coded field of its nations, in files of JSON."""
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    codes = F.sort_array(F.collect_list(F.struct(F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("name"))))
    layers = n.groupBy("r_regionkey", "r_name").agg(codes.alias("codes"))
    domain = F.struct(F.lit("codedValue").alias("type"), F.lit("nations").alias("name"), F.col("codes").alias("codedValues"))
    field = lambda name, kind, d: F.struct(F.lit(name).alias("name"), F.lit(kind).alias("type"), F.lit(name).alias("alias"), d.alias("domain"))
    none = F.lit(None).cast("struct<type:string,name:string,codedValues:array<struct<code:string,name:string>>>")
    wkid = F.when(F.col("r_regionkey") % 2 == 0, 2927).when(F.col("r_regionkey") == 3, 0).otherwise(4326)
    text = F.to_json(
        F.struct(
            F.col("r_name").alias("name"),
            F.lit(1000).alias("maxRecordCount"),
            F.struct(F.struct(F.lit(102749).alias("wkid"), wkid.alias("latestWkid")).alias("spatialReference")).alias("extent"),
            F.struct((F.lit(1700000000000) + F.col("r_regionkey") * 1000).alias("lastEditDate")).alias("editingInfo"),
            F.array(field("OBJECTID", "esriFieldTypeOID", none), field("NATION", "esriFieldTypeString", domain)).alias("fields"),
        )
    )
    root = S.scratch_folder(spark, "layers")
    layers.select("r_regionkey", text.alias("value")).write.partitionBy("r_regionkey").text(root)
    return P.read_metadata(spark, root)


def layer_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What layers publish of themselves: their fields, codes with labels, and layers whose reference system isn't the declared one."""
    meta = _metadata(spark, sf_dir)
    fields = P.field_snapshot(meta, "2026-01-01 00:00:00").select(F.lit("field").alias("kind"), F.col("layer_name").alias("layer"), F.col("field_name").alias("name"), F.concat_ws(":", "field_type", "crs", F.unix_millis("source_last_edit_at")).alias("value"))
    names = meta.select("layer", F.col("name").alias("layer_name"))
    codes = P.coded_values(meta, "2026-01-01 00:00:00").join(names, "layer").select(F.lit("code").alias("kind"), F.col("layer_name").alias("layer"), F.concat_ws("/", "field_name", "code").alias("name"), F.col("label").alias("value"))
    declared = {r.r_name: 2927 for r in table(spark, sf_dir, "region").select("r_name").collect()}  # a manifest names its layers
    wrong = P.crs_violations(meta, declared).select(F.lit("wrong_crs").alias("kind"), F.col("name").alias("layer"), F.lit("extent").alias("name"), F.concat_ws(":", "observed", "declared").alias("value"))
    return fields.unionByName(codes).unionByName(wrong)


LAYER_SNAPSHOT = """
WITH r AS (SELECT *, CASE WHEN r_regionkey % 2 = 0 THEN 2927 WHEN r_regionkey = 3 THEN 0 ELSE 4326 END AS crs FROM region WHERE r_regionkey IN (SELECT n_regionkey FROM nation))
SELECT 'field' AS kind, r_name AS layer, f AS name, t || ':' || crs || ':' || (1700000000000 + r_regionkey * 1000) AS value FROM r, (VALUES ('OBJECTID', 'esriFieldTypeOID'), ('NATION', 'esriFieldTypeString')) v(f, t)
UNION ALL SELECT 'code', r_name, 'NATION/' || n_nationkey, n_name FROM nation JOIN r ON n_regionkey = r_regionkey
UNION ALL SELECT 'wrong_crs', r_name, 'extent', crs || ':2927' FROM r WHERE crs NOT IN (0, 2927)
"""


def contracted_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of a table: a sound one, one with repeated keys and one short of rows (both refused), and a sound one again; with the rows that readers see after each."""
    root = S.scratch_folder(spark, "versions")
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    loads = [("v1", c.select(F.col("c_custkey").alias("k")), None), ("v2", o.select(F.col("o_custkey").alias("k")), None), ("v3", c.select(F.col("c_custkey").alias("k")), -1), ("v4", o.select(F.col("o_orderkey").alias("k")), None)]
    out = None
    for version, rows, expected in loads:
        try:
            report = S.contracted_load(rows, root, "t", version, "k", expected)
            done, seen = True, report.rows
        except S.ContractError:
            done, seen = False, None
        one = S.current(spark, root, "t").agg(F.lit(version).alias("version"), F.lit(done).alias("published"), F.lit(seen).cast("long").alias("loaded"), F.count("*").alias("visible"), F.sum("k").alias("key_sum"))
        one = S.materialise(one, f"seen_{version}")  # what is visible now, not what will be
        out = one if out is None else out.unionByName(one)
    return out


CONTRACTED_VERSIONS = """
WITH c AS (SELECT count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS k FROM customer), o AS (SELECT count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS k FROM orders)
SELECT 'v1' AS version, true AS published, n AS loaded, n AS visible, k AS key_sum FROM c
UNION ALL SELECT v, false, NULL, n, k FROM c, (VALUES ('v2'), ('v3')) x(v)
UNION ALL SELECT 'v4', true, n, n, k FROM o
"""


def history_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history to which two runs are added, and the latest capture of each key in it."""
    path = S.scratch_folder(spark, "history")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    S.append_history(c.where("c_custkey % 3 <> 0").withColumn("captured_at", F.lit("2026-01-01")), path)
    S.append_history(c.where("c_custkey % 2 = 0").withColumn("captured_at", F.lit("2026-02-01")), path)
    rows = V.latest_capture(spark.read.schema("c_custkey long, c_acctbal double, captured_at string").parquet(path), "captured_at", ["c_custkey"])
    return rows.groupBy("captured_at").agg(F.count("*").alias("n"), F.sum("c_custkey").alias("keys"))


HISTORY_RUNS = """
SELECT CASE WHEN c_custkey % 2 = 0 THEN '2026-02-01' ELSE '2026-01-01' END AS captured_at, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS keys
FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 <> 0 GROUP BY 1
"""


def incremental_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources published, then those alone published again whose layer was edited since."""
    path = S.scratch_folder(spark, "published")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("source"), F.col("l_quantity").cast("long").alias("quantity"), "l_shipdate")
    rows = lambda run: lines.groupBy("source").agg(F.count("*").alias("n"), F.sum("quantity").alias("quantity"), F.lit(run).alias("run"))
    rows("first").write.partitionBy("source").parquet(path)
    edited = lines.groupBy("source").agg(F.max("l_shipdate").cast("timestamp").alias("edited_at"))
    # Recorded: that of A as it is, that of N a day ago, none of the others.
    seen = edited.where("source in ('A', 'N')").withColumn("edited_at", F.when(F.col("source") == "N", F.col("edited_at") - F.expr("interval 1 day")).otherwise(F.col("edited_at")))
    S.publish_changed(rows("second"), V.freshness(edited, seen, "source"), path, "source")
    return spark.read.schema("n long, quantity long, run string, source string").parquet(path)


INCREMENTAL_PUBLISH = """
SELECT l_returnflag AS source, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity, CASE WHEN l_returnflag = 'A' THEN 'first' ELSE 'second' END AS run
FROM lineitem GROUP BY l_returnflag
"""


def clustered_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features under a point, from a store along a curve: boxes in other places are not read."""
    path = S.scratch_folder(spark, "clustered")
    r = rectangles(spark, sf_dir)
    S.store_clustered(r.select(F.col("p_partkey").alias("feature_id"), "p_brand", "geom", G.bbox(F.col("geom")).alias("box")), path)
    x, y = 500.5, 480.5
    return X.at_point(S.near_point(spark, path, x, y), x, y, G.contains(F.col("geom"), F.lit(x), F.lit(y))).select("feature_id", "p_brand", "total")


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages landed by the stream, twice over the same folder: each page once."""
    source = _part_pages(spark, sf_dir)
    target, checkpoint = S.scratch_folder(spark, "landed"), S.scratch_folder(spark, "landing")
    schema = P.declared_schema([("OBJECTID", "esriFieldTypeOID"), ("SIZE", "esriFieldTypeString")])
    for _ in range(2):
        landing.land_available(landing.page_stream(spark, f"{source}/pages", _upper(schema)), target, checkpoint).awaitTermination()
    rows = spark.read.parquet(target)
    return rows.groupBy("page").agg(F.count("*").alias("n"), F.sum("OBJECTID").alias("keys"), F.count_if(F.col("SIZE") == "n/a").alias("n_unknown")).drop("page")


def _upper(schema):
    """The names as the pages write them."""
    return type(schema)([type(f)(f.name.upper(), f.dataType) for f in schema.fields])


LANDED_PAGES = f"""
SELECT count(*) AS n, CAST(sum(p_partkey) AS BIGINT) AS keys, count(*) FILTER (p_partkey % 17 = 0) AS n_unknown FROM part GROUP BY p_partkey // {SIZE}
"""

def seed_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seed written as CSV and read with declared types: codes stay text, empty notes are missing."""
    path = S.scratch_folder(spark, "seed")
    n = table(spark, sf_dir, "nation")
    note = F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("region "), F.col("n_regionkey").cast("string")))
    n.select(F.lpad(F.col("n_nationkey").cast("string"), 3, "0").alias("code"), F.col("n_name").alias("label"), note.alias("note")).write.csv(path, header=True)
    return P.read_seed(spark, path)


def mapped_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that a manifest maps and the source no longer publishes, with the rows that go without."""
    published = table(spark, sf_dir, "orders").drop("o_orderpriority")
    source = conform.Source("O", "orders", "o_orderkey", {"status": "o_orderstatus", "priority": "o_orderpriority", "clerk": "o_clerkname", "total": "o_totalprice * 2"}, key_fields=("o_custkey",))
    missing = F.array(*[F.lit(c) for c in conform.missing_columns(source, published.columns)])
    return published.agg(F.count("*").alias("n_rows")).select(F.explode(missing).alias("missing"), "n_rows")


def geometry_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single polygons as multi ones, each in one of two reference systems or in none that is known, all brought into one."""
    x, y = F.col("p_partkey") % 100 + F.lit(0.25), F.col("p_partkey") % 60 + F.lit(0.5)
    ring = G.polygon([(x, y), (x + 1, y), (x, y + 1)])
    known = F.element_at(F.array(F.lit(4326), F.lit(3857), F.lit(9999)), (F.col("p_partkey") % 3 + 1).cast("int"))
    tagged = G.transformed(G.with_srid(G.multi(F.get(ring, F.lit(0))), known), 3857, (4326, 3857))
    first = F.get(G.points(G.shape(tagged)), F.lit(0))
    return table(spark, sf_dir, "part").select("p_partkey", G.srid(tagged).alias("srid"), F.size(G.shape(tagged)).alias("n_parts"), F.round(first.x, 3).alias("x"), F.round(first.y, 3).alias("y"))


GEOMETRY_TRANSFORM = """
WITH p AS (SELECT p_partkey, p_partkey % 3 AS kind, CAST(p_partkey % 100 + 0.25 AS DOUBLE) AS x, CAST(p_partkey % 60 + 0.5 AS DOUBLE) AS y FROM part)
SELECT p_partkey, CASE WHEN kind < 2 THEN 3857 END AS srid, CASE WHEN kind < 2 THEN 1 END AS n_parts,
       CASE kind WHEN 0 THEN round(radians(x) * 6378137.0, 3) WHEN 1 THEN x END AS x, CASE kind WHEN 0 THEN round(ln(tan(pi() / 4 + radians(y) / 2)) * 6378137.0, 3) WHEN 1 THEN y END AS y
FROM p
"""

QUERIES = {
    "page_scan": page_scan,
    "attribute_pages": attribute_pages,
    "equal_windows": equal_windows,
    "layer_snapshot": layer_snapshot,
    "contracted_versions": contracted_versions,
    "history_runs": history_runs,
    "incremental_publish": incremental_publish,
    "clustered_lookup": clustered_lookup,
    "landed_pages": landed_pages,
    "seed_labels": seed_labels,
    "mapped_columns": mapped_columns,
    "geometry_transform": geometry_transform,
}
SQL = {
    "page_scan": PAGE_SCAN,
    "attribute_pages": "SELECT s_suppkey AS objectid, s_name AS label, s_acctbal AS balance FROM supplier",
    "equal_windows": EQUAL_WINDOWS,
    "layer_snapshot": LAYER_SNAPSHOT,
    "contracted_versions": CONTRACTED_VERSIONS,
    "history_runs": HISTORY_RUNS,
    "incremental_publish": INCREMENTAL_PUBLISH,
    "clustered_lookup": """
WITH f AS (SELECT p_partkey AS feature_id, p_brand FROM part WHERE 500.5 BETWEEN p_partkey * 37 % 1000 AND p_partkey * 37 % 1000 + p_size AND 480.5 BETWEEN p_partkey * 91 % 1000 AND p_partkey * 91 % 1000 + p_size)
SELECT feature_id, p_brand, (SELECT count(*) FROM f) AS total FROM f ORDER BY feature_id LIMIT 6
""",
    "landed_pages": LANDED_PAGES,
    "seed_labels": "SELECT lpad('' || n_nationkey, 3, '0') AS code, n_name AS label, CASE WHEN n_nationkey % 2 = 0 THEN 'region ' || n_regionkey END AS note FROM nation",
    "mapped_columns": "SELECT m AS missing, count(*) AS n_rows FROM orders, (VALUES ('o_clerkname'), ('o_orderpriority')) v(m) GROUP BY m",
    "geometry_transform": GEOMETRY_TRANSFORM,
}
