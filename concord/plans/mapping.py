"""Geometry on shapes made of the parts: overlaps, merged shapes, validity, repair, findings, lookups, exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions.columns import ordered_case
from ..operators import findings as X
from ..operators import overlap as O
from ..operators import contracts as C
from ..operators.reconcile import Comparable, disagreement_text, reconcile
from ..operators.records import merge_records
from ..operators.rules import Rule, judge, split
from ..sources.sinks import export, feature_columns, materialise, scratch_folder
from .common import spread, table

PARENT = "p_partkey div 2"
SOURCE_SQL = "CASE p_partkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END"


def source() -> Column:
    """Another division of the parts, by which the scorecard counts."""
    return F.element_at(F.array(F.lit("A"), F.lit("N"), F.lit("R")), (F.col("p_partkey") % 3 + 1).cast("int"))


def corner() -> tuple[Column, Column, Column]:
    return (F.col("p_partkey") * 37) % 1000, (F.col("p_partkey") * 91) % 1000, F.col("p_size").cast("long")


def rectangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A square for each part: its source is the brand, two parts share a parent, some are stacked."""
    x, y, s = corner()
    p = spread(table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size", "p_type"), "p_partkey")
    return p.select("p_partkey", "p_brand", "p_size", source().alias("source"), F.expr(PARENT).alias("parent"), (F.col("p_type") == "ECONOMY").alias("stacked"), G.rectangle(x, y, x + s, y + s).alias("geom"))


def pairs(spark: SparkSession, sf_dir: str, by: str = "p_brand") -> DataFrame:
    return O.classify_overlaps(O.overlap_pairs(rectangles(spark, sf_dir), "p_partkey", by, parent="parent", stacked="stacked"), "stacked")


def counted_pairs(spark: SparkSession, sf_dir: str, by: str = "p_brand") -> DataFrame:
    """The same pairs by classes of equal shapes, with their number."""
    return O.classify_overlaps(O.counted_pairs(rectangles(spark, sf_dir), "p_partkey", by, parent="parent", stacked="stacked"), "stacked")


def outcome() -> Column:
    return F.when(F.col("unflagged_coincident"), "coincident_unflagged").otherwise(F.col("overlap_class"))


def overlap_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs(spark, sf_dir).select("p_brand", "p_partkey_a", "p_partkey_b", "overlap_area", "overlap_ratio", "overlap_class", "unflagged_coincident")


def pairs_sql(source: str = "p_brand") -> str:
    """The pairs of one source, whose shapes are squares."""
    return _PAIRS_SQL.replace("{source}", source)


_PAIRS_SQL = """
shapes AS (SELECT p_partkey AS k, {source} AS p_brand, p_partkey // 2 AS parent, p_type = 'ECONOMY' AS stacked, p_partkey * 37 % 1000 AS x, p_partkey * 91 % 1000 AS y, p_size AS s FROM part),
pairs AS (
  SELECT a.p_brand, a.k AS p_partkey_a, b.k AS p_partkey_b, a.parent AS parent_a, b.parent AS parent_b, a.stacked AS stacked_a, b.stacked AS stacked_b,
         CAST((least(a.x + a.s, b.x + b.s) - greatest(a.x, b.x)) * (least(a.y + a.s, b.y + b.s) - greatest(a.y, b.y)) AS DOUBLE) AS overlap_area,
         CAST((least(a.x + a.s, b.x + b.s) - greatest(a.x, b.x)) * (least(a.y + a.s, b.y + b.s) - greatest(a.y, b.y)) AS DOUBLE) / least(a.s * a.s, b.s * b.s) AS overlap_ratio
  FROM shapes a JOIN shapes b ON a.p_brand = b.p_brand AND a.k < b.k AND a.parent <> b.parent AND NOT (a.stacked AND b.stacked)
   AND a.x < b.x + b.s AND b.x < a.x + a.s AND a.y < b.y + b.s AND b.y < a.y + a.s),
classed AS (
  SELECT *, CASE WHEN overlap_ratio >= 0.8 THEN 'coincident' ELSE 'encroachment' END AS overlap_class,
         overlap_ratio >= 0.8 AND NOT stacked_a AND NOT stacked_b AS unflagged_coincident
  FROM pairs WHERE overlap_area > 1)"""
PAIRS_SQL = pairs_sql()


def overlap_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs by source and outcome, and the invariants they break (none)."""
    p = counted_pairs(spark, sf_dir)
    number = F.abs("n_pairs")
    broken = [F.sum(F.when(c, number).otherwise(0)).alias(n) for n, c in O.overlap_invariants("shape", None, "stacked").items()]
    return p.groupBy("p_brand", outcome().alias("outcome")).agg(F.sum("n_pairs").alias("n"), F.sum(F.col("overlap_area") * F.col("n_pairs")).alias("area"), *broken)


OVERLAP_CLASSES = f"""
WITH {PAIRS_SQL}
SELECT p_brand, CASE WHEN unflagged_coincident THEN 'coincident_unflagged' ELSE overlap_class END AS outcome, count(*) AS n, sum(overlap_area) AS area,
       count(*) FILTER (stacked_a AND stacked_b) AS both_stacked, count(*) FILTER (p_partkey_a >= p_partkey_b) AS not_ordered, count(*) FILTER (parent_a = parent_b) AS one_parent,
       count(*) FILTER (overlap_ratio IS NULL OR overlap_ratio <= 0 OR overlap_ratio > 1.0000001) AS ratio_out_of_range, count(*) FILTER (overlap_area <= 1) AS area_too_small,
       count(*) FILTER (unflagged_coincident AND (overlap_class <> 'coincident' OR stacked_a OR stacked_b)) AS wrongly_unflagged,
       count(*) FILTER (overlap_class NOT IN ('coincident', 'encroachment')) AS class_unknown, count(*) FILTER ((overlap_ratio >= 0.8) <> (overlap_class = 'coincident')) AS class_against_ratio
FROM classed GROUP BY ALL
"""


def overlap_area_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triangles with sloped edges; areas are multiples of a half, and the limit lies between two of them."""
    x, y, s = corner()
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", G.polygon([(x, y), (x + s, y), (x, y + s)]).alias("geom"))
    out = O.overlap_pairs(p, "p_partkey", "p_brand", least_area=0.75)
    return out.select("p_partkey_a", "p_partkey_b", F.round("overlap_area", 6).alias("overlap_area"), F.round("area_a", 6).alias("area_a"))


OVERLAP_AREA_POLYGON = """
WITH shapes AS (SELECT p_partkey AS k, p_brand, CAST(p_partkey * 37 % 1000 AS DOUBLE) AS x, CAST(p_partkey * 91 % 1000 AS DOUBLE) AS y, CAST(p_size AS DOUBLE) AS s FROM part),
near AS (SELECT a.k AS ka, b.k AS kb, a.x AS xa, a.y AS ya, a.s AS sa, b.x AS xb, b.y AS yb, b.s AS sb FROM shapes a JOIN shapes b ON a.p_brand = b.p_brand AND a.k < b.k
          AND a.x < b.x + b.s AND b.x < a.x + a.s AND a.y < b.y + b.s AND b.y < a.y + a.s),
-- Two right triangles of one shape meet in a third: its corner is the larger of both corners, its leg reaches the nearer hypotenuse.
leg AS (SELECT *, least(xa + ya + sa, xb + yb + sb) - greatest(xa, xb) - greatest(ya, yb) AS t FROM near)
SELECT ka AS p_partkey_a, kb AS p_partkey_b, round(t * t / 2, 6) AS overlap_area, round(sa * sa / 2, 6) AS area_a FROM leg WHERE t > 0 AND t * t / 2 > 0.75
"""


def counterpart_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = {"has_encroachment": F.col("overlap_class") == "encroachment", "has_unflagged_coincident": F.col("unflagged_coincident")}
    members, reach = O.parents_in_reach(rectangles(spark, sf_dir), "p_partkey", "p_brand", "parent", stacked="stacked", flags=flags)
    return X.reached_counterparts(members, reach, "p_partkey", "parent", list(flags))


COUNTERPARTS_SQL = (
    PAIRS_SQL
    + """,
directed AS (SELECT p_partkey_a AS p_partkey, parent_b AS counterpart, overlap_area, overlap_class, unflagged_coincident FROM classed
             UNION ALL SELECT p_partkey_b, parent_a, overlap_area, overlap_class, unflagged_coincident FROM classed),
each AS (SELECT p_partkey, counterpart, max(overlap_area) AS area, bool_or(overlap_class = 'encroachment') AS e, bool_or(unflagged_coincident) AS u FROM directed GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY area DESC, counterpart) AS r FROM each),
lists AS (
  SELECT p_partkey, count(*) AS n_counterparts, string_agg(counterpart || ' (' || CAST(round_even(area, 0) AS BIGINT) || ')', '; ' ORDER BY r) FILTER (r <= 5) AS counterparts,
         bool_or(e) AS has_encroachment, bool_or(u) AS has_unflagged_coincident
  FROM ranked GROUP BY p_partkey)"""
)


RECONCILED_FIELDS = [Comparable("brand", text=True), Comparable("size", "sum")]


def _answer_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other side's records: most parents of parts, some of another brand, and suppliers, some ids twice."""
    p = table(spark, sf_dir, "part").where(f"({PARENT}) % 11 <> 0")
    brand = F.when(F.expr(PARENT) % 9 == 0, F.lit("Other")).otherwise(F.col("p_brand"))
    parts = p.select(F.concat(F.lit("P-"), F.expr(PARENT).cast("string")).alias("uid"), brand.alias("brand"), F.when(F.col("p_size") >= 3, F.col("p_size")).cast("long").alias("size"), F.col("p_size").cast("double").alias("area"), F.col("p_partkey").alias("row"))
    s = table(spark, sf_dir, "supplier").where("s_suppkey % 4 = 1")
    area = F.when(F.col("s_acctbal") > 0, F.col("s_acctbal"))
    return parts.unionByName(s.select(F.concat(F.lit("S-"), (F.col("s_suppkey") % 40).cast("string")).alias("uid"), F.lit(None).cast("string").alias("brand"), F.lit(None).cast("long").alias("size"), area.alias("area"), F.col("s_suppkey").alias("row")))


#: Rules by which shapes are kept from publication.
SHAPE_RULES = [Rule("too_small", "smaller than any shape may be", "p_size < 3")]


def _origins(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three origins of findings: published shapes with one, records only the other side has, shapes too small to publish.

    Some rings come open; repair closes them, and says so.
    """
    open_ring = F.transform("geom", lambda rings: F.transform(rings, lambda ring: F.slice(ring, 1, F.size(ring) - 1)))
    raw = rectangles(spark, sf_dir).withColumn("geom", F.when(F.col("p_partkey") % 29 == 0, open_ring).otherwise(F.col("geom")))
    r = G.repair(raw).withColumn("uid", F.concat(F.lit("P-"), F.col("parent").cast("string"))).withColumn("area", G.area(F.col("geom")))
    published, quarantined = split(judge(r, SHAPE_RULES))
    key = _answer_key(spark, sf_dir)
    recon = reconcile(published.select("uid", F.col("p_brand").alias("brand"), F.col("p_size").cast("long").alias("size")), key, "uid", RECONCILED_FIELDS)
    classes = recon.select("uid", "reconciliation_class", disagreement_text(RECONCILED_FIELDS).alias("disagreements"))
    # A small file makes large rows: none of these is broadcast by its size.
    fine = published.join(counterpart_list(spark, sf_dir).hint("merge"), "p_partkey", "left").join(classes.hint("merge"), "uid", "left")
    ours = X.feature_ids(fine.where(X.has_finding()), "ours-", "uid", F.col("area"), [F.col("p_partkey")])
    missing = key.join(classes.where("reconciliation_class = 'theirs_only'").drop("disagreements").hint("merge"), "uid")
    theirs = X.feature_ids(missing.select("uid", "area", "row", "reconciliation_class"), "theirs-", "uid", F.col("area"), [F.col("row")])
    rejected = X.feature_ids(quarantined.drop("geometry_repaired"), "quarantine-", "uid", F.col("area"), [F.col("p_partkey")])
    return ours, theirs, rejected


FINDING_COLUMNS = ["feature_id", "uid", "area", "reconciliation_class", "disagreements", "has_encroachment", "has_unflagged_coincident", "n_counterparts", "counterparts", "geometry_repaired", "rejection_reason", "geom_source", "finding_primary"]


def findings_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.union_findings(*_origins(spark, sf_dir)).select(*FINDING_COLUMNS)


_IDS = "'{0}-' || uid || CASE WHEN count(*) OVER (PARTITION BY uid) > 1 THEN '#' || row_number() OVER (PARTITION BY uid ORDER BY area DESC NULLS FIRST, {1}) ELSE '' END AS feature_id"
FINDINGS_UNION = f"""
WITH {COUNTERPARTS_SQL},
r AS (SELECT 'P-' || parent AS uid, parent, k, s, CAST(s * s AS DOUBLE) AS area FROM shapes),
key AS (SELECT 'P-' || p_partkey // 2 AS uid, CASE WHEN p_partkey // 2 % 9 = 0 THEN 'Other' ELSE p_brand END AS brand, CASE WHEN p_size >= 3 THEN p_size END AS size, CAST(p_size AS DOUBLE) AS area, p_partkey AS row FROM part WHERE p_partkey // 2 % 11 <> 0
        UNION ALL SELECT 'S-' || s_suppkey % 40, NULL, NULL, CASE WHEN s_acctbal > 0 THEN s_acctbal END, s_suppkey FROM supplier WHERE s_suppkey % 4 = 1),
sides AS (SELECT * FROM (SELECT uid, min(p_brand) AS a_brand, sum(s) AS a_size, 1 AS a FROM (SELECT 'P-' || parent AS uid, p_brand, s FROM shapes WHERE s >= 3) GROUP BY uid)
          FULL JOIN (SELECT uid, min(brand) AS b_brand, sum(size) AS b_size, 1 AS b FROM key GROUP BY uid) USING (uid)),
recon AS (SELECT uid, CASE WHEN a IS NULL THEN 'theirs_only' WHEN b IS NULL THEN 'ours_only' WHEN upper(a_brand) <> upper(b_brand) OR coalesce(a_size <> b_size, false) THEN 'both_differ' ELSE 'both_match' END AS reconciliation_class,
                 nullif(concat_ws('; ', CASE WHEN upper(a_brand) <> upper(b_brand) THEN 'brand: ' || a_brand || ' ≠ ' || b_brand END, CASE WHEN a_size <> b_size THEN 'size: ' || CAST(a_size AS BIGINT) || ' ≠ ' || CAST(b_size AS BIGINT) END), '') AS disagreements FROM sides),
fine AS (SELECT r.*, l.n_counterparts, l.counterparts, l.has_encroachment, l.has_unflagged_coincident, reconciliation_class, disagreements, k % 29 = 0 AS geometry_repaired
         FROM r LEFT JOIN lists l ON k = p_partkey LEFT JOIN recon USING (uid) WHERE s >= 3),
found AS (SELECT * FROM fine WHERE coalesce(has_encroachment, false) OR coalesce(has_unflagged_coincident, false) OR reconciliation_class <> 'both_match' OR geometry_repaired),
missing AS (SELECT key.uid, row, area FROM key JOIN recon USING (uid) WHERE reconciliation_class = 'theirs_only')
SELECT *, CASE WHEN geom_source = 'quarantine' THEN 'quarantined' WHEN reconciliation_class = 'theirs_only' THEN 'missing_from_ours' WHEN has_encroachment THEN 'encroachment' WHEN has_unflagged_coincident THEN 'unflagged_coincident'
                WHEN reconciliation_class = 'both_differ' THEN 'attribute_disagreement' WHEN reconciliation_class = 'ours_only' THEN 'missing_from_theirs' WHEN geometry_repaired THEN 'geometry_repaired' END AS finding_primary
FROM (
  SELECT {_IDS.format("ours", "k")}, uid, area, reconciliation_class, disagreements, has_encroachment, has_unflagged_coincident, n_counterparts, counterparts, geometry_repaired, CAST(NULL AS VARCHAR) AS rejection_reason, 'ours' AS geom_source FROM found
  UNION ALL SELECT {_IDS.format("theirs", "row")}, uid, area, 'theirs_only', NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'theirs' FROM missing
  UNION ALL SELECT {_IDS.format("quarantine", "k")}, uid, area, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'too_small', 'quarantine' FROM r WHERE s < 3)
"""


def dup_discriminator(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("P-"), F.expr("p_partkey div 3").cast("string")).alias("uid"), F.when(F.col("p_size") % 5 != 0, F.col("p_size")).alias("area"))
    return X.feature_ids(p, "part-", "uid", F.col("area"), [F.col("p_partkey")]).select("p_partkey", "feature_id")


DUP_DISCRIMINATOR = """
SELECT p_partkey, 'part-P-' || p_partkey // 3 || CASE WHEN count(*) OVER w > 1 THEN '#' || row_number() OVER (w ORDER BY CASE WHEN p_size % 5 <> 0 THEN p_size END DESC NULLS FIRST, p_partkey) ELSE '' END AS feature_id
FROM part WINDOW w AS (PARTITION BY p_partkey // 3)
"""


def merged_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shapes of a brand and parent gathered as parts of one; what the parts share, and what they cover together."""
    r = rectangles(spark, sf_dir).withColumn("key", F.concat_ws("-", "p_brand", F.expr("p_partkey div 100").cast("string"))).withColumn("record_signature", F.col("p_partkey").cast("string"))
    r = r.withColumn("geom", F.when(F.col("p_size") > 2, F.col("geom")))
    merged = merge_records(r, "key", "record_signature", {"geom": "union", "stacked": "any"})
    own = O.overlap_pairs(r, "p_partkey", "key", least_area=0.0).groupBy("key").agg(F.sum("overlap_area").alias("overlap"))
    # Both are by key already; nothing is broadcast by the size of a small file.
    out = merged.join(own.hint("merge"), "key", "left")
    return out.select("key", "stacked", "source_record_count", F.coalesce(F.size("geom"), F.lit(0)).alias("n_parts"), F.coalesce(G.area(F.col("geom")), F.lit(0.0)).alias("area"), F.coalesce("overlap", F.lit(0.0)).alias("shared_area"), F.coalesce(G.union_area(F.col("geom")), F.lit(0.0)).alias("union_area"))


MERGED_GEOMETRY = """
WITH r AS (SELECT p_partkey AS k, p_brand || '-' || p_partkey // 100 AS key, p_type = 'ECONOMY' AS stacked, p_partkey * 37 % 1000 AS x, p_partkey * 91 % 1000 AS y, CASE WHEN p_size > 2 THEN p_size END AS s FROM part),
o AS (SELECT a.key, sum(CAST((least(a.x + a.s, b.x + b.s) - greatest(a.x, b.x)) * (least(a.y + a.s, b.y + b.s) - greatest(a.y, b.y)) AS DOUBLE)) AS overlap
      FROM r a JOIN r b ON a.key = b.key AND a.k < b.k AND a.x < b.x + b.s AND b.x < a.x + a.s AND a.y < b.y + b.s AND b.y < a.y + a.s GROUP BY 1),
-- What squares cover together: the cells between all their borders that lie in one of them.
xs AS (SELECT key, v AS x0, lead(v) OVER (PARTITION BY key ORDER BY v) AS x1 FROM (SELECT key, x AS v FROM r WHERE s IS NOT NULL UNION SELECT key, x + s FROM r WHERE s IS NOT NULL)),
ys AS (SELECT key, v AS y0, lead(v) OVER (PARTITION BY key ORDER BY v) AS y1 FROM (SELECT key, y AS v FROM r WHERE s IS NOT NULL UNION SELECT key, y + s FROM r WHERE s IS NOT NULL)),
cells AS (SELECT DISTINCT xs.key, x0, x1, y0, y1 FROM xs JOIN ys USING (key) JOIN r ON r.key = xs.key AND x <= x0 AND x1 <= x + s AND y <= y0 AND y1 <= y + s),
u AS (SELECT key, CAST(sum((x1 - x0) * (y1 - y0)) AS DOUBLE) AS covered FROM cells GROUP BY key)
SELECT key, bool_or(stacked) AS stacked, count(*) AS source_record_count, CAST(count(s) AS INTEGER) AS n_parts, CAST(coalesce(sum(s * s), 0) AS DOUBLE) AS area, coalesce(max(overlap), 0.0) AS shared_area, coalesce(max(covered), 0.0) AS union_area
FROM r LEFT JOIN o USING (key) LEFT JOIN u USING (key) GROUP BY key
"""


def odd_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A shape for each part: sound, open, with a spike, a bow-tie, empty, collapsed to a line, or missing."""
    x, y, s = corner()
    pts = [(x, y), (x + s, y), (x + s, y + s), (x, y + s)]
    ring = lambda ps: F.array(F.array(F.array(*[G.point(a, b) for a, b in ps])))
    kind = F.col("p_partkey") % 7
    geom = (
        F.when(kind == 0, ring([*pts, pts[0]]))
        .when(kind == 1, ring(pts))
        .when(kind == 2, ring([*pts[:2], (x + 2 * s, y), pts[1], *pts[2:], pts[0]]))
        .when(kind == 3, ring([pts[0], pts[2], pts[1], pts[3], pts[0]]))
        .when(kind == 4, F.array().cast(G.GEOMETRY))
        .when(kind == 5, ring([pts[0], pts[1], pts[0], pts[1], pts[0]]))
    )
    return spread(table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size"), "p_partkey").select("p_partkey", "p_brand", "p_size", geom.alias("geom"))


def geometry_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validity, emptiness, area and reference system; a ring with a spike isn't simple, so it is invalid."""
    observed = F.when(F.col("p_partkey") % 3 == 0, 2927).when(F.col("p_partkey") % 3 == 1, 0).otherwise(4326)
    tagged = odd_shapes(spark, sf_dir).withColumn("tagged", G.with_srid(F.col("geom"), observed))
    g = G.shape(F.col("tagged"))
    return tagged.select("p_partkey", G.is_empty(g).alias("is_empty"), G.is_valid(g).alias("is_valid"), G.area(g).alias("area"), G.srid(F.col("tagged")).alias("srid"), G.srid_fits(F.col("tagged"), 2927).alias("srid_ok"))


GEOMETRY_VALIDITY = """
SELECT p_partkey, CASE WHEN p_partkey % 7 < 6 THEN p_partkey % 7 = 4 END AS is_empty, CASE WHEN p_partkey % 7 < 6 THEN p_partkey % 7 = 0 END AS is_valid,
       CAST(CASE p_partkey % 7 WHEN 0 THEN p_size * p_size WHEN 1 THEN p_size * p_size WHEN 2 THEN p_size * p_size WHEN 6 THEN NULL ELSE 0 END AS DOUBLE) AS area,
       CASE WHEN p_partkey % 7 < 6 THEN CASE p_partkey % 3 WHEN 0 THEN 2927 WHEN 1 THEN 0 ELSE 4326 END END AS srid, CASE WHEN p_partkey % 7 < 6 THEN p_partkey % 3 <> 2 END AS srid_ok
FROM part
"""


def geometry_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = G.repair(odd_shapes(spark, sf_dir))
    g = F.col("geom")
    return out.select("p_partkey", "geometry_repaired", G.is_valid(g).alias("is_valid"), F.size(g).alias("n_parts"), G.area(g).alias("area"), F.size(G.points(g)).alias("n_points"))


GEOMETRY_REPAIR = """
SELECT p_partkey, p_partkey % 7 IN (1, 2, 3) AS geometry_repaired, CASE WHEN p_partkey % 7 < 6 THEN p_partkey % 7 < 4 END AS is_valid,
       CASE p_partkey % 7 WHEN 3 THEN 2 WHEN 4 THEN 0 WHEN 6 THEN NULL ELSE 1 END AS n_parts,
       CAST(CASE p_partkey % 7 WHEN 3 THEN p_size * p_size / 2 WHEN 4 THEN 0 WHEN 5 THEN 0 WHEN 6 THEN NULL ELSE p_size * p_size END AS DOUBLE) AS area,
       CASE p_partkey % 7 WHEN 3 THEN 8 WHEN 4 THEN 0 WHEN 6 THEN NULL ELSE 5 END AS n_points
FROM part
"""


def looped_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each part a ring of two square loops, a bridge there and back between them; every other second loop runs the other way."""
    x, y, s = corner()
    dx, dy = F.col("p_partkey") % 13, F.col("p_partkey") % 7
    loop = lambda a, b: [(a, b), (a + s, b), (a + s, b + s), (a, b + s), (a, b)]
    ring = lambda ps: F.array(F.array(F.array(*[G.point(a, b) for a, b in ps])))
    second = loop(x + dx, y + dy)
    turned = ring([*loop(x, y), *second[::-1], (x, y)])
    return spread(table(spark, sf_dir, "part").select("p_partkey", "p_size"), "p_partkey").select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, ring([*loop(x, y), *second, (x, y)])).otherwise(turned).alias("geom"))


def geometry_repair_loops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loops that overlap: the ground that a ring winds round once or more, in valid parts."""
    out = G.repair(looped_shapes(spark, sf_dir))
    g = F.col("geom")
    return out.select("p_partkey", "geometry_repaired", G.is_valid(g).alias("is_valid"), F.size(g).alias("n_parts"), G.area(g).alias("area"), G.perimeter(g).alias("perimeter"))


GEOMETRY_REPAIR_LOOPS = """
WITH s AS (SELECT p_partkey, p_partkey % 2 = 0 AS alike, p_size AS s, p_partkey % 13 AS dx, p_partkey % 7 AS dy FROM part),
m AS (SELECT *, greatest(s - dx, 0) AS w, greatest(s - dy, 0) AS h FROM s),
-- Two loops over each other, or side by side; of loops against each other that are one nothing is left, and they stay as they were.
k AS (SELECT *, w * h > 0 AS over, (dx = s AND h > 0) OR (dy = s AND w > 0) AS beside, NOT alike AND dx = 0 AND dy = 0 AS gone FROM m)
SELECT p_partkey, NOT gone AS geometry_repaired, NOT gone AS is_valid,
       CASE WHEN gone OR beside OR (alike AND over) THEN 1 ELSE 2 END AS n_parts,
       CAST(2 * s * s - CASE WHEN alike THEN 1 ELSE 2 END * w * h AS DOUBLE) AS area,
       CAST(8 * s - CASE WHEN gone THEN 0 WHEN beside OR (alike AND over) THEN 2 * (w + h) WHEN over THEN CASE WHEN dx = 0 THEN 4 * h WHEN dy = 0 THEN 4 * w ELSE 0 END ELSE 0 END AS DOUBLE) AS perimeter
FROM k
"""


def dissolved_outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outline of all squares of a brand on a small lattice, where they share sides, parts of sides and ground."""
    x, y, s = F.col("p_partkey") * 7 % 40, F.col("p_partkey") * 11 % 30, F.col("p_size") % 4 + 1
    p = table(spark, sf_dir, "part").select("p_brand", G.rectangle(x, y, x + s, y + s).alias("geom"))
    g = F.col("geom")
    return G.dissolve(p, ["p_brand"]).select("p_brand", G.area(g).alias("area"), G.perimeter(g).alias("perimeter"), G.is_valid(g).alias("is_valid"))


DISSOLVED_OUTLINE = """
WITH s AS (SELECT p_brand, p_partkey * 7 % 40 AS x, p_partkey * 11 % 30 AS y, p_size % 4 + 1 AS s FROM part),
cells AS (SELECT DISTINCT p_brand, x + i AS cx, y + j AS cy FROM (SELECT *, unnest(range(0, s)) AS i FROM s) JOIN (SELECT unnest(range(0, 4)) AS j) ON j < s)
SELECT a.p_brand, CAST(count(*) AS DOUBLE) AS area, CAST(4 * count(*) - 2 * (count(r.cx) + count(u.cx)) AS DOUBLE) AS perimeter, true AS is_valid
FROM cells a LEFT JOIN cells r ON r.p_brand = a.p_brand AND r.cx = a.cx + 1 AND r.cy = a.cy LEFT JOIN cells u ON u.p_brand = a.p_brand AND u.cx = a.cx AND u.cy = a.cy + 1
GROUP BY a.p_brand
"""


def geometry_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extract's geometries: there, not empty, in one reference system, valid (a warning); and a vintage for each row."""
    observed = F.when(F.col("p_partkey") % 3 == 2, 2927).otherwise(4326)
    root = scratch_folder(spark, "split")
    # Repaired once: every contract reads the shapes.
    rows = materialise(G.repair(odd_shapes(spark, sf_dir)), "repaired", root).withColumn("tagged", G.with_srid(F.col("geom"), observed))
    # Both sides of the split as tables of their own; where a row is comes from the file that it is read from.
    for side, part in zip(("published", "quarantine"), split(judge(rows.select("p_partkey", "p_size"), SHAPE_RULES))):
        materialise(part, side, root)
    stored = spark.read.schema("p_partkey long, p_size int, rejection_reason string").parquet(f"{root}/published", f"{root}/quarantine").withColumn("location", F.element_at(F.split(F.input_file_name(), "/"), -2))
    lost = rows.select("p_partkey").join(stored, "p_partkey", "left")
    lines = table(spark, sf_dir, "lineitem")
    last = lines.where("l_returnflag <> 'A'").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.max("l_shipdate").alias("vintage"))
    out = C.geometry_contracts(rows, "tagged", 4326) | {"vintage_present": C.expect_not_null(rows.join(last, "p_partkey", "left"), "vintage"), "quarantine_location": C.expect_true(stored, (F.col("location") == "quarantine") == F.col("rejection_reason").isNotNull()), "split_without_loss": C.expect_not_null(lost, "location"), "quarantined_rows": C.expect_true(stored, F.col("location") != "quarantine")}
    return C.violation_counts(out, {"geometry_valid": "warn", "quarantined_rows": "warn"})


GEOMETRY_CONTRACTS = """
SELECT 'geometry_present' AS contract, 'error' AS severity, count(*) AS violations FROM part WHERE p_partkey % 7 = 6
UNION ALL SELECT 'geometry_not_empty', 'error', count(*) FROM part WHERE p_partkey % 7 = 4
UNION ALL SELECT 'geometry_srid', 'error', count(*) FROM part WHERE p_partkey % 7 < 6 AND p_partkey % 3 = 2
UNION ALL SELECT 'geometry_valid', 'warn', count(*) FROM part WHERE p_partkey % 7 IN (4, 5)
UNION ALL SELECT 'vintage_present', 'error', count(*) FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag <> 'A')
UNION ALL SELECT 'quarantine_location', 'error', count(*) FROM part WHERE (p_size < 3) <> (p_size IN (1, 2))
UNION ALL SELECT 'split_without_loss', 'error', count(*) FROM part WHERE p_partkey IS NULL
-- So many rows are in the quarantine.
UNION ALL SELECT 'quarantined_rows', 'warn', count(*) FROM part WHERE p_size < 3
"""


def geometry_simplify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squares with a point in the middle of two sides, one of them a little off the line."""
    x, y, s = corner()
    s = s * 10
    h = s / 2
    pts = [(x, y), (x + h, y), (x + s, y), (x + s + F.lit(0.4), y + h), (x + s, y + s), (x, y + s)]
    p = table(spark, sf_dir, "part").select("p_partkey", G.polygon(pts).alias("geom"))
    out = None
    for tolerance in (0.1, 0.5):
        one = G.simplify(p, tolerance=tolerance).select("p_partkey", F.lit(tolerance).alias("tolerance"), F.size(G.points(F.col("geom"))).alias("n_points"))
        out = one if out is None else out.unionByName(one)
    return out


GEOMETRY_SIMPLIFY = """
-- A point in the middle of a side stays if it is farther from that side than the tolerance: one is on it, one beside it.
WITH s AS (SELECT p_partkey, p_partkey * 37 % 1000 AS x, p_partkey * 91 % 1000 AS y, p_size * 10 AS s FROM part),
middle AS (SELECT p_partkey, abs(y - y) AS first, abs((x + s + 0.4) - (x + s)) AS second FROM s)
SELECT p_partkey, CAST(t AS DOUBLE) AS tolerance, 5 + CAST(first > t AS INTEGER) + CAST(second > t AS INTEGER) AS n_points FROM middle, (VALUES (0.1), (0.5)) v(t)
"""


def dimension_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published dimension: names, types and order as declared, the geometry last, in one reference system."""
    r = rectangles(spark, sf_dir)
    tagged = G.with_srid(F.col("geom"), 2927)
    columns = {
        "uid": F.concat(F.lit("P-"), F.col("parent").cast("string")),
        "record_key": F.concat_ws("|", F.lit("P"), F.col("p_partkey").cast("string")),
        "source": F.col("source"),
        "brand": F.upper("p_brand"),
        "size_code": F.lpad(F.col("p_size").cast("string"), 3, "0"),
        "size": F.col("p_size").cast("int"),
        "stacked": F.coalesce("stacked", F.lit(False)),
        "area": G.area(F.col("geom")),
        "acres": F.round(G.area(F.col("geom")) / 43560, 6),
        "geom_srid": G.srid(tagged),
        "geom": G.to_geojson(G.shape(tagged)),
    }
    return r.select(*[c.alias(n) for n, c in columns.items()])


DIMENSION_PROJECTION = """
WITH s AS (SELECT *, p_partkey * 37 % 1000 AS x, p_partkey * 91 % 1000 AS y, p_partkey * 37 % 1000 + p_size AS u, p_partkey * 91 % 1000 + p_size AS v FROM part)
SELECT 'P-' || p_partkey // 2 AS uid, 'P|' || p_partkey AS record_key, CASE p_partkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END AS source, upper(p_brand) AS brand, lpad('' || p_size, 3, '0') AS size_code,
       CAST(p_size AS INTEGER) AS size, p_type = 'ECONOMY' AS stacked, CAST(p_size * p_size AS DOUBLE) AS area, round(CAST(p_size * p_size AS DOUBLE) / 43560, 6) AS acres, 2927 AS geom_srid,
       '{"type":"MultiPolygon","coordinates":[[[[' || x || '.0,' || y || '.0],[' || u || '.0,' || y || '.0],[' || u || '.0,' || v || '.0],[' || x || '.0,' || v || '.0],[' || x || '.0,' || y || '.0]]]]}' AS geom
FROM s
"""


def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y, s = corner()
    r = rectangles(spark, sf_dir).withColumn("box", G.bbox(F.col("geom"))).withColumn("feature_id", F.col("p_partkey"))
    return X.at_point(r, 500.5, 480.5, G.contains(F.col("geom"), F.lit(500.5), F.lit(480.5))).select("feature_id", "p_brand", "total")


POINT_LOOKUP = """
WITH f AS (SELECT p_partkey AS feature_id, p_brand FROM part WHERE 500.5 BETWEEN p_partkey * 37 % 1000 AND p_partkey * 37 % 1000 + p_size AND 480.5 BETWEEN p_partkey * 91 % 1000 AND p_partkey * 91 % 1000 + p_size)
SELECT feature_id, p_brand, (SELECT count(*) FROM f) AS total FROM f ORDER BY feature_id LIMIT 6
"""


def reproject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Longitude and latitude to web Mercator and back, and to a state plane and back."""
    lon, lat = F.col("p_partkey") % 360 - 180 + F.lit(0.25), F.col("p_partkey") % 160 - 80 + F.lit(0.5)
    near = (F.lit(-122.0) + (F.col("p_partkey") % 40) / 10, F.lit(46.0) + (F.col("p_partkey") % 25) / 10)
    p = table(spark, sf_dir, "part").select("p_partkey", G.polygon([(lon, lat)]).alias("geom"), G.polygon([near]).alias("near"))
    first = lambda g: F.get(G.points(g), F.lit(0))
    mercator = G.reproject(F.col("geom"), 4326, 3857)
    back = first(G.reproject(mercator, 3857, 4326))
    zone = G.reproject(F.col("near"), 4326, 2927)
    plane, there = first(G.reproject(zone, 2927, 4326)), first(zone)
    m = first(mercator)
    return p.select("p_partkey", F.round(m.x, 3).alias("x"), F.round(m.y, 3).alias("y"), F.round(back.x, 6).alias("lon"), F.round(back.y, 6).alias("lat"), F.round(plane.x, 6).alias("plane_lon"), F.round(plane.y, 6).alias("plane_lat"), F.round(there.x, 2).alias("plane_x"), F.round(there.y, 2).alias("plane_y"))


REPROJECT = """
WITH p AS (SELECT p_partkey, p_partkey % 360 - 180 + 0.25 AS lon, p_partkey % 160 - 80 + 0.5 AS lat, -122.0::DOUBLE + (p_partkey % 40) / 10.0 AS a, 46.0::DOUBLE + (p_partkey % 25) / 10.0 AS b FROM part),
-- The conformal conic of the zone, by the published formulas for two standard parallels on an ellipsoid.
k AS (SELECT sqrt(2 * f - f * f) AS e, 1200 / 3937.0::DOUBLE AS unit FROM (SELECT 1 / 298.257222101::DOUBLE AS f)),
z AS (SELECT name, cos(lat) / sqrt(1 - pow(e * sin(lat), 2)) AS m, tan(pi() / 4 - lat / 2) / pow((1 - e * sin(lat)) / (1 + e * sin(lat)), e / 2) AS t
      FROM k, (VALUES (0, radians(45 + 20 / 60.0::DOUBLE)), (1, radians(45 + 50 / 60.0::DOUBLE)), (2, radians(47 + 20 / 60.0::DOUBLE))) v(name, lat)),
c AS (SELECT max(t) FILTER (name = 0) AS t0, max(t) FILTER (name = 1) AS t1, max(t) FILTER (name = 2) AS t2, max(m) FILTER (name = 1) AS m1, max(m) FILTER (name = 2) AS m2 FROM z),
g AS (SELECT n, t0, m1 / (n * pow(t1, n)) AS big FROM (SELECT *, (ln(m1) - ln(m2)) / (ln(t1) - ln(t2)) AS n FROM c)),
q AS (SELECT p.*, unit, n, 6378137.0::DOUBLE * big * pow(t0, n) AS rho0, 6378137.0::DOUBLE * big * pow(tan(pi() / 4 - radians(b) / 2) / pow((1 - e * sin(radians(b))) / (1 + e * sin(radians(b))), e / 2), n) AS rho, radians(a + 120.5) * n AS theta FROM p, k, g)
SELECT p_partkey, round(radians(CAST(lon AS DOUBLE)) * 6378137.0, 3) AS x, round(ln(tan(pi() / 4 + radians(CAST(lat AS DOUBLE)) / 2)) * 6378137.0, 3) AS y, CAST(lon AS DOUBLE) AS lon, CAST(lat AS DOUBLE) AS lat,
       round(a, 6) AS plane_lon, round(b, 6) AS plane_lat, round(rho * sin(theta) / unit + 500000 / unit, 2) AS plane_x, round((rho0 - rho * cos(theta)) / unit, 2) AS plane_y
FROM q
"""


def export_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One snapshot written in every format and read back: rows and columns of each."""
    shapes = rectangles(spark, sf_dir)
    kinds = shapes.groupBy("p_brand").agg(F.count("*").alias("n"))
    root = scratch_folder(spark, "export")
    export({"shapes": shapes, "kinds": kinds}, root, small=("kinds",), features={"shapes": "geom"})
    back = {
        "parquet/shapes": spark.read.parquet(f"{root}/parquet/shapes"),
        "csv/shapes": spark.read.csv(f"{root}/csv/shapes", header=True),
        "json/kinds": spark.read.json(f"{root}/json/kinds"),
        "json_array/kinds": spark.read.json(f"{root}/json_array/kinds", multiLine=True),
        "features/shapes": spark.read.parquet(f"{root}/features/shapes"),
        "features_wkb/shapes": spark.read.parquet(f"{root}/features_wkb/shapes"),
    }
    figures = {"kinds": ("n", F.length("p_brand")), "shapes": ("p_partkey", F.col("p_size"))}
    extra = {"features/shapes": F.length("geom_json"), "features_wkb/shapes": F.length("geom_wkb")}

    def summed(output: str, d: DataFrame) -> DataFrame:
        first, second = figures[output.split("/")[1]]
        sums = [F.sum(c.cast("long")).alias(n) for n, c in (("first", F.col(first)), ("second", second), ("third", extra.get(output, F.lit(0))))]
        return d.agg(F.count("*").alias("n_rows"), *sums).select(F.lit(output).alias("output"), "n_rows", F.lit(len(d.columns)).alias("n_columns"), "first", "second", "third")

    out = None
    for k, d in back.items():
        out = summed(k, d) if out is None else out.unionByName(summed(k, d))
    return out


EXPORT_SHAPE = """
WITH kinds AS (SELECT p_brand, count(*) AS n FROM part GROUP BY 1),
shapes AS (SELECT *, p_partkey * 37 % 1000 AS x, p_partkey * 91 % 1000 AS y FROM part),
k AS (SELECT count(*) AS n_rows, CAST(sum(n) AS BIGINT) AS first, CAST(sum(length(p_brand)) AS BIGINT) AS second FROM kinds),
s AS (SELECT count(*) AS n_rows, CAST(sum(p_partkey) AS BIGINT) AS first, CAST(sum(p_size) AS BIGINT) AS second,
             CAST(sum(83 + length('' || x) * 3 + length('' || (x + p_size)) * 2 + length('' || y) * 3 + length('' || (y + p_size)) * 2) AS BIGINT) AS text FROM shapes)
SELECT o AS output, n_rows, CASE WHEN o LIKE 'json%' THEN 2 WHEN o LIKE 'features%' THEN 7 ELSE 6 END AS n_columns, first, second,
       CASE o WHEN 'features/shapes' THEN text WHEN 'features_wkb/shapes' THEN n_rows * 102 ELSE 0 END AS third
FROM (SELECT unnest(['json/kinds', 'json_array/kinds']) AS o), (SELECT *, NULL AS text FROM k)
UNION ALL SELECT o, n_rows, CASE WHEN o LIKE 'features%' THEN 7 ELSE 6 END, first, second, CASE o WHEN 'features/shapes' THEN text WHEN 'features_wkb/shapes' THEN n_rows * 102 ELSE 0 END
FROM (SELECT unnest(['parquet/shapes', 'csv/shapes', 'features/shapes', 'features_wkb/shapes']) AS o), s
"""


def feature_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature export: every column, the geometry as text, with the size class of each shape."""
    r = rectangles(spark, sf_dir)
    size = ordered_case([(F.col("p_size") < 10, "small"), (F.col("p_size") < 30, "medium"), (F.lit(True), "large")])
    return feature_columns(r.select("p_partkey", size.alias("size_class"), "geom"))


FEATURE_TEXT = """
WITH s AS (SELECT p_partkey, p_size, p_partkey * 37 % 1000 AS x, p_partkey * 91 % 1000 AS y, p_partkey * 37 % 1000 + p_size AS u, p_partkey * 91 % 1000 + p_size AS v FROM part)
SELECT p_partkey, CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'medium' ELSE 'large' END AS size_class,
       '{"type":"MultiPolygon","coordinates":[[[[' || x || '.0,' || y || '.0],[' || u || '.0,' || y || '.0],[' || u || '.0,' || v || '.0],[' || x || '.0,' || v || '.0],[' || x || '.0,' || y || '.0]]]]}' AS geom_json
FROM s
"""

QUERIES = {
    "overlap_pairs": overlap_pairs,
    "overlap_classes": overlap_classes,
    "overlap_area_polygon": overlap_area_polygon,
    "overlap_topk_text": counterpart_list,
    "findings_union": findings_union,
    "dup_discriminator": dup_discriminator,
    "merged_geometry": merged_geometry,
    "geometry_validity": geometry_validity,
    "geometry_repair": geometry_repair,
    "geometry_repair_loops": geometry_repair_loops,
    "dissolved_outline": dissolved_outline,
    "geometry_contracts": geometry_contracts,
    "geometry_simplify": geometry_simplify,
    "point_lookup": point_lookup,
    "dimension_projection": dimension_projection,
    "reproject": reproject,
    "export_shape": export_shape,
    "feature_text": feature_text,
}
SQL = {
    "overlap_pairs": f"WITH {PAIRS_SQL} SELECT p_brand, p_partkey_a, p_partkey_b, overlap_area, overlap_ratio, overlap_class, unflagged_coincident FROM classed",
    "overlap_classes": OVERLAP_CLASSES,
    "overlap_area_polygon": OVERLAP_AREA_POLYGON,
    "overlap_topk_text": f"WITH {COUNTERPARTS_SQL} SELECT * FROM lists",
    "findings_union": FINDINGS_UNION,
    "dup_discriminator": DUP_DISCRIMINATOR,
    "merged_geometry": MERGED_GEOMETRY,
    "geometry_validity": GEOMETRY_VALIDITY,
    "geometry_repair": GEOMETRY_REPAIR,
    "geometry_repair_loops": GEOMETRY_REPAIR_LOOPS,
    "dissolved_outline": DISSOLVED_OUTLINE,
    "geometry_contracts": GEOMETRY_CONTRACTS,
    "geometry_simplify": GEOMETRY_SIMPLIFY,
    "point_lookup": POINT_LOOKUP,
    "dimension_projection": DIMENSION_PROJECTION,
    "reproject": REPROJECT,
    "export_shape": EXPORT_SHAPE,
    "feature_text": FEATURE_TEXT,
}
