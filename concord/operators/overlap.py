"""The spatial self-join: pairs of polygons of one source that overlap, on a hierarchy of grids.

Level k of the hierarchy has cells ``STEP`` times as wide as level k - 1.  A box lives on the finest level whose
cells are as wide as the box, where it touches four cells at most; so space is divided finely where boxes are
small and coarsely where they are large, whatever their mixture in one place.  Two boxes meet on the level of
the larger one: every box is posted there on the levels above its own as well, where it touches four cells at
most too, and only boxes at home on a level are looked for.  A pair is kept only in the cell that holds the lower
left corner of the two boxes' intersection, so it comes out once and no shuffle is needed to drop repeats.

Boxes that live in one cell are at least a quarter as wide as the cell, so a crowded cell is one whose boxes
overlap in truth.  Its searching rows are counted (a distributed count by cell) and dealt over so many slices that
none has more than ``SLICE``, with the boxes at home copied to each: one cell, even if it holds most of the rows,
is the work of many tasks.

Shapes that are the same, point for point, are one class: classes alone go through the grid and have their areas taken.
A pair of classes stays in the cell where it was found, unless it has a shape that isn't all of its box: pairs of records come
from the classes' lists of members there, their number and lists of counterparts from the classes' figures.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geometry as G
from ..functions.shapes import overlap_areas
from ..sources.sinks import materialise, scratch_folder

STEP = 4
#: Searching rows that one (cell, slice) may have.
SLICE = 1_024


def choose_cell(boxes: DataFrame, box: str = "box", share: float = 0.1) -> float:
    """The finest cell: as wide as ``share`` of all boxes at most (approximate percentile, one number to the driver)."""
    width = F.greatest(F.col(f"{box}.x1") - F.col(f"{box}.x0"), F.col(f"{box}.y1") - F.col(f"{box}.y0"))
    got = boxes.where(width > 0).agg(F.percentile_approx(width, share, 1000).alias("w")).first()["w"]
    return float(got) if got and got > 0 else 1.0


def posted(rows: DataFrame, key: str, source: str, cell: float, box: str = "box", most: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(searching, at home): rows by (source, at, cx, cy, slice), the first on their own level and those above, the second on their own."""
    most = most or SLICE
    x0, y0, x1, y1 = (F.col(f"{box}.{c}") for c in ("x0", "y0", "x1", "y1"))
    across = F.greatest(x1 - x0, y1 - y0) / F.lit(float(cell))
    level = F.greatest(F.lit(0), F.ceil(F.log(F.greatest(across, F.lit(1e-9))) / F.log(F.lit(float(STEP))))).cast("int")
    rows = rows.withColumn("level", level)
    # A handful of numbers: there are no more levels than powers of STEP between the smallest and the largest box.
    levels = F.array(*[F.lit(r[0]) for r in rows.select("level").distinct().orderBy("level").collect()]).cast("array<int>")
    size = F.lit(float(cell)) * F.pow(F.lit(float(STEP)), F.col("at"))
    cells = lambda low, high: F.explode(F.sequence(F.floor(low / size), F.floor(high / size)))
    everywhere = rows.withColumn("at", F.explode(F.filter(levels, lambda k: k >= F.col("level"))))
    searching = everywhere.withColumn("cx", cells(x0, x1)).withColumn("cy", cells(y0, y1))
    where = [source, "at", "cx", "cy"]
    home = rows.withColumn("at", F.col("level")).withColumn("cx", cells(x0, x1)).withColumn("cy", cells(y0, y1))
    crowded = searching.groupBy(*where).agg(F.count("*").alias("n")).where(F.col("n") > most).select(*where, F.ceil(F.col("n") / most).cast("int").alias("slices"))
    path = scratch_folder(rows.sparkSession, "crowded")
    crowded.write.parquet(path)
    crowded = rows.sparkSession.read.schema(crowded.schema).parquet(path)
    # Dealt over all tasks by number: how many pairs come of a row isn't seen from its bytes.
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if crowded.isEmpty():
        return tuple(side.repartition(n, *where).withColumn("slice", F.lit(0)) for side in (searching, home))
    slices = F.coalesce("slices", F.lit(1))
    own = F.pmod(F.xxhash64(key), slices).cast("int")
    searching = searching.join(crowded, where, "left").withColumn("slice", own).drop("slices")
    home = home.join(crowded, where, "left").withColumn("slice", F.explode(F.sequence(F.lit(0), slices - 1))).drop("slices")
    return searching.repartition(n, *where, "slice"), home.repartition(n, *where, "slice")


def _met(source: str, cell: float, box: str) -> Column:
    """Whether the boxes of a searching row a and of a row b at home overlap, and this is the cell that keeps the pair."""
    ax0, ay0, bx0, by0 = (F.col(f"{t}.{box}.{c}") for t in "ab" for c in ("x0", "y0"))
    boxes = (ax0 < F.col(f"b.{box}.x1")) & (bx0 < F.col(f"a.{box}.x1")) & (ay0 < F.col(f"b.{box}.y1")) & (by0 < F.col(f"a.{box}.y1"))
    size = F.lit(float(cell)) * F.pow(F.lit(float(STEP)), F.col("a.at"))
    corner = (F.floor(F.greatest(ax0, bx0) / size) == F.col("a.cx")) & (F.floor(F.greatest(ay0, by0) / size) == F.col("a.cy"))
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in (source, "at", "cx", "cy", "slice")]
    return same[0] & same[1] & same[2] & same[3] & same[4] & boxes & corner


def candidate_pairs(df: DataFrame, key: str, source: str, cell: float, box: str = "box", extra: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Pairs (key_a < key_b) of one source whose boxes overlap, with ``<column>_a`` and ``<column>_b`` of ``keep``.

    ``extra``: a further condition on a.* and b.*, the same whichever of the two is a, tried before anything dear.
    """
    rows = df.where(F.col(f"{box}.x0").isNotNull()).select(*dict.fromkeys([key, source, box, *keep]))
    searching, home = posted(rows, key, source, cell, box)
    a, b = searching.alias("a"), home.alias("b")
    # Boxes of one level find each other from both sides: the smaller key searches.
    first = F.col(f"a.{key}") < F.col(f"b.{key}")
    condition = _met(source, cell, box) & ((F.col("a.level") < F.col("b.level")) | first)
    if extra is not None:
        condition &= extra
    side = {"a": F.when(first, "a").otherwise("b"), "b": F.when(first, "b").otherwise("a")}
    seen = lambda t, c: F.when(side[t] == "a", F.col(f"a.{c}")).otherwise(F.col(f"b.{c}")).alias(f"{c}_{t}")
    # Never broadcast by the size of the file that the boxes are made of.
    return a.join(b.hint("merge"), condition).select(F.col(f"a.{source}").alias(source), *[seen(t, c) for t in "ab" for c in (key, *keep)])


def _shaped(df: DataFrame, source: str, geom: str, parent: str | None, stacked: str | None) -> DataFrame:
    """The rows that can pair, with the ``shape`` that they share with their like: 128 bits of digest."""
    rows = df.where(F.col(geom).isNotNull() & ~G.is_empty(F.col(geom)) & F.col(source).isNotNull())
    if parent:
        rows = rows.where(F.col(parent).isNotNull())  # of no known parent: pairs with none
    flag = [F.coalesce(F.col(stacked).cast("string"), F.lit("unknown"))] if stacked else []
    return rows.withColumn("shape", F.struct(*[F.xxhash64(F.lit(k), source, *flag, geom).alias(c) for k, c in ((1, "h1"), (2, "h2"))]))


def shape_classes(df: DataFrame, key: str, source: str, geom: str = "geom", parent: str | None = None, stacked: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(members, classes) of the shapes that aren't empty: source, key and parent of each record with its ``shape``; and source, ``shape``, n, box, area, stacked, geometry of each class and whether it is all of its box (``filled``), kept as a table.

    Records of one source whose shapes are the same and which are flagged alike have one ``shape``.
    """
    rows = _shaped(df, source, geom, parent, stacked)
    members = rows.select("shape", source, key, *([parent] if parent else []))
    first = [F.first(c).alias(c) for c in ([stacked] if stacked else [])]
    classes = rows.groupBy(source, "shape").agg(F.count("*").alias("n"), *first, F.first(geom).alias(geom)).withColumn("box", G.bbox(F.col(geom)))
    return members, materialise(classes.withColumn("area", G.area(F.col(geom))).withColumn("filled", G.fills(F.col(geom), F.col("box"))), "shape_classes")


def with_overlap(pairs: DataFrame, classes: DataFrame, geom: str, a: str = "a", b: str = "b") -> DataFrame:
    """Adds ``overlap_area`` of the classes ``shape_<a>`` and ``shape_<b>``, of which the pairs have ``box_`` and ``filled_`` as well.

    Two boxes share a box, so pairs of shapes that fill theirs stay where they are.  The geometries of others join the pairs,
    and the area comes from an Arrow function over them, which the optimiser neither repeats nor pulls into the join.
    """
    kinds = {r[0] for r in classes.select("filled").distinct().collect()}
    edge = lambda f, g, c: F.greatest(f(*[F.col(f"box_{t}.{c}1") for t in (a, b)]) - g(*[F.col(f"box_{t}.{c}0") for t in (a, b)]), F.lit(0.0))
    both = F.col(f"filled_{a}") & F.col(f"filled_{b}")
    plain = pairs.where(both if kinds == {True, False} else F.lit(True in kinds)).withColumn("overlap_area", edge(F.least, F.greatest, "x") * edge(F.least, F.greatest, "y"))
    rest = pairs.where(~both if kinds == {True, False} else F.lit(False in kinds))
    for t in (a, b):
        rest = rest.join(classes.select(F.col("shape").alias(f"shape_{t}"), F.col(geom).alias(f"{geom}_{t}")).hint("merge"), f"shape_{t}")
    n = len(pairs.columns)
    rest = rest.select(*pairs.columns, f"{geom}_{a}", f"{geom}_{b}")
    schema = T.StructType([*pairs.schema.fields, T.StructField("overlap_area", T.DoubleType(), False)])

    def run(batches):
        for batch in batches:
            area = overlap_areas(batch.column(n), batch.column(n + 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(area)], names=[f.name for f in schema.fields])

    return plain.unionByName(rest.mapInArrow(run, schema))


def class_pairs(rows: DataFrame, classes: DataFrame, source: str, geom: str = "geom", stacked: str | None = None, least_area: float = 1.0, cell: float | None = None, key: str = "shape", more: tuple[str, ...] = ()) -> DataFrame:
    """Pairs of classes (key_a < key_b, and each class of several records with itself) that overlap by more than ``least_area``.

    ``rows``: the classes, or several rows of each, with a ``key`` and ``more`` columns of their own.  The grid join
    moves these and boxes only.
    """
    keep = tuple(dict.fromkeys(c for c in ("shape", "box", "filled", "area", "n", stacked, *more) if c and c != key))
    extra = None
    alone = (F.col("n") > 1) & (F.col("box.x0") < F.col("box.x1")) & (F.col("box.y0") < F.col("box.y1"))
    if stacked:
        extra = ~(F.coalesce(F.col(f"a.{stacked}"), F.lit(False)) & F.coalesce(F.col(f"b.{stacked}"), F.lit(False)))
        alone &= ~F.coalesce(F.col(stacked), F.lit(False))
    pairs = candidate_pairs(rows, key, source, cell or choose_cell(classes), extra=extra, keep=keep)
    pairs = pairs.unionByName(rows.where(alone).select(source, *[F.col(c).alias(f"{c}_{t}") for t in "ab" for c in (key, *keep)]))
    pairs = with_overlap(pairs, classes, geom).where(F.col("overlap_area") > least_area).drop("box_a", "box_b", "filled_a", "filled_b")
    return pairs.withColumn("overlap_ratio", F.col("overlap_area") / F.nullif(F.least("area_a", "area_b"), F.lit(0.0)))


def overlap_pairs(df: DataFrame, key: str, source: str, geom: str = "geom", parent: str | None = None, stacked: str | None = None, least_area: float = 1.0, cell: float | None = None) -> DataFrame:
    """Pairs that overlap by more than ``least_area``: overlap_area and overlap_ratio (to the smaller of the two).

    ``key`` is unique; records of one ``parent`` never pair, nor do two ``stacked`` ones.  Classes go through the grid with
    their members, large ones in pieces of about ``SLICE``, and pairs of records come from both lists where the pieces meet:
    no pair is moved.
    """
    members, classes = shape_classes(df, key, source, geom, parent, stacked)
    member = F.struct(F.col(key).alias("k"), *([F.col(parent).alias("p")] if parent else []))
    large = classes.where(F.col("n") > SLICE).select("shape", F.ceil(F.col("n") / SLICE).cast("int").alias("slices"))
    dealt = members.join(large.hint("merge"), "shape", "left").withColumn("slice", F.pmod(F.xxhash64(key), F.coalesce("slices", F.lit(1))).cast("int"))
    pieces = dealt.groupBy("shape", "slice").agg(F.collect_list(member).alias("members")).join(classes.drop(geom).hint("merge"), "shape")
    pieces = materialise(pieces.withColumn("piece", F.monotonically_increasing_id()), "shape_pieces")
    pairs = class_pairs(pieces, classes, source, geom, stacked, least_area, cell, "piece", ("members",))
    stay = [c for c in pairs.columns if not c.startswith("members_")]
    both = pairs.select(*stay, F.explode("members_a").alias("_a"), "members_b").select(*stay, "_a", F.explode("members_b").alias("_b"))
    first = F.col("_a.k") < F.col("_b.k")
    apart = (F.col("piece_a") != F.col("piece_b")) | first
    if parent:
        apart &= F.col("_a.p") != F.col("_b.p")
    names = {key: "_{}.k", "area": "area_{}", **({parent: "_{}.p"} if parent else {}), **({stacked: stacked + "_{}"} if stacked else {})}
    turned = lambda c, t: F.when(first, F.col(c.format(t))).otherwise(F.col(c.format("b" if t == "a" else "a")))
    return both.where(apart).select(source, *[turned(c, t).alias(f"{n}_{t}") for t in "ab" for n, c in names.items()], "overlap_area", "overlap_ratio")


def counted_pairs(df: DataFrame, key: str, source: str, geom: str = "geom", parent: str | None = None, stacked: str | None = None, least_area: float = 1.0, cell: float | None = None) -> DataFrame:
    """Pairs of classes with ``n_pairs``, the number of the pairs of ``overlap_pairs`` that are of them; none without any.

    All pairs of members but those of one parent, which are counted from the classes within each parent.
    """
    members, classes = shape_classes(df, key, source, geom, parent, stacked)
    pairs = class_pairs(classes, classes, source, geom, stacked, least_area, cell)
    n_a, n_b = F.col("n_a"), F.col("n_b")
    same = F.col("shape_a") == F.col("shape_b")
    every = F.when(same, (n_a * (n_a - 1) / 2).cast("long")).otherwise(n_a * n_b)
    if not parent:
        return pairs.withColumn("n_pairs", every).where("n_pairs > 0")
    within = members.groupBy(parent, "shape").agg(F.count("*").alias("m"))
    a, b = (within.select(parent, F.col("shape").alias(f"shape_{t}"), F.col("m").alias(f"m_{t}")) for t in "ab")
    kin = F.when(same, (F.col("m_a") * (F.col("m_a") - 1) / 2).cast("long")).otherwise(F.col("m_a") * F.col("m_b"))
    related = a.join(b.hint("merge"), parent).where("shape_a <= shape_b").groupBy("shape_a", "shape_b").agg(F.sum(kin).alias("related"))
    return pairs.join(related.hint("merge"), ["shape_a", "shape_b"], "left").withColumn("n_pairs", every - F.coalesce("related", F.lit(0))).drop("related").where("n_pairs <> 0")


def parents_in_reach(df: DataFrame, key: str, source: str, parent: str, geom: str = "geom", stacked: str | None = None, least_area: float = 1.0, flags: dict[str, Column] | None = None, top: int = 5) -> tuple[DataFrame, DataFrame]:
    """(members, reach): each record with its shape and parent, and whether what it overlaps has its parent though not its shape (``kin_met``);
    and for each class that overlaps any the number of parents in its ``reach`` (``n``), whether it overlaps itself, the ``top`` + 1 of them
    that it overlaps most, ties by name (``first``), and for each of ``flags`` the least and the greatest of the parents of flagged pairs.

    A record's counterparts are the parents that its class reaches, without its own: what is left out of pairs are those
    of one parent.  ``flags``: conditions on classified pairs.  Pairs of classes are summed up where they are found, by the
    number and the first of each class's parents; a parent of several classes is counted once for each, and what is too
    much is taken off by those shapes that meet two of its classes (``_met_again``).
    """
    flags = flags or {}
    members, classes = shape_classes(df, key, source, geom, parent, stacked)
    kin = materialise(members.select(source, "shape", parent).distinct(), "shape_parents")
    most = kin.groupBy(source, parent).count().agg(F.max("count")).first()[0] or 1
    figures = kin.groupBy("shape").agg(F.count("*").alias("parents"), F.min(parent).alias("low"), F.max(parent).alias("high"))
    classes = materialise(classes.join(figures.hint("merge"), "shape").withColumn("class", F.monotonically_increasing_id()), "shape_figures")
    cell = choose_cell(classes)
    pairs = classify_overlaps(class_pairs(classes, classes, source, geom, stacked, least_area, cell, "class", ("parents", "low", "high")), stacked)
    way = lambda t, o: F.struct(F.col(f"class_{t}").alias("class"), *[F.col(f"{c}_{o}").alias(n) for c, n in (("class", "other"), ("parents", "parents"), ("low", "low"), ("high", "high"))])
    ways = F.when(F.col("class_a") == F.col("class_b"), F.array(way("a", "b"))).otherwise(F.array(way("a", "b"), way("b", "a")))
    directed = pairs.select(F.explode(ways).alias("w"), "overlap_area", *[c.alias(n) for n, c in flags.items()]).select("w.*", "overlap_area", *flags)
    ends = [f(F.when(F.col(n), F.col(c))).alias(f"{c}_{n}") for n in flags for f, c in ((F.min, "low"), (F.max, "high"))]
    totals = directed.groupBy("class").agg(F.sum("parents").alias("n"), F.bool_or(F.col("class") == F.col("other")).alias("itself"), *ends)
    # So many of the classes it overlaps most hold the ``top`` + 1 parents: each has one, and no parent is in more than ``most``.
    rank = F.row_number().over(W.partitionBy("class").orderBy(F.desc("overlap_area"), "low"))
    best = directed.select("class", "other", "overlap_area", "low").withColumn("rank", rank).where(F.col("rank") <= (top + 1) * most)
    rank = F.row_number().over(W.partitionBy("shape").orderBy(parent))
    few = kin.select("shape", parent).withColumn("rank", rank).where(F.col("rank") <= top + 1).join(classes.select("shape", F.col("class").alias("other")).hint("merge"), "shape")
    each = best.select("class", "other", "overlap_area").join(few.select("other", F.col(parent).alias("counterpart")).hint("merge"), "other")
    each = each.repartition("class").groupBy("class", "counterpart").agg(F.max("overlap_area").alias("area"))
    rank = F.row_number().over(W.partitionBy("class").orderBy(F.desc("area"), "counterpart"))
    first = each.withColumn("rank", rank).where(F.col("rank") <= top + 1).groupBy("class").agg(F.sort_array(F.collect_list(F.struct("rank", "counterpart", "area"))).alias("first"))
    reach = totals.join(first.hint("merge"), "class").join(classes.select("class", "shape").hint("merge"), "class")
    if most == 1:
        return members.withColumn("kin_met", F.lit(False)), reach
    meeting, again = _met_again(kin, classes, source, parent, geom, stacked, least_area, cell)
    reach = reach.join(again.hint("merge"), "class", "left").withColumn("n", F.col("n") - F.coalesce("again", F.lit(0))).drop("again")
    members = members.join(meeting.hint("merge"), ["shape", parent], "left").withColumn("kin_met", F.coalesce("kin_met", F.lit(False)))
    return members, reach


def _met_again(kin: DataFrame, classes: DataFrame, source: str, parent: str, geom: str, stacked: str | None, least_area: float, cell: float) -> tuple[DataFrame, DataFrame]:
    """(meeting, again) of the parents with several classes in one source: shape and parent where two of its classes overlap; and for each
    class by how much the number of (class, parent) it reaches is above that of parents.

    Two classes of one parent go through the grid as one row, with the box of the first; what meets it meets the box of the second as well.
    """
    columns = ("class", "shape", "box", "filled", "n", *([stacked] if stacked else []))
    side = lambda t: kin.select(source, parent, F.col("shape").alias(f"shape_{t}"))
    twins = side("a").join(side("b").hint("merge"), [source, parent]).where("shape_a < shape_b")
    for t in "ab":
        twins = twins.join(classes.select(*[F.col(c).alias(f"{c}_{t}") for c in columns]).hint("merge"), f"shape_{t}")
    twins = materialise(twins, "shape_twins")
    flagged = lambda t: F.coalesce(F.col(f"{stacked}_{t}"), F.lit(False)) if stacked else F.lit(False)
    meeting = with_overlap(twins.where(G.boxes_meet(F.col("box_a"), F.col("box_b")) & ~(flagged("a") & flagged("b"))), classes, geom).where(F.col("overlap_area") > least_area)
    meeting = meeting.select(parent, F.explode(F.array("shape_a", "shape_b")).alias("shape")).distinct().withColumn("kin_met", F.lit(True))
    # What is looked for and what looks for it are posted together, and each row joins the other kind only.
    ours = classes.select(source, "box", *[F.col(c).alias(f"{c}_s") for c in columns])
    theirs = twins.select(source, F.col("box_a").alias("box"), *[c for c in twins.columns if c != source])
    rows = ours.withColumn("theirs", F.lit(False)).unionByName(theirs.withColumn("theirs", F.lit(True)), allowMissingColumns=True)
    searching, home = posted(rows.where("box.x0 is not null").withColumn("row", F.monotonically_increasing_id()), "row", source, cell)
    found = []
    for s, o in (("a", "b"), ("b", "a")):
        sides = {"a": searching.where(F.col("theirs") == (s == "b")).alias("a"), "b": home.where(F.col("theirs") == (s == "a")).alias("b")}
        pick = [F.col(f"{s}.{c}_s").alias(f"{c}_s") for c in columns] + [F.col(f"{o}.{c}").alias(c) for c in (parent, *[f"{c}_{t}" for t in "ab" for c in columns])]
        # Those of one level meet where the class searches.
        once = F.lit(True) if s == "a" else F.col("a.level") < F.col("b.level")
        found.append(sides["a"].join(sides["b"].hint("merge"), _met(source, cell, "box") & once & G.boxes_meet(F.col(f"{s}.box_s"), F.col(f"{o}.box_b"))).select(*pick))
    both = found[0].unionByName(found[1])
    for t in "ab":
        # A class meets itself if it is of several records.
        fits = ((F.col("shape_s") != F.col(f"shape_{t}")) | (F.col("n_s") > 1)) & ~(flagged("s") & flagged(t))
        both = with_overlap(both.where(fits), classes, geom, "s", t).where(F.col("overlap_area") > least_area).drop("overlap_area")
    each = both.select("class_s", parent, F.explode(F.array("class_a", "class_b")).alias("met")).distinct().groupBy("class_s", parent).agg((F.count("*") - 1).alias("more"))
    return meeting, each.groupBy(F.col("class_s").alias("class")).agg(F.sum("more").alias("again"))


def classify_overlaps(pairs: DataFrame, stacked: str | None = None, coincident: float = 0.8) -> DataFrame:
    """Adds overlap_class and unflagged_coincident (coincident though neither record is flagged as stacked)."""
    out = pairs.withColumn("overlap_class", F.when(F.col("overlap_ratio") >= coincident, "coincident").otherwise("encroachment"))
    flagged = [F.coalesce(F.col(f"{stacked}_{t}"), F.lit(False)) for t in "ab"] if stacked else [F.lit(False)] * 2
    return out.withColumn("unflagged_coincident", (F.col("overlap_class") == "coincident") & ~flagged[0] & ~flagged[1])


def overlap_invariants(key: str, parent: str | None, stacked: str, least_area: float = 1.0, coincident: float = 0.8) -> dict[str, Column]:
    """What no pair may be, by name: conditions on classified pairs that only wrong code can make true.

    Without ``parent`` the pairs are of classes, with n_pairs: more of them were left out as of one parent than there are.
    """
    both = F.coalesce(F.col(f"{stacked}_a"), F.lit(False)) & F.coalesce(F.col(f"{stacked}_b"), F.lit(False))
    either = F.coalesce(F.col(f"{stacked}_a"), F.lit(False)) | F.coalesce(F.col(f"{stacked}_b"), F.lit(False))
    is_coincident = F.col("overlap_class") == "coincident"
    return {
        "both_stacked": both,
        "not_ordered": F.col(f"{key}_a") >= F.col(f"{key}_b") if parent else F.col(f"{key}_a") > F.col(f"{key}_b"),
        "one_parent": F.col(f"{parent}_a") == F.col(f"{parent}_b") if parent else F.col("n_pairs") < 0,
        "ratio_out_of_range": F.col("overlap_ratio").isNull() | (F.col("overlap_ratio") <= 0) | (F.col("overlap_ratio") > 1.0000001),
        "area_too_small": F.col("overlap_area") <= least_area,
        "wrongly_unflagged": F.col("unflagged_coincident") & (~is_coincident | either),
        "class_unknown": ~F.coalesce(F.col("overlap_class").isin("coincident", "encroachment"), F.lit(False)),
        "class_against_ratio": (F.col("overlap_ratio") >= coincident) != is_coincident,
    }


def both_directions(pairs: DataFrame, columns: dict[str, tuple[str, str]], shared: list[str]) -> DataFrame:
    """Each pair once from either side: ``columns`` gives for each output the pair's column seen from a and from b."""
    sides = [F.struct(*[F.col(c[i]).alias(n) for n, c in columns.items()]) for i in (0, 1)]
    return pairs.select(*shared, F.explode(F.array(*sides)).alias("_side")).select(*shared, "_side.*")
