"""Sharding by a k-d tree over document metadata, in DataFrame operations only.

The tree splits all rows at the weighted median (weights: bytes) of the widest metadata dimension,
again and again, until the leaves are the shards.  Medians come from histograms: each round counts
the bytes in each bin of each open node and narrows the median to one bin, so that only nodes x bins
rows move, whatever the size of the table.  A node is known by its first leaf; the nodes and splits of a
level are small tables, of at most as many rows as there are leaves, and rows find theirs by a join.
Nothing is collected, and no expression grows with the tree.

Dimensions are functions of the text (log size, share of bytes beyond ASCII, line length), and a
split also compares a hash of the text, so equal texts always fall on the same side and a median is
exact to one group of equal texts.

Defined results: a null text has no bytes (size 1, CRC 0) and groups with the empty text; very long texts
are measured whole; null and repeated ids and repeated rows are rows like any other.  Ties: of dimensions
of equal width the first is split; of borders equally near the median the upper one is taken.  An empty
table gives no rows.  Columns of any name are kept, but size, text_crc32, shard and slot are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .store import discard, stored
from .text import free_name

#: Bits of a dimension's place, of the hash that breaks its ties, and of one histogram round.
PLACE_BITS, TIE_BITS, ROUND_BITS = 24, 24, 12
_BITS = PLACE_BITS + TIE_BITS
#: Splits of a level are broadcast up to so many leaves.
BROADCAST_LEAVES = 100_000


def dimensions(text: Column) -> list[Column]:
    """Metadata of a text, each between 0 and 1."""
    size, chars = F.octet_length(text), F.length(text)
    lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    return [
        F.least(F.log2(size + 1) / 40, F.lit(1.0)),
        F.when(size > 0, (size - chars) / size).otherwise(0.0),
        F.least(F.log2(chars / lines + 1) / 40, F.lit(1.0)),
    ]


def _small(table: DataFrame, leaves: int) -> DataFrame:
    """A table of at most one row a leaf, broadcast while that is few."""
    return F.broadcast(table) if leaves <= BROADCAST_LEAVES else table


def _key(dims: str, tie: str, split: str = "") -> Column:
    """A row's place along the dimension that its node splits, then its hash; ``split``: the struct that has which, low and wide."""
    at = F.floor((F.element_at(dims, F.col(f"{split}which")) - F.col(f"{split}low")) / F.col(f"{split}wide") * (1 << PLACE_BITS))
    place = F.greatest(F.least(at, F.lit((1 << PLACE_BITS) - 1)), F.lit(0)).cast("long")
    return F.shiftleft(place, TIE_BITS) + F.col(tie)


def _splits(rows: DataFrame, nodes: DataFrame, shards: int, n_dims: int) -> DataFrame:
    """node, leaves and what splits it: dimension (which), its low and wide, and the border key.  ``rows``: node, dims, tie, w; stored."""
    ends = [f(F.element_at("dims", i + 1)).alias(f"{k}{i}") for i in range(n_dims) for k, f in (("lo", F.min), ("hi", F.max))]
    widths = F.array(*[F.col(f"hi{i}") - F.col(f"lo{i}") for i in range(n_dims)])
    which = F.array_position(widths, F.array_max(widths)).cast("int")  # the first of the widest
    state = rows.groupBy("node").agg(F.sum("w").alias("total"), *ends).join(_small(nodes.where("leaves > 1"), shards), "node")
    state = state.withColumn("which", which).select(
        "node", "leaves", "which", F.element_at(F.array(*[F.col(f"lo{i}") for i in range(n_dims)]), F.col("which")).alias("low"),
        F.coalesce(F.nullif(F.array_max(widths), F.lit(0.0)), F.lit(1.0)).alias("wide"), F.expr("total * (leaves div 2) div leaves").alias("aim"), F.lit(0).cast("long").alias("border"),
    )
    state = stored(state, "nodes")
    for shift in range(_BITS - ROUND_BITS, -1, -ROUND_BITS):
        # ``border``: the bits found so far; ``aim``: the weight still to reach among the keys that have them.
        keyed = rows.join(_small(state, shards), "node").withColumn("key", _key("dims", "tie")).where(F.shiftright("key", shift + ROUND_BITS) == F.col("border"))
        bins = keyed.groupBy("node", F.shiftright("key", shift).alias("bin")).agg(F.sum("w").alias("w"), F.max("aim").alias("aim"))
        up_to = bins.withColumn("up_to", F.sum("w").over(W.partitionBy("node").orderBy("bin"))).where("up_to >= aim")
        # The first bin that reaches the aim.
        first = up_to.groupBy("node").agg(F.min_by(F.struct("bin", "w", "up_to"), "bin").alias("b"))
        left = F.col("aim") - (F.col("b.up_to") - F.col("b.w"))
        border = F.col("b.bin")
        if shift == 0:  # the nearer of the two borders of the last bin
            border = F.when(2 * left < F.col("b.w"), border - 1).otherwise(border)
        before, state = state, stored(state.drop("border").join(first, "node").select("node", "leaves", "which", "low", "wide", left.alias("aim"), border.alias("border")), "nodes")
        discard(before)
    return state


def _assigned(rows: DataFrame, splits: DataFrame, shards: int, node: str, dims: str, tie: str) -> DataFrame:
    """``rows`` with the node one level down; ``splits`` has the columns of _splits()."""
    split = free_name(rows.columns, "_split")
    packed = splits.select(F.col("node").alias(node), F.struct("leaves", "which", "low", "wide", "border").alias(split))
    both = rows.join(_small(packed, shards), node, "left")
    down = F.when(_key(dims, tie, f"{split}.") > F.col(f"{split}.border"), F.col(node) + F.expr(f"{split}.leaves div 2").cast("int")).otherwise(F.col(node))
    return both.select(*[F.col(f"`{c}`") for c in rows.columns if c != node], down.alias(node))


def build_tree(rows: DataFrame, shards: int, n_dims: int) -> list[DataFrame]:
    """The splits of each level, as stored tables, until ``shards`` leaves.  ``rows``: dims, tie and w."""
    nodes = rows.sparkSession.range(1).select(F.lit(0).alias("node"), F.lit(shards).alias("leaves"))
    rows = stored(rows.withColumn("node", F.lit(0)), "metadata")
    levels: list[DataFrame] = []
    most = shards
    while most > 1:
        splits = _splits(rows, nodes, shards, n_dims)
        levels.append(splits)
        half = F.expr("leaves div 2").cast("int")
        below = F.array(F.struct(F.col("node"), half.alias("leaves")), F.struct((F.col("node") + half).alias("node"), (F.col("leaves") - half).alias("leaves")))
        nodes = splits.select(F.inline(below))
        most -= most // 2
        if most > 1:
            before, rows = rows, stored(_assigned(rows, splits, shards, "node", "dims", "tie"), "metadata")
            discard(before)
    discard(rows)
    return levels


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, text: str = "text", ids: tuple[str, ...] = ("doc_id",), blocks: int | None = None) -> DataFrame:
    """Adds size, text_crc32, shard and slot (gapless from 0 in each shard); the text goes.

    Give the number of ``shards`` or the ``target_bytes`` of a leaf.  Slots are numbered in two steps:
    rows are dealt by hash to ``blocks`` blocks, numbered within a block, and offset by the counts of
    the blocks before, so no task sorts a whole shard.
    """
    own = ("size", "text_crc32", "shard", "slot")
    keep = [c for c in docs.columns if c.lower() not in own and c != text]
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    names = [free_name(keep, c) for c in ("dims", "tie", "block", "hash", "before")]
    dims, tie, deal, hash_, before = names
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], (F.octet_length(whole) + 1).cast("long").alias("size"), F.crc32(whole).alias("text_crc32"), F.xxhash64(whole).alias(hash_), F.array(*dimensions(whole)).alias(dims))
    rows = rows.withColumn(tie, F.shiftrightunsigned(hash_, 64 - TIE_BITS))
    rows = stored(rows, "measured")
    if shards is None:
        total = rows.agg(F.sum("size")).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    rows = rows.withColumn("shard", F.lit(0))
    for splits in build_tree(rows.select(F.col(dims).alias("dims"), F.col(tie).alias("tie"), F.col("size").alias("w")), shards, 3):
        rows = _assigned(rows, splits, shards, "shard", dims, tie)
    order = [F.col(f"`{c}`") for c in ids if c in keep]
    blocks = blocks or 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn(deal, F.pmod(F.xxhash64(*order, F.col(hash_)), F.lit(blocks)).cast("int"))
    counts = rows.groupBy("shard", deal).agg(F.count("*").alias("n"))
    # shards x blocks rows, however large the table.
    start = counts.select("shard", deal, (F.sum("n").over(W.partitionBy("shard").orderBy(deal)) - F.col("n")).alias(before))
    slot = F.row_number().over(W.partitionBy("shard", deal).orderBy(*order, hash_)) - 1
    rows = rows.withColumn("slot", slot.cast("long")).join(F.broadcast(start) if shards * blocks <= 100_000 else start, ["shard", deal])
    return rows.select(*[F.col(f"`{c}`") for c in keep], "size", "text_crc32", "shard", (F.col("slot") + F.col(before)).alias("slot"))
