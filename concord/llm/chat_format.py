r"""Chat formatting: conversations become training texts of a budgeted number of tokens, with loss masks.

Turns lie on a line, one behind the other, each as long as its tokens: prefix sums of the turns' tokens, without
the system turn.  Window w owns the turns that begin in [w * grid, (w + 1) * grid) and repeats those that begin
in the ``history`` tokens before; the conversation's system turn stands at the head of each.  Windows are so
aligned to turns, no turn is cut, and each is owned once.  grid is what the budget leaves when the system turn, the
history and the longest turn have their tokens, but a quarter of the budget at least: only where these take more than
three quarters can a window exceed it.  The mask covers assistant turns that the window owns; repeated ones are
masked out.  Windows are a function of the prefix sums alone, so nothing is carried from one to the next.

A turn is ``<s>[INST]role[/INST]text</s>``.  Inside roles and texts a control string gets a backslash behind its first
character, and one that has k backslashes there gets one more, which is undone exactly.

Everything is window functions, joins and array functions.  Turns move once, by conversation; the windows and what
reads them back by conversation need no further shuffle.  A conversation on more than a thousandth of all rows (and
``skew.LEAST_ROWS``) is split: ranges of its turns are summed apart, the ranges' totals, of which there are
no more than ranges and such conversations, give each its place on the line, and its windows are put together
by (conversation, window).

Defined results: null texts and roles count as empty.  The system turn is the first one, if its role is
``system``; others are turns like any.  Turns of equal number follow by role, then text; null numbers come first; rows that
repeat are turns of their own.  Null ids are one conversation.  A turn longer than the budget is a window
(nearly) by itself, whole.  An empty table gives no windows.  Other columns, of any name, aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from . import skew
from .store import stored

OPEN, TEXT, END = "<s>[INST]", "[/INST]", "</s>"
#: A control string, with the backslashes behind its first character.
_CONTROL = r"([<\[])(\\*)(/?(?:s>|INST\]))"
_ESCAPED = r"([<\[])\\(\\*)(/?(?:s>|INST\]))"
#: Words, digits and other visible characters; and what a turn's marks count.
PIECES = r"[\p{L}\p{M}]+|\p{N}|[^\p{L}\p{M}\p{N}\x20\x09-\x0D]"
MARKS = 8
_ORDER = ["turn", "role", "text"]


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def turn_tokens(text: Column) -> Column:
    """Tokens of a turn, estimated: the pieces of its text and its marks."""
    return (F.regexp_count(text, F.lit(PIECES)) + MARKS).cast("long")


def _hot(turns: DataFrame) -> DataFrame | None:
    """Ids on more than a thousandth of all rows: fewer than ``skew.HOT_KEYS``, whatever the input."""
    counts = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    hot = stored(counts.where(F.col("n") > max(turns.count() // skew.HOT_KEYS, skew.LEAST_ROWS)).select("conv_id"), "hot")
    return None if hot.isEmpty() else hot


def _is_head() -> Column:
    return (F.col("rank") == 1) & (F.col("role") == "system")


def _figures() -> dict[str, Column]:
    """Aggregates of a conversation: tokens of its system turn, of its longest other turn, and before its last turn."""
    cost = F.col("cost")
    return {"head": F.max(F.when(_is_head(), cost)), "longest": F.max(F.when(~_is_head(), cost)), "before_last": F.max(F.col("upto") - cost)}


def _placed(turns: DataFrame) -> DataFrame:
    """Adds rank, the prefix sum ``upto`` and the figures of the conversation: all its turns meet."""
    whole = W.partitionBy("conv_id")
    line = whole.orderBy(*_ORDER).rowsBetween(W.unboundedPreceding, 0)
    ranked = turns.withColumns({"rank": F.row_number().over(line), "upto": F.sum("cost").over(line)})
    return ranked.withColumns({n: F.coalesce(c.over(whole), F.lit(0)) for n, c in _figures().items()})


def _placed_by_ranges(turns: DataFrame, hot: DataFrame) -> DataFrame:
    """The same for ``hot`` conversations, each in as many ranges of turns as it fills."""
    spark = turns.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The number of the row parts even rows that are equal.
    dealt = turns.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(ranges, "conv_id", *_ORDER, "row")
    dealt = stored(dealt.withColumn("range", F.spark_partition_id()), "turns")
    before = W.partitionBy("conv_id").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    sums = dealt.groupBy("conv_id", "range").agg(F.count("*").alias("rows"), F.sum("cost").alias("cost"))
    sums = sums.select(F.col("conv_id").alias("of"), F.col("range").alias("at"), *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("rows", "cost")])
    line = W.partitionBy("conv_id", "range").orderBy(*_ORDER, "row").rowsBetween(W.unboundedPreceding, 0)
    ranked = dealt.withColumns({"rank": F.row_number().over(line), "upto": F.sum("cost").over(line)})
    # A border of ranges parts one conversation at most: no more rows than ranges and hot conversations.
    ranked = ranked.join(F.broadcast(sums), F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("range") == F.col("at")))
    ranked = ranked.select("conv_id", *_ORDER, "cost", (F.col("rank") + F.col("rows_before")).alias("rank"), (F.col("upto") + F.col("cost_before")).alias("upto"))
    figures = ranked.groupBy(F.col("conv_id").alias("of")).agg(*[F.coalesce(c, F.lit(0)).alias(n) for n, c in _figures().items()])
    return ranked.join(F.broadcast(figures), F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")


def _rendered(placed: DataFrame, budget: int, history: int) -> DataFrame:
    """One row for each window, from turns with their places."""
    grid = F.greatest(F.lit(budget - history) - F.col("head") - F.col("longest"), F.lit(max(budget // 4, 1)))
    begin = F.col("upto") - F.col("cost") - F.col("head")
    window = lambda at: F.floor(at / F.col("grid")).cast("int")
    first = F.when(_is_head(), 0).otherwise(window(begin))
    last = F.when(_is_head(), window(F.greatest(F.col("before_last") - F.col("head"), F.lit(0)))).otherwise(window(begin + history))
    parts = {"opening": F.concat(F.lit(OPEN), escaped(F.col("role")), F.lit(TEXT)), "body": F.concat(escaped(F.col("text")), F.lit(END))}
    turns = placed.withColumn("grid", grid).withColumns({"first": first, "last": last, **parts})
    turns = turns.select("conv_id", "rank", "role", "cost", "opening", "body", "first", F.explode(F.sequence("first", "last")).alias("window"))
    along = W.partitionBy("conv_id", "window").orderBy("rank").rowsBetween(W.unboundedPreceding, 0)
    stop = F.sum(F.length("opening") + F.length("body")).over(along)
    fields = ["rank", (F.col("window") > F.col("first")).alias("repeated"), (F.col("role") == "assistant").alias("target"), F.length("body").cast("long").alias("size"), "cost", "stop", F.concat("opening", "body").alias("text")]
    rows = turns.withColumn("stop", stop).groupBy("conv_id", "window").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("turns"))
    repeated = F.size(F.filter("turns", lambda t: t["repeated"]))
    loss = F.transform(F.filter("turns", lambda t: t["target"] & ~t["repeated"]), lambda t: F.struct((t["stop"] - t["size"]).alias("start"), (t["stop"] - len(END)).alias("stop")))
    rows = rows.select("conv_id", "window", F.size("turns").alias("n_turns"), repeated.alias("n_repeated"), F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + t["cost"]).alias("n_tokens"), loss.alias("loss"), F.array_join(F.transform("turns", lambda t: t["text"]), "").alias("formatted"))
    return rows.where("n_turns > n_repeated")


def format_chat(conversations: DataFrame, budget: int = 1024, history: int = 128, tokens=turn_tokens) -> DataFrame:
    """conv_id, window, n_turns, n_repeated (the turns before those it owns), n_tokens, loss (spans of code points), formatted.

    ``conversations``: conv_id, turn, role, text.  ``tokens`` gives a turn's tokens from its text.
    """
    if not 0 <= history < budget:
        raise ValueError("history must be less than budget")
    role, text = (F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text"))
    turns = conversations.select("conv_id", "turn", role, text)
    hot = _hot(turns)
    turns = turns.withColumn("cost", tokens(F.col("text")))
    if hot is None:
        return _rendered(_placed(turns), budget, history)
    ids = F.broadcast(hot.select(F.col("conv_id").alias("of")))
    same = F.col("conv_id").eqNullSafe(F.col("of"))
    split = _placed_by_ranges(turns.join(ids, same, "left_semi"), hot)
    return _rendered(_placed(turns.join(ids, same, "left_anti")), budget, history).unionByName(_rendered(split, budget, history))


def read_back(windows: DataFrame) -> DataFrame:
    """Adds ``owned``, role and text of the turns that a window owns, and ``targets``, the texts under its mask, both read from ``formatted``."""
    pieces = F.slice(F.split("formatted", END), F.col("n_repeated") + 1, F.col("n_turns") - F.col("n_repeated"))

    def turn(piece: Column) -> Column:
        rest = F.substring(piece, F.lit(len(OPEN) + 1), F.length(piece))
        role = F.substring_index(rest, TEXT, 1)
        return F.struct(unescaped(role).alias("role"), unescaped(F.substring(rest, F.length(role) + F.lit(len(TEXT) + 1), F.length(rest))).alias("text"))

    masked = F.transform("loss", lambda s: unescaped(F.substring("formatted", (s["start"] + 1).cast("int"), (s["stop"] - s["start"]).cast("int"))))
    return windows.withColumns({"owned": F.transform(pieces, turn), "targets": masked})


def digests(windows: DataFrame) -> DataFrame:
    """One row for each conversation: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    A digest runs over a whole conversation, so one conversation's windows meet in one task here.
    """
    said = F.array_join(F.transform("owned", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    rows = read_back(windows).select("conv_id", F.struct("window", F.size("owned").cast("long").alias("n"), said.alias("said"), F.array_join("targets", "").alias("loss"), F.length("formatted").cast("long").alias("chars")).alias("w"))
    rows = rows.groupBy("conv_id").agg(F.sum("w.n").alias("n_turns"), F.sum("w.chars").alias("formatted_chars"), F.sort_array(F.collect_list("w")).alias("w"))
    joined = lambda field: F.array_join(F.transform("w", lambda w: w[field]), "")
    loss = joined("loss")
    return rows.select("conv_id", "n_turns", F.sha2(joined("said"), 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")
