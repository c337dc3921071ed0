"""Cleaning, identity and comparison as Column expressions (three-valued: null stays null)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def blank_to_null(c: Column) -> Column:
    """The trimmed text, null if nothing is left. Trims spaces only."""
    return F.nullif(F.trim(c.cast("string")), F.lit(""))


def sentinel_to_null(c: Column, *sentinels: str) -> Column:
    """Null where the trimmed text is one of the sentinels."""
    text = F.trim(c.cast("string"))
    return F.when(~text.isin(*sentinels), text)


def regex_group(c: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match in the trimmed text; null (not ``''``) without a match."""
    return F.nullif(F.regexp_extract(F.trim(c.cast("string")), pattern, group), F.lit(""))


def zip5(c: Column) -> Column:
    return regex_group(c, "^([0-9]{5})")


def zip4(c: Column) -> Column:
    """The last four digits of a whole ZIP+4, else null."""
    return regex_group(c, "^[0-9]{5}-([0-9]{4})$")


def is_true(c: Column) -> Column:
    """A mapped condition as a plain boolean: unknown counts as false."""
    return F.coalesce(c, F.lit(False))


def namespaced_id(namespace: Column, ident: Column) -> Column:
    """``namespace-ident``; null if the identifier is null."""
    return F.concat(namespace, F.lit("-"), blank_to_null(ident))


def record_key(uid: Column, fields: Iterable[Column]) -> Column:
    """The id followed by the declared key fields, ``~`` for a blank one; null if the id is null."""
    return F.concat(uid, *[F.concat(F.lit("|"), F.coalesce(blank_to_null(f), F.lit("~"))) for f in fields])


def as_text(df: DataFrame, name: str) -> Column:
    """A column as text that doesn't depend on the engine's way of writing numbers.

    Whole numbers of any numeric type have no decimal point; other reals are written with 6 places;
    times are microseconds since 1970; booleans are true or false.
    """
    kind, c = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        whole = F.floor(c) == c
        return F.when(whole, c.cast("decimal(38,0)").cast("string")).otherwise(c.cast("decimal(38,6)").cast("string"))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("string")
    return c.cast("string")


def row_signature(df: DataFrame, exclude: Iterable[str] = ()) -> Column:
    """md5 over every column of the live schema but the excluded ones, so a new column is taken in."""
    out = {e.lower() for e in exclude}
    return F.md5(F.concat_ws("|", *[as_text(df, c) for c in df.columns if c.lower() not in out]))


def recovered_key(key: Column, ident: Column, pattern: str) -> tuple[Column, Column]:
    """(the key, else what the pattern finds in the identifier; whether it was recovered)."""
    return F.coalesce(blank_to_null(key), regex_group(ident, pattern)), blank_to_null(key).isNull()


def code_or_name(value: Column, width: int, code_of_name: Column) -> tuple[Column, Column]:
    """(a numeric value padded to ``width``, else the code found by name; whether the name was needed)."""
    numeric = value.rlike("^[0-9]+$")
    return F.when(numeric, F.lpad(value, width, "0")).otherwise(F.lpad(code_of_name, width, "0")), ~numeric


def squeezed(c: Column) -> Column:
    """Lower case without spaces, for joins on names."""
    return F.replace(F.lower(c), F.lit(" "), F.lit(""))


def ratio(a: Column, b: Column) -> Column:
    """a / b; null where b is 0 or null."""
    return a / F.nullif(b, F.lit(0).cast("double"))


def out_of_range(c: Column, low: str, high: str) -> Column:
    """Present and outside the range; false if null."""
    return c.isNotNull() & ~F.coalesce(c.between(low, high), F.lit(True))


def tri_state(flag: Column) -> Column:
    return F.when(flag, "flagged").when(flag.isNull(), "not_measurable").otherwise("clear")


def ordered_case(pairs: Iterable[tuple[Column, str]]) -> Column:
    """The label of the first condition that is true, else null."""
    out: Column | None = None
    for condition, label in pairs:
        out = F.when(condition, label) if out is None else out.when(condition, label)
    return out if out is not None else F.lit(None).cast("string")


def for_comparison(c: Column, text: bool) -> Column:
    return F.upper(F.trim(c)) if text else c


def field_status(ours: Column, theirs: Column, text: bool = False) -> Column:
    a, b = for_comparison(ours, text), for_comparison(theirs, text)
    return (
        F.when(a.isNull() & b.isNull(), "both_null")
        .when(a.isNull(), "ours_absent")
        .when(b.isNull(), "theirs_absent")
        .when(a == b, "agree")
        .otherwise("disagree")
    )


def rounded_to_long(c: Column) -> Column:
    """Half-even rounding of a double to a long."""
    return F.rint(c).cast("long")


def date_of_millis(c: Column) -> Column:
    return F.timestamp_millis(c.cast("long")).cast("date")


def without_code(label: Column) -> Column:
    """A label without its leading ``12 - ``."""
    return F.regexp_replace(label, r"^[0-9]+\s*-\s*", "")


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    """100 * part / whole for counts, rounded half up in whole numbers; null where the whole is 0."""
    scale = 10**places
    part, whole = part.cast("long"), F.nullif(whole.cast("long"), F.lit(0).cast("long"))
    return F.call_function("div", part * (200 * scale) + whole, whole * 2).cast("double") / scale
