"""Sources of any shape to one canonical schema, from a declarative mapping of SQL expressions."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import blank_to_null, namespaced_id, record_key, row_signature


@dataclass(frozen=True)
class Target:
    """A column of the canonical schema."""

    name: str
    type: str = "string"
    default: str | None = None
    #: Blank texts become null.
    clean: bool = False


@dataclass(frozen=True)
class Source:
    """What a source publishes and how it maps to the canonical schema.

    ``mapping``: target -> SQL expression over the source's columns; absent or None gives the default.
    ``key_fields``: columns that tell apart the records of one id.  ``identity_exclude``: columns left
    out of the row signature.  ``exclude``: columns that are never read.
    """

    key: str
    name: str
    id_column: str
    mapping: Mapping[str, str | None]
    key_fields: Sequence[str] = ()
    identity_exclude: Sequence[str] = ()
    exclude: Sequence[str] = ()
    constants: Mapping[str, str] = field(default_factory=dict)


def retained(columns: Sequence[str], exclude: Sequence[str]) -> list[str]:
    """Published columns less the excluded ones (names compared without case)."""
    out = {e.lower() for e in exclude}
    return [c for c in columns if c.lower() not in out]


def mapped(source: Source, target: Target) -> Column:
    expression = source.mapping.get(target.name)
    value = F.expr(expression) if expression is not None else F.lit(target.default)
    if target.clean:
        value = blank_to_null(value)
    return value.cast(target.type).alias(target.name)


def conform(df: DataFrame, source: Source, targets: Sequence[Target], as_of: str | None = None) -> DataFrame:
    """One row in, one row out: identity, the targets in order, and constants that say where a row is from."""
    df = df.select(*retained(df.columns, source.exclude))
    uid = namespaced_id(F.lit(source.key), F.col(source.id_column))
    constants = [F.lit(v).alias(k) for k, v in source.constants.items()]
    return df.select(
        uid.alias("uid"),
        record_key(uid, [F.col(c) for c in source.key_fields]).alias("record_key"),
        row_signature(df, source.identity_exclude).alias("record_signature"),
        F.lit(source.key).alias("source_key"),
        F.lit(source.name).alias("source_name"),
        *[mapped(source, t) for t in targets],
        *constants,
        F.lit(as_of).cast("timestamp").alias("ingested_at"),
    )


def conform_union(frames: Mapping[str, DataFrame], sources: Sequence[Source], targets: Sequence[Target], as_of: str | None = None) -> DataFrame:
    """All sources of the manifest under one another, by name."""
    parts = [conform(frames[s.key], s, targets, as_of) for s in sources]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def missing_columns(source: Source, published: Sequence[str]) -> list[str]:
    """Mapped bare identifiers that the source no longer publishes."""
    have = {c.lower() for c in published}
    wanted = [source.id_column, *source.key_fields, *(e for e in source.mapping.values() if e and re.fullmatch(r"[A-Za-z_]\w*", e))]
    return sorted({w for w in wanted if w.lower() not in have and w.lower() not in ("null", "true", "false")})


def broken_expressions(df: DataFrame, source: Source) -> list[tuple[str, str]]:
    """(target, error) of the mapping's expressions that Spark's analyser rejects; nothing is run."""
    out = []
    for target, expression in source.mapping.items():
        if expression is not None:
            try:
                df.select(F.expr(expression)).schema  # noqa: B018
            except Exception as e:  # noqa: BLE001
                out.append((target, str(e).splitlines()[0]))
    return out


def schema_drift(old: DataFrame, new: DataFrame) -> DataFrame:
    """Fields (field_name, field_type) that were added, removed or have another type."""
    both = old.select("field_name", F.col("field_type").alias("old_type")).join(new.select("field_name", F.col("field_type").alias("new_type")), "field_name", "full_outer")
    change = F.when(F.col("old_type").isNull(), "added").when(F.col("new_type").isNull(), "removed").when(F.col("old_type") != F.col("new_type"), "retyped")
    return both.withColumn("change", change).where("change is not null")
