"""Substring dedup by content-defined chunks under a gear rolling hash.

The gear hash of a position covers the 32 bytes up to it.  A chunk ends where that hash is the
smallest within ``reach`` bytes on either side: the cut depends on those bytes alone, so an insertion
moves no cut further away than that.  (A mask with a least size, the other common rule, takes several
chunks to fall into step after an insertion; a mask without one leaves chunks of a few bytes, which
repeat by chance.)  So a chunk is longer than ``reach``, about twice as long on average, but for a
text's last.  Chunks are known by 128-bit digests and computed once, into a table; of a chunk that
occurs more than once, the occurrence in the document with the smallest id (its first there) stays
and the others are cut out.  Every chunk counts, however short: the last one of a text and a short text
too.  Chunks on many rows are not shuffled to meet their count (see ``skew``).

Defined results: a null text has no bytes and no chunks; an empty text likewise; a very long text is
chunked whole.  Ids may be of any type with an order; null ids sort last.  Ties: rows that share the
smallest id all keep the chunk; rows equal in id and text share a result.  An empty table gives an empty
table.  Columns of any name are kept, but those that have the name of a result are replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .skew import split_join
from .store import stored
from .text import blocks, byte_buffer, cover, free_name, mapped, runs, sha256_hex

WINDOW = 32
#: Bytes on either side among which a cut's hash is the smallest.
REACH = 32


def _gear_table() -> np.ndarray:
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(32)).astype(np.uint32)


_GEAR = _gear_table()


def gear(raw: np.ndarray) -> np.ndarray:
    """The rolling hash of each position: sum of table[byte k back] << k over the last 32 bytes (fewer at the start)."""
    h = _GEAR[raw]
    step = 1
    while step < WINDOW:
        h[step:] += h[:-step] << np.uint32(step)
        step *= 2
    return h


def cuts(raw: np.ndarray, reach: int = REACH) -> np.ndarray:
    """Ends (exclusive) of the chunks of a text, the text's own end last."""
    n = len(raw)
    if n <= 2 * reach:
        return np.array([n] if n else [], np.int64)
    h = gear(raw)
    # Smallest of the ``reach`` positions before and after each position, by doubling.
    low, size = h.copy(), 1
    while size < reach:
        step = min(size, reach - size)
        np.minimum(low[: n - step], low[step:], out=low[: n - step])
        size += step
    i = np.arange(reach, n - reach)
    at = i[(h[i] < low[i - reach]) & (h[i] < low[i + 1])] + 1
    return np.append(at, n)


def chunk_rows(text: bytes, raw: np.ndarray, reach: int = REACH) -> list[tuple[int, int, int, int]]:
    """(start, size, digest high, digest low) of each chunk."""
    ends = cuts(raw, reach).tolist()
    out, a = [], 0
    for b in ends:
        d = hashlib.blake2b(text[a:b], digest_size=16).digest()
        out.append((a, b - a, int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)))
        a = b
    return out


def chunks(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """One row per chunk of key_a, key_b, id, text; ``again``: its text had the same chunk before."""

    def run(batches):
        for batch in batches:
            for part in blocks(batch, 3):
                raw, offs = byte_buffer(part.column(3))
                data, at = raw.tobytes(), offs.tolist()
                row, found, again = [], [], []
                for k, (i, j) in enumerate(zip(at, at[1:])):
                    seen: set[tuple[int, int]] = set()
                    for c in chunk_rows(data[i:j], raw[i:j], reach):
                        row.append(k)
                        found.append(c)
                        again.append(c[2:] in seen)
                        seen.add(c[2:])
                if found:
                    start, size, high, low = (np.array(x, np.int64) for x in zip(*found))
                    take = pa.array(row, pa.int32())
                    yield pa.RecordBatch.from_arrays([*(part.column(c).take(take) for c in range(3)), pa.array(start.astype(np.int32)), pa.array(size.astype(np.int32)), pa.array(again), pa.array(high), pa.array(low)], names=["key_a", "key_b", "id", "start", "size", "again", "high", "low"])

    schema = T.StructType([docs.schema[c] for c in ("key_a", "key_b", "id")] + list(T._parse_datatype_string("start int, size int, again boolean, high long, low long").fields))
    return mapped(docs.select("key_a", "key_b", "id", "text"), run, schema)


def chunk_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep_text: bool = True, reach: int = REACH) -> DataFrame:
    """Cuts repeated chunks out of the texts and adds n_bytes, n_repeated, n_removed, n_spans and kept_sha256.

    n_repeated: bytes in chunks that occur elsewhere, kept or not; n_removed: bytes cut out, in n_spans runs.
    The text column holds what is left (without it if not ``keep_text``).
    """
    own = ("n_bytes", "n_repeated", "n_removed", "n_spans", "kept_sha256")
    keep = [c for c in docs.columns if c.lower() not in own and c != text]
    spans = free_name([*keep, text], "spans")
    a, b = free_name([*keep, text], "key_a"), free_name([*keep, text], "key_b")
    whole, id_ = F.coalesce(F.col(f"`{text}`"), F.lit("")), F.col(f"`{doc_id}`")
    keys = [F.xxhash64(F.lit(k), id_, whole) for k in (1, 2)]
    texts = docs.select(keys[0].alias("key_a"), keys[1].alias("key_b"), id_.alias("id"), whole.alias("text"))
    rows = stored(chunks(texts, reach), "chunks")
    # Partial aggregation combines the copies of a frequent chunk before the shuffle; null ids come last.
    order = F.struct(F.col("id").isNull().alias("no_id"), F.col("id"))
    known = stored(rows.groupBy("high", "low").agg(F.count("*").alias("n"), F.min(order).alias("first")).where("n > 1"), "repeated-chunks")
    hit = split_join(rows, known, ["high", "low"], "n")
    found = hit.select("key_a", "key_b", "start", "size", (F.col("again") | (order > F.col("first"))).alias("out")).distinct()
    found = found.groupBy("key_a", "key_b").agg(F.collect_list(F.struct("start", "size", "out")).alias(spans))
    found = found.withColumnsRenamed({"key_a": a, "key_b": b})
    kept_columns = [F.col(f"`{c}`") for c in keep]
    both = docs.select(*kept_columns, F.col(f"`{text}`").alias(text), keys[0].alias(a), keys[1].alias(b)).join(found, [a, b], "left").select(*kept_columns, text, spans)
    schema = T.StructType([f for f in both.schema.fields if f.name != spans and (keep_text or f.name != text)] + [T.StructField(c, T.LongType()) for c in own[:4]] + [T.StructField("kept_sha256", T.StringType())])
    names = [f.name for f in schema.fields]

    def run(batches):
        for batch in batches:
            for part in blocks(batch, len(keep)):
                raw, offs = byte_buffer(part.column(len(keep)))
                data, at = raw.tobytes(), offs.tolist()
                n_bytes, repeated, removed, n_spans, digest, left = [], [], [], [], [], []
                for i, j, got in zip(at, at[1:], part.column(len(keep) + 1).to_pylist()):
                    own_text = data[i:j]
                    n_bytes.append(j - i)
                    out = [(s["start"], s["start"] + s["size"]) for s in got or [] if s["out"]]
                    repeated.append(sum(s["size"] for s in got or []))
                    if out:
                        mask = cover(*(np.array(x) for x in zip(*out)), j - i)
                        starts, _ = runs(mask)
                        n_spans.append(len(starts))
                        removed.append(int(mask.sum()))
                        own_text = raw[i:j][~mask].tobytes()
                    else:
                        n_spans.append(0)
                        removed.append(0)
                    digest.append(sha256_hex(own_text))
                    left.append(own_text.decode(errors="ignore"))
                columns = [*part.columns[: len(keep)]]
                if keep_text:
                    columns.append(pa.array(left, pa.string()))
                yield pa.RecordBatch.from_arrays([*columns, *(pa.array(x, pa.int64()) for x in (n_bytes, repeated, removed, n_spans)), pa.array(digest, pa.string())], names=names)

    return mapped(both, run, schema)
