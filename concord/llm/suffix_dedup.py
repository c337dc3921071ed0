"""Suffix-array dedup: every byte inside a string of ``length`` bytes that also starts elsewhere goes.

A full suffix array of a corpus is many times its size.  This one is sparse, without giving up
exactness.  In each window of ``length`` bytes the smallest hash of its ``SEED``-byte substrings
chooses an anchor; equal windows choose the same anchor, so only suffixes that start at anchors (one
in about 85 bytes) are kept, each for the run of consecutive windows that chose it: its context.

1. Anchors with a seed that occurs once in the corpus can't repeat and go (counts with map-side
   combination, then a join in which seeds on many rows are broadcast, see ``skew``).
2. Copies of a context (equal seed and context digests, 128 bits) are one suffix with a count before
   anything is sorted; a context that occurs twice repeats entirely.
3. Where a seed has several contexts, one copy of each is fetched from its text.  These suffixes are
   range-partitioned by their leading bytes, with splitters that Spark samples.  In a bucket they are
   sorted by a multikey sort, eight bytes at a time, of which only groups that are still equal go on; so
   are the bytes before the anchors, backwards.  Neighbours are compared byte by byte, which gives the
   common prefixes in both orders.  A window repeats if another context agrees with it from the anchor
   to its end and from the anchor back to its start: with as many bytes on either side, both are in one
   run of the first order and in one run of the second.
4. Windows have their anchor's ``SEED`` leading bytes in common if they are equal, and a range partition
   never parts equal leading bytes: no pair of equal windows lies across a border.  A seed with more
   than ``HOT`` contexts would be too much for a task; its windows are dealt over the cluster by their
   64-bit digest and meet by it instead.

Matches never cross documents, and strings are judged on the input, not on what is left.  Defined
results: null texts are empty; texts under ``length`` bytes lose nothing; very long texts are taken
whole, in pieces that overlap.  Whole rows that repeat count as occurrences of each other and get equal
rows; every occurrence goes, so there are no ties.  An empty table gives an empty table.  Columns of
any name are kept, but n_bytes, n_removed, n_spans and kept_sha256 are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .skew import split_join
from .store import discard, stored
from .text import blocks, byte_buffer, cover, free_name, mapped, runs, sha256_hex

LENGTH = 200
#: Bytes of a seed; a power of two.
SEED = 32
#: Window starts handled at once.
PIECE = 1 << 19
#: Contexts of a seed that one task may hold.
HOT = 50_000
_PLACE = np.uint64((1 << 24) - 1)


def _spread(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h


_BYTE = _spread(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _powers(length: int) -> list[int]:
    """Powers of two that add up to ``length``, the largest first."""
    return [1 << k for k in range(length.bit_length() - 1, -1, -1) if length >> k & 1]


def digests(raw: np.ndarray, sizes: list[int]) -> dict[int, np.ndarray]:
    """Hashes of all substrings of each size (powers of two), by doubling."""
    h, size, out = _BYTE[raw], 1, {}
    while True:
        if size in sizes:
            out[size] = h
        if size >= max(sizes) or len(h) <= size:
            break
        new = h[:-size] * np.uint64(0x9E3779B97F4A7C15)
        new += h[size:]
        h, size = _spread(new), size * 2
    return out


def window_digests(parts: dict[int, np.ndarray], at: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the windows of ``length`` bytes that start at ``at``."""
    out, done = np.zeros(len(at), np.uint64), 0
    for size in _powers(length):
        out = _spread(out * np.uint64(0xBF58476D1CE4E5B9) + parts[size][at + done])
        done += size
    return out


def anchors(raw: np.ndarray, offs: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """Runs of windows with a common anchor: doc, lo (first window's start in the doc), n, seed, context, ahead.

    ``ahead``: bytes from the first window's start to the anchor.
    """
    out: list[dict[str, np.ndarray]] = []
    first, count = offs[:-1], np.maximum(np.diff(offs) - length + 1, 0)
    span = length - SEED + 1
    sizes = sorted({SEED, *_powers(length)})
    total = int(offs[-1]) - length + 1
    for s in range(0, max(total, 0), PIECE):
        part = raw[s : s + PIECE + length - 1]
        h = digests(part, sizes)
        low = (h[SEED] & ~_PLACE) | np.arange(len(h[SEED]), dtype=np.uint64)
        size = 1
        while size < span:  # smallest of the next ``span`` seeds, the leftmost of equals
            step = min(size, span - size)
            low = np.minimum(low[:-step], low[step:])
            size += step
        n = len(low)
        doc = np.searchsorted(offs, np.arange(s, s + n), side="right") - 1 if len(first) > 1 else np.zeros(n, np.int64)
        valid = s + np.arange(n) - first[doc] < count[doc]
        at = (low & _PLACE).astype(np.int64)
        new = np.ones(n, bool)
        new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1]) | (valid[1:] != valid[:-1])
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], n)
        keep = valid[starts]
        starts, ends = starts[keep], ends[keep]
        if not len(starts):
            continue
        n_windows = ends - starts
        context = _spread(window_digests(h, starts, length) * np.uint64(0x94D049BB133111EB) + window_digests(h, ends - 1, length))
        context = _spread(context + n_windows.astype(np.uint64))
        anchor = at[starts]
        out.append({"doc": doc[starts], "lo": s + starts - first[doc[starts]], "n": n_windows, "seed": h[SEED][anchor], "context": context, "ahead": anchor - starts})
    names = ("doc", "lo", "n", "seed", "context", "ahead")
    return {k: np.concatenate([o[k] for o in out]) if out else np.zeros(0, np.uint64 if k in ("seed", "context") else np.int64) for k in names}


def _anchor_rows(texts: DataFrame, length: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for part in blocks(batch, 2):
                raw, offs = byte_buffer(part.column(2))
                x = anchors(raw, offs, length)
                take = pa.array(x["doc"].astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(take), part.column(1).take(take), pa.array(x["seed"].view(np.int64)), pa.array(x["context"].view(np.int64)), pa.array(x["lo"].astype(np.int32)), pa.array(x["n"].astype(np.int16)), pa.array(x["ahead"].astype(np.int16))],
                    names=["key_a", "key_b", "seed", "context", "lo", "n", "ahead"],
                )

    return mapped(texts.select("key_a", "key_b", "text"), run, "key_a long, key_b long, seed long, context long, lo int, n short, ahead short")


def packed(df: DataFrame, text: str) -> DataFrame:
    """The text column as zstd bytes, so that a shuffle moves and spills less."""
    schema = T.StructType([T.StructField(f.name, T.BinaryType()) if f.name == text else f for f in df.schema.fields])
    at = df.columns.index(text)

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1).compress
        for whole in batches:
            for batch in blocks(whole, at):
                raw, offs = byte_buffer(batch.column(at))
                data, o = raw.tobytes(), offs.tolist()
                columns = list(batch.columns)
                columns[at] = pa.array([pack(data[i:j]) for i, j in zip(o, o[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return mapped(df, run, schema)


def unpack(data: bytes, tool=zstandard.ZstdDecompressor()) -> bytes:
    return tool.decompress(data)


def _contexts(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """One row for each wanted context: seed, context, n, ahead, hot, lead (leading bytes of the anchor's suffix) and its bytes."""
    lists = wanted.groupBy("key_a", "key_b").agg(F.collect_list(F.struct("seed", "context", "lo", "n", "ahead", "hot")).alias("wanted"))
    # A merge join brings the copies of a text together, of which one is taken.
    both = packed(texts.select("key_a", "key_b", "text"), "text").join(lists.hint("merge"), ["key_a", "key_b"])

    def run(batches):
        last = None
        for batch in batches:
            out: list[tuple] = []
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            for i, key in enumerate(keys):
                if key == last:
                    continue  # a copy of the text before
                last = key
                data = unpack(batch.column(2)[i].as_py())
                for w in batch.column(3)[i].as_py():
                    a = w["lo"] + w["ahead"]
                    out.append((w["seed"], w["context"], w["n"], w["ahead"], w["hot"], data[a : a + SEED], data[w["lo"] : w["lo"] + w["n"] + length - 1]))
            for k in range(0, len(out), 20_000):
                columns = list(zip(*out[k : k + 20_000]))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int16(), pa.int16(), pa.bool_(), pa.binary(), pa.binary()))], names=["seed", "context", "n", "ahead", "hot", "lead", "bytes"])

    return mapped(both.select("key_a", "key_b", "text", "wanted"), run, "seed long, context long, n short, ahead short, hot boolean, lead binary, bytes binary")


def _windows(contexts: list[bytes], n: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Digest, context number and offset of each window of the contexts."""
    raw = np.frombuffer(b"".join(contexts), np.uint8)
    begin = np.cumsum([0, *map(len, contexts)])[:-1]
    which = np.repeat(np.arange(len(contexts)), n)
    offset = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    return window_digests(digests(raw, _powers(length)), begin[which] + offset, length), which, offset


def multikey_order(rows: np.ndarray) -> np.ndarray:
    """The order of equally long byte strings (a matrix of uint8, its width a multiple of 8).

    One 8-byte character at a time: strings equal so far form a group, each group is sorted by the next
    character, and only groups of two or more that are still equal go on.
    """
    characters = rows.view(">u8").astype(np.uint64)
    order, group = np.arange(len(rows)), np.zeros(len(rows), np.int64)
    still = order.copy()  # places in ``order`` that aren't settled
    for k in range(characters.shape[1]):
        c = characters[order[still], k]
        by = np.lexsort((c, group[still]))
        order[still] = order[still][by]
        c, g = c[by], group[still]
        new = np.ones(len(still), bool)
        new[1:] = (c[1:] != c[:-1]) | (g[1:] != g[:-1])
        first = np.flatnonzero(new)
        group[still] = still[first][np.cumsum(new) - 1]
        size = np.diff(np.append(first, len(still)))
        still = still[np.repeat(size > 1, size)]
        if not len(still):
            break
    return order


def common_prefixes(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Bytes that each string has in common with the one before it in the order (the first: none)."""
    differs = rows[order[1:]] != rows[order[:-1]]
    same = np.where(differs.any(axis=1), differs.argmax(axis=1), rows.shape[1])
    return np.concatenate((np.zeros(min(1, len(order)), np.int64), same))


def _sides(data: list[bytes], ahead: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Matrices of the bytes from the anchors on, and of those before them backwards, filled up with zeros."""
    width = -(-width // 8) * 8
    out = np.zeros((2, len(data), width), np.uint8)
    for i, (x, a) in enumerate(zip(data, ahead.tolist())):
        raw = np.frombuffer(x, np.uint8)
        right, left = raw[a : a + width], raw[max(a - width, 0) : a][::-1]
        out[0, i, : len(right)] = right
        out[1, i, : len(left)] = left
    return out[0], out[1]


def _repeats(seed: np.ndarray, context: np.ndarray, n: np.ndarray, ahead: np.ndarray, data: list[bytes], length: int) -> pa.RecordBatch:
    """Runs of windows that are in two contexts or more; a context given twice counts once."""
    _, one = np.unique(np.stack([seed, context]), axis=1, return_index=True)
    seed, context, n, ahead, data = seed[one], context[one], n[one], ahead[one], [data[i] for i in one]
    ranks, commons = [], []
    for side in _sides(data, ahead, length):
        order = multikey_order(side)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        ranks.append(rank)
        commons.append(common_prefixes(side, order))
    begin = np.cumsum(n) - n
    twice = np.zeros(int(n.sum()), bool)
    for back in range(length - SEED + 1):  # windows that begin so many bytes before their anchor
        has = np.flatnonzero((ahead >= back) & (ahead - n < back))
        if len(has) < 2:
            continue
        runs_of = [np.cumsum(common < depth)[rank[has]] for rank, common, depth in zip(ranks, commons, (length - back, back))]
        key = runs_of[0] * (len(n) + 1) + runs_of[1]
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        at = begin[has] + ahead[has] - back
        twice[at[order[1:][same]]] = True
        twice[at[order[:-1][same]]] = True
    # A run ends with its context.
    which = np.repeat(np.arange(len(n)), n)
    edge = np.flatnonzero(np.diff(np.concatenate(([0], (twice * (which + 1)), [0]))))
    starts = edge[np.concatenate((twice, [False]))[edge]]
    ends = np.searchsorted(edge, starts, side="right")
    size = edge[ends] - starts if len(starts) else starts
    w = which[starts]
    return pa.RecordBatch.from_arrays([pa.array(seed[w]), pa.array(context[w]), pa.array((starts - begin[w]).astype(np.int32)), pa.array(size.astype(np.int32))], names=["seed", "context", "offset", "size"])


def _compare(contexts: DataFrame, length: int) -> DataFrame:
    """Runs (seed, context, offset, size) of repeated windows among contexts of a seed, bucket by bucket."""

    def run(batches, most=1 << 22):
        held: list[pa.RecordBatch] = []
        size = 0

        def flush(last: bool):
            nonlocal held, size
            if not held:
                return
            t = pa.Table.from_batches(held).combine_chunks()
            seed = t.column("seed").to_numpy()
            stop = len(seed)
            if not last:  # the last seed may go on in the next batch
                differs = np.flatnonzero(seed != seed[-1])
                stop = int(differs[-1]) + 1 if len(differs) else 0
            if stop:
                x = t.slice(0, stop)
                n, ahead = (x.column(c).to_numpy().astype(np.int64) for c in ("n", "ahead"))
                yield _repeats(seed[:stop], x.column("context").to_numpy(), n, ahead, x.column("bytes").to_pylist(), length)
            held = t.slice(stop).to_batches()
            size = sum(b.nbytes for b in held)

        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size > most:
                yield from flush(False)
        yield from flush(True)

    parts = contexts.repartitionByRange("lead").sortWithinPartitions("lead", "seed")
    return mapped(parts.select("seed", "context", "n", "ahead", "bytes"), run, "seed long, context long, offset int, size int")


def _compare_hot(contexts: DataFrame, length: int) -> DataFrame:
    """The same for seeds with too many contexts for a task: windows meet by their digest, in a shuffle that combines map-side."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                p = batch.slice(at, 2_000)
                key, which, offset = _windows(p.column(3).to_pylist(), p.column(2).to_numpy().astype(np.int64), length)
                take = pa.array(which.astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), p.column(0).take(take), p.column(1).take(take), pa.array(offset.astype(np.int32))], names=["key", "seed", "context", "offset"])

    rows = mapped(contexts.select("seed", "context", "n", "bytes"), run, "key long, seed long, context long, offset int").distinct()
    twice = rows.groupBy("key", "seed").agg(F.count("*").alias("m")).where("m > 1").drop("m")
    return rows.join(twice, ["key", "seed"]).select("seed", "context", "offset", F.lit(1).alias("size"))


def repeated_spans(docs: DataFrame, text: str = "text", length: int = LENGTH, hot: int = HOT) -> tuple[DataFrame, list]:
    """Spans (key_a, key_b, start, stop) in bytes, overlapping ones not merged, and the key columns of ``docs``."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    keys = [F.xxhash64(F.lit(k), whole) for k in (1, 2)]
    texts = docs.select(keys[0].alias("key_a"), keys[1].alias("key_b"), whole.alias("text")).where(F.octet_length("text") >= length)
    every = stored(_anchor_rows(texts, length), "anchors")
    again = stored(every.groupBy("seed").agg(F.count("*").alias("m")).where("m > 1"), "seeds")
    rows = stored(split_join(every, again, ["seed"], "m"), "repeated-seeds")
    discard(every, again)
    # All of these first() are of one row: any occurrence of the context will do.
    one = rows.groupBy("seed", "context").agg(F.count("*").alias("m"), *[F.first(c).alias(c) for c in ("key_a", "key_b", "lo", "n", "ahead")])
    one = stored(one, "contexts")
    several = one.groupBy("seed").agg(F.count("*").alias("contexts")).where("contexts > 1").select("seed", (F.col("contexts") > hot).alias("hot"))
    contexts = _contexts(texts, one.join(several, "seed"), length)
    is_hot = several.where("hot").limit(1).count() > 0
    partly = _compare(contexts.where("not hot"), length)
    if is_hot:
        partly = partly.unionByName(_compare_hot(contexts.where("hot"), length))
    entirely = one.where("m > 1").select("seed", "context", F.lit(0).alias("offset"), F.col("n").cast("int").alias("size"), "m")
    # A context in one text only is on one row.
    marks = entirely.unionByName(partly.withColumn("m", F.lit(1)))
    marks = stored(marks.groupBy("seed", "context").agg(F.max("m").alias("m"), F.collect_list(F.struct("offset", "size")).alias("runs")), "repeats")
    discard(one)
    found = split_join(rows.select("key_a", "key_b", "seed", "context", "lo"), marks, ["seed", "context"], "m")
    start = F.col("lo") + F.col("offset")
    spans = found.select("key_a", "key_b", "lo", F.inline("runs")).select("key_a", "key_b", start.alias("start"), (start + F.col("size") + (length - 1)).alias("stop")).distinct()
    return spans, keys


def suffix_dedup(docs: DataFrame, text: str = "text", length: int = LENGTH, keep_text: bool = True, hot: int = HOT) -> DataFrame:
    """Cuts repeated bytes out of the texts and adds n_bytes, n_removed, n_spans (long) and kept_sha256.

    The text column holds what is left, without characters that a cut went through (no text column if
    not ``keep_text``); the digest is of all bytes left.
    """
    own = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    keep = [c for c in docs.columns if c.lower() not in own and c != text]
    spans, keys = repeated_spans(docs, text, length, hot)
    a, b, s = (free_name([*keep, text], c) for c in ("key_a", "key_b", "spans"))
    lists = spans.groupBy(F.col("key_a").alias(a), F.col("key_b").alias(b)).agg(F.collect_list(F.struct("start", "stop")).alias(s))
    columns = [F.col(f"`{c}`") for c in keep]
    both = packed(docs.select(*columns, F.col(f"`{text}`").alias(text), keys[0].alias(a), keys[1].alias(b)), text).join(lists, [a, b], "left").select(*columns, text, s)
    schema = T.StructType([f for f in both.schema.fields[: len(keep)]] + [T.StructField(text, T.StringType())] * keep_text + [T.StructField(c, T.LongType()) for c in own[:3]] + [T.StructField("kept_sha256", T.StringType())])
    names = [f.name for f in schema.fields]

    def run(batches):
        for whole in batches:
            for batch in blocks(whole, len(keep)):
                n_bytes, removed, n_spans, digest, left = [], [], [], [], []
                for data, got in zip(batch.column(len(keep)).to_pylist(), batch.column(len(keep) + 1)):
                    data = unpack(data)
                    n_bytes.append(len(data))
                    if got.is_valid:
                        pairs = got.values
                        mask = cover(pairs.field(0).to_numpy(), pairs.field(1).to_numpy(), len(data))
                        n_spans.append(len(runs(mask)[0]))
                        removed.append(int(mask.sum()))
                        data = np.frombuffer(data, np.uint8)[~mask].tobytes()
                    else:
                        n_spans.append(0)
                        removed.append(0)
                    digest.append(sha256_hex(data))
                    if keep_text:
                        left.append(data.decode(errors="ignore"))
                texts = [pa.array(left, pa.string())] if keep_text else []
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *texts, *(pa.array(x, pa.int64()) for x in (n_bytes, removed, n_spans)), pa.array(digest, pa.string())], names=names)

    return mapped(both, run, schema)
