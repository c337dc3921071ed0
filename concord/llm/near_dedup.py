"""MinHash near-dedup: an inverted join on signature coordinates, confirmed on the full sets.

A text's set are its distinct 5-word shingles, as 64-bit hashes.  Texts with one set form a class,
known by a 128-bit digest; all later work is on classes.  A signature has ``COORDINATES`` values, the
smallest of the set under as many hash functions; a class is posted under each (coordinate, value).

* Skip: a class with fewer than two of its first ``FIRST`` values posted by others has no partner
  (a linked pair shares fewer with a chance of 1e-8) and its other values are never posted.
* Prefix: a pair that collides in ``MATCHES`` coordinates shares one of each side's
  COORDINATES - MATCHES + 1 rarest values.  Values that occur once are the rarest, so only classes
  with at least MATCHES values shared by others are merged, and never in the lists of their most
  frequent values.
* Merge without all pairs: in two rounds each prefix list pairs its members with one of them, first
  the one with most shared values, then any; what is confirmed joins components.  Classes in lists that
  still hold several components are compared once more, across components only.  There the lists of
  coordinates can't tell near copies just below the limit from those above it, and would pair them with
  the square of their number; exact prefix and position filters on the full sets choose the candidates.
  Pairs inside a component can't change the result, so large groups of copies cost as many pairs as
  members.
* Count: all collisions of a candidate pair are counted, also those in the long lists that the merge
  skipped, as the size of the intersection of both sides' postings.  Pairs with MATCHES or more stay
  (a pair at the limit of 0.75 has fewer with a chance of 1e-8), and then their full sets decide:
  100 * intersection >= 75 * union.

Defined results: null texts and texts without words have the empty set and link with nothing; a text
of fewer than 5 words has one shingle, its whole sequence; very long texts are hashed whole, at about 40 bytes of
memory for each byte of the longest.
Repeated rows link with each other and get equal rows.  Ties: of documents that share the smallest id
of a component each is kept.  A null id never is a component's id unless no document of the component
has one; such documents are kept if they are alone.  An empty table gives an empty table.  Only the id
column is read beside the text, so other columns may have any name.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import connected_components
from .store import discard, stored
from .suffix_dedup import packed, unpack
from .text import blocks, byte_buffer, free_name, mapped

WIDTH = 5
SIMILARITY = 75
COORDINATES, MATCHES, FIRST = 128, 68, 16
STAR_ROUNDS = 2
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def _spread(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _multipliers() -> np.ndarray:
    with np.errstate(over="ignore"):
        return _spread(np.arange(1, COORDINATES + 1, dtype=np.uint64) * _BASE) | np.uint64(1)


_MULTIPLIERS = _multipliers()
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_BREAK = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse mod 2**64."""
    if len(_powers[0]) < n:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for k, x in enumerate((_BASE, inverse)):
            steps = np.full(n, x, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def word_hashes(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word and the n + 1 offsets of the documents' words."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offs), np.int64)
    space = np.ones(n + 1, bool)
    space[:n] = _BREAK[raw]
    edge = np.zeros(n + 1, bool)  # a word starts here
    edge[:n] = ~space[:n]
    edge[1:n] &= space[: n - 1]
    heads = offs[:-1][offs[:-1] < n]
    edge[heads] |= ~space[heads]
    starts = np.flatnonzero(edge[:n])
    # A word ends at the next space or document border.
    stop = space.copy()
    stop[offs] = True
    ends = np.flatnonzero(stop)
    ends = ends[np.searchsorted(ends, starts, side="right")]
    power, inverse = _power_tables(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((_LOWER[raw].astype(np.uint64) + np.uint64(1)) * power[:n], out=total[1:])
    words = _spread((total[ends] - total[starts]) * inverse[starts])
    return words, np.searchsorted(starts, offs)


def shingle_sets(raw: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct shingles of each document."""
    words, at = word_hashes(raw, offs)
    n = len(words)
    h = np.full(max(n - WIDTH + 1, 0), WIDTH, np.uint64)
    for i in range(WIDTH):
        h = _spread(h * _BASE + words[i : n - WIDTH + 1 + i]) if len(h) else h
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= WIDTH:
            s = np.sort(h[a : b - WIDTH + 1])
            out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        elif b > a:
            one = np.full(1, b - a, np.uint64)
            for w in words[a:b]:
                one = _spread(one * _BASE + w)
            out.append(one)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(shingles: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    out = np.full(coordinates, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 4096):
        part = shingles[at : at + 4096]
        np.minimum(out, (_MULTIPLIERS[:coordinates, None] * part[None, :]).min(axis=1), out=out)
    return out


def _posting_keys(sig: np.ndarray) -> np.ndarray:
    """One number for each (coordinate, value)."""
    return _spread(sig + np.arange(sig.shape[-1], dtype=np.uint64) * _BASE).view(np.int64)


def _classes(docs: DataFrame) -> DataFrame:
    """id, key_a, key_b -> n, class (digest of the set, null if empty), first posting keys."""

    def run(batches):
        for batch in batches:
            for part in blocks(batch, 3):
                sets = shingle_sets(*byte_buffer(part.column(3)))
                n = np.array([len(s) for s in sets], np.int64)
                digest = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                keys = [_posting_keys(signature(s, FIRST)) for s in sets if len(s)]
                flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
                first = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(np.where(n > 0, FIRST, 0)))).astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(n), pa.array(digest, pa.binary()), first], names=["id", "key_a", "key_b", "n", "class", "first"])

    schema = T.StructType([docs.schema["id"], *T._parse_datatype_string("key_a long, key_b long, n long, class binary, first array<long>").fields])
    return mapped(docs.select("id", "key_a", "key_b", "text"), run, schema)


def _signed(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """class, keys (under which it is posted, of all coordinates) and packed text of the wanted classes."""
    # A merge join brings the copies of a text together, of which one is taken.
    both = packed(texts, "text").join(wanted.hint("merge"), ["key_a", "key_b"]).select("class", "text")

    def run(batches):
        last = None
        for batch in batches:
            keep, keys = [], []
            for i, (c, z) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                if c == last:
                    continue  # a copy of the text before
                last = c
                data = np.frombuffer(unpack(z), np.uint8)
                keep.append(i)
                keys.append(_posting_keys(signature(shingle_sets(data, np.array([0, len(data)]))[0])))
            if keep:
                b = batch.take(pa.array(keep))
                offs = np.arange(0, (len(keep) + 1) * COORDINATES, COORDINATES, dtype=np.int32)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(offs), pa.array(np.concatenate(keys))), b.column(1)], names=["class", "keys", "text"])

    return mapped(both, run, "class binary, keys array<long>, text binary")


def _counted(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """Those of the candidates (a, b) that collide in MATCHES coordinates or more."""
    left, right = (signed.select(F.col("class").alias(c), F.col("keys").alias(f"keys_{c}")) for c in "ab")
    return pairs.join(left, "a").join(right, "b").where(F.size(F.array_intersect("keys_a", "keys_b")) >= MATCHES).select("a", "b")


def _linked(pairs: DataFrame, signed: DataFrame, most: int = 32 << 20) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are similar enough."""
    left, right = (signed.select(F.col("class").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab")
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")

    def run(batches):
        known: dict[bytes, np.ndarray] = {}
        size = 0

        def shingles(c: bytes, z) -> np.ndarray:
            nonlocal size
            got = known.get(c)
            if got is None:
                if size > most:
                    known.clear()
                    size = 0
                data = np.frombuffer(unpack(z.as_py()), np.uint8)
                got = known[c] = shingle_sets(data, np.array([0, len(data)]))[0]
                size += got.nbytes
            return got

        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keep = []
            for i in range(batch.num_rows):
                x, y = shingles(a[i], batch.column(2)[i]), shingles(b[i], batch.column(3)[i])
                common = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * common >= SIMILARITY * (len(x) + len(y) - common):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int32())), batch.column(1).take(pa.array(keep, pa.int32()))], names=["a", "b"])

    return mapped(both, run, "a binary, b binary")


def _prefixes(posts: DataFrame, lists: DataFrame, others: list[str]) -> DataFrame:
    """class, ``others``, key, shared (the class's postings in ``lists``: key, df) and at (the place among them) of each posting in the prefix."""
    own = posts.join(lists, "key").groupBy("class", *others).agg(F.sort_array(F.collect_set(F.struct("df", "key"))).alias("own"))
    shared = F.size("own")
    own = own.where(shared >= MATCHES).select("class", *others, shared.alias("shared"), F.posexplode(F.slice("own", 1, shared - MATCHES + 1)).alias("at", "post"))
    return own.select("class", *others, "shared", "at", F.col("post.key").alias("key"))


def _shingle_rows(signed: DataFrame) -> DataFrame:
    """class, component, n and shingle: the full sets, a row for each element."""

    def run(batches):
        for batch in batches:
            for part in blocks(batch, 2, 1 << 19):
                sets = []
                for z in part.column(2).to_pylist():
                    data = np.frombuffer(unpack(z), np.uint8)
                    sets.append(shingle_sets(data, np.array([0, len(data)]))[0])
                n = np.array([len(s) for s in sets], np.int32)
                take = pa.array(np.repeat(np.arange(len(sets), dtype=np.int32), n))
                yield pa.RecordBatch.from_arrays([part.column(0).take(take), part.column(1).take(take), pa.array(np.repeat(n, n)), pa.array(np.concatenate(sets).view(np.int64))], names=["class", "component", "n", "shingle"])

    return mapped(signed.select("class", "component", "text"), run, "class binary, component binary, n int, shingle long")


def _rest_of_pairs(members: DataFrame, signed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs of different components, among classes that are still near others, that may be similar enough; none is missed.

    Prefix and position filter on the full sets: with the shingles of every class in order of their
    frequency here, two similar sets share one of each side's first n - ceil(0.75 n) + 1, and the
    places of the first one shared leave room for the overlap that the limit asks for.  Also gives
    the stored table that the pairs are read from.
    """
    rows = _shingle_rows(signed.join(members, "class"))
    frequent = rows.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    own = rows.join(frequent, "shingle").groupBy("class", "component", "n").agg(F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("own"))
    # Shingles that are in no other class come first in the order; places count them.
    unique = F.col("n") - F.size("own")
    reach = F.expr(f"n - (({SIMILARITY} * n + 99) div 100) + 1").cast("int") - unique
    own = own.where(reach > 0).select("class", "component", "n", unique.alias("unique"), F.posexplode(F.slice("own", 1, reach)).alias("at", "post"))
    posts = stored(own.select("class", "component", "n", (F.col("unique") + F.col("at")).alias("at"), F.col("post.shingle").alias("shingle")), "shingles")
    main = posts.groupBy("shingle", "component").agg(F.count("*").alias("m")).groupBy("shingle").agg(F.max_by("component", "m").alias("main"), F.count("*").alias("several")).where("several > 1")
    rest = posts.join(main, "shingle").where("component <> main")
    other = posts.select("shingle", F.col("class").alias("other"), F.col("component").alias("other_component"), F.col("n").alias("m"), F.col("at").alias("other_at"))
    near = f"component <> other_component and (other_component = main or class < other) and 100 * least(n, m) >= {SIMILARITY} * greatest(n, m)"
    room = f"{100 + SIMILARITY} * least(n - at, m - other_at) >= {SIMILARITY} * (n + m)"
    return rest.join(other, "shingle").where(f"{near} and {room}").select("class", "other"), posts


def _with_component(rows: DataFrame, components: DataFrame | None, on: str = "class") -> DataFrame:
    if components is None:
        return rows.withColumn("component", F.col(on))
    return rows.join(components.withColumnRenamed("node", on), on, "left").withColumn("component", F.coalesce("component", on))


def links(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> tuple[DataFrame, DataFrame | None]:
    """(documents with id, key_a and key_b of the text, n and class; components of the classes that have any link)."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    keys = [F.xxhash64(F.lit(k), whole).alias(c) for k, c in ((1, "key_a"), (2, "key_b"))]
    texts = docs.select(F.col(f"`{doc_id}`").alias("id"), *keys, whole.alias("text"))
    rows = stored(_classes(texts), "classes")
    # Skip: values of the first coordinates posted by two classes or more.
    posts = rows.where("class is not null").select("class", F.explode("first").alias("key"))
    shared = posts.withColumn("h", F.xxhash64("class")).groupBy("key").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo < hi").select("key")
    going_on = posts.join(shared, "key", "left_semi").distinct().groupBy("class").agg(F.count("*").alias("m")).where("m > 1").select("class")
    # All first() of one row: any text of the class will do.
    wanted = rows.join(going_on, "class", "left_semi").groupBy("class").agg(F.first("key_a").alias("key_a"), F.first("key_b").alias("key_b"))
    signed = stored(_signed(texts.select("key_a", "key_b", "text"), wanted), "signed")
    # Prefix: the rarest values of each class, ties broken by the value itself.
    posts = signed.select("class", F.explode("keys").alias("key"))
    frequent = posts.groupBy("key").agg(F.count("*").alias("df")).where("df > 1")
    # A class with many shared values is in the middle of its like.
    lists = stored(_prefixes(posts, frequent, []).select("class", "shared", "key"), "lists")
    edges = tried = components = None
    done = [signed, lists]
    for turn in range(STAR_ROUNDS + 1):
        members = _with_component(lists, components)
        open_lists = members.withColumn("h", F.xxhash64("component")).groupBy("key").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo < hi").select("key")
        members = stored(members.join(open_lists, "key", "left_semi"), "members")
        if turn < STAR_ROUNDS:
            order = F.struct(-F.col("shared"), F.xxhash64("class")) if turn == 0 else F.struct(F.xxhash64("component", F.lit(turn)), F.xxhash64("class"))
            centre = members.groupBy("key").agg(F.min_by(F.struct("class", "component"), order).alias("centre"))
            pairs = members.join(centre, "key").where("component <> centre.component").select("class", F.col("centre.class").alias("other"))
        else:
            pairs, read = _rest_of_pairs(members.select("class", "component").distinct(), signed)
            done.append(read)
        pairs = pairs.select(F.least("class", "other").alias("a"), F.greatest("class", "other").alias("b")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        found = stored(_linked(_counted(pairs, signed), signed), "links")
        done += [members, pairs, found]
        tried = pairs if tried is None else tried.unionByName(pairs)
        edges = found if edges is None else edges.unionByName(found)
        if not found.isEmpty():
            done.append(components)
            components = stored(connected_components(edges), "components")
    discard(*done)
    return rows.select("id", "key_a", "key_b", "n", "class"), components


def near_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: the id column, n_shingles, component_id and kept (the component's documents with the smallest id)."""
    rows, components = links(docs, text, doc_id)
    rows = rows.select("id", "n", "class")
    named = _with_component(rows.where("class is not null").select("id", "class"), components)
    smallest = named.groupBy("component").agg(F.min("id").alias("smallest"))
    classes = _with_component(rows.where("class is not null").select("class").distinct(), components).join(smallest, "component").select("class", "smallest")
    out = rows.join(classes, "class", "left").withColumn("component_id", F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("smallest")))
    return out.select(F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One document of each component: that with the smallest id, null ids last.

    Of several with that id the one with the smallest hash of its text stays, and of rows equal in id and
    text the smallest by their other columns, as JSON.  Documents without words link with nothing; all stay.
    """
    rows, components = links(docs, text, doc_id)
    rows = rows.where("class is not null").select("id", "key_a", "key_b", "class")
    # Ids don't tell rows apart: they may be repeated or null.
    own = F.struct(F.col("id").isNull().alias("no_id"), "id", "key_a", "key_b")
    best = _with_component(rows, components).groupBy("component").agg(F.min(own).alias("best"))
    classes = _with_component(rows.select("class").distinct(), components).join(best, "component").select("class", "best")
    gone = rows.join(classes, "class").where(~own.eqNullSafe(F.col("best"))).select("id", "key_a", "key_b").distinct()
    again = rows.groupBy("id", "key_a", "key_b").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    keys = {"id": F.col(f"`{doc_id}`"), "key_a": F.xxhash64(F.lit(1), whole), "key_b": F.xxhash64(F.lit(2), whole)}

    def matched(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        names = {c: free_name(left.columns, c) for c in keys}
        right = right.withColumnsRenamed(names)
        same = [keys[c].eqNullSafe(F.col(names[c])) for c in keys]
        return left.join(right, same[0] & same[1] & same[2], how)

    left = matched(docs, gone, "left_anti")
    if again.isEmpty():
        return left.select(*[F.col(f"`{c}`") for c in docs.columns])
    repeated = matched(left, again, "left_semi")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rest = F.to_json(F.struct(F.lit(0), *[F.col(f"`{c}`") for c in docs.columns if c not in (text, doc_id)]))
    one = repeated.groupBy(*keys.values()).agg(F.min_by(row, rest).alias("row")).select("row.*")
    return matched(left, again, "left_anti").unionByName(one)
