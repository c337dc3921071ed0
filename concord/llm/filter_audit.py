"""What each filter of a chain does in every order of the chain, on a sparse document-term matrix.

The matrix is built in shards of compressed sparse rows over one dictionary for all documents:

1. A task numbers the distinct words of its documents until it has ``WORDS`` of them or they have
   ``WORD_BYTES``: a block.  Documents of a block become rows of (number, times), about 2 MB of text a shard.
2. The words of all blocks are dealt over buckets by a hash; their number follows from the bytes of the
   dictionaries, so a bucket is of bounded size whatever the corpus.  A bucket numbers its distinct words once for all
   blocks: a word's term is rank * buckets + bucket.  A frequent word is there once for each block, not once for
   each document, so no word is hot.
3. The terms go back to their blocks, and the shards get them for their blocks' numbers.

Row sums of the matrix are the documents' words, nonzero counts their distinct words; these decide filters A and B.
The others are columns: C and D from the text, E by joining the smallest id of each digest (hot digests
are broadcast, see skew).  What a chain does to a document depends on the set of filters it fails alone, so documents
are counted by (part, set, labels) first, and only those counts, at most 128 for each part, meet the orders.

Defined results: a null text counts as empty, which fails A alone (and E behind another).  A null id is
smaller than none and larger than none: it never fails E.  Rows that repeat id and text fail E or don't alike.
Null language is the part ''.  Labels that repeat an id count if any of them says so; labels without
a document, and null ids, count nothing.  Ties: a figure equal to its limit passes.  Texts are taken whole,
however long.  An empty table of documents gives no rows.  Other columns, of any name, aren't read.
"""

from __future__ import annotations

import zlib
from itertools import chain, islice, permutations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .skew import split_join
from .store import discard, stored
from .text import blocks, byte_buffer, mapped

#: Bounds of a block's words, and so of a task's memory.
WORDS, WORD_BYTES = 400_000, 16 << 20
#: Bytes of packed words that a bucket may have.
BUCKET_BYTES = 4 << 20
FILTERS = "ABCDE"
_SHARDS = "block long, kind int, rows binary, numbers binary, counts binary, words binary"


def _planes(numbers: np.ndarray) -> bytes:
    """32-bit numbers as differences in four byte planes, of which the upper ones are mostly zero and compress well."""
    return np.diff(numbers.astype(np.uint32), prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.frombuffer(planes, np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel().cumsum(dtype=np.uint32).astype(np.int64)


def _pack(words: list[bytes]) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"\n".join(words))


def _unpack(packed: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(packed).split(b"\n")


def _sparse(texts: list[bytes], number: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row ends, word numbers and times of each text's words, by number within a row."""
    found = [t.split() for t in texts]
    sizes = [len(x) for x in found]
    words = np.fromiter([number.setdefault(w, len(number)) for w in chain.from_iterable(found)], np.int64, sum(sizes))
    width = max(len(number), 1)
    cells, times = np.unique(np.repeat(np.arange(len(texts)), sizes) * width + words, return_counts=True)
    return np.searchsorted(cells // width, np.arange(1, len(texts) + 1)), cells % width, times


def _encoded(docs: DataFrame) -> DataFrame:
    """Shards in their block's own numbers (kind 1), and each block's words in the order of their numbers (0).  The text is the last column of ``docs``."""
    at = len(docs.columns) - 1
    row = T.StructType(docs.schema.fields[:at])
    schema = T.StructType([*T._parse_datatype_string(_SHARDS).fields, T.StructField("docs", T.ArrayType(row))])
    names = [f.name for f in schema.fields]

    def run(batches):
        block, number, size, kind = TaskContext.get().partitionId() << 32, {}, 0, None

        def one(kind_, rows, numbers, counts, words, docs_):
            arrays = [pa.array([block], pa.int64()), pa.array([kind_], pa.int32()), *(pa.array([x], pa.binary()) for x in (rows, numbers, counts, words)), docs_]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        def dictionary():
            return one(0, None, None, None, _pack(list(number)), pa.nulls(1, kind))

        for batch in batches:
            for part in blocks(batch, at):
                raw, offs = byte_buffer(part.column(at))
                data, ends, had = raw.tobytes(), offs.tolist(), len(number)
                rows, numbers, counts = _sparse([data[i:j] for i, j in zip(ends, ends[1:])], number)
                size += sum(map(len, islice(number, had, None)))
                struct = pa.StructArray.from_arrays(part.columns[:at], fields=[part.schema.field(i) for i in range(at)])
                listed = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), struct)
                kind = listed.type
                yield one(1, _planes(rows), _planes(numbers), _planes(counts), None, listed)
                if len(number) >= WORDS or size >= WORD_BYTES:
                    yield dictionary()
                    block, number, size = block + 1, {}, 0
        if kind is not None and number:
            yield dictionary()

    return mapped(docs, run, schema)


def _terms(encoded: DataFrame, with_words: bool) -> DataFrame:
    """block, numbers and terms of every block's words; or, once for each word, term and word."""
    words = encoded.where("kind = 0").select("block", "words")
    total = words.agg(F.sum(F.length("words"))).first()[0] or 0
    least = int(encoded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(least, -(-total // BUCKET_BYTES))

    def deal(batches):
        for batch in batches:
            for block, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = _unpack(packed)
                bucket = np.fromiter((zlib.crc32(w) % buckets for w in own), np.int64, len(own))
                order = np.argsort(bucket, kind="stable")
                for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
                    yield pa.RecordBatch.from_pylist([{"bucket": int(bucket[part[0]]), "block": block, "numbers": _planes(part), "words": _pack([own[i] for i in part.tolist()])}], dealt)

    dealt = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("numbers", pa.binary()), ("words", pa.binary())])

    def number(batches):
        last, known = None, {}
        for batch in batches:
            for part in blocks(batch, 3):
                out = []
                for bucket, packed in zip(part.column(0).to_pylist(), part.column(3).to_pylist()):
                    if bucket != last:
                        last, known = bucket, {}
                    had = len(known)
                    ranks = np.array([known.setdefault(w, len(known)) for w in _unpack(packed)], np.int64)
                    if with_words:
                        new = list(islice(known, had, None))
                        yield pa.RecordBatch.from_arrays([pa.array(np.arange(had, len(known)) * buckets + bucket), pa.array([w.decode() for w in new], pa.string())], names=["term", "word"])
                    out.append((ranks * buckets + bucket).tobytes())
                if not with_words:
                    yield pa.RecordBatch.from_arrays([part.column(1), part.column(2), pa.array(out, pa.binary())], names=["block", "numbers", "terms"])

    # In this order within a bucket a task that is run again numbers its words alike.
    met = mapped(words, deal, "bucket int, block long, numbers binary, words binary").repartition("bucket").sortWithinPartitions("bucket", "block")
    return mapped(met, number, "term long, word string" if with_words else "block long, numbers binary, terms binary")


def dictionary(encoded: DataFrame) -> DataFrame:
    """term (long) and word of every distinct word of the corpus."""
    return _terms(encoded, True)


def encoded_blocks(docs: DataFrame, text: str = "text") -> DataFrame:
    """The stored table that ``shards`` and ``dictionary`` read: discard it when they are no longer needed."""
    return stored(_encoded(docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != text], F.col(f"`{text}`"))), "blocks")


def shards(encoded: DataFrame) -> DataFrame:
    """docs (the other columns of each row), ends (of the rows), terms and counts: compressed sparse rows, one shard a row."""
    back = _terms(encoded, False).select("block", F.lit(0).alias("kind"), "numbers", F.col("terms").alias("words"))
    rows = encoded.where("kind = 1").select("block", "kind", "numbers", "rows", "counts", "docs")
    both = rows.unionByName(back, allowMissingColumns=True).repartition("block").sortWithinPartitions("block", "kind")
    docs = encoded.schema["docs"]
    schema = T.StructType([docs, *(T.StructField(c, T.ArrayType(T.LongType())) for c in ("ends", "terms", "counts"))])

    def run(batches):
        block, terms = None, np.zeros(0, np.int64)
        for batch in batches:
            names = batch.schema.names
            column = {c: batch.column(i) for i, c in enumerate(names)}
            for i, (b, kind) in enumerate(zip(column["block"].to_pylist(), column["kind"].to_pylist())):
                if b != block:
                    block, terms = b, np.zeros(0, np.int64)
                at = _numbers(column["numbers"][i].as_py())
                if kind == 0:
                    if len(at) and at[-1] >= len(terms):
                        terms = np.concatenate([terms, np.zeros(int(at[-1]) + 1 - len(terms), np.int64)])
                    terms[at] = np.frombuffer(column["words"][i].as_py(), np.int64)
                    continue
                listed = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x)) for x in (_numbers(column["rows"][i].as_py()), terms[at], _numbers(column["counts"][i].as_py()))]
                yield pa.RecordBatch.from_arrays([column["docs"].slice(i, 1), *listed], names=["docs", "ends", "terms", "counts"])

    return mapped(both, run, schema)


def row_figures(matrix: DataFrame) -> DataFrame:
    """The documents' columns with n_words, the sum of a row of the matrix, and n_distinct, its nonzero counts."""
    fields = matrix.schema["docs"].dataType.elementType.fields
    schema = T.StructType([*fields, T.StructField("n_words", T.LongType()), T.StructField("n_distinct", T.LongType())])

    def run(batches):
        for batch in batches:
            for docs, ends, counts in zip(batch.column(0), batch.column(1), batch.column(2)):
                ends = np.concatenate([[0], ends.values.to_numpy()])
                total = np.concatenate([[0], np.cumsum(counts.values.to_numpy())])
                yield pa.RecordBatch.from_arrays([*docs.values.flatten(), pa.array(np.diff(total[ends]), pa.int64()), pa.array(np.diff(ends), pa.int64())], names=[f.name for f in schema.fields])

    return mapped(matrix.select("docs", "ends", "counts"), run, schema)


def failures(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang", least_words: int = 200, distinct: int = 50, capitals: int = 3) -> DataFrame:
    """doc_id, part and, for each filter, whether the document fails it: A, B, C, D, E.

    The table that the matrix is read from is deleted; the result is a stored table itself.
    """
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    c = F.regexp_count(whole, F.lit("[A-Z]")) * 100 > F.length(whole) * capitals
    d = whole.rlike("[#$%&*|]")
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(whole, 256)).alias("digest"), c.alias("C"), d.alias("D"), whole.alias("text"))
    encoded = encoded_blocks(rows)
    a, b = F.col("n_words") < least_words, F.col("n_distinct") * 100 < F.col("n_words") * distinct
    figures = stored(row_figures(shards(encoded)).select("doc_id", "part", "digest", a.alias("A"), b.alias("B"), "C", "D"), "figures")
    discard(encoded)
    first = stored(figures.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "first")
    e = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    out = stored(split_join(figures, first, ["digest"], "n").select("doc_id", "part", "A", "B", "C", "D", e.alias("E")), "failures")
    discard(figures, first)
    return out


def audit(failed: DataFrame, labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """For every part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    ``failed``: of ``failures``.  A document is removed by the first filter of an order that it fails.
    """
    known = labels.where(F.col(f"`{doc_id}`").isNotNull()).groupBy(F.col(f"`{doc_id}`").alias("doc_id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    marked = failed.join(known, "doc_id", "left")
    counts = marked.groupBy("part", *FILTERS, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")]).agg(F.count("*").alias("n"))
    # Filters that a document fails, in the order of the letters, as a string.
    fails = F.concat(*[F.when(F.col(f), f).otherwise("") for f in FILTERS])
    counts = counts.select("part", "good", "toxic", "n", fails.alias("fails"))
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    each = counts.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    # The letters of earlier steps that it fails too.
    earlier = F.expr("translate(fails, substring(filter_order, 1, step - 1), '') <> fails")
    here, failing = F.contains("fails", letter), F.length("fails")
    removed = here & ~earlier
    total = lambda on, x: F.sum(F.when(on, x).otherwise(0)).cast("long")
    n = F.col("n")
    return each.groupBy("part", "filter_order", "step").agg(
        total(~here & ~earlier, n).alias("kept"),
        total(removed, n).alias("removed"),
        total(here & earlier, n).alias("redundant"),
        total(here & (failing == 1), n).alias("unique_fails"),
        total(removed, n * F.col("good")).alias("good_lost"),
        total(removed, n * F.col("toxic")).alias("toxic_lost"),
        # It is the first of the k filters that a document fails in 120 / k orders.
        total(here, n * F.expr("120 div length(fails)")).alias("shapley"),
    )
