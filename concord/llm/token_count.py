"""Token counts without token ids: pieces of distinct pre-tokens, joined to frequencies and summed.

A pre-token is a run of spaces with the non-spaces after it.  No piece of the vocabulary has a space
mark behind another character (checked when the model is loaded), so no merge crosses the border of
two pre-tokens and a text's count is the sum over its pre-tokens.

1. A task numbers the distinct pre-tokens of its documents, until it has ``DICTIONARY`` of them or they
   have ``DICTIONARY_BYTES``: a block.  Each document becomes its frequencies, (number, times), in two
   bytes or so a pair.
2. The pre-tokens of a block are dealt over buckets by a hash and shuffled by bucket, packed, so that the
   same pre-token of all blocks comes to one place: its pieces are computed once in the whole corpus, and
   go back to every block that has it.  A frequent pre-token is there once for each block, not once for
   each document, so no key is hot.
3. Pieces and frequencies meet by block, the pieces first, and each document's are summed.

Defined results: null counts as the empty text, which has 0 tokens.  Texts are taken whole, however
long.  Rows are counted by themselves: repeated rows give equal rows,
ids play no part, and there are no ties.  An empty table gives an empty table.  Columns of any name
are kept but for n_bytes, n_tokens and over_limit, which are replaced.
"""

from __future__ import annotations

import base64
import zlib
from itertools import islice

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import stored
from .text import blocks, free_name, mapped, sha256_hex

#: Bounds of a block's pre-tokens, and so of a task's memory.
DICTIONARY, DICTIONARY_BYTES = 400_000, 16 << 20
#: Buckets for each shuffle partition; the pre-tokens of one are in a task's memory at a time.
BUCKETS = 4
_MARK = "▁"
_PAIRS = "block long, kind int, bucket int, n_bytes long, numbers binary, values binary, words binary"


def pre_tokens(text: str | None) -> list[str]:
    """The pre-tokens of a text, each without one space of those before it; a last one may have nothing but spaces."""
    if not text:
        return []
    words = text.replace(_MARK, " ").split(" ")  # the same character to the model
    if "" not in words:
        return words
    out, spaces = [], 0
    for w in words:
        if w:
            out.append(" " * spaces + w)
            spaces = 0
        else:
            spaces += 1
    if spaces:
        out.append(" " * (spaces - 1))
    return out


class PieceCounter:
    def __init__(self, model: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(_MARK in p.lstrip(_MARK) for p in pieces):
            raise ValueError("a piece of this vocabulary crosses the border of two pre-tokens")

    def pieces(self, pre_token: str) -> int:
        """Pieces of one pre-token; the model itself puts the space that was left out before it."""
        return len(self.model.encode(pre_token)) if pre_token else 1


_counters: dict[str, PieceCounter] = {}


def _counter(sent: bytes) -> PieceCounter:
    key = sha256_hex(sent)
    if key not in _counters:
        _counters.clear()
        _counters[key] = PieceCounter(base64.b64decode(sent))
    return _counters[key]


def _planes(ascending: np.ndarray) -> bytes:
    """Numbers as differences, in byte planes, which compress well."""
    return np.diff(ascending.astype(np.uint32), prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.frombuffer(planes, np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel().cumsum(dtype=np.int64)


def _frequencies(texts: list[str | None], number: dict[str, int]) -> tuple[list[bytes], list[bytes]]:
    """For each text the numbers of its pre-tokens and how often it has them (255 at most, then again)."""
    found = [[number.setdefault(w, len(number)) for w in pre_tokens(t)] for t in texts]
    size = max(len(number), 1)
    doc = np.repeat(np.arange(len(texts)), [len(x) for x in found])
    pairs, times = np.unique(doc * size + np.array([i for x in found for i in x], np.int64), return_counts=True)
    more = -(-times // 255)  # rows for each pair
    each = np.full(int(more.sum()), 255, np.int64)
    each[np.cumsum(more) - 1] = times - 255 * (more - 1)
    pairs, each = np.repeat(pairs, more), each.astype(np.uint8)
    used = pairs % size
    ends = np.searchsorted(pairs // size, np.arange(len(texts) + 1)).tolist()
    return [_planes(used[a:b]) for a, b in zip(ends, ends[1:])], [each[a:b].tobytes() for a, b in zip(ends, ends[1:])]


def _dealt(number: dict[str, int], buckets: int) -> tuple[list[int], list[bytes], list[bytes], list[bytes]]:
    """A block's pre-tokens by bucket: bucket, numbers, sizes in characters, the characters themselves packed."""
    words = list(number)
    bucket = np.array([zlib.crc32(w.encode()) % buckets for w in words], np.int64)
    order = np.argsort(bucket, kind="stable")
    pack = zstandard.ZstdCompressor(level=1).compress
    out = [], [], [], []
    for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
        own = [words[i] for i in part.tolist()]
        for x, v in zip(out, (int(bucket[part[0]]), _planes(part), np.array([len(w) for w in own], np.uint32).tobytes(), pack("".join(own).encode()))):
            x.append(v)
    return out


def _blocks(docs: DataFrame, n: int, buckets: int) -> DataFrame:
    """Rows of two kinds: documents (1), each with its other columns (``n`` of them) and its frequencies, and a block's pre-tokens by bucket (0)."""
    row = T.StructType(docs.schema.fields[:n])
    schema = T.StructType([*T._parse_datatype_string(_PAIRS).fields, T.StructField("row", row)])
    names = [f.name for f in schema.fields]

    def run(batches):
        block, number, size = TaskContext.get().partitionId() << 32, {}, 0
        kind = None
        same = lambda v, k, t: pa.array(np.full(k, v), t)

        def dictionary():
            bucket, numbers, sizes, words = _dealt(number, buckets)
            k = len(bucket)
            return pa.RecordBatch.from_arrays([same(block, k, pa.int64()), same(0, k, pa.int32()), pa.array(bucket, pa.int32()), same(0, k, pa.int64()), *(pa.array(x, pa.binary()) for x in (numbers, sizes, words)), pa.nulls(k, kind)], names=names)

        for batch in batches:
            for part in blocks(batch, n + 1):
                had = len(number)
                used, times = _frequencies(part.column(n + 1).to_pylist(), number)
                size += sum(map(len, islice(number, had, None)))
                k, rows = part.num_rows, pa.StructArray.from_arrays(part.columns[:n], fields=[part.schema.field(i) for i in range(n)])
                kind = rows.type
                yield pa.RecordBatch.from_arrays([same(block, k, pa.int64()), same(1, k, pa.int32()), same(-1, k, pa.int32()), part.column(n), pa.array(used, pa.binary()), pa.array(times, pa.binary()), pa.nulls(k, pa.binary()), rows], names=names)
                if len(number) >= DICTIONARY or size >= DICTIONARY_BYTES:
                    yield dictionary()
                    block, number, size = block + 1, {}, 0
        if number:
            yield dictionary()

    return mapped(docs, run, schema)


def _pieces(words: DataFrame, sent) -> DataFrame:
    """block, numbers and values: the pieces of each pre-token, computed once where all rows of its bucket meet."""

    def run(batches):
        counter, last = _counter(sent.value), None
        known: dict[str, int] = {}
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for part in blocks(batch, 4):
                values = []
                for bucket, sizes, packed in zip(part.column(0).to_pylist(), part.column(3).to_pylist(), part.column(4).to_pylist()):
                    if bucket != last:
                        last, known = bucket, {}
                    text, out, at = unpack(packed).decode(), [], 0
                    for size in np.frombuffer(sizes, np.uint32).tolist():
                        word = text[at : at + size]
                        at += size
                        n = known.get(word)
                        if n is None:
                            n = known[word] = counter.pieces(word)
                        out.append(n)
                    values.append(np.array(out, np.int32).tobytes())
                yield pa.RecordBatch.from_arrays([part.column(1), part.column(2), pa.array(values, pa.binary())], names=["block", "numbers", "values"])

    dealt = words.select("bucket", "block", "numbers", F.col("values").alias("sizes"), "words").repartition("bucket").sortWithinPartitions("bucket")
    return mapped(dealt, run, "block long, numbers binary, values binary")


def count_tokens(docs: DataFrame, model: bytes, text: str = "text", limit: int = 4096) -> DataFrame:
    """Adds n_bytes, n_tokens (long) and over_limit (n_tokens > ``limit``); the text goes.

    ``model`` is the vocabulary file's bytes, of fixed size, sent as a broadcast variable.
    """
    sent = docs.sparkSession.sparkContext.broadcast(base64.b64encode(model))
    own = ["n_bytes", "n_tokens", "over_limit"]
    keep = [c for c in docs.columns if c.lower() not in own and c != text]
    whole = F.col(f"`{text}`")
    size = F.coalesce(F.octet_length(whole).cast("long"), F.lit(0).cast("long"))
    # Known by their places: other columns may have any name.
    docs = docs.select(F.lit(0).alias(free_name(keep, "_")), *[F.col(f"`{c}`") for c in keep], size.alias(own[0]), whole)
    buckets = BUCKETS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    table = stored(_blocks(docs, len(keep) + 1, buckets), "frequencies")
    counted = _pieces(table.where("kind = 0"), sent).select("block", F.lit(0).alias("kind"), "numbers", "values")
    rows = table.where("kind = 1").select("block", "kind", "numbers", "values", "n_bytes", "row")
    both = rows.unionByName(counted, allowMissingColumns=True).repartition("block").sortWithinPartitions("block", "kind")
    fields = docs.schema.fields[1 : 1 + len(keep)]
    schema = T.StructType([*fields, T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])

    def run(batches):
        block, pieces = None, np.zeros(0, np.int64)
        for batch in batches:
            ids, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            edges = np.flatnonzero((ids[1:] != ids[:-1]) | (kind[1:] != kind[:-1])) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(ids)]):
                if ids[a] != block:
                    block, pieces = ids[a], np.zeros(0, np.int64)
                part = batch.slice(a, b - a)
                numbers, values = part.column(2).to_pylist(), part.column(3).to_pylist()
                if kind[a] == 0:  # the pieces of the block's pre-tokens
                    at = [_numbers(x) for x in numbers]
                    grown = np.zeros(max(len(pieces), *(int(x[-1]) + 1 for x in at)), np.int64)
                    grown[: len(pieces)] = pieces
                    pieces = grown
                    pieces[np.concatenate(at)] = np.frombuffer(b"".join(values), np.int32)
                    continue
                n = [int(pieces[_numbers(x)] @ np.frombuffer(t, np.uint8)) for x, t in zip(numbers, values)]
                row = part.column(5).flatten()
                yield pa.RecordBatch.from_arrays([*row[1:], part.column(4), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], names=[*keep, *own])

    return mapped(both, run, schema)


def default_model(spark: SparkSession) -> bytes:
    """The model named by ``spark.concord.llm.pieceModel``, else the installed public one."""
    import public_tokenizers

    with open(spark.conf.get("spark.concord.llm.pieceModel", public_tokenizers.path("piece_bpe_32k.model")), "rb") as f:
        return f.read()
