"""Benchmark decontamination: one Aho-Corasick automaton over the windows of all benchmark items.

Texts are normalised to words (A-Z lower-cased, runs of anything but ASCII letters, digits and
non-ASCII characters separate them) joined by single spaces; the automaton holds every window of
``width`` consecutive item words (an item of fewer words is one window).  One scan of a text finds
all windows in it, however they overlap; hits are mapped back to byte offsets in the original text.

The automaton is broadcast, so the benchmark is taken in blocks of at most ``BLOCK_BYTES`` of windows
and item ids: a benchmark larger than that is scanned by one automaton after another, each in a Python
pass of its own that adds its hits to the rows and writes them, and a block leaves the driver before
the one after the next comes.  No shuffle of the documents is needed.

Defined results: null and empty texts have no words and no hits; null or empty items have no windows;
items with the same text are all counted, items that repeat an id once; an item with a null id marks
words but isn't counted.  Very long texts are scanned whole, one at a time.  Documents are judged row
by row, so repeated rows and ids give equal rows, and there are no ties.  An empty benchmark hits
nothing; an empty table of documents gives an empty table.  Columns of any name are kept, but n_words,
n_hit, items and spans are replaced.
"""

from __future__ import annotations

import uuid

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import discard, stored
from .text import blocks, byte_buffer, cover, free_name, mapped, runs

#: Bytes of windows and item ids in one automaton (about ten times as much in a worker's memory).
BLOCK_BYTES = 16 << 20
#: Separators become spaces, A-Z becomes a-z, the rest stays.
_TABLE = bytes(32 if b < 0x30 or 0x3A <= b < 0x41 or 0x5B <= b < 0x61 or 0x7B <= b < 0x80 else b + 32 if 0x41 <= b < 0x5B else b for b in range(256))
HITS = "array<struct<start:int,stop:int,items:array<string>>>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def windows_of(text: str | None, width: int) -> set[str]:
    words = words_of((text or "").encode())
    if not words:
        return set()
    n = max(1, len(words) - width + 1)
    return {b" ".join(words[i : i + width]).decode("latin-1") for i in range(n)}


def benchmark_windows(benchmark: DataFrame, width: int = 10, item: str = "item_id", text: str = "text") -> DataFrame:
    """window, items: each distinct window with the sorted ids of its items."""

    def run(batches):
        for batch in batches:
            for part in blocks(batch, 1):
                found = [sorted(windows_of(t, width)) for t in part.column(1).to_pylist()]
                take = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]), pa.int32())
                yield pa.RecordBatch.from_arrays([part.column(0).take(take), pa.array([w for x in found for w in x], pa.string())], names=["item", "window"])

    rows = mapped(benchmark.select(F.col(f"`{item}`").cast("string").alias("item"), F.col(f"`{text}`").alias("text")), run, "item string, window string")
    return rows.groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items"))


def benchmark_blocks(windows: DataFrame, most: int):
    """Lists of (window, item ids), each of about ``most`` bytes, read one after another."""
    block: list[tuple[str, list[str]]] = []
    size = 0
    for r in windows.toLocalIterator():
        block.append((r[0], r[1]))
        size += len(r[0]) + sum(map(len, r[1]))
        if size >= most:
            yield block
            block, size = [], 0
    if block:
        yield block


_automata: dict[str, ahocorasick.Automaton | None] = {}


def _automaton(key: str, block) -> ahocorasick.Automaton | None:
    if key not in _automata:
        _automata.clear()
        a = ahocorasick.Automaton()
        for window, items in block:
            a.add_word(f" {window} ", (len(window) + 1, items))
        a.make_automaton()
        _automata[key] = a if len(a) else None
    return _automata[key]


_SPAN = "struct<word_start:int,word_stop:int,byte_start:int,byte_stop:int>"
_OWN = {"n_words": "bigint", "n_hit": "bigint", "items": "array<string>", "spans": f"array<{_SPAN}>"}


def _scan(docs: DataFrame, sent, text: str, hits: str, last: bool, keep_text: bool) -> DataFrame:
    """Adds the hits of a block, a broadcast, to those of earlier blocks; the last block's scan turns them into results."""
    key = uuid.uuid4().hex
    kept = [f for f in docs.schema.fields if f.name != hits and (keep_text or not last or f.name != text)]
    new = [T.StructField(c, T._parse_datatype_string(kind)) for c, kind in (_OWN if last else {hits: HITS}).items()]
    span_type = pa.list_(pa.struct([(f"{a}_{b}", pa.int32()) for a in ("word", "byte") for b in ("start", "stop")]))
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("items", pa.list_(pa.string()))]))
    names, stay = [f.name for f in [*kept, *new]], [f.name for f in kept]

    columns = docs.columns

    def run(batches):
        automaton = _automaton(key, sent.value)
        for whole in batches:
            for batch in blocks(whole, columns.index(text)):
                raw, offs = byte_buffer(batch.column(columns.index(text)))
                data, at = raw.tobytes(), offs.tolist()
                before = batch.column(columns.index(hits)).to_pylist() if hits in columns else [[]] * batch.num_rows
                n_words, out, results = [], [], []
                for i, j, had in zip(at, at[1:], before):
                    clean = data[i:j].translate(_TABLE)
                    words = clean.split()
                    n_words.append(len(words))
                    norm = b" %b " % b" ".join(words)
                    got = list(automaton.iter(norm.decode("latin-1"))) if automaton and words else []
                    if got:
                        spaces = np.flatnonzero(np.frombuffer(norm, np.uint8) == 32)
                        stops = np.searchsorted(spaces, [e for e, _ in got])
                        starts = np.searchsorted(spaces, [e - n for e, (n, _) in got])
                        had = [*had, *({"start": a, "stop": b, "items": items} for a, b, (_, (_, items)) in zip(starts.tolist(), stops.tolist(), got))]
                    out.append(had)
                    if last:
                        results.append(_spans(clean, len(words), had) if had else (0, [], []))
                kept_columns = [batch.column(columns.index(c)) for c in stay]
                if last:
                    kept_columns += [pa.array(n_words, pa.int64()), pa.array([r[0] for r in results], pa.int64()), pa.array([r[1] for r in results], pa.list_(pa.string())), pa.array([r[2] for r in results], span_type)]
                else:
                    kept_columns.append(pa.array(out, kind))
                yield pa.RecordBatch.from_arrays(kept_columns, names=names)

    return mapped(docs, run, T.StructType([*kept, *new]))


def _spans(clean: bytes, n_words: int, hits: list[dict]) -> tuple[int, list[str], list[dict]]:
    """Words hit, items, and the runs of hit words with their byte offsets in the original text."""
    mask = cover(np.array([h["start"] for h in hits]), np.array([h["stop"] for h in hits]), n_words)
    first, last = runs(np.frombuffer(clean, np.uint8) != 32)
    a, b = runs(mask)
    items = sorted({x for h in hits for x in h["items"]})
    return int(mask.sum()), items, [{"word_start": int(s), "word_stop": int(e), "byte_start": int(first[s]), "byte_stop": int(last[e - 1])} for s, e in zip(a, b)]


def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", width: int = 10, most: int = BLOCK_BYTES, keep_text: bool = True) -> DataFrame:
    """Adds to the documents: n_words, n_hit (long), items (sorted ids as strings) and spans.

    ``spans``: the maximal runs of hit words, as words ``word_start``, ``word_stop`` and bytes of the
    original text ``byte_start``, ``byte_stop`` (ends exclusive).
    """
    keep = [c for c in docs.columns if c.lower() not in _OWN or c == text]
    marked = docs.select(*[F.col(f"`{c}`") for c in keep])
    hits = free_name(keep, "hits")
    send = docs.sparkSession.sparkContext.broadcast
    ahead: list | None = None
    for block in benchmark_blocks(benchmark_windows(benchmark, width), most):
        if ahead is not None:
            sent = send(ahead)
            before, marked = marked, stored(_scan(marked, sent, text, hits, False, True), "contamination")
            discard(before)
            sent.destroy()
        ahead = block
    return _scan(marked, send(ahead or []), text, hits, True, keep_text)
