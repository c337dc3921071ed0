"""Fill-in-the-middle: a text is cut twice at unit borders and reordered so that its middle comes last.

Units are runs of letters A-Z and a-z, and every other character by itself.  One fullmatch of ``(unit)*``
with the regex library keeps every repetition of its group: ``match.ends(1)`` has the end of each unit, so its
length is n and the cuts are two of its members, without a loop over units.  A text of more than ``PIECE``
characters is matched in pieces that end at unit borders, which bounds what a match holds; the pieces'
unit numbers follow on, so results don't depend on where they end.

The cuts, the choice of texts and that of the form come from the SHA-256 of ``<seed>:<id>``, so they don't
depend on the order or place of rows and come out the same after a lost executor.

* ``plain``: the text as it is;  ``psm``: <P>prefix<S>suffix<M>middle;  ``spm``: <S>suffix<P>prefix<M>middle.

Defined results: a null text counts as empty; an empty text and one that contains a mark are plain; a null id
is hashed as the empty string.  Texts are cut whole, however long.  Ties: if both cuts fall on one border the
middle is empty.  Rows are cut by themselves: repeated rows give equal rows.  An empty table gives an empty
table.  Columns of any name are kept but for n, form, prefix_chars, middle_chars and fim, which are replaced.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import blocks, mapped

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Characters that one match takes at a time (and up to the end of a run of letters).
PIECE = 1 << 20
# Possessive: a border between units is never tried elsewhere, so nothing is kept for backtracking.
_UNITS = regex.compile(r"([A-Za-z]++|[^A-Za-z])*+")
_OTHER = regex.compile(r"[^A-Za-z]")
_OWN = ["n", "form", "prefix_chars", "middle_chars", "fim"]


def unit_ends(text: str, start: int, stop: int) -> list[int]:
    """The end of every unit of text[start:stop], which begins and ends at unit borders."""
    return _UNITS.fullmatch(text, start, stop).ends(1)


def pieces(text: str, size: int) -> list[tuple[int, int]]:
    """Spans of about ``size`` characters that end at unit borders: before a character that is no letter, or at the text's end."""
    out, start = [], 0
    while start < len(text):
        border = _OTHER.search(text, start + size)
        stop = border.start() if border else len(text)
        out.append((start, stop))
        start = stop
    return out


def _offsets(text: str, choose) -> tuple[int, list[int]]:
    """n, and the offsets behind the numbers of units that ``choose(n)`` gives."""
    spans = pieces(text, PIECE)
    if len(spans) < 2:
        ends = unit_ends(text, 0, len(text)) if text else []
        return len(ends), [ends[k - 1] if k else 0 for k in choose(len(ends))]
    upto = [0]
    for a, b in spans:
        upto.append(upto[-1] + len(unit_ends(text, a, b)))
    out = []
    for k in choose(upto[-1]):
        i = bisect_left(upto, k) - 1
        out.append(unit_ends(text, *spans[i])[k - upto[i] - 1] if k else 0)
    return upto[-1], out


def transformed(text: str, key: str, fim: int, spm: int) -> tuple[int, str, int | None, int | None, str]:
    """n, form, characters of prefix and of middle (null if plain) and the output of one text."""
    digest = hashlib.sha256(key.encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    n, (a, b) = _offsets(text, lambda n: sorted((h1 % (n + 1), h2 % (n + 1))))
    if not text or h3 % 100 >= fim or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    before, middle, after = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm:
        return n, "spm", a, b - a, f"{SUFFIX}{after}{PREFIX}{before}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{before}{SUFFIX}{after}{MIDDLE}{middle}"


def fill_in_middle(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", seed: int = 1, fim: int = 90, spm: int = 20) -> DataFrame:
    """Adds n, form, prefix_chars, middle_chars and ``fim``, the transformed text; the text goes.

    Of 100 texts about ``fim`` are cut, and of those about ``spm`` in 100 have the suffix first.
    """
    keep = [c for c in docs.columns if c.lower() not in _OWN and c != text]
    # The hashed key and the text go last and are known by their places: other columns may have any name.
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")))
    docs = docs.select(*[F.col(f"`{c}`") for c in keep], key, F.col(f"`{text}`"))
    types = (T.LongType(), T.StringType(), T.LongType(), T.LongType(), T.StringType())
    schema = T.StructType([*docs.schema.fields[:-2], *map(T.StructField, _OWN, types)])
    at, arrow = len(keep), (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())

    def run(batches):
        for batch in batches:
            for part in blocks(batch, at + 1):
                out = [transformed(t or "", k, fim, spm) for k, t in zip(part.column(at).to_pylist(), part.column(at + 1).to_pylist())]
                yield pa.RecordBatch.from_arrays([*part.columns[:-2], *map(pa.array, zip(*out), arrow)], names=[f.name for f in schema.fields])

    return mapped(docs, run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text again, from the output and its form alone.

    A text with a mark in it is plain, and no mark can arise where a piece meets one, so the first
    place of each mark is the one that the operator set.
    """
    place = lambda mark: F.instr(output, mark)
    between = lambda start, stop: F.substring(output, start + F.lit(3), stop - start - F.lit(3))
    p, s, m = place(PREFIX), place(SUFFIX), place(MIDDLE)
    middle = F.substring(output, m + F.lit(3), F.length(output))
    return F.when(form == "psm", F.concat(between(p, s), middle, between(s, m))).when(form == "spm", F.concat(between(p, m), middle, between(s, p))).otherwise(output)
