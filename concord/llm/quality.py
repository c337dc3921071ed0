"""Quality rules on repetition: how much of a text lies in repeated n-grams and lines.

For several lengths n, the hashes of all word n-grams roll over a text: with prefix sums of word hash
times a power of an odd base, the hash of a window is one difference, brought to a common place by the
base's inverse (numpy, mod 2**64, a block of documents at a time).  They are sorted within each
document; characters of words inside any n-gram found twice or more in the same text are counted once,
first occurrences included, and so are the characters of lines equal to an earlier line.

The verdict: of the characters in words at most so many may be in repeated n-grams (``NGRAM_SHARES``, by
length) and in repeated lines (``LINE_CHAR_SHARE``), of the lines at most ``LINE_SHARE`` may repeat.

Defined results: a null text has no words and no lines with a word; a text without words fails the
base rule for its few words.  Texts are taken whole, in blocks bounded by bytes; nothing is compared
across documents, so repeated rows give equal rows and ids play no part.  Ties: a share equal to its
limit is kept.  An empty table gives an empty table.  Columns of any name are kept, but those that have
the name of a result are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import blocks, byte_buffer, cover, mapped

#: n-gram length -> highest share of word characters inside repeated n-grams that a kept text may have.
NGRAM_SHARES = {5: 0.20, 7: 0.15, 10: 0.10}
#: Highest share of lines (with a word) equal to an earlier one.
LINE_SHARE = 0.30
#: Highest share of word characters inside lines equal to an earlier one.
LINE_CHAR_SHARE = 0.20
_SPACE = b" \t\n\r\x0b\x0c"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SYMBOLS = b"#*$%&|<>"


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _BASE
    return h ^ (h >> np.uint64(29))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse mod 2**64."""
    out = []
    for x in (_BASE, np.uint64(pow(int(_BASE), -1, 1 << 64))):
        steps = np.full(n, x, np.uint64)
        steps[:1] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


def rolling(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums from which the hash of any window of the words is one difference, and what brings it to a common place."""
    power, inverse = powers(len(words))
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * power, out=total[1:])
    return total, inverse


def repeated_words(total: np.ndarray, inverse: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Mask of the words inside an n-gram that its document has twice or more.

    ``total``, ``inverse``: of ``rolling`` over a 64-bit hash per word; ``doc``: each word's document, in order.
    """
    size = len(doc)
    if size < n:
        return np.zeros(size, bool)
    at = np.flatnonzero(doc[: size - n + 1] == doc[n - 1 :])
    h = _mix((total[at + n] - total[at]) * inverse[at])
    h = _mix(h + doc[at].astype(np.uint64))
    order = np.argsort(h)
    same = h[order][1:] == h[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    starts = at[twice]
    return cover(starts, starts + n, size)


def _measure(texts: list[bytes], lengths: tuple[int, ...]) -> dict[str, np.ndarray]:
    split = [t.split() for t in texts]
    counts = np.array([len(w) for w in split], np.int64)
    doc = np.repeat(np.arange(len(texts)), counts)
    flat = [w for s in split for w in s]
    words = np.fromiter(map(hash, flat), np.int64, len(flat)).view(np.uint64)
    out = {"n_words": counts}
    out["word_bytes"] = np.array([len(b"".join(s)) for s in split], np.int64)
    out["n_symbols"] = np.array([len(t) - len(t.translate(None, _SYMBOLS)) for t in texts], np.int64)
    # Code points are the bytes that don't continue one.
    heads = [b"".join(s).translate(None, _CONTINUE) for s in split]
    out["word_chars"] = np.array([len(h) for h in heads], np.int64)
    sizes = np.array([len(w.translate(None, _CONTINUE)) for w in flat], np.int64) if any(len(h) != b for h, b in zip(heads, out["word_bytes"])) else np.fromiter(map(len, flat), np.int64, len(flat))
    total, inverse = rolling(words)
    for n in lengths:
        mask = repeated_words(total, inverse, doc, n)
        out[f"words_{n}"] = np.bincount(doc[mask], minlength=len(texts))
        out[f"chars_{n}"] = np.bincount(doc[mask], sizes[mask], minlength=len(texts)).astype(np.int64)
    lines = [[x for x in t.split(b"\n") if x and not x.isspace()] for t in texts]
    out["n_lines"] = np.array([len(x) for x in lines], np.int64)
    out["n_dup_lines"] = np.array([len(x) - len(set(x)) for x in lines], np.int64)
    out["chars_dup_lines"] = np.array([_again(x) if n else 0 for x, n in zip(lines, out["n_dup_lines"])], np.int64)
    return out


def _again(lines: list[bytes]) -> int:
    """Characters in words of lines that are equal to an earlier one."""
    seen: set[bytes] = set()
    total = 0
    for line in lines:
        if line in seen:
            total += len(line.translate(None, _SPACE + _CONTINUE))
        seen.add(line)
    return total


_CONTINUE = bytes(range(0x80, 0xC0))


def repetition(docs: DataFrame, text: str = "text", shares: dict[int, float] | None = None, line_share: float = LINE_SHARE, line_chars: float = LINE_CHAR_SHARE) -> DataFrame:
    """Adds the base figures, ``chars_n`` for each n of ``shares``, ``chars_dup_lines`` and the verdict ``kept``; the text goes."""
    shares = dict(NGRAM_SHARES if shares is None else shares)
    lengths = tuple(sorted({5, *shares}))
    longs = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "chars_dup_lines", *(f"chars_{n}" for n in lengths)]
    own = [*longs, "base_failed", "kept"]
    keep = [c for c in docs.columns if c.lower() not in own and c != text]
    # The text goes last and is known by its place: other columns may have any name.
    docs = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`"))
    schema = T.StructType([*docs.schema.fields[:-1], *(T.StructField(c, T.LongType()) for c in longs), T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())])

    def run(batches):
        for batch in batches:
            for part in blocks(batch, len(keep)):
                raw, offs = byte_buffer(part.column(len(keep)))
                data, at = raw.tobytes(), offs.tolist()
                x = _measure([data[i:j] for i, j in zip(at, at[1:])], lengths)
                x["n_repeat_words"] = x["words_5"]
                failed = (x["n_words"] < 10) | (100 * x["n_repeat_words"] > 20 * x["n_words"])
                kept = ~failed & (x["n_dup_lines"] <= line_share * x["n_lines"]) & (x["chars_dup_lines"] <= line_chars * x["word_chars"])
                for n, most in shares.items():
                    kept &= x[f"chars_{n}"] <= most * x["word_chars"]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *(pa.array(x[c], pa.int64()) for c in longs), pa.array(failed), pa.array(kept)], names=[*keep, *own])

    return mapped(docs, run, schema)
