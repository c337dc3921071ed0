"""Exact byte-pair encoding in linear time, and decoding through an offset table.

The encoder never replays merges.  An Aho-Corasick automaton over the vocabulary walks a word from
longest token to longest token; each is taken unless the pair-compatibility table says that it can't
stand beside its predecessor, in which case the next shorter one is tried or the predecessor is taken
back, and the walk goes on from there.  Each position is given up at most once, so the work is linear.
Words are encoded once and kept; when the table is full, those not asked for lately go.
Decoding gathers bytes from one blob by the offsets of the ids.

Defined results: a null text counts as empty; an empty text has no tokens and decodes to ``""``.
Texts of any length are taken whole, in blocks bounded by bytes.  Each row is encoded by itself: rows
that repeat give equal rows, and ids that repeat or are null play no part.  There are no ties: each
text has one encoding.  An empty table gives an empty table of the same columns.  Columns of the
input are kept whatever their names; those the operator adds replace columns of the same name.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from itertools import groupby

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from .text import blocks, mapped, sha256_hex

#: A task keeps so many words, texts with rare characters between spaces, and pairs; results don't depend on it.
WORD_TABLE, CHUNK_TABLE, PAIR_TABLE = 300_000, 100_000, 100_000
#: Longer words are encoded where they stand and not kept.
KEPT_LENGTH = 64
#: A text is cut into words about so many characters at a time, which bounds memory.
SLICE = 1 << 20
_END = 0xE000  # a word's last symbol is moved here, so that it differs from the same byte inside


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class _Kept(dict):
    """``make(key)`` for each key asked for; when there are ``most``, the half that was not asked for lately goes."""

    def __init__(self, make: Callable[[str], bytes], most: int):
        super().__init__()
        self.make, self.half, self.older = make, most // 2, {}

    def __missing__(self, key: str) -> bytes:
        got = self.older.pop(key, None)
        if got is None:
            got = self.make(key)
        if len(key) <= KEPT_LENGTH:
            if len(self) >= self.half:
                self.older = dict(self)
                self.clear()
            self[key] = got
        return got


class WordBpe:
    """A word-level BPE vocabulary with word ends, read from a tokenizers JSON file."""

    def __init__(self, spec: str):
        spec = json.loads(spec)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        alphabet = byte_alphabet()
        base = [*alphabet, *(chr(_END + ord(c)) for c in alphabet)]
        self.tokens: list[str] = base
        order = {t: i for i, t in enumerate(base)}
        self.parts: list[tuple[int, int]] = [(i, i) for i in range(len(base))]
        self.merged: dict[tuple[int, int], int] = {}
        for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            pair = order[self._own(a)], order[self._own(b)]
            token = self.tokens[pair[0]] + self.tokens[pair[1]]
            if token not in order:
                order[token] = len(self.tokens)
                self.tokens.append(token)
                self.parts.append(pair)
            self.merged.setdefault(pair, order[token])
        raw = np.array([vocab.get(self._outer(t), -1) for t in self.tokens], np.int32).tobytes()
        self.ids = [raw[at : at + 4] for at in range(0, len(raw), 4)]
        self.sizes = [len(t) for t in self.tokens]
        self.longest = max(self.sizes)
        self.shorts: dict[int, int] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        self.automaton = ahocorasick.Automaton()
        for i, t in enumerate(self.tokens):
            if i < len(base) or self._reachable(i):
                self.automaton.add_word(t, (len(t), i))
        self.automaton.make_automaton()
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.split_special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        # The vocabulary's own text rules (Unicode forms, case, borders of words); the merges are ours.
        rules = Tokenizer.from_str(json.dumps(spec | {"added_tokens": [], "model": model | {"vocab": {}, "merges": []}}))
        self.normalise, self.split = rules.normalizer.normalize_str, rules.pre_tokenizer.pre_tokenize_str
        self.symbols = alphabet
        #: Fixed value: the pattern for which _LATIN is a faster equal.
        self.plain = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] == r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
        self.texts = {**{i: t for t, i in vocab.items()}, **{i: t for t, i in self.special.items()}}
        self.words, self.chunks = _Kept(self.word, WORD_TABLE), _Kept(self.chunk, CHUNK_TABLE)

    def _own(self, token: str) -> str:
        if token.endswith(self.suffix) and len(token) > len(self.suffix):
            token = token[: -len(self.suffix)]
            return token[:-1] + chr(_END + ord(token[-1]))
        return token

    def _outer(self, token: str) -> str:
        last = ord(token[-1])
        return token[:-1] + chr(last - _END) + self.suffix if last >= _END else token

    def _reachable(self, token: int) -> bool:
        """False for a token that merging its own symbols would never end in."""
        left, right = self.parts[token]
        return self.compatible(left, right, token)

    def compatible(self, left: int, right: int, below: int | None = None) -> bool:
        """Whether merging keeps the border between two tokens: no pair across it is merged before each side is whole.

        ``below`` asks about the pairs merged before that token only.
        """
        key = (left, right)
        if below is None and (known := self.fits.get(key)) is not None:
            return known
        limit, result, a, b = (len(self.tokens) if below is None else below), True, left, right
        while True:
            new = self.merged.get((a, b))
            if new is not None and new < limit:
                result = False
                break
            # Step back to the state before the later of the two was formed.
            if a > b:
                limit, nxt = a, self.parts[a][1]
                if nxt == a:
                    break
                a = nxt
            else:
                limit, nxt = b + 1, self.parts[b][0]
                if nxt == b:
                    limit, nxt = a, self.parts[a][1]
                    if nxt == a:
                        break
                    a = nxt
                else:
                    b = nxt
        if below is None:
            if len(self.fits) >= PAIR_TABLE:
                self.fits.clear()
            self.fits[key] = result
        return result

    def shorter(self, token: int) -> int:
        """The longest token that another one begins with, or -1."""
        found = self.shorts.get(token)
        if found is None:
            text = self.tokens[token]
            begun = (self.automaton.get(text[:n], None) for n in range(len(text) - 1, 0, -1))
            found = self.shorts[token] = next((b[1] for b in begun if b), -1)
        return found

    def encode_word(self, word: str) -> list[int]:
        """Token ordinals of one word in the vocabulary's own symbols."""
        sizes, fits, walk = self.sizes, self.fits, self.automaton.iter_long
        out: list[int] = []
        dead: set[int] = set()  # positions given up
        pos, last, ahead, stop, size = 0, -1, None, 0, len(word)
        while pos < size:
            if ahead is None or stop < size and pos + self.longest > stop:
                stop = min(pos + 16 * self.longest, size)  # the automaton copies what it walks over
                ahead = walk(word[pos:stop])
            token = next(ahead)[1][1]  # the longest at pos
            while True:
                if token < 0:
                    dead.add(pos)
                    if not out:
                        raise ValueError(f"no encoding of {word!r}")
                    token = out.pop()
                    pos -= sizes[token]
                    last = out[-1] if out else -1
                elif pos + sizes[token] not in dead:
                    if last < 0:
                        break
                    good = fits.get((last, token))
                    if good or good is None and self.compatible(last, token):
                        break
                token, ahead = self.shorter(token), None
            out.append(token)
            pos += sizes[token]
            last = token
        return out

    def piece(self, piece: str) -> bytes:
        """The ids of a word in the vocabulary's symbols, as int32 bytes."""
        return b"".join([self.ids[t] for t in self.encode_word(piece[:-1] + chr(_END + ord(piece[-1])))])

    def word(self, word: str) -> bytes:
        """The ids of a lower-case word of plain characters."""
        return self.piece(word if word.isascii() and word.isprintable() else "".join([self.symbols[b] for b in word.encode()]))

    def chunk(self, chunk: str) -> bytes:
        """The ids of a text without white space by the vocabulary's own rules."""
        return b"".join([self.piece(p) for p, _ in self.split(self.normalise(chunk))])

    def is_plain(self, text: str) -> bool:
        return self.plain and (text.isascii() or not _RARE.search(text))

    def encode(self, text: str) -> np.ndarray:
        """All ids of a text; special strings in it become their own ids."""
        if any(m in text for m in self.special):
            parts, marks = self.split_special.split(text), self.split_special.findall(text)
        else:
            parts, marks = [text], []
        word, chunk, out = self.words.__getitem__, self.chunks.__getitem__, []
        for i, whole in enumerate(parts):
            for part in _slices(whole):
                if self.is_plain(part):
                    out.append(b"".join(map(word, _LATIN.findall(part.lower()))))
                    continue
                chunks = _CHUNK.findall(part) if any(c in part for c in _ODD_SPACE) else part.split()
                for plain, group in groupby(chunks, self.is_plain):
                    out.append(b"".join(map(word, _LATIN.findall(" ".join(group).lower())) if plain else map(chunk, group)))
            if i < len(marks):
                out.append(np.array([self.special[marks[i]]], np.int32).tobytes())
        return np.frombuffer(b"".join(out), np.int32)


# str.split() breaks at four control characters that aren't white space in Unicode.
_ODD_SPACE = "\x1c\x1d\x1e\x1f"
_CHUNK = re.compile("(?:[^\\s]|[\x1c-\x1f])+")

# Plain: up to composed Latin letters, the same in every version of Unicode. Of some the lower case lies above them.
_RARE = re.compile("[^\x00-\u024f]")
_LATIN = re.compile("[a-zªµºß-öø-\u02af\u2c65\u2c66]+|'(?:[stmd]|re|ve|ll)|[\\d²³¹¼½¾]|(?:[^\\s\\w]|_|[\x1c-\x1f])+")
_SPACE = re.compile("[ \t\n\r]")


def _slices(text: str) -> Iterator[str]:
    """The text in slices that begin at white space, of ``SLICE`` characters and what is left of a word."""
    at = 0
    while len(text) - at > SLICE and (space := _SPACE.search(text, at + SLICE)):
        yield text[at : space.start()]
        at = space.start()
    yield text[at:]


class OffsetTable:
    """Strings by id as one blob with offsets; a sequence of ids is one gather, the parts joined by a space."""

    def __init__(self, strings: dict[int, str]):
        n = max(strings, default=-1) + 1
        raw = [(strings.get(i, "") + " ").encode() for i in range(n)]
        self.known = np.array([i in strings for i in range(n)], bool)
        self.sizes = np.array([len(r) for r in raw], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.blob = np.frombuffer(b"".join(raw), np.uint8)

    def gather(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of all ids, each followed by a space, and where each id's end."""
        if not len(ids):
            return b"", ids
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        index = np.repeat(self.starts[ids] - (ends - sizes), sizes)
        index += np.arange(ends[-1])
        return np.take(self.blob, index, mode="clip").tobytes(), ends

    def text(self, ids: np.ndarray, step: int = 1 << 18) -> bytes:
        return b"".join([self.gather(ids[at : at + step])[0] for at in range(0, len(ids), step)])[:-1]

    def digest(self, ids: np.ndarray) -> str:
        return sha256_hex(self.text(ids))


def _model(spec: str) -> tuple[WordBpe, OffsetTable, OffsetTable]:
    """The encoder, the tokens' texts and the ids' decimals. Built in each task (a third of a second), so that an idle worker holds none."""
    bpe = WordBpe(spec)
    return bpe, OffsetTable(bpe.texts), OffsetTable({i: str(i) for i in bpe.texts})


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def bpe_encode(docs: DataFrame, vocabulary: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """Adds the token ids of each whole text as an array column (int).

    ``vocabulary`` is the JSON text of the vocabulary (``read_vocabulary(path)``): a file of fixed size,
    sent to the tasks as a broadcast variable.
    """
    spec = docs.sparkSession.sparkContext.broadcast(vocabulary)
    keep = [c for c in docs.columns if c.lower() != ids.lower()]
    docs = docs.select(*[F.col(f"`{c}`") for c in keep])
    schema = T.StructType([*docs.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)])
    at = keep.index(text)

    def run(batches):
        bpe = _model(spec.value)[0]
        for batch in batches:
            for part in blocks(batch, at):
                got = [bpe.encode(t or "") for t in part.column(at).to_pylist()]
                offs = np.concatenate(([0], np.cumsum([len(g) for g in got]))).astype(np.int32)
                flat = np.concatenate(got) if got else np.zeros(0, np.int32)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.ListArray.from_arrays(offs, pa.array(flat, pa.int32()))], names=[*keep, ids])

    return mapped(docs, run, schema)


def bpe_decode(tokens: DataFrame, vocabulary: str, ids: str = "token_ids", decoded: str = "decoded") -> DataFrame:
    """Adds the decoded text of an array of ids; special tokens are kept. Null ids decode to ``""``."""
    spec = tokens.sparkSession.sparkContext.broadcast(vocabulary)
    keep = [c for c in tokens.columns if c.lower() != decoded.lower()]
    tokens = tokens.select(*[F.col(f"`{c}`") for c in keep])
    schema = T.StructType([*tokens.schema.fields, T.StructField(decoded, T.StringType(), False)])
    at = keep.index(ids)

    def run(batches):
        words = _model(spec.value)[1]
        for batch in batches:
            for part in blocks(batch, at):
                out = [words.text(np.asarray(v.values, np.int64)).decode() if v.is_valid else "" for v in part.column(at)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.string())], names=[*keep, decoded])

    return mapped(tokens, run, schema)


def bpe_round_trip(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """Replaces the text by n_tokens, ids_sha256 and decoded_sha256: encodes, decodes and digests in one pass.

    The ids and the decoded text stay inside the task, where only their digests are wanted.
    """
    spec = docs.sparkSession.sparkContext.broadcast(vocabulary)
    own = ["n_tokens", "ids_sha256", "decoded_sha256"]
    keep = [c for c in docs.columns if c.lower() not in own and c != text]
    # The text goes last and is known by its place: other columns may have any name.
    docs = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`"))
    schema = T.StructType([*docs.schema.fields[:-1], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def run(batches):
        bpe, words, decimals = _model(spec.value)
        for batch in batches:
            for part in blocks(batch, len(keep)):
                n, first, second = [], [], []
                for t in part.column(len(keep)).to_pylist():
                    ids = bpe.encode(t or "")
                    n.append(len(ids))
                    first.append(decimals.digest(ids))
                    second.append(words.digest(ids))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(n, pa.int64()), pa.array(first, pa.string()), pa.array(second, pa.string())], names=[*keep, *own])

    return mapped(docs, run, schema)


def default_vocabulary(spark: SparkSession) -> str:
    """The JSON vocabulary named by ``spark.concord.llm.wordBpe``, else the installed public one."""
    import public_tokenizers

    return read_vocabulary(spark.conf.get("spark.concord.llm.wordBpe", public_tokenizers.path("word_bpe_49k.json")))
