"""The map-side operators against the libraries and against brute force."""

import hashlib
import random
import re
from collections import Counter

import pytest

from concord.llm import bpe, decontaminate, quality, token_count
from concord.llm.text import sha256_hex

SPACE = r"[^\x20\x09-\x0D]+"


def odd_texts(seed=1, n=400):
    rng = random.Random(seed)
    chars = "abcdeilnorst'’., \n\t  0123é漢🙂-!#$%ÀΣςа́▁<s>|\x1c\x85\xa0"
    fixed = ["", " ", "   ", "<|endoftext|>hi<|startoftext|>", "a<|endoftext|>b", "ΣΑΣ", "İ", "it's we'LL I'D", "ﬁ²½", "日本語 한국어", "x" * 3000, "ab " * 2000, "\n\n"]
    return fixed + ["".join(rng.choice(chars) for _ in range(rng.randint(1, 200))) for _ in range(n)]


def frame(spark, texts, extra="string"):
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, f"doc_id long, text string, n_tokens {extra}").repartition(3)


@pytest.fixture(scope="module")
def vocabulary(spark):
    return bpe.default_vocabulary(spark)


def test_bpe_is_the_library_s(spark, vocabulary):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_str(vocabulary)
    texts = [*odd_texts(), None]
    got = {r.doc_id: r for r in bpe.bpe_round_trip(frame(spark, texts), vocabulary).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        ids = lib.encode(t or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == sha256_hex(" ".join(map(str, ids)).encode())
        assert got[i].decoded_sha256 == sha256_hex(lib.decode(ids, skip_special_tokens=False).encode())


def test_bpe_ids_and_decode(spark, vocabulary):
    texts = ["Hello world", "", None]
    out = bpe.bpe_decode(bpe.bpe_encode(frame(spark, texts), vocabulary), vocabulary).orderBy("doc_id").collect()
    assert out[0].decoded == "hello</w> world</w>" and out[1].decoded == "" and out[2].token_ids == []
    assert bpe.bpe_encode(frame(spark, []), vocabulary).count() == 0


def invented(seed, n):
    """Words of syllables, which merge over many borders."""
    rng = random.Random(seed)
    parts = ["th", "er", "on", "an", "tion", "ing", "ou", "éa", "ß", "ch", "le", "ö", "nd", "s", "ê"]
    return list(dict.fromkeys("".join(rng.choices(parts, k=rng.randint(2, 9))) for _ in range(n)))


def test_bpe_encodes_each_word_once(vocabulary):
    words, made = bpe.WordBpe(vocabulary), invented(7, 150_000)
    seen, one = Counter(), words.encode_word
    words.encode_word = lambda w: seen.update([w]) or one(w)
    for between in (" ", ", "):
        words.encode(between.join(made))
    assert len(seen) == len(made) + 1 > 110_000 and set(seen.values()) == {1}


@pytest.mark.parametrize("most", [2, 40])
def test_bpe_with_small_tables_is_the_library_s(vocabulary, monkeypatch, most):
    from tokenizers import Tokenizer

    for name in ("WORD_TABLE", "CHUNK_TABLE", "SLICE"):
        monkeypatch.setattr(bpe, name, most)
    words, lib = bpe.WordBpe(vocabulary), Tokenizer.from_str(vocabulary)
    latin = [chr(c) for c in range(0x250)]
    texts = [" ".join(invented(8, 3000)), *odd_texts(9, 100), "’".join(invented(10, 50)) + " plain words 漢 and words", "".join(invented(11, 2000)), "".join(latin), " ".join(latin), "".join(f"a{c}{c}9'{c}s " for c in latin)]
    for t in texts:
        assert words.encode(t).tolist() == lib.encode(t, add_special_tokens=False).ids, repr(t[:200])
    assert len(words.words) <= most and len(words.chunks) <= most


def test_token_counts_are_the_library_s(spark):
    import sentencepiece

    model = token_count.default_model(spark)
    lib = sentencepiece.SentencePieceProcessor(model_proto=model)
    texts = [*odd_texts(2), *[" " * i + "a" + " " * j + "b" + " " * i for i in range(6) for j in range(6)], None]
    got = {r.doc_id: r for r in token_count.count_tokens(frame(spark, texts), model, limit=50).collect()}
    for i, t in enumerate(texts):
        n = len(lib.encode(t or ""))
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((t or "").encode()), n > 50), repr(t)
    assert token_count.count_tokens(frame(spark, []), model).count() == 0


def brute_quality(text):
    words = re.findall(SPACE, text or "")
    chars, hits = {}, {}
    for n in (5, 7, 10):
        windows = Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
        hits[n] = {j for i in range(len(words) - n + 1) if windows[tuple(words[i : i + n])] > 1 for j in range(i, i + n)}
        chars[n] = sum(len(words[i]) for i in hits[n])
    seen, again, again_chars, lines = set(), 0, 0, 0
    for line in (text or "").split("\n"):
        if re.search(SPACE, line):
            lines += 1
            if line in seen:
                again += 1
                again_chars += sum(map(len, re.findall(SPACE, line)))
            seen.add(line)
    total = sum(map(len, words))
    failed = len(words) < 10 or 100 * len(hits[5]) > 20 * len(words)
    kept = not failed and again <= 0.30 * lines and again_chars <= 0.20 * total and chars[5] <= 0.20 * total and chars[7] <= 0.15 * total and chars[10] <= 0.10 * total
    return len(words), total, len(re.findall(r"[#*$%&|<>]", text or "")), again, len(hits[5]), failed, *chars.values(), again_chars, kept


def test_quality_against_brute_force(spark):
    rng = random.Random(4)
    texts = [None, "", *odd_texts(3, 50), "a b c d e " * 3, "l one\nl one\n\n \nl one\n", "one two three four five six seven eight nine ten é"]
    texts += ["".join(rng.choice(["ab ", "cd ", "é ", "f\n", "g# "]) for _ in range(rng.randint(0, 300))) for _ in range(100)]
    vocab = [f"wörd{i}" for i in range(400)]
    for _ in range(150):  # near the verdict's limits
        lines = [" ".join(rng.choice(vocab) for _ in range(rng.randint(3, 14))) for _ in range(12)]
        texts.append("\n".join(lines + [rng.choice(lines) for _ in range(rng.randint(0, 5))]))
    got = {r.doc_id: r for r in quality.repetition(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        g = got[i]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words, g.base_failed, g.chars_5, g.chars_7, g.chars_10, g.chars_dup_lines, g.kept) == brute_quality(t), repr(t)
    passed = [r for r in got.values() if not r.base_failed]
    assert {r.kept for r in passed} == {True, False}
    assert quality.repetition(frame(spark, [])).count() == 0


def odd_rows(spark, columns):
    """Nulls, empty and repeated rows, a very long text, and columns with the names that the operators use inside."""
    long = " ".join(f"w{i % 5000} x" for i in range(200_000))
    texts = [None, "", "same text of several words here", "same text of several words here", long, "w1"]
    rows = [(None if i == 3 else 7, t, *("c" for _ in columns)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, body string, " + ", ".join(f"`{c}` string" for c in columns)).repartition(2)


CLASHING = ["text", "hits", "row", "block", "kind", "at", "word", "words", "used", "times", "page", "range", "depth", "top", "best", "key", "id", "own", "spans", "key_a", "key_b", "_"]


def test_odd_rows_and_clashing_names(spark, vocabulary):
    docs = odd_rows(spark, CLASHING)
    bench = spark.createDataFrame([(1, "same text of several words here")], "item_id long, text string")
    model = token_count.default_model(spark)
    for name, run in {
        "op1": lambda d: bpe.bpe_round_trip(d, vocabulary, text="body"),
        "op5": lambda d: decontaminate.find_contamination(d, bench, text="body"),
        "op8": lambda d: quality.repetition(d, text="body"),
        "op10": lambda d: token_count.count_tokens(d, model, text="body"),
    }.items():
        out = run(docs)
        assert set(CLASHING) - {"spans"} <= set(out.columns), name
        rows = out.collect()
        assert len(rows) == 6 and all(r[c] == "c" for r in rows for c in CLASHING if c != "spans"), name
        assert run(docs.limit(0)).count() == 0, name
    whole = {r.n_bytes: r.n_tokens for r in token_count.count_tokens(docs, model, text="body").collect()}
    assert whole[0] == 0 and max(whole) > 1_000_000 and max(whole.values()) > 400_000


def brute_contamination(text, items, width=10):
    words_of = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    words, hit, found = words_of(text), set(), set()
    for item, t in items:
        w = words_of(t)
        if not w:
            continue
        size = min(width, len(w))
        wanted = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in wanted:
                hit |= set(range(i, i + size))
                found.add(str(item))
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("most", [1 << 20, 300])
def test_contamination_against_brute_force(spark, most):
    rng = random.Random(6)
    vocab = ["Alpha", "béta", "c3", "d", "Ee", "ÉF"]
    make = lambda n: "".join(rng.choice(vocab) + rng.choice([" ", ", ", "-", "\n", "_"]) for _ in range(n))
    items = [(1, "alpha beta"), (2, None), (3, ""), (4, "!!"), (5, make(12)), (6, make(30)), (7, "c3"), (8, make(9))]
    items.append((9, items[5][1]))
    texts = [None, "", "...", "ALPHA, Beta!", *[make(rng.randint(0, 40)) for _ in range(60)], "x " + items[5][1] + " y", items[4][1] * 3]
    docs = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, hits string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.find_contamination(docs, bench, most=most).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.n_hit, sorted(r["items"])) == brute_contamination(r.text, items), repr(r.text)
        raw = (r.text or "").encode()
        for s in r.spans:
            assert len(decontaminate.words_of(raw[s.byte_start : s.byte_stop])) == s.word_stop - s.word_start
    empty = decontaminate.find_contamination(docs, bench.limit(0)).collect()
    assert len(empty) == len(texts) and all(r.n_hit == 0 for r in empty)
    assert decontaminate.find_contamination(docs.limit(0), bench).count() == 0


def test_item_digest(spark, tmp_path):
    from concord.llm import queries

    spark.createDataFrame([(1, "a b c"), (2, "zz")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(10, "b"), (9, "a b")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = {r.doc_id: r for r in queries.op5_decontaminate(spark, str(tmp_path)).collect()}
    assert out[1].items_sha256 == hashlib.sha256(b"10,9").hexdigest() and out[1].n_items == 2 and out[1].n_hit == 2
    assert out[2].items_sha256 == hashlib.sha256(b"").hexdigest() and not out[2].contaminated
