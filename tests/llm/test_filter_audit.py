"""The filter audit against a loop over orders, and the document-term matrix against word counts."""

import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from concord.llm import filter_audit, skew


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def failing(docs):
    """The letters that each (doc_id, text) fails, in order."""
    out = []
    for doc_id, text in docs:
        t, w = text or "", words_of(text)
        e = doc_id is not None and any((x or "") == t and i is not None and i < doc_id for i, x in docs)
        marks = len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), bool(re.search(r"[#$%&*|]", t)), e
        out.append("".join(f for f, m in zip("ABCDE", marks) if m))
    return out


def brute(rows, labels):
    """rows: doc_id, text, lang."""
    fails, out = failing([r[:2] for r in rows]), Counter()
    good, toxic = ({x[0] for x in labels if x[k] == 1 and x[0] is not None} for k in (1, 2))
    parts = {r[2] or "" for r in rows}
    for order in map("".join, permutations("ABCDE")):
        for (doc_id, _, lang), f in zip(rows, fails):
            hit = next((x for x in order if x in f), None)
            for step, x in enumerate(order, 1):
                at = (lang or "", order, step)
                out[at, "kept"] += hit is None or order.index(hit) >= step
                out[at, "removed"] += hit == x
                out[at, "redundant"] += x in f and hit != x
                out[at, "unique_fails"] += f == x
                out[at, "good_lost"] += hit == x and doc_id in good
                out[at, "toxic_lost"] += hit == x and doc_id in toxic
                if hit == x:
                    out[(lang or "", x), "shapley"] += 1
    names = "kept removed redundant unique_fails good_lost toxic_lost".split()
    return {(p, o, s): (*(out[(p, o, s), c] for c in names), out[(p, o[s - 1]), "shapley"]) for p in parts for o in map("".join, permutations("ABCDE")) for s in range(1, 6)}


@pytest.fixture(scope="module")
def rows():
    many = " ".join(f"word{i}é" for i in range(300))
    texts = [None, "", many, many, "UP " * 250, "a $ b", many + " #", "a\x1cb\x85c " * 210, "one two " * 100, many.upper(), " ".join(f"w{i % 100}" for i in range(200)), " ".join(f"w{i % 99}" for i in range(200))]
    ids = [*range(12)]
    out = [(i, t, ("en", "fr", None, "")[i % 4]) for i, t in zip(ids, texts)]
    out += [(20 + i, many, "en") for i in range(40)] + [(2, many, "en"), (None, many, "de"), (None, None, "de"), (30, "", "fr")]
    return out


LABELS = [(2, 1, 0), (3, 1, 1), (3, 0, 0), (4, None, 1), (None, 1, 1), (77, 1, 1), (22, 0, 1)]


def run(spark, rows, labels=LABELS):
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, lang string, digest string, part string").repartition(4)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = filter_audit.audit(filter_audit.failures(docs), marks)
    got = {(r.part, r.filter_order, r.step): tuple(r[3:]) for r in out.collect()}
    return got


def test_against_a_loop_over_orders(spark, rows):
    assert run(spark, rows) == brute(rows, LABELS)


def test_hot_copies_and_small_blocks(spark, rows, monkeypatch):
    """Digests on more than a few rows are broadcast, blocks hold a few words and buckets a few bytes: the same figures."""
    for name, value in (("WORDS", 50), ("BUCKET_BYTES", 64)):
        monkeypatch.setattr(filter_audit, name, value)
    monkeypatch.setattr(skew, "LEAST_ROWS", 3)
    monkeypatch.setattr(skew, "HOT_KEYS", 10)
    assert run(spark, rows) == brute(rows, LABELS)


def test_empty_tables(spark, rows):
    assert run(spark, rows[:3], labels=[]) == brute(rows[:3], [])
    assert run(spark, []) == {}


@pytest.mark.parametrize("words", [3, 400_000])
def test_matrix_is_the_word_counts(spark, rows, words, monkeypatch):
    monkeypatch.setattr(filter_audit, "WORDS", words)
    texts = [*dict.fromkeys(r[1] for r in rows), " ".join(f"z{i}" for i in range(100_000)), "very long " * 300_000]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").repartition(3)
    encoded = filter_audit.encoded_blocks(docs)
    table = filter_audit.dictionary(encoded).collect()
    word = {r.term: r.word for r in table}
    assert len(word) == len(table) and set(word.values()) == {w for t in texts for w in words_of(t)} and len(set(word.values())) == len(word)
    found = {}
    for s in filter_audit.shards(encoded).collect():
        edges = [0, *s.ends]
        assert len(s.ends) == len(s.docs) and s.ends[-1] == len(s.terms) == len(s.counts)
        for d, a, b in zip(s.docs, edges, edges[1:]):
            found[d.doc_id] = {word[t]: n for t, n in zip(s.terms[a:b], s.counts[a:b])}
    assert found == {i: dict(Counter(words_of(t))) for i, t in enumerate(texts)}
    figures = {r.doc_id: (r.n_words, r.n_distinct) for r in filter_audit.row_figures(filter_audit.shards(encoded)).collect()}
    assert figures == {i: (len(words_of(t)), len(set(words_of(t)))) for i, t in enumerate(texts)}


def test_planes():
    for x in ([], [0], [3, 70_000, 70_001, 4_000_000_000], [5, 2, 9, 0]):
        assert filter_audit._numbers(filter_audit._planes(np.array(x, np.int64))).tolist() == x


def test_other_limits(spark):
    docs = spark.createDataFrame([(1, "A b c", "en"), (2, "a b c", "en")], "doc_id long, text string, lang string")
    got = {r.doc_id: (r.A, r.B, r.C) for r in filter_audit.failures(docs, least_words=3, distinct=100, capitals=20).collect()}
    assert got == {1: (False, False, False), 2: (False, False, False)}
    assert filter_audit.failures(docs, least_words=4, capitals=19).where(F.col("A") & F.col("C")).count() == 1
