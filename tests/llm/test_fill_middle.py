"""Fill-in-the-middle against a loop over units, exact restoring, and odd rows."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from concord.llm import fill_middle


def brute(text, doc_id):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def odd_texts(n=600):
    rng = random.Random(12)
    chars = ["ab", "Zz", "é", "日", "🙂", " ", "\n", "\r\n", "1", "<", "<P", "P>", "<S", ">", "M>", "<M", "\x00", "\x85", "ſ", "K"]
    fixed = [None, "", "<", "<P>", "a<S>b", "<M>", "<<P>>", "abc", "...", "\n", "<P", "S>", "<P<S<M"]
    return fixed + ["".join(rng.choice(chars) for _ in range(rng.randint(1, 60))) for _ in range(n)]


@pytest.mark.parametrize("piece", [1, 7, 1 << 20])
def test_against_a_loop_over_units(piece, monkeypatch):
    monkeypatch.setattr(fill_middle, "PIECE", piece)
    for i, t in enumerate(odd_texts()):
        assert fill_middle.transformed(t or "", f"1:{i}", 90, 20) == brute(t, i), (piece, t)


def test_rows_and_restoring(spark):
    texts = odd_texts()
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)] + [(None, "one two", "x", "y")] * 2 + [(5, texts[5], "x", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, FIM string, `a b` string").repartition(3)
    out = fill_middle.fill_in_middle(docs)
    assert out.columns == ["doc_id", "a b", "n", "form", "prefix_chars", "middle_chars", "fim"]
    got = out.withColumn("again", fill_middle.restored(F.col("fim"), F.col("form"))).collect()
    want = sorted((repr((i, *brute(t, i))), t or "") for i, t, *_ in rows)
    assert sorted((repr((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.fim)), r.again) for r in got) == want
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fill_middle.fill_in_middle(docs.limit(0)).count() == 0


def test_long_texts(spark):
    """Two million units and one unit of two million letters; ids that are no numbers; other rates."""
    texts = {"a": "x, " * 700_000, "b": "q" * 2_000_000, "c": "é" * 1_500_000}
    docs = spark.createDataFrame([*texts.items()], "doc_id string, text string")
    for r in fill_middle.fill_in_middle(docs).withColumn("again", fill_middle.restored(F.col("fim"), F.col("form"))).collect():
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.fim) == brute(texts[r.doc_id], r.doc_id)
        assert r.again == texts[r.doc_id]
    few = spark.createDataFrame([(i, "a b c") for i in range(2_000)], "doc_id long, text string")
    n = {r.form: r["count"] for r in fill_middle.fill_in_middle(few, fim=50, spm=50).groupBy("form").count().collect()}
    assert 900 < n["plain"] < 1_100 and 400 < n["psm"] < 600
