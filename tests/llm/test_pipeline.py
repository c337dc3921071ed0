"""The pipeline against brute force: only the classifier's verdicts are taken from its operator."""

import sys
from pathlib import Path

from tokenizers import Tokenizer

from concord.llm import bpe, toxicity
from concord.llm.text import sha256_hex

sys.path.insert(0, str(Path(__file__).parent))
from test_tables import brute_near  # noqa: E402
from test_text_operators import brute_contamination  # noqa: E402


def brute_cut(texts, size=200):
    """The texts without bytes in repeated strings, and without characters that a cut went through."""
    seen = {}
    for t in texts:
        for i in range(len(t) - size + 1):
            seen[t[i : i + size]] = seen.get(t[i : i + size], 0) + 1
    out = []
    for t in texts:
        mask = bytearray(len(t))
        for i in range(len(t) - size + 1):
            if seen[t[i : i + size]] > 1:
                mask[i : i + size] = b"\1" * size
        out.append(bytes(b for b, m in zip(t, mask) if not m).decode(errors="ignore"))
    return out


def test_pipeline_against_brute_force(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = [(r.doc_id, r.text) for r in toxicity.toxicity(docs, labels).where("not toxic").orderBy("doc_id").collect()]
    near = brute_near(rows)
    rows = [r for r in rows if near[r[0]][2]]
    cut = brute_cut([(t or "").encode() for _, t in rows])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    left = {d: t for (d, _), t in zip(rows, cut) if not brute_contamination(t, items)[1]}
    lib = Tokenizer.from_str(bpe.default_vocabulary(spark))
    want = {}
    for d, t in left.items():
        ids = lib.encode(t, add_special_tokens=False).ids
        want[d] = (len(ids), sha256_hex(" ".join(map(str, ids)).encode()), sha256_hex(lib.decode(ids, skip_special_tokens=False).encode()))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, sf).collect()}
    assert got == want and 0 < len(got) < docs.count()


def test_stages_on_odd_rows(spark, sf):
    """Null, empty, repeated and very long texts, null ids, columns with the operators' names and without n_chars; empty tables."""
    import corpus_pipeline

    names = ["n_bytes", "items", "toxic", "p_toxic", "spans", "key_a", "others", "n_words", "kept", "class"]
    long = " ".join(f"w{i % 7000}x{i % 11}" for i in range(60_000))
    texts = [None, "", "a text of a few words", "a text of a few words", long, "w1"]
    rows = [(None if i == 1 else min(i, 4), t, *("c" for _ in names)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{c} string" for c in names)).repartition(2)
    left = {"toxicity": 6, "near_dedup": 5, "suffix_dedup": 6, "decontaminate": 6}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        got = out.collect()
        assert len(got) == left[name] and all(r[c] == "c" for r in got for c in names), name
        full = spark.read.parquet(f"{sf}/documents.parquet")
        assert stage(spark, full.limit(0), sf).dtypes == full.dtypes and stage(spark, full.limit(0), sf).count() == 0, name
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, docs, sf).count() == 6 and last(spark, docs.limit(0), sf).count() == 0
