"""Toxicity by a classifier chain: one linear model per category, each fed the categories before it.

Features are the words of a text and their beginnings (3 to 6 letters), present or not; those that
tell the categories apart best on the labelled rows are kept, at most ``FEATURES``.  The models of
the chain are logistic; model k sees the features and the probabilities of categories 1 to k - 1.
When a later model is trained, those probabilities are out-of-fold predictions, so that it doesn't
learn from probabilities better than it will get: each fold's rows are predicted by a model that
was fitted, features chosen included, on the other folds alone.  Folds go by a hash of the id.

The chain is fitted on at most ``SAMPLE`` labelled documents, those with the smallest hash of their id:
a fixed bound, whatever the size of the corpus.  Of documents that share an id one counts, that with
the smallest hash of its text.  Every document is scored, by its whole text.

Defined results: a null or empty text has no features and gets the rate of the models' bias; labels with a
null id or category, or without a document, are left out; labels that repeat an id count once, with
the highest mark; without any labelled rows of both kinds a category's probability is the rate there
is (0 if none, so an empty table of labels calls nothing toxic).  An empty table of documents gives an
empty table.  Repeated rows and ids are scored row by row, alike.  Features of equal score are taken in
the order of their names; p_toxic equal to ``THRESHOLD`` is toxic.  Columns called p_<category> or toxic
are replaced, all others are kept.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import discard, stored
from .text import blocks, mapped

#: Bounds of the fit: labelled rows, features, folds for out-of-fold predictions.
SAMPLE, FEATURES, FOLDS = 16_384, 2_048, 3
#: Lengths of word beginnings.
BEGINNINGS = (3, 4, 5, 6)
#: A feature must be in so many labelled texts.
LEAST_TEXTS = 3
#: Standard errors by which a feature's texts must differ from the base rate.
LEAST_SCORE = 3.0
THRESHOLD = 0.5
#: The fit ends when no entry of the gradient is larger.
LEAST_GRADIENT = 1e-9
#: A task forgets its table of words when it holds so many; results don't depend on it.
WORD_TABLE = 100_000
_WORD = re.compile(r"[^\W\d_]{2,}")


def features_of(word: str) -> list[str]:
    """A word and its beginnings; the word itself ends in a mark."""
    return [word[:k] for k in BEGINNINGS if k <= len(word)] + [word + "$"]


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def _features(text: str | None) -> set[str]:
    return {f for w in words_of(text) for f in features_of(w)}


def logistic(x: list[np.ndarray], extra: np.ndarray, y: np.ndarray, n_features: int, steps: int = 300, l2: float = 1e-3, block: int = 1 << 18) -> np.ndarray:
    """Weights of [features, extra columns, bias] by accelerated gradient descent on rows of feature numbers.

    The step is 1 / L, where L bounds the curvature: a quarter of the weighted sum of the rows' squared norms, and
    the penalty's.  So no step overshoots, and rows in another order change nothing but the last bits.  It ends
    after ``steps``, or when the gradient has all but vanished.  Each step looks at ``block`` feature numbers at
    a time, which bounds what it holds beside the rows.
    """
    n = len(y)
    sizes = np.array([len(r) for r in x])
    ends = np.cumsum(sizes)
    parts, at = [], 0
    while at < n:
        stop = max(int(np.searchsorted(ends, (ends[at - 1] if at else 0) + block, side="right")), at + 1)
        parts.append((at, stop, np.concatenate(x[at:stop]).astype(np.int32), np.repeat(np.arange(stop - at, dtype=np.int32), sizes[at:stop])))
        at = stop
    dense = np.column_stack([extra, np.ones(n)])
    w = np.zeros(n_features + dense.shape[1])
    ahead, last = w.copy(), w.copy()
    # Each text weighs the same within its class; classes weigh the same.
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum()))
    penalty = 10 * l2 / max(1, n)
    rate = 1 / (0.25 * float(weight @ (sizes + (dense**2).sum(axis=1))) + penalty)
    for t in range(1, steps + 1):
        grad = penalty * np.append(ahead[:-1], 0.0)
        for a, b, column, row in parts:
            z = np.bincount(row, ahead[column], b - a) + dense[a:b] @ ahead[n_features:]
            err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[a:b]) * weight[a:b]
            grad[:n_features] += np.bincount(column, err[row], n_features)[:n_features]
            grad[n_features:] += err @ dense[a:b]
        if np.abs(grad).max() < LEAST_GRADIENT:
            break
        w = ahead - rate * grad
        ahead = w + (t - 1) / (t + 2) * (w - last)
        last = w
    return w


def predict(w: np.ndarray, x: list[np.ndarray], extra: np.ndarray, n_features: int) -> np.ndarray:
    z = np.array([w[r].sum() for r in x]) if len(x) else np.zeros(0)
    z = z + np.column_stack([extra, np.ones(len(x))]) @ w[n_features:]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_chain(rows: list[np.ndarray], labels: np.ndarray, fold: np.ndarray, own: np.ndarray) -> list[np.ndarray | float]:
    """One model per column of ``labels``; a float stands for a category that has one value only.

    ``own[0]``: for each category the mask of its features, other weights of its model stay 0;
    ``own[1 + f]``: the same for the models that predict fold f.
    """
    n, n_features = len(rows), own.shape[2]
    models: list[np.ndarray | float] = []
    before = np.zeros((n, 0))
    for k in range(labels.shape[1]):
        y = labels[:, k].astype(float)
        if n == 0 or y.min() == y.max():
            models.append(float(y[0]) if n else 0.0)
            out = np.full(n, models[-1])
        else:
            models.append(logistic([r[own[0, k][r]] for r in rows], before, y, n_features))
            out = np.zeros(n)
            for f in range(len(own) - 1):
                held, rest = np.flatnonzero(fold == f), np.flatnonzero(fold != f)
                if len(held) and len(rest) and 0 < y[rest].sum() < len(rest):
                    x = [r[own[1 + f, k][r]] for r in rows]
                    w = logistic([x[i] for i in rest], before[rest], y[rest], n_features)
                    out[held] = predict(w, [x[i] for i in held], before[held], n_features)
                else:
                    out[held] = y[rest].mean() if len(rest) else y.mean()
        before = np.column_stack([before, out])
    return models


def _sample(docs: DataFrame, labels: DataFrame, categories: dict[str, tuple[str, int, bool]], text: str, doc_id: str, sample: int) -> DataFrame:
    """id, fold, text and y0, y1, ... of at most ``sample`` labelled documents, one row for each id."""
    id_, whole = F.col(f"`{doc_id}`"), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    marks = [F.max((F.col(f"`{c}`") == v).cast("int")).alias(f"y{i}") for i, (c, v, _) in enumerate(categories.values())]
    known = labels.where(id_.isNotNull()).groupBy(id_.alias("id")).agg(*marks).na.drop()
    # Ids without texts: labels that have a document, one row each, before the sample is taken.
    there = docs.where(id_.isNotNull()).groupBy(id_.alias("id")).agg(F.min(F.xxhash64(whole)).alias("own"))
    known = stored(known.join(there, "id").orderBy(F.xxhash64("id"), "id").limit(sample), "labelled")
    # At most ``sample`` short rows: a proven bound for the broadcast.  Rows repeated whole are one.
    rows = docs.select(id_.alias("id"), F.col(f"`{text}`").alias("text"), F.xxhash64(whole).alias("own")).join(F.broadcast(known), ["id", "own"])
    fold = F.pmod(F.xxhash64(F.lit("fold"), F.col("id")), F.lit(FOLDS)).cast("int").alias("fold")
    rows = stored(rows.select(F.col("id").cast("string").alias("id"), fold, "text", *[f"y{i}" for i in range(len(categories))]).dropDuplicates(["id"]), "sample")
    discard(known)
    return rows


def _scores(categories: dict[str, tuple[str, int, bool]], totals: dict[int, list[int]], without: int | None) -> list:
    """For each category how far a feature's texts differ from the base rate, in standard errors, on all folds but one."""
    folds = [f for f in range(FOLDS) if f != without]
    total = lambda i: sum(totals[f][i] for f in folds if f in totals)
    count = lambda i: sum((F.col(f"c{f}_{i}") for f in folds), F.lit(0))
    out = []
    for i, (_, _, against) in enumerate(categories.values()):
        rows, p = total(len(categories)), total(i) / max(1, total(len(categories)))
        if rows and 0 < p < 1:
            n = F.nullif(count(len(categories)), F.lit(0))
            score = (count(i) - n * p) / F.sqrt(n * (p * (1 - p)))
            out.append(F.when(n >= LEAST_TEXTS, F.abs(score) if against else score))
        else:
            out.append(F.lit(0.0))
    return out


def fit_toxicity(docs: DataFrame, labels: DataFrame, categories: dict[str, tuple[str, int, bool]], text: str = "text", doc_id: str = "doc_id", sample: int = SAMPLE):
    """(features, models).  ``categories``, in the order of the chain: name -> (label column, the value that means yes, whether features that speak against it count too)."""
    rows = _sample(docs, labels, categories, text, doc_id, sample)
    n = len(categories)
    counts = [f"c{f}_{i}" for f in range(FOLDS) for i in range(n + 1)]

    def count(batches):
        for batch in batches:
            for part in blocks(batch, 2):
                number: dict[str, int] = {}
                found = [[number.setdefault(f, len(number)) for f in _features(t)] for t in part.column(2).to_pylist()]
                which = np.repeat(np.arange(len(found)), [len(x) for x in found])
                feature = np.array([f for x in found for f in x], np.int64)
                y = np.column_stack([*(c.to_numpy() for c in part.columns[3:]), np.ones(part.num_rows, np.int64)])
                fold = part.column(1).to_numpy()
                table = [np.bincount(feature, y[which, i] * (fold[which] == f), len(number)).astype(np.int64) for f in range(FOLDS) for i in range(n + 1)]
                yield pa.RecordBatch.from_arrays([pa.array(list(number), pa.string()), *map(pa.array, table)], names=["feature", *counts])

    counted = mapped(rows, count, "feature string, " + ", ".join(f"{c} long" for c in counts)).groupBy("feature").agg(*[F.sum(c).alias(c) for c in counts])
    counted = stored(counted.where(sum((F.col(f"c{f}_{n}") for f in range(FOLDS)), F.lit(0)) >= LEAST_TEXTS), "features")
    totals = {r["fold"]: [*r[1:]] for r in rows.groupBy("fold").agg(*[F.sum(f"y{i}") for i in range(n)], F.count("*")).collect()}
    # At most FEATURES names for each choice: that of all rows, then those of all but one fold.
    chosen = [
        [{r[0] for r in counted.where(score >= LEAST_SCORE).orderBy(score.desc(), "feature").limit(FEATURES // n).select("feature").collect()} for score in _scores(categories, totals, f)]
        for f in (None, *range(FOLDS))
    ]
    names = sorted(set().union(*(c for choice in chosen for c in choice)))
    own = np.array([[[f in c for f in names] for c in choice] for choice in chosen], bool).reshape(1 + FOLDS, n, len(names))
    number = {f: i for i, f in enumerate(names)}

    def encode(batches):
        for batch in batches:
            for part in blocks(batch, 2):
                found = [sorted({number[f] for f in _features(t) if f in number}) for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(found, pa.list_(pa.int32())), *part.columns[3:]], names=["id", "fold", "x", *(f"y{i}" for i in range(n))])

    ys = ", ".join(f"y{i} int" for i in range(n))
    # One row for each labelled document of the sample: at most ``sample`` lists of feature numbers.
    data = mapped(rows, encode, f"id string, fold int, x array<int>, {ys}").toArrow().sort_by("id").combine_chunks()
    discard(rows, counted)
    x = [np.asarray(v.values, np.int32) for v in data.column("x")]
    y = np.column_stack([data.column(f"y{i}").to_numpy().astype(np.int64) for i in range(n)])
    fold = data.column("fold").to_numpy()
    del data
    models = fit_chain(x, y, fold, own)
    pa.default_memory_pool().release_unused()
    return names, models


def score_toxicity(docs: DataFrame, features: list[str], models: list, categories: list[str], text: str = "text", keep_text: bool = True) -> DataFrame:
    """Adds p_<category> (double) for each category of the chain."""
    own = [f"p_{c}" for c in categories]
    keep = [c for c in docs.columns if c.lower() not in own]
    docs = docs.select(*[F.col(f"`{c}`") for c in keep])
    sent = docs.sparkSession.sparkContext.broadcast((features, models))
    stay = [i for i, c in enumerate(keep) if keep_text or c != text]
    schema = T.StructType([*(docs.schema.fields[i] for i in stay), *(T.StructField(c, T.DoubleType()) for c in own)])
    at = keep.index(text)

    def run(batches):
        names, models = sent.value
        number = {f: i for i, f in enumerate(names)}
        table: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            for part in blocks(batch, at):
                x = []
                for t in part.column(at).to_pylist():
                    found: set[int] = set()
                    for w in words_of(t):
                        got = table.get(w)
                        if got is None:
                            if len(table) >= WORD_TABLE:
                                table.clear()
                            got = table[w] = tuple([number[f] for f in features_of(w) if f in number])
                        if got:
                            found.update(got)
                    x.append(np.array(sorted(found), np.int64))
                before = np.zeros((len(x), 0))
                for m in models:
                    p = np.full(len(x), m) if isinstance(m, float) else predict(m, x, before, len(names))
                    before = np.column_stack([before, p])
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in stay), *(pa.array(before[:, i]) for i in range(len(own)))], names=[f.name for f in schema.fields])
        table.clear()

    return mapped(docs, run, schema)


#: The categories of the labels table, in chain order.
CATEGORIES = {"low_quality": ("quality", 0, True), "toxic": ("toxic", 1, False)}


def toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", keep_text: bool = True) -> DataFrame:
    """Fits the chain on the labelled rows and adds p_low_quality, p_toxic and toxic (p_toxic >= THRESHOLD)."""
    names, models = fit_toxicity(docs, labels, CATEGORIES, text, doc_id)
    scored = score_toxicity(docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != "toxic" or c == text]), names, models, list(CATEGORIES), text, keep_text)
    return scored.withColumn("toxic", F.col("p_toxic") >= THRESHOLD)
