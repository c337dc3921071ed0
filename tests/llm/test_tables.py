"""The operators that compare rows with each other, against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from concord.llm import chunk_dedup, components, kd_shards, near_dedup, queries, skew, suffix_dedup, toxicity, url_filter


def brute_suffix(texts, size=200):
    count = Counter(t[i : i + size] for t in texts for i in range(len(t) - size + 1))
    out = []
    for t in texts:
        mask = bytearray(len(t))
        for i in range(len(t) - size + 1):
            if count[t[i : i + size]] > 1:
                mask[i : i + size] = b"\1" * size
        kept = bytes(b for b, m in zip(t, mask) if not m)
        spans = sum(1 for i in range(len(t)) if mask[i] and not (i and mask[i - 1]))
        out.append((len(t), sum(mask), spans, hashlib.sha256(kept).hexdigest()))
    return out


def passages(seed=3, n=40):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdefgh é\n") for _ in range(900)) for _ in range(4)]
    texts = [None, "", "é" * 150, "a" * 1000, "ab" * 300, "x" * 199, "x" * 200]
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(1, 4)):
            s = rng.randint(0, 600)
            parts += [rng.choice(base)[s : s + rng.randint(100, 300)], "".join(rng.choice("xyz") for _ in range(rng.randint(0, 50)))]
        texts.append("".join(parts))
    return [*texts, base[0], base[0], base[0], base[1]]


@pytest.mark.parametrize("hot", [50_000, 1])
def test_suffix_dedup_against_brute_force(spark, hot):
    texts = passages()
    docs = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, spans string").repartition(5)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.suffix_dedup(docs, hot=hot).collect()}
    assert got == dict(enumerate(brute_suffix([(t or "").encode() for t in texts])))


def test_suffix_dedup_pieces_and_empty(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 97)
    rng = random.Random(8)
    shared = bytes(rng.choice(b"abcd") for _ in range(500))
    raw = np.frombuffer(shared + b"-" + shared, np.uint8)
    a = suffix_dedup.anchors(raw, np.array([0, len(raw)]), 200)
    assert a["n"].sum() == len(raw) - 199 and (a["ahead"] <= 200 - suffix_dedup.SEED + a["n"]).all()
    assert suffix_dedup.suffix_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_multikey_order():
    rng = np.random.default_rng(3)
    rows = rng.integers(0, 2, (500, 40)).astype(np.uint8)
    rows[200:] = rows[rng.integers(0, 20, 300)]
    rows[300:, 17] = 255
    order = suffix_dedup.multikey_order(rows)
    texts = [bytes(r) for r in rows]
    assert [texts[i] for i in order] == sorted(texts)
    want = [0] + [next((k for k in range(40) if a[k] != b[k]), 40) for a, b in zip(sorted(texts), sorted(texts)[1:])]
    assert suffix_dedup.common_prefixes(rows, order).tolist() == want
    assert len(suffix_dedup.multikey_order(rows[:0])) == 0


def test_hot_keys_are_split(spark, monkeypatch):
    from concord.llm import skew

    monkeypatch.setattr(skew, "LEAST_ROWS", 5)
    monkeypatch.setattr(skew, "HOT_KEYS", 4)
    left = spark.createDataFrame([(1, i) for i in range(60)] + [(k, k) for k in range(2, 40)], "k int, v int")
    right = left.groupBy("k").agg(F.count("*").alias("n"), F.first("k").alias("w")).where("k <> 5")
    out = skew.split_join(left, right, ["k"], "n")
    assert "BroadcastHashJoin" in out._jdf.queryExecution().toString()
    assert sorted(map(tuple, out.collect())) == sorted((r.k, r.v, r.k) for r in left.collect() if r.k != 5)


def brute_near(rows):
    sets, posted = [], defaultdict(list)
    for i, (_, t) in enumerate(rows):
        words = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append(set(zip(*[words[k:] for k in range(5)])) if len(words) >= 5 else {tuple(words)} if words else set())
        for x in sets[i]:
            posted[x].append(i)
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in posted[x] if j > i).items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                up[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), d), d)
    return {d: (len(sets[i]), low[find(i)], d == low[find(i)]) for i, (d, _) in enumerate(rows)}


def near_rows(seed=5):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(3000)]
    texts = [None, "", "a b", "A B", "a b c", "  \n", "one two three four five six", "one two three four FIVE six"]
    for _ in range(8):
        base = [rng.choice(vocab) for _ in range(rng.randint(20, 300))]
        for _ in range(rng.randint(1, 30)):
            x = list(base)
            for _ in range(rng.randint(0, int(len(base) * 0.05) + 1)):
                x[rng.randrange(len(x))] = rng.choice(vocab)
            texts.append(" ".join(x))
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_near_dedup_against_brute_force(spark):
    rows = near_rows()
    docs = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, class string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_dedup(docs).collect()}
    assert got == brute_near(rows)


def test_pairs_at_the_limit_collide_often_enough():
    """The stated chances at a similarity of 0.75, and pairs of just that similarity."""
    from math import comb

    chance = lambda n, least: sum(comb(n, k) * 0.75**k * 0.25 ** (n - k) for k in range(least))
    assert chance(near_dedup.COORDINATES, near_dedup.MATCHES) < 3e-8 and chance(near_dedup.FIRST, 2) < 3e-8
    rng = np.random.default_rng(7)
    counts = []
    for _ in range(400):
        shared, a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (300, 50, 50))
        x, y = (near_dedup.signature(np.concatenate((shared, own))) for own in (a, b))
        counts.append(int((x == y).sum()))
    assert min(counts) >= near_dedup.MATCHES and abs(np.mean(counts) / near_dedup.COORDINATES - 0.75) < 0.01


def test_rest_of_pairs_bridges_components(spark, monkeypatch):
    """Without star rounds every link is found by the merge across components, or by none."""
    rows = near_rows(12)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(near_dedup, "STAR_ROUNDS", 0)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_dedup(docs).collect()}
    assert got == brute_near(rows)


def test_near_dedup_nulls_and_repeated_rows(spark):
    t = "one two three four five six seven"
    docs = spark.createDataFrame([(None, t), (4, t), (4, t), (None, None), (None, "alone here with some words")], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in near_dedup.near_dedup(docs).collect())
    assert got == sorted([("None", 3, "4", False), ("4", 3, "4", True), ("4", 3, "4", True), ("None", 0, "None", True), ("None", 1, "None", True)])
    assert near_dedup.near_dedup(docs.limit(0)).count() == 0


def test_drop_near_duplicates_leaves_one_row_of_each_component(spark):
    t, u, v = "one two three four five six seven", "some quite different words of a clean row here", "words of rows that have no id at all"
    rows = [(1, t, "a"), (1, t, "b"), (1, t, "b"), (2, t, "a"), (2, u, "a"), (3, u, "a"), (None, t, "a"), (None, v, "a"), (None, v.upper(), "b"), (5, None, "a"), (5, None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key_a string").repartition(3)
    got = sorted(map(str, map(tuple, near_dedup.drop_near_duplicates(docs).collect())))
    free = [x for x in got if v in x.lower()]
    assert len(free) == 1 and sorted(set(got) - set(free)) == sorted(map(str, {(1, t, "a"), (2, u, "a"), (5, None, "a")})) and len(got) == 5
    assert near_dedup.drop_near_duplicates(docs.limit(0)).count() == 0
    unique = spark.createDataFrame([(1, t), (2, t), (None, t), (4, u)], "doc_id long, text string")
    assert sorted(r.doc_id for r in near_dedup.drop_near_duplicates(unique).collect()) == [1, 4]


INSIDE = ["id", "key_a", "key_b", "class", "component", "spans", "seed", "context", "lo", "n", "ahead", "lead", "runs", "m", "start", "stop", "high", "low", "first", "again", "out", "own", "y0", "fold", "x", "dims", "tie", "block", "hash", "before", "_split", "node", "leaves", "page", "range", "depth", "top", "best", "level", "labels"]


def test_odd_rows_and_clashing_names(spark):
    """Null, empty, repeated and very long texts, null and repeated ids, and columns named as those inside the operators."""
    long = " ".join(f"w{i % 7000}x{i % 11}" for i in range(150_000))
    texts = [None, "", "same text of several words here " * 9, "same text of several words here " * 9, long, long + " end", "w1"]
    rows = [(None if i == 3 else min(i, 5), t, *("c" for _ in INSIDE)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{c} string" for c in INSIDE)).repartition(2)
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (4, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    near = sorted((str(r.doc_id), r.component_id, r.kept) for r in near_dedup.near_dedup(docs).collect())
    assert near == sorted([("0", 0, True), ("1", 1, True), ("2", 2, True), ("None", 2, False), ("4", 4, True), ("5", 4, False), ("5", 5, True)])
    whole = {"op4": lambda d: kd_shards.kd_shards(d, shards=3), "op6": suffix_dedup.suffix_dedup, "op7": chunk_dedup.chunk_dedup, "op9": lambda d: toxicity.toxicity(d, labels)}
    for name, run in whole.items():
        out = run(docs).collect()
        assert len(out) == 7 and all(r[c] == "c" for r in out for c in INSIDE), name
        assert run(docs.limit(0)).count() == 0, name
    cut = {len(r.text): r for r in suffix_dedup.suffix_dedup(docs).collect()}
    assert sorted(cut) == [0, 2, 4] or max(cut) < 200
    dropped = near_dedup.drop_near_duplicates(docs).collect()
    assert len(dropped) == 5 and all(r[c] == "c" for r in dropped for c in INSIDE)
    pages = docs.withColumn("url", F.lit("http://a.example.org/es/1"))
    out = url_filter.filter_urls(pages, url_filter.rule_frame(spark, url_filter.RULES)).collect()
    assert len(out) == 7 and all(r.verdict == "block" and r[c] == "c" for r in out for c in INSIDE)


def test_url_ranges_hand_on_open_rules(spark):
    """One rule around all keys of many ranges, others nested in it across their borders."""
    rules = [("com", "", "block")] + [("com", "/" + "a" * i, "allow" if i % 2 else "block") for i in range(1, 6)]
    urls = [f"http://x{i % 7}.com/{'a' * (i % 8)}{'b' * (i % 3)}{i}" for i in range(400)]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.filter_urls(pages, url_filter.rule_frame(spark, rules), ranges=16).collect()}
    for i, u in enumerate(urls):
        path = u.split(".com", 1)[1]
        best = max((r for r in rules if path.startswith(r[1])), key=lambda r: len(r[1]))
        assert got[i] == (best[0] + best[1], best[2]), u


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 60)] + [(300 + rng.randrange(60), 300 + rng.randrange(60)) for _ in range(50)]
    up = {x: x for e in edges for x in e}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        up[y] = x
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}


def test_url_filter_sweeps_a_common_ancestor_once(spark, monkeypatch):
    """One path on many hosts of one ancestor: ranges of the sweep are about as large as each other, and hosts get the ancestor's rule."""
    n = 4_000
    pages = spark.range(n).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h"), F.col("id").cast("string"), F.lit(".com/")).alias("url")).repartition(4)
    rules = url_filter.rule_frame(spark, [("com", "/", "block"), ("h7.com", "/", "allow"), ("org", "/", "allow")])
    points = url_filter._ancestors(pages.select(url_filter.url_host(F.col("url")).alias("host"), url_filter.url_path(F.col("url")).alias("path")).distinct())
    events = url_filter._events(points, rules)
    assert events.where("step = 0").count() == n + 1  # each host, and their ancestor once
    sizes = [r["count"] for r in events.repartitionByRange(8, "key").groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) <= 2 * sum(sizes) / 8
    for bound in (1_000, 10):  # with the hot key broadcast, and without
        monkeypatch.setattr(skew, "LEAST_ROWS", bound)
        out = url_filter.filter_urls(pages, rules, ranges=8)
        assert {(r.rule, r.verdict): r["count"] for r in out.groupBy("rule", "verdict").count().collect()} == {("com/", "block"): n - 1, ("h7.com/", "allow"): 1}


def test_url_filter_against_sql_and_brute_force(spark, sf):
    want = duckdb.connect()
    want.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    rows = sorted(map(tuple, want.execute(queries.OP3_SQL).fetchall()), key=str)
    assert sorted(map(tuple, queries.op3_url_filter(spark, sf).collect()), key=str) == rows
    rules = [("org", "/", "allow"), ("example.org", "/a", "block"), ("example.org", "/a/b/", "allow"), ("example.org", "/a/b/c", "block"), ("x.example.org", "/", "block"), ("com", "", "block"), ("com", "", "allow")]
    rng = random.Random(9)
    urls = [None, "", "nothing", "http://", "://x", "HTTP://Example.ORG/a/b/c?x://y", "a://com#f", "a://b.com"]
    urls += [f"http://{rng.choice(['', 'x.', 'y.x.', 'w-'])}{rng.choice(['example.org', 'Example.Org', 'com', 'net', 'org'])}{rng.choice(['', '/', '/a', '/a/', '/ab', '/a/b', '/a/b/c', '/a/b/cd?q', '/a/b/#x'])}" for _ in range(200)]
    pages = spark.createDataFrame([(None if i % 7 == 0 else i % 50, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")

    def brute(url):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        best = max(((len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)), default=(0, 0, None, "allow"))
        return host, path, best[2], best[3]

    got = sorted(map(str, ((r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(pages, url_filter.rule_frame(spark, rules)).collect())))
    assert got == sorted(str(brute(u)) for u in urls)
    assert url_filter.filter_urls(pages.limit(0), url_filter.rule_frame(spark, rules)).count() == 0
    assert {r.verdict for r in url_filter.filter_urls(pages, url_filter.rule_frame(spark, [])).collect()} == {"allow"}


@pytest.mark.parametrize("shards", [8, 3])
def test_shards(spark, sf, shards):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(None, None), (None, ""), (1, None)], "doc_id long, text string")).withColumn("dim0", F.lit("x"))
    rows = kd_shards.kd_shards(docs, shards=shards, text="text").collect()
    text = {r.doc_id: r.text for r in docs.where("doc_id is not null and text is not null").collect()}
    assert len(rows) == docs.count() and {r.shard for r in rows} == set(range(shards))
    total, heaviest = sum(r["size"] for r in rows), Counter()
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
        heaviest[r.text_crc32, r["size"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    weights = Counter()
    for r in rows:
        weights[r.shard] += r["size"]
    slack = 3 * max(heaviest.values())
    assert all(abs(w - total / shards) <= slack for w in weights.values()), (weights, slack)
    place = defaultdict(set)
    for r in rows:
        place[r.text_crc32, r["size"]].add(r.shard)
        if r.doc_id in text and r.doc_id != 1:
            assert r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) and r["size"] == len(text[r.doc_id].encode()) + 1
    assert all(len(s) == 1 for s in place.values())
    assert kd_shards.kd_shards(docs.limit(0), shards=4).count() == 0
    assert kd_shards.kd_shards(docs, target_bytes=total // 2).agg(F.max("shard")).first()[0] in (1, 2)


def brute_tree(rows, shards, first=0):
    """rows: (number, dims, tie, weight); the shard of each number, by plain recursion."""
    if shards == 1 or not rows:
        return {r[0]: first for r in rows}
    lows = [min(r[1][i] for r in rows) for i in range(3)]
    widths = [max(r[1][i] for r in rows) - lows[i] for i in range(3)]
    i = widths.index(max(widths))
    key = lambda r: (min(int((r[1][i] - lows[i]) / (widths[i] or 1.0) * 2**24), 2**24 - 1) << 24) + r[2]
    weight = Counter()
    for r in rows:
        weight[key(r)] += r[3]
    aim, below = sum(weight.values()) * (shards // 2) // shards, 0
    for border in sorted(weight):
        if below + weight[border] >= aim:
            break
        below += weight[border]
    if 2 * (aim - below) < weight[border]:
        border -= 1
    sides = [r for r in rows if key(r) <= border], [r for r in rows if key(r) > border]
    return brute_tree(sides[0], shards // 2, first) | brute_tree(sides[1], shards - shards // 2, first + shards // 2)


@pytest.mark.parametrize("shards", [2, 5, 8])
def test_shards_are_those_of_a_recursive_tree(spark, sf, shards):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    measured = docs.select("doc_id", F.array(*kd_shards.dimensions(F.col("text"))), F.shiftrightunsigned(F.xxhash64("text"), 40), F.octet_length("text") + 1)
    want = brute_tree([tuple(r) for r in measured.collect()], shards)
    assert {r.doc_id: r.shard for r in kd_shards.kd_shards(docs, shards=shards).collect()} == want


def brute_chunks(texts):
    """texts: (id, text) with distinct ids."""
    cut, first, times = [], {}, Counter()
    for i, t in texts:
        raw = (t or "").encode()
        h = [sum(int(chunk_dedup._GEAR[raw[j - k]]) << k for k in range(min(32, j + 1))) % 2**32 for j in range(len(raw))]
        r = chunk_dedup.REACH
        ends = [j + 1 for j in range(r, len(raw) - r) if all(h[j] < h[j + d] for d in range(-r, r + 1) if d)] if len(raw) > 2 * r else []
        parts, a = [], 0
        for b in [*ends, len(raw)] if raw else []:
            parts.append((a, raw[a:b]))
            a = b
        cut.append((i, raw, parts))
        for _, p in parts:
            times[p] += 1
            first[p] = min(first.get(p, i), i)
    out = {}
    for i, raw, parts in cut:
        seen, kept, removed, repeated = set(), b"", 0, 0
        for _, p in parts:
            repeated += len(p) * (times[p] > 1)
            if p in seen or first[p] < i:
                removed += len(p)
            else:
                kept += p
            seen.add(p)
        out[i] = len(raw), repeated, removed, hashlib.sha256(kept).hexdigest()
    return out


def test_chunk_dedup_against_brute_force(spark):
    texts = list(enumerate(passages(11, 25)))
    docs = spark.createDataFrame([(*t, 1) for t in texts], "doc_id long, text string, key_a int").repartition(4)
    got = {r.doc_id: (r.n_bytes, r.n_repeated, r.n_removed, r.kept_sha256) for r in chunk_dedup.chunk_dedup(docs).collect()}
    assert got == brute_chunks(texts)
    assert chunk_dedup.chunk_dedup(docs.limit(0)).count() == 0
    named = docs.select(F.format_string("%05d", "doc_id").alias("doc_id"), "text")
    assert {int(r.doc_id): (r.n_bytes, r.n_repeated, r.n_removed, r.kept_sha256) for r in chunk_dedup.chunk_dedup(named).collect()} == got
    nulls = spark.createDataFrame([(None, "q" * 10 + str(i) * 40) for i in (1, 1, 2)], "doc_id long, text string")
    assert chunk_dedup.chunk_dedup(nulls).count() == 3


def test_chunk_dedup_leaves_no_short_chunk(spark):
    """Of an exact copy nothing stays, and a short text that repeats goes as well."""
    rng = random.Random(4)
    long = "".join(rng.choice("abcdefghij klmn") for _ in range(5_000))
    ends = [0, *chunk_dedup.cuts(np.frombuffer(long.encode(), np.uint8)).tolist()]
    sizes = [b - a for a, b in zip(ends, ends[1:])]
    assert min(sizes[:-1]) > chunk_dedup.REACH
    docs = spark.createDataFrame([(1, long), (2, long), (3, "short"), (4, "short"), (5, "alone")], "doc_id long, text string")
    got = {r.doc_id: (r.n_repeated, r.n_removed, r.text) for r in chunk_dedup.chunk_dedup(docs).collect()}
    assert got == {1: (5_000, 0, long), 2: (5_000, 5_000, ""), 3: (5, 0, "short"), 4: (5, 5, ""), 5: (0, 0, "alone")}


def test_chunks_resist_insertions():
    rng = random.Random(1)
    text = bytes(rng.choice(b"abcdefghij klmn") for _ in range(20_000))
    ends = lambda t: set(chunk_dedup.cuts(np.frombuffer(t, np.uint8)).tolist())
    other = text[:9_000] + b"inserted" + text[9_000:]
    shifted = {e + 8 if e > 9_000 else e for e in ends(text)}
    assert len(shifted ^ ends(other)) <= 6


def test_toxicity_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    test = labels.where("doc_id % 4 = 0")
    out = toxicity.toxicity(docs, labels.where("doc_id % 4 <> 0")).drop("text").join(test.withColumnRenamed("toxic", "truth"), "doc_id").groupBy("truth", "toxic").count().collect()
    n = {(r.truth, r.toxic): r["count"] for r in out}
    # Some of the texts labelled toxic are junk without any word of their own.
    assert n[1, True] / (n[1, True] + n.get((1, False), 0)) > 0.9, n
    assert n.get((0, True), 0) / (n[0, False] + n.get((0, True), 0)) < 0.01, n


def brute_chain(texts, ys, fold, scored):
    """Probabilities by the same chain, written out on dense matrices: texts, marks and folds of the labelled rows in order."""
    words = lambda t: set(re.findall(r"[^\W\d_]{2,}", (t or "").lower()))
    feats = lambda t: {f for w in words(t) for f in [w[:k] for k in (3, 4, 5, 6) if k <= len(w)] + [w + "$"]}
    found, n = [feats(t) for t in texts], len(texts)

    def choose(rows, k, against):
        count, hits = Counter(f for i in rows for f in found[i]), Counter(f for i in rows if ys[i][k] for f in found[i])
        p = sum(ys[i][k] for i in rows) / max(1, len(rows))
        score = {f: (hits[f] - c * p) / np.sqrt(c * (p * (1 - p))) for f, c in count.items() if c >= 3}
        score = {f: abs(v) if against else v for f, v in score.items()}
        return [f for f in sorted(score, key=lambda f: (-score[f], f)) if score[f] >= 3][:1024]

    def dense(names, sets):
        return np.array([[f in s for f in names] for s in sets], float).reshape(len(sets), len(names))

    def fit(x, extra, y):
        x = np.column_stack([x, extra, np.ones(len(y))])
        w = ahead = last = np.zeros(x.shape[1])
        weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum()))
        rate = 1 / ((weight @ (x**2).sum(axis=1)) / 4 + 1e-2 / len(y))
        for t in range(1, 301):
            grad = x.T @ ((1 / (1 + np.exp(-np.clip(x @ ahead, -30, 30))) - y) * weight) + 1e-3 * np.append(ahead[:-1], 0) / len(y) * 10
            w = ahead - rate * grad
            ahead = w + (t - 1) / (t + 2) * (w - last)
            last = w
        return w

    def apply(w, x, extra):
        return 1 / (1 + np.exp(-np.clip(np.column_stack([x, extra, np.ones(len(x))]) @ w, -30, 30)))

    before, out = np.zeros((n, 0)), np.zeros((len(scored), 0))
    for k, against in enumerate((True, False)):
        y = np.array([v[k] for v in ys], float)
        names = choose(range(n), k, against)
        w = fit(dense(names, found), before, y)
        out = np.column_stack([out, apply(w, dense(names, [feats(t) for t in scored]), out)])
        held_out = np.zeros(n)
        for f in range(3):
            rest, held = [i for i in range(n) if fold[i] != f], [i for i in range(n) if fold[i] == f]
            names = choose(rest, k, against)
            w = fit(dense(names, [found[i] for i in rest]), before[rest], y[rest])
            held_out[held] = apply(w, dense(names, [found[i] for i in held]), before[held])
        before = np.column_stack([before, held_out])
    return out


def test_toxicity_against_a_plain_chain(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    marks = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 0).cast("int")).alias("a"), F.max((F.col("toxic") == 1).cast("int")).alias("b")).na.drop()
    rows = docs.join(marks, "doc_id").select("doc_id", "text", "a", "b", F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(3)).alias("fold")).collect()
    rows.sort(key=lambda r: str(r.doc_id))
    got = {r.doc_id: (r.p_low_quality, r.p_toxic) for r in toxicity.toxicity(docs, labels).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = brute_chain([r.text for r in rows], [(r.a, r.b) for r in rows], [r.fold for r in rows], list(texts.values()))
    assert np.abs(np.array([got[d] for d in texts]) - want).max() < 1e-6


def test_toxicity_does_not_depend_on_row_order():
    """The same rows in another order: the same weights but for the last bits, whatever number of features a row has."""
    rng = np.random.default_rng(5)
    for n_features, most in ((1, 1), (40, 12), (300, 200)):
        x = [np.sort(rng.choice(n_features, rng.integers(0, min(most, n_features) + 1), replace=False)).astype(np.int32) for _ in range(400)]
        y = np.array([float(len(r) > most / 2) if rng.random() < 0.9 else 1.0 for r in x])
        extra = rng.random((400, 1))
        w = toxicity.logistic(x, extra, y, n_features)
        p = rng.permutation(400)
        again = toxicity.logistic([x[i] for i in p], extra[p], y[p], n_features, block=50)
        assert np.abs(toxicity.predict(w, x, extra, n_features) - toxicity.predict(again, x, extra, n_features)).max() < 1e-9


def test_toxicity_odd_rows(spark):
    docs = spark.createDataFrame([(1, "an idiot"), (2, "a friend"), (None, None), (3, ""), (1, "an idiot")], "doc_id long, text string").withColumn("p_toxic", F.lit(1))
    labels = spark.createDataFrame([(1, 1, 1), (2, 1, 0), (None, 0, 1), (3, None, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity(docs, labels).count() == 5
    assert toxicity.toxicity(docs, labels.limit(0)).where("toxic").count() == 0
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0


def test_toxicity_sample_bounds_what_is_fitted(spark, monkeypatch):
    """An id on many rows counts once, and labels without a document take no place in the sample."""
    fitted = []
    monkeypatch.setattr(toxicity, "fit_chain", lambda x, y, fold, own: fitted.append(y.tolist()) or [0.0] * y.shape[1])
    docs = spark.createDataFrame([(1, f"text {i % 3}") for i in range(60)] + [(i, "a friend") for i in range(2, 7)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i == 1)) for i in range(1, 200)], "doc_id long, quality int, toxic int")
    for sample, n in ((6, 6), (4, 4), (50, 6)):
        toxicity.fit_toxicity(docs, labels, toxicity.CATEGORIES, sample=sample)
        assert len(fitted[-1]) == n
    assert sorted(fitted[-1]) == [[0, 0]] * 5 + [[0, 1]]


def test_toxicity_misses_only_texts_without_a_toxic_word(spark):
    """The ten words are in 113 labelled toxic documents each, or more, and in none of the others."""
    words = {"trash", "pathetic", "idiot", "worthless", "disgusting", "stupid", "clown", "scum", "loser", "moron"}
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    test = labels.where("doc_id % 4 = 0 and toxic = 1").select("doc_id")
    out = toxicity.toxicity(docs.join(labels.select("doc_id").distinct(), "doc_id"), labels.where("doc_id % 4 <> 0")).join(test, "doc_id").collect()
    missed = {r.doc_id: toxicity.words_of(r.text) & words for r in out if not r.toxic}
    assert len(out) > 100 and not any(missed.values()), missed
