"""MinHash classes, centroid clustering and source divergence against SQL and brute force."""

import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from starload.llm import divergence, minhash
from starload.llm.centroids import GREATEST, cluster_vectors, nearest, whole_vectors
from starload.llm.divergence import audit_sources, terms
from starload.llm.minhash import minhash_dedup, shingle_set, sketch
from starload.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_minhash_dedup", "op12_centroid_clustering", "op13_source_divergence"])
def test_queries_equal_their_sql(spark, name):
    rows = QUERIES[name](spark, SF)
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"create view {t} as from '{SF}/{t}.parquet'")
    want = con.sql(f"select {', '.join(rows.columns)} from ({ORACLES[name]})").fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in rows.collect())


# ---------------------------------------------------------------- MinHash

def words_of(text):
    out = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\f\r":
        out = out.replace(c, " ")
    return [w for w in out.split(" ") if w]


def shingles_of(text):
    w = words_of(text)
    return {" ".join(w[i:i + 2]) for i in range(len(w) - 1)} if len(w) > 1 else set(w)


def brute_classes(rows):
    """doc_id, set size and smallest id reachable of every row."""
    sets = [shingles_of(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least.setdefault(find(i), []).append(d)
    ids = {k: min((d for d in v if d is not None), default=None) for k, v in least.items()}
    return sorted(((d, len(sets[i]), ids[find(i)], d == ids[find(i)]) for i, (d, _) in enumerate(rows)), key=str)


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()), key=str)


def near_copies(rng, n, length, changes):
    base = [f"w{rng.randrange(500)}" for _ in range(length)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(changes + 1)):
            copy[rng.randrange(length)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def test_classes_equal_brute_force(spark):
    rng = random.Random(5)
    texts = near_copies(rng, 120, 60, 9) + near_copies(rng, 40, 12, 2) + near_copies(rng, 40, 400, 60)
    texts += [" ".join(f"w{rng.randrange(30)}" for _ in range(rng.randrange(1, 9))) for _ in range(80)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(minhash_dedup(df)) == brute_classes(rows)


def test_crowded_buckets_equal_brute_force(spark, monkeypatch):
    """Blocks smaller than the buckets, and chains of copies that only neighbours link."""
    monkeypatch.setattr(minhash, "SMALL_BUCKET", 2)
    monkeypatch.setattr(minhash, "BLOCK", 8)
    base = [f"w{i}" for i in range(60)]
    chain = [" ".join(base[:i] + [f"y{j}" for j in range(i)] + base[i:]) for i in range(0, 40, 2)]
    rows = list(enumerate(chain + near_copies(random.Random(1), 30, 40, 6)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(minhash_dedup(df)) == brute_classes(rows)


def test_odd_documents(spark):
    long = " ".join(f"v{i}" for i in range(50_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "oNE\x0b"), (6, "é"), (7, "É"), (8, long), (9, long + " end"),
            (3, "another text of the same id here"), (3, "another text of the same id here"), (None, "no id at all here"),
            (None, "lone text that has no id"), (2, "no id at all here"), (12, "a b a b a b"), (13, "a b a")]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "doc_id long, text string, first string, n int, node int")
    got = minhash_dedup(df)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    want = [(d, n, c if n else d, k or (not n)) for d, n, c, k in brute_classes(rows)]
    assert result(got) == sorted(want, key=str)
    assert minhash_dedup(df.limit(0)).collect() == []


def test_table_keys_find_similar_sets():
    """Sets of similarity 0.8 share a table key; unlike ones hardly ever do."""
    rng = np.random.default_rng(3)
    hit = stray = 0
    for _ in range(300):
        a = rng.integers(0, 1 << 63, 90, dtype=np.uint64)
        b = np.concatenate([a[:80], rng.integers(0, 1 << 63, 10, dtype=np.uint64)])
        c = np.concatenate([a[:25], rng.integers(0, 1 << 63, 65, dtype=np.uint64)])
        keys = [[set(side) for side in sketch(np.unique(s))[:2]] for s in (a, b, c)]
        hit += all(x & y for x, y in zip(keys[0], keys[1]))
        stray += all(x & y for x, y in zip(keys[0], keys[2]))
    assert hit >= 299 and stray <= 15


def test_bounds_never_leave_out_similar_sets():
    rng = np.random.default_rng(4)
    for size in (10, 90, 700, 3000):
        a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        b = a[:-(len(a) // 10)]
        tables = [pd.DataFrame({"n": [len(s)], "root": [i], "parity": [sketch(s)[2]]}) for i, s in enumerate((a, b))]
        assert minhash._may_be_similar(*tables).all()
    assert len(shingle_set("x " * 9)) == 1 and len(shingle_set("a b c")) == 2


# ---------------------------------------------------------------- clustering

def brute_clusters(rows, clusters=40, rounds=5):
    """Python integers throughout."""
    kept = [(i, [int(np.floor(256 * float(e))) for e in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(e is not None and np.isfinite(e) for e in v)]

    def drawn(r):
        return (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])

    centroids = [x for _, x in sorted(kept, key=drawn)[:clusters]]

    def assign():
        return [min((sum((p - q) ** 2 for p, q in zip(x, c)), k) for k, c in enumerate(centroids)) for _, x in kept]

    for _ in range(rounds):
        at = assign()
        for k in range(len(centroids)):
            own = [x for (_, x), (_, c) in zip(kept, at) if c == k]
            if own:
                centroids[k] = [sum(col) // len(own) for col in zip(*own)]
    at = assign()
    total, whole = Counter(), sum(d for d, _ in at)
    for d, c in at:
        total[c] += d
    return sorted(((i, c, d, total[c], whole, hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
                   for (i, _), (d, c) in zip(kept, at)), key=str)


def test_clusters_equal_brute_force(spark):
    rng = np.random.default_rng(8)
    heart = rng.normal(0, 0.3, (6, 64))
    rows = [(i, (heart[i % 6] + rng.normal(0, 0.05, 64)).astype(np.float32).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(90)]  # one vector many times
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    got = sorted((tuple(r) for r in cluster_vectors(df).collect()), key=str)
    assert got == brute_clusters(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    v = [0.5, -0.25] * 32
    rows = [(1, v), (1, [-0.001] * 64), (2, None), (3, []), (4, v[:63]), (5, v + [0.0]), (6, [nan] + v[1:]), (7, v[1:] + [inf]),
            (8, [None] + v[1:]), (None, v), (9, [float(GREATEST // 256)] + v[1:]), (10, v), (10, v)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, cluster int, x int")
    got = sorted((tuple(r) for r in cluster_vectors(df).collect()), key=str)
    assert got == brute_clusters(rows) and len(got) == 6
    assert cluster_vectors(df.limit(0)).collect() == [] and cluster_vectors(df.filter("vec_id = 2")).collect() == []
    with pytest.raises(Exception, match="beyond"):
        whole_vectors(spark.createDataFrame([(1, [1e300] * 64)], df.select("vec_id", "embedding").schema)).collect()


@pytest.mark.parametrize("scale,k,d", [(100, 40, 64), (3, 17, 5), (1 << 26, 9, 3), (1, 1, 2)])
def test_threshold_search_equals_brute_force(scale, k, d):
    rng = np.random.default_rng(k)
    centroids = rng.integers(-scale, scale + 1, (k, d))
    x = np.vstack([rng.integers(-scale, scale + 1, (400, d)), centroids, centroids + 1])
    where, best, steps = nearest(x, centroids)
    exact = ((x[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert (where == exact.argmin(axis=1)).all() and (best == exact.min(axis=1)).all()
    assert steps.max() <= 2 * k and (k < 40 or steps.mean() < 10)


def test_walk_stops_before_the_lists_end():
    """On clustered vectors the frontier passes the best distance early."""
    rng = np.random.default_rng(1)
    centroids = rng.integers(-10_000, 10_000, (200, 4))
    x = centroids[rng.integers(0, 200, 500)] + rng.integers(-20, 20, (500, 4))
    assert nearest(x, centroids)[2].mean() < 5


# ---------------------------------------------------------------- divergence

def brute_audit(rows, least, top):
    docs = [(l or "", s or "", t or "") for l, s, t in rows]
    split = [[w.decode() for w in terms(t) if w] for *_, t in docs]
    out = []
    for lang in {l for l, *_ in docs}:
        own = [(s, w) for (l, s, _), w in zip(docs, split) if l == lang]
        df = Counter(t for _, w in own for t in set(w))
        kept = sorted(t for t, n in df.items() if n >= least)
        counts = {s: Counter() for s, _ in own}
        for s, w in own:
            counts[s].update(t for t in w if df[t] >= least)
        counts[None] = sum((counts[s] for s in counts), Counter())
        v = len(kept)
        p = {s: {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * v) for t in kept} for s, c in counts.items()}
        for s in counts:
            if s is None:
                continue
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in counts if o not in (s, None)]
            words = [(p[s][t] - p[None][t], t) for t in kept if counts[s][t] and p[s][t] > p[None][t]]
            for part, found in (("pair", pairs), ("term", words)):
                found = sorted(found, key=lambda f: (-f[0], f[1].encode()))[:top if part == "term" else None]
                out += [(lang, s, part, item, f, r + 1) for r, (f, item) in enumerate(found)]
    return sorted(out)


def audit_rows(seed, n):
    rng = random.Random(seed)
    pool = ["the", "The", "übung", "Übung", "日本", "x1y", "don't", "a-b", "naïve", "z", "k", "ſ"] + [f"t{c}" for c in "abcdefgh"]
    rows = []
    for _ in range(n):
        lang = rng.choice(["en", "de", None, ""])
        source = rng.choice(["s0"] * 10 + [f"s{i}" for i in range(20)] + [None])
        own = pool[rng.randrange(6):][:rng.randrange(1, 14)]
        rows.append((lang, source, " ".join(rng.choice(own) for _ in range(rng.randrange(0, 40)))))
    return rows


def test_audit_equals_brute_force(spark, monkeypatch):
    """Many small cells: three sources by about four terms."""
    monkeypatch.setattr(divergence, "SOURCES", 3)
    monkeypatch.setattr(divergence, "TERMS", 4)
    monkeypatch.setattr(divergence, "HELD", 20)
    rows = audit_rows(2, 400)
    df = spark.createDataFrame(rows, "lang string, source string, text string").repartition(4)
    assert sorted(tuple(r) for r in audit_sources(df, least_documents=10, top=3).collect()) == brute_audit(rows, 10, 3)


def test_audit_of_odd_documents(spark):
    rows = [("en", "a", None), ("en", "a", ""), (None, None, "x"), ("", "", "x"), ("de", "only", "wort wort"), ("en", "b", "x " * 200_000),
            ("en", "c", "123 !?"), ("en", "d", "X\x00x\u0080"), ("fr", "p", "mot"), ("fr", "q", "mot"), ("fr", "q", "mot")]
    df = spark.createDataFrame([(*r, 1, "t") for r in rows], "lang string, source string, text string, n int, term string")
    for least in (1, 2, 30):
        assert sorted(tuple(r) for r in audit_sources(df, least_documents=least).collect()) == brute_audit(rows, least, 50)
    assert audit_sources(df.limit(0)).collect() == []


def test_terms_are_letter_runs():
    text = "Ab1c_é\x7fÉ\u0080Z{`[@ \U0001f600x\x00"
    assert [t for t in terms(text) if t] == [w.encode() for w in ("ab", "c", "é", "É\u0080z", "\U0001f600x")]
    assert [t for t in terms("") if t] == []


def test_probabilities_stay_exact_beyond_longs(spark):
    one = spark.range(1).select(divergence._share(F.lit(10**13), F.lit(10**14), F.lit(10**6)).alias("p")).first()
    assert one.p == 1 + 10**9 * (10**13 + 5) // (10**14 + 5 * 10**6)
