"""Decontamination, ranked search and clustering against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from marketlens.llm import cluster, decontaminate, lexical
from tests.llm.conftest import ODD, docs

ITEMS = "item_id long, text string, key long, digest string, w string, n int"
lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def items(spark, texts, ids=None):
    """A benchmark table with extra columns whose names clash with internal ones."""
    ids = range(100, 100 + len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, 1, "d", "w", 3) for i, t in zip(ids, texts)], ITEMS)


def rows_of(df):
    return [tuple(r) for r in df.collect()]


# ---------------------------------------------------------------- op11

def clean_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(lower))


def hits(texts, ids, bench, bench_ids, size=10):
    windows = defaultdict(set)
    for i, t in zip(bench_ids, bench):
        w = clean_words(t)
        n = min(len(w), size)
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k:k + n])].add("" if i is None else str(i))
    out = []
    for i, t in zip(ids, texts):
        w, gone, found = clean_words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k:k + n])) in windows:
                    gone |= set(range(k, k + n))
                    found |= windows[x]
        out.append((i, len(w), len(gone), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(gone)))
    return sorted(out, key=str)


def benchmark_corpus(seed=5):
    rng = random.Random(seed)
    word = lambda: rng.choice(["Alpha", "beta", "GAMMA", "delta", "é", "Ñu", "7", "x1", "the", "of"]) + rng.choice(["", "", "a", "b"])
    bench = [" ".join(word() for _ in range(rng.randint(10, 30))) for _ in range(12)]
    bench += ["", None, "...", "solo", "two words", "Three, short words", bench[0], "the the the the the the the the the the the the"]
    texts = list(ODD)
    for k in range(60):
        body = [word() for _ in range(rng.randint(0, 60))]
        if k % 2:
            w = clean_words(rng.choice(bench[:12]))
            lo = rng.randint(0, max(0, len(w) - 12))
            body[len(body) // 2:len(body) // 2] = w[lo:lo + rng.randint(8, 14)]
        texts.append(rng.choice([" ", ", ", "\n-"]).join(body))
    texts += ["solo", "SOLO two  words", "three short words " * 3, "the " * 40, bench[2] + " " + bench[2], bench[3].upper()]
    return texts, bench


def test_decontamination_brute_force(spark):
    texts, bench = benchmark_corpus()
    texts += texts[:20]
    ids = [None if k % 17 == 0 else k % 50 for k in range(len(texts))]  # null and repeated ids
    names = [None if k == 4 else 200 + k // 2 for k in range(len(bench))]
    want = hits(texts, ids, bench, names)
    got = rows_of(decontaminate.digest(docs(spark, texts, ids), items(spark, bench, names)))
    assert sorted(got, key=str) == want
    assert sum(r[5] for r in want) > 20 and not all(r[5] for r in want)


@pytest.mark.parametrize("window, shingle, block", [(10, 3, 7), (4, 4, 1000), (6, 1, 20)])
def test_decontamination_blocks_and_sizes(spark, window, shingle, block):
    texts, bench = benchmark_corpus(8)
    ids = list(range(len(texts)))
    want = hits(texts, ids, bench[:5], range(5), window)
    rows = decontaminate.decontaminate(docs(spark, texts, ids), items(spark, bench[:5], range(5)), window=window, shingle=shingle, block=block)
    got = [(r.doc_id, r.n_words, r.n_hit, r.n_items, hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r.contaminated) for r in rows.collect()]
    assert sorted(got, key=str) == want


def test_decontamination_intervals_and_empty_tables(spark):
    bench = items(spark, [" ".join(f"w{k}" for k in range(14))], [1])
    text = "a " + " ".join(f"W{k}" for k in range(12)) + " b " + " ".join(f"w{k}" for k in range(4, 14))
    [row] = decontaminate.decontaminate(docs(spark, [text]), bench).collect()
    assert [tuple(x) for x in row.hits] == [(1, 13), (14, 24)] and row["items"] == ["1"] and row.n_hit == 22
    assert decontaminate.digest(docs(spark, [text]).limit(0), bench).collect() == []
    [row] = decontaminate.digest(docs(spark, [text]), bench.limit(0)).collect()
    assert (row.n_words, row.n_hit, row.contaminated) == (24, 0, False)
    # text ids are kept as they are
    [row] = decontaminate.decontaminate(docs(spark, [text]).selectExpr("'x' as name", "text"), bench, id_col="name").collect()
    assert row.name == "x"


def test_decontamination_is_native_and_long_texts(spark):
    words = [f"q{k % 997}" for k in range(60_000)]
    bench = [" ".join(words[30_000:30_010]), "q5 " * 10]
    texts = [" ".join(words), " ".join(words[:29_990])]
    df = decontaminate.digest(docs(spark, texts), items(spark, bench))
    assert sorted(rows_of(df), key=str) == hits(texts, [0, 1], bench, [100, 101])
    assert not re.search("Python|Arrow|Pandas", df._jdf.queryExecution().executedPlan().toString())


# ---------------------------------------------------------------- op12

def terms_of(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(lower))


def ranking(texts, ids, queries, names, top=10):
    counts = [Counter(terms_of(t)) for t in texts]
    n = [sum(c.values()) for c in counts]
    total, docs_ = sum(n), sum(x > 0 for x in n)
    df = Counter(t for c in counts for t in c)
    out = []
    for name, q in {(i, t or ""): 0 for i, t in zip(names, queries)}:
        scores = []
        for i, c, size in zip(ids, counts, n):
            if size:
                m = 100 - 75 + (75 * size * docs_) // total
                s = sum(math.floor(1000 * math.log((2 * docs_ + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in terms_of(q) if c[t])
                if s > 0:
                    scores.append((-s, i is None, i or 0))
        out += [(name, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


def search_corpus(seed=2, n=300):
    rng = random.Random(seed)
    vocabulary = [f"t{int(rng.paretovariate(0.7))}" for _ in range(4000)]
    texts = list(ODD) + [" ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 5, 30, 200]))) for _ in range(n)]
    texts += [texts[30]] * 40  # ties
    queries = [" ".join(rng.choice(vocabulary).upper() for _ in range(rng.randint(1, 25))) for _ in range(25)]
    return texts, queries + ["", None, "?!", "unheard", texts[30], "t1 t1 t1 t2", "t1"]


@pytest.mark.parametrize("block, bucket, seed", [(50_000, 2048, 8192), (40, 16, 30)])
def test_ranking_brute_force(spark, block, bucket, seed):
    texts, queries = search_corpus()
    ids = list(range(len(texts)))
    random.Random(3).shuffle(ids)
    ids[7], ids[9] = None, ids[8]
    want = ranking(texts, ids, queries, range(len(queries)))
    got = lexical.rank_documents(docs(spark, texts, ids).repartition(5), items(spark, queries, range(len(queries))), block=block, bucket=bucket, seed=seed)
    assert sorted(rows_of(got.select("item_id", "rank", "doc_id", "score")), key=str) == want
    assert len(want) > 200


def test_ranking_odd_queries_and_empty_tables(spark):
    df = docs(spark, ["a b c", "a b", None, "a"])
    same = items(spark, ["A", "A", "b", "a"], [1, 1, 1, None])
    got = sorted(rows_of(lexical.digest(df, same)), key=str)
    assert [g[:3] for g in got] == [(1, 1, 1), (1, 1, 3), (1, 2, 0), (1, 2, 1), (1, 3, 0), (None, 1, 3), (None, 2, 1), (None, 3, 0)]
    assert lexical.digest(df.limit(0), same).collect() == [] and lexical.digest(df, same.limit(0)).collect() == []
    assert lexical.digest(docs(spark, [None, "", "?"]), same).collect() == []


def test_buckets_prune_but_lose_nothing():
    """The bounds of one bucket against all scores of that bucket."""
    rng = np.random.default_rng(4)
    weights = rng.integers(1, 9000, 50)
    mask = rng.random((400, 50)) < 0.2
    x = rng.integers(1, 10 ** 6, (400, 50)) * mask
    length = np.sqrt((weights * x.astype(float) ** 2).sum(1))
    term = np.sort(rng.choice(50, 12, replace=False))
    q = lexical.Queries(np.zeros(12, np.int64), term, rng.integers(1, 3, 12), weights, 1)
    score = (x[:, term] * q.q).sum(1)
    for floor in (1, int(np.sort(score)[-30]), int(score.max()), int(score.max()) + 1):
        best = lexical.Best(np.array([floor]), 500)
        lexical.search_bucket(q, best, np.nonzero(mask)[1], x[mask], np.r_[0, mask.sum(1).cumsum()], length, np.zeros(400, bool), np.arange(400))
        got = dict(zip(best.rows[0][2], best.rows[0][0])) if 0 in best.rows else {}
        assert got == {k: s for k, s in enumerate(score) if s >= floor}


def test_impacts_beyond_64_bits():
    got = lexical.impact(np.array([3]), np.array([10 ** 9]), 10 ** 12, 10 ** 15)
    assert got[0] == (3 * 10 ** 9) // (3000 + 8 * (25 + 75 * 10 ** 21 // 10 ** 15))


# ---------------------------------------------------------------- op13

def kmeans(vectors, k=40, rounds=5, scale=256):
    """[(id, components)] -> rows of the contract, by plain integers."""
    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in vectors
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"2:{i}".encode()).hexdigest()
    chosen = sorted(kept, key=lambda r: (r[0] is None, name(r[0])))[:k]
    c = np.array([v for _, v in chosen], dtype=object).reshape(-1, 64)
    v = np.array([v for _, v in kept], dtype=object).reshape(-1, 64)
    for turn in range(rounds + 1):
        d = np.array([((v - x) ** 2).sum(1) for x in c]).T
        best = d.argmin(1) if len(v) else np.zeros(0, int)
        if turn < rounds:
            c = np.array([[int(t) // int((best == j).sum()) for t in v[best == j].sum(0)] if (best == j).any() else list(c[j]) for j in range(len(c))], dtype=object)
    own = [int(d[j, b]) for j, b in enumerate(best)]
    inertia = {b: sum(o for o, x in zip(own, best) if x == b) for b in best}
    sha = [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in c]
    return sorted([(i, int(b), o, inertia[b], sum(own), sha[b]) for (i, _), b, o in zip(kept, best, own)], key=str)


VECTORS = "vec_id long, embedding array<float>, label int, id long, key long, cluster string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 2, "c") for i, v in rows], VECTORS)


def cloud(n, centres=6, spread=0.02, seed=1, scale=1.0):
    rng = np.random.default_rng(seed)
    mid = rng.normal(0, 0.3, (centres, 64))
    return [(k, [float(np.float32(x)) for x in scale * (mid[k % centres] + rng.normal(0, spread, 64))]) for k in range(n)]


ODD_VECTORS = [(900, None), (901, []), (902, [1.0] * 63), (903, [1.0] * 65), (904, [float("nan")] + [0.0] * 63),
               (905, [float("inf")] + [0.0] * 63), (906, [None] + [0.0] * 63), (None, [0.5] * 64), (None, [0.25] * 64), (907, [0.0] * 64)]


@pytest.mark.parametrize("n, spread, scale", [(700, 0.02, 1.0), (300, 0.3, 1.0), (200, 0.1, 30000.0)])
def test_clustering_brute_force(spark, n, spread, scale):
    rows = cloud(n, spread=spread, scale=scale) + ODD_VECTORS + [(5000 + k, [0.125] * 64) for k in range(60)]
    got = rows_of(cluster.digest(vectors(spark, rows).repartition(4)))
    assert sorted(got, key=str) == kmeans(rows)


def test_clustering_few_repeated_and_no_vectors(spark):
    rows = cloud(7) + cloud(7) + [(3, [0.5] * 64)]
    assert sorted(rows_of(cluster.digest(vectors(spark, rows))), key=str)[0][4] == kmeans(rows)[0][4]
    assert cluster.digest(vectors(spark, [])).collect() == []
    assert cluster.digest(vectors(spark, ODD_VECTORS[:7])).collect() == []


def test_zone_maps_exclude_no_nearest_centroid():
    rng = np.random.default_rng(9)
    centroids = rng.integers(-80, 80, (40, 64))
    some = 0
    for spread in (1, 10, 60):
        v = rng.integers(-80, 80, 64) + rng.integers(-spread, spread + 1, (200, 64))
        near = cluster.candidates(v.min(0), v.max(0), centroids)
        d = ((v[:, None, :] - centroids) ** 2).sum(2)
        assert set(d.argmin(1)) <= set(near)
        best, distance = cluster.nearest(v, centroids[near])
        assert (near[best] == d.argmin(1)).all() and (distance == d.min(1)).all()
        some += near.size < 40
    assert some


def test_hilbert_curve_visits_neighbours():
    """All cells once, each one step from the one before."""
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(np.meshgrid(*[np.arange(1 << bits)] * dims)).reshape(dims, -1).T
        key = cluster.hilbert(cells, bits)
        assert sorted(key) == list(range(len(cells)))
        path = cells[np.argsort(key)]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_large_components_stay_exact():
    rng = np.random.default_rng(3)
    v, c = rng.integers(-(1 << 27), 1 << 27, (50, 64)), rng.integers(-(1 << 27), 1 << 27, (9, 64))
    exact = [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, y)) for y in c] for x in v]
    best, distance = cluster.nearest(v, c)
    assert [int(x) for x in distance] == [min(r) for r in exact] and list(best) == [r.index(min(r)) for r in exact]
