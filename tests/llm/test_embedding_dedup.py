import numpy as np
import pytest

from duolog.llm import embedding_dedup as E


def brute(vectors, threshold=0.9):
    sound = {}
    for k, (_, v) in enumerate(vectors):
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float64)
            sound[k] = x / np.linalg.norm(x)
    root, links = list(range(len(vectors))), [0] * len(vectors)
    for i in sound:
        for j in sound:
            if len(sound[i]) == len(sound[j]) and i != j and sound[i] @ sound[j] >= threshold:
                links[i] += 1
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    least = {r: min(v for k, (v, _) in enumerate(vectors) if root[k] == r) for r in set(root)}
    return sorted((v, links[k], least[root[k]], v == least[root[k]]) for k, (v, _) in enumerate(vectors))


def planted(seed, centres, copies, size=64, noise=0.02):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(centres):
        c = rng.normal(size=size)
        out += [(c / np.linalg.norm(c) + rng.normal(size=size) * noise).astype(np.float32).tolist() for _ in range(rng.integers(1, copies))]
    return [(1000 - k, v) for k, v in enumerate(out)]


def test_links_and_components_equal_brute_force(spark, rows):
    vectors = planted(1, 120, 6)
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").repartition(4)
    assert rows(E.near_duplicates(df)) == sorted(brute(vectors), key=repr)


def test_blocks_of_a_hot_bucket(spark, rows, monkeypatch):
    vectors = planted(2, 2, 90)
    monkeypatch.setattr(E, "BLOCK", 16)
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    assert rows(E.near_duplicates(df)) == sorted(brute(vectors), key=repr)


def test_unusable_copies_and_lengths(spark, rows):
    one = [1.0, 2.0, 3.0]
    vectors = [(1, None), (2, []), (3, [0.0, 0.0, 0.0]), (4, [1.0, None, 2.0]), (5, [float("nan"), 1.0, 1.0]), (6, [float("inf"), 1.0, 1.0]), (7, one), (8, one), (9, [2.0, 4.0, 6.0]), (10, [1.0, 2.0]), (11, [-1.0, -2.0, -3.0]), (12, [1.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in vectors], "vec_id long, embedding array<double>, cls int")
    assert rows(E.near_duplicates(df)) == sorted(brute(vectors), key=repr)
    assert E.near_duplicates(df.limit(0)).count() == 0
    again = E.near_duplicates(df.union(df.where("vec_id = 7"))).where("vec_id = 7").collect()
    assert [(r.n_links, r.component_id) for r in again] == [(3, 7)] * 2


def at_cosine(rng, n, size, low, high):
    a = rng.normal(size=(n, size))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=(n, size))
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    c = rng.uniform(low, high, (n, 1))
    return a, c * a + np.sqrt(1 - c * c) * b


@pytest.mark.parametrize("size", [16, 64, 200])
def test_codes_let_close_pairs_through_and_few_others(size):
    a, b = at_cosine(np.random.default_rng(size), 400, size, 0.9, 0.93)
    x = np.concatenate([a, b])
    i, j = E.close_pairs(x, np.arange(800), None, 0.9 - 1e-9)
    assert len({(p, q) for p, q in zip(i, j) if q == p + 400}) >= 398
    maybe = E.likely(E.encode(x), size, np.arange(400), np.arange(400, 800), 0.9)
    assert maybe.sum() < (0.6 if size == 16 else 0.05) * maybe.size
    f = np.ascontiguousarray(E.encode(x)[:, :4]).view(np.float32)[:, 0]
    assert abs(f - E._turned(x).__abs__().sum(1) / np.sqrt(2 * size * 2)).max() < 1e-5


@pytest.mark.parametrize("size", [16, 64])
def test_recall_end_to_end(spark, size):
    a, b = at_cosine(np.random.default_rng(7), 1500, size, 0.901, 0.92)
    rows = [(k, v.tolist()) for k, v in enumerate(np.concatenate([a, b]))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    found = {r.vec_id: r.component_id for r in E.near_duplicates(df).collect()}
    assert np.mean([found[k] == found[k + 1500] for k in range(1500)]) >= 0.97
    linked = {r.vec_id for r in E.near_duplicates(df).where("n_links > 0").collect()}
    unit = np.concatenate([a, b])
    cosine = unit @ unit.T - 2 * np.eye(3000)
    assert linked <= set(np.flatnonzero((cosine >= 0.9 - 1e-12).any(1)).tolist())


def test_recall_at_the_threshold():
    rng = np.random.default_rng(4)
    a = rng.normal(size=(3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=(3000, 64))
    b -= (a * b).sum(1, keepdims=True) * a
    b = 0.9 * a + np.sqrt(1 - 0.81) * b / np.linalg.norm(b, axis=1, keepdims=True)
    bits, tables = E.tables_for(1_000_000, 0.9)
    met = (E.bucket_keys(a, bits, tables) == E.bucket_keys(b, bits, tables)).any(1).mean()
    assert met >= 0.93
    x = np.concatenate([a[:300], b[:300]])
    i, j = E.close_pairs(x, np.arange(600), None, 0.9 - 1e-9)
    assert len({(p, q) for p, q in zip(i, j) if q == p + 300}) >= 297
