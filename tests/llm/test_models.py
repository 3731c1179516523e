import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from duolog.llm import language_id, quality, toxicity

DATA = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
ODD = [(-1, None), (-2, ""), (-3, " \n\t"), (-4, "12 34 !!"), (-5, "a"), (None, "word"), (-6, "lorem ipsum " * 40000), (-6, "lorem ipsum " * 40000)]


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    odd = spark.createDataFrame([(d, t, None, "s", 0) for d, t in ODD], docs.schema)
    return docs.unionByName(odd), spark.read.parquet(f"{DATA}/labels.parquet")


def held(found, labels, label):
    truth = {r.doc_id: r[label] for r in labels.collect()}
    rows = [(r.score, truth[r.doc_id]) for r in found if r.held_out and r.doc_id in truth]
    ones, zeros = ([s for s, y in rows if y == k] for k in (1, 0))
    return np.mean([(s > z) + 0.5 * (s == z) for s in ones for z in zeros])


@pytest.mark.parametrize(("module", "label", "modulus", "fold", "least"), [(quality, "quality", 3, 1, 0.97), (toxicity, "toxic", 5, 0, 0.85)])
def test_held_out_auc_and_edges(tables, module, label, modulus, fold, least):
    docs, labels = tables
    found = module.scored(docs, labels).collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode() if r.doc_id is not None else b"") % modulus == fold) for r in found)
    assert held(found, labels, label) >= least


@pytest.mark.parametrize("module", [quality, toxicity])
def test_no_labels_give_a_constant(tables, module):
    docs, labels = tables
    few = docs.limit(20)
    assert len({r.score for r in module.scored(few, labels.limit(0)).collect()}) == 1
    assert module.scored(docs.limit(0), labels).count() == 0


def test_filters_keep_columns(tables):
    docs, labels = tables
    named = docs.withColumnRenamed("n_chars", "score").limit(200)
    for keep in (quality.good_documents, toxicity.clean_documents):
        kept = keep(named, labels)
        assert kept.columns == named.columns and kept.subtract(named).count() == 0 and kept.count() > 0


def test_flat_trees_equal_recursion():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2000, 5))
    model = quality.fit_trees(x, (x[:, 0] * x[:, 1] > 0).astype(float))

    def walk(k, row):
        while model.left[k] != k:
            k = model.left[k] if row[model.feature[k]] <= model.cut[k] else model.right[k]
        return model.value[k]

    raw = [model.base + sum(walk(r, row) for r in model.roots) for row in x[:50]]
    assert np.allclose(model.scores(x[:50]), 1 / (1 + np.exp(-np.array(raw))))
    assert ((model.scores(x) > 0.5) == (x[:, 0] * x[:, 1] > 0)).mean() > 0.9


def test_block_max_search_is_exact():
    rng = random.Random(9)
    words = [f"term{c}{i}" for c in "abc" for i in range(40)]
    texts = pa.array([" ".join(rng.choices(words, k=rng.randrange(1, 30))) for _ in range(400)])
    lookup = toxicity.Lookup(np.unique(toxicity._terms(pa.array([" ".join(words)]))[1]))
    rows, terms, counts = lookup.counts(texts)
    idf = np.log(401 / (np.bincount(terms, minlength=len(lookup.terms)) + 1)) + 1
    index = toxicity.Index(lookup, idf, rows, terms, counts, np.zeros(400), np.arange(400))
    rows, terms, weight = index.unit(rows, terms, counts, 400)
    dense = np.zeros((400, len(idf)))
    dense[rows, terms] = weight
    cosine = dense @ dense.T
    start = index.start(rows, terms, weight, 400)
    assert 0 < len(index.matrix) < len(idf)
    for i in range(0, 400, 7):
        at = rows == i
        ids, found = index.nearest(terms[at], weight[at], start[i], 15)
        assert np.allclose(np.sort(cosine[i])[::-1][:15], found) and np.allclose(cosine[i][index.ids[ids]], found)
        ids, found = index.nearest(terms[at], weight[at], start[i], 15, i)
        assert i not in index.ids[ids] and np.allclose(np.sort(np.delete(cosine[i], i))[::-1][:15], found)


def test_toxicity_equals_dense_cosine_over_whole_texts(tables):
    """Words, frequencies, weights, neighbours and votes anew, without the index."""
    docs, labels = tables
    docs = docs.where("doc_id between 0 and 499")
    found = {r.doc_id: r for r in toxicity.scored(docs, labels).collect()}
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    mark = {r.doc_id: r.toxic for r in labels.collect() if r.doc_id in text}
    learn = sorted(d for d in mark if zlib.crc32(str(d).encode()) % 5)

    def terms(t):
        out = Counter()
        for w in re.findall(rb"[0-9A-Za-z\x80-\xff]+", t.encode()):
            w = bytes(c + 32 if 65 <= c <= 90 else c for c in w)
            out[w] += 1
            if len(w) > 6:
                out[b"<" + w[:6]] += 1
        return out

    bags = {d: terms(t) for d, t in text.items()}
    df = Counter(w for b in bags.values() for w in b)
    seen, ones = Counter(w for d in learn for w in bags[d]), Counter(w for d in learn if mark[d] for w in bags[d])
    rate = sum(mark[d] for d in learn) / len(learn)
    names = {w: k for k, w in enumerate(seen)}
    factor = np.array([(math.log((len(text) + 1) / (df[w] + 1)) + 1) * (0.1 + 0.9 * min(1, max(0, ((ones[w] - n * rate) / math.sqrt(n * rate * (1 - rate)) - 3) / 5))) for w, n in seen.items()])
    ids = sorted(text)
    dense = np.zeros((len(ids), len(names)))
    for k, d in enumerate(ids):
        for w, n in bags[d].items():
            if w in names:
                dense[k, names[w]] = (1 + math.log(n)) * factor[names[w]]
    dense /= np.maximum(np.sqrt((dense**2).sum(1, keepdims=True)), 1e-300)
    at = [ids.index(d) for d in learn]
    cosine = dense @ dense[at].T
    pairs = []
    for k, d in enumerate(ids):
        best = np.sort(cosine[k])[::-1][:15]
        best = best[best > 1e-12]
        mine = [cosine[k, learn.index(e)] for e in found[d].evidence]
        assert np.allclose(best, mine)
        if len(mine):
            w = 1 / (1.02 - np.minimum(best, 1))
            pairs.append((float((w * [mark[e] for e in found[d].evidence]).sum() / w.sum()), found[d].score))
    assert len(pairs) > 400
    pairs.sort()
    assert all(a[1] <= b[1] + 1e-9 for a, b in zip(pairs, pairs[1:]))  # scores follow votes


def test_repeated_ids_are_combined_before_they_reach_the_driver(tables, spark):
    docs, labels = tables
    few = docs.where("doc_id between 0 and 300")
    known = labels.where("doc_id < 300").first().doc_id
    many = few.unionByName(few.where(F.col("doc_id") == known).crossJoin(spark.range(3000)).drop("id"))
    for module, label in ((quality, "quality"), (toxicity, "toxic")):
        sample = quality.labelled_sample(many, labels, label, 3, 5, 1000)
        assert sample.where(F.col("doc_id") == known).count() == 1
        assert module.scored(many, labels).count() == many.count()
    one = lambda df: {r.doc_id: round(r.score, 9) for r in quality.scored(df, labels).collect()}
    assert one(many) == one(few)


def test_clashing_columns(tables, spark):
    docs, labels = tables
    few = docs.where("doc_id between 0 and 300").withColumns({c: F.lit("x") for c in ("y", "_id", "score", "held_out", "predicted", "terms", "lang_pred", "s", "log_chars")})
    for module in (quality, toxicity):
        assert module.scored(few, labels).count() == few.count()
    assert language_id.identified(few).count() == few.count()


def test_languages(tables, spark):
    docs, _ = tables
    found = {(r.doc_id, r.lang_pred, r.score, r.held_out) for r in language_id.identified(docs).collect()}
    odd = {d: (p, s) for d, p, s, _ in found if d is None or d < 0}
    assert [odd[k] for k in (-1, -2, -3, -4)] == [("und", 0.0)] * 4 and odd[-5][0] != "und"
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = [(p, truth[d]) for d, p, _, h in found if h and d is not None and d >= 0]
    assert np.mean([p == t for p, t in rows]) > 0.97
    empty = language_id.identified(docs.limit(0))
    assert empty.count() == 0
