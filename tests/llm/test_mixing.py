import random
import re
from fractions import Fraction

from pyspark.sql import functions as F

from duolog.llm import mixing


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes, weights=(3, 1, 2), share=Fraction(3, 2), epochs=2):
    """Target of each source, by clamping and sharing anew."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, free, left = {}, set(names), share * sum(sizes.values())
    while free:
        level = Fraction(left) / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > epochs * sizes[s]}
        if not over:
            return target | {s: weight[s] * level for s in free}
        for s in over:
            target[s] = Fraction(epochs * sizes[s])
            left -= target[s]
        free -= over
    return target


def corpus(rng, n=900):
    text = lambda: rng.choice([None, "", " \t", "a b", "a  b\nc d", " ".join("w" * rng.randrange(1, 4) for _ in range(rng.randrange(60)))])
    source = lambda: rng.choice(["hot"] * 9 + ["a", "B", "é", "\U0001f600", "￿", None, "", "tiny"])
    rows = [(rng.choice([k, k, k, None]), source(), text()) for k in range(n)]
    return rows + [(7, "copies", "x y z")] * 60 + [(5000, "long", "word " * 20000)]


def check(docs, got, **options):
    sizes, taken = {}, {}
    for _, s, t in docs:
        sizes[s] = sizes.get(s, 0) + words(t)
    want = targets(sizes, **options)
    epochs = options.get("epochs", 2)
    assert len(got) == len(docs)
    assert sorted((repr(d), repr(s), words(t)) for d, s, t in docs) == sorted((repr(r.doc_id), repr(r.source), r.size) for r in got)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - float(want[r.source])) <= 1e-9 * max(1, r.target)
        assert r.taken == r.size * r.repetitions <= epochs * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s in sizes:
        largest = max(words(t) for _, x, t in docs if x == s)
        assert abs(taken[s] - want[s]) <= largest / 2 + 1e-6
        assert max(r.repetitions for r in got if r.source == s and r.size or 1) - min([r.repetitions for r in got if r.source == s and r.size], default=0) <= 1 or not sizes[s]


def test_targets_and_sample_equal_plain_water_filling(spark):
    rng = random.Random(12)
    for n in (900, 40):
        docs = corpus(rng, n)
        df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, source string, text string, target string")
        got = mixing.repetitions(df.repartition(7)).collect()
        check(docs, got)
        again = mixing.repetitions(df.repartition(3, "source")).collect()
        assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_other_weights_caps_and_shares(spark):
    docs = corpus(random.Random(5), 200)
    df = spark.createDataFrame(docs, "doc_id long, source string, text string")
    check(docs, mixing.repetitions(df, weights=(1, 50), share="1/3", epochs=1).collect(), weights=(1, 50), share=Fraction(1, 3), epochs=1)
    all_capped = mixing.repetitions(df, share=9, epochs=3).collect()
    assert all(r.taken == 3 * r.size and r.target == 3 * r.source_size for r in all_capped)


def test_empty_tables_and_sources_without_words(spark):
    empty = spark.createDataFrame([], "doc_id long, source string, text string")
    assert mixing.repetitions(empty).count() == 0 and mixing.mixture(empty).count() == 0
    none = spark.createDataFrame([(1, None, None), (2, "a", " ")], "doc_id long, source string, text string")
    assert {(r.size, r.source_size, r.target, r.taken) for r in mixing.repetitions(none).collect()} == {(0, 0, 0.0, 0)}


def test_mixture_repeats_whole_rows(spark):
    docs = corpus(random.Random(8), 150)
    df = spark.createDataFrame([(*d, k) for k, d in enumerate(docs)], "doc_id long, source string, text string, epoch int").repartition(4)
    found = mixing.mixture(df)
    assert found.columns == ["doc_id", "source", "text", "epoch", "epoch_"]
    plan = sorted((repr(r.doc_id), repr(r.source), r.size, r.repetitions) for r in mixing.repetitions(df).where("repetitions > 0").collect())
    rows = found.groupBy("epoch", "doc_id", "source", "text").agg(F.count("*").alias("n"), F.max("epoch_").alias("last")).collect()
    assert sorted((repr(r.doc_id), repr(r.source), words(r.text), r.n) for r in rows) == plan and all(r.last == r.n - 1 for r in rows)


def test_many_sources_are_joined_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(mixing, "FEW_SOURCES", 3)
    docs = corpus(random.Random(9), 100)
    check(docs, mixing.repetitions(spark.createDataFrame(docs, "doc_id long, source string, text string")).collect())
