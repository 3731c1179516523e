import random
import re
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from duolog.llm import ngram_join
from duolog.llm.ngram_join import distinct_documents, divide_skip, near_duplicates


def shingles(text):
    w = [x.translate({i: i + 32 for i in range(65, 91)}) for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(docs):
    sets, root = [shingles(t) for _, t in docs], list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(docs, sets))), key=repr)


def test_random_edits_chains_and_passages(spark, rows):
    rng = random.Random(7)
    word = lambda: rng.choice("abcdefghij") + rng.choice("klmnopqrst") + str(rng.randrange(40))
    passage = " ".join(word() for _ in range(60))
    docs, k = [], 0
    for _ in range(25):
        base = [word() for _ in range(rng.randrange(5, 150))]
        for _ in range(rng.randrange(1, 12)):
            base = list(base)
            for _ in range(rng.randrange(0, 3)):
                at = rng.randrange(len(base))
                base[at : at + rng.randrange(0, 2)] = [word()]
            text = " ".join(base) + (" " + passage if rng.random() < 0.3 else "")
            docs.append((1000 - k, text.upper() if rng.random() < 0.2 else text))
            k += 1
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert rows(near_duplicates(df)) == brute(docs)


def test_two_letter_words_and_their_complements_stay_apart(spark, rows):
    order = lambda n, letters: "".join(letters[i.bit_count() % 2] for i in range(n))
    docs = [(k, w) for k, w in enumerate(t.format(order(n, letters)) for n in (64, 1024, 2048, 4096) for t in ("{}", "one two {} three four five") for letters in ("ab", "ba"))]
    docs.append((99, docs[-1][1]))
    assert rows(near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))) == brute(docs)


def test_nulls_empty_short_long_repeats_and_clashing_names(spark, rows):
    long = " ".join(f"w{i % 977}x{i}" for i in range(30000))
    docs = [(4, None), (3, ""), (2, " \t\n"), (9, "One two"), (8, "one  TWO"), (7, "one two three"), (6, long), (5, long + " tail"), (1, "a a a a a a a a"), (0, "a a a a a")]
    df = spark.createDataFrame([(d, t, "c", "n", "t") for d, t in docs], "doc_id long, text string, cls string, n string, token string")
    assert rows(near_duplicates(df)) == brute(docs)
    again = [*docs, docs[3], docs[6]]
    df = spark.createDataFrame([(d, t) for d, t in again], "doc_id long, text string")
    assert rows(near_duplicates(df)) == brute(again)
    assert near_duplicates(df.limit(0)).count() == 0
    kept = distinct_documents(df.where("doc_id <> 9 or doc_id is null"))
    assert kept.columns == df.columns and {5, 0, 7, 8} <= {r.doc_id for r in kept.select("doc_id").collect()}


def test_divide_skip_counts_like_sets():
    rng = np.random.default_rng(3)
    for _ in range(60):
        query = np.unique(rng.integers(0, 400, rng.integers(1, 120)).astype(np.uint64))
        sets = []
        for _ in range(rng.integers(0, 30)):
            part = query[rng.random(len(query)) < rng.random()]
            sets.append(np.unique(np.concatenate([part, rng.integers(0, 400, rng.integers(0, 40)).astype(np.uint64)])))
        need = [int(rng.integers(1, max(2, len(query)))) for _ in sets]
        want = [n if (n := len(np.intersect1d(query, s))) >= k else -1 for s, k in zip(sets, need)]
        assert divide_skip(query, sets, need) == want


def test_long_lists_are_only_probed(monkeypatch):
    made = []
    monkeypatch.setattr(ngram_join, "merged_lists", lambda lists, real=ngram_join.merged_lists: made.append(sum(map(len, lists))) or real(lists))
    query = np.arange(0, 2000, 2, dtype=np.uint64)
    near = [np.delete(query, range(k, k + 20)) for k in range(0, 400, 4)]
    far = [np.concatenate([query[k : k + 100], np.arange(5001 + k, 5801 + k, dtype=np.uint64)]) for k in range(300, 700, 4)]
    need = [ngram_join._need(len(query), len(s), 80) for s in near + far]
    found = divide_skip(query, near + far, need)
    assert found == [980] * 100 + [-1] * 100
    assert 0 < made[0] < 0.35 * sum(len(np.intersect1d(query, s)) for s in near + far)


def test_merged_lists_count_members():
    members, times = ngram_join.merged_lists([[1, 5, 9], [5], [2, 5, 9], []])
    assert members.tolist() == [1, 2, 5, 9] and times.tolist() == [1, 1, 3, 2]
    assert [x.tolist() for x in ngram_join.merged_lists([])] == [[], []]


def test_hot_group_of_near_copies(spark):
    base = [f"w{i}" for i in range(150)]
    edit = F.concat(F.lit("edit"), F.col("id").cast("string"))
    words = F.transform(F.array(*[F.lit(w) for w in base]), lambda w, i: F.when(i == F.col("id") % 150, edit).otherwise(w))
    df = spark.range(600).select(F.col("id").alias("doc_id"), F.array_join(words, " ").alias("text"))
    assert [tuple(r) for r in near_duplicates(df).select("component_id").distinct().collect()] == [(0,)]


@pytest.mark.parametrize("light", [ngram_join.LIGHT, 0])
def test_pairs_of_unequal_length_and_at_the_threshold(spark, rows, monkeypatch, light):
    monkeypatch.setattr(ngram_join, "LIGHT", light)  # 0: all lists are dealt by size class
    rng = random.Random(17)
    docs = []
    for k in range(300):
        n = rng.randrange(1, 57) if k % 3 else 4 * rng.randrange(1, 12)
        longer = rng.randrange(1, max(2, n // 4 + 2)) if k % 3 else n // 4  # every third pair is at 0.8 exactly
        base = [f"p{k}w{i}" for i in range(n + 4)]
        more = [f"p{k}e{i}" for i in range(longer)]
        docs += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(base + more if rng.random() < 0.5 else more + base))]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert rows(near_duplicates(df)) == brute(docs)


def test_least_shared_is_a_lower_limit(spark):
    need = lambda n, m: -(-80 * (n + m) // 180) - -(-80 * max(n, m) // 100) + 1
    ranges = [(n, low, min(low + wide, n * 5 // 4)) for n in range(5, 140, 3) for low in range(-(-4 * n // 5), n * 5 // 4 + 1) for wide in (0, 2, 6)]
    df = spark.createDataFrame(ranges, "n long, low long, high long")
    for r in df.selectExpr("*", f"{ngram_join._least_shared(80)} as least").collect():
        assert 1 <= r.least <= max(1, min(need(r.n, m) for m in range(r.low, r.high + 1)))


def test_null_and_repeated_ids(spark, rows):
    text = lambda k, *more: " ".join([*(f"n{k}w{i}" for i in range(30)), *more])
    docs = [(None, text(0)), (None, text(0, "a")), (None, text(0, *"abcde")), (None, text(1)), (None, None), (None, " \n"), (5, None), (5, "")]
    docs += [(7, text(2)), (7, text(2, "a")), (7, text(2, "b")), (7, text(3)), (8, text(3, "a")), (7, text(4)), (7, text(4))]
    docs += [(1, text(5)), (None, text(5, *"abcde")), (2, text(5, *"abcdefghij")), (0, ""), (9, text(6))]
    df = spark.createDataFrame([(d, t, k) for k, (d, t) in enumerate(docs)], "doc_id long, text string, key int").repartition(3)
    sets, group = [shingles(t) for _, t in docs], list(range(len(docs)))
    for _ in docs:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a & b and 100 * len(a & b) >= 80 * len(a | b):
                    group[i] = group[j] = min(group[i], group[j])
    members = [[i for i in range(len(docs)) if group[i] == g] for g in sorted(set(group))]
    name = lambda m: min((docs[i][0] for i in m if docs[i][0] is not None), default=None)
    assert rows(near_duplicates(df)) == sorted(((docs[i][0], len(sets[i]), name(m)) for m in members for i in m), key=repr)
    kept = distinct_documents(df)
    assert kept.columns == df.columns
    found = [r.key for r in kept.collect()]
    assert sorted(group[k] for k in found) == sorted(set(group)) and all(docs[k][0] == name([i for i in range(len(docs)) if group[i] == group[k]]) for k in found)


def test_frequent_shingles_keep_to_their_limit(spark):
    docs = [(k, " ".join(f"{'abcdefgh'[j]}{k % (1 << j)}" for j in range(8))) for k in range(600)]
    df = spark.createDataFrame([(k, t + f" own{k}") for k, t in docs], "doc_id long, text string").coalesce(1)
    token, level = ngram_join.frequent_shingles(df, 1)
    count = {}
    for _, t in docs:
        for w in t.split():
            count[w] = count.get(w, 0) + 1
    assert len(token) == sum(n >= 4 for n in count.values()) and sorted(set(level.tolist())) == sorted({n.bit_length() for n in count.values() if n >= 4})
    few, high = ngram_join.frequent_shingles(df, 1, keep=20)
    assert 0 < len(few) <= 20 and high.min() >= np.sort(level)[-20] and set(few.tolist()) < set(token.tolist())
    assert len(ngram_join.frequent_shingles(df, 1, keep=0)[0]) == 0


def test_a_window_of_shingles_is_counted_without_many_copies():
    held = [np.unique(np.random.default_rng(k).integers(0, 3000 if k % 2 else 2**62, 5000, dtype=np.uint64)) for k in range(200)]
    value, times = np.unique(np.concatenate(held), return_counts=True)
    size = sum(map(len, held)) * 8
    tracemalloc.start()
    found, counts = ngram_join._often(held)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.tolist() == value[times >= 3].tolist() and counts.tolist() == times[times >= 3].tolist() and not held
    assert peak < 2.6 * size
    assert [x.tolist() for x in ngram_join._often([np.zeros(1, np.uint64)])] == [[], []]
