import hashlib
import re

from pyspark.sql import functions as F

from duolog.llm.exact_dedup import deduplicated, duplicate_groups

SCHEMA = "doc_id long, text string, keep_id string, group_size string, _digest string"


def brute(docs):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    out = []
    for d, t in docs:
        group = [(x, u or "") for x, u in docs if norm(u) == norm(t)]
        keep = min(group, key=lambda g: (-len(g[1]), g[0]))[0]
        out.append((d, keep, len(group), d == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out)


def test_ties_nulls_blanks_long_texts_and_clashing_names(spark, rows):
    docs = [(5, "a b"), (3, "ab"), (4, "a  b"), (9, "a\t\nb"), (1, None), (2, ""), (7, " \x0b\x0c"), (8, "é x"), (10, "éx"), (11, "y " * 60000), (12, "y" * 60000)]
    df = spark.createDataFrame([(d, t, "k", "g", "d") for d, t in docs], SCHEMA).repartition(5)
    assert rows(duplicate_groups(df)) == sorted(brute(docs), key=repr)


def test_weak_digest_does_not_merge_contents(spark, rows):
    docs = [(k, t) for k, t in enumerate(["a", "b", "a ", "c", "c", "d"])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    weak = duplicate_groups(df, salts=2, digest=lambda c: F.lit("same").cast("binary"))
    assert rows(weak) == sorted(brute(docs), key=repr)


def test_hot_group(spark):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "copy").otherwise(F.col("id").cast("string")).alias("text"))
    got = duplicate_groups(df).where("group_size > 1").agg(F.count("*").alias("n"), F.count_if("kept").alias("kept")).first()
    assert (got.n, got.kept) == (1667, 1)


def test_filter_keeps_columns_and_one_of_repeated_rows(spark, rows):
    df = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "y"), (2, "ab", "z"), (None, "c", "n"), (None, "c", "m")], "doc_id long, text string, source string")
    got = deduplicated(df)
    assert got.columns == df.columns
    assert sorted((r.doc_id or 0, r.text) for r in got.collect()) == [(0, "c"), (1, "a b")]
    assert duplicate_groups(df.limit(0)).count() == 0 and deduplicated(df.limit(0)).count() == 0
