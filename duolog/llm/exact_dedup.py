"""Exact deduplication by skew-safe combining."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from duolog.llm._scratch import fresh, materialize

#: Characters that do not count when texts are compared.
BLANKS = r"[\x20\x09-\x0D]+"
_WIDE = Decimal(2**64)
_TOP = Decimal(2**63 - 1)


def normalized(text: Column) -> Column:
    """The text without ASCII white space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, "")


def _packed(text: Column, doc_id: Column) -> Column:
    """Length and id in one number whose maximum is the row that stays: most code points, then smallest id.
    A fixed-width value keeps the combining in a hash aggregate. Null for a null id."""
    length = F.char_length(F.coalesce(text, F.lit(""))).cast("decimal(10,0)")
    whole = length * F.lit(_WIDE).cast("decimal(20,0)") + (F.lit(_TOP).cast("decimal(20,0)") - doc_id.cast("decimal(20,0)"))
    return whole.cast("decimal(38,0)")


def duplicate_groups(docs: DataFrame, salts: int = 16, digest=None) -> DataFrame:
    """(doc_id, text) -> one row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Three combining stages, each with the whole normalised text beside the digest in its key, so that
    contents and not digests decide: rows of a task are combined before any shuffle (the partial
    aggregate), digest groups are merged under a salt that comes from the task's number, and only
    the salts' winners meet. No stage gathers members. Verdicts return to the rows by a join on the
    digest, in which Spark can split a hot digest; digests that more than one content shares (only
    possible with a weaker `digest` function than the default SHA-256) join on the content as well.

    Null text is empty; empty texts are one group. A row with a null id counts in its group and is
    kept only if no row of the group has an id (keep_id is then null). Rows that repeat id and text
    get the same verdict, see `deduplicated`. An empty table gives no rows. Only doc_id and text
    are read; other columns may have any names.
    """
    digest = digest or (lambda c: F.unhex(F.sha2(c, 256)))
    rows = docs.select("doc_id", "text").withColumn("_norm", normalized(F.col("text")))
    rows = rows.select("doc_id", "_norm", digest(F.col("_norm")).alias("_digest"), _packed(F.col("text"), F.col("doc_id")).alias("_best"))
    salted = rows.withColumn("_salt", F.spark_partition_id() % salts)
    totals = (F.max("_best").alias("_best"), F.sum("_n").alias("_n"))
    local = salted.withColumn("_n", F.lit(1).cast("bigint")).groupBy("_digest", "_norm", "_salt").agg(*totals)
    groups = local.groupBy("_digest", "_norm").agg(*totals)
    verdict = groups.select(
        "_digest",
        F.unhex(F.sha2("_norm", 256)).alias("_sha"),
        F.when(F.col("_best").isNotNull(), F.lit(_TOP).cast("decimal(20,0)") - F.col("_best") % F.lit(_WIDE)).cast("bigint").alias("keep_id"),
        F.col("_n").alias("group_size"),
    )
    verdict = materialize(verdict)
    shared = verdict.groupBy("_digest").count().where("count > 1").select("_digest")
    keyed = rows.select("doc_id", "_digest", F.lit(None).cast("binary").alias("_sha"))
    on = ["_digest"]
    if not shared.isEmpty():
        keyed = rows.select("doc_id", "_digest", F.unhex(F.sha2("_norm", 256)).alias("_sha"))
        on = ["_digest", "_sha"]
    out = keyed.select("doc_id", *on).join(verdict, on)
    return out.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("doc_id").isNull() & F.col("keep_id").isNull()).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """docs without copies, all columns kept: per group the row that `duplicate_groups` keeps. Of rows that
    repeat its id and normalised text one stays, the longest. The join and the choice share one partitioning by id and digest.

    Null texts are empty; of empty texts one stays. A group whose ids are all null keeps one row. An empty table gives no
    rows. docs may have columns of any other names; those used on the way are chosen apart from them."""
    sha, row = fresh(docs, "_sha", "_row")
    kept = duplicate_groups(docs).where("kept").select("doc_id", F.col("text_sha256").alias(sha)).distinct()
    tagged = docs.withColumn(sha, F.sha2(normalized(F.col("text")), 256))
    named = tagged.where("doc_id is not null").join(kept.where("doc_id is not null").hint("merge"), ["doc_id", sha], "left_semi")
    nameless = tagged.where("doc_id is null").join(kept.where("doc_id is null").select(sha).hint("merge"), sha, "left_semi")
    by_length = [F.char_length("text").desc_nulls_last(), F.col("text")]
    one = lambda df, *keys: df.withColumn(row, F.row_number().over(Window.partitionBy(*keys).orderBy(*by_length))).where(F.col(row) == 1).select(*docs.columns)
    return one(named, "doc_id", sha).unionByName(one(nameless, sha))


ORACLE = r"""
with d as (
  select doc_id, coalesce(text, '') as t,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm
  from documents),
w as (
  select *, count(*) over (partition by norm) as group_size,
    first_value(doc_id) over (partition by norm order by length(t) desc, doc_id) as keep_id
  from d)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(norm) as text_sha256 from w
"""
