"""Keyed incremental processing; each function works on a batch, so `foreachBatch` can call it."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from duolog.functions.clean import season, season_label
from duolog.operators.dims import first_per_key
from duolog.operators.quality import require_unique
from duolog.operators.ranges import same
from duolog.sources.scratch import materialize

#: Bits of the filter of incoming keys.
BLOOM_BITS = 1 << 23


def folded_label(c: str) -> Column:
    """Labels match without regard to case; null matches empty."""
    return F.lower(F.coalesce(c, F.lit("")))


def _tag(df: DataFrame, keys: Sequence[str], label: str | None) -> tuple[DataFrame, list[str]]:
    tags = {f"_k{n}": folded_label(k) if k == label else F.col(k) for n, k in enumerate(keys)}
    return df.withColumns(tags), list(tags)


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str], label: str | None = None, order: Sequence[Column] = (), replace: bool = False) -> DataFrame:
    """Rows of updates, and those of target whose key they lack; of a key repeated in updates the first by order stays.
    `label` names a key column compared by `folded_label`; a null in another key column matches null. replace keeps updates only."""
    new, tags = _tag(updates, keys, label)
    new = first_per_key(new, tags, [*order, *[F.col(c) for c in updates.columns]])
    if not replace:
        old, _ = _tag(target, keys, label)
        named = new.select(*[F.col(t).alias(f"_w{n}") for n, t in enumerate(tags)])
        new = old.join(named, same(old, named, {t: f"_w{n}" for n, t in enumerate(tags)}), "left_anti").unionByName(new)
    return new.select(*target.columns)


def replace_by_key(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """All rows of an incoming key are replaced by the incoming rows."""
    return target.join(updates.select(key).distinct(), key, "left_anti").select(*target.columns).unionByName(updates)


def insert_absent(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """target and the incoming rows with new keys, one per key; without keys, distinct rows."""
    if not keys:
        return target.unionByName(incoming).distinct()
    fresh = first_per_key(incoming.join(target, list(keys), "left_anti").select(*target.columns), keys, [F.col(c) for c in target.columns])
    return first_per_key(target, keys, [F.col(c) for c in target.columns]).unionByName(fresh)


def append_keep_first(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Existing and new rows, the first per key: existing before new, then by all columns."""
    both = existing.withColumn("_p", F.lit(0)).unionByName(new.withColumn("_p", F.lit(1)))
    return first_per_key(both, keys, [F.col("_p"), *[F.col(c) for c in existing.columns]]).drop("_p")


def within(df: DataFrame, date: str, start: str, end: str, keys: Sequence[str]) -> DataFrame:
    """Rows of the window, one per key."""
    return first_per_key(df.where(F.col(date).between(F.lit(start).cast("date"), F.lit(end).cast("date"))), keys, [F.col(c) for c in df.columns])


def unloaded(ids: DataFrame, first: DataFrame, second: DataFrame, third: DataFrame, key: str) -> DataFrame:
    """Ids (distinct) and which of two details need loading: `detail` if either of two tables lacks it, `events` if the third does."""
    out = ids.select(key).distinct()
    for n, table in enumerate((first, second, third)):
        out = out.join(table.select(key).distinct().withColumn(f"_h{n}", F.lit(True)), key, "left")
    have = lambda n: F.coalesce(f"_h{n}", F.lit(False))
    return out.select(key, (~have(0) | ~have(1)).alias("detail"), (~have(2)).alias("events")).where("detail or events")


def merge_coalesce(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Full outer merge: the source's value where it has one, else the target's."""
    other = source.toDF(*[c if c == key else f"_s_{c}" for c in source.columns])
    joined = target.join(other, key, "full")
    pick = lambda c: F.coalesce(F.col(f"_s_{c}"), F.col(c)) if f"_s_{c}" in joined.columns else F.col(c)
    return joined.select(*[F.col(c) if c == key else pick(c).alias(c) for c in target.columns])


def watermark(spark: SparkSession, sources: Sequence[tuple[DataFrame, str]], explicit: str | None = None) -> DataFrame:
    """One row: watermark (the first source that has a latest date) and start (the explicit date, else the day after)."""
    found = None
    for df, c in sources:
        one = F.broadcast(df.agg(F.max(F.col(c).cast("date")).alias(f"_w{0 if found is None else len(found.columns)}")))
        found = one if found is None else found.crossJoin(one)
    mark = F.coalesce(*[F.col(c) for c in found.columns])
    return found.select(mark.alias("watermark"), F.coalesce(F.lit(explicit).cast("date"), F.date_add(mark, 1)).alias("start"))


def footer_latest(spark: SparkSession, path: str, column: str) -> DataFrame:
    """One row, `latest`: the largest value of a date or number column of Parquet files, answered from the statistics in their footers, so no
    column is read. Null for files without values. Row groups without statistics make it fail; use an aggregate over the rows there.

    The aggregate is pushed into the scan by Spark's reader of the second version, which the session's settings choose while the plan is made."""
    wanted = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text", "spark.sql.parquet.aggregatePushdown": "true"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        found = spark.read.parquet(path).agg(F.max(column).alias("latest"))
        plan = found._jdf.queryExecution().executedPlan().toString()  # planned here, under these settings
        if "PushedAggregation: [MAX" not in plan:
            raise ValueError(f"the largest {column} can't be told from footers")
        value, kind = found.first().latest, found.schema
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.createDataFrame([(value,)], kind)


def plausible_labels(start: Column, end: Column) -> Column:
    """Labels that games between two dates of one year may have. Regular games are always possible."""
    first, last = F.month(start), F.month(end)
    before = (first <= 10) & (last >= 10) | (first == 9) | (last == 9)
    found = [(before, "Pre Season"), (F.lit(True), "Regular Season"), (last >= 11, "In-Season Tournament"), (last >= 4, "PlayIn"), (last >= 4, "Playoffs")]
    return F.array_compact(F.array(*[F.when(condition, label) for condition, label in found]))


def window_plan(span: DataFrame) -> DataFrame:
    """(start, end) rows -> slices of calendar months by plausible label: from_date, to_date, season, label."""
    months = span.withColumn("_m", F.explode(F.sequence(F.trunc("start", "month"), F.trunc("end", "month"), F.expr("interval 1 month"))))
    slices = months.select(F.greatest("start", "_m").alias("from_date"), F.least("end", F.last_day("_m")).alias("to_date")).where("from_date <= to_date")
    rows = slices.withColumn("label", F.explode(plausible_labels(F.col("from_date"), F.col("to_date"))))
    return rows.withColumn("season", season_label(season(F.col("from_date"), 7, "start")))


def partition_plan(log: DataFrame, date: str, existing: DataFrame, start: str, stop: str, force: bool = False) -> DataFrame:
    """Per season of the calendar from start to stop: its rows in log, status (skipped if the partition exists and is not forced,
    else empty or processed) and last_updated (the season's last day, 30 June, or stop if that is earlier)."""
    spark = log.sparkSession
    year = lambda d: season(F.lit(d).cast("date"), 7, "start")
    calendar = spark.range(1).select(F.explode(F.sequence(year(start), year(stop))).alias("season"))
    rows = log.groupBy(season(F.col(date), 7, "start").alias("season")).agg(F.count("*").alias("n_rows"))
    joined = calendar.join(rows, "season", "left").join(existing.select("season").distinct().withColumn("_old", F.lit(True)), "season", "left")
    n = F.coalesce("n_rows", F.lit(0))
    status = F.when(F.col("_old") & F.lit(not force), "skipped").when(n == 0, "empty").otherwise("processed")
    ends = F.make_date(F.col("season") + 1, F.lit(6), F.lit(30))
    return joined.select("season", season_label(F.col("season")).alias("label"), n.alias("n_rows"), status.alias("status"), F.least(ends, F.lit(stop).cast("date")).alias("last_updated"))


def append_counts(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row on `append_keep_first`: final_rows, and added_rows (never below 0, though repeats among existing rows go)."""
    before = existing.agg(F.count("*").alias("_n"))
    after = append_keep_first(existing, new, keys).agg(F.count("*").alias("final_rows"))
    return after.crossJoin(F.broadcast(before)).select(F.greatest(F.col("final_rows") - F.col("_n"), F.lit(0)).alias("added_rows"), "final_rows")


def stamped(updates: DataFrame, column: str = "updated_at") -> DataFrame:
    """updates with the time of the run."""
    return updates.withColumn(column, F.current_timestamp())


def _bucket(keys: Sequence[str], label: str | None, buckets: int) -> Column:
    """Bucket of a key: a hash of its columns, the label without case."""
    return F.pmod(F.xxhash64(*[folded_label(k) if k == label else F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def _write_version(df: DataFrame, folder: str, keys: Sequence[str], label: str | None, buckets: int) -> str:
    """df as a new version with a folder per bucket. Rows are rebalanced by bucket: small ones share a task, large ones are split."""
    path = f"{folder}/version={uuid.uuid4().hex}"
    df.withColumn("_bucket", _bucket(keys, label, buckets)).hint("rebalance", "_bucket").write.partitionBy("_bucket").parquet(path)
    return path


def _point(spark: SparkSession, folder: str, state: dict) -> None:
    """Add a pointer: which version holds each bucket. Pointers are only ever added, and a file appears whole, so that readers find the old
    state or the new one, never a part of it."""
    line = f"{time.time_ns():020d} {json.dumps(state)}"
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(f"{folder}/current")


def _state(spark: SparkSession, folder: str) -> dict:
    return json.loads(spark.read.text(f"{folder}/current").agg(F.max("value")).first()[0].partition(" ")[2])


def _bucket_files(spark: SparkSession, state: dict, some: Sequence[int] | None = None) -> DataFrame:
    """Rows of the buckets (all by default), each read from the version that holds it; buckets that hold none are not read."""
    schema = StructType.fromJson(state["schema"])
    by_version: dict[str, list[int]] = {}
    for b, v in state["at"].items():
        if some is None or int(b) in some:
            by_version.setdefault(v, []).append(int(b))
    rows = spark.createDataFrame([], schema)
    for version, held in by_version.items():
        stored = spark.read.schema(StructType([*schema.fields, StructField("_bucket", IntegerType())])).parquet(version)
        rows = rows.unionByName(stored.where(F.col("_bucket").isin(held)).select(*schema.names))
    return rows


def _held(spark: SparkSession, path: str) -> list[int]:
    """Buckets that a version has rows in; at most as many as there are buckets."""
    return [r[0] for r in spark.read.parquet(path).select("_bucket").distinct().collect()]


def require_unique_keys(df: DataFrame, incoming: DataFrame, keys: Sequence[str], label: str | None = None) -> None:
    """An error if a key of incoming repeats in df. A Bloom filter of the incoming keys, one bit array of fixed size per task's share of hashes, combined before
    it is sent, turns most rows of df away while they are scanned; only rows that pass meet the keys themselves."""
    old, tags = _tag(df, keys, label)
    new, _ = _tag(incoming, keys, label)
    hashes = [F.pmod(F.xxhash64(F.lit(k), *tags), F.lit(BLOOM_BITS)) for k in range(2)]
    bits = new.select(F.explode(F.array(*hashes)).alias("_h")).groupBy(F.bitmap_bucket_number("_h").alias("_n")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_h")).alias("_b"))
    table = F.broadcast(bits.groupBy().agg(F.map_from_entries(F.collect_list(F.struct("_n", "_b"))).alias("_m")))  # BLOOM_BITS / 8 bytes at most
    rows = old.select(*tags).crossJoin(table)
    for h in hashes:
        byte = F.substring(F.col("_m")[F.bitmap_bucket_number(h)], (F.floor(F.bitmap_bit_position(h) / 8) + 1).cast("int"), F.lit(1))
        value = F.conv(F.hex(byte), 16, 10).cast("int")
        rows = rows.where(F.coalesce(F.bit_get(value, (F.bitmap_bit_position(h) % 8).cast("int")) == 1, F.lit(False)))
    met = rows.select(*tags).join(new.select(*tags).distinct(), tags, "left_semi")
    if not met.groupBy(*tags).count().where("count > 1").isEmpty():
        raise ValueError(f"repeated keys in {', '.join(keys)}")


def publish(df: DataFrame, folder: str, keys: Sequence[str], label: str | None = None, buckets: int = 64) -> str:
    """Write df as a new version of a table, one folder per bucket of its keys, check that no key repeats, then add a pointer to it, see `_point`.
    Returns the version's path. `upsert_published` changes such a table."""
    spark = df.sparkSession
    path = _write_version(df, folder, keys, label, buckets)
    state = {"schema": df.schema.jsonValue(), "buckets": buckets, "keys": list(keys), "label": label, "at": {b: path for b in _held(spark, path)}}
    tagged, tags = _tag(_bucket_files(spark, state), keys, label)
    require_unique(tagged, tags)
    _point(spark, folder, state)
    return path


def current(spark: SparkSession, folder: str) -> DataFrame:
    """The table that the last pointer describes."""
    return _bucket_files(spark, _state(spark, folder))


def current_of(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """Rows of a published table whose keys are in wanted, null matching null; only the buckets of those keys are read."""
    state = _state(spark, folder)
    keys, label = state["keys"], state["label"]
    some = [r[0] for r in wanted.select(_bucket(keys, label, state["buckets"])).distinct().collect()]  # at most the number of buckets
    rows, _ = _tag(_bucket_files(spark, state, some), keys, label)
    asked, tags = _tag(wanted, keys, label)
    named = asked.select(*[F.col(t).alias(f"_w{n}") for n, t in enumerate(tags)])
    return rows.join(named, same(rows, named, {t: f"_w{n}" for n, t in enumerate(tags)}), "left_semi").drop(*tags)


def upsert_published(spark: SparkSession, folder: str, updates: DataFrame, order: Sequence[Column] = (), replace: bool = False) -> list[int]:
    """`upsert` into a published table, of touched buckets only: those that hold a key of updates are read, merged and written as a new version, their
    keys checked (`require_unique_keys`), and a pointer to the new files and the old ones of all other buckets is added. Returns the buckets.

    updates is stored first, so it is computed once. An update without rows changes nothing. Failing leaves the old state."""
    state = _state(spark, folder)
    keys, label = state["keys"], state["label"]
    names = [f["name"] for f in state["schema"]["fields"]]
    new, tags = _tag(updates.select(*names), keys, label)
    new = materialize(first_per_key(new, tags, [*order, *[F.col(c) for c in names]]).select(*names))
    touched = sorted(r[0] for r in new.select(_bucket(keys, label, state["buckets"])).distinct().collect())  # at most the number of buckets
    if not touched:
        return []
    old = _bucket_files(spark, state, touched)
    path = _write_version(upsert(old, new, keys, label, order, replace), folder, keys, label, state["buckets"])
    at = {int(b): v for b, v in state["at"].items() if int(b) not in touched} | {b: path for b in _held(spark, path)}
    state["at"] = at
    require_unique_keys(_bucket_files(spark, state, touched), new, keys, label)
    _point(spark, folder, state)
    return touched


def upsert_stream(source: DataFrame, folder: str, checkpoint: str, keys: Sequence[str], order: Sequence[Column] = ()):
    """Apply a stream of updates to the published table, batch by batch, until the source is exhausted."""

    def apply(batch: DataFrame, _: int) -> None:
        upsert_published(batch.sparkSession, folder, batch, order)

    return source.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
