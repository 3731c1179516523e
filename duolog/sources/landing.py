"""Landed files and payloads: CSV, JSON result sets, season partitions."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from duolog.functions.clean import align
from duolog.operators.reshape import unpivot_sides
from duolog.sources.scratch import materialize


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV with a header and a given schema; lines that don't fit are dropped."""
    return spark.read.schema(schema).option("header", True).option("mode", "DROPMALFORMED").csv(path)


# Kinds that a column's text may have, narrow ones first, with the pattern of their values.
KINDS = {
    "boolean": "(?i)^(true|false)$",
    "bigint": "^[+-]?[0-9]{1,18}$",
    "double": "^[+-]?([0-9]{1,18}([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$",
    "date": "^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "timestamp_ntz": "^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?)?$",
}


def inferred_types(rows: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """The narrowest kind that all values of each text column have, string where there is none or no value. What values may be are
    bits that "and" combines: tasks send one number a column, whatever the rows, and two files' answers give that of both."""
    value = lambda c: F.trim(F.col(f"`{c}`"))
    fits = lambda c, n, kind, pattern: F.when(value(c).rlike(pattern) & value(c).try_cast(kind).isNotNull(), 1 << n).otherwise(0)
    bits = {c: sum((fits(c, n, k, p) for n, (k, p) in enumerate(KINDS.items())), F.lit(0)) for c in columns}
    one = rows.agg(*[F.bit_and(F.when(F.col(f"`{c}`").isNotNull(), b)).alias(f"_{n}") for n, (c, b) in enumerate(bits.items())]).first()
    return {c: next((k for m, k in enumerate(KINDS) if (one[n] or 0) >> m & 1), "string") for n, c in enumerate(columns)}


@dataclass
class Landed:
    """Typed tables by name, and rejected lines: source, file, line, reason."""

    tables: dict[str, DataFrame]
    rejects: DataFrame


def _source(path: Column) -> Column:
    """Name of a file's source: that of the file `name.csv`, or of the folder of that name, in small letters, digits and underscores."""
    return F.regexp_replace(F.lower(F.regexp_extract(F.url_decode(path), r"([^/]+)\.csv", 1)), "[^0-9a-z]+", "_")


def read_tables(spark: SparkSession, folder: str) -> Landed:
    """All CSV files of a folder and its subfolders as typed tables, one per source (see `load_summary`). Every file has a header of its own; files of
    one source are united by column name, columns that a file lacks are null there.

    Headers come from one pass over the lines, types from one pass over each source's rows (`inferred_types`). Lines that have not the
    header's number of fields are kept apart with file and reason, and no value of theirs is used; quoted line ends are not supported. Blank lines go. Empty fields are
    null, text that is no value of an inferred kind can't occur. Empty column names become column1 and so on, repeated ones get a number. A folder without CSV files gives no tables."""
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv*").text(folder)
    first = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("n"), "value").where("at = 0")
    heads = first.groupBy("file").agg(F.min_by("value", "n").alias("header")).select(_source(F.col("file")).alias("source"), "file", "header").collect()  # a row a file
    groups: dict[tuple[str, tuple[str, ...]], list[str]] = {}
    for r in sorted(heads):
        names: list[str] = []
        for n, name in enumerate(next(csv.reader([r.header]), []), 1):
            name = name.strip().removeprefix("\ufeff") or f"column{n}"
            names.append(name if name.lower() not in map(str.lower, names) else f"{name}_{n}")
        path = re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(r.file))  # a plain path, not a pattern
        groups.setdefault((r.source, tuple(names)), []).append(path)
    parts: dict[str, DataFrame] = {}
    rejects = spark.createDataFrame([], "source string, file string, line string, reason string")
    for (source, names), files in groups.items():
        schema = StructType([StructField(n, StringType()) for n in (*names, "_bad_line")])
        read = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad_line").option("escape", '"').csv(files)
        rows = materialize(read.withColumn("_file", F.col("_metadata.file_path")))
        bad = rows.where("_bad_line is not null")
        rejects = rejects.unionByName(bad.select(F.lit(source).alias("source"), F.col("_file").alias("file"), F.col("_bad_line").alias("line"), F.lit(f"not {len(names)} fields").alias("reason")))
        good = rows.where("_bad_line is null").drop("_bad_line", "_file")
        parts[source] = parts[source].unionByName(good, allowMissingColumns=True) if source in parts else good
    tables = {}
    for source, rows in parts.items():
        kinds = inferred_types(rows, rows.columns)
        tables[source] = rows.select(*[F.col(f"`{c}`") if k == "string" else F.trim(F.col(f"`{c}`")).cast(k).alias(c) for c, k in kinds.items()])
    return Landed(tables, rejects)


def load_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per source of a CSV folder and its subfolders: source, n. A source is a file `name.csv`, or a folder of that name with all
    its files; its name is in small letters, digits and underscores."""
    lines = spark.read.option("recursiveFileLookup", True).option("header", True).csv(folder)
    return lines.groupBy(_source(F.col("_metadata.file_path")).alias("source")).agg(F.count("*").alias("n"))


def result_set(payloads: DataFrame, column: str, name: str, keep: Sequence[str] = ()) -> DataFrame:
    """Rows of the named result set in JSON payloads {"resultSets": [{"name", "headers", "rowSet"}]}: each a map of lower-case
    header to text. Unreadable payloads give no rows."""
    kind = "struct<resultSets: array<struct<name: string, headers: array<string>, rowSet: array<array<string>>>>>"
    sets = payloads.select(*keep, F.explode(F.from_json(column, kind)["resultSets"]).alias("_s")).where(F.col("_s.name") == name)
    rows = sets.select(*keep, F.transform("_s.headers", lambda h: F.lower(h)).alias("_h"), F.explode("_s.rowSet").alias("_v"))
    return rows.where(F.size("_h") == F.size("_v")).select(*keep, F.map_from_arrays("_h", "_v").alias("row"))


#: Inputs that a user may not have.
EXTERNAL = "season int, player_id int, " + ", ".join(f"{c} double" for c in ("odarko", "o_lebron", "o_drip", "o_bpm", "o_la3rapm", "ddarko", "d_lebron", "d_drip", "d_bpm", "d_la3rapm"))
BIO = "player_id int, height_inches double"
VERSATILITY = "season int, player_id int, versatility double"


def optional(spark: SparkSession, df: DataFrame | None, schema: str) -> DataFrame:
    """df with the columns and types of an optional input, or an empty frame of that schema where there is none."""
    kind = StructType.fromDDL(schema)
    return spark.createDataFrame([], kind) if df is None else align(df, kind)


def exists(spark: SparkSession, folder: str) -> bool:
    """Whether a path is there, in whatever file system Spark reads it from."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(path)


def write_seasons(df: DataFrame, folder: str, season: str = "season", order: Sequence[str] = (), force: bool = False) -> None:
    """Partition by season, in row order within files. Seasons that exist are left alone unless forced; others never change.
    Rows are dealt by ranges of season and order, so a large season is written by several tasks."""
    spark = df.sparkSession
    if not force and exists(spark, folder):
        df = df.join(spark.read.parquet(folder).select(season).distinct(), season, "left_anti")
    dealt = df.repartitionByRange(season, *order).sortWithinPartitions(season, *order)
    dealt.write.partitionBy(season).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(folder)


# Columns of a bootstrapped log in order.
LOG = (
    "season_id string, team_id string, team_abbreviation string, team_name string, game_id string, game_date date, matchup string, wl string, min double, fgm double, fga double, fg_pct double, "
    "fg3m double, fg3a double, fg3_pct double, ftm double, fta double, ft_pct double, oreb double, dreb double, reb double, ast double, stl double, blk double, tov double, pf double, pts double, "
    "plus_minus double, video_available int, season_type string"
)


def bootstrap_log(wide: DataFrame) -> DataFrame:
    """One row per side of wide text games, in the columns and types of LOG: results in capitals, missing labels regular, missing
    flags 0, numbers that can't be read null. Rows without date, team or game go; rows are in order of those."""
    fields = StructType.fromDDL(LOG).fields
    base = ["season_id", "game_id", "game_date", "season_type", "min"]
    long = unpivot_sides(wide, [c for c in base if c in wide.columns], [f.name for f in fields if f.name not in base])
    text = lambda name: F.trim(F.col(name).cast("string")) if name in long.columns else F.lit(None).cast("string")
    kinds = {"string": text, "double": lambda n: text(n).try_cast("double"), "date": lambda n: text(n).try_cast("date"), "int": lambda n: F.coalesce(text(n).try_cast("double").cast("int"), F.lit(0))}
    special = {"wl": F.upper(text("wl")), "season_type": F.coalesce(F.col("season_type").cast("string") if "season_type" in long.columns else F.lit(None), F.lit("Regular Season"))}
    rows = long.select(*[special.get(f.name, kinds[f.dataType.simpleString()](f.name)).alias(f.name) for f in fields])
    return rows.where("game_date is not null and team_id is not null and game_id is not null").orderBy("game_date", "game_id", "team_id")
