"""Cleaning expressions: blanks, tolerant casts, ids, labels, seasons. All built-in functions."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Raw label -> vocabulary.
LABELS = {
    "preseason": "Pre Season",
    "pre season": "Pre Season",
    "pre-season": "Pre Season",
    "all-star": "All-Star",
    "all star": "All-Star",
    "allstar": "All-Star",
    "play-in": "PlayIn",
    "play in": "PlayIn",
    "play-in tournament": "PlayIn",
    "play in tournament": "PlayIn",
    "playin": "PlayIn",
    "regular season": "Regular Season",
    "playoffs": "Playoffs",
}
# Label of a fetched log -> vocabulary.
FETCHED_LABELS = {
    "regular season": "Regular Season",
    "pre season": "Pre Season",
    "preseason": "Pre Season",
    "playin": "PlayIn",
    "play-in": "PlayIn",
    "playoffs": "Playoffs",
    "post season": "Playoffs",
    "in season tournament": "In-Season Tournament",
    "in-season tournament": "In-Season Tournament",
}
# Id prefixes that are in use.
KNOWN_PREFIXES = ("001", "002", "003", "004", "005")
# Label by the id's first three digits.
PREFIX_LABELS = {1: "Pre Season", 2: "Regular Season", 4: "Playoffs"}


def blank_to_null(c: Column) -> Column:
    """Trimmed text; null where nothing is left."""
    return F.nullif(F.trim(c.cast("string")), F.lit(""))


def tolerant(c: Column, kind: str) -> Column:
    """Cast that gives null where it can't. Integers accept decimals and round half away from zero."""
    text = F.nullif(c.cast("string"), F.lit(""))
    if kind in ("int", "bigint"):
        value = text.try_cast("double")
        return F.when(~F.isnan(value), F.round(value)).try_cast(kind)
    return text.try_cast(kind)


def padded_id(c: Column, width: int = 10) -> Column:
    """Digits of an id, zero-padded; longer text is cut to width."""
    return F.lpad(c.cast("string"), width, "0")


def digits_id(c: Column, width: int = 10) -> Column:
    """The first run of digits, zero-padded; null without digits."""
    return F.lpad(F.nullif(F.regexp_extract(c.cast("string"), r"(\d+)", 1), F.lit("")), width, "0")


def known_prefix(c: Column, prefixes: Sequence[str] = KNOWN_PREFIXES) -> Column:
    return F.coalesce(F.substring(c, 1, 3).isin(*prefixes), F.lit(False))


def canonical_label(c: Column, labels: Mapping[str, str] = LABELS) -> Column:
    """Vocabulary label of a raw one; the raw label where it is unknown."""
    known = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return F.coalesce(known[F.lower(c)], c)


def fetched_label(c: Column) -> Column:
    """Vocabulary label of a fetched one, blanks around it aside; the label as it is where it is unknown."""
    known = F.create_map(*[F.lit(x) for pair in FETCHED_LABELS.items() for x in pair])
    return F.coalesce(known[F.lower(F.trim(c))], c)


def keep_known_ids(df: DataFrame, column: str, prefixes: Sequence[str] = KNOWN_PREFIXES) -> DataFrame:
    """df with the column as digits, padded with zeros to ten (longer ids stay whole); rows whose id has no known prefix go."""
    digits = F.coalesce(F.regexp_extract(F.col(column).cast("string"), r"(\d+)", 1), F.lit(""))
    padded = F.when(F.length(digits) < 10, F.lpad(digits, 10, "0")).otherwise(digits)
    return df.withColumn(column, padded).where(F.substring(column, 1, 3).isin(*prefixes))


def prefix_label(label: Column, padded: Column) -> Column:
    """The label, or the one that the id's prefix stands for."""
    known = F.create_map(*[F.lit(x) for pair in PREFIX_LABELS.items() for x in pair])
    return F.coalesce(label, known[F.substring(padded, 1, 3).try_cast("int")])


def season(date: Column, cut_month: int = 8, by: str = "end") -> Column:
    """Season of a date: named by the year it ends in (by="end") or starts in (by="start"); a new one begins in cut_month."""
    late = F.when(F.month(date) >= cut_month, 1).otherwise(0)
    return F.year(date) + late - (0 if by == "end" else 1)


def season_label(start_year: Column) -> Column:
    """2024 -> 2024-25."""
    return F.concat(start_year.cast("string"), F.lit("-"), F.lpad(((start_year + 1) % 100).cast("string"), 2, "0"))


def clock_minutes(c: Column) -> Column:
    """MM:SS, or a plain number, in minutes."""
    parts = F.split(c, ":")
    clock = F.get(parts, F.lit(0)).try_cast("double") + F.get(parts, F.lit(1)).try_cast("double") / 60.0
    return F.when(F.instr(c, ":") > 0, clock).otherwise(c.try_cast("double"))


def sanitized(names: Sequence[str]) -> list[str]:
    """Lower-case names of letters, digits and underscores."""
    return [re.sub(r"_+", "_", re.sub(r"[^0-9a-z]+", "_", n.strip().lower())).strip("_") for n in names]


def align(df: DataFrame, target: StructType) -> DataFrame:
    """df with the target's columns, order and types: names are sanitised, missing columns are null, others go."""
    named = df.toDF(*sanitized(df.columns))
    cast = lambda f: tolerant(F.col(f.name), f.dataType.simpleString()) if f.name in named.columns else F.lit(None).cast(f.dataType)
    return named.select(*[cast(f).alias(f.name) for f in target])
