"""Mixing sources to target weights by capped water-filling and seeded sampling of repetitions."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duolog.operators.ranges import numbered, same
from duolog.sources.scratch import fresh, materialize

#: Rows of a table of sources up to which it is broadcast.
FEW_SOURCES = 10_000
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_filled(sources: DataFrame, share: Fraction, epochs: int) -> DataFrame:
    """(weight, source_size) -> the same rows with target: the share of all sizes, divided by weight, but no source gets more
    than `epochs` times its size.

    Sources whose part of what is left exceeds their cap are clamped to it, and what they leave is divided anew among the others by
    weight, until no part exceeds its cap. A source that is clamped stays so, for the level of the others only rises. A round
    brings three sums of the sources to the driver, whatever their number; all are whole numbers, so the result does not depend on the
    order of summing. No sources: no rows."""
    cap = F.col("source_size") * epochs
    whole = lambda c: F.coalesce(F.sum(c.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))
    total = Fraction(int(sources.agg(whole(F.col("source_size"))).first()[0])) * share
    level, clamped = Fraction(0), -1
    while True:
        # clamped: weight * level >= cap, in whole numbers
        held = F.col("weight").cast("decimal(38,0)") * F.lit(str(level.numerator)).cast("decimal(38,0)") >= cap.cast("decimal(38,0)") * F.lit(str(level.denominator)).cast("decimal(38,0)")
        n, full, weight = sources.agg(F.count_if(held), whole(F.when(held, cap)), whole(F.when(~held, F.col("weight")))).first()
        if n == clamped or not weight:
            break
        clamped, level = n, max(Fraction(0), (total - int(full)) / int(weight))
    part = F.col("weight") * F.lit(float(level))
    return sources.withColumn("target", F.when(held, cap.cast("double")).otherwise(F.least(part, cap.cast("double"))))


def _planned(rows: DataFrame, weights: Sequence[int], share: Fraction | str, epochs: int) -> DataFrame:
    """rows (doc_id, source, size, draw, place; stored) with source_size, target, repetitions and taken."""
    sources = materialize(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    ranked = numbered(sources.withColumn("none", F.col("source").isNull()), [], ["none", "source"], {"rank": []})
    turn = F.array(*[F.lit(int(w)) for w in weights])
    ranked = ranked.withColumn("weight", F.element_at(turn, ((F.col("rank") - 1) % len(weights) + 1).cast("int")).cast("long"))
    targets = water_filled(materialize(ranked.select("source", "source_size", "weight")), Fraction(share), epochs)
    base = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(epochs))).otherwise(F.lit(0)).cast("int")
    targets = targets.withColumn("base", base).withColumn("rest", F.col("target") - F.col("base") * F.col("source_size"))
    targets = materialize(targets.select(F.col("source").alias("of"), "source_size", "target", "base", "rest"))
    few = targets.limit(FEW_SOURCES + 1).count() <= FEW_SOURCES

    drawn = numbered(rows, ["source"], ["draw", "size", "doc_id", "place"], {}, {"ahead": (["source"], "size")})
    joined = drawn.join(F.broadcast(targets) if few else targets, same(drawn, targets, {"source": "of"}))
    more = (F.col("ahead") + F.col("size") / 2.0 <= F.col("rest")) & (F.col("size") > 0) & (F.col("base") < epochs)
    out = joined.withColumn("repetitions", F.col("base") + more.cast("int"))
    return out.withColumn("taken", F.col("size") * F.col("repetitions"))


def _drawn(seed: int) -> list[Column]:
    doc_id = F.col("doc_id").cast("long")
    return [doc_id.alias("doc_id"), F.col("source"), n_words(F.col("text")).alias("size"), F.xxhash64(F.lit(seed), doc_id, "source", "text").alias("draw")]


def repetitions(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: Fraction | str = Fraction(3, 2), epochs: int = 2, seed: int = 12) -> DataFrame:
    """(doc_id, source, text) -> one row per row of docs: doc_id, source, size (words of the text), source_size (of all its rows),
    target (words that the mix wants of the source), repetitions and taken (repetitions * size).

    Sources in order of code points, null last, have the weights in turn and share `share` of all words, see `water_filled`. All rows
    of a source are repeated as often as its target holds its size; the rest of the target is one more repetition of a sample: rows in
    the order of a seeded hash, as many as come nearest to the rest, so a source misses its target by at most half of one document.
    The running sum over that order is taken in sorted ranges, so no task holds a source.

    Null text counts 0 words; rows without words join no sample. Repeated rows each take part on their own; which of those equal in id
    and text is sampled makes no difference. A null source is a source of its own, a null id an id. Sources without words have target 0. An empty table
    gives no rows. The same rows give the same result, however they are dealt. Only doc_id, source and text are read."""
    rows = materialize(docs.select(*_drawn(seed), F.monotonically_increasing_id().alias("place")))
    out = _planned(rows, weights, share, epochs)
    return out.select("doc_id", "source", "size", "source_size", "target", "repetitions", "taken")


def mixture(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: Fraction | str = Fraction(3, 2), epochs: int = 2, seed: int = 12) -> DataFrame:
    """The mixed documents themselves: all columns of docs and `epoch` (from 0; a longer name where docs has it), each row as often as
    `repetitions` says. docs is stored once, so that rows keep their places. Nulls, repeated rows, empty tables and other columns count as there."""
    place, n, epoch = fresh(docs, "_place", "_n", "epoch")
    stored = materialize(docs.withColumn(place, F.monotonically_increasing_id()))
    plan = _planned(materialize(stored.select(*_drawn(seed), F.col(place).alias("place"))), weights, share, epochs)
    plan = plan.where("repetitions > 0").select(F.col("place").alias(place), F.col("repetitions").alias(n))
    return stored.join(plan, place).select(*docs.columns, F.explode(F.sequence(F.lit(0), F.col(n) - 1)).alias(epoch))
