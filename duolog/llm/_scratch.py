"""Materialised intermediates in the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_own: list[str] = []


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the session names in spark.checkpoint.dir. Where it is unset, a local session (tests) gets a folder
    of its own; on a cluster that is an error, for a folder of one machine would not be seen by the others."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="duolog-"))
    return _own[0]


def materialize(df: DataFrame) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/duolog-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of df has it, whatever the case of its letters."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def keep_ids(df: DataFrame, ids: DataFrame, key: str, limit: int = 500_000) -> DataFrame:
    """Rows of df whose key is in ids (materialised, one column `key`). ids is broadcast only while
    it has at most `limit` rows; beyond that, both sides are shuffled by key."""
    few = ids.limit(limit + 1).count() <= limit
    return df.join(F.broadcast(ids) if few else ids.hint("merge"), key, "left_semi")
