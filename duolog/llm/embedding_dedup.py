"""Near-duplicate embeddings: rotation codes with correction factors decide which pairs are compared exactly."""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duolog.llm._components import connected_components, with_least
from duolog.llm._scratch import materialize

#: Classes that a bucket holds on average, and classes compared with each other in one block of a bucket.
BUCKET, BLOCK = 1024, 2048
#: Chance that a pair exactly at the threshold meets in some table; closer pairs meet more surely.
RECALL = 0.98
#: Standard deviations of the estimate's error that a pair may lie below the threshold and still be recomputed.
CONFIDENCE = 4.0
#: Rotations whose signs make up a code.
ROTATIONS = 2
#: Rows of a table of large buckets up to which it is broadcast.
FEW = 200_000


@lru_cache(maxsize=256)
def rotation(size: int, number: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every worker."""
    q, r = np.linalg.qr(np.random.default_rng([size, number]).normal(size=(size, size)))
    return q * np.sign(np.diag(r))


def tables_for(count: int, threshold: float) -> tuple[int, int]:
    """Bits of a bucket's key, and number of tables: keys grow with the logarithm of the input, so that buckets
    hold about BUCKET classes, and tables follow until RECALL is reached at the threshold."""
    bits = min(31, max(4, math.ceil(math.log2(max(2, count) / BUCKET))))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - RECALL) / math.log(1 - meet))


def _matrices(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, unit vectors in double precision) for every vector length in a list column without nulls."""
    sizes = np.diff(np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    at = np.concatenate([[0], np.cumsum(sizes)])
    out = []
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        x = flat[at[rows][:, None] + np.arange(size)]
        x = x / np.abs(x).max(1, keepdims=True)
        out.append((rows, x / np.linalg.norm(x, axis=1, keepdims=True)))
    return out


def bucket_keys(x: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """Per vector and table the signs of `bits` rotated coordinates as a number, the vector's length above them."""
    size = x.shape[1]
    at_once = max(1, size // bits)
    out = np.empty((len(x), tables), np.int64)
    power = 1 << np.arange(bits, dtype=np.int64)
    for first in range(0, tables, at_once):
        signs = x @ rotation(size, 1 + first // at_once) > 0
        for k in range(min(at_once, tables - first)):
            some = signs[:, k * bits : (k + 1) * bits]
            out[:, first + k] = some @ power[: some.shape[1]]
    return out + (size << 32)


def _turned(x: np.ndarray) -> np.ndarray:
    """Coordinates of unit vectors after each of ROTATIONS rotations, side by side."""
    return np.concatenate([x @ rotation(x.shape[1], 1_000_000 + k) for k in range(ROTATIONS)], 1).astype(np.float32)


def encode(x: np.ndarray) -> np.ndarray:
    """Unit vectors as bytes, one row each: the signs of the rotated coordinates; f, the inner product of code and vector, as
    the stored correction factor; and the vector itself in four bits a coordinate with its scale, for the part of the query.
    Coordinates are rounded up or down by a dither that depends on place and value, so that the rounding has no bias."""
    n, size = x.shape
    turned = _turned(x)
    bits = np.packbits(turned > 0, axis=1)
    f = (np.abs(turned).sum(1) / math.sqrt(ROTATIONS * size * ROTATIONS)).astype(np.float32)
    scale = (np.abs(x).max(1) / 7.5).astype(np.float32)
    level = x / scale[:, None] + 7.5
    dither = ((x.astype(np.float32).view(np.uint32) * np.uint32(2654435761)) >> np.uint32(8)) / np.float64(1 << 24)
    level = np.clip(np.floor(level + dither), 0, 15).astype(np.uint8)
    level = np.concatenate([level, np.zeros((n, size % 2), np.uint8)], 1)
    return np.concatenate([f[:, None].view(np.uint8).reshape(n, 4), scale[:, None].view(np.uint8).reshape(n, 4), level[:, ::2] << 4 | level[:, 1::2], bits], 1)


def likely(codes: np.ndarray, size: int, left: np.ndarray, right: np.ndarray | None, threshold: float) -> np.ndarray:
    """Which rows of left and right (or of left among each other) may have a cosine of at least the threshold, by their codes.

    <code, query> / f estimates the cosine without bias, with an error of about sqrt((1 - f^2) / (f^2 (D - 1))) for D bits. Each of a pair is
    code once and query once; both estimates plus CONFIDENCE errors must reach the threshold."""
    f, scale = (np.ascontiguousarray(codes[:, k : k + 4]).view(np.float32)[:, 0] for k in (0, 4))
    half = -(-size // 2)
    nibbles = codes[:, 8 : 8 + half]
    level = np.stack([nibbles >> 4, nibbles & 15], 2).reshape(len(codes), -1)[:, :size]
    turned = _turned((level - np.float32(7.5)) * scale[:, None])
    wide = ROTATIONS * size
    sign = np.unpackbits(codes[:, 8 + half :], axis=1)[:, :wide].astype(np.float32) * 2 - 1
    sign /= math.sqrt(wide * ROTATIONS) * f[:, None]
    error = np.sqrt(np.maximum(1 - f * f, 0) / (f * f * max(1, wide - 1)) + scale * scale / 4)
    floor = (threshold - 1e-4 - CONFIDENCE * error).astype(np.float32)
    other = left if right is None else right
    one = sign[left] @ turned[other].T
    two = one.T if right is None else sign[other] @ turned[left].T
    maybe = (one >= floor[left][:, None]) & (two.T >= floor[other][None, :])
    return np.triu(maybe, 1) if right is None else maybe


def close_pairs(x: np.ndarray, left: np.ndarray, right: np.ndarray | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of x (unit vectors) with cosine >= threshold: rows of left with rows of right, or among left. Only pairs that
    their codes let through are recomputed."""
    i, j = np.nonzero(likely(encode(x), x.shape[1], left, right, threshold))
    i, j = left[i], (left if right is None else right)[j]
    exact = np.concatenate([np.zeros(0)] + [(x[i[k : k + 65536]] * x[j[k : k + 65536]]).sum(1) for k in range(0, len(i), 65536)])
    return i[exact >= threshold], j[exact >= threshold]


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest row that links lead to, per row."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, i, low[j])
        np.minimum.at(new, j, low[i])
        new = new[new]
        if (new == low).all():
            return low
        low = new


def _by_blocks(batches, block: list[str]):
    """Tables whose rows begin and end with whole blocks, with the edges of those, from batches sorted by block."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        table = pa.Table.from_batches(held).combine_chunks()
        names = np.stack([table.column(c).to_numpy() for c in block], 1)
        edge = np.flatnonzero((names[1:] != names[:-1]).any(1)) + 1
        if len(edge):
            yield table.slice(0, int(edge[-1])).combine_chunks(), np.concatenate([[0], edge])
            table = table.slice(int(edge[-1]))
        held = table.to_batches()
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        if table.num_rows:
            yield table, np.array([0, table.num_rows])


def near_duplicates(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """(vec_id, embedding) -> vec_id, n_links, component_id, kept: links of cosine >= threshold in double precision.

    Vectors that are null, empty or zero, or hold null, NaN or infinite components, link with nothing; neither do
    vectors of different lengths. Equal vectors (also the same id repeated) form a class and link with each
    other; a class is compared once, and its size counts in the others' links. A null id never names a component unless all its
    members' ids are null; its kept is then false. An empty table gives no rows. Only vec_id and embedding are read.

    Classes meet in buckets of equal sign keys of several rotations; only codes with their factors travel there, see `encode`.
    A bucket of more than BLOCK classes is split into blocks, and pairs of blocks are compared in tasks of their own. Vectors are
    fetched for those classes only that a code lets through with another one of their block, and compared exactly. A pair counts in the first
    table where it meets. A block returns classes, link counts and one local root per class, never its pairs.
    """
    kind = "double" if "array<double>" in vectors.select("embedding").schema[0].dataType.simpleString() else "float"
    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("embedding"))
    sound = "size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(embedding, x -> x <> 0)"
    usable = F.coalesce(F.expr(sound), F.lit(False))
    alike = F.sha2(F.transform("embedding", lambda x: x + F.lit(0).cast(kind)).cast("string"), 256)  # 0 and -0 are equal
    rows = materialize(plain.select("vec_id", F.when(usable, F.unhex(alike)).alias("digest")))
    classes = plain.where(usable).withColumn("digest", F.unhex(alike)).groupBy("digest").agg(F.min("vec_id").alias("least"), F.count("*").alias("size"), F.first("embedding").alias("embedding"))
    classes = materialize(classes)
    classes = materialize(classes.withColumn("cls", F.monotonically_increasing_id()))
    count = classes.count()
    bits, tables = tables_for(count, threshold)

    def deal(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.zeros((batch.num_rows, tables), np.int64)
            codes: list[bytes] = [b""] * batch.num_rows
            for part, x in _matrices(batch.column("embedding")):
                keys[part] = bucket_keys(x, bits, tables)
                for k, code in zip(part.tolist(), encode(x)):
                    codes[k] = code.tobytes()
            at = pa.array(np.arange(0, keys.size + 1, tables, dtype=np.int32))
            yield pa.record_batch([batch.column("cls"), pa.array(codes, pa.binary()), pa.ListArray.from_arrays(at, pa.array(keys.ravel()))], ["cls", "code", "keys"])

    keyed = materialize(classes.select("cls", "embedding").mapInArrow(deal, "cls long, code binary, keys array<long>"))
    posted = keyed.select("cls", "code", F.posexplode("keys").alias("tab", "key"))
    large = posted.groupBy("tab", "key").count().where(F.col("count") > BLOCK)
    large = materialize(large.select("tab", "key", F.ceil(F.col("count") / BLOCK).cast("int").alias("parts")))
    few = large.limit(FEW + 1).count() <= FEW
    dealt = posted.join(F.broadcast(large) if few else large.hint("merge"), ["tab", "key"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    part = F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int")
    dealt = dealt.withColumn("part", part).withColumn("mate", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.withColumn("lo", F.least("part", "mate")).withColumn("hi", F.greatest("part", "mate"))
    block = ["tab", "key", "lo", "hi"]
    dealt = dealt.select(*block, "part", "cls", "code").repartition(*block).sortWithinPartitions(*block)

    def sift(batches):
        for table, edges in _by_blocks(batches, block):
            part, lo, hi, key = (table.column(c).to_numpy() for c in ("part", "lo", "hi", "key"))
            code, kept = table.column("code").combine_chunks(), []
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                if b - a < 2:
                    continue
                codes = np.frombuffer(b"".join(code.slice(a, b - a).to_pylist()), np.uint8).reshape(b - a, -1)
                number, mine = np.arange(b - a), part[a:b] == lo[a]
                left, right = (number, None) if lo[a] == hi[a] else (number[mine], number[~mine])
                maybe = likely(codes, int(key[a] >> 32), left, right, threshold)
                hit = np.zeros(b - a, bool)
                hit[left] |= maybe.any(1)
                hit[left if right is None else right] |= maybe.any(0)
                kept.append(a + np.flatnonzero(hit))
            if kept:
                yield from table.select([*block, "part", "cls"]).take(np.concatenate(kept)).combine_chunks().to_batches()

    near = materialize(dealt.mapInArrow(sift, "tab int, key long, lo int, hi int, part int, cls long"))
    wanted = near.join(classes.select("cls", "size", "embedding").hint("merge"), "cls").select(*block, "part", "cls", "size", "embedding")
    wanted = wanted.repartition(*block).sortWithinPartitions(*block)

    def compare(batches):
        for table, edges in _by_blocks(batches, block):
            cls, size, tab, part, lo, hi = (table.column(c).to_numpy() for c in ("cls", "size", "tab", "part", "lo", "hi"))
            place, which, unit = np.zeros(len(cls), np.int64), np.zeros(len(cls), np.int64), []
            for number, (rows, y) in enumerate(_matrices(table.column("embedding").combine_chunks())):
                unit.append((y, bucket_keys(y, bits, tables)))
                place[rows], which[rows] = np.arange(len(rows)), number
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                x, keys = (v[place[a:b]] for v in unit[which[a]])
                number, mine = np.arange(b - a), part[a:b] == lo[a]
                i, j = close_pairs(x, number, None, threshold) if lo[a] == hi[a] else close_pairs(x, number[mine], number[~mine], threshold)
                first = ~(keys[i, : tab[a]] == keys[j, : tab[a]]).any(1)
                i, j = i[first], j[first]
                if not len(i):
                    continue
                n = b - a
                links = np.bincount(i, size[a:b][j], n) + np.bincount(j, size[a:b][i], n)
                root = _roots(n, i, j)
                some = np.flatnonzero(links)
                yield pa.record_batch([pa.array(cls[a:b][some]), pa.array(links[some].astype(np.int64)), pa.array(cls[a:b][root[some]])], ["cls", "links", "root"])

    found = materialize(wanted.mapInArrow(compare, "cls long, links long, root long"))
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    roots = connected_components(found.select(F.col("cls").alias("src"), F.col("root").alias("dst"))).toDF("cls", "root")
    placed = classes.drop("embedding").join(roots.hint("merge"), "cls", "left").join(links.hint("merge"), "cls", "left")
    placed = materialize(placed.select("digest", "least", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("root", "cls").alias("root")))
    verdict = materialize(with_least(placed, "root", "least", "component_id").select("digest", "n_links", "component_id"))
    sound_rows = rows.where("digest is not null").join(verdict.hint("merge"), "digest").select("vec_id", "n_links", "component_id")
    alone = rows.where("digest is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = sound_rows.unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
