"""Best-fit packing of token pieces, closed up by swap-based local search."""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left, bisect_right, insort
from itertools import combinations
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duolog.llm._arrow import slices
from duolog.llm._scratch import fresh, materialize
from duolog.llm.word_bpe import encoded

#: Pieces packed together in one task.
SHARD = 10_000
#: Donors in a row that a local search tries in vain before it ends.
PATIENCE = 32


def pieces(docs: DataFrame, path: str, capacity: int, end_id: int = 1, with_ids: bool = True) -> DataFrame:
    """(doc_id, text) -> one row per piece: doc_id, piece, start, length, ids_crc32, and ids (binary, unsigned 32-bit
    little-endian) where asked for; else ids stay in the worker. A document is its ids and then end_id, so null and empty texts
    are one piece of one token. Only longer documents than capacity are cut; only a last piece is shorter than capacity."""
    tail = np.array([end_id], "<u4").tobytes()
    fields = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.binary())] * with_ids)

    def cut(batches):
        for part in slices(batches):
            flat, offsets = encoded(part.column("text"), path)
            raw, edge = memoryview(flat.astype("<u4")).cast("B"), (4 * offsets).tolist()
            rows = []
            for doc_id, a, b in zip(part.column("doc_id").to_pylist(), edge[:-1], edge[1:]):
                for k, at in enumerate(range(a, b + 4, 4 * capacity)):
                    ids = bytes(raw[at : min(b, at + 4 * capacity)])
                    if at + 4 * capacity > b:
                        ids += tail
                    rows.append((doc_id, k, k * capacity, len(ids) // 4, zlib.crc32(ids), ids)[: len(fields)])
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), fields)], schema=fields)

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return plain.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)


class Bins:
    """Items laid in bins of one capacity: best fit as they arrive, then the swap-based local search."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        self.lengths, self.capacity = np.asarray(lengths, np.int64), capacity
        self.steps, self.sizes = 0, self.lengths.tolist()
        self.choices: dict[int, dict[int, list]] = {1: {}, 2: {}}
        self.items, self.fill = self._best_fit()

    def _best_fit(self) -> tuple[list[list[int]], np.ndarray]:
        """Each item, in the order given, into the fullest bin that takes it, else into a new one."""
        bins: list[list[int]] = []
        by_room: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        rooms: list[int] = []
        for i, need in enumerate(self.sizes):
            at = bisect_left(rooms, need)
            if at == len(rooms):
                bins.append([])
                room, b = self.capacity, len(bins) - 1
            else:
                room = rooms[at]
                b = by_room[room].pop()
                if not by_room[room]:
                    del rooms[at]
            bins[b].append(i)
            left = room - need
            if left:
                if not by_room[left]:
                    insort(rooms, left)
                by_room[left].append(b)
        return bins, np.array([int(self.lengths[b].sum()) for b in bins], np.int64)

    def least(self) -> int:
        """Bins that any packing needs: tokens over capacity, or, for some size up to half, the items that exclude each other
        and what the smaller ones need beyond the room beside those."""
        size = np.sort(self.lengths)
        most = -(-int(size.sum()) // self.capacity)
        sums = np.concatenate([[0], np.cumsum(size)])
        half = np.searchsorted(size, self.capacity // 2, side="right")
        low = np.searchsorted(size, np.unique(size[:half]))
        alone = np.minimum(np.searchsorted(size, self.capacity - size[low], side="right"), len(size))
        alone = np.maximum(alone, half)
        beside = (alone - half) * self.capacity - (sums[alone] - sums[half])
        need = len(size) - half + np.maximum(0, -(-(sums[half] - sums[low] - beside) // self.capacity))
        return max(most, len(size) - int(half), int(need.max(initial=0)))

    def improve(self) -> None:
        """Empty underfull bins, the least full one first, into the others.

        A step takes items of the donor and moves one into the bin that it fills best, exchanges one for a smaller item of a
        bin, one for two of a bin, or two for one, whichever leaves least room there. A step is taken only where the sum of squared
        fills grows. All underfull bins take part. A donor that can give no more is set aside; the search ends where no fewer bins
        could hold the items, where all donors are set aside, or after PATIENCE of them in a row."""
        least, used, idle = self.least(), len(self.items), 0
        waiting = [(f, b) for b, f in enumerate(self.fill.tolist()) if f < self.capacity]
        heapq.heapify(waiting)
        open_bins = np.flatnonzero(self.fill < self.capacity)
        self.item = np.array([i for b in open_bins.tolist() for i in self.items[b]], np.int64)
        self.owner = np.repeat(open_bins, [len(self.items[b]) for b in open_bins.tolist()])
        self.size, self.where = self.lengths[self.item], np.full(len(self.lengths), -1)
        self.where[self.item] = np.arange(len(self.item))
        while waiting and used > least and idle < PATIENCE:
            fill, donor = heapq.heappop(waiting)
            if fill != self.fill[donor]:
                if self.items[donor]:
                    heapq.heappush(waiting, (int(self.fill[donor]), donor))
                continue
            while self.items[donor] and (self._moves(donor) or self._exchanges(donor, 1, 1) or self._exchanges(donor, 1, 2) or self._exchanges(donor, 2, 1)):
                pass
            used -= not self.items[donor]
            idle = idle + 1 if self.items[donor] else 0

    def _swap(self, donor: int, gives: tuple[int, ...], b: int, takes: tuple[int, ...] = ()) -> None:
        self.items[donor] = [x for x in self.items[donor] if x not in gives] + list(takes)
        self.items[b] = [x for x in self.items[b] if x not in takes] + list(gives)
        moved = sum(self.sizes[i] for i in gives) - sum(self.sizes[i] for i in takes)
        self.fill[donor] -= moved
        self.fill[b] += moved
        for i in gives:
            self.owner[self.where[i]] = b
        for i in takes:
            self.owner[self.where[i]] = donor
        for kept in self.choices.values():
            kept.pop(donor, None)
            kept.pop(b, None)
        self.steps += 1

    def _moves(self, donor: int) -> bool:
        """Move what fits elsewhere, longest first, into the bin with least room for it."""
        before = self.steps
        room = self.capacity - self.fill
        room[donor] = 0
        room[self.fill == 0] = 0
        for i in sorted(self.items[donor], key=lambda i: -self.sizes[i]):
            size = self.sizes[i]
            fits = np.flatnonzero((room >= size) & (self.fill + size > self.fill[donor]))
            if len(fits):
                b = int(fits[room[fits].argmin()])
                self._swap(donor, (i,), b)
                room[b] -= size
        return self.steps > before

    def _exchanges(self, donor: int, gives: int, takes: int) -> bool:
        """One pass over the bins that can take `gives` items of the donor for `takes` smaller ones, roomiest first."""
        before = self.steps
        if len(self.items[donor]) < gives:
            return False
        offers = self._sums(donor, gives)
        free = self.capacity - self.fill[self.owner]
        hit = np.zeros(len(self.items), bool)
        if takes == 1:
            for size in {o[0] for o in offers} if len(offers) < 64 else ():
                hit[self.owner[(self.size < size) & (self.size + free >= size)]] = True
            if len(offers) >= 64:
                hit[self.owner[free > 0]] = True
        else:
            hit[self.owner[(free > 0) & (self.size < offers[-1][0])]] = True
        hit[donor] = False
        bins = np.flatnonzero(hit)
        for b in bins[np.argsort(self.fill[bins], kind="stable")].tolist():
            room = self.capacity - int(self.fill[b])
            gain, offer, taken = 0, None, ()
            for size, taken_now in self._sums(b, takes):
                at = bisect_right(offers, size + room, key=_first) - 1
                if at >= 0 and offers[at][0] - size > gain:
                    gain, offer, taken = offers[at][0] - size, offers[at][1], taken_now
                    if gain == room:
                        break
            if gain and self.fill[b] + gain > self.fill[donor]:
                self._swap(donor, offer, b, taken)
                if len(self.items[donor]) < gives:
                    break
                offers = self._sums(donor, gives)
        return self.steps > before

    def _sums(self, b: int, many: int) -> list[tuple[int, tuple[int, ...]]]:
        """Sizes of all choices of so many items of a bin, with the items, in order; kept until the bin changes."""
        if (kept := self.choices[many].get(b)) is None:
            sizes = self.sizes
            if many == 1:
                kept = sorted((sizes[i], (i,)) for i in self.items[b])
            else:
                kept = sorted((sizes[i] + sizes[j], (i, j)) for i, j in combinations(self.items[b], 2))
            self.choices[many][b] = kept
        return kept


_first = itemgetter(0)


def assign(parts: DataFrame, capacity: int, shard: int = SHARD) -> DataFrame:
    """Rows with a `length` of 1 to capacity -> the same rows with sequence_id, offset (gapless from 0) and moved: whether the
    local search took the row out of the sequence that best fit had chosen.

    Full pieces are sequences of their own. The others are dealt by a hash that takes in the row's place, into shards of about
    `shard` rows whatever their ids; a shard is packed in one task, see Bins, so its bins hold no other shard's pieces and a shard
    leaves at most a few bins underfull. parts must be materialised (its row places must not change between runs)."""
    columns = parts.columns
    full = parts.where(F.col("length") >= capacity)
    rest = parts.where(F.col("length") < capacity)
    shards = max(1, -(-rest.count() // shard))
    place = F.monotonically_increasing_id()
    full = full.select(*columns, (-place - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(False).alias("moved"))
    (key,) = fresh(parts, "_shard")
    dealt = rest.withColumn(key, F.pmod(F.xxhash64("length", place), F.lit(shards)).cast("long"))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        bins = Bins(rows["length"].to_numpy(), capacity)
        sequence, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        first = np.zeros(len(rows), np.int64)
        for k, items in enumerate(bins.items):
            first[items] = k
        bins.improve()
        for k, items in enumerate(bins.items):
            sequence[items] = k
            offset[items] = np.cumsum(bins.lengths[items]) - bins.lengths[items]
        out = rows.drop(columns=key)
        out["sequence_id"] = (rows[key].to_numpy() << 32) + sequence
        out["offset"], out["moved"] = offset, sequence != first
        return out

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema) + ", sequence_id long, offset long, moved boolean"
    return full.unionByName(dealt.groupBy(key).applyInPandas(pack, schema))


def packed(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """(doc_id, text) -> one row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, moved.

    Documents are encoded with the vocabulary at `path`, see `pieces` for cutting and `assign` for packing.
    Ids stay in the workers; only lengths are packed. Null texts are empty, repeated rows are packed each, null ids
    stay null. An empty table gives no rows. Only doc_id and text are read, whatever other columns are called."""
    return assign(materialize(pieces(docs, path, capacity, end_id, with_ids=False)), capacity)


def sequences(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """The packed sequences themselves: sequence_id, n_tokens, doc_ids, ids (binary), each of at most capacity tokens. Nulls,
    repeated rows, empty tables and other columns count as in `packed`."""
    laid = assign(materialize(pieces(docs, path, capacity, end_id)), capacity)
    rows = laid.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids", "length"))).alias("p"))
    return rows.select(
        "sequence_id",
        F.aggregate("p", F.lit(0).cast("long"), lambda n, x: n + x["length"]).alias("n_tokens"),
        F.col("p.doc_id").alias("doc_ids"),
        F.expr("aggregate(p, cast('' as binary), (a, x) -> concat(a, x.ids))").alias("ids"),
    )
