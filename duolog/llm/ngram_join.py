"""N-gram Jaccard self-join by T-occurrence search with DivideSkip."""

from __future__ import annotations

import hashlib
import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from duolog.llm._arrow import LOWER, SPACE, Rolling, mix, slices, text_bytes, words
from duolog.llm._components import connected_components, with_least
from duolog.llm._scratch import fresh, keep_ids, materialize

#: Shingles whose frequency order is known exactly; the others are ordered by hash.
FREQUENT = 1 << 18
#: Shingles counted together before a task reports the repeated ones.
WINDOW = 1 << 22
#: Steps of the histogram of counts for each doubling.
STEPS = 16
#: Postings of a class that travel with each of them at most.
CARRIED = 256
#: Classes in a list that is joined without more ado.
LIGHT = 64
#: Lists probed for a set before its chances are reckoned anew.
PROBED = 32
#: Candidates of one query that one task verifies.
CANDIDATES = 64
_FOLD = np.random.default_rng(5).integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Per row the sorted distinct 64-bit hashes of its shingles of `width` words, lower-cased in A-Z."""
    data, offsets = text_bytes(column)
    data = LOWER[data]
    starts, ends, at = words(data, offsets, SPACE[data])
    one = Rolling(data)(starts, ends)
    n = max(0, len(one) - width + 1)
    long = np.zeros(n, np.uint64)
    for k in range(width):
        long += one[k : k + n] * _FOLD[k]
    long = mix(long)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= width:
            yield np.unique(long[a : b - width + 1])
        elif b > a:
            yield mix(np.array([b - a], np.uint64) + (one[a:b] * _FOLD[width : width + b - a]).sum(dtype=np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def _digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _class_of(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _often(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that occur at least three times in held, and how often. Empties held and sorts one copy in place: a window's shingles are kept twice at most."""
    value = np.concatenate(held)
    held.clear()
    value.sort()
    third = value[2:] == value[:-2]
    found, times = np.unique(value[:-2][third], return_counts=True)
    return found, times.astype(np.int64) + 2


def frequent_shingles(docs: DataFrame, width: int, keep: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """The shingles that most distinct sets hold, with a level (log2 of their count); at most `keep` of them.

    Tasks count all shingles of all documents and report those seen at least three times within a
    window; sums of the reports decide. A histogram of the sums tells from which count on at most `keep` are left, and only those
    come to the driver, so tasks don't offer it `keep` rows each. The list only orders shingles, so that rare ones are indexed
    first; any order gives the same links. Its size is fixed, whatever the input.
    """

    def count(batches):
        held, size, seen = [], 0, set()

        def flush():
            if not held:
                return None
            value, times = _often(held)
            return pa.record_batch([pa.array(value.view(np.int64)), pa.array(times)], ["token", "n"])

        for part in slices(batches):
            for tokens in _shingle_sets(part.column("text"), width):
                digest = _digest(tokens)
                if digest in seen:
                    continue
                seen.add(digest)
                held.append(tokens)
                size += len(tokens)
            if size >= WINDOW:
                yield flush()
                seen.clear()
                size = 0
        last = flush()
        if last is not None:
            yield last

    counts = docs.select("text").mapInArrow(count, "token long, n long")
    counts = materialize(counts.groupBy("token").agg(F.sum("n").alias("n")).where("n >= 4"))
    step = F.floor(F.log2("n") * STEPS).cast("int")
    held = sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True)  # 64 * STEPS rows at most
    least, total = None, 0
    for r in held:
        total += r["count"]
        if total > keep:
            break
        least = r.step
    rows = counts.where(step >= least).collect() if least is not None else []
    token = np.array([r.token for r in rows], np.int64).view(np.uint64)
    level = np.array([int(r.n).bit_length() for r in rows], np.int64)
    order = np.argsort(token)
    return token[order], level[order]


def prefix_size(n: int, percent: int) -> int:
    """Shingles of a set of n of which any partner shares at least one."""
    return n - -(-percent * n // 100) + 1


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, key (hash of id and text, the same whenever it is computed), text."""
    doc_id = F.col("doc_id").cast("long")
    return docs.select(doc_id.alias("doc_id"), F.xxhash64(doc_id, "text").alias("key"), "text")


def signatures(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, key, n, digest (of the whole set), cls (64 bits of it), prefix: the set's rarest shingles, at the
    first document of each class in a task, else null. Materialised."""
    token, level = frequent_shingles(docs, width)
    bits = np.zeros(1 << 20, bool)
    bits[(token & np.uint64(0xFFFFF)).astype(np.int64)] = True
    shared = docs.sparkSession.sparkContext.broadcast((token, level, bits))

    def sign(batches):
        token, level, bits = shared.value
        seen: set[bytes] = set()
        for part in slices(batches):
            sizes, digests, classes, prefixes = [], [], [], []
            for tokens in _shingle_sets(part.column("text"), width):
                digest, n = _digest(tokens), len(tokens)
                sizes.append(n)
                digests.append(digest)
                classes.append(_class_of(digest))
                if not n or digest in seen:
                    prefixes.append(None)
                    continue
                if len(seen) > 500_000:
                    seen.clear()
                seen.add(digest)
                maybe = np.flatnonzero(bits[(tokens & np.uint64(0xFFFFF)).astype(np.int64)])
                if len(maybe) and len(token):
                    rank = np.zeros(n, np.int64)
                    place = np.minimum(np.searchsorted(token, tokens[maybe]), len(token) - 1)
                    rank[maybe] = np.where(token[place] == tokens[maybe], level[place], 0)
                    tokens = tokens[np.argsort(rank, kind="stable")]
                prefixes.append(tokens[: prefix_size(n, percent)].view(np.int64))
            yield pa.record_batch(
                [part.column("doc_id"), part.column("key"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(classes, pa.int64()), pa.array(prefixes, pa.list_(pa.int64()))],
                ["doc_id", "key", "n", "digest", "cls", "prefix"],
            )

    return materialize(_keyed(docs).mapInArrow(sign, "doc_id long, key long, n long, digest binary, cls long, prefix array<long>"))


def merged_lists(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted lists merged on a heap: the members, and in how many lists each is."""
    members, times, last = [], [], None
    for k in heapq.merge(*lists):
        if k != last:
            members.append(k)
            times.append(0)
            last = k
        times[-1] += 1
    return np.array(members, np.int64), np.array(times, np.int64)


def divide_skip(query: np.ndarray, sets: list[np.ndarray], need: list[int]) -> list[int]:
    """Overlap of query with each of sets (sorted, distinct), or -1 below its need.

    T is the least need. L lists of the query's tokens are set aside, at most T - 1; only the other lists, which name the sets that
    hold a token, are made, and merged on a heap. A set that occurs less than T - L times there can't reach T. For the
    others, the lists set aside are probed by binary search, until the need can't be met any more."""
    if not sets:
        return []
    out = [-1] * len(sets)
    least = max(1, min(need))
    if len(query) < least:
        return out
    aside = min(least - 1, int(least / (0.0085 * math.log2(max(2, len(sets))) + 1)))
    short, long = query[: len(query) - aside], query[len(query) - aside :]
    lists: dict[int, list[int]] = {}
    for k, tokens in enumerate(sets):
        few = tokens[: np.searchsorted(tokens, short[-1], side="right")]
        place = np.minimum(np.searchsorted(short, few), len(short) - 1)
        for p in place[short[place] == few].tolist():
            lists.setdefault(p, []).append(k)
    for k, times in zip(*(x.tolist() for x in merged_lists(list(lists.values())))):
        for at in range(0, len(long), PROBED):
            if times + len(long) - at < need[k]:
                break
            some = long[at : at + PROBED]
            place = np.minimum(np.searchsorted(sets[k], some), len(sets[k]) - 1)
            times += int((sets[k][place] == some).sum())
        if times >= need[k]:
            out[k] = times
    return out


def _need(na: int, nb: int, percent: int) -> int:
    """Least overlap for 100 * intersection >= percent * union."""
    return -(-percent * (na + nb) // (100 + percent))


def verified_links(docs: DataFrame, classes: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of pairs (a, b: classes) whose sets reach the threshold, with their overlap. Materialised.

    Sets are computed anew for the documents that stand for the candidates, found by their keys. A query's set travels once, before
    its candidates; queries with more than CANDIDATES are dealt to several tasks."""
    pairs = materialize(pairs)
    wanted = pairs.select("a").union(pairs.select("b")).distinct().toDF("cls")
    chosen = materialize(classes.join(wanted, "cls").select(F.col("rep.key").alias("key")).distinct())

    def compute(batches):
        seen: set[bytes] = set()
        for part in slices(batches):
            found = {_digest(s): s for s in _shingle_sets(part.column("text"), width)}
            digests = [d for d in found if d not in seen]
            sets = [found[d] for d in digests]
            if len(seen) > 500_000:
                seen.clear()
            seen.update(digests)
            yield pa.record_batch(
                [pa.array(digests, pa.binary()), pa.array([_class_of(d) for d in digests], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                ["digest", "cls", "tokens"],
            )

    texts = keep_ids(_keyed(docs).select("key", "text"), chosen, "key")
    sets = texts.mapInArrow(compute, "digest binary, cls long, tokens array<long>")
    sets = sets.join(classes.select("digest"), "digest", "left_semi").dropDuplicates(["digest"]).select("cls", "tokens")
    sets = materialize(sets)

    many = materialize(pairs.groupBy("a").agg(F.ceil(F.count("*") / CANDIDATES).cast("int").alias("parts")))
    queries = sets.toDF("a", "tokens").join(many.hint("merge"), "a")
    queries = queries.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("long").alias("b"), "tokens")
    dealt = pairs.join(many.where("parts > 1"), "a", "left").select("a", "b", F.coalesce(F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"), F.lit(0)).alias("part"))
    candidates = dealt.join(sets.toDF("b", "tokens").hint("merge"), "b").select("a", "part", "b", "tokens")

    def search(batches):
        name, query = None, None
        for batch in batches:
            a, part, b = (batch.column(c).to_pylist() for c in ("a", "part", "b"))
            view = lambda i: batch.column("tokens")[i].values.to_numpy(zero_copy_only=False).view(np.uint64)  # noqa: B023, E731
            at = [i for i in range(len(a)) if not i or (a[i], part[i]) != (a[i - 1], part[i - 1])] + [len(a)]
            kept, overlap = [], []
            for lo, hi in zip(at[:-1], at[1:]):
                if (a[lo], part[lo]) != name:  # a group begins with its query
                    name, query = (a[lo], part[lo]), view(lo).copy()
                    lo += 1
                others = [view(i) for i in range(lo, hi)]
                for i, n in zip(range(lo, hi), divide_skip(query, others, [_need(len(query), len(o), percent) for o in others])):
                    if n >= 0:
                        kept.append(i)
                        overlap.append(n)
            yield pa.record_batch([pa.array([a[i] for i in kept], pa.int64()), pa.array([b[i] for i in kept], pa.int64()), pa.array(overlap, pa.int64())], ["a", "b", "overlap"])

    grouped = queries.unionByName(candidates).repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    return materialize(grouped.select("a", "part", "b", "tokens").mapInArrow(search, "a long, b long, overlap long"))


def _least_shared(percent: int) -> str:
    """SQL for a lower limit of the postings that sets of n and of any m from low to high must share. Up to n they grow
    with m; beyond it they fall with m, but for rounding, so the value at high is taken before rounding up."""
    upto = f"ceil({percent} * (n + low) / {100 + percent}.0) - ceil({percent} * greatest(n, low) / 100.0) + 1"
    beyond = f"floor(({100 * percent} * (n + high) - {percent * (100 + percent)} * greatest(n, high)) / {100 * (100 + percent)}.0) + 1"
    return f"greatest(1, least({upto}, {beyond}))"


def _pairs_apart(placed: DataFrame, held: DataFrame, percent: int, possible: str, bound) -> DataFrame:
    """Pairs (a, b, na, nb) of classes with different roots that may share as many postings as their sizes ask for.

    A pair of sizes na, nb must share at least `bound` of the postings left to each, so one of the shared ones is among the first
    l - bound + 1 of either's l, shortest lists first: the other lists of a class are its long ones, set aside. Lists of at most LIGHT classes go
    to the classes that search them, which merge theirs on a heap. For longer ones, which would travel too often, bounds
    depend on both sizes: sizes are dealt into classes, and a posting goes to each class of
    partners for which it is early enough; most postings of long lists come too late for any. A class's postings
    travel along, up to CARRIED of them, so that the join counts what a pair shares before it makes a row; longer ones are
    counted by the caller."""
    own = Window.partitionBy("cls")
    ranked = placed.withColumns({"rank": F.row_number().over(own.orderBy("df", "token")), "total": F.count("*").over(own)})
    ranked = materialize(ranked)
    side = lambda rows, x, *more: rows.select("token", *more, *[F.col(c).alias(f"{k}{x}") for c, k in (("cls", ""), ("n", "n"), ("live", "l"), ("root", "r"))])
    sizes = {"low": F.ceil(F.col("n") * percent / 100).cast("bigint"), "high": F.floor(F.col("n") * 100 / percent).cast("bigint")}
    light = ranked.where(F.col("df") <= LIGHT).withColumns(sizes).where(f"rank <= total + 1 - {_least_shared(percent)}")
    light = light.select("token", "cls", "n", "live", "root")
    entry = F.struct("cls", "n", "live", "root")
    lists = light.groupBy("token").agg(F.sort_array(F.collect_list(entry)).alias("e")).where("size(e) > 1")  # at most LIGHT
    lists = lists.select("token", *[F.col(f"e.{c}").alias(f"{c}s") for c in ("cls", "n", "live", "root")])
    searched = light.join(lists.hint("merge"), "token").drop("token").repartition("cls").sortWithinPartitions("cls")

    def search(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held).combine_chunks()
            cls = table.column("cls").to_numpy()
            edge = np.flatnonzero(cls[1:] != cls[:-1]) + 1
            if len(edge):
                yield from found(table.slice(0, int(edge[-1])), np.concatenate([[0], edge]))
                table = table.slice(int(edge[-1]))
            held = table.to_batches()
        if held:
            table = pa.Table.from_batches(held).combine_chunks()
            yield from found(table, np.array([0, table.num_rows]))

    def found(table, edges):
        number = {c: table.column(c).to_numpy() for c in ("cls", "n", "live", "root")}
        lists = {c: table.column(f"{c}s").combine_chunks() for c in number}
        begin = np.concatenate([[0], np.cumsum(lists["cls"].value_lengths().to_numpy())])
        flat = {c: v.flatten().to_numpy() for c, v in lists.items()}
        out = []
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
            one = {c: int(v[lo]) for c, v in number.items()}
            member = {c: v[begin[lo] : begin[hi]] for c, v in flat.items()}
            na, nb = one["n"], member["n"]
            larger = np.maximum(na, nb)
            most = np.minimum(one["live"], member["live"]) + -(-percent * larger // 100) - 1
            ok = (member["root"] != one["root"]) & ((na < nb) | (na == nb) & (one["cls"] < member["cls"])) & (100 * na >= percent * nb) & ((100 + percent) * most >= percent * (na + nb))
            if not ok.any():
                continue
            of = np.repeat(np.arange(hi - lo), np.diff(begin[lo : hi + 1]))[ok]
            name, size = member["cls"][ok], nb[ok]
            cuts = np.searchsorted(of, np.arange(hi - lo + 1))
            members, _ = merged_lists([name[i:j].tolist() for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()) if j > i])
            at = np.argsort(name, kind="stable")
            out.append((np.full(len(members), one["cls"]), members, np.full(len(members), na), size[at[np.searchsorted(name[at], members)]]))
        if out:
            yield pa.record_batch([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out)], ["a", "b", "na", "nb"])

    merged = searched.select("cls", "n", "live", "root", "clss", "ns", "lives", "roots").mapInArrow(search, "a long, b long, na long, nb long")

    step = 1.04
    kind = F.floor(F.log(F.col("n")) / math.log(step)).cast("int")
    spread = math.ceil(math.log(100 / percent) / math.log(step))
    rows = ranked.where(F.col("df") > LIGHT).withColumn("mine", kind)
    rows = rows.withColumn("other", F.explode(F.sequence(F.col("mine") - spread, F.col("mine") + spread)))
    low = F.greatest(F.floor(F.pow(F.lit(step), F.col("other"))) - 1, F.ceil(F.col("n") * percent / 100))
    high = F.least(F.ceil(F.pow(F.lit(step), F.col("other") + 1)) + 1, F.floor(F.col("n") * 100 / percent))
    rows = rows.withColumns({"low": low.cast("bigint"), "high": high.cast("bigint")}).where("low <= high")
    rows = rows.where(f"rank <= total + 1 - {_least_shared(percent)}")
    rows = rows.select("token", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"), "mine", "cls", "n", "live", "root")
    rows = materialize(rows)
    short = held.where(F.size("tokens") <= CARRIED).toDF("cls", "own")
    rows = rows.join(short.hint("merge"), "cls", "left")
    a = side(rows.where("mine = lo"), "a", "lo", "hi", F.col("own").alias("oa"))
    b = side(rows.where("mine = hi"), "b", "lo", "hi", F.col("own").alias("ob"))
    joined = a.join(b.hint("merge"), ["token", "lo", "hi"]).where(f"(lo < hi or na < nb or na = nb and a < b) and ra <> rb and {possible}")
    shared = F.size(F.array_intersect("oa", "ob")) >= bound
    joined = joined.where(F.col("oa").isNull() | F.col("ob").isNull() | shared)
    return merged.union(joined.select("a", "b", "na", "nb")).distinct()


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, text) -> doc_id, n_shingles, component_id (smallest id reachable by links, itself included).

    Two documents link when 100 * |A and B| >= percent * |A or B| over their sets of distinct `width`-word
    shingles (words between ASCII white space, A-Z lower-cased; a shorter text is one shingle).
    Documents without words or with null text have empty sets and no links. Rows that repeat an id take part
    each on its own. A null id never names a component unless all its members' ids are null.
    An empty table gives no rows. Only doc_id and text are read, whatever other columns are called.

    Equal sets form classes, joined by digest. Each class posts its prefix: as many of its rarest
    shingles as leave one in common with any partner (T-occurrence with all other lists set aside).
    Postings that no other class shares go. What two sets share is in both prefixes, or in the rest of the one whose
    prefix ends first, so the smaller number of postings left and the larger rest bound the overlap.
    First, in every list, only the class with the largest part of its prefix left is tried against the
    others, which connects groups of near-copies with a number of pairs linear in their size. Then pairs
    still apart whose bounds allow it are sought in the lists (see `_pairs_apart`), those that share too few
    postings go, and the rest are verified by `divide_skip`. Components close over both kinds of links.
    Shingles are 64-bit hashes.
    """
    sig, by_class, _ = _grouped(docs, width, percent)
    out = sig.select("doc_id", "n", "digest").join(by_class.hint("merge"), "digest", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def _grouped(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Signatures; digest and component_id of each class; doc_id and key of the one document that stands for each component,
    which has the smallest id, null last. Documents without words are in no class."""
    sig = signatures(docs, width, percent)
    rep = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key"))
    classes = materialize(sig.where("n > 0").groupBy("digest", "cls").agg(rep.alias("rep"), F.max("n").alias("n")))
    posts = sig.where("prefix is not null").select("cls", "n", F.explode("prefix").alias("token"))
    lists = posts.groupBy("token").agg(F.min("cls").alias("_first"), F.max("cls").alias("_last")).where("_first < _last").select("token")
    live = materialize(posts.join(lists.hint("merge"), "token").select("token", "cls", "n").dropDuplicates(["token", "cls", "n"]))

    rest = f"cast(ceil({percent} * n / 100.0) as bigint) - 1"  # tokens outside the prefix
    reach = live.groupBy("cls", "n").agg(F.count("*").alias("live")).select("cls", "live", F.expr(f"live / (n - ({rest})) as share"))
    live = materialize(live.join(reach.hint("merge"), "cls").select("token", "cls", "n", "live", "share"))
    hub = live.groupBy("token").agg(F.max(F.struct("share", "cls", "n", "live")).alias("h")).select("token", F.col("h.cls").alias("a"), F.col("h.n").alias("na"), F.col("h.live").alias("la"))
    possible = f"100 * least(na, nb) >= {percent} * greatest(na, nb) and {100 + percent} * (least(la, lb) + ceil({percent} * greatest(na, nb) / 100.0) - 1) >= {percent} * (na + nb)"
    bound = F.expr(f"ceil({percent} * (na + nb) / {100 + percent}.0) - ceil({percent} * greatest(na, nb) / 100.0) + 1")
    star = live.toDF("token", "b", "nb", "lb", "_share").join(hub.hint("merge"), "token").where(f"a <> b and {possible}")
    star = star.groupBy("a", "b", "na", "nb").count().where(F.col("count") >= F.greatest(bound, F.expr(f"(nb - ceil({percent} * nb / 100.0) + 1) * 0.3")))
    first = verified_links(docs, classes, star.select("a", "b"), width, percent)
    near = connected_components(first.select(F.col("a").alias("src"), F.col("b").alias("dst"))).toDF("cls", "root")

    placed = live.join(near.hint("merge"), "cls", "left").select("token", "cls", "n", "live", F.coalesce("root", "cls").alias("root"))
    placed = materialize(placed)
    mixed = placed.groupBy("token").agg(F.min("root").alias("_lo"), F.max("root").alias("_hi"), F.count("*").alias("df")).where("_lo < _hi").select("token", "df")
    placed = materialize(placed.join(mixed.hint("merge"), "token"))
    held = materialize(placed.groupBy("cls").agg(F.collect_list("token").alias("tokens")))  # at most a prefix
    pairs = _pairs_apart(placed, held, percent, possible, bound)
    pairs = pairs.join(held.toDF("a", "_ta").hint("merge"), "a").join(held.toDF("b", "_tb").hint("merge"), "b")
    second = verified_links(docs, classes, pairs.where(F.size(F.array_intersect("_ta", "_tb")) >= bound).select("a", "b"), width, percent)

    links = first.union(second).select(F.col("a").alias("src"), F.col("b").alias("dst"))
    roots = connected_components(links).toDF("cls", "root")
    rooted = classes.join(roots.hint("merge"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    rooted = materialize(rooted.select("digest", "root", "rep"))
    by_class = materialize(with_least(rooted, "root", "rep", "least").select("digest", F.col("least.doc_id").alias("component_id")))
    least = rooted.groupBy("root").agg(F.min("rep").alias("least"))
    return sig, by_class, least.select("least.doc_id", "least.key")


def distinct_documents(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """docs with one row of each group of near-copies, of the smallest id (null only where no row has one); all columns kept.

    The row is found by its id and a hash of id and text, so where an id repeats, its other texts go. Of rows that are equal in
    both, any one stays. Rows without words, null texts among them, are near-copies of none and all stay. An empty table stays empty.
    docs may have columns of any other names."""
    worded = F.coalesce(F.col("text").rlike(r"[^\t-\r ]"), F.lit(False))
    doc_id = F.col("doc_id").cast("long")
    place = fresh(docs, "_near_none", "_near_id", "_near_key")
    at = lambda rows, doc_id, key: rows.withColumns(dict(zip(place, (doc_id.isNull(), F.coalesce(doc_id, F.lit(0)), key))))
    kept = at(_grouped(docs, width, percent)[2], F.col("doc_id"), F.col("key")).select(*place)
    rows = at(docs.where(worded), doc_id, F.xxhash64(doc_id, "text")).join(kept.hint("merge"), place, "left_semi").dropDuplicates(place)
    return rows.select(*docs.columns).union(docs.where(~worded))
