"""Prefix trie of conversations as a distributed burst trie."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duolog.llm.mixing import n_words
from duolog.operators.ranges import numbered
from duolog.sources.scratch import materialize

#: Distinct suffixes that a container holds at most; a larger one is burst.
LIMIT = 128
#: Turns of a conversation that are in one row and handled at once; longer conversations go on under the node where a page ends.
PAGE = 512
#: Burst containers up to which their table is broadcast.
FEW = 10_000
#: Ids joined to one piece of text on the way to a digest.
IDS = 4096

_SWEPT = "head boolean, r int, box binary, parent binary, up long, conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved long, w long, end binary"


def _digest(text: Column) -> Column:
    """128 bits of the text's SHA-256."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) -> conv_id, depth (from 1, in order of turn, null first), turn_id (128 bits of role and text), words, and a
    row of depth 0 without a turn for each conversation.

    Null role or text is empty, equal turns are in order of turn_id, rows without conv_id go. Rows are numbered in sorted ranges, so a conversation of
    any length is spread over tasks."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), _digest(whole).alias("turn_id"), n_words(text).alias("words"))
    rows = numbered(rows.withColumn("place", F.monotonically_increasing_id()), ["conv_id"], ["turn", "turn_id", "place"], {"depth": ["conv_id"]})
    rows = materialize(rows.select("conv_id", "depth", "turn_id", "words"))
    return rows.unionByName(rows.select("conv_id").distinct(), allowMissingColumns=True).na.fill(0, ["depth", "words"])


def rebuilt(rows: DataFrame, stride: int = 20, most: int = 4) -> DataFrame:
    """`turns` of conversations with shared openings: the first h turns come from the conversation whose id is the next lower multiple of
    stride (as many as it has; none if it is absent), then follow the own turns after the first h, with h = crc32 of the id in decimal, modulo `most`."""
    h = F.crc32(F.col("conv_id").cast("string")) % most
    base = F.col("conv_id") - F.pmod("conv_id", F.lit(stride))
    own = rows.where("depth > 0")
    convs = rows.groupBy("conv_id").agg(F.max("depth").alias("n")).withColumns({"h": h, "base": base})
    convs = materialize(convs)
    openings = own.where((F.pmod("conv_id", F.lit(stride)) == 0) & (F.col("depth") < most)).withColumnRenamed("conv_id", "base")
    shared = convs.select("conv_id", "h", "base").join(openings, "base").where("depth <= h").select("conv_id", "depth", "turn_id", "words")
    bases = convs.where(F.pmod("conv_id", F.lit(stride)) == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    placed = convs.join(bases, "base", "left").select("conv_id", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("kept"))
    rest = own.join(placed, "conv_id").where("depth > h").select("conv_id", (F.col("depth") - F.col("h") + F.col("kept")).alias("depth"), "turn_id", "words")
    return shared.unionByName(rest).unionByName(rows.where("depth = 0"))


def _swept(base: int):
    """Containers (rows sorted by box and ids) to nodes. A container's distinct suffixes come in order, so each adds nodes below the last node that
    it shares with the one before; counts are then summed from the last node to the first, for children come after their parents."""

    def nodes_of(rows: list[dict]) -> list[tuple]:
        o = rows[0]["o"]
        parent, depth, words, end = [-1], [o], [rows[0]["words"][o - 1] if o else 0], [None]
        least, n, children, leaves, saved = [None], [0], [0], [0], [0]
        path, last = [0], None
        for row in rows:
            ids, k = row["ids"], o
            if last is not None:
                to = min(len(last), len(ids))
                while k < to and last[k] == ids[k]:
                    k += 1
            del path[k - o + 1 :]
            for d in range(k, len(ids)):
                parent.append(path[-1])
                path.append(len(depth))
                depth.append(d + 1)
                words.append(row["words"][d])
                end.append(None)
                least.append(None)
                for counts in (n, children, leaves, saved):
                    counts.append(0)
            i = path[-1]
            least[i], n[i], end[i] = row["least"], row["n"], row["end"]
            children[i], leaves[i], saved[i] = row["xc"], row["xl"], row["xs"]
            last = ids
        for i in range(len(depth) - 1, -1, -1):
            if not children[i]:
                leaves[i] = 1
            if i:
                p = parent[i]
                saved[i] += words[i] * (n[i] - 1)
                least[p] = least[i] if least[p] is None else min(least[p], least[i])
                n[p] += n[i]
                children[p] += 1
                leaves[p] += leaves[i]
                saved[p] += saved[i]
        first = rows[0]
        out = [(True, first["r"], first["box"], first["parent"], first["up"], least[0], base + o, n[0], children[0], leaves[0], saved[0], words[0], end[0])]
        out += [(False, None, None, None, least[parent[i]], least[i], base + depth[i], n[i], children[i], leaves[i], saved[i], None, end[i]) for i in range(1, len(depth))]
        return out

    names = [c.split()[0] for c in _SWEPT.split(", ")]
    kinds = {"boolean": pa.bool_(), "int": pa.int32(), "binary": pa.binary(), "long": pa.int64()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in _SWEPT.split(", ")])

    def run(batches):
        held: list[dict] = []
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if held and row["box"] != held[0]["box"]:
                    out += nodes_of(held)
                    held = []
                held.append(row)
            if out:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], names)
        if held:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*nodes_of(held)), schema)], names)

    return run


def _burst_trie(classes: DataFrame, base: int) -> tuple[DataFrame, DataFrame]:
    """classes (hid, ids, words, n, least, end, xc, xl, xs; ids distinct under a hid) -> nodes below the heads hid, and a row per hid with its sums.

    All suffixes of a head start in one container. A container of more than LIMIT is burst: the turns that all of its suffixes share become trie heads at once
    (they are what the least and the greatest suffix share), and each suffix moves on to the container of its next turn; one that ends there is
    kept with the head. Containers left are dealt over tasks, sorted and swept into nodes; then heads add up their containers, the last burst first."""
    current = classes.select(F.lit(0).alias("r"), F.col("hid").alias("box"), F.lit(None).cast("binary").alias("parent"), F.lit(None).cast("long").alias("up"), F.lit(0).alias("o"), "ids", "words", "n", "least", "end", "xc", "xl", "xs")
    small, bursts, r = [], [], 0
    while True:
        large = materialize(current.groupBy("box").count().where(F.col("count") > LIMIT).select("box"))
        few = large.limit(FEW + 1).count()
        if not few:
            small.append(current)
            break
        near = F.broadcast if few <= FEW else lambda df: df
        small.append(current.join(near(large), "box", "left_anti").select(*current.columns))
        over = current.join(near(large), "box", "left_semi")
        heads = over.groupBy("box", "r", "parent", "up", "o").agg(F.min(F.struct("ids", "words")).alias("lo"), F.max("ids").alias("hi"), F.min("least").alias("least"), F.sum("n").alias("n"))
        shared = F.array_position(F.zip_with("lo.ids", "hi", lambda a, b: a.eqNullSafe(b)), False) - 1
        heads = heads.withColumn("to", shared.cast("int"))
        w = F.when(F.col("o") > 0, F.try_element_at("lo.words", F.col("o"))).otherwise(0).cast("long")
        heads = materialize(heads.select("box", "r", "parent", "up", "o", "to", "least", "n", w.alias("w"), F.slice("lo.words", F.col("o") + 1, F.col("to") - F.col("o")).alias("chain")))
        r += 1
        moved = over.join(near(heads.select("box", "to", F.col("least").alias("top"))), "box")
        following = F.try_element_at("ids", F.col("to") + 1)
        box = F.when(following.isNotNull(), _digest(F.concat(F.hex("box"), F.hex(following))))
        moved = moved.select(F.lit(r).alias("r"), box.alias("box"), F.col("box").alias("parent"), F.col("top").alias("up"), (F.col("to") + 1).alias("o"), "ids", "words", "n", "least", "end", "xc", "xl", "xs")
        moved = materialize(moved)
        bursts.append((heads, moved.where("box is null").select(F.col("parent").alias("box"), "end", "xc", "xl", "xs")))
        current = moved.where("box is not null")

    containers = small[0]
    for df in small[1:]:
        containers = containers.unionByName(df)
    dealt = containers.repartition("box").sortWithinPartitions("box", "ids").select("r", "box", "parent", "up", "o", "ids", "words", "n", "least", "end", "xc", "xl", "xs")
    swept = materialize(dealt.mapInArrow(_swept(base), _SWEPT))
    node = ["conv_id", "depth", "up", "n_convs", "n_children", "n_leaves", "saved", "end"]
    nodes, tops = swept.where("not head").select(*node), swept.where("head").drop("head")
    for number in range(len(bursts), 0, -1):
        heads, stops = bursts[number - 1]
        kids = tops.where(F.col("r") == number).withColumn("saved", F.col("saved") + F.col("w") * (F.col("n_convs") - 1))
        sums = kids.groupBy("parent").agg(F.count("*").alias("c"), F.sum("n_leaves").alias("l"), F.sum("saved").alias("s")).withColumnRenamed("parent", "box")
        zero = lambda c: F.coalesce(c, F.lit(0))
        inner = heads.join(sums, "box").join(stops, "box", "left")
        inner = inner.withColumns({"n_children": F.col("c") + zero("xc"), "n_leaves": F.col("l") + zero("xl"), "inside": F.col("s") + zero("xs"), "k": F.col("to") - F.col("o")})
        total = lambda words: F.aggregate(words, F.lit(0).cast("long"), lambda a, x: a + x)
        inner = materialize(inner)
        steps = inner.where("k > 0").select("*", F.explode(F.sequence(F.lit(1), F.col("k"))).alias("i"))
        chain = steps.select(
            F.col("least").alias("conv_id"), (F.lit(base).cast("long") + F.col("o") + F.col("i")).alias("depth"), F.col("least").alias("up"), F.col("n").alias("n_convs"),
            F.when(F.col("i") == F.col("k"), F.col("n_children")).otherwise(1).alias("n_children"), "n_leaves",
            (F.col("inside") + (F.col("n") - 1) * total(F.slice("chain", F.col("i"), F.col("k")))).alias("saved"), F.when(F.col("i") == F.col("k"), F.col("end")).alias("end"),
        )
        above = inner.select(
            "r", "box", "parent", "up", F.col("least").alias("conv_id"), (F.lit(base).cast("long") + F.col("o")).alias("depth"), F.col("n").alias("n_convs"),
            F.when(F.col("k") > 0, 1).otherwise(F.col("n_children")).alias("n_children"), "n_leaves", (F.col("inside") + (F.col("n") - 1) * total("chain")).alias("saved"), "w", F.when(F.col("k") == 0, F.col("end")).alias("end"),
        )
        nodes = nodes.unionByName(kids.select(*node)).unionByName(chain)
        tops = tops.where(F.col("r") < number).unionByName(above)
    return nodes, tops


def _id_digests(ends: DataFrame) -> DataFrame:
    """ends (end, conv_id) -> end, ends_sha256: the digest of each end's ids in decimal, in numeric order, joined by commas.

    Sorted ranges of all rows are joined to pieces of text of IDS ids at most, and a digest reads the few pieces of its end one after the other, so
    an end of any number of ids is no task's memory."""

    def pieces(batches):
        end, first, ids = None, None, []
        for batch in batches:
            out = []
            for e, c in zip(batch.column("end").to_pylist(), batch.column("conv_id").to_pylist()):
                if ids and (e != end or len(ids) == IDS):
                    out.append((end, first, ",".join(ids)))
                    ids = []
                if not ids:
                    end, first = e, c
                ids.append(str(c))
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.string()))], ["end", "first", "piece"])
        if ids:
            yield pa.record_batch([pa.array([end], pa.binary()), pa.array([first], pa.int64()), pa.array([",".join(ids)])], ["end", "first", "piece"])

    def digests(batches):
        end, state = None, None
        for batch in batches:
            out = []
            for e, piece in zip(batch.column("end").to_pylist(), batch.column("piece").to_pylist()):
                if e != end:
                    if state is not None:
                        out.append((end, state.hexdigest()))
                    end, state = e, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(piece.encode())
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.string()))], ["end", "ends_sha256"])
        if state is not None:
            yield pa.record_batch([pa.array([end], pa.binary()), pa.array([state.hexdigest()])], ["end", "ends_sha256"])

    sorted_rows = ends.repartitionByRange("end", "conv_id").sortWithinPartitions("end", "conv_id")
    text = sorted_rows.mapInArrow(pieces, "end binary, first long, piece string")
    return text.repartition("end").sortWithinPartitions("end", "first").mapInArrow(digests, "end binary, ends_sha256 string")


def prefix_nodes(rows: DataFrame) -> DataFrame:
    """`turns` (or `rebuilt`) -> one row per distinct sequence of the first turns: conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs,
    n_children, n_leaves (childless nodes in its subtree), saved_tokens (summed over the subtree: one less than its members times the words of its last turn),
    ends_sha256 (of the ids of members that end there).

    Conversations are cut into pages of PAGE turns. The first pages of all, equal ones counted once, form a burst trie under the root, see `_burst_trie`; the
    next pages of conversations that share a first page one under the node where it ends, and so on; a page that only one conversation has is followed by a plain
    chain of its turns, however long. Sums return from the last pages to the first. Conversations without turns are members of the root. No conversations: no rows, not even a root."""
    rows = materialize(rows)
    convs = materialize(rows.groupBy("conv_id").agg(F.max("depth").alias("turns")))
    entry = F.sort_array(F.collect_list(F.struct("depth", "turn_id", "words")))
    pages = rows.where("depth > 0").groupBy("conv_id", F.floor((F.col("depth") - 1) / PAGE).alias("page")).agg(entry.alias("e"))
    pages = materialize(pages.select("conv_id", "page", F.col("e.turn_id").alias("ids"), F.col("e.words").alias("words")))

    levels, ends, alone = [], None, None
    open_ = convs.withColumn("hid", F.lit(b"").cast("binary"))
    while True:
        level = len(levels)
        here = open_.join(pages.where(F.col("page") == level).drop("page"), "conv_id", "left")
        here = here.withColumns({"ids": F.coalesce("ids", F.array().cast("array<binary>")), "words": F.coalesce("words", F.array().cast("array<bigint>"))})
        name = _digest(F.concat(F.lit(f"{level}:"), F.hex("hid"), F.array_join(F.transform("ids", lambda t: F.hex(t)), "")))
        stops = (F.col("turns") <= (level + 1) * PAGE) & (F.lit(level == 0) | (F.size("ids") > 0))
        here = here.withColumns({"cls": name, "stops": stops, "goes": F.col("turns") > (level + 1) * PAGE})
        here = materialize(here.select("conv_id", "turns", "hid", "cls", "stops", "goes", "ids", "words"))
        classes = here.groupBy("hid", "cls", "ids", "words").agg(F.count("*").alias("n"), F.min("conv_id").alias("least"), F.count_if("stops").alias("n_stops"), F.count_if("goes").alias("n_goes"))
        classes = materialize(classes)
        levels.append(classes)
        stopped = here.where("stops").select(F.col("cls").alias("end"), "conv_id")
        ends = stopped if ends is None else ends.union(stopped)
        if here.where("goes").isEmpty():
            break
        single = here.where("goes").join(classes.where("n = 1 and n_goes = 1").select("cls"), "cls").select("conv_id", "turns", F.lit((level + 1) * PAGE).alias("begin"))
        alone = single if alone is None else alone.union(single)
        open_ = here.join(classes.where("n > 1 and n_goes > 0").select("cls"), "cls").select("conv_id", "turns", F.col("cls").alias("hid"))

    nodes, below = None, None
    for level in range(len(levels) - 1, -1, -1):
        classes = levels[level].withColumn("end", F.when(F.col("n_stops") > 0, F.col("cls")))
        if below is None:
            classes = classes.withColumns({c: F.lit(0).cast("bigint") for c in ("xc", "xl", "xs")})
        else:
            single = classes.where("n = 1 and n_goes = 1").select("cls", F.lit(1).alias("xc"), F.lit(1).alias("xl"), F.lit(0).alias("xs"))
            classes = classes.join(single.unionByName(below), "cls", "left")
        classes = classes.withColumns({c: F.coalesce(F.col(c).cast("bigint"), F.lit(0)) for c in ("xc", "xl", "xs")})
        found, tops = _burst_trie(classes, level * PAGE)
        nodes = found if nodes is None else nodes.unionByName(found)
        below = tops.select(F.col("box").alias("cls"), F.col("n_children").alias("xc"), F.col("n_leaves").alias("xl"), F.col("saved").alias("xs"))
    nodes = nodes.unionByName(tops.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("up"), "n_convs", "n_children", "n_leaves", "saved", "end"))
    nodes = materialize(nodes)

    empty = hashlib.sha256(b"").hexdigest()
    named = nodes.where("end is not null").join(_id_digests(ends), "end").drop("end")
    out = named.unionByName(nodes.where("end is null").drop("end").withColumn("ends_sha256", F.lit(empty)))
    if alone is not None:
        deep = rows.where("depth > 0").join(alone, "conv_id").where("depth > begin")
        last = F.col("depth") == F.col("turns")
        out = out.unionByName(deep.select(
            "conv_id", "depth", F.col("conv_id").alias("up"), F.lit(1).cast("long").alias("n_convs"), F.when(last, 0).otherwise(1).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
            F.lit(0).cast("long").alias("saved"), F.when(last, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(empty)).alias("ends_sha256"),
        ))
    return out.select("conv_id", "depth", F.col("up").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), "ends_sha256")


def prefix_trie(conversations: DataFrame, stride: int | None = None, most: int = 4) -> DataFrame:
    """`prefix_nodes` of conversations (conv_id, turn, role, text), rebuilt with shared openings where a stride is given. Other columns are not read."""
    rows = turns(conversations)
    return prefix_nodes(rebuilt(rows, stride, most) if stride else rows)
