import hashlib
import os
import random
import re
import zlib

import pytest

from duolog.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, box string"
COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def sequences(rows, stride=20):
    """Conversations in order of turn (null first; equal ones by digest of role and text), with shared openings."""
    digest = lambda role, text: hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own.setdefault(c, []).append((turn is not None, turn or 0, digest(role, text), role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    if not stride:
        return own
    h = {c: zlib.crc32(str(c).encode()) % 4 for c in own}
    return {c: own.get(c - c % stride, [])[: h[c]] + turns[h[c] :] for c, turns in own.items()}


def brute(rows, stride=20):
    """Every prefix of every sequence, its members and what follows."""
    members, ends, children = {}, {}, {}
    for c, turns in sequences(rows, stride).items():
        key = ()
        for turn in [None, *turns]:
            if turn is not None:
                children.setdefault(key, set()).add(turn)
                key = (*key, turn)
            members.setdefault(key, []).append(c)
        ends.setdefault(key, []).append(c)
    leaves, saved = {}, {}
    for key in sorted(members, key=len, reverse=True):
        below = [(*key, t) for t in children.get(key, ())]
        words = len(re.findall(r"[^\x20\x09-\x0D]+", key[-1][1])) if key else 0
        leaves[key] = sum(leaves[b] for b in below) or 1
        saved[key] = sum(saved[b] for b in below) + (len(members[key]) - 1) * words
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children.get(k, ())), leaves[k], saved[k], sha(ends.get(k, []))) for k, m in members.items())


def found(spark, rows, stride=20):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r[c] for c in COLUMNS) for r in prefix_trie.prefix_trie(df, stride).collect()), key=lambda r: (r[0], r[1]))


def corpus(rng, n, alphabet, longest):
    texts = [None, "", "  ", "a b", "a  b c\td"] + [f"t{k} " * (k % 5 + 1) for k in range(alphabet)]
    rows = []
    for c in rng.sample(range(-n, 2 * n), n) if n < 200 else range(n):
        turns = [(t, rng.choice(["user", "user", None, "tool"]), rng.choice(texts)) for t in range(rng.randrange(1, longest))]
        rows += [(c, None if rng.random() < 0.05 else t, role, text) for t, role, text in turns]
    return rows


def copies(n, turns, first=0):
    return [(c, t, "user", f"same {t}") for c in range(first, first + n) for t in range(turns)]


@pytest.mark.parametrize("limit, page", [(128, 512), (3, 512), (2, 2)])
def test_nodes_equal_all_prefixes(spark, monkeypatch, limit, page):
    monkeypatch.setattr(prefix_trie, "LIMIT", limit)
    monkeypatch.setattr(prefix_trie, "PAGE", page)
    monkeypatch.setattr(prefix_trie, "IDS", 4)
    rng = random.Random(limit * 10 + page)
    rows = corpus(rng, 60, 3, 6) + copies(14, 7, 500) + [(700, t, "user", f"same {t}") for t in range(12)]
    rows += [(900 + c, t, "user", f"opening {t}" if t < 4 else f"{c} {t}") for c in range(9) for t in range(7)]  # a shared opening, then apart
    rows += [(None, 1, "user", "nobody"), rows[0], rows[0]]
    rng.shuffle(rows)
    assert found(spark, rows) == brute(rows)
    if limit == 3:
        assert found(spark, rows, None) == brute(rows, None)


def test_many_copies_and_one_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PAGE", 16)
    rows = copies(300, 3) + [(1000, t, "user", f"long {t}") for t in range(400)] + [(1001, t, "user", f"long {t}" if t < 40 else "other") for t in range(60)]
    assert found(spark, rows) == brute(rows)


def test_turnless_conversations_nulls_and_empty_tables(spark):
    lone = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3)  # loses its three turns, and has no base
    rows = [(lone, t, "user", "x") for t in range(3)]
    assert found(spark, rows) == brute(rows) == [(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]
    assert found(spark, [(None, 0, "user", "x")]) == [] and found(spark, []) == []
    rows = [(1, 0, None, None), (2, 0, "", ""), (3, None, "user", "long " * 30_000), (3, 0, "user", "b")]
    assert found(spark, rows) == brute(rows)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    got = sorted((tuple(r[c] for c in COLUMNS) for r in prefix_trie.prefix_trie(df, 20).collect()), key=lambda r: (r[0], r[1]))
    assert got == brute(rows)
