"""BPE with word ends: splitting, speculative encoding with pairwise verification, decoding."""

from __future__ import annotations

import heapq
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from duolog.llm._arrow import LOWER, SPACE, Rolling, slices, text_bytes, words

#: Slots of a worker's table of encoded chunks at its start and at most, and ids that it keeps at most. A full table starts anew;
#: only for a single run of texts that holds more may it be larger, until the next run.
FEW, SLOTS, KEPT = 1 << 14, 1 << 21, 1 << 22
#: Symbols of a word up to which words are merged together, and how many of them; longer ones are merged on a heap.
SHORT, TOGETHER = 48, 4096
END = "</w>"
NEVER = 1 << 40
_STOP, _PLAIN = np.zeros(256, bool), np.zeros(256, bool)
_STOP[[ord(c) for c in ".,;:!?"]] = True
_PLAIN[65:91] = _PLAIN[97:123] = True


class Vocabulary:
    """A vocabulary file of the tokenizers library: BPE over UTF-8 bytes whose last symbol in a word carries an end mark."""

    def __init__(self, path: str):
        self.path, self.library = path, None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["end_of_word_suffix"] != END or model["type"] != "BPE":
            raise ValueError("a BPE vocabulary with word ends is needed")
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in (self.ids | self.special).items()}
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.exact = regex.compile(split)
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.ranks = {tuple(pair): k for k, pair in enumerate(model["merges"])}
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {b: chr(b) for b in visible}
        for b in range(256):
            shown.setdefault(b, chr(256 + b - sum(v < b for v in visible)))
        self.shown = [shown[b] for b in range(256)]
        #: Longest token inside and at the end of a word, by its first three symbols.
        self.inner, self.final = {}, {}
        for t in self.ids:
            body, reach = (t[: -len(END)], self.final) if t.endswith(END) else (t, self.inner)
            reach[body[:3]] = max(len(body), reach.get(body[:3], 0))
        spelled = [(self.names.get(i, "") + " ").encode() for i in range(max(self.names) + 1)]
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in spelled])])
        self._spines(model["merges"])

    def _spines(self, merges: list[list[str]]) -> None:
        """For every token the boundary symbols of its merge tree, outermost first, each with the rank at which
        its parent is merged: rows of `right` and `left` hold ids, of `right_until` and `left_until` ranks."""
        n = max(self.ids.values()) + 1
        made = np.full(n, -1, np.int64)
        parts = np.full((n, 2), -1, np.int64)
        keys = np.empty(len(merges), np.int64)
        for k, (a, b) in enumerate(merges):
            x, y, z = self.ids[a], self.ids[b], self.ids[a + b]
            keys[k] = x * n + y
            if made[z] < 0:
                made[z], parts[z] = k, (x, y)
        self.size, order = n, np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], order
        self.result = np.array([self.ids[a + b] for a, b in merges], np.int64)
        self.single = np.array([[self.ids.get(c + end, -1) for c in self.shown] for end in ("", END)], np.int64)
        never = len(merges) + 1
        out = []
        for side in (1, 0):
            nodes, until = [np.arange(n)], [np.full(n, never)]
            while True:
                held = nodes[-1]
                split = (held >= 0) & (parts[held, side] >= 0)
                if not split.any():
                    break
                until.append(np.where(split, made[held], -1))
                nodes.append(np.where(split, parts[held, side], -1))
            out.append((np.stack(nodes, 1), np.stack(until, 1)))
        (self.right, self.right_until), (self.left, self.left_until) = out

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of merging a with b, -1 if no such merge."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == key) & (a >= 0) & (b >= 0), self.pair_ranks[at], -1)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether tokens a and b stay apart when they stand side by side: no merge of a symbol on a's right
        edge with one on b's left edge comes before both are merged into their own parents. On equal rank
        the leftmost merge goes first: a's own before the crossing one, the crossing one before b's own."""
        fine = np.ones(len(a), bool)
        for i in range(self.right.shape[1]):
            x = self.right[a, i]
            if not (x >= 0).any():
                break
            for j in range(self.left.shape[1]):
                y = self.left[b, j]
                if not (y >= 0).any():
                    break
                rank = self.rank_of(x, y)
                fine &= ~((rank >= 0) & (rank < self.right_until[a, i]) & (rank <= self.left_until[b, j]))
        return fine

    def words(self, text: str) -> list[str]:
        """The words of a text, lower-cased character by character; special tokens as themselves (no word equals one).
        For characters that Python's Unicode tables do not know, the library's own pre-tokenizer decides."""
        if self.cut is not None and "<|" in text and len(pieces := self.cut.split(text)) > 1:
            return [w for p in pieces for w in ([p] if p in self.special else self.words(p))]
        if text.isascii():
            return [text.lower()] if text.isalpha() else self.exact.findall(text.lower())
        if not text.isalpha() and any(unicodedata.category(c) == "Cn" for c in text):
            if self.library is None:
                self.library = Tokenizer.from_file(self.path)
            plain = self.library.normalizer.normalize_str(text)
            return [plain[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(plain)]
        return self.exact.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def greedy(self, word: str) -> list[int]:
        """Longest match from the left."""
        s = word if word.isascii() and word.isalnum() else "".join([self.shown[b] for b in word.encode()])
        get, out, at, n = self.ids.get, [], 0, len(s)
        inner, final = self.inner.get, self.final.get
        while at < n:
            start = s[at : at + 3]
            found = get(s[at:] + END) if n - at <= final(start, 0) else None
            to = n
            if found is None:
                to = min(n - 1, at + max(inner(start, 0), 2))
                while to > at and (found := get(s[at:to])) is None:
                    to -= 1
                if found is None:
                    return []
            out.append(found)
            at = to
        return out

    def merged(self, found: list[str]) -> list[list[int]]:
        """Exact merging of words by rank; the leftmost pair goes first. Short words are merged together, one pair of each at a time."""
        raw = [w.encode() for w in found]
        size = np.array([len(r) for r in raw], np.int64)
        out: list[list[int]] = [[]] * len(found)
        for k in np.flatnonzero(size > SHORT).tolist():
            out[k] = self._merged_on_heap(raw[k])
        order = np.argsort(size, kind="stable")[: int((size <= SHORT).sum())]
        for at in range(0, len(order), TOGETHER):
            some = order[at : at + TOGETHER]
            n = size[some]
            symbols = np.full((len(some), int(n[-1])), -1, np.int64)
            data = np.frombuffer(b"".join([raw[k] for k in some.tolist()]), np.uint8)
            symbols[np.arange(symbols.shape[1]) < n[:, None]] = self.single[0][data]
            symbols[np.arange(len(some)), n - 1] = self.single[1][data[np.cumsum(n) - 1]]
            for k, row in self._merge_rows(symbols):
                out[some[k]] = row
        return out

    def _merge_rows(self, symbols: np.ndarray):
        """Rows of symbol ids, filled up with -1, until no pair of a row merges: (row number, its ids)."""
        ranked = lambda a, b: np.where((r := self.rank_of(a, b)) >= 0, r, NEVER)
        rank, row = ranked(symbols[:, :-1], symbols[:, 1:]), np.arange(len(symbols))
        while len(row):
            done = np.ones(len(row), bool)
            if rank.shape[1]:
                at = rank.argmin(1)
                least = rank[np.arange(len(row)), at]
                done = least >= NEVER
            for k in np.flatnonzero(done).tolist():
                ids = symbols[k]
                yield int(row[k]), ids[ids >= 0].tolist()
            if done.all():
                return
            symbols, rank, row, at, least = symbols[~done], rank[~done], row[~done], at[~done, None], least[~done]
            from_place = np.arange(symbols.shape[1] - 1)
            each = np.arange(len(row))
            symbols = np.take_along_axis(symbols, from_place + (from_place > at), 1)
            rank = np.take_along_axis(rank, from_place[:-1] + (from_place[:-1] > at), 1)
            at = at[:, 0]
            symbols[each, at] = self.result[least]
            for pair, there in ((at - 1, at > 0), (at, at < rank.shape[1])):
                k = each[there]
                rank[k, pair[there]] = ranked(symbols[k, pair[there]], symbols[k, pair[there] + 1])

    def _merged_on_heap(self, word: bytes) -> list[int]:
        """The same for one word in n log n steps: symbols are a linked list, pairs wait on a heap by rank and place. An entry whose
        symbols have since been merged with others is passed over."""
        s = [self.shown[b] for b in word]
        s[-1] += END
        rank, n = self.ranks.get, len(s)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, k, s[k], s[k + 1]) for k in range(n - 1) if (r := rank((s[k], s[k + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, k, left, right = heapq.heappop(heap)
            j = after[k]
            if s[k] != left or j >= n or s[j] != right:
                continue
            s[k], s[j] = left + right, ""
            after[k] = after[j]
            if after[k] < n:
                before[after[k]] = k
                if (r := rank((s[k], s[after[k]]))) is not None:
                    heapq.heappush(heap, (r, k, s[k], s[after[k]]))
            if before[k] >= 0 and (r := rank((s[before[k]], s[k]))) is not None:
                heapq.heappush(heap, (r, before[k], s[before[k]], s[k]))
        return [self.ids[x] for x in s if x in self.ids]

    def encode_words(self, found: list[str]) -> tuple[list[list[int]], int]:
        """Token ids of distinct words, and how many needed exact merging: propose by longest match, verify all
        adjacent pairs at once, merge only words with a pair that fails or without a proposal."""
        proposed = [self.greedy(w) for w in found]
        sizes = np.array([len(p) for p in proposed], np.int64)
        flat = np.fromiter((i for p in proposed for i in p), np.int64, int(sizes.sum()))
        bad = sizes == 0
        if len(flat) > 1:
            owner = np.repeat(np.arange(len(found)), sizes)
            inner = np.flatnonzero(owner[:-1] == owner[1:])
            pairs, which = np.unique(flat[inner] * self.size + flat[inner + 1], return_inverse=True)
            fine = self.compatible(pairs // self.size, pairs % self.size)[which]
            bad[owner[inner[~fine]]] = True
        failing = np.flatnonzero(bad).tolist()
        for k, ids in zip(failing, self.merged([found[k] for k in failing])):
            proposed[k] = ids
        return proposed, int(bad.sum())


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, loaded once in a worker."""
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


class _Store:
    """A worker's encoded chunks (runs between ASCII white space, which no word crosses), known by the 128 bits of two
    independent hashes in an open table that grows with what it holds; ids lie in one array."""

    def __init__(self, path: str):
        self.vocabulary = vocabulary(path)
        self.known = {t: [i] for t, i in self.vocabulary.special.items()}
        self.reset()

    def reset(self, slots: int = FEW) -> None:
        self._table(slots)
        self.ids = np.zeros(1 << 14, np.uint32)
        self.used = self.held = 0

    def _table(self, slots: int) -> None:
        self.keys = np.zeros((2, slots), np.uint64)
        self.start = np.full(slots, -1, np.int32)
        self.count = np.zeros(slots, np.int32)

    def find(self, h: np.ndarray, g: np.ndarray) -> np.ndarray:
        """Slots, -1 where a chunk is new. At most half of the slots are taken, so every search ends."""
        mask = len(self.start) - 1
        out = np.full(len(h), -1, np.int64)
        left = np.arange(len(h))
        slot = (h & np.uint64(mask)).astype(np.int64)
        while len(left):
            hit = (self.keys[0][slot] == h[left]) & (self.keys[1][slot] == g[left]) & (self.start[slot] >= 0)
            out[left[hit]] = slot[hit]
            more = ~hit & (self.start[slot] >= 0)
            left, slot = left[more], (slot[more] + 1) & mask
        return out

    def room_for(self, new: int) -> bool:
        """Make room for as many new chunks. False where the table started anew: what was found before is gone."""
        slots = len(self.start)
        while 2 * (self.held + new) > slots:
            slots *= 2
        if self.held and (slots > SLOTS or self.used > KEPT):
            self.reset()
            return False
        if slots > len(self.start):
            taken = np.flatnonzero(self.start >= 0)
            kept = self.keys[0][taken], self.keys[1][taken], self.start[taken], self.count[taken]
            self._table(slots)
            self._put(*kept)
        return True

    def _put(self, h: np.ndarray, g: np.ndarray, start: np.ndarray, count: np.ndarray) -> None:
        mask = len(self.start) - 1
        left = np.arange(len(h))
        slot = (h & np.uint64(mask)).astype(np.int64)
        while len(left):
            free = np.flatnonzero(self.start[slot] < 0)
            _, one = np.unique(slot[free], return_index=True)
            put = free[one]
            at, who = slot[put], left[put]
            self.keys[0][at], self.keys[1][at] = h[who], g[who]
            self.start[at], self.count[at] = start[who], count[who]
            rest = np.ones(len(left), bool)
            rest[put] = False
            left, slot = left[rest], (slot[rest] + 1) & mask

    def add(self, h: np.ndarray, g: np.ndarray, ids: list[list[int]]) -> None:
        """Put distinct new chunks into the table, which has room for them."""
        sizes = np.array([len(i) for i in ids], np.int64)
        total = int(sizes.sum())
        if self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(max(self.used, total), np.uint32)])
        self.ids[self.used : self.used + total] = np.fromiter((i for x in ids for i in x), np.uint32, total)
        self._put(h, g, self.used + np.cumsum(sizes) - sizes, sizes)
        self.used += total
        self.held += len(ids)

    def encode(self, chunks: list[str]) -> list[list[int]]:
        split = [self.vocabulary.words(c) for c in chunks]
        distinct = list({w for words in split for w in words} - self.known.keys())
        ids_of = self.known | dict(zip(distinct, self.vocabulary.encode_words(distinct)[0]))
        return [[i for w in words for i in ids_of[w]] for words in split]


_stores: dict[str, _Store] = {}


def _parted(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chunks with a last stop after an ASCII letter become two, as the words in them are, so that fewer chunks are distinct."""
    if not len(starts):
        return starts, ends, at
    cut = (ends - starts > 1) & _STOP[data[ends - 1]] & _PLAIN[data[np.maximum(ends - 2, 0)]]
    n = 1 + cut
    place = np.concatenate([[0], np.cumsum(n)])
    second = place[1:][cut] - 1
    starts, ends = np.repeat(starts, n), np.repeat(ends, n)
    starts[second] = ends[second] - 1
    ends[second - 1] -= 1
    return starts, ends, place[at]


def _distinct(h: np.ndarray, g: np.ndarray) -> np.ndarray:
    """A place of each distinct pair."""
    order = np.lexsort((g, h))
    first = np.ones(len(order), bool)
    first[1:] = (h[order][1:] != h[order][:-1]) | (g[order][1:] != g[order][:-1])
    return order[first]


def encoded(column: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all texts (unsigned 32-bit), and len + 1 offsets."""
    if path not in _stores:
        _stores[path] = _Store(path)
    store = _stores[path]
    data, offsets = text_bytes(column)
    if not (data[:-1] == 60)[data[1:] == 124].any():  # special tokens keep their case
        data = LOWER[data]
    starts, ends, at = words(data, offsets, SPACE[data])
    starts, ends, at = _parted(data, starts, ends, at)
    h, g = Rolling(data, 0)(starts, ends), Rolling(data, 1)(starts, ends)
    slots = store.find(h, g)
    new = np.flatnonzero(slots < 0)
    if len(new):
        new = new[_distinct(h[new], g[new])]
        while not store.room_for(len(new)):
            new = _distinct(h, g)
        raw = data.tobytes()
        store.add(h[new], g[new], store.encode([raw[a:b].decode() for a, b in zip(starts[new].tolist(), ends[new].tolist())]))
        slots = store.find(h, g)
    sizes = store.count[slots].astype(np.int64)
    ends = np.cumsum(sizes)
    ids = store.ids[np.repeat(store.start[slots] - (ends - sizes), sizes) + np.arange(int(sizes.sum()))]
    return ids, np.concatenate([[0], ends])[at]


def decoded(ids: np.ndarray, offsets: np.ndarray, path: str) -> pa.Array:
    """Texts of token ids: the tokens with a blank between them."""
    names, at = vocabulary(path).spelled
    sizes = (at[1:] - at[:-1])[ids]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    data = names[np.repeat(at[ids] - ends[:-1], sizes) + np.arange(int(ends[-1]))]
    raw, edge = data.tobytes(), ends[offsets].tolist()
    return pa.array([raw[a : b - 1] if b > a else b"" for a, b in zip(edge[:-1], edge[1:])], pa.binary()).cast(pa.string())


def codes(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) -> doc_id, ids (binary, little-endian unsigned 32-bit), decoded: the whole text encoded
    without added tokens, special tokens in the text as themselves, and decoded with a blank between tokens.

    Null and empty texts have no ids and decode to the empty text. Rows are independent: repeated rows and
    null ids give repeated results. Other columns are not read. The file is read on every worker."""

    def run(batches):
        for part in slices(batches):
            ids, offsets = encoded(part.column("text"), path)
            raw, edge = ids.astype("<u4").tobytes(), (4 * offsets).tolist()
            packed = pa.array([raw[a:b] for a, b in zip(edge[:-1], edge[1:])], pa.binary())
            yield pa.record_batch([part.column("doc_id"), packed, decoded(ids, offsets, path)], ["doc_id", "ids", "decoded"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return plain.mapInArrow(run, "doc_id long, ids binary, decoded string")


def code_digests(docs: DataFrame, path: str) -> DataFrame:
    """`codes` as doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return codes(docs, path).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
