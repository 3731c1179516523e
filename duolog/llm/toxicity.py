"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duolog.llm._arrow import LOWER, WORDLIKE, Rolling, crc32_of, slices, text_bytes, words
from duolog.llm.quality import labelled_sample
from duolog.llm._scratch import materialize

#: Labelled rows that the index holds at most, chosen by a hash of the id.
SAMPLE = 4_000
#: Texts whose products with all examples are held at once: 8 bytes times texts times examples.
TOGETHER = 256
#: Lengths in bytes of word beginnings that are terms beside whole words.
STEMS = (6,)
#: Least relevance of a term, and standard deviations from which it grows.
FAINT, SURE = 0.1, 3.0
#: Neighbours that vote, examples in a block of the index, and blocks that are read before the others are judged.
NEAREST, BLOCK, FIRST = 15, 64, 6
_WHOLE = np.uint64(0x5851F42D4C957F2D)


def _terms(column: pa.Array):
    """(row, term) of all whole words (runs of letters, digits and non-ASCII characters, A-Z lower-cased) and word beginnings."""
    data, offsets = text_bytes(column)
    data = LOWER[data]
    starts, ends, at = words(data, offsets, ~WORDLIKE[data])
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(at))
    rolling = Rolling(data)
    rows, terms = [owner], [rolling(starts, ends) ^ _WHOLE]
    for size in STEMS:
        long = np.flatnonzero(ends - starts > size)
        rows.append(owner[long])
        terms.append(rolling(starts[long], starts[long] + size))
    return np.concatenate(rows), np.concatenate(terms)


class Lookup:
    """Places of terms in a sorted vocabulary, behind a bitmap that turns most others away."""

    def __init__(self, terms: np.ndarray):
        self.terms = terms
        self.bits = np.zeros(1 << 21, bool)
        self.bits[(terms & np.uint64(0x1FFFFF)).astype(np.int64)] = True

    def counts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, term place, count), sorted."""
        rows, terms = _terms(column)
        maybe = np.flatnonzero(self.bits[(terms & np.uint64(0x1FFFFF)).astype(np.int64)])
        if not len(maybe) or not len(self.terms):
            none = np.zeros(0, np.int64)
            return none, none, none
        place = np.minimum(np.searchsorted(self.terms, terms[maybe]), len(self.terms) - 1)
        hit = self.terms[place] == terms[maybe]
        key, n = np.unique(rows[maybe][hit] * len(self.terms) + place[hit], return_counts=True)
        return key // len(self.terms), key % len(self.terms), n


def document_frequency(docs: DataFrame, lookup: Lookup) -> tuple[np.ndarray, int]:
    """In how many of all documents each term occurs, and how many documents there are."""
    shared = docs.sparkSession.sparkContext.broadcast(lookup)

    def count(batches):
        found = shared.value
        df, n = np.zeros(len(found.terms), np.int64), 0
        for part in slices(batches):
            df += np.bincount(found.counts(part.column("text"))[1], minlength=len(df))
            n += part.num_rows
        some = np.flatnonzero(df)
        yield pa.record_batch([pa.array(np.append(some, -1)), pa.array(np.append(df[some], n))], ["term", "n"])

    rows = docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    term, n = rows.column("term").to_numpy(), rows.column("n").to_numpy()
    df = np.zeros(len(lookup.terms), np.int64)
    df[term[term >= 0]] = n[term >= 0]
    return df, int(n[term < 0].sum())


def relevance(n: np.ndarray, ones: np.ndarray, rate: float) -> np.ndarray:
    """Factor of a term by what the sample tells of it: FAINT for most; up to 1 as the count of label 1 among its n examples
    lies SURE standard deviations and more above chance."""
    z = (ones - n * rate) / np.sqrt(np.maximum(n * rate * (1 - rate), 1e-9))
    return FAINT + (1 - FAINT) * np.clip((z - SURE) / 5, 0, 1)


def _runs(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """All numbers of the ranges lo to hi, one range after the other."""
    n = hi - lo
    return np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


class Index:
    """Examples as unit vectors, inverted by term in blocks of BLOCK examples with each block's largest weight. Terms that more than
    a tenth of the examples hold are rows of a matrix instead. `factor` is each term's inverse document frequency times its relevance."""

    def __init__(self, lookup: Lookup, factor: np.ndarray, rows: np.ndarray, terms: np.ndarray, counts: np.ndarray, y: np.ndarray, ids: np.ndarray):
        self.lookup, self.factor = lookup, factor
        rows, terms, weight = self.unit(rows, terms, counts, len(y))
        held = np.unique(rows)
        bare = np.setdiff1d(np.arange(len(y)), held)
        #: Score of a text without any term: the share of label 1 among such examples.
        self.bare = (y[bare].sum() + 0.1) / (len(bare) + 1.0)
        order = self._alike(np.searchsorted(held, rows), terms, weight, len(held))
        self.ids, self.y = ids[held][order], y[held][order]
        place = np.empty(len(held), np.int64)
        place[order] = np.arange(len(held))
        rows = place[np.searchsorted(held, rows)]
        self.blocks = -(-len(held) // BLOCK)
        common = np.flatnonzero(np.bincount(terms, minlength=len(factor)) * 10 > len(held))
        self.seat = np.full(len(factor), -1)
        self.seat[common] = np.arange(len(common))
        self.matrix = np.zeros((len(common), self.blocks * BLOCK))
        often = self.seat[terms] >= 0
        self.matrix[self.seat[terms[often]], rows[often]] = weight[often]
        rows, terms, weight = rows[~often], terms[~often], weight[~often]
        order = np.lexsort((rows, terms))
        self.row, self.weight, terms = rows[order].astype(np.int32), weight[order], terms[order]
        block = self.row // BLOCK
        first = np.ones(len(terms), bool)
        first[1:] = (terms[1:] != terms[:-1]) | (block[1:] != block[:-1])
        #: One entry per term and block: its block, largest weight, and where its postings begin.
        self.begin = np.append(np.flatnonzero(first), len(terms))
        self.block = block[self.begin[:-1]].astype(np.int16 if self.blocks < 1 << 15 else np.int32)
        self.most = np.maximum.reduceat(self.weight, self.begin[:-1]) if len(terms) else np.zeros(0)
        self.entry = np.searchsorted(terms[self.begin[:-1]], np.arange(len(factor) + 1))
        self.slope, self.shift = 1.0, 0.0

    @staticmethod
    def _alike(rows: np.ndarray, terms: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
        """An order that puts like examples side by side, so that blocks have tight bounds: by the signs of three
        principal components over the commonest terms, then by the largest weight. Any order gives the same results."""
        common = np.argsort(-np.bincount(terms, minlength=1), kind="stable")[:128]
        seat = np.full(terms.max(initial=0) + 1, -1)
        seat[common] = np.arange(len(common))
        some = seat[terms] >= 0
        dense = np.zeros((n, 128))
        dense[rows[some], seat[terms[some]]] = weight[some]
        _, axes = np.linalg.eigh(dense.T @ dense)
        side = (dense - dense.sum(0) / max(n, 1)) @ axes[:, -4:-1] > 0
        top = np.zeros(n)
        np.maximum.at(top, rows, weight)
        return np.lexsort((top, side @ np.array([1, 2, 4])))

    def unit(self, rows, terms, counts, n):
        weight = (1 + np.log(counts)) * self.factor[terms]
        norm = np.sqrt(np.bincount(rows, weight * weight, n))
        return rows, terms, weight / np.where(norm[rows] > 0, norm[rows], 1)

    def start(self, rows: np.ndarray, terms: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
        """Of n texts, what the common terms add to the cosine with each example."""
        often = self.seat[terms] >= 0
        dense = np.zeros((n, len(self.matrix)))
        dense[rows[often], self.seat[terms[often]]] = weight[often]
        return dense @ self.matrix

    def nearest(self, terms: np.ndarray, weight: np.ndarray, start: np.ndarray, k: int, skip: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The k examples with the largest cosine above zero, exactly: the FIRST blocks by their bounds, then those of the others whose
        bound may still beat the k-th cosine found there. A bound is the largest start of the block and the largest weights of its lists.
        Ties go to the example that comes first. `skip` is the id of one to leave out."""
        rare = self.seat[terms] < 0
        terms, weight = terms[rare], weight[rare]
        lo, hi = self.entry[terms], self.entry[terms + 1]
        entries = _runs(lo, hi)
        load = np.repeat(weight, hi - lo)
        block = self.block[entries]
        bound = start.reshape(self.blocks, BLOCK).max(1) + np.bincount(block, load * self.most[entries], self.blocks)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        score = np.zeros(self.blocks * BLOCK)
        least = 0.0
        for now in (order[:FIRST], order[FIRST:]):
            now = now[bound[now] >= least - 1e-12]
            chosen = np.zeros(self.blocks, bool)
            chosen[now] = True
            take = np.flatnonzero(chosen[block])
            begin, end = self.begin[entries[take]], self.begin[entries[take] + 1]
            at = _runs(begin, end)
            score.reshape(self.blocks, BLOCK)[now] = start.reshape(self.blocks, BLOCK)[now]
            score += np.bincount(self.row[at], np.repeat(load[take], end - begin) * self.weight[at], len(score))
            if skip is not None:
                score[: len(self.ids)][self.ids == skip] = 0
            if least == 0 and len(score) > k:
                least = max(0.0, np.partition(score, len(score) - k)[len(score) - k])
        some = np.flatnonzero((score > 0) & (score >= least - 1e-9))
        top = some[np.lexsort((some, -np.round(score[some], 12)))[:k]]
        return top, score[top]

    def vote(self, ids: np.ndarray, cosine: np.ndarray) -> float:
        """Share of label 1 among neighbours, each weighted by the inverse of its distance."""
        if not len(ids):
            return self.bare
        w = 1 / (1.02 - np.minimum(cosine, 1))
        return float((w * self.y[ids]).sum() / w.sum())

    def votes(self, column: pa.Array, skip: list | None = None) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Of each text: whether it has neighbours, its vote, and the voting examples, nearest first."""
        n = len(column)
        rows, terms, weight = self.unit(*self.lookup.counts(column), n)
        at = np.searchsorted(rows, np.arange(n + 1))
        near, votes, evidence = np.zeros(n, bool), np.full(n, self.bare), [np.zeros(0, np.int64)] * n
        for low in range(0, n if self.blocks else 0, TOGETHER):
            high = min(n, low + TOGETHER)
            a, b = at[low], at[high]
            start = self.start(rows[a:b] - low, terms[a:b], weight[a:b], high - low)
            for i in np.unique(rows[a:b]):
                ids, cosine = self.nearest(terms[at[i] : at[i + 1]], weight[at[i] : at[i + 1]], start[i - low], NEAREST, skip[i] if skip else None)
                if len(ids):
                    near[i], votes[i], evidence[i] = True, self.vote(ids, cosine), self.ids[ids]
        return near, votes, evidence

    def calibrate(self, votes: np.ndarray, y: np.ndarray) -> None:
        """Fit score = sigmoid(slope * logit(vote) + shift) to the examples, each voted on by the others."""
        if len(np.unique(y)) < 2:
            return
        z = _logit(votes)
        a, c = 1.0, 0.0
        for _ in range(30):
            p = 1 / (1 + np.exp(-(a * z + c)))
            g, h = p - y, np.maximum(p * (1 - p), 1e-6)
            m = np.array([[(h * z * z).sum() + 1, (h * z).sum()], [(h * z).sum(), h.sum() + 1]])
            step = np.linalg.solve(m, [(g * z).sum() + a - 1, g.sum() + c])
            a, c = a - step[0], c - step[1]
            if np.abs(step).max() < 1e-6:
                break
        self.slope, self.shift = max(a, 0.1), c

    def score(self, column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
        """Calibrated score and the voting examples of each text."""
        near, votes, evidence = self.votes(column)
        return np.where(near, 1 / (1 + np.exp(-(self.slope * _logit(votes) + self.shift))), self.bare), evidence


def _logit(p):
    p = np.clip(p, 0.01, 0.99)
    return np.log(p / (1 - p))


def fit(docs: DataFrame, labels: DataFrame, modulus: int = 5, held_out: int = 0, limit: int = SAMPLE) -> Index:
    """An index of at most `limit` labelled examples over all of their terms; frequencies are over all of docs. Only the
    examples' terms reach the driver. Without labels of both kinds every text gets the same score."""
    sample = materialize(labelled_sample(docs, labels, "toxic", modulus, held_out, limit).repartition(8))

    def count(batches):
        for part in slices(batches):
            rows, terms = _terms(part.column("text"))
            order = np.lexsort((terms, rows))
            rows, terms = rows[order], terms[order]
            first = np.ones(len(rows), bool)
            first[1:] = (rows[1:] != rows[:-1]) | (terms[1:] != terms[:-1])
            begin = np.flatnonzero(first)
            n = np.diff(np.append(begin, len(rows))).astype(np.int32)
            at = pa.array(np.searchsorted(rows[begin], np.arange(part.num_rows + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(at, pa.array(v)) for v in (terms[begin].view(np.int64), n)]
            yield pa.record_batch([part.column("doc_id"), part.column("y"), *lists], ["doc_id", "y", "terms", "counts"])

    found = sample.mapInArrow(count, "doc_id long, y int, terms array<long>, counts array<int>").toArrow().combine_chunks().sort_by("doc_id")
    y, ids = found.column("y").to_numpy().astype(float), found.column("doc_id").to_numpy()
    flat = lambda name: found.column(name).combine_chunks().flatten().to_numpy()
    rows = np.repeat(np.arange(len(y)), found.column("terms").combine_chunks().value_lengths().to_numpy()) if len(y) else np.zeros(0, np.int64)
    if not 0 < y.sum() < len(y):
        none = np.zeros(0, np.int64)
        return Index(Lookup(none.view(np.uint64)), np.zeros(0), none, none, none, y, ids)
    vocabulary, place = np.unique(flat("terms").view(np.uint64), return_inverse=True)
    lookup = Lookup(vocabulary)
    df, total = document_frequency(docs, lookup)
    told = relevance(np.bincount(place, minlength=len(vocabulary)), np.bincount(place, y[rows], len(vocabulary)), y.mean())
    index = Index(lookup, (np.log((total + 1) / (df + 1)) + 1) * told, rows, place, flat("counts"), y, ids)
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def others(batches):
        for part in slices(batches):
            _, votes, _ = shared.value.votes(part.column("text"), part.column("doc_id").to_pylist())
            yield pa.record_batch([part.column("y"), pa.array(votes)], ["y", "vote"])

    judged = sample.mapInArrow(others, "y int, vote double").toArrow()
    index.calibrate(judged.column("vote").to_numpy(), judged.column("y").to_numpy().astype(float))
    return index


def scored(docs: DataFrame, labels: DataFrame, modulus: int = 5, held_out: int = 0, limit: int = SAMPLE) -> DataFrame:
    """(doc_id, text) -> doc_id, held_out, score (probability of toxic 1), predicted, evidence (ids of the voting examples, nearest
    first) for every row and whole text.

    Labels are learnt from rows whose crc32(doc_id as text) mod modulus is not held_out. Vectors hold every term of the examples,
    weighted by (1 + log count) * inverse document frequency * relevance; terms that no example has can meet none. Texts
    without any such term, null and empty ones among them, get the share of label 1 among such examples. Repeated rows
    repeat their scores; a null id hashes as empty text. An empty table gives no rows. Other columns are not read.
    """
    index = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, modulus, held_out, limit))

    def score(batches):
        for part in slices(batches):
            s, evidence = index.value.score(part.column("text"))
            fold = crc32_of(part.column("doc_id")) % modulus == held_out
            yield pa.record_batch(
                [part.column("doc_id"), pa.array(fold), pa.array(s), pa.array((s >= 0.5).astype(np.int32)), pa.array(evidence, pa.list_(pa.int64()))],
                ["doc_id", "held_out", "score", "predicted", "evidence"],
            )

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return plain.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int, evidence array<long>")


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs that are not predicted toxic, each row judged by its own text; all columns kept, whatever they are called, nothing
    shuffled. Null and empty texts have no term and stay unless most such examples are toxic; repeated rows stay
    or go together; an empty table stays empty. Without labels of both kinds all rows stay or go by the constant score."""
    index = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def keep(batches):
        for part in slices(batches):
            yield part.filter(pa.array(index.value.score(part.column("text"))[0] < 0.5))

    return docs.mapInArrow(keep, docs.schema)
