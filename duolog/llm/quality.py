"""Quality classifier: histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duolog.llm._arrow import LOWER, SPACE, Rolling, crc32_of, row_sums, slices, text_bytes, words

#: Labelled rows that a model is fitted on at most, chosen by a hash of the id.
SAMPLE = 20_000
#: Fit parameters.
TREES, DEPTH, BINS, RATE, RIDGE, LEAST = 60, 4, 64, 0.2, 1.0, 20

_UPPER, _LETTER, _DIGIT, _MARK, _WIDE = (np.zeros(256, bool) for _ in range(5))
_UPPER[65:91] = True
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_DIGIT[48:58] = True
_MARK[33:48] = _MARK[58:65] = _MARK[91:97] = _MARK[123:127] = True
_WIDE[192:] = True
_USUAL = np.zeros(256, bool)
_USUAL[[ord(c) for c in ".,;:!?'\"()-"]] = True
STATISTICS = (
    "log_chars", "log_words", "word_length", "word_spread", "upper", "digits", "marks", "odd_marks", "non_ascii", "lines_per_word",
    "distinct_words", "distinct_lines", "top_word", "marked_words", "repeated_bytes", "upper_words", "line_length", "exclaimed",
)


def statistics(column: pa.Array) -> np.ndarray:
    """One row of STATISTICS per text; all zero for null, empty and blank texts."""
    data, offsets = text_bytes(column)
    n = len(offsets) - 1
    out = np.zeros((n, len(STATISTICS)))
    if not len(data):
        return out
    starts, ends, at = words(data, offsets, SPACE[data])
    sizes = (ends - starts).astype(float)
    count = np.maximum(at[1:] - at[:-1], 1).astype(float)
    chars = np.maximum(row_sums((data & 0xC0) != 0x80, offsets), 1).astype(float)
    filled = np.maximum(offsets[1:] - offsets[:-1] - row_sums(SPACE[data], offsets), 1).astype(float)
    share = lambda table: row_sums(table[data], offsets) / filled
    hashes = Rolling(LOWER[data])(starts, ends)
    mean = row_sums(sizes, at) / count
    out[:, 0] = np.log1p(chars)
    out[:, 1] = np.log1p(at[1:] - at[:-1])
    out[:, 2] = mean
    out[:, 3] = np.sqrt(np.maximum(row_sums(sizes * sizes, at) / count - mean * mean, 0))
    out[:, 4], out[:, 5], out[:, 6] = share(_UPPER), share(_DIGIT), share(_MARK)
    out[:, 7] = share(_MARK & ~_USUAL)
    out[:, 8] = row_sums(_WIDE[data], offsets) / chars
    lines, line_ends, line_at = words(data, offsets, data == 10)
    line_hash = Rolling(data)(lines, line_ends)
    line_count = np.maximum(line_at[1:] - line_at[:-1], 1).astype(float)
    out[:, 9] = line_count / count
    for k in range(n):
        w = np.sort(hashes[at[k] : at[k + 1]])
        if len(w):
            edge = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1], [True]]))
            out[k, 10] = (len(edge) - 1) / len(w)
            out[k, 12] = np.diff(edge).max() / len(w)
        if line_at[k + 1] > line_at[k]:
            out[k, 11] = len(np.unique(line_hash[line_at[k] : line_at[k + 1]])) / line_count[k]
    marks = np.concatenate([[0], np.cumsum(_MARK[data])])
    out[:, 13] = row_sums(marks[ends] - marks[starts] > 1, at) / count
    same = np.zeros(len(data), bool)
    same[1:] = (data[1:] == data[:-1]) & ~SPACE[data[1:]]
    out[:, 14] = row_sums(same, offsets) / filled
    capitals = np.concatenate([[0], np.cumsum(_UPPER[data])])
    out[:, 15] = row_sums((capitals[ends] - capitals[starts]) * 2 > sizes, at) / count
    out[:, 16] = np.log1p(filled / line_count)
    out[:, 17] = row_sums(data == 33, offsets) / count
    out[at[1:] == at[:-1]] = 0
    return out


class Trees:
    """Boosted trees for a 0/1 label, flattened: node k tests feature[k] <= cut[k] and goes to left[k] or right[k];
    a leaf points to itself."""

    def __init__(self, base: float):
        self.base, self.roots = base, []
        self.feature, self.cut, self.left, self.right, self.value = [], [], [], [], []

    def node(self) -> int:
        k = len(self.value)
        for store, item in ((self.feature, 0), (self.cut, np.inf), (self.left, k), (self.right, k), (self.value, 0.0)):
            store.append(item)
        return k

    def freeze(self) -> Trees:
        for name in ("feature", "cut", "left", "right", "value", "roots"):
            setattr(self, name, np.array(getattr(self, name), float if name in ("cut", "value") else np.int64))
        return self

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 per row; all trees and rows go down one level at a time."""
        if not len(x) or not len(self.roots):
            return np.full(len(x), 1 / (1 + np.exp(-self.base)))
        node = np.repeat(self.roots[None, :], len(x), 0)
        row = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            node = np.where(x[row, self.feature[node]] <= self.cut[node], self.left[node], self.right[node])
        return 1 / (1 + np.exp(-(self.base + self.value[node].sum(1))))


def fit_trees(x: np.ndarray, y: np.ndarray) -> Trees:
    """Newton boosting of the logistic loss over quantile bins. One class only, or no rows: a constant."""
    mean = (y.sum() + 0.5) / (len(y) + 1)
    model = Trees(float(np.log(mean / (1 - mean))))
    if len(np.unique(y)) < 2:
        return model.freeze()
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)])
    raw = np.full(len(y), model.base)
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-9)
        root = model.node()
        model.roots.append(root)
        level = {root: np.arange(len(y))}
        for depth in range(DEPTH + 1):
            below = {}
            for k, rows in level.items():
                g, h = grad[rows].sum(), hess[rows].sum()
                model.value[k] = -RATE * g / (h + RIDGE)
                best = (1e-6, None)
                if depth < DEPTH and len(rows) >= 2 * LEAST:
                    for f, bins in enumerate(binned[:, rows]):
                        size = len(cuts[f]) + 1
                        gl = np.cumsum(np.bincount(bins, grad[rows], size))[:-1]
                        hl = np.cumsum(np.bincount(bins, hess[rows], size))[:-1]
                        nl = np.cumsum(np.bincount(bins, minlength=size))[:-1]
                        gain = gl**2 / (hl + RIDGE) + (g - gl) ** 2 / (h - hl + RIDGE) - g**2 / (h + RIDGE)
                        gain[(nl < LEAST) | (len(rows) - nl < LEAST)] = 0
                        if len(gain) and gain.max() > best[0]:
                            best = (gain.max(), (f, int(gain.argmax())))
                if best[1] is None:
                    raw[rows] += model.value[k]
                    continue
                f, b = best[1]
                model.feature[k], model.cut[k] = f, cuts[f][b]
                model.left[k], model.right[k] = model.node(), model.node()
                goes = binned[f, rows] <= b
                below[model.left[k]], below[model.right[k]] = rows[goes], rows[~goes]
            level = below
    return model.freeze()


def _chosen(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int, limit: int) -> DataFrame:
    """Rows (doc_id, text, y) of at most `limit` labelled ids outside the held-out fold, those that hash lowest.
    Unlabelled documents, null labels and ids that carry contradicting labels take no part."""
    known = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_y")).where("_id is not null and _y in (0, 1)")
    known = known.groupBy("_id").agg(F.min("_y").alias("y"), F.max("_y").alias("_most")).where("y = _most")
    fold = F.crc32(F.col("_id").cast("string").cast("binary")) % modulus
    chosen = known.where(fold != held_out).orderBy(F.xxhash64("_id"), "_id").limit(limit).select("_id", "y")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return plain.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "y")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int, limit: int) -> DataFrame:
    """(doc_id, text, y) of at most `limit` labelled documents, see `_chosen`. Where an id repeats, however often, one text of it is
    taken, combined before the shuffle."""
    text = F.min_by("text", F.xxhash64("text")).alias("text")
    return _chosen(docs, labels, label, modulus, held_out, limit).groupBy("doc_id", "y").agg(text).select("doc_id", "text", "y")


def fit(docs: DataFrame, labels: DataFrame, modulus: int = 3, held_out: int = 1, limit: int = SAMPLE) -> Trees:
    """A model from the statistics of a bounded sample, one text per id; only statistics and labels reach the driver."""

    def measure(batches):
        for part in slices(batches):
            x = statistics(part.column("text"))
            yield pa.record_batch([part.column("doc_id"), part.column("y"), *[pa.array(c) for c in x.T]], ["doc_id", "y", *STATISTICS])

    rows = _chosen(docs, labels, "quality", modulus, held_out, limit)
    rows = rows.mapInArrow(measure, "doc_id long, y int, " + ", ".join(f"{s} double" for s in STATISTICS))
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("y", *STATISTICS)).alias("s")).select("doc_id", "s.*").toPandas().sort_values("doc_id")
    return fit_trees(rows[list(STATISTICS)].to_numpy(), rows["y"].to_numpy(float))


def scored(docs: DataFrame, labels: DataFrame, modulus: int = 3, held_out: int = 1, limit: int = SAMPLE) -> DataFrame:
    """(doc_id, text) -> doc_id, held_out, score (probability of quality 1), predicted, for every row and whole text.

    Labels are learnt from rows whose crc32(doc_id as text) mod modulus is not held_out. Null, empty and blank texts
    have all-zero statistics and get that point's score. Repeated rows repeat their scores; a null id hashes
    as empty text. Without usable labels every score is a constant. Other columns are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, modulus, held_out, limit))

    def score(batches):
        for part in slices(batches):
            s = model.value.scores(statistics(part.column("text")))
            fold = crc32_of(part.column("doc_id")) % modulus == held_out
            yield pa.record_batch([part.column("doc_id"), pa.array(fold), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return plain.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs whose predicted quality is 1, each row judged by its own text; all columns kept, whatever they are called, nothing
    shuffled. Null, empty and blank texts are judged at the point of zeros; repeated rows stay or go together; an empty table stays
    empty. Without labels of both kinds all rows stay or go by the constant score."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def keep(batches):
        for part in slices(batches):
            yield part.filter(pa.array(model.value.scores(statistics(part.column("text"))) >= 0.5))

    return docs.mapInArrow(keep, docs.schema)
