"""Language identification: averaged hashed subword embeddings with a linear softmax, trained by SGD in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duolog.llm._arrow import LOWER, SPACE, crc32_of, slices, text_bytes

#: Labelled rows that a model is trained on at most, by a hash of the id.
SAMPLE = 4_000
#: Buckets of subwords, width of embeddings, byte lengths of subwords.
BUCKETS, WIDTH, SIZES = 1 << 14, 16, (2, 3, 4)
EPOCHS, GROUP, STEP = 8, 32, 0.5
UNKNOWN = "und"
_TIMES = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)
_BLANK = np.arange(256, dtype=np.uint8)
_BLANK[SPACE] = 32
_BLANK[33:65] = _BLANK[91:97] = _BLANK[123:127] = 32
_PLAIN = _BLANK[LOWER]


def subwords(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Offsets of rows in bytes, and per size the bucket of the subword that ends at each byte: A-Z lower-cased, ASCII
    digits, signs and white space as blanks, so that beginnings and ends of words count; -1 where it would cross rows
    or holds two blanks in a row."""
    data, offsets = text_bytes(column)
    data = _PLAIN[data]
    blank = data == 32
    double = np.zeros(len(data), bool)
    double[1:] = blank[1:] & blank[:-1]
    wide = data.astype(np.uint32)
    place = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    out = []
    value = wide * _TIMES[0]
    bad = np.zeros(len(data), bool)
    for k in range(1, max(SIZES)):
        value = np.concatenate([np.zeros(1, np.uint32), value[:-1]]) * np.uint32(31) + wide * _TIMES[k] if len(data) else value
        bad = np.concatenate([np.ones(1, bool), bad[:-1]]) | double if len(data) else bad
        if k + 1 in SIZES:
            mixed = value ^ (value >> np.uint32(15))
            mixed = (mixed * np.uint32(0x2C1B3C6D)) >> np.uint32(18)
            out.append(np.where(bad | (place < k), -1, mixed.astype(np.int64)))
    return offsets, out


def bags(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per row its distinct buckets and their shares of its subwords."""
    offsets, by_size = subwords(column)
    out = []
    for a, b in zip(offsets[:-1], offsets[1:]):
        found = np.concatenate([s[a:b] for s in by_size])
        count = np.bincount(found[found >= 0], minlength=BUCKETS)
        some = np.flatnonzero(count)
        out.append((some, count[some] / max(count.sum(), 1)))
    return out


class Model:
    """Languages in order, and the logit that each bucket's embedding adds (embedding times softmax weights), ready for averaging."""

    def __init__(self, languages: list[str], table: np.ndarray, bias: np.ndarray, heat: float, floor: float):
        self.languages, self.table, self.bias, self.heat, self.floor = languages, table, bias, heat, floor

    def probabilities(self, column: pa.Array) -> np.ndarray:
        offsets, by_size = subwords(column)
        logits = np.zeros((len(offsets) - 1, len(self.languages)))
        total = np.zeros(len(offsets) - 1)
        for found in by_size:
            ok = found >= 0
            at = np.concatenate([[0], np.cumsum(ok)])[offsets]
            taken = found[ok]
            total += np.diff(at)
            for k in range(len(self.languages)):
                sums = np.concatenate([[0.0], np.cumsum(self.table[k][taken])])
                logits[:, k] += np.diff(sums[at])
        logits = (logits / np.maximum(total, 1)[:, None] + self.bias) / self.heat
        return _softmax(logits)


def _softmax(z):
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, languages: list[str], keep_rate: float = 0.99) -> Model:
    """Stochastic gradient descent over groups of rows, then a temperature and a rejection floor on every fifth row, which
    takes no part in the descent. The floor is the score that keep_rate of those rows reach."""
    n = len(languages)
    rng = np.random.default_rng(17)
    embed = rng.normal(0, 0.1, (BUCKETS, WIDTH))
    soft, bias = np.zeros((WIDTH, n)), np.zeros(n)
    check = np.arange(len(rows)) % 5 == 4
    learn = np.flatnonzero(~check)
    for epoch in range(EPOCHS):
        rate = STEP * (1 - epoch / EPOCHS) * 10
        order = rng.permutation(learn)
        for at in range(0, len(order), GROUP):
            group = order[at : at + GROUP]
            bag = np.zeros((len(group), BUCKETS))
            for k, i in enumerate(group):
                bag[k, rows[i][0]] = rows[i][1]
            mean = bag @ embed
            error = _softmax(mean @ soft + bias)
            error[np.arange(len(group)), y[group]] -= 1
            back = error @ soft.T
            soft -= rate * mean.T @ error / len(group)
            bias -= 0.1 * rate * error.mean(0)
            embed -= 8 * rate / len(group) * (bag.T @ back)
    table = (embed @ soft).T.copy()
    held = np.flatnonzero(check)
    logits = np.array([table[:, rows[i][0]] @ rows[i][1] + bias for i in held]).reshape(len(held), n)
    heat, floor = 1.0, 0.0
    if len(held):
        loss = lambda t: -np.log(np.maximum(_softmax(logits / t)[np.arange(len(held)), y[held]], 1e-12)).mean()
        heat = min(np.geomspace(0.1, 10, 41), key=loss)
        floor = float(np.quantile(_softmax(logits / heat).max(1), 1 - keep_rate))
    return Model(languages, table, bias, float(heat), floor)


def fit(docs: DataFrame, modulus: int = 4, held_out: int = 2, limit: int = SAMPLE) -> Model | None:
    """A model from at most `limit` whole texts with a language, outside the held-out fold, one text per id. Only their bags
    reach the driver, at most BUCKETS numbers each. None without such rows."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").where("doc_id is not null and lang is not null")
    chosen = known.where(fold != held_out).select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    sample = known.join(F.broadcast(chosen), "doc_id")

    def bag(batches):
        for part in slices(batches):
            found = bags(part.column("text"))
            yield pa.record_batch(
                [part.column("doc_id"), part.column("lang"), pa.array([f[0].astype(np.int32) for f in found], pa.list_(pa.int32())), pa.array([f[1].astype(np.float32) for f in found], pa.list_(pa.float32()))],
                ["doc_id", "lang", "buckets", "shares"],
            )

    table = sample.mapInArrow(bag, "doc_id long, lang string, buckets array<int>, shares array<float>")
    table = table.groupBy("doc_id").agg(F.min(F.struct("lang", "buckets", "shares")).alias("s")).select("doc_id", "s.*").toArrow()
    if not table.num_rows:
        return None
    table = table.combine_chunks()
    lists = lambda name: [x.values.to_numpy() for x in table.column(name)]
    rows = list(zip(lists("buckets"), lists("shares"), table.column("doc_id").to_pylist(), table.column("lang").to_pylist()))
    rows.sort(key=lambda r: (r[2], r[3]))
    languages = sorted({r[3] for r in rows})
    order = np.random.default_rng(3).permutation(len(rows))
    rows = [rows[i] for i in order]
    return train([(r[0].astype(np.int64), r[1].astype(float)) for r in rows], np.array([languages.index(r[3]) for r in rows]), languages)


def identified(docs: DataFrame, modulus: int = 4, held_out: int = 2, limit: int = SAMPLE) -> DataFrame:
    """(doc_id, text, lang) -> doc_id, held_out, lang_pred, score (calibrated probability), rejected, for every row and whole text.

    Languages are learnt from rows with a language whose crc32(doc_id as text) mod modulus is not held_out. Null
    texts and texts without a letter are `und` with score 0, as is every text if nothing could be learnt. rejected
    tells that the score lies below the floor that nearly all checked examples reach; lang_pred stays the best guess.
    Repeated rows repeat; a null id hashes as empty text. Other columns are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, modulus, held_out, limit))

    def identify(batches):
        m = model.value
        for part in slices(batches):
            texts = pc.fill_null(part.column("text"), "")
            letter = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
            if m is None:
                letter = np.zeros(len(letter), bool)
                best, score = [UNKNOWN] * len(letter), np.zeros(len(letter))
            else:
                p = m.probabilities(texts)
                score = np.where(letter, p.max(1), 0.0)
                best = [m.languages[k] if ok else UNKNOWN for k, ok in zip(p.argmax(1), letter)]
            rejected = ~letter | (score < (m.floor if m else 1))
            fold = crc32_of(part.column("doc_id")) % modulus == held_out
            yield pa.record_batch([part.column("doc_id"), pa.array(fold), pa.array(best, pa.string()), pa.array(score), pa.array(rejected)], ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return plain.mapInArrow(identify, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")
