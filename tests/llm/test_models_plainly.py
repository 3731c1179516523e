"""Quality statistics, boosted trees and language models against plain Python."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from duolog.llm import language_id, quality

TEXTS = [
    None, "", " \n\t", "a", "The cat sat.\nThe cat sat.\n\nOn THE mat!", "  lead and trail  ", "!!! $$$ ##", "é è ü ñ ü\nΩmega ÄÖ", "x" * 300 + " " + "y" * 40 + "\n" + "y" * 40, "A1 b2 C3\tD4\x0bE5\x0cF6\rG7", "one\n\n\none\ntwo", "aa bb  cc\n \n dd", "UPPER lower UPPer 12345", "日本語 テスト", "ab" * 40 + " " + "ba" * 40 + " " + "ab" * 40,
]


def plain_statistics(text):
    raw = (text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    if not words:
        return [0.0] * len(quality.STATISTICS)
    lower = [bytes(b + 32 if 65 <= b <= 90 else b for b in w) for w in words]
    lines = [x for x in raw.split(b"\n") if x]
    chars = sum(b & 0xC0 != 0x80 for b in raw)
    filled = [b for b in raw if b not in b" \t\n\x0b\x0c\r"]
    mark = lambda b: 33 <= b < 48 or 58 <= b < 65 or 91 <= b < 97 or 123 <= b < 127
    n, mean = len(words), sum(map(len, words)) / len(words)
    per = lambda test: sum(map(test, filled)) / len(filled)
    return [
        math.log1p(chars), math.log1p(n), mean, math.sqrt(max(0, sum(len(w) ** 2 for w in words) / n - mean**2)), per(lambda b: 65 <= b <= 90), per(lambda b: 48 <= b <= 57), per(mark),
        per(lambda b: mark(b) and chr(b) not in ".,;:!?'\"()-"), sum(b >= 192 for b in raw) / chars, max(1, len(lines)) / n, len(set(lower)) / n, len(set(lines)) / len(lines), max(Counter(lower).values()) / n,
        sum(sum(map(mark, w)) > 1 for w in words) / n, sum(a == b and b not in b" \t\n\x0b\x0c\r" for a, b in zip(raw, raw[1:])) / len(filled), sum(2 * sum(65 <= b <= 90 for b in w) > len(w) for w in words) / n,
        math.log1p(len(filled) / len(lines)), raw.count(b"!") / n,
    ]


def test_statistics_equal_plain_python():
    got = quality.statistics(pa.array(TEXTS, pa.string()))
    for text, row in zip(TEXTS, got):
        assert np.allclose(row, plain_statistics(text), rtol=1e-9, atol=1e-12), text
    assert np.allclose(quality.statistics(pa.array(TEXTS[4:6])), got[4:6])  # neighbours don't matter


def plain_boosting(x, y, trees, depth, bins, rate, ridge, least):
    """Every split of every bin edge tried by sums over rows; returns raw scores of the fitted rows."""
    mean = (sum(y) + 0.5) / (len(y) + 1)
    base = math.log(mean / (1 - mean))
    edges = [sorted(set(np.quantile([r[f] for r in x], np.linspace(0, 1, bins + 1)[1:-1]).tolist())) for f in range(len(x[0]))]
    raw = [base] * len(y)

    def grow(rows, left):
        g, h = sum(grad[i] for i in rows), sum(hess[i] for i in rows)
        best = (1e-6, None, None)
        if left and len(rows) >= 2 * least:
            for f, cuts in enumerate(edges):
                for cut in cuts:
                    low = [i for i in rows if x[i][f] <= cut]
                    if least <= len(low) <= len(rows) - least:
                        gl, hl = sum(grad[i] for i in low), sum(hess[i] for i in low)
                        gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge)
                        if gain > best[0] + 1e-9:
                            best = (gain, f, cut)
        if best[1] is None:
            for i in rows:
                step[i] = -rate * g / (h + ridge)
            return
        grow([i for i in rows if x[i][best[1]] <= best[2]], left - 1)
        grow([i for i in rows if x[i][best[1]] > best[2]], left - 1)

    for _ in range(trees):
        p = [1 / (1 + math.exp(-r)) for r in raw]
        grad, hess, step = [a - b for a, b in zip(p, y)], [max(a * (1 - a), 1e-9) for a in p], {}
        grow(list(range(len(y))), depth)
        raw = [r + step[i] for i, r in enumerate(raw)]
    return [1 / (1 + math.exp(-r)) for r in raw]


@pytest.mark.parametrize("seed", [1, 2])
def test_trees_equal_exhaustive_boosting(monkeypatch, seed):
    monkeypatch.setattr(quality, "TREES", 4)
    monkeypatch.setattr(quality, "DEPTH", 3)
    monkeypatch.setattr(quality, "BINS", 8)
    rng = np.random.default_rng(seed)
    x = np.stack([rng.normal(size=150), rng.integers(0, 4, 150).astype(float), rng.random(150) ** 3, np.full(150, 2.0)], 1)
    y = (x[:, 0] + (x[:, 1] == 2) + rng.normal(size=150) * 0.5 > 0.3).astype(float)
    model = quality.fit_trees(x, y)
    expected = plain_boosting(x.tolist(), y.tolist(), 4, 3, 8, quality.RATE, quality.RIDGE, quality.LEAST)
    assert np.allclose(model.scores(x), expected, rtol=1e-9) and len(model.roots) == 4


def plain_subwords(text):
    """Counts of buckets of byte runs of two to four: letters small, other ASCII as blanks, none with two blanks side by side."""
    raw = [b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()]
    raw = [b if b >= 128 or 97 <= b <= 122 or b < 32 and not 9 <= b <= 13 or b == 127 else 32 for b in raw]
    times, found = [0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], Counter()
    for end in range(len(raw)):
        for size in (2, 3, 4):
            run = raw[end - size + 1 : end + 1] if end + 1 >= size else []
            if not run or any(a == b == 32 for a, b in zip(run, run[1:])):
                continue
            value = 0
            for k, b in enumerate(run):
                value = ((value * 31 if k else 0) + b * times[k]) % 2**32
            value ^= value >> 15
            found[(value * 0x2C1B3C6D) % 2**32 >> 18] += 1
    return found


def test_subwords_and_bags_equal_plain_python():
    for text, (buckets, shares) in zip(TEXTS, language_id.bags(pa.array(TEXTS, pa.string()))):
        found = plain_subwords(text)
        assert buckets.tolist() == sorted(found) and np.allclose(shares, [found[b] / sum(found.values()) for b in sorted(found)])


def test_training_and_scores_equal_plain_python(monkeypatch):
    monkeypatch.setattr(language_id, "EPOCHS", 2)
    monkeypatch.setattr(language_id, "GROUP", 3)
    texts = ["the cat and the dog", "der Hund und die Katze", "le chat et le chien", "and then the end", "und dann das Ende", "et puis la fin", "that is that", "das ist das", "c'est la vie", "the the", "die die", "la la"]
    y, languages = np.array([0, 1, 2] * 4), ["en", "de", "fr"]
    bags = language_id.bags(pa.array(texts))
    model = language_id.train(bags, y, languages)

    rng = np.random.default_rng(17)
    embed = {b: v for b, v in enumerate(rng.normal(0, 0.1, (language_id.BUCKETS, language_id.WIDTH)).tolist())}
    width, n = language_id.WIDTH, 3
    soft, bias = [[0.0] * n for _ in range(width)], [0.0] * n

    def softmax(z):
        e = [math.exp(v - max(z)) for v in z]
        return [v / sum(e) for v in e]

    average = lambda bag: [sum(s * embed[b][d] for b, s in zip(*bag)) for d in range(width)]
    logits = lambda m: [sum(m[d] * soft[d][k] for d in range(width)) + bias[k] for k in range(n)]
    learn = [i for i in range(len(texts)) if i % 5 != 4]
    for epoch in range(2):
        rate, order = language_id.STEP * (1 - epoch / 2) * 10, rng.permutation(learn).tolist()
        for at in range(0, len(order), 3):
            group = order[at : at + 3]
            means = [average(bags[i]) for i in group]
            errors = [[p - (k == y[i]) for k, p in enumerate(softmax(logits(m)))] for i, m in zip(group, means)]
            backs = [[sum(e[k] * soft[d][k] for k in range(n)) for d in range(width)] for e in errors]
            for d in range(width):
                for k in range(n):
                    soft[d][k] -= rate * sum(m[d] * e[k] for m, e in zip(means, errors)) / len(group)
            for k in range(n):
                bias[k] -= 0.1 * rate * sum(e[k] for e in errors) / len(group)
            for i, back in zip(group, backs):
                for b, s in zip(*bags[i]):
                    embed[b] = [v - 8 * rate / len(group) * s * g for v, g in zip(embed[b], back)]
    checked = [i for i in range(len(texts)) if i % 5 == 4]
    loss = lambda t: -sum(math.log(max(softmax([v / t for v in logits(average(bags[i]))])[y[i]], 1e-12)) for i in checked)
    heat = min(np.geomspace(0.1, 10, 41), key=loss)
    assert model.heat == pytest.approx(heat)
    tops = [max(softmax([v / heat for v in logits(average(bags[i]))])) for i in checked]
    assert model.floor == pytest.approx(float(np.quantile(tops, 0.01)), rel=1e-6)
    some = [*texts, "a new text", "ein neuer Text", "", None]
    got = model.probabilities(pa.array(some, pa.string()))
    for text, row in zip(some, got):
        bag = plain_subwords(text)
        total = max(1, sum(bag.values()))
        expected = softmax([v / heat for v in logits(average((list(bag), [c / total for c in bag.values()])))])
        assert np.allclose(row, expected, rtol=1e-6, atol=1e-9)
