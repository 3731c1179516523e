import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from duolog.llm import packing, word_bpe
from duolog.llm.queries import vocabulary_path

PATH = vocabulary_path()
ODD = ["", "   ", "it's we'll IT'S", "Σας ΟΔΟΣ", "İstanbul", "½ cup ² ⅷ x9 １２", "a_b__c", "aaaa aaaaaaaaaaaaaaaa", "日本語テスト", "é x y z \x1c a\x85b", "<|endoftext|", "x<|endoftext|>HELLO <|startoftext|>", "<|ENDOFTEXT|>", "😀😀", "࢏Ᲊ new", "THE the The " * 5000]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def texts():
    rng = random.Random(11)
    out = list(ODD)
    out += ["".join(rng.choice("aeinrst") for _ in range(rng.randrange(1, 30))) for _ in range(3000)]
    out += ["".join(rng.choice("ab' .") for _ in range(rng.randrange(1, 40))) for _ in range(1000)]
    out += ["".join(chr(c) if not 0xD800 <= c < 0xE000 else "x" for c in (rng.choice([rng.randrange(32, 127), rng.randrange(32, 0x3000), rng.randrange(0x110000)]) for _ in range(40))) for _ in range(300)]
    return out


def test_ids_and_text_equal_the_library(library):
    given = texts()
    ids, at = word_bpe.encoded(pa.array(given), PATH)
    decoded = word_bpe.decoded(ids, at, PATH).to_pylist()
    for k, e in enumerate(library.encode_batch(given, add_special_tokens=False)):
        assert ids[at[k] : at[k + 1]].tolist() == e.ids, given[k]
        assert decoded[k] == library.decode(e.ids, skip_special_tokens=False)


def test_verification_never_passes_a_wrong_proposal():
    v = word_bpe.vocabulary(PATH)
    words = [t for t in texts() if t.isascii() and t.isalpha()]
    assert v.encode_words(words)[0] == v.merged(words) == [v._merged_on_heap(w.encode()) for w in words]


def test_codes_of_null_and_extra_columns(spark):
    df = spark.createDataFrame([(1, None, "a"), (None, "the cat", "b"), (2, "", "c"), (2, "", "c")], "doc_id long, text string, ids string")
    got = {(r.doc_id, r.n_tokens) for r in word_bpe.code_digests(df, PATH).collect()}
    assert got == {(1, 0), (None, 2), (2, 0)} and word_bpe.code_digests(df, PATH).count() == 4


def test_pieces_and_sequences_are_whole(spark, library):
    docs = [(1, None), (2, ""), (3, "the cat " * 5000), (4, "dog"), (4, "dog"), (5, "a b c d e " * 700)]
    df = spark.createDataFrame([(d, t, 0) for d, t in docs], "doc_id long, text string, length long")
    got = packing.packed(df, PATH).collect()
    for d, t in {x[0]: x[1] for x in docs}.items():
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        mine = sorted({(r.piece, r.start, r.length, r.ids_crc32) for r in got if r.doc_id == d})
        assert mine == [(k, k * 4096, len(p), zlib.crc32(p.tobytes())) for k in range(-(-len(ids) // 4096)) for p in [ids[k * 4096 : (k + 1) * 4096]]]
    place = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == place.get(r.sequence_id, 0)
        place[r.sequence_id] = r.offset + r.length
    assert max(place.values()) <= 4096 and len(place) == -(-sum(place.values()) // 4096)
    assert packing.packed(df.limit(0), PATH).count() == 0
    whole = packing.sequences(df, PATH).collect()
    assert sorted(r.n_tokens for r in whole) == sorted(place.values()) and all(len(r.ids) == 4 * r.n_tokens for r in whole)


def test_local_search_empties_bins_and_loses_nothing():
    rng = random.Random(5)
    saved = 0
    for size, low, high in ((30, 700, 1700), (400, 700, 1700), (1500, 1300, 4000), (3000, 5, 900), (1, 9, 10), (0, 1, 2)):
        lengths = [rng.randrange(low, high) for _ in range(size)]
        bins = packing.Bins(np.array(lengths), 4096)
        first, squares = len(bins.items), (bins.fill**2).sum()
        bins.improve()
        left = [b for b in bins.items if b]
        assert sorted(i for b in left for i in b) == list(range(size))
        assert all(sum(lengths[i] for i in b) <= 4096 for b in left) and (bins.fill**2).sum() >= squares
        saved += first - len(left)
        assert len(left) >= bins.least()
    assert saved > 10


def test_least_is_a_lower_bound_and_full_search_reaches_it():
    assert packing.Bins(np.array([7, 7, 7]), 12).least() == 3 and packing.Bins(np.array([6, 6, 6, 6]), 12).least() == 2
    assert packing.Bins(np.array([9, 9, 4]), 12).least() == 3 and packing.Bins(np.zeros(0, np.int64), 12).least() == 0
    for lengths in ([5, 4, 8, 7], [3, 3, 3, 3, 6, 6, 12]):  # the first needs an exchange
        bins = packing.Bins(np.array(lengths), 12)
        bins.improve()
        assert sum(map(bool, bins.items)) == -(-sum(lengths) // 12)


def test_long_words_and_more_chunks_than_the_first_table(library):
    rng = random.Random(3)
    word = "".join(rng.choice("etaoinshrdlu") for _ in range(200_000))
    many = " ".join(f"{i:x}q{i * 7919 % 100003:x}" for i in range(60_000))
    given = [word, many, "a" * 5000, word[:70], "the cat", "\u00e9" * 400]
    ids, at = word_bpe.encoded(pa.array(given), PATH)
    for k, text in enumerate(given):
        assert ids[at[k] : at[k + 1]].tolist() == library.encode(text, add_special_tokens=False).ids


def thue_morse(n, letters="ab"):
    return "".join(letters[i.bit_count() % 2] for i in range(n))


def complements():
    """Two-letter words whose polynomial hashes modulo 2^64 agree with those of their complements, alone and in sentences."""
    return [w for n in (16, 64, 512, 1024, 2048, 4096) for t in ("{}", "the {} cat.") for letters in ("ab", "ba") for w in [t.format(thue_morse(n, letters))]]


def test_words_and_their_complements_keep_their_own_ids(spark, library):
    given = complements()
    expected = [library.encode(t, add_special_tokens=False).ids for t in given]
    ids, at = word_bpe.encoded(pa.array(given), PATH)
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == expected
    df = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string").repartition(2)
    digests = {r.doc_id: r.ids_sha256 for r in word_bpe.code_digests(df, PATH).collect()}
    assert digests == {k: hashlib.sha256(np.array(e, "<u4").tobytes()).hexdigest() for k, e in enumerate(expected)}
    pieces = {r.doc_id: (r.length, r.ids_crc32) for r in packing.packed(df, PATH).collect()}
    assert pieces == {k: (len(e) + 1, zlib.crc32(np.array([*e, 1], "<u4").tobytes())) for k, e in enumerate(expected)}


def test_table_starts_anew_and_grows(monkeypatch, library):
    monkeypatch.setattr(word_bpe, "SLOTS", 64)
    monkeypatch.setattr(word_bpe, "FEW", 16)
    monkeypatch.setattr(word_bpe, "_stores", {})
    for first in range(0, 400, 50):
        given = [" ".join(f"w{i}" for i in range(first, first + n)) for n in (3, 40, 200)]
        ids, at = word_bpe.encoded(pa.array(given), PATH)
        for k, text in enumerate(given):
            assert ids[at[k] : at[k + 1]].tolist() == library.encode(text, add_special_tokens=False).ids
