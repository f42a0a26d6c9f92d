import numpy as np
import pyarrow as pa
from cases import ALNUM as ALNUM_WORDS
from cases import SPACED as SPACED_WORDS

from assaykit.llm.arrays import (
    ALNUM, SPACED, chunked, gram_hashes, lowered_words, string_hashes, text_bytes, whole_grams,
)
from assaykit.llm.tables import pack, pack_sorted, unpack, unpack_sorted

TEXTS = ["One two\tTWO", "", None, " x ", "ü-ß 1a", "y" * 300 + " y"]


def test_words_are_those_of_the_patterns():
    raw, offsets = text_bytes(pa.array(TEXTS))
    for member, pattern in ((SPACED, SPACED_WORDS), (ALNUM, ALNUM_WORDS)):
        codes, words, first = lowered_words(raw, offsets, member)
        got = [words[c].as_py().decode() for c in codes.tolist()]
        split = [got[a:b] for a, b in zip(first[:-1], first[1:])]
        assert split == [pattern.findall((t or "").lower()) for t in TEXTS]


def test_hashes_do_not_depend_on_the_company():
    short = pa.array([b"one", b"two"], pa.large_binary())
    long = pa.array([b"one", b"x" * 1000, b"two", b"x" * 64 + b"y", b"y" * 64 + b"x"], pa.large_binary())
    a, b = string_hashes(short), string_hashes(long)
    assert a.tolist() == b[[0, 2]].tolist() and len(set(b.tolist())) == 5


def test_grams_stay_in_documents():
    first = np.array([0, 3, 3, 4, 9])
    assert whole_grams(first, 3).tolist() == [0, 4, 5, 6]
    hashes = np.arange(9, dtype=np.uint64)
    assert gram_hashes(hashes, 3)[4] == gram_hashes(hashes[4:7], 3)[0]


def test_slices_hold_all_rows():
    batch = pa.record_batch({"text": pa.array(["a" * 10] * 7 + ["b" * 50])})
    sizes = [b.num_rows for b in chunked(iter([batch, batch.slice(0, 0)]), "text", 25)]
    assert sum(sizes) == 8 and max(sizes) == 2


def test_packed_numbers_come_back():
    for values in ([], [0], [255, 256], [1 << 40]):
        assert unpack(pack(np.array(values, np.int64))).tolist() == values
    hashes = np.sort(np.array([1 << 63, 5, 17], np.uint64))
    assert unpack_sorted(pack_sorted(hashes)).tolist() == hashes.tolist()
