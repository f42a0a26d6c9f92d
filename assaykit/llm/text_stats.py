"""Dense statistics of whole texts, worked out for many documents at once."""

from __future__ import annotations

import numpy as np

from .arrays import SPACED, distinct_spans, word_spans

#: Shares of the bytes that are in each set.
BYTE_SETS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789", "stop": b".", "comma": b",", "colon": b":;", "shout": b"!", "ask": b"?",
    "bar": b"|", "marks": b"#$%&*@^~+=<>\\_", "slash": b"/", "quote": b"\"'`",
    "bracket": b"()[]{}", "dash": b"-", "line": b"\n",
}
NAMES = [
    "log_bytes", "log_words", *(f"share_{name}" for name in BYTE_SETS), "share_beyond_ascii",
    "word_bytes", "longest_word", "capital_words", "shouted_words", "marked_words", "bare_words",
    "distinct_words", "top_word", "again_words", "lines", "distinct_lines", "line_words",
]


def per_document(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the flags between the given places."""
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return np.diff(sums[first])


def tops(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """The greatest value of each owner, 0 where it has none."""
    out = np.zeros(n, np.int64)
    np.maximum.at(out, owner, values)
    return out


def repeats(codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per document: distinct codes and the count of the most frequent one."""
    n = len(first) - 1
    owner = np.repeat(np.arange(n), np.diff(first))
    size = int(codes.max(initial=0)) + 1
    pairs, times = np.unique(owner * size + codes, return_counts=True)
    return np.bincount(pairs // size, minlength=n), tops(times, pairs // size, n)


def statistics(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of NAMES per document; shares of an empty text are 0."""
    sizes = np.diff(offsets)
    size = np.maximum(sizes, 1)
    kind = np.zeros(256, np.uint8)
    for number, members in enumerate(BYTE_SETS.values(), 1):
        kind[list(members)] = number
    kinds = kind[raw]
    starts, ends, first = word_spans(raw, offsets, SPACED)
    codes, _ = distinct_spans(raw, starts, ends)
    codes = codes.astype(np.int64)
    words = np.diff(first)
    many = np.maximum(words, 1)
    owner = np.repeat(np.arange(len(sizes)), words)
    lengths = ends - starts

    def in_words(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[ends] - sums[starts]

    capitals, smalls = in_words(kinds == 1), in_words(kinds == 2)
    signs = in_words((kinds >= 7) & (kinds <= 14))
    letters = capitals + smalls + in_words(raw >= 128)
    again = np.zeros(len(codes), bool)
    again[1:] = (codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1])
    distinct, top = repeats(codes, first)
    line_starts, line_ends, line_first = word_spans(raw, offsets, np.arange(256) != 10)
    line_codes, _ = distinct_spans(raw, line_starts, line_ends)
    lines = np.diff(line_first)
    distinct_lines, _ = repeats(line_codes.astype(np.int64), line_first)
    columns = [
        np.log1p(sizes), np.log1p(words),
        *(per_document(kinds == i, offsets) / size for i in range(1, len(BYTE_SETS) + 1)),
        per_document(raw >= 128, offsets) / size,
        per_document(lengths, first) / many,
        np.log1p(tops(lengths, owner, len(sizes))),
        per_document((kinds[starts] == 1) if len(starts) else starts, first) / many,
        per_document((capitals > 1) & (smalls == 0), first) / many,
        per_document((signs > 0) & (letters > 0), first) / many,
        per_document(letters == 0, first) / many,
        distinct / many, top / many, per_document(again, first) / many,
        np.log1p(lines), distinct_lines / np.maximum(lines, 1), words / np.maximum(lines, 1),
    ]
    return np.stack([np.asarray(c, np.float64) for c in columns], 1)
