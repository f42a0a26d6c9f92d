"""Documents that are hard to handle, and plain versions of the operators' rules."""

import hashlib
import re

from pyspark.sql import types as T

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

STORY = "the quick brown fox jumps over the lazy dog while nine wise owls watch from an old oak tree"
#: (doc_id, text): nulls, empty and blank texts, repeats, a long text, odd characters.
HARD = [
    (1, STORY), (2, None), (3, ""), (4, " \n\t "), (5, STORY), (5, STORY), (6, STORY.upper() + "!!"),
    (7, "word " * 30_000), (8, "x" * 5_000), (9, "don't we'll it's <|endoftext|> a|b 12.5 é ü—ß İ"),
    (10, "one two three"), (11, "One Two  Three"), (12, STORY + " " + STORY + " and more"),
    (13, " no break　spaces \r\n\r\n end \x1f ."), (None, STORY), (None, None), (14, "日本語 の テキスト " * 40),
    (15, "a\n b\n\nc   d \n"), (16, STORY.replace("quick", "slow")),
]
#: Names that operators use inside, as extra columns of the input.
CLASHING = ["row", "score", "block", "shard", "value", "node", "label", "component", "u", "v", "n", "y"]


def frame(spark, rows, extra=True):
    """The rows as documents, with null columns of clashing names."""
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
    more = [T.StructField(name, T.StringType()) for name in (CLASHING if extra else [])]
    return spark.createDataFrame([(*r, *[None] * len(more)) for r in rows], T.StructType(fields + more))


def words(text, pattern=SPACED):
    return pattern.findall((text or "").translate(LOW))


def shingles(text, size=5):
    found = words(text)
    return frozenset(tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1))) if found else frozenset()


def components(rows, similar):
    """(n, component) of each row by comparing all pairs; null ids stand alone."""
    sets = [shingles(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (a, _) in enumerate(rows):
        for j, (b, _) in enumerate(rows[:i]):
            if a is not None and b is not None and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if a == b or similar(both, len(sets[i]) + len(sets[j]) - both):
                    parent[root(i)] = root(j)
    out = []
    for i, (a, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i)]
        out.append((a, len(sets[i]), min(ids) if a is not None else None))
    return out


def removed(rows, length):
    """(id, n_bytes, n_removed, n_spans, sha of the rest) by looking up every string."""
    first = {}
    for doc, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - length + 1):
            key = data[i : i + length]
            first[key] = min(first.get(key, (doc, i)), (doc, i))
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = [False] * len(data)
        for i in range(len(data) - length + 1):
            if first[data[i : i + length]] < (doc, i):
                gone[i : i + length] = [True] * length
        rest = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc, len(data), len(data) - len(rest), spans, hashlib.sha256(rest).hexdigest()))
    return out


def contaminated(rows, items, size=13):
    windows = {}
    for name, text in items:
        found = words(text, ALNUM) if name is not None else []
        for i in range(max(1, len(found) - size + 1) if found else 0):
            windows.setdefault(tuple(found[i : i + size]), set()).add(str(name))
    out = []
    for doc, text in rows:
        found, hit, names = words(text, ALNUM), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(found) - n + 1):
                if here := windows.get(tuple(found[i : i + n])):
                    names |= here
                    hit.update(range(i, i + n))
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((doc, len(found), len(hit), len(names), digest, bool(hit) and 20 * len(hit) >= len(found)))
    return out


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)
