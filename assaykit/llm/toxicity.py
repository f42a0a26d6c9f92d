"""Toxicity: boosted trees over dense features of a text, calibrated by isotonic regression.

The lexicon is a short fixed list and entries learned from labels: whole words and word beginnings
that are far more frequent in toxic documents, each with its log odds. Features for the trees are
computed with entries learned from other folds than the document's own, so that the trees see the
lexicon as it will work on new texts; the calibration sees scores of trees that did not learn
from the document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .arrays import LOWER, SPACED, chunked, distinct_spans, text_bytes, word_spans
from .boosting import boost, isotonic, margins
from .rule_ensemble import labelled_sample
from .tables import crc_fold, stored
from .text_stats import per_document, tops
from .token_counts import rows_batch

SAMPLE = 20_000
FOLDS = 3
#: Entries of the learned lexicon at most: those of the greatest log odds.
ENTRIES = 5_000
#: Log-likelihood ratio that a term's counts need against an even spread (chance below 1e-3).
EVIDENCE = 12.0
PREFIXES = (4, 5, 6)
TREES = 80
DEPTH = 3
#: Words on either side in which a second person counts as near.
NEAR = 3

LEXICON = set(
    "arschloch asshole bastard bitch bobo cabron clown clowns connard cretin cretino disgusting dreck "
    "dumb dumm estupido filth freak garbage gilipollas hate hijo idiot idiota idiote idioten idiots imbecil "
    "imbecile inutil jerk kill lame loser losers merde mierda moron morons pathetic pendejo pig puta retard "
    "scheisse schwein scum shit shut stupid stupide sucker trash trottel ugly vermin whore worthless".split())
SECOND_PERSON = set(
    "you your yours yourself u ur du dich dir dein deine deinen ihr euch euer sie tu te toi ton ta tes "
    "vous votre vos usted ustedes tus ti contigo vosotros".split())
#: Signs that stand for letters in words made hard to find.
LEET = bytes.maketrans(b"013457@$!|", b"oieastasil")

NAMES = [
    "hits", "share_hits", "distinct_hits", "sum_odds", "mean_odds", "top_odds", "fixed_hits",
    "share_fixed", "near_person", "share_near", "persons", "hidden_hits", "obfuscated", "capitals",
    "shouted_words", "shouts", "asks", "punctuation", "digits", "log_words",
]
_TERMS = "term binary, fold int, toxic long, other long"


def letters_table() -> np.ndarray:
    """Bytes of plain words: ASCII letters and all bytes beyond ASCII."""
    return np.array([b >= 128 or chr(b).isalpha() for b in range(256)])


def terms_of(word: bytes) -> list[bytes]:
    """The word, and its beginnings of some lengths, marked as such."""
    return [word, *(word[:n] + b"*" for n in PREFIXES if len(word) >= n)]


def term_counts(batches):
    """Per slice, term and fold: toxic and other documents that hold the term."""
    for batch in chunked(batches, "text"):
        raw, offsets = text_bytes(batch.column(2))
        low = LOWER[raw]
        starts, ends, first = word_spans(low, offsets, letters_table())
        if not len(starts):
            continue
        codes, words = distinct_spans(low, starts, ends)
        index: dict[bytes, int] = {}
        owned = [[index.setdefault(t, len(index)) for t in terms_of(w)] for w in words.to_pylist()]
        sizes = np.array([len(x) for x in owned])
        flat = np.array([i for x in owned for i in x])
        begins = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(batch.num_rows), np.diff(first))
        pairs = np.unique(owner * len(words) + codes)
        doc, word = pairs // len(words), pairs % len(words)
        many = sizes[word]
        term = flat[np.arange(many.sum()) + np.repeat(begins[word] - (np.cumsum(many) - many), many)]
        pairs = np.unique(np.repeat(doc, many) * len(index) + term)
        doc, term = pairs // len(index), pairs % len(index)
        fold, y = (batch.column(i).to_numpy().astype(np.int64)[doc] for i in (0, 1))
        cells, n = np.unique((term * FOLDS + fold) * 2 + y, return_counts=True)
        names = list(index)
        table = {}
        for cell, count in zip(cells.tolist(), n.tolist()):
            table.setdefault(cell // 2, [0, 0])[1 - cell % 2] += count
        yield rows_batch([(names[k // FOLDS], k % FOLDS, *v) for k, v in table.items()], _TERMS)


def learned_entries(sample: DataFrame, entries: int) -> tuple[list, np.ndarray]:
    """Terms with their counts by fold, (fold, toxic and other), those with the greatest odds; and
    the documents by fold.

    Only terms of at least two toxic documents, and more toxic than expected, come to the driver.
    """
    size = sample.groupBy("fold").agg(F.sum("y").alias("toxic"), F.count("*").alias("n")).collect()
    docs = np.zeros((FOLDS, 2))
    for r in size:
        docs[r.fold] = r.toxic, r.n - r.toxic
    toxic, other = docs.sum(0)
    counts = sample.select("fold", "y", "text").mapInArrow(term_counts, _TERMS).groupBy("term").agg(
        *[F.sum(F.when(F.col("fold") == k, F.col(c))).alias(f"{c}{k}")
          for k in range(FOLDS) for c in ("toxic", "other")],
        F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("other") + 0.5) / (other + 1))
    share = (toxic + 0.5) / (toxic + other + 1)
    seen = F.col("toxic") + F.col("other")
    evidence = 2 * (F.col("toxic") * F.log(F.col("toxic") / (seen * share)) + F.when(
        F.col("other") > 0, F.col("other") * F.log(F.col("other") / (seen * (1 - share)))).otherwise(0.0))
    top = (counts.where("toxic >= 2").withColumn("odds", odds).where("odds > 1.5")
           .where(evidence >= EVIDENCE)
           .orderBy(F.desc(F.col("odds") * F.log(F.col("toxic") + 1)), "term").limit(entries).collect())
    found = [(bytes(r.term), np.array([[r[f"toxic{k}"] or 0, r[f"other{k}"] or 0] for k in range(FOLDS)]))
             for r in top]
    return found, docs


def lexicon_odds(found: list, docs: np.ndarray, left_out: int | None) -> dict[bytes, float]:
    """Log odds of the entries, without the documents of one fold; only those that speak for
    toxic documents with at least two of them."""
    keep = [k for k in range(FOLDS) if k != left_out]
    toxic, other = docs[keep].sum(0)
    out = {}
    for term, counts in found:
        a, b = counts[keep].sum(0)
        odds = float(np.log((a + 0.5) / (toxic + 1)) - np.log((b + 0.5) / (other + 1)))
        share = (toxic + 0.5) / (toxic + other + 1)
        evidence = 2 * (a * np.log(max(a, 1) / ((a + b) * share + 1e-9))
                        + b * np.log(max(b, 1) / ((a + b) * (1 - share) + 1e-9)))
        if a >= 2 and odds > 1.5 and evidence >= EVIDENCE * len(keep) / FOLDS:
            out[term] = odds
    return out


def features(raw: np.ndarray, offsets: np.ndarray, odds: dict[bytes, float]) -> np.ndarray:
    """One row of NAMES per document; shares of an empty text are 0."""
    n, low = len(offsets) - 1, LOWER[raw]
    size = np.maximum(np.diff(offsets), 1)
    starts, ends, first = word_spans(low, offsets, letters_table())
    codes, words = distinct_spans(low, starts, ends)
    held = words.to_pylist()
    score = np.array([max((odds.get(t, 0.0) for t in terms_of(w)), default=0.0) for w in held] or [0.0])
    plain = [w.decode("utf-8", "replace") for w in held]
    fixed = np.array([w in LEXICON for w in plain] or [False])
    person = np.array([w in SECOND_PERSON for w in plain] or [False])
    codes = codes.astype(np.int64)
    count = np.diff(first)
    many = np.maximum(count, 1)
    owner = np.repeat(np.arange(n), count)
    word_odds, is_fixed, is_person = score[codes], fixed[codes], person[codes]
    hit = (word_odds > 0) | is_fixed
    close = np.zeros(len(codes), bool)
    for step in range(1, NEAR + 1):
        same = owner[step:] == owner[:-step]
        close[step:] |= same & is_person[:-step]
        close[:-step] |= same & is_person[step:]
    distinct = np.unique(owner[hit] * max(1, len(held)) + codes[hit]) // max(1, len(held))
    # Words with signs or digits among their letters, read with the signs as letters.
    s2, e2, f2 = word_spans(low, offsets, SPACED)
    codes2, words2 = distinct_spans(low, s2, e2)
    hidden = np.zeros(max(1, len(words2)), np.int64)
    mixed = np.zeros(max(1, len(words2)), bool)
    for i, w in enumerate(words2.to_pylist()):
        core = w.strip(b".,;:!?\"'()*#$%&-")
        if not core or core.isalpha():
            continue
        spelled = core.translate(LEET, b".,;:?\"'()*#%&-_+~^")
        if spelled != core and any(97 <= b <= 122 for b in core):
            mixed[i] = True
            hidden[i] = spelled.decode("utf-8", "replace") in LEXICON or any(
                odds.get(t, 0) > 0 for t in terms_of(spelled))
    capital = (raw >= 65) & (raw <= 90)
    small = (raw >= 97) & (raw <= 122)
    sums = np.concatenate([[0], np.cumsum(small, dtype=np.int64)])
    tall = np.concatenate([[0], np.cumsum(capital, dtype=np.int64)])
    shouted = (sums[e2] == sums[s2]) & (tall[e2] - tall[s2] > 1)
    sign = ((raw > 32) & (raw < 48)) | ((raw > 57) & (raw < 65)) | ((raw > 90) & (raw < 97)) | (
        (raw > 122) & (raw < 127))
    hits = per_document(hit, first)
    total = np.bincount(owner, word_odds, n) if len(owner) else np.zeros(n)
    columns = [
        hits, hits / many, np.bincount(distinct, minlength=n), total, total / many,
        tops((word_odds * 1000).astype(np.int64), owner, n) / 1000,
        per_document(is_fixed, first), per_document(is_fixed, first) / many,
        per_document(hit & close, first), per_document(hit & close, first) / many,
        per_document(is_person, first) / many,
        per_document(hidden[codes2] if len(codes2) else codes2, f2),
        per_document(mixed[codes2] if len(codes2) else codes2, f2) / np.maximum(np.diff(f2), 1),
        per_document(capital, offsets) / size,
        per_document(shouted, f2) / np.maximum(np.diff(f2), 1),
        per_document(raw == 33, offsets) / size, per_document(raw == 63, offsets) / size,
        per_document(sign, offsets) / size, per_document((raw > 47) & (raw < 58), offsets) / size,
        np.log1p(count),
    ]
    return np.stack([np.asarray(c, np.float64) for c in columns], 1)


def feature_rows(batches, tables: list[dict]):
    """Per labelled document: fold, label, and features by the entries of the other folds."""
    for batch in chunked(batches, "text"):
        raw, offsets = text_bytes(batch.column(3))
        fold = batch.column(1).to_numpy()
        x = np.zeros((batch.num_rows, len(NAMES)))
        for k in np.unique(fold):
            x[fold == k] = features(raw, offsets, tables[k])[fold == k]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], *(pa.array(c) for c in x.T)], names=["doc_id", "fold", "y", *NAMES])


class Model:
    """What scores texts: the lexicon's odds, the trees and the calibration."""

    def __init__(self, odds: dict, bias: float, trees: list, at: np.ndarray, values: np.ndarray):
        self.odds, self.bias, self.trees, self.at, self.values = odds, bias, trees, at, values

    def score(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        margin = margins(features(raw, offsets, self.odds), self.bias, self.trees)
        if not len(self.at):
            return 1 / (1 + np.exp(-margin))
        # A little of the margin keeps the order of scores that the calibration makes equal.
        step = np.interp(margin, self.at, self.values)
        return 0.999 * step + 0.001 / (1 + np.exp(-margin))


def learn_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE,
                   entries: int = ENTRIES) -> Model:
    chosen = stored(labelled_sample(docs, labels, label, sample).withColumn(
        "fold", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(FOLDS)).cast("int")))
    found, size = learned_entries(chosen, entries)
    tables = [lexicon_odds(found, size, k) for k in range(FOLDS)]
    ddl = ", ".join(["doc_id long, fold int, y int", *(f"{n} double" for n in NAMES)])
    held = chosen.select("doc_id", "fold", "y", "text").mapInArrow(
        lambda batches: feature_rows(batches, tables), ddl).orderBy("doc_id").toArrow()
    x = np.stack([held[n].to_numpy() for n in NAMES], 1)
    y, fold = held["y"].to_numpy().astype(np.float64), held["fold"].to_numpy()
    odds = lexicon_odds(found, size, None)
    bias, trees = boost(x, y, TREES if len(np.unique(y)) > 1 else 0, DEPTH)
    if len(np.unique(y)) < 2:
        return Model(odds, bias, [], np.zeros(0), np.zeros(0))
    unseen = np.zeros(len(y))
    for k in range(FOLDS):
        own, rest = fold == k, fold != k
        several = TREES if len(np.unique(y[rest])) > 1 else 0
        unseen[own] = margins(x[own], *boost(x[rest], y[rest], several, DEPTH)) if rest.any() else bias
    return Model(odds, bias, trees, *isotonic(unseen, y))


def scored_rows(batches, model: Model):
    for batch in chunked(batches, "text"):
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(model.score(*text_bytes(batch.column(1))))],
            names=["doc_id", "score"])


def score_toxicity(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = 0.5,
    sample: int = SAMPLE,
) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    `held_out` documents (crc32 of the id as text a multiple of 5) teach nothing; at most `sample`
    labelled documents do. The score is the calibrated probability of label 1 from the whole
    text; null counts as empty, and an empty text is scored like any other. Repeated rows are scored
    each; a null id is not held out. Without labels of both kinds every score is the share of
    label 1. An empty table gives no rows; other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = learn_toxicity(docs, labels, label, sample)
    scored = docs.mapInArrow(lambda batches: scored_rows(batches, model), "doc_id long, score double")
    return scored.select(
        "doc_id", F.coalesce(crc_fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
