"""Quality rules: base counts of a text, and a hashed n-gram likelihood ratio.

Method: the byte ``NGRAM``-grams of a text are hashed into ``BUCKETS`` buckets.
One pass over all documents counts two multinomials, that of trusted texts and
that of the raw corpus.  A document's score is the mean over its n-grams of
log P(bucket | trusted) - log P(bucket | raw): the log-likelihood ratio divided
by the length.  The threshold is a fixed quantile of the scores of all rows
labelled good; every document is held against it, so the verdict is deterministic.

Trusted texts are all rows labelled good; the raw counts are of all documents.

Defined results: null or empty text has zero words and lines and fails the base
rules; a text shorter than an n-gram scores 0; without trusted rows the ratio
is 0 everywhere and the base rules decide alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saferow.llm.common import (NON_SPACE, byte_class, chunks, gram_hashes, inside_row, scramble, span_hashes, stored,
                                words)
from saferow.operators.quantiles import exact_quantiles

NGRAM, BUCKETS = 4, 1 << 16
#: Most trusted rows whose ids (8 bytes each) are sent to every task; more are joined by shuffle.
TRUSTED_ROWS = 1_000_000
#: The threshold: this quantile of the scores of all rows labelled good.
TRUSTED_QUANTILE = 0.002
MIN_WORDS, MAX_REPEAT_PERCENT, REPEAT_WINDOW = 10, 20, 5
SYMBOL = byte_class(*[(ord(c), ord(c)) for c in "#*$%&|<>"])
_LINE = np.arange(256) != 10


def _row_sums(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[off[1:]] - total[off[:-1]]


def base_counts(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """The five counts of each row of a chunk."""
    starts, ends, first = words(data, off, NON_SPACE)
    rows = len(off) - 1
    n = np.diff(first)
    chars = _row_sums(NON_SPACE[data] & ((data & 0xC0) != 0x80), off)  # first bytes of code points

    # words inside a five-word window that occurs twice or more in its text
    repeat = np.zeros(rows, np.int64)
    k = REPEAT_WINDOW
    if len(starts) >= k:
        row = np.searchsorted(first[1:], np.arange(len(starts)), "right")
        h = gram_hashes(span_hashes(data, starts, ends), k)
        h = scramble(h ^ scramble(row[:len(h)].astype(np.uint64)))
        at = np.flatnonzero(inside_row(first, len(starts), k))
        order = at[np.argsort(h[at], kind="stable")]
        same = (h[order][1:] == h[order][:-1]) & (row[order][1:] == row[order][:-1])
        again = order[np.r_[same, False] | np.r_[False, same]]
        inside = np.zeros(len(starts), bool)
        for j in range(k):
            inside[again + j] = True
        repeat = _row_sums(inside, first)

    # lines with a word that equal an earlier line of the text
    a, b, line_first = words(data, off, _LINE)
    dup = np.zeros(rows, np.int64)
    if len(a):
        has_word = np.searchsorted(starts, b) > np.searchsorted(ends, a, "right")
        row = np.searchsorted(line_first[1:], np.arange(len(a)), "right")
        h = scramble(span_hashes(data, a, b) ^ scramble(row.astype(np.uint64)))
        at = np.flatnonzero(has_word)
        order = at[np.argsort(h[at], kind="stable")]
        later = order[1:][(h[order][1:] == h[order][:-1]) & (row[order][1:] == row[order][:-1])]
        dup = np.bincount(row[later], minlength=rows)
    return {"n_words": n, "word_chars": chars, "n_symbols": _row_sums(SYMBOL[data], off), "n_dup_lines": dup,
            "n_repeat_words": repeat}


def _grams(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each n-gram, offsets of the rows in them)."""
    n = len(data) - NGRAM + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    v = np.zeros(n, np.uint32)
    for j in range(NGRAM):
        v = v * np.uint32(0x01000193) + data[j:j + n]
    v = (v ^ (v >> np.uint32(15))) * np.uint32(0x85EBCA6B)
    ok = np.ones(n, bool)
    for j in range(1, NGRAM):
        at = off[1:-1] - j
        ok[at[(at >= 0) & (at < n)]] = False
    kept = np.concatenate([[0], np.cumsum(ok)])
    return (v[ok] >> np.uint32(16)).astype(np.int64), kept[np.minimum(off, n)]


def corpus_counts(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(trusted, raw) counts of the buckets over all ``docs`` (text, trusted)."""
    def run(batches):
        total = np.zeros((2, BUCKETS), np.int64)
        for b in batches:
            trusted = b.column("trusted").to_numpy(zero_copy_only=False).astype(bool)
            for lo, hi, data, off in chunks(b.column("text")):
                grams, first = _grams(data, off)
                total[1] += np.bincount(grams, minlength=BUCKETS)
                total[0] += np.bincount(grams[np.repeat(trusted[lo:hi], np.diff(first))], minlength=BUCKETS)
        at = np.flatnonzero(total[1])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[0][at]), pa.array(total[1][at])],
                                         ["bucket", "trusted", "raw"])

    rows = docs.select("text", "trusted").mapInArrow(run, "bucket long, trusted long, raw long")
    got = rows.groupBy("bucket").agg(F.sum("trusted"), F.sum("raw")).collect()  # at most BUCKETS rows
    out = np.zeros((2, BUCKETS))
    for bucket, t, r in got:
        out[:, bucket] = t, r
    return out[0], out[1]


def log_ratio(trusted: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Smoothed log P(bucket | trusted) - log P(bucket | raw); 0 without trusted counts."""
    if not trusted.sum():
        return np.zeros(BUCKETS)
    prior = (raw + 1) / (raw.sum() + BUCKETS)  # unseen buckets lean on the raw corpus
    strength = 1000.0
    return np.log((trusted + strength * prior) / (trusted.sum() + strength)) - np.log(prior)


def scored(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """Base counts and score of every text (columns doc_id, text, trusted); no shuffle."""
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches):
        for b in batches:
            for lo, hi, data, off in chunks(b.column("text")):
                base = base_counts(data, off)
                grams, first = _grams(data, off)
                total = np.zeros(hi - lo)
                n = np.diff(first)
                full = np.flatnonzero(n)
                if len(full):
                    total[full] = np.add.reduceat(ratio[grams], first[full])
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id")[lo:hi], b.column("trusted")[lo:hi], *[pa.array(base[c]) for c in counts],
                     pa.array(total / np.maximum(n, 1))], ["doc_id", "trusted", *counts, "score"])

    return docs.mapInArrow(run, "doc_id long, trusted boolean, " + "".join(f"{c} long, " for c in counts) + "score double")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the base counts, score, base_failed and kept of every row of ``docs``."""
    good_ids = stored(labels.where("quality = 1 and doc_id is not null")
                      .select(F.col("doc_id").cast("long").alias("_id")).distinct(), "good-ids")
    few = good_ids.count() <= TRUSTED_ROWS
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .join(F.broadcast(good_ids) if few else good_ids, F.col("doc_id") == F.col("_id"), "left") \
        .select("doc_id", "text", F.col("_id").isNotNull().alias("trusted"))
    got = stored(scored(rows, log_ratio(*corpus_counts(rows))), "quality-scores")
    good_scores = stored(got.where("trusted").select("score"), "good-scores")
    at = exact_quantiles(good_scores, ["score"], [TRUSTED_QUANTILE])["score"][0]
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    good = F.lit(True) if at is None else F.col("score") >= F.lit(at)
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score",
                      failed.alias("base_failed"), (~failed & good).alias("kept"))
