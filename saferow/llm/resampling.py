"""Importance resampling of documents towards a target distribution, with Arrow kernels.

Features of a text are its runs of 1 to ``order`` words, hashed to ``buckets`` by
CRC-32.  The gain of a bucket is the log ratio of its share among the target's
features to its share among all documents' features, in thousandths; a document's
weight is the floored mean gain of its features.  Weights plus reproducible Gumbel
noise are ranked, and the highest ``percent`` of the eligible documents are the draw:
sampling without replacement in proportion to exp(weight / 1000).

Features inside a task, slice by slice of an Arrow batch: ``ascii_lower``,
``split_pattern_regex``, ``list_flatten`` and ``dictionary_encode`` turn a slice into
word indices; indices shifted by one word form the runs as pairs (run so far, next
word), encoded again; CRC-32 is computed once per distinct pair, carried on from the
CRC of the shorter run; ``take`` brings bucket or gain back to every occurrence, and
sums over the segment of each document give its weight.

Corpus counts are a table of at most ``buckets`` rows, summed over all documents and
all target texts; only they (and the gains from them) pass the driver.  Texts are
never shuffled.  Ranks come from :mod:`saferow.operators.ranks`: no task holds more than a
range of the order.

Defined results: null and wordless texts have no features, weight 0 and are not
eligible (unless ``least_words`` is 0); a null id draws its noise from the seed alone
and ranks after all other ids of its score; rows of equal id and score take
consecutive ranks in any order (equal rows are interchangeable); an empty target
makes every gain that of smoothing alone; empty tables give no rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saferow.llm.common import stored
from saferow.operators.ranks import row_index

#: What separates words: every ASCII character that is no digit and no (lower-case) letter.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS, ORDER = 10_000, 2
PERCENT, LEAST_WORDS, SEED = 25, 20, 7
#: Bytes of text that one run of the kernels handles (a longer text: alone).
SLICE_BYTES = 4 << 20


def slices(col: pa.Array, limit: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Runs of rows of about ``limit`` bytes (a longer text: alone); null is the empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    ends = np.cumsum(pc.binary_length(col).to_numpy(zero_copy_only=False))
    lo = 0
    while lo < len(col):
        base = int(ends[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield col.slice(lo, hi - lo)
        lo = hi


def words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(index of each word in the dictionary, the dictionary, document of each word)."""
    lists = pc.split_pattern_regex(pc.ascii_lower(texts), pattern=SEPARATORS)
    flat, doc = pc.list_flatten(lists), pc.list_parent_indices(lists)
    full = pc.not_equal(flat, pa.scalar("", flat.type))  # the empty strings before and after separators
    coded = flat.filter(full).dictionary_encode()
    return (coded.indices.to_numpy().astype(np.int64), coded.dictionary,
            doc.filter(full).to_numpy().astype(np.int64))


def runs(texts: pa.Array, order: int = ORDER) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length 1 to ``order``: (CRC-32 of every distinct run, index of each run
    among them, document of each run)."""
    word, dictionary, doc = words(texts)
    n_words = max(len(dictionary), 1)
    spelled = dictionary.cast(pa.large_binary()).to_pylist()
    crc = np.fromiter(map(zlib.crc32, spelled), np.int64, len(spelled))
    here, at = word, np.arange(len(word))  # index of the run so far, position of its first word
    yield crc, here, doc
    after = [b" " + w for w in spelled]
    for length in range(2, order + 1):
        whole = at[at + length - 1 < len(word)]
        whole = whole[doc[whole] == doc[whole + length - 1]]
        # the run one word shorter that starts at the same word, and the word after it
        shorter = here[np.searchsorted(at, whole)]
        coded = pa.array(shorter * n_words + word[whole + length - 1]).dictionary_encode()
        pair = coded.dictionary.to_numpy()
        left, right = crc[pair // n_words].tolist(), (pair % n_words).tolist()
        crc = np.fromiter((zlib.crc32(after[r], c) for c, r in zip(left, right)), np.int64, len(pair))
        here, at = coded.indices.to_numpy().astype(np.int64), whole
        yield crc, here, doc[whole]


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, order: int = ORDER) -> DataFrame:
    """(bucket, n): features of all texts by bucket; at most ``buckets`` rows."""
    def run(batches: Iterator[pa.RecordBatch]):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for part in slices(b.column(0)):
                for crc, here, _ in runs(part, order):
                    of = pa.array(crc % buckets).take(pa.array(here)).to_numpy()
                    total += np.bincount(of, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    return (texts.select(F.col("text").cast("string")).mapInArrow(run, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Gain of every bucket in thousandths, from the two tables of counts."""
    s, t = [0] * buckets, [0] * buckets
    for into, counts in ((s, corpus), (t, target)):
        for row in counts.collect():  # at most one row per bucket
            into[row["bucket"]] = row["n"]
    all_s, all_t = sum(s) + buckets, sum(t) + buckets
    return np.array([math.floor(1000 * math.log(float(t[b] + 1) * float(all_s) / (float(s[b] + 1) * float(all_t))))
                     for b in range(buckets)], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, order: int = ORDER) -> DataFrame:
    """Per document: doc_id, n_words, n_features, weight."""
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            n_words, n_features, total = [], [], []
            for part in slices(b.column(1)):
                n, of, value = len(part), np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
                for k, (crc, here, doc) in enumerate(runs(part, order)):
                    each = pa.array(gain[crc % buckets]).take(pa.array(here)).to_numpy()
                    # documents are segments of the runs: differences of running sums
                    ends = np.searchsorted(doc, np.arange(n + 1))
                    running = np.concatenate([[0], np.cumsum(each)])
                    of += np.diff(ends)
                    value += np.diff(running[ends])
                    if not k:
                        n_words.append(np.diff(ends))
                n_features.append(of)
                total.append(value)
            n_words, n_features, total = (np.concatenate(x) if x else np.zeros(0, np.int64)
                                          for x in (n_words, n_features, total))
            weight = np.where(n_features > 0, total // np.maximum(n_features, 1), 0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_words), pa.array(n_features), pa.array(weight)],
                                             ["doc_id", "n_words", "n_features", "weight"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, n_words long, n_features long, weight long"))


def noise(seed: int):
    """Gumbel noise of a document in thousandths, from a hash of seed and id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
             seed: int = SEED, buckets: int = BUCKETS, order: int = ORDER) -> DataFrame:
    """Every document with n_words, n_features, weight, score and its rank in the draw
    of floor(``percent`` * N / 100) of the N documents of ``least_words`` words or more
    (null: not drawn)."""
    gain = gains(bucket_counts(docs, buckets, order), bucket_counts(target, buckets, order), buckets)
    scored = stored(weighed(docs, gain, order).withColumn("score", F.col("weight") + noise(seed)), "resampling-scores")
    eligible = F.col("n_words") >= least_words
    draw = percent * scored.where(eligible).count() // 100
    # highest score first, then smallest id (null last); equal rows in any order
    keys = scored.where(eligible).withColumns({"down": -F.col("score"), "no_id": F.col("doc_id").isNull()})
    ranked = row_index(keys, ["down", "no_id", "doc_id"], out="place").drop("down", "no_id")
    ranked = ranked.withColumn("rank", F.when(F.col("place") < draw, F.col("place") + 1)).drop("place")
    out = ranked.unionByName(scored.where(~eligible).withColumn("rank", F.lit(None).cast("long")))
    return out.select("doc_id", "n_words", "n_features", "weight", "score", F.col("rank").cast("long").alias("rank"))
