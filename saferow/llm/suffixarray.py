"""Removal of repeated byte strings by external induced suffix sorting.

A byte goes if a string of ``LENGTH`` bytes over it also starts anywhere else.

1. The exact candidate search of :mod:`saferow.llm.anchors` finds the stretches
   of text that share an anchor.  Stretches that are equal as a whole are
   repeated as a whole.
2. The others, one of each text, are dealt by anchor to shards; each shard is
   put in suffix order by external induced sorting, with common prefixes carried
   along (:mod:`saferow.llm.induced`).  A window is repeated if its prefix in
   common with a neighbour in that order has ``LENGTH`` bytes.
3. The spans found are joined to their texts, once per distinct text.

Texts move twice: once to fetch the stretches, and those with removals once
more.  Anchor groups beyond ``MAX_GROUP`` are divided without loss; what is
equal as a whole on the way is settled by an aggregate.

Defined results: null is the empty text; texts shorter than ``LENGTH`` lose
nothing; copies of a text (rows repeated as a whole too) remove each other;
matches never cross documents, and are judged on the input.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saferow.llm.anchors import MAX_GROUP, SHARD_BYTES, bodies, comparing_tasks, divided, keyed, members, shards
from saferow.llm.common import BYTE_KEY, scratch, stored
from saferow.llm.induced import suffix_order

LENGTH, GRAM = 400, 280


def _symbols(data, off):
    return BYTE_KEY[data], off


def _bytes(data, off):
    return data, off


def repeated_windows(body: list[bytes], n: np.ndarray, length: int, memory: int) -> tuple[np.ndarray, np.ndarray]:
    """(stretch, window) of all windows that occur at least twice in a shard."""
    size = np.array([len(b) + 1 for b in body])
    base = np.cumsum(size) - size
    text = np.frombuffer(b"\0".join(body) + b"\0", np.uint8).astype(np.int32) + 1
    text[base + size - 1] = 0  # closes a stretch, below every byte
    order, prefix = suffix_order(text, length, memory)
    again = prefix >= length
    hit = np.sort(order[again | np.r_[again[1:], False]])
    at = np.searchsorted(base, hit, "right") - 1
    ok = hit - base[at] < n[at]
    return at[ok], (hit - base[at])[ok]


def _runs(at: np.ndarray, w: np.ndarray):
    """(stretch, first window, last window) of consecutive windows."""
    new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (w[1:] != w[:-1] + 1)]) if len(at) else np.zeros(0, int)
    last = np.r_[new[1:], len(at)][:len(new)] - 1
    return at[new], w[new], w[last]


def _settled(halves: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """(halves of divided groups still to be compared, spans of those that are equal as a
    whole); one of the equal ones stays to be compared with others, as ``doc`` 0."""
    place = F.struct("key", "start")
    equal = stored(halves.groupBy("anchor", "whole").agg(F.min(place).alias("one"), F.max(place).alias("other"))
                   .where("one < other").select("anchor", "whole", "one"), "equal-halves")
    all_ = halves.join(equal, ["anchor", "whole"], "left")
    spans = all_.where("one is not null and doc = 1") \
        .select("key", "start", (F.col("start") + F.col("n") - 1 + length).alias("end"))
    kept = all_.where(F.col("one").isNull() | (F.col("one") == place)) \
        .withColumn("doc", F.when(F.col("one").isNull(), F.col("doc")).otherwise(F.lit(0).cast("long")))
    return kept, spans


def repeated_spans(rows: DataFrame, length: int = LENGTH, k: int = GRAM, max_group: int = MAX_GROUP,
                   shard_bytes: int = SHARD_BYTES, memory: int = 1 << 26) -> tuple[DataFrame, DataFrame]:
    """(texts with repeated strings: key, text; spans: key, start, end) of keyed rows."""
    member = members(rows, _symbols, length, k)
    same = stored(member.groupBy("anchor", "text").agg(
        F.count(F.lit(1)).alias("c"), F.min(F.struct("doc", "key", "start", "n", "own")).alias("one")), "equal-stretches")
    whole = member.join(same.where("c > 1").select("anchor", "text"), ["anchor", "text"], "left_semi") \
        .select("key", "start", (F.col("start") + F.col("n") - 1 + length).alias("end")).distinct()
    # stored, so that both sides of its join are plain shuffles, of which Spark can split a hot anchor
    mixed = stored(same.groupBy("anchor").agg(F.count(F.lit(1)).alias("texts"), F.min("c").alias("low"))
                   .where("texts > 1 and low = 1").select("anchor"), "mixed-anchors")
    # a stretch that is alone carries its own place as ``doc`` 1, the others 0
    wanted = same.join(mixed, "anchor", "left_semi").select(
        F.col("one.key").alias("key"),
        F.struct("anchor", F.when(F.col("c") == 1, 1).otherwise(0).cast("long").alias("doc"), "text",
                 F.col("one.start").alias("start"), F.col("one.n").alias("n"), F.col("one.own").alias("own")).alias("w"))
    wanted = wanted.groupBy("key").agg(F.collect_list("w").alias("wanted"))
    whole = stored(whole, "whole-spans")
    concerned = whole.select("key").distinct().join(wanted, "key", "full_outer")
    path = scratch(rows.sparkSession, "concerned-texts") + "/t"
    rows.select("key", "text").join(concerned, "key").dropDuplicates(["key"]).write.option("compression", "zstd").parquet(path)
    texts = rows.sparkSession.read.parquet(path)

    def compare(batches):
        for t in shards(batches, shard_bytes):
            if len(t) < 2:
                continue
            at, w = repeated_windows(t["body"].to_pylist(), t["n"].to_numpy(), length, memory)
            alone = t["doc"].to_numpy()[at] == 1
            at, first, last = _runs(at[alone], w[alone])
            start = t["start"].to_numpy()[at]
            yield pa.RecordBatch.from_arrays([t["key"].combine_chunks().take(pa.array(at)), pa.array(start + first),
                                              pa.array(start + last + length)], ["key", "start", "end"])

    contexts = bodies(texts.where("wanted is not null"), _bytes, length)
    contexts, settled = divided(stored(contexts, "contexts"), length, 1, max_group, lambda h: _settled(h, length), "high = 1")
    part = contexts.repartition(comparing_tasks(contexts, length, 1, shard_bytes), "anchor").sortWithinPartitions("anchor", "lo", "key", "start") \
        .mapInArrow(compare, "key binary, start long, end long")
    part = part if settled is None else part.unionByName(settled)
    return texts.select("key", "text"), whole.unionByName(stored(part, "part-spans"))


def deduplicate(docs: DataFrame, length: int = LENGTH, k: int = GRAM, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (binary, only of
    texts with removals) of every row."""
    rows = keyed(docs)
    texts, spans = repeated_spans(rows, length, k, **options)

    def cut(batches):
        for b in batches:
            out = []
            for key, text, found in zip(*(b.column(c).to_pylist() for c in ("key", "text", "spans"))):
                raw, merged = text.encode(), []
                for s in sorted((s["start"], s["end"]) for s in found):
                    if merged and s[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s[1])
                    else:
                        merged.append([*s])
                edges = [0, *(e for s in merged for e in s), len(raw)]
                kept = b"".join(raw[edges[i]:edges[i + 1]] for i in range(0, len(edges), 2))
                out.append((key, len(raw) - len(kept), len(merged), hashlib.sha256(kept).hexdigest()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)],
                                                 ["key", "n_removed", "n_spans", "kept_sha256"])

    spans = spans.groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    found = texts.join(spans, "key").mapInArrow(
        cut, "key binary, n_removed long, n_spans long, kept_sha256 string")
    base = rows.select("doc_id", "key", F.octet_length("text").cast("long").alias("n_bytes"),
                       F.sha2("text", 256).alias("whole_sha256"))
    out = base.join(found, "key", "left")
    return out.select("doc_id", "n_bytes", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_removed", "n_spans")],
                      F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"))
