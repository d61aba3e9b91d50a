"""Removal of repeated word windows by prefix-partitioned suffix trees.

A word goes if a window of ``LENGTH`` words over it also starts in a document
with a smaller id.

1. The exact candidate search of :mod:`saferow.llm.anchors` finds the stretches
   of words that share an anchor.  Of stretches equal as a whole only the
   smallest document matters: all others lose theirs.
2. Stretches of one anchor that differ, one of each text with its smallest
   document, are dealt by anchor to tasks.  A task splits their suffixes by
   variable-length prefixes into groups of at most ``GROUP_SUFFIXES`` and builds
   one subtree for each: the suffixes of a group are sorted by reading the next
   symbols of those still tied only, the more at a time the fewer they are, which
   gives the order and the common prefixes, that is the tree.  Internal nodes of
   depth ``LENGTH`` are the repeated windows; a node's smallest document decides.
3. The spans found are joined to their documents.

Defined results: null and empty texts have no words; a null id counts as larger
than any; rows that agree in id and text are alike and do not remove each other;
windows are judged on the input.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saferow.llm.anchors import MAX_GROUP, SHARD_BYTES, bodies, comparing_tasks, divided, keyed, members, shards
from saferow.llm.common import NON_SPACE, scratch, span_hashes, stored, words

LENGTH, GRAM = 50, 12
GROUP_SUFFIXES = 1 << 17
#: Symbols that a subtree reads at a time.
READ = 1 << 20
_SPACE = re.compile("[\x20\x09-\x0d]+")


def _symbols(data, off):
    starts, ends, first = words(data, off, NON_SPACE)
    return span_hashes(data, starts, ends), first


def prefix_groups(text: np.ndarray, suffixes: np.ndarray, length: int, limit: int) -> Iterator[np.ndarray]:
    """Suffixes in groups of at most ``limit`` by prefixes that are made longer where
    a group is too large; neighbouring small groups are taken together."""
    todo, packed, held = [(suffixes, 0)], [], 0
    while todo:
        group, depth = todo.pop()
        if len(group) > limit and depth < length:
            symbol = text[group + depth]
            order = np.argsort(symbol, kind="stable")
            cut = np.flatnonzero(np.diff(symbol[order])) + 1
            todo += [(g, depth + 1) for g in np.split(group[order], cut)][::-1]
            continue
        if held and held + len(group) > limit:
            yield np.concatenate(packed)
            packed, held = [], 0
        packed.append(group)
        held += len(group)
    if packed:
        yield np.concatenate(packed)


def subtree(text: np.ndarray, suffixes: np.ndarray, length: int, read: int = READ) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, common prefix of each with the one before), to depth ``length``."""
    order, common = suffixes.copy(), np.zeros(len(suffixes), np.int64)
    segment = np.zeros(len(suffixes), np.int64)  # tied suffixes: the place of the first of them
    tied, depth = np.arange(len(suffixes)), 0
    while len(tied) > 1 and depth < length:
        step = int(min(length - depth, max(1, read // len(tied))))
        block = text[order[tied][:, None] + depth + np.arange(step)]
        by = np.lexsort((*block.T[::-1], segment[tied]))
        block, seg = block[by], segment[tied][by]
        order[tied] = order[tied][by]
        differ = block[1:] != block[:-1]
        same = seg[1:] == seg[:-1]
        agree = np.where(differ.any(1), differ.argmax(1), step)
        common[tied[1:][same]] = depth + agree[same]
        new = np.r_[True, ~same | (agree < step)]
        segment[tied] = tied[np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))]
        alone = new & np.r_[new[1:], True]
        tied, depth = tied[~alone], depth + step
    return order, common


def smaller_documents(body: list[bytes], n: np.ndarray, doc: np.ndarray, length: int, limit: int) -> tuple:
    """(stretch, window) of all windows that also occur in a stretch of a smaller document."""
    size = np.array([len(b) // 8 for b in body])
    base = np.cumsum(size) - size
    text = np.unique(np.frombuffer(b"".join(body), np.uint64), return_inverse=True)[1]
    owner = np.repeat(np.arange(len(n)), n)
    suffixes = base[owner] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    found = []
    for group in prefix_groups(text, suffixes, length, limit):
        order, common = subtree(text, group, length)
        at = np.searchsorted(base, order, "right") - 1
        edge = np.flatnonzero(common < length)  # each deep node is a run between these
        edge = edge if len(edge) and edge[0] == 0 else np.r_[0, edge]
        least = np.repeat(np.minimum.reduceat(doc[at], edge), np.diff(np.r_[edge, len(order)]))
        found.append(order[least < doc[at]])
    hit = np.sort(np.concatenate(found))
    at = np.searchsorted(base, hit, "right") - 1
    return at, hit - base[at]


def _settled(halves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(halves of divided groups still to be compared, windows lost by those that equal
    one of a smaller document as a whole)."""
    equal = stored(halves.groupBy("anchor", "whole").agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
                   .where("least < most").select("anchor", "whole", "least"), "equal-halves")
    all_ = halves.join(equal, ["anchor", "whole"], "left")
    lost = all_.where("doc > least").select("text", "doc", (-F.col("own")).alias("first"),
                                            (F.col("n") - 1 - F.col("own")).alias("last"))
    return all_.where("least is null or doc = least"), lost


def repeated_spans(rows: DataFrame, length: int = LENGTH, k: int = GRAM, max_group: int = MAX_GROUP,
                   shard_bytes: int = SHARD_BYTES, group_suffixes: int = GROUP_SUFFIXES) -> tuple[DataFrame, DataFrame]:
    """(rows whose text has shared stretches: doc, key, text; spans: doc, key, start, end)."""
    member = members(rows, _symbols, length, k)
    same = stored(member.groupBy("anchor", "text").agg(
        F.min("doc").alias("least"), F.min(F.struct("doc", "key", "start", "n", "own")).alias("one")), "equal-stretches")
    end = F.col("start") + F.col("n") - 1 + length
    whole = stored(member.join(same.select("anchor", "text", "least"), ["anchor", "text"]).where("doc > least")
                   .select("doc", "key", "start", end.alias("end")).distinct(), "whole-spans")
    # stored, so that both sides of its join are plain shuffles, of which Spark can split a hot anchor
    mixed = stored(same.groupBy("anchor").agg(F.min("least").alias("a"), F.max("least").alias("b")).where("a < b")
                   .select("anchor"), "mixed-anchors")
    wanted = same.join(mixed, "anchor", "left_semi").select(
        F.col("one.key").alias("key"),
        F.struct("anchor", F.col("least").alias("doc"), "text", F.col("one.start").alias("start"),
                 F.col("one.n").alias("n"), F.col("one.own").alias("own")).alias("w"))
    wanted = wanted.groupBy("key").agg(F.collect_list("w").alias("wanted"))
    concerned = member.select("key").distinct().join(wanted, "key", "left")
    path = scratch(rows.sparkSession, "concerned-texts") + "/t"
    rows.select("doc", "key", "text").join(concerned, "key").write.option("compression", "zstd").parquet(path)
    texts = rows.sparkSession.read.parquet(path)

    def compare(batches):
        for t in shards(batches, shard_bytes):
            if len(t) < 2:
                continue
            doc, own = t["doc"].to_numpy(), t["own"].to_numpy()
            at, w = smaller_documents(t["body"].to_pylist(), t["n"].to_numpy(), doc, length, group_suffixes)
            if not len(at):
                continue
            new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (w[1:] != w[:-1] + 1)])
            last = np.r_[new[1:], len(at)] - 1
            at, first, last = at[new], w[new], w[last]
            yield pa.RecordBatch.from_arrays([pa.array(t["text"].to_numpy()[at]), pa.array(doc[at]),
                                              pa.array(first - own[at]), pa.array(last - own[at])],
                                             ["text", "doc", "first", "last"])

    contexts = bodies(texts.where("wanted is not null"), _symbols, length)
    contexts, settled = divided(stored(contexts, "contexts"), length, 8, max_group, _settled, "low < high")
    part = contexts.repartition(comparing_tasks(contexts, length, 8, shard_bytes), "anchor").sortWithinPartitions("anchor", "lo", "key", "start") \
        .mapInArrow(compare, "text long, doc long, first long, last long")
    part = part if settled is None else part.unionByName(settled)
    # a text may stand several times in its smallest document: back to all its places there
    at = F.col("start") + F.col("own")
    part = member.join(part, ["text", "doc"]) \
        .select("doc", "key", (at + F.col("first")).alias("start"), (at + F.col("last") + length).alias("end"))
    return texts.select("doc", "key", "text"), whole.unionByName(stored(part, "part-spans"))


def deduplicate(docs: DataFrame, length: int = LENGTH, k: int = GRAM, **options) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row."""
    rows = keyed(docs)
    texts, spans = repeated_spans(rows, length, k, **options)

    def cut(batches):
        for b in batches:
            out = []
            for doc, key, text, found in zip(*(b.column(c).to_pylist() for c in ("doc", "key", "text", "spans"))):
                all_words = [w for w in _SPACE.split(text) if w]
                gone = np.zeros(len(all_words) + 1, np.int64)
                for s in found:
                    gone[s["start"]] += 1
                    gone[s["end"]] -= 1
                gone = np.cumsum(gone[:-1]) > 0
                kept = " ".join(w for w, g in zip(all_words, gone.tolist()) if not g)
                out.append((doc, key, int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)],
                                                 ["doc", "key", "n_removed", "kept_sha256"])

    spans = spans.groupBy("doc", "key").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    found = texts.join(spans, ["doc", "key"]).mapInArrow(
        cut, "doc long, key binary, n_removed long, kept_sha256 string").dropDuplicates(["doc", "key"])
    joined = F.btrim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " "), F.lit(" "))
    base = rows.withColumn("joined", joined).select(
        "doc_id", "doc", "key", F.sha2("joined", 256).alias("whole_sha256"),
        F.when(F.col("joined") == "", F.lit(0)).otherwise(
            F.length("joined") - F.length(F.replace("joined", F.lit(" "), F.lit(""))) + 1).cast("long").alias("n_words"))
    return base.join(found, ["doc", "key"], "left").select(
        "doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"))
