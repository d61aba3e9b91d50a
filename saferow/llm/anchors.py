"""Exact candidate search for long repeated strings.

A string of ``length`` units (bytes or words) is owned by one of its ``k``-unit
grams: the leftmost one with the smallest hash.  Which one that is depends on
the string alone, so equal strings have equal owners at equal places.  Runs of
window starts with the same owner form a *stretch*; its text reaches from the
first window's start to the last window's end.  Hence a repeated string is
always found among the stretches that share an owner gram (the *anchor*):

* stretches equal as a whole (hash of anchor and text) repeat in all windows;
* a stretch that is alone with its text may still share some windows with other
  stretches of its anchor.  Only those, one of each text, have to be compared
  unit by unit, which the two operators that use this do each by its own method.

Nothing is left out: a string whose anchor occurs once occurs once itself.
Long texts are cut into overlapping pieces, which changes no window's owner.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saferow.llm.common import chunks, powers, scramble, stored

_BASE = 0x9E6C63D0876A9A47


class SpanHash:
    """Hash of any span of an array of 64-bit symbols, by prefix sums."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(symbols * powers(_BASE, n), out=self.total[1:])
        self.back = powers(pow(_BASE, -1, 1 << 64), n + 1)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return scramble((self.total[ends] - self.total[starts]) * self.back[starts] + (ends - starts).astype(np.uint64))

    def grams(self, k: int) -> np.ndarray:
        return scramble((self.total[k:] - self.total[:-k]) * self.back[:len(self.total) - k])


def sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values."""
    out, span = h, 1
    while 2 * span <= w:
        out, span = np.minimum(out[:-span], out[span:]), 2 * span
    return np.minimum(out[:len(out) - (w - span)], out[w - span:]) if span < w else out


def stretches(symbols: np.ndarray, off: np.ndarray, length: int, k: int):
    """(row, first window start, number of windows, anchor hash, text hash, owner
    place in the first window) of every stretch; starts are within the row."""
    none = np.zeros(0, np.int64)
    if len(symbols) < length:
        return none, none, none, none, none, none
    span = SpanHash(symbols)
    g = span.grams(k)
    low = sliding_min(g, length - k + 1)
    inside = np.maximum(np.diff(off) - length + 1, 0)  # windows of each row
    total = int(inside.sum())
    if not total:
        return none, none, none, none, none, none
    start = np.arange(total) + np.repeat(off[:-1] - np.cumsum(inside) + inside, inside)
    w = length - k + 1
    least = low[start]
    valid = np.zeros(len(low), np.uint64)
    valid[start] = least
    edge = np.zeros(w - 1, np.uint64)
    # a gram can own a window only if it equals the largest minimum of the windows over it
    most = ~sliding_min(~np.concatenate([edge, valid, edge]), w)
    able = np.flatnonzero(most[:len(g)] == g)
    own = np.repeat(able, np.diff(able, prepend=-1))[start]  # the next one from the window's start
    wrong = np.flatnonzero(g[own] != least)
    at = np.searchsorted(able, start[wrong])
    while len(wrong):
        at += 1
        own[wrong] = able[at]
        still = g[own[wrong]] != least[wrong]
        wrong, at = wrong[still], at[still]
    new = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (start[1:] != start[:-1] + 1)])
    last = np.r_[new[1:], len(start)] - 1
    first, n = start[new], start[last] - start[new] + 1
    r = np.searchsorted(off[1:], first, "right")
    text = span(first, first + n - 1 + length) ^ scramble((own[new] - first).astype(np.uint64))
    return r, first - off[r], n, g[own[new]].view(np.int64), text.view(np.int64), own[new] - first


def pieces(off: np.ndarray, overlap: int, limit: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Cuts rows longer than ``limit`` into pieces that share ``overlap`` units:
    (first unit, offsets of the pieces from there, row and start of each piece)."""
    rows = len(off) - 1
    if rows and (np.diff(off) > limit).any():
        for r in range(rows):
            for lo in range(0, max(1, int(off[r + 1] - off[r]) - overlap), limit):
                hi = min(int(off[r + 1]), int(off[r]) + lo + limit + overlap)
                yield int(off[r]) + lo, np.array([0, hi - off[r] - lo]), np.array([[r, lo]])
    else:
        yield 0, off, np.column_stack([np.arange(rows), np.zeros(rows, np.int64)])


# --------------------------------------------------------------------- on Spark
#: Units of a text that one step looks at; longer texts are cut into overlapping pieces.
PIECE = 1 << 21
#: Stretches of one anchor that one task compares; larger groups are divided.
MAX_GROUP = 8_000
#: Bytes of stretches that a task compares at once (whole groups).
SHARD_BYTES = 5 << 19

MEMBER = "doc long, key binary, anchor long, text long, start long, n long, own long"
CONTEXT = "anchor long, lo long, hi long, doc long, key binary, text long, start long, n long, own long, body binary"
HALF = CONTEXT + ", whole binary"


def keyed(docs: DataFrame) -> DataFrame:
    """doc (the id, null as the largest), key (128-bit hash of the text) and text (null as empty)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("doc"),
                       F.unhex(F.md5(text)).alias("key"), text.alias("text"))


def members(rows: DataFrame, units, length: int, k: int) -> DataFrame:
    """All stretches whose anchor occurs at least twice, stored.

    ``units(bytes, offsets)`` gives the 64-bit symbols of a chunk and their offsets."""
    def run(batches):
        for b in batches:
            for lo, hi, data, off in chunks(b.column("text")):
                symbols, at = units(data, off)
                for base, cut, place in pieces(at, length - 1, PIECE):
                    r, start, n, anchor, text, own = stretches(symbols[base:base + int(cut[-1] - cut[0])],
                                                               cut - cut[0], length, k)
                    row = pa.array(lo + place[r, 0])
                    yield pa.RecordBatch.from_arrays(
                        [b.column("doc").take(row), b.column("key").take(row), pa.array(anchor, pa.int64()),
                         pa.array(text, pa.int64()), pa.array(start + place[r, 1], pa.int64()), pa.array(n, pa.int64()),
                         pa.array(own, pa.int64())], ["doc", "key", "anchor", "text", "start", "n", "own"])

    found = stored(rows.select("doc", "key", "text").mapInArrow(run, MEMBER), "stretches")
    # stored, so that both sides of the join are plain shuffles, of which Spark can split a hot anchor
    twice = stored(found.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("anchor"), "anchors")
    return stored(found.join(twice, "anchor", "left_semi").select("doc", "key", "anchor", "text", "start", "n", "own"),
                  "shared-stretches")


def bodies(texts: DataFrame, units, length: int) -> DataFrame:
    """The symbols of wanted stretches, from ``texts`` (key, text, wanted: array of
    stretches, and doc if only that document's are meant); one row per stretch, its
    body as bytes of the symbols."""
    def run(batches):
        for b in batches:
            docs = b.column("doc").to_pylist() if "doc" in b.schema.names else None
            keys, wanted = b.column("key").to_pylist(), b.column("wanted").to_pylist()
            for lo, hi, data, off in chunks(b.column("text")):
                symbols, at = units(data, off)
                out = [(w["anchor"], 0, length, w["doc"], keys[k], w["text"], w["start"], w["n"], w["own"],
                        symbols[at[k - lo] + w["start"]:at[k - lo] + w["start"] + w["n"] - 1 + length].tobytes())
                       for k in range(lo, hi) for w in wanted[k] or ()
                       if docs is None or docs[k] == w["doc"]]
                if out:
                    yield pa.RecordBatch.from_pydict(dict(zip(_CONTEXT, zip(*out))), schema=_CONTEXT_ARROW)

    return texts.mapInArrow(run, CONTEXT)


_CONTEXT = [f.strip().split(" ")[0] for f in CONTEXT.split(",")]
_CONTEXT_ARROW = pa.schema([(c, pa.binary() if c in ("key", "body") else pa.int64()) for c in _CONTEXT])
_HALF_ARROW = _CONTEXT_ARROW.append(pa.field("whole", pa.binary()))


def divided(contexts: DataFrame, length: int, unit: int, max_group: int, settle, live: str) -> tuple[DataFrame, DataFrame | None]:
    """(groups to compare, what was settled on the way): groups of more than
    ``max_group`` stretches are divided, without loss.

    Windows of a group start ``lo`` to ``hi`` units before the anchor.  The range is
    halved; all windows of a half share more units around the anchor, whose hash
    becomes the new group.  ``settle(halves)`` splits the halves into those still to be
    compared and the verdicts on those equal as a whole (same group, same ``whole``),
    which need no text.  Single windows of a group are always equal, so they are settled
    there, are not compared and carry no body: no group that is compared stays larger
    than ``max_group``.  Large groups without ``live`` (SQL on ``low`` and ``high``, the
    least and largest ``doc``) have nothing to be found.
    """
    def halve(batches):
        for b in batches:
            out = []
            for row in b.to_pylist():
                mid = (row["lo"] + row["hi"]) // 2
                for lo, hi in ((row["lo"], mid), (mid + 1, row["hi"])):
                    first = max(0, row["own"] - hi)  # windows of the stretch in this half
                    last = min(row["n"] - 1, row["own"] - lo)
                    if lo > hi or first > last:
                        continue
                    body, own = row["body"][first * unit:(last + length) * unit], row["own"] - first
                    common = body[(own - lo) * unit if own >= lo else 0:(own - hi + length) * unit]
                    out.append(row | {"lo": lo, "hi": hi, "start": row["start"] + first, "n": last - first + 1,
                                      "own": own, "body": body if lo < hi else b"",
                                      "anchor": _mixed(row["anchor"], lo, common), "whole": _whole(own, body)})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=_HALF_ARROW)

    done, settled, rows = None, None, contexts
    while True:
        large = stored(rows.groupBy("anchor").agg(F.count(F.lit(1)).alias("c"), F.min("doc").alias("low"),
                                                  F.max("doc").alias("high"))
                       .where(F.col("c") > max_group).select("anchor", "low", "high"), "large-anchors")
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows), settled
        small = rows.join(large, "anchor", "left_anti").select(*_CONTEXT)
        done = small if done is None else done.unionByName(small)
        halves = stored(rows.join(large.where(live), "anchor", "left_semi").select(*_CONTEXT)
                        .mapInArrow(halve, HALF), "halves")
        kept, found = settle(halves)
        settled = found if settled is None else settled.unionByName(found)
        rows = stored(kept.where("lo < hi").select(*_CONTEXT), "kept-halves")


def _whole(own: int, body: bytes) -> bytes:
    return hashlib.blake2b(body, digest_size=16, salt=struct.pack("<q", own)).digest()


def _mixed(anchor: int, lo: int, common: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(common, digest_size=8, salt=struct.pack("<qq", anchor, lo)).digest(), "little",
                          signed=True)


def comparing_tasks(contexts: DataFrame, length: int, unit: int, shard_bytes: int) -> int:
    """Tasks that compare about ``shard_bytes`` of bodies each, at any size of the table (what a
    shuffle weighs compressed says little about the work).  Only lengths are read."""
    total = contexts.agg(F.sum((F.col("n") + (length - 1)) * unit)).first()[0] or 0
    return max(1, -(-int(total) // shard_bytes))


def shards(batches: Iterator[pa.RecordBatch], limit: int = SHARD_BYTES) -> Iterator[pa.Table]:
    """Whole groups from rows sorted by anchor, about ``limit`` bytes of bodies at a time;
    a repeated (key, start) of a group (copies of a text) is taken once."""
    kept, held = [], 0

    def ready(t: pa.Table) -> pa.Table:
        cols = [t["anchor"].to_numpy(), t["start"].to_numpy(), t["lo"].to_numpy()]
        key = t["key"].to_pylist()
        new = np.r_[True, np.logical_or.reduce([c[1:] != c[:-1] for c in cols])]
        new[1:] |= np.array([a != b for a, b in zip(key, key[1:])], bool)
        return t.filter(pa.array(new))

    for b in batches:
        if not b.num_rows:
            continue
        kept.append(b)
        held += b.nbytes
        if held < limit:
            continue
        t = pa.Table.from_batches(kept)
        a = t["anchor"].to_numpy()
        cut = np.flatnonzero(a[1:] != a[:-1])
        if len(cut):
            yield from _sliced(t.slice(0, cut[-1] + 1), ready, limit)
            t = t.slice(cut[-1] + 1)
        kept, held = t.to_batches(), t.nbytes
    if kept:
        yield from _sliced(pa.Table.from_batches(kept), ready, limit)


def _sliced(t: pa.Table, ready, limit: int) -> Iterator[pa.Table]:
    """One batch of rows can hold many shards: cut at group edges."""
    a = t["anchor"].to_numpy()
    size = np.cumsum(pc.binary_length(t["body"]).to_numpy().astype(np.int64))
    edge, lo = np.r_[np.flatnonzero(a[1:] != a[:-1]) + 1, len(a)], 0
    while lo < len(a):
        base = size[lo - 1] if lo else 0
        fits = edge[(edge > lo) & (size[edge - 1] - base <= limit)]
        hi = int(fits[-1]) if len(fits) else int(edge[edge > lo][0])
        yield ready(t.slice(lo, hi - lo))
        lo = hi
