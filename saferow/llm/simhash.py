"""SimHash near-duplicates with a Gray-order hierarchical index.

Fingerprint: 64 bits, a bit is set if more than half of the hashes of the
document's three-word shingles have it.  Fingerprints within ``MAX_BITS`` bits
are linked; a component is what is reachable over links.

Search: only distinct fingerprints take part (thousands of copies are one).
Two fingerprints within 3 bits agree in one of four 16-bit blocks, so each is
sent once for each block, its block turned to the front.  Rows of one block value
meet in one task; a block value with more than ``MAX_GROUP`` fingerprints is
divided again by its remaining bits, in four, by the same argument, so no task
holds an unbounded group and no pair is lost.  In a task the rows are sorted by
Gray rank, where neighbours differ in few bits; every ``FANOUT`` neighbours form
a node that holds the bits all of them share, less what its parent holds
already.  A query goes down the tree, adds up the differing shared bits, and
drops a whole node once the sum exceeds the limit.

A task returns, of the links it finds, a spanning forest (each fingerprint with
its local root), so dense groups give rows in proportion to their size.
Components of all tasks are joined by alternating star contraction.

Defined results: null or empty text has the fingerprint 0 and is linked like
any other; fewer words than a shingle form one shingle; repeated rows share
their component; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saferow.llm.common import LOWER, NON_SPACE, chunks, stored, words

SHINGLE, MAX_BITS, SEED = 3, 3, 42
FANOUT = 16
MAX_GROUP = 50_000


# -------------------------------------------------------------- fingerprints
def fingerprints_of(data: np.ndarray, off: np.ndarray, k: int = SHINGLE) -> np.ndarray:
    """Fingerprint of each row of a chunk of texts."""
    low = LOWER[data]
    starts, ends, first = words(low, off, NON_SPACE)
    out = np.zeros(len(off) - 1, np.uint64)
    if not len(starts):
        return out
    size = ends - starts
    new_start = np.concatenate([[0], np.cumsum(size + 1)])  # words joined by one space
    joined = np.full(new_start[-1], 32, np.uint8)
    joined[np.arange(size.sum()) + np.repeat(np.arange(len(size)), size)] = low[NON_SPACE[low]]
    raw = joined.tobytes()
    n = np.diff(first)
    shingles = np.where(n == 0, 0, np.maximum(n - k + 1, 1))
    row = np.repeat(np.arange(len(n)), shingles)
    at = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    stop = new_start[np.minimum(at + k, first[row + 1])] - 1
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(raw[a:b], SEED) for a, b in zip(new_start[at].tolist(), stop.tolist())), np.uint64, len(at))
    full = np.flatnonzero(shingles)
    edge = np.concatenate([np.cumsum(shingles)[full] - shingles[full], [len(h)]])
    lo = 0
    while lo < len(full):  # 64 counters a row, over a bounded number of hashes unless one row has more
        hi = max(lo + 1, int(np.searchsorted(edge, edge[lo] + 100_000, "right")) - 1)
        bits = np.unpackbits(h[edge[lo]:edge[hi]].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, edge[lo:hi] - edge[lo], axis=0, dtype=np.int32)
        major = (2 * ones > shingles[full[lo:hi], None]).astype(np.uint8)
        out[full[lo:hi]] = np.packbits(major, axis=1, bitorder="little").view("<u8").ravel()
        lo = hi
    return out


def fingerprint(docs: DataFrame) -> DataFrame:
    """doc_id, text_key (hash of the text) and fp (the 64 bits as a long); no shuffle."""
    def run(batches):
        for b in batches:
            for lo, hi, data, off in chunks(b.column("text")):
                fp = fingerprints_of(data, off).view(np.int64)
                yield pa.RecordBatch.from_arrays([b.column("doc_id")[lo:hi], b.column("text_key")[lo:hi], pa.array(fp)],
                                                 ["doc_id", "text_key", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text") \
        .mapInArrow(run, "doc_id long, text_key long, fp long")


# ---------------------------------------------------------------- Gray index
def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each value in the reflected Gray sequence."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


class GrayTree:
    """Hierarchical index over values sorted by Gray rank."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.levels = []  # from the leaves up: (pattern, mask of agreed bits)
        pattern, mask = values, np.full(len(values), ~np.uint64(0))
        while len(pattern) > 1 or not self.levels:
            at = np.arange(0, len(pattern), FANOUT)
            head = np.repeat(pattern[at], np.diff(np.append(at, len(pattern))))
            differ = np.bitwise_or.reduceat(pattern ^ head, at)
            mask = np.bitwise_and.reduceat(mask, at) & ~differ
            pattern = pattern[at] & mask
            self.levels.append((pattern, mask))

    def pairs(self, queries: np.ndarray, numbers: np.ndarray, front: np.uint64, limit: int) -> Iterator[tuple]:
        """(query number, value number) arrays of all values within ``limit`` bits
        that agree with the query in the ``front`` bits."""
        stack = [(len(self.levels) - 1, numbers, np.zeros(len(numbers), np.int64), np.zeros(len(numbers), np.int64))]
        while stack:
            level, q, node, far = stack.pop()
            if len(q) > 1 << 18:  # bounded frontier
                half = len(q) // 2
                stack += [(level, q[half:], node[half:], far[half:]), (level, q[:half], node[:half], far[:half])]
                continue
            if level >= 0:
                pattern, mask = self.levels[level]
                own = mask[node]
                if level + 1 < len(self.levels):
                    own = own & ~self.levels[level + 1][1][node // FANOUT]
            else:
                pattern, own = self.values, ~self.levels[0][1][node // FANOUT]
            differ = (queries[q] ^ pattern[node]) & own
            far = far + np.bitwise_count(differ)
            ok = (far <= limit) & (differ & front == 0)
            q, node, far = q[ok], node[ok], far[ok]
            if level < 0:
                if len(q):
                    yield q, node
                continue
            below = len(self.levels[level - 1][0]) if level else len(self.values)
            child = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
            ok = child < below
            if ok.any():
                stack.append((level - 1, np.repeat(q, FANOUT)[ok], child[ok], np.repeat(far, FANOUT)[ok]))


def spanning_roots(values: np.ndarray, front_bits: int, limit: int) -> np.ndarray:
    """For values in Gray order: the number of the first value each is connected to."""
    tree, root = GrayTree(values), np.arange(len(values))
    front = ~np.uint64(0) << np.uint64(64 - front_bits)
    for lo in range(0, len(values), 4096):
        numbers = np.arange(lo, min(lo + 4096, len(values)))
        for a, b in tree.pairs(values, numbers, front, limit):
            keep = a < b
            a, b = a[keep], b[keep]
            while True:
                x, y = root[a], root[b]
                differ = x != y
                if not differ.any():
                    break
                a, b, x, y = a[differ], b[differ], x[differ], y[differ]
                np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
                while (root[root] != root).any():
                    root = root[root]
    return root


def _turned(fp, fixed: int, width: int, k: int):
    """The k-th of the ``width``-bit blocks after the first ``fixed`` bits moved to
    the front of them, the rest turned after it (a bijection)."""
    if fixed == 0:
        return F.expr(f"shiftleft(r, {width * k}) | shiftrightunsigned(r, {64 - width * k})") if k else F.col("r")
    rest = 64 - fixed
    low = f"(r & {(1 << rest) - 1}L)"
    top = f"(r & {-(1 << rest)}L)"
    if not k:
        return F.col("r")
    turned = f"((shiftleft({low}, {width * k}) | shiftrightunsigned({low}, {rest - width * k})) & {(1 << rest) - 1}L)"
    return F.expr(f"{top} | {turned}")


def _divided(rows: DataFrame, fixed: int, blocks: int) -> tuple[DataFrame, int]:
    """Each row once for each block of the bits after ``fixed``."""
    width = (64 - fixed) // blocks
    cases = F.array(*[F.struct(F.concat_ws(".", "way", F.lit(str(k))).alias("way"),
                               _turned(F.col("r"), fixed, width, k).alias("r")) for k in range(blocks)])
    out = rows.select("fp", F.explode(cases).alias("c")).select("fp", "c.way", "c.r")
    return out.withColumn("front", F.expr(f"shiftrightunsigned(r, {64 - fixed - width})")), fixed + width


def links(fps: DataFrame, limit: int = MAX_BITS, max_group: int = MAX_GROUP) -> DataFrame:
    """a, b: links between distinct fingerprints that span every component."""
    def search(fixed: int):
        def run(batches):
            kept, rows = None, 0

            def found(t: pa.Table):
                v, fp = t["r"].to_numpy().view(np.uint64), t["fp"].to_numpy()
                order = np.argsort(gray_rank(v), kind="stable")
                root = spanning_roots(v[order], fixed, limit)
                fp = fp[order]
                far = np.flatnonzero(root != np.arange(len(root)))
                return pa.RecordBatch.from_arrays([pa.array(fp[far]), pa.array(fp[root[far]])], ["a", "b"])

            # rows come sorted by (way, front): search runs of whole groups of one way
            for b in batches:
                t = pa.Table.from_batches([b])
                kept = t if kept is None else pa.concat_tables([kept, t])
                if len(kept) < 100_000:
                    continue
                way, front = kept["way"].to_numpy(), kept["front"].to_numpy()
                cut = np.flatnonzero((way[1:] != way[:-1]) | (front[1:] != front[:-1]))
                if len(cut):
                    yield from _by_way(kept.slice(0, cut[-1] + 1), found)
                    kept = kept.slice(cut[-1] + 1)
            if kept is not None and len(kept):
                yield from _by_way(kept, found)
        return run

    rows, fixed, blocks = fps.select("fp", F.lit("").alias("way"), F.col("fp").alias("r")), 0, limit + 1
    out = None
    while True:
        rows, fixed = _divided(rows, fixed, blocks)
        many = rows.groupBy("way", "front").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_group)
        many = stored(many, "large-groups")
        if 64 - fixed < 2 * blocks or many.isEmpty():  # with that few bits left a group is bounded by their number
            many = None
        here = rows if many is None else rows.join(many.drop("n"), ["way", "front"], "left_anti")
        found = here.repartition("way", "front").sortWithinPartitions("way", "front") \
            .mapInArrow(search(fixed), "a long, b long")
        out = found if out is None else out.unionByName(found)
        if many is None:
            return out
        rows = rows.join(many.drop("n"), ["way", "front"], "left_semi")


def _by_way(t: pa.Table, found):
    way = t["way"].to_numpy()
    cut = np.r_[0, np.flatnonzero(way[1:] != way[:-1]) + 1, len(way)]
    for lo, hi in zip(cut[:-1], cut[1:]):
        yield found(t.slice(lo, hi - lo))


# ---------------------------------------------------------------- components
def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node reachable) for every node with a link.

    Alternating star contraction: each node hands its larger neighbours, then its
    smaller ones, over to its smallest neighbour, until nothing changes.
    """
    def state(e):
        r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(r)

    now = stored(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                 "star")
    was, is_now = None, state(now)
    while is_now[0] and is_now != was:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # the smallest neighbours are stored: both sides of the joins are then plain shuffles, of which Spark
        # can split the root of a large component
        low = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "star-low")
        large = stored(both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(),
                       "star-large")
        low = stored(large.groupBy("a").agg(F.min("b").alias("m")), "star-low")
        small = large.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stored(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "star")
        was, is_now = is_now, state(now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, limit: int = MAX_BITS) -> DataFrame:
    """doc_id, text_key, fp, component_id, and the (doc_id, text_key) that stands for the component."""
    marked = stored(fingerprint(docs), "fingerprints")
    fps = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("low"), F.min(F.struct("doc_id", "text_key")).alias("rep")),
                 "distinct-fingerprints")
    of = components(links(fps, limit)).withColumnRenamed("node", "fp")
    fps = fps.join(of, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    comp = fps.groupBy("root").agg(F.min("low").alias("component_id"), F.min("rep").alias("rep"))
    fps = fps.select("fp", "root").join(comp, "root").select("fp", "component_id", "rep")
    return marked.join(fps, "fp").select("doc_id", "text_key", "fp", "component_id", "rep")


def one_of_each(docs: DataFrame, limit: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` of each component (columns kept)."""
    rep = near_duplicates(docs, limit).where(
        F.col("doc_id").eqNullSafe(F.col("rep.doc_id")) & F.col("text_key").eqNullSafe(F.col("rep.text_key")))
    rep = rep.select(F.col("doc_id").alias("__sf_id"), F.col("text_key").alias("__sf_rep")).distinct()
    keyed = docs.withColumn("__sf_key", F.xxhash64("text"))
    on = keyed["doc_id"].eqNullSafe(rep["__sf_id"]) & (keyed["__sf_key"] == rep["__sf_rep"])
    kept = keyed.join(rep, on, "left_semi")
    first = Window.partitionBy("doc_id", "__sf_key").orderBy(F.lit(1))  # repeated rows only
    return kept.withColumn("__sf_n", F.row_number().over(first)).where("__sf_n = 1").select(*[f"`{c}`" for c in docs.columns])
