"""Benchmark decontamination with a distributed positional inverted index.

Index: every task cuts its rows into segments of a few MB of text; a segment is
one row of the stored index table: its documents, its terms (sorted hashes of
the words) and for each term the sorted list of its positions in the segment
(delta coded).  A document lies in one segment as a whole, so any query can be
answered segment by segment with no shuffle of postings.

Phrase query: term frequencies over the whole index are summed first, so each
window of a test item knows its rarest terms.  In a segment the positions of a
window's rarest term, less its offset in the window, are the candidates; they
are intersected with the offset-adjusted list of the next rarest term, and so
on, until all words agree.  Test items never meet on the driver: tasks cut them into
windows, Spark deals the distinct (item, window) pairs by range into blocks of
at most ``BLOCK_WORDS`` pairs, stored as rows of a table in the shared folder.
An index task reads them there one after another: once to count the postings of
a block's terms, and, when the sums have given each window its order of rarity,
once to match.  A task holds one block and one batch of segments.

Proximity query: all words of a query within ``slop`` positions, any order,
found by next-position look-ups in the lists, starting from the rarest term.

Defined results: null or empty text has no words, is never contaminated, and as
a test item matches nothing; an item of fewer words than the window is one
window; repeated rows are reported each; a null item id is shown as "null";
items of equal id are one item with the windows of all its texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saferow.llm.common import LOWER, byte_class, chunks, filesystem, scratch, span_hashes, stored, words

WINDOW = 10
BLOCK_WORDS = 1 << 18
#: Segments (of some 2 MB of text) that one task counts: each task sends on one partial count a term.
COUNTED_SEGMENTS = 64
#: Word bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z.
WORD_BYTE = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
_INDEX = ("segment string, doc_ids array<bigint>, doc_words array<bigint>, terms binary, counts binary, "
          "positions binary")


def _hashed(data, off):
    data = LOWER[data]
    starts, ends, first = words(data, off, WORD_BYTE)
    return span_hashes(data, starts, ends), first


def build_index(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The stored index of ``text``; one pass over the documents, no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]):
        part, k = TaskContext.get().partitionId(), 0
        for b in batches:
            ids = b.column("id")
            for lo, hi, data, off in chunks(b.column("text")):
                h, first = _hashed(data, off)
                order = np.argsort(h, kind="stable")
                terms, at, counts = np.unique(h[order], return_index=True, return_counts=True)
                delta = np.diff(order, prepend=0)
                delta[at] = order[at]
                yield pa.RecordBatch.from_arrays([
                    pa.array([f"{part}-{k}"]), pa.array([ids[lo:hi].to_pylist()], pa.list_(pa.int64())),
                    pa.array([np.diff(first)], pa.list_(pa.int64())), pa.array([terms.tobytes()], pa.binary()),
                    pa.array([counts.astype("<u4").tobytes()], pa.binary()),
                    pa.array([delta.astype("<u4").tobytes()], pa.binary())],
                    ["segment", "doc_ids", "doc_words", "terms", "counts", "positions"])
                k += 1

    rows = docs.select(F.col(id_col).cast("long").alias("id"), "text").mapInArrow(run, _INDEX)
    path = scratch(docs.sparkSession, "positional-index") + "/t"
    rows.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(_INDEX).parquet(path)


class Segment:
    """Postings of one index row as arrays."""

    def __init__(self, terms: bytes, counts: bytes, positions: bytes, doc_words: list):
        self.terms = np.frombuffer(terms, np.uint64)
        self.counts = np.frombuffer(counts, "<u4").astype(np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.counts)])
        delta = np.frombuffer(positions, "<u4").astype(np.int64)
        run = np.cumsum(delta)
        base = np.concatenate([[0], run])[self.at[:-1]] if len(delta) else np.zeros(0, np.int64)
        self.positions = run - np.repeat(base, self.counts)
        self.first = np.concatenate([[0], np.cumsum(np.array(doc_words, np.int64))])
        self.n = len(self.positions)
        self._keys = None

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Local number of each term, -1 where the segment lacks it."""
        if not len(self.terms):
            return np.full(hashes.shape, -1)
        k = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[k] == hashes, k, -1)

    def has(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Whether each (term number, position) is a posting."""
        if self._keys is None:
            self._keys = np.repeat(np.arange(len(self.terms)), self.counts) * (self.n + 1) + self.positions
        key = term * (self.n + 1) + position
        k = np.minimum(np.searchsorted(self._keys, key), self.n - 1)
        return (self._keys[k] == key) & (position >= 0) & (position < self.n)

    def doc_of(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first[1:], position, "right")


def match_windows(seg: Segment, windows: np.ndarray, lengths: np.ndarray, by_rarity: np.ndarray):
    """(window number, start) of every exact occurrence inside one document.

    ``windows``: term hashes, one row per window, padded with its first word;
    ``by_rarity``: for each window its word offsets, rarest first (padding last).
    """
    none = np.zeros(0, np.int64)
    local = seg.find(windows)
    width = np.arange(windows.shape[1])
    there = np.flatnonzero(((local >= 0) | (width >= lengths[:, None])).all(1) & (lengths > 0))
    if not len(there):
        return none, none
    rare = by_rarity[there, 0]
    term = local[there, rare]
    n = seg.counts[term]
    w = np.repeat(there, n)
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    start = seg.positions[np.repeat(seg.at[term], n) + within] - np.repeat(rare, n)
    for k in range(1, windows.shape[1]):
        off = by_rarity[w, k]
        ok = (k >= lengths[w]) | seg.has(local[w, off], start + off)
        w, start = w[ok], start[ok]
        if not len(w):
            return none, none
    ok = (start >= 0) & (start + lengths[w] <= seg.n)
    w, start = w[ok], start[ok]
    ok = seg.doc_of(start) == seg.doc_of(start + lengths[w] - 1)
    return w[ok], start[ok]


def item_windows(items: DataFrame) -> DataFrame:
    """The distinct (item, window) pairs; a window is the hashes of its words, 8 bytes each."""
    def run(batches):
        for b in batches:
            for lo, hi, data, off in chunks(b.column("text")):
                h, first = _hashed(data, off)
                for k in range(hi - lo):
                    mine = h[first[k]:first[k + 1]]
                    if len(mine):
                        size = min(WINDOW, len(mine))
                        seen = np.unique(np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(mine, size))
                                         .view(f"V{8 * size}").ravel())
                        yield pa.RecordBatch.from_arrays(
                            [pa.repeat(b.column("item")[lo + k], len(seen)),
                             pa.array([x.tobytes() for x in seen], pa.binary())], ["item", "window"])

    return items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), "text") \
        .mapInArrow(run, "item string, window binary").distinct()


class Block:
    """A bounded set of windows with the items they belong to."""

    SCHEMA = "block string, names array<string>, windows binary, lengths binary, item_at binary, item_no binary"

    def __init__(self, row: dict):
        self.names = np.array(row["names"], object)
        self.windows = np.frombuffer(row["windows"], np.uint64).reshape(-1, WINDOW)  # padded with the first word
        self.lengths = np.frombuffer(row["lengths"], np.int64)
        self.item_at, self.item_no = np.frombuffer(row["item_at"], np.int64), np.frombuffer(row["item_no"], np.int64)
        self.terms = np.unique(self.windows)

    @staticmethod
    def row(name: str, pairs: list[tuple[str, bytes]]) -> pa.RecordBatch:
        names, windows = sorted({i for i, _ in pairs}), sorted({w for _, w in pairs})
        number, place = {x: k for k, x in enumerate(names)}, {x: k for k, x in enumerate(windows)}
        of = np.array([place[w] for _, w in pairs], np.int64)
        item = np.array([number[i] for i, _ in pairs], np.int64)
        order = np.lexsort((item, of))
        padded = np.frombuffer(b"".join(w + w[:8] * (WINDOW - len(w) // 8) for w in windows), np.uint64)
        cells = [padded, np.array([len(w) // 8 for w in windows], np.int64),
                 np.searchsorted(of[order], np.arange(len(windows) + 1)), item[order]]
        return pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([names], pa.list_(pa.string())), *[pa.array([c.tobytes()], pa.binary()) for c in cells]],
            ["block", "names", "windows", "lengths", "item_at", "item_no"])

    def ranked(self, counts: np.ndarray) -> np.ndarray:
        """For each window its word offsets, rarest first, padding last."""
        n = counts[np.searchsorted(self.terms, self.windows)]
        n[np.arange(WINDOW) >= self.lengths[:, None]] = np.iinfo(np.int64).max
        return np.argsort(n, axis=1, kind="stable")

    def spans(self, seg: Segment, by_rarity: np.ndarray):
        """(document, item name, start, end) of the maximal runs of this block's windows, by positions in the segment."""
        w, start = match_windows(seg, self.windows, self.lengths, by_rarity)
        n = self.item_at[w + 1] - self.item_at[w]
        item = self.item_no[np.repeat(self.item_at[w] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        start, end = np.repeat(start, n), np.repeat(start + self.lengths[w], n)
        doc = seg.doc_of(start)
        order = np.lexsort((start, item, doc))
        doc, item, start, end = doc[order], item[order], start[order], end[order]
        group = np.cumsum(np.r_[False, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])]) if len(doc) else doc
        upto = np.maximum.accumulate(end + group * (seg.n + 1)) - group * (seg.n + 1) if len(doc) else end
        new = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (start[1:] > upto[:-1])]) if len(doc) else doc
        last = np.r_[new[1:], len(doc)] - 1 if len(doc) else doc
        return doc[new], self.names[item[new]], start[new], upto[last]


def _read_rows(uris: list[str]) -> Iterator[dict]:
    """The rows of a stored table of blocks, one in memory at a time (read inside tasks)."""
    for uri in uris:
        system, at = filesystem(uri)
        with system.open_input_file(at) as stream:
            for b in pq.ParquetFile(stream).iter_batches(batch_size=1):
                yield from b.to_pylist()


def item_blocks(index: DataFrame, items: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The stored blocks of all items, each window with its order of rarity in ``index``."""
    pairs = stored(item_windows(items), "item-windows")

    def cut(batches):
        part, k, held = TaskContext.get().partitionId(), 0, []
        for b in batches:
            held += zip(b.column("item").to_pylist(), b.column("window").to_pylist())
            while len(held) >= block_words:
                yield Block.row(f"{part}-{k}", held[:block_words])
                held, k = held[block_words:], k + 1
        if held:
            yield Block.row(f"{part}-{k}", held)

    # a range of (item, window) keeps an item together, yet one id with very many texts is divided
    ranges = max(1, -(-pairs.count() // block_words))
    blocks = stored(pairs.repartitionByRange(ranges, "item", "window").sortWithinPartitions("item", "window")
                    .mapInArrow(cut, Block.SCHEMA), "item-blocks")
    counts = term_frequencies(index, blocks.inputFiles())

    def rank(block: pd.DataFrame, count: pd.DataFrame) -> pd.DataFrame:
        held = Block(block.iloc[0])
        n = np.zeros(len(held.terms), np.int64)
        n[count["term"].to_numpy(np.int64)] = count["n"].to_numpy(np.int64)
        return block.assign(by_rarity=[held.ranked(n).astype(np.int64).tobytes()])

    return stored(blocks.groupBy("block").cogroup(counts.groupBy("block"))
                  .applyInPandas(rank, Block.SCHEMA + ", by_rarity binary"), "ranked-blocks")


def _postings(terms: np.ndarray, segments: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    total = np.zeros(len(terms), np.int64)
    for have, n in segments:
        if len(have):
            k = np.minimum(np.searchsorted(have, terms), len(have) - 1)
            total += np.where(have[k] == terms, n[k], 0)
    return total


def _lists(b: pa.RecordBatch) -> list[tuple[np.ndarray, np.ndarray]]:
    return [(np.frombuffer(t.as_buffer(), np.uint64), np.frombuffer(c.as_buffer(), "<u4"))
            for t, c in zip(b.column("terms"), b.column("counts"))]


def term_frequencies(index: DataFrame, uris: list[str]) -> DataFrame:
    """block, term (its number among the block's sorted terms), n: postings in the whole index."""
    def run(batches):
        for b in batches:
            lists = _lists(b)
            for row in _read_rows(uris):
                total = _postings(Block(row).terms, lists)
                k = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.repeat(row["block"], len(k)), pa.array(k, pa.int64()),
                                                  pa.array(total[k], pa.int64())], ["block", "term", "n"])

    tasks = max(1, -(-index.count() // COUNTED_SEGMENTS))
    return index.select("terms", "counts").coalesce(tasks).mapInArrow(run, "block string, term long, n long") \
        .groupBy("block", "term").agg(F.sum("n").alias("n"))


def span_pieces(index: DataFrame, items: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """segment, doc_no, item, start, end: the spans of :func:`phrase_spans`; those of
    an item whose windows lie in several blocks come in pieces that may overlap."""
    uris = item_blocks(index, items, block_words).inputFiles()

    def run(batches):
        for b in batches:
            rows = b.to_pylist()
            for row in _read_rows(uris):
                block = Block(row)
                by_rarity = np.frombuffer(row["by_rarity"], np.int64).reshape(-1, WINDOW)
                for r in rows:
                    seg = Segment(r["terms"], r["counts"], r["positions"], r["doc_words"])
                    doc, item, start, end = block.spans(seg, by_rarity)
                    if len(doc):
                        base = seg.first[doc]
                        yield pa.RecordBatch.from_arrays([
                            pa.repeat(r["segment"], len(doc)), pa.array(doc, pa.int32()), pa.array(item, pa.string()),
                            pa.array(start - base, pa.int64()), pa.array(end - base, pa.int64())],
                            ["segment", "doc_no", "item", "start", "end"])

    return index.mapInArrow(run, "segment string, doc_no int, item string, start long, end long")


def phrase_spans(index: DataFrame, items: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """segment, doc_no, item, start, end: maximal runs of overlapping or adjacent
    window occurrences of one item in one document (word positions in it)."""
    own = Window.partitionBy("segment", "doc_no", "item").orderBy("start", "end")
    before = F.max("end").over(own.rowsBetween(Window.unboundedPreceding, -1))
    run = F.sum("new").over(own.rowsBetween(Window.unboundedPreceding, 0))
    return span_pieces(index, items, block_words) \
        .withColumn("new", F.when(F.col("start") <= before, 0).otherwise(1)).withColumn("run", run) \
        .groupBy("segment", "doc_no", "item", "run").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("run")


def proximity_matches(index: DataFrame, queries: dict[str, list[str]], slop: int) -> DataFrame:
    """query, segment, doc_no, start, end: every minimal stretch of at most ``slop``
    words of one document that holds all words of a query, in any order."""
    want = {q: np.unique(_hashed(np.frombuffer(" ".join(w).encode(), np.uint8),
                                 np.array([0, len(" ".join(w).encode())]))[0]) for q, w in queries.items()}
    terms = np.unique(np.concatenate([*want.values(), np.zeros(0, np.uint64)]))
    freq = np.zeros(len(terms), np.int64)

    def count(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([_postings(terms, _lists(b))], pa.list_(pa.int64()))], ["n"])

    if len(terms):  # one number for each word of the given queries
        per = index.select("terms", "counts").mapInArrow(count, "n array<long>").select(F.posexplode("n").alias("term", "n"))
        for row in per.groupBy("term").agg(F.sum("n").alias("n")).collect():
            freq[row["term"]] = row["n"]
    plan = {q: h[np.argsort(freq[np.searchsorted(terms, h)], kind="stable")] for q, h in want.items() if len(h)}

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                seg = Segment(row["terms"], row["counts"], row["positions"], row["doc_words"])
                for q, h in plan.items():
                    local = seg.find(h)
                    if (local < 0).any():
                        continue
                    lists = [seg.positions[seg.at[t]:seg.at[t + 1]] for t in local]
                    start = np.unique(np.concatenate(lists))
                    end = start
                    for p in lists:  # rarest first: most starts go at once
                        k = np.searchsorted(p, start)
                        ok = k < len(p)
                        start, end, k = start[ok], end[ok], k[ok]
                        end = np.maximum(end, p[k])
                        ok = end - start < slop
                        start, end = start[ok], end[ok]
                    ok = seg.doc_of(start) == seg.doc_of(end)
                    start, end = start[ok], end[ok]
                    tight = np.r_[end[1:] > end[:-1], True] if len(end) else np.zeros(0, bool)
                    start, end = start[tight], end[tight]
                    if len(start):
                        doc = seg.doc_of(start)
                        yield pa.RecordBatch.from_arrays([
                            pa.array([q] * len(doc)), pa.array([row["segment"]] * len(doc)), pa.array(doc, pa.int32()),
                            pa.array(start - seg.first[doc], pa.int64()), pa.array(end + 1 - seg.first[doc], pa.int64())],
                            ["query", "segment", "doc_no", "start", "end"])

    return index.mapInArrow(run, "query string, segment string, doc_no int, start long, end long")


def indexed_documents(index: DataFrame) -> DataFrame:
    """segment, doc_no, doc_id, n_words of every document of the index."""
    d = index.select("segment", F.posexplode(F.arrays_zip("doc_ids", "doc_words")).alias("doc_no", "d"))
    return d.select("segment", "doc_no", F.col("d.doc_ids").alias("doc_id"), F.col("d.doc_words").alias("n_words"))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document: n_words, n_hit (words inside any occurrence), n_items, items_sha256, contaminated."""
    index = build_index(docs, id_col)
    spans = stored(span_pieces(index, items), "phrase-spans")
    # length of the union of a document's spans, swept in order of their starts
    sweep = F.aggregate(
        F.array_sort(F.collect_list(F.struct("start", "end"))),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto")),
        lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], a["upto"]))).alias("n"),
                              F.greatest(a["upto"], s["end"]).alias("upto")))["n"]
    hits = spans.groupBy("segment", "doc_no").agg(sweep.alias("n_hit"), F.array_sort(F.collect_set("item")).alias("items"))
    out = indexed_documents(index).join(hits, ["segment", "doc_no"], "left")
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0))
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(items_of).cast("long").alias("n_items"),
                      F.sha2(F.array_join(items_of, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark passage (columns kept)."""
    keyed = docs.withColumn("__sf_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    bad = contamination(keyed, items, "__sf_key").where("contaminated") \
        .select(F.col("doc_id").alias("__sf_key")).distinct()
    return keyed.join(bad, "__sf_key", "left_anti").select(*[f"`{c}`" for c in docs.columns])
