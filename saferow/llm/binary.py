"""Token ids in files of independent zstandard frames with a seek table.

A file holds, in ascending document order, one zstandard frame per document
(its ids, little endian, 2 bytes each if the vocabulary allows, else 4), then a
skippable frame with the document ids, then the seek table of the published
zstandard seekable format: per frame the two sizes and a checksum (the low 32
bits of XXH64 of the content), and a footer.  A reader takes the footer and the
table from the end and then decompresses only the frames it wants; any
zstandard tool can also read the whole file.

Writing: rows are dealt by range of the document id and sorted in each task;
each task writes one file under a name of its own attempt, and the manifest
(a Parquet table written by Spark from the tasks that succeeded) names the files
that count, so retried or lost tasks leave no wrong data.  ``base`` in the
manifest is the number of ids in all files before; ``least`` and ``greatest`` are
the ends of a file's ids, so a look-up opens only the files that can hold an id.
A task starts a new file after ``FILE_IDS`` ids, so files stay bounded while the
data grow.

Defined results: null text is an empty document (just the end id); null ids come
first; rows of equal id are ordered by text; an empty table gives no files.  Equal
rows are told apart by their place in the input, so that a row repeated very often
is spread over many files; ``docs`` should therefore be read from a stored table,
whose rows keep their places when a lost task runs again.
"""

from __future__ import annotations

import array
import struct
import sys
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from saferow.llm.common import filesystem, qualified, stored
from saferow.llm.tokens import Recent, Splitter, _loaded, byte_letters

# Fixed values of the published format.
SEEK_FRAME, INDEX_FRAME, SEEK_MAGIC = 0x184D2A5E, 0x184D2A50, 0x8F92EAB1
END_ID = 0
#: A file is closed once it holds this many ids (a longer document: alone in its file's end).
FILE_IDS = 1 << 26
READ_ROWS = 1 << 13


def encoder(path: str):
    """text -> ids as bytes.  Pieces are encoded by the tokenizers library once
    and kept in a bounded cache; a piece's ids do not depend on its neighbours."""
    if ("encode", path) not in _loaded:
        split = Splitter(path)
        width = "<u2" if split.library.get_vocab_size() <= 1 << 16 else "<u4"

        letters = byte_letters()
        tokenize, code = split.library.model.tokenize, "H" if width == "<u2" else "I"

        def make(piece: str) -> bytes:  # what the library does with a piece: its bytes as letters, then its model
            ids = array.array(code, [t.id for t in tokenize(piece.encode().decode("latin-1").translate(letters))])
            if sys.byteorder == "big":
                ids.byteswap()
            return ids.tobytes()

        cache = Recent(make)
        special = {s: np.array([i], width).tobytes() for s, i in split.special.items()}

        def encode(text: str) -> bytes:
            out = []
            for k, part in enumerate(split.segments(text)):
                if k % 2:
                    out.append(special[part])
                else:
                    out.extend(map(cache.__getitem__, split.plain(part)))
            return b"".join(out)

        _loaded["encode", path] = encode, width
    return _loaded["encode", path]


class FrameWriter:
    """Frames, document index and seek table to an open binary stream."""

    def __init__(self, stream, width: str, level: int = 3):
        self.stream, self.width, self.table, self.ids = stream, width, [], []
        self.zstd = zstandard.ZstdCompressor(level=level)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        frame = self.zstd.compress(ids)
        self.stream.write(frame)
        self.table.append((len(frame), len(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF))
        self.ids.append(doc_id)

    def close(self) -> None:
        null = np.array([i is None for i in self.ids], np.uint8)
        known = np.array([0 if i is None else i for i in self.ids], "<i8")
        index = struct.pack("<IB", len(self.ids), int(self.width[-1])) + known.tobytes() + null.tobytes()
        index = struct.pack("<II", INDEX_FRAME, len(index)) + index
        self.stream.write(index)
        entries = [*self.table, (len(index), 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF)]
        body = b"".join(struct.pack("<III", *e) for e in entries)
        body += struct.pack("<IBI", len(entries), 0x80, SEEK_MAGIC)
        self.stream.write(struct.pack("<II", SEEK_FRAME, len(body)) + body)
        self.stream.close()


class FrameReader:
    """Random access to the documents of one file (an open seekable stream)."""

    def __init__(self, stream):
        self.stream = stream
        size = stream.seek(0, 2)
        stream.seek(size - 9)
        n, flags, magic = struct.unpack("<IBI", stream.read(9))
        if magic != SEEK_MAGIC or not flags & 0x80:
            raise ValueError("no seek table with checksums at the end of the file")
        stream.seek(size - 9 - 12 * n)
        table = np.frombuffer(stream.read(12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.at = np.concatenate([[0], np.cumsum(table[:, 0])])
        stream.seek(int(self.at[n - 1]))
        raw = stream.read(int(table[n - 1, 0]))
        if struct.unpack("<I", raw[:4])[0] != INDEX_FRAME:
            raise ValueError("no document index")
        count, width = struct.unpack("<IB", raw[8:13])
        known, null = np.frombuffer(raw[13:13 + 8 * count], "<i8"), np.frombuffer(raw[13 + 8 * count:], np.uint8)
        self.doc_ids = [None if b else int(i) for i, b in zip(known, null)]
        self.width, self.table = f"<u{width}", table
        self.zstd = zstandard.ZstdDecompressor()

    def __len__(self) -> int:
        return len(self.doc_ids)

    def ids(self, k: int) -> np.ndarray:
        """The ids of the k-th document; only its frame is read."""
        self.stream.seek(int(self.at[k]))
        raw = self.zstd.decompress(self.stream.read(int(self.table[k, 0])), max_output_size=int(self.table[k, 1]) or 1)
        if len(raw) != self.table[k, 1] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.table[k, 2]:
            raise ValueError(f"checksum of frame {k} does not match")
        return np.frombuffer(raw, self.width)


def write_token_files(docs: DataFrame, folder: str, path: str, files: int | None = None,
                      file_ids: int = FILE_IDS) -> DataFrame:
    """Write the frames below ``folder``; gives the stored manifest (file_no, uri, n_docs,
    n_ids, least, greatest, base).  ``files``: ranges of ids, one task each (the session's
    shuffle partitions); a task writes several files if it has more than ``file_ids`` ids."""
    spark = docs.sparkSession
    folder = qualified(spark, folder)

    def run(batches):
        encode, width = encoder(path)
        end = np.array([END_ID], width).tobytes()
        part, no, writer, n_ids = TaskContext.get().partitionId(), 0, None, 0

        def closed():
            writer.close()
            known = [i for i in writer.ids if i is not None]  # in ascending order
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "no": pa.array([no], pa.int32()), "uri": [uri],
                "n_docs": [len(writer.ids)], "n_ids": [n_ids], "least": pa.array(known[:1] or [None], pa.int64()),
                "greatest": pa.array(known[-1:] or [None], pa.int64())})

        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                if writer is None:
                    uri = f"{folder}/tokens-{part:06d}-{no:06d}-{uuid.uuid4().hex}.zst"
                    system, at = filesystem(uri)
                    system.create_dir(at.rpartition("/")[0], recursive=True)
                    writer, n_ids = FrameWriter(system.open_output_stream(at, compression=None), width), 0
                ids = (encode(text) if text else b"") + end
                writer.add(doc_id, ids)
                n_ids += len(ids) // int(width[-1])
                if n_ids >= file_ids:
                    yield closed()
                    writer, no = None, no + 1
        if writer is not None:
            yield closed()

    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"),
                       F.monotonically_increasing_id().alias("place"))
    done = (rows.repartitionByRange(n, "doc_id", "tie", "place").sortWithinPartitions("doc_id", "tie", "text")
            .select("doc_id", "text")
            .mapInArrow(run, "part int, no int, uri string, n_docs long, n_ids long, least long, greatest long"))
    done = stored(done, "token-files")
    inside = Window.partitionBy("part").orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    ranges = done.groupBy("part").agg(F.sum("n_ids").alias("all"))  # one row for each range of ids
    ranges = ranges.select("part", F.coalesce(F.sum("all").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    return done.withColumn("own", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(ranges, "part").select(
        ((F.col("part").cast("long") * (1 << 32)) + F.col("no")).alias("file_no"), "uri", "n_docs", "n_ids", "least", "greatest",
        (F.col("base") + F.col("own")).cast("long").alias("base"))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]

    def packed(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            for uri, start in zip(b.column("uri").to_pylist(), b.column("base").to_pylist()):
                system, at = filesystem(uri)
                with system.open_input_file(at) as stream:
                    reader, rows = FrameReader(stream), []
                    for k, doc_id in enumerate(reader.doc_ids):
                        ids = reader.ids(k)
                        rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        start += len(ids)
                        if len(rows) == READ_ROWS:
                            yield packed(rows)
                            rows = []
                if rows:
                    yield packed(rows)

    n = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return manifest.select("uri", "base", "file_no").repartition(n, "file_no").drop("file_no") \
        .mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_document(spark: SparkSession, manifest: DataFrame, doc_id: int) -> list[np.ndarray]:
    """The ids of the documents with this id: opens the files whose ids span it, decompresses only their frames."""
    found = []
    for row in manifest.where(F.lit(doc_id).between(F.col("least"), F.col("greatest"))).orderBy("file_no").toLocalIterator():
        system, at = filesystem(row["uri"])
        with system.open_input_file(at) as stream:
            reader = FrameReader(stream)
            found += [reader.ids(k) for k, i in enumerate(reader.doc_ids) if i == doc_id]
    return found
