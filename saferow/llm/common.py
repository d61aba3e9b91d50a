"""Shared helpers: the shared scratch folder, and texts as flat byte arrays.

Operators work on whole texts.  A task walks its Arrow batches in chunks of a
few MB of bytes (:func:`chunks`), finds the words of all documents of a chunk
with vectorised byte operations and identifies each word by a 64-bit hash.
A single text larger than a chunk is still handled whole.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that one vectorised step handles (a longer text: alone).
CHUNK_BYTES = 1 << 21


# ------------------------------------------------------------- shared folder
def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting (tests) gets a private folder; a
    cluster without it is an error, since executors do not share local disks.
    """
    sc = spark.sparkContext
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    conf = conf or sc.getCheckpointDir()
    if not conf:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="saferow-llm-")
        sc.setCheckpointDir(conf)
    return conf.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, deleted when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/llm-scratch/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(p)
    fs.deleteOnExit(p)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: it is computed once,
    its lineage ends there and a lost executor costs no more than a re-read."""
    spark = df.sparkSession
    path = scratch(spark, name) + "/t"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the file system that Spark itself would write to,
    so that files which tasks open by themselves land in the same place."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()


def filesystem(uri: str):
    """pyarrow's file system for a qualified path, and the path there."""
    return pafs.FileSystem.from_uri("file://" + uri[5:] if uri.startswith("file:/") and uri[6:7] != "/" else uri)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------ texts as bytes
def text_bytes(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, row offsets) of an Arrow string column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, off


def chunks(col, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of runs of rows of about ``limit`` bytes."""
    raw, off = text_bytes(col)
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        hi = min(hi, lo + 65536)
        yield lo, hi, raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Table over the 256 byte values: True inside the inclusive ranges."""
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a:b + 1] = True
    return out


#: Word bytes of ``[^\x20\x09-\x0D]+`` (continuation bytes are word bytes too).
NON_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: Lower-cases A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words(data: np.ndarray, off: np.ndarray, word_byte: np.ndarray):
    """(starts, ends, first word of each row plus the total) of maximal runs of
    word bytes; a run never crosses a row boundary."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    w = word_byte[data]
    before = np.empty_like(w)
    before[0], before[1:] = False, w[:-1]
    after = np.empty_like(w)
    after[-1], after[:-1] = False, w[1:]
    inner = off[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    before[inner] = False
    after[inner - 1] = False
    starts, ends = np.flatnonzero(w & ~before), np.flatnonzero(w & ~after) + 1
    return starts, ends, np.searchsorted(starts, off).astype(np.int64)


# -------------------------------------------------------------------- hashes
def scramble(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift and multiply rounds)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


BYTE_KEY = scramble(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D))
_BASE, _MASK = 0x5851F42D4C957F2D, (1 << 64) - 1
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base**i`` modulo 2**64 for i < n, kept and doubled as needed."""
    have = _powers.get(base)
    if have is None:
        have = np.ones(1, np.uint64)
    while len(have) < n:
        step = np.uint64(pow(base, len(have), 1 << 64))
        have = np.concatenate([have, have * step])
    _powers[base] = have if len(have) <= 1 << 23 else have[:1 << 23]
    return have[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span (the same bytes give the same value anywhere)."""
    n = len(data)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_KEY[data] * powers(_BASE, n), out=total[1:])
    back = powers(pow(_BASE, -1, 1 << 64), n + 1)
    return scramble((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive entries (rows are not regarded)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * np.uint64(0x9FB21C651E98DF25) + h[j:j + n]
    return scramble(out)


def inside_row(first: np.ndarray, n: int, k: int) -> np.ndarray:
    """Mask over the n-k+1 run starts: True where the run of k stays in one row."""
    m = n - k + 1
    if m <= 0:
        return np.zeros(0, bool)
    row = np.searchsorted(first[1:], np.arange(n), "right")
    return row[:m] == row[k - 1:]


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mask over n positions: True inside any of the spans [start, end)."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, starts, 1)
    np.add.at(d, ends, -1)
    return np.cumsum(d[:n]) > 0
