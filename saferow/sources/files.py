"""File sources and sinks.

Reads are plain Spark scans (partitioned, column-pruned, filter push-down for
Parquet); format dispatch and path checks happen on the driver before any job
runs.  Every read normalises NaN to NULL, the one missing-value marker.
"""

from __future__ import annotations

import hashlib
import json
import logging
import os
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import Optional, Sequence, Union

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saferow.functions.exprs import nan_to_null
from saferow.sources.json_arrays import read_arrays

log = logging.getLogger(__name__)

SUPPORTED_FORMATS = ("csv", "json", "parquet")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence through the Hadoop file system of the path (local, HDFS, object stores)."""
    jvm = spark.sparkContext._jvm  # noqa: SLF001
    conf = spark.sparkContext._jsc.hadoopConfiguration()  # noqa: SLF001
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(conf).exists(p))


def detect_format(path: str, file_format: Optional[str] = None) -> str:
    """Explicit format (leading dot stripped) or the lower-cased suffix."""
    fmt = (file_format or os.path.splitext(path.rstrip("/"))[1]).lstrip(".").lower()
    if fmt not in SUPPORTED_FORMATS:
        raise ValueError(f"cannot read or write {fmt!r}; known formats: {', '.join(SUPPORTED_FORMATS)}")
    return fmt


# Fixed value: the cells that a CSV reader with the usual defaults takes as missing.
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
             "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
_CSV = {"header": True, "escape": '"', "mode": "PERMISSIVE", "enforceSchema": False}


def _as_struct(schema: Union[T.StructType, str]) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def _csv_cells(spark: SparkSession, path: str, **options) -> DataFrame:
    """All cells as text under the header's names; the missing-value tokens are NULL."""
    raw = spark.read.options(**{**_CSV, **options}).csv(path)
    return raw.select(*[F.when(~F.col(f"`{c}`").isin(*NA_TOKENS), F.col(f"`{c}`")).alias(c) for c in raw.columns])


def read_csv(spark: SparkSession, path: str, schema: Union[T.StructType, str], **options) -> DataFrame:
    """Columns are taken by header name and cast one by one; a cell that does not
    parse is NULL and is counted by :func:`csv_bad_cells`.  A column the file lacks is
    NULL.  Whole numbers with a decimal point ("5.0") are accepted for integer columns."""
    cells = _csv_cells(spark, path, **options)
    return cells.select(*[_typed(f, cells.columns).alias(f.name) for f in _as_struct(schema).fields])


def _typed(f: T.StructField, have: Sequence[str]) -> Column:
    if f.name not in have:
        return F.lit(None).cast(f.dataType)
    cell = F.col(f"`{f.name}`")
    if isinstance(f.dataType, T.IntegralType):
        number = cell.try_cast("double")
        return F.coalesce(cell.try_cast(f.dataType), F.when(number == F.floor(number), number.try_cast(f.dataType)))
    return cell.try_cast(f.dataType)


def csv_bad_cells(spark: SparkSession, path: str, schema: Union[T.StructType, str], **options) -> DataFrame:
    """column_name, bad_cells: cells that are there but do not parse as their type."""
    cells = _csv_cells(spark, path, **options)
    fields = [f for f in _as_struct(schema).fields if f.name in cells.columns]
    counts = cells.agg(*[F.count_if(F.col(f"`{f.name}`").isNotNull() & _typed(f, cells.columns).isNull()).alias(f.name)
                         for f in fields])
    pairs = F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.col(f"`{f.name}`").alias("bad_cells"))
                      for f in fields])
    return counts.select(F.explode(pairs).alias("c")).select("c.column_name", "c.bad_cells")


def read_json(spark: SparkSession, path: str, schema: Optional[Union[T.StructType, str]] = None, **options) -> DataFrame:
    """A file or folder of JSON, sub-folders included; each file's first character (after
    its codec) says whether it is one array or JSON Lines.  The JSON Lines files are one
    scan, the arrays are cut into elements by many tasks
    (:mod:`saferow.sources.json_arrays`), and the two are united."""
    kinds: dict[bool, list[str]] = {True: [], False: []}
    for file, is_array in _json_kinds(spark, path):
        kinds[is_array].append(file)
    reader = (spark.read if schema is None else spark.read.schema(schema)).options(**options)
    parts = []
    if kinds[True]:
        parts.append(read_arrays(spark, kinds[True], schema, **options))
    if kinds[False]:
        parts.append(reader.json(kinds[False]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else reader.json(path)


#: Files whose first bytes are looked at together.
PEEK_THREADS = 16


def _json_kinds(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(file, is one array) of the data files at and below ``path``; a few bytes of each are read."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()  # noqa: SLF001
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    found, files = fs.listFiles(p, True), []
    root = fs.makeQualified(p).toUri().getPath().rstrip("/")
    while found.hasNext():
        s = found.next()
        below = s.getPath().toUri().getPath()[len(root):].split("/")
        if s.getLen() and not any(part.startswith(("_", ".")) for part in below):
            files.append(s.getPath())
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def kind(file) -> tuple[str, bool]:
        codec, stream = codecs.getCodec(file), fs.open(file)
        try:
            if codec is not None:
                stream = codec.createInputStream(stream)
            first = stream.read()
            while first in (32, 9, 10, 13, 0xEF, 0xBB, 0xBF):
                first = stream.read()
        finally:
            stream.close()
        return file.toString(), first == ord("[")

    with ThreadPoolExecutor(PEEK_THREADS) as pool:
        return list(pool.map(kind, files))


def read_table(spark: SparkSession, path: str, file_format: Optional[str] = None,
               schema: Optional[Union[T.StructType, str]] = None, normalize_nan: Optional[bool] = None,
               **options) -> DataFrame:
    """Read CSV (header), JSON (arrays or JSON Lines, file by file) or Parquet.

    With a schema, CSV and JSON are read by name without inference; the usual
    missing-value tokens of a CSV cell become NULL.  Without a schema, CSV types are
    inferred (a full extra pass: avoid on large inputs).

    ``NaN`` cells become NULL for the text formats.  Parquet is left untouched by
    default: rewriting every double column would stop filters from reaching the
    scan.  Pass ``normalize_nan=True`` to force it.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no such path: {path}")
    fmt = detect_format(path, file_format)
    if fmt == "csv":
        df = read_csv(spark, path, schema, **options) if schema is not None else \
            spark.read.options(**{**_CSV, "nullValue": "NA", "inferSchema": True, **options}).csv(path)
    elif fmt == "json":
        df = read_json(spark, path, schema, **options)
    else:
        df = (spark.read if schema is None else spark.read.schema(schema)).options(**options).parquet(path)
    if normalize_nan is None:
        normalize_nan = fmt != "parquet"
    return nan_to_null(df) if normalize_nan else df


OUTCOME = "path string, status string, n_rows long, error string"
#: Paths that are tried at the same time, and characters of an error that is kept.
TRY_THREADS, ERROR_CHARS = 8, 2000


def load_each(spark: SparkSession, paths: Sequence[str], file_format: Optional[str] = None,
              schema: Optional[Union[T.StructType, str]] = None, **options) -> tuple[list[DataFrame], DataFrame]:
    """(the tables that can be read, the outcome of every path: path, status, n_rows, error).

    A path counts as readable only if every row and column of it was: one job per path
    decodes all of it (nothing is stored), so a file that breaks in its middle is
    skipped as a whole, as one that is missing.  Jobs run ``TRY_THREADS`` at a time."""
    def attempt(path: str):
        try:
            df = read_table(spark, path, file_format, schema, **options)
            decoded = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]) \
                if df.columns else F.lit(0)
            n = df.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(decoded).alias("all")).first()["n"]
            return df, (path, "loaded", n, None)
        except Exception as e:  # noqa: BLE001 - a path that fails is skipped, with a warning
            if spark.sparkContext._jsc.sc().isStopped():  # noqa: SLF001
                raise
            log.warning("skipped %s: %s", path, e)
            return None, (path, "skipped", 0, str(e)[:ERROR_CHARS])

    with ThreadPoolExecutor(TRY_THREADS) as pool:
        tried = [x.result() for x in [pool.submit(inheritable_thread_target(spark)(attempt), p) for p in paths]]
    return [df for df, _ in tried if df is not None], spark.createDataFrame([o for _, o in tried], OUTCOME)


def read_many(spark: SparkSession, paths: Sequence[str], file_format: Optional[str] = None,
              schema: Optional[Union[T.StructType, str]] = None, combine: bool = True,
              **options) -> Union[DataFrame, list[DataFrame]]:
    """The paths that can be read (:func:`load_each`), appended with columns aligned
    by name (gaps are NULL).  ``combine=False`` or nothing loaded returns the list."""
    frames, _ = load_each(spark, paths, file_format, schema, **options)
    if not combine or not frames:
        return frames
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def write_table(df: DataFrame, path: str, file_format: Optional[str] = None, mode: str = "overwrite",
                **options) -> str:
    """Write CSV (header, no index), JSON (JSON Lines: one object per line,
    not one array) or Parquet as a directory of part files, and last its manifest."""
    fmt = detect_format(path, file_format)
    w = df.write.mode(mode).options(**options)
    if fmt == "csv":
        w.options(**{"header": True, "escape": '"', **options}).csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.parquet(path)
    seal(df.sparkSession, path)
    return path


#: Name of the manifest: Spark's readers pass over names that begin with an underscore.
MANIFEST = "_manifest.json"


def _data_files(fs, root) -> dict:
    """What the manifest says: number and bytes of the data files below ``root``, and a hash of names and sizes."""
    base, found, files = fs.makeQualified(root).toUri().getPath().rstrip("/"), fs.listFiles(root, True), []
    while found.hasNext():
        s = found.next()
        below = s.getPath().toUri().getPath()[len(base) + 1:]
        if not any(part.startswith(("_", ".")) for part in below.split("/")):
            files.append((below, s.getLen()))
    listing = "".join(f"{name} {size}\n" for name, size in sorted(files))
    return {"files": len(files), "bytes": sum(n for _, n in files), "listing": hashlib.sha256(listing.encode()).hexdigest()}


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p  # noqa: SLF001


def seal(spark: SparkSession, path: str) -> None:
    """Write the manifest of the finished folder ``path`` (data files of sub-folders
    included); it appears whole or not at all, and after all it speaks of."""
    fs, p = _hadoop(spark, path)
    jvm = spark.sparkContext._jvm  # noqa: SLF001
    final, new = (jvm.org.apache.hadoop.fs.Path(p, name) for name in (MANIFEST, f"_{uuid.uuid4().hex}.tmp"))
    stream = fs.create(new, True)
    stream.write(bytearray(json.dumps(_data_files(fs, p)).encode()))
    stream.close()
    fs.delete(final, False)
    if not fs.rename(new, final):
        raise OSError(f"the manifest of {path} could not be put in place")


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a file, or a folder whose files are those of its manifest.  A folder
    that another writer left has none: it is complete if it has Spark's success mark, or
    holds data and no sign of a write under way."""
    fs, p = _hadoop(spark, path)
    if not fs.exists(p):
        return False
    if fs.getFileStatus(p).isFile():
        return True
    manifest = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, MANIFEST)  # noqa: SLF001
    if fs.exists(manifest):
        stream = fs.open(manifest)
        try:
            said = json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()
        return said == _data_files(fs, p)
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return "_SUCCESS" in names or "_temporary" not in names and _data_files(fs, p)["files"] > 0


def write_lines(lines: DataFrame, path: str) -> str:
    """A one-column string table as a text file (one part)."""
    lines.coalesce(1).write.mode("overwrite").text(path)
    return path


def load_or_generate(spark: SparkSession, path: str, n_samples: int = 5000, seed: int = 42,
                     contamination_ratio: float = 0.3, file_format: Optional[str] = None,
                     schema: Optional[T.StructType] = None, keys: Optional[DataFrame] = None) -> DataFrame:
    """Read the table if the path holds a complete one (:func:`is_complete`), else
    generate it (``n_samples`` rows, or one per row of ``keys``), persist it there and read
    the persisted copy back (so later stages do not recompute it).  What a killed write
    left is not taken for a table: it is written anew."""
    if is_complete(spark, path):
        return read_table(spark, path, file_format, schema)
    from saferow.sources.synth import generate

    gen = generate(spark, n=n_samples, keys=keys, seed=seed, contamination_ratio=contamination_ratio)
    write_table(gen, path, file_format)
    return read_table(spark, path, file_format, schema or gen.schema)
