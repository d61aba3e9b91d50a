"""Files that hold one JSON array, read by many tasks.

Spark cuts JSON only at line ends, so a file that is one array goes to one task.
Here the file is read by the splittable text source with ``}`` as the line separator:
its pieces are dealt by byte range, whatever the line breaks, and a compressed file comes
through its codec.  Whether a ``}`` ends an element depends on everything before it
(inside a string?  how deep?), so

1. a first pass sums up each byte range: under either assumption about its start
   (outside or inside a string), whether it ends inside a string and by how much
   the nesting grows.  Summaries are one row per range; put one after the other, they give
   the state at the start of every range.
2. Only where a file has several ranges, a second pass takes the ends of elements that
   began in an earlier range and the starts of those that go on (two short texts a
   range), which are joined in order.
3. The elements are then read range by range from a known state, as one JSON text each,
   and parsed by Spark's JSON reader (with its options, with or without a schema).

No backslash escape can reach over a ``}``, so string and nesting are the whole state.

Defined results: elements are objects; an empty array gives no rows; a file that does not
end its array is an error that names it; line breaks inside an element become spaces.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Optional, Union

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Most ranges whose states are handed to the tasks (one small row each; at 128 MB a range, 250 TB of arrays).
MAX_RANGES = 2_000_000

_QUOTE, _ESCAPE, _OPEN, _CLOSE = ord('"'), ord("\\"), b"{[", b"}]"
_DEPTH = np.zeros(256, np.int8)
_DEPTH[list(_OPEN)], _DEPTH[list(_CLOSE)] = 1, -1
_MARK = _DEPTH != 0
_MARK[_QUOTE] = True
_BYTES = pa.large_binary()
Range = tuple[str, int]


def _marks(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places of quotes and brackets, which byte each is, quotes up to and with it);
    quotes that a backslash escapes are left out."""
    at = np.flatnonzero(_MARK[data])
    kind = data[at]
    escape = data == _ESCAPE
    if escape.any():
        quote = np.flatnonzero(kind == _QUOTE)
        other = np.where(escape, -1, np.arange(len(data)))
        last = np.r_[-1, np.maximum.accumulate(other)[:-1]][at[quote]]  # last byte before the quote that is no backslash
        real = np.ones(len(at), bool)
        real[quote] = (at[quote] - 1 - last) % 2 == 0
        at, kind = at[real], kind[real]
    return at, kind, np.cumsum(kind == _QUOTE)


def _brackets(marks: tuple, inside: bool) -> tuple[np.ndarray, np.ndarray, bool]:
    """(places of the brackets outside strings, which byte each is, whether the text ends
    inside a string) for text that starts ``inside`` a string or not."""
    at, kind, quotes = marks
    out = (kind != _QUOTE) & ((quotes + inside) % 2 == 0)
    return at[out], kind[out], bool(((int(quotes[-1]) if len(quotes) else 0) + inside) % 2)


def _joined(values: pa.Array) -> np.ndarray:
    """The pieces with a separator after each, as bytes."""
    whole = pc.binary_join_element_wise(values.cast(_BYTES), *[pa.scalar(x, _BYTES) for x in (b"", b"}")])
    lo, hi = np.frombuffer(whole.buffers()[1], np.int64)[[whole.offset, whole.offset + len(whole)]]
    return np.frombuffer(whole.buffers()[2], np.uint8)[lo:hi]


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Range, pa.Array]]:
    """Runs of rows of one byte range, in order."""
    for b in batches:
        if not b.num_rows:
            continue
        start = b.column("start").to_numpy()
        file = b.column("file").dictionary_encode()
        code = file.indices.to_numpy()
        cut = np.r_[0, np.flatnonzero((start[1:] != start[:-1]) | (code[1:] != code[:-1])) + 1, b.num_rows]
        for lo, hi in zip(cut[:-1], cut[1:]):
            yield (file.dictionary[int(code[lo])].as_py(), int(start[lo])), b.column("value").slice(lo, hi - lo)


class _Walk:
    """Follows one byte range from a known state and cuts out its elements."""

    def __init__(self, inside: bool, depth: int):
        self.inside, self.depth = inside, depth
        self.held, self.first = [], True  # text since the last end of an element; whether there was none yet
        self.head = None  # what ends an element of an earlier range

    def feed(self, data: np.ndarray) -> list[bytes]:
        at, kind, self.inside = _brackets(_marks(data), self.inside)
        depth = self.depth + np.cumsum(_DEPTH[kind], dtype=np.int64)
        self.depth = int(depth[-1]) if len(depth) else self.depth
        ends = at[(depth == 1) & (kind == ord("}"))] + 1
        out, lo, raw = [], 0, data.tobytes()
        for e in ends.tolist():
            text = b"".join([*self.held, raw[lo:e]])
            self.held, lo = [], e
            if self.first:
                self.head, self.first = text, False
            else:
                out.append(text)
        self.held.append(raw[lo:])
        return out

    def tail(self) -> bytes:
        return b"".join(self.held)


def _element(text: bytes) -> str:
    """From the first brace on, on one line."""
    return text[text.find(b"{"):].replace(b"\n", b" ").replace(b"\r", b" ").decode("utf-8")


def _pieces(spark: SparkSession, files: list[str]) -> DataFrame:
    text = spark.read.option("lineSep", "}").text(files)
    return text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def _states(pieces: DataFrame) -> dict[Range, tuple[bool, int, bool]]:
    """(inside a string, nesting, several ranges in the file) at the start of each range."""
    def summed(batches):
        now, done = None, []
        for r, values in _ranges(batches):
            if now is None or now[0] != r:
                now = [r, [False, 0], [True, 0]]
                done.append(now)
            marks = _marks(_joined(values))
            for way in now[1:]:
                _, kind, way[0] = _brackets(marks, way[0])
                way[1] += int(_DEPTH[kind].sum())
        if done:
            cols = zip(*[(*r, a[0], a[1], b[0], b[1]) for r, a, b in done])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["file", "start", "s0", "d0", "s1", "d1"])

    rows = pieces.mapInArrow(summed, "file string, start long, s0 boolean, d0 long, s1 boolean, d1 long")
    rows = rows.collect()  # one small row per byte range
    if len(rows) > MAX_RANGES:
        raise ValueError(f"more than {MAX_RANGES} byte ranges: raise spark.sql.files.maxPartitionBytes")
    out, file, several = {}, None, {}
    for row in sorted(rows, key=lambda r: (r["file"], r["start"])):
        if row["file"] != file:
            _whole(file, several)
            file, inside, depth = row["file"], False, 0
        out[file, row["start"]] = inside, depth
        several.setdefault(file, [0, 0])[0] += 1
        inside, depth = (row["s1"], depth + row["d1"]) if inside else (row["s0"], depth + row["d0"])
        several[file][1] = depth if not inside else None
    _whole(file, several)
    return {k: (*v, several[k[0]][0] > 1) for k, v in out.items()}


def _whole(file: Optional[str], seen: dict) -> None:
    # the separator after the last piece is ours: a closed array ends one level below the ground
    if file is not None and seen[file][1] != -1:
        raise ValueError(f"{file} is not one whole JSON array")


def _parts(pieces: DataFrame, states: dict, edges: bool) -> DataFrame:
    """Elements that lie in one range, as (value); with ``edges`` the (file, start, part,
    value) of those that do not: part 0 what ends an earlier one, 1 what goes on."""
    def cut(batches):
        now, walk, n = None, None, 0

        def over():
            """What the range leaves: its head, and the text after its last element."""
            if walk.first:
                return [(*now, 1, walk.tail())]
            return [(*now, 0, walk.head), (*now, 1, walk.tail())]

        for r, values in _ranges(batches):
            left = []
            if r != now:
                left = over() if now else []
                if r not in states:
                    raise ValueError(f"{r[0]} is cut elsewhere than when it was opened: neither the file nor "
                                     "spark.sql.files.maxPartitionBytes may change before the rows are read")
                now, walk = r, _Walk(*states[r][:2])
                walk.first = states[r][2]  # in a file of one range the first element is whole
            whole = walk.feed(_joined(values))
            if edges and left:
                yield _edge_batch(left, states)
            if not edges and whole:
                yield pa.RecordBatch.from_arrays([pa.array([_element(x) for x in whole], pa.string())], ["value"])
        if edges and now:
            yield _edge_batch(over(), states)

    return pieces.mapInArrow(cut, "file string, start long, part int, value binary" if edges else "value string")


def _edge_batch(rows: list, states: dict) -> pa.RecordBatch:
    rows = [r for r in rows if states[r[:2]][2]]
    cols = list(zip(*rows)) if rows else [[], [], [], []]
    types = (pa.string(), pa.int64(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["file", "start", "part", "value"])


def _over_edges(edges: DataFrame) -> DataFrame:
    """The elements that reach over range edges: the texts of a file in order, cut after each head."""
    def join(batches):
        file, held, out = None, [], []
        for b in batches:
            for row in b.to_pylist():
                if row["file"] != file:
                    file, held = row["file"], []
                held.append(row["value"])
                if row["part"] == 0:
                    text = b"".join(held)
                    held = []
                    if b"{" in text:
                        out.append(_element(text))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])
                out = []

    return edges.repartition("file").sortWithinPartitions("file", "start", "part").mapInArrow(join, "value string")


def read_arrays(spark: SparkSession, files: list[str], schema: Optional[Union[T.StructType, str]] = None,
                **options) -> DataFrame:
    """The elements of the arrays in ``files`` as rows."""
    pieces = _pieces(spark, files)
    states = _states(pieces)
    elements = _parts(pieces, states, edges=False)
    if any(several for _, _, several in states.values()):
        elements = elements.unionByName(_over_edges(_parts(pieces, states, edges=True)))
    reader = spark._jsparkSession.read()  # noqa: SLF001
    for k, v in options.items():
        reader = reader.option(k, str(v).lower() if isinstance(v, bool) else str(v))
    if schema is not None:
        reader = reader.schema(schema if isinstance(schema, str) else schema.toDDL())
    texts = getattr(elements._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())  # noqa: SLF001
    return DataFrame(reader.json(texts), spark)
