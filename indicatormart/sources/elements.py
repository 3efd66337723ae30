"""Elements of one large JSON array, read by many tasks.

A JSON document has no line ends to split at, so Spark reads it whole in one
task.  Here the text reader splits it after each ``}``, wherever that stands,
and three passes give the elements of the array:

1.  Each byte range is scanned under both guesses (it begins inside a string or
    not): how the nesting depth changes, how low it gets, and where the array's
    key is followed by ``[``.  A few numbers a range go to the driver.
2.  In file order these tell for each range whether it begins in a string, at
    what depth, and whether the array is open.
3.  Each range is cut at the commas between elements.  Elements within a range
    are done; the pieces at its ends meet in one small shuffle.

Strings, escapes and nested arrays of the same name are respected; a document
that is cut off or not balanced fails.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_END = b"}"
_OPEN, _CLOSE, _COMMA = 1, -1, 2
_KIND = np.zeros(256, np.int8)
_KIND[list(b"{[")], _KIND[list(b"}]")], _KIND[ord(",")] = _OPEN, _CLOSE, _COMMA

#: Pieces of an element, in the order they take within a range.
HEAD, MIDDLE, TAIL = 0, 1, 2


class Marks(NamedTuple):
    """Brackets, braces and commas outside strings."""
    at: np.ndarray      # byte positions
    kind: np.ndarray    # opening, closing, comma
    depth: np.ndarray   # nesting depth after each
    in_string: bool     # whether the text ends in a string


def marks(raw: bytes, in_string: bool, depth: int) -> Marks:
    a = np.frombuffer(raw, np.uint8)
    quote = a == ord('"')
    slash = np.flatnonzero(a == ord("\\"))
    if len(slash):      # after an odd number of backslashes a quote is escaped
        new = np.flatnonzero(np.concatenate([[True], slash[1:] != slash[:-1] + 1]))
        size = np.diff(np.append(new, len(slash)))
        after = (slash[new] + size)[size % 2 == 1]
        quote[after[after < len(a)]] = False
    inside = np.logical_xor.accumulate(quote) ^ in_string
    kind = _KIND[a]
    at = np.flatnonzero((kind != 0) & ~inside)
    kind = kind[at]
    return Marks(at, kind, depth + np.cumsum(np.where(kind == _COMMA, 0, kind), dtype=np.int64),
                 bool(inside[-1]) if len(a) else in_string)


def _openings(raw: bytes, m: Marks, key: str | None, first: bool) -> Iterator[int]:
    """Indexes in ``m`` of the ``[`` after the key (without a key: of a ``[`` that begins the document)."""
    if key is None:
        if first and len(m.at) and raw[m.at[0]:m.at[0] + 1] == b"[":
            yield 0
        return
    for found in re.finditer(re.escape(b'"%s"' % key.encode()) + rb"\s*:\s*\[", raw):
        i = int(np.searchsorted(m.at, found.end() - 1))
        if i < len(m.at) and m.at[i] == found.end() - 1:
            yield i


# -- pass 1 ------------------------------------------------------------------------------------

class _Guess:
    """A range read on the guess that it begins in a string, or not; depths count from its beginning."""

    def __init__(self, in_string: bool):
        self.begins, self.in_string, self.depth, self.low, self.marked = in_string, in_string, 0, 0, False
        self.openings: list[list[int]] = []     # depth before, lowest depth after

    def read(self, raw: bytes, key: str | None, at_start: bool) -> None:
        m = marks(raw, self.in_string, self.depth)
        for o in self.openings:
            o[1] = int(min(o[1], m.depth.min(initial=o[1])))
        for i in _openings(raw, m, key, at_start and not self.marked):
            self.openings.append([int(m.depth[i]) - 1, int(m.depth[i:].min())])
        self.marked |= len(m.at) > 0
        self.low = int(min(self.low, m.depth.min(initial=self.low)))
        self.depth, self.in_string = int(m.depth[-1]) if len(m.depth) else self.depth, m.in_string


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, bytes]]:
    """``(file, start, file size, text)`` of consecutive rows of one byte range."""
    for batch in batches:
        file, start, size, value = (batch.column(i) for i in range(4))
        first, names = start.to_numpy(), file.dictionary_encode()
        code = names.indices.to_numpy()
        edge = np.flatnonzero(np.concatenate([[True], (first[1:] != first[:-1]) | (code[1:] != code[:-1])])) \
            if len(first) else np.zeros(0, int)
        for a, b in zip(edge, np.append(edge[1:], len(first))):
            yield file[a].as_py(), int(first[a]), size[a].as_py(), _END.join([*value.slice(a, b - a).to_pylist(), b""])


_SUMMARY = "file string, start long, size long, bytes long, in_string boolean, depth int, low int, ends boolean, " \
           "openings array<array<int>>"


def _summaries(key: str | None):
    def run(batches: Iterator[pa.RecordBatch]):
        known, guesses = None, []

        def done():
            file, start, size, n = known
            out = [{"file": file, "start": start, "size": size, "bytes": n, "in_string": g.begins, "depth": g.depth,
                    "low": g.low, "ends": g.in_string, "openings": g.openings} for g in guesses]
            return pa.RecordBatch.from_pylist(out, pa.schema([
                ("file", pa.string()), ("start", pa.int64()), ("size", pa.int64()), ("bytes", pa.int64()),
                ("in_string", pa.bool_()), ("depth", pa.int32()), ("low", pa.int32()), ("ends", pa.bool_()),
                ("openings", pa.list_(pa.list_(pa.int32())))]))

        for file, start, size, raw in _ranges(batches):
            if known is None or known[:2] != (file, start):
                if known:
                    yield done()
                known, guesses = (file, start, size, 0), [_Guess(False), _Guess(True)]
            known = (*known[:3], known[3] + len(raw))
            for g in guesses:
                g.read(raw, key, start == 0)
        if known:
            yield done()

    return run


# -- pass 2 ------------------------------------------------------------------------------------

class State(NamedTuple):
    """How a range begins; ``open`` is None before the array, True in it, False after it."""
    in_string: bool
    depth: int
    open: bool | None


def begins(summaries: list, base: int) -> dict[tuple[str, int], State]:
    """The state each range begins in; the array opens at depth ``base``."""
    out: dict[tuple[str, int], State] = {}
    guesses = {(r["file"], r["start"], r["in_string"]): r for r in summaries}
    for file in sorted({r["file"] for r in summaries}):
        at, total, r = State(False, 0, None), 0, None
        for start in sorted({s for f, s, _ in guesses if f == file}):
            out[file, start] = at
            r = guesses[file, start, at.in_string]
            open_ = at.open
            if open_ is None:
                for before, low in r["openings"]:
                    if at.depth + before == base:
                        open_ = at.depth + low > base
                        break
            elif open_:
                open_ = at.depth + r["low"] > base
            at = State(r["ends"], at.depth + r["depth"], open_)
            total += r["bytes"]
        # the text ends in } or the last one was added here (a byte order mark is not read)
        added = total - r["size"] in (1, -2)
        if at.in_string or at.open or at.depth + added != 0:
            raise ValueError(f"not a whole JSON document: {file}")
    return out


# -- pass 3 ------------------------------------------------------------------------------------

_PIECE = "file string, start long, kind int, value string"


def _pieces(key: str | None, base: int, known):
    def run(batches: Iterator[pa.RecordBatch]):
        schema = pa.schema([("file", pa.string()), ("start", pa.int64()), ("kind", pa.int32()), ("value", pa.string())])
        here, state, held, whole = None, None, [], False

        def rows(found):
            return pa.record_batch([pa.array([here[0]] * len(found), pa.string()), pa.array([here[1]] * len(found), pa.int64()),
                                    pa.array([k for k, _ in found], pa.int32()),
                                    pa.array([v for _, v in found], pa.binary()).cast(pa.string())], schema=schema)

        def rest():
            return [(TAIL if whole else MIDDLE, b"".join(held))] if here and state.open else []

        marked = False
        for file, start, _, raw in _ranges(batches):
            if here != (file, start):
                if last := rest():
                    yield rows(last)
                here, state, held, marked = (file, start), known.value[file, start], [], False
                whole = state.open is None          # the next piece begins in this range
            m = marks(raw, state.in_string, state.depth)
            cut, open_ = 0, state.open
            if open_ is None:
                for i in _openings(raw, m, key, start == 0 and not marked):
                    if m.depth[i] - 1 == base:
                        cut, open_ = int(m.at[i]) + 1, True
                        break
            marked |= len(m.at) > 0
            found = []
            if open_:
                inside = m.at >= cut
                closed = np.flatnonzero(inside & (m.depth == base) & (m.kind == _CLOSE))
                end = int(m.at[closed[0]]) if len(closed) else len(raw)
                commas = m.at[inside & (m.at < end) & (m.depth == base + 1) & (m.kind == _COMMA)].tolist()
                for edge in commas + ([end] if len(closed) else []):
                    found.append((None if whole else HEAD, b"".join([*held, raw[cut:edge]])))
                    held, whole, cut = [], True, edge + 1
                open_ = not len(closed)
                if open_:
                    held.append(raw[cut:])
            state = State(m.in_string, int(m.depth[-1]) if len(m.depth) else state.depth, open_)
            if found:
                yield rows(found)
        if last := rest():
            yield rows(last)

    return run


def read_elements(spark: SparkSession, path: str, array: str | None, schema: StructType | None = None,
                  glob: str | None = None, column: str = "element") -> DataFrame:
    """The elements of the array ``array`` of each document's outer object, one row each.

    ``array=None`` reads documents that are an array themselves.  ``schema`` is an
    element's type; without it elements are VARIANT.  A file is read by as
    many tasks as it has splits (``spark.sql.files.maxPartitionBytes``),
    also when it is one line; the driver gets a few numbers per split.
    Documents without the array, or with an empty one, give no rows.  Element
    order is not kept; where ``schema`` has a string for a nested value, it holds
    that value as JSON without blanks.  A document that is not balanced, and with ``schema`` a
    malformed element, fails.
    """
    reader = spark.read.option("lineSep", _END.decode())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    text = reader.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("value"))
    base = 0 if array is None else 1
    known = begins([r.asDict() for r in text.mapInArrow(_summaries(array), _SUMMARY).collect()], base)
    pieces = text.mapInArrow(_pieces(array, base, spark.sparkContext.broadcast(known)), _PIECE)
    order = Window.partitionBy("file").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    parts = pieces.filter(F.col("kind").isNotNull()).withColumn("number", F.sum((F.col("kind") == TAIL).cast("int")).over(order))
    joined = parts.groupBy("file", "number").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("start", "kind", "value"))), lambda p: p["value"]), "").alias("value"))
    elements = pieces.filter(F.col("kind").isNull()).select("value").union(joined.select("value")) \
        .filter(F.regexp_replace("value", r"\s", "") != "")
    if schema is None:
        return elements.select(F.parse_json("value").alias(column))
    return elements.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias(column))
