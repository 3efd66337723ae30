"""Tokenised chunks: many documents in one row, as word codes with a local dictionary.

A chunk holds about ``CHUNK_BYTES`` of text (a longer document is alone), so a
task's memory stays bounded.  The table is written once to the shared scratch
folder; later passes read codes instead of text, and ask for facts about words
by *requests*: a chunk sends each distinct key once to the part that owns its
hash, and gets the answers back under its chunk id.  A key that a third of all
rows hold thus reaches its part once per chunk, not once per row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicatormart.llm import _words
from indicatormart.llm._tables import bucketed, partitions, written

CHUNK_BYTES = 8 << 20
FLAG, NO_ID = 1, 2
CHUNK_SCHEMA = "chunk long, ids binary, flags binary, sizes binary, words binary, codes binary"


class Chunk(NamedTuple):
    id: int
    ids: np.ndarray     # int64, one per document
    flags: np.ndarray   # uint8, one per document
    sizes: np.ndarray   # int64, words of each document
    words: np.ndarray   # uint64, hashes of the distinct words
    codes: np.ndarray   # int64, positions in ``words`` of all words in order

    @property
    def offset(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.sizes)])


def _pack(array: np.ndarray, kind: type) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(array, kind).tobytes())


def _unpack(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


#: Begins codes that are stored byte by byte (a compressed frame never begins so).
_PLANES = b"P"


def _by_frequency(words: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Words by falling frequency, and their codes byte by byte: the high bytes are mostly zero and compress."""
    order = np.argsort(-np.bincount(codes, minlength=len(words)), kind="stable")
    rank = np.empty(len(words), np.uint32)
    rank[order] = np.arange(len(words), dtype=np.uint32)
    planes = rank[codes].astype("<u4").view(np.uint8).reshape(-1, 4).T
    return words[order], _PLANES + _pack(planes, np.uint8)


def _codes_of(data: bytes) -> np.ndarray:
    if data[:1] != _PLANES:
        return _unpack(data, np.uint32).astype(np.int64)
    planes = _unpack(data[1:], np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def read_chunk(row: dict) -> Chunk:
    return Chunk(row["chunk"], _unpack(row["ids"], np.int64), _unpack(row["flags"], np.uint8),
                 _unpack(row["sizes"], np.int64), _unpack(row["words"], np.uint64), _codes_of(row["codes"]))


def tokenise(docs: DataFrame, id_col: str, text_col: str, flag: F.Column | None = None, slim: bool = False,
             by_chunk: bool = False) -> DataFrame:
    """Written chunks of the words of all rows; ``flag`` is a boolean kept per document as bit ``FLAG``.

    A null id is kept as zero with bit ``NO_ID``.  ``slim`` takes a fifth less
    room; the words of a chunk are then by frequency, else by hash.  ``by_chunk``
    writes buckets of chunks, so that joins on the chunk's id do not move them.
    """
    def run(batches: Iterator[pa.RecordBatch]):
        seq, held, size = 0, [], 0
        task = TaskContext.get().partitionId()

        def pack():
            hashes = np.concatenate([h for _, _, _, h in held])
            words, codes = np.unique(hashes, return_inverse=True)
            words, packed = _by_frequency(words, codes) if slim else (words, _pack(codes, np.uint32))
            row = {"chunk": [(task << 32) | seq], "ids": [_pack(np.concatenate([x[0] for x in held]), np.int64)],
                   "flags": [_pack(np.concatenate([x[1] for x in held]), np.uint8)],
                   "sizes": [_pack(np.concatenate([x[2] for x in held]), np.int64)],
                   "words": [_pack(words, np.uint64)], "codes": [packed]}
            return pa.record_batch({k: pa.array(v, pa.int64() if k == "chunk" else pa.binary())
                                    for k, v in row.items()})

        for batch in batches:
            texts = _words.texts_of(batch.column(1))
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            flags = batch.column(2).to_numpy(zero_copy_only=False).astype(np.uint8)
            for a, b in _words.groups(texts, CHUNK_BYTES // 4):
                some = _words.part(texts, a, b)
                found = _words.words_of(some)
                held.append((ids[a:b], flags[a:b], _words.per_text(_words.owner(some.offset, found.start), b - a),
                             found.hash))
                size += len(some.buf)
                if size >= CHUNK_BYTES:
                    yield pack()
                    seq, held, size = seq + 1, [], 0
        if held:
            yield pack()

    set_ = F.when(F.coalesce(flag, F.lit(False)), FLAG).otherwise(0) if flag is not None else F.lit(0)
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(0).cast("long")).alias("id"),
        F.col(text_col).cast("string").alias("text"),
        (set_ + F.when(F.col(id_col).isNull(), NO_ID).otherwise(0)).cast("byte").alias("flag"))
    found = rows.mapInArrow(run, CHUNK_SCHEMA)
    return bucketed(found, "chunks", "chunk") if by_chunk else written(found, "chunks")


# -- requests and answers ----------------------------------------------------------------------

def parts_for(chunks: DataFrame) -> int:
    """Parts of a request round: each gets a few MB."""
    return max(4 * partitions(chunks.sparkSession), chunks.count())


def by_part(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Order that groups ``keys`` by owning part, and where each part starts in it."""
    owner = ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    order = np.argsort(owner, kind="stable")
    return order, np.searchsorted(owner[order], np.arange(parts + 1, dtype=np.uint64))


def requests(chunks: DataFrame, ask: Callable[[Chunk], tuple[np.ndarray, list[np.ndarray]]], parts: int) -> DataFrame:
    """``(part, chunk, keys, values...)``: for each chunk, ``ask`` gives uint64 keys and arrays of one value per key."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for row in batch.to_pylist():
                chunk = read_chunk(row)
                keys, values = ask(chunk)
                order, edge = by_part(keys, parts)
                out = {"part": [], "chunk": [], "data": []}
                for p in np.flatnonzero(np.diff(edge)):
                    some = order[edge[p]:edge[p + 1]]
                    out["part"].append(int(p))
                    out["chunk"].append(chunk.id)
                    out["data"].append(freeze([keys[some], *(v[some] if isinstance(v, np.ndarray) else v.take(some)
                                                              for v in values)]))
                yield pa.record_batch({"part": pa.array(out["part"], pa.int32()),
                                       "chunk": pa.array(out["chunk"], pa.int64()),
                                       "data": pa.array(out["data"], pa.binary())})

    return chunks.mapInArrow(run, "part int, chunk long, data binary")


class Ragged(NamedTuple):
    """Several values per key."""
    offset: np.ndarray
    values: np.ndarray

    def take(self, index: np.ndarray) -> Ragged:
        size = (self.offset[1:] - self.offset[:-1])[index]
        out = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(out[-1]) - np.repeat(out[:-1], size) + np.repeat(self.offset[:-1][index], size)
        return Ragged(out, self.values[at])


def freeze(arrays: list) -> bytes:
    """Arrays (and ragged arrays) as bytes."""
    import pickle
    flat = [tuple(a) if isinstance(a, Ragged) else a for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(flat, protocol=5))


def thaw(data: bytes) -> list:
    import pickle
    return [Ragged(*a) if isinstance(a, tuple) else a
            for a in pickle.loads(zstandard.ZstdDecompressor().decompress(data))]  # noqa: S301 - own scratch data
