"""Pairs of Bloom filters over 64-bit hashes: seen once, seen twice.

Each task turns its hashes into sorted bit places, split into blocks of the filter; blocks are
merged by ``twice = t1 | t2 | (o1 & o2), once = o1 | o2``, which may be applied in any order. A
hash that two tasks saw, or one task twice, has all its bits in ``twice``: the filters may hold
more, never less. What a task sends grows with its own hashes, not with the size of the filter.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of one block: the unit of merging.
BLOCK = 1 << 18
#: Largest filter: 64 MB. Beyond its capacity it only lets more pass.
MAX_BITS = 1 << 29
#: Hashes that a task keeps before it sends blocks.
FLUSH = 1 << 21
_ODD = np.uint64(0x9E3779B97F4A7C15)


def bits_for(n: int, each: int = 16, most: int = MAX_BITS) -> int:
    """A power of two of ``each`` bits a hash, between one block and ``most``."""
    return max(BLOCK, min(most, 1 << max(0, int(n) * each - 1).bit_length()))


def places(h: np.ndarray, bits: int) -> np.ndarray:
    """Three bit places for each 64-bit hash, one row each."""
    h = h.astype(np.uint64)
    low = np.uint64(bits - 1)
    g = h * _ODD
    return np.stack([h & low, (g >> np.uint64(32)) & low, (g ^ (h >> np.uint64(29))) & low])


def has(filter_: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether each hash may be in the filter (an array of bytes)."""
    out = np.ones(len(h), bool)
    for p in places(h, len(filter_) * 8):
        out &= (filter_[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return out


def add(filter_: np.ndarray, h: np.ndarray) -> None:
    for p in places(h, len(filter_) * 8):
        np.bitwise_or.at(filter_, p >> np.uint64(3), np.uint8(1) << (p & np.uint64(7)).astype(np.uint8))


def _pack(p: np.ndarray) -> bytes:
    """Sorted places within a block: as they are, or as a bitmap where that is shorter."""
    if len(p) * 32 < BLOCK:
        return b"\0" + p.astype(np.uint32).tobytes()
    bits = np.zeros(BLOCK, np.uint8)
    bits[p] = 1
    return b"\1" + np.packbits(bits, bitorder="little").tobytes()


def _unpack(b: bytes) -> np.ndarray:
    if b[:1] == b"\1":
        return np.frombuffer(b, np.uint8, offset=1)
    bits = np.zeros(BLOCK, np.uint8)
    bits[np.frombuffer(b[1:], np.uint32)] = 1
    return np.packbits(bits, bitorder="little")


def _blocks(h: np.ndarray, bits: int) -> dict[str, list]:
    """Rows (block, once, twice) of some hashes."""
    u, n = np.unique(h, return_counts=True)
    once = np.unique(places(u, bits).ravel())
    twice = np.unique(places(u[n > 1], bits).ravel())
    at = np.unique(once // np.uint64(BLOCK))
    cut = lambda p, x: _pack(p[np.searchsorted(p, x * np.uint64(BLOCK)):np.searchsorted(p, (x + np.uint64(1)) * np.uint64(BLOCK))] % np.uint64(BLOCK))
    return {"block": at.astype(np.int32), "once": [cut(once, x) for x in at], "twice": [cut(twice, x) for x in at]}


_ROW = "block int, once binary, twice binary"
_ARROW = pa.schema([("block", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])


def _record(out: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in _ARROW], schema=_ARROW)


def filter_blocks(hashes: DataFrame, bits: int) -> DataFrame:
    """Merged blocks (block, once, twice) of the only column of ``hashes``, a long without nulls."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            held.append(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            n += b.num_rows
            if n >= FLUSH:
                yield _record(_blocks(np.concatenate(held), bits))
                held, n = [], 0
        if n:
            yield _record(_blocks(np.concatenate(held), bits))

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, once, twice = None, None, None
        done = lambda: _record({"block": [at], "once": [once.tobytes()], "twice": [twice.tobytes()]})
        for b in batches:
            for k, o, t in zip(*(b.column(i).to_pylist() for i in range(3))):
                o, t = _unpack(o), _unpack(t)
                if k != at:
                    if at is not None:
                        yield done()
                    at, once, twice = k, o.copy(), t.copy()
                else:
                    twice |= t | (once & o)
                    once |= o
        if at is not None:
            yield done()

    return hashes.mapInArrow(partial, _ROW).repartition("block").sortWithinPartitions("block").mapInArrow(merged, _ROW)


def collected(blocks: DataFrame, which: str, bits: int) -> np.ndarray:
    """One filter on the driver: ``bits / 8`` bytes, 64 MB at most."""
    out = np.zeros(bits // 8, np.uint8)
    empty = bytes(BLOCK // 8)
    for r in blocks.select("block", which).where(F.col(which) != F.lit(empty)).collect():
        out[r[0] * (BLOCK // 8):(r[0] + 1) * (BLOCK // 8)] = np.frombuffer(r[1], np.uint8)
    return out


def handed_out(spark: SparkSession, filter_: np.ndarray | str) -> str:
    """The name of a file of the filter that Spark copies to every executor, for ``mapped``; the name
    of such a file is returned as it is. A broadcast would be read into each Python worker."""
    if isinstance(filter_, str):
        return filter_
    name = f"filter-{os.urandom(8).hex()}.bin"
    path = os.path.join(SparkFiles.getRootDirectory(), name)
    filter_.tofile(path)
    spark.sparkContext.addFile(path)
    return name


@lru_cache(maxsize=3)
def mapped(name: str) -> np.ndarray:
    """The filter of that name, mapped into memory: the workers of a machine share its pages."""
    return np.asarray(np.memmap(SparkFiles.get(name), np.uint8, "r"))
