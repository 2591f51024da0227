"""A Bloom filter that tells which keys of a table may occur more than once.

Every key sets three cells. A cell counts how often it was set, up to two; a key may be
repeated if all of its cells were set twice. No repeated key is missed; a single key is
taken for a repeated one only if others share all of its cells. The filter's size
follows the number of keys up to ``MOST_BITS``, so that a broadcast of it is bounded:
beyond that, more single keys are taken for repeated ones, and nothing else changes.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.words import mixed

BITS_PER_KEY = 16
MOST_BITS = 29
LEAST_BITS = 16
# The filter is put together in so many blocks, by the leading bits of a cell.
BLOCK_BITS = 8
FLUSH = 2_000_000

_SET = "block int, once binary, twice binary"
_BLOCK = "block int, bits binary"
_FACTORS = np.random.default_rng(11).integers(1, 2**63, 3, dtype=np.uint64) | np.uint64(1)


def filter_bits(count: int) -> int:
    """Binary logarithm of the number of cells for ``count`` keys."""
    return min(MOST_BITS, max(LEAST_BITS, (BITS_PER_KEY * max(count, 1) - 1).bit_length()))


def _cells(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    spread = mixed(keys.view(np.uint64))
    return [(mixed(spread * f) >> np.uint64(64 - bits)).astype(np.uint32) for f in _FACTORS]


def _packed(cells: np.ndarray) -> bytes:
    """Sorted cells by their distances, which are small."""
    return zlib.compress(np.diff(cells, prepend=np.uint32(0)).tobytes(), 1)


def _unpacked(packed: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(packed), dtype=np.uint32), dtype=np.uint32)


def _key_column(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("key").to_numpy(zero_copy_only=False).astype(np.int64)


def _set_cells(bits: int, times: int, keys_of: Callable[[pa.RecordBatch], np.ndarray]):
    low = bits - BLOCK_BITS

    def rows(keys: list[np.ndarray]) -> pa.RecordBatch:
        cells, counts = np.unique(
            np.concatenate(_cells(np.concatenate(keys), bits)), return_counts=True
        )
        bounds = np.searchsorted(cells >> low, np.arange((1 << BLOCK_BITS) + 1))
        out = []
        for block in np.flatnonzero(np.diff(bounds)):
            part = slice(bounds[block], bounds[block + 1])
            once = counts[part] * times == 1
            own = cells[part] & np.uint32((1 << low) - 1)
            out.append((int(block), _packed(own[once]), _packed(own[~once])))
        kinds = [pa.int32(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["block", "once", "twice"]
        )

    def set_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n = [], 0
        for batch in batches:
            waiting.append(keys_of(batch))
            n += len(waiting[-1])
            if n >= FLUSH:
                yield rows(waiting)
                waiting, n = [], 0
        if n:
            yield rows(waiting)

    return set_cells


def _merged(bits: int):
    low = bits - BLOCK_BITS

    def merged(rows: pd.DataFrame) -> pd.DataFrame:
        seen = np.zeros(1 << low, dtype=np.uint8)
        for once, twice in zip(rows["once"], rows["twice"]):
            own = _unpacked(once)
            seen[own] = np.minimum(seen[own] + 1, 2)
            seen[_unpacked(twice)] = 2
        return pd.DataFrame(
            [(int(rows["block"].iloc[0]), np.packbits(seen == 2).tobytes())],
            columns=["block", "bits"],
        )

    return merged


def _built(rows: DataFrame, count: int, times: int, keys_of):
    bits = filter_bits(count)
    blocks = (
        rows.mapInArrow(_set_cells(bits, times, keys_of), _SET)
        .groupBy("block")
        .applyInPandas(_merged(bits), _BLOCK)
        .collect()
    )
    size = 1 << (bits - BLOCK_BITS - 3)
    cells = np.zeros(size << BLOCK_BITS, dtype=np.uint8)
    for row in blocks:
        cells[row["block"] * size : (row["block"] + 1) * size] = np.frombuffer(
            row["bits"], dtype=np.uint8
        )
    return rows.sparkSession.sparkContext.broadcast((bits, cells))


def repeated_filter(rows: DataFrame, count: int, keys_of=_key_column):
    """Broadcast filter of the keys of ``rows`` that may be repeated.

    ``keys_of`` has the keys of a batch as int64, by default those of the long column
    ``key``, none missing; ``count`` is about their number. The driver gets the filter in
    blocks, at most 2 ** ``MOST_BITS`` bits together.
    """
    return _built(rows, count, 1, keys_of)


def member_filter(rows: DataFrame, count: int):
    """Broadcast filter of all keys of ``rows``, as if each were there twice."""
    return _built(rows.select("key"), count, 2, _key_column)


def told(known: tuple[int, np.ndarray], keys: np.ndarray) -> np.ndarray:
    """Which of ``keys`` (int64) the filter's value takes for repeated ones."""
    bits, cells = known
    out = np.ones(len(keys), dtype=bool)
    for cell in _cells(keys, bits):
        out &= (cells[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1
    return out


def may_repeat(known, key: str) -> Column:
    """Whether the filter takes the column ``key`` for a repeated one."""

    @F.pandas_udf(T.BooleanType())
    def repeated(keys: pd.Series) -> pd.Series:
        return pd.Series(told(known.value, keys.to_numpy(np.int64)))

    return repeated(key)
