"""Numpy helpers for the tasks: words as numbers, rows cut to pieces, keys dealt to buckets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

U = np.uint64
ODD = U(0x9E3779B97F4A7C15)  # odd multiplier: 2**64 over the golden ratio


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers so that every input bit reaches every output bit."""
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


class Words(dict):
    """Numbers words in order of appearance and keeps a 64-bit hash of each."""

    def __init__(self, most: int = 80_000):
        super().__init__()
        self.most, self._hashes, self._table = most, [], np.empty(0, U)

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        self._hashes.append(xxhash.xxh3_64_intdigest(word))
        return n

    def renew(self) -> None:
        """Forget the words when there are too many; call it between texts only."""
        if len(self) > self.most:
            self.clear()
            self._hashes, self._table = [], np.empty(0, U)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def hashes(self, numbers: np.ndarray) -> np.ndarray:
        if len(self._table) < len(self._hashes):
            more = np.array(self._hashes[len(self._table):], U)
            self._table = np.concatenate([self._table, more])
        return self._table[numbers]


def pieces(batches: Iterator[pa.RecordBatch], text: str, size: int = 768 << 10) -> Iterator[pa.RecordBatch]:
    """The rows in pieces of about ``size`` bytes of text; one longer text is a piece of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), np.int64)
        ends = np.cumsum(lengths) // size
        cuts = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary column in one array, and the offsets of its rows (null: empty)."""
    column = pc.fill_null(column, b"")
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def planes(values: np.ndarray) -> bytes:
    """64-bit values byte plane by byte plane, so that leading zero bytes compress away."""
    return np.ascontiguousarray(values.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8).T).tobytes()


def unplaned(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def by_bucket(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order that puts keys of one bucket together, and ``(bucket, start, end)`` of each."""
    bucket = (keys % U(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    return order, [(b, int(edges[b]), int(edges[b + 1])) for b in np.flatnonzero(np.diff(edges)).tolist()]


def runs(ordered: np.ndarray) -> np.ndarray:
    """Start of each run of equal values, and the end of all."""
    if not len(ordered):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1, [len(ordered)]])
