"""Vectorised text work on Arrow batches: bytes, words and rolling hashes with numpy.

All hashes are functions of the bytes alone (no process seed), so every task and every run
gives the same value. Words are maximal runs of bytes other than 0x20 and 0x09-0x0D.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
#: Odd multiplier of the polynomial byte hash and of the hash over words.
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (kept and grown as needed)."""
    have = _tables.get(base)
    if have is None or len(have[0]) < n:
        size = max(1 << 16, 1 << (int(n) - 1).bit_length())
        up, down = np.full(size, base, dtype=U), np.full(size, pow(base, -1, 1 << 64), dtype=U)
        up[0] = down[0] = 1
        with np.errstate(over="ignore"):
            have = _tables[base] = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return have[0][:n], have[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def raw(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow text column and its offsets (rows + 1); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    if data is None or not len(off):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[off[0]: off[-1]], off - off[0]


def pieces(batch: pa.RecordBatch, column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``limit`` text bytes (one row at least), which bound the memory
    of the arrays made from them."""
    if batch.num_rows == 0:
        return
    _, off = raw(batch.column(column))
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(off, off[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def prefix(buf: np.ndarray) -> np.ndarray:
    """Running polynomial sum; with ``window`` it gives the hash of any byte range."""
    up, _ = powers(BYTE_BASE, len(buf))
    out = np.zeros(len(buf) + 1, dtype=U)
    np.cumsum((buf.astype(U) + U(1)) * up, out=out[1:])
    return out


def ranges(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte ranges [start, end)."""
    _, down = powers(BYTE_BASE, len(sums))
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(U))


def words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document number, start, end) of every word; words do not cross documents."""
    if not len(buf):
        z = np.zeros(0, dtype=np.int64)
        return z, z, z
    ink = ~SPACE[buf]
    first = np.zeros(len(buf) + 1, dtype=bool)
    first[off] = True
    before = np.empty(len(buf), dtype=bool)
    before[0], before[1:] = False, ink[:-1]
    start = np.flatnonzero(ink & (~before | first[:-1]))
    after = np.empty(len(buf), dtype=bool)
    after[-1], after[:-1] = False, ink[1:]
    end = np.flatnonzero(ink & (~after | first[1:])) + 1
    return np.searchsorted(off, start, side="right") - 1, start, end


def shingles(hashes: np.ndarray, doc: np.ndarray, n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word windows in text order and their offsets by document. A document of
    fewer than k words (but one) has one window: all its words."""
    count = np.bincount(doc, minlength=n_docs)
    base = np.concatenate(([0], np.cumsum(count)))
    up, down = powers(WORD_BASE, len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, dtype=U)
    np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
    n = np.where(count == 0, 0, np.maximum(count - k + 1, 1))
    off = np.concatenate(([0], np.cumsum(n)))
    owner = np.repeat(np.arange(n_docs), n)
    start = base[owner] + (np.arange(off[-1]) - off[owner])
    end = np.minimum(start + k, base[owner + 1])
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(U)), off


def occurrences(values: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """For each value, how many equal ones of the same owner come before it."""
    if not len(values):
        return np.zeros(0, dtype=np.int64)
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    new = np.ones(len(v), dtype=bool)
    new[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
    at = np.arange(len(v))
    out = np.empty(len(v), dtype=np.int64)
    out[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    return out
