"""Byte-level text kernels on numpy, shared by the operators of this package.

Texts reach Python as Arrow batches; a `Piece` is a few megabytes of whole texts laid end to end with one separator byte after
each. All patterns used here have ASCII separators only, so UTF-8 bytes can be scanned as they are. A null text counts as empty.
The working memory is a small multiple of max(piece size, longest text).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
PIECE_BYTES = 2 << 20


def _splitmix(n: int, seed: int) -> np.ndarray:
    x = (np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)) + U64(seed)
    return mix(x)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_TABLE = _splitmix(256, 0x5EED)
_P = U64(0xD6E8FEB86659FD93)
_PINV = U64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def _grow(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        m = max(n, PIECE_BYTES + (1 << 16))
        for k, p in enumerate((_P, _PINV)):
            a = np.full(m, p, U64)
            a[0] = 1
            _powers[k] = np.cumprod(a)
    return _powers[0][:n], _powers[1][:n]


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """Running polynomial sums modulo 2**64; `span_hash` reads spans off them."""
    up, _ = _grow(len(buf) + 1)
    out = np.empty(len(buf) + 1, U64)
    out[0] = 0
    np.cumsum(_TABLE[buf] * up[:-1], out=out[1:])
    return out


def span_hash(pre: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; equal bytes get equal hashes wherever they stand."""
    _, down = _grow(len(pre))
    return mix((pre[end] - pre[start]) * down[start] + (end - start).astype(U64) * U64(0xA24BAED4963EE407))


def hash_bytes(values: list[bytes]) -> np.ndarray:
    """`span_hash` of free-standing byte strings."""
    buf = np.frombuffer(b"".join(values), np.uint8)
    end = np.cumsum([len(v) for v in values], dtype=np.int64) if values else np.zeros(0, np.int64)
    return span_hash(prefix_hash(buf), end - [len(v) for v in values] if values else end, end)


def table(*ranges: tuple[int, int]) -> np.ndarray:
    """A 256-entry lookup that is true within the inclusive byte ranges."""
    t = np.zeros(256, bool)
    for a, b in ranges:
        t[a : b + 1] = True
    return t


SPACE = table((0x09, 0x0D), (0x20, 0x20))
NOT_SPACE = ~SPACE  # bytes of words [^\x20\x09-\x0D]+
ALNUM_WORD = table((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))  # bytes of words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+, after lower-casing
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


@dataclass
class Piece:
    """Some whole texts. ids: their ids as an Arrow array; row: the index of the first in its batch; buf: their bytes, a separator after each; start, end: of each text in buf."""

    ids: pa.Array
    row: int
    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def doc_of(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.start, position, side="right") - 1

    def text(self, k: int) -> bytes:
        return self.buf[self.start[k] : self.end[k]].tobytes()


def pieces(batch: pa.RecordBatch | pa.Table, id_col: str = "doc_id", text_col: str = "text", size: int = PIECE_BYTES, sep: bytes = b"\n") -> Iterator[Piece]:
    """The texts of a batch in pieces of about `size` bytes."""
    texts = batch.column(text_col)
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], texts.type)
    ids = batch.column(id_col)
    if isinstance(ids, pa.ChunkedArray):
        ids = pa.concat_arrays(ids.chunks) if ids.num_chunks else pa.array([], ids.type)
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    n = len(texts)
    if not n:
        return
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + size, side="right")) - 1)
        to = min(to, n)
        length = np.diff(off[at : to + 1])
        start = off[at:to] - off[at] + np.arange(to - at)
        buf = np.full(int(off[to] - off[at]) + to - at, sep[0], np.uint8)
        keep = np.ones(len(buf), bool)
        keep[start + length] = False
        buf[keep] = data[off[at] : off[to]]
        yield Piece(ids.slice(at, to - at), at, buf, start, start + length)
        at = to


def slices(batch: pa.RecordBatch, text_col: str = "text", size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about `size` bytes of text each, where the results of a whole batch would take too much memory."""
    n = pc.fill_null(pc.binary_length(batch.column(text_col)), 0)
    upto = np.concatenate(([0], np.cumsum(np.asarray(n), dtype=np.int64)))
    at = 0
    while at < batch.num_rows:
        to = min(batch.num_rows, max(at + 1, int(np.searchsorted(upto, upto[at] + size, side="right")) - 1))
        yield batch.slice(at, to - at)
        at = to


def spans(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true."""
    edge = np.flatnonzero(mask[1:] != mask[:-1]) + 1
    if len(mask) and mask[0]:
        edge = np.concatenate(([0], edge))
    if len(mask) and mask[-1]:
        edge = np.concatenate((edge, [len(mask)]))
    return edge[0::2], edge[1::2]


def words(p: Piece, lut: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word of a piece, and the index of the first word of each text, with the number of words at the end. The separators must not be word bytes."""
    a, b = spans(lut[p.buf])
    first = np.searchsorted(a, np.append(p.start, len(p.buf) + 1))
    return a, b, first


def per_doc(first: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of values over consecutive groups that begin at first[:-1]."""
    c = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return c[first[1:]] - c[first[:-1]]


def window_hash(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n consecutive values; entry i is of h[i:i+n]."""
    if len(h) < n:
        return np.zeros(0, U64)
    out = np.zeros(len(h) - n + 1, U64)
    for k in range(n):
        out *= U64(0x9FB21C651E98DF25)
        out += h[k : len(h) - n + 1 + k]
    return mix(out)


def group_ids(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A stable order that sorts the keys, and where in it each group of equal keys begins."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    return order, np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1]))) if len(s) else np.zeros(0, np.int64)


def runs(x: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, start, stop) of the runs of equal values of a sorted array."""
    if len(x):
        s = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1])))
        yield from zip(x[s].tolist(), s.tolist(), np.append(s[1:], len(x)).tolist())


def squeeze(x: np.ndarray) -> bytes:
    """Numbers below 2**32, byte planes apart, compressed."""
    raw = x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unsqueeze(b: bytes) -> np.ndarray:
    raw = pa.decompress(b[8:], int.from_bytes(b[:8], "little"), "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4")[:, 0].astype(np.int64)
