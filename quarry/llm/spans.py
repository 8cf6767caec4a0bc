"""Spans of a byte buffer as numpy arrays: words of a column of texts, and a verified hash table of spans."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at a time inside a task (one text is never cut).
BLOCK_BYTES = 1 << 20
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], np.uint64)
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)


def text_blocks(texts: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, UTF-8 bytes, edges) of consecutive whole texts; null texts are empty.

    Text i of the block is bytes[edges[i]:edges[i + 1]].
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    _, offsets, values = texts.buffers()
    edges = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(values, np.uint8) if values is not None else np.empty(0, np.uint8)
    row = 0
    while row < len(texts):
        end = max(int(np.searchsorted(edges, edges[row] + block_bytes, "right")) - 1, row + 1)
        yield row, data[edges[row]:edges[end]], edges[row:end + 1] - edges[row]
        row = end


def word_spans(gap: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, size, text) of every word: a maximal run of bytes of one text that are no gaps.

    The byte before is the state: a word starts where a gap or a text's edge turns into a word byte.
    """
    inside = ~gap
    fresh = np.ones(len(gap), bool)  # the byte before is a gap or of another text
    fresh[1:] = gap[:-1]
    fresh[edges[:-1][edges[:-1] < len(gap)]] = True
    done = np.ones(len(gap), bool)
    done[:-1] = gap[1:]
    done[edges[1:][edges[1:] > 0] - 1] = True
    starts = np.flatnonzero(inside & fresh)
    sizes = np.flatnonzero(inside & done) + 1 - starts
    return starts, sizes, np.searchsorted(edges, starts, "right") - 1


def _view(data: np.ndarray) -> np.ndarray:
    """Eight bytes from every place of `data`, which ends in eight bytes of padding."""
    return np.ndarray((len(data) - 7,), "<u8", buffer=data, strides=(1,))


def pad(data: np.ndarray) -> np.ndarray:
    return np.concatenate([data, np.zeros(8, np.uint8)])


def take_spans(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """values[start:start + size] of every span, one after the other."""
    after = np.cumsum(sizes)
    return values[np.repeat(starts - (after - sizes), sizes) + np.arange(after[-1] if len(after) else 0)]


def binary_array(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Values of `values`, each up to its end (in items), as an Arrow binary column."""
    offsets = np.zeros(len(ends) + 1, np.int64)
    offsets[1:] = ends * values.itemsize
    found = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(values)])
    return found.cast(pa.binary())


def hash_spans(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit hash of every span of padded `data`, eight bytes at a time."""
    view = _view(data)
    found = (sizes.astype(np.uint64) + np.uint64(1)) * _MULTIPLY
    left, at, rows = sizes, starts, slice(None)
    while len(at):
        mixed = (found[rows] ^ (view[at] & _KEEP[np.minimum(left, 8)])) * _MULTIPLY
        found[rows] = mixed ^ (mixed >> _SHIFT)
        more = np.flatnonzero(left > 8)
        rows = more if isinstance(rows, slice) else rows[more]
        left, at = left[more] - 8, at[more] + 8
    return found


def equal_spans(data: np.ndarray, a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the bytes from `a` and from `b` are the same, span by span."""
    view = _view(data)
    same = np.ones(len(a), bool)
    rows, left = np.arange(len(a)), sizes
    while len(rows):
        keep = _KEEP[np.minimum(left, 8)]
        equal = (view[a] & keep) == (view[b] & keep)
        same[rows[~equal]] = False
        more = np.flatnonzero(equal & (left > 8))
        rows, a, b, left = rows[more], a[more] + 8, b[more] + 8, left[more] - 8
    return same


def insert_spans(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray,
                 groups: np.ndarray | None = None) -> np.ndarray:
    """For every span the number of the span that stands for it in a hash table of the distinct spans.

    Open addressing, all spans at once: free slots are taken, and a span that meets a slot's owner is
    compared with it byte by byte (and by group, if given), so equal hashes never make different spans
    one; spans that differ from the owner try the next slot.
    """
    hashes = hash_spans(data, starts, sizes)
    if groups is not None:
        hashes = (hashes ^ groups.astype(np.uint64)) * _MULTIPLY
        hashes ^= hashes >> _SHIFT
    bits = max(4, int(2 * len(starts) + 1).bit_length())
    table = np.full(1 << bits, -1, np.int64)
    slots = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    owner = np.empty(len(starts), np.int64)
    waiting = np.arange(len(starts))
    while len(waiting):
        at = slots[waiting]
        free = table[at] < 0
        table[at[free]] = waiting[free]
        met = table[at]
        same = (hashes[met] == hashes[waiting]) & (sizes[met] == sizes[waiting])
        if groups is not None:
            same &= groups[met] == groups[waiting]
        check = np.flatnonzero(same & (met != waiting))
        same[check] = equal_spans(data, starts[met[check]], starts[waiting[check]], sizes[waiting[check]])
        owner[waiting[same]] = met[same]
        waiting = waiting[~same]
        slots[waiting] = (slots[waiting] + 1) & (len(table) - 1)
    return owner
