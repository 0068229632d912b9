"""Vectorised word work on Arrow batches: hashes of words and of word runs for many texts at once.

A word is a run of bytes without blank, tab, line feed, vertical tab, form feed and carriage
return. Texts go through in pieces of a few MB, so memory follows the piece, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
SPACE = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))
_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xD1342543DE82EF95)
_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        steps = np.full(max(n, 1024), base, dtype=np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if len(have) <= 1 << 22:
            _powers[int(base)] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _beginnings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the first n bytes of words, apart from those of whole words."""
    out = np.full(len(starts), n, np.uint64)
    for j, power in enumerate(powers(_P, n)):
        at = np.minimum(starts + j, len(data) - 1)
        out += np.where(starts + j < ends, _BYTE[data[at]] * power, np.uint64(0))
    return mix(out)


def _hash_part(data: np.ndarray, space: np.ndarray, prefixes: Sequence[int] = ()) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of one piece (one row more for each prefix length), and where they start in it."""
    inside = np.concatenate(([0], (~space).view(np.int8), [0]))
    edge = np.flatnonzero(np.diff(inside))
    starts, ends = edge[0::2], edge[1::2]
    if not len(starts):
        return np.empty((1 + len(prefixes), 0), np.uint64), starts
    place = np.arange(len(data), dtype=np.int64)
    lengths = np.diff(np.concatenate((starts, [len(data)])))
    place = place[starts[0] :] - np.repeat(starts, lengths)
    terms = _BYTE[data[starts[0] :]] * powers(_P, int((ends - starts).max()) + 1).take(place, mode="clip")
    terms[space[starts[0] :]] = 0
    whole = mix(np.add.reduceat(terms, starts - starts[0]))
    return np.vstack([whole, *[_beginnings(data, starts, ends, n) for n in prefixes]]), starts


def word_hashes(texts: list[bytes], space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of all texts, and ``offsets``: text i has words offsets[i] to offsets[i+1]."""
    hashes, offsets = word_features(texts, space)
    return hashes[0], offsets


def word_features(texts: list[bytes], space: np.ndarray = SPACE, prefixes: Sequence[int] = ()) -> tuple[np.ndarray, np.ndarray]:
    """Like ``word_hashes``, with a further row of hashes for the beginnings of each given length.

    ``space`` says which bytes separate words; a line feed must be one of them.
    """
    joined = b"\n".join(texts)
    data = np.frombuffer(joined, np.uint8)
    gaps = space[data]
    found, at, begin = [], [], 0
    while begin < len(data):
        end = begin + SLICE_BYTES
        if end < len(data):  # cut at a separator; a longer word stays whole
            after = np.flatnonzero(gaps[end : end + SLICE_BYTES])
            while not len(after) and end < len(data):
                end += SLICE_BYTES
                after = np.flatnonzero(gaps[end : end + SLICE_BYTES])
            end = end + int(after[0]) if len(after) else len(data)
        h, s = _hash_part(data[begin:end], gaps[begin:end], prefixes)
        found.append(h)
        at.append(s + begin)
        begin = end
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    text_starts = np.concatenate(([0], np.cumsum(sizes)))
    hashes = np.concatenate(found, axis=1) if found else np.empty((1 + len(prefixes), 0), np.uint64)
    starts = np.concatenate(at) if at else np.empty(0, np.int64)
    return hashes, np.searchsorted(starts, text_starts)


def run_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k neighbouring words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    if k <= 8:
        out = words[:n].copy()
        for j in range(1, k):
            out *= _Q
            out += words[j : j + n]
        return mix(out)
    inverse = np.uint64(pow(int(_Q), -1, 1 << 64))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * powers(_Q, len(words)), dtype=np.uint64)))
    return mix((sums[k:] - sums[:-k]) * powers(inverse, n))


def window_minima(values: np.ndarray, k: int) -> np.ndarray:
    """The least of every k neighbouring values."""
    n = len(values) - k + 1
    if n <= 0:
        return np.empty(0, values.dtype)
    padded = np.full(-(-len(values) // k) * k, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, k)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[k - 1 : k - 1 + n])


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cut a batch into runs of rows with a few MB of text, with the texts as bytes; nulls are empty."""
    sizes = pc.binary_length(batch[column]).fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    begin = 0
    while begin < batch.num_rows:
        used = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, used + limit, side="right")))
        part = batch.slice(begin, end - begin)
        yield part, [t or b"" for t in part[column].cast(pa.large_binary()).to_pylist()]
        begin = end


def lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """An Arrow list column from one array per row."""
    offsets = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values).cast(kind) if values.dtype != np.uint64 else pa.array(values.view(np.int64)).cast(kind))
