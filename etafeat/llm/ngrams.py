"""Hashed n-gram features of many texts at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

PRIME = np.uint64(0x100000001B3)
INVERSE = np.uint64(pow(0x100000001B3, -1, 1 << 64))
MIX = np.uint64(0x9E3779B97F4A7C15)
CHUNK = 1 << 18  # bytes of text hashed at a time; a longer text is a chunk of its own
ROWS = 512  # rows of a batch that are Python objects at a time
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) <= n:
        with np.errstate(over="ignore"):
            for k, x in (("up", PRIME), ("down", INVERSE)):
                p = np.full(max(n, CHUNK) + 2, x, np.uint64)
                p[0] = 1
                _powers[k] = np.multiply.accumulate(p)
    return _powers["up"], _powers["down"]


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """``batch`` in parts of ROWS rows, so that few texts are Python objects at once."""
    for at in range(0, batch.num_rows, ROWS):
        yield batch.slice(at, ROWS)


def chunks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about CHUNK bytes together."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > CHUNK:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * MIX
    return h ^ (h >> np.uint64(29))


def hashed(words: pa.Array) -> np.ndarray:
    """64-bit hash of each word's bytes."""
    size = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    stop = np.cumsum(size)
    b = np.frombuffer(words.buffers()[2], np.uint8) if len(words) else np.zeros(0, np.uint8)
    begin = np.frombuffer(words.buffers()[1], np.int32)[words.offset] if len(words) else 0
    b = b[begin:begin + int(size.sum())]
    up, down = _power(len(b))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((b + np.uint64(1)) * up[:len(b)])))
    return mixed((total[stop] - total[stop - size]) * down[stop - size])


def features(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(text number, 64-bit hash) of every feature occurrence, in text order, a pair
    of arrays for each kind of feature.

    Each word gives its lower-cased letters, its first four and six bytes, its
    shape (punctuation, capitals, digits, length, last byte) and the pair with
    the word before it; equal neighbours give one common pair.
    """
    b = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    space = (b == 32) | ((b >= 9) & (b <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate(([1], space.view(np.int8), [1]))))
    start, stop = edge[0::2], edge[1::2]
    if not len(start):
        return []
    doc = np.searchsorted(ends, start, side="right")
    upper = (b >= 65) & (b <= 90)
    digit = (b >= 48) & (b <= 57)
    mark = (b > 32) & (b < 127) & ~upper & ~digit & ~((b >= 97) & (b <= 122))
    up, down = _power(len(b))
    low = np.where(upper, b + 32, b)
    low[mark] = 0  # punctuation adds nothing to a word's hash
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(low * up[:len(b)])))

    def hashed(until: np.ndarray) -> np.ndarray:
        return (total[until] - total[start]) * down[start]

    def count(x: np.ndarray) -> np.ndarray:
        upto = np.concatenate((np.zeros(1, np.int32), np.cumsum(x, dtype=np.int32)))
        return upto[stop] - upto[start]

    size = stop - start
    word = mixed(hashed(stop))
    shape = (np.minimum(count(mark), 4) + 5 * np.minimum(count(upper), 3) + 20 * (count(digit) > 0)
             + 40 * np.minimum(size, 24)).astype(np.uint64)
    shape = mixed(shape * np.uint64(257) + np.where(mark[stop - 1], b[stop - 1], 0) + np.uint64(1 << 40))
    out = [(doc, word), (doc, shape)]
    for n in (4, 6):
        longer = size > n
        out.append((doc[longer], mixed(hashed(np.minimum(start + n, stop)) + np.uint64(n << 50))[longer]))
    pair = mixed(word[:-1] * np.uint64(3) + word[1:])
    pair[word[:-1] == word[1:]] = MIX
    inside = doc[:-1] == doc[1:]
    return [*out, (doc[1:][inside], pair[inside])]


def sketch(text: bytes, salts: int = 4, size: int = 3) -> list[int]:
    """The smallest hash of the ``size``-word shingles, for each salt; near copies agree in most of them."""
    words = text.lower().split()
    joined = [b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]
    h = np.array([xxhash.xxh64_intdigest(s) for s in joined], np.uint64)
    return [int(mixed(h + np.uint64(i << 60)).min()) for i in range(salts)]
