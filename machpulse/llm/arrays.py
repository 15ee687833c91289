"""Numpy helpers on Arrow batches: hashes of words and shingles. Memory follows one group of rows or one text."""

import numpy as np

GROUP_BYTES = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"): ord("Z") + 1] += 32
_ODD = np.random.Generator(np.random.PCG64(20240601)).integers(0, 1 << 63, 512, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUE, _FACTOR = _ODD[:256], _ODD[256:]


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads every bit of unsigned 64-bit values over the whole word, one to one."""
    x = values.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _hash_group(data: np.ndarray, rows: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of adjoining texts that begin at ``rows``, and each word's first byte."""
    inner = ~_SPACE[data]
    first = inner.copy()
    first[1:] &= ~inner[:-1]
    begins = rows[rows < len(data)]
    first[begins] = inner[begins]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    letters = data[inner]
    at = (np.cumsum(inner) - 1)[starts]
    lengths = np.diff(np.append(at, len(letters)))
    place = np.arange(len(letters)) - np.repeat(at, lengths)
    powers = np.ones(int(lengths.max()), np.uint64)
    powers[1:] = _FACTOR[0]
    values = _VALUE[_LOWER[letters] if lower else letters] * np.cumprod(powers)[place]
    return mix(np.add.reduceat(values, at) + lengths.astype(np.uint64) * _FACTOR[1]), starts


def _hash_long(data: np.ndarray, lower: bool) -> np.ndarray:
    """The words of one long text, read in pieces that end at white space."""
    found, at = [], 0
    while at < len(data):
        end = min(at + GROUP_BYTES, len(data))
        while end < len(data) and not _SPACE[data[end]]:
            step = np.flatnonzero(_SPACE[data[end: end + GROUP_BYTES]])
            end = end + int(step[0]) if len(step) else min(end + GROUP_BYTES, len(data))
        found.append(_hash_group(data[at:end], np.zeros(0, np.int64), lower)[0])
        at = end
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def word_hashes(texts, lower: bool = True):
    """For each text of an Arrow string array without nulls: the 64-bit hashes of its words, in order.

    Words are runs of ``[^\\x20\\x09-\\x0D]``; with ``lower``, A-Z count as a-z.
    """
    count = len(texts)
    if not count:
        return
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int32)[texts.offset: texts.offset + count + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < count:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + GROUP_BYTES, "right")) - 1)
        part = data[offsets[row]: offsets[end]]
        if end == row + 1 and len(part) > GROUP_BYTES:
            yield _hash_long(part, lower)
        else:
            begins = offsets[row:end] - offsets[row]
            hashes, starts = _hash_group(part, begins, lower)
            cuts = np.append(np.searchsorted(starts, begins), len(starts))
            for i in range(end - row):
                yield hashes[cuts[i]: cuts[i + 1]]
        row = end


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``width`` words; of the whole sequence if it is shorter; none of none."""
    if not len(words):
        return np.zeros(0, np.uint64)
    if len(words) < width:
        return mix(np.array([np.sum(words * _FACTOR[2: 2 + len(words)]) + np.uint64(len(words))], np.uint64))
    total = np.zeros(len(words) - width + 1, np.uint64)
    for k in range(width):
        total += words[k: len(words) - width + 1 + k] * _FACTOR[2 + k]
    return np.unique(mix(total))
