"""Words of many texts at once, as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

PORTION = 1 << 20     # bytes of text that are looked at at once
_BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mixed(h: np.ndarray, x: np.ndarray) -> np.ndarray:
    h = (h ^ x) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def word_spans(raw: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and byte after the last of the words of texts that stand in ``raw`` one after another, and the number of words of
    each text; ``cuts`` are the texts' borders. ASCII blanks part words."""
    solid = ~_BLANK[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[cuts] = True
    blank = np.concatenate([[True], ~solid, [True]])
    starts = np.flatnonzero(solid & (edge[:-1] | blank[:-2]))
    ends = np.flatnonzero(solid & (edge[1:] | blank[2:])) + 1
    return starts, ends, np.searchsorted(starts, cuts[1:]) - np.searchsorted(starts, cuts[:-1])


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words. They are read eight bytes at a time, all words at once; long ones go one by one."""
    size = ends - starts
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(raw) + 1, "<u8", padded, strides=(1,))
    h = size.astype(np.uint64)
    for i in np.flatnonzero(size > 64):
        h[i] = xxhash.xxh3_64_intdigest(raw[starts[i]:ends[i]].tobytes())
    short = np.flatnonzero(size <= 64)
    for done in range(0, 64, 8):
        short = short[size[short] > done]
        if not len(short):
            break
        left = np.minimum(size[short] - done, 8).astype(np.uint64)
        h[short] = _mixed(h[short], eight[starts[short] + done] & (_ALL >> (np.uint64(64) - np.uint64(8) * left)))
    return h


def word_hashes(raw: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts, and the number of words of each text."""
    starts, ends, n = word_spans(raw, cuts)
    return span_hashes(raw, starts, ends), n


def hashed_portions(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, word hashes and word counts of runs of rows of a binary array with about ``PORTION`` bytes of text. A longer text is
    a run of its own and hashed in pieces that end at blanks."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    row = 0
    while row < len(texts):
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + PORTION, "right")) - 1)
        part, cuts = raw[offsets[row]:offsets[to]], offsets[row:to + 1] - offsets[row]
        if len(part) <= 2 * PORTION:
            yield row, *word_hashes(part, cuts)
        else:
            found, at = [], 0
            while at < len(part):
                end = at + PORTION
                blank = np.flatnonzero(_BLANK[part[end:end + PORTION]])
                while not len(blank) and end < len(part):
                    end += PORTION
                    blank = np.flatnonzero(_BLANK[part[end:end + PORTION]])
                end = min(len(part), end + int(blank[0])) if len(blank) else len(part)
                found.append(word_hashes(part[at:end], np.array([0, end - at]))[0])
                at = end
            words = np.concatenate(found)
            yield row, words, np.array([len(words)])
        row = to
