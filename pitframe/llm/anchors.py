"""Anchors of byte texts: positions that every window of a given length holds one of, chosen by content alone."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

from pitframe.llm.shingles import mixed

WINDOW = 100  # bytes of a match
GRAM = 40  # bytes that an anchor is hashed from
CHUNK = 1 << 18  # bytes hashed together; a place in a chunk takes PLACE_BITS bits
PLACE_BITS = 19

_rng = np.random.default_rng(11)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


@lru_cache(maxsize=2)
def _powers(base: int) -> np.ndarray:
    return np.multiply.accumulate(np.r_[np.uint64(1), np.full(1 << PLACE_BITS, base, np.uint64)])


def _prefix(data: np.ndarray) -> np.ndarray:
    return np.r_[np.uint64(0), np.cumsum(_BYTE[data] * _powers(_BASE)[: len(data)], dtype=np.uint64)]


def _stretch(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes from start to end: the base is odd, so powers of its inverse move every stretch to the same place."""
    return mixed((prefix[end] - prefix[start]) * _powers(pow(_BASE, -1, 1 << 64))[start])


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values."""
    n = len(values)
    blocks = -(-n // width)
    full = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    full[:n] = values
    full = full.reshape(blocks, width)
    ahead = np.minimum.accumulate(full, 1).ravel()
    behind = np.minimum.accumulate(full[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1: n])


def segments(texts: list[bytes], window: int = WINDOW) -> Iterator[list[tuple[int, int, bytes]]]:
    """Groups of (text number, offset, bytes) of about a chunk. Longer texts are cut with an overlap, so that every window is
    whole in exactly one segment; texts shorter than a window have none."""
    group, size = [], 0
    for number, text in enumerate(texts):
        for offset in range(0, len(text) - window + 1, CHUNK):
            part = text[offset: offset + CHUNK + window - 1]
            if size and size + len(part) > CHUNK:
                yield group
                group, size = [], 0
            group.append((number, offset, part))
            size += len(part)
    if group:
        yield group


def anchors(group: list[tuple[int, int, bytes]], window: int = WINDOW, gram: int = GRAM) -> dict[str, np.ndarray]:
    """The anchors of a group of segments: text (number), at, first and last (starts of the windows that belong to it), all as
    offsets in the text, gram (hash of the anchor) and context (hash of all bytes of its windows and of its place in them).

    A window belongs to the leftmost of its smallest grams.
    """
    data = np.frombuffer(b"".join(part for _, _, part in group), np.uint8)
    sizes = np.array([len(part) for _, _, part in group])
    begin = np.cumsum(sizes) - sizes
    prefix = _prefix(data)
    starts = np.arange(len(data) - gram + 1)
    grams = _stretch(prefix, starts, starts + gram)
    place = np.uint64((1 << PLACE_BITS) - 1)
    low = sliding_minimum((grams & ~place) | starts.astype(np.uint64), window - gram + 1)
    owner = np.repeat(np.arange(len(group)), sizes)[: len(low)]
    valid = np.flatnonzero(np.arange(len(low)) + window <= (begin + sizes)[owner])
    position = (low[valid] & place).astype(np.int64)
    head = np.flatnonzero(np.r_[True, (position[1:] != position[:-1]) | (owner[valid][1:] != owner[valid][:-1])])
    first = valid[head]
    last = valid[np.r_[head[1:], len(valid)] - 1]
    at = position[head]
    context = _stretch(prefix, first, last + window) + mixed((at - first).astype(np.uint64) * np.uint64(131) + (last - first).astype(np.uint64))
    segment = owner[first]
    shift = np.array([offset for _, offset, _ in group]) - begin
    return {"text": np.array([number for number, _, _ in group])[segment], "at": at + shift[segment], "first": first + shift[segment],
            "last": last + shift[segment], "gram": grams[at].view(np.int64), "context": context.view(np.int64)}
