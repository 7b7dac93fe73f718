"""Word shingles as 64-bit hashes, in numpy, for Arrow batches of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

WIDTH = 5
CHUNK_BYTES = 4_000_000

_P = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a one-to-one mapping)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def chunks(batch: pa.RecordBatch, size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of a few MB of text, so that working memory does not follow the batch; a null text is empty."""
    texts = batch.column("text")
    lengths = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        base = lengths[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(lengths, base + size, side="right")))
        yield batch.slice(start, end - start)
        start = end


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and how many words each text has. Words are split at ASCII white space, A-Z lower-cased."""
    words: list[bytes] = []
    counts = []
    for text in texts.to_pylist():
        own = (text or "").encode().lower().split()  # on bytes both are about ASCII alone
        counts.append(len(own))
        words += own
    encoded = pa.array(words, pa.binary()).dictionary_encode()
    distinct = encoded.dictionary.to_pylist()
    table = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct))
    return table[encoded.indices.to_numpy(zero_copy_only=False)], np.array(counts)


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; one shingle for a text of fewer words, none for one without words."""
    words, counts = word_hashes(texts)
    n = len(words)
    if n >= width:
        rolled = words[: n - width + 1].copy()
        for k in range(1, width):
            rolled = rolled * _P + words[k: n - width + 1 + k]
        rolled = mixed(rolled)
    else:
        rolled = np.empty(0, np.uint64)
    result = []
    start = 0
    for count in counts.tolist():
        if count >= width:
            result.append(np.unique(rolled[start: start + count - width + 1]))
        elif count:
            h = np.uint64(count)
            with np.errstate(over="ignore"):
                for w in words[start: start + count]:
                    h = h * _P + w
            result.append(mixed(np.array([h], np.uint64) + np.uint64(1)))
        else:
            result.append(np.empty(0, np.uint64))
        start += count
    return result
