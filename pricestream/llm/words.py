"""Words of whole texts as dictionary codes, and rolling hashes over them.

A word is a maximal run of characters other than space and ``\\t \\n \\v \\f \\r``.
Every function works on one Arrow array of texts inside a task; a null text has no
words. Nothing is cut: long texts are handled whole.
"""

from __future__ import annotations

import ctypes
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash



def _give_back_memory() -> None:
    """Lets glibc return every freed array of 1 MB and more to the system: by default it keeps blocks of up
    to 32 MB, and a Python worker would hold the peak of all its tasks (elsewhere: no effect)."""
    try:
        ctypes.CDLL(None).mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD
    except (OSError, AttributeError):
        pass


_give_back_memory()

_M = np.uint64(0x9E3779B97F4A7C15)


class Words(NamedTuple):
    """``codes[offsets[i]:offsets[i+1]]`` are the words of text i, as places in ``vocab``."""
    offsets: np.ndarray
    codes: np.ndarray
    vocab: pa.Array


def as_texts(col) -> pa.Array:
    """One large-string array without nulls."""
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], pa.string())
    texts = pc.fill_null(col.cast(pa.large_string()), "")
    if len(texts) and (texts.offset or np.frombuffer(texts.buffers()[1], np.int64, 1)[0]):
        # a part of a longer array: some kernels (ascii_lower) misread offsets that do not start at 0
        texts = pa.concat_arrays([texts, pa.array([], pa.large_string())])
    return texts


def split_words(texts: pa.Array) -> Words:
    lists = pc.ascii_split_whitespace(texts)
    off = np.asarray(lists.offsets).astype(np.int64)
    flat = lists.values.slice(off[0], off[-1] - off[0]).dictionary_encode()
    off = off - off[0]
    codes, vocab = np.asarray(flat.indices), flat.dictionary
    gap = pc.index(vocab, "").as_py()
    if gap >= 0:
        keep = codes != gap
        before = np.concatenate(([0], np.cumsum(keep)))
        off, codes = before[off], codes[keep]
    return Words(off, codes, vocab)


def doc_of(offsets: np.ndarray) -> np.ndarray:
    """For every word, the place of its text."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer, so that linear structure does not survive."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def word_hashes(vocab: pa.Array, seed: int = 0) -> np.ndarray:
    """64-bit hash of every vocabulary entry."""
    h = xxhash.xxh3_64_intdigest
    return np.fromiter((h(w, seed) for w in vocab.to_pylist()), np.uint64, len(vocab))


def window_hashes(word_hash: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive words (runs across texts included;
    the caller masks those). Polynomial over the ring of 64-bit integers, then mixed."""
    n = len(word_hash) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    # doubling: h(2k) = h(k) * M^k + h(k) shifted by k
    out, done, part, width, power = None, 0, word_hash, 1, _M
    left = size
    while left:
        if left & 1:
            out = part[:n + size - width] if out is None else (
                out[:len(part) - done] * power + part[done:done + len(out)])
            done += width
        left >>= 1
        if left:
            part = part[:-width] * power + part[width:]
            width = width * 2
            with np.errstate(over="ignore"):
                power = power * power
    return mix(out[:n])


def starts_in_one_text(offsets: np.ndarray, size: int) -> np.ndarray:
    """Mask over all run starts: whether the run of ``size`` words stays in its text."""
    n = int(offsets[-1]) - size + 1
    if n <= 0:
        return np.zeros(0, bool)
    ends = np.repeat(offsets[1:], np.diff(offsets))
    return np.arange(n) + size <= ends[:n]


def slices(batch: pa.RecordBatch | pa.Table, column: str, most: int = 4 << 20):
    """``batch`` cut into runs of rows with about ``most`` bytes of text at most (a longer
    text is a run of its own), so that the working memory of a task stays bounded."""
    size = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
    total, at = np.cumsum(size), 0
    while at < len(size):
        base = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, base + most, "right")))
        yield batch.slice(at, end - at)
        at = end
    pa.default_memory_pool().release_unused()  # a worker lives on after its task
