"""Words and hashes shared by the operators, vectorised over Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: The white space of ``[\\x20\\x09-\\x0D]``, the same bytes that ``bytes.split`` uses.
SPACE = b" \t\n\x0b\x0c\r"
_C1, _C2, _C3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection on 64-bit values."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + _C1
        x = (x ^ (x >> np.uint64(30))) * _C2
        x = (x ^ (x >> np.uint64(27))) * _C3
        return x ^ (x >> np.uint64(31))


def texts(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """Texts as one large-string array; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    # Some text kernels misread slices, so the values are copied out of the batch.
    column = column.take(pa.array(np.arange(len(column))))
    return pc.fill_null(column.cast(pa.large_string()), "")


def words(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Offsets of each text into the flat array of its words."""
    split = pc.ascii_split_whitespace(column)
    flat, offsets = split.flatten(), split.offsets.to_numpy()
    offsets = offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64)
    there = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    if not there.all():  # leading and trailing white space leave empty words
        before = np.concatenate([[0], np.cumsum(there)])
        offsets, flat = before[offsets], flat.filter(pa.array(there))
    return offsets.astype(np.int64), flat


def word_hashes(flat: pa.Array) -> np.ndarray:
    """A 64-bit hash of every word; each different word is hashed once."""
    coded = pc.dictionary_encode(flat)
    each = np.fromiter(
        (xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.cast(pa.large_binary()).to_pylist()),
        np.uint64, len(coded.dictionary),
    )
    return each[coded.indices.to_numpy(zero_copy_only=False)] if len(each) else each


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` values from each position on; the last ones wrap round."""
    out = np.zeros(len(hashes), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            out = mix(out + np.roll(hashes, -k) * np.uint64(2 * k + 1))
    return out


def owner(offsets: np.ndarray) -> np.ndarray:
    """The text that each word belongs to."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def slices(batch: pa.RecordBatch, column: str, chars: int = 4_000_000):
    """Parts of a batch of about ``chars`` bytes of text, so that memory is bounded."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes.astype(np.int64)) // chars
    starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    for a, b in zip(starts, np.r_[starts[1:], batch.num_rows]):
        yield batch.slice(int(a), int(b - a))
