"""MinHash band digests of texts (one vectorised UDF) and LSH band sizes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

from claimloom.functions.shingles import code_points, rolling_hash

# Modulus and range of the hash permutations.
MERSENNE_PRIME = (1 << 61) - 1
MAX_HASH = (1 << 32) - 1

# Letters hashed together: at most 128 MB of permuted hashes per Python worker.
CHUNK_CHARS = 250_000
# Texts of an Arrow batch that are Python strings at a time, however many rows the batch has.
PIECE_ROWS = 256
# Rows of them that are compared at a time.
GATHERED = 1024


def _area(f, low: float, high: float, steps: int = 1000) -> float:
    width = (high - low) / steps
    return width * sum(f(low + (i + 0.5) * width) for i in range(steps))


@lru_cache(maxsize=None)
def lsh_bands(threshold: float, num_perm: int) -> tuple[int, int]:
    """Bands and rows per band with the least false-positive plus false-negative area.

    Two texts of similarity s share a band with probability 1 - (1 - s^rows)^bands.
    """
    best = None
    for bands in range(1, num_perm + 1):
        for rows in range(1, num_perm // bands + 1):
            found = lambda s: 1 - (1 - s**rows) ** bands
            error = _area(found, 0.0, threshold, 200) + _area(lambda s: 1 - found(s), threshold, 1.0, 200)
            if best is None or error < best[0]:
                best = (error, bands, rows)
    return best[1], best[2]


def band_digests(text: Column, ngram: int, num_perm: int, seed: int, bands: int, rows: int) -> Column:
    """Array of one 16-byte digest per band; equal digests mean equal bands.

    Shingles are the distinct character n-grams (the whole text if shorter),
    hashed to 32 bits by a polynomial over their code points and permuted by
    ``num_perm`` affine maps modulo a prime; a band is ``rows`` successive
    minima. The digest also covers the band's number, so digests of different
    bands never meet. All work is on arrays, none per shingle. A worker holds
    its batch as Arrow brought it and a few rows of it as strings, so its memory
    does not follow the size of the input.
    """
    prime, mask, chunk_chars, piece_rows = MERSENNE_PRIME, MAX_HASH, CHUNK_CHARS, PIECE_ROWS
    kind = pa.list_(pa.binary())

    def digests(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        draw = np.random.RandomState(seed)
        pairs = [
            (draw.randint(1, prime, dtype=np.uint64), draw.randint(0, prime, dtype=np.uint64))
            for _ in range(num_perm)
        ]
        factor = np.array([a for a, _ in pairs], dtype=np.uint64)
        offset = np.array([b for _, b in pairs], dtype=np.uint64)
        low61, shift = np.uint64(prime), np.uint64(61)
        gathered = np.empty((GATHERED, num_perm), dtype=np.uint32)

        def permuted(hashes: np.ndarray) -> np.ndarray:
            out = np.empty((len(hashes), num_perm), dtype=np.uint32)
            for start in range(0, len(hashes), 512):  # blocks that stay in cache
                block = hashes[start : start + 512, None] * factor
                block += offset
                # Modulo 2^61-1 by folding; the cast keeps the low 32 bits.
                high = block >> shift
                block &= low61
                block += high
                block += block >= low61
                out[start : start + 512] = block
            return out

        def least_of(table: np.ndarray, row: np.ndarray) -> np.ndarray:
            """Minima over the rows of ``table`` that ``row`` lists, some at a time, so that they stay in cache."""
            least = np.full(num_perm, mask, dtype=np.uint32)
            for start in range(0, len(row), GATHERED):
                part = row[start : start + GATHERED]
                taken = np.take(table, part, axis=0, out=gathered[: len(part)], mode="clip")
                np.minimum(least, taken.min(axis=0), out=least)
            return least

        def minima(pieces: list[str]) -> Iterator[np.ndarray]:
            """Minima of each piece; a shingle that several pieces share is permuted once."""
            hashes = rolling_hash(code_points("".join(pieces)), ngram)
            lengths = np.array([len(piece) for piece in pieces])
            ends = np.repeat(np.cumsum(lengths), lengths)[: len(hashes)]
            inside = ends - ngram >= np.arange(len(hashes))
            distinct, row = np.unique(hashes[inside], return_inverse=True)
            table = permuted(distinct)
            done = 0
            for count in (lengths - ngram + 1).tolist():
                yield least_of(table, row[done : done + count])
                done += count

        def signatures(values: list[str]) -> np.ndarray:
            least = np.full((len(values), num_perm), mask, dtype=np.uint32)
            rows_held, pieces, chars = [], [], 0

            def flush() -> None:
                for row, found in zip(rows_held, minima(pieces)):
                    np.minimum(least[row], found, out=least[row])

            for row, value in enumerate(values):
                if len(value) < ngram:
                    points = code_points(value)
                    least[row] = permuted(rolling_hash(points, len(points)))[0]
                    continue
                # A long text comes in pieces that overlap by one n-gram less a letter.
                for start in range(0, len(value) - ngram + 1, chunk_chars):
                    rows_held.append(row)
                    pieces.append(value[start : start + chunk_chars + ngram - 1])
                    chars += len(pieces[-1])
                    if chars >= chunk_chars:
                        flush()
                        rows_held, pieces, chars = [], [], 0
            if pieces:
                flush()
            return least

        def bands_of(signature: np.ndarray) -> list[bytes]:
            data, size = signature.astype("<u4").tobytes(), 4 * rows
            return [
                hashlib.blake2b(
                    data[i * size : (i + 1) * size], digest_size=16, salt=i.to_bytes(4, "little")
                ).digest()
                for i in range(bands)
            ]

        source = iter(batches)
        while (batch := next(source, None)) is not None:
            done = [
                pa.array([bands_of(s) for s in signatures(batch.slice(start, piece_rows).to_pylist())], kind)
                for start in range(0, len(batch), piece_rows)
            ]
            del batch  # let go before the next is read
            yield pa.concat_arrays(done) if done else pa.array([], kind)
            del done
            pa.default_memory_pool().release_unused()

    return F.arrow_udf(digests, "array<binary>")(F.coalesce(text, F.lit("")))
