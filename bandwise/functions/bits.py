"""Bit arithmetic on signatures: Hamming distance, bit ranges, band layout.

A signature is one LONG up to 64 bits and an ARRAY<LONG> of 64-bit words beyond.
Everything here is built from Spark's own bit functions, written as SQL expressions;
signatures are passed as the SQL text of their column.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_BITS = 64


def mask(width: int, start: int = 0) -> str:
    """LONG literal with ``width`` bits set from bit ``start`` on."""
    value = ((1 << width) - 1) << start
    if value >= 1 << 63:
        value -= 1 << 64
    return "(-9223372036854775807L - 1L)" if value == -(1 << 63) else f"{value}L"


def words(sig: str, m: int) -> list[str]:
    if m <= WORD_BITS:
        return [sig]
    return [f"{sig}[{i}]" for i in range(-(-m // WORD_BITS))]


def xor_words(left: str, right: str, m: int) -> list[str]:
    return [f"({a} ^ {b})" for a, b in zip(words(left, m), words(right, m), strict=True)]


def hamming(left: str, right: str, m: int) -> str:
    """Number of differing bits of two ``m``-bit signatures."""
    return "(" + " + ".join(f"bit_count({word})" for word in xor_words(left, right, m)) + ")"


def bit_range(sig: str, m: int, start: int, width: int) -> str:
    """Bits ``[start, start + width)`` as one LONG; ``width`` is at most 64 and may straddle two words."""
    parts = words(sig, m)
    word, offset = divmod(start, WORD_BITS)
    value = f"shiftrightunsigned({parts[word]}, {offset})" if offset else parts[word]
    if offset + width > WORD_BITS:
        value = f"({value} | shiftleft({parts[word + 1]}, {WORD_BITS - offset}))"
    return value if width == WORD_BITS else f"({value} & {mask(width)})"


def band_width(m: int, b: int) -> int:
    """Bits per band; the last ``m - b * width`` bits of a signature belong to no band."""
    if not 1 <= b <= m:
        raise ValueError(f"need 1 <= b <= m, got b={b}, m={m}")
    return m // b


def band_array(sig: str, m: int, bs: Iterable[int]) -> Column:
    """All band keys of a signature as ARRAY<STRUCT<b, band_idx, band_val>>.

    ``band_val`` is a LONG while every band fits in 64 bits, otherwise an ARRAY<LONG>.
    """
    bs = list(bs)
    wide = any(band_width(m, b) > WORD_BITS for b in bs)
    keys = []
    for b in bs:
        r = band_width(m, b)
        for i in range(b):
            chunks = [bit_range(sig, m, i * r + at, min(WORD_BITS, r - at)) for at in range(0, r, WORD_BITS)]
            value = f"array({', '.join(chunks)})" if wide else chunks[0]
            keys.append(f"named_struct('b', {b}, 'band_idx', {i}, 'band_val', {value})")
    return F.expr(f"array({', '.join(keys)})")


def generating_counts(m: int, bs: Iterable[int]) -> list[int]:
    """The band counts whose buckets must be paired.

    When the bands of b are unions of the bands of a larger count, every pair of b is
    also a pair of the larger one and needs no buckets of its own.
    """
    bs = sorted(set(bs))
    return [
        b for b in bs
        if not any(c > b and c % b == 0 and band_width(m, b) == band_width(m, c) * (c // b) for c in bs)
    ]


def outside_band(word: str, width: int) -> str:
    """The bits of a one-word signature outside the row's band ``band_idx``, closed up."""
    below = f"(~shiftleft(-1L, band_idx * {width}))"
    return f"(({word} & {below}) | (shiftrightunsigned({word}, {width}) & ~{below}))"


def piece_array(sig: str, band: int, piece: int, count: int) -> str:
    """Keys of the first ``count`` pieces of ``piece`` bits outside a band of ``band`` bits."""
    rest = outside_band(sig, band)
    return "array(" + ", ".join(
        f"named_struct('piece', {q}, 'piece_val', shiftrightunsigned({rest}, {q * piece}) & {mask(piece)})"
        for q in range(count)
    ) + ")"


def prefix_signature(sig: str, m_from: int, m: int) -> Column:
    """The ``m``-bit signature inside an ``m_from``-bit one (planes are a prefix, so bits are too)."""
    if m > m_from:
        raise ValueError("a prefix cannot be longer than the signature")
    parts = words(sig, m_from)[: -(-m // WORD_BITS)]
    if m % WORD_BITS:
        parts[-1] = f"({parts[-1]} & {mask(m % WORD_BITS)})"
    return F.expr(parts[0] if m <= WORD_BITS else f"array({', '.join(parts)})")
