"""Words of many texts at once, as places in one buffer and as packed integers.

A word is a run of bytes that a table allows; the bytes of all characters beyond ASCII are in both
tables, so runs of bytes are runs of characters. A-Z is lowered. Short words are packed into one or
two 64-bit numbers whose order is that of their bytes.
"""

from __future__ import annotations

import numpy as np

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
LETTERS = np.array([97 <= c <= 122 or c >= 128 for c in range(256)])
LETTERS_DIGITS = LETTERS | np.array([48 <= c <= 57 for c in range(256)])
#: Bytes of one and of two packed numbers.
ONE, TWO = 8, 16


def words_in(texts: list[bytes], allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(buffer, start, length, text)``: the lowered texts in one buffer, and each word's place and text."""
    joined = b"".join([b"\0", b"\0".join(texts), bytes(TWO + 1)]).translate(LOWER)
    buffer = np.frombuffer(joined, np.uint8)
    inside = allowed[buffer]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    start, length = edges[::2], edges[1::2] - edges[::2]
    begins = 1 + np.cumsum([0, *(len(t) + 1 for t in texts)])
    number = np.diff(np.searchsorted(start, begins))
    return buffer, start, length, np.repeat(np.arange(len(texts)), number)


def _number(buffer: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``size`` (1 to 8) bytes from each place, the first byte highest, the rest 0."""
    every = np.ndarray((len(buffer) - ONE + 1,), ">u8", buffer, strides=(1,))
    shift = (8 * (ONE - size)).astype(np.uint64)
    return every[at].astype(np.uint64) >> shift << shift


def pack_one(buffer: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The first eight bytes of each word."""
    return _number(buffer, start, np.minimum(length, ONE))


def pack_two(buffer: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first eight bytes of each word and the next eight."""
    low = np.zeros(len(start), np.uint64)
    more = np.flatnonzero(length > ONE)
    low[more] = _number(buffer, start[more] + ONE, np.minimum(length[more] - ONE, ONE))
    return pack_one(buffer, start, length), low


def bytes_at(buffer: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
    """Words of one length as byte strings."""
    return np.ndarray((len(buffer) - length + 1,), f"S{length}", buffer, strides=(1,))[start]


def radix_order(*keys: np.ndarray) -> np.ndarray:
    """The stable order of rows by 64-bit ``keys``, the first one leading, by digits of 16 bits.

    Numpy sorts numbers of 16 bits by counting; digits that are equal in all rows are passed over.
    """
    order = None
    for key in reversed(keys):
        digits = np.ascontiguousarray(key).view("<u2").reshape(-1, 4)
        for k in range(4):
            digit = digits[:, k]
            if not len(digit) or (digit == digit[0]).all():
                continue
            place = np.argsort(digit if order is None else digit[order], kind="stable")
            order = place if order is None else order[place]
    return np.arange(len(keys[0])) if order is None else order
