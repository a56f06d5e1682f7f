"""Text primitives shared by the operators of this folder.

Words are ``[^\\x20\\x09-\\x0D]+`` (ASCII white space separates, nothing else does).
``words`` is the Spark form; ``ByteWords`` is the numpy form over one Arrow batch.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

WS = "[ \\t-\\r]+"
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def body(text) -> Column:
    """The text, null as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """Array of words, white space dropped."""
    return F.array_remove(F.split(text, WS), "")


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


#: Random odd factor of the rolling hash and its inverse modulo 2^64; a random value for each byte.
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_VALUE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The factor's and its inverse's powers from 0 to n - 1; the worker keeps the longest arrays up to 2^23."""
    if not _POWERS or len(_POWERS[0]) < n:
        made = []
        for factor in (_FACTOR, _INVERSE):
            out = np.ones(max(n, 1 << 16), np.uint64)
            out[1:] = factor
            made.append(np.multiply.accumulate(out))
        if n > 1 << 23:
            return made[0][:n], made[1][:n]
        _POWERS[:] = made
    return _POWERS[0][:n], _POWERS[1][:n]


class ByteWords:
    """Words of many texts, found and hashed without a Python object for each word.

    ``texts`` are bytes.  ``start``/``end`` are the words' places in ``data`` (the
    texts joined by a blank), ``doc`` the text each word belongs to, ``offset`` the
    first word of each text (one more entry than texts).  ``hash`` gives a 64-bit
    value for each word: equal words have equal values; two different words of a
    corpus with n word types share one with probability about n*n/2^65.
    """

    def __init__(self, texts: list[bytes], lower: bool = True):
        joined = b" ".join(texts) + b" "
        self.raw = joined.lower() if lower else joined  # bytes.lower() changes A-Z alone
        self.data = np.frombuffer(self.raw, np.uint8)
        gap = is_space(self.data)
        edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        if len(self.data) and not gap[0]:
            edge = np.concatenate([[0], edge])
        self.start, self.end = edge[0::2], edge[1::2]
        size = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        bound = np.concatenate([[0], np.cumsum(size)])
        self.offset = np.searchsorted(self.start, bound)
        self.count = np.diff(self.offset)
        self.doc = np.repeat(np.arange(len(texts)), self.count)

    def hash(self) -> np.ndarray:
        n = len(self.data)
        power, inverse = _powers(n)
        total = np.concatenate([[np.uint64(0)], np.cumsum(_VALUE[self.data] * power, dtype=np.uint64)])
        return _mix((total[self.end] - total[self.start]) * inverse[self.start])

    def word(self, i: int) -> bytes:
        return self.raw[self.start[i]:self.end[i]]


def encode(column) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column, null as empty."""
    return [x or b"" for x in column.cast("binary").to_pylist()]
