"""Content hashes, splits that follow from them, and 64-bit perceptual hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fraction(hex_digest: Column) -> Column:
    """The first 32 bits of a hash as a number from 0 to 1."""
    return F.conv(F.substr(hex_digest, F.lit(1), F.lit(8)), 16, 10).cast("double") / F.lit(4294967295.0)


def split_by_hash(hex_digest: Column, train: float = 0.7, valid: float = 0.2) -> Column:
    """A split that depends on the content only. The cuts are sums of binary fractions."""
    x = fraction(hex_digest)
    return F.when(x < train, F.lit("train")).when(x < train + valid, F.lit("valid")).otherwise("test")


def split_by_key(key: Column, hex_digest: Column) -> Column:
    """The same of a key and a hash together, at 0.7, 0.2 and 0.1."""
    return split_by_hash(F.md5(F.concat(key, F.lit(":"), hex_digest).cast("binary")), 0.70, 0.20)


def half(hex16: Column, start: int) -> Column:
    """Eight hexadecimal digits from ``start`` on as a number."""
    return F.conv(F.substr(hex16, F.lit(start), F.lit(8)), 16, 10).cast("long")


def hamming(a: Column, b: Column) -> Column:
    """Different bits of two hashes of 16 hexadecimal digits; for other texts 64, or 0 if they are equal."""
    shape = "^[0-9a-fA-F]{16}$"
    bits = F.bit_count(half(a, 1).bitwiseXOR(half(b, 1))) + F.bit_count(half(a, 9).bitwiseXOR(half(b, 9)))
    return F.when(a.rlike(shape) & b.rlike(shape), bits).when(a == b, F.lit(0)).otherwise(64).cast("int")


def bits_of(digits: Column) -> Column:
    """Hexadecimal digits as text of zeros and ones, four each."""
    return F.array_join(F.transform(F.filter(F.split(digits, ""), lambda d: d != ""), lambda d: F.lpad(F.conv(d, 16, 2), 4, "0")), "")


def mean_hash(cells: Column) -> Column:
    """16 hexadecimal digits of 64 grey values: a bit is set where a value is at least their mean."""
    total = F.aggregate(cells, F.lit(0.0), lambda a, x: a + x.cast("double"))
    bits = F.transform(cells, lambda x: F.when(x.cast("double") * F.size(cells) >= total, F.lit("1")).otherwise("0"))
    return _hex_of_bits(bits)


def sign_hash(vector: Column) -> Column:
    """16 hexadecimal digits of 64 numbers: a bit is set where a number is at least 0."""
    return _hex_of_bits(F.transform(vector, lambda x: F.when(x >= 0, F.lit("1")).otherwise("0")))


def _hex_of_bits(bits: Column) -> Column:
    half = lambda start: F.lpad(F.lower(F.conv(F.array_join(F.slice(bits, start, 32), ""), 2, 16)), 8, "0")
    return F.concat(half(1), half(33))
