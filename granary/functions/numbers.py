"""Numbers that are given as text, and numbers that become text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A decimal literal; Spark's cast alone also takes type suffixes and hexadecimal floats.
DECIMAL = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
NON_FINITE = r"(?i)^\s*[+-]?(inf|infinity|nan)\s*$"


def named(x: Column, f: Callable[[Column], Column]) -> Column:
    """``f(x)``, where x is worked out once, however often f names it. Inside lambdas Spark works each mention out anew."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def to_number(text: Column) -> Column:
    """A decimal literal, infinity or not-a-number as double; null for any other text."""
    special = F.when(F.lower(text).contains("nan"), F.lit(float("nan"))).when(text.contains("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    return F.when(text.rlike(DECIMAL), text.try_cast("double")).when(text.rlike(NON_FINITE), special)


def finite(text: Column) -> Column:
    """``to_number``, null also for infinity and not-a-number."""
    return named(F.when(text.rlike(DECIMAL), text.try_cast("double")), lambda x: F.when(F.abs(x) != float("inf"), x))


def number_or_zero(text: Column) -> Column:
    return F.coalesce(finite(text), F.lit(0.0))


def whole_or_zero(text: Column) -> Column:
    """An integer literal as long; 0 for anything else."""
    return F.coalesce(F.when(text.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.trim(text).try_cast("long")), F.lit(0).cast("long"))


def truncated_class(text: Column) -> Column:
    """A class id that may be written as a decimal: cut towards zero."""
    return named(finite(text), lambda x: F.when(F.abs(x) < 2**31, x.cast("int")))


def strict_class(text: Column) -> Column:
    """A class id that must be an integer literal."""
    return F.when(text.rlike(r"^[+-]?[0-9]{1,9}$"), text.cast("int"))


def integral_class(text: Column, tolerance: float = 1e-9) -> Column:
    """A class id that may be written as a decimal, but must be whole."""
    return named(finite(text), lambda x: F.when((F.abs(x - F.rint(x)) <= tolerance) & (F.abs(x) < 2**31), F.rint(x).cast("int")))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole; 0 if whole is 0 or null."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def fixed6(x: Column) -> Column:
    """Six decimals, rounding the binary value (exact below a thousand million), halves to even; null for what isn't a number."""
    return F.when(F.abs(x) == float("inf"), _infinite(x)).when(~F.isnan(x), F.call_function("format_number", x, F.lit("0.000000")))


def short12(x: Column) -> Column:
    """At most twelve significant digits, without trailing zeros; very small and very large ones with an exponent."""
    shown = lambda pattern: F.call_function("format_number", x, F.lit(pattern))
    size = F.abs(x)
    out = F.when(F.isnan(x), None).when(size == float("inf"), _infinite(x)).when(size == 0, shown("0"))
    out = out.when(size < 0.99999999999950e-4, F.lower(shown("0.###########E00")))
    for digits in range(15, -1, -1):
        out = out.when(size < min(10.0 ** (12 - digits), 999_999_999_999.5), shown("0." + "#" * digits if digits else "0"))
    return out.otherwise(F.regexp_replace(F.regexp_replace(shown("0.###########E00"), "E-", "e-"), "E", "e+"))


def _infinite(x: Column) -> Column:
    return F.when(x > 0, F.lit("inf")).otherwise("-inf")
