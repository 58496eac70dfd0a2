"""Number, salary and rounding expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobtide import fixed_values as V
from jobtide.functions.text import java_regex, matches

# What Python's float() reads: digits with single underscores between them, an
# exponent, or one of the special names.  Java also reads "12d" and hex floats.
# Digits are taken possessively, in a loop: a long run of them must not fill the stack.
_DIGITS = r"\d++(?:_\d++)*+"
_FLOAT_TEXT = (
    rf"(?i)^\s*+[+-]?(?:(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:e[+-]?{_DIGITS})?"
    r"|inf|infinity)\s*$"
)


def positive_number(text: Column) -> Column:
    """Text to double; NULL unless it is a number above zero."""
    number = F.when(
        text.rlike(_FLOAT_TEXT), F.replace(F.trim(text), F.lit("_"), F.lit(""))
    ).try_cast("double")
    return F.when(number > 0, number)


def salary_bounds(text: Column) -> Column:
    """Yearly dollar bounds in free text, as a struct of ``low`` and ``high``.

    In order: a range in thousands, one amount in thousands, then the smallest
    and largest full amount that could be a yearly salary.
    """

    def thousands(pattern: str, group: int) -> Column:
        digits = F.regexp_extract(text, java_regex(pattern), group)
        return digits.try_cast("double") * F.lit(1000.0)

    amounts = F.filter(
        F.transform(
            F.regexp_extract_all(text, F.lit(java_regex(V.SALARY_FULL)), F.lit(1)),
            lambda digits: digits.try_cast("double"),
        ),
        lambda amount: amount >= V.SALARY_FULL_MIN,
    )
    ranged = matches(text, V.SALARY_RANGE_K)
    single = matches(text, V.SALARY_SINGLE_K)

    def bound(group: int, of_amounts) -> Column:
        return (
            F.when(ranged, thousands(V.SALARY_RANGE_K, group))
            .when(single, thousands(V.SALARY_SINGLE_K, 1))
            .otherwise(of_amounts(amounts))
        )

    return F.struct(
        bound(1, F.array_min).alias("low"), bound(2, F.array_max).alias("high")
    )


def salary_midpoint(low: Column, high: Column) -> Column:
    """Whole-dollar midpoint; NULL when a bound is missing."""
    return F.round((low + high) / F.lit(2.0), 0)


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` as double; NULL for an empty whole."""
    return F.try_divide(F.lit(100.0) * part, whole.cast("double"))


def round_half_even(value: Column, digits: int) -> Column:
    """Scale, round to the nearest even, scale back (the dataframe rounding)."""
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale
