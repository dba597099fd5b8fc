"""Casts that turn bad input into NULL instead of failing the job."""

from __future__ import annotations

from pyspark.sql import types as T

from millrace.functions.literals import sql_literal

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)

# What text must look like to be worth casting to each kind of type,
# blanks and control characters at the ends aside. The first group of the
# whole-number pattern is the part an integer keeps.
_BLANK = r"[\x00-\x20]*"
_WHOLE_NUMBER = rf"^{_BLANK}([+-]?[0-9]+)(?:\.[0-9]*)?{_BLANK}$"
_NUMBER = (
    rf"(?i)^{_BLANK}[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?[df]?|0x.*|inf|infinity|nan){_BLANK}$"
)
_DATE = rf"(?s)^{_BLANK}[+-]?[0-9]{{4,7}}(?:-.*)?{_BLANK}$"


def lenient_cast(expression: str, source: T.DataType, target: str | T.DataType) -> str:
    """A SQL expression casting ``expression``, of type ``source``, to ``target``.

    Unreadable input becomes NULL. Text such as ``'2.5'`` or ``'2.0'`` reads as the
    whole number 2 when the target is integral, so numbers written with a decimal
    point are not lost.

    ``try_cast`` throws and catches an exception for each bad value, which costs
    a hundred times the cast itself. Text is therefore matched against a pattern
    first, and only what could be a value of the type reaches the cast.
    """
    wanted = T.DataType.fromDDL(target) if isinstance(target, str) else target
    if isinstance(source, T.StringType):
        if isinstance(wanted, _INTEGRAL):
            expression = f"nullif(regexp_extract({expression}, {sql_literal(_WHOLE_NUMBER)}, 1), '')"
        elif isinstance(wanted, _FRACTIONAL):
            expression = _matching(expression, _NUMBER)
        elif isinstance(wanted, T.DateType):
            expression = _matching(expression, _DATE)
    return f"try_cast({expression} AS {wanted.simpleString()})"


def _matching(expression: str, pattern: str) -> str:
    return f"CASE WHEN rlike({expression}, {sql_literal(pattern)}) THEN {expression} END"
