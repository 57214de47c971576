"""Decimal text of doubles, digit for digit as C and Python print them.

``%.3f`` of the JVM rounds the shortest decimal form of a number; C and Python round the binary
value itself, ties to even. The difference shows where the two disagree about a tie: 1.0005 is
stored as 1.000499..., so it prints as 1.000.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Veltkamp's constant for doubles: 2 ** 27 + 1
_SPLIT = 134217729.0
#: numbers that have this many last digits or more are left to the JVM's own formatting
EXACT_BELOW = float(1 << 52)


def fixed(x: Column, digits: int = 3) -> Column:
    """``x`` with ``digits`` (1 to 6) decimals as text; null stays null. Exact while
    ``|x| * 10 ** digits`` is below 2 ** 52 (4.5e12 at 3 digits)."""
    if not 1 <= digits <= 6:
        raise ValueError("1 to 6 digits")
    base = 10 ** digits
    x = x.cast("double")
    a = F.abs(x)
    # a * base without rounding: product + error, from the halves of a
    high = a * F.lit(_SPLIT) - (a * F.lit(_SPLIT) - a)
    product = a * F.lit(float(base))
    error = (high * F.lit(float(base)) - product) + (a - high) * F.lit(float(base))
    below = F.floor(product)
    past_half = (product - below.cast("double") - F.lit(0.5)) + error
    up = (past_half > 0) | ((past_half == 0) & (F.pmod(below, F.lit(2)) == 1))
    n = below + F.when(up, 1).otherwise(0)
    sign = F.when(x.cast("string").startswith("-"), "-").otherwise("")
    text = F.concat(sign, F.floor(n / F.lit(base)).cast("string"), F.lit("."), F.lpad(F.pmod(n, F.lit(base)).cast("string"), digits, "0"))
    return (F.when(F.isnan(x), F.lit("nan")).when(a == F.lit(float("inf")), F.concat(sign, F.lit("inf")))
            .when(product >= EXACT_BELOW, F.format_string(f"%.{digits}f", x)).otherwise(text))


def printed(form: str, *values: Column | str) -> Column:
    """A line of the fixed format ``form``: ``%.3f`` (any width, e.g. ``%9.3f``) by :func:`fixed`, other
    directives as they are; a null prints as ``null``."""
    columns = iter([F.col(v) if isinstance(v, str) else v for v in values])
    given: list[Column] = []

    def directive(match: re.Match) -> str:
        width, digits, kind = match.groups()
        value = next(columns)
        given.append(fixed(value, int(digits[1:])) if kind == "f" else value)
        return f"%{width}s" if kind == "f" else match.group()

    line = re.sub(r"%(\d*)(\.\d+)?([dfs])", directive, form)
    return F.format_string(line, *given)
