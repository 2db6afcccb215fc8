"""Column expressions (pure ``Column -> Column`` helpers, all JVM-side)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_date(col, fmt: str = "yyyy-MM-dd") -> Column:
    """Text -> date with a fixed pattern; malformed text becomes null (P1).  A cast reads
    the usual text in a fraction of the time; it takes other forms as well, so the
    pattern is asked for all text that is not four, two and two digits."""
    c = _c(col)
    if fmt != "yyyy-MM-dd":
        return F.try_to_date(c, fmt)
    d = c.try_cast("date")
    # a text of this outline that is a date has digits in all other places
    plain = (F.length(c) == 10) & (F.substring(c, 5, 1) == "-") & (F.substring(c, 8, 1) == "-") \
        & F.substring(c, 1, 1).between("0", "9") & F.substring(c, 10, 1).between("0", "9") & (F.substring(c, 1, 4) != "0000")
    return F.when(plain, d).otherwise(F.try_to_date(c, fmt))


#: What stands for a missing number: no cast is tried, as each that fails costs an exception.
MISSING = ("NA", "")


def _given(c: Column) -> Column:
    return ~c.cast("string").isin(*MISSING)


def to_double(col) -> Column:
    """Tolerant text -> double: ``"NA"``, empty, ``"NaN"``, infinite and out-of-range
    values (``EXACT_LIMIT`` and more, which no exact sum can hold) become null (P2)."""
    c = _c(col)
    d = c.try_cast("double")
    return F.when(_given(c) & (F.abs(d) < EXACT_LIMIT), d)   # false for NaN and infinity


def to_int(col) -> Column:
    """Tolerant text -> int through double, truncating toward zero, so ``"5.0"``
    gives 5 and ``"NA"``/``"NaN"``/empty give null (P2), like all that no int can hold."""
    c = _c(col)
    return F.when(_given(c), c.try_cast("double").try_cast("int"))


def playoff_flag(col) -> Column:
    """``REG`` -> 0, anything else including null -> 1 (P5)."""
    return F.when(_c(col) == "REG", 0).otherwise(1)


def last_week(season, by_season: Mapping[int, int]) -> Column:
    """Last regular week of a season, from ``{first season: weeks from then on}``."""
    s, expr = _c(season), F.lit(None).cast("int")
    for first, weeks in sorted(by_season.items()):
        expr = F.when(s >= first, F.lit(weeks)).otherwise(expr)
    return expr


def normalise_week(col, names: Mapping[str, int], season=None,
                   last_regular: Mapping[int, int] | None = None, names_after: int = 17) -> Column:
    """Named playoff rounds -> week numbers, other text -> int.

    Without ``season`` the numbers of ``names`` are used as they are.  With it,
    ``names`` are read as rounds after week ``names_after`` and moved behind the
    season's own last regular week, so a round never shares a number with a regular
    week of a longer season.
    """
    c = _c(col)
    shift = F.lit(0) if season is None else last_week(season, last_regular) - names_after
    expr = None
    for name, week in names.items():
        value = F.lit(week) + shift
        expr = F.when(c == name, value) if expr is None else expr.when(c == name, value)
    numeric = to_int(c)
    return numeric if expr is None else expr.otherwise(numeric)


def favourite_is_home(fav, home) -> Column:
    """1 when the favourite's code equals the home code, else 0 (null -> 0)."""
    return F.when(_c(fav) == _c(home), 1).otherwise(0)


def negate_metric(col) -> Column:
    """Defensive EPA is minus the opponent's offensive EPA."""
    return _c(col) * F.lit(-1)


def team_code(prefix: str, key) -> Column:
    return F.concat(F.lit(prefix), _c(key).cast("string"))


EXACT = "decimal(38,18)"
#: Values from here on do not fit ``EXACT``.
EXACT_LIMIT = 1e20


def exact(col) -> Column:
    """A double rounded to 18 decimals as decimal(38,18); null if it does not fit."""
    return _c(col).try_cast(EXACT)


def exact_sum(col) -> Column:
    """Sum of a column in decimal(38,18).  Each value is first rounded to 18 decimals;
    the sum of the rounded values is exact, so it does not depend on partitioning or
    summation order.  A sum that does not fit is null."""
    return F.try_sum(exact(col))


def decimal_to_double(col) -> Column:
    """Correctly rounded decimal -> double.  A direct cast divides the unscaled long
    by a power of ten (two roundings) for values of 16+ digits; the exact text
    parsed as a double is rounded once."""
    return _c(col).cast("string").cast("double")


def exact_avg(col) -> Column:
    """Average from an exact sum divided by the count of the values in it (null when none)."""
    n = F.count(exact(col))   # of the values that are in the sum
    return F.when(n > 0, decimal_to_double(exact_sum(col)) / n.cast("double"))
