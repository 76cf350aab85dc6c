"""Numeric functions: coercing casts, price bands, log target, intervals, run metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricewise.functions._util import as_col

# Right-closed price band edges (0, 5e5], (5e5, 1e6], (1e6, 2e6],
# (2e6, 3e6], (3e6, inf) labelled 1..5; non-positive prices get no band.
PRICE_BAND_EDGES = (0.0, 5e5, 1e6, 2e6, 3e6)

# Generalisation-gap thresholds and their labels.
GAP_THRESHOLDS = (0.1, 0.25, 0.4)
GAP_LABELS = ("excellent", "acceptable", "potential_overfit", "likely_overfit")

# Text that a lenient numeric parser accepts: decimal or exponent notation,
# plus inf/infinity/nan, surrounded by optional whitespace.
_NUMERIC_TEXT = r"^\s*[+-]?(((\d+(\.\d*)?)|(\.\d+))([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])\s*$"


def cast_numeric(c: "Column | str") -> Column:
    """Text -> double; anything that is not a number becomes null.

    ANSI mode makes a plain cast raise, and ``try_cast`` alone accepts Java
    suffixes such as '1d', so the text is guarded by a regex first.
    """
    x = as_col(c)
    text = x.cast("string")
    return F.when(text.rlike(_NUMERIC_TEXT), F.trim(text).try_cast("double"))


def clip_upper(x: "Column | str", cap: Column) -> Column:
    """``x`` capped at ``cap``; null stays null (``least`` alone would turn null
    into cap). ``cap`` is referenced once, so a scalar-subquery cap runs once."""
    v = as_col(x)
    return F.when(v.isNull(), F.lit(None).cast("double")).otherwise(F.least(v.cast("double"), cap))


def price_band(c: "Column | str", edges: Sequence[float] = PRICE_BAND_EDGES) -> Column:
    """Right-closed bins over ``edges`` labelled 1..len(edges); <= edges[0] or null -> null."""
    x = as_col(c)
    expr = F.when(x.isNull() | F.isnan(x) | (x <= F.lit(edges[0])), F.lit(None).cast("int"))
    for label, upper in enumerate(edges[1:], start=1):
        expr = expr.when(x <= F.lit(upper), F.lit(label))
    return expr.otherwise(F.lit(len(edges)))


def log1p_label(c: "Column | str") -> Column:
    return F.log1p(as_col(c))


def expm1_pred(c: "Column | str") -> Column:
    return F.expm1(as_col(c))


def round_half_up(c: "Column | str", digits: int = 2) -> Column:
    """floor(x * 10^d + 0.5) / 10^d on the binary value, i.e. JavaScript's
    ``Math.round(x * 100) / 100`` for d = 2. Spark's ``round`` instead rounds the
    shortest decimal text of the double, which differs at apparent halves.
    Magnitudes too large for the scaled floor (and NaN/inf) pass through."""
    x = as_col(c).cast("double")
    scale = float(10 ** digits)
    return F.when(F.abs(x) < F.lit(1e14), F.floor(x * F.lit(scale) + F.lit(0.5)) / F.lit(scale)) \
            .otherwise(x)


def round_price(c: "Column | str") -> Column:
    return round_half_up(c, 2)


def interval_bounds(price: "Column | str", rate: float = 0.1) -> Column:
    """[max(0, p - m), p + m] with m = round(p * rate, 2), all rounded to 2 dp.

    ``greatest`` skips nulls, so a null price is guarded explicitly.
    """
    p = round_half_up(price, 2)
    margin = round_half_up(p * F.lit(rate), 2)
    lo = round_half_up(F.greatest(F.lit(0.0), p - margin), 2)
    hi = round_half_up(p + margin, 2)
    return F.when(p.isNull(), F.lit(None).cast("array<double>")).otherwise(F.array(lo, hi))


def is_finite_number(c: "Column | str") -> Column:
    """True for values that parse as a finite number (not null, NaN or +-Infinity)."""
    v = cast_numeric(c)
    return (v.isNotNull() & ~F.isnan(v) & (v != F.lit(float("inf")))
            & (v != F.lit(float("-inf"))))


def generalisation_gap(val: "Column | str", train: "Column | str") -> Column:
    """(val - train) / train; null when either is missing or train is 0."""
    v, t = as_col(val), as_col(train)
    return F.when(v.isNotNull() & t.isNotNull() & (t != 0), (v - t) / t)


def gap_bucket(gap: "Column | str") -> Column:
    g = as_col(gap)
    expr = F.when(g.isNull(), F.lit("unavailable"))
    for bound, label in zip(GAP_THRESHOLDS, GAP_LABELS):
        expr = expr.when(g < F.lit(bound), F.lit(label))
    return expr.otherwise(F.lit(GAP_LABELS[-1]))
