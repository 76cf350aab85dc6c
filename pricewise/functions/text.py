"""String functions: postcodes, interaction keys, flags, keyword predicates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricewise.functions._util import as_col

# The truthy spellings accepted for boolean run parameters.
TRUTHY_VALUES = ("1", "true", "yes", "y")


def canonical_postcode(c: "Column | str") -> Column:
    """Upper-case, delete every whitespace run, trim: ' sw1a 1aa ' -> 'SW1A1AA'."""
    return F.trim(F.upper(F.regexp_replace(as_col(c).cast("string"), r"\s+", "")))


def outcode(clean: "Column | str") -> Column:
    """All but the last three characters ('' for inputs of three or fewer)."""
    c = as_col(clean)
    return F.left(c, F.greatest(F.length(c) - 3, F.lit(0)))


def incode(clean: "Column | str") -> Column:
    """The last three characters (the whole string when it is shorter)."""
    return F.right(as_col(clean), F.lit(3))


def interaction(a: "Column | str", b: "Column | str", sep: str = "_",
                null_token: str = "nan") -> Column:
    """``str(a) + sep + str(b)``; a null side renders as ``null_token``.

    Plain ``concat`` would null the whole value and ``concat_ws`` would drop
    the side, so each side is coalesced first.
    """
    left = F.coalesce(as_col(a).cast("string"), F.lit(null_token))
    right = F.coalesce(as_col(b).cast("string"), F.lit(null_token))
    return F.concat(left, F.lit(sep), right)


def truthy(c: "Column | str", default: bool = True) -> Column:
    """Text flag -> boolean: trimmed, lower-cased value in TRUTHY_VALUES; null -> default."""
    v = F.lower(F.trim(as_col(c).cast("string")))
    return F.when(v.isNull(), F.lit(default)).otherwise(v.isin(*TRUTHY_VALUES))


def keyword_predicate(c: "Column | str", keywords: Iterable[str]) -> Column:
    """True when the text contains every keyword (each a regex), case-insensitive.

    Null text is false; an empty keyword list is true for every row.
    """
    pred = F.lit(True)
    for kw in keywords:
        pred = pred & F.coalesce(as_col(c).rlike("(?i)" + kw), F.lit(False))
    return pred
