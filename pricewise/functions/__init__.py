"""Column-level functions: every helper returns a ``Column`` built from
``pyspark.sql.functions`` so it stays inside whole-stage codegen."""

from pricewise.functions.text import (canonical_postcode, outcode, incode, interaction,
                                      truthy, keyword_predicate)
from pricewise.functions.numeric import (cast_numeric, price_band, log1p_label, expm1_pred,
                                         round_price, interval_bounds, is_finite_number,
                                         generalisation_gap, gap_bucket, clip_upper,
                                         round_half_up)
from pricewise.functions.dates import (cast_timestamp, sold_year, sold_month, month_start,
                                       epoch_millis_to_utc, ntz_micros)

__all__ = [
    "canonical_postcode", "outcode", "incode", "interaction", "truthy", "keyword_predicate",
    "cast_numeric", "price_band", "log1p_label", "expm1_pred", "round_price",
    "interval_bounds", "is_finite_number", "generalisation_gap", "gap_bucket", "clip_upper", "round_half_up",
    "cast_timestamp", "sold_year", "sold_month", "month_start", "epoch_millis_to_utc",
    "ntz_micros",
]
