"""DuckDB SQL fragments mirroring the Spark derivations (oracle twins)."""

from __future__ import annotations

from pricewise.plans.tables import DIRECTORY_SQL, SALES_RAW_SQL


def canon(expr: str) -> str:
    return f"trim(upper(regexp_replace({expr}, '\\s+', '', 'g')))"


# written for the oracle alone: sign, digits with an optional point, exponent; or inf / nan words
NUMBER = r"^[ \t\n\r\f\v]*[-+]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][-+]?[0-9]+)?[ \t\n\r\f\v]*$"
WORD_NUMBER = r"^\s*([-+]?(inf|infinity)|[-+]?nan)\s*$"


def num(expr: str) -> str:
    return (f"CASE WHEN regexp_matches(CAST({expr} AS VARCHAR), '{NUMBER}') "
            f"OR regexp_matches(lower(CAST({expr} AS VARCHAR)), '{WORD_NUMBER}') "
            f"THEN TRY_CAST(trim(CAST({expr} AS VARCHAR)) AS DOUBLE) END")


def ix(a: str, b: str, sep: str = "_") -> str:
    return f"coalesce(CAST({a} AS VARCHAR), 'nan') || '{sep}' || coalesce(CAST({b} AS VARCHAR), 'nan')"


CAST_SQL = f"""
SELECT transaction_id, {num('price')} AS price, try_strptime(date, '%Y-%m-%d %H:%M') AS date,
       postcode, property_type, "old/new", duration, county
FROM ({SALES_RAW_SQL}) raw
"""

POSTCODES_SQL = f"""
SELECT *, left(pc, greatest(length(pc) - 3, 0)) AS outcode, right(pc, 3) AS incode
FROM (SELECT *, {canon('postcode')} AS pc FROM ({CAST_SQL}) c) p
"""

CLEAN_UNCLIPPED_SQL = f"""
SELECT transaction_id, price, date, postcode, property_type, "old/new" AS is_new_build,
       duration AS is_leasehold, county, pc AS postcode_clean, outcode, incode,
       CAST(year(date) AS BIGINT) AS sold_year, CAST(month(date) AS BIGINT) AS sold_month
FROM ({POSTCODES_SQL}) p
WHERE price IS NOT NULL AND NOT isnan(price) AND date IS NOT NULL AND postcode IS NOT NULL
  AND property_type IS NOT NULL AND "old/new" IS NOT NULL AND duration IS NOT NULL
  AND county IS NOT NULL
"""

CLEAN_SQL = f"""
SELECT * REPLACE (CASE WHEN price > (SELECT quantile_cont(price, 0.99) FROM ({CLEAN_UNCLIPPED_SQL}) q)
                       THEN (SELECT quantile_cont(price, 0.99) FROM ({CLEAN_UNCLIPPED_SQL}) q)
                       ELSE price END AS price)
FROM ({CLEAN_UNCLIPPED_SQL}) u
"""

DIR_LOOKUP_SQL = f"""
SELECT {canon('postcode')} AS k, min(district) AS district
FROM ({DIRECTORY_SQL}) d
WHERE {canon('postcode')} IS NOT NULL AND district IS NOT NULL
GROUP BY 1
"""

# Flagship keywords on county: contains 'a' and 'i' (case-insensitive).
FLAGSHIP_KEYWORDS = ("a", "i")

RESOLVED_SQL = f"""
SELECT f.*, dl.district
FROM (SELECT * FROM ({CLEAN_SQL}) c
      WHERE coalesce(regexp_matches(county, '(?i)a'), false)
        AND coalesce(regexp_matches(county, '(?i)i'), false)) f
LEFT JOIN ({DIR_LOOKUP_SQL}) dl ON {canon('f.postcode')} = dl.k
WHERE {canon('f.postcode')} IS NULL OR dl.district IS NOT NULL
"""


def rolling_sql(part: str, ts: str, val: str, days: int = 180) -> str:
    return (f"quantile_cont({val}, 0.5) OVER (PARTITION BY {part} ORDER BY {ts} RANGE BETWEEN "
            f"INTERVAL {days} DAY PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)")


ENGINEERED_SQL = f"""
WITH res AS ({RESOLVED_SQL}),
bpt AS (SELECT district, quantile_cont(price, 0.5) AS bpt FROM res
        WHERE district IS NOT NULL GROUP BY district),
dym AS (SELECT district, sold_year, quantile_cont(price, 0.5) AS dym FROM res
        WHERE district IS NOT NULL AND sold_year IS NOT NULL GROUP BY district, sold_year),
roll AS (SELECT *, {rolling_sql('district', 'date', 'price')} AS rm FROM res)
SELECT roll.* EXCLUDE (rm),
       bpt.bpt AS borough_price_trend,
       dym.dym AS district_yearly_medians,
       coalesce(roll.rm, bpt.bpt) AS avg_price_last_half,
       {ix('roll.is_new_build', 'roll.property_type')} AS advanced_property_type,
       {ix('roll.is_leasehold', 'roll.property_type')} AS property_type_and_tenure,
       {ix('roll.district', 'roll.property_type')} AS property_type_and_district
FROM roll
LEFT JOIN bpt ON roll.district = bpt.district
LEFT JOIN dym ON roll.district = dym.district AND roll.sold_year = dym.sold_year
"""


def rhu(expr: str, digits: int = 2) -> str:
    """SQL twin of functions.numeric.round_half_up."""
    m = 10 ** digits
    return (f"CASE WHEN abs({expr}) < 1e14 THEN floor(({expr}) * {m}.0 + 0.5) / {m}.0 "
            f"ELSE ({expr}) END")


def r4(sql: str, *doubles: str, digits: dict[str, int] | None = None) -> str:
    """Round the named double columns to 4 decimals, or ``digits[col]`` (the Spark
    side rounds every double column the same way before results are compared)."""
    if not doubles:
        return sql
    digits = digits or {}
    repl = ", ".join(f"{rhu(c, digits.get(c, 4))} AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({repl}) FROM ({sql}) rr"

CAST_ONLY_SQL = f"""
SELECT transaction_id, price, date, postcode, property_type, "old/new", duration, county
FROM ({CAST_SQL}) c
"""

RESOLVED_ALL_SQL = f"""
SELECT c.*, dl.district
FROM ({CLEAN_SQL}) c
LEFT JOIN ({DIR_LOOKUP_SQL}) dl ON {canon('c.postcode')} = dl.k
WHERE {canon('c.postcode')} IS NULL OR dl.district IS NOT NULL
"""

REQUESTS_SQL = """
SELECT c_custkey AS request_id,
       'k' || CAST(c_custkey AS VARCHAR) || ' ' || lower(substr(c_mktsegment, 1, 3)) AS postcode,
       lower(substr(c_mktsegment, 1, 1)) AS property_type,
       CASE WHEN c_acctbal > 5000 THEN 'y' WHEN c_acctbal > 2500 THEN 'n' ELSE NULL END AS is_new_build,
       CASE WHEN c_nationkey < 3 THEN 'x' WHEN c_nationkey < 15 THEN 'y' ELSE 'N' END AS is_leasehold
FROM customer
"""

RUNS_SQL = """
SELECT 'run-' || CAST(user_id AS VARCHAR) AS run_id,
       CASE WHEN count_if(event_type = 'error') > count_if(event_type = 'purchase')
            THEN 'FAILED' ELSE 'FINISHED' END AS status,
       epoch_us(min(ts)) // 1000 AS start_time,
       epoch_us(max(ts)) // 1000 AS end_time,
       avg(CASE WHEN event_type = 'view' THEN value END) AS train_rmse,
       avg(CASE WHEN event_type = 'click' THEN value END) AS validation_rmse,
       avg(CASE WHEN event_type = 'click' THEN value * value END) AS validation_mse,
       min(CASE WHEN event_type = 'click' THEN value END)
         / max(CASE WHEN event_type = 'click' THEN value END) AS validation_r2,
       avg(CASE WHEN event_type = 'purchase' THEN value END) AS test_rmse,
       CASE WHEN count_if(event_type = 'signup') > 0 THEN 'yes' ELSE 'no' END AS log_target
FROM events
GROUP BY user_id
"""
