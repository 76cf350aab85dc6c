"""Registered queries: joins, group aggregates, windows, splits (JN*, AG1-3, AG10-13, WN1-3, SP*, SO1/SO5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewise.operators import aggregates as AG
from pricewise.operators import enrich as EN
from pricewise.operators import split as SP
from pricewise.operators import windows as WN
from pricewise.operators.metrics import regression_metrics
from pricewise.plans import sqltext as Q
from pricewise.plans import tables as T
from pricewise.plans.catalog import ORACLE, cleaned, engineered, lookups, register, resolved, round4
from pricewise.plans.sqltext import canon, num, r4, rolling_sql
from pricewise.sources.buckets import resolve_bucketed, save_bucketed_pair, unresolved_bucketed

CLEAN = f"({Q.CLEAN_SQL}) cl"
RES = f"({Q.RESOLVED_ALL_SQL}) rs"
ENG = f"({Q.ENGINEERED_SQL}) en"

# ------------------------------------------------------------------ joins


@register("resolve_dimension", f"SELECT transaction_id, postcode_clean, district FROM {RES}")
def q_resolve(spark, sf_dir):
    return resolved(spark, sf_dir).select("transaction_id", "postcode_clean", "district")


def _bucketed_sales(spark, sf_dir):
    return save_bucketed_pair(cleaned(spark, sf_dir), "postcode", T.postcode_directory(spark, sf_dir), "postcode", "district")


@register("resolve_dimension_bucketed", f"SELECT transaction_id, postcode_clean, district FROM {RES}")
def q_resolve_bucketed(spark, sf_dir):
    """JN1 over sales and directory stored in the same buckets."""
    return resolve_bucketed(spark, _bucketed_sales(spark, sf_dir)).select("transaction_id", "postcode_clean", "district")


@register("unresolved_keys_bucketed", ORACLE["unresolved_keys"])
def q_unresolved_bucketed(spark, sf_dir):
    """FL5 over sales and directory stored in the same buckets."""
    return unresolved_bucketed(spark, _bucketed_sales(spark, sf_dir))


AUGMENT_SQL = f"""
SELECT c.transaction_id, c.price, a.quantity
FROM {CLEAN}
LEFT JOIN (SELECT transaction_id, quantile_cont({num('quantity')}, 0.5) AS quantity
           FROM ({T.QUANTITY_SIDE_SQL}) q WHERE transaction_id IS NOT NULL GROUP BY transaction_id) a
  ON c.transaction_id = a.transaction_id
""".replace(f"FROM {CLEAN}", f"FROM ({Q.CLEAN_SQL}) c")


def _augmented(spark, sf_dir):
    return EN.augment_median(cleaned(spark, sf_dir).select("transaction_id", "price"),
                             T.quantity_side(spark, sf_dir), "transaction_id", "quantity", how="left")


@register("augment_median", r4(AUGMENT_SQL, "price", "quantity"))
def q_augment(spark, sf_dir):
    return round4(_augmented(spark, sf_dir))


@register("match_rate", r4(f"""
SELECT avg(CASE WHEN quantity IS NOT NULL THEN 1.0 ELSE 0.0 END) AS match_rate FROM ({AUGMENT_SQL}) m""",
                           "match_rate"))
def q_match_rate(spark, sf_dir):
    return round4(EN.match_rate(_augmented(spark, sf_dir), "quantity"))


@register("attach_group_stat_join", r4(f"""
SELECT r.transaction_id, r.district, r.sold_year, g.m AS district_yearly_medians
FROM {RES.replace(' rs', ' r')}
LEFT JOIN (SELECT district, sold_year, quantile_cont(price, 0.5) AS m FROM {RES}
           WHERE district IS NOT NULL AND sold_year IS NOT NULL GROUP BY 1, 2) g
  ON r.district = g.district AND r.sold_year = g.sold_year""", "district_yearly_medians"))
def q_group_stat_join(spark, sf_dir):
    df = EN.attach_group_stat_join(resolved(spark, sf_dir), ["district", "sold_year"], "price",
                                   "district_yearly_medians")
    return round4(df.select("transaction_id", "district", "sold_year", "district_yearly_medians"))


LOOKUPS_SQL = {
    "bpt": f"SELECT district, quantile_cont(price, 0.5) AS price FROM {ENG} WHERE district IS NOT NULL GROUP BY 1",
    "dym": f"""SELECT district || '_' || CAST(sold_year AS VARCHAR) AS district_year, quantile_cont(price, 0.5) AS price
               FROM {ENG} WHERE district IS NOT NULL AND sold_year IS NOT NULL GROUP BY district, sold_year""",
    "recent": f"""SELECT district, quantile_cont(price, 0.5) AS price FROM {ENG}
                  WHERE district IS NOT NULL AND date >= (SELECT max(date) FROM {ENG}) - INTERVAL 6 MONTH
                  GROUP BY 1""",
}
GLOBAL_SQL = f"(SELECT quantile_cont(price, 0.5) FROM ({LOOKUPS_SQL['bpt']}) gb)"


def fallback_sql(requests_sql: str, district: str, year: str) -> str:
    return f"""
SELECT q.*,
       coalesce(b.price, {GLOBAL_SQL}) AS borough_price_trend,
       coalesce(y1.price, y2.price, {GLOBAL_SQL}) AS district_yearly_medians,
       coalesce(rc.price, {GLOBAL_SQL}) AS avg_price_last_half
FROM ({requests_sql}) q
LEFT JOIN ({LOOKUPS_SQL['bpt']}) b ON q.{district} = b.district
LEFT JOIN ({LOOKUPS_SQL['dym']}) y1 ON q.{district} || '_' || CAST(q.{year} AS VARCHAR) = y1.district_year
LEFT JOIN ({LOOKUPS_SQL['dym']}) y2 ON q.{district} || '_' || CAST(q.{year} - 1 AS VARCHAR) = y2.district_year
LEFT JOIN ({LOOKUPS_SQL['recent']}) rc ON q.{district} = rc.district"""


@register("lookup_with_fallback", r4(fallback_sql(
    f"SELECT DISTINCT district, sold_year + 1 AS sold_year FROM {RES} WHERE district IS NOT NULL",
    "district", "sold_year"), "borough_price_trend", "district_yearly_medians", "avg_price_last_half"))
def q_lookup_fallback(spark, sf_dir):
    lk = lookups(spark, sf_dir)
    req = (resolved(spark, sf_dir).where(F.col("district").isNotNull())
           .select("district", (F.col("sold_year") + 1).alias("sold_year")).distinct())
    out = EN.lookup_with_fallback(req, "district", "sold_year", lk.borough_price_trend,
                                  lk.district_yearly_medians, lk.avg_price_last_half, lk.global_median())
    return round4(out)


# ------------------------------------------------------------------ aggregates


@register("group_median", r4(LOOKUPS_SQL["bpt"], "price"))
def q_group_median(spark, sf_dir):
    return round4(AG.group_median(engineered(spark, sf_dir), "district", "price", "price"))


@register("group_median_composite", r4(LOOKUPS_SQL["dym"], "price"))
def q_group_median_composite(spark, sf_dir):
    return round4(AG.group_median_composite(engineered(spark, sf_dir), "district", "sold_year"))


@register("recent_group_median", r4(LOOKUPS_SQL["recent"], "price"))
def q_recent_group_median(spark, sf_dir):
    return round4(AG.recent_group_median(engineered(spark, sf_dir), "district", "date", year_col="sold_year"))


@register("global_fallback", r4(f"SELECT {GLOBAL_SQL} AS global_median", "global_median"))
def q_global_fallback(spark, sf_dir):
    return round4(AG.global_fallback(AG.group_median(engineered(spark, sf_dir), "district")))


@register("category_count", f"SELECT property_type, count(*) AS count FROM {CLEAN} GROUP BY 1")
def q_category_count(spark, sf_dir):
    return AG.category_count(cleaned(spark, sf_dir), "property_type")


@register("distinct_keys", f"SELECT DISTINCT outcode FROM {CLEAN} WHERE outcode IS NOT NULL")
def q_distinct_keys(spark, sf_dir):
    return AG.distinct_keys(cleaned(spark, sf_dir), "outcode")


@register("distinct_count", f"SELECT count(DISTINCT postcode_clean) AS n_distinct FROM {CLEAN}")
def q_distinct_count(spark, sf_dir):
    return AG.distinct_count(cleaned(spark, sf_dir), "postcode_clean")


# ------------------------------------------------------------------ windows

EVENTS_ROLL = f"""
SELECT event_id, user_id, ts, value, {rolling_sql('user_id', 'ts', 'value')} AS rolling_median
FROM events"""


@register("rolling_median_180d", r4(EVENTS_ROLL, "value", "rolling_median"))
def q_rolling(spark, sf_dir):
    e = T.read(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    return round4(WN.rolling_median(e, "user_id", "ts", "value", "rolling_median", fallback=False))


@register("rolling_median_fallback", r4(f"""
SELECT r.event_id, r.user_id, r.ts, r.value, coalesce(r.rolling_median, m.med) AS rolling_median
FROM ({EVENTS_ROLL}) r
LEFT JOIN (SELECT user_id, quantile_cont(value, 0.5) AS med FROM events WHERE user_id IS NOT NULL GROUP BY 1) m
  ON r.user_id = m.user_id""", "value", "rolling_median"))
def q_rolling_fallback(spark, sf_dir):
    e = T.read(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    return round4(WN.rolling_median(e, "user_id", "ts", "value", "rolling_median", fallback=True))


@register("rolling_median_sales", r4(f"""
SELECT transaction_id, district, date, price, avg_price_last_half FROM {ENG}""",
                                     "price", "avg_price_last_half"))
def q_rolling_sales(spark, sf_dir):
    """The operator itself over the resolved sales (not the stored feature)."""
    sales = engineered(spark, sf_dir).select("transaction_id", "district", "date", "price")
    return round4(WN.rolling_median(sales, "district", "date", "price", "avg_price_last_half"))


@register("attach_group_median", r4(f"""
SELECT r.transaction_id, r.district, g.m AS borough_price_trend
FROM {RES.replace(' rs', ' r')}
LEFT JOIN (SELECT district, quantile_cont(price, 0.5) AS m FROM {RES} WHERE district IS NOT NULL GROUP BY 1) g
  ON r.district = g.district""", "borough_price_trend"))
def q_attach_group_median(spark, sf_dir):
    df = WN.attach_group_median(resolved(spark, sf_dir), "district", "price", "borough_price_trend")
    return round4(df.select("transaction_id", "district", "borough_price_trend"))


@register("date_price_trend", r4(f"""
SELECT r.transaction_id, r.date, g.m AS date_price_trend
FROM {CLEAN.replace(' cl', ' r')}
LEFT JOIN (SELECT date, quantile_cont(price, 0.5) AS m FROM {CLEAN} WHERE date IS NOT NULL GROUP BY 1) g
  ON r.date = g.date""", "date_price_trend"))
def q_date_price_trend(spark, sf_dir):
    df = WN.attach_group_median(cleaned(spark, sf_dir), "date", "price", "date_price_trend")
    return round4(df.select("transaction_id", "date", "date_price_trend"))


# ------------------------------------------------------------------ sorts


@register("sort_by_date", r4(f"SELECT * FROM {CLEAN} ORDER BY date, transaction_id", "price"))
def q_sort(spark, sf_dir):
    return round4(cleaned(spark, sf_dir).orderBy("date", "transaction_id"))


@register("first_row_example", r4(f"SELECT * FROM {ENG} ORDER BY date, transaction_id LIMIT 1",
                                  "price", "borough_price_trend", "district_yearly_medians",
                                  "avg_price_last_half"))
def q_first_row(spark, sf_dir):
    return round4(engineered(spark, sf_dir).orderBy("date", "transaction_id").limit(1))


# ------------------------------------------------------------------ splits


def _hash_sql(id_col: str, seed: int = 42) -> str:
    return f"sha256('{seed}:' || CAST({id_col} AS VARCHAR))"


RANDOM_SPLIT_SQL = f"""
SELECT transaction_id, CASE WHEN rk <= (n * 1 + 4) // 5 THEN 'test' ELSE 'train' END AS split
FROM (SELECT transaction_id,
             row_number() OVER (ORDER BY {_hash_sql('transaction_id')}, transaction_id) AS rk,
             count(*) OVER () AS n
      FROM {CLEAN}) s"""


@register("random_split", RANDOM_SPLIT_SQL)
def q_random_split(spark, sf_dir):
    return SP.random_split(cleaned(spark, sf_dir).select("transaction_id"), "transaction_id", 0.2, 42)


Q_BAND = """CASE WHEN price IS NULL OR isnan(price) OR price <= 0 THEN NULL
     WHEN price <= 500000 THEN 1 WHEN price <= 1000000 THEN 2 WHEN price <= 2000000 THEN 3
     WHEN price <= 3000000 THEN 4 ELSE 5 END"""

def stratified_sql(src: str) -> str:
    """Bands and hash ranks over ``src``: test, validation and train as in the operator."""
    return f"""
SELECT transaction_id, price,
       CASE WHEN rk <= nt THEN 'test' WHEN rk <= nt + ((n - nt) * 3 + 16) // 17 THEN 'validation'
            ELSE 'train' END AS split
FROM (SELECT *, (n * 3 + 19) // 20 AS nt
      FROM (SELECT transaction_id, price,
                   row_number() OVER (PARTITION BY band ORDER BY {_hash_sql('transaction_id')}, transaction_id) AS rk,
                   count(*) OVER (PARTITION BY band) AS n
            FROM (SELECT transaction_id, price, coalesce({Q_BAND}, 0) AS band FROM {src}) b) r) t"""


STRATIFIED_SQL = stratified_sql(CLEAN)


def _stratified(spark, sf_dir):
    return SP.stratified_split(cleaned(spark, sf_dir).select("transaction_id", "price"),
                               "transaction_id", "price", 0.15, 0.15, 42)


@register("stratified_split", r4(STRATIFIED_SQL, "price"))
def q_stratified(spark, sf_dir):
    return round4(_stratified(spark, sf_dir))


# squared prices reach 1e10+: compare mse in whole units and rmse in cents
METRIC_DIGITS = {"mse": 0, "rmse": 2}


@register("regression_metrics", r4(f"""
SELECT split, sqrt(avg((y - p) * (y - p))) AS rmse, avg((y - p) * (y - p)) AS mse,
       CASE WHEN var_pop(y) * count(*) > 0 THEN 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*))
            WHEN sum((y - p) * (y - p)) = 0 THEN 1.0 ELSE 0.0 END AS r2,
       count(*) AS n
FROM (SELECT s.split, e.price AS y, e.borough_price_trend AS p
      FROM ({STRATIFIED_SQL}) s JOIN {ENG} ON s.transaction_id = e.transaction_id) j
WHERE y IS NOT NULL AND p IS NOT NULL
GROUP BY split""".replace(f"JOIN {ENG}", f"JOIN ({Q.ENGINEERED_SQL}) e"), "rmse", "mse", "r2",
                                     digits=METRIC_DIGITS))
def q_regression_metrics(spark, sf_dir):
    """Metrics of the district-median baseline on each split."""
    split = _stratified(spark, sf_dir).select("transaction_id", "split")
    eng = engineered(spark, sf_dir).select("transaction_id", "price", "borough_price_trend")
    return round4(regression_metrics(eng.join(split, "transaction_id"), "price",
                                     "borough_price_trend", "split"), METRIC_DIGITS)
