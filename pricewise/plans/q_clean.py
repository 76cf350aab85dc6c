"""Registered queries: scalars, projections, filters, cleaning (SC*, DT*, PJ*, FL1-6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewise import functions as PF
from pricewise.operators import clean as C
from pricewise.operators import filters as FL
from pricewise.operators.clean import drop_null_rows
from pricewise.plans import sqltext as Q
from pricewise.plans import tables as T
from pricewise.plans.catalog import cast_sales, cleaned, engineered, register, round4
from pricewise.plans.pipelines import clean_augment
from pricewise.plans.sqltext import canon, ix, num, r4, rhu

RAW = f"({T.SALES_RAW_SQL}) raw"
CAST = f"({Q.CAST_ONLY_SQL}) cs"
CLEAN = f"({Q.CLEAN_SQL}) cl"
ENG = f"({Q.ENGINEERED_SQL}) en"

# ------------------------------------------------------------------ scalars


@register("canonical_postcode", f"SELECT transaction_id, postcode, {canon('postcode')} AS postcode_clean FROM {RAW}")
def q_canonical_postcode(spark, sf_dir):
    return T.sales_raw(spark, sf_dir).select(
        "transaction_id", "postcode", PF.canonical_postcode("postcode").alias("postcode_clean"))


@register("split_postcode", f"""
SELECT transaction_id, pc AS postcode_clean, left(pc, greatest(length(pc) - 3, 0)) AS outcode,
       right(pc, 3) AS incode
FROM (SELECT transaction_id, {canon('postcode')} AS pc FROM {RAW}) p""")
def q_split_postcode(spark, sf_dir):
    return C.normalise_postcodes(T.sales_raw(spark, sf_dir), "postcode").select(
        "transaction_id", "postcode_clean", "outcode", "incode")


@register("cast_numeric_coerce", r4(f"SELECT transaction_id, price AS price_text, {num('price')} AS price FROM {RAW}", "price"))
def q_cast_numeric(spark, sf_dir):
    return round4(T.sales_raw(spark, sf_dir).select(
        "transaction_id", F.col("price").alias("price_text"), PF.cast_numeric("price").alias("price")))


@register("cast_timestamp_coerce", f"""
SELECT transaction_id, date AS date_text, try_strptime(date, '%Y-%m-%d %H:%M') AS date FROM {RAW}""")
def q_cast_timestamp(spark, sf_dir):
    return T.sales_raw(spark, sf_dir).select(
        "transaction_id", F.col("date").alias("date_text"), PF.cast_timestamp("date").alias("date"))


@register("cast_timestamp_inferred", f"""
SELECT transaction_id, try_strptime(date, '%Y-%m-%d %H:%M') AS date FROM {RAW}""")
def q_cast_timestamp_inferred(spark, sf_dir):
    """The dates are rewritten in another layout (texts that are no dates stay); the operator is
    not told which."""
    raw = T.sales_raw(spark, sf_dir)
    known = PF.cast_timestamp("date")
    raw = raw.select("transaction_id", F.coalesce(F.date_format(known, "d MMMM yyyy HH:mm:ss"), F.col("date")).alias("date"))
    return C.cast_columns(raw.orderBy(known.isNull(), "transaction_id"), {"date": "datetime"}, "infer")


@register("clip_upper_quantile", r4(f"""
SELECT transaction_id, price,
       CASE WHEN price > (SELECT quantile_cont(price, 0.99) FROM {CAST})
            THEN (SELECT quantile_cont(price, 0.99) FROM {CAST}) ELSE price END AS price_clipped
FROM {CAST}""", "price", "price_clipped"))
def q_clip(spark, sf_dir):
    df = cast_sales(spark, sf_dir)
    return round4(C.clip_upper_quantile(df, "price", 0.99, out_col="price_clipped")
                  .select("transaction_id", "price", "price_clipped"))


@register("log1p_label", r4(f"SELECT transaction_id, ln(1 + price) AS log_price FROM {CLEAN}", "log_price"))
def q_log1p(spark, sf_dir):
    return round4(cleaned(spark, sf_dir).select("transaction_id", PF.log1p_label("price").alias("log_price")))


@register("expm1_pred", r4(f"SELECT transaction_id, exp(ln(1 + price)) - 1 AS price_back FROM {CLEAN}", "price_back"))
def q_expm1(spark, sf_dir):
    return round4(cleaned(spark, sf_dir).select(
        "transaction_id", PF.expm1_pred(PF.log1p_label("price")).alias("price_back")))


PRICE_BAND_SQL = """CASE WHEN price IS NULL OR isnan(price) OR price <= 0 THEN NULL
     WHEN price <= 500000 THEN 1 WHEN price <= 1000000 THEN 2 WHEN price <= 2000000 THEN 3
     WHEN price <= 3000000 THEN 4 ELSE 5 END"""


@register("price_band", r4(f"""
SELECT transaction_id, price, {PRICE_BAND_SQL} AS price_band
FROM (SELECT transaction_id, price * 10 AS price FROM {CLEAN}) s""", "price"))
def q_price_band(spark, sf_dir):
    # prices scaled x10 so that every band, edges included, is populated
    df = cleaned(spark, sf_dir).select("transaction_id", (F.col("price") * 10).alias("price"))
    return round4(df.withColumn("price_band", PF.price_band("price")))


# Category merge used by the merge query (segment letters).
MERGE_MAP = {"AB": ["A", "B"], "FH": ["F", "H"]}


@register("merge_categories", f"""
SELECT transaction_id,
       CASE WHEN property_type IN ('A', 'B') THEN 'AB' WHEN property_type IN ('F', 'H') THEN 'FH'
            ELSE property_type END AS property_type,
       is_new_build, is_leasehold
FROM {CLEAN}""")
def q_merge(spark, sf_dir):
    df = cleaned(spark, sf_dir).select("transaction_id", "property_type", "is_new_build", "is_leasehold")
    return C.merge_categories(df, MERGE_MAP, subset=["property_type"])


@register("round2_interval", r4(f"""
SELECT transaction_id, p AS predicted_price,
       {rhu('greatest(0.0, p - m)')} AS ci_low, {rhu('p + m')} AS ci_high
FROM (SELECT transaction_id, p, {rhu('p * 0.1')} AS m
      FROM (SELECT transaction_id, {rhu('avg_price_last_half')} AS p FROM {ENG}) a) b""",
                                 "predicted_price", "ci_low", "ci_high"))
def q_round2(spark, sf_dir):
    df = engineered(spark, sf_dir)
    iv = PF.interval_bounds("avg_price_last_half")
    return round4(df.select("transaction_id", PF.round_price("avg_price_last_half").alias("predicted_price"),
                            iv[0].alias("ci_low"), iv[1].alias("ci_high")))


TRUTHY_TEXT_SQL = """CASE event_type WHEN 'view' THEN ' Yes ' WHEN 'click' THEN '1'
     WHEN 'purchase' THEN 'false' WHEN 'signup' THEN 'Y' ELSE NULL END"""


@register("truthy_param", f"""
SELECT event_id, flag, CASE WHEN flag IS NULL THEN true
                            ELSE lower(trim(flag)) IN ('1', 'true', 'yes', 'y') END AS truthy
FROM (SELECT event_id, {TRUTHY_TEXT_SQL} AS flag FROM events) e""")
def q_truthy(spark, sf_dir):
    e = T.read(spark, sf_dir, "events")
    flag = (F.when(F.col("event_type") == "view", " Yes ").when(F.col("event_type") == "click", "1")
             .when(F.col("event_type") == "purchase", "false")
             .when(F.col("event_type") == "signup", "Y"))
    return e.select("event_id", flag.alias("flag")).withColumn("truthy", PF.truthy("flag", True))


@register("sold_year", f"SELECT transaction_id, CAST(year(date) AS BIGINT) AS sold_year FROM {CAST}")
def q_sold_year(spark, sf_dir):
    return C.add_sold_year(cast_sales(spark, sf_dir), "date").select("transaction_id", "sold_year")


@register("sold_month", f"SELECT transaction_id, CAST(month(date) AS BIGINT) AS sold_month FROM {CAST}")
def q_sold_month(spark, sf_dir):
    return C.add_sold_month(cast_sales(spark, sf_dir), "date").select("transaction_id", "sold_month")


@register("month_start", "SELECT event_id, date_trunc('month', ts) AS month_start FROM events")
def q_month_start(spark, sf_dir):
    return T.read(spark, sf_dir, "events").select("event_id", PF.month_start("ts").alias("month_start"))


@register("epoch_millis_to_utc", """
SELECT event_id, epoch_us(ts) // 1000 AS ms, make_timestamp((epoch_us(ts) // 1000) * 1000) AS ts_utc
FROM events""")
def q_epoch(spark, sf_dir):
    e = T.read(spark, sf_dir, "events").select("event_id", PF.ntz_micros("ts").alias("us"))
    e = e.withColumn("ms", F.floor(F.col("us") / 1000).cast("bigint"))
    return e.select("event_id", "ms", PF.epoch_millis_to_utc("ms").alias("ts_utc"))


# ------------------------------------------------------------------ projections

MODEL_INPUT_SQL = """property_type, is_new_build, is_leasehold, district, sold_month,
       advanced_property_type, property_type_and_tenure, property_type_and_district, date,
       sold_year, borough_price_trend, district_yearly_medians, avg_price_last_half"""


@register("required_columns", r4(f"SELECT {MODEL_INPUT_SQL}, price FROM {ENG}", "price",
                                 "borough_price_trend", "district_yearly_medians", "avg_price_last_half"))
def q_required(spark, sf_dir):
    from pricewise.operators.model import CAT_FEATURES, MODEL_COLUMNS
    cats = [c for c in MODEL_COLUMNS if c in CAT_FEATURES]
    nums = [c for c in MODEL_COLUMNS if c not in CAT_FEATURES]
    return round4(C.required_columns(engineered(spark, sf_dir), cats, nums, "price"))


@register("rename_safe", r4(f"""
SELECT transaction_id, price, date, postcode, property_type, "old/new" AS is_new_build,
       duration AS is_leasehold, county FROM {CAST}""", "price"))
def q_rename(spark, sf_dir):
    mapping = {"old/new": "is_new_build", "no_such_column": "ignored", "duration": "is_leasehold"}
    return round4(C.rename_columns(cast_sales(spark, sf_dir), mapping))


@register("drop_column", r4(f"SELECT {MODEL_INPUT_SQL} FROM {ENG}",
                            "borough_price_trend", "district_yearly_medians", "avg_price_last_half"))
def q_drop(spark, sf_dir):
    from pricewise.operators.model import MODEL_COLUMNS
    return round4(C.drop_columns(engineered(spark, sf_dir).select(*MODEL_COLUMNS, "price"), ["price"]))


@register("interaction_feature", f"""
SELECT transaction_id, {ix('is_new_build', 'property_type')} AS advanced_property_type,
       {ix('district', 'property_type', '|')} AS district_and_type
FROM ({Q.RESOLVED_ALL_SQL}) r""")
def q_interaction(spark, sf_dir):
    from pricewise.plans.catalog import resolved
    df = resolved(spark, sf_dir)
    df = C.add_interaction(df, "advanced_property_type", "is_new_build", "property_type")
    df = C.add_interaction(df, "district_and_type", "district", "property_type", sep="|")
    return df.select("transaction_id", "advanced_property_type", "district_and_type")


# ------------------------------------------------------------------ filters


@register("keyword_filter", r4(f"""
SELECT * FROM {CLEAN}
WHERE coalesce(regexp_matches(county, '(?i)a'), false) AND coalesce(regexp_matches(county, '(?i)i'), false)""",
                               "price"))
def q_keyword(spark, sf_dir):
    return round4(FL.keyword_filter(cleaned(spark, sf_dir), "county", Q.FLAGSHIP_KEYWORDS))


@register("drop_null_rows", r4(f"""
SELECT * FROM {CAST}
WHERE price IS NOT NULL AND NOT isnan(price) AND date IS NOT NULL AND postcode IS NOT NULL
  AND property_type IS NOT NULL AND "old/new" IS NOT NULL AND duration IS NOT NULL AND county IS NOT NULL""",
                               "price"))
def q_dropna(spark, sf_dir):
    return round4(drop_null_rows(cast_sales(spark, sf_dir), T.LOADED_COLUMNS))


@register("drop_rare_categories", f"""
SELECT transaction_id, outcode FROM {CLEAN}
WHERE outcode IN (SELECT outcode FROM {CLEAN} WHERE outcode IS NOT NULL GROUP BY outcode HAVING count(*) >= 10)""")
def q_rare(spark, sf_dir):
    return FL.drop_rare_categories(cleaned(spark, sf_dir), "outcode", 10).select("transaction_id", "outcode")


@register("validate_requests", f"""
SELECT request_id, pt AS property_type, nb AS is_new_build, lh AS is_leasehold,
       reason AS reject_reason, reason IS NULL AS is_valid
FROM (SELECT request_id, pt, nb, lh,
             CASE WHEN NOT coalesce(pt IN ('A', 'B', 'F', 'H', 'M'), false)
                  THEN 'property_type must be one of A,B,F,H,M'
                  WHEN NOT nb IN ('Y', 'N') THEN 'is_new_build must be Y or N'
                  WHEN NOT lh IN ('Y', 'N') THEN 'is_leasehold must be Y or N' END AS reason
      FROM (SELECT request_id, upper(property_type) AS pt, upper(coalesce(is_new_build, 'N')) AS nb,
                   upper(coalesce(is_leasehold, 'N')) AS lh FROM ({Q.REQUESTS_SQL}) r) u) v""")
def q_validate(spark, sf_dir):
    out = FL.validate_requests(T.requests_table(spark, sf_dir), allowed_types=T.PROPERTY_TYPES)
    return out.select("request_id", "property_type", "is_new_build", "is_leasehold",
                      "reject_reason", "is_valid")


@register("unresolved_keys", f"""
SELECT DISTINCT {canon('postcode')} AS key FROM {CLEAN}
WHERE {canon('postcode')} IS NOT NULL
  AND {canon('postcode')} NOT IN (SELECT k FROM ({Q.DIR_LOOKUP_SQL}) d)""")
def q_unresolved(spark, sf_dir):
    return FL.unresolved_keys(cleaned(spark, sf_dir), "postcode", T.postcode_directory(spark, sf_dir),
                              "postcode", "district")


@register("recent_rows", r4(f"""
SELECT * FROM {CLEAN} WHERE date >= (SELECT max(date) FROM {CLEAN}) - INTERVAL 6 MONTH""", "price"))
def q_recent(spark, sf_dir):
    return round4(FL.recent_rows(cleaned(spark, sf_dir), "date", 6, "sold_year"))


PC = canon("postcode")


@register("clean_augment", r4(f"""
SELECT transaction_id, postcode, {num('quantity')} AS quantity, {PC} AS postcode_clean,
       left({PC}, greatest(length({PC}) - 3, 0)) AS outcode, right({PC}, 3) AS incode
FROM ({T.PARCEL_SIDE_SQL}) q
WHERE transaction_id IS NOT NULL AND postcode IS NOT NULL
  AND {num('quantity')} IS NOT NULL AND NOT isnan({num('quantity')})""", "quantity"))
def q_clean_augment(spark, sf_dir):
    return round4(clean_augment(T.parcel_side(spark, sf_dir), dtype_map={"quantity": "float", "postcode": "string"},
                                postcode_col="postcode", required_cols=["transaction_id", "postcode", "quantity"]))
