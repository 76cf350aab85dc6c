"""Registered queries: data-quality profile (AG4-AG9, ML7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewise.operators import profile as PR
from pricewise.plans import sqltext as Q
from pricewise.plans.catalog import cast_sales, cleaned, register, round4
from pricewise.session import stored
from pricewise.sources.files import json_text, write_json_document

# Column lists of the two profiled tables (the oracle SQL needs them spelled out).
CLEAN_NUMERIC = ("price", "sold_year", "sold_month")
CLEAN_TEXT = ("transaction_id", "postcode", "property_type", "is_new_build", "is_leasehold",
              "county", "postcode_clean", "outcode", "incode")
CLEAN_ALL = ("transaction_id", "price", "date", "postcode", "property_type", "is_new_build",
             "is_leasehold", "county", "postcode_clean", "outcode", "incode", "sold_year",
             "sold_month")
CAST_NUMERIC = ("price",)
CAST_TEXT = ("transaction_id", "postcode", "property_type", "old/new", "duration", "county")
CAST_ALL = ("transaction_id", "price", "date", "postcode", "property_type", "old/new", "duration",
            "county")
CAST_FLOATS = ("price",)
DUCK_TYPES = {"VARCHAR": "string", "DOUBLE": "double", "TIMESTAMP": "timestamp_ntz",
              "BIGINT": "bigint", "INTEGER": "int", "BOOLEAN": "boolean"}


def qi(name: str) -> str:
    return '"' + name + '"'


def sql_null_ratio(src: str, cols, floats) -> str:
    parts = []
    for c in cols:
        miss = f"{qi(c)} IS NULL" + (f" OR isnan({qi(c)})" if c in floats else "")
        parts.append(f"SELECT '{c}' AS \"column\", avg(CASE WHEN {miss} THEN 1.0 ELSE 0.0 END) AS null_ratio FROM {src}")
    return " UNION ALL ".join(parts)


def sql_schema(src_sql: str) -> str:
    mapping = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in DUCK_TYPES.items())
    return (f"SELECT column_name AS \"column\", CASE column_type {mapping} ELSE lower(column_type) END AS type "
            f"FROM (DESCRIBE {src_sql})")


def sql_numeric_profile(src: str, cols) -> str:
    parts = []
    for c in cols:
        v = f"CAST({qi(c)} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS \"column\", CAST(count({v}) AS DOUBLE) AS count, avg({v}) AS mean, "
            f"stddev_samp({v}) AS std, min({v}) AS min, quantile_cont({v}, 0.25) AS q25, "
            f"quantile_cont({v}, 0.5) AS q50, quantile_cont({v}, 0.75) AS q75, max({v}) AS max "
            f"FROM {src} WHERE {v} IS NOT NULL AND NOT isnan({v})")
    return " UNION ALL ".join(parts)


def sql_outliers(src: str, cols) -> str:
    parts = []
    for c in cols:
        v = f"CAST({qi(c)} AS DOUBLE)"
        q = (f"(SELECT quantile_cont({v}, 0.25) AS q1, quantile_cont({v}, 0.75) AS q3 FROM {src} "
             f"WHERE {v} IS NOT NULL AND NOT isnan({v}))")
        parts.append(
            f"SELECT '{c}' AS \"column\", CAST(count_if({v} < q.q1 - 1.5 * (q.q3 - q.q1) OR "
            f"{v} > q.q3 + 1.5 * (q.q3 - q.q1)) AS BIGINT) AS outliers FROM {src}, {q} q")
    return " UNION ALL ".join(parts)


def sql_categories(src: str, cols, max_unique: int = PR.MAX_CATEGORY_VALUES) -> str:
    parts = []
    for c in cols:
        parts.append(
            f"SELECT '{c}' AS \"column\", CAST({qi(c)} AS VARCHAR) AS value, "
            f"CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () AS share FROM {src} "
            f"WHERE {qi(c)} IS NOT NULL GROUP BY {qi(c)} "
            f"HAVING (SELECT count(DISTINCT {qi(c)}) FROM {src}) <= {max_unique}")
    return " UNION ALL ".join(parts)


def sql_ks(src: str, cols, id_col: str = "transaction_id") -> str:
    side = (f"CASE WHEN row_number() OVER (ORDER BY sha256('42:' || CAST({id_col} AS VARCHAR)), {id_col}) "
            f"<= (count(*) OVER () + 4) // 5 THEN 'test' ELSE 'train' END")
    long = " UNION ALL ".join(
        f"SELECT '{c}' AS col, CAST({qi(c)} AS DOUBLE) AS value, side FROM s" for c in cols)
    return f"""
WITH s AS (SELECT *, {side} AS side FROM {src}),
l AS ({long}),
c AS (SELECT col, value, CAST(count_if(side = 'train') AS DOUBLE) AS a,
             CAST(count_if(side = 'test') AS DOUBLE) AS b
      FROM l WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY col, value),
w AS (SELECT col, sum(a) OVER (PARTITION BY col ORDER BY value) AS ca,
             sum(b) OVER (PARTITION BY col ORDER BY value) AS cb,
             sum(a) OVER (PARTITION BY col) AS na, sum(b) OVER (PARTITION BY col) AS nb FROM c)
SELECT col AS "column", max(abs(ca / na - cb / nb)) AS ks FROM w GROUP BY col"""


CLEAN = f"({Q.CLEAN_SQL}) cl"
CAST = f"({Q.CAST_ONLY_SQL}) cs"


@register("null_ratio", Q.r4(sql_null_ratio(CAST, CAST_ALL, CAST_FLOATS), "null_ratio"))
def q_null_ratio(spark, sf_dir):
    return round4(PR.null_ratio(cast_sales(spark, sf_dir)))


@register("schema_summary", sql_schema(Q.CLEAN_SQL))
def q_schema(spark, sf_dir):
    return PR.schema_summary(cleaned(spark, sf_dir))


NUM_DOUBLES = ("count", "mean", "std", "min", "q25", "q50", "q75", "max")


@register("numeric_profile", Q.r4(sql_numeric_profile(CLEAN, CLEAN_NUMERIC), *NUM_DOUBLES))
def q_numeric_profile(spark, sf_dir):
    return round4(PR.numeric_profile(cleaned(spark, sf_dir), CLEAN_NUMERIC))


@register("outlier_count", sql_outliers(CLEAN, CLEAN_NUMERIC))
def q_outliers(spark, sf_dir):
    return PR.outlier_count(cleaned(spark, sf_dir), CLEAN_NUMERIC)


@register("category_distribution", Q.r4(sql_categories(CLEAN, CLEAN_TEXT), "share"))
def q_categories(spark, sf_dir):
    return round4(PR.category_distribution(cleaned(spark, sf_dir), CLEAN_TEXT))


@register("ks_drift", Q.r4(sql_ks(CLEAN, CLEAN_NUMERIC), "ks"))
def q_ks(spark, sf_dir):
    return round4(PR.ks_drift(cleaned(spark, sf_dir), "transaction_id", CLEAN_NUMERIC))


# ------------------------------------------------------------------ ML7


def quality_report(df: DataFrame, id_col: str, numeric=None, text=None) -> DataFrame:
    """All six profile sections as (section, column, key, value, text) rows.

    The sections read one stored copy of ``df`` instead of its lineage six times.
    """
    df = stored(df, "report-input")
    numeric = list(numeric) if numeric is not None else PR.numeric_columns(df)
    text = list(text) if text is not None else PR.text_columns(df)
    none_d, none_s = F.lit(None).cast("double"), F.lit(None).cast("string")
    parts = [
        PR.null_ratio(df).select(F.lit("missing").alias("section"), "column",
                                 F.lit("null_ratio").alias("key"), F.col("null_ratio").alias("value"),
                                 none_s.alias("text")),
        PR.schema_summary(df).select(F.lit("schema_summary").alias("section"), "column",
                                     F.lit("type").alias("key"), none_d.alias("value"),
                                     F.col("type").alias("text")),
    ]
    if numeric:
        prof = stored(PR.numeric_profile(df, numeric), "report-profile")
        stats = F.array(*[F.struct(F.lit(k).alias("key"), F.col(c).alias("value"))
                          for k, c in zip(PR.PROFILE_STATS, NUM_DOUBLES)])
        parts += [
            prof.select(F.lit("numeric_stats").alias("section"), "column", F.inline(stats))
                .withColumn("text", none_s),
            PR.outlier_count(df, numeric, profile=prof).select(F.lit("outliers").alias("section"), "column",
                                                 F.lit("count").alias("key"),
                                                 F.col("outliers").cast("double").alias("value"),
                                                 none_s.alias("text")),
            PR.ks_drift(df, id_col, numeric).select(F.lit("train_val_drift").alias("section"), "column",
                                                    F.lit("ks").alias("key"), F.col("ks").alias("value"),
                                                    none_s.alias("text")),
        ]
    if text:
        parts.append(PR.category_distribution(df, text).select(
            F.lit("category_distribution").alias("section"), "column", F.col("value").alias("key"),
            F.col("share").alias("value"), none_s.alias("text")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_quality_report(report: DataFrame, path: str) -> str:
    """The report's rows as one nested JSON document {section: {column: {key: number or text}}}."""
    value = F.when(F.col("text").isNotNull(), json_text(F.col("text"))).otherwise(json_text(F.col("value")))
    return write_json_document(report.withColumn("__json", value), path, ["section", "column", "key"], "__json",
                               value_is_json=True)


def _sql_report(src_sql: str, cols, floats, numeric, text) -> str:
    src = f"({src_sql}) src"
    stats = " UNION ALL ".join(
        f"SELECT 'numeric_stats' AS section, \"column\", '{k}' AS key, {c} AS value, NULL::VARCHAR AS text FROM np"
        for k, c in zip(PR.PROFILE_STATS, NUM_DOUBLES))
    return f"""
WITH np AS ({sql_numeric_profile(src, numeric)})
SELECT 'missing' AS section, "column", 'null_ratio' AS key, null_ratio AS value, NULL::VARCHAR AS text
FROM ({sql_null_ratio(src, cols, floats)}) a
UNION ALL SELECT 'schema_summary', "column", 'type', NULL::DOUBLE, type FROM ({sql_schema(src_sql)}) b
UNION ALL {stats}
UNION ALL SELECT 'outliers', "column", 'count', CAST(outliers AS DOUBLE), NULL FROM ({sql_outliers(src, numeric)}) c
UNION ALL SELECT 'train_val_drift', "column", 'ks', ks, NULL FROM ({sql_ks(src, numeric)}) d
UNION ALL SELECT 'category_distribution', "column", value, share, NULL FROM ({sql_categories(src, text)}) e"""


@register("quality_report", Q.r4(_sql_report(Q.CAST_ONLY_SQL, CAST_ALL, CAST_FLOATS, CAST_NUMERIC,
                                             CAST_TEXT), "value"))
def q_quality_report(spark, sf_dir):
    """Report on the raw sales after the coercing casts (as the source profiles raw data)."""
    return round4(quality_report(cast_sales(spark, sf_dir), "transaction_id", CAST_NUMERIC, CAST_TEXT))
