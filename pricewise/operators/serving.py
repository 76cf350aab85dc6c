"""Lookup tables, serving features and batch scoring of request tables.

Serving mirrors training but reads precomputed lookups instead of
recomputing trends; it runs over whole tables (or streams) of requests.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewise.functions.dates import month_start, sold_month, sold_year
from pricewise.functions.numeric import interval_bounds, round_price
from pricewise.functions.text import canonical_postcode, interaction, truthy
from pricewise.operators.aggregates import (global_fallback, group_median,
                                            group_median_composite, recent_group_median)
from pricewise.operators.enrich import dimension_table, lookup_with_fallback
from pricewise.operators.filters import ALLOWED_PROPERTY_TYPES, validate_requests
from pricewise.operators.model import MODEL_COLUMNS, score_table

# serving's Y/N leasehold flag rendered in training's F/L tenure codes.
TENURE_FROM_FLAG = {"Y": "L", "N": "F"}


@dataclass
class LookupTables:
    borough_price_trend: DataFrame      # district, price
    district_yearly_medians: DataFrame  # district, sold_year, district_year, price
    avg_price_last_half: DataFrame      # district, price

    def global_median(self) -> Column:
        return global_fallback(self.borough_price_trend).scalar()

    def long(self) -> DataFrame:
        """(lookup, key, price) rows of all three tables."""
        return (self.borough_price_trend.select(F.lit("borough_price_trend").alias("lookup"),
                                                F.col("district").alias("key"), "price")
                .unionByName(self.district_yearly_medians.select(
                    F.lit("district_yearly_medians").alias("lookup"),
                    F.col("district_year").alias("key"), "price"))
                .unionByName(self.avg_price_last_half.select(
                    F.lit("avg_price_last_half").alias("lookup"),
                    F.col("district").alias("key"), "price")))


def build_lookup_tables(engineered: DataFrame, district_col: str = "district",
                        year_col: str = "sold_year", date_col: str = "date",
                        price_col: str = "price", months: int = 6) -> LookupTables:
    """Three lookups from one engineered table: district medians,
    district-year medians, and district medians of the latest ``months``. ``year_col`` holds the
    year of ``date_col``; of a table partitioned by it the third reads the latest years alone."""
    base = engineered.select(F.col(district_col).alias("district"), year_col, date_col, price_col)
    return LookupTables(
        group_median(base, "district", price_col, "price"),
        group_median_composite(base, "district", year_col, price_col, "district_year", "price", keep_keys=True),
        recent_group_median(base, "district", date_col, price_col, months, "price", year_col=year_col),
    )


def serving_features(requests: DataFrame, lookups: LookupTables, as_of: Column,
                     district_col: str = "district",
                     tenure_map: Mapping[str, str] | None = TENURE_FROM_FLAG,
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """The 13 model inputs, in model order, for every request row.

    ``as_of`` replaces "today": year, month and month start come from it.
    Trend values fall back district-year -> previous year -> global median. The
    leasehold flag is rendered in training's codes (``tenure_map``), in the
    column itself and in its interaction.
    """
    req = requests.withColumns({
        "sold_year": sold_year(as_of), "sold_month": sold_month(as_of),
        "date": month_start(as_of)})
    req = lookup_with_fallback(req, district_col, "sold_year", lookups.borough_price_trend,
                               lookups.district_yearly_medians, lookups.avg_price_last_half,
                               lookups.global_median())
    tenure = F.col("is_leasehold")
    if tenure_map:
        m = F.create_map(*[F.lit(x) for kv in tenure_map.items() for x in kv])
        tenure = F.coalesce(m[F.col("is_leasehold")], F.col("is_leasehold"))
    req = req.withColumn("is_leasehold", tenure).withColumns({
        "advanced_property_type": interaction("is_new_build", "property_type"),
        "property_type_and_tenure": interaction("is_leasehold", "property_type"),
        "property_type_and_district": interaction(district_col, "property_type"),
    })
    if district_col != "district":
        req = req.withColumnRenamed(district_col, "district")
    return req.select(*keep, *MODEL_COLUMNS)


def route_requests(requests: DataFrame, directory: DataFrame, id_col: str = "request_id",
                   directory_key: str = "postcode", directory_value: str = "district",
                   allowed_types=ALLOWED_PROPERTY_TYPES) -> tuple[DataFrame, DataFrame]:
    """Validate and resolve requests: (accepted rows with district, rejected
    rows with the reason: first invalid field, else unknown postcode)."""
    checked = validate_requests(requests, allowed_types=allowed_types)
    lookup = dimension_table(directory, directory_key, directory_value, "district")
    keyed = checked.drop("district") if "district" in checked.columns else checked
    keyed = (keyed.withColumn("__pw_key", canonical_postcode("postcode"))
                  .join(lookup, on="__pw_key", how="left").drop("__pw_key"))
    reason = F.coalesce(F.col("reject_reason"),
                        F.when(F.col("district").isNull(), F.lit("unknown postcode")))
    keyed = keyed.withColumn("reject_reason", reason)
    rejected = keyed.where(F.col("reject_reason").isNotNull()).select(id_col, "reject_reason")
    accepted = keyed.where(F.col("reject_reason").isNull()).drop("is_valid", "reject_reason")
    return accepted, rejected


# How a response names its features.
USER_FIELDS = ("is_leasehold", "is_new_build", "postcode", "property_type")
ENRICHED = ("district", "borough_price_trend", "district_yearly_medians", "avg_price_last_half",
            "advanced_property_type", "property_type_and_tenure", "property_type_and_district",
            "sold_year", "sold_month", "date")
MODEL_NAME = "gbt_model"


def responses(features: DataFrame, model: PipelineModel, run_id: str, log_target: bool,
              id_col: str = "request_id", model_name: str = MODEL_NAME) -> DataFrame:
    """Responses for feature rows: predicted_price, confidence_interval [lo, hi], run_id,
    model_version ('name:first 8 of run_id') and features_used."""
    scored = score_table(model, features, log_target, "__raw")
    names = {"user_provided": USER_FIELDS, "enriched": ENRICHED, "defaulted": ()}
    used = F.struct(*[F.array(*[F.lit(x) for x in v]).cast("array<string>").alias(k) for k, v in names.items()])
    return scored.select(
        id_col, "district", round_price("__raw").alias("predicted_price"),
        interval_bounds("__raw").alias("confidence_interval"), F.lit(run_id).alias("run_id"),
        F.lit(f"{model_name}:{run_id[:8]}").alias("model_version"), used.alias("features_used"))


def score_requests(requests: DataFrame, directory: DataFrame, lookups: LookupTables,
                   model: PipelineModel, as_of: Column, run: DataFrame, id_col: str = "request_id",
                   directory_key: str = "postcode", directory_value: str = "district",
                   allowed_types=ALLOWED_PROPERTY_TYPES,
                   model_name: str = MODEL_NAME) -> tuple[DataFrame, DataFrame]:
    """validate -> district -> features -> price -> interval.

    ``run`` is the run record of the model (see ``model.run_record``): its id names the
    responses and its ``log_target`` parameter (missing: true) says how to invert
    the prediction. Returns (responses, rejected).
    """
    record = run.select("run_id", F.coalesce(truthy(F.col("params")["log_target"]), F.lit(True)).alias("log")).first()
    if record is None:
        raise LookupError("no run record for the model")
    accepted, rejected = route_requests(requests, directory, id_col, directory_key,
                                        directory_value, allowed_types)
    feats = serving_features(accepted, lookups, as_of, keep=(id_col,))
    return responses(feats, model, record["run_id"], record["log"], id_col, model_name), rejected
