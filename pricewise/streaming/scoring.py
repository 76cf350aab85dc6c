"""Score a stream of requests against static lookups and a fitted model.

The serving path is stateless (validate -> directory join -> lookup joins
-> features -> model), so it runs unchanged on a streaming DataFrame as
stream-static joins. Each micro-batch is written by ``foreachBatch`` into a
folder named by its batch id, which makes a replayed batch overwrite its own
output instead of duplicating it (exactly-once with the checkpoint).
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession

from pricewise.operators.filters import ALLOWED_PROPERTY_TYPES
from pricewise.operators.serving import LookupTables, route_requests, score_requests, serving_features

REQUEST_SCHEMA = ("request_id bigint, postcode string, property_type string, "
                  "is_new_build string, is_leasehold string")


def read_request_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 100) -> DataFrame:
    """Parquet files dropped into ``path`` become a request stream."""
    return (spark.readStream.schema(REQUEST_SCHEMA)
                 .option("maxFilesPerTrigger", max_files_per_trigger).parquet(path))


def stream_features(requests: DataFrame, directory: DataFrame, lookups: LookupTables,
                    as_of: Column, allowed_types=ALLOWED_PROPERTY_TYPES) -> tuple[DataFrame, DataFrame]:
    """(features, rejected) for a streaming (or static) request DataFrame."""
    accepted, rejected = route_requests(requests, directory, allowed_types=allowed_types)
    return serving_features(accepted, lookups, as_of, keep=("request_id",)), rejected


def start_scoring(requests: DataFrame, directory: DataFrame, lookups: LookupTables,
                  model: PipelineModel, as_of: Column, run: DataFrame, out_path: str, checkpoint: str,
                  allowed_types=ALLOWED_PROPERTY_TYPES, available_now: bool = True):
    """Start the scoring query. Every request is answered: responses land in
    ``out_path/responses/batch=<id>``, rejected requests with their reason in
    ``out_path/rejected/batch=<id>``."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        for name, df in zip(("responses", "rejected"),
                            score_requests(batch, directory, lookups, model, as_of, run, allowed_types=allowed_types)):
            df.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/{name}/batch={batch_id}")

    writer = requests.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
