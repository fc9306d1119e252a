"""Incremental weather integration of newly landed crash files.

Every stage between the geographic filter and the weather features is
stateless per row, so the batch operators run unchanged on ``readStream``.
The weather table is the static side of a stream-static left join (checked
small, then broadcast), dates use the per-row rule (a table-wide switch has
no meaning on an unbounded stream), and the sink is exactly-once Parquet
with its checkpoint in the folder the session names.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from roadbook.operators.dates import reconstruct_dates
from roadbook.operators.geo import geo_pipeline
from roadbook.operators.weather import add_weather_features, join_weather
from roadbook.session import checkpoint_dir


def crash_weather_stream(spark: SparkSession, source_dir: str, schema: StructType, weather: DataFrame,
                         fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming version of geo -> dates -> weather join -> features."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    crashes = reader.load(source_dir)
    dated = reconstruct_dates(geo_pipeline(crashes), mode="row")
    return add_weather_features(join_weather(dated, weather))


def start(df: DataFrame, out_dir: str, name: str = "crash_weather", available_now: bool = True) -> StreamingQuery:
    """Append the stream to Parquet; checkpoint under the session's checkpoint folder.

    The checkpoint is keyed by the sink path, so restarting the same sink
    resumes exactly once, and a different sink never inherits its state.
    """
    key = hashlib.sha1(os.path.abspath(out_dir).encode()).hexdigest()[:16]
    ckpt = os.path.join(checkpoint_dir(df.sparkSession), f"stream-{name}-{key}")
    w = df.writeStream.format("parquet").option("checkpointLocation", ckpt).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start(out_dir)
