from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..config import Config
from ..plans import staging
from ..sources.schemas import RAW_SCHEMAS

_STAGERS = {"events": staging.stage_events, "licenses": staging.stage_licenses,
            "transactions": staging.stage_transactions}


def staged_stream(spark: SparkSession, source: str, path: str, fmt: str = "parquet",
                  cfg: Config = Config()) -> DataFrame:
    """A streaming DataFrame of the staged rows of raw files arriving under ``path``."""
    raw = spark.readStream.format(fmt).schema(RAW_SCHEMAS[source]).load(path)
    return _STAGERS[source](raw, cfg)


def stage_stream(spark: SparkSession, source: str, path: str, out: str, checkpoint: str,
                 fmt: str = "parquet", cfg: Config = Config(),
                 available_now: bool = False) -> StreamingQuery:
    """Append staged rows to the parquet table ``out``; progress is kept under ``checkpoint`` (a
    shared folder) so a restarted query resumes exactly where it stopped."""
    writer = (staged_stream(spark, source, path, fmt, cfg).writeStream.format("parquet")
              .option("path", out).option("checkpointLocation", checkpoint).outputMode("append"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
