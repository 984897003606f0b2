"""Pipeline log tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks import schemas


def log_rows(
    spark: SparkSession, pipeline_name: str, run_id: str, entries: Sequence[tuple[str, str]],
    metadata: str | None = None, logger: str | None = None, module: str | None = None,
    function: str | None = None, line: int | None = None,
) -> DataFrame:
    """Log rows for (level, message) entries, stamped with the current time."""
    levels = spark.createDataFrame(list(entries), "level string, message string")
    constants = {
        "logger": logger or pipeline_name, "pipeline_name": pipeline_name, "run_id": run_id,
        "module": module, "function": function, "line": line, "metadata": metadata,
    }
    out = []
    for f in schemas.PIPELINE_LOGS.fields:
        if f.name == "timestamp":
            c = F.current_timestamp()
        elif f.name in ("level", "message"):
            c = F.col(f.name)
        else:
            c = F.lit(constants[f.name])
        out.append(c.cast(f.dataType).alias(f.name))
    return levels.select(*out)


def logs_by_level(logs: DataFrame) -> DataFrame:
    return logs.groupBy("pipeline_name", "run_id", "level").agg(
        F.count(F.lit(1)).alias("log_count")
    )


def log_coverage(logs: DataFrame) -> DataFrame:
    """Rows, first and last time per run, to spot gaps."""
    return logs.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("log_count"),
        F.min("timestamp").alias("first_log"),
        F.max("timestamp").alias("last_log"),
    )


def absent_rows(logs: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows whose run, time, level and message are not in the logs yet, each once."""
    key = ["run_id", "timestamp", "level", "message"]
    seen = logs.select(*[F.col(c).alias(f"_{c}") for c in key]).distinct()
    same = F.lit(True)
    for c in key:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return rows.dropDuplicates(key).join(seen, same, "left_anti")


# Fields of a fallback log line.
_FALLBACK = T.StructType(
    [
        T.StructField(n, T.StringType())
        for n in ["timestamp", "level", "message", "pipeline_name", "run_id", "metadata"]
    ]
)


def recover_logs(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(log rows, unreadable lines) of fallback JSON-lines files.

    Parsed from text, so one scan of a line gives the row or keeps the line:
    JSON that is broken or lacks a time, level or message is set aside.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    entry = F.from_json("value", _FALLBACK)
    parsed = lines.select("value", entry.alias("e")).select(
        "value", "e.*", F.col("e.timestamp").try_cast("timestamp_ntz").alias("at")
    )
    usable = F.col("at").isNotNull() & F.col("level").isNotNull() & F.col("message").isNotNull()
    rows = parsed.where(usable).select(
        *[
            (
                F.col("at") if f.name == "timestamp"
                else F.col(f.name) if f.name in _FALLBACK.names
                else F.lit(None)
            ).cast(f.dataType).alias(f.name)
            for f in schemas.PIPELINE_LOGS.fields
        ]
    )
    return rows, parsed.where(~usable).select("value")
