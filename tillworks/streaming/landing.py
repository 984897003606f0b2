"""Newly landed files into bronze, each once."""

from __future__ import annotations

import json
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks import schemas
from tillworks.operators import ledger as L
from tillworks.operators import silver
from tillworks.plans import monthly
from tillworks.sources import transactions as X
from tillworks.sources.layers import LayerStore, in_partitions, write_bronze

BRONZE = "bronze.raw_transactions"
# Ledger of the files in bronze: a row per file and batch, a folder per bronze version and batch.
LANDED = "ops.landed_files"
LANDED_ROWS = "source_file string, bronze_version string, ingest_batch string"
# Bytes of files that one micro-batch takes; a backlog beyond it comes in several.
BYTES_PER_TRIGGER = 64 << 30


def landing_lines(
    spark: SparkSession, landing: str, fmt: str = "csv", schema: T.StructType | None = None,
    bytes_per_trigger: int = BYTES_PER_TRIGGER,
) -> DataFrame:
    """Stream of the files in a landing folder (or glob)."""
    reader = spark.readStream.schema(schema or schemas.SOURCE_FILE)
    reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    if fmt == "csv":
        reader = reader.option("header", True)
    lines = reader.format(fmt).load(landing)
    return lines.withColumn("source_file", F.col("_metadata.file_path"))


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The stream's lasting id, kept in its checkpoint folder; a renewed checkpoint has another."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").head()[0])["id"]


def drain(lines: DataFrame, checkpoint: str, take: Callable[[DataFrame, str], None]) -> None:
    """Give all files present to ``take``, a micro-batch at a time, then stop.

    A batch's name holds the stream's id, so batches of several streams never
    meet under one name, while a replayed batch has its old one.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        take(batch, f"{stream_id(batch.sparkSession, checkpoint)}-{batch_id}")

    writer = lines.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


def _batches(store: LayerStore, folder: str) -> set[str]:
    """Batches that have a folder under a table's folder; one listing, no file is opened."""
    fs, place = store._fs(folder)
    if not fs.exists(place):
        return set()
    names = [status.getPath().getName() for status in fs.listStatus(place)]
    return {unquote(n.split("=", 1)[1]) for n in names if n.startswith("ingest_batch=")}


def note_landed(store: LayerStore, but: str | None = None) -> None:
    """Enter the files of bronze batches that the ledger does not know yet, except batch ``but``.

    Only those batches are read: as a rule the one just written, after a crash between the two
    writes the one left over, and all once where bronze was filled before there was a ledger or a
    full refresh replaced it (the ledger is kept for each bronze version). A batch without file
    names gets a row, too, so that it is not read again.
    """
    version = store.location(BRONZE).rsplit("=", 1)[1]
    noted = set()
    if store.exists(LANDED):
        noted = _batches(store, f"{store.location(LANDED)}/bronze_version={version}")
    missing = _batches(store, store.location(BRONZE)) - noted - {but}
    if not missing:
        return
    rows = store.read(BRONZE).where(F.col("ingest_batch").isin(sorted(missing)))
    files = rows.select("source_file", F.lit(version).alias("bronze_version"), "ingest_batch").distinct()
    store.overwrite_partitions(files, LANDED, ["bronze_version", "ingest_batch"])


def landed_files(store: LayerStore) -> DataFrame:
    """(source_file, ingest_batch) of the current bronze version, from the ledger."""
    if not store.exists(LANDED):
        rows = store.spark.createDataFrame([], LANDED_ROWS)
    else:
        rows = store.spark.read.schema(LANDED_ROWS).parquet(store.location(LANDED))
        rows = rows.where(F.col("bronze_version") == store.location(BRONZE).rsplit("=", 1)[1])
    return rows.where("source_file is not null").select("source_file", "ingest_batch")


def take_batch(store: LayerStore, rows: DataFrame, batch: str) -> DataFrame:
    """One batch of cleaned lines into bronze; returns the rows that it holds there.

    The batch has folders of its own, so a replay replaces it. Files that another
    batch already brought, before a checkpoint was renewed, are left out: the ledger
    names them, so no line of an earlier batch is read.
    """
    fresh = X.bronze_rows(rows, batch)
    if store.exists(BRONZE):
        note_landed(store, but=batch)
        others = landed_files(store).where(F.col("ingest_batch") != batch)
        fresh = fresh.join(others.select("source_file").distinct(), "source_file", "left_anti")
    write_bronze(store, fresh.select(*schemas.BRONZE_TABLE.names))
    note_landed(store)
    return store.read(BRONZE).where(F.col("ingest_batch") == batch)


def stream_bronze(
    lines: DataFrame, store: LayerStore, checkpoint: str, clean: Callable = X.clean_strict
) -> None:
    """Clean landed lines and append them to bronze; a file counts once."""
    drain(clean(lines), checkpoint, lambda rows, batch: take_batch(store, rows, batch))


def arrivals(spark: SparkSession, landing: str, fmt: str = "csv") -> DataFrame:
    """Landed files: path, name, size, modification time, rows."""
    reader = spark.read
    if fmt == "csv":
        reader = reader.schema(schemas.SOURCE_FILE).option("header", True)
    m = "_metadata."
    return (
        reader.format(fmt)
        .load(landing)
        .groupBy(
            F.col(m + "file_path").alias("file_path"),
            F.col(m + "file_name").alias("file_name"),
            F.col(m + "file_size").alias("file_size"),
            F.col(m + "file_modification_time").alias("modified_at"),
        )
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def touched_months(rows: DataFrame) -> list[Row]:
    """Months of dated bronze rows: storage folders, bounded by the calendar."""
    return rows.where(F.col("invoicedate").isNotNull()).select("invoice_month").distinct().collect()


def refresh_batch(store: LayerStore, rows: DataFrame, batch: str) -> None:
    """Take one batch of cleaned lines through bronze, silver and the monthly mart.

    Only months the batch touches are recomputed, from all their lines; new dates
    and products are added, product ids never change.
    """
    touched = touched_months(take_batch(store, rows, batch))
    if not touched:
        return
    months = [(int(r[0][:4]), int(r[0][5:])) for r in touched]
    lines = store.read(BRONZE).where(in_partitions(touched, ["invoice_month"]))

    # append what is new: a replayed batch finds nothing new
    known = store.read_or_empty("silver.dim_date")
    fresh = silver.dim_date(lines).join(known, "date_id", "left_anti")
    store.append(fresh.select(*known.columns).coalesce(1), "silver.dim_date")
    products = store.read_or_empty("silver.dim_product")
    fresh = silver.extend_dim_product(products, lines)
    if not store.exists("silver.dim_product") or not fresh.isEmpty():
        store.append(fresh, "silver.dim_product")
    dates, products = store.read("silver.dim_date"), store.read("silver.dim_product")
    store.overwrite_partitions(
        silver.fact_sales_daily(lines, dates, products), "silver.fact_sales_daily"
    )
    frame = store.spark.createDataFrame(months, "year int, month int")
    monthly.mark(store, frame, L.rules.IN_PROGRESS)
    monthly.recompute(store, months)
    monthly.mark(store, frame, L.rules.COMPLETED)


def refresh_touched_months(
    store: LayerStore, lines: DataFrame, checkpoint: str, clean: Callable = X.clean_strict
) -> None:
    """Run ``refresh_batch`` for every micro-batch of landed files."""
    drain(clean(lines), checkpoint, lambda rows, batch: refresh_batch(store, rows, batch))
