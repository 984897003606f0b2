"""Registered queries: operators over a test-data folder.

Every entry takes (spark, sf_dir). Results leave through ``plain``, so that they
compare with another engine: decimals as doubles, integers as BIGINT, dates and
times as ISO text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillworks import schemas
from tillworks.functions import columns as C
from tillworks.functions import rules
from tillworks.operators import customer_marts as CM
from tillworks.operators import ledger as L
from tillworks.operators import merge, oplog, quality, silver
from tillworks.operators import reports as R
from tillworks.operators import sales_marts as SM
from tillworks.plans import medallion, monthly, workspace
from tillworks.sources import layers, workbooks
from tillworks.sources import transactions as X
from tillworks.sources.layers import LayerStore, write_bronze
from tillworks.sources.testdata import bronze_lines, raw_lines, table
from tillworks.streaming import daily as stream_daily
from tillworks.streaming import landing

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2001-08-02"  # day after the last order
EVENTS_NOW = "2024-02-01 00:00:00"  # after the last event

_QUERIES: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """Types another engine shares; decimals of more than two places keep six."""
    out = []
    for f in df.schema.fields:
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, T.DecimalType):
            c = (F.round(c, 6) if t.scale > 6 else c).cast("double")
        elif isinstance(t, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(fn: Query) -> Query:
    """Register under the function's name."""
    _QUERIES[fn.__name__] = lambda spark, sf_dir: plain(fn(spark, sf_dir))
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- ingest and bronze ------------------------------------------------------


@query
def clean_strict(spark, sf_dir):
    return X.clean_strict(raw_lines(spark, sf_dir, defects=True))


@query
def clean_lenient(spark, sf_dir):
    return X.clean_lenient(raw_lines(spark, sf_dir, defects=False))


@query
def clean_report(spark, sf_dir):
    return X.cleaning_report(raw_lines(spark, sf_dir, defects=True))


@query
def ingest_check(spark, sf_dir):
    cleaned = X.clean_strict(raw_lines(spark, sf_dir, defects=True))
    return R.ingest_count_check(cleaned, table(spark, sf_dir, "lineitem"))


@query
def bronze_summary(spark, sf_dir):
    return R.bronze_summary(workspace.bronze(spark, sf_dir))


@query
def bronze_revenue_by_country(spark, sf_dir):
    return R.bronze_revenue_by_country(bronze_lines(spark, sf_dir))


@query
def bronze_top_products(spark, sf_dir):
    return R.bronze_top_products(bronze_lines(spark, sf_dir))


@query
def bronze_daily_volume(spark, sf_dir):
    return R.bronze_daily_volume(bronze_lines(spark, sf_dir))


@query
def bronze_customer_analysis(spark, sf_dir):
    return R.bronze_customer_analysis(bronze_lines(spark, sf_dir))


@query
def cancellations_by_month(spark, sf_dir):
    return R.cancellations_by_month(bronze_lines(spark, sf_dir))


# --- silver -----------------------------------------------------------------


@query
def dim_date(spark, sf_dir):
    return silver.dim_date(bronze_lines(spark, sf_dir))


@query
def dim_product(spark, sf_dir):
    return silver.dim_product(bronze_lines(spark, sf_dir))


@query
def dim_product_extended(spark, sf_dir):
    """The dimension of the codes before 'PROMO' with other descriptions, then extended by the others."""
    lines = bronze_lines(spark, sf_dir)
    known = silver.dim_product(lines.where(F.col("stockcode") < "PROMO"))
    known = known.withColumn("description", F.concat(F.lit("kept "), "description"))
    return known.unionByName(silver.extend_dim_product(known, lines))


@query
def product_category(spark, sf_dir):
    """Products per category."""
    codes = bronze_lines(spark, sf_dir).select("stockcode").distinct()
    return codes.groupBy(C.product_category("stockcode").alias("category")).agg(
        F.count(F.lit(1)).alias("products")
    )


@query
def customer_ids(spark, sf_dir):
    """Lines per parsed customer id, -1 for the missing."""
    return (
        bronze_lines(spark, sf_dir)
        .groupBy(C.parse_customer_id("customerid").alias("customer_id"))
        .agg(F.count(F.lit(1)).alias("line_count"))
    )


@query
def fact_sales_daily(spark, sf_dir):
    """Out of the lines, over the stored dimensions."""
    dates, products = workspace.dimensions(spark, sf_dir)
    return silver.fact_sales_daily(bronze_lines(spark, sf_dir), dates, products)


@query
def fact_upsert(spark, sf_dir):
    """Facts of 2001 corrected, and a second country's worth of them added."""
    fact = workspace.silver(spark, sf_dir)["fact_sales_daily"]
    late = fact.where(F.col("year") == 2001).withColumn(
        "total_quantity", F.col("total_quantity") * 2
    )
    moved = late.withColumn("country", F.concat("country", F.lit(" (new)")))
    return merge.upsert(fact, late.unionByName(moved), silver.FACT_KEYS)


@query
def silver_metrics(spark, sf_dir):
    t = workspace.silver(spark, sf_dir)
    return R.silver_metrics(t["fact_sales_daily"], t["dim_date"], t["dim_product"])


@query
def layer_row_counts(spark, sf_dir):
    t = workspace.silver(spark, sf_dir)
    summary = SM.monthly_sales_summary(t["fact_sales_daily"], t["dim_date"])
    named = {"bronze.raw_transactions": workspace.bronze(spark, sf_dir)}
    named |= {f"silver.{n}": df for n, df in t.items()}
    return R.layer_row_counts(named | {"gold.monthly_sales_summary": summary})


# --- gold -------------------------------------------------------------------


def _gold(name: str) -> Query:
    return lambda spark, sf_dir: medallion.gold_models(AS_OF)[name](
        workspace.silver(spark, sf_dir)
    )


def _register_gold(key: str, model: str) -> None:
    build = _gold(model)
    _QUERIES[key] = lambda spark, sf_dir: plain(build(spark, sf_dir))


_register_gold("gold_sales_monthly", "fact_sales_monthly")
_register_gold("gold_product_performance", "fact_product_performance")
_register_gold("gold_country_sales", "fact_country_sales")
_register_gold("gold_daily_trend", "fact_sales_daily_enhanced")
for _mart in [
    "monthly_sales_summary", "top_products_by_revenue", "country_performance",
    "customer_lifetime_value", "customer_monthly_activity", "customer_product_affinity",
]:
    _register_gold(_mart, _mart)


def _fact_dates(spark, sf_dir):
    t = workspace.silver(spark, sf_dir)
    return t["fact_sales_daily"], t["dim_date"]


@query
def gold_daily_enhanced(spark, sf_dir):
    return SM.sales_daily_enhanced(*_fact_dates(spark, sf_dir))


@query
def top_product_per_country(spark, sf_dir):
    return SM.top_product_per_country(_fact_dates(spark, sf_dir)[0])


@query
def country_unique_customers_incl_unknown(spark, sf_dir):
    sales = SM.country_sales(*_fact_dates(spark, sf_dir), count_unknown=True)
    return sales.select("country", "unique_customers")


@query
def customer_primary_country(spark, sf_dir):
    return CM.primary_country(_fact_dates(spark, sf_dir)[0])


@query
def customer_segment_counts(spark, sf_dir):
    return CM.customer_segment_counts(_gold("customer_lifetime_value")(spark, sf_dir))


@query
def customer_recency_counts(spark, sf_dir):
    return CM.customer_recency_counts(_gold("customer_lifetime_value")(spark, sf_dir))


@query
def affinity_level_counts(spark, sf_dir):
    return CM.affinity_level_counts(_gold("customer_product_affinity")(spark, sf_dir))


# --- published listings -----------------------------------------------------


@query
def silver_daily_rollup(spark, sf_dir):
    return R.silver_daily_rollup(*_fact_dates(spark, sf_dir))


@query
def silver_top_products(spark, sf_dir):
    t = workspace.silver(spark, sf_dir)
    return R.silver_top_products(t["fact_sales_daily"], t["dim_product"])


@query
def silver_daily_revenue(spark, sf_dir):
    return R.silver_daily_revenue(*_fact_dates(spark, sf_dir))


@query
def silver_revenue_by_country(spark, sf_dir):
    return R.silver_revenue_by_country(_fact_dates(spark, sf_dir)[0])


@query
def gold_weekday_analysis(spark, sf_dir):
    fact, dates = _fact_dates(spark, sf_dir)
    return R.gold_weekday_analysis(SM.sales_daily_enhanced(fact, dates), dates)


@query
def gold_month_name_revenue(spark, sf_dir):
    fact, dates = _fact_dates(spark, sf_dir)
    return R.gold_month_name_revenue(SM.sales_monthly(fact, dates), dates)


@query
def gold_monthly_trend(spark, sf_dir):
    return R.gold_monthly_trend(_gold("fact_sales_monthly")(spark, sf_dir))


@query
def gold_latest_months(spark, sf_dir):
    return R.gold_latest_months(_gold("fact_sales_monthly")(spark, sf_dir))


@query
def gold_top10_products(spark, sf_dir):
    return R.gold_top10_products(_gold("fact_product_performance")(spark, sf_dir))


@query
def gold_country_ranking(spark, sf_dir):
    return R.gold_country_ranking(_gold("fact_country_sales")(spark, sf_dir))


@query
def gold_daily_trend_30(spark, sf_dir):
    return R.gold_daily_trend_30(_gold("fact_sales_daily_enhanced")(spark, sf_dir))


@query
def gold_product_listing(spark, sf_dir):
    return R.gold_product_listing(_gold("fact_product_performance")(spark, sf_dir))


@query
def gold_country_listing(spark, sf_dir):
    return R.gold_country_listing(_gold("fact_country_sales")(spark, sf_dir))


@query
def gold_latest_days(spark, sf_dir):
    return R.gold_latest_days(_gold("fact_sales_daily_enhanced")(spark, sf_dir))


# --- quality ----------------------------------------------------------------


def _suite(spark, sf_dir):
    t = workspace.silver(spark, sf_dir)
    marts = {n: m for n, m in workspace.gold(spark, sf_dir, AS_OF).items() if not n.startswith("fact_")}
    return quality.suite({"raw_transactions": workspace.bronze(spark, sf_dir)} | t | marts)


@query
def dq_suite(spark, sf_dir):
    return _suite(spark, sf_dir)


@query
def dq_summary(spark, sf_dir):
    return quality.summarize(_suite(spark, sf_dir))


@query
def dq_failures(spark, sf_dir):
    """Checks that find something: prices of the uncleaned lines, event fields."""
    lines = raw_lines(spark, sf_dir, defects=True)
    raw = X.normalize_columns(lines)
    events = table(spark, sf_dir, "events")
    results = [
        quality.table_checks(
            raw, "raw",
            [quality.not_null(c) for c in ["invoiceno", "description", "customerid"]]
            + [quality.in_range("unitprice", rules.MIN_PRICE, rules.MAX_PRICE)]
            + [quality.max_length("stockcode", 12), quality.customer_parses("customerid")],
        ),
        quality.table_checks(
            events, "events",
            [quality.accepted_values("event_type", ["view", "click"]), quality.has_rows(),
             quality.positive_total("value"), quality.date_bounds("ts")],
        ),
        quality.unique(events, "events", ["user_id", "event_type"]),
        quality.relationships(
            events, "events", "user_id", table(spark, sf_dir, "supplier"), "s_suppkey"
        ),
        quality.columns_match(lines, "raw", schemas.SOURCE_FILE.names),
    ]
    return quality.union_checks(results)


@query
def reconcile_layers(spark, sf_dir):
    fact = workspace.silver(spark, sf_dir)["fact_sales_daily"]
    return quality.reconcile_layers(workspace.bronze(spark, sf_dir), fact)


@query
def freshness(spark, sf_dir):
    return quality.freshness(table(spark, sf_dir, "events"), "ts", EVENTS_NOW)


# --- incremental processing -------------------------------------------------


def _ledger(spark, sf_dir):
    """Months with orders and a status by quarter month; the third is not entered."""
    months = table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    ).distinct()
    place = F.col("month") % 3
    status = F.when(place == 1, rules.COMPLETED).when(place == 2, rules.IN_PROGRESS)
    return months.select(
        C.month_key("year", "month").alias("month_key"), "year", "month", status.alias("status")
    ).where("status IS NOT NULL")


@query
def distinct_months(spark, sf_dir):
    return L.distinct_months(_fact_dates(spark, sf_dir)[0])


@query
def pending_months(spark, sf_dir):
    months = L.distinct_months(_fact_dates(spark, sf_dir)[0])
    return L.pending_months(months, _ledger(spark, sf_dir))


@query
def mark_months(spark, sf_dir):
    """The ledger after every pending month was completed."""
    months = L.distinct_months(_fact_dates(spark, sf_dir)[0])
    ledger = _ledger(spark, sf_dir).select(
        "*", *[
            F.lit(None).cast(f.dataType).alias(f.name)
            for f in schemas.PROCESSED_MONTHS.fields
            if f.name in ("processed_at", "updated_at", "metadata")
        ]
    )
    todo = L.pending_months(months, ledger)
    marked = L.mark_months(ledger, todo, rules.COMPLETED)
    return marked.select("month_key", "year", "month", "status")


@query
def recompute_month(spark, sf_dir):
    """Every month rebuilt from the fact, counting the unknown customer."""
    fact, dates = _fact_dates(spark, sf_dir)
    months = [tuple(r) for r in L.distinct_months(fact).collect()]  # calendar-bounded
    return L.recompute_months(fact, dates, months)


@query
def upsert_monthly(spark, sf_dir):
    """Monthly rows up to 1999, replaced and extended by rows from 1999 on."""
    fact, dates = _fact_dates(spark, sf_dir)
    old = SM.sales_monthly(fact, dates, count_unknown=True).where("year <= 1999")
    return merge.upsert(
        old, SM.sales_monthly(fact, dates).where("year >= 1999"), ["year", "month"]
    )


@query
def rebuild_month(spark, sf_dir):
    """Monthly sums out of daily product and country rows."""
    t = workspace.silver(spark, sf_dir)
    daily_rows = (
        t["fact_sales_daily"]
        .join(t["dim_date"].select("date_id", "date"), "date_id")
        .select(
            F.col("date").alias("date_id"), "product_id", "country",
            F.col("total_revenue").alias("total_sales"), "total_quantity",
            F.col("total_transactions").alias("transaction_count"),
        )
    )
    return L.rebuild_months_from_daily(daily_rows)


@query
def duplicate_months(spark, sf_dir):
    """Months that the facts of each country enter again."""
    rows = _fact_dates(spark, sf_dir)[0].select("year", "month", "country").distinct()
    return merge.find_duplicate_keys(rows, ["year", "month"])


@query
def dedupe_keep_latest(spark, sf_dir):
    """Newest event of every user."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return merge.keep_latest(events, ["user_id"], ["ts", "event_id"])


# --- ledgers and logs out of events -----------------------------------------


def _log_rows(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select(
        F.col("ts").alias("timestamp"),
        F.col("event_type").alias("level"),
        F.lit("events").alias("pipeline_name"),
        F.col("user_id").cast("string").alias("run_id"),
        F.col("props").alias("metadata"),
    )


@query
def log_level_counts(spark, sf_dir):
    return oplog.logs_by_level(_log_rows(spark, sf_dir))


@query
def log_coverage(spark, sf_dir):
    return oplog.log_coverage(_log_rows(spark, sf_dir))


@query
def checkpoint_latest(spark, sf_dir):
    """Last value of every (run, stage) checkpoint."""
    events = table(spark, sf_dir, "events").select(
        F.lit("events").alias("pipeline_name"),
        F.col("user_id").cast("string").alias("run_id"),
        F.col("event_type").alias("stage"),
        F.lit("value").alias("checkpoint_key"),
        F.col("value").cast("string").alias("checkpoint_value"),
        "ts",
        "event_id",
    )
    return merge.keep_latest(events, L.CHECKPOINT_KEY, ["ts", "event_id"]).drop("ts")


def _event_ledger(spark, sf_dir):
    """Ledger rows out of events, damaged in the three ways a ledger can be."""
    kind, value = F.col("event_type"), F.col("value")
    cut = F.expr("substring(props, 1, length(props) - 1)")
    status = (
        F.when(kind == "click", "invalid_status_corrupted")
        .when(kind == "view", rules.IN_PROGRESS)
        .when(kind == "signup", rules.FAILED)
        .otherwise(rules.COMPLETED)
    )
    return table(spark, sf_dir, "events").select(
        F.concat_ws("-", F.date_format("ts", "yyyy-MM"), F.col("event_id")).alias("month_key"),
        F.when(value >= 1.0, F.year("ts")).alias("year"),
        F.month("ts").alias("month"),
        status.alias("status"),
        F.when(kind == "error", cut).when(kind != "signup", F.col("props")).alias("metadata"),
    )


@query
def ledger_scan(spark, sf_dir):
    return L.scan_ledger(_event_ledger(spark, sf_dir))


@query
def ledger_repair(spark, sf_dir):
    """Healthy event rows plus every month with orders as recovered."""
    months = table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    ).distinct()
    ledger = _event_ledger(spark, sf_dir).select(
        "*", F.lit(None).cast("timestamp_ntz").alias("processed_at"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"),
    )
    repaired = L.repair_ledger(ledger, months)
    return repaired.select("month_key", "year", "month", "status", "metadata")


# --- files, stores and runs -------------------------------------------------


def _fresh_store(spark, purpose: str) -> LayerStore:
    return LayerStore(spark, workspace.fresh_folder(spark, purpose))


def _file_lines(spark, sf_dir):
    lines = raw_lines(spark, sf_dir, defects=True).toDF(*schemas.SOURCE_FILE.names)
    price = F.when(F.col("UnitPrice").isNotNull(), (F.col("UnitPrice") + 2000) % 10050 - 25)
    return lines.withColumn("UnitPrice", price)


@query
def read_transactions(spark, sf_dir):
    """Lines written as CSV and read back, most prices within the limits, cleaned strictly."""
    folder = workspace.fresh_folder(spark, "csv")
    _file_lines(spark, sf_dir).write.option("header", True).csv(folder)
    return X.clean_strict(X.read_transactions(spark, folder)).drop("source_file")


@query
def read_workbooks(spark, sf_dir):
    """The same lines written as spreadsheets and read back."""
    folder = workspace.fresh_folder(spark, "xlsx")
    workbooks.write_workbooks(_file_lines(spark, sf_dir), folder)
    lines = X.read_transactions(spark, folder, fmt="xlsx", sheets=workbooks.ALL)
    return X.clean_strict(lines).drop("source_file")


@query
def write_bronze_append(spark, sf_dir):
    """Two batches appended, the first of them twice."""
    store, lines = _fresh_store(spark, "bronze-append"), workspace.bronze(spark, sf_dir)
    returns, sales = lines.where("quantity < 0"), lines.where("quantity >= 0")
    for rows, batch in [(returns, "returns"), (sales, "sales"), (returns, "returns")]:
        write_bronze(store, X.bronze_rows(rows, batch))
    return store.read(landing.BRONZE).groupBy("ingest_batch").agg(
        F.count(F.lit(1)).alias("line_count"), C.count_sum("quantity").alias("total_quantity")
    )


@query
def write_bronze_overwrite(spark, sf_dir):
    """All lines, then only those until 1998 as a full refresh."""
    store, lines = _fresh_store(spark, "bronze-overwrite"), workspace.bronze(spark, sf_dir)
    write_bronze(store, X.bronze_rows(lines, "all"))
    write_bronze(store, X.bronze_rows(lines.where(F.year("invoicedate") <= 1998), "early"), "overwrite")
    return store.read(landing.BRONZE).groupBy("ingest_batch", "invoice_month").agg(
        F.count(F.lit(1)).alias("line_count")
    )


@query
def ensure_layers(spark, sf_dir):
    """Rows of every catalog table after all months went through the ledger's states."""
    fact = workspace.silver(spark, sf_dir)["fact_sales_daily"]
    store = _fresh_store(spark, "layers")
    store.ensure_layers()
    for status in [rules.IN_PROGRESS, rules.FAILED, rules.IN_PROGRESS, rules.COMPLETED]:
        monthly.mark(store, L.distinct_months(fact), status)
    return R.layer_row_counts({n: spark.table(n) for n in schemas.TABLES}, ordered=False)


@query
def write_table(spark, sf_dir):
    """The monthly summary as a managed table, read through the catalog."""
    rows = SM.monthly_sales_summary(*_fact_dates(spark, sf_dir))
    name = f"gold.monthly_summary_{uuid.uuid4().hex}"  # a warehouse may outlive its catalog
    layers.write_table(rows, name)
    return spark.table(name)


@query
def gold_row_counts(spark, sf_dir):
    gold = workspace.gold(spark, sf_dir, AS_OF)
    return R.layer_row_counts({f"gold.{n}": df for n, df in gold.items() if n.startswith("fact_")})


@query
def stage_checkpoints(spark, sf_dir):
    """A stage per event type, the second run of which finds its rows counted."""
    kinds = table(spark, sf_dir, "events").groupBy("event_type").count().collect()  # five types
    store, name = _fresh_store(spark, "checkpoints"), monthly.CHECKPOINTS
    for kind, n in sorted(tuple(k) for k in kinds * 2):
        key = ("events", "run-1", kind, "rows")
        if L.get_checkpoint(store.read_or_empty(name), key) == str(n):
            continue  # the second time it is done already
        store.replace(L.start_stage(store.read_or_empty(name), key), name)
        store.replace(L.set_checkpoint(store.read(name), key, str(n)), name)
    return store.read(name).select("pipeline_name", "run_id", "stage", "checkpoint_key", "checkpoint_value", "status")


@query
def recover_logs(spark, sf_dir):
    """Events as fallback JSON lines, those of errors cut short, recovered twice."""
    folder, store = workspace.fresh_folder(spark, "fallback"), _fresh_store(spark, "logs")
    entry = F.to_json(F.struct(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"), F.col("event_type").alias("level"),
        F.col("event_id").cast("string").alias("message"), F.lit("events").alias("pipeline_name"),
        F.col("user_id").cast("string").alias("run_id"),
    ))
    cut = F.when(F.col("event_type") == "error", F.expr("left(line, length(line) - 1)")).otherwise(F.col("line"))
    lines = table(spark, sf_dir, "events").withColumn("line", entry).select(cut.alias("value"))
    lines.write.text(folder)
    for _ in range(2):
        monthly.recover_logs(store, folder)
    return oplog.logs_by_level(store.read(monthly.LOGS))


@query
def processed_dates(spark, sf_dir):
    """First and last event day marked, the first one twice."""
    first, last = table(spark, sf_dir, "events").agg(
        F.min(F.to_date("ts")).cast("string"), F.max(F.to_date("ts")).cast("string")
    ).head()
    store, name = _fresh_store(spark, "dates"), "ops.processed_dates"
    for day, status in [(first, rules.IN_PROGRESS), (last, rules.FAILED), (first, rules.COMPLETED)]:
        store.replace(L.mark_date(store.read_or_empty(name), day, status), name)
    return store.read(name).select("date_value", "status")


@query
def reset_ledger(spark, sf_dir):
    """Rows of the month ledger before and after its reset."""
    store = _fresh_store(spark, "ledger")
    monthly.mark(store, L.distinct_months(workspace.silver(spark, sf_dir)["fact_sales_daily"]), rules.COMPLETED)
    before = store.read(monthly.MONTHS)
    monthly.reset_ledger(store)
    return R.layer_row_counts({"before": before, "after": store.read(monthly.MONTHS)})


@query
def dry_run(spark, sf_dir):
    """Months of 1998 that a run would take; nothing is written."""
    workspace.silver(spark, sf_dir)
    store = workspace.store_for(spark, sf_dir)
    months = monthly.refresh_months(store, year=1998, dry_run=True)  # calendar-bounded
    if store.exists(monthly.MONTHS):
        raise AssertionError("a dry run wrote the ledger")
    return spark.createDataFrame(months, "year int, month int")


@query
def pending_months_of_year(spark, sf_dir):
    months = L.distinct_months(_fact_dates(spark, sf_dir)[0])
    return L.pending_months(months, _ledger(spark, sf_dir), year=1998)


@query
def recompute_some_months(spark, sf_dir):
    """Spring of 1998 rebuilt in a table whose other months hold wrong sums."""
    fact, dates = _fact_dates(spark, sf_dir)
    store = _fresh_store(spark, "recompute")
    wrong = SM.sales_monthly(fact, dates).withColumn("total_quantity", F.lit(-1).cast("bigint"))
    store.replace(wrong, monthly.MONTHLY)
    months = [(1998, m) for m in (3, 4, 5)]
    store.upsert(L.recompute_months(fact, dates, months, False), monthly.MONTHLY, ["year", "month"])
    return store.read(monthly.MONTHLY).select("year", "month", "total_quantity", "total_revenue")


def _doubled(rows, name: str, condition: str, keys: list[str], spark):
    """Stored rows of which those under a condition are upserted with twice the quantity."""
    store = _fresh_store(spark, "upsert")
    store.replace(rows, name)
    store.upsert(rows.where(condition).withColumn("total_quantity", F.col("total_quantity") * 2), name, keys)
    return store.read(name)


@query
def upsert_products(spark, sf_dir):
    rows = workspace.gold(spark, sf_dir, AS_OF)["fact_product_performance"]
    rows = rows.select("product_id", "stock_code", "total_quantity", "total_revenue")
    return _doubled(rows, "gold.fact_product_performance", "product_id % 3 = 0", ["product_id"], spark)


@query
def upsert_countries(spark, sf_dir):
    rows = workspace.gold(spark, sf_dir, AS_OF)["fact_country_sales"]
    rows = rows.select("country", "total_quantity", "total_revenue")
    return _doubled(rows, "gold.fact_country_sales", "country < 'G'", ["country"], spark)


@query
def upsert_days(spark, sf_dir):
    rows = workspace.gold(spark, sf_dir, AS_OF)["fact_sales_daily_enhanced"]
    rows = rows.select("date_id", "total_quantity", "total_revenue")
    return _doubled(rows, "gold.fact_sales_daily_enhanced", "date_id >= 19980101", ["date_id"], spark)


@query
def customer_ids_rounded(spark, sf_dir):
    """Lines per customer id with half a number added, rounded as the numeric reading does."""
    text = F.concat(F.regexp_replace("customerid", "[.]0$", ""), F.lit(".5"))
    return (
        bronze_lines(spark, sf_dir)
        .groupBy(C.parse_customer_id(text, numeric=True).alias("customer_id"))
        .agg(F.count(F.lit(1)).alias("line_count"))
    )


# --- streams ----------------------------------------------------------------


def _line_stream(spark, sf_dir):
    """lineitem as a stream of landed files, joined to the static order tables."""
    schema = table(spark, sf_dir, "lineitem").schema
    landed = spark.readStream.schema(schema).parquet(f"{sf_dir}/lineitem.parque[t]")
    return bronze_lines(spark, sf_dir, landed)


@query
def stream_bronze(spark, sf_dir):
    """Landed lines in bronze, per month."""
    root = workspace.fresh_folder(spark, "stream-bronze")
    store = LayerStore(spark, root)
    landing.stream_bronze(_line_stream(spark, sf_dir), store, f"{root}-checkpoint")
    return (
        store.read(landing.BRONZE)
        .groupBy("invoice_month")
        .agg(
            F.count(F.lit(1)).alias("line_count"),
            C.count_sum("quantity").alias("total_quantity"),
            C.line_revenue().alias("total_revenue"),
        )
    )


@query
def arrivals(spark, sf_dir):
    files = landing.arrivals(spark, f"{sf_dir}/lineitem.parque[t]", "parquet")
    return files.select("file_name", "row_count", (F.col("file_size") > 0).alias("has_bytes"))


@query
def refresh_touched_months(spark, sf_dir):
    """Monthly rows after the landed lines went through every layer."""
    root = workspace.fresh_folder(spark, "stream-refresh")
    store = LayerStore(spark, root, count_unknown=True)
    landing.refresh_touched_months(store, _line_stream(spark, sf_dir), f"{root}-checkpoint")
    return store.read("gold.fact_sales_monthly")


@query
def stream_daily_sales(spark, sf_dir):
    """Daily sales of the landed lines."""
    root = workspace.fresh_folder(spark, "stream-daily")
    store = LayerStore(spark, root)
    stream_daily.stream_daily_sales(_line_stream(spark, sf_dir), store, f"{root}-checkpoint")
    return store.read(stream_daily.DAILY).drop("invoice_month")
