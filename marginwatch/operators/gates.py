"""Reconciliation gates: every layer against the one before it.

Each gate is a one-row frame (layer, check_name, severity, observed, expected, tolerance,
message); `judge` turns the union into PASS / FAIL / WARN.
"""
from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.among import may_hold, repeated
from .model import FACTS

STAGES_WATCHED = ["ingest", "clean", "transform", "load"]


def _gate(one_row: DataFrame, layer: str, name: str, observed: Column, expected: Column, severity: str = "CRITICAL",
          tolerance: float = 0.0, message: Column | None = None) -> DataFrame:
    def num(c: Column) -> Column:
        return F.coalesce(c.cast("double"), F.lit(0.0))
    text = F.concat(F.lit("observed "), observed.cast("string"), F.lit(" vs expected "), expected.cast("string"))
    return one_row.select(F.lit(layer).alias("layer"), F.lit(name).alias("check_name"), F.lit(severity).alias("severity"),
                          num(observed).alias("observed"), num(expected).alias("expected"),
                          F.lit(float(tolerance)).alias("tolerance"),
                          F.coalesce(text if message is None else message, F.lit("")).alias("message"))


def judge(gates: DataFrame) -> DataFrame:
    ok = F.abs(F.col("observed") - F.col("expected")) <= F.col("tolerance")
    return gates.withColumn("status", F.when(ok, "PASS").when(F.col("severity") == "CRITICAL", "FAIL").otherwise("WARN")).select(
        "layer", "check_name", "severity", "status", "observed", "expected", "message")


def enforce(gates: DataFrame) -> None:
    """Raise when a CRITICAL gate failed. Call after the results are stored."""
    failed = gates.where("status = 'FAIL' and severity = 'CRITICAL'").select("check_name", "message").collect()
    if failed:
        raise RuntimeError("Critical data-quality checks failed: " + ", ".join(f"{r.check_name} ({r.message})" for r in failed))


HISTORY = "run_id string, checked_at timestamp, layer string, check_name string, severity string, status string, observed double, expected double, message string"


def settle(gates: DataFrame, history: str, run_id: str, now: datetime) -> DataFrame:
    """A stored step: the results are appended to the gate history, and only then enforced, from what
    was stored. A run that fails is on record with what it saw; the gates are evaluated once."""
    spark = gates.sparkSession
    stamped = gates.select(F.lit(run_id).alias("run_id"), F.lit(now).cast("timestamp").alias("checked_at"), *gates.columns)
    stamped.coalesce(1).write.mode("append").parquet(history)
    stored = spark.read.schema(HISTORY).parquet(history).where(F.col("run_id") == run_id)
    enforce(stored)
    return stored


def gate_history(spark: SparkSession, history: str) -> DataFrame:
    return spark.read.schema(HISTORY).parquet(history)


# ------------------------------------------------------------------ landing
def landing_ranges(raw: DataFrame, planned: DataFrame | None = None) -> DataFrame:
    """Per topic partition: rows landed, distinct offsets, first and last offset, what was planned,
    and whether exactly that arrived, each offset once.

    `planned` has topic, kafka_partition, first_offset and last_offset of the range to be read; a
    partition of it that landed nothing is incomplete. Without it the landed offsets are the range,
    so that only gaps and repeats inside it show.
    """
    keys = ["topic", "kafka_partition"]
    offsets = raw.groupBy(*keys, "kafka_offset").agg(F.count(F.lit(1)).alias("_n"))
    seen = offsets.groupBy(*keys).agg(F.sum("_n").alias("landed"), F.count(F.lit(1)).alias("distinct_offsets"),
                                      F.min("kafka_offset").alias("first_offset"), F.max("kafka_offset").alias("last_offset"))
    if planned is None:
        ranged = seen.withColumns({"_from": F.col("first_offset"), "_to": F.col("last_offset")})
    else:
        plan = planned.select(*keys, F.col("first_offset").alias("_from"), F.col("last_offset").alias("_to"))
        ranged = plan.join(seen, keys, "full_outer").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("landed", "distinct_offsets")})
    expected = F.coalesce(F.col("_to") - F.col("_from") + 1, F.lit(0))
    whole = (F.col("landed") == expected) & (F.col("distinct_offsets") == expected) & (
        (expected == 0) | (F.col("first_offset") == F.col("_from")) & (F.col("last_offset") == F.col("_to")))
    return ranged.withColumn("expected", expected).withColumn("complete", F.coalesce(whole, F.lit(False))).drop("_from", "_to")


def ingest_lag(ranges: DataFrame, watermarks: DataFrame) -> DataFrame:
    """One row: landed, what the committed offsets imply, messages not consumed yet.
    `watermarks` has topic, kafka_partition, low, high, committed (null when never read)."""
    committed = F.coalesce("committed", "low")
    return watermarks.join(ranges.select("topic", "kafka_partition", "landed"), ["topic", "kafka_partition"], "left").agg(
        F.coalesce(F.sum("landed"), F.lit(0)).alias("landed"), F.sum(committed - F.col("low")).alias("expected"),
        F.sum(F.greatest(F.col("high") - committed, F.lit(0))).alias("lag")).withColumn(
        "reconciled", F.col("landed") == F.col("expected"))


# ------------------------------------------------------------------ gate sets
def _facts(facts: dict[str, DataFrame], *cols: Column | str) -> DataFrame:
    return reduce(DataFrame.unionByName, [facts[t].select(*cols) for t in FACTS])


def warehouse_gates(landing: DataFrame, account: DataFrame, failures: DataFrame, events: DataFrame, facts: dict[str, DataFrame],
                    dims: dict[str, DataFrame]) -> DataFrame:
    """The warehouse gates. `landing` has landed and expected messages per topic partition (see
    `landing_ranges`), `account` is the stored one-row accounting of the validation run."""
    ranges = landing.agg(F.sum("landed").alias("landed"), F.sum("expected").alias("committed"))
    rejects = (failures.where("disposition = 'REJECTED'").groupBy("kafka_topic", "kafka_partition", "kafka_offset")
               .agg(F.count(F.lit(1)).alias("c")).agg(F.count(F.lit(1)).alias("n")))
    stored = _facts(facts, F.lit(1).alias("x")).agg(F.count(F.lit(1)).alias("n"))
    # Hashes are counted across rows; only ids whose hash repeats are compared themselves.
    ids = _facts(facts, "event_id")
    doubtful = may_hold(ids, {"_may": "xxhash64(event_id)"}, repeated(ids, ["xxhash64(event_id)"])).where("_may")
    repeats = (doubtful.groupBy("event_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
               .agg(F.count(F.lit(1)).alias("n")))
    # Grouped to distinct keys first: a hot product or branch is one row in the joins.
    keys = _facts(facts, "branch_id", "product_id").groupBy("branch_id", "product_id").agg(F.count(F.lit(1)).alias("c"))
    known = (keys.join(dims["dim_branch"].select("branch_id", F.lit(1).alias("_b")), "branch_id", "left")
             .join(dims["dim_product"].select("product_id", F.lit(1).alias("_p")), "product_id", "left"))
    orphans = known.agg(F.coalesce(F.sum(F.when(F.col("_b").isNull() | F.col("_p").isNull(), F.col("c"))), F.lit(0)).alias("n"))
    sales = facts["fact_sales"].agg(
        F.max(F.abs(F.col("net_revenue") - F.col("cogs") - F.col("gross_profit"))).alias("d"),
        F.count_if((F.col("net_revenue") <= 0) | (F.col("quantity") <= 0)).alias("bad"),
        F.sum("net_revenue").alias("r"), F.sum("gross_profit").alias("p"))
    lake = events.where("event_type = 'SALE'").agg(F.sum("revenue").alias("r"), F.sum("profit").alias("p"))

    def single(df: DataFrame, col: str) -> Column:
        return df.select(col).scalar()

    w, zero = "warehouse", F.lit(0)
    gates = [
        _gate(ranges, w, "KAFKA_OFFSETS_EQUAL_RAW_MESSAGES", F.col("landed"), F.col("committed")),
        _gate(account, w, "RAW_EQUALS_CLEAN_PLUS_REJECTED", F.col("raw"), F.col("accepted") + F.col("rejected")),
        _gate(ranges, w, "RAW_MESSAGES_EQUAL_KAFKA", F.col("landed"), single(account, "raw")),
        _gate(rejects, w, "QUARANTINE_HOLDS_EVERY_REJECT", F.col("n"), single(account, "rejected")),
        _gate(stored, w, "WAREHOUSE_FACTS_EQUAL_ACCEPTED_EVENTS", F.col("n"), single(account, "accepted")),
        _gate(repeats, w, "EVENT_IN_ONE_FACT_ONLY", F.col("n"), zero),
        _gate(orphans, w, "NO_ORPHAN_FACTS", F.col("n"), zero),
        _gate(sales, w, "SALES_PROFIT_IDENTITY", F.coalesce("d", zero), zero, tolerance=0.02),
        _gate(sales, w, "SALES_ARE_POSITIVE", F.col("bad"), zero),
        _gate(sales, w, "SALES_REVENUE_CHECKSUM_LAKE_VS_WAREHOUSE", F.col("r"), single(lake, "r"), tolerance=0.5),
        _gate(sales, w, "SALES_PROFIT_CHECKSUM_LAKE_VS_WAREHOUSE", F.col("p"), single(lake, "p"), tolerance=0.5),
    ]
    return judge(reduce(DataFrame.unionByName, gates))


def freshness_gates(runs: DataFrame, now: datetime, max_days: int = 2) -> DataFrame:
    """J12-J15: last success of each watched stage no older than `max_days` (INFO, never fails)."""
    spark: SparkSession = runs.sparkSession
    last = runs.where("status = 'SUCCESS'").groupBy("stage").agg(F.max("finished_at").alias("finished_at"))
    names = spark.createDataFrame([(s,) for s in STAGES_WATCHED], "stage string")
    fresh = F.col("finished_at") >= F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {int(max_days)} DAYS")
    return names.join(last, "stage", "left").select(
        F.lit("warehouse").alias("layer"), F.concat(F.lit("FRESH_"), F.upper("stage"), F.lit("_RUN")).alias("check_name"),
        F.lit("INFO").alias("severity"), F.when(fresh, "PASS").otherwise("WARN").alias("status"),
        F.lit(None).cast("double").alias("observed"), F.lit(None).cast("double").alias("expected"),
        F.concat(F.lit("last successful "), "stage", F.lit(": "), F.coalesce(F.col("finished_at").cast("string"), F.lit("never"))).alias("message"))


def analytics_gates(facts: dict[str, DataFrame], published: dict[str, DataFrame]) -> DataFrame:
    """J16-J22. `published`: kpi_summary, company_monthly, branch_scorecard, anomalies, revenue_leakage."""
    a, zero = "analytics", F.lit(0)
    core = facts["fact_sales"].agg(F.sum("net_revenue").alias("r"), F.sum("gross_profit").alias("p"))
    revenue, profit = core.select("r").scalar(), core.select("p").scalar()
    kpi = published["kpi_summary"].agg(
        F.max(F.when(F.col("kpi_key") == "net_revenue", F.col("value_numeric"))).alias("r"),
        F.max(F.when(F.col("kpi_key") == "gross_profit", F.col("value_numeric"))).alias("p"))
    monthly = published["company_monthly"].agg(F.sum("net_revenue").alias("r"))
    branches = published["branch_scorecard"].agg(
        F.sum("net_revenue").alias("r"), F.count_if(F.col("performance_score").isNull()).alias("nulls"))
    mute = published["anomalies"].agg(F.count_if(F.col("explanation").isNull() | (F.length("explanation") < 40)).alias("n"))
    leak = published["revenue_leakage"].agg(F.coalesce(F.sum("exposure_amount"), zero).alias("e"))
    judged = judge(reduce(DataFrame.unionByName, [
        _gate(kpi, a, "KPI_REVENUE_EQUALS_WAREHOUSE", F.col("r"), revenue, tolerance=1.0),
        _gate(kpi, a, "KPI_PROFIT_EQUALS_WAREHOUSE", F.col("p"), profit, tolerance=1.0),
        _gate(monthly, a, "MONTHLY_SERIES_EQUALS_WAREHOUSE", F.col("r"), revenue, tolerance=1.0),
        _gate(branches, a, "BRANCH_SCORECARD_EQUALS_WAREHOUSE", F.col("r"), revenue, tolerance=1.0),
        _gate(mute, a, "EVERY_ANOMALY_HAS_AN_EXPLANATION", F.col("n"), zero),
        _gate(branches, a, "BRANCH_SCORES_COMPLETE", F.col("nulls"), zero),
    ]))
    info = leak.select(
        F.lit(a).alias("layer"), F.lit("LEAKAGE_EXPOSURE_RECORDED").alias("check_name"), F.lit("INFO").alias("severity"),
        F.lit("PASS").alias("status"), F.col("e").cast("double").alias("observed"), F.lit(None).cast("double").alias("expected"),
        F.concat(F.lit("identified exposure "), F.format_number(F.col("e").cast("double"), 0)).alias("message"))
    return judged.unionByName(info)


def source_totals(source: DataFrame) -> DataFrame:
    """One row recomputed from the source columns alone: rows, sale totals, refunds, and the
    naive all-row totals that must not be used as revenue."""
    sale, back = F.col("event_type") == "SALE", F.col("event_type") == "RETURN"
    def total(col: str, where: Column | None = None) -> Column:
        c = F.col(col).try_cast("decimal(20,4)")
        return F.sum(c if where is None else F.when(where, c))
    return source.agg(
        F.count(F.lit(1)).alias("rows"), total("revenue", sale).alias("sales_revenue"), total("profit", sale).alias("sales_profit"),
        total("quantity", sale).alias("sales_units"), total("revenue", back).alias("return_value"),
        total("revenue").alias("naive_revenue_all_rows"), total("profit").alias("naive_profit_all_rows"))


def source_vs_facts(source: DataFrame, facts: dict[str, DataFrame], fact_of_type: dict[str, str]) -> DataFrame:
    """Rows of each type in the source against the rows of its fact table."""
    fact = F.coalesce(*[F.when(F.col("event_type") == t, F.lit(f)) for t, f in fact_of_type.items()])
    src = source.where(fact.isNotNull()).groupBy(fact.alias("fact")).agg(F.count(F.lit(1)).alias("source_rows"))
    stored = reduce(DataFrame.unionByName, [
        facts[t].agg(F.count(F.lit(1)).alias("fact_rows")).withColumn("fact", F.lit(t)) for t in FACTS])
    n = F.coalesce("source_rows", F.lit(0))
    return stored.join(src, "fact", "left").select("fact", n.alias("source_rows"), "fact_rows", (n == F.col("fact_rows")).alias("match"))
