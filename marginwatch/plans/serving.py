"""Views and page queries over the published tables."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import order_stats, quantiles
from ..operators.detection import peer_points
from ..operators.finance import OPPORTUNITY

FLAGS = ["is_high_margin", "is_low_margin", "is_high_return", "is_high_discount", "is_declining", "is_problematic"]
SEGMENT_COLUMNS = ["product_id", "category", "supplier_id", "net_revenue", "gross_margin", "discount_rate", "return_rate_units",
                   "growth_rate", "sale_events", "margin_percentile", "problem_reasons", "anomaly_count"]


# ------------------------------------------------------------------ headline, leakage, anomalies
def executive_overview(kpi: DataFrame) -> DataFrame:
    return kpi.orderBy("sort_order")


def leakage_by_type(leak: DataFrame) -> DataFrame:
    return (leak.groupBy("leakage_type").agg(
        F.count(F.lit(1)).alias("findings"), F.sum("exposure_amount").alias("exposure_amount"),
        F.sum("annualised_exposure").alias("annualised_exposure"))
        .withColumn("kind", F.when(F.col("leakage_type") == OPPORTUNITY, "opportunity").otherwise("detected"))
        .orderBy(F.desc("exposure_amount")))


def anomaly_feed(anomalies: DataFrame, entity_type: str | None = None, leakage_only: bool = False,
                 limit: int | None = None) -> DataFrame:
    df = anomalies
    if entity_type:
        df = df.where(F.col("entity_type") == entity_type)
    if leakage_only:
        df = df.where(F.col("leakage_type").isNotNull())
    place = F.when(F.col("severity") == "critical", 1).when(F.col("severity") == "high", 2).otherwise(3)
    df = df.orderBy(place, F.desc_nulls_last("estimated_exposure"), "anomaly_id")
    return df.limit(limit) if limit else df


def peer_strip(features: dict[str, DataFrame], cfg: dict, check_id: str) -> DataFrame:
    """All eligible peers of one check with its median, scale and threshold."""
    one = {**cfg, "anomaly": {**cfg["anomaly"], "peer_checks": [c for c in cfg["anomaly"]["peer_checks"] if c["id"] == check_id]}}
    return peer_points(features, one)


def leakage_items(leak: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Findings with the first anomaly behind each of them."""
    a = anomalies.select("anomaly_id", "severity", "explanation", "check_id", "detection_method", "metric", "baseline_value",
                         "observed_value", F.col("entity_type").alias("anomaly_entity_type"))
    first = leak.withColumn("anomaly_id", F.split_part("source_anomaly_id", F.lit(";"), F.lit(1)))
    return first.join(a, "anomaly_id", "left").drop("anomaly_id").orderBy(F.desc("exposure_amount"))


def nav_counts(leak: DataFrame, inventory: DataFrame, anomalies: DataFrame, products: DataFrame, gates: DataFrame) -> DataFrame:
    parts = [
        ("leakage", leak, F.col("leakage_type") != OPPORTUNITY),
        ("inventory", inventory, (F.col("stockout_risk_level") == "high") | F.col("reorder_flag")),
        ("branches", anomalies, F.col("entity_type") == "branch"),
        ("suppliers", anomalies, F.col("entity_type") == "supplier"),
        ("products", products, F.col("is_problematic")),
        ("health", gates, F.col("status") == "FAIL"),
    ]
    return reduce(DataFrame.unionByName, [
        df.agg(F.count_if(cond).alias("n")).select(F.lit(page).alias("page"), "n") for page, df, cond in parts])


# ------------------------------------------------------------------ sales
def sales_detail(sales: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    d = dims["dim_date"].select("date_key", "full_date", "year_month", "year", "quarter")
    return (sales.join(d, "date_key").join(dims["dim_branch"].select("branch_id", "city"), "branch_id")
            .join(dims["dim_product"].select("product_id", "category", "supplier_id"), "product_id")
            .select("event_id", "event_ts", "full_date", "year_month", "year", "quarter", "branch_id", "city", "product_id",
                    "category", "supplier_id", "quantity", "unit_price", "discount_pct", "gross_sales", "discount_amount",
                    "net_revenue", "cogs", "gross_profit"))


def sales_statistics(sales: DataFrame) -> DataFrame:
    def share(cond: Column) -> Column:
        return F.try_divide(F.count_if(cond).cast("double"), F.count(F.lit(1)).cast("double"))
    d = F.col("discount_pct")
    return sales.agg(
        F.count(F.lit(1)).alias("events"), F.sum("quantity").alias("units"), F.sum("gross_sales").alias("gross"),
        F.sum("discount_amount").alias("disc"), F.sum("net_revenue").alias("rev"), F.sum("cogs").alias("cogs"),
        F.sum("gross_profit").alias("gp"),
        F.try_divide(F.sum("discount_pct").cast("double"), F.count(F.lit(1)).cast("double")).alias("avg_disc"),
        share(d > F.lit("0.2").cast("decimal(7,4)")).alias("share_over_20"), share(d == 0).alias("share_none"),
        F.max("discount_pct").alias("max_disc"), F.count_if(F.col("gross_profit") < 0).alias("loss_making"))


def returns_statistics(returns: DataFrame) -> DataFrame:
    return returns.agg(F.sum("quantity").alias("units"), F.sum("refund_value").alias("refund"), F.sum("profit_impact").alias("impact"),
                       F.count(F.lit(1)).alias("events"), F.count_if(~F.col("restockable")).alias("non_restockable"))


def purchases_statistics(purchases: DataFrame) -> DataFrame:
    return purchases.agg(F.sum("spend").alias("spend"), F.sum("price_variance_amount").alias("ppv"),
                         F.count_if("cost_above_list_price").alias("above_list"))


def movement_statistics(inventory_facts: DataFrame) -> DataFrame:
    return inventory_facts.groupBy("movement_type").agg(F.sum("quantity").alias("units"), F.sum("value_at_cost").alias("value"))


def year_on_year(company: DataFrame) -> DataFrame:
    """Each month against the row twelve places before it (one row a month, so the window is short)."""
    prior = F.lag("net_revenue", 12).over(Window.orderBy("year_month"))
    return company.select("year_month", "net_revenue", prior.alias("prior_year"),
                          (F.try_divide(F.col("net_revenue").cast("double"), prior.cast("double")) - 1).alias("yoy"))


# ------------------------------------------------------------------ inventory
def top_stockout(inventory: DataFrame, n: int = 25) -> DataFrame:
    return inventory.orderBy(F.desc("stockout_risk_score"), "product_id").limit(n).select(
        "product_id", "category", "supplier_id", "velocity_per_day", "replenishment_ratio", "days_since_last_purchase",
        "days_since_last_sale", "stockout_risk_score", "stockout_risk_level", "reorder_flag", "is_slow_moving", "is_dead_stock",
        "explanation")


def risk_levels(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy(F.col("stockout_risk_level").alias("level")).agg(F.count(F.lit(1)).alias("n"))


def slow_movers(inventory: DataFrame, n: int = 15) -> DataFrame:
    return inventory.where("is_slow_moving").orderBy(F.asc_nulls_first("velocity_per_day"), "product_id").limit(n).select(
        "product_id", "category", "velocity_per_day", "units_sold_recent", "days_since_last_sale")


def inventory_flags(inventory: DataFrame) -> DataFrame:
    return inventory.agg(F.count_if("reorder_flag").alias("reorder"), F.count_if("is_slow_moving").alias("slow"),
                         F.count_if("is_dead_stock").alias("dead"))


def coverage_matrix(branch_category: DataFrame, categories: list[str] | None = None) -> DataFrame:
    """branch_id and `cells`, a map of category to coverage, which is scaled 0..1 between the 5th and 95th index
    percentile of all cells and clipped. One aggregation, whatever the categories are: nothing looks for them
    first. With `categories` the map's entries are columns of these names instead."""
    cuts = quantiles(branch_category, "replenishment_ratio", {"lo": 0.05, "hi": 0.95}, kind="index")
    rows = branch_category.select("branch_id", "category", "replenishment_ratio").withColumns({c: cuts.select(c).scalar() for c in ("lo", "hi")})
    scaled = "least(1D, greatest(0D, (replenishment_ratio - lo) / if(hi = lo, 1D, hi - lo)))"
    cells = rows.groupBy("branch_id").agg(F.expr(f"map_from_entries(collect_list(struct(category, case when replenishment_ratio is not null then {scaled} end)))").alias("cells"))
    return cells if categories is None else cells.select("branch_id", *[F.col("cells")[c].alias(c) for c in categories])


def overall_coverage(movement_monthly: DataFrame) -> DataFrame:
    return movement_monthly.agg(F.try_divide(F.sum("units_purchased").cast("double"), F.sum("units_sold").cast("double")).alias("coverage"))


# ------------------------------------------------------------------ branches
def branch_ranking(scorecard: DataFrame) -> DataFrame:
    return scorecard.orderBy("performance_rank", "branch_id")


def branch_series(branch_monthly: DataFrame) -> DataFrame:
    return branch_monthly.select("branch_id", "year_month", "net_revenue", "gross_margin", "discount_rate", "return_rate_units").orderBy(
        "branch_id", "year_month")


def score_points(scorecard: DataFrame, cfg: dict) -> DataFrame:
    """Points each component adds to a branch's score."""
    items = [F.struct(F.lit(m).alias("component"), F.col(c["out"]).alias("score"), F.lit(float(c["weight"])).alias("weight"),
                      (F.col(c["out"]) * F.lit(float(c["weight"])) * 100).alias("points"))
             for m, c in cfg["branch_score"]["components"].items()]
    return scorecard.select("branch_id", F.explode(F.array(*items)).alias("i")).select("branch_id", "i.*")


def other_branches_median(branch_monthly: DataFrame, metric: str) -> DataFrame:
    """Per branch and month: the upper median of the metric over the other branches. Leaving one
    value out shifts the middle by at most one place, so each month needs two order statistics
    and no pair of branches is ever formed."""
    stats = order_stats(branch_monthly.select("year_month", metric), metric, ["year_month"])
    n, value = F.col("n"), F.col(metric)

    def at(pos: Column) -> Column:
        return F.max(F.when((F.col("less") <= pos) & (pos < F.col("less") + F.col("ties")), value))

    m = F.floor((n - 1) / 2)
    middle = stats.groupBy("year_month").agg(
        F.max("n").alias("_n"), at(m).alias("_low"), at(m + 1).alias("_high"), at(F.floor(n / 2)).alias("_all"))
    rows = branch_monthly.select("branch_id", "year_month", metric).join(middle, "year_month", "left")
    below = value <= F.col("_low")
    # Removing a value at or below place m moves the next one into it; the month's own missing
    # value leaves the list whole.
    other = F.when(value.isNull(), F.col("_all")).when(F.col("_n") > 1, F.when(below, F.col("_high")).otherwise(F.col("_low")))
    return rows.select("branch_id", "year_month", metric, other.alias("others_median"))


# ------------------------------------------------------------------ suppliers and products
def flagged_supplier_series(supplier_monthly: DataFrame, scorecard: DataFrame) -> DataFrame:
    flagged = scorecard.where("anomaly_count > 0").select("supplier_id")
    return (supplier_monthly.join(flagged, "supplier_id", "left_semi")
            .select("supplier_id", "year_month", "ppv_pct", "purchase_spend").orderBy("supplier_id", "year_month"))


def suppliers_above_standard(scorecard: DataFrame) -> DataFrame:
    above = F.col("ppv_amount") > 1
    return scorecard.agg(F.count_if(above).alias("above_standard"), F.count_if(~above).alias("at_standard"))


def product_segments(products: DataFrame) -> DataFrame:
    """Six top-k reports in one table."""
    spec = [("high_margin", "is_high_margin", [F.desc("gross_margin")], 12), ("low_margin", "is_low_margin", [F.asc("gross_margin")], 12),
            ("high_return", "is_high_return", [F.desc("return_rate_units")], 12),
            ("high_discount", "is_high_discount", [F.desc("discount_rate")], 12),
            ("declining", "is_declining", [F.asc("growth_rate")], 12),
            ("problematic", "is_problematic", [F.desc("anomaly_count"), F.desc("net_revenue")], 25)]
    return reduce(DataFrame.unionByName, [
        products.where(F.col(flag)).orderBy(*order, "product_id").limit(k).select(F.lit(name).alias("segment"), *SEGMENT_COLUMNS)
        for name, flag, order, k in spec])


def category_rollup(products: DataFrame) -> DataFrame:
    return products.groupBy("category").agg(
        F.count(F.lit(1)).alias("products"), F.sum("net_revenue").alias("net_revenue"),
        F.try_divide(F.sum("gross_profit").cast("double"), F.sum("net_revenue").cast("double")).alias("gross_margin"),
        F.try_divide(F.sum("return_units").cast("double"), F.sum("units_sold").cast("double")).alias("return_rate")).orderBy(
        F.desc("net_revenue"))


def segment_counts(products: DataFrame) -> DataFrame:
    return products.agg(*[F.count_if(F.col(f)).alias(f.removeprefix("is_")) for f in FLAGS], F.count(F.lit(1)).alias("total"))


# ------------------------------------------------------------------ operations
def latest_runs(runs: DataFrame) -> DataFrame:
    """Latest run of each stage with its duration."""
    cols = [c for c in runs.columns if c != "stage"]
    last = runs.groupBy("stage").agg(F.max_by(F.struct(*cols), F.struct("started_at", "run_id")).alias("r"))
    seconds = F.unix_micros("r.finished_at") - F.unix_micros("r.started_at")
    return last.select("stage", "r.status", "r.started_at", "r.finished_at", (seconds / 1e6).alias("duration_seconds"),
                       "r.rows_in", "r.rows_out", "r.rows_rejected", "r.error")


def latest_gates(results: DataFrame) -> DataFrame:
    cols = ["severity", "status", "observed", "expected", "message", "checked_at"]
    return results.groupBy("layer", "check_name").agg(F.max_by(F.struct(*cols), "checked_at").alias("r")).select(
        "layer", "check_name", "r.*")


def flow_funnel(encoded: DataFrame, raw: DataFrame, account: DataFrame, facts: dict[str, DataFrame]) -> DataFrame:
    """published -> landed -> accepted / rejected -> stored, one row each."""
    def n(df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n"))
    stored = reduce(DataFrame.unionByName, [t.select(F.lit(1).alias("x")) for t in facts.values()])
    parts = [("published", n(encoded)), ("landed", n(raw)), ("accepted", account.select(F.col("accepted").alias("n"))),
             ("rejected", account.select(F.col("rejected").alias("n"))), ("stored", n(stored))]
    return reduce(DataFrame.unionByName, [df.select(F.lit(s).alias("step"), F.col("n").cast("bigint").alias("n")) for s, df in parts])


def processing_seconds(latest: DataFrame) -> DataFrame:
    timed = ["ingest", "clean", "transform", "load", "features", "analytics", "publish_analytics"]      # fixed values
    return latest.where(F.col("stage").isin(timed)).agg(F.coalesce(F.sum("duration_seconds"), F.lit(0.0)).alias("seconds"))


def quarantine_samples(failures: DataFrame, n: int = 8) -> DataFrame:
    return (failures.where("disposition = 'REJECTED'").orderBy("kafka_timestamp", "kafka_topic", "kafka_partition", "kafka_offset", "rule_code")
            .limit(n).select("event_id", "rule_code", "detail", "kafka_topic", "disposition"))


def batch_history(raw: DataFrame) -> DataFrame:
    """Messages per landed batch and the running total (one row a batch)."""
    sums = raw.groupBy("ingest_batch").agg(F.count(F.lit(1)).alias("messages"))
    return sums.withColumn("cumulative", F.sum("messages").over(Window.orderBy("ingest_batch")))
