"""Every operator as a runnable query over the given tables, next to its independent SQL.

A query names its output columns with a kind letter; both engines' results are cast by it, so
that they can be compared value by value: s text, i bigint, d double to 6 decimals, b boolean,
t date or timestamp as text.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import EVENT_FIELDS, FACT_OF_TYPE, RULES
from ..functions.stats import order_stats, quantiles, with_baseline, with_pct_ranks, with_quantiles, with_robust_components
from ..operators import detection, features, finance, gates, model, scoring
from ..operators import validation as V
from ..sources import events as source
from ..sources import tables as T
from ..streaming import landing, ranges
from . import retail, serving
from .oracle import RULE_SQL, with_library
from .retail import CFG, NOW, RULES_CFG, Workspace


@dataclass(frozen=True)
class Query:
    columns: str
    run: Callable[[Workspace], DataFrame]
    sql: str | None

    def pairs(self) -> list[tuple[str, str]]:
        return [tuple(c.split(":")) for c in self.columns.split()]

    def spark(self, spark: SparkSession, data_dir: str) -> DataFrame:
        shape = {"s": "string({0}) as {0}", "t": "string({0}) as {0}", "i": "bigint({0}) as {0}", "b": "boolean({0}) as {0}",
                 "d": "round(double({0}), 6) + 0.0D as {0}"}
        return self.run(Workspace.of(spark, data_dir)).selectExpr(*[shape[k].format(f"`{c}`") for c, k in self.pairs()])

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        shape = {"s": "CAST({0} AS VARCHAR) AS {0}", "t": "CAST({0} AS VARCHAR) AS {0}", "i": "CAST({0} AS BIGINT) AS {0}",
                 "b": "CAST({0} AS BOOLEAN) AS {0}", "d": "round(CAST({0} AS DOUBLE), 6) + 0.0 AS {0}"}
        inner = self.sql if self.sql.lstrip().upper().startswith("SELECT") else f"SELECT * FROM {self.sql}"
        cols = ", ".join(shape[k].format(f'"{c}"') for c, k in self.pairs())
        return with_library(f"SELECT {cols} FROM ({inner}) AS q")


QUERIES: dict[str, Query] = {}


def add(name: str, columns: str, sql: str | None):
    def register(run: Callable[[Workspace], DataFrame]):
        QUERIES[name] = Query(columns, run, sql)
        return run
    return register


# ================================================================== sources, sinks, landing
LAKE_EVENTS = ("SELECT 'retail.events' AS topic, event_id % 4 AS kafka_partition, event_id // 4 AS kafka_offset, user_id AS key, event_type, ts FROM events")


def _event_messages(w: Workspace) -> DataFrame:
    return w.stage("event_messages", lambda: retail.event_messages(w.table("events")))


def _land(w: Workspace, out: str, checkpoint: str) -> None:
    _event_messages(w)
    stream = landing.message_stream(w.spark, {"format": "parquet", "path": f"{w.root}/event_messages"})
    query = landing.land(stream, out, checkpoint)
    query.awaitTermination()


def _landed(w: Workspace) -> DataFrame:
    """The events table landed once by the stream, then offered again: nothing new arrives."""
    if "landed" not in w.staged:
        base = f"{w.root}/landing-{uuid.uuid4().hex}"
        for _ in range(2):
            _land(w, f"{base}/raw", f"{base}/checkpoint")
        w.staged["landed"] = w.spark.read.parquet(f"{base}/raw")
    return w.staged["landed"]


@add("a01_incremental_event_read", "topic:s kafka_partition:i messages:i", f"SELECT topic, kafka_partition, count(*) AS messages FROM ({LAKE_EVENTS}) GROUP BY 1, 2")
def _(w): return _landed(w).groupBy("topic", "kafka_partition").agg(F.expr("count(1) as messages"))


@add("a02_raw_landing", "topic:s kafka_partition:i kafka_offset:i key:s event_type:s kafka_timestamp:t",
     f"SELECT topic, kafka_partition, kafka_offset, key, event_type, date_trunc('second', ts) AS kafka_timestamp FROM ({LAKE_EVENTS})")
def _(w): return _landed(w).selectExpr("topic", "kafka_partition", "kafka_offset", "key", "get_json_object(value, '$.event_type') as event_type",
                                       "cast(date_trunc('second', kafka_timestamp) as timestamp_ntz) as kafka_timestamp")


@add("a03_exactly_once_replay", "messages:i distinct_messages:i", "SELECT count(*) AS messages, count(DISTINCT event_id) AS distinct_messages FROM events")
def _(w):
    # A lost checkpoint replays every batch: each batch overwrites its own directory.
    base = f"{w.root}/replay-{uuid.uuid4().hex}"
    for attempt in ("first", "second"):
        _land(w, f"{base}/raw", f"{base}/checkpoint-{attempt}")
    per_message = w.spark.read.parquet(f"{base}/raw").groupBy("topic", "kafka_partition", "kafka_offset").agg(F.expr("count(1) as c"))
    return per_message.agg(F.expr("sum(c) as messages"), F.expr("count(1) as distinct_messages"))


@add("a04_landing_completeness", "topic:s kafka_partition:i landed:i first_offset:i last_offset:i expected:i complete:b",
     f"SELECT *, landed = expected AS complete FROM (SELECT topic, kafka_partition, count(*) AS landed, min(kafka_offset) AS first_offset, max(kafka_offset) AS last_offset, "
     f"max(kafka_offset) - min(kafka_offset) + 1 AS expected FROM ({LAKE_EVENTS}) GROUP BY 1, 2)")
def _(w): return gates.landing_ranges(_landed(w))


# A planned step reads a third of the longest topic partition.
STEP_ROWS = (f"(SELECT *, min(kafka_offset) OVER w AS low, max(kafka_offset) OVER w AS top, (SELECT max(n) + 2 FROM (SELECT max(kafka_offset) - min(kafka_offset) + 1 AS n FROM ({LAKE_EVENTS}) GROUP BY topic, kafka_partition)) // 3 AS step "
             f"FROM ({LAKE_EVENTS}) WINDOW w AS (PARTITION BY topic, kafka_partition))")


def _source(w: Workspace) -> dict:
    _event_messages(w)
    return {"format": "parquet", "path": f"{w.root}/event_messages"}


def _planned(w: Workspace, base: str, steps: int | None = None) -> None:
    ends = ranges.source_ends(w.spark, _source(w), ranges.commit_log(w.spark, f"{base}/log"))
    most = -(-ends.agg(F.max(F.col("high") - F.col("low"))).first()[0] // 3)
    while steps is None or steps > 0:
        if ranges.land_range(w.spark, _source(w), f"{base}/raw", f"{base}/log", most) is None:
            return
        steps = None if steps is None else steps - 1


def _planned_zone(w: Workspace) -> str:
    """The events table landed in planned steps to its end, with the directory of a step that never committed."""
    if "planned" not in w.paths:
        base = f"{w.root}/planned-{uuid.uuid4().hex}"
        _planned(w, base)
        _event_messages(w).selectExpr("*", "current_timestamp() as ingested_at").write.parquet(f"{base}/raw/ingest_batch=00009999")
        w.paths["planned"] = base
    return w.paths["planned"]


@add("a03_planned_steps", "ingest_batch:i topic:s kafka_partition:i first_offset:i last_offset:i landed:i",
     f"SELECT (kafka_offset - low) // step + 1 AS ingest_batch, topic, kafka_partition, min(kafka_offset) AS first_offset, max(kafka_offset) AS last_offset, count(*) AS landed FROM {STEP_ROWS} GROUP BY 1, 2, 3")
def _(w):
    # The first step is written and fails before its commit; the next attempt replaces its directory.
    base = f"{w.root}/steps-{uuid.uuid4().hex}"
    _event_messages(w).limit(10).selectExpr("*", "current_timestamp() as ingested_at").write.parquet(f"{base}/raw/ingest_batch=00000001")
    _planned(w, base)
    return ranges.registered_raw(w.spark, f"{base}/raw", f"{base}/log").groupBy("ingest_batch", "topic", "kafka_partition").agg(
        *map(F.expr, ["min(kafka_offset) as first_offset", "max(kafka_offset) as last_offset", "count(1) as landed"]))


# What happens to the topic partitions between plan and read; `first` and `last` are their planned ends.
LOSSES = {"whole": "true", "gap": "kafka_offset <> first + 3", "lost_start": "kafka_offset <> first", "lost_end": "kafka_offset <> last", "empty": "kafka_partition <> 2"}
REPEATED = "kafka_partition = 1 and kafka_offset = first + 5"


@add("a04_planned_refusals", "case:s refused:b steps:i missing:i repeated:i",
     f"SELECT * FROM (WITH m AS (SELECT topic, kafka_partition, kafka_offset, min(kafka_offset) OVER w AS first, max(kafka_offset) OVER w AS last FROM ({LAKE_EVENTS}) WINDOW w AS (PARTITION BY topic, kafka_partition)), "
     "c AS (" + " UNION ALL ".join(f"SELECT '{n}' AS \"case\", count(*) FILTER (NOT ({p})) AS missing, 0 AS repeated FROM m" for n, p in LOSSES.items())
     + f" UNION ALL SELECT 'repeat', 0, count(*) FILTER ({REPEATED}) FROM m) SELECT \"case\", missing + repeated > 0 AS refused, CASE WHEN missing + repeated > 0 THEN 0 ELSE 1 END AS steps, missing, repeated FROM c)")
def _(w):
    log = ranges.commit_log(w.spark, f"{w.root}/no-log")
    plan = ranges.plan_step(ranges.source_ends(w.spark, _source(w), log), log)
    ends = w.spark.createDataFrame(plan, ranges.PLAN).selectExpr("topic", "kafka_partition", "first_offset as first", "last_offset as last")
    rows = _event_messages(w).join(F.broadcast(ends), ["topic", "kafka_partition"])
    cases = {n: rows.where(p) for n, p in LOSSES.items()} | {"repeat": rows.unionByName(rows.where(REPEATED))}
    out = []
    for name, case in cases.items():
        base = f"{w.root}/refusals-{uuid.uuid4().hex}"
        case.drop("first", "last").write.parquet(f"{base}/source")
        try:
            ranges.land_range(w.spark, {"format": "parquet", "path": f"{base}/source"}, f"{base}/raw", f"{base}/log", plan=plan)
            refused = False
        except ranges.LandingRefused:
            refused = True
        steps = ranges.commit_log(w.spark, f"{base}/log").select("ingest_batch").distinct()
        stored = w.spark.read.parquet(f"{base}/raw").agg(F.count_distinct("topic", "kafka_partition", "kafka_offset").alias("d"), F.expr("count(1) as n"))
        out.append(stored.selectExpr(f"'{name}' as case", f"{refused} as refused", f"{sum(r.last_offset - r.first_offset + 1 for r in plan)} - d as missing", "n - d as repeated").withColumn("steps", steps.agg(F.expr("count(1) as n")).scalar()))
    return reduce(DataFrame.unionByName, out)


@add("a05_registered_batches", "messages:i batches:i stored:i",
     f"SELECT count(*) AS messages, max((kafka_offset - low) // step) + 1 AS batches, 2 * count(*) AS stored FROM {STEP_ROWS}")
def _(w):
    # On disk lies one more directory, of a step that never committed; `stored` counts it, the registry does not know it.
    base = _planned_zone(w)
    raw = ranges.registered_raw(w.spark, f"{base}/raw", f"{base}/log")
    stored = w.spark.read.schema("topic string").parquet(f"{base}/raw").agg(F.expr("count(1) as n")).scalar()
    return raw.agg(F.expr("count(1) as messages"), F.count_distinct("ingest_batch").alias("batches")).withColumn("stored", stored)


def _text_events(w: Workspace) -> DataFrame:
    return w.source().selectExpr(*[f"date_format(event_ts, 'yyyy-MM-dd HH:mm:ss') as {c}" if c == "event_timestamp" else f"string({c}) as {c}" for c in EVENT_FIELDS])


@add("a06_event_csv_source", "event_type:s rows:i quantity:d revenue:d missing_reason:i",
     "SELECT event_type, count(*) AS rows, sum(quantity) AS quantity, sum(revenue) AS revenue, count(*) FILTER (return_reason IS NULL) AS missing_reason FROM src GROUP BY 1")
def _(w):
    if "csv" not in w.staged:
        _text_events(w).write.mode("overwrite").option("header", True).csv(f"{w.root}/csv")
        w.staged["csv"] = source.read_event_csv(w.spark, f"{w.root}/csv")
    return w.staged["csv"].groupBy("event_type").agg(*map(F.expr, [
        "count(1) as rows", "sum(cast(quantity as bigint)) as quantity", "sum(cast(revenue as decimal(16,2))) as revenue",
        "count_if(return_reason is null) as missing_reason"]))


@add("a07_encode_route_key", "topic:s key:s messages:i quantity:d",
     "SELECT 'retail.' || CASE event_type WHEN 'SALE' THEN 'sales' WHEN 'PURCHASE' THEN 'purchases' WHEN 'RETURN' THEN 'returns' WHEN 'PRICE_CHANGE' THEN 'price_changes' "
     "ELSE 'inventory' END AS topic, branch_id AS key, count(*) AS messages, sum(quantity) AS quantity FROM src GROUP BY 1, 2")
def _(w): return source.encode_events(_text_events(w)).groupBy("topic", "key").agg(
    F.expr("count(1) as messages"), F.expr("sum(cast(get_json_object(value, '$.quantity') as int)) as quantity"))


@add("a08_zone_write_counts", "table:s rows:i", "SELECT 'lineitem' AS \"table\", count(*) AS rows FROM lineitem UNION ALL SELECT 'orders', count(*) FROM orders")
def _(w):
    counts = [(n, T.write_zone(w.table(n), f"{w.root}/zone/{n}")) for n in ["lineitem", "orders"]]
    return w.spark.createDataFrame(counts, "table string, rows bigint")


def _accounts(w: Workspace) -> tuple[DataFrame, DataFrame]:
    """Customer balances as the stored table, order totals per customer as the arriving one."""
    schema = "c_custkey bigint, amount decimal(28,2), updated_at timestamp"
    old = w.table("customer").selectExpr("c_custkey", "cast(cast(c_acctbal as decimal(12,2)) as decimal(28,2)) as amount", "timestamp'2020-01-01' as updated_at")
    new = w.table("orders").groupBy(F.expr("string(o_custkey) as c_custkey")).agg(F.expr("sum(cast(o_totalprice as decimal(14,2))) as amount"))
    return w.spark.createDataFrame([], schema).unionByName(old), new


ARRIVING = "SELECT o_custkey AS c_custkey, sum(CAST(o_totalprice AS DECIMAL(14,2))) AS amount, 2026 AS stamp FROM orders GROUP BY 1"


def _merged(w: Workspace, mode: str) -> DataFrame:
    old, new = _accounts(w)
    return T.merge(old, new, mode, ["c_custkey"], F.lit(NOW).cast("timestamp")).selectExpr("*", "year(updated_at) as stamp")


@add("a11_merge_replace", "c_custkey:i amount:d stamp:i", ARRIVING)
def _(w): return _merged(w, "replace")


@add("a12_merge_upsert", "c_custkey:i amount:d stamp:i",
     f"SELECT * FROM ({ARRIVING}) UNION ALL SELECT c_custkey, CAST(c_acctbal AS DECIMAL(12,2)), 2020 FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def _(w): return _merged(w, "upsert")


@add("a13_merge_sync", "c_custkey:i amount:d stamp:i", ARRIVING)
def _(w): return _merged(w, "sync")


@add("a13_merge_sync_changes", "inserted:i updated:i deleted:i",
     "SELECT count(*) FILTER (c IS NULL) AS inserted, count(*) FILTER (c = o) AS updated, count(*) FILTER (o IS NULL) AS deleted FROM "
     "(SELECT c_custkey AS c FROM customer) FULL JOIN (SELECT DISTINCT o_custkey AS o FROM orders) ON c = o")
def _(w):
    old, new = _accounts(w)
    return T.merge_changes(old, new.selectExpr("bigint(c_custkey) as c_custkey"), ["c_custkey"])


@add("a14_conform_to_schema", "o_orderkey:i o_orderdate:t o_totalprice:d",
     "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, CAST(o_totalprice AS DECIMAL(14,2)) AS o_totalprice FROM orders")
def _(w):
    target = w.spark.createDataFrame([], "o_orderkey bigint, o_orderdate date, o_totalprice decimal(14,2)").schema
    return T.conform(w.table("orders").selectExpr("string(o_totalprice) as o_totalprice", "string(o_orderdate) as o_orderdate", "string(o_orderkey) as o_orderkey"), target)


@add("a15_project_to_published", "branch_id:s performance_score:d", "SELECT branch_id, performance_score FROM branch_scorecard")
def _(w): return T.project(w.scorecards()["branch_scorecard"], ["branch_id", "performance_score"])[0]


PUBLISHED_COUNTS = " UNION ALL ".join(f"SELECT '{n}' AS \"table\", count(*) AS rows FROM {t}" for n, t in [
    ("company_monthly", "company_monthly"), ("branch_monthly", "branch_monthly"), ("supplier_monthly", "supplier_monthly"),
    ("inventory_movement_monthly", "inventory_movement_monthly"), ("inventory_branch_category", "inventory_branch_category"),
    ("branch_scorecard", "branch_base"), ("product_scorecard", "product_base"), ("supplier_scorecard", "supplier_base"),
    ("inventory_risk", "inventory_base"), ("anomalies", "anomalies"), ("revenue_leakage", "leak")]) + " UNION ALL SELECT 'kpi_summary', 33"


@add("a16_publish_version", "table:s rows:i", PUBLISHED_COUNTS)
def _(w):
    root = f"{w.root}/published"
    T.publish(w.spark, w.published(), root, uuid.uuid4().hex, datetime.now())
    return reduce(DataFrame.unionByName, [T.read_published(w.spark, root, n).agg(F.expr("count(1) as rows")).selectExpr(f"'{n}' as table", "rows")
                                          for n in w.published()])


@add("a17_load_verification", "table:s expected:i stored:i verdict:s",
     "SELECT fact AS \"table\", count(*) AS expected, count(*) AS stored, 'equal' AS verdict FROM allfacts GROUP BY 1")
def _(w): return T.count_check(model.build_facts(w.events(), w.dims()["dim_product"], CFG["returns"]["non_restockable_reasons"]), w.stored_facts())


@add("a18_run_log", "stage:s status:s rows_in:i rows_out:i rows_rejected:i error:s",
     "SELECT 'clean' AS stage, 'SUCCESS' AS status, raw AS rows_in, accepted AS rows_out, rejected AS rows_rejected, NULL AS error FROM account "
     "UNION ALL SELECT 'load', 'FAILED', NULL, NULL, NULL, 'RuntimeError: stored ' || (SELECT count(*) FROM lineitem) || ' rows'")
def _(w):
    log = T.RunLog(w.spark, f"{w.root}/runs-{uuid.uuid4().hex}")
    def clean():
        a = w.account().first()
        return {"rows_in": a.raw, "rows_out": a.accepted, "rows_rejected": a.rejected}
    def load():
        raise RuntimeError(f"stored {w.table('lineitem').count()} rows")
    log.stage("r1", "clean", clean)
    try:
        log.stage("r2", "load", load)
    except RuntimeError:
        pass      # the point of the query: the failure is on record
    return log.read()


# ================================================================== parsing and rules
def _typed(w: Workspace) -> DataFrame:
    return V.type_events(V.parse_events(w.messages()))


@add("b01_parse_events", "kafka_offset:i malformed:b event_id:s event_type:s quantity:s return_reason:s", "SELECT kafka_offset, malformed, event_id, event_type, quantity, return_reason FROM msg")
def _(w): return V.parse_events(w.messages())


@add("b01_parse_event_props", "event_id:i k:i", "SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k FROM events")
def _(w): return w.table("events").selectExpr("event_id", "from_json(props, 'k bigint').k as k")


@add("b02_blank_to_null", "city:s rows:i", "SELECT city, count(*) AS rows FROM msg GROUP BY 1")
def _(w): return V.parse_events(w.messages()).groupBy("city").agg(F.expr("count(1) as rows"))


@add("b03_safe_typing", "kafka_offset:i t_event_ts:t t_quantity:i t_unit_cost:d t_unit_price:d t_discount_pct:d t_revenue:d t_purchase_cost:d t_profit:d t_event_value:d",
     "SELECT kafka_offset, ts AS t_event_ts, t_qty AS t_quantity, t_unit_cost, t_unit_price, t_discount AS t_discount_pct, t_revenue, t_cost AS t_purchase_cost, "
     "t_profit, t_value AS t_event_value FROM msg")
def _(w): return _typed(w)


@add("b04_topic_short_name", "topic_short:s rows:i", "SELECT substr(topic, 8) AS topic_short, count(*) AS rows FROM msg GROUP BY 1")
def _(w): return w.messages().groupBy(V.topic_short(F.col("topic")).alias("topic_short")).agg(F.expr("count(1) as rows"))


@add("b05_expected_topic", "event_type:s expected_topic:s rows:i", "SELECT event_type, routed AS expected_topic, count(*) AS rows FROM msg GROUP BY 1, 2")
def _(w): return _typed(w).groupBy("event_type", "expected_topic").agg(F.expr("count(1) as rows"))


@add("b06_accepted_projection",
     "event_id:s event_ts:t event_type:s branch_id:s city:s product_id:s category:s supplier_id:s quantity:i unit_cost:d unit_price:d discount_pct:d revenue:d "
     "purchase_cost:d profit:d event_value:d return_reason:s kafka_topic:s kafka_offset:i has_warning:b",
     "SELECT event_id, ts AS event_ts, event_type, branch_id, city, product_id, category, supplier_id, t_qty AS quantity, t_unit_cost AS unit_cost, t_unit_price AS unit_price, "
     "t_discount AS discount_pct, t_revenue AS revenue, t_cost AS purchase_cost, t_profit AS profit, t_value AS event_value, return_reason, topic AS kafka_topic, kafka_offset, "
     "has_warning FROM judged WHERE NOT is_rejected")
def _(w): return V.accepted(w.judged())


RULE_ORDER = [*RULE_SQL, "POSSIBLE_DUPLICATE_BUSINESS_KEY", "DUPLICATE_EVENT_ID"]


def _flagged(w: Workspace) -> DataFrame:
    """Typed rows with both conflict flags, for the rules that read them."""
    product, branch = V.masters(V.parse_events(w.messages()), RULES_CFG)
    rows = V.conflict(_typed(w), product, ["product_id"], ["category", "supplier_id"], "product_conflict")
    return V.conflict(rows, branch, ["branch_id"], ["city"], "branch_conflict")


def _rule_query(number: int, code: str) -> None:
    severity = RULES["severity"][code]

    def run(w: Workspace) -> DataFrame:
        if code in RULE_SQL:
            predicate, detail = V.rule_expressions(RULES_CFG, NOW)[code]
            rows = _flagged(w) if "_conflict" in predicate else _typed(w)
            hits = rows.where(predicate).selectExpr("*", f"{detail} as detail")
        else:
            hits = w.judged().where(F.expr(f"exists(failures, f -> f.rule_code = '{code}')"))
        return hits.selectExpr("topic", "kafka_offset", "event_id", f"'{code}' as rule_code", f"'{severity}' as severity")

    add(f"c{number:02d}_{code.lower()}", "topic:s kafka_offset:i event_id:s rule_code:s severity:s",
        f"SELECT topic, kafka_offset, event_id, rule_code, severity FROM failures WHERE rule_code = '{code}'")(run)


for _i, _code in enumerate(RULE_ORDER, 1):
    _rule_query(_i, _code)


@add("c27_dominant_product_attributes", "product_id:s category:s supplier_id:s", "SELECT product_id, dom_category AS category, dom_supplier AS supplier_id FROM product_master")
def _(w): return V.dominant(V.parse_events(w.messages()).where("not malformed"), ["product_id"], ["category", "supplier_id"], 0.5)


@add("c27_dominant_branch_city", "branch_id:s city:s", "SELECT branch_id, dom_city AS city FROM branch_master")
def _(w): return V.dominant(V.parse_events(w.messages()).where("not malformed"), ["branch_id"], ["city"], 0.5)


@add("c28_failure_assembly", "kafka_offset:i codes:s", "SELECT kafka_offset, array_to_string(codes, ',') AS codes FROM local")
def _(w): return w.first_pass().selectExpr("kafka_offset", "concat_ws(',', transform(failures, f -> f.rule_code)) as codes")


@add("c29_first_valid_copy", "topic:s kafka_offset:i", "SELECT topic, kafka_offset FROM ranked WHERE id_rank > 1")
def _(w): return w.repeats().where("repeat = 'id'")


@add("c30_business_key_repeat", "topic:s kafka_offset:i", "SELECT topic, kafka_offset FROM ranked WHERE biz_rank > 1")
def _(w): return w.repeats().where("repeat = 'business'")


@add("c31_verdict", "topic:s kafka_offset:i is_rejected:b has_warning:b", "SELECT topic, kafka_offset, is_rejected, has_warning FROM judged")
def _(w): return w.judged()


@add("c32_failure_log", "event_id:s kafka_topic:s kafka_offset:i rule_code:s severity:s disposition:s",
     "SELECT event_id, topic AS kafka_topic, kafka_offset, rule_code, severity, disposition FROM failures")
def _(w): return V.failure_log(w.judged(), RULES_CFG)


@add("c33_row_accounting", "raw:i accepted:i rejected:i warned_only:i balanced:b", "SELECT *, raw = accepted + rejected AS balanced FROM account")
def _(w): return w.account()


@add("c34_rule_counts", "rule_code:s severity:s failures:i status:s",
     "SELECT r.rule_code, r.severity, coalesce(f.n, 0) AS failures, CASE WHEN coalesce(f.n, 0) = 0 THEN 'PASS' WHEN r.severity = 'REJECT' THEN 'FAIL' ELSE 'WARN' END AS status FROM (VALUES "
     + ", ".join(f"('{c}', '{s}')" for c, s in RULES["severity"].items()) + ") AS r(rule_code, severity) LEFT JOIN (SELECT rule_code, count(*) AS n FROM failures GROUP BY 1) f ON f.rule_code = r.rule_code")
def _(w): return V.rule_counts(w.failures(), RULES_CFG)


@add("c35_failure_summary", "rule_code:s severity:s disposition:s failures:i first_seen:t last_seen:t",
     "SELECT rule_code, severity, disposition, count(*) AS failures, min(kafka_timestamp) AS first_seen, max(kafka_timestamp) AS last_seen FROM failures GROUP BY 1, 2, 3")
def _(w): return V.failure_summary(w.failures())


# ================================================================== dimensions and facts
@add("d01_dominant_attributes", "product_id:s category:s supplier_id:s", "SELECT product_id, category, supplier_id FROM dim_product")
def _(w): return V.dominant(w.events(), ["product_id"], ["category", "supplier_id"])


@add("d02_dim_date", "date_key:i full_date:t year:i quarter:i month:i month_name:s year_month:s iso_week:i day_of_week:i day_name:s is_weekend:b", "dim_date")
def _(w): return model.dim_date(w.events())


@add("d03_dim_supplier", "supplier_id:s first_seen:t last_seen:t", "dim_supplier")
def _(w): return model.dim_supplier(w.events())


@add("d04_dim_branch", "branch_id:s city:s first_seen:t last_seen:t", "dim_branch")
def _(w): return model.dim_branch(w.events())


@add("d05_dim_product", "product_id:s category:s supplier_id:s list_price:d standard_cost:d first_seen:t last_seen:t", "dim_product")
def _(w): return model.dim_product(w.events())


FACT_KEYS = "event_id:s event_ts:t date_key:i branch_id:s product_id:s "


@add("d06_fact_sales", FACT_KEYS + "quantity:i unit_price:d unit_cost:d discount_pct:d gross_sales:d discount_amount:d net_revenue:d cogs:d gross_profit:d", "fact_sales")
def _(w): return model.fact_sales(w.events())


@add("d07_fact_returns", FACT_KEYS + "quantity:i return_reason:s refund_value:d cost_value:d restockable:b profit_impact:d", "fact_returns")
def _(w): return model.fact_returns(w.events(), CFG["returns"]["non_restockable_reasons"])


@add("d08_fact_purchases", FACT_KEYS + "supplier_id:s quantity:i unit_cost:d standard_cost:d list_price:d spend:d standard_spend:d price_variance_amount:d "
     "price_variance_pct:d cost_above_list_price:b", "fact_purchases")
def _(w): return model.fact_purchases(w.events(), w.dims()["dim_product"])


@add("d09_fact_inventory_movements", FACT_KEYS + "movement_type:s direction:s quantity:i unit_cost:d value_at_cost:d", "fact_inventory_movements")
def _(w): return model.fact_inventory_movements(w.events())


@add("d10_fact_price_changes", FACT_KEYS + "list_price:d standard_cost:d list_margin_pct:d", "fact_price_changes")
def _(w): return model.fact_price_changes(w.events(), w.dims()["dim_product"])


@add("d11_fact_coverage", "events:i fact_rows:i complete:b",
     "SELECT (SELECT count(*) FROM src) AS events, (SELECT count(*) FROM allfacts) AS fact_rows, (SELECT count(*) FROM src) = (SELECT count(*) FROM allfacts) AS complete")
def _(w): return model.fact_coverage(w.events(), w.facts())


@add("d12_integrity_constraints", "table:s constraint:s n:i", "SELECT 'fact_sales' AS \"table\", 'check quantity' AS \"constraint\", 1 AS n FROM fact_sales WHERE quantity <= 0")
def _(w): return model.check_constraints({**w.dims(), **w.facts()})


@add("d12_constraint_violations", "table:s constraint:s n:i",
     "SELECT 'orders' AS \"table\", 'check o_totalprice' AS \"constraint\", count(*) AS n FROM orders WHERE o_totalprice >= 200000 HAVING count(*) > 0 "
     "UNION ALL SELECT 'lineitem', 'unique l_orderkey', count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1) HAVING count(*) > 0 "
     "UNION ALL SELECT 'lineitem', 'reference l_partkey', count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT o_orderkey FROM orders) HAVING count(*) > 0")
def _(w): return model.check_constraints({"orders": w.table("orders"), "lineitem": w.table("lineitem")}, {
    "orders": {"key": "o_orderkey", "check": {"o_totalprice": "o_totalprice < 200000"}},
    "lineitem": {"key": "l_orderkey", "refs": {"l_partkey": "orders"}}})


# ================================================================== features
BRANCH = ("branch_id:s city:s period_start:t period_end:t sale_events:i units_sold:i gross_sales:d net_revenue:d cogs:d gross_profit:d discount_amount:d return_events:i "
          "return_units:i return_value:d damage_units:i return_profit_impact:d damage_value:d adjustment_events:i adjustment_units:i adjustment_value:d "
          "adjustment_event_cost:d purchase_units:i purchase_spend:d adjusted_gross_profit:d gross_margin:d discount_rate:d return_rate_units:d return_rate_value:d "
          "damage_rate:d adjustment_avg_qty:d shrink_rate:d growth_rate:d")
PRODUCT = ("product_id:s category:s supplier_id:s list_price:d standard_cost:d sale_events:i units_sold:i gross_sales:d net_revenue:d cogs:d gross_profit:d "
           "discount_amount:d return_events:i return_units:i return_value:d damage_units:i adjustment_units:i revenue_recent:d revenue_prior:d gross_margin:d "
           "discount_rate:d return_rate_units:d damage_rate:d growth_rate:d")
SUPPLIER = ("supplier_id:s products_supplied:i purchase_events:i purchase_units:i purchase_spend:d purchase_standard_spend:d ppv_amount:d ppv_pct:d "
            "share_above_standard:d purchases_above_list:i cadence_cv:d product_return_rate:d product_damage_rate:d first_purchase:t last_purchase:t")
INVENTORY = ("product_id:s category:s supplier_id:s as_of_date:t units_sold_recent:i units_sold_prior:i velocity_per_day:d velocity_change:d units_sold_window:i "
             "units_purchased_window:i replenishment_ratio:d days_since_last_sale:d days_since_last_purchase:d damage_units_recent:i")
COMPANY_M = ("year_month:s month_start:t sale_events:i units_sold:i gross_sales:d net_revenue:d cogs:d gross_profit:d discount_amount:d return_units:i return_value:d "
             "return_profit_impact:d damage_value:d adjustment_value:d purchase_spend:d price_variance_amount:d adjusted_gross_profit:d gross_margin:d discount_rate:d "
             "return_rate_units:d")
BRANCH_M = ("branch_id:s year_month:s month_start:t sale_events:i units_sold:i gross_sales:d net_revenue:d cogs:d gross_profit:d discount_amount:d return_units:i "
            "return_value:d damage_units:i adjustment_units:i purchase_spend:d gross_margin:d discount_rate:d return_rate_units:d")


@add("e01_as_of_date", "as_of:t", "SELECT d AS as_of FROM refday")
def _(w): return w.spark.createDataFrame([(features.as_of(w.facts()),)], "as_of date")


AS_OF = "1996-06-30"     # a configured day inside the data


@add("e01_configured_as_of", "as_of:t fact:s rows:i last_day:t",
     f"SELECT '{AS_OF}' AS as_of, fact, count(*) AS rows, CAST(max(ts) AS DATE) AS last_day FROM (" + " UNION ALL ".join(
         f"SELECT '{f}' AS fact, event_ts AS ts FROM {f}" for f in sorted(set(FACT_OF_TYPE.values()))) + f") WHERE CAST(ts AS DATE) <= DATE '{AS_OF}' GROUP BY fact")
def _(w):
    # The configured day wins over the latest event, and no later row is left in any fact.
    facts = features.cut(w.facts(), AS_OF)
    day = features.as_of(facts, AS_OF)
    return reduce(DataFrame.unionByName, [df.selectExpr(f"'{n}' as fact", "event_ts").groupBy("fact").agg(F.expr("count(1) as rows"), F.expr("to_date(max(event_ts)) as last_day")) for n, df in facts.items()]).withColumn("as_of", F.lit(day))


@add("e02_movements", "branch_id:s product_id:s event_ts:t kind:s quantity:i value:d", "movements")
def _(w): return w.moves()


@add("e02_daily_movements", "branch_id:s product_id:s event_ts:t kind:s events:i quantity:i value:d",
     "SELECT branch_id, product_id, date_trunc('day', event_ts)::TIMESTAMP AS event_ts, kind, count(*) AS events, sum(quantity) AS quantity, sum(value) AS value FROM movements GROUP BY 1, 2, 3, 4")
def _(w): return features.daily(w.moves()).withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))


@add("e05_branch_base_from_daily", BRANCH, "branch_base")
def _(w): return features.branch_base(features.daily(w.moves()), w.dims()["dim_branch"], w.day(), 6)


@add("e03_growth_windows", "branch_id:s revenue_recent:d revenue_prior:d growth_rate:d",
     "SELECT branch_id, revenue_recent, revenue_prior, CAST(revenue_recent AS DOUBLE) / nullif(CAST(revenue_prior AS DOUBLE), 0) - 1 AS growth_rate FROM s_branch")
def _(w): return w.moves().where("kind = 'SALE'").groupBy("branch_id").agg(*map(F.expr, features.growth_windows(w.day(), 6))).selectExpr("*", features.GROWTH)


@add("e04_entity_aggregates", "product_id:s sale_events:i units_sold:d return_events:i return_units:d damage_units:d adjustment_units:d",
     "SELECT k.product_id, coalesce(sale_events, 0) AS sale_events, units_sold, coalesce(return_events, 0) AS return_events, return_units, damage_units, adjustment_units "
     "FROM (SELECT DISTINCT product_id FROM movements) k LEFT JOIN s_product s ON s.product_id = k.product_id LEFT JOIN r_product r ON r.product_id = k.product_id "
     "LEFT JOIN i_product i ON i.product_id = k.product_id")
def _(w): return features.entity_aggregates(w.moves(), "product_id", w.day(), 6)


@add("e05_branch_base", BRANCH, "branch_base")
def _(w): return features.branch_base(w.moves(), w.dims()["dim_branch"], w.day(), 6)


@add("e06_product_base", PRODUCT, "product_base")
def _(w): return features.product_base(w.moves(), w.dims()["dim_product"], w.day(), 6)


@add("e07_supplier_base", SUPPLIER, "supplier_base")
def _(w): return features.supplier_base(w.facts(), w.dims()["dim_supplier"], w.dims()["dim_product"])


@add("e07_purchase_cadence", "supplier_id:s cadence_cv:d", "SELECT supplier_id, stddev_samp(gap) / nullif(avg(gap), 0) AS cadence_cv FROM gaps WHERE gap IS NOT NULL GROUP BY 1")
def _(w): return features.cadence(w.facts()["fact_purchases"])


@add("e08_company_monthly", COMPANY_M, "company_monthly")
def _(w): return features.company_monthly(w.moves())


@add("e09_branch_monthly", BRANCH_M, "branch_monthly")
def _(w): return features.branch_monthly(w.moves())


@add("e10_supplier_monthly", "supplier_id:s year_month:s month_start:t purchase_events:i purchase_units:i purchase_spend:d purchase_standard_spend:d ppv_amount:d ppv_pct:d",
     "supplier_monthly")
def _(w): return features.supplier_monthly(w.facts()["fact_purchases"])


@add("e11_inventory_movement_monthly", "year_month:s month_start:t units_purchased:i units_sold:i units_returned:i units_damaged:i units_adjusted:i replenishment_ratio:d",
     "inventory_movement_monthly")
def _(w): return features.inventory_movement_monthly(w.moves())


@add("e12_inventory_base", INVENTORY, "inventory_base")
def _(w): return features.inventory_base(w.moves(), w.dims()["dim_product"], w.day())


@add("e13_inventory_branch_category", "branch_id:s category:s as_of_date:t units_sold:i units_purchased:i replenishment_ratio:d damage_units:i adjustment_units:i "
     "adjustment_value:d shrink_rate:d days_since_last_purchase:d", "inventory_branch_category")
def _(w): return features.branch_category(w.moves(), w.dims()["dim_product"], w.day())


@add("e14_null_policy", "zero_sums:i null_ratios:i", "SELECT count(*) FILTER (units_sold = 0) AS zero_sums, count(*) FILTER (gross_margin IS NULL) AS null_ratios FROM product_base")
def _(w): return features.product_base(w.moves(), w.dims()["dim_product"], w.day()).agg(
    F.expr("count_if(units_sold = 0) as zero_sums"), F.expr("count_if(gross_margin is null) as null_ratios"))


# ================================================================== detection
ANOMALY = ("anomaly_id:s detection_method:s check_id:s entity_type:s entity_id:s entity_label:s metric:s direction:s observed_value:d baseline_value:d baseline_spread:d "
           "severity:s sample_size:i estimated_exposure:d annualised_exposure:d leakage_type:s")


@add("f01_robust_baseline", "check_id:s median:d scale:d peers:i", "SELECT check_id, min(med) AS median, min(scale) AS scale, min(peers) AS peers FROM points GROUP BY 1")
def _(w): return detection.peer_points(w.peers(), CFG).groupBy("check_id").agg(*[F.expr(f"min({c}) as {c}") for c in ["median", "scale", "peers"]])


@add("f01_robust_baseline_distributed", "check_id:s median:d scale:d peers:i", "SELECT check_id, min(med) AS median, min(scale) AS scale, min(peers) AS peers FROM points GROUP BY 1")
def _(w): return detection.peer_points(w.peers(), CFG).groupBy("check_id").agg(*[F.expr(f"min({c}) as {c}") for c in ["median", "scale", "peers"]])


@add("f02_severity", "severity:s n:i", "SELECT severity, count(*) AS n FROM (SELECT CASE WHEN z >= 3 THEN 'critical' WHEN z >= 2 THEN 'high' WHEN z >= 1 THEN 'medium' END AS severity "
     "FROM (SELECT CASE direction WHEN 'high' THEN value - med ELSE med - value END / scale AS z FROM points)) GROUP BY 1")
def _(w): return (detection.peer_points(w.peers(), CFG).selectExpr("case direction when 'high' then value - median else median - value end / scale as z", "z_medium", "z_high", "z_critical")
                  .groupBy(F.expr(detection.severity("z", "z_medium", "z_high", "z_critical")).alias("severity")).agg(F.expr("count(1) as n")))


@add("f03_entity_label", "entity_type:s entity_id:s entity_label:s", "SELECT DISTINCT entity_type, entity_id, entity_label FROM candidates")
def _(w): return detection.peer_candidates(w.peers(), CFG).select("entity_type", "entity_id", "entity_label").distinct()


def _peer(w: Workspace) -> DataFrame:
    return detection.detect_peer(w.peers(), CFG, w.period_start(), w.day())


def _temporal(w: Workspace) -> DataFrame:
    return detection.detect_temporal(w.series(), CFG, w.day(), detection.branch_labels(w.features()["branch_base"]))


@add("f04_peer_anomalies", ANOMALY, "SELECT * FROM anomalies WHERE detection_method = 'PEER'")
def _(w): return _peer(w)


def _one_check(name: str, check: dict, temporal: bool) -> None:
    kind = "temporal_checks" if temporal else "peer_checks"
    cfg = {**CFG, "anomaly": {**CFG["anomaly"], kind: [check]}}

    def run(w: Workspace) -> DataFrame:
        if temporal:
            return detection.detect_temporal(w.series(), cfg, w.day(), detection.branch_labels(w.features()["branch_base"]))
        return detection.detect_peer(w.peers(), cfg, w.period_start(), w.day())
    add(name, ANOMALY, f"SELECT * FROM anomalies WHERE check_id = '{check['id']}'")(run)


for _c, _check in zip("abcdefgh", CFG["anomaly"]["peer_checks"]):
    _one_check(f"f05{_c}_{_check['id']}", _check, temporal=False)


@add("f06_temporal_anomalies", ANOMALY, "SELECT * FROM anomalies WHERE detection_method = 'TEMPORAL'")
def _(w): return _temporal(w)


for _c, _check in zip("abcd", CFG["anomaly"]["temporal_checks"]):
    _one_check(f"f07{_c}_{_check['id']}", _check, temporal=True)


@add("f08_all_anomalies", ANOMALY, "anomalies")
def _(w): return detection.detect_all(w.features(), CFG, w.period_start(), w.day())


@add("f09_anomaly_rollup", "entity_type:s entity_id:s anomaly_count:i max_anomaly_severity:s", "SELECT entity_type, entity_id, anomaly_count, worst AS max_anomaly_severity FROM rollup")
def _(w): return reduce(DataFrame.unionByName, [detection.anomaly_rollup(w.anomalies(), e).selectExpr(f"'{e}' as entity_type", "*") for e in detection.ID])


NOUN = "CASE check_id WHEN 'branch_adjustment_qty' THEN 'stock adjustments' WHEN 'supplier_price_variance' THEN 'purchases' ELSE 'sales' END"
LABEL = ("CASE metric WHEN 'discount_rate' THEN 'discount rate' WHEN 'return_rate_units' THEN 'return rate' WHEN 'adjustment_avg_qty' THEN 'average stock-adjustment size' "
         "WHEN 'damage_rate' THEN 'damage rate' WHEN 'gross_margin' THEN 'gross margin' ELSE 'purchase cost versus standard cost' END")


def _num(v: str, digits: int = 1) -> str:
    return f"CAST(CAST(round({v}, {digits}) AS DECIMAL(38,{digits})) AS VARCHAR)"


def _grouped(v: str) -> str:
    return f"format('{{:,}}', CAST(round({v}) AS BIGINT))"


def _in_unit(v: str, after: str, signed: bool = False) -> str:
    """SQL: a value in the unit of the row's metric."""
    sign = f"CASE WHEN {v} >= 0 THEN '+' ELSE '' END || " if signed else ""
    return (f"CASE metric WHEN 'adjustment_avg_qty' THEN {_num(v)} || ' units' WHEN 'ppv_pct' THEN {sign}{_num(v + ' * 100')} || '{after}' ELSE {_num(v + ' * 100')} || '{after}' END")


_GAP = f"{_in_unit('gap', ' points')} || CASE direction WHEN 'high' THEN ' above' ELSE ' below' END"
_MONEY = CFG["currency"]


@add("f10_peer_explanations", "anomaly_id:s explanation:s robust_z:d",
     f"SELECT check_id || ':' || entity_id AS anomaly_id, entity_label || ', ' || {LABEL} || ': ' || {_in_unit('value', ' %', True)} || '. The middle of ' || peers || ' ' || "
     f"CASE entity_type WHEN 'branch' THEN 'branches' ELSE entity_type || 's' END || ' is ' || {_in_unit('med', ' %', True)} || '. It lies ' || {_GAP} || ' that, or ' || {_num('z')} || ' robust deviations: ' || severity "
     f"|| '. Seen in ' || {_grouped('n')} || ' ' || {NOUN} || '.' || CASE WHEN estimated_exposure > 0 THEN ' At stake: {_MONEY} ' || {_grouped('estimated_exposure')} || ' in ' || {_num('(SELECT years FROM period)')} || ' years' "
     f"|| CASE WHEN annualised_exposure <> 0 THEN ', {_MONEY} ' || {_grouped('annualised_exposure')} || ' in a year' ELSE '' END || '.' ELSE '' END AS explanation, round(z, 2) AS robust_z FROM peer")
def _(w): return _peer(w)


@add("f11_temporal_explanations", "anomaly_id:s explanation:s",
     f"SELECT check_id || ':' || entity_id AS anomaly_id, entity_label || ', ' || {LABEL} || ': ' || {_in_unit('recent', ' %', True)} || ' as the mean of its latest 3 months, ' || {_GAP} || ' the ' || "
     f"{_in_unit('base_mean', ' %', True)} || ' of the ' || baseline_months || ' before. One month differs from the next by about ' || {_in_unit('spread', ' %', True)} || '; the shift has a z of ' || {_num('z')} "
     "|| ': ' || severity || '.' AS explanation FROM temporal")
def _(w): return _temporal(w)


@add("f12_stockout_explanations", "product_id:s explanation:s",
     f"SELECT product_id, coalesce(nullif(concat_ws(' ', '90 days of sales: ' || {_num('velocity_per_day')} || ' units a day, ahead of ' || {_num('pct_velocity * 100', 0)} || ' % of the products.', "
     f"'Purchases made up for ' || {_num('replenishment_ratio * 100', 0)} || ' % of what 180 days sold.', 'Bought last ' || days_since_last_purchase || ' days ago.'), ''), 'No movement to judge by.') AS explanation "
     "FROM inventory_risk")
def _(w): return scoring.score_inventory(w.features()["inventory_base"], CFG)


# ================================================================== scoring
RISK = "product_id:s pct_velocity:d pct_replenishment_gap:d pct_purchase_recency:d stockout_risk_score:d stockout_risk_level:s is_slow_moving:b is_dead_stock:b reorder_flag:b"
FLAGS = "product_id:s margin_percentile:d is_high_margin:b is_low_margin:b is_high_return:b is_high_discount:b is_declining:b anomaly_count:i is_problematic:b"
SCORE = ("branch_id:s score_gross_margin:d score_discount_rate:d score_return_rate:d score_shrink_rate:d score_growth_rate:d performance_score:d performance_band:s "
         "performance_rank:i anomaly_count:i max_anomaly_severity:s operational_risk:s")
PCT_RANK_SQL = "SELECT product_id, margin_percentile AS r FROM product_flags"


def _pct_rank(w: Workspace) -> DataFrame:
    return with_pct_ranks(w.features()["product_base"], "product_id", {"r": ("gross_margin", True)}, ["category"])


@add("g01_percentile_rank", "product_id:s r:d", PCT_RANK_SQL)
def _(w): return _pct_rank(w)


@add("g01_percentile_rank_distributed", "product_id:s r:d", PCT_RANK_SQL)
def _(w): return _pct_rank(w)


COMPONENT_SQL = "SELECT branch_id, score_gross_margin, score_discount_rate, score_return_rate, score_shrink_rate, score_growth_rate FROM branch_scorecard"
COMPONENTS = "branch_id:s score_gross_margin:d score_discount_rate:d score_return_rate:d score_shrink_rate:d score_growth_rate:d"


@add("g02_robust_components", COMPONENTS, COMPONENT_SQL)
def _(w): return with_robust_components(w.features()["branch_base"], "branch_id", CFG["branch_score"]["components"])


@add("g02_robust_components_distributed", COMPONENTS, COMPONENT_SQL)
def _(w): return with_robust_components(w.features()["branch_base"], "branch_id", CFG["branch_score"]["components"])


@add("g03_branch_scores", SCORE, "branch_scorecard")
def _(w): return scoring.score_branches(w.features()["branch_base"], w.anomalies(), CFG)


@add("g04_risk_from_severity", "operational_risk:s branches:i", "SELECT operational_risk, count(*) AS branches FROM branch_scorecard GROUP BY 1")
def _(w): return w.features()["branch_base"].join(detection.anomaly_rollup(w.anomalies(), "branch").withColumnRenamed("entity_id", "branch_id"), "branch_id", "left").groupBy(
    F.expr(scoring.risk("max_anomaly_severity")).alias("operational_risk")).agg(F.expr("count(1) as branches"))


@add("g05_supplier_risk", "supplier_id:s ppv_pct:d anomaly_count:i risk_level:s", "supplier_scorecard")
def _(w): return scoring.score_suppliers(w.features()["supplier_base"], w.anomalies())


@add("g06_product_flags", FLAGS, "product_flags")
def _(w): return scoring.flag_products(w.features()["product_base"], w.anomalies(), CFG)


@add("g06_product_flags_distributed", FLAGS, "product_flags")
def _(w): return scoring.flag_products(w.features()["product_base"], w.anomalies(), CFG)


@add("g07_product_reasons", "product_id:s problem_reasons:s",
     "SELECT product_id, CASE WHEN is_problematic THEN nullif(concat_ws('; ', CASE WHEN anomaly_count > 0 THEN 'stands out from its peers' END, "
     f"CASE WHEN is_low_margin THEN 'margin ' || {_num('gross_margin * 100')} || ' %, among the lowest in ' || category END, "
     f"CASE WHEN is_high_return THEN 'returns ' || {_num('return_rate_units * 100')} || ' %, among the highest of all' END, "
     f"CASE WHEN is_high_discount THEN 'discounts ' || {_num('discount_rate * 100')} || ' %, among the highest of all' END, "
     f"CASE WHEN is_declining THEN 'revenue down by ' || {_num('abs(growth_rate) * 100', 0)} || ' %' END), '') END AS problem_reasons "
     "FROM product_flags")
def _(w): return scoring.flag_products(w.features()["product_base"], w.anomalies(), CFG)


@add("g08_stockout_scores", RISK, "inventory_risk")
def _(w): return scoring.score_inventory(w.features()["inventory_base"], CFG)


@add("g08_stockout_scores_distributed", RISK, "inventory_risk")
def _(w): return scoring.score_inventory(w.features()["inventory_base"], CFG)


@add("g09_slow_moving", "product_id:s category:s slow_cut:d is_slow_moving:b", "SELECT product_id, category, slow_cut, is_slow_moving FROM inventory_risk")
def _(w): return with_quantiles(w.features()["inventory_base"], {"slow_cut": ("velocity_per_day", 0.2)}, ["category"]).selectExpr(
    "product_id", "category", "slow_cut", "coalesce(velocity_per_day <= slow_cut, false) as is_slow_moving")


@add("g10_dead_stock", "product_id:s days_since_last_sale:d", "SELECT product_id, days_since_last_sale FROM inventory_risk WHERE is_dead_stock")
def _(w): return w.scorecards()["inventory_risk"].where("is_dead_stock")


@add("g11_reorder_review", "product_id:s velocity_per_day:d days_since_last_purchase:d", "SELECT product_id, velocity_per_day, days_since_last_purchase FROM inventory_risk WHERE reorder_flag")
def _(w): return w.scorecards()["inventory_risk"].where("reorder_flag")


# ================================================================== leakage and KPIs
LEAK = "leakage_type:s entity_type:s entity_id:s entity_label:s exposure_amount:d annualised_exposure:d source_anomaly_id:s"


@add("h01_leakage_from_anomalies", "leakage_type:s entity_type:s entity_id:s entity_label:s exposure:d source_anomaly_id:s",
     "SELECT leakage_type, entity_type, entity_id, entity_label, exposure_amount AS exposure, source_anomaly_id FROM leak WHERE leakage_type <> 'LOW_MARGIN_SHORTFALL'")
def _(w): return finance.leakage_from_anomalies(w.anomalies(), CFG)


@add("h02_low_margin_shortfall", "entity_id:s entity_label:s exposure_amount:d", "SELECT entity_id, entity_label, exposure_amount FROM leak WHERE leakage_type = 'LOW_MARGIN_SHORTFALL'")
def _(w): return finance.margin_shortfall(w.scorecards()["product_scorecard"]).selectExpr("*", "round(exposure, 2) as exposure_amount")


@add("h02_revenue_leakage", LEAK, "leak")
def _(w): return finance.leakage(w.anomalies(), w.scorecards()["product_scorecard"], CFG, w.period_start(), w.day())


_SUM = lambda c, t="company_monthly": f"(SELECT CAST(sum({c}) AS DOUBLE) FROM {t})"
_CNT = lambda t, p="true": f"(SELECT CAST(count(*) FILTER ({p}) AS DOUBLE) FROM {t})"
_LAST = "(SELECT net_revenue, row_number() OVER (ORDER BY year_month DESC) AS rn FROM company_monthly)"
_DET, _OPP = "leakage_type <> 'LOW_MARGIN_SHORTFALL'", "leakage_type = 'LOW_MARGIN_SHORTFALL'"
KPI_SQL = {
    **{k: _SUM(k) for k in ["net_revenue", "gross_profit", "units_sold", "discount_amount", "return_value", "return_profit_impact", "damage_value", "adjustment_value",
                            "purchase_spend", "adjusted_gross_profit"]},
    "price_variance": _SUM("price_variance_amount"), "gross_margin": f"{_SUM('gross_profit')} / {_SUM('net_revenue')}",
    "discount_rate": f"{_SUM('discount_amount')} / {_SUM('gross_sales')}", "return_rate_units": f"{_SUM('return_units')} / {_SUM('units_sold')}",
    "net_revenue_12m": f"(SELECT CAST(sum(net_revenue) AS DOUBLE) FROM {_LAST} WHERE rn <= 12)",
    "revenue_growth_yoy": f"(SELECT CAST(sum(net_revenue) FILTER (rn <= 12) AS DOUBLE) / CAST(sum(net_revenue) FILTER (rn > 12 AND rn <= 24) AS DOUBLE) - 1 FROM {_LAST})",
    "leakage_total": f"(SELECT coalesce(sum(exposure_amount), 0) FROM leak WHERE {_DET})", "leakage_annualised": f"(SELECT coalesce(sum(annualised_exposure), 0) FROM leak WHERE {_DET})",
    "margin_opportunity": f"(SELECT coalesce(sum(exposure_amount), 0) FROM leak WHERE {_OPP})", "leakage_findings": _CNT("leak", _DET), "anomalies_total": _CNT("anomalies"),
    **{f"anomalies_{s}": _CNT("anomalies", f"severity = '{s}'") for s in ["critical", "high", "medium"]}, "branches_weak": _CNT("branch_scorecard", "performance_band = 'weak'"),
    "products_problematic": _CNT("product_flags", "is_problematic"), "stockout_high": _CNT("inventory_risk", "stockout_risk_level = 'high'"),
    "slow_moving": _CNT("inventory_risk", "is_slow_moving"), "dead_stock": _CNT("inventory_risk", "is_dead_stock"), "reorder_flags": _CNT("inventory_risk", "reorder_flag"),
    "suppliers_at_risk": _CNT("supplier_scorecard", "risk_level <> 'low'"),
}
KPI_ROWS = " UNION ALL ".join(
    f"SELECT '{k}' AS kpi_key, '{s}' AS section, '{lb}' AS label, round({KPI_SQL.get(k, 'CAST(NULL AS DOUBLE)')}, 4) AS value, "
    + {"as_of_date": "(SELECT CAST(d AS VARCHAR) FROM refday)", "period_start": "(SELECT CAST(lo AS VARCHAR) FROM period)"}.get(k, "CAST(NULL AS VARCHAR)")
    + f" AS value_text, '{u}' AS unit, {i} AS sort_order" for i, (k, s, lb, u) in enumerate(finance.KPIS))
KPI = "kpi_key:s section:s label:s value:d value_text:s unit:s sort_order:i"


@add("h03_kpi_summary", KPI, KPI_ROWS)
def _(w): return w.build_kpis().selectExpr("*", "round(value_numeric, 4) as value")


@add("h03a_trailing_twelve_months", "kpi_key:s value:d", f"SELECT kpi_key, value FROM ({KPI_ROWS}) WHERE kpi_key IN ('net_revenue_12m', 'revenue_growth_yoy')")
def _(w): return w.build_kpis().where("kpi_key in ('net_revenue_12m', 'revenue_growth_yoy')").selectExpr("kpi_key", "round(value_numeric, 4) as value")


@add("h03b_detected_vs_opportunity", "kpi_key:s value:d", f"SELECT kpi_key, value FROM ({KPI_ROWS}) WHERE kpi_key IN ('leakage_total', 'leakage_annualised', 'margin_opportunity', 'leakage_findings')")
def _(w): return w.build_kpis().where("kpi_key in ('leakage_total', 'leakage_annualised', 'margin_opportunity', 'leakage_findings')").selectExpr("kpi_key", "round(value_numeric, 4) as value")


# ================================================================== gates
GATE = "layer:s check_name:s severity:s status:s observed:d expected:d"


def _gate_sql(layer: str, rows: list[tuple[str, str, str, float]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{n}' AS check_name, 'CRITICAL' AS severity, CASE WHEN abs({o} - {e}) <= {t} THEN 'PASS' ELSE 'FAIL' END AS status, {o} AS observed, {e} AS expected"
        for n, o, e, t in rows)


_N = lambda t: f"(SELECT CAST(count(*) AS DOUBLE) FROM {t})"
_REJECTED = "(SELECT CAST(rejected AS DOUBLE) FROM account)"


def _clean_tables(w: Workspace) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Star schema of the accepted messages."""
    names = ["dim_branch", "dim_product"]
    dims = {n: w.stage(f"clean_{n}", lambda n=n: getattr(model, n)(w.clean_events())) for n in names}
    if "clean_fact_sales" not in w.staged:
        for n, df in model.build_facts(w.clean_events(), dims["dim_product"], CFG["returns"]["non_restockable_reasons"]).items():
            w.stage(f"clean_{n}", lambda df=df: df)
    return {n: w.staged[f"clean_{n}"] for n in model.FACTS}, dims


SOLD = "FROM judged WHERE NOT is_rejected AND event_type = 'SALE'"


@add("j01_j11_warehouse_gates", GATE, _gate_sql("warehouse", [
    ("KAFKA_OFFSETS_EQUAL_RAW_MESSAGES", _N("msg"), _N("msg"), 0), ("RAW_EQUALS_CLEAN_PLUS_REJECTED", _N("msg"), "(SELECT CAST(accepted + rejected AS DOUBLE) FROM account)", 0),
    ("RAW_MESSAGES_EQUAL_KAFKA", _N("msg"), "(SELECT CAST(raw AS DOUBLE) FROM account)", 0), ("QUARANTINE_HOLDS_EVERY_REJECT", _REJECTED, _REJECTED, 0),
    ("WAREHOUSE_FACTS_EQUAL_ACCEPTED_EVENTS", "(SELECT CAST(count(*) AS DOUBLE) FROM judged WHERE NOT is_rejected)", "(SELECT CAST(accepted AS DOUBLE) FROM account)", 0),
    ("EVENT_IN_ONE_FACT_ONLY", "(SELECT CAST(count(*) AS DOUBLE) FROM (SELECT event_id FROM judged WHERE NOT is_rejected GROUP BY 1 HAVING count(*) > 1))", "CAST(0 AS DOUBLE)", 0),
    ("NO_ORPHAN_FACTS", "CAST(0 AS DOUBLE)", "CAST(0 AS DOUBLE)", 0),
    ("SALES_PROFIT_IDENTITY", f"(SELECT CAST(max(abs(t_revenue - t_cost - t_profit)) AS DOUBLE) {SOLD})", "CAST(0 AS DOUBLE)", 0.02),
    ("SALES_ARE_POSITIVE", f"(SELECT CAST(count(*) FILTER (t_revenue <= 0 OR t_qty <= 0) AS DOUBLE) {SOLD})", "CAST(0 AS DOUBLE)", 0),
    ("SALES_REVENUE_CHECKSUM_LAKE_VS_WAREHOUSE", f"(SELECT CAST(sum(t_revenue) AS DOUBLE) {SOLD})", f"(SELECT CAST(sum(t_revenue) AS DOUBLE) {SOLD})", 0.5),
    ("SALES_PROFIT_CHECKSUM_LAKE_VS_WAREHOUSE", f"(SELECT CAST(sum(t_profit) AS DOUBLE) {SOLD})", f"(SELECT CAST(sum(t_profit) AS DOUBLE) {SOLD})", 0.5)]))
def _(w):
    facts, dims = _clean_tables(w)
    # A bulk import: its landing record is the number of messages written per topic partition.
    record = w.messages().groupBy("topic", "kafka_partition").agg(F.expr("count(1) as landed"), F.expr("count(1) as expected"))
    return gates.warehouse_gates(record, w.account(), w.failures(), w.clean_events(), facts, dims)


_LINES = "(SELECT CAST(count(*) AS DOUBLE) FROM {})"
_DAMAGE = [     # check, observed, expected of tables that were tampered with
    ("KAFKA_OFFSETS_EQUAL_RAW_MESSAGES", _N("msg"), "(SELECT CAST(count(*) + 5 * count(DISTINCT topic) AS DOUBLE) FROM msg)"),
    ("RAW_EQUALS_CLEAN_PLUS_REJECTED", _N("msg"), "(SELECT CAST(accepted - 3 + rejected AS DOUBLE) FROM account)"),
    ("RAW_MESSAGES_EQUAL_KAFKA", _N("msg"), _N("msg")),
    ("QUARANTINE_HOLDS_EVERY_REJECT", _LINES.format("judged WHERE is_rejected AND kafka_offset % 10 <> 0"), _REJECTED),
    ("WAREHOUSE_FACTS_EQUAL_ACCEPTED_EVENTS", "(SELECT CAST(count(*) + count(*) FILTER (event_type = 'SALE' AND t_qty = 1) AS DOUBLE) FROM judged WHERE NOT is_rejected)", "(SELECT CAST(accepted - 3 AS DOUBLE) FROM account)"),
    ("EVENT_IN_ONE_FACT_ONLY", _LINES.format("judged WHERE NOT is_rejected AND event_type = 'SALE' AND t_qty = 1"), "CAST(0 AS DOUBLE)"),
    ("NO_ORPHAN_FACTS", _LINES.format("judged WHERE NOT is_rejected AND event_type = 'RETURN' AND t_qty > 3"), "CAST(0 AS DOUBLE)"),
]


@add("j01_j11_failing_gates", "run_id:s check_name:s status:s observed:d expected:d message:s raised:b",
     " UNION ALL ".join(f"SELECT 'tampered' AS run_id, '{n}' AS check_name, CASE WHEN {o} = {e} THEN 'PASS' ELSE 'FAIL' END AS status, {o} AS observed, {e} AS expected, "
                        f"'observed ' || CAST(CAST({o} AS BIGINT) AS VARCHAR) || ' vs expected ' || CAST(CAST({e} AS BIGINT) AS VARCHAR) AS message, true AS raised" for n, o, e in _DAMAGE))
def _(w):
    """Offsets that never arrived, a wrong accounting, rejects lost from the quarantine, sales loaded twice and
    returns of unknown products: the results are stored, then the run fails."""
    facts, dims = _clean_tables(w)
    record = w.messages().groupBy("topic", "kafka_partition").agg(F.expr("count(1) as landed"), F.expr("count(1) + 5 as expected"))
    sales, returns = facts["fact_sales"], facts["fact_returns"]
    facts = {**facts, "fact_sales": sales.unionByName(sales.where("quantity = 1")), "fact_returns": returns.withColumn("product_id", F.expr("if(quantity > 3, 'NONE', product_id)"))}
    checked = gates.warehouse_gates(record, w.account().withColumn("accepted", F.col("accepted") - 3), w.failures().where("kafka_offset % 10 <> 0"), w.clean_events(), facts, dims)
    history = f"{w.root}/gates-{uuid.uuid4().hex}"
    try:
        gates.settle(checked, history, "tampered", datetime(2001, 8, 1))
        raised = False
    except RuntimeError:
        raised = True
    return gates.gate_history(w.spark, history).where(F.col("check_name").isin([n for n, _, _ in _DAMAGE])).withColumn("raised", F.lit(raised))


@add("j12_j15_freshness_gates", "layer:s check_name:s severity:s status:s",
     "SELECT 'warehouse' AS layer, 'FRESH_' || upper(s) || '_RUN' AS check_name, 'INFO' AS severity, CASE WHEN date_diff('day', (SELECT max(o_orderdate) FROM orders), TIMESTAMP '2001-08-01') <= 2 "
     "AND s IN ('ingest', 'clean') THEN 'PASS' ELSE 'WARN' END AS status FROM (VALUES ('ingest'), ('clean'), ('transform'), ('load')) AS t(s)")
def _(w):
    newest = w.table("orders").agg(F.expr("max(o_orderdate) as d")).first()["d"]
    runs = reduce(DataFrame.unionByName, [T.run_record(w.spark, s, s, "SUCCESS", newest, newest) for s in ["ingest", "clean"]])
    return gates.freshness_gates(runs, datetime(2001, 8, 1))


@add("j16_j22_analytics_gates", GATE, _gate_sql("analytics", [
    ("KPI_REVENUE_EQUALS_WAREHOUSE", _SUM("net_revenue"), _SUM("net_revenue", "fact_sales"), 1), ("KPI_PROFIT_EQUALS_WAREHOUSE", _SUM("gross_profit"), _SUM("gross_profit", "fact_sales"), 1),
    ("MONTHLY_SERIES_EQUALS_WAREHOUSE", _SUM("net_revenue"), _SUM("net_revenue", "fact_sales"), 1),
    ("BRANCH_SCORECARD_EQUALS_WAREHOUSE", _SUM("net_revenue", "branch_base"), _SUM("net_revenue", "fact_sales"), 1),
    ("EVERY_ANOMALY_HAS_AN_EXPLANATION", "CAST(0 AS DOUBLE)", "CAST(0 AS DOUBLE)", 0), ("BRANCH_SCORES_COMPLETE", "CAST(0 AS DOUBLE)", "CAST(0 AS DOUBLE)", 0)])
    + " UNION ALL SELECT 'analytics', 'LEAKAGE_EXPOSURE_RECORDED', 'INFO', 'PASS', round((SELECT sum(exposure_amount) FROM leak), 2), NULL")
def _(w): return gates.analytics_gates(w.facts(), w.published())


@add("j23_ingest_lag", "landed:i expected:i lag:i reconciled:b", "SELECT count(*) AS landed, count(*) AS expected, 0 AS lag, true AS reconciled FROM events")
def _(w):
    ranges = gates.landing_ranges(_landed(w))
    marks = _event_messages(w).groupBy("topic", "kafka_partition").agg(*map(F.expr, [
        "min(kafka_offset) as low", "max(kafka_offset) + 1 as high", "max(kafka_offset) + 1 as committed"]))
    return gates.ingest_lag(ranges, marks)


@add("j23_lag_behind", "landed:i expected:i lag:i reconciled:b",
     f"SELECT sum(least(n, 2 * step)) AS landed, sum(least(n, 2 * step)) AS expected, sum(greatest(n - 2 * step, 0)) AS lag, true AS reconciled "
     f"FROM (SELECT DISTINCT topic, kafka_partition, top - low + 1 AS n, step FROM {STEP_ROWS})")
def _(w):
    # Two steps only: what the source holds beyond the log is the lag.
    base = f"{w.root}/behind-{uuid.uuid4().hex}"
    _planned(w, base, 2)
    return ranges.lag(w.spark, _source(w), f"{base}/raw", f"{base}/log")


@add("j24_source_totals", "rows:i sales_revenue:d sales_profit:d sales_units:d return_value:d naive_revenue_all_rows:d naive_profit_all_rows:d",
     "SELECT count(*) AS rows, sum(revenue) FILTER (event_type = 'SALE') AS sales_revenue, sum(profit) FILTER (event_type = 'SALE') AS sales_profit, "
     "sum(quantity) FILTER (event_type = 'SALE') AS sales_units, sum(revenue) FILTER (event_type = 'RETURN') AS return_value, sum(revenue) AS naive_revenue_all_rows, "
     "sum(profit) AS naive_profit_all_rows FROM src")
def _(w): return gates.source_totals(_text_events(w))


@add("j24_source_vs_facts", "fact:s source_rows:i fact_rows:i match:b", "SELECT fact, count(*) AS source_rows, count(*) AS fact_rows, true AS match FROM allfacts GROUP BY 1")
def _(w): return gates.source_vs_facts(_text_events(w), w.facts(), FACT_OF_TYPE)


# ================================================================== serving
@add("i01_executive_overview", KPI, KPI_ROWS)
def _(w): return serving.executive_overview(w.kpis()).selectExpr("*", "round(value_numeric, 4) as value")


@add("i02_leakage_by_type", "leakage_type:s findings:i exposure_amount:d annualised_exposure:d kind:s",
     "SELECT leakage_type, count(*) AS findings, round(sum(exposure_amount), 2) AS exposure_amount, round(sum(annualised_exposure), 2) AS annualised_exposure, "
     "CASE WHEN leakage_type = 'LOW_MARGIN_SHORTFALL' THEN 'opportunity' ELSE 'detected' END AS kind FROM leak GROUP BY 1")
def _(w): return serving.leakage_by_type(w.leakage())


FEED_ORDER = "ORDER BY CASE severity WHEN 'critical' THEN 1 WHEN 'high' THEN 2 ELSE 3 END, estimated_exposure DESC NULLS LAST, anomaly_id"


@add("i03_anomaly_feed", ANOMALY, "anomalies")
def _(w): return serving.anomaly_feed(w.anomalies())


@add("i03_top_leakage_findings", ANOMALY, f"SELECT * FROM anomalies WHERE leakage_type IS NOT NULL {FEED_ORDER} LIMIT 4")
def _(w): return serving.anomaly_feed(w.anomalies(), leakage_only=True, limit=4)


@add("i04_sales_detail", "event_id:s event_ts:t full_date:t year_month:s year:i quarter:i branch_id:s city:s product_id:s category:s supplier_id:s quantity:i net_revenue:d gross_profit:d",
     "SELECT f.*, d.full_date, d.year_month, d.year, d.quarter, b.city, p.category, p.supplier_id FROM fact_sales f JOIN dim_date d ON d.date_key = f.date_key "
     "JOIN dim_branch b ON b.branch_id = f.branch_id JOIN dim_product p ON p.product_id = f.product_id")
def _(w): return serving.sales_detail(w.facts()["fact_sales"], w.dims())


STAGES = "'ingest', 'clean', 'transform', 'load', 'features'"


def _runs(w: Workspace) -> DataFrame:
    """Orders read as stage runs: one run per order, the stage by customer, minutes by order key."""
    return w.table("orders").selectExpr(
        "lpad(string(o_orderkey), 12, '0') as run_id", f"element_at(array({STAGES}), int(o_custkey % 5) + 1) as stage",
        "case o_orderstatus when 'F' then 'SUCCESS' else 'FAILED' end as status", "cast(o_orderdate as timestamp) as started_at",
        "cast(o_orderdate + make_dt_interval(0, 0, int(o_orderkey % 60)) as timestamp) as finished_at",
        "o_orderkey as rows_in", "o_orderkey as rows_out", "bigint(0) as rows_rejected", "cast(null as string) as error")


RUNS_SQL = (f"SELECT lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS run_id, [{STAGES}][o_custkey % 5 + 1] AS stage, CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' ELSE 'FAILED' END AS status, "
            "o_orderdate AS started_at, 60.0 * (o_orderkey % 60) AS duration_seconds, o_orderkey AS rows_in FROM orders")
LATEST_SQL = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY stage ORDER BY started_at DESC, run_id DESC) AS rn FROM ({RUNS_SQL})) WHERE rn = 1"


@add("i05_latest_run_per_stage", "stage:s status:s duration_seconds:d rows_in:i",
     LATEST_SQL)
def _(w): return serving.latest_runs(_runs(w))


@add("i06_peer_strip", "entity_id:s value:d n:i median:d scale:d peers:i", "SELECT entity_id, value, n, med AS median, scale, peers FROM points WHERE check_id = 'product_return_rate'")
def _(w): return serving.peer_strip(w.peers(), CFG, "product_return_rate")


@add("i07_nav_counts", "page:s n:i",
     f"SELECT 'leakage' AS page, {_CNT('leak', _DET)} AS n UNION ALL SELECT 'inventory', {_CNT('inventory_risk', chr(39).join(['stockout_risk_level = ', 'high', ' OR reorder_flag']))} "
     f"UNION ALL SELECT 'branches', {_CNT('anomalies', chr(39).join(['entity_type = ', 'branch', '']))} UNION ALL SELECT 'suppliers', {_CNT('anomalies', chr(39).join(['entity_type = ', 'supplier', '']))} "
     f"UNION ALL SELECT 'products', {_CNT('product_flags', 'is_problematic')} UNION ALL SELECT 'health', 0")
def _(w):
    s = w.scorecards()
    checked = w.stage("analytics_gates", lambda: gates.analytics_gates(w.facts(), w.published()))
    return serving.nav_counts(w.leakage(), s["inventory_risk"], w.anomalies(), s["product_scorecard"], checked)


@add("i08_leakage_items", "leakage_type:s entity_id:s exposure_amount:d source_anomaly_id:s severity:s check_id:s observed_value:d baseline_value:d",
     "SELECT l.leakage_type, l.entity_id, l.exposure_amount, l.source_anomaly_id, a.severity, a.check_id, a.observed_value, a.baseline_value FROM leak l "
     "LEFT JOIN anomalies a ON a.anomaly_id = split_part(l.source_anomaly_id, ';', 1)")
def _(w): return serving.leakage_items(w.leakage(), w.anomalies())


@add("i09_top_stockout_risk", "product_id:s stockout_risk_score:d stockout_risk_level:s reorder_flag:b", "SELECT * FROM inventory_risk ORDER BY round(s, 1) DESC, product_id LIMIT 25")
def _(w): return serving.top_stockout(w.scorecards()["inventory_risk"])


@add("i10_risk_levels", "level:s n:i", "SELECT stockout_risk_level AS level, count(*) AS n FROM inventory_risk GROUP BY 1")
def _(w): return serving.risk_levels(w.scorecards()["inventory_risk"])


@add("i10_slow_movers", "product_id:s category:s velocity_per_day:d units_sold_recent:i", "SELECT * FROM inventory_risk WHERE is_slow_moving ORDER BY velocity_per_day NULLS FIRST, product_id LIMIT 15")
def _(w): return serving.slow_movers(w.scorecards()["inventory_risk"])


@add("i11_branch_ranking", SCORE, "branch_scorecard")
def _(w): return serving.branch_ranking(w.scorecards()["branch_scorecard"])


@add("i11_branch_series", "branch_id:s year_month:s net_revenue:d gross_margin:d discount_rate:d return_rate_units:d", "branch_monthly")
def _(w): return serving.branch_series(w.features()["branch_monthly"])


@add("i12_flagged_supplier_series", "supplier_id:s year_month:s ppv_pct:d purchase_spend:d",
     "SELECT * FROM supplier_monthly WHERE supplier_id IN (SELECT supplier_id FROM supplier_scorecard WHERE anomaly_count > 0)")
def _(w): return serving.flagged_supplier_series(w.features()["supplier_monthly"], w.scorecards()["supplier_scorecard"])


_SEG = [("high_margin", "gross_margin DESC", 12), ("low_margin", "gross_margin ASC", 12), ("high_return", "return_rate_units DESC", 12),
        ("high_discount", "discount_rate DESC", 12), ("declining", "growth_rate ASC", 12), ("problematic", "anomaly_count DESC, net_revenue DESC", 25)]


@add("i13_product_segments", "segment:s product_id:s category:s net_revenue:d gross_margin:d discount_rate:d return_rate_units:d growth_rate:d margin_percentile:d anomaly_count:i",
     " UNION ALL ".join(f"SELECT * FROM (SELECT '{n}' AS segment, product_id, category, net_revenue, gross_margin, discount_rate, return_rate_units, growth_rate, margin_percentile, "
                        f"anomaly_count FROM product_flags WHERE is_{n} ORDER BY {o}, product_id LIMIT {k})" for n, o, k in _SEG))
def _(w): return serving.product_segments(w.scorecards()["product_scorecard"])


@add("i14_category_rollup", "category:s products:i net_revenue:d gross_margin:d return_rate:d",
     "SELECT category, count(*) AS products, sum(net_revenue) AS net_revenue, CAST(sum(gross_profit) AS DOUBLE) / nullif(CAST(sum(net_revenue) AS DOUBLE), 0) AS gross_margin, "
     "CAST(sum(return_units) AS DOUBLE) / nullif(CAST(sum(units_sold) AS DOUBLE), 0) AS return_rate FROM product_base GROUP BY 1")
def _(w): return serving.category_rollup(w.scorecards()["product_scorecard"])


@add("i15_segment_counts", "high_margin:i low_margin:i high_return:i high_discount:i declining:i problematic:i total:i",
     "SELECT " + ", ".join(f"count(*) FILTER (is_{n}) AS {n}" for n, *_ in _SEG) + ", count(*) AS total FROM product_flags")
def _(w): return serving.segment_counts(w.scorecards()["product_scorecard"])


@add("i16_flow_funnel", "step:s n:i",
     "SELECT 'published' AS step, raw AS n FROM account UNION ALL SELECT 'landed', raw FROM account UNION ALL SELECT 'accepted', accepted FROM account "
     "UNION ALL SELECT 'rejected', rejected FROM account UNION ALL SELECT 'stored', accepted FROM account")
def _(w): return serving.flow_funnel(w.messages(), w.first_pass(), w.account(), _clean_tables(w)[0])


@add("i16_processing_seconds", "seconds:d", f"SELECT sum(duration_seconds) AS seconds FROM ({LATEST_SQL})")
def _(w): return serving.processing_seconds(serving.latest_runs(_runs(w)))


@add("i17_latest_gate_status", "layer:s check_name:s status:s observed:d",
     "SELECT layer, check_name, status, observed FROM (SELECT event_type AS layer, user_id AS check_name, CASE WHEN value > 50 THEN 'FAIL' ELSE 'PASS' END AS status, value AS observed, "
     "row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC) AS rn FROM events) WHERE rn = 1")
def _(w): return serving.latest_gates(w.table("events").selectExpr(
    "event_type as layer", "string(user_id) as check_name", "'INFO' as severity", "case when value > 50 then 'FAIL' else 'PASS' end as status", "value as observed",
    "cast(null as double) as expected", "props as message", "ts as checked_at"))


@add("i18_quarantine_samples", "event_id:s rule_code:s kafka_topic:s disposition:s",
     "SELECT event_id, rule_code, topic AS kafka_topic, disposition FROM failures WHERE disposition = 'REJECTED' ORDER BY kafka_timestamp, topic, kafka_offset, rule_code LIMIT 8")
def _(w): return serving.quarantine_samples(w.failures())


@add("i19_other_branches_median", "branch_id:s year_month:s discount_rate:d others_median:d",
     "SELECT m.branch_id, m.year_month, m.discount_rate, (list_sort(list(o.discount_rate) FILTER (o.discount_rate IS NOT NULL)))[CAST(floor(count(o.discount_rate) / 2) AS INTEGER) + 1] AS others_median "
     "FROM branch_monthly m LEFT JOIN branch_monthly o ON o.year_month = m.year_month AND o.branch_id <> m.branch_id GROUP BY 1, 2, 3")
def _(w): return serving.other_branches_median(w.features()["branch_monthly"], "discount_rate")


@add("i20_coverage_matrix", "branch_id:s category:s x:d",
     "SELECT branch_id, category, CASE WHEN replenishment_ratio IS NOT NULL THEN greatest(0.0, least(1.0, (replenishment_ratio - lo) / CASE WHEN hi = lo THEN 1 ELSE hi - lo END)) END AS x "
     "FROM inventory_branch_category CROSS JOIN (SELECT v[CAST(floor(len(v) * 0.05) AS INTEGER) + 1] AS lo, v[CAST(floor(len(v) * 0.95) AS INTEGER) + 1] AS hi FROM "
     "(SELECT list_sort(list(replenishment_ratio) FILTER (replenishment_ratio IS NOT NULL)) AS v FROM inventory_branch_category))")
def _(w): return serving.coverage_matrix(w.features()["inventory_branch_category"]).selectExpr("branch_id", "explode(cells) as (category, x)")


@add("i21_overall_coverage", "coverage:d", "SELECT CAST(sum(units_purchased) AS DOUBLE) / CAST(sum(units_sold) AS DOUBLE) AS coverage FROM inventory_movement_monthly")
def _(w): return serving.overall_coverage(w.features()["inventory_movement_monthly"])


@add("i22_score_points", "branch_id:s component:s score:d weight:d points:d", "SELECT branch_id, component, score, weight, score * weight * 100 AS points FROM components")
def _(w): return serving.score_points(w.scorecards()["branch_scorecard"], CFG)


@add("i23_year_on_year", "year_month:s net_revenue:d prior_year:d yoy:d",
     "SELECT year_month, net_revenue, lag(net_revenue, 12) OVER (ORDER BY year_month) AS prior_year, "
     "CAST(net_revenue AS DOUBLE) / CAST(lag(net_revenue, 12) OVER (ORDER BY year_month) AS DOUBLE) - 1 AS yoy FROM company_monthly")
def _(w): return serving.year_on_year(w.features()["company_monthly"])


@add("i24_suppliers_above_standard", "above_standard:i at_standard:i", "SELECT count(*) FILTER (ppv_amount > 1) AS above_standard, count(*) FILTER (ppv_amount <= 1) AS at_standard FROM supplier_base")
def _(w): return serving.suppliers_above_standard(w.scorecards()["supplier_scorecard"])


@add("i25_sales_statistics", "events:i units:i gross:d disc:d rev:d cogs:d gp:d avg_disc:d share_over_20:d share_none:d max_disc:d loss_making:i",
     "SELECT count(*) AS events, sum(quantity) AS units, sum(gross_sales) AS gross, sum(discount_amount) AS disc, sum(net_revenue) AS rev, sum(cogs) AS cogs, sum(gross_profit) AS gp, "
     "CAST(sum(discount_pct) AS DOUBLE) / count(*) AS avg_disc, count(*) FILTER (discount_pct > 0.2) / count(*) AS share_over_20, count(*) FILTER (discount_pct = 0) / count(*) AS share_none, "
     "max(discount_pct) AS max_disc, count(*) FILTER (gross_profit < 0) AS loss_making FROM fact_sales")
def _(w): return serving.sales_statistics(w.facts()["fact_sales"])


@add("i26_returns_statistics", "units:i refund:d impact:d events:i non_restockable:i",
     "SELECT sum(quantity) AS units, sum(refund_value) AS refund, sum(profit_impact) AS impact, count(*) AS events, count(*) FILTER (NOT restockable) AS non_restockable FROM fact_returns")
def _(w): return serving.returns_statistics(w.facts()["fact_returns"])


@add("i26_purchases_statistics", "spend:d ppv:d above_list:i",
     "SELECT sum(spend) AS spend, sum(price_variance_amount) AS ppv, count(*) FILTER (cost_above_list_price) AS above_list FROM fact_purchases")
def _(w): return serving.purchases_statistics(w.facts()["fact_purchases"])


@add("i26_movement_statistics", "movement_type:s units:i value:d", "SELECT movement_type, sum(quantity) AS units, sum(value_at_cost) AS value FROM fact_inventory_movements GROUP BY 1")
def _(w): return serving.movement_statistics(w.facts()["fact_inventory_movements"])


@add("i27_inventory_flags", "reorder:i slow:i dead:i",
     "SELECT count(*) FILTER (reorder_flag) AS reorder, count(*) FILTER (is_slow_moving) AS slow, count(*) FILTER (is_dead_stock) AS dead FROM inventory_risk")
def _(w): return serving.inventory_flags(w.scorecards()["inventory_risk"])


@add("i28_batch_history", "ingest_batch:s messages:i cumulative:i",
     "SELECT ingest_batch, messages, sum(messages) OVER (ORDER BY ingest_batch) AS cumulative FROM (SELECT strftime(ts, '%Y-%m-%d') AS ingest_batch, count(*) AS messages FROM events GROUP BY 1)")
def _(w): return serving.batch_history(_event_messages(w).selectExpr("date_format(kafka_timestamp, 'yyyy-MM-dd') as ingest_batch"))


# ================================================================== streaming
def _stream_of(w: Workspace) -> DataFrame:
    w.messages()
    return landing.message_stream(w.spark, {"format": "parquet", "path": f"{w.root}/messages"})


@add("k01_landing_stream", "topic:s messages:i", "SELECT substr(topic, 8) AS topic, count(*) AS messages FROM msg GROUP BY 1")
def _(w):
    base = f"{w.root}/k1-{uuid.uuid4().hex}"
    landing.land(_stream_of(w), f"{base}/raw", f"{base}/checkpoint").awaitTermination()
    return landing.landed_counts(w.spark.read.parquet(f"{base}/raw"))


def _validated(w: Workspace) -> str:
    if "k2" not in w.staged:
        base = f"{w.root}/k2-{uuid.uuid4().hex}"
        landing.validate_stream(_stream_of(w), RULES_CFG, NOW, w.masters(), f"{base}/accepted", f"{base}/failures", f"{base}/checkpoint").awaitTermination()
        w.staged["k2"] = w.spark.read.parquet(f"{base}/accepted").drop("ingest_batch")
        w.staged["k2_failures"] = w.spark.read.parquet(f"{base}/failures")
        w.paths["k2"] = base
    return w.paths["k2"]


@add("k02_streaming_validation", "rule_code:s failures:i",
     "SELECT rule_code, count(*) AS failures FROM (SELECT unnest(codes) AS rule_code FROM local) GROUP BY 1")
def _(w):
    _validated(w)
    return w.staged["k2_failures"].groupBy("rule_code").agg(F.expr("count(1) as failures"))


@add("k02_streaming_accepted", "event_id:s event_type:s quantity:i revenue:d",
     "SELECT event_id, event_type, t_qty AS quantity, t_revenue AS revenue FROM ranked WHERE cand")
def _(w):
    _validated(w)
    return w.staged["k2"]


@add("k03_streaming_first_copies", "event_id:s", "SELECT DISTINCT event_id FROM ranked WHERE cand")
def _(w):
    # Accepted events arrive in the order of their time, in several micro-batches; the state of a week is kept.
    base = _validated(w)
    out = f"{base}/first-{uuid.uuid4().hex}"
    accepted = w.staged["k2"]
    seconds = F.expr("unix_timestamp(cast(kafka_timestamp as timestamp))")
    cuts = accepted.agg(F.percentile_approx(seconds, [i / 6 for i in range(1, 6)], 1000)).first()[0] or []
    for low, high in zip([None, *cuts], [*cuts, None]):
        part = accepted if low is None else accepted.where(seconds > low)
        (part if high is None else part.where(seconds <= high)).write.mode("append").parquet(f"{out}-ordered")
        query = (landing.first_copies(w.spark.readStream.schema(accepted.schema).parquet(f"{out}-ordered"), "7 days").writeStream.format("parquet").option("path", out)
                 .option("checkpointLocation", f"{out}-checkpoint").trigger(availableNow=True).start())
        query.awaitTermination()
    return w.spark.read.schema(accepted.schema).parquet(out)
