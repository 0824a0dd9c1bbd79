"""The star-schema tables seen as retail events, and the staged tables derived from them.

`source_events` is the mapping: order lines become sales, returns, purchases, adjustments and
damage, parts become price observations. `source_messages` is the same stream as raw messages
in which a few order keys carry one known fault each, so that every rule has rows to find.
Both cover whole tables; a fault changes a row, it never drops one.
"""
from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ANALYTICS, EVENT_FIELDS, RULES, override
from ..operators import detection, features, finance, model, scoring, validation
from ..sources.events import encode_events

NOW = datetime(2026, 10, 5, 12, 0, 0)
REASONS = RULES["return_reasons"]

# Identifiers follow the tables' own keys, which are longer than the contract's defaults.
RULES_CFG = override(
    RULES,
    id_patterns={"event_id": "^[0-9a-f]{32}$", "branch_id": "^BR[0-9]{2}$", "product_id": "^P[0-9]+$", "supplier_id": "^SUP[0-9]+$"},
    timestamp__earliest="1990-01-01")

# The tables are uniform: the defaults would find nothing, so the thresholds are lowered.
_FLOORS = {"discount_rate": 0.0005, "return_rate_units": 0.005, "adjustment_avg_qty": 0.25, "damage_rate": 0.003,
           "gross_margin": 0.0005, "ppv_pct": 0.0005}
_Z = {"medium": 1.0, "high": 2.0, "critical": 3.0}
CFG = override(
    ANALYTICS,
    anomaly__severity_z=_Z,
    anomaly__peer_checks=[{**c, "min_scale": _FLOORS[c["metric"]], "min_abs_effect": 0.0, "min_n": 5, "severity_z": _Z}
                          for c in ANALYTICS["anomaly"]["peer_checks"]],
    anomaly__temporal_checks=[{**c, "min_std": _FLOORS[c["metric"]], "min_abs_effect": 0.0, "z_threshold": 1.0}
                              for c in ANALYTICS["anomaly"]["temporal_checks"]],
    product__min_sale_events=5)


def _md5(*parts: Column) -> Column:
    return F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]).cast("binary"))


def _hash_offset(key: Column) -> Column:
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("bigint")


KINDS = ["SALE", "RETURN", "PURCHASE", "STOCK_ADJUSTMENT", "DAMAGE"]
_KINDS = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
# Line fields that travel as one number: name -> (SQL text as a whole number, how many values it may take, SQL text back).
_DAY = "timestamp_ntz '1970-01-01 00:00:00'"
PACKED = {
    "line": ("bigint(line)", 100, "int({})"),
    "quantity": ("bigint(quantity)", 1_000, "int({})"),
    "discount_pct": ("bigint(discount_pct * 10000)", 10_001, "cast({} / 10000BD as decimal(7,4))"),
    "tax": ("bigint(tax * 100)", 1_001, "cast({} / 100BD as decimal(4,2))"),
    "kind": (f"bigint(array_position({_KINDS}, kind) - 1)", len(KINDS),
             "case {} " + " ".join(f"when {i} then '{k}'" for i, k in enumerate(KINDS)) + " end"),
    "shipped": (f"bigint(datediff(shipped, {_DAY}))", 40_000, f"{_DAY} + make_dt_interval(int({{}}))"),
}


def pack(rows: DataFrame) -> DataFrame:
    """rows with the fields of PACKED in one number, `packed`, so that a shuffle moves less. A row with a
    value that does not fit (null, out of range, a time of day) keeps its fields, and `packed` is null."""
    number = "0L"
    for n, (_, k, _) in PACKED.items():
        number = f"({number} * {k} + _w.{n})"
    whole = "named_struct(" + ", ".join(f"'{n}', {e}" for n, (e, _, _) in PACKED.items()) + ")"
    fits = " and ".join(f"_w.{n} between 0 and {k - 1}" for n, (_, k, _) in PACKED.items())
    exact = "shipped = cast(cast(shipped as date) as timestamp_ntz)"
    told = rows.withColumn("_w", F.expr(whole)).withColumn("packed", F.expr(f"case when {fits} and {exact} then {number} end"))
    kept = [c for c in rows.columns if c not in PACKED]
    return told.selectExpr(*kept, "packed", *[f"case when packed is null then {n} end as {n}" for n in PACKED])


def unpack(rows: DataFrame) -> DataFrame:
    """The rows that `pack` was given."""
    back, below = {}, 1
    for n, (_, k, e) in reversed(PACKED.items()):
        back[n] = e.format(f"((packed div {below}) % {k})")
        below *= k
    kept = [c for c in rows.columns if c not in PACKED and c != "packed"]
    return rows.selectExpr(*kept, *[f"coalesce({back[n]}, {n}) as {n}" for n in PACKED])


#: What event_id is made of, besides columns that a source row has anyway: of a line its day and number, of a price neither.
ID_PARTS = ["shipped", "line"]


def with_event_id(rows: DataFrame) -> DataFrame:
    """Rows of `source_rows` with event_id, as first column and in the place of ID_PARTS. It follows from the others: 32
    characters that nothing compresses are not stored, and not made for readers that don't want them."""
    product, supplier = F.expr("substring(product_id, 2)"), F.expr("substring(supplier_id, 4)")
    event_id = F.when(F.col("event_type") == "PRICE_CHANGE", F.md5(F.concat(F.lit("price|"), product).cast("binary"))).otherwise(
        _md5(F.col("fault_key"), product, supplier, F.col("line"), F.col("quantity"), F.col("shipped")))
    return rows.select(event_id.alias("event_id"), *[c for c in rows.columns if c not in ID_PARTS])


def source_events(tables: Callable[[str], DataFrame]) -> DataFrame:
    """Typed contract fields (event_ts instead of event_timestamp) + `fault_key`."""
    return with_event_id(source_rows(tables))


def source_rows(tables: Callable[[str], DataFrame]) -> DataFrame:
    """`source_events` with ID_PARTS instead of event_id."""
    dec = "decimal(12,2)"
    part = tables("part").select("p_partkey", "p_type", F.col("p_retailprice").cast(dec).alias("retail"))
    nation = tables("nation").select("n_nationkey", "n_name")
    branch = (tables("orders").select("o_orderkey", "o_custkey")
              .join(tables("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
              .select("o_orderkey", F.col("c_nationkey").alias("n_nationkey")))
    line = F.col("l_linenumber")
    kind = (F.when(F.col("l_returnflag") == "N", "SALE").when(F.col("l_returnflag") == "R", "RETURN")
            .when(F.col("l_linestatus") == "O", "PURCHASE").when(line % 2 == 1, "STOCK_ADJUSTMENT").otherwise("DAMAGE"))
    li = pack(tables("lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", line.alias("line"), F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_discount").cast("decimal(7,4)").alias("discount_pct"), F.col("l_tax").cast("decimal(4,2)").alias("tax"),
        kind.alias("kind"), F.col("l_shipdate").cast("timestamp_ntz").alias("shipped")))
    line, kind = F.col("line"), F.col("kind")
    pct = lambda n: (n.cast("decimal(4,0)") / 100).cast("decimal(4,2)")
    book = F.col("retail") * F.lit("0.70").cast("decimal(3,2)")
    # Orders first, parts last and by sort: the rows leave the join next to those of their product, still narrow.
    joined = (li.join(branch, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
              .join(part.hint("merge"), F.col("l_partkey") == F.col("p_partkey")))
    lines = (unpack(joined)
             .select(*ID_PARTS, (F.col("shipped") + F.make_dt_interval(F.lit(0), line)).alias("event_ts"), kind.alias("event_type"),
                     "n_nationkey", F.concat(F.lit("P"), "l_partkey").alias("product_id"), F.col("p_type").alias("category"),
                     F.concat(F.lit("SUP"), "l_suppkey").alias("supplier_id"), "quantity",
                     (book * (1 + F.when(kind == "PURCHASE", F.col("tax")).otherwise(pct(line % 3)))).cast(dec).alias("unit_cost"),
                     (F.col("retail") * (1 + pct(line % 4))).cast(dec).alias("unit_price"), "discount_pct",
                     F.when(kind == "RETURN", F.element_at(F.array(*[F.lit(r) for r in REASONS]), (line % 5 + 1).cast("int"))).alias("return_reason"),
                     F.col("l_orderkey").alias("fault_key")))
    key = F.col("p_partkey")
    prices = part.select(
        F.lit(None).cast("timestamp_ntz").alias("shipped"), F.lit(None).cast("int").alias("line"),
        (F.lit("1998-01-01").cast("timestamp_ntz") + F.make_dt_interval((key % 365).cast("int"))).alias("event_ts"),
        F.lit("PRICE_CHANGE").alias("event_type"), (key % 25).cast("int").alias("n_nationkey"),
        F.concat(F.lit("P"), key).alias("product_id"), F.col("p_type").alias("category"),
        F.concat(F.lit("SUP"), key % 10).alias("supplier_id"), F.lit(1).alias("quantity"), book.cast(dec).alias("unit_cost"),
        (F.col("retail") * F.lit("1.02").cast("decimal(3,2)")).cast(dec).alias("unit_price"),
        F.lit(0).cast("decimal(7,4)").alias("discount_pct"), F.lit(None).cast("string").alias("return_reason"), key.alias("fault_key"))
    money = "decimal(16,2)"
    revenue = (F.col("quantity") * F.col("unit_price") * (1 - F.col("discount_pct"))).cast(money)
    cost = (F.col("quantity") * F.col("unit_cost")).cast(money)
    valued = (lines.unionByName(prices).join(nation, "n_nationkey")
              .withColumn("revenue", revenue).withColumn("purchase_cost", cost)
              .withColumn("profit", (F.col("revenue") - F.col("purchase_cost")).cast(money)))
    value = (F.when(F.col("event_type") == "PURCHASE", F.col("purchase_cost"))
             .when(F.col("event_type") == "PRICE_CHANGE", F.col("unit_price")).otherwise(F.col("revenue")))
    return valued.select(
        *ID_PARTS, "event_ts", "event_type", F.concat(F.lit("BR"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("branch_id"),
        F.col("n_name").alias("city"), "product_id", "category", "supplier_id", "quantity",
        F.col("unit_cost").cast(money).alias("unit_cost"), F.col("unit_price").cast(money).alias("unit_price"), "discount_pct",
        "revenue", "purchase_cost", "profit", value.cast(money).alias("event_value"), "return_reason", "fault_key")


def accepted_events(source: DataFrame) -> DataFrame:
    """The source rows in the accepted-event shape (all of them are valid)."""
    return source.drop("fault_key").select(
        "*", F.lit("retail").alias("kafka_topic"), F.lit(0).alias("kafka_partition"), _hash_offset(F.col("event_id")).alias("kafka_offset"),
        F.col("event_ts").alias("kafka_timestamp"), F.lit(False).alias("has_warning"))


# ------------------------------------------------------------------ raw messages with faults
# fault number (fault_key mod 97) -> (field, SQL text of its new value); each a fixed test value.
FAULTS = {
    0: ("event_id", "null"),
    1: ("event_id", "concat('X-', event_id)"),
    2: ("event_type", "'REFUND'"),
    3: ("quantity", "'-3'"),
    4: ("quantity", "'0'"),
    5: ("quantity", "'2.5'"),
    6: ("branch_id", "'BRANCH-7'"),
    7: ("product_id", "'PROD1'"),
    8: ("supplier_id", "'S-9'"),
    9: ("unit_price", "'0.0'"),
    10: ("unit_cost", "'-12.5'"),
    11: ("discount_pct", "'1.4'"),
    12: ("event_timestamp", "'2099-01-01 00:00:00'"),
    13: ("event_timestamp", "'yesterday-ish'"),
    14: ("revenue", "cast(cast(revenue as decimal(16,2)) + 100 as varchar(40))"),
    15: ("purchase_cost", "cast(cast(purchase_cost as decimal(16,2)) + 77 as varchar(40))"),
    16: ("profit", "cast(cast(profit as decimal(16,2)) + 500 as varchar(40))"),
    17: ("return_reason", "null"),
    18: ("return_reason", "'Felt like it'"),
    19: ("city", "'  '"),
    20: ("category", "'Imaginary Category'"),
    21: ("city", "'Atlantis'"),
    26: ("unit_price", "'1.00'"),
}
MALFORMED, DUPLICATE, WRONG_TOPIC, TWIN = 22, 23, 24, 27


def source_messages(source: DataFrame) -> DataFrame:
    """Raw rows (topic, kafka_partition, kafka_offset, kafka_timestamp, key, value)."""
    fault = F.col("fault_key") % 97
    # A product keeps one supplier here, so that there is master data to conflict with.
    supplier = F.concat(F.lit("SUP"), (F.substring("product_id", 2, 20).cast("bigint") % 100).cast("string"))
    text = source.select(
        fault.alias("fault"), F.col("event_ts").alias("kafka_timestamp"), F.col("event_id").alias("origin"),
        F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss").alias("event_timestamp"), supplier.alias("supplier_id"),
        *[F.col(c).cast("string").alias(c) for c in EVENT_FIELDS if c not in {"event_timestamp", "supplier_id"}])
    # A repeat (same id) and a twin (new id, same business key) arrive a day later. One pass over the source gives all three.
    copies = F.expr(f"case fault when {DUPLICATE} then array('first', 'again') when {TWIN} then array('first', 'twin') else array('first') end")
    rows = text.select("*", F.explode(copies).alias("copy")).withColumn(
        "event_id", F.when(F.col("copy") == "twin", F.md5(F.concat(F.lit("twin|"), "event_id").cast("binary"))).otherwise(F.col("event_id")))
    sent = {c: F.col(c) for c in EVENT_FIELDS}
    for n, (field, expr) in FAULTS.items():
        sent[field] = F.when(F.col("fault") == n, F.expr(expr)).otherwise(sent[field])
    later = F.when(F.col("copy") == "first", F.col("kafka_timestamp")).otherwise(
        F.col("kafka_timestamp") + F.make_dt_interval(F.lit(1)))
    broken = rows.select(*[c.alias(n) for n, c in sent.items()], "fault", later.alias("kafka_timestamp"),
                         _hash_offset(F.concat_ws("|", "copy", "origin")).alias("kafka_offset"), F.lit(0).alias("kafka_partition"))
    sent_as = encode_events(broken)
    cut_off = F.concat(F.lit('{"event_id": "'), F.col("kafka_offset").cast("string"), F.lit('", "quantity": '))
    bad = F.col("fault") == MALFORMED
    return sent_as.select(
        F.when(bad, "retail.dead_letter").when(F.col("fault") == WRONG_TOPIC, "retail.returns").otherwise(F.col("topic")).alias("topic"),
        "kafka_partition", "kafka_offset", "kafka_timestamp", "key", F.when(bad, cut_off).otherwise(F.col("value")).alias("value"))


def event_messages(events: DataFrame) -> DataFrame:
    """The stream table as raw messages: four partitions of consecutive offsets a topic."""
    return events.select(
        F.lit("retail.events").alias("topic"), (F.col("event_id") % 4).cast("int").alias("kafka_partition"),
        F.expr("event_id div 4").alias("kafka_offset"), F.col("ts").cast("timestamp_ntz").alias("kafka_timestamp"),
        F.col("user_id").cast("string").alias("key"), F.to_json(F.struct("event_id", "event_type", "value", "props")).alias("value"))


# ------------------------------------------------------------------ staged tables
FEATURES = ["company_monthly", "branch_monthly", "supplier_monthly", "inventory_movement_monthly", "inventory_branch_category",
            "branch_base", "product_base", "supplier_base", "inventory_base"]


_FALLBACK: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names. A session with local executors, as in tests, may leave
    it unset and gets a temporary one; anywhere else that is an error, since executors would write
    to their own disks."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _FALLBACK.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="spark-"))


class Workspace:
    """Derived tables of one data directory, each written once per application to the shared
    folder and read back: lineage is cut, later reads prune columns, and file sizes give the
    optimizer real statistics for its broadcast decisions."""

    _open: dict[tuple[str, str], "Workspace"] = {}

    def __init__(self, spark: SparkSession, data_dir: str) -> None:
        self.spark, self.data_dir = spark, data_dir
        # A longer method is one that HotSpot interprets; Spark then splits the expressions into short ones instead.
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
        # Shuffle files go when their query ends, and not when the driver happens to collect its garbage.
        spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
        key = hashlib.md5(data_dir.encode()).hexdigest()[:12]
        self.root = f"{shared_dir(spark)}/marginwatch/{spark.sparkContext.applicationId}/{key}"
        self.staged: dict[str, DataFrame] = {}
        self.values: dict[str, date] = {}
        self.paths: dict[str, str] = {}
        self.built: dict[str, dict[str, DataFrame]] = {}
        self._evaluated: DataFrame | None = None

    @classmethod
    def of(cls, spark: SparkSession, data_dir: str) -> "Workspace":
        key = (spark.sparkContext.applicationId, str(data_dir))
        if key not in cls._open:
            cls._open[key] = cls(spark, str(data_dir))
        return cls._open[key]

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.data_dir}/{name}.parquet")

    def stage(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self.staged:
            path = f"{self.root}/{name}"
            build().write.mode("overwrite").option("compression", "zstd").parquet(path)
            self.staged[name] = self.spark.read.parquet(path)
        return self.staged[name]

    def value(self, name: str, compute: Callable[[], date]) -> date:
        """One scalar of the data, computed once."""
        if name not in self.values:
            self.values[name] = compute()
        return self.values[name]

    def tables(self, names: list[str], build: Callable[[], dict[str, DataFrame]]) -> dict[str, DataFrame]:
        """Independent tables, written as concurrent jobs so that small ones share the cluster."""
        if any(n not in self.staged for n in names):
            built = build()
            with ThreadPoolExecutor(max_workers=4) as pool:
                list(pool.map(lambda n: self.stage(n, lambda: built[n]), names))
        return {n: self.staged[n] for n in names}

    # -- accepted events, star schema
    def source(self) -> DataFrame:
        """Written as the join with the parts leaves it: rows of one product lie together, so that what is summed
        by product is summed before it is shuffled, and files are small."""
        return with_event_id(self.stage("source", lambda: source_rows(self.table)))

    def events(self) -> DataFrame:
        """A projection of the stored source: it adds lineage columns, which only few readers need."""
        return accepted_events(self.source())

    def dims(self) -> dict[str, DataFrame]:
        names = ["dim_date", "dim_supplier", "dim_branch", "dim_product"]
        return self.tables(names, lambda: {n: getattr(model, n)(self.events()) for n in names})

    def facts(self) -> dict[str, DataFrame]:
        """Facts that need no other table are projections of the stored source; those that borrow columns of the
        product dimension are written once."""
        if "facts" not in self.built:
            facts = model.build_facts(self.events(), self.dims()["dim_product"], CFG["returns"]["non_restockable_reasons"])
            joined = [f"fact_{n}" for n, (_, borrowed, _) in model.SHAPES.items() if borrowed]
            self.built["facts"] = facts | self.tables(joined, lambda: {n: facts[n] for n in joined})
        return self.built["facts"]

    def stored_facts(self) -> dict[str, DataFrame]:
        """Every fact table as written, for the checks of what was written."""
        facts = self.facts()
        names = {n: n if n in self.staged else f"stored_{n}" for n in model.FACTS}
        stored = self.tables(list(names.values()), lambda: {names[n]: facts[n] for n in model.FACTS})
        return {n: stored[names[n]] for n in model.FACTS}

    def moves(self) -> DataFrame:
        return features.movements(self.facts())

    def day(self) -> date:
        return self.value("day", lambda: features.as_of(self.facts()))

    def period_start(self) -> date:
        return self.value("period_start", lambda: self.features()["branch_base"].agg(F.min("period_start")).first()[0])

    # -- analytics
    def features(self) -> dict[str, DataFrame]:
        return self.tables(FEATURES, lambda: features.build_features(self.facts(), self.dims(), CFG, self.day()))

    def peers(self) -> dict[str, DataFrame]:
        f = self.features()
        return {e: f[f"{e}_base"] for e in detection.ID}

    def series(self) -> dict[str, DataFrame]:
        f = self.features()
        return {"branch": f["branch_monthly"], "supplier": f["supplier_monthly"]}

    def anomalies(self) -> DataFrame:
        return self.stage("anomalies", lambda: detection.detect_all(self.features(), CFG, self.period_start(), self.day()))

    def scorecards(self) -> dict[str, DataFrame]:
        def build() -> dict[str, DataFrame]:
            f, a = self.features(), self.anomalies()
            return {"branch_scorecard": scoring.score_branches(f["branch_base"], a, CFG),
                    "supplier_scorecard": scoring.score_suppliers(f["supplier_base"], a),
                    "product_scorecard": scoring.flag_products(f["product_base"], a, CFG),
                    "inventory_risk": scoring.score_inventory(f["inventory_base"], CFG)}
        return self.tables(["branch_scorecard", "supplier_scorecard", "product_scorecard", "inventory_risk"], build)

    def leakage(self) -> DataFrame:
        return self.stage("revenue_leakage", lambda: finance.leakage(
            self.anomalies(), self.scorecards()["product_scorecard"], CFG, self.period_start(), self.day()))

    def build_kpis(self) -> DataFrame:
        f, s = self.features(), self.scorecards()
        return finance.kpis(f["company_monthly"], s["branch_scorecard"], s["product_scorecard"], s["supplier_scorecard"],
                            s["inventory_risk"], self.anomalies(), self.leakage(), self.period_start(), self.day())

    def kpis(self) -> DataFrame:
        return self.stage("kpi_summary", self.build_kpis)

    def published(self) -> dict[str, DataFrame]:
        f = self.features()
        return {**{n: f[n] for n in FEATURES if not n.endswith("_base")}, **self.scorecards(), "anomalies": self.anomalies(),
                "revenue_leakage": self.leakage(), "kpi_summary": self.kpis()}

    # -- raw messages and validation
    def messages(self) -> DataFrame:
        """Straight from the tables unless the source is stored already: validation reads nothing else of it."""
        return self.stage("messages", lambda: source_messages(self.source() if "source" in self.staged else source_events(self.table)))

    def evaluated(self) -> DataFrame:
        """Not written itself: a join of the staged first pass and the staged repeats."""
        if self._evaluated is None:
            self._evaluated = validation.evaluate(validation.parse_events(self.messages()), RULES_CFG, NOW,
                                                  stage=lambda name, df: self.stage(name, lambda: df))
        return self._evaluated

    def first_pass(self) -> DataFrame:
        """Every message with the failures that need no other row's verdict."""
        self.evaluated()
        return validation.add_conflicts(self.staged["first_pass"], RULES_CFG, NOW, self.masters(), self.staged["conflicting"])

    def repeats(self) -> DataFrame:
        self.evaluated()
        return self.staged["repeats"]

    def masters(self) -> tuple[DataFrame, DataFrame]:
        """Of the messages, parsed for the fields of the master tables alone; nothing is judged for them."""
        if "branch_master" not in self.staged:
            stage = lambda name, df: self.stage(name, lambda: df)
            parsed = validation.parse_events(self.messages(), validation.MASTER_FIELDS)
            validation.masters(parsed, RULES_CFG, stage, stage("master_counts", validation.master_counts(parsed)))
        return self.staged["product_master"], self.staged["branch_master"]

    def judged(self) -> DataFrame:
        """Every message with its verdict: the staged first pass, of which only rows that may repeat are joined with
        the staged repeats. Not written a second time."""
        return self.evaluated()

    def clean_events(self) -> DataFrame:
        """Accepted messages as typed events, written once for the tables and gates that read them again and again."""
        return self.stage("clean_events", lambda: validation.accepted(self.judged()))

    def failures(self) -> DataFrame:
        return validation.failure_log(self.judged(), RULES_CFG)

    def account(self) -> DataFrame:
        return self.stage("account", lambda: validation.accounting(self.judged()))
