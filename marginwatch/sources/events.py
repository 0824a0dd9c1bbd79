"""Reading events in and encoding them as messages."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEAD_LETTER, EVENT_FIELDS, SCHEMA_VERSION, TOPIC_OF_TYPE

NUMERIC = {"quantity": "int", **dict.fromkeys(
    ["unit_cost", "unit_price", "discount_pct", "revenue", "purchase_cost", "profit", "event_value"], "double")}
RAW_SCHEMA = ("topic string, kafka_partition int, kafka_offset bigint, kafka_timestamp timestamp_ntz, key string, value string")


def read_event_csv(spark: SparkSession, path: str, first: int | None = None, ordered: bool = False) -> DataFrame:
    """The 17 contract columns as text, blanks null. Typing is left to validation, which is where bad
    values are judged. `ordered` sorts by (timestamp, id), as a replay wants; `first` replays only the
    oldest rows."""
    schema = ", ".join(f"{c} string" for c in EVENT_FIELDS)
    df = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
    df = df.select(*[F.nullif(c, F.lit("")).alias(c) for c in EVENT_FIELDS])
    if ordered or first:
        df = df.orderBy("event_timestamp", "event_id")
    return df.limit(first) if first else df


def route(event_type: Column) -> Column:
    """Short topic of an event type; unknown or missing types go to the dead-letter topic."""
    return F.coalesce(*[F.when(event_type == t, F.lit(topic)) for t, topic in TOPIC_OF_TYPE.items()], F.lit(DEAD_LETTER))


def _json_text(col: Column) -> Column:
    """A text value as a quoted, escaped JSON string."""
    boxed = F.to_json(F.array(col))
    return F.substring(boxed, F.lit(2), F.length(boxed) - 2)


def _json_member(name: str) -> Column:
    text = F.col(name).cast("string")
    quoted = _json_text(text)
    if name in NUMERIC:
        number = text.try_cast(NUMERIC[name]).cast("string")
        # A number that cannot be converted stays the text that was sent: validation judges it.
        quoted = F.when(number.isNotNull() & ~number.isin("NaN", "Infinity", "-Infinity"), number).otherwise(quoted)
    return F.concat(F.lit(f'"{name}":'), F.when(text.isNull(), F.lit("null")).otherwise(quoted))


def encode_events(events: DataFrame, prefix: str = "retail") -> DataFrame:
    """topic, key, value: compact JSON with the schema version, numbers as JSON numbers, absent
    values null; keyed by branch so a branch stays ordered within a partition."""
    kept = [c for c in events.columns if c not in EVENT_FIELDS]
    texts = events.select(*[F.col(c).cast("string").alias(c) for c in EVENT_FIELDS], *kept)
    told = texts.withColumns({f"_{c}": F.col(c).try_cast(kind) for c, kind in NUMERIC.items()})
    # One generator writes a row whose numbers all convert; only another row is put together field by field.
    numbers = " and ".join(f"({c} is null or coalesce(abs(_{c}) < double('infinity'), false))" for c in NUMERIC)
    whole = F.struct(F.lit(SCHEMA_VERSION).alias("schema_version"), *[F.col(f"_{c}" if c in NUMERIC else c).alias(c) for c in EVENT_FIELDS])
    pieces = F.concat(F.lit(f'{{"schema_version":{SCHEMA_VERSION},'), F.concat_ws(",", *[_json_member(c) for c in EVENT_FIELDS]), F.lit("}"))
    body = F.when(F.expr(numbers), F.to_json(whole, {"ignoreNullFields": "false"})).otherwise(pieces)
    return told.select(F.concat(F.lit(prefix + "."), route(F.col("event_type"))).alias("topic"),
                       F.nullif("branch_id", F.lit("")).alias("key"), body.alias("value"), *kept)


def write_messages(messages: DataFrame, target: dict) -> None:
    """To Kafka (`{"format": "kafka", "options": {...}}`) or to a directory partitioned by topic."""
    if target.get("format") == "kafka":
        messages.write.format("kafka").options(**target["options"]).save()
    else:
        messages.write.mode(target.get("mode", "append")).partitionBy("topic").parquet(target["path"])


def read_jdbc(spark: SparkSession, url: str, table: str, as_of: str | None = None, split: tuple[str, object, object, int] | None = None,
              **options: str) -> DataFrame:
    """A warehouse table. `split` = (column, lower, upper, partitions) reads it in parallel; the
    as-of cut is a plain comparison, so it is pushed to the database."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", 20000).options(**options)
    if split:
        column, lower, upper, parts = split
        reader = (reader.option("partitionColumn", column).option("lowerBound", str(lower)).option("upperBound", str(upper))
                  .option("numPartitions", parts))
    df = reader.load()
    if as_of:
        # JDBC sources return timestamps with a zone or without; compare in the column's own type.
        kind = dict(df.dtypes)["event_ts"]
        df = df.where(F.col("event_ts") < F.date_add(F.lit(as_of).cast("date"), 1).cast(kind))
    return df


def write_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Staging write: truncate and refill, batched."""
    (df.write.format("jdbc").option("url", url).option("dbtable", table).option("truncate", True).option("batchsize", 10000)
     .options(**options).mode("overwrite").save())
