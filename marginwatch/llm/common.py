"""Reading the given tables, and tables kept in the folder that all executors share."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The contract's white space, as a regular expression of both Java and DuckDB.
WHITE = r"[\x20\x09-\x0D]+"

_test_folders: dict[str, str] = {}


#: Bytes of a batch that a task hands to Python. Ten thousand rows of long texts, Spark's own bound, take much more.
BATCH_BYTES = 4 << 20


def prepare(spark: SparkSession) -> None:
    """From here on the session bounds batches for Python by bytes, and a query's shuffle files go when it ends. Else they
    stay until the driver happens to collect its garbage, and a join in many steps holds those of all its steps."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, in a prepared session."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below spark.checkpoint.dir. Only a local session without that setting, as in
    tests, gets a temporary folder; a cluster without it is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _test_folders.setdefault(context.applicationId, tempfile.mkdtemp(prefix="spark-llm-"))
    return f"{root.rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once and read back: lineage ends here, and a lost executor costs a re-read."""
    prepare(df.sparkSession)
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: log2 of the bits that mark_among spends: 2**25 bits are 4 MB to broadcast, however large the input.
FILTER_BITS = 25
#: Bytes of the bitmap in one broadcast row, held as words of 64 bits: a lookup reads one of them and copies nothing.
PIECE = 64


def unused(name: str, columns: list[str]) -> str:
    """name, or as many underscores before it as make it none of columns (in any case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def mark_among(rows: DataFrame, keys: DataFrame, columns: list[str], name: str = "among") -> DataFrame:
    """rows with a boolean, called name: whether these columns' values may be among those of keys. A bitmap
    of fixed size decides, so that rows are not shuffled; it may say yes wrongly, never no. name must not be a
    column of rows (unused gives one); the helper columns take names that rows does not have."""
    if name.lower() in {c.lower() for c in rows.columns}:
        raise ValueError(f"{name} is a column of these rows")
    bucket, bitmap, at = (unused(c, rows.columns) for c in ("_bucket", "_bits", "_at"))
    slot = F.pmod(F.xxhash64(*columns), F.lit(1 << FILTER_BITS))
    words = [F.expr(f"bit_or(if(_slot % {8 * PIECE} div 64 = {k}, shiftleft(1L, int(_slot % 64)), 0L))") for k in range(PIECE // 8)]
    bits = keys.select(slot.alias("_slot")).groupBy(F.expr(f"_slot div {8 * PIECE}").alias(bucket)).agg(*[w.alias(f"_w{k}") for k, w in enumerate(words)])
    bits = bits.select(bucket, F.array(*[f"_w{k}" for k in range(PIECE // 8)]).alias(bitmap))
    met = rows.withColumn(at, slot).withColumn(bucket, F.expr(f"{at} div {8 * PIECE}")).join(F.broadcast(bits), bucket, "left")
    return met.withColumn(name, F.expr(f"coalesce(getbit({bitmap}[int({at} % {8 * PIECE} div 64)], int(pmod({at}, 64L))) = 1, false)")).drop(bucket, bitmap, at)
