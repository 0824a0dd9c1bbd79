import time

from pyspark.sql import functions as F

from marginwatch.functions.among import PIECE as WIDE_PIECE, may_hold
from marginwatch.llm.common import BATCH_BYTES, PIECE, mark_among, staged, table


def plan(df):
    return df._jdf.queryExecution().analyzed().toString()


def test_bitmap_never_misses_a_key_and_is_looked_up_in_pieces(spark):
    rows = spark.range(0, 40_000).selectExpr("if(id % 50 = 0, null, id) as id", "id as row")
    keys = spark.range(0, 40_000, 7)
    found = mark_among(rows, keys, ["id"])
    assert found.columns == ["id", "row", "among"]
    assert found.where("among is null").count() == 0
    assert found.where("id % 7 = 0 and not among").count() == 0
    assert found.where("id % 7 <> 0 and among").count() < 200
    told = may_hold(rows, {"_may": "id * 1000003", "_other": "id * 1000003 + 5"}, keys.selectExpr("id * 1000003 as h"))
    assert told.where("id is null and (_may or _other)").count() == 0
    assert told.where("id % 7 = 0 and not _may").count() == 0
    assert told.where("id % 7 <> 0 and _may").count() < 200
    assert 0 < PIECE <= 256 and 0 < WIDE_PIECE <= 256  # the bytes that a lookup copies; a whole bucket has 4096
    assert f", {PIECE})" in plan(found) and f", {WIDE_PIECE})" in plan(told)


def test_a_lookup_in_a_bitmap_copies_nothing(spark):
    rows = spark.range(0, 2_000).selectExpr("id", "id as row")
    keys = spark.range(0, 2_000, 3)
    found = mark_among(rows, keys, ["id"])
    told = may_hold(rows, {"_may": "xxhash64(id)"}, keys.selectExpr("xxhash64(id) as h"))
    for df in (found, told):
        assert "substring(" not in plan(df) and "decode" not in plan(df)
    for slots in ("0L", "63L", "64L", "511L", "512L", "-1L"):  # first and last bits of words, pieces and the bitmap
        one = may_hold(spark.range(1).selectExpr("0 as row"), {"_same": slots, "_next": f"{slots} + 1"}, spark.range(1).selectExpr(f"{slots} as h")).first()
        assert one._same and not one._next


def test_batches_for_python_are_bounded_by_bytes(spark, tmp_path):
    spark.range(0, 3_000, 1, 1).selectExpr("id", "repeat('x', 20000) as text").write.parquet(f"{tmp_path}/documents.parquet")

    def sizes(batches):
        for b in batches:
            yield b.select(["id"]).slice(0, 1).set_column(0, "id", __import__("pyarrow").array([b.nbytes]))

    found = [r.id for r in table(spark, str(tmp_path), "documents").mapInArrow(sizes, "id long").collect()]
    assert sum(found) > 60_000_000 and max(found) < 2 * BATCH_BYTES


def test_a_staged_table_leaves_no_shuffle_files(spark):
    def shuffle_files():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(k).getName() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_")}

    before = shuffle_files()
    rows = spark.range(1_000).groupBy((F.col("id") % 7).alias("k")).count()  # the reference keeps its shuffle from the garbage
    found = staged(rows.join(rows.withColumnRenamed("count", "n"), "k"), "shuffled")
    for _ in range(50):  # files go in the background
        if not (left := shuffle_files() - before):
            break
        time.sleep(0.2)
    assert not left
    assert found.count() == 7 and rows.count() == 7
