"""From documents to packed sequences, in five stages.

Each stage reads what the one before it wrote. The first four return the columns of documents, whatever
further ones those have and however they are called: they are set aside while an operator runs. An empty
table gives no row in any stage.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marginwatch.llm.common import mark_among, staged, table
from marginwatch.llm.line_dedup import line_dedup
from marginwatch.llm.mixing import mix
from marginwatch.llm.packing import pack_documents
from marginwatch.llm.parity_join import jaccard_components
from marginwatch.llm.quality import classify, grades_of
from marginwatch.llm.tokens import vocabulary_path


#: Columns that the stages read; all others are only carried.
READ = ("doc_id", "text", "source", "lang", "n_chars")


def _aside(docs: DataFrame) -> tuple[DataFrame, list[Column]]:
    """docs with every column that no stage reads under a name of ours, and the columns that give them back."""
    names = {c: c if c in READ else f"_carried_{k}" for k, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), [F.col(new).alias(old) for old, new in names.items()]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely good than not; without labels, all.

    A null or empty text is graded by its lack of words; a long one is read whole. Rows that repeat a text
    share its grade. Labels without an id or grade are left out of the fit.
    """
    docs, back = _aside(docs)
    return classify(docs, grades_of(table(spark, sf_dir, "labels"))).where("accepted").select(*back)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat an earlier one, short ones exactly; those that lose all of their text go.

    A null or empty text has lost nothing and stays. The first line of a class stays, by (id, place), a null
    id first; rows that repeat id and text keep the same lines. A long text is cut like any other.
    """
    docs, back = _aside(docs)
    left = line_dedup(docs, exact_chars=1).where("n_dropped = 0 or text rlike '[^\\\\x20\\\\x09-\\\\x0D]'")
    return left.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*back)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near duplicates: five-word shingles, 0.8.

    A null or empty text is in no group and stays, as does a null id. Rows that repeat an id are one document
    and stay or go together. Texts are compared whole.
    """
    docs, back = _aside(docs)
    gone = staged(jaccard_components(docs).where("component_id <> doc_id").select("doc_id"), "near-duplicates")
    marked = mark_among(docs, gone, ["doc_id"])
    return marked.where("not among").select(*back).union(marked.where("among").join(gone, "doc_id", "left_anti").select(*back))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with flattened shares of source, language and topic.

    A null source or language is a value of its own; a text without words has topic 0 and no tokens. Rows
    that repeat id and text share the decision, which is a hash of both.
    """
    docs, back = _aside(docs)
    chosen = mix(docs)
    gone = staged(chosen.where("not selected").select("row_key").distinct(), "not-mixed")
    marked = mark_among(docs.withColumn("row_key", F.xxhash64(F.col("doc_id").cast("string"), "text")), gone, ["row_key"])
    return marked.where("not among").select(*back).union(marked.where("among").join(gone, "row_key", "left_anti").select(*back))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens. A null or empty text is its end mark; a long one is cut into
    pieces. Rows that repeat are packed each. The result has the columns of packing alone."""
    return pack_documents(docs, vocabulary_path())


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("mixing", mixing), ("packing", packing)]
#: The stages train models and tokenize, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
