"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Only DataFrame functions. The text is never shuffled: rows shrink to (id, length, prefix hash,
digest) in the scan. A group is a set of narrow rows, counted by combining aggregates, and only
groups of two or more are joined back, from a written table, so that Spark may broadcast it when it
is small and may split a hot group when it is not.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, mark_among, staged

#: Characters of the normalised text that the second level looks at.
PREFIX_CHARS = 64


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS, all_digests: bool = False) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after runs of white space became one space. A null text is an
    empty one; empty texts form one group. Rows that repeat an id are counted as they are, and all
    rows of the smallest id stay. A null id counts as larger than any: its row stays only in a group
    without other ids, with keep_id null. An empty table gives an empty result; other columns are ignored.

    text_sha256 is null for most texts that a cheaper level proved unique; the content is hashed in a
    second scan, of the surviving texts. all_digests asks for the digest of every text, so one scan does.
    """
    text, digest = normalised(F.col("text")), F.sha2(F.encode("norm", "UTF-8"), 256)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).select("doc_id", text.alias("norm")).withColumns({
        "n_bytes": F.octet_length("norm"), "prefix_hash": F.xxhash64(F.left("norm", F.lit(prefix_chars)))})
    keys = rows.select("doc_id", "n_bytes", "prefix_hash", *[digest.alias("text_sha256")] * all_digests)
    if all_digests:
        keys = staged(keys, "exact-keys")

    # Levels 1 and 2: lengths that repeat, and among them prefixes that repeat.
    prefixes = keys.groupBy("n_bytes", "prefix_hash").agg(F.count(F.lit(1)).alias("n"))
    lengths = prefixes.groupBy("n_bytes").agg(F.sum("n").alias("n_length")).where("n_length > 1")
    suspects = staged(prefixes.where("n > 1").join(lengths, "n_bytes", "left_semi").select("n_bytes", "prefix_hash"), "exact-suspects")

    # Level 3: the whole content, of survivors only.
    marked = mark_among(keys if all_digests else rows, suspects, ["n_bytes", "prefix_hash"], "suspect")
    if not all_digests:
        marked = staged(marked.select("doc_id", "suspect", F.when(F.col("suspect"), digest).alias("text_sha256")), "exact-digests")
    groups = staged(marked.where("suspect").groupBy("text_sha256").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")).where("group_size > 1"), "exact-groups")

    joined = marked.select("doc_id", "text_sha256").join(groups, "text_sha256", "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                         F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")
