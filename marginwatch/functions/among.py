"""Which rows may hold one of some keys, told without a shuffle of the rows."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: log2 of the bits of the bitmap: 2**26 bits are 8 MB to broadcast, however large the input.
FILTER_BITS = 26
#: Bytes of the bitmap in one broadcast row, held as words of 64 bits: a lookup reads one of them and copies nothing.
PIECE = 64


def may_hold(rows: DataFrame, hashes: dict[str, str], keys: DataFrame) -> DataFrame:
    """rows with a boolean per name of `hashes` (name -> SQL text of a bigint hash): whether that hash may be in
    `keys`, a table of one bigint column `h`. It may say yes wrongly, never no; a null hash is not among them."""
    slot = lambda h: f"pmod({h}, {1 << FILTER_BITS}L)"
    words = [F.expr(f"bit_or(if(_slot % {8 * PIECE} div 64 = {k}, shiftleft(1L, int(_slot % 64)), 0L))").alias(f"_w{k}") for k in range(PIECE // 8)]
    bits = (keys.selectExpr(f"{slot('h')} as _slot").groupBy(F.expr(f"_slot div {8 * PIECE}").alias("_bucket")).agg(*words)
            .select("_bucket", F.array(*[f"_w{k}" for k in range(PIECE // 8)]).alias("_bits")))
    # At most 2**FILTER_BITS / 8 / PIECE rows.
    out = rows
    for i, (name, h) in enumerate(hashes.items()):
        named = bits.selectExpr(f"_bucket as _bucket{i}", f"_bits as _bits{i}")
        out = (out.withColumn(f"_slot{i}", F.expr(slot(f"({h})"))).withColumn(f"_bucket{i}", F.expr(f"_slot{i} div {8 * PIECE}"))
               .join(F.broadcast(named), f"_bucket{i}", "left")
               .withColumn(name, F.expr(f"coalesce(getbit(_bits{i}[int(_slot{i} % {8 * PIECE} div 64)], int(pmod(_slot{i}, 64L))) = 1, false)"))
               .drop(f"_slot{i}", f"_bucket{i}", f"_bits{i}"))
    return out


def repeated(rows: DataFrame, hashes: Sequence[str]) -> DataFrame:
    """`h`: those values of the hashes (SQL texts) that stand more than once. Nulls do not count."""
    return (rows.selectExpr(f"explode(array({', '.join(hashes)})) as h").where("h is not null")
            .groupBy("h").agg(F.expr("count(1) as _n")).where("_n > 1").select("h"))
