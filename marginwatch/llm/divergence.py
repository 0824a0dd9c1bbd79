"""Source divergence audit by count-level bitmaps.

Every source of a language gives each kept term a smoothed frequency that depends on its count alone, so the
distance of two sources is a sum over pairs of counts: (terms that occur i times here and j times there) times
the distance of those counts. The terms of a (source, count) are held as a bitset, cut into words of 64 terms;
two sources meet word by word, and AND and popcount give their joint cells. Term numbers follow falling
total counts, so that the terms of one count lie close together and a bitset has few words that are not empty.
Zeros are never stored: with f(i, j) the distance of counts and n(i, j) the joint cells of counts over 0,

    sum of all = sum n(i, j) (f(i, j) - f(i, 0) - f(0, j) + f(0, 0))
               + sum over i of terms(i) f(i, 0) + sum over j of terms(j) f(0, j) + (V - terms - terms') f(0, 0).

Texts are counted in tasks, which sum what they read before anything is shuffled.
"""
from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import staged

#: Documents of a language that a kept term is in, at least; ranks that part `term` goes to.
LEAST_DOCS, TOP = 10, 10
#: Distinct (source, term) that a task sums before it hands them on.
HELD_TERMS = 200_000
SCALE = 1_000_000_000

#: Bytes that are no letter become blanks, A-Z become a-z.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, n_docs) of docs (lang, source, text), partial sums."""
    def run(batches):
        held: dict[tuple, Counter] = {}
        seen: dict[tuple, Counter] = {}
        size = 0

        def hand_on():
            rows = [(lang, source, term, n, seen[lang, source][term]) for (lang, source), c in held.items() for term, n in c.items()]
            for a in range(0, len(rows), 20_000):
                columns = zip(*rows[a:a + 20_000])
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()))], ["lang", "source", "term", "n", "n_docs"])
            held.clear()
            seen.clear()

        for batch in batches:
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
                words = Counter(text.translate(_LETTERS).split())
                c = held.setdefault((lang, source), Counter())
                size -= len(c)
                c.update(words)
                size += len(c)
                seen.setdefault((lang, source), Counter()).update(words.keys())
                if size > HELD_TERMS:
                    yield from hand_on()
                    size = 0
        yield from hand_on()

    text = F.coalesce(F.encode("text", "UTF-8"), F.lit(b"").cast("binary"))
    return docs.select("lang", "source", text.alias("text")).mapInArrow(run, "lang string, source string, term binary, n long, n_docs long")


def _p(count: str, den: str) -> str:
    """SQL: 1 + floor(SCALE * (count + 2) / den) by long division in three steps of a thousand, so that no
    product leaves a long before counts of 9e15."""
    first = f"(({count} + 2) * 1000)"
    second = f"(({first} % {den}) * 1000)"
    third = f"(({second} % {den}) * 1000)"
    return f"(1 + ({first} div {den}) * 1000000 + ({second} div {den}) * 1000 + ({third} div {den}))"


def _f(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q}) div ({p} + {q}))"


def audit_sources(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source of a language is from the others (part
    `pair`, item the other source, all ranks), and by which terms it stands out from its language (part
    `term`, the first `top`).

    Null language, source or text count as empty. A text without letters adds no term, but its group is there:
    with no count at all every term has the same frequency. Each row is a document, repeated ones too. A
    language in which no term is in `least_docs` documents has distances of 0 and no terms; a source that is
    alone in its language has no pair. Ties go by the item's bytes. An empty table gives no row; other
    columns are ignored.
    """
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(value(lang_col).alias("lang"), value(source_col).alias("source"), F.col(text_col).alias("text"))
    counts = staged(term_counts(rows).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs")), "audit-counts")
    terms = counts.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("n_docs").alias("n_docs")).where(F.col("n_docs") >= least_docs).select("lang", "term", "total")
    # Falling totals, each (lang, term) once: numbers are unique, and dense within a partition.
    terms = staged(terms.repartitionByRange("lang", F.desc("total"), "term").sortWithinPartitions("lang", F.desc("total"), "term").withColumn("number", F.monotonically_increasing_id()), "audit-terms")
    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("n_lang"))
    kept = staged(counts.join(terms, ["lang", "term"]).select("lang", "source", "term", "n", "total", "number"), "audit-kept")
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_all"), F.count(F.lit(1)).alias("n_terms"))
    groups = rows.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["n_all", "n_terms", "v", "n_lang"])
    groups = groups.selectExpr("lang", "source", "n_terms", "v", "n_all + 2 * v as den", "n_lang + 2 * v as den_lang")
    # A language without kept terms divides nothing: its pairs are 0.
    groups = staged(groups.selectExpr("*", f"if(v = 0, 1, {_p('0L', 'greatest(den, 1)')}) as p0"), "audit-groups")

    levels = kept.groupBy("lang", "source", "n", F.shiftright("number", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(number & 63 as int))")).alias("bits"))
    levels = staged(levels.join(groups.select("lang", "source", "den", "p0"), ["lang", "source"]).selectExpr("lang", "source", "word", "n", "bits", f"{_p('n', 'den')} as p", "p0"), "audit-levels")
    side = {x: levels.select("lang", "word", F.col("source").alias(f"source_{x}"), F.col("bits").alias(f"bits_{x}"), F.col("p").alias(f"p_{x}"), F.col("p0").alias(f"z_{x}")) for x in "ab"}
    both = side["a"].join(side["b"], ["lang", "word"]).where("source_a < source_b and (bits_a & bits_b) <> 0")
    cell = f"bit_count(bits_a & bits_b) * ({_f('p_a', 'p_b')} - {_f('p_a', 'z_b')} - {_f('z_a', 'p_b')} + {_f('z_a', 'z_b')})"
    joint = both.groupBy("lang", "source_a", "source_b").agg(F.sum(F.expr(cell)).alias("joint"), F.sum(F.expr("bit_count(bits_a & bits_b)")).alias("shared"))
    joint = staged(joint, "audit-joint")

    # What a source's terms are worth against a zero: by its counts, whose number is about the root of its tokens.
    held = levels.groupBy("lang", "source", "p").agg(F.sum(F.expr("bit_count(bits)")).alias("held"))
    other = groups.selectExpr("lang", "source as item", "p0 as z", "n_terms as item_terms")
    alone = held.join(other, "lang").where("source <> item").groupBy("lang", "source", "item").agg(F.sum(F.expr(f"held * {_f('p', 'z')}")).alias("alone"))
    alone = staged(alone, "audit-alone")
    pairs = groups.join(other, "lang").where("source <> item")
    pairs = pairs.join(alone, ["lang", "source", "item"], "left").join(alone.selectExpr("lang", "item as source", "source as item", "alone as item_alone"), ["lang", "source", "item"], "left")
    pairs = pairs.withColumns({"source_a": F.least("source", "item"), "source_b": F.greatest("source", "item")}).join(joint, ["lang", "source_a", "source_b"], "left").na.fill(0, ["alone", "item_alone", "joint"])
    pairs = pairs.selectExpr("lang", "source", "'pair' as part", "item", f"joint + alone + item_alone + (v - n_terms - item_terms) * {_f('p0', 'z')} as value")

    own = kept.join(groups.select("lang", "source", "den", "den_lang"), ["lang", "source"]).selectExpr("lang", "source", "term", f"{_p('n', 'den')} as p", f"{_p('total', 'den_lang')} as q")
    own = own.where("p > q").selectExpr("lang", "source", "'term' as part", "decode(term, 'UTF-8') as item", f"{_f('p', 'q')} as value")
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    first = own.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(order)).union(first)
