"""Line dedup by a segment-partition edit join. DataFrame and SQL functions only.

Two lines are near when at most `edits` characters are inserted, deleted or replaced. A line is cut into
edits + 1 segments; one of them stands unchanged in any near line of the same or greater length, and not
further from its place than the edits before and behind it allow. So shorter lines hand out their segments,
and longer lines probe with the few substrings that can be such a segment, for each length in reach.
Candidates must also agree in their counts of some characters, within the join itself. What is
left is verified by a banded bit-parallel automaton: a row of 2 * edits + 1 bits for each number of edits,
one bit for each diagonal, stepped once a character.

Lines travel as hashes; the text of a line is kept once, at its first place, for candidates. Equal lines are one vertex. Fixed-size
bitmaps keep keys without a partner, and documents without a dropped line, out of every shuffle.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mark_among, staged, unused
from .components import connected_components

EDITS = 2
#: Shorter lines have no near lines: a few edits would be most of them.
MIN_CHARS = 20
#: Characters whose counts candidates must share, but for the edits.
COUNTED = (" ", "e", "n", "t", "r", "a", "o", "s", "i", "h")


def _segment(length: str, i: int, edits: int) -> tuple[str, str]:
    """SQL of the start (from 1) and the size of segment i (from 0) of a line of that length: even sizes, longer ones last."""
    k = edits + 1
    size = f"int({length} div {k})"
    short = f"({k} - {length} % {k})"
    return f"int(1 + {i} * {size} + greatest(0, {i} - {short}))", f"int({size} + if({i} >= {short}, 1, 0))"


def segment_keys(edits: int) -> str:
    """SQL: the keys that a line hands out."""
    parts = [_segment("n_chars", i, edits) for i in range(edits + 1)]
    return "array(" + ", ".join(f"xxhash64(n_chars, {i}, substring(line, {start}, {size}))" for i, (start, size) in enumerate(parts)) + ")"


def probe_keys(edits: int) -> str:
    """SQL: the keys that a line asks for, of lines as long and up to `edits` shorter."""
    out = []
    for shorter in range(edits + 1):
        length = f"(n_chars - {shorter})"
        for i in range(edits + 1):
            start, size = _segment(length, i, edits)
            for move in range(max(-i, shorter - (edits - i)), min(i, shorter + edits - i) + 1):
                out.append(f"xxhash64({length}, {i}, substring(line, {start} + {move}, {size}))")
    return "array(" + ", ".join(out) + ")"


def within_edits(a: str, b: str, edits: int) -> str:
    """SQL boolean: whether at most `edits` edits lead from one text to the other.

    Bit k of row e is set when, after i characters of a, i + k - edits characters of b are reached with e
    edits. A character keeps the bits where b has the same one; an edit is a replaced (same bit), deleted
    (bit below) or inserted (bit above) character, from the row with one edit less."""
    width, full = 2 * edits + 1, (1 << (2 * edits + 1)) - 1
    same = " | ".join(f"if(get(_cb, _i + {k - edits}) <=> _c, {1 << k}, 0)" for k in range(width))
    start = [1 << edits]  # before the first character, only insertions lead to places of b
    for e in range(1, edits + 1):
        start.append(start[-1] | (start[-1] << 1) & full)
    # Each row needs the new row above it, so rows are appended to an array one after the other. A transform
    # of an array of one binds a value to a name. Names begin with _, so that no column is hidden.
    step = "array(_y.r[0] & _y.m)"
    for e in range(1, edits + 1):
        step = (f"transform(array({step}), _q -> concat(_q, array(((_y.r[{e}] & _y.m) | _y.r[{e - 1}] | shiftright(_y.r[{e - 1}], 1)"
                f" | shiftleft(_q[{e - 1}], 1)) & {full})))[0]")
    chars = "filter(split({}, ''), _x -> _x <> '')"
    begin = "array(" + ", ".join(map(str, start)) + ")"
    matched = f"struct(_s.r as r, transform(array(_s.i), _i -> {same})[0] as m)"
    dead = " and ".join(f"_s.r[{e}] = 0" for e in range(edits, -1, -1))
    body = f"if({dead}, _s, named_struct('i', _s.i + 1, 'r', transform(array({matched}), _y -> {step})[0]))"
    at_end = f"int(length({b}) - length({a}) + {edits})"
    return (f"abs(length({a}) - length({b})) <= {edits} and exists(transform(array({chars.format(b)}), _cb -> (aggregate({chars.format(a)}, named_struct('i', 0, 'r', {begin}), (_s, _c) -> {body})).r), "
            f"_rows -> exists(_rows, _r -> (shiftright(_r, {at_end}) & 1) = 1))")


#: SQL: the line without blanks, tabs and returns at its ends. btrim takes long and few lines need it.
_TRIMMED = "if(" + " or ".join(f"{at}swith(line, '{c}')" for at in ("start", "end") for c in (" ", "\\t", "\\r")) + ", btrim(line, ' \\t\\r'), line)"


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(row_key, doc_id, pos, line) of the lines that count, without white space at their ends."""
    lines = docs.select("row_key", "doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return lines.withColumn("line", F.expr(_TRIMMED)).where(F.length("line") >= min_chars)


def _hash() -> Column:
    return F.xxhash64("line", F.lit("line"))


def near_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, exact_chars: int | None = None) -> DataFrame:
    """Of (row_key, doc_id, text): one row (line_key, class_key, n, first) per distinct line that repeats or
    has a near line; first is the first place (doc_id, row_key, pos) of any line of its class. Lines of
    exact_chars to min_chars characters (by default none) are in the class of their copies alone."""
    occurrences = _lines(docs, min_chars if exact_chars is None else min(exact_chars, min_chars))
    counts = [f"octet_length(line) - octet_length(replace(line, '{c}', ''))" for c in COUNTED]
    distinct = occurrences.groupBy(_hash().alias("line_key"), F.xxhash64("line").alias("check")).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "row_key", "pos")).alias("first"))
    distinct = staged(distinct.groupBy("line_key").agg(F.sum("n").alias("n"), F.min("first").alias("first")), "lines")

    counted = [f"c{k}" for k in range(len(COUNTED))]
    # Keys are made at the first place of a line only: equal lines elsewhere add nothing. The bitmap may let
    # others through; they go with the repeated rows below.
    firsts = mark_among(occurrences.where(F.length("line") >= min_chars).withColumn("line_key", _hash()), distinct.select("line_key", "first.doc_id", "first.row_key", "first.pos"), ["line_key", "doc_id", "row_key", "pos"]).where("among")
    shaped = firsts.select("line_key", "line", F.length("line").alias("n_chars"))
    keyed = staged(shaped.select("*", F.expr(segment_keys(edits)).alias("given"), F.expr(probe_keys(edits)).alias("asked")), "line-keys")
    given = keyed.select(F.col("line_key").alias("a"), F.col("n_chars").alias("n_a"), "line", F.explode("given").alias("key"))
    asked = keyed.select(F.col("line_key").alias("b"), F.col("n_chars").alias("n_b"), "line", F.explode(F.array_distinct("asked")).alias("key"))
    # A line of its own length asks for its own segments; keys that stand on one line only have no partner.
    multiple = staged(asked.groupBy("key").agg(F.min("b").alias("lo"), F.max("b").alias("hi")).where("lo < hi").select("key"), "line-multiple")
    # A row depends on its line alone, so that a line counts once whatever the bitmap let through. Characters are
    # counted where a key is left, not in every line.
    given, asked = (mark_among(rows, multiple, ["key"]).where("among").select(x, f"n_{x}", *[F.expr(c).alias(f"c{k}_{x}") for k, c in enumerate(counts)], "key").distinct()
                    for x, rows in (("a", given), ("b", asked)))
    close = " + ".join(f"abs({c}_a - {c}_b)" for c in counted)
    pairs = given.join(asked, "key").where(((F.col("n_b") > F.col("n_a")) | (F.col("n_b") == F.col("n_a")) & (F.col("a") < F.col("b"))) & (F.col("n_b") <= F.col("n_a") + edits) & F.expr(f"{close} <= {2 * edits} - (n_b - n_a)"))
    pairs = staged(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "line-pairs")

    wanted = staged(pairs.select(F.col("a").alias("line_key")).union(pairs.select("b")).distinct(), "line-wanted")
    texts = mark_among(keyed.select("line_key", "line"), wanted, ["line_key"]).where("among").select("line_key", "line").dropDuplicates(["line_key"])
    texts = staged(texts, "line-texts")
    both = pairs.join(texts.select(F.col("line_key").alias("a"), F.col("line").alias("x")), "a").join(texts.select(F.col("line_key").alias("b"), F.col("line").alias("y")), "b")
    links = staged(both.where(F.expr(within_edits("x", "y", edits))).select("a", "b"), "line-links")
    classes = staged(connected_components(links), "line-classes")

    near = distinct.join(classes.withColumnRenamed("id", "line_key"), "line_key", "left").withColumn("class_key", F.coalesce("component", "line_key"))
    near = near.where("n > 1 or component is not null").drop("component")
    first = near.groupBy("class_key").agg(F.min("first").alias("first"))
    return staged(near.drop("first").join(first, "class_key"), "line-near")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS, min_chars: int = MIN_CHARS, exact_chars: int | None = None) -> DataFrame:
    """docs with text_col without the lines that repeat, or nearly repeat, an earlier one, and three columns
    more: n_lines, n_dropped, dropped (the places, from 0, of the lines that went).

    Of a class of near lines (linked by at most `edits` edits, directly or by way of others) the first
    occurrence stays, by (id, place), a null id before all. Of lines shorter than
    min_chars, white space at their ends left out, those of at least exact_chars characters go if they repeat
    an earlier one exactly; the others, by default all, stay. A null text stays null, with no lines; an empty one has one, which
    stays. Rows that repeat both id and text are one document and keep the same lines. An empty table
    gives no row. Other columns are kept; result columns of these three names replace the input's.
    """
    keep = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped", "dropped")]
    row_key, among = unused("row_key", docs.columns), unused("among", docs.columns)
    keyed = docs.select(*keep).withColumn(row_key, F.xxhash64(F.col(id_col).cast("string"), text_col))
    narrow = keyed.select(F.col(row_key).alias("row_key"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    near = near_lines(narrow, edits, min_chars, exact_chars)
    places = mark_among(_lines(narrow, min_chars if exact_chars is None else min(exact_chars, min_chars)).select("row_key", "doc_id", "pos", _hash().alias("line_key")), near, ["line_key"]).where("among").drop("among")
    gone = places.join(near, "line_key").where(~F.struct("doc_id", "row_key", "pos").eqNullSafe(F.col("first")))
    gone = staged(gone.groupBy("row_key").agg(F.array_sort(F.collect_set("pos")).alias("dropped")), "line-dropped").withColumnRenamed("row_key", row_key)

    marked = mark_among(keyed, gone, [row_key], among)
    none = F.array().cast("array<int>")
    whole = marked.where(f"not {among}").withColumn("dropped", none)
    cut = marked.where(among).join(gone, row_key, "left").withColumn("dropped", F.coalesce("dropped", none))
    cut = cut.withColumn(text_col, F.when(F.size("dropped") == 0, F.col(text_col)).otherwise(F.expr(f"array_join(filter(split(`{text_col}`, '\\n'), (l, i) -> not array_contains(dropped, i)), '\\n')")))
    counted = F.coalesce(F.expr(f"cast(size(split(`{text_col}`, '\\n')) as long)"), F.lit(0))
    n_dropped = F.size("dropped").cast("long")
    left = F.when(F.col(text_col).isNull(), 0).when((F.length(text_col) == 0) & (n_dropped > 0), 0).otherwise(counted)
    return whole.unionByName(cut).withColumn("n_dropped", n_dropped).withColumn("n_lines", (left + F.col("n_dropped")).cast("long")).select(*keep, "n_lines", "n_dropped", "dropped")
