"""N-gram Jaccard join by parity sketches.

Each shingle of a document flips one bit of a wide sketch, so the Hamming distance of two sketches never
exceeds the symmetric difference of the two sets. Documents are taken in bands of set size. A band's
sketch is cut into parts; if two sets of n and at most n / threshold shingles link, they differ in at most
d(n) shingles, which touch at most d(n) parts. A document therefore hands out the first d(n) + 1 of its
parts that are not empty as join keys: of the parts up to there, the empty ones and the d(n) touched ones
cannot be all, so a linked pair shares a key. Parts are very wide and held as the XOR of one random word
per set bit. Which parts come first may be chosen, as long as all documents agree: those that no other
document has come first and the most frequent ones last, so a passage that many documents share is a key
only of those that have too little besides. A folded sketch prunes candidates, then one as wide as the set
is large, before the few sets that are left are compared.

Only documents that share a key are candidates, and not all pairs of those are made. In a few rounds every
document meets one representative of each of its keys, so that most of a large group becomes one component.
What is left, documents of one key in different components, meet within a join whose condition is the
distance of their short sketches; no other pair leaves it, and those are compared exactly.
"""
from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mark_among, staged
from .components import connected_components

#: Ratio between the largest and the smallest size of a band.
BAND = 1.6
#: 64-bit words of the folded sketch, which candidates are first compared by.
SKETCH_WORDS = 16
#: Rounds in which documents meet representatives, at most; a round that finds no link is the last.
ROUNDS = 4
#: Words whose hashes one Python worker keeps.
CACHE_WORDS = 250_000
#: Bits of a key by which its documents are counted, and groups that count them: a bucket holds 4 bytes a key.
SLOT_BITS, BUCKETS = 43, 2_048
#: SQL text of a key's slot.
SLOT = f"shiftrightunsigned(key, {64 - SLOT_BITS})"

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def _mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """splitmix64's finalizer."""
    x = x + np.uint64(seed * int(_ODD[0]) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * _ODD[1]
    x = (x ^ (x >> np.uint64(27))) * _ODD[2]
    return x ^ (x >> np.uint64(31))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


@functools.lru_cache(maxsize=1)
def _hashes() -> _Hashes:
    return _Hashes()


def shingles(text: bytes, width: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the runs of `width` lower-case words; a shorter text is one run."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    known = _hashes()
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - width + 1)
    run = np.full(n, min(len(h), width), np.uint64)
    for k in range(min(width, len(h))):
        run = run * _ODD[0] + h[k:k + n]
    return np.unique(_mix(run))


class Bands:
    """Sizes, differences and keys for a threshold of num / den."""

    def __init__(self, num: int, den: int) -> None:
        if not 0 < num <= den:
            raise ValueError("the threshold is over 0 and at most 1")
        self.num, self.den = num, den
        self.ratio = max(BAND, 1.01 * den / num)

    def difference(self, n: int) -> int:
        """The most that a set of n shingles can differ from one it links with."""
        return (self.den - self.num) * (n + n * self.den // self.num) // (self.den + self.num)

    def of(self, n: int) -> list[int]:
        """The bands in which a set of n meets others: its own, and the next if it can link into that."""
        g = int(math.log(n) / math.log(self.ratio))
        g += self.low(g + 1) <= n
        g -= self.low(g) > n
        return [g, g + 1] if n * self.den // self.num >= self.low(g + 1) else [g]

    @functools.lru_cache(maxsize=None)  # noqa: B019
    def low(self, g: int) -> int:
        return math.ceil(self.ratio ** g)

    @functools.lru_cache(maxsize=None)  # noqa: B019
    def parts(self, g: int) -> int:
        least = self.difference(self.low(g + 1)) + 1
        return least + least // 10

    def keys(self, h: np.ndarray) -> np.ndarray:
        return self.elements(h)[0]

    def elements(self, h: np.ndarray) -> tuple[np.ndarray, list[int], int]:
        """The keys of the parts that are not empty, and of the empty ones where those are too few, band after
        band; for each band the number of the former and of all; how many of them a linked set must meet."""
        out, sizes = [], []
        for g in self.of(len(h)):
            parts, need = self.parts(g), self.difference(len(h)) + 1
            part = ((h >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            part = part[order]
            first = np.flatnonzero(np.diff(part, prepend=-1))
            code, at = np.bitwise_xor.reduceat(_mix(h[order], 1), first), part[first]
            sizes.append(len(at))
            if len(at) < need:  # too few parts with shingles: the empty ones are keys as well
                code, at = np.concatenate([code, np.zeros(parts - len(at), np.uint64)]), np.concatenate([at, np.setdiff1d(np.arange(parts), at)])
            sizes.append(len(at))
            out.append(_mix(code ^ _mix(np.uint64(g << 32) + at.astype(np.uint64), 2), 3))
        return np.concatenate(out).view(np.int64), sizes, self.difference(len(h)) + 1


def folded(h: np.ndarray) -> np.ndarray:
    """The sketch folded to SKETCH_WORDS words."""
    at = (_mix(h, 4) & np.uint64(64 * SKETCH_WORDS - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=64 * SKETCH_WORDS) & 1).astype(np.uint8)).view(np.int64)


def wide_sketch(h: np.ndarray) -> bytes | None:
    """The sketch at two bits or more a shingle; None where the folded one has as many. A wider sketch folds
    to a narrower one by the XOR of its halves."""
    bits = 1 << (2 * len(h) - 1).bit_length()
    if bits <= 64 * SKETCH_WORDS:
        return None
    at = (_mix(h, 4) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8)).tobytes()


def wide_distance(x: bytes, y: bytes) -> int:
    """The Hamming distance of two wide sketches, at the width of the narrower."""
    a, b = sorted((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)), key=len)
    while len(b) > len(a):
        b = b[:len(b) // 2] ^ b[len(b) // 2:]
    return int(np.bitwise_count(a ^ b).sum())


def sketch_documents(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """Of (doc_id, text): doc_id, n_shingles, two checksums of the set, folded and wide sketch, elements."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("check_a", pa.int64()), ("check_b", pa.int64()), ("sketch", pa.list_(pa.int64())), ("wide", pa.binary()), ("keys", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("need", pa.int32())])

    def run(batches):
        bands = Bands(num, den)
        for batch in batches:
            out = []
            for t in batch.column("text").to_pylist():
                h = shingles(t or b"", width)
                if len(h):
                    out.append((len(h), int(np.bitwise_xor.reduce(h).view(np.int64)), int(_mix(h, 5).sum(dtype=np.uint64).view(np.int64)), folded(h), wide_sketch(h), *bands.elements(h)))
                else:
                    out.append((0, 0, 0, [], None, [], [], 0))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(x, f.type) for x, f in zip(zip(*out) if out else [[]] * 8, list(schema)[1:])]], schema=schema)

    return docs.mapInArrow(run, "doc_id long, n_shingles long, check_a long, check_b long, sketch array<long>, wide binary, keys array<long>, sizes array<int>, need int")


def repeated_slots(vertices: DataFrame) -> DataFrame:
    """Of (keys): slot, n_rows of those slots, the first SLOT_BITS bits of a key, that stand more than once. Four bytes a
    key are shuffled: a key's first bits name its bucket, and the other bits of its slot lie side by side in one value."""
    def deal(batches):
        for batch in batches:
            slots = np.sort(batch.column("keys").flatten().to_numpy(zero_copy_only=False).view(np.uint64) >> np.uint64(64 - SLOT_BITS))
            ends = np.searchsorted(slots, np.arange(1, BUCKETS + 1, dtype=np.uint64) << np.uint64(32)).tolist()
            rest, starts = slots.astype("<u4"), [0, *ends[:-1]]
            filled = [k for k in range(BUCKETS) if ends[k] > starts[k]]
            yield pa.RecordBatch.from_arrays([pa.array(filled, pa.int32()), pa.array([rest[starts[k]:ends[k]].tobytes() for k in filled], pa.binary())], ["bucket", "rest"])

    def count(key, table):
        rest, n = np.unique(np.frombuffer(b"".join(table.column("rest").to_pylist()), "<u4"), return_counts=True)
        return pa.table({"slot": (key[0].as_py() << 32) + rest[n > 1].astype(np.int64), "n_rows": n[n > 1].astype(np.int64)})

    return vertices.mapInArrow(deal, "bucket int, rest binary").groupBy("bucket").applyInArrow(count, "slot long, n_rows long")


def _sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """The shingles of the documents with these ids; only their texts leave the scan."""
    def run(batches):
        for batch in batches:
            sets = [shingles(t or b"", width).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.binary())], ["doc_id", "hashes"])

    some = mark_among(docs, ids, ["doc_id"]).where("among").select("doc_id", "text").mapInArrow(run, "doc_id long, hashes binary")
    return staged(some, "parity-sets")


def _ends(pairs: DataFrame) -> DataFrame:
    """doc_id of both ends of the pairs, once a pair: a bitmap of them needs no more."""
    return pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))


def _similarity(pairs: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """(a, b) with the exact sizes of intersection and union."""
    sets = _sets(docs, _ends(pairs), width)
    both = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("hashes").alias("x")), "a").join(sets.select(F.col("doc_id").alias("b"), F.col("hashes").alias("y")), "b")

    def run(batches):
        for batch in batches:
            common, union = [], []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                at = np.searchsorted(x, y)
                n = int((x[np.minimum(at, len(x) - 1)] == y).sum()) if len(x) else 0
                common.append(n)
                union.append(len(x) + len(y) - n)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(common, pa.int64()), pa.array(union, pa.int64())], ["a", "b", "n_common", "n_union"])

    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long, n_common long, n_union long")


def _close(num: int, den: int, words: int) -> str:
    """SQL: whether sizes n_a, n_b and sketches s_a, s_b allow a link. The distance of folded sketches is at
    most the symmetric difference of the sets, and that at most (1 - t) / (1 + t) of the sum of their sizes."""
    distance = " + ".join(f"bit_count(s_a[{k}] ^ s_b[{k}])" for k in range(words))
    return f"n_a * {den} >= n_b * {num} and n_b * {den} >= n_a * {num} and ({distance}) * {den + num} <= {den - num} * (n_a + n_b)"


def _sides(vertices: DataFrame, sketch: str) -> dict[str, DataFrame]:
    return {x: vertices.select(F.col("doc_id").alias(x), F.col("n").alias(f"n_{x}"), F.col(sketch).alias(f"s_{x}")) for x in "ab"}


def _near(pairs: DataFrame, vertices: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose sizes and sketches, the folded and then the wide ones, allow a link."""
    pairs = staged(pairs, "parity-pairs")
    for sketch in ("s", "wide"):
        side = _sides(staged(mark_among(vertices.select("doc_id", "n", sketch), _ends(pairs), ["doc_id"]).where("among").drop("among"), "parity-sides"), sketch)
        both = pairs.join(side["a"], "a").join(side["b"], "b")
        if sketch == "s":
            pairs = staged(both.where(_close(num, den, SKETCH_WORDS)).select("a", "b").distinct(), "parity-pairs")

    def run(batches):
        for batch in batches:
            keep = [x is None or y is None or wide_distance(x, y) * (den + num) <= (den - num) * n
                    for x, y, n in zip(batch.column("s_a").to_pylist(), batch.column("s_b").to_pylist(), batch.column("n").to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "s_a", "s_b", F.expr("n_a + n_b").alias("n")).mapInArrow(run, "a long, b long").distinct()


def _links(pairs: DataFrame, docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    return staged(_similarity(staged(pairs, "parity-pairs"), docs, width).where(f"n_common * {den} >= n_union * {num}").select("a", "b").distinct(), "parity-links")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id.

    Sets of `width`-word shingles (words without white space, A-Z lower-cased) link when their Jaccard
    similarity is at least num / den, compared in integers. component_id is the smallest id that links reach.
    A text with fewer words is one shingle; one without words, or null, has none and links with nothing. Rows
    that repeat an id are one document: each keeps its n_shingles, and the links of any hold for the id. A null
    id links with nothing and its component is null. An empty table gives no row; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.encode(F.col(text_col), "UTF-8").alias("text"))
    sketches = staged(sketch_documents(rows, width, num, den), "parity-sketches")
    filled = sketches.where("n_shingles > 0 and doc_id is not null")
    same = ["n_shingles", "check_a", "check_b"]

    # Equal sets are one vertex, their smallest id. Sketches and keys stay where they are: a bitmap tells which sets may
    # repeat, and of those only ids and checksums meet the repeats. A second bitmap tells which of them are vertices; a
    # copy that it lets through wrongly is one vertex more, with the same links.
    repeats = staged(filled.groupBy(same).agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1").drop("n_rows"), "parity-repeats")
    told = mark_among(filled.select("doc_id", *same), repeats, same).where("among").drop("among")
    told = staged(told.join(repeats, same, "left"), "parity-told")
    copies = told.where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    first = told.where("rep is null or doc_id = rep")
    vertices = mark_among(mark_among(filled, repeats, same, "repeats"), first, ["doc_id", *same], "first").where("not repeats or first")
    single = staged(vertices.select("doc_id", F.col("n_shingles").alias("n"), F.col("sketch").alias("s"), "wide"), "parity-vertices")

    # Keys that two vertices share; other keys go no further. A vertex needs as many keys as a linked one must meet;
    # those of its own come first, then the rarest.
    shared = staged(repeated_slots(vertices.select("keys")), "parity-keys")
    spread = vertices.select("doc_id", F.col("check_b").alias("row"), "sizes", "need", F.posexplode("keys").alias("pos", "key"))
    band = F.expr("if(pos < sizes[1], 0, 1)").alias("band")
    empty = F.expr("if(pos < sizes[1], pos >= sizes[0], pos - sizes[1] >= sizes[2])").alias("empty")
    short = F.expr("need - if(pos < sizes[1], sizes[0], sizes[2])").alias("short")  # keys that are needed beyond its filled parts
    met = mark_among(spread.withColumn("slot", F.expr(SLOT)), shared, ["slot"]).where("among").select("doc_id", "row", "key", band, empty, short)
    met = met.join(shared, F.expr(f"{SLOT} = slot"))
    ranked = met.groupBy("doc_id", "row", "short", "band").agg(
        F.sort_array(F.collect_set(F.expr("if(not empty, struct(n_rows, key), null)"))).alias("own"), F.collect_set(F.expr("if(empty, key, null)")).alias("empty"))
    mates = staged(ranked.select("doc_id", F.explode(F.expr("concat(slice(own.key, 1, greatest(0, short + size(own))), empty)")).alias("key")).distinct(), "parity-mates")

    links, open_ = copies, mates.withColumn("component", F.col("doc_id"))
    for k in range(ROUNDS):
        order = F.col("doc_id") if k == 0 else F.xxhash64("doc_id", F.lit(k))
        heads = open_.groupBy("key").agg(F.min(F.struct(order.alias("order"), F.col("doc_id").alias("rep"), F.col("component").alias("rep_component"))).alias("h")).select("key", "h.rep", "h.rep_component")
        stars = open_.join(heads, "key").where("component <> rep_component").select(F.least("rep", "doc_id").alias("a"), F.greatest("rep", "doc_id").alias("b")).distinct()
        found = _links(_near(stars, single, num, den), rows, width, num, den)
        links = links.union(found)
        known = staged(connected_components(links), "parity-known")
        now = mates.join(known.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
        mixed = now.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
        open_ = staged(now.join(staged(mixed, "parity-mixed"), "key", "left_semi").select("key", "doc_id", "component"), "parity-open")
        mates = open_.select("key", "doc_id")
        if found.isEmpty():
            break
    open_ = staged(open_.join(single.select("doc_id", "n", "s"), "doc_id"), "parity-open")
    x, y = (open_.select(F.col("key").alias(f"key_{z}"), F.col("doc_id").alias(z), F.col("component").alias(f"c_{z}"), F.col("n").alias(f"n_{z}"), F.col("s").alias(f"s_{z}")) for z in "ab")
    rest = x.join(y, F.expr(f"key_a = key_b and c_a < c_b and {_close(num, den, SKETCH_WORDS)}")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = links.union(_links(_near(rest, single, num, den), rows, width, num, den))

    components = staged(connected_components(links), "parity-components")
    return sketches.select("doc_id", "n_shingles").join(components.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
