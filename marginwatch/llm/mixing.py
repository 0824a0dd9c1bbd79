"""Mixing to target weights: iterative proportional fitting over source, language and topic.

Topics come from spherical k-means over hashed words of all documents: texts are read once into bins, tasks
then sum document frequencies and, in each round, their documents by centre; only these sums and the centres
leave them. Tokens are then summed by cell (source, language, topic), and the cells' weights
are raked in one task, which gets one row a cell and not a document: scaled to the target of each marginal in turn until all hold. A document's probability is its
cell's weight over its cell's tokens, times one factor that makes the expected tokens what is asked for,
at most 1; a hash of the document decides.
"""
from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

#: Bins that words fold into, rounds of k-means at most.
TOPIC_BINS, ROUNDS = 4_096, 12
#: Documents that are compared with centres together, groups that tasks are summed in first.
BLOCK, LANES = 512, 1_024
#: Exponent that flattens a marginal's own shares where no target is given.
FLATTEN = 0.7
#: Raking ends when no marginal is off by more than this, relatively, or after so many sweeps.
TOLERANCE, SWEEPS = 1e-6, 200
#: Cells that one task rakes at most (some 200 MB); more are an error, never dropped.
MAX_CELLS = 1_000_000


def word_bins(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct bins of a text's words, in order, and how many distinct words fold into each."""
    distinct = set(words)
    n = np.bincount(np.fromiter(map(zlib.crc32, distinct), np.int64, len(distinct)) % TOPIC_BINS, minlength=1)
    at = np.flatnonzero(n)
    return at.astype("<u2"), n[at].astype("<u4")


def _numbers(column: pa.Array, kind: str) -> np.ndarray:
    """The numbers packed into the values of a binary column, one value after the other."""
    return np.frombuffer(b"".join(column.to_pylist()), kind)


class _Block:
    """Documents as rows of unit length by bin, of which only the bins that they have are held: `value` at (`row`, `at`), row
    after row, every row with one at least."""

    def __init__(self, size: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
        self.size, self.at, self.value = size, at, value
        self.start = np.cumsum(size) - size

    def like(self, centres: np.ndarray) -> np.ndarray:
        """Inner products, documents by centres."""
        out = np.empty((len(self.size), len(centres)))
        for t, centre in enumerate(centres):
            out[:, t] = np.add.reduceat(centre[self.at] * self.value, self.start) if len(self.size) else 0
        return out

    def summed(self, group: np.ndarray, n: int) -> np.ndarray:
        """Sums of the documents by group, groups from 0 to n by bins; a group below 0 is none."""
        place = np.repeat(group, self.size) * TOPIC_BINS + self.at
        kept = place >= 0
        return np.bincount(place[kept], self.value[kept], n * TOPIC_BINS).reshape(n, TOPIC_BINS)

    def whole(self, k: int) -> np.ndarray:
        """Document k by all bins."""
        out, own = np.zeros(TOPIC_BINS), slice(self.start[k], self.start[k] + self.size[k])
        out[self.at[own]] = self.value[own]
        return out


def _blocks(batch: pa.RecordBatch, scale: np.ndarray):
    """(places in the batch, a _Block, lengths before) of its documents, BLOCK at a time: numbers of words times
    scale. A document whose words scale hides is left out."""
    for start in range(0, len(batch), BLOCK):
        part = batch.slice(start, BLOCK)
        size = pc.binary_length(part.column("bins")).to_numpy(zero_copy_only=False).astype(np.int64) // 2
        at, n = _numbers(part.column("bins"), "<u2").astype(np.int64), _numbers(part.column("times"), "<u4")
        value = n * scale[at]
        norm = np.sqrt(np.bincount(np.repeat(np.arange(len(size)), size), value * value, len(size)))
        told = norm > 1e-9
        value = value / np.repeat(np.where(told, norm, 1), size)
        if not told.all():
            kept = np.repeat(told, size)
            at, value = at[kept], value[kept]
        yield start + np.flatnonzero(told), _Block(size[told], at, value), norm[told]


def _summed(parts: DataFrame) -> dict[int, np.ndarray]:
    """Sums by part of the doubles in rows (part, sums), a row a task and part, in two steps, so that no group
    grows with all tasks: those of a lane first, then the lanes. The order of addition is fixed by the values."""
    def add(_, table):
        rows = sorted(v.as_py() for v in table.column("sums"))
        return pa.table({"part": table.column("part").slice(0, 1), "sums": pa.array([sum(np.frombuffer(r, "<f8") for r in rows).tobytes()], pa.binary())})

    laned = parts.withColumn("lane", F.pmod(F.spark_partition_id(), F.lit(LANES)))
    lanes = laned.groupBy("part", "lane").applyInArrow(add, "part int, sums binary")
    return {r.part: np.frombuffer(r.sums, "<f8") for r in lanes.groupBy("part").applyInArrow(add, "part int, sums binary").collect()}


def _parts(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.astype("<f8").tobytes() for v in sums.values()], pa.binary())], ["part", "sums"])


def _farthest(vectors: DataFrame, rarity: np.ndarray, c: np.ndarray) -> np.ndarray | None:
    """The document least like all centres, of equals the one of most, and rarest, words, then of the smallest
    key; none if all are like a centre."""
    sent = vectors.sparkSession.sparkContext.broadcast(c)

    def run(batches):
        best = None
        for batch in batches:
            keys = batch.column("row_key").to_numpy()
            for at, x, norm in _blocks(batch, rarity):
                if len(at):
                    near, less = np.round(x.like(sent.value).max(axis=1, initial=-1.0), 9), np.round(-norm, 9)  # sums differ in their last bits by block
                    k = np.lexsort((keys[at], less, near))[0]
                    new = float(near[k]), float(less[k]), int(keys[at[k]])
                    if best is None or new < best[:3]:
                        best = *new, x.whole(k).tobytes()
        if best:
            yield pa.RecordBatch.from_arrays([pa.array([b]) for b in best], ["near", "less", "row_key", "value"])

    new = vectors.mapInArrow(run, "near double, less double, row_key long, value binary").agg(F.min(F.struct("near", "less", "row_key", "value")).alias("m")).first().m
    return None if new is None or len(c) and new.near > 1 - 1e-8 else np.frombuffer(new.value, "<f8")


def fit_topics(vectors: DataFrame, n_topics: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centres by bin, to be summed over a document's words, words weighted by rarity, of all of (row_key, bins,
    times); started from the documents farthest from each other, the largest topic first. Equal documents count as often
    as they are there."""
    def frequencies(batches):
        total = np.zeros(TOPIC_BINS + 1)
        for batch in batches:
            total[TOPIC_BINS] += len(batch)
            total[:TOPIC_BINS] += np.bincount(_numbers(batch.column("bins"), "<u2"), minlength=TOPIC_BINS)
        yield _parts({0: total})

    found = _summed(vectors.select("bins").mapInArrow(frequencies, "part int, sums binary")).get(0, np.zeros(TOPIC_BINS + 1))
    rarity = np.log((1 + found[TOPIC_BINS]) / (1 + found[:TOPIC_BINS]))
    c, context = np.zeros((0, TOPIC_BINS)), vectors.sparkSession.sparkContext
    while len(c) < n_topics and (new := _farthest(vectors, rarity, c)) is not None:
        c = np.vstack([c, new])
    for k in range(rounds if len(c) else 0):
        sent, before, pulls = context.broadcast(c), c.copy(), k > 0

        def by_centre(batches):
            sums = np.zeros((len(sent.value), TOPIC_BINS + 1))
            for batch in batches:
                for _, x, _ in _blocks(batch, rarity):
                    like = x.like(sent.value)
                    mine = np.where(pulls | (like.max(axis=1) > 1e-9), like.argmax(axis=1), -1)
                    sums[:, :-1] += x.summed(mine, len(sums))
                    sums[:, -1] += np.bincount(mine[mine >= 0], minlength=len(sums))
            yield _parts({int(t): sums[t] for t in np.flatnonzero(sums[:, -1])})

        # The largest topic comes first: documents that share no word with any centre go there once that is known.
        found, size = _summed(vectors.select("bins", "times").mapInArrow(by_centre, "part int, sums binary")), np.zeros(len(c))
        for t, total in found.items():
            c[t], size[t] = total[:-1] / np.linalg.norm(total[:-1]), total[-1]
        c = c[np.argsort(-size, kind="stable")]
        if np.abs(c - before).max() < 1e-6:
            break
    return np.vstack([c, np.zeros((n_topics - len(c), TOPIC_BINS))]) * rarity


def with_topics(docs: DataFrame, text_col: str, n_topics: int) -> DataFrame:
    """(doc_id, row_key, source columns ..., n_tokens, topic) of docs with row_key; a text without words has topic 0."""
    keep = [c for c in docs.columns if c != text_col]

    def read(batches):
        for batch in batches:
            words = [(t or b"").lower().split() for t in batch.column(text_col).cast(pa.binary()).to_pylist()]
            found = [word_bins(w) for w in words]
            bins, times = (pa.array([f[k].tobytes() for f in found], pa.binary()) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array([len(w) for w in words], pa.int64()), bins, times], [*keep, "n_tokens", "bins", "times"])

    schema = docs.select(*keep).schema.add("n_tokens", "long").add("bins", "binary").add("times", "binary")
    vectors = staged(docs.mapInArrow(read, schema), "mix-vectors")
    sent = docs.sparkSession.sparkContext.broadcast(fit_topics(vectors.select("row_key", "bins", "times"), n_topics))

    def assign(batches):
        for batch in batches:
            topic = np.zeros(len(batch), np.int32)
            for at, x, _ in _blocks(batch, np.ones(TOPIC_BINS)):
                topic[at] = x.like(sent.value).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in (*keep, "n_tokens")], pa.array(topic, pa.int32())], [*keep, "n_tokens", "topic"])

    return vectors.mapInArrow(assign, docs.select(*keep).schema.add("n_tokens", "long").add("topic", "integer"))


def rake(codes: list[np.ndarray], tokens: np.ndarray, targets: list[np.ndarray], tolerance: float = TOLERANCE, sweeps: int = SWEEPS) -> np.ndarray:
    """Weights of cells, from their tokens, such that over each dimension the weights of each value sum to
    its target. codes numbers each cell's value, targets are by number."""
    weight = tokens.astype(float)
    for _ in range(sweeps):
        off = 0.0
        for code, target in zip(codes, targets):
            total = np.bincount(code, weight, len(target))
            factor = np.where(total > 0, target / np.where(total > 0, total, 1), 1.0)
            weight *= factor[code]
            alive = (total > 0) & (target > 0)
            off = max(off, float(np.abs(factor[alive] - 1).max(initial=0)))
        if off <= tolerance:
            break
    return weight


def probabilities(tokens: np.ndarray, weight: np.ndarray, keep_share: float) -> np.ndarray:
    """min(1, factor * weight / tokens) of cells, the factor such that the expected tokens are keep_share of
    all (or all that have a weight, if those are fewer); 1 for a cell without tokens."""
    wanted, factor = min(keep_share * tokens.sum(), tokens[weight > 0].sum()), 0.0
    while True:
        full = weight * factor >= tokens
        rest = weight[~full].sum()
        new = (wanted - tokens[full].sum()) / rest if rest > 0 else factor
        if new <= factor * (1 + 1e-12):
            break
        factor = new
    return np.where(tokens > 0, np.minimum(1.0, weight * factor / np.maximum(tokens, 1)), 1.0)


def _chances(cells: DataFrame, dims: list[str], targets: dict[str, dict], flatten: float, keep_share: float) -> DataFrame:
    """cells (dims ..., tokens) with probability. One task rakes the cell table, whose size is checked."""
    def run(batches):
        rows = [r for batch in batches for r in zip(*(batch.column(c).to_pylist() for c in [*dims, "tokens"]))]
        if len(rows) > MAX_CELLS:
            raise ValueError(f"over {MAX_CELLS} cells of {', '.join(dims)}: mix by columns with fewer values")
        if not rows:
            return
        tokens, codes, aims = np.array([r[-1] for r in rows], float), [], []
        for k, dim in enumerate(dims):
            values, code = np.unique([r[k] for r in rows], return_inverse=True)
            given = targets.get(dim)
            if given is not None:
                share = np.array([dict(("-" if v is None else f"={v}", float(w)) for v, w in given.items()).get(v, 0.0) for v in values.tolist()])
            else:
                share = (np.bincount(code, tokens, len(values)) / max(tokens.sum(), 1)) ** flatten
            codes.append(code)
            aims.append(share / (share.sum() or 1) * tokens.sum())
        chance = probabilities(tokens, rake(codes, tokens, aims), keep_share)
        yield pa.RecordBatch.from_pydict({**{d: pa.array([r[k] for r in rows], pa.string()) for k, d in enumerate(dims)}, "probability": pa.array(chance)})

    return staged(cells.coalesce(1).mapInArrow(run, ", ".join(f"{d} string" for d in dims) + ", probability double"), "mix-chances")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", n_topics: int = 8,
        targets: dict[str, dict] | None = None, flatten: float = FLATTEN, keep_share: float = 0.7) -> DataFrame:
    """One row per input row: doc_id, row_key, topic, n_tokens, probability, selected.

    targets maps "source", "lang" or "topic" to weights by value (None for null); a value without a weight
    gets none, and its documents go. A marginal without targets aims at its own token shares to the power
    `flatten`. A null source or language is a value of its own. A text without words, or null, has no tokens,
    weighs nothing and is selected where its cell has no tokens at all, else by its cell's probability. Rows
    that repeat id and text share the decision. Targets that no weights can meet together end with the last
    dimension met, after SWEEPS. An empty table gives no row; other columns are ignored.
    """
    dims = ["source", "lang", "topic"]
    value = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(id_col).cast("string"), text_col).alias("row_key"), value(source_col).alias("source"), value(lang_col).alias("lang"), F.col(text_col).alias("text"))
    rows = staged(with_topics(rows, "text", n_topics).withColumn("topic", value("topic")), "mix-rows")
    cells = staged(rows.groupBy(*dims).agg(F.sum("n_tokens").alias("tokens")), "mix-cells")
    chances = _chances(cells, dims, targets or {}, flatten, keep_share)
    draw = F.pmod(F.xxhash64("row_key", F.lit("mix")), F.lit(1 << 53)) / F.lit(float(1 << 53))
    return rows.join(chances, dims).select("doc_id", "row_key", F.regexp_replace("topic", "^=", "").cast("int").alias("topic"), "n_tokens", "probability", (draw < F.col("probability")).alias("selected"))
