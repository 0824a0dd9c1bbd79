"""Ordinal quality classifier: a cumulative-link model over hashed text features.

Ratings are grades 0 to K - 1. One weight vector is shared by all grades, and ordered thresholds cut its
score: P(grade <= k) = sigmoid(threshold[k] - score). The expected grade ranks documents, and the tail
probability P(grade >= k) selects them. Features are hashed: the distinct words of a text, and levels that
the rates of signs, capitals, digits and repeats in it exceed.

The fit uses a bounded sample of labelled documents, MAX_LABELLED by the hash of their id; every document
is scored, where it is read, with the weights (at most 2**BITS of them) sent to the tasks.
"""
from __future__ import annotations

import functools
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mark_among, staged

#: Labelled documents that the fit sees at most.
MAX_LABELLED = 16_000
#: log2 of the number of hashed features.
BITS = 20
#: Labelled documents that a feature must appear in.
LEAST_DOCUMENTS = 5
CACHE_WORDS = 250_000

_SIGNS = b"!*#$%&|<>{}[]=_~^@/\\+?\"()-"
_EDGES = b".,;:!?*#$%&|<>{}[]=_~^@/\\+\"'()-"
_LEVELS = (0.002, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.4, 0.6, 0.8)
_CAPITALS, _DIGITS = bytes(range(65, 91)), b"0123456789"


def _bin(name: bytes) -> int:
    return zlib.crc32(name) & ((1 << BITS) - 1)


class _Words(dict):
    """Numbers words, and keeps the bin of each without signs at its ends."""

    def __init__(self) -> None:
        self.bins: list[int] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.bins)
        core = word.strip(_EDGES)
        self.bins.append(_bin(b"w" + core) if core else -1)
        return n


@functools.lru_cache(maxsize=1)
def _words() -> _Words:
    return _Words()


@functools.lru_cache(maxsize=None)
def _level_bins(name: str) -> np.ndarray:
    return np.array([_bin(f"{name}>{level}".encode()) for level in _LEVELS])


def features(text: bytes) -> np.ndarray:
    """The sorted distinct bins of a text."""
    known = _words()
    if len(known) > CACHE_WORDS:
        known.clear()
        known.bins.clear()
    words = text.lower().split()
    if not words:
        return np.array([_bin(b"no words")])
    at = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
    distinct = np.unique(at)
    bins = np.array([known.bins[i] for i in distinct.tolist()])
    rates = [("capitals", (len(text) - len(text.translate(None, _CAPITALS))) / len(text)), ("digits", (len(text) - len(text.translate(None, _DIGITS))) / len(text)),
             ("repeats", float((at[1:] == at[:-1]).mean()) if len(at) > 1 else 0.0), ("distinct", len(distinct) / len(at))]
    rates += [(chr(s), text.count(s) / len(words)) for s in _SIGNS]
    levels = [_level_bins(name)[: int(np.searchsorted(_LEVELS, rate))] for name, rate in rates if rate > _LEVELS[0]]
    return np.unique(np.concatenate([bins[bins >= 0], *levels]))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(rows: list[np.ndarray], grades: np.ndarray, n_grades: int, epochs: int = 20, rate: float = 0.1, l1: float = 3e-3, seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins with a weight, their weights, thresholds: AdaGrad on the cumulative-link likelihood, weights
    pulled to zero. Steps between thresholds are exponentials, so that they stay ordered. Grades weigh
    by the inverse root of their share, since bad ones are few."""
    count = np.bincount(np.concatenate(rows), minlength=1 << BITS)
    used = np.flatnonzero(count >= LEAST_DOCUMENTS)
    place = np.full(1 << BITS, -1, np.int64)
    place[used] = np.arange(len(used))
    rows = [p[p >= 0] for p in (place[r] for r in rows)]
    share = np.bincount(grades, minlength=n_grades) / len(grades)
    weight = 1 / np.sqrt(np.maximum(share, 1e-3))[grades]
    weight /= weight.mean()
    below = np.clip(np.cumsum(share)[:-1], 0.01, 0.99)
    start = np.log(below / (1 - below))
    base, steps = start[0], np.log(np.maximum(np.diff(start), 0.5))
    w, sums, t_sums = np.zeros(len(used)), np.full(len(used), 1e-3), np.full(n_grades - 1, 1e-3)
    rng = np.random.default_rng(seed)
    batch = 128
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for i in range(0, len(order), batch):
            some = order[i:i + batch]
            n = np.array([len(rows[j]) for j in some])
            flat = np.concatenate([rows[j] for j in some])
            owner = np.repeat(np.arange(len(some)), n)
            score = np.bincount(owner, w[flat], len(some))
            cut = np.concatenate([[-np.inf], base + np.concatenate([[0], np.cumsum(np.exp(steps))]), [np.inf]])
            g = grades[some]
            hi, lo = _sigmoid(cut[g + 1] - score), _sigmoid(cut[g] - score)
            hi, lo = np.where(g == n_grades - 1, 1.0, hi), np.where(g == 0, 0.0, lo)
            p = np.maximum(hi - lo, 1e-9)
            d_hi, d_lo = hi * (1 - hi) / p * weight[some], lo * (1 - lo) / p * weight[some]
            grad = np.bincount(flat, (d_hi - d_lo)[owner], len(w)) / len(some)
            seen = np.flatnonzero(grad)
            sums[seen] += grad[seen] ** 2
            move = rate / np.sqrt(sums[seen])
            w[seen] -= move * grad[seen]
            w[seen] = np.sign(w[seen]) * np.maximum(np.abs(w[seen]) - move * l1, 0)
            d_cut = np.array([d_lo[g == k + 1].sum() - d_hi[g == k].sum() for k in range(n_grades - 1)]) / len(some)
            d = np.concatenate([[d_cut.sum()], [d_cut[k + 1:].sum() * np.exp(steps[k]) for k in range(n_grades - 2)]])
            t_sums += d ** 2
            d = rate * d / np.sqrt(t_sums)
            base, steps = base - d[0], np.clip(steps - d[1:], -5, 5)
    kept = np.flatnonzero(w)
    return used[kept], w[kept], base + np.concatenate([[0], np.cumsum(np.exp(steps))])


def train(docs: DataFrame, labels: DataFrame, n_grades: int, max_labelled: int = MAX_LABELLED) -> tuple[np.ndarray, np.ndarray] | None:
    """All weights by bin, and the thresholds, from labels (doc_id, grade); None where no document is labelled.
    An id with several grades counts with the lowest. One task fits, on at most max_labelled rows of bins."""
    graded = labels.where("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.min("grade").cast("int").alias("grade"))
    sample = staged(graded.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled), "quality-sample")
    some = mark_among(docs.select("doc_id", "text"), sample, ["doc_id"]).where("among").join(sample, "doc_id").dropDuplicates(["doc_id"])

    def bins(batches):
        for batch in batches:
            found = [features(t or b"").astype(np.int32) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("grade"), pa.array(found, pa.list_(pa.int32()))], ["doc_id", "grade", "bins"])

    rows = staged(some.select("doc_id", "grade", "text").mapInArrow(bins, "doc_id long, grade int, bins array<int>"), "quality-bins")

    def learn(batches):
        found = [(i, g, np.array(b)) for batch in batches for i, g, b in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "grade", "bins")))]
        if found:
            found.sort(key=lambda x: x[0])
            at, w, cuts = fit([b for _, _, b in found], np.array([g for _, g, _ in found]), n_grades)
            yield pa.RecordBatch.from_pydict({"bins": [at.tolist()], "weights": [w.tolist()], "cuts": [cuts.tolist()]})

    model = rows.coalesce(1).mapInArrow(learn, "bins array<long>, weights array<double>, cuts array<double>").first()
    if model is None:
        return None
    weights = np.zeros(1 << BITS, np.float32)
    weights[model.bins] = model.weights
    return weights, np.array(model.cuts)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_grades: int = 3, least_grade: int | None = None, least_tail: float = 0.5) -> DataFrame:
    """docs with expected_grade, p_tail = P(grade >= least_grade, by default the highest) and accepted.

    labels has doc_id and grade, 0 to n_grades - 1. accepted is p_tail >= least_tail. A null text counts as
    empty; it and any text without words is scored by that feature alone. Without labelled documents both
    numbers are null and all are accepted. Rows that repeat an id are scored one by one; a null id is scored
    too. An empty table gives no row. Other columns are kept; the input's of these three names are replaced.
    """
    least = n_grades - 1 if least_grade is None else least_grade
    keep = [c for c in docs.columns if c not in ("expected_grade", "p_tail", "accepted")]
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.encode(F.col(text_col), "UTF-8").alias("text"))
    model = train(narrow, labels, n_grades)
    if model is None:
        return docs.select(*keep, F.lit(None).cast("double").alias("expected_grade"), F.lit(None).cast("double").alias("p_tail"), F.lit(True).alias("accepted"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        weights, cuts = sent.value
        for batch in batches:
            score = np.array([float(weights[features((t or "").encode())].sum()) for t in batch.column(text_col).to_pylist()])
            above = 1 - _sigmoid(cuts[None, :] - score[:, None])  # P(grade > k)
            tail = above[:, least - 1] if least else np.ones(len(score))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(above.sum(axis=1)), pa.array(tail), pa.array(tail >= least_tail)], [*keep, "expected_grade", "p_tail", "accepted"])

    schema = docs.select(*keep).schema.add("expected_grade", "double").add("p_tail", "double").add("accepted", "boolean")
    return docs.select(*keep).mapInArrow(run, schema)


def grades_of(labels: DataFrame) -> DataFrame:
    """Grades of the given labels: toxic 0, of low quality 1, good 2; a null flag leaves a row out."""
    return labels.select("doc_id", F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2).alias("grade"))
