"""A gated recurrent language model with a class-factored softmax, in numpy inside tasks.

P(word | history) = P(class | h) * P(word | class, h), h the state of a gated recurrent unit that runs over a
document from its first token to its end. The most frequent words form small classes whose words are told
apart by h as well; words of the further head form classes by stratum (language) and frequency, and all other
words form classes by their last two bytes; within these a word has its smoothed share. Each class of the
last kind holds one unknown type, so that the probabilities of known and unknown words sum to one.

Counts, classes and shares come from every training document. The network is trained by truncated
backpropagation on every token of them: each round takes the next part of every document, in consecutive windows; the
state is carried from one to the next, gradients are not. Tasks train on their rows, some at a time, and their weights are averaged, by a tree, after each
round. For scoring, documents of a task run side by side, sorted by length, window after window with the
state carried, so that a document is scored whole whatever its length.
"""
from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

#: Words whose codes tasks hold; of these, words with own inputs, and words told apart by the state.
HEAD, INPUTS, HOT, HOT_CLASS = 100_000, 3_000, 256, 32
#: Frequency classes of a stratum; strata with classes of their own; classes of the words outside the head.
BINS, STRATA, RARE = 4, 8, 16
STATE = 16
#: Length of a window, documents side by side in training, rounds (each trains on one of so many parts of every text).
WINDOW, BATCH, ROUNDS = 16, 64, 3
#: Distinct words that a task counts before it hands them on.
COUNTED = 150_000
#: Tokens of documents that are scored, or trained on, side by side, at most (a longer document by itself).
SCORED = 1_500_000


def _rare_class(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % RARE


class Vocabulary:
    """Codes of tokens: head words 0 to n - 1, then the end, then the rare classes. Built from head rows
    (word, count, stratum) in falling order of count, and the smoothed totals of the rare classes."""

    def __init__(self, head: list[tuple[str, int, str]], n_ends: int, rare_totals: list[float]) -> None:
        n = len(head)
        self.codes = {w.encode(): k for k, (w, _, _) in enumerate(head)}
        self.end = n
        count = np.array([c for _, c, _ in head] + [n_ends], float) + 0.5
        common = [s for s, _ in Counter(s for _, _, s in head).most_common(STRATA - 1)]
        stratum = np.array([common.index(s) if s in common else len(common) for _, _, s in head], np.int64)
        hot = min(HOT, n)
        order = np.lexsort((np.arange(hot), stratum[:hot]))
        cls = np.zeros(n + 1, np.int64)
        cls[order] = np.arange(hot) // HOT_CLASS
        base = -(-hot // HOT_CLASS)
        for s in range(len(common) + 1):
            mine = hot + np.flatnonzero(stratum[hot:] == s)
            mass = np.cumsum(count[mine])
            cls[mine] = base + s * BINS + np.minimum((mass / max(mass[-1] if len(mass) else 1, 1e-9) * BINS * 0.9999).astype(np.int64), BINS - 1)
        cls[n] = base + (len(common) + 1) * BINS
        used, cls = np.unique(cls, return_inverse=True)  # empty classes would take probability
        self.rare = len(used)
        self.n_classes = self.rare + RARE
        self.n_hot, self.n_hot_classes = hot, base
        self.cls = np.concatenate([cls, self.rare + np.arange(RARE)])  # by code
        total = np.bincount(cls, count, self.n_classes)
        total[self.rare:] = rare_totals
        self.class_log = np.log(np.maximum(total, 1e-9) / total.sum())
        self.rare_log = np.log(np.array(rare_totals))
        share = np.log(count / total[cls])
        self.share_log = np.concatenate([share, np.zeros(RARE)])  # of a rare class itself: words' shares are joined later
        self.hot_words = [np.flatnonzero(cls[:hot] == k) for k in range(base)]
        self.hot_place = np.zeros(hot, np.int64)
        for words in self.hot_words:
            self.hot_place[words] = np.arange(len(words))
        n_in = min(INPUTS, n)
        self.inputs = np.concatenate([np.arange(n_in), n_in + self.cls[n_in:]])
        self.n_inputs = n_in + self.n_classes

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
        """Codes of a document with its end, and its words outside the head."""
        codes = np.fromiter((self.codes.get(w, -1) for w in words), np.int64, len(words))
        rare = [words[i] for i in np.flatnonzero(codes < 0).tolist()]
        if rare:
            codes[codes < 0] = [self.end + 1 + _rare_class(w) for w in rare]
        return np.append(codes, self.end), rare


def initial(v: Vocabulary, seed: int = 1) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    small = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
    return {"x": small(v.n_inputs, 3 * STATE), "u": small(STATE, 3 * STATE), "c": small(v.n_classes, STATE) * 0, "cb": v.class_log.astype(np.float32),
            "w": small(v.n_hot, STATE) * 0, "wb": v.share_log[: v.n_hot].astype(np.float32)}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _step(m: dict, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """One gated recurrent step: the new state, and what the gradient needs."""
    s = STATE
    hu = h @ m["u"][:, : 2 * s]
    gates = _sigmoid(x[:, : 2 * s] + hu)
    z, r = gates[:, :s], gates[:, s:]
    rh = r * h
    n = np.tanh(x[:, 2 * s:] + rh @ m["u"][:, 2 * s:])
    return h + z * (n - h), z, r, rh, n


def _softmax_log(scores: np.ndarray) -> np.ndarray:
    scores = scores - scores.max(axis=1, keepdims=True)
    return scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))


def log_probabilities(m: dict, v: Vocabulary, h: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Natural log of the class and share factors of each code, from the states before them."""
    at = np.arange(len(codes))
    out = _softmax_log(h @ m["c"].T + m["cb"])[at, v.cls[codes]].astype(np.float64)
    hot = codes < v.n_hot
    out += np.where(hot, 0.0, v.share_log[codes])
    rows = np.flatnonzero(hot)
    order = rows[np.argsort(v.cls[codes[rows]], kind="stable")]
    cuts = np.searchsorted(v.cls[codes[order]], np.arange(v.n_hot_classes + 1))
    for k, words in enumerate(v.hot_words):
        some = order[cuts[k]:cuts[k + 1]]
        if len(some):
            out[some] += _softmax_log(h[some] @ m["w"][words].T + m["wb"][words])[np.arange(len(some)), v.hot_place[codes[some]]]
    return out


def part_of(codes: np.ndarray, k: int) -> np.ndarray:
    """The part of a document that round k trains on; together the rounds train on each token once."""
    size = -(-len(codes) // ROUNDS)
    return codes[k * size:(k + 1) * size]


def train_runs(m: dict, v: Vocabulary, runs: list[np.ndarray], rate: float = 0.1, sums: dict | None = None) -> dict:
    """One pass of AdaGrad over runs of codes, in windows of WINDOW with the state carried and not its gradient.
    `sums`, where given, are the squares of earlier passes and take those of this one."""
    m = {k: a.copy() for k, a in m.items()}
    sums = {} if sums is None else sums
    for k, a in m.items():
        sums.setdefault(k, np.full_like(a, 1e-2))
    runs = sorted((r for r in runs if len(r)), key=len)
    batches = [runs[i:i + BATCH] for i in range(0, len(runs), BATCH)]
    for b in np.random.default_rng(len(runs)).permutation(len(batches)):
        some = batches[b]
        length = np.array([len(r) for r in some])
        h = np.zeros((len(some), STATE), np.float32)
        for t0 in range(0, int(length[-1]), WINDOW):
            alive = some[int(np.searchsorted(length, t0, side="right")):]  # the shortest end first
            codes = np.full((min(WINDOW, int(length[-1]) - t0), len(alive)), -1, np.int64)
            for j, r in enumerate(alive):
                piece = r[t0:t0 + WINDOW]
                codes[: len(piece), j] = piece
            h = _window(m, v, sums, codes, h[len(h) - len(alive):], rate)
    return m


def _window(m: dict, v: Vocabulary, sums: dict, codes: np.ndarray, h: np.ndarray, rate: float) -> np.ndarray:
    steps, states = [], [h]
    for c in codes:
        x = m["x"][v.inputs[np.maximum(c, 0)]]
        new, *kept = _step(m, x, states[-1])
        new = np.where((c >= 0)[:, None], new, states[-1])
        steps.append(kept)
        states.append(new)
    t, j = np.nonzero(codes >= 0)
    if not len(t):
        return states[-1]
    before, want = np.stack(states[:-1])[t, j], codes[t, j]
    scale = 1 / len(want)
    g = {k: np.zeros_like(a) for k, a in m.items() if k != "x"}
    p = np.exp(_softmax_log(before @ m["c"].T + m["cb"]))
    p[np.arange(len(want)), v.cls[want]] -= 1
    p *= scale
    g["c"], g["cb"] = p.T @ before, p.sum(axis=0)
    d_before = p @ m["c"]
    for k, words in enumerate(v.hot_words):
        some = np.flatnonzero((want < v.n_hot) & (v.cls[want] == k))
        if len(some):
            q = np.exp(_softmax_log(before[some] @ m["w"][words].T + m["wb"][words]))
            q[np.arange(len(some)), v.hot_place[want[some]]] -= 1
            q *= scale
            g["w"][words], g["wb"][words] = q.T @ before[some], q.sum(axis=0)
            d_before[some] += q @ m["w"][words]
    d_out = np.zeros((len(codes), *h.shape), np.float32)
    d_out[t, j] = d_before
    d, s = np.zeros_like(h), STATE
    inputs, d_inputs = [], []
    for k in range(len(codes) - 1, -1, -1):  # d: gradient of the state after step k
        c, old, (z, r, rh, n) = codes[k], states[k], steps[k]
        alive = (c >= 0)[:, None]
        dh = d * alive
        dn = dh * z * (1 - n * n)
        dz = dh * (n - old) * z * (1 - z)
        drh = dn @ m["u"][:, 2 * s:].T
        dr = drh * old * r * (1 - r)
        dg = np.concatenate([dz, dr], axis=1)
        g["u"][:, : 2 * s] += old.T @ dg
        g["u"][:, 2 * s:] += rh.T @ dn
        inputs.append(v.inputs[np.maximum(c, 0)])
        d_inputs.append(np.concatenate([dg, dn], axis=1) * alive)
        d = np.where(alive, dh * (1 - z) + drh * r + dg @ m["u"][:, : 2 * s].T, d) + d_out[k]
    at, inverse = np.unique(np.concatenate(inputs), return_inverse=True)
    gx = np.zeros((len(at), 3 * s), np.float32)
    np.add.at(gx, inverse, np.concatenate(d_inputs))
    for k in ("u", "c", "cb", "w", "wb"):
        a = np.clip(g[k], -1, 1)
        sums[k] += a * a
        m[k] -= rate * a / np.sqrt(sums[k])
    gx = np.clip(gx, -1, 1)
    sums["x"][at] += gx * gx
    m["x"][at] -= rate * gx / np.sqrt(sums["x"][at])
    return states[-1]


def score_documents(m: dict, v: Vocabulary, docs: list[np.ndarray], window: int = 32) -> np.ndarray:
    """The natural log probability of each document's codes, side by side, the longest first."""
    order = sorted(range(len(docs)), key=lambda i: -len(docs[i]))
    length = np.array([len(docs[i]) for i in order])
    start = np.cumsum(length) - length
    flat = np.concatenate([docs[i] for i in order]) if docs else np.zeros(0, np.int64)
    h, total = np.zeros((len(docs), STATE), np.float32), np.zeros(len(docs))
    for t0 in range(0, int(length[0]) if len(length) else 0, window):
        states, want, owner = [], [], []
        for t in range(t0, min(t0 + window, int(length[0]))):
            n = int(np.searchsorted(-length, -t, side="left"))  # documents with a token at t
            c = flat[start[:n] + t]
            states.append(h[:n].copy())
            want.append(c)
            owner.append(np.arange(n))
            h[:n] = _step(m, m["x"][v.inputs[c]], h[:n])[0]
        owner = np.concatenate(owner)
        total += np.bincount(owner, log_probabilities(m, v, np.concatenate(states), np.concatenate(want)), len(docs))
    out = np.empty(len(docs))
    out[order] = total
    return out


def _pack(m: dict) -> bytes:
    return np.concatenate([m[k].ravel() for k in sorted(m)]).astype("<f4").tobytes()


def _unpack(data: bytes, like: dict) -> dict:
    flat, at, out = np.frombuffer(data, "<f4"), 0, {}
    for k in sorted(like):
        out[k] = flat[at:at + like[k].size].reshape(like[k].shape).copy()
        at += like[k].size
    return out


def _average(rows: DataFrame) -> DataFrame:
    """(n, weights) averaged with weight n, 16 rows at a time, down to one row."""
    def merge(key, table):
        n = np.array(table.column("n").to_pylist(), float)
        total = sum(np.frombuffer(w.as_buffer(), "<f4") * k for w, k in zip(table.column("weights"), n / n.sum()))
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "n": pa.array([int(n.sum())], pa.int64()), "weights": pa.array([total.astype("<f4").tobytes()], pa.binary())})

    rows = staged(rows.withColumn("part", F.spark_partition_id().cast("long")), "lm-weights")
    while rows.count() > 1:
        rows = rows.withColumn("part", F.floor(F.col("part") / 16).cast("long"))
        rows = staged(rows.select("part", "n", "weights").groupBy("part").applyInArrow(merge, "part long, n long, weights binary"), "lm-weights")
    return rows


def _train_tokens(rows: DataFrame) -> DataFrame:
    """(word, stratum, n) of training documents, counted in the tasks first."""
    def flush(found):
        out = [(w.decode(), s, n) for s, c in found.items() for w, n in c.items()]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out) if out else [[]] * 3, (pa.string(), pa.string(), pa.int64()))], ["word", "stratum", "n"])

    def run(batches):
        found: dict[str, Counter] = {}
        for batch in batches:
            for t, s in zip(batch.column("text").to_pylist(), batch.column("stratum").to_pylist()):
                found.setdefault(s, Counter()).update(t.lower().split())
                if sum(map(len, found.values())) > COUNTED:
                    yield flush(found)
                    found = {}
        yield flush(found)

    return rows.select("text", "stratum").mapInArrow(run, "word string, stratum string, n long")


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str | None = "lang") -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are words without white space, A-Z lower-cased, and one end. Documents whose crc32 of the id as
    text leaves 1 when divided by 5 are held out; the model learns from all others (also from a null id).
    base_score is the smoothed unigram log10 probability of the whole text, score the model's. A null text is
    an empty one: its end alone. Rows that repeat an id are scored, and learned from, one by one. Without
    training documents every token is unknown. The stratum shapes word classes only; null is a stratum.
    """
    spark = docs.sparkSession
    stratum = F.coalesce(F.col(stratum_col).cast("string"), F.lit("")) if stratum_col else F.lit("")
    held = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 1, F.lit(False))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("text"), held.alias("held_out"), stratum.alias("stratum"))
    learn = rows.where("not held_out")
    by_stratum = _train_tokens(learn).groupBy("word", "stratum").agg(F.sum("n").alias("n"))
    counts = staged(by_stratum.groupBy("word").agg(F.sum("n").alias("c"), F.max_by("stratum", F.struct("n", "stratum")).alias("stratum")), "lm-counts")
    n_ends = learn.count()
    n_words, n_types = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    train_tokens, types = n_words + n_ends, n_types + (n_ends > 0)
    head = [tuple(r) for r in counts.orderBy(F.desc("c"), "word").limit(HEAD).collect()]
    last = (head[-1][1], head[-1][0]) if head else None
    tail = counts.where((F.col("c") < last[0]) | ((F.col("c") == last[0]) & (F.col("word") > last[1]))) if last else counts
    rare_class = F.crc32(F.substring(F.col("word").cast("binary"), -2, 2)) % RARE
    totals = {r.k: r.t for r in tail.groupBy(rare_class.alias("k")).agg(F.sum(F.col("c") + 0.5).alias("t")).collect()}
    vocabulary = Vocabulary(head, n_ends, [totals.get(k, 0.0) + 0.5 for k in range(RARE)])
    denominator = float(np.log10(train_tokens + 0.5 * (types + 1)))
    head_log = np.log10(np.array([c for _, c, _ in head] + [n_ends], float) + 0.5)
    sent = spark.sparkContext.broadcast((vocabulary, head_log))

    def encoded(batches):
        v, _ = sent.value
        for batch in batches:
            out = [v.encode(t.lower().split())[0].astype(np.int32) for t in batch.column("text").to_pylist()]
            ends = np.cumsum([0, *map(len, out)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(ends, np.concatenate([np.zeros(0, np.int32), *out]))], ["codes"])

    texts = staged(learn.select("text").mapInArrow(encoded, "codes array<int>"), "lm-codes")
    weights = initial(vocabulary)
    for turn in range(ROUNDS):
        now = spark.sparkContext.broadcast(_pack(weights))

        def fit(batches, turn=turn):
            v, _ = sent.value
            m, sums, waiting, tokens, seen = _unpack(now.value, initial(v)), {}, [], 0, 0
            for batch in batches:
                for c in batch.column("codes"):
                    waiting.append(part_of(c.values.to_numpy(zero_copy_only=False), turn).astype(np.int64))
                    tokens += len(waiting[-1])
                    if tokens >= SCORED:
                        m, seen = train_runs(m, v, waiting, sums=sums), seen + tokens
                        waiting, tokens = [], 0
            if tokens:
                m, seen = train_runs(m, v, waiting, sums=sums), seen + tokens
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([_pack(m)], pa.binary())], ["n", "weights"])

        row = _average(texts.mapInArrow(fit, "n long, weights binary")).first()
        weights = _unpack(row.weights, weights) if row else weights
    model = spark.sparkContext.broadcast(_pack(weights))
    fields = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("known", pa.int64()), ("head_log", pa.float64()), ("model_log", pa.float64()), ("words", pa.list_(pa.string())), ("times", pa.list_(pa.int32()))])

    def score(batches):
        v, logs = sent.value
        m = _unpack(model.value, initial(v))
        waiting, held_tokens = [], 0
        for batch in batches:
            for i, out, t in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "held_out", "text"))):
                codes, rare = v.encode(t.lower().split())
                waiting.append((i, out, codes, Counter(rare)))
                held_tokens += len(codes)
                if held_tokens >= SCORED:
                    yield flush(m, v, logs, waiting)
                    waiting, held_tokens = [], 0
        if waiting:
            yield flush(m, v, logs, waiting)

    def flush(m, v, logs, waiting):
        natural = score_documents(m, v, [c for _, _, c, _ in waiting])
        out = []
        for (i, held_out, codes, rare), s in zip(waiting, natural.tolist()):
            inside = codes[codes <= v.end]
            # A rare word's share is (c + 0.5) / total; the totals are known here, the counts are joined.
            shares = v.rare_log[codes[codes > v.end] - v.end - 1].sum()
            known = len(inside) - (0 if n_ends else 1)
            out.append((i, held_out, len(codes), known, float(logs[inside].sum()), (s - float(shares)) / np.log(10), [w.decode() for w in rare], list(rare.values())))
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), fields)], schema=fields)

    part = staged(rows.select("doc_id", "held_out", "text").mapInArrow(score, "doc_id long, held_out boolean, n_tokens long, known long, head_log double, model_log double, words array<string>, times array<int>")
                  .withColumn("row", F.monotonically_increasing_id()), "lm-scored")
    each = part.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select("row", F.col("w.words").alias("word"), F.col("w.times").alias("k"))
    met = each.join(tail.select("word", "c"), "word", "left").groupBy("row").agg(
        F.sum(F.col("k") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("rare_log"), F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("rare_known"))
    whole = part.join(met, "row", "left").withColumn("rare_log", F.coalesce("rare_log", F.lit(0.0)))
    return whole.select("doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"), F.lit(train_tokens).cast("long").alias("train_tokens"),
                        (F.col("head_log") + F.col("rare_log") - F.col("n_tokens") * F.lit(denominator)).alias("base_score"), (F.col("model_log") + F.col("rare_log")).alias("score"))
