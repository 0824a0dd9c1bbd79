import math
import re
import zlib
from collections import Counter

import numpy as np

from marginwatch.llm import language_model as L

SF = "/root/testdata/sf0.01"


def tokens(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + ["\n"]


def vocabulary():
    head = [(f"w{k}", 5000 // (k + 1), "en" if k % 2 else "de") for k in range(700)]
    return L.Vocabulary(head, 90, [3.5 + r for r in range(L.RARE)])


def test_probabilities_of_all_tokens_sum_to_one():
    v = vocabulary()
    m = {k: np.random.default_rng(2).normal(0, 0.5, a.shape).astype(np.float32) for k, a in L.initial(v).items()}
    codes = np.arange(v.end + 1 + L.RARE)  # a rare class stands for all its words and its unknown type
    for seed in range(3):
        h = np.repeat(np.random.default_rng(seed).normal(0, 1, (1, L.STATE)).astype(np.float32), len(codes), axis=0)
        assert math.isclose(np.exp(L.log_probabilities(m, v, h, codes)).sum(), 1, rel_tol=1e-4)


def test_state_is_carried_across_windows():
    v = vocabulary()
    m = {k: np.random.default_rng(3).normal(0, 0.3, a.shape).astype(np.float32) for k, a in L.initial(v).items()}
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, v.end + 1, n) for n in (1, 700, 33, 32, 31, 700, 5)]
    whole = L.score_documents(m, v, docs, window=10_000)
    assert np.allclose(whole, L.score_documents(m, v, docs, window=7), rtol=1e-5)
    assert np.allclose(whole, [L.score_documents(m, v, [d])[0] for d in docs], rtol=1e-5)


def test_gradient_descends():
    v = vocabulary()
    runs = [np.tile([3, 50, 9, 300], 8) for _ in range(100)]
    m = L.initial(v)
    before = L.score_documents(m, v, runs[:1])[0]
    for _ in range(5):
        m = L.train_runs(m, v, runs)
    assert L.score_documents(m, v, runs[:1])[0] > before / 2


def test_scores_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(400).union(spark.createDataFrame(
        [(9001, None, None, "s", 0), (9002, "", "en", "s", 0), (9002, "Unseen-Word ZZZ", "en", "s", 0), (None, "the of", "en", "s", 0), (9003, "the " * 60_000, "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")).withColumnRenamed("source", "stratum")
    rows = docs.collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    count = Counter(w for r in rows if not held(r.doc_id) for w in tokens(r.text))
    n, denominator = sum(count.values()), math.log10(sum(count.values()) + 0.5 * (len(count) + 1))
    got = L.score_texts(docs).collect()
    assert len(got) == len(rows)
    want = sorted(((r.doc_id or -1, len(t := tokens(r.text)), sum(count[w] > 0 for w in t), sum(math.log10(count[w] + 0.5) - denominator for w in t)) for r in rows))
    have = sorted(((r.doc_id or -1 if r.doc_id is not None else -1, r.n_tokens, r.n_known, r.base_score) for r in got))
    for a, b in zip(want, have):
        assert a[:3] == b[:3] and math.isclose(a[3], b[3], rel_tol=1e-9)
    assert {r.train_tokens for r in got} == {n} and all(r.held_out == held(r.doc_id) for r in got)
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_without_training_documents(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    got = L.score_texts(spark.createDataFrame([(held, "a b", "en")], "doc_id long, text string, lang string")).collect()
    assert got[0].n_known == 0 and got[0].train_tokens == 0 and got[0].n_tokens == 3 and math.isfinite(got[0].score)
    assert L.score_texts(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0


def test_every_training_token_is_trained_on():
    for n in (0, 1, 2, 3, 50, 1000):
        codes = np.arange(n)
        assert np.array_equal(np.concatenate([L.part_of(codes, k) for k in range(L.ROUNDS)]), codes)
    # A pattern that starts beyond what one short run of a text would show is learned as well.
    v, rng = vocabulary(), np.random.default_rng(4)
    texts = [np.concatenate([rng.integers(300, 600, 40), np.tile([3, 50, 9, 300], 30)]) for _ in range(60)]
    m = L.initial(v)
    before = L.score_documents(m, v, [texts[0][40:]])[0]
    for k in range(L.ROUNDS):
        m = L.train_runs(m, v, [L.part_of(t, k) for t in texts])
    assert L.score_documents(m, v, [texts[0][40:]])[0] > 0.8 * before
