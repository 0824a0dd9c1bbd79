import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marginwatch.llm import mixing
from marginwatch.llm.mixing import mix, probabilities, rake
from marginwatch.llm.quality import classify, features, fit, grades_of

SF = "/root/testdata/sf0.01"


def test_held_out_documents_are_graded_well(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    grades = grades_of(labels)
    train, held = grades.where("doc_id % 4 <> 0"), grades.where("doc_id % 4 = 0")
    got = classify(docs, train).join(held, "doc_id").groupBy("grade").agg(F.avg(F.col("accepted").cast("double")).alias("a"), F.avg("expected_grade").alias("e")).collect()
    got = {r.grade: r for r in got}
    assert got[2].a > 0.9 and got[0].a < 0.3 and got[1].a < 0.3 and max(got[0].e, got[1].e) < got[2].e - 0.3


def test_thresholds_are_ordered_and_fit_separates():
    rng = np.random.default_rng(0)
    grades = rng.integers(0, 4, 800)
    rows = [np.unique(np.concatenate([[int(g)], rng.integers(10, 200, 20)])) for g in grades]
    bins, weights, cuts = fit(rows, grades, 4)
    assert (np.diff(cuts) > 0).all()
    w = dict(zip(bins.tolist(), weights.tolist()))
    assert w[0] < w.get(1, 0) < w.get(2, 0) < w[3]


def test_classify_odd_rows(spark):
    rows = [(1, "good words here", "a"), (2, None, "b"), (3, "", "c"), (3, "again", "d"), (None, "no id", "e"), (4, "x!! " * 100_000, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bins string")
    labels = spark.createDataFrame([(1, 2), (3, 0), (3, 2), (9, 1), (None, 1), (4, None)], "doc_id long, grade int")
    got = classify(docs, labels).collect()
    assert len(got) == 6 and all(0 <= r.p_tail <= 1 and 0 <= r.expected_grade <= 2 for r in got)
    assert classify(docs, labels.limit(0)).where("accepted").count() == 6
    assert classify(docs.limit(0), labels).count() == 0
    assert grades_of(spark.createDataFrame([(1, 1, 1), (2, 0, 0), (3, 1, 0), (4, None, 0)], "doc_id long, quality int, toxic int")).where("grade is not null").count() == 3


def test_features_of_signs_and_repeats():
    assert set(features(b"a b c")) < set(features(b"a, b! c!!")) and len(features(b"")) == 1
    assert not set(features(b"the the the the")) <= set(features(b"the cat"))


def test_raking_meets_the_marginals():
    cells = [("a", "x", 100), ("a", "y", 10), ("b", "x", 5), ("b", "y", 500), ("c", "x", 50), ("c", "y", 50), ("d", "x", 0)]
    codes = [np.array(["abcd".index(s) for s, _, _ in cells]), np.array(["xy".index(k) for _, k, _ in cells])]
    targets = [np.array([200.0, 300.0, 215.0, 0.0]), np.array([400.0, 315.0])]
    got = rake(codes, np.array([t for *_, t in cells]), targets)
    for code, target in zip(codes, targets):
        assert np.allclose(np.bincount(code, got), target, rtol=1e-4)
    # Raking keeps odds ratios of the cells.
    assert math.isclose(got[0] * got[3] / (got[1] * got[2]), 100 * 500 / (10 * 5), rel_tol=1e-9) and got[6] == 0


@pytest.mark.parametrize("share", [0.1, 0.5, 0.9, 1.0])
def test_probabilities_keep_the_share(share):
    tokens, weight = np.arange(30) * 10.0, (np.arange(30) * 7919 % 100).astype(float)
    got = probabilities(tokens, weight, share)
    assert math.isclose((tokens * got).sum(), min(share * tokens.sum(), tokens[weight > 0].sum()), rel_tol=1e-9)
    assert ((0 <= got) & (got <= 1)).all() and got[0] == 1


def test_mix_moves_shares_to_targets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("topic", F.lit("clash"))
    langs = {"en": 1.0, "de": 1.0, "fr": 1.0, "es": 1.0}
    got = mix(docs, targets={"lang": langs}, keep_share=0.1, n_topics=1).join(docs.select("doc_id", "lang"), "doc_id")
    rows = got.groupBy("lang").agg(F.sum(F.col("n_tokens") * F.col("probability")).alias("t"), F.sum(F.when(F.col("selected"), F.col("n_tokens"))).alias("s")).collect()
    total = sum(r.t for r in rows)
    assert all(abs(r.t / total - 0.25) < 0.08 for r in rows) and len(rows) == 4
    assert mix(docs, targets={"lang": {"en": 1.0}}, keep_share=0.5).join(docs.where("lang <> 'en'"), "doc_id", "left_semi").where("selected").count() == 0


def test_mix_odd_rows(spark):
    rows = [(1, "a b", None, "en"), (2, None, "s", None), (3, "", "s", "en"), (3, "c d e", "s", "en"), (3, "c d e", "s", "en"), (None, "x", "t", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = mix(docs).collect()
    assert len(got) == 6 and len({r.selected for r in got if r.doc_id == 3 and r.n_tokens == 3}) == 1
    assert mix(docs.limit(0)).count() == 0


def test_rare_topic_is_found_among_many_documents(spark):
    """Three documents of 12,000 have a topic of their own: a bounded sample would leave them without a centre."""
    common = [(i, " ".join(f"{'ab'[i % 2]}{(i * 7 + j * j) % 40}" for j in range(12)), "s", "en") for i in range(12_000)]
    rare = [(20_000 + i, " ".join(f"zz{j}" for j in range(12 + i)), "s", "en") for i in range(3)]
    docs = spark.createDataFrame(common + rare, "doc_id long, text string, source string, lang string").repartition(4)
    topics = {r.doc_id: r.topic for r in mix(docs, n_topics=3).collect()}
    assert len({topics[20_000 + i] for i in range(3)}) == 1 and topics[20_000] not in {topics[i] for i in range(12_000)}
    assert topics == {r.doc_id: r.topic for r in mix(docs.repartition(7), n_topics=3).collect()}


def test_blocks_hold_the_bins_that_documents_have_and_give_the_same_products():
    texts = [b"a b c a", b"", b"b d e", b"hidden", b"c"]
    found = [mixing.word_bins(t.split()) for t in texts]
    scale = np.linspace(0.5, 2, mixing.TOPIC_BINS)
    scale[found[3][0]] = 0
    batch = pa.RecordBatch.from_arrays([pa.array([f[k].tobytes() for f in found], pa.binary()) for k in (0, 1)], ["bins", "times"])
    dense = np.zeros((len(texts), mixing.TOPIC_BINS))
    for row, (at, n) in zip(dense, found):
        row[at] = n * scale[at]
    dense = dense[[0, 2, 4]]
    dense /= np.linalg.norm(dense, axis=1)[:, None]
    (at, block, norm), = mixing._blocks(batch, scale)
    assert at.tolist() == [0, 2, 4] and len(norm) == 3
    assert len(block.value) == np.count_nonzero(dense)
    centres = np.random.default_rng(3).random((2, mixing.TOPIC_BINS))
    assert np.allclose(block.like(centres), dense @ centres.T)
    assert np.allclose(block.summed(np.array([1, -1, 1]), 2), [np.zeros(mixing.TOPIC_BINS), dense[0] + dense[2]])
    assert np.allclose([block.whole(k) for k in range(3)], dense)
    nothing = next(mixing._blocks(batch.slice(1, 1), scale))[1]
    assert nothing.like(centres).shape == (0, 2) and not nothing.summed(np.zeros(0, int), 2).any()
