import math

import numpy as np
import pytest

from marginwatch.llm import embedding_graph as G


def brute(rows, least):
    def ok(v):
        return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)

    units = [np.array(v, np.float32).astype(float) / np.linalg.norm(np.array(v, np.float32).astype(float)) if ok(v) else None for _, v, _ in rows]
    links = {i: 0 for i, _, _ in rows}
    root = {i: i for i, _, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x in range(len(rows)):
        for y in range(x):
            (i, _, a), (j, _, b) = rows[x], rows[y]
            if None not in (i, j, a, b) and a == b and units[x] is not None and units[y] is not None and len(units[x]) == len(units[y]) and units[x] @ units[y] >= least:
                links[i] += 1
                links[j] += 1
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {(i, links[i], find(i)) for i, _, _ in rows}


def vectors(n, dim=16, seed=0):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 6, dim))
    rows = []
    for i in range(n):
        v = base[rng.integers(len(base))] if rng.random() < 0.5 else rng.normal(size=dim)
        rows.append((int(i * 3 + 1), [float(np.float32(x)) for x in v + rng.normal(size=dim) * rng.choice([0, 0.05, 0.1])], int(rng.integers(2))))
    return rows


@pytest.mark.parametrize("shard_rows", [60, 1500])
def test_links_and_components_match_brute_force(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(G, "SHARD_ROWS", shard_rows)
    rows = vectors(700)
    ball = [(5000 + i, [1.0 + 0.001 * (i % 40)] + [1.0] * 15, 0) for i in range(150)]  # very close and equal vectors
    rows += ball
    got = G.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)).collect()
    want = brute(rows, 0.98)
    have = {(r.vec_id, r.n_links, r.component_id) for r in got}
    assert len(got) == len(rows) and len(have & want) >= 0.97 * len(want)
    assert sum(r.n_links for r in got) >= 0.97 * sum(n for _, n, _ in want) and sum(r.n_links for r in got) <= sum(n for _, n, _ in want)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_odd_vectors(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 1), (2, [2.0, 4.0, 6.0], 1), (3, v, 2), (4, v, None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0, 0.0], 1), (8, [1.0, None, 3.0], 1),
            (9, [float("nan"), 1.0, 1.0], 1), (10, [float("inf"), 1.0, 1.0], 1), (11, [1.0, 2.0], 1), (12, [1e-38, 2e-38, 3e-38], 1), (13, [1e38, 2e38, 3e38], 1), (14, [-1.0, -2.0, -3.0], 1), (15, v, 1)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in G.near_vectors(spark.createDataFrame([(*r, "x") for r in rows] + [(None, v, 1, "x")], "vec_id long, embedding array<float>, label int, shard string")).collect()}
    linked = {1, 2, 12, 13, 15}
    for i in range(1, 16):
        assert got[i] == ((4, 1, i == 1) if i in linked else (0, i, True)), i
    assert got[None] == (0, None, True)
    assert G.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_graph_search_finds_what_is_near():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(800, 24))
    x[400:] = x[:400] + rng.normal(size=(400, 24)) * 0.05
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    pruned = G.build_graph(x)
    graph = G.both_ways(pruned)
    assert all(i in graph[j] for i in range(800) for j in graph[i])
    medoid = int((x @ x.mean(axis=0)).argmax())
    found = sum(q + 400 in G.search(x, graph, medoid, q, 0.9, 24).tolist() for q in range(400))
    assert found >= 396 and pruned.shape[1] <= G.EDGES


def tight_group(n=1500, noise=200, dim=16, seed=7):
    rng = np.random.default_rng(seed)
    v = np.concatenate([rng.normal(size=dim) + 0.012 * rng.normal(size=(n, dim)) * np.sqrt(dim) / 4, rng.normal(size=(noise, dim))]).astype(np.float32)
    return [(i, x.tolist(), 0) for i, x in enumerate(v)]


def links_of(rows):
    x = np.array([v for _, v, _ in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return {i: int(n) - 1 for (i, _, _), n in zip(rows, (x @ x.T >= 0.98).sum(axis=1))}


@pytest.mark.parametrize("reach", [0.4, 0.0])
def test_links_of_a_group_over_many_shards(spark, monkeypatch, reach):
    """With a reach of 0 the first attempt falls short; its rows must not be what is returned."""
    monkeypatch.setattr(G, "SHARD_ROWS", 60)
    monkeypatch.setattr(G, "PART_ROWS", 200, raising=False)
    monkeypatch.setattr(G, "REACH", reach, raising=False)
    rows = tight_group()
    want = links_of(rows)
    got = {r.vec_id: r.n_links for r in G.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)).collect()}
    assert sum(want.values()) > 2_000_000
    assert all(got[i] <= n for i, n in want.items()) and sum(got.values()) >= (0.99 if reach else 1) * sum(want.values())


def test_audit_covers_every_hundredth_id_and_counts_pairs(spark, monkeypatch):
    monkeypatch.setattr(G, "SHARD_ROWS", 60)
    rows = tight_group()
    want = links_of(rows)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    audit = G.near_vectors_audited(frame)[1]
    assert audit["links"] == sum(n for i, n in want.items() if i % 100 == 0) and audit["pair_recall"] >= 0.95


def test_audit_goes_by_rows_that_have_a_smaller_twin(spark):
    """Every audited id has an exact copy one below it, and near ones besides; an audit by vertex would be empty."""
    rng, rows = np.random.default_rng(3), []
    for g in range(1, 31):
        v = rng.normal(size=16)
        rows += [(100 * g - 1, v), (100 * g, v)] + [(100 * g + k, v + 0.01 * rng.normal(size=16)) for k in (1, 2, 3, 4)]
    frame = spark.createDataFrame([(i, [float(x) for x in v], "l") for i, v in rows], "vec_id long, embedding array<float>, label string")
    got, audit = G.near_vectors_audited(frame)
    assert audit["links"] == sum(r.n_links for r in got.collect() if r.vec_id % 100 == 0) >= 30 * 5 and audit["recall"] >= 0.95 and audit["pair_recall"] >= 0.95


def test_nothing_audited_is_not_a_recall(spark):
    frame = spark.createDataFrame([(k, [float(k == j) for j in range(4)], "l") for k in range(1, 4)], "vec_id long, embedding array<float>, label string")
    assert G.near_vectors_audited(frame)[1] == {"links": 0, "recall": None, "pair_recall": None, "attempts": 1}
