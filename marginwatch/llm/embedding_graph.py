"""Near-duplicate vectors by a robust-pruned flat graph, built on overlapping cluster shards.

Only vectors of one label meet. Each vector is dealt to the shard of its nearest centre (its home), and is
sent as a visitor to every shard whose members can be near it: if y is nearer to centre c' than to c and
|x - y| <= r, then x.c - x.c' <= r |c - c'|. r that belongs to the threshold makes this exact; REACH of it
is tried first. However many shards a tight group is cut into, its vectors visit all of them.

In its home shard a vector is searched in a graph: each vector's candidates are pruned so that a neighbour is
kept only if no kept one is nearer to it (scaled by ALPHA), edges go both ways, and a beam walks from the
shard's medoid; once a vector within the threshold is met, all its neighbours are expanded while they stay
within range. Visitors are compared with the members of a shard in blocks, in double precision.

Dealing has two levels, so that the centres stay few: at most FANOUT for a label, and again for each shard
that is still large. Exact copies are one vertex with a count. A shard's links leave it as a count for each
vector and a spanning forest, never as all pairs. Recall is measured in every run: vectors with
an id divisible by AUDIT, all of them, visit by the exact reach and are compared in blocks at home too. If the graph and the narrow
reach give less than LEAST_RECALL of their links, counted with or without copies, the run is repeated with
the exact reach and blocks for all, which misses nothing.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged
from .components import connected_components

#: Members of a shard that dealing aims at, vectors that its centres are fitted on (in expectation), centres, rows that one task compares.
SHARD_ROWS, MAX_FITTED, FANOUT, PART_ROWS = 1_500, 4_096, 256, 12_000
#: Share of the exact reach that is tried first: in 64 dimensions over three deviations of a link's part along one direction.
REACH = 0.4
#: Edges of a vector, candidates that are pruned to them, pruning factor, beam of the search.
EDGES, CANDIDATES, ALPHA, BEAM = 24, 64, 1.2, 24
AUDIT, LEAST_RECALL = 100, 0.95


def _rows(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    a = pc.list_flatten(column).to_numpy().astype(float).reshape(len(column), dim)
    a /= np.abs(a).max(axis=1, keepdims=True)
    return a / np.linalg.norm(a, axis=1, keepdims=True)


def centres_of(sample: np.ndarray, n: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means, started from a fixed choice."""
    c = sample[np.random.default_rng(len(sample)).choice(len(sample), min(n, len(sample)), replace=False)]
    for _ in range(rounds):
        at = (sample @ c.T).argmax(axis=1)
        for k in range(len(c)):
            if (at == k).any():
                c[k] = sample[at == k].mean(axis=0)
        c = c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def build_graph(x: np.ndarray, edges: int = EDGES, candidates: int = CANDIDATES, alpha: float = ALPHA) -> np.ndarray:
    """Robust-pruned neighbours of each row of unit vectors, padded with -1."""
    n = len(x)
    out = np.full((n, edges), -1, np.int64)
    k = min(candidates, n - 1)
    if k < 1:
        return out
    rng = np.random.default_rng(n)
    for a in range(0, n, 512):
        sims = x[a:a + 512] @ x.T
        rows = np.arange(len(sims))
        sims[rows, a + rows] = -2
        near = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        far = rng.integers(0, n, (len(sims), 8))  # long edges, so that the walk crosses the shard
        pool = np.concatenate([near, far], axis=1)
        d = 1 - np.take_along_axis(sims, pool, axis=1)
        d[d > 2.5] = np.inf  # itself
        order = np.argsort(d, axis=1)
        pool, d = np.take_along_axis(pool, order, axis=1), np.take_along_axis(d, order, axis=1)
        alive = np.isfinite(d)
        vectors = x[pool]
        for e in range(edges):
            any_left = alive.any(axis=1)
            if not any_left.any():
                break
            first = alive.argmax(axis=1)
            pick = pool[rows, first]
            out[a + rows[any_left], e] = pick[any_left]
            between = 1 - np.einsum("ijk,ik->ij", vectors, x[pick])
            alive &= ~(alpha * between <= d + 1e-12) & any_left[:, None]
            alive[rows, first] = False
    return out


def both_ways(graph: np.ndarray) -> list[np.ndarray]:
    """Adjacency lists with each edge in both directions, so that every vector is reached from what it reaches."""
    at, k = np.nonzero(graph >= 0)
    pairs = np.stack([np.concatenate([at, graph[at, k]]), np.concatenate([graph[at, k], at])])
    pairs = np.unique(pairs, axis=1)
    return np.split(pairs[1], np.searchsorted(pairs[0], np.arange(1, len(graph))))


def search(x: np.ndarray, graph: list[np.ndarray], medoid: int, q: int, least: float, beam: int) -> np.ndarray:
    """The rows of x within the threshold of row q, itself left out: a greedy walk with a beam from the medoid,
    and from q's own edges, then expansion of all that is in range."""
    v, seen, walked, hits = x[q], {medoid, q}, {q}, []
    best = [(float(x[medoid] @ v), medoid)]
    if medoid != q and best[0][0] >= least:
        hits.append(medoid)
    at = q
    while True:
        new = np.array([j for j in graph[at].tolist() if j not in seen], np.int64)
        if len(new):
            seen.update(new.tolist())
            sims = x[new] @ v
            hits += new[sims >= least].tolist()
            best = sorted(best + list(zip(sims.tolist(), new.tolist())), reverse=True)[:beam]
        at = next((i for _, i in best if i not in walked), None)
        if at is None:
            break
        walked.add(at)
    grow = [h for h in hits if h not in walked]
    while grow:
        new = np.array([j for j in np.unique(np.concatenate([graph[i] for i in grow])).tolist() if j not in seen], np.int64)
        seen.update(new.tolist())
        grow = new[x[new] @ v >= least].tolist() if len(new) else []
        hits += grow
    return np.array(hits, np.int64)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema)


def _deal(points: DataFrame, dim: int, narrow: float, exact: float) -> DataFrame:
    """points (vertex, audited, shard, home, near, v) with shards of over SHARD_ROWS members dealt out to smaller ones.
    A vertex is a member where home is true; near says that the narrow reach leads it there."""
    spark = points.sparkSession
    sizes = points.where("home").groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where(f"n > {SHARD_ROWS}")
    draw = F.pmod(F.xxhash64("vertex", "shard"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    sample = points.where("home").join(sizes, "shard").where(draw * F.col("n") < MAX_FITTED).select("shard", "n", "vertex", "v")

    def fit(key, table):
        x = _rows(table.sort_by("vertex").column("v"), dim)
        c = centres_of(x, min(FANOUT, -(-table.column("n")[0].as_py() // SHARD_ROWS)))
        return pa.table({"shard": pa.array([key[0].as_py()], pa.string()), "centres": pa.array([c.astype("<f8").tobytes()], pa.binary())})

    fitted = sample.groupBy("shard").applyInArrow(fit, "shard string, centres binary").collect()
    centres = {r.shard: np.frombuffer(r.centres, "<f8").reshape(-1, dim) for r in fitted}
    sent = spark.sparkContext.broadcast({k: (c, np.sqrt(np.maximum(0, 2 - 2 * c @ c.T))) for k, c in centres.items()})

    def assign(batches):
        for batch in batches:
            if not len(batch):
                continue
            shards, vertex, audited, home, near = (np.array(batch.column(c).to_pylist()) for c in ("shard", "vertex", "audited", "home", "near"))
            x, take, names, homes, nears = _rows(batch.column("v"), dim), [], [], [], []
            for shard in np.unique(shards).tolist():
                mine = np.flatnonzero(shards == shard)
                if shard not in sent.value:
                    take.append(mine), names.extend([shard] * len(mine)), homes.append(home[mine]), nears.append(near[mine])
                    continue
                c, apart = sent.value[shard]
                s = x[mine] @ c.T
                best = s.argmax(axis=1)
                behind = s[np.arange(len(mine)), best][:, None] - s
                within = behind <= narrow * apart[best] + 1e-9
                at, k = np.nonzero((audited[mine] > 0)[:, None] & (behind <= exact * apart[best] + 1e-9) | within)
                take.append(mine[at]), names.extend(f"{shard}/{j}" for j in k.tolist())
                homes.append(home[mine[at]] & (k == best[at])), nears.append(near[mine[at]] & within[at, k])
            take = np.concatenate(take)
            yield pa.RecordBatch.from_arrays([pa.array(vertex[take]), pa.array(audited[take]), pa.array(names, pa.string()), pa.array(np.concatenate(homes)), pa.array(np.concatenate(nears)), batch.column("v").take(pa.array(take))], ["vertex", "audited", "shard", "home", "near", "v"])

    return staged(points.select("vertex", "audited", "shard", "home", "near", "v").mapInArrow(assign, "vertex long, audited long, shard string, home boolean, near boolean, v array<float>"), "graph-shards")


def _find(points: DataFrame, copies: DataFrame, dim: int, least: float, reach: float, beam: int) -> DataFrame:
    """(vertex, other, n, pairs, near): for a vertex in a shard, copies and vertices found within the threshold,
    near if graph and narrow reach find them; and, with other, the edges of the shard's forest. A reach of 1
    is exact and does without the graph."""
    exact = float(np.sqrt(2 - 2 * least))
    for _ in range(2):
        points = _deal(points, dim, reach * exact, exact)
    # A shard with many visitors is compared in parts, each with all members.
    parts = points.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / PART_ROWS).cast("int").alias("parts"))
    mine = F.pmod(F.xxhash64("vertex"), "parts").cast("int")
    rows = points.join(F.broadcast(parts), "shard").withColumn("part", F.explode(F.when(F.col("home"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(mine))))
    rows = rows.withColumn("asks", F.col("part") == mine).drop("parts").join(copies, "vertex")
    schema = pa.schema([("vertex", pa.int64()), ("other", pa.int64()), ("n", pa.int64()), ("pairs", pa.int64()), ("near", pa.bool_())])

    def walk(key, table):
        table = table.sort_by([("home", "descending"), ("vertex", "ascending")])
        ids, weights, audited, home, near, asks = (np.array(table.column(c).to_pylist()) for c in ("vertex", "copies", "audited", "home", "near", "asks"))
        m = int(home.sum())  # members come first
        if not m:
            return _table([], schema)
        v = _rows(table.column("v"), dim)
        x, weights = v[:m], weights[:m]
        graph = both_ways(build_graph(x)) if reach < 1 and asks[:m].any() else None
        medoid = int((x @ x.mean(axis=0)).argmax())
        root, out = np.arange(m), []
        asking = np.flatnonzero(asks)
        for a in range(0, len(asking), 512):
            block = asking[a:a + 512]
            hit = v[block] @ x.T >= least
            inside = np.flatnonzero(block < m)
            hit[inside, block[inside]] = False
            for q, found in zip(block.tolist(), hit):
                walked = q < m and graph is not None
                if walked:
                    hits = search(x, graph, medoid, q, least - 1e-9, beam)
                    hits = hits[x[hits] @ x[q] >= least]
                    out.append((int(ids[q]), None, int(weights[hits].sum()), len(hits), True))
                if not walked or audited[q]:
                    full = np.flatnonzero(found)
                    less = hits if walked else full[:0]
                    if len(full) > len(less):
                        out.append((int(ids[q]), None, int(weights[full].sum() - weights[less].sum()), len(full) - len(less), bool(near[q]) and not walked))
                    hits = full
                roots = np.unique(root[np.append(hits, q)] if q < m else root[hits])
                first = int(ids[roots[0]] if q < m else ids[q]) if len(roots) else None
                out += [(first, int(ids[r]), 0, 0, True) for r in roots[q < m:].tolist()]
                if len(roots) > 1:
                    root[np.isin(root, roots)] = roots[0]
        return _table(out, schema)

    return staged(rows.groupBy("shard", "part").applyInArrow(walk, "vertex long, other long, n long, pairs long, near boolean"), "graph-found")


def _recall(found: DataFrame, vertices: DataFrame) -> dict:
    """Of the rows with an id divisible by AUDIT: links, and the share of them that graph and narrow reach find,
    with copies and by pairs of vertices; None where there is no link to measure it by."""
    total = lambda c, when=F.lit(True): F.coalesce(F.sum(F.when(when, F.col(c) * F.col("audited"))), F.lit(0))
    asked = vertices.where("audited > 0").select("vertex", "audited", "copies")
    copies = asked.withColumn("own", F.col("copies") - 1).agg(total("own").alias("n")).first().n
    r = found.where("other is null").join(asked, "vertex").agg(
        total("n").alias("n"), total("pairs").alias("pairs"), total("n", F.col("near")).alias("got"), total("pairs", F.col("near")).alias("got_pairs")).first()
    links = r.n + copies  # equal vectors are one vertex, so their links are never missed
    return {"links": links, "recall": (r.got + copies) / links if links else None, "pair_recall": r.got_pairs / r.pairs if r.pairs else None}


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", least: float = 0.98) -> DataFrame:
    """The rows of near_vectors_audited, whose recall is assured."""
    return near_vectors_audited(vectors, id_col, vector_col, label_col, least)[0]


def near_vectors_audited(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", least: float = 0.98) -> tuple[DataFrame, dict]:
    """One row per input row: vec_id, n_links, component_id, kept.

    Vectors link when their labels are equal and not null and their cosine is at least `least`. A vector that
    is null, empty or zero, or holds a null or a number that is not finite, links with nothing, nor does one
    of another dimension than the most common. Rows that repeat an id are one vector with the links of all
    of them; a null id links with nothing, its component is null and it is kept. An empty table gives no row.

    The second value has the audited links and the recall, weighted by copies and by pairs, of the attempt
    whose rows these are; attempts is 2 if the first fell short. Without audited links nothing is measured: the
    recall is None, and the first attempt stands.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<float>").alias("v"))
    sane = "size(v) > 0 and forall(v, x -> coalesce(abs(x) < float('inf'), false) and not isnan(x)) and exists(v, x -> x <> 0)"
    usable = rows.where("vec_id is not null and label is not null").where(f"coalesce({sane}, false)")
    common = usable.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if common is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")), {"links": 0, "recall": None, "pair_recall": None, "attempts": 0}
    dim = common.dim
    usable = usable.where(F.size("v") == dim)
    vertices = staged(usable.groupBy("label", "v").agg(F.min("vec_id").alias("vertex"), F.count(F.lit(1)).alias("copies"), F.count_if(F.col("vec_id") % AUDIT == 0).alias("audited")), "graph-vertices")
    points = vertices.select("vertex", "audited", F.col("label").alias("shard"), F.lit(True).alias("home"), F.lit(True).alias("near"), "v")
    for attempt, reach in enumerate((REACH, 1.0), 1):
        found = _find(points, vertices.select("vertex", "copies"), dim, least, reach, BEAM)
        audit = _recall(found, vertices) | {"attempts": attempt}
        if all(audit[k] is None or audit[k] >= LEAST_RECALL for k in ("recall", "pair_recall")):
            break
    else:
        raise RuntimeError(f"exact comparison missed audited links: {audit}")
    members = usable.join(vertices.select("label", "v", "vertex", "copies"), ["label", "v"]).select("vec_id", "vertex", "copies")
    links = found.where("other is not null").select(F.col("vertex").alias("a"), F.col("other").alias("b")).union(members.where("vec_id <> vertex").select("vec_id", "vertex"))
    components = staged(connected_components(links), "graph-components")
    counts = members.join(found.groupBy("vertex").agg(F.sum("n").alias("n")), "vertex", "left").groupBy("vec_id").agg(F.sum(F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = rows.select("vec_id").join(staged(counts, "graph-counts"), "vec_id", "left").join(components.withColumnRenamed("id", "vec_id"), "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept")), audit

