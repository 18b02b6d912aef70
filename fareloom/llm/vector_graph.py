"""Nearest neighbours by beam search over robust-pruned graphs, one per shard.

Equal vectors are one node with its smallest ids, so copies cannot crowd a node's edges. Nodes are
dealt by hash over shards of bounded size. In each shard a directed graph is built: greedy searches
from the medoid propose neighbours for a batch of nodes; pruning keeps a candidate unless a nearer
kept one is closer to it by the factor alpha, so edges point in diverse directions; reverse edges
are added and pruned alike. Every query is searched with a beam in every shard, in blocks, and the
shards' answers are merged.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fareloom.sources.staging import stage

SHARD_ROWS = 4096
DEGREE = 32
BUILD_BEAM = 64
SEARCH_BEAM = 128
ALPHA = 1.2
EXPAND = 4  # nodes expanded per step
BATCH = 128
QUERY_BLOCK = 2048
PASSES = (1.0, ALPHA)
# A shard is laid around its middle, with typical components near 1, before it is searched. In single
# precision up to these components (of a node; of a query), beyond them in double.
MOST_SINGLE = 1e6
FAR_QUERY = 1e3
MOST_DOUBLE = 1e150  # squares must be finite


# --- one shard, in numpy ---------------------------------------------------------------------


def frame_of(vectors):
    """(centre, scale) of a shard, from medians: outliers do not move them."""
    import numpy as np

    quarter = vectors * 0.25  # the difference of any two is finite
    centre = np.partition(quarter, len(quarter) // 2, axis=0)[len(quarter) // 2]
    reach = np.abs(quarter - centre).max(1)
    reach = reach[reach > 0]
    scale = np.partition(reach, len(reach) // 2)[len(reach) // 2] if len(reach) else 1.0
    return centre, scale


def placed(vectors, frame):
    """Vectors in the frame of a shard, in double precision."""
    import numpy as np

    with np.errstate(over="ignore"):
        return np.clip((vectors * 0.25 - frame[0]) / frame[1], -MOST_DOUBLE, MOST_DOUBLE)


def single(x):
    """In single precision, unless components are too large for it."""
    import numpy as np

    return x.astype(np.float32) if np.abs(x).max() <= MOST_SINGLE else x


def distances(vectors, query):
    """Euclidean distances; scaled where squares overflow."""
    import numpy as np

    with np.errstate(over="ignore", invalid="ignore"):
        out = np.sqrt(((vectors - query) ** 2).sum(1))
        wide = ~np.isfinite(out)
        if wide.any():
            apart = vectors[wide] * 0.25 - query * 0.25
            most = np.abs(apart).max(1)
            out[wide] = most * np.sqrt(((apart / most[:, None]) ** 2).sum(1)) * 4
    return out


def beam_search(x, graph, entry: int, queries, beam: int):
    """(ids, squared distances) of the `beam` best nodes met, for a batch of queries; -1 pads."""
    import numpy as np

    b, n = len(queries), len(x)
    seen = np.zeros((b, n + 1), bool)
    seen[:, n] = True  # the padding node
    ids = np.full((b, beam), n, np.int64)
    dist = np.full((b, beam), np.inf, queries.dtype)
    open_ = np.zeros((b, beam), bool)
    ids[:, 0], open_[:, 0], seen[:, entry] = entry, True, True
    dist[:, 0] = ((x[entry] - queries) ** 2).sum(1)
    while True:
        # Best open nodes of each row; the lists are sorted, so the first ones.
        rank = np.cumsum(open_, 1)
        pick = open_ & (rank <= EXPAND)
        active = pick.any(1)
        if not active.any():
            break
        open_ &= ~pick
        live = np.flatnonzero(active)
        chosen = np.full((len(live), EXPAND), n, np.int64)
        r, c = np.nonzero(pick[live])
        chosen[r, rank[live][r, c] - 1] = ids[live][r, c]
        near = graph[np.minimum(chosen, n - 1)]
        near[chosen == n] = n
        near = near.reshape(len(live), -1)
        near[near < 0] = n
        near.sort(1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = n
        near[seen[live[:, None], near]] = n
        seen[live[:, None], near] = True
        d = ((x[np.minimum(near, n - 1)] - queries[live][:, None, :]) ** 2).sum(2)
        d[near == n] = np.inf
        all_ids = np.concatenate((ids[live], near), 1)
        all_dist = np.concatenate((dist[live], d), 1)
        all_open = np.concatenate((open_[live], near < n), 1)
        order = np.argsort(all_dist, 1, kind="stable")[:, :beam]
        at = np.arange(len(live))[:, None]
        ids[live], dist[live], open_[live] = all_ids[at, order], all_dist[at, order], all_open[at, order]
    return np.where(np.isinf(dist), -1, ids), dist


def robust_prune(x, nodes, candidates, alpha: float, degree: int):
    """The kept out-edges of each node, -1 padded: nearest first, dropping those a kept one covers."""
    import numpy as np

    b, c = candidates.shape
    cand = np.sort(candidates, 1)
    bad = (cand < 0) | (cand == nodes[:, None])
    bad[:, 1:] |= cand[:, 1:] == cand[:, :-1]
    safe = np.maximum(cand, 0)
    v = x[safe] - x[nodes][:, None, :]  # around the node, so that near candidates do not cancel
    to_node = (v**2).sum(2)
    between = to_node[:, :, None] + to_node[:, None, :] - 2 * np.matmul(v, v.transpose(0, 2, 1))
    alive = np.where(bad, np.inf, to_node)
    out = np.full((b, degree), -1, np.int64)
    rows = np.arange(b)
    for k in range(degree):
        best = alive.argmin(1)
        ok = np.isfinite(alive[rows, best])
        if not ok.any():
            break
        out[ok, k] = cand[rows, best][ok]
        covered = alpha * alpha * between[rows, best] <= to_node
        alive[covered & ok[:, None]] = np.inf
        alive[rows, best] = np.inf
    return out


def build_graph(x, degree: int = DEGREE, beam: int = BUILD_BEAM, seed: int = 8):
    """(graph, entry): out-edges of each row of x, and the node searches start from."""
    import numpy as np

    n = len(x)
    entry = int(((x - x.mean(0)) ** 2).sum(1).argmin())
    if n <= degree + 1:
        graph = np.full((n, degree), -1, np.int64)
        for i in range(n):
            graph[i, : n - 1] = [j for j in range(n) if j != i]
        return graph, entry
    rng = np.random.default_rng(seed)
    graph = rng.integers(0, n, (n, degree))
    for alpha in PASSES:
        order = rng.permutation(n)
        for at in range(0, n, BATCH):
            nodes = order[at : at + BATCH]
            met, _ = beam_search(x, graph, entry, x[nodes], beam)
            graph[nodes] = robust_prune(x, nodes, np.concatenate((met, graph[nodes]), 1), alpha, degree)
            # Reverse edges, gathered per target.
            source = np.repeat(nodes, degree)
            target = graph[nodes].ravel()
            source, target = source[target >= 0], target[target >= 0]
            by = np.argsort(target, kind="stable")
            source, target = source[by], target[by]
            own, first, many = np.unique(target, return_index=True, return_counts=True)
            width = min(int(many.max()), degree)
            # A node that many of the batch point to takes them in several rounds.
            for skip in range(0, int(many.max()), width):
                k = np.arange(skip, skip + width)[None, :]
                has = k < many[:, None]
                some = has.any(1)
                new = np.where(has, source[np.minimum(first[:, None] + k, len(source) - 1)], -1)[some]
                t = own[some]
                graph[t] = robust_prune(x, t, np.concatenate((graph[t], new), 1), alpha, degree)
    return graph, entry


def search_shard(vectors, graph, entry: int, ids: list[list[int]], query_ids, queries, k: int, beam: int):
    """(row of the query, vec_id, distance) of the k best ids of each query, itself left out."""
    import numpy as np

    frame, width = frame_of(vectors), max(beam, k + 1)
    x = placed(vectors, frame)
    near_x, out = single(x), []
    for at in range(0, len(queries), BATCH):
        q = queries[at : at + BATCH]
        own_place = placed(q, frame)
        far = np.abs(own_place).max(1) > FAR_QUERY
        met = np.empty((len(q), width), np.int64)
        for some, space in ((~far, near_x), (far, x)):
            if some.any():
                met[some], _ = beam_search(space, graph, entry, own_place[some].astype(space.dtype), width)
        for i, row in enumerate(met):
            nodes = row[row >= 0]
            exact = distances(vectors[nodes], q[i])
            own = int(query_ids[at + i])
            # A little more than k nodes: the query's own may be among them.
            near = np.argsort(exact, kind="stable")[: k + 1]
            last = exact[near[-1]] if len(near) else 0.0
            pairs = [
                (float(d), v)
                for node, d in zip(nodes, exact)
                if d <= last
                for v in ids[node]
                if v != own
            ]
            out += [(at + i, v, d) for d, v in sorted(pairs)[:k]]
    return out


# --- Spark -----------------------------------------------------------------------------------


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and vector (doubles) of rows with an id and a finite vector other than zero."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), v.alias("vector"))
    finite = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows.filter("vec_id is not null and vector is not null").filter(
        finite & F.exists("vector", lambda c: c != 0)
    )


def nodes_of(rows: DataFrame, k: int) -> DataFrame:
    """dim, vector, ids: each different vector with its k + 1 smallest ids (one may be the query's)."""
    rank = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    some = rows.distinct().withColumn("rank", rank).filter(F.col("rank") <= k + 1)
    nodes = some.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return nodes.select(F.size("vector").alias("dim"), "vector", "ids")


def build_index(nodes: DataFrame, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, DataFrame]:
    """(index, shards): a row per shard with its graph, and (dim, shards) per dimension."""
    counts = nodes.groupBy("dim").agg(F.count(F.lit(1)).alias("n"))
    shards = counts.select("dim", F.ceil(F.col("n") / shard_rows).alias("shards"))
    dealt = nodes.join(shards, "dim").withColumn("shard", F.pmod(F.xxhash64("vector"), F.col("shards")))

    def build(table: pa.Table) -> pa.Table:
        import numpy as np

        dim = table.column("dim")[0].as_py()
        vectors = table.column("vector").combine_chunks().flatten().to_numpy().reshape(-1, dim)
        order = np.lexsort(vectors.T[:3])  # the same graph whatever the order rows arrive in
        vectors = vectors[order]
        ids = table.column("ids").take(pa.array(order)).to_pylist()
        graph, entry = build_graph(single(placed(vectors, frame_of(vectors))))
        return pa.table(
            {
                "dim": pa.array([dim], pa.int32()),
                "shard": table.column("shard").slice(0, 1).cast(pa.int64()),
                "entry": pa.array([entry], pa.int32()),
                "vectors": pa.array([vectors.tobytes()], pa.binary()),
                "graph": pa.array([graph.astype(np.int32).tobytes()], pa.binary()),
                "ids": pa.array([ids], pa.list_(pa.list_(pa.int64()))),
            }
        )

    schema = "dim int, shard bigint, entry int, vectors binary, graph binary, ids array<array<bigint>>"
    # A fixed number of partitions: shards are small in bytes but long in work, so none are merged.
    most = shards.agg(F.sum("shards")).first()[0] or 1
    dealt = dealt.select("dim", "shard", "vector", "ids").repartition(int(most), "dim", "shard")
    index = dealt.groupBy("dim", "shard").applyInArrow(build, schema)
    return stage(index, "index"), shards


def search(index: DataFrame, shards: DataFrame, queries: DataFrame, k: int, beam: int = SEARCH_BEAM) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found for each (vec_id, vector) of `queries`."""
    queries = queries.distinct().withColumn("dim", F.size("vector"))
    sizes = queries.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).alias("blocks"))
    sizes = stage(sizes.join(shards, "dim"), "blocks")
    asked = queries.join(sizes, "dim").select(
        "dim",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shards") - 1)).alias("shard"),
        F.pmod(F.xxhash64("vec_id", "vector"), F.col("blocks")).alias("block"),
        "vec_id",
        "vector",
    )
    held = index.join(sizes, "dim").withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    )
    held = held.drop("blocks", "shards")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        import numpy as np

        names = ["query_id", "vector", "vec_id", "score"]
        types = [pa.int64(), pa.list_(pa.float64()), pa.int64(), pa.float64()]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], t) for t in types], names=names)
        dim = left.column("dim")[0].as_py()
        queries = left.column("vector").combine_chunks().flatten().to_numpy().reshape(-1, dim)
        own = left.column("vec_id").to_numpy()
        r = right.slice(0, 1).to_pylist()[0]
        vectors = np.frombuffer(r["vectors"]).reshape(-1, dim)
        graph = np.frombuffer(r["graph"], np.int32).reshape(len(vectors), -1).astype(np.int64)
        rows = search_shard(vectors, graph, r["entry"], r["ids"], own, queries, k, beam)
        at = pa.array([i for i, _, _ in rows], pa.int64())
        return pa.table(
            [
                left.column("vec_id").take(at),
                left.column("vector").take(at),
                pa.array([v for _, v, _ in rows], pa.int64()),
                pa.array([d for _, _, d in rows], pa.float64()),
            ],
            names=names,
        )

    key = ["dim", "shard", "block"]
    found = asked.groupBy(*key).cogroup(held.groupBy(*key)).applyInArrow(
        run, "query_id bigint, vector array<double>, vec_id bigint, score double"
    )
    best = Window.partitionBy("query_id", "vector").orderBy("score", "vec_id")
    ranked = found.distinct().withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def nearest(
    vectors: DataFrame,
    every: int = 100,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    beam: int = SEARCH_BEAM,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest other rows of every row whose id `every` divides.

    Euclidean distance in double precision on the original vectors; ties go to the smaller id. Rows
    with a null id, or a vector that is null, zero or holds null or non-finite components, take no
    part. Vectors meet only those of their own length. Rows repeated with their id count once; an
    id with several vectors is asked, and may be found, with each. With fewer than k others all are
    returned; an empty table gives an empty result. Vectors may lie anywhere and have any finite
    components: the graphs are built and searched around each shard's middle.
    """
    rows = usable(vectors, id_col, vector_col)
    nodes = stage(nodes_of(rows, k), "nodes")
    index, shards = build_index(nodes, shard_rows)
    return search(index, shards, rows.filter(F.col("vec_id") % every == 0), k, beam)
