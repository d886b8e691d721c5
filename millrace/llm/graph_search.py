"""Approximate nearest neighbours by robust-pruned directed graphs.

Distinct vectors are dealt to shards of bounded size. A shard's graph is built in batches: greedy
beam searches from fixed entries propose neighbours, pruning with relaxed distances keeps diverse
edges, and reverse edges are added and pruned alike. Every query runs a beam search in every shard;
what a beam found is scored again in double precision on the original vectors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.shared import forget, map_batches, map_groups, one_thread, staged
from millrace.llm.vectors import directions, matrix, unit, usable

SHARD_ROWS = 8192
DEGREE = 32
RELAX = 1.2
BUILD_BEAM = 64
SEARCH_BEAM = 320
ENTRIES = 16
EXPAND = 4
BATCH = 256
QUERY_BLOCK = 20_000


def beam_search(
    x: np.ndarray, graph: np.ndarray, entries: np.ndarray, queries: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """The ``width`` nodes nearest to each query that a greedy beam reaches, best first.

    ``graph`` holds -1 for no edge. Places without a node have id -1 and similarity -inf.
    """
    n, m = len(x), len(queries)
    rows = np.arange(m)[:, None]
    ids = np.full((m, width), -1)
    sims = np.full((m, width), -np.inf, np.float32)
    k = min(width, len(entries))
    ids[:, :k] = entries[:k]
    sims[:, :k] = queries @ x[entries[:k]].T
    order = np.argsort(-sims, axis=1, kind="stable")
    ids, sims = ids[rows, order], sims[rows, order]
    seen = np.zeros((m, n + 1), bool)
    seen[:, entries] = True
    seen[:, n] = True
    open_ = ids >= 0
    live = np.arange(m)
    while len(live):
        # The first open places of each beam, best first.
        at = np.argsort(~open_[live], axis=1, kind="stable")[:, :EXPAND]
        mine = np.arange(len(live))[:, None]
        chosen = np.where(open_[live[:, None], at], ids[live[:, None], at], -1)
        open_[live[:, None], at] = False
        near = np.where(chosen[:, :, None] >= 0, graph[chosen], -1).reshape(len(live), -1)
        near = np.where(near < 0, n, near)
        fresh = ~seen[live[:, None], near]
        seen[live[:, None], near] = True
        # A node named twice in one step counts once.
        rank = np.argsort(near, axis=1, kind="stable")
        same = np.zeros_like(fresh)
        sorted_ = near[mine, rank]
        same[mine, rank[:, 1:]] = sorted_[:, 1:] == sorted_[:, :-1]
        fresh &= ~same
        line, column = np.nonzero(fresh)
        found = np.full(near.shape, -np.inf, np.float32)
        nodes = near[line, column]
        found[line, column] = np.einsum("ij,ij->i", queries[live[line]], x[nodes])
        all_sims = np.concatenate([sims[live], found], 1)
        all_ids = np.concatenate([ids[live], np.where(fresh, near, -1)], 1)
        all_open = np.concatenate([open_[live], fresh], 1)
        order = np.argsort(-all_sims, axis=1, kind="stable")[:, :width]
        sims[live], ids[live] = all_sims[mine, order], all_ids[mine, order]
        open_[live] = all_open[mine, order] & (ids[live] >= 0)
        live = live[open_[live].any(axis=1)]
    return ids, sims


def robust_prune(
    x: np.ndarray, nodes: np.ndarray, cands: np.ndarray, degree: int, relax: float
) -> np.ndarray:
    """Up to ``degree`` diverse neighbours of each node among its candidates (-1: none).

    The nearest candidate is kept, and each other that is nearer to it, by the relaxed distance,
    than to the node is dropped; then the next nearest, and so on.
    """
    m = len(nodes)
    vectors = x[np.maximum(cands, 0)]
    own = 2 - 2 * np.einsum("ij,ikj->ik", x[nodes], vectors)
    own[(cands < 0) | (cands == nodes[:, None])] = np.inf
    out = np.full((m, degree), -1)
    for place in range(degree):
        best = own.argmin(axis=1)
        line = np.flatnonzero(np.isfinite(own[np.arange(m), best]))
        if not len(line):
            break
        best = best[line]
        out[line, place] = cands[line, best]
        between = 2 - 2 * np.einsum("ij,ikj->ik", vectors[line, best], vectors[line])
        gone = relax * relax * between <= own[line]
        gone[np.arange(len(line)), best] = True
        own[line] = np.where(gone, np.inf, own[line])
    return out


def build_graph(
    x: np.ndarray, degree: int = DEGREE, relax: float = RELAX, beam: int = BUILD_BEAM
) -> tuple[np.ndarray, np.ndarray]:
    """Neighbours of each unit vector, and the entries of every search."""
    n = len(x)
    order = np.random.default_rng(0).permutation(n)
    graph = np.full((n, degree), -1)
    entries = order[:ENTRIES]
    done = len(entries)
    cands = np.repeat(entries[None, :], done, 0)
    graph[entries] = robust_prune(x, entries, cands, degree, relax)
    while done < n:
        batch = order[done : done + max(1, min(BATCH, done))]
        found, _ = beam_search(x, graph, entries, x[batch], beam)
        # Others of the batch may be near as well.
        near = x[batch] @ x[batch].T
        mates = np.argsort(-near, axis=1, kind="stable")[:, : min(len(batch), 16)]
        cands = np.concatenate([found, batch[mates]], 1)
        graph[batch] = robust_prune(x, batch, cands, degree, relax)
        _add_reverse(x, graph, batch, degree, relax)
        done += len(batch)
    return graph, entries


def _add_reverse(
    x: np.ndarray, graph: np.ndarray, batch: np.ndarray, degree: int, relax: float
) -> None:
    source = np.repeat(batch, degree)
    target = graph[batch].ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    nodes, first, many = np.unique(target, return_index=True, return_counts=True)
    wide = np.full((len(nodes), degree + int(many.max(initial=0))), -1)
    wide[:, :degree] = graph[nodes]
    line = np.repeat(np.arange(len(nodes)), many)
    wide[line, degree + np.arange(len(target)) - np.repeat(first, many)] = source
    for part in np.array_split(np.arange(len(nodes)), -(-len(nodes) // 1024) or 1):
        if not len(part):
            continue
        own = wide[part]
        # A reverse edge that is there already is not new.
        rank = np.argsort(own, axis=1, kind="stable")
        mine = np.arange(len(part))[:, None]
        put = own[mine, rank]
        put[:, 1:][put[:, 1:] == put[:, :-1]] = -1
        fits = (put >= 0).sum(axis=1) <= degree
        packed = put[mine, np.argsort(put < 0, axis=1, kind="stable")][:, :degree]
        graph[nodes[part[fits]]] = packed[fits]
        full = ~fits
        if full.any():
            graph[nodes[part[full]]] = robust_prune(x, nodes[part[full]], put[full], degree, relax)


def build_index(distinct: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``shard, dim, place, entry, _vid, vector, neighbours`` of every distinct vector."""
    sizes = distinct.groupBy("dim").agg(F.ceil(F.count("*") / shard_rows).alias("shards"))
    dealt = distinct.join(F.broadcast(sizes), "dim").select(
        "dim",
        F.pmod(F.xxhash64("_vid"), F.col("shards")).alias("part"),
        "_vid",
        "vector",
    )
    keyed = dealt.withColumn("shard", F.xxhash64("dim", "part"))

    def build(group: pa.Table) -> dict:
        one_thread()
        group = group.sort_by("_vid")
        x = unit(matrix(group.column("vector"))).astype(np.float32)
        graph, entries = build_graph(x)
        entry = np.zeros(len(x), bool)
        entry[entries] = True
        return {
            "shard": group.column("shard").combine_chunks(),
            "dim": group.column("dim").combine_chunks(),
            "place": np.arange(len(x)),
            "entry": entry,
            "_vid": group.column("_vid").combine_chunks(),
            "vector": group.column("vector").cast(pa.list_(pa.float64())).combine_chunks(),
            "neighbours": pa.array(list(graph.astype(np.int32)), pa.list_(pa.int32())),
        }

    ddl = (
        "shard long, dim int, place int, entry boolean, _vid long, vector array<double>, "
        "neighbours array<int>"
    )
    return map_groups(keyed, "shard", build, ddl)


def _search(group: pa.Table, k: int, beam: int) -> dict | None:
    """What a beam finds of the ``k`` + 1 nearest directions of each query, with all that tie."""
    one_thread()
    asks = group.filter(pa.compute.is_null(group.column("place")))
    shard = group.filter(pa.compute.is_valid(group.column("place"))).sort_by("place")
    if not len(asks) or not len(shard):
        return None
    exact = unit(matrix(shard.column("vector")))
    x = exact.astype(np.float32)
    graph = matrix(shard.column("neighbours")).astype(np.int64)
    entries = np.flatnonzero(shard.column("entry").to_numpy())
    vids = shard.column("_vid").to_numpy()
    queries = unit(matrix(asks.column("vector")))
    names = asks.column("_vid").to_numpy()
    out: dict[str, list] = {"query": [], "found": [], "score": []}
    for a in range(0, len(queries), BATCH):
        ids, _ = beam_search(x, graph, entries, queries[a : a + BATCH].astype(np.float32), beam)
        score = np.einsum("ij,ikj->ik", queries[a : a + BATCH], exact[np.maximum(ids, 0)])
        score[ids < 0] = -np.inf
        # A query's own direction and k others are enough, but for equal scores.
        least = np.sort(score, axis=1)[:, ::-1][:, min(k, beam - 1)]
        line, column = np.nonzero((ids >= 0) & (score >= least[:, None]))
        out["query"].append(names[a + line])
        out["found"].append(vids[ids[line, column]])
        out["score"].append(score[line, column])
    return {name: np.concatenate(parts) for name, parts in out.items()}


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    beam: int = SEARCH_BEAM,
    id_column: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each query row.

    Nearness is the cosine, in double precision; ties go to the smaller id. Candidates are all rows
    of the query's vector length but the query's own row; a repeated id or an equal vector is a
    candidate of its own. Vectors of one direction, scaled copies among them, have equal scores
    with every query: they are one node of the graph, and the smallest ids of it answer. Rows whose
    vector is null, empty, zero or holds a null or non-finite component take no part. A query has
    fewer rows if there are fewer candidates. ``is_query`` null means no. A null id is the largest
    in a tie. An empty table gives no rows; other columns are not read.
    """
    given = vectors.filter(usable(vector)).select(
        F.col(id_column).alias("id"),
        F.col(vector).cast("array<double>").alias("vector"),
        F.size(vector).alias("dim"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )

    def name(batch):
        dims = batch.column(batch.schema.get_field_index("dim")).to_numpy()
        column = batch.column(batch.schema.get_field_index("vector"))
        names = np.zeros(len(dims), np.int64)
        for d in np.unique(dims).tolist():
            names[dims == d] = directions(matrix(column.filter(pa.array(dims == d))))
        yield {"_vid": names}

    named = map_batches(given, name, "_vid long", given.columns)
    rows = staged(named.withColumn("_row", F.monotonically_increasing_id()), "vectors")
    # Of one direction, k + 1 rows can be among a query's nearest.
    by_id = W.partitionBy("_vid").orderBy(F.col("id").asc_nulls_last(), "_row")
    few = rows.select("_vid", "id", "_row", F.row_number().over(by_id).alias("n"))
    few = staged(few.filter(F.col("n") <= k + 1).drop("n"), "few")
    distinct = rows.groupBy("_vid").agg(
        F.first("dim").alias("dim"), F.min_by("vector", F.struct("id", "_row")).alias("vector")
    )
    index = staged(build_index(distinct), "index")
    asked = rows.filter("asks")
    shards = index.select("dim", "shard").distinct()
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    block = F.pmod(F.xxhash64("_vid"), F.lit(blocks))

    def key(part: Column) -> Column:
        return F.xxhash64(F.col("shard"), part)

    asks = (
        asked.select("_vid", "dim", "vector")
        .dropDuplicates(["_vid"])
        .join(shards, "dim")
        .select("_vid", "vector", "shard", block.alias("block"))
        .select(key(F.col("block")).alias("key"), "_vid", "vector")
    )
    held = index.select(
        F.explode(F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda b: F.xxhash64(F.col("shard"), b.cast("long")))).alias("key"),
        "_vid",
        "vector",
        "place",
        "entry",
        "neighbours",
    )
    both = asks.unionByName(held, allowMissingColumns=True)
    found = staged(
        map_groups(
            both, "key", lambda g: _search(g, k, beam), "query long, found long, score double"
        ),
        "found",
    )
    forget(index)
    # Equal scores may hide a smaller id, so all that tie with the last go on.
    best = W.partitionBy("query").orderBy(F.desc("score"))
    near = found.withColumn("n", F.rank().over(best)).filter(F.col("n") <= k + 1)
    pairs = (
        near.join(few, near["found"] == few["_vid"])
        .select("query", "score", F.col("id").alias("vec_id"), F.col("_row").alias("other"))
        .join(
            asked.select(F.col("_vid").alias("query"), F.col("id").alias("query_id"), "_row"),
            "query",
        )
        .filter("other != _row")
    )
    rank = W.partitionBy("_row").orderBy(
        F.desc("score"), F.col("vec_id").asc_nulls_last(), "other"
    )
    return (
        pairs.withColumn("rank", F.row_number().over(rank).cast("int"))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
