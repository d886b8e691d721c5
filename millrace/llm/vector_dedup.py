"""Embedding near-duplicates by a PCA-ordered tiled comparison.

Unit vectors are turned onto the principal axes of all vectors, which leaves cosines as they are.
Within a label, blocks of vectors are compared tile by tile: products of the leading dimensions are
summed first, what the rest can add is bounded by the product of the suffix norms, and a pair is
dropped as soon as sum and bound stay below the threshold. What is left is decided on the original
vectors. A tile returns link counts and a forest of its links, never pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import Broadcasted, components, map_batches, map_groups, meetings, staged
from millrace.llm.vectors import matrix, principal_axes, unit, usable

THRESHOLD = 0.98
STEPS = (8, 16, 32)
TILE = 512
BLOCK_ROWS = 4096
# Bounds are compared with a little room for rounding; the last test is exact.
ROOM = 1e-9


def close_pairs(
    turned: np.ndarray, exact: np.ndarray, left: slice, right: slice, threshold: float
) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of two tiles whose cosine reaches ``threshold``."""
    a, b = turned[left], turned[right]
    steps = [s for s in STEPS if s < a.shape[1]] or [a.shape[1]]
    head = a[:, : steps[0]] @ b[:, : steps[0]].T
    rest_a = np.sqrt(np.maximum(1 - np.cumsum(a * a, axis=1), 0))
    rest_b = np.sqrt(np.maximum(1 - np.cumsum(b * b, axis=1), 0))
    bound = head + rest_a[:, steps[0] - 1][:, None] * rest_b[:, steps[0] - 1]
    i, j = np.nonzero(bound >= threshold - ROOM)
    sums = head[i, j]
    for start, stop in zip(steps[:-1], steps[1:], strict=True):
        sums = sums + np.einsum("ij,ij->i", a[i, start:stop], b[j, start:stop])
        alive = sums + rest_a[i, stop - 1] * rest_b[j, stop - 1] >= threshold - ROOM
        i, j, sums = i[alive], j[alive], sums[alive]
    i, j = i + left.start, j + right.start
    alive = np.einsum("ij,ij->i", exact[i], exact[j]) >= threshold
    return i[alive], j[alive]


def _compare(block: pa.Table, axes: dict[int, np.ndarray], threshold: float) -> dict | None:
    ids, first = np.unique(block.column("_vid").to_numpy(), return_index=True)
    block = block.take(pa.array(first))
    raw = matrix(block.column("vector"))
    side = block.column("side").to_numpy()
    inner = bool(block.column("inner")[0].as_py())
    weight = block.column("copies").to_numpy()
    exact = unit(raw)
    turned = exact @ axes[raw.shape[1]]
    m = len(ids)
    parent = np.arange(m)
    links = np.zeros(m, np.int64)

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    tiles = [slice(t, min(t + TILE, m)) for t in range(0, m, TILE)]
    for at, left in enumerate(tiles):
        for right in tiles[at:]:
            i, j = close_pairs(turned, exact, left, right, threshold)
            keep = i < j if inner else (i < j) & (side[i] != side[j])
            i, j = i[keep], j[keep]
            np.add.at(links, i, weight[j])
            np.add.at(links, j, weight[i])
            for x, y in zip(i.tolist(), j.tolist(), strict=True):
                x, y = find(x), find(y)
                if x != y:
                    parent[max(x, y)] = min(x, y)
    some = np.flatnonzero(links)
    if not len(some):
        return None
    roots = np.array([find(x) for x in some.tolist()])
    return {"a": ids[some], "b": ids[roots], "n": links[some]}


def near_duplicates(
    vectors: DataFrame,
    carry: list[str],
    threshold: float = THRESHOLD,
    id_column: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """``carry`` columns of every vector, ``n_links``, ``component_id`` and ``kept``.

    Vectors link if their labels are equal and not null, their lengths are equal and their cosine
    reaches ``threshold``. A vector that is null, empty, zero or holds a null or non-finite
    component links with nothing and keeps its own id. Equal vectors of a label are compared once
    and counted as often as they occur. A component's id is its least id; ids that repeat are rows
    of their own; a null id is carried, and counts only where a component has no other.
    """
    carry = list(dict.fromkeys([id_column, *carry]))
    held = [f"_c{i}" for i in range(len(carry))]
    valid = usable(vector) & F.col(label).isNotNull()
    rows = staged(
        vectors.select(
            *[F.col(f"`{c}`").alias(h) for c, h in zip(carry, held, strict=True)],
            F.when(valid, F.xxhash64(label, vector)).alias("_vid"),
            F.when(valid, F.xxhash64(label, F.size(vector))).alias("group"),
            F.when(valid, F.size(vector)).alias("dim"),
            F.when(valid, F.col(vector)).alias("vector"),
        ),
        "vectors",
    )
    distinct = rows.filter("_vid is not null").groupBy("_vid").agg(
        F.first("group").alias("group"),
        F.first("dim").alias("dim"),
        F.first("vector").alias("vector"),
        F.count("*").alias("copies"),
        F.min("_c0").alias("least"),
    )
    distinct = staged(distinct, "distinct")
    axes = Broadcasted(vectors.sparkSession, principal_axes(distinct, "vector", "dim"))
    # Unit vectors that reach the threshold lie this near to each other, on the first axis too.
    reach = float(np.sqrt(max(2 - 2 * threshold, 0.0))) + 1e-6

    def first_axis(batch):
        dims = batch.column(batch.schema.get_field_index("dim")).to_numpy()
        column = batch.column(batch.schema.get_field_index("vector"))
        out = np.zeros(len(dims), np.int32)
        for d in np.unique(dims).tolist():
            at = dims == d
            x = unit(matrix(column.filter(pa.array(at)))) @ axes.value[d][:, 0]
            out[at] = np.floor(x / reach)
        yield {"class": out}

    nodes = staged(
        map_batches(
            distinct.select("_vid", "group", "dim", "vector"),
            first_axis,
            "class int",
            ["_vid", "group"],
        ).withColumn("one", F.lit(1)),
        "classes",
    )
    met = meetings(nodes, "_vid", "group", "one", BLOCK_ROWS, BLOCK_ROWS)
    blocks = (
        distinct.select("_vid", "vector", "copies")
        .join(met, "_vid")
        .select("_vid", "vector", "copies", F.explode("meetings").alias("m"))
        .select("_vid", "vector", "copies", "m.key", "m.side", "m.inner")
    )
    found = staged(
        map_groups(
            blocks, "key", lambda t: _compare(t, axes.value, threshold), "a long, b long, n long"
        ),
        "links",
    )
    counts = found.groupBy(F.col("a").alias("_vid")).agg(F.sum("n").alias("n"))
    linked = staged(components(found.select("a", "b")), "linked")
    rooted = (
        distinct.select("_vid", "copies", "least")
        .join(linked.toDF("_vid", "root"), "_vid", "left")
        .join(counts, "_vid", "left")
        .withColumn("root", F.coalesce("root", "_vid"))
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    by_vector = rooted.join(least, "root").select(
        "_vid", "component", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n")
    )
    own = ("n_links", "component_id", "kept")
    joined = rows.drop("vector").join(by_vector, "_vid", "left")
    component = F.when(F.col("_vid").isNull(), F.col("_c0")).otherwise(F.col("component"))
    return joined.select(
        *[F.col(h).alias(c) for h, c in zip(held, carry, strict=True) if c not in own],
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("_c0").eqNullSafe(component).alias("kept"),
    )
