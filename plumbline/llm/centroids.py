"""Exact integer k-means; a vantage-point tree over the centroids finds each vector's nearest one."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import table, without
from plumbline.sources.staging import materialise, scratch_path

CLUSTERS, ROUNDS, SEED, DIMENSIONS = 8, 10, 3, 64
SCALE = 1024
#: Components below this (as integers) are computed in 64 bits: 64 squared differences stay below 2^63.
NARROW = 1 << 27
#: Vectors with a component beyond this have no exact integer in 64 bits.
WIDEST = 2.0**52
LEAF = 2  # centroids of a leaf
#: Vectors of one step in Python.
STEP = 4096
_LONGEST = (1 << 63) - 1


def squared(a: list[int], b: list[int]) -> int:
    return sum((x - y) ** 2 for x, y in zip(a, b))


def vantage_tree(points: list[list[int]], leaf: int = LEAF) -> list[tuple]:
    """Nodes over numbered points, the root first. A leaf is (points, None); an inner node is (vantage point, sides),
    each side (node, least and greatest distance of its points to the vantage point): those within the median distance
    and those beyond."""
    nodes: list[tuple] = []

    def grow(members: list[int]) -> int:
        at = len(nodes)
        nodes.append(())
        if len(members) <= leaf:
            nodes[at] = (members, None)
            return at
        vantage = members[0]
        by_distance = sorted((squared(points[vantage], points[i]), i) for i in members[1:])
        half = (len(by_distance) + 1) // 2
        nodes[at] = (vantage, tuple(
            (grow([i for _, i in side]), math.sqrt(side[0][0]), math.sqrt(side[-1][0])) for side in (by_distance[:half], by_distance[half:])
        ))
        return at

    if points:
        grow(list(range(len(points))))
    return nodes


def nearest_points(vectors: np.ndarray, centres: list[list[int]], nodes: list[tuple]) -> tuple[np.ndarray, np.ndarray, int]:
    """Per vector the nearest point (the smallest number of equally near ones) and the squared distance; and how many
    distances were computed. ``vectors`` are integers, of 64 bits (small enough) or Python's.

    Best first: each vector opens the node with the least bound on its distance next, until that bound is beyond the
    best distance. A node whose bound equals the best is opened: it may hold an equal distance with a smaller number.
    Bounds are floating-point and lowered by more than their error; the distances that decide are integers.
    """
    n, computed = len(vectors), 0
    kind = vectors.dtype
    points = np.array(centres, dtype=kind)
    best, label = np.full(n, -1, kind), np.full(n, -1, np.int64)
    bounds = np.full((n, len(nodes)), np.inf)
    if n and nodes:
        bounds[:, 0] = 0.0
    reach = np.full(n, np.inf)  # root of the best distance

    def try_point(rows: np.ndarray, point: int) -> np.ndarray:
        nonlocal computed
        apart = vectors[rows] - points[point]
        distance = (apart * apart).sum(axis=1)
        computed += len(rows)
        closer = (label[rows] < 0) | (distance < best[rows]) | ((distance == best[rows]) & (point < label[rows]))
        best[rows[closer]], label[rows[closer]] = distance[closer], point
        root = np.sqrt(distance.astype(np.float64))
        reach[rows[closer]] = root[closer]
        return root

    open_rows = np.arange(n) if nodes else np.zeros(0, np.int64)
    while len(open_rows):
        node = bounds[open_rows].argmin(axis=1)
        open_rows = open_rows[bounds[open_rows, node] <= reach[open_rows]]
        node = bounds[open_rows].argmin(axis=1) if len(open_rows) else node[:0]
        for at in np.unique(node).tolist():
            rows = open_rows[node == at]
            own = bounds[rows, at]
            bounds[rows, at] = np.inf
            held, sides = nodes[at]
            if sides is None:
                for point in held:
                    try_point(rows, point)
                continue
            root = try_point(rows, held)
            for child, least, greatest in sides:
                bound = np.maximum(np.maximum(root - greatest, least - root), own)
                bounds[rows, child] = np.maximum(bound - 1e-9 * (root + greatest + 1.0), 0.0)
        open_rows = open_rows[np.isfinite(bounds[open_rows].min(axis=1))] if len(open_rows) else open_rows
    return label, best, computed


def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """Slices of a batch: where each begins, and its integers."""
    lists = batch.column("components")
    if not len(lists):
        return
    values = lists.flatten().to_numpy().reshape(len(lists), -1)
    for low in range(0, len(values), STEP):
        part = values[low : low + STEP]
        yield low, part if np.abs(part).max() < NARROW else part.astype(object)


def _small(points: list[list[int]]) -> bool:
    return all(abs(c) < NARROW for point in points for c in point)


def assigned(kept: DataFrame, points: list[list[int]]) -> DataFrame:
    """``vec_id``, ``cluster`` and ``distance`` of every kept vector; a distance beyond a long is null."""
    context = kept.sparkSession.sparkContext
    tree = context.broadcast((points, vantage_tree(points)))
    small = _small(points)

    def run(batches):
        for batch in batches:
            labels, distances = [], []
            for _, vectors in _vectors(batch):
                label, best, _ = nearest_points(vectors if small else vectors.astype(object), *tree.value)
                labels += label.tolist()
                distances += [d if d <= _LONGEST else None for d in best.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(labels, pa.int32()), pa.array(distances, pa.int64())], names=["vec_id", "cluster", "distance"]
            )

    return kept.mapInArrow(run, "vec_id bigint, cluster int, distance bigint")


def cluster_sums(kept: DataFrame, points: list[list[int]]) -> dict[int, tuple[int, list[int]]]:
    """Per non-empty cluster the number of its vectors and the exact sums of their components.

    A task sends a row per cluster and component; Spark adds them up in decimals of 38 digits.
    """
    context = kept.sparkSession.sparkContext
    tree = context.broadcast((points, vantage_tree(points)))
    small, width = _small(points), len(points[0])

    def run(batches):
        totals: dict[int, list] = {}
        for batch in batches:
            for _, vectors in _vectors(batch):
                label, _, _ = nearest_points(vectors if small else vectors.astype(object), *tree.value)
                for cluster in np.unique(label).tolist():
                    own = vectors[label == cluster]
                    held = totals.setdefault(cluster, [0, [0] * width])
                    held[0] += len(own)
                    held[1] = [a + b for a, b in zip(held[1], own.sum(axis=0).tolist())]
        rows = [(c, i, n, Decimal(total)) for c, (n, sums) in totals.items() for i, total in enumerate(sums)]
        columns = list(zip(*rows)) or [[], [], [], []]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38, 0)]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["cluster", "place", "n", "total"])

    parts = kept.mapInArrow(run, "cluster int, place int, n bigint, total decimal(38,0)")
    rows = parts.groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    sums: dict[int, tuple[int, list[int]]] = {}
    for r in rows:  # clusters x components
        sums.setdefault(r["cluster"], (r["n"], [0] * width))[1][r["place"]] = int(r["total"])
    tree.unpersist()
    return sums


def kept_vectors(embeddings: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """``vec_id`` and ``components``, the integers floor(1024 x), of vectors with exactly so many finite components."""
    values = F.col("embedding").cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < WIDEST))
    whole = embeddings.select("vec_id", values.alias("embedding")).where((F.size(values) == dimensions) & finite)
    rows = whole.select("vec_id", F.transform("embedding", lambda x: F.floor(x * SCALE).cast("bigint")).alias("components"))
    path = scratch_path(embeddings.sparkSession, "vectors")
    rows.write.parquet(path)
    return embeddings.sparkSession.read.schema(rows.schema).parquet(path)


def first_centroids(kept: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> list[list[int]]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    drawn = kept.where("vec_id is not null").select(digest.alias("h"), "components").orderBy("h", "components").limit(clusters)
    return [list(r["components"]) for r in sorted(drawn.collect(), key=lambda r: (r["h"], r["components"]))]


def cluster_vectors(embeddings: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, dimensions: int = DIMENSIONS) -> DataFrame:
    """One row per kept vector: ``vec_id``, ``cluster``, ``distance`` (squared, to its centroid), ``cluster_inertia``,
    ``inertia`` and ``centroid_sha256``.

    Vectors become integers, written once as narrow rows. Each round builds a vantage-point tree over the centroids
    (clusters x components: bounded by the parameters), broadcasts it, assigns every vector to the nearest centroid
    (ties: the smaller number) and adds up counts and components per task and cluster: a round moves a few rows per
    task. A non-empty centroid becomes the floor of its vectors' mean, exactly; an empty one stays.

    Null vectors, ones of another length and ones with null or non-finite parts are left out, and so are ones with a
    component of 2^52 or more, which has no such integer in 64 bits. From 2^17 on, arithmetic is Python's, and a
    distance (or a sum of distances) that no long holds is null. Null ids are assigned, but never a first centroid.
    Repeated rows count each; among rows of one id the smaller components come first. With fewer vectors than clusters
    there are fewer centroids; without vectors there are no rows. Other columns are left out.
    """
    kept = kept_vectors(without(embeddings, ["components", "cluster", "distance"]), dimensions)
    points = first_centroids(kept, clusters, seed)
    result = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    if not points:
        return kept.sparkSession.createDataFrame([], result)
    for _ in range(rounds):
        for cluster, (n, sums) in cluster_sums(kept, points).items():
            points[cluster] = [total // n for total in sums]
    rows, _ = materialise(assigned(kept, points))
    wide = F.sum(F.col("distance").cast("decimal(38,0)"))
    inertia = {r[0]: r[1] for r in rows.groupBy("cluster").agg(F.when(F.count_if(F.col("distance").isNull()) == 0, wide)).collect()}
    total = None if None in inertia.values() else sum(inertia.values())

    def long(value):
        return F.lit(None if value is None or value > _LONGEST else int(value)).cast("bigint")

    final = [
        (c, None if v is None or v > _LONGEST else int(v), hashlib.sha256(",".join(map(str, points[c])).encode()).hexdigest())
        for c, v in sorted(inertia.items())
    ]
    of_cluster = kept.sparkSession.createDataFrame(final, "cluster int, cluster_inertia bigint, centroid_sha256 string")
    # a row per cluster
    return rows.join(F.broadcast(of_cluster), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", long(total).alias("inertia"), "centroid_sha256"
    )


def op13_vantage_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """The rounds unrolled: assignments by all distances, means by whole division that rounds down."""
    steps = [f"""
v as materialized (
  select vec_id, list_transform(embedding::double[], lambda x: floor({SCALE} * x)::bigint) as c from embeddings
  where len(embedding) = {DIMENSIONS} and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))),
m0 as materialized (
  select (row_number() over (order by sha256('{SEED}:' || vec_id)) - 1)::int as k, c from v
  qualify row_number() over (order by sha256('{SEED}:' || vec_id)) <= {CLUSTERS})"""]
    near = """
a{i} as materialized (
  select vec_id, c, k, d from (
    select v.vec_id, v.c, m.k, list_sum(list_transform(list_zip(v.c, m.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d
    from v, m{i} m) qualify row_number() over (partition by vec_id order by d, k) = 1)"""
    mean = """
s{i} as (select k, i, sum(x)::hugeint as s, count(*) as n from (select k, unnest(c) as x, unnest(range(1, 65)) as i from a{i}) group by 1, 2),
m{j} as materialized (
  select m.k, coalesce(t.c, m.c) as c from m{i} m
  left join (select k, list((s // n - case when s < 0 and s % n <> 0 then 1 else 0 end)::bigint order by i) as c from s{i} group by 1) t using (k))"""
    for i in range(ROUNDS):
        steps += [near.format(i=i), mean.format(i=i, j=i + 1)]
    steps.append(near.format(i=ROUNDS))
    return f"""with {",".join(steps)}
select a.vec_id, a.k as cluster, a.d as distance, (sum(a.d) over (partition by a.k))::bigint as cluster_inertia,
  (sum(a.d) over ())::bigint as inertia, sha256(array_to_string(m.c, ',')) as centroid_sha256
from a{ROUNDS} a join m{ROUNDS} m using (k)"""


OP13_SQL = _sql()
