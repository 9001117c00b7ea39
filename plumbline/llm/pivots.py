"""Near-duplicate vectors through a pivot-permutation index."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import per_batch, table, to_arrow_schema, whole_groups
from plumbline.llm.components import connected_components
from plumbline.sources.staging import materialise

LEAST_COSINE = 0.9
#: Nearest reference points that describe a vector among up to ``FEW`` points, and how many of them two vectors must share.
PREFIX, SHARED, FEW = 7, 2, 160
#: Reference points per cube root of the number of vectors: lists then grow slower than the table.
PIVOTS = 16
#: Reference points are drawn from so many times their number of sampled vectors, none of them closer than this cosine,
#: so that a crowd of near copies has few of them.
DRAWN, APART = 4, 0.7
#: Members of a list that are compared with each other in one piece of work.
BLOCK = 1024
#: Pairs that share enough points are verified one by one if they are fewer than one in ``DENSE``, ``PAIRS`` at a time.
DENSE, PAIRS = 16, 1 << 16


def usable(values: list | None) -> np.ndarray | None:
    """The vector in double precision; None for null, empty or zero vectors and ones with null or non-finite parts."""
    if values is None or not len(values):
        return None
    vector = np.array([np.nan if v is None else v for v in values], np.float64)
    return vector if np.isfinite(vector).all() and vector.any() else None


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(-1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=-1, keepdims=True)


def choose_pivots(vectors: list[np.ndarray], most: int) -> dict[int, np.ndarray]:
    """By length of the vector: unit vectors, in the order given, each apart from those before."""
    chosen: dict[int, np.ndarray] = {}
    held: dict[int, int] = {}
    for vector in map(unit, vectors):
        if sum(held.values()) == most:
            break
        length, n = len(vector), held.get(len(vector), 0)
        near = chosen.setdefault(length, np.empty((16, length)))
        if n and (near[:n] @ vector).max() >= APART:
            continue
        if n == len(near):  # twice the room: each vector moves a few times at most
            near = chosen[length] = np.concatenate([near, np.empty_like(near)])
        near[n] = vector
        held[length] = n + 1
    return {length: chosen[length][:n] for length, n in held.items()}


def depth(points: int) -> int:
    """How many nearest reference points describe a vector: one more for each tenfold number of vectors (the number of
    points grows with its cube root), so that two vectors share enough of them as often at every size."""
    return PREFIX + max(0, math.ceil(3 * math.log10(max(points, 1) / FEW)))


def nearest(vectors: np.ndarray, pivots: np.ndarray | None) -> np.ndarray:
    """Numbers of the nearest reference points of each unit vector, nearest first."""
    if pivots is None:
        return np.zeros((len(vectors), 0), np.int64)
    distant, most = -(vectors @ pivots.T), depth(len(pivots))
    if most >= len(pivots):
        return np.argsort(distant, axis=1, kind="stable")
    found = np.sort(np.argpartition(distant, most, axis=1)[:, :most], axis=1)
    order = np.argsort(np.take_along_axis(distant, found, axis=1), axis=1, kind="stable")
    return np.take_along_axis(found, order, axis=1)


def linked_pairs(x: np.ndarray, near_x: np.ndarray, y: np.ndarray, near_y: np.ndarray, here: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that share enough reference points, have ``here`` as the smallest shared one, and pass the cosine."""
    shared = np.zeros((len(x), len(y)), np.int16)
    smaller = np.zeros((len(x), len(y)), bool)
    points, columns = np.unique(near_y, return_inverse=True) if near_y.size else (np.zeros(0, int), np.zeros(0, int))
    has_y = np.zeros((len(y), len(points)), bool)
    has_y[np.repeat(np.arange(len(y)), near_y.shape[1]), columns.ravel()] = True
    for k in range(near_x.shape[1]):
        at = np.searchsorted(points, near_x[:, k])
        known = (at < len(points)) & (points[np.minimum(at, len(points) - 1)] == near_x[:, k])
        hit = has_y[:, np.where(known, at, 0)].T & known[:, None]
        shared += hit
        smaller |= hit & (near_x[:, k] < here)[:, None]
    need = min(SHARED, near_x.shape[1])
    a, b = np.nonzero((shared >= need) & ~smaller)
    if len(a) * DENSE > len(x) * len(y):  # so many pairs that one product of the blocks is less work
        close = (x @ y.T)[a, b] >= least
    else:
        close = np.concatenate([
            (x[a[i : i + PAIRS]] * y[b[i : i + PAIRS]]).sum(axis=1) >= least for i in range(0, len(a), PAIRS)
        ] or [np.zeros(0, bool)])
    return a[close], b[close]


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest number that each of ``n`` numbers reaches through the pairs."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _work(batch: pa.RecordBatch, least: float) -> dict[str, list]:
    """One piece of work: two blocks of a list (or one with itself) against each other."""
    part = batch.column("part").to_numpy()
    point, i, j = (batch.column(c)[0].as_py() for c in ("point", "i", "j"))
    keys = np.array(batch.column("class").to_pylist(), object)
    weights = batch.column("n").to_numpy()
    x = unit(np.stack([np.frombuffer(v, np.float64) for v in batch.column("vector").to_pylist()]))
    near = np.stack([np.array(v, np.int64) for v in batch.column("near").to_pylist()])
    left, right = np.flatnonzero(part == i), np.flatnonzero(part == j)
    a, b = linked_pairs(x[left], near[left], x[right], near[right], point, least)
    a, b = left[a], right[b]
    if i == j:
        a, b = a[a < b], b[a < b]
    count = np.bincount(a, weights[b], len(keys)) + np.bincount(b, weights[a], len(keys))
    root = roots(len(keys), a, b)
    used = np.flatnonzero(count)
    return {"class": keys[used].tolist(), "n": count[used].astype(np.int64), "root": keys[root[used]].tolist()}


def near_vectors(embeddings: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links`` (other rows linked directly), ``component_id`` (the smallest vec_id
    reachable) and ``kept`` (it is that one). Vectors with a cosine of ``least`` or more in double precision are linked.

    Equal vectors are one class. Every class is posted to the lists of its nearest reference points; within a list,
    pairs that share ``SHARED`` of their `depth` points are verified. Lists are worked through in pairs of blocks
    of about ``BLOCK`` members; a piece of work returns a row per member, with how many it links to and one member it
    is connected to, so a crowd of near copies never becomes a row per pair. A pair counts in the list of its smallest
    shared point only. Reference points come from a sample of the classes with the smallest digests, bounded by
    ``DRAWN`` x ``PIVOTS`` x the cube root of the number of classes; vectors of a length without points are compared
    with all vectors of that length.

    Columns other than ``vec_id`` and ``embedding`` are left out. Null, empty and zero vectors, ones with null or non-finite parts, and null ids link with nothing (a null id is
    kept, with a null component). Rows that repeat an id count as vectors of their own. No rows give no rows.
    """

    def read(batch):
        out = {"vec_id": batch.column("vec_id"), "class": [], "vector": []}
        for id_, values in zip(batch.column("vec_id").to_pylist(), batch.column("embedding").to_pylist()):
            vector = usable(values) if id_ is not None else None
            data = None if vector is None else (vector + 0.0).tobytes()
            out["vector"].append(data)
            out["class"].append(None if data is None else xxhash.xxh3_128_digest(data))
        return out

    narrow = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    rows, _ = materialise(per_batch(narrow, read, "vec_id bigint, class binary, vector binary", "vec_id"))
    classes, measured = materialise(
        rows.where("class is not null").groupBy("class").agg(F.any_value("vector").alias("vector"), F.count(F.lit(1)).alias("n")),
        n=F.count(F.lit(1)),
    )
    most = max(PREFIX, round(PIVOTS * (measured["n"] or 0) ** (1 / 3)))
    drawn = classes.orderBy("class").limit(DRAWN * most).collect()
    # 16 x cube root of the number of classes: 8 MB of 64 components at a billion vectors, held once per worker
    pivots = embeddings.sparkSession.sparkContext.broadcast(choose_pivots([np.frombuffer(bytes(r["vector"]), np.float64) for r in drawn], most))
    kinds = "class binary, n bigint, vector binary, near array<int>"

    def describe(batch):
        near = [None] * batch.num_rows
        vectors = [np.frombuffer(v, np.float64) for v in batch.column("vector").to_pylist()]
        for length in {len(v) for v in vectors}:
            at = [k for k, v in enumerate(vectors) if len(v) == length]
            for k, found in zip(at, nearest(unit(np.stack([vectors[k] for k in at])), pivots.value.get(length))):
                near[k] = found.tolist()
        return {"class": batch.column("class"), "n": batch.column("n"), "vector": batch.column("vector"), "near": near}

    described, _ = materialise(per_batch(classes.select("class", "n", "vector"), describe, kinds, "vector"))
    length = F.length("vector")
    posted = described.select("*", length.alias("length"), F.explode(F.when(F.size("near") > 0, F.col("near")).otherwise(F.array(F.lit(-1)))).alias("point"))
    sizes = described.select(length.alias("length"), F.explode(F.when(F.size("near") > 0, F.col("near")).otherwise(F.array(F.lit(-1)))).alias("point"))
    sizes = sizes.groupBy("length", "point").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"), F.count(F.lit(1)).alias("m")).where("m > 1")
    work = posted.join(sizes, ["length", "point"]).withColumn("part", F.pmod(F.xxhash64("class"), F.col("parts")).cast("int"))
    work = work.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "length", "point", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "class", "n", "vector", "near"
    )
    unit_of_work = ["length", "point", "i", "j"]
    arrow = to_arrow_schema("class binary, n bigint, root binary")

    def compare(batches):
        for batch, cuts in whole_groups(batches, unit_of_work):
            for a, b in zip(cuts, cuts[1:]):
                yield pa.RecordBatch.from_pydict(_work(batch.slice(a, b - a), least), schema=arrow)

    placed = work.repartition(*unit_of_work).sortWithinPartitions(*unit_of_work)
    found, _ = materialise(placed.mapInArrow(compare, "class binary, n bigint, root binary"))
    counts = found.groupBy("class").agg(F.sum("n").alias("others"))
    labels = connected_components(found.select(F.col("class").alias("a"), F.col("root").alias("b"))).withColumnRenamed("id", "class")
    own = classes.select("class", F.col("n").alias("copies")).join(counts, "class", "left").join(labels, "class", "left")
    own = own.select("class", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "class").alias("component"))
    named = rows.join(own, "class", "left").drop("vector")
    smallest = named.where("component is not null").groupBy(F.col("component").alias("c")).agg(F.min("vec_id").alias("least_id"))
    named = named.join(smallest, F.col("component") == F.col("c"), "left")
    component = F.coalesce("least_id", "vec_id")
    return named.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def op7_pivot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


OP7_SQL = """
with recursive v as (
  select vec_id, embedding::double[] as e from embeddings
  where embedding is not null and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))
    and list_bool_or(list_transform(embedding, lambda x: x <> 0))),
l as materialized (select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and list_cosine_similarity(a.e, b.e) >= 0.9),
r(id, reach) as (select a, a from l union select r.id, l.b from r join l on l.a = r.reach),
k as (select id, min(reach) as component from r group by 1),
n as (select a as id, count(*) as n from l group by 1)
select e.vec_id, coalesce(n.n, 0)::bigint as n_links, coalesce(k.component, e.vec_id) as component_id,
  coalesce(k.component, e.vec_id) = e.vec_id as kept
from embeddings e left join k on k.id = e.vec_id left join n on n.id = e.vec_id
"""
