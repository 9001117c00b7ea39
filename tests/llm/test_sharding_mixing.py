import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import mixing, sharding

DOCS = "doc_id bigint, text string, source string, shard int, TAKEN string"


def rows_of(spark, n, third=True):
    out = [(i, "one two three " * (i % 7), "hot" if third and i % 3 == 0 else f"s{i % 5}", 9, "x") for i in range(n)]
    out += [(None, None, None, None, None), (None, "", "s1", 1, "y"), (5, "a b", "s0", 1, "z"), (5, "a b", "s0", 1, "z")]
    return spark.createDataFrame(out, DOCS)


def test_matrix_has_exact_sums_and_spreads():
    blocks, shards = [100, 0, 57, 243], [100] * 4
    matrix = sharding.communication_matrix(blocks, shards, 3)
    assert [sum(r) for r in matrix] == blocks and [sum(c) for c in zip(*matrix)] == shards
    assert min(min(r) for r in (matrix[0], matrix[3])) > 5


def test_large_populations_follow_the_law():
    rng = np.random.default_rng(1)
    good, bad, drawn = 10**9, 3 * 10**9, 10**6
    values = [sharding.hypergeometric(rng, good, bad, drawn) for _ in range(300)]
    spread = math.sqrt(drawn * 0.25 * 0.75)
    assert abs(np.mean(values) - drawn / 4) < 5 * spread / math.sqrt(300)
    assert 0.85 < np.std(values) / spread < 1.15
    assert sharding.hypergeometric(rng, good, 2 * 10**9, good + 2 * 10**9) == good


@pytest.mark.parametrize("n", [0, 5, 400])
def test_shards_are_even_and_slots_gapless(spark, n):
    df = rows_of(spark, n) if n else spark.createDataFrame([], DOCS)
    got = sharding.shuffle_into_shards(df, [F.col("doc_id")], n_shards=6, rows_per_block=7, least_blocks=4).toPandas()
    total = n + 4 if n else 0
    assert len(got) == total and list(got.columns)[-2:] == ["shard", "slot"]
    sizes = [len(g) for _, g in got.groupby("shard")]
    assert not total or (max(sizes) - min(sizes) <= 1 and all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard")))


def test_shuffle_is_uniform_enough_and_repeatable(spark):
    df = spark.range(3000).withColumnRenamed("id", "doc_id")
    first, second = (sharding.shuffle_into_shards(df, [F.col("doc_id")], 5).toPandas().sort_values("doc_id") for _ in range(2))
    assert first.values.tolist() == second.values.tolist()
    assert abs(np.corrcoef(first.doc_id, first.slot)[0, 1]) < 0.08
    assert abs(np.corrcoef(first.doc_id, first.shard)[0, 1]) < 0.08


def expected_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total >= 2 * sizes[s]}
        if not full:
            return target | {s: left * weight[s] / total for s in open_}
        target |= {s: 2.0 * sizes[s] for s in full}
        left, open_ = left - sum(2 * sizes[s] for s in full), open_ - full
    return target


@pytest.mark.parametrize("n", [0, 4, 300])
def test_mix_meets_targets(spark, n):
    df = rows_of(spark, n).withColumn("size", mixing.count_words(F.col("text"))).withColumn("q", (F.col("doc_id") % 3).cast("double"))
    got = mixing.mix(df, F.col("size"), F.col("q"), [F.col("doc_id")]).collect()
    assert len(got) == n + 4
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
    target = expected_targets(sizes)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - target[r["source"]]) < 1e-6
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in sizes)


def test_quality_is_drawn_first_and_reruns_agree(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit(3).alias("size"), (F.when(F.col("id") % 2 == 0, 1.0).otherwise(0.1)).alias("q"))
    df = df.unionByName(spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("t").alias("source"), F.lit(3).alias("size"), F.lit(1.0).alias("q")))
    runs = [mixing.mix(df, F.col("size"), F.col("q"), [F.col("doc_id")]).orderBy("source", "doc_id").toPandas() for _ in range(2)]
    assert runs[0].values.tolist() == runs[1].values.tolist()
    t = runs[0][runs[0].source == "s"]
    share = t.groupby(t.doc_id % 2).taken.sum()
    assert share[0] > share[1] or t.taken.min() == 6


def test_empty_mix(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string, source string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert mixing.mix_documents(df, labels).count() == 0


def taken_brute(rows, targets):
    """Rows of a source in the order of their keys, filled one after the other."""
    out = []
    for source in {r["source"] for r in rows}:
        own = sorted((r for r in rows if r["source"] == source), key=lambda r: (r["k"], r["size"], r["doc_id"] is not None, r["doc_id"] or 0))
        size = sum(r["size"] for r in own)
        epochs, rest = divmod(round(targets[source]), max(size, 1))
        for r in own:
            part = max(0, min(r["size"], rest))
            rest -= part
            out.append((source, r["doc_id"], r["size"], epochs * r["size"] + part))
    return sorted(out, key=repr)


@pytest.mark.parametrize("border_rows", [2, 40, 10**6])
@pytest.mark.parametrize("kind", ["different", "equal", "both"])
def test_borders_are_exact_whatever_repeats(spark, border_rows, kind):
    """A third of all rows may be one row: equal rows at a border are numbered, not sorted."""
    rows = [(i, 3 + i % 5, f"s{i % 3}") for i in range(600)] if kind != "equal" else []
    rows += [(7, 11, "s1")] * 500 + [(None, 4, "s2")] * 90 + [(None, 5, None)] * 60 if kind != "different" else []
    df = spark.createDataFrame(rows, "doc_id bigint, size bigint, source string").repartition(7)
    got = mixing.mix(df, F.col("size"), F.lit(1.0), [F.col("doc_id")], border_rows=border_rows).collect()
    keys = df.select("*", mixing.exponential_key(29, [F.col("doc_id")], F.lit(1.0)).alias("k")).collect()
    targets = {r["source"]: r["target"] for r in got}
    assert sorted(((r["source"], r["doc_id"], r["size"], r["taken"]) for r in got), key=repr) == taken_brute(keys, targets)
    assert targets == pytest.approx(expected_targets({s: sum(r["size"] for r in got if r["source"] == s) for s in targets}))


def test_a_hot_identity_is_split_over_blocks(spark):
    rows = [(5, i) for i in range(300)] + [(i, 0) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, n int").repartition(6)
    options = {"n_shards": 6, "rows_per_block": 20, "least_blocks": 4}
    frame = sharding.shuffle_into_shards(df, [F.col("doc_id")], **options)
    got = frame.toPandas()
    assert sorted(zip(got.doc_id, got.n)) == sorted(rows)
    assert got.groupby("shard").size().tolist() == [100] * 6
    assert all(sorted(g.slot) == list(range(100)) for _, g in got.groupby("shard"))
    hot = got[got.doc_id == 5]
    assert hot.groupby("shard").size().max() < 90 and got.sort_values(["doc_id", "n"]).values.tolist() == frame.toPandas().sort_values(["doc_id", "n"]).values.tolist()
    plan = frame._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def shard_counts(spark, seeds):
    df = spark.range(60).withColumnRenamed("id", "doc_id")
    for seed in seeds:
        rows = sharding.shuffle_into_shards(df, [F.col("doc_id")], 4, seed=seed, rows_per_block=9, least_blocks=5).collect()
        yield {r.doc_id: (r.shard, r.slot) for r in rows}


def test_every_row_goes_to_every_place_alike(spark):
    """The uniform law: over many seeds a row meets each shard, and each half of it, about as often."""
    seen = np.zeros((60, 4)), np.zeros((60, 2))
    draws = list(shard_counts(spark, range(24)))
    for draw in draws:
        for row, (shard, slot) in draw.items():
            seen[0][row, shard] += 1
            seen[1][row, slot * 2 // 15] += 1
    for counts in seen:
        expected = counts.sum() / counts.size
        spread = ((counts - expected) ** 2 / expected).sum()
        free = counts.size - len(counts)
        assert abs(spread - free) < 4 * math.sqrt(2 * free)
