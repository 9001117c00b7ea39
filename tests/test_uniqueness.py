"""First-of-value marking: against a plain window, over paths, partitions and skew."""

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from plumbline.operators import uniqueness
from plumbline.operators.uniqueness import grouping_key, mark_first
from plumbline.sources.staging import with_position


def skewed(spark, n=6000):
    """A third NULL, a sixth one value, the rest pairs and singles."""
    return spark.range(n).select(
        F.col("id").alias("k"),
        F.expr("CASE WHEN id % 3 = 0 THEN NULL WHEN id % 6 = 1 THEN 'hot' WHEN id % 6 = 2 THEN 'p' || (id DIV 12) "
               "ELSE 's' || id END").alias("v"),
        F.expr("id % 7").alias("w"),
    )


def by_window(df, field, order):
    w = Window.partitionBy(field).orderBy(*order)
    return {r.k for r in df.withColumn("n", F.row_number().over(w)).where("n = 1").collect()}


PATHS = [{}, {"max_broadcast_keys": 0}, {"max_broadcast_keys": 0, "hot_rows": 500}, {"max_broadcast_keys": 3}]


@pytest.mark.parametrize("options", PATHS, ids=["look-up", "listed", "listed-with-hot", "mixed"])
@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_same_as_window(spark, options, partitions):
    df = skewed(spark).repartition(partitions)
    marked, flags = mark_first(df, ["v", "w", "k"], ["k"], **options)
    rows = marked.select("k", *[flags[f].alias(f"f_{f}") for f in ("v", "w", "k")]).collect()
    assert len(rows) == 6000
    for f in ("v", "w", "k"):
        assert {r.k for r in rows if r[f"f_{f}"]} == by_window(df, f, ["k"]), f


@pytest.mark.parametrize("partitions", [1, 7])
@pytest.mark.parametrize("options", PATHS[:3], ids=["look-up", "window", "listed-with-hot"])
def test_one_field(spark, options, partitions):
    df = skewed(spark).repartition(partitions)
    marked, flags = mark_first(df, ["v"], ["k"], **options)
    assert {r.k for r in marked.where(flags["v"]).collect()} == by_window(df, "v", ["k"])


@pytest.mark.parametrize("options", [{}, {"max_broadcast_keys": 0}, {"max_broadcast_keys": 0, "hot_rows": 50}],
                         ids=["look-up", "listed", "listed-with-hot"])
def test_identical_rows_still_give_one_first(spark, options):
    """Rows equal in every column: no order tells them apart, their position does."""
    df = spark.range(900).select(F.expr("id % 10").alias("a"), F.lit("same").alias("b"))
    marked, flags = mark_first(df, ["a", "b"], ["a"], **options)
    row = marked.agg(F.count(F.lit(1)), F.count_if(flags["a"]), F.count_if(flags["b"])).first()
    assert tuple(row) == (900, 10, 1)


def test_declared_order_that_is_no_key(spark, sf_dir):
    """(l_orderkey, l_linenumber) repeats; every value still has exactly one first row."""
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber")
    marked, flags = mark_first(df, ["l_orderkey"], ["l_linenumber"])
    firsts = marked.agg(F.count_if(flags["l_orderkey"])).first()[0]
    assert firsts == df.select("l_orderkey").distinct().count()


def test_clean_field_costs_no_join(spark, sf_dir):
    df = with_position(spark.read.parquet(f"{sf_dir}/orders.parquet"))
    marked, flags = mark_first(df, ["o_orderkey"], ["o_orderkey"])
    plan = marked.select(flags["o_orderkey"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_wide_rows_are_not_shuffled(spark, sf_dir):
    """Repeated values are looked up by broadcast; no window, no sort of the entity."""
    df = with_position(spark.read.parquet(f"{sf_dir}/customer.parquet"))
    marked, flags = mark_first(df, ["c_mktsegment", "c_nationkey"], ["c_custkey"])
    plan = marked.select("*", flags["c_mktsegment"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SortMergeJoin" not in plan
    assert plan.count("BroadcastHashJoin") >= 2


def test_hot_values_never_reach_a_window(spark):
    """The NULL third of the table is resolved by broadcast, not ranked in one task."""
    df = skewed(spark)
    marked, flags = mark_first(df, ["v"], ["k"], max_broadcast_keys=0, hot_rows=500)
    plan = marked.select(flags["v"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftAnti" in plan
    window_input = plan[plan.index("Window"):]
    assert "Join LeftAnti" in window_input


def test_one_wide_shuffle_for_all_fields(spark, sf_dir):
    df = with_position(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))
    marked, flags = mark_first(df, ["l_orderkey", "l_partkey", "l_suppkey"], ["l_linenumber"], max_broadcast_keys=0)
    out = marked.select("l_comment" if "l_comment" in df.columns else "l_shipdate", *flags.values())
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 1


@pytest.mark.parametrize("kind", ["string", "binary"])
def test_long_texts_are_grouped_by_digest(spark, kind):
    rows = [(0, "x" * 5000), (1, "x" * 5000), (2, "x" * 4999 + "y"), (3, "x" * 64), (4, "x" * 64), (5, None), (6, None)]
    df = spark.createDataFrame(rows, "k int, v string").withColumn("v", F.col("v").cast(kind))
    widths = [r[0] for r in df.select(F.octet_length(grouping_key(df, "v"))).collect()]
    assert max(w for w in widths if w is not None) == 65
    marked, flags = mark_first(df, ["v"], ["k"])
    assert sorted(r.k for r in marked.where(flags["v"]).collect()) == [0, 2, 3, 5]


def test_empty_table(spark):
    df = spark.createDataFrame([], "k int, v string")
    marked, flags = mark_first(df, ["v"], ["k"])
    assert marked.where(flags["v"]).count() == 0


def test_float_values_group_as_equal(spark):
    df = spark.createDataFrame([(0, 0.0), (1, -0.0), (2, float("nan")), (3, float("nan"))], "k int, v double")
    for options in PATHS[:2]:
        marked, flags = mark_first(df, ["v"], ["k"], **options)
        assert sorted(r.k for r in marked.where(flags["v"]).collect()) == [0, 2]


def test_text_as_declared_order_is_not_broadcast(spark):
    """A text that is a key identifies rows by a digest of fixed width; nothing is copied to give them a position."""
    df = spark.createDataFrame([("x" * 500, 1), ("y" * 500, 1), ("z" * 500, 2)], "t string, v int")
    marked, flags = mark_first(df, ["v"], ["t"])
    assert "_dq_id_a" in marked.columns and "_dq_row" not in marked.columns
    assert sorted(r.t[0] for r in marked.where(flags["v"]).collect()) == ["x", "z"]


def test_nested_columns_are_refused(spark):
    with pytest.raises(ValueError, match="atomic"):
        mark_first(spark.createDataFrame([([1],)], "v array<int>"), ["v"])


def test_layout_does_not_decide(spark, tmp_path):
    """No declared order: one file or seven, the same rows come first."""
    rows = spark.range(2000).select(F.expr("id % 400").alias("v"), F.expr("id % 3").alias("status"), F.col("id").alias("x"))
    firsts = []
    for files in (1, 7):
        path = str(tmp_path / f"files{files}")
        rows.orderBy(F.rand(files)).repartition(files).write.parquet(path)
        marked, flags = mark_first(with_position(spark.read.parquet(path)), ["v"])
        firsts.append(sorted(r.x for r in marked.where(flags["v"]).collect()))
    assert firsts[0] == firsts[1] and len(firsts[0]) == 400


def test_more_crowded_fields_than_a_word_has_bits(spark):
    names = [f"c{i}" for i in range(64)]
    df = spark.range(60).select("id", *[F.expr(f"(id + {i}) % {3 + i % 5}").alias(n) for i, n in enumerate(names)])
    marked, flags = mark_first(df, names, ["id"], max_broadcast_keys=0)
    got = marked.agg(*[F.count_if(flags[n]).alias(n) for n in names]).first()
    assert list(got) == [3 + i % 5 for i in range(64)]
    assert {r.id for r in marked.where(flags["c63"]).collect()} == by_window(df.withColumn("k", F.col("id")), "c63", ["id"])


def scans(frame):
    """Columns that each scan of the plan reads from files; a row's index in its file is counted, not read."""
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return [set(re.findall(r"(\w+):", line.split("ReadSchema: struct<")[1])) - {"_tmp_metadata_row_index"} for line in plan.splitlines() if "ReadSchema: struct<" in line]


def test_all_fields_are_counted_in_one_scan(spark, sf_dir, monkeypatch):
    frames = []
    original = uniqueness.materialise

    def seen(df, **kwargs):
        frames.append(df)
        return original(df, **kwargs)

    monkeypatch.setattr(uniqueness, "materialise", seen)
    df = with_position(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))
    mark_first(df, ["l_suppkey", "l_partkey", "l_returnflag"], ["l_orderkey", "l_linenumber", "l_shipdate"])
    counts = [f for f in frames if "_dq_set" in f.columns]
    assert len(counts) == 1 and scans(counts[0]) == [{"l_suppkey", "l_partkey", "l_returnflag"}]


def test_a_declared_order_reads_no_other_column(spark, sf_dir):
    """Looking for first rows reads the value and the declared columns; other columns only where these tie."""
    df = with_position(spark.read.parquet(f"{sf_dir}/customer.parquet"))
    marked, flags = mark_first(df, ["c_nationkey"], ["c_custkey"])
    run = marked.select(flags["c_nationkey"])
    run.collect()
    plan = run._jdf.queryExecution().executedPlan().toString()
    final = plan[plan.index("== Final Plan =="):plan.index("== Initial Plan ==")]
    read = [set(re.findall(r"(\w+):", line.split("ReadSchema: struct<")[1])) - {"_tmp_metadata_row_index"} for line in final.splitlines() if "ReadSchema: struct<" in line]
    assert sorted(map(sorted, read)) in ([["c_custkey", "c_nationkey"], ["c_nationkey"]], [["c_custkey", "c_nationkey"]] * 2 + [["c_nationkey"]])


@pytest.mark.parametrize("order", [["o"], ["o", "p"], []])
def test_ties_follow_the_rows_values(spark, tmp_path, order):
    """Of rows that tie in the declared order the same one comes first whatever the layout; equal rows give one."""
    rows = spark.range(3000).select(F.expr("id % 50").alias("v"), F.expr("id % 3").alias("o"), F.expr("id % 2").alias("p"), F.expr("id % 700").alias("x"))
    marks = []
    for files in (1, 5):
        path = str(tmp_path / f"f{files}")
        rows.orderBy(F.rand(files)).repartition(files).write.parquet(path)
        marked, flags = mark_first(with_position(spark.read.parquet(path)), ["v", "x"], order)
        marks.append([sorted(tuple(r) for r in marked.where(flags[f]).select("v", "o", "p", "x").collect()) for f in ("v", "x")])
    assert marks[0] == marks[1] and [len(m) for m in marks[0]] == [50, 700]
    if order:
        best = {r.v: r.o for r in rows.groupBy("v").agg(F.min("o").alias("o")).collect()}
        assert all(o == best[v] for v, o, _, _ in marks[0][0])


def test_late_rows_per_group_match_marked_rows(spark):
    df = skewed(spark).withColumn("g", F.expr("id % 4") if "id" in skewed(spark).columns else F.expr("k % 4")).repartition(5)
    df = df.withColumn("in", F.expr("k % 5 <> 0"))
    marked, flags = mark_first(df, ["v", "w"], ["k"])
    late = uniqueness.late_rows_per_group(df, ["v", "w"], ["k"], F.col("in"), ["g"])
    for f in ("v", "w"):
        want = {r.g: r.n for r in marked.where("in").where(~flags[f]).groupBy("g").agg(F.count(F.lit(1)).alias("n")).collect()}
        assert {r.g: r._dq_count for r in late[f].collect() if r._dq_count} == want


def test_rows_without_a_position_are_not_copied(spark, monkeypatch):
    """Rows that differ are known by their values; of rows that do not, just these get a position."""
    copied = []
    original = uniqueness.stage_with_position
    monkeypatch.setattr(uniqueness, "stage_with_position", lambda df: copied.append(df.count()) or original(df))
    df = skewed(spark, 900).repartition(4)
    marked, flags = mark_first(df, ["v"], ["w"])
    assert not copied and "_dq_row" not in marked.columns
    first = sorted((str(r.v), r.w, r.k) for r in marked.where(flags["v"]).collect())
    assert len(first) == df.select("v").distinct().count()
    best = {r.v: r.w for r in df.groupBy("v").agg(F.min("w").alias("w")).collect()}
    assert all(w == best[None if v == "None" else v] for v, w, _ in first)

    more = df.unionByName(df.where("k < 5")).unionByName(df.where("k < 3"))
    for options in PATHS:
        copied.clear()
        marked, flags = mark_first(more, ["v", "k"], ["w"], **options)
        assert copied == [13] and marked.count() == 908
        assert sorted((str(r.v), r.w, r.k) for r in marked.where(flags["v"]).collect()) == first
        assert sorted(r.k for r in marked.where(flags["k"]).collect()) == list(range(900))


def test_maps_do_not_tell_rows_apart_but_are_kept(spark):
    df = spark.createDataFrame([(1, {"a": 1}), (1, {"a": 2}), (2, {"a": 3})], "v int, m map<string,int>")
    marked, flags = mark_first(df, ["v"])
    assert marked.count() == 3 and marked.where(flags["v"]).count() == 2
    assert sorted(r.m["a"] for r in marked.collect()) == [1, 2, 3]


def test_rows_per_task_of_the_wide_join_do_not_grow(spark, sf_dir, monkeypatch):
    """Both sides are dealt once, to tasks of a bounded number of rows, whatever Spark's own number of partitions is."""
    monkeypatch.setattr(uniqueness, "ROWS_PER_TASK", 2000)
    df = with_position(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))
    n = df.count()
    marked, flags = mark_first(df, ["l_orderkey"], ["l_linenumber"], max_broadcast_keys=0, hot_rows=8)
    plan = marked._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"hashpartitioning\(_dq_file_a#\d+L, _dq_file_b#\d+L, _dq_row#\d+L, (\d+)\)", plan)
    assert dealt and set(dealt) == {str(-(-n // 2000))} and "coalesce(_dq_file_a" not in plan
    firsts = marked.groupBy("l_orderkey").agg(
        F.count_if(flags["l_orderkey"]).alias("n"), F.min("l_linenumber").alias("least"),
        F.min(F.when(flags["l_orderkey"], F.col("l_linenumber"))).alias("first"),
    )
    assert firsts.where("n <> 1 or first <> least").count() == 0
    most = marked.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert most <= 2 * 2000


def test_identity_that_may_be_null_joins_null_safe(spark, monkeypatch):
    monkeypatch.setattr(uniqueness, "ROWS_PER_TASK", 100)
    df = spark.createDataFrame([(None if i == 0 else i, i % 40) for i in range(2000)], "k int, v int")
    marked, flags = mark_first(df, ["v"], ["k"], max_broadcast_keys=0, hot_rows=8)
    firsts = {r.k for r in marked.where(flags["v"]).collect()}
    assert firsts == {None, *range(1, 40)}
