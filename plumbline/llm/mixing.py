"""Mixing sources to target weights: weighted sampling by exponential keys, cut at token budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import count_words, table, without
from plumbline.sources.staging import materialise

SOURCE_WEIGHTS = (3, 1, 2)
BUDGET_SHARE = 1.5
MOST_EPOCHS = 2
KEY_BUCKETS = 64
#: Different rows of a source that are sorted at once; sources up to which a row per source is broadcast.
BORDER_ROWS, FEW_SOURCES = 1_000_000, 100_000
LEAST_QUALITY = 1e-3
OUT = ["source_size", "target", "taken"]
_HEX_DIGITS = 13


def exponential_key(seed: int, parts: list[Column], quality: Column) -> Column:
    """Efraimidis-Spirakis: an exponential variable with the quality as its rate; the smallest keys are drawn first."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    number = F.conv(F.substring(digest, 1, _HEX_DIGITS), 16, 10).cast("double")
    uniform = (number + 0.5) / F.lit(float(16**_HEX_DIGITS))
    return -F.log(uniform) / quality


def source_targets(sizes: DataFrame) -> DataFrame:
    """Add ``target`` to one row per source (``source``, ``source_size``).

    Sources in code point order, null last, weigh 3, 1, 2, 3, ...; they share ``BUDGET_SHARE`` of all words, none above
    ``MOST_EPOCHS`` times its own; what is over is shared again by weight. Each round is one aggregate of the sources'
    rows; rounds end when no further source is full.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(SOURCE_WEIGHTS)
    weights = F.element_at(F.array(*[F.lit(w) for w in SOURCE_WEIGHTS]), place + 1)
    rows, _ = materialise(sizes.select("source", "source_size", weights.alias("_llm_w")))
    cap, weight = F.col("source_size") * MOST_EPOCHS, F.col("_llm_w")
    total = (rows.agg(F.sum("source_size")).first()[0] or 0) * BUDGET_SHARE
    level, seen = 0.0, -1
    while True:
        full = cap <= weight * F.lit(level)
        held, open_weight, n = rows.agg(
            F.sum(F.when(full, cap)), F.sum(F.when(~full, weight)), F.count(F.when(full, 1))
        ).first()
        if n == seen or not open_weight:
            break
        seen, level = n, (total - (held or 0)) / open_weight
    target = F.least(cap.cast("double"), weight * F.lit(level)) if open_weight else cap.cast("double")
    return rows.select("source", "source_size", target.alias("target"))


def _border_groups(inside: DataFrame, at: list[str], most: int) -> DataFrame:
    """Per source the group of equal rows in which the sampled words end: ``_llm_border`` (what orders rows), ``_llm_due``
    (words that the group gives), ``_llm_alike`` (its rows).

    ``inside`` has the rows around each source's border, what is summed before them and what is to be filled. Equal rows
    fold to a group; while a source has more than ``most`` groups, quantiles of its keys narrow them down.
    """
    place = F.struct(*at).alias("_llm_border")
    groups, _ = materialise(inside.groupBy("source", "_llm_before", "_llm_rest", *at).agg(F.count(F.lit(1)).alias("_llm_alike")))
    words = F.col("_llm_size") * F.col("_llm_alike")
    while (groups.groupBy("source").count().agg(F.max("count")).first()[0] or 0) > most:
        shares = F.array(*[F.lit(i / KEY_BUCKETS) for i in range(1, KEY_BUCKETS)])
        cuts = groups.groupBy(F.col("source").alias("_llm_in")).agg(F.percentile_approx("_llm_key", shares, F.lit(10_000)).alias("_llm_cuts"))
        ranged = groups.join(cuts, F.col("source").eqNullSafe(F.col("_llm_in"))).drop("_llm_in").withColumn(
            "_llm_bucket", F.size(F.filter("_llm_cuts", lambda c: c < F.col("_llm_key")))
        )
        sums = ranged.groupBy(F.col("source").alias("_llm_in"), F.col("_llm_bucket").alias("_llm_at")).agg(F.sum(words).alias("_llm_sum"))
        earlier = Window.partitionBy("_llm_in").orderBy("_llm_at").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("_llm_more", F.coalesce(F.sum("_llm_sum").over(earlier), F.lit(0)))
        joined = ranged.join(sums, F.col("source").eqNullSafe(F.col("_llm_in")) & (F.col("_llm_bucket") == F.col("_llm_at")))
        before = F.col("_llm_before") + F.col("_llm_more")
        kept = joined.where((before < F.col("_llm_rest")) & (F.col("_llm_rest") <= before + F.col("_llm_sum")))
        kept = kept.select("source", before.alias("_llm_before"), "_llm_rest", *at, "_llm_alike")
        n = groups.count()
        groups, seen = materialise(kept, n=F.count(F.lit(1)))
        if seen["n"] == n:  # one key, told apart by sizes and ids only
            break
    running = Window.partitionBy("source").orderBy(*at).rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("_llm_rest") - F.col("_llm_before") - F.coalesce(F.sum(words).over(running), F.lit(0))
    return groups.select("source", place, "_llm_alike", left.alias("_llm_due"), words.alias("_llm_words")).where("_llm_due > 0 and _llm_due <= _llm_words")


def mix(df: DataFrame, size: Column, quality: Column, identity: list[Column], seed: int = 29, border_rows: int = BORDER_ROWS) -> DataFrame:
    """Add ``source_size``, ``target`` and ``taken`` (words of this row that the mix takes, repeats counted).

    ``df`` has ``source``. A source's target, rounded to words, is filled by whole passes over it first; the rest comes
    from the rows with the smallest exponential keys, their sizes summed up to the rest, the row at the border in part.
    Keys fall into ``KEY_BUCKETS`` ranges by their quantiles; sums per source and range tell which range holds the
    border, and it is narrowed down until no source has more than ``border_rows`` different rows in it. Only those are
    sorted: a row per source then says where its border is. Equal rows at a border are numbered per task and offset by
    the tasks before. So neither a source nor a row with a third of the table is one task's work.

    Null quality counts as 1, others as ``LEAST_QUALITY`` at least; null sizes and sources count as 0 and a source of
    their own. Equal rows have equal keys: which of them is taken makes no difference. Existing columns named as the
    results are replaced. No rows: no rows. Reruns give the same result. Pass narrow rows: they are written once.
    """
    weight = F.greatest(F.coalesce(quality.cast("double"), F.lit(1.0)), F.lit(LEAST_QUALITY))
    names = [f"_llm_id_{i}" for i in range(len(identity))]
    rows, _ = materialise(without(df, OUT).select(
        "*", F.coalesce(size, F.lit(0)).cast("long").alias("_llm_size"), exponential_key(seed, identity, weight).alias("_llm_key"),
        *[c.alias(n) for c, n in zip(identity, names)], F.monotonically_increasing_id().alias("_llm_place"),
    ))
    at = ["_llm_key", "_llm_size", *names]
    shares = [i / KEY_BUCKETS for i in range(1, KEY_BUCKETS)]
    borders = rows.agg(F.percentile_approx("_llm_key", F.array(*map(F.lit, shares)), F.lit(10_000))).first()[0] or []
    borders = F.array(*map(F.lit, sorted(set(borders)))) if borders else F.array().cast("array<double>")
    bucket = F.size(F.filter(borders, lambda b: b < F.col("_llm_key")))

    sums, _ = materialise(rows.groupBy("source", bucket.alias("_llm_bucket")).agg(F.sum("_llm_size").alias("_llm_sum")))
    targets = source_targets(sums.groupBy("source").agg(F.sum("_llm_sum").alias("source_size")))
    whole, full = F.round("target").cast("long"), F.greatest(F.col("source_size"), F.lit(1))
    plan, planned = materialise(targets.select(
        F.col("source").alias("_llm_source"), "source_size", "target",
        F.expr("cast(round(target) as bigint) div greatest(source_size, 1)").alias("_llm_epochs"), (whole % full).alias("_llm_rest"),
    ), n=F.count(F.lit(1)))

    def of_sources(table: DataFrame) -> DataFrame:
        """One row per source: broadcast while sources are few."""
        return F.broadcast(table) if (planned["n"] or 0) <= FEW_SOURCES else table

    earlier = Window.partitionBy("source").orderBy("_llm_bucket").rowsBetween(Window.unboundedPreceding, -1)
    ranges = sums.select(
        F.col("source").alias("_llm_in"), F.col("_llm_bucket").alias("_llm_at"), "_llm_sum",
        F.coalesce(F.sum("_llm_sum").over(earlier), F.lit(0)).alias("_llm_before"),
    ).join(plan.select("_llm_source", "_llm_rest"), F.col("_llm_in").eqNullSafe(F.col("_llm_source"))).where(
        "_llm_before < _llm_rest and _llm_rest <= _llm_before + _llm_sum"
    ).drop("_llm_source", "_llm_sum")
    inside = rows.join(of_sources(ranges), F.col("source").eqNullSafe(F.col("_llm_in")) & (bucket == F.col("_llm_at")))
    border, alike = materialise(_border_groups(inside, at, border_rows), most=F.max("_llm_alike"))

    plan = plan.join(border.withColumnRenamed("source", "_llm_in"), F.col("_llm_source").eqNullSafe(F.col("_llm_in")), "left").drop("_llm_in")
    joined = rows.join(of_sources(plan), F.col("source").eqNullSafe(F.col("_llm_source")))
    own = F.struct(*at)
    part = F.when(own < F.col("_llm_border"), F.col("_llm_size")).when(own.eqNullSafe(F.col("_llm_border")), F.col("_llm_due")).otherwise(F.lit(0))
    if (alike["most"] or 0) > 1:
        # the equal rows of a border: each task numbers its own
        tied = joined.where(
            own.eqNullSafe(F.col("_llm_border")) & (F.col("_llm_alike") > 1)
        ).withColumn("_llm_task", F.shiftright("_llm_place", 33))
        tasks = tied.groupBy(F.col("source").alias("_llm_in"), F.col("_llm_task").alias("_llm_of")).agg(F.count(F.lit(1)).alias("_llm_n"))
        before = Window.partitionBy("_llm_in").orderBy("_llm_of").rowsBetween(Window.unboundedPreceding, -1)
        tasks = tasks.select("_llm_in", "_llm_of", F.coalesce(F.sum("_llm_n").over(before), F.lit(0)).alias("_llm_offset"))
        tied = tied.join(tasks, F.col("source").eqNullSafe(F.col("_llm_in")) & (F.col("_llm_task") == F.col("_llm_of")))
        number = F.row_number().over(Window.partitionBy("source", "_llm_task").orderBy("_llm_place")) - 1 + F.col("_llm_offset")
        left = F.col("_llm_due") - number * F.col("_llm_size")
        tied = tied.withColumn("_llm_part", F.greatest(F.lit(0), F.least(F.col("_llm_size"), left))).drop("_llm_task", "_llm_in", "_llm_of", "_llm_offset")
        apart = joined.where(~(own.eqNullSafe(F.col("_llm_border")) & (F.coalesce("_llm_alike", F.lit(0)) > 1)))
        joined = apart.withColumn("_llm_part", part).unionByName(tied)
    else:
        joined = joined.withColumn("_llm_part", part)
    taken = (F.col("_llm_epochs") * F.col("_llm_size") + F.col("_llm_part")).cast("long")
    return joined.withColumn("taken", taken).select(*without(df, OUT).columns, *OUT)


#: Quality weight of a document by its label; without a label it lies between the two.
GOOD, POOR, UNKNOWN = 1.0, 0.25, 0.7


def with_quality(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Add ``quality_weight`` from ``labels.quality`` by ``doc_id``; the lowest of several labels counts."""
    lowest = labels.groupBy(F.col("doc_id").alias("_llm_id")).agg(F.min("quality").alias("_llm_q"))
    q = F.col("_llm_q")
    weight = F.when(q >= 1, GOOD).when(q < 1, POOR).otherwise(UNKNOWN)
    joined = without(rows, ["quality_weight"]).join(lowest, F.col("doc_id") == F.col("_llm_id"), "left")
    return joined.withColumn("quality_weight", weight).drop("_llm_id", "_llm_q")


def mix_documents(documents: DataFrame, labels: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Narrow rows of the mix: ``doc_id``, ``source``, ``size`` (words), ``text_md5``, ``keep`` and the results of `mix`."""
    narrow = documents.select("doc_id", "source", count_words(F.col("text")).alias("size"), F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"), *keep)
    rows = with_quality(narrow, labels)
    return mix(rows, F.col("size"), F.col("quality_weight"), [F.col("doc_id"), F.col("text_md5")])


def op10_mix_sources(spark, sf_dir: str) -> DataFrame:
    rows = mix_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rows.select("doc_id", "size", "source_size", "target", "taken", "quality_weight")


OP10_SQL = f"""
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as size,
    md5(coalesce(text, '')) as text_md5
  from documents),
q as (select doc_id as id, min(quality) as q from labels group by 1),
w as (
  select d.*, case when q.q >= 1 then {GOOD} when q.q < 1 then {POOR} else {UNKNOWN} end as quality_weight,
    md5('29:' || coalesce(doc_id::varchar, '') || ':' || text_md5) as h
  from d left join q on d.doc_id = q.id),
k as (select *, -ln((('0x' || substr(h, 1, 13))::bigint::double + 0.5) / 4503599627370496.0) / quality_weight as key from w),
s as (
  select source, sum(size)::bigint as source_size,
    [3, 1, 2][1 + (row_number() over (order by source nulls last) - 1) % 3] as sw from k group by 1),
r as (
  select *, coalesce(sum(source_size * 2) over lower, 0) as held, sum(sw) over higher as open_weight,
    1.5 * sum(source_size) over () as total
  from s window lower as (order by source_size * 2.0 / sw, source rows between unbounded preceding and 1 preceding),
    higher as (order by source_size * 2.0 / sw, source rows between current row and unbounded following)),
l as (
  select arg_min((total - held) / open_weight, source_size * 2.0 / sw)
    filter (where (total - held) / open_weight < source_size * 2.0 / sw) as level from r),
t as (select source, source_size, least(source_size * 2.0, sw * coalesce(level, 1e300))::double as target from s, l),
p as (
  select k.*, t.source_size, t.target, round(t.target)::bigint // greatest(t.source_size, 1) as epochs,
    round(t.target)::bigint % greatest(t.source_size, 1) as rest,
    coalesce(sum(size) over (partition by k.source order by key, size, doc_id, text_md5 rows between unbounded preceding and 1 preceding), 0) as run
  from k join t on k.source is not distinct from t.source)
select doc_id, size::bigint as size, source_size, target,
  (epochs * size + greatest(0, least(size, rest - run)))::bigint as taken, quality_weight::double as quality_weight
from p
"""
