"""Uniqueness: the first row of each value passes, later ones fail.

The table is wide and mostly clean, and one value (often NULL) may hold a third
of its rows, so neither a window over whole rows nor a window per value is safe.

1. Count the values of all fields in one scan of these columns. Partial
   aggregation folds a hot value to one row per task before the shuffle. Values
   seen once need no more work.
2. If few values repeat, find the first row of each and look them up by a
   broadcast join: the wide rows are never shuffled. The declared columns and the
   rows' places are read for that; other columns only for values whose first two
   rows tie in the declared order.
3. If many values repeat in one field only, and the counts show that no group is
   large, rank the rows by a window.
4. Otherwise list the failing rows by position. Rows of hot values are compared
   with their value's first row; the rest have bounded groups, which a window
   over narrow rows ranks. The lists of all fields merge into one row per
   position, and the wide rows are shuffled once, on a unique key.

Long texts are grouped by their SHA-256, so keys have a bounded width.

"First" follows the declared columns, then a digest of the row's own values, and
only then its place in the table: rewriting or moving a table changes no count.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DatetimeType,
    MapType,
    NumericType,
    StringType,
    StructType,
)

from plumbline.functions.rules import column
from plumbline.sources.staging import POSITION, has_position, materialise, stage_with_position

# Looked-up values: a key is 8 bytes or, as text, up to 65; a position 24; a hash table's entry 16 more. Beyond some
# hundred thousand values a window is the cheaper way.
MAX_BROADCAST_BYTES = 5 << 20
_NUMBER_BYTES, _TEXT_BYTES, _ENTRY_BYTES = 8, 65, 40
# A value is hot above this many rows: no window ever ranks a larger group, however large the table is.
HOT_ROWS = 100_000
# Wide rows that one task joins with the list of failing ones, about; what it sorts does not grow with the table.
ROWS_PER_TASK = 500_000
LONG_TEXT_BYTES = 64

# Fields counted in one scan: each row goes into the aggregate once per field.
COUNTED_AT_ONCE = 8

# Bits of one word in the list of fields in which a row is a later duplicate.
WORD_BITS = 62

_KEY, _COUNT, _FIRST, _LATE = "_dq_key", "_dq_count", "_dq_first", "_dq_late"
_IDENTITY = ("_dq_id_a", "_dq_id_b")
_CONTENT = ("_dq_row_a", "_dq_row_b")


def grouping_key(df: DataFrame, field: str) -> Column:
    """The value itself, or a digest of a long text; digests are longer than any text kept."""
    value = column(field)
    kind = df.select(value).schema[0].dataType
    if isinstance(kind, (ArrayType, MapType, StructType)):
        raise ValueError(f"uniqueness is judged on columns of atomic types, {field!r} is {kind.simpleString()}")
    if not isinstance(kind, (StringType, BinaryType)):
        return value
    digest = F.concat(F.lit("#"), F.sha2(value, 256))
    return F.when(F.octet_length(value) > LONG_TEXT_BYTES, digest.cast(kind)).otherwise(value)


def is_key(df: DataFrame, columns: Sequence[str]) -> bool:
    """Whether the columns identify a row."""
    groups = df.groupBy(*[column(c) for c in columns]).agg(F.count(F.lit(1)).alias(_COUNT))
    return groups.agg(F.max(_COUNT)).first()[0] in (None, 1)


def _is_narrow(df: DataFrame, columns: Sequence[str]) -> bool:
    """Whether the columns have a fixed width, so that as many as are broadcast have a bounded size."""
    kinds = [f.dataType for f in df.select(*[column(c) for c in columns]).schema]
    return all(isinstance(k, (NumericType, DatetimeType, BooleanType)) for k in kinds)


def _digests(df: DataFrame, columns: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Add a 128-bit digest of the columns, as two numbers."""
    values = [column(c) for c in columns]
    return df.select("*", *[F.xxhash64(F.lit(seed), *values).alias(name) for seed, name in enumerate(names)])


def with_row_identity(df: DataFrame, order_by: Sequence[str]) -> tuple[DataFrame, list[str], list[str]]:
    """The frame with columns that identify each of its rows, the same in every scan; and the columns whose values
    settle which of two rows comes first where the declared order does not (none if it always does).

    A declared order that is a key identifies rows by itself, by a digest where it holds texts. Otherwise a row is
    identified by its position, and the rows' values follow the declared order. Where rows have no position their
    values' digest identifies them; only rows that equal another one are written once, to get a position.
    """
    if not has_position(df) and order_by and is_key(df, order_by):
        if _is_narrow(df, order_by):
            return df, list(order_by), []
        return _digests(df, order_by, _IDENTITY), list(_IDENTITY), []
    own = [f.name for f in df.schema if not f.name.startswith("_dq_") and "map<" not in f.dataType.simpleString()]
    if has_position(df):
        return df, list(POSITION), own
    df = _digests(df, own, _IDENTITY)
    twins, seen = materialise(
        df.groupBy(*_IDENTITY).agg(F.count(F.lit(1)).alias(_COUNT)), keep=F.col(_COUNT) > 1, n=F.count_if(F.col(_COUNT) > 1)
    )
    if not seen["n"]:
        return df, list(_IDENTITY), []
    names = [f"_dq_twin_{i}" for i in range(len(_IDENTITY))]
    twins = twins.select(*[F.col(c).alias(a) for c, a in zip(_IDENTITY, names)])
    if seen["n"] <= MAX_BROADCAST_BYTES // (2 * _NUMBER_BYTES + _ENTRY_BYTES):
        twins = F.broadcast(twins)
    placed = stage_with_position(df.join(twins, _all_same(_IDENTITY, names), "left_semi"))
    rest = df.join(twins, _all_same(_IDENTITY, names), "left_anti").select("*", *[F.lit(0).cast("long").alias(c) for c in POSITION])
    return rest.unionByName(placed), [*_IDENTITY, *POSITION], []


def _broadcast_keys(df: DataFrame, key: Column) -> int:
    """How many values of a field may be looked up by a broadcast: as many as stay below its bound in bytes."""
    is_text = isinstance(df.select(key).schema[0].dataType, (StringType, BinaryType))
    return MAX_BROADCAST_BYTES // ((_TEXT_BYTES if is_text else _NUMBER_BYTES) + _ENTRY_BYTES)


def mark_first(
    df: DataFrame,
    fields: Sequence[str],
    order_by: Sequence[str] = (),
    max_broadcast_keys: int | None = None,
    hot_rows: int = HOT_ROWS,
) -> tuple[DataFrame, dict[str, Column]]:
    """Per field, a Column that is true on the first row of each value.

    "First" follows ``order_by``, the row's values and then its position in the
    table. The frame returned carries the helper columns those Columns read.
    """
    order_by = list(dict.fromkeys(order_by))
    df, identity, values = with_row_identity(df, order_by)
    fields = list(dict.fromkeys(fields))
    keys = {f: grouping_key(df, f) for f in fields}
    counted = _repeated_keys(df, list(keys.values()), hot_rows)

    marked, flags, crowded, n_rows = df, {}, [], 0
    for n, (field, (repeated, seen)) in enumerate(zip(fields, counted)):
        most = _broadcast_keys(df, keys[field]) if max_broadcast_keys is None else max_broadcast_keys
        if not seen["repeated"]:
            flags[field] = F.lit(True)
        elif seen["repeated"] <= most:
            first = _first_rows(df, keys[field], repeated, order_by, identity, values)
            marked = _look_up(marked, first, keys[field], identity, f"_dq_first_{n}")
            flags[field] = F.col(f"_dq_first_{n}")
        else:
            n_rows = seen["rows"]
            crowded.append((field, repeated.where(F.col(_COUNT) > hot_rows) if seen["hot"] else None, seen["hot"] <= most))

    if not crowded:
        return marked, flags
    settled = _digests(df, values, _CONTENT) if values else df
    order = list(dict.fromkeys([*order_by, *(_CONTENT if values else ()), *identity]))
    if len(crowded) == 1 and crowded[0][1] is None:
        field = crowded[0][0]
        by_values = [F.xxhash64(F.lit(seed), *[column(c) for c in values]) for seed in range(len(_CONTENT))] if values else []
        places = [column(c) for c in dict.fromkeys(order_by) if c != field], [column(c) for c in identity if c not in (field, *order_by)]
        rank = F.row_number().over(Window.partitionBy(keys[field]).orderBy(*places[0], *by_values, *places[1]))
        marked = marked.withColumn("_dq_rank", rank)
        flags[field] = F.col("_dq_rank") == 1
    else:
        late = []
        for field, hot, few in crowded:
            narrow = settled.select(keys[field].alias(_KEY), *[column(c) for c in order])
            # read twice: by the rows of hot values and by the others
            first = None if hot is None else materialise(_first_rows(df, keys[field], hot, order_by, identity, values, few=few))[0]
            late.append(_late_rows(narrow, first, order, identity, few))
        marked = _join_late(marked, late, identity, -(-n_rows // ROWS_PER_TASK))
        for i, (field, *_) in enumerate(crowded):
            word, bit = divmod(i, WORD_BITS)
            flags[field] = F.coalesce(F.getbit(F.col(f"{_LATE}_{word}"), F.lit(bit)) == 0, F.lit(True))
    return marked, flags


def late_rows_per_group(
    df: DataFrame, fields: Sequence[str], order_by: Sequence[str], counted: Column, by: Sequence[str] = ()
) -> dict[str, DataFrame]:
    """Per field, in each group of ``by``: ``_dq_count``, its ``counted`` rows that are not the first of their value.

    "First" is the row that ``mark_first`` marks. Values are counted in one scan of the fields; only rows of repeated
    values are looked at again, folded to a row per value and group in each task.
    """
    order_by = list(dict.fromkeys(order_by))
    df, identity, values = with_row_identity(df, order_by)
    fields = list(dict.fromkeys(fields))
    keys = {f: grouping_key(df, f) for f in fields}
    groups = {c: f"_dq_by_{i}" for i, c in enumerate(by)}
    own = [column(c).alias(a) for c, a in groups.items()]
    found = {}
    for field, (repeated, seen) in zip(fields, _repeated_keys(df, list(keys.values()))):
        few = seen["repeated"] <= _broadcast_keys(df, keys[field])
        wanted = repeated.select(F.col(_KEY).alias("_dq_wanted"))
        same = keys[field].eqNullSafe(F.col("_dq_wanted"))
        rows = df.where(counted).join(F.broadcast(wanted) if few else wanted, same, "left_semi")
        first = _first_rows(df, keys[field], repeated, order_by, identity, values, {"_dq_counted": counted, **{a: column(c) for c, a in groups.items()}}, few)
        # each value's first row comes off its group's rows
        all_rows = rows.select(*own, F.lit(1).alias("n"))
        first_rows = first.where("_dq_counted").select(*groups.values(), F.lit(-1).alias("n"))
        found[field] = all_rows.unionByName(first_rows).groupBy(*groups.values()).agg(F.sum("n").alias(_COUNT)).select(
            *[F.col(a).alias(c) for c, a in groups.items()], F.coalesce(_COUNT, F.lit(0)).alias(_COUNT)
        )
    return found


def _repeated_keys(df: DataFrame, keys: Sequence[Column], hot_rows: int = HOT_ROWS) -> list[tuple[DataFrame, dict]]:
    """Per key: its repeated values with their counts, and what is known of all of them. One scan counts
    ``COUNTED_AT_ONCE`` keys."""
    if len(keys) > COUNTED_AT_ONCE:
        return [found for i in range(0, len(keys), COUNTED_AT_ONCE) for found in _repeated_keys(df, keys[i : i + COUNTED_AT_ONCE], hot_rows)]
    names = [f"{_KEY}_{i}" for i in range(len(keys))]
    narrow = df.select(*[k.alias(n) for k, n in zip(keys, names)])
    count = F.count(F.lit(1)).alias(_COUNT)
    if len(keys) == 1:
        counts = narrow.groupBy(*names).agg(count).withColumn("_dq_set", F.lit(0))
    else:
        sets = [[n] for n in names]
        # a set that leaves out all columns but one has ones in all other places
        counts = narrow.groupingSets(sets, *names).agg(count, F.grouping_id().alias("_dq_set"))
    of_set = {i: (F.col("_dq_set") == (0 if len(keys) == 1 else ((1 << len(keys)) - 1) ^ (1 << (len(keys) - 1 - i)))) for i in range(len(keys))}
    measures = {}
    for i, here in of_set.items():
        measures[f"rows_{i}"] = F.sum(F.when(here, F.col(_COUNT)))
        measures[f"repeated_{i}"] = F.count_if(here & (F.col(_COUNT) > 1))
        measures[f"hot_{i}"] = F.count_if(here & (F.col(_COUNT) > hot_rows))
    stored, seen = materialise(counts, keep=F.col(_COUNT) > 1, **measures)
    return [
        (stored.where(of_set[i]).select(F.col(n).alias(_KEY), _COUNT), {m: seen[f"{m}_{i}"] for m in ("rows", "repeated", "hot")})
        for i, n in enumerate(names)
    ]


def _all_same(left: Sequence[str], right: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [column(a).eqNullSafe(column(b)) for a, b in zip(left, right)])


def _rank(key: Column, order: Sequence[str]) -> Column:
    return F.row_number().over(Window.partitionBy(key).orderBy(*[column(c) for c in order]))


def _first_rows(
    df: DataFrame, key: Column, repeated: DataFrame, order_by: Sequence[str], identity: Sequence[str], values: Sequence[str],
    carried: dict[str, Column] | None = None, few: bool = True,
) -> DataFrame:
    """Of each repeated value the first row: the value, ``identity`` of the row and what it ``carried``.

    Among the rows that come first in the declared order, the one with the least place and the one with the greatest
    are the same unless they tie. Only tying values are looked at again, with digests of the rows' ``values``: they are
    the small side of a join, and where there are none Spark drops the join before it scans the table.
    """
    carried = carried or {}
    places = {f"_dq_at_{i}": column(c) for i, c in enumerate(identity)}
    told = {f"_dq_by_{i}_": column(c) for i, c in enumerate(order_by)}

    def least(rows: DataFrame, wanted: DataFrame, keep_order: bool, extra: dict[str, Column]) -> DataFrame:
        """Rows of wanted values, the first of each by declared order (or among given ones) and then ``extra``."""
        fields = {**(told if keep_order else {}), **extra, **places, **carried}
        parts = [F.struct(*[v.alias(n) for n, v in fields.items()]).alias(_FIRST)]
        if values and keep_order and order_by:
            backwards = {**told, **{n: F.bitwise_not(v) for n, v in places.items()}}
            parts.append(F.struct(*[v.alias(n) for n, v in backwards.items()]).alias("_dq_last"))
        same = key.eqNullSafe(F.col("_dq_wanted"))
        if not keep_order:
            for n, v in told.items():
                same = same & v.eqNullSafe(F.col(f"{n}w"))
        hit = rows.join(F.broadcast(wanted) if few else wanted, same, "left_semi").select(key.alias(_KEY), *parts)
        return hit.groupBy(_KEY).agg(*[F.min(c).alias(c) for c in hit.columns[1:]])

    def result(rows: DataFrame) -> DataFrame:
        return rows.select(
            _KEY, *[F.col(f"{_FIRST}.{n}").alias(c) for n, c in zip(places, identity)], *[F.col(f"{_FIRST}.{n}").alias(n) for n in carried]
        )

    wanted = repeated.select(F.col(_KEY).alias("_dq_wanted"))
    if not values:
        return result(least(df, wanted, True, {}))
    digests = {name: F.xxhash64(F.lit(seed), *[column(c) for c in values]) for seed, name in enumerate(_CONTENT)}
    if not order_by:
        return result(least(df, wanted, True, digests))
    ties = reduce(lambda a, b: a | b, [F.col(f"{_FIRST}.{n}") != F.bitwise_not(F.col(f"_dq_last.{n}")) for n in places])
    found = least(df, wanted, True, {}).withColumn("_dq_tie", ties)
    tied = found.where("_dq_tie").select(F.col(_KEY).alias("_dq_wanted"), *[F.col(f"{_FIRST}.{n}").alias(f"{n}w") for n in told])
    return result(found.where("not _dq_tie")).unionByName(result(least(df, tied, False, digests)))


def _look_up(
    marked: DataFrame, first: DataFrame, key: Column, identity: Sequence[str], flag: str
) -> DataFrame:
    """Add a flag: the row's value does not repeat, or the row is the first one of it."""
    names = [f"_dq_found_{i}" for i in range(len(identity))]
    found = first.select(
        F.col(_KEY).alias("_dq_found"),
        F.lit(True).alias("_dq_hit"),
        *[column(c).alias(a) for c, a in zip(identity, names)],
    )
    is_first = F.col("_dq_hit").isNull() | _all_same(identity, names)
    joined = marked.join(F.broadcast(found), key.eqNullSafe(F.col("_dq_found")), "left")
    return joined.select(*[column(c) for c in marked.columns], is_first.alias(flag))


def _late_rows(
    narrow: DataFrame, first: DataFrame | None, order: Sequence[str], identity: Sequence[str], few: bool
) -> DataFrame:
    """Identity of every row that is not the first of its value. ``first`` has the first rows of the hot values; rows of
    these meet it by a broadcast, or by a join (which Spark splits at hot values) if there are too many of them."""
    ids = [column(c) for c in identity]
    cold = narrow
    if first is not None:
        names = [f"_dq_first_{i}" for i in range(len(identity))]
        first = first.select(F.col(_KEY).alias("_dq_hot"), *[c.alias(a) for c, a in zip(ids, names)])
        is_hot = F.col(_KEY).eqNullSafe(F.col("_dq_hot"))
        first = F.broadcast(first) if few else first
        cold = narrow.join(first, is_hot, "left_anti")
    late = cold.withColumn("_dq_rank", _rank(F.col(_KEY), order)).where("_dq_rank > 1").select(*ids)
    if first is None:
        return late
    of_hot = narrow.join(first, is_hot)
    return late.unionByName(of_hot.where(~_all_same(identity, names)).select(*ids))


def _join_late(marked: DataFrame, lists: Sequence[DataFrame], identity: Sequence[str], tasks: int) -> DataFrame:
    """Attach to each row the set of fields in which it is a later duplicate, as bits of as many words as it takes.

    Where ``tasks`` are more than run at once, both sides are dealt to so many: Spark's own number of them follows the
    shuffle's compressed bytes and lets a task's memory grow with the table. Identities that may be null meet by other
    keys than their columns, so their join is left to Spark.
    """
    words = [f"{_LATE}_{w}" for w in range(-(-len(lists) // WORD_BITS))]
    bits = [
        rows.select("*", *[F.lit(1 << i % WORD_BITS if w == i // WORD_BITS else 0).cast("long").alias(word)
                           for w, word in enumerate(words)])
        for i, rows in enumerate(lists)
    ]
    names = [f"_dq_at_{i}" for i in range(len(identity))]
    late = reduce(DataFrame.unionByName, bits)
    same = _all_same(identity, names)
    if not any(f.nullable for f in marked.select(*[column(c) for c in identity]).schema):
        same = reduce(lambda a, b: a & b, [column(a) == column(b) for a, b in zip(identity, names)])
        if tasks > marked.sparkSession.sparkContext.defaultParallelism:
            marked, late = (df.repartition(tasks, *[column(c) for c in identity]) for df in (marked, late))
    late = (
        late
        .groupBy(*[column(c) for c in identity])
        .agg(*[F.bit_or(word).alias(word) for word in words])
        .select(*[column(c).alias(a) for c, a in zip(identity, names)], *words)
    )
    return marked.join(late, same, "left")
