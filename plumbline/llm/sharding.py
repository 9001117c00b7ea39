"""Uniform shuffle into shards of exact sizes, planned by a hypergeometric communication matrix."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import table, without
from plumbline.sources.staging import materialise

OUT = ["shard", "slot"]
_EXACT_BELOW = 10**9  # the generator's own law is limited to smaller populations


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """How many of ``drawn`` items are good. Large populations: inversion of the exact law around its mode."""
    if good + bad < _EXACT_BELOW:
        return int(rng.hypergeometric(good, bad, drawn)) if drawn else 0
    least, most = max(0, drawn - bad), min(drawn, good)
    total = good + bad
    mode = min(most, max(least, (drawn + 1) * (good + 1) // (total + 2)))
    spread = math.sqrt(max(1.0, drawn * (good / total) * (bad / total) * ((total - drawn) / max(1, total - 1))))
    lo, hi = max(least, mode - int(40 * spread) - 40), min(most, mode + int(40 * spread) + 40)
    k = np.arange(lo, hi, dtype=np.float64)
    steps = np.log((good - k) * (drawn - k)) - np.log((k + 1) * (bad - drawn + k + 1))
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    weights = np.exp(logs - logs.max())
    return lo + int(np.searchsorted(np.cumsum(weights), rng.random() * weights.sum(), side="right"))


def communication_matrix(blocks: list[int], shards: list[int], seed: int) -> list[list[int]]:
    """Rows that each block sends to each shard: row and column sums are exact, the law is that of a uniform shuffle."""
    rng = np.random.default_rng(seed)
    room, matrix = list(shards), []
    for size in blocks:
        left, pool, row = size, sum(room), []
        for s, free in enumerate(room):
            pool -= free
            sent = left if s == len(room) - 1 else hypergeometric(rng, free, pool, left)
            row.append(sent)
            left -= sent
        room = [free - sent for free, sent in zip(room, row)]
        matrix.append(row)
    return matrix


#: Blocks up to which what is known of each is broadcast (some 200 bytes each).
FEW_BLOCKS = 100_000


def _few(of_blocks: DataFrame, blocks: int) -> DataFrame:
    return F.broadcast(of_blocks) if blocks <= FEW_BLOCKS else of_blocks


def shuffle_into_shards(
    df: DataFrame, identity: list[Column], n_shards: int = 24, seed: int = 17, rows_per_block: int = 1_000_000,
    least_blocks: int = 32,
) -> DataFrame:
    """Add ``shard`` (0 to ``n_shards`` - 1) and ``slot`` (gapless from 0 in its shard) by a uniform random shuffle.

    ``identity`` are columns that tell rows apart; rows that agree in them are interchangeable. Shard counts differ by
    one at most. Blocks of rows are counted; the counts that each block sends to each shard are drawn exactly; a
    block's rows are permuted and cut by those counts; each shard's rows are permuted again in subdivisions of it. So
    no window holds more than about ``rows_per_block`` rows, and what the driver holds is one number per block and
    shard. Pass narrow rows: they are written once to the shared folder, which makes the random keys final.

    A block that repeated identities make too large is split by the rows' places in that write.

    Null identities are told apart by their place in the scan. Existing columns named as the results are replaced. An
    empty frame gives an empty result; repeated rows each get a slot of their own.
    """
    spark, rows = df.sparkSession, without(df, OUT)
    place = F.monotonically_increasing_id()
    known = [F.coalesce(c.cast("string"), place.cast("string")) for c in identity]
    rows, measured = materialise(
        rows.select(
            "*", F.xxhash64(F.lit(seed), *known).alias("_llm_a"), F.xxhash64(F.lit(~seed), *known).alias("_llm_b"), place.alias("_llm_place")
        ),
        n=F.count(F.lit(1)),
    )
    n = measured["n"] or 0
    n_blocks = max(least_blocks, math.ceil(n / rows_per_block))
    rows = rows.withColumn("_llm_block", F.pmod("_llm_a", F.lit(n_blocks)).cast("int"))
    sizes = {r[0]: r[1] for r in rows.groupBy("_llm_block").count().collect()}
    large = [(b, math.ceil(size / rows_per_block)) for b, size in sorted(sizes.items()) if size > 2 * rows_per_block]
    salt = F.lit(0).cast("bigint")
    if large:
        first = n_blocks + np.concatenate([[0], np.cumsum([k for _, k in large])])
        split = spark.createDataFrame([(b, k, int(f)) for (b, k), f in zip(large, first)], "_llm_block int, _llm_pieces int, _llm_from int")
        piece = F.pmod(F.xxhash64("_llm_place"), F.col("_llm_pieces")).cast("int")
        # at most one row per rows_per_block rows
        rows = rows.join(_few(split, len(large)), "_llm_block", "left").withColumns({
            "_llm_block": F.coalesce(F.col("_llm_from") + piece, F.col("_llm_block")),
            "_llm_salt": F.when(F.col("_llm_from").isNotNull(), F.col("_llm_place")).otherwise(salt),
        })
        salt = F.col("_llm_salt")
        n_blocks = int(first[-1])
        sizes = {r[0]: r[1] for r in rows.groupBy("_llm_block").count().collect()}
    shards = [n // n_shards + (s < n % n_shards) for s in range(n_shards)]
    matrix = communication_matrix([sizes.get(b, 0) for b in range(n_blocks)], shards, seed)
    cuts = spark.createDataFrame([(b, np.cumsum(row).tolist()) for b, row in enumerate(matrix)], "_llm_block int, _llm_cuts array<bigint>")

    local = Window.partitionBy("_llm_block").orderBy("_llm_b", "_llm_a")
    rows = rows.withColumn("_llm_rank", (F.row_number().over(local) - 1).cast("long")).join(_few(cuts, n_blocks), "_llm_block").withColumn(
        "shard", F.size(F.filter("_llm_cuts", lambda cut: cut <= F.col("_llm_rank"))).cast("int")
    )

    parts = max(2, math.ceil(n / n_shards / rows_per_block))
    again = F.xxhash64(F.lit(seed + 1), "_llm_a", "_llm_b", salt)
    rows = rows.withColumn("_llm_key", again).withColumn("_llm_part", F.pmod("_llm_key", F.lit(parts)).cast("int"))
    earlier = Window.partitionBy("shard").orderBy("_llm_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("shard", "_llm_part").agg(F.count(F.lit(1)).alias("_llm_n")).select(
        "shard", "_llm_part", F.coalesce(F.sum("_llm_n").over(earlier), F.lit(0)).alias("_llm_offset")
    )
    inner = Window.partitionBy("shard", "_llm_part").orderBy("_llm_key", "_llm_a")
    placed = rows.withColumn("_llm_row", F.row_number().over(inner) - 1)
    # one offset per shard and part: bounded by the number of rows over rows_per_block
    placed = placed.join(_few(offsets, n_shards * parts), ["shard", "_llm_part"]).withColumn(
        "slot", (F.col("_llm_offset") + F.col("_llm_row")).cast("long")
    )
    return placed.select(*[c for c in rows.columns if not c.startswith("_llm_") and c not in OUT], *OUT)


def sized(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``size`` (UTF-8 bytes of the text plus 8) and ``text_crc32`` of whole texts; null texts count as none."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return documents.select("doc_id", (F.length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))


def op9_uniform_shards(spark, sf_dir: str) -> DataFrame:
    rows = sized(table(spark, sf_dir, "documents"))
    placed = shuffle_into_shards(rows, [F.col("doc_id")])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
