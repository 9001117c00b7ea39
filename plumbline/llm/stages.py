"""Stages of the corpus pipeline: ``(spark, docs, sf_dir)`` to the documents that are left, in the columns of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import mixing, pieces, quality, sketches, suffix
from plumbline.llm.common import count_words, table, without
from plumbline.operators.numbering import assign_ids
from plumbline.sources.staging import materialise


#: Bytes of a passage that must not repeat. A run of over 50 words takes about 330 bytes, hardly ever less than 280; a little less leaves room for ends that differ.
PASSAGE = 240


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it; the one at a source's border counts by the nearest whole pass.

    The mix works on narrow rows, one per row of ``docs``; equal rows get the sum of what they are due, spread evenly,
    so a join on the document's id and text brings the passes back without telling equal rows apart.
    """
    rows = mixing.mix_documents(docs, table(spark, sf_dir, "labels"))
    size = F.greatest(F.sum("size"), F.lit(1))
    due = rows.groupBy(F.col("doc_id").alias("_llm_id"), F.col("text_md5").alias("_llm_md5")).agg(
        F.round(F.sum("taken") / size).cast("int").alias("_llm_times")
    ).where(F.col("_llm_times") > 0)
    md5 = F.md5(F.coalesce("text", F.lit("")))
    joined = docs.join(due, F.col("doc_id").eqNullSafe(F.col("_llm_id")) & (md5 == F.col("_llm_md5")))
    return joined.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col("_llm_times"))).alias("_llm_pass")).drop("_llm_pass")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    model = quality.fit_on(docs, table(spark, sf_dir, "labels"))
    held = {c: f"_llm_held_{i}" for i, c in enumerate(docs.columns) if c != "text"}
    judged = quality.judge_quality(docs.withColumnsRenamed(held), model).where("kept")
    return judged.select(*[F.col(held.get(c, c)).alias(c) for c in docs.columns])


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with the digests of its ids and of the text they give back."""
    own = without(docs, [*pieces.OUT, *pieces.DIGESTS])
    return pieces.digests(pieces.encode_documents(own), *own.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that with the smallest doc_id, one without an id only if no other is there.
    Rows without words (null and empty texts too) stay, other columns pass through. No documents: none.

    Rows are judged one by one: where ids repeat or are null, each id and text gets a number of its own to be judged by.
    """
    digest = F.md5(F.coalesce("text", F.lit("")))
    keyed = docs.select("doc_id", digest.alias("_llm_md5"))
    again, seen = materialise(
        keyed.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")), keep=F.expr("n > 1 or doc_id is null"),
        least=F.min("doc_id"), most=F.max("doc_id"), odd=F.count_if(F.expr("n > 1 or doc_id is null")),
    )
    if not seen["odd"]:
        gone = sketches.near_duplicates(docs).where("not kept").select("doc_id")
        return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)

    again = again.select(F.col("doc_id").alias("_llm_id"))
    odd, counted = materialise(
        keyed.join(again, F.col("doc_id").eqNullSafe(F.col("_llm_id")), "left_semi").distinct(), n=F.count(F.lit(1))
    )
    most, least = seen["most"] or 0, seen["least"] or 0
    start = most if most < 2**62 else min(least, 0) - counted["n"] - 1
    numbers = assign_ids(odd, "_llm_node", start, ["doc_id", "_llm_md5"]).select(
        "_llm_node", F.col("doc_id").alias("_llm_id"), F.col("_llm_md5").alias("_llm_own")
    )
    numbers, _ = materialise(numbers)
    same = F.col("doc_id").eqNullSafe(F.col("_llm_id")) & (digest == F.col("_llm_own"))
    node = F.coalesce("_llm_node", "doc_id")
    rows = suffix.stored(docs.join(numbers, same, "left").select(
        *docs.columns, node.alias("_llm_node"), (F.col("_llm_node").isNotNull() & (count_words(F.col("text")) > 0)).alias("_llm_odd")
    ))

    judged = sketches.near_duplicates(rows.select(F.col("_llm_node").alias("doc_id"), "text")).where("n_shingles > 0")
    judged = judged.select(F.col("doc_id").alias("_llm_node"), F.col("component_id").alias("_llm_group")).distinct()
    known = numbers.select("_llm_node", "_llm_id", F.lit(True).alias("_llm_known"))
    judged = judged.join(known, "_llm_node", "left").withColumn(
        "_llm_id", F.when(F.col("_llm_known"), F.col("_llm_id")).otherwise(F.col("_llm_node"))
    )
    judged, _ = materialise(judged)
    order = F.struct(F.col("_llm_id").isNull().alias("nameless"), "_llm_id", "_llm_node")
    first = judged.groupBy("_llm_group").agg(F.min(order).alias("first"))
    gone = judged.join(first.select(F.col("first._llm_node").alias("_llm_node")), "_llm_node", "left_anti").select("_llm_node")
    left = rows.join(gone, "_llm_node", "left_anti")
    # equal rows fold in each task: a crowd of them is nobody's window
    plain = [f.name for f in docs.schema if "map<" not in f.dataType.simpleString()]
    one = F.min_by(F.struct(*docs.columns), F.xxhash64(*plain)).alias("_llm_row")
    once = left.where("_llm_odd").groupBy("_llm_node").agg(one).select("_llm_row.*")
    return left.where("not _llm_odd").select(*docs.columns).unionByName(once)


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the bytes of strings of ``PASSAGE`` bytes that are also in another, different text;
    characters that lost a byte go whole, ``n_chars`` follows.

    What two texts share goes from every place; what repeats within one text stays, and so do rows of equal texts (the
    stage before leaves none but ones without words). Null, empty and shorter texts come out as they went in, and so do
    all other columns. No documents: none.
    """
    gone = suffix.remove_repeats(docs, PASSAGE, across=True).select(F.col("key").alias("_llm_key"), F.col("kept_text").alias("_llm_kept"))
    joined = docs.join(gone, suffix.text_key() == F.col("_llm_key"), "left")
    changed = {"text": F.coalesce("_llm_kept", "text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("_llm_kept").isNull(), F.col("n_chars")).otherwise(F.length("_llm_kept").cast("long"))
    return joined.select(*[changed.get(c, F.col(c)).alias(c) for c in docs.columns])
