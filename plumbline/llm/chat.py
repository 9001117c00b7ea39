"""Chat formatting as a prefix tree: turns that conversations share from their start are emitted once, depth first."""

from __future__ import annotations

import base64
import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.common import small_batches, table, to_arrow_schema
from plumbline.sources.staging import materialise

OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>"
TRAINED_ROLE = "assistant"
VOCABULARY = "byte_bpe_50k.tiktoken"
_IN_TEXT = re.compile(r"\\(\\|### |</turn>)|</turn>")
_IN_ROLE = re.compile(r"\\(\\|### |</turn>|: )|: ")


def escaped(text: Column, role: bool = False) -> Column:
    """Control strings, and backslashes, get a backslash before them; in a role what ends it too."""
    return F.regexp_replace(text, r"(\\|### |</turn>|: )" if role else r"(\\|### |</turn>)", r"\\$1")


def _until(pattern: re.Pattern, text: str, at: int) -> tuple[str, int]:
    """Unescaped text from ``at`` to the first control string, and the place after that."""
    out = []
    for match in pattern.finditer(text, at):
        out.append(text[at : match.start()])
        at = match.end()
        if match[1] is None:
            return "".join(out), at
        out.append(match[1])
    raise ValueError("a turn has no end")


def unescaped(text: str) -> str:
    return _IN_TEXT.sub(lambda m: m[1] or m[0], text)


def parse(text: str) -> list[tuple[str, str]]:
    """Roles and texts of formatted turns."""
    turns, at = [], 0
    while at < len(text):
        if not text.startswith(OPEN, at):
            raise ValueError("a turn has no head")
        role, at = _until(_IN_ROLE, text, at + len(OPEN))
        said, at = _until(_IN_TEXT, text, at)
        turns.append((role, said))
        at += 1  # the line's end
    return turns


def _tokenizer(path: str | None):
    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path(VOCABULARY), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file)}
    return tiktoken.Encoding("turns", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def chained(conversations: DataFrame) -> DataFrame:
    """Turns by conversation with ``place`` (from 0), ``node`` (digest of the turns up to here) and ``parent``.

    Conversations are dealt out and sorted; a running digest goes through each, so a long one needs no memory.
    """
    kinds = "conv_id bigint, place bigint, node binary, parent binary, role string, text string"
    arrow = to_arrow_schema(kinds)
    rows = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches):
        last, node, place = object(), None, 0
        for batch in batches:
            for part in small_batches(iter([batch]), "text"):
                out = {name: [] for name in arrow.names}
                for conv, role, text in zip(*(part.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                    if conv != last:
                        last, node, place = conv, None, 0
                    role_bytes = role.encode()
                    said = b"%d:%s%s" % (len(role_bytes), role_bytes, text.encode())
                    parent, node = node, hashlib.blake2b((node or b"") + said, digest_size=16).digest()
                    for name, value in zip(arrow.names, (conv, place, node, parent, role, text)):
                        out[name].append(value)
                    place += 1
                yield pa.RecordBatch.from_pydict(out, schema=arrow)

    return rows.mapInArrow(run, kinds)


def formatted_nodes(nodes: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Add ``formatted``, the characters under the loss (``loss_start``, ``loss_end``; null for other roles), the token
    ``ids`` and, of those, ``loss_from`` and ``loss_to``."""
    trained = F.col("role") == TRAINED_ROLE
    shaped = nodes.withColumns({
        "head": F.concat(F.lit(OPEN), escaped(F.col("role"), True), F.lit(MIDDLE)), "body": escaped(F.col("text")),
    }).select(
        *nodes.drop("text").columns, "head", "body", F.concat("head", "body", F.lit(CLOSE + "\n")).alias("formatted"),
        F.when(trained, F.length("head")).cast("long").alias("loss_start"),
        F.when(trained, F.length("head") + F.length("body")).cast("long").alias("loss_end"),
    )

    def run(batches):
        coder = _tokenizer(vocabulary)
        for batch in small_batches(batches, "formatted"):
            parts = [coder.encode_ordinary_batch(batch.column(c).to_pylist(), num_threads=1) for c in ("head", "body")]
            tail = coder.encode_ordinary(CLOSE + "\n")
            ids = [h + b + tail for h, b in zip(*parts)]
            trains = batch.column("loss_start").is_valid().to_pylist()
            begin = [len(h) if t else None for h, t in zip(parts[0], trains)]
            end = [len(h) + len(b) if t else None for h, b, t in zip(*parts, trains)]
            kept = batch.select(columns)
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(ids, pa.list_(pa.int32())), pa.array(begin, pa.int64()), pa.array(end, pa.int64())],
                names=[*columns, "ids", "loss_from", "loss_to"],
            )

    columns = [c for c in shaped.columns if c not in ("head", "body")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in shaped.select(*columns).schema)
    return shaped.mapInArrow(run, f"{schema}, ids array<int>, loss_from bigint, loss_to bigint")


def offsets_in_order(rows: DataFrame, order: list[str], size: str) -> DataFrame:
    """Add ``offset``: the sum of ``size`` over all rows before this one. Range partitions are summed apart, then
    shifted by one number per partition."""
    placed, _ = materialise(rows.orderBy(*order))
    placed = placed.select("*", F.spark_partition_id().alias("_llm_part"), F.monotonically_increasing_id().alias("_llm_place"))
    before = Window.orderBy("_llm_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = placed.groupBy("_llm_part").agg(F.sum(size).alias("_llm_sum")).select(
        "_llm_part", F.coalesce(F.sum("_llm_sum").over(before), F.lit(0)).alias("_llm_shift")
    )
    inner = Window.partitionBy("_llm_part").orderBy("_llm_place").rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.withColumn("_llm_inner", F.coalesce(F.sum(size).over(inner), F.lit(0)))
    # one row per partition
    return summed.join(F.broadcast(shifts), "_llm_part").withColumn("offset", F.col("_llm_shift") + F.col("_llm_inner")).drop(
        "_llm_part", "_llm_place", "_llm_inner", "_llm_shift"
    )


def prefix_forest(conversations: DataFrame, vocabulary: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The forest's nodes and the conversations' paths through it.

    Nodes, one per distinct run of first turns: ``node``, ``parent``, ``place``, ``role``, ``owner`` (the smallest
    conversation through it), ``formatted`` and the loss spans and tokens of `formatted_nodes`; ``start`` and ``end``,
    the node's tokens in the depth-first layout of all trees; ``position``, the position id of its first token, which
    counts the tokens of its ancestors; ``attends``, the intervals of the layout that its tokens see besides their own
    node, ancestors in order. Paths: ``conv_id``, ``place``, ``node``.

    Turns go by turn, role and text; null roles and texts are empty, a null conv_id is a conversation. Children are
    laid out by their owners, so an owner's own turns stand together: one segment per conversation that adds any turn.
    Segments are sorted by where they branch off; only their lengths are summed over the corpus. Repeated rows are
    turns of their own. No rows give an empty forest. Extra columns are left out.
    """
    turns, _ = materialise(chained(conversations))
    owners = turns.groupBy("node").agg(F.min("conv_id").alias("owner"))
    owned, _ = materialise(turns.join(owners, "node"))
    own = owned.where(F.col("conv_id").eqNullSafe(F.col("owner")))
    nodes, _ = materialise(formatted_nodes(own.select("node", "parent", "place", "role", "owner", "text"), vocabulary))

    paths = owned.select("conv_id", "place", "node", "owner").join(nodes.select("node", F.size("ids").cast("long").alias("n")), "node")
    along = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    paths = paths.withColumn("position", F.coalesce(F.sum("n").over(along), F.lit(0)))
    paths, _ = materialise(paths)
    # a path runs through the segments of a few owners; where each run begins says where its segment branches off
    runs = paths.groupBy("conv_id", "owner").agg(F.min("place").alias("begin"), F.sum("n").alias("n"), F.min("position").alias("position"))
    steps = F.sort_array(F.collect_list(F.struct("begin", F.col("owner").alias("by"))))
    keys = runs.groupBy("conv_id").agg(F.transform(steps, lambda s: F.struct((-s["begin"]).alias("branch"), s["by"])).alias("key"))
    segments = runs.where(F.col("conv_id").eqNullSafe(F.col("owner"))).drop("owner").withColumnRenamed("conv_id", "id")
    segments = segments.join(keys, F.col("id").eqNullSafe(F.col("conv_id"))).select("id", "key", "n", F.col("position").alias("before"))
    segments, _ = materialise(offsets_in_order(segments, ["key"], "n").select("id", "offset", "before"))

    spans = runs.join(segments, F.col("owner").eqNullSafe(F.col("id"))).select(
        "conv_id", F.struct("begin", (F.col("offset") + F.col("position") - F.col("before")).alias("a"),
                            (F.col("offset") + F.col("position") - F.col("before") + F.col("n")).alias("b")).alias("span"),
        F.col("conv_id").eqNullSafe(F.col("owner")).alias("own"),
    ).where("not own").groupBy("conv_id").agg(F.sort_array(F.collect_list("span")).alias("spans"))
    interval = lambda a, b: F.struct(a.alias("from"), b.alias("to"))
    above = F.transform(F.coalesce("spans", F.array().cast("array<struct<begin:bigint,a:bigint,b:bigint>>")), lambda s: interval(s["a"], s["b"]))
    segments = segments.join(spans.withColumnRenamed("conv_id", "c"), F.col("id").eqNullSafe(F.col("c")), "left").select(
        "id", "offset", "before", above.alias("above")
    )
    at = paths.where(F.col("conv_id").eqNullSafe(F.col("owner"))).select("node", "conv_id", "position", "n")
    at = at.join(segments, F.col("conv_id").eqNullSafe(F.col("id")))
    start = F.col("offset") + F.col("position") - F.col("before")
    mine = F.when(start > F.col("offset"), F.array(interval(F.col("offset"), start))).otherwise(F.array().cast("array<struct<from:bigint,to:bigint>>"))
    at = at.select("node", start.alias("start"), (start + F.col("n")).alias("end"), "position", F.concat("above", mine).alias("attends"))
    return nodes.join(at, "node"), paths.select("conv_id", "place", "node")


def read_back(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """Conversations from the forest alone: digests of the parsed turns and of the text under the loss mask."""
    kinds = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    arrow = to_arrow_schema(kinds)
    rows = paths.join(nodes.select("node", "formatted", "loss_start", "loss_end"), "node").select(
        "conv_id", "place", "formatted", "loss_start", "loss_end"
    ).repartition("conv_id").sortWithinPartitions("conv_id", "place")

    def run(batches):
        begun, conv, done = False, None, {name: [] for name in arrow.names}
        turns = loss = None
        n = lost = chars = 0

        def close():
            for name, value in zip(arrow.names, (conv, n, turns.hexdigest(), lost, loss.hexdigest(), chars)):
                done[name].append(value)

        for batch in batches:
            for part in small_batches(iter([batch]), "formatted"):
                for i, (id_, text, begin, end) in enumerate(zip(*(part.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_end")))):
                    if not begun or id_ != conv:
                        if begun:
                            close()
                        begun, conv, turns, loss, n, lost, chars = True, id_, hashlib.sha256(), hashlib.sha256(), 0, 0, 0
                    for role, said in parse(text):
                        turns.update(f"{role}\n{said}\n".encode())
                        n += 1
                    if begin is not None:
                        said = unescaped(text[begin:end])
                        loss.update(said.encode())
                        lost += len(said)
                    chars += len(text)
                yield pa.RecordBatch.from_pydict(done, schema=arrow)
                done = {name: [] for name in arrow.names}
        if begun:
            close()
            yield pa.RecordBatch.from_pydict(done, schema=arrow)

    return rows.mapInArrow(run, kinds)


def op5_prefix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "\\### Assistant: </turn> ok"
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"),
    )
    return read_back(*prefix_forest(rows.unionByName(added)))


OP5_SQL = r"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
f as (
  select *, length('### : </turn>') + 1 + length(regexp_replace(role, '(\\|### |</turn>|: )', '\\\1', 'g'))
    + length(regexp_replace(text, '(\\|### |</turn>)', '\\\1', 'g')) as chars from c)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  sum(chars)::bigint as formatted_chars
from f group by conv_id
"""
