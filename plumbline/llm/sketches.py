"""Near-duplicate documents by SetSketch registers: bands for candidates, a joint likelihood, then the full sets."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import BLANKS, per_batch, small_batches, table, text_bytes, whole_groups
from plumbline.llm.components import connected_components
from plumbline.sources.staging import materialise

SHINGLE = 5
REGISTERS = 128
BAND = 4  # registers in a band: 32 bands find a pair at the threshold but for 5 in a million
BASE, RATE, TOP = 1.001, 20.0, 65_534
#: A pair goes on to the full sets if its estimate is at least the threshold less so many standard errors.
ERRORS = 5.0
#: Members of a bucket that are compared with each other in one piece of work.
BLOCK = 512
PERCENT = 75

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.isin(np.arange(256), list(BLANKS.encode()))
_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_FACTORS = _mix(np.arange(1, REGISTERS + 1, dtype=np.uint64) * _P) | np.uint64(1)


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of all texts, and the number of the first word of each text."""
    blank = _BLANK[raw]
    begins = ~blank
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    begins[1:] &= blank[:-1] | edge[1 : len(raw)]
    starts = np.flatnonzero(begins)
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), first
    number = np.cumsum(begins) - 1
    place = np.arange(len(raw)) - starts[np.maximum(number, 0)]
    longest = int(place[~blank].max()) + 1
    powers = np.cumprod(np.full(longest, _P, np.uint64))
    value = np.where(blank, np.uint64(0), (_LOWER[raw].astype(np.uint64) + np.uint64(1)) * powers[np.minimum(place, longest - 1)])
    return _mix(np.add.reduceat(value, starts)), first


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its five-word shingles; of fewer words, of the whole sequence."""
    raw, offsets = text_bytes(texts)
    words, first = word_hashes(raw, offsets)
    grams = np.zeros(max(0, len(words) - SHINGLE + 1), np.uint64)
    for j in range(SHINGLE):
        grams = grams * _Q + words[j : j + len(grams)]
    grams = _mix(grams)
    sets = []
    for begin, end in zip(first[:-1].tolist(), first[1:].tolist()):
        if end - begin >= SHINGLE:
            sets.append(np.unique(grams[begin : end - SHINGLE + 1]))
        elif end > begin:
            whole = np.array([end - begin], np.uint64) * _P
            for w in words[begin:end]:
                whole = whole * _Q + w
            sets.append(_mix(whole))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def registers(shingles: np.ndarray) -> np.ndarray:
    """The sketch of a set. Register i holds floor(1 - log_b x), x the least of exponential variables that hashing
    gives the elements. Sketches merge by the larger value of each register."""
    least = np.full(REGISTERS, _ALL)
    for i in range(0, len(shingles), 512):
        np.minimum(least, (shingles[i : i + 512, None] * _FACTORS).min(0), out=least)
    uniform = ((least >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
    exponential = -np.log1p(-uniform) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / math.log(BASE)), 0, TOP + 1).astype(np.uint16)


def estimate(n_a: np.ndarray, n_b: np.ndarray, above: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Jaccard similarity of greatest likelihood, given set sizes and in how many registers a is above or below b.

    A register of a is above b's with probability p(u - vJ) and below with p(v - uJ), u and v the sizes' shares and
    p(x) = -log_b(1 - x (b - 1) / b). The likelihood is concave in J; its slope is bisected.
    """
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    equal = REGISTERS - above - below
    rate, log_b = (BASE - 1) / BASE, math.log(BASE)
    lo, hi = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(30):
        j = (lo + hi) / 2
        x, y = u - v * j, v - u * j
        p, q = -np.log1p(-x * rate) / log_b, -np.log1p(-y * rate) / log_b
        dp, dq = rate / log_b / (1 - x * rate), rate / log_b / (1 - y * rate)
        with np.errstate(divide="ignore", invalid="ignore"):
            slope = equal * (v * dp + u * dq) / (1 - p - q)
            slope = slope - np.where(above > 0, above * v * dp / p, 0) - np.where(below > 0, below * u * dq / q, 0)
        lo, hi = np.where(slope > 0, j, lo), np.where(slope > 0, hi, j)
    return (lo + hi) / 2


def least_estimate(percent: int = PERCENT) -> float:
    j = percent / 100
    return j - ERRORS * math.sqrt(j * (1 - j) / REGISTERS)


def sketch(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``set_id`` (digest of the whole set) and ``sketch`` (the registers) of whole texts."""

    def run(batch):
        sets = shingle_sets(batch.column("text"))
        return {
            "doc_id": batch.column("doc_id"), "n_shingles": [len(s) for s in sets],
            "set_id": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets],
            "sketch": [registers(s).tobytes() if len(s) else None for s in sets],
        }

    return per_batch(documents.select("doc_id", "text"), run, "doc_id bigint, n_shingles bigint, set_id binary, sketch binary")


def meetings(sets: DataFrame) -> DataFrame:
    """Members of buckets that hold several: ``id``, ``band``, ``bucket``, its size ``n`` and its ``centre``.

    A bucket is one band's register values. Its centre is the member that meets most others over all its buckets, so
    that the buckets of a crowd of near copies share the centre that is nearest to all of them.
    """
    at = F.explode(F.sequence(F.lit(0), F.lit(REGISTERS // BAND - 1)))
    bands = sets.select("id", "sketch", at.alias("band")).select(
        "id", "band", F.xxhash64("band", F.expr(f"substring(sketch, band * {2 * BAND} + 1, {2 * BAND})")).alias("bucket")
    )
    sizes = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met, _ = materialise(bands.join(sizes, "bucket"))
    scores = met.groupBy("id").agg(F.sum("n").alias("score"))
    best = met.join(scores, "id").groupBy("bucket").agg(F.max(F.struct("score", (-F.col("id")).alias("id"))).alias("best"))
    return materialise(met.join(best.select("bucket", (-F.col("best.id")).alias("centre")), "bucket"))[0]


def star_candidates(met: DataFrame) -> DataFrame:
    """Each member of a bucket with the bucket's centre: as many pairs as members at most."""
    pair = [F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")]
    return met.where("id <> centre").select(*pair).distinct()


def _passing(x: int, others: np.ndarray, n: np.ndarray, k: np.ndarray, band: int, percent: int) -> np.ndarray:
    """Of ``others`` those that x may be similar to and that it meets in ``band`` first."""
    others = others[100 * np.minimum(n[others], n[x]) >= percent * np.maximum(n[others], n[x])]
    same = (k[others].reshape(-1, REGISTERS // BAND, BAND) == k[x].reshape(-1, BAND)).all(2)
    others = others[same.argmax(1) == band]
    if not len(others):
        return others
    above, below = (k[x] > k[others]).sum(1), (k[x] < k[others]).sum(1)
    return others[estimate(np.full(len(others), float(n[x])), n[others].astype(float), above, below) >= least_estimate(percent)]


def _shared(x: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many elements the sorted set x shares with each of the others."""
    joined = np.concatenate(others)
    at = np.minimum(np.searchsorted(x, joined), len(x) - 1)
    begins = np.cumsum([0, *map(len, others)])[:-1]
    return np.add.reduceat((x[at] == joined).astype(np.int64), begins)


_UNIT = ["bucket", "i", "j"]
#: Rows of pieces of work in a task, about: four pieces of two full blocks.
UNIT_ROWS = 4096


def block_links(met: DataFrame, sets: DataFrame, labels: DataFrame, documents: DataFrame, percent: int, block: int) -> DataFrame:
    """Links between components that meet in a bucket, as many as it takes to join them.

    Only buckets whose members besides the centre (which has been tried against all) are still in several components
    count. The members of a bucket's largest component are never compared with one another: they are split into blocks
    that meet the blocks of the other members, which also meet each other. So a bucket of a million near copies and a
    stray sends each copy once. A piece of work holds two blocks of a bucket. It first finds by the registers which
    members have any likely partner of another component. Their full sets are fetched, pairs are verified in memory,
    each in the first bucket that it meets in, and a link is returned when it joins two components.
    """
    named = met.where("id <> centre").join(labels, "id", "left").withColumn("label", F.coalesce("component", "id"))
    sizes = named.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    open_ = sizes.groupBy("bucket").agg(
        F.sum("n").alias("n"), F.max(F.struct("n", F.negative("label").alias("label"))).alias("most"), F.count(F.lit(1)).alias("components")
    ).where("components > 1")
    parts = lambda n: F.ceil(n / block).cast("int")
    others, largest = F.col("n") - F.col("most.n"), F.col("most.n")
    open_, counted = materialise(
        open_.select("bucket", F.negative("most.label").alias("largest"), parts(others).alias("p"), parts(largest).alias("q"), "n", "most"),
        rows=F.coalesce(F.sum(others * (F.col("p") + F.col("q")) + largest * F.col("p")), F.lit(0)),
    )
    members = named.join(open_.select("bucket", "largest", "p", "q"), "bucket")
    in_largest, spread = F.col("label") == F.col("largest"), F.xxhash64("id")
    part = F.when(in_largest, F.col("p") + F.pmod(spread, F.col("q"))).otherwise(F.pmod(spread, F.col("p"))).cast("int")
    meets = F.col("p") + F.when(in_largest, 0).otherwise(F.col("q")) - 1
    members = members.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), meets)))
    work = members.select(
        "bucket", "band", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "id", "label"
    ).join(sets.select("id", "n_shingles", "sketch"), "id")

    def by_unit(rows: DataFrame, n: int) -> DataFrame:
        return rows.repartition(1 + n // UNIT_ROWS, *_UNIT).sortWithinPartitions(*_UNIT, "id")

    def pieces(batches):
        for batch, cuts in whole_groups(batches, _UNIT):
            ids, label, n, part, band, i, j = (batch.column(c).to_numpy() for c in ("id", "label", "n_shingles", "part", "band", "i", "j"))
            k = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint16).reshape(-1, REGISTERS)
            for a, b in zip(cuts, cuts[1:]):
                if b - a > 1 and (label[a:b] != label[a]).any():
                    left, right = a + np.flatnonzero(part[a:b] == i[a]), a + np.flatnonzero(part[a:b] == j[a])
                    yield batch, left, right, i[a] == j[a], ids, label, n, k, int(band[a])

    def hopeful(batches):
        for batch, left, right, alike, ids, label, n, k, band in pieces(batches):
            used = np.zeros(batch.num_rows, bool)
            for x in left:
                others = right[(label[right] != label[x]) & (right > x if alike else True)]
                others = _passing(x, others, n, k, band, percent)
                used[others] = True
                used[x] |= len(others) > 0
            yield batch.filter(pa.array(used))

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in work.schema)
    chosen, kept = materialise(by_unit(work, counted["rows"]).mapInArrow(hopeful, kinds), n=F.count(F.lit(1)))
    full = full_sets(chosen.select("id").distinct(), documents)

    def verified(batches):
        for batch, left, right, alike, ids, label, n, k, band in pieces(batches):
            shingles = [np.frombuffer(v.as_buffer(), np.uint64) for v in batch.column("shingles")]
            label = label.copy()
            found = []
            for x in left:
                others = _passing(x, right[(label[right] != label[x]) & (right > x if alike else True)], n, k, band, percent)
                if not len(others):
                    continue
                shared = _shared(shingles[x], [shingles[y] for y in others])
                for y in others[100 * shared >= percent * (n[x] + n[others] - shared)]:
                    if label[y] != label[x]:
                        found.append((ids[x], ids[y]))
                        label[label == label[y]] = label[x]
            found = np.array(found, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    return by_unit(chosen.join(full, "id"), kept["n"]).mapInArrow(verified, "a bigint, b bigint")


def likely(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose registers make the similarity likely."""
    side = lambda x: sets.select(F.col("id").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("sketch").alias(f"k_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").where(
        F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    )
    least = least_estimate(percent)

    def run(batches):
        for batch in batches:
            n_a, n_b = (batch.column(c).to_numpy().astype(float) for c in ("n_a", "n_b"))
            k_a, k_b = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in ("k_a", "k_b")
            )
            near = estimate(n_a, n_b, (k_a > k_b).sum(1), (k_a < k_b).sum(1)) >= least
            yield batch.select(["a", "b"]).filter(pa.array(near))

    return both.select("a", "b", "n_a", "n_b", "k_a", "k_b").mapInArrow(run, "a bigint, b bigint")


def full_sets(ids: DataFrame, documents: DataFrame) -> DataFrame:
    """``id`` and ``shingles`` (the whole set, sorted) of the documents named."""
    texts = documents.select(F.col("doc_id").alias("id"), "text").join(ids, "id", "left_semi")

    def run(batch):
        return {"id": batch.column("id"), "shingles": [s.tobytes() for s in shingle_sets(batch.column("text"))]}

    return materialise(per_batch(texts, run, "id bigint, shingles binary"))[0]


def verify(pairs: DataFrame, documents: DataFrame, percent: int) -> DataFrame:
    """Pairs linked by their full sets. Only documents in a pair send their sets on."""
    pairs, _ = materialise(pairs)
    full = full_sets(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), documents)
    both = pairs.join(full.select(F.col("id").alias("a"), F.col("shingles").alias("s_a")), "a").join(
        full.select(F.col("id").alias("b"), F.col("shingles").alias("s_b")), "b"
    )

    def run(batches):
        for batch in batches:
            for part in small_batches(iter([batch]), "s_a"):
                same = []
                for x, y in zip(part.column("s_a"), part.column("s_b")):
                    x, y = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    same.append(100 * shared >= percent * (len(x) + len(y) - shared))
                yield part.select(["a", "b"]).filter(pa.array(same, pa.bool_()))

    return both.select("a", "b", "s_a", "s_b").mapInArrow(run, "a bigint, b bigint").distinct()


def near_duplicates(documents: DataFrame, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id`` (the smallest doc_id that links reach) and
    ``kept`` (it is that smallest one). Documents are linked if 100 times the shared shingles are at least ``percent``
    times those of both.

    Documents of equal sets are one class, known by its smallest doc_id. Classes meet in buckets, one per band of
    register values. First each member is tried against its bucket's centre; whatever that leaves in several components
    is compared within the bucket, block by block, in memory. Candidates pass a joint likelihood estimate and are then
    confirmed on full sets. So a bucket of any size returns no more links than it has members, and no link between
    different components is lost but by the bands (5 in a million at the threshold) or the estimate (fewer).

    Texts without words, null texts and null ids are linked with nothing; a null id is kept, with a null component.
    Rows that repeat an id are one document: they share its verdict. No rows give no rows. Other columns are left out.
    """
    rows, _ = materialise(sketch(documents))
    known = rows.where("n_shingles > 0 and doc_id is not null")
    sets, _ = materialise(known.groupBy("set_id").agg(
        F.min("doc_id").alias("id"), F.any_value("n_shingles").alias("n_shingles"), F.any_value("sketch").alias("sketch")
    ))
    # an id that repeats with different texts stands for each of its sets
    met = meetings(sets)
    first, _ = materialise(verify(likely(star_candidates(met), sets, percent), documents, percent))
    labels = connected_components(first)
    more, found = materialise(block_links(met, sets, labels, documents, percent, block), n=F.count(F.lit(1)))
    if found["n"]:
        labels = connected_components(first.unionByName(more))
    classes = sets.select("set_id", "id").join(labels, "id", "left").select(
        F.col("set_id").alias("_llm_set"), F.coalesce("component", "id").alias("_llm_component")
    )
    linked = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    joined = rows.join(classes, (F.col("set_id") == F.col("_llm_set")) & linked, "left")
    component = F.when(linked, F.col("_llm_component")).otherwise(F.col("doc_id"))
    return joined.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def op2_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP2_SQL = r"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w from documents),
s as materialized (
  select distinct doc_id, g from (
    select doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
      else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) end) as g from d)),
n as materialized (select doc_id, count(*) as n from s group by 1),
c as (select a.doc_id as a, b.doc_id as b, count(*) as shared from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
l as materialized (
  select a, b from c join n x on x.doc_id = a join n y on y.doc_id = b where 100 * shared >= 75 * (x.n + y.n - shared)),
e as materialized (select a, b from l union select b, a from l),
r(id, reach) as (select a, a from e union select r.id, e.b from r join e on e.a = r.reach),
k as (select id, min(reach) as component from r group by 1)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, coalesce(k.component, d.doc_id) as component_id,
  coalesce(k.component, d.doc_id) = d.doc_id as kept
from d left join n using (doc_id) left join k on k.id = d.doc_id
"""
