"""Phrases by set-oriented mining: occurrence relations, joined at adjacent places, counted, and cut to frequent groups."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.common import ascii_lower, per_batch, small_batches, table, text_bytes, to_arrow_schema
from plumbline.operators.numbering import assign_ids
from plumbline.sources.staging import materialise, scratch_path

LEAST = 30  # occurrences of a candidate
LONGEST = 4  # words
CONTAINED = 80  # percent of a phrase's occurrences inside one longer candidate that drop it
BEST = 2000  # phrases of a language
NO_LANG = "und"
#: Frequent groups up to this size are looked up in sorted arrays that are broadcast; beyond it by a shuffle of the
#: occurrences. A broadcast has about ``PART`` bytes, and a worker holds one at a time.
MOST_BROADCAST = 512 << 20
PART = 32 << 20
#: Items that are paired, counted or looked up at once.
PAIRS = 1 << 21
#: Pairs that a task folds before they are dealt out, and pairs of a bucket.
HELD = 1 << 22
BUCKET = 1 << 19
#: Buckets that a task folds, one after the other; the hash of Spark's shuffle deals several more evenly than one.
BUCKETS_A_TASK = 4
#: Items of a row of a relation, if no gapless run is longer.
ROW = 512
#: The first cut of a language's best phrases works in so many parts.
RANK_PARTS = 64
ITEMS = "items binary"
_GAP = -1
#: Per byte, its lower case (A-Z), and 0 within words, 1 for blanks, 2 for ends of pieces.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, np.uint8)
_KIND[list(b" \t")] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2
_FACTORS = np.random.default_rng(11).integers(1, 1 << 63, 1 << 12, np.uint64)


def word_occurrences(documents: DataFrame) -> DataFrame:
    """``lang``, ``text_no``, ``pos``, ``word``: a row per word, in the order of the texts. Words of one piece have
    successive places; between two pieces one is left out."""
    pieces = F.regexp_replace(ascii_lower(F.coalesce("text", F.lit(""))), r"[.,;:!?\x0A-\x0D]+", " \n ")
    texts = documents.select(
        F.coalesce(F.col("lang"), F.lit(NO_LANG)).alias("lang"), F.monotonically_increasing_id().alias("text_no"),
        F.split(pieces, r"[\x20\x09]+").alias("words"),
    )
    words = texts.select("lang", "text_no", F.posexplode("words").alias("pos", "word"))
    return words.where("word <> '' and word <> '\n'")


def words_of(batch: pa.RecordBatch) -> tuple[pa.Array, pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The words of a batch of texts, cut as ``word_occurrences`` does: the different ones (languages and words), how
    often each occurs, and per occurrence its number among them and whether it is the first word of a piece."""
    raw, offsets = text_bytes(batch.column("text"))
    kind = _KIND[raw]
    inner = kind == 0
    begins, ends = inner.copy(), inner.copy()
    begins[1:] &= ~inner[:-1]
    ends[:-1] &= ~inner[1:]
    full = offsets[:-1] < offsets[1:]
    first, last = offsets[:-1][full], offsets[1:][full] - 1
    begins[first], ends[last] = inner[first], inner[last]
    starts = np.flatnonzero(begins)
    lengths = np.flatnonzero(ends) + 1 - starts
    text = np.searchsorted(offsets, starts, side="right") - 1
    stops = np.cumsum(kind == 2, dtype=np.int32)[starts]
    opens = np.ones(len(starts), bool)
    opens[1:] = (text[1:] != text[:-1]) | (stops[1:] != stops[:-1])

    places = pa.py_buffer(np.append(0, np.cumsum(lengths)).astype(np.int64))
    words = pa.Array.from_buffers(pa.large_string(), len(starts), [None, places, pa.py_buffer(_LOWER[raw[inner]])])
    words = words.dictionary_encode()
    langs = pa.compute.fill_null(batch.column("lang"), NO_LANG).dictionary_encode()
    n = len(words.dictionary)
    codes = langs.indices.to_numpy()[text].astype(np.int64) * n + words.indices.to_numpy()
    size = len(langs.dictionary) * n
    if size > 8 * len(codes):
        found, numbers, counts = np.unique(codes, return_inverse=True, return_counts=True)
    else:
        counts = np.bincount(codes, minlength=size)
        found = np.flatnonzero(counts)
        counts, place = counts[found], np.zeros(size, np.int64)
        place[found] = np.arange(len(found))
        numbers = place[codes]
    of, word = np.divmod(found, max(n, 1))
    return langs.dictionary.take(pa.array(of)), words.dictionary.take(pa.array(word)).cast(pa.string()), counts, numbers, opens


def word_counts(documents: DataFrame) -> DataFrame:
    """``lang``, ``word``, ``a``: the words of ``documents`` (``lang``, ``text``), counted for some texts at a time."""

    def count(batch: pa.RecordBatch) -> dict:
        langs, words, counts, _, _ = words_of(batch)
        return {"lang": langs, "word": words, "a": counts}

    return per_batch(documents, count, "lang string, word string, a bigint")


def word_hashes(langs: pa.Array, words: pa.Array) -> np.ndarray:
    """A hash per word, sums of its bytes by place; what has the same one is compared by who looks it up."""
    raw, offsets = text_bytes(words)
    place = np.arange(len(raw)) - np.repeat(offsets[:-1], np.diff(offsets))
    hashes = np.add.reduceat(raw * _FACTORS[place % len(_FACTORS)], offsets[:-1]) if len(words) else np.zeros(0, np.uint64)
    langs = langs.dictionary_encode()
    seeds = [xxhash.xxh64_intdigest(lang) for lang in langs.dictionary.cast(pa.binary()).to_pylist()]
    return hashes + np.array(seeds, np.uint64)[langs.indices.to_numpy()]


def _parts(frequent: DataFrame, columns: list[str], n: int, size: int, pack: Callable[..., tuple]) -> list[Broadcast]:
    """``pack(columns of rows)`` for the rows of ``frequent``, numbered 1 to ``n``, in broadcasts of about ``PART`` of
    their ``size`` bytes. The driver holds one at a time."""
    step = max(1, n * PART // max(size, 1))
    parts = []
    for low in range(0, n, step):
        rows = frequent.where(F.col("id").between(low + 1, low + step)).select("id", *columns).toArrow()
        parts.append(frequent.sparkSession.sparkContext.broadcast(pack(*(rows.column(c).combine_chunks() for c in ("id", *columns)))))
    return parts


def _each(parts: list[Broadcast]) -> Iterator[tuple]:
    """The values of broadcasts; of several, a worker holds one at a time and reads the others from its disk again."""
    for part in parts:
        yield part.value
        if len(parts) > 1:
            del part._value


def pack_words(ids: pa.Array, langs: pa.Array, words: pa.Array) -> tuple:
    """Frequent words sorted by a hash."""
    hashes = word_hashes(langs, words)
    order = np.argsort(hashes, kind="stable")
    return hashes[order], ids.to_numpy()[order], langs.take(pa.array(order)), words.take(pa.array(order))


def find_words(part: tuple, hashes: np.ndarray, langs: pa.Array, words: pa.Array, found: np.ndarray) -> None:
    """Put the ids of words that ``part`` has into ``found``. Words with equal hashes are compared by their bytes."""
    keys, ids, its_langs, its_words = part
    left = np.arange(len(hashes))
    at = np.searchsorted(keys, hashes)
    while True:
        left = left[at[left] < len(keys)]
        left = left[keys[at[left]] == hashes[left]]
        if not len(left):
            return
        here, there = pa.array(left), pa.array(at[left])
        same = pa.compute.and_(
            pa.compute.equal(its_words.take(there), words.take(here)), pa.compute.equal(its_langs.take(there), langs.take(here))
        ).to_numpy(zero_copy_only=False)
        found[left[same]] = ids[at[left[same]]]
        left = left[~same]
        at[left] += 1


def pack_pairs(ids: pa.Array, x: pa.Array, y: pa.Array) -> tuple:
    """Frequent pairs, sorted."""
    keys = paired(x.to_numpy(), y.to_numpy())
    order = np.argsort(keys)
    return keys[order], ids.to_numpy()[order]


def find_pairs(part: tuple, keys: np.ndarray, found: np.ndarray) -> None:
    """Put the ids of pairs, in order, that ``part`` has into ``found``."""
    its, ids = part
    at = np.minimum(np.searchsorted(its, keys), len(its) - 1)
    same = its[at] == keys
    found[same] = ids[at[same]]


def paired(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Two ids in one number; ids are below 2^31, as that many frequent groups would need."""
    if len(x) and max(x.max(), y.max()) >> 31:
        raise ValueError("more than 2^31 frequent groups")
    return x << 32 | y


def _blobs(values: np.ndarray, offsets: np.ndarray | list[int]) -> pa.Array:
    """Binary values: the bytes of stretches of an array."""
    places = pa.py_buffer((np.asarray(offsets, np.int64) * values.itemsize).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, places, pa.py_buffer(np.ascontiguousarray(values))])


def _items(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The items of all rows of a batch of a relation, and where each row begins, with the end last."""
    values = batch.column("items").cast(pa.large_binary())
    _, places, data = values.buffers()
    offsets = np.frombuffer(places, np.int64)[values.offset : values.offset + len(values) + 1] if len(values) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw.view(np.int32).astype(np.int64), (offsets - offsets[0]) // 4


def _rows(items: np.ndarray, arrow: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows of about ``ROW`` items, cut at gaps only. Items that have no neighbour go: they are in no pair."""
    solid = items != _GAP
    beside = np.zeros(len(items), bool)
    beside[1:] = solid[:-1]
    beside[:-1] |= solid[1:]
    kept = np.flatnonzero(solid & beside)
    if not len(kept):
        return
    gaps = np.flatnonzero(np.diff(kept) != 1) + 1
    runs = np.append(0, gaps + np.arange(1, len(gaps) + 1))  # where each run of items begins
    runs = runs[np.append(True, np.diff(runs // ROW) > 0)]
    items = np.insert(items[kept], gaps, _GAP)
    yield pa.RecordBatch.from_arrays([_blobs(items.astype(np.int32), np.append(runs, len(items)))], schema=arrow)


def word_relation(documents: DataFrame, parts: list[Broadcast]) -> DataFrame:
    """The sorted occurrence relation of frequent words, which are looked up in ``parts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            langs, words, _, numbers, opens = words_of(batch)
            hashes, found = word_hashes(langs, words), np.full(len(words), _GAP)
            for part in _each(parts):
                find_words(part, hashes, langs, words, found)
            yield from _rows(np.insert(found[numbers], np.flatnonzero(opens), _GAP), arrow)

    arrow = to_arrow_schema(ITEMS)
    return _stored(documents.mapInArrow(run, ITEMS), parts)


def neighbours(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The items of some rows, ``PAIRS`` at a time: each with the next one, and where both are items of one row."""
    items, offsets = _items(batch)
    both = np.zeros(len(items), bool)
    both[:-1] = (items[:-1] != _GAP) & (items[1:] != _GAP)
    both[offsets[1:][offsets[1:] > 0] - 1] = False
    after = np.append(items[1:], _GAP)
    for low in range(0, len(items), PAIRS):
        yield items[low : low + PAIRS], after[low : low + PAIRS], both[low : low + PAIRS]


def _folded(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, and the sum of the counts of each."""
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    begins = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[begins], np.add.reduceat(counts, begins) if len(begins) else counts


def pair_counts(occurred: DataFrame, least: int) -> DataFrame:
    """The merge-join of a sorted relation with itself at the next place, counted: ``x``, ``y`` and ``a`` of the pairs
    with ``least`` occurrences.

    A task folds its pairs and deals them, by a hash, to buckets of at most about ``BUCKET`` pairs; a row is the pairs
    of one task and bucket. One task folds a bucket, and holds one at a time.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def dealt() -> Iterator[pa.RecordBatch]:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            bucket = ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            sizes = np.bincount(bucket, minlength=buckets)
            some = np.flatnonzero(sizes)
            offsets = np.append(0, np.cumsum(sizes[some]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(some.astype(np.int32)), _blobs(keys[order], offsets), _blobs(counts[order].astype(np.int32), offsets)], schema=arrow
            )

        held, n = [], 0
        for batch in batches:
            for x, y, both in neighbours(batch):
                held.append(paired(x[both], y[both]))
                n += len(held[-1])
                if n >= HELD:
                    yield from dealt()
                    held, n = [], 0
        if n:
            yield from dealt()

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def folded() -> Iterator[pa.RecordBatch]:
            keys, counts = _folded(np.concatenate(keys_held), np.concatenate(counts_held).astype(np.int64))
            keys, counts = keys[counts >= least], counts[counts >= least]
            yield pa.RecordBatch.from_arrays([pa.array(keys >> 32), pa.array(keys & 0xFFFFFFFF), pa.array(counts)], schema=result)

        last, keys_held, counts_held = -1, [], []
        for batch in batches:
            for i, bucket in enumerate(batch.column("bucket").to_pylist()):
                if bucket != last and keys_held:
                    yield from folded()
                    keys_held, counts_held = [], []
                last = bucket
                keys_held.append(np.frombuffer(batch.column("keys")[i].as_buffer(), np.int64).copy())
                counts_held.append(np.frombuffer(batch.column("counts")[i].as_buffer(), np.int32).copy())
        if keys_held:
            yield from folded()

    size = occurred.agg(F.sum(F.octet_length("items"))).first()[0] or 0
    buckets = size // 4 // BUCKET + 1
    schema, counted = "bucket int, keys binary, counts binary", "x bigint, y bigint, a bigint"
    arrow, result = to_arrow_schema(schema), to_arrow_schema(counted)
    return occurred.mapInArrow(deal, schema).repartition(buckets // BUCKETS_A_TASK + 1, "bucket").sortWithinPartitions("bucket").mapInArrow(fold, counted)


def pair_relation(occurred: DataFrame, parts: list[Broadcast]) -> DataFrame:
    """The sorted occurrence relation of frequent pairs, which are looked up in ``parts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for x, y, both in neighbours(batch):
                ids, keys = np.full(len(x), _GAP), paired(x[both], y[both])
                order = np.argsort(keys)  # in order, neighbours are found near one another
                keys, of = keys[order], np.full(len(keys), _GAP)
                for part in _each(parts):
                    find_pairs(part, keys, of)
                ids[np.flatnonzero(both)[order]] = of
                found.append(ids)
            if found:
                yield from _rows(np.concatenate(found), arrow)

    arrow = to_arrow_schema(ITEMS)
    return _stored(occurred.mapInArrow(run, ITEMS), parts)


def relation(occurrences: DataFrame) -> DataFrame:
    """A sorted occurrence relation, persisted: a row per text, ``items`` (4 bytes each) by place, ``_GAP`` where a place
    has none.

    ``occurrences`` (``text_no``, ``pos``, ``id``) come sorted within each task, whole texts to a task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text, last, held = -1, 0, []

        def closed(items: np.ndarray, offsets: list[int]) -> pa.RecordBatch:
            if len(items) and items.max() >> 31:
                raise ValueError("more than 2^31 frequent groups")
            return pa.RecordBatch.from_arrays([_blobs(items.astype(np.int32), offsets)], schema=arrow)

        for batch in batches:
            if not batch.num_rows:
                continue
            no, pos, ids = (batch.column(c).to_numpy() for c in ("text_no", "pos", "id"))
            before, place = np.append(text, no[:-1]), np.append(last, pos[:-1])
            if (no < before).any() or ((no == before) & (pos <= place)).any():
                raise ValueError("occurrences are out of order")
            begins = no != before
            gaps = np.flatnonzero(~begins & (pos != place + 1))
            starts = np.flatnonzero(begins)
            items, starts = np.insert(ids, gaps, _GAP), starts + np.searchsorted(gaps, starts)
            text, last = no[-1], pos[-1]
            if not len(starts):
                held.append(items)
                continue
            rest = np.concatenate([*held, items[: starts[0]]])
            if len(rest):
                yield closed(rest, [0, len(rest)])
            if len(starts) > 1:
                yield closed(items[starts[0] : starts[-1]], (starts - starts[0]).tolist())
            held = [items[starts[-1] :]]
        if held:
            rest = np.concatenate(held)
            yield closed(rest, [0, len(rest)])

    arrow = to_arrow_schema(ITEMS)
    return _stored(occurrences.select("text_no", "pos", "id").mapInArrow(run, ITEMS))


def adjacent(occurred: DataFrame) -> DataFrame:
    """The merge-join of a sorted relation with itself at the next place: ``text_no``, ``pos``, ``x`` and ``y``.

    Both sides have the same order, so the join is one walk over each text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, offsets = _items(batch)
            first, last = int(offsets[0]), int(offsets[-1])
            numbers = batch.column("text_no").to_numpy()
            for low in range(first, max(first, last - 1), PAIRS):
                x, y = items[low : min(low + PAIRS, last - 1)], items[low + 1 : min(low + PAIRS, last - 1) + 1]
                at = np.flatnonzero((x != _GAP) & (y != _GAP)) + low
                row = np.searchsorted(offsets, at, side="right") - 1
                inside = at + 1 < offsets[row + 1]
                at, row = at[inside], row[inside]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(numbers[row]), pa.array((at - offsets[row]).astype(np.int32)), pa.array(items[at]), pa.array(items[at + 1])], schema=arrow
                )

    schema = "text_no bigint, pos int, x bigint, y bigint"
    arrow = to_arrow_schema(schema)
    return occurred.select(F.monotonically_increasing_id().alias("text_no"), "items").mapInArrow(run, schema)


def _stored(df: DataFrame, parts: Iterable[Broadcast] = ()) -> DataFrame:
    """``df`` written and read; the broadcasts that it needed go."""
    path = scratch_path(df.sparkSession, "phrases")
    df.write.option("compression", "zstd").parquet(path)
    for part in parts:
        part.destroy()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _shuffled(occurrences: DataFrame, frequent: DataFrame, keys: list[str]) -> DataFrame:
    """Occurrences of frequent groups with the group's ``id``, joined by a shuffle, in the order of the texts."""
    joined = occurrences.join(frequent.select("id", *keys), keys).select("text_no", "pos", "id")
    return joined.repartition("text_no").sortWithinPartitions("text_no", "pos")


def frequent_phrases(documents: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[list[DataFrame], DataFrame]:
    """Per length, phrases with ``least`` occurrences: ``id``, ``a`` (occurrences) and, for words, ``lang`` and
    ``word``, for longer ones ``x`` and ``y``, the ids of the phrases without the last and without the first word; and
    the words of each ``lang``: ``n``.

    One length at a time: the relation of occurrences is joined with itself at the next place, the pairs are counted,
    and only occurrences of frequent pairs make the next relation.
    """
    documents = documents.select("lang", "text")
    counted = word_counts(documents).groupBy("lang", "word").agg(F.sum("a").alias("a"))
    # rare words fold into one row per language, which keeps the total
    counted = counted.groupBy("lang", F.when(F.col("a") >= least, F.col("word")).alias("word")).agg(F.sum("a").alias("a"))
    counted, measured = materialise(counted, n=F.count("word"), size=F.sum(F.octet_length("word") + F.octet_length("lang") + 32))
    totals = counted.groupBy("lang").agg(F.sum("a").alias("n"))
    frequent, _ = materialise(assign_ids(counted.where("word is not null"), "id", 0, ["lang", "word"]))
    levels = [frequent]
    n, size = measured["n"], measured["size"] or 0
    if size <= MOST_BROADCAST:
        occurred = word_relation(documents, _parts(frequent, ["lang", "word"], n, size, pack_words))
    else:
        occurred = relation(_shuffled(word_occurrences(documents), frequent, ["lang", "word"]))
    for length in range(2, longest + 1):
        counted, measured = materialise(pair_counts(occurred, least), n=F.count(F.lit(1)))
        frequent, _ = materialise(assign_ids(counted, "id", 0, ["x", "y"]))
        levels.append(frequent)
        if length == longest:
            break
        n = measured["n"]
        if 16 * n <= MOST_BROADCAST:
            occurred = pair_relation(occurred, _parts(frequent, ["x", "y"], n, 16 * n, pack_pairs))
        else:
            occurred = relation(_shuffled(adjacent(occurred), frequent, ["x", "y"]))
    return levels, totals


def mine_phrases(
    documents: DataFrame, least: int = LEAST, longest: int = LONGEST, contained: int = CONTAINED, best: int = BEST
) -> DataFrame:
    """The ``best`` phrases of 2 to ``longest`` words of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``,
    ``r``, ``n``, ``score``.

    Texts are lower-cased (A-Z) and split into pieces at punctuation and line ends; a phrase is a run of words of one
    piece, all its occurrences count, within a language. Its score is the lowest of its cuts', exact in decimals of 38
    digits; the first of equal cuts counts. A phrase goes if ``contained`` percent of its occurrences lie in one longer
    candidate: the longest such share is that of a phrase with one word more, as a still longer one is rarer.

    Words and phrases are numbered level by level; a relation is rows of numbers in the order of the texts. Texts are cut
    and words and pairs counted in arrays, some texts at a time; what leaves a task is folded, so a word pair that fills a
    third of the table is a few entries. Frequent groups are looked up in sorted arrays, broadcast in parts, up to
    ``MOST_BROADCAST`` bytes, by a shuffle of the occurrences beyond. Ranks are cut per part of a language before they are
    cut per language.

    Null texts are empty, null languages are ``und``. Repeated rows count each. No phrases: no rows. Other columns are
    left out. A text and its words' numbers are held by one task.
    """
    levels, totals = frequent_phrases(documents, least, longest)
    known = levels[0].select(
        "id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), F.array("a").alias("heads"), F.array("a").alias("tails")
    )
    candidates, longer = [], []
    for length, found in enumerate(levels[1:], 2):
        x = known.select(F.col("id").alias("x"), "lang", "phrase", "heads")
        y = known.select(F.col("id").alias("y"), "last", "tails")
        known = found.join(x, "x").join(y, "y").select(
            "id", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last", "a",
            F.concat("heads", F.array("a")).alias("heads"), F.concat("tails", F.array("a")).alias("tails"),
        )
        if length < len(levels):
            known, _ = materialise(known)  # read by the next length too
        candidates.append(known)
        longer.append(found.select(F.explode(F.array("x", "y")).alias("id"), "a").groupBy("id").agg(F.max("a").alias("inside")))

    scored = None
    for length, rows in enumerate(candidates, 2):
        cuts = [
            F.struct(
                F.expr(f"(cast(2000000 as decimal(38,0)) * a) div (cast(heads[{k - 1}] as decimal(38,0)) + tails[{length - k - 1}])").alias("score"),
                F.lit(k).alias("k"), F.expr(f"heads[{k - 1}]").alias("l"), F.expr(f"tails[{length - k - 1}]").alias("r"),
            )
            for k in range(1, length)
        ]
        rows = rows.withColumn("cut", F.array_min(F.array(*cuts)))
        if length - 1 < len(longer):
            rows = rows.join(longer[length - 1], "id", "left").where(
                f"inside is null or cast(100 as decimal(38,0)) * inside < cast({contained} as decimal(38,0)) * a"
            )
        rows = rows.select("lang", "phrase", "a", "cut.l", "cut.r", F.col("cut.score").cast("long").alias("score"))
        scored = rows if scored is None else scored.unionByName(rows)

    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    first = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).where(F.col("rank") <= best)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= best)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_setm_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_phrases(table(spark, sf_dir, "documents").select("lang", "text"))


OP11_SQL = f"""
with d as (
  select row_number() over () as d, coalesce(lang, '{NO_LANG}') as lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
p as (select d, lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) as piece from d),
w as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from p),
g as (
  select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase, w[i:i + k - 1] as words
  from (select lang, w, unnest(range(1, len(w) + 1)) as i from w), (select unnest([1, 2, 3, 4]) as k) where i + k - 1 <= len(w)),
f as materialized (select lang, k, phrase, any_value(words) as words, count(*) as a from g group by all),
n as (select lang, sum(a)::bigint as n from f where k = 1 group by 1),
c as materialized (select * from f where k >= 2 and a >= {LEAST}),
cut as (
  select c.lang, c.k, c.phrase, c.a, j, array_to_string(c.words[1:j], ' ') as head, array_to_string(c.words[j + 1:], ' ') as tail
  from c, (select unnest([1, 2, 3]) as j) where j < c.k),
s as (
  select cut.lang, cut.k, cut.phrase, cut.a, j, h.a as l, t.a as r, (2000000::hugeint * cut.a) // (h.a + t.a) as score
  from cut join f h on h.lang = cut.lang and h.phrase = cut.head and h.k = j
  join f t on t.lang = cut.lang and t.phrase = cut.tail and t.k = cut.k - j),
b as (select * from s qualify row_number() over (partition by lang, phrase order by score, j) = 1),
o as (
  select c.lang, array_to_string(c.words[i:i + m - 1], ' ') as phrase, max(c.a) as longest
  from c, (select unnest([1, 2, 3]) as i), (select unnest([2, 3]) as m) where m < c.k and i + m - 1 <= c.k group by all),
k as (
  select b.* from b left join o on o.lang = b.lang and o.phrase = b.phrase where o.longest is null or 100 * o.longest < {CONTAINED} * b.a)
select k.lang, row_number() over (partition by k.lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n.n, score::bigint as score
from k join n on n.lang = k.lang qualify rank <= {BEST}
"""
