"""Exact removal of long repeated strings: content-defined shards, suffix arrays by induced sorting, permuted prefixes."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import per_batch, small_batches, table, text_bytes, to_arrow_schema
from plumbline.sources.staging import materialise, scratch_path

LENGTH = 400  # bytes of a repeated string
GRAM = 32  # bytes of an anchor
#: Bytes that a suffix array is built over, about; and distinct surroundings of one anchor beyond which they are split.
SHARD_BYTES = 1 << 20
HOT = 6000
#: Stretches a task holds before it hands them on.
MOST_HELD = 100_000
#: Repeated anchors (8 bytes each) up to this many are looked up by a broadcast, more by a shuffle.
MOST_BROADCAST = 1_000_000
_PLACE_BITS = 30
_SEED = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes (a power of two) from each place on; as many as fit."""
    value, width, factor = raw.astype(np.uint64) + np.uint64(1), 1, _SEED
    while width < gram:
        value = value[:-width] * factor + value[width:]
        width *= 2
        with np.errstate(over="ignore"):
            factor = factor * factor
    return _mix(value)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of ``width`` values."""
    n = len(values)
    blocks = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    blocks[:n] = values
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchors(raw: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of all texts: their hashes, places and texts.

    In every string of ``length`` bytes within a text the gram with the least hash, the first of several, is an anchor.
    So equal strings have an anchor at the same place in them.
    """
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(raw) < length:
        return none
    hashes = gram_hashes(raw, gram)
    order = (hashes >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | np.arange(len(hashes), dtype=np.uint64)
    first = sliding_least(order, length - gram + 1) & np.uint64((1 << _PLACE_BITS) - 1)
    sizes = np.diff(offsets)
    starts = np.zeros(len(raw) + 1, np.int32)
    long = sizes >= length
    np.add.at(starts, offsets[:-1][long], 1)
    np.add.at(starts, offsets[1:][long] - length + 1, -1)
    places = np.unique(first[np.cumsum(starts[: len(first)]) > 0]).astype(np.int64)
    return hashes[places], places, np.searchsorted(offsets, places, side="right") - 1


def find_anchors(documents: DataFrame, length: int, gram: int) -> DataFrame:
    """A row per anchor: ``h``, its hash; ``around``, a digest of the bytes that any string of ``length`` bytes with the
    anchor may cover; ``key``, the text's digest; ``lo`` and ``hi``, the place of those bytes; ``at``, where in them the
    anchor is (-1 if in several places)."""
    reach = length - gram

    def run(batches):
        arrow = to_arrow_schema(kinds)
        for batch in small_batches(batches, "text", 1 << 20):
            raw, offsets = text_bytes(batch.column("text"))
            hashes, places, texts = anchors(raw, offsets, length, gram)
            lo = np.maximum(places - reach, offsets[:-1][texts]) if len(texts) else places
            hi = np.minimum(places + length, offsets[1:][texts]) if len(texts) else places
            at = places - lo
            if len(places):  # a gram that repeats within the same stretch counts once
                _, once, times = np.unique(np.column_stack([hashes.view(np.int64), lo, hi]), axis=0, return_index=True, return_counts=True)
                at[once[times > 1]] = -1
                once.sort()
                hashes, lo, hi, texts, at = hashes[once], lo[once], hi[once], texts[once], at[once]
            whole, last, key, keys = raw.tobytes(), -1, b"", []
            for t in texts.tolist():
                if t != last:
                    last, key = t, hashlib.md5(whole[offsets[t] : offsets[t + 1]]).digest()
                keys.append(key)
            around = [xxhash.xxh3_128_digest(whole[a:b]) for a, b in zip(lo.tolist(), hi.tolist())]
            base = offsets[:-1][texts] if len(texts) else places
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes.view(np.int64)), pa.array(around, pa.binary()), pa.array(keys, pa.binary()),
                 pa.array((lo - base).astype(np.int32)), pa.array((hi - base).astype(np.int32)), pa.array(at.astype(np.int32))], schema=arrow
            )

    kinds = "h bigint, around binary, key binary, lo int, hi int, at int"
    return documents.select("text").mapInArrow(run, kinds)


def _words(values: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as one number, the first byte lowest; zeros follow the end."""
    each = 8 // values.itemsize
    padded = np.append(values, np.zeros(2 * each, values.dtype)).astype(values.dtype.newbyteorder("<"), copy=False)
    out = np.empty(-(-len(values) // each) * each, np.uint64)
    for i in range(each):
        out[i::each] = padded[i : i + len(out)].view("<u8")
    return out[: len(values)]


def _stepwise_equal(text: np.ndarray, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether the strings of ``lengths`` (of 2-byte letters, 1 at least) from a and from b on are equal, four letters
    a step."""
    words = _words(text)
    equal, active, step = np.ones(len(a), bool), np.arange(len(a)), 0
    while len(active):
        unused = (16 * np.maximum(4 + step - lengths[active], 0)).astype(np.uint64)
        differ = (words[a[active] + step] ^ words[b[active] + step]) << unused != 0
        equal[active[differ]] = False
        active = active[~differ & (lengths[active] > step + 4)]
        step += 4
    return equal


def _induce(text: np.ndarray, smaller: np.ndarray, order: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All suffixes in order, induced from leftmost-smaller suffixes in ``order``.

    A bucket (suffixes of one first letter) is worked through in waves, each what the one before has added to it: the
    same sequence as one suffix at a time.
    """
    n, letters = len(text), len(counts)
    ends = np.cumsum(counts)
    starts = ends - counts
    out = np.full(n, -1, np.int32)
    seed = text[order]
    seeds = np.bincount(seed, minlength=letters)
    grouped = order[np.argsort(seed, kind="stable")]
    seed_at = np.concatenate([[0], np.cumsum(seeds)])

    head = starts.copy()

    def push_front(found: np.ndarray) -> None:
        before = found[found > 0] - 1
        before = before[~smaller[before]]
        first = text[before]
        by = np.argsort(first, kind="stable")
        many = np.bincount(first, minlength=letters)
        sorted_first = first[by]
        shift = head - (np.cumsum(many) - many)
        out[np.arange(len(by)) + shift[sorted_first]] = before[by]
        np.add(head, many, out=head)

    for c in np.flatnonzero(counts):
        done = starts[c]
        while done < head[c]:
            wave = out[done : head[c]]
            done = head[c]
            push_front(wave)
        push_front(grouped[seed_at[c] : seed_at[c + 1]])
    larger_end = head.copy()

    tail = ends.copy()

    def push_back(found: np.ndarray) -> None:
        before = found[found > 0] - 1
        before = before[smaller[before]]
        first = text[before]
        by = np.argsort(first, kind="stable")
        many = np.bincount(first, minlength=letters)
        sorted_first = first[by]
        place = np.arange(len(by)) - (np.cumsum(many) - many)[sorted_first]
        out[tail[sorted_first] - 1 - place] = before[by]
        np.subtract(tail, many, out=tail)

    for c in np.flatnonzero(counts)[::-1]:
        done = ends[c]
        while done > tail[c]:
            wave = out[tail[c] : done][::-1]
            done = tail[c]
            push_back(wave)
        push_back(out[starts[c] : larger_end[c]][::-1])
    out[0] = n - 1  # the end mark, which no other suffix induces
    return out


def _sort_names(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of names (from 0, no more of them than names in the string). The first round
    sorts by as many names as one number holds. Each next one tells apart what is still equal by the ranks of the
    suffixes ``width`` names on, twice as far as the round before; a rank is where its group begins in the order, and
    own and next rank are sorted as one number."""
    n = len(names)
    bits = int(names.max() + 1).bit_length()
    width = 63 // bits
    padded = np.append(names + 1, np.zeros(width, np.int64))  # 0: beyond the end
    key = padded[:n].copy()
    for i in range(1, width):
        key = key << bits | padded[i : i + n]
    order = np.argsort(key)
    key = key[order]
    heads = np.append(True, key[1:] != key[:-1])
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
    tied = np.flatnonzero(~(heads & np.append(heads[1:], True)))
    while len(tied):
        suffixes = order[tied]
        beyond = suffixes + width
        key = rank[suffixes].astype(np.int64) << 32
        inside = beyond < n
        key[inside] += rank[beyond[inside]] + 1
        by = np.argsort(key)
        key, suffixes = key[by], suffixes[by]
        order[tied] = suffixes
        heads = np.append(True, key[1:] != key[:-1])
        rank[suffixes] = tied[np.maximum.accumulate(np.where(heads, np.arange(len(tied)), 0))]
        tied = tied[~(heads & np.append(heads[1:], True))]
        width *= 2
    return order


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes of ``text`` in order. The last letter must be the only 0.

    Suffixes are classified as smaller or larger than the next; substrings between leftmost-smaller places are sorted
    by a first induction and named; equal names are told apart by sorting the string of names; a second induction from
    these sorts all suffixes in linear time.
    """
    n = len(text)
    if n < 3:
        return np.arange(n, dtype=np.int32)[::-1].copy()
    step = np.sign(text[1:].astype(np.int16) - text[:-1].astype(np.int16)).astype(np.int8)
    known = np.where(step != 0, np.arange(n - 1, dtype=np.int32), np.int32(n - 1))
    nearest = np.minimum.accumulate(known[::-1])[::-1]
    smaller = np.append(step[np.minimum(nearest, n - 2)] > 0, True)
    del step, known, nearest
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    counts = np.bincount(text, minlength=257)
    if len(lms) < 2:
        return _induce(text, smaller, lms.astype(np.int32), counts)
    first = _induce(text, smaller, lms.astype(np.int32), counts)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    ordered = first[is_lms[first]].astype(np.int64)
    del first, is_lms
    length = np.empty(n, np.int32)
    length[lms] = np.append(np.diff(lms), 0) + 1
    a, b = ordered[:-1], ordered[1:]
    same = length[a] == length[b]
    same[same] = _stepwise_equal(text, a[same], b[same], length[a[same]])
    name = np.empty(n, np.int64)
    name[ordered] = np.concatenate([[0], np.cumsum(~same)])
    names = name[lms]
    if names.max() + 1 < len(lms):
        order = lms[_sort_names(names)]
    else:
        order = ordered
    return _induce(text, smaller, order.astype(np.int32), counts)


def permuted_prefixes(text: np.ndarray, array: np.ndarray, left: np.ndarray) -> np.ndarray:
    """For each place, how many bytes it shares with the place before it in the suffix array, ``left`` at most.

    A place whose left neighbours agree has one byte less than the place before it; only the others are compared.
    """
    n = len(text)
    before = np.full(n, -1, np.int32)
    before[array[1:]] = array[:-1]
    place = np.arange(n, dtype=np.int32)
    compared = (before <= 0) | (place == 0) | (left == 0)
    compared[1:] |= (left[:-1] == 0) | (text[:-1] != text[np.maximum(before[1:], 1) - 1]) | (left[np.maximum(before[1:], 1) - 1] == 0)
    shared = np.zeros(n, np.int32)
    own = np.flatnonzero(compared & (before >= 0))
    most = np.minimum(left[own], left[before[own]])
    words = _words(text.astype(np.uint8))
    length, active = np.zeros(len(own), np.int64), np.arange(len(own))
    while len(active):
        active = active[length[active] < most[active]]
        x, y = own[active] + length[active], before[own[active]] + length[active]
        differ = words[x] ^ words[y]
        lowest = differ & (~differ + np.uint64(1))  # 0 if all 8 bytes are equal: its predecessor has 64 bits
        length[active] += np.bitwise_count(lowest - np.uint64(1)) // 8
        active = active[differ == 0]
    shared[own] = np.minimum(length, most)
    del own, most, length, active, before
    source = np.maximum.accumulate(np.where(compared, place, np.int32(0)))
    return np.maximum(shared[source] - (place - source), 0)


def repeated_in_shard(
    pieces: list[bytes], texts: np.ndarray, begins: np.ndarray, length: int, across: bool = False
) -> list[tuple[int, int, int]]:
    """Stretches (piece, from, to) covered by strings of ``length`` bytes that also start at another place, or, with
    ``across``, in another text.

    ``texts`` numbers the text of each piece and ``begins`` its place there: pieces may overlap, and the same place in
    two pieces is one place.
    """
    sizes = np.array([len(p) for p in pieces])
    raw = np.frombuffer(b"\x01".join(pieces) + b"\x01", np.uint8)
    ends = np.cumsum(sizes + 1) - 1
    letters = raw.astype(np.uint16) + np.uint16(1)
    letters[ends] = 1
    text = np.append(letters, np.uint16(0))
    piece = np.repeat(np.arange(len(pieces), dtype=np.int32), sizes + 1)
    at = (np.arange(len(raw)) - (ends - sizes)[piece]).astype(np.int32)
    left = np.append(np.maximum(sizes[piece] - at, 0), 0).astype(np.int32)
    array = suffix_array(text)
    shared = permuted_prefixes(text, array, left)[array]
    run = np.cumsum(shared < length)
    heads = np.flatnonzero(np.append(True, shared[1:] < length))
    where = np.append((texts[piece].astype(np.int64) << 32) + begins[piece] + at, -1)[array]
    where = where >> 32 if across else where
    several = np.minimum.reduceat(where, heads) != np.maximum.reduceat(where, heads)
    run -= run[0]
    found = np.zeros(len(text), bool)
    found[array[several[run]]] = True
    hit = np.flatnonzero(found[: len(raw)])
    if not len(hit):
        return []
    cut = np.flatnonzero((np.diff(hit) != 1) | (np.diff(piece[hit]) != 0))
    firsts, lasts = hit[np.append(0, cut + 1)], hit[np.append(cut, len(hit) - 1)]
    return list(zip(piece[firsts].tolist(), at[firsts].tolist(), (at[lasts] + length).tolist()))


def common_prefix(a: bytes, b: bytes) -> int:
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle - 1)
    return low


def _most_common(strings: list[bytes]) -> list[int]:
    """For each string the longest prefix that it shares with any other: with a neighbour in order."""
    order = sorted(range(len(strings)), key=strings.__getitem__)
    most = [0] * len(strings)
    for a, b in zip(order, order[1:]):
        shared = common_prefix(strings[a], strings[b])
        most[a], most[b] = max(most[a], shared), max(most[b], shared)
    return most


def shared_stretches(pieces: list[bytes], at: list[int], length: int) -> list[tuple[int, int] | None]:
    """Of each piece of an anchor's group the part (from, to) that any string of ``length`` bytes with the anchor lies
    in which another piece has too: what the piece shares with any other before the anchor and from it on. None if
    these do not add up to ``length``."""
    if min(at) < 0:
        return [(0, len(p)) for p in pieces]
    after = _most_common([p[a:] for p, a in zip(pieces, at)])
    before = _most_common([p[:a][::-1] for p, a in zip(pieces, at)])
    return [(a - x, a + y) if x + y >= length else None for a, x, y in zip(at, before, after)]


def may_repeat(pieces: list[bytes], at: list[int], length: int) -> list[bool]:
    """Whether a string of ``length`` bytes around an anchor can be in another piece of the anchor's group."""
    return [part is not None for part in shared_stretches(pieces, at, length)]


def settle_group(
    group: list[tuple[bytes, int, bytes, int]], length: int, across: bool = False
) -> tuple[list[tuple[bytes, int, int]], list[tuple[bytes, int, bytes]]]:
    """Of an anchor's group, rows (text, place of the piece, piece, place of the anchor in it): stretches (text, from, to)
    that repeat as a whole, as an equal one is elsewhere; and the (text, place, piece) that a suffix array is needed for.

    Pieces are cut to what they share first. Those that are equal then fold to one, or ``across`` texts to one of each
    of two texts, which stay for the unlike ones to be compared with; alone in the group they need no comparison.
    """
    if len(group) < 2:
        return [], []
    parts = shared_stretches([r[2] for r in group], [r[3] for r in group], length)
    kinds: dict[bytes, set] = {}
    for (key, lo, piece, _), part in zip(group, parts):
        if part is not None:
            kinds.setdefault(piece[part[0] : part[1]], set()).add((key, lo + part[0]))
    whole, unlike = [], []
    for piece, places in kinds.items():
        first, last = min(places), max(places)
        several = first[0] != last[0] if across else first != last
        if several:
            whole += [(key, lo, lo + len(piece)) for key, lo in places]
            places = {first, last} if across else {first}
        if len(kinds) > 1:
            unlike += [(key, lo, piece) for key, lo in places]
    return whole, unlike


def _shards(length: int, across: bool):
    """Task that gathers whole anchor groups to shards and reports repeated stretches of their texts.

    Groups are settled first as far as their pieces are equal where they share anything (see `settle_group`).
    """

    def run(batches):
        held: list = []
        whole: set = set()
        group: list = []
        size = 0

        def closed() -> list:
            equal, unlike = settle_group([r[1:] for r in group], length, across)
            whole.update(equal)
            group.clear()
            return unlike

        def solve():
            found = []
            if held:
                keys = {}
                number = np.array([keys.setdefault(r[0], len(keys)) for r in held])
                found = repeated_in_shard([r[2] for r in held], number, np.array([r[1] for r in held]), length, across)
            rows = whole | {(held[i][0], held[i][1] + a, held[i][1] + b) for i, a, b in found}
            columns = list(zip(*sorted(rows))) or [[], [], []]
            held.clear()
            whole.clear()
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32())], schema=arrow)

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("h", "key", "lo", "piece", "at"))):
                if group and row[0] != group[0][0]:
                    rows = closed()
                    more = sum(len(r[2]) for r in rows)
                    if held and size + more > SHARD_BYTES or len(whole) > MOST_HELD:  # a large group is a shard by itself
                        yield solve()
                        size = 0
                    held += rows
                    size += more
                group.append(row)
        if group:
            held += closed()
        if held or whole:
            yield solve()

    arrow = to_arrow_schema("key binary, lo int, hi int")
    return run


def text_key(text: str = "text"):
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))


def stored(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "suffix")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def repeated_stretches(
    documents: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, across: bool = False
) -> tuple[DataFrame, DataFrame]:
    """``key``, ``lo``, ``hi``: stretches of texts covered by repeated strings; and ``key``, ``text`` of texts that may
    have some. ``key`` is the digest of a text."""
    found = stored(find_anchors(documents, length, gram))
    again, measured = materialise(
        found.groupBy("h").agg(F.count(F.lit(1)).alias("n")), keep=F.col("n") > 1, repeated=F.count_if(F.col("n") > 1)
    )
    again = again.select("h")
    if (measured["repeated"] or 0) <= MOST_BROADCAST:
        again = F.broadcast(again)
    found = stored(found.join(again, "h", "left_semi"))
    copies = documents.select(text_key().alias("key"), "text").groupBy("key").agg(F.any_value("text").alias("text"))
    texts = stored(copies.join(found.select("key").distinct(), "key", "left_semi"))

    stretch = ["h", "around", "at"]
    folded, _ = materialise(
        found.groupBy(*stretch).agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "lo", "hi")).alias("one"),
            *([F.max(F.struct("key", "lo", "hi")).alias("other")] if across else []),
            (F.min("key") != F.max("key") if across else F.count(F.lit(1)) > 1).alias("several"),
        ).select(*stretch, "n", "several", "one.*", *(["other"] if across else []))
    )
    whole = found.join(folded.where("several").select(*stretch), stretch, "left_semi")
    whole = whole.where(F.col("hi") - F.col("lo") >= length).select("key", "lo", "hi").distinct()

    mixed = folded.groupBy("h").agg(F.count(F.lit(1)).alias("kinds"), F.min("several").alias("done")).where("kinds > 1 and not done")
    each_place = folded.select(*stretch, "key", "lo", "hi")
    if across:  # what repeats in one text only has to be found at each of its places
        own = found.join(folded.where("n > 1 and not several").select(*stretch), stretch, "left_semi")
        # of two texts one place each: what is like it may be in one of them, where only the other one is another text
        two = folded.where("several").select(*stretch, "other.*")
        each_place = folded.where("n = 1 or several").select(*each_place.columns).unionByName(two).unionByName(own.select(*each_place.columns))
    asked = each_place.join(mixed.select("h", (F.col("kinds") > hot).alias("crowded")), "h")
    asked = asked.join(texts, "key").select("h", "crowded", "key", "lo", "at", F.expr("substring(cast(text as binary), lo + 1, hi - lo)").alias("piece"))
    asked = stored(asked.where(F.length("piece") >= length))
    sorted_out = asked.where("not crowded").drop("crowded").repartition("h").sortWithinPartitions("h", "key", "lo")
    by_array = sorted_out.mapInArrow(_shards(length, across), "key binary, lo int, hi int")
    # an anchor with more surroundings than a shard holds: each string with it is counted by its digest
    each = asked.where("crowded").select("key", "lo", "piece", F.explode(F.sequence(F.lit(0), F.length("piece") - length)).alias("from"))
    each = each.select("key", (F.col("lo") + F.col("from")).cast("int").alias("lo"), F.unhex(F.md5(F.expr(f"substring(piece, from + 1, {length})"))).alias("string")).distinct()
    several = each.groupBy("string").agg((F.min("key") != F.max("key") if across else F.count(F.lit(1)) > 1).alias("several"))
    several = several.where("several").select("string")
    by_count = each.join(several, "string", "left_semi").select("key", "lo", (F.col("lo") + length).alias("hi"))
    return stored(whole.unionByName(by_array).unionByName(by_count)), texts


def remove_repeats(documents: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, across: bool = False) -> DataFrame:
    """Every text of which something goes: ``key`` (its MD5, 16 bytes), ``n_removed`` (bytes), ``n_spans`` (maximal
    runs), ``kept`` (the other bytes) and ``kept_text`` (these as text, without characters that lost a byte).

    Each byte goes that a string of ``length`` bytes covers which also starts anywhere else, in the same text or any
    other. Strings never cross texts and are judged on the input. Two equal strings share an anchor (see `anchors`), so
    texts meet by the hashes of their anchors: equal surroundings are folded to a count first, unlike ones are sorted
    in a suffix array per shard of whole anchor groups. No text is held but by its own task.

    With ``across`` only strings count that start in another, different text; what repeats within one text stays.

    Null and short texts have nothing to remove; repeated rows remove each other. An empty table gives no rows. Columns
    other than ``text`` are left out.
    """
    marks, texts = repeated_stretches(documents, length, gram, hot, across)
    spans = marks.groupBy("key").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    rows = texts.join(spans, "key").select("key", "text", F.col("spans.lo").alias("lo"), F.col("spans.hi").alias("hi"))

    def cut(batch):
        out = {name: [] for name in ("key", "n_removed", "n_spans", "kept", "kept_text")}
        for key, text, lo, hi in zip(*(batch.column(c).to_pylist() for c in ("key", "text", "lo", "hi"))):
            raw = text.encode()
            kept, end, runs = [], 0, 0
            for a, b in sorted(zip(lo, hi)):
                if a > end or not runs:
                    kept.append(raw[end:a])
                    runs += 1
                end = max(end, b)
            kept = b"".join([*kept, raw[end:]])
            for name, value in zip(out, (key, len(raw) - len(kept), runs, kept, kept.decode("utf-8", "ignore"))):
                out[name].append(value)
        return out

    return per_batch(rows, cut, "key binary, n_removed bigint, n_spans bigint, kept binary, kept_text string")


def op4_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    gone = remove_repeats(documents).select("key", "n_removed", "n_spans", F.sha2("kept", 256).alias("sha"))
    whole = F.coalesce("text", F.lit("")).cast("binary")
    rows = documents.select("doc_id", text_key().alias("key"), F.length(whole).cast("long").alias("n_bytes"), F.sha2(whole, 256).alias("own"))
    return rows.join(gone, "key", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("sha", "own").alias("kept_sha256"),
    )
