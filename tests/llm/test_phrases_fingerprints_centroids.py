"""Phrases, order MinHash and exact k-means against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from plumbline.llm import centroids, collocations, fingerprints

SF = "/root/testdata/sf0.001"


# phrases ----------------------------------------------------------------------


def phrases_brute(rows, least, longest, contained, best):
    counts, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                counts.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    candidates = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= least}
    found = defaultdict(list)
    for (lang, words), a in candidates.items():
        inside = any(
            100 * f >= contained * a
            for (other, longer), f in candidates.items()
            if other == lang and len(longer) > len(words)
            and any(longer[i : i + len(words)] == words for i in range(len(longer) - len(words) + 1))
        )
        if not inside:
            cuts = [(2000000 * a // (counts[lang, words[:k]] + counts[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            found[lang].append((-score, -a, " ".join(words).encode(), counts[lang, words[:k]], counts[lang, words[k:]]))
    return {
        (lang, rank, p.decode(), -a, l, r, total[lang], -s)
        for lang, kept in found.items() for rank, (s, a, p, l, r) in enumerate(sorted(kept)[:best], 1)
    }


def phrase_rows(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "A", "b", "c", "d", "É", "é", "x\x0by", "it's", " ", "z" * 40]
    rows = [(None, None), ("en", ""), ("en", " \t\n.;"), ("", "a b c"), ("en", "a b\nc d"), ("en", "a b c d " * 300)]
    for _ in range(60):
        glue = rng.choice([" ", "  ", "\t"])
        text = glue.join(rng.choice(vocabulary) + rng.choice(["", "", "", ",", ". ", "\n"]) for _ in range(rng.randrange(120)))
        rows += [(rng.choice(["en", "de", None]), text)] * rng.choice([1, 1, 2])
    return rows


@pytest.mark.parametrize("seed, broadcast, pairs", [(1, 1 << 25, 1 << 19), (2, -1, 7)])
def test_phrases_match_brute_force(spark, monkeypatch, seed, broadcast, pairs):
    """By lookups and by shuffles, with pieces of work of any size."""
    monkeypatch.setattr(collocations, "MOST_BROADCAST", broadcast)
    monkeypatch.setattr(collocations, "PAIRS", pairs)
    rows = phrase_rows(seed)
    frame = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "lang string, text string, id int, word int, a int").repartition(3)
    got = collocations.mine_phrases(frame, least=4, longest=4, contained=80, best=9).collect()
    assert {tuple(r) for r in got} == phrases_brute(rows, 4, 4, 80, 9)
    assert len(got) == len({tuple(r) for r in got}) > 10


def test_phrases_of_three_words_and_none(spark):
    rows = phrase_rows(3)
    frame = spark.createDataFrame(rows, "lang string, text string")
    got = {tuple(r) for r in collocations.mine_phrases(frame, least=9, longest=3, contained=50).collect()}
    assert got == phrases_brute(rows, 9, 3, 50, 2000)
    assert collocations.mine_phrases(frame.limit(0)).count() == 0
    assert collocations.mine_phrases(spark.createDataFrame([("en", "a b")], "lang string, text string")).count() == 0


def odd_rows(seed):
    """Many languages, some with the same words, and texts that end in each kind of byte."""
    rng = random.Random(seed)
    rows = phrase_rows(seed) + [(f"l{i}", f"w{i} v{i} w{i} v{i}, b c b c") for i in range(90) for _ in range(2)]
    for end in ["", " ", ".", "\n", "\x0c", "a", "É", "\0"]:
        rows += [(rng.choice(["en", "", "l1"]), f"{start}a b c a b c{end}") for start in ["", "a b", ";", "\t", "!? "]]
    return rows


@pytest.mark.parametrize("part", [1 << 25, 200])
def test_phrases_shuffle_no_occurrence(spark, monkeypatch, part):
    """Frequent groups are looked up where the occurrences are, in one broadcast or several; a row of an occurrence is
    not made. Small pieces of work, buckets and rows."""

    def made(*_):
        raise AssertionError("a row per occurrence")

    for name in ("word_occurrences", "adjacent"):
        monkeypatch.setattr(collocations, name, made)
    for name, value in (("PART", part), ("PAIRS", 50), ("HELD", 90), ("BUCKET", 60), ("ROW", 8)):
        monkeypatch.setattr(collocations, name, value)
    rows = odd_rows(4)
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = collocations.mine_phrases(frame, least=2, longest=4, contained=80, best=9).collect()
    assert {tuple(r) for r in got} == phrases_brute(rows, 2, 4, 80, 9)
    assert len(got) > 100


def test_phrases_with_equal_hashes(spark, monkeypatch):
    """Words of one hash are told apart by their bytes and languages."""
    monkeypatch.setattr(collocations, "word_hashes", lambda langs, words: np.full(len(words), 7, np.uint64))
    rows = odd_rows(5)
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(2)
    got = collocations.mine_phrases(frame, least=3, longest=3, contained=80, best=9).collect()
    assert {tuple(r) for r in got} == phrases_brute(rows, 3, 3, 80, 9)


def test_phrases_by_shuffle_of_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(collocations, "MOST_BROADCAST", -1)
    rows = odd_rows(6)
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = collocations.mine_phrases(frame, least=2, longest=4, contained=80, best=9).collect()
    assert {tuple(r) for r in got} == phrases_brute(rows, 2, 4, 80, 9)


def test_pairs_are_dealt_folded(spark):
    """What a task hands on is a row per bucket, not one per pair of words."""
    items = np.random.default_rng(1).integers(1, 40, 50_000).astype(np.int32)
    occurred = spark.createDataFrame([(bytearray(items.tobytes()),)] * 3, "items binary").coalesce(1)
    counted = collocations.pair_counts(occurred, 2)
    got = {(r.x, r.y): r.a for r in counted.collect()}
    pairs = Counter(zip(items[:-1].tolist(), items[1:].tolist()))
    assert got == {k: 3 * n for k, n in pairs.items() if 3 * n >= 2}
    assert "HashAggregate" not in counted._jdf.queryExecution().executedPlan().toString()


def test_scores_beyond_64_bits():
    """2,000,000 times a count of 10^13 needs decimals; the expression must not fall back to longs."""
    assert 2_000_000 * 10**13 > 2**63 and "decimal(38,0)" in open(collocations.__file__).read()


# order MinHash ----------------------------------------------------------------


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def hash_long(x, seed):
    return xxhash.xxh64((x & (1 << 64) - 1).to_bytes(8, "little"), seed=seed).intdigest()


def hash_longs(values):
    seed = 42
    for v in values:
        seed = hash_long(v, seed)
    return seed


def minhash_brute(text):
    """Each permutation by itself: all k-mers in the order of their hash XOR the entry's number."""
    units = [xxhash.xxh64(u.encode(), seed=42).intdigest() for u in re.findall(fingerprints.UNIT, text)]
    k = fingerprints.GRAM
    grams = [hash_longs(units[i : i + k]) for i in range(len(units) - k + 1)] if len(units) >= k else [hash_longs(units)] if units else []
    seen, hashes = Counter(), []
    for place, gram in enumerate(grams):
        number = xxhash.xxh64(seen[gram].to_bytes(4, "little"), seed=hash_long(gram, 42)).intdigest()
        bits = len(bin(len(grams))) - 2
        hashes.append((number >> bits, place))
        seen[gram] += 1
    bits = len(bin(len(grams))) - 2
    out = []
    for j in range(fingerprints.ENTRIES):
        # runs are numbered in the order of signed hashes
        run = (j + fingerprints.ENTRIES // 2) % fingerprints.ENTRIES
        order = sorted(hashes, key=lambda h: ((h[0] ^ (run << 58 >> bits)), h[1]))
        places = sorted(p for _, p in order[: fingerprints.CHOSEN])
        out.append(f"{hash_longs([grams[p] for p in places]) & 0xFFFFFFFF:08x}")
    return "".join(out)


def texts_of(seed):
    rng = random.Random(seed)
    texts = ["", " \n", "one", "one two", "one two three", "Ünïcode \U0001F600 x", "ab" * 500, "a " * 90, "x y " * 40 + "z"]
    for n in (4, 20, 70, 150, 400, 2500):
        texts += [" ".join(f"w{rng.randrange(n)}" for _ in range(n)) for _ in range(3)]
    return texts


def test_fingerprints_match_brute_force(spark):
    texts = texts_of(5)
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    got = {r.doc_id: r.fingerprint for r in fingerprints.fingerprint_documents(frame).collect()}
    for i, text in enumerate(texts):
        assert got[i] == minhash_brute(text), text[:60]


def same_share(a, b):
    return sum(a[i : i + 8] == b[i : i + 8] for i in range(0, len(a), 8)) / fingerprints.ENTRIES


def test_edits_follow_the_next_document(spark):
    texts = texts_of(6)
    rows = [(i * 3, t) for i, t in enumerate(texts)] + [(None, "no id " * 30), (None, None), (6, texts[2]), (6, texts[2]), (9, "other text of the id nine")]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id bigint, text string, key int, place int").repartition(4)
    got = Counter(tuple(r) for r in fingerprints.fingerprint_edits(frame).collect())
    ordered = sorted(
        ((i, t or "") for i, t in rows),
        key=lambda r: (r[0] is None, r[0] or 0, hashlib.md5(f"{'-' if r[0] is None else r[0]}:{r[1]}".encode()).digest()),
    )
    want = Counter()
    for (i, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        own, other, following = map(minhash_brute, (text, edited, after))
        want[i, len(text), hashlib.sha256(edited.encode()).hexdigest(), own, other, same_share(own, other), same_share(own, following)] += 1
    assert got == want
    assert fingerprints.fingerprint_edits(frame.limit(0)).count() == 0
    alone = fingerprints.fingerprint_edits(spark.createDataFrame([(1, "a b c d e f")], "doc_id bigint, text string")).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0


def test_moves_and_edits_lower_the_likeness(spark):
    rng = random.Random(1)
    base = [f"w{i}" for i in range(2000)]
    few = list(base)
    for _ in range(20):
        few[rng.randrange(2000)] = "edit"
    moved = [w for block in rng.sample([base[i : i + 50] for i in range(0, 2000, 50)], 40) for w in block]
    other = [f"v{i}" for i in range(2000)]
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate([base, few, moved, other])], "doc_id bigint, text string")
    a, b, c, d = [r.fingerprint for r in fingerprints.fingerprint_documents(frame).orderBy("doc_id").collect()]
    assert same_share(a, b) > 0.75 and 0.25 < same_share(a, c) < 0.7 and same_share(a, d) == 0


def test_fingerprints_run_no_python(spark):
    frame = spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string")
    plan = fingerprints.fingerprint_edits(frame)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# k-means ----------------------------------------------------------------------


def kmeans_brute(rows, clusters, rounds, dimensions):
    kept = [
        (i, [int(np.floor(1024 * float(x))) if abs(x) < 2**40 else int(x) * 1024 for x in v])
        for i, v in rows if v is not None and len(v) == dimensions and all(x is not None and np.isfinite(x) for x in v)
    ]
    seeds = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), c) for i, c in kept if i is not None)[:clusters]
    points = [list(c) for _, c in seeds]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(c, p)), k) for k, p in enumerate(points)) for _, c in kept]

    for _ in range(rounds):
        labels = [k for _, k in assign()]
        for k in range(len(points)):
            own = [c for (_, c), label in zip(kept, labels) if label == k]
            if own:
                points[k] = [sum(col) // len(own) for col in zip(*own)]
    final = assign()
    inertia = Counter()
    for d, k in final:
        inertia[k] += d
    digests = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]
    total = sum(inertia.values())
    rows = ((i, k, d, inertia[k], total, digests[k]) for (i, _), (d, k) in zip(kept, final))
    return Counter(tuple(v if isinstance(v, str) or v is None or v < 2**63 else None for v in r) for r in rows)


def vectors(seed, n=160, dimensions=4, scale=1.0):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([rng.gauss(0, scale), rng.randrange(-2, 3) / 2]) for _ in range(dimensions)]) for i in range(n)]
    rows += [(i + n, list(rows[i][1])) for i in range(10)]
    odd = [None, [], [1.0] * (dimensions - 1), [float("nan")] * dimensions, [float("inf")] * dimensions, [None] + [1.0] * (dimensions - 1), [0.0] * dimensions]
    return rows + [(1000 + i, v) for i, v in enumerate(odd)] + [(None, [0.5] * dimensions), rows[3], rows[3]]


@pytest.mark.parametrize("seed, clusters, scale", [(1, 8, 1.0), (2, 40, 1.0), (3, 5, 1e6), (4, 1, 1.0), (5, 400, 1.0)])
def test_clusters_match_brute_force(spark, seed, clusters, scale):
    rows = vectors(seed, scale=scale)
    frame = spark.createDataFrame([(*r, 7, "x") for r in rows], "vec_id bigint, embedding array<double>, cluster int, components string").repartition(5)
    got = centroids.cluster_vectors(frame, clusters, 3, dimensions=4).collect()
    assert Counter(tuple(r) for r in got) == kmeans_brute(rows, clusters, 3, 4)


def test_distances_beyond_a_long(spark):
    rows = [(1, [2.0**50, 0.0]), (2, [-(2.0**50), 1.0]), (3, [0.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {r.vec_id: r for r in centroids.cluster_vectors(frame, 2, 2, dimensions=2).collect()}
    assert len(got) == 3 and any(r.distance is None for r in got.values()) and all(r.inertia is None for r in got.values())
    assert centroids.cluster_vectors(frame.limit(0), 2, 2, dimensions=2).count() == 0
    assert centroids.cluster_vectors(frame, 2, 2, dimensions=3).count() == 0


@pytest.mark.parametrize("kind", [np.int64, object])
def test_tree_finds_the_smallest_of_equally_near(kind):
    rng = np.random.default_rng(1)
    points = rng.integers(-3, 4, (200, 3)).tolist()
    queries = rng.integers(-4, 5, (300, 3)).astype(kind)
    label, best, computed = centroids.nearest_points(queries, points, centroids.vantage_tree(points))
    for q, k, d in zip(queries.tolist(), label.tolist(), best.tolist()):
        assert (d, k) == min((centroids.squared(q, p), i) for i, p in enumerate(points))


def test_tree_prunes():
    rng = np.random.default_rng(2)
    middles = rng.integers(-100_000, 100_000, (40, 8))
    points = (middles[:, None, :] + rng.integers(-50, 50, (40, 10, 8))).reshape(-1, 8).tolist()
    queries = middles[rng.integers(0, 40, 500)] + rng.integers(-50, 50, (500, 8))
    label, best, computed = centroids.nearest_points(queries, points, centroids.vantage_tree(points))
    assert computed < 0.3 * len(points) * len(queries)
    everything = ((queries[:, None, :] - np.array(points)[None]) ** 2).sum(2)
    assert (best == everything.min(1)).all() and (label == everything.argmin(1)).all()
