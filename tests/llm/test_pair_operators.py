import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plumbline.llm import pivots, sketches, suffix
from plumbline.llm.components import connected_components
from plumbline.sources import staging


def smallest_reach(nodes, links):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


@pytest.mark.parametrize("links", [
    [], [(1, 1)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 80)], [(99, i) for i in range(1, 80)],
    [(i * 7 % 50, i * 13 % 50) for i in range(40)], [(2, 1), (1, 2), (2, 1)],
])
def test_components(spark, links):
    got = {r[0]: r[1] for r in connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    nodes = {x for link in links if link[0] != link[1] for x in link}
    assert got == smallest_reach(nodes, [x for x in links if x[0] != x[1]])


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)}


def near_brute(texts, percent=75):
    sets = [shingles(t) for t in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    return [len(s) for s in sets], smallest_reach(range(len(texts)), links)


def corpus(seed, groups=14, size=14):
    rng = random.Random(seed)
    texts = [None, "", "  \n", "one", "ONE", "one two three four", "one two three four five", "É x y z w", "é x y z w"]
    for g in range(groups):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.choice([12, 60, 200, 900]))]
        for _ in range(rng.randrange(1, size)):
            words = list(base)
            for _ in range(int(len(words) * rng.choice([0, 0, 0.01, 0.02, 0.04, 0.06, 0.3]))):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(words).upper() if rng.random() < 0.2 else "  ".join(words))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed, block", [(1, 256), (2, 4)])
def test_near_duplicates_match_brute_force(spark, seed, block):
    texts = corpus(seed)
    rows = [(i, t, "z", True) for i, t in enumerate(texts)]
    df = spark.createDataFrame([*rows, (None, texts[5], None, None), rows[20]], "doc_id bigint, text string, bucket string, kept boolean")
    got = sketches.near_duplicates(df, block=block).collect()
    sizes, reach = near_brute(texts)
    assert len(got) == len(texts) + 2
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == (sizes[r["doc_id"]], reach[r["doc_id"]])
            assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_a_stray_in_a_crowded_bucket_sends_each_copy_once(spark, monkeypatch):
    """All texts in one bucket; one of them isn't in the component that the others are in yet."""
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(words[:i] + [f"x{i}"] + words[i + 1 :]) for i in range(150)]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    sets = sketches.sketch(documents).select(F.col("doc_id").alias("id"), "set_id", "n_shingles", "sketch")
    met = sketches.meetings(sets)
    crowd = met.where("band = 0").groupBy("bucket", "centre").count().orderBy(F.desc("count")).first()
    here = met.where(F.col("bucket") == crowd["bucket"])
    stray = here.where("id <> centre").agg(F.max("id")).first()[0]
    labels = sets.where(F.col("id") != stray).select("id", F.lit(0).cast("bigint").alias("component"))
    counted = []

    def spy(df, keep=None, **measures):
        stored, found = staging.materialise(df, keep, **measures)
        counted.append(found)
        return stored, found

    monkeypatch.setattr(sketches, "materialise", spy)
    block, members = 4, crowd["count"] - 1
    links = sketches.block_links(here, sets, labels, documents, 75, block).collect()
    found = {row["rows"] for row in counted if "rows" in row}
    blocks = -(-(members - 1) // block)
    assert members > 3 * block and found == {members - 1 + blocks + 1}
    assert 1 <= len(links) <= blocks and all(stray in (r["a"], r["b"]) for r in links)  # a link per piece of work


def test_chain_through_unlike_neighbours(spark):
    """Each text links to the next only; the smallest of a bucket need not be near the rest."""
    rng = random.Random(9)
    words = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(40):
        texts.append(" ".join(words))
        for _ in range(6):
            words[rng.randrange(300)] = f"x{rng.randrange(10**6)}"
    order = list(range(40))
    rng.shuffle(order)
    texts = [texts[i] for i in order]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["component_id"] for r in sketches.near_duplicates(df, block=8).collect()}
    assert got == near_brute(texts)[1]


def test_no_documents(spark):
    assert sketches.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_estimates_and_merging():
    rng = np.random.default_rng(4)
    pool = rng.integers(0, 2**63, 6000).astype(np.uint64)
    for j in (0.2, 0.6, 0.75, 0.95):
        shared = int(2 * 2000 * j / (1 + j))
        errors = []
        for _ in range(30):
            pick = rng.permutation(pool)
            a, b = pick[:2000], np.concatenate([pick[:shared], pick[2000 : 4000 - shared]])
            ka, kb = sketches.registers(np.sort(a)), sketches.registers(np.sort(b))
            guess = sketches.estimate(np.array([2000.0]), np.array([2000.0]), (ka > kb).sum(keepdims=True), (ka < kb).sum(keepdims=True))
            errors.append(guess[0] - shared / (4000 - shared))
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 2 * np.sqrt(j * (1 - j) / sketches.REGISTERS)
        assert (np.maximum(ka, kb) == sketches.registers(np.unique(np.concatenate([a, b])))).all()


def vectors(seed):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(40):
        base = rng.normal(size=32)
        out += [base + rng.normal(size=32) * rng.choice([0, 0.01, 0.1, 0.3, 0.5]) for _ in range(rng.integers(1, 9))]
    out += [out[0] * 3.5] * 3
    rows = [v.astype(np.float32).tolist() for v in out]
    return rows + [None, [], [0.0] * 32, [float("nan")] + [1.0] * 31, [float("inf")] + [1.0] * 31, [None] + [1.0] * 31, [1.0, 0.0, 0.0], [2.0, 0.0, 0.1]]


@pytest.mark.parametrize("seed, block", [(1, 1024), (2, 16)])
def test_vectors_match_brute_force(spark, monkeypatch, seed, block):
    monkeypatch.setattr(pivots, "BLOCK", block)
    rows = vectors(seed)
    df = spark.createDataFrame([(i, v, "l", 7) for i, v in enumerate(rows)] + [(None, rows[0], "l", 7)], "vec_id bigint, embedding array<float>, class string, n bigint")
    got = pivots.near_vectors(df).collect()
    usable = {i: pivots.usable(v) for i, v in enumerate(rows)}
    links = set()
    for i, x in usable.items():
        for j, y in usable.items():
            if i != j and x is not None and y is not None and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.9:
                links.add((i, j))
    reach = smallest_reach(range(len(rows)), links)
    n = np.bincount([a for a, _ in links], minlength=len(rows))
    found = sum(r["n_links"] for r in got)
    assert len(got) == len(rows) + 1 and found <= len(links) and found >= 0.97 * len(links)
    for r in got:
        if r["vec_id"] is None:
            assert (r["n_links"], r["component_id"], r["kept"]) == (0, None, True)
        else:
            assert r["n_links"] <= n[r["vec_id"]] and r["component_id"] >= reach[r["vec_id"]]
            assert r["kept"] == (r["vec_id"] == r["component_id"])
    assert sum(r["component_id"] == reach[r["vec_id"]] for r in got if r["vec_id"] is not None) >= 0.98 * len(rows)


def test_no_vectors(spark):
    assert pivots.near_vectors(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).count() == 0
    one = pivots.near_vectors(spark.createDataFrame([(4, [1.0])], "vec_id bigint, embedding array<float>")).collect()
    assert [tuple(r) for r in one] == [(4, 0, 4, True)]


def texts_for_arrays():
    rng = random.Random(6)
    yield b"banana", b"mississippi", b"aaaaaaaa", b"abababab", b"a"
    for letters in (b"ab", b"abc", bytes(range(256))):
        for _ in range(40):
            yield (bytes(rng.choice(letters) for _ in range(rng.randrange(1, 120))),)
    for _ in range(20):
        part = bytes(rng.choice(b"abcd") for _ in range(30))
        yield (part * 3 + b"x" + part,)


def test_suffix_arrays_and_prefixes():
    for raw in (x for group in texts_for_arrays() for x in group):
        text = np.append(np.frombuffer(raw, np.uint8).astype(np.uint16) + 1, np.uint16(0))
        got = suffix.suffix_array(text)
        expected = sorted(range(len(text)), key=lambda i: text[i:].tolist())
        assert got.tolist() == expected, raw
        left = np.append(np.arange(len(raw), 0, -1), 0)
        shared = suffix.permuted_prefixes(text, got, left)
        for before, i in zip(expected, expected[1:]):
            common = 0
            while raw[before + common : before + common + 1] == raw[i + common : i + common + 1] != b"":
                common += 1
            assert shared[i] == common, (raw, i)


def repeats_brute(texts, length, across=False):
    starts = {}
    raws = [(t or "").encode() for t in texts]
    for d, raw in enumerate(raws):
        for i in range(len(raw) - length + 1):
            starts.setdefault(raw[i : i + length], []).append((d, i))
    gone = [np.zeros(len(r), bool) for r in raws]
    for places in starts.values():
        if len({texts[d] for d, _ in places} if across else places) > 1:
            for d, i in places:
                gone[d][i : i + length] = True
    return [(int(g.sum()), int((np.diff(np.concatenate([[0], g.astype(int)])) == 1).sum()), bytes(np.frombuffer(r, np.uint8)[~g])) for g, r in zip(gone, raws)]


def texts_with_passages(seed, length):
    rng = random.Random(seed)

    def noise(n):
        return "".join(rng.choice("abcdefghij é\n") for _ in range(n))

    passages = [noise(rng.choice([length - 6, length, length + 3, 3 * length])) for _ in range(6)]
    texts = [None, "", "short", "z" * (4 * length), "z" * (length + 1), "z" * (length - 1), "ab" * (2 * length)]
    for _ in range(70):
        parts = [noise(rng.randrange(3 * length)) for _ in range(rng.randrange(1, 4))]
        if rng.random() < 0.6:
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(passages))
        texts.append("".join(parts))
    return texts + [texts[9], texts[9], texts[12], texts[12][1:], "q" + texts[12], texts[14] + texts[14]]


@pytest.mark.parametrize("seed, hot, shard", [(1, 6000, 2 << 20), (2, 2, 300), (3, 6000, 900)])
def test_repeats_match_brute_force(spark, monkeypatch, seed, hot, shard):
    length, gram = 40, 8
    monkeypatch.setattr(suffix, "SHARD_BYTES", shard)
    texts = texts_with_passages(seed, length)
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in enumerate(texts)], "doc_id bigint, text string, key string, lo int")
    got = {bytes(r["key"]): r for r in suffix.remove_repeats(df, length, gram, hot).collect()}
    import hashlib

    for text, (removed, spans, kept) in zip(texts, repeats_brute(texts, length)):
        row = got.get(hashlib.md5((text or "").encode()).digest())
        have = (row["n_removed"], row["n_spans"], bytes(row["kept"])) if row else (0, 0, (text or "").encode())
        assert have == (removed, spans, kept), repr(text)[:80]
        if row:
            assert row["kept_text"] == kept.decode("utf-8", "ignore")


def test_no_texts(spark):
    assert suffix.remove_repeats(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_anchors_of_equal_strings_agree():
    rng = np.random.default_rng(8)
    common = rng.integers(97, 100, 120).astype(np.uint8)
    raws = [np.concatenate([rng.integers(97, 100, rng.integers(0, 50)).astype(np.uint8), common, rng.integers(97, 100, 30).astype(np.uint8)]) for _ in range(20)]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raws])])
    _, places, texts = suffix.anchors(np.concatenate(raws), offsets, 40, 8)
    seen = []
    for t, raw in enumerate(raws):
        begin = len(raw) - 150
        own = places[texts == t] - offsets[t] - begin
        seen.append([x for x in own.tolist() if 32 <= x <= 80])
    assert seen[0] and all(s == seen[0] for s in seen)
    assert pa.array([1]) is not None


def test_hopeless_pieces_are_those_without_a_partner():
    rng = random.Random(4)
    for _ in range(200):
        anchor = b"##"
        pieces = []
        for _ in range(rng.randrange(2, 7)):
            before, after = (bytes(rng.choice(b"ab") for _ in range(rng.randrange(6))) for _ in range(2))
            pieces.append((before + anchor + after, len(before)))
        texts, at = [p for p, _ in pieces], [a for _, a in pieces]
        got = suffix.may_repeat(texts, at, 6)
        for i, (p, a) in enumerate(pieces):
            held = any(
                suffix.common_prefix(p[a:], q[b:]) + suffix.common_prefix(p[:a][::-1], q[:b][::-1]) >= 6
                for j, (q, b) in enumerate(pieces) if j != i
            )
            assert got[i] or not held
    assert suffix.may_repeat([b"a", b"b"], [0, -1], 400) == [True, True]
    assert suffix.common_prefix(b"abc", b"abd") == 2 and suffix.common_prefix(b"", b"x") == 0


@pytest.mark.parametrize("seed", range(4))
def test_identical_long_pieces_in_one_shard(seed):
    """Pieces that agree for longer than a string: prefixes carry from place to place only in a fully sorted array."""
    rng = random.Random(seed)
    long = [bytes(rng.choice(b"ab ") for _ in range(rng.choice([450, 900, 2500]))) for _ in range(3)]
    texts = []
    for _ in range(14):
        parts = [rng.choice(long)[rng.randrange(40) :][: rng.randrange(380, 2500)] for _ in range(rng.randrange(1, 4))]
        texts.append(b"-".join([bytes(rng.choice(b"xyz") for _ in range(rng.randrange(30))), *parts]).decode())
    found = suffix.repeated_in_shard([t.encode() for t in texts], np.arange(len(texts)), np.zeros(len(texts), np.int64), 400)
    gone = [np.zeros(len(t), bool) for t in texts]
    for i, a, b in found:
        gone[i][a:b] = True
    assert [int(g.sum()) for g in gone] == [removed for removed, _, _ in repeats_brute(texts, 400)]


def test_long_repeats_match_brute_force(spark):
    rng = random.Random(9)
    passage = [" ".join(f"p{rng.randrange(10**4)}" for _ in range(400)) for _ in range(2)]
    texts = [" ".join(f"w{rng.randrange(10**4)}" for _ in range(60)) + p[rng.randrange(300) :][: rng.randrange(300, 2300)] for p in passage * 12] + passage
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(4)
    got = {bytes(r.key): (r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix.remove_repeats(frame).collect()}
    import hashlib

    for text, (removed, spans, kept) in zip(texts, repeats_brute(texts, 400)):
        assert got.get(hashlib.md5(text.encode()).digest(), (0, 0, text.encode())) == (removed, spans, kept)


@pytest.mark.parametrize("hot", [6000, 1])
@pytest.mark.parametrize("seed", [1, 2])
def test_passages_of_other_texts_only(spark, seed, hot):
    """What repeats within a text stays unless another text has it too, at each of its places."""
    rng = random.Random(seed)
    shared = ["".join(rng.choice("abc ") for _ in range(rng.choice([45, 90, 200]))) for _ in range(4)]
    own = ["".join(rng.choice("de ") for _ in range(120)) for _ in range(3)]
    texts = []
    for i in range(40):
        parts = [rng.choice(shared)[rng.randrange(9) :] for _ in range(rng.randrange(3))] + [own[i % 3]] * (2 if i < 3 else 0)
        parts += ["".join(rng.choice("xyz") for _ in range(rng.randrange(60)))]
        rng.shuffle(parts)
        texts.append("|".join(parts * rng.choice([1, 1, 2])))
    texts += [None, "", texts[3], texts[3]]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(4)
    got = {bytes(r.key): (r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix.remove_repeats(frame, 40, 8, hot, True).collect()}
    import hashlib

    wanted = repeats_brute(texts, 40, across=True)
    assert any(w[0] for w in wanted)
    for text, (removed, spans, kept) in zip(texts, wanted):
        raw = (text or "").encode()
        assert got.get(hashlib.md5(raw).digest(), (0, 0, raw)) == (removed, spans, kept)


@pytest.mark.parametrize("hot", [6000, 1])
def test_part_of_a_passage_again_in_one_of_its_texts(spark, hot):
    """Two texts share a passage and one of them has a part of it again: only the other text makes that part go."""
    import hashlib

    rng = random.Random(5)

    def noise(n):
        return "".join(rng.choice("abcdefgh") for _ in range(n))

    texts = []
    for _ in range(20):
        passage = noise(300)
        texts += [noise(30) + passage + noise(50) + passage[100 : 100 + rng.choice([50, 60, 90])] + noise(40), noise(20) + passage + noise(25)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(4)
    got = {bytes(r.key): (r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix.remove_repeats(frame, 40, 8, hot, True).collect()}
    for text, wanted in zip(texts, repeats_brute(texts, 40, across=True)):
        assert got[hashlib.md5(text.encode()).digest()] == wanted


@pytest.mark.parametrize("across", [False, True])
def test_pieces_equal_where_they_share_fold_before_the_suffix_array(across):
    length, anchor = 8, b"####"
    near = [(b"a", 3, b"xx12345####6789yy", 7), (b"b", 0, b"2345####6789", 4)]
    whole, unlike = suffix.settle_group(near, length, across)
    assert sorted(whole) == [(b"a", 6, 18), (b"b", 0, 12)] and unlike == []
    assert suffix.settle_group(near[:1], length, across) == ([], [])
    again = [(b"a", 0, b"1234####5", 4), (b"a", 50, b"1234####6", 4)]
    assert bool(suffix.settle_group(again, length, across)[0]) is not across

    rng = random.Random(5)
    for _ in range(300):
        texts = {bytes([97 + i]): bytes(rng.choice(b"uv") for _ in range(rng.randrange(1, 7))) + anchor + bytes(rng.choice(b"uv") for _ in range(rng.randrange(1, 7))) for i in range(rng.randrange(2, 8))}
        if rng.random() < 0.5:  # the anchor twice in a text
            texts[b"a"] += b"-" * 12 + texts[b"b"]
        group = [(k, max(at - 6, 0), t[max(at - 6, 0) : at + 10], min(at, 6)) for k, t in texts.items() for at in range(len(t)) if t.startswith(anchor, at)]
        whole, unlike = suffix.settle_group(group, length, across)
        found = list(whole)
        if unlike:
            keys = [k for k, _, _ in unlike]
            for i, a, b in suffix.repeated_in_shard([p for _, _, p in unlike], np.array([ord(k) for k in keys]), np.array([lo for _, lo, _ in unlike]), length, across):
                found.append((keys[i], unlike[i][1] + a, unlike[i][1] + b))
        assert sum(len(p) for _, _, p in unlike) <= sum(len(r[2]) for r in group)
        gone = {k: np.zeros(len(t), bool) for k, t in texts.items()}
        for k, a, b in found:
            gone[k][a:b] = True
        wanted = {k: np.zeros(len(t), bool) for k, t in texts.items()}
        starts = {}
        for k, t in texts.items():
            for i in range(len(t) - length + 1):
                if anchor in t[i : i + length]:
                    starts.setdefault(t[i : i + length], []).append((k, i))
        for places in starts.values():
            if len({k for k, _ in places} if across else places) > 1:
                for k, i in places:
                    wanted[k][i : i + length] = True
        assert all((gone[k] >= wanted[k]).all() for k in texts)
        every = repeats_brute([t.decode() for t in texts.values()], length, across)
        assert all(int(gone[k].sum()) <= n for k, (n, _, _) in zip(texts, every))


def test_names_and_words_in_order():
    rng = np.random.default_rng(3)
    for n, most in ((1, 1), (7, 2), (500, 2), (500, 40), (3000, 2000)):
        names = np.concatenate([rng.integers(0, most, n), np.zeros(5, np.int64), rng.integers(0, most, 3)]).astype(np.int64)
        names = np.unique(np.concatenate([names, names]), return_inverse=True)[1].astype(np.int64)
        assert suffix._sort_names(names).tolist() == sorted(range(len(names)), key=lambda i: names[i:].tolist())
    for kind in (np.uint8, np.uint16):
        values = rng.integers(0, 256, 21).astype(kind)
        padded = values.astype("<u%d" % values.itemsize).tobytes() + bytes(8)
        assert suffix._words(values).tolist() == [int.from_bytes(padded[i * values.itemsize :][:8], "little") for i in range(21)]
