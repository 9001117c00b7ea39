import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from plumbline.llm import licenses, pieces, quality, toxicity

ODD = [
    None, "", " ", "\n\n", "a", "a\nb\na\na", "one two three one two three", "x# $y|z <q>", "É ünï code  x",
    "\x1c\x85 a b", "tab\tvt\x0bff\x0ccr\r\n end", "word " * 3000, "\n".join(["same line here"] * 70), "no newline" * 4000,
]
SCHEMA = "doc_id bigint, text string, kept string, score string, IDS int"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "k", "s", 1) for i, t in enumerate(texts)] + [(None, "a b", None, None, None)], SCHEMA)


def base_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = list(zip(words, words[1:], words[2:]))
    times = Counter(windows)
    repeated = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeated))


def test_base_counts_match_brute_force(spark):
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice("ab \n#é\t") for _ in range(rng.randrange(300))) for _ in range(60)]
    got = quality.judge_quality(frame(spark, texts), quality.PRIOR).where("doc_id is not null").orderBy("doc_id").collect()
    for row, text in zip(got, texts):
        expected = base_counts(text)
        assert tuple(row[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == expected, repr(text)
        assert row["base_failed"] == (expected[0] < 50 or 100 * expected[4] > 50 * expected[0])
        assert row["kept"] is False or not row["base_failed"]


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(0)
    for n in range(1, 9):
        lean, change, first = rng.normal(size=n), rng.normal(size=(2, 2)), rng.normal(size=2)

        def value(path):
            return first[path[0]] + sum(lean[i] for i in range(n) if path[i]) + sum(change[a, b] for a, b in zip(path, path[1:]))

        best = max(([int(b) for b in f"{i:0{n}b}"] for i in range(2**n)), key=value)
        assert quality.viterbi(lean.tolist(), change.tolist(), first.tolist()) == best
    assert quality.viterbi([], [[0, 0], [0, 0]], [0, 0]) == []


def test_line_model_learns_and_empty_tables(spark):
    rng = random.Random(5)

    def line(poor):
        words = ["".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(12)]
        return " | ".join(words) if poor else " ".join(words) + "."

    docs = [(i, "\n".join(line(i % 4 == 0) for _ in range(8)), None) for i in range(200)]
    documents = spark.createDataFrame(docs, "doc_id bigint, text string, extra int")
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(0, 200)] + [(None, 1, 0), (3, None, 0)], "doc_id bigint, quality int, toxic int")
    model = quality.fit_on(documents, labels)
    got = {r["doc_id"]: r["kept"] for r in quality.judge_quality(documents, model).collect()}
    assert all(got[i] == (i % 4 != 0) for i in got)
    empty = documents.limit(0)
    assert quality.fit_on(empty, labels) == quality.PRIOR and quality.fit_on(documents, labels.limit(0)) == quality.PRIOR
    assert quality.judge_quality(empty, model).count() == 0


def test_license_base_matches_brute_force(spark):
    texts = ODD + ["Cc-By cc by, CC BY cc", "the GNU General Public License; all RIGHTS reserved", "ccby ccé by cc by", "General\nPublic\tLicense"]
    got = licenses.scan_licenses(frame(spark, texts), {}).where("doc_id is not null").orderBy("doc_id").collect()
    for row, text in zip(got, texts):
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        starts, labels = [], set()
        for phrase, label in licenses.BASE_PHRASES.items():
            p = phrase.split()
            at = [i for i in range(len(words)) if words[i : i + len(p)] == p]
            starts += at
            labels |= {label} if at else set()
        assert (row["n_words"], row["n_base"]) == (len(words), len(starts))
        assert (row["first_word"], row["last_word"]) == ((min(starts), max(starts)) if starts else (None, None))
        assert row["base_labels"] == ",".join(sorted(labels)) and labels <= set(row["labels"].split(",")) and 0 <= row["score"] <= 1


def test_licenses_are_found_by_position(spark):
    mit = licenses.TEMPLATES[1][1]
    shuffled = " ".join(sorted(mit.split()))
    texts = ["intro words " + mit.upper() + " more", shuffled, "released under the MIT License.", "mit and license apart", "of the to in " * 50]
    documents = frame(spark, texts)
    got = licenses.scan_licenses(documents, licenses.template_idf(documents)).where("doc_id is not null").orderBy("doc_id").collect()
    assert [r["labels"] for r in got] == ["mit", "", "mit", "", ""] and got[0]["score"] == 1.0
    assert licenses.template_idf(documents.limit(0)) and licenses.scan_licenses(documents.limit(0), {}).count() == 0


@pytest.fixture(scope="module")
def processor():
    import public_tokenizers
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))


def test_ids_and_spans(spark, processor):
    rng = random.Random(11)
    texts = ODD + ["▁a ▁", "日本語 と 😀", "\x00null\x01", "  lead and trail  ", "12345 67"]
    texts += ["".join(chr(rng.choice([32, 32, 97, 98, 233, 0x4E2D, 0x1F600, 0x2581, 10])) for _ in range(rng.randrange(80))) for _ in range(80)]
    got = pieces.encode_documents(frame(spark, texts)).where("doc_id is not null").orderBy("doc_id").collect()
    for row, text in zip(got, texts):
        text = text or ""
        ids = processor.encode(text)
        assert row["ids"] == ids and row["decoded"] == processor.decode(ids) if ids else row["ids"] == [] and row["decoded"] == ""
        ends = row["piece_ends"]
        assert len(ends) == len(ids) and ends == sorted(ends) and (not ids or ends[-1] == len(text.encode()))
        begin = 0
        for i, end in zip(ids, ends):
            surface = text.encode()[begin:end]
            begin = end
            piece = processor.id_to_piece(i)
            if not processor.is_byte(i):
                assert piece.replace("▁", " ").lstrip(" ") == surface.decode().replace("▁", " ").lstrip(" ")
    digests = {r["doc_id"]: r for r in pieces.digests(pieces.encode_documents(frame(spark, texts)), "doc_id").collect()}
    ids = processor.encode(texts[-1])
    assert digests[len(texts) - 1]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert pieces.encode_documents(frame(spark, []).limit(0)).count() == 0


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "identity"])
def test_longest_prefixes_as_the_library_normalises(rule):
    import sentencepiece

    library = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    from sentencepiece import sentencepiece_model_pb2

    spec = sentencepiece_model_pb2.ModelProto()
    spec.ParseFromString(library.serialized_model_proto())
    spec = spec.normalizer_spec
    ours = pieces.Normalizer(spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces)
    for text in ["ＡＢＣ ｶﾞ ﬁne Å Ä", "ẛ̣ ① ㈱ …", "a\tb　c", "Straße ΑΣ", "가각 é 😀", "​x­", "", "  a  b ", " ", "　"]:
        shaped, align = ours(text)
        assert shaped.replace("▁", " ") == library.normalize(text).replace("▁", " ")
        assert len(align) == len(shaped.encode()) + 1 and (np.diff(align) >= 0).all()
        assert align[-1] == len(text.encode()) or spec.remove_extra_whitespaces and align[-1] < len(text.encode())


def test_extra_blanks_go_where_the_model_says():
    norm = pieces.Normalizer(b"", True, True)
    shaped, align = norm("  ab   c ")
    assert shaped == "▁ab▁c" and align.tolist() == [2, 2, 2, 2, 3, 4, 4, 4, 7, 8]
    assert norm("   ")[0] == "" and norm("")[0] == ""


def test_gradients_match_differences():
    rng = np.random.default_rng(2)
    net = toxicity.Network([b"w"], dtype=np.float64)
    added = rng.normal(size=(3, 5, 2, 3 * toxicity.HIDDEN))
    mask = np.array([[1, 1, 1, 1, 1], [1, 1, 1, 0, 0], [1, 0, 0, 0, 0]], bool)
    d_logit = rng.normal(size=3)
    _, tape = net.forward(added, mask, True)
    g, d_added = net.gradients(added, mask, d_logit, tape)

    def loss():
        return float(net.forward(added, mask) @ d_logit)

    for name in ("again", "look", "ask", "out", "base"):
        for at in [tuple(rng.integers(s) for s in net.p[name].shape) for _ in range(4)]:
            kept = net.p[name][at]
            net.p[name][at] = kept + 1e-6
            up = loss()
            net.p[name][at] = kept - 1e-6
            down = loss()
            net.p[name][at] = kept
            assert abs((up - down) / 2e-6 - g[name][at]) < 1e-5, name
    for at in [tuple(rng.integers(s) for s in added.shape) for _ in range(10)]:
        kept = added[at]
        added[at] = kept + 1e-6
        up = loss()
        added[at] = kept - 1e-6
        down = loss()
        added[at] = kept
        assert abs((up - down) / 2e-6 - d_added[at]) < 1e-5


def test_windows_cover_texts_and_overlap():
    for n in range(0, 200):
        begins = toxicity.windows(n)
        assert begins[0] == 0 and begins[-1] + toxicity.WINDOW >= n and (n <= toxicity.WINDOW or begins[-1] < n)
        assert all(b - a == toxicity.STRIDE for a, b in zip(begins, begins[1:]))


def test_toxic_words_are_learnt(spark):
    rng = random.Random(1)
    plain = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(400)]

    def text(toxic):
        words = [rng.choice(plain) for _ in range(rng.randrange(20, 200))]
        for _ in range(3 * toxic):
            words[rng.randrange(len(words))] = rng.choice(["zzbad", "qqworse", "xxvile"])
        return " ".join(words)

    net = toxicity.train([text(i % 5 == 0) for i in range(300)], np.array([i % 5 == 0 for i in range(300)]))
    texts = [text(i % 5 == 0) for i in range(100)] + ODD
    got = toxicity.score_documents(frame(spark, texts), net).where("doc_id is not null").orderBy("doc_id").collect()
    right = sum((r["score"] >= 0.3) == (i % 5 == 0) for i, r in enumerate(got[:100]))
    assert right >= 97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert got[100]["score"] == got[101]["score"]  # null and empty


def test_toxicity_without_labels(spark):
    documents = frame(spark, ["a b", None])
    labels = spark.createDataFrame([(0, None, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    assert toxicity.train_on(documents, labels) is None
    assert [r["score"] for r in toxicity.score_documents(documents, None).collect()] == [0.0] * 3
    assert pa.array([1]) is not None


def test_spans_of_the_query_cut_the_source(spark, processor, tmp_path):
    """Through the registered query: spans, cut from the source, give the pieces back."""
    rng = random.Random(4)
    texts = [*ODD, "日本語 ▁ 😀 x", *["".join(rng.choice(["a", " ", "é", "日", "the ", "\n", "😀"]) for _ in range(200)) for _ in range(20)]]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    for row in pieces.op6_pieces(spark, str(tmp_path)).collect():
        source = (texts[row.doc_id] or "").encode()
        ends, at = [], 0
        for i in processor.encode(texts[row.doc_id] or ""):
            if processor.is_byte(i):
                width = 1
            else:
                piece = processor.id_to_piece(i)
                first = piece.startswith("▁") and not ends and not source.startswith("▁".encode()) and source[:1] != b" "
                written = piece[1:] if first else piece
                width = 0
                for c in written:  # a mark stands for a blank, unless the source has the mark itself
                    width += 1 if c == "▁" and source[at + width : at + width + 1] == b" " else len(c.encode())
            at += width
            ends.append(at)
        assert row.n_covered == len(source) and row.n_tokens == len(ends)
        if source[:1] != b" ":
            assert row.piece_ends_sha256 == hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()


def test_one_path_normalises_with_and_without_a_map():
    """A blank inside of what a key turns into stays; what can begin no key is copied."""
    plain = pieces.Normalizer(b"", True, False)
    shaped, align = plain("a é")
    assert shaped == "▁a▁é" and align.tolist() == [0, 0, 0, 0, 1, 1, 1, 2, 3, 4]
    assert not plain.begins.any()
    assert pieces.Normalizer(b"", False, True)("  a   b ")[0] == "a▁b"
    assert pieces.Normalizer(b"", True, True)("   ")[0] == ""
