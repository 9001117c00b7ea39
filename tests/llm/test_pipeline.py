"""The pipeline's stages one by one on small tables, each against a plain version of what it decides."""

import hashlib
from collections import Counter

import pytest

import corpus_pipeline
from plumbline.llm import pieces, quality, queries, stages
from tests.llm.test_pair_operators import near_brute, repeats_brute
from tests.llm.test_text_operators import ODD, base_counts

SF = "/root/testdata/sf0.001"
ROWS = [None, "", "a b c", *ODD[3:8], "clean words here " + " ".join(f"w{i}" for i in range(60)), "x " * 200]


@pytest.fixture(scope="module")
def documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(10_000 + i, t, "en", None if i % 2 else "src0", 1) for i, t in enumerate(ROWS)] + [(None, ROWS[-2], None, None, None)], docs.schema)
    return docs.unionByName(extra).cache()


def stage(n):
    return corpus_pipeline.STAGES[n][1]


def test_quality_rejects_by_the_base_rules_and_keeps_clean_texts(spark, documents):
    kept = stage(0)(spark, documents, SF)
    assert kept.columns == documents.columns
    ids = {r.doc_id for r in kept.collect()}
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    for r in documents.collect():
        n, _, _, _, repeated = base_counts(r.text)
        failed = n < quality.LEAST_WORDS or 100 * repeated > quality.MOST_REPEATED * n
        assert not (failed and r.doc_id in ids)
        assert failed or r.doc_id not in good or r.doc_id in ids


def test_one_of_each_group_stays(spark, documents):
    rows = documents.where("doc_id is not null").orderBy("doc_id").collect()
    got = {r.doc_id for r in stage(1)(spark, documents, SF).collect()}
    _, reach = near_brute([r.text for r in rows])
    assert got == {rows[i].doc_id for i, c in reach.items() if i == c}  # the row without an id copies one that has one


def test_repeated_passages_go(spark, documents):
    rows = documents.collect()
    expected = Counter((r.doc_id, kept.decode("utf-8", "ignore")) for r, (_, _, kept) in zip(rows, repeats_brute([r.text for r in rows], stages.PASSAGE, across=True)))
    got = stage(2)(spark, documents, SF).collect()
    assert Counter((r.doc_id, r.text or "") for r in got) == expected
    before = {r.doc_id: r.text for r in rows}
    assert all(r.n_chars == len(r.text) for r in got if r.text is not None and before[r.doc_id] != r.text)


def test_mix_repeats_and_drops_whole_documents(spark, documents):
    got = stage(3)(spark, documents, SF)
    assert got.columns == documents.columns
    times = Counter((r.doc_id, r.text) for r in got.collect())
    assert max(times.values()) <= 2 and sum(times.values()) > documents.count()


def test_every_document_is_encoded(spark, documents):
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.MODEL))
    got = stage(4)(spark, documents, SF).collect()
    assert len(got) == documents.count()
    for r in got[:50]:
        ids = model.encode(r.text or "")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


@pytest.mark.parametrize("n", range(5))
def test_no_documents(spark, documents, n):
    assert stage(n)(spark, documents.limit(0), SF).count() == 0


def test_all_queries_are_registered(spark):
    assert sorted({int(k[2:].split("_")[0]) for k in queries.QUERIES}) == list(range(1, 14))
    assert [name for name, _ in corpus_pipeline.STAGES] and corpus_pipeline.run(spark, SF).count() > 0


def test_clashing_columns_pass_through(spark, documents):
    """Columns named like an operator's own come out as they went in, but for those the last stage returns itself."""
    names = ["kept", "n_words", "size", "taken", "key", "lo", "id", "bucket", "component_id"]
    docs = documents.limit(60).selectExpr("*", *[f"doc_id + {i} AS {n}" for i, n in enumerate(names)])
    for n in range(4):
        got = stage(n)(spark, docs, SF)
        assert got.columns == docs.columns
        assert all(r[name] == r.doc_id + i for r in got.collect() if r.doc_id is not None for i, name in enumerate(names))
    last = stage(4)(spark, docs.selectExpr("*", "1 AS ids", "2 AS n_tokens"), SF)
    assert last.count() == 60 and "ids" not in last.columns
