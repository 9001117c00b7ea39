"""Near-dedup and passages over rows whose ids repeat or are null: nothing clean vanishes."""

from collections import Counter

import corpus_pipeline


def words(name, n=120):
    return " ".join(f"{name}{i}" for i in range(n))


def test_rows_are_judged_one_by_one(spark):
    a, b, c, d, e = map(words, "abcde")
    near = a.replace("a60", "zz")
    rows = [
        (1, a), (1, a), (1, a),  # the same document three times
        (2, near), (2, b),  # one text is a near copy, the other is unique
        (3, c), (None, c),  # a copy without an id
        (None, d), (None, d),  # copies among rows without an id
        (4, e), (4, e.replace("e60", "zz")),  # near copies of one id
        (5, " "), (5, " "), (None, None),  # no words
    ]
    assert min(len(t or "") for _, t in rows[:11]) >= 400
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(5)
    near_dedup, passages = corpus_pipeline.STAGES[1][1], corpus_pipeline.STAGES[2][1]
    kept = near_dedup(spark, docs, None)
    assert kept.columns == docs.columns
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    of_four = [k for k in got if k[0] == 4]
    assert len(of_four) == 1 and of_four[0][1] in {e, e.replace("e60", "zz")}
    assert got == Counter([(1, a), (2, b), (3, c), (None, d), of_four[0], (5, " "), (5, " "), (None, None)])
    left = Counter((r.doc_id, r.text) for r in passages(spark, kept, None).collect())
    assert left == got
