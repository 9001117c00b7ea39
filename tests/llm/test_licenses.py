"""The licence index against a try of every template at every start, and whole licences in running text."""

import random

import pytest

from plumbline.llm import licenses
from plumbline.llm.license_texts import BODIES, NOTICES, TEMPLATES
from plumbline.llm.licenses import Match, TemplateIndex, words_of

FILLER = "lorem of the and dolor software sit license amet to permission".encode().split()


def common_in_order(a, b):
    """Longest common subsequence by the table."""
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[j], row[j + 1]))
        row = new
    return row[-1]


def every_place(words, templates):
    found = []
    for t, (_, text, phrases) in enumerate(templates):
        own = words_of(text)
        span = len(own) + licenses.SLACK + len(own) // licenses.WORDS_PER_GAP
        for start, word in enumerate(words):
            near = words[start : start + span]
            if word in own and all(f" {p} " in f" {b' '.join(near).decode()} " for p in phrases):
                n = common_in_order(own, near)
                if n >= licenses.LEAST_COVER * len(own):
                    found.append(Match(t, start, n))
    return found


def changed(rng, words, rate):
    out = []
    for w in words:
        x = rng.random()
        if x > rate:
            out.append(w)
        elif x > rate / 2:
            out += [w, rng.choice(FILLER)]
    return out


@pytest.mark.parametrize("seed", range(6))
def test_index_finds_what_every_start_finds(seed):
    rng = random.Random(seed)
    templates = [t for t in TEMPLATES if len(words_of(t[1])) < 45]
    vocabulary = sorted({w.decode() for t in templates for w in words_of(t[1])})
    idf = {w: rng.choice([0.0, 1.0, rng.random() * 9]) for w in vocabulary} if seed else {}
    index = TemplateIndex(templates, idf)
    hits = 0
    for _ in range(12):
        words = []
        for _ in range(rng.randrange(1, 4)):
            words += rng.choices(FILLER, k=rng.randrange(12))
            words += changed(rng, words_of(rng.choice(templates)[1]), rng.choice([0, 0.05, 0.15, 0.3]))
        got = index.places(words)
        assert got == every_place(words, templates)
        hits += len(got)
    assert hits


def test_order_by_bits_is_the_longest_common_subsequence():
    rng = random.Random(2)
    index = TemplateIndex(TEMPLATES, {})
    for template in index.templates:
        for rate in (0, 0.1, 0.5):
            words = changed(rng, template.words, rate)
            assert template.in_order(words) == common_in_order(template.words, words)
        assert template.in_order([]) == 0 and template.found_in(template.words) == len(template.words)


def test_whole_licences_carry_their_own_label():
    index = TemplateIndex(TEMPLATES, {})
    noticed = {label for label, _, _ in NOTICES}
    assert len({label for label, _, _ in BODIES}) >= 25
    for label, text, phrases in BODIES:
        words = FILLER * 3 + words_of(text.upper()) + FILLER
        assert index.matches(words) == {label: 1.0}
        line = b" ".join(words)
        for phrase in phrases:  # without a mandatory phrase only a notice can carry the label
            assert label in noticed or label not in index.matches(line.replace(phrase.encode(), b"").split())
        if not any(" and " in p for p in phrases):  # further words between those of the template
            assert index.matches(line.replace(b" and ", b" and also ").split()) == {label: 1.0}
        assert index.matches(sorted(words)) == {}


def test_notices_and_several_licences_in_a_file(spark):
    bodies = {label: text for label, text, _ in BODIES}
    texts = [
        bodies["mit"] + "\n\n" + bodies["bsd-2-clause"] + "\n" + bodies["mit"],
        "# Licensed under the Apache License, Version 2.0 (the License)",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This "
        "program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "granted permission software free", bodies["zlib"] * 40, None, "",
    ]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = licenses.scan_licenses(documents, licenses.template_idf(documents)).orderBy("doc_id").collect()
    assert [r["labels"] for r in rows] == ["bsd-2-clause,mit", "apache-2.0", "gpl,gpl-3.0", "", "zlib", "", ""]
    assert [r["score"] for r in rows] == [1, 1, 1, 0, 1, 0, 0]
