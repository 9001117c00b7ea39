"""Licence scan: a positional index of template words, searched from each file's rarest licence words."""

from __future__ import annotations

import math
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import extended, per_batch, small_batches, table, to_arrow_schema, without
from plumbline.llm.license_texts import TEMPLATES

# Phrases that are labels by themselves.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: So many words of a template's rare part must stand where one start would have them.
AGREEING = 2
#: A match may have so many words between those of the template, and one more for each ``WORDS_PER_GAP`` of its words.
SLACK = 2
WORDS_PER_GAP = 8
LEAST_COVER = 0.8
BASE_ONLY = 0.5
OUT = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]

_SEPARATORS = bytes(b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122))
_FOLD = bytes(32 if b in _SEPARATORS else b + 32 if 65 <= b <= 90 else b for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """ASCII letters in lower case, digits and everything beyond ASCII make words."""
    return text.encode().translate(_FOLD).split() if text else []


def phrase_starts(line: bytes, phrase: str) -> list[int]:
    """Word numbers at which the phrase's words stand in a row. ``line``: the words, a blank before and after each."""
    found, sought, at, words = [], f" {phrase} ".encode(), -1, 0
    last = 0
    while (at := line.find(sought, at + 1)) >= 0:
        words += line.count(b" ", last, at)
        last = at
        found.append(words)
    return found


@dataclass(frozen=True)
class Template:
    label: str
    words: list[bytes]
    phrases: list[bytes]
    places: dict[bytes, int]  # the places of a word, as bits

    @property
    def need(self) -> int:
        """So many words must stand in order."""
        return math.ceil(LEAST_COVER * len(self.words))

    @property
    def span(self) -> int:
        """A match lies within so many words from its start."""
        return len(self.words) + SLACK + len(self.words) // WORDS_PER_GAP

    def in_order(self, words: list[bytes]) -> int:
        """The most template words that stand in ``words`` in the template's order (longest common subsequence)."""
        full = (1 << len(self.words)) - 1
        free = full
        for w in words:
            if at := self.places.get(w):
                taken = free & at
                free = ((free + taken) | (free - taken)) & full
        return len(self.words) - free.bit_count()

    def found_in(self, words: list[bytes]) -> int:
        """``in_order``, but 0 where it is too little or a mandatory phrase is missing."""
        line = b" " + b" ".join(words) + b" "
        if not all(p in line for p in self.phrases):
            return 0
        n = self.in_order(words)
        return n if n >= self.need else 0


@dataclass(frozen=True)
class Match:
    """``n`` of the template's words stand in order within its span from word ``start`` on."""

    template: int
    start: int
    n: int


class TemplateIndex:
    """Positional postings of the licence words: word to (template, place) pairs, rare words first.

    A word is posted for a template if it belongs to its rare part: its words of highest IDF, just so many that any match
    has at least ``AGREEING`` of them in place, whichever words it lacks. What the index finds is so what a try of every
    template at every start finds.
    """

    def __init__(self, templates: list[tuple[str, str, list[str]]], idf: dict[str, float]):
        self.templates: list[Template] = []
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        for t, (label, text, phrases) in enumerate(templates):
            words, places = words_of(text), {}
            for i, w in enumerate(words):
                places[w] = places.get(w, 0) | 1 << i
            template = Template(label, words, [f" {p} ".encode() for p in phrases], places)
            self.templates.append(template)
            left = len(words) - template.need + AGREEING
            for word in sorted(places, key=lambda w: (-idf.get(w.decode(), 0.0), w)):
                if left <= 0:
                    break
                here = [(t, i) for i, w in enumerate(words) if w == word]
                self.postings.setdefault(word, []).extend(here)
                left -= len(here)
        order = sorted(self.postings, key=lambda w: (-idf.get(w.decode(), 0.0), w))
        self.rank = {w: i for i, w in enumerate(order)}

    def starts(self, words: list[bytes]) -> dict[int, list[tuple[int, int]]]:
        """Per template the ranges of starts (first, last) on which ``AGREEING`` places of its rare part agree."""
        where: dict[bytes, list[int]] = {}
        for i, w in enumerate(words):
            if w in self.rank:
                where.setdefault(w, []).append(i)
        events: dict[int, list[tuple[int, int, int]]] = {}
        for word in sorted(where, key=self.rank.__getitem__):
            for t, place in self.postings[word]:
                template = self.templates[t]
                lacking = len(template.words) - template.need
                before, after = template.span - len(template.words) + lacking, lacking
                for at in where[word]:  # a match that has this word here starts in this range
                    events.setdefault(t, []).append((at - place - before, 1, place))
                    events[t].append((at - place + after + 1, -1, place))
        found = {}
        for t, marks in events.items():
            open_places: dict[int, int] = {}
            ranges, since = [], None
            for at, step, place in sorted(marks):
                open_places[place] = open_places.get(place, 0) + step
                if not open_places[place]:
                    del open_places[place]
                if len(open_places) >= AGREEING:
                    since = at if since is None else since
                elif since is not None:
                    first, last, since = max(since, 0), min(at, len(words)) - 1, None
                    if first <= last:
                        ranges.append((first, last))
            if ranges:
                found[t] = ranges
        return found

    def places(self, words: list[bytes]) -> list[Match]:
        """All starts at a word of the template from which it is found, by halving the ranges of `starts`: what is not in
        the words of all starts of a range is in those of none of them."""
        found = set()
        for t, ranges in self.starts(words).items():
            template = self.templates[t]
            left = list(ranges)
            while left:
                first, last = left.pop()
                n = template.found_in(words[first : last + template.span])
                if n and first < last:
                    middle = (first + last) // 2
                    left += [(first, middle), (middle + 1, last)]
                elif n and words[first] in template.places:
                    found.add(Match(t, first, n))
        return sorted(found, key=lambda m: (m.template, m.start))

    def best(self, places: list[Match]) -> list[Match]:
        """The best start of each chain of starts that follow closely, without those that lie (by half of their words or
        more) in a match of another template with more words in order: the two-clause form within the three-clause one."""
        chains: list[Match] = []
        before = None
        for m in places:
            template = self.templates[m.template]
            if before and before.template == m.template and m.start - before.start <= template.span - len(template.words):
                chains[-1] = m if m.n > chains[-1].n else chains[-1]
            else:
                chains.append(m)
            before = m

        def covered(m: Match, by: Match) -> bool:
            own, other = len(self.templates[m.template].words), len(self.templates[by.template].words)
            common = min(m.start + own, by.start + other) - max(m.start, by.start)
            return by.n > m.n and 2 * common >= own

        return [m for m in chains if not any(covered(m, by) for by in chains)]

    def matches(self, words: list[bytes]) -> dict[str, float]:
        """Labels whose template is in the file, with the best share of the template's words found in order."""
        if self.rank.keys().isdisjoint(words):
            return {}
        found: dict[str, float] = {}
        for m in self.best(self.places(words)):
            template = self.templates[m.template]
            found[template.label] = max(found.get(template.label, 0.0), m.n / len(template.words))
        return found


def template_idf(documents: DataFrame, templates=TEMPLATES) -> dict[str, float]:
    """IDF of the templates' words over all texts. What reaches the driver is one count per word of the templates."""
    vocabulary = sorted({w.decode() for _, text, _ in templates for w in words_of(text)})

    def count(batch):
        counts, sought = {}, {w.encode() for w in vocabulary}
        texts = batch.column("text").to_pylist()
        for text in texts:
            for w in sought.intersection(words_of(text)):
                counts[w.decode()] = counts.get(w.decode(), 0) + 1
        return {"word": [*counts, ""], "n": [*counts.values(), len(texts)]}

    sums = per_batch(documents.select("text"), count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    seen = {r[0]: r[1] for r in sums.collect()}
    total = seen.pop("", 0)
    return {w: math.log((total + 1) / (seen.get(w, 0) + 1)) for w in vocabulary}


def scan_licenses(documents: DataFrame, idf: dict[str, float], templates=TEMPLATES) -> DataFrame:
    """Add word count, base phrase places and labels to each document, by whole texts.

    The file's licence words with the highest IDF are looked up in the postings; starts on which two of a template's rare
    words agree by relative position are checked: the mandatory phrases must stand in the template's span from there, and
    ``LEAST_COVER`` of its words in order. A match within a better one of another template doesn't count. ``score`` is the
    best cover found, ``BASE_ONLY`` if only base phrases are, else 0.

    Null and empty texts have no words, no labels (empty strings), null places and score 0. Rows are scanned one by
    one: repeated rows get equal results, other columns pass unchanged, columns named as the results are replaced.
    """
    kinds = "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"
    rows, arrow = without(documents, OUT), to_arrow_schema(kinds)

    def scan(batches):
        index = TemplateIndex(templates, idf)
        for batch in small_batches(batches, "text"):
            out = {name: [] for name in OUT}
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                line = b" " + b" ".join(words) + b" "
                starts, base = [], set()
                for phrase, label in BASE_PHRASES.items():
                    if at := phrase_starts(line, phrase):
                        starts += at
                        base.add(label)
                more = index.matches(words)
                row = (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
                       ",".join(sorted(base | set(more))), max([*more.values(), BASE_ONLY if base else 0.0]))
                for name, value in zip(OUT, row):
                    out[name].append(value)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(out[f.name], f.type) for f in arrow]], names=[*batch.schema.names, *OUT]
            )

    return rows.mapInArrow(scan, extended(rows, kinds))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan_licenses(documents, template_idf(documents)).drop("text")
