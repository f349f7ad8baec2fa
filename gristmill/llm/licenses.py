"""Operator 7: license statements, by phrases and by an exact set-similarity join with templates."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import PLAIN_WORDS, arrow_rows

#: Phrase and label.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Label and wording of the statements that are sought as sets of words.
TEMPLATES = {
    "apache": "licensed under the apache license version 2 0",
    "apache-notice": "you may not use this file except in compliance with the license",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by-sa": "licensed under cc by sa 4 0",
    "cc0": "dedicated to the public domain under cc0 1 0",
    "gpl-notice": "this work is licensed under the gnu general public license version 3",
    "mit": "released under the mit license",
    "mit-notice": "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "mpl": "subject to the terms of the mozilla public license version 2 0",
}
THRESHOLD = 0.9


def plain_lines(raw: bytes | None) -> list[list[bytes]]:
    return [line.translate(PLAIN_WORDS).split() for line in (raw or b"").split(b"\n")]


def blocks(lines: list[list[bytes]], reach: int) -> Iterator[list[bytes]]:
    """Every line with words, and the ``reach`` words after it: a statement that starts in a line ends in its block."""
    for i, line in enumerate(lines):
        if line:
            after: list[bytes] = []
            for more in lines[i + 1 :]:
                after += more[: reach - len(after)]
                if len(after) >= reach:
                    break
            yield line + after


def _frequencies(vocabulary: frozenset):
    """Lines that hold a word of the templates, one row per word and batch."""

    def make(columns: list[list]) -> list:
        seen: Counter = Counter()
        for raw in columns[0]:
            for words in plain_lines(raw):
                seen.update(vocabulary.intersection(words))
        return [[w.decode() for w in seen], list(seen.values())]

    return make


class Index:
    """Prefixes of the templates under the global order of the words, rarest first."""

    def __init__(self, templates: dict[str, str], counts: dict[str, int], threshold: float):
        self.sets: list[tuple[str, frozenset, int, int]] = []
        self.prefixes: dict[bytes, list[tuple[int, int]]] = {}
        for label, wording in sorted(templates.items()):
            words = sorted(set(wording.encode().translate(PLAIN_WORDS).split()), key=lambda w: (counts.get(w.decode(), 0), w))
            need = math.ceil(threshold * len(words) - 1e-9)
            for place, word in enumerate(words[: len(words) - need + 1]):
                self.prefixes.setdefault(word, []).append((len(self.sets), place))
            self.sets.append((label, frozenset(words), len(words), need))
        self.first = frozenset(self.prefixes)
        #: Words of the longest statement.
        self.reach = max((len(wording.encode().translate(PLAIN_WORDS).split()) for wording in templates.values()), default=0)

    def matches(self, words: list[bytes]) -> list[tuple[str, float]]:
        """Labels of the templates that a block contains, with the share of the template's words it has."""
        block = frozenset(words)
        met: dict[int, list[int]] = {}
        for word in self.first & block:
            for template, place in self.prefixes[word]:
                met.setdefault(template, []).append(place)
        found = []
        for template, places in met.items():
            label, wanted, size, need = self.sets[template]
            # Length filter; then by position: before the first match nothing is shared, after the last all may be.
            if len(block) >= need and len(places) + size - max(places) - 1 >= need:
                shared = len(wanted & block)
                if shared >= need:
                    found.append((label, shared / size))
        return found


def _places(words: list[bytes], phrase: bytes) -> list[int]:
    """Positions of the words at which the phrase starts."""
    text, sought = b" " + b" ".join(words) + b" ", b" " + phrase + b" "
    found, at, words_before, counted = [], text.find(sought), 0, 0
    while at >= 0:
        words_before += text.count(b" ", counted, at)
        counted = at
        found.append(words_before)
        at = text.find(sought, at + 1)
    return found


def _scan(index: Index, phrases: dict[str, str]):
    sought = [(phrase.encode(), label) for phrase, label in phrases.items()]

    def make(columns: list[list]) -> list:
        out: list[list] = [columns[0], [], [], [], [], [], [], []]
        for raw in columns[1]:
            lines = plain_lines(raw)
            words = [word for line in lines for word in line]
            known = frozenset(words)
            places: list[int] = []
            base: set[str] = set()
            for phrase, label in sought:
                if known.issuperset(phrase.split()) and (at := _places(words, phrase)):
                    places += at
                    base.add(label)
            more = {}
            if not index.first.isdisjoint(known):
                for block in blocks(lines, index.reach):
                    for label, share in index.matches(block):
                        more[label] = max(share, more.get(label, 0.0))
            row = (
                len(words), len(places), min(places, default=None), max(places, default=None),
                ",".join(sorted(base)), ",".join(sorted(base | set(more))),
                1.0 if base else max(more.values(), default=0.0),
            )
            for column, value in zip(out[1:], row):
                column.append(value)
        return out

    return make


def license_labels(
    documents: DataFrame,
    phrases: dict[str, str] | None = None,
    templates: dict[str, str] | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """License phrases and statements of every document.

    ``documents`` needs doc_id and text. One row per input row: doc_id, n_words, n_base (places where a phrase
    stands), first_word and last_word (smallest and largest place, counted in words; null without a place),
    base_labels, labels (those of the templates too; sorted, joined by commas, empty if none), score (1 if a
    phrase stands, else the largest share of a template that a block contains, 0 if none reaches the threshold).
    A null text counts as empty. Rows are judged one by one, repeated ones alike; other columns are ignored.

    A block is a line with as many of the words after it as the longest template has, so a statement may run over any
    number of lines; it contains a template if it has ``threshold`` of its distinct words. The words of the templates
    are ordered by the number of lines that hold them in the whole table; a block that contains a template shares a
    word with its rarest words (the prefix), has as many words as needed, and its matches leave enough words
    after them. What passes is verified. The driver holds the templates and one count per word of theirs.
    """
    phrases, templates = phrases or PHRASES, templates or TEMPLATES
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    vocabulary = frozenset(w for t in templates.values() for w in t.encode().translate(PLAIN_WORDS).split())
    counted = arrow_rows(rows.select("text"), _frequencies(vocabulary), "word string, n long")
    counts = {row["word"]: row["n"] for row in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    schema = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double"
    )
    return arrow_rows(rows, _scan(Index(templates, counts, threshold), phrases), schema)
