"""License scans as an exact set-similarity join of text blocks with templates.

A block is a line of a text, or a window of consecutive words that may run
over line ends, half as long again as the template (see ``width``); a template
is a short license notice. A template is found where a block holds at least
``THRESHOLD`` of its distinct words. Paragraphs are no blocks: a long text
without blank lines would be one set of words, which holds short templates by
chance. Template words are ordered by how often they occur in the whole corpus,
rarest first. By the prefix filter a block can only reach the threshold if it
holds one of a template's first (size - needed + 1) words; so only lines with
such a word, and windows around one, are looked at. A length filter (distinct
words of the block) and, in lines, a positional filter (words left after the
common one, on either side) drop more; what stays is verified by counting
common words. The templates are a fixed list, so their index goes to every
task; the corpus is read twice, once for the word counts, and never shuffled.

The base labels are exact phrases. Null text is an empty text, without words
and labels, score 0. Repeated rows give repeated results, an empty table none.
A line longer than a template's
windows is no block for it but is looked through in windows like the rest, so
line breaks do not change what is found."""

from __future__ import annotations

import math
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_exact

THRESHOLD = 0.9
PHRASES = {
    b"gnu general public license": "gpl",
    b"apache license": "apache",
    b"cc by": "cc-by",
    b"mit license": "mit",
}
#: Opening words of public license notices, by label.
TEMPLATES = (
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl", "licensed under the gnu general public license version"),
    ("lgpl", "licensed under the gnu lesser general public license version"),
    ("apache", "licensed under the apache license version"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("cc-by", "licensed under cc by"),
    ("cc-by", "this work is licensed under a creative commons attribution international license"),
    ("cc-by-nc", "licensed under cc by nc"),
    ("cc-by-sa", "licensed under cc by sa"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
)

#: A-Z to lower case; every other ASCII character but 0-9 and a-z is a blank.
FOLD = bytes(
    [
        b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
        for b in range(256)
    ]
)


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(FOLD).split()


def width(n_words: int) -> int:
    """Words of a window: room for comment marks, versions, "the terms of"."""
    return n_words + max(4, n_words // 2)


class Index:
    """Templates with their words in corpus order, and prefixes by word."""

    def __init__(self, counts: dict[bytes, int], threshold: float, templates=TEMPLATES):
        self.order = lambda w: (counts.get(w, 0), w)
        self.rank = {w: n for n, w in enumerate(sorted({w for _, t in templates for w in t.encode().split()}, key=self.order))}
        self.templates = []
        self.widths = []
        self.prefix: dict[bytes, list[tuple[int, int]]] = {}
        for n, (label, text) in enumerate(templates):
            ordered = sorted(set(text.encode().split()), key=self.order)
            needed = max(1, math.ceil(threshold * len(ordered) - 1e-9))
            self.templates.append((label, ordered, frozenset(ordered), needed))
            self.widths.append(width(len(text.split())))
            for at, word in enumerate(ordered[: len(ordered) - needed + 1]):
                self.prefix.setdefault(word, []).append((n, at))
        self.first = frozenset(self.prefix)
        self.least_width = min(self.widths, default=0)

    def matches(self, block: set[bytes], n_words: int = 0) -> dict[int, float]:
        """Templates found in a block of so many words, with the share of their
        words. Of a block longer than a template's windows only those count."""
        met = block & self.first
        if not met:
            return {}
        # words outside the templates can't be common: only the others are ordered
        known = sorted((w for w in block if w in self.rank), key=self.rank.__getitem__)
        place = {w: n for n, w in enumerate(known)}
        out: dict[int, float] = {}
        tried = set()
        for word in sorted(met, key=place.__getitem__):
            for n, at in self.prefix[word]:
                if n in tried:
                    continue
                tried.add(n)  # the first common prefix word decides
                if n_words > self.widths[n]:
                    continue
                _, ordered, whole, needed = self.templates[n]
                if len(known) < needed:  # length filter
                    continue
                if 1 + min(len(ordered) - at - 1, len(known) - place[word] - 1) < needed:  # positional filter
                    continue
                common = len(whole & block)
                if common >= needed:
                    out[n] = common / len(ordered)
        return out


    def windows(self, words: list[bytes], whole_text: set[bytes]) -> dict[int, float]:
        """Templates found in windows of a text's words, with the share of their
        words in the fullest window. Every template word is passed once."""
        out: dict[int, float] = {}
        places: dict[bytes, list[int]] | None = None
        for n in {n for word in whole_text & self.first for n, _ in self.prefix[word]}:
            _, ordered, whole, needed = self.templates[n]
            if len(whole & whole_text) < needed:  # length filter on the text
                continue
            if places is None:
                places = {}
                for at, word in enumerate(words):
                    if word in self.rank:
                        places.setdefault(word, []).append(at)
            reach = self.widths[n]
            met = [self.rank[word] for word in ordered if word in places]
            prefix = [
                word
                for at, word in enumerate(ordered[: len(ordered) - needed + 1])
                # positional filter on the text: template words from this one on
                if word in places and sum(r >= self.rank[word] for r in met) >= needed
            ]
            firsts = sorted(at for word in prefix for at in places[word])
            best = self._fullest(words, firsts, whole, needed, reach)
            if best >= needed:
                out[n] = best / len(ordered)
        return out

    @staticmethod
    def _fullest(words: list[bytes], firsts: list[int], whole: frozenset[bytes], needed: int, reach: int) -> int:
        """Most distinct words of ``whole`` in ``reach`` words in a row that hold a prefix word."""
        best, k = 0, 0
        while k < len(firsts):
            start, end = max(0, firsts[k] - reach + 1), firsts[k] + reach
            k += 1
            while k < len(firsts) and firsts[k] - reach < end:  # ranges that meet are one
                end = firsts[k] + reach
                k += 1
            part = words[start:end]
            if len(whole.intersection(part)) < needed:  # length filter on the range
                continue
            held: Counter = Counter()
            for at, word in enumerate(part):
                if at >= reach and part[at - reach] in whole:
                    gone = part[at - reach]
                    held[gone] -= 1
                    if not held[gone]:
                        del held[gone]
                if word in whole:
                    held[word] += 1
                    best = max(best, len(held))
        return best


def word_counts(docs: DataFrame, templates=TEMPLATES) -> dict[bytes, int]:
    """Lines of the corpus that hold each template word: a table of fixed size."""
    wanted = frozenset(w for _, t in templates for w in t.encode().split())

    def run(batches):
        total: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                for line in (text or "").encode().split(b"\n"):
                    total.update(wanted.intersection(line.translate(FOLD).split()))
        yield pd.DataFrame({"word": list(total), "n": list(total.values())}).astype({"n": "int64"})

    rows = docs.select("text").mapInPandas(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {bytes(r["word"]): r["n"] for r in rows}


def base_places(words: list[bytes]) -> list[tuple[int, str]]:
    """(word number, label) of every phrase."""
    joined = b" " + b" ".join(words) + b" "
    out = []
    for phrase, label in PHRASES.items():
        needle = b" " + phrase + b" "
        at = joined.find(needle)
        while at >= 0:
            out.append((joined.count(b" ", 0, at), label))
            at = joined.find(needle, at + 1)
    return out


def scan(text: str | None, index: Index) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score."""
    words = words_of(text) if text else []
    base = base_places(words) if words else []
    found: dict[int, float] = {}
    if not index.first.isdisjoint(words):
        lines = text.encode().split(b"\n")
        blocks = []
        for line in lines:
            own = line.translate(FOLD).split()
            blocks.append(index.matches(set(own), len(own)))
        if len(lines) > 1 or len(words) > index.least_width:  # else the line holds every window
            blocks.append(index.windows(words, set(words)))
        for block in blocks:
            for n, share in block.items():
                found[n] = max(share, found.get(n, 0.0))
    named = {label for _, label in base}
    labels = named | {index.templates[n][0] for n in found}
    places = [at for at, _ in base]
    return (
        len(words),
        len(base),
        min(places, default=None),
        max(places, default=None),
        ",".join(sorted(named)),
        ",".join(sorted(labels)),
        max(found.values(), default=0.0),
    )


def scan_licenses(docs: DataFrame, threshold: float = THRESHOLD, templates=TEMPLATES) -> DataFrame:
    """One row per document; see ``scan``."""
    counts = word_counts(docs, templates)
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]

    def run(batches):
        index = Index(counts, threshold, templates)
        for batch in batches:
            rows = [(d, *scan(t, index)) for d, t in zip(batch["doc_id"], batch["text"])]
            frame = pd.DataFrame(rows, columns=names)
            yield frame.astype({"doc_id": "Int64", "first_word": "Int64", "last_word": "Int64"})

    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return map_exact(docs.select("doc_id", "text"), run, schema)
