"""Licence scan with a positional index of rare words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.llm.batches import stage_batched
from tabkit.llm.words import ALNUM, Words, split_words, utf8, words_of


@dataclass(frozen=True)
class Template:
    """A licence notice and its mandatory key phrases, in the order they stand in the text.

    Key phrases have to stand word for word; between them a file's wording may
    shift by up to SLACK words, so "version 2" after a long name is met in the
    usual variants.
    """

    label: str
    text: str
    keys: tuple[str, ...]


# The base phrases: fixed values of the result's definition.
BASE = (
    Template("mit", "under the mit license", ("under the mit license",)),
    Template("apache-2", "apache license version 2", ("apache license version 2",)),
    Template("cc-by-nc", "cc by nc", ("cc by nc",)),
)
# Well-known notices, in lower case without punctuation.
NOTICES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ("permission is hereby granted",)),
    Template("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", ("apache license version 2 0",)),
    Template("gpl-3", "this work is licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("gpl-2", "this work is licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    Template(
        "gpl-3",
        "under the terms of the gnu general public license as published by the free software foundation either version 3 of the license",
        ("gnu general public license", "free software foundation", "version 3"),
    ),
    Template(
        "gpl-2",
        "under the terms of the gnu general public license as published by the free software foundation either version 2 of the license",
        ("gnu general public license", "free software foundation", "version 2"),
    ),
    Template("gpl-3", "gnu general public license v3", ("gnu general public license v3",)),
    Template("gpl-2", "gnu general public license v2", ("gnu general public license v2",)),
    Template("lgpl", "licensed under the gnu lesser general public license", ("gnu lesser general public license",)),
    Template("mpl-2", "subject to the terms of the mozilla public license version 2 0", ("mozilla public license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("redistribution and use in source",)),
    Template("cc-by", "licensed under a creative commons attribution license", ("creative commons attribution",)),
    Template("proprietary", "all rights reserved", ("all rights reserved",)),
    *(
        Template(label, f"spdx license identifier {name}", (f"spdx license identifier {name}",))
        for label, name in (("mit", "mit"), ("apache-2", "apache 2 0"), ("gpl-3", "gpl 3 0"), ("gpl-2", "gpl 2 0"), ("lgpl", "lgpl"), ("mpl-2", "mpl 2 0"), ("bsd", "bsd"))
    ),
)
# Words a file's notice may be longer or shorter than the template between two places.
SLACK = 4
# Rare words of a file that have to agree on a phrase's start before it is verified.
LOOKUPS = 2


def _hashes(text: str) -> np.ndarray:
    data, at = utf8(pa.array([text]))
    return split_words(data, at, ALNUM, lower=True).hashes()


class Index:
    """Positional index of the key phrases: licence word -> (phrase, position) postings.

    Words are numbered by falling IDF, so a file's rarest licence words are its
    smallest numbers.
    """

    def __init__(self, templates: tuple[Template, ...], idf: dict[int, float]):
        self.templates = templates
        known = licence_words(templates)
        weight = np.array([idf.get(int(x), 0.0) for x in known])
        order = np.lexsort((known, -weight))
        self.known, self.weight = known, weight[order]
        self.number = np.empty(len(known), dtype=np.int64)  # of known[i]
        self.number[order] = np.arange(len(known))
        texts: dict[str, int] = {}
        self.words, self.parts = [], []  # per template: word numbers; (phrase, position in the text) in order
        for t in templates:
            w, parts, after = self._numbers(t.text), [], 0
            for key in t.keys:
                k = self._numbers(key)
                after = next(i for i in range(after, len(w) - len(k) + 1) if (w[i : i + len(k)] == k).all())
                parts.append((texts.setdefault(key, len(texts)), after))
                after += len(k)
            self.words.append(w)
            self.parts.append(parts)
        self.phrases = [self._numbers(k) for k in texts]
        n, m = len(known), len(self.phrases)
        self.times = np.zeros((n, m), dtype=np.float32)  # how often a phrase holds a word
        for p, w in enumerate(self.phrases):
            np.add.at(self.times[:, p], w, 1)
        self.distinct = (self.times > 0).sum(0)
        # rarest words of each phrase: the last of them is how far down a file's list has to be read
        self.reach = np.array([np.unique(w)[:LOOKUPS][-1] for w in self.phrases])
        post = sorted((int(x), p, i) for p, w in enumerate(self.phrases) for i, x in enumerate(w))
        word, self.post_phrase, self.post_place = (np.array(c, dtype=np.int64) for c in zip(*post))
        self.post_at = np.searchsorted(word, np.arange(n + 1))

    def _numbers(self, text: str) -> np.ndarray:
        return self.number[np.searchsorted(self.known, _hashes(text))]

    def numbers(self, h: np.ndarray) -> np.ndarray:
        """Number of every word, -1 for words of no licence."""
        at = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
        return np.where(self.known[at] == h, self.number[at], -1)

    def phrase_places(self, w: Words, x: np.ndarray, row: np.ndarray) -> list[np.ndarray]:
        """Sorted starting words of every key phrase, as in the texts word for word.

        Each file looks up its rarest licence words, as many as the phrases it
        holds all words of need. Their postings vote for a phrase's start by
        relative position; a start all looked-up words of a phrase agree on is
        verified against the whole phrase.
        """
        hit = np.flatnonzero(x >= 0)
        here = np.zeros((w.rows, len(self.known)), dtype=bool)
        here[row[hit], x[hit]] = True
        possible = (here.astype(np.float32) @ (self.times > 0).astype(np.float32)) == self.distinct
        limit = np.where(possible, self.reach, -1).max(axis=1)  # per file
        looked = here & (np.arange(len(self.known)) <= limit[:, None])
        hit = hit[x[hit] <= limit[row[hit]]]
        runs = (self.post_at[1:] - self.post_at[:-1])[x[hit]]
        post = np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs - self.post_at[x[hit]], runs)
        phrase, start, r = self.post_phrase[post], np.repeat(hit, runs) - self.post_place[post], np.repeat(row[hit], runs)
        sizes = np.array([len(p) for p in self.phrases])
        ok = possible[r, phrase] & (start >= w.first[r]) & (start + sizes[phrase] <= w.first[r + 1])
        phrase, start, r = phrase[ok], start[ok], r[ok]
        n = len(x) + 1
        key, one, votes = np.unique(phrase * n + start, return_index=True, return_counts=True)
        wanted = looked.astype(np.float32) @ self.times
        ok = votes == wanted[r[one], phrase[one]]
        phrase, start = key[ok] // n, key[ok] % n
        out = []
        for p, words in enumerate(self.phrases):
            s = start[phrase == p]
            for j, word in enumerate(words):
                s = s[x[s + j] == word]
            out.append(s)
        return out

    def places(self, w: Words, x: np.ndarray, row: np.ndarray, found: list[np.ndarray], i: int) -> tuple[np.ndarray, np.ndarray]:
        """(starting word of the first key phrase, coverage) of every place where template i's key phrases all stand.

        Later key phrases stand within SLACK words of their place relative to the
        one before. Coverage is the share of the template's IDF weight whose
        words stand within SLACK words of their place.
        """
        words, (first, *rest) = self.words[i], self.parts[i]
        at, key = found[first[0]], np.zeros(len(words), dtype=bool)
        last, q = at, first[1]
        key[q : q + len(self.phrases[first[0]])] = True
        for phrase, place in rest:
            s = found[phrase]
            lo = np.maximum(last + (place - q) - SLACK, w.first[row[last]])
            k = np.searchsorted(s, lo)
            nxt = s[np.minimum(k, len(s) - 1)] if len(s) else np.full(len(at), -1)
            ok = (k < len(s)) & (nxt <= last + (place - q) + SLACK) & (nxt < w.first[row[last] + 1])
            at, last, q = at[ok], nxt[ok], place
            key[place : place + len(self.phrases[phrase])] = True
        got = np.full(len(at), self.weight[words[key]].sum())
        lo, hi = w.first[row[at]], w.first[row[at] + 1]
        for j in np.flatnonzero(~key):
            there = np.zeros(len(at), dtype=bool)
            for d in range(-SLACK, SLACK + 1):
                p = at + (j - first[1] + d)
                inside = (p >= lo) & (p < hi)
                there |= inside & (x[np.where(inside, p, 0)] == words[j])
            got += np.where(there, self.weight[words[j]], 0.0)
        total = self.weight[words].sum()
        return at, np.minimum(1.0, got / total) if total > 0 else np.ones(len(at))


def licence_words(templates: tuple[Template, ...]) -> np.ndarray:
    return np.unique(np.concatenate([_hashes(t.text) for t in templates]))


def word_idf(docs: DataFrame, text: str, templates: tuple[Template, ...]) -> dict[int, float]:
    """IDF of every licence word over all documents: log((1 + documents) / (1 + documents with the word))."""
    known = licence_words(templates)

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, seen = 0, np.zeros(len(known), dtype=np.int64)
        for batch in it:
            n += batch.num_rows
            for w in words_of(batch.column(0), ALNUM, lower=True):
                h = w.hashes()
                at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                hit = known[at] == h
                pair = np.unique(w.row_of_word()[hit] * len(known) + at[hit])
                seen += np.bincount(pair % len(known), minlength=len(known))
        yield pa.RecordBatch.from_arrays([pa.array([*range(len(known)), -1], type=pa.int64()), pa.array([*seen.tolist(), n], type=pa.int64())], ["word", "n"])

    parts = stage_batched(docs.select(F.col(text).cast("string")).mapInArrow(count, "word long, n long"))
    sums = {r["word"]: r["n"] for r in parts.groupBy("word").agg(F.sum("n").alias("n")).collect()}  # one row per licence word
    total = sums.get(-1, 0)
    return {int(x): float(np.log((1 + total) / (1 + sums.get(i, 0)))) for i, x in enumerate(known)}


def scan_licences(docs: DataFrame, notices: tuple[Template, ...] = NOTICES, least: float = 0.6, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: n_words, n_base, first_word, last_word, base_labels, labels, score.

    Words are runs of digits, letters (A-Z lower-cased) and non-ASCII
    characters. n_base counts the places of the base phrases; first_word and
    last_word are their smallest and largest start (words from 0). labels adds
    the notices whose key phrases stand word for word, in order, and whose IDF
    coverage is at least ``least``; score is the best coverage of an accepted
    template, 0 without one. One pass counts the licence words' document
    frequencies over all documents, one scans; nothing is shuffled.

    Null and empty text: no words, no places, empty labels, score 0. Null ids
    pass through. Every row gives one row, repeated ids too.
    """
    templates = BASE + tuple(notices)
    idf = word_idf(docs, text, templates)
    kind = docs.schema[id_column].dataType.simpleString()
    names = [id_column, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]

    def scan(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(templates, idf)
        for batch in it:
            for w in words_of(batch.column(1), ALNUM, lower=True):
                x, row = index.numbers(w.hashes()), w.row_of_word()
                found = index.phrase_places(w, x, row)
                n_base = np.zeros(w.rows, dtype=np.int64)
                first, last = np.full(w.rows, np.iinfo(np.int64).max), np.full(w.rows, -1)
                score = np.zeros(w.rows)
                base: dict[int, set[str]] = {}
                every: dict[int, set[str]] = {}
                for i, t in enumerate(templates):
                    at, cover = index.places(w, x, row, found, i)
                    is_base = i < len(BASE)
                    if not is_base:
                        at, cover = at[cover >= least], cover[cover >= least]
                    r = row[at]
                    np.maximum.at(score, r, cover)
                    for k in np.unique(r).tolist():
                        every.setdefault(k, set()).add(t.label)
                        if is_base:
                            base.setdefault(k, set()).add(t.label)
                    if is_base:
                        n_base += np.bincount(r, minlength=w.rows)
                        np.minimum.at(first, r, at - w.first[r])
                        np.maximum.at(last, r, at - w.first[r])
                none = n_base == 0
                label = lambda of: pa.array([",".join(sorted(of[k])) if k in of else "" for k in range(w.rows)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(w.row0, w.rows), pa.array(np.diff(w.first).astype(np.int64)), pa.array(n_base), pa.array(first, mask=none), pa.array(last, mask=none), label(base), label(every), pa.array(score)], names
                )

    schema = f"{id_column} {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return stage_batched(docs.select(id_column, F.col(text).cast("string")).mapInArrow(scan, schema))
