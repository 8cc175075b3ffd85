"""License scan by templates with optional and replaceable regions.

A template is a license's wording in which ``<<optional>> .. <<end>>`` may be
left out and ``<<var;words=0-4>>`` stands for any words, that many of them;
``match=`` gives an expression that each of these words has to match.  All other
words are mandatory.

* Templates are compiled to automata over words.  A state has its moves by word,
  and moves by any word for a replaceable region; optional regions are resolved
  when the automaton is built.
* A template is tried where its first mandatory words stand.  All its states are
  carried on word by word; it is accepted if the last one is reached, and the
  longest accepted stretch counts.  Mandatory wording matches exactly or not
  at all.
* Whole texts are scanned in Spark tasks, with nothing shuffled.

Beside the templates, fixed phrases are looked up as they are (``BASE``).
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from event_ml.llm.common import kept_in_worker, map_batches, table

# --- fixed values: phrases of the query and wording of public licenses ---------
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

AS_IS = """THIS SOFTWARE IS PROVIDED BY <<var;words=1-12>> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL <<var;words=1-12>> BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES"""

BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
<<var;words=0-1>> Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
<<var;words=0-1>> Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution. """

ENDORSE = """<<var;words=0-1>> Neither the name of <<var;words=1-12>> nor the names of <<var;words=1-3>> contributors may be used to endorse or promote
products derived from this software without specific prior written permission. """

TEXTS = {
    "mit-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
following conditions: The above copyright notice and this permission notice <<optional>>(including the next paragraph)<<end>> shall be included
in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
<<var;words=1-12>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "isc-text": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided
that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND
<<var;words=1-12>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE""",
    "bsd-2-clause-text": BSD + AS_IS,
    "bsd-3-clause-text": BSD + ENDORSE + AS_IS,
    "apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at <<optional>>http www apache org licenses LICENSE 2 0<<end>> <<optional>>https www apache
org licenses LICENSE 2 0<<end>> Unless required by applicable law or agreed to in writing, software distributed under the License is
distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.""",
    "gpl-header": """This <<var;words=1-3>> is free software: you can redistribute it and/or modify it under the terms of the GNU
<<optional>>Lesser<<end>> <<optional>>Affero<<end>> General Public License as published by the Free Software Foundation, <<optional>>either<<end>>
version <<var;words=1-2;match=[0-9]+>> of the License <<optional>>or (at your option) any later version<<end>>""",
    "unlicense-text": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile,
sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
}

VERBS = ("licensed under", "released under", "distributed under", "available under", "published under")
VERSION = "<<optional>>International<<end>> <<var;words=1-2;match=v?[0-9]+>> <<optional>>International<<end>>"
NOTICES = {
    "gpl-notice": "<<optional>>the terms of<<end>> <<optional>>the<<end>> GNU General Public License <<optional>>as published by the Free Software Foundation<<end>> "
    "<<optional>>either<<end>> <<optional>>version<<end>> <<var;words=1-2;match=v?[0-9]+>>",
    "apache-2.0-notice": "<<optional>>the terms of<<end>> <<optional>>the<<end>> Apache License <<optional>>Version<<end>> 2 0",
    "mit-notice": "<<optional>>the terms of<<end>> <<optional>>the<<end>> MIT License",
    "cc-by-notice": f"<<optional>>a<<end>> <<optional>>the<<end>> CC BY {VERSION}",
    "cc-by-nc-notice": f"<<optional>>a<<end>> <<optional>>the<<end>> CC BY NC {VERSION}",
    "cc-by-sa-notice": f"<<optional>>a<<end>> <<optional>>the<<end>> CC BY SA {VERSION}",
}
# --- end of fixed values -----------------------------------------------------

TEMPLATES = tuple(TEXTS.items()) + tuple((label, f"{verb} {text}") for label, text in NOTICES.items() for verb in VERBS)

#: Mandatory words at a template's beginning that are looked for before it is tried.
LEAD = 3
#: Bytes to lower case, with a blank for what isn't a digit, a letter or a part of a character outside ASCII.
WORD_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(WORD_BYTES).split()


class _Items(NamedTuple):
    """A template as a sequence: words (bytes), replaceable regions
    (least, most, pattern) and, by place, the place after an optional region that begins there."""

    sequence: list
    skips: dict[int, list[int]]


def _parsed(template: str) -> _Items:
    sequence: list = []
    skips: dict[int, list[int]] = {}
    begun: list[int] = []
    for part in re.split(r"(<<[^<>]*>>)", template):
        if part == "<<optional>>":
            begun.append(len(sequence))
        elif part == "<<end>>":
            if not begun:
                raise ValueError("an optional region ends that has not begun")
            skips.setdefault(begun.pop(), []).append(len(sequence))
        elif part.startswith("<<"):
            found = re.fullmatch(r"<<var;words=(\d+)-(\d+)(?:;match=(.*))?>>", part)
            if not found or int(found[1]) > int(found[2]):
                raise ValueError(f"no such region: {part}")
            sequence.append((int(found[1]), int(found[2]), re.compile(found[3].encode()) if found[3] else None))
        else:
            sequence.extend(words_of(part))
    if begun:
        raise ValueError("an optional region doesn't end")
    if not sequence or isinstance(sequence[0], tuple) or 0 in skips:
        raise ValueError("a template begins with a mandatory word")
    return _Items(sequence, skips)


class Automaton:
    """A template's states and moves.

    State (i, used) is the place before item i, of which ``used`` words are
    consumed if it is a replaceable region.  ``by_word[s]`` and ``by_any[s]``
    are the moves of state s, after all that may be left out is left out.
    ``depth[s]`` counts the mandatory words before s.
    """

    def __init__(self, label: str, template: str):
        self.label = label
        items, skips = _parsed(template)
        lead = next((i for i, x in enumerate(items) if isinstance(x, tuple) or i in skips), len(items))
        #: words that every accepted text begins with
        lead = min(lead, LEAD)
        self.anchor = items[:lead]
        optional = {i for a, ends in skips.items() for b in ends for i in range(a, b)}
        before = [0]
        for i, x in enumerate(items):
            before.append(before[-1] + (not isinstance(x, tuple) and i not in optional))
        self.mandatory = before[-1]
        self.numbers: dict[tuple[int, int], int] = {}
        self.by_word: list[dict[bytes, set[int]]] = []
        self.by_any: list[list[tuple[re.Pattern | None, int]]] = []
        self.depth: list[int] = []
        self.final: set[int] = set()
        todo = [(lead, 0)]
        self.start = self._number(todo[0], todo, before)
        for state in todo:  # grows as moves find states
            own = self.numbers[state]
            for i, used in self._reached(state, items, skips):
                if i == len(items):
                    self.final.add(own)
                elif isinstance(items[i], tuple):
                    if used < items[i][1]:
                        self.by_any[own].append((items[i][2], self._number((i, used + 1), todo, before)))
                else:
                    self.by_word[own].setdefault(items[i], set()).add(self._number((i + 1, 0), todo, before))

    def _number(self, state: tuple[int, int], todo: list, before: list[int]) -> int:
        if state not in self.numbers:
            self.numbers[state] = len(self.numbers)
            self.by_word.append({})
            self.by_any.append([])
            self.depth.append(before[state[0]])
            if len(self.numbers) > 1:
                todo.append(state)
        return self.numbers[state]

    @staticmethod
    def _reached(state: tuple[int, int], items: list, skips: dict[int, list[int]]) -> set[tuple[int, int]]:
        """States that no further word is needed for."""
        seen, left = set(), [state]
        while left:
            now = left.pop()
            if now in seen:
                continue
            seen.add(now)
            i, used = now
            if used == 0:
                left.extend((end, 0) for end in skips.get(i, ()))
            if i < len(items) and isinstance(items[i], tuple) and used >= items[i][0]:
                left.append((i + 1, 0))
        return seen

    def run(self, words: list[bytes], at: int) -> tuple[int | None, float]:
        """(end of the longest accepted stretch that begins at word ``at`` or None,
        share of the mandatory words that were matched in order)."""
        now, place = {self.start}, at + len(self.anchor)
        deepest, end = 0, None
        while now:
            deepest = max(deepest, max(self.depth[s] for s in now))
            if not now.isdisjoint(self.final):
                end = place
            if place == len(words):
                break
            word = words[place]
            after = set()
            for s in now:
                after |= self.by_word[s].get(word, frozenset())
                after.update(t for pattern, t in self.by_any[s] if pattern is None or pattern.fullmatch(word))
            now, place = after, place + 1
        return end, 1.0 if end is not None else deepest / self.mandatory


def _starts(joined: bytes, phrase: Sequence[bytes]) -> Iterator[int]:
    """Word numbers at which ``phrase`` stands, overlaps included, in words joined (and surrounded) by blanks."""
    wanted = b" " + b" ".join(phrase) + b" "
    at, counted, n = joined.find(wanted), 0, 0
    while at >= 0:
        n += joined.count(b" ", counted, at)
        counted = at
        yield n
        at = joined.find(wanted, at + 1)


class Scanner:
    """Compiled templates by their anchors, and the fixed phrases."""

    def __init__(self, templates: Sequence[tuple[str, str]], base: Sequence[tuple[str, str]]):
        self.base = [(words_of(phrase), label) for phrase, label in base]
        self.by_anchor: dict[tuple[bytes, ...], list[Automaton]] = {}
        for label, text in templates:
            automaton = Automaton(label, text)
            self.by_anchor.setdefault(tuple(automaton.anchor), []).append(automaton)

    def scan(self, text: str | None) -> tuple[int, list[tuple[str, int, int]], list[tuple[str, int, int]], float]:
        """(words, fixed phrases and accepted templates as (label, first word, word after the last), score)."""
        words = words_of(text)
        joined = b" " + b" ".join(words) + b" "
        base = [(label, n, n + len(phrase)) for phrase, label in self.base for n in _starts(joined, phrase)]
        accepted, score = [], 0.5 if base else 0.0
        for anchor, automata in self.by_anchor.items():
            for at in _starts(joined, anchor):
                for automaton in automata:
                    end, share = automaton.run(words, at)
                    score = max(score, share)
                    if end is not None:
                        accepted.append((automaton.label, at, end))
        in_order = lambda places: sorted(places, key=lambda x: (x[1], x[2], x[0]))
        return len(words), in_order(base), in_order(accepted), score


PLACE = "array<struct<label: string, first: long, past: long>>"


def scan(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    base: Sequence[tuple[str, str]] = tuple(BASE.items()),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_words, base_places, places, score) of every row.

    ``base_places`` lists every place of a fixed phrase, ``places`` the accepted
    templates, both as (label, first, past): the first word's number from 0 and
    the number after the last word, in order of place.  ``score`` is 1 where a
    template is accepted, else the largest share of a template's mandatory
    words that follow each other from its beginning, and at least 0.5 where a
    fixed phrase stands.

    A null text is empty; empty texts and texts without words have no places and
    score 0.  Texts are scanned whole, whatever their length.  Overlapping places
    all count; two templates accepted at one place are both listed.  Repeated rows
    have their results each; a null id stays null.  Other columns, whatever
    their names, are not read.  An empty table gives no rows.
    """
    templates, base = tuple(templates), tuple(base)
    if not all(words_of(phrase) for phrase, _ in base):
        raise ValueError("a phrase has at least one word")
    Scanner(templates, base)  # markup is checked before any job

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = kept_in_worker(("licenses", templates, base), lambda: Scanner(templates, base))
        place = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("past", pa.int64())]))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                n, found, accepted, score = zip(*map(scanner.scan, part.column(1).to_pylist()), strict=True)
                own, more = ([[{"label": x, "first": a, "past": b} for x, a, b in row] for row in rows] for rows in (found, accepted))
                values = [part.column(0), pa.array(n, pa.int64()), pa.array(own, place), pa.array(more, place), pa.array(score, pa.float64())]
                yield pa.RecordBatch.from_arrays(values, ["doc_id", "n_words", "base_places", "places", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, run, f"doc_id long, n_words long, base_places {PLACE}, places {PLACE}, score double")


def op13_template_markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    own, more = F.col("base_places.label"), F.col("places.label")
    named = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return found.select(
        "doc_id", "n_words", F.size("base_places").cast("long").alias("n_base"), F.array_min("base_places.first").alias("first_word"),
        F.array_max("base_places.first").alias("last_word"), named(own).alias("base_labels"), named(F.concat(own, more)).alias("labels"), "score",
    )
