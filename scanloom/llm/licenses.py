"""License scan: texts against templates with optional and replaceable regions.

A template is text with <<beginOptional>> .. <<endOptional>> around what may be absent and <<var;max=N;min=M;match=P>> where
M (0) to N (10) words of any kind, or that the pattern P matches, may stand. All templates compile to one automaton over
words; a place in a text matches a template if the automaton accepts it from there, that is if all its mandatory wording stands
exactly, in order.

Every template and base phrase has a mandatory anchor word. One built-in filter looks for anchors, so that only
texts with one go to Python; that is exact, as a text without any anchor cannot match. Each text is one row, no
shuffle is needed.

Words are runs of digits, a-z (after lower-casing A-Z only) and all code points from 0x80.

Cases: a null text is empty, with no words and no labels; overlapping and repeated places all count; repeated
rows are scanned each; an empty table gives an empty result; only the id and the text column are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanloom.llm.common import text_of

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: The same words before lower-casing, as a Java pattern.
_ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Phrase and label.
BASE_PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Parts of the BSD licenses. Fixed values.
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "<<beginOptional>>1. <<endOptional>>Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. <<beginOptional>>2. <<endOptional>>Redistributions in binary form must reproduce the above copyright notice, this list of "
    "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_TAIL = (
    "THIS SOFTWARE IS PROVIDED BY <<var;max=15>> \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL <<var;max=15>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; "
    "OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
    "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)

#: Label and template markup. The wording of public licenses and of their usual notices.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0<<beginOptional>> (the \"License\")<<endOptional>>"),
    ("mit-notice", "<<beginOptional>>is <<endOptional>>released under the<<beginOptional>> terms of the<<endOptional>> MIT license"),
    (
        "gpl-3.0",
        "licensed under the<<beginOptional>> terms of the<<endOptional>> GNU General Public License<<beginOptional>> as published by the Free Software Foundation<<endOptional>>, version 3"
    ),
    (
        "gpl-2.0",
        "licensed under the<<beginOptional>> terms of the<<endOptional>> GNU General Public License<<beginOptional>> as published by the Free Software Foundation<<endOptional>>, version 2"
    ),
    ("cc-by-nc-4.0", "licensed under<<beginOptional>> a Creative Commons<<endOptional>> CC BY-NC 4.0"),
    ("cc-by-4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of <<var;max=12>> (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "mit-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of <<var;max=12>> (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice<<beginOptional>> (including the next paragraph)<<endOptional>> shall be included in "
        "all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
        "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
        "<<var;max=12>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ),
    ("bsd-2-clause", _BSD_HEAD + _BSD_TAIL),
    (
        "bsd-3-clause",
        _BSD_HEAD + "<<beginOptional>>3. <<endOptional>>Neither the name of <<var;max=15>> nor the names of its contributors may be used to endorse "
        "or promote products derived from this software without specific prior written permission. " + _BSD_TAIL,
    ),
    (
        "zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the <<var;match=authors?;max=1;min=1>> be "
        "held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, "
        "including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions",
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
        "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    (
        "bsl-1.0",
        "Boost Software License<<beginOptional>> -<<endOptional>> Version 1.0<<beginOptional>> - August 17th, 2003<<endOptional>>",
    ),
    ("copyright-line", "Copyright<<beginOptional>> (c)<<endOptional>> <<var;match=(19|20)[0-9][0-9];max=4;min=1>> <<var;max=6>> All rights reserved"),
)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.translate(_LOWER))


@dataclass(frozen=True)
class Automaton:
    """All templates as one. States are numbered; step[s] maps a word to the next states, skip[s] are states reached for free,
    anything[s] are (next state, pattern or None) that any word, or any that the pattern matches whole, leads to. final maps
    states to labels. mandatory has the wording of each template outside regions. Sets of states that occur are kept with
    where each word leads from them, so that a text is read as by a deterministic automaton."""

    step: tuple[dict[str, tuple[int, ...]], ...]
    skip: tuple[tuple[int, ...], ...]
    anything: tuple[tuple[tuple[int, str | None], ...], ...]
    final: dict[int, str]
    mandatory: tuple[tuple[str, ...], ...]
    first: frozenset[str]
    seen: dict[tuple[frozenset[int], str | None], frozenset[int]]

    def closed(self, states: Iterable[int]) -> frozenset[int]:
        out, open_ = set(), list(states)
        while open_:
            s = open_.pop()
            if s not in out:
                out.add(s)
                open_ += self.skip[s]
        return frozenset(out)

    def after(self, states: frozenset[int], word: str) -> frozenset[int]:
        known = any(word in self.step[s] for s in states) or any(p for s in states for _, p in self.anything[s])
        key = states, word if known else None
        if (got := self.seen.get(key)) is None:
            to = [t for s in states for t in self.step[s].get(word, ())]
            to += [t for s in states for t, pattern in self.anything[s] if pattern is None or re.fullmatch(pattern, word)]
            if len(self.seen) > MAX_SEEN:
                self.seen.clear()
            got = self.seen[key] = self.closed(to)
        return got

    def match(self, words: Sequence[str], start: int) -> dict[str, int]:
        """The end of the longest match of each template that matches from `start`."""
        states, out, i = self.closed([0]), {}, start
        while states:
            for s in states & self.final.keys():
                out[self.final[s]] = i
            if i == len(words):
                break
            states = self.after(states, words[i])
            i += 1
        return out


#: Transitions that a task keeps.
MAX_SEEN = 200_000


def compile_templates(templates: Sequence[tuple[str, str]]) -> Automaton:
    """Templates of (label, markup) as one automaton. Raises ValueError for unbalanced regions, or for markup without mandatory
    wording or that begins with a replaceable region."""
    step: list[dict[str, list[int]]] = [{}]
    skip: list[list[int]] = [[]]
    anything: list[list[tuple[int, str | None]]] = [[]]
    final: dict[int, str] = {}
    wording = []

    def new() -> int:
        step.append({})
        skip.append([])
        anything.append([])
        return len(step) - 1

    for label, markup in templates:
        start = at = new()
        skip[0].append(start)
        opened, mandatory = [], []
        for piece in re.split(r"(<<.*?>>)", markup):
            if piece.startswith("<<beginOptional"):
                opened.append(at)
                inner = new()
                skip[at].append(inner)
                at = inner
            elif piece.startswith("<<endOptional"):
                if not opened:
                    raise ValueError(f"{label}: region closed but not opened")
                end = new()
                skip[at].append(end)
                skip[opened.pop()].append(end)
                at = end
            elif piece.startswith("<<var"):
                given = dict(x.split("=", 1) for x in piece[5:-2].split(";") if x)
                most, least = int(given.get("max", 10)), int(given.get("min", 0))
                states = [at] + [new() for _ in range(most)]
                end = new()
                for a, b in zip(states, states[1:]):
                    anything[a].append((b, given.get("match")))
                for s in states[least:]:
                    skip[s].append(end)
                at = end
            else:
                for w in words_of(piece):
                    nxt = new()
                    step[at].setdefault(w, []).append(nxt)
                    at = nxt
                    if not opened:
                        mandatory.append(w)
        if opened or not mandatory:
            raise ValueError(f"{label}: region not closed, or no mandatory wording")
        final[at] = label
        wording.append(tuple(mandatory))
    made = Automaton(
        tuple(
            {w: tuple(t) for w, t in x.items()} for x in step
        ), tuple(map(tuple, skip)), tuple(map(tuple, anything)), final, tuple(wording), frozenset(), {}
    )
    starts = made.closed([0])
    if any(anything[s] for s in starts):
        raise ValueError("a template begins with a replaceable region")
    return replace(made, first=frozenset(w for s in starts for w in step[s]))


def anchors(automaton: Automaton, phrases: Sequence[tuple[str, str]]) -> list[str]:
    """One mandatory word of each template and phrase, as few in all as the longest words give."""
    found: set[str] = set()
    for own in [list(m) for m in automaton.mandatory] + [words_of(p) for p, _ in phrases]:
        usable = [w for w in own if w.isascii()] or own
        if not found & set(own):
            found.add(max(usable, key=lambda w: (w in ("license", "licensed"), len(w))))
    return sorted(found)


def scan_text(text: str, automaton: Automaton, phrases: Sequence[tuple[str, str]] = BASE_PHRASES) -> tuple:
    """(n_base, first_word, last_word, base_labels, labels, score, spans of (label, first word, end))."""
    words = words_of(text)
    places: list[int] = []
    base: set[str] = set()
    split = [(words_of(p), label) for p, label in phrases]
    spans = []
    for i, w in enumerate(words):
        for phrase, label in split:
            if w == phrase[0] and words[i : i + len(phrase)] == phrase:
                places.append(i)
                base.add(label)
        if w in automaton.first:
            spans += [(label, i, end) for label, end in sorted(automaton.match(words, i).items())]
    labels = base | {x[0] for x in spans}
    score = 1.0 if spans else 0.5 if base else 0.0
    return len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score, spans


def scan_licenses(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    phrases: Sequence[tuple[str, str]] = BASE_PHRASES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per document: id, n_words, n_base, first_word, last_word, base_labels, labels, score (1 where a whole
    template matches, 0.5 where only a phrase does) and spans: array of (label, first word, end word)."""
    automaton = compile_templates(templates)
    found = "n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label:string,first:long,end:long>>"

    @F.pandas_udf(found)
    def scan(texts: pd.Series) -> pd.DataFrame:
        rows = [(0, None, None, "", "", 0.0, []) if t is None else scan_text(t, automaton, phrases) for t in texts]
        out = pd.DataFrame(rows, columns=["n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])
        out["spans"] = [[{"label": a, "first": b, "end": c} for a, b, c in s] for s in out["spans"]]
        return out.astype({"first_word": "Int64", "last_word": "Int64"})

    text = text_of(text_col)
    maybe = text.rlike("(?i)" + "|".join(re.escape(a) for a in anchors(automaton, phrases)))
    rows = docs.select(
        F.col(id_col).alias("id"), F.regexp_count(text, F.lit(_ANY_CASE_WORD)).cast("long").alias("n_words"),
        F.when(maybe, text).alias("text")
    )
    return rows.select(F.col("id").alias(id_col), "n_words", scan("text").alias("x")).select(id_col, "n_words", "x.*")
