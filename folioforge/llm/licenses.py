"""Operator 3: license scans by template-markup matching.

A template is license wording with marked regions: `<<beginOptional>>` ...
`<<endOptional>>` may be left out, `<<var;match="...";most=n>>` stands for one
to n words that each match a pattern. Everything else is mandatory and has to
stand there word for word. A template compiles to an automaton over words; a
text is labelled with every template that accepts a run of its words.

Beside the templates, fixed phrases are counted wherever their words stand
consecutively.

Edge cases: a null text is empty; texts without words have no labels, score 0;
repeated rows give repeated rows; other columns are ignored; texts of any length
are scanned whole.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from folioforge.llm.common import map_rows, text_bytes

#: A word: digits, lower-case letters and every character beyond ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

#: The phrases to count, and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Copyright lines: a holder's name and years, up to 16 words.
COPYRIGHT = '<<beginOptional>>Copyright <<var;match=".+";most=16>> <<endOptional>><<beginOptional>>All rights reserved. <<endOptional>>'

#: Whole public licenses and headers, in markup.
LICENSE_TEXTS = {
    "mit": COPYRIGHT + """
        Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
        (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
        publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
        subject to the following conditions:
        The above copyright notice and this permission notice <<beginOptional>>(including the next paragraph) <<endOptional>>shall be included in all copies or substantial portions of the Software.
        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL <<var;match=".+";most=8>> BE LIABLE FOR ANY CLAIM,
        DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE
        OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "isc": COPYRIGHT + """
        Permission to use, copy, modify, <<var;match="and|or";most=2>> distribute this software for any purpose with or without fee is hereby granted,
        provided that the above copyright notice and this permission notice appear in all copies.
        THE SOFTWARE IS PROVIDED "AS IS" AND <<var;match=".+";most=8>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <<var;match=".+";most=8>> BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
        CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE
        OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "bsd": COPYRIGHT + """
        Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
        <<beginOptional>>1. <<endOptional>>Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
        <<beginOptional>>2. <<endOptional>>Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer
        in the documentation and/or other materials provided with the distribution.
        <<beginOptional>><<beginOptional>>3. <<endOptional>>Neither the name of <<var;match=".+";most=10>> nor the names of <<var;match="its|the";most=1>> contributors may be used to endorse
        or promote products derived from this software without specific prior written permission. <<endOptional>>
        THIS SOFTWARE IS PROVIDED BY <<var;match=".+";most=8>> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL <<var;match=".+";most=8>> BE LIABLE FOR ANY
        DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
        SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
        LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY
        OF SUCH DAMAGE.""",
    "apache-2.0-header": COPYRIGHT + """
        Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
        You may obtain a copy of the License at <<var;match=".+";most=12>> Unless required by applicable law or agreed to in writing, software
        distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
        See the License for the specific language governing permissions and limitations under the License.""",
    "gnu-header": COPYRIGHT + """
        <<var;match=".+";most=6>> is free software: you can redistribute it and/or modify it under the terms of the GNU <<beginOptional>>Lesser <<endOptional>>
        <<beginOptional>>Affero <<endOptional>>General Public License as published by the Free Software Foundation, either version <<var;match="[0-9]+";most=2>>
        of the License, or (at your option) any later version. <<var;match=".+";most=6>> is distributed in the hope that it will be useful, but WITHOUT ANY
        WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU <<beginOptional>>Lesser <<endOptional>>
        <<beginOptional>>Affero <<endOptional>>General Public License for more details.""",
    "mpl-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. "
        "If a copy of the MPL was not distributed with this file, You can obtain one at <<var;match=\".+\";most=8>>"
    ),
}

#: Own templates of common notices, in markup, beside the whole texts.
TEMPLATES = {
    "apache-2.0-notice": "<<beginOptional>>This work is <<endOptional>>Licensed under the Apache License<<beginOptional>>, Version 2.0<<endOptional>>",
    "apache-notice-full": (
        'Licensed under the Apache License, Version <<var;match="[0-9]+";most=2>> <<beginOptional>>(the "License"); <<endOptional>>'
        "you may not use this file except in compliance with the License"
    ),
    "gpl-notice": (
        '<<beginOptional>>This <<var;match="work|program|software|file";most=1>> is <<endOptional>>licensed under the GNU General Public License'
        '<<beginOptional>>, version <<var;match="[0-9]+";most=2>><<endOptional>>'
    ),
    "gpl-redistribution": (
        'you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation'
        '<<beginOptional>>, either version <<var;match="[0-9]+";most=1>> of the License, or (at your option) any later version<<endOptional>>'
    ),
    "mit-notice": '<<var;match="released|licensed|distributed|available";most=1>> under the <<beginOptional>>terms of the <<endOptional>>MIT License',
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
        '<<beginOptional>> (the "Software")<<endOptional>>, to deal in the Software without restriction'
    ),
    "bsd-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
    ),
    "cc-by-notice": (
        '<<var;match="released|licensed|available";most=1>> under <<beginOptional>>a Creative Commons <<endOptional>><<beginOptional>>the <<endOptional>>CC BY'
        '<<beginOptional>>-<<var;match="nc|sa|nd";most=2>><<endOptional>><<beginOptional>> <<var;match="[0-9]+";most=2>><<endOptional>>'
    ),
} | LICENSE_TEXTS


def words_of(text: bytes) -> list[bytes]:
    return WORD.findall(text.lower())


@dataclass
class TokenAutomaton:
    """Words and patterns on transitions; state 0 begins."""

    arcs: list[list[tuple[bytes | re.Pattern, int]]] = field(default_factory=lambda: [[]])
    skips: list[list[int]] = field(default_factory=lambda: [[]])
    final: int = 0
    mandatory: set[bytes] = field(default_factory=set)

    def state(self) -> int:
        self.arcs.append([])
        self.skips.append([])
        return len(self.arcs) - 1

    @classmethod
    def compile(cls, markup: str) -> TokenAutomaton:
        self, at, opened = cls(), 0, []
        for part in re.split(r"(<<[^>]*>>)", markup):
            if part == "<<beginOptional>>":
                opened.append(at)
            elif part == "<<endOptional>>":
                self.skips[opened.pop()].append(at)
            elif part.startswith("<<var;"):
                match, most = re.fullmatch(r'<<var;match="(.*)";most=(\d+)>>', part).groups()
                pattern, ends = re.compile(match.encode()), []
                for _ in range(int(most)):
                    to = self.state()
                    self.arcs[at].append((pattern, to))
                    at = to
                    ends.append(to)
                for e in ends[:-1]:
                    self.skips[e].append(at)
            else:
                for w in words_of(part.encode()):
                    to = self.state()
                    self.arcs[at].append((w, to))
                    at = to
                    if not opened:
                        self.mandatory.add(w)
        if opened:
            raise ValueError("an optional region is not closed")
        self.final = at
        return self

    def closure(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for s in self.skips[todo.pop()]:
                if s not in states:
                    states.add(s)
                    todo.append(s)
        return states

    def longest(self, words: list[bytes], start: int) -> int:
        """How many words from start the automaton accepts at most; 0 if none."""
        now, best = self.closure({0}), 0
        for i in range(start, len(words)):
            w = words[i]
            now = self.closure({to for s in now for label, to in self.arcs[s] if (label == w if isinstance(label, bytes) else label.fullmatch(w))})
            if not now:
                break
            if self.final in now:
                best = i + 1 - start
        return best

    def starts(self, words: list[bytes]) -> list[int]:
        firsts = [label for s in self.closure({0}) for label, _ in self.arcs[s]]
        known = {x for x in firsts if isinstance(x, bytes)}
        patterns = [x for x in firsts if not isinstance(x, bytes)]
        return [i for i, w in enumerate(words) if w in known or any(p.fullmatch(w) for p in patterns)]


class Scanner:
    def __init__(self, phrases: dict[str, str], templates: dict[str, str]):
        self.phrases = [(p, label) for phrase, label in phrases.items() if (p := tuple(words_of(phrase.encode())))]
        self.templates = {name: TokenAutomaton.compile(m) for name, m in templates.items()}
        # a word of each phrase and template that a text must hold
        self.rare = [max(p, key=len, default=b"") for p, _ in self.phrases] + [max(a.mandatory, key=len, default=b"") for a in self.templates.values()]
        self.any_rare = re.compile(b"|".join(sorted({re.escape(w) for w in self.rare}, key=len)))  # matches anything if one of them has no such word

    def scan(self, text: bytes) -> dict:
        """Counts, first and last place of phrases, labels, matched spans and score."""
        lower = text.lower()
        words = WORD.findall(lower)
        out = {"n_words": len(words), "n_base": 0, "first_word": None, "last_word": None, "base_labels": "", "labels": "", "spans": [], "score": 0.0}
        if not self.any_rare.search(lower):
            return out
        held = set(words)
        places, base = [], set()
        for phrase, label in self.phrases:
            if held.issuperset(phrase):
                n = len(phrase)
                at = [i for i, w in enumerate(words) if w == phrase[0] and tuple(words[i : i + n]) == phrase]
                places += at
                if at:
                    base.add(label)
        spans = []
        for name, a in self.templates.items():
            if a.mandatory <= held:
                spans += [(name, i, n) for i in a.starts(words) if (n := a.longest(words, i))]
        if places:
            out |= {"n_base": len(places), "first_word": min(places), "last_word": max(places), "base_labels": ",".join(sorted(base))}
        out["labels"] = ",".join(sorted(base | {s[0] for s in spans}))
        out["spans"] = [{"template": t, "start": i, "words": n} for t, i, n in spans]
        out["score"] = 1.0 if spans else 0.5 if places else 0.0
        return out


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict | None = None, templates: dict | None = None) -> DataFrame:
    """One row per row of df.

    score is 1 if a template accepts a run of words, 0.5 if there are only base
    phrases and else 0. spans has the accepted runs: template, start, words. Empty
    phrases or templates look for none; a phrase without words stands nowhere.
    """
    kind = df.schema[id_col].dataType.simpleString()
    phrases, templates = PHRASES if phrases is None else phrases, TEMPLATES if templates is None else templates
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]

    def run(batches):
        scanner = Scanner(phrases, templates)
        for batch in batches:
            got = [scanner.scan(t.as_py()) for t in batch.column(1)]
            yield {id_col: batch.column(0)} | {n: [g[n] for g in got] for n in names}

    schema = (
        f"`{id_col}` {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "spans array<struct<template:string,start:long,words:long>>"
    )
    return map_rows(df.select(id_col, text_bytes(text_col)), run, schema)
