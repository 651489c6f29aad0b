"""License scans: lines, whole texts and windows of words compared with license templates by Dice's coefficient.

Native: DataFrame functions only.  Texts are lower-cased and every run of other characters than letters and
digits becomes one blank.  A unit and a template are sets of word bigrams; Dice = 2 * shared / (bigrams of the one + of the other).
Units are each line, the whole text of several lines, and windows: stretches of as many words as the template has, across lines, that begin at
every tenth of the template's length (every word, for short ones), so that a notice that is wrapped over lines or lies in a longer line is
nearly in line with one.  A window counts each of its bigrams, repeated ones too.

Dice of t or more needs sizes within t / (2 - t) of each other, so that units of a size that no template allows are dropped, and each other
unit meets only the templates whose bounds it is within.  What tells licenses, their versions and relatives apart (``KEYS``) has to be in the
unit if it is in the template, and ``NEVER`` must not, nor in the ``AHEAD`` words behind a window.  So texts without the words of any template's
keys are dropped before they are split, and units meet only the templates whose keys they have.  For templates without keys the bound tells how
many bigrams a match may lack, and so words of which it must have one.  Windows are found from the bigrams that a text shares with a template:
only windows with such a bigram exist.

The templates are a fixed table of this module or a parameter of the caller; more than ``BLOCK_TEMPLATES`` are scanned for in blocks of so many, each
of which is what is broadcast.  Bigrams join the templates in place; only the shared ones are shuffled.

Defined results: null and empty texts and units of fewer than two words match nothing; of a line or whole text the best license counts, of
equal scores the first by name; of a license the best window counts, of equal ones the first in the text; rows with the same id are scanned each
and equal findings merge; an empty table gives an empty result.  A very long text that has a match's words is split as a whole, some 100 bytes a word.
Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.runtime import pick, settle

BLOCK_TEMPLATES = 1000
#: The places of the units that are the whole text, and windows.
WHOLE, WINDOW = -1, -2

# Public license notices, and license texts without their copyright lines.
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_3 = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
_MIT = 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.'
_MIT_END = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
_ISC_END = 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
_APACHE = 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'
_APACHE_END = 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'
_GNU_END = "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
_GNU = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0}General Public License as published by the Free Software Foundation, either version {1} of the License, or (at your option) any later version."
_GNU_LIBRARY = "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version {0} of the License, or (at your option) any later version."
_GNU_FILE = "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", _APACHE),
    ("Apache-2.0", f"{_APACHE} {_APACHE_END}"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", _MIT),
    ("MIT", f"{_MIT} {_MIT_END}"),
    ("ISC", _ISC),
    ("ISC", f"{_ISC} {_ISC_END}"),
    ("BSD-2-Clause", _BSD),
    ("BSD-2-Clause", f"{_BSD} {_BSD_END}"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", f"{_BSD} {_BSD_3}"),
    ("BSD-3-Clause", f"{_BSD} {_BSD_3} {_BSD_END}"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", _GNU.format("", 2)),
    ("GPL-2.0", f"{_GNU.format('', 2)} {_GNU_END} See the GNU General Public License for more details."),
    ("GPL-2.0", f"GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc. {_GNU_FILE}"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", _GNU.format("", 3)),
    ("GPL-3.0", f"{_GNU.format('', 3)} {_GNU_END} See the GNU General Public License for more details."),
    ("GPL-3.0", f"GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. {_GNU_FILE}"),
    ("LGPL-2.1", _GNU_LIBRARY.format("2.1")),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", _GNU_LIBRARY.format("3")),
    ("LGPL-3.0", f"GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. {_GNU_FILE}"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", _GNU.format("Affero ", 3)),
    ("AGPL-3.0", f"GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc. {_GNU_FILE}"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated all copyright and related rights to this work to the public domain worldwide."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("All-Rights-Reserved", "All rights reserved."),
]
#: Bigrams that a match has to have if the template has them, and those that it must not have, by license.
KEYS = frozenset("apache license|mit license|hereby granted|without fee|binary form|endorse or|bsd style|gnu general|gnu lesser|gnu affero|version 2|version 3|2 1|2 of|mozilla public|v 2|cc by|by 4|sa 4|nc 4|by sa|by nc|attribution 4|sharealike 4|noncommercial 4|attribution sharealike|attribution noncommercial|public domain|unencumbered software|rights reserved".split("|"))
#: A window is told by so many words behind it, too, that it lacks what it must not have.
AHEAD = 40
NEVER = {"BSD-2-Clause": ("endorse or",)}


def words(text: str) -> list[str]:
    out, word = [], []
    for c in text.lower():
        if c.isascii() and c.isalnum():
            word.append(c)
        elif word:
            out.append("".join(word))
            word = []
    return out + ["".join(word)] * bool(word)


def bigrams(text: str) -> list[str]:
    own = words(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(own, own[1:], strict=False)))


def word_sets(grams: list[str], threshold: float, most: int = 3, known: frozenset[str] = frozenset()) -> list[list[str]]:
    """Disjoint sets of words, of each of which every unit that matches the template has one.

    A match lacks at most a share of 1 - t / (2 - t) of the template's bigrams; so it has a word of any set whose words are in more of them.
    Words that are ``known`` are taken first, and then long words, as they are the rarer ones."""
    spare = int(len(grams) * (1 - threshold / (2 - threshold)) + 1e-9)
    pairs, out, used = [set(g.split()) for g in grams], [], set()
    while len(out) < most:
        own, left = [], pairs
        while len(pairs) - len(left) <= spare:
            free = {w for g in left for w in g} - used - set(own)
            if not free:
                return out
            own.append(min(free, key=lambda w: (w not in known, -min(len(w), 7), -sum(w in g for g in left), w)))
            left = [g for g in left if own[-1] not in g]
        out.append(own)
        used |= set(own)
    return out


def required_words(known: list[list[str]], threshold: float) -> list[list[list[str]]]:
    """The ``word_sets`` of each template, the same words for several where that can be; the templates with the fewest bigrams choose first."""
    seen: frozenset[str] = frozenset()
    out = set()
    for grams in sorted(known, key=lambda g: (len(g), g)):
        sets = word_sets(grams, threshold, known=seen)
        seen |= {w for own in sets for w in own}
        out.add(tuple(map(tuple, sets)))
    return sorted(out)


def may_match(text: Column, required: list[list[list[str]]]) -> Column:
    """Whether a lower-cased text has the words that some template's matches must have.  Each word is looked for once."""
    words_ = sorted({w for sets in required for own in sets for w in own})

    def some(flags: Column) -> Column:
        has = lambda own: reduce(lambda x, y: x | y, (flags[words_.index(w)] for w in own))
        every = [reduce(lambda x, y: x & y, map(has, sets), F.lit(True)) for sets in required]
        return reduce(lambda x, y: x | y, every, F.lit(False))

    return F.exists(F.array(F.array(*(text.contains(w) for w in words_))), some) if words_ else F.lit(bool(required))


def keys_of(grams: list[str], keys: frozenset[str] = KEYS) -> tuple[str, ...]:
    return tuple(sorted(keys & set(grams)))


def may_hold(unit: Column, known: list[tuple], keys: frozenset[str] = KEYS) -> Column:
    """The numbers of the templates whose keys a unit has; ``unit`` is its words with a blank before, between and after."""
    by_keys: dict[tuple[str, ...], list[int]] = {}
    for k, _, own, *_ in known:
        by_keys.setdefault(keys_of(own, keys), []).append(k)
    some = [F.when(reduce(lambda x, y: x & y, (unit.contains(f" {g} ") for g in asked), F.lit(True)), F.array(*map(F.lit, numbers))) for asked, numbers in sorted(by_keys.items())]
    return F.flatten(F.array_compact(F.array(*some))) if some else F.array().cast("array<int>")


def has_words(text: Column, known: list[tuple], threshold: float, keys: frozenset[str] = KEYS) -> Column:
    """Whether a lower-cased text has all words of some template's keys; for a template without keys, the words that the bound asks for."""
    every = {tuple(sorted({w for g in keys_of(own, keys) for w in g.split()}, key=lambda w: (-len(w), w))) for _, _, own, *_ in known}
    some = may_match(text, required_words([own for _, _, own, *_ in known if not keys_of(own, keys)], threshold)) if () in every else F.lit(False)
    for first in sorted({words_[0] for words_ in every if words_}):
        rest = (reduce(lambda x, y: x & y, (text.contains(w) for w in words_[1:]), F.lit(True)) for words_ in sorted(every) if words_ and words_[0] == first)
        some = some | (text.contains(first) & reduce(lambda x, y: x | y, rest))
    return some


def prepared(templates: list[tuple[str, str]], keys: frozenset[str] = KEYS, never: dict[str, tuple[str, ...]] = NEVER) -> list[tuple]:
    """(number, license, bigrams, words, step of windows, [(bigram, its number, role)]) of templates with bigrams.

    Roles: 0 is shared or not, 1 must be shared, 2 must not be there (and isn't one of the template's)."""
    out = []
    for k, (name, text) in enumerate(templates):
        own, size = bigrams(text), len(words(text))
        others = [g for g in never.get(name, ()) if g not in own]
        if own:
            out.append((k, name, own, size, max(1, size // 10), [(g, i, int(g in keys)) for i, g in enumerate(own)] + [(g, len(own) + i, 2) for i, g in enumerate(others)]))
    return out


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] | None = None, threshold: float = 0.8, keys: frozenset[str] = KEYS, never: dict[str, tuple[str, ...]] = NEVER) -> DataFrame:
    """A row for each unit that matches: the id, line (from 0; -1 for the whole text, -2 for a window), word (a window's first, else -1), license and dice.

    Without ``keys`` and ``never`` Dice alone decides, and versions of a license are told apart by no more than that."""
    templates = TEMPLATES if templates is None else templates
    blocks = [templates[i : i + BLOCK_TEMPLATES] for i in range(0, max(1, len(templates)), BLOCK_TEMPLATES)]
    scores = reduce(DataFrame.unionByName, (_scores(pick(docs, id_col, text_col).toDF("_id", "_text"), prepared(b, keys, never), threshold, keys) for b in blocks))
    lines = scores.where(F.col("line") > WINDOW).groupBy("_id", "line").agg(F.min(F.struct((-F.col("dice")).alias("d"), "license", "word")).alias("_best"))
    windows = scores.where(F.col("line") == WINDOW).groupBy("_id", "line", "license").agg(F.min(F.struct((-F.col("dice")).alias("d"), "word", "license")).alias("_best")).select("_id", "line", F.struct("_best.d", "_best.license", "_best.word").alias("_best"))
    best = lines.unionByName(windows)
    return best.select(F.col("_id").alias(id_col), F.col("line").cast("long").alias("line"), F.col("_best.word").cast("long").alias("word"), F.col("_best.license").alias("license"), F.round(-F.col("_best.d"), 6).alias("dice"))


def _scores(docs: DataFrame, known: list[tuple], threshold: float, keys: frozenset[str]) -> DataFrame:
    """_id, line, word, license and dice of what reaches the threshold."""
    spark = docs.sparkSession
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    rows = [(g, k, name, len(own), size, size + (AHEAD if role == 2 else 0), step, sum(r == 1 for _, _, r in roles), i, role) for k, name, own, size, step, roles in known for g, i, role in roles]
    grams = spark.createDataFrame(rows, "gram string, template int, license string, size int, words int, reach int, step int, keys int, nth int, role int")

    def once(value: Column, use) -> Column:
        """``use(value)`` with the value made once: as a plain column it would be made anew wherever it is used."""
        return F.transform(F.array(value), use)[0]

    def unit(text_: Column, distinct: bool) -> Column:
        """Size, the templates whose keys are there, and the bigrams (of windows, all of them and where they are); null without any."""

        def from_words(w: Column) -> Column:
            pairs = F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w) - 1), lambda x, y: F.concat_ws(" ", x, y))
            pairs = F.array_distinct(pairs) if distinct else pairs
            grams_ = once(pairs, lambda g: F.struct((F.size(g) + (0 if distinct else 1)).alias("size"), F.transform(g, lambda x, i: F.struct(x.alias("gram"), (F.lit(0) if distinct else i).alias("at"))).alias("grams")))
            able = once(F.concat(F.lit(" "), F.array_join(w, " "), F.lit(" ")), lambda x: may_hold(x, known, keys))
            return F.when(F.size(w) >= 2, once(able, lambda t: F.when(F.size(t) > 0, F.struct(t.alias("able"), grams_.alias("own")))))

        return once(F.filter(F.split(F.btrim(text_), " +"), lambda w: w != ""), from_words)

    def units_of(lines: Column) -> Column:
        each = F.transform(lines, lambda u, i: F.struct(i.alias("line"), unit(u, True).alias("found")))
        whole = F.array_join(lines, " ")
        more = F.array(F.struct(F.lit(WHOLE).alias("line"), F.when(F.size(lines) > 1, unit(whole, True)).alias("found")), F.struct(F.lit(WINDOW).alias("line"), unit(whole, False).alias("found")))
        return F.filter(F.concat(each, more), lambda u: u["found"].isNotNull())

    # Texts that lack the words of every template are dropped before they are split, and then units.
    text = F.coalesce(F.col("_text"), F.lit(""))
    some = F.exists(F.array(F.lower(text)), lambda low_: has_words(low_, known, threshold, keys))
    lines = F.split(F.regexp_replace(F.lower(text), "[^a-z0-9\\n]+", " "), "\n")
    units = docs.where(some).select("_id", F.xxhash64("_text").alias("_same"), F.explode(once(lines, units_of)).alias("_unit"))
    units = units.select("_id", "_same", F.col("_unit.line").alias("line"), F.col("_unit.found.able").alias("_able"), F.col("_unit.found.own.size").alias("_size"), F.col("_unit.found.own.grams").alias("_grams"))
    allowed = F.lit(False)
    for size in sorted({len(own) for _, _, own, *_ in known}):
        allowed = allowed | F.col("_size").between(F.lit(low * size - 1e-9), F.lit(high * size + 1e-9))
    found = units.where((F.col("line") == WINDOW) | allowed).select("_id", "_same", "line", "_able", "_size", F.explode("_grams").alias("_g")).select("_id", "_same", "line", "_able", "_size", "_g.gram", "_g.at")
    near = (F.col("line") == WINDOW) | ((F.col("_size") >= F.col("size") * F.lit(low) - 1e-9) & (F.col("_size") <= F.col("size") * F.lit(high) + 1e-9))
    found = settle(found.join(F.broadcast(grams), "gram").where(near & F.array_contains("_able", F.col("template"))).drop("gram", "_able"))
    # The same text gives the same counts, so that repeated rows merge.
    counts = [F.count_distinct(F.when(F.col("role") < 2, F.col("nth"))).alias("_shared"), F.count_distinct(F.when(F.col("role") == 1, F.col("nth"))).alias("_keys"), F.count(F.when(F.col("role") == 2, 1)).alias("_never")]
    template = ["template", "license", "size", "keys"]
    right = (F.col("_keys") == F.col("keys")) & (F.col("_never") == 0) & (F.col("dice") >= threshold)
    whole = found.where(F.col("line") > WINDOW).groupBy("_id", "_same", "line", "_size", *template).agg(*counts)
    whole = whole.withColumn("dice", F.lit(2.0) * F.col("_shared") / (F.col("_size") + F.col("size"))).where(right)
    # A bigram is in the windows that begin at most the template's words less two before it.
    begins = F.sequence(F.greatest(F.lit(0), F.ceil((F.col("at") - F.col("reach") + 2) / F.col("step")).cast("int")), F.floor(F.col("at") / F.col("step")).cast("int"))
    ahead = F.greatest(F.lit(0), F.ceil((F.col("at") - F.col("reach") + 2) / F.col("step")).cast("int")) <= F.floor(F.col("at") / F.col("step")).cast("int")
    inside = found.where((F.col("line") == WINDOW) & ahead).withColumn("word", F.explode(begins)).withColumn("word", F.col("word") * F.col("step"))
    windows = inside.groupBy("_id", "_same", "line", "word", "_size", "words", *template).agg(*counts)
    own = F.least(F.col("words"), F.col("_size") - F.col("word")) - 1
    windows = windows.withColumn("dice", F.lit(2.0) * F.col("_shared") / (own + F.col("size"))).where(right)
    return whole.select("_id", "line", F.lit(-1).alias("word"), "license", "dice").unionByName(windows.select("_id", "line", "word", "license", "dice"))


def oracle(threshold: float = 0.8) -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    known = prepared(TEMPLATES)
    values = ", ".join(f"({k}, {quoted(name)}, {len(own)}, {size}, {size + (AHEAD if role == 2 else 0)}, {step}, {sum(r == 1 for _, _, r in roles)}, {quoted(g)}, {i}, {role})" for k, name, own, size, step, roles in known for g, i, role in roles)
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    counts = "count(DISTINCT nth) FILTER (WHERE role < 2) AS shared, count(DISTINCT nth) FILTER (WHERE role = 1) AS found, count(*) FILTER (WHERE role = 2) AS never"
    return rf"""
WITH t(template, license, size, words, reach, step, keys, gram, nth, role) AS (VALUES {values}),
l AS (SELECT doc_id, string_split(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9
]+', ' ', 'g'), chr(10)) AS ls FROM documents),
u AS (SELECT doc_id, generate_subscripts(ls, 1) - 1 AS line, unnest(ls) AS unit FROM l
      UNION ALL SELECT doc_id, -1, array_to_string(ls, ' ') FROM l WHERE len(ls) > 1
      UNION ALL SELECT doc_id, -2, array_to_string(ls, ' ') FROM l),
w AS (SELECT doc_id, line, list_filter(string_split(unit, ' '), lambda x: x <> '') AS ws FROM u),
g AS (SELECT doc_id, line, len(ws) AS n, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) AS grams FROM w WHERE len(ws) >= 2),
a AS (SELECT doc_id, line, len(list_distinct(grams)) AS own, unnest(list_distinct(grams)) AS gram FROM g WHERE line > -2),
b AS (SELECT doc_id, n, generate_subscripts(grams, 1) - 1 AS pos, unnest(grams) AS gram FROM g WHERE line = -2),
x AS (SELECT doc_id, line, template, license, size, keys, own, {counts} FROM a JOIN t ON a.gram = t.gram
      WHERE own BETWEEN {low}::DOUBLE * size - 1e-9 AND {high}::DOUBLE * size + 1e-9 GROUP BY doc_id, line, template, license, size, keys, own),
o AS (SELECT doc_id, template FROM b JOIN t ON b.gram = t.gram WHERE role = 1 GROUP BY doc_id, template, keys HAVING count(DISTINCT nth) = keys),
y AS (SELECT b.doc_id, n, pos, t.template, license, size, words, step, keys, nth, role,
             unnest(range(greatest(0, CAST(ceil((pos - reach + 2) / step) AS BIGINT)), CAST(floor(pos / step) AS BIGINT) + 1)) * step AS word FROM b JOIN t ON b.gram = t.gram JOIN o ON o.doc_id = b.doc_id AND o.template = t.template),
z AS (SELECT doc_id, word, n, template, license, size, words, keys, {counts} FROM y GROUP BY doc_id, word, n, template, license, size, words, keys),
d AS (SELECT doc_id, line, -1 AS word, license, 2.0::DOUBLE * shared / (own + size) AS dice FROM x WHERE found = keys AND never = 0
      UNION ALL SELECT doc_id, -2, word, license, 2.0::DOUBLE * shared / (least(words, n - word) - 1 + size) FROM z WHERE found = keys AND never = 0)
SELECT doc_id, CAST(line AS BIGINT) AS line, CAST(word AS BIGINT) AS word, license, round(dice, 6) AS dice FROM d WHERE dice >= {threshold}::DOUBLE
QUALIFY row_number() OVER (PARTITION BY doc_id, line, CASE WHEN line = -2 THEN license END ORDER BY dice DESC, CASE WHEN line = -2 THEN word END, license) = 1
"""
