"""Licence scan: TF-IDF cosine of lines to templates, then inheritance from directories.

A file is a row with a path and a text.  Each line of it is compared with the
templates as a sparse TF-IDF vector: a term counts once, and weighs
ln((1 + T) / (1 + df)) + 1 over the T templates; terms of no template weigh
as df = 0.  The cosine of a line and a template is

    sum of squared weights of shared terms / (length of line * length of template).

A line whose best cosine reaches ``least`` states that licence, under two conditions,
as a wrong licence is worse than none.  It has the terms that tell the licence from
its relatives, such as its name and version, and none that name a relative
(``TELLING``, ``RELATIVES``); else it isn't compared with that template.  And no other
licence comes within ``MARGIN`` of the best cosine.  A file has the licence of its
best line (ties: the first name).  Lines are found by a filter that loses none: for
each template terms are taken, those of everyday English last, until what is left
of it is shorter than ``least``; a line with none of these terms can't reach it.

A file is compared in the same way by larger parts with ``documents``: full licence texts, standard headers, SPDX tags and the
short notices, with weights of their own.  Its parts are the whole text, its runs
of comment lines and of other lines, its paragraphs (also between blank comment
lines), and its sentences, wrapped or not.  The best part counts (ties: the first
name) if no line states a licence, or if it is nearer to a text or header than the
best line to its template.  Only parts that have a word of ``LEGAL`` are compared, as all of these
documents have.  The conditions hold for parts as well; a full text needs no terms of
``TELLING``, and has ``STRANGERS`` instead: terms that a like text of another licence has.

A licence file (its name is in ``LICENCE_FILES``) gives its licence to its
directory; of several in one, the best cosine counts, then the first path.  A
file without a licence of its own inherits that of the nearest directory
above it that has one.  Paths are joined by their directories, one row for each
ancestor; a directory of very many files is split at run time.

Everything is DataFrame expressions.  The templates are a fixed short list.

Defined cases: a null or empty text has no licence of its own and may inherit;
a null path has no directory; repeated rows have the same result each; an empty
table gives an empty table; other columns of the input are not looked at.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliosearch.session import scratch_path

LEAST = 0.6
LICENCE_FILES = ("LICENSE", "LICENCE", "COPYING", "NOTICE")

EVERYDAY = {"a", "by", "file", "is", "of", "the", "this", "to", "under", "use", "work", "library", "version", "source", "code"}

#: How far the best cosine must be from that of any other licence.
MARGIN = 0.01

#: Short notices by licence, in the words that such notices commonly have.
TEMPLATES = {
    "AGPL-3.0": "GNU Affero General Public License, version 3",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Licensed under the BSD 2-Clause License.",
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License.",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0 Creative Commons Attribution.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Released under CC0 1.0 Universal Public Domain Dedication.",
    "EPL-1.0": "Eclipse Public License, Version 1.0",
    "EPL-2.0": "Eclipse Public License, Version 2.0",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Released under the ISC License.",
    "LGPL-2.1": "GNU Lesser General Public License, version 2.1",
    "LGPL-3.0": "GNU Lesser General Public License, version 3",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "Mozilla Public License, version 2.0",
    "Unlicense": "Released into the public domain under the Unlicense.",
    "Zlib": "Released under the zlib License.",
}

_V1, _V2, _V3 = ("1", "1.0", "v1", "v1.0"), ("2", "2.0", "v2", "v2.0"), ("3", "3.0", "v3", "v3.0")

#: Of each of these groups of terms, a notice of the licence has one.
TELLING = {
    "AGPL-3.0": (("affero", "agpl"), _V3),
    "Apache-2.0": (("apache",), _V2),
    "BSD-2-Clause": (("bsd",), ("2", "two", "simplified")),
    "BSD-3-Clause": (("bsd",), ("3", "three", "new", "revised")),
    "BSL-1.0": (("boost", "bsl"), _V1),
    "CC-BY-4.0": (("by", "attribution"), ("4.0", "4")),
    "CC-BY-NC-4.0": (("nc", "noncommercial"), ("4.0", "4")),
    "CC-BY-SA-4.0": (("sa", "sharealike"), ("4.0", "4")),
    "CC0-1.0": (("cc0",),),
    "EPL-1.0": (("eclipse", "epl"), _V1),
    "EPL-2.0": (("eclipse", "epl"), _V2),
    "GPL-2.0": (("general", "gpl"), _V2),
    "GPL-3.0": (("general", "gpl"), _V3),
    "ISC": (("isc",),),
    "LGPL-2.1": (("lesser", "lgpl"), ("2.1", "v2.1")),
    "LGPL-3.0": (("lesser", "lgpl"), _V3),
    "MIT": (("mit", "expat"),),
    "MPL-2.0": (("mozilla", "mpl"), _V2),
    "Unlicense": (("unlicense",),),
    "Zlib": (("zlib",),),
}

#: Terms that name a relative, unless the notice of the licence has them itself.
RELATIVES = {
    "AGPL-3.0": ("lesser", "lgpl"),
    "CC-BY-4.0": ("nc", "noncommercial", "sa", "sharealike", "nd", "noderivatives"),
    "CC-BY-NC-4.0": ("sa", "sharealike", "nd", "noderivatives"),
    "CC-BY-SA-4.0": ("nc", "noncommercial", "nd", "noderivatives"),
    "GPL-2.0": ("affero", "agpl", "lesser", "lgpl"),
    "GPL-3.0": ("affero", "agpl", "lesser", "lgpl"),
    "LGPL-2.1": ("affero", "agpl"),
    "LGPL-3.0": ("affero", "agpl"),
}

#: The Affero text is the GPL's with a section on those who interact remotely.
STRANGERS = {"GPL-3.0": ("remotely",)}


LEGAL = r"(?i)licen[cs]|copyright|permi(?:ssion|tted)|redistribut|warrant|spdx"

#: Words at the start of a comment line.
MARK = r"[ \t]*(?://|#|/?\*|--|;|%|<!--|rem\b)"

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:"""
_MIT_REST = """The above copyright notice and this permission notice shall be included in all copies or substantial portions
of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.
"""
_BSD_REST = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF
USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED
OF THE POSSIBILITY OF SUCH DAMAGE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies."""
_ISC_REST = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License."""
_APACHE_REST = """You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS
IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""
_MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""

_UNLICENSE = "This is free and unencumbered software released into the public domain under no copyright."
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software."""


def _gnu(name: str, version: str) -> tuple[str, str]:
    """The first sentence of a GNU header, and the whole."""
    first = f"""This program is free software; you can redistribute it and/or modify it under the terms of the GNU {name} as
published by the Free Software Foundation; either version {version} of the License, or (at your option) any later version."""
    rest = f"""This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details. You should
have received a copy of the GNU {name} along with this program. If not, see https://www.gnu.org/licenses/."""
    return first, f"{first}\n\n{rest}"


@functools.cache
def documents() -> dict[str, str]:
    """Licence texts, headers and tags: the name is the licence's, a ``#`` and what it is."""
    out = {f"{name}#notice": text for name, text in TEMPLATES.items()}
    out |= {f"{p.stem}#text": p.read_text() for p in sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))}
    gnu = {"GPL-2.0": ("General Public License", "2"), "GPL-3.0": ("General Public License", "3")}
    gnu |= {"LGPL-2.1": ("Lesser General Public License", "2.1"), "LGPL-3.0": ("Lesser General Public License", "3")}
    gnu |= {"AGPL-3.0": ("Affero General Public License", "3")}
    for licence, (name, version) in gnu.items():
        out[f"{licence}#first"], out[f"{licence}#header"] = _gnu(name, version)
    out |= {"MIT#first": _MIT, "MIT#text": f"{_MIT}\n\n{_MIT_REST}", "ISC#first": _ISC, "ISC#text": f"{_ISC}\n\n{_ISC_REST}"}
    out |= {"BSD-2-Clause#text": _BSD + _BSD_REST, "BSD-3-Clause#text": _BSD + _BSD_THIRD + _BSD_REST}
    out |= {"Apache-2.0#first": _APACHE, "Apache-2.0#header": f"{_APACHE}\n\n{_APACHE_REST}", "MPL-2.0#header": _MPL}
    out |= {"Unlicense#first": _UNLICENSE, "Zlib#first": _ZLIB}
    licences = sorted({name.split("#")[0] for name in out})
    return out | {f"{licence}#tag": f"SPDX-License-Identifier: {licence}" for licence in licences}


def parts_of(text: Column) -> Column:
    """The whole text, its runs of comment and other lines, its paragraphs and its sentences."""
    text = F.regexp_replace(text, "\r\n?", "\n")
    turns = rf"(?im)(?<=\n|^)({MARK}[^\n]*)\n(?!{MARK})|(?<=\n|^)((?!{MARK})[^\n]*)\n(?={MARK})"
    runs = F.split(F.regexp_replace(text, turns, "$1$2\u0001"), "\u0001")
    paragraphs = F.flatten(F.transform(runs, lambda run: F.split(run, r"\n[ \t/*#;%-]*(?=\n)")))
    sentences = F.flatten(F.transform(paragraphs, lambda p: F.split(p, r"(?<=[.;!?])\s+")))
    return F.array_distinct(F.flatten(F.array(F.array(text), runs, paragraphs, sentences)))


def terms_of(text: str) -> set[str]:
    """Distinct terms: runs of a-z, 0-9 and dots inside, lower-cased."""
    return set(re.findall(r"[a-z0-9]+(?:\.[a-z0-9]+)*", text.lower()))


def weights(templates: dict[str, str]) -> tuple[dict[str, float], float]:
    """The weight of each template term, and of any other term."""
    of = [terms_of(t) for t in templates.values()]
    weight = lambda df: math.log((1 + len(of)) / (1 + df)) + 1
    return {t: weight(sum(t in x for x in of)) for t in sorted(set().union(*of))}, weight(0)


def told_by(name: str, text: str) -> tuple[list[tuple[str, ...]], list[str]]:
    """Groups of terms of which a line needs one each, and terms it must not have, to be this template's.

    A template asks only for what it has itself: the body of a licence doesn't name it.
    """
    licence, _, kind = name.partition("#")
    own = terms_of(text)
    if kind == "text":
        return [], [t for t in STRANGERS.get(licence, ()) if t not in own]
    needed = [group for group in TELLING.get(licence, ()) if own.intersection(group)]
    return needed, [t for t in RELATIVES.get(licence, ()) if t not in own]


def signs(templates: dict[str, str], least: float) -> list[str]:
    """Terms of which any line near a template has one."""
    weight, _ = weights(templates)
    out: set[str] = set()
    for text in templates.values():
        ranked = sorted(terms_of(text), key=lambda t: (t in EVERYDAY, -weight[t], t))
        whole = sum(weight[t] ** 2 for t in ranked)
        left = whole
        for term in ranked:
            if left < least**2 * whole:
                break
            out.add(term)
            left -= weight[term] ** 2
    return sorted(out)


def line_licences(files: DataFrame, least: float, templates: dict[str, str]) -> DataFrame:
    """(path, text_key, licence, cosine): the best licence line of each file that has one."""
    pattern = r"(?i)(?<![a-z0-9])(?:" + "|".join(re.escape(t) for t in signs(templates, least)) + r")(?![a-z0-9])"
    return _best(files, F.split("text", "\n"), pattern, least, templates)


def part_licences(files: DataFrame, least: float, templates: dict[str, str]) -> DataFrame:
    """The same for the best part of each file; also whether a licence text or header is near it (``long``)."""
    best = _best(files, parts_of(F.col("text")), LEGAL, least, templates)
    return best.withColumns(
        {"licence": F.substring_index("licence", "#", 1), "long": F.substring_index("licence", "#", -1).isin("text", "header", "first")}
    )


def _best(files: DataFrame, parts: Column, pattern: str, least: float, templates: dict[str, str]) -> DataFrame:
    weight, other = weights(templates)
    names = sorted(templates)
    of = {name: terms_of(templates[name]) for name in names}
    lines = files.where(F.col("text").rlike(pattern)).select("path", "text_key", F.posexplode(parts).alias("line", "words"))
    terms = F.array_distinct(F.regexp_extract_all(F.lower("words"), F.lit(r"([a-z0-9]+(?:\.[a-z0-9]+)*)"), F.lit(1)))
    norm = {name: math.sqrt(sum(weight[t] ** 2 for t in of[name])) for name in names}
    # A line of which the terms of no template alone are longer than this is too far from all.
    strange = F.size(F.array_except("terms", F.array(*[F.lit(t) for t in weight]))) * F.lit(other**2)
    near = lines.where(F.col("words").rlike(pattern)).select("path", "text_key", "line", terms.alias("terms"))
    near = near.where(strange <= F.lit((max(norm.values()) / least) ** 2 + 1e-6))
    rows = near.select("path", "text_key", "line", F.explode("terms").alias("term"))
    # Terms that decide are numbered; a line has them as bits of one or two numbers.
    rules = {name: told_by(name, templates[name]) for name in names}
    ruling = sorted({t for needed, barred in rules.values() for t in (*barred, *(t for group in needed for t in group))})
    places = [ruling[at : at + 60] for at in range(0, len(ruling), 60)]
    bits = lambda terms: [sum(1 << k for k, t in enumerate(place) if t in terms) for place in places]
    vocabulary = files.sparkSession.createDataFrame(
        [(t, weight.get(t, other) ** 2, [t in of[name] for name in names], bits({t})) for t in sorted({*weight, *ruling})],
        "known string, square double, inside array<boolean>, marks array<long>",
    )
    square = F.coalesce("square", F.lit(other**2))
    dots = [F.sum(F.when(F.element_at("inside", k + 1), F.col("square")).otherwise(0.0)).alias(f"dot{k}") for k in range(len(names))]
    has = [F.bit_or(F.coalesce(F.element_at("marks", k + 1), F.lit(0).cast("long"))).alias(f"has{k}") for k in range(len(places))]
    summed = (
        rows.join(vocabulary, F.col("term") == F.col("known"), "left")
        .groupBy("path", "text_key", "line")
        .agg(F.sqrt(F.sum(square)).alias("length"), *has, *dots)
    )

    def any_of(terms: Sequence[str]) -> Column:
        told = [F.col(f"has{k}").bitwiseAND(F.lit(mask).cast("long")) != 0 for k, mask in enumerate(bits(terms)) if mask]
        return functools.reduce(Column.__or__, told)

    def away(k: int, name: str) -> Column:
        """Minus the cosine; 0 where the line lacks a needed term or has a barred one."""
        needed, barred = rules[name]
        may = [any_of(group) for group in needed] + ([~any_of(barred)] if barred else [])
        cosine = F.round(F.col(f"dot{k}") / (F.col("length") * F.lit(norm[name])), 6)
        return -F.when(functools.reduce(Column.__and__, may, F.lit(True)), cosine).otherwise(0.0)

    each = [F.struct(away(k, name).alias("away"), F.lit(name).alias("licence")) for k, name in enumerate(names)]  # the least is the best
    licence_of = lambda name: F.substring_index(name, "#", 1)
    # The one-element explode keeps the long expression from being copied into all that use it.
    ranked = summed.select("path", "text_key", F.explode(F.array(F.array(*each))).alias("each")).withColumn("top", F.array_min("each"))
    ranked = ranked.where(F.col("top.away") <= -least)
    rival = F.array_min(F.filter("each", lambda one: licence_of(one["licence"]) != licence_of(F.col("top.licence"))))["away"]
    found = ranked.where(F.coalesce(F.round(rival - F.col("top.away"), 6) > MARGIN, F.lit(True))).select("path", "text_key", "top")
    top = found.groupBy("path", "text_key").agg(F.min("top").alias("top"))
    return top.select("path", "text_key", (-F.col("top.away")).alias("cosine"), "top.licence")


def directory(path: Column) -> Column:
    """The path up to its last slash, without it; null if it has none."""
    return F.when(F.instr(path, "/") > 0, F.regexp_replace(path, "/[^/]*$", ""))


def ancestors(folder: Column) -> Column:
    """The directory and all above it, the nearest first, as (depth, folder)."""
    parts = F.split(folder, "/")
    return F.transform(
        F.sequence(F.size(parts), F.lit(1), F.lit(-1)),
        lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("folder")),
    )


def scan(
    files: DataFrame, path: str = "path", text: str = "text", least: float = LEAST, templates: dict[str, str] = TEMPLATES
) -> DataFrame:
    """(path, own_licence, cosine, licence, inherited_from) for every distinct file.

    ``licence`` is the file's own or the inherited one; ``inherited_from`` is the
    directory it comes from.  Files with equal path and text are one file.
    """
    spark = files.sparkSession
    rows = files.select(
        F.col(path).cast("string").alias("path"), F.xxhash64(F.col(text).cast("string")).alias("text_key"), F.col(text).cast("string").alias("text")
    )
    found_path, told_path = scratch_path(spark, "licence-lines"), scratch_path(spark, "licence-files")
    line_licences(rows, least, templates).write.parquet(found_path)
    by_line, parts_path = spark.read.parquet(found_path), scratch_path(spark, "licence-parts")
    part_licences(rows.where(F.col("text").rlike(LEGAL)), least, documents()).write.parquet(parts_path)
    told_line = by_line.select(F.col("path").alias("p"), F.col("text_key").alias("k"), F.col("cosine").alias("c"), F.col("licence").alias("by_line"))
    both = spark.read.parquet(parts_path).join(
        told_line, F.col("path").eqNullSafe(F.col("p")) & (F.col("text_key") == F.col("k")), "full"
    )
    part = F.col("c").isNull() | (F.col("long") & (F.col("cosine") > F.col("c")))
    found = both.select(
        F.coalesce("path", "p").alias("p"),
        F.coalesce("text_key", "k").alias("k"),
        F.when(part, F.col("cosine")).otherwise(F.col("c")).alias("cosine"),
        F.when(part, F.col("licence")).otherwise(F.col("by_line")).alias("own_licence"),
    )
    told = rows.select("path", "text_key").distinct().join(found, F.col("path").eqNullSafe(F.col("p")) & (F.col("text_key") == F.col("k")), "left")
    told.select("path", "text_key", "own_licence", "cosine", directory(F.col("path")).alias("folder")).write.parquet(told_path)
    told = spark.read.parquet(told_path)

    name = F.regexp_extract("path", r"([^/]*)$", 1)
    of_folder = (
        told.where(name.isin(*LICENCE_FILES) & F.col("own_licence").isNotNull() & F.col("folder").isNotNull())
        .groupBy("folder")
        .agg(F.min(F.struct(-F.col("cosine"), F.col("path"), F.col("own_licence").alias("licence")))["licence"].alias("given"))
        .select(F.col("folder").alias("above"), "given")
    )
    # Directories, not files, look for the nearest one above; there are fewer of them.
    folders = told.where("own_licence is null and folder is not null").select("folder").distinct()
    steps = folders.select("folder", F.explode(ancestors(F.col("folder"))).alias("step"))
    nearest = (
        steps.join(of_folder, F.col("step.folder") == F.col("above"))
        .groupBy("folder")
        .agg(F.max_by(F.struct("above", "given"), "step.depth").alias("nearest"))
        .select(F.col("folder").alias("inside"), "nearest")
    )
    near_path = scratch_path(spark, "licence-folders")
    nearest.write.parquet(near_path)
    without = F.col("own_licence").isNull()
    return told.join(spark.read.parquet(near_path), F.col("folder") == F.col("inside"), "left").select(
        "path",
        "text_key",
        "own_licence",
        "cosine",
        F.when(without, F.col("nearest.given")).otherwise(F.col("own_licence")).alias("licence"),
        F.when(without, F.col("nearest.above")).alias("inherited_from"),
    )
