"""Licence recognition by sentence rules.

A text is cut into sentences, once within lines and once across line breaks; each
normalised sentence is looked up among known licence sentences; the sequence of
identifiers found is matched against ordered rules. Narrow DataFrame functions only.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Known licence sentences (identifier, sentence), from the public licence texts. Fixed values.
SENTENCES = [
    ("mit-ref", "Released under the MIT License"),
    ("mit-ref", "Licensed under the MIT License"),
    ("mit-ref", "This project is licensed under the terms of the MIT License"),
    ("mit-ref", "This software is released under the MIT License"),
    ("mit-title", "The MIT License"),
    ("mit-title", "MIT License"),
    ("mit-grant", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("mit-notice", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("mit-warranty", 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT'),
    ("mit-liability", "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE"),
    ("apache2-ref", "Licensed under the Apache License, Version 2.0"),
    ("apache2-ref", "Released under the Apache License, Version 2.0"),
    ("apache2-header", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License'),
    ("apache2-copy", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache2-warranty", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied'),
    ("apache2-see", "See the License for the specific language governing permissions and limitations under the License"),
    ("gpl3-ref", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl3-ref", "Licensed under the GNU General Public License, version 3"),
    ("gpl2-ref", "This work is licensed under the GNU General Public License, version 2"),
    ("gpl2-ref", "Licensed under the GNU General Public License, version 2"),
    ("gpl3-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("gpl2-later", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"),
    ("gpl-warranty", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"),
    ("gpl-see", "See the GNU General Public License for more details"),
    ("ccbync4-ref", "Licensed under CC BY-NC 4.0"),
    ("ccbync4-ref", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("ccby4-ref", "Licensed under CC BY 4.0"),
    ("ccby4-ref", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("ccbysa4-ref", "Licensed under CC BY-SA 4.0"),
    ("cc0-ref", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("mpl2-header", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("isc-grant", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("bsd-grant", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("bsd-source", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("bsd-binary", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"),
    ("bsd-endorse", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]


class Rule(NamedTuple):
    name: str
    licence: str
    family: str
    sentences: tuple[str, ...]


#: In order of precedence: the first rule that matches names a text's licence. Fixed values.
RULES = [
    Rule("mit-full", "MIT", "permissive", ("mit-grant", "mit-notice", "mit-warranty")),
    Rule("mit-grant", "MIT", "permissive", ("mit-grant",)),
    Rule("apache2-full", "Apache-2.0", "permissive", ("apache2-header", "apache2-copy", "apache2-warranty", "apache2-see")),
    Rule("apache2-header", "Apache-2.0", "permissive", ("apache2-header",)),
    Rule("bsd-3", "BSD-3-Clause", "permissive", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    Rule("bsd-2", "BSD-2-Clause", "permissive", ("bsd-grant", "bsd-source", "bsd-binary")),
    Rule("isc", "ISC", "permissive", ("isc-grant",)),
    Rule("gpl3-later", "GPL-3.0-or-later", "copyleft", ("gpl3-later",)),
    Rule("gpl2-later", "GPL-2.0-or-later", "copyleft", ("gpl2-later",)),
    Rule("gpl3-ref", "GPL-3.0-only", "copyleft", ("gpl3-ref",)),
    Rule("gpl2-ref", "GPL-2.0-only", "copyleft", ("gpl2-ref",)),
    Rule("mpl2", "MPL-2.0", "copyleft", ("mpl2-header",)),
    Rule("ccbync4", "CC-BY-NC-4.0", "noncommercial", ("ccbync4-ref",)),
    Rule("ccbysa4", "CC-BY-SA-4.0", "copyleft", ("ccbysa4-ref",)),
    Rule("ccby4", "CC-BY-4.0", "permissive", ("ccby4-ref",)),
    Rule("cc0", "CC0-1.0", "permissive", ("cc0-ref",)),
    Rule("unlicense", "Unlicense", "permissive", ("unlicense",)),
    Rule("apache2-ref", "Apache-2.0", "permissive", ("apache2-ref",)),
    Rule("mit-ref", "MIT", "permissive", ("mit-ref",)),
    Rule("mit-title", "MIT", "permissive", ("mit-title",)),
]
#: Each known sentence holds one of these; a text without any holds no known sentence.
TRIGGERS = ("licen", "copyright", "permission", "warrant", "unencumbered", "liab", "permitted", "redistribut")
#: Ends of sentences: marks before white space or the end, empty lines; and between lines as well.
ACROSS = "[.!?]+(?:\\s+|$)|\\n\\s*\\n\\s*"
WITHIN = "[.!?]+(?:\\s+|$)|\\n+"


def normalised(sentence: str) -> str:
    """Lower case of A-Z, letters and digits of ASCII only, single spaces between."""
    return re.sub("[^a-z0-9]+", " ", sentence.translate(str.maketrans(UPPER, LOWER))).strip(" ")


def known_sentences(pattern: str) -> dict[str, str]:
    """Normalised sentence to identifier, for texts that are cut at ``pattern``.

    A sentence that holds an end mark ("v. 2.0") is cut as the text is; of its parts,
    those of four words or more identify it.
    """
    known: dict[str, str] = {}
    for name, sentence in SENTENCES:
        parts = [normalised(x) for x in re.split(pattern, sentence)]
        for part in parts:
            if part and (len(parts) == 1 or part.count(" ") >= 3):
                known.setdefault(part, name)
    return known


def identifiers(text: Column, pattern: str) -> Column:
    """Identifiers of the known sentences of a text, in order; others are left out."""
    table = F.create_map(*(F.lit(x) for pair in known_sentences(pattern).items() for x in pair))
    parts = F.transform(F.split(text, pattern), lambda s: F.trim(F.regexp_replace(s, "[^a-z0-9]+", " ")))
    return F.filter(F.transform(parts, lambda s: F.try_element_at(table, s)), lambda x: x.isNotNull())


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """All rows of ``docs`` with a struct ``licence``.

    ``sentences`` counts known sentences (the larger of both ways of cutting), ``rules``
    and ``licences`` list all rules that match and their licences, in order of
    precedence, ``name`` and ``family`` are the first one's (null without any). Null
    and empty texts match nothing. Rows stay as they are, repeated ones too; an input
    column named ``licence`` is replaced.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    low = F.translate(whole, UPPER, LOWER)  # only for texts with a trigger
    none = F.array().cast("array<string>")
    may = F.lit(False)
    for t in TRIGGERS:
        may = may | F.contains(F.lower(whole), F.lit(t))
    found = F.when(may, let(low, lambda x: F.array(identifiers(x, WITHIN), identifiers(x, ACROSS)))).otherwise(F.array(none, none))
    out = docs.withColumn("licence", found)
    runs = F.transform("licence", lambda x: F.concat(F.lit("/"), F.array_join(x, "/"), F.lit("/")))
    rules = F.array(*(F.struct(F.lit(r.name).alias("rule"), F.lit(r.licence).alias("licence"), F.lit(r.family).alias("family"), F.lit("/" + "/".join(r.sentences) + "/").alias("run")) for r in RULES))
    matched = let(runs, lambda x: F.filter(rules, lambda r: F.contains(x[0], r["run"]) | F.contains(x[1], r["run"])))
    out = out.withColumn("licence", F.struct(F.greatest(F.size(F.col("licence")[0]), F.size(F.col("licence")[1])).cast("long").alias("sentences"), matched.alias("matched")))
    m = F.col("licence.matched")
    return out.withColumn(
        "licence",
        F.struct(
            F.col("licence.sentences").alias("sentences"), F.transform(m, lambda r: r["rule"]).alias("rules"), F.array_distinct(F.transform(m, lambda r: r["licence"])).alias("licences"),
            F.get(m, F.lit(0))["licence"].alias("name"), F.get(m, F.lit(0))["family"].alias("family"),
        ),
    )
