"""License scans by sentence rules, in DataFrame functions only.

A text is normalised (lower case; all but ``a-z 0-9 . + -`` is one space) and has
boundaries at line ends and after ``. ! ? ;`` before a space or a line end.  Dots
and spaces in front of a boundary go, and so do the comment and bullet marks
behind it.  A known licence sentence is found where it stands between two
boundaries, and its words may be parted by one line end or semicolon, so
hard-wrapped texts are read too; a blank line or ``. ! ?`` parts sentences.  The
longest sentence at a place counts.  A table names the sentences by identifiers.
The identifiers of a text, in order, form a sequence, and ordered rules match
runs of identifiers in it: the first rule that fits is the licence of the text,
and all that fit are listed.

The DuckDB statement cuts at every line end, so it finds the same but for
sentences that are wrapped or follow a dash; the given tables have none.

Everything is an expression over one row: there is no shuffle and no Python.

Defined cases: a null or empty text has no sentences and no licence; repeated
sentences repeat in the sequence; each input row gives one row, repeated rows and
rows without an id too; a text that fits several rules has the licence of the first
of them; a text of any length is read whole; an empty table gives an empty result;
columns besides doc_id and text are not read, whatever their names.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm import common

#: Sentences of public licence texts and notices, normalised, with their identifiers.
TEXTS = {
    # Apache License 2.0
    "licensed under the apache license version 2.0": "APACHE2_NOTICE",
    "licensed under the apache license version 2.0 the license": "APACHE2_NOTICE",
    "apache license version 2.0 january 2004": "APACHE2_TITLE",
    "you may not use this file except in compliance with the license": "APACHE2_COMPLY",
    "you may obtain a copy of the license at": "APACHE2_COPY",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "APACHE2_ASIS",
    "see the license for the specific language governing permissions and limitations under the license": "APACHE2_SEE",
    # MIT and ISC
    "released under the mit license": "MIT_NOTICE",
    "licensed under the mit license": "MIT_NOTICE",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MIT_GRANT",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MIT_INCLUDE",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "MIT_ASIS",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "MIT_LIABLE",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "ISC_GRANT",
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "ISC_GRANT",
    "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness": "ISC_ASIS",
    # BSD
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BSD_PERMIT",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BSD_SOURCE",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BSD_BINARY",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BSD_NAME",
    "neither the name of the copyright holders nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BSD_NAME",
    "the name of the author may not be used to endorse or promote products derived from this software without specific prior written permission": "BSD_NAME",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "BSD_ASIS",
    # Mozilla, Boost, public domain
    "this source code form is subject to the terms of the mozilla public license v": "MPL2_NOTICE",
    "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla.org mpl 2.0": "MPL2_COPY",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla.org mpl 2.0": "MPL2_COPY",
    "mozilla public license version 2.0": "MPL2_TITLE",
    "boost software license - version 1.0 - august 17th 2003": "BSL1_TITLE",
    "distributed under the boost software license version 1.0": "BSL1_NOTICE",
    "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third-parties to whom the software is furnished to do so all subject to the following": "BSL1_GRANT",
    "this is free and unencumbered software released into the public domain": "UNLICENSE_NOTICE",
    "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non-commercial and by any means": "UNLICENSE_GRANT",
    "cc0 1.0 universal": "CC0_TITLE",
    "to the extent possible under law the author s has dedicated all copyright and related and neighboring rights to this software to the public domain worldwide": "CC0_NOTICE",
    "the person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law including all related and neighboring rights to the extent allowed by law": "CC0_DEED",
    # GNU
    "this work is licensed under the gnu general public license version 3": "GPL3_NOTICE",
    "this work is licensed under the gnu general public license version 2": "GPL2_NOTICE",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation": "GPL2_NOTICE",
    "gnu general public license version 3 29 june 2007": "GPL3_TITLE",
    "gnu general public license version 2 june 1991": "GPL2_TITLE",
    "gnu lesser general public license version 3 29 june 2007": "LGPL3_TITLE",
    "gnu lesser general public license version 2.1 february 1999": "LGPL2_TITLE",
    "gnu affero general public license version 3 19 november 2007": "AGPL3_TITLE",
    # Creative Commons, short forms
    "licensed under cc by-nc 4.0": "CC_BY_NC4_NOTICE",
    "licensed under cc by 4.0": "CC_BY4_NOTICE",
    "licensed under cc by-sa 4.0": "CC_BY_SA4_NOTICE",
}

#: The GNU licences by name and version with their short names; the Creative Commons ones by their terms.
GNU = (("general", "2", "GPL2", "GPL-2.0"), ("general", "3", "GPL3", "GPL-3.0"), ("lesser general", "2.1", "LGPL2", "LGPL-2.1"), ("lesser general", "3", "LGPL3", "LGPL-3.0"), ("affero general", "3", "AGPL3", "AGPL-3.0"))
COMMONS = (("attribution", "BY"), ("attribution-sharealike", "BY-SA"), ("attribution-noncommercial", "BY-NC"), ("attribution-noderivatives", "BY-ND"), ("attribution-noncommercial-sharealike", "BY-NC-SA"), ("attribution-noncommercial-noderivatives", "BY-NC-ND"))
COMMONS_VERSIONS = (("4.0 international", "4"), ("3.0 unported", "3"))
#: Identifiers that a line ``SPDX-License-Identifier:`` may name.
SPDX = ("MIT", "ISC", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "BSL-1.0", "Unlicense", "CC0-1.0", *(f"CC-{c}-{v}.0" for _, c in COMMONS for _, v in COMMONS_VERSIONS), *(f"{g[3]}-{x}" for g in GNU for x in ("only", "or-later")))


#: Sentences with a place for a name, as they are in TEXTS: what stands in front of the name, behind it, and the sentence whose identifier they have.
SLOTS = (
    ("neither the name of ", " nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("the name of ", " may not be used to endorse or promote products derived from this software without specific prior written permission", "the name of the author may not be used to endorse or promote products derived from this software without specific prior written permission"),
    ("this software is provided by ", " as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed", "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"),
)
#: The most words of a name, which may hold periods but ends no sentence.
NAME_WORDS = 16


def _id(name: str) -> str:
    return name.upper().replace("-", "_").replace(".", "_")


def _sentences() -> dict[str, str]:
    """The texts above and those that follow a rule: notices of the GNU and Creative Commons licences, SPDX lines."""
    out = dict(TEXTS)
    for kind, version, short, _ in GNU:
        for work in ("program", "library", "file", "software"):
            out[f"this {work} is free software you can redistribute it and or modify it under the terms of the gnu {kind} public license as published by the free software foundation either version {version} of the license or at your option any later version"] = f"{short}_TERMS"
    for words, code in COMMONS:
        for version, v in COMMONS_VERSIONS:
            out[f"this work is licensed under a creative commons {words} {version} license"] = f"CC_{_id(code)}{v}_NOTICE"
            out[f"this work is licensed under the creative commons {words} {version} license"] = f"CC_{_id(code)}{v}_NOTICE"
    for name in SPDX:
        out[f"spdx-license-identifier {name.lower()}"] = f"SPDX_{_id(name)}"
    return out


SENTENCES = _sentences()

#: Rules over a sequence ``;ID;ID;``, the strongest first. A run must be whole and in this order.
RULES = (
    ("BSD-3-Clause", ("BSD_PERMIT", "BSD_SOURCE", "BSD_BINARY", "BSD_NAME")),
    ("BSD-2-Clause", ("BSD_PERMIT", "BSD_SOURCE", "BSD_BINARY")),
    ("Apache-2.0", ("APACHE2_NOTICE", "APACHE2_COMPLY", "APACHE2_COPY", "APACHE2_ASIS")),
    ("MIT", ("MIT_GRANT", "MIT_INCLUDE")),
    ("ISC", ("ISC_GRANT",)),
    ("BSL-1.0", ("BSL1_GRANT",)),
    *((f"{spdx}-or-later", (f"{short}_TERMS",)) for _, _, short, spdx in reversed(GNU)),
    *((name, (f"SPDX_{_id(name)}",)) for name in SPDX),
    ("GPL-3.0-only", ("GPL3_NOTICE",)),
    ("GPL-2.0-only", ("GPL2_NOTICE",)),
    *((f"{spdx}-only", (f"{short}_TITLE",)) for _, _, short, spdx in reversed(GNU)),
    ("Apache-2.0", ("APACHE2_NOTICE",)),
    ("Apache-2.0", ("APACHE2_TITLE",)),
    ("MPL-2.0", ("MPL2_NOTICE", "MPL2_COPY")),
    ("MPL-2.0", ("MPL2_TITLE",)),
    ("MIT", ("MIT_INCLUDE",)),
    ("MIT", ("MIT_NOTICE",)),
    ("BSL-1.0", ("BSL1_TITLE",)),
    ("BSL-1.0", ("BSL1_NOTICE",)),
    ("Unlicense", ("UNLICENSE_NOTICE", "UNLICENSE_GRANT")),
    ("Unlicense", ("UNLICENSE_NOTICE",)),
    ("CC0-1.0", ("CC0_DEED",)),
    ("CC0-1.0", ("CC0_NOTICE",)),
    ("CC0-1.0", ("CC0_TITLE",)),
    *((f"CC-{code}-{v}.0", (f"CC_{_id(code)}{v}_NOTICE",)) for _, code in reversed(COMMONS) for _, v in COMMONS_VERSIONS),
)

#: Every known sentence holds one of these, so a text without them needs no cutting.
HINT = "licen|copyright|distribut|permission|warrant|public domain|universal"
#: Texts are lower-cased, so capitals are free as marks: S ends a sentence, L is a semicolon. In this order they give boundaries without marks around them.
STEPS = (
    (r"\r\n?", "\n"),
    (r"(?<![.!?;]);++(?=[ \t\n])", "L"),
    (r"(?<![.!?;])[.!?;]++(?=[ \t\n])", "S"),
    (r"[^a-z0-9.+\nSL-]+", " "),
    (r"(?<=[\nSL])[ .+-]++", ""),
    (r"(?<![ .])[ .]++(?=[\nSL])", ""),
)
PARTS = r"(?: |L?\n|L)"
#: Inside a name an abbreviation's period ends no sentence.
NAME_PARTS = r"(?: |L?\n|L|S)"


def normalised(sentence: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(sentence), r"[^a-z0-9.+-]+", " "), r"^[ .]+|[ .]+$", "")


def sentence_pattern(sentences: dict[str, str] = SENTENCES) -> str:
    """Any known sentence between two boundaries of a text after STEPS, the longest first."""
    longest = sorted(sentences, key=len, reverse=True)
    spaced = lambda x: PARTS.join(re.escape(w) for w in x.split(" "))
    name = rf"{PARTS}(?:[a-z0-9.+-]+{NAME_PARTS}){{1,{NAME_WORDS}}}?"
    slots = [spaced(a.strip()) + name + spaced(b.strip()) for a, b, _ in SLOTS]
    return r"(?<=[\nSL])(?:" + "|".join([*(spaced(x) for x in longest), *slots]) + r")(?=[\nSL])"


def without_name(sentence: Column) -> Column:
    """A sentence with a name in its slot as the known sentence."""
    for a, b, known in SLOTS:
        sentence = F.when(sentence.startswith(a) & sentence.endswith(b), F.lit(known)).otherwise(sentence)
    return sentence


def known_sentences(text: Column, sentences: dict[str, str] = SENTENCES) -> Column:
    """The identifiers of the known sentences of a text, in order."""
    names = F.create_map(*[F.lit(x) for p in sentences.items() for x in p])
    marked = F.concat(F.lit("\n"), F.lower(text), F.lit("\n"))
    for pattern, by in STEPS:
        marked = F.regexp_replace(marked, pattern, by)
    hits = F.regexp_extract_all(marked, F.lit(sentence_pattern(sentences)), 0)
    looked_up = F.transform(hits, lambda s: F.element_at(names, without_name(F.regexp_replace(s, NAME_PARTS, " "))))
    return F.when(F.lower(text).rlike(HINT), looked_up).otherwise(F.array().cast("array<string>"))


def matches(sequence: Column, rules: tuple = RULES) -> Column:
    """The licences of the rules that fit, in their order, each once."""
    hits = [F.when(sequence.contains(f";{';'.join(ids)};"), F.lit(name)) for name, ids in rules]
    return F.array_distinct(F.array_compact(F.array(*hits)))


def scan(docs: DataFrame) -> DataFrame:
    """One row a document: doc_id, its sentence identifiers joined by spaces, how many they are, all licences that fit, joined by commas, and the first of them (null if none)."""
    ids = common.pick(docs, "doc_id", "text").select("doc_id", known_sentences(F.coalesce("text", F.lit(""))).alias("ids"))
    found = ids.select("doc_id", "ids", matches(F.concat(F.lit(";"), F.array_join("ids", ";"), F.lit(";"))).alias("found"))
    return found.select("doc_id", F.array_join("ids", " ").alias("sentences"), F.size("ids").cast("long").alias("n_sentences"), F.array_join("found", ",").alias("licences"), F.try_element_at("found", F.lit(1)).alias("licence"))


def oracle_sql() -> str:
    """The same over the documents table, in DuckDB."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"{quote(k)}: {quote(v)}" for k, v in SENTENCES.items())
    cases = ", ".join(f"CASE WHEN contains(seq, {quote(';' + ';'.join(ids) + ';')}) THEN {quote(name)} END" for name, ids in RULES)
    slot = "CASE " + " ".join(f"WHEN regexp_full_match(c, {quote(re.escape(a).replace(chr(92) + ' ', ' '))} || '[a-z0-9.+-]+( [a-z0-9.+-]+){{0,{NAME_WORDS - 1}}}' || {quote(re.escape(b).replace(chr(92) + ' ', ' '))}) THEN {quote(k)}" for a, b, k in SLOTS) + " ELSE c END"
    clean = r"regexp_replace(regexp_replace(lower(s), '[^a-z0-9.+-]+', ' ', 'g'), '^[ .]+|[ .]+$', '', 'g')"
    return f"""
WITH cut AS (
  SELECT doc_id, unnest(string_split_regex(coalesce(text, ''), '[.!?;]+[ \\t]+|[\\n\\r]+')) AS s, generate_subscripts(string_split_regex(coalesce(text, ''), '[.!?;]+[ \\t]+|[\\n\\r]+'), 1) AS place
  FROM documents
), cleaned AS (
  SELECT doc_id, place, {clean} AS c FROM cut
), named AS (
  SELECT doc_id, place, MAP {{{known}}}[{slot}] AS id FROM cleaned
), seqs AS (
  SELECT doc_id, string_agg(id, ';' ORDER BY place) AS ids, count(id) AS n FROM named WHERE id IS NOT NULL GROUP BY doc_id
), ruled AS (
  SELECT doc_id, ids, n, ';' || ids || ';' AS seq FROM seqs
), listed AS (
  SELECT doc_id, ids, n, list_filter([{cases}], lambda x: x IS NOT NULL) AS hits FROM ruled
), once AS (
  SELECT doc_id, ids, n, list_filter(hits, lambda x, i: list_position(hits, x) = i) AS found FROM listed
)
SELECT d.doc_id, coalesce(replace(o.ids, ';', ' '), '') AS sentences, coalesce(o.n, 0) AS n_sentences,
       coalesce(array_to_string(o.found, ','), '') AS licences, o.found[1] AS licence
FROM documents d LEFT JOIN once o ON d.doc_id = o.doc_id
"""
