"""Licence scan by sentence rules, in DataFrame functions only.

A text is normalised (letters and digits in lower case, one space between) with
marks where sentences end or may end, and known licence sentences are searched
between the marks, wrapped over lines or not. The numbers found, in text order,
are matched against licence rules, which are ordered runs of sentence numbers; the
longest rule wins. Sentences that name a licence are brought to one form first.

Defined cases: a null or empty text has no sentences and no licence; a repeated
sentence counts each time; a licence is reported once per document, in rule
order; repeated rows give repeated results; an empty table gives no rows; bytes 1 and 2 in a
text count as spaces.
"""

from __future__ import annotations

import json
import re

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Normalised licence sentences by number, and rules over them. NAMED adds the wordings of licences by name.
SENTENCES = {
    1: "licensed under the apache license version 2 0 the license",
    2: "you may not use this file except in compliance with the license",
    3: "you may obtain a copy of the license at http www apache org licenses license 2 0",
    4: "licensed under the apache license version 2 0",
    6: "licensed under the mit license",
    7: "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction",
    8: "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    9: "the software is provided as is without warranty of any kind",
    10: "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    11: "redistributions of source code must retain the above copyright notice",
    12: "redistributions in binary form must reproduce the above copyright notice",
    13: "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software",
    14: "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
    15: "licensed under the gnu general public license version 2",
    16: "licensed under the gnu general public license version 3",
    17: "this source code form is subject to the terms of the mozilla public license v 2 0",
    18: "licensed under cc by 4 0",
    19: "licensed under cc by sa 4 0",
    20: "licensed under cc by nc 4 0",
    21: "licensed under cc by nc sa 4 0",
    22: "licensed under cc by nd 4 0",
    23: "licensed under cc by nc nd 4 0",
    24: "this work is dedicated to the public domain under cc0 1 0",
    25: "all rights reserved",
    26: "spdx license identifier mit",
    27: "spdx license identifier apache 2 0",
    28: "spdx license identifier bsd 3 clause",
    29: "spdx license identifier gpl 3 0 only",
    30: "this is free and unencumbered software released into the public domain",
    31: "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    32: "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    33: "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    34: "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    35: "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    36: "all advertising materials mentioning features or use of this software must display the following acknowledgement",
    37: "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    38: "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following",
    39: "do what the fuck you want to public license",
    40: "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0",
    41: "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 which accompanies this distribution and is available at http www eclipse org legal epl v10 html",
    42: "the contents of this file are subject to the terms of the common development and distribution license the license",
    43: "this font software is licensed under the sil open font license version 1 1",
    44: "the artistic license 2 0",
    45: "microsoft public license ms pl",
    46: "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license version 1 3 or any later version published by the free software foundation with no invariant sections no front cover texts and no back cover texts",
    47: "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license version 1 2 or any later version published by the free software foundation with no invariant sections no front cover texts and no back cover texts",
    48: "university of illinois ncsa open source license",
    49: "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies",
    50: "python software foundation license version 2",
}
RULES = [
    ("Apache-2.0", (1, 2, 3)),
    ("Apache-2.0", (4,)),
    ("Apache-2.0", (4, 2)),
    ("Apache-2.0", (27,)),
    ("MIT", (7, 8, 9)),
    ("MIT", (6,)),
    ("MIT", (26,)),
    ("BSD-2-Clause", (10, 11, 12)),
    ("BSD-3-Clause", (10, 11, 12, 13)),
    ("BSD-3-Clause", (28,)),
    ("BSD-4-Clause", (10, 11, 12, 36, 13)),
    ("0BSD", (32,)),
    ("ISC", (31,)),
    ("Zlib", (37,)),
    ("BSL-1.0", (38,)),
    ("NCSA", (48,)),
    ("PostgreSQL", (49,)),
    ("PSF-2.0", (50,)),
    ("WTFPL", (39,)),
    ("GPL", (14,)),
    ("GPL-2.0", (15,)),
    ("GPL-3.0", (16,)),
    ("GPL-3.0", (29,)),
    ("LGPL-2.1", (33,)),
    ("LGPL-3.0", (34,)),
    ("AGPL-3.0", (35,)),
    ("GFDL-1.2", (47,)),
    ("GFDL-1.3", (46,)),
    ("MPL-2.0", (17,)),
    ("EPL-1.0", (41,)),
    ("EPL-2.0", (40,)),
    ("CDDL-1.0", (42,)),
    ("Artistic-2.0", (44,)),
    ("MS-PL", (45,)),
    ("OFL-1.1", (43,)),
    ("CC-BY-4.0", (18,)),
    ("CC-BY-SA-4.0", (19,)),
    ("CC-BY-NC-4.0", (20,)),
    ("CC-BY-NC-SA-4.0", (21,)),
    ("CC-BY-ND-4.0", (22,)),
    ("CC-BY-NC-ND-4.0", (23,)),
    ("CC0-1.0", (24,)),
    ("Unlicense", (30,)),
    ("Proprietary", (25,)),
]
# How licences are named after "licensed under the" and the like.
NAMED = {
    "Apache-2.0": ["apache license version 2 0", "apache license 2 0"],
    "MIT": ["mit license"],
    "BSD-2-Clause": ["bsd 2 clause license", "simplified bsd license"],
    "BSD-3-Clause": ["bsd 3 clause license", "new bsd license", "modified bsd license"],
    "ISC": ["isc license"],
    "Zlib": ["zlib license"],
    "BSL-1.0": ["boost software license version 1 0"],
    "GPL-2.0": ["gnu general public license version 2", "gnu general public license v2 0", "gnu gpl version 2", "gpl v2"],
    "GPL-3.0": ["gnu general public license version 3", "gnu general public license v3 0", "gnu gpl version 3", "gpl v3"],
    "LGPL-2.1": ["gnu lesser general public license version 2 1", "gnu lgpl version 2 1", "lgpl v2 1"],
    "LGPL-3.0": ["gnu lesser general public license version 3", "gnu lgpl version 3", "lgpl v3"],
    "AGPL-3.0": ["gnu affero general public license version 3", "gnu agpl version 3", "agpl v3"],
    "GFDL-1.2": ["gnu free documentation license version 1 2"],
    "GFDL-1.3": ["gnu free documentation license version 1 3"],
    "MPL-2.0": ["mozilla public license version 2 0", "mozilla public license v2 0"],
    "EPL-1.0": ["eclipse public license version 1 0", "eclipse public license v1 0"],
    "EPL-2.0": ["eclipse public license version 2 0", "eclipse public license 2 0", "eclipse public license v2 0"],
    "EUPL-1.2": ["eupl version 1 2", "european union public licence version 1 2"],
    "CDDL-1.0": ["common development and distribution license version 1 0"],
    "Artistic-2.0": ["artistic license 2 0"],
    "MS-PL": ["microsoft public license"],
    "OFL-1.1": ["sil open font license version 1 1"],
    "CC-BY-4.0": ["cc by 4 0", "creative commons attribution 4 0 international license"],
    "CC-BY-SA-4.0": ["cc by sa 4 0", "creative commons attribution sharealike 4 0 international license"],
    "CC-BY-NC-4.0": ["cc by nc 4 0", "creative commons attribution noncommercial 4 0 international license"],
    "CC-BY-NC-SA-4.0": ["cc by nc sa 4 0", "creative commons attribution noncommercial sharealike 4 0 international license"],
    "CC-BY-ND-4.0": ["cc by nd 4 0", "creative commons attribution noderivatives 4 0 international license"],
    "CC-BY-NC-ND-4.0": ["cc by nc nd 4 0", "creative commons attribution noncommercial noderivatives 4 0 international license"],
}
# What may stand before such a name; the lookup is by "licensed under" and the name.
WORKS = "work,software,project,program,document,file,code".split(",")
NAMING = rf"(?:(?:this (?:{'|'.join(WORKS)})|the code) is )?(?:licensed|released|distributed|available) under (?:the terms of )?(?:the |an? )?"
PLAIN = "licensed under "


def _plain(said: str) -> str:
    return re.sub("^" + NAMING, PLAIN, said)


def _add(name: str, said: str) -> None:
    """A sentence that names a licence by itself, under the next number from 101."""
    if _plain(said) not in map(_plain, SENTENCES.values()):
        SENTENCES[max(100, *SENTENCES) + 1] = said
        RULES.append((name, (max(SENTENCES),)))


for _name, _forms in NAMED.items():
    for _form in _forms:
        _add(_name, PLAIN + _form)
# Identifiers of licences, with what may follow those of the GNU licences.
for _name in dict.fromkeys(name for name, _ in RULES if name not in ("GPL", "Proprietary")):
    for _lead in ("spdx license identifier", "spdx"):
        for _tail in ("", " only", " or later") if "GPL" in _name or "GFDL" in _name else ("",):
            _add(_name, f"{_lead} {re.sub('[^a-z0-9]+', ' ', _name.lower())}{_tail}")
# Reserved rights are no licence; they are told where nothing else is found, and never part two sentences of a licence.
RESERVED = 25
# Whole sentences of the licence texts themselves, with the numbers they stand for.
_AS_PUBLISHED = "as published by the free software foundation"
_UNDER_GPL = "is free software you can redistribute it and or modify it under the terms of the gnu general public license"
WORDINGS = {
    "apache license version 2 0 january 2004": [4],
    "you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed "
    "under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": [3],
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the "
    "software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software "
    "and to permit persons to whom the software is furnished to do so subject to the following conditions": [7],
    "the above copyright notice and this permission notice including the next paragraph shall be included in all copies or substantial portions of the software": [8],
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a "
    "particular purpose and noninfringement": [9],
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": [11],
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other "
    "materials provided with the distribution": [12],
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without "
    "specific prior written permission": [13],
    "neither the name of the university nor the names of its contributors may be used to endorse or promote products derived from this software without specific "
    "prior written permission": [13],
    "neither the name of the organization nor the names of its contributors may be used to endorse or promote products derived from this software without specific "
    "prior written permission": [13],
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this "
    "permission notice appear in all copies": [31],
    "gnu lesser general public license version 2 1 february 1999": [33],
    "gnu lesser general public license version 3 29 june 2007": [34],
    "gnu affero general public license version 3 19 november 2007": [35],
    "boost software license version 1 0 august 17th 2003": [38],
    "sil open font license version 1 1 26 february 2007": [43],
    **{
        f"{what} {_UNDER_GPL}{end}": [14]
        for what in ("this program", "this software", "this file", "it")
        for end in (
            "", f" {_AS_PUBLISHED}",
            *(x for v in "23" for x in (f" {_AS_PUBLISHED} either version {v} of the license or at your option any later version", f" {_AS_PUBLISHED} version {v} of the license", f" version {v} {_AS_PUBLISHED}", f" {_AS_PUBLISHED} version {v}")),
        )
    },
    "gnu general public license version 2 june 1991": [15],
    "gnu general public license version 3 29 june 2007": [16],
    "mozilla public license version 2 0": [17],
    "spdx license identifier gpl 3 0 or later": [29],
}
# A sentence ends at . ! ? before white space or the end, but not in "v. 2.0". It may end
# at a line end or after : or ; too, but a known sentence may also run on over these.
# Patterns of both Spark and the SQL; marks stand doubled, so that two sentences can share one.
STEPS = [
    (r"[\x01\x02]", " "),
    (r"\b([vV])\.([ \t\r\n]+[0-9])", r"\1 \2"),
    (r"[.!?]+(?:[ \t\r\n]|\z)", "\x01"),
    (r"[:;]([ \t\r\n])", "\x02\\1"),
    (r"\r?\n", "\x02"),
    (r"[^A-Za-z0-9\x01\x02]+", " "),
    (r" ?([\x01\x02]) ?", r"\1\1"),
]
GAP = r"(?: |\x02{2,6})"


def _branches(said: list[list[str]]) -> str:
    """A pattern for any of the word lists, longer ones first."""
    tails: dict[str, list[list[str]]] = {}
    for words in said:
        if words:
            tails.setdefault(words[0], []).append(words[1:])
    found = []
    for word, rest in tails.items():
        more = _branches([r for r in rest if r])
        found.append(word + (f"(?:{GAP}{more})" + ("?" if [] in rest else "") if more else ""))
    return "(?:" + "|".join(found) + ")" if found else ""


def _known() -> dict[str, int]:
    """Numbers by sentence, naming sentences in their plain form."""
    return {_plain(said): number for number, said in SENTENCES.items()} | {_plain(said): numbers[0] for said, numbers in WORDINGS.items()}


def _pattern() -> str:
    """A known sentence between two places where sentences end or may end, with an item's sign before it."""
    names = [said[len(PLAIN) :].split() for said in _known() if said.startswith(PLAIN)]
    others = [said.split() for said in _known() if not said.startswith(PLAIN)]
    naming = NAMING.replace(" ", GAP)
    return rf"(?:^ ?|[\x01\x02])(?:[0-9a-z] )?({naming}{_branches(names)}|{_branches(others)}) ?(?:[\x01\x02]|\z)"


def marked(text: Column) -> Column:
    """Normalised text: \\x01 twice where a sentence ends, \\x02 twice where it may end."""
    for pattern, put in STEPS:
        text = F.regexp_replace(text, pattern, re.sub(r"\\(\d)", r"$\1", put))
    return F.lower(text)


def sentence_numbers(text: Column) -> Column:
    """Numbers of the known licence sentences, in text order.

    A known sentence stands between two places where sentences end or may end; it
    may be wrapped over lines, with comment signs at their beginnings. Of two that
    begin at the same place the longer one counts.
    """
    found = F.regexp_extract_all(marked(text), F.lit(_pattern()), F.lit(1))
    book = F.from_json(F.lit(json.dumps(_known())), "map<string,int>")
    numbers = F.transform(found, lambda s: F.element_at(book, F.regexp_replace(F.regexp_replace(s, "\x02+", " "), "^" + NAMING, PLAIN)))
    return F.coalesce(numbers, F.array().cast("array<int>"))


def _run(numbers: Sequence[int]) -> str:
    return "".join(f",{n}," for n in numbers)


def _tests() -> dict[str, list[tuple[str, list[str]]]]:
    """Per licence: runs of numbers, each with the longer runs of other licences that it is a part of."""
    found: dict[str, list[tuple[str, list[str]]]] = {}
    for name, run in RULES:
        if run != (RESERVED,):
            longer = [_run(r) for other, r in RULES if other != name and len(r) > len(run) and _run(run) in _run(r)]
            found.setdefault(name, []).append((_run(run), sorted(longer, key=len, reverse=True)))
    return found


def scan(docs: DataFrame) -> DataFrame:
    """Licences of every document: doc_id, n_sentences, sentence_ids (comma-separated), licences (comma-separated).

    One pass without a shuffle. A rule holds where its numbers follow each other
    among the document's known sentences, reserved rights left out; what a longer
    rule takes is not open to a shorter one. Reserved rights alone are ``Proprietary``.
    """
    found = docs.select("doc_id", sentence_numbers(F.col("text")).alias("_ids"))
    line = F.concat(F.lit(","), F.array_join(F.array_remove("_ids", RESERVED), ",,"), F.lit(","))
    found = found.select("doc_id", F.size("_ids").cast("bigint").alias("n_sentences"), F.array_join("_ids", ",").alias("sentence_ids"), line.alias("_line"))
    held = []
    for name, runs in _tests().items():
        hit = F.lit(False)
        for run, longer in runs:
            left = F.col("_line")
            for other in longer:
                left = F.replace(left, F.lit(other), F.lit("|"))
            hit = hit | left.contains(run)
        held.append(F.when(hit, F.lit(name)))
    alone = F.concat(F.lit(","), "sentence_ids", F.lit(",")).contains(f",{RESERVED},")
    found = found.select("doc_id", "n_sentences", "sentence_ids", F.concat_ws(",", *held).alias("_names"), alone.alias("_reserved"))
    names = F.when((F.col("_names") == "") & F.col("_reserved"), F.lit("Proprietary")).otherwise(F.col("_names"))
    return found.select("doc_id", "n_sentences", "sentence_ids", names.alias("licences"))


def scan_sql() -> str:
    """The same scan in DuckDB SQL."""
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    text = "coalesce(text, '')"
    for pattern, put in STEPS:
        put = {"\x01": "chr(1)", "\x02": "chr(2)", "\x02\\1": "chr(2) || '\\1'"}.get(put, quoted(put))
        text = f"regexp_replace({text}, {quoted(pattern)}, {put}, 'g')"
    book = ", ".join(f"{quoted(said)}: {number}" for said, number in _known().items())
    names = []
    for name, runs in _tests().items():
        hits = []
        for run, longer in runs:
            left = "line"
            for other in longer:
                left = f"replace({left}, {quoted(other)}, '|')"
            hits.append(f"contains({left}, {quoted(run)})")
        names.append(f"case when {' or '.join(hits)} then {quoted(name)} end")
    plain = f"regexp_replace(regexp_replace(s, '\\x02+', ' ', 'g'), {quoted('^' + NAMING)}, {quoted(PLAIN)})"
    return f"""
with marked as (select doc_id, lower({text}) as said from documents),
hits as (select doc_id, regexp_extract_all(said, {quoted(_pattern())}, 1) as found from marked),
book as (select map {{{book}}} as book),
ids as (select doc_id, list_transform(found, lambda s: book[{plain}]) as ids from hits, book),
lines as (
  select doc_id, len(ids)::bigint as n_sentences, coalesce(array_to_string(ids, ','), '') as sentence_ids,
    ',' || coalesce(array_to_string(list_filter(ids, lambda x: x <> {RESERVED}), ',,'), '') || ',' as line, list_contains(ids, {RESERVED}) as reserved from ids),
named as (select *, concat_ws(',', {', '.join(names)}) as names from lines)
select doc_id, n_sentences, sentence_ids, case when names = '' and reserved then 'Proprietary' else names end as licences from named"""
