"""Licence scan by sentence rules.

A text is cut into sentences by ``CUTS``, one replacement after the other: at sentence marks before white space, at blank lines,
at lines of comment marks alone, after a line of copyright and before the openings of licence sentences; marks at the start
of a line and marks inside known sentences cut nothing, an SPDX tag is a sentence of its own.  A sentence, or else a line of
it, is normalised (names of holders become one name) and, if it is known, becomes an identifier.  The identifiers of a
document, in their order, are matched against ordered rules: a rule fires where its identifiers follow one another without
another known sentence between them.  ``YIELDS`` names what a licence gives way to; "all rights reserved" is a
licence of its own only where no other is found.

Only built-in column functions run.  A cheap test for a word that every known sentence holds one of comes first; it excludes
no match.  Both tables are constants of the plan.

A null or empty text has no sentences and no licences.  One row per row; repeated rows are scanned each; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Identifier and wording of known licence sentences, in lower case without punctuation.
SENTENCES = {
    "apache-2.0-notice": "licensed under the apache license version 2 0",
    "apache-2.0-terms": "licensed under the apache license version 2 0 the license",
    "apache-2.0-compliance": "you may not use this file except in compliance with the license",
    "apache-2.0-copy": "you may obtain a copy of the license at",
    "apache-2.0-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "mit-notice": "released under the mit license",
    "mit-title": "the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-condition": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "gpl-3.0-notice": "this work is licensed under the gnu general public license version 3",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-copy": "you should have received a copy of the gnu general public license along with this program",
    "cc-by-nc-4.0-notice": "licensed under cc by nc 4 0",
    "cc-by-4.0-notice": "licensed under cc by 4 0",
    "cc-by-sa-4.0-notice": "licensed under cc by sa 4 0",
    "cc0-notice": "this work is dedicated to the public domain under cc0 1 0 no rights reserved",
    "bsd-forms": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "mpl-2.0-notice": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "gpl-2.0-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-2.0-only": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation",
    "lgpl-2.1-free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "lgpl-3.0-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl-hope": "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "agpl-3.0-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "all-rights-reserved": "all rights reserved",
}

#: Licence and the sequences of sentences that show it.
RULES = {
    "Apache-2.0": [("apache-2.0-notice",), ("apache-2.0-terms", "apache-2.0-compliance", "apache-2.0-copy"), ("apache-2.0-compliance", "apache-2.0-copy", "apache-2.0-as-is")],
    "MIT": [("mit-notice",), ("mit-licensed",), ("mit-title", "mit-grant"), ("mit-grant", "mit-condition"), ("mit-grant", "mit-condition", "mit-as-is")],
    "GPL-3.0": [("gpl-3.0-notice",), ("gpl-free", "gpl-hope"), ("gpl-free", "gpl-hope", "gpl-copy")],
    "CC-BY-NC-4.0": [("cc-by-nc-4.0-notice",)],
    "CC-BY-4.0": [("cc-by-4.0-notice",)],
    "CC-BY-SA-4.0": [("cc-by-sa-4.0-notice",)],
    "CC0-1.0": [("cc0-notice",)],
    "BSD-3-Clause": [("bsd-forms", "bsd-source", "bsd-binary", "bsd-endorse"), ("bsd-source", "bsd-binary", "bsd-endorse")],
    "BSD-2-Clause": [("bsd-forms", "bsd-source", "bsd-binary")],
    "ISC": [("isc-grant",)],
    "MPL-2.0": [("mpl-2.0-notice",)],
    "Proprietary": [("all-rights-reserved",)],
}

RULES |= {
    "GPL-2.0": [("gpl-2.0-free", "gpl-hope"), ("gpl-2.0-only",)],
    "LGPL-2.1": [("lgpl-2.1-free", "lgpl-hope")],
    "LGPL-3.0": [("lgpl-3.0-free", "gpl-hope"), ("lgpl-3.0-free", "lgpl-hope")],
    "AGPL-3.0": [("agpl-3.0-free", "gpl-hope")],
}
# An SPDX tag names its licence: a sentence and a rule of one sentence for each licence that has such a name.
for _name in [n for n in RULES if n != "Proprietary"]:
    SENTENCES[f"spdx-{_name.lower()}"] = "spdx " + _name.lower().replace("-", " ").replace(".", " ")
    RULES[_name].append((f"spdx-{_name.lower()}",))

#: Licences that yield where one of the others is found.
YIELDS = {"BSD-2-Clause": ("BSD-3-Clause",), "Proprietary": tuple(n for n in RULES if n != "Proprietary")}

#: Every known sentence holds one of these.
ANCHORS = ("spdx", "licens", "permi", "redistribut", "warrant", "copyright", "rights")
MARK = "\x01"
_GAP = "[^a-z0-9\x01]+"
_OPENINGS = (
    "permission is hereby granted free of charge", "permission to use copy modify", "redistribution and use in source", "redistributions of source code must",
    "redistributions in binary form must", "neither the name of", "licensed under the apache license", "this program is free software",
    "this library is free software", "this source code form is subject",
)
_OPENING = "|".join(words.replace(" ", _GAP) for words in _OPENINGS)
_BLANK, _ID = r"[ \t\n\x0b\f\r]", "[a-z0-9.+-]+"


def _joined(before: str, mark: str, behind: str) -> tuple[str, str]:
    """A mark inside a known sentence that would cut it goes."""
    return "(" + before.replace(" ", _GAP) + ")" + mark + "(" + _GAP + behind.replace(" ", _GAP) + ")", "$1$2"


#: What is replaced by what, in this order, letter case aside; the patterns mean the same to Java and RE2.
CUTS = [
    # Line breaks of string literals.
    (r"\\[nrt]([\"' \t\r\n\\]|\z)", " $1"),
    # Comment marks at the start of a line; a line of them alone becomes a blank line.
    (r"^[ \t]*(?:[/*#;%!'>|\"-]+|<!--+|\(\*+|\{-+|(?:dnl|rem|c)(?:[ \t]+|\r?$))", ""),
    # A line of copyright stands for itself, whatever follows it.
    (r"^([ \t]*(?:copyright|\(c\)|©)[ \t:]*(?:\(c\)|©|[0-9]{4}|<year>|\[yyyy\])[^\n]*)\n", f"$1\n{MARK}"),
    (rf"spdx-license-identifier:[ \t(]*({_ID})[ \t]+(?:or|and)[ \t]+({_ID})", f"{MARK}spdx $1{MARK}spdx $2{MARK}"),
    (rf"spdx-license-identifier:[ \t(]*({_ID})", f"{MARK}spdx $1{MARK}"),
    (r"\(see[^()]{0,100}\)", ""),
    (f"([^a-z0-9])({_OPENING})", f"$1{MARK}$2"),
    _joined("free software", "[:;]", "you can"),
    _joined("any warranty", "[:;]", "without even"),
    _joined("license v", "[.]", "2[.]0"),
    _joined("cc0 1[.]0", "[.;:]", "no rights"),
    (rf"[.;:!?]+(?:{_BLANK}+|\z)|\n[ \t\r]*\n", MARK),
]

_ENDORSE = "neither the name of the copyright holder nor the names of its contributors may be used"
#: Ways to write one sentence, on normalised sentences: numbers of a list, names of holders, versions of an SPDX name.
SAME = [
    ("^[0-9]{1,2} ", ""),
    ("^neither the names? of (?:[a-z0-9]+ ){1,30}?nor the names? of (?:[a-z0-9]+ ){1,6}?may be used", _ENDORSE),
    ("^the names? of (?:[a-z0-9]+ ){1,30}?may not be used to endorse", f"{_ENDORSE} to endorse"),
    ("^(spdx [a-z0-9 ]+) (?:only|or later)$", "$1"),
]


def normal(text: Column) -> Column:
    words = F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))
    for pattern, same in SAME:
        words = F.regexp_replace(words, pattern, same)
    return words


def _known() -> Column:
    return F.create_map(*[F.lit(x) for name, words in SENTENCES.items() for x in (words, name)])


def _cut(text: Column) -> Column:
    """Sentences of a text."""
    for pattern, other in CUTS:
        # i: letter case aside, m: lines have starts and ends, d: only a line feed ends a line.
        text = F.regexp_replace(text, f"(?imd){pattern}", other)
    return F.split(text, MARK)


def sentence_ids(text: Column) -> Column:
    """Identifiers of the known sentences, in their order."""
    known = _known()
    lookup = lambda part: F.try_element_at(known, normal(part))
    in_lines = lambda part: F.transform(F.split(part, "\n"), lookup)
    of_sentence = lambda part: F.when(lookup(part).isNotNull(), F.array(lookup(part))).otherwise(in_lines(part))
    anchored = F.filter(_cut(text), lambda part: F.lower(part).rlike("|".join(ANCHORS)))
    return F.filter(F.flatten(F.transform(anchored, of_sentence)), lambda name: name.isNotNull())


def licences(ids: Column) -> Column:
    """Licences whose rules the sequence of identifiers fulfils, in the order of ``RULES``; a rule that another holds whole yields."""
    joined = F.concat(F.lit(" "), F.array_join(ids, " "), F.lit(" "))
    fires = {name: _any(joined, found) for name, found in RULES.items()}
    named = F.filter(F.array(*[F.when(F.coalesce(fires[name], F.lit(False)), F.lit(name)) for name in RULES]), lambda name: name.isNotNull())
    for name, others in YIELDS.items():
        beaten = F.arrays_overlap(named, F.array(*[F.lit(other) for other in others]))
        named = F.when(beaten, F.array_remove(named, name)).otherwise(named)
    return named


def _any(joined: Column, sequences: list[tuple[str, ...]]) -> Column:
    out = F.lit(False)
    for sequence in sequences:
        out = out | F.contains(joined, F.lit(" " + " ".join(sequence) + " "))
    return out


def scan(documents: DataFrame) -> DataFrame:
    """doc_id, sentence_ids, licences (arrays)."""
    hinted = F.lower("text").rlike("|".join(ANCHORS))
    ids = F.when(hinted, sentence_ids(F.col("text"))).otherwise(F.array().cast("array<string>"))
    found = documents.select("doc_id", ids.alias("sentence_ids"))
    return found.withColumn("licences", F.when(F.size("sentence_ids") > 0, licences(F.col("sentence_ids"))).otherwise(F.array().cast("array<string>")))
