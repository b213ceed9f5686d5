"""Licence scanning by sentence rules (native DataFrame operations only).

1. Text is cut into sentences, which are normalised: lower case, all but letters and
   digits to single spaces. Licence texts are wrapped and stand in comments, so marks that
   begin a line are taken off and a line end inside a paragraph is a space. Where a
   line begins or ends with a known sentence, the line end also counts as a
   possible sentence end.
2. Each normalised sentence that is a known licence sentence becomes its identifier;
   other sentences that speak of licences become UNKNOWN; the rest disappear.
3. The identifier sequence of a document is matched against ordered rules. A rule
   is a sequence of identifiers; where it occurs its identifiers are used up, so a
   full licence text is not reported again by the shorter rules after it. What was
   left and right of a match does not become neighbours.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty, without

# Normalised licence sentences by identifier.
SENTENCES: dict[str, tuple[str, ...]] = {
    "ApacheRef": (
        "licensed under the apache license version 2 0",
        "licensed under the apache license version 2 0 the license",
        "this project is licensed under the apache license version 2 0",
        "released under the apache license version 2 0",
    ),
    "ApacheNoUse": ("you may not use this file except in compliance with the license",),
    "ApacheCopy": ("you may obtain a copy of the license at http www apache org licenses license 2 0", "you may obtain a copy of the license at https www apache org licenses license 2 0"),
    "CopyAt": ("you may obtain a copy of the license at",),
    "ApacheURL": ("http www apache org licenses license 2 0", "https www apache org licenses license 2 0"),
    "ApacheSee": ("see the license for the specific language governing permissions and limitations under the license",),
    "ApacheBasis": (
        "unless required by applicable law or agreed to in writing software distributed under the license is "
        "distributed on an as is basis without warranties or conditions of any kind either express or implied",
    ),
    "MITRef": (
        "released under the mit license",
        "licensed under the mit license",
        "this project is licensed under the mit license",
        "distributed under the mit license",
        "mit license",
    ),
    "MITGrant": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
        "permit persons to whom the software is furnished to do so subject to the following conditions",
    ),
    "MITNotice": (
        "the above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the software",
    ),
    "AsIs": (
        "the software is provided as is without warranty of any kind express or implied including but not limited to "
        "the warranties of merchantability fitness for a particular purpose and noninfringement",
    ),
    "MITLiability": (
        "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether "
        "in an action of contract tort or otherwise arising from out of or in connection with the software or the use "
        "or other dealings in the software",
    ),
    "ISCGrant": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
    ),
    "UnlicenseGift": ("this is free and unencumbered software released into the public domain",),
    "BoostRef": ("distributed under the boost software license version 1 0", "boost software license version 1 0"),
    "GPL3Ref": (
        "this work is licensed under the gnu general public license version 3",
        "licensed under the gnu general public license version 3",
        "released under the gnu general public license version 3",
    ),
    "GPL2Ref": (
        "this work is licensed under the gnu general public license version 2",
        "licensed under the gnu general public license version 2",
    ),
    "GPLFree": ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",),
    "GPLHope": ("this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",),
    "GPL2Free": ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",),
    "LGPL3Free": ("this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",),
    "LGPL21Free": ("this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",),
    "AGPL3Free": ("this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",),
    "GPLWithout": ("this program is distributed in the hope that it will be useful but without any warranty", "this library is distributed in the hope that it will be useful but without any warranty"),
    "GPLImplied": ("without even the implied warranty of merchantability or fitness for a particular purpose",),
    "GPLSee": ("see the gnu general public license for more details", "see the gnu lesser general public license for more details", "see the gnu affero general public license for more details"),
    "GPLCopy": ("you should have received a copy of the gnu general public license along with this program", "you should have received a copy of the gnu affero general public license along with this program"),
    "BSDRedist": ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",),
    "BSDSource": ("redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",),
    "BSDBinary": ("redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",),
    "BSDNames": ("neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",),
    "MPL2Ref": ("this source code form is subject to the terms of the mozilla public license v 2 0",),
    "CCBYNCRef": ("licensed under cc by nc 4 0", "this work is licensed under cc by nc 4 0", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    "CCBYRef": ("licensed under cc by 4 0", "this work is licensed under cc by 4 0", "licensed under a creative commons attribution 4 0 international license"),
    "CCBYSARef": ("licensed under cc by sa 4 0", "this work is licensed under cc by sa 4 0"),
    "CC0Ref": ("released under cc0 1 0", "licensed under cc0 1 0"),
    "AllRights": ("all rights reserved",),
}

# Rules in order of precedence; the first match uses its sentences up.
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("Apache-2.0", ("ApacheRef", "ApacheNoUse", "ApacheCopy", "ApacheBasis")),
    ("Apache-2.0", ("ApacheRef", "ApacheNoUse", "CopyAt", "ApacheURL", "ApacheBasis", "ApacheSee")),
    ("Apache-2.0", ("ApacheRef", "ApacheNoUse", "CopyAt", "ApacheURL", "ApacheBasis")),
    ("Apache-2.0", ("ApacheRef", "ApacheNoUse")),
    ("MIT", ("MITGrant", "MITNotice", "AsIs", "MITLiability")),
    ("MIT", ("MITGrant", "MITNotice", "AsIs")),
    ("MIT", ("MITGrant", "MITNotice")),
    ("BSD-3-Clause", ("BSDRedist", "BSDSource", "BSDBinary", "BSDNames")),
    ("BSD-2-Clause", ("BSDRedist", "BSDSource", "BSDBinary")),
    ("GPL-3.0-or-later", ("GPLFree", "GPLWithout", "GPLImplied", "GPLSee", "GPLCopy")),
    ("GPL-3.0-or-later", ("GPLFree", "GPLWithout", "GPLImplied")),
    ("GPL-2.0-or-later", ("GPL2Free", "GPLWithout", "GPLImplied", "GPLSee", "GPLCopy")),
    ("GPL-2.0-or-later", ("GPL2Free", "GPLWithout", "GPLImplied")),
    ("AGPL-3.0-or-later", ("AGPL3Free", "GPLWithout", "GPLImplied", "GPLSee", "GPLCopy")),
    ("AGPL-3.0-or-later", ("AGPL3Free", "GPLWithout", "GPLImplied")),
    ("LGPL-3.0-or-later", ("LGPL3Free", "GPLWithout", "GPLImplied")),
    ("LGPL-2.1-or-later", ("LGPL21Free", "GPLWithout", "GPLImplied")),
    ("GPL-3.0-or-later", ("GPLFree", "GPLHope")),
    ("GPL-3.0-or-later", ("GPLFree",)),
    ("GPL-2.0-or-later", ("GPL2Free",)),
    ("AGPL-3.0-or-later", ("AGPL3Free",)),
    ("LGPL-3.0-or-later", ("LGPL3Free",)),
    ("LGPL-2.1-or-later", ("LGPL21Free",)),
    ("ISC", ("ISCGrant",)),
    ("Unlicense", ("UnlicenseGift",)),
    ("Apache-2.0", ("ApacheRef",)),
    ("MIT", ("MITRef",)),
    ("BSL-1.0", ("BoostRef",)),
    ("GPL-3.0-only", ("GPL3Ref",)),
    ("GPL-2.0-only", ("GPL2Ref",)),
    ("MPL-2.0", ("MPL2Ref",)),
    ("CC-BY-NC-4.0", ("CCBYNCRef",)),
    ("CC-BY-SA-4.0", ("CCBYSARef",)),
    ("CC-BY-4.0", ("CCBYRef",)),
    ("CC0-1.0", ("CC0Ref",)),
)
#: A sentence with one of these that is not known is UNKNOWN.
KEYWORDS = ("license", "licence", "licensed", "copyright", "warranty", "redistribution")
UNKNOWN = "UNKNOWN"
#: Patterns that mean the same to both engines: comment marks and bullets at the start of a line, a
#: version after "v.", sentence ends, and what normalising turns into a space. \x01 ends a sentence, \x02 may.
SPACE = r"[ \t\n\x0b\f\r]"
MARKS = r"(^|\n)[ \t]*[#*;%/!>|-]+[ \t]*"
VERSION = rf"\bv\.{SPACE}+([0-9])"
STOP = rf"([.!?;]){SPACE}+"
PARAGRAPH = r"\n[ \t\r]*\n"
ITEM = r":[ \t\r]*\n[ \t]*([(0-9])"
ODD = r"[^a-z0-9]+"


def _plain(some: Column) -> Column:
    return F.trim(F.regexp_replace(some, ODD, " "))


def _table(known: Mapping[str, Sequence[str]]) -> Column:
    return F.create_map(*[F.lit(x) for name, forms in known.items() for form in forms for x in (form, name)])


def folded(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ\u0001\u0002", "abcdefghijklmnopqrstuvwxyz  ")


def sentences_of(text: Column, known: Mapping[str, Sequence[str]] = SENTENCES) -> Column:
    """Normalised sentences of folded text; letters outside a-z act as spaces."""
    table = _table(known)
    bare = F.regexp_replace(text, MARKS, "$1")
    bare = F.regexp_replace(bare, VERSION, "v $1")

    def line(x: Column) -> Column:
        parts = F.split(x, STOP)
        first, last = _plain(parts[0]), _plain(F.element_at(parts, -1))
        before = F.when(F.map_contains_key(table, first), F.lit("\u0002")).otherwise(F.lit(""))
        after = F.when(F.map_contains_key(table, last), F.lit("\u0002")).otherwise(F.lit(""))
        return F.concat(before, x, after)

    bare = F.array_join(F.transform(F.split(bare, "\n"), line), "\n")
    bare = F.regexp_replace(F.regexp_replace(bare, ITEM, "\u0001$1"), f"\u0002?{PARAGRAPH}", "\u0001")
    whole = F.split(F.regexp_replace(bare, STOP, "\u0001"), "\u0001")

    def pieces(x: Column) -> Column:
        """The sentence itself if it is known across line ends, else what the line ends leave."""
        alone = F.map_contains_key(table, _plain(x)) | ~F.contains(x, F.lit("\u0002"))
        return F.when(alone, F.array(_plain(x))).otherwise(F.transform(F.split(x, "\u0002"), _plain))

    return F.flatten(F.transform(whole, pieces))


def identifiers_of(text: Column, known: Mapping[str, Sequence[str]], keywords: Sequence[str]) -> Column:
    """Identifier of each licence sentence of a text in order; others are left out."""
    table = _table(known)
    speaks = r"\b(" + "|".join(keywords) + r")\b"
    forms = {form for some in known.values() for form in some}
    # Of a form without any keyword its first three words tell where it may be.
    begins = [f.split()[:3] for f in forms if not any(k in f.split() for k in keywords)]
    spaced = sorted({*keywords, *(" ".join(b) for b in begins)})
    marks = "|".join(sorted({*keywords, *(ODD.join(b) for b in begins)}))
    named = F.transform(
        F.filter(sentences_of(text, known), lambda s: s.rlike(r"\b(" + "|".join(spaced) + r")\b")),
        lambda s: F.coalesce(F.try_element_at(table, s), F.when(s.rlike(speaks), F.lit(UNKNOWN))),
    )
    # Nearly all texts hold none of these; only the others are cut into sentences.
    return F.when(text.rlike(marks), F.filter(named, lambda x: x.isNotNull())).otherwise(F.array().cast("array<string>"))


def match_rules(identifiers: Column, rules: Sequence[tuple[str, Sequence[str]]]) -> tuple[Column, Column]:
    """(licences in rule order without repeats, identifiers no rule used)."""
    left = F.concat(F.lit(";"), F.array_join(identifiers, ";;"), F.lit(";"))
    barrier = F.lit("|")
    found = []
    for licence, parts in rules:
        pattern = F.lit("".join(f";{p};" for p in parts))
        found.append(F.when(F.contains(left, pattern), F.lit(licence)))
        left = F.replace(left, pattern, barrier)
    licences = F.array_distinct(F.array_compact(F.array(*found)))
    rest = F.filter(F.split(left, "[;|]+"), lambda x: x != "")
    return licences, rest


def scan(
    docs: DataFrame,
    text_col: str = "text",
    known: Mapping[str, Sequence[str]] = SENTENCES,
    rules: Sequence[tuple[str, Sequence[str]]] = RULES,
    keywords: Sequence[str] = KEYWORDS,
) -> DataFrame:
    """All rows and columns plus ``licences``, ``licence_sentences`` and ``unmatched_sentences`` (arrays).

    Null and empty texts have none. ``unmatched_sentences`` are identifiers, UNKNOWN
    included, that no rule used. Repeated rows give repeated results. Input
    columns of these names are replaced.
    """
    out = without(docs, "licences", "licence_sentences", "unmatched_sentences")
    found = identifiers_of(folded(text_or_empty(text_col)), known, keywords)
    out = out.withColumn("licence_sentences", found)
    # Nearly all texts have no licence sentence; the rules run for the others only.
    some = F.size("licence_sentences") > 0
    licences, rest = match_rules(F.col("licence_sentences"), rules)
    none = F.array().cast("array<string>")
    return out.withColumn("licences", F.when(some, licences).otherwise(none)).withColumn(
        "unmatched_sentences", F.when(some, rest).otherwise(none)
    )
