"""License scan by sentence rules (DataFrame only).

A text is cut into sentences; a sentence is normalised (ASCII lower case, runs
of other characters to one space; the holder that a name clause names left out) and
looked up among known licence sentences.  The identifiers found, in order of appearance, form a sequence; sentences that
are not known leave no identifier.  Ordered rules are then matched against the
sequence: a rule is a run of identifiers, rules are tried in the given order and
what one rule has matched is not seen by later ones, so the full BSD text with
three clauses is not also reported with two.  Everything is one narrow
projection: no shuffle, no join, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licences, normalised, under their identifiers (never given anew).
SENTENCES = {
    1: "released under the mit license",
    2: "this project is licensed under the terms of the mit license",
    3: "licensed under the mit license",
    4: ("permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction including "
        "without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies "
        "of the software and to permit persons to whom the software is furnished to do so subject to the "
        "following conditions"),
    5: ("the above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the software"),
    6: "licensed under the apache license version 2 0",
    7: "licensed under the apache license version 2 0 the license",
    8: "you may not use this file except in compliance with the license",
    9: "you may obtain a copy of the license at",
    10: "this work is licensed under the gnu general public license version 3",
    11: "this work is licensed under the gnu general public license version 2",
    12: ("this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "general public license as published by the free software foundation either version 3 of the license or "
        "at your option any later version"),
    13: ("this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "general public license as published by the free software foundation either version 2 of the license or "
        "at your option any later version"),
    14: ("this program is distributed in the hope that it will be useful but without any warranty without even the "
        "implied warranty of merchantability or fitness for a particular purpose"),
    15: ("redistributions of source code must retain the above copyright notice this list of conditions and the "
        "following disclaimer"),
    16: ("redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
        "following disclaimer in the documentation and or other materials provided with the distribution"),
    17: ("neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission"),
    18: "licensed under cc by 4 0",
    19: "licensed under cc by sa 4 0",
    20: "licensed under cc by nc 4 0",
    21: "licensed under cc by nd 4 0",
    22: "this work is licensed under a creative commons attribution 4 0 international license",
    23: "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    24: "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    25: ("to the extent possible under law the author has waived all copyright and related or neighboring rights "
        "to this work"),
    26: ("permission to use copy modify and or distribute this software for any purpose with or without fee is "
        "hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    27: "this source code form is subject to the terms of the mozilla public license v 2 0",
    28: "if a copy of the mpl was not distributed with this file you can obtain one at",
    29: "all rights reserved",
    # pieces of official notices, cut where they have a mark inside
    30: "this program is free software",
    31: "this library is free software",
    32: "this program is distributed in the hope that it will be useful but without any warranty",
    33: "this library is distributed in the hope that it will be useful but without any warranty",
    34: "without even the implied warranty of merchantability or fitness for a particular purpose",
    35: ("you can redistribute it and or modify it under the terms of the gnu general public license as published "
        "by the free software foundation"),
    36: ("you can redistribute it and or modify it under the terms of the gnu lesser general public license as "
        "published by the free software foundation"),
    37: ("you can redistribute it and or modify it under the terms of the gnu library general public license as "
        "published by the free software foundation"),
    38: ("you can redistribute it and or modify it under the terms of the gnu affero general public license as "
        "published by the free software foundation"),
    39: "either version 2 of the license or at your option any later version",
    40: "either version 2 1 of the license or at your option any later version",
    41: "either version 3 of the license or at your option any later version",
    42: ("you can redistribute it and or modify it under the terms of the gnu general public license as published "
        "by the free software foundation either version 2 of the license or at your option any later version"),
    43: ("you can redistribute it and or modify it under the terms of the gnu general public license as published "
        "by the free software foundation either version 3 of the license or at your option any later version"),
    44: ("you can redistribute it and or modify it under the terms of the gnu lesser general public license as "
        "published by the free software foundation either version 2 1 of the license or at your option any later "
        "version"),
    45: ("you can redistribute it and or modify it under the terms of the gnu lesser general public license as "
        "published by the free software foundation either version 3 of the license or at your option any later "
        "version"),
    46: ("you can redistribute it and or modify it under the terms of the gnu affero general public license as "
        "published by the free software foundation either version 3 of the license or at your option any later "
        "version"),
    47: "this source code form is subject to the terms of the mozilla public license v",
    48: ("if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0"),
    49: ("if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0"),
    # further heads
    50: ("the name of the author may not be used to endorse or promote products derived from this software without "
        "specific prior written permission"),
    51: ("you can redistribute it and or modify it under the terms of the gnu general public license version 2 as "
        "published by the free software foundation"),
    52: ("you can redistribute it and or modify it under the terms of the gnu general public license version 3 as "
        "published by the free software foundation"),
    53: "this is free and unencumbered software released into the public domain",
    54: ("this program and the accompanying materials are made available under the terms of the eclipse public "
        "license 2 0 which is available at https www eclipse org legal epl 2 0"),
    55: ("this program and the accompanying materials are made available under the terms of the eclipse public "
        "license v2 0 which accompanies this distribution and is available at https www eclipse org legal epl v20 "
        "html"),
    56: ("this program and the accompanying materials are made available under the terms of the eclipse public "
        "license v1 0 which accompanies this distribution and is available at http www eclipse org legal epl v10 "
        "html"),
    57: "the asf licenses this file to you under the apache license version 2 0 the license",
    58: "this software is provided as is without any express or implied warranty",
    59: ("permission is granted to anyone to use this software for any purpose including commercial applications "
        "and to alter it and redistribute it freely subject to the following restrictions"),
    60: ("permission is hereby granted free of charge to any person or organization obtaining a copy of the "
        "software and accompanying documentation covered by this license the software to use reproduce display "
        "distribute execute and transmit the software and to prepare derivative works of the software and to "
        "permit third parties to whom the software is furnished to do so all subject to the following"),
    61: ("permission to use copy modify and or distribute this software for any purpose with or without fee is "
        "hereby granted"),
    62: ("this work is licensed under a creative commons attribution noncommercial sharealike 4 0 international "
        "license"),
    63: "this work is licensed under a creative commons attribution noderivatives 4 0 international license",
    64: ("this work is licensed under a creative commons attribution noncommercial noderivatives 4 0 international "
        "license"),
    # tag lines
    65: "spdx license identifier",
    66: "mit",
    67: "apache 2 0",
    68: "bsd 2 clause",
    69: "bsd 3 clause",
    70: "isc",
    71: "0bsd",
    72: "zlib",
    73: "bsl 1 0",
    74: "unlicense",
    75: "cc0 1 0",
    76: "gpl 2 0 only",
    77: "gpl 2 0",
    78: "gpl 2 0 or later",
    79: "gpl 3 0 only",
    80: "gpl 3 0",
    81: "gpl 3 0 or later",
    82: "lgpl 2 1 or later",
    83: "lgpl 3 0 or later",
    84: "agpl 3 0 only",
    85: "agpl 3 0 or later",
    86: "mpl 2 0",
    87: "epl 2 0",
    88: "cc by 4 0",
    89: "cc by sa 4 0",
    90: "cc by nc 4 0",
}

#: A reservation of rights: part of the notice of any licence beside it, a rule only where it stands alone.
RESERVED = 29

# Fixed values: (licence, kind, run of sentence identifiers), tried in this order.
RULES = (
    ("BSD-3-Clause", "permissive", (15, 16, 50)),
    ("BSD-3-Clause", "permissive", (15, 16, 17)),
    ("BSD-2-Clause", "permissive", (15, 16)),
    ("MIT", "permissive", (4, 5)),
    ("MIT", "permissive", (4,)),
    ("MIT", "permissive", (1,)),
    ("MIT", "permissive", (2,)),
    ("MIT", "permissive", (3,)),
    ("Apache-2.0", "permissive", (7, 8, 9)),
    ("Apache-2.0", "permissive", (7, 8)),
    ("Apache-2.0", "permissive", (7,)),
    ("Apache-2.0", "permissive", (6,)),
    ("GPL-3.0-or-later", "copyleft", (12, 14)),
    ("GPL-3.0-or-later", "copyleft", (12,)),
    ("GPL-2.0-or-later", "copyleft", (13, 14)),
    ("GPL-2.0-or-later", "copyleft", (13,)),
    ("GPL-3.0-only", "copyleft", (10,)),
    ("GPL-2.0-only", "copyleft", (11,)),
    ("MPL-2.0", "copyleft", (27, 28)),
    ("MPL-2.0", "copyleft", (27,)),
    ("ISC", "permissive", (26,)),
    ("CC0-1.0", "permissive", (25,)),
    ("CC-BY-SA-4.0", "copyleft", (19,)),
    ("CC-BY-SA-4.0", "copyleft", (23,)),
    ("CC-BY-NC-4.0", "restricted", (20,)),
    ("CC-BY-NC-4.0", "restricted", (24,)),
    ("CC-BY-ND-4.0", "restricted", (21,)),
    ("CC-BY-4.0", "permissive", (18,)),
    ("CC-BY-4.0", "permissive", (22,)),
    ("Proprietary", "restricted", (29,)),
    ("GPL-2.0-or-later", "copyleft", (35, 39)),
    ("GPL-2.0-or-later", "copyleft", (42,)),
    ("GPL-3.0-or-later", "copyleft", (35, 41)),
    ("GPL-3.0-or-later", "copyleft", (43,)),
    ("LGPL-2.0-or-later", "copyleft", (37, 39)),
    ("LGPL-2.1-or-later", "copyleft", (36, 40)),
    ("LGPL-2.1-or-later", "copyleft", (44,)),
    ("LGPL-3.0-or-later", "copyleft", (36, 41)),
    ("LGPL-3.0-or-later", "copyleft", (45,)),
    ("AGPL-3.0-or-later", "copyleft", (38, 41)),
    ("AGPL-3.0-or-later", "copyleft", (46,)),
    ("MPL-2.0", "copyleft", (47, 48)),
    ("MPL-2.0", "copyleft", (47, 49)),
    ("GPL-2.0-only", "copyleft", (51,)),
    ("GPL-3.0-only", "copyleft", (52,)),
    ("Unlicense", "permissive", (53,)),
    ("EPL-2.0", "copyleft", (54,)),
    ("EPL-2.0", "copyleft", (55,)),
    ("EPL-1.0", "copyleft", (56,)),
    ("Apache-2.0", "permissive", (57, 8, 9)),
    ("Apache-2.0", "permissive", (57,)),
    ("Zlib", "permissive", (58, 59)),
    ("Zlib", "permissive", (59,)),
    ("BSL-1.0", "permissive", (60,)),
    ("0BSD", "permissive", (61,)),
    ("CC-BY-NC-SA-4.0", "restricted", (62,)),
    ("CC-BY-ND-4.0", "restricted", (63,)),
    ("CC-BY-NC-ND-4.0", "restricted", (64,)),
    ("MIT", "permissive", (65, 66)),
    ("Apache-2.0", "permissive", (65, 67)),
    ("BSD-2-Clause", "permissive", (65, 68)),
    ("BSD-3-Clause", "permissive", (65, 69)),
    ("ISC", "permissive", (65, 70)),
    ("0BSD", "permissive", (65, 71)),
    ("Zlib", "permissive", (65, 72)),
    ("BSL-1.0", "permissive", (65, 73)),
    ("Unlicense", "permissive", (65, 74)),
    ("CC0-1.0", "permissive", (65, 75)),
    ("GPL-2.0-only", "copyleft", (65, 76)),
    ("GPL-2.0-only", "copyleft", (65, 77)),
    ("GPL-2.0-or-later", "copyleft", (65, 78)),
    ("GPL-3.0-only", "copyleft", (65, 79)),
    ("GPL-3.0-only", "copyleft", (65, 80)),
    ("GPL-3.0-or-later", "copyleft", (65, 81)),
    ("LGPL-2.1-or-later", "copyleft", (65, 82)),
    ("LGPL-3.0-or-later", "copyleft", (65, 83)),
    ("AGPL-3.0-only", "copyleft", (65, 84)),
    ("AGPL-3.0-or-later", "copyleft", (65, 85)),
    ("MPL-2.0", "copyleft", (65, 86)),
    ("EPL-2.0", "copyleft", (65, 87)),
    ("CC-BY-4.0", "permissive", (65, 88)),
    ("CC-BY-SA-4.0", "copyleft", (65, 89)),
    ("CC-BY-NC-4.0", "restricted", (65, 90)),
)

#: Ends of sentences: closing marks before white space, blank lines.
SENTENCE_END = r"[.!?;:]+[ \t\r\n]+|\n[ \t\r]*\n"
#: The same, and every line on its own: for notices that end without a mark.
LINE_END = r"[.!?;:]+[ \t\r\n]+|\n"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: What a holder's name may stand for, and what the known sentence has there.
HELD_BY = ("^neither the name of .+ nor the names of its contributors may be used", "neither the name of")
HELD_AS = "neither the name of the copyright holder nor the names of its contributors may be used"
#: A copyright line and the reservation below it, as one sentence.
CLAIM = ("copyright ", " all rights reserved")
#: Unknown sentences that may lie between a reservation of rights and its licence.
APART = 8


def _identifiers(text: Column, end: str, known: Column) -> Column:
    """`` 4 ... 5 ``: known identifiers in order, each between two spaces of its own,
    and a dot for every sentence that is not known."""
    sentences = F.split(F.translate(text, UPPER, LOWER), end)
    plain = F.transform(sentences, lambda s: F.btrim(F.regexp_replace(s, "[^a-z0-9]+", " ")))
    meant = lambda s: (F.when(s.startswith(HELD_BY[1]), F.regexp_replace(s, HELD_BY[0], HELD_AS))
                       .when(s.startswith(CLAIM[0]) & s.endswith(CLAIM[1]), F.lit(SENTENCES[RESERVED])).otherwise(s))
    place = lambda s: F.array_position(known, meant(s))
    token = lambda s: F.transform(F.array(place(s)), lambda k: F.when(k > 0, F.concat(F.lit(" "), k.cast("string"), F.lit(" ")))
                                  .otherwise(F.when(s == "", "").otherwise(".")))[0]
    return F.concat_ws("", F.transform(plain, token))


def _matched(dotted: Column) -> Column:
    """The identifiers with each rule's run replaced by `` R<rule number> ``."""
    sequence = F.translate(dotted, ".", "")
    for number, (_, _, run) in enumerate(RULES, 1):
        if run != (RESERVED,):
            sequence = F.replace(sequence, F.lit("".join(f" {k} " for k in run)), F.lit(f" R{number} "))
    return sequence


def _alone(dotted: Column, marked: Column) -> Column:
    """Whether a reservation of rights has no licence beside it."""
    alone = F.replace(dotted, F.lit(f" {RESERVED} "), F.lit(" P "))
    for _ in range(2):  # twice: two reservations may stand together
        alone = F.regexp_replace(alone, f" P (\\.{{0,{APART}}} [0-9])", "$1")
        alone = F.regexp_replace(alone, f"([0-9] \\.{{0,{APART}}}) P ", "$1")
    return F.contains(alone, F.lit(" P ")) | (_holds(dotted) & ~F.contains(marked, F.lit(" R")))


def _holds(dotted: Column) -> Column:
    return F.contains(dotted, F.lit(f" {RESERVED} "))


def _named(marked: Column, names: list[str]) -> Column:
    numbers = F.regexp_extract_all(marked, F.lit("R([0-9]+)"), F.lit(1))
    table = F.array(*map(F.lit, names))
    return F.transform(numbers, lambda k: F.element_at(table, k.cast("int")))


def _in_places() -> list[str]:
    """The sentences, each at the place of its identifier."""
    return [SENTENCES.get(k, "") or f"no sentence {k}." for k in range(1, max(SENTENCES) + 1)]


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_sentences, sentence_ids, licenses, kinds, restricted``.

    ``n_sentences`` counts the pieces of the cut by line that have a letter or
    digit, ``sentence_ids`` holds the known identifiers in order (comma-joined; of
    the cut that finds more),
    ``licenses`` and ``kinds`` the distinct names that rules matched, sorted and
    comma-joined; ``restricted`` is true when a rule of that kind matched.  Both
    ways of cutting count: by sentence, for wrapped texts, and by line as well,
    for one-line notices; a licence is reported if either finds it.  A reservation of
    rights within a few sentences of a licence is part of its notice; it restricts
    only where it stands alone.  Very long texts are cut whole, in the scan.
    A null or empty text has 0 sentences and empty strings.  Null identifiers
    and repeated rows pass through, one result row each; other columns are
    ignored; an empty table gives an empty result.
    """
    known = F.array(*map(F.lit, _in_places()))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    df = docs.select(F.col(id_col).alias("doc_id"), text.alias("t"))
    df = df.select(
        "doc_id",
        F.size(F.filter(F.split("t", LINE_END), lambda s: s.rlike("[A-Za-z0-9]"))).alias("n_sentences"),
        _identifiers(F.col("t"), LINE_END, known).alias("by_line"),
        _identifiers(F.col("t"), SENTENCE_END, known).alias("by_sentence"))
    df = df.withColumns({"m_line": _matched(F.col("by_line")), "m_sentence": _matched(F.col("by_sentence"))})
    # alone in both cuts; one cut may see the reservation or the licence only
    by_line = _alone(F.col("by_line"), F.col("m_line"))
    reserved = F.when(_holds(F.col("by_sentence")) & _holds(F.col("by_line")), by_line & _alone(F.col("by_sentence"), F.col("m_sentence"))) \
                .when(_holds(F.col("by_sentence")), _alone(F.col("by_sentence"), F.col("m_sentence")) & ~F.contains("m_line", F.lit(" R"))) \
                .otherwise(by_line & ~F.contains("m_sentence", F.lit(" R")))
    rule = next(n for n, (_, _, run) in enumerate(RULES, 1) if run == (RESERVED,))
    df = df.withColumns({"m": F.concat("m_line", F.lit("|"), "m_sentence", F.when(reserved, f" R{rule} ").otherwise("")),
                         "by_line": F.translate("by_line", ".", ""), "by_sentence": F.translate("by_sentence", ".", "")})
    df = df.withColumn("ids", F.when(F.length("by_sentence") > F.length("by_line"), F.col("by_sentence")).otherwise(F.col("by_line")))
    kinds = F.array_sort(F.array_distinct(_named(F.col("m"), [k for _, k, _ in RULES])))
    return df.select(
        "doc_id", "n_sentences", F.replace(F.btrim("ids"), F.lit("  "), F.lit(",")).alias("sentence_ids"),
        F.concat_ws(",", F.array_sort(F.array_distinct(_named(F.col("m"), [n for n, _, _ in RULES])))).alias("licenses"),
        F.concat_ws(",", kinds).alias("kinds"), F.array_contains(kinds, "restricted").alias("restricted"))
