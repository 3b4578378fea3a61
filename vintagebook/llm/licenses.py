"""Licence recognition by sentences and ordered rules.

A text is normalised (A-Z lower-cased, runs of other than a-z and 0-9 become
one space, so comment markers go) with marks at its line ends and after ``. ! ?``
before a space.  A known licence sentence is found where it lies between two
marks, line ends inside it ignored, so hard-wrapped notices match as well as
single lines; of several that start at one place the longest is taken.
The identifiers found, in text order, form the document's sequence; a licence
is recognised when its rule's identifiers occur in that order, other
identifiers in between allowed.

Defined cases: a null or empty text, and one without known sentences, has no
identifiers and no licences; repeated sentences stay repeated in the
sequence; licences are listed once each in the rules' order; every row gives
one row, extra columns are kept.  Row-wise Spark expressions: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, reserve

# Identifier -> known licence sentences, normalised.
SENTENCES = {
    "apache-ref": ["licensed under the apache license version 2 0"],
    "apache-not-use": ["you may not use this file except in compliance with the license"],
    "apache-obtain": ["you may obtain a copy of the license at http www apache org licenses license 2 0"],
    "mit-ref": ["released under the mit license", "licensed under the mit license"],
    "mit-grant": ["permission is hereby granted free of charge to any person obtaining a copy of this "
                  "software and associated documentation files the software to deal in the software "
                  "without restriction"],
    "mit-notice": ["the above copyright notice and this permission notice shall be included in all "
                   "copies or substantial portions of the software"],
    "as-is": ["the software is provided as is without warranty of any kind express or implied"],
    "gpl3-ref": ["this work is licensed under the gnu general public license version 3"],
    "gpl-free": ["this program is free software you can redistribute it and or modify it under the "
                 "terms of the gnu general public license as published by the free software foundation"],
    "gpl-warranty": ["this program is distributed in the hope that it will be useful but without any "
                     "warranty"],
    "cc-by-nc-ref": ["licensed under cc by nc 4 0"],
    "cc-by-ref": ["licensed under cc by 4 0",
                  "this work is licensed under a creative commons attribution 4 0 international license"],
    "bsd-redistribute": ["redistribution and use in source and binary forms with or without "
                         "modification are permitted provided that the following conditions are met"],
    "bsd-source": ["redistributions of source code must retain the above copyright notice this list of "
                   "conditions and the following disclaimer"],
    "bsd-binary": ["redistributions in binary form must reproduce the above copyright notice this list "
                   "of conditions and the following disclaimer in the documentation and or other "
                   "materials provided with the distribution"],
    "reserved": ["all rights reserved"],
}
# Fixed values: (licence, identifiers in order).
RULES = (
    ("Apache-2.0", ("apache-ref",)),
    ("Apache-2.0", ("apache-not-use", "apache-obtain")),
    ("MIT", ("mit-ref",)),
    ("MIT", ("mit-grant", "mit-notice", "as-is")),
    ("GPL-3.0", ("gpl3-ref",)),
    ("GPL", ("gpl-free", "gpl-warranty")),
    ("CC-BY-NC-4.0", ("cc-by-nc-ref",)),
    ("CC-BY-4.0", ("cc-by-ref",)),
    ("BSD-2-Clause", ("bsd-redistribute", "bsd-source", "bsd-binary")),
    ("All-Rights-Reserved", ("reserved",)),
)
_FREE = "* is free software you can redistribute it and or modify it under the terms of the "
_FSF = " as published by the free software foundation "
_LATER = " of the license or at your option any later version"
_MIT = SENTENCES["mit-grant"][0]
_NO_WARRANTY = (" is distributed in the hope that it will be useful but without any warranty without even "
                "the implied warranty of merchantability or fitness for a particular purpose")
# The whole sentences of the licence texts and notices, with their
# variants; "*" stands for one to twelve words.
WHOLE = {
    "apache-ref": ["licensed under the apache license version 2 0 the license",
                   "licensed under the apache license version 2 0 the license you may not use this file "
                   "except in compliance with the license"],
    "apache-obtain": ["you may obtain a copy of the license at https www apache org licenses license 2 0"],
    "mit-grant": [f"{_MIT} including without limitation the rights to use copy modify merge publish "
                  "distribute sublicense and or sell copies of the software and to permit persons to whom "
                  "the software is furnished to do so subject to the following conditions"],
    "mit-notice": ["the above copyright notice and this permission notice including the next paragraph "
                   "shall be included in all copies or substantial portions of the software"],
    "as-is": [f"{SENTENCES['as-is'][0]} including but not limited to the warranties of merchantability "
              f"fitness for a particular purpose and {x}" for x in ("noninfringement", "non infringement")],
    "isc-grant": [f"permission to use copy modify {x}distribute this software for any purpose with or "
                  "without fee is hereby granted provided that the above copyright notice and this "
                  "permission notice appear in all copies" for x in ("and or ", "and ")],
    "isc-as-is": ["the software is provided as is and the author disclaims all warranties with regard to "
                  "this software including all implied warranties of merchantability and fitness"],
    **{f"{k}-{v}-free": [f"{_FREE}gnu {n}general public license{_FSF}{e}version {v}{t}"
                         for e, t in (("either ", _LATER), ("", " of the license"))]
       for k, n, vs in (("gpl", "", "23"), ("lgpl", "lesser ", ("2 1", "3")), ("agpl", "affero ", "3"))
       for v in vs},
    "gpl-warranty": [f"*{_NO_WARRANTY}"],
    "mpl-2-ref": ["this source code form is subject to the terms of the mozilla public license v"],
    "bsd-endorse": ["neither the name of * nor the names of * may be used to endorse or promote products "
                    "derived from this software without specific prior written permission"],
    "bsd-as-is": ["this software is provided by * as is and any express or implied warranties including "
                  "but not limited to the implied warranties of merchantability and fitness for a "
                  "particular purpose are disclaimed"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
    "apache-head": ["apache license version 2 0 january 2004"],
    "mit-ref": ["licensed under the mit license see license", "distributed under the mit license",
                "distributed under the terms of the mit license"],
    "apache-terms": ["distributed under the terms of the apache license 2 0",
                     "distributed under the terms of the apache license version 2 0"],
    "cc-by-sa-ref": ["licensed under cc by sa 4 0", "this work is licensed under a creative commons "
                     "attribution sharealike 4 0 international license"],
    "boost-ref": ["distributed under the boost software license version 1 0"],
    "boost-head": ["boost software license version 1 0 august 17th 2003"],
    "gpl3-head": ["gnu general public license version 3 29 june 2007"],
    **{f"spdx-{x}": [f"spdx license identifier {x}"] for x in (
        "apache 2 0", "mit", "isc", "bsd 2 clause", "bsd 3 clause", "mpl 2 0", "bsl 1 0", "unlicense",
        "cc by 4 0", "cc by sa 4 0")},
    **{f"spdx-{x}": [f"spdx license identifier {x}{t}" for t in ("", " only", " or later")] for x in (
        "gpl 2 0", "gpl 3 0", "lgpl 2 1", "lgpl 3 0", "agpl 3 0")},
}
WHOLE_RULES = (
    ("ISC", ("isc-grant", "isc-as-is")),
    ("GPL-2.0", ("gpl-2-free", "gpl-warranty")),
    ("GPL-3.0", ("gpl-3-free", "gpl-warranty")),
    ("LGPL-2.1", ("lgpl-2 1-free", "gpl-warranty")),
    ("LGPL-3.0", ("lgpl-3-free", "gpl-warranty")),
    ("AGPL-3.0", ("agpl-3-free", "gpl-warranty")),
    ("MPL-2.0", ("mpl-2-ref",)),
    ("BSD-3-Clause", ("bsd-redistribute", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("Unlicense", ("unlicense",)),
    ("Apache-2.0", ("apache-head",)),
    ("Apache-2.0", ("apache-terms",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-ref",)),
    ("BSL-1.0", ("boost-ref",)),
    ("BSL-1.0", ("boost-head",)),
    ("GPL-3.0", ("gpl3-head",)),
    *((name, (f"spdx-{name.lower().replace('-', ' ').replace('.', ' ')}",)) for name in (
        "Apache-2.0", "MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "BSL-1.0", "Unlicense",
        "CC-BY-4.0", "CC-BY-SA-4.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0")),
)
KNOWN = {i: SENTENCES.get(i, []) + WHOLE.get(i, []) for i in {**SENTENCES, **WHOLE}}
ALL_RULES = RULES + WHOLE_RULES
# A licence whose rule goes on from another's stands in its place.
REPLACES = {"BSD-3-Clause": "BSD-2-Clause"}
# Every known sentence holds one of these strings, so a text without them has none.
ANCHORS = (r"(?i)licen[cs]e|permission|copyright|warranty|warranties|redistribut|rights reserved"
           r"|contributors|public\s+domain")


def marked(text: Column) -> Column:
    """The normalised text, with S at sentence ends and L at line ends."""
    out = ascii_lower(F.coalesce(text, F.lit("")))
    for pattern, by in (
            (r"(?<=conditions|are met):[\x20\x09]+", " L "),  # the list may go on in the line
            (r"(?<![.!?])[.!?]++([\x20\x09-\x0D]+|$)", " S "), (r"[\n\r]+", " L "), (r"[^a-z0-9SL]+", " "),
            (r"(?<=[SL]) (?:dnl|rem) ", " "),  # comment markers that are words
            # labels of list items
            (r" L (?:[0-9]{1,2}|[a-z]|i{2,3}) (?=(?:redistributions|neither) )", " L "),
            # runs of line ends first, so that no run is read again from each of its places
            (r" L(?: L)++(?= )", " L"), (r" (?:L )?S (?:[SL] )*+", " S ")):
        out = F.regexp_replace(out, pattern, by)
    return F.concat(F.lit("S "), F.trim(out), F.lit(" S"))


def sentence_ids(text: Column, known: dict[str, list[str]] = KNOWN) -> Column:
    """The identifiers of the known sentences of ``text``, in text order.  A
    table of its own is looked up without the anchor test."""
    every = sorted(((s, i) for i, ss in known.items() for s in ss), key=lambda x: (-len(x[0]), x))
    slot = "[a-z0-9]+(?: [a-z0-9]+){0,11}"
    # in a match the line ends are gone; here they may stand at any space
    gap = lambda s: s.replace(" ", "(?: L)? ")
    either = "|".join(gap(s).replace("*", gap(slot)) for s, _ in every)
    hits = F.regexp_extract_all(marked(text), F.lit(f"(?<=[SL] )({either})(?= [SL])"), F.lit(1))
    ids = F.create_map(*[x for s, i in every if "*" not in s for x in (F.lit(s), F.lit(i))])
    open_ = [(f"^{s.replace('*', slot)}$", i) for s, i in every if "*" in s]

    def named(hit: Column) -> Column:
        return F.coalesce(F.element_at(ids, hit), *[F.when(hit.rlike(p), F.lit(i)) for p, i in open_])

    found = F.transform(F.transform(hits, lambda x: F.replace(x, F.lit(" L "), F.lit(" "))), named)
    if known is not KNOWN:
        return found
    return F.when(text.rlike(ANCHORS), found).otherwise(F.array().cast("array<string>"))


def licenses_of(ids: Column, rules=ALL_RULES) -> Column:
    """The licences whose identifiers occur in ``ids`` in their order."""
    joined = F.concat(F.lit("|"), F.array_join(ids, "|"), F.lit("|"))
    hits = [F.when(joined.rlike("".join(
        (r".*" if k else "") + r"\|" + s + r"(?=\|)" for k, s in enumerate(seq))), F.lit(name))
        for name, seq in rules]
    names = F.array_distinct(F.filter(F.array(*hits), lambda x: x.isNotNull()))
    for more, less in REPLACES.items():
        names = F.when(F.array_contains(names, more), F.array_remove(names, less)).otherwise(names)
    return names


def scan_licenses(docs: DataFrame, text_col: str = "text", known: dict[str, list[str]] = KNOWN,
                  rules=ALL_RULES) -> DataFrame:
    """Add ``sentence_ids`` and ``licenses`` (arrays of strings), which ``docs``
    may not have yet (ValueError)."""
    reserve(docs, "sentence_ids", "licenses")
    out = docs.withColumn("sentence_ids", sentence_ids(F.col(text_col), known))
    return out.withColumn("licenses", licenses_of(F.col("sentence_ids"), rules))


def oracle_sql() -> str:
    """DuckDB twin of the registered query (ids and licences joined by commas)."""
    up, low = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    values = ", ".join(f"('{s}', '{i}')" for i, ss in KNOWN.items() for s in ss if "*" not in s)
    hit = []
    for k, (name, seq) in enumerate(ALL_RULES):
        cond = "ids IS NOT NULL AND regexp_matches('|' || ids || '|', '" + "".join(
            (".*" if j else "") + r"\|" + s + (r"\|" if j == len(seq) - 1 else "")
            for j, s in enumerate(seq)) + "')"
        hit.append((name, cond))
    names = list(dict.fromkeys(n for n, _ in hit))
    parts = ", ".join("CASE WHEN " + " OR ".join(f"({c})" for n, c in hit if n == x)
                      + f" THEN '{x}' END" for x in names)
    return f"""
WITH known(sentence, id) AS (VALUES {values}),
cut AS (SELECT rowid_, unnest(parts) AS s, unnest(range(len(parts))) AS k FROM (
  SELECT row_number() OVER () AS rowid_, string_split_regex(coalesce(text, ''),
    '[.!?]+([\\x20\\x09-\\x0D]+|$)|[\\n\\r]+') AS parts, doc_id FROM documents)),
ids AS (SELECT rowid_, string_agg(id, '|' ORDER BY k) AS ids FROM cut JOIN known
  ON trim(regexp_replace(translate(s, '{up}', '{low}'), '[^a-z0-9]+', ' ', 'g')) = sentence
  GROUP BY rowid_),
d AS (SELECT row_number() OVER () AS rowid_, doc_id FROM documents)
SELECT doc_id, coalesce(replace(ids, '|', ','), '') AS sentence_ids,
  concat_ws(',', {parts}) AS licenses
FROM d LEFT JOIN ids USING (rowid_)"""
