"""Licence scan by sentence rules, in DataFrame operations only.

A text is cut into sentences (at blank lines, and after ``.``, ``!``, ``?`` or ``;`` before white space), each is normalised (A-Z
lower-cased, anything but a-z and 0-9 one space), and known licence sentences become identifiers. A known sentence may take one line
of a sentence, some lines that follow each other, or all, so notices of one line and wrapped texts are both found, with marks of
comments before the lines. Some known sentences have a slot for a name of 1 to 10 words, abbreviations with full stops included. The
sequence of a document's identifiers, other sentences left out, is matched against ordered rules: a rule fits where its identifiers
follow each other in that sequence, and the first rule that fits names the licence. Everything is per row: no shuffle, no join,
no skew.

Every known sentence holds one of a few words, so texts with none of them are passed over unsplit.

Defined cases: a null or empty text has no sentences; documents without a known sentence give no row; those whose identifiers fit
no rule give the licence ``unknown``; repeated sentences repeat in the sequence; very long texts are read whole; repeated rows come
out repeated; a null doc_id is kept; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Known sentences by identifier, normalised; fixed values.
SENTENCES = {
    "mit-name": ["the mit license", "mit license", "the mit license mit"],
    "mit-ref": ["released under the mit license", "licensed under the mit license", "this project is licensed under the mit license", "distributed under the mit license"],
    "mit-grant": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"],
    "mit-notice": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"],
    "apache2-ref": ["licensed under the apache license version 2 0", "licensed under the apache license version 2 0 the license", "released under the apache license version 2 0", "this project is licensed under the apache license 2 0"],
    "apache2-use": ["you may not use this file except in compliance with the license"],
    "apache2-copy": ["you may obtain a copy of the license at"],
    "gpl3-ref": ["this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3", "released under the gnu general public license version 3"],
    "gpl2-ref": ["this work is licensed under the gnu general public license version 2", "licensed under the gnu general public license version 2", "released under the gnu general public license version 2"],
    "gpl-free": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "gpl-title": ["gnu general public license version 3 29 june 2007"],
    "gpl2-title": ["gnu general public license version 2 june 1991"],
    "lgpl-title": ["gnu lesser general public license version 3 29 june 2007"],
    "lgpl21-title": ["gnu lesser general public license version 2 1 february 1999"],
    "agpl-title": ["gnu affero general public license version 3 19 november 2007"],
    "gpl-terms": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"],
    "lgpl-terms": ["this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"],
    "v2-later": ["either version 2 of the license or at your option any later version"],
    "v21-later": ["either version 2 1 of the license or at your option any later version"],
    "v3-later": ["either version 3 of the license or at your option any later version"],
    "apache2-title": ["apache license version 2 0 january 2004"],
    "mpl2-title": ["mozilla public license version 2 0"],
    "epl2-title": ["eclipse public license v 2 0"],
    "epl2-ref": ["this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at", "this program and the accompanying materials are made available under the terms of the eclipse public license v2 0 which accompanies this distribution", "licensed under the eclipse public license 2 0"],
    "boost-title": ["boost software license version 1 0 august 17th 2003"],
    "boost-ref": ["distributed under the boost software license version 1 0"],
    "boost-grant": ["permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following"],
    "isc-name": ["isc license", "the isc license"],
    "isc-grant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"],
    "zlib-asis": ["this software is provided as is without any express or implied warranty"],
    "zlib-grant": ["permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions"],
    "gpl-warranty": ["see the gnu general public license for more details"],
    "lgpl3-ref": ["licensed under the gnu lesser general public license version 3"],
    "agpl3-ref": ["licensed under the gnu affero general public license version 3"],
    "mpl2-ref": ["this source code form is subject to the terms of the mozilla public license v 2 0", "licensed under the mozilla public license version 2 0"],
    "bsd-redist": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "bsd-endorse": ["neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"],
    "bsd-asis": ["this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"],
    "bsd-ref": ["licensed under the bsd license", "released under the bsd 3 clause license", "licensed under the bsd 3 clause license"],
    "as-is": ["the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"],
    "ccbync4-ref": ["licensed under cc by nc 4 0", "this work is licensed under cc by nc 4 0", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"],
    "ccbysa4-ref": ["licensed under cc by sa 4 0", "this work is licensed under cc by sa 4 0", "this work is licensed under a creative commons attribution sharealike 4 0 international license"],
    "ccby4-ref": ["licensed under cc by 4 0", "this work is licensed under cc by 4 0", "this work is licensed under a creative commons attribution 4 0 international license"],
    "cc0-ref": ["released under cc0 1 0", "this work is released into the public domain under a cc0 1 0 license"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
    "reserved": ["all rights reserved"],
}

#: Known sentences with a name between two parts, by identifier, normalised; fixed values.
NAMED = {
    "bsd-endorse": [("neither the name of", "nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission")],
    "bsd-asis": [("this software is provided by", "as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed")],
    "reserved": [("copyright", "all rights reserved")],
}

#: Rules in order; fixed values.
RULES = [
    ("MIT", ["mit-grant", "mit-notice"]),
    ("Apache-2.0", ["apache2-ref", "apache2-use"]),
    ("GPL-3.0", ["gpl-free", "gpl-warranty"]),
    ("GPL-2.0", ["gpl-terms", "v2-later"]),
    ("GPL-3.0", ["gpl-terms", "v3-later"]),
    ("LGPL-2.1", ["lgpl-terms", "v21-later"]),
    ("LGPL-3.0", ["lgpl-terms", "v3-later"]),
    ("BSD-3-Clause", ["bsd-redist", "bsd-endorse"]),
    ("BSD-2-Clause", ["bsd-redist", "as-is"]),
    ("BSD-2-Clause", ["bsd-redist", "bsd-asis"]),
    ("Zlib", ["zlib-asis", "zlib-grant"]),
    ("ISC", ["isc-grant"]),
    ("BSL-1.0", ["boost-grant"]),
    ("AGPL-3.0", ["agpl-title"]),
    ("LGPL-3.0", ["lgpl-title"]),
    ("LGPL-2.1", ["lgpl21-title"]),
    ("GPL-3.0", ["gpl-title"]),
    ("GPL-2.0", ["gpl2-title"]),
    ("Apache-2.0", ["apache2-title"]),
    ("MPL-2.0", ["mpl2-title"]),
    ("EPL-2.0", ["epl2-title"]),
    ("BSL-1.0", ["boost-title"]),
    ("EPL-2.0", ["epl2-ref"]),
    ("BSL-1.0", ["boost-ref"]),
    ("AGPL-3.0", ["agpl3-ref"]),
    ("LGPL-3.0", ["lgpl3-ref"]),
    ("GPL-3.0", ["gpl3-ref"]),
    ("GPL-3.0", ["gpl-free"]),
    ("GPL-2.0", ["gpl2-ref"]),
    ("MPL-2.0", ["mpl2-ref"]),
    ("Apache-2.0", ["apache2-ref"]),
    ("MIT", ["mit-ref"]),
    ("MIT", ["mit-grant"]),
    ("MIT", ["mit-name"]),
    ("ISC", ["isc-name"]),
    ("Zlib", ["zlib-grant"]),
    ("BSD-3-Clause", ["bsd-ref"]),
    ("CC-BY-NC-4.0", ["ccbync4-ref"]),
    ("CC-BY-SA-4.0", ["ccbysa4-ref"]),
    ("CC-BY-4.0", ["ccby4-ref"]),
    ("CC0-1.0", ["cc0-ref"]),
    ("Unlicense", ["unlicense"]),
    ("proprietary", ["reserved"]),
]

#: Each known sentence holds one of these; fixed values.
HINTS = ["licen", "permission", "copyright", "redistribut", "warrant", "cc0"]
SPACED_HINTS = "cc[^a-z0-9]+by|public[^a-z0-9]+domain|rights[^a-z0-9]+reserved"

#: Ends of sentences, in lower-cased text with \n as the only line end; lines without letters and digits count as blank.
SENTENCE_END = r"[.!?;]+(?:[ \t\n\x0B\f]|\z)|\n[^a-z0-9]*\n"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What turns a text into words with SS at ends of sentences and LL at other line ends; no capitals are left besides.
STEPS = [(r"\r\n?", r"\n"), (SENTENCE_END, "S"), (r"\n+", "L"), ("[^a-z0-9SL]+", " "), ("[ L]*S[ SL]*", "SS"), (" *L[ L]*", "LL")]


def known_sentences() -> dict[str, str]:
    return {s: i for i, some in SENTENCES.items() for s in some}


def sentence_pattern() -> str:
    """A known sentence with one mark before it and one after; of sentences that start alike the longer is tried first."""
    spaced = lambda s: s.replace(" ", "(?: |LL)")
    plain = [spaced(s) for s in sorted(known_sentences(), key=len, reverse=True)]
    name = "(?: |LL)[a-z0-9]+(?:(?: |LL|SS)[a-z0-9]+){0,9}?(?: |LL|SS)"
    named = [spaced(a) + name + spaced(b) for some in NAMED.values() for a, b in some]
    return f"[SL](?:{'|'.join(plain + named)})[SL]"


def marked(text: Column) -> Column:
    out = F.translate(text, UPPER, LOWER)
    for find, put in STEPS:
        out = F.regexp_replace(out, find, put.replace(r"\n", "\n"))
    return F.concat(F.lit("S"), F.trim(out), F.lit("S"))


def identifiers(text: Column) -> Column:
    """The identifiers of a text's known sentences, in order."""
    names = F.create_map(*[F.lit(x) for pair in known_sentences().items() for x in pair])
    found = F.regexp_extract_all(marked(text), F.lit(sentence_pattern()), F.lit(0))

    def identifier(sentence: Column) -> Column:
        s = F.trim(F.regexp_replace(sentence, "[SL]+", " "))
        named = [F.when(s.startswith(a + " ") & s.endswith(" " + b), i) for i, some in NAMED.items() for a, b in some]
        return F.coalesce(names[s], *named)

    return F.transform(found, identifier)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, sentence_ids (joined by spaces), n_sentences and licence."""
    text = F.col("text").cast("string")
    hint = F.lit(False)
    for h in HINTS:
        hint = hint | F.col("low").contains(h)
    # between the words of a sentence there may be any punctuation
    rows = docs.select("doc_id", text.alias("text"), F.lower(text).alias("low")).where(hint | F.col("low").rlike(SPACED_HINTS))
    ids = rows.select("doc_id", identifiers(F.col("text")).alias("ids")).where(F.size("ids") > 0)
    sequence = F.concat(F.lit(" "), F.array_join("ids", " "), F.lit(" "))
    licence = F.coalesce(*[F.when(F.col("sequence").contains(f" {' '.join(want)} "), name) for name, want in RULES], F.lit("unknown"))
    return ids.withColumn("sequence", sequence).select("doc_id", F.trim("sequence").alias("sentence_ids"), F.size("ids").cast("long").alias("n_sentences"), licence.alias("licence"))


def oracle_sql() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    pairs = ", ".join(f"({quote(s)}, {quote(i)})" for s, i in known_sentences().items())
    rules = " ".join(f"WHEN contains(seq, {quote(f' {" ".join(want)} ')}) THEN {quote(name)}" for name, want in RULES)
    named = " ".join(f"WHEN starts_with(s, {quote(a + ' ')}) AND ends_with(s, {quote(' ' + b)}) THEN {quote(i)}" for i, some in NAMED.items() for a, b in some)
    steps = f"translate(text, '{UPPER}', '{LOWER}')"
    for find, put in STEPS:
        steps = f"regexp_replace({steps}, {quote(find)}, {'chr(10)' if put == r'\n' else quote(put)}, 'g')"
    return f"""
    WITH known(sentence, id) AS (VALUES {pairs}),
    texts AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all('S' || trim({steps}) || 'S', {quote(sentence_pattern())}) AS parts
      FROM documents WHERE regexp_matches(text, '(?i)licen|permission|copyright|redistribut|warrant|cc[^a-z0-9]+by|cc0|public[^a-z0-9]+domain|rights[^a-z0-9]+reserved')),
    cut AS (SELECT r, doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS k FROM texts),
    named AS (SELECT r, doc_id, k, trim(regexp_replace(part, '[SL]+', ' ', 'g')) AS s FROM cut),
    ids AS (SELECT r, doc_id, k, coalesce(id, CASE {named} END) AS id FROM named LEFT JOIN known ON sentence = s),
    seqs AS (SELECT r, any_value(doc_id) AS doc_id, ' ' || string_agg(id, ' ' ORDER BY k) || ' ' AS seq, count(*) AS n FROM ids GROUP BY r)
    SELECT doc_id, trim(seq) AS sentence_ids, n AS n_sentences, CASE {rules} ELSE 'unknown' END AS licence FROM seqs"""
