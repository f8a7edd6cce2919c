"""Sentences with a name in them, further licences, and the SQL on wrapped texts."""

import duckdb
import pytest
from test_licences_wrapped import BSD, GPL, MIT, comment

from rillflow.llm import license_scan as ls
from rillflow.llm.queries import ORACLE_SQL

BSD3 = """Copyright (c) 2005, Acme Inc. All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice,
   this list of conditions and the following disclaimer.
3. Neither the name of Acme Inc. nor the names of its contributors may be
   used to endorse or promote products derived from this software without
   specific prior written permission.

THIS SOFTWARE IS PROVIDED BY ACME INC. AND OTHERS "AS IS" AND ANY EXPRESS OR
IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
"""
BSD2 = BSD3[: BSD3.index("3. N")] + BSD3[BSD3.index("THIS") :]
APACHE = """Copyright 2019 Someone

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0
"""
GPL2 = """This program is free software; you can redistribute it and/or
modify it under the terms of the GNU General Public License
as published by the Free Software Foundation; either version 2
of the License, or (at your option) any later version.
"""
GPL2 = GPL2.replace("software; you", "software you")
LGPL = """This library is free software you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
ZLIB = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:
"""
TITLES = {"                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n": "GPL-3.0", "   Apache License\n   Version 2.0, January 2004\n   http://www.apache.org/licenses/\n": "Apache-2.0", "GNU LESSER GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007": "LGPL-3.0", "Boost Software License - Version 1.0 - August 17th, 2003": "BSL-1.0", "Eclipse Public License - v 2.0": "EPL-2.0"}
WANT = {BSD3: "BSD-3-Clause", BSD2: "BSD-2-Clause", APACHE: "Apache-2.0", GPL2: "GPL-2.0", LGPL: "LGPL-2.1", ISC: "ISC", ZLIB: "Zlib"} | TITLES


@pytest.fixture(scope="module")
def scanned(spark, tmp_path_factory):
    """Licences by text, from the operator and from the SQL."""
    texts = [*WANT, MIT, GPL, BSD, *[comment(t, m) for t in (*WANT, MIT, GPL) for m in ("//", " *", "#")], "Copyright 2001 a b c d e f g h i j k All rights reserved", "Copyright 2001 Jo Doe All rights reserved", "neither the name of nor the names", None, "", "LS S. All rights reserved! L", "x. " * 30_000 + "\r\n\r\nISC License\r"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    folder = tmp_path_factory.mktemp("licences")
    df.coalesce(1).write.parquet(f"{folder}/documents")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents/*.parquet')")
    mine = {r.doc_id: (r.sentence_ids, r.n_sentences, r.licence) for r in ls.scan(df).collect()}
    return texts, mine, {r[0]: r[1:] for r in con.sql(ORACLE_SQL["op4_license_scan"]).fetchall()}


def test_licences(scanned):
    texts, mine, _ = scanned
    for t, want in WANT.items():
        assert mine[texts.index(t)][2] == want, t
        for m in ("//", " *", "#"):
            assert mine[texts.index(comment(t, m))][2] == want, (m, t)
    assert mine[texts.index(BSD3)][0] == "reserved bsd-redist bsd-endorse bsd-asis"
    assert mine[texts.index("Copyright 2001 Jo Doe All rights reserved")][2] == "proprietary"
    assert texts.index("Copyright 2001 a b c d e f g h i j k All rights reserved") not in mine  # a name has ten words at most
    assert mine[len(texts) - 1][2] == "ISC"


def test_sql_gives_the_same_rows(scanned):
    _, mine, sql = scanned
    assert mine == sql and len(sql) > 40


def test_named_sentences_can_be_found():
    for some in ls.NAMED.values():
        for a, b in some:
            assert any(h in f"{a} {b}" for h in ls.HINTS)
    assert set(ls.NAMED) <= set(ls.SENTENCES)
