"""Licence texts as published: wrapped over lines, in comments, with either line end."""

from rillflow.llm import license_scan as ls

MIT = """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
GPL = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
    * Redistributions of source code must retain the above notice.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""


def comment(text, mark):
    return "".join(f"{mark} {x}\n" for x in text.splitlines())


def test_wrapped_texts(spark):
    texts = [MIT, GPL, BSD, comment(MIT, " *"), comment(GPL, "//"), comment(BSD, "#"), MIT.replace("\n", "\r\n"), GPL.replace("\n", "\r"), "L S Released under\nCC BY 4.0", "Licensed under\n\nCC BY 4.0.", "Released under\r\nthe MIT License."]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.licence, r.sentence_ids) for r in ls.scan(df).collect()}
    mit, gpl, bsd = ("MIT", "mit-name mit-grant mit-notice"), ("GPL-3.0", "gpl-free gpl-warranty"), ("BSD-3-Clause", "bsd-redist bsd-endorse")
    assert got == dict(enumerate([mit, gpl, bsd, mit, gpl, bsd, mit, gpl])) | {10: ("MIT", "mit-ref")}
