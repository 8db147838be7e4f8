"""Whole public licence texts and notices as they stand in files: hard-wrapped, under comment marks."""

import pytest

from siltstone.llm import licences

MIT = """MIT License

Copyright (c) 2024 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""
LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.
"""
AGPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Affero General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.
"""
GPL_TITLE = """                    GNU GENERAL PUBLIC LICENSE
                       Version 3, 29 June 2007

 Copyright (C) 2007 Free Software Foundation, Inc.
"""
UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any
means.
"""
CC0 = """To the extent possible under law, the author(s) have nothing to add.
CC0 1.0 Universal
"""
BOOST = """Boost Software License - Version 1.0 - August 17th, 2003

Permission is hereby granted, free of charge, to any person or organization
obtaining a copy of the software and accompanying documentation covered by
this license (the "Software") to use, reproduce, display, distribute,
execute, and transmit the Software, and to prepare derivative works of the
Software, and to permit third-parties to whom the Software is furnished to
do so, all subject to the following:
"""
COMMONS = """This work is licensed under a Creative Commons Attribution-NonCommercial
4.0 International License.
"""
TEXTS = {"MIT": MIT, "ISC": ISC, "MPL-2.0": MPL, "LGPL-2.1-or-later": LGPL, "AGPL-3.0-or-later": AGPL, "GPL-3.0-only": GPL_TITLE, "Unlicense": UNLICENSE, "CC0-1.0": CC0, "BSL-1.0": BOOST, "CC-BY-NC-4.0": COMMONS}


@pytest.mark.parametrize("mark,end", [("", "\n"), ("# ", "\n"), (" * ", "\r\n"), ("// ", "\n")])
def test_whole_texts(spark, mark, end):
    docs = spark.createDataFrame([(n, end.join(mark + line for line in t.splitlines()) + end + "code") for n, t in TEXTS.items()], "doc_id string, text string")
    assert {r["doc_id"]: r["licence"] for r in licences.scan(docs).collect()} == {n: n for n in TEXTS}


def test_lines_that_name_a_licence(spark):
    names = ["MIT", "Apache-2.0", "GPL-2.0-only", "BSD-3-Clause", "CC-BY-SA-4.0", "LGPL-3.0-or-later"]
    docs = spark.createDataFrame([(n, f"/* SPDX-License-Identifier: {n} */\nint main;\n") for n in names], "doc_id string, text string")
    assert {r["doc_id"]: r["licence"] for r in licences.scan(docs).collect()} == {n: n for n in names}


def test_what_is_no_licence(spark):
    texts = ["MIT licensed nothing here.", "The licence of this text is unknown; permission was asked.", "Universal rights and public domain art.", "He may redistribute the cards with a warranty.", "Permission to use is hereby granted to nobody."]
    assert all(r["licence"] is None for r in licences.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect())


BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice,
   this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""


def test_a_named_holder_is_no_other_licence(spark):
    """A third clause with a name in it: the name's slot, wrapped or not; without the clause it is the shorter licence."""
    clause = lambda name: f"3. Neither the name of {name} nor the names of its\n   contributors may be used to endorse or promote products derived from this\n   software without specific prior written permission.\n"
    rows = [("google", BSD + clause("Google Inc.")), ("long", BSD + clause("the Regents of the\n   University of California, Berkeley")), ("own", BSD + clause("the copyright holder")), ("two", BSD), ("open", BSD + clause(" ".join(["word"] * 40)))]
    got = {r["doc_id"]: r["licence"] for r in licences.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got == {"google": "BSD-3-Clause", "long": "BSD-3-Clause", "own": "BSD-3-Clause", "two": "BSD-2-Clause", "open": "BSD-2-Clause"}
