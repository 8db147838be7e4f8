"""Known sentences in hard-wrapped licence texts."""

import os

import duckdb
import pytest

from siltstone.llm import licences

BSD2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = (
    BSD2
    + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
)
MIT = """The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
GPL3 = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.
"""
GPL2 = GPL3.replace("Foundation, either version 3", "Foundation; either version 2")
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
"""
TEXTS = {"BSD-2-Clause": BSD2, "BSD-3-Clause": BSD3, "MIT": MIT, "GPL-3.0-or-later": GPL3, "GPL-2.0-or-later": GPL2, "Apache-2.0": APACHE}
COUNTS = {"BSD-2-Clause": 3, "BSD-3-Clause": 4, "MIT": 1, "GPL-3.0-or-later": 1, "GPL-2.0-or-later": 1, "Apache-2.0": 4}


def scanned(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r for _, r in sorted((r["doc_id"], r) for r in licences.scan(rows).collect())]


@pytest.mark.parametrize("mark,end", [("", "\n"), ("# ", "\n"), (" * ", "\r\n"), ("-- ", "\n"), ("// ", "\n"), ("- ", "\r")])
def test_wrapped_texts(spark, mark, end):
    got = scanned(spark, [end.join(mark + line for line in t.splitlines()) + end + "code" for t in TEXTS.values()])
    assert [(r["licence"], r["n_sentences"]) for r in got] == [(name, COUNTS[name]) for name in TEXTS]


def test_what_parts_sentences(spark):
    got = scanned(spark, ["Released under the\n\nMIT License.", "Released under the. MIT License", "Not released under the\nMIT License", "Released under the MIT License\nand more", "more\nReleased under\nthe MIT License", "x released under the MIT License", "." * 20_000 + "\n- Licensed under\nCC BY 4.0", "Released under the MIT License\x01"])
    assert [r["licence"] for r in got] == [None, None, None, "MIT", "MIT", None, "CC-BY-4.0", "MIT"]


def test_equals_the_statement_where_nothing_is_wrapped(spark):
    for sf in ("sf0.001", "sf0.01", "sf0.1"):
        path = f"/root/testdata/{sf}/documents.parquet"
        if os.path.exists(path):
            with duckdb.connect() as c:
                c.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
                want = sorted(c.execute(licences.oracle_sql()).fetchall(), key=repr)
            assert sorted((tuple(r) for r in licences.scan(spark.read.parquet(path)).collect()), key=repr) == want
