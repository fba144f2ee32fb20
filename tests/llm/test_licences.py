"""Licence texts as they stand in files: wrapped, commented, numbered."""

import os
import sys
import textwrap

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from oracle import connect, differences  # noqa: E402
from placewell.llm import licenses  # noqa: E402
from placewell.llm.queries import ORACLE, QUERIES  # noqa: E402

MIT = """MIT License

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation \
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, \
modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the \
Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE \
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the \
following conditions are met:

{0}Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

{1}Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following \
disclaimer in the documentation and/or other materials provided with the distribution."""
NAMES = """

{2}Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products \
derived from this software without specific prior written permission."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance \
with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" \
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language \
governing permissions and limitations under the License."""
GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public \
License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of \
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."""
TEXTS = {
    "MIT": MIT, "Apache-2.0": APACHE, "GPL-3.0-or-later": GPL, "BSD-2-Clause": BSD.format("1. ", "2. "),
    "BSD-3-Clause": (BSD + NAMES).format("(a) ", "(b) ", "(c) "),
}


def wrapped(text, width, mark=""):
    parts = [textwrap.fill(p, width) for p in text.split("\n\n")]
    return "\n".join((mark + line).rstrip() for line in "\n\n".join(parts).split("\n"))


def forms(text):
    yield text
    yield wrapped(text, 72)
    yield wrapped(text, 79).replace("\n", "\r\n")
    yield "/*\n" + wrapped(text, 70, " * ") + "\n */"
    yield wrapped(text, 60, "# ")
    yield "Some prose first\n\n" + wrapped(text, 72, "// ") + "\n\nand prose behind it."


@pytest.mark.parametrize("name", TEXTS)
def test_usual_forms_are_found(spark, name):
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(forms(TEXTS[name]))], "doc_id int, text string")
    assert [r.licence.names for r in licenses.scan(rows).orderBy("doc_id").collect()] == [[name]] * rows.count()


def test_a_line_of_its_own_is_still_a_sentence(spark):
    texts = ["Released under the MIT License\nand other words go on", "Words here\nAll rights reserved\nmore words",
             "See it. Licensed under CC-BY 4.0\nNext", "Numbers: 1. Redistributions", None, "", "software", "1.\n2.\nsoftware"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = [r.licence.names for r in licenses.scan(rows).orderBy("doc_id").collect()]
    assert found == [["MIT"], ["all-rights-reserved"], ["CC-BY-4.0"], [], [], [], [], []]
    assert licenses.scan(rows.limit(0)).count() == 0


def test_every_sentence_has_a_word_that_admits_it():
    for found in licenses.SENTENCES.values():
        assert all(any(w in s for w in licenses.WORDS) for s in found)


def test_sql_finds_the_same_in_all_forms(spark):
    rows = [(k, t) for k, t in enumerate(t for text in TEXTS.values() for t in forms(text))]
    rows += [(900 + k, t) for k, t in enumerate([None, "", " * ", "a) b", "MIT License.  x\ty\n\n\nsoftware; 2) z"])]
    con = connect("/root/testdata/sf0.001")
    con.execute("DROP VIEW documents")
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = licenses.scan(docs).selectExpr(
        "doc_id", "licence.sentence_ids", "licence.n_sentences", "array_join(licence.names, ',') AS licences")
    assert differences(found, con, ORACLE["op2_license_scan"]) == []


def test_query_agrees_with_sql(spark):
    con = connect("/root/testdata/sf0.001")
    assert differences(QUERIES["op2_license_scan"](spark, "/root/testdata/sf0.001"), con, ORACLE["op2_license_scan"]) == []
