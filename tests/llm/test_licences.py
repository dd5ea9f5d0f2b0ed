import re

import pytest

from skyfold.llm import licences

MIT = """MIT License

Copyright (c) 2021 Some One, Inc.

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
BSD2 = """Copyright 2019 The Authors. All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = BSD2 + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
"""
APACHE = """   Licensed under the Apache License, Version 2.0 (the "License");
   you may not use this file except in compliance with the License.
   You may obtain a copy of the License at

       http://www.apache.org/licenses/LICENSE-2.0

   Unless required by applicable law or agreed to in writing, software
   distributed under the License is distributed on an "AS IS" BASIS,
"""
APACHE_WHOLE = """                                 Apache License
                           Version 2.0, January 2004
                        http://www.apache.org/licenses/

   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION
"""
GPL2_LATER = """    This program is free software; you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation; either version 2 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
"""
GPL2_ONLY = """ * This program is free software; you can redistribute it and/or modify it
 * under the terms of the GNU General Public License version 2 as
 * published by the Free Software Foundation.
"""
GPL2_ONLY_AFTER = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; version 2 of the License.\n"
GPL3 = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.
"""
GPL3_WHOLE = """                    GNU GENERAL PUBLIC LICENSE
                       Version 3, 29 June 2007

 Everyone is permitted to copy and distribute verbatim copies
 of this license document, but changing it is not allowed.
"""
LGPL21 = """   This library is free software; you can redistribute it and/or
   modify it under the terms of the GNU Lesser General Public
   License as published by the Free Software Foundation; either
   version 2.1 of the License, or (at your option) any later version.
"""
AGPL = GPL3.replace("GNU General", "GNU Affero General")
MPL = """   This Source Code Form is subject to the terms of the Mozilla Public
   License, v. 2.0. If a copy of the MPL was not distributed with this
   file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE
"""
UNLICENSE = "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify\n"
CC0 = "To the extent possible under law, Jane Q. Public has waived all copyright and related or neighboring rights to this work.\n"
TEXTS = {
    "MIT": MIT, "BSD-2-Clause": BSD2, "BSD-3-Clause": BSD3, "Apache-2.0": APACHE, "GPL-2.0-or-later": GPL2_LATER, "GPL-2.0-only": GPL2_ONLY, "GPL-3.0-or-later": GPL3,
    "LGPL-2.1-or-later": LGPL21, "AGPL-3.0-or-later": AGPL, "MPL-2.0": MPL, "ISC": ISC, "Unlicense": UNLICENSE, "GPL-3.0": GPL3_WHOLE, "CC0-1.0": CC0,
}


def dressed(text):
    """The same text as it is, in comments, in capitals, on one line for each paragraph, in narrow lines and inside a file."""
    lines = text.split("\n")
    paragraphs = [" ".join(p.split()) for p in re.split(r"\n\s*\n", text)]
    narrow = "\n\n".join("\n".join(re.findall(r".{1,24}(?:\s|$)|\S+", p)) for p in paragraphs)
    return [
        text, "\n".join("# " + x for x in lines), "/*\n" + "\n".join(" * " + x for x in lines) + "\n */\nint main;", "\n".join("// " + x for x in lines), text.upper(),
        "\n\n".join(paragraphs), narrow, text.replace("\n", "\r\n"), "int x = 1;\nFoo bar baz\n\n" + text + "\n\nMore text. And more",
    ]


def scanned(spark, texts):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_sentences int, licences string")
    return {r.doc_id: (list(r.sentence_ids), list(r.licences)) for r in licences.scan(docs).collect()}


def test_verbatim_texts_in_all_dresses(spark):
    cases = [(name, text) for name, whole in TEXTS.items() for text in dressed(whole)]
    got = scanned(spark, [t for _, t in cases])
    wrong = [(cases[i][0], cases[i][1][:200], ids, found) for i, (ids, found) in got.items() if found != [cases[i][0]]]
    assert not wrong


def test_versions_and_near_misses(spark):
    texts = {
        GPL2_ONLY_AFTER: ["GPL-2.0-only"], APACHE_WHOLE: ["Apache-2.0"], MIT + "\n" + GPL3: ["MIT", "GPL-3.0-or-later"],
        "SPDX-License-Identifier: GPL-2.0-only\n": ["GPL-2.0-only"], "// SPDX-License-Identifier: MIT": ["MIT"],
        "MIT License is mentioned": [], "not Released under the MIT License": [], "Released under the MIT License or not": [],
        GPL3.replace("either version 3", "either version 4"): [], BSD2.replace("binary form must", "binary form may"): [],
        BSD3.replace("the copyright holder", "Foo, Inc. of Bar"): ["BSD-3-Clause"], BSD3.replace("the copyright holder", "x " * 40): ["BSD-2-Clause"],
        "\n\n".join(reversed(MIT.split("\n\n"))): [], "Copyright (c) 2020 A\n" + MIT.split("\n\n", 2)[2]: ["MIT"],
    }
    got = scanned(spark, list(texts))
    assert {t: got[i][1] for i, t in enumerate(texts)} == texts


def test_lines_and_odd_rows(spark):
    got = scanned(spark, [
        "Prose first. Released under the MIT License. More prose", None, "", "Released under the MIT License.\n" * 3, "x " * 100_000 + ". Licensed under CC BY-NC 4.0",
        "junk\nlicensed  under the apache license, VERSION 2.0\nThis work is licensed under the GNU General Public License, version 3.", "licence\x01warranty\x02",
    ])
    assert got[0] == (["mit-name"], ["MIT"]) and got[1] == got[2] == got[6] == ([], [])
    assert got[3] == (["mit-name"] * 3, ["MIT"]) and got[4][1] == ["CC-BY-NC-4.0"]
    assert got[5] == (["apache-name", "gpl3-name"], ["Apache-2.0", "GPL-3.0"])
    assert scanned(spark, []) == {}


def test_tables():
    assert all(re.search(licences.TELLING, wording) for wording in licences.SENTENCES.values())
    assert {i for _, ids in licences.RULES for i in ids} <= licences.SENTENCES.keys()


@pytest.mark.parametrize("name", sorted(licences.SENTENCES))
def test_wordings_are_told_apart(name):
    same = [n for n, w in licences.SENTENCES.items() if licences.words_of(w) == licences.words_of(licences.SENTENCES[name])]
    assert same == [name]
