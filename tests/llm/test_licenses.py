import re

from starling.llm.licenses import RULES, SENTENCES, TRIGGER, scan_licenses

BSD2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
* Redistributions of source code must retain the above copyright notice, this
  list of conditions and the following disclaimer.
* Redistributions in binary form must reproduce the above copyright notice, this
  list of conditions and the following disclaimer in the documentation and/or
  other materials provided with the distribution.
"""
BSD3 = BSD2 + """* Neither the name of the copyright holder nor the names of its contributors may
  be used to endorse or promote products derived from this software without
  specific prior written permission.
"""
GNU = """This {subject} is free software{mark} you can redistribute it and/or modify
it under the terms of the {name} as published by
the Free Software Foundation{mark} either version {version} of the License, or
(at your option) any later version.

This {subject} is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
{name} for more details.

You should have received a copy of the {name}
along with this {subject}.  If not, see <https://www.gnu.org/licenses/>.
"""
MIT = """MIT License

Copyright (c) 2020 Some One

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
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM.
"""
# Headers as files carry them, with the licences and the sentences that they hold.
HEADERS = [
    (GNU.format(subject=subject, mark=mark, name=name, version=spoken), [f"{family}-{version}-or-later"],
     [f"{family.lower()}{version}-later", "gnu-hope", "gnu-details"])
    for subject, mark, name, spoken, family, version in [
        ("program", ";", "GNU General Public License", "2", "GPL", "2.0"),
        ("program", ":", "GNU General Public License", "3", "GPL", "3.0"),
        ("library", ";", "GNU Lesser General Public License", "2.1", "LGPL", "2.1"),
        ("software", ",", "GNU Lesser General Public License", "3", "LGPL", "3.0"),
        ("file", ":", "GNU Affero General Public License", "3", "AGPL", "3.0"),
    ]
] + [
    (MIT, ["MIT"], ["mit-grant", "mit-condition", "as-is"]),
    ("""Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS.
""", ["Apache-2.0"], ["apache-notice", "apache-comply", "apache-copy"]),
    ("""This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
""", ["MPL-2.0"], ["mpl-notice"]),
    ("""Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
""", ["ISC"], ["isc-grant"]),
    ("""This software is provided 'as-is', without any express or implied warranty.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:
""", ["Zlib"], ["zlib-grant"]),
    ("Copyright Some One 2004.\nDistributed under the Boost Software License,\nVersion 1.0. (See a file)\n",
     ["BSL-1.0"], ["boost-notice"]),
    ("This is free and unencumbered software released into the public domain.\n", ["Unlicense"], ["unlicense"]),
    ("To the extent possible under law, the author(s) have dedicated all copyright\nand related and neighboring "
     "rights to this software to the public domain\nworldwide.\n", ["CC0-1.0"], ["cc0-notice"]),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0\nInternational License.\n",
     ["CC-BY-SA-4.0"], ["cc-by-sa-notice"]),
    ("Use of this source code is governed by a BSD-style\nlicense that can be found in the LICENSE file.\n",
     ["LicenseRef-BSD-style"], ["bsd-notice"]),
    (BSD2, ["BSD-2-Clause"], ["bsd-grant", "bsd-source", "bsd-binary"]),
    (BSD3.replace("the copyright holder", "Some Company, Inc."), ["BSD-3-Clause"],
     ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
]
CASES = {
    "/* SPDX-License-Identifier: (MIT OR Apache-2.0) */": ["Apache-2.0", "MIT"],
    "// SPDX-License-Identifier: GPL-2.0+\nint x;": ["GPL-2.0-or-later"],
    "# SPDX-License-Identifier: GPL-2.0": ["GPL-2.0-only"],
    "This project is licensed under the MIT License - see the LICENSE file.": ["MIT"],
    "This is not licensed under the MIT License at all.": [],
    "Files are licensed under the GNU General Public License v3.0, others are not": ["GPL-3.0-only"],
    "Copyright 2020 Some One. All rights reserved.": ["LicenseRef-All-Rights-Reserved"],
    "for all rights reserved to the states": [],
    "redistribution\n" * 5000: [],
    "Some prose.\nReleased under the MIT License.\nMore prose.": ["MIT"],
    "Licensed under CC BY-NC 4.0. Licensed under the Apache License, Version 2.0.\nend": ["Apache-2.0", "CC-BY-NC-4.0"],
    "This work is licensed under the GNU General Public License, version 3.\n": ["GPL-3.0-only"],
    "# SPDX-License-Identifier: Apache-2.0\ncode": ["Apache-2.0"],
    BSD2: ["BSD-2-Clause"],
    BSD3: ["BSD-3-Clause"],
    BSD3 + BSD2: ["BSD-2-Clause", "BSD-3-Clause"],
    "the license to kill and the MIT license plate": [],
    "": [],
    None: [],
    "License. " * 20_000: [],
}


def test_sentences_are_normal_and_have_a_trigger():
    for wordings in SENTENCES.values():
        for s in wordings:
            assert s == re.sub("[^a-z0-9]+", " ", s.lower()).strip()
            assert re.search(TRIGGER, s)
    assert all(i in SENTENCES for _, ids in RULES for i in ids)


def test_cases(spark):
    df = spark.createDataFrame(list(enumerate(CASES)), "doc_id long, text string")
    got = {r.doc_id: r.licenses for r in scan_licenses(df).collect()}
    assert got == dict(enumerate(CASES.values()))


def test_headers_plain_commented_and_wrapped(spark):
    """Each header as it is, behind comment marks, in a box, wrapped anywhere, and on one line."""
    def shapes(text):
        lines, words = text.rstrip("\n").split("\n"), text.split()
        yield text
        for mark in ("# ", "// ", " * ", ";; ", "-- ", "dnl ", "REM ", "% "):
            yield "\r\n".join(mark + line for line in lines)
        yield "/*\n" + "\n".join(f" * {line:<80} *" for line in lines) + "\n */\nint main();"
        for width in (3, 7):
            yield "\n".join("  # " + " ".join(words[i:i + width]) for i in range(0, len(words), width))
        yield "Some File. " + " ".join(words) + "\nprose follows"

    wanted = [(text, licences, ids) for header, licences, ids in HEADERS for text in shapes(header)]
    df = spark.createDataFrame([(n, text) for n, (text, *_) in enumerate(wanted)], "doc_id long, text string")
    for row in scan_licenses(df).collect():
        assert (row.licenses, row.sentence_ids) == wanted[row.doc_id][1:], row.text


def test_each_sentence_is_found_as_itself_and_each_rule_is_reached(spark):
    """Every wording alone in a line gives its identifier, every rule's sequence its licence."""
    known = [(s, name) for name, wordings in SENTENCES.items() for s in wordings]
    assert len({s for s, _ in known}) == len(known)
    texts = [s for s, _ in known] + ["\n\n".join(SENTENCES[i][0].upper() for i in ids) for _, ids in RULES]
    got = sorted(scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect())
    assert [r.sentence_ids for r in got[:len(known)]] == [[name] for _, name in known]
    assert [r.licenses for r in got[len(known):]] == [[name] for name, _ in RULES]


def test_corpus_by_lines(spark, corpus):
    """The corpus holds licences as sentences of five wordings only."""
    lines = {
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Released under the MIT License.": "MIT",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "All rights reserved.": "LicenseRef-All-Rights-Reserved",
    }
    docs = spark.createDataFrame([r[:2] for r in corpus], "doc_id long, text string")
    want = {i: sorted({n for line, n in lines.items() if line in t}) for i, t, *_ in corpus}
    got = {r.doc_id: r.licenses for r in scan_licenses(docs).collect()}
    assert got == want and any(want.values())


def test_odd_rows(odd, empty, clashing):
    assert scan_licenses(odd).where("size(licenses) > 0").count() == 0
    assert scan_licenses(odd).count() == odd.count()
    assert scan_licenses(empty).count() == 0
    assert set(clashing.columns) <= set(scan_licenses(clashing).columns)
