"""Licences recognised from sequences of known sentences."""

from __future__ import annotations

import re
from itertools import chain

from pyspark.sql import Column, DataFrame, functions as F

from .common import let, pinned, whole_text

# Known licence sentences, normalised (lower case, letters and digits, single blanks), by
# identifier. The wording is that of the public licences and of their usual notices.
_FREE = "free software you can redistribute it and or modify it under the terms of the"
_BY_FSF = "as published by the free software foundation"
_GNU = {
    "gpl": "gnu general public license", "lgpl": "gnu lesser general public license",
    "agpl": "gnu affero general public license",
}
_SUBJECTS = ["program", "library", "software", "file"]
_GNU_VERSIONS = [("gpl", "2", "2.0"), ("gpl", "3", "3.0"), ("lgpl", "2 1", "2.1"), ("lgpl", "3", "3.0"), ("agpl", "3", "3.0")]
_CREATIVE = {
    "by": "attribution", "by-sa": "attribution sharealike", "by-nd": "attribution noderivatives",
    "by-nc": "attribution noncommercial", "by-nc-sa": "attribution noncommercial sharealike",
    "by-nc-nd": "attribution noncommercial noderivatives",
}
SENTENCES: dict[str, list[str]] = {
    "gnu-hope": [
        f"this {subject} is distributed in the hope that it will be useful but without any warranty without "
        "even the implied warranty of merchantability or fitness for a particular purpose"
        for subject in _SUBJECTS
    ],
    "gnu-details": [f"see the {name} for more details" for name in _GNU.values()],
    "mit-notice": [
        "released under the mit license", "licensed under the mit license", "distributed under the mit license",
        "use of this source code is governed by an mit style license that can be found in the license file",
    ],
    "mit-grant": [
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction including "
        "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
        "copies of the software and to permit persons to whom the software is furnished to do so subject to "
        "the following conditions",
    ],
    "mit-condition": [
        "the above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the software",
    ],
    "as-is": [
        "the software is provided as is without warranty of any kind express or implied including but not "
        "limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    ],
    "apache-notice": [
        "licensed under the apache license version 2 0", "released under the apache license version 2 0",
        "licensed under the apache license version 2 0 the license", "licensed under the apache license 2 0",
    ],
    "apache-comply": [
        "you may not use this file except in compliance with the license",
        "you may not use this software except in compliance with the license",
    ],
    "apache-copy": [
        f"you may obtain a copy of the license at {scheme} www apache org licenses license 2 0"
        for scheme in ("http", "https")
    ],
    "bsd-grant": [
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met",
    ],
    "bsd-source": [
        "redistributions of source code must retain the above copyright notice this list of conditions and "
        "the following disclaimer",
    ],
    "bsd-binary": [
        "redistributions in binary form must reproduce the above copyright notice this list of conditions "
        "and the following disclaimer in the documentation and or other materials provided with the "
        "distribution",
    ],
    "bsd-names": [
        "may be used to endorse or promote products derived from this software without specific prior "
        "written permission",
    ],
    "bsd-notice": [
        "use of this source code is governed by a bsd style license that can be found in the license file",
    ],
    "isc-grant": [
        f"permission to use copy modify and{also} distribute this software for any purpose with or without fee "
        "is hereby granted provided that the above copyright notice and this permission notice appear in all "
        "copies"
        for also in ("", " or")
    ],
    "zlib-grant": [
        "permission is granted to anyone to use this software for any purpose including commercial "
        "applications and to alter it and redistribute it freely subject to the following restrictions",
    ],
    "boost-notice": [
        "distributed under the boost software license version 1 0",
        "use modification and distribution are subject to the boost software license version 1 0",
    ],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
    "mpl-notice": [
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        "licensed under the mozilla public license version 2 0",
    ],
    "cc0-notice": [
        "released under cc0 1 0",
        "dedicated all copyright and related and neighboring rights to this software to the public domain worldwide",
        "waived all copyright and related or neighboring rights to this work",
    ],
    "reserved": ["all rights reserved"],
}
for _family, _spoken, _version in _GNU_VERSIONS:
    _name = _GNU[_family]
    SENTENCES[f"{_family}{_version}-later"] = [
        f"this {subject} is {_FREE} {_name} {_BY_FSF} either version {_spoken} of the license or at your option "
        "any later version"
        for subject in _SUBJECTS
    ] + [f"licensed under the {_name} version {_spoken} or later"]
    SENTENCES[f"{_family}{_version}-notice"] = [
        f"licensed under the {_name} {short}"
        for short in sorted({f"version {_spoken}", f"v{_spoken}", f"v{_version.replace('.', ' ')}"})
    ] + [
        f"this {subject} is {_FREE} {_name} {version}" for subject in _SUBJECTS
        for version in (f"version {_spoken} {_BY_FSF}", f"{_BY_FSF} version {_spoken} of the license")
    ]
for _code, _words in _CREATIVE.items():
    SENTENCES[f"cc-{_code}-notice"] = [
        f"licensed under cc {_code.replace('-', ' ')} 4 0",
        f"licensed under a creative commons {_words} 4 0 international license",
        f"licensed under the creative commons {_words} 4 0 international license",
    ]

# Licence rules in order: the first that matches takes its sentences, so fuller texts come first.
RULES: list[tuple[str, list[str]]] = [
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("MIT", ["mit-notice", "mit-grant", "mit-condition", "as-is"]),
    ("MIT", ["mit-grant", "mit-condition", "as-is"]),
    ("MIT", ["mit-grant", "mit-condition"]),
    ("Apache-2.0", ["apache-notice", "apache-comply", "apache-copy"]),
    ("Apache-2.0", ["apache-notice"]),
    ("MIT", ["mit-notice"]),
    ("LicenseRef-BSD-style", ["bsd-notice"]),
    ("ISC", ["isc-grant"]),
    ("Zlib", ["zlib-grant"]),
    ("BSL-1.0", ["boost-notice"]),
    ("Unlicense", ["unlicense"]),
    ("CC0-1.0", ["cc0-notice"]),
    ("MPL-2.0", ["mpl-notice"]),
    ("LicenseRef-All-Rights-Reserved", ["reserved"]),
]
for _family, _, _version in _GNU_VERSIONS:
    for _kind, _suffix in (("later", "or-later"), ("notice", "only")):
        _licence, _head = f"{_family.upper()}-{_version}-{_suffix}", f"{_family}{_version}-{_kind}"
        RULES += [(_licence, [_head, "gnu-hope", "gnu-details"]), (_licence, [_head])]
RULES += [(f"CC-{_code.upper()}-4.0", [f"cc-{_code}-notice"]) for _code in _CREATIVE]
# Every licence that a rule knows has its tag, too; a GNU version without more means that one only.
for _licence in sorted({name for name, _ in RULES if not name.startswith("LicenseRef-")}):
    _tagged = "spdx license identifier " + re.sub("[^a-z0-9]+", " ", _licence.lower())
    SENTENCES[f"tag-{_licence}"] = [_tagged] + ([_tagged.removesuffix(" only")] if _tagged.endswith(" only") else [])
    RULES.append((_licence, [f"tag-{_licence}"]))

# A text without any of these words has no known sentence (every sentence above holds one).
TRIGGER = r"(?i)licen[sc]|permission|redistribut|warranty|rights|cc0|gnu|unencumbered"
# Shorter sentences count only where they stand by themselves, longer ones anywhere in the words.
_FEW_WORDS = 12
# Where a sentence or a part of it may end, beside line ends; words may run on over any of these.
_MARK = r"[.!?;:,](?=\s|$)|[()\[\]\"\u201c\u201d]|(?<=[\x20\t])-+(?=[\x20\t])"
_BEGIN, _END = r"(?<=\n ?|^ ?| is | are )", r"(?= ?(?:\n|$)| see | you may )"
# Words that some languages put before every line of a comment; other comment marks are no letters.
_COMMENT = r"(?m)^[\x20\t]*(?:dnl|rem)\b"
# The licences of a tag that names several each get a tag of their own.
_TAG_PLUS = r"(spdx-license-identifier:[\x20\t]*[a-z0-9.-]+)\+"
_TAG_MORE = r"(?<=spdx-license-identifier:[^\n]{0,200}) (?:or|and) (?=[(a-z])"


def word_stream(text: Column) -> Column:
    """Letters and digits in lower case, blanks between words, line feeds where a part may end."""
    plain = F.regexp_replace(F.lower(text), _COMMENT, " ")
    tagged = F.regexp_replace(F.regexp_replace(plain, _TAG_PLUS, "$1-or-later"), _TAG_MORE, "\nspdx-license-identifier: ")
    return F.regexp_replace(F.regexp_replace(tagged, _MARK, "\n"), "[^a-z0-9\n]+", " ")


def _alternatives(sentences: list[str]) -> str:
    """A pattern of all sentences, longest first below each first word, over any line feeds."""
    by_first: dict[str, list[str]] = {}
    for s in sorted(sentences, key=lambda s: (-len(s), s)):
        first, *rest = s.split()
        by_first.setdefault(first, []).append("".join(r"[ \n]+" + word for word in rest))
    return "|".join(f"{first}(?:{'|'.join(rests)})" for first, rests in by_first.items())


def _pattern() -> str:
    known = [s for wordings in SENTENCES.values() for s in wordings]
    long = [s for s in known if len(s.split()) >= _FEW_WORDS]
    short = [s for s in known if len(s.split()) < _FEW_WORDS]
    firsts = "|".join(sorted({s.split()[0] for s in short}))
    return (
        rf"(?<![a-z0-9])(?:(?:{_alternatives(long)})(?![a-z0-9])"
        rf"|(?=(?:{firsts})[ \n]){_BEGIN}(?:{_alternatives(short)}){_END})"
    )


def _identifier(sentence: Column) -> Column:
    known = F.create_map(*chain.from_iterable(
        (F.lit(sentence), F.lit(name)) for name, wordings in SENTENCES.items() for sentence in wordings
    ))
    return F.try_element_at(known, F.regexp_replace(sentence, r"[ \n]+", " "))


def _apply_rules(sequence: Column) -> Column:
    """Licences by rule, each with how often it matched, out of `` id id ... `` (a blank each side).

    A rule's matches leave a bar behind, so that no later rule matches across them.
    """
    state = F.struct(sequence.alias("left"), F.array().cast("array<string>").alias("found"))
    for name, ids in RULES:
        pattern = "".join(f" {i} " for i in ids)

        def step(s: Column, pattern: str = pattern, name: str = name) -> Column:
            hit = F.contains(s["left"], F.lit(pattern))
            return F.struct(
                F.when(hit, F.replace(s["left"], F.lit(pattern), F.lit(" | "))).otherwise(s["left"]).alias("left"),
                F.when(hit, F.concat(s["found"], F.array(F.lit(name)))).otherwise(s["found"]).alias("found"),
            )

        state = let(state, _one_argument(step))
    return F.array_sort(F.array_distinct(state["found"]))


def _one_argument(step):
    return lambda s: step(s)


def scan_licenses(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``sentence_ids`` (known sentences in order) and ``licenses`` (sorted names).

    A text becomes a stream of normalised words, from which comment marks, quotes and wraps are gone;
    known SENTENCES are found in it and become identifiers; RULES then match the sequence of these,
    in order. Sentences of fewer than twelve words must begin and end with a sentence, clause or
    line (or follow ``is``), longer ones may be wrapped and cut anywhere. Sentences that are not
    known do not interrupt a sequence. NULL and empty texts, and those that name no licence, get two
    empty arrays. Columns of ``docs`` with these names are replaced, all others stay. Only columns
    are computed: no row is shuffled, and whole texts are read. Repeated rows get equal results; an
    empty table gives no rows.
    """
    docs = docs.drop("sentence_ids", "licenses")
    whole = whole_text(text)
    none = F.array().cast("array<string>")
    sentences = F.regexp_extract_all(word_stream(whole), F.lit(_pattern()), F.lit(0))
    ids = F.when(whole.rlike(TRIGGER), F.transform(sentences, _identifier))
    sequence = F.array_join(F.transform("sentence_ids", lambda i: F.concat(F.lit(" "), i, F.lit(" "))), "")
    return (
        docs.withColumn("sentence_ids", pinned(F.coalesce(ids, none)))
        .withColumn(
            "licenses",
            pinned(F.when(F.size("sentence_ids") > 0, _apply_rules(sequence)).otherwise(none)),
        )
    )
