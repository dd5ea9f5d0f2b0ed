"""Licence scan by sentence rules.

A text is cut at sentence ends and blank lines; lines that wrap, colons, semicolons, list marks and comment prefixes only
mark places where a sentence may begin or end. Known licence sentences are looked up by their first word at each such
place and compared word by word, so wrapping, comments, case and punctuation change nothing. What is found, in order,
is a sequence of identifiers, which is matched against ordered licence rules. Everything happens within a row, in
DataFrame expressions: no text is shuffled, and a text of any length is read whole.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from skyfold.functions.staging import fixed

_GPL = "you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License as published by the Free Software Foundation"
_GPL_NAMES = {"gpl": "", "lgpl": "Lesser ", "lgpl-library": "Library ", "agpl": "Affero "}

#: Identifier and wording of known licence sentences; ``<>`` stands for one to twelve words.
SENTENCES = {
    "mit-name": "Released under the MIT License",
    "mit-licensed": "Licensed under the MIT License",
    "mit-title": "MIT License",
    "mit-title-the": "The MIT License",
    "mit-title-both": "The MIT License (MIT)",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit0-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so",
    "as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "isc-grant-and": "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "0bsd-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "isc-warranty": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS",
    "apache-name": "Licensed under the Apache License, Version 2.0",
    "apache-notice": "Licensed under the Apache License, Version 2.0 (the \"License\")",
    "apache-comply": "you may not use this file except in compliance with the License",
    "apache-obtain": "You may obtain a copy of the License at",
    "apache-title": "Apache License Version 2.0, January 2004",
    "apache-terms": "TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    "gpl3-name": "This work is licensed under the GNU General Public License, version 3",
    "gpl2-title": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "gpl3-title": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "lgpl21-title": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    "lgpl3-title": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "agpl3-title": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    "gpl-copies": "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-advertise": "All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by <>",
    "bsd-endorse": "Neither the name of <> nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-endorse-may": "Neither the name of <> may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-endorse-name": "The name of <> may not be used to endorse or promote products derived from this software without specific prior written permission",
    "zlib-as-is": "This software is provided 'as-is', without any express or implied warranty",
    "zlib-origin": "The origin of this software must not be misrepresented; you must not claim that you wrote the original software",
    "boost-name": "Distributed under the Boost Software License, Version 1.0",
    "boost-title": "Boost Software License - Version 1.0 - August 17th, 2003",
    "unlicense": "This is free and unencumbered software released into the public domain",
    "cc0-dedicate": "To the extent possible under law, <> has waived all copyright and related or neighboring rights to <>",
    "cc0-title": "CC0 1.0 Universal",
    "cc0-name": "This work is licensed under CC0 1.0 Universal",
    "ccbync-name": "Licensed under CC BY-NC 4.0",
    "ccby-name": "Licensed under CC BY 4.0",
    "ccbysa-name": "Licensed under CC BY-SA 4.0",
    "cc-work": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "ccsa-work": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "ccnc-work": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "mpl-subject": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "mpl-obtain": "If a copy of the MPL was not distributed with this file, You can obtain one at <>",
    "mpl-title": "Mozilla Public License Version 2.0",
    "epl-terms": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at <>",
}
for _name, _kind in _GPL_NAMES.items():
    for _version in ("2", "2.1", "3"):
        _number = _version.replace(".", "")
        SENTENCES[f"{_name}{_number}-later"] = f"{_GPL.format(kind=_kind)}, either version {_version} of the License, or (at your option) any later version"
        SENTENCES[f"{_name}{_number}-only"] = f"{_GPL.format(kind=_kind)}, version {_version} of the License"
        SENTENCES[f"{_name}{_number}-only-word"] = f"{_GPL.format(kind=_kind)}, version {_version} only"
        SENTENCES[f"{_name}{_number}-only-before"] = _GPL.format(kind=_kind).replace("License as", f"License version {_version} as")

#: Licence and the identifiers that follow each other in it.
RULES = [
    ("MIT", ("mit-grant", "mit-notice", "as-is")),
    ("MIT", ("mit-title", "mit-grant")),
    ("MIT", ("mit-title-the", "mit-grant")),
    ("MIT", ("mit-title-both", "mit-grant")),
    ("MIT", ("mit-name",)),
    ("MIT", ("mit-licensed",)),
    ("MIT-0", ("mit0-grant", "as-is")),
    ("ISC", ("isc-grant", "isc-warranty")),
    ("ISC", ("isc-grant-and", "isc-warranty")),
    ("0BSD", ("0bsd-grant", "isc-warranty")),
    ("Apache-2.0", ("apache-notice", "apache-comply", "apache-obtain")),
    ("Apache-2.0", ("apache-name",)),
    ("Apache-2.0", ("apache-title",)),
    ("GPL-3.0", ("gpl3-name",)),
    ("GPL-2.0", ("gpl2-title",)),
    ("GPL-3.0", ("gpl3-title",)),
    ("LGPL-2.1", ("lgpl21-title",)),
    ("LGPL-3.0", ("lgpl3-title",)),
    ("AGPL-3.0", ("agpl3-title",)),
    ("BSD-4-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-advertise")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse-may")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse-name")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("Zlib", ("zlib-as-is", "zlib-origin")),
    ("BSL-1.0", ("boost-name",)),
    ("BSL-1.0", ("boost-title",)),
    ("Unlicense", ("unlicense",)),
    ("CC0-1.0", ("cc0-dedicate",)),
    ("CC0-1.0", ("cc0-title",)),
    ("CC0-1.0", ("cc0-name",)),
    ("CC-BY-NC-4.0", ("ccbync-name",)),
    ("CC-BY-NC-4.0", ("ccnc-work",)),
    ("CC-BY-4.0", ("ccby-name",)),
    ("CC-BY-4.0", ("cc-work",)),
    ("CC-BY-SA-4.0", ("ccbysa-name",)),
    ("CC-BY-SA-4.0", ("ccsa-work",)),
    ("MPL-2.0", ("mpl-subject",)),
    ("MPL-2.0", ("mpl-title",)),
    ("EPL-2.0", ("epl-terms",)),
]
for _name in SENTENCES:
    if _found := re.fullmatch(r"(l?gpl|agpl)(-library)?(2|21|3)-(later|only).*", _name):
        _number = {"2": "2.0", "21": "2.1", "3": "3.0"}[_found[3]]
        RULES.append((f"{_found[1].upper()}-{_number}-{'or-later' if _found[4] == 'later' else 'only'}", (_name,)))
#: Licences that the tag of a source file names.
for _name in sorted({licence for licence, _ in RULES}):
    SENTENCES[f"spdx-{_name}"] = f"SPDX-License-Identifier: {_name}"
    RULES.append((_name, (f"spdx-{_name}",)))
#: A rule that contains another one whole, by licence: where the longer matches, the shorter does not count.
WITHIN = [("BSD-2-Clause", "BSD-3-Clause"), ("BSD-2-Clause", "BSD-4-Clause")]

#: Each known sentence has one of these, never broken over lines; a text without them is not cut up.
TELLING = "(?i)licen[sc]e|permission|permitted|distribut|warrant|unencumbered|cc0|neighboring|advertising|misrepresented"
HARD, SOFT = "\x01", "\x02"
#: Numbers and letters of lists, and comment prefixes that are words, at the beginning of a line of a lower-case text.
LIST_MARK = r"(?m)^[^a-z0-9\n]*(?:\(?[0-9]{1,2}[.)]|\(?[a-z]\)|dnl|rem)[ \t]+"
SENTENCE_END = r"[.!?]+[\"')\]]*(?:\s|$)|\n[^a-z0-9\n]*\n"
MAY_END = "[;:\n]+"
OUTSIDE = f"[^a-z0-9{HARD}{SOFT}]+"
HARD_RUN = f"(?:[{HARD}{SOFT}] )*{HARD}(?: [{HARD}{SOFT}])*"
SOFT_RUN = f" {SOFT}(?: {SOFT})*"
STEPS = [(LIST_MARK, f" {SOFT} "), (SENTENCE_END, f" {HARD} "), (MAY_END, f" {SOFT} "), (OUTSIDE, " "), (HARD_RUN, HARD), (SOFT_RUN, SOFT)]
GAP = 12


def tokens_of(text: Column) -> Column:
    """Words and sentence ends of a text; a word behind which a sentence may end carries a mark."""
    whole = F.concat(F.lit(f"{HARD} "), F.lower(text))
    for pattern, put in STEPS:
        whole = F.regexp_replace(whole, pattern, put)
    return F.split(F.trim(whole), " ")


def words_of(wording: str) -> list[str]:
    """The same for one known wording, without the marks that do not end it."""
    whole = wording.lower()
    for pattern, put in STEPS:
        whole = re.sub(pattern, put, whole)
    return whole.replace(SOFT, "").strip(f" {HARD}").split(" ")


def _known() -> Column:
    """Map from a first word to the sentences that begin with it: ``no, id, n, head, gap, m, tail``."""
    by_word: dict[str, list[Column]] = {}
    for no, (name, wording) in enumerate(SENTENCES.items()):
        head, *rest = (words_of(part) if part.strip() else [] for part in wording.split("<>"))
        tail = rest[0] if rest else []
        fields = {"no": no, "id": name, "n": len(head), "head": " ".join(head), "gap": GAP if rest else 0, "m": len(tail), "tail": " ".join(tail), "open": len(rest) > 1}
        by_word.setdefault(head[0], []).append(F.struct(*[F.lit(v).alias(k) for k, v in fields.items()]))
    return F.create_map(*[x for word, rows in by_word.items() for x in (F.lit(word), F.array(*rows))])


def scan(docs: DataFrame) -> DataFrame:
    """Every row of ``docs``: ``doc_id, n_sentences, sentence_ids, licences``.

    ``sentence_ids`` are the identifiers of the recognised sentences in order, ``licences`` those of the rules whose
    identifiers follow each other in it, in rule order and once each. Null and empty texts have none. Rows that
    repeat a ``doc_id`` or have none are scanned each by its text; other columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.when(text.rlike(TELLING), text).alias("_text"))
    cut = fixed(rows, {"_tokens": F.when(F.col("_text").isNotNull(), tokens_of(F.col("_text"))).otherwise(F.array(F.lit("")))}).drop("_text")
    cut = fixed(cut, {"_words": F.transform("_tokens", lambda t: F.translate(t, SOFT, ""))})
    known = _known()
    token, word = (lambda i, a=a: F.try_element_at(F.col(a), (i + 1).cast("int")) for a in ("_tokens", "_words"))
    ends = lambda i: F.coalesce(token(i - 1).endswith(SOFT) | (token(i) == HARD), F.lit(True))
    held = lambda i, n: F.array_join(F.slice("_words", (i + 1).cast("int"), n), " ")
    starts = lambda i: (i > 0) & ((token(i - 1) == HARD) | token(i - 1).endswith(SOFT)) & F.map_contains_key(known, word(i))

    def closed(i: Column, k: Column) -> Column:
        """Whether the rest of the sentence follows the head, with as many words between as it allows."""
        after = lambda g: (held(i + k["n"] + g, k["m"]) == k["tail"]) & (k["open"] | ends(i + k["n"] + g + k["m"]))
        return F.exists(F.sequence(F.least(k["gap"], F.lit(1)), k["gap"]), after)

    def names(i: Column) -> Column:
        fits = F.filter(F.element_at(known, word(i)), lambda k: (held(i, k["n"]) == k["head"]) & closed(i, k))
        return F.transform(fits, lambda k: k["id"])

    places = fixed(cut, {"_places": F.filter(F.sequence(F.lit(0), F.size("_words") - 1), starts)})
    found = fixed(places, {"sentence_ids": F.flatten(F.transform("_places", names))}).drop("_tokens", "_words", "_places")
    marked = found.withColumn("line", F.concat(F.lit(" "), F.array_join("sentence_ids", " "), F.lit(" ")))
    rules = F.array(*[F.struct(F.lit(licence).alias("licence"), F.lit(f" {' '.join(ids)} ").alias("ids")) for licence, ids in RULES])
    matched = F.array_distinct(F.transform(F.filter(rules, lambda r: F.contains(F.col("line"), r["ids"])), lambda r: r["licence"]))
    for shorter, longer in WITHIN:
        matched = F.when(F.array_contains(matched, longer), F.array_remove(matched, shorter)).otherwise(matched)
    return marked.select("doc_id", F.size("sentence_ids").cast("long").alias("n_sentences"), "sentence_ids", matched.alias("licences"))
