"""Operator 10: licence recognition by sentence rules.

A text is cut into sentences, each normalised (lower case, words only). A sentence is mapped to the identifiers of the known
licence sentences that it holds word for word; holders, years and comment marks may stand around them. The sequence of a document's identifiers is then
matched against ordered rules, the longest first; a matched stretch is used once.

Very long texts are scanned whole, sentence by sentence. Nulls: a null or empty text has no licence; null and repeated ids keep a row each. Overlapping rules: the longer rule wins,
then the earlier one in the table. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import re

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Known licence sentences, normalised, by identifier.
SENTENCES = {
    "apache-notice": "licensed under the apache license version 2 0",
    "apache-use": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "apache-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis",
    "mit-notice": "released under the mit license",
    "mit-notice-2": "licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "mit-notice-kept": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-as-is": "the software is provided as is without warranty of any kind",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice",
    "bsd-names": "may be used to endorse or promote products derived from this software without specific prior written permission",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc-as-is": "the software is provided as is and the author disclaims all warranties",
    "zlib-as-is": "this software is provided as is without any express or implied warranty",
    "zlib-origin": "the origin of this software must not be misrepresented",
    "boost-notice": "distributed under the boost software license version 1 0",
    "boost-grant": "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "wtfpl": "do what the fuck you want to public license",
    "epl1-notice": "made available under the terms of the eclipse public license v1 0",
    "epl2-notice": "made available under the terms of the eclipse public license 2 0",
    "epl2-notice-2": "made available under the terms of the eclipse public license v 2 0",
    "artistic2-notice": "under the terms of the artistic license 2 0",
    "gpl3-notice": "licensed under the gnu general public license version 3",
    "gpl2-notice": "licensed under the gnu general public license version 2",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
    "gpl-v3": "either version 3 of the license or at your option any later version",
    "gpl-v2": "either version 2 of the license or at your option any later version",
    "gpl2-only": "under the terms of the gnu general public license version 2 as published by the free software foundation",
    "lgpl-free": "is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license",
    "lgpl-v21": "either version 2 1 of the license or at your option any later version",
    "agpl-free": "is free software you can redistribute it and or modify it under the terms of the gnu affero general public license",
    "agpl-notice": "licensed under the gnu affero general public license",
    "lgpl-notice": "licensed under the gnu lesser general public license",
    "mpl-notice": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "mpl-copy": "if a copy of the mpl was not distributed with this file you can obtain one at",
    "cc-by-4-work": "licensed under a creative commons attribution 4 0 international license",
    "cc-by-sa-4-work": "licensed under a creative commons attribution sharealike 4 0 international license",
    "cc-by-nc-4-work": "licensed under a creative commons attribution noncommercial 4 0 international license",
    "cc-by-nd-4-work": "licensed under a creative commons attribution noderivatives 4 0 international license",
    "cc-by-nc-sa-4-work": "licensed under a creative commons attribution noncommercial sharealike 4 0 international license",
    "cc-by-nc-4": "licensed under cc by nc 4 0",
    "cc-by-sa-4": "licensed under cc by sa 4 0",
    "cc-by-4": "licensed under cc by 4 0",
    "cc0": "cc0 1 0 universal",
    "reserved": "all rights reserved",
}
#: Ordered rules, a licence and the sentence identifiers that must follow one another.
RULES = [
    ("Apache-2.0", ["apache-notice", "apache-use", "apache-copy", "apache-as-is"]),
    ("Apache-2.0", ["apache-notice"]),
    ("MIT", ["mit-grant", "mit-notice-kept", "mit-as-is"]),
    ("MIT", ["mit-notice"]),
    ("MIT", ["mit-notice-2"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("ISC", ["isc-grant", "isc-as-is"]),
    ("ISC", ["isc-grant"]),
    ("Zlib", ["zlib-as-is", "zlib-origin"]),
    ("BSL-1.0", ["boost-notice"]),
    ("BSL-1.0", ["boost-grant"]),
    ("Unlicense", ["unlicense"]),
    ("WTFPL", ["wtfpl"]),
    ("EPL-1.0", ["epl1-notice"]),
    ("EPL-2.0", ["epl2-notice"]),
    ("EPL-2.0", ["epl2-notice-2"]),
    ("Artistic-2.0", ["artistic2-notice"]),
    ("GPL-2.0", ["gpl2-only"]),
    ("LGPL-2.1", ["lgpl-free", "lgpl-v21"]),
    ("LGPL-3.0", ["lgpl-free", "gpl-v3"]),
    ("AGPL-3.0", ["agpl-free", "gpl-v3"]),
    ("AGPL-3.0", ["agpl-notice"]),
    ("MPL-2.0", ["mpl-notice", "mpl-copy"]),
    ("CC-BY-4.0", ["cc-by-4-work"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4-work"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4-work"]),
    ("CC-BY-ND-4.0", ["cc-by-nd-4-work"]),
    ("CC-BY-NC-SA-4.0", ["cc-by-nc-sa-4-work"]),
    ("GPL-3.0", ["gpl-free", "gpl-v3"]),
    ("GPL-2.0", ["gpl-free", "gpl-v2"]),
    ("GPL-3.0", ["gpl3-notice"]),
    ("GPL-2.0", ["gpl2-notice"]),
    ("LGPL", ["lgpl-notice"]),
    ("MPL-2.0", ["mpl-notice"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4"]),
    ("CC-BY-4.0", ["cc-by-4"]),
    ("CC0-1.0", ["cc0"]),
    ("All-Rights-Reserved", ["reserved"]),
]
#: A sentence ends with its stop behind a word and before white space, unless a number follows ("v. 2.0"). Semicolons, colons,
#: line breaks and the marks of comment lines ("!", ";;", "|") end none, as licences have them inside their sentences.
SENTENCE_END = re.compile(r"(?<=[\w\"')\]])[.!?]++(?=\W*\s)(?![\W_]*\d)")
NOT_WORD = re.compile(r"[^a-z0-9]+")


def normalise(sentence: str) -> str:
    return f" {NOT_WORD.sub(' ', sentence.lower()).strip()} "


def recogniser() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for name, sentence in SENTENCES.items():
        found.add_word(f" {sentence} ", name)
    found.make_automaton()
    return found


#: The longest word of each known sentence, which normalising leaves whole: a sentence without any of them holds none.
MARKS = re.compile("|".join(sorted({max(s.split(), key=len) for s in SENTENCES.values()})), re.I)


def sentence_ids(text: str, known: ahocorasick.Automaton) -> list[str]:
    """The identifiers of the text's known sentences, in order. A line break inside a sentence is a space."""
    out = []
    for sentence in SENTENCE_END.split(text):
        if MARKS.search(sentence):
            # A sentence holds an identifier once; of overlapping ones the longest stays.
            spans = sorted(((end - len(SENTENCES[n]) - 1, end, n) for end, n in known.iter(normalise(sentence))), key=lambda x: (x[0], -x[1]))
            reach = -1
            for start, end, name in spans:
                if start >= reach:
                    out.append(name)
                    reach = end
    return out


def match(found: list[str], rules=RULES) -> list[str]:
    ordered = sorted(rules, key=lambda r: -len(r[1]))
    out, i = [], 0
    while i < len(found):
        rule = next((r for r in ordered if found[i : i + len(r[1])] == r[1]), None)
        if rule:
            out.append(rule[0])
        i += len(rule[1]) if rule else 1
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, licenses, sentence_ids) of every document; licences in order of appearance, repeats included."""

    @F.pandas_udf("licenses array<string>, sentence_ids array<string>")
    def found(texts: pd.Series) -> pd.DataFrame:
        known = recogniser()
        ids = [sentence_ids(t, known) if t and MARKS.search(t) else [] for t in texts]
        return pd.DataFrame({"licenses": [match(x) for x in ids], "sentence_ids": ids})

    return docs.select(F.col(id_col), found(F.col(text_col)).alias("found")).select(id_col, "found.licenses", "found.sentence_ids")
