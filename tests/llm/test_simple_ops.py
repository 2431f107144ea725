"""Operators 2, 5, 6, 8, 9 and 10 against brute force, round trips and held-out accuracy."""

import hashlib
import re
import time
import zlib
from collections import defaultdict

import numpy as np
import pytest

from quillstream.llm import exact_dedup, html_text, language_id, licenses, packing, token_counts, tokens
from quillstream.llm.core import table

ODD = [(1, "a b"), (2, None), (3, ""), (4, "a\t\n b"), (4, "a b"), (None, "a b"), (5, "word " * 30000), (6, " "), (7, "x<|endoftext|>y"), (8, "word " * 30000)]


def test_exact_dedup(spark, documents):
    got = {(r.doc_id, r.text_sha256): r for r in exact_dedup.exact_dedup(documents(ODD)).collect()}
    groups = defaultdict(list)
    for d, t in ODD:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(d)
    assert len(exact_dedup.exact_dedup(documents(ODD)).collect()) == len(ODD)
    for t, members in groups.items():
        for d in members:
            r = got[d, hashlib.sha256(t.encode()).hexdigest()]
            assert (r.keep_id, r.group_size, r.kept) == (min(x for x in members if x is not None), len(members), d == r.keep_id)
    assert exact_dedup.exact_dedup(documents([])).count() == 0
    kept = exact_dedup.keep_first(documents(ODD).withColumnRenamed("source", "keep_id"))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 5, 6, 7]


def reference_ids(text, public=None):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return t.encode(text, add_special_tokens=False).ids


def test_ids_equal_those_of_tokenizers(spark, sf_dir):
    for r in table(spark, sf_dir, "documents").limit(60).collect():
        assert tokens.ids(r.text, tokens.default_ranks()).tolist() == reference_ids(r.text)
    assert tokens.ids("x<|endoftext|>y  z　", tokens.default_ranks()).tolist() == reference_ids("x<|endoftext|>y  z　")


def check_pieces(rows, texts):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for d, pieces in by_doc.items():
        want, at = np.append(tokens.ids(texts[d], tokens.default_ranks()), 0).astype("<u4"), 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(want))
            assert r.ids_crc32 == zlib.crc32(want[at : at + r.length].tobytes())
            at += r.length
        assert at == len(want)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024 and at & (at - 1) == 0 and {r.tier for r in pieces} == {at}


def test_packing(spark, documents, sf_dir):
    docs = table(spark, sf_dir, "documents")
    check_pieces(packing.with_digest(packing.pack(docs)).collect(), {r.doc_id: r.text for r in docs.collect()})
    odd = {1: None, 2: "", 3: "word " * 5000, 4: "x<|endoftext|>y", 5: "a"}
    check_pieces(packing.with_digest(packing.pack(documents(list(odd.items())))).collect(), odd)
    assert packing.pack(documents([])).count() == 0
    assert packing.pack(documents([(1, "a"), (1, "a"), (None, "b")])).count() >= 3


def test_packing_fills_with_whole_documents(spark, sf_dir):
    rows = packing.pack(table(spark, sf_dir, "documents")).select("doc_id", "doc_tokens").collect()
    whole = sum(-(-n // 1024) for n in {r.doc_id: r.doc_tokens for r in rows}.values())
    assert len(rows) < 2 * whole


@pytest.mark.parametrize("block", [7, 1 << 18])
def test_token_counts(spark, documents, block):
    rows = [(1, "hello there world " * 10), (2, None), (3, "x<|endoftext|>y"), (None, "abc"), (4, ""), (4, "again")]
    got = sorted((r.doc_id or -1, r.n_tokens) for r in token_counts.document_token_counts(documents(rows), block).collect())
    assert got == sorted((d or -1, len(tokens.ids(t, tokens.default_ranks(), special=False))) for d, t in rows)
    assert token_counts.document_token_counts(documents([])).count() == 0


def test_language_id(spark, documents, sf_dir):
    rows = language_id.predict_documents(table(spark, sf_dir, "documents")).collect()
    lang = {r.doc_id: r.lang for r in table(spark, sf_dir, "documents").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    unseen = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in unseen]) > 0.95
    odd = {r.doc_id: r for r in language_id.predict_documents(documents([(1, "the cat sat", "en"), (2, None, "en"), (3, "12 34", "en"), (4, "le chat est", "fr"), (9, "the dog", None)])).collect()}
    assert odd[2].lang_pred == odd[3].lang_pred == "und" and odd[2].score == 0.0
    assert language_id.predict_documents(documents([])).count() == 0
    assert {r.lang_pred for r in language_id.predict_documents(documents([(1, "no label", None)])).collect()} == {"und"}


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><a href="/">Home</a> site name here</header><nav><ul><li><a>One</a></li></ul></nav>
<div class="cookie-notice">We use cookies to do many things today</div><div class="x"><h1>Head &amp; line</h1><p>First <b>bold</b> text with several words in it.</p><script>var a="<p>no</p>";</script>
<aside>Side text here</aside><form><label>Mail</label></form><p>Second&nbsp;paragraph has some more words as well<br>end.</p></div>
<div id="comments"><p>A reader wrote this long comment about the whole article text.</p></div><footer>&copy; all</footer></body></html>"""


def test_html_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    weights = html_text.fit_on(pages)
    assert weights["word"] > 0 and all(v < 0 for k, v in weights.items() if k != "word")
    want = "Head & line\n\nFirst bold text with several words in it.\n\nSecond paragraph has some more words as well end."
    assert html_text.main_text(PAGE, weights) == html_text.main_text(PAGE, html_text.DEFAULT) == want
    assert html_text.main_text(None, weights) == html_text.main_text("", weights) == html_text.main_text("<p></p>", weights) == ""
    broken = '<div class="ad">Buy this thing<article><p>One two three four<p class="notice">Not this<p>five six seven &am</article><div class="site-header">Name of site</div>'
    assert html_text.main_text(broken, weights) == html_text.main_text(broken, html_text.DEFAULT) == "One two three four\n\nfive six seven &am"
    long = "<p>" + "word " * 200000 + "</p>"
    assert html_text.main_text(long, weights) == ("word " * 200000).strip()
    for r in html_text.extract(pages, weights).limit(50).collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [html_text.SPACES.sub(" ", html_text.entities.unescape(re.sub(r"<[^>]*>", "", b))).strip() for b in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n\n".join(b for b in blocks if b)


def test_best_region_is_the_maximum():
    rng = np.random.default_rng(3)
    for _ in range(200):
        s = rng.normal(size=12).round(1).tolist()
        i, j = html_text.best_region(s)
        assert abs(sum(s[i:j]) - max(0, max(sum(s[a:b]) for a in range(12) for b in range(a, 13)))) < 1e-9


def test_licenses(spark, documents):
    text = "Copyright 2020.\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the X). The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND."
    rows = [(1, text), (2, "This work is licensed under the GNU General Public License, version 3."), (3, None), (4, ""), (5, "Licensed under CC BY-NC 4.0.\nThe x. Licensed under the Apache License, Version 2.0."), (5, "plain"), (6, "licence " * 50000)]
    got = sorted(((r.doc_id, r.licenses) for r in licenses.scan(documents(rows)).collect()), key=str)
    assert got == sorted([(1, ["MIT"]), (2, ["GPL-3.0"]), (3, []), (4, []), (5, ["CC-BY-NC-4.0", "Apache-2.0"]), (5, []), (6, [])], key=str)
    assert licenses.match(["bsd-grant", "bsd-source", "bsd-binary", "x"]) == ["BSD-2-Clause"]
    assert licenses.scan(documents([])).count() == 0


HEADERS = [
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software\ndistributed under the License is distributed on an "AS IS" BASIS,\nWITHOUT WARRANTIES OR CONDITIONS OF ANY KIND.'),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("ISC", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES.'),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable.\n1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0.\n(See accompanying file LICENSE_1_0.txt)"),
    ("EPL-2.0", "This program and the accompanying materials are made\navailable under the terms of the Eclipse Public License 2.0\nwhich is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n1. Redistributions of source code must retain the above copyright notice.\n2. Redistributions in binary form must reproduce the above copyright notice.\n3. Neither the name of the holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
]


WORDINGS = dict(HEADERS) | {
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software\ndistributed under the License is distributed on an "AS IS" BASIS,\nWITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "MIT": 'Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the "Software"), to deal\nin the Software without restriction, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED "AS\nIS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED.',
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this\nlist of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice.\n\n3. Neither the name of the copyright holder nor the names of its contributors\nmay be used to endorse or promote products derived from this software without\nspecific prior written permission.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this\nlist of conditions.\n\n2. Redistributions in binary form must reproduce the above copyright\nnotice, this list of conditions.",
    "GPL-2.0": "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation; either version 2 of the License, or\n(at your option) any later version.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at http://mozilla.org/MPL/2.0/.",
}
NOTICES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0."], "MIT": ["Released under the MIT License.", "Licensed under the MIT license."], "GPL-3.0": ["Licensed under the GNU General Public License, version 3."],
    "GPL-2.0": ["Licensed under the GNU General Public License, version 2."], "LGPL": ["Licensed under the GNU Lesser General Public License."], "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0."], "CC-BY-4.0": ["Licensed under CC BY 4.0."], "CC0-1.0": ["CC0 1.0 Universal."], "All-Rights-Reserved": ["All rights reserved."],
    "CC-BY-ND-4.0": ["Licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."], "CC-BY-NC-SA-4.0": ["Licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."],
    "Artistic-2.0": ["You may use it under the terms of the Artistic License 2.0."], "WTFPL": ["Do What The Fuck You Want To Public License."], "EPL-1.0": ["Made available under the terms of the Eclipse Public License v1.0."],
    "LGPL-3.0": ["It is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License, either version 3 of the License, or (at your option) any later version."],
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License."], "ISC": [HEADERS[6][1].split("\n")[0]], "EPL-2.0": ["Made available under the terms of the Eclipse Public License v. 2.0."],
    "BSL-1.0": ["Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license."],
}


def licences_of(text):
    return licenses.match(licenses.sentence_ids(text, licenses.recogniser()))


@pytest.mark.parametrize("comment", ["", "# ", " * ", "// ", ";; ", "! ", "-- ", " | "])
def test_every_licence_rule_fires_on_its_own_words(comment):
    lines = lambda text: "".join(f"{comment}{x}\n" for x in text.split("\n"))
    for name, text in WORDINGS.items():
        assert licences_of(lines("Copyright 2020 A. Holder.\n" + text)) == [name]
    for name, texts in NOTICES.items():
        for text in texts:
            assert licences_of(lines("A file.\n" + text.replace(" ", "\n", 1) + "\nMore.")) == [name]
    assert {r[0] for r in licenses.RULES} == set(WORDINGS) | set(NOTICES)


def test_no_known_sentence_is_lost_to_the_shortcut(spark, documents):
    texts = ["THE SOFTWARE IS PROVIDED AS-IS, WITHOUT WARRANTY OF ANY KIND", "The software is provided as   is without warranty of any kind", "the software is provided as\n# is, without warranty of any kind."]
    got = [r.sentence_ids for r in licenses.scan(documents(list(enumerate(texts)))).collect()]
    assert got == [["mit-as-is"]] * 3
    assert " " not in licenses.MARKS.pattern and all(licenses.MARKS.search(x) for x in licenses.SENTENCES.values())
    assert licences_of("We gave them all. Rights reserved are others.") == []
    assert licences_of("x" + "." * 200000 + "a" + ". " * 100000) == []


@pytest.mark.parametrize("element", ["button", "svg", "select", "object", "iframe", "canvas", "video", "noscript", "textarea"])
def test_html_without_end_tags_keeps_the_rest(element):
    first, second = "First words of the article stand here.", "Second paragraph has some more words as well."
    for head in ("<head><title>A title</title>", "<head><title>A title</title><meta charset=utf-8>", "<head><title>A title</title></head>", "<title>A title</title>"):
        page = f"<html>{head}<body><article><p>{first}</p><{element} class=x><p>{second}</p></article></body></html>"
        assert html_text.main_text(page, html_text.DEFAULT) == f"{first}\n\n{second}"
        closed = page.replace(f"<{element} class=x>", f"<{element} class=x>silent</{element}>")
        assert html_text.main_text(closed, html_text.DEFAULT) == f"{first}\n\n{second}"
    assert html_text.main_text(f"<p>{first}</p><script>var a = 1;", html_text.DEFAULT) == first
    later = f"<article><p>{first}</p><{element} class=x><p>{second}</p></article><p>More words follow here.</p><{element}>silent</{element}>"
    assert html_text.main_text(later, html_text.DEFAULT) == f"{first}\n\n{second}\n\nMore words follow here."


TEXT = "One two three four five six seven eight nine ten."


@pytest.mark.parametrize(
    "page",
    [
        "<html><head><title>T</title><meta charset=utf-8><body><p>{}</p></body></html>",
        '<html><body class="layout no-sidebar"><div class="layout no-sidebar"><p>{}</p></div></body></html>',
        '<div class="content social"><p>{}</p></div>',
        '<div id="search-results-article"><p>{}</p></div>',
        '<p><a name=x>{}</p>',
        '<p><a name="x>{}</p><p class="y"></p>',
        '<p title="a > b">{}</p>',
        "<div class='comment-list'><p>Reader words here.</p></div><p>{}</p><div class=\"sidebar-left\">Side words</div>",
        "<p>{}</p><!-- not this",
        "<svg><path><p>{}</p></body>",
    ],
)
def test_html_fragments(page):
    assert html_text.main_text(page.format(TEXT), html_text.DEFAULT) == TEXT


@pytest.mark.parametrize("part", ["<a", '<a "', "<a '>", "<svg>", "<nav><aside>", "</nav><aside>", "<!--", "&amp", '<p class="', "<button>", "<div class='ad'>x", "<"])
def test_long_pages_take_linear_time(part):
    page = "<p>" + TEXT + "</p>" + part * (400_000 // len(part)) + "</body>"
    began = time.time()
    html_text.main_text(page, html_text.DEFAULT)
    assert time.time() - began < 8


def test_region_against_brute_force_without_labels(spark, sf_dir):
    """The region of pages whose labels are taken out is the best of all regions, by their tokens' weights."""
    weights = html_text.fit_on(table(spark, sf_dir, "pages"))
    for r in table(spark, sf_dir, "pages").orderBy("page_id").limit(12).collect():
        page = re.sub(r"</?article>", "", r.html)
        scores = [weights.get(k, weights["other tag"]) * n if n else 0.0 for k, n in html_text.kinds(html_text.parse(page))]
        i, j = html_text.best_region(scores)
        sums = np.concatenate([[0], np.cumsum(scores)])
        assert abs(sums[j] - sums[i] - max(0, (sums[None, :] - sums[:, None])[np.triu_indices(len(sums))].max())) < 1e-6
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        longest = max(re.split(r"</?(?:p|h1)>", inner), key=len)
        assert html_text.entities.unescape(html_text.SPACES.sub(" ", re.sub(r"<[^>]*>", "", longest))).strip() in html_text.main_text(page, weights)


def test_html_table_with_odd_rows(spark):
    schema = "page_id long, url string, html string, text string, words int"
    rows = [(1, "u", f"<p>{TEXT}</p>", "old", 1), (1, "u", f"<p>{TEXT}</p>", "old", 1), (None, None, None, None, None), (2, "u", "", "x", 2)]
    got = html_text.extract(spark.createDataFrame(rows, schema), html_text.DEFAULT).collect()
    assert sorted(r.text for r in got) == ["", "", TEXT, TEXT] and got[0].words in (1, 2, None)
    assert html_text.extract(spark.createDataFrame([], schema), html_text.fit_on(spark.createDataFrame([], schema))).count() == 0


def test_language_id_odd_rows(spark, documents):
    odd = ["²", "①", "Ⅷ", "½ 12", "...", "日本"]
    rows = [(i, t) for i, t in enumerate(odd)] + [(20, "the cat sat on the mat", "en"), (21, "le chat est sur la table", "fr")] + [(22, "repeated row of one id", "en")] * 50 + [(23, "mot " * 300000, None)]
    clash = documents(rows).withColumnRenamed("source", "at").withColumnRenamed("n_chars", "score")
    got = {r.doc_id: r.lang_pred for r in language_id.predict_documents(clash).collect()}
    assert [got[i] for i in range(5)] == ["und"] * 5 and got[5] != "und" and got[23] != "und"


def test_exact_dedup_of_rows_without_id(spark, documents):
    rows = [(None, "a  b")] * 70 + [(None, "c")] * 3 + [(5, "a b"), (4, "a\tb"), (4, "a b"), (9, None)]
    got = sorted((r.doc_id or 0, r.keep_id or 0, r.group_size, r.kept) for r in exact_dedup.exact_dedup(documents(rows)).collect())
    assert got == sorted([(0, 4, 73, False)] * 70 + [(0, 0, 3, True)] * 3 + [(5, 4, 73, False), (4, 4, 73, True), (4, 4, 73, True), (9, 9, 1, True)])


def brute_ids(text):
    """The known sentences of a text by plain search in every normalised sentence; of overlapping ones the first, then the longest."""
    out = []
    for sentence in licenses.SENTENCE_END.split(text):
        words = licenses.normalise(sentence)
        places = sorted((m.start(), -len(s), n) for n, s in licenses.SENTENCES.items() for m in re.finditer(f"(?= {s} )", words))
        reach = -1
        for at, size, name in places:
            if at >= reach:
                out.append(name)
                reach = at - size + 1
    return out


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// "])
def test_standard_headers(mark):
    known = licenses.recogniser()
    for name, text in HEADERS:
        wrapped = "\n".join(mark + line for line in ("Copyright (c) 2020 Some Holder\n\n" + text).splitlines())
        found = licenses.sentence_ids(wrapped, known)
        assert licenses.match(found) == [name], (name, found)
        assert found == brute_ids(wrapped)


def test_licence_scan_against_brute_force(spark, documents, sf_dir):
    docs = [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()]
    rows = docs + [(10**6, "\n\n".join(t for _, t in HEADERS)), (10**6, None), (None, HEADERS[0][1] * 2), (10**6 + 1, "All rights reserved. " * 20000)]
    clash = documents(rows).withColumnRenamed("lang", "found").withColumnRenamed("source", "licenses")
    got = sorted(((r.doc_id or 0, r.sentence_ids) for r in licenses.scan(clash).collect()), key=repr)
    assert got == sorted(((d or 0, brute_ids(t or "")) for d, t in rows), key=repr)
