"""Operators against plain versions, with nulls, empty and odd texts, ties, repeated rows and extra columns."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece as spm
from pyspark.sql import functions as F

import brute
from tillstar.llm import langid, licenses, perplexity, repeats, rules, warc
from tillstar.llm import sentencepiece as sp
from tillstar.llm.decontam import contaminated
from tillstar.llm.line_dedup import dedup_lines
from tillstar.llm.near_dup import near_duplicates, verified

SCHEMA = "doc_id bigint, text string, lang string, th string, h1 bigint, key string"
_WORDS = "the of and ingre ention éoux schein über atre bleson ondre wh haou qu erst mentai ly ñas ciónes".split()


def _sentence(rnd, n):
    return " ".join(rnd.choice(_WORDS) + str(rnd.randrange(40)) for _ in range(n))


def sample(seed=3, n=40):
    """(doc_id, text): null, empty and blank texts, a long one, copies, near copies, shared lines and passages."""
    rnd = random.Random(seed)
    passage = _sentence(rnd, 60)
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "\n\n"), (5, "Ab cd"), (6, "ab CD")]
    for d in range(7, n):
        lines = [_sentence(rnd, rnd.randrange(3, 40)) for _ in range(rnd.randrange(1, 6))]
        if d % 3 == 0:
            lines.insert(rnd.randrange(len(lines) + 1), passage)
        if d % 4 == 0:
            lines.append("  A Shared LINE of text\t")
        rows.append((d, "\n".join(lines)))
    base = _sentence(rnd, 120).split()
    for d in range(n, n + 12):  # near copies, some close to the threshold
        words = list(base)
        for _ in range(rnd.randrange(0, 7)):
            words[rnd.randrange(len(words))] = f"x{rnd.randrange(1000)}"
        rows.append((d, " ".join(words)))
    rows += [(n + 20, rows[10][1]), (n + 21, rows[10][1]), (n + 22, "a" * 1200), (n + 23, _sentence(rnd, 6000))]
    return rows


def odd(rows):
    """Rows without an id and repeated rows as well."""
    return [*rows, (None, rows[12][1]), (None, "alone without an id, a text of some length"), rows[15], rows[15], (20, rows[9][1])]


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en" if i % 2 else None, "x", i, "k") for i, (d, t) in enumerate(rows)], SCHEMA).repartition(3)


def plain(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("hot", [8192, 1])
def test_repeats(spark, hot):
    rows = odd(sample())
    got = repeats.remove_repeats(frame(spark, rows), span=60, gram=24, hot=hot).collect()
    assert plain(got) == plain(brute.repeats(rows, 60))


def test_repeat_nodes_hold_equal_strings(spark):
    rows = sample()
    texts = {d: (t or "").encode() for d, t in rows}
    found = repeats.occurrences(frame(spark, rows), span=60, gram=24).where("maximal").collect()
    strings = {}
    for r in found:
        piece = texts[r["doc_id"]][r["start"] : r["start"] + r["len"]]
        assert len(piece) == r["len"] and strings.setdefault(r["node"], piece) == piece
    assert len(strings) > 3


def test_suffix_array_and_tree():
    text = b"mississippi\xffmiss\xff"
    starts = np.array([i for i in range(len(text)) if text[i] != 255])
    left = np.array([text.index(b"\xff", i) - i for i in starts])
    sa, lcp = repeats.suffix_array(np.frombuffer(text, np.uint8), starts, left, 16)
    cut = lambda i: text[i : text.index(b"\xff", i) + 1]
    assert [cut(i) for i in sa] == sorted(cut(i) for i in starts)
    for k in range(1, len(sa)):
        a, b = cut(sa[k - 1])[:-1], cut(sa[k])[:-1]
        assert lcp[k] == max(n for n in range(len(a) + 1) if b.startswith(a[:n]))
    nodes, deepest = repeats.intervals(lcp.tolist(), 1)
    for depth, first, last, parent in nodes:
        assert min(lcp[first + 1 : last + 1]) == depth and (parent < 0 or nodes[parent][0] < depth)
    assert all(k < 0 or nodes[k][1] <= i <= nodes[k][2] for i, k in enumerate(deepest))


@pytest.mark.parametrize(("batches", "fanout"), [(1, 2), (5, 2), (4, 3)])
def test_line_dedup(spark, batches, fanout):
    rows = odd(sample())
    got = dedup_lines(frame(spark, rows), batches=batches, fanout=fanout).select("doc_id", "n_lines", "n_dropped", "kept_text").collect()
    assert plain(got) == plain(brute.line_dedup(rows))
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("line_run")]


@pytest.mark.parametrize(("words", "k"), [(4, 64), (5, 64)])
def test_near_duplicates(spark, words, k):
    rows = odd(sample())
    got = near_duplicates(frame(spark, rows), words=words, k=k).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert plain(got) == plain(brute.near_duplicates(rows, words))


def test_near_duplicates_in_a_large_list(spark):
    """More near copies than hubs: later rounds must find what the first leave."""
    rnd = random.Random(5)
    base = _sentence(rnd, 60).split()
    rows = []
    for d in range(90):
        words = list(base)
        for _ in range(rnd.randrange(0, 4)):
            words[rnd.randrange(60)] = f"y{rnd.randrange(100)}"
        rows.append((d, " ".join(words)))
    got = near_duplicates(frame(spark, rows), words=2).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert plain(got) == plain(brute.near_duplicates(rows, 2))


def test_near_duplicates_compares_few_half_alike(spark, monkeypatch):
    """Each of many copies has 15 of 100 words for itself, too many to be linked with any: they are not compared with each other."""
    base = [f"b{i}" for i in range(100)]
    rows = [(d, " ".join(base[15:] + [f"own{d}x{i}" for i in range(15)])) for d in range(40)]
    rows += [(d, " ".join(base[3:] + [f"own{d}x{i}" for i in range(3)])) for d in range(40, 44)]
    rows += [(44, " ".join(base[:88])), (45, " ".join(base[:70]))]
    compared = []

    def counting(pairs, *args):
        compared.append(pairs.count())
        return verified(pairs, *args)

    monkeypatch.setattr("tillstar.llm.near_dup.verified", counting)
    got = near_duplicates(frame(spark, rows), words=1).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert plain(got) == plain(brute.near_duplicates(rows, 1))
    assert len({r["component_id"] for r in got}) < len(rows)
    assert sum(compared) < 300  # 780 pairs of the forty alone


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_contaminated(spark, monkeypatch, limit):
    monkeypatch.setattr("tillstar.llm.common.BROADCAST_BYTES", limit)
    rnd = random.Random(8)
    items = [(i, _sentence(rnd, rnd.randrange(12, 40)).capitalize() + ".") for i in range(6)] + [(6, None), (7, "too few words"), (8, "")]
    rows = odd(sample())
    for d, (i, edits) in enumerate([(0, 0), (1, 1), (2, 2), (3, 0), (4, 6)], 200):
        words = items[i][1].split()
        for _ in range(edits):
            words[rnd.randrange(len(words))] = "changed"
        rows.append((d, "Some words before, " + " ".join(words).upper() + " and after it.\nMore."))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = contaminated(frame(spark, rows), bench)
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == brute.contaminated(rows, items)
    assert (200, 0) in brute.contaminated(rows, items)


def test_contaminated_with_repeated_words(spark):
    """A run of equal words, as in a table, replaced by another value: one heavy shingle, and most of the others shared."""
    rnd = random.Random(5)
    rows, items = [], []
    for i in range(12):
        words = [f"w{rnd.randrange(10**6)}" for _ in range(330)]
        items.append((i, " ".join(words[:160] + ["0"] * 34 + words[160:])))
        rows.append((i, " ".join(words[:160] + ["1"] * 34 + words[160:])))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in contaminated(frame(spark, rows), bench).collect()}
    assert got == brute.contaminated(rows, items) == {(i, i) for i in range(12)}


def test_warc(spark, tmp_path):
    rnd = random.Random(2)
    big, other = _sentence(rnd, 400), "<p>\r\n\r\né" + _sentence(rnd, 300)
    rows = [(1, "u1", big), (5, "u\r\n5", big), (3, None, big), (2, "u", "small"), (4, "u", "small"), (6, "u", None), (7, "u", ""), (8, "u", other)]
    rows += [(9, "u", other), (9, "u", other), (None, "u", other), (10, "x", _sentence(rnd, 250))]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id bigint, url string, html string, digest string")
    warc.write_archives(pages.repartition(2), str(tmp_path / "a"), per_file=4)
    index = warc.normalise(spark, str(tmp_path / "a"), str(tmp_path / "b"))
    got = warc.read_records(index).collect()
    top, want = {}, []
    for page, _, html in rows:
        if len((html or "").encode()) >= 1000:
            top[html] = max(top.get(html, -1), -1 if page is None else page)
    answered = set()
    for page, _, html in rows:
        data = (html or "").encode()
        revisit = html in top and (page != top[html] or (page, html) in answered)
        answered.add((page, html))
        want.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", top[html] if revisit else None))
    assert plain((r["page_id"], r["payload_bytes"], r["digest"], r["kind"], r["refers_to"]) for r in got) == plain(want)
    assert {bytes(r["payload"]) for r in got if r["kind"] == "response"} == {(h or "").encode() for _, _, h in rows}
    one = index.where("offset > 0").limit(1).collect()[0]
    assert one["length"] > 0 and one["archive"].endswith(".warc.gz")


def test_licenses(spark):
    s = licenses.SENTENCES
    texts = [f"{s['m']}.\n{s['n']}. {s['o']}! {s['p']}.", f"{s['m']}. Odd one. {s['n']}.\n\n{s['o']}", "Released under the MIT License.\nAll rights reserved."]
    rows = odd([(i + 500, t) for i, t in enumerate(texts)] + sample())
    got = licenses.scan(frame(spark, rows)).select("doc_id", "n_hits", "identifiers", "licenses").collect()
    want = [(d, *brute.licenses(t, licenses.KNOWN, licenses.ALL_RULES, licenses.VARIABLE)) for d, t in rows]
    assert plain(got) == plain(want)
    assert {r["licenses"] for r in got} >= {"BSD-3-Clause:1", "BSD-2-Clause:1", "MIT:1;all rights reserved:1"}


def test_licenses_inside_others_and_with_names(spark):
    """What stands in a rule's gaps stays; a holder's name does not hide the third condition; tables are arguments."""
    s = licenses.KNOWN
    rnd = random.Random(6)
    text = lambda ids: "".join(f"{s[k]}{rnd.choice(['.', '. ', '!'])}\n" for k in ids)
    named = "Neither the name of Example, Inc. nor the names of its\n   contributors may be used to endorse or promote products derived from this software\n   without specific prior written permission."
    named = named.replace(", Inc.", " Inc")
    texts = [text("xqbcde"), text("gwjhi"), _BSD + "\n3. " + named + "\n", _BSD, text("gghh"), text("mwnwo")]
    texts += [text("".join(rnd.choice("ghixbcdemnopkljfaqw") for _ in range(rnd.randrange(1, 9)))) for _ in range(150)]
    rows = list(enumerate(texts))
    got = {r["doc_id"]: (r["identifiers"], r["licenses"]) for r in licenses.scan(frame(spark, rows)).collect()}
    assert got[0] == ("xqbcde", "Apache-2.0:1;CC-BY-NC-4.0:1") and got[1] == ("gwjhi", "MIT:1;GPL-3.0:1;all rights reserved:1")
    assert got[2] == ("mnop", "BSD-3-Clause:1") and got[3] == ("mno", "BSD-2-Clause:1")
    for d, t in rows:
        assert got[d] == brute.licenses(t, licenses.KNOWN, licenses.ALL_RULES, licenses.VARIABLE)[1:], t
    own = licenses.scan(frame(spark, [(1, "Do what you like. All else is yours")]), {"z": "do what you like", "y": "all else is yours"}, [("own", "zy")], [])
    assert own.first()["licenses"] == "own:1"


def test_license_twin_reads_all_tables(spark):
    import duckdb
    import pandas as pd

    texts = [_MIT, _APACHE, _GPL2, _BSD, _MPL, _ISC, _MIT.replace("\n", "\r\n"), "// SPDX-License-Identifier: MPL-2.0\nint x;", "a: All rights\nreserved", None, "", "x.:\n\ny;;"]
    texts += [v for v in licenses.KNOWN.values()]
    rows = list(enumerate(texts))
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]))
    want = con.execute(f"SELECT doc_id, n_hits, identifiers, licenses FROM ({licenses.twin()})").fetchall()
    got = licenses.scan(frame(spark, rows)).select("doc_id", "n_hits", "identifiers", "licenses").collect()
    assert plain(got) == plain(want) and sum(r[1] for r in want) > len(licenses.KNOWN)


_MIT = """MIT License

Copyright (c) 2020 A. Person

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
AUTHORS BE LIABLE.
"""
_APACHE = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.
"""
_GPL2 = """ * This program is free software; you can redistribute it and/or
 * modify it under the terms of the GNU General Public License
 * as published by the Free Software Foundation; either version 2
 * of the License, or (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
 * GNU General Public License for more details.
"""
_BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
_MPL = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */
"""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""


def test_published_licenses(spark):
    want = {
        _MIT: ("ghi", "MIT:1"), _APACHE: ("xbcde", "Apache-2.0:1"), _GPL2: ("Al", "GPL-2.0-or-later:1"), _BSD: ("mno", "BSD-2-Clause:1"),
        _MPL: ("IK", "MPL-2.0:1"), _ISC: ("L", "ISC:1"), _MIT.replace("\n", "\r\n"): ("ghi", "MIT:1"), _BSD + "\n" + _MIT: ("mnoghi", "MIT:1;BSD-2-Clause:1"),
        "// SPDX-License-Identifier: MIT\nint x;": ("t", "MIT:1"), "# SPDX-License-Identifier: Apache-2.0": ("u", "Apache-2.0:1"),
        "All rights\n\nreserved": ("", ""), "All rights.\nreserved": ("", ""), "All rights\nreserved by\nall": ("", ""), "\n" * 50_000 + "All\nrights\nreserved" + " \n" * 50_000: ("w", "all rights reserved:1"),
        **{f"x\nSPDX-License-Identifier: {name}\n\ny": (k, f"{name}:1") for k, (name, v) in licenses.MORE.items() if v.startswith("spdx")},
    }
    texts = list(want)
    got = licenses.scan(frame(spark, list(enumerate(texts)))).collect()
    assert {texts[r["doc_id"]]: (r["identifiers"], r["licenses"]) for r in got} == want


def test_every_license_sentence_is_found_alone(spark):
    known = {**licenses.SENTENCES, **{k: v for k, (_, v) in licenses.MORE.items()}}
    got = licenses.scan(frame(spark, list(enumerate(known.values())))).collect()
    assert {r["doc_id"]: r["identifiers"] for r in got} == dict(enumerate(known))


def test_langid(spark):
    rnd = random.Random(4)
    stems = {"aa": "the ing tion of and", "bb": "schen ung keit der und", "cc": "eau aux ment de la"}
    rows = []
    for d in range(300):
        lang = "aabbcc"[d % 3 * 2 : d % 3 * 2 + 2]
        text = " ".join("".join(rnd.choices(stems[lang].split(), k=2)) for _ in range(rnd.randrange(3, 60)))
        rows.append((d, text, lang if d % 7 else None, d))
    rows += [(300, None, "aa", 0), (301, "", "aa", 0), (302, "12 -- 34", "bb", 0), (None, "the ingtion", "aa", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score int")
    model = langid.fit(docs.where(~langid.held_out()))
    got = {r["doc_id"]: r for r in langid.predict(docs, model).collect()}
    assert len(got) == 304 and {got[d]["lang_pred"] for d in (300, 301, 302)} == {"und"} and not got[302]["accepted"]
    truth = {d: "aabbcc"[d % 3 * 2 : d % 3 * 2 + 2] for d in range(300)}
    assert sum(got[d]["lang_pred"] == truth[d] for d in truth) >= 294
    none = langid.predict(docs, langid.fit(docs.where("false"))).collect()
    assert {r["lang_pred"] for r in none} == {"und"} and {r["score"] for r in none} == {0.0}


def test_langid_is_fitted_off_the_driver(spark, monkeypatch):
    """The sample is not collected, and the model is what training makes of it in its order."""
    here, train = [], langid.train
    monkeypatch.setattr(langid, "train", lambda texts, labels: here.append(1) or train(texts, labels))
    texts = [("the old %d man and the sea " % k, "en") if k % 2 else ("der alte %d mann und das meer " % k, "de") for k in range(20)]
    docs = spark.createDataFrame([(1, t, lang) for t, lang in texts], "doc_id bigint, text string, lang string")
    model = langid.fit(docs, per_language=10**6)
    assert model.languages == ["de", "en"] and not here
    placed = docs.select(F.col("text").cast("binary").alias("b"), "lang", F.pmod(F.xxhash64("doc_id", "text", F.lit("langid")), F.lit(1 << 30)).alias("place"))
    rows = placed.orderBy("place", "lang", "b").collect()
    want = train([bytes(r["b"]) for r in rows], [r["lang"] for r in rows])
    assert np.allclose(model.table, want.table, atol=1e-3) and np.array_equal(model.known, want.known)


def test_langid_learns_from_whole_texts(spark):
    """Long texts with the same header, longer than what is taken of a text."""
    rnd = random.Random(9)
    stems = {"aa": "the ing tion of and", "bb": "schen ung keit der und", "cc": "eau aux ment de la"}
    words = lambda lang, n: " ".join("".join(rnd.choices(stems[lang].split(), k=2)) for _ in range(n))
    header = words("aa", 6000)
    assert len(header) > langid.TRAIN_BYTES
    rows = [(d, header + " " + words(lang, 9000), lang) for d, lang in enumerate(["aa", "bb", "cc"] * 10)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    texts = [(d, words(lang, 30), lang) for d, lang in enumerate(["aa", "bb", "cc"] * 10)]
    got = langid.predict(spark.createDataFrame(texts, "doc_id bigint, text string, lang string"), model).collect()
    assert sum(r["lang_pred"] == texts[r["doc_id"]][2] for r in got) >= 29


def test_bucket_table_is_the_two_layer_model():
    texts = [b"abcd efg", b"x", b"", b"aaaa bbbb cccc"]
    rng = np.random.default_rng(1)
    table = rng.normal(size=((2 << langid.BITS) + 1, 3)).astype(np.float32)
    table[-1] = 0
    model = langid.Model(["a", "b", "c"], table, np.zeros(3))
    together = model.logits(langid.Texts(pa.array(texts)))
    for i, t in enumerate(texts):
        assert np.allclose(together[i], model.logits(langid.Texts(pa.array([t])))[0], atol=1e-5)


def test_perplexity_counts_and_model(spark):
    rows = odd(sample())
    rows.append((900, "so it is said again and now so it is said again and now " * 3))
    got = perplexity.judge(frame(spark, rows)).collect()
    want = [(d, *brute.base_rules(t)) for d, t in rows]
    assert plain((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got) == plain(want)
    for r in got:
        failed = r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_perplexity_bands_of_copies_and_rare_classes(spark):
    rnd = random.Random(8)
    clean = [_sentence(rnd, 100) for _ in range(60)]
    copy = " ".join(rnd.choice(["abab", "cdcd", "efef", "ghgh"]) + str(k) for k in range(100))
    junk = " ".join("".join(rnd.choices("qzxjkvwbpy", k=9)) for _ in range(1500))
    texts = [*clean, *[copy] * 100, junk]
    docs = spark.createDataFrame([(d, t, "en") for d, t in enumerate(texts)], "doc_id bigint, text string, lang string")
    kept = {r["doc_id"]: r["kept"] for r in perplexity.judge(docs).collect()}
    assert all(kept[d] for d in range(60)) and not kept[160]


def test_kneser_ney_sums_to_one():
    texts = perplexity.Texts(pa.array([s for _, s in sample() if s]))
    code, _ = perplexity.ngrams(texts)
    codes, counts = np.unique(code.astype(np.int64), return_counts=True)
    model = perplexity.Model.loads(perplexity.Model.build(codes, counts).dumps())
    for context in [*np.unique(codes >> 6)[::200].tolist(), 17, (5 << 12) | 63]:  # seen and unseen ones
        p = 2.0 ** model.log2(context << 6 | np.arange(64)).astype(float)
        assert abs(p.sum() - 1) < 1e-3


def test_symbols_keep_the_whole_text():
    """Texts are read again from their symbols; what differs in case, digits, signs, spaces or accents differs in its n-grams."""
    alike = ["Ab 12", "ab 12", "AB 12", "ab 13", "ab  12", "ab\t12", "ab\n12", "ab(12", "ab[12", "ab_12", "é", "á", "É", "ж", "語", "誠", "😀", "\x00\x7f", "Ñandú — ¿qué?", "~^`{|}<>#@$%&*+=\\"]
    code, counts = perplexity.ngrams(perplexity.Texts(pa.array(alike)))
    codes = np.split(code, np.cumsum(counts)[:-1])
    assert len({tuple(c.tolist()) for c in codes}) == len(alike)
    single = perplexity._SINGLE + perplexity._LEADS
    for text, found in zip(alike, codes, strict=True):
        symbols, raw, left = (found & 63).tolist(), bytearray(), 0
        while symbols:
            s = symbols.pop(0)
            if left:
                raw.append(128 | s)
                left -= 1
                continue
            raw.append(single[s] if s < len(single) else single[symbols.pop(0)] - 32 if s == len(single) else {1: 0, 2: 64, 3: 192}[s - len(single)] | symbols.pop(0))
            left = 0 if raw[-1] < 0xC0 else 1 if raw[-1] < 0xE0 else 2 if raw[-1] < 0xF0 else 3
        assert raw.decode() == text
    rest, _ = perplexity.ngrams(perplexity.Texts(pa.array([None, "", "ab"])))
    assert _.tolist() == [0, 0, 2] and (rest[1] >> 12) == rest[0] >> 6 & 0x3FFFF


def test_perplexity_sees_case_and_signs(spark):
    rnd = random.Random(3)
    clean = [_sentence(rnd, 120) for _ in range(60)]
    mixed = "".join(c.upper() if rnd.random() < 0.5 else c for c in clean[0].replace(" ", "  "))
    docs = spark.createDataFrame([(d, t, "en") for d, t in enumerate([*clean, mixed])], "doc_id bigint, text string, lang string")
    found = {r["doc_id"]: r for r in perplexity.judge(docs).collect()}
    assert all(found[d]["kept"] for d in range(60))
    assert found[60]["perplexity"] > 1.1 * max(found[d]["perplexity"] for d in range(60))  # the same n-grams as the first text's, were case and spaces folded


def test_repeated_words_at_block_size():
    ids = np.array([1, 2, 3, 1, 2, 3, 9, 1, 2, 3, 1, 2])
    doc = np.array([0] * 6 + [1] * 6)
    assert perplexity.repeated_words(ids, doc, 3, 2).tolist() == [6, 0]


def test_rule_ensemble(spark):
    rnd = random.Random(6)
    rows, labels = [], []
    for d in range(600):
        good = rnd.random() < 0.7
        words = _sentence(rnd, rnd.randrange(5, 60))
        rows.append((d, words if good else words.replace(" ", " | ")))
        labels.append((d, int(good) if d % 11 else None, 0))
    rows = odd(rows + [(700, None), (701, "")])
    stats = rules.statistics(frame(spark, rows))
    out = langid.held_out("doc_id", 3, 1)
    model = rules.fit(stats, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").where(~out))
    table = rules.score(stats, model).toPandas()
    features = stats.toPandas()
    want = model.scores(features[model.features].to_numpy(float))
    joined = table.sort_values(["score"])["score"].to_numpy()
    assert len(table) == len(rows) and np.allclose(joined, np.sort(want)) and table["score"].between(0, 1).all()
    truth = {d: y for d, y, _ in labels if y is not None}
    right = [(p == truth[d]) for d, p in zip(table["doc_id"], table["predicted"], strict=True) if d in truth]
    assert np.mean(right) > 0.97 and 0 < len(model.rules) < 200
    none = rules.fit(stats, spark.createDataFrame([], "doc_id bigint, quality int"))
    assert set(rules.score(stats, none).toPandas()["score"]) == {0.5}


_TEXTS = [
    None, "", " ", "  a", "a  b", "     a      b", "\n\t z ", "▁x▁▁ y", "中文 字 \x00 \U0001f600 é", "a" * 700, "<s></s><unk><0x41>",
    "Hello wörld, the the the", " " * 40 + "x" + " " * 17,
]


def test_sentencepiece_matches_the_library(spark):
    rnd = random.Random(1)
    texts = _TEXTS + ["".join(rnd.choice("  abcdeéthing\n中▁.,!-") for _ in range(rnd.randrange(60))) for _ in range(300)] + [t for _, t in sample()]
    library = spm.SentencePieceProcessor(model_file=sp.MODEL)
    docs = spark.createDataFrame([(i, t, "e") for i, t in enumerate(texts)], "doc_id bigint, text string, extra string")
    got = {r["doc_id"]: r for r in sp.decode(sp.encode(docs)).collect()}
    for i, t in enumerate(texts):
        assert got[i]["ids"] == (None if t is None else library.encode(t)), t
        assert got[i]["decoded"] == (None if t is None else library.decode(library.encode(t)))
        if t is not None and "▁" not in t:
            assert got[i]["decoded"] == t


def test_unigram_model_by_viterbi():
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    proto.ParseFromString(sp.load(sp.MODEL))
    proto.trainer_spec.model_type = 1
    for i, piece in enumerate(proto.pieces):  # scores without ties, in the range of a unigram model
        if piece.type == pb.ModelProto.SentencePiece.NORMAL:
            piece.score = -1.0 - (i * 7919 % 31991) / 3199.1 - 2.0 / len(piece.piece)
    model = proto.SerializeToString()
    library = spm.SentencePieceProcessor(model_proto=model)
    texts = [t for _, t in sample() if t and "\n" not in t][:30] + ["hello wonderful world", "  two  spaces "]
    score = lambda ids: sum(library.get_score(k) for k in ids)
    for t, ids in zip(texts, sp.Encoder(model).encode(pa.array(texts)).to_pylist(), strict=True):
        assert library.decode(ids) == t
        assert score(ids) >= score(library.encode(t)) - 1e-3


def test_empty_tables(spark):
    docs = frame(spark, sample()).where("false")
    assert repeats.remove_repeats(docs).count() == 0
    assert dedup_lines(docs).count() == 0
    assert near_duplicates(docs).count() == 0
    assert contaminated(docs, spark.createDataFrame([(1, "a b c d e f")], "item_id bigint, text string")).count() == 0
    assert contaminated(frame(spark, sample()), spark.createDataFrame([], "item_id bigint, text string")).count() == 0
    assert licenses.scan(docs).count() == 0
    assert langid.predict(docs, None).count() == 0
    assert perplexity.judge(docs).count() == 0
    assert rules.score(rules.statistics(docs), rules.Ensemble([], [], [], 0.0)).count() == 0
    assert sp.decode(sp.encode(docs)).count() == 0


def test_empty_archive(spark, tmp_path):
    warc.write_archives(spark.createDataFrame([], "page_id bigint, url string, html string"), str(tmp_path / "a"))
    index = warc.normalise(spark, str(tmp_path / "a"), str(tmp_path / "b"))
    assert warc.read_records(index).count() == 0


def test_damaged_archive(tmp_path):
    import gzip

    data = gzip.compress(b"WARC/1.1\r\nContent-Length: 5\r\n\r\nabc")
    with pytest.raises(ValueError, match="ends within"):
        list(warc.stream_records([gzip.decompress(data)]))
    path = tmp_path / "cut.gz"
    path.write_bytes(data[:-6])
    with pytest.raises(ValueError, match="cut off"), path.open("rb") as stream:
        list(warc.inflated(stream))




def collision(spark):
    """Two texts of lines that share Spark's 32-bit hash."""
    from pyspark.sql import functions as F

    texts = spark.range(300_000).select(F.concat(F.lit("a line that is number "), "id").alias("t"))
    pair = texts.groupBy(F.hash("t").alias("h")).agg(F.min("t").alias("a"), F.max("t").alias("b")).where("a <> b").first()
    return pair["a"], pair["b"]


def test_rows_without_an_id_are_told_apart(spark):
    """Row keys hold more than a short hash: nothing of another row is deleted."""
    a, b = collision(spark)
    rows = [(None, a), (None, b), (1, a), (2, "something else that stays")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", "kept_text").collect()
    assert plain(got) == plain(brute.line_dedup(rows)) and (None, 1, 0, b) in plain(got)
    near = near_duplicates(docs, words=2).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert plain(near) == plain(brute.near_duplicates(rows, 2))
    long = [(None, a * 30), (None, b * 30), (1, a * 30)]
    gone = repeats.remove_repeats(spark.createDataFrame(long, "doc_id bigint, text string"))
    assert plain(gone.collect()) == plain(brute.repeats(long, 200))
    items = spark.createDataFrame([(5, f"{a} and more words than five")], "item_id bigint, text string")
    found = contaminated(spark.createDataFrame([(None, f"{a} and more words than five"), (None, b)], "doc_id bigint, text string"), items)
    assert found.count() == 1


def test_foreign_texts_are_rejected(spark):
    """Languages, scripts, code and noise that were never learned; a softmax alone is sure of them."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs.where(~langid.held_out()))
    rnd = random.Random(3)
    foreign = [
        "Praha je hlavní a současně největší město České republiky a patnácté největší město Evropské unie.",
        "Budapest Magyarország fővárosa és legnépesebb városa, az Európai Unió kilencedik legnépesebb városa.",
        "Москва является столицей России и самым населённым городом страны.",
        "北京是中华人民共和国的首都，是全国的政治中心、文化中心和国际交往中心。",
        "def f(x):\n    return [y for y in range(x) if y % 2 == 0]\n\nclass A(B):\n    def __init__(self, q=None):\n        self.q = q or {}\n",
        " ".join("".join(rnd.choice("bcdfghjklmnpqrstvwxz") for _ in range(7)) for _ in range(40)),
    ]
    table = spark.createDataFrame(list(enumerate(foreign)), "doc_id bigint, text string")
    assert [r["accepted"] for r in langid.predict(table, model).collect()] == [False] * len(foreign)
    held = langid.predict(docs.where(langid.held_out()), model)
    assert held.where("accepted").count() >= 0.99 * held.count()


def test_sample_is_bounded_without_ids(spark):
    """Equal rows count once, rows without an id are chosen by their texts."""
    rows = [(None, f"words of text number {i % 400} in one language", "xx") for i in range(3000)]
    rows += [(None, "the same words again and again", "xx")] * 500
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.fit(docs, per_language=600)
    assert model.languages == ["xx"] and langid.predict(docs, model).where("lang_pred <> 'xx'").count() == 0


def test_repeats_of_frequent_words_stay_known(spark, monkeypatch):
    """Both generations of the word memory turn over within a task; ids stay the library's."""
    monkeypatch.setattr(sp, "REMEMBERED", 50)
    encoder, library = sp.Encoder(sp.load(sp.MODEL)), spm.SentencePieceProcessor(model_file=sp.MODEL)
    rnd = random.Random(2)
    for _ in range(12):
        texts = [_sentence(rnd, 30) + " " + "".join(rnd.choice("abcdefgh éü") for _ in range(30)) for _ in range(4)]
        assert encoder.encode(pa.array(texts)).to_pylist() == [library.encode(t) for t in texts]


def test_round_trip_is_encode_and_decode(spark):
    rows = odd(sample())
    docs = frame(spark, rows)
    a = sp.round_trip(docs).select("doc_id", "text", "ids", "decoded").collect()
    b = sp.decode(sp.encode(docs)).select("doc_id", "text", "ids", "decoded").collect()
    assert plain(a) == plain(b)
