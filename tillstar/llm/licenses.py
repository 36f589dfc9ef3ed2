"""Licence scan by sentence rules.

Every text is cut into parts, which are normalised (lower case, runs of other than a-z and 0-9 as one
space). A known licence sentence is a hit where it is one part or several successive ones: a single line break, a
colon and a semicolon may stand inside it, so hard-wrapped texts (with comment signs as well) and SPDX tags are
found; a stop and a blank line may not. Of the sentences that start at a part the longest counts.
A sentence may have a variable part, such as the
holder's name. A document's hits, in text order, form a sequence of identifiers, and ordered rules are
matched against it, each once: a rule is a sequence of identifiers that may stand ``GAP`` hits apart. What a rule
names is gone for the rules after it, what stands in its gaps is not; so complete licence texts come before
their parts and short notices, and a licence inside another one is still found.

Sentences, variable sentences and rules are arguments; the SQL twin reads the same tables.

Defined cases: null and empty texts have no hits; a sentence that occurs n times counts n times; rows are
documents; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import row_keyed

GAP = 2
#: Characters of a sentence's variable part.
NAME = 120

#: Known sentences, normalised, by identifier.
SENTENCES = {
    "a": "licensed under the apache license version 2 0",
    "b": "you may not use this file except in compliance with the license",
    "c": "you may obtain a copy of the license at",
    "d": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "e": "see the license for the specific language governing permissions and limitations under the license",
    "f": "released under the mit license",
    "g": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "h": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "i": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "j": "this work is licensed under the gnu general public license version 3",
    "k": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "l": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "m": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "n": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "o": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "p": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "q": "licensed under cc by nc 4 0",
    "r": "this work is licensed under a creative commons attribution 4 0 international license",
    "s": "this is free and unencumbered software released into the public domain",
    "t": "spdx license identifier mit",
    "u": "spdx license identifier apache 2 0",
    "v": "spdx license identifier gpl 3 0 or later",
    "w": "all rights reserved",
    "x": "licensed under the apache license version 2 0 the license",
}

#: Ordered rules: licence and its identifiers in order.
RULES = (
    ("Apache-2.0", "xbcde"), ("Apache-2.0", "xbcd"), ("MIT", "ghi"), ("MIT", "gh"), ("BSD-3-Clause", "mnop"), ("BSD-2-Clause", "mno"),
    ("GPL-3.0-or-later", "kl"), ("GPL-3.0-or-later", "k"), ("GPL-3.0", "j"), ("Apache-2.0", "x"), ("Apache-2.0", "a"),
    ("MIT", "f"), ("CC-BY-NC-4.0", "q"), ("CC-BY-4.0", "r"), ("Unlicense", "s"), ("MIT", "t"), ("Apache-2.0", "u"),
    ("GPL-3.0-or-later", "v"), ("all rights reserved", "w"),
)


_GNU = "is free software you can redistribute it and or modify it under the terms of the gnu"
_FSF = "general public license as published by the free software foundation"
_LATER = "of the license or at your option any later version"
_SPDX = (
    "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later",
    "AGPL-3.0-only", "AGPL-3.0-or-later", "MPL-2.0", "ISC", "0BSD", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "BSD-2-Clause", "BSD-3-Clause",
    "Unlicense",
)
#: Further sentences of common licences as published, with the licence they stand for; "" for none by themselves.
_PUBLISHED = (
    ("GPL-2.0-or-later", f"this program {_GNU} {_FSF} either version 2 {_LATER}"),
    ("GPL-2.0-only", f"this program {_GNU} general public license version 2 as published by the free software foundation"),
    ("GPL-2.0-only", f"this program {_GNU} {_FSF} version 2 of the license"),
    ("LGPL-2.1-or-later", f"this library {_GNU} lesser {_FSF} either version 2 1 {_LATER}"),
    ("LGPL-3.0-or-later", f"this program {_GNU} lesser {_FSF} either version 3 {_LATER}"),
    ("LGPL-3.0-or-later", f"this library {_GNU} lesser {_FSF} either version 3 {_LATER}"),
    ("AGPL-3.0-or-later", f"this program {_GNU} affero {_FSF} either version 3 {_LATER}"),
    ("", "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    # The published text has "v. 2.0": its stop ends the sentence.
    ("MPL-2.0", "this source code form is subject to the terms of the mozilla public license v"),
    ("MPL-2.0", "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0"),
    ("MPL-2.0", "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0"),
    ("ISC", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("ISC", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("", "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"),
    ("0BSD", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("CC0-1.0", "to the extent possible under law the author s have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide"),
    ("CC0-1.0", "cc0 1 0 universal"),
    ("CC-BY-SA-4.0", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("CC-BY-SA-4.0", "this work is licensed under cc by sa 4 0"),
    ("CC-BY-4.0", "this work is licensed under cc by 4 0"),
)
_NAMED = (*_PUBLISHED, *((name, "spdx license identifier " + name.lower().replace("-", " ").replace(".", " ")) for name in _SPDX))
MORE = dict(zip("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789yz", _NAMED, strict=True))
#: Their rules: texts of several sentences first, then each sentence alone.
MORE_RULES = (
    ("GPL-2.0-or-later", "Al"), ("GPL-2.0-only", "Bl"), ("GPL-2.0-only", "Cl"), ("LGPL-2.1-or-later", "DH"), ("LGPL-3.0-or-later", "El"),
    ("LGPL-3.0-or-later", "FH"), ("AGPL-3.0-or-later", "Gl"), ("MPL-2.0", "IJ"), ("MPL-2.0", "IK"), ("ISC", "LN"), ("ISC", "MN"), ("0BSD", "ON"),
    *((name, k) for k, (name, _) in MORE.items() if name),
)

#: All sentences and rules.
KNOWN = SENTENCES | {k: v for k, (_, v) in MORE.items()}
ALL_RULES = (*RULES, *MORE_RULES)
#: Sentences with a variable part between a beginning and an end; they count under the identifier of the usual wording.
VARIABLE = (
    ("p", "neither the name of", "nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("p", "neither the name of", "nor the names of contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("p", "the name of", "may not be used to endorse or promote products derived from this software without specific prior written permission"),
)

#: Texts without any of these parts of words hold no known sentence and are not searched.
CUE = "licens|permission|redistribut|software|rights|merchantability|mozilla|universal"

_BLANK = r"[\x20\x09-\x0D]"
#: Sentence ends: stops (a blank line) and signs that may stand inside a known sentence (one break).
_STOP, _WITHIN = rf"[.!?:;]*[.!?][.!?:;]*({_BLANK}+|$)", rf"[:;]+({_BLANK}+|$)"

Known = Mapping[str, str]
Rules = Sequence[tuple[str, str]]
Variable = Sequence[tuple[str, str, str]]


def pattern(identifiers: str) -> str:
    """A rule as a pattern over identifiers; its groups are the hits in its gaps."""
    return f"(.{{0,{GAP}}}?)".join(identifiers)


def whole_sentences(known: Known, variable: Variable) -> str:
    """One pattern for every known sentence, the longest first, over normalised lines."""
    spaced = lambda v: v.replace(" ", r"[ \n]")
    fixed = [spaced(v) for v in sorted(known.values(), key=len, reverse=True)]
    named = [spaced(f"{head} ") + rf"[a-z0-9 \n]{{1,{NAME}}}?" + spaced(f" {tail}") for _, head, tail in variable]
    return "(?m)^(" + "|".join([*fixed, *named]) + ")$"


def normalised(text: Column) -> Column:
    """The normalised parts of a text as lines; an empty line where a known sentence cannot go on."""
    # Possessive, so that a long run of signs is tried once.
    stop, within = rf"(?<![.!?:;])[.!?:;]++({_BLANK}++|$)", rf"(?<![.!?:;])[:;]++({_BLANK}++|$)"
    lines = F.regexp_replace(F.regexp_replace(F.lower(text), within, "\n"), stop, "\n\n")
    return F.btrim(F.regexp_replace(F.regexp_replace(lines, r"[^a-z0-9\n]+", " "), r" ?\n ?", "\n"))


def scan(docs: DataFrame, known: Known = KNOWN, rules: Rules = ALL_RULES, variable: Variable = VARIABLE) -> DataFrame:
    """``doc_id, th, n_hits, identifiers, licenses``, a row for each input row: the hits in order, and each
    licence with its number of matches, in rule order."""
    if any(len(k) != 1 for k in known):
        raise ValueError("identifiers are single characters")
    ids = F.create_map(*(F.lit(x) for k, v in known.items() for x in (v, k)))

    def identifier(hit: Column) -> Column:
        sentence = F.translate(hit, "\n", " ")
        named = [F.when(sentence.rlike(f"^{head} .* {tail}$"), F.lit(k)) for k, head, tail in variable]
        return F.coalesce(ids[sentence], *named)

    hits = F.transform(F.regexp_extract_all(normalised(F.col("text")), F.lit(whole_sentences(known, variable)), F.lit(0)), identifier)
    cue = all(re.search(CUE, v) for v in (*known.values(), *(t for _, _, t in variable)))
    identifiers = F.array_join(hits, "")
    identifiers = F.when(F.lower("text").rlike(CUE), identifiers) if cue else identifiers
    found = row_keyed(docs).select("doc_id", "th", F.coalesce(identifiers, F.lit("")).alias("identifiers"))
    left = "identifiers"
    # Rules of one identifier do not take from each other: successive ones are one step.
    for single, step in groupby(enumerate(rules), lambda r: len(r[1][1]) == 1):
        for these in [list(step)] if single else [[r] for r in step]:
            counts = {f"n{k}": F.regexp_count(left, F.lit(pattern(ids_))) for k, (_, ids_) in these}
            gone = "|".join(pattern(ids_) for _, (_, ids_) in these)
            gaps = "".join(f"${i}" for i in range(1, len(these[0][1][1])))
            found = found.withColumns({**counts, f"left{these[0][0]}": F.regexp_replace(left, gone, gaps)})
            left = f"left{these[0][0]}"
    parts = []
    for name in dict.fromkeys(name for name, _ in rules):
        total = sum((F.col(f"n{k}") for k, (n, _) in enumerate(rules) if n == name), F.lit(0))
        parts.append(F.when(total > 0, F.concat(F.lit(f"{name}:"), total.cast("string"))))
    return found.select("doc_id", "th", F.length("identifiers").cast("long").alias("n_hits"), "identifiers", F.concat_ws(";", *parts).alias("licenses"))


def twin(known: Known = KNOWN, rules: Rules = ALL_RULES, variable: Variable = VARIABLE) -> str:
    """The same in DuckDB SQL, from the same tables."""
    values = ", ".join(f"('{v}', '{k}')" for k, v in known.items())
    named = " ".join(f"WHEN regexp_full_match(sentence, '{head} .* {tail}') THEN '{k}'" for k, head, tail in variable)
    steps, left = [], "identifiers"
    for k, (_, ids_) in enumerate(rules):
        p, gaps = pattern(ids_), "".join(rf"\{i}" for i in range(1, len(ids_)))
        steps.append(f"s{k} AS (SELECT *, len(regexp_extract_all({left}, '{p}')) AS n{k}, regexp_replace({left}, '{p}', '{gaps}', 'g') AS left{k} FROM {f's{k - 1}' if k else 'found'})")
        left = f"left{k}"
    parts = []
    for name in dict.fromkeys(n for n, _ in rules):
        total = " + ".join(f"n{k}" for k, (n, _) in enumerate(rules) if n == name)
        parts.append(f"CASE WHEN {total} > 0 THEN '{name}:' || ({total}) END")
    return f"""
WITH known(sentence, id) AS (VALUES {values}),
ended AS (
  SELECT doc_id, regexp_replace(regexp_replace(lower(coalesce(text, '')), '{_STOP}', '\n\n', 'g'), '{_WITHIN}', '\n', 'g') AS t FROM documents),
normal AS (SELECT doc_id, trim(regexp_replace(regexp_replace(t, '[^a-z0-9\\n]+', ' ', 'g'), ' ?\\n ?', '\n', 'g')) AS t FROM ended),
hits AS (SELECT doc_id, regexp_extract_all(t, '{whole_sentences(known, variable)}') AS hs FROM normal),
placed AS (SELECT doc_id, replace(unnest(hs), '\n', ' ') AS sentence, generate_subscripts(hs, 1) AS pos FROM hits),
found AS (
  SELECT doc_id, string_agg(CASE WHEN id IS NOT NULL THEN id {named} END, '' ORDER BY pos) AS identifiers
  FROM placed LEFT JOIN known USING (sentence) GROUP BY doc_id),
{", ".join(steps)}
SELECT doc_id, coalesce(len(identifiers), 0) AS n_hits, coalesce(identifiers, '') AS identifiers,
  coalesce(concat_ws(';', {", ".join(parts)}), '') AS licenses
FROM documents LEFT JOIN s{len(rules) - 1} USING (doc_id)
"""
