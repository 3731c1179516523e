"""Licence scan by sentence rules, with built-in functions only."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Identifier -> known sentence of a licence text or notice, normalised to lower-case letters and digits with single blanks.
SENTENCES = {
    "mit.name": "the mit license",
    "mit.title": "mit license",
    "mit.short": "mit licensed",
    "mit.notice": "released under the mit license",
    "mit.notice2": "licensed under the mit license",
    "mit.notice3": "this project is licensed under the mit license",
    "mit.grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit.keep": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit.asis": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit.liability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "apache2.title": "apache license version 2 0 january 2004",
    "apache2.notice": "licensed under the apache license version 2 0",
    "apache2.notice2": "licensed under the apache license version 2 0 the license",
    "apache2.may": "you may not use this file except in compliance with the license",
    "apache2.copy": "you may obtain a copy of the license at",
    "apache2.asis": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache2.see": "see the license for the specific language governing permissions and limitations under the license",
    "gpl3.notice": "this work is licensed under the gnu general public license version 3",
    "gpl3.notice2": "licensed under the gnu general public license version 3",
    "gpl2.notice": "licensed under the gnu general public license version 2",
    "gpl2.title": "gnu general public license version 2 june 1991",
    "gpl3.title": "gnu general public license version 3 29 june 2007",
    "agpl3.title": "gnu affero general public license version 3 19 november 2007",
    "lgpl21.title": "gnu lesser general public license version 2 1 february 1999",
    "lgpl3.title": "gnu lesser general public license version 3 29 june 2007",
    "gpl.only2": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation",
    "agpl.free": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "agpl.details": "see the gnu affero general public license for more details",
    "gpl.free2": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl.free3": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl.hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl.details": "see the gnu general public license for more details",
    "lgpl.free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "lgpl.hope": "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "lgpl.details": "see the gnu lesser general public license for more details",
    "bsd.permit": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd.source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd.binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd.endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "isc.permit": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "zlib.asis": "this software is provided as is without any express or implied warranty",
    "zlib.liable": "in no event will the authors be held liable for any damages arising from the use of this software",
    "zlib.grant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "bsl.title": "boost software license version 1 0 august 17th 2003",
    "bsl.notice": "distributed under the boost software license version 1 0",
    "epl2.notice": "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0",
    "mpl2.title": "mozilla public license version 2 0",
    "mpl2.form": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "mpl2.obtain": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    "unlicense.free": "this is free and unencumbered software released into the public domain",
    "ccbync4.notice": "licensed under cc by nc 4 0",
    "ccby4.notice": "licensed under cc by 4 0",
    "ccbysa4.notice": "licensed under cc by sa 4 0",
    "cc0.notice": "licensed under cc0 1 0",
    "ccby4.long": "this work is licensed under a creative commons attribution 4 0 international license",
    "ccbysa4.long": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "ccbync4.long": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
}
# Fixed values: (rule, licence, identifiers in the order in which a text must hold them, nothing known between).
RULES = (
    ("mit-full", "MIT", ("mit.grant", "mit.keep", "mit.asis", "mit.liability")),
    ("mit-name", "MIT", ("mit.name",)),
    ("mit-title", "MIT", ("mit.title",)),
    ("mit-short", "MIT", ("mit.short",)),
    ("mit-notice", "MIT", ("mit.notice",)),
    ("mit-notice2", "MIT", ("mit.notice2",)),
    ("mit-notice3", "MIT", ("mit.notice3",)),
    ("apache2-header", "Apache-2.0", ("apache2.notice2", "apache2.may", "apache2.copy")),
    ("apache2-text", "Apache-2.0", ("apache2.title",)),
    ("apache2-notice", "Apache-2.0", ("apache2.notice",)),
    ("apache2-notice2", "Apache-2.0", ("apache2.notice2",)),
    ("gpl3-notice", "GPL-3.0-only", ("gpl3.notice",)),
    ("gpl3-notice2", "GPL-3.0-only", ("gpl3.notice2",)),
    ("gpl2-notice", "GPL-2.0-only", ("gpl2.notice",)),
    ("gpl2-text", "GPL-2.0-only", ("gpl2.title",)),
    ("gpl3-text", "GPL-3.0-only", ("gpl3.title",)),
    ("agpl3-text", "AGPL-3.0-only", ("agpl3.title",)),
    ("lgpl21-text", "LGPL-2.1-only", ("lgpl21.title",)),
    ("lgpl3-text", "LGPL-3.0-only", ("lgpl3.title",)),
    ("gpl2-only-header", "GPL-2.0-only", ("gpl.only2",)),
    ("agpl3-header", "AGPL-3.0-or-later", ("agpl.free", "gpl.hope", "agpl.details")),
    ("gpl2-header", "GPL-2.0-or-later", ("gpl.free2", "gpl.hope", "gpl.details")),
    ("gpl3-header", "GPL-3.0-or-later", ("gpl.free3", "gpl.hope", "gpl.details")),
    ("lgpl21-header", "LGPL-2.1-or-later", ("lgpl.free", "lgpl.hope", "lgpl.details")),
    ("bsd3", "BSD-3-Clause", ("bsd.permit", "bsd.source", "bsd.binary", "bsd.endorse")),
    ("bsd2", "BSD-2-Clause", ("bsd.permit", "bsd.source", "bsd.binary")),
    ("isc", "ISC", ("isc.permit",)),
    ("zlib", "Zlib", ("zlib.asis", "zlib.liable", "zlib.grant")),
    ("bsl1-text", "BSL-1.0", ("bsl.title",)),
    ("bsl1-notice", "BSL-1.0", ("bsl.notice",)),
    ("epl2", "EPL-2.0", ("epl2.notice",)),
    ("mpl2-text", "MPL-2.0", ("mpl2.title",)),
    ("mpl2", "MPL-2.0", ("mpl2.form", "mpl2.obtain")),
    ("unlicense", "Unlicense", ("unlicense.free",)),
    ("cc-by-nc-4", "CC-BY-NC-4.0", ("ccbync4.notice",)),
    ("cc-by-nc-4-long", "CC-BY-NC-4.0", ("ccbync4.long",)),
    ("cc-by-4", "CC-BY-4.0", ("ccby4.notice",)),
    ("cc-by-4-long", "CC-BY-4.0", ("ccby4.long",)),
    ("cc-by-sa-4", "CC-BY-SA-4.0", ("ccbysa4.notice",)),
    ("cc-by-sa-4-long", "CC-BY-SA-4.0", ("ccbysa4.long",)),
    ("cc0", "CC0-1.0", ("cc0.notice",)),
)
#: Licence tags: the licence's name in lower-case letters and digits -> its identifier. Tags have rules of their own.
TAGS = {" ".join(re.findall("[a-z0-9]+", name.lower())).replace(" or later", " orlater"): f"spdx.{name}" for _, name, _ in RULES}
ALL_RULES = RULES + tuple((f"spdx-{key[5:].lower()}", key[5:], (key,)) for key in dict.fromkeys(TAGS.values()))
TAG = "spdx license identifier"
#: Characters of a marked text: where a sentence ends, and where a line or a clause does.
_END, _SOFT = "\x01", "\x02"
#: Steps to a marked text, each a pattern and what replaces it (groups as $1): line ends of one kind; stops after v that belong to it; stops before white space; lines without letters or digits;
#: line ends and ; or : before white space; all else but letters and digits.
STEPS = (
    (r"[\x01\x02]", " "),
    (r"\r\n?", "\n"),
    (r"(^|[^A-Za-z0-9])([vV])[.]", "$1$2 "),
    (r"[.!?]+([ \t\n]+|$)", _END),
    (r"\n([^A-Za-z0-9\x01\n]*\n)+", _END),
    (r"\n+|[;:]+[ \t]+", _SOFT),
    (r"[^A-Za-z0-9\x01\x02]+", " "),
)
#: What may come before a notice in its sentence.
LEAD = r"^(this|these|the) (.* )?(is|are) ((licensed|released) under .*)$"
LED = " (is|are) (licensed|released) under "
#: Lines over which a known sentence goes at most: a word a line.
LINES = max(len(v.split(" ")) for v in SENTENCES.values())


def beginnings() -> list[str]:
    """First words of known sentences, up to the whole sentence, in order."""
    return sorted({" ".join(words[:k]) for v in SENTENCES.values() for words in [v.split(" ")] for k in range(1, len(words) + 1)})


def _hits(sequence: str, what: int) -> list[str]:
    """SQL for each rule's name or licence where its identifiers follow each other, else null. A rule whose sequence
    begins a longer rule that also matches gives way to it."""
    out = []
    for rule in ALL_RULES:
        has = f"{sequence} like '%|{'|'.join(rule[2])}|%'"
        for other in ALL_RULES:
            if other is not rule and other[2][: len(rule[2])] == rule[2]:
                has += f" and {sequence} not like '%|{'|'.join(other[2])}|%'"
        out.append(f"case when {has} then '{rule[what]}' end")
    return out


def _lookup(pairs: dict[str, str]):
    table = F.create_map(*[F.lit(x) for key, value in pairs.items() for x in (key, value)])
    return lambda key: F.try_element_at(table, key)


def _identifiers(sentences: Column) -> Column:
    """Identifiers that sentences (each the parts between its soft marks) hold, in order.

    A known sentence is looked up as a run of whole parts, joined by blanks: the whole sentence or some of its lines. Runs are tried only
    from parts that begin a known sentence, that begin with a notice's lead where the sentence has one, or that are a licence tag; the longest known
    run from a part counts, and none that lies within another. Each step makes an array for the next one, so nothing is computed anew for each part."""
    known = _lookup({v: k for k, v in SENTENCES.items()})
    tagged = _lookup(TAGS)
    run = lambda s, i, n: F.array_join(F.slice(s["p"], i, n), " ")
    name = lambda text: F.coalesce(known(text), known(F.regexp_replace(text, LEAD, "$4")))
    places = lambda p: F.sequence(F.lit(1), F.size(p))
    first = lambda s, i: F.element_at(s["p"], i)
    begins = lambda x: x.isin(beginnings())
    led = F.transform(sentences, lambda p: F.struct(p.alias("p"), F.array_join(p, " ").rlike(LED).alias("led")))
    some = F.filter(led, lambda s: s["led"] | F.exists(s["p"], lambda x: begins(x) | x.startswith(TAG)))
    starts = lambda s: F.filter(places(s["p"]), lambda i: begins(first(s, i)) | (s["led"] & first(s, i).rlike("^(this|these|the) ")))
    tags = lambda s: F.filter(places(s["p"]), lambda i: first(s, i).startswith(TAG))
    begun = F.transform(some, lambda s: F.struct(s["p"].alias("p"), starts(s).alias("starts"), tags(s).alias("tags")))
    lengths = lambda s, i: F.sequence(F.lit(1), F.least(F.lit(LINES), F.size(s["p"]) - i + 1))
    longest = lambda s, i: F.array_max(F.filter(lengths(s, i), lambda n: name(run(s, i, n)).isNotNull()))
    runs = lambda s: F.filter(F.transform(s["starts"], lambda i: F.struct(i.alias("i"), longest(s, i).alias("n"))), lambda r: r["n"].isNotNull())
    tried = F.transform(begun, lambda s: F.struct(s["p"].alias("p"), runs(s).alias("runs"), s["tags"].alias("tags")))
    apart = lambda s: F.filter(s["runs"], lambda r: ~F.exists(s["runs"], lambda o: (o["i"] < r["i"]) & (o["i"] + o["n"] >= r["i"] + r["n"])))
    named = lambda s: F.transform(apart(s), lambda r: F.struct(r["i"].alias("i"), F.array(name(run(s, r["i"], r["n"]))).alias("ids")))
    listed = lambda s, i: F.regexp_replace(F.when(first(s, i) == TAG, run(s, i, F.lit(2))).otherwise(first(s, i)), f"^{TAG} ?", "")
    ids = lambda s, i: F.filter(F.transform(F.split(F.replace(listed(s, i), F.lit(" or later"), F.lit(" orlater")), " (or|and|with) "), lambda x: tagged(x)), lambda x: x.isNotNull())
    both = lambda s: F.array_sort(F.concat(named(s), F.transform(s["tags"], lambda i: F.struct(i.alias("i"), ids(s, i).alias("ids")))))
    return F.flatten(F.transform(tried, lambda s: F.flatten(F.transform(both(s), lambda r: r["ids"]))))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> doc_id, n_sentences, n_known, sentence_ids ('|' between), rules and licenses (',' between, in rule order,
    a licence once), for every row and whole text.

    A text is cut into sentences at stops before white space and at lines without letters or digits, so single line ends, with comment signs beside
    them, do not end one; a sentence is lower-case ASCII letters and digits. Sentences, and runs of whole lines or clauses of one, are looked up in SENTENCES, notices also
    after "this ... is" and the like; licence tags name licences joined by or, and, with. The sequence of known identifiers, others skipped, is matched
    against ALL_RULES. n_sentences counts sentences with letters or digits, n_known identifiers found. Licence lines keep their sense in the middle of other text.
    Null and empty texts have no sentences; repeated rows and null ids repeat. Other columns are not read. Only built-in
    functions run, and nothing is shuffled. No table lookup joins: the known sentences are literals of fixed number.
    """
    text = F.coalesce("text", F.lit(""))
    for pattern, by in STEPS:
        text = F.regexp_replace(text, pattern, by)
    sentences = F.filter(F.split(F.lower(text), _END), lambda s: s.rlike("[a-z0-9]"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), sentences.alias("s"))
    parts = lambda s: F.filter(F.transform(F.split(s, _SOFT), lambda p: F.trim(p)), lambda p: p != "")
    rows = rows.select("doc_id", F.size("s").cast("long").alias("n_sentences"), _identifiers(F.transform("s", parts)).alias("k"))
    rows = rows.select("doc_id", "n_sentences", F.size("k").cast("long").alias("n_known"), F.array_join("k", "|").alias("sentence_ids"))
    sequence = "concat('|', sentence_ids, '|')"
    return rows.select(
        "*",
        F.expr(f"concat_ws(',', {', '.join(_hits(sequence, 0))})").alias("rules"),
        F.expr(f"array_join(array_distinct(array_compact(array({', '.join(_hits(sequence, 1))}))), ',')").alias("licenses"),
    )


def _once() -> list[str]:
    """Each licence once, at its first rule that holds."""
    sequence = "concat('|', sentence_ids, '|')"
    hits = _hits(sequence, 1)
    out = []
    for k, (case, rule) in enumerate(zip(hits, ALL_RULES)):
        earlier = [hits[i].removeprefix("case when ").partition(" then ")[0] for i in range(k) if ALL_RULES[i][1] == rule[1]]
        before = "".join(f" and not ({e})" for e in earlier)
        out.append(case.replace(" then ", f"{before} then "))
    return out


def oracle() -> str:
    """The same in DuckDB SQL, with a row per sentence, part and run."""
    values = lambda pairs: ", ".join(f"('{a}', '{b}')" for a, b in pairs)
    marked = "coalesce(text, '')"
    for pattern, by in STEPS:
        plain = {"\n": "chr(10)", _END: "chr(1)", _SOFT: "chr(2)"}
        marked = f"regexp_replace({marked}, '{pattern}', {plain.get(by) or repr(by.replace('$', chr(92))).replace(chr(92) * 2, chr(92))}, 'g')"
    firsts = ", ".join(f"('{b}')" for b in beginnings())
    sequence = "concat('|', sentence_ids, '|')"
    return rf"""
with known(sentence, id) as (values {values((v, k) for k, v in SENTENCES.items())}),
tags(tag, id) as (values {values(TAGS.items())}),
firsts(part) as (values {firsts}),
d as (select row_number() over () as r, doc_id, lower({marked}) as t from documents),
cut as (select r, doc_id, list_filter(string_split(t, chr(1)), lambda s: regexp_matches(s, '[a-z0-9]')) as ss from d),
s as (select r, unnest(ss) as s, generate_subscripts(ss, 1) as k from cut),
p as (select r, k, list_filter(list_transform(string_split(s, chr(2)), lambda x: trim(x)), lambda x: x <> '') as ps from s),
each as (select r, k, ps, array_to_string(ps, ' ') as whole, unnest(ps) as part, generate_subscripts(ps, 1) as i from p),
starts as (select * from each where part in (select part from firsts) or regexp_matches(whole, '{LED}') and regexp_matches(part, '^(this|these|the) ')),
tried as (select r, k, i, ps, unnest(range(1, least({LINES}, len(ps) - i + 1) + 1)) as n from starts),
runs as (select r, k, i, n, array_to_string(list_slice(ps, i, i + n - 1), ' ') as run from tried),
named as (
  select x.r, x.k, x.i, x.n, coalesce(a.id, b.id) as id from runs x left join known a on a.sentence = run left join known b on b.sentence = regexp_replace(run, '{LEAD}', '\4')
  where a.id is not null or b.id is not null),
longest as (select * from named qualify row_number() over (partition by r, k, i order by n desc) = 1),
apart as (select * from longest x where not exists (select 1 from longest o where o.r = x.r and o.k = x.k and o.i < x.i and o.i + o.n >= x.i + x.n)),
tagged as (select r, k, i, regexp_replace(case when part = '{TAG}' then array_to_string(list_slice(ps, i, i + 1), ' ') else part end, '^{TAG} ?', '') as t from each where starts_with(part, '{TAG}')),
listed as (select r, k, i, unnest(x) as tag, generate_subscripts(x, 1) as j from (select *, regexp_split_to_array(replace(t, ' or later', ' orlater'), ' (or|and|with) ') as x from tagged)),
found as (select r, k, i, 0 as j, id from apart union all select r, k, i, j, id from listed join tags using (tag)),
q as (
  select doc_id, cast(len(ss) as bigint) as n_sentences, coalesce(n, 0) as n_known, coalesce(ids, '') as sentence_ids
  from cut left join (select r, count(*) as n, string_agg(id, '|' order by k, i, j) as ids from found group by 1) using (r))
select *, concat_ws(',', {', '.join(_hits(sequence, 0))}) as rules, concat_ws(',', {', '.join(_once())}) as licenses
from q
"""
