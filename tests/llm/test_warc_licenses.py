import base64
import hashlib
import textwrap
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from duolog.llm import licenses, warc

PAGE = '<!DOCTYPE html><html lang="fr"><head><title>A &amp; B</title><style>p{}</style></head><body><!-- <a href="/no"> --><script>var t="</p><a href=\'/no\'>";</script><h1>Hi&nbsp;you</h1><p>one <b>two</b><br>three &#233;<a href="/x?a=1&amp;b=2">l</a><a href="/x?a=1&amp;b=2">l</a></p></body></html>'


def test_derivatives_link_to_their_response(spark):
    pages = spark.createDataFrame([(1, "http://e.org/d/", PAGE, 0), (None, None, None, 0), (2, "http://[bad", "<p>x" * 40000, 0)], "page_id long, url string, html string, content int")
    source = {r.page_id: r for r in warc.responses(pages).collect()}
    got = {(r.page_id, r.warc_type): r for r in warc.derivatives(warc.responses(pages)).collect()}
    assert len(got) == 6
    for (page, _), r in got.items():
        assert r.refers_to == source[page].record_id and r.target_uri == source[page].target_uri
        assert r.content_length == len(r.content.encode()) and r.block_digest == "sha1:" + base64.b32encode(hashlib.sha1(r.content.encode()).digest()).decode()
    meta, text = got[1, "metadata"], got[1, "conversion"]
    assert "title: A & B\r\nlanguage: fr\r\nsource-status: HTTP/1.1 200 OK\r\nsource-header-content-type: text/html; charset=utf-8\r\n" in meta.content
    assert meta.n_outlinks == 1 and "outlink: http://e.org/x?a=1&b=2\r\n" in meta.content
    assert text.source_payload_digest == warc.digest(PAGE.encode()) and text.content == "Hi you\none two\nthree él l".replace("l l", "ll")
    assert warc.derivatives(warc.responses(pages.limit(0))).count() == 0


def test_files_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(k, f"http://e.org/{k}", PAGE + "x\r\n\r\ny" * k) for k in range(5)], "page_id long, url string, html string")
    records = warc.derivatives(warc.responses(pages))
    warc.write_warc(records, str(tmp_path / "w"))
    back = warc.read_warc(spark, str(tmp_path / "w"))
    key = lambda df: sorted(tuple(r) for r in df.select("warc_type", "record_id", "refers_to", "block_digest", "content").collect())
    assert key(back) == key(records) and back.where("not whole").count() == 0


def test_all_source_headers_stay_and_records_name_each_other(spark):
    head = "HTTP/1.1 404 Not Found\r\nDate: Mon\r\nSet-Cookie: a=1\r\nSet-Cookie: b=2\r\nX-Long: one\r\n two\r\ncontent-type: text/html"
    blocks = [(1, "<r1>", "http://e.org/", None, head + "\r\n\r\n<p>hi", 0), (2, None, None, "d", None, 0), (3, "<r3>", "u", "d", "no head at all", 0), (3, "<r3>", "u", "d", "no head at all", 0)]
    df = spark.createDataFrame(blocks, "page_id long, record_id string, target_uri string, warc_date string, block string, content int")
    got = warc.derivatives(df).collect()
    assert len(got) == 8
    pair = {r.warc_type: r for r in got if r.page_id == 1}
    for r in pair.values():
        assert r.source_status == "HTTP/1.1 404 Not Found" and r.source_content_type == "text/html"
        assert r.source_headers == "Date: Mon\r\nSet-Cookie: a=1\r\nSet-Cookie: b=2\r\nX-Long: one two\r\ncontent-type: text/html"
    assert pair["metadata"].concurrent_to == pair["conversion"].record_id and pair["conversion"].concurrent_to == pair["metadata"].record_id
    assert "source-header-set-cookie: a=1\r\nsource-header-set-cookie: b=2\r\n" in pair["metadata"].content and pair["conversion"].content == "hi"
    assert [r.content for r in got if r.page_id == 3 and r.warc_type == "conversion"] == ["no head at all"] * 2


def test_hostile_pages_take_linear_time():
    import time

    for page in ("<a " * 350_000, "<title>" * 150_000, "<" * 1_000_000, "<!--" * 250_000, "<script>" * 130_000, "<a href='" * 110_000, "<html lang" * 100_000, "<p>" * 330_000, "<head><p>x" * 100_000, "</" * 500_000, "a href=" * 140_000, "<a href" + " " * 1_000_000 + ">"):
        began = time.time()
        warc.read_page(page, "http://e.org/")
        assert time.time() - began < 5


def parsed(data):
    """WARC records by their declared lengths alone."""
    at, out = 0, []
    while at < len(data):
        assert data[at : at + 10] == b"WARC/1.1\r\n"
        end = data.index(b"\r\n\r\n", at)
        head = dict(line.split(": ", 1) for line in data[at + 10 : end].decode().split("\r\n"))
        size = int(head["Content-Length"])
        out.append((head, data[end + 4 : end + 4 + size]))
        assert data[end + 4 + size :][:4] == b"\r\n\r\n"
        at = end + 8 + size
    return out


def test_independent_parser_reads_the_files_of_all_pages(spark, tmp_path):
    from html.parser import HTMLParser

    class Links(HTMLParser):
        def __init__(self):
            super().__init__()
            self.found = []

        def handle_starttag(self, tag, attrs):
            if tag == "a" and (href := dict(attrs).get("href")) is not None:
                self.found.append(urljoin(self.base, href.strip()))

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    records = warc.derivatives(warc.responses(pages))
    warc.write_warc(records, str(tmp_path / "w"), "none")
    found = [r for f in sorted((tmp_path / "w").glob("part-*")) for r in parsed(f.read_bytes())]
    assert len(found) == 2 * pages.count()
    responses = {r.record_id: r for r in warc.responses(pages).collect()}
    seen = {}
    for head, content in found:
        source = responses[head["WARC-Refers-To"]]
        assert head["WARC-Block-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(content).digest()).decode()
        assert head["WARC-Target-URI"] == source.target_uri
        seen[head["WARC-Record-ID"]] = head
        if head["WARC-Type"] == "metadata":
            p = Links()
            p.base = source.target_uri
            p.feed(source.block.partition("\r\n\r\n")[2])
            mine = [line[9:] for line in content.decode().split("\r\n") if line.startswith("outlink: ")]
            assert mine == list(dict.fromkeys(" ".join(x.split()) for x in p.found))
    assert all(seen[h["WARC-Concurrent-To"]]["WARC-Concurrent-To"] == k for k, h in seen.items())
    back = warc.read_warc(spark, str(tmp_path / "w"))
    assert back.count() == len(found) and back.where("not whole").count() == 0


def test_version_lines_in_a_payload_and_responses_read_back(spark, tmp_path):
    block = "HTTP/1.1 200 OK\r\nServer: s\r\n\r\n<p>WARC/1.1\r\nWARC-Type: no\r\n\r\nWARC/1.1\r\n</p>"
    record = lambda k: f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <r{k}>\r\nWARC-Target-URI: http://e.org/{k}\r\nContent-Length: {len(block)}\r\n\r\n{block}\r\n\r\n"
    (tmp_path / "a.warc").write_bytes("".join(record(k) for k in range(4)).encode())
    got = warc.read_warc(spark, str(tmp_path / "a.warc"))
    assert sorted((r.record_id, r.block, r.whole) for r in got.collect()) == [(f"<r{k}>", block, True) for k in range(4)]
    assert warc.derivatives(got).where("source_headers = 'Server: s'").count() == 8


def test_other_charsets_versions_and_lengths(spark, tmp_path):
    import gzip

    def record(k, block, version="1.0", size=None, kind="response"):
        head = f"WARC/{version}\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <r{k}>\r\nWARC-Target-URI: http://e.org/{k}\r\nContent-Length: {len(block) if size is None else size}\r\n\r\n"
        return head.encode() + block + b"\r\n\r\n"

    http = lambda kind: b"HTTP/1.1 200 OK\r\nContent-Type: text/html" + kind + b"\r\n\r\n"
    latin, meta, greek = "<p>caf\u00e9</p>".encode("latin-1"), '<meta charset="windows-1253"><p>\u0391\u0392'.encode("cp1253"), "<p>caf\u00e9".encode()
    junk = b"<p>a\xff\xfeb WARC/1.0 and WARC/1.x WARC/1.1\r\nWARC-Type: no\r\n\r\n</p>"
    blocks = [http(b"; charset=ISO-8859-1") + latin, http(b"") + meta, http(b"; charset=none-such") + greek, http(b"") + junk, b"\xe9 no head"]
    records = [record(9, b"software: x\xe9", kind="warcinfo"), *(record(k, b, "1.1" if k % 2 else "1.0") for k, b in enumerate(blocks)), record(7, b"short", size=999)]
    (tmp_path / "plain.warc").write_bytes(b"".join(records))
    (tmp_path / "packed.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    for name in ("plain.warc", "packed.warc.gz"):
        got = {r.record_id: r for r in warc.read_warc(spark, str(tmp_path / name)).collect()}
        assert got.keys() == {"<r9>", "<r7>", *(f"<r{k}>" for k in range(5))}
        assert [r.version for k, r in sorted(got.items())] == ["WARC/1.0", "WARC/1.1", "WARC/1.0", "WARC/1.1", "WARC/1.0", "WARC/1.0", "WARC/1.0"]
        assert {k for k, r in got.items() if not r.whole} == {"<r7>"} and got["<r7>"].content == "short" and got["<r9>"].block is None
        assert got["<r0>"].block.endswith("caf\u00e9</p>") and got["<r1>"].block.endswith("<p>\u0391\u0392") and got["<r2>"].block.endswith("caf\u00e9")
        assert got["<r3>"].block.encode().count(b"WARC/1.") == 3 and "\ufffd" in got["<r3>"].block and got["<r4>"].block == "\ufffd no head"
        text = {r.refers_to: r for r in warc.derivatives(warc.read_warc(spark, str(tmp_path / name)).where("block is not null")).where("warc_type = 'conversion'").collect()}
        assert text["<r0>"].content == "caf\u00e9" and text["<r0>"].source_payload_digest == warc.digest(latin)


def test_one_gzip_member_a_record_and_ids_by_content(spark, tmp_path):
    import zlib

    pages = spark.createDataFrame([(1, "http://e.org/", "<p>a"), (1, "http://e.org/", "<p>b"), (None, None, None)], "page_id long, url string, html string")
    ids = [r.record_id for r in warc.responses(pages).collect()]
    assert len(set(ids)) == 3
    records = warc.derivatives(warc.responses(pages)).repartition(2)
    warc.write_warc(records, str(tmp_path / "w"))
    members = []
    for file in sorted((tmp_path / "w").iterdir()):
        left = file.read_bytes()
        while left:
            one = zlib.decompressobj(31)
            members.append(one.decompress(left))
            left = one.unused_data
    assert len(members) == 6 and all(len(parsed(m)) == 1 for m in members)
    assert warc.read_warc(spark, str(tmp_path / "w")).where("whole").count() == 6
    with pytest.raises(ValueError):
        warc.write_warc(records, str(tmp_path / "w"))
    warc.write_warc(records.limit(0), str(tmp_path / "none"))
    assert not list((tmp_path / "none").iterdir())


def test_rules_want_order_and_the_longer_rule_wins(spark):
    s = licenses.SENTENCES
    full = ". ".join(s[k].upper() for k in ("mit.grant", "mit.keep", "mit.asis", "mit.liability")) + "."
    docs = {
        1: "Intro.\n" + full, 2: ". ".join(s[k] for k in ("mit.keep", "mit.grant", "mit.asis", "mit.liability")), 3: "Licensed under the Apache License, Version 2.0.", 4: None, 5: "", 6: "no licence here, Released under the MIT License yes",
        7: ". ".join(s[k] for k in ("bsd.permit", "bsd.source", "bsd.binary", "bsd.endorse")), 8: ". ".join(s[k] for k in ("bsd.permit", "bsd.source", "bsd.binary")), 9: "Released under the MIT License.\nReleased under the MIT License!\nLicensed under the MIT License.", 10: "x " * 90000 + ".\nLicensed under CC BY-NC 4.0.",
    }
    df = spark.createDataFrame([(k, t, "s") for k, t in docs.items()], "doc_id long, text string, s string")
    got = {r.doc_id: r.licenses for r in licenses.scan(df).collect()}
    assert got == {1: "MIT", 2: "", 3: "Apache-2.0", 4: "", 5: "", 6: "", 7: "BSD-3-Clause", 8: "BSD-2-Clause", 9: "MIT", 10: "CC-BY-NC-4.0"}
    plan = licenses.scan(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan and licenses.scan(df.limit(0)).count() == 0


def test_tags_leads_and_repeated_rows(spark):
    docs = [
        (1, "// SPDX-License-Identifier: MIT\nint x;"), (2, "/* SPDX-License-Identifier:  (MIT OR Apache-2.0) */"), (3, "# SPDX-License-Identifier: GPL-2.0-or-later WITH Classpath-exception-2.0\r\ncode"), (4, "SPDX-License-Identifier:\tNOASSERTION"),
        (5, "MIT licensed."), (6, "This program and all of the many files that come with it are licensed under the MIT License."), (7, "The library is\nlicensed under\nthe MIT License\nand a line"), (8, "the code that is not licensed under the MIT License"),
        (9, "Prose without a stop\nLicensed under CC BY 4.0\nmore prose"), (9, "Prose without a stop\nLicensed under CC BY 4.0\nmore prose"), (None, "MIT licensed!"), (10, "x" * 300_000 + " " + "y z " * 100_000 + "\nMIT License\n" + "q\n" * 50_000), (11, "Released under\nthe MIT License"),
    ]
    got = sorted(((r.doc_id or 0, r.licenses, r.n_known) for r in licenses.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()))
    assert got == [(0, "MIT", 1), (1, "MIT", 1), (2, "MIT,Apache-2.0", 2), (3, "GPL-2.0-or-later", 1), (4, "", 0), (5, "MIT", 1), (6, "MIT", 1), (7, "MIT", 1), (8, "", 0), (9, "CC-BY-4.0", 1), (9, "CC-BY-4.0", 1), (10, "MIT", 1), (11, "MIT", 1)]


def agrees(spark, docs):
    """Sentences and all, against the SQL."""
    import duckdb

    con = duckdb.connect()
    con.execute("create table documents(doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", docs)
    found = con.execute(licenses.oracle())
    names = [c[0] for c in found.description]
    mine = licenses.scan(spark.createDataFrame(docs, "doc_id long, text string")).select(*names)
    assert sorted(map(tuple, mine.collect()), key=repr) == sorted(found.fetchall(), key=repr)


def test_oracle_agrees(spark):
    import duckdb

    docs = [(1, "A. B! c\nReleased under the MIT License."), (2, None), (3, "x: y;\tz"), (4, "Ünïcode. The MIT License. Licensed under CC0 1.0\r\n")]
    con = duckdb.connect()
    con.execute("create table documents(doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", docs)
    found = con.execute(licenses.oracle())
    names = [c[0] for c in found.description]
    mine = licenses.scan(spark.createDataFrame(docs, "doc_id long, text string")).select(*names)
    assert sorted(map(tuple, mine.collect())) == sorted(found.fetchall())
    assert mine.where(F.col("n_known") > 0).count() == 2


def test_wrapped_texts_and_leading_words(spark):
    s = licenses.SENTENCES
    apache = ["Copyright 2020 X", "", 'Licensed under the Apache License, Version 2.0 (the "License");', "you may not use this file except in compliance with the License.", "You may obtain a copy of the License at", "", "    http://www.apache.org/licenses/LICENSE-2.0"]
    gpl = "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation; either version 2 of the License, or\n(at your option) any later version.\n\nThis program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\nGNU General Public License for more details.\n"
    wrap = lambda k, sign: textwrap.fill(s[k] + ".", 72, initial_indent=sign, subsequent_indent=sign)
    docs = {
        1: "\n".join(f"# {x}" for x in apache), 2: gpl, 3: "\r\n".join("// " + x for x in gpl.split("\n")),
        4: "\n *\n".join(wrap(k, " * ") for k in ("mit.grant", "mit.keep", "mit.asis", "mit.liability")), 5: "A line\n" + wrap("isc.permit", ""),
        6: "\n".join(wrap(k, f"{n}. ") for n, k in enumerate(("bsd.permit", "bsd.source", "bsd.binary", "bsd.endorse"))).replace("\n0. ", "\n").replace("\n1. ", "\n").replace("\n2. ", "\n").replace("\n3. ", "\n"),
        7: "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/.",
        8: "This software is licensed under the MIT License.", 9: "This software is not licensed under the MIT License.", 10: "Released under\n\nthe MIT License yes",
    }
    got = {r.doc_id: r.licenses for r in licenses.scan(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()}
    assert got == {1: "Apache-2.0", 2: "GPL-2.0-or-later", 3: "GPL-2.0-or-later", 4: "MIT", 5: "ISC", 6: "BSD-3-Clause", 7: "MPL-2.0", 8: "MIT", 9: "", 10: ""}


FILES = {
    "MIT": ["MIT License", "Copyright (c) 2020 Some One", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"],
    "Zlib": ["Copyright (C) 2020", "This software is provided 'as-is', without any express or implied warranty.  In no event will the authors be held liable for any damages arising from the use of this software.", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:", "1. The origin must not be misrepresented."],
    "AGPL-3.0-or-later": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU Affero General Public License for more details."],
    "GPL-2.0-only": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."],
    "EPL-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0.", "(See accompanying file LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
}
HEADS = {"GPL-3.0-only": "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007", "GPL-2.0-only": "\t\t    GNU GENERAL PUBLIC LICENSE\n\t\t       Version 2, June 1991\n\n Copyright", "Apache-2.0": "                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/", "LGPL-2.1-only": "GNU LESSER GENERAL PUBLIC LICENSE\nVersion 2.1, February 1999\n"}


def test_licence_files_wrapped_at_60_and_80_columns_behind_signs(spark):
    rows, want = [], {}
    for width in (60, 80):
        for sign in ("", "# ", " * ", "// ", ";; "):
            for name, paragraphs in FILES.items():
                text = f"\n{sign.rstrip()}\n".join(textwrap.fill(p, width, initial_indent=sign, subsequent_indent=sign) for p in paragraphs)
                want[len(rows)] = name
                rows.append((len(rows), "x = 1\n\n" + text + "\n\ncode();\n"))
    for name, head in HEADS.items():
        want[len(rows)] = name
        rows.append((len(rows), head))
    got = {r.doc_id: r.licenses for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want
    odd = ["", "v. 2.0. V.x", "a.\r\rb\n\r\nc", "x;y: z;\n\nq", "SPDX-License-Identifier: MIT\nMIT License\nReleased under\nthe MIT License.", "the the MIT License\nthe\nMIT License", "\x01MIT License\x02", "this is licensed under the\nMIT License"]
    agrees(spark, rows + [(1000 + k, t) for k, t in enumerate(odd)] + [(None, None), (5000, None)])


def test_oracle_agrees_on_the_tables(spark):
    import duckdb

    path = "/root/testdata/sf0.01/documents.parquet"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{path}'")
    found = con.execute(licenses.oracle())
    names = [c[0] for c in found.description]
    assert sorted(map(tuple, licenses.scan(spark.read.parquet(path)).select(*names).collect())) == sorted(found.fetchall())
