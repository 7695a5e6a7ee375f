import textwrap

import pytest

from leadmill.llm.license_scan import SENTENCES, scan_licenses
from tests.llm.frames import by_id, documents

MIT = f"{SENTENCES['mit-grant']}\n\n{SENTENCES['mit-notice']}"
BSD2 = "\n".join(SENTENCES[s] for s in ("bsd-intro", "bsd-source", "bsd-binary"))
BSD3 = f"{BSD2} {SENTENCES['bsd-names']}"


@pytest.mark.parametrize(("text", "licenses", "matches"), [
    ("Some prose. Released under the MIT License. More prose.", "MIT", 1),
    ("RELEASED   under the mit\tlicense!\nx", "MIT", 1),
    ("Licensed### under%%% CC&&& BY-NC*** 4.0.", "CC-BY-NC-4.0", 1),
    (MIT, "MIT", 1), (BSD2, "BSD-2-Clause", 1), (BSD3, "BSD-3-Clause", 1),
    (f"{SENTENCES['gpl-free']} {SENTENCES['gpl-3-terms']}", "GPL-3.0-or-later", 1),
    (f"{SENTENCES['gpl-3-terms']} {SENTENCES['gpl-free']}", "", 0),
    ("Licensed under the Apache License, Version 2.0. Text. This work is licensed under the GNU General Public License, version 3.",
     "Apache-2.0 GPL-3.0-only", 2),
    ("All rights reserved.\nAll rights reserved.", "LicenseRef-all-rights-reserved", 2),
    ("We released it under the MIT License once.", "", 0), ("", "", 0), (None, "", 0),
    ("word " * 50_000 + ". Released under the MIT License.", "MIT", 1),
])
def test_rules(spark, text, licenses, matches):
    assert by_id(scan_licenses(documents(spark, text, text)), "licenses", "n_matches") == {
        0: (licenses, matches), 1: (licenses, matches)}


def test_only_native_expressions_and_own_rules(spark):
    docs = documents(spark, "Alpha rule.\nBeta rule.", "Beta rule.")
    found = scan_licenses(docs, sentences={"a": "Alpha rule", "b": "beta RULE"}, rules=[("AB", ["a", "b"]), ("B", ["b"])])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert by_id(found, "sentence_ids", "licenses") == {0: ("a b", "AB"), 1: ("b", "B")}
    assert scan_licenses(docs.limit(0)).count() == 0


APACHE_COMMENT = """/*
 * Licensed under the Apache License, Version 2.0 (the "License"); you may
 * not use this file except in compliance with the License. You may obtain
 * a copy of the License at
 *
 *     http://www.apache.org/licenses/LICENSE-2.0
 */
int x;"""
GPL_2 = ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
         "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
         "later version.")
LGPL = GPL_2.replace("program", "library").replace("General", "Lesser General").replace("version 2", "version 2.1")
AGPL = GPL_2.replace("software;", "software:").replace("General", "Affero General").replace("Foundation;", "Foundation,").replace(
    "version 2", "version 3")
ISC = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
       "granted, provided that the above copyright notice and this permission notice appear in all copies.")


def wrapped(text, mark="", width=72):
    return "\n".join(textwrap.fill(p, width, initial_indent=mark, subsequent_indent=mark) for p in text.split("\n"))


WRAPPED = [
    (wrapped(MIT), "MIT", 1), (wrapped(MIT).replace("\n", "\r\n"), "MIT", 1), (wrapped(MIT, "# "), "MIT", 1),
    ("Copyright (c) 2020 A B\n" + wrapped(MIT, "; "), "MIT", 1), (APACHE_COMMENT, "Apache-2.0", 1),
    (wrapped(BSD3, " * "), "BSD-3-Clause", 1), ("Released under\nthe MIT License.\n\nReleased under the MIT License.", "MIT", 2),
    (wrapped(GPL_2, "// "), "GPL-2.0-or-later", 1), (wrapped(LGPL), "LGPL-2.1-or-later", 1),
    (wrapped(AGPL, "-- "), "AGPL-3.0-or-later", 1), (wrapped(ISC), "ISC", 1),
    ("Title\nAll rights reserved.\nreleased it", "LicenseRef-all-rights-reserved", 1),
    ("Released under the\n\nMIT License.", "", 0), ("Released under the\n *\n * MIT License.", "", 0),
    ("Released under the.\nMIT License.", "", 0), ("He\nreleased it under the MIT License.", "", 0),
]


def test_sentences_over_several_lines(spark):
    found = scan_licenses(documents(spark, *[text for text, _, _ in WRAPPED]))
    assert by_id(found, "licenses", "n_matches") == {n: (names, k) for n, (_, names, k) in enumerate(WRAPPED)}
