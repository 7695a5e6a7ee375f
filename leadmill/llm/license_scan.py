"""Licences by sentences: known sentences become identifiers, their sequence is matched by rules.

A text is cut into sentences at line breaks and after ``.``, ``!``, ``?``, ``:`` or ``;`` before white
space. A sentence is normalised to its lower-cased runs of a-z and 0-9, joined by one space. A known
sentence may also run over several lines, whatever marks begin and end them, but not over an
empty line or one of marks only; of known sentences that begin at the same place the longest is taken.
The known ones among a text's sentences, in order, are its sequence of identifiers. A rule is a licence
and the identifiers that must follow each other in it; rules are tried in order, and an identifier
that a rule has used is not there for later ones.

Only DataFrame functions are used and rows stay where they are. A null or empty text has an empty
sequence and no licence. Repeated rows give equal results, empty tables empty ones; other columns
do not matter, whatever their names.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadmill.llm.shared import pick

# Sentences of common licences and notices, as they are usually written.
SENTENCES = {
    "apache-short": "Licensed under the Apache License, Version 2.0.",
    "apache-notice": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache-comply": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at",
    "mit-short": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                 'associated documentation files (the "Software"), to deal in the Software without restriction, '
                 "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
                 "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
                 "furnished to do so, subject to the following conditions:",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or "
                  "substantial portions of the Software.",
    "gpl-3-short": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-free": "This program is free software:",
    "gpl-3-terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                   "published by the Free Software Foundation, either version 3 of the License, or (at your option) "
                   "any later version.",
    "gpl-3-only-terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License "
                        "as published by the Free Software Foundation, version 3.",
    "gpl-terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                 "published by the Free Software Foundation;",
    "gpl-2-terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                   "published by the Free Software Foundation, either version 2 of the License, or (at your option) "
                   "any later version.",
    "gpl-2-only-terms": "you can redistribute it and/or modify it under the terms of the GNU General Public License "
                        "version 2 as published by the Free Software Foundation.",
    "lgpl-free": "This library is free software:",
    "lgpl-terms": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License "
                  "as published by the Free Software Foundation;",
    "lgpl-3-terms": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
                    "License as published by the Free Software Foundation, either version 3 of the License, or (at "
                    "your option) any later version.",
    "agpl-terms": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License "
                  "as published by the Free Software Foundation;",
    "agpl-3-terms": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
                    "License as published by the Free Software Foundation, either version 3 of the License, or (at "
                    "your option) any later version.",
    "or-later-2": "either version 2 of the License, or (at your option) any later version.",
    "or-later-2.1": "either version 2.1 of the License, or (at your option) any later version.",
    "or-later-3": "either version 3 of the License, or (at your option) any later version.",
    "only-2": "version 2 of the License.",
    "only-2.1": "version 2.1 of the License.",
    "only-3": "version 3 of the License.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
                 "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
                 "in all copies.",
    "isc-and-grant": "Permission to use, copy, modify, and distribute this software for any purpose with or without "
                     "fee is hereby granted, provided that the above copyright notice and this permission notice "
                     "appear in all copies.",
    "cc-by-nc-short": "Licensed under CC BY-NC 4.0.",
    "cc-by-short": "Licensed under CC BY 4.0.",
    "cc-by-sa-work": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-work": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "bsd-intro": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                 "provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions "
                  "and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of "
                  "conditions and the following disclaimer in the documentation and/or other materials provided "
                  "with the distribution.",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
                 "or promote products derived from this software without specific prior written permission.",
    "mpl-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "all-rights": "All rights reserved.",
}

# Licences and the identifiers that make them, more of them before fewer.
RULES = [
    ("Apache-2.0", ["apache-notice", "apache-comply", "apache-copy"]),
    ("Apache-2.0", ["apache-notice", "apache-comply"]),
    ("Apache-2.0", ["apache-notice"]),
    ("Apache-2.0", ["apache-short"]),
    ("BSD-3-Clause", ["bsd-intro", "bsd-source", "bsd-binary", "bsd-names"]),
    ("BSD-2-Clause", ["bsd-intro", "bsd-source", "bsd-binary"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("MIT", ["mit-grant"]),
    ("MIT", ["mit-short"]),
    ("MIT", ["mit-licensed"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-3-terms"]),
    ("GPL-3.0-only", ["gpl-free", "gpl-3-only-terms"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-terms", "or-later-3"]),
    ("GPL-3.0-only", ["gpl-free", "gpl-terms", "only-3"]),
    ("GPL-2.0-or-later", ["gpl-free", "gpl-terms", "or-later-2"]),
    ("GPL-2.0-or-later", ["gpl-free", "gpl-2-terms"]),
    ("GPL-2.0-only", ["gpl-free", "gpl-terms", "only-2"]),
    ("GPL-2.0-only", ["gpl-free", "gpl-2-only-terms"]),
    *[(name, [free, *terms]) for free in ("lgpl-free", "gpl-free") for name, terms in [
        ("LGPL-2.1-or-later", ["lgpl-terms", "or-later-2.1"]),
        ("LGPL-2.1-only", ["lgpl-terms", "only-2.1"]),
        ("LGPL-3.0-or-later", ["lgpl-terms", "or-later-3"]),
        ("LGPL-3.0-or-later", ["lgpl-3-terms"]),
        ("LGPL-3.0-only", ["lgpl-terms", "only-3"])]],
    ("AGPL-3.0-or-later", ["gpl-free", "agpl-terms", "or-later-3"]),
    ("AGPL-3.0-or-later", ["gpl-free", "agpl-3-terms"]),
    ("AGPL-3.0-only", ["gpl-free", "agpl-terms", "only-3"]),
    ("GPL-3.0-only", ["gpl-3-short"]),
    ("ISC", ["isc-grant"]),
    ("ISC", ["isc-and-grant"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-short"]),
    ("CC-BY-4.0", ["cc-by-short"]),
    ("CC-BY-4.0", ["cc-by-work"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-work"]),
    ("MPL-2.0", ["mpl-notice"]),
    ("LicenseRef-all-rights-reserved", ["all-rights"]),
]

BREAK = r"\n+|(?<=[.!?:;])[ \t\r\f\x0B]+"


# Steps from a lower-cased text to its words, in which capitals stand for breaks: L for the end of a line,
# over which a known sentence may run, S for the end of a sentence or paragraph.
MARKS = [
    (r"\n[^a-z0-9\n]++", "\n"),  # what begins a line, as in comments
    (r"\n{2,}+", "S"),
    (r"[.!?:;](?:[ \t\r\f\x0B]++|\n)", "S"),
    (r"\n", "L"),
    (r"[^a-z0-9LS]++", " "),
    (r"[ L]*+S[ LS]*+", "S"),
    (r" ?L ?", "L"),
]


def marked(text: Column) -> Column:
    words = F.concat(F.lit("\n\n"), F.lower(F.coalesce(text, F.lit(""))), F.lit("\n\n"))
    for pattern, mark in MARKS:
        words = F.regexp_replace(words, pattern, mark)
    return words


def _plain(sentence: str) -> str:
    return " ".join("".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789" else " " for c in sentence.lower()).split())


def split_known(sentences: dict[str, str]) -> tuple[dict[str, str], dict[str, list[str]]]:
    """Known sentences as a text would be cut: identifier by normalised sentence, and by name its identifiers."""
    identifiers, parts = {}, {}
    for name, sentence in sentences.items():
        cut = [p for p in (_plain(s) for s in re.split(BREAK, sentence)) if p]
        parts[name] = [name if n == 0 else f"{name}-{n + 1}" for n in range(len(cut))]
        identifiers.update(zip(cut, parts[name], strict=True))
    return identifiers, parts


def scan_licenses(df: DataFrame, id_column: str = "doc_id", text: str = "text",
                  sentences: dict[str, str] | None = None,
                  rules: list[tuple[str, list[str]]] | None = None) -> DataFrame:
    """Per row: the id, ``sentence_ids`` (known ones in order), ``licenses`` (sorted, each once) and
    ``n_matches`` (rules matched, repeats included)."""
    identifiers, parts = split_known(sentences or SENTENCES)
    known = F.create_map(*[F.lit(x) for pair in identifiers.items() for x in pair])
    rows = pick(df, id_column, text)
    any_known = "|".join(s.replace(" ", "[ L]") for s in sorted(identifiers, key=len, reverse=True))
    found = F.regexp_extract_all(marked(F.col(text)), F.lit(f"(?<=[LS])({any_known})(?=[LS])"), F.lit(1))
    found = F.transform(found, lambda s: F.element_at(known, F.translate(s, "L", " ")))
    matched = rows.select(id_column, found.alias("sentence_ids"))
    # The sequence as text, in which a used stretch leaves a gap.
    state = F.concat(F.lit("|"), F.array_join("sentence_ids", "||"), F.lit("|"))
    matched = matched.withColumns({"_left": state, "_licenses": F.array().cast("array<string>"), "_n": F.lit(0)})
    for name, needed in rules or RULES:
        wanted = "".join(f"|{i}|" for n in needed for i in parts[n])
        hits = ((F.length("_left") - F.length(F.replace("_left", F.lit(wanted), F.lit("")))) / len(wanted)).cast("int")
        matched = matched.withColumns({
            "_n": F.col("_n") + hits,
            "_licenses": F.when(hits > 0, F.array_append("_licenses", F.lit(name))).otherwise(F.col("_licenses")),
            "_left": F.replace("_left", F.lit(wanted), F.lit("/")),
        })
    return matched.select(
        id_column, F.array_join("sentence_ids", " ").alias("sentence_ids"),
        F.array_join(F.array_sort(F.array_distinct("_licenses")), " ").alias("licenses"),
        F.col("_n").cast("long").alias("n_matches"))
