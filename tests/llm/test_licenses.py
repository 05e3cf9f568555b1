"""Licences that files name, beside a plain Python matcher of the same texts."""

import re

import pytest

from tidemart.llm import exact_dedup, licenses, pii

SPDX = """MIT Apache-2.0 Apache-1.1 BSD-2-Clause BSD-3-Clause BSD-4-Clause 0BSD ISC Zlib BSL-1.0
Unlicense WTFPL CC0-1.0 MPL-1.1 MPL-2.0 EPL-1.0 EPL-2.0 CDDL-1.0 EUPL-1.2 Artistic-2.0 AFL-3.0
MS-PL OFL-1.1 PostgreSQL PSF-2.0 NCSA Vim GPL-2.0-only GPL-2.0-or-later GPL-3.0-only
GPL-3.0-or-later LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only AGPL-3.0-only AGPL-3.0-or-later
CC-BY-4.0 CC-BY-SA-4.0 CC-BY-SA-3.0 CC-BY-ND-4.0 CC-BY-NC-4.0 CC-BY-NC-SA-4.0 CC-BY-NC-ND-4.0""".split()

SAID = {
    "This file is released under the MIT license.": "MIT",
    "The code is made available under the terms of the BSD 3-Clause License.": "BSD-3-Clause",
    "Licensed under the Boost Software License, Version 1.0.": "BSL-1.0",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "CC-BY-SA-4.0",
    "Distributed under the GNU Lesser General Public License v2.1 or later.": "LGPL-2.1-or-later",
    "This project is licensed under the GNU Affero General Public License version 3.": "AGPL-3.0-only",
    "Released under GPL v2+": "GPL-2.0-or-later",
    "This program and the accompanying materials are made available under the terms of the "
    "Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0": "EPL-2.0",
    "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy": "MPL-2.0",
    "This library is free software; you can redistribute it and/or modify it under the terms of\n"
    "the GNU Lesser General Public License as published by the Free Software Foundation; either\n"
    "version 2.1 of the License, or (at your option) any later version.\n": "LGPL-2.1-or-later",
    "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or "
    "without fee is hereby granted, provided that the above\ncopyright notice and this permission "
    "notice appear in all copies.": "ISC",
    "This is free and unencumbered software released into the public domain.": "Unlicense",
    "This Font Software is licensed under the SIL Open Font License, Version 1.1.": "OFL-1.1",
    "Altered source versions must be plainly marked as such, and must not be\nmisrepresented as "
    "being the original software.": "Zlib",
    "Dual licensed under the MIT license and the Apache License, Version 2.0.": "Apache-2.0 MIT",
}
QUIET = [
    "The license of the driver was taken away by the police.",
    "He was licensed to sell wine under the old law.",
    "All permissions are set. Released under pressure.",
    "License: to kill",
]


def plain(tag):
    """Licences of an SPDX expression, by the identifiers alone."""
    known = {x.lower(): x for x in SPDX}
    parts = re.split(r"(?i)\s+(?:or|and)\s+|[()]", tag)
    return sorted({known[p.strip().lower()] for p in parts if p.strip().lower() in known})


def found(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = licenses.scan_licenses(df).orderBy("doc_id").collect()
    return [r.licenses for r in rows]


def test_spdx_lines_end_with_their_line(spark):
    marks = ["// {}\nint main;", "# {}\nimport os", "/* {} */\ncode", " * {}\n * text", "<!-- {} -->\n<p>", "{}"]
    tags = [*SPDX, "MIT OR Apache-2.0", "(MIT AND BSD-3-Clause) OR ISC"]
    texts = [
        "first line\n" + marks[k % len(marks)].format(f"SPDX-License-Identifier: {tag}")
        for k, tag in enumerate(tags)
    ]
    assert len(SPDX) > 40
    assert found(spark, texts) == [plain(tag) for tag in tags]


def test_licences_by_name_and_by_text(spark):
    assert found(spark, list(SAID)) == [name.split() for name in SAID.values()]
    wrapped = ["Some words before.\n\n" + t + "\n\nand words after" for t in SAID]
    assert found(spark, wrapped) == [name.split() for name in SAID.values()]


def test_other_texts_have_none(spark):
    assert found(spark, QUIET) == [[]] * len(QUIET)


@pytest.mark.parametrize("name", ["ids", "hit", "__ids", "__hit", "IDS"])
def test_columns_of_any_name_pass_through(spark, name):
    df = spark.createDataFrame([(1, "mail a@b.org. Released under the MIT license.", "kept")], f"doc_id long, text string, {name} string")
    for out in (licenses.scan_licenses(df), pii.pseudonymise(df, "k")):
        assert out.first()[name] == "kept" and out.columns[:3] == df.columns
    assert exact_dedup.dedup_exact(df, exact_dedup.new_index(spark, df)).count() == 1
