"""Licence recognition by sentences.

A text is cut into sentences, each is normalised and looked up among known licence
sentences, and the sequence of identifiers is matched against ordered rules: the
first rule whose identifiers occur in a row names a licence and uses them up.
Sentences and lines that put something under a licence by its name ("released under
the ...", SPDX lines) are known by their frame: the name is looked up, and the
identifier, ``=`` and the licence, names that licence itself. DataFrame functions only.
"""

from __future__ import annotations

import re
from itertools import chain, product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm._common import free_name

# Identifier: normalised sentences that mean it.
SENTENCES = {
    "apache2": (
        "licensed under the apache license version 2 0",
        "licensed under the apache license version 2 0 the license",
        "released under the apache license version 2 0",
        "this work is licensed under the apache license version 2 0",
        "spdx license identifier apache 2 0",
    ),
    "apacheNoUse": (
        "you may not use this file except in compliance with the license",
        "you may obtain a copy of the license at",
    ),
    "asIsLicense": (
        "unless required by applicable law or agreed to in writing software distributed under "
        "the license is distributed on an as is basis without warranties or conditions of any "
        "kind either express or implied",
    ),
    "mit": (
        "released under the mit license",
        "licensed under the mit license",
        "this work is licensed under the mit license",
        "spdx license identifier mit",
    ),
    "mitPermission": (
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files the software to deal in the software "
        "without restriction including without limitation the rights to use copy modify merge "
        "publish distribute sublicense and or sell copies of the software and to permit persons "
        "to whom the software is furnished to do so subject to the following conditions",
    ),
    "mitNotice": (
        "the above copyright notice and this permission notice shall be included in all copies "
        "or substantial portions of the software",
    ),
    "gpl3": (
        "this work is licensed under the gnu general public license version 3",
        "licensed under the gnu general public license version 3",
        "released under the gnu general public license version 3",
        "spdx license identifier gpl 3 0 only",
    ),
    "gpl3orLater": (
        "this program is free software you can redistribute it and or modify it under the terms "
        "of the gnu general public license as published by the free software foundation either "
        "version 3 of the license or at your option any later version",
        "spdx license identifier gpl 3 0 or later",
    ),
    "gpl2orLater": (
        "this program is free software you can redistribute it and or modify it under the terms "
        "of the gnu general public license as published by the free software foundation either "
        "version 2 of the license or at your option any later version",
        "spdx license identifier gpl 2 0 or later",
    ),
    "fsfNoWarranty": (
        "this program is distributed in the hope that it will be useful but without any warranty "
        "without even the implied warranty of merchantability or fitness for a particular purpose",
    ),
    "ccByNc4": (
        "licensed under cc by nc 4 0",
        "this work is licensed under cc by nc 4 0",
        "this work is licensed under a creative commons attribution noncommercial 4 0 "
        "international license",
        "spdx license identifier cc by nc 4 0",
    ),
    "ccBy4": (
        "licensed under cc by 4 0",
        "this work is licensed under cc by 4 0",
        "this work is licensed under a creative commons attribution 4 0 international license",
        "spdx license identifier cc by 4 0",
    ),
    "bsdPermission": (
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
    ),
    "bsdSource": (
        "redistributions of source code must retain the above copyright notice this list of "
        "conditions and the following disclaimer",
    ),
    "bsdBinary": (
        "redistributions in binary form must reproduce the above copyright notice this list of "
        "conditions and the following disclaimer in the documentation and or other materials "
        "provided with the distribution",
    ),
    "bsdEndorse": (
        "neither the name of the copyright holder nor the names of its contributors may be used "
        "to endorse or promote products derived from this software without specific prior written "
        "permission",
    ),
    "reserved": ("all rights reserved",),
    "iscPermission": (
        "permission to use copy modify and or distribute this software for any purpose with or "
        "without fee is hereby granted provided that the above copyright notice and this "
        "permission notice appear in all copies",
    ),
    "zeroBsdPermission": (
        "permission to use copy modify and or distribute this software for any purpose with or "
        "without fee is hereby granted",
    ),
    "zlibAltered": (
        "altered source versions must be plainly marked as such and must not be misrepresented "
        "as being the original software",
    ),
    "boostPermission": (
        "permission is hereby granted free of charge to any person or organization obtaining a "
        "copy of the software and accompanying documentation covered by this license the "
        "software to use reproduce display distribute execute and transmit the software and to "
        "prepare derivative works of the software and to permit third parties to whom the "
        "software is furnished to do so all subject to the following",
    ),
    "unencumbered": ("this is free and unencumbered software released into the public domain",),
    "mozillaNotice": (
        "this source code form is subject to the terms of the mozilla public license v 2 0",
    ),
    "ccZeroWaiver": (
        "to the extent possible under law the author has waived all copyright and related or "
        "neighboring rights to this work",
    ),
}

# In order: identifiers in a row, and the licence they mean.
RULES = (
    ("apache2 apacheNoUse apacheNoUse asIsLicense", "Apache-2.0"),
    ("gpl3orLater fsfNoWarranty", "GPL-3.0-or-later"),
    ("gpl2orLater fsfNoWarranty", "GPL-2.0-or-later"),
    ("mitPermission mitNotice", "MIT"),
    ("bsdPermission bsdSource bsdBinary bsdEndorse", "BSD-3-Clause"),
    ("bsdPermission bsdSource bsdBinary", "BSD-2-Clause"),
    ("gpl3orLater", "GPL-3.0-or-later"),
    ("gpl2orLater", "GPL-2.0-or-later"),
    ("apache2", "Apache-2.0"),
    ("mitPermission", "MIT"),
    ("mit", "MIT"),
    ("gpl3", "GPL-3.0-only"),
    ("ccByNc4", "CC-BY-NC-4.0"),
    ("ccBy4", "CC-BY-4.0"),
    ("iscPermission", "ISC"),
    ("zeroBsdPermission", "0BSD"),
    ("zlibAltered", "Zlib"),
    ("boostPermission", "BSL-1.0"),
    ("unencumbered", "Unlicense"),
    ("mozillaNotice", "MPL-2.0"),
    ("ccZeroWaiver", "CC0-1.0"),
    ("reserved", "Proprietary"),
)

# Licences and what texts call them, without words such as "the", "license" and
# "version"; an identifier is also a name of its own (fixed values).
NAMES = {
    "MIT": ("mit expat", "expat", "mit mit"),
    "Apache-2.0": ("apache", "apache software 2 0", "asl 2 0"),
    "Apache-1.1": ("apache software 1 1",),
    "BSD-2-Clause": ("simplified bsd", "freebsd", "2 clause bsd", "bsd 2 clause simplified"),
    "BSD-3-Clause": ("new bsd", "modified bsd", "3 clause bsd", "bsd 3 clause new", "revised bsd"),
    "BSD-4-Clause": ("original bsd", "4 clause bsd"),
    "0BSD": ("zero clause bsd", "bsd zero clause"),
    "ISC": (),
    "Zlib": ("zlib libpng",),
    "BSL-1.0": ("boost software 1 0", "boost 1 0", "boost software"),
    "Unlicense": (),
    "WTFPL": ("do what the fuck you want to public",),
    "CC0-1.0": ("cc0", "cc0 1 0 universal", "creative commons zero 1 0 universal"),
    "MPL-1.1": ("mozilla public 1 1",),
    "MPL-2.0": ("mozilla public 2 0", "mozilla public"),
    "EPL-1.0": ("eclipse public 1 0",),
    "EPL-2.0": ("eclipse public 2 0",),
    "CDDL-1.0": ("common development and distribution 1 0", "common development and distribution"),
    "EUPL-1.2": ("european union public 1 2", "eupl 1 2"),
    "Artistic-2.0": (),
    "AFL-3.0": ("academic free 3 0",),
    "MS-PL": ("microsoft public",),
    "OFL-1.1": ("sil open font 1 1", "open font 1 1"),
    "PostgreSQL": (),
    "PSF-2.0": ("python software foundation", "psf", "python software foundation 2"),
    "NCSA": ("university of illinois ncsa open source",),
    "Vim": (),
}
# Families with versions, of which later ones may be allowed (fixed values).
GNU = {
    "GPL": (("gnu general public", "gnu gpl", "gpl"), ("1.0", "2.0", "3.0")),
    "LGPL": (
        ("gnu lesser general public", "gnu library general public", "gnu lgpl", "lgpl"),
        ("2.0", "2.1", "3.0"),
    ),
    "AGPL": (("gnu affero general public", "gnu agpl", "agpl"), ("1.0", "3.0")),
}
CREATIVE_COMMONS = {
    "BY": "attribution",
    "BY-SA": "attribution sharealike",
    "BY-ND": "attribution noderivatives",
    "BY-NC": "attribution noncommercial",
    "BY-NC-SA": "attribution noncommercial sharealike",
    "BY-NC-ND": "attribution noncommercial noderivatives",
}
CC_VERSIONS = ("2.0", "2.5", "3.0", "4.0")


def _named() -> dict[str, str]:
    """Name, as `_canonical` leaves it, to licence."""
    out = {}
    for name, others in NAMES.items():
        for said in (re.sub(r"[^a-z0-9]+", " ", name.lower()), *others):
            out[said] = name
    for family, (names, versions) in GNU.items():
        for said, version in product(names, versions):
            number = version.replace(".", " ")
            for spoken in dict.fromkeys((number, number.removesuffix(" 0"))):
                only, later = f"{family}-{version}-only", f"{family}-{version}-or-later"
                out |= {f"{said} {spoken}": only, f"{said} {spoken} only": only}
                out[f"{said} {spoken} orlater"] = later
    for (part, words), version in product(CREATIVE_COMMONS.items(), CC_VERSIONS):
        name, number = f"CC-{part}-{version}", version.replace(".", " ")
        out[f"cc {part.lower().replace('-', ' ')} {number}"] = name
        for kind in ("", " international", " unported"):
            out[f"creative commons {words} {number}{kind}"] = name
    return out


# On normalised sentences. A frame's group is the licence's name.
_SUBJECT = r"(?:(?:this|the|all|our|these) (?:\w+ ){1,6}?(?:is|are|has been|was|were) )?"
_VERB = (
    r"(?:licensed|released|distributed|published|available|made available|provided|covered|"
    r"subject|free software licensed|open source under)"
)
FRAME = (
    rf"^{_SUBJECT}(?:also |hereby |dual |freely )*{_VERB} (?:under|by|to) "
    r"(?:either )?(?:the terms (?:and conditions )?(?:of|in) )?(.+)$"
)
# The header of the GNU licences, said in one sentence.
GNU_HEADER = (
    r"^this \w+ is free software you can redistribute it and or modify it under the terms of "
    r"(the gnu .+? license) as published by the free software foundation (?:either )?"
    r"(version [0-9 ]+?) of the license( or at your option any later version)?$"
)
LATER = r" or (?:at your option )?(?:any )?(?:later|newer)(?: version)?| plus$"
AFTER_NAME = r" (?:which|as published|see|you|a copy|for details|for more|in the file|found in|with) .*$"
# A line that says a licence and nothing else.
TAG = r"(?im)^\W*(?:SPDX-License-Identifier|Licen[sc]e)[ \t]*[:=][ \t]*(.+?)[^\w+]*$"

# Every known sentence holds one of these; a text without them needs no cutting.
HINT = (
    r"(?i)licen[sc]e|warrant|permission|redistribut|all\W+rights|public\W+domain|neighboring|misrepresented|"
    r"(?:released|distributed|published|available)\W+under"
)
# A sentence ends at . ! ? before white space, at : ; before a line end, at an empty
# line, or at the end.
ENDS = r"(?<=[.!?])\s+|(?<=[:;])[ \t]*\n|\n\s*\n"


def normalise(sentence: Column) -> Column:
    """Lower case, letters and digits with single spaces; ``2+`` is 2 or later."""
    later = F.regexp_replace(F.lower(sentence), r"(?<=[0-9])\+", " or later")
    return F.trim(F.regexp_replace(later, r"[^\p{L}\p{N}]+", " "))


def _lookup(pairs: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for x in chain.from_iterable(pairs.items())))


def _name_ids(said: Column) -> Column:
    """``=`` and the licence, for each licence that a normalised name is of."""
    later = F.regexp_replace(said, LATER, " orlater")
    cut = F.regexp_replace(later, AFTER_NAME, "")
    plain = F.regexp_replace(cut, r"\b(?:the|an?|licen[sc]es?d?|version|v|your choice of)\b", " ")
    plain = F.regexp_replace(plain, r"\bv(?=[0-9])", "")
    parts = F.split(F.trim(F.regexp_replace(plain, " +", " ")), " (?:or|and) ")
    # Names with "and" in them are looked up whole, too.
    whole = F.concat(F.array(F.trim(F.regexp_replace(plain, " +", " "))), parts)
    table = _lookup(_named())
    found = F.transform(whole, lambda p: F.element_at(table, F.trim(p)))
    known = F.array_distinct(F.filter(found, lambda x: x.isNotNull()))
    return F.transform(known, lambda x: F.concat(F.lit("="), x))


def _sentence_ids(sentences: Column) -> Column:
    """Identifiers of the known sentences, in order, as (identifier) texts."""
    table = _lookup({s: name for name, said in SENTENCES.items() for s in said})
    none = F.array().cast("array<string>")

    def ids(n: Column) -> Column:
        said = F.regexp_replace(n, GNU_HEADER, "licensed under $1 $2$3")
        exact = F.element_at(table, n)
        framed = F.when(said.rlike(FRAME), _name_ids(F.regexp_extract(said, FRAME, 1)))
        return F.when(exact.isNotNull(), F.array(exact)).otherwise(F.coalesce(framed, none))

    return F.flatten(F.transform(F.transform(sentences, normalise), ids))


def _tag_ids(text: Column) -> Column:
    """Identifiers of lines that only say a licence, one comment mark or more aside."""
    tags = F.regexp_extract_all(text, F.lit(TAG), F.lit(1))
    return F.flatten(F.transform(F.transform(tags, normalise), _name_ids))


def _matched(ids: Column) -> Column:
    """Licences by the ordered rules, each identifier used once, and those that name one."""
    rules = F.array(
        *(
            F.struct(F.lit(f" {rule.replace(' ', '  ')} ").alias("rule"), F.lit(name).alias("name"))
            for rule, name in RULES
        )
    )
    # Doubled spaces, so that rules side by side do not share one.
    start = F.struct(
        F.concat(F.lit(" "), F.array_join(ids, "  "), F.lit(" ")).alias("rest"),
        F.array().cast("array<string>").alias("names"),
    )

    def step(s: Column, rule: Column) -> Column:
        rest = F.replace(s["rest"], rule["rule"], F.lit(" | "))
        hit = rest != s["rest"]
        return F.struct(
            rest.alias("rest"),
            F.when(hit, F.array_union(s["names"], F.array(rule["name"])))
            .otherwise(s["names"])
            .alias("names"),
        )

    own = F.transform(
        F.filter(ids, lambda i: F.startswith(i, F.lit("="))), lambda i: F.substring(i, 2, 99)
    )
    return F.array_union(F.aggregate(rules, start, step, lambda s: s["names"]), own)


def scan_licenses(
    docs: DataFrame,
    text_col: str = "text",
    found_col: str = "licenses",
    ids_col: str = "license_sentences",
) -> DataFrame:
    """``docs`` with the licences found (sorted names) and the sentence identifiers.

    Sentences are sought among lines first, and then, for wrapped text, with line
    breaks read as spaces; both sequences go through the rules and their licences
    are united, with those that a line names by itself (``SPDX-License-Identifier: MIT``
    after any comment mark). ``ids_col`` is the longer sequence (lines on a tie), then
    those lines'. Null and empty texts have empty lists. Rows are mapped one by one;
    columns of the two names are replaced, others pass through whatever their names.
    """
    text = F.col(f"`{text_col}`")
    lines = _sentence_ids(F.split(text, r"\n|(?<=[.!?:;])\s+"))
    joined = _sentence_ids(F.split(text, ENDS))
    hit = F.when(
        text.rlike(HINT),
        F.struct(lines.alias("lines"), joined.alias("joined"), _tag_ids(text).alias("tags")),
    )
    own = free_name(docs, "ids")
    ids = F.col(own)
    longer = F.when(F.size(ids["lines"]) >= F.size(ids["joined"]), ids["lines"]).otherwise(
        ids["joined"]
    )
    none = F.array().cast("array<string>")
    every = F.array_union(_matched(ids["lines"]), _matched(ids["joined"]))
    every = F.array_union(every, _matched(ids["tags"]))
    made = docs.withColumn(own, hit)
    return (
        made.withColumn(found_col, F.coalesce(F.array_sort(every), none))
        .withColumn(ids_col, F.coalesce(F.concat(longer, ids["tags"]), none))
        .drop(own)
    )
