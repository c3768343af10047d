"""Licence scans by sentence rules.

A text is cut into sentences after stops (full stop, semicolon, colon and so on before white space), at brackets and at blank
lines. Within a sentence each line is also taken by itself, as licence lines often stand without a stop. Marks of comments at
the beginning of lines are taken off first. Sentences are normalised (lower case, only letters, digits and dots inside numbers,
single spaces) and mapped to the identifiers of known licence sentences. The sequence of identifiers of a document is matched
against ordered rules, of which the first that holds names the licence. All of it is column expressions in one scan: no
shuffle, and nothing but literal maps of the known sentences (fixed tables) is shipped.

Defined cases: null and empty texts have no sentences and licence ``none``; repeated sentences are listed each time, and a
sentence of several lines after its lines; of rules that tie the first in the order holds; null and repeated doc_ids are
allowed; texts of any length are read whole; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriva.llm.common import ascii_lower

#: Known licence sentences, normalised, and their identifiers.
SENTENCES = {
    "licensed under cc by nc 4.0": "cc-by-nc-4.0",
    "this work is licensed under cc by 4.0": "cc-by-4.0",
    "licensed under cc by 4.0": "cc-by-4.0",
    "licensed under cc by sa 4.0": "cc-by-sa-4.0",
    "this work is licensed under the gnu general public license version 3": "gpl-3",
    "this program is free software": "gpl-notice",
    "licensed under the gnu general public license version 2": "gpl-2",
    "licensed under the apache license version 2.0": "apache-2",
    "you may not use this file except in compliance with the license": "apache-terms",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge": "mit-grant",
    "the software is provided as is": "as-is",
    "redistribution and use in source and binary forms are permitted": "bsd-grant",
    "this project is licensed under the mit license": "mit",
    "licensed under the mit license": "mit",
    "the mit license": "mit",
    "mit license": "mit",
    "licensed under the bsd license": "bsd",
    "licensed under the isc license": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "this work is dedicated to the public domain": "public-domain",
    "all rights reserved": "reserved",
    "this work is in the public domain": "public-domain",
}
#: Ordered rules: licence, kind, and the identifiers that must occur in this order (others may lie between).
RULES = [
    ("dual-mit-apache", "permissive", ["mit", "apache-2"]),
    ("dual-apache-mit", "permissive", ["apache-2", "mit"]),
    ("gpl-3.0", "copyleft", ["gpl-3"]),
    ("gpl-2.0", "copyleft", ["gpl-2"]),
    ("gpl-unversioned", "copyleft", ["gpl-notice"]),
    ("cc-by-nc-4.0", "non-commercial", ["cc-by-nc-4.0"]),
    ("cc-by-sa-4.0", "copyleft", ["cc-by-sa-4.0"]),
    ("cc-by-4.0", "permissive", ["cc-by-4.0"]),
    ("apache-2.0", "permissive", ["apache-2"]),
    ("apache-2.0", "permissive", ["apache-terms"]),
    ("mit", "permissive", ["mit"]),
    ("mit", "permissive", ["mit-grant", "as-is"]),
    ("bsd", "permissive", ["bsd-grant", "as-is"]),
    ("public-domain", "permissive", ["public-domain"]),
    ("all-rights-reserved", "proprietary", ["reserved"]),
]

#: Sentences of the notices as they are printed, normalised, and their identifiers.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit-terms",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "as-is",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-terms",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd-terms",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "as-is",
    "this software is provided by the regents and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "as-is",
    "this software is provided by the author and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "as-is",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-terms",
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-terms",
    "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness": "as-is",
    "the software is provided as is and isc disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness": "as-is",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "0bsd-terms",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-names",
    "neither the name of the author nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-names",
    "neither the name of the university nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-names",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache-as-is",
    "apache license version 2.0 january 2004 http www apache org licenses": "apache-2",
    "apache license version 2.0 january 2004 https www apache org licenses": "apache-2",
    # Cut after the "v." of its version, which can only be 2.0.
    "this source code form is subject to the terms of the mozilla public license v": "mpl-2",
    "mozilla public license version 2.0": "mpl-2",
    "the contents of this file are subject to the mozilla public license version 1.1": "mpl-1.1",
    "this library is free software": "gpl-notice",
    **{
        f"you can redistribute it and or modify it under the terms of the gnu {name}general public license as published by the free software foundation{rest}": f"{short}{found}"
        for name, short in (("", "gpl"), ("library ", "lgpl"), ("lesser ", "lgpl"), ("affero ", "agpl"))
        for rest, found in (("", "-terms"), *((f"{either} version {v} of the license{end}", f"-{v}") for either in ("", " either") for v in ("2", "2.1", "3") for end in ("", " or", " or at your option any later version")))
    },
    **{
        f"you can redistribute it and or modify it under the terms of the gnu {name}general public license version {v} as published by the free software foundation": f"{short}-{v}"
        for name, short in (("", "gpl"), ("library ", "lgpl"), ("lesser ", "lgpl"), ("affero ", "agpl"))
        for v in ("2", "2.1", "3")
    },
    **{f"either version {v} of the license{end}": f"version-{v}" for v in ("2", "2.1", "3") for end in ("", " or")},
    **{f"version {v} of the license{end}": f"version-{v}" for v in ("2", "2.1", "3") for end in ("", " or")},
    "gnu general public license version 2 june 1991": "gpl-2",
    "gnu general public license version 3 29 june 2007": "gpl-3",
    "gnu library general public license version 2 june 1991": "lgpl-2",
    "gnu lesser general public license version 2.1 february 1999": "lgpl-2.1",
    "gnu lesser general public license version 3 29 june 2007": "lgpl-3",
    "gnu affero general public license version 3 19 november 2007": "agpl-3",
}
#: Creative Commons licences by their short and long names.
CREATIVE = {
    "by": "attribution", "by sa": "attribution sharealike", "by nd": "attribution noderivatives", "by nc": "attribution noncommercial",
    "by nc sa": "attribution noncommercial sharealike", "by nc nd": "attribution noncommercial noderivatives",
}
#: Identifiers of the SPDX list, and the licence that each names.
SPDX = {
    "MIT": "mit", "Apache-2.0": "apache-2.0", "BSD-2-Clause": "bsd-2-clause", "BSD-3-Clause": "bsd-3-clause", "ISC": "isc", "0BSD": "0bsd", "Unlicense": "unlicense", "MPL-2.0": "mpl-2.0",
    "CC0-1.0": "cc0-1.0", "CC-BY-4.0": "cc-by-4.0", "CC-BY-SA-4.0": "cc-by-sa-4.0", "CC-BY-NC-4.0": "cc-by-nc-4.0",
    **{f"{name}-{v}{end}": f"{name.lower()}-{v}" for name, versions in (("GPL", ("2.0", "3.0")), ("LGPL", ("2.1", "3.0")), ("AGPL", ("3.0",))) for v in versions for end in ("", "-only", "-or-later", "+")},
}


def normal(sentence: str) -> str:
    """As normalised() does it."""
    low = re.sub(r"\.([^0-9]|\Z)", r" \1", sentence.lower())
    return re.sub(r"[^a-z0-9.]+", " ", low).strip()


def kind_of(licence: str) -> str:
    if "-nc" in licence:
        return "non-commercial"
    return "copyleft" if re.search(r"gpl|mpl|-sa", licence) else "permissive"


KNOWN = SENTENCES | NOTICES
for _code, _name in CREATIVE.items():
    for _v, _end in (("4.0", "international"), ("3.0", "unported")):
        _id = f"cc-{_code.replace(' ', '-')}-{_v}"
        KNOWN |= {f"{start} {what}": _id for start in ("licensed under", "this work is licensed under") for what in (f"cc {_code} {_v}", f"a creative commons {_name} {_v} {_end} license", f"the creative commons {_name} {_v} {_end} license")}
for _name, _short in (("", "gpl"), ("lesser ", "lgpl"), ("affero ", "agpl")):
    for _v in ("2", "2.1", "3"):
        KNOWN |= {f"{start} the gnu {_name}general public license {v}": f"{_short}-{_v}" for start in ("licensed under", "this work is licensed under", "released under") for v in (f"version {_v}", f"v{_v}", f"v{_v}.0")}
KNOWN |= {normal(f"SPDX-License-Identifier {k}"): f"spdx-{k.lower()}" for k in SPDX}
KNOWN |= {normal(f"SPDX-License-Identifier {a} OR {b}"): f"spdx-dual-{a.lower()}-{b.lower()}" for a, b in (("MIT", "Apache-2.0"), ("Apache-2.0", "MIT"))}

COPYLEFT_NOTICES = [
    *((f"{short}-{v}{'' if '.' in v else '.0'}", "copyleft", needed) for short in ("agpl", "lgpl") for v in ("3", "2.1", "2") for needed in ([f"{short}-{v}"], [f"{short}-terms", f"version-{v}"])),
    *((f"gpl-{v}.0", "copyleft", ["gpl-terms", f"version-{v}"]) for v in ("3", "2")),
    *((f"{short}-unversioned", "copyleft", [f"{short}-terms"]) for short in ("agpl", "lgpl")),
    ("mpl-2.0", "copyleft", ["mpl-2"]),
    ("mpl-1.1", "copyleft", ["mpl-1.1"]),
]
PERMISSIVE_NOTICES = [("mit", "permissive", ["mit-terms"]), ("bsd-3-clause", "permissive", ["bsd-terms", "bsd-names"]), ("bsd", "permissive", ["bsd-terms"]), ("bsd", "permissive", ["bsd"]), ("isc", "permissive", ["isc-terms"]), ("isc", "permissive", ["isc"]), ("0bsd", "permissive", ["0bsd-terms"]), ("unlicense", "permissive", ["unlicense"])]
OF_SPDX = [("dual-mit-apache", "permissive", ["spdx-dual-mit-apache-2.0"]), ("dual-apache-mit", "permissive", ["spdx-dual-apache-2.0-mit"]), *((name, kind_of(name), [f"spdx-{k.lower()}"]) for k, name in SPDX.items())]
OF_CREATIVE = [(name, kind_of(name), [name]) for code in CREATIVE for v in ("4.0", "3.0") for name in (f"cc-{code.replace(' ', '-')}-{v}",) if not any(r[2] == [name] for r in RULES)]
#: What a file says of itself comes first, then dual licences; a full text's "All rights reserved" comes last.
ALL_RULES = [*OF_SPDX, *RULES[:2], *COPYLEFT_NOTICES, *RULES[2:5], *OF_CREATIVE, *RULES[5:-1], *PERMISSIVE_NOTICES, RULES[-1]]
#: Every known sentence has one of these: a text without them needs no cutting.
CUES = ("licens", "permi", "free software", "software is provided", "rights reserved", "public domain")

#: Marks of comments at the beginning of a line, the name of a tag whose colon is no stop, and what ends a sentence.
COMMENT, TAG, STOP = r"\n[ \t]*[;/*#%>|-]+", r"spdx-license-identifier:[ \t]*", r"[.;:!?]+[*_]*([ \t\r\n]+|\z)|[()\[\]{}]|\n[^a-z0-9]*\n"


def prepared(text: Column) -> Column:
    low = F.concat(F.lit("\n"), ascii_lower(F.coalesce(text, F.lit(""))))
    return F.regexp_replace(F.regexp_replace(low, COMMENT, "\n"), TAG, "spdx-license-identifier ")


def normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(sentence, r"\.([^0-9]|\z)", " $1"), r"[^a-z0-9.]+", " "))


def sentence_ids(text: Column) -> Column:
    """The identifiers of the known sentences of a text, in order."""
    low = prepared(text)
    known = F.create_map(*[F.lit(x) for pair in KNOWN.items() for x in pair])

    def lines_of(sentence: Column) -> Column:
        return F.filter(F.transform(F.split(sentence, "\n"), normalised), lambda line: line != "")

    def ids_of(lines: Column) -> Column:
        whole = F.when(F.size(lines) > 1, F.array(F.array_join(lines, " "))).otherwise(F.array().cast("array<string>"))
        return F.array_compact(F.transform(F.concat(lines, whole), lambda s: known[s]))

    found = F.flatten(F.transform(F.transform(F.split(low, STOP), lines_of), ids_of))
    likely = F.lit(False)
    for cue in CUES:
        likely = likely | F.coalesce(text, F.lit("")).rlike("(?i)" + cue.replace(" ", "[^a-z0-9]+"))
    return F.when(likely, found).otherwise(F.expr("cast(array() as array<string>)"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, sentence_ids, licence, kind), one row per row of docs."""
    ids = docs.select(F.col(id_col).alias("doc_id"), sentence_ids(F.col(text_col)).alias("sentence_ids"))
    line = F.concat(F.lit(" "), F.array_join("sentence_ids", " "), F.lit(" "))
    found, kind = F.lit("none"), F.lit("none")
    for name, sort, needed in reversed(ALL_RULES):
        holds = line.rlike(rule_pattern(needed))
        found, kind = F.when(holds, name).otherwise(found), F.when(holds, sort).otherwise(kind)
    none = F.size("sentence_ids") == 0
    return ids.select("doc_id", "sentence_ids", F.when(none, "none").otherwise(found).alias("licence"), F.when(none, "none").otherwise(kind).alias("kind"))


def rule_pattern(needed: list[str]) -> str:
    return " " + " (.* )?".join(re.escape(x) for x in needed) + " "


def sql(table: str = "documents") -> str:
    """The same scan in DuckDB's SQL."""
    known = ", ".join(f"('{k}', '{v}')" for k, v in KNOWN.items())
    cases = [" ".join(f"WHEN regexp_matches(line, '{rule_pattern(r[2])}') THEN '{r[k]}'" for r in ALL_RULES) for k in (0, 1)]
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    prep = f"regexp_replace(regexp_replace(chr(10) || translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{COMMENT}', chr(10), 'g'), '{TAG}', 'spdx-license-identifier ', 'g')"
    norm = r"trim(regexp_replace(regexp_replace(s, '\.([^0-9]|\z)', ' \1', 'g'), '[^a-z0-9.]+', ' ', 'g'))"
    return f"""
WITH known(sentence, id) AS (VALUES {known}),
cut AS (SELECT doc_id, regexp_split_to_array({prep}, '{STOP}') AS parts FROM {table}),
hard AS (SELECT doc_id, unnest(parts) AS h, generate_subscripts(parts, 1) AS i FROM cut),
fine AS (SELECT doc_id, i, unnest(string_split(h, chr(10))) AS s, generate_subscripts(string_split(h, chr(10)), 1) AS j FROM hard WHERE h <> ''),
norm AS (SELECT doc_id, i, j, {norm} AS sentence FROM fine),
whole AS (SELECT doc_id, i, 1000000000 AS j, string_agg(sentence, ' ' ORDER BY j) AS sentence FROM norm WHERE sentence <> '' GROUP BY doc_id, i HAVING count(*) > 1),
hits AS (SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY i, j) AS ids, ' ' || string_agg(id, ' ' ORDER BY i, j) || ' ' AS line
  FROM (SELECT * FROM norm UNION ALL SELECT * FROM whole) JOIN known USING (sentence) GROUP BY doc_id),
lines AS (SELECT d.doc_id, coalesce(n, 0) AS n_sentences, coalesce(ids, '') AS sentence_ids, coalesce(line, '  ') AS line FROM {table} d LEFT JOIN hits h ON d.doc_id = h.doc_id)
SELECT doc_id, n_sentences, sentence_ids, CASE {cases[0]} ELSE 'none' END AS licence, CASE {cases[1]} ELSE 'none' END AS kind FROM lines"""
