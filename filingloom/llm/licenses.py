"""License scans: known sentences become identifiers, ordered rules read the sequence of identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingloom.llm.common import running

# SPDX identifier, then the names by which a sentence may call the licence (normalised).
NAMES = {
    "MIT": ["mit license", "mit/x11 license", "expat license", "mit"],
    "Apache-2.0": ["apache license version 2.0", "apache license 2.0", "apache 2.0 license", "apache-2.0 license", "apache software license 2.0", "apache-2.0"],
    "BSD-2-Clause": ["bsd 2-clause license", "2-clause bsd license", "simplified bsd license", "freebsd license", "bsd-2-clause license"],
    "BSD-3-Clause": ["bsd 3-clause license", "3-clause bsd license", "new bsd license", "modified bsd license", "revised bsd license", "bsd-3-clause license"],
    "BSD": ["bsd license", "bsd-style license", "bsd"],
    "ISC": ["isc license", "isc"],
    "Zlib": ["zlib license", "zlib/libpng license"],
    "BSL-1.0": ["boost software license version 1.0", "boost software license 1.0", "boost software license"],
    "GPL-2.0-only": ["gnu general public license version 2", "gnu general public license v2", "gnu gpl version 2", "gnu gpl v2", "gpl version 2", "gplv2", "gpl v2", "gnu gplv2", "gpl-2.0"],
    "GPL-3.0-only": ["gnu general public license version 3", "gnu general public license v3", "gnu gpl version 3", "gnu gpl v3", "gpl version 3", "gplv3", "gpl v3", "gnu gplv3", "gpl-3.0"],
    "GPL": ["gnu general public license", "gnu gpl", "gpl"],
    "LGPL-2.1-only": ["gnu lesser general public license version 2.1", "gnu lgpl version 2.1", "lgpl version 2.1", "lgplv2.1", "gnu lgplv2.1", "lgpl-2.1"],
    "LGPL-3.0-only": ["gnu lesser general public license version 3", "gnu lgpl version 3", "lgpl version 3", "lgplv3", "gnu lgplv3", "lgpl-3.0"],
    "LGPL": ["gnu lesser general public license", "gnu lgpl", "lgpl"],
    "AGPL-3.0-only": ["gnu affero general public license version 3", "gnu agpl version 3", "agpl version 3", "agplv3", "gnu agplv3", "agpl-3.0"],
    "AGPL": ["gnu affero general public license", "gnu agpl", "agpl"],
    "MPL-2.0": ["mozilla public license version 2.0", "mozilla public license 2.0", "mozilla public license v. 2.0", "mpl 2.0", "mpl-2.0"],
    "EPL-1.0": ["eclipse public license version 1.0", "eclipse public license 1.0", "eclipse public license v1.0", "epl-1.0"],
    "EPL-2.0": ["eclipse public license version 2.0", "eclipse public license 2.0", "eclipse public license v2.0", "epl-2.0"],
    "CDDL-1.0": ["common development and distribution license version 1.0", "common development and distribution license 1.0", "cddl-1.0"],
    "Artistic-2.0": ["artistic license 2.0", "artistic license version 2.0", "artistic-2.0"],
    "CC0-1.0": ["cc0 1.0 universal", "cc0 1.0", "creative commons zero v1.0 universal", "cc0"],
    "CC-BY-4.0": ["cc by 4.0", "cc-by-4.0", "creative commons attribution 4.0 international license", "creative commons attribution 4.0"],
    "CC-BY-SA-4.0": ["cc by-sa 4.0", "cc-by-sa-4.0", "creative commons attribution-sharealike 4.0 international license", "creative commons attribution-sharealike 4.0"],
    "CC-BY-NC-4.0": ["cc by-nc 4.0", "cc-by-nc-4.0", "creative commons attribution-noncommercial 4.0 international license", "creative commons attribution-noncommercial 4.0"],
    "CC-BY-ND-4.0": ["cc by-nd 4.0", "cc-by-nd-4.0", "creative commons attribution-noderivatives 4.0 international license"],
    "CC-BY-NC-SA-4.0": ["cc by-nc-sa 4.0", "cc-by-nc-sa-4.0", "creative commons attribution-noncommercial-sharealike 4.0 international license"],
    "CC-BY-SA-3.0": ["cc by-sa 3.0", "cc-by-sa-3.0", "creative commons attribution-sharealike 3.0 unported license"],
    "CC-BY-3.0": ["cc by 3.0", "cc-by-3.0", "creative commons attribution 3.0 unported license"],
    "Unlicense": ["unlicense"],
    "WTFPL": ["wtfpl", "do what the fuck you want to public license"],
}
# How such sentences begin; each stands before each name.
OPENINGS = [f"{subject}{verb} {the}" for subject in ("", "this project is ", "this work is ", "this software is ", "this program is ", "this library is ", "this file is ", "this code is ", "the code is ", "this package is ", "this repository is ", "this document is ") for verb in ("licensed under", "released under", "distributed under", "made available under", "available under", "published under") for the in ("the terms of the ", "the ", "a ", "")]
# SPDX identifiers of a tag line that differ from the names above.
TAGS = {"mit": "MIT", "bsd-2-clause": "BSD-2-Clause", "bsd-3-clause": "BSD-3-Clause", "isc": "ISC", "zlib": "Zlib", "bsl-1.0": "BSL-1.0", "cc0-1.0": "CC0-1.0", "unlicense": "Unlicense", "wtfpl": "WTFPL", "gpl-2.0-only": "GPL-2.0-only", "gpl-3.0-only": "GPL-3.0-only", "gpl-2.0-or-later": "GPL-2.0-or-later", "gpl-3.0-or-later": "GPL-3.0-or-later", "gpl-2.0+": "GPL-2.0-or-later", "gpl-3.0+": "GPL-3.0-or-later", "lgpl-2.1-only": "LGPL-2.1-only", "lgpl-2.1-or-later": "LGPL-2.1-or-later", "lgpl-3.0-only": "LGPL-3.0-only", "lgpl-3.0-or-later": "LGPL-3.0-or-later", "agpl-3.0-only": "AGPL-3.0-only", "agpl-3.0-or-later": "AGPL-3.0-or-later"}
# Sentences of licence texts and notices, normalised (lower case, no punctuation but . + - /), with identifiers.
SENTENCES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and/or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit-as-is",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "mit-liability",
    "licensed under the apache license version 2.0 the license": "apache-grant",
    "you may not use this file except in compliance with the license": "apache-use",
    "you may obtain a copy of the license at": "apache-copy",
    "you may obtain a copy of the license at http //www.apache.org/licenses/license-2.0": "apache-copy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache-as-is",
    "see the license for the specific language governing permissions and limitations under the license": "apache-see",
    "this program is free software you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3-later",
    "this program is free software you can redistribute it and/or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl2-later",
    "this program is free software you can redistribute it and/or modify it under the terms of the gnu general public license version 2 as published by the free software foundation": "gpl2-only",
    "this library is free software you can redistribute it and/or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2.1 of the license or at your option any later version": "lgpl21-later",
    "this library is free software you can redistribute it and/or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "lgpl3-later",
    "this program is free software you can redistribute it and/or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "lgpl3-later",
    "this program is free software you can redistribute it and/or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "agpl3-later",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "gnu-no-warranty",
    "this program is distributed in the hope that it will be useful but without any warranty": "gnu-no-warranty",
    "this library is distributed in the hope that it will be useful but without any warranty": "gnu-no-warranty",
    "without even the implied warranty of merchantability or fitness for a particular purpose": "gnu-implied",
    "see the gnu general public license for more details": "gnu-see",
    "see the gnu lesser general public license for more details": "gnu-see",
    "see the gnu affero general public license for more details": "gnu-see",
    "you should have received a copy of the gnu general public license along with this program": "gnu-copy",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-names",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "bsd-as-is",
    "permission to use copy modify and/or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness": "isc-as-is",
    "this source code form is subject to the terms of the mozilla public license v. 2.0": "mpl2-grant",
    "if a copy of the mpl was not distributed with this file you can obtain one at https //mozilla.org/mpl/2.0": "mpl2-copy",
    "if a copy of the mpl was not distributed with this file you can obtain one at http //mozilla.org/mpl/2.0": "mpl2-copy",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2.0 which is available at https //www.eclipse.org/legal/epl-2.0": "epl2-grant",
    "this program and the accompanying materials are made available under the terms of the eclipse public license v1.0 which accompanies this distribution": "epl1-grant",
    "this software is provided as-is without any express or implied warranty": "zlib-as-is",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "zlib-grant",
    "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third-parties to whom the software is furnished to do so all subject to the following": "bsl-grant",
    "this is free and unencumbered software released into the public domain": "unlicense-grant",
    "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non-commercial and by any means": "unlicense-anyone",
    "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work": "cc0-grant",
    "the person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law": "cc0-grant",
    "you just do what the fuck you want to": "wtfpl-grant",
    "all rights reserved": "rights-reserved",
    "this software is proprietary and confidential": "proprietary",
    "unauthorized copying of this file via any medium is strictly prohibited": "proprietary",
}
# The GNU notices' clauses. Their texts have a colon, a semicolon or a comma between them, or nothing.
GNU = {"gpl": "general public license", "lgpl": "lesser general public license", "agpl": "affero general public license"}
TERMS = {k: f"you can redistribute it and/or modify it under the terms of the gnu {name} as published by the free software foundation" for k, name in GNU.items()}
LATER = {v: f"either version {v} of the license or at your option any later version" for v in ("2", "2.1", "3")}
SENTENCES |= {text: f"{k}-terms" for k, text in TERMS.items()} | {text: f"later-{v}" for v, text in LATER.items()}
SENTENCES |= {f"{TERMS[k]} {LATER[v]}": f"{k}{v.replace('.', '')}-later" for k, v in (("gpl", "2"), ("gpl", "3"), ("lgpl", "2.1"), ("lgpl", "3"), ("agpl", "3"))}
SENTENCES |= {f"{TERMS['gpl']} version 2": "gpl2-only", f"{TERMS['gpl']} version 2 of the license": "gpl2-only", "version 2 of the license": "only-2"}
SENTENCES |= {TERMS["gpl"].replace("license as", "license version 2 as"): "gpl2-only"}
SENTENCES |= {f"you should have received a copy of the gnu {name} along with this {what}": "gnu-copy" for name in GNU.values() for what in ("program", "library")}
REST = "(?:gnu-no-warranty;)?(?:gnu-implied;)?(?:gnu-see;)?(?:gnu-copy;)?"
# Rules in order; each reads a sequence of identifiers (";" ends one) and takes what it matches. Rules of names follow.
RULES = [
    ("MIT", "mit-grant;(?:mit-notice;)?(?:mit-as-is;)?(?:mit-liability;)?"),
    ("Apache-2.0", "apache-grant;(?:apache-use;)?(?:apache-copy;)?(?:apache-as-is;)?(?:apache-see;)?"),
    ("GPL-3.0-or-later", f"(?:gpl3-later|gpl-terms;later-3);{REST}"),
    ("GPL-2.0-or-later", f"(?:gpl2-later|gpl-terms;later-2);{REST}"),
    ("GPL-2.0-only", f"(?:gpl2-only|gpl-terms;only-2);{REST}"),
    ("LGPL-2.1-or-later", f"(?:lgpl21-later|lgpl-terms;later-2.1);{REST}"),
    ("LGPL-3.0-or-later", f"(?:lgpl3-later|lgpl-terms;later-3);{REST}"),
    ("AGPL-3.0-or-later", f"(?:agpl3-later|agpl-terms;later-3);{REST}"),
    ("BSD-3-Clause", "bsd-grant;bsd-source;bsd-binary;bsd-names;(?:bsd-as-is;)?"),
    ("BSD-2-Clause", "bsd-grant;bsd-source;bsd-binary;(?:bsd-as-is;)?"),
    ("BSD", "bsd-grant;(?:bsd-source;)?"),
    ("ISC", "isc-grant;(?:isc-as-is;)?"),
    ("MPL-2.0", "mpl2-grant;(?:mpl2-copy;)?"),
    ("EPL-2.0", "epl2-grant;"),
    ("EPL-1.0", "epl1-grant;"),
    ("Zlib", "(?:zlib-as-is;)?zlib-grant;"),
    ("BSL-1.0", "bsl-grant;"),
    ("Unlicense", "unlicense-grant;(?:unlicense-anyone;)?"),
    ("CC0-1.0", "cc0-grant;"),
    ("WTFPL", "wtfpl-grant;"),
    ("Proprietary", "(?:rights-reserved;|proprietary;)+"),  # after the names
]
# Every known sentence holds one of these words; texts and sentences without any aren't looked at.
TRIGGERS = ["licens", "licenc", "permission", "permitted", "copyright", "warrant", "redistribut", "unencumbered", "reserved", "proprietary", "unauthori", "waive", "anyone", "endorse", "liable", "fuck", "obtain", "released", "distributed", "available", "published"]
FOUND = "struct<start:int,kind:int,end:int,id:string>"
END = r"(?<=[.!?;:]\s)(?<!identifier:\s)(?<!\blicen[sc]e:\s)(?<!\bv\.\s)"
#: What stands before a line of a comment, in any language: its marks go, and a line of marks alone is blank.
MARKS = r"(?m)^[ \t]*(?:#+|//+!?|/\*+|\*+/?|--+|;+|%+|!+|<!--|dnl|rem|\x22{3}|'{3})(?:[ \t]+|$)"
#: Sentences that hold a holder's name: what stands before the rights reserved doesn't matter.
HOLDER = r"^(?:copyright|c|©)\s.*\sall rights reserved$"


def hinted(text: Column) -> Column:
    there = text.contains(TRIGGERS[0])
    for word in TRIGGERS[1:]:
        there = there | text.contains(word)
    return there


def bare(sentence: Column) -> Column:
    """Runs of other characters than letters, digits and . + - / become a space, as do words of only such signs and a number
    before the first word; none at the ends, and no final stops. Licence is spelt license."""
    kept = F.regexp_replace(F.regexp_replace(sentence, r"[^\p{L}\p{N}.+/©-]+", " "), r"(?<=\x20)[.+/-]+\x20", "")
    kept = F.regexp_replace(F.regexp_replace(kept, r"^[\x20.+/-]+|[\x20./-]+$", ""), r"^[0-9] (?=\p{L})", "")
    return F.replace(kept, F.lit("licence"), F.lit("license"))


def table(pairs: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for pair in pairs.items() for x in pair))


def listed(text: Column, known: Column) -> Column:
    """name:<licence> of each licence that a text lists by and, or, with, joined by semicolons; null where it names none. "or any
    later version" belongs to the name before it."""
    later = F.regexp_replace(text, r" or (?:at your option )?(?:any )?(?:later|newer)(?: versions?)?(?= |$)", "+")
    parts = F.split(F.regexp_replace(later, "^either (?:of )?(?:the )?|^both (?:the )?", ""), " (?:or|and|with) (?:the )?")
    one = lambda p: F.coalesce(F.try_element_at(known, p), F.regexp_replace(F.try_element_at(known, F.regexp_replace(p, r"\+$", "")), "-only$", "-or-later"))
    found = F.filter(F.transform(parts, one), lambda x: x.isNotNull())
    return F.nullif(F.array_join(found, ";"), F.lit(""))


def sentence_id(sentence: Column) -> Column:
    """The identifier of a bare sentence, or null. Sentences by rule are told by their parts: an opening, or a tag, then names."""
    openings = "|".join(sorted({o.strip() for o in OPENINGS}, key=len, reverse=True))
    names = {n: f"name:{licence}" for licence, every in NAMES.items() for n in every}
    tags = names | {t: f"name:{licence}" for t, licence in TAGS.items()}
    held = F.when(sentence.rlike(HOLDER), F.lit("rights-reserved"))
    after = lambda opening, known: F.when(sentence.rlike(rf"^(?:{opening}) "), listed(F.regexp_extract(sentence, rf"^(?:{opening}) (.+)$", 1), table(known)))
    return F.coalesce(F.try_element_at(table(SENTENCES), sentence), held, after(openings, names), after("spdx-license-identifier|license", tags))


def scan_licenses(documents: DataFrame) -> DataFrame:
    """doc_id, n_sentences, sentences (identifiers) and licenses (by rule, each once) of every row.

    A sentence is looked for in each line, and in lines joined up to a blank one, since licence texts are wrapped. Findings
    of both ways count (comment marks before lines are no part of them), in the order of the text; a line's within a joined sentence that is known is left out. A null or empty text has none.
    Repeated rows each get a row, further columns take no part, an empty table gives no rows.
    """
    low = F.lower(F.coalesce("text", F.lit("")))
    d = documents.select("doc_id", low.alias("low")).select("doc_id", F.when(hinted(F.col("low")), F.regexp_replace("low", MARKS, "")).otherwise(F.lit("")).alias("low"))
    # pieces keep every character, and joining changes no length, so both ways count the same offsets
    lines = F.split("low", rf"(?<=\n)|{END}")
    joined = F.split(F.regexp_replace("low", r"\n(?!\s*\n)", " "), rf"(?<=\n)|{END}")
    d = d.select("doc_id", F.when(F.length("low") > 0, lines).alias("a"), F.when(F.length("low") > 0, joined).alias("b"))

    known = lambda pieces: F.transform(F.transform(pieces, lambda p: F.when(hinted(p), bare(p))), lambda x: F.when(x.isNotNull(), sentence_id(x)))
    d = d.withColumns({"x": known("a"), "y": known("b")})

    def found(pieces: str, ids: str, kind: int) -> Column:
        """(start, kind, end, id) of the known sentences. Arrays that lambdas would look up are zipped: each is computed once."""

        def step(at: Column, i: Column) -> tuple[Column, Column]:
            end = at + F.length(F.get(pieces, i))
            return end, F.struct(at.alias("start"), end.alias("end"))

        places = running(F.coalesce(F.size(pieces), F.lit(0)), step, "struct<start:int,end:int>")
        both = F.zip_with(places, F.coalesce(ids, F.array().cast("array<string>")), lambda p, x: F.struct(p["start"].alias("start"), F.lit(kind).alias("kind"), p["end"].alias("end"), x.alias("id")))
        return F.filter(both, lambda f: f["id"].isNotNull())

    d = d.select("doc_id", F.array_sort(F.concat(found("b", "y", 0), found("a", "x", 1))).alias("f"))

    def outside(at: Column, i: Column) -> tuple[Column, Column]:
        """Each line lies within one joined sentence, which comes first: a line within a known one isn't kept."""
        f = F.get("f", i)
        return F.when(f["kind"] == 0, f["end"]).otherwise(at), (f["kind"] == 0) | (f["start"] >= at)

    kept = F.filter(F.zip_with("f", running(F.size("f"), outside, "boolean"), lambda f, k: F.struct(f["id"].alias("id"), k.alias("kept"))), lambda z: z["kept"])
    d = d.select("doc_id", F.transform(kept, lambda z: z["id"]).alias("ids"))
    d = d.withColumns({"rest": F.concat(F.array_join("ids", ";"), F.when(F.size("ids") > 0, F.lit(";")).otherwise(F.lit(""))), "out": F.array().cast("array<string>")})
    for licence, rule in RULES:
        if licence == RULES[-1][0]:
            d = d.withColumn("out", F.concat("out", F.transform(F.filter(F.split("rest", ";"), lambda x: x.startswith("name:")), lambda x: F.substring(x, len("name:") + 1, 100))))
        whole = rf"(?:^|(?<=;)){rule}"
        d = d.withColumn("out", F.when(F.col("rest").rlike(whole), F.array_append("out", F.lit(licence))).otherwise(F.col("out")))
        d = d.withColumn("rest", F.regexp_replace("rest", whole, ";"))
    return d.select("doc_id", F.size("ids").cast("long").alias("n_sentences"), F.array_join("ids", ";").alias("sentences"), F.array_join(F.array_distinct("out"), ",").alias("licenses"))
