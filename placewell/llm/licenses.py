"""Licence scans by sentence rules: known sentences become identifiers, rules match their order.

Everything is a DataFrame expression. Lines are freed of comment and list marks and
joined, unless one is blank or begins or ends with a known sentence; the text is then cut
at sentence ends, each sentence is normalised and looked up, and neighbouring known
sentences form runs. Rules are tried in order on the runs; what a rule has matched is used
up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Identifier and the normalised sentences (lower case, signs as one blank) it stands for.
SENTENCES = {
    "MIT_REF": ("released under the mit license", "licensed under the mit license", "the mit license", "mit license",
                "this project is licensed under the mit license", "the mit license mit", "distributed under the mit license"),
    "MIT_GRANT": ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
                  "documentation files the software to deal in the software without restriction including without limitation "
                  "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
                  "permit persons to whom the software is furnished to do so subject to the following conditions",),
    "MIT_NOTICE": ("the above copyright notice and this permission notice shall be included in all copies or substantial "
                   "portions of the software",),
    "AS_IS": ("the software is provided as is without warranty of any kind express or implied including but not limited to "
              "the warranties of merchantability fitness for a particular purpose and noninfringement",),
    "APACHE2_REF": ("licensed under the apache license version 2 0", "licensed under the apache license version 2 0 the license",
                    "apache license version 2 0", "released under the apache license version 2 0",
                    "this project is licensed under the apache license version 2 0"),
    "APACHE2_USE": ("you may not use this file except in compliance with the license",),
    "APACHE2_COPY": ("you may obtain a copy of the license at",
                     "you may obtain a copy of the license at http www apache org licenses license 2 0"),
    "APACHE2_URL": ("http www apache org licenses license 2 0", "https www apache org licenses license 2 0"),
    "APACHE2_BASIS": ("unless required by applicable law or agreed to in writing software distributed under the license is "
                      "distributed on an as is basis without warranties or conditions of any kind either express or implied",),
    "APACHE2_SEE": ("see the license for the specific language governing permissions and limitations under the license",),
    "GPL3_REF": ("this work is licensed under the gnu general public license version 3",
                 "licensed under the gnu general public license version 3", "gnu general public license version 3",
                 "released under the gnu general public license version 3"),
    "GPL2_REF": ("licensed under the gnu general public license version 2", "gnu general public license version 2",
                 "this work is licensed under the gnu general public license version 2"),
    "GPL_FREE": ("this program is free software",),
    "GPL3_LATER": ("you can redistribute it and or modify it under the terms of the gnu general public license as published by "
                   "the free software foundation either version 3 of the license or at your option any later version",),
    "GPL2_LATER": ("you can redistribute it and or modify it under the terms of the gnu general public license as published by "
                   "the free software foundation either version 2 of the license or at your option any later version",),
    "GPL_HOPE": ("this program is distributed in the hope that it will be useful but without any warranty",),
    "GPL_IMPLIED": ("without even the implied warranty of merchantability or fitness for a particular purpose",),
    "BSD_USE": ("redistribution and use in source and binary forms with or without modification are permitted provided that the "
                "following conditions are met",),
    "BSD_SOURCE": ("redistributions of source code must retain the above copyright notice this list of conditions and the "
                   "following disclaimer",),
    "BSD_BINARY": ("redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
                   "following disclaimer in the documentation and or other materials provided with the distribution",),
    "BSD_NAMES": ("neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                  "products derived from this software without specific prior written permission",),
    "BSD3_REF": ("licensed under the bsd 3 clause license", "released under the bsd 3 clause license", "bsd 3 clause license"),
    "BSD2_REF": ("licensed under the bsd 2 clause license", "released under the bsd 2 clause license", "bsd 2 clause license"),
    "MPL2_REF": ("this source code form is subject to the terms of the mozilla public license v 2 0",
                 "licensed under the mozilla public license version 2 0"),
    "CC_BY_NC4_REF": ("licensed under cc by nc 4 0", "this work is licensed under cc by nc 4 0",
                      "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    "CC_BY_SA4_REF": ("licensed under cc by sa 4 0", "this work is licensed under cc by sa 4 0",
                      "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    "CC_BY4_REF": ("licensed under cc by 4 0", "this work is licensed under cc by 4 0",
                   "this work is licensed under a creative commons attribution 4 0 international license"),
    "CC0_REF": ("licensed under cc0 1 0", "released under cc0 1 0", "cc0 1 0 universal"),
    "RESERVED": ("all rights reserved",),
}
# Licence and the identifiers that state it, next to each other, in the order in which rules are tried.
RULES = (
    ("Apache-2.0", ("APACHE2_REF", "APACHE2_USE", "APACHE2_COPY", "APACHE2_URL", "APACHE2_BASIS", "APACHE2_SEE")),
    ("Apache-2.0", ("APACHE2_REF", "APACHE2_USE", "APACHE2_COPY", "APACHE2_BASIS", "APACHE2_SEE")),
    ("MIT", ("MIT_REF", "MIT_GRANT", "MIT_NOTICE", "AS_IS")),
    ("MIT", ("MIT_GRANT", "MIT_NOTICE", "AS_IS")),
    ("BSD-3-Clause", ("BSD_USE", "BSD_SOURCE", "BSD_BINARY", "BSD_NAMES")),
    ("BSD-2-Clause", ("BSD_USE", "BSD_SOURCE", "BSD_BINARY")),
    ("GPL-3.0-or-later", ("GPL_FREE", "GPL3_LATER", "GPL_HOPE", "GPL_IMPLIED")),
    ("GPL-2.0-or-later", ("GPL_FREE", "GPL2_LATER", "GPL_HOPE", "GPL_IMPLIED")),
    ("GPL-3.0-or-later", ("GPL_FREE", "GPL3_LATER")),
    ("GPL-2.0-or-later", ("GPL_FREE", "GPL2_LATER")),
    ("Apache-2.0", ("APACHE2_REF",)),
    ("MIT", ("MIT_REF",)),
    ("GPL-3.0-only", ("GPL3_REF",)),
    ("GPL-2.0-only", ("GPL2_REF",)),
    ("BSD-3-Clause", ("BSD3_REF",)),
    ("BSD-2-Clause", ("BSD2_REF",)),
    ("MPL-2.0", ("MPL2_REF",)),
    ("CC-BY-NC-4.0", ("CC_BY_NC4_REF",)),
    ("CC-BY-SA-4.0", ("CC_BY_SA4_REF",)),
    ("CC-BY-4.0", ("CC_BY4_REF",)),
    ("CC0-1.0", ("CC0_REF",)),
    ("all-rights-reserved", ("RESERVED",)),
)
LINE_ENDS = r"\r\n|[\n\r]"
# Comment signs and the number or letter of a list item, at the start of a line.
MARKS = r"^[ \t]*(?:(?:[*#>;%|+-]+|//+|/\*+|\*/|<!--|-->|\(?(?:[0-9]{1,2}|[A-Za-z]|[ivx]{1,4})[.)])(?:[ \t]+|$)){0,8}"
SENTENCE_ENDS = r"(?<=[.!?;:])[ \t]+"
SIGNS = r"[^a-z0-9]+"
ITEM = r"^(?:[0-9]{1,2}|[a-z]|[ivx]{1,4})$"  # what is left of a list mark inside a line
# Every known sentence has one of these; texts without any need not be cut.
WORDS = ("licens", "software", "reserved", "warrant", "copyright", "redistribut", "cc0", "cc by", "cc-by")


def patterns(rules=RULES) -> list[tuple[str, str]]:
    """Licence and the text that its identifiers make in a run."""
    return [(name, "," + ",".join(ids) + ",") for name, ids in rules]


def sentence_runs(text: Column, sentences=SENTENCES) -> Column:
    """Identifiers in text order as ``,A,B,;,C,``: unknown sentences end a run. Null text: empty."""
    known = {s: name for name, found in sentences.items() for s in found}
    table = F.create_map(*[F.lit(x) for pair in sorted(known.items()) for x in pair])
    plain = lambda s: F.trim(F.regexp_replace(F.lower(s), SIGNS, " "))
    name = lambda s: F.try_element_at(table, plain(s))

    def joined_line(line: Column) -> Column:
        first = F.regexp_extract(line, r"^(.*?[.!?;:](?=[ \t])|.*$)", 1)
        last = F.regexp_extract(line, r"^(?:.*[.!?;:][ \t]+)?(.*)$", 1)
        before = F.when(name(first).isNotNull(), F.lit("\n")).otherwise(F.lit(""))
        after = F.when((F.trim(line) == "") | name(last).isNotNull(), F.lit("\n")).otherwise(F.lit(" "))
        return F.concat(before, line, after)

    lines = F.transform(F.split(text, LINE_ENDS), lambda x: F.regexp_replace(x, MARKS, ""))
    whole = F.array_join(F.transform(lines, joined_line), "")
    spelled = F.filter(F.split(whole, "\n|" + SENTENCE_ENDS),
                       lambda s: s.rlike("[A-Za-z0-9]") & ~plain(s).rlike(ITEM))
    named = F.transform(spelled, lambda s: F.coalesce(name(s), F.lit(";")))
    joined = F.concat(F.lit(","), F.array_join(named, ","), F.lit(","))
    # Unknown sentences fold into one mark; marks at the ends go.
    folded = F.regexp_replace(joined, r"(,;)+,", ",;,")
    folded = F.regexp_replace(F.regexp_replace(folded, r"^(,;)?,+$|^,;(?=,)", ""), r"(?<=,);,$", "")
    return F.when(text.rlike("(?i)" + "|".join(WORDS)), folded).otherwise(F.lit(""))


def licences(runs: Column, rules=RULES) -> Column:
    """Licences that the rules find, in the order of the rules, each once."""
    tried = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(p).alias("ids")) for n, p in patterns(rules)])
    start = F.struct(runs.alias("runs"), F.array().cast("array<string>").alias("found"))

    def step(state: Column, rule: Column) -> Column:
        hit = F.contains(state["runs"], rule["ids"])
        return F.struct(
            F.replace(state["runs"], rule["ids"], F.lit(",;,")).alias("runs"),
            F.when(hit, F.array_union(state["found"], F.array(rule["name"]))).otherwise(state["found"]).alias("found"))

    return F.aggregate(tried, start, step)["found"]


def scan(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with a struct ``licence``: sentence_ids, n_sentences and names.

    sentence_ids are the identifiers of known sentences in text order (``;`` where others
    lie between), names the licences found, in rule order. Null and empty texts and texts
    without a known sentence have an empty string, 0 and an empty list. Whole texts are
    read; a sentence may stand anywhere and any number of times. Repeated rows are scanned
    alike. Every column of ``docs`` is returned; one named ``licence`` is replaced. No
    rows give no rows.
    """
    runs = sentence_runs(F.col(text_column))
    row = docs.drop("licence")
    held = row.select(F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in row.columns]).alias("row"),
                      F.transform(F.array(runs), lambda r: F.struct(r.alias("runs"), licences(r).alias("names")))[0].alias("f"))
    known = F.filter(F.split("f.runs", ","), lambda x: (x != "") & (x != ";"))
    return held.select("row.*", F.struct(
        F.regexp_replace("f.runs", "^,|,$", "").alias("sentence_ids"),
        F.size(known).cast("bigint").alias("n_sentences"), F.col("f.names").alias("names")).alias("licence"))
