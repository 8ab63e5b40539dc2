"""Licence recognition by sentences and ordered rules, in built-in functions only.

A text is cut into sentences. Those that hold a licence word are normalised and looked up among the known
licence sentences, which have identifiers; others get UNKNOWN. The identifiers in text order are matched against
the rules one after the other: a rule is a run of identifiers, and what a rule has matched is used up, so longer
rules come first. Every text is scanned whole, row by row, with no shuffle.

Known sentences are found however their lines are broken: between their words may stand line breaks, comment marks and
empty lines. They start at a line or after a sentence and end at punctuation or at a line's end. Other text ends a sentence at
every line break, so a one-line mention between lines without punctuation counts too. The SQL reads line by line
and knows no third BSD clause; it agrees where no licence sentence is wrapped and no such clause follows a BSD run.

Null and empty texts have no sentences. Repeated sentences are listed as often as they stand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "UNKNOWN"
#: Every known sentence holds one of these.
WORD = "licen[cs]e|copyright|warrant|permission is hereby|redistribution|public domain"
END = "[.!?;]*[\\x0A\\x0D]+|[.!?;]+[\\x20\\x09]+"

# Sentences of public licences, normalised, by identifier
SENTENCES = {
    "mitRef": ["released under the mit license", "licensed under the mit license", "this project is licensed under the mit license",
               "distributed under the mit license", "license mit"],
    "mitGrant": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
                 "the software to deal in the software without restriction including without limitation the rights to use copy modify merge "
                 "publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to "
                 "do so subject to the following conditions"],
    "mitNotice": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"],
    "asIs": ["the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of "
             "merchantability fitness for a particular purpose and noninfringement"],
    "apache2Ref": ["licensed under the apache license version 2 0", "licensed under the apache license version 2 0 the license",
                   "released under the apache license version 2 0", "distributed under the apache license version 2 0"],
    "apache2Use": ["you may not use this file except in compliance with the license"],
    "apache2Copy": ["you may obtain a copy of the license at http www apache org licenses license 2 0"],
    "gpl3Ref": ["this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3",
                "released under the gnu general public license version 3"],
    "gpl2Ref": ["this work is licensed under the gnu general public license version 2", "licensed under the gnu general public license version 2",
                "released under the gnu general public license version 2"],
    "gplLater": ["either version 3 of the license or at your option any later version", "or at your option any later version of the license"],
    "lgpl21Ref": ["licensed under the gnu lesser general public license version 2 1"],
    "agpl3Ref": ["licensed under the gnu affero general public license version 3"],
    "mpl2Ref": ["this source code form is subject to the terms of the mozilla public license v 2 0", "licensed under the mozilla public license version 2 0"],
    "bsdGrant": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following "
                 "conditions are met"],
    "bsdSource": ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"],
    "bsdBinary": ["redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in "
                  "the documentation and or other materials provided with the distribution"],
    "bsdRef": ["licensed under the bsd 3 clause license", "released under the bsd 3 clause license"],
    "iscGrant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that "
                 "the above copyright notice and this permission notice appear in all copies"],
    "ccByRef": ["licensed under cc by 4 0", "this work is licensed under a creative commons attribution 4 0 international license"],
    "ccBySaRef": ["licensed under cc by sa 4 0"],
    "ccByNcRef": ["licensed under cc by nc 4 0"],
    "cc0Ref": ["licensed under cc0 1 0", "this work is dedicated to the public domain"],
}
# Licences by runs of sentence identifiers, in the order in which they are tried
RULES = [
    ("MIT", ["mitGrant", "mitNotice", "asIs"]), ("MIT", ["mitGrant", "mitNotice"]), ("Apache-2.0", ["apache2Ref", "apache2Use", "apache2Copy"]),
    ("Apache-2.0", ["apache2Ref", "apache2Use"]), ("BSD-2-Clause", ["bsdGrant", "bsdSource", "bsdBinary"]), ("GPL-3.0-or-later", ["gpl3Ref", "gplLater"]),
    ("GPL-2.0-or-later", ["gpl2Ref", "gplLater"]), ("MIT", ["mitRef"]), ("Apache-2.0", ["apache2Ref"]), ("GPL-3.0-only", ["gpl3Ref"]),
    ("GPL-2.0-only", ["gpl2Ref"]), ("LGPL-2.1-only", ["lgpl21Ref"]), ("AGPL-3.0-only", ["agpl3Ref"]), ("MPL-2.0", ["mpl2Ref"]),
    ("BSD-3-Clause", ["bsdRef"]), ("ISC", ["iscGrant"]), ("CC-BY-4.0", ["ccByRef"]), ("CC-BY-SA-4.0", ["ccBySaRef"]), ("CC-BY-NC-4.0", ["ccByNcRef"]),
    ("CC0-1.0", ["cc0Ref"]),
]

#: What the operator knows besides: a clause that names the holder, as a sentence with a gap, and the rule that it makes.
GAP = "the copyright holder"
CLAUSES = {"bsdEndorse": f"neither the name of {GAP} nor the names of its contributors may be used to endorse or promote products derived from this "
                         "software without specific prior written permission"}
BSD3 = ("BSD-3-Clause", ["bsdGrant", "bsdSource", "bsdBinary", "bsdEndorse"])
#: Start of a wrapped sentence: a line or the end of a sentence, then marks of comments and lists. Between words: all but letters and digits.
START = "(?<=\\A|[\\x0A\\x0D]|[.!?;][\\x20\\x09])[^A-Za-z0-9\\x0A\\x0D]*+(?:[0-9a-z]{1,2}[.)][\\x20\\x09]++)?"
BETWEEN, STOP = "[^A-Za-z0-9]++", "(?:[^A-Za-z0-9\\x0A\\x0D]*+(?=[\\x0A\\x0D]|\\z)|[.!?;]++[\\x20\\x09]++|:[\\x20\\x09]++(?=[(*-]?[\\x20]?[0-9a-z]{1,2}[.)]))"


def known() -> dict[str, str]:
    """Identifier by normalised sentence."""
    return {sentence: name for name, sentences in SENTENCES.items() for sentence in sentences}


def normalised(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))


def rules() -> list[tuple[str, list[str]]]:
    """The rules in the order in which they are tried."""
    at = [name for name, _ in RULES].index("BSD-2-Clause")
    return [*RULES[:at], BSD3, *RULES[at:]]


def _wrapped(sentence: str) -> str:
    """Pattern of a known sentence over any number of lines."""
    parts = [BETWEEN.join(part.split()) for part in sentence.split(GAP)]
    return "(?i)" + START + (BETWEEN + "[^.;]{1,300}?" + BETWEEN).join(parts) + STOP


def unwrapped(text: Column) -> Column:
    """Text with each known sentence on a line of its own."""
    for sentence in [*known(), *CLAUSES.values()]:
        text = F.regexp_replace(text, _wrapped(sentence), f"\n{sentence}\n")
    return text


def sentence_ids(text: str = "text") -> Column:
    """Identifiers of a text's licence sentences in text order."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    table = F.create_map(*[F.lit(x) for pair in (known() | {s: i for i, s in CLAUSES.items()}).items() for x in pair])
    sentences = F.filter(F.split(unwrapped(whole), END), lambda s: F.lower(s).rlike(WORD))
    found = F.transform(sentences, lambda s: F.coalesce(F.try_element_at(table, normalised(s)), F.lit(UNKNOWN)))
    return F.when(F.lower(whole).rlike(WORD), found).otherwise(F.array().cast("array<string>"))


def _matched(ids: Column) -> Column:
    """Names of the rules that match, in rule order. ids: array of identifiers."""
    tried = F.array(*[F.struct(F.lit(name).alias("name"), F.lit("|" + "||".join(run) + "|").alias("run")) for name, run in rules()])
    start = F.struct(F.array_join(F.transform(ids, lambda i: F.concat(F.lit("|"), i, F.lit("|"))), "").alias("left"),
                     F.array().cast("array<string>").alias("names"))
    end = F.aggregate(tried, start, lambda state, rule: F.struct(
        F.replace(state["left"], rule["run"], F.lit("#")).alias("left"),
        F.when(F.contains(state["left"], rule["run"]), F.concat(state["names"], F.array(rule["name"]))).otherwise(state["names"]).alias("names")))
    return F.array_distinct(end["names"])


def licences(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, sentence_ids and licences (comma-joined), n_unknown (licence sentences that are not known)."""
    read = docs.select(F.col(doc_id).alias("doc_id"), sentence_ids(text).alias("ids"))
    none = F.array().cast("array<string>")
    named = F.when(F.size("ids") > 0, _matched(F.col("ids"))).otherwise(none)
    return read.select("doc_id", F.array_join("ids", ",").alias("sentence_ids"), F.array_join(named, ",").alias("licences"),
                       F.size(F.filter("ids", lambda i: i == UNKNOWN)).cast("bigint").alias("n_unknown"))


def sql() -> str:
    """The same over `documents` in DuckDB's SQL."""
    table = "MAP {" + ", ".join(f"'{s}': '{i}'" for s, i in known().items()) + "}"
    ctes, names = ["r0 AS (SELECT doc_id, ids, array_to_string(list_transform(ids, lambda i: '|' || i || '|'), '') AS s0 FROM i)"], []
    for k, (name, run) in enumerate(RULES):
        run = "|" + "||".join(run) + "|"
        ctes.append(f"r{k + 1} AS (SELECT *, replace(s{k}, '{run}', '#') AS s{k + 1}, CASE WHEN contains(s{k}, '{run}') THEN '{name}' END AS n{k} FROM r{k})")
        names.append(f"n{k}")
    listed = f"list_filter([{', '.join(names)}], lambda x: x IS NOT NULL)"
    distinct = f"list_filter({listed}, lambda x, k: list_position({listed}, x) = k)"
    return f"""
        WITH s AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{END}'), lambda s: regexp_matches(lower(s), '{WORD}')) AS w FROM documents),
        i AS (SELECT doc_id, list_transform(w, lambda s: coalesce(({table})[trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'))], '{UNKNOWN}')) AS ids FROM s),
        {", ".join(ctes)}
        SELECT doc_id, array_to_string(ids, ',') AS sentence_ids, array_to_string({distinct}, ',') AS licences,
               len(list_filter(ids, lambda i: i = '{UNKNOWN}')) AS n_unknown FROM r{len(RULES)}"""
