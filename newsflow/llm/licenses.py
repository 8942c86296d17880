"""Licence statements by sentence rules.

A text that has a word of a licence sentence is normalised (A-Z lower-cased, all but
letters, digits and ``. ! ? + -`` made spaces) and cut into sentences. Every
sentence that a sentence rule knows is mapped to its identifier; the identifiers, in
order, are matched against the ordered licence rules, each taking what it matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Identifier, pattern over a normalised sentence; the first that fits names the sentence.
GRANT = "(licen[sc]ed|released|distributed|available|published|provided|made available)( as [a-z ]+| to [a-z ]+)? under (the )?(terms of )?(the |a )?"
SENTENCES = [
    ("MITgrant", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("MITnotice", "the above copyright notice and this permission notice shall be included"),
    ("AsIs", "(is|are) provided as is( and [a-z ]+)? without (any )?(express [a-z ]+ )?warrant(y|ies)"),
    ("AsIsBSD", "this software is provided by .* as is and any express or implied warranties"),
    ("MITref", GRANT + "(mit|expat|x11)( public| open source)? licen[sc]e"),
    ("ApacheRef", GRANT + "apache( software)? licen[sc]e version 2.0"),
    ("ApacheUse", "you may not use this file except in compliance with the licen[sc]e"),
    ("ApacheObtain", "you may obtain a copy of the licen[sc]e at"),
    ("AsIsApache", "distributed under the licen[sc]e is distributed on an as is basis"),
    ("AGPL3", "gnu affero general public licen[sc]e( as published by the free software foundation)?( either)? version 3"),
    ("LGPL3", "gnu lesser general public licen[sc]e( as published by the free software foundation)?( either)? version 3"),
    ("LGPL21", "gnu lesser general public licen[sc]e( as published by the free software foundation)?( either)? version 2.1"),
    ("GPL3later", "gnu general public licen[sc]e .*version 3 .*any later version"),
    ("GPL2later", "gnu general public licen[sc]e .*version 2 .*any later version"),
    ("GPL3", "gnu general public licen[sc]e( as published by the free software foundation)?( either)? (version |v)3"),
    ("GPL2", "gnu general public licen[sc]e( as published by the free software foundation)?( either)? (version |v)2"),
    ("GPLwarranty", "without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("MPL2", "mozilla public licen[sc]e (version |v )?2.0"),
    ("EPL2", "eclipse public licen[sc]e (version |v )?2.0"),
    ("BSDcond", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("BSDsource", "redistributions of source code must retain the above copyright notice"),
    ("BSDbinary", "redistributions in binary form must reproduce the above copyright notice"),
    ("BSDname", "neither the name of .* may be used to endorse or promote products"),
    ("BSDref", GRANT + "(3-clause |2-clause |new |simplified )?bsd( 3-clause| 2-clause)? licen[sc]e"),
    ("CC0", "(creative commons zero|cc0)"),
    *[(f"CC-{k.upper()}-{v}", GRANT + f"(creative commons|cc) ?({names}) ?(international )?(licen[sc]e )?{v}")
      for v in ("4.0", "3.0", "2.0") for k, names in (
          ("by-nc-sa", "by-nc-sa|attribution-noncommercial-sharealike"), ("by-nc-nd", "by-nc-nd|attribution-noncommercial-noderivatives"),
          ("by-nc", "by-nc|attribution-noncommercial"), ("by-nd", "by-nd|attribution-noderivatives"),
          ("by-sa", "by-sa|attribution-sharealike"), ("by", "by|attribution"))],
    ("PublicDomain", "(placed|released|dedicated|is) (in|into|to) the public domain"),
    ("Reserved", "all rights reserved"),
    ("Copyright", "copyright (c )?[0-9]{4}"),
    ("Unknown", "(licen[sc]ed under|under the terms of|under the [a-z0-9. -]*licen[sc]e)"),
]

# Licence and the identifiers that state it, in the order in which they are tried.
LICENSES = [
    ("MIT", "MITgrant MITnotice AsIs"), ("MIT", "MITgrant MITnotice"), ("MIT", "MITgrant"), ("MIT", "MITref"),
    ("Apache-2.0", "ApacheRef ApacheUse ApacheObtain AsIsApache"), ("Apache-2.0", "ApacheRef ApacheUse ApacheObtain"), ("Apache-2.0", "ApacheRef"),
    ("AGPL-3.0", "AGPL3"), ("LGPL-3.0", "LGPL3"), ("LGPL-2.1", "LGPL21"), ("GPL-3.0-or-later", "GPL3later GPLwarranty"), ("GPL-3.0-or-later", "GPL3later"),
    ("GPL-2.0-or-later", "GPL2later GPLwarranty"), ("GPL-2.0-or-later", "GPL2later"), ("GPL-3.0", "GPL3"), ("GPL-2.0", "GPL2"),
    ("MPL-2.0", "MPL2"), ("EPL-2.0", "EPL2"), ("BSD-3-Clause", "BSDcond BSDsource BSDbinary BSDname"), ("BSD-2-Clause", "BSDcond BSDsource BSDbinary"),
    ("BSD", "BSDref"), ("CC0-1.0", "CC0"), *[(name, name) for name, _ in SENTENCES if name.startswith("CC-")],
    ("Public-Domain", "PublicDomain"), ("All-Rights-Reserved", "Copyright Reserved"), ("All-Rights-Reserved", "Reserved"),
]

# every sentence rule's sentences have one of these
KEYWORDS = ["licen", "copyright", "rights reserved", "public domain", "redistribut", "permission", "warrant", "under the terms", "creative commons", "cc0",
            "to endorse", " under "]

# single words, one of which is in every text with one of KEYWORDS, whatever white space or punctuation parts them there
WORDS = ["licen", "copyright", "reserved", "domain", "redistribut", "permission", "warrant", "terms", "commons", "cc0", "endorse", "under"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def sentences(text: Column) -> Column:
    """The normalised sentences of a text."""
    flat = F.trim(F.regexp_replace(F.translate(text, UPPER, LOWER), "[^a-z0-9.!?+-]+", " "))
    return F.split(flat, "[.!?]+( |$)")


def identified(sentence: Column) -> Column:
    """The identifier of a sentence, or null."""
    out = None
    for name, pattern in SENTENCES:
        fits = sentence.rlike(f"(^| ){pattern}( |$)")
        out = F.when(fits, name) if out is None else out.when(fits, name)
    return out


def scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_sentences, sentence_ids, licenses, unmatched)`` for each row of ``docs(doc_id, text, ...)`` with a licence sentence.

    ``sentence_ids`` and ``unmatched`` (those that no licence rule took) are joined by spaces in
    text order, ``licenses`` (each once) by spaces in the order of the rules. Null, empty and other
    texts without a licence sentence give no row; repeated rows repeat their result.
    """
    text = F.col("text").cast("string")
    low = F.translate(text, UPPER, LOWER)
    maybe = F.lit(False)
    for k in WORDS:
        maybe = maybe | F.col("_low").contains(k)
    rows = docs.select("doc_id", text.alias("text"), low.alias("_low")).where(maybe).select("doc_id", sentences(F.col("text")).alias("_all"))
    # the identifier rules are only tried on sentences that have a keyword
    def worth(s: Column) -> Column:
        out = F.lit(False)
        for k in KEYWORDS:
            out = out | F.concat(F.lit(" "), s, F.lit(" ")).contains(k)
        return out
    rows = rows.withColumn("_some", F.filter("_all", worth)).drop("_all")
    rows = rows.withColumn("_ids", F.filter(F.transform("_some", identified), lambda x: x.isNotNull())).where(F.size("_ids") > 0)
    rows = rows.select("doc_id", F.size("_ids").cast("bigint").alias("n_sentences"), F.array_join("_ids", " ").alias("sentence_ids"),
                       F.concat(F.lit("<"), F.array_join("_ids", "><"), F.lit(">")).alias("_left"), F.array().cast("array<string>").alias("_found"))
    for name, ids in LICENSES:
        form = "<" + ids.replace(" ", "><") + ">"
        rows = rows.select("doc_id", "n_sentences", "sentence_ids", F.replace(F.col("_left"), F.lit(form), F.lit("")).alias("_left"),
                           F.when(F.col("_left").contains(form), F.array_append("_found", F.lit(name))).otherwise(F.col("_found")).alias("_found"))
    unmatched = F.trim(F.replace(F.replace(F.col("_left"), F.lit("<"), F.lit(" ")), F.lit(">"), F.lit("")))
    return rows.select("doc_id", "n_sentences", "sentence_ids", F.array_join(F.array_distinct("_found"), " ").alias("licenses"), unmatched.alias("unmatched"))


def oracle() -> str:
    """The same scan of ``documents`` as DuckDB SQL."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    case = "CASE " + " ".join(f"WHEN regexp_matches(s, {q('(^| )' + p + '( |$)')}) THEN {q(n)}" for n, p in SENTENCES) + " END"
    steps, at = [], "ids0"
    for i, (name, ids) in enumerate(LICENSES):
        form = q("<" + ids.replace(" ", "><") + ">")
        steps.append(f"ids{i + 1} AS (SELECT doc_id, n, seq, replace(rest, {form}, '') AS rest, "
                     f"CASE WHEN contains(rest, {form}) AND NOT list_contains(found, {q(name)}) THEN list_append(found, {q(name)}) ELSE found END AS found FROM {at})")
        at = f"ids{i + 1}"
    maybe = " OR ".join(f"contains(translate(text, '{UPPER}', '{LOWER}'), {q(k)})" for k in KEYWORDS)
    return f"""WITH cut AS (SELECT doc_id, string_split_regex(trim(regexp_replace(translate(text, '{UPPER}', '{LOWER}'), '[^a-z0-9.!?+-]+', ' ', 'g')), '[.!?]+( |$)') AS parts
  FROM documents WHERE {maybe}),
named AS (SELECT doc_id, list_filter(list_transform(parts, lambda s: {case}), lambda x: x IS NOT NULL) AS ids FROM cut),
ids0 AS (SELECT doc_id, len(ids)::BIGINT AS n, array_to_string(ids, ' ') AS seq, '<' || array_to_string(ids, '><') || '>' AS rest, []::VARCHAR[] AS found FROM named WHERE len(ids) > 0),
{', '.join(steps)}
SELECT doc_id, n AS n_sentences, seq AS sentence_ids, array_to_string(found, ' ') AS licenses, trim(replace(replace(rest, '<', ' '), '>', '')) AS unmatched FROM {at}"""
