"""License scans (operator 8, native): sentence-rule recognition.

A text is split into sentences; each is normalised (ASCII lower case, runs of
characters other than letters, digits, ``.`` and ``-`` to one space, outer
spaces and full stops cut) and mapped to the identifier of a known licence
sentence. The identifiers of a text, in order, form a sequence; ``-`` stands
for one or more unknown sentences between them. A licence rule is an ordered
list of identifiers that must stand side by side in that sequence.

Notices wrapped over lines are found by a second reading of the text by
paragraphs, where a single line end is white space and list numbers are left
out, against the licences' full sentences too. It adds to ``licenses`` only;
``sentence_ids`` and ``n_sentences`` are those of the lines.

Defined results: null or empty text has no sentences; repeated rows and null
ids are kept row by row (nothing is grouped); an empty table gives no rows;
other columns of the input are kept unless they share a result's name, which
the result replaces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import fresh, lower_ascii, table

# Known licence sentences, normalised, with their identifiers.
SENTENCES = {
    "released under the mit license": "mit-ref",
    "licensed under the mit license": "mit-ref",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction": "mit-grant",
    "licensed under the apache license version 2.0": "apache2-ref",
    "licensed under the apache license version 2.0 the license": "apache2-ref",
    "you may not use this file except in compliance with the license": "apache2-use",
    "you may obtain a copy of the license at": "apache2-copy",
    "this work is licensed under the gnu general public license version 3": "gpl3-ref",
    "this program is free software": "gpl-free",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl-terms",
    "either version 3 of the license or at your option any later version": "gpl3-later",
    "licensed under cc by-nc 4.0": "ccbync4-ref",
    "licensed under cc by 4.0": "ccby4-ref",
    "this work is licensed under a creative commons attribution 4.0 international license": "ccby4-ref",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "all rights reserved": "arr",
}
# Licence rules, each an ordered list of identifiers.
RULES = {
    "Apache-2.0": [["apache2-ref"], ["apache2-use", "apache2-copy"]],
    "BSD": [["bsd-grant"]],
    "CC-BY-4.0": [["ccby4-ref"]],
    "CC-BY-NC-4.0": [["ccbync4-ref"]],
    "GPL-3.0": [["gpl3-ref"], ["gpl-terms", "gpl3-later"]],
    "GPL-3.0-or-later": [["gpl-free", "gpl-terms", "gpl3-later"]],
    "MIT": [["mit-ref"], ["mit-grant"]],
    "proprietary": [["arr"]],
}
_GPL = "you can redistribute it and or modify it under the terms of the gnu {} public license as published by the free software foundation"
_LATER = "either version {} of the license or at your option any later version"
# Full sentences of real licence texts, for the reading by paragraphs.
FULL_SENTENCES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-full",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-full",
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-full",
    "this library is free software": "gpl-free",
    **{f"this {x} is free software {_GPL.format('general')} {_LATER.format(3)}": "gpl3-header" for x in ("program", "library")},
    **{f"this {x} is free software {_GPL.format('lesser general')} {_LATER.format(3)}": "lgpl3-header" for x in ("program", "library")},
    f"{_GPL.format('general')} {_LATER.format(3)}": "gpl3-header",
    f"{_GPL.format('lesser general')} {_LATER.format(3)}": "lgpl3-header",
    _GPL.format("lesser general"): "lgpl-terms",
    _LATER.format(2): "gpl2-later",
    _LATER.format("2.1"): "lgpl21-later",
    _GPL.format("general").replace("license as", "license version 2 as"): "gpl2-only",
    "gnu general public license version 2 june 1991": "gpl2-title",
    "gnu general public license version 3 29 june 2007": "gpl3-title",
    "gnu lesser general public license version 2.1 february 1999": "lgpl21-title",
    "gnu lesser general public license version 3 29 june 2007": "lgpl3-title",
    "apache license version 2.0 january 2004 http www.apache.org licenses": "apache2-title",
    # the full stop of "v. 2.0" ends a sentence
    "this source code form is subject to the terms of the mozilla public license v": "mpl-src",
    "2.0": "v2.0",
    **{f"if a copy of the mpl was not distributed with this file you can obtain one at {x} mozilla.org mpl 2.0": "mpl2-copy" for x in ("http", "https")},
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-endorse",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "bsd-as-is",
}
# Further rules of the reading by paragraphs.
FULL_RULES = {
    "Apache-2.0": [["apache2-title"]],
    "BSD-2-Clause": [["bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is"]],
    "BSD-3-Clause": [["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"]],
    "GPL-2.0": [["gpl2-only"], ["gpl2-title"], ["gpl-terms", "gpl2-later"]],
    "GPL-2.0-or-later": [["gpl-free", "gpl-terms", "gpl2-later"]],
    "GPL-3.0": [["gpl3-header"], ["gpl3-title"]],
    "GPL-3.0-or-later": [["gpl3-header"]],
    "ISC": [["isc-full"]],
    "LGPL-2.1": [["lgpl21-title"], ["lgpl-terms", "lgpl21-later"]],
    "LGPL-2.1-or-later": [["lgpl-terms", "lgpl21-later"]],
    "LGPL-3.0": [["lgpl3-header"], ["lgpl3-title"], ["lgpl-terms", "gpl3-later"]],
    "LGPL-3.0-or-later": [["lgpl3-header"], ["lgpl-terms", "gpl3-later"]],
    "MIT": [["mit-full"]],
    "MPL-2.0": [["mpl-src", "v2.0"], ["mpl2-copy"]],
}
# A sentence ends at ! ? ; or line end, or at a full stop before white space.
SPLIT = r"[!?;\n]+|\.[\x20\x09-\x0D]+|\.$"

# In a paragraph a single line end is white space; lines of signs only are blank.
PARAGRAPH_SPLIT = r"[!?;]+|\n[^A-Za-z0-9\n\x{80}-\x{10FFFF}]*\n|\.[\x20\x09-\x0D]+|\.$"


def _normal(s: Column) -> Column:
    return F.trim(F.regexp_replace(lower_ascii(s), r"[^a-z0-9.\-\x{80}-\x{10FFFF}]+", " "), F.lit(" ."))


def _found(ids: Column, rules: dict) -> Column:
    """Names of the rules that match, null for the others."""
    # runs of unknown sentences count as one gap
    line = F.concat(F.lit(" "), F.regexp_replace(F.array_join(ids, " "), r"-( -)*", "-"), F.lit(" "))
    return F.transform(F.array(line), lambda q: F.array(*[
        F.when(F.greatest(F.lit(False), *[F.contains(q, F.lit(" " + " ".join(r) + " ")) for r in alts]), F.lit(name))
        for name, alts in sorted(rules.items())]))[0]


def _paragraph_ids(text: Column, known: Column) -> Column:
    """Identifiers of the sentences of ``text`` read by paragraphs."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), PARAGRAPH_SPLIT),
                        lambda s: F.regexp_replace(_normal(s), "^([0-9]{1,2}|-) ", ""))
    parts = F.filter(parts, lambda s: ~s.rlike("^([0-9]{1,2}|-)?$"))
    # the holder's name stands in the sentence
    named = r"^neither the name of .+ (nor the names of (its|any|the) contributors) may "
    return F.transform(parts, lambda s: F.coalesce(F.try_element_at(known, F.when(
        s.startswith("neither the name of "), F.regexp_replace(s, named, "neither the name of the copyright holder nor the names of its contributors may ")).otherwise(s)), F.lit("-")))


def scan_licenses(df: DataFrame, text_col: str = "text", sentences: dict = SENTENCES,
                  rules: dict = RULES) -> DataFrame:
    """Add ``sentence_ids`` (ordered identifiers), ``licenses`` (sorted names
    of the rules that match) and ``n_sentences``."""
    known = F.create_map(*[F.lit(x) for kv in sentences.items() for x in kv])
    parts = F.filter(F.transform(F.split(F.coalesce(F.col(text_col), F.lit("")), SPLIT),
                                 lambda s: F.trim(s, F.lit(" \t\r\x0b\x0c"))), lambda s: s != "")
    s, i, p = (fresh(df, name) for name in ("_s", "_i", "_p"))
    ids = F.transform(s, lambda x: F.coalesce(F.try_element_at(known, _normal(x)), F.lit("-")))
    out = df.withColumn(s, parts).withColumn(i, ids)
    every = {name: rules.get(name, []) + FULL_RULES.get(name, []) for name in {**rules, **FULL_RULES}}
    whole = F.create_map(*[F.lit(x) for kv in {**FULL_SENTENCES, **sentences}.items() for x in kv])
    out = out.withColumn(p, _paragraph_ids(F.col(text_col), whole))
    hits = F.array_union(_found(F.col(i), rules), _found(F.col(p), every))
    return (out.withColumn("n_sentences", F.size(s).cast("long"))
            .withColumn("sentence_ids", F.filter(i, lambda x: x != "-"))
            .withColumn("licenses", F.array_sort(F.filter(hits, lambda x: x.isNotNull())))
            .drop(s, i, p))


def op8_license_scan(spark, sf_dir) -> DataFrame:
    """Licences of every document."""
    out = scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_sentences", F.size("sentence_ids").cast("long").alias("n_known"),
                      F.array_join("sentence_ids", " ").alias("sentence_ids"),
                      F.array_join("licenses", " ").alias("licenses"))


def _sql() -> str:
    known = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in SENTENCES.items()) + "}"
    cases = ", ".join("CASE WHEN " + " OR ".join(f"contains(q, ' {' '.join(r)} ')" for r in alts)
                      + f" THEN '{name}' END" for name, alts in sorted(RULES.items()))
    return f"""
WITH s AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(coalesce(text, ''),
    '[!?;\\n]+|\\.[\\x20\\x09-\\x0D]+|\\.$'), lambda x: trim(x, chr(32) || chr(9) || chr(13) || chr(11) || chr(12))), lambda x: x <> '') AS s
  FROM documents),
i AS (SELECT doc_id, s, list_transform(s, lambda x: coalesce(({known})[
    trim(regexp_replace(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^a-z0-9.\\-\\x{{80}}-\\x{{10FFFF}}]+', ' ', 'g'), ' .')], '-')) AS i FROM s),
q AS (SELECT *, ' ' || regexp_replace(array_to_string(i, ' '), '-( -)*', '-', 'g') || ' ' AS q FROM i)
SELECT doc_id, len(s)::BIGINT AS n_sentences, len(list_filter(i, lambda x: x <> '-'))::BIGINT AS n_known,
  array_to_string(list_filter(i, lambda x: x <> '-'), ' ') AS sentence_ids, concat_ws(' ', {cases}) AS licenses FROM q"""


OP8_SQL = _sql()
