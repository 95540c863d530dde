"""License scans: ordered signature rules over the words of a text.

Each rule is a regular expression over the words of a document joined by one
space, with a keyword that must be among the words before the expression is
tried, a label, a priority and a confidence. Documents meet rules by joining
their distinct keywords with the rule table, so a rule costs nothing where its
keyword is absent. Of overlapping detections, one that lies inside another is
suppressed: the longer one stays, and of equal stretches the one of the rule
with the smaller priority number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lapakdw.llm.text import text_key, word_count, words
from lapakdw.runtime import literal_rows

# Phrases that are always found, and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
PHRASE_KEYWORDS = {"mit": "mit", "apache-2": "apache", "cc-by-nc": "cc"}

# Label, keyword, and how the license is named in lower-case words. Every match must hold the keyword as a word.
NAMES = [
    ("mit", "mit", r"mit(?: x11)?"),
    ("mit", "expat", r"expat"),
    ("mit-0", "mit", r"mit (?:0|no attribution)"),
    ("apache-1.1", "apache", r"apache(?: software)? (?:license )?(?:version |v)?1 1"),
    ("apache-2", "apache", r"apache(?= )(?: software)?(?: license)?(?: version| v)? ?2(?: 0)?"),
    ("apache-2", "apache2", r"apache2(?: 0)?"),
    ("bsd-0", "0bsd", r"0bsd"),
    ("bsd-2", "bsd", r"(?:bsd 2 clause|2 clause bsd|simplified bsd)"),
    ("bsd-2", "freebsd", r"freebsd"),
    ("bsd-3", "bsd", r"(?:bsd 3 clause|3 clause bsd|(?:new|modified|revised) bsd)"),
    ("bsd-4", "bsd", r"(?:bsd 4 clause|4 clause bsd|original bsd)"),
    ("bsd", "bsd", r"bsd(?: style)?"),
    ("gpl-1", "gnu", r"gnu general public license (?:version |v )?1(?: 0)?"),
    ("gpl-2", "gnu", r"gnu (?:gpl|general public license) ?(?:version |v )?(?:v)?2(?: 0)?"),
    ("gpl-3", "gnu", r"gnu (?:gpl|general public license) ?(?:version |v )?(?:v)?3(?: 0)?"),
    ("gpl-2", "gplv2", r"gplv2"),
    ("gpl-3", "gplv3", r"gplv3"),
    ("gpl-2", "gpl", r"gpl (?:version |v )?2(?: 0)?(?: only| or later)?"),
    ("gpl-3", "gpl", r"gpl (?:version |v )?3(?: 0)?(?: only| or later)?"),
    ("gpl", "gnu", r"gnu (?:gpl|general public license)"),
    ("lgpl-2", "lgpl", r"lgpl (?:version |v )?2(?: 0)?(?: only| or later)?"),
    ("lgpl-2.1", "lgpl", r"lgpl (?:version |v )?2 1(?: only| or later)?"),
    ("lgpl-3", "lgpl", r"lgpl (?:version |v )?3(?: 0)?(?: only| or later)?"),
    ("lgpl-2.1", "lesser", r"gnu lesser general public license (?:version |v )?2 1"),
    ("lgpl-3", "lesser", r"gnu lesser general public license (?:version |v )?3(?: 0)?"),
    ("lgpl", "lesser", r"gnu lesser general public license"),
    ("lgpl", "library", r"gnu library general public license"),
    ("agpl-3", "affero", r"gnu affero general public license(?: version| v)?(?: 3)?(?: 0)?"),
    ("agpl-3", "agpl", r"agpl(?: version| v)?(?: 3)?(?: 0)?"),
    ("gfdl", "gnu", r"gnu free documentation license"),
    ("mpl-1.1", "mozilla", r"mozilla public license (?:version |v )?1 1"),
    ("mpl-2", "mozilla", r"mozilla public license(?: version| v)? 2(?: 0)?"),
    ("mpl", "mozilla", r"mozilla public license"),
    ("mpl-2", "mpl", r"mpl (?:version |v )?2(?: 0)?"),
    ("epl-1", "eclipse", r"eclipse public license (?:version |v )?1(?: 0)?"),
    ("epl-2", "eclipse", r"eclipse public license(?: version| v)? ?2(?: 0)?"),
    ("epl", "epl", r"epl (?:1|2) 0"),
    ("cddl-1", "cddl", r"cddl(?: 1)?(?: 0| 1)?"),
    ("cddl-1", "distribution", r"common development and distribution license"),
    ("isc", "isc", r"isc"),
    ("zlib", "zlib", r"zlib(?: libpng)?"),
    ("boost-1", "boost", r"boost software(?: license)?(?: version)?(?: 1 0)?"),
    ("unlicense", "unlicense", r"unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("artistic-1", "artistic", r"artistic (?:license )?1(?: 0)?"),
    ("artistic-2", "artistic", r"artistic (?:license )?2(?: 0)?"),
    ("postgresql", "postgresql", r"postgresql"),
    ("python-2", "python", r"python software foundation(?: license)?"),
    ("ruby", "ruby", r"ruby"),
    ("openssl", "openssl", r"openssl"),
    ("eupl-1.2", "eupl", r"eupl(?: 1 [12])?"),
    ("cecill", "cecill", r"cecill(?: [bc])?"),
    ("ofl-1.1", "ofl", r"(?:sil )?ofl(?: 1 1)?"),
    ("ofl-1.1", "font", r"(?:sil )?open font"),
    ("odbl", "odbl", r"odbl(?: 1 0)?"),
    ("odbl", "database", r"open database"),
    ("cc0", "cc0", r"cc0(?: 1 0)?"),
    ("cc-by-nc-nd", "cc", r"cc by nc nd(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "cc", r"cc by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc", "cc", r"cc by nc(?: [1-4] [05])?"),
    ("cc-by-nd", "cc", r"cc by nd(?: [1-4] [05])?"),
    ("cc-by-sa", "cc", r"cc by sa(?: [1-4] [05])?"),
    ("cc-by", "cc", r"cc by(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "commons", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "commons", r"creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?"),
    ("cc-by-nc", "commons", r"creative commons attribution non ?commercial(?: [1-4] [05])?"),
    ("cc-by-nd", "commons", r"creative commons attribution no ?deriv(?:ative)?s(?: [1-4] [05])?"),
    ("cc-by-sa", "commons", r"creative commons attribution share ?alike(?: [1-4] [05])?"),
    ("cc-by", "commons", r"creative commons attribution(?: [1-4] [05])?"),
    ("cc0", "commons", r"creative commons zero"),
]

# Label, keyword, and clauses of the license texts and notices themselves, which name no license or say which version.
_MIT = (
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"
)
_MIT_GRANT = (
    " the software to deal in the software without restriction including without limitation the rights to use copy modify merge"
    " publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so"
)
_ISC = "permission to use copy modify (?:and )?(?:or )?distribute this software for any purpose with or without fee is hereby granted"
_GNU = "you can redistribute it and or modify it under the terms of the {} as published by the free software foundation (?:either )?version {}"
_LATER = "(?: of the license)?(?: or at your option any later version)?"
_BSD = "redistribution and use in source and binary forms with or without modification are permitted"
NOTICES = [
    ("mit", "obtaining", _MIT),
    ("mit", "obtaining", _MIT + _MIT_GRANT + " subject to the following conditions"),
    ("mit-0", "obtaining", _MIT + _MIT_GRANT + " the software is provided"),
    ("boost-1", "obtaining", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("isc", "distribute", "permission to use copy modify (?:and )?(?:or )?distribute this software for any purpose with or without fee"),
    ("isc", "distribute", _ISC + " provided that the above copyright notice"),
    ("bsd-0", "distribute", _ISC + " the software is provided"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms"),
    ("bsd", "redistribution", _BSD + " provided that the following conditions are met"),
    ("bsd-3", "endorse", "(?:names? of|nor the names of) (?:its|the|his|her|their)(?: copyright holders?(?: and)?)?(?: contributors)? (?:may|must not|can) (?:not )?be used to endorse or promote products derived from this software"),
    ("bsd-4", "advertising", "all advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("zlib", "authors", "in no event will the authors be held liable for any damages arising from the use of this software"),
    ("zlib", "anyone", "permission is granted to anyone to use this software for any purpose including commercial applications"),
    ("zlib", "altered", "altered source versions must be plainly marked as such"),
    ("apache-2", "compliance", "you may not use this file except in compliance with the license"),
    ("apache-2", "applicable", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    *((f"gpl-{v}", "redistribute", _GNU.format("gnu general public license", f"{v}{_LATER}")) for v in (1, 2, 3)),
    ("lgpl-2", "redistribute", _GNU.format("gnu library general public license", f"2{_LATER}")),
    ("lgpl-2.1", "redistribute", _GNU.format("gnu lesser general public license", f"2 1{_LATER}")),
    ("lgpl-3", "redistribute", _GNU.format("gnu lesser general public license", f"3{_LATER}")),
    ("agpl-3", "redistribute", _GNU.format("gnu affero general public license", f"3{_LATER}")),
    ("mpl-2", "mozilla", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("wtfpl", "fuck", "do what the fuck you want to public license"),
]

# How a text refers to a named license, and how sure that makes the detection.
FORMS = [
    (r"spdx license identifier {}", 1.0),
    (r"(?:is |are |be )?(?:released|distributed|published|provided|available|made available) under (?:the )?(?:terms of (?:the )?)?{}(?: license)?", 0.95),
    (r"(?:dual |re)?licensed under (?:the )?(?:terms of (?:the )?)?{}(?: license)?", 0.95),
    (r"(?:covered|governed) by (?:the )?{}(?: license)?", 0.85),
    (r"under (?:the )?(?:terms of the )?{} license", 0.85),
    (r"licen[cs]e {}", 0.7),
    (r"{} licen[cs]e", 0.6),
]

# Names long or odd enough to stand alone.
BARE_WORDS = 3


def rule_table() -> list[tuple]:
    """(label, keyword, pattern, priority, confidence) of every rule, the most specific form first."""
    rules = [(label, PHRASE_KEYWORDS[label], phrase, 0, 0.9) for phrase, label in PHRASES.items()]
    for rank, (form, sure) in enumerate(FORMS, start=1):
        for place, (label, keyword, name) in enumerate(NAMES):
            rules.append((label, keyword, form.format(f"(?:{name})"), rank * 1000 + place, sure))
    for place, (label, keyword, name) in enumerate(NAMES):
        if name.count(" ") >= BARE_WORDS:
            rules.append((label, keyword, f"(?:{name})", 9000 + place, 0.5))
    rules += [(label, keyword, clause, 500 + place, 0.9) for place, (label, keyword, clause) in enumerate(NOTICES)]
    return [(a, b, rf"(?<= )({p})(?= )", n, c) for a, b, p, n, c in rules]


def rules(spark: SparkSession) -> DataFrame:
    schema = {"label": "string", "keyword": "string", "pattern": "string", "priority": "int", "sure": "double"}
    return literal_rows(spark, schema, rule_table())


def _spans(joined: Column, pattern: Column) -> Column:
    """First and last word of every match in words joined (and surrounded) by spaces.

    Matches are put between two characters that no word holds; words that begin
    or end with them are the edges.
    """
    marked = F.regexp_replace(joined, pattern, F.lit("\x01$1\x02"))
    pieces = F.split(F.trim(marked), " ")
    placed = F.transform(pieces, lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    first = F.transform(F.filter(placed, lambda x: x["w"].startswith("\x01")), lambda x: x["i"])
    last = F.transform(F.filter(placed, lambda x: x["w"].endswith("\x02")), lambda x: x["i"])
    return F.arrays_zip(first.alias("first"), last.alias("last"))


def detections(documents: DataFrame, table: DataFrame | None = None) -> DataFrame:
    """Every match of every rule, once: ``doc_id, key, label, priority, sure, first, last, kept``.

    ``first`` and ``last`` are word positions from 0; ``kept`` is false where
    the match lies inside a better one.
    """
    table = rules(documents.sparkSession) if table is None else table
    keywords = sorted({row[1] for row in rule_table()})
    wordy = documents.select("doc_id", text_key(F.col("text")).alias("key"), words(F.col("text")).alias("ws"))
    gated = (
        wordy.withColumn("found", F.array_intersect("ws", F.array(*map(F.lit, keywords))))
        .where(F.size("found") > 0)
        .select("doc_id", "key", F.concat(F.lit(" "), F.array_join("ws", " "), F.lit(" ")).alias("joined"), "found")
        .select("doc_id", "key", "joined", F.explode("found").alias("keyword"))
    )
    matches = (
        gated.join(F.broadcast(table), "keyword")
        .where(F.expr("joined rlike pattern"))
        .select(
            "doc_id", "key", "label", "priority", "sure", F.inline(_spans(F.col("joined"), F.col("pattern")))
        )
        .distinct()
    )
    # Whatever holds a match comes before it in this order, so the furthest end so far tells.
    before = (
        Window.partitionBy("doc_id", "key")
        .orderBy("first", F.desc("last"), "priority")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = F.coalesce(F.max("last").over(before) >= F.col("last"), F.lit(False))
    return matches.withColumn("kept", ~inside)


def scan_licenses(documents: DataFrame) -> DataFrame:
    """One row per document: word count, the fixed phrases, the labels of all kept rules, a score.

    ``n_base``, ``first_word``, ``last_word`` and ``base_labels`` tell where the
    fixed phrases start; ``labels`` adds the labels of the kept detections;
    ``score`` is the largest confidence among them, 0 without any. Null and
    empty texts have no words and no labels. Repeated rows each get their row; a
    null id is an id like any other. Other columns are ignored.
    """
    key = text_key(F.col("text"))
    rows = documents.select("doc_id", key.alias("key"), word_count(F.col("text")).alias("n_words"))
    base = F.col("priority") == 0
    used = base | F.col("kept")
    found = (
        detections(documents)
        .groupBy("doc_id", "key")
        .agg(
            F.count_if(base).alias("n_base"),
            F.min(F.when(base, F.col("first"))).cast("long").alias("first_word"),
            F.max(F.when(base, F.col("first"))).cast("long").alias("last_word"),
            F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
            F.array_join(F.array_sort(F.collect_set(F.when(used, F.col("label")))), ",").alias("labels"),
            F.max(F.when(used, F.col("sure"))).alias("score"),
        )
        .select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "*")
        .drop("doc_id", "key")
    )
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left")
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
