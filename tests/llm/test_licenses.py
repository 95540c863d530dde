import random
import re

from lapakdw.llm import licenses
from tests.llm.brute import words

DOC = "doc_id long, text string, _id long, _key long, label string"
COLUMNS = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def brute(docs):
    table = [(label, keyword, re.compile(pattern), priority, sure) for label, keyword, pattern, priority, sure in licenses.rule_table()]
    rows = []
    for doc_id, text in docs:
        ws = words(text)
        joined = " " + " ".join(ws) + " "
        found = set()
        for label, keyword, pattern, priority, sure in table:
            if keyword in ws:
                for m in pattern.finditer(joined):
                    first = joined.count(" ", 0, m.start()) - 1
                    found.add((first, first + m[0].count(" "), label, priority, sure))
        base = sorted(f for f in found if f[3] == 0)

        def inside(d, found=found):
            return any(
                o != d and o[0] <= d[0] and o[1] >= d[1] and ((o[0], o[1]) != (d[0], d[1]) or o[3] < d[3]) for o in found
            )

        used = [d for d in found if d[3] == 0 or not inside(d)]
        rows.append(
            (
                doc_id, len(ws), len(base), base[0][0] if base else None, base[-1][0] if base else None,
                ",".join(sorted({b[2] for b in base})), ",".join(sorted({u[2] for u in used})),
                max((u[4] for u in used), default=0.0),
            )
        )
    return rows


def check(spark, docs):
    df = spark.createDataFrame([(*d, 1, 2, "x") for d in docs], DOC)
    found = licenses.scan_licenses(df)
    assert found.columns == COLUMNS
    assert sorted((tuple(r) for r in found.collect()), key=str) == sorted(brute(docs), key=str)
    return {r["doc_id"]: r for r in found.collect()}


def test_rules_are_many_and_compile():
    table = licenses.rule_table()
    assert len(table) > 400
    assert len({(r[0], r[2]) for r in table}) == len(table)
    for label, keyword, pattern, _, sure in table:
        assert label and keyword and 0 < sure <= 1
        re.compile(pattern)


def test_known_texts(spark):
    found = check(
        spark,
        [
            (1, "This work is licensed under the GNU General Public License, version 3."),
            (2, "Released under the MIT license."),
            (3, "Apache License, Version 2.0; also CC-BY-NC and cc by nc-sa 4.0"),
            (4, "SPDX-License-Identifier: LGPL-2.1-or-later"),
            (5, "the committee permitted apaches to under the mit"),
            (6, "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 license"),
            (7, "covered by the BSD 3-Clause License"),
        ],
    )
    labels = {k: r["labels"] for k, r in found.items()}
    assert labels[1] == "gpl-3"
    assert labels[2] == "mit" and found[2]["n_base"] == 1 and found[2]["first_word"] == 1
    assert found[3]["base_labels"] == "apache-2,cc-by-nc"
    assert "lgpl-2.1" in labels[4]
    assert labels[5] == "" and found[5]["score"] == 0.0
    assert labels[6] == "cc-by-nc-sa"
    assert labels[7] == "bsd-3"


def test_random_texts(spark):
    rng = random.Random(4)
    bits = [w for phrase in licenses.PHRASES for w in phrase.split()] + [
        "licensed", "gnu", "general", "public", "gpl", "bsd", "3", "clause", "is", "released", "terms", "of", "sa", "nd", "É", "x",
    ]
    docs = [(i, rng.choice([" ", "-", ", "]).join(rng.choices(bits, k=rng.randrange(0, 120)))) for i in range(80)]
    check(spark, docs)


def test_nulls_repeats_and_long_texts(spark):
    many = "Under the MIT License! " * 3000
    check(spark, [(1, None), (1, None), (2, ""), (None, "cc by nc"), (None, "cc by nc"), (3, "cc by nc"), (3, "isc license"), (4, many), (5, "…")])


def test_empty_table(spark):
    check(spark, [])


def labels_by_rules(text, gated):
    """Labels of all rules that match, with or without their keywords."""
    ws = words(text)
    joined = " " + " ".join(ws) + " "
    return {r[:4] for r in licenses.rule_table() if (not gated or r[1] in ws) and re.search(r[2], joined)}


def test_keywords_are_implied_by_their_rules():
    names = ["freebsd", "apache2", "apache2 0", "apache 2 0", "apache license v2", "apache v2", "simplified bsd", "expat", "gplv3", "0bsd", "cc0", "epl 2 0"]
    for name in names:
        for form in ("Released under the {} license", "licensed under {}", "SPDX-License-Identifier: {}", "{}"):
            text = form.format(name)
            assert labels_by_rules(text, True) == labels_by_rules(text, False)
    assert {r[0] for r in labels_by_rules("Released under the FreeBSD license", True)} == {"bsd-2"}
    assert {r[0] for r in labels_by_rules("licensed under Apache2", True)} == {"apache-2"}


def test_notices_without_a_name():
    texts = {
        "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "bsd-3": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software",
        "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\")",
        "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice",
        "zlib": "Permission is granted to anyone to use this software for any purpose, including commercial applications",
        "apache-2": "you may not use this file except in compliance with the License.",
        "gpl-2": "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    }
    for label, text in texts.items():
        found = labels_by_rules(text, True)
        assert label in {r[0] for r in found if r[3] < 1000}
        assert found == labels_by_rules(text, False)
    for label, keyword, clause in licenses.NOTICES:
        assert re.search(rf"\b{keyword}\b", clause) and label in {r[0] for r in licenses.NAMES}
