"""License notices in documents: MinHash bands retrieve templates for text windows, shingle containment verifies.

Texts are compared as lower-case runs of ASCII letters and digits, in shingles of five.  A document is read in
overlapping windows, one set for every size class of the templates; a window is half as long again as the largest
template of its class, and half a template further the next one starts, up to the last shingle, so every notice lies
whole in a window.  A window that holds ``CONTAINMENT`` of a template's shingles has a Jaccard similarity of at least 1/8 with it (a template is at
least half as long as the largest of its class).  With one row in each of ``BANDS`` bands such a pair shares a band with
probability ``1 - (7 / 8) ** 64``, over 0.9998.  Retrieved pairs are verified by the exact
share of the template's shingles in the window.

A window without any shingle of any template cannot collide in a band, so signatures are computed for the others only.
The templates are a parameter and small; their shingles and bands are all that is broadcast.  Everything is DataFrame
and SQL expressions, and no text moves.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 5
CONTAINMENT = 0.8
BANDS = 64
TEMPLATE_WORDS = 1_000_000  # templates beyond this many words in all are refused

# Short notices and opening paragraphs of common licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at"
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "MIT": "Released under the MIT License.",
    "MIT grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software"
    ),
    "BSD grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:"
    ),
    "ISC grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MPL-2.0 notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at"
    ),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
}


def words(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def size_classes(templates: Mapping[str, str]) -> dict[int, list[str]]:
    """Largest template size in words, and the templates of at least half that size."""
    left = sorted(((len(words(t)), name) for name, t in templates.items() if words(t)), reverse=True)
    if sum(n for n, _ in left) > TEMPLATE_WORDS:
        raise ValueError(f"templates have more than {TEMPLATE_WORDS} words")
    classes: dict[int, list[str]] = {}
    for n, name in left:
        largest = next((m for m in classes if 2 * n >= m), n)
        classes.setdefault(largest, []).append(name)
    return classes


def shingles_of(array: str) -> str:
    """SQL for the hashes of an array's runs of five words; the whole array is one run where it is shorter."""
    more = ", ".join(f"get({array}, i + {k})" for k in range(1, SHINGLE))
    return (
        f"slice(transform({array}, (w, i) -> xxhash64(w, {more})), 1, "
        f"IF(size({array}) = 0, 0, greatest(size({array}) - {SHINGLE - 1}, 1)))"
    )


def signature(array: str) -> str:
    """SQL for the MinHash values of an array of shingle hashes, one per band."""
    return (
        f"transform(sequence(0, {BANDS - 1}), b -> named_struct('band', b, 'value', "
        f"array_min(transform({array}, x -> xxhash64(x, b)))))"
    )


def template_table(spark: SparkSession, templates: Mapping[str, str]) -> DataFrame:
    """license, size class, and distinct shingle hashes of every template with a word."""
    of = {name: n for n, names in size_classes(templates).items() for name in names}
    rows = [(name, of[name], words(templates[name])) for name in of]
    table = spark.createDataFrame(rows, "license string, class int, words array<string>")
    return table.select("license", "class", F.expr(f"array_distinct({shingles_of('words')})").alias("shingles"))


def licenses_found(
    docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, containment: float = CONTAINMENT
) -> DataFrame:
    """doc_id, license, containment, first_word and n_windows: each license once per document, by its best window.

    Null and empty texts have none.  Rows with one doc_id, or with none, are one document here.
    """
    spark = docs.sparkSession
    known = template_table(spark, templates)
    every = {n: max(1, n // 2) for n in size_classes(templates)}
    if not every:
        return spark.createDataFrame([], "doc_id long, license string, containment double, first_word int, n_windows long")
    # The templates' shingles as a literal: a few hundred numbers from the parameter.
    hashes = sorted({h for r in known.select("shingles").toLocalIterator() for h in r.shingles})
    wanted = "array(" + ", ".join(f"{h}L" if h > -(2**63) else "-9223372036854775807L - 1L" for h in hashes) + ")"
    cleaned = "trim(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]+', ' '))"
    step = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.expr(f"split({cleaned}, ' ')").alias("_words"))
    # The task's number is not deterministic, so the filter stays above instead of computing the hashes once more.
    packed = F.expr(f"named_struct('task', spark_partition_id(), 'h', {shingles_of('_words')})")
    step = step.select("doc_id", packed.alias("_s")).where(f"arrays_overlap(_s.h, {wanted})")
    step = step.select("doc_id", F.col("_s.h").alias("_h"))
    windows = ", ".join(
        f"transform(sequence(0, size(_h) - 1, {stride}), s -> named_struct('class', {n}, 'start', s, "
        f"'part', slice(_h, s + 1, {max(1, n + stride - SHINGLE + 1)})))"
        for n, stride in every.items()
    )
    each = step.selectExpr("doc_id", f"inline(concat({windows}))").where(f"arrays_overlap(part, {wanted})")
    each = each.selectExpr("doc_id", "class", "start", "array_distinct(part) AS part")
    banded = each.selectExpr("doc_id", "class", "start", "part", f"inline({signature('part')})")
    filed = known.selectExpr("license", "class", "shingles", f"inline({signature('shingles')})")
    # As large as the templates, which are bounded.
    pairs = banded.join(F.broadcast(filed), ["class", "band", "value"])
    share = "size(array_intersect(part, shingles)) / size(shingles)"
    verified = pairs.select("doc_id", "license", "start", F.expr(share).alias("containment"))
    verified = verified.where(f"containment >= {containment!r}D")
    best = F.max_by("start", F.struct("containment", F.expr("-start")))
    return verified.groupBy("doc_id", "license").agg(
        F.max("containment").alias("containment"),
        best.alias("first_word"),
        F.count_distinct("start").alias("n_windows"),
    )


def oracle_sql(templates: Mapping[str, str] = TEMPLATES, containment: float = CONTAINMENT) -> str:
    """The same in DuckDB, each window compared with each template of its class."""
    classes = size_classes(templates)
    of = {name: n for n, names in classes.items() for name in names}
    quoted = ", ".join(
        "('{}', {}, {})".format(name.replace("'", "''"), of[name], str(words(templates[name]))) for name in of
    )
    grid = ", ".join(f"({n}, {max(1, n // 2)})" for n in classes)
    run = "list_transform(range(1, greatest(len({0}) - 3, 2)), lambda i: array_to_string({0}[i:i + 4], ' '))"
    return f"""
    WITH t AS (SELECT license, class, list_distinct({run.format('words')}) AS shingles
               FROM (VALUES {quoted}) AS v(license, class, words)),
    d AS (SELECT row_number() OVER () AS rid, doc_id,
                 string_split(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')), ' ') AS words
          FROM documents WHERE text IS NOT NULL),
    h AS (SELECT rid, doc_id, {run.format('words')} AS h FROM d),
    hit AS (SELECT * FROM h WHERE list_has_any(h, (SELECT flatten(list(shingles)) FROM t))),
    w AS (SELECT doc_id, class, start, list_distinct(h[start + 1:start + class + stride - 4]) AS part
          FROM (SELECT doc_id, h, class, stride, unnest(range(0, len(h), stride)) AS start
                FROM hit, (VALUES {grid}) AS g(class, stride))),
    p AS (SELECT doc_id, license, start, len(list_intersect(part, shingles)) / len(shingles) AS containment
          FROM w JOIN t USING (class))
    SELECT doc_id, license, max(containment) AS containment,
           CAST(max_by(start, (containment, -start)) AS INTEGER) AS first_word, count(DISTINCT start) AS n_windows
    FROM p WHERE containment >= {containment!r} GROUP BY ALL"""
