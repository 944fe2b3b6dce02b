"""Licence scans by Dice coefficient over word bigrams (native DataFrame operations only).

Texts and templates are lower-cased, and what is neither letter nor digit
separates words. Templates are short notices and full licence texts. With A the
bag of bigrams of a window of a document and B that of a template, Dice is
2 |A and B| / (|A| + |B|). At least ``LEAST`` is possible only for windows whose
size is within a factor of (2 - LEAST) / LEAST of the template's, so for each
template windows of sizes between these bounds slide over the whole document: all
sizes of short templates, up to ``SIZES`` evenly spaced ones of long ones, from
every place where a bigram of the template stands.

Pruning, which loses no match: a match needs ``need`` (two thirds at 0.8) of a
template's bigrams, so a document with fewer hits of a template is dropped for
it, and no window of other sizes is looked at. Only bigrams that some template
has are kept beyond the scan, as numbers, and only those of such documents are
shuffled.

How bags are intersected without looking at every window: the k-th occurrence of
a bigram that the template has w times counts in the windows that hold it but not
the occurrence w before it, which is an interval of window starts. Running sums
over the ends of these intervals give every window's intersection.

Of a document's best windows, one for each template, those that overlap a better
one of another licence are left out of its licences, as BSD texts resemble each
other. There is one scan; each document also sends one empty row along, so every
row is in the result.

Defined cases: null text has no bigram; texts of fewer than two words match
nothing; very long texts are scanned whole; repeated rows and null ids are rows of
their own; ties go to the longest template, then to the one that comes first, and
to its first window, the shortest there; an empty table gives an empty result; other columns of the
input are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_table, staged

#: Least Dice coefficient of a match.
LEAST = 0.8
#: Sizes of windows for a template, at most.
SIZES = 12
#: Full licence texts, as published: a file each, named by licence.
TEXTS = Path(__file__).parent / "licence_texts"

# Notices and short licence texts, as published.
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
)


TEMPLATES = (*NOTICES, *((p.stem, p.read_text(encoding="utf-8")) for p in sorted(TEXTS.glob("*.txt"))))


def words_of(text: str) -> list[str]:
    """A template's words, by the rule of ``_words``; templates are ASCII."""
    return re.sub(r"[^a-z0-9]+", " ", text.lower()).split()


def bigrams_of(text: str) -> Counter:
    own = words_of(text)
    return Counter(" ".join(p) for p in zip(own, own[1:], strict=False))


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def bounds(size: int, least: float) -> tuple[int, int]:
    """Least and most bigrams of a window that can reach ``least`` with a template of ``size`` bigrams."""
    fits = [n for n in range(1, int(size * (2 - least) / least) + 2) if 2 * min(n, size) / (n + size) >= least]
    return min(fits), max(fits)


def lengths(size: int, least: float, most: int = SIZES) -> list[int]:
    """Sizes of the windows for a template of ``size`` bigrams: its own and others from bound to bound."""
    lo, hi = bounds(size, least)
    if hi - lo < most:
        return list(range(lo, hi + 1))
    return sorted({lo + (hi - lo) * i // (most - 2) for i in range(most - 1)} | {size})


def need(size: int, least: float) -> int:
    """Fewest bigrams that a window shares with a template of ``size`` if it reaches ``least``."""
    return min(k for k in range(1, size + 1) if 2 * k / (k + size) >= least)


def template_rows(templates=TEMPLATES, least: float = LEAST) -> list[tuple[int, str, str, int, int, int]]:
    """(number, licence, bigram, its count, template's bigrams, fewest shared ones)"""
    out = []
    for i, (licence, text) in enumerate(templates):
        bag = bigrams_of(text)
        size = sum(bag.values())
        fewest = need(size, least) if size else 0
        out += [(i, licence, b, n, size, fewest) for b, n in bag.items()]
    return out


def length_rows(templates=TEMPLATES, least: float = LEAST) -> list[tuple[int, int]]:
    """(template's number, size of a window)"""
    return [(i, n) for i, (_, text) in enumerate(templates) if (size := sum(bigrams_of(text).values())) for n in lengths(size, least)]


def hits(docs: DataFrame, id_col: str, text_col: str, templates, least: float) -> DataFrame:
    """row, id, n (bigrams of the text), pos, gram: where bigrams stand that any template has; and one without ``gram`` for each row."""
    known = [(i, *g.split(" ")) for i, g in enumerate(sorted({r[2] for r in template_rows(templates, least)}))]
    near = F.broadcast(staged(small_table(docs.sparkSession, known, "gram int, one string, two string"), "grams"))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), _words(F.coalesce(F.col(text_col), F.lit(""))).alias("words"))  # before the explosion
    later = F.slice("words", 2, F.greatest(F.size("words"), F.lit(1)))
    n = F.greatest(F.size("words") - 1, F.lit(0))
    # a text's last word has none after it: that is its empty row (or, without any word, the outer one)
    each = rows.select("row", "id", n.alias("n"), F.posexplode_outer(F.arrays_zip(F.col("words").alias("first"), later.alias("second"))).alias("pos", "pair"))
    found = each.join(near, (F.col("pair.first") == F.col("one")) & (F.col("pair.second") == F.col("two")), "left").where(F.col("gram").isNotNull() | F.col("pair.second").isNull())
    # the id goes with the empty row alone; what is staged is read several times, and row numbers stay as they are
    return staged(found.select("row", F.when(F.col("gram").isNull(), F.col("id")).alias("id"), "n", "pos", "gram"), "hits")


def matches(found: DataFrame, templates=TEMPLATES, least: float = LEAST) -> DataFrame:
    """The best window of each row and template that reaches ``least``: row, template, licence, b, dice, first, last (bigrams)."""
    spark, told = found.sparkSession, template_rows(templates, least)
    gram = {g: i for i, g in enumerate(sorted({r[2] for r in told}))}
    # staged: thousands of rows inside a plan make planning slow
    near = F.broadcast(staged(small_table(spark, [(t, licence, gram[g], *rest) for t, licence, g, *rest in told], "template int, licence string, gram int, want int, b int, need int"), "templates"))
    sizes = F.broadcast(small_table(spark, length_rows(templates, least), "template int, len int"))
    own = found.where("gram IS NOT NULL").join(near.select("template", "gram", "need"), "gram")
    enough = own.groupBy("row", "template").agg(F.count("*").alias("all"), F.first("need").alias("need")).where("all >= need").select("row", "template")
    some = found.where("gram IS NOT NULL").join(enough, "row").join(near, ["template", "gram"])
    same = some.groupBy("row", "template", "gram").agg(F.sort_array(F.collect_list("pos")).alias("ps"), *[F.first(c).alias(c) for c in ("n", "licence", "want", "b")])
    # an occurrence counts from after the one that is ``want`` before it
    after = F.transform("ps", lambda p, k: F.struct(p.alias("p"), F.when(k >= F.col("want"), F.try_element_at("ps", k - F.col("want") + 1) + 1).otherwise(0).alias("lo")))
    each = same.select("row", "template", "n", "licence", "b", F.explode(after).alias("o")).join(sizes, "template")
    event = lambda at, delta, asked: F.struct(at.alias("at"), F.lit(asked).alias("asked"), F.lit(delta).alias("delta"))
    events = F.array(event(F.greatest(F.col("o.lo"), F.col("o.p") - F.col("len") + 1), 1, 0), event(F.col("o.p") + 1, -1, 0), event(F.col("o.p"), 0, 1))
    line = each.select("row", "template", "n", "licence", "b", "len", F.explode(events).alias("e")).select("*", "e.*").drop("e")
    sofar = Window.partitionBy("row", "template", "len").orderBy("at", "asked").rowsBetween(Window.unboundedPreceding, 0)
    asked = line.withColumn("both", F.sum("delta").over(sofar)).where("asked = 1").withColumn("size", F.least(F.col("len"), F.col("n") - F.col("at")))
    dice = F.lit(2.0) * F.col("both") / (F.col("size") + F.col("b"))
    best = asked.withColumn("dice", dice).where(F.col("dice") >= least).groupBy("row", "template").agg(F.first("licence").alias("licence"), F.first("b").alias("b"), F.min(F.struct((-F.col("dice")).alias("d"), F.col("at"), F.col("size"))).alias("w"))
    return best.select("row", "template", "licence", "b", (-F.col("w.d")).alias("dice"), F.col("w.at").alias("first"), (F.col("w.at") + F.col("w.size") - 1).alias("last"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, least: float = LEAST) -> DataFrame:
    """One row per row of ``docs``: id, licence (the best match's; null: none), dice, n_matches (templates that match), licences (names of all, by name, comma-joined)."""
    found = hits(docs, id_col, text_col, templates, least)
    one = matches(found, templates, least).select("row", F.lit(None).cast(dict(found.dtypes)["id"]).alias("id"), F.struct((-F.col("dice")).alias("d"), (-F.col("b")).alias("less"), "template", "licence", "first", "last").alias("m"))
    rows = found.where("gram IS NULL").select("row", "id", F.lit(None).cast(dict(one.dtypes)["m"]).alias("m")).unionByName(one)
    own = rows.groupBy("row").agg(F.max("id").alias("id"), F.array_sort(F.collect_list("m")).alias("ms"))
    better = lambda m, o: (o["licence"] != m["licence"]) & (o["first"] <= m["last"]) & (m["first"] <= o["last"]) & (o < m)
    kept = F.filter("ms", lambda m: ~F.exists("ms", lambda o: better(m, o)))
    names = F.array_join(F.array_sort(F.array_distinct(F.transform(kept, lambda m: m["licence"]))), ",")
    first = F.try_element_at("ms", F.lit(1))
    return own.select(F.col("id").alias(id_col), first["licence"].alias("licence"), (-first["d"]).alias("dice"), F.size("ms").cast("long").alias("n_matches"), names.alias("licences"))


def oracle(templates=TEMPLATES, least: float = LEAST) -> str:
    """The same scan in DuckDB SQL, window by window."""
    quoted = lambda x: "'" + str(x).replace("'", "''") + "'"
    values = ", ".join(f"({i}, {quoted(licence)}, {quoted(' '.join(words_of(text)))})" for i, (licence, text) in enumerate(templates))
    sizes = ", ".join(map(str, length_rows(templates, least)))
    return rf"""
WITH tt(template, licence, text) AS (VALUES {values}),
sz(template, len) AS (VALUES {sizes}),
tw AS (SELECT template, licence, string_split(text, ' ') AS words FROM tt),
tg AS (SELECT template, licence, len(words) - 1 AS b, unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS bigram FROM tw),
t AS (SELECT template, licence, b, bigram, count(*) AS want FROM tg GROUP BY ALL),
d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT row, list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS words FROM d),
g AS (SELECT row, len(words) - 1 AS n, unnest(range(0, len(words) - 1)) AS pos, unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS bigram FROM w WHERE len(words) > 1),
h AS (SELECT row, n, pos, bigram, template, licence, want, b FROM g JOIN t USING (bigram) QUALIFY 2.0::DOUBLE * count(*) OVER (PARTITION BY row, template) / (count(*) OVER (PARTITION BY row, template) + b) >= {least}),
c AS (
  SELECT s.row, s.template, s.licence, s.b, s.pos AS first, len, least(len, s.n - s.pos) AS size, p.bigram, least(count(*), any_value(p.want)) AS shared
  FROM h s JOIN sz USING (template) JOIN h p ON p.row = s.row AND p.template = s.template AND p.pos BETWEEN s.pos AND s.pos + len - 1
  GROUP BY s.row, s.template, s.licence, s.b, s.pos, len, s.n, p.bigram),
v AS (SELECT row, template, licence, b, first, size, 2.0::DOUBLE * sum(shared) / (size + b) AS dice FROM c GROUP BY row, template, licence, first, len, size, b),
k AS (SELECT *, first + size - 1 AS last FROM v WHERE dice >= {least} QUALIFY row_number() OVER (PARTITION BY row, template ORDER BY dice DESC, first, size) = 1),
best AS (SELECT row, licence, dice FROM k QUALIFY row_number() OVER (PARTITION BY row ORDER BY dice DESC, b DESC, template) = 1),
n AS (SELECT row, count(*) AS n_matches FROM k GROUP BY row),
own AS (
  SELECT row, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences FROM k AS m
  WHERE NOT EXISTS (SELECT 1 FROM k AS o WHERE o.row = m.row AND o.licence <> m.licence AND o.first <= m.last AND m.first <= o.last AND (o.dice > m.dice OR o.dice = m.dice AND (o.b > m.b OR o.b = m.b AND o.template < m.template)))
  GROUP BY row)
SELECT doc_id, licence, dice, coalesce(n_matches, 0) AS n_matches, coalesce(licences, '') AS licences FROM d LEFT JOIN best USING (row) LEFT JOIN n USING (row) LEFT JOIN own USING (row)
"""
