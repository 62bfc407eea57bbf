"""Licence scans: Dice coefficient over word bigrams against licence templates, in DataFrame functions only.

Case, punctuation, comment marks and white space are normalised away, line ends too, so a statement may be wrapped, commented out or share its lines
with others. Dice is 2 x common / (a + b) over bigrams, repeats included, so with a least value d a
statement of a bigrams can only match templates of between a d / (2 - d) and a (2 - d) / d: the size bounds.

A match has at least d / (2 - d) of its template's bigrams. So of a few more than the other part of a template's bigrams, its anchors, every
match has one. Candidates are the runs of words around an anchor in the text, put so that the run begins, or ends, where the template
would if its anchor stood there, in every length within the size bounds. An anchor's template is the only one that the run is compared with. In the
same way a few marker words are chosen of which every match of any template has one; texts without any are done after one look.
Templates are a short, fixed list of literals, so there is no join and no shuffle.

Defined results: null, empty and one-word texts match nothing. ``n_matches`` is the greatest number of matching runs that don't overlap; of all
matching runs the best is named (ties: the first name). Every row of the input gives one row, repeated or not. Texts of any length are scanned whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Usual statements of licences, by SPDX identifier.
TEMPLATES = {
    "AGPL-3.0": "This program is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "You may not use this file except in compliance with the Apache License.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "LGPL-2.1": "This library is licensed under the GNU Lesser General Public License, version 2.1.",
    "MIT": "Released under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "BSD-disclaimer": "This software is provided by the copyright holders and contributors as is and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed.",
    "BSL-1.0": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license to use, reproduce, display, distribute, execute, and transmit the Software.",
    "GPL-2.0-notice": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MIT-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions.",
    "Unlicense-grant": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "Zlib": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions.",
}
LEAST = 0.8
#: Bounds are rounded numbers; the coefficient itself decides at the edge.
SLACK = 1e-9


def normal_words(text: str) -> list[str]:
    return re.sub(r"[^0-9A-Za-z]+", " ", text).lower().split()


def bigrams(words: list[str]) -> list[str]:
    return [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def known_bigrams(templates: Mapping[str, str]) -> dict[str, list[str]]:
    """By name in order."""
    known = {name: bigrams(normal_words(t)) for name, t in sorted(templates.items())}
    for name, grams in known.items():
        if not grams:
            raise ValueError(f"template {name} has no bigram")
    return known


def repeated(grams: list[str]) -> dict[str, int]:
    return {g: n for g, n in Counter(grams).items() if n > 1}


def sizes(grams: list[str], least: float) -> tuple[int, int]:
    """Fewest and most bigrams of a match."""
    n = len(grams)
    return math.ceil(n * least / (2 - least) - SLACK), math.floor(n * (2 - least) / least + SLACK)


def anchors(grams: list[str], least: float) -> dict[str, int]:
    """Bigrams of which every match has one, with their places; long ones, as they are rare in other texts."""
    need = len(grams) - sizes(grams, least)[0] + 1
    once = sorted((g for g, n in Counter(grams).items() if n == 1), key=lambda g: (-len(g), g))
    if len(once) < need:
        raise ValueError("a template repeats too many of its bigrams")
    return {g: grams.index(g) for g in once[:need]}


def markers(known: Mapping[str, list[str]], least: float) -> list[str]:
    """Words and bigrams of which every match has one; long words first, as they are rare in other texts."""
    need = {name: len(t) - sizes(t, least)[0] + 1 for name, t in known.items()}
    hit: dict[str, set[int]] = {name: set() for name in known}
    words = {w for t in known.values() for g in t for w in (g, *g.split())}
    places = {w: {name: {k for k, g in enumerate(t) if w in g} for name, t in known.items()} for w in words}
    chosen = []
    while open_ := [n for n in known if len(hit[n]) < need[n]]:
        gain = {w: sum(len(places[w][n] - hit[n]) for n in open_) for w in words - set(chosen)}
        best_word = max(gain, key=lambda w: (gain[w] > 0 and len(w) >= 6, gain[w] * len(w), w))
        chosen.append(best_word)
        for n in known:
            hit[n] |= places[best_word][n]
    return chosen


def normalised(text: Column) -> Column:
    return F.trim(F.lower(F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), "[^0-9A-Za-z]+", " ")))


def quoted(texts: Iterable[str]) -> str:
    return ", ".join(f"'{t}'" for t in texts)


def literals(known: Mapping[str, list[str]], least: float) -> tuple[str, str]:
    """Templates (licence, m bigrams, few and most of a match, the different ones, repeated ones) and anchors (bigram, template, place) as SQL arrays."""
    rows, points = [], []
    for k, (name, grams) in enumerate(known.items(), 1):
        few, most = sizes(grams, least)
        twice = ", ".join(f"named_struct('g', '{g}', 'times', {n})" for g, n in repeated(grams).items())
        rows.append(f"named_struct('licence', '{name}', 'm', {len(grams)}, 'few', {few}, 'most', {most}, 't', array({quoted(dict.fromkeys(grams))}), 'r', CAST(array({twice}) AS array<struct<g: string, times: int>>))")
        points += [f"named_struct('g', '{g}', 'k', {k}L, 'place', {place})" for g, place in anchors(grams, least).items()]
    return f"array({', '.join(rows)})", f"array({', '.join(points)})"


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, *, least: float = LEAST, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id``, ``n_matches`` long (matching runs apart), ``licence`` and ``score`` of the best (null without one)."""
    if not templates or not 0 < least <= 1:
        raise ValueError("one template at least, and a least coefficient above 0 and up to 1")
    known = known_bigrams(templates)
    templates_sql, anchors_sql = literals(known, least)
    every = quoted(sorted({g for t in known.values() for g in anchors(t, least)}))
    marked = " OR ".join(f"contains(plain, '{w}')" for w in markers(known, least))
    plain = docs.select(F.col(key).alias("doc_id"), normalised(F.col(text)).alias("plain"))
    cut = plain.select("doc_id", F.expr(f"CASE WHEN {marked} THEN split(plain, ' ') ELSE CAST(array() AS array<string>) END").alias("w"))
    paired = cut.select("doc_id", F.expr("zip_with(slice(w, 1, greatest(size(w) - 1, 0)), slice(w, 2, greatest(size(w) - 1, 0)), (a, b) -> concat_ws(' ', a, b))").alias("grams"))
    some = paired.select("doc_id", "grams", F.expr(f"filter(transform(grams, (g, k) -> named_struct('g', g, 'at', k)), h -> h.g IN ({every}))").alias("hits"))
    # a start is one long: the template above 2^40, below it the place, which may lie up to a template before the text
    codes = some.select("doc_id", "grams", F.expr(f"array_distinct(flatten(transform(hits, h -> transform(filter({anchors_sql}, a -> a.g = h.g), a -> shiftleft(a.k, 40) + {1 << 20} + h.at - a.place))))").alias("codes"))
    starts = codes.select("doc_id", "grams", F.expr(f"transform(codes, c -> named_struct('k', CAST(shiftright(c, 40) AS INT), 'at', CAST((c & {(1 << 40) - 1}) - {1 << 20} AS INT)))").alias("starts"))
    t = f"element_at({templates_sql}, s.k)"
    runs = starts.select("doc_id", "grams", F.expr(f"""
        filter(flatten(transform(starts, s -> flatten(transform(sequence({t}.few, {t}.most), n -> array(named_struct('k', s.k, 'at', s.at, 'n', n), named_struct('k', s.k, 'at', s.at + {t}.m - n, 'n', n)))))),
          r -> r.at >= 0 AND r.at + r.n <= size(grams))""").alias("runs"))  # fmt: skip
    t = f"element_at({templates_sql}, x.r.k)"
    scored = runs.select("doc_id", F.expr(f"""
        transform(transform(runs, r -> named_struct('r', r, 'own', slice(grams, r.at + 1, r.n))), x -> named_struct('after', x.r.at + x.r.n + 1, 'at', x.r.at, 'minus',
          -2.0D * aggregate({t}.r, size(array_intersect(x.own, {t}.t)), (c, y) -> c + greatest(least(size(filter(x.own, g -> g = y.g)), y.times) - 1, 0)) / (x.r.n + {t}.m),
          'licence', {t}.licence))""").alias("scored"))  # fmt: skip
    found = scored.select("doc_id", F.array_sort(F.filter("scored", lambda m: m["minus"] <= -least)).alias("m"))
    top = F.array_min(F.transform("m", lambda m: F.struct(m["minus"].alias("minus"), m["licence"].alias("licence"))))
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("after"))
    apart = F.aggregate("m", start, lambda x, m: F.when(m["at"] >= x["after"], F.struct((x["n"] + 1).alias("n"), m["after"].alias("after"))).otherwise(x), lambda x: x["n"])
    done = found.select("doc_id", F.coalesce(apart, F.lit(0)).cast("long").alias("n_matches"), top.alias("top"))
    return done.select("doc_id", "n_matches", F.col("top.licence").alias("licence"), (-F.col("top.minus")).alias("score"))


def oracle(templates: Mapping[str, str] = TEMPLATES, least: float = LEAST) -> str:
    """The same scan as DuckDB SQL over ``documents``."""
    known = known_bigrams(templates)
    rows = ", ".join(f"('{name}', {grams!r}, {sizes(grams, least)[0]}, {sizes(grams, least)[1]})" for name, grams in known.items())
    points = ", ".join(f"('{name}', '{g}', {k})" for name, grams in known.items() for g, k in anchors(grams, least).items())
    return f"""
    WITH templates(licence, t, few, most) AS (VALUES {rows}), anchors(licence, gram, place) AS (VALUES {points}),
    words AS (SELECT doc_id, string_split(trim(lower(regexp_replace(coalesce(text, ''), '[^0-9A-Za-z]+', ' ', 'g'))), ' ') AS w FROM documents),
    grams AS (SELECT doc_id, list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1]) AS g FROM words WHERE len(w) > 1),
    places AS (SELECT DISTINCT doc_id, licence, k - 1 - place AS s FROM (SELECT doc_id, unnest(g) AS gram, generate_subscripts(g, 1) AS k FROM grams) JOIN anchors USING (gram)),
    lengths AS (SELECT p.doc_id, p.licence, p.s, t.t, unnest(generate_series(t.few, t.most)) AS n FROM places p JOIN templates t USING (licence)),
    runs AS (SELECT DISTINCT doc_id, licence, pos, n FROM (SELECT doc_id, licence, s AS pos, n FROM lengths UNION ALL SELECT doc_id, licence, s + len(t) - n, n FROM lengths)),
    own AS (SELECT r.doc_id, r.licence, r.pos, r.n, t.t, g.g[r.pos + 1 : r.pos + r.n] AS o FROM runs r JOIN grams g USING (doc_id) JOIN templates t USING (licence) WHERE r.pos >= 0 AND r.pos + r.n <= len(g.g)),
    scores AS (
      SELECT doc_id, licence, pos, n, 2.0::DOUBLE * list_sum(list_transform(list_distinct(list_intersect(o, t)), lambda x: least(len(list_filter(o, lambda y: y = x)), len(list_filter(t, lambda y: y = x))))) / (n + len(t)) AS score FROM own),
    matches AS (SELECT * FROM scores WHERE score >= {least}),
    line AS (SELECT doc_id, list_sort(list({{'after': pos + n + 1, 'pos': pos, 'n': 0::BIGINT}})) AS m, arg_min(licence, (-score, licence)) AS licence, max(score) AS score FROM matches GROUP BY doc_id),
    counted AS (SELECT doc_id, licence, score, list_reduce(list_prepend({{'after': 0::BIGINT, 'pos': 0::BIGINT, 'n': 0::BIGINT}}, m), lambda x, y: CASE WHEN y.pos >= x.after THEN {{'after': y.after, 'pos': y.pos, 'n': x.n + 1}} ELSE x END).n AS n FROM line)
    SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_matches, licence, score FROM documents d LEFT JOIN counted USING (doc_id)"""
