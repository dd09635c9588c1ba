"""Licence of each file: TF-IDF cosine of notices and licence files to templates, then inheritance by directory."""

from __future__ import annotations

import re
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tunehouse.llm.common import landed

THRESHOLD = 0.8
WORD = r"[a-z0-9]++(?:\.[0-9]++)*+"  # possessive: else a call deeper for every repeat, or each length tried anew
SIGNAL = r"(?i)licen[cs]e|copyright|warrant|redistribut|permission|public domain|rights reserved"
BREAK = r"\n|(?<=[.!?])[ \t]+"  # between sentences; a line break ends one too
PARAGRAPH = r"\n[ \t]*\n"
# what marks a line as a comment, at its start or end
MARK = r"""(?m)^[ \t]*+(?://+!?|/?\*+!?(?!/)|\*+/|#+|;+|--+|%+|<!--|\"\"\"|'''|(?:@?rem|@?REM|Rem|dnl)\b)?[ \t]*+|(?:(?<![ \t])[ \t]++(?:\*++/|-->)?+|(?<!\*)\*++/|-->)[ \t]*+$"""
SIGNAL_WORD = r"licen[cs]e|copyright|warrant|redistribut|permission|domain|reserved"
LONG = 12  # words from which a template is looked for in windows of its length
LINES = (2, 3, 4)  # lines over which a shorter one may be wrapped
LICENSE_FILE = r"(?i)^(un)?(licen[cs]e|copying|notice)([.-][^/]*)?$"
# an SPDX tag's expression, up to the end of the line or comment
SPDX_TAG = r"(?i)SPDX-License-Identifier:[ \t]*+([a-z0-9.+:() -]++)"
ROW = "__row"

# fixed values: the wording of common notices, by SPDX identifier
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("MIT", "Released under the MIT License."),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction'),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("Proprietary", "All rights reserved."),
)
# whole licences, by SPDX identifier
WHOLE_TEXTS = tuple((p.stem, p.read_text(encoding="utf-8")) for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt")))


def words(text: Column) -> Column:
    """Lower-case words and version numbers."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def spdx_expression(text: Column) -> Column:
    """What the first SPDX tag of a text says: an identifier without "-only", "-or-later" or "+", or an expression of
    several as it stands, without brackets around the whole; NULL where there is none."""
    said = F.regexp_replace(F.trim(F.regexp_extract(text, SPDX_TAG, 1)), r"[ -]++$", "")
    bare = F.when(said.rlike(r"^\([^()]*\)$"), F.trim(F.substring(said, F.lit(2), F.length(said) - 2))).otherwise(said)
    single = F.regexp_replace(bare, r"(?i)(?:-only|-or-later|\+)$", "")
    return F.when(bare.rlike(r"^[A-Za-z0-9.+-]+$"), single).when(bare != "", bare)


def template_words(docs: DataFrame) -> DataFrame:
    """(template, license, full, term, tf) of the notices and, as full ones, of the whole licences."""
    every = [(k, False, t) for k, t in TEMPLATES] + [(k, True, t) for k, t in WHOLE_TEXTS]
    listed = F.array(*[F.struct(F.lit(i).alias("template"), F.lit(k).alias("license"), F.lit(f).alias("full"), F.lit(t).alias("text")) for i, (k, f, t) in enumerate(every)])
    one = docs.sparkSession.range(1).select(F.explode(listed).alias("t")).select("t.*")
    return one.select("template", "license", "full", F.explode(words(F.col("text"))).alias("term")).groupBy("template", "license", "full", "term").agg(F.count("*").alias("tf"))


def inverse_frequencies(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(term, idf, idf_other): idf = ln((1 + documents) / (1 + documents with the term)) + 1 over all documents.

    Only the templates' words are counted, by an intersection within each row, so a row per word and task is
    shuffled. Any other word weighs idf_other, as if no document had it.
    """
    vocabulary = sorted({w for _, text in TEMPLATES for w in re.findall(WORD, text.lower())})
    known = F.array(*map(F.lit, vocabulary))
    has = F.array_intersect(words(F.coalesce(F.col(text_col).cast("string"), F.lit(""))), known)
    # every document counts for the empty term, and for each template word in it
    terms = docs.select(F.explode(F.array_append(has, F.lit(""))).alias("term"), F.lit(1).alias("df"))
    none = docs.sparkSession.range(1).select(F.explode(F.array_append(known, F.lit(""))).alias("term"), F.lit(0).alias("df"))
    counts = terms.groupBy("term").agg(F.sum("df").alias("df")).unionByName(none).groupBy("term").agg(F.sum("df").alias("df"))
    total = F.max(F.when(F.col("term") == "", F.col("df"))).over(W.partitionBy(F.lit(1)))  # one row per template word
    n = (total + 1).cast("double")
    weighed = counts.select("term", (F.log(n / (F.col("df") + 1)) + 1).alias("idf"), (F.log(n) + 1).alias("idf_other"))
    return weighed.where("term != ''")


def _template_lengths() -> dict[int, list[list[str]]]:
    """The templates' words, by their number."""
    lengths: dict[int, list[list[str]]] = {}
    for _, text in TEMPLATES:
        found = re.findall(WORD, text.lower())
        lengths.setdefault(len(found), []).append(found)
    return lengths


def alike(tokens: Column, templates: list[list[str]]) -> Column:
    """Whether the words hold a third of the different words of a template; parts with fewer are not scored."""
    share = [F.size(F.array_intersect(tokens, F.array(*map(F.lit, sorted(set(t)))))) * 3 >= len(set(t)) for t in templates]
    return reduce(lambda a, b: a | b, share)


def windows(text: Column) -> Column:
    """Runs of as many words as a long template has that hold a word of licensing, whatever lines and sentences they
    lie in: from every place where a template's first two words stand, and from every eighth of its length."""

    def of_words(tokens: Column) -> Column:
        signals = F.filter(F.sequence(F.lit(0), F.size(tokens) - 1), lambda i: F.get(tokens, i).rlike(SIGNAL_WORD))

        def of_length(n: int, templates: list[list[str]]) -> Column:
            heads = [" ".join(t[:2]) for t in templates]

            near = lambda p: F.sequence(F.greatest(p - (n - 1), F.lit(0)), p)
            head = lambda i: F.concat_ws(" ", F.get(tokens, i), F.get(tokens, i + 1)).isin(heads)
            places = F.array_distinct(F.flatten(F.transform(signals, near)))
            starts = F.filter(places, lambda i: (i % (n // 8 or 1) == 0) | head(i))
            runs = F.filter(F.transform(starts, lambda i: F.slice(tokens, i + 1, F.lit(n))), lambda run: alike(run, templates))
            return F.transform(runs, lambda run: F.array_join(run, " "))

        return F.concat(*[of_length(n, templates) for n, templates in _template_lengths().items() if n >= LONG])

    # a variable of one value, so that the words are found once
    return F.flatten(F.transform(F.array(words(text)), of_words))


def line_runs(text: Column) -> Column:
    """Some consecutive lines, joined, where they are not much longer than a short template and like one."""
    short = [t for n, templates in _template_lengths().items() if n < LONG for t in templates]
    fits = lambda tokens: (F.size(tokens) <= 2 * LONG) & alike(tokens, short)

    def of_lines(lines: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(lines))
        run = lambda k: lambda i: F.array_join(F.slice(lines, i, F.lit(k)), " ")
        return F.concat(*[F.transform(starts, run(k)) for k in LINES])

    joined = F.flatten(F.transform(F.array(F.split(text, "\r?\n")), of_lines))
    return F.filter(joined, lambda p: p.rlike(SIGNAL) & F.exists(F.array(words(p)), fits))


def segments(text: Column) -> Column:
    """Parts that hold a word of licensing, and the whole text, without repeats: (whole, text).

    Parts are sentences, lines and paragraphs, sentences and paragraphs of the text without comment marks, sentences
    going on over lines there, a few consecutive lines there, and windows of the long templates' lengths.
    """

    def held(parts: Column) -> Column:
        return F.filter(parts, lambda p: p.rlike(SIGNAL))

    plain = F.regexp_replace(text, MARK, "")
    blocks = F.transform(F.split(plain, PARAGRAPH), lambda p: F.regexp_replace(p, "\\s+", " "))
    sentences = F.flatten(F.transform(held(blocks), lambda p: F.split(p, r"(?<=[.!?])[ \t]+")))
    own = F.concat(held(F.split(text, BREAK)), held(F.split(text, "\n")), held(F.split(text, PARAGRAPH)))
    # the same words in other white space are the same part
    squeezed = lambda parts: F.transform(parts, lambda p: F.trim(F.regexp_replace(p, "\\s+", " ")))
    templates = [t for found in _template_lengths().values() for t in found]
    long_ones = F.filter(F.concat(held(blocks), held(sentences)), lambda p: F.exists(F.array(words(p)), lambda tokens: alike(tokens, templates)))
    more = F.array_except(squeezed(F.concat(long_ones, line_runs(plain))), squeezed(own))
    parts = F.concat(own, more, windows(text))
    notices = F.transform(F.array_distinct(parts), lambda p: F.struct(F.lit(False).alias("whole"), p.alias("text")))
    return F.array_append(notices, F.struct(F.lit(True).alias("whole"), text.alias("text")))


def best_templates(candidates: DataFrame, idf: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(row, whole, license, score) for every row's notices, and for its whole text, that reach the threshold.

    Whole texts are compared with whole licences only, their parts with notices; words in no notice all weigh idf_other.
    Vectors are sparse: a row per segment and word. Weights and templates are broadcast; both are bounded by the list of templates.
    """
    segment = [ROW, "whole", "place"]
    # few texts, but many rows of each: the number of tasks is not left to their size
    dealt = candidates.select(ROW, "text").repartition(int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions")), ROW)
    cut = dealt.select(ROW, F.posexplode(segments(F.col("text"))).alias("place", "s"))
    tokens = cut.select(ROW, "s.whole", "place", F.explode(words(F.col("s.text"))).alias("term"))
    # dealt by segment once: counts, norms and products all follow that
    tf = tokens.repartition(*segment).groupBy(*segment, "term").agg(F.count("*").alias("tf"))
    other = F.lit(idf.first()["idf_other"])
    weighed = tf.join(F.broadcast(idf.select("term", "idf")), "term", "left")
    weighed = weighed.withColumn("w", F.col("tf") * F.coalesce("idf", other))
    vectors = template_words(candidates).join(F.broadcast(idf.select("term", "idf")), "term", "left").withColumn("tw", F.col("tf") * F.coalesce("idf", other))
    norms = vectors.groupBy("template").agg(F.sqrt(F.sum(F.col("tw") * F.col("tw"))).alias("tn"))
    scaled = vectors.join(norms, "template").groupBy("term").agg(F.collect_list(F.struct("template", "license", "full", (F.col("tw") / F.col("tn")).alias("tw"))).alias("in"))
    # one row per segment and word; the products with all templates are kept beside it, so norms and products need one shuffle
    paired = weighed.join(F.broadcast(scaled), "term", "left")
    norm = paired.groupBy(*segment).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    hits = paired.select(*segment, "w", F.explode(F.filter("in", lambda t: t["full"] == F.col("whole"))).alias("t")).groupBy(*segment, "t.template", "t.license").agg(F.sum(F.col("w") * F.col("t.tw")).alias("dot"))
    score = hits.join(norm, segment).select(ROW, "whole", "license", F.round(F.col("dot") / F.col("norm"), 6).alias("score"))
    reached = score.where(F.col("score") >= threshold)
    # of equal scores the licence that comes first by name
    best = reached.groupBy(ROW, "whole").agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("b"))
    return best.select(ROW, "whole", "b.license", (-F.col("b.s")).alias("score"))


def directory(path: Column) -> Column:
    """All of a path before its last slash; empty at the top."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def ancestors(folder: Column) -> Column:
    """A directory and all above it, the empty one included."""
    parts = F.split(folder, "/")
    up = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    return F.array_distinct(F.array_append(up, F.lit("")))


def license_scan(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``files`` (key, path, text): key, path, license, score, origin, inherited_from.

    origin: "header" for a notice anywhere in the text (its first and last line alike), "file" for a licence file
    (a licence's whole text, or a notice in a file of such a name), "inherited" where the file has none and the nearest directory above it,
    its own first, has a licence file; NULL with a NULL license where there is none. Of several licence files in
    a directory the one of the highest score counts, of equal ones the smallest licence name. Scores are rounded to 6 decimals.
    An SPDX tag says its licence itself, with a score of 1, and goes before notices.
    Texts are read whole; NULL and blank texts and NULL paths have no notice (a NULL path inherits from the top
    directory). Rows are told apart by a number, so repeated rows and NULL keys each give a row; other columns are not read.
    """
    slim = files.select("key", F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"), F.col("text").cast("string").alias("text"))
    idf = landed(inverse_frequencies(slim), "license-idf")[0]
    # one pass: the text stays with the rows that may have a notice
    text = F.when(F.col("text").rlike(SIGNAL), F.col("text"))
    tag = spdx_expression(F.col("text"))
    every = landed(slim.select("key", "path", text.alias("text"), tag.alias("spdx"), F.monotonically_increasing_id().alias(ROW)), "license-files")[0]
    marked = every.where("text is not null")
    best = landed(best_templates(marked, idf, threshold), "license-matches")[0]
    whole = best.where("whole").select(ROW, F.col("license").alias("whole_license"), F.col("score").alias("whole_score"))
    part = best.where("not whole").select(ROW, "license", "score")
    name = F.regexp_extract("path", "[^/]*$", 0)
    judged = marked.drop("text").join(whole, ROW, "left").join(part.withColumnRenamed("license", "noticed"), ROW, "left")
    judged = judged.withColumns(
        {
            "license": F.coalesce("spdx", "noticed"),
            "score": F.when(F.col("spdx").isNotNull(), F.lit(1.0)).otherwise(F.col("score")),
        }
    )
    is_file = F.col("whole_license").isNotNull() | (name.rlike(LICENSE_FILE) & F.col("license").isNotNull())
    own = landed(
        judged.select(
            "key",
            "path",
            F.coalesce("whole_license", "license").alias("license"),
            F.coalesce("whole_score", "score").alias("score"),
            F.when(is_file, F.lit("file")).when(F.col("license").isNotNull(), F.lit("header")).alias("origin"),
        ),
        "license-own",
    )[0]
    of_files = own.where("origin = 'file'").groupBy(directory(F.col("path")).alias("above"))
    shelves = of_files.agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("b"))
    shelves = shelves.select("above", F.col("b.license").alias("shelf_license"), (-F.col("b.s")).alias("shelf_score"))
    without = own.where("origin is null").select("key", "path").unionByName(every.where("text is null").select("key", "path"))
    folders = without.select(directory(F.col("path")).alias("folder")).distinct()
    above = folders.select("folder", F.explode(ancestors(F.col("folder"))).alias("above")).join(shelves, "above")
    nearest = above.groupBy("folder").agg(F.max_by(F.struct("shelf_license", "shelf_score", "above"), F.length("above")).alias("near"))
    nearest = landed(nearest, "license-folders")[0]
    heirs = without.withColumn("folder", directory(F.col("path"))).join(nearest, "folder", "left")
    inherited = heirs.select(
        "key",
        "path",
        F.col("near.shelf_license").alias("license"),
        F.col("near.shelf_score").alias("score"),
        F.when(F.col("near").isNotNull(), F.lit("inherited")).alias("origin"),
        F.col("near.above").alias("inherited_from"),
    )
    found = own.where("origin is not null").withColumn("inherited_from", F.lit(None).cast("string"))
    return found.unionByName(inherited)


def document_files(docs: DataFrame) -> DataFrame:
    """Documents as files (key, path, text): source / thousands / hundreds / doc_id.txt."""
    number = F.col("doc_id").cast("bigint")
    part = lambda n: F.coalesce(F.expr(f"cast(cast(doc_id as bigint) div {n} as string)"), F.lit("none"))
    source = F.coalesce(F.col("source").cast("string"), F.lit("none"))
    path = F.concat_ws("/", source, part(1000), part(100), F.concat(F.coalesce(number.cast("string"), F.lit("none")), F.lit(".txt")))
    return docs.select(F.col("doc_id").alias("key"), path.alias("path"), "text")


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_TEXTS = Path(__file__).resolve().parent / "license_texts"
_SQL_WORD = r"[a-z0-9]+(?:\.[0-9]+)*"

#: DuckDB, over the documents as files
LICENSE_SQL = rf"""
with tpl(template, license, text) as (values {", ".join(f"({i}, {_sql_text(k)}, {_sql_text(t)})" for i, (k, t) in enumerate(TEMPLATES))}),
full_tpl as (select 1000 + row_number() over (order by filename) as template,
                    regexp_extract(filename, '([^/]*)\.txt$', 1) as license, content as text from read_text('{_TEXTS}/*.txt')),
tw as (select template, license, term, count(*) as tf
       from (select template, license, unnest(regexp_extract_all(lower(text), '{_SQL_WORD}')) as term from tpl) group by all),
fw as (select template, license, term, count(*) as tf
       from (select template, license, unnest(regexp_extract_all(lower(text), '{_SQL_WORD}')) as term from full_tpl) group by all),
d as (select row_number() over () as r, doc_id, text as t,
             concat_ws('/', coalesce(source, 'none'), coalesce((doc_id // 1000)::varchar, 'none'),
                       coalesce((doc_id // 100)::varchar, 'none'), coalesce(doc_id::varchar, 'none') || '.txt') as path from documents),
n as (select 1.0 + count(*) as n from d),
df as (select term, count(*) as df from (select distinct r, unnest(regexp_extract_all(lower(coalesce(t, '')), '{_SQL_WORD}')) as term from d)
       where term in (select term from tw) group by term),
idf as (select term, ln(n / (coalesce(df, 0) + 1)) + 1 as idf from (select distinct term from tw) left join df using (term), n),
c as (select r, t from d where regexp_matches(t, '{SIGNAL}')),
g as (select r, false as whole, unnest(list_distinct(list_filter(list_concat(
          string_split(regexp_replace(t, '([.!?])[ \t]+', '\1' || chr(10), 'g'), chr(10)), string_split(t, chr(10)),
          string_split_regex(t, '{PARAGRAPH}')), lambda x: regexp_matches(x, '{SIGNAL}')))) as s from c
      union all select r, true, t from c),
q as (select row_number() over () as seg, * from g),
tf as (select seg, term, count(*) as tf from (select seg, unnest(regexp_extract_all(lower(s), '{_SQL_WORD}')) as term from q) group by all),
w as (select seg, term, tf * coalesce(idf, ln(n) + 1) as w from tf left join idf using (term), n),
norm as (select seg, sqrt(sum(w * w)) as norm from w group by seg),
tv as (select template, license, term, tf * idf as tw, sqrt(sum(tf * idf * tf * idf) over (partition by template)) as tn, false as whole
       from tw join idf using (term)
       union all
       select template, license, term, tf * coalesce(idf, ln(n) + 1) as tw,
              sqrt(sum(tf * coalesce(idf, ln(n) + 1) * tf * coalesce(idf, ln(n) + 1)) over (partition by template)) as tn, true
       from fw left join idf using (term), n),
dot as (select seg, license, round(sum(w * tw / tn) / any_value(norm), 6) as score
        from w join q using (seg) join tv on tv.term = w.term and tv.whole = q.whole join norm using (seg) group by seg, template, license),
hit as (select r, whole, license, score from dot join q using (seg) where score >= {THRESHOLD}),
best as (select *, row_number() over (partition by r, whole order by score desc, license) as k from hit),
tag as (select r, regexp_replace(trim(regexp_extract(t, '(?i)SPDX-License-Identifier:[ \t]*([a-z0-9.+:() -]+)', 1)), '[ -]+$', '') as said from c),
bare as (select r, case when regexp_matches(said, '^\([^()]*\)$') then trim(said[2:-2]) else said end as said from tag),
spdx as (select r, case when regexp_matches(said, '^[A-Za-z0-9.+-]+$') then regexp_replace(said, '(?i)(-only|-or-later|\+)$', '') else said end as said
         from bare where said <> ''),
own as (select d.r, doc_id, path, coalesce(a.license, spdx.said, b.license) as license,
               coalesce(a.score, case when spdx.said is not null then 1.0 end, b.score) as score,
               case when a.license is not null then 'file' when spdx.said is not null or b.license is not null then 'header' end as origin
        from d left join spdx on spdx.r = d.r left join best a on a.r = d.r and a.whole and a.k = 1 left join best b on b.r = d.r and not b.whole and b.k = 1),
shelf as (select regexp_replace(path, '/[^/]*$', '') as above, license, score,
                 row_number() over (partition by regexp_replace(path, '/[^/]*$', '') order by score desc, license) as k
          from own where origin = 'file'),
near as (select o.r, s.license, s.score, s.above, row_number() over (partition by o.r order by length(s.above) desc) as k
         from own o join shelf s on s.k = 1 and starts_with(o.path, s.above || '/') where o.origin is null)
select o.doc_id, o.path, coalesce(o.license, near.license) as license, coalesce(o.score, near.score) as score,
       coalesce(o.origin, case when near.license is not null then 'inherited' end) as origin, near.above as inherited_from
from own o left join near on near.r = o.r and near.k = 1
"""
