"""License scan by diagonal voting.

Every rolling word k-gram of every document is joined to the template positions with the same k-gram;
each hit votes for the diagonal (document position minus template position). Diagonals next to each
other are merged, so that a few added or missing words do not break a match. A merged span that covers enough
of the template's words is verified on the document's words: the words that tell its license from others must
stand in it or near it, no word of a competing license may, and of overlapping spans of one family those stay that no
better one overlaps. A sentence that several licenses share needs a second one. A phrase occurs exactly where one diagonal holds all of its k-grams.

Defined results: null and empty texts have no words and no labels, score 0 and null positions. Equal rows
get equal results. Phrases and templates need at least ``K`` words. Other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .text import folded_words, join_docs, literal_rows, named, saved, small_broadcast, table

K = 3
NEIGHBOUR = 2          # diagonals at most this far apart are merged
MIN_COVERAGE = 0.8     # share of the template's words a span must cover

# Phrases with their labels (the contract's) ...
PHRASES = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]
MAX_BROADCAST_ROWS = 200_000   # document keys (two longs) sent to every executor at most
NEAR = 60              # words before and after a span in which a naming word may stand
CELL = 128             # words; spans of a family are compared with those that share a cell with them
PARTIAL = 0.5          # largest score of a span that is not verified


class Template(NamedTuple):
    """A sentence of a license and what verifies a span of it: patterns over the span's words that must stand in it
    (``has``) or may not (``lacks``), of which one must stand near it (``near``) and none may (``apart``). A sentence
    that other licenses use too (not ``alone``) gives its label only together with another one of that label."""
    label: str
    text: str
    family: str
    has: tuple[str, ...] = ()
    lacks: tuple[str, ...] = ()
    near: tuple[str, ...] = ()
    apart: tuple[str, ...] = ()
    alone: bool = True


# ... and sentences of well-known licenses, as words, with the words that tell them apart.
_NC, _SA, _ND = "non ?commercial", "share ?alike", "no ?deriv(s|ative|atives)"
_CC = "creative commons attribution"
_GNU = "general public license as published by the free software foundation"
_OR_LATER = "of the license or at your option any later version"
_OTHERS = ("mozilla", "netscape", "common development and distribution", "cddl", "eclipse", "educational community", "european union")
TEMPLATES = [
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
                    "documentation files the software to deal in the software without restriction", "mit",
             has=("associated documentation",), lacks=("or organization",)),
    Template("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of "
                    "the software", "mit", alone=False),
    Template("mit", "the software is provided as is without warranty of any kind express or implied", "mit", alone=False),
    Template("bsl-1", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and "
                      "accompanying documentation covered by this license", "mit", has=("or organization",)),
    Template("bsl-1", "distributed under the boost software license version 1 0", "boost", has=("boost",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
                    "provided that the above copyright notice and this permission notice appear in all copies", "isc",
             has=("provided that the above",)),
    Template("0bsd", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
             "isc", apart=("provided that the above copyright notice",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "unlicense", has=("unencumbered",)),
    Template("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable "
                     "for any damages arising from the use of this software", "zlib", has=("authors",)),
    Template("apache-2", "licensed under the apache license version 2 0 the license", "apache", has=("apache", "2 0")),
    Template("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at", "apache",
             near=("apache license version 2", "apache license 2", "apache 2 0", "apache org licenses license 2 0"), apart=_OTHERS),
    Template("mpl-1-1", "the contents of this file are subject to the mozilla public license version 1 1", "mpl", has=("mozilla", "1 1")),
    Template("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", "mpl", has=("mozilla", "2 0")),
    Template("cddl-1", "the contents of this file are subject to the terms of the common development and distribution license", "mpl",
             has=("common development",)),
    Template("epl-2", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0",
             "epl", has=("eclipse", "2 0")),
    Template("gpl-3", "is licensed under the gnu general public license version 3", "gpl", has=("version 3",), lacks=("lesser", "affero", "library")),
    Template("gpl-3", f"it under the terms of the gnu {_GNU} either version 3 {_OR_LATER}", "gpl", has=("version 3",),
             lacks=("lesser", "affero", "library")),
    Template("gpl-2", f"it under the terms of the gnu {_GNU} either version 2 {_OR_LATER}", "gpl", has=("version 2",),
             lacks=("lesser", "affero", "library")),
    Template("lgpl-2-1", f"it under the terms of the gnu lesser {_GNU} either version 2 1 {_OR_LATER}", "gpl", has=("lesser", "version 2 1")),
    Template("lgpl-3", f"it under the terms of the gnu lesser {_GNU} either version 3 {_OR_LATER}", "gpl", has=("lesser", "version 3")),
    Template("agpl-3", f"it under the terms of the gnu affero {_GNU} either version 3 {_OR_LATER}", "gpl", has=("affero", "version 3")),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
                    "following conditions are met", "bsd", apart=("apache", "openssl", "php license")),
    Template("cc0-1", "to the extent possible under law has waived all copyright and related or neighboring rights to", "cc", has=("waived",)),
    Template("cc-by-nc-sa", f"{_CC} noncommercial sharealike 4 0 international license", "cc", has=(_NC, _SA), lacks=(_ND,)),
    Template("cc-by-nc-nd", f"{_CC} noncommercial noderivatives 4 0 international license", "cc", has=(_NC, _ND), lacks=(_SA,)),
    Template("cc-by-nd", f"{_CC} noderivatives 4 0 international license", "cc", has=(_ND,), lacks=(_NC, _SA)),
    Template("cc-by-nc", f"{_CC} noncommercial 4 0 international license", "cc", has=(_NC,), lacks=(_SA, _ND)),
    Template("cc-by-sa", f"{_CC} sharealike 4 0 international license", "cc", has=(_SA,), lacks=(_NC, _ND)),
    Template("cc-by", f"{_CC} 4 0 international license", "cc", lacks=(_NC, _SA, _ND)),
]


def template_positions(spark: SparkSession, phrases: list[tuple[str, str]], templates: list[Template]) -> DataFrame:
    """(gram, template, at, label, n_template, is_phrase): one row for each k-gram of each template. The
    table is made of parameters, so its size does not depend on the documents."""
    rows = []
    for number, (label, text) in enumerate([*phrases, *[(t.label, t.text) for t in templates]]):
        if len(text.split()) < K:
            raise ValueError(f"a template needs at least {K} words: {text!r}")
        rows.append((number, label, text, number < len(phrases)))
    frame = literal_rows(spark, ["template", "label", "text", "is_phrase"], rows).withColumn("words", F.split("text", " +"))
    return frame.select(F.posexplode(rolling_grams()).alias("at", "gram"), "template", "label", F.size("words").alias("n_template"), "is_phrase")


def rolling_grams() -> Column:
    """Hashes of the k-grams of the column ``words``, in order; null for fewer words."""
    return F.when(F.size("words") >= K, F.transform(
        F.sequence(F.lit(0), F.size("words") - K),
        lambda i: F.xxhash64(*[F.get(F.col("words"), i + j) for j in range(K)])))


def votes(docs: DataFrame, positions: DataFrame) -> DataFrame:
    """(doc_id, text_hash, template, label, n_template, is_phrase, diagonal, ats): template positions that
    voted for each diagonal."""
    words = named(docs, words=folded_words(F.col("text")))
    grams = words.select("doc_id", "text_hash", F.posexplode_outer(rolling_grams()).alias("pos", "gram")).filter("gram is not null")
    hits = grams.join(F.broadcast(positions), "gram")
    return hits.groupBy("doc_id", "text_hash", "template", "label", "n_template", "is_phrase",
                        (F.col("pos") - F.col("at")).alias("diagonal")).agg(F.collect_set("at").alias("ats"))


def merged_spans(diagonals: DataFrame) -> DataFrame:
    """Spans (doc_id, text_hash, template, label, first_word, last_word, first_place, last_place, coverage):
    neighbouring diagonals merged. Words are those with votes, places those where the whole template would stand."""
    by_diagonal = Window.partitionBy("doc_id", "text_hash", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(by_diagonal)
    runs = diagonals.withColumn("starts", F.when(gap <= NEIGHBOUR, F.lit(0)).otherwise(F.lit(1))) \
        .withColumn("run", F.sum("starts").over(by_diagonal))
    spans = runs.groupBy("doc_id", "text_hash", "template", "label", "n_template", "run").agg(
        F.array_distinct(F.flatten(F.collect_set("ats"))).alias("ats"),
        F.min(F.col("diagonal") + F.array_min("ats")).alias("first_word"),
        F.max(F.col("diagonal") + F.array_max("ats") + K - 1).alias("last_word"),
        F.greatest(F.min("diagonal"), F.lit(0)).alias("first_place"),
        (F.max("diagonal") + F.col("n_template") - 1).alias("last_place"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("ats", lambda a: F.sequence(a, a + K - 1)))))
    return spans.select("doc_id", "text_hash", "template", "label", "first_word", "last_word", "first_place", "last_place",
                        (covered / F.col("n_template")).alias("coverage"))


def rule(t: Template, stands: str) -> str:
    """The condition that verifies a span of a template, in SQL; ``stands`` is the test of a pattern in words."""
    one = lambda words, patterns: "(" + " OR ".join(stands.format(words, f"' {p} '") for p in patterns) + ")"
    parts = [one("whole", (p,)) for p in t.has] + [f"NOT {one(w, ps)}" for w, ps in (("voted", t.lacks), ("around", t.apart)) if ps]
    return " AND ".join([*parts, *([one("around", t.near)] if t.near else [])]) or "true"


def verified_spans(docs: DataFrame, spans: DataFrame, templates: list[Template], first_number: int) -> DataFrame:
    """The spans (doc_id, text_hash, template, label, coverage) that the documents' words confirm; of overlapping
    ones of a family only those that no better one overlaps."""
    found = saved(spans.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct(
        "template", "label", "coverage", "first_word", "last_word", "first_place", "last_place")).alias("spans")))
    keys = small_broadcast(found.select("doc_id", "text_hash"), MAX_BROADCAST_ROWS)
    texts = join_docs(named(docs, text=F.col("text")), keys, "left_semi").dropDuplicates(["doc_id", "text_hash"])
    worded = join_docs(found, texts.withColumn("words", folded_words(F.col("text"))).drop("text"))
    stretch = lambda first, last: F.concat(F.lit(" "), F.array_join(
        F.slice("words", first + 1, last - first + 1), " "), F.lit(" "))
    each = worded.select("doc_id", "text_hash", F.explode(F.transform("spans", lambda s: F.struct(
        s["template"].alias("template"), s["label"].alias("label"), s["coverage"].alias("coverage"), s["first_word"].alias("first"),
        s["last_word"].alias("last"), stretch(s["first_place"], s["last_place"]).alias("whole"), stretch(s["first_word"], s["last_word"]).alias("voted"),
        stretch(F.greatest(s["first_place"] - NEAR, F.lit(0)), s["last_place"] + NEAR).alias("around")))).alias("s")) \
        .select("doc_id", "text_hash", "s.*")
    numbered = list(enumerate(templates, first_number))
    right = F.expr("CASE template " + " ".join(f"WHEN {n} THEN {rule(t, '{} RLIKE {}')}" for n, t in numbered) + " END")
    family = F.expr("CASE template " + " ".join(f"WHEN {n} THEN '{t.family}'" for n, t in numbered) + " END")
    good = saved(each.filter(right).select("doc_id", "text_hash", family.alias("family"), F.struct(
        (-F.col("coverage")).alias("less"), (F.col("first") - F.col("last")).alias("short"), "first", "last", "template", "label").alias("span")))
    # a cell holds at most the spans over its words, so the lists do not grow with the document
    cells = good.withColumn("cell", F.explode(F.sequence(F.floor(F.col("span.first") / CELL), F.floor(F.col("span.last") / CELL)))) \
        .groupBy("doc_id", "text_hash", "family", "cell").agg(F.collect_set("span").alias("spans"))
    beaten = cells.select("doc_id", "text_hash", "family", F.explode(F.filter("spans", lambda s: F.exists("spans", lambda o: (
        o < s) & (o["first"] <= s["last"]) & (s["first"] <= o["last"])))).alias("span")).distinct()
    lost = beaten.withColumnsRenamed({"doc_id": "other_id", "text_hash": "other_hash", "family": "other_family", "span": "other"})
    stay = good.distinct().join(lost, F.col("doc_id").eqNullSafe(F.col("other_id")) & (F.col("text_hash") == F.col("other_hash"))
                                & (F.col("family") == F.col("other_family")) & (F.col("span") == F.col("other")), "left_anti")
    return stay.select("doc_id", "text_hash", "span.template", "span.label", (-F.col("span.less")).alias("coverage"))


def labels_of(verified: DataFrame, templates: list[Template], first_number: int) -> DataFrame:
    """(doc_id, text_hash, label, coverage): labels with a sentence that stands for its license alone, or with two
    that do not."""
    alone = F.col("template").isin([n for n, t in enumerate(templates, first_number) if t.alone])
    return (verified.groupBy("doc_id", "text_hash", "label").agg(
        F.bool_or(alone).alias("alone"), F.count_distinct("template").alias("sentences"), F.max("coverage").alias("coverage"))
        .filter(F.col("alone") | (F.col("sentences") > 1)).drop("alone", "sentences"))


def scan_licenses(docs: DataFrame, phrases: list[tuple[str, str]] = PHRASES, templates: list[Template] = TEMPLATES,
                  min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """Per document: n_words, n_base (exact phrase places), first_word, last_word (smallest and largest
    start of them), base_labels, labels (of verified spans too) and score (1 for an exact phrase, the largest
    coverage of spans that give a label, and of others at most ``PARTIAL``)."""
    diagonals = saved(votes(docs, template_positions(docs.sparkSession, phrases, templates)))
    exact = diagonals.filter(F.col("is_phrase") & (F.size("ats") == F.col("n_template") - (K - 1))) \
        .select("doc_id", "text_hash", "label", F.col("diagonal").alias("start"), F.lit(1.0).alias("coverage"))
    merged = saved(merged_spans(diagonals))
    sentences = merged.filter((F.col("coverage") >= min_coverage) & (F.col("template") >= len(phrases)))
    good = labels_of(verified_spans(docs, sentences, templates, len(phrases)), templates, len(phrases)) \
        .select("doc_id", "text_hash", "label", F.lit(None).cast("int").alias("start"), "coverage")
    # a span itself gives a part of the score; its label is null unless verified
    spans = merged.select("doc_id", "text_hash", F.lit(None).cast("string").alias("label"), F.lit(None).cast("int").alias("start"),
                          F.least("coverage", F.lit(PARTIAL)).alias("coverage"))
    found = exact.unionByName(good).unionByName(spans).groupBy("doc_id", "text_hash").agg(
        F.count("start").alias("n_base"), F.min("start").alias("first_word"), F.max("start").alias("last_word"),
        F.collect_set(F.when(F.col("start").isNotNull(), F.col("label"))).alias("base"),
        F.collect_set("label").alias("all"), F.max("coverage").alias("score"))
    base = named(docs, n_words=F.size(folded_words(F.col("text"))).cast("long"))
    joined_labels = lambda c: F.coalesce(F.array_join(F.array_sort(c), ","), F.lit(""))
    return join_docs(base, found, "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        joined_labels("base").alias("base_labels"), joined_labels("all").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))


def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    rows = ", ".join(f"({i}, '{label}', '{text}', {i < len(PHRASES)})"
                     for i, (label, text) in enumerate([*PHRASES, *[(t.label, t.text) for t in TEMPLATES]]))
    numbered = list(enumerate(TEMPLATES, len(PHRASES)))
    right = " ".join(f"WHEN {n} THEN {rule(t, 'regexp_matches({}, {})')}" for n, t in numbered)
    family = " ".join(f"WHEN {n} THEN '{t.family}'" for n, t in numbered)
    alone = ", ".join(str(n) for n, t in numbered if t.alone)
    return rf"""
WITH tt AS (SELECT column0 AS template, column1 AS label, string_split(column2, ' ') AS tw, column3 AS is_phrase
        FROM (VALUES {rows}) AS v(column0, column1, column2, column3)),
tg AS (SELECT template, label, len(tw) AS n_template, is_phrase, a - 1 AS tpos, array_to_string(tw[a:a+{K - 1}], ' ') AS gram
        FROM (SELECT *, unnest(range(1, len(tw) - {K - 2})) AS a FROM tt)),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
dg AS (SELECT doc_id, p - 1 AS pos, array_to_string(words[p:p+{K - 1}], ' ') AS gram
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - {K - 2})) AS p FROM d WHERE len(words) >= {K})),
h AS (SELECT doc_id, template, label, n_template, is_phrase, pos - tpos AS diagonal, tpos FROM dg JOIN tg USING (gram)),
dia AS (SELECT doc_id, template, label, n_template, is_phrase, diagonal, list(DISTINCT tpos) AS ats
        FROM h GROUP BY ALL),
st AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) <= {NEIGHBOUR}
        THEN 0 ELSE 1 END AS starts FROM dia),
rn AS (SELECT *, sum(starts) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS run FROM st),
cv AS (SELECT doc_id, template, label, n_template, run, unnest(ats) AS tpos FROM rn),
cw AS (SELECT doc_id, template, label, n_template, run, count(DISTINCT tpos + j) AS covered
        FROM cv, range({K}) g(j) GROUP BY doc_id, template, label, n_template, run),
places AS (SELECT doc_id, template, run, min(diagonal + list_min(ats)) AS fw, max(diagonal + list_max(ats) + {K - 1}) AS lw,
        greatest(min(diagonal), 0) AS fp, max(diagonal) + max(n_template) - 1 AS lp FROM rn GROUP BY ALL),
sp AS (SELECT cw.doc_id, template, label, covered / n_template AS coverage, fw, lw,
        ' ' || array_to_string(words[fp + 1:lp + 1], ' ') || ' ' AS whole, ' ' || array_to_string(words[fw + 1:lw + 1], ' ') || ' ' AS voted,
        ' ' || array_to_string(words[greatest(fp - {NEAR}, 0) + 1:lp + {NEAR} + 1], ' ') || ' ' AS around
        FROM cw JOIN places USING (doc_id, template, run) JOIN d USING (doc_id)
        WHERE template >= {len(PHRASES)} AND covered / n_template >= {MIN_COVERAGE}),
rt AS (SELECT *, CASE template {family} END AS family, struct_pack(a := -coverage, b := fw - lw, c := fw, d := lw, e := template) AS rank
        FROM sp WHERE CASE template {right} END),
ok AS (SELECT * FROM rt r WHERE NOT EXISTS (SELECT 1 FROM rt o WHERE o.doc_id = r.doc_id AND o.family = r.family AND o.rank < r.rank
        AND o.fw <= r.lw AND r.fw <= o.lw)),
good AS (SELECT doc_id, label, max(coverage) AS coverage FROM ok GROUP BY doc_id, label
        HAVING bool_or(template IN ({alone})) OR count(DISTINCT template) > 1),
f AS (SELECT doc_id, label, diagonal AS start, 1.0::DOUBLE AS coverage FROM dia
        WHERE is_phrase AND len(ats) = n_template - {K - 1}
        UNION ALL SELECT doc_id, label, NULL, coverage FROM good
        UNION ALL SELECT doc_id, NULL, NULL, least(covered / n_template, {PARTIAL}) FROM cw),
a AS (SELECT doc_id, count(start) AS n_base, min(start) AS first_word, max(start) AS last_word,
        array_to_string(list_sort(list(DISTINCT label) FILTER (start IS NOT NULL)), ',') AS base_labels,
        array_to_string(list_sort(list(DISTINCT label) FILTER (label IS NOT NULL)), ',') AS labels,
        max(coverage) AS score FROM f GROUP BY doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
        coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0) AS score
FROM d LEFT JOIN a ON d.doc_id = a.doc_id
"""


ORACLE = _oracle()
