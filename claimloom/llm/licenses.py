"""Licence notices: a trained paragraph classifier, confirmed by templates.

``train`` fits a multinomial logistic regression over word n-grams on the
driver over a bounded set: passages of the templates, one class per
family, and a sample of the corpus's own paragraphs as the unknown class. The
features are all n-grams of the templates. The temperature is fitted on
held-out passages, and the unknown class takes every paragraph whose best
family stays below ``MIN_PROBABILITY``.

``scan_licenses`` is DataFrame functions only: paragraphs, their n-grams joined
with the weights (as many rows as features, whatever the data), a softmax, and
the share of the template's n-grams that the paragraph holds, which must reach
``MIN_OVERLAP`` to confirm. A paragraph is a line, or a run of adjacent lines
where a wrapped notice needs it: runs are judged like lines and count where they
are confirmed and no line of theirs is. Texts without any of the words that
decide (``anchors_of``) cannot be predicted as a family and are not cut.

Null and empty texts have no paragraphs and no findings. Equal paragraphs in
one document are separate findings. Each row of ``docs`` gives one row, rows
with equal or null ids as well. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from claimloom.staging import stage

SAMPLE = 4_000  # paragraphs of the corpus in the unknown class
SAMPLE_DOCS = 1_000  # documents they are taken from
SIZES = (2, 3)  # words of an n-gram
MIN_PROBABILITY = 0.5
MIN_OVERLAP = 0.6
UNKNOWN = "unknown"

# Short notices by which documents and files declare their licence.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ),
    "cc-by": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ),
    "cc-by-nc": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ),
    "cc-by-sa": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
    ),
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "proprietary": (
        "All rights reserved.",
        "All rights reserved. No part of this publication may be reproduced without the prior written permission of the publisher.",
    ),
}

_WORD = re.compile(r"[a-z0-9]+")


def words_of(paragraph: str) -> list[str]:
    return _WORD.findall(paragraph.lower())


def ngrams_of(words: Sequence[str], sizes: Sequence[int] = SIZES) -> list[str]:
    """N-grams in words; a paragraph with fewer words than the smallest size has none."""
    return [" ".join(words[i : i + n]) for n in sizes for i in range(len(words) - n + 1)]


@dataclass(frozen=True)
class Model:
    families: tuple[str, ...]  # the unknown class last
    features: tuple[str, ...]
    weights: np.ndarray  # features x classes, temperature applied
    bias: np.ndarray
    anchors: tuple[str, ...]  # every feature holds one of these words
    needed: int  # a paragraph without any of so many first anchors is unknown, whatever else it holds


def passages(template: str) -> list[list[str]]:
    """The template whole, and cut short at either end down to four words: notices are rarely quoted in full."""
    words = words_of(template)
    least = min(4, len(words))
    cuts = [words]
    cuts += [words[:n] for n in range(least, len(words))]
    cuts += [words[-n:] for n in range(least, len(words))]
    return cuts


def anchors_of(features: Sequence[str], gains: np.ndarray, bias: np.ndarray, count: Mapping[str, int]) -> tuple[list[str], int]:
    """Words such that every feature holds one of them, and how many of them suffice.

    ``gains`` (features x families) and ``bias`` (families) are what a feature,
    and no feature, adds to a family's score over the unknown class. A paragraph
    without the first words has only features that none of them is in; once
    even all of these together lift no family over the unknown class, these
    words suffice. Words that bring much and are rare (``count``) come first.
    """
    held = [set(f.split()) for f in features]
    lift = np.maximum(gains, 0)
    weight = lift.max(1) + 1e-9
    left, chosen, needed = set(range(len(features))), [], None
    while left:
        if needed is None and (lift[sorted(left)].sum(0) + bias < 0).all():
            needed = len(chosen)
        brings: Counter = Counter()
        for i in left:
            for word in held[i]:
                brings[word] += weight[i]
        word = max(brings, key=lambda w: (brings[w] / (1 + count.get(w, 0)), w))
        chosen.append(word)
        left = {i for i in left if word not in held[i]}
    return chosen, len(chosen) if needed is None else needed


def train(
    sample: Sequence[str],
    templates: Mapping[str, Sequence[str]] = TEMPLATES,
    sizes: Sequence[int] = SIZES,
    penalty: float = 1e-4,
    steps: int = 300,
) -> Model:
    families = (*sorted(templates), UNKNOWN)
    rows = [
        (i, passage)
        for i, family in enumerate(families[:-1])
        for template in templates[family]
        for passage in passages(template)
    ]
    known = {g for _, p in rows for g in ngrams_of(p, sizes)}
    # notices are common among sampled paragraphs too: those that hold most of a template teach nothing
    whole = [set(ngrams_of(words_of(t), sizes)) for ts in templates.values() for t in ts]
    unknown, plain = [], Counter()  # words by paragraphs that hold them
    for paragraph in sample:
        words = words_of(paragraph)
        own = set(ngrams_of(words, sizes)) & known
        if not any(len(own & w) >= MIN_OVERLAP * len(w) for w in whole):
            unknown.append(own)
            plain.update(set(words))
    features = sorted(known)
    index = {g: i for i, g in enumerate(features)}
    y = np.array([i for i, _ in rows] + [len(families) - 1] * len(unknown))
    x = np.zeros((len(y), len(features)))
    for r, grams in enumerate([ngrams_of(p, sizes) for _, p in rows] + [list(u) for u in unknown]):
        for g in grams:
            if g in index:
                x[r, index[g]] = 1.0
    share = np.bincount(y, minlength=len(families))
    importance = (len(y) / (len(families) * np.maximum(share, 1)))[y]
    held = np.arange(len(y)) % 5 == 0
    w, b = np.zeros((len(features), len(families))), np.zeros(len(families))
    target = np.eye(len(families))[y]

    def softmax(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    fit = ~held
    weight = importance[fit, None] / importance[fit].sum()
    for _ in range(steps):
        error = weight * (softmax(x[fit] @ w + b) - target[fit])
        w -= 5.0 * (x[fit].T @ error + penalty * w)
        b -= 5.0 * error.sum(0)
    b[-1] = max(b[-1], b[:-1].max() + 2.0)  # without a single feature a paragraph is unknown
    z = x[held] @ w + b
    heat = min(
        (0.25, 0.5, 1.0, 2.0, 4.0),
        key=lambda t: -np.mean(importance[held] * np.log(softmax(z * t)[np.arange(held.sum()), y[held]] + 1e-12)),
    )
    w, b = w * heat, b * heat
    anchors, needed = anchors_of(features, w[:, :-1] - w[:, -1:], b[:-1] - b[-1], plain)
    return Model(families, tuple(features), w, b, tuple(anchors), needed)


def paragraphs(docs: DataFrame, id: Column, text: str) -> DataFrame:
    """(row, paragraph number, paragraph), blank ones left out."""
    cut = docs.select(id.alias("row"), F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), r"\n")).alias("at", "paragraph"))
    return cut.where(F.col("paragraph").rlike("[A-Za-z0-9]"))


def sample_paragraphs(docs: DataFrame, text: str, limit: int = SAMPLE) -> list[str]:
    """At most ``limit`` distinct paragraphs of about ``SAMPLE_DOCS`` documents drawn by a hash of their text."""
    share = min(1.0, SAMPLE_DOCS / max(1, docs.count()))
    place = F.pmod(F.xxhash64(text), F.lit(1 << 30)) / F.lit(1 << 30)
    drawn = paragraphs(docs.where(place < share), F.lit(0), text).select("paragraph").distinct()
    return [r.paragraph for r in drawn.orderBy(F.xxhash64("paragraph"), "paragraph").limit(limit).collect()]


def _grams(words: Column, sizes: Sequence[int]) -> Column:
    """Distinct n-grams of an array of words."""

    def of(n: int) -> Column:
        count = F.size(words) - (n - 1)
        starts = F.when(count > 0, F.sequence(F.lit(1), F.greatest(count, F.lit(1)))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))

    return F.array_distinct(F.concat(*[of(n) for n in sizes]))


def scan_licenses(
    docs: DataFrame,
    model: Model,
    text: str,
    templates: Mapping[str, Sequence[str]] = TEMPLATES,
    sizes: Sequence[int] = SIZES,
    min_probability: float = MIN_PROBABILITY,
    min_overlap: float = MIN_OVERLAP,
) -> DataFrame:
    """(row, copy, at, last, family, probability, overlap, confirmed) of paragraphs predicted as a family.

    ``docs`` holds ``row`` and the text; ``copy`` tells rows of an equal ``row`` apart.
    ``at`` is the paragraph's first line, ``last`` its last one.
    """
    spark = docs.sparkSession
    lowered = F.lower(F.coalesce(F.col(text), F.lit("")))
    anchors = "|".join(model.anchors[: model.needed])
    holds = F.col("lowered").rlike(f"(?<![a-z0-9])(?:{anchors})(?![a-z0-9])") if anchors else F.lit(True)
    likely = docs.select("row", lowered.alias("lowered")).where(holds)
    likely = likely.select("row", F.monotonically_increasing_id().alias("copy"), "lowered")  # rows may be equal
    cut = likely.select("row", "copy", F.posexplode(F.split("lowered", r"\n")).alias("at", "lowered"))
    cut_words = F.regexp_extract_all("lowered", F.lit("([a-z0-9]+)"), F.lit(1)).alias("words")
    lines = stage(cut.select("row", "copy", "at", cut_words, holds.alias("hit")), "licence-words")  # few documents are left
    longest = max(len(words_of(t)) for ts in templates.values() for t in ts)
    units = lines.where("hit").select("row", "copy", "at", F.col("at").alias("last"), "words").union(_runs(lines, longest))
    key = ["row", "copy", "at", "last"]
    grams = units.select(*key, F.explode(_grams(F.col("words"), sizes)).alias("gram"))

    weights = spark.createDataFrame(
        [
            (gram, family, float(model.weights[i, c]), float(model.bias[c]))
            for i, gram in enumerate(model.features)
            for c, family in enumerate(model.families)
        ],
        "gram string, family string, w double, b double",
    )
    scored = (
        grams.join(F.broadcast(weights), "gram")  # a row per feature and family
        .groupBy(*key, "family")
        .agg((F.sum("w") + F.min("b")).alias("z"))
    )
    best = scored.groupBy(*key).agg(
        F.max(F.struct("z", "family")).alias("top"), F.collect_list("z").alias("all")
    )
    total = F.aggregate("all", F.lit(0.0), lambda sum_, z: sum_ + F.exp(z - F.col("top.z")))
    predicted = best.select(*key, F.col("top.family").alias("family"), (1 / total).alias("probability")).where(
        (F.col("family") != UNKNOWN) & (F.col("probability") >= min_probability)
    )
    # the template that the paragraph holds the most of confirms the prediction
    forms = [
        (family, sorted(set(ngrams_of(words_of(t), sizes)))) for family in sorted(templates) for t in templates[family]
    ]
    form = spark.createDataFrame(forms, "family string, form array<string>")
    found = predicted.join(units, key).withColumn("grams", _grams(F.col("words"), sizes)).drop("words")
    overlap = F.size(F.array_intersect("grams", "form")) / F.size("form")
    judged = (
        found.join(F.broadcast(form), "family")  # one row per template
        .groupBy(*key, "family", "probability")
        .agg(F.max(overlap).alias("overlap"))
        .withColumn("confirmed", F.col("overlap") >= min_overlap)
    )
    return _settled(stage(judged, "licence-judged"), longest)  # lines and runs are read from it


def _runs(lines: DataFrame, longest: int) -> DataFrame:
    """(row, copy, at, last, words) of runs of adjacent lines that a wrapped notice can fill.

    Between the first line and the last, which other text may share, a run has
    fewer words than the longest template; blank lines end it. One of its lines
    must be a hit: every feature across a line end has its words in the run.
    """
    by_copy = Window.partitionBy("copy").orderBy("at")
    by_paragraph = Window.partitionBy("copy", "part").orderBy("end")
    numbered = lines.withColumn("part", F.sum((F.size("words") == 0).cast("int")).over(by_copy))
    full = numbered.where(F.size("words") > 0).withColumn(
        "end", F.sum(F.size("words")).over(Window.partitionBy("copy", "part").orderBy("at"))
    )
    line = F.struct("at", "words", "hit")
    # each line is the last but one of some runs
    pairs = full.select(
        "row", "copy",
        F.collect_list(line).over(by_paragraph.rangeBetween(-longest + 1, 0)).alias("head"),
        F.lead(line).over(by_paragraph).alias("tail"),
    ).where(F.col("tail").isNotNull())
    parts = F.concat("head", F.array("tail"))
    runs = pairs.select(
        "row", "copy", F.explode(F.transform(F.sequence(F.lit(1), F.size("head")), lambda i: F.slice(parts, i, F.size(parts)))).alias("run")
    )
    return runs.where(F.exists("run", lambda x: x["hit"])).select(
        "row", "copy", F.col("run")[0]["at"].alias("at"), F.element_at("run", -1)["at"].alias("last"),
        F.flatten(F.col("run.words")).alias("words"),
    )


def _settled(judged: DataFrame, longest: int) -> DataFrame:
    """Single lines, and the runs that are confirmed where no line of theirs is.

    Of runs of one family that overlap, the one that holds the most of its
    template stays, then the shortest, then the first. It stands for the
    unconfirmed lines in it. Lines and runs meet in sweeps over the lines of a
    document, and only runs that overlap each other are compared one by one.
    """
    fields = ["at", "last", "family", "probability", "overlap", "confirmed"]
    document = Window.partitionBy("row", "copy")
    family = Window.partitionBy("row", "copy", "family")
    single = F.col("at") == F.col("last")
    # a run goes if the last confirmed line before its end lies in it
    line = F.max(F.when(single & F.col("confirmed"), F.col("at"))).over(family.orderBy("last"))
    marked = judged.where(single | F.col("confirmed")).withColumn("line", line)
    runs = marked.where(~single & (F.col("line").isNull() | (F.col("line") < F.col("at"))))
    # a run with one in it that holds as much of its template never stays; no run has more lines than the longest template words and two
    inside = F.collect_list(F.struct("at", "last", "overlap")).over(family.orderBy("at").rangeBetween(0, longest + 2))
    beaten = F.exists(
        "inside",
        lambda x: (x["last"] <= F.col("last")) & (x["overlap"] >= F.col("overlap")) & ((x["at"] > F.col("at")) | (x["last"] < F.col("last"))),
    )
    runs = runs.withColumn("inside", inside).where(~beaten).drop("inside", "line")
    before = F.max("last").over(family.orderBy("at", "last").rowsBetween(Window.unboundedPreceding, -1))
    begins = (before.isNull() | (before < F.col("at"))).cast("int")
    island = F.sum("begins").over(family.orderBy("at", "last"))
    rank = F.struct((-F.col("overlap")).alias("o"), (F.col("last") - F.col("at")).alias("n"), *fields)
    islands = (
        runs.withColumn("begins", begins).withColumn("island", island)
        .groupBy("row", "copy", "family", "island").agg(F.array_sort(F.collect_list(rank)).alias("runs"))
    )
    chosen = F.aggregate(
        "runs", F.slice("runs", 1, 0),
        lambda held, x: F.when(F.exists(held, lambda y: (x["at"] <= y["last"]) & (y["at"] <= x["last"])), held).otherwise(F.concat(held, F.array(x))),
    )
    stay = islands.select("row", "copy", F.explode(chosen).alias("f")).select("row", "copy", *[f"f.{x}" for x in fields])
    both = marked.where(single).select("row", "copy", *fields).unionByName(stay)
    covered = F.max(F.when(~single, F.col("last"))).over(document.orderBy("at"))
    kept = ~single | F.col("confirmed") | F.col("covered").isNull() | (F.col("covered") < F.col("at"))
    return both.withColumn("covered", covered).where(kept).drop("covered")


def _row_key(id: Column, text: Column) -> Column:
    """The same for rows of equal id and text only; such rows have the same findings."""
    named = id.cast("string")
    return F.sha2(F.concat(F.coalesce(F.length(named).cast("string"), F.lit("-")), F.lit(":"), F.coalesce(named, F.lit("")), text), 256)


def document_licenses(docs: DataFrame, id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """(doc_id, n_notices, n_unconfirmed, families, notices), one row per row of ``docs``.

    ``families`` are the confirmed ones, sorted; ``notices`` are all
    predictions as paragraph:family:confirmed, in order.
    """
    model = train(sample_paragraphs(docs, text, sample))
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id).alias("doc_id"), _row_key(F.col(id), whole).alias("row"), whole.alias("text"))
    found = scan_licenses(rows.select("row", "text"), model, "text")
    notice = F.concat_ws(":", "at", "family", F.when(F.col("confirmed"), "confirmed").otherwise("unconfirmed"))
    by_copy = found.groupBy("row", "copy").agg(
        F.count_if("confirmed").alias("n_notices"),
        F.count_if(~F.col("confirmed")).alias("n_unconfirmed"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("confirmed"), F.col("family")))), ",").alias("families"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", notice.alias("n")))), lambda x: x["n"]), ",").alias("notices"),
    )
    told = F.struct("n_notices", "n_unconfirmed", "families", "notices")
    by_row = by_copy.groupBy("row").agg(F.min_by(told, "copy").alias("told")).select("row", "told.*")
    return rows.select("doc_id", "row").join(by_row, "row", "left").select(
        "doc_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_notices", "n_unconfirmed")],
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("families", "notices")],
    )
