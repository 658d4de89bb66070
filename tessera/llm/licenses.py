"""License scans by an exact set-similarity join, in DataFrame functions only.

A text block is a run of ``BLOCK`` words of a document, whatever lines they stand on; runs overlap by half, so a passage of up to
``BLOCK // 2 + 1`` words stands whole in one. A block meets a template if it holds at least ``THRESHOLD`` of the template's distinct
words. The join is exact: words are ordered by how many blocks hold them, the rarest
first; a pair that meets the threshold of t words shares one of the template's first (size - t + 1) words (prefix filter); a block
with fewer than t template words is out (length filter); and from the places i, j of the shared prefix word at most
min(size - i, held - j) words are still to come (positional filter). Pairs left are counted word by word.

Only words of the templates are kept of a block, so the text is read once; templates are a fixed short list. Base places are
phrases found with all their words in a row. A license whose naming sentence is too short to tell by a share of its words (four of
the five of "released under the mit license" are in other licenses' too) is told by such a phrase as well, which counts for labels
and score but is no base place. Defined results: null or empty text has no words and no places; words are
[0-9a-z] after folding A-Z, and every character beyond ASCII.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import cut, documents

#: Base phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Naming phrases of public licenses and their labels; not base phrases.
NAMES = (("mit license", "mit"),)
#: Opening or naming sentences of public licenses, as words.
TEMPLATES = {
    "apache-2.0": "licensed under the apache license version 2 0",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by-sa": "licensed under a creative commons attribution sharealike international license",
    "cc0": "to the extent possible under law the author has waived all copyright and related or neighboring rights",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
}
THRESHOLD, BLOCK = 0.8, 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _vocabulary(templates: dict[str, str]) -> list[str]:
    return sorted({w for t in templates.values() for w in t.split()})


def _needed(n: int, threshold: float) -> int:
    return max(1, math.ceil(round(threshold * n, 9)))


def scan(docs: DataFrame, keep: list[str], phrases=PHRASES, templates=None) -> DataFrame:
    """One pass over the text: keep, n_words, the base places, named, and for each block the template words it holds."""
    vocab = F.array(*(F.lit(w) for w in _vocabulary(templates or TEMPLATES)))
    text = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    d = docs.select(*keep, F.regexp_replace(text, _GAP, " ").alias("_text"))
    d = d.select(*keep, "_text", F.filter(F.split("_text", " "), lambda w: w != "").alias("_words"))
    any_phrase = reduce(lambda a, b: a | b, (F.contains("_text", F.lit(p)) for p, _ in (*phrases, *NAMES)))
    # one space on each side of each word, so that neighbouring phrases share none
    spaced = F.when(any_phrase, F.concat(F.lit(" "), F.array_join("_words", "  "), F.lit(" "))).otherwise(F.lit(""))
    held = F.filter(F.transform(_runs(F.col("_words")), lambda ws: F.array_intersect(vocab, ws)), lambda x: F.size(x) > 0)
    d = d.select(*keep, F.size("_words").cast("long").alias("n_words"), spaced.alias("_s"), held.alias("_held"))
    count, first, last = [], [], []
    for k, (p, _) in enumerate(phrases):
        needle = _needle(p)
        n = len(needle)
        d = d.withColumn(f"_n{k}", F.expr(f"(length(_s) - length(replace(_s, '{needle}', ''))) div {n}"))
        d = d.withColumn(f"_a{k}", F.when(F.col(f"_n{k}") > 0, F.expr(f"left(_s, instr(_s, '{needle}') - 1)")))
        d = d.withColumn(f"_b{k}", F.when(F.col(f"_n{k}") > 0, F.expr(f"left(_s, length(_s) - instr(reverse(_s), '{needle[::-1]}') - {n - 1})")))
        count.append(F.col(f"_n{k}"))
        first.append(F.when(F.col(f"_n{k}") > 0, _words_before(f"_a{k}")))
        last.append(F.when(F.col(f"_n{k}") > 0, _words_before(f"_b{k}")))
    labels = F.array_sort(F.array_distinct(F.array_compact(F.array(*(F.when(F.col(f"_n{k}") > 0, F.lit(x)) for k, (_, x) in enumerate(phrases))))))
    named = F.array_distinct(F.array_compact(F.array(*(F.when(F.contains("_s", F.lit(_needle(p))), F.lit(x)) for p, x in NAMES))))
    return d.select(*keep, "n_words", reduce(lambda a, b: a + b, count).cast("long").alias("n_base"), F.least(*first).cast("long").alias("first_word"), F.greatest(*last).cast("long").alias("last_word"), labels.alias("base"), named.alias("named"), "_held")


def _needle(phrase: str) -> str:
    return " " + phrase.replace(" ", "  ") + " "


def _runs(words: Column) -> Column:
    """Runs of BLOCK words, one beginning at every half; the last may be shorter."""
    many = F.sequence(F.lit(0), F.greatest(F.size(words) - BLOCK // 2 - 1, F.lit(0)), F.lit(BLOCK // 2))
    return F.when(F.size(words) <= BLOCK, F.array(words)).otherwise(F.transform(many, lambda i: F.slice(words, i + 1, BLOCK)))


def _words_before(prefix: str) -> Column:
    """Of " w  w  w " cut before a phrase's own first space: each word stands between two spaces."""
    return F.expr(f"(length({prefix}) - length(replace({prefix}, ' ', ''))) div 2")


def containment_join(blocks: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """row, label, score: the best block of each row for each template that a block meets. blocks: row, held (array of words)."""
    spark, templates = blocks.sparkSession, templates or TEMPLATES
    sets = {k: sorted(set(t.split())) for k, t in templates.items()}
    least = min(_needed(len(s), threshold) for s in sets.values())
    freq = {r["w"]: r["n"] for r in blocks.select(F.explode("held").alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()}  # template words only
    order = {w: i for i, w in enumerate(sorted(_vocabulary(templates), key=lambda w: (freq.get(w, 0), w)))}
    prefix = []
    for label, s in sets.items():
        ranked, need = sorted(s, key=order.get), _needed(len(s), threshold)
        prefix += [(order[w], label, i, len(s), need, [order[x] for x in ranked]) for i, w in enumerate(ranked[: len(s) - need + 1])]
    t = spark.createDataFrame(prefix, "tok int, label string, i int, size int, need int, all array<int>")
    rank = F.create_map(*(F.lit(x) for w, i in order.items() for x in (w, i)))
    b = blocks.where(F.size("held") >= least).select("row", F.array_sort(F.transform("held", lambda w: rank[w])).alias("own"))
    # most blocks hold only the common words, which are in no prefix
    b = b.where(F.arrays_overlap("own", F.array(*(F.lit(x) for x in sorted({p[0] for p in prefix})))))
    b = b.select("row", "own", F.posexplode("own").alias("j", "tok"))
    pairs = b.join(F.broadcast(t), "tok")  # at most one row for each template word
    pairs = pairs.where((F.size("own") >= F.col("need")) & (F.least(F.col("size") - F.col("i"), F.size("own") - F.col("j")) + F.least("i", "j") >= F.col("need")))
    pairs = pairs.select("row", "label", "need", "size", F.size(F.array_intersect("own", "all")).alias("both")).where("both >= need")
    return pairs.groupBy("row", "label").agg(F.max(F.col("both") / F.col("size")).alias("score"))


def scan_licenses(docs: DataFrame) -> DataFrame:
    s = cut(scan(docs.select("doc_id", "text"), ["doc_id"]).withColumn("row", F.monotonically_increasing_id()))
    found = containment_join(s.select("row", F.explode("_held").alias("held")))
    found = found.groupBy("row").agg(F.collect_set("label").alias("more"), F.max("score").alias("best"))  # at most one label for each template
    out = s.join(found, "row", "left")
    labels = F.array_join(F.array_sort(F.array_union(F.array_union("base", "named"), F.coalesce("more", F.array().cast("array<string>")))), ",")
    score = F.when((F.col("n_base") > 0) | (F.size("named") > 0), F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0)))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"), labels.alias("labels"), score.alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir))
