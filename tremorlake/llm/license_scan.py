"""License scan by diagonal voting.

All rolling word pairs of every text are hashed and joined to the positions of
the same pairs in the license templates (a fixed parameter list, so the
broadcast side is bounded).  A hit votes for the diagonal "place in the text
minus place in the template".  Votes are bit masks over template positions.  A
diagonal with all votes is a verified exact place of the template.
Neighbouring diagonals, as a few inserted or lost words make them, are merged;
a merged span is verified when it covers MIN_COVER of the template.

Words: runs of digits, letters and all non-ASCII, with A-Z lower-cased.

Defined results: null or empty texts have no words, no labels and score 0.
Rows with the same doc_id and text each give their own equal row.  A null doc_id
is a value like any other.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tremorlake.llm.common import ascii_lower, keyed

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrases whose exact places are counted, with their labels.
BASE = [("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved")]

#: Notices of common licenses, found also with some words changed.
NOTICES = [
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("gpl-3.0", "general public license version 3"),
    ("gpl-2.0", "general public license version 2"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
]

MIN_COVER = 0.8
MERGE_GAP = 2


def template_pairs(templates: list[tuple[str, str, bool]]) -> list[tuple]:
    """(word, next word, places) of every word pair; a place is (template, label, is_base, pairs, place)."""
    out: dict[tuple[str, str], list[tuple]] = {}
    for t, (label, phrase, base) in enumerate(templates):
        words = phrase.split()
        if not 2 <= len(words) <= 60:
            raise ValueError(f"a template has 2 to 60 words: {phrase!r}")
        for i, pair in enumerate(zip(words, words[1:], strict=False)):
            out.setdefault(pair, []).append((t, label, base, len(words) - 1, i))
    return [(*pair, places) for pair, places in out.items()]


def all_templates() -> list[tuple[str, str, bool]]:
    return [(a, b, True) for a, b in BASE] + [(a, b, False) for a, b in NOTICES]


def scan(docs: DataFrame, templates: list[tuple[str, str, bool]] | None = None,
         min_cover: float = MIN_COVER, merge_gap: int = MERGE_GAP) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    ``spans`` lists the merged places as (label, first word, words, covered share).
    """
    spark = docs.sparkSession
    places = "array<struct<tpl:int,label:string,base:boolean,n_pairs:int,place:int>>"
    pairs = spark.createDataFrame(template_pairs(all_templates() if templates is None else templates),
                                  f"wa string, wb string, places {places}")
    words = keyed(docs).select("doc_id", "row_hash", F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(WORD), F.lit(0)).alias("words"))
    grams = F.zip_with("words", F.slice("words", F.lit(2), F.greatest(F.size("words"), F.lit(1))), lambda a, b: F.struct(F.xxhash64(a, b).alias("gram"), a.alias("a"), b.alias("b"), F.size("words").alias("n")))
    # The number of words rides in each pair: a row of a pair must not carry the whole array along.
    rolling = words.select("doc_id", "row_hash", F.posexplode_outer(grams).alias("pos", "g")).select(
        "doc_id", "row_hash", F.coalesce("g.n", F.lit(0)).alias("n_words"), F.coalesce("pos", F.lit(0)).alias("pos"), "g.gram", "g.a", "g.b")
    small = F.broadcast(pairs.withColumn("tgram", F.xxhash64("wa", "wb")))
    voted = rolling.join(small, (F.col("gram") == F.col("tgram")) & (F.col("a") == F.col("wa")) & (F.col("b") == F.col("wb")), "left")
    # The first word's row stays as the document's own, beside whatever it hits.
    own = F.array(F.struct(F.lit(-1).alias("tpl"), F.lit("").alias("label"), F.lit(False).alias("base"), F.lit(1).alias("n_pairs"), F.lit(0).alias("place")))
    none = F.array().cast(places)
    hits = F.concat(F.when(F.col("pos") == 0, own.cast(places)).otherwise(none), F.coalesce("places", none))
    votes = voted.filter("pos = 0 or places is not null").select("doc_id", "row_hash", "n_words", "pos", F.explode(hits).alias("p")).select(
        "doc_id", "row_hash", "n_words", F.col("p.tpl").alias("kind"), "p.label", "p.base", "p.n_pairs",
        (F.col("pos") - F.col("p.place")).alias("diag"), F.expr("shiftleft(1L, p.place)").alias("mask"))
    # A document's rows come from one task; they meet again by document, once for all steps below.
    diagonals = votes.repartition("doc_id", "row_hash").groupBy(
        "doc_id", "row_hash", "n_words", "kind", "label", "base", "n_pairs", "diag").agg(
        F.bit_or("mask").alias("mask"), F.count(F.lit(1)).alias("seen"))
    along = Window.partitionBy("doc_id", "row_hash", "kind").orderBy("diag")
    begins = F.when(F.col("diag") - F.lag("diag").over(along) <= merge_gap, 0).otherwise(1)
    spans = diagonals.withColumn("begins", begins).withColumn("span", F.sum("begins").over(along)).groupBy(
        "doc_id", "row_hash", "n_words", "kind", "label", "base", "n_pairs", "span").agg(
        F.bit_count(F.bit_or("mask")).alias("covered"), F.min("diag").alias("low"), F.max("diag").alias("high"), F.max("seen").alias("seen"),
        F.count(F.when(F.bit_count("mask") == F.col("n_pairs"), 1)).alias("whole"),
        F.min(F.when(F.bit_count("mask") == F.col("n_pairs"), F.col("diag"))).alias("first_whole"),
        F.max(F.when(F.bit_count("mask") == F.col("n_pairs"), F.col("diag"))).alias("last_whole"))
    share = F.col("covered") / F.col("n_pairs")
    found = spans.withColumn("share", share).withColumn(
        "ok", F.when(F.col("base"), F.col("whole") > 0).otherwise((F.col("share") >= min_cover) & (F.col("kind") >= 0)))
    def listed(when):
        return F.array_join(F.sort_array(F.collect_set(F.when(when, F.col("label")))), ",")
    out = found.groupBy("doc_id", "row_hash").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.coalesce(F.sum(F.when(F.col("base"), F.col("whole"))), F.lit(0)).cast("long").alias("n_base"),
        F.min(F.when(F.col("base"), F.col("first_whole"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("base"), F.col("last_whole"))).cast("long").alias("last_word"),
        listed(F.col("base") & F.col("ok")).alias("base_labels"), listed(F.col("ok")).alias("labels"),
        F.coalesce(F.max(F.when(F.col("ok"), F.col("share"))), F.lit(0.0)).alias("score"),
        F.sort_array(F.collect_list(F.when(F.col("ok"), F.struct(
            "label", F.col("low").alias("first"), (F.col("high") - F.col("low") + F.col("n_pairs") + 1).alias("words"), "share")))).alias("spans"),
        F.max(F.when(F.col("kind") < 0, F.col("seen"))).alias("copies"))
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("row_hash", "copies", "copy")
