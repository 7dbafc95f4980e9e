"""License scans: phrases, and an exact set-similarity join with license templates.

A block is a line of the text, or a window of as many words as a template needs
at the threshold, which may run over line breaks. A block matches a template when
it holds at least ``threshold`` of the template's distinct words. The join is
exact and needs no comparison of all blocks with all templates:

* tokens are ordered by their frequency over all blocks, rarest first, ties by
  the token itself;
* prefix filter: with T tokens in a template and o = ceil(threshold T) needed, a
  match holds one of the template's T - o + 1 rarest tokens. The templates'
  prefixes are an indexed table, token to templates, and blocks are joined with it
  by their tokens;
* length filter: a block of fewer than o template words cannot match;
* positional filter: if the first template token that a block holds stands at
  place i of the template and place j of the block in that order, at most
  1 + min(tokens after i, tokens after j) are shared.

What passes is verified on full sets. Only blocks near an anchor are formed: a
match lacks at most T - o of a template's words, so it holds one of any T - o + 1,
of which the longest are the template's anchors. Neighbouring anchors share one
stretch of words, of which each window is formed once, so that a notice repeated
without end takes time in proportion.

Every template that a block matches is reported. For labels a line gives the
template that it holds best; windows that overlap compete, the best stays, and
windows at different places all count, so a line or a text without line feeds may
give several labels. A line's label is dropped where a better match that runs
over its end took the place. Only DataFrame functions touch rows.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bound, lower_ascii, text_of, written

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases that are places of their own, and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Notices in words of this library, with the label that a match gives.
TEMPLATES = (
    ("apache", "licensed under the apache license version 2.0"),
    ("apache", "you may not use this file except in compliance with the apache license"),
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "you can redistribute it and modify it under the terms of the gnu general public license"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "released under the bsd license"),
    ("mpl", "subject to the terms of the mozilla public license"),
    ("cc-by", "licensed under cc by 4.0"),
    ("cc-by-nc", "licensed under cc by nc 4.0"),
    ("cc-by-sa", "licensed under cc by sa 4.0"),
    ("cc-by", "this work is licensed under a creative commons attribution license"),
    ("cc0", "dedicated to the public domain under cc0"),
    ("reserved", "copyright all rights reserved"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
THRESHOLD = 0.8
#: Rows of the prefix index up to which it is broadcast.
MOST_BROADCAST = 1_000_000


def template_words(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(WORD, text.lower())))


def needed_words(size: int, threshold: float) -> int:
    return math.ceil(threshold * size - 1e-9)


def anchor_words(templates: list[tuple[str, str]], threshold: float) -> list[str]:
    """Words of which every block that matches some template holds one."""
    found: set[str] = set()
    for _, text in templates:
        words = sorted(template_words(text), key=lambda w: (-len(w), w))
        found.update(words[: len(words) - needed_words(len(words), threshold) + 1])
    return sorted(found)


def window_words(text: str, threshold: float) -> int:
    """Words of a window: the template's own number, with room for others between them."""
    return math.ceil(len(re.findall(WORD, text.lower())) / threshold - 1e-9)


def phrase_places(words: Column) -> Column:
    """array<struct<at, label>> of the places where a phrase's words stand consecutively."""
    none = F.expr("cast(array() as array<struct<at:bigint,label:string>>)")

    def places_of(phrase: str, label: str) -> Column:
        parts = phrase.split()
        last = F.size(words) - len(parts)
        here = F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: reduce(lambda x, y: x & y, [F.get(words, i + k) == w for k, w in enumerate(parts)]))
        return F.when(last >= 0, F.transform(here, lambda i: F.struct(i.cast("long").alias("at"), F.lit(label).alias("label")))).otherwise(none)

    return F.concat(*[places_of(p, label) for p, label in PHRASES.items()])


def vocabulary_of(templates: list[tuple[str, str]]) -> list[str]:
    return sorted({w for _, text in templates for w in template_words(text)})


def stretches_of(words: Column, vocabulary: list[str], anchors: list[str], reach: int) -> Column:
    """array<array<struct<at, token>>>: template words around anchors, each word in one stretch.

    Anchors with at most ``2 * reach`` template words between them share a stretch.
    As template words are some of all words, it has every word within ``reach`` of
    its anchors.
    """
    hits = F.filter(F.transform(words, lambda w, i: F.struct(i.cast("int").alias("at"), w.alias("token"))), lambda x: x["token"].isin(vocabulary))

    def cut(hits: Column) -> Column:
        spots = F.filter(F.sequence(F.lit(0), F.size(hits) - 1), lambda i: F.get(hits, i)["token"].isin(anchors))

        def between(spots: Column) -> Column:
            first = F.filter(spots, lambda x, i: (i == 0) | (x - F.get(spots, i - 1) > 2 * reach))
            last = F.filter(spots, lambda x, i: (i == F.size(spots) - 1) | (F.get(spots, i + 1) - x > 2 * reach))
            return F.zip_with(first, last, lambda x, y: F.slice(hits, F.greatest(x - reach, F.lit(0)) + 1, y - F.greatest(x - reach, F.lit(0)) + reach + 1))

        return bound(spots, between)

    return bound(hits, cut)


def blocks_of(documents: DataFrame, id_col: str, templates: list[tuple[str, str]], threshold: float) -> DataFrame:
    """(row, doc_id, n_words, base, blocks) of every document row.

    ``base`` has the places of phrases. ``blocks`` has the lines that hold an
    anchor and the stretches around anchors, as array<struct<line, hits>>; of
    both only words that some template has, of a line distinct ones.
    """
    vocabulary = vocabulary_of(templates)
    anchors = anchor_words(templates, threshold)
    reach = max((window_words(text, threshold) for _, text in templates), default=1) - 1
    read = text_of(documents, F.col(id_col).cast("long").alias("doc_id"))
    df = read.select("doc_id", lower_ascii(F.col("text")).alias("text")).withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    shape = "array<struct<line:boolean,hits:array<struct<at:int,token:string>>>>"

    def line_block(line: Column) -> Column:
        own = F.array_distinct(F.filter(F.regexp_extract_all(line, F.lit(WORD), F.lit(0)), lambda w: w.isin(vocabulary)))
        return F.struct(F.lit(True).alias("line"), F.transform(own, lambda w: F.struct(F.lit(0).alias("at"), w.alias("token"))).alias("hits"))

    lines = F.filter(F.transform(F.split("text", "\n", -1), line_block), lambda x: F.exists(x["hits"], lambda h: h["token"].isin(anchors)))
    near = F.transform(stretches_of(F.col("words"), vocabulary, anchors, reach), lambda h: F.struct(F.lit(False).alias("line"), h.alias("hits")))
    some = F.exists("words", lambda w: w.isin(anchors))
    blocks = F.when(some, F.concat(lines, near)).otherwise(F.expr(f"cast(array() as {shape})"))
    phrased = reduce(lambda x, y: x | y, [reduce(lambda x, y: x & y, [F.col("text").contains(w) for w in p.split()]) for p in PHRASES])
    base = F.when(phrased, phrase_places(F.col("words"))).otherwise(F.expr("cast(array() as array<struct<at:bigint,label:string>>)"))
    return df.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.size("words").cast("long").alias("n_words"), base.alias("base"), blocks.alias("blocks"))


def prefix_index(templates: list[tuple[str, str]], frequency: DataFrame, threshold: float) -> DataFrame:
    """(token, place, template, label, size, needed, width, tokens): each template's prefix, its tokens in global order.

    ``frequency`` has (token, n), the blocks that hold each token.
    """
    spark = frequency.sparkSession
    rows = [(k, label, w, len(words), needed_words(len(words), threshold), window_words(text, threshold)) for k, (label, text) in enumerate(templates) if (words := template_words(text)) for w in words]
    given = spark.createDataFrame(rows, "template int, label string, token string, size int, needed int, width int").join(frequency, "token", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    placed = given.withColumn("place", F.row_number().over(Window.partitionBy("template").orderBy("n", "token")))
    whole = placed.groupBy("template").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "token"))), lambda x: x["token"]).alias("tokens"))
    return placed.filter(F.col("place") <= F.col("size") - F.col("needed") + 1).join(whole, "template").select("token", "place", "template", "label", "size", "needed", "width", "tokens")


SPAN = "struct<start:int,end:int,share:double,size:int,label:string,tight:int>"


def windows_of(hits: Column, tokens: Column, needed: Column, size: Column, width: Column, label: Column) -> Column:
    """All windows of a stretch that match the template, one a start: from the first to the last word that counts.

    A window has at most ``width`` template words, so the work is linear in the stretch.
    """

    def all_of(own: Column) -> Column:
        def matched(i: Column) -> Column:
            first = F.get(own, i)["at"]

            def judged(inside: Column) -> Column:
                found = F.transform(inside, lambda h: h["token"])

                def shaped(distinct: Column) -> Column:
                    last = F.get(inside, (F.array_position(found, F.element_at(distinct, -1)) - 1).cast("int"))["at"] + 1
                    span = F.struct(first.alias("start"), last.alias("end"), (F.size(distinct) / size).alias("share"), size.alias("size"), label.alias("label"), (first - last).alias("tight"))
                    return F.when(F.size(distinct) >= needed, span)

                return bound(F.array_distinct(found), shaped)

            return bound(F.filter(F.slice(own, i + 1, width), lambda h: h["at"] < first + width), judged)

        return F.array_compact(F.transform(F.filter(F.sequence(F.lit(0), F.size(own) - 1), lambda i: i < F.size(own)), matched))

    own = F.filter(hits, lambda h: F.array_contains(tokens, h["token"]))
    return F.when(F.size(own) >= needed, bound(own, all_of)).otherwise(F.expr(f"cast(array() as array<{SPAN}>)"))


def best_places(found: Column) -> Column:
    """struct<labels, share>: the labels of matches that stay where matches overlap, and their greatest share.

    One sweep in order of start: of a match and the one kept before it that it
    overlaps, the better stays, the tighter of equals; what it displaces doesn't
    come back. The state is one match and the labels, however many matches.
    """
    rank = lambda x: F.struct(x["share"], x["size"], x["label"], x["tight"])
    start = F.struct(F.expr(f"cast(null as {SPAN})").alias("at"), F.expr("cast(array() as array<string>)").alias("labels"), F.lit(0.0).alias("share"))

    def settled(acc: Column) -> Column:
        return F.array_union(acc["labels"], F.array(acc["at"]["label"]))

    def step(acc: Column, x: Column) -> Column:
        over = acc["at"].isNotNull() & (x["start"] < acc["at"]["end"])
        moved = F.struct(x.alias("at"), F.when(acc["at"].isNull() | over, acc["labels"]).otherwise(settled(acc)).alias("labels"), F.when(acc["at"].isNull() | over, acc["share"]).otherwise(F.greatest(acc["share"], acc["at"]["share"])).alias("share"))
        return F.when(over & (rank(acc["at"]) >= rank(x)), acc).otherwise(moved)

    def ended(acc: Column) -> Column:
        none = acc["at"].isNull()
        return F.struct(F.when(none, acc["labels"]).otherwise(settled(acc)).alias("labels"), F.when(none, acc["share"]).otherwise(F.greatest(acc["share"], acc["at"]["share"])).alias("share"))

    return F.aggregate(F.sort_array(found), start, step, ended)


def matching_blocks(blocks: DataFrame, index: DataFrame) -> DataFrame:
    """(row, own, best, windows, matches) of rows with a match.

    ``own`` has the best template of each line, ``best`` what ``best_places`` leaves
    of all matching windows, ``windows`` the greatest share of each label in them,
    and ``matches`` every template that some block matches, as
    (template, label, share, blocks): its greatest share and the lines and
    windows that match it. ``blocks`` has (row, block, line, hits, tokens), the tokens
    distinct and in global order. A candidate is kept at the first prefix token that
    it shares, so each pair of block and template is verified once.
    """
    keep = [c for c in index.columns if c != "tokens"]
    paired = blocks.withColumn("token", F.explode("tokens")).join(index.select(*keep, F.col("tokens").alias("template_tokens")), "token")
    both = F.array_intersect("template_tokens", "tokens")
    rest = F.least(F.col("size") - F.col("place"), F.size("tokens") - F.array_position("tokens", F.col("token")))
    near = paired.filter((F.size("tokens") >= F.col("needed")) & (1 + rest >= F.col("needed"))).withColumn("both", both)
    verified = near.filter((F.get("both", F.lit(0)) == F.col("token")) & (F.size("both") >= F.col("needed")))
    spans = windows_of(F.col("hits"), F.col("template_tokens"), F.col("needed"), F.col("size"), F.col("width"), F.col("label"))
    share = F.size("both") / F.col("size")
    judged = verified.select("row", "block", "line", "template", "label", "size", share.alias("share"), F.when(~F.col("line"), spans).alias("spans"))
    judged = judged.withColumn("top", F.when(F.col("line"), F.col("share")).otherwise(F.array_max(F.transform("spans", lambda x: x["share"])))).filter("top is not null")
    own = F.max(F.when(F.col("line"), F.struct("share", "size", "label"))).alias("own")
    by_block = judged.groupBy("row", "block").agg(own, F.flatten(F.collect_list("spans")).alias("spans"))
    by_row = by_block.groupBy("row").agg(F.collect_set("own").alias("own"), F.flatten(F.collect_list("spans")).alias("spans"))
    counted = judged.groupBy("row", "template", "label").agg(F.max("top").alias("share"), F.max(F.when(~F.col("line"), F.col("top"))).alias("window"), F.sum(F.when(F.col("line"), 1).otherwise(F.size("spans"))).alias("blocks"))
    windows = F.collect_list(F.when(F.col("window").isNotNull(), F.struct("label", F.col("window").alias("share")))).alias("windows")
    matches = counted.groupBy("row").agg(windows, F.array_sort(F.collect_list(F.struct("template", "label", "share", "blocks"))).alias("matches"))
    return by_row.join(matches, "row").select("row", "own", best_places(F.col("spans")).alias("best"), "windows", "matches")


def scan_licenses(documents: DataFrame, id_col: str = "doc_id", threshold: float = THRESHOLD, templates: DataFrame | None = None) -> DataFrame:
    """Per document: n_words, n_base, first_word, last_word, base_labels, labels, score, matches.

    ``templates`` has (label, text) and is a parameter of the driver's size;
    without it ``TEMPLATES`` counts. ``matches`` has every template that a block of
    the document reaches the threshold of, as ``<number>:<label>``, sorted by number;
    ``labels`` the best of each place. ``score`` is the greatest containment of a
    template that gives a label, 1 where a base phrase stands, and 0 where there is
    neither. Null and empty texts have no words and no labels; repeated rows are
    scanned each; an empty table gives no rows. Templates without words match
    nothing. Only the id and the text are read.

    One pass over the texts writes the blocks near anchors; the token frequencies
    over all blocks, the join and the result read that. Documents without such
    blocks take no part in the join.
    """
    given = list(TEMPLATES) if templates is None else [(r["label"], r["text"]) for r in templates.filter("label is not null and text is not null").select("label", "text").collect()]
    given = [(label, text) for label, text in given if template_words(text)]
    found = written(blocks_of(documents, id_col, given, threshold), "blocks")
    some = found.filter(F.size("blocks") > 0)
    exploded = some.select("row", F.posexplode("blocks").alias("block", "x")).select("row", "block", "x.line", "x.hits")
    exploded = exploded.withColumn("held", F.array_distinct(F.transform("hits", lambda h: h["token"])))
    frequency = written(exploded.select(F.explode("held").alias("token")).groupBy("token").agg(F.count("*").alias("n")), "frequency")
    index = written(prefix_index(given, frequency, threshold), "index")
    index = F.broadcast(index) if index.count() <= MOST_BROADCAST else index
    # The templates' tokens in global order, as one array; a block's are the ones of it that it holds.
    order = frequency.agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "token"))), lambda x: x["token"]).alias("order"))
    blocks = exploded.crossJoin(F.broadcast(order)).withColumn("tokens", F.array_intersect("order", "held"))
    matches = matching_blocks(blocks.select("row", "block", "line", "hits", "tokens"), index)

    own_type = "array<struct<share:double,size:int,label:string>>"
    df = some.select("row", "doc_id", "n_words", "base").join(matches, "row", "left")
    best = F.coalesce("best.labels", F.expr("cast(array() as array<string>)"))
    # A line's label whose every place went to better matches.
    lost = lambda x: F.exists("windows", lambda y: (y["label"] == x["label"]) & (y["share"] >= x["share"])) & ~F.array_contains(best, x["label"])
    own = F.filter(F.coalesce("own", F.expr(f"cast(array() as {own_type})")), lambda x: ~lost(x))
    share = F.greatest(F.coalesce(F.array_max(F.transform("own", lambda x: x["share"])), F.lit(0.0)), F.coalesce("best.share", F.lit(0.0)))
    named = F.coalesce(F.array_join(F.transform("matches", lambda x: F.concat_ws(":", x["template"].cast("string"), x["label"])), ","), F.lit(""))
    with_blocks = df.withColumn("own", own).select("doc_id", "n_words", "base", F.concat(F.transform("own", lambda x: x["label"]), best).alias("more"), share.alias("share"), named.alias("matches"))
    without = found.filter(F.size("blocks") == 0).select("doc_id", "n_words", "base", F.expr("cast(array() as array<string>)").alias("more"), F.lit(0.0).alias("share"), F.lit("").alias("matches"))
    labels = F.transform("base", lambda x: x["label"])
    joined = lambda x: F.array_join(F.array_sort(F.array_distinct(x)), ",")
    return with_blocks.unionByName(without).select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda x: x["at"])).alias("first_word"),
        F.array_max(F.transform("base", lambda x: x["at"])).alias("last_word"),
        joined(labels).alias("base_labels"),
        joined(F.concat(labels, "more")).alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.col("share")).alias("score"),
        "matches",
    )
