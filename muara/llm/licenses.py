"""License scans: named phrases, and an exact set-similarity join of text blocks with license templates.

A template meets a text where a run of consecutive words, wherever the lines break, holds at least the threshold's
share of the template's distinct words, all of its ``must`` words and none of its ``without`` words, which tell a
license from its near relatives. A run is at most as long as the template and the words put in that the threshold
allows. A block is twice as long as the longest run, and starts that far behind the one before, so each run lies whole
in a block. Words are put in the order of their frequency over all documents, rarest first. A block that meets a
template of t words, k of them needed, must hold one of the template's first t - k + 1 words (prefix), have k words at
all (length), and have enough words left behind the first one both share (position). Runs of blocks that pass are
compared word by word.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from muara.llm.common import documents, write_table

# The contract's separators and phrases with their labels.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


class Template(NamedTuple):
    label: str
    text: str
    must: str = ""
    without: str = ""


# Texts, headers and sentences of public licenses, lower case.
_TEXTS = (
    Template("mit", "released under the mit license", "mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "associated files"),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the "
        "software to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
        "distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to "
        "the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the software the software is provided as is without warranty of any kind express or implied including but not limited "
        "to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright "
        "holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or "
        "in connection with the software or the use or other dealings in the software",
        "associated sublicense",
    ),
    Template(
        "bsl",
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying "
        "documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to "
        "prepare derivative works of the software",
        "organization accompanying",
    ),
    Template("apache", "licensed under the apache license version 2 0", "apache"),
    Template("apache", "apache license you may not use this file except in compliance with the license", "apache compliance"),
    Template(
        "apache",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may "
        "obtain a copy of the license at unless required by applicable law or agreed to in writing software distributed under the license is "
        "distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the "
        "specific language governing permissions and limitations under the license",
        "apache compliance",
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "redistribution source binary",
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions "
        "are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the "
        "documentation and or other materials provided with the distribution",
        "redistribution binary disclaimer",
    ),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license", "mozilla"),
    Template(
        "mpl",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this "
        "file you can obtain one at",
        "mozilla mpl",
    ),
    Template(
        "mpl",
        "the contents of this file are subject to the mozilla public license version 1 1 the license you may not use this file except in "
        "compliance with the license",
        "mozilla contents",
    ),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "purpose fee"),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the "
        "above copyright notice and this permission notice appear in all copies the software is provided as is and the author disclaims all "
        "warranties with regard to this software including all implied warranties of merchantability and fitness",
        "fee appear",
    ),
    Template(
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages "
        "arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial "
        "applications and to alter it and redistribute it freely",
        "alter freely",
    ),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered"),
)
#: The family of one notice: label, name, and the words that tell it from the others.
_PUBLIC = (
    ("gpl", "gnu general public license", "general public", "lesser affero"),
    ("lgpl", "gnu lesser general public license", "lesser general public", "affero"),
    ("agpl", "gnu affero general public license", "affero general public", "lesser"),
)
_NOTICES = (
    "this work is licensed under the {} version 3",
    "this program is free software you can redistribute it and or modify it under the terms of the {}",
    "this program is free software you can redistribute it and or modify it under the terms of the {} as published by the free software "
    "foundation either version 3 of the license or at your option any later version",
)
#: Parts of a Creative Commons name, short and long, and the names they make.
_PARTS = {"nc": "noncommercial", "sa": "sharealike", "nd": "noderivatives"}
_NAMES = ((), ("nc",), ("sa",), ("nd",), ("nc", "sa"), ("nc", "nd"))


def _commons(parts: tuple[str, ...]) -> tuple[Template, Template]:
    name, others = " ".join(["cc by", *parts]), [p for p in _PARTS if p not in parts]
    words = " ".join(["attribution", *(_PARTS[p] for p in parts)])
    return (
        Template(name.replace(" ", "-"), f"licensed under {name} 4 0", name, " ".join(others)),
        Template(
            name.replace(" ", "-"),
            f"licensed under the creative commons {words} 4 0 international license",
            f"commons {words}",
            " ".join(_PARTS[p] for p in others),
        ),
    )


TEMPLATES: tuple[Template, ...] = (
    *_TEXTS,
    *(Template(label, notice.format(name), must, without) for label, name, must, without in _PUBLIC for notice in _NOTICES),
    *(template for parts in _NAMES for template in _commons(parts)),
)
THRESHOLD = 0.8


def needed(words: int, threshold: float = THRESHOLD) -> int:
    return math.ceil(threshold * words - 1e-9)


def span(text: str, threshold: float = THRESHOLD) -> int:
    """Words of the longest run that is compared with a template."""
    return math.ceil(len(text.split()) / threshold - 1e-9)


def _words(text: Column) -> Column:
    """Lower-case words. Beside A-Z the Kelvin sign alone has an ASCII letter as its lower case; it stays another letter."""
    lower = F.lower(F.replace(text, F.lit("K"), F.lit("ĸ")))
    return F.array_remove(F.split(lower, SEPARATORS + "+"), "")


def _blocks(words: Column, longest: int) -> Column:
    starts = F.sequence(F.lit(1), F.greatest(F.size(words), F.lit(1)), F.lit(longest))
    return F.transform(starts, lambda i: F.slice(words, i, F.lit(2 * longest)))


def _array(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def word_order(docs: DataFrame, templates=TEMPLATES) -> list[str]:
    """The templates' words by the number of documents that hold them, rarest first.

    One row per template word comes to the driver.
    """
    vocabulary = sorted({w for t in templates for w in t.text.split()})
    held = F.explode(F.array_intersect(_words(F.coalesce("text", F.lit(""))), _array(vocabulary)))
    counts = {r["word"]: r["count"] for r in docs.select(held.alias("word")).groupBy("word").count().collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def prefixes_of(template: Template, order: list[str], threshold: float = THRESHOLD) -> tuple[list[str], int]:
    """The template's distinct words, rarest first, and how many of them are its prefix."""
    rank = {w: i for i, w in enumerate(order)}
    words = sorted(set(template.text.split()), key=rank.__getitem__)
    return words, len(words) - needed(len(words), threshold) + 1


def template_table(spark: SparkSession, order: list[str], templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per template and prefix word: ``word, at, label, words, must, cut, need, span``.

    ``cut`` is a pattern of the words that no run may hold. The rows are literals, so Spark knows how few they are.
    """
    entries = []
    for t in templates:
        words, prefix = prefixes_of(t, order, threshold)
        cut = f"(?<![^ ])(?:{'|'.join(t.without.split())})(?![^ ])" if t.without else "(?!)"
        columns = {
            "prefix": _array(words[:prefix]),
            "label": F.lit(t.label),
            "words": _array(words),
            "must": _array(t.must.split()),
            "cut": F.lit(cut),
            "need": F.lit(needed(len(words), threshold)),
            "span": F.lit(span(t.text, threshold)),
        }
        entries.append(F.struct(*[c.alias(n) for n, c in columns.items()]))
    rows = spark.range(1).select(F.inline(F.array(*entries)))
    return rows.select(F.posexplode("prefix").alias("at", "word"), "label", "words", "must", "cut", "need", "span")


def _places(words: Column) -> Column:
    """Start and label of each place where a phrase's words stand."""

    def starts(phrase: str, label: str) -> Column:
        parts = phrase.split()
        here = lambda i: [F.get(words, i + k) == F.lit(part) for k, part in reversed(list(enumerate(parts)))]
        every = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.when(here(i)[0], _all(here(i)[1:])).otherwise(F.lit(False)))
        return F.transform(every, lambda i: F.struct(i.alias("at"), F.lit(label).alias("label")))

    # every phrase ends in a word that few texts hold
    last = _array(sorted({p.split()[-1] for p in PHRASES}))
    none = F.array().cast("array<struct<at:int,label:string>>")
    return F.when(F.arrays_overlap(words, last), F.concat(*[starts(p, label) for p, label in PHRASES.items()])).otherwise(none)


def _all(conditions: list[Column]) -> Column:
    every = F.lit(True)
    for condition in conditions:
        every = every & condition
    return every


def scanned(docs: DataFrame, prefix: list[str], longest: int) -> DataFrame:
    """One row per document and none of its text, written to the shared folder.

    ``rid, doc_id, n_words, places`` (of phrases), and ``blocks`` that hold a prefix word. A text is split once.
    """
    split = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long"), _words(F.coalesce("text", F.lit(""))).alias("words"))
    words = F.col("words")
    blocks = F.filter(_blocks(words, longest), lambda b: F.arrays_overlap(b, _array(prefix)))
    rows = split.select(
        "rid",
        "doc_id",
        F.size(words).cast("long").alias("n_words"),
        _places(words).alias("places"),
        F.when(F.arrays_overlap(words, _array(prefix)), blocks).alias("blocks"),
    )
    return write_table(rows, "licenses")


def _share(block: Column) -> Column:
    """The most of a template's words that an admissible run of the block holds; none: null."""
    span_, must, words = F.col("span"), F.col("must"), F.col("words")
    pieces = F.transform(F.split(F.array_join(block, " "), F.col("cut")), lambda s: F.array_remove(F.split(s, " "), ""))
    starts = lambda s: F.sequence(F.lit(1), F.greatest(F.size(s) - span_ + 1, F.lit(1)))
    runs = F.flatten(F.transform(pieces, lambda s: F.transform(starts(s), lambda i: F.slice(s, i, span_))))
    whole = F.filter(runs, lambda r: F.size(F.array_intersect(must, r)) == F.size(must))
    return F.array_max(F.transform(whole, lambda r: F.size(F.array_intersect(words, r))))


def similar(blocks: DataFrame, prefixes: DataFrame, order: list[str], prefix: list[str]) -> DataFrame:
    """``rid, label, score`` for every block and template that meet, from rows of ``rid, block``."""
    rare = F.filter(
        F.transform("known", lambda w, i: F.struct(w.alias("word"), i.alias("place"))), lambda e: F.array_contains(_array(prefix), e["word"])
    )
    sets = blocks.withColumn("known", F.array_intersect(_array(order), "block"))
    met = sets.select("*", F.inline(rare)).join(prefixes, "word")  # Spark checks the size of the templates
    first = F.size(F.array_intersect(F.slice("words", F.lit(1), F.col("at")), "known")) == 0
    left = F.least(F.size("words") - F.col("at"), F.size("known") - F.col("place"))
    held = (F.size(F.array_intersect("words", "known")) >= F.col("need")) & (F.size(F.array_intersect("must", "known")) == F.size("must"))
    met = met.where((F.size("known") >= F.col("need")) & (left >= F.col("need")) & first & held)  # length, position, one word a pair
    common = met.withColumn("common", _share(F.col("block"))).where("common >= need")
    return common.select("rid", "label", (F.col("common") / F.size("words")).alias("score"))


def licenses(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` for every row of ``docs``.

    ``score`` is the largest share of a template that a run of words holds, one where a phrase stands, and zero where
    neither is found. Null text counts as empty. Repeated rows and equal or null ids each keep their row. Extra
    columns are ignored.
    """
    order = word_order(docs, templates)
    prefixes = template_table(docs.sparkSession, order, templates, threshold)
    prefix = sorted({w for t in templates for words, n in [prefixes_of(t, order, threshold)] for w in words[:n]})
    rows = scanned(docs, prefix, max(span(t.text, threshold) for t in templates))
    blocks = rows.select("rid", F.explode("blocks").alias("block"))
    found = similar(blocks, prefixes, order, prefix).groupBy("rid").agg(F.collect_set("label").alias("met"), F.max("score").alias("share"))
    base = F.array_sort(F.array_distinct("places.label"))
    none = F.array().cast("array<string>")
    number = F.size("places")
    return rows.join(found, "rid", "left").select(
        "doc_id",
        "n_words",
        number.cast("long").alias("n_base"),
        F.array_min("places.at").cast("long").alias("first_word"),
        F.array_max("places.at").cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.coalesce("met", none))), ",").alias("labels"),
        F.when(number > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses(documents(spark, sf_dir))
