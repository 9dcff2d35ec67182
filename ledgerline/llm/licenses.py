"""License scans: an exact set-similarity join of text blocks with licence templates.

Words are runs of digits, letters and non-ASCII characters, A-Z in lower case, so
that line ends, comment marks and indents of a wrapped notice part words and do no
more. A block is a window of consecutive words, as the set of them; its length is
the template's number of words and a tenth more. A template is found in a block
that holds at least ``PERCENT`` / 100 of the template's different words.

All words of the corpus that occur in templates are counted; every template is put
in the order of these counts, rarest first. Blocks are compared with it only if

prefix     one of the |T| - a + 1 rarest words of the template is in the block,
           a being the least overlap; no other word becomes a row,
length     the words within a block's length of that word hold ``a`` different
           words of the template,
position   the block begins at most its length before that word and not after it.

Only built-in functions run. The templates are a fixed list, and so is what is
collected: the counts of their words. A template found in a block is dropped if
another holds all its words and more, and is found as fully in the block widened
by the difference of their lengths, as "GNU Lesser" holds "GNU".

Null and empty texts have no words. Repeated rows get the same labels each; rows
are found again by id and text hash, so ids may repeat or be null. Other columns
are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import materialize

PERCENT = 90
NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SLACK_PERCENT = 10  # words that a block may hold beyond the template's

# Phrases that are labels by themselves.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Words of well-known licence notices, with their labels.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files to deal in the software without restriction"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at "
               "http www apache org licenses license 2 0"),
    ("gpl", "licensed under the gnu general public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license"),
    ("bsd", "licensed under the bsd 3 clause license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc0", "licensed under cc0 1 0"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nd", "licensed under cc by nd 4 0"),
    ("cc-by-nc-sa", "licensed under cc by nc sa 4 0"),
    ("cc-by-nc-nd", "licensed under cc by nc nd 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
)

_PHRASE = "(?i)(?<![^ ])(?:" + "|".join(PHRASES) + ")(?![^ ])"


def word_line(text: Column) -> Column:
    """The words of ``text``, one blank between them."""
    return F.trim(F.regexp_replace(text, NOT_WORD, " "))


def n_words(line: Column) -> Column:
    """Number of words of a ``word_line``."""
    return F.when(line == "", 0).otherwise(F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1).cast("bigint")


def _rows(documents: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("print"))


def phrase_places(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``print``, word count, and where the phrases stand: count, first and last word, their labels."""
    rows = _rows(documents).select("doc_id", "print", word_line(F.col("text")).alias("line"))
    rows = rows.withColumn("n_words", n_words(F.col("line")))
    rows = rows.withColumn("gaps", F.when(F.col("line").rlike("(?i)license"), F.split("line", _PHRASE, -1)))
    found = F.when(F.col("gaps").isNotNull(), F.regexp_extract_all("line", F.lit(_PHRASE), F.lit(0)))
    rows = rows.withColumn("found", F.transform(found, lambda x: F.lower(x)))
    n = F.coalesce(F.size("gaps") - 1, F.lit(0)).cast("bigint")
    n = F.when(F.col("gaps").isNull(), F.lit(0)).otherwise(n).cast("bigint")
    first = n_words(F.trim(F.get("gaps", F.lit(0))))
    after = n_words(F.trim(F.try_element_at("gaps", F.lit(-1))))
    last = F.col("n_words") - after - n_words(F.try_element_at("found", F.lit(-1)))
    labels = F.create_map(*(F.lit(x) for pair in PHRASES.items() for x in pair))
    found = F.coalesce(F.array_distinct(F.transform("found", lambda x: labels[x])), F.array().cast("array<string>"))
    return rows.select("doc_id", "print", "n_words", n.alias("n_base"), first.alias("first"), last.alias("last"), found.alias("base")).select(
        "doc_id", "print", "n_words", "n_base",
        F.when(F.col("n_base") > 0, F.col("first")).alias("first_word"),
        F.when(F.col("n_base") > 0, F.col("last")).alias("last_word"),
        F.array_sort("base").alias("base"),
    )


@dataclass(frozen=True)
class Template:
    """A notice: its different words, the rarest first, and the length of its blocks."""

    label: str
    words: tuple[str, ...]
    window: int

    def least(self, percent: int) -> int:
        return -(-len(self.words) * percent // 100)

    def prefix(self, percent: int) -> tuple[str, ...]:
        return self.words[: len(self.words) - self.least(percent) + 1]


def templates(counts: dict[str, int]) -> list[Template]:
    """The fixed notices with their words in the order of ``counts``."""
    out = []
    for label, text in TEMPLATES:
        words = text.split()
        ordered = sorted(set(words), key=lambda w: (counts.get(w, 0), w))
        out.append(Template(label, tuple(ordered), len(words) + len(words) * SLACK_PERCENT // 100))
    return out


def _strings(values) -> Column:
    return F.array(*map(F.lit, values))


def _words(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``print`` and all words of each text, an array."""
    return _rows(documents).select("doc_id", "print", F.split(F.lower(word_line(F.col("text"))), " ").alias("words"))


def word_counts(documents: DataFrame) -> dict[str, int]:
    """How often each word of the templates occurs in the corpus, if it does."""
    vocabulary = sorted({word for _, text in TEMPLATES for word in text.split()})
    rows = _words(documents).select(F.explode("words").alias("word")).where(F.col("word").isin(vocabulary))
    return {word: n for word, n in rows.groupBy("word").count().collect()}


def template_matches(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``print``, ``label`` and the best ``containment`` of the templates found around each prefix word."""
    known = templates(word_counts(documents))
    wider = [
        [(b, b.window - a.window) for b in known if len(b.words) > len(a.words) and set(a.words) < set(b.words)] for a in known
    ]
    reach = max(t.window - 1 + max([0, *(d for _, d in own)]) for t, own in zip(known, wider))
    by_word: dict[str, list[int]] = {}
    for number, template in enumerate(known):
        for word in template.prefix(percent):
            by_word.setdefault(word, []).append(number)

    # The words around every prefix word.
    rows = _words(documents).where(F.arrays_overlap("words", _strings(by_word)))
    places = F.filter(
        F.transform("words", lambda w, i: F.when(w.isin(list(by_word)), i)), lambda i: i.isNotNull()
    )

    def around(place: Column) -> Column:
        first = F.greatest(place - reach, F.lit(0))
        own = F.slice("words", first + 1, place + reach + 1 - first)
        return F.struct(own.alias("near"), (place - first).alias("hit"))

    hits = rows.withColumn("places", places).select("doc_id", "print", F.explode(F.transform("places", around)).alias("x"))
    hits = hits.select("doc_id", "print", "x.near", "x.hit")
    numbers = F.create_map(*(c for word, own in by_word.items() for c in (F.lit(word), F.array(*map(F.lit, own)))))
    hits = hits.withColumn("t", F.explode(F.element_at(numbers, F.get("near", F.col("hit")))))

    # Columns of the hit's template.
    own = {
        "label": _strings(t.label for t in known),
        "own": F.array(*(_strings(t.words) for t in known)),
        "width": F.array(*(F.lit(t.window) for t in known)),
        "least": F.array(*(F.lit(t.least(percent)) for t in known)),
        "wider": F.array(*(_wider(x) for x in wider)),
    }
    hits = hits.withColumns({name: F.get(values, F.col("t")) for name, values in own.items()}).drop("t")
    first = F.greatest(F.col("hit") - F.col("width") + 1, F.lit(0))
    region = F.slice("near", first + 1, F.col("hit") + F.col("width") - first)
    hits = hits.where(F.size(F.array_intersect(region, "own")) >= F.col("least"))

    def block(start: Column) -> Column:
        common = F.size(F.array_intersect(F.slice("near", start + 1, F.col("width")), "own"))
        return F.struct(start.alias("start"), common.alias("common"))

    def covered(x: Column) -> Column:
        def by(b: Column) -> Column:
            begin = F.greatest(x["start"] - b["more"], F.lit(0))
            around_it = F.slice("near", begin + 1, x["start"] + F.col("width") + b["more"] - begin)
            return F.size(F.array_intersect(around_it, b["words"])) * F.size("own") >= x["common"] * F.size(b["words"])

        return F.exists("wider", by)

    blocks = F.filter(F.transform(F.sequence(first, F.col("hit")), block), lambda x: x["common"] >= F.col("least"))
    found = hits.withColumn("blocks", blocks)
    found = found.withColumn("kept", F.filter("blocks", lambda x: ~covered(x))).where(F.size("kept") > 0)
    best = F.array_max(F.transform("kept", lambda x: x["common"]))
    return found.select("doc_id", "print", "label", (best / F.size("own")).alias("containment"))


def _wider(found: list[tuple[Template, int]]) -> Column:
    """Templates that hold all words of another, with the difference of lengths."""
    rows = [F.struct(_strings(t.words).alias("words"), F.lit(more).alias("more")) for t, more in found]
    return F.array(*rows).cast("array<struct<words:array<string>,more:int>>")


def scan(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per document: phrase places, ``base`` and all ``labels``, and the ``score``.

    The score is the best containment of a template, and 1 where a phrase stands.
    """
    found = template_matches(documents, percent).groupBy("doc_id", "print").agg(
        F.collect_set("label").alias("labels"), F.max("containment").alias("score")
    )
    found = materialize(found, "license-labels").alias("f")
    rows = phrase_places(documents).alias("d")
    match = F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.print") == F.col("f.print"))
    none = F.array().cast("array<string>")
    return rows.join(found, match, "left").select(
        "d.doc_id", "n_words", "n_base", "first_word", "last_word", "base",
        F.array_sort(F.array_union("base", F.coalesce("labels", none))).alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("score", F.lit(0.0))).alias("score"),
    )
