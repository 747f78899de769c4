"""Licence scans with a positional index of rare words, in DataFrame functions only.

A template is a licence notice as a list of words, some of them mandatory key phrases.  How rare a
licence word is follows from the documents that hold it (inverse document frequency, IDF, over the
whole table).  The index keeps, for each template, the places of its ``RARE`` rarest words.

A file's words are looked up in it: a word at place i that stands at place q of a template votes
for the pair (template, i - q).  Where at least half of a template's indexed places agree on one
pair, the template's words are compared with the file's from there on; the alignment counts if all
key phrases stand where they should, give or take ``DRIFT`` words, and if the words that agree have
at least ``SHARE`` of the template's IDF.

All of this happens within a row, in time proportional to its text and its votes: there is no
exchange but the one for the word frequencies, which sends one row per task and licence word.

Defined results: a null text counts as empty and has no words.  Words are counted from 0.  Rows are
independent, so repeated rows and ids get equal results and any text is read whole, however long.  An
empty table gives no row.  Further columns are passed through; those named like a result
(``n_words``, ``base``, ``licences``) are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Public licence notices in lower case without marks, (label, words, key phrases).
TEMPLATES = (
    ("mit", "mit license", ("mit license",)),
    ("apache", "apache license", ("apache license",)),
    ("gpl", "general public license", ("general public license",)),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
        ("hereby granted free of charge", "deal in the software without restriction"),
    ),
    (
        "apache",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
        ("except in compliance with the license",),
    ),
    (
        "apache",
        "unless required by applicable law or agreed to in writing software distributed under the license is "
        "distributed on an as is basis without warranties or conditions of any kind either express or implied",
        ("unless required by applicable law", "without warranties or conditions of any kind"),
    ),
    (
        "gpl",
        "is free software you can redistribute it and or modify it under the terms of the gnu general public license "
        "as published by the free software foundation either version",
        ("redistribute it and or modify it", "published by the free software foundation"),
    ),
    ("lgpl", "gnu lesser general public license", ("lesser general public license",)),
    ("agpl", "gnu affero general public license", ("affero general public license",)),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
        ("redistribution and use in source and binary forms", "following conditions are met"),
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
        ("with or without fee", "appear in all copies"),
    ),
    (
        "zlib",
        "in no event will the authors be held liable for any damages arising from the use of this software",
        ("held liable for any damages arising from the use",),
    ),
    ("mpl", "subject to the terms of the mozilla public license", ("mozilla public license",)),
    ("epl", "eclipse public license", ("eclipse public license",)),
    ("boost", "distributed under the boost software license version", ("boost software license",)),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ("unencumbered software released into the public domain",),
    ),
    ("cc-by", "licensed under cc by 4 0", ("cc by 4 0",)),
    ("cc-by", "creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    ("cc0", "cc0 1 0 universal", ("cc0 1 0",)),
)
# The phrases of base places and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# What stands between words.
MARKS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
# Places of a template in the index, the rarest first.
RARE = 4
# Words by which a key phrase may be off its place in the alignment.
DRIFT = 3
# Share of a template's IDF that must agree.
SHARE = 0.6

LICENCES = "array<struct<label:string,template:int,first_word:int,share:double>>"


@dataclass(frozen=True)
class Index:
    """Words, weights and indexed places of each template."""

    words: list[list[str]]
    weights: list[list[float]]
    rare: list[list[int]]

    @property
    def postings(self) -> dict[str, list[tuple[int, int]]]:
        found: dict[str, list[tuple[int, int]]] = {}
        for t, places in enumerate(self.rare):
            for q in places:
                found.setdefault(self.words[t][q], []).append((t, q))
        return found


def template_words() -> list[list[str]]:
    return [text.split() for _, text, _ in TEMPLATES]


def vocabulary() -> list[str]:
    return sorted({word for words in template_words() for word in words})


def lowered(text: Column) -> Column:
    """The text with A-Z in lower case.

    The Kelvin sign and the dotted capital I have ASCII letters in lower case; private letters
    replace them, so no word becomes a licence word by them.
    """
    plain = F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\ue000"))
    return F.lower(F.replace(plain, F.lit("\u0130"), F.lit("\ue001")))


def words_of(text: Column) -> Column:
    """The words; after marks at the end of the text one empty word follows."""
    return F.split(F.regexp_replace(lowered(text), f"^{MARKS}", ""), MARKS)


def frequencies(docs: DataFrame) -> tuple[int, dict[str, int]]:
    """How many documents there are, and how many hold each licence word."""
    held = docs.select(F.array_intersect(_array(vocabulary(), "string"), words_of(F.col("text"))).alias("held"))
    # Not explode, whose check for empty lists would cut the text a second time.
    counts = held.select(F.explode_outer("held").alias("word")).where("word is not null").groupBy("word").count()
    return docs.count(), {row["word"]: row["count"] for row in counts.collect()}  # one row per licence word


def build_index(n_docs: int, holding: dict[str, int]) -> Index:
    """The index by the IDF of a table of ``n_docs`` documents; ties go to the earlier place."""
    words = template_words()
    weights = [[1 + math.log((n_docs + 1) / (holding.get(w, 0) + 1)) for w in template] for template in words]
    rare = [
        sorted(sorted(range(len(template)), key=lambda q: (holding.get(template[q], 0), q))[:RARE]) for template in words
    ]
    return Index(words, weights, rare)


def _array(values, kind: str) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")


def scan(docs: DataFrame, index: Index) -> DataFrame:
    """The documents with ``n_words``; ``base``: (label, first_word) of the base places; and
    ``licences``: (label, template, first_word, share) of the alignments that count."""
    kept = [c for c in docs.columns if c.lower() not in ("n_words", "base", "licences")]
    postings = index.postings
    indexed = sorted(postings)
    word_at = lambda i: F.get("_words", i)

    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), words_of(F.col("text")).alias("_words")
    )
    places = F.filter(F.transform("_words", lambda w, i: F.when(w.isin(indexed), i)), lambda i: i.isNotNull())
    # Most texts have no indexed word at all, which a set tells sooner than a look at every place.
    places = F.when(F.arrays_overlap("_words", _array(indexed, "string")), places).otherwise(_array([], "int"))
    found = rows.select("_row", "_words", places.alias("_places"))

    # Votes: every posting of a word, moved by the place where the file has it.
    by_word = F.create_map(
        *[
            part
            for word in indexed
            for part in (F.lit(word), F.array(*[F.struct(F.lit(t).alias("t"), F.lit(q).alias("q")) for t, q in postings[word]]))
        ]
    )
    votes = F.flatten(
        F.transform(
            "_places",
            lambda i: F.transform(
                F.element_at(by_word, word_at(i)), lambda p: F.struct(p["t"].alias("t"), (i - p["q"]).alias("at"))
            ),
        )
    )
    voted = found.select("_row", "_words", "_places", F.sort_array(votes).alias("_votes"))

    # A pair has enough votes if it is the last of a run that is long enough.
    need = _array([(len(places) + 1) // 2 for places in index.rare], "int")
    vote_at = lambda i: F.get("_votes", i)
    agreed = F.filter(
        "_votes",
        lambda c, i: F.coalesce(vote_at(i - F.get(need, c["t"]) + 1) == c, F.lit(False))
        & ~F.coalesce(vote_at(i + 1) == c, F.lit(False)),
    )
    aligned = voted.select("_row", "_words", "_places", agreed.alias("_agreed"))

    # Key phrases, and the share of the template's weight.
    texts = F.array(*[_array(words, "string") for words in index.words])
    # Shares of the whole, so that they add up to one.
    shares = F.array(*[_array([w / sum(weights) for w in weights], "double") for weights in index.weights])
    phrases = F.array(*[F.array(*[_phrase(words, p) for p in TEMPLATES[t][2]]) for t, words in enumerate(index.words)])
    labels = _array([label for label, _, _ in TEMPLATES], "string")

    def verified(c: Column) -> Column:
        def stands(phrase: Column, off: Column) -> Column:
            begin = c["at"] + phrase["q"] + off
            return F.forall(
                F.sequence(F.lit(0), F.size(phrase["words"]) - 1),
                lambda j: F.coalesce(word_at(begin + j) == F.get(phrase["words"], j), F.lit(False)),
            )

        shifts = F.array(*[F.lit(d) for d in sorted(range(-DRIFT, DRIFT + 1), key=abs)])
        return F.forall(F.get(phrases, c["t"]), lambda p: F.exists(shifts, lambda off: stands(p, off)))

    def share(c: Column) -> Column:
        words, weights = F.get(texts, c["t"]), F.get(shares, c["t"])
        return F.aggregate(
            F.sequence(F.lit(0), F.size(words) - 1),
            F.lit(0.0),
            lambda total, q: total
            + F.when(word_at(c["at"] + q) == F.get(words, q), F.get(weights, q)).otherwise(F.lit(0.0)),
        )

    licences = F.transform(
        F.filter("_agreed", verified),
        lambda c: F.struct(
            F.get(labels, c["t"]).alias("label"),
            c["t"].alias("template"),
            c["at"].alias("first_word"),
            F.least(F.round(share(c), 6), F.lit(1.0)).alias("share"),
        ),
    )
    base = F.filter(F.transform("_places", lambda i: F.struct(_base_label(word_at, i).alias("label"), i.alias("first_word"))), lambda b: b["label"].isNotNull())
    done = aligned.select(
        "_row", (F.size("_words") - (F.element_at("_words", -1) == "").cast("int")).cast("long").alias("_n"), base.alias("_base"), F.filter(licences, lambda x: x["share"] >= SHARE).alias("_found")
    )
    return done.select(
        *[F.col("_row")[c].alias(c) for c in kept],
        F.col("_n").alias("n_words"),
        F.col("_base").alias("base"),
        F.col("_found").alias("licences"),
    )


def _phrase(words: list[str], phrase: str) -> Column:
    """A key phrase and its place in the template."""
    parts = phrase.split()
    q = next(q for q in range(len(words)) if words[q : q + len(parts)] == parts)
    return F.struct(F.lit(q).alias("q"), _array(parts, "string").alias("words"))


def _base_label(word_at, i: Column) -> Column:
    label = F.lit(None).cast("string")
    for phrase, name in BASE:
        same = F.lit(True)
        for j, word in enumerate(phrase.split()):
            same = same & F.coalesce(word_at(i + j) == word, F.lit(False))
        label = F.when(same, name).otherwise(label)
    return label
