"""License scans by a positional index of rare tokens, with DataFrame functions only.

The index holds, for each template, the words of its key phrases of the highest inverse document frequency, with
their positions; frequencies are counted over all documents. A file's words are looked up in it: each posting, moved back by its
position in the template, says where the template would begin, and the postings of a template are intersected by
that place. Where all agree, the mandatory key phrases are verified word by word. A match's share is the part of
the template's words that stand at their places, so a license with other words in between still matches.

Everything happens inside a document's row, without a shuffle; only document frequencies (at most one number a
template word) come to the driver, and the templates are a parameter of bounded size (MOST_WORDS). Whichever word
is rarest, the words of the key phrases must all be there, so the frequencies never change the result.

A null text has no words. Rows are independent: repeated rows, ties and null doc_id keep their rows. An empty
table gives an empty result. Words are lower-cased in A-Z only.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lorebank.llm.common import table, text_of

#: Words of a template that are looked up.
RARE_WORDS = 3
#: Words of all templates together, at most: the index is part of each task's plan.
MOST_WORDS = 5_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """Words of a license; ``keys`` are phrases of it that must stand at their places. Without keys, all words must."""

    label: str
    text: str
    keys: tuple[str, ...] = ()
    base: bool = False

    @property
    def words(self) -> list[str]:
        return [w for w in re.split(_GAP, self.text.translate(str.maketrans(_UPPER, _LOWER))) if w]

    def key_places(self) -> list[tuple[int, list[str]]]:
        """Each key phrase with its place in the template."""
        if not self.keys:
            return [(0, self.words)]
        out, own = [], self.words
        for key in self.keys:
            phrase = key.split()
            places = [i for i in range(len(own) - len(phrase) + 1) if own[i : i + len(phrase)] == phrase]
            if not places:
                raise ValueError(f"{key!r} is not a phrase of {self.label}")
            out.append((places[0], phrase))
        return out


# The phrases and labels of the contract.
BASE = (
    Template("mit", "mit license", base=True),
    Template("apache", "apache license", base=True),
    Template("gpl", "general public license", base=True),
)

# Wording of published licenses and of the usual lines that name them.
TEMPLATES = (
    Template("apache-2.0", "Apache License, Version 2.0"),
    Template("gpl-2.0", "GNU General Public License, version 2"),
    Template("gpl-3.0", "GNU General Public License, version 3"),
    Template("lgpl", "GNU Lesser General Public License"),
    Template("agpl", "GNU Affero General Public License"),
    Template("mpl-2.0", "Mozilla Public License, version 2.0"),
    Template("cc-by-4.0", "CC BY 4.0"),
    Template("cc-by-sa-4.0", "CC BY-SA 4.0"),
    Template("cc-by-nc-4.0", "CC BY-NC 4.0"),
    Template("cc-by-nc-sa-4.0", "CC BY-NC-SA 4.0"),
    Template("cc-by-nd-4.0", "CC BY-ND 4.0"),
    Template("cc0-1.0", "CC0 1.0 Universal"),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction",
        ("hereby granted free of charge", "to any person obtaining a copy"),
    ),
    Template(
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        ("for any purpose with or without fee", "hereby granted"),
    ),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        ("in source and binary forms", "are permitted provided that"),
    ),
    Template("unlicense", "This is free and unencumbered software released into the public domain", ("free and unencumbered software", "public domain")),
)


def words_of(text: Column) -> Column:
    """The words of a text in lower case, in order."""
    return F.array_remove(F.split(F.translate(text, _UPPER, _LOWER), _GAP), "")


def document_frequencies(words: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Documents that hold each word of the vocabulary; ``words``: one row a document."""
    known = F.array(*map(F.lit, vocabulary))
    found = words.select(F.explode(F.array_intersect("words", known)).alias("word")).groupBy("word").count()
    return {r.word: r["count"] for r in found.collect()}


def rare_words(template: Template, frequency: dict[str, int], rare: int = RARE_WORDS) -> list[tuple[str, int]]:
    """Words of the key phrases of the highest inverse document frequency (ties by word), each with one of its places."""
    places = {w: start + i for start, phrase in template.key_places() for i, w in enumerate(phrase)}
    return [(w, places[w]) for w in sorted(places, key=lambda w: (frequency.get(w, 0), w))[:rare]]


def _literal(words: list[str]) -> Column:
    return F.array(*map(F.lit, words))


def _starts(template: Template, frequency: dict[str, int], rare: int) -> Column:
    """Where the postings of the rare words agree that the template begins, key phrases verified."""

    def posted(word: str, place: int) -> Column:
        return F.transform(F.filter("hits", lambda h: h["word"] == F.lit(word)), lambda h: h["at"] - F.lit(place))

    agreed = reduce(F.array_intersect, [posted(w, p) for w, p in rare_words(template, frequency, rare)])

    def verified(start: Column) -> Column:
        tests = [F.slice("words", start + F.lit(1 + place), F.lit(len(key))) == _literal(key) for place, key in template.key_places()]
        return reduce(Column.__and__, tests, start >= 0)

    return F.filter(agreed, verified)


def _matches(template: Template, starts: Column) -> Column:
    own = template.words
    places = F.sequence(F.lit(0), F.lit(len(own) - 1))

    def match(start: Column) -> Column:
        kept = F.size(F.filter(places, lambda j: F.get("words", start + j) == F.get(_literal(own), j)))
        share = F.lit(1.0) if not template.keys else kept / F.lit(float(len(own)))
        return F.struct(
            F.lit(template.label).alias("label"), F.lit(template.base).alias("base"), start.cast("bigint").alias("start"),
            F.lit(len(own)).alias("n_words"), share.alias("share"),
        )

    return F.transform(starts, match)


def scan_licenses(docs: DataFrame, templates: tuple[Template, ...] = BASE + TEMPLATES, rare: int = RARE_WORDS) -> DataFrame:
    """docs with n_words and license_matches: label, base, start (word, from 0), n_words of the template, share.

    Columns of docs with these names, or named ``words`` or ``hits``, are replaced or dropped.
    """
    sizes = Counter(w for t in templates for w in t.words)
    if sum(sizes.values()) > MOST_WORDS:
        raise ValueError(f"templates of more than {MOST_WORDS} words")
    if any(not t.words for t in templates):
        raise ValueError("a template without words")
    kept = [c for c in docs.columns if c not in ("n_words", "license_matches", "words", "hits")]
    frequency = document_frequencies(docs.select(words_of(text_of("text")).alias("words")), sorted(sizes))
    indexed = sorted({w for t in templates for w, _ in rare_words(t, frequency, rare)})
    none = F.array().cast("array<struct<word: string, at: int>>")
    numbered = F.transform("words", lambda w, i: F.struct(w.alias("word"), i.alias("at")))
    hits = F.when(F.arrays_overlap("words", _literal(indexed)), F.filter(numbered, lambda h: h["word"].isin(indexed))).otherwise(none)
    found = docs.select(*kept, words_of(text_of("text")).alias("words")).select(*kept, "words", hits.alias("hits"))
    empty = F.array().cast("array<struct<label: string, base: boolean, start: bigint, n_words: int, share: double>>")
    matches = F.when(F.size("hits") > 0, F.flatten(F.array(*(_matches(t, _starts(t, frequency, rare)) for t in templates)))).otherwise(empty)
    return found.select(*kept, F.size("words").cast("bigint").alias("n_words"), matches.alias("license_matches"))


def labels_of(matches: Column) -> Column:
    """Distinct labels, sorted and joined by commas."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan_licenses(docs).withColumn("base", F.filter("license_matches", lambda m: m["base"]))
    starts = F.transform("base", lambda m: m["start"])
    return found.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "n_words", F.size("base").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels_of(F.col("base")).alias("base_labels"), labels_of(F.col("license_matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("license_matches", lambda m: m["share"])), F.lit(0.0)).alias("score"),
    )
