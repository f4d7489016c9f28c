"""Licence notices found through a positional index of rare words, in native columns only.

The words of all templates form the vocabulary. Every text is reduced to the
places of those words; document frequencies over all texts give their IDF. A
phrase is looked up by its word of highest IDF: the places of that word, less
its place in the phrase, are intersected with those of the other words in
falling order of IDF. What remains are the places where the whole phrase stands.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.staging import stage

NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Template:
    """A notice: ``key`` must stand word for word, ``notice`` (which holds it) only adds to the score."""

    label: str
    key: str
    notice: str
    base: bool = False


# The base phrases and their labels.
BASE_TEMPLATES = (
    Template(
        "gpl",
        "gnu general public license",
        "this work is licensed under the gnu general public license version 3",
        True,
    ),
    Template("apache", "apache license", "licensed under the apache license version 2 0", True),
    Template("cc-by", "cc by", "licensed under cc by 4 0", True),
    Template("mit", "mit license", "released under the mit license", True),
)
MORE_TEMPLATES = (
    Template("lgpl", "gnu lesser general public license", "licensed under the gnu lesser general public license"),
    Template("agpl", "gnu affero general public license", "licensed under the gnu affero general public license"),
    Template("mpl", "mozilla public license", "licensed under the mozilla public license version 2 0"),
    Template("bsd", "bsd license", "released under the bsd license"),
    Template("bsd", "redistribution and use in source and binary forms", "redistribution and use in source and binary forms with or without modification"),
    Template("mit", "permission is hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy"),
    Template("apache-2", "apache license version 2", "licensed under the apache license version 2 0"),
    Template("gpl-3", "gnu general public license version 3", "this work is licensed under the gnu general public license version 3"),
    Template("cc-by-nc", "cc by nc", "licensed under cc by nc 4 0"),
    Template("cc-by-sa", "cc by sa", "licensed under cc by sa 4 0"),
    Template("cc-by-nd", "cc by nd", "licensed under cc by nd 4 0"),
    Template("all-rights-reserved", "all rights reserved", "all rights reserved"),
)


def license_words(text: Column) -> Column:
    """Words of a text with A-Z in lower case: runs outside ASCII punctuation and blanks."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(lowered, NOT_WORD), "")


def word_places(docs: DataFrame, vocabulary: Sequence[str], text_col: str = "_text") -> DataFrame:
    """Replace the text by ``n_words`` and ``hits``, the vocabulary words with their places."""
    words = F.col("_words")
    known = F.filter(
        F.when(F.size(words) > 0, F.sequence(F.lit(0), F.size(words) - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: F.get(words, i).isin(list(vocabulary)),
    )
    hits = F.transform(known, lambda i: F.struct(F.get(words, i).alias("word"), i.alias("place")))
    kept = [c for c in docs.columns if c != text_col]
    split = docs.withColumn("_words", license_words(F.col(text_col)))
    return split.select(*kept, F.size("_words").cast("long").alias("n_words"), hits.alias("hits"))


def inverse_frequencies(hits: DataFrame, vocabulary: Sequence[str]) -> dict[str, float]:
    """IDF of every vocabulary word over all documents; reads one row per vocabulary word."""
    counted = (
        hits.select(F.explode(F.array_distinct(F.transform("hits", lambda h: h["word"]))).alias("word"))
        .groupBy("word")
        .count()
    )
    found = {row["word"]: row["count"] for row in counted.collect()}
    total = hits.count()
    return {w: math.log((1 + total) / (1 + found.get(w, 0))) for w in vocabulary}


def _aligned(word: str, place: int) -> Column:
    """Where a phrase would start if ``word`` stood at its ``place`` in it."""
    return F.transform(F.filter("hits", lambda h: h["word"] == word), lambda h: h["place"] - place)


def phrase_places(phrase: str, idf: dict[str, float]) -> Column:
    """First-word places of a phrase, by intersection from its rarest word on."""
    order = sorted(enumerate(phrase.split()), key=lambda x: (-idf[x[1]], x[0]))
    found = None
    for place, word in order:
        starts = _aligned(word, place)
        found = starts if found is None else F.array_intersect(found, starts)
    rare = order[0][1]
    present = F.exists("hits", lambda h: h["word"] == rare)
    return F.when(present, found).otherwise(F.array().cast("array<int>"))


def _notice_score(template: Template, first: Column, idf: dict[str, float]) -> Column:
    """Share of the notice's IDF that stands around the first place of its key."""
    words, key = template.notice.split(), template.key.split()
    lead = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
    total = sum(idf[w] for w in words)
    if total <= 0:
        return F.lit(1.0)
    start = first - lead

    def weight(word: str, place: int) -> Column:
        stands = F.exists("hits", lambda h: (h["word"] == word) & (h["place"] == start + place))
        return F.when(stands, F.lit(idf[word])).otherwise(F.lit(0.0))

    found = [weight(w, i) for i, w in enumerate(words)]
    return F.least(F.lit(1.0), sum(found[1:], found[0]) / F.lit(total))


def scan_licenses(
    docs: DataFrame,
    templates: Sequence[Template] = (*BASE_TEMPLATES, *MORE_TEMPLATES),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Licence labels and places of every document.

    Returns ``(id_col, n_words, places, base_labels, labels, score)``:
    ``places`` is a list of ``(label, base, start)`` over all places where a
    template's key phrase stands; ``score`` is the best share of a notice, by
    IDF, around the first place of its key, 0 without one. One row per row of
    ``docs``, repeated rows included; a null text has no words; other columns
    are left out and may have any name; an empty table gives no rows.

    Runs jobs: places of vocabulary words are staged once, then counted.
    """
    vocabulary = sorted({w for t in templates for w in t.notice.split()})
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    hits = stage(word_places(rows, vocabulary), "license-words", compression="zstd")
    idf = inverse_frequencies(hits, vocabulary)
    starts = [f"_starts{i}" for i in range(len(templates))]
    found = hits.select("*", *(phrase_places(t.key, idf).alias(s) for s, t in zip(starts, templates, strict=True)))
    found = found.select("*", *(F.array_min(s).alias(f"{s}_first") for s in starts))
    pairs = list(zip(starts, templates, strict=True))
    none = F.array().cast("array<string>")
    named = lambda chosen: F.concat(
        none, *(F.when(F.size(s) > 0, F.array(F.lit(t.label))).otherwise(none) for s, t in chosen)
    )
    def listed(starts: str, template: Template) -> Column:
        label, base = F.lit(template.label).alias("label"), F.lit(template.base).alias("base")
        return F.transform(starts, lambda p: F.struct(label, base, p.alias("start")))

    places = F.flatten(F.array(*(listed(s, t) for s, t in pairs)))
    scores = [
        F.when(F.size(s) > 0, _notice_score(t, F.col(f"{s}_first"), idf)).otherwise(F.lit(0.0)) for s, t in pairs
    ]
    return found.select(
        F.col("_id").alias(id_col),
        "n_words",
        places.alias("places"),
        F.array_sort(F.array_distinct(named([p for p in pairs if p[1].base]))).alias("base_labels"),
        F.array_sort(F.array_distinct(named(pairs))).alias("labels"),
        F.greatest(*scores, F.lit(0.0)).alias("score"),
    )
