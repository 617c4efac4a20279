"""License scan with a positional rare-token index, in DataFrame expressions only.

``TEMPLATES`` are license notices as word sequences, each with mandatory key phrases. One pass over
all texts counts in how many documents each mandatory word occurs. The index posts every template
with an offset under its mandatory word of highest inverse document frequency (ties: the earlier
word): a file that holds the template holds that word. Index and templates are constants of the
plan, whose size grows with the templates alone and whose expressions do not repeat per template.
In a second pass each text is cut into words once; a text without any of the looked-up words is
done. Otherwise every occurrence of one, minus the posted offset, proposes a template and a start;
the template's other words are intersected at their relative places, and a start counts
if all mandatory phrases stand there. The score of a match is the share of the template's
words that stand at their places.

Everything about a document happens in its own row: no shuffle, no pairing, no hot key.
Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` of the lower-cased text.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    must: tuple[tuple[int, int], ...]  # spans (first word, end) that have to stand there
    base: bool = False

    @property
    def mandatory(self) -> tuple[int, ...]:
        return tuple(j for a, b in self.must for j in range(a, b))


def _template(label: str, text: str, base: bool = False) -> Template:
    """``[...]`` marks the mandatory phrases of the text."""
    words, must = [], []
    for part in text.replace("[", " [ ").replace("]", " ] ").split():
        if part == "[":
            opened = len(words)
        elif part == "]":
            must.append((opened, len(words)))
        else:
            words.append(part)
    return Template(label, tuple(words), tuple(must), base)


BASE = (
    _template("mit", "[mit license]", True),
    _template("apache", "[apache license]", True),
    _template("gpl", "[general public license]", True),
)
TEMPLATES = BASE + (
    _template("agpl", "gnu [affero general public license]"),
    _template("apache-2.0", "licensed under the [apache license version 2 0]"),
    _template("bsd", "redistribution and use in [source and binary forms] with or without modification"),
    _template("bsd", "licensed under the [bsd license]"),
    _template("cc-by-nc", "licensed under [cc by nc] 4 0"),
    _template("cc-by-sa", "licensed under [cc by sa] 4 0"),
    _template("cc-by", "[creative commons attribution] license"),
    _template("gpl-3", "gnu [general public license version 3]"),
    _template("gpl-2", "gnu [general public license version 2]"),
    _template("isc", "[isc license]"),
    _template("lgpl", "gnu [lesser general public license]"),
    _template("mit", "[permission is hereby granted] free of charge [to any person obtaining a copy]"),
    _template("mpl", "[mozilla public license] version 2 0"),
    _template("proprietary", "[all rights reserved]"),
    _template("unlicense", "[released into the public domain]"),
)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), BREAKS), "")


def _constant(words: Sequence[str]) -> Column:
    """Words (none holds a space) as one constant array."""
    return F.split(F.lit(" ".join(words)), " ")


def document_frequency(words: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """In how many rows of ``words`` (an array column ``w``) each word of the vocabulary occurs."""
    known = _constant(vocabulary)
    found = words.select(F.explode(F.array_intersect("w", known)).alias("v")).groupBy("v").count()
    return {r[0]: r[1] for r in found.collect()}  # at most one row per template word


def _index(templates: tuple[Template, ...], frequency: dict[str, int]) -> tuple[list[str], Column, Column]:
    """The looked-up words, their postings and the templates, as constants of the plan.

    Postings: word -> (template number, offset). A template is posted under its mandatory word of
    highest inverse document frequency, so a file's look-ups are of its rarest license words.
    """
    postings: dict[str, list[tuple[int, int]]] = {}
    for k, t in enumerate(templates):
        rare = min(t.mandatory, key=lambda j: (frequency.get(t.words[j], 0), j))
        postings.setdefault(t.words[rare], []).append((k, rare))
    anchors = sorted(postings)
    lists = [
        F.array(*[F.struct(F.lit(k).alias("t"), F.lit(j).alias("offset")) for k, j in postings[w]]) for w in anchors
    ]
    known = F.map_from_arrays(_constant(anchors), F.array(*lists))
    notices = F.array(*[
        F.struct(
            F.lit(t.label).alias("label"), _constant(t.words).alias("words"),
            F.expr(f"array({', '.join(map(str, t.mandatory))})").alias("must"), F.lit(t.base).alias("base"),
        )
        for t in templates
    ])
    return anchors, known, notices


def _places(words: Column, hits: Column, postings: Column, notices: Column) -> Column:
    """All matches in one text: proposed by its looked-up words, intersected at their relative places."""

    def proposed(h: Column) -> Column:
        return F.transform(
            F.element_at(postings, h["w"]), lambda p: F.struct(p["t"].alias("t"), (h["at"] - p["offset"]).alias("start"))
        )

    def stands(c: Column) -> Column:
        t = F.get(notices, c["t"])
        return (c["start"] >= 0) & F.forall(
            t["must"], lambda j: F.get(words, c["start"] + j).eqNullSafe(F.get(t["words"], j))
        )

    def match(c: Column) -> Column:
        t = F.get(notices, c["t"])
        standing = F.size(F.filter(t["words"], lambda x, j: F.get(words, c["start"] + j).eqNullSafe(x)))
        return F.struct(
            t["label"].alias("label"), c["start"].cast("bigint").alias("start"), standing.alias("standing"),
            F.size(t["words"]).alias("words"), t["base"].alias("base"),
        )

    return F.transform(F.filter(F.flatten(F.transform(hits, proposed)), stands), match)


def scan(docs: DataFrame, passed: tuple[str, ...] = ("doc_id",), templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """(passed columns, n_words, n_base, first_word, last_word, base_labels, labels, score,
    places) for every row of ``docs`` (text).

    Null and empty texts have no words and no labels. ``places`` lists all matches (label,
    start, words standing, template words). Overlapping matches all count. Repeated rows
    stay repeated; other columns are not read.
    """
    words = docs.select(*passed, words_of(F.col("text")).alias("w"))
    vocabulary = sorted({t.words[j] for t in templates for j in t.mandatory})
    frequency = document_frequency(words, vocabulary)
    anchors, postings, notices = _index(templates, frequency)
    looked_up = _constant(anchors)
    empty = F.array().cast("array<struct<w:string,at:int>>")
    hits = F.when(
        F.arrays_overlap("w", looked_up),
        F.filter(
            F.transform("w", lambda x, i: F.struct(x.alias("w"), i.alias("at"))), lambda h: h["w"].isin(anchors)
        ),
    ).otherwise(empty)
    cut = words.withColumn("__hits", hits)
    matches = _places(F.col("w"), F.col("__hits"), postings, notices)
    none = F.array().cast("array<struct<label:string,start:bigint,standing:int,words:int,base:boolean>>")
    found = cut.withColumn("places", F.when(F.size("__hits") > 0, matches).otherwise(none))
    base = F.filter("places", lambda p: p["base"])
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(F.transform(a, lambda p: p["label"]))), ",")
    starts = F.transform(base, lambda p: p["start"])
    share = F.transform("places", lambda p: p["standing"] / p["words"])
    return found.select(
        *passed, F.size("w").cast("bigint").alias("n_words"), F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"), joined(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(share), F.lit(0.0)).alias("score"), "places",
    )
