"""Texts that are sent to the embedding model, and search texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .lists import (
    COACHING_PREFIXES, DEFAULT_DIRECTION, DEFAULT_MEANING, DEFAULT_POLARITY, DEFAULT_TIER,
    DIRECTION_WORDS, FIELD_MEANING, POLARITY_WORDS, TIER_WORDS,
)
from .text import normalize_label, squeeze, strip

_NORMAL_FORM = {"mapper": "mapper", "backfill": "loose", "cluster": "cluster"}


def _class_by_words(text: Column, classes: list, default: str) -> Column:
    def has(words: list) -> Column:
        return reduce(lambda a, b: a | b, [text.contains(w) for w in words])

    return reduce(
        lambda acc, item: F.when(has(item[1]), F.lit(item[0])).otherwise(acc),
        reversed(classes),
        F.lit(default),
    )


def _norm(c: Column, style: str) -> Column:
    return F.coalesce(normalize_label(c, _NORMAL_FORM[style]), F.lit(""))


def coaching_parts(label: Column) -> tuple[Column, Column, Column]:
    """Tier, skill and direction of a coaching label."""
    text = F.coalesce(label, F.lit(""))
    low = F.lower(text)
    prefix = "|".join(COACHING_PREFIXES)
    return (
        _class_by_words(low, TIER_WORDS, DEFAULT_TIER),
        F.regexp_replace(text, f"^(?:{prefix})", ""),
        _class_by_words(low, DIRECTION_WORDS, DEFAULT_DIRECTION),
    )


def coaching_text(label: Column, style: str = "mapper") -> Column:
    tier, skill, direction = coaching_parts(label)
    return F.concat(
        F.lit("tier: "), tier, F.lit(" | skill: "), skill,
        F.lit(" | direction: "), direction, F.lit(" | label: "), _norm(label, style),
    )


def next_step_polarity(label: Column) -> Column:
    low = F.lower(F.coalesce(label, F.lit("")))
    return _class_by_words(low, POLARITY_WORDS, DEFAULT_POLARITY)


def next_step_text(label: Column, style: str = "mapper") -> Column:
    return F.concat(
        F.lit("next_step_outcome: "), next_step_polarity(label),
        F.lit(" | label: "), _norm(label, style),
    )


def embedding_text(
    field: Column,
    label: Column,
    mode: str = "field_label",
    style: str = "mapper",
    definitions: dict[str, str] | None = None,
) -> Column:
    """Text to embed for a label of a field.

    ``style='cluster'`` writes a business definition instead of the short meaning; the
    caller passes its own definitions, a field without one falls back to the meaning.
    """
    if mode == "label_only":
        return _norm(label, style)
    if mode != "field_label":
        raise ValueError(f"unknown embedding text mode: {mode}")
    name = strip(F.coalesce(field, F.lit("")))
    meanings = dict(FIELD_MEANING)
    if style == "cluster":
        meanings.update(definitions or {})
        word = "business_definition"
    else:
        word = "meaning"
    lookup = F.create_map(*[F.lit(x) for pair in meanings.items() for x in pair])
    meaning = F.coalesce(F.try_element_at(lookup, name), F.lit(DEFAULT_MEANING))
    plain = F.concat(
        F.lit("field: "), name, F.lit(f"; {word}: "), meaning,
        F.lit("; label: "), _norm(label, style),
    )
    return (
        F.when(name == "coaching_tags", coaching_text(label, style))
        .when(name == "next_step", next_step_text(label, style))
        .otherwise(plain)
    )


def clean_label(c: Column) -> Column:
    """Array braces and quotes off, underscores to spaces."""
    text = strip(F.coalesce(c, F.lit("")))
    inner = F.array_join(
        F.filter(
            F.transform(
                F.split(F.regexp_extract(text, r"(?s)^\{(.*)\}$", 1), ","),
                lambda x: F.regexp_replace(strip(x), r'^"+|"+$', ""),
            ),
            lambda x: x != "",
        ),
        " ",
    )
    bare = F.when(text.rlike(r"(?s)^\{.*\}$"), inner).otherwise(
        F.regexp_replace(text, r'^"+|"+$', "")
    )
    return strip(squeeze(F.translate(bare, "_", " ")))


def search_document(
    raw: Column, norm: Column, display: Column, medoid: Column, field: Column
) -> Column:
    """One search text per label, parts that repeat the raw or normal form left out."""
    raw, norm, medoid = clean_label(raw), clean_label(norm), clean_label(medoid)
    display = strip(F.coalesce(display, F.lit("")))
    field = strip(F.translate(F.coalesce(field, F.lit("")), "_", " "))

    def part(value: Column, *others: Column) -> Column:
        keep = reduce(lambda a, b: a & b, [value != o for o in others], value != "")
        return F.when(keep, value)

    return F.concat_ws(
        " | ", part(raw), part(norm, raw), part(display, raw, norm), part(medoid, raw, norm),
        part(field),
    )
