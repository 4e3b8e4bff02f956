"""Display names: building, cleaning, keys and validation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .lists import ACRONYMS_BACKFILL, ACRONYMS_WEEKLY, GENERIC_NAMES, WEAK_MEDOIDS
from .text import normalize_label, separators_to_space, split_camel, squeeze, strip

_ACRONYMS = {"weekly": ACRONYMS_WEEKLY, "backfill": ACRONYMS_BACKFILL}


def _capital(word: Column) -> Column:
    return F.concat(F.upper(F.substring(word, 1, 1)), F.lower(F.substring(word, 2, 1 << 20)))


def _words(text: Column, max_words: int) -> Column:
    return F.slice(F.filter(F.split(text, " "), lambda w: w != ""), 1, max_words)


def display_name(c: Column, max_words: int = 6, job: str = "weekly") -> Column:
    """Title form of the first words of a label; ``Unknown`` for an empty one."""
    variant = "weekly" if job == "weekly" else "loose"
    words = _words(F.coalesce(normalize_label(c, variant), F.lit("")), max_words)
    titled = F.transform(
        words,
        lambda w: F.when(w.isin(_ACRONYMS[job]) | w.rlike(r"^\d+[a-z]*$"), F.upper(w)).otherwise(
            _capital(w)
        ),
    )
    return F.when(F.size(words) > 0, F.array_join(titled, " ")).otherwise(F.lit("Unknown"))


def sanitize_name(c: Column, max_words: int = 6, job: str = "weekly") -> Column:
    """Clean a proposed name: first line, no wrappers, no trailing hash tokens."""
    text = F.regexp_extract(strip(F.coalesce(c.cast("string"), F.lit(""))), r"^[^\r\n]*", 0)
    text = F.regexp_replace(text, r"[{}\[\]()]", " ")
    text = F.regexp_replace(text, "[_|,;:]+", " ")
    text = split_camel(F.translate(text, "-/", "  "))
    text = F.regexp_replace(text, r"(?i)\b[0-9a-f]{5,}\b$", "")
    text = F.regexp_replace(text, r"(?i)\b[a-z]{1,8}[0-9a-f]{4,}\b$", "")
    text = F.regexp_replace(text, r"(?i)\banomaly\s+review\b", " ")
    text = F.regexp_replace(text, r"""^["'` .,:;|_-]+|["'` .,:;|_-]+$""", "")
    text = strip(squeeze(F.regexp_replace(text, "[^A-Za-z0-9 &+]", " ")))
    titled = F.transform(
        _words(text, max_words),
        lambda w: F.when(
            F.lower(w).isin(_ACRONYMS[job]) | F.lower(w).rlike(r"^\d+[a-z]*$"), F.upper(w)
        )
        .when(w.rlike("[A-Z]") & ~w.rlike("[a-z]") & (F.length(w) <= 5), w)
        .otherwise(_capital(w)),
    )
    return F.array_join(titled, " ")


def name_key(c: Column) -> Column:
    """Comparable form of a display name."""
    text = separators_to_space(F.lower(strip(F.coalesce(c.cast("string"), F.lit("")))))
    return strip(squeeze(F.regexp_replace(text, r"[^a-z0-9\s]", "")))


def adjacent_repeat(c: Column) -> Column:
    """Some word equals the one before it, case aside."""
    words = F.split(F.lower(strip(squeeze(F.coalesce(c, F.lit(""))))), " ")
    following = F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))
    same = F.zip_with(words, following, lambda a, b: (a == b) & (a != ""))
    return F.coalesce(F.exists(same, lambda x: x), F.lit(False))


def name_notes(c: Column, exists: Column, rejected: Column | None = None) -> Column:
    """Validation notes; ``exists`` / ``rejected`` tell whether the key is already taken."""
    clean = sanitize_name(c)
    notes = F.array_compact(
        F.array(
            F.when(exists, F.lit("existing_name_conflict")),
            F.when(
                F.lit(False) if rejected is None else rejected,
                F.lit("duplicate_against_rejected_name"),
            ),
            F.when(adjacent_repeat(clean), F.lit("adjacent_repeated_words")),
        )
    )
    return F.when(clean == "", F.array(F.lit("blank_name"))).otherwise(notes)


def generic_name(c: Column, max_length: int = 4) -> Column:
    return c.isNotNull() & ((F.length(c) <= max_length) | F.lower(c).isin(GENERIC_NAMES))


def weak_medoid(c: Column) -> Column:
    """No medoid, a filler word, two characters or fewer, or a number."""
    text = F.lower(strip(c))
    weak = text.isin(WEAK_MEDOIDS) | (F.length(text) <= 2) | text.rlike(r"^\d+(\.\d+)?$")
    return F.coalesce(weak, F.lit(True))
