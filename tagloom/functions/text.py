"""Label normalization, splitting and cell parsing as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lists import INVALID_WORDS, QUERY_REPAIRS

_QUOTED = r"""(?s)^(['"])(.*)\1$"""


# Blanks that are stripped and squeezed, Unicode ones included.
_BLANKS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also where lambdas use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def pin(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that are computed once per row.

    A projection would be merged into what reads it: lambdas and pushed-down filters then
    evaluate a nested expression again and again. A one-row generator is never merged.
    """
    values = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.inline(F.array(values)))


def strip(c: Column) -> Column:
    """Drop blanks (Unicode ones too) at both ends."""
    return F.btrim(c, F.lit(_BLANKS))


def squeeze(c: Column) -> Column:
    return F.regexp_replace(F.translate(c, _BLANKS, " " * len(_BLANKS)), " {2,}", " ")


def separators_to_space(c: Column) -> Column:
    return F.translate(c, "_-/", "   ")


def split_camel(c: Column) -> Column:
    return F.regexp_replace(c, "([a-z])([A-Z])", "$1 $2")


def unquote(c: Column) -> Column:
    """Strip one pair of equal quotes around a stripped text of two characters or more."""
    return F.when(c.rlike(_QUOTED), strip(F.regexp_extract(c, _QUOTED, 2))).otherwise(c)


def normalize_label(c: Column, variant: str = "cluster") -> Column:
    """The four normal forms differ on purpose; see each branch.

    ``cluster``  null is '', words for "no label" are kept.
    ``mapper``   invalid words are '', lowered before the camel split (so never split).
    ``weekly``   invalid words are '', camel case split.
    ``loose``    one pair of quotes stripped, invalid words tested last; result null.
    """
    c = c.cast("string")
    if variant == "cluster":
        spaced = split_camel(separators_to_space(F.coalesce(c, F.lit(""))))
        return F.lower(strip(squeeze(spaced)))
    if variant == "loose":
        text = unquote(strip(c))
        norm = F.lower(strip(squeeze(split_camel(separators_to_space(text)))))
        return F.when((norm != "") & ~norm.isin(INVALID_WORDS), norm)
    text = strip(F.coalesce(c, F.lit("")))
    if variant == "mapper":
        blanked = F.translate(F.lower(text), "_-/" + _BLANKS, " " * (3 + len(_BLANKS)))
        norm = F.trim(F.regexp_replace(blanked, " {2,}", " "))
    elif variant == "weekly":
        norm = F.lower(strip(squeeze(split_camel(separators_to_space(text)))))
    else:
        raise ValueError(f"unknown normal form: {variant}")
    return F.when(F.lower(text).isin(INVALID_WORDS), F.lit("")).otherwise(norm)


def normalize_exact(c: Column) -> Column:
    return F.nullif(F.lower(unquote(strip(c.cast("string")))), F.lit(""))


def valid_label(c: Column) -> Column:
    """Not null and not one of '', nan, none, null after trim."""
    return c.isNotNull() & ~F.lower(strip(c)).isin("", "nan", "none", "null")


def family_token(c: Column) -> Column:
    """First word of the clustering normal form, null for a blank label."""
    return F.nullif(F.split(normalize_label(c, "cluster"), " ")[0], F.lit(""))


_PY_ITEM = r"""(?:'[^']*'|"[^"]*"|[-+0-9.eE]+)"""
_PY_LIST = rf"^(?:\[\s*(?:{_PY_ITEM}\s*(?:,\s*{_PY_ITEM}\s*)*,?\s*)?\]" \
           rf"|\(\s*{_PY_ITEM}\s*,\s*(?:{_PY_ITEM}\s*(?:,\s*{_PY_ITEM}\s*)*,?\s*)?\))$"


def _bracket_items(text: Column) -> Column:
    """Items of JSON or Python list text, null when the text is neither."""
    as_json = F.when(text.rlike(r"(?s)^\[.*\]$"), F.from_json(text, "array<string>"))
    as_python = F.when(
        text.rlike(_PY_LIST),
        F.transform(
            F.regexp_extract_all(text, F.lit(f"({_PY_ITEM})"), F.lit(1)),
            lambda x: F.regexp_replace(x, r"""^['"]|['"]$""", ""),
        ),
    )
    return F.coalesce(as_json, as_python)


def split_label_items(c: Column, is_array: bool = False) -> Column:
    """Trimmed items of a cell before the removal of repeats: array, JSON text,
    Python list text, else split at the first present separator of ``|``, ``;``, ``,``."""
    if is_array:
        items = c
    else:
        text = strip(c.cast("string"))
        by_separator = (
            F.when(text.contains("|"), F.split(text, r"\|"))
            .when(text.contains(";"), F.split(text, ";"))
            .when(text.contains(","), F.split(text, ","))
            .otherwise(F.array(text))
        )
        nothing = ["", "nan", "none", "null", "n/a", "na"]
        items = F.when(
            text.isNotNull() & ~F.lower(text).isin(nothing),
            F.coalesce(_bracket_items(text), by_separator),
        )
    empty = F.array().cast("array<string>")
    return F.transform(F.coalesce(items, empty), lambda x: strip(F.coalesce(x, F.lit(""))))


def distinct_labels(items: Column, norms: Column) -> Column:
    """Items with a normal form; of equal normal forms the first is kept.

    ``norms`` must be a materialized column: it is read once per item.
    """
    return F.filter(
        items,
        lambda x, i: (F.get(norms, i) != "") & (F.array_position(norms, F.get(norms, i)) == i + 1),
    )


def split_labels(c: Column, is_array: bool = False) -> Column:
    """Labels of one cell, without repeats of the mapper normal form."""
    return let(
        split_label_items(c, is_array),
        lambda items: let(
            F.transform(items, lambda x: normalize_label(x, "mapper")),
            lambda norms: distinct_labels(items, norms),
        ),
    )


_STAGE_INVALID = ["", *INVALID_WORDS]


def _keep_valid(items: Column) -> Column:
    return F.filter(
        F.transform(items, lambda x: strip(x)), lambda x: ~F.lower(x).isin(_STAGE_INVALID)
    )


def _bare(x: Column) -> Column:
    """Stripped, without the quotes at both ends; the patterns run only where there is a quote."""
    text = strip(x)
    unquoted = F.regexp_replace(F.regexp_replace(text, r'^"+|"+$', ""), r"^'+|'+$", "")
    return F.when(F.contains(x, F.lit('"')) | F.contains(x, F.lit("'")), unquoted).otherwise(text)


def parse_stage_text(text: Column, multi: Column) -> Column:
    """Labels of a stripped stage cell, which should be a column that exists: it is read many times."""
    empty = F.array().cast("array<string>")
    body = strip(F.regexp_extract(text, r"(?s)^\{(.*)\}$", 1))
    braces = F.when(body == "", empty).otherwise(
        F.filter(F.transform(F.split(body, ","), _bare), lambda x: x != "")
    )
    parts = F.transform(F.split(text, r"\s*(?:,|;|\|)\s*"), _bare)
    plain = F.when(multi, F.filter(parts, lambda x: ~F.lower(x).isin(_STAGE_INVALID))).otherwise(F.array(text))
    opens = F.substring(text, 1, 1)
    as_json = F.when((opens == "[") & text.endswith("]"), _keep_valid(F.from_json(text, "array<string>")))
    return (
        F.when(text.isNull() | F.lower(text).isin(_STAGE_INVALID), empty)
        .when(as_json.isNotNull(), as_json)
        .when((opens == "{") & text.endswith("}"), braces)
        .otherwise(plain)
    )


def parse_stage_labels(c: Column, multi: bool, is_array: bool = False) -> Column:
    """Labels of a stage cell, repeats kept; ``{}`` text keeps invalid words."""
    if is_array:
        return F.coalesce(_keep_valid(c), F.array().cast("array<string>"))
    return parse_stage_text(strip(c.cast("string")), F.lit(multi))


def assemble_stage_value(original: Column, mapped: Column, multi: bool) -> Column:
    """Text cell from mapped labels; an absent cell stays absent."""
    value = (
        F.array_join(mapped, ", ")
        if multi
        else F.when(F.size(mapped) > 0, F.get(mapped, F.lit(0))).otherwise(original)
    )
    return F.when(original.isNotNull(), value)


def row_changed(old: Column, new: Column) -> Column:
    """Trimmed texts differ, null counts as ''."""
    return strip(F.coalesce(old, F.lit(""))) != strip(F.coalesce(new, F.lit("")))


def parse_call_label(c: Column) -> Column:
    """``{a,"b"}`` text to struct(values, is_multi); other text is one value."""
    text = strip(c)
    items = F.filter(
        F.transform(
            F.split(F.regexp_extract(text, r"(?s)^\{(.*)\}$", 1), ","),
            lambda x: F.regexp_replace(strip(x), r'^"(.*)"$', "$1"),
        ),
        lambda x: x != "",
    )
    values = F.when(text.rlike(r"(?s)^\{.*\}$"), items).otherwise(F.array(text))
    return F.struct(values.alias("values"), (F.size(values) > 1).alias("is_multi"))


def safe_part(c: Column) -> Column:
    """File- and key-safe form of a text, at most 80 characters."""
    text = F.regexp_replace(c.cast("string"), "[^a-zA-Z0-9_.-]+", "_")
    cut = F.substring(F.regexp_replace(text, "^_+|_+$", ""), 1, 80)
    return F.when(cut != "", cut).otherwise(F.lit("value"))


def fix_query(c: Column, repairs: dict[str, str] = QUERY_REPAIRS) -> Column:
    """Spelling repairs on whole words, any case, then trim."""
    for wrong, right in repairs.items():
        c = F.regexp_replace(c, rf"(?i)\b{wrong}\b", right)
    return strip(c)
