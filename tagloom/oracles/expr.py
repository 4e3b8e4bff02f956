"""SQL expressions of the text rules, written apart from the Spark ones."""

from __future__ import annotations

from ..functions import lists as L


def quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def spaced(x: str) -> str:
    return f"translate({x}, '_-/', '   ')"


def camel(x: str) -> str:
    return rf"regexp_replace({x}, '([a-z])([A-Z])', '\1 \2', 'g')"


def squeeze(x: str) -> str:
    return rf"regexp_replace({x}, '\s+', ' ', 'g')"


def unquote(x: str) -> str:
    t = strip(x)
    return (
        f"CASE WHEN length({t}) >= 2 AND left({t}, 1) = right({t}, 1) AND left({t}, 1) IN ('''', '\"') "
        f"THEN {strip(f'substr({t}, 2, length({t}) - 2)')} ELSE {t} END"
    )


def norm_cluster(x: str) -> str:
    given = f"coalesce({x}, '')"
    return f"lower({strip(squeeze(camel(spaced(given))))})"


def norm_mapper(x: str) -> str:
    return (
        f"CASE WHEN {x} IS NULL OR lower({strip(x)}) IN ({quoted(L.INVALID_WORDS)}) THEN '' "
        f"ELSE {strip(squeeze(spaced(f'lower({strip(x)})')))} END"
    )


def norm_weekly(x: str) -> str:
    return (
        f"CASE WHEN {x} IS NULL OR lower({strip(x)}) IN ({quoted(L.INVALID_WORDS)}) THEN '' "
        f"ELSE lower({strip(squeeze(camel(spaced(strip(x)))))}) END"
    )


def norm_loose(x: str) -> str:
    n = f"lower({strip(squeeze(camel(spaced(f'({unquote(x)})'))))})"
    return f"CASE WHEN {n} IN ('', {quoted(L.INVALID_WORDS)}) THEN NULL ELSE {n} END"


def norm_exact(x: str) -> str:
    return f"nullif(lower({unquote(x)}), '')"


def any_word(x: str, words) -> str:
    return "(" + " OR ".join(f"contains({x}, '{w}')" for w in words) + ")"


def classes(x: str, rules, default: str) -> str:
    whens = " ".join(f"WHEN {any_word(x, words)} THEN '{name}'" for name, words in rules)
    return f"CASE {whens} ELSE '{default}' END"


def embedding_text(field: str, raw: str, norm: str, word: str = "meaning") -> str:
    low = f"lower({raw})"
    skill = f"regexp_replace({raw}, '^({'|'.join(L.COACHING_PREFIXES)})', '')"
    meaning = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in L.FIELD_MEANING.items())
    return f"""CASE WHEN {field} = 'coaching_tags' THEN
        'tier: ' || {classes(low, L.TIER_WORDS, L.DEFAULT_TIER)} || ' | skill: ' || {skill}
        || ' | direction: ' || {classes(low, L.DIRECTION_WORDS, L.DEFAULT_DIRECTION)}
        || ' | label: ' || {norm}
      WHEN {field} = 'next_step' THEN
        'next_step_outcome: ' || {classes(low, L.POLARITY_WORDS, L.DEFAULT_POLARITY)}
        || ' | label: ' || {norm}
      ELSE 'field: ' || {field} || '; {word}: ' ||
        CASE {field} {meaning} ELSE '{L.DEFAULT_MEANING}' END || '; label: ' || {norm} END"""


def display_name(norm: str, acronyms, max_words: int = 6) -> str:
    words = f"list_filter(string_split({norm}, ' '), lambda w: w <> '')[1:{max_words}]"
    return f"""CASE WHEN len({words}) = 0 THEN 'Unknown' ELSE array_to_string(list_transform({words},
        lambda w: CASE WHEN w IN ({quoted(acronyms)}) OR regexp_full_match(w, '\\d+[a-z]*')
          THEN upper(w) ELSE upper(w[1]) || lower(w[2:]) END), ' ') END"""


def sanitize(x: str, acronyms, max_words: int = 6) -> str:
    t = rf"regexp_extract({strip(f'coalesce({x}, chr(32))')}, '^[^\r\n]*')"
    t = rf"regexp_replace({t}, '[{{}}\[\]()]', ' ', 'g')"
    t = f"regexp_replace({t}, '[_|,;:]+', ' ', 'g')"
    t = camel(f"translate({t}, '-/', '  ')")
    t = rf"regexp_replace({t}, '(?i)\b[0-9a-f]{{5,}}\b$', '')"
    t = rf"regexp_replace({t}, '(?i)\b[a-z]{{1,8}}[0-9a-f]{{4,}}\b$', '')"
    t = rf"regexp_replace({t}, '(?i)\banomaly\s+review\b', ' ', 'g')"
    t = f"""trim({t}, '"''` .,:;|-_')"""
    t = strip(squeeze(f"regexp_replace({t}, '[^A-Za-z0-9 &+]', ' ', 'g')"))
    words = f"list_filter(string_split({t}, ' '), lambda w: w <> '')[1:{max_words}]"
    return f"""coalesce(array_to_string(list_transform({words}, lambda w:
        CASE WHEN lower(w) IN ({quoted(acronyms)}) OR regexp_full_match(lower(w), '\\d+[a-z]*') THEN upper(w)
          WHEN regexp_matches(w, '[A-Z]') AND NOT regexp_matches(w, '[a-z]') AND length(w) <= 5 THEN w
          ELSE upper(w[1]) || lower(w[2:]) END), ' '), '')"""


def name_key(x: str) -> str:
    return strip(squeeze(rf"regexp_replace({spaced(f'lower({strip(x)})')}, '[^a-z0-9\s]', '', 'g')"))


def opposite_mask(norm: str) -> str:
    n = len(L.OPPOSITES)
    bits = [
        f"CASE WHEN contains({norm}, '{w}') THEN {1 << (side * n + i)} ELSE 0 END"
        for i, pair in enumerate(L.OPPOSITES)
        for side, w in enumerate(pair)
    ]
    return "(" + " + ".join(bits) + ")"


def swap_hit(a: str, b: str, n: int) -> str:
    low = (1 << n) - 1
    return f"((({a} & {low}) & ({b} >> {n})) | (({a} >> {n}) & ({b} & {low}))) <> 0"


def actor_steps(source: str, norm: str, prefix: str) -> dict[str, str]:
    """CTEs that give ``{prefix}_mask(norm, mask)`` for the distinct texts of a source."""
    agents, customers = quoted(L.AGENT_WORDS), quoted(L.CUSTOMER_WORDS)
    phrases = " OR ".join(f"(x = '{a}' AND t[i + 1] = '{b}')" for a, b in L.CUSTOMER_PHRASES)
    acts = " ".join(
        f"WHEN x IN ({quoted(words)}) THEN {1 << i}" for i, words in enumerate(L.ACTION_WORDS.values())
    )
    return {
        f"{prefix}_tok": f"""
            SELECT n, t,
              list_transform(t, lambda x, i: CASE WHEN x IN ({agents}) THEN 1
                WHEN x IN ({customers}) OR coalesce({phrases}, false) THEN 2 ELSE 0 END) AS kinds,
              list_transform(t, lambda x: CASE {acts} ELSE 0 END) AS acts
            FROM (SELECT DISTINCT {norm} AS n, string_split({norm}, ' ') AS t FROM {source})""",
        f"{prefix}_act": f"""
            SELECT n, t, acts, unnest(kinds) AS kind, generate_subscripts(kinds, 1) AS i
            FROM {prefix}_tok""",
        f"{prefix}_pair": f"""
            SELECT a.n, a.t, a.acts, a.i, b.i AS j, a.kind AS first_kind
            FROM {prefix}_act a JOIN {prefix}_act b ON a.n = b.n AND a.i < b.i AND b.i - a.i <= 10
            WHERE a.kind > 0 AND b.kind > 0 AND a.kind <> b.kind""",
        f"{prefix}_rel": f"""
            SELECT n, CASE WHEN (first_kind = 1) <> list_contains(t[i:j], 'by') THEN c ELSE c << 3 END AS m
            FROM (SELECT *, CASE WHEN list_aggregate(acts[i:j], 'bit_or') <> 0
                    THEN list_aggregate(acts[i:j], 'bit_or')
                    ELSE list_aggregate(acts[i:j + 3], 'bit_or') END AS c FROM {prefix}_pair)""",
        f"{prefix}_mask": f"""
            SELECT x.n AS norm, cast(coalesce(bit_or(r.m), 0) AS INT) AS mask
            FROM (SELECT DISTINCT n FROM {prefix}_tok) x LEFT JOIN {prefix}_rel r ON r.n = x.n GROUP BY x.n""",
    }


def call_label_steps(fields, source: str = "fx_calls") -> dict[str, str]:
    """CTEs that give ``call_labels(id, created_at, field_name, pos, raw_label, normalized_label)``."""
    names = quoted(fields)
    cells = ", ".join(fields)
    return {
        "cells": f"""
            SELECT id, created_at, unnest([{names}]) AS field_name, unnest([{cells}]) AS cell FROM {source}""",
        "items": r"""
            SELECT id, created_at, field_name, unnest(l) AS item, generate_subscripts(l, 1) AS pos FROM (
              SELECT *, CASE WHEN cell IS NULL OR lower(trim(cell)) IN ('', 'nan', 'none', 'null', 'n/a', 'na') THEN []
                WHEN regexp_matches(cell, '^\[.*\]$|^\(.*,.*\)$') THEN regexp_extract_all(cell, '["'']([^"'']*)["'']', 1)
                WHEN contains(cell, '|') THEN string_split(cell, '|')
                WHEN contains(cell, ';') THEN string_split(cell, ';')
                WHEN contains(cell, ',') THEN string_split(cell, ',')
                ELSE [cell] END AS l FROM cells)""",
        "call_labels": f"""
            SELECT * FROM (SELECT id, created_at, field_name, pos, trim(item) AS raw_label,
              {norm_mapper('item')} AS normalized_label FROM items) WHERE normalized_label <> ''
            QUALIFY row_number() OVER (PARTITION BY id, field_name, normalized_label ORDER BY pos) = 1""",
    }


CALL_FIELDS = [
    "call_type", "outcome", "outcome_sub", "main_reason", "additional_tags", "next_step",
    "descriptive_keywords", "coaching_tags",
]


def call_labels() -> dict[str, str]:
    return call_label_steps(CALL_FIELDS)


def label_facts() -> dict[str, str]:
    return call_labels() | {
        "label_facts": "SELECT field_name, raw_label, count(*) AS value_count FROM call_labels GROUP BY ALL"
    }
