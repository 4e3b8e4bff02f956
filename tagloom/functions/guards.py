"""Guards between a label and a cluster text.

Both guards are bit masks, computed once per text, so that a pair test is integer
arithmetic: no pair of texts is ever parsed together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lists import (
    ACTION_WORDS, AGENT_WORDS, CUSTOMER_PHRASES, CUSTOMER_WORDS, OPPOSITES, STOPWORDS,
)
from .text import normalize_label, pin

_N_OPP = len(OPPOSITES)
_N_ACT = len(ACTION_WORDS)


def token_set(c: Column) -> Column:
    """Distinct words of the weekly normal form, without stopwords and single letters."""
    words = F.split(normalize_label(c, "weekly"), " ")
    return F.array_distinct(
        F.filter(words, lambda w: (F.length(w) > 1) & ~w.isin(STOPWORDS))
    )


def _words(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _half_swap_hit(a: Column, b: Column, n: int) -> Column:
    low = (1 << n) - 1
    return (
        a.bitwiseAND(low).bitwiseAND(F.shiftright(b, n))
        .bitwiseOR(F.shiftright(a, n).bitwiseAND(b.bitwiseAND(low)))
        != 0
    )


def masks_contradict(a: Column, b: Column) -> Column:
    return _half_swap_hit(a, b, _N_OPP)


def with_masks(df: DataFrame, norm: str, opposite: str, actor: str) -> DataFrame:
    """Add both masks of a normalized text column.

    The opposite mask has bit i when the text contains the left word of pair i, and bit
    10 + i for the right word.

    The actor mask tells who acts on whom. Bits 0-2: the agent acts on the customer (rude,
    hangs up, refuses); bits 3-5: the customer acts on the agent. Two actors of different
    kind within ten tokens form a relation; its classes come from the words between them,
    else from up to three words after; the earlier actor acts on the later one, reversed
    when ``by`` lies between.
    """
    phrases = " OR ".join(
        f"(w = '{first}' AND get(_tokens, i + 1) = '{second}')" for first, second in CUSTOMER_PHRASES
    )
    kinds = (
        f"transform(_tokens, (w, i) -> CASE WHEN w IN ({_words(AGENT_WORDS)}) THEN 1 "
        f"WHEN w IN ({_words(CUSTOMER_WORDS)}) OR coalesce({phrases}, false) THEN 2 ELSE 0 END)"
    )
    classes = " ".join(
        f"WHEN w IN ({_words(words)}) THEN {1 << n}" for n, words in enumerate(ACTION_WORDS.values())
    )
    # Actors follow each other in place order, so partners are the next ones in the list.
    relation = f"""
        transform(array(aggregate(slice(_acts, i + 1, j - i + 1), 0, (x, y) -> x | y)), between ->
          transform(array(CASE WHEN between <> 0 THEN between
              ELSE aggregate(slice(_acts, i + 1, j - i + 4), 0, (x, y) -> x | y) END), c ->
            CASE WHEN (CASE WHEN array_contains(slice(_tokens, i + 1, j - i + 1), 'by')
                THEN get(_kinds, j) ELSE get(_kinds, i) END) = 1
              THEN c ELSE shiftleft(c, {_N_ACT}) END)[0])[0]"""
    relations = f"""
        aggregate(transform(_places, (i, n) -> aggregate(
          filter(slice(_places, n + 2, 10), j -> j - i <= 10 AND get(_kinds, j) <> get(_kinds, i)),
          0, (acc, j) -> acc | {relation})), 0, (x, y) -> x | y)"""
    opposites = " + ".join(
        f"CASE WHEN contains(_text, '{word}') THEN {1 << (side * _N_OPP + n)} ELSE 0 END"
        for n, pair in enumerate(OPPOSITES)
        for side, word in enumerate(pair)
    )
    df = pin(df, {"_text": F.coalesce(F.col(norm), F.lit(""))})
    df = pin(df, {"_tokens": F.split("_text", " ")})
    df = pin(df, {
        "_kinds": F.expr(kinds),
        "_acts": F.expr(f"transform(_tokens, w -> CASE {classes} ELSE 0 END)"),
    })
    df = pin(df, {"_places": F.expr("filter(sequence(0, size(_tokens) - 1), i -> get(_kinds, i) > 0)")})
    both = "array_contains(_kinds, 1) AND array_contains(_kinds, 2)"
    masks = {actor: F.expr(f"CASE WHEN {both} THEN {relations} ELSE 0 END"), opposite: F.expr(opposites)}
    return pin(df, masks).drop("_text", "_tokens", "_kinds", "_acts", "_places")


def masks_conflict(a: Column, b: Column) -> Column:
    """Same action class with the two sides swapped."""
    return _half_swap_hit(a, b, _N_ACT)


def actor_relations(mask: Column) -> Column:
    """Readable relations of a mask, for evidence columns."""
    sides = [("agent", "customer"), ("customer", "agent")]
    found = [
        F.when(
            mask.bitwiseAND(1 << (s * _N_ACT + a)) != 0, F.lit(f"{doer}>{target}:{name}")
        )
        for s, (doer, target) in enumerate(sides)
        for a, name in enumerate(ACTION_WORDS)
    ]
    return F.array_compact(F.array(*found))
