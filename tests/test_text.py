"""Text rules against hand-derived expectations."""

import pytest
from pyspark.sql import functions as F

from tagloom.functions import guards, names, text
from tagloom.functions.embedtext import coaching_text, embedding_text, next_step_text


def one(spark, value, expr, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(expr(F.col("x")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "raw, cluster, mapper, weekly, loose",
    [
        (None, "", "", "", None),
        ("  ", "", "", "", None),
        ("Info_Sent", "info sent", "info sent", "info sent", "info sent"),
        ("infoSentNow", "info sent now", "infosentnow", "info sent now", "info sent now"),
        ("N/A", "n a", "", "", "n a"),
        ("unknown", "unknown", "", "", None),
        ("'Quoted'", "'quoted'", "'quoted'", "'quoted'", "quoted"),
        (" Call-Back /x ", "call back x", "call back x", "call back x", "call back x"),
        ("ALLCAPS", "allcaps", "allcaps", "allcaps", "allcaps"),
    ],
)
def test_normal_forms(spark, raw, cluster, mapper, weekly, loose):
    for variant, want in (("cluster", cluster), ("mapper", mapper), ("weekly", weekly), ("loose", loose)):
        assert one(spark, raw, lambda c, v=variant: text.normalize_label(c, v)) == want, variant


def test_exact_form_and_quotes(spark):
    assert one(spark, ' "A b" ', text.normalize_exact) == "a b"
    assert one(spark, '"', text.normalize_exact) == '"'
    assert one(spark, '""', text.normalize_exact) is None


@pytest.mark.parametrize(
    "cell, want",
    [
        (None, []),
        ("nan", []),
        ('["a","B_c","A"]', ["a", "B_c"]),
        ("('x','y')", ["x", "y"]),
        ("['one']", ["one"]),
        ("a|b;c", ["a", "b;c"]),
        ("a;b,c", ["a", "b,c"]),
        ("a, b ,,a, n/a", ["a", "b"]),
        ("[broken", ["[broken"]),
    ],
)
def test_split_labels(spark, cell, want):
    assert one(spark, cell, text.split_labels) == want


def test_split_array_cell(spark):
    assert one(spark, ["A_b", "a b", None, " c "], lambda c: text.split_labels(c, True), "array<string>") == ["A_b", "c"]


@pytest.mark.parametrize(
    "cell, multi, want",
    [
        ('{a,"b",none}', True, ["a", "b", "none"]),
        ("{}", True, []),
        ('["a", " null "]', True, ["a"]),
        ("a, b; c | a", True, ["a", "b", "c", "a"]),
        ("a, b", False, ["a, b"]),
        ("none", False, []),
    ],
)
def test_stage_labels(spark, cell, multi, want):
    assert one(spark, cell, lambda c: text.parse_stage_labels(c, multi)) == want


def test_embedding_texts(spark):
    assert one(spark, "DM_Name_Secured", next_step_text) == "next_step_outcome: HOLDING_PATTERN | label: dm name secured"
    got = one(spark, "Coaching_Unclear_Pitch", coaching_text)
    assert got == "tier: AGENT_SKILL | skill: Pitch | direction: STRENGTH_DEMONSTRATED | label: coaching unclear pitch"
    plain = one(spark, "Rate_Query", lambda c: embedding_text(F.lit("tone"), c))
    assert plain == "field: tone; meaning: customer tone or sentiment; label: rate query"
    assert one(spark, "x", lambda c: embedding_text(F.lit("odd"), c)) == "field: odd; meaning: call classification field; label: x"
    own = one(spark, "x", lambda c: embedding_text(F.lit("tone"), c, style="cluster", definitions={"tone": "mood"}))
    assert own == "field: tone; business_definition: mood; label: x"
    with pytest.raises(ValueError):
        embedding_text(F.lit("a"), F.lit("b"), mode="other")


@pytest.mark.parametrize(
    "raw, want",
    [
        ("{Discovery,Admin Routing}", "Discovery Admin Routing"),
        ("loa chase 3cx 12ab", "LOA Chase 3CX 12AB"),
        ("Rates anomaly review 00456c", "Rates"),
        ("first\nsecond", "First"),
        ("one two three four five six seven", "One Two Three Four Five Six"),
        ("--", ""),
    ],
)
def test_sanitize_name(spark, raw, want):
    assert one(spark, raw, names.sanitize_name) == want


def test_adjacent_repeat(spark):
    assert one(spark, "Call call back", names.adjacent_repeat) is True
    assert one(spark, "call back call", names.adjacent_repeat) is False


@pytest.mark.parametrize(
    "raw, want",
    [
        ("agent yelled at customer", 1),
        ("customer insulted by agent", 1),
        ("customer insulted agent", 8),
        ("client hung up on advisor", 16),
        ("agent customer abuse", 1),
        ("decision maker refused rep", 32),
        ("agent a b c d e f g h i j k customer rude", 0),
        ("agent called", 0),
    ],
)
def test_actor_masks(spark, raw, want):
    df = guards.with_masks(spark.createDataFrame([(raw,)], "n string"), "n", "opp", "act")
    assert df.first()["act"] == want


def test_contradiction_is_a_substring_test(spark):
    df = spark.createDataFrame([("unclear pitch", "unclear"), ("callback", "do not call"), ("a", "b")], "a string, b string")
    df = guards.with_masks(df, "a", "oa", "aa")
    df = guards.with_masks(df, "b", "ob", "ab")
    got = [r["c"] for r in df.orderBy("a").select(guards.masks_contradict(F.col("oa"), F.col("ob")).alias("c")).collect()]
    assert got == [False, True, True]
