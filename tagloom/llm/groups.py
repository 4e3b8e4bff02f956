"""Groups of linked items, found from lists of items that share a key without comparing all pairs of a list.

Both similarity joins end in the same way: items (lines, sets of shingles) stand in lists, one list for each shared
key, and any two items that are linked stand in some list together. First each list's centre is compared with its other
members, which joins the large groups. After that only pairs of a list whose items are still apart are compared, the
minority of a list against all of it. No link between two groups is missed, and a group of copies with small changes
costs one comparison a member, not one a pair.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..lineage import cut
from ..operators.graph import connected_components



#: From what two rows of a list say about their items (structs ``mark``): in how many lists, this one among them, the
#: items must meet if they are linked; null if this meeting does not count.
Needs = Callable[[Column, Column], Column]


def _met(rows: DataFrame, x: str, y: str, x_mark: str, y_mark: str, needs: Needs) -> DataFrame:
    """(a, b), a < b, once each, of the pairs that meet often enough."""
    least = needs(F.col(x_mark), F.col(y_mark))
    met = rows.filter(least.isNotNull()).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"), least.alias("needs"))
    often = met.groupBy("a", "b").agg(F.count("*").alias("n"), F.min("needs").alias("needs"))
    return often.filter("n >= needs").select("a", "b")


def centre_pairs(lists: DataFrame, needs: Needs) -> DataFrame:
    """The centres of lists with their other members; ``lists``: id, mark, centre, centre_mark.

    What is left out, as only lists with this centre count, stays with the remaining pairs.
    """
    return _met(lists.filter(F.col("id") != F.col("centre")), "id", "centre", "mark", "centre_mark", needs)


def remaining_pairs(lists: DataFrame, labels: DataFrame, needs: Needs) -> DataFrame:
    """Pairs of a list whose labels differ.

    Lists of one label are left out. In the others the rows beside the list's most frequent label meet all rows of it, so
    that a large group in a list is met only by what does not belong to it.
    """
    known = labels.select(F.col("node").alias("id"), "component")
    now = cut(lists.select("key", "id", "mark").join(known, "id", "left").select(
        "key", "id", "mark", F.coalesce("component", "id").alias("label")))
    mixed = now.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").select("key")
    now = now.join(cut(mixed), "key")
    votes = now.groupBy("key", "label").agg(F.count("*").alias("n"))
    main = votes.groupBy("key").agg(F.max(F.struct("n", "label")).getField("label").alias("main"))
    now = cut(now.join(main, "key"))
    few = now.filter("label <> main").select("key", F.col("id").alias("x"), F.col("mark").alias("x_mark"), F.col("label").alias("x_label"))
    met = few.join(now, "key").filter("x_label <> label and (label = main or x < id)")
    return _met(met, "x", "id", "x_mark", "mark", needs)


def linked_groups(lists: DataFrame, needs: Needs, verify: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(node, component) of the items that have a link; a component is named by its least item.

    ``lists`` is a written table of (key, id, mark, centre, centre_mark), each (key, id) once; ``verify`` keeps the
    pairs (a, b) that are linked.
    """
    tried = cut(centre_pairs(lists, needs))
    links = cut(verify(tried))
    rest = remaining_pairs(lists, connected_components(links, "a", "b"), needs)
    rest = cut(rest.join(tried, ["a", "b"], "left_anti"))
    return connected_components(links.unionByName(cut(verify(rest))), "a", "b")
