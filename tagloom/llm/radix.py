"""Exact duplicates by distributed MSD radix partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..lineage import cut
from .common import small_side, text_of

#: Bytes of the first digit; each later digit has GROWTH times as many.
FIRST, GROWTH = 256, 16
#: Groups of the first digit that may be broadcast; beyond it the join shuffles.
FEW_GROUPS = 100_000


def normalised(docs: DataFrame):
    """The text with each run of ASCII white space as one space."""
    return F.regexp_replace(text_of(docs), r"[\x20\x09-\x0D]+", " ")


def exact_groups(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row.

    Documents are split by successive digits of their normalised text, most significant first. A digit is a stretch
    of bytes, longer from round to round, so that the longest text takes a number of rounds that grows with the logarithm of
    its length. After each round documents that are alone in their group are done, and groups whose texts ended are
    groups of equal texts; only the others go on. Keys are the bytes themselves: equal means equal bytes, no digest
    decides. A group is a key that is counted with map-side sums and joined back, so that no task holds a group.

    A null text is equal to the empty text. The smallest doc_id of a group stays, null only if the group has no other;
    of rows with this same doc_id one stays. An empty table gives no rows; further columns are ignored.
    """
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), normalised(docs).alias("norm"))
    rows = rows.select("doc_id", F.sha2("norm", 256).alias("text_sha256"), F.encode("norm", "UTF-8").alias("bytes"))

    def split(df: DataFrame, width: int) -> DataFrame:
        """The next digit, and what is left behind it."""
        return df.select(
            *(c for c in df.columns if c != "bytes"), F.substring("bytes", 1, width).alias("digit"),
            (F.octet_length("bytes") <= width).alias("ended"), F.substring("bytes", width + 1, (1 << 31) - 1).alias("bytes"))

    first = split(rows, FIRST)
    many = first.groupBy("digit", "ended").agg(F.count("*").alias("n")).filter("n > 1")
    many = cut(many.select("digit", "ended", F.lit(True).alias("many")))
    met = first.join(small_side(many, FEW_GROUPS), ["digit", "ended"], "left")
    alone = met.filter("many is null").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    width = FIRST
    now = cut(met.filter("many").select(
        "doc_id", "text_sha256", F.monotonically_increasing_id().alias("row"), F.lit(0).cast("long").alias("group"), "digit", "ended", "bytes"))
    out = alone
    keys = ["group", "digit", "ended"]
    while not now.isEmpty():
        least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
        groups = now.groupBy(*keys).agg(least, F.count("*").alias("n"))
        groups = cut(groups.select(*keys, F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("first_row"), "n"))
        over = (F.col("n") == 1) | F.col("ended")
        told = cut(now.join(groups, keys).select(
            "doc_id", "text_sha256", "row", "first_row", "keep_id", F.col("n").alias("group_size"), over.alias("over"),
            F.when(~over, F.col("bytes")).alias("bytes")))
        out = out.unionByName(told.filter("over").select(
            "doc_id", "keep_id", "group_size", (F.col("row") == F.col("first_row")).alias("kept"), "text_sha256"))
        width *= GROWTH
        now = split(told.filter("not over").select("doc_id", "text_sha256", "row", F.col("first_row").alias("group"), "bytes"), width)
    return out
