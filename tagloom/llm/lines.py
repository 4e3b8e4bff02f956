"""Line dedup: an edit-distance join of lines by segments, in DataFrame expressions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import pin
from ..lineage import cut
from ..skew import join_one
from .common import small_side, text_of
from .groups import linked_groups

#: Lines at most so many edits apart are copies.
EDITS = 2
#: From so many code points on, lines need not be equal.
NEAR = 20
#: A line of these characters alone is blank.
BLANKS = " \t\x0b\x0c\r"
#: Classes of characters that a line's profile counts.
CLASSES = 16


def probes(edits: int) -> list[tuple[int, int, int]]:
    """(segment, how much longer the probing line is, shift): the substrings by which a line can meet an index.

    If a line becomes another one by at most ``edits`` edits, some segment stands whole in it, moved by no more than
    the edits before it and no more than those behind it allow.
    """
    return [
        (i, extra, shift) for i in range(edits + 1) for extra in range(edits + 1)
        for shift in range(max(-i, extra - (edits - i)), min(i, extra + edits - i) + 1)
    ]


def with_substrings(lines: DataFrame, edits: int, near: int) -> DataFrame:
    """A row (key, indexed, id) for each of a line's own segments and for each substring that probes for others.

    A line has edits + 1 even segments, the last ones longer by a character if need be. The key is a hash of the other
    line's length, the segment's number and the substring; lengths shorter than ``near`` have no segments. Four bytes a
    character let a substring be taken without counting characters from the line's start.
    """
    parts, rows = edits + 1, lines.withColumn("line", F.encode("line", "UTF-32"))
    for extra in range(edits + 1):
        other = F.col("length") - extra
        rows = rows.withColumns({f"_even{extra}": F.floor(other / parts).cast("int"), f"_long{extra}": (other % parts).cast("int")})
    found = []
    for i, extra, shift in probes(edits):
        even, longer, other = F.col(f"_even{extra}"), F.col(f"_long{extra}"), F.col("length") - extra
        start = even * i + F.greatest(F.lit(0), longer + (i - parts)) + shift
        width = even + F.when(longer >= parts - i, 1).otherwise(0)
        key = F.xxhash64(other, F.lit(i), F.substring("line", start * 4 + 1, width * 4))
        found.append(F.struct(F.when(other >= near, key).alias("key"), F.lit(extra == 0 and shift == 0).alias("indexed")))
    rows = rows.select("id", F.explode(F.array(*found)).alias("s"))
    return rows.select("s.key", "s.indexed", "id").filter("key is not null")


def within_edits(a: Column, b: Column, edits: int) -> Column:
    """Whether two lines are at most ``edits`` apart: an automaton of 2 * edits + 1 diagonals, a bit each.

    Bit k of word d is set when the first j + k - edits characters of ``a`` become the first j of ``b`` with at most d edits. A
    character of ``b`` moves all diagonals at once: matches stay, substitutions stay with an error more, insertions
    and deletions shift by one.
    """
    band, full = 2 * edits + 1, (1 << (2 * edits + 1)) - 1

    def moved(acc: Column) -> list[Column]:
        """The words after the character whose matches are in ``m``."""
        words = [acc["r0"].bitwiseAND(acc["m"])]
        for d in range(1, edits + 1):
            fewer = acc[f"r{d - 1}"]
            word = acc[f"r{d}"].bitwiseAND(acc["m"]).bitwiseOR(fewer).bitwiseOR(F.shiftright(fewer, 1))
            words.append(word.bitwiseOR(F.shiftleft(words[-1], 1)).bitwiseAND(F.lit(full)))
        return words

    def step(acc: Column, char: Column) -> Column:
        """Move by the character before and note where this one matches, so that each expression is evaluated once."""
        hits = [F.when(F.get(acc["chars"], acc["j"] + (k - edits)) == char, 1 << k).otherwise(0) for k in range(band)]
        words = [F.when(acc["j"] == 0, acc[f"r{d}"]).otherwise(w) for d, w in enumerate(moved(acc))]
        return F.struct(
            acc["chars"].alias("chars"), (acc["j"] + 1).alias("j"), reduce(lambda x, y: x.bitwiseOR(y), hits).alias("m"),
            *(w.alias(f"r{d}") for d, w in enumerate(words)))

    def codes(text: Column) -> Column:
        return F.transform(F.split(text, ""), F.ascii)

    last = F.char_length(a) - F.char_length(b) + edits
    start = [F.lit(sum(1 << (edits + k) for k in range(d + 1))).alias(f"r{d}") for d in range(edits + 1)]
    first = F.struct(codes(a).alias("chars"), F.lit(0).alias("j"), F.lit(0).alias("m"), *start)
    word = F.aggregate(codes(b), first, step, lambda acc: moved(acc)[edits])
    return last.between(0, band - 1) & (F.call_function("shiftright", word, last).bitwiseAND(F.lit(1)) == 1)


def second_hash(line: str) -> Column:
    """A hash independent of a line's id, as the first column seeds it; both together are 128 bits."""
    return F.xxhash64(F.lit("line"), F.col(line))


def line_rows(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, line_no, line, id, length of the lines that are not blank."""
    rows = docs.select(docs["doc_id"].alias("doc_id"), text_of(docs).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    rows = rows.withColumn("line", F.trim("line")).withColumn("length", F.char_length("line"))
    # Most lines show by their first character that they are not blank.
    filled = (F.ascii("line") > 32) | (F.btrim("line", F.lit(BLANKS)) != "")
    return rows.filter(filled).withColumn("id", F.xxhash64("line"))


def shared_segments(lines: DataFrame, edits: int, near: int) -> DataFrame:
    """(key, id, centre) of the substrings that two lines or more share; a written table.

    A first pass keeps, with map-side minima, only the least and the largest line of a key; a second one lists the lines of
    the keys where these differ. So the many keys of a single line are shuffled once, and copies of a line meet before.
    """
    rows = with_substrings(lines.filter(F.col("length") >= near).select("line", "length", "id"), edits, near)
    ends = rows.groupBy("key").agg(
        F.min("id").alias("centre"), F.max("id").alias("other"), F.max("indexed").alias("indexed"))
    shared = cut(ends.filter("centre < other and indexed").select("key", "centre"))
    return cut(rows.select("key", "id").join(small_side(shared), "key").distinct())


def profile(line: Column, length: Column) -> Column:
    """Length and counts of CLASSES classes of characters.

    A substitution changes the counts by two in all, an insertion or deletion by one, and the length by one.
    """
    counts = []
    for k in range(CLASSES):
        members = "".join(chr(c) for c in range(32, 1280) if c % CLASSES == k)
        counts.append((length - F.char_length(F.translate(line, members, ""))).cast("int").alias(f"c{k}"))
    return F.struct(length.cast("int").alias("length"), *counts)


def line_groups(lines: DataFrame, edits: int = EDITS, near: int = NEAR) -> DataFrame:
    """(id, check, component): the lines within ``edits`` of another line, directly or over others.

    Lines that share a substring are compared by their profiles where they meet, and by their characters only if these
    allow a link.
    """
    lists = shared_segments(lines, edits, near)
    wanted = small_side(cut(lists.select("id").distinct()))
    texts = lines.select("id", "line", "length").join(wanted, "id", "left_semi").groupBy("id").agg(F.min("line").alias("line"))
    texts = cut(texts.withColumns({"profile": profile(F.col("line"), F.char_length("line")), "check": second_hash("line")}))
    own = texts.select("id", F.col("profile").alias("mark"))
    centre = texts.select(F.col("id").alias("centre"), F.col("profile").alias("centre_mark"))
    lists = cut(lists.select("key", "id", "centre").join(own, "id").join(centre, "centre"))

    def needs(a: Column, b: Column) -> Column:
        apart = reduce(lambda x, y: x + y, [F.abs(a[f"c{k}"] - b[f"c{k}"]) for k in range(CLASSES)])
        longer = F.abs(a["length"] - b["length"])
        return F.when((longer <= edits) & (apart <= 2 * edits - longer), 1)

    def verify(pairs: DataFrame) -> DataFrame:
        left = texts.select(F.col("id").alias("a"), F.col("line").alias("x"))
        right = texts.select(F.col("id").alias("b"), F.col("line").alias("y"))
        return pairs.join(left, "a").join(right, "b").filter(within_edits(F.col("x"), F.col("y"), edits)).select("a", "b")

    groups = linked_groups(lists, needs, verify).select(F.col("node").alias("id"), "component")
    return groups.join(texts.select("id", "check"), "id")


def dedup_lines(docs: DataFrame, edits: int = EDITS, near: int = NEAR) -> DataFrame:
    """(doc, n_lines, n_dropped) of every row: ``doc`` holds all columns of the row, repeated lines taken out of ``text``.

    Lines are the parts between line feeds, without spaces at their ends. Lines of ``near`` code points or more are linked
    when an edit distance of ``edits`` or less lies between them, shorter ones when equal; the links' connected components are groups.
    Of a group the first line stays, by doc_id, hash of the text and line number; the others go, in the same
    document too. Blank lines always stay.

    A null text stays null and has no lines; an empty text has one line, which stays. Documents whose lines all go have an
    empty text. Rows that are repeated as a whole count as one and share its fate; a null doc_id comes last in order. Ties
    cannot occur otherwise. Lines are equal when two independent 64-bit hashes are; of lines that share the first one alone
    the least stands for it in the search for near lines, the others are copies of their equals only. A long text is split
    within its row, so it takes memory in proportion to its length. An empty table gives no rows.
    """
    lines = line_rows(docs)
    labels = small_side(cut(line_groups(lines, edits, near)))
    at = lines.select("doc_id", "text_hash", "line_no", "id", second_hash("line").alias("check")).join(labels, ["id", "check"], "left")
    at = cut(at.select(
        "doc_id", "text_hash", "line_no", F.coalesce("component", "id").alias("group"),
        F.when(F.col("component").isNull(), F.col("check")).otherwise(0).alias("check")))
    place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_hash", "line_no")
    first = at.groupBy("group", "check").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.count("*").alias("_n"))
    first = cut(first.filter("first <> last").select("group", "check", "first", "_n"))
    sizes = first.select("group", "check", "_n")
    again = join_one(at, first.drop("_n"), ["group", "check"], "inner", sizes).filter(place != F.col("first"))
    drops = cut(again.groupBy("doc_id", "text_hash").agg(F.collect_set("line_no").alias("drops")))
    rows = docs.select(
        F.struct(*(docs[c] for c in docs.columns)).alias("doc"), docs["doc_id"].alias("id"), F.xxhash64(text_of(docs)).alias("hash"))
    rows = rows.join(small_side(drops, 200_000), F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash")), "left")
    text = F.col("doc")["text"]
    breaks = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))
    rows = rows.select("doc", "drops", F.coalesce(breaks + 1, F.lit(0)).cast("long").alias("n_lines"))
    # Split once for a row, not once for a line that stays.
    rows = pin(rows, {"parts": F.when(F.col("drops").isNotNull(), F.split(text, "\n"))})
    rows = pin(rows, {"stay": F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("drops"))})
    fewer = F.array_join(F.transform("stay", lambda i: F.get("parts", i)), "\n")
    return rows.select(
        F.col("doc").withField("text", F.when(F.col("drops").isNull(), text).otherwise(fewer)).alias("doc"),
        "n_lines", F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"))
