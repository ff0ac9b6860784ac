"""Quotation linking: threads from quoted passages.

A line is quoted as deep as it has ``>`` signs at its start. Consecutive lines of
one depth are a passage. Passages are normalised (lower case, white space as one
blank) and hashed, and the hashes joined to those of what other messages of the
conversation say themselves: a whole body, a paragraph or a line. The earliest
message that says a passage, before the one that quotes it, is its original.

A message answers the latest original of its outermost quotes. That makes trees,
whose roots and depths come from pointer doubling, in as many steps as the
logarithm of the deepest tree. Threads are read root by root, each in the order
of depth, then turn, and without the quoted lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import stage

QUOTE = r"^[ \t]*(?:>[ \t]*)+"


def depth_of(line: Column) -> Column:
    marks = F.regexp_extract(line, QUOTE, 0)
    return F.length(marks) - F.length(F.replace(marks, F.lit(">"), F.lit("")))


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def passages(text: Column) -> Column:
    """Array of (depth, text): runs of lines of one depth, quote marks removed."""
    lines = F.transform(
        F.split(F.coalesce(text, F.lit("")), "\n", -1),
        lambda line: F.struct(depth_of(line).alias("depth"), F.regexp_replace(line, QUOTE, "").alias("line")),
    )
    kind = "array<struct<depth:int,text:string>>"

    def add(done, one):
        size = F.size(done)
        last = F.element_at(done, -1)
        same = (size > 0) & (F.get(done, size - 1)["depth"] == one["depth"])
        longer = F.struct(one["depth"].alias("depth"), F.concat_ws("\n", last["text"], one["line"]).alias("text"))
        fresh = F.struct(one["depth"].alias("depth"), one["line"].alias("text"))
        return F.when(same, F.concat(F.slice(done, F.lit(1), size - 1), F.array(longer))).otherwise(
            F.concat(done, F.array(fresh))
        )

    # Runs are numbered first where nothing is quoted, which is the common case.
    plain = F.array(F.struct(F.lit(0).alias("depth"), F.coalesce(text, F.lit("")).alias("text")))
    return F.when(
        F.coalesce(text, F.lit("")).rlike(r"(?m)^[ \t]*>"),
        F.aggregate(lines, F.array().cast(kind), add),
    ).otherwise(plain)


def own_text(parts: Column) -> Column:
    """What a message says itself: its unquoted passages, trimmed, a blank line between them."""
    own = F.transform(F.filter(parts, lambda p: p["depth"] == 0), lambda p: F.trim(F.regexp_replace(p["text"], r"^\s+|\s+$", "")))
    return F.array_join(F.filter(own, lambda t: t != ""), "\n\n")


def units(text: Column) -> Column:
    """The hashes of a text as a whole, of its paragraphs and of its lines."""
    pieces = F.concat(F.array(text), F.split(text, r"\n\s*\n", -1), F.split(text, "\n", -1))
    clean = F.filter(F.transform(pieces, normalised), lambda p: p != "")
    return F.array_distinct(F.transform(clean, lambda p: F.md5(p)))


def link_quotes(messages: DataFrame) -> DataFrame:
    """Threads of ``messages`` (``conv_id``, ``turn``, ``role``, ``text``).

    Per row: conv_id, turn, role, ``parent_turn`` (null for those that answer
    nothing), ``root_turn``, ``depth``, ``n_quotes`` (quoted passages), ``n_linked``
    (those with an original) and ``body``, the text without quotes. In order of
    conv_id, root_turn, depth and turn the rows are the conversations as read.

    Null texts are empty. Messages without conv_id or turn are roots of their own.
    Rows that repeat a conv_id and turn count as one message with the links of
    all; each keeps its own body. Other columns are ignored.
    """
    read = messages.select("conv_id", "turn", "role", passages(F.col("text")).alias("parts"))
    quoted = F.filter("parts", lambda p: (p["depth"] > 0) & (normalised(p["text"]) != ""))
    rows = stage(
        read.select(
            "conv_id", "turn", "role", own_text(F.col("parts")).alias("body"),
            F.transform(
                quoted, lambda p: F.struct(p["depth"].alias("depth"), F.md5(normalised(p["text"])).alias("hash"))
            ).alias("quotes"),
        )
    )
    placed = rows.filter("conv_id IS NOT NULL AND turn IS NOT NULL")
    wanted = stage(
        placed.filter(F.size("quotes") > 0)
        .select("conv_id", "turn", F.explode("quotes").alias("q"))
        .select("conv_id", "turn", "q.depth", "q.hash")
        .distinct()
    )
    # Only what somebody quotes is looked for; the first message of a conversation that says it is its original.
    asked = stage(wanted.select("conv_id", "hash").distinct())
    said = placed.filter("body <> ''").select("conv_id", "turn", F.explode(units(F.col("body"))).alias("hash"))
    originals = stage(said.join(asked, ["conv_id", "hash"], "left_semi").groupBy("conv_id", "hash").agg(F.min("turn").alias("source")))
    linked = wanted.join(originals, ["conv_id", "hash"]).filter("source < turn")
    outermost = F.struct((-F.col("depth")).alias("d"), F.col("source").alias("source"))
    links = stage(
        linked.groupBy("conv_id", "turn").agg(F.max(outermost)["source"].alias("parent_turn"), F.collect_set("hash").alias("found"))
    )
    tree = stage(roots(links.select("conv_id", "turn", "parent_turn")))
    known = links.join(tree, ["conv_id", "turn"])
    joined = rows.join(known, ["conv_id", "turn"], "left")
    hits = F.size(F.filter("quotes", lambda q: F.array_contains(F.coalesce("found", F.array().cast("array<string>")), q["hash"])))
    return joined.select(
        "conv_id", "turn", "role", "parent_turn",
        F.coalesce("root_turn", "turn").alias("root_turn"),
        F.coalesce("depth", F.lit(0)).alias("depth"),
        F.size("quotes").cast("long").alias("n_quotes"),
        hits.cast("long").alias("n_linked"),
        "body",
    )


def roots(links: DataFrame) -> DataFrame:
    """(conv_id, turn, root_turn, depth) of every message that answers another, by pointer doubling.

    A parent has a smaller turn than its child, so there are no cycles. Messages
    that have reached their root are only looked up from then on.
    """
    table = stage(
        links.select("conv_id", "turn", F.col("parent_turn").alias("up"), F.lit(1).alias("steps"), F.lit(False).alias("done"))
    )
    while True:
        above = table.select(
            "conv_id", F.col("turn").alias("up"), F.col("up").alias("next"), F.col("steps").alias("more"), F.col("done").alias("last")
        )
        moved = table.filter("NOT done").join(above, ["conv_id", "up"], "left")
        moved = moved.select(
            "conv_id", "turn", F.coalesce("next", "up").alias("up"),
            (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"), F.coalesce("last", F.lit(True)).alias("done"),
        )
        table = stage(moved.union(table.filter("done")))
        if table.filter("NOT done").isEmpty():
            return table.select("conv_id", "turn", F.col("up").alias("root_turn"), F.col("steps").alias("depth"))
