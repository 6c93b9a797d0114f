"""Quotation linking: quoted passages to the messages they come from, replies in order."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.quality import normal_line
from tallyspark.llm.shared import BLANKS, let, materialise

# A quotation mark at the start of a line, and all of them with their blanks.
MARKS = r"^((?:[ \t]{0,3}>)+)"
MARKED = r"^(?:[ \t]{0,3}>)+[ \t]?"


def quote_level(line: Column) -> Column:
    """How many quotation marks a line starts with, nested or not."""
    marks = F.regexp_extract(line, MARKS, 1)
    return F.length(marks) - F.length(F.replace(marks, F.lit(">")))


def parsed_lines(text: Column) -> Column:
    """The lines of a text as (level, body): quote level and text without the marks."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: F.struct(
        quote_level(line).alias("level"), F.regexp_replace(line, MARKED, "").alias("body")))


def passages_of(lines: Column) -> Column:
    """Maximal runs of lines of one level, split at blank lines: (level, place, bodies).

    A run starts where the level changes or a blank line ends; ``place`` is its first line.
    """
    def blank(line):
        return F.btrim(line["body"], F.lit(BLANKS)) == ""

    def starts(lines):
        return F.filter(F.transform(lines, lambda line, i: F.when(
            ~blank(line) & ((i == 0) | F.coalesce(F.get(lines, i - 1)["level"] != line["level"], F.lit(True))
                            | F.coalesce(blank(F.get(lines, i - 1)), F.lit(True))), i)), lambda i: i.isNotNull())

    def runs(lines):
        return let(starts(lines), lambda s: F.transform(s, lambda first, k: let(
            F.slice(lines, first + 1, F.coalesce(F.get(s, k + 1), F.size(lines)) - first),
            lambda run: F.struct(
                F.get(run, F.lit(0))["level"].alias("level"), first.alias("place"),
                F.transform(F.filter(run, lambda line: (line["level"] == F.get(run, F.lit(0))["level"]) & ~blank(line)),
                            lambda line: line["body"]).alias("bodies")))))

    return let(lines, runs)


def _hashed(bodies: Column) -> Column:
    """Hash of a passage: its lines normalised and joined, so that re-wrapping changes nothing."""
    return F.xxhash64(F.array_join(F.transform(bodies, normal_line), " "))


def _own(lines: Column) -> Column:
    return F.filter(lines, lambda line: line["level"] == 0)


def quotation_links(messages: DataFrame) -> DataFrame:
    """Stored: one row per quoted passage: _row, level, place, and the turn of the original
    message (``origin``), NULL where none is found.

    A passage is looked up as a whole; if it is not found, by its lines, the first found counts.
    Originals are the unquoted passages of all earlier messages of the conversation, whole
    messages, passages and single lines; each hash is reduced to the first message that has it
    before anything is joined, so a phrase that everyone uses yields one row per conversation.
    """
    quoted = messages.select("_row", "conv", "turn", F.explode(
        F.filter(passages_of(F.col("_lines")), lambda p: p["level"] > 0)).alias("p"))
    hashes = F.concat(F.array(_hashed(F.col("p.bodies"))),
                      F.transform("p.bodies", lambda body: _hashed(F.array(body))))
    passages = materialise(quoted.select(
        "_row", "conv", "turn", F.col("p.level").alias("level"), F.col("p.place").alias("place"),
        F.posexplode(hashes).alias("part", "hash")), "passages")
    own = let(passages_of(F.col("_lines")), lambda runs: F.filter(runs, lambda p: p["level"] == 0))
    units = let(own, lambda runs: F.array_union(
        F.array_union(F.transform(runs, lambda p: _hashed(p["bodies"])),
                      F.flatten(F.transform(runs, lambda p: F.transform(p["bodies"], lambda b: _hashed(F.array(b)))))),
        F.array(_hashed(F.flatten(F.transform(runs, lambda p: p["bodies"]))))))
    originals = materialise(messages.select("conv", "turn", F.explode(units).alias("hash"))
                            .groupBy("conv", "hash").agg(F.min("turn").alias("origin")), "originals")
    first = originals.select(F.col("conv").alias("_conv"), F.col("hash").alias("_hash"), "origin")
    found = passages.join(
        first, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("hash") == F.col("_hash"))
        & (F.col("origin") < F.col("turn")), "left")
    best = F.min(F.when(F.col("origin").isNotNull(), F.struct("part", "origin")))
    return materialise(found.groupBy("_row", "level", "place").agg(best.alias("best"))
                       .select("_row", "level", "place", F.col("best.origin").alias("origin")), "links")


def _threads(parents: DataFrame) -> DataFrame:
    """(conv, turn, root, depth) by pointer doubling: every round halves the way to the root.

    A parent's turn is smaller than its reply's, so the ways end; rounds are stored.
    """
    state = materialise(parents.select("conv", "turn", F.coalesce("parent", "turn").alias("root"),
                                       F.col("parent").isNotNull().cast("int").alias("depth")), "threads")
    while True:
        up = state.filter("root <> turn").select("conv", "turn", "root", "depth")
        above = state.filter("root <> turn").select(
            F.col("conv").alias("_conv"), F.col("turn").alias("_turn"), F.col("root").alias("_root"),
            F.col("depth").alias("_depth"))
        joined = materialise(up.join(above, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("root") == F.col("_turn")),
                                     "left").select(
            "conv", "turn", F.coalesce("_root", "root").alias("root"),
            (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"), F.col("_root").isNotNull().alias("moved"))
            .union(state.filter("root = turn").select("conv", "turn", "root", "depth", F.lit(False).alias("moved"))),
            "threads")
        if not joined.filter("moved").limit(1).count():
            return joined.drop("moved")
        state = joined.drop("moved")


def reply_ordered(messages: DataFrame) -> DataFrame:
    """Messages without their quotations, linked to what they reply to.

    ``messages`` has conv_id, turn, role and text.  Returned per message: conv_id, turn, role,
    ``parent`` (turn of the message whose passage it quotes at the outermost level, its first
    such passage that is found), ``root`` (turn of the first message of its reply chain),
    ``depth`` in that chain, ``n_quotes``, ``n_linked`` and ``reply_text`` (unquoted lines).
    Sorted by conv_id, root, turn, conversations are ordered by reply: thread after thread, a
    message after the one it answers.

    Defined results: a NULL text counts as empty; a NULL conv_id is a conversation of its own;
    a message without a turn links to nothing; messages that share conversation and turn share
    parent, root and depth (the smallest parent); a quotation without an earlier original
    stays unlinked; an empty table gives an empty result; extra columns are ignored.
    """
    rows = materialise(messages.select(
        F.monotonically_increasing_id().alias("_row"), F.col("conv_id").alias("conv"), "turn", "role",
        parsed_lines(F.col("text")).alias("_lines")), "messages")
    links = quotation_links(rows)
    outer = links.filter("origin is not null").groupBy("_row").agg(
        F.min(F.struct("level", "place", "origin")).alias("best")).select("_row", F.col("best.origin").alias("parent"))
    counts = links.groupBy("_row").agg(F.count("*").alias("n_quotes"), F.count("origin").alias("n_linked"))
    replies = materialise(rows.select("_row", "conv", "turn").join(counts, "_row", "left").join(outer, "_row", "left"),
                          "replies")
    threads = _threads(replies.filter("turn is not null").groupBy("conv", "turn").agg(F.min("parent").alias("parent")))
    placed = replies.join(threads.select(F.col("conv").alias("_conv"), F.col("turn").alias("_turn"), "root", "depth"),
                          F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("turn") == F.col("_turn")), "left")
    text = F.array_join(F.transform(_own(F.col("_lines")), lambda line: line["body"]), "\n")
    return rows.select("_row", "role", text.alias("reply_text")).join(placed, "_row").select(
        F.col("conv").alias("conv_id"), "turn", "role", "parent", "root",
        F.coalesce("depth", F.lit(0)).alias("depth"), F.coalesce("n_quotes", F.lit(0)).cast("bigint").alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).cast("bigint").alias("n_linked"), "reply_text")
