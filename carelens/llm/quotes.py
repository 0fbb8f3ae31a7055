"""Quotation linking: replies are linked to the messages they quote, and conversations come without quotes.

Quote levels (``>``, also nested and spaced) are parsed line by line; a passage is a run of lines of one level.  Passages
are normalised and hashed and met with the hashes of the other messages' own passages, lines and sentences.  A passage that
nobody says as a whole is looked for by its lines and sentences, and comes from the message that says most of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelens.llm.common import stored

#: Passages and parts of them with fewer letters and digits than this are looked for in their own conversation only.
LEAST_CHARS = 12
#: The share of a passage that a message has to say, in percent, where none says the whole.
COVER = 50
#: Turns are cut into blocks of two to this power, so that no task sorts a whole conversation.
TURN_BITS = 12


def normalised(text: Column) -> Column:
    """Lower case, letters and digits only, one space between words."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _lines(text: Column) -> Column:
    """(level, content) of each line.  Only marks at the start of a line count; ``> >`` is ``>>``."""
    lines = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), r"\r\n?", "\n"), "\n", -1)
    marks = lambda line: F.regexp_extract(line, r"^((?:[ \t]{0,3}>)*)", 1)
    return F.transform(
        lines,
        lambda line: F.struct(
            F.length(F.regexp_replace(marks(line), "[^>]", "")).alias("level"),
            F.regexp_replace(line, r"^(?:[ \t]{0,3}>)+ ?", "").alias("content"),
        ),
    )


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _passages(lines: Column) -> Column:
    """Runs of lines of one level, joined by line feeds."""

    def runs(own: Column, starts: Column) -> Column:
        def run(start: Column, k: Column) -> Column:
            end = F.coalesce(F.get(starts, k + 1), F.size(own))
            return F.struct(
                F.get(own, start)["level"].alias("level"),
                F.array_join(F.transform(F.slice(own, start + 1, end - start), lambda x: x["content"]), "\n").alias("content"),
            )

        return F.transform(starts, run)

    def cut(own: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(own) - 1)
        starts = F.filter(places, lambda i: (i == 0) | (F.get(own, i)["level"] != F.get(own, i - 1)["level"]))
        return _bound(starts, lambda found: runs(own, found))

    return _bound(lines, cut)


def _parts(text: Column) -> Column:
    """Normal forms of the lines and sentences of a text."""
    parts = F.concat(F.split(text, r"\n+"), F.split(text, r"(?<=[.!?])\s+"))
    return F.array_distinct(F.filter(F.transform(parts, normalised), lambda x: F.length(x) > 0))


def linked(messages: DataFrame) -> DataFrame:
    """Per row of ``messages`` (conv_id, turn, role, text): what it says itself, what it answers, and its place.

    Columns: conv_id, turn, role, own_text (without quoted lines), n_quotes, quote_depth, parent_conv, parent_turn,
    thread_conv, thread_turn, depth, place.  The parent is the message that the row's outermost quote comes from: an
    earlier one of the same conversation if there is one (the latest of them), else the first other message that says it,
    else the one that says most of its lines and sentences (half of it at least), likewise; without a known quote it is the
    turn before in the conversation.  Short passages and parts are known in their own conversation only.  A message is known by (conv_id, turn); rows that
    repeat one share its links, rows with NULL in either have no links.  NULL texts are empty.  Parents are earlier in
    (turn, conv_id), so threads hold no cycles; ``depth`` counts the messages above, ``place`` orders a thread.
    """
    base = messages.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), F.col("role").cast("string").alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    lines = _lines(F.col("text"))
    quoted = F.col("text").rlike(r"(?m)^[ \t]{0,3}>")
    own = F.when(quoted, F.trim(F.array_join(F.transform(F.filter(lines, lambda x: x["level"] == 0), lambda x: x["content"]), "\n"))).otherwise(F.col("text"))
    rows = base.withColumn("own_text", own).withColumn("passages", F.when(quoted, F.filter(_passages(lines), lambda p: p["level"] > 0)))
    rows = stored(rows.select("conv_id", "turn", "role", "own_text", "passages"), "messages")
    known = rows.where("conv_id is not null and turn is not null")
    # What messages say: the whole text and each line and sentence of it, under the hash of its normal form.
    parts = F.array_distinct(F.concat(F.array(normalised(F.col("own_text"))), _parts(F.col("own_text"))))
    said = known.select("conv_id", "turn", F.explode(parts).alias("norm"))
    asked = known.where("size(passages) > 0").select("conv_id", "turn", F.posexplode("passages").alias("n", "p"))
    asked = asked.select("conv_id", "turn", "n", F.col("p.level").alias("level"), normalised(F.col("p.content")).alias("all"), _parts(F.col("p.content")).alias("parts"))
    # The whole passage, and what it is made of.
    asked = asked.withColumn("norm", F.explode(F.array_distinct(F.concat(F.array("all"), "parts")))).where("length(norm) > 0")
    asked = asked.select("conv_id", "turn", "n", "level", "norm", (F.col("norm") == F.col("all")).alias("whole"), F.length("all").alias("length"))
    asked = asked.withColumn("hash", F.xxhash64("norm"))
    # A passage that a message repeats is asked for once.
    asked = asked.groupBy("conv_id", "turn", "level", "hash", "norm", "whole", "length").agg(F.min("n").alias("n"))
    said = said.where("length(norm) > 0").withColumn("hash", F.xxhash64("norm"))
    wanted = asked.select("hash").distinct()
    # One source per passage and conversation, and the first of all: a passage that many say stays one row.
    said = said.join(wanted, "hash", "left_semi")
    first = said.where(F.length("norm") >= LEAST_CHARS).groupBy("hash", "norm").agg(F.min(F.struct("turn", "conv_id")).alias("first"))
    # Both sides in one list by turn: as long as they are, however often a conversation repeats a passage.
    both = asked.withColumn("said", F.lit(None).cast("bigint")).unionByName(said.withColumn("said", F.col("turn")), allowMissingColumns=True)
    inside = _latest_before(both, "hash", "norm", "conv_id").where("n is not null and latest is not null")
    outside = asked.join(first, ["hash", "norm"]).where("first.turn < turn or (first.turn = turn and first.conv_id < conv_id)")
    inside = inside.withColumns({"p_turn": F.col("latest"), "p_conv": F.col("conv_id"), "far": F.lit(0)})
    outside = outside.withColumns({"p_turn": F.col("first.turn"), "p_conv": F.col("first.conv_id"), "far": F.lit(1)})
    names = ["conv_id", "turn", "level", "n", "norm", "whole", "length", "far", "p_turn", "p_conv"]
    met = inside.select(*names).unionByName(outside.select(*names))
    source = lambda far: F.struct("level", far.alias("far"), "n", "p_turn", "p_conv").alias("c")
    choice = met.where("whole").select("conv_id", "turn", source(F.col("far")))
    # Of each passage the message that says most of it, the latest of those that say as much.
    most = met.where("not whole").groupBy("conv_id", "turn", "level", "n", "length", "far", "p_turn", "p_conv").agg(F.sum(F.length("norm")).alias("chars"))
    most = most.where(100 * F.col("chars") >= COVER * F.col("length")).groupBy("conv_id", "turn", "level", "n", "far")
    most = most.agg(F.max(F.struct("chars", "p_turn", "p_conv")).alias("m")).select("conv_id", "turn", "level", "n", "far", "m.p_turn", "m.p_conv")
    choice = choice.unionByName(most.select("conv_id", "turn", source(F.col("far") + 2)))
    parent = choice.groupBy("conv_id", "turn").agg(F.min("c").alias("c"))
    keys = known.select("conv_id", "turn").distinct()
    keys = _latest_before(keys.withColumn("said", F.col("turn")), "conv_id").withColumnRenamed("latest", "previous").join(parent, ["conv_id", "turn"], "left")
    keys = keys.select(
        "conv_id", "turn", F.coalesce("c.p_conv", F.when(F.col("previous").isNotNull(), F.col("conv_id"))).alias("parent_conv"),
        F.coalesce("c.p_turn", "previous").alias("parent_turn"),
    )
    threads = _threads(stored(keys, "parents"))
    out = rows.select("conv_id", "turn", "role", "own_text", F.coalesce(F.size("passages"), F.lit(0)).alias("n"), "passages")
    depth = F.coalesce(F.array_max(F.transform("passages", lambda p: p["level"])), F.lit(0)).alias("quote_depth")
    out = out.select("conv_id", "turn", "role", "own_text", F.greatest("n", F.lit(0)).alias("n_quotes"), depth)
    return out.join(threads, ["conv_id", "turn"], "left")


def _latest_before(rows: DataFrame, *by: str) -> DataFrame:
    """``rows`` with ``latest``: the greatest ``said`` among rows of the same ``by`` whose ``turn`` is less.

    Within a block of turns by a window, across blocks by the greatest value of each.
    """
    rows = rows.withColumn("block", F.shiftright("turn", TURN_BITS))
    within = Window.partitionBy(*by, "block").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(*by).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy(*by, "block").agg(F.max("said").alias("said")).select(*by, "block", F.max("said").over(across).alias("earlier"))
    rows = rows.withColumn("latest", F.max("said").over(within)).join(blocks, [*by, "block"], "left")
    return rows.withColumn("latest", F.coalesce("latest", "earlier")).drop("block", "earlier", "said")


def _threads(keys: DataFrame) -> DataFrame:
    """Root and depth of each message by pointer doubling; each round is stored.

    A message that has reached its root is settled: later rounds join those that have not, so long threads cost their own
    length and not a pass over all messages.
    """
    up = keys.select(
        "conv_id", "turn", "parent_conv", "parent_turn", F.coalesce("parent_conv", "conv_id").alias("up_conv"), F.coalesce("parent_turn", "turn").alias("up_turn"),
        F.when(F.col("parent_turn").isNotNull(), 1).otherwise(0).alias("depth"), F.col("parent_turn").isNotNull().alias("open"),
    )
    while True:
        far = up.select(F.col("conv_id").alias("up_conv"), F.col("turn").alias("up_turn"), F.col("up_conv").alias("far_conv"), F.col("up_turn").alias("far_turn"), F.col("depth").alias("more"), F.col("open").alias("far_open"))
        new = up.where("open").join(far, ["up_conv", "up_turn"], "left").select(
            "conv_id", "turn", "parent_conv", "parent_turn", F.coalesce("far_conv", "up_conv").alias("up_conv"), F.coalesce("far_turn", "up_turn").alias("up_turn"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.coalesce("far_open", F.lit(False)).alias("open"),
        )
        up = stored(up.where("not open").unionByName(new), "threads")
        if up.where("open").isEmpty():
            break
    roots = up.select("conv_id", "turn", "parent_conv", "parent_turn", F.col("up_conv").alias("thread_conv"), F.col("up_turn").alias("thread_turn"), "depth")
    return roots.withColumn("place", F.struct("depth", "turn", "conv_id"))


def conversations(messages: DataFrame) -> DataFrame:
    """The rows of ``linked`` with ``place`` as text, which sorts a thread from its root to its last replies."""
    rows = linked(messages)
    digits = lambda c: F.lpad(F.col(f"place.{c}").cast("string"), 19, "0")
    return rows.withColumn("place", F.concat_ws("-", digits("depth"), digits("turn"), digits("conv_id")))
