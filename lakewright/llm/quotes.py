"""Quotation linking: messages that quote others become conversations in reply order, without quotes.

A line is quoted as deep as the ``>`` marks at its start say. Lines of one depth in a
row are a passage. Passages are normalised (lower case, white space as one blank) and
hashed whole, by paragraph and by line; so are the messages' own words. A passage
links to the earlier message of its conversation that first wrote most of it, counted
in characters at the best of the three grains; of equals, to the first. A message
answers the origin of its shallowest linked passage, of equals the one with most
characters. A thread is a message that answers none, with all below it; in the order
of conversation, thread and turn every message follows the one it answers.

A null text is empty. A message whose conversation or turn is null links to nothing. Messages
with the same conversation and turn answer together: the best link of any counts for
all. Quotes whose origin is not in the table are taken out too, and counted. Other
columns are not looked at. Only built-in functions are used, and no conversation is
ever gathered, however long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewright.functions.once import computed_once
from lakewright.session import materialise

MARKS = r"^[ \t]*>[> \t]*"
#: A line that only says who wrote the quote below it.
SAID = r"(?i)^.*\b(wrote|writes|schrieb|a écrit|escribió)\s*:\s*$"


def normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def parsed(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, runs (level and body of lines of one depth in a row) and text, the message's own words."""
    lines = F.split(F.coalesce(F.col("whole"), F.lit("")), "\r?\n")
    rows = computed_once(messages.select("conv_id", "turn", "role", F.col("text").alias("whole")), lines=lines)
    marks = lambda line: F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), "[^>]", ""))
    rows = computed_once(rows, levels=F.transform("lines", marks), bodies=F.transform("lines", lambda line: F.regexp_replace(line, MARKS, "")))
    level = lambda i: F.get(F.col("levels"), i)
    said = lambda i: (level(i) < F.coalesce(level(i + 1), F.lit(0))) & F.get(F.col("lines"), i).rlike(SAID)
    numbers = F.sequence(F.lit(0), F.size("lines") - 1)
    rows = computed_once(rows, starts=F.filter(numbers, lambda i: (i == 0) | (level(i) != level(i - 1))))
    run = lambda s, k: F.struct(level(s).alias("level"), F.array_join(F.slice("bodies", s + 1, F.coalesce(F.get("starts", k + 1), F.size("lines")) - s), "\n").alias("body"))
    own = F.array_join(F.transform(F.filter(numbers, lambda i: (level(i) == 0) & ~F.coalesce(said(i), F.lit(False))), lambda i: F.get(F.col("bodies"), i)), "\n")
    quoted = F.exists("levels", lambda n: n > 0)
    text = F.when(quoted, F.regexp_replace(own, r"^(\s*\n)+|\s+$", "")).otherwise(F.coalesce("whole", F.lit("")))
    return computed_once(rows, runs=F.transform("starts", run), text=text, quoted=quoted).select("conv_id", "turn", "role", "runs", "text", "quoted")


def units(of: DataFrame, text: str, *keep: str) -> DataFrame:
    """``keep``, grain (0 whole, 1 paragraph, 2 line), hash and chars of everything in ``text`` that is not blank."""
    grains = [F.array(text), F.split(F.col(text), r"\n\s*\n"), F.split(F.col(text), "\n")]

    def tagged(grain: int):
        return lambda t: F.struct(F.lit(grain).alias("grain"), normal(t).alias("words"))

    tagged = [F.transform(g, tagged(k)) for k, g in enumerate(grains)]
    found = of.select(*keep, F.inline(F.concat(*tagged))).where("words <> ''")
    return found.select(*keep, "grain", F.xxhash64("words").alias("hash"), F.length("words").alias("chars"))


def links(messages: DataFrame) -> DataFrame:
    """conv_id, turn, passage (from 0 in its message), level, chars matched and origin, the turn quoted; null if none."""
    read = parsed(messages)
    placed = read.where("conv_id is not null and turn is not null")
    passages = placed.where("quoted").select("conv_id", "turn", F.xxhash64("runs").alias("tie"), F.posexplode("runs").alias("passage", "run"))
    passages = materialise(passages.where("run.level > 0").select("conv_id", "turn", "tie", "passage", F.col("run.level").alias("level"), F.col("run.body").alias("body")).distinct(), "passages")
    key = ("conv_id", "turn", "tie", "passage", "level")
    wanted = units(passages, "body", *key)
    # One row per hash and conversation, however often it is written: the first turn.
    written = units(placed.join(passages.select("conv_id").distinct(), "conv_id", "left_semi"), "text", "conv_id", "turn")
    first = written.groupBy("conv_id", "hash", "chars").agg(F.min("turn").alias("origin"))
    met = wanted.join(first, ["conv_id", "hash", "chars"]).where("origin < turn")
    score = met.groupBy(*key, "origin", "grain").agg(F.sum("chars").alias("chars")).groupBy(*key).agg(F.max(F.struct("chars", (-F.col("origin")).alias("back"))).alias("best"))
    return passages.select(*key).distinct().join(score, list(key), "left").select("conv_id", "turn", "tie", "passage", "level", F.col("best.chars").alias("chars"), (-F.col("best.back")).alias("origin"))


def threads(answers: DataFrame) -> DataFrame:
    """conv_id, turn, thread and depth for every conv_id, turn and parent: the way up is doubled until it ends."""
    now = materialise(answers.select("conv_id", "turn", F.col("parent").alias("thread"), F.lit(1).cast("long").alias("depth")), "threads")
    while True:
        up = now.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("above"), F.col("depth").alias("more"))
        joined = now.join(up, ["conv_id", "thread"], "left")
        now = materialise(joined.select("conv_id", "turn", F.coalesce("above", "thread").alias("thread"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.isnotnull("above").alias("moved")), "threads")
        if now.where("moved").isEmpty():
            return now.drop("moved")


def conversations(messages: DataFrame) -> DataFrame:
    """One row per message: conv_id, turn, role, text without quotes, parent, thread, depth, n_quotes and n_linked.

    Sorted by conv_id, thread and turn the rows read in reply order.
    """
    found = materialise(links(messages), "links")
    top = F.min(F.struct("level", (-F.col("chars")).alias("chars"), "origin", "passage"))
    answers = found.where("origin is not null").groupBy("conv_id", "turn").agg(top.alias("top")).select("conv_id", "turn", F.col("top.origin").alias("parent"))
    answers = materialise(answers, "answers")
    above = threads(answers).join(answers, ["conv_id", "turn"])
    quotes = lambda runs: F.size(F.filter(runs, lambda r: r["level"] > 0))
    linked = found.groupBy("conv_id", "turn", "tie").agg(F.count("origin").alias("n_linked"))
    read = parsed(messages).select("conv_id", "turn", "role", "text", quotes(F.col("runs")).cast("long").alias("n_quotes"), F.xxhash64("runs").alias("tie"))
    joined = read.join(above, ["conv_id", "turn"], "left").join(linked, ["conv_id", "turn", "tie"], "left")
    return joined.select(
        "conv_id", "turn", "role", "text", "parent", F.coalesce("thread", "turn").alias("thread"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        "n_quotes", F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
    )


def in_reply_order(messages: DataFrame) -> DataFrame:
    """:func:`conversations`, sorted; a range of the order is one task, and a long conversation several."""
    return conversations(messages).orderBy("conv_id", "thread", "turn")
