"""Mixing sources to target weights, block by block.

The words of each source form one stream, cut into blocks of a fixed length (the last
is shorter). Every output shard draws how many of its slots each source fills: a whole
part by its share and the rest by a multinomial draw. The slots of a source are counted
through; slot ``g`` is in pass ``g div blocks`` and maps through that pass's
pseudorandom permutation of the block numbers, a swap-or-not shuffle, so one pass takes
each block once and no block is taken more than ``CAP`` times. Blocks and slots then
meet by their number.

Sources weigh 5, 2 and 1 in turn, in code point order with null last. Targets share all
words by weight; none exceeds ``CAP`` times its source, and what is over goes to the
others by weight. All draws are md5 sums of positions, so reruns agree.

A null text has no words; a text without words is never taken and has no place in a
stream; a null source is a source; rows with equal ids are placed one by one. An empty
table gives no rows. Only ``doc_id``, ``text`` and ``source`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakewright.session import materialise

#: Words of a block, slots of an output shard, takes of a block at most, rounds of the shuffle.
BLOCK = 64
SHARD = 65536
CAP = 3
ROUNDS = 12
WEIGHTS = (5, 2, 1)
SEED = "mix"
SPACE = "\\x20\\x09-\\x0D"
#: Parts that the stream of a source is numbered in, so that no source is one task.
PARTS = 4096


def words_of(text: Column) -> Column:
    """The words of a text as an array; empty for a null text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), lambda w: w != "")


def draw(*parts: Column) -> Column:
    """48 pseudorandom bits for some values."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(SEED), *[p.cast("string") for p in parts]).cast("binary")), 1, 12), 16, 10).cast("long")


def placed_sizes(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id, source, size and the part of its source's stream, for every row; ``more`` goes along."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        "source",
        *more,
        F.size(words_of(F.col("text"))).cast("long").alias("size"),
        (F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, 3), 16, 10).cast("int") % PARTS).alias("part"),
        F.xxhash64(text).alias("tie"),
    )


def plan_sources(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """One row per source: its number, size, target, blocks and the slots it fills of each of ``shards`` shards.

    ``whole`` slots of a shard are the source's for sure; of the ``rest`` others it
    takes those whose draw falls from ``low`` to below ``high``. The windows here run
    over one row per source.
    """
    each = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.row_number().over(in_order) - 1
    each = each.withColumn("sid", turn.cast("int")).withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int")))
    # The level at which sum(min(cap, level * weight)) is the total: the largest of the lines' roots.
    by_room = Window.orderBy(F.col("source_size") / F.col("weight"), "sid")
    every = Window.partitionBy()
    left = F.sum("source_size").over(every) - CAP * F.coalesce(F.sum("source_size").over(by_room.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    heavier = F.sum("weight").over(by_room.rowsBetween(0, Window.unboundedFollowing))
    each = each.withColumn("root", left / heavier).withColumn("level", F.max("root").over(every))
    each = each.withColumn("target", F.least(CAP * F.col("source_size").cast("double"), F.col("level") * F.col("weight")))
    each = each.withColumn("blocks", F.ceil(F.col("source_size") / block))
    each = each.withColumn("share", F.when(F.col("source_size") > 0, F.col("target") * F.col("blocks") / F.col("source_size")).otherwise(0.0))
    each = each.withColumn("all_slots", F.ceil(F.round(F.sum("share").over(every), 6)))
    each = each.withColumn("shards", F.greatest(F.lit(1), F.ceil(F.col("all_slots") / shard)))
    each = each.withColumn("slots", F.ceil(F.col("all_slots") / F.col("shards")))
    each = each.withColumn("mine", F.when(F.col("all_slots") > 0, F.col("slots") * F.col("share") / F.sum("share").over(every)).otherwise(0.0))
    each = each.withColumn("whole", F.floor(F.round(F.col("mine"), 9)))
    each = each.withColumn("rest", F.col("slots") - F.sum("whole").over(every))
    each = each.withColumn("part", F.greatest(F.lit(0.0), F.col("mine") - F.col("whole")))
    up_to = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, 0)
    each = each.withColumn("all_parts", F.sum("part").over(every)).withColumn("high", F.sum("part").over(up_to))
    scale = float(1 << 48)
    high = F.when(F.col("sid") == F.max("sid").over(every), scale).when(F.col("all_parts") > 0, F.floor(F.col("high") / F.col("all_parts") * scale)).otherwise(0.0)
    each = each.withColumn("high", high).withColumn("low", F.coalesce(F.lag("high").over(Window.orderBy("sid")), F.lit(0.0)))
    return each.select("sid", "source", "source_size", "target", "blocks", "shards", "whole", "rest", "low", "high")


def round_keys(n: Column, *key: Column) -> Column:
    """What ``permuted`` needs of a key, once for all positions: a number below ``n`` for every round."""
    return F.transform(F.sequence(F.lit(1), F.lit(ROUNDS)), lambda r: F.pmod(draw(*key, F.lit("k"), r), n))


def permuted(x: Column, n: Column, keys: Column, *key: Column) -> Column:
    """Where ``x`` of 0 to ``n - 1`` goes under the keyed permutation: a swap-or-not shuffle."""

    def swapped(at: Column, r: Column) -> Column:
        pair = F.struct(at.alias("a"), F.pmod(F.get(keys, r - 1) - at, n).alias("p"))
        # Both members of a pair ask the same question, so they swap or stay together.
        return F.aggregate(F.array(pair), at, lambda _, q: F.when(draw(*key, r, F.greatest(q["a"], q["p"])) % 2 == 1, q["p"]).otherwise(q["a"]))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x, swapped)


def slots(sources: DataFrame) -> DataFrame:
    """One row per filled slot: sid, pass and block."""
    within = lambda s, low, high, rest: F.when(rest > 0, F.size(F.filter(F.sequence(F.lit(0).cast("long"), F.greatest(rest - 1, F.lit(0))), lambda r: (draw(s, F.lit("s"), r) >= low) & (draw(s, F.lit("s"), r) < high)))).otherwise(0)
    per_shard = sources.where("blocks > 0").withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)))
    per_shard = per_shard.withColumn("n", F.col("whole") + within(F.col("shard"), F.col("low"), F.col("high"), F.col("rest")))
    before = Window.partitionBy("sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    per_shard = per_shard.withColumn("from", F.coalesce(F.sum("n").over(before), F.lit(0)))
    per_shard = per_shard.withColumn("to", F.least(F.col("from") + F.col("n"), CAP * F.col("blocks"))).where("to > from")
    turns = per_shard.withColumn("pass", F.explode(F.sequence(F.floor(F.col("from") / F.col("blocks")), F.floor((F.col("to") - 1) / F.col("blocks")))))
    start = F.col("pass") * F.col("blocks")
    low, high = F.greatest(F.col("from") - start, F.lit(0)), F.least(F.col("to") - start, F.col("blocks"))
    # In pieces, dealt over enough tasks for the work that unfolding them is.
    piece = 4096
    pieces = turns.select("sid", "pass", "blocks", F.explode(F.sequence(low, high - 1, F.lit(piece).cast("long"))).alias("at"), high.alias("over"))
    many = sources.agg(F.sum(F.least(F.col("shards") * (F.col("whole") + 1), CAP * F.col("blocks")))).first()[0] or 0
    dealt = pieces.repartition(max(1, -(-int(many) // (8 * piece))), "sid", "pass", "at")
    keyed = dealt.withColumn("keys", round_keys(F.col("blocks"), F.col("sid"), F.col("pass")))
    filled = keyed.withColumn("at", F.explode(F.sequence(F.col("at"), F.least(F.col("at") + piece, F.col("over")) - 1)))
    return filled.select("sid", "pass", permuted(F.col("at"), F.col("blocks"), F.col("keys"), F.col("sid"), F.col("pass")).alias("block"))


def placed(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """Where each text begins in its source's stream: two sums, over the parts and within one."""
    parts = sizes.groupBy("source", "part").agg(F.sum("size").alias("in_part"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("skip", F.coalesce(F.sum("in_part").over(earlier), F.lit(0))).drop("in_part")
    numbered = parts.join(sources.select("source", "sid", "source_size", "target", "blocks"), parts["source"].eqNullSafe(sources["source"])).select(
        parts["source"].alias("of"), F.col("part").alias("in"), "skip", "sid", "source_size", "target", "blocks"
    )
    inside = Window.partitionBy("source", "part").orderBy("doc_id", "tie", "size").rowsBetween(Window.unboundedPreceding, -1)
    begun = sizes.withColumn("begin", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    same = begun["source"].eqNullSafe(numbered["of"]) & (begun["part"] == numbered["in"])
    return begun.join(numbered, same).withColumn("begin", F.col("begin") + F.col("skip")).drop("of", "in", "skip", "part", "tie")


def pieces(at: DataFrame, block: int = BLOCK) -> DataFrame:
    """sid, begin, block and the words of that block for every block that a text reaches into."""
    size, begin = F.col("size"), F.col("begin")
    reach = F.explode(F.sequence(F.floor(begin / block), F.floor((begin + size - 1) / block)))
    found = at.where("size > 0").select("sid", "begin", "size", reach.alias("block"))
    low, high = F.greatest(begin, F.col("block") * block), F.least(begin + size, (F.col("block") + 1) * block)
    return found.select("sid", "begin", "block", (low - begin).alias("from"), (high - begin).alias("to"))


def taken_pieces(at: DataFrame, sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """:func:`pieces` that at least one slot holds, with the number of slots."""
    times = slots(sources).groupBy("sid", "block").agg(F.count("*").alias("times"))
    # Unfolded from a few rows, the slots look small to the planner; they grow with the corpus.
    return pieces(at, block).join(times.hint("merge"), ["sid", "block"])


def mix_report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken (words the mix takes, repeats counted) for every row."""
    sizes = materialise(placed_sizes(docs), "mix-sizes")
    sources = materialise(plan_sources(sizes), "mix-sources")
    at = placed(sizes, sources)
    words = taken_pieces(at, sources).groupBy("sid", "begin").agg(F.sum((F.col("to") - F.col("from")) * F.col("times")).alias("taken"))
    # A text without words begins where the next one does; it must not get that one's words.
    key = F.when(F.col("size") > 0, F.col("begin")).otherwise(-1 - F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000_007)))
    return at.withColumn("begin", key).join(words, ["sid", "begin"], "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mix_texts(docs: DataFrame) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a text whole for every pass that takes all of it,
    else one row for each block of it that is taken, its words joined by one blank.
    ``n_chars``, if there, becomes the length of the new text."""
    sources = materialise(plan_sources(placed_sizes(docs)), "mix-sources")
    slim = materialise(placed(placed_sizes(docs), sources).select("sid", "begin", "size"), "mix-places")
    piece = F.struct("block", "from", "to", "times")
    chosen = taken_pieces(slim, sources).groupBy("sid", "begin").agg(F.array_sort(F.collect_list(piece)).alias("pieces"), F.sum(F.col("to") - F.col("from")).alias("held"))
    row = F.struct(*[F.col(c) for c in docs.columns]).alias("row")
    found = placed(placed_sizes(docs, row), sources).where("size > 0").join(chosen, ["sid", "begin"])
    passes = found.withColumn("turn", F.explode(F.sequence(F.lit(1), F.array_max(F.col("pieces.times")).cast("int"))))
    full = (F.col("held") == F.col("size")) & (F.array_min(F.col("pieces.times")) >= F.col("turn"))
    cut = F.transform(
        F.filter("pieces", lambda p: p["times"] >= F.col("turn")),
        lambda p: F.concat_ws(" ", F.slice("words", (p["from"] + 1).cast("int"), (p["to"] - p["from"]).cast("int"))),
    )
    parted = passes.withColumn("words", F.when(~full, words_of(F.col("row.text"))))
    texts = parted.withColumn("new", F.explode(F.when(full, F.array("row.text")).otherwise(cut)))
    new = {"text": F.col("new"), "n_chars": F.length("new")}
    return texts.select(*[new.get(c, F.col("row")[c]).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])
