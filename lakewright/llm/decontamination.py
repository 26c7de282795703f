"""Benchmark decontamination by spaced seeds.

A mask marks which tokens of a stretch count; the others may differ. Every mask is
laid at every position of the benchmark items and of the texts, the counted tokens are
hashed, and equal hashes are hits. Around a hit, up to ``WINDOW`` tokens of the item
are compared with the text position by position: the pair counts if at least
``PERCENT`` of them are equal, so substituted words are tolerated, also under the mask.

Tokens are runs of letters and digits, in lower case. An item shorter than the masks
must be met whole; one with fewer than ``LEAST`` tokens says too little to be looked
for. Null and empty texts and items have no tokens and meet nothing. Rows with equal
ids are compared one by one and reported under their common id; extra columns are not
looked at. Only built-in functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewright.functions.once import computed_once
from lakewright.session import materialise

MASKS = ("111101111011", "111010011101", "110110100111")
WINDOW = 24
PERCENT = 80
LEAST = 5
#: Seeds (about 50 bytes each) up to which every executor gets all of them; beyond, both sides are dealt by hash.
BROADCAST_SEEDS = 1_000_000
_SPAN = len(MASKS[0])


def tokens_of(text: Column) -> Column:
    """One number for each token of a text."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def masked(tokens: Column, at: Column) -> list[Column]:
    """The hash under each mask laid at a position (from 0)."""
    return [F.xxhash64(F.lit(k), *[F.get(tokens, at + i) for i, c in enumerate(mask) if c == "1"]) for k, mask in enumerate(MASKS)]


def whole(tokens: Column, at: Column, length: int) -> Column:
    return F.xxhash64(F.lit(-length), *[F.get(tokens, at + i) for i in range(length)])


def laid(rows: DataFrame, short: list[int], *keep: str) -> DataFrame:
    """``keep``, position and hash for every mask and, for the lengths in ``short``, every run of that length."""
    at, size = F.col("at"), F.size("tokens")
    found = rows.where(size >= LEAST).select(*keep, "tokens", F.explode(F.sequence(F.lit(0), size - LEAST)).alias("at"))
    fits = lambda length, key: F.when(at + length <= size, key)
    keys = [fits(_SPAN, k) for k in masked(F.col("tokens"), at)] + [fits(n, whole(F.col("tokens"), at, n)) for n in short]
    return found.select(*keep, "tokens", "at", F.explode(F.array(*keys)).alias("key")).where("key is not null")


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, tie (hash of the text), item_id, matched and compared: the best overlap of every pair that counts."""
    items = materialise(benchmark.select("item_id", tokens_of(F.col("text")).alias("tokens")).where(F.size("tokens") >= LEAST).distinct(), "items")
    items = items.withColumn("item", F.xxhash64("item_id", "tokens"))
    short = sorted(r.n for r in items.where(F.size("tokens") < _SPAN).select(F.size("tokens").alias("n")).distinct().collect())  # LEAST to _SPAN - 1
    of_long = laid(items.where(F.size("tokens") >= _SPAN), [], "item").select("key", "item", F.col("at").alias("from"), F.size("tokens").alias("length"))
    of_short = items.where(F.size("tokens") < _SPAN)
    seeds = of_long
    for n in short:
        seeds = seeds.unionByName(of_short.where(F.size("tokens") == n).select(whole(F.col("tokens"), F.lit(0), n).alias("key"), "item", F.lit(0).alias("from"), F.lit(n).alias("length")))
    seeds = materialise(seeds, "seeds")

    text = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"), F.col("text").alias("whole"))
    text = computed_once(text, tokens=tokens_of(F.col("whole"))).drop("whole")
    # The compared stretch begins at item token `start`, which would lie at `low` in the text.
    start = F.greatest(F.lit(0), F.least(F.col("from") + _SPAN // 2 - WINDOW // 2, F.col("length") - WINDOW))
    low = F.col("at") - F.col("from") + start
    inside = F.greatest(low, F.lit(0))
    stretch = F.slice("tokens", inside + 1, low + F.least(F.lit(WINDOW), F.col("length")) - inside)
    seen = ("doc_id", "tie", "item", "length", (start + inside - low).alias("skip"), stretch.alias("stretch"))
    if seeds.count() <= BROADCAST_SEEDS:
        hits = laid(text, short, "doc_id", "tie").join(F.broadcast(seeds), "key").select(*seen)
    else:
        spots = laid(text, short, "doc_id", "tie").drop("tokens").join(seeds, "key").drop("key").distinct()
        same = F.col("i").eqNullSafe(F.col("doc_id")) & (F.col("t") == F.col("tie"))
        hits = text.dropDuplicates(["doc_id", "tie"]).withColumnsRenamed({"doc_id": "i", "tie": "t"}).join(spots, same).select(*seen)

    of = items.select("item", "item_id", F.col("tokens").alias("theirs"))
    compared = hits.join(of, "item").withColumn("equal", F.zip_with("stretch", F.slice("theirs", F.col("skip") + 1, F.greatest(F.lit(1), F.size("stretch"))), lambda a, b: F.coalesce(a == b, F.lit(False))))
    counted = compared.select("doc_id", "tie", "item_id", F.size(F.filter("equal", lambda e: e)).alias("matched"), F.least(F.lit(WINDOW), F.col("length")).alias("compared"))
    # Partial maxima come first, so the many hits of one pair are one row before they move.
    return counted.where(100 * F.col("matched") >= PERCENT * F.col("compared")).groupBy("doc_id", "tie", "item_id").agg(
        F.max("matched").cast("long").alias("matched"), F.max("compared").cast("long").alias("compared")
    )


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, matched and compared for every text and item that overlap."""
    found = overlaps(docs, benchmark)
    return found.groupBy("doc_id", "item_id").agg(F.max("matched").alias("matched"), F.max("compared").alias("compared"))


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose text overlaps with no item."""
    bad = materialise(overlaps(docs, benchmark).select(F.col("doc_id").alias("i"), F.col("tie").alias("t")).distinct(), "contaminated")
    row = F.struct(*[F.col(c) for c in docs.columns])
    tied = docs.select(F.col("doc_id").alias("of"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"), row.alias("row"))
    return tied.join(bad, F.col("of").eqNullSafe(F.col("i")) & (F.col("tie") == F.col("t")), "left_anti").select("row.*")


ORACLE = f"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '') AS tokens FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '') AS tokens FROM benchmark),
m AS (SELECT unnest([{", ".join(f"'{m}'" for m in MASKS)}]) AS mask),
dp AS (SELECT doc_id, tokens, unnest(range(0, len(tokens) - {LEAST} + 1)) AS pos FROM d WHERE len(tokens) >= {LEAST}),
bp AS (SELECT item_id, tokens, unnest(range(0, len(tokens) - {LEAST} + 1)) AS pos FROM b WHERE len(tokens) >= {LEAST}),
ds AS (SELECT doc_id, pos, mask || ':' || array_to_string([tokens[pos + i] for i in range(1, {_SPAN + 1}) if mask[i] = '1'], ' ') AS key
  FROM dp, m WHERE pos + {_SPAN} <= len(tokens)
  UNION ALL SELECT doc_id, pos, 'w:' || array_to_string(tokens[pos + 1 : pos + n], ' ') FROM dp
    JOIN (SELECT DISTINCT len(tokens) AS n FROM b WHERE len(tokens) BETWEEN {LEAST} AND {_SPAN - 1}) s ON pos + n <= len(tokens)),
bs AS (SELECT item_id, pos, mask || ':' || array_to_string([tokens[pos + i] for i in range(1, {_SPAN + 1}) if mask[i] = '1'], ' ') AS key
  FROM bp, m WHERE pos + {_SPAN} <= len(tokens)
  UNION ALL SELECT item_id, 0, 'w:' || array_to_string(tokens, ' ') FROM b WHERE len(tokens) BETWEEN {LEAST} AND {_SPAN - 1}),
hit AS (SELECT DISTINCT ds.doc_id, bs.item_id, ds.pos - bs.pos AS shift,
    greatest(0, least(bs.pos + {_SPAN // 2 - WINDOW // 2}, len(b.tokens) - {WINDOW})) AS start, least({WINDOW}, len(b.tokens)) AS n
  FROM ds JOIN bs USING (key) JOIN b ON b.item_id = bs.item_id),
found AS (SELECT hit.doc_id, hit.item_id, n,
    len([i for i in range(start + 1, start + n + 1) if i + shift >= 1 AND d.tokens[i + shift] = b.tokens[i]]) AS matched
  FROM hit JOIN d ON d.doc_id = hit.doc_id JOIN b ON b.item_id = hit.item_id)
SELECT doc_id, item_id, CAST(max(matched) AS BIGINT) AS matched, CAST(max(n) AS BIGINT) AS compared FROM found WHERE 100 * matched >= {PERCENT} * n GROUP BY ALL
"""
