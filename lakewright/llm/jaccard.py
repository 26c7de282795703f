"""Similarity join of texts on word n-grams: a sparse matrix product, in blocks of columns.

Rows of the matrix are classes of texts with equal n-gram sets, columns are n-grams.
Spark deals out the columns; each block of columns adds its part of the overlap of
every pair of rows in it. Bounds that follow from sizes keep the product sparse, and
none loses a pair at or above the limit: sizes must lie within the limit of each other;
only the first columns of a row in a common order take part, as many as its size
leaves room to differ, and :func:`extra` more, and fewer of the smaller row of a pair; the
overlap in these must exceed what the smaller row brings extra; and as all columns fall into ``BLOCKS``
blocks by hash, the smaller counts of two rows, summed over the blocks, must reach the
overlap that the limit needs. What is left is counted exactly on the whole texts.

The common order puts n-grams that many texts hold last. It comes from counts of all
texts in a fixed number of hash buckets; any order gives the same links, a good one gives
fewer candidates.

Columns are dealt into blocks by the smallest class that holds them, so the columns that a family of
like texts shares mostly meet in one block, which tells a pair once and not once a column. Only
columns that very many rows hold are joined row by row.

Links form components, so not all of them are needed. In ``ROUNDS`` rounds every row is
compared with a few of those that lead a column among rows of about one size, the ones that
share most columns with it: with one in the first round, and with ``MORE`` times as many, of
as many more leaders, in each further one, where only columns are left whose rows are not
all connected. The product then leaves out pairs that are connected by that. Copies are
thus never expanded into all pairs, and no link between different components is lost.

Words are lower-cased (A-Z only). A text with fewer words than ``n`` has one n-gram,
all its words; one without words or a null text has none and links with nothing. Rows
with equal ids count one by one; a component's id is the smallest id in it, nulls left
out. Extra columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewright.llm.components import components
from lakewright.llm.words import U64, Hasher, column, mix, slices, windows
from lakewright.session import materialise

N = 4
PERCENT = 85
#: Columns more than needed that take part, and so overlaps more than one that a pair must have in them; one more for so many n-grams.
EXTRA, EVERY = 4, 100
#: Blocks of columns whose counts bound the overlap of two rows.
BLOCKS = 128
#: Rounds of leaders, and how many times more of them there are in each.
ROUNDS, MORE = 3, 8
#: Counters of the order of columns (a power of two), and parts they are summed in.
COUNTERS = 1 << 22
PARTS = 256
#: Columns of up to so many rows are multiplied in blocks of about so many entries; others are joined.
BLOCK_ROWS, BLOCK_ENTRIES = 1024, 50_000
#: Pairs of entries that a block looks at in one step.
STEP_PAIRS = 1 << 20
#: Classes (about 50 bytes each) whose texts are picked out by a broadcast list; more are joined by hash.
BROADCAST_CLASSES = 500_000


def shingles(hasher: Hasher, texts: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted distinct n-grams of each text."""
    words, first = hasher.words(texts)
    runs = windows(words, n)
    out = []
    for a, b in zip(first.tolist(), first[1:].tolist(), strict=False):
        if b - a >= n:
            out.append(np.unique(runs[a : b - n + 1]))
        elif b > a:
            out.append(windows(words[a:b], b - a))
        else:
            out.append(np.empty(0, U64))
    return out


def least_overlap(a: Column, b: Column, percent: int) -> Column:
    """The overlap from which sets of two sizes reach the limit."""
    return F.ceil((a + b) * percent / F.lit(100 + percent) - F.lit(1e-9))


def extra(size):
    """Columns beyond those needed that a row of some size brings; more for long rows, which share more by chance."""
    return EXTRA + size // EVERY


def extra_of(size: Column) -> Column:
    return EXTRA + F.floor(size / EVERY)


def column_order(docs: DataFrame, n: int = N) -> np.ndarray:
    """How many texts hold an n-gram of each hash bucket, from all texts; ``COUNTERS`` numbers whatever the input.

    Every task counts by itself; its counters are cut into parts, and each part is summed as it comes in.
    """
    size, schema = COUNTERS // PARTS, pa.schema([("part", pa.int32()), ("counts", pa.binary())])

    def row(part, counts):
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([pa.compress(counts.tobytes(), codec="zstd", asbytes=True)], pa.binary())], schema=schema)

    def counted(batches):
        hasher, total = Hasher(), np.zeros(COUNTERS, np.uint32)
        for batch in slices(batches, "text"):
            grams = np.concatenate(shingles(hasher, column(batch, "text"), n))
            total += np.bincount(bucket(grams), minlength=COUNTERS).astype(np.uint32)
        for part, counts in enumerate(total.reshape(PARTS, size)):
            if counts.any():
                yield row(part, counts)

    def summed(batches):
        total = {}
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts = np.frombuffer(pa.decompress(counts, decompressed_size=4 * size, codec="zstd", asbytes=True), np.uint32)
                total[part] = total[part] + counts if part in total else counts
        yield from (row(part, counts) for part, counts in total.items())

    parts = docs.select("text").mapInArrow(counted, "part int, counts binary").repartition("part").mapInArrow(summed, "part int, counts binary")
    order = np.zeros((PARTS, size), np.uint32)
    for r in parts.collect():
        order[r.part] += np.frombuffer(pa.decompress(bytes(r.counts), decompressed_size=4 * size, codec="zstd", asbytes=True), np.uint32)
    return order.ravel()


def bucket(grams: np.ndarray) -> np.ndarray:
    return (grams >> U64(64 - COUNTERS.bit_length() + 1)).astype(np.int64)


def sets(docs: DataFrame, order: np.ndarray, n: int = N, percent: int = PERCENT) -> DataFrame:
    """doc_id, tie (of the text), n_shingles, the class (equal sets, null without any), the columns that take part, in
    order, and how many columns each block holds, in steps of ``step`` and rounded up."""
    # The order goes along with the tasks, and the driver keeps what it sends: mostly zeros and small numbers.
    packed = pa.compress(pa.py_buffer(order), codec="zstd", asbytes=True)

    def measured(batches):
        hasher, order = Hasher(), np.frombuffer(pa.decompress(packed, decompressed_size=4 * COUNTERS, codec="zstd"), np.uint32)
        for batch in slices(batches, "text"):
            size, kind, columns, counts, steps = [], [], [], [], []
            for found in shingles(hasher, column(batch, "text"), n):
                m = len(found)
                size.append(m)
                if not m:
                    kind.append(None)
                    columns.append(None)
                    counts.append(None)
                    steps.append(None)
                    continue
                held = np.bincount((mix(found) >> U64(57)).astype(np.int64), minlength=BLOCKS)
                step = 1 << max(0, int(held.max()).bit_length() - 7)
                if held.max() > 127 * step:
                    step *= 2
                counts.append((-(-held // step)).astype(np.int8))
                steps.append(step)
                ranks = np.arange(1, m + 1, dtype=U64)
                kind.append(int(np.bitwise_xor.reduce(mix(found * ranks)).astype(np.int64)) ^ m)
                first = min(m, m - -(-percent * m // 100) + 1 + extra(m))
                columns.append(found[np.lexsort((found, order[bucket(found)]))[:first]].view(np.int64))
            yield pa.record_batch(
                [column(batch, "doc_id"), column(batch, "tie"), pa.array(size, pa.int64()), pa.array(kind, pa.int64()), pa.array(columns, pa.list_(pa.int64())), pa.array(counts, pa.list_(pa.int8())), pa.array(steps, pa.int64())],
                ["doc_id", "tie", "n_shingles", "class", "columns", "counts", "step"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    tied = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"))
    return tied.mapInArrow(measured, f"doc_id {id_type}, tie long, n_shingles long, class long, columns array<long>, counts array<tinyint>, step long")


def verified(pairs: DataFrame, texts: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """The pairs of classes a, b that reach the limit, counted on one whole text of each; ``texts``: class, text."""

    def counted(batches):
        hasher, last, mine = Hasher(), None, None
        for batch in slices(batches, "right"):
            a, b = column(batch, "a"), column(batch, "b")
            left = column(batch, "left")
            keep = np.zeros(batch.num_rows, bool)
            for i, other in enumerate(shingles(hasher, column(batch, "right"), n)):
                if a[i].as_py() != last:
                    last, mine = a[i].as_py(), shingles(hasher, left.slice(i, 1), n)[0]
                both = len(np.intersect1d(mine, other, assume_unique=True))
                keep[i] = both > 0 and 100 * both >= percent * (len(mine) + len(other) - both)
            yield pa.record_batch([a, b], ["a", "b"]).filter(pa.array(keep))

    left = texts.select(F.col("class").alias("a"), F.col("text").alias("left"))
    right = texts.select(F.col("class").alias("b"), F.col("text").alias("right"))
    return pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "left", "right").mapInArrow(counted, "a long, b long")


def block_product(percent: int = PERCENT, step_pairs: int = STEP_PAIRS):
    """A function of the entries of a block of whole columns (gram, class, size, root, first): every pair of rows in different
    components and within the size limit of each other, smaller one first, and how many columns it shares in the block.
    Only columns that are among the first of the smaller row count."""

    def multiplied(table: pa.Table) -> pa.Table:
        gram, kind, size, root, first = (column(table, c).to_numpy(zero_copy_only=False) for c in ("gram", "class", "size", "root", "first"))
        # The rows of a column lie together, in the order of sizes, then classes.
        kinds, row = np.unique(kind, return_inverse=True)
        by = np.lexsort((row, size, gram))
        gram, row, size, root, first = gram[by], row[by], size[by], root[by], first[by]
        starts = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]])
        many = np.diff(np.r_[starts, len(gram)])
        keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        for k in np.unique(many[many > 1]).tolist():
            low, high = np.triu_indices(k, 1)
            at = starts[many == k]
            step = max(1, step_pairs // len(low))
            for i in range(0, len(at), step):
                a, b = (at[i : i + step, None] + low).ravel(), (at[i : i + step, None] + high).ravel()
                keep = first[a] & (root[a] != root[b]) & (100 * size[a] >= percent * size[b])
                found, times = np.unique(row[a[keep]] * len(kinds) + row[b[keep]], return_counts=True)
                keys, where = np.unique(np.r_[keys, found], return_inverse=True)
                counts = np.bincount(where, weights=np.r_[counts, times], minlength=len(keys)).astype(np.int64)
        size_of = np.zeros(len(kinds), np.int64)
        size_of[row] = size
        a, b = np.divmod(keys, max(1, len(kinds)))
        return pa.table([kinds[a], kinds[b], size_of[a], size_of[b], counts], ["class_a", "class_b", "size_a", "size_b", "shared"])

    return multiplied


def links(rows: DataFrame, docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """Class and root for every class that links with another; ``rows`` are :func:`sets`, written once."""
    filled = rows.where("class is not null")
    whole = filled.groupBy("class").agg(F.min(F.struct("doc_id", "tie", "counts", "step")).alias("of"), F.max("n_shingles").alias("size"))
    whole = materialise(whole.select("class", "size", "of.*"), "classes")
    key = whole.select(F.col("class").alias("c"), F.col("doc_id").alias("i"), F.col("tie").alias("t"))
    same = (F.col("class") == F.col("c")) & F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("tie") == F.col("t"))
    # Equal rows may stand for their class together; distinct() below keeps one entry of each column.
    one = filled.join(key, same).select("class", F.posexplode("columns").alias("place", "gram"))
    # Both sides of the join read one shuffle, as the sum reads all columns, too.
    one = one.repartition("gram")
    shared = one.groupBy("gram").agg(F.min("class").alias("low"), F.max("class").alias("high"), F.max("place").alias("last")).where("low < high AND last >= 0").select("gram")
    entries = one.join(shared, "gram").distinct().join(whole.select("class", "size"), "class")
    entries = materialise(entries.select("gram", "place", "class", "size"), "entries")
    sizes = whole.select("class", "size", "counts", "step")

    texts = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"))

    def texts_of(pairs: DataFrame) -> DataFrame:
        wanted = materialise(pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class"))).distinct().join(whole.select("class", "doc_id", "tie"), "class"), "wanted")
        wanted = wanted.select("class", F.col("doc_id").alias("i"), F.col("tie").alias("t"))
        wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_CLASSES else wanted
        found = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("tie") == F.col("t")))
        return found.groupBy("class").agg(F.first("text").alias("text"))

    def side(name: str) -> list[Column]:
        return [F.col(c).alias(f"{c}_{name}") for c in ("class", "size", "counts", "step")]

    a, b = F.col("size_a"), F.col("size_b")
    both = F.zip_with("counts_a", "counts_b", lambda x, y: F.least(x * F.col("step_a"), y * F.col("step_b")))
    possible = (100 * F.least(a, b) >= percent * F.greatest(a, b)) & (F.aggregate(both, F.lit(0).cast("long"), lambda x, y: x + y) >= least_overlap(a, b, percent))

    def apart(rows: DataFrame, known: DataFrame) -> DataFrame:
        """The rows of columns that are not all connected yet, with their roots; a column that is stays so."""
        known = known.select(F.col("node").alias("class"), F.col("root").alias("known"))
        joined = rows.join(known, "class", "left").withColumn("root", F.coalesce("known", "class")).drop("known")
        several = joined.groupBy("gram").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("gram")
        return materialise(joined.join(several, "gram"), "open")

    def grown(known: DataFrame | None, links: DataFrame) -> DataFrame:
        """Components of the links and of those found before, which go in as stars."""
        return components(links if known is None else links.unionByName(known.select(F.col("node").alias("a"), F.col("root").alias("b"))))

    known, open_ = None, entries.withColumn("root", F.col("class"))
    for turn in range(ROUNDS):
        rows = open_.withColumn("about", F.floor(F.log("size") / F.log(F.lit(100 / percent)) + turn / ROUNDS))
        mark = F.xxhash64(F.lit(turn), "class")
        leads = rows.groupBy("gram", "about", F.pmod(mark, F.lit(MORE**turn)).alias("deal")).agg(F.min_by("class", mark).alias("a"), F.min_by("root", mark).alias("root_a"))
        # Of a linked row and one without links only the latter looks for the other.
        useful = (F.col("root") != F.col("root_a")) & ((F.col("class") == F.col("root")) | (F.col("a") != F.col("root_a")))
        led = rows.join(leads.drop("deal"), ["gram", "about"]).where(useful).groupBy(F.col("class").alias("b"), "a").agg(F.count("*").alias("shared"))
        # A row has at most its columns times MORE**turn leaders; it keeps MORE**turn, before sizes and counts are looked up.
        most = F.slice(F.sort_array(F.collect_list(F.struct("shared", "a")), asc=False), 1, MORE**turn)
        led = led.groupBy("b").agg(most.alias("most")).select(F.explode("most.a").alias("a"), "b")
        led = led.join(sizes.select(*side("a")), F.col("a") == F.col("class_a")).join(sizes.select(*side("b")), F.col("b") == F.col("class_b")).where(possible)
        best = materialise(led.select("a", "b"), "pairs")
        found = materialise(verified(best, texts_of(best), n, percent), "links")
        if found.isEmpty():
            break
        known = grown(known, found)
        open_ = apart(open_, known)

    # The product over columns whose rows are not all connected by then.
    first = F.col("place") <= F.col("size") - least_overlap(F.col("size"), F.col("size"), percent) + extra_of(F.col("size"))
    held = open_.groupBy("gram").agg(F.min("class").alias("low"), F.count("*").alias("held"))
    blocks = F.lit(max(1, -(-open_.count() // BLOCK_ENTRIES)))
    open_ = open_.select("gram", "class", "size", "root", first.alias("first")).join(held, "gram")
    dealt = open_.where(F.col("held") <= BLOCK_ROWS).withColumn("block", F.pmod(F.xxhash64("low"), blocks))
    product = dealt.groupBy("block").applyInArrow(block_product(percent), "class_a long, class_b long, size_a long, size_b long, shared long")
    often = open_.where(F.col("held") > BLOCK_ROWS)
    left, right = often.where("first").drop("low", "held", "first"), often.drop("low", "held", "first")
    left, right = (t.select("gram", *[F.col(c).alias(f"{c}_{name}") for c in ("class", "size", "root")]) for t, name in ((left, "a"), (right, "b")))
    left = left.join(sizes.select(*side("a")).drop("size_a"), "class_a")
    right = right.join(sizes.select(*side("b")).drop("size_b"), "class_b")
    smaller = (a < b) | ((a == b) & (F.col("class_a") < F.col("class_b")))
    rest = left.join(right, "gram").where(smaller & (F.col("root_a") != F.col("root_b")) & possible)
    rest = rest.groupBy("class_a", "class_b", "size_a", "size_b").agg(F.count("*").alias("shared"))
    enough = F.col("shared") >= F.least(extra_of(a) + 1, least_overlap(a, b, percent))
    product = product.unionByName(rest).groupBy("class_a", "class_b", "size_a", "size_b").agg(F.sum("shared").alias("shared")).where(enough).select("class_a", "class_b")
    product = product.join(sizes.select(*side("a")), "class_a").join(sizes.select(*side("b")), "class_b").where(possible)
    pairs = materialise(product.select(F.col("class_a").alias("a"), F.col("class_b").alias("b")), "pairs")
    return grown(known, verified(pairs, texts_of(pairs), n, percent))


def rooted(docs: DataFrame, n: int = N, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """The :func:`sets` of ``docs``, and of those with words doc_id, tie, n_shingles, class and root."""
    rows = materialise(sets(docs, column_order(docs, n), n, percent), "sets")
    roots = links(rows, docs, n, percent).withColumnRenamed("node", "class")
    slim = rows.drop("columns", "counts", "step").where("class is not null")
    return rows, slim.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))


def similar_texts(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, tie (hash of the text), n_shingles, root (a class of
    the component, which differs also where ids repeat; null without words) and component_id."""
    rows, slim = rooted(docs, n, percent)
    least = slim.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    found = slim.join(least, "root").select("doc_id", "tie", "n_shingles", "root", "component_id")
    alone = rows.where("class is null").select("doc_id", "tie", "n_shingles", F.col("class").alias("root"), F.col("doc_id").alias("component_id"))
    return found.unionByName(alone)


def keep_one(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, all columns, but for one row of each component; rows without words all stay.

    The smallest id stays, and of equal ids the smallest text hash and then any.
    """
    _, found = rooted(docs, n, percent)
    first = found.groupBy("root").agg(F.min(F.struct(F.isnull("doc_id"), "doc_id", "tie")).alias("of"))
    row = F.struct(*[F.col(c) for c in docs.columns])
    tied = docs.select(F.col("doc_id").alias("i"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("t"), row.alias("row"))
    kept = tied.join(first.select("of.doc_id", "of.tie"), F.col("i").eqNullSafe(F.col("doc_id")) & (F.col("t") == F.col("tie")), "left_semi")
    empty = docs.where(~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]"))
    one = kept.groupBy("i", "t").agg(F.first("row").alias("row")).select("row.*")
    return one.unionByName(empty)
