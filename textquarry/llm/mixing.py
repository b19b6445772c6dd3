"""Mixing sources to target weights with column expressions alone.

The words of a source's documents lie end to end and are packed into blocks of `block_words`. Each source gets as
many output slots as its target needs. How many of them an output shard gets is drawn: every slot is thrown into a shard, so
the counts of a source over the shards are multinomial, and those of a shard over the sources too, given its size and the
sources' totals. The counts alone go on. Prefix sums over the shards give each shard a run of slot numbers of each source. Slot j of a source
takes block p(j) of the source, p being a pseudorandom permutation of its block numbers; beyond the last block the next
epoch begins. Slots and blocks meet in a join on source and block number. The last slot of a source is cut, so that the
words taken are the target, rounded. The shards are written, a row per slot with the pieces of documents packed
in its block, and what the mix takes of a document is counted from these files.

Nothing is gathered by source: positions and slot numbers are prefix sums over buckets of about the square root of all rows, and
blocks spread evenly, also if one source or one document holds most words.

Defined cases: a null text has no words; a document without words is taken 0 times; null sources are one source,
the last in order; rows with one doc_id, repeated rows as well, are mixed each on its own; an empty table gives an
empty mix; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textquarry.sources.staging import staged, written_once

WORD = r"[^\x20\x09-\x0D]+"
#: A word with the white space before it.
PIECE = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
BLOCK_WORDS = 256
SHARD_SLOTS = 4096
#: Slots that one row stands for before they are spread.
_RUN = 1 << 16


def _source_key() -> Column:
    return F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), F.col("source")))


def sized(docs: DataFrame, *keys: str) -> DataFrame:
    """doc_id, source, size and the columns named, without texts."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", "source", F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), *keys)


def targets(
    sizes: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """A row per source: its size, target, blocks and slots.

    Weights repeat over the sources by code point, null last. Targets divide `share` times all words by weight; none
    exceeds `most` times its source's words, and what is cut off is divided among the others in the same way. In the
    order of most / weight, the capped sources are a prefix, so one pass finds the level of the others.
    """
    every = Window.partitionBy(F.lit(0))
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = every.orderBy(F.col("source").isNull(), "source")
    listed = F.array(*(F.lit(float(w)) for w in weights))
    ranked = per_source.withColumn("at", F.row_number().over(order) - 1).withColumn(
        "weight", F.element_at(listed, (F.col("at") % len(weights) + 1).cast("int"))
    )
    capped = ranked.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    by_ratio = every.orderBy(F.col("cap") / F.col("weight"), "at")
    filled = (
        capped.withColumn("step", F.row_number().over(by_ratio))
        .withColumn("all_words", F.sum("source_size").over(every) * F.lit(float(share)))
        .withColumn("before", F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("weight_left", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("all_words") - F.col("before")) / F.col("weight_left"))
        .withColumn(
            "free",
            F.min(F.when(F.col("weight") * F.col("level") < F.col("cap"), F.struct("step", "level"))).over(every),
        )
        .withColumn(
            "target",
            F.when(F.col("free").isNull() | (F.col("step") < F.col("free.step")), F.col("cap")).otherwise(
                F.col("weight") * F.col("free.level")
            ),
        )
    )
    size, goal = F.col("source_size"), F.col("goal")
    return (
        filled.withColumn("goal", F.round("target").cast("long"))
        .withColumn("full_blocks", F.floor(size / block_words))
        .withColumn("blocks", F.ceil(size / block_words))
        .withColumn("epochs", F.when(size > 0, F.floor(goal / size)).otherwise(0))
        .withColumn("rest", goal - F.col("epochs") * size)
        .withColumn("slots", F.col("epochs") * F.col("blocks") + F.ceil(F.col("rest") / block_words))
        .withColumn("cut", F.when(F.col("rest") > 0, (F.col("rest") - 1) % block_words + 1))
        .select(
            "source", _source_key().alias("source_key"), "source_size", "target", "full_blocks", "blocks", "slots", "cut"
        )
    )


def placed(sizes: DataFrame) -> DataFrame:
    """Adds source_key and start, the words of the source before the document.

    Within a bucket and over the buckets of a source, a window each; both hold about the square root of all rows.
    """
    rows = sizes.count()
    buckets = max(1, int(rows**0.5))
    spread = sizes.withColumn("source_key", _source_key()).withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int")
    )
    before = Window.unboundedPreceding
    inside = Window.partitionBy("source_key", "bucket").orderBy("doc_id", "size").rowsBetween(before, -1)
    over = Window.partitionBy("source_key").orderBy("bucket").rowsBetween(before, -1)
    offsets = (
        spread.groupBy("source_key", "bucket")
        .agg(F.sum("size").alias("words"))
        .withColumn("offset", F.coalesce(F.sum("words").over(over), F.lit(0)))
        .drop("words")
    )
    within = spread.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return (
        within.join(offsets, ["source_key", "bucket"])
        .withColumn("start", F.col("offset") + F.col("within"))
        .drop("bucket", "offset", "within")
    )


def permuted(x: Column, n: Column, key: Column, seed: int) -> Column:
    """A pseudorandom permutation of 0 .. n - 1, other for each key.

    Four Feistel rounds over pairs of digits to the base ceil(sqrt(n)); results of n or more are put in again until
    they fall below, which takes one step mostly and 24 at the very most up to n = 100; for larger n more than that is
    practically impossible and would be an error, not a wrong result.
    """
    base = F.ceil(F.sqrt(n.cast("double"))).cast("long")

    def once(value: Column) -> Column:
        left, right = F.floor(value / base).cast("long"), value % base
        for turn in range(4):
            left, right = right, (left + F.pmod(F.xxhash64(right, key, F.lit(seed * 4 + turn)), base)) % base
        return left * base + right

    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(24)), once(x), lambda value, _: F.when(value < n, value).otherwise(once(value))
    )
    first = once(x)
    return (
        F.when(first < n, first)
        .when(walked < n, walked)
        .otherwise(F.raise_error(F.lit("no block number found")).cast("long"))
    )


def shard_counts(plan: DataFrame, shard_slots: int = SHARD_SLOTS, seed: int = 1) -> DataFrame:
    """The draw: shard, source_key and how many slots of the source the shard gets; rows of 0 are left out.

    plan: rows of targets(). Shards have `shard_slots` slots in expectation; slots are counted per task before any shuffle.
    """
    total = plan.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    shards = max(1, -(-total // shard_slots))
    runs = plan.filter("slots > 0").select(
        "source_key", "slots", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / _RUN))).alias("run")
    )
    spread = runs.repartition(max(1, -(-total // _RUN)), "source_key", "run")
    first = F.col("run") * _RUN
    each = spread.select("source_key", F.explode(F.sequence(first, F.least(first + _RUN, F.col("slots")) - 1)).alias("slot"))
    thrown = F.pmod(F.xxhash64("source_key", "slot", F.lit(seed)), F.lit(shards))
    return each.groupBy(thrown.alias("shard"), "source_key").agg(F.count(F.lit(1)).alias("slots"))


def numbered(counts: DataFrame) -> DataFrame:
    """Adds first: the slots of the source in all shards before this one. counts is read twice."""
    shards = counts.agg(F.coalesce(F.max("shard"), F.lit(0))).first()[0] + 1
    grouped = counts.withColumn("group", F.floor(F.col("shard") / max(1, int(shards**0.5))))
    before = Window.unboundedPreceding
    inside = Window.partitionBy("source_key", "group").orderBy("shard").rowsBetween(before, -1)
    over = Window.partitionBy("source_key").orderBy("group").rowsBetween(before, -1)
    offsets = (
        grouped.groupBy("source_key", "group")
        .agg(F.sum("slots").alias("in_group"))
        .withColumn("offset", F.coalesce(F.sum("in_group").over(over), F.lit(0)))
        .drop("in_group")
    )
    within = grouped.withColumn("within", F.coalesce(F.sum("slots").over(inside), F.lit(0)))
    return within.join(offsets, ["source_key", "group"]).select(
        "shard", "source_key", F.col("slots").alias("drawn"), (F.col("offset") + F.col("within")).alias("first")
    )


def slots(plan: DataFrame, counts: DataFrame, block_words: int = BLOCK_WORDS, seed: int = 1) -> DataFrame:
    """A row per output slot: shard, position, source_key, slot, epoch, block and the words taken of the block.

    plan: rows of targets(); counts: those of shard_counts(), written once. By position the slots of a shard are in random
    order. The short last block of a source is the last of each epoch.
    """
    total = plan.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    drawn = numbered(counts).repartition(max(1, -(-total // _RUN)), "source_key", "shard")
    by_source = F.broadcast(plan) if _small(plan) else plan
    numbers = F.sequence("first", F.col("first") + F.col("drawn") - 1)
    each = drawn.join(by_source, "source_key").select("*", F.explode(numbers).alias("slot"))
    inside = F.col("slot") % F.col("blocks")
    short = F.col("source_size") - F.col("full_blocks") * block_words
    length = F.when(F.col("block") < F.col("full_blocks"), block_words).otherwise(short)
    return (
        each.withColumn("epoch", F.floor(F.col("slot") / F.col("blocks")))
        .withColumn(
            "block",
            F.when(
                inside < F.col("full_blocks"),
                permuted(inside, F.col("full_blocks"), F.struct("source_key", "epoch"), seed),
            ).otherwise(inside),
        )
        .withColumn("taken_words", F.when(F.col("slot") == F.col("slots") - 1, F.coalesce("cut", length)).otherwise(length))
        .withColumn("position", F.xxhash64("shard", "source_key", "slot"))
        .select("shard", "position", "source_key", "slot", "epoch", "block", F.col("taken_words").cast("long"))
    )


def segments(places: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """A row per document and block that it has words in; first: the word of the block at which it begins there."""
    end = F.col("start") + F.col("size")
    block = F.explode(F.sequence(F.floor(F.col("start") / block_words), F.floor((end - 1) / block_words)))
    low, high = F.col("block") * block_words, (F.col("block") + 1) * block_words
    return (
        places.filter("size > 0")
        .select("*", block.alias("block"))
        .withColumn("first", F.greatest("start", low) - low)
        .withColumn("last", F.least(end, high) - low)
        .withColumn("offset", low + F.col("first") - F.col("start"))
    )


def taken(parts: DataFrame, drawn: DataFrame) -> DataFrame:
    """Segments that slots take: one row for each segment and slot, words being how many of its words."""
    words = F.least("last", F.col("taken_words")) - F.col("first")
    # Estimates do not see how many slots a source has, and would have them broadcast.
    return parts.join(drawn.hint("merge"), ["source_key", "block"]).withColumn("words", words).filter("words > 0")


def packed(parts: DataFrame, drawn: DataFrame) -> DataFrame:
    """The shards: a row per slot, and in it the pieces of documents that its block holds, in their order.

    parts: rows of segments(); drawn: those of slots(). A block holds at most as many pieces as words. A piece names its
    document, the place where that begins in its source, the word it begins with and how many words it has.
    """
    pieces = F.struct("first", "doc_id", "start", "offset", (F.col("last") - F.col("first")).alias("words"))
    blocks = parts.groupBy("source_key", "block").agg(F.sort_array(F.collect_list(pieces)).alias("pieces"))

    def cut(p: Column) -> Column:
        words = F.least(p.words, F.col("taken_words") - p["first"])
        return F.struct(p.doc_id.alias("doc_id"), p.start.alias("start"), p.offset.alias("offset"), words.alias("words"))

    held = F.transform(F.filter("pieces", lambda p: p["first"] < F.col("taken_words")), cut)
    # Estimates do not see how many slots a source has, and would have them broadcast.
    return (
        blocks.join(drawn.hint("merge"), ["source_key", "block"])
        .select("shard", "position", "source_key", "slot", "epoch", "block", held.alias("pieces"))
        .repartition("shard")
        .sortWithinPartitions("shard", "position")
    )


def mixed_words(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    block_words: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
    seed: int = 1,
) -> DataFrame:
    """doc_id, source, size, source_size, target and taken: the words that the written shards hold of each document."""
    with staged(docs.sparkSession) as copies:
        places = copies.written_once(placed(copies.written_once(sized(docs), "sizes")), "places")
        plan = copies.written_once(targets(places, weights, share, most, block_words), "targets")
        counts = copies.written_once(shard_counts(plan, shard_slots, seed), "draws")
        drawn = slots(plan, counts, block_words, seed)
        shards = copies.written_once(packed(segments(places, block_words), drawn), "shards")
        sums = (
            shards.select("source_key", F.explode("pieces").alias("piece"))
            .groupBy("source_key", "piece.start")
            .agg(F.sum("piece.words").alias("taken"))
            .withColumn("size_key", F.lit(True))
        )
        by_source = plan.select("source_key", "source_size", "target")
        mix = (
            places.withColumn("size_key", F.col("size") > 0)
            .join(sums.hint("merge"), ["source_key", "start", "size_key"], "left")
            .join(F.broadcast(by_source) if _small(by_source) else by_source, "source_key")
            .select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
        )
        return written_once(mix, "mix")


def _small(by_source: DataFrame) -> bool:
    """Whether a table of sources may be broadcast: 10,000 rows at most; otherwise it is joined by shuffle."""
    return by_source.limit(10_001).count() <= 10_000


def mixed_texts(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    block_words: int = BLOCK_WORDS,
    seed: int = 1,
) -> DataFrame:
    """The mix as documents: what one epoch takes of a document is one row, with the columns of `docs`.

    A document taken whole keeps its text as it is; one taken in part has the taken words with the white space before
    them, in their order. Documents without words are in no block and so not in the mix. n_chars, if there, is the
    length of the new text.
    """
    columns = docs.columns
    keyed = docs.select("doc_id", "source", "text", F.struct(*columns).alias("_doc"), F.xxhash64(*columns).alias("_row"))
    places = written_once(placed(written_once(sized(keyed, "_row"), "sizes")), "places")
    plan = written_once(targets(places, weights, share, most, block_words), "targets")
    counts = written_once(shard_counts(plan, seed=seed), "draws")
    cuts = (
        taken(segments(places, block_words), slots(plan, counts, block_words, seed))
        .groupBy("source_key", "start", "doc_id", "_row", "size", "epoch")
        .agg(F.sort_array(F.collect_list(F.struct("offset", "words"))).alias("cuts"), F.sum("words").alias("words"))
        .withColumnRenamed("doc_id", "_doc_id")
        .withColumnRenamed("_row", "_key")
    )
    # Rows alike in all columns have places of their own; the first of them stands for the text of all.
    texts = keyed.dropDuplicates(["doc_id", "_row"]) if _repeated(places) else keyed
    pieces = F.regexp_extract_all("text", F.lit(PIECE), 0)
    parts = F.transform("cuts", lambda c: F.array_join(F.slice(F.col("pieces"), c.offset.cast("int") + 1, c.words.cast("int")), ""))
    joined = (
        texts.join(cuts.hint("merge"), F.col("_doc_id").eqNullSafe(F.col("doc_id")) & (F.col("_key") == F.col("_row")))
        .withColumn("pieces", F.when(F.col("words") < F.col("size"), pieces))
        .withColumn("mixed", F.when(F.col("words") == F.col("size"), F.col("text")).otherwise(F.array_join(parts, "")))
    )
    new = {"text": F.col("mixed")}
    if "n_chars" in columns:
        new["n_chars"] = F.length("mixed").cast(docs.schema["n_chars"].dataType)
    return joined.select(*(new.get(c, F.col("_doc").getField(c)).alias(c) for c in columns))


def _repeated(places: DataFrame) -> bool:
    return bool(places.groupBy("doc_id", "_row").count().filter("count > 1").limit(1).count())
