"""Mixing sources to target weights by a low-discrepancy schedule.

The words of each source, its documents in shuffled order, form an axis that is repeated as
often as its target asks, cut into blocks of equally many words. Slot ``i`` of the schedule is
the fractional part of ``i`` times the golden ratio, looked up in the cumulative targets; the
``r``-th slot of a source takes its ``r``-th block. Any stretch of the schedule therefore holds
the sources in nearly their target shares, and the mixed documents come in the order of the
slots that hold their first words.

All of it is DataFrame operations. Numbering and prefix sums go over fixed-size buckets and the
totals of the buckets, so that a source that holds most rows is spread over many tasks.

Defined cases: a null text has no words; a null source is a source of its own, last in order;
documents without words are never taken; rows that are equal are separate documents, and rows
that differ only in where a null stands are too, as rows are numbered before they are mixed; an
empty table gives an empty result. Other columns of the input are not read, but carried along.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayposts.llm.text import n_words
from wayposts.sources.shared_folder import materialize, settled

WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
BLOCK_WORDS = 1024

_BITS = 40
_GOLDEN = int(2**_BITS * 0.6180339887498949) | 1
_CELLS = 4096
_SLOTS_A_CHUNK = 4096


def cyclic_weight(place: Column, weights: tuple[int, ...] = WEIGHTS) -> Column:
    """The weight at a place counted from 1, the weights repeating."""
    return F.element_at(
        F.array(*[F.lit(w) for w in weights]), ((place - 1) % len(weights) + 1).cast("int")
    )


def source_targets(
    sizes: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most_repeats: int = MOST_REPEATS,
) -> DataFrame:
    """Targets that share all words by weight, none above ``most_repeats`` times its source.

    ``sizes`` has one row per source: ``source``, ``source_size``. What a source cannot take is
    shared again by weight among the others. Adds ``sid`` (place in code-point order from 1,
    null last), ``weight``, ``target``, and ``low`` and ``high``, its stretch of the cumulative
    targets. The windows hold one row per source.
    """
    placed = sizes.withColumn(
        "sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    ).withColumn("weight", cyclic_weight(F.col("sid"), weights).cast("long"))
    cap = most_repeats * F.col("source_size")
    by_level = Window.orderBy(cap / F.col("weight"), "sid")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy("sid").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    levelled = placed.withColumn(
        "_level", left.cast("double") / F.sum("weight").over(onward)
    ).withColumn("_full", cap / F.col("weight") <= F.col("_level"))
    level = F.max(F.when(~F.col("_full"), F.col("_level"))).over(everything)
    targets = levelled.withColumn(
        "target", F.when(F.col("_full"), cap.cast("double")).otherwise(level * F.col("weight"))
    )
    so_far = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return targets.withColumn("high", F.sum("target").over(so_far)).select(
        "sid",
        "source",
        "source_size",
        "weight",
        "target",
        (F.col("high") - F.col("target")).alias("low"),
        "high",
    )


def point(slot: Column) -> Column:
    """Slot ``i`` as ``i`` times the golden ratio modulo 1, in units of 2**-40, exact."""
    half = 1 << (_BITS // 2)
    high, low = F.floor(slot / half), slot % half
    return ((high * _GOLDEN) % half * half + low * _GOLDEN) % (1 << _BITS)


def schedule(targets: DataFrame, total: int, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The slots of the mix: ``slot``, ``sid`` and ``rank`` of the slot among those of its source.

    A source whose stretch is a slot or two short of its target gets them after the others.
    """
    spark = targets.sparkSession
    cell = lambda at: F.least(F.floor(at / total * _CELLS), F.lit(_CELLS - 1))
    stretches = targets.where("target > 0").select(
        "sid", "low", "high", F.explode(F.sequence(cell(F.col("low")), cell(F.col("high")))).alias("cell")
    )
    n_slots = -(-total // block_words)
    slots = spark.range(n_slots).select(
        F.col("id").alias("slot"), point(F.col("id") + 1).alias("_point")
    )
    at = F.col("_point") / (1 << _BITS) * total
    dealt = (
        slots.withColumn("cell", F.floor(F.col("_point") / ((1 << _BITS) // _CELLS)))
        .join(stretches, "cell")
        .where((at >= F.col("low")) & (at < F.col("high")))
        .select("slot", "sid", F.floor(F.col("slot") / _SLOTS_A_CHUNK).alias("chunk"))
    )
    chunks = dealt.groupBy("sid", "chunk").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = chunks.withColumn("_start", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    inside = Window.partitionBy("sid", "chunk").orderBy("slot")
    ranked = dealt.join(starts, ["sid", "chunk"]).select(
        "slot", "sid", (F.col("_start") + F.row_number().over(inside) - 1).alias("rank")
    )
    needed = targets.where("target > 0").select(
        "sid", F.ceil(F.round("target") / block_words).alias("_needed")
    )
    have = chunks.groupBy("sid").agg(F.sum("n").alias("_have"))
    short = needed.join(have, "sid", "left").select(
        "sid", "_needed", F.coalesce("_have", F.lit(0)).alias("_have")
    )
    # the window holds a few rows per source
    last = short.where("_have < _needed").select(
        "sid", F.explode(F.sequence(F.col("_have"), F.col("_needed") - 1)).alias("rank")
    )
    after = F.row_number().over(Window.orderBy("rank", "sid")) + (n_slots - 1)
    return ranked.unionByName(last.withColumn("slot", after.cast("long")))


def blocks(
    sized: DataFrame, targets: DataFrame, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """The documents along the repeated axes of their sources, cut at the ends of the blocks.

    ``sized`` has ``source``, ``doc_id``, ``size`` and ``order``, a text that shuffles. Returns
    its columns and ``sid``, ``source_size``, ``target``, ``start`` (the document's place on the
    axis), ``pass`` (the repetition of the axis, from 0), ``rank`` (of the block) and ``words`` (of
    the document in it); a document beyond the target gives one row with a null ``rank``.
    """
    placed = sized.join(
        targets.select(F.col("source").alias("_source"), "sid", "source_size", "target"),
        F.col("source").eqNullSafe(F.col("_source")),
    ).drop("_source")
    placed = placed.withColumn("bucket", F.substring("order", 1, 3))
    sums = placed.groupBy("sid", "bucket").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        "sid", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_start")
    )
    inside = (
        Window.partitionBy("sid", "bucket")
        .orderBy("order", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    axis = placed.join(starts, ["sid", "bucket"]).withColumn(
        "start", F.col("_start") + F.sum("size").over(inside) - F.col("size")
    )
    taken = F.round("target").cast("long")
    passes = F.ceil(taken / F.greatest("source_size", F.lit(1)))
    unrolled = axis.withColumn(
        "pass", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(passes - 1, F.lit(0))))
    ).withColumn("_at", F.col("pass") * F.col("source_size") + F.col("start"))
    unrolled = unrolled.withColumn("_end", F.least(F.col("_at") + F.col("size"), taken))
    covered = F.when(
        F.col("_end") > F.col("_at"),
        F.sequence(
            F.floor(F.col("_at") / block_words), F.floor((F.col("_end") - 1) / block_words)
        ),
    )
    cut = unrolled.withColumn("rank", F.explode_outer(covered))
    in_block = F.least("_end", (F.col("rank") + 1) * block_words) - F.greatest(
        "_at", F.col("rank") * block_words
    )
    return cut.select(
        *sized.columns,
        "sid",
        "source_size",
        "target",
        "start",
        "pass",
        "rank",
        F.when(F.col("rank").isNotNull(), in_block).alias("words"),
    )


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most_repeats: int = MOST_REPEATS,
    block_words: int = BLOCK_WORDS,
    *carried: str,
) -> DataFrame:
    """Per document the words that the mix takes of it, repeats counted.

    Columns: ``doc_id``, ``size``, ``source_size``, ``target``, ``taken``, ``first_slot`` (the
    schedule's first slot that holds a word of it), ``slots`` (its first slot in each repetition
    that takes it, null in others) and the ``carried`` columns.
    """
    spark = docs.sparkSession
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    sized = materialize(
        docs.select(
            "doc_id",
            F.col("source").cast("string").alias("source"),
            n_words(F.col("text")).alias("size"),
            order.alias("order"),
            *carried,
        ),
        "mix-sizes",
    )
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialize(source_targets(per_source, weights, most_repeats), "mix-targets")
    total = targets.agg(F.sum("source_size")).first()[0] or 0
    slots = schedule(targets, max(total, 1), block_words).withColumn("_dealt", F.lit(True))
    pieces = blocks(sized, targets, block_words).join(slots, ["sid", "rank"], "left")
    return (
        pieces.groupBy("sid", "start", "doc_id", "size", "source_size", "target", *carried)
        .agg(
            F.coalesce(F.sum(F.when(F.col("_dealt"), F.col("words"))), F.lit(0)).alias("taken"),
            F.min("slot").alias("first_slot"),
            F.array(
                *[F.min(F.when(F.col("pass") == p, F.col("slot"))) for p in range(most_repeats)]
            ).alias("slots"),
        )
        .drop("sid", "start")
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents as often as the mix takes them, whole: words taken over size, rounded.

    Has the columns of ``docs``. Documents taken for less than half go; the others come in the
    order of the schedule, each copy at its first slot, so that any stretch of the result has
    nearly the target shares.
    """
    # written with their numbers, so that these are the same in both reads
    marked = materialize(docs.withColumn("_mix_row", F.monotonically_increasing_id()), "mix-rows")
    copies = F.floor(F.col("taken") / F.greatest("size", F.lit(1)) + 0.5).cast("int")
    plan = settled(
        lambda: mix(marked, WEIGHTS, MOST_REPEATS, BLOCK_WORDS, "_mix_row")
        .select(F.col("_mix_row").alias("_mix_of"), "slots", "first_slot", copies.alias("_mix_copies"))
        .where("_mix_copies > 0"),
        "mix-plan",
    )
    slot = F.coalesce(F.get("slots", F.col("_mix_copy") - 1), F.col("first_slot"))
    dealt = (
        plan.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies"))))
        .select("_mix_of", "_mix_copy", slot.alias("_mix_slot"))
    )
    # by shuffle at every size, as the plan names nearly all documents
    return (
        marked.join(dealt.hint("merge"), F.col("_mix_row") == F.col("_mix_of"))
        .orderBy("_mix_slot", "_mix_row", "_mix_copy")
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
