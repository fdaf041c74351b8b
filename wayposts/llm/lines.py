"""Line dedup: runs of lines that occurred before are deleted, found by prefix doubling.

The corpus is a sequence of line ids, cut at the ends of documents. Prefix doubling names the
runs of 1, 2, 4, ... lines: two runs get the same name if they are equal, and the name is the
place of the first of them. The name of a run of any length between two powers is the pair of
names of its first and last power-of-two lines; runs with the same pair form an interval of
the suffix array with that common prefix. A line is deleted if it lies in a run of at least
``min_words`` words that occurs earlier, in the order of ``doc_id`` and line. Such a run has a
part that still covers the line and cannot be shortened at one of its ends, so only the
shortest runs from each line forward and backward need names, which bounds the doubling.

All of it is DataFrame operations. Lines that occur once are dropped at the first step. Equal
runs are counted before the shuffle, and the rows look up their names by a join that adaptive
execution can split, so a line that is in every document is no hot spot.

Defined cases: lines without words are no part of a run and are never deleted; a null text
stays null; a null ``doc_id`` comes last; rows with equal ``doc_id`` and text are one document
listed twice and get the same result; other columns are kept as they are.
"""

from math import floor, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayposts.llm.text import has_word, let, n_words, whole
from wayposts.sources.shared_folder import materialize, release, settled

MIN_WORDS = 50


def document_key(docs: DataFrame) -> Column:
    """A document's place: null ids last, then the id, then a hash of the text."""
    return F.struct(
        F.col("doc_id").isNull().alias("none"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
        F.xxhash64(whole(F.col("text"))).alias("hash"),
    )


def line_table(docs: DataFrame) -> DataFrame:
    """One row per line with a word: ``doc``, ``i`` among those lines, ``at`` in the text, its
    128-bit id ``h1``, ``h2`` and its number of words ``wc``."""
    lines = F.filter(
        F.transform(
            F.split(whole(F.col("text")), "\n"),
            lambda line, at: F.struct(
                at.alias("at"),
                F.xxhash64(line).alias("h1"),
                F.xxhash64(F.lit(1), line, F.lit(2)).alias("h2"),
                n_words(line).alias("wc"),
            ),
        ),
        lambda x: x["wc"] > 0,
    )
    keyed = docs.select(document_key(docs).alias("doc"), lines.alias("rows"))
    return keyed.select("doc", F.posexplode("rows").alias("i", "row")).select("doc", "i", "row.*")


def with_runs(lines: DataFrame, min_words: int) -> DataFrame:
    """``lines`` once each, with the lengths ``forward`` and ``backward`` of the shortest runs of
    ``min_words`` words that begin and end there, or null; runs end where a line is missing."""
    least = max(min_words, 1)
    by_doc = Window.partitionBy("doc").orderBy("i")
    # a document listed twice has each line twice
    once = lines.withColumn("_last", F.lag("i").over(by_doc)).where("_last is null or _last < i")
    cut = once.withColumn("_stretch", F.col("i") - F.row_number().over(by_doc))
    stretch = Window.partitionBy("doc", "_stretch")
    so_far = stretch.orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # words up to the end of the line, and from its start on
    summed = cut.withColumn("_up", F.sum("wc").over(so_far)).select(
        "*",
        (F.sum("wc").over(stretch) - F.col("_up") + F.col("wc")).alias("_on"),
        (F.col("i") - F.min("i").over(stretch) + 1).alias("_before"),
        (F.max("i").over(stretch) - F.col("i") + 1).alias("_after"),
    )
    # lines that a run of enough words to or from this one need not reach
    spared = lambda by: F.count(F.lit(1)).over(
        stretch.orderBy(by).rangeBetween(Window.unboundedPreceding, -least)
    )
    length = lambda words, most: F.when(
        F.col(words) >= least, (F.col(most) - spared(words)).cast("int")
    )
    return summed.select(
        *lines.columns,
        length("_on", "_after").alias("forward"),
        length("_up", "_before").alias("backward"),
    ).drop("wc")


def _named(rows: DataFrame, key: list[str], name: str) -> DataFrame:
    """``rows`` whose ``key`` occurs at more than one place, with the first such place as ``n``."""
    place = F.struct("doc", "i")
    firsts = materialize(
        rows.groupBy(*key)
        .agg(F.min(place).alias("n"), F.max(place).alias("_last"))
        .where("n < _last")
        .drop("_last"),
        f"{name}-names",
    )
    return rows.join(firsts, key)


def deleted_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc`` and ``gone``, the numbers from 0 of the lines to delete, for documents with any."""
    lines = materialize(line_table(docs), "lines-all")
    # a line that occurs once is in no repeated run, so runs are measured without it
    repeated = _named(lines, ["h1", "h2"], "line").drop("h1", "h2")
    named = materialize(with_runs(repeated, min_words), "lines-1")
    release(lines)
    level = named.select("doc", "i", "n")
    covered = []
    for k in range(floor(log2(max(min_words, 1))) + 1):
        if k:
            half = 2 ** (k - 1)
            tail = level.select("doc", (F.col("i") - half).alias("i"), F.col("n").alias("n2"))
            pairs = level.withColumnRenamed("n", "n1").join(tail, ["doc", "i"])
            level = materialize(
                _named(pairs, ["n1", "n2"], f"lines-{2**k}").select("doc", "i", "n"),
                f"lines-{2**k}",
            )
        covered.append(_later_runs(named, level, k))
        if level.isEmpty():
            break
    runs = covered[0]
    for more in covered[1:]:
        runs = runs.unionByName(more)
    inside = runs.select(
        "doc", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("m") - 1)).alias("i")
    ).distinct()
    at = inside.join(named.select("doc", "i", "at"), ["doc", "i"])
    return at.groupBy("doc").agg(F.sort_array(F.collect_set("at")).alias("gone"))


def _later_runs(named: DataFrame, level: DataFrame, k: int) -> DataFrame:
    """Shortest runs of 2**k to 2**(k+1) - 1 lines that occur earlier: ``doc``, ``start``, ``m``."""
    forward = named.select("doc", F.col("i").alias("start"), F.col("forward").alias("m"))
    backward = named.select(
        "doc", (F.col("i") - F.col("backward") + 1).alias("start"), F.col("backward").alias("m")
    )
    runs = forward.union(backward).where(F.col("m").between(2**k, 2 ** (k + 1) - 1)).distinct()
    head = level.select("doc", F.col("i").alias("start"), F.col("n").alias("n1"))
    if k == 0:
        own = F.struct("doc", F.col("start").alias("i"))
        return runs.join(head, ["doc", "start"]).where(own > F.col("n1")).drop("n1")
    tail = level.select("doc", F.col("i").alias("_end"), F.col("n").alias("n2"))
    ends = runs.withColumn("_end", F.col("start") + F.col("m") - 2**k)
    paired = (
        ends.join(head, ["doc", "start"])
        .join(tail, ["doc", "_end"])
        .select("doc", F.col("start").alias("i"), "m", "n1", "n2")
    )
    paired = materialize(paired, f"runs-{2**k}")
    later = _named(paired, ["m", "n1", "n2"], f"runs-{2**k}")
    return later.where(F.struct("doc", "i") > F.col("n")).select(
        "doc", F.col("i").alias("start"), "m"
    )


def without_lines(docs: DataFrame, min_words: int = MIN_WORDS, prefix: str = "") -> DataFrame:
    """``docs`` with the shortened text, and the old numbers of the lines that went as ``gone``."""
    gone = f"{prefix}gone"
    deleted = settled(lambda: deleted_lines(docs, min_words), "lines-gone").select(
        F.col("doc").alias("_lines_doc"), F.col("gone").alias(gone)
    )
    keyed = docs.withColumn("_lines_key", document_key(docs))
    # by shuffle at every size, as there are too many documents with repeated lines to send around
    joined = keyed.join(deleted.hint("merge"), F.col("_lines_key") == F.col("_lines_doc"), "left")
    rest = let(
        F.col(gone),
        lambda g: F.array_join(
            F.filter(F.split(F.col("text"), "\n"), lambda _, at: ~F.array_contains(g, at)), "\n"
        ),
    )
    return joined.withColumn(
        "text", F.when(F.col(gone).isNull(), F.col("text")).otherwise(rest)
    ).drop("_lines_key", "_lines_doc")


def unrepeated_documents(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents without repeated runs, with their own columns and ``n_chars`` renewed.

    A document of which nothing but lines without words is left was a copy, and goes.
    """
    prefix = "_lines_"
    shortened = without_lines(docs, min_words, prefix)
    left = F.col(f"{prefix}gone").isNull() | has_word(whole(F.col("text")))
    kept = shortened.where(left)
    columns = [F.col(f"`{c}`") for c in docs.columns if c != "n_chars"]
    if "n_chars" in docs.columns:
        columns.append(
            F.when(F.col(f"{prefix}gone").isNull(), F.col("n_chars"))
            .otherwise(F.length("text").cast(docs.schema["n_chars"].dataType))
            .alias("n_chars")
        )
    return kept.select(*columns).select(*[f"`{c}`" for c in docs.columns])
