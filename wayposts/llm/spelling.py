"""Spelling variants: frequent words that differ by one edit, and the form each is a variant of.

The words form a trie whose edges, one row per prefix and next letter, are a table. A frontier
of states (word, node, letters skipped, edits) moves down the trie level by level: each level is
one join of the states with the edges of that depth. A state without edit may follow any other
letter (a replaced one) or skip its own (a deleted one); a state with its edit follows its word's
letters, and where it reaches the end of a word, that is a neighbour. Two words that differ by
one edit agree on the first half or on the second half of either, so the same walk over the
words read backwards lets all edits lie in the second half, where the trie has few branches. An
edge knows the lengths of the words below it, which ends most states at once. Inserted letters
are deleted ones seen from the other word.

The trie has ``DEPTH`` levels. Longer words, which are rare, meet by the fingerprints of what is
left without one of their letters, and are compared letter by letter.

Defined cases: a null text has no words, a null ``doc_id`` counts as an empty one; equal rows
count as often as they occur; ties between forms go to the smaller word in code-point order; an
empty table gives an empty result. Other columns are not read.
"""

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayposts.sources.shared_folder import materialize, release

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LEAST_LENGTH = 5
LEAST_COUNT = 3
# A form is at least so many times as frequent as its variant.
TIMES = 2
# The letters of the longest words in the trie; their lengths fit the bits of a number.
DEPTH = 32

# Words that a task counts before it passes them on, and texts it looks at together.
_KEPT_WORDS = 500_000
_TEXTS = 500

_FORWARD, _BACKWARD, _END = ">", "<", "."
_PRIME, _BASE = 2**61 - 1, 1_000_003


def run_counts(text: str | None) -> Counter:
    """How often each run of letters occurs in a text, A-Z in lower case."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower()
    return Counter(RUN.findall(raw.decode("utf-8", "surrogatepass")))


def noised(doc_id: str, run: str) -> str:
    """The run without the letter that its checksum names, if 97 divides that."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % 97:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` and ``n``: the frequent words of whole texts, counted in the tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def passed_on() -> pa.RecordBatch:
            made = pa.RecordBatch.from_pydict(
                {"word": pa.array(counts.keys(), pa.string()), "n": pa.array(counts.values(), pa.int64())}
            )
            counts.clear()
            return made

        for batch in batches:
            for at in range(0, batch.num_rows, _TEXTS):
                part = batch.slice(at, _TEXTS)
                for doc_id, text in zip(*(column.to_pylist() for column in part.columns)):
                    for found, n in run_counts(text).items():
                        word = noised(doc_id, found)
                        if len(word) >= LEAST_LENGTH:
                            counts[word] += n
                if len(counts) > _KEPT_WORDS:
                    yield passed_on()
        yield passed_on()

    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id")
    counted = docs.select(doc_id, "text").mapInArrow(run, "word string, n long")
    total = counted.groupBy("word").agg(F.sum("n").alias("n"))
    return total.where(F.col("n") >= LEAST_COUNT)


def _letter(key: str, place: Column) -> Column:
    """The letter at a place of the key, counted from 0 behind the mark of its side."""
    return F.substring(F.col(key), place + 2, F.lit(1))


def _keys(words: DataFrame) -> DataFrame:
    """Each word forward and backward, with its length and the letters on which a walk agrees."""
    size = F.length("word").cast("int")
    half = F.floor(size / 2).cast("int")
    forward = F.struct(
        F.concat(F.lit(_FORWARD), "word", F.lit(_END)).alias("key"), half.alias("exact")
    )
    backward = F.struct(
        F.concat(F.lit(_BACKWARD), F.reverse("word"), F.lit(_END)).alias("key"),
        (size - half).alias("exact"),
    )
    sides = words.select(size.alias("size"), F.explode(F.array(forward, backward)).alias("side"))
    return sides.select("side.key", "size", "side.exact")


def _edges(keys: DataFrame, least: int) -> DataFrame:
    """``parent``, ``letter``, the ``depth`` of the parent and, as bits, the lengths below."""
    depth = F.explode(F.sequence(F.lit(least), F.col("size"))).alias("depth")
    bit = F.expr("shiftleft(1L, size)").alias("bit")
    steps = keys.select("key", bit, depth).select(
        F.substring(F.col("key"), F.lit(1), F.col("depth") + 1).alias("parent"),
        _letter("key", F.col("depth")).alias("letter"),
        "depth",
        "bit",
    )
    edges = steps.groupBy("parent", "letter", "depth").agg(F.bit_or("bit").alias("sizes"))
    # a level then reads the pages of its depth only
    return edges.sortWithinPartitions("depth")


def _level(keys: DataFrame, edges: DataFrame, frontier: DataFrame | None, depth: int) -> DataFrame:
    """The states after the step from ``depth``: ``key``, ``node`` and the letters ``skipped``."""
    prefix = F.substring(F.col("key"), 1, depth + 1).alias("node")
    own, following = _letter("key", F.lit(depth)), _letter("key", F.lit(depth + 1))
    here = keys.where((F.col("exact") <= depth) & (F.col("size") > depth))
    edits = F.array_compact(
        F.array(
            F.struct(F.lit(0).alias("skipped"), F.lit(0).alias("edits"), own.alias("next")),
            # of equal letters in a row the last stands for all
            F.when(
                own != following,
                F.struct(F.lit(1).alias("skipped"), F.lit(1).alias("edits"), following.alias("next")),
            ),
        )
    )
    states = here.select("key", prefix, F.explode(edits).alias("edit")).select(
        "key", "node", "edit.*"
    )
    if frontier is not None:
        wanted = _letter("key", F.col("skipped") + depth).alias("next")
        states = states.unionByName(
            frontier.select("key", "node", "skipped", F.lit(1).alias("edits"), wanted)
        )
    level = edges.where(F.col("depth") == depth)
    size = F.length("key") - 2 - F.col("skipped")
    follows = F.when(F.col("edits") == 1, F.col("letter") == F.col("next")).otherwise(
        F.col("letter") > F.col("next")
    )
    fits = F.getbit("sizes", size) == 1
    met = states.join(level, (F.col("node") == F.col("parent")) & follows & fits)
    return met.select("key", F.concat("node", "letter").alias("node"), "skipped")


def _word(key: str) -> Column:
    letters = F.substring(F.col(key), F.lit(2), F.length(key) - 2)
    return F.when(F.col(key).startswith(_BACKWARD), F.reverse(letters)).otherwise(letters)


def _pairs_in_trie(words: DataFrame) -> tuple[DataFrame | None, list[DataFrame]]:
    """Pairs of words at one edit, and the tables that hold them. Runs a job per level."""
    keys = materialize(_keys(words), "spelling-keys")
    least, most = keys.agg(F.min("exact"), F.max("size")).first()
    if least is None:
        return None, [keys]
    edges = materialize(_edges(keys, least), "spelling-edges")
    levels: list[DataFrame] = []
    for depth in range(least, most + 1):
        going = levels[-1].where(~F.col("node").endswith(_END)) if levels else None
        levels.append(materialize(_level(keys, edges, going, depth), "spelling-level"))
    release(edges)
    ended = [level.where(F.col("node").endswith(_END)) for level in levels]
    found = reduce(DataFrame.unionByName, ended)
    return found.select(_word("key").alias("word"), _word("node").alias("near")), [keys, *levels]


def _fingerprints(words: DataFrame) -> DataFrame:
    """``id``, and per place the fingerprint of the word without its letter there (null: whole)."""

    def prints(word: str) -> Iterator[tuple[int | None, int]]:
        codes = [ord(c) for c in word]
        before = [0]
        for code in codes:
            before.append((before[-1] * _BASE + code) % _PRIME)
        yield None, before[-1]
        after, power = 0, 1
        for at in range(len(codes) - 1, -1, -1):
            yield at, (before[at] * power + after) % _PRIME
            after = (codes[at] * power + after) % _PRIME
            power = power * _BASE % _PRIME

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, word in zip(*(column.to_pylist() for column in batch.columns)):
                places, found = zip(*prints(word))
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": pa.array([number] * len(found), pa.int64()),
                        "left": pa.array([len(word) - (p is not None) for p in places], pa.int32()),
                        "at": pa.array(places, pa.int32()),
                        "print": pa.array(found, pa.int64()),
                    }
                )

    return words.select("id", "word").mapInArrow(run, "id long, left int, at int, print long")


def _pairs_of_long_words(words: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Pairs at one edit of which one word at least is longer than the trie is deep."""
    numbered = materialize(words.select(F.monotonically_increasing_id().alias("id"), "word"), "long-words")
    prints = materialize(_fingerprints(numbered), "long-words-prints")
    one, two = prints.alias("one"), prints.where(F.col("left") >= DEPTH).alias("two")
    same_print = (F.col("one.print") == F.col("two.print")) & (F.col("one.left") == F.col("two.left"))
    replaced = (F.col("one.at") == F.col("two.at")) & (F.col("one.id") < F.col("two.id"))
    deleted = F.col("one.at").isNotNull() & F.col("two.at").isNull()
    met = one.join(two, same_print & (replaced | deleted)).select(
        F.col("one.id").alias("id"), F.col("two.id").alias("near_id"), F.col("one.at").alias("at"),
        F.col("two.at").alias("near_at"),
    )
    texts = met.join(numbered, "id").join(
        numbered.select(F.col("id").alias("near_id"), F.col("word").alias("near")), "near_id"
    )
    without = F.expr("concat(left(word, at), substring(word, at + 2))")
    near_without = F.expr("if(near_at is null, near, concat(left(near, near_at), substring(near, near_at + 2)))")
    found = texts.where((without == near_without) & (F.col("word") != F.col("near")))
    return found.select("word", "near"), [numbered, prints]


def near_words(words: DataFrame) -> DataFrame:
    """``word`` and ``near`` for all words (distinct, in ``word``) that differ by one edit, both
    ways; written to the shared folder."""
    size = F.length("word")
    found, used = _pairs_in_trie(words.where(size <= DEPTH))
    long_found, long_used = _pairs_of_long_words(words.where(size >= DEPTH))
    pairs = long_found if found is None else found.unionByName(long_found)
    both = F.explode(
        F.array(F.struct("word", "near"), F.struct(F.col("near").alias("word"), F.col("word").alias("near")))
    )
    result = materialize(pairs.select(both.alias("pair")).select("pair.*").distinct(), "near-words")
    for table in [*used, *long_used]:
        release(table)
    return result


def _rooted(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` of all words of ``forms`` (``word``, ``form``).

    Roots are passed down to variants, one level per job. A form has few variants, so no key is
    hot; it is more than once as frequent as they are, so there are few levels.
    """
    level = forms.where(F.col("form").isNull()).select("word", F.col("word").alias("root"))
    open_words = forms.where(F.col("form").isNotNull())
    done = [level]
    while True:
        above = level.select(F.col("word").alias("form"), "root")
        joined = materialize(open_words.join(above, "form", "left"), "spelling-roots")
        level = joined.where(F.col("root").isNotNull()).select("word", "root")
        open_words = joined.where(F.col("root").isNull()).select("word", "form")
        done.append(level)
        if open_words.isEmpty():
            return reduce(DataFrame.unionByName, done)


def variants(docs: DataFrame) -> DataFrame:
    """Per frequent word: its ``form`` and ``root``, ``n``, ``n_near`` and ``form_n``."""
    words = materialize(word_counts(docs), "spelling-words")
    near = near_words(words.select("word"))
    counted = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = (
        near.join(counted, "near")
        .groupBy("word")
        .agg(
            F.count(F.lit(1)).alias("n_near"),
            F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"),
        )
    )
    frequent = -F.col("best.less") >= TIMES * F.col("n")
    formed = words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, F.col("best.near")).alias("form"),
        F.when(frequent, -F.col("best.less")).alias("form_n"),
    )
    formed = materialize(formed, "spelling-forms")
    roots = _rooted(formed.select("word", "form"))
    return formed.join(roots, "word").select("word", "form", "root", "n", "n_near", "form_n")
