"""Best-fit packing: documents into as few sequences of bounded length as possible.

Only lengths matter for packing, and there are at most as many as the capacity, so the problem
is solved on the counts of the lengths, whatever the number of documents. First the dominance
reduction of Martello and Toth: a piece and the set of pieces that fills its sequence at least
as well as any other set could are fixed together for good. Best-fit decreasing places what is
left. The result is a list of patterns, each used many times; pieces are numbered within their
length, over fixed buckets, and look up their sequence and offset by that number.

Defined cases: a null or empty text is the single closing token; rows that are equal are packed
as separate documents; an empty table gives an empty result; other columns are not read.
"""

import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayposts.llm.arrow import map_batches
from wayposts.sources.shared_folder import materialize

CAPACITY = 4096
CLOSING_ID = 1
KEPT_WORDS = 1_000_000
_BUCKETS = 512

# In UTF-8: letters a-z and those of U+00C0 to U+00FF, which are one word to the tokenizer, and
# marks after them. Of the marks that are not here, ' may begin a word with letters after it, and
# < or | the name of a special token.
PARTS = re.compile(rb"((?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([!-&(-/:;=?@\[-`{}~]*)")

# (times used, ((length, pieces of it in one sequence), ...))
Pattern = tuple[int, tuple[tuple[int, int], ...]]


class WordIds(dict):
    """Ids of words as packed little-endian 32-bit numbers, for words that ``learn`` was given.

    The tokenizer drops white space and joins nothing across it, so the ids of a text are those
    of its words one after another. A run of marks after letters is a word of its own to it, so
    such words are put together from two. Words of plain letters are single words to it too; they
    are encoded many at a time and told apart by the ids that end a word.
    """

    def __init__(self, tokenizer_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        size = self.tokenizer.get_vocab_size()
        self.ends = np.zeros(size, bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.ends[number] = token.endswith("</w>")

    def learn(self, words: set[bytes]) -> None:
        if len(self) > KEPT_WORDS:
            self.clear()
        plain, others, marked = set(), set(), []
        for word in words:
            if word in self:
                continue
            parts = PARTS.fullmatch(word)
            if not parts:
                others.add(word)
                continue
            letters, marks = parts.groups()
            if letters not in self:
                plain.add(letters)
            if marks:
                marked.append((word, letters, marks))
                if marks not in self:
                    others.add(marks)
        listed = list(plain)
        for at in range(0, len(listed), 1000):
            others.update(self._learn_together(listed[at : at + 1000]))
        listed = list(others)
        for at in range(0, len(listed), 1000):
            some = listed[at : at + 1000]
            for word, ids in zip(some, self._encode([w.decode() for w in some])):
                self[word] = np.array(ids, "<u4").tobytes()
        for word, letters, marks in marked:
            self[word] = self[letters] + self[marks]

    def _learn_together(self, words: list[bytes]) -> list[bytes]:
        """Learns words from one text of them all; gives them back if they can't be told apart."""
        ids = np.array(self._encode([b" ".join(words).decode()])[0], "<u4")
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(words):
            return words
        packed, start = ids.tobytes(), 0
        for word, end in zip(words, ends.tolist()):
            self[word] = packed[4 * start : 4 * end]
            start = end
        return []

    def _encode(self, texts: list[str]) -> list[list[int]]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [each.ids for each in found]


@lru_cache(maxsize=1)
def known_words(tokenizer_path: str) -> WordIds:
    """The words that the tasks of one Python worker share."""
    return WordIds(tokenizer_path)


def byte_words(text: str | None) -> list[bytes]:
    """The words of a text in UTF-8, their A-Z in lower case where that changes no id.

    It would where the name of a special token or a letter with a combining mark appears.
    """
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not any(mark in raw for mark in (b"<|", b"\xcc", b"\xcd")):
        raw = raw.lower()
    return raw.split()


def pieces(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per document and piece of at most ``capacity`` ids, and ``bucket`` for numbering."""
    closing = np.array([CLOSING_ID], "<u4").tobytes()

    def start() -> Callable[[dict], dict]:
        import public_tokenizers

        known = known_words(tokenizer_path or public_tokenizers.path("word_bpe_49k.json"))
        rows = 0

        def work(batch: dict) -> dict:
            nonlocal rows
            texts = [byte_words(text) for text in batch["text"]]
            known.learn(set().union(*texts))
            made: dict[str, list] = {
                n: [] for n in ("doc_id", "piece", "start", "length", "ids_crc32", "bucket")
            }
            for doc_id, words in zip(batch["doc_id"], texts):
                ids = b"".join(map(known.__getitem__, words)) + closing
                for number, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    made["doc_id"].append(doc_id)
                    made["piece"].append(number)
                    made["start"].append(at // 4)
                    made["length"].append(len(part) // 4)
                    made["ids_crc32"].append(zlib.crc32(part))
                    made["bucket"].append(zlib.crc32(f"{doc_id},{number},{rows}".encode()) % _BUCKETS)
                rows += 1
            return made

        return work

    return map_batches(
        docs.select("doc_id", "text"),
        start,
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start long, "
        "length long, ids_crc32 long, bucket int",
    )


def reduce_by_dominance(counts: np.ndarray, capacity: int = CAPACITY) -> list[Pattern]:
    """Fixes sets that dominate all others with their largest piece; takes them from ``counts``.

    For the largest pieces first, with ``k`` the largest that fits beside one: alone if nothing
    fits; with ``k`` if both fill the sequence, if no two pieces fit beside it, or if no three
    fit and no two are longer than ``k``.
    """
    fixed: list[Pattern] = []
    for j in range(capacity, 0, -1):
        while counts[j]:
            room = capacity - j
            counts[j] -= 1
            there = np.flatnonzero(counts[: room + 1])
            counts[j] += 1
            if not len(there):
                fixed.append((int(counts[j]), ((j, 1),)))
                counts[j] = 0
                break
            k = int(there[-1])
            low = np.repeat(there[:3], np.minimum(counts[there[:3]], 3))[:3]
            two_fit = len(low) > 1 and low[:2].sum() <= room
            three_fit = len(low) > 2 and low.sum() <= room
            if j + k != capacity and two_fit:
                partners = there[np.searchsorted(there, room - there, "right") - 1]
                sums = np.where(there + partners <= room, there + partners, 0)
                if three_fit or sums.max() > k:
                    break
            times = int(counts[j] // 2 if j == k else min(counts[j], counts[k]))
            fixed.append((times, ((j, 2),) if j == k else ((j, 1), (k, 1))))
            counts[j] -= times
            counts[k] -= times
    return fixed


def best_fit(counts: np.ndarray, capacity: int = CAPACITY) -> list[Pattern]:
    """Best-fit decreasing on counted lengths: each piece goes to the fullest sequence it fits."""
    rooms: list[int] = []
    groups: dict[int, list[Pattern]] = {}

    def put(room: int, group: Pattern) -> None:
        if room not in groups:
            insort(rooms, room)
            groups[room] = []
        groups[room].append(group)

    for j in range(capacity, 0, -1):
        left = int(counts[j])
        at = bisect_left(rooms, j)
        filled = []
        while left:
            if at < len(rooms):
                room = rooms[at]
                times, pattern = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[at]
            else:
                room, times, pattern = capacity, left, ()
            each = room // j
            full = min(times, left // each)
            rest = left % each if full < times and left // each == full else 0
            if full:
                filled.append((room - each * j, (full, (*pattern, (j, each)))))
            if rest:
                filled.append((room - rest * j, (1, (*pattern, (j, rest)))))
            untouched = times - full - bool(rest)
            if untouched and pattern:
                put(room, (untouched, pattern))
            left -= full * each + rest
        counts[j] = 0
        for room, group in filled:
            put(room, group)
    return [group for listed in groups.values() for group in listed]


def solve(lengths: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in lengths.items():
        counts[length] = n
    return reduce_by_dominance(counts, capacity) + best_fit(counts, capacity)


def places(patterns: list[Pattern]) -> dict[str, np.ndarray]:
    """Per pattern and length: the first number in the length, pieces in one sequence, the
    number of the pattern's first sequence and the offset of the length there; sorted."""
    rows = []
    used: dict[int, int] = {}
    sequence = 0
    for times, pattern in patterns:
        offset = 0
        for length, each in pattern:
            rows.append((length, used.get(length, 0), each, sequence, offset))
            used[length] = used.get(length, 0) + times * each
            offset += length * each
        sequence += times
    columns = np.array(sorted(rows), np.int64).reshape(-1, 5).T
    return dict(zip(("length", "first", "each", "sequence", "offset"), columns))


def pack(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id`` and
    ``offset``. ``tokenizer_path`` names the tokenizer's file, which every executor must have."""
    cut = materialize(pieces(docs, tokenizer_path, capacity), "pack-pieces")
    # at most one row per length up to the capacity
    counted = cut.groupBy("length").count().collect()
    found = places(solve({r["length"]: r["count"] for r in counted}, capacity))
    sums = cut.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    earlier = (
        Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = sums.select("length", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    numbered = cut.join(starts, ["length", "bucket"]).select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("_start") + F.row_number().over(inside) - 1).alias("number"),
    )

    def start() -> Callable[[dict], dict]:
        by = (found["length"] << 48) + found["first"]

        def work(batch: dict) -> dict:
            length = np.array(batch["length"], np.int64)
            number = np.array(batch["number"], np.int64)
            row = np.searchsorted(by, (length << 48) + number, "right") - 1
            copy, place = np.divmod(number - found["first"][row], found["each"][row])
            made = {n: batch[n] for n in ("doc_id", "piece", "start", "length", "ids_crc32")}
            made["sequence_id"] = found["sequence"][row] + copy
            made["offset"] = found["offset"][row] + place * length
            return made

        return work

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(
        numbered,
        start,
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, "
        "offset long",
    )
