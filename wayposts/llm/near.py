"""Near-duplicate texts by order MinHash, with candidates verified by banded alignment.

Each sketch of a text takes the two smallest of its five-word shingles under one hash, each
shingle labelled with how often it occurred before, in the order in which they stand. Texts that
share all sketches of a band are candidates. Each bucket names one leader by a hash of its own.
Every text is verified against that of its leaders with which it shares most sketches, then, of
the classes that this gives, one pair of leader and text for each two classes. Buckets that still
hold several classes are finished: all pairs of different classes are compared, first the nearest
text of each class, and once these classes are united, all that are left.

Three things are told of a pair before it becomes a row, without a look at the texts. Pairs whose
numbers of shingles differ too much are unlike. So are pairs with fewer equal sketches than
similar texts have, but for one in a million. And every text has a short histogram of its
shingles by hash: where two histograms differ by more than the shingles of similar texts can, the
texts are surely unlike. Texts that merely share a long passage end there. A pair is linked if the
multisets of shingles have a Jaccard similarity of 0.8 or more and the words an edit similarity
of 0.8 or more, found along the diagonals within the band that this similarity leaves. Classes
are connected components.

Equal texts are one node throughout, so thousands of copies cost one comparison. Buckets are
counted before the shuffle and joined back by joins that adaptive execution can split; pairs
across classes are made from blocks of bounded size, so a task never holds a whole bucket.

Defined cases: a null text is an empty one; texts with fewer than five words are one shingle;
equal texts, empty ones too, are always in one class; a null ``doc_id`` is the last of a class;
rows with equal ``doc_id`` and text are one document listed twice; an empty table gives an empty
result.
"""

from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayposts.llm.arrow import WORD, map_batches
from wayposts.llm.components import components
from wayposts.llm.text import whole
from wayposts.sources.shared_folder import materialize, release, settled

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 16
SKETCHES_A_BAND = 2
# Of the sketches, as many are equal at least; at the wanted similarity 20 of 32 are on average.
LEAST_EQUAL = 8
# Cells of a histogram of shingles, one byte each; larger counts stay at the largest byte.
CELLS = 256
KEPT_WORDS = 300_000
# Texts outside a bucket's largest class, and texts they are compared with, in one task on average.
OPEN_ROWS = 1024
ASKED_ROWS = 4096

_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their differences over all bits."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, computed when first asked for."""

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) > KEPT_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of the shingles of hashed words; one for a text shorter than a shingle."""
    with np.errstate(over="ignore"):
        if len(words) < SHINGLE:
            words = np.concatenate([words, np.full(SHINGLE - len(words), len(words), np.uint64)])
        n = len(words) - SHINGLE + 1
        total = np.zeros(n, np.uint64)
        for k in range(SHINGLE):
            total = mixed(total + words[k : k + n] + np.uint64(k))
        return total


def occurrence_labelled(hashes: np.ndarray) -> np.ndarray:
    """Hashes that tell a shingle's first occurrence in the text from its second, and so on."""
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    same = np.flatnonzero(ranked[1:] == ranked[:-1]) + 1
    if not len(same):
        return hashes
    starts = np.ones(len(hashes), bool)
    starts[same] = False
    places = np.arange(len(hashes))
    earlier = places - np.maximum.accumulate(np.where(starts, places, 0))
    labels = np.empty(len(hashes), np.uint64)
    labels[order] = earlier.astype(np.uint64)
    with np.errstate(over="ignore"):
        return np.where(labels > 0, mixed(hashes + labels * _MIX_2), hashes)


def sketches(words: np.ndarray, count: int = BANDS * SKETCHES_A_BAND) -> np.ndarray:
    """The sketches of a text of hashed words, as signed 64-bit numbers."""
    factors = mixed(np.arange(1, count + 1, dtype=np.uint64)) | np.uint64(1)
    with np.errstate(over="ignore"):
        h = occurrence_labelled(shingles(words))
        seen = factors[:, None] * h
        each = np.arange(count)
        one = seen.argmin(1)
        if len(h) > 1:
            seen[each, one] = ~np.uint64(0)
            two = seen.argmin(1)
        else:
            two = one
        head, tail = h[np.minimum(one, two)], h[np.maximum(one, two)]
        return mixed(mixed(head) + tail + factors).view(np.int64)


def histogram(words: np.ndarray) -> bytes:
    """How many shingles of a text of hashed words fall into each cell, 255 for more."""
    cells = (shingles(words) & np.uint64(CELLS - 1)).astype(np.int64)
    return np.minimum(np.bincount(cells, minlength=CELLS), 255).astype(np.uint8).tobytes()


def may_be_similar(far: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Whether texts can have the similarity, with ``far`` the difference of their histograms and
    ``total`` their shingles together.

    Texts of similarity s have (1 - s) / (1 + s) of their shingles unshared at most, and the
    histograms differ by no more than the unshared ones.
    """
    return far <= (1 - SIMILARITY) / (1 + SIMILARITY) * total + 1e-6


def _far(hists: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How much the histograms at the places ``a`` and ``b`` differ, pair by pair."""
    found = np.empty(len(a), np.int64)
    for at in range(0, len(a), 8192):
        to = slice(at, at + 8192)
        found[to] = np.abs(hists[a[to]].astype(np.int16) - hists[b[to]]).sum(1)
    return found


def band_values(listed: Column) -> Column:
    """One number per band, of its sketches."""
    band = lambda b: F.xxhash64(*[F.get(listed, b * SKETCHES_A_BAND + k) for k in range(SKETCHES_A_BAND)])
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), band)


def labelled(words: np.ndarray) -> np.ndarray:
    """The shingles of a text of hashed words, each told from its other occurrences, sorted."""
    return np.sort(occurrence_labelled(shingles(words)))


def overlap(x: np.ndarray, y: np.ndarray) -> float:
    """The Jaccard similarity of two sorted sets."""
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    shared = np.count_nonzero(both[1:] == both[:-1])
    return shared / (len(both) - shared)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of the multisets of shingles of two texts of hashed words."""
    return overlap(labelled(a), labelled(b))


def within_edits(a: np.ndarray, b: np.ndarray, most: int) -> bool:
    """Whether at most ``most`` words inserted, deleted or replaced turn ``a`` into ``b``.

    Follows the furthest place reached on each diagonal of the band, edit by edit.
    """
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return False
    stops: dict[int, list[int]] = {}

    def run(diagonal: int, at: int) -> int:
        """The first place from ``at`` on where the diagonal's words differ, or its end."""
        if diagonal not in stops:
            low, high = max(0, -diagonal), min(n, m - diagonal)
            differ = np.flatnonzero(a[low:high] != b[low + diagonal : high + diagonal]) + low
            stops[diagonal] = [*differ.tolist(), high]
        listed = stops[diagonal]
        return listed[min(bisect_left(listed, at), len(listed) - 1)] if at < listed[-1] else at

    reached = {0: run(0, 0)}
    for _ in range(most + 1):
        if reached.get(m - n, -1) >= n:
            return True
        following = {}
        for d in range(min(reached) - 1, max(reached) + 2):
            if abs(d) > most or d < -n or d > m:
                continue
            at = max(reached.get(d, -2) + 1, reached.get(d + 1, -2) + 1, reached.get(d - 1, -2))
            at = min(at, n, m - d)
            if at >= max(0, -d):
                following[d] = run(d, at)
        reached = following
    return False


def few_edits(a: np.ndarray, b: np.ndarray) -> bool:
    return within_edits(a, b, int((1 - SIMILARITY) * max(len(a), len(b)) + 1e-9))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    return jaccard(a, b) >= SIMILARITY and few_edits(a, b)


class Compared(dict):
    """Hashed words and labelled shingles of the texts that a task compares, kept by node: a text
    that is in many pairs is read once. At most ``KEPT_WORDS`` words, and those of one text."""

    def __init__(self):
        self.hashes = WordHashes()
        self.held = 0

    def of(self, node: bytes, text: str) -> tuple[np.ndarray, np.ndarray]:
        if node not in self:
            if self.held > KEPT_WORDS:
                self.clear()
                self.held = 0
            words = self.hashes.of(WORD.findall(text))
            self[node] = words, labelled(words)
            self.held += len(words)
        return self[node]

    def similar(self, node: bytes, one: str, leader: bytes, other: str) -> bool:
        (a, x), (b, y) = self.of(node, one), self.of(leader, other)
        return overlap(x, y) >= SIMILARITY and few_edits(a, b)


def text_node(text: Column) -> Column:
    """The 128-bit digest by which equal texts are one node."""
    return F.unhex(F.md5(whole(text).cast("binary")))


def sketched(docs: DataFrame) -> DataFrame:
    """``node``, ``doc_id``, ``sketches``, ``grams`` (number of shingles) and ``hist`` of every
    document; no sketches of those without words."""

    def start() -> Callable[[dict], dict]:
        hashes = WordHashes()

        def work(batch: dict) -> dict:
            found = [hashes.of(WORD.findall(text or "")) for text in batch["text"]]
            return {
                "node": batch["node"],
                "doc_id": batch["doc_id"],
                "sketches": [sketches(w) if len(w) else [] for w in found],
                "grams": [max(len(w) - SHINGLE + 1, 1) for w in found],
                "hist": [histogram(w) if len(w) else b"" for w in found],
            }

        return work

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(
        docs.select(text_node(F.col("text")).alias("node"), "doc_id", "text"),
        start,
        f"node binary, doc_id {kind}, sketches array<long>, grams long, hist binary",
    )


def _led(buckets: DataFrame) -> DataFrame:
    """The rows of ``buckets`` that hold several texts, with the ``leader`` of the bucket."""
    order = F.xxhash64("node", "bucket")
    leaders = (
        buckets.groupBy("bucket")
        .agg(F.min(F.struct(order.alias("o"), "node")).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("bucket", F.col("first.node").alias("leader"))
    )
    leaders = materialize(leaders, "near-leaders")
    led = materialize(buckets.join(leaders, "bucket").select("node", "leader"), "near-led")
    release(leaders)
    return led


def _alike(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs with enough ``equal`` sketches, and numbers of shingles near enough, to be similar."""
    one = nodes.select("node", F.col("sketches").alias("_one"), F.col("grams").alias("_n"))
    other = nodes.select(
        F.col("node").alias("leader"), F.col("sketches").alias("_other"), F.col("grams").alias("_m")
    )
    near = F.least("_n", "_m") >= SIMILARITY * F.greatest("_n", "_m") - 1e-6
    same = F.filter(F.zip_with("_one", "_other", lambda a, b: a == b), lambda x: x)
    joined = pairs.join(one, "node").join(other, "leader")
    equal = joined.where(near).select("node", "leader", F.size(same).alias("equal"))
    return equal.where(F.col("equal") >= LEAST_EQUAL)


def _of_most(pairs: DataFrame, *group: str) -> DataFrame:
    """Of each group the pair with most equal sketches."""
    most = F.max(F.struct("equal", "node", "leader")).alias("most")
    return pairs.groupBy(*group).agg(most).select("most.node", "most.leader")


def _between_classes(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs of different classes under ``roots``, with the two ``low`` and ``high``."""
    for end in ("node", "leader"):
        rooted = roots.select(F.col("node").alias(end), F.col("component").alias(f"_{end}"))
        pairs = pairs.join(rooted, end, "left").withColumn(f"_{end}", F.coalesce(f"_{end}", end))
    low, high = F.least("_node", "_leader"), F.greatest("_node", "_leader")
    apart = pairs.where("_node <> _leader")
    return apart.select("node", "leader", "equal", low.alias("low"), high.alias("high"))


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those (``node``, ``leader``) pairs whose texts are similar."""

    def start() -> Callable[[dict], dict]:
        compared = Compared()

        def work(batch: dict) -> dict:
            made: dict[str, list] = {"node": [], "leader": []}
            for node, leader, one, other in zip(*(batch[n] for n in ("node", "leader", "one", "other"))):
                if compared.similar(node, one, leader, other):
                    made["node"].append(node)
                    made["leader"].append(leader)
            return made

        return work

    ends = pairs.select("node").union(pairs.select("leader")).distinct()
    asked = texts.join(ends, "node", "left_semi")
    one = asked.select("node", F.col("text").alias("one"))
    other = asked.select(F.col("node").alias("leader"), F.col("text").alias("other"))
    joined = pairs.join(one, "node").join(other, "leader")
    return map_batches(
        joined.select("node", "leader", "one", "other"), start, "node binary, leader binary"
    )


def _bucketed(nodes: DataFrame, *kept: str) -> DataFrame:
    """A row with the ``band`` and ``bucket`` for each band of every text with words."""
    values = F.posexplode(band_values(F.col("sketches"))).alias("band", "value")
    banded = nodes.where(F.size("sketches") > 0).select("node", *kept, values)
    return banded.select("node", *kept, "band", F.xxhash64("band", "value").alias("bucket"))


def _unfinished(rooted: DataFrame) -> DataFrame:
    """Rows of the tasks that compare the texts outside the largest class of a bucket (``own``)
    with all of the bucket, block by block; ``key`` tells the tasks apart."""
    banded = _bucketed(rooted, "root")
    classes = (
        banded.groupBy("bucket", "root")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("bucket")
        .agg(
            F.max(F.struct("n", "root")).alias("main"),
            F.sum("n").alias("total"),
            F.count(F.lit(1)).alias("classes"),
        )
        .where("classes > 1")
        .select(
            "bucket",
            F.col("main.root").alias("main"),
            F.ceil((F.col("total") - F.col("main.n")) / OPEN_ROWS).alias("blocks"),
            F.ceil(F.col("total") / ASKED_ROWS).alias("parts"),
        )
    )
    classes = materialize(classes, "near-mixed")
    rows = banded.join(classes, "bucket").select(
        "node", "bucket", "blocks", "parts", (F.col("root") != F.col("main")).alias("open")
    )
    rows = materialize(rows, "near-unfinished")
    release(classes)
    # enough of a sketch to tell most unequal ones; those taken for equal only add candidates
    low = lambda x: x.bitwiseAND(F.lit(0x7FFF)).cast("short")
    facts = rooted.select(
        "node",
        F.col("root").alias("class"),
        F.xxhash64("node").alias("hash"),
        F.transform("sketches", low).alias("sketches"),
        "grams",
        "hist",
    )
    each = lambda name: F.sequence(F.lit(0).cast("long"), F.col(name) - 1)
    one = lambda name, seed: F.array(F.pmod(F.xxhash64("node", F.lit(seed)), F.col(name)))
    own = rows.where("open").select("*", F.lit(True).alias("own"), one("blocks", 1).alias("_b"), each("parts").alias("_p"))
    asked = rows.select("*", F.lit(False).alias("own"), each("blocks").alias("_b"), one("parts", 2).alias("_p"))
    dealt = (
        own.union(asked)
        .select("node", "bucket", "open", "own", F.explode("_b").alias("_b"), "_p")
        .select("node", "open", "own", "bucket", "_b", F.explode("_p").alias("_p"))
        .select("node", "open", "own", F.xxhash64("bucket", "_b", "_p").alias("key"))
    )
    return dealt.join(facts, "node").select(
        "key", "own", "open", "class", "hash", "node", "sketches", "grams", "hist"
    )


def _across(group: pa.Table, nearest: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of different classes in a task's rows that can be similar; if
    ``nearest``, for each own text only the one least far of each class."""
    own, opened, order, grams = (
        group.column(n).to_numpy() for n in ("own", "open", "hash", "grams")
    )
    kind = pa.concat_arrays(group.column("class").chunks).dictionary_encode().indices.to_numpy()
    listed = pa.concat_arrays([c.flatten() for c in group.column("sketches").chunks])
    listed = listed.to_numpy().reshape(len(own), -1)
    hists = np.frombuffer(b"".join(group.column("hist").to_pylist()), np.uint8).reshape(len(own), -1)
    a, b = np.flatnonzero(own), np.flatnonzero(~own)
    ones, others = [], []
    for at in range(0, len(a), 64):
        x = a[at : at + 64]
        # of two open texts each is asked by the other
        once = ~opened[b] | (order[x][:, None] <= order[b])
        n, m = grams[x][:, None], grams[b]
        sized = np.minimum(n, m) >= SIMILARITY * np.maximum(n, m) - 1e-6
        i, j = np.nonzero(once & sized & (kind[x][:, None] != kind[b]))
        i, j = x[i], b[j]
        alike = (listed[i] == listed[j]).sum(1) >= LEAST_EQUAL
        i, j = i[alike], j[alike]
        far = _far(hists, i, j)
        alike = may_be_similar(far, grams[i] + grams[j])
        i, j, far = i[alike], j[alike], far[alike]
        if nearest and len(i):
            ranked = np.lexsort((order[j], far, kind[j], i))
            i, j = i[ranked], j[ranked]
            new = np.ones(len(i), bool)
            new[1:] = (i[1:] != i[:-1]) | (kind[j[1:]] != kind[j[:-1]])
            i, j = i[new], j[new]
        ones.append(i)
        others.append(j)
    none = [np.empty(0, int)]
    return np.concatenate(ones or none), np.concatenate(others or none)


def _candidates(rooted: DataFrame, nearest: bool) -> DataFrame:
    """Pairs of texts that share a bucket, have enough equal sketches and are of different
    classes, the ``node`` before the ``leader``."""

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            keys = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for low, high in zip(cuts[:-1], cuts[1:]):
                if low == high:
                    continue
                if held and keys[low] != last:
                    yield pa.Table.from_batches(held)
                    held = []
                held.append(batch.slice(low, high - low))
                last = keys[low]
        if held:
            yield pa.Table.from_batches(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("node", pa.binary()), ("leader", pa.binary())])
        made: tuple[list, list] = ([], [])
        for group in groups(batches):
            nodes = group.column("node")
            for kept, places in zip(made, _across(group, nearest)):
                kept += nodes.take(pa.array(places)).to_pylist()
            if len(made[0]) >= ASKED_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(m, pa.binary()) for m in made], schema=schema)
                made = ([], [])
        yield pa.RecordBatch.from_arrays([pa.array(m, pa.binary()) for m in made], schema=schema)

    rows = _unfinished(rooted).repartition("key").sortWithinPartitions("key")
    return _ordered(rows.mapInArrow(run, "node binary, leader binary")).distinct()


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        F.least("node", "leader").alias("node"), F.greatest("node", "leader").alias("leader")
    )


def class_roots(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node of its class, for nodes that are not that."""
    led = _led(_bucketed(nodes))
    pairs = led.where("node <> leader").distinct()
    alike = materialize(_alike(pairs, nodes), "near-pairs")
    # only these have others to be compared with
    members = materialize(led.select("node").distinct(), "near-members")
    release(led)
    texts = _texts(docs, members)
    asked = materialize(_of_most(alike, "node"), "near-first")
    roots = components(_verified(asked, texts))
    left = alike.join(asked, ["node", "leader"], "left_anti")
    second = materialize(_of_most(_between_classes(left, roots), "low", "high"), "near-second")
    roots = _joined(roots, _verified(second, texts))
    asked = _ordered(asked.unionByName(second))
    for nearest in (True, False):
        rooted = materialize(_rooted(nodes.join(members, "node", "left_semi"), roots), "near-rooted")
        pairs = settled(
            lambda: _candidates(rooted, nearest).join(asked, ["node", "leader"], "left_anti"), "near-across"
        )
        release(rooted)
        if pairs.isEmpty():
            break
        roots = _joined(roots, _verified(pairs, texts))
        asked = asked.unionByName(pairs)
    return roots


def _joined(roots: DataFrame, found: DataFrame) -> DataFrame:
    """The roots once the links ``found`` are added to the classes that ``roots`` names."""
    joined = components(roots.union(found))
    release(roots)
    return joined


def _rooted(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """``nodes`` with the ``root`` of each."""
    rooted = nodes.join(roots, "node", "left")
    return rooted.withColumn("root", F.coalesce("component", "node")).drop("component", "smallest")


def _texts(docs: DataFrame, members: DataFrame) -> DataFrame:
    """The text of each of the nodes in ``members``, written.

    Members are too many to send to every task in a large corpus, and so in a small one as well.
    """
    return materialize(
        docs.select(text_node(F.col("text")).alias("node"), whole(F.col("text")).alias("text"))
        .join(members.hint("merge"), "node", "left_semi")
        .groupBy("node")
        .agg(F.first("text").alias("text")),
        "near-texts",
    )


def near_classes(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``node``, ``class_id``, the smallest id in its class, and
    ``root``, by which classes differ whose smallest ids are equal."""
    sketches_of = materialize(sketched(docs), "near-sketches")
    nodes = materialize(
        sketches_of.groupBy("node").agg(
            F.min("doc_id").alias("smallest"),
            *[F.first(c).alias(c) for c in ("sketches", "grams", "hist")],
        ),
        "near-nodes",
    )
    # the sketches of all rows are not read again
    rows = materialize(sketches_of.select("doc_id", "node"), "near-rows")
    release(sketches_of)
    roots = settled(lambda: class_roots(docs, nodes), "near-found")
    rooted = nodes.join(roots, "node", "left").select(
        "node", F.coalesce("component", "node").alias("root"), "smallest"
    )
    rooted = materialize(rooted, "near-roots")
    release(nodes)
    release(roots)
    smallest = rooted.groupBy("root").agg(F.min("smallest").alias("class_id"))
    smallest = materialize(smallest, "near-smallest")
    named = materialize(rooted.join(smallest, "root").select("node", "class_id", "root"), "near-classes")
    release(rooted)
    release(smallest)
    return rows.join(named, "node")


def _chosen(classes: DataFrame) -> DataFrame:
    """The id and node of the document that stands for each class."""
    kept = classes.where(F.col("doc_id").eqNullSafe(F.col("class_id")))
    # of rows with the smallest id, the one with the smallest digest
    chosen = kept.groupBy("root").agg(F.min(F.struct("node", "class_id")).alias("_near"))
    return chosen.select(F.col("_near.class_id").alias("_near_id"), F.col("_near.node").alias("_near_node"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The document with the smallest id of each class, with its own columns."""
    chosen = settled(lambda: _chosen(near_classes(docs)), "near-chosen")
    own = [F.col(f"`{c}`") for c in docs.columns]
    marked = docs.withColumn("_near_own", text_node(F.col("text")))
    found = marked.join(
        chosen,
        F.col("doc_id").eqNullSafe(F.col("_near_id")) & (F.col("_near_own") == F.col("_near_node")),
        "left_semi",
    )
    once = found.groupBy("doc_id", "_near_own").agg(F.first(F.struct(*own)).alias("_near_doc"))
    return once.select("_near_doc.*")
