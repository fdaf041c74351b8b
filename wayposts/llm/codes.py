"""Vector codes: each part of a vector as the number of its nearest entry in a codebook.

Components are whole numbers, the floor of 1024 times the given ones. The codebooks are refined
by rounds of assigning and averaging. Between rounds every part keeps its ``b`` next entries in
order, a lower bound of the distance to each, one outer bound for all others and an upper bound
of the distance to its own entry (Drake and Hamerly). A round widens the bounds by how far the
entries moved. Where the upper bound stays below a lower bound, neither that entry nor any
behind it can be nearer; what stands before it is compared in whole numbers, so results do not
depend on ``b`` or on rounding. After each round ``b`` falls to the number that costs least with
the bounds just needed. The state is a table in the shared folder, written once per round, and
the sums of a round are one row per entry and task.

Defined cases: rows whose vector is null or holds null or non-finite components are dropped;
shorter vectors, and those whose length four does not divide, are filled with zeros at their
end; components beyond 2**16 in size count as 2**16; with fewer rows than entries the codebook
has as many entries as there are rows; rows with equal or null ``vec_id`` are kept apart, null
last and equal ones by their components; an empty table gives an empty result. Other columns are
not read.
"""

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayposts.operators.ranking import shuffle_partitions
from wayposts.sources.shared_folder import materialize, release

SCALE = 1024
LARGEST = 2**26
PARTS = 4
ENTRIES = 256
ROUNDS = 4
# Entries for which a part keeps a bound at first, and at least.
FIRST_BOUNDS = 16
LEAST_BOUNDS = 2

# Rows per step, so that the distances to all entries stay small.
_ROWS = 4096
# More than the rounding errors of a few operations on distances.
_SLACK = 1e-9

_STATE = (
    "q binary, code binary, near binary, low binary, outer binary, upper binary, used binary, "
    "error long"
)


class Compressed(NamedTuple):
    """``vec_id``, ``label``, ``code`` (a byte per part) and ``error``; and the codebooks, by
    part, entry and position."""

    codes: DataFrame
    books: np.ndarray


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``label`` and ``q``, the vector in whole numbers, of the rows that are kept."""
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    whole = F.transform(
        "embedding",
        lambda x: F.floor(
            F.least(F.greatest(x.cast("double") * SCALE, F.lit(-LARGEST)), F.lit(LARGEST))
        ).cast("int"),
    )
    kept = vectors.where(F.col("embedding").isNotNull() & finite)
    return kept.select("vec_id", "label", whole.alias("q"))


def first_books(vectors: DataFrame, size: int, entries: int) -> np.ndarray:
    """The parts, of ``size`` components, of the rows with the smallest ids, by part and entry; at
    most ``entries`` rows reach the driver."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("q")]
    first = vectors.select("vec_id", "q").orderBy(*order).limit(entries).collect()
    rows = np.zeros((len(first), PARTS * size), np.int64)
    for place, row in enumerate(first):
        rows[place, : len(row.q)] = row.q
    return rows.reshape(len(first), PARTS, size).transpose(1, 0, 2)


def squares(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of rows to entries, in whole numbers."""
    size = max(np.abs(x).max(initial=0), np.abs(book).max(initial=0))
    if 4 * x.shape[1] * int(size) ** 2 < 2**53:  # every sum is exact in double precision
        a, b = x.astype(np.float64), book.astype(np.float64)
        cross = a @ b.T
        return ((a * a).sum(1)[:, None] - 2 * cross + (b * b).sum(1)).astype(np.int64)
    return np.stack([((x - entry) ** 2).sum(1) for entry in book], axis=1)


class Bounds(NamedTuple):
    """Per row: its entry and the next ones, their lower bounds, that of all others, the upper
    bound of its own entry, and how many bounds the last round needed."""

    near: np.ndarray
    low: np.ndarray
    outer: np.ndarray
    upper: np.ndarray
    used: np.ndarray


def searched(x: np.ndarray, book: np.ndarray, b: int) -> Bounds:
    """The bounds of rows that are compared with all entries; ties go to the lower number."""
    d = squares(x, book)
    rows = np.arange(len(x))
    own = d.argmin(1)
    mine = d[rows, own]
    d[rows, own] = -1
    b = min(b, len(book) - 1)
    outer = np.full(len(x), np.inf)
    order = np.argpartition(d, min(b + 1, len(book) - 1), axis=1)[:, : b + 2]
    order = np.take_along_axis(order, np.take_along_axis(d, order, 1).argsort(1), 1)
    found = np.sqrt(np.take_along_axis(d, order, 1).clip(0).astype(np.float64))
    if order.shape[1] > b + 1:
        outer = found[:, b + 1]
    return Bounds(
        order[:, : b + 1], found[:, 1 : b + 1], outer, np.sqrt(mine.astype(np.float64)),
        np.full(len(x), b + 1),
    )


def _needed(upper: np.ndarray, floors: np.ndarray) -> np.ndarray:
    """The place of the first floor that is above ``upper``; their number where none is."""
    above = upper[:, None] < floors
    return np.where(above.any(1), above.argmax(1), floors.shape[1])


def moved(x: np.ndarray, book: np.ndarray, move: np.ndarray, old: Bounds, b: int) -> Bounds:
    """The bounds after the entries moved by ``move`` to ``book``."""
    b = min(b, old.low.shape[1])
    near = old.near[:, : b + 1].astype(np.intp)
    outer = np.minimum(old.outer, old.low[:, b:].min(1, initial=np.inf))
    upper = (old.upper + move[near[:, 0]]) * (1 + _SLACK)
    low = np.column_stack([old.low[:, :b] - move[near[:, 1:]], outer - move.max(initial=0)])
    low = low - np.abs(low, where=np.isfinite(low), out=np.zeros_like(low)) * _SLACK - _SLACK
    floors = np.minimum.accumulate(low[:, ::-1], axis=1)[:, ::-1].copy()
    used = _needed(upper, floors)
    unsure = np.flatnonzero(used)
    exact = np.sqrt(((x[unsure] - book[near[unsure, 0]]) ** 2).sum(1).astype(np.float64))
    upper[unsure] = exact
    used[unsure] = _needed(exact * (1 + _SLACK), floors[unsure])

    some = np.flatnonzero((used > 0) & (used <= b))
    if len(some):
        most = used[some].max() + 1
        listed = near[some, :most]
        d = ((x[some, None, :] - book[listed]) ** 2).sum(2)
        farthest = np.iinfo(np.int64).max
        d[np.arange(most) > used[some, None]] = farthest
        least = d.min(1)
        own = np.where(d == least[:, None], listed, len(book)).min(1)
        rank = np.where(listed == own[:, None], -1, d)
        order = rank.argsort(1, kind="stable")
        near[some, :most] = np.take_along_axis(listed, order, 1)
        upper[some] = np.sqrt(least.astype(np.float64))
        d = np.take_along_axis(d, order, 1)[:, 1:]
        known = d < farthest
        floors[some, : most - 1] = np.where(
            known, np.sqrt(np.where(known, d, 0).astype(np.float64)), floors[some, : most - 1]
        )
    every = np.flatnonzero(used > b)
    if len(every):
        fresh = searched(x[every], book, b)
        near[every], floors[every, :b], floors[every, b] = fresh.near, fresh.low, fresh.outer
        upper[every] = fresh.upper
    return Bounds(near, floors[:, :b], floors[:, b], upper, used)


def _below(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


def _above(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(np.inf))


def _packed(rows: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(rows)
    size = rows[0].nbytes if len(rows) else 0
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(size)
    return pa.Array.from_buffers(
        pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)]
    )


def _unpacked(column: pa.Array, kind: str, *shape: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), *shape)


def _assigned(
    batch: pa.RecordBatch, books: np.ndarray, b: int, move: np.ndarray | None, schema: pa.Schema
) -> pa.RecordBatch:
    """The state of a batch under ``books``: from nothing, or from the state before the move."""
    _, entries, size = books.shape
    n = batch.num_rows
    if move is None:
        x = np.zeros((n, PARTS * size), np.int64)
        for place, vector in enumerate(batch.column("q").to_pylist()):
            x[place, : len(vector)] = vector
    else:
        x = _unpacked(batch.column("q"), "<i4", PARTS * size).astype(np.int64)
        old = {
            "near": _unpacked(batch.column("near"), "u1", PARTS, -1),
            "low": _unpacked(batch.column("low"), "<f4", PARTS, -1).astype(np.float64),
            "outer": _unpacked(batch.column("outer"), "<f4", PARTS).astype(np.float64),
            "upper": _unpacked(batch.column("upper"), "<f4", PARTS).astype(np.float64),
        }
    parts = x.reshape(n, PARTS, size)
    made = []
    for p in range(PARTS):
        if move is None:
            made.append(searched(parts[:, p], books[p], b))
        else:
            before = Bounds(*[column[:, p] for column in old.values()], np.zeros(n))
            made.append(moved(parts[:, p], books[p], move[p], before, b))
    near, low, outer, upper, used = (np.stack(column, axis=1) for column in zip(*made))
    entry = near[:, :, 0]
    errors = sum(((parts[:, p] - books[p][entry[:, p]]) ** 2).sum(1) for p in range(PARTS))
    columns = {
        "vec_id": batch.column("vec_id"),
        "label": batch.column("label"),
        "q": _packed(x.astype("<i4")),
        "code": _packed(entry.astype("u1")),
        "near": _packed(near.astype("u1")),
        "low": _packed(_below(low)),
        "outer": _packed(_below(outer)),
        "upper": _packed(_above(upper)),
        "used": _packed(used.astype("u1")),
        "error": pa.array(errors, pa.int64()),
    }
    return pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in schema], schema=schema)


def _assign(table: DataFrame, books: np.ndarray, b: int, move: np.ndarray | None = None) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    kinds = {name: table.schema[name].dataType.simpleString() for name in ("vec_id", "label")}
    schema = ", ".join([*(f"{name} {kind}" for name, kind in kinds.items()), _STATE])
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                yield _assigned(batch.slice(at, _ROWS), books, b, move, arrow)

    return table.mapInArrow(run, schema)


def _refined(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks with every used entry replaced by the floor of the mean of its parts."""
    _, entries, size = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((PARTS, entries), np.int64)
        sums = np.zeros((PARTS, entries, size), np.int64)
        for batch in batches:
            entry = _unpacked(batch.column("code"), "u1", PARTS)
            parts = _unpacked(batch.column("q"), "<i4", PARTS, size)
            for p in range(PARTS):
                counts[p] += np.bincount(entry[:, p], minlength=entries)
                np.add.at(sums[p], entry[:, p], parts[:, p].astype(np.int64))
        part, number = np.nonzero(counts)
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array(part, pa.int32()),
                "entry": pa.array(number, pa.int32()),
                "n": pa.array(counts[part, number], pa.int64()),
                "sums": pa.array(list(sums[part, number]), pa.list_(pa.int64())),
            }
        )

    summed = state.select("code", "q").mapInArrow(run, "part int, entry int, n long, sums array<long>")
    totals = [F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(size)]
    refined = books.copy()
    # one row per part and entry that is used
    for part, entry, n, *total in summed.groupBy("part", "entry").agg(F.sum("n"), *totals).collect():
        refined[part, entry] = [value // n for value in total]
    return refined


def _adapted(state: DataFrame, b: int, entries: int) -> int:
    """The number of bounds, at most ``b``, that would have cost the least in the last round:
    one comparison per bound and part, and all entries for each part that needs more."""
    used = F.explode(F.transform(F.sequence(F.lit(1), F.lit(PARTS)), _byte("used")))
    needed = np.zeros(b + 2, np.int64)
    for place, n in state.select(used.alias("used")).groupBy("used").count().collect():
        needed[min(place, b + 1)] += n
    beyond = needed.sum() - needed.cumsum()
    costs = [needed.sum() * c + entries * beyond[c] for c in range(b + 1)]
    return max(min(LEAST_BOUNDS, b), int(np.argmin(costs)))


def _byte(column: str) -> Callable:
    return lambda at: F.conv(F.hex(F.substring(F.col(column), at, F.lit(1))), 16, 10).cast("int")


def compress(
    vectors: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS, bounds: int = FIRST_BOUNDS
) -> Compressed:
    """Codes of all vectors (``vec_id``, ``embedding``, ``label``) and the codebooks behind them.

    ``entries`` is at most 256. Runs jobs; the last state stays in the shared folder.
    """
    whole = whole_vectors(vectors)
    longest = whole.agg(F.max(F.size("q"))).first()[0] or 0
    size = -(-longest // PARTS)
    books = first_books(whole, size, entries)
    b = max(min(bounds, books.shape[1] - 1), 0)
    state = materialize(_assign(whole, books, b), "codes-state")
    for _ in range(rounds):
        if not books.size:
            break
        last, refined = state, _refined(state, books)
        move = np.sqrt(((refined - books) ** 2).sum(2).astype(np.float64)) * (1 + _SLACK)
        books = refined
        state = materialize(_assign(last, books, b, move), "codes-state")
        release(last)
        b = _adapted(state, b, entries)
    return Compressed(state.select("vec_id", "label", "code", "error"), books)


def with_label_error(codes: DataFrame) -> DataFrame:
    """``codes`` with the sum of the errors of their label in ``label_error``, nulls together.

    A label that holds more than a partition's share of the rows is spread over as many slices.
    """
    parts = shuffle_partitions(codes.sparkSession)
    total = codes.count() or 1
    shares = F.ceil(F.col("_n") * parts / total)
    sums = codes.groupBy(F.col("label").alias("_label")).agg(
        F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("_n")
    )
    sums = materialize(sums.withColumn("_slices", F.greatest(shares, F.lit(1))), "label-sums")
    # each of these holds more than one share, so there are fewer than partitions
    large = sums.where("_slices > 1").select(F.col("_label").alias("_large"), "_slices")
    slot = F.pmod(F.xxhash64("vec_id", "code", "error"), F.coalesce("_slices", F.lit(1)))
    spread = codes.join(F.broadcast(large), codes["label"].eqNullSafe(F.col("_large")), "left")
    spread = spread.withColumn("_slot", slot).drop("_slices", "_large")
    copies = sums.select(
        "_label", "label_error", F.explode(F.expr("sequence(0L, _slices - 1)")).alias("_slice")
    )
    same = spread["label"].eqNullSafe(copies["_label"]) & (F.col("_slot") == F.col("_slice"))
    return spread.join(copies, same).select(*codes.columns, "label_error")
