"""Toxicity: a linear-chain conditional random field marks toxic words, documents add them up.

Cues (whole words and beginnings of words) come from the labelled documents: those in many
more toxic documents than clean ones. A word is observed as its strongest cue or as none. Words
of toxic documents with a strong cue are the toxic tokens the field is trained on. Its
forward-backward marginals are the chance of each word to be toxic; a logistic regression on
their sum, mean and largest value gives the score of a document, and words above one half are
the offending spans. Labels decide about cues, field and regression only; id, language and
source are never looked at.

The cues are counted in all labelled texts. The field learns from windows of a bounded number of
whole texts: labelled texts by hash, and for every cue a text that holds it, so that no cue is
unknown to the field wherever it stands. Of the windows, wherever in their texts, some are taken
by hash for each label, and one for every cue.

Defined cases: a null or empty text has no words and the score of such a text; without labels
of both kinds every score is 0; equal rows get equal scores; other columns are not read.
"""

import re
import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayposts.llm.arrow import WORD, map_batches
from wayposts.sources.shared_folder import materialize, release
from wayposts.sources.tables import literal_frame

PREFIXES = range(4, 9)
# Bounds of what is learned: cues kept; documents taken by hash for the field beside one per
# cue, words in a window, and windows taken by hash beside one per cue; and documents for the
# regression (their marginals only).
CUES = 5_000
FIELD_DOCS = 2_000
WINDOW_WORDS = 256
FIELD_WINDOWS = 4_000
SCORE_DOCS = 10_000
LEAST_TOXIC_DOCS = 8
LEAST_LOG_ODDS = 1.5
STRONG_LOG_ODDS = 2.5
KEPT_WORDS = 300_000
CELLS = 500_000

_TRIM = re.compile(r"^\W+|\W+$")


def plain(word: str) -> str:
    return _TRIM.sub("", word).lower()


def cue_names(word: str) -> list[str]:
    return [f"={word}"] + [f"<{word[:n]}" for n in PREFIXES if len(word) >= n]


def find_cues(labelled: DataFrame) -> tuple[list[tuple[str, float]], list]:
    """At most ``CUES`` cues with their log-odds, from (``doc_id``, ``text``, ``toxic``) rows, and
    for each the id of a toxic document that holds it."""

    def start() -> Callable[[dict], dict]:
        def work(batch: dict) -> dict:
            counts: dict[str, list[int]] = {}
            holders: dict[str, object] = {}
            for doc_id, text, toxic in zip(batch["doc_id"], batch["text"], batch["toxic"]):
                for word in {plain(w) for w in set(WORD.findall(text or ""))}:
                    if word:
                        counts.setdefault(word, [0, 0])[toxic] += 1
                        if toxic:
                            holders.setdefault(word, doc_id)
            return {
                "word": list(counts),
                "clean": [c[0] for c in counts.values()],
                "toxic": [c[1] for c in counts.values()],
                "holder": [holders.get(word) for word in counts],
            }

        return work

    totals = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not totals.get(0) or not totals.get(1):
        return [], []
    kind = labelled.schema["doc_id"].dataType.simpleString()
    added = [F.sum(c).alias(c) for c in ("clean", "toxic")] + [F.min("holder").alias("holder")]
    words = (
        map_batches(
            labelled.select("doc_id", "text", "toxic"),
            start,
            f"word string, clean long, toxic long, holder {kind}",
        )
        .groupBy("word")
        .agg(*added)
    )
    begun = F.transform(
        F.filter(F.array(*[F.lit(n) for n in PREFIXES]), lambda n: F.length("word") >= n),
        lambda n: F.concat(F.lit("<"), F.substring(F.col("word"), F.lit(1), n)),
    )
    cues = (
        words.select(
            F.explode(F.concat(F.array(F.concat(F.lit("="), F.col("word"))), begun)).alias("cue"),
            "clean",
            "toxic",
            "holder",
        )
        .groupBy("cue")
        .agg(*added)
        .where(F.col("toxic") >= LEAST_TOXIC_DOCS)
    )
    rate = lambda c, n: (F.col(c) + 0.5) / (n + 1)
    odds = F.log(rate("toxic", totals[1]) / rate("clean", totals[0]))
    found = (
        cues.withColumn("odds", odds)
        .where(F.col("odds") >= LEAST_LOG_ODDS)
        .orderBy(F.desc("odds"), "cue")
        .limit(CUES)
        .collect()
    )
    return [(r["cue"], r["odds"]) for r in found], sorted({r["holder"] for r in found})


class Observer:
    """Turns words into numbers of cues, from 1, strongest first; 0 is no cue."""

    def __init__(self, cues: list[tuple[str, float]]):
        self.number = {cue: i for i, (cue, _) in enumerate(cues, start=1)}
        self.known: dict[str, int] = {}

    def __call__(self, words: list[str]) -> list[int]:
        known = self.known
        if len(known) > KEPT_WORDS:
            known.clear()
        seen = []
        for word in words:
            n = known.get(word)
            if n is None:
                found = [self.number[c] for c in cue_names(plain(word)) if c in self.number]
                known[word] = n = min(found, default=0)
            seen.append(n)
        return seen


@dataclass
class Field:
    """Weights: ``emit`` per cue for the toxic state, ``step`` between states, ``first``."""

    emit: np.ndarray
    step: np.ndarray
    first: float


def forward_backward(seen: np.ndarray, sizes: np.ndarray, field: Field) -> tuple[np.ndarray, np.ndarray]:
    """Chance of the toxic state at each place, and of the four steps before each place.

    ``seen`` is places by sequences, ``sizes`` are their lengths. Messages are kept
    as the share of the toxic state, so nothing under- or overflows.
    """
    places, n = seen.shape
    ratio = np.exp(np.clip(field.emit, -30, 30))[seen]
    m = np.exp(field.step)
    ahead = np.empty((places, n))
    now = 1 / (1 + np.exp(-field.first)) * np.ones(n)
    for t in range(places):
        if t:
            low, high = (1 - now) * m[0, 0] + now * m[1, 0], (1 - now) * m[0, 1] + now * m[1, 1]
        else:
            low, high = 1 - now, now
        high = high * ratio[t]
        now = high / (low + high)
        ahead[t] = now
    back = np.full((places, n), 0.5)
    for t in range(places - 2, -1, -1):
        low, high = 1 - back[t + 1], back[t + 1] * ratio[t + 1]
        to_low, to_high = m[0, 0] * low + m[0, 1] * high, m[1, 0] * low + m[1, 1] * high
        back[t] = np.where(t + 1 < sizes, to_high / (to_low + to_high), 0.5)
    high = ahead * back
    return high / (high + (1 - ahead) * (1 - back)), _steps(ahead, back, ratio, m, sizes)


def _steps(ahead, back, ratio, m, sizes) -> np.ndarray:
    """Expected number of each step, over all sequences."""
    if len(ahead) < 2:
        return np.zeros((2, 2))
    inside = np.arange(1, len(ahead))[:, None] < sizes
    a = (1 - ahead[:-1], ahead[:-1])
    b = (1 - back[1:], back[1:] * ratio[1:])
    joint = np.array([[a[i] * m[i, j] * b[j] for j in range(2)] for i in range(2)])
    joint /= joint.sum((0, 1))
    return (joint * inside).sum((2, 3))


def train_field(rows: list[tuple[list[int], int]], strong: int, cues: int, rounds: int = 40) -> Field:
    """The field of highest likelihood, with a small penalty on weights, by gradient ascent.

    ``rows`` are observed words and the document's label; the first ``strong`` cues make a word
    of a toxic document a toxic token.
    """
    field = Field(np.zeros(cues + 1), np.zeros((2, 2)), 0.0)
    rows = [r for r in rows if r[0]]
    if not rows:
        return field
    sizes = np.array([len(r[0]) for r in rows])
    seen = np.zeros((sizes.max(), len(rows)), np.int32)
    for k, (words, _) in enumerate(rows):
        seen[: len(words), k] = words
    inside = np.arange(len(seen))[:, None] < sizes
    toxic = (seen > 0) & (seen <= strong) & np.array([r[1] == 1 for r in rows]) & inside
    counted = np.bincount(seen[toxic], minlength=cues + 1)
    pairs = np.zeros((2, 2))
    both = inside[1:]
    for i in range(2):
        for j in range(2):
            pairs[i, j] = ((toxic[:-1] == i) & (toxic[1:] == j) & both).sum()
    weights = np.zeros(cues + 1 + 5)
    moment, spread = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, rounds + 1):
        p, expected = forward_backward(seen, sizes, field)
        gradient = np.concatenate(
            [
                counted - np.bincount(seen.ravel(), (p * inside).ravel(), minlength=cues + 1),
                (pairs - expected).ravel(),
                [toxic[0].sum() - p[0].sum()],
            ]
        ) / len(rows) - 1e-4 * weights
        moment = 0.9 * moment + 0.1 * gradient
        spread = 0.99 * spread + 0.01 * gradient**2
        weights += 0.3 * moment / (1 - 0.9**step) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-8)
        field = Field(weights[: cues + 1], weights[cues + 1 : cues + 5].reshape(2, 2), weights[-1])
    return field


def marginals(observed: list[list[int]], field: Field) -> list[np.ndarray]:
    """The chance of each word to be toxic, per text; texts of like length go together."""
    found: list[np.ndarray] = [np.zeros(0)] * len(observed)
    order = sorted((k for k in range(len(observed)) if observed[k]), key=lambda k: len(observed[k]))
    while order:
        longest = len(observed[order[-1]])
        group = order[-max(1, CELLS // longest) :]
        del order[-len(group) :]
        sizes = np.array([len(observed[k]) for k in group])
        seen = np.zeros((longest, len(group)), np.int32)
        for column, k in enumerate(group):
            seen[: sizes[column], column] = observed[k]
        p, _ = forward_backward(seen, sizes, field)
        for column, k in enumerate(group):
            found[k] = p[: sizes[column], column]
    return found


def summary(p: np.ndarray) -> tuple[float, float, float]:
    if not len(p):
        return 0.0, 0.0, 0.0
    return float(np.log1p(p.sum())), float(p.mean()), float(p.max())


def fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 25) -> np.ndarray:
    """Weights (bias first) by Newton's method, with a small penalty."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-2 * np.eye(len(w))
        w = w + np.linalg.solve(hessian, x.T @ (y - p) - 1e-2 * w)
    return w


@dataclass
class Model:
    cues: list[tuple[str, float]]
    field: Field
    weights: np.ndarray


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """A model from documents and the (``doc_id``, ``toxic``) rows of those to learn from.

    None if one of the labels does not occur.
    """
    texts, labels = docs.select("doc_id", "text"), labels.select("doc_id", "toxic")
    # one way of joining at every size, so that a small trial tells what a large run will move
    known = labels.hint("merge")
    cues, holders = find_cues(texts.join(known, "doc_id"))
    if not cues:
        return None
    order = (F.xxhash64("doc_id"), F.col("doc_id"))

    def sample(rows: DataFrame, most: int) -> DataFrame:
        # at most a few thousand pairs of a long and an int, so safe to broadcast
        return texts.join(F.broadcast(rows.orderBy(*order).limit(most)), "doc_id")

    each = [labels.where(F.col("toxic") == label) for label in (0, 1)]
    chosen = [rows.orderBy(*order).limit(FIELD_DOCS // 2) for rows in each]
    # at most one for each cue
    chosen.append(each[1].join(F.broadcast(_ids(labels, holders)), "doc_id", "left_semi"))
    chosen = chosen[0].unionByName(chosen[1]).unionByName(chosen[2]).distinct()
    few = texts.join(F.broadcast(chosen), "doc_id")
    strong = sum(odds >= STRONG_LOG_ODDS for _, odds in cues)
    field = train_field(field_windows(few, cues), strong, len(cues))
    seen = _summaries(sample(labels, SCORE_DOCS), cues, field, "toxic")
    seen = seen.select("summary", "toxic").limit(2 * SCORE_DOCS).collect()
    x = np.array([r["summary"] for r in seen])
    return Model(cues, field, fit_logistic(x, np.array([r["toxic"] for r in seen], float)))


def _ids(labels: DataFrame, ids: list) -> DataFrame:
    kind = T.StructType([labels.schema["doc_id"]])
    return literal_frame(labels.sparkSession, [(i,) for i in ids], kind)


def field_windows(
    docs: DataFrame, cues: list[tuple[str, float]], most: int = FIELD_WINDOWS
) -> list[tuple[list[int], int]]:
    """Windows of the whole texts of (``doc_id``, ``text``, ``toxic``) rows, as numbers of cues,
    with the label: ``most`` / 2 of each label by hash, and for every cue one of a toxic text."""

    def start() -> Callable[[dict], dict]:
        observe = Observer(cues)

        def work(batch: dict) -> dict:
            made: dict[str, list] = {"seen": [], "toxic": [], "draw": []}
            for doc_id, text, toxic in zip(batch["doc_id"], batch["text"], batch["toxic"]):
                seen = observe(WORD.findall(text or ""))
                for at in range(0, len(seen), WINDOW_WORDS):
                    made["seen"].append(seen[at : at + WINDOW_WORDS])
                    made["toxic"].append(toxic)
                    made["draw"].append(zlib.crc32(f"{doc_id}:{at}".encode()))
            return made

        return work

    windows = materialize(
        map_batches(
            docs.select("doc_id", "text", "toxic"), start, "seen array<int>, toxic int, draw long"
        ),
        "toxic-windows",
    )
    by_hash = [
        windows.where(F.col("toxic") == label).orderBy("draw", "seen").limit(most // 2)
        for label in (0, 1)
    ]
    held = F.explode(F.array_distinct(F.filter("seen", lambda cue: cue > 0))).alias("cue")
    first = F.min(F.struct("draw", "seen", "toxic")).alias("first")
    by_cue = windows.where("toxic = 1").select(held, "draw", "seen", "toxic").groupBy("cue")
    by_cue = by_cue.agg(first).select("first.seen", "first.toxic", "first.draw")
    taken = by_hash[0].unionByName(by_hash[1]).unionByName(by_cue).distinct()
    rows = taken.orderBy("draw", "toxic", "seen").limit(most + len(cues)).collect()
    release(windows)
    return [(r["seen"], r["toxic"]) for r in rows]


def _summaries(docs: DataFrame, cues, field: Field, *carried: str) -> DataFrame:
    """Per text the summary of its marginals and its offending spans."""
    names = ("doc_id", *carried)

    def start() -> Callable[[dict], dict]:
        observe = Observer(cues)

        def work(batch: dict) -> dict:
            texts = [text or "" for text in batch["text"]]
            found = marginals([observe(WORD.findall(text)) for text in texts], field)
            spans = []
            for text, p in zip(texts, found):
                hit = p > 0.5
                places = [m.span() for m in WORD.finditer(text)] if hit.any() else []
                spans.append(",".join(f"{s}:{e}" for (s, e), h in zip(places, hit) if h))
            made = {name: batch[name] for name in names}
            return made | {"summary": [summary(p) for p in found], "spans": spans}

        return work

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in names)
    return map_batches(
        docs.select(*names, "text"), start, f"{kinds}, summary array<double>, spans string"
    )


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id``, ``score`` and ``spans`` (start:end in code points, comma-joined)."""
    if model is None:
        return docs.select("doc_id", F.lit(0.0).alias("score"), F.lit("").alias("spans"))
    bias, *weights = map(float, model.weights)
    total = F.lit(bias)
    for place, weight in enumerate(weights):
        total = total + F.get("summary", F.lit(place)) * weight
    return _summaries(docs, model.cues, model.field).select(
        "doc_id", (1 / (1 + F.exp(-total))).alias("score"), "spans"
    )
