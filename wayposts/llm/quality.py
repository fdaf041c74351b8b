"""Quality rules: a decision list learned by sequential covering, applied as Spark expressions.

The statistics of a text are DataFrame expressions. Rules that reject are conjunctions of
thresholds on them: each is grown on one part of a labelled sample by information gain, pruned
on the other part, and kept while it is precise there; the documents that it covers are taken
out before the next one is grown. The list becomes one ``CASE WHEN``.

Defined cases: a null text is an empty one; a text without words has zero for every statistic
and fails the base rules; without labels the list is empty, so only the base rules reject.
Rows are judged one by one, so equal rows get equal verdicts, and other columns are not read.
"""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayposts.llm.text import SPACES, has_word, let, whole, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5
# The learner sees at most this many labelled documents, the first by hash of their id.
SAMPLE_ROWS = 20_000
THRESHOLDS = 32
MOST_CONDITIONS = 4
MOST_RULES = 12
LEAST_PRECISION = 0.9
LEAST_COVERED = 5

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "n_words",
    "mean_word_chars",
    "symbol_share",
    "upper_share",
    "dup_line_share",
    "repeat_share",
    "bangs_a_word",
)


def _repeated_words(found: Column) -> Column:
    """Words in windows of five that occur twice or more in the text, the first included."""

    def hashed(w: Column) -> Column:
        window = lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)])
        return F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), window)

    def any_twice(s: Column) -> Column:
        return F.exists(
            F.sequence(F.lit(1), F.size(s) - 1), lambda i: F.get(s, i) == F.get(s, i - 1)
        )

    def twice(s: Column) -> Column:
        """Places of the windows with an equal neighbour in the sorted list."""
        key = lambda i: F.get(s, i)["h"]
        same = F.filter(
            F.transform(
                F.sequence(F.lit(0), F.size(s) - 1),
                lambda i: F.when(
                    key(i).eqNullSafe(key(i - 1)) | key(i).eqNullSafe(key(i + 1)),
                    F.get(s, i)["p"],
                ),
            ),
            lambda p: p.isNotNull(),
        )
        return F.sort_array(same)

    def covered(p: Column) -> Column:
        gaps = F.transform(
            F.sequence(F.lit(0), F.size(p) - 1),
            lambda i: F.least(
                F.coalesce(F.get(p, i + 1) - F.get(p, i), F.lit(WINDOW)), F.lit(WINDOW)
            ),
        )
        return F.aggregate(gaps, F.lit(0), lambda total, x: total + x)

    def count(h: Column) -> Column:
        placed = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p")))
        in_full = let(let(F.sort_array(placed), twice), covered)
        some = (F.size(h) > 1) & let(F.sort_array(h), any_twice)
        return F.when(some, in_full).otherwise(0)

    return F.when(F.size(found) <= WINDOW, 0).otherwise(let(let(found, hashed), count))


def with_statistics(docs: DataFrame, prefix: str = "") -> DataFrame:
    """``docs`` with the counts of each text and the shares that the rules look at."""
    text = whole(F.col("text"))

    def counts(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            _repeated_words(w).cast("long").alias("n_repeat_words"),
        )

    lines = F.filter(F.split(text, "\n"), has_word)
    without = lambda chars: F.length(F.translate(text, chars, ""))
    upper = F.length(F.regexp_replace(text, r"[^\p{Lu}]", ""))
    everything = F.struct(
        let(words(F.col("text")), counts).alias("w"),
        without(SPACES).cast("long").alias("word_chars"),
        (F.length(text) - without(SYMBOLS)).cast("long").alias("n_symbols"),
        let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("long").alias(
            "n_dup_lines"
        ),
        let(lines, F.size).alias("n_lines"),
        upper.alias("n_upper"),
        (F.length(text) - without("!")).alias("n_bangs"),
    )
    share = lambda part, of: F.coalesce(part / F.nullif(of, F.lit(0)), F.lit(0.0))

    def derived(s: Column) -> Column:
        n, chars = s["w"]["n_words"], s["word_chars"]
        return F.struct(
            n.alias("n_words"),
            chars.alias("word_chars"),
            s["n_symbols"].alias("n_symbols"),
            s["n_dup_lines"].alias("n_dup_lines"),
            s["w"]["n_repeat_words"].alias("n_repeat_words"),
            share(chars, n).alias("mean_word_chars"),
            share(s["n_symbols"], chars).alias("symbol_share"),
            share(s["n_upper"], chars).alias("upper_share"),
            share(s["n_dup_lines"], s["n_lines"]).alias("dup_line_share"),
            share(s["w"]["n_repeat_words"], n).alias("repeat_share"),
            share(s["n_bangs"], n).alias("bangs_a_word"),
        )

    stats = f"{prefix}stats"
    return docs.withColumn(stats, let(everything, derived))


def base_failed(stats: Column) -> Column:
    return (stats["n_words"] < 10) | (100 * stats["n_repeat_words"] > 20 * stats["n_words"])


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self, stats: Column) -> Column:
        value = stats[self.feature].cast("double")
        return value >= self.threshold if self.above else value <= self.threshold


Rule = tuple[Condition, ...]


def _holds(rule: Rule, x: np.ndarray, names: tuple[str, ...]) -> np.ndarray:
    held = np.ones(len(x), bool)
    for c in rule:
        value = x[:, names.index(c.feature)]
        held &= value >= c.threshold if c.above else value <= c.threshold
    return held


def _grow(x: np.ndarray, bad: np.ndarray, names: tuple[str, ...], most: int) -> Rule:
    """Conditions added one by one, each the best by FOIL's information gain."""
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, THRESHOLDS))) for f in range(x.shape[1])]
    rule: list[Condition] = []
    inside = np.ones(len(x), bool)
    while len(rule) < most and (inside & ~bad).any():
        p0, n0 = (inside & bad).sum(), (inside & ~bad).sum()
        best = (0.0, None, None)
        for f, name in enumerate(names):
            for cut in cuts[f]:
                for above in (True, False):
                    held = inside & (x[:, f] >= cut if above else x[:, f] <= cut)
                    p, n = (held & bad).sum(), (held & ~bad).sum()
                    if p:
                        gain = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))
                        if gain > best[0] + 1e-9:
                            best = (gain, Condition(name, above, float(cut)), held)
        if best[1] is None:
            break
        rule.append(best[1])
        inside = best[2]
    return tuple(rule)


def _prune(rule: Rule, x: np.ndarray, bad: np.ndarray, names: tuple[str, ...]) -> Rule:
    """The shortest beginning of the rule that does best on rows it was not grown on."""

    def worth(size: int) -> tuple[float, int]:
        held = _holds(rule[:size], x, names)
        p, n = (held & bad).sum(), (held & ~bad).sum()
        return ((p - n) / (p + n) if p + n else -1.0, -size)

    return rule[: max(range(1, len(rule) + 1), key=worth)]


def learn_rules(x: np.ndarray, bad: np.ndarray, names: tuple[str, ...] = FEATURES) -> list[Rule]:
    """An ordered list of rules, each covering rows with ``bad`` true that those before left."""
    rules: list[Rule] = []
    growing = np.arange(len(x)) % 3 != 2
    while len(rules) < MOST_RULES and (bad & growing).any():
        rule = _grow(x[growing_rows := growing.nonzero()[0]], bad[growing_rows], names, MOST_CONDITIONS)
        held_out = np.setdiff1d(np.arange(len(x)), growing_rows)
        if not rule or not len(held_out):
            break
        rule = _prune(rule, x[held_out], bad[held_out], names)
        held = _holds(rule, x[held_out], names)
        hits = (held & bad[held_out]).sum()
        if hits < LEAST_COVERED or hits < LEAST_PRECISION * held.sum():
            break
        rules.append(rule)
        left = ~_holds(rule, x, names)
        x, bad, growing = x[left], bad[left], growing[left]
    return rules


def fit_rules(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules from a bounded sample of the labelled documents: ``quality`` 0 is to be rejected."""
    order = F.xxhash64("doc_id")
    sample = (
        labels.select("doc_id", "quality")
        .where("doc_id is not null and quality in (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(order, "doc_id")
        .limit(sample_rows)
    )
    # at most sample_rows pairs of a long and an int, so safe to broadcast
    labelled = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    # not filtered here, as Spark would then compute the statistics of all documents first
    stats = with_statistics(labelled).select(order.alias("o"), "quality", "stats.*")
    rows = stats.orderBy("o", *FEATURES).limit(sample_rows).collect()
    rows = [
        r for r in rows if r["n_words"] >= 10 and 100 * r["n_repeat_words"] <= 20 * r["n_words"]
    ]
    if not rows:
        return []
    x = np.array([[float(r[f]) for f in FEATURES] for r in rows])
    return learn_rules(x, np.array([r["quality"] == 0 for r in rows]))


def verdict(rules: list[Rule], stats: Column) -> Column:
    """The number of the first rule that rejects, 0 for the base rules, null if none does."""
    first = F.when(base_failed(stats), 0)
    for number, rule in enumerate(rules, start=1):
        held = rule[0].column(stats)
        for condition in rule[1:]:
            held = held & condition.column(stats)
        first = first.when(held, number)
    return first


def judged(docs: DataFrame, labels: DataFrame, prefix: str = "") -> DataFrame:
    """``docs`` with a struct ``stats`` and ``rule``, the number of the rule that rejects."""
    rules = fit_rules(docs, labels)
    scored = with_statistics(docs, prefix)
    return scored.withColumn(f"{prefix}rule", verdict(rules, F.col(f"{prefix}stats")))


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that no rule rejects, with their own columns."""
    prefix = "_quality_"
    return judged(docs, labels, prefix).where(f"{prefix}rule is null").select(
        *[f"`{c}`" for c in docs.columns]
    )
