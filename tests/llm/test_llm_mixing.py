import math
import random

import pytest
from pyspark.sql import functions as F

from llm_frames import WORD, documents, some_words
from wayposts.llm import mixing
from wayposts.sources.tables import literal_frame


def _expected_targets(sizes, weights=(1, 2, 3), most=3):
    """Shares by repeated sharing of what is left among the sources that have room."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    targets, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if most * sizes[s] <= left * weight[s] / total}
        if not full:
            return targets | {s: left * weight[s] / total for s in open_}
        for s in full:
            targets[s] = float(most * sizes[s])
        left -= sum(targets[s] for s in full)
        open_ -= full
    return targets


@pytest.fixture(scope="module")
def rows():
    chance = random.Random(5)
    sources = ["b", "a", None, "é", "z", "tiny", "z"]
    found = [
        (i, " ".join(some_words(chance, chance.randrange(80))), chance.choice(sources[:5]))
        for i in range(300)
    ]
    found += [(300 + i, " ".join(some_words(chance, 40)), "hot") for i in range(150)]
    found += [
        (900, "one two", "tiny"), (901, None, "tiny"), (902, "", "a"), (903, "\t\n ", "a"),
        (904, " ".join(some_words(chance, 20_000)), "a"), (None, "x y z", "a"),
        (905, "same row", "z"), (905, "same row", "z"),
    ]
    return found


def test_targets_and_words_taken(spark, rows):
    found = mixing.mix(documents(spark, rows)).collect()
    assert len(found) == len(rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    targets = _expected_targets(sizes)
    by_source = {}
    of = {(doc_id, len(WORD.findall(text or ""))): source for doc_id, text, source in rows}
    for r in found:
        source = of[r["doc_id"], r["size"]]
        assert r["source_size"] == sizes[source]
        assert math.isclose(r["target"], targets[source])
        assert 0 <= r["taken"] <= 3 * r["size"]
        by_source[source] = by_source.get(source, 0) + r["taken"]
    assert math.isclose(sum(targets.values()), sum(sizes.values()))
    for source, taken in by_source.items():
        assert abs(taken - targets[source]) <= 0.5
    assert sorted(map(str, mixing.mix(documents(spark, rows)).collect())) == sorted(map(str, found))


def test_the_schedule_is_spread_evenly(spark):
    sizes = literal_frame(
        spark, [("a", 600_000), ("b", 300_000), ("c", 20_000)], "source string, source_size long"
    )
    targets = mixing.source_targets(sizes)
    share = {r["sid"]: r["target"] / 920_000 for r in targets.collect()}
    slots = mixing.schedule(targets, 920_000, 100).where("slot is not null")
    for until in (50, 700, 9200):
        counts = dict(slots.where(F.col("slot") < until).groupBy("sid").count().collect())
        for sid, part in share.items():
            assert abs(counts.get(sid, 0) - part * until) < 4
    ranks = slots.groupBy("sid").agg(F.min("rank"), F.max("rank"), F.count_distinct("rank")).collect()
    for _, low, high, n in ranks:
        assert low == 0 and high == n - 1


def test_points_are_exact_beyond_doubles(spark):
    for slot in (1, 10**6 + 3, 2**39 + 12345):
        point = spark.range(1).select(mixing.point(F.lit(slot))).first()[0]
        assert point == slot * mixing._GOLDEN % 2**40


def test_mixed_documents_come_as_often_as_they_are_taken(spark, rows):
    docs = documents(spark, rows)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    copies = {}
    for r in mixed.select("doc_id", "text").collect():
        copies[tuple(r)] = copies.get(tuple(r), 0) + 1
    texts = {(d, len(WORD.findall(t or ""))): t for d, t, _ in rows}
    expected = {}
    for r in mixing.mix(docs).collect():
        if n := math.floor(r["taken"] / max(r["size"], 1) + 0.5):
            key = (r["doc_id"], texts[r["doc_id"], r["size"]])
            expected[key] = expected.get(key, 0) + n
    assert copies == expected
    assert mixed.where("label <> 'kept'").count() == 0


def test_rows_that_differ_only_in_the_place_of_a_null(spark):
    rows = [(1, "a b c", None, "en"), (1, "a b c", "en", None), (1, "a b c", None, "en")]
    docs = literal_frame(spark, rows, "doc_id long, text string, source string, lang string")
    # all are taken once or more, as two sources of unlike size share the words by weight
    copies = {}
    for r in mixing.mixed_documents(docs).collect():
        copies[r["source"], r["lang"]] = copies.get((r["source"], r["lang"]), 0) + 1
    taken = {}
    for r in mixing.mix(docs.withColumn("s", F.col("source")), (1, 2, 3), 3, 1024, "s").collect():
        taken[r["s"]] = taken.get(r["s"], 0) + math.floor(r["taken"] / 3 + 0.5)
    assert copies == {("en", None): taken["en"], (None, "en"): taken[None]}
    assert copies.keys() == {(None, "en"), ("en", None)}


def test_mixed_documents_come_in_slot_order(spark):
    chance = random.Random(9)
    rows = [(i, " ".join(some_words(chance, 200)), "abc"[i * i % 3]) for i in range(900)]
    docs = documents(spark, rows)
    mixed = [r["source"] for r in mixing.mixed_documents(docs).collect()]
    target = {r["source"]: r["target"] for r in mixing.source_targets(
        docs.groupBy("source").agg(F.sum(mixing.n_words(F.col("text"))).alias("source_size"))).collect()}
    total = sum(target.values())
    for until in range(90, len(mixed), 90):
        for source, words in target.items():
            assert abs(mixed[:until].count(source) - until * words / total) <= 16


def test_texts_are_joined_by_shuffle_at_every_size(spark, rows):
    mixed = mixing.mixed_documents(documents(spark, rows))
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, ""), (2, " ")]])
def test_nothing_to_mix(spark, rows):
    found = mixing.mix(documents(spark, rows)).collect()
    assert [(r["taken"], r["target"]) for r in found] == [(0, 0.0)] * len(rows)
    assert mixing.mixed_documents(documents(spark, rows)).count() == 0
