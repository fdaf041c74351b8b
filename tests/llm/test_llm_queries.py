"""The registered queries against their SQL, and the pipeline stage by stage."""

import math
import zlib

import duckdb
import pytest

import corpus_pipeline
from llm_frames import WORD, deleted_lines, jaccard, repeated_words
from wayposts.llm import mixing, queries

SF_DIR = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.queries()) == list(range(1, 14))
    assert queries.oracle_sql().keys() <= queries.queries().keys()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equal(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings"):
        connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    cursor = connection.execute(queries.oracle_sql()[name])
    columns = [column[0] for column in cursor.description]
    result = queries.queries()[name](spark, SF_DIR)
    assert sorted(result.columns) == sorted(columns)
    assert sorted(map(tuple, result.select(*columns).collect())) == sorted(cursor.fetchall())


def test_results_follow_the_contracts(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    texts = {r["doc_id"]: r["text"] for r in rows}
    run = lambda name: queries.queries()[name](spark, SF_DIR).collect()
    for r in run("op2_quality"):
        n = len(WORD.findall(texts[r["doc_id"]]))
        failed = n < 10 or 100 * repeated_words(WORD.findall(texts[r["doc_id"]])) > 20 * n
        assert r["base_failed"] == failed and not (failed and r["kept"])
    for r in run("op5_toxicity"):
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert r["predicted"] == (r["score"] >= 0.7)
    assert {r["doc_id"] for r in run("op6_near")} == set(texts)


@pytest.fixture(scope="module")
def steps(spark):
    """The documents that each stage got, and the last one's result."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, found = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        found[name] = docs.collect()
        docs = stage(spark, docs, SF_DIR).persist()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    found["packed"] = docs.collect()
    return found


def test_quality_stage_keeps_only_documents_that_pass(steps):
    before, after = steps["quality_rules"], steps["line_dedup"]
    assert {r["doc_id"] for r in after} < {r["doc_id"] for r in before}
    for r in after:
        words = WORD.findall(r["text"])
        assert len(words) >= 10 and 100 * repeated_words(words) <= 20 * len(words)


def test_line_stage_deletes_later_copies(steps):
    before, after = steps["line_dedup"], {r["doc_id"]: r for r in steps["near_dedup"]}
    gone = deleted_lines([(r["doc_id"], r["text"]) for r in before])
    for r in before:
        numbers = gone.get((r["doc_id"], r["text"]), [])
        left = "\n".join(x for at, x in enumerate(r["text"].split("\n")) if at not in numbers)
        if numbers and not WORD.search(left):
            assert r["doc_id"] not in after
        else:
            kept = after[r["doc_id"]]
            assert (kept["text"], kept["n_chars"]) == (left, len(left) if numbers else r["n_chars"])


def test_near_stage_keeps_one_of_each_class(steps):
    before, after = steps["near_dedup"], {r["doc_id"] for r in steps["source_mix"]}
    rows = [(r["doc_id"], r["text"]) for r in sorted(before, key=lambda r: r["doc_id"])]
    root = {doc_id: doc_id for doc_id, _ in rows}
    for k, (i, a) in enumerate(rows):
        for j, b in rows[:k]:
            if a == b or (abs(len(a) - len(b)) < 0.5 * len(a) and jaccard(a, b) >= 0.8):
                low, high = sorted((root[i], root[j]))
                root = {x: low if y == high else y for x, y in root.items()}
    assert after == set(root.values())


def test_mix_stage_repeats_documents_towards_the_targets(spark, steps):
    before, after = steps["source_mix"], steps["best_fit_packing"]
    docs = spark.createDataFrame(before)
    expected = {}
    for r in mixing.mix(docs).collect():
        expected[r["doc_id"]] = math.floor(r["taken"] / max(r["size"], 1) + 0.5)
    found = {}
    for r in after:
        found[r["doc_id"]] = found.get(r["doc_id"], 0) + 1
    assert found == {doc_id: n for doc_id, n in expected.items() if n}


def test_pack_stage_packs_every_copy(steps):
    pieces = steps["packed"]
    copies = {}
    for r in steps["best_fit_packing"]:
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
    first = {}
    for r in pieces:
        if r["piece"] == 0:
            first[r["doc_id"]] = first.get(r["doc_id"], 0) + 1
    assert first == copies
    assert len({(r["sequence_id"], r["offset"]) for r in pieces}) == len(pieces)


def test_run_is_the_stages_one_after_another(spark, steps):
    found = corpus_pipeline.run(spark, SF_DIR)
    assert found.count() == len(steps["packed"])
    assert corpus_pipeline.ORACLE_SQL is None
