"""Repeated lines, near-duplicate texts and vectors, and the components they share."""

import random

import numpy as np
import pandas as pd
import pytest

from llm_frames import deleted_lines, documents, jaccard, some_words
from wayposts.llm import embeddings, hnsw, lines, near
from wayposts.llm.components import components
from wayposts.sources.tables import literal_frame


def _check_lines(spark, rows):
    found = lines.without_lines(documents(spark, rows), prefix="g_").collect()
    assert len(found) == len(rows)
    expected = deleted_lines(rows)
    old = {}
    for doc_id, text in rows:
        old.setdefault(doc_id, []).append(text)
    for r in found:
        text = next(t for t in old[r["doc_id"]] if r["g_gone"] is None or True)
        gone = expected.get((r["doc_id"], text), [])
        assert (r["g_gone"] or []) == gone
        left = [line for at, line in enumerate((text or "").split("\n")) if at not in gone]
        assert r["text"] == (text if not gone else "\n".join(left))


def test_repeated_runs_of_lines(spark):
    chance = random.Random(3)
    long = [" ".join(some_words(chance, n)) for n in (60, 30, 25, 10, 50, 49)]
    a, b, c, d, e, f = long
    rows = [
        (1, f"{a}\nunique one\n{b}\n{c}"),
        (2, f"start\n{a}\nend"),
        (3, f"{b}\n\n{c}\nmore"),
        (4, f"{c}\n{b}"),
        (5, f"{e}\n{f}\n{d}"),
        (6, f"{f}\n{d}\n{e}\n{e}"),
        (7, None), (8, ""), (9, "\n\n"), (None, f"{a}\nlast"),
    ]
    _check_lines(spark, rows)


@pytest.mark.parametrize("seed", range(3))
def test_runs_of_few_different_lines(spark, seed):
    chance = random.Random(seed)
    pool = [" ".join(some_words(chance, chance.choice([1, 3, 9, 17, 26, 51]))) for _ in range(7)]
    rows = [
        (i, "\n".join(chance.choice(pool) for _ in range(chance.randrange(14)))) for i in range(25)
    ]
    _check_lines(spark, rows)


def test_texts_are_joined_by_shuffle_at_every_size(spark):
    text = " ".join(some_words(random.Random(1), 80))
    docs = documents(spark, [(1, text), (2, text)])
    plan = lines.without_lines(docs, prefix="g_")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_runs_end_where_a_line_is_missing(spark):
    rows = [("d", i, 20) for i in (0, 1, 2, 4, 5, 6, 6, 7)] + [("e", 3, 60), ("e", 4, 1)]
    found = lines.with_runs(literal_frame(spark, rows, "doc string, i int, wc long"), 50).collect()
    assert sorted((r["doc"], r["i"], r["forward"], r["backward"]) for r in found) == [
        ("d", 0, 3, None), ("d", 1, None, None), ("d", 2, None, 3),
        ("d", 4, 3, None), ("d", 5, 3, None), ("d", 6, None, 3), ("d", 7, None, 3),
        ("e", 3, 1, 1), ("e", 4, None, 2),
    ]


def test_documents_that_were_copies_go(spark):
    text = " ".join(some_words(random.Random(1), 80))
    docs = documents(spark, [(1, text), (2, text), (3, f"{text}\nnew"), (4, ""), (1, text), (5, None)])
    kept = lines.unrepeated_documents(docs)
    assert kept.columns == docs.columns
    found = sorted((r["doc_id"], r["text"], r["n_chars"]) for r in kept.where("text <> ''").collect())
    assert found == [(1, text, len(text)), (1, text, len(text)), (3, "new", 3)]
    assert kept.count() == 5
    assert lines.unrepeated_documents(docs.limit(0)).count() == 0


def _altered(chance, words, changes):
    words = list(words)
    for at in chance.sample(range(len(words)), changes):
        words[at] = "changed" + str(chance.randrange(1000))
    return words


@pytest.fixture(scope="module")
def copied():
    chance = random.Random(12)
    rows = []
    for group in range(12):
        base = some_words(chance, chance.choice([30, 120, 400]))
        for _ in range(chance.choice([1, 2, 6])):
            rows.append(" ".join(_altered(chance, base, chance.choice([0, 1, 2, len(base) // 60]))))
        rows.append(" ".join(_altered(chance, base, len(base) // 3)))
        rows.append(" ".join(base[: len(base) // 2] + some_words(chance, len(base) // 2)))
    rows += ["a b", "a b", "a  b", "c", "", None, " ", rows[0], " ".join(some_words(chance, 20_000))]
    long = rows[-1].split()
    rows.append(" ".join(long[:7000] + ["put", "in"] + long[7000:]))
    return list(enumerate(rows))


def _edits_alike(a, b):
    """Whether the edit similarity of the words is 0.8 or more, by the whole table of distances."""
    a, b = (np.array(text.split(), object) for text in (a, b))
    at = np.arange(len(b) + 1)
    row = at
    for word in a:
        kept = np.minimum(row[1:] + 1, row[:-1] + (b != word))
        # an insertion costs one for each place moved on
        row = np.minimum.accumulate(np.concatenate([[row[0] + 1], kept]) - at) + at
    return 5 * row[-1] <= max(len(a), len(b))


def _classes(rows):
    """Components of all pairs of texts whose shingles and words are both alike to 0.8 or more;
    equal texts too."""
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in rows:
        for j, b in rows[:i]:
            a, b = a or "", b or ""
            if a == b or (a.split() and b.split() and jaccard(a, b) >= 0.8 and _edits_alike(a, b)):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return {i: find(i) for i, _ in rows}


def test_near_classes(spark, copied):
    docs = documents(spark, copied)
    found = {r["doc_id"]: r["class_id"] for r in near.near_classes(docs).collect()}
    assert found == _classes(copied)
    kept = near.one_of_each(docs.union(docs.limit(5)))
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(found.values()))
    assert near.near_classes(docs.limit(0)).count() == 0
    assert near.one_of_each(documents(spark, [(None, "x"), (None, "y"), (None, "x")])).count() == 2


def test_like_shingles_in_another_order_are_another_text(spark):
    parts = [some_words(random.Random(k), 60) for k in range(4)]
    turned = [" ".join(sum((parts[k] for k in order), [])) for order in ((0, 1, 2, 3), (2, 3, 0, 1))]
    assert jaccard(*turned) >= 0.8 and not _edits_alike(*turned)
    rows = [(1, turned[0]), (2, turned[1]), (3, turned[1] + " end")]
    found = {r["doc_id"]: r["class_id"] for r in near.near_classes(documents(spark, rows)).collect()}
    assert found == _classes(rows) == {1: 1, 2: 2, 3: 2}


def test_histograms_never_part_similar_texts():
    chance = random.Random(8)
    hashes, parted = near.WordHashes(), 0
    for n in (1, 3, 5, 6, 20, 200, 3000):
        for _ in range(60):
            a = [chance.choice("abcdef") for _ in range(n)] if chance.random() < 0.3 else some_words(chance, n)
            b = list(a)
            for _ in range(chance.randrange(max(2, n // 12))):
                b[chance.randrange(n)] = "new"
            if chance.random() < 0.3:
                b = b[: max(1, int(n * chance.uniform(0.7, 1)))]
            x, y = hashes.of(a), hashes.of(b)
            hists = np.array([np.frombuffer(near.histogram(w), np.uint8) for w in (x, y)])
            far = near._far(hists, np.array([0]), np.array([1]))
            may = near.may_be_similar(far, len(near.shingles(x)) + len(near.shingles(y)))[0]
            parted += not may
            assert may or near.jaccard(x, y) < near.SIMILARITY
    assert parted > 20


def test_members_unlike_their_leader_find_each_other(spark, monkeypatch):
    chance = random.Random(21)
    base = [some_words(chance, 60) for _ in range(4)]
    rows = list(enumerate(" ".join(b[:-k] + ["x"] * k) for b in base for k in (1, 2, 3)))
    # all in one bucket of the first band, as if a frequent passage held its sketches
    own = near.sketches
    monkeypatch.setattr(near, "sketches", lambda words: np.concatenate([[1, 2], own(words)[2:]]))
    found = {r["doc_id"]: r["class_id"] for r in near.near_classes(documents(spark, rows)).collect()}
    assert found == _classes(rows)


def test_pairs_among_hundreds_of_texts_with_their_passage_are_found(spark):
    chance = random.Random(31)
    passage = some_words(chance, 300)
    rows, pairs = [], []
    for number in range(60):
        words = passage + [f"own{number}x{i}" for i in range(60)]
        # in the passage, so that the pair shares few bands
        other = list(words)
        for at in chance.sample(range(0, 300, 12), 7):
            other[at] = f"new{number}x{at}"
        pairs.append((len(rows), len(rows) + 1))
        rows += [" ".join(words), " ".join(other)]
    for number in range(400):
        own = [f"fill{number}x{i}" for i in range(120)]
        at = chance.randrange(120)
        rows.append(" ".join(own[:at] + passage + own[at:]))
    rows = list(enumerate(rows))
    hashes = near.WordHashes()
    listed = [near.sketches(hashes.of(text.split())).reshape(near.BANDS, -1) for _, text in rows]
    for a, b in pairs:
        assert jaccard(rows[a][1], rows[b][1]) >= 0.8
        assert (listed[a] == listed[b]).all(1).any()
    found = {r["doc_id"]: r["class_id"] for r in near.near_classes(documents(spark, rows)).collect()}
    assert found == {i: i - 1 if i < 120 and i % 2 else i for i, _ in rows}


def test_edit_distance_within_a_band():
    chance = random.Random(17)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    for _ in range(400):
        a = np.array([chance.randrange(3) for _ in range(chance.randrange(12))], np.uint64)
        b = np.array([chance.randrange(3) for _ in range(chance.randrange(12))], np.uint64)
        true = distance(a.tolist(), b.tolist())
        for most in range(6):
            assert near.within_edits(a, b, most) == (true <= most)


def test_order_matters_to_the_sketches():
    words = near.WordHashes().of([f"w{i}" for i in range(300)])
    same = near.sketches(words)
    turned = near.sketches(np.concatenate([words[150:], words[:150]]))
    assert (same == near.sketches(words.copy())).all()
    assert (same == turned).mean() < 0.7


def test_components(spark):
    chance = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 140)] + [(200, 200 + i) for i in range(1, 50)]
    edges += [(chance.randrange(40), chance.randrange(40)) for _ in range(25)] + [(7, 7), (None, 3)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    frame = literal_frame(spark, edges, "a long, b long")
    assert dict(map(tuple, components(frame).collect())) == {
        x: find(x) for x in root if find(x) != x
    }
    assert components(frame.limit(0)).count() == 0


def test_stars_need_no_round(spark, monkeypatch):
    from wayposts.llm import components as module

    written = []
    write = module.materialize
    monkeypatch.setattr(module, "materialize", lambda df, name: written.append(name) or write(df, name))
    edges = [(1, i) for i in range(2, 60)] + [(80, 70), (70, 80), (90, 70)]
    found = components(literal_frame(spark, edges, "a long, b long"))
    assert dict(map(tuple, found.collect())) == {i: 1 for i in range(2, 60)} | {80: 70, 90: 70}
    assert written == ["component-edges", "component-stars"]


def _vectors(spark, rows):
    frame = literal_frame(spark, [(i, v) for i, v in rows], "vec_id long, embedding array<float>")
    return frame.selectExpr("*", "1 as label", "'kept' as digest", "'kept' as node", "2 as n")


def test_linked_vectors(spark):
    draw = np.random.default_rng(2)
    rows = [draw.standard_normal(24) for _ in range(700)]
    for group in range(30):
        centre = draw.standard_normal(24)
        rows += [centre + draw.standard_normal(24) * 0.22 for _ in range(draw.integers(2, 40))]
    rows += [rows[0]] * 60 + [rows[1] * 2.5, -rows[2]]
    rows = [[float(np.float32(x)) for x in row] for row in rows]
    x = np.array(rows)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= 0.9
    np.fill_diagonal(linked, False)
    label = np.arange(len(rows))
    while True:
        new = np.array([min(label[i], *label[linked[i]]) if linked[i].any() else label[i] for i in label * 0 + np.arange(len(rows))])
        if (new == label).all():
            break
        label = new
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0] * 24, [nan] + [1.0] * 23, [inf] + [1.0] * 23, [None] + [1.0] * 23, [1.0, 2.0]]
    table = [*enumerate(rows), *((5000 + i, v) for i, v in enumerate(odd))]
    found = {r["vec_id"]: r for r in embeddings.linked_vectors(_vectors(spark, table)).collect()}
    assert len(found) == len(table)
    for i in range(len(rows)):
        assert (found[i]["n_links"], found[i]["component_id"]) == (linked[i].sum(), label[i])
        assert found[i]["kept"] == (label[i] == i)
    for i in range(len(odd)):
        r = found[5000 + i]
        assert (r["n_links"], r["component_id"], r["kept"]) == (0, 5000 + i, True)


def test_no_vectors(spark):
    assert embeddings.linked_vectors(_vectors(spark, [])).count() == 0
    assert embeddings.linked_vectors(_vectors(spark, [(1, None), (None, [0.0])])).count() == 2


def test_graph_finds_neighbours():
    draw = np.random.default_rng(8)
    x = embeddings.unit(draw.standard_normal((1500, 16)))
    graph = hnsw.build(x)
    queries = embeddings.unit(draw.standard_normal((200, 16)))
    ids, near_ = hnsw.search(graph, queries, 64)
    assert (np.diff(near_, axis=1) <= 0).all()
    assert (ids[:, 0] == (queries @ x.T).argmax(1)).mean() > 0.97
    own, _ = hnsw.search(graph, x, 32)
    assert (own[:, 0] == np.arange(len(x))).mean() > 0.99


def test_beam_is_widened_until_the_audit_passes(monkeypatch):
    draw = np.random.default_rng(1)
    x = embeddings.unit(draw.standard_normal((2000, 48)))
    graph = hnsw.build(x, degree=2, beam=4)
    queries = embeddings.unit(draw.standard_normal((300, 48)))
    monkeypatch.setattr(embeddings, "FIRST_BEAM", 1)
    beam = embeddings.audited_beam(graph, queries, 0.9)
    assert beam > 1
    moved = embeddings.unit(x + draw.standard_normal(x.shape) * 0.04)
    pieces = list(embeddings.find_links(graph, x.astype(float), moved.astype(float), 0.9))
    rows, found = map(np.concatenate, zip(*pieces))
    true = set(zip(*map(np.ndarray.tolist, np.nonzero(moved @ x.T >= 0.9))))
    assert len(true & set(zip(rows.tolist(), found.tolist()))) >= 0.97 * len(true)


def test_a_group_of_copies_does_not_pass_the_audit_for_the_rest(monkeypatch):
    draw = np.random.default_rng(5)
    copies = draw.standard_normal(48) + 0.05 * draw.standard_normal((500, 48))
    rest = draw.standard_normal((1000, 48))
    x = embeddings.unit(np.concatenate([copies, rest]))
    graph = hnsw.build(x, degree=6, beam=12)
    monkeypatch.setattr(embeddings, "FIRST_BEAM", 4)
    moved = embeddings.unit(x + draw.standard_normal(x.shape) * 0.04)
    asked = moved[draw.permutation(len(moved))[:300]]
    beam = embeddings.audited_beam(graph, asked, 0.9)
    rare = moved[500:]
    rows, found, _ = embeddings._beamed(graph, rare, beam, 0.9)
    true = set(zip(*map(np.ndarray.tolist, np.nonzero(rare @ x.T >= 0.9))))
    assert len(true & set(zip(rows.tolist(), found.tolist()))) >= 0.97 * len(true)


def test_links_of_a_large_group_are_never_held_at_once(monkeypatch):
    draw = np.random.default_rng(2)
    x = draw.standard_normal((3000, 32))
    x[:1000] = x[0] + 0.02 * draw.standard_normal((1000, 32))
    x[1000:1100] = x[1100:1200] + 0.05 * draw.standard_normal((100, 32))
    rows = pd.DataFrame({"node": np.arange(3000) * 7 + 3, "n": 1, "vector": list(x), "width": 32, "shard": 0})
    sizes = []
    whole = embeddings.forest

    def measured(a, b):
        sizes.append(len(a))
        return whole(a, b)

    monkeypatch.setattr(embeddings, "forest", measured)
    found = embeddings._asked(embeddings._graph_of_shard(rows), rows[["node", "vector"]])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    degrees = found.groupby("node")["links"].sum().reindex(rows["node"], fill_value=0)
    assert near.sum() > 900_000 and degrees.tolist() == near.sum(1).tolist()
    assert max(sizes) <= 64 * 1000
    edges = found[found["node"] != found["other"]]
    assert (len(edges), edges["other"].nunique()) == (1099, 101)


def test_a_shard_is_kept_as_rows_and_asked_in_waves(spark, monkeypatch):
    draw = np.random.default_rng(6)
    rows = draw.standard_normal((160, 12))
    rows[100:] = rows[:60] + draw.standard_normal((60, 12)) * 0.05
    table = [(i, [float(np.float32(x)) for x in row]) for i, row in enumerate(rows)]
    table += [(1000 + i, v[:5]) for i, v in table[:20]] + [(2000, table[0][1])]
    written = []
    write = embeddings.materialize

    def measured(df, name):
        made = write(df, name)
        sizes = [f"size({c})" for c, kind in made.dtypes if kind.startswith("array")]
        lengths = [f"length({c})" for c, kind in made.dtypes if kind in ("binary", "string")]
        most = made.selectExpr(*[f"max({e})" for e in sizes + lengths]).first() if sizes + lengths else []
        written.append((name, made.count(), max([m for m in most if m is not None], default=0)))
        return made

    monkeypatch.setattr(embeddings, "materialize", measured)
    whole = sorted(map(tuple, embeddings.linked_vectors(_vectors(spark, table)).collect()))
    assert [rows for name, rows, _ in written if name == "vectors-graphs"] == [180]
    assert max(most for *_, most in written) <= 9 * hnsw.DEGREE
    assert sum(links > 0 for _, links, *_ in whole) >= 120
    written.clear()
    monkeypatch.setattr(embeddings, "WAVE_ROWS", 180)
    monkeypatch.setattr(embeddings, "PART_ROWS", 50)
    assert sorted(map(tuple, embeddings.linked_vectors(_vectors(spark, table)).collect())) == whole
    assert [name for name, *_ in written].count("vectors-links") == embeddings.LEAST_SHARDS


def test_graph_as_lists():
    x = embeddings.unit(np.random.default_rng(3).standard_normal((900, 8)))
    graph = hnsw.build(x)
    starts, values = hnsw.as_lists(graph)
    again = hnsw.from_lists(x, np.diff(starts), values)
    assert len(graph.layers) > 1 and again.entry == graph.entry
    assert all(map(np.array_equal, again.layers, graph.layers))


def test_pairs_are_held_a_few_at_a_time(monkeypatch):
    draw = np.random.default_rng(4)
    x = draw.standard_normal((1200, 16))
    x[:400] = x[0] + 0.02 * draw.standard_normal((400, 16))
    graph = hnsw.build(embeddings.unit(x))
    pairs = lambda pieces: set(zip(*map(np.ndarray.tolist, map(np.concatenate, zip(*pieces)))))
    whole = pairs(embeddings.find_links(graph, x, x, 0.9))
    beam = embeddings.audited_beam(graph, embeddings.unit(x), 0.9)
    monkeypatch.setattr(embeddings, "PAIRS_AT_ONCE", 1000)
    pieces = list(embeddings.find_links(graph, x, x, 0.9))
    assert max(len(rows) for rows, _ in pieces) <= 1000
    assert len(whole) > 160_000 and pairs(pieces) == whole
    held = []
    whole_pairs = embeddings._all
    monkeypatch.setattr(embeddings, "_all", lambda p: held.append(whole_pairs(p)) or held[-1])
    assert embeddings.audited_beam(graph, embeddings.unit(x), 0.9) == beam
    assert max(len(rows) for rows, _ in held) <= 1000


def test_a_text_in_many_pairs_is_read_once(monkeypatch):
    chance = random.Random(11)
    base = some_words(chance, 60)
    texts = [" ".join(base[: 60 - i] + some_words(chance, i % 9)) for i in range(14)] + ["", "a", "a a a a a a a"]
    hashes = near.WordHashes()
    words = [hashes.of(near.WORD.findall(text)) for text in texts]
    read = []
    labelled = near.labelled
    monkeypatch.setattr(near, "labelled", lambda w: read.append(len(w)) or labelled(w))
    for most, reads in ((10_000, len(texts)), (100, None)):
        monkeypatch.setattr(near, "KEPT_WORDS", most)
        read.clear()
        compared = near.Compared()
        found = [
            compared.similar(bytes([i]), one, bytes([j]), other)
            for i, one in enumerate(texts)
            for j, other in enumerate(texts)
        ]
        assert reads in (None, len(read))
        # few are held at once, and read again when asked for again
        assert sum(len(w) for w, _ in compared.values()) <= most + 2 * 60
        assert found == [jaccard(a, b) >= 0.8 and near.few_edits(x, y) for a, x in zip(texts, words) for b, y in zip(texts, words)]
    assert any(found) and not all(found)
