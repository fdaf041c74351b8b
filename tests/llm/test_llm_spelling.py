import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from llm_frames import documents
from wayposts.llm import queries, spelling
from wayposts.sources.tables import literal_frame


def _one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(
        long[:i] + long[i + 1 :] == short for i in range(len(long))
    )


def _near(words):
    return {(a, b) for a in words for b in words if _one_edit(a, b)}


def _near_by_letters(words):
    """The same for many words: every word with one letter less, more or another."""
    letters = sorted({c for w in words for c in w})
    found = set()
    for w in words:
        made = {w[:i] + w[i + 1 :] for i in range(len(w))}
        made |= {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in letters}
        made |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        found |= {(w, v) for v in made if v != w and v in words}
    return found


def _counts(rows):
    upper = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(upper)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = h % len(run)
            counts[run if h % 97 else run[:at] + run[at + 1 :]] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def _variants(rows, near=_near):
    counts = _counts(rows)
    by_word = {}
    for a, b in near(counts.keys()):
        by_word.setdefault(a, []).append(b)
    forms = {}
    for word in counts:
        best = min(by_word.get(word, []), key=lambda v: (-counts[v], v), default=None)
        forms[word] = best if best and counts[best] >= 2 * counts[word] else None
    found = []
    for word, form in forms.items():
        root = word
        while forms[root]:
            root = forms[root]
        found.append((word, form, root, counts[word], len(by_word.get(word, [])), form and counts[form]))
    return sorted(found)


def _pairs(spark, words):
    frame = literal_frame(spark, [(w,) for w in sorted(words)], "word string")
    return {tuple(r) for r in spelling.near_words(frame).collect()}


@pytest.mark.parametrize("letters, sizes", [("ab", (5, 9)), ("abcdeé", (5, 7)), ("aé", (28, 36))])
def test_pairs_against_every_pair(spark, letters, sizes):
    chance = random.Random(letters)
    words = set()
    for _ in range(120):
        word = "".join(chance.choices(letters, k=chance.randint(*sizes)))
        at = chance.randrange(len(word))
        words |= {word, word[:at] + word[at + 1 :], word[:at] + chance.choice(letters) + word[at:]}
        words.add(word[:at] + chance.choice(letters) + word[at + 1 :])
    words = {w for w in words if len(w) >= 5}
    assert _pairs(spark, words) == _near(words)


def test_every_place_and_kind_of_edit(spark):
    words = set()
    for size in (5, 6, 11, 31, 32, 33, 34):
        word = ("abcdefgh" * 5)[:size]
        words.add(word)
        for i in range(size + 1):
            words |= {word[:i] + "z" + word[i:], word[:i] + word[i + 1 :], word[:i] + "z" + word[i + 1 :]}
    words = {w for w in words if len(w) >= 5}
    assert _pairs(spark, words) == _near(words)


def test_words_of_any_length(spark):
    base = "".join(random.Random(1).choices("abc", k=20_000))
    words = {base, base[1:], base[:-1], base[:9_999] + "x" + base[10_000:], base + "a", "a" * 3000, "a" * 3001}
    assert _pairs(spark, words) == _near(words)


def test_words_with_one_beginning(spark):
    chance = random.Random(4)
    words = {"common" + "".join(chance.choices("abcd", k=4)) for _ in range(300)}
    assert _pairs(spark, words) == _near(words)


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.text("abÿ", min_size=5, max_size=8), max_size=40))
def test_any_words(spark, words):
    assert _pairs(spark, words) == _near(words)


def _found(frame):
    return sorted(tuple(r) for r in spelling.variants(frame).collect())


def test_documents_of_every_kind(spark):
    chance = random.Random(2)
    base = ["spelling", "SPELLING", "speling", "spellings", "Übermut", "übermut", "naïve", "naive×"]
    rows = [(i, " ".join(chance.choices(base, k=30))) for i in range(40)]
    rows += [(None, "nobody nobody nobodyy"), (100, None), (101, ""), (102, "nobody, 1nobody2 ndoby")]
    rows += [rows[0], rows[0], (103, "long" * 2000), (104, "long" * 2000), (105, "long" * 2000)]
    assert _found(documents(spark, rows)) == _variants(rows)
    assert _found(documents(spark, [])) == _found(documents(spark, [(1, None)])) == []


def test_chains_of_forms(spark):
    counts = {"aaaaa": 3, "aaaab": 7, "aaabb": 15, "aabbb": 40, "abbbb": 40, "zzzzz": 5, "zzzzy": 9}
    rows = [(0, " ".join(w for w, n in counts.items() for _ in range(n)))]
    expected = _variants(rows)
    assert _found(documents(spark, rows)) == expected
    roots = {r[0]: r[2] for r in expected}
    assert roots["aaaaa"] == "aabbb" and roots["zzzzz"] == "zzzzz"


def test_tasks_pass_on_what_they_counted(spark, monkeypatch):
    rows = [(i, "alpha bravo charlie delta " * (i % 4)) for i in range(30)]
    monkeypatch.setattr(spelling, "_KEPT_WORDS", 1)
    monkeypatch.setattr(spelling, "_TEXTS", 2)
    assert _found(documents(spark, rows).repartition(3)) == _variants(rows)


def test_query_over_the_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    result = queries.op12_spelling(spark, sf_dir)
    assert result.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    expected = _variants([tuple(r) for r in table.collect()], _near_by_letters)
    assert sorted(tuple(r) for r in result.collect()) == expected
