"""Quality rules, secret scans, token counts and toxicity."""

import hashlib
import itertools
import random
import re
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_frames import WORD, documents, repeated_words, some_words
from wayposts.llm import quality, secrets, tokens, toxicity
from wayposts.sources.tables import literal_frame


@pytest.fixture(scope="module")
def texts():
    chance = random.Random(2)
    found = [None, "", " \t\n", "one", "a b c d e a b c d e", "x\n\nx\n x\nx", "\x0b\x0c", "é" * 50,
             "a b c d e f " * 200, "# * $ % & | < > !!", "😀 😀 😀 😀 😀 😀"]
    for _ in range(60):
        words = some_words(chance, chance.randrange(60), "ab#")
        found.append("".join(w + chance.choice([" ", "\n", "\n\n", "\t"]) for w in words))
    found.append(" ".join(some_words(chance, 20_000)))
    return found


def test_statistics(spark, texts):
    docs = documents(spark, list(enumerate(texts)) + [(0, texts[0]), (None, "a b")])
    rows = quality.with_statistics(docs, "q_").select("doc_id", "q_stats.*").collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        text = (texts[r["doc_id"]] if r["doc_id"] is not None else "a b") or ""
        words = WORD.findall(text)
        lines = [line for line in text.split("\n") if WORD.search(line)]
        assert tuple(r[c] for c in quality.COUNTS) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), repeated_words(words),
        )


def test_rules_are_learned_and_applied(spark):
    chance = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        words = some_words(chance, 40)
        if bad := i % 5 == 0:
            words = [w + "%%" for w in words] if i % 2 else [w.upper() + "!!" for w in words]
        rows.append((i, " ".join(words)))
        if i < 500:
            labels.append((i, 0 if bad else 1))
    labels += [(None, 1), (7, None), (9999, 0)]
    docs = documents(spark, rows + [(1000, None), (1001, "short text")])
    frame = literal_frame(spark, labels, "doc_id long, quality int")
    kept = quality.good_documents(docs, frame)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert {i for i in range(600) if i % 5} <= ids and sum(i % 5 == 0 for i in ids) <= 12
    unlabelled = quality.judged(docs, frame.limit(0))
    assert unlabelled.where("rule is null").count() == 600
    assert quality.good_documents(docs.limit(0), frame).count() == 0


def test_rules_are_dropped_when_they_do_not_hold_elsewhere():
    draw = np.random.default_rng(1)
    assert quality.learn_rules(draw.random((900, 3)), draw.random(900) < 0.3, ("a", "b", "c")) == []
    x = draw.random((900, 3))
    rules = quality.learn_rules(x, (x[:, 0] > 0.8) & (x[:, 2] < 0.5), ("a", "b", "c"))
    assert rules and {c.feature for rule in rules for c in rule} == {"a", "c"}


SECRETS = [
    ("password=abc", []),
    ("password=abcdef", [("assign", 0, 15)]),
    ("é PassWord : 'Abc123=' x", [("assign", 2, 21)]),
    ("api_key\"=\"aaaaaa apikey=bbbbbb", [("assign", 0, 16), ("assign", 17, 30)]),
    ("\u017fecret=abcdefg to\u212aen=abcdefg", []),
    ("AKIA" + "B" * 15 + " AKIA" + "B" * 16, [("access", 20, 40)]),
    ("f" * 23 + "g" + "0" * 24, [("hex", 24, 48)]),
    ("token=" + "ab" * 12, [("assign", 0, 30), ("hex", 6, 30)]),
    ("Zq8vT3xLp0Wn5RkY is here", [("token", 0, 16)]),
    ("4532015112830366 some_identifier_name internationalization", []),
    ("d41d8cd98f00b204e9800998ecf8427e".upper(), []),
    ("123e4567-e89b-42d3-a456-426614174000", []),
]


def test_secrets(spark):
    rows = [(i, text) for i, (text, _) in enumerate(SECRETS)] + [(50, None), (51, ""), (None, "AKIA")]
    found = {r["doc_id"]: r for r in secrets.scan(documents(spark, rows)).collect()}
    assert len(found) == len(rows)
    for i, (_, spans) in enumerate(SECRETS):
        assert found[i]["spans"] == secrets.joined(spans)
        base = [s for s in spans if s[0] in secrets.BASE_KINDS]
        assert found[i]["base_sha256"] == hashlib.sha256(secrets.joined(base).encode()).hexdigest()
        for kind in secrets.KINDS:
            assert found[i][f"n_{kind}"] == sum(s[0] == kind for s in spans)
    assert found[50]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert secrets.scan(documents(spark, [])).count() == 0


def test_words_are_no_secrets(texts):
    import public_tokenizers

    count = secrets.token_counter(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    plain = "thandnheerti ciónmenteosmente verberlichkeit Getzbe theand " * 50
    assert secrets.token_spans(plain, count, []) == []


@pytest.mark.parametrize("secret", ["Xk9fQ2mZ8rTb4LpW", "7Qz/12/Vw8Kp-3xYtN0bRfJ", "pT4vNq81Zs6LgX2dWb9RmC5y"])
def test_names_joined_to_a_secret_do_not_hide_it(secret):
    import public_tokenizers

    count = secrets.token_counter(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    for name in ("deploy/production/service-account/private-key=", "internal_service_account_key_",
                 "international-organization-for-documentation-", "production/production/production/"):
        for tail in ("", "/production/documentation", "_international_organization_key"):
            text = f"see {name}{secret}{tail} here"
            at = 4 + len(name)
            for taken in ([], [("hex", text.index(" here") - 1, len(text))] if tail else []):
                [(_, start, end)] = secrets.token_spans(text, count, taken)
                assert min(end, at + len(secret)) - max(start, at) >= secrets.LEAST_CANDIDATE
    for plain in ("users/123e4567-e89b-42d3-a456-426614174000/documentation-v2",
                  "documentation/gp/product/B00X4WHP5E/ref=sr_1_3", "archive/2024-01-15/documentation-utf8-mp3",
                  "blobs/sha1/" + "DA39A3EE5E6B4B0D3255BFEF95601890AFD80709" + "/documentation"):
        assert secrets.token_spans(plain, count, []) == []


def test_long_slugs_are_told_in_one_pass():
    pattern = secrets.IDENTIFIER.pattern
    for slug in ("how-to-build-large-language-model-training-data-2024-01-15", "a" * 45 + "12345",
                 "x" * 50 + "=", "someLongCamelCaseName" * 4 + "-2024-01-15"):
        code = f"import re; print(re.fullmatch({pattern!r}, {slug!r}))"
        told = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=20)
        assert told.stdout == "None\n"
    parts = re.compile(r"[A-Z]?[a-z]+([_/-]?[A-Z]?[a-z]+)*[_-]?[0-9]{0,4}|[A-Z]+([_/-][A-Z]+)*|[0-9+/_=-]+")
    for n in range(1, 7):
        for word in map("".join, itertools.product("aB_-2", repeat=n)):
            assert bool(secrets.IDENTIFIER.fullmatch(word)) == bool(parts.fullmatch(word)), word


@pytest.fixture(scope="module")
def vocabulary():
    import public_tokenizers

    return tokens.zipf_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))


def _library_counts(vocabulary, words):
    from tokenizers import Tokenizer, models

    unigram = Tokenizer(models.Unigram([("<unk>", 0.0), *vocabulary], unk_id=0))
    return [len(unigram.encode(tokens.MARK + w).ids) for w in words]


def test_token_counts_equal_the_library(spark, vocabulary, texts):
    chance = random.Random(8)
    letters = "abcdeéñ中文한😀́#1"
    words = ["".join(chance.choices(letters, k=chance.randint(1, 12))) for _ in range(3000)]
    words += ["international", "the", "x" * 400, "日本語テキスト", "​", "😀😀😀"]
    count = tokens.piece_counter(vocabulary)
    assert [count(tokens.MARK + w) for w in words] == _library_counts(vocabulary, words)
    docs = documents(spark, list(enumerate(texts)) + [(0, texts[0]), (None, "the end")])
    found = tokens.token_counts(docs).collect()
    assert len(found) == len(texts) + 2
    for r in found:
        listed = WORD.findall((texts[r["doc_id"]] if r["doc_id"] is not None else "the end") or "")
        assert r["n_words"] == len(listed)
        assert r["n_tokens"] == sum(_library_counts(vocabulary, listed))


def test_ties_go_to_the_earliest_start():
    vocabulary = [("a", -1.0), ("b", -1.0), ("ab", -2.0), ("c", -1.0), ("bc", -2.0), ("▁", -1.0)]
    words = ["abc", "ab", "abab", "bcbc", "abcabc", "azzb", "zz"]
    count = tokens.piece_counter(vocabulary)
    assert [count(tokens.MARK + w) for w in words] == _library_counts(vocabulary, words)


def test_marginals_equal_enumeration():
    draw = np.random.default_rng(6)
    field = toxicity.Field(draw.standard_normal(4), draw.standard_normal((2, 2)), 0.3)
    for words in ([2], [1, 0, 3], [0, 0, 2, 2, 1]):
        total, on = 0.0, np.zeros(len(words))
        for code in range(2 ** len(words)):
            y = [(code >> k) & 1 for k in range(len(words))]
            weight = field.first * y[0] + sum(field.emit[w] for w, s in zip(words, y) if s)
            weight += sum(field.step[a, b] for a, b in zip(y, y[1:]))
            total += np.exp(weight)
            on += np.exp(weight) * np.array(y)
        together = toxicity.marginals([words, [], [0] * 9], field)
        assert np.allclose(together[0], on / total) and len(together[1]) == 0


def test_toxicity_is_learned_from_labels(spark):
    chance = random.Random(9)
    rows, labels = [], []
    for i in range(400):
        words = some_words(chance, 60, "bcdfghjk")
        if toxic := i % 4 == 0:
            for at in chance.sample(range(60), 6):
                words[at] = chance.choice(["Vile,", "vileness", "rotten", "rottenly."])
        rows.append((i, " ".join(words)))
        if i < 300:
            labels.append((i, int(toxic)))
    rows += [(500, None), (501, ""), (None, "vile rotten vile"), (3, rows[3][1])]
    docs = documents(spark, rows)
    model = toxicity.fit(docs, literal_frame(spark, labels, "doc_id long, toxic int"))
    found = toxicity.score(docs, model).collect()
    assert len(found) == len(rows)
    texts = dict(rows)
    for r in found:
        assert 0 <= r["score"] <= 1
        if r["doc_id"] is not None and 300 <= r["doc_id"] < 400:
            assert (r["score"] >= 0.7) == (r["doc_id"] % 4 == 0)
        for span in filter(None, r["spans"].split(",")):
            start, end = map(int, span.split(":"))
            assert re.match("(?i)vile|rotten", texts[r["doc_id"]][start:end])
    assert toxicity.fit(docs, literal_frame(spark, [(1, 0)], "doc_id long, toxic int")) is None
    assert toxicity.score(docs, None).agg(F.max("score")).first()[0] == 0
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_cues_far_into_a_text_are_learned(spark):
    chance = random.Random(4)
    rows, labels = [], []
    for i in range(80):
        words = some_words(chance, 1400, "bcdfghjk")
        if i % 2:
            for at in chance.sample(range(1100, 1400), 8):
                words[at] = "vileness"
        rows.append((i, " ".join(words)))
        labels.append((i, i % 2))
    model = toxicity.fit(documents(spark, rows), literal_frame(spark, labels, "doc_id long, toxic int"))
    number = toxicity.Observer(model.cues)(["vileness"])[0]
    assert number and model.field.emit[number] > 1
    plain, late = some_words(chance, 1400, "bcdfghjk"), some_words(chance, 1400, "bcdfghjk")
    late[1390] = late[1300] = late[1200] = late[1250] = "vileness"
    asked = documents(spark, [(1, " ".join(plain)), (2, " ".join(late))])
    low, high = [r["score"] for r in toxicity.score(asked, model).orderBy("doc_id").collect()]
    assert low < 0.5 < high


def test_windows_cover_whole_texts_and_every_cue(spark):
    cues = [(f"=cue{k}", 3.0) for k in range(20)]
    rows = []
    for i in range(20):
        words = ["plain"] * 3000
        words[2900] = f"cue{i}"
        rows.append((i, " ".join(words), 1))
    docs = literal_frame(spark, rows, "doc_id long, text string, toxic int")
    found = toxicity.field_windows(docs, cues, most=10)
    assert {n for seen, _ in found for n in seen if n} == set(range(1, 21))
    assert len(found) <= 30 and all(len(seen) <= toxicity.WINDOW_WORDS for seen, _ in found)
    everything = toxicity.field_windows(docs, cues, most=10_000)
    assert sum(len(seen) for seen, _ in everything) <= 20 * 3000
    assert {toxic for _, toxic in everything} == {1}


def _plain_token_spans(text, count, taken):
    """The token test with every span asked about every piece."""
    spans = []
    for m in secrets.CANDIDATE.finditer(text):
        if secrets.is_known(m[0]):
            continue
        over = [t for t in taken if m.start() < t[2] and t[1] < m.end()]
        if not over and len(m[0]) <= secrets.MOST_CHARS_A_TOKEN * count(m[0]):
            spans.append(("token", *m.span()))
            continue
        closed = [t[1:] for t in over]
        closed += [u.span() for u in secrets.UUID_PART.finditer(text, *m.span())]
        groups = [[]]
        for p in secrets.PIECE.finditer(text, *m.span()):
            readable = secrets.IDENTIFIER.fullmatch(p[0])
            if any(p.start() < e and s < p.end() for s, e in closed) or (
                not readable and secrets.is_known(p[0])
            ):
                groups.append([])
            else:
                score = 0.0 if readable else secrets.MOST_CHARS_A_TOKEN * count(p[0])
                groups[-1].append((*p.span(), score - len(p[0])))
        found = []
        while groups:
            group = groups.pop()
            if worst := secrets._worst_range(group):
                found.append((group[worst[0]][0], group[worst[1]][1]))
                groups += [group[: worst[0]], group[worst[1] + 1 :]]
        spans += [("token", *part) for part in sorted(found)]
    return spans


def test_token_spans_beside_base_spans():
    import public_tokenizers

    count = secrets.token_counter(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    chance = random.Random(12)
    for _ in range(300):
        parts = []
        for _ in range(chance.randrange(1, 25)):
            random_text = "".join(chance.choices("abcXYZ0189qQ", k=chance.randrange(4, 40)))
            hexes = "".join(chance.choices("0123456789abcdef", k=chance.randrange(20, 45)))
            parts.append(chance.choice([
                random_text, hexes, "production", "token=" + random_text, "AKIA" + random_text.upper(),
                "123e4567-e89b-42d3-a456-426614174000",
            ]) + chance.choice([" ", "_", "-", "/", "="]))
        text = "".join(parts)
        base = secrets.base_spans(text)
        assert secrets.token_spans(text, count, base) == _plain_token_spans(text, count, base)


def test_many_base_spans_in_one_text_take_linear_time():
    import time

    digest = hashlib.sha1(b"x").hexdigest()
    lines = "\n".join(f"{digest}_pkg-release-linux-{n}" for n in range(50_000))
    base = secrets.base_spans(lines)
    assert len(base) == 50_000
    started = time.process_time()
    secrets.token_spans(lines, len, base)
    assert time.process_time() - started < 15
