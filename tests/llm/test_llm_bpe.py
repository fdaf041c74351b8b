import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_frames import documents
from wayposts.llm import bpe, queries

FILES = ("word_bpe_49k.json", "byte_bpe_50k.json")
ODD = [
    "", " ", "\u0085", "a\x1cb", "ΣΑΣ İx ǅ", "é ́e", "Ａ　b", "<|endoftext|>",
    "x<|startoftext|><|endoftext|>y <|ENDOFTEXT|>", "it's IT'S 'tis 12½", "\x00�\U0001f600",
    "é" * 300, "ab" * 3000, "!" * 4000, "a\r\nb\vc\fd",
]


@pytest.fixture(scope="module", params=FILES)
def both(request):
    path = public_tokenizers.path(request.param)
    return bpe.Encoder(path), bpe.Decoder(path), Tokenizer.from_file(path)


def _same(both, text):
    encoder, decoder, library = both
    packed = encoder.encode(text)
    ids = np.frombuffer(packed, "<u4").tolist()
    assert ids == library.encode(text, add_special_tokens=False).ids
    assert decoder.decode(packed) == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", ODD)
def test_odd_texts_as_in_the_library(both, text):
    _same(both, text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abcdeéßÀİ'’1½ \t\n.,!<|>́ẞ中😀"), max_size=40))
def test_any_text_as_in_the_library(both, text):
    _same(both, text)


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=30))
def test_any_characters_as_in_the_library(both, text):
    _same(both, text)


def test_letters_before_marks_are_not_cut_again():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, library = bpe.Encoder(path), Tokenizer.from_file(path)
    encoder._learn = None
    text = "Straße straße, ÄRGER!? ärger... naïve) x#$ thé"
    ids = np.frombuffer(encoder.encode(text), "<u4").tolist()
    assert ids == library.encode(text, add_special_tokens=False).ids
    assert len([p for p in encoder.pieces if p.startswith("stra")]) == 1


def test_tasks_of_a_worker_share_an_encoder():
    path = public_tokenizers.path("word_bpe_49k.json")
    assert bpe.known_encoder(path) is bpe.known_encoder(path)


def _merged_plainly(symbols, merges):
    """The lowest-ranked, leftmost pair again and again, by looking at all of them."""
    symbols = list(symbols)
    while True:
        found = [
            (*merges[pair], at) for at, pair in enumerate(zip(symbols, symbols[1:])) if pair in merges
        ]
        if not found:
            return symbols
        _, made, at = min(found, key=lambda f: (f[0], f[2]))
        symbols[at : at + 2] = [made]


def test_merges_against_a_plain_scan():
    chance = random.Random(5)
    for _ in range(300):
        merges, made = {}, 4
        for rank in range(chance.randrange(12)):
            merges[chance.randrange(made), chance.randrange(made)] = (rank, made)
            made += 1
        symbols = [chance.randrange(4) for _ in range(chance.randrange(30))]
        by_rank = {rank: pair for pair, (rank, _) in merges.items()}
        ranks = {pair: rank for pair, (rank, _) in merges.items()}
        made_by = [merges[by_rank[r]][1] if r in by_rank else -2 for r in range(12)]
        assert bpe.merged(symbols, ranks, made_by) == _merged_plainly(symbols, merges)


def test_ids_that_the_file_lacks(both):
    _, decoder, library = both
    ids = [3, 4_000_000_000, 5, 70_000]
    packed = np.array(ids, "<u4").tobytes()
    assert decoder.decode(packed) == library.decode(ids, skip_special_tokens=False)


def test_caches_start_afresh(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 3)
    encoder = bpe.Encoder(public_tokenizers.path(FILES[0]))
    text = "one two three four, five six one two"
    first = encoder.encode(text)
    assert encoder.encode(text) == first and len(encoder.words) <= 3 and len(encoder.pieces) <= 3


def _expected(rows):
    library = Tokenizer.from_file(public_tokenizers.path(FILES[0]))
    found = []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        digests = (np.array(ids, "<u4").tobytes(), decoded.encode())
        found.append((doc_id, len(ids), *[hashlib.sha256(d).hexdigest() for d in digests]))
    return sorted(found, key=str)


def test_documents_of_every_kind(spark):
    rows = [*enumerate(ODD), (100, None), (None, "no id"), (7, "twice"), (7, "twice")]
    rows.append((101, "long words and \N{GREEK SMALL LETTER ALPHA} " * 20_000))
    frame = documents(spark, rows)
    decoded = bpe.decode(bpe.encode(frame))
    assert decoded.columns == ["doc_id", "n_tokens", "ids", "text"]
    found = [
        (r.doc_id, r.n_tokens, hashlib.sha256(r.ids).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest())
        for r in decoded.collect()
    ]
    assert sorted(found, key=str) == _expected(rows)
    assert bpe.decode(bpe.encode(documents(spark, []))).count() == 0


def test_query_over_the_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    result = queries.op13_bpe(spark, sf_dir)
    assert result.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, result.collect()), key=str) == _expected(map(tuple, rows))
