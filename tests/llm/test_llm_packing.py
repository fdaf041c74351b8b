import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from llm_frames import documents, some_words
from wayposts.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def _packed(rows, capacity):
    """The lengths of the sequences; checks that pieces fill them without gap or overlap."""
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return sequences


def test_documents_are_packed_whole(spark, tokenizer):
    chance = random.Random(6)
    odd = [
        None, "", " ", "a b  c　d", "é ́x", "<|endoftext|> a <|startoftext|>b",
        "don't can 't WON'T", "a\x1cb\x85c", "İstanbul ΣΑΣ ΟΔΟΣ", "ﬁ ① 한국 어 😀", "a\x0bb\x0cc\r\nd",
    ]
    texts = odd + [" ".join(some_words(chance, chance.randrange(300))) for _ in range(80)]
    texts.append(" ".join(some_words(chance, 9000)))
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, "no id")]
    found = packing.pack(documents(spark, rows)).collect()
    _packed(found, 4096)
    texts_of = defaultdict(list)
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        texts_of[doc_id].append(np.array(ids, "<u4"))
    pieces = Counter()
    for r in found:
        ids = texts_of[r["doc_id"]][0]
        part = ids[r["start"] : r["start"] + r["length"]]
        assert r["start"] == 4096 * r["piece"] and len(part) == r["length"]
        assert r["ids_crc32"] == zlib.crc32(part.tobytes())
        pieces[r["doc_id"]] += 1
    for doc_id, several in texts_of.items():
        assert pieces[doc_id] == sum(-(-len(ids) // 4096) for ids in several)
    assert packing.pack(documents(spark, [])).count() == 0


def test_equal_rows_are_packed_apart(spark):
    rows = [(1, "same text here")] * 40 + [(2, None)]
    found = packing.pack(documents(spark, rows), capacity=16).collect()
    assert len(found) == 41
    _packed(found, 16)


@pytest.mark.parametrize("seed", range(30))
def test_patterns_hold_all_pieces(seed):
    chance = random.Random(seed)
    capacity = chance.choice([10, 64, 500])
    lengths = Counter(chance.randint(1, capacity) for _ in range(chance.randrange(400)))
    for length in list(lengths):
        if chance.random() < 0.1:
            lengths[length] += 1000
    patterns = packing.solve(dict(lengths), capacity)
    held = Counter()
    for times, pattern in patterns:
        assert times > 0 and sum(length * n for length, n in pattern) <= capacity
        for length, n in pattern:
            held[length] += times * n
    assert held == Counter({k: v for k, v in lengths.items() if v})
    pieces = [length for length in lengths for _ in range(lengths[length])]
    assert sum(times for times, _ in patterns) <= _first_fit_decreasing(pieces, capacity) * 1.02 + 1


def _first_fit_decreasing(pieces, capacity):
    rooms = []
    for piece in sorted(pieces, reverse=True):
        at = next((k for k, room in enumerate(rooms) if room >= piece), None)
        if at is None:
            rooms.append(capacity - piece)
        else:
            rooms[at] -= piece
    return len(rooms)


def _fewest(items, capacity):
    """The fewest sequences, by trying everything."""
    items = sorted(items, reverse=True)
    best = [len(items)]

    def place(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(items):
            best[0] = len(rooms)
            return
        for room in {r for r in rooms if r >= items[k]}:
            rest = list(rooms)
            rest[rest.index(room)] -= items[k]
            place(k + 1, rest)
        place(k + 1, [*rooms, capacity - items[k]])

    place(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(40))
def test_reduction_loses_no_optimum(seed):
    chance = random.Random(seed)
    items = [chance.randint(1, 20) for _ in range(9)]
    counts = np.bincount(items, minlength=21)
    fixed = packing.reduce_by_dominance(counts, 20)
    rest = [length for length in range(21) for _ in range(counts[length])]
    used = sum(times for times, _ in fixed)
    assert used + (_fewest(rest, 20) if rest else 0) == _fewest(items, 20)


def test_words_with_marks_are_put_together_from_parts():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    letters = ["ab", "Été", "naïve", "ñ", "x×y", "don't", "a1", "ªº", "ŒÆ"]
    marks = ["", ".", ",!!", "&&&%%%", "'s!", "!'ve", "<|endoftext|>", "|", "`~{}[]^\\", "≠", "̸"]
    words = [a + m + b for a in letters for m in marks for b in ("", "ß")]
    words = {word for text in words for word in packing.byte_words(text)}
    known = packing.WordIds(path)
    asked = []
    plainly, known._encode = known._encode, lambda texts: asked.extend(texts) or plainly(texts)
    known.learn(words)
    for word in words:
        ids = library.encode(word.decode(), add_special_tokens=False).ids
        assert known[word] == np.array(ids, "<u4").tobytes(), word
    # letters are never encoded with the marks after them
    assert "ab&&&%%%" not in asked and "&&&%%%" in asked
    assert packing.known_words(path) is packing.known_words(path)
