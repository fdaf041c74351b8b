"""Byte-pair encoding and decoding with a given tokenizer file.

A word starts as a doubly linked list of its characters. The pairs that the file can merge wait
in a priority queue by rank, then by place; the first is merged, the pairs it makes with its
neighbours join the queue, and an entry whose symbols have changed since is stale and skipped.
Decoding looks up each id's string and joins the strings, with a space between them unless the
file names a byte-level decoder. The normalizer and the cutting into words are those of the
file, run by the library; words and ids never pass through its model.

Defined cases: a null or empty text has no ids and decodes to an empty text; equal rows are
encoded alike and kept apart; an empty table gives an empty result; other columns are not read.
Ids that the file lacks decode to nothing, as in the library.
"""

import json
import os
import re
from collections.abc import Callable
from functools import lru_cache
from heapq import heapify, heappop, heappush
from string import ascii_letters, punctuation
from struct import pack

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql.types import DataType

from wayposts.llm.arrow import WORD, map_batches

# Encoded words, and pieces of words, that the tasks of a Python worker keep, and the longest that
# they keep; beyond this they start afresh.
KEPT_WORDS = 500_000
KEPT_LENGTH = 64
ID_TYPE = "<u4"
# New words that are cut in one go.
_TOGETHER = 1000
# Most new words are letters before marks or none, and known letters need not be cut again. The
# marks leave out those that begin added tokens or endings of their own.
_LETTERS = ascii_letters + "ßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ"
_MARKS = punctuation.translate({ord(mark): None for mark in "'<"})
_PARTS = re.compile(rf"([{_LETTERS}]+)([{re.escape(_MARKS)}]*)")

# An entry of the queue is the rank of a pair above the place of its first symbol.
_PLACE_BITS = 32
_PLACES = (1 << _PLACE_BITS) - 1

_UNSUPPORTED = (
    "dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges",
)


class Vocabulary:
    """What a tokenizer file says about symbols, merges and added tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        model = parts["model"]
        odd = [name for name in _UNSUPPORTED if model.get(name)]
        if model.get("type", "BPE") != "BPE" or odd:
            raise ValueError(f"not a plain byte-pair model: {model.get('type')} {odd}")
        added = parts.get("added_tokens") or []
        if any(t[flag] for t in added for flag in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens must be matched as they are")
        self.ids: dict[str, int] = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = {(self.ids[a], self.ids[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.made = [self.ids[a + b] for a, b in pairs]
        self.added = {t["content"]: t["id"] for t in added}
        self.strings = {i: s for s, i in (self.ids | self.added).items()}
        kind = (parts.get("decoder") or {}).get("type")
        if kind not in (None, "ByteLevel"):
            raise ValueError(f"no decoding by {kind}")
        self.byte_level = kind == "ByteLevel"

    def symbols(self, word: str) -> list[int]:
        """The ids of a word's characters, the last one marked as the end; others are dropped."""
        marked = [*word[:-1], word[-1] + self.end]
        return [self.ids[s] for s in marked if s in self.ids]


def merged(symbols: list[int], ranks: dict[tuple[int, int], int], made: list[int]) -> list[int]:
    """``symbols`` after all merges, the lowest rank first, then the leftmost.

    ``ranks`` has the rank of each pair that merges, ``made`` the symbol it makes, by rank.
    """
    size = len(symbols)
    rank_of, bits, places = ranks.get, _PLACE_BITS, _PLACES
    now = list(symbols)
    before, after = list(range(-1, size - 1)), list(range(1, size + 1))
    # The rank at which each symbol would merge with the one after it now.
    due: list[int | None] = [*map(rank_of, zip(now, now[1:])), None]
    queue = [rank << bits | at for at, rank in enumerate(due) if rank is not None]
    heapify(queue)
    while queue:
        first = heappop(queue)
        rank, at = first >> bits, first & places
        if due[at] != rank:
            continue
        gone = after[at]
        now[at] = symbol = made[rank]
        now[gone], due[gone], due[at] = -1, None, None
        after[at] = right = after[gone]
        left = before[at]
        if right < size:
            before[right] = at
            rank = rank_of((symbol, now[right]))
            if rank is not None:
                due[at] = rank
                heappush(queue, rank << bits | at)
        if left >= 0:
            due[left] = rank = rank_of((now[left], symbol))
            if rank is not None:
                heappush(queue, rank << bits | left)
    return [symbol for symbol in now if symbol >= 0]


class Encoder:
    """Texts to packed little-endian 32-bit ids."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.vocabulary = Vocabulary(path)
        library = Tokenizer.from_file(path)
        self.normalizer, self.cutter = library.normalizer, library.pre_tokenizer
        # Where white space is dropped, it parts words for good, and each is encoded once.
        self.by_word = not self._cut(" ") and len(self._cut("a \t\nb")) == 2
        added = sorted(self.vocabulary.added, key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        # Words that may be cut in one text with others: those without white space or added tokens.
        self.alone = re.compile("|".join([r"\s", *map(re.escape, added)]))
        sample = ["Ab", "é1", "x's", "!?", "ß"]
        self.together = self._cut(" ".join(sample)) == [p for word in sample for p in self._cut(word)]
        # What the file makes of each letter, and whether it makes the same of them in a word.
        self.letters = {ord(c): "".join(self._cut(c)) for c in _LETTERS}
        all_letters = _LETTERS.translate(self.letters)
        self.parted = self._cut(_LETTERS + _MARKS) == [all_letters, _MARKS] and not any(
            _PARTS.match(token) for token in added
        )
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _cut(self, text: str) -> list[str]:
        if self.normalizer is not None:
            text = self.normalizer.normalize_str(text)
        if self.cutter is None:
            return [text] if text else []
        return [word for word, _ in self.cutter.pre_tokenize_str(text)]

    def _piece(self, piece: str) -> bytes:
        known = self.vocabulary
        ids = merged(known.symbols(piece), known.ranks, known.made)
        packed = pack(f"<{len(ids)}I", *ids)
        if len(piece) <= KEPT_LENGTH:
            self.pieces[piece] = packed
        return packed

    def _plain(self, text: str) -> list[bytes]:
        known, learn = self.pieces.get, self._piece
        return [known(piece) or learn(piece) for piece in self._cut(text)] if text else []

    def _word(self, word: str) -> bytes:
        found: list[bytes] = []
        start = 0
        for token in self.added.finditer(word) if self.added else ():
            found += self._plain(word[start : token.start()])
            found.append(pack("<I", self.vocabulary.added[token.group()]))
            start = token.end()
        packed = b"".join(found + self._plain(word[start:]))
        if len(word) <= KEPT_LENGTH:
            self.words[word] = packed
        return packed

    def _part(self, words: set[str]) -> list[str]:
        """Learns the words that are letters before marks or none, and returns them."""
        known, learn, kept, parts = self.pieces.get, self._piece, self.words, _PARTS.fullmatch
        done = []
        for word in words:
            if len(word) > KEPT_LENGTH or not (found := parts(word)):
                continue
            letters, marks = found.groups()
            letters = letters.translate(self.letters)
            packed = known(letters) or learn(letters)
            kept[word] = packed + (known(marks) or learn(marks)) if marks else packed
            done.append(word)
        return done

    def _learn(self, words: list[str]) -> None:
        """Cuts words in one go, and tells their pieces apart by their places; leaves the words out
        where their number changes."""
        whole = self.normalizer.normalize_str(" ".join(words)) if self.normalizer else " ".join(words)
        parts = whole.split(" ")
        if len(parts) != len(words):
            return
        cut = self.cutter.pre_tokenize_str(whole)
        known, learn = self.pieces.get, self._piece
        at = end = 0
        for word, part in zip(words, parts):
            end += len(part) + 1
            found = []
            while at < len(cut) and cut[at][1][0] < end:
                piece = cut[at][0]
                found.append(known(piece) or learn(piece))
                at += 1
            self.words[word] = b"".join(found)

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        listed = [WORD.findall(text or "") if self.by_word else [text or ""] for text in texts]
        if self.by_word and self.together:
            alone = self.alone.search
            fresh = set().union(*listed).difference(self.words)
            if self.parted:
                fresh.difference_update(self._part(fresh))
            plain = [word for word in fresh if len(word) <= KEPT_LENGTH and not alone(word)]
            for at in range(0, len(plain), _TOGETHER):
                self._learn(plain[at : at + _TOGETHER])
        known, learn = self.words.get, self._word
        ids = [b"".join([known(word) or learn(word) for word in words]) for words in listed]
        # between batches only, as the words of a batch were learned for it
        for kept in (self.words, self.pieces):
            if len(kept) > KEPT_WORDS:
                kept.clear()
        return ids


@lru_cache(maxsize=1)
def known_encoder(path: str) -> Encoder:
    """The encoder that the tasks of one Python worker share."""
    return Encoder(path)


def _byte_of() -> dict[str, int]:
    """The byte for which each character of a byte-level vocabulary stands.

    Printable Latin-1 stands for itself, the other bytes in turn for what follows U+00FF.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = sorted(set(range(256)) - set(plain))
    return {chr(b): b for b in plain} | {chr(256 + place): b for place, b in enumerate(rest)}


class Decoder:
    """Packed ids to texts."""

    def __init__(self, path: str):
        vocabulary = Vocabulary(path)
        self.joint, self.byte_level = (" ", False) if not vocabulary.byte_level else ("", True)
        self.bytes_of = _byte_of()
        self.strings = [""] * (max(vocabulary.strings, default=-1) + 1)
        self.there = np.zeros(len(self.strings) + 1, bool)
        for number, string in vocabulary.strings.items():
            self.strings[number] = string
            self.there[number] = True

    def decode(self, packed: bytes | None) -> str:
        ids = np.frombuffer(packed or b"", ID_TYPE)
        known = self.there[np.minimum(ids, len(self.strings))]
        joined = self.joint.join(map(self.strings.__getitem__, ids[known].tolist()))
        if not self.byte_level:
            return joined
        raw = bytearray()
        for character in joined:
            byte = self.bytes_of.get(character)
            raw += character.encode() if byte is None else bytes([byte])
        return raw.decode("utf-8", "replace")


def _path(path: str | None) -> str:
    import public_tokenizers

    return path or public_tokenizers.path("word_bpe_49k.json")


def _kind(df: DataFrame) -> DataType:
    return df.schema["doc_id"].dataType.simpleString()


def encode(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` of every whole text.

    ``ids`` holds unsigned 32-bit numbers, little-endian, one after another.
    ``tokenizer_path`` names the tokenizer's file, which every executor must have.
    """

    def start() -> Callable[[dict], dict]:
        encoder = known_encoder(_path(tokenizer_path))

        def work(batch: dict) -> dict:
            ids = encoder.encode_all(batch["text"])
            return {"doc_id": batch["doc_id"], "n_tokens": [len(i) // 4 for i in ids], "ids": ids}

        return work

    schema = f"doc_id {_kind(docs)}, n_tokens long, ids binary"
    return map_batches(docs.select("doc_id", "text"), start, schema)


def decode(encoded: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` and the ``text`` that the ids stand for."""

    def start() -> Callable[[dict], dict]:
        decoder = Decoder(_path(tokenizer_path))
        return lambda batch: batch | {"text": [decoder.decode(ids) for ids in batch["ids"]]}

    schema = f"doc_id {_kind(encoded)}, n_tokens long, ids binary, text string"
    return map_batches(encoded.select("doc_id", "n_tokens", "ids"), start, schema)
