"""Token counts: the number of pieces of the best segmentation, without the pieces.

A unigram vocabulary scores each piece; a text's segmentation is that of each word, marked at
its start, with the highest total score. An Aho-Corasick automaton lists the pieces that end
at each character, and dynamic programming carries the best score and its number of pieces.
Ties go to the segmentation whose last piece starts first, as the scores are compared from the
earliest start on and only a higher one replaces another. A character that is no piece itself
may be an unknown piece at the lowest score less ten; neighbouring unknown pieces count as one.

The pieces come from a vocabulary file; their scores follow Zipf's law by their place in it.

Defined cases: a null or empty text has no tokens; equal rows get equal counts; other columns
are not read.
"""

import math
from collections.abc import Callable

from pyspark.sql import DataFrame

from wayposts.llm.arrow import WORD, map_batches

MARK = "▁"
UNKNOWN_PENALTY = 10.0
# Words whose counts a task keeps; beyond this it starts afresh.
KEPT_WORDS = 500_000


def zipf_vocabulary(model_path: str) -> list[tuple[str, float]]:
    """The ordinary pieces of a sentencepiece file, in file order, with scores by rank."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    pieces = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i))
    ]
    return [(piece, -math.log(rank + 2.7)) for rank, piece in enumerate(pieces)]


def piece_counter(vocabulary: list[tuple[str, float]]) -> Callable[[str], int]:
    """A function from a marked word to the number of pieces of its best segmentation."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for piece, score in vocabulary:
        automaton.add_word(piece, (len(piece), score))
    automaton.make_automaton()
    single = {piece for piece, _ in vocabulary if len(piece) == 1}
    unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY

    def count(word: str) -> int:
        size = len(word)
        best = [-math.inf] * (size + 1)
        pieces = [0] * (size + 1)
        ends_unknown = [False] * (size + 1)
        best[0] = 0.0
        matches = iter(automaton.iter(word))
        match = next(matches, None)
        for end in range(1, size + 1):
            while match is not None and match[0] == end - 1:
                length, score = match[1]
                start = end - length
                total = best[start] + score
                if total > best[end]:
                    best[end], pieces[end] = total, pieces[start] + 1
                match = next(matches, None)
            if word[end - 1] not in single:
                total = best[end - 1] + unknown
                if total > best[end]:
                    best[end] = total
                    pieces[end] = pieces[end - 1] + (not ends_unknown[end - 1])
                    ends_unknown[end] = True
        return pieces[size]

    return count


def token_counts(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """``doc_id``, ``n_words`` and ``n_tokens`` of every whole text.

    ``model_path`` names the vocabulary, by default that of the installed package of public
    tokenizers; it must be there on every executor.
    """

    def start() -> Callable[[dict], dict]:
        import public_tokenizers

        count = piece_counter(
            zipf_vocabulary(model_path or public_tokenizers.path("piece_bpe_32k.model"))
        )
        known: dict[str, int] = {}

        def counted(word: str) -> int:
            if len(known) >= KEPT_WORDS:
                known.clear()
            known[word] = n = count(MARK + word)
            return n

        def work(batch: dict) -> dict:
            n_words, n_tokens = [], []
            for text in batch["text"]:
                words = WORD.findall(text or "")
                total = 0
                for word in words:
                    n = known.get(word)
                    total += counted(word) if n is None else n
                n_words.append(len(words))
                n_tokens.append(total)
            return {"doc_id": batch["doc_id"], "n_words": n_words, "n_tokens": n_tokens}

        return work

    return map_batches(
        docs.select("doc_id", "text"),
        start,
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, n_tokens long",
    )
