"""Secret scans: base patterns, and random strings found by their low token efficiency.

A string that a byte-pair vocabulary needs many tokens for, relative to its length, holds no
words: few characters per token point to random text. Digests of known lengths, numbers and
word-like identifiers are left out before the test. Where a whole run of characters passes as
readable, its pieces between separators are tested too, so a name or path joined to a random
string does not hide it.

Defined cases: a null text is an empty one and has no spans; rows are scanned one by one, so
equal rows get equal results; other columns are not read. Offsets count code points.
"""

import base64
import hashlib
import re
from collections.abc import Callable

from pyspark.sql import DataFrame

from wayposts.llm.arrow import map_batches

KINDS = ("assign", "access", "hex", "token")
BASE_KINDS = KINDS[:3]

MOST_CHARS_A_TOKEN = 1.9
LEAST_CANDIDATE = 16
# Hexadecimal lengths of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512.
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)

_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(_either_case, ("password", "passwd", "secret", "token"))) + "|" + (
    _either_case("api") + "_?" + _either_case("key")
)
ASSIGN = re.compile(rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
CANDIDATE = re.compile(rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{LEAST_CANDIDATE},}}")
PIECE = re.compile(r"[A-Za-z0-9]+")
UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
UUID_PART = re.compile(rf"(?<![A-Za-z0-9]){UUID.pattern}(?![A-Za-z0-9])")
# Runs of letters are taken whole (++, *+), so a word that does not fit fails in one pass.
IDENTIFIER = re.compile(
    r"[A-Z]?[a-z]++([_/-][A-Z]?[a-z]++|[A-Z][a-z]++)*+[_-]?[0-9]{0,4}|[A-Z]+([_/-][A-Z]+)*|[0-9+/_=-]+"
)

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """The spans of the three base patterns, each kind leftmost and non-overlapping."""
    spans = []
    lower = text.lower()
    if any(word in lower for word in _KEYWORDS):
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    return in_order(spans)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def is_known(found: str) -> bool:
    """Whether a string is a digest or an identifier, which the token test leaves out."""
    digest = len(found) in DIGEST_LENGTHS and re.fullmatch("[0-9a-f]+|[0-9A-F]+", found)
    return bool(digest or UUID.fullmatch(found) or IDENTIFIER.fullmatch(found))


def _worst_range(pieces: list[tuple[int, int, float]]) -> tuple[int, int] | None:
    """Numbers of the first and last of the neighbouring pieces (start, end, score) that span
    ``LEAST_CANDIDATE`` characters or more and have the highest score; None if it is negative."""
    best, most = None, 0.0
    total, before = 0.0, []
    first = at = 0
    for last, (start, end, score) in enumerate(pieces):
        if last:
            total -= start - pieces[last - 1][1]
        before.append(total)
        total += score
        while at <= last and end - pieces[at][0] >= LEAST_CANDIDATE:
            first = at if before[at] <= before[first] else first
            at += 1
        if at and total - before[first] >= most:
            best, most = (first, last), total - before[first]
    return best


def meeting(spans: list[Span]) -> Callable[[int, int], list[Span]]:
    """A function that gives those of ``spans`` which overlap a range. The ranges must come in
    order and not overlap each other; each span is then looked at as often as it is met, and
    twice."""
    waiting = iter(sorted(spans, key=lambda s: s[1]))
    coming = next(waiting, None)
    met: list[Span] = []

    def met_by(start: int, end: int) -> list[Span]:
        nonlocal coming, met
        met = [s for s in met if start < s[2]]
        while coming and coming[1] < end:
            if start < coming[2]:
                met.append(coming)
            coming = next(waiting, None)
        return list(met)

    return met_by


def random_parts(
    text: str, start: int, end: int, count: Callable[[str], int], taken: list[Span]
) -> list[tuple[int, int]]:
    """The random-looking ranges of pieces in a run that holds readable ones too.

    Separators count as characters without tokens, and so do identifiers and numbers; pieces
    that are digests or overlap a span in ``taken`` are in no range.
    """
    closed = meeting(taken + [("uuid", *m.span()) for m in UUID_PART.finditer(text, start, end)])
    groups: list[list[tuple[int, int, float]]] = [[]]
    for m in PIECE.finditer(text, start, end):
        s, e = m.span()
        readable = IDENTIFIER.fullmatch(m[0])
        if closed(s, e) or (not readable and is_known(m[0])):
            groups.append([])
        else:
            score = 0.0 if readable else MOST_CHARS_A_TOKEN * count(m[0])
            groups[-1].append((s, e, score - len(m[0])))
    found = []
    while groups:
        group = groups.pop()
        if worst := _worst_range(group):
            first, last = worst
            found.append((group[first][0], group[last][1]))
            groups += [group[:first], group[last + 1 :]]
    return sorted(found)


def token_spans(text: str, count: Callable[[str], int], taken: list[Span]) -> list[Span]:
    """Random-looking strings that overlap no span in ``taken``; ``count`` counts tokens."""
    spans = []
    met_by = meeting(taken)
    for m in CANDIDATE.finditer(text):
        found, (start, end) = m[0], m.span()
        if is_known(found):
            continue
        over = met_by(start, end)
        if not over and len(found) <= MOST_CHARS_A_TOKEN * count(found):
            spans.append(("token", start, end))
        else:
            spans += [("token", *part) for part in random_parts(text, start, end, count, over)]
    return spans


def token_counter(ranks_path: str) -> Callable[[str], int]:
    """Counts tokens under the byte-pair vocabulary in a file of ranks."""
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoding = tiktoken.Encoding(
        "ranks", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={}
    )
    return lambda text: len(encoding.encode_ordinary(text))


def scan(docs: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """Per document the counts of the base kinds and ``token``, the digest of the base spans,
    and all spans. ``ranks_path`` names the vocabulary, by default that of the installed
    package of public tokenizers; it must be there on every executor."""

    def start() -> Callable[[dict], dict]:
        import public_tokenizers

        count = token_counter(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"))

        def work(batch: dict) -> dict:
            made = {"doc_id": batch["doc_id"], "base_sha256": [], "spans": []}
            made |= {f"n_{kind}": [] for kind in KINDS}
            for text in batch["text"]:
                base = base_spans(text or "")
                spans = in_order(base + token_spans(text or "", count, base))
                for kind in KINDS:
                    made[f"n_{kind}"].append(sum(s[0] == kind for s in spans))
                made["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
                made["spans"].append(joined(spans))
            return made

        return work

    counts = ", ".join(f"n_{kind} long" for kind in KINDS)
    return map_batches(
        docs.select("doc_id", "text"),
        start,
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {counts}, "
        "base_sha256 string, spans string",
    )
