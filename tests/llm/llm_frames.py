"""Documents for the tests of the training-data operators."""

import re
from collections import Counter

from wayposts.sources.tables import literal_frame

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, rows, extra=True):
    """Documents from (doc_id, text) or (doc_id, text, source), with columns that operators
    might use names of."""
    values = []
    for doc_id, text, *source in rows:
        values.append((doc_id, text, "en", source[0] if source else "a", len(text or "")))
    frame = literal_frame(spark, values, SCHEMA)
    if not extra:
        return frame
    names = "size words node bands stats rule gone doc i bucket order sid target row rank label"
    return frame.selectExpr("*", *[f"'kept' as `{name}`" for name in names.split()])


def some_words(chance, n, letters="abcdefgh"):
    return ["".join(chance.choices(letters, k=chance.randint(2, 5))) for _ in range(n)]


def shingles(text):
    words, seen, found = WORD.findall(text), Counter(), set()
    for i in range(max(1, len(words) - 4)):
        gram = tuple(words[i : i + 5])
        seen[gram] += 1
        found.add((gram, seen[gram]))
    return found


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


def repeated_words(words):
    places = {}
    for i in range(len(words) - 4):
        places.setdefault(tuple(words[i : i + 5]), []).append(i)
    return len({j for at in places.values() if len(at) > 1 for i in at for j in range(i, i + 5)})


def deleted_lines(rows, least=50):
    """Numbers of the lines to delete per (doc_id, text), by comparing every run of lines."""
    rows = sorted(set(rows), key=lambda r: (r[0] is None, r[0]))
    worded = []
    for doc_id, text in rows:
        lines = enumerate((text or "").split("\n"))
        worded.append([(at, line, len(WORD.findall(line))) for at, line in lines if WORD.search(line)])
    seen, gone = set(), {}
    for number, lines in enumerate(worded):
        for first in range(len(lines)):
            for last in range(first, len(lines)):
                run = lines[first : last + 1]
                key = tuple(line for _, line, _ in run)
                if sum(n for *_, n in run) >= least:
                    if key in seen:
                        gone.setdefault(rows[number], set()).update(at for at, *_ in run)
                    seen.add(key)
    return {row: sorted(at) for row, at in gone.items()}
