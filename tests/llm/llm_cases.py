"""Hand-made documents with the awkward cases, and small brute-force helpers."""

import re
from collections import Counter

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "row string, score string, kept string, size string, h string, `a.b` int")
WORD = re.compile(r"[^\x20\x09-\x0D]+")

LONG = " ".join(f"w{i % 977} the" for i in range(30_000))


def rows():
    """Nulls in every column, empty and very long texts, repeated rows and keys, equal texts."""
    out = [
        (1, "one two three four five six seven", "en", "a", 3),
        (2, None, "en", "a", None),
        (3, "", None, "a", 0),
        (4, " \t\n ", "en", None, 4),
        (5, LONG, "en", "b", 1),
        (6, "one two three four five six seven", "en", "b", 3),
        (6, "one two three four five six seven", "en", "b", 3),
        (7, "same line\nsame line\nother ### $$ 'x'", "de", "b", 9),
        (None, "a text without a key", "en", "c", 9),
        (8, "ÄÖ é 12 <|endoftext|> x", None, None, None),
        (9, "word", "fr", "c", 4),
    ]
    return [(*r, "r", "s", "k", "z", "h", 1) for r in out]


def docs(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return WORD.findall(text or "")


def bag(text, n=5):
    w = words((text or "").lower())
    return Counter(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))) if w else Counter()


def jaccard(a, b):
    both = sum((a & b).values())
    whole = sum((a | b).values())
    return both / whole if whole else 1.0
