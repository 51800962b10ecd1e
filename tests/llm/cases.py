"""Small tables with every awkward case, and plain versions of the operators."""

from __future__ import annotations

import random
import re
from collections import Counter

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, k string, h string, score string, "
          "n_words string, node string, lot string, _row string, label string, stretches string")
CLASH = ("x",) * 9
SYLLABLES = {"en": ["the", "ing", "er", "wh", "ea", "th", "on"], "fr": ["eau", "ou", "é", "que", "oi", "eux", "le"]}


def prose(seed: int, n: int, lang: str = "en") -> str:
    draw = random.Random(seed)
    words = ["".join(draw.choices(SYLLABLES[lang], k=draw.randint(1, 3))) for _ in range(n)]
    return re.sub(r"(\. |^)(\w)", lambda m: m[1] + m[2].upper(), " ".join(
        w + ("." if i % 9 == 8 else "") for i, w in enumerate(words)))


def awkward(spark):
    """Nulls in every column, empty, blank and long texts, repeated rows and ids, passages that documents share."""
    shared = prose(900, 60)
    rows = [
        (None, prose(1, 50), None, None, None),
        (None, None, None, None, None),
        (1, prose(2, 120), "en", "s", 1),
        (1, prose(2, 120), "en", "s", 1),
        (1, prose(3, 80, "fr"), "fr", None, 2),
        (2, prose(2, 120), "en", "s", 1),
        (3, None, "en", "s", 0),
        (4, "", "en", "s", 0),
        (5, " \n\t ", None, "s", 4),
        (6, "12 345 !!! ---", "en", "s", 9),
        (7, prose(4, 40) + "\n" + shared + "\n" + prose(5, 40), "en", "s", 9),
        (8, prose(6, 30) + "\n" + shared, "en", "s", 9),
        (9, "word", "en", "s", 4),
        (10, "word", "fr", "s", 4),
        (11, prose(7, 20_000, "fr"), "fr", "s", 9),
        (12, "ab" * 400, None, "s", 800),
        (13, "é" * 300 + " ñ 日本語 <|endoftext|> x", "fr", "s", 300),
        (-14, prose(2, 119), "en", "s", 1),
        (15, "the the the the\nthe the the the\nthe the the the\n" * 5, "en", "s", 1),
    ]
    return spark.createDataFrame([r + CLASH for r in rows], SCHEMA)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def collected(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


def words(text: str) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def repeated_words(texts: list[str], window: int) -> list[list[bool]]:
    """Which words lie in a window that starts more than once in all the texts."""
    cut = [words(t) for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in cut for i in range(len(w) - window + 1))
    out = []
    for w in cut:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        out.append(gone)
    return out


def earlier_bytes(texts: list[bytes], length: int) -> list[bytes]:
    """A mask for each text, in the order that counts as earlier."""
    seen, out = set(), []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            part = t[i:i + length]
            if part in seen:
                gone[i:i + length] = b"\1" * length
            seen.add(part)
        out.append(bytes(gone))
    return out


def near_classes(texts: dict, size: int = 5, threshold: float = 0.8) -> dict:
    """Smallest key of the class of each text, from all pairs, with the unweighted similarity."""
    sets = {}
    for key, t in texts.items():
        w = t.encode().lower().split()
        sets[key] = Counter(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))) if w else Counter()
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = list(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            shared = sum((sets[a] & sets[b]).values())
            if shared and shared >= threshold * sum((sets[a] | sets[b]).values()):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}
