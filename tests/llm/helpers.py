"""Small tables for the operator tests."""

from __future__ import annotations

import re

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, "
        # names that the operators use themselves
        "key string, row_key string, size string, kept string, n_words string, bucket string, score string")


def documents(spark, rows):
    """rows of (doc_id, text[, lang[, source]]) with extra, clashing columns."""
    full = []
    for r in rows:
        r = (*r, *[None] * (4 - len(r)))
        full.append((*r, None if r[1] is None else len(r[1]), "k", "r", None, "x", "1", "b", "s"))
    return spark.createDataFrame(full, DOCS)


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower_words(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)


def edge_rows():
    """Null and empty texts, blanks, a long text, ties, repeated rows, null ids."""
    long = " ".join(f"w{i % 997}x{i}" for i in range(30_000))
    return [(1, None), (2, ""), (3, " \t\n "), (4, long), (5, "one two"), (5, "one two"), (6, "one two"),
            (None, "three four five"), (None, None), (7, "#### $$$ !!!"), (8, "été Über x y")]


VECS = "vec_id long, embedding array<float>, label int, id string, vec string, cid string, n string, cell string, home string, x string"


def vectors(spark, rows):
    """rows of (vec_id, embedding, label) with extra, clashing columns."""
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], g,
                                   "i", "v", "c", "n", "c", "h", "x") for i, v, g in rows], VECS)
