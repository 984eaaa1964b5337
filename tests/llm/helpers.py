"""Shared by the operator tests: awkward documents and small brute forces."""

import re

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC_COLS = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"word{i % 977}" for i in range(60_000))

AWKWARD = [
    (1, "The cat sat on the mat. It was a fine, fine day!", "en", "a", 1),
    (1, "The cat sat on the mat. It was a fine, fine day!", "en", "a", 1),      # repeated row
    (2, None, None, None, None),
    (3, "", "en", "b", 0),
    (4, "   \t\n ", "en", "b", 0),
    (5, "one", "en", None, 3),
    (6, "Ünïcode ÉÀ straße \u00a0nbsp\u2003em ΑΣ İstanbul e\u0301a it's we'll <|endoftext|> x<|ENDOFTEXT|>",
     "de", "b", 5),
    (7, LONG, "en", "a", len(LONG)),
    (None, "no id here at all, yet some words", "en", "a", 9),
    (8, "The cat sat on the mat. It was a fine, fine day.", "en", "c", 1),
    (9, "1,2,,3... a.b,c ''' don't STOP!!", "en", "c", 1),
]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def awkward(spark):
    return spark.createDataFrame(AWKWARD, DOC_COLS)


def clashing(spark):
    """The awkward documents with columns named like the operators' own."""
    from pyspark.sql import functions as F
    names = ["row", "text_hash", "found_doc_id", "size", "copies", "h", "words", "score", "spans", "new",
             "n_entities_", "start", "unit", "fp", "root", "quality", "x y", "held_out"]
    return awkward(spark).select("*", *[F.lit(i).alias(n) for i, n in enumerate(names)])


def empty(spark):
    return spark.createDataFrame([], DOC_COLS)


def as_set(df, *cols):
    return sorted((tuple(r[c] for c in cols or df.columns) for r in df.collect()), key=repr)
