"""Column expressions for turning text into words.

Everything here is a plain ``Column`` built from ``pyspark.sql.functions``:
it runs inside the JVM next to the scan, needs no shuffle and no Python
worker. Order of operations follows the tokenizer being matched: split,
then lower-case, then drop, then the shape test, then the stop list.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexis.profile import LanguageProfile


def full_match(pattern: str) -> str:
    """Anchor a pattern so ``rlike`` (a find) behaves like a whole match.

    ``\\z`` rather than ``$``: ``$`` would also accept a final line break.
    """
    return f"^(?:{pattern})\\z"


def is_word(word: Column, profile: LanguageProfile) -> Column:
    """Word-shape, dash and stop-word tests on one lower-cased token."""
    keep = word.rlike(full_match(profile.word_pattern))
    if profile.drop_words:
        keep = keep & ~word.isin(*profile.drop_words)
    if profile.stop_words:
        # Compiled to a hash-set lookup (InSet) for lists over ten words.
        keep = keep & ~word.isin(*profile.stop_words)
    return keep


def words(text: Column, profile: LanguageProfile) -> Column:
    """``array<string>``: the kept words of one text, in order, repeats kept.

    NULL text gives an empty array.
    """
    parts = F.split(F.coalesce(text, F.lit("")), profile.split_pattern)
    lowered = F.transform(parts, lambda w: F.lower(w))
    kept = F.filter(lowered, lambda w: is_word(w, profile))
    if profile.stemmer:
        from lexis.operators.normalize import stem_array
        kept = stem_array(kept, profile.stemmer)
    return kept


def field_words(cols: list[Column], profile: LanguageProfile) -> Column:
    """Words of several fields of one record, field after field."""
    arrays = [words(c, profile) for c in cols]
    return arrays[0] if len(arrays) == 1 else F.concat(*arrays)
