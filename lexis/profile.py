"""Language profiles: how text becomes index terms.

A profile holds the split pattern, the word-shape pattern, the words dropped
before the shape test, an optional stop list and an optional stemmer rule
set. The same profile must be used for the corpus and for the queries.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# --- fixed values (the tokenizer's observable behaviour must match) --------
# Separator class: Unicode separators, whitespace, . , ; : ! ? ' " ( ) / \
SPLIT_PATTERN = r"[\p{Z}\s.,;:!?'\"()/\\]+"
# Russian words: Cyrillic a..ya in both cases plus hyphen (yo is outside it).
RUSSIAN_WORD = r"[а-яА-Я\-]+"
# Latin-script fixtures: any letter plus hyphen.
LETTER_WORD = r"[\p{L}\-]+"
# The en dash is dropped as a word of its own.
EN_DASH = "–"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class LanguageProfile:
    name: str
    word_pattern: str = LETTER_WORD          # whole-token match, no anchors
    split_pattern: str = SPLIT_PATTERN
    drop_words: tuple[str, ...] = (EN_DASH,)
    stop_words: tuple[str, ...] = ()         # exact, lower-case, unstemmed
    stemmer: str | None = None               # key into normalize.STEMMERS

    def with_stop_words(self, words) -> "LanguageProfile":
        """Stop list from any iterable of lines: BOM stripped, blanks and
        multi-word phrases dropped (a token never holds a space)."""
        clean = []
        for w in words:
            w = (w or "").lstrip("\ufeff").strip()
            if w and not any(c.isspace() for c in w):
                clean.append(w)
        return replace(self, stop_words=tuple(dict.fromkeys(clean)))

    def with_stemmer(self, stemmer: str | None) -> "LanguageProfile":
        return replace(self, stemmer=stemmer)


RUSSIAN = LanguageProfile("ru", word_pattern=RUSSIAN_WORD, stemmer="russian")
LATIN = LanguageProfile("latin", word_pattern=LETTER_WORD)
