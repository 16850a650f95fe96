"""The settings that all text rules share, as one immutable value."""

from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace

from pyspark.sql import Column

from rasmlens.functions import lexicon as lex


@dataclass(frozen=True)
class TextProfile:
    """Rules for cleaning, tokenising and counting.

    ``hamza``: ``"alef"`` writes every hamza form as a plain alef, ``"hamza"``
    writes every carrier as a bare hamza (and madda as two).
    ``fold_alef_maksura``: also write the final dotless yeh as alef.
    ``punctuation_tokens``: keep runs of two or more non-word characters as tokens.
    ``normalize_lexicon``: bring word lists to the spelling of cleaned text. Off by
    default, so that entries whose spelling cleaning changes never match.
    ``noun_counter``: replaces the noun heuristic; gets the token array column.
    ``stopwords`` become part of the query; ``prepare`` takes long lists as a table.
    """

    stopwords: tuple[str, ...] = lex.DEFAULT_STOPWORDS
    verbs: tuple[str, ...] = lex.COMMON_VERBS
    noun_suffixes: tuple[str, ...] = lex.NOUN_SUFFIXES
    hamza: str = "alef"
    fold_alef_maksura: bool = False
    punctuation_tokens: bool = False
    normalize_lexicon: bool = False
    min_tokens: int = 5
    noun_counter: Callable[[Column], Column] | None = None

    def __post_init__(self):
        if self.hamza not in ("alef", "hamza"):
            raise ValueError(f"unknown hamza mode {self.hamza!r}")

    def with_stopwords(self, words: Iterable[str]) -> "TextProfile":
        return replace(self, stopwords=tuple(words))

    def fold_word(self, word: str) -> str:
        """Spelling of a list entry after cleaning."""
        word = word.translate({ord(c): None for c in lex.DIACRITICS + lex.TATWEEL})
        if self.hamza == "alef":
            word = word.translate({ord(c): lex.ALEF for c in lex.HAMZA_TO_ALEF})
        else:
            word = word.replace(lex.ALEF_MADDA, lex.HAMZA * 2)
            word = word.translate({ord(c): lex.HAMZA for c in lex.HAMZA_CARRIERS})
        alefs = lex.ALEF_WASLA + (lex.ALEF_MAKSURA if self.fold_alef_maksura else "")
        return word.translate({ord(c): lex.ALEF for c in alefs})

    def words(self, entries: Iterable[str]) -> list[str]:
        unique = dict.fromkeys(self.fold_word(w) if self.normalize_lexicon else w for w in entries)
        return list(unique)


DEFAULT = TextProfile()
