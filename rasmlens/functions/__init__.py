from rasmlens.functions.normalize import is_blank, normalize_arabic
from rasmlens.functions.profile import DEFAULT, TextProfile
from rasmlens.functions.stylometry import (
    avg_syllables, count_nouns, looks_like_noun, syllables, type_token_ratio)
from rasmlens.functions.tokens import (
    drop_stopwords, drop_stopwords_by_table, split_words, tokenize)

__all__ = [
    "DEFAULT", "TextProfile", "avg_syllables", "count_nouns", "drop_stopwords",
    "drop_stopwords_by_table", "is_blank", "looks_like_noun", "normalize_arabic",
    "split_words", "syllables", "tokenize", "type_token_ratio",
]
