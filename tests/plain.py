"""The text rules in plain Python, as an independent check of the column forms."""

import re

from rasmlens.functions import lexicon as lex

VOWELS = set("اوي" "ًٌٍَُِْ")


def normalize(text):
    if text is None:
        return None
    text = "".join(c for c in text if not "ً" <= c <= "ْ" and c != "ـ")
    text = "".join("ا" if c in "ءأإآٱ" else c for c in text)
    text = "".join("لا" if "ﻵ" <= c <= "ﻼ" else c for c in text)
    text = re.sub(r"[^؀-ۿ\sA-Za-z0-9.,!?:;]", " ", text)
    return re.sub(r"[ \t]+", " ", text).strip()


def tokens(clean, stopwords=lex.DEFAULT_STOPWORDS):
    out, run = [], ""
    for c in (clean or "") + " ":
        if c.isalnum() or c in "_'" or "ً" <= c <= "ْ":
            run += c
        else:
            if len(run) > 1 and run not in stopwords:
                out.append(run)
            run = ""
    return out


def syllables(word):
    starts = sum(1 for i, c in enumerate(word)
                 if c in VOWELS and (i == 0 or word[i - 1] not in VOWELS))
    return max(starts, 1) if word else 0


def noun(word):
    shaped = len(word) == 3 or word.startswith("ال") or word.endswith(lex.NOUN_SUFFIXES)
    return len(word) >= 3 and word not in lex.COMMON_VERBS and shaped
