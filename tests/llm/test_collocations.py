import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasmlens.llm import collocations as c


def plain(rows, per_language, min_count):
    counts = defaultdict(Counter)
    for lang, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            counts["und" if lang is None else lang].update(
                tuple(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(v for p, v in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        longer = defaultdict(int)
        for p, a in candidates.items():
            if len(p) == 3:
                for part in (p[:2], p[1:]):
                    longer[part] = max(longer[part], a)
        found = []
        for p, a in candidates.items():
            if 100 * longer[p] >= 50 * a and len(p) == 2:
                continue
            s, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((s, a, " ".join(p), f[p[:k]], f[p[k:]]))
        found.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i + 1, p, a, l, r, n, s) for i, (s, a, p, l, r) in enumerate(found[:per_language])]
    return out


def run(documents, rows, **options):
    docs = documents([(i, t, lang, "a") for i, (lang, t) in enumerate(rows)])
    return sorted(tuple(r) for r in c.collocations(docs, **options).collect())


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"W{i}" for i in range(12)] + ["é", "Ω", "\U0001F600x", "ｚ"]
    fixed = [" ".join(rng.choice(words) for _ in range(3)) for _ in range(6)]
    rows = []
    for _ in range(n):
        said = [rng.choice(fixed) if rng.random() < 0.4 else rng.choice(words) for _ in range(rng.randint(0, 12))]
        rows.append((rng.choice(["en", "en", "de", None, ""]),
                     "".join(w + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"]) for w in said)))
    return rows


@pytest.mark.parametrize("per_language", [3, 40, 2000])
def test_against_plain(documents, per_language):
    """Few wanted phrases leave most pairs unexpanded; many need all of them."""
    rows = corpus(1, 200)
    for min_count in (2, 10):
        got = run(documents, rows, per_language=per_language, min_count=min_count)
        assert got == sorted(plain(rows, per_language, min_count))


def test_rounds_go_on_until_enough_survive(documents, monkeypatch):
    """A first round of one pair is followed by others; earlier triples are not counted again."""
    monkeypatch.setattr(c, "FIRST_ROUND", 0.05)
    rows = corpus(2, 200)
    listed = []
    whole = c.count_triples
    monkeypatch.setattr(c, "count_triples", lambda *a: (listed.append(1), whole(*a))[1])
    assert run(documents, rows, per_language=20, min_count=2) == sorted(plain(rows, 20, 2))
    assert len(listed) > 1


def test_saturated_bitmaps_change_nothing(documents, monkeypatch):
    monkeypatch.setattr(c, "MOST_BITS", 64)
    rows = corpus(3, 100)
    assert run(documents, rows, per_language=20, min_count=2) == sorted(plain(rows, 20, 2))


def test_odd_rows(documents, monkeypatch):
    monkeypatch.setattr(c, "CHUNK", 50)
    rows = [(None, None), ("und", "a b c a b c"), (None, "A b. c"), ("en", ""), ("en", " \t"), ("en", ".,;:"),
            ("en", "same words here"), ("en", "same words here"), ("fr", "x " * 5000), ("fr", "y" * 100_000 + " z")]
    assert run(documents, rows, per_language=50, min_count=2) == sorted(plain(rows, 50, 2))
    assert run(documents, []) == []
    assert run(documents, [("en", "nothing twice")]) == []


def test_pieces_end_phrases_and_chunks_do_not(monkeypatch):
    monkeypatch.setattr(c, "CHUNK", 4)
    numbers = c.Numbers()
    ids = np.concatenate(list(numbers.of("Aa bb\tcc,dd\r\nAA")))
    words = [b"|", *list(numbers)[1:]]
    assert [words[i + 1] for i in ids] == [b"aa", b"bb", b"cc", b"|", b"dd", b"|", b"|", b"aa"]


def test_scores_are_exact_beyond_64_bits(spark):
    cases = [(10**14 + 7, 3 * 10**14 + 1, 10**14 + 7), (10, 10, 10), (3 * 10**9, 4 * 10**9 + 1, 5 * 10**9), (1, 3, 10**14)]
    got = spark.createDataFrame(cases, "a long, l long, r long").select(
        c.score(F.col("a"), F.col("l"), F.col("r")).alias("s")).collect()
    assert [r.s for r in got] == [10**6 * a * a // (l * r) for a, l, r in cases]
