import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from rasmlens.llm import merkle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts):
    return hashlib.sha256("".join(parts).encode("utf-8", "surrogatepass")).hexdigest()


def framed(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(level):
    """The top over digests, and the (left, right) siblings of each."""
    paths, at = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for i, p in enumerate(at):
            other = p ^ 1
            step = (level[other] if other < p else "", level[other] if p < other < len(level) else "")
            paths[i].append(step)
        level = [digest(*level[i:i + 2]) for i in range(0, len(level), 2)]
        at = [p // 2 for p in at]
    return level[0], paths


def plain(rows, tampered):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    tops, out = [], []
    for g in order:
        leaves = sorted(((r[0] is not None, r[0] or 0, digest(*map(framed, r))), r) for r in groups[g])
        top, paths = climb([key[2] for key, _ in leaves])
        tops.append(top)
        out.append([(r, key[2], top, path) for (key, r), path in zip(leaves, paths)])
    root, above = climb(tops)
    found = []
    for members, up in zip(out, above):
        for r, leaf, top, path in members:
            whole, changed = path + up, list(r)
            if tampered(r) and r[3] is not None:
                changed[3] += 1
            middle = digest(*map(framed, changed))
            for left, right in whole:
                middle = digest(left, middle, right)
            found.append((r[0], leaf, top, root, digest(*[a + b for a, b in whole]), middle, middle == root))
    return found


def run(documents, rows):
    """Rows are (doc_id, source, lang, n_chars, text)."""
    docs = documents([(r[0], r[4], r[2], r[1]) for r in rows])
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    got = merkle.manifest(docs, FIELDS, changed=(tampered, {"n_chars": F.col("n_chars") + 1}))
    return [tuple(r) for r in got.drop("path").collect()]


def key(row):
    return tuple((v is not None, str(v)) for v in row)


def hit(r):
    return r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0


def rows_of(sizes):
    rows, id = [], 0
    for lang, size in sizes.items():
        for _ in range(size):
            id = (id * 31 + 7) % 1_000_003
            text = f"text {id} é"
            rows.append((id, f"src{id % 3}", lang, len(text), text))
    return rows


@pytest.mark.parametrize("bits", [1, 2, 8])
def test_against_plain(documents, monkeypatch, bits):
    """Small blocks make trees of several tiers."""
    monkeypatch.setattr(merkle, "BITS", bits)
    rows = rows_of({"en": 37, "de": 8, "fr": 1, "": 5, None: 2, "Ω": 3, "z\U0001F600": 1, "zｚ": 2} if bits > 1 else
                   {"en": 7, None: 1, "fr": 4})
    got = run(documents, rows)
    assert sorted(got, key=key) == sorted(plain(rows, hit), key=key)
    assert {g[-1] for g in got} == {True, False}
    assert all(g[-1] == (not hit((g[0],))) for g in got)


def test_more_than_one_block(documents):
    rows = rows_of({"en": 700, "de": 257, "fr": 256})
    assert sorted(run(documents, rows), key=key) == sorted(plain(rows, hit), key=key)


def test_odd_rows(documents):
    rows = [(None, None, None, 0, None), (None, "a", None, 2, "xy"), (1, "a", "en", 2, "xy"), (1, "a", "en", 2, "xy"),
            (1, "b", "en", 0, ""), (7, "a", "en", 300_000, "é" * 300_000), (-5, "a", "en", 3, "a\nb")]
    assert sorted(run(documents, rows), key=key) == sorted(plain(rows, hit), key=key)


def test_one_row_and_none(documents):
    rows = [(11, "a", "en", 2, "xy")]
    got = run(documents, rows)
    assert got == plain(rows, hit) and got[0][1] == got[0][2] == got[0][3] and got[0][4] == digest("")
    assert run(documents, []) == []


def test_null_field_is_not_changed(documents):
    tampered = (F.lit(True), {"n_chars": F.col("n_chars") + 1})
    docs = documents([(1, "x", "en", "a"), (2, "y", "en", "a")]).withColumn(
        "n_chars", F.when(F.col("doc_id") == 1, F.col("n_chars")))
    got = {r.doc_id: r.verified for r in merkle.manifest(docs, changed=tampered).collect()}
    assert got == {1: False, 2: True}
