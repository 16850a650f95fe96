import hashlib
import random
import re

from pyspark.sql import functions as F

from rasmlens.llm import sketches


def md5(s):
    return hashlib.md5(s.encode()).hexdigest()


def plain_sketch(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    hashes = {md5(" ".join(w[i:i + 5])) for i in range(max(len(w) - 4, 1))}
    return sorted(h[:16] for h in hashes if h < "2"), "-" + md5(" ".join(w))[:16]


def plain_likeness(a, b):
    (ka, wa), (kb, wb) = plain_sketch(a), plain_sketch(b)
    if (ka and ka == kb) or (not ka and not kb and wa == wb):
        return 1.0
    return len(set(ka) & set(kb)) / min(len(ka), len(kb)) if ka and kb else 0.0


def name(text):
    kept, whole = plain_sketch(text)
    return "".join(kept) or whole


def plain(rows):
    order = sorted(((id, text or "") for id, text in rows if id is not None), reverse=True)
    out = []
    for i, (id, text) in enumerate(order):
        after = order[(i + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        out.append((id, len(text), edited, name(text), name(edited),
                    plain_likeness(text, edited), plain_likeness(text, after)))
    return out + [(None, len(text or ""), None, name(text or ""), None, None, None) for id, text in rows if id is None]


def run(documents, rows):
    got = sketches.fingerprints(documents([(i, t, "en", "a") for i, t in rows])).drop("in_edited")
    return [tuple(r) for r in got.collect()]


def key(row):
    return tuple((v is None, str(v)) for v in row)


def texts(n, rng):
    vocabulary = [f"w{i}é" for i in range(200)]
    return [" ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 4, 5, 6, 30, 200]))) for _ in range(n)]


def test_against_plain(documents):
    rng = random.Random(5)
    made = texts(150, rng)
    # Blocks of one row and of many, ids below zero, gaps wider than a block.
    ids = rng.sample(range(-300, 300), 100) + rng.sample(range(10_000, 10_000_000), 50)
    rows = list(zip(ids, made + [made[0]] * 50))
    assert sorted(run(documents, rows), key=key) == sorted(plain(rows), key=key)


def test_odd_rows(documents):
    rng = random.Random(6)
    long = " ".join(f"v{rng.random()}" for _ in range(60_000))
    rows = [(None, None), (None, "a b"), (1, None), (2, ""), (3, "same same"), (3, "same same"), (3, "other"),
            (4, long), (1 << 60, "\U0001F600" * 7), (5, " \t\n\x0b "), (6, "same  same")]
    got = run(documents, rows)
    assert sorted(got, key=key) == sorted(plain(rows), key=key)
    assert len({r[3] for r in got if r[0] in (1, 2, 5)}) == 1


def test_one_row_and_none(documents):
    rows = [(9, "a b c d e f g h")]
    got = run(documents, rows)
    assert got == plain(rows) and got[0][2] == "a b c d a b c d"[:8] + "a b c d"[:7] and got[0][6] == 1.0
    assert run(documents, []) == []


def test_containment_of_a_short_text_in_a_long_one(spark):
    rng = random.Random(7)
    words = [f"w{rng.random()}" for _ in range(20_000)]
    part = " ".join(words[5_000:7_000])
    other = " ".join(f"x{rng.random()}" for _ in range(2_000))
    df = spark.createDataFrame([(part, " ".join(words), other)], "part string, whole string, other string")
    kept = df.select(*[sketches.sketch(F.col(c)).alias(c) for c in df.columns])
    row = kept.select(
        sketches.containment(F.col("part"), F.col("whole")).alias("part_in_whole"),
        sketches.containment(F.col("whole"), F.col("part")).alias("whole_in_part"),
        sketches.containment(sketches.merge(F.col("part"), F.col("other")), F.col("whole")).alias("merged_in_whole"),
        F.size("whole").alias("n")).first()
    assert row.part_in_whole == 1.0
    assert abs(row.whole_in_part - 0.1) < 0.03
    assert abs(row.merged_in_whole - 0.5) < 0.1
    assert abs(row.n - 2_500) < 250


def test_merging_is_the_union(spark):
    a, b = "a b c d e f g h i j k l m n o p q r s t u v w x y z", "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18"
    df = spark.createDataFrame([(a, b)], "a string, b string").select(
        sketches.merge(sketches.sketch(F.col("a")), sketches.sketch(F.col("b"))).alias("m"))
    assert df.first().m == sorted(set(plain_sketch(a)[0]) | set(plain_sketch(b)[0]))


def test_no_python_in_the_plan(documents, plan_of):
    plan = plan_of(sketches.fingerprints(documents([(1, "a", "en", "a")])))
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
