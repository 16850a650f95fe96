import hashlib
import random

from pyspark.sql import functions as F

from rasmlens.llm import mixing


def fill(budget, children):
    """Shares of (name, capacity, weight): pour, fill up the full ones, pour again."""
    share = {name: 0.0 for name, _, _ in children}
    open_ = {name: (cap, w) for name, cap, w in children if w}
    left = min(float(budget), sum(c for c, _ in open_.values()))
    while open_ and left > 1e-9:
        total = sum(w for _, w in open_.values())
        full = [n for n, (cap, w) in open_.items() if cap - share[n] <= left * w / total + 1e-9]
        if not full:
            for n, (_, w) in open_.items():
                share[n] += left * w / total
            break
        for n in full:
            left -= open_[n][0] - share[n]
            share[n] = float(open_.pop(n)[0])
    return share


def plain(rows, weights, share, epochs, seed):
    tokens = lambda rs: sum(r[3] for r in rs)
    out = []

    def down(rs, path, depth, budget):
        if depth == 2:
            whole = tokens(rs)
            budget = int(budget + 1e-6)
            full = budget // whole if whole else 0
            rest, before = budget - full * whole, 0
            key = lambda r: hashlib.md5(f"{seed}:{full}:{'' if r[0] is None else r[0]}".encode()).hexdigest()
            for r in sorted(rs, key=key):
                n = full + (before < rest)
                before += r[3]
                if n:
                    out.append((r[0], n))
            return
        names = sorted({r[1 + depth] for r in rs}, key=str)
        shares = fill(budget, [(n, epochs * tokens([r for r in rs if r[1 + depth] == n]),
                                weights.get((*path, n), 1)) for n in names])
        for n in names:
            down([r for r in rs if r[1 + depth] == n], (*path, n), depth + 1, shares[n])

    total = tokens(rows)
    down(rows, (), 0, min(int(total * share), total * epochs))
    return out


def run(spark, rows, weights, share, epochs, seed=3):
    df = spark.createDataFrame(
        [(*r, "c", 1, "k") for r in rows], "doc_id long, a string, b string, n long, copies string, epochs int, key string")
    out = mixing.mix(df, {"a": F.col("a"), "b": F.col("b")}, weights, share, epochs, seed, tokens=F.col("n"))
    assert out.columns == ["doc_id", "a", "b", "n", "epochs", "key", "copies"]
    return [(r["doc_id"], r["copies"]) for r in out.collect()]


def test_against_plain(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice("xyz"), rng.choice(["p", "q", "r", None]), rng.randint(0, 40)) for i in range(400)]
    weights = {("x",): 5, ("x", "p"): 3, ("y", "q"): 7, ("z", "r"): 0}
    for share, epochs in ((0.3, 1), (0.8, 2), (1.5, 3), (5.0, 2)):
        assert sorted(run(spark, rows, weights, share, epochs)) == sorted(plain(rows, weights, share, epochs, 3))


def test_shortage_goes_to_siblings_before_ancestors(spark):
    rows = [(i, "x", "small", 10) for i in range(2)] + [(10 + i, "x", "large", 10) for i in range(50)] + [
        (100 + i, "y", "other", 10) for i in range(50)]
    got = dict(run(spark, rows, {("x",): 1, ("y",): 1}, 0.5, 1))
    tokens = lambda ids: 10 * sum(i in got for i in ids)
    assert tokens(range(2)) == 20            # all the small leaf has
    assert tokens(range(10, 60)) == 240      # what the small one could not use went to its sibling
    assert tokens(range(100, 150)) == 260 or tokens(range(100, 150)) == 250


def test_odd_rows(spark):
    rows = [(1, None, None, 5), (1, None, None, 5), (None, "x", "p", 3), (2, "x", "p", 0), (3, "x", "p", None), (None, None, None, 9)]
    whole = run(spark, rows, {}, 2.0, 2)
    assert sorted(whole, key=str) == sorted([(1, 2), (1, 2), (None, 2), (2, 2), (3, 2), (None, 2)], key=str)
    assert run(spark, rows, {}, 0.0, 2) == []
    assert run(spark, [], {}, 1.0, 2) == []


def test_words(spark):
    texts = [None, "", " a\tb\x0bc  d\x85e ", "x " * 1000]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r[0] for r in df.select(mixing.word_count(F.col("text"))).collect()] == [0, 0, 4, 1000]
