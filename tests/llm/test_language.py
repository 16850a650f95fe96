import random
import zlib
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from rasmlens.llm import language

VOCABULARY = {
    "aa": "the of and to in that was with for this".split(),
    "bb": "der die und das nicht sie ein mit auch wird".split(),
    "cc": "que los una por con para como pero sobre entre".split(),
}


def text_in(rng, name, n):
    return " ".join(rng.choice(VOCABULARY[name]) for _ in range(n))


def corpus(documents, rng):
    rows = [(i, text_in(rng, "aabbcc"[i % 3 * 2:i % 3 * 2 + 2], 60), "aabbcc"[i % 3 * 2:i % 3 * 2 + 2]) for i in range(150)]
    return documents([*rows, (900, None, "aa"), (901, "no label here", None), (902, "", "bb")])


def test_single_and_mixed_texts(documents):
    rng = random.Random(1)
    model = language.train(corpus(documents, rng))
    assert model.languages == ("aa", "bb", "cc")
    rows = [(1, text_in(rng, "bb", 100)), (2, text_in(rng, "aa", 70) + " " + text_in(rng, "cc", 30)), (3, None), (4, ""),
            (5, "123 !!! ---"), (6, text_in(rng, "cc", 100).upper()), (7, text_in(rng, "aa", 200_000)),
            (None, text_in(rng, "aa", 5)), (8, "x"), (8, "x")]
    got = language.identify(documents(rows), model, ["doc_id", "fp"]).collect()
    assert len(got) == len(rows) and got[0]["fp"] == "f"
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[1]["lang_pred"] == "bb" and by_id[1]["score"] == 1.0
    mixed = {s["lang"]: s["share"] for s in by_id[2]["languages"]}
    assert mixed.keys() == {"aa", "cc"} and abs(mixed["aa"] - 0.68) < 0.12 and abs(sum(mixed.values()) - 1) < 1e-6
    for id in (3, 4, 5):
        assert (by_id[id]["lang_pred"], by_id[id]["score"], by_id[id]["languages"]) == ("und", 0.0, [])
    assert by_id[6]["lang_pred"] == "cc" and by_id[7]["lang_pred"] == "aa" and by_id[None]["lang_pred"] == "aa"
    assert by_id[8]["lang_pred"] in model.languages


def test_trigrams_against_plain():
    rng = random.Random(2)
    texts = ["".join(rng.choice("abÉ İß 1.\nя") for _ in range(rng.randint(0, 40))) for _ in range(50)]
    place, bins = language.trigram_bins(texts)
    want_places, plain = [], []
    for i, t in enumerate(texts):
        t = " " + "".join(c if c.isalpha() else " " for c in t.lower()) + " "
        for at in range(1, len(t) - 1):
            if t[at] != " ":
                want_places.append(i)
                plain.append(t[at - 1:at + 2])
    assert place.tolist() == want_places
    code = dict(zip(plain, bins.tolist()))
    assert [code[p] for p in plain] == bins.tolist()


def test_mixture_climbs_to_the_best_proportions():
    rng = np.random.default_rng(4)
    p = rng.dirichlet(np.ones(40), 3)
    n = rng.multinomial(4000, 0.7 * p[0] + 0.3 * p[2]).astype("f8")
    counts = language._Counts(np.zeros(40, "i8"), n, p, 1)
    share, likelihood = language.mixture(counts, np.full((1, 3), 1 / 3), 200, 1e-9)
    grid = np.linspace(0.001, 0.999, 999)
    best = max(float((n * np.log(a * p[0] + (1 - a) * p[2])).sum()) for a in grid)
    assert likelihood[0] >= best - 0.5 and abs(share[0, 0] - 0.7) < 0.08


def test_language_sets_against_all_subsets():
    """The set chosen by growing has the best penalised likelihood of all sets, or one as good."""
    rng = np.random.default_rng(6)
    p = rng.dirichlet(np.full(60, 0.5), 4)
    same = 0
    docs = 60
    for _ in range(docs):
        among = rng.choice(4, rng.integers(1, 4), replace=False)
        share = rng.dirichlet(np.full(len(among), 4.0))
        n = rng.multinomial(int(rng.integers(60, 3000)), share @ p[among]).astype("f8")
        full = np.flatnonzero(n)
        counts = language._Counts(np.zeros(len(full), "i8"), n[full], p[:, full], 1)

        def value(languages):
            start = np.zeros((1, 4))
            start[0, list(languages)] = 1 / len(languages)
            return language.mixture(counts, start, 300, 1e-7)[1][0] / 3 - np.log(n.sum()) * len(languages)

        chosen = tuple(np.flatnonzero(language.infer(counts, 1.0, 300)[0]).tolist())
        values = {s: value(s) for k in range(1, 5) for s in combinations(range(4), k)}
        best = max(values.values())
        same += values[chosen] >= best - 1e-6
        assert values[chosen] >= best - 3.0, (chosen, values)
    assert same >= 0.9 * docs


def test_no_language_learnt(documents):
    model = language.train(documents([(1, "text", None), (2, None, "aa")]))
    assert model.languages == ()
    assert language.identify(documents([(1, "text")]), model, ["doc_id"]).first()["lang_pred"] == "und"
    assert language.identify(documents([]), model, ["doc_id"]).count() == 0


def test_bound_on_fitted_rows_keeps_every_language(documents):
    rng = random.Random(3)
    model = language.train(corpus(documents, rng), max_rows_per_language=20)
    assert model.languages == ("aa", "bb", "cc")


def test_held_out_is_the_crc_rule(documents):
    rows = [(i, "t") for i in [*range(50), -3, 2 ** 60]]
    got = documents([*rows, (None, "t")]).select("doc_id", language.held_out(F.col("doc_id")).alias("h")).collect()
    for r in got:
        assert r["h"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)


def test_held_out_accuracy(spark, sf_dir):
    from rasmlens.llm.queries import op4_language_mixture
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text")
    got = op4_language_mixture(spark, "/root/testdata/sf0.01").join(truth, "doc_id").where(
        "held_out and lang is not null and lang_pred <> 'und'")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.95
