"""Percentiles, areas, vocabulary taggers, certificates, importance."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from rasmlens import operators as ops
from rasmlens import sources, workspace


def test_percentiles_against_numpy(spark):
    rng = random.Random(1)
    groups = {0: [rng.lognormvariate(0, 1) for _ in range(3000)], 1: [float(rng.randint(0, 5)) for _ in range(2000)],
              2: [7.0], 3: [1.0, 2.0], 4: [0.5] * 500 + [9.5]}
    rows = [(label, v) for label, values in groups.items() for v in values]
    rows += [(0, None), (0, math.nan), (None, 1.0)]
    df = spark.createDataFrame(rows, "label int, v double").repartition(5)
    shares = (0.0, 0.01, 0.25, 0.5, 0.9, 1.0)
    for accuracy in (20, 10_000):  # wide brackets and narrow ones
        got = {(r.label, r.p): r.value for r in ops.percentiles_by_class(df, "v", shares, accuracy).collect()}
        assert len(got) == len(groups) * len(shares)
        for label, values in groups.items():
            for p in shares:
                assert got[label, p] == pytest.approx(np.quantile(values, p), abs=1e-12), (label, p)


def test_percentiles_of_nothing(spark):
    assert ops.percentiles_by_class(spark.createDataFrame([], "label int, v double"), "v").collect() == []


def plain_auc(rows):
    positive = [s for s, y in rows if y == 1]
    negative = [s for s, y in rows if y != 1]
    if not positive or not negative:
        return None
    wins = sum((a > b) + (a == b) / 2 for a in positive for b in negative)
    return wins / len(positive) / len(negative)


def test_areas_against_pairs(spark):
    rng = random.Random(2)
    models = {"ties": [(float(rng.randint(0, 4)), rng.randint(0, 1)) for _ in range(300)],
              "fine": [(rng.gauss(y, 1), y) for y in [rng.randint(0, 1) for _ in range(400)]],
              "equal": [(0.5, i % 2) for i in range(20)], "one class": [(rng.random(), 1) for _ in range(10)],
              None: [(rng.random(), rng.randint(0, 1)) for _ in range(50)]}
    rows = [(m, s, y) for m, pairs in models.items() for s, y in pairs] + [("ties", None, 1), ("ties", 1.0, None)]
    df = spark.createDataFrame(rows, "model string, score double, label int").repartition(6)
    got = {r.model: r for r in ops.auc_by_model(df).collect()}
    assert got.keys() == models.keys()
    for name, pairs in models.items():
        want = plain_auc(pairs)
        assert got[name].n == len(pairs) and got[name].positives == sum(y for _, y in pairs)
        assert got[name].auc == (want if want is None else pytest.approx(want, abs=1e-12))
    assert ops.auc_by_model(df.limit(0)).collect() == []


def test_tagger_counts_every_occurrence(spark):
    def load_tagger():
        with_e = {}
        return lambda words: [with_e.setdefault(w, "e" in w) or None for w in words]

    rng = random.Random(3)
    words = ["the", "one", "xx", "yy", "e", "ö", ""]
    rows = [(i, [rng.choice(words) for _ in range(rng.randint(0, 40))], "own") for i in range(80)] + [(900, [], "own"), (901, None, "own")]
    df = spark.createDataFrame(rows, "id int, tokens array<string>, verdict string")
    got = ops.count_by_vocabulary(df, load_tagger, "id", "hits", "tokens")
    assert got.columns == ["id", "tokens", "verdict", "hits"]
    assert {r.id: r.hits for r in got.collect()} == {i: sum("e" in w for w in t or ()) for i, t, _ in rows}
    tagged = ops.tag_vocabulary(df.select(F.explode("tokens").alias("word")), load_tagger).collect()
    assert len(tagged) == len({w for _, t, _ in rows for w in t or ()})


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(300):
        y = int(rng.random() < 0.4)
        x = rng.normal(0.8 * y, 1.0, 6) * np.array([1, 5, 0.1, 1, 1, 1])
        x[5] = 3.0  # constant
        rows.append((y, Vectors.sparse(6, [j for j in range(6)], x) if i % 2 else Vectors.dense(x)))
    return spark.createDataFrame(rows, ["label", "features"]).cache()


@pytest.mark.parametrize("reg", [0.01, 0.3])
def test_certificates_bound_the_distance_to_the_best_fit(points, reg):
    best = LogisticRegression(maxIter=500, tol=1e-12, regParam=reg).fit(points)
    tight = ops.duality_gap(best, points, reg).first()
    assert 0 <= tight.gap < 1e-6 and tight.dual <= tight.primal
    early = LogisticRegression(maxIter=2, regParam=reg).fit(points)
    loose = ops.duality_gap(early, points, reg).first()
    assert loose.gap >= loose.primal - tight.primal - 1e-9
    assert loose.dual <= tight.primal + 1e-9
    deviations = np.array([np.std([r.features.toArray()[j] for r in points.collect()], ddof=1) for j in range(6)])
    apart = np.linalg.norm((early.coefficients.toArray() - best.coefficients.toArray()) * deviations)
    assert apart <= loose.distance + 1e-6


def test_hinge_certificate(points):
    best = LinearSVC(maxIter=500, tol=1e-10, regParam=0.05).fit(points)
    early = LinearSVC(maxIter=1, regParam=0.05).fit(points)
    tight, loose = (ops.duality_gap(m, points, 0.05, hinge=True).first() for m in (best, early))
    assert 0 <= tight.gap < 0.02 and tight.dual <= tight.primal
    assert loose.primal >= tight.primal >= max(tight.dual, loose.dual)


def test_importance_follows_from_the_stored_trees(spark, points):
    model = RandomForestClassifier(numTrees=9, maxDepth=4, seed=3).fit(points)
    path = sources.save_classifier(model, workspace.fresh_dir(spark, "forest"), "RandomForest")
    nodes = ops.forest_nodes(spark, path)
    got = {r.feature: r.importance for r in ops.importance_by_hand(nodes, model.numFeatures).collect()}
    assert [got[i] for i in range(6)] == pytest.approx(list(model.featureImportances.toArray()), abs=1e-12)
    gains = ops.split_gains(nodes)
    assert gains.where("not adds_up or gain < -1e-9").count() == 0
    assert gains.count() == nodes.where("left >= 0").count() > 0


def test_votes_follow_from_the_stored_trees(spark, points, plan_of):
    model = RandomForestClassifier(numTrees=9, maxDepth=4, seed=3).fit(points)
    path = sources.save_classifier(model, workspace.fresh_dir(spark, "forest"), "RandomForest")
    first = points.first().features.toArray()
    sparse = [(1, Vectors.sparse(6, [1, 4], [float(first[1]), float(first[4])])), (1, Vectors.sparse(6, [], []))]
    rows = points.select("label", "features").unionByName(
        spark.createDataFrame([*sparse, (None, Vectors.dense(first))], points.schema))
    votes = ops.forest_votes(model.transform(rows), ops.forest_nodes(spark, path), 6, "label", "rawPrediction")
    assert "Join" not in plan_of(votes) and "Exchange" not in plan_of(votes)
    got = votes.collect()
    assert len(got) == rows.count() and sum(r.label is None for r in got) == 1
    assert all(r.votes == r.rawPrediction.toArray().tolist() for r in got)


def test_spoiled_statistics_are_found(spark):
    rows = [(0, 0, 1, 2, 3, [6.0, 4.0]), (0, 1, -1, -1, -1, [5.0, 1.0]), (0, 2, -1, -1, -1, [1.0, 2.0])]
    nodes = spark.createDataFrame(rows, "tree int, node int, left int, right int, feature int, stats array<double>")
    assert [r.adds_up for r in ops.split_gains(nodes).collect()] == [False]


def test_first_lines_of_files(spark, tmp_path):
    import gzip
    (tmp_path / "a.csv").write_bytes("﻿name,x\r\n1,2\r\n".encode())
    (tmp_path / "b c.csv").write_bytes(b"x,name\n3,4\n")
    (tmp_path / "empty.csv").write_bytes(b"")
    with gzip.open(tmp_path / "d.csv.gz", "wb") as out:
        out.write(b"name,x\n5,6\n")
    read = lambda name: workspace.first_line(spark, str(tmp_path / name))
    assert read("a.csv") == "﻿name,x" and read("b c.csv") == "x,name" and read("empty.csv") == ""
    assert read("d.csv.gz") == "name,x"
    back = sources.read_csv(spark, str(tmp_path))
    assert {tuple(r) for r in back.select("name", "x").collect()} == {("1", "2"), ("4", "3"), ("5", "6")}


def test_word_list_file(spark, tmp_path):
    from dataclasses import replace

    from rasmlens.functions import DEFAULT
    (tmp_path / "words.txt").write_text("\ufeffمن\n  إلى \n\n# note\nعلى # twice\nمن\r\n", encoding="utf-8")
    words = lambda profile: {r.word for r in sources.read_words(spark, str(tmp_path / "words.txt"), profile).collect()}
    assert words(DEFAULT) == {"من", "إلى", "على"}
    assert words(replace(DEFAULT, normalize_lexicon=True)) == {"من", "الى", "على"}
    banned = sources.read_words(spark, str(tmp_path / "words.txt"))
    rows = spark.createDataFrame([(1, "من البيت على كتاب مدرسة قلم ورق")], "id int, text string")
    assert ops.prepare(rows, stopwords=banned, keys=("id",)).first()["tokens"] == ["البيت", "كتاب", "مدرسة", "قلم", "ورق"]
