import glob
import math
import os
import random

import numpy as np
import pytest
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from rasmlens import operators as ops
from rasmlens import schema, sources, workspace
from rasmlens.plans import datasets


def test_melt(spark):
    wide = spark.createDataFrame(
        [("إنسان", "آلي", None), (None, " \n ", "نص"), ("", "b", "c")],
        "original_abstract string, allam_generated_abstract string, openai_generated_abstract string")
    got = sorted(map(tuple, ops.melt(wide, "train").collect()))
    assert got == sorted([
        ("إنسان", 0, "human", "train"), ("آلي", 1, "allam", "train"), ("نص", 1, "openai", "train"),
        ("b", 1, "allam", "train"), ("c", 1, "openai", "train")])
    with pytest.raises(ValueError):
        ops.melt(wide.select(F.lit(1).alias("x")), "train")


def test_csv_with_bom_newlines_and_quotes(spark, tmp_path):
    path = tmp_path / "arabic_abstracts_train.csv"
    path.write_text(
        'original_abstract,jais_generated_abstract\n"سطر\nسطر ""ثان""",\n"  x ",نص\n',
        encoding="utf-8-sig")
    df = sources.read_csv(spark, str(path))
    assert df.columns == ["original_abstract", "jais_generated_abstract"]
    assert [tuple(r) for r in df.collect()] == [('سطر\nسطر "ثان"', None), ("  x ", "نص")]
    long = ops.ingest(spark, {"train": str(path)})
    assert sorted(map(tuple, long.collect())) == [
        ("  x ", 0, "human", "train"), ('سطر\nسطر "ثان"', 0, "human", "train"),
        ("نص", 1, "jais", "train")]
    assert [(f.name, f.dataType) for f in long.schema] == [
        (f.name, f.dataType) for f in schema.CORPUS]


def test_cells_that_pandas_takes_as_missing(spark, tmp_path):
    path = tmp_path / "cells.csv"
    path.write_text('a,b\nNA,"null"\n" NA",nan text\n', encoding="utf-8")
    assert [tuple(r) for r in sources.read_csv(spark, str(path)).collect()] == [
        (None, None), (" NA", "nan text")]
    kept = sources.read_csv(spark, str(path), missing=("",)).collect()
    assert tuple(kept[0]) == ("NA", "null")


def test_csv_sink_keeps_existing_files(spark, tmp_path):
    first = spark.createDataFrame([(" a\r\nb ", 'q"q', "\\")], "x string, y string, z string")
    paths = sources.write_splits({"test": first}, str(tmp_path))
    assert paths == {"test": f"{tmp_path}/arabic_abstracts_test.csv"}
    sources.write_splits({"test": first.union(first)}, str(tmp_path))
    back = sources.read_csv(spark, paths["test"], ["x", "y", "z"]).collect()
    assert [tuple(r) for r in back] == [(" a\r\nb ", 'q"q', "\\")]


def test_parquet_sinks(spark, tmp_path):
    rows = [("t", "c", ["a", "b"], 2, i % 2, "m", "s") for i in range(10)]
    df = spark.createDataFrame(
        rows, "text string, clean_text_columns string, tokens array<string>, n_tokens int, "
              "label int, model string, source string").withColumn("extra", F.lit(1))
    plain = sources.write_parquet(df, str(tmp_path / "plain"))
    sources.write_parquet(df, plain)
    back = sources.read_parquet(spark, plain)
    assert tuple(back.columns) == schema.STORED_COLUMNS and back.count() == 10
    parts = sources.write_parquet_by(df, str(tmp_path / "by_label"), "label")
    assert sorted(d for d in os.listdir(parts) if "=" in d) == ["label=0", "label=1"]
    assert sources.read_parquet(spark, parts).where("label = 1").count() == 5


def test_stored_table_is_pruned_and_filtered_at_the_scan(spark, tmp_path, plan_of):
    path = str(tmp_path / "stored")
    spark.range(10).select(
        F.col("id").alias("n_tokens"), F.lit("x").alias("text"), F.lit(1).alias("label")
    ).write.parquet(path)
    plan = plan_of(ops.label_counts(spark.read.parquet(path).where("n_tokens > 5")))
    assert "GreaterThan(n_tokens,5)" in plan
    assert "ReadSchema: struct<n_tokens:bigint,label:int>" in plan


def test_spread_leaves_wide_inputs_alone(spark):
    narrow, wide = spark.range(100, numPartitions=1), spark.range(100, numPartitions=64)
    assert sources.spread(wide) is wide
    assert sources.spread(narrow).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_workspace_uses_the_configured_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert workspace.shared_dir(spark) == folder
    a, b = workspace.fresh_dir(spark, "x"), workspace.fresh_dir(spark, "x")
    assert a != b and a.startswith(folder) and not glob.glob(a)


def test_workspace_is_cleared_for_this_application_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workspace, "shared_dir", lambda _: str(tmp_path))
    foreign = tmp_path / "rasmlens" / "other" / "table"
    foreign.mkdir(parents=True)
    spark.range(3).write.parquet(workspace.fresh_dir(spark, "x"))
    assert len(list((tmp_path / "rasmlens").iterdir())) == 2
    workspace.clear(spark)
    assert list((tmp_path / "rasmlens").iterdir()) == [foreign.parent]


def test_workspace_without_a_configured_folder():
    class Session:
        class sparkContext:
            folder = None

            @classmethod
            def getCheckpointDir(cls):
                return cls.folder

        conf = {"spark.sql.warehouse.dir": "shared:/warehouse/"}

    assert workspace.shared_dir(Session) == "shared:/warehouse/_work"
    Session.sparkContext.folder = "shared:/checkpoints/"
    assert workspace.shared_dir(Session) == "shared:/checkpoints"


def test_csv_files_are_read_by_their_own_headers(spark, tmp_path):
    human, ai = "original_abstract", "jais_generated_abstract"
    for name, columns, rows in (("a", (human, ai), [("h1", "a1"), ("h2", "a2")]), ("b", (ai, human), [("a3", "h3")]),
                                ("c", (human,), [("h4",)]), ("d", (human, ai), [])):
        spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns)).coalesce(1).write.option(
            "header", True).csv(f"{tmp_path}/{name}")
    long = ops.ingest(spark, {"train": f"{tmp_path}/*"}).select("text", "label", "model").collect()
    assert sorted(map(tuple, long)) == sorted(
        [(f"h{i}", 0, "human") for i in (1, 2, 3, 4)] + [(f"a{i}", 1, "jais") for i in (1, 2, 3)])


def test_half_written_csv_is_written_again(spark, tmp_path):
    df = spark.createDataFrame([("x",), ("y",)], "text string")
    path = sources.write_csv(df, str(tmp_path / "out"))
    (tmp_path / "out" / "_SUCCESS").unlink()
    sources.write_csv(df.union(df), path)
    assert sources.read_csv(spark, path).count() == 4
    sources.write_csv(df, path)
    assert sources.read_csv(spark, path).count() == 4


def test_counts_and_composition(spark):
    df = spark.createDataFrame([(0,), (1,), (1,)], "label int")
    assert ops.row_count(df).first()["n"] == 3
    assert {r["label"]: r["n"] for r in ops.label_counts(df).collect()} == {0: 1, 1: 2}
    assert {tuple(r) for r in ops.class_composition(df).collect()} == {(0, 1, 33.3), (1, 2, 66.7)}


def test_top_tokens_break_ties_by_word(spark):
    df = spark.createDataFrame([(["b", "a", "c"],), (["c"],), ([],)], "tokens array<string>")
    assert [tuple(r) for r in ops.top_tokens(df, 2).collect()] == [("c", 2), ("a", 1)]


def test_distribution_ignores_nulls(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 3.0), (0, None), (1, None)], "label int, v double")
    assert [tuple(r) for r in ops.distribution_by_class(df, "v").collect()] == [(0, 2, 2.0, 1.0, 3.0)]


def test_correlation_matrix(spark):
    rng = random.Random(3)
    rows = [(rng.random(), rng.random(), 5.0) for _ in range(50)]
    got = {(r["a"], r["b"]): r["r"] for r in ops.correlation_matrix(
        spark.createDataFrame(rows, "x double, y double, z double"), ["x", "y", "z"]).collect()}
    expected = np.corrcoef([r[0] for r in rows], [r[1] for r in rows])[0, 1]
    assert got["x", "y"] == got["y", "x"] == pytest.approx(expected)
    assert got["x", "x"] == 1.0 and len(got) == 9
    assert got["z", "z"] is None and got["x", "z"] is None


def numpy_density(values, points=200):
    values = np.array(values, dtype=float)
    bw = 1.06 * values.std() * len(values) ** (-1 / 5) or 1.0
    xs = np.linspace(values.min(), values.max(), points)
    ys = np.exp(-0.5 * ((xs[:, None] - values[None, :]) / bw) ** 2).sum(axis=1)
    return xs, ys / (len(values) * bw * math.sqrt(2 * math.pi))


@pytest.mark.parametrize("values", [
    [4.0, 4.0, 4.0],
    [1.0, 2.0],
    [float(i % 17) for i in range(400)],
    # A narrow kernel: most grid points are beyond the reach of most values.
    [float(i % 3) for i in range(900)] + [5000.0],
    [math.sin(i) for i in range(300)],
])
def test_density_equals_brute_force(spark, values):
    other = [(1, 1.0), (2, 3.0), (2, 4.0), (None, 1.0), (None, 2.0)]
    rows = [(0, v) for v in values] + other + [(0, None), (0, math.nan)]
    df = spark.createDataFrame(rows, "label int, v double").repartition(5)
    got = ops.kernel_density(df, "v").orderBy("i").collect()
    xs, ys = numpy_density(values)
    assert {r["label"] for r in got} == {0, 2} and len(got) == 400  # every label with two values
    got = [r for r in got if r["label"] == 0]
    np.testing.assert_allclose([r["x"] for r in got], xs, rtol=1e-12, atol=1e-12)
    np.testing.assert_allclose([r["density"] for r in got], ys, rtol=1e-9, atol=1e-15)


def test_density_of_nothing(spark):
    assert ops.kernel_density(spark.createDataFrame([], "label int, v double"), "v").count() == 0


def corpus_rows():
    rng = random.Random(11)
    return [(i, ["hot"] * rng.randrange(1, 4) + [f"w{rng.randrange(40)}" for _ in range(6)])
            for i in range(60)] + [(99, [])]


def test_tfidf_reads_the_tokens_at_most_twice(spark, tmp_path, plan_of):
    path = str(tmp_path / "tokens")
    spark.createDataFrame(corpus_rows(), "id int, tokens array<string>").write.parquet(path)
    plan = plan_of(ops.tfidf(spark.read.parquet(path), "id"))
    assert plan.count("Generate") == 0  # counted once, before, and stored
    assert plan.count("FileScan") - plan.count("ReusedExchange") <= 4
    assert plan.count("tokens:array") == 0


def test_tfidf_equals_brute_force(spark):
    rows = corpus_rows()
    df = spark.createDataFrame(rows, "id int, tokens array<string>")
    got = {(r["id"], r["w"]): (r["tf"], r["tfidf"])
           for r in ops.tfidf(df, "id").collect()}
    frequency = {}
    for _, tokens in rows:
        for w in set(tokens):
            frequency[w] = frequency.get(w, 0) + 1
    idf = {w: math.log((len(rows) + 1) / (n + 1)) for w, n in frequency.items()}
    expected = {(i, w): (ts.count(w), ts.count(w) * idf[w]) for i, ts in rows for w in set(ts)}
    assert got.keys() == expected.keys()
    for pair, (tf, weight) in expected.items():
        assert got[pair][0] == tf and got[pair][1] == pytest.approx(weight)


def test_term_counts_shuffle_nothing(spark, plan_of):
    df = spark.createDataFrame(corpus_rows(), "id int, tokens array<string>")
    assert "Exchange" not in plan_of(ops.term_counts(df, "id"))


def test_scaling_equals_the_mllib_scaler(spark):
    df = spark.createDataFrame([(float(i), 2.0) for i in range(9)], "a double, b double")
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="v").transform(df)
    scaler = StandardScaler(inputCol="v", outputCol="s").fit(vectors)
    expected = [r[0] for r in scaler.transform(vectors).select(vector_to_array("s")).collect()]
    got = ops.scale_by_deviation(df, ["a", "b"]).select("a_scaled", "b_scaled").collect()
    np.testing.assert_allclose([list(r) for r in got], expected)


def test_hash_split_is_complete_disjoint_and_repeatable(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    parts = [sorted(r["k"] for r in p.collect()) for p in ops.hash_split(df, "k")]
    assert sorted(sum(parts, [])) == list(range(2000))
    again = [sorted(r["k"] for r in p.collect()) for p in ops.hash_split(df.repartition(7), "k")]
    assert parts == again
    assert [len(p) / 2000 for p in parts] == pytest.approx([0.7, 0.15, 0.15], abs=0.03)


def test_random_splits_are_complete_and_disjoint(spark):
    df = spark.range(3000)
    for parts in (ops.random_split(df), ops.random_split_two_stage(df, (0.6, 0.1, 0.3))):
        ids = [sorted(r["id"] for r in p.collect()) for p in parts]
        assert sorted(sum(ids, [])) == list(range(3000))
    assert [len(p) / 3000 for p in ids] == pytest.approx([0.6, 0.1, 0.3], abs=0.04)


@pytest.mark.parametrize("ratios", [(0.7, 0.2, 0.2), (1.0, 0.0, 0.0), ()])
def test_ratios_are_checked(spark, ratios):
    with pytest.raises(ValueError):
        ops.random_split(spark.range(1), ratios)


def test_samples(spark):
    df = spark.range(4000)
    kept = [r["id"] for r in ops.hash_sample(df, "id", 0.25).collect()]
    assert len(kept) / 4000 == pytest.approx(0.25, abs=0.03)
    assert ops.hash_sample(df, "id", 1.0).count() == 4000
    assert ops.bernoulli_sample(df, 0.25, 9).count() / 4000 == pytest.approx(0.25, abs=0.04)
    assert ops.sample_limit(df, 0.5, 20, seed=9).count() == 20
    limited = [r["id"] for r in ops.sample_limit(df, 0.25, 5, seed=0, key="id").collect()]
    assert limited == sorted(kept)[:5]
    with pytest.raises(ValueError):
        ops.hash_sample(df, "id", 1.5)


def own_tables(spark, folder, n=60):
    docs = [(i, " ".join(f"the{chr(97 + i % 7)}ab word{j % 5}xy" for j in range(9)), "en", "s", 1) for i in range(n)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{folder}/documents.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(0, n, 2)], "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet")
    return str(folder)


def test_labelled_rows_are_prepared_alone(spark, tmp_path):
    at = own_tables(spark, tmp_path)
    alone = datasets.prepared_labelled(spark, at)
    assert not datasets.stands(spark, at, "prepared")
    assert spark.read.parquet(datasets.once(spark, at, "prepared_labelled", lambda: None)).count() == 30
    whole = datasets.prepared(spark, at)
    assert whole.count() == 60
    from_whole = datasets.prepared_labelled(spark, at)
    assert sorted(map(tuple, alone.collect())) == sorted(map(tuple, from_whole.collect()))


def test_files_of_vectors_hold_few_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(datasets, "VECTOR_FILE_ROWS", 4)
    vectors = datasets.Lab(spark, own_tables(spark, tmp_path)).vectors
    sizes = [r["count"] for r in vectors.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 30 and max(sizes) <= 4
