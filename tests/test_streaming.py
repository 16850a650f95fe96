import json
import os
from collections import Counter

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from rasmlens import operators as ops
from rasmlens import schema, sources, streaming

TEXT = "كتاب مدرسة قلم ورق معلم {}"
MACHINE = "نموذج بيانات شبكة تعلم خوارزمية دقة {}"


def rows(n):
    return [((MACHINE if i % 2 else TEXT).format("علم " * (i % 5)), i % 2) for i in range(n)]


@pytest.fixture(scope="module")
def fitted(spark, tmp_path_factory):
    df = spark.createDataFrame(rows(60), "text string, label int")
    prepared = ops.prepare(df)
    features = ops.fit_features(prepared)
    model = LogisticRegression(maxIter=30, regParam=0.01).fit(ops.vectorize(features, prepared))
    folder = tmp_path_factory.mktemp("models")
    return {
        "features": features, "model": model,
        "features_path": sources.save_fitted(features, str(folder / "features")),
        "model_path": sources.save_classifier(model, str(folder), "LogReg")}


def write_files(folder, records):
    os.makedirs(folder, exist_ok=True)
    start = len(os.listdir(folder))
    for i, record in enumerate(records, start):
        body = record if isinstance(record, str) else json.dumps(
            {"text": record[0], "label": record[1]}, ensure_ascii=False)
        with open(f"{folder}/abs_{i:03d}.json", "w", encoding="utf-8") as out:
            out.write(body)


def test_twenty_files_make_four_batches_equal_to_a_batch_job(spark, tmp_path, fitted):
    feed, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_files(feed, rows(20))
    result, accuracy = streaming.run_stream(
        spark, feed, out, str(tmp_path / "checkpoint"),
        fitted["features_path"], fitted["model_path"], interval=None)
    commits = [c for c in os.listdir(tmp_path / "checkpoint" / "commits") if c.isdigit()]
    assert len(commits) == 4
    batch = streaming.classify(
        spark.read.schema(schema.STREAM_IN).json(feed), fitted["features"], fitted["model"])
    assert Counter(map(tuple, result.collect())) == Counter(map(tuple, batch.collect()))
    assert result.schema == schema.STREAM_OUT
    assert result.count() == 20 and accuracy == pytest.approx(
        sum(r["label"] == r["prediction"] for r in batch.collect()) / 20)


def test_restart_continues_without_duplicates(spark, tmp_path, fitted):
    feed, out, checkpoint = (str(tmp_path / d) for d in ("in", "out", "checkpoint"))
    for _ in range(2):
        write_files(feed, rows(7))
        result, _ = streaming.run_stream(
            spark, feed, out, checkpoint, fitted["features_path"], fitted["model_path"],
            interval=None)
    assert result.count() == 14
    assert Counter(r["text"] for r in result.collect()) == Counter(t for t, _ in rows(7) * 2)


def test_uncommitted_files_do_not_count(spark, tmp_path, fitted):
    feed, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_files(feed, rows(3))
    streaming.run_stream(
        spark, feed, out, str(tmp_path / "checkpoint"),
        fitted["features_path"], fitted["model_path"], interval=None)
    with open(f"{out}/part-leftover.json", "w", encoding="utf-8") as stray:
        stray.write('{"text":"x","label":1,"prediction":0.0}\n')
    assert streaming.read_output(spark, out).count() == 3


def test_bad_rows_are_dropped(spark, tmp_path, fitted):
    feed = str(tmp_path / "in")
    write_files(feed, rows(2) + [(None, 1), ("قصير جدا", 0), "{not json"])
    result, _ = streaming.run_stream(
        spark, feed, str(tmp_path / "out"), str(tmp_path / "checkpoint"),
        fitted["features_path"], fitted["model_path"], interval=None)
    assert result.count() == 2


def test_bounded_run_with_a_processing_time_trigger(spark, tmp_path, fitted):
    feed, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_files(feed, rows(4))
    with pytest.raises(ValueError):
        streaming.run_stream(spark, feed, out, str(tmp_path / "c"),
                             fitted["features_path"], fitted["model_path"])
    result, _ = streaming.run_stream(
        spark, feed, out, str(tmp_path / "checkpoint"), fitted["features_path"],
        fitted["model_path"], interval="1 second", seconds=8)
    assert result.count() == 4 and not spark.streams.active


def test_console_sink(spark, tmp_path):
    feed = str(tmp_path / "in")
    write_files(feed, rows(2))
    query = streaming.write_console(streaming.read_stream(spark, feed), interval=None)
    assert query.awaitTermination(60) and query.exception() is None


def test_feed_holds_every_row(spark, tmp_path):
    df = spark.createDataFrame(rows(50), "text string, label int").withColumn("more", F.lit(1))
    path = streaming.write_feed(df.coalesce(2), str(tmp_path / "in"), rows_per_file=10)
    files = [f for f in os.listdir(path) if f.endswith(".json")]
    assert len(files) == 6 and sum(1 for f in files for _ in open(f"{path}/{f}")) == 50
    back = spark.read.schema(schema.STREAM_IN).json(path)
    assert Counter(map(tuple, back.collect())) == Counter(rows(50))


def test_rows_without_a_label_are_not_right(spark):
    rows = spark.createDataFrame([("a", None, 1.0), ("b", None, 0.0), ("c", 1, 1.0), ("d", 0, 1.0)], schema.STREAM_OUT)
    assert tuple(streaming.stream_accuracy(rows).first()) == (4, 0.25)


def test_accuracy_without_output(spark):
    empty = spark.createDataFrame([], schema.STREAM_OUT)
    assert tuple(streaming.stream_accuracy(empty).first()) == (0, 0.0)


def test_empty_feed(spark, tmp_path, fitted):
    feed = str(tmp_path / "in")
    os.makedirs(feed)
    got = streaming.run_stream(
        spark, feed, str(tmp_path / "out"), str(tmp_path / "checkpoint"),
        fitted["features_path"], fitted["model_path"], interval=None)
    assert got == (None, 0.0)
    assert streaming.evaluate_output(spark, str(tmp_path / "nowhere")) == (None, 0.0)


LISTED = ["قلم", "معلم", "شبكة", "علم"]


def banned(spark):
    return spark.createDataFrame([(w,) for w in LISTED], "word string")


def test_a_stream_with_a_table_of_stopwords_equals_a_batch_job(spark, tmp_path, fitted):
    feed, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_files(feed, rows(20) + rows(3) + [(None, 1), (" ".join(LISTED * 3), 0)])
    result, accuracy = streaming.run_stream(
        spark, feed, out, str(tmp_path / "checkpoint"), fitted["features_path"], fitted["model_path"],
        interval=None, stopwords=banned(spark))
    keyed = spark.read.schema(schema.STREAM_IN).json(feed).withColumn("id", F.monotonically_increasing_id())
    batch = streaming.classify(
        keyed, fitted["features"], fitted["model"], stopwords=banned(spark), keys=("id",))
    want = Counter(map(tuple, batch.collect()))
    assert 0 < sum(want.values()) < 23 and Counter(map(tuple, result.collect())) == want
    assert accuracy == pytest.approx(sum(n for (_, label, p), n in want.items() if label == p) / sum(want.values()))
    assert len(streaming.finished_batches(spark, out)) == 5


def test_a_batch_that_failed_halfway_is_written_once(spark, tmp_path):
    """The first run dies in its second batch, after some of its rows are written; a finished batch that was
    not committed is run again as well."""
    feed, out, checkpoint = (str(tmp_path / d) for d in ("in", "out", "checkpoint"))
    write_files(feed, rows(12))
    calls = []

    def each(batch):
        calls.append(1)
        if len(calls) == 2:
            folder = streaming.finished_batches(spark, out)[0].replace("batch=0", "batch=1")
            batch.limit(2).select("text", "label").write.json(folder)
            os.remove(folder.removeprefix("file:") + "/_SUCCESS")
            raise RuntimeError("lost")
        return batch.select("text", "label")

    def run():
        stream = streaming.read_stream(spark, feed)
        streaming.write_batches(stream, out, checkpoint, each, interval=None).awaitTermination()

    with pytest.raises(Exception, match="lost"):
        run()
    assert streaming.read_batches(spark, out, schema.STREAM_IN).count() == 5
    for crc in (f"{checkpoint}/commits/.0.crc", f"{checkpoint}/commits/0"):
        if os.path.exists(crc):
            os.remove(crc)
    run()
    result = streaming.read_batches(spark, out, schema.STREAM_IN)
    assert Counter(map(tuple, result.collect())) == Counter(rows(12))
    write_files(feed, rows(2))
    run()
    assert streaming.read_batches(spark, out, schema.STREAM_IN).count() == 14
    assert len(calls) == 5  # batch 0 was finished and is not made again


def test_a_new_checkpoint_is_a_new_query(spark, tmp_path):
    feed, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_files(feed, rows(3))
    for name in ("one", "two"):
        streaming.write_batches(streaming.read_stream(spark, feed), out, str(tmp_path / name),
                                lambda b: b.select("text", "label"), interval=None).awaitTermination()
    assert streaming.read_batches(spark, out, schema.STREAM_IN).count() == 6
    assert streaming.read_batches(spark, str(tmp_path / "none"), schema.STREAM_IN).count() == 0


def test_feature_names_reach_the_stream(spark, tmp_path):
    prepared = ops.prepare(spark.createDataFrame(rows(40), "text string, label int"), f023="syl", f046="nouns")
    features = ops.fit_features(prepared, f023="syl", f046="nouns")
    model = LogisticRegression(maxIter=5).fit(ops.vectorize(features, prepared))
    feed = str(tmp_path / "in")
    write_files(feed, rows(6))
    result, _ = streaming.run_stream(
        spark, feed, str(tmp_path / "out"), str(tmp_path / "checkpoint"),
        sources.save_fitted(features, str(tmp_path / "features")),
        sources.save_classifier(model, str(tmp_path), "LogReg"), interval=None, f023="syl", f046="nouns")
    assert result.count() == 6


def test_running_accuracy_after_each_batch_and_a_restart(spark, tmp_path, fitted):
    feed, out = str(tmp_path / "in"), str(tmp_path / "out")
    totals, tracked = str(tmp_path / "totals"), str(tmp_path / "tracked")
    assert tuple(streaming.running_accuracy(spark, totals).first()) == (0, 0.0)
    for step in range(4):
        write_files(feed, rows(5) + [(TEXT.format("x"), None)])
        output, _ = streaming.run_stream(
            spark, feed, out, str(tmp_path / "checkpoint"), fitted["features_path"], fitted["model_path"], interval=None)
        streaming.track_accuracy(spark, out, totals, tracked, interval=None, max_files_per_trigger=2).awaitTermination()
        assert tuple(streaming.running_accuracy(spark, totals).first()) == tuple(streaming.stream_accuracy(output).first())
        assert output.count() == 6 * (step + 1)


def test_number_of_batches_does_not_follow_the_files(spark, tmp_path, monkeypatch):
    from rasmlens import workspace
    from rasmlens.plans import streams
    feed, predictions = str(tmp_path / "feed"), str(tmp_path / "predictions")
    rows = spark.range(200).select(F.lit("نص").alias("text"), (F.col("id") % 2).cast("int").alias("label"))
    streaming.write_feed(rows.repartition(100), feed)
    files = sum(name.endswith(".json") for name in os.listdir(feed))
    a_batch = streams._files_a_batch(spark, feed, 2)
    assert files > 5 * streams.MOST_BATCHES and (a_batch - 1) * streams.MOST_BATCHES < files <= a_batch * streams.MOST_BATCHES
    assert [streams._files_a_batch(spark, feed, n) for n in (5, 50)] == [a_batch, 50]
    assert streams._files_a_batch(spark, str(tmp_path / "none"), 2) == 2
    rows.withColumn("prediction", F.lit(1.0)).repartition(100).write.json(predictions)
    monkeypatch.setattr(streams, "_predicted", lambda *_: predictions)
    monkeypatch.setattr(workspace, "fresh_dir", lambda _, name, make=workspace.fresh_dir: (
        str(tmp_path / name) if name == "tracked" else make(_, name)))
    assert tuple(streams.stream_running_accuracy(spark, "unused").first()) == (200, 0.5)
    assert len(streaming.finished_batches(spark, str(tmp_path / "tracked" / "totals"))) <= streams.MOST_BATCHES


def test_a_batch_is_held_with_its_tokens(spark, tmp_path, fitted, monkeypatch):
    held = []
    kept = streaming.flow.write_batches
    monkeypatch.setattr(streaming.flow, "write_batches", lambda rows, *a: held.append(rows.columns) or kept(rows, *a))
    feed = str(tmp_path / "in")
    write_files(feed, rows(6))
    streaming.run_stream(
        spark, feed, str(tmp_path / "out"), str(tmp_path / "checkpoint"), fitted["features_path"],
        fitted["model_path"], interval=None, stopwords=banned(spark))
    assert held == [["text", "label", "tokens"]]


def test_a_compressed_feed_is_served_whole_and_compressed(spark, tmp_path, fitted):
    feed, out, texts = str(tmp_path / "in"), str(tmp_path / "out"), rows(20) + [(None, 1), ("قصير جدا", None)]
    streaming.write_feed(spark.createDataFrame(texts, schema.STREAM_IN).coalesce(2), feed, 4, "lz4")
    assert len([name for name in os.listdir(feed) if name.endswith(".json.lz4")]) == 6
    result, _ = streaming.run_stream(
        spark, feed, out, str(tmp_path / "checkpoint"), fitted["features_path"], fitted["model_path"],
        interval=None, compression="lz4")
    batch = streaming.classify(spark.createDataFrame(texts, schema.STREAM_IN), fitted["features"], fitted["model"])
    assert Counter(map(tuple, result.collect())) == Counter(map(tuple, batch.collect()))
    assert {name.split(".", 1)[1] for name in os.listdir(out) if name.startswith("part-")} == {"json.lz4"}
