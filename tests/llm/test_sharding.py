import random
import zlib

from rasmlens.llm import sharding


def check(rows, got, shards, slack):
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted((r[0] is None, r[0] or 0) for r in rows)
    sizes, slots = [0] * shards, [[] for _ in range(shards)]
    for r in got:
        assert 0 <= r["shard"] < shards
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    for own in slots:
        assert sorted(own) == list(range(len(own)))
    assert max(sizes) - min(sizes) <= 2 * slack, (max(sizes), min(sizes), slack)


def test_equal_bytes_with_copies_and_repeats(documents):
    rng = random.Random(1)
    rows = [(i, "x" * rng.randint(0, 900)) for i in range(1500)]
    rows += [(5000 + i, "the same text") for i in range(900)] + [(7, "repeated row")] * 700 + [(None, None)] * 5
    got = sharding.shard(documents(rows), shards=8).collect()
    check(rows, got, 8, 916)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[5000]["size"] == 13 + 16 and by_id[5000]["text_crc32"] == zlib.crc32(b"the same text")
    assert by_id[None]["size"] == 16 and by_id[None]["text_crc32"] is None
    assert zlib.crc32("é".encode()) == sharding.shard(documents([(1, "é")]), 3).first()["text_crc32"]


def test_equal_texts_stay_together_unless_too_many(documents):
    rows = [(i, f"text {i // 4} " * 20) for i in range(800)]
    got = {r["doc_id"]: r["shard"] for r in sharding.shard(documents(rows), shards=5).collect()}
    apart = sum(len({got[4 * g + k] for k in range(4)}) > 1 for g in range(200))
    assert apart <= 4  # only at the four ends between shards


def test_more_rows_make_more_ranges(documents, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_RANGE", 7)
    rows = [(i, "x" * (i % 50)) for i in range(900)]
    check(rows, sharding.shard(documents(rows), shards=3).collect(), 3, 66)


def test_few_and_no_rows(documents):
    assert sharding.shard(documents([])).count() == 0
    assert sharding.shard(documents([(1, None)]), shards=40).count() == 1
    check([(1, "a"), (2, "b" * 200_000), (3, "c")], sharding.shard(
        documents([(1, "a"), (2, "b" * 200_000), (3, "c")]), shards=2).collect(), 2, 200_016)


def test_shards_can_be_written(spark, documents, tmp_path):
    docs = documents([(i, f"text {i}") for i in range(300)])
    placed = sharding.shard(docs, shards=4)
    back = spark.read.parquet(sharding.write_shards(docs, placed, str(tmp_path / "out")))
    assert back.count() == 300 and set(docs.columns) < set(back.columns)
