import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasmlens.llm.packing import binary_lengths, encoder, in_buckets, pack, write_buckets

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def full():
    import public_tokenizers
    return tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(full, text):
    return full.encode(text or "", add_special_tokens=False).ids


def texts():
    rng = random.Random(5)
    alphabet = list("ab cDé ñ  \n\t\r .,!?'0123456789_-<|>") + [
        "'ll", "’s", " ", "\x85", "\x1c", "中文", "🙂", "ß", "٣", "​", "é", "　"]
    for _ in range(400):
        yield "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
    yield from ["a<|endoftext|>b", " leading", "trailing  ", "x" * 5000, " ", "\n\n\n", "a  b   c\n d \n  e", "don't 'S"]


def test_encoder_is_the_full_tokenizer(full):
    fast = encoder("byte_bpe_50k")
    for text in texts():
        assert np.frombuffer(fast(text), "<u4").tolist() == ids_of(full, text), repr(text)


def test_a_text_is_encoded_in_one_call(full, monkeypatch):
    fast, calls = encoder("byte_bpe_50k"), []
    plain = fast.plain
    monkeypatch.setattr(fast, "plain", lambda text, **options: calls.append(text) or plain(text, **options))
    text = " ".join(f"word{i}, other" for i in range(500))
    assert np.frombuffer(fast(text), "<u4").tolist() == ids_of(full, text)
    assert calls == [text]


def test_binary_lengths():
    for n in range(1, 5000):
        parts = binary_lengths(n, 1024)
        assert sum(parts) == n and parts == sorted(parts, reverse=True)
        assert all(p & (p - 1) == 0 and p <= 1024 for p in parts)
        assert len({p for p in parts if p < 1024}) == len([p for p in parts if p < 1024])


def test_pieces_put_together_are_the_documents(documents, full):
    rows = [(1, "Some words here."), (2, None), (3, ""), (None, "no id"), (4, "same"), (4, "same"),
            (5, "long text " * 2000)]
    pieces = pack(documents(rows)).collect()
    assert len({p["sequence_id"] for p in pieces}) == len(pieces)
    whole = {}
    for p in sorted(pieces, key=lambda p: p["start"]):
        ids = np.frombuffer(p["tokens"], "<u4").tolist()
        assert len(ids) == p["length"] and p["offset"] == 0
        whole.setdefault(p["doc_id"], []).append((p["start"], ids))
    assert sum(map(len, (ids for _, ids in whole[5]))) == len(ids_of(full, rows[-1][1])) + 1
    for id, text in ((1, rows[0][1]), (2, ""), (3, ""), (None, "no id"), (5, rows[-1][1])):
        got = [i for _, ids in whole[id] for i in ids]
        assert got == [*ids_of(full, text), 0]
        starts = [s for s, _ in whole[id]]
        assert starts == np.cumsum([0, *[len(i) for _, i in whole[id]]])[:-1].tolist()
    assert len(whole[4]) == 2 * len(binary_lengths(len(ids_of(full, "same")) + 1, 1024))


def test_crc_and_buckets(spark, documents, tmp_path):
    pieces = pack(documents([(1, "abc def " * 300)]), max_length=64)
    for p in pieces.withColumn("crc", F.crc32("tokens")).collect():
        assert p["crc"] == zlib.crc32(p["tokens"])
    path = write_buckets(pieces, str(tmp_path / "buckets"))
    back = spark.read.parquet(path)
    assert back.count() == pieces.count()
    assert all(r["length"] * 4 == r["bytes"] for r in back.select("length", F.octet_length("tokens").alias("bytes")).collect())


def test_empty_table_and_wrong_length(documents):
    assert pack(documents([])).count() == 0
    with pytest.raises(ValueError):
        pack(documents([]), max_length=1000)


def test_places_in_buckets(documents):
    rows = [(i, "some words " * (i % 7) * (i % 5) * 40, "en", "a") for i in range(90)] + [(None, None), (3, "x"), (3, "x")]
    pieces = pack(documents(rows).repartition(4))
    placed = in_buckets(pieces).collect()
    assert len(placed) == pieces.count()
    of = {}
    for p in placed:
        assert 1 << p["bucket"] == p["length"]
        of.setdefault(p["bucket"], []).append(p["place"])
    assert len(of) > 5
    for places in of.values():
        assert sorted(places) == list(range(len(places)))
    whole = lambda rs: sorted((p["sequence_id"], p["start"], p["length"], bytes(p["tokens"])) for p in rs)
    assert whole(placed) == whole(pieces.collect())
    assert in_buckets(pack(documents([]))).collect() == []
