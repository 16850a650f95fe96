import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasmlens.llm import urls
from rasmlens.llm.frames import stored
from rasmlens.llm.queries import URL_RULES


def plain(url, listed):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host):])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.prefix)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    verdict = best.verdict if best else ("block" if host + path in listed else "allow")
    return host, path, best.name if best else None, verdict


URLS = ["http://A.Example.NET/en/x?y#z", "http://example.net/de", "https://example.com/de/1", "http://x.example.com/deX",
        "ftp://a.org/fr/", "http://a.org/fr", "HTTP://É.ORG/fr/é", "no scheme", None, "", "http://", "http://h?x://y/z",
        "http://h#f", "http://net", "http://net/", "http://xnet/", "http://a://b/c", "http://h/a\nb?c", "x://" + "h" * 50_000]


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, host int, key string, listed string, h1 int")


def test_against_plain(spark):
    every = URLS + [f"http://s{i % 7}.example.org/p/{i % 300}" for i in range(900)]
    rows = [(i if i % 5 else None, u, "h", 1, "k", "l", 2) for i, u in enumerate(every)]
    listed = {"s1.example.org/p/1", "s2.example.org/p/2", "", "h", "not in the corpus", "h/a\nb"}
    listed_df = spark.createDataFrame([(k,) for k in [*listed, None]], "key string")
    got = urls.judge_urls(pages(spark, rows), URL_RULES, listed_df).collect()
    key = lambda r: tuple((v is None, str(v)) for v in r)
    want = [(r[0], *plain(r[1], listed)) for r in rows]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("share", [0.0, 0.001, 0.3, 0.9, 1.0])
def test_cascade_is_exact_over_its_universe(spark, share):
    """Many shards, broadcast or dealt out with their rows, of which one key has a third."""
    keys = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"), "id")
    listed = keys.where(F.col("id") < 5000 * share)
    cascade = urls.Cascade.build(listed, keys.unionByName(keys), keys_per_shard=300)
    assert cascade.shards > 10
    hot = keys.unionByName(keys.where("id = 7").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(2500)))).drop("n"))
    hot = hot.unionByName(spark.createDataFrame([(None, -1)] * 3, "key string, id long"))
    for cascade.broadcast_bytes in (1500, 0, 1 << 20):
        marked = stored(cascade.mark(hot, "key", "found"), "marked")
        assert marked.columns == ["key", "id", "found"] and marked.count() == 7503
        assert marked.where(F.col("found") != F.coalesce(
            F.col("key").isNotNull() & (F.col("id") < 5000 * share), F.lit(False))).count() == 0


def test_levels_survive_storing():
    rng = np.random.default_rng(3)
    h1, h2 = rng.integers(0, 1 << 63, (2, 20_000)).astype("u8")
    listed = rng.random(20_000) < 0.1
    levels = urls.unpack_levels(urls.pack_levels(urls.build_levels(h1, h2, listed)))
    assert (urls.walk(levels, h1, h2) == listed).all()
    assert sum(lv.bits for lv in levels) < 20 * listed.sum()


def test_empty(spark):
    none = pages(spark, [])
    assert urls.judge_urls(none, URL_RULES, none.select("key")).count() == 0
    some = pages(spark, [(1, "http://a.b/c", "h", 1, "k", "l", 2)])
    assert urls.judge_urls(some, URL_RULES, none.select("key")).first()["verdict"] == "allow"
