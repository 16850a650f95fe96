from collections import Counter

import pytest

import corpus_pipeline
from rasmlens.llm import simhash
from rasmlens.llm.frames import stored
from test_lines import plain as plain_lines

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def outputs(spark, sf_dir):
    """What each stage was given and what it returned."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        result = stored(stage(spark, docs, sf_dir), name)
        out[name] = (docs, result)
        docs = result
    return out


def rows(df):
    return [tuple(r) for r in df.select(*COLUMNS).collect()]


def test_stages_keep_the_columns_of_documents(outputs):
    assert list(outputs) == ["language", "lines", "near_duplicates", "mixture", "packing"]
    for name, (_, result) in outputs.items():
        assert name == "packing" or result.columns == COLUMNS


def test_language_stage_drops_what_has_no_letters(outputs):
    given, kept = map(rows, outputs["language"])
    assert set(kept) <= set(given)
    gone = set(given) - set(kept)
    assert len(gone) <= 0.05 * len(given)
    assert not [r for r in kept if not any(c.isalpha() for c in r[1] or "")]


def test_lines_stage_against_plain(outputs):
    given, cleaned = map(rows, outputs["lines"])
    want = plain_lines([(i, text, lang, site) for i, text, lang, site, _ in given], corpus_pipeline.MIN_SITES)
    assert sorted((i, text) for i, text, *_ in cleaned) == sorted((i, text) for i, text, *_ in want)
    assert all(n == len(text) for _, text, _, _, n in cleaned)


def test_near_duplicates_stage_against_all_pairs(outputs):
    given, kept = map(rows, outputs["near_duplicates"])
    assert set(kept) <= set(given)
    given.sort()
    prints = [simhash.fingerprint(r[1]) for r in given]
    first = list(range(len(given)))

    def top(i):
        while first[i] != i:
            i = first[i]
        return i

    for i in range(len(given)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 4:
                a, b = sorted((top(i), top(j)))
                first[b] = a
    assert sorted(r[0] for r in kept) == sorted({given[top(i)][0] for i in range(len(given))})


def test_mixture_stage_reads_whole_documents_up_to_its_budget(outputs):
    given, chosen = map(rows, outputs["mixture"])
    times = Counter(chosen)
    assert set(times) <= set(given) and max(times.values()) <= corpus_pipeline.MIX_EPOCHS + 1
    words = lambda rs: sum(len((r[1] or "").encode().split()) for r in rs)
    longest = max(words([r]) for r in given)
    leaves = len({(r[2], r[3]) for r in given})
    budget = int(words(given) * corpus_pipeline.MIX_SHARE)
    assert budget - leaves <= words(chosen) <= budget + leaves * longest


def test_packing_stage_holds_every_document(outputs):
    given, pieces = outputs["packing"]
    ends = Counter(r["doc_id"] for r in pieces.collect() if r["start"] + r["length"] == r["doc_tokens"])
    assert ends == Counter(r["doc_id"] for r in given.collect())
    assert all(r["length"] == 1 << r["bucket"] <= 1024 for r in pieces.collect())
    places = Counter((r["bucket"], r["place"]) for r in pieces.collect())
    sizes = Counter(bucket for bucket, _ in places)
    assert set(places.values()) == {1} and all(place < sizes[bucket] for bucket, place in places)


def test_run_applies_all_stages(spark, sf_dir, outputs):
    digest = lambda df: Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in df.collect())
    assert digest(corpus_pipeline.run(spark, sf_dir)) == digest(outputs["packing"][1])


CLASHING = ["Score", "lang_pred", "Languages", "copies", "_copy", "row", "id", "key", "n", "tokens", "fp", "h1",
            "name", "kept", "nth", "level0", "cut", "Bucket", "text_of"]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows, with columns named like what the stages add, in another case too."""
    body = "the words of this document are quite ordinary and the sentence goes on for a while "
    said = [(1, None, None, None), (2, "", "en", "a"), (None, body + "x", "en", "a"), (None, body + "x", "en", "a"),
            (3, body * 2 + "one", "en", None), (3, body * 2 + "one", "en", None), (3, "other text of the same id", "en", "b"),
            (4, (body + "so ") * 13_000, "en", "a"), (5, "12345 !!", "en", "a"), (6, "plain text on its own here", None, "c")]
    columns = ", ".join(f"`{c}` string" for c in CLASHING)
    data = [(*row, len(row[1] or ""), *[f"own {c}" for c in CLASHING]) for row in said]
    schema = f"doc_id long, text string, lang string, source string, n_chars int, {columns}"
    return spark.createDataFrame(data, schema)


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_rows(spark, sf_dir, odd, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    result = stage(spark, odd, sf_dir)
    got = result.collect()
    assert stage(spark, odd.limit(0), sf_dir).collect() == []
    if name == "packing":
        ends = Counter(r["doc_id"] for r in got if r["start"] + r["length"] == r["doc_tokens"])
        assert ends == Counter(r["doc_id"] for r in odd.collect())
        return
    assert result.columns == odd.columns
    at = odd.columns.index("n_chars") + 1
    assert all(tuple(r)[at:] == tuple(f"own {c}" for c in CLASHING) for r in got)
    texts = Counter((r["doc_id"], r["text"] and r["text"][:100]) for r in got)
    given = Counter((r["doc_id"], r["text"] and r["text"][:100]) for r in odd.collect())
    if name == "language":
        assert texts.keys() == {k for k in given if k[1] and not k[1].startswith("1")}
        assert all(texts[k] == given[k] for k in texts)
    elif name == "lines":
        assert texts == given
    elif name == "near_duplicates":
        assert all(n == 1 for n in texts.values()) and (1, None) in texts and (2, "") not in texts
        assert max(len(r["text"] or "") for r in got) > 1_000_000
    else:
        assert set(texts) <= set(given)
