import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import plain
from rasmlens import schema
from rasmlens.functions import (
    DEFAULT, TextProfile, avg_syllables, count_nouns, drop_stopwords_by_table, is_blank,
    looks_like_noun, normalize_arabic, split_words, syllables, tokenize, type_token_ratio)
from rasmlens.functions import lexicon as lex
from rasmlens.functions import normalize as rules
from rasmlens.operators import add_stylometrics, add_tokens, clean, list_tokens, prepare, prepare_listed


def apply(spark, rule, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(rule(F.col("v"))).collect()]


@pytest.mark.parametrize("raw, expected", [
    (None, None),
    ("", ""),
    ("  \n\t ", ""),
    ("كَتَبَ", "كتب"),
    ("مدرّسة", "مدرسة"),
    ("كـــتاب", "كتاب"),
    ("ء أ إ آ", "ا ا ا ا"),
    ("سؤال مائة", "سؤال مائة"),
    ("ٱلكتاب", "الكتاب"),
    ("على", "على"),
    ("ﻻ ﻷ ﻹ ﻵ ﻼ", "لا لا لا لا لا"),
    ("نص😀نص é نص", "نص نص نص"),
    ("a\t \tb", "a b"),
    ("سطر\nسطر", "سطر\nسطر"),
    ("x y", "x y"),
    ("x\x1cy\x85", "x\x1cy"),
    ("it's (ok) 50%!", "it s ok 50 !"),
])
def test_normalize(spark, raw, expected):
    assert apply(spark, normalize_arabic, [raw]) == [expected]
    assert plain.normalize(raw) == expected


def test_rules_one_by_one(spark):
    def one(rule, value):
        return apply(spark, rule, [value])[0]

    assert one(rules.strip_diacritics, lex.DIACRITICS + "بـ") == "بـ"
    assert one(rules.strip_tatweel, "بـًـ") == "بً"
    assert one(rules.fold_hamza, "ءأإآؤئ") == "ااااؤئ"
    assert one(lambda c: rules.fold_hamza(c, "hamza"), "ءأإآؤئ") == "ءءءءءءء"
    assert one(rules.fold_alef, "ٱى") == "اى"
    assert one(lambda c: rules.fold_alef(c, maksura=True), "ٱى") == "اا"
    assert one(rules.split_ligatures, "ﻵﻼ") == "لالا"
    assert one(rules.blank_other_characters, "بé-ب\n") == "ب  ب\n"
    assert one(rules.collapse_blanks, " \t\n  ") == " \n "
    assert one(rules.strip_ends, "　 ب ب\r\n") == "ب ب"


def test_composed_rule_equals_the_chain(spark):
    text = F.col("v")
    chain = rules.fold_hamza(rules.strip_tatweel(rules.strip_diacritics(text)))
    chain = rules.split_ligatures(rules.fold_alef(chain))
    chain = rules.strip_ends(rules.collapse_blanks(rules.blank_other_characters(chain)))
    values = random_texts(300, seed=1)
    assert apply(spark, normalize_arabic, values) == apply(spark, lambda _: chain, values)


def test_hamza_mode(spark):
    uniform = replace(DEFAULT, hamza="hamza")
    assert apply(spark, lambda c: normalize_arabic(c, uniform), ["سؤال أئمة آجلا"]) == ["سءال ءءمة ءءجلا"]
    with pytest.raises(ValueError):
        TextProfile(hamza="none")


@pytest.mark.parametrize("clean_text, expected", [
    (None, []),
    ("", []),
    ("... ! ؟", []),
    ("ب ت ث", []),
    ("قلم abc 12 x_y", ["قلم", "abc", "12", "x_y"]),
    ("كتاب,قلم;ورق", ["كتاب", "قلم", "ورق"]),
    ("كتاب في البيت", ["كتاب", "البيت"]),
    ("في من عن", []),
])
def test_tokenize(spark, clean_text, expected):
    assert apply(spark, tokenize, [clean_text]) == [expected]
    assert plain.tokens(clean_text) == expected


def test_punctuation_runs_on_request(spark):
    profile = replace(DEFAULT, punctuation_tokens=True)
    got = apply(spark, lambda c: split_words(c, profile), ["كتاب... قلم! \n\n ورق"])
    assert got == [["كتاب", "...", "قلم", "ورق"]]


def test_stopwords_match_raw_spelling_unless_told_otherwise(spark):
    cleaned = ["ان البيت"]
    assert apply(spark, tokenize, cleaned) == [["ان", "البيت"]]
    respelled = replace(DEFAULT, normalize_lexicon=True)
    assert apply(spark, lambda c: tokenize(c, respelled), cleaned) == [["البيت"]]


def test_long_lists_are_allowed_as_literals_and_as_a_table(spark):
    listed = [str(i) for i in range(30_000)]
    assert len(TextProfile(stopwords=tuple(listed)).stopwords) == 30_000
    banned = spark.createDataFrame([(w,) for w in ("كتاب", "درس", None)] + [(w,) for w in listed], "word string")
    rows = spark.createDataFrame(
        [(1, "كتاب قلم درس ورق معلم طالب علم"), (2, "كتاب درس"), (3, None)], "id int, text string")
    got = prepare(rows, stopwords=banned, keys=("id",), f023="a", f046="b")
    assert [(r["id"], r["tokens"]) for r in got.collect()] == [(1, "قلم ورق معلم طالب علم".split())]
    assert {"a", "b"} < set(got.columns)


@pytest.mark.parametrize("extra, salts", [(0, 5), (50, 1), (1000, 16)])
def test_stopword_antijoin_equals_literal_filter(spark, extra, salts):
    rng = random.Random(extra)
    vocabulary = [f"w{i}" for i in range(12)]
    banned = ["w0", "w1", "w2"]
    rows = [(i, i % 2, [rng.choice(vocabulary) for _ in range(rng.randrange(9))], "x")
            for i in range(80)] + [(100, 0, ["w0"] * 40, "x"), (101, 0, [], "x")]
    df = spark.createDataFrame(rows, "id int, part int, tokens array<string>, other string")
    words = spark.createDataFrame(
        [(w,) for w in banned + [f"unused{i}" for i in range(extra)]], "word string")
    got = drop_stopwords_by_table(df, words, ["id", "part"], salts=salts)
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect())) == [
        (i, p, [t for t in ts if t not in banned], o) for i, p, ts, o in rows]


def test_syllables(spark):
    words = ["بتث", "باب", "كتاوي", "كتابوي", "بابا", "", None]
    assert apply(spark, syllables, words) == [1, 1, 1, 2, 2, 0, 0]


def test_avg_syllables_and_nouns_without_words(spark):
    lists = [[], None, ["باب", "بابا"]]
    assert apply(spark, avg_syllables, lists, "array<string>") == [0.0, 0.0, 1.5]
    assert apply(spark, count_nouns, lists, "array<string>") == [0, 0, 1]
    assert apply(spark, type_token_ratio, [["a", "a", "b", "b"], []], "array<string>") == [0.5, None]


@pytest.mark.parametrize("word, expected", [
    (None, False), ("", False), ("با", False), ("باب", True), ("قال", False), ("جاء", False),
    ("يأتي", False), ("ياتي", False), ("الب", True), ("البا", True), ("مدرسة", True),
    ("كتابات", True), ("معلمون", True), ("معلمين", True), ("عربية", True), ("قضايا", True),
    ("كتابها", True), ("كتابهم", True), ("كتابهن", True), ("مكتب", False), ("استخدم", False),
])
def test_noun_heuristic(spark, word, expected):
    assert apply(spark, looks_like_noun, [word]) == [expected]
    assert plain.noun(word or "") == expected


def test_noun_counter_hook(spark):
    profile = replace(DEFAULT, noun_counter=lambda tokens: F.size(tokens) * 2)
    assert apply(spark, lambda c: count_nouns(c, profile), [["a", "b"]], "array<string>") == [4]


def test_blank(spark):
    assert apply(spark, is_blank, [None, "", " \n ", "x"]) == [True, True, True, False]


def random_texts(n, seed):
    rng = random.Random(seed)
    letters = "ابتةثجحخدذرزسشصضطظعغفقكلمنهويىءأإآؤئٱ"
    other = lex.DIACRITICS + lex.TATWEEL + lex.WHITESPACE + " " * 30 + "\n.,!?:;'_-%é😀٣7aZﻷﻻٰ"
    words = list(lex.DEFAULT_STOPWORDS) + list(lex.COMMON_VERBS)
    def piece():
        kind = rng.random()
        if kind < 0.2:
            return " " + rng.choice(words) + " "
        return rng.choice(letters) if kind < 0.75 else rng.choice(other)
    return ["".join(piece() for _ in range(rng.randrange(120))) for _ in range(n)]


def test_everything_matches_plain_python(spark):
    texts = random_texts(1500, seed=7) + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    rows = add_stylometrics(add_tokens(df)).collect()
    assert len(rows) == len(texts)
    for row in rows:
        cleaned = plain.normalize(row["text"])
        words = plain.tokens(cleaned)
        assert row[schema.CLEAN] == cleaned
        assert row["tokens"] == words
        assert row["n_tokens"] == len(words)
        mean = sum(map(plain.syllables, words)) / len(words) if words else 0.0
        assert row[schema.F023] == mean
        assert row[schema.F046] == sum(map(plain.noun, words))


def test_length_filter(spark):
    texts = ["با " * n for n in (4, 5, 6)] + [None, "", "في " * 9]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert sorted(r["n_tokens"] for r in clean(df).collect()) == [5, 6]


def test_text_rules_run_once_and_without_python(spark, plan_of):
    df = spark.createDataFrame([("نص",)], "text string")
    plan = plan_of(prepare(df).where("n_tokens > 7"))
    assert plan.count("Generate inline") == 1
    assert plan.count("{2,}, 0") == 1
    assert "Python" not in plan and "Exchange" not in plan


def odd_texts():
    rng = random.Random(7)
    edges = (lex.DIACRITICS + lex.TATWEEL + lex.HAMZA_TO_ALEF + lex.ALEF_WASLA + lex.ALEF_MAKSURA + lex.HAMZA_CARRIERS
             + "".join(map(chr, range(0xFEF5, 0xFEFD))) + lex.WHITESPACE + ".,!?:;_'\"-*éÜß٣۴²½" + "‌‏\x00\U0001F600\U00010400")
    arabic = [chr(c) for c in range(0x600, 0x700)]
    pools = [edges, arabic, "ابتكقل من \n", list(edges) + arabic + list("aB9 ") + [chr(c) for c in range(0x20, 0x2000, 7)]]
    return [None, "", " ", "ـ"] + ["".join(rng.choices(rng.choice(pools), k=rng.randrange(60))) for _ in range(400)]


@pytest.mark.parametrize("profile", [
    DEFAULT, replace(DEFAULT, hamza="hamza"), replace(DEFAULT, fold_alef_maksura=True),
    replace(DEFAULT, punctuation_tokens=True)], ids=["alef", "hamza", "maksura", "punctuation"])
def test_tokens_of_the_spelled_text_are_those_of_the_cleaned_one(spark, profile):
    df = spark.createDataFrame(list(enumerate(odd_texts())), "id int, text string")
    listed = list_tokens(df, profile).select(
        "tokens", split_words(F.col("clean_text_columns"), profile).alias("want"),
        "clean_text_columns", normalize_arabic(F.col("text"), profile).alias("clean")).collect()
    assert sum(len(r["tokens"]) for r in listed) > 500
    for r in listed:
        assert r["tokens"] == r["want"] and r["clean_text_columns"] == r["clean"]


def test_nothing_is_cleaned_between_words_where_only_tokens_are_read(spark, plan_of):
    df = spark.createDataFrame([(1, "كتاب قلم درس ورق معلم")], "id int, text string")
    assert "btrim(" not in plan_of(prepare(df).drop("clean_text_columns", "text")).split("Physical Plan")[-1]
    assert prepare(df).columns[:5] == ["id", "text", "clean_text_columns", "tokens", "n_tokens"]


def test_tokens_left_by_a_table_are_worked_out_once(spark, plan_of):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, ["a"])], "id int, tokens array<string>")
    words = spark.createDataFrame([("a",)], "word string")
    left = drop_stopwords_by_table(df, words, ["id"]).where(F.size("tokens") > 0)
    assert plan_of(left).count("array_contains(") == 1
    assert [tuple(r) for r in left.collect()] == [(1, ["b"])]


def test_listed_rows_are_prepared_like_texts(spark):
    df = spark.createDataFrame(
        [(1, "كتاب قلم درس ورق معلم طالب علم"), (1, "كتاب قلم كتاب ورق معلم طالب علم"), (2, "كتاب درس"), (3, None)],
        "id int, text string")
    words = spark.createDataFrame([("كتاب",), ("درس",), (None,), ("كتاب",)], "word string")
    got = prepare_listed(list_tokens(df), words, ("id",))
    want = prepare(df, stopwords=words, keys=("id",))
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 2
