"""The same results as DuckDB SQL over the driver's views."""

from rasmlens import schema
from rasmlens.functions import lexicon as lex
from rasmlens.plans.datasets import ARABIC, LATIN
from rasmlens.plans.learning import RANKED_RULES, RULE_TOKENS

MARKS = r"\x{064B}-\x{0652}"
SPACES = (r"\t\n\x{0B}\x{0C}\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
          r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
KEPT = rf"\x{{0600}}-\x{{06FF}}{SPACES}A-Za-z0-9.,!?:;"
WORD = rf"\p{{L}}\p{{N}}_{MARKS}''"


def listed(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def arabic(column: str) -> str:
    return f"translate({column}, '{LATIN}', '{ARABIC}')"


def strip_diacritics(x: str) -> str:
    return f"regexp_replace({x}, '[{MARKS}]', '', 'g')"


def strip_tatweel(x: str) -> str:
    return f"replace({x}, '{lex.TATWEEL}', '')"


def fold_hamza(x: str) -> str:
    return f"translate({x}, 'ءأإآ', 'اااا')"


def fold_hamza_uniform(x: str) -> str:
    return f"translate(replace({x}, 'آ', 'ءء'), 'أإؤئٕٔ', 'ءءءءءء')"


def fold_alef(x: str, maksura: bool = False) -> str:
    return f"translate({x}, 'ٱى', 'اا')" if maksura else f"replace({x}, 'ٱ', 'ا')"


def split_ligatures(x: str) -> str:
    return rf"regexp_replace({x}, '[\x{{FEF5}}-\x{{FEFC}}]', 'لا', 'g')"


def blank_others(x: str) -> str:
    return f"regexp_replace({x}, '[^{KEPT}]', ' ', 'g')"


def collapse_blanks(x: str) -> str:
    return rf"regexp_replace({x}, '[ \t]+', ' ', 'g')"


def strip_ends(x: str) -> str:
    return f"regexp_replace({x}, '^[{SPACES}]+|[{SPACES}]+$', '', 'g')"


def normalized(x: str, hamza=fold_hamza, maksura: bool = False) -> str:
    folded = fold_alef(hamza(strip_tatweel(strip_diacritics(x))), maksura)
    return strip_ends(collapse_blanks(blank_others(split_ligatures(folded))))


def respelled(word: str) -> str:
    """A list entry as cleaning would write it."""
    x = f"'{word}'"
    return fold_alef(fold_hamza(strip_tatweel(strip_diacritics(x))))


def words(clean: str) -> str:
    return f"regexp_extract_all({clean}, '[{WORD}]{{2,}}')"


def without(tokens: str, stopwords) -> str:
    return f"list_filter({tokens}, lambda w: w NOT IN ({listed(stopwords)}))"


def syllables(w: str) -> str:
    return (rf"greatest(1, len(regexp_extract_all({w}, "
            rf"'[اوي\x{{064B}}-\x{{0650}}\x{{0652}}]+')))")


def noun(w: str) -> str:
    suffixes = " OR ".join(f"ends_with({w}, '{s}')" for s in lex.NOUN_SUFFIXES)
    return (f"CASE WHEN length({w}) < 3 THEN false WHEN {w} IN ({listed(lex.COMMON_VERBS)}) "
            f"THEN false WHEN starts_with({w}, 'ال') AND length({w}) > 3 THEN true "
            f"WHEN {suffixes} THEN true ELSE length({w}) = 3 END")


F023 = f"list_sum(list_transform(tokens, lambda w: {syllables('w')})) / len(tokens)"
F046 = f"len(list_filter(tokens, lambda w: {noun('w')}))"

DOCS = f"docs AS (SELECT doc_id, {arabic('text')} AS text, lang, source FROM documents)"
TOKENIZED = f"""{DOCS},
cleaned AS (SELECT *, {normalized('text')} AS clean FROM docs),
tokenized AS (SELECT *, {without(words('clean'), lex.DEFAULT_STOPWORDS)} AS tokens FROM cleaned),
counted AS (SELECT *, len(tokens)::INTEGER AS n_tokens FROM tokenized),
featured AS (SELECT *, CASE WHEN n_tokens > 0 THEN {F023} ELSE 0.0 END::DOUBLE AS f023,
                    {F046}::INTEGER AS f046 FROM counted)"""
PREPARED = f"""{TOKENIZED},
everything AS (SELECT f.*, l.quality AS label, f.lang AS model
               FROM featured f LEFT JOIN labels l USING (doc_id) WHERE n_tokens >= 5),
prepared AS (SELECT * FROM everything WHERE label IS NOT NULL)"""
WIDE = f"""wide AS (SELECT conv_id,
  {arabic("CASE WHEN role = 'user' THEN text END")} AS human,
  {arabic("CASE WHEN role = 'assistant' THEN text END")} AS ai FROM conversations)"""
CONVERSATIONS = f"""conv AS (SELECT * FROM (
  SELECT conv_id, human AS text, 0 AS label, 'human' AS model, 'conversations' AS source FROM wide
  UNION ALL SELECT conv_id, ai, 1, 'openai', 'conversations' FROM wide)
  WHERE text IS NOT NULL AND {strip_ends('text')} <> '')"""
LABELLED = f"""labelled AS (SELECT text, quality AS label,
  CASE quality WHEN 0 THEN 'human' ELSE 'jais' END AS model, 'documents' AS source
  FROM docs JOIN labels USING (doc_id) WHERE text IS NOT NULL AND {strip_ends('text')} <> '')"""


def rule(expression: str) -> str:
    return f"WITH {DOCS} SELECT doc_id, {expression} AS result FROM docs"


def token_lists(expression: str) -> str:
    return f"""WITH {DOCS}, cleaned AS (SELECT doc_id, {normalized('text')} AS clean FROM docs),
listed AS (SELECT doc_id, {expression} AS tokens FROM cleaned)
SELECT doc_id, array_to_string(tokens, ' ') AS tokens, len(tokens)::INTEGER AS n_tokens
FROM listed"""


def features(*columns: str) -> str:
    return f"WITH {TOKENIZED} SELECT doc_id, {', '.join(columns)} FROM featured"


def over_prepared(select: str, *ctes: str) -> str:
    return f"WITH {', '.join([PREPARED, *ctes])} {select}"


def distribution(expression: str) -> str:
    return over_prepared(f"""SELECT label, count(*) AS n, round(avg({expression}), 6) AS mean,
  round(min({expression})::DOUBLE, 6) AS min, round(max({expression})::DOUBLE, 6) AS max
  FROM prepared GROUP BY label""")


def position(key: str, seed: int) -> str:
    return f"CAST('0x' || substr(md5('{seed}:' || {key}), 1, 8) AS BIGINT)"


def density(column: str, where: str = "true") -> str:
    return over_prepared(
        """SELECT g.label, g.i, round(g.x, 6) AS x,
  round(sum(v.copies * exp(-0.5 * pow((g.x - v.v) / g.bw, 2)))
        / (any_value(g.n) * any_value(g.bw) * sqrt(2 * pi())), 9) AS density
  FROM grid g JOIN vals v USING (label) GROUP BY g.label, g.i, g.x""",
        f"""vals AS (SELECT label, {column}::DOUBLE AS v, count(*) AS copies
  FROM prepared WHERE {where} GROUP BY ALL)""",
        """stats AS (SELECT label, count(*) AS n, min(v) AS lo, max(v) AS hi,
  1.06 * stddev_pop(v) * pow(count(*), -0.2) AS raw
  FROM (SELECT label, v, unnest(range(copies)) FROM vals) GROUP BY label HAVING count(*) >= 2)""",
        """grid AS (SELECT label, n, CASE WHEN raw = 0 THEN 1.0 ELSE raw END AS bw, i::INTEGER AS i,
  lo + i * ((hi - lo) / 199) AS x FROM stats, range(200) r(i))""")


def correlations() -> str:
    names = ("f023", "f046", "n_tokens", "label")
    cells = " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM prepared"
        for a in names for b in names)
    return over_prepared(cells)


TERMS = """term_df AS (SELECT w, count(*) AS doc_freq FROM (
  SELECT unnest(list_distinct(tokens)) AS w FROM everything) GROUP BY w),
idfs AS (SELECT w, doc_freq, ln(((SELECT count(*) FROM everything) + 1) / (doc_freq + 1)) AS idf
         FROM term_df)"""

def scaled(fitted_on: str = "everything") -> str:
    return ", ".join(
        f"round({c} / (SELECT stddev_samp({c}) FROM {fitted_on}), 6) AS {c}_scaled"
        for c in ("f023", "f046", "n_tokens"))


SPLIT = f"""placed AS (SELECT *, CASE WHEN {position('doc_id', 2026)} < {int(0.70 * 2**32)}
  THEN 'train' WHEN {position('doc_id', 2026)} < {int((0.70 + 0.15) * 2**32)}
  THEN 'validation' ELSE 'test' END AS split FROM everything)"""

RULED = f"""ruled AS (SELECT label, CASE WHEN n_tokens > {RULE_TOKENS} THEN 1.0 ELSE 0.0 END::DOUBLE
  AS prediction, n_tokens AS score FROM prepared)"""
CLASS_F1 = """classes AS (SELECT c, count(*) FILTER (WHERE label = c) AS actual,
  2.0 * count(*) FILTER (WHERE label = c AND prediction = c)
  / (count(*) FILTER (WHERE label = c) + count(*) FILTER (WHERE prediction = c)) AS f1
  FROM ruled, (VALUES (0), (1)) k(c) GROUP BY c)"""
RANKS = """ranks AS (SELECT label, rank() OVER (ORDER BY score)
  + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM ruled)"""


# Murmur3 (32 bits, seed 42) of a word's UTF-8 bytes, modulo 4096.
M32 = 4294967295


def rotated(x: str, bits: int) -> str:
    return f"((({x} & {(1 << (32 - bits)) - 1}) << {bits}) | ({x} >> {32 - bits}))"


def mixed(k: str) -> str:
    first = f"(({k} * 3432918353) & {M32})"
    return f"(({rotated(first, 15)} * 461845907) & {M32})"


def scrambled(x: str, shift: int, factor: int | None = None) -> str:
    folded = f"xor({x}, {x} >> {shift})"
    return f"(({folded} * {factor}) & {M32})" if factor else folded


def number(*positions: str) -> str:
    pieces = " || ".join(f"substr(hx, {p}, 2)" for p in positions)
    return f"CAST('0x' || {pieces} AS UBIGINT)"


BLOCK = number("8 * i + 7", "8 * i + 5", "8 * i + 3", "8 * i + 1")
TAIL = number("8 * (n // 4) + 5", "8 * (n // 4) + 3", "8 * (n // 4) + 1")
STEP = f"(({rotated('xor(h, k)', 13)} * 5 + 3864292196) & {M32})"
BUCKETS = f"""vocab AS (SELECT w, hex(w) AS hx, strlen(w) AS n
  FROM (SELECT DISTINCT unnest(tokens) AS w FROM everything)),
body AS (SELECT w, n, list_reduce([42::UBIGINT] || list_transform(
    list_transform(range(n // 4), lambda i: {BLOCK}), lambda k: {mixed('k')}),
    lambda h, k: {STEP}) AS h, CASE WHEN n % 4 > 0 THEN {TAIL} ELSE 0 END::UBIGINT AS k FROM vocab),
ended AS (SELECT w, xor(xor(h, {mixed('k')}), n::UBIGINT) AS h FROM body),
once AS (SELECT w, {scrambled('h', 16, 2246822507)} AS h FROM ended),
twice AS (SELECT w, {scrambled('h', 13, 3266489909)} AS h FROM once),
buckets AS (SELECT w, ({scrambled('h', 16)} & 4095)::INTEGER AS bucket FROM twice)"""
HASHED = f"""{BUCKETS},
hashed AS (SELECT doc_id, bucket, count(*) AS tf
  FROM (SELECT doc_id, unnest(tokens) AS w FROM everything) JOIN buckets USING (w)
  GROUP BY doc_id, bucket),
bucket_idf AS (SELECT bucket, ln(((SELECT count(*) FROM everything) + 1) / (count(*) + 1)) AS idf
  FROM hashed GROUP BY bucket),
weighted AS (SELECT doc_id, bucket, tf, tf * idf AS tfidf FROM hashed JOIN bucket_idf USING (bucket))"""

# Multinomial naive Bayes with smoothing 1 over the 4,099 values, fitted on the training rows.
STYLE_VALUES = " UNION ALL ".join(
    f"SELECT doc_id, {4096 + i}, {c} / (SELECT stddev_samp({c}) FROM everything) FROM everything"
    for i, c in enumerate(("f023", "f046", "n_tokens")))
BAYES = f"""{HASHED}, {SPLIT},
cells AS (SELECT doc_id, bucket AS j, tfidf AS x FROM weighted UNION ALL {STYLE_VALUES}),
train AS (SELECT doc_id, label FROM placed WHERE split = 'train' AND label IS NOT NULL),
priors AS (SELECT label AS c, ln(count(*) + 1) - ln((SELECT count(*) FROM train) + 2) AS pi
  FROM train GROUP BY label),
masses AS (SELECT label AS c, j, sum(x) AS s FROM cells JOIN train USING (doc_id) GROUP BY ALL),
totals AS (SELECT c, sum(s) AS total FROM masses GROUP BY c),
scored AS (SELECT d.doc_id, t.c,
    any_value(p.pi) + sum(d.x * (ln(coalesce(m.s, 0) + 1) - ln(t.total + 4099))) AS score
  FROM cells d CROSS JOIN totals t JOIN priors p USING (c)
  LEFT JOIN masses m ON m.c = t.c AND m.j = d.j GROUP BY d.doc_id, t.c),
guessed AS (SELECT doc_id, p.label, p.split, arg_max(c, score)::DOUBLE AS prediction,
    round(max(score) FILTER (WHERE c = 1), 8) AS score
  FROM scored JOIN placed p USING (doc_id) GROUP BY ALL)"""
GUESSED_TEST = """ruled AS (SELECT label, prediction, score FROM guessed
  WHERE split = 'test' AND label IS NOT NULL)"""

METRICS = """SELECT (SELECT count(*) FROM ruled) AS n,
  round((SELECT avg((label = prediction)::INTEGER) FROM ruled), 6) AS accuracy,
  round((SELECT sum(f1 * actual) / sum(actual) FROM classes), 6) AS f1,
  round((SELECT (sum(r) FILTER (WHERE label = 1) - p * (p + 1) / 2.0) / (p * (t - p)) FROM ranks,
    (SELECT count(*) AS t, count(*) FILTER (WHERE label = 1) AS p FROM ruled) GROUP BY p, t), 6)
    AS auc"""
CONFUSION = """SELECT label, count(*) FILTER (WHERE prediction = 0)::INTEGER AS pred_0,
  count(*) FILTER (WHERE prediction = 1)::INTEGER AS pred_1 FROM ruled GROUP BY label"""

ROWS_IN_AND_OUT = "(SELECT count(*) FROM everything)"


def ruled(more_than: int) -> str:
    return f"""ruled AS (SELECT label, CASE WHEN n_tokens > {more_than} THEN 1.0 ELSE 0.0 END::DOUBLE
  AS prediction, n_tokens AS score FROM prepared)"""


def ranked(more_than: int) -> str:
    """The scores of one rule, four digits."""
    return f"""SELECT 'over {more_than}' AS model, round(accuracy, 4) AS acc, round(f1, 4) AS f1, round(auc, 4) AS auc
  FROM (WITH {ruled(more_than)}, {CLASS_F1}, {RANKS} {METRICS})"""


RANKED = over_prepared(" UNION ALL ".join(map(ranked, RANKED_RULES)))

ARTICLES = f"""WITH {TOKENIZED} SELECT doc_id,
  len(list_filter(tokens, lambda w: starts_with(w, 'ال')))::INTEGER AS articles FROM counted"""
PERCENTILES = " UNION ALL ".join(
    f"SELECT '{c}' AS measure, label, {p} AS p, round(quantile_cont({c}::DOUBLE, {p}), 6) AS value FROM prepared GROUP BY label"
    for c in ("n_tokens", "f023", "f046") for p in ("0.05::DOUBLE", "0.25::DOUBLE", "0.5::DOUBLE", "0.75::DOUBLE", "0.95::DOUBLE"))
SCORED = """scored_rows AS (SELECT 'NaiveBayes' AS model, label, score FROM guessed WHERE split = 'test' AND label IS NOT NULL
  UNION ALL SELECT 'n_tokens', label, n_tokens FROM prepared UNION ALL SELECT 'f023', label, f023 FROM prepared
  UNION ALL SELECT 'f046', label, f046 FROM prepared),
score_ranks AS (SELECT model, label, rank() OVER (PARTITION BY model ORDER BY score)
  + (count(*) OVER (PARTITION BY model, score) - 1) / 2.0 AS r FROM scored_rows)"""
AREAS = """SELECT model, count(*) AS n, count(*) FILTER (label = 1) AS positives,
  round((sum(r) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0)
    / (count(*) FILTER (label = 1) * count(*) FILTER (label <> 1)), 9) AS auc FROM score_ranks GROUP BY model"""
LONG_LIST = f"""{DOCS},
cleaned AS (SELECT *, {normalized('text')} AS clean FROM docs),
counted AS (SELECT *, len(tokens)::INTEGER AS n_tokens FROM (SELECT *, list_filter({words('clean')},
    lambda w: length(w) <> 3 AND w NOT IN ({listed(lex.DEFAULT_STOPWORDS)})) AS tokens FROM cleaned))"""

SQL = {
    "class_profile": over_prepared("""SELECT label, count(*) AS n, round(avg(f023), 6) AS avg_f023,
  round(avg(f046), 6) AS avg_f046, round(avg(n_tokens), 6) AS avg_n_tokens,
  round(avg(len(list_distinct(tokens)) / n_tokens), 6) AS avg_ttr
  FROM prepared GROUP BY label"""),
    "strip_diacritics": rule(strip_diacritics("text")),
    "strip_tatweel": rule(strip_tatweel("text")),
    "fold_hamza": rule(fold_hamza("text")),
    "fold_alef": rule(fold_alef("text")),
    "split_ligatures": rule(split_ligatures("text")),
    "blank_other_characters": rule(blank_others("text")),
    "collapse_blanks": rule(collapse_blanks("text")),
    "strip_ends": rule(strip_ends("text")),
    "normalize_text": rule(normalized("text")),
    "normalize_hamza_uniform": rule(normalized("text", fold_hamza_uniform)),
    "normalize_alef_maksura": rule(normalized("text", maksura=True)),
    "tokenize": token_lists(words("clean")),
    "tokenize_punctuation": token_lists(
        rf"list_filter(regexp_extract_all(clean, '[{WORD}]{{2,}}|[^{WORD} \t\r\x{{0C}}\x{{0B}}]{{2,}}'), "
        f"lambda w: {strip_ends('w')} <> '')"),
    "stopword_filter_inset": token_lists(without(words("clean"), lex.DEFAULT_STOPWORDS)),
    "stopword_filter_respelled": token_lists(
        f"list_filter({words('clean')}, lambda w: w NOT IN ({', '.join(map(respelled, lex.DEFAULT_STOPWORDS))}))"),
    "stopword_filter_antijoin": token_lists(without(words("clean"), lex.DEFAULT_STOPWORDS)),
    "noun_hook": ARTICLES,
    "noun_hook_by_vocabulary": ARTICLES,
    "prepare_stopword_table": f"""WITH {LONG_LIST}
SELECT doc_id, n_tokens, ({F023})::DOUBLE AS f023, ({F046})::INTEGER AS f046 FROM counted WHERE n_tokens >= 5""",
    "min_token_filter": f"WITH {TOKENIZED} SELECT doc_id, n_tokens FROM counted WHERE n_tokens >= 5",
    "syllables_f023": features("f023"),
    "nouns_f046": features("f046"),
    "stylometrics": features("f023", "f046", "n_tokens"),
    "word_syllables": f"""WITH {TOKENIZED}, vocab AS (SELECT unnest(tokens) AS w FROM tokenized)
  SELECT w, count(*) AS n, {syllables('w')}::INTEGER AS syllables FROM vocab GROUP BY w""",
    "word_nouns": f"""WITH {TOKENIZED}, vocab AS (SELECT unnest(tokens) AS w FROM tokenized)
  SELECT w, count(*) AS n, ({noun('w')})::INTEGER AS noun FROM vocab GROUP BY w""",
    "melt_conversations": f"""WITH {WIDE}, {CONVERSATIONS}
  SELECT conv_id, md5(text) AS text_md5, label, model, source FROM conv""",
    "union_splits": f"""WITH {DOCS}, {WIDE}, {CONVERSATIONS}, {LABELLED}
  SELECT source, model, label, count(*) AS n, sum(length(text))::BIGINT AS n_chars
  FROM (SELECT text, label, model, source FROM conv
        UNION ALL SELECT text, label, model, source FROM labelled) GROUP BY source, model, label""",
    "ingest_csv": f"""WITH {DOCS}, {WIDE}, {CONVERSATIONS}, {LABELLED}
  SELECT md5(text) AS text_md5, label, model, 'validation' AS source FROM conv
  UNION ALL SELECT md5(text), label, model, 'train' FROM labelled""",
    "csv_roundtrip": f"WITH {DOCS} SELECT doc_id, text FROM docs",
    "parquet_roundtrip": over_prepared("""SELECT md5(text) AS text_md5, clean AS clean_text_columns,
  array_to_string(tokens, ' ') AS tokens, n_tokens, label, model, source FROM everything"""),
    "parquet_partitioned": over_prepared("SELECT doc_id, n_tokens, label FROM prepared"),
    "row_count": over_prepared("SELECT count(*) AS n FROM everything"),
    "label_counts": over_prepared("SELECT label, count(*) AS n FROM prepared GROUP BY label"),
    "class_composition": over_prepared("""SELECT label, count(*) AS n,
  round(100.0 * count(*) / (SELECT count(*) FROM prepared), 1) AS percent
  FROM prepared GROUP BY label"""),
    "token_counts": over_prepared("""SELECT w, count(*) AS count
  FROM (SELECT unnest(tokens) AS w FROM everything) GROUP BY w"""),
    "top_tokens": over_prepared("""SELECT w, count(*) AS count
  FROM (SELECT unnest(tokens) AS w FROM everything) GROUP BY w ORDER BY count DESC, w LIMIT 20"""),
    "type_token_ratio": over_prepared("""SELECT doc_id, label,
  len(list_distinct(tokens)) / n_tokens AS ttr FROM everything"""),
    "ttr_by_class": distribution("len(list_distinct(tokens)) / n_tokens"),
    "token_distribution_by_class": distribution("n_tokens"),
    "noun_distribution_by_class": distribution("f046"),
    "percentiles_by_class": over_prepared(PERCENTILES),
    "kde_tokens_by_class": density("n_tokens"),
    "kde_tokens_sampled": density("n_tokens", f"{position('doc_id', 3)} < {int(0.5 * 2**32)}"),
    "kde_f023_by_class": density("f023"),
    "corr_matrix": correlations(),
    "term_idf": over_prepared("SELECT w, doc_freq, round(idf, 9) AS idf FROM idfs", TERMS),
    "tfidf_exact": over_prepared("""SELECT doc_id, w, tf, round(tf * idf, 6) AS tfidf
  FROM (SELECT doc_id, w, count(*) AS tf FROM (SELECT doc_id, unnest(tokens) AS w FROM everything)
        GROUP BY doc_id, w) JOIN idfs USING (w)""", TERMS),
    "stylo_scaled": over_prepared(f"SELECT doc_id, {scaled()} FROM everything"),
    "sample_hash": f"""SELECT doc_id, lang FROM documents
  WHERE {position('doc_id', 3)} < {int(0.5 * 2**32)}""",
    "sample_limit": f"""SELECT doc_id, lang FROM documents
  WHERE {position('doc_id', 9)} < {int(0.05 * 2**32)} ORDER BY doc_id LIMIT 20""",
    "hash_split_counts": over_prepared(
        "SELECT split, label, count(*) AS n FROM placed GROUP BY split, label", SPLIT),
    "random_split_cover": over_prepared("SELECT doc_id, 1::BIGINT AS splits FROM everything"),
    "random_split_two_stage_cover": over_prepared("SELECT doc_id, 1::BIGINT AS splits FROM everything"),
    "sample_bernoulli_subset": """SELECT count(*) AS n, 0::BIGINT AS foreign, 0::BIGINT AS doubled,
  true AS about_half FROM documents""",
    "ingest_csv_mixed_headers": f"""WITH {DOCS}, {WIDE}, {LABELLED}
  SELECT md5(text) AS text_md5, label, model, 'train' AS source FROM (
    SELECT text, label, model FROM labelled UNION ALL SELECT text, label, model FROM labelled
    UNION ALL SELECT human, 0, 'human' FROM wide WHERE human IS NOT NULL AND {strip_ends('human')} <> '')""",
    "feature_vectors": over_prepared(f"""SELECT doc_id, 4099 AS dim,
  n_tokens::DOUBLE AS tf_total, {scaled()} FROM everything"""),
    "feature_vectors_fit_on_train": over_prepared(f"""SELECT doc_id, 4099 AS dim,
  n_tokens::DOUBLE AS tf_total, {scaled("(SELECT * FROM placed WHERE split = 'train')")}
  FROM everything""", SPLIT),
    "hashed_tfidf": over_prepared(
        "SELECT doc_id, bucket, tf, round(tfidf, 6) AS tfidf FROM weighted", HASHED),
    "naive_bayes_predictions": over_prepared(
        "SELECT doc_id, label, prediction FROM guessed WHERE label IS NOT NULL", BAYES),
    "naive_bayes_test": over_prepared(METRICS, BAYES, GUESSED_TEST, CLASS_F1, RANKS),
    "naive_bayes_evaluation": over_prepared(
        f"SELECT round(accuracy, 4) AS accuracy, round(f1, 4) AS f1_score, round(auc, 4) AS auc FROM ({METRICS})",
        BAYES, GUESSED_TEST, CLASS_F1, RANKS),
    "log_reg_by_hand": over_prepared("SELECT doc_id, true AS agrees FROM prepared"),
    "linear_svc_by_hand": over_prepared("SELECT doc_id, true AS agrees FROM prepared"),
    "random_forest_by_hand": over_prepared("SELECT doc_id, true AS agrees FROM prepared"),
    "log_reg_gradient": "SELECT true AS flat",
    "log_reg_gap": "SELECT 'LogReg' AS model, true AS is_bound, true AS is_near",
    "linear_svc_gap": "SELECT 'LinearSVC' AS model, true AS is_bound, true AS is_near",
    "rf_importance_by_hand": "SELECT range::INTEGER AS feature, true AS agrees FROM range(4099)",
    "rf_nodes_add_up": "SELECT 80::BIGINT AS trees, true AS whole, true AS adds_up, true AS gains",
    "auc_by_model": over_prepared(AREAS, BAYES, SCORED),
    "rf_importance_range": f"""SELECT place::BIGINT AS place, feature, true AS is_share
  FROM (VALUES (0, '{schema.F023}'), (1, '{schema.F046}'), (2, '{schema.N_TOKENS}')) f(place, feature)""",
    "inference_sweep_rows": over_prepared("""SELECT p::INTEGER AS partitions,
  (SELECT count(*) FROM placed WHERE split = 'test' AND label IS NOT NULL) AS rows
  FROM (VALUES (2), (4), (8), (16)) s(p)""", SPLIT),
    "rule_ranking": RANKED,
    "rule_best": f"SELECT arg_max(model, f1) AS model FROM ({RANKED})",
    "naive_bayes_confusion": over_prepared(CONFUSION, BAYES, GUESSED_TEST),
    "rule_metrics": over_prepared(METRICS, RULED, CLASS_F1, RANKS),
    "rule_confusion": over_prepared(CONFUSION, RULED),
    "rule_confusion_counts": over_prepared(
        "SELECT label, prediction, count(*) AS n FROM ruled GROUP BY label, prediction", RULED),
    "save_load_predict": over_prepared("""SELECT model, (SELECT count(*) FROM prepared) AS n,
  (SELECT count(*) FROM prepared) AS n_same
  FROM (VALUES ('NaiveBayes'), ('LogReg'), ('RandomForest'), ('LinearSVC')) m(model)"""),
    "stream_prepare": over_prepared(
        "SELECT md5(text) AS text_md5, label, n_tokens, f023, f046 FROM everything"),
    "stream_stopword_table": f"""WITH {LONG_LIST}
SELECT md5(text) AS text_md5, quality AS label, n_tokens, ({F023})::DOUBLE AS f023, ({F046})::INTEGER AS f046
FROM counted LEFT JOIN labels USING (doc_id) WHERE n_tokens >= 5""",
    "stream_running_accuracy": over_prepared("""SELECT count(*) AS n,
  round(avg(coalesce(label = prediction, false)::INTEGER), 6) AS accuracy FROM guessed""", BAYES),
    "stream_naive_bayes": over_prepared(
        "SELECT md5(p.text) AS text_md5, label, prediction FROM guessed g JOIN "
        "(SELECT doc_id, text FROM everything) p USING (doc_id)", BAYES),
    "stream_naive_bayes_accuracy": over_prepared("""SELECT count(*) AS n,
  round(avg((label = prediction)::INTEGER), 6) AS accuracy FROM guessed WHERE label IS NOT NULL""", BAYES),
    "stream_accuracy_with_unlabelled": over_prepared("""SELECT count(*) AS n,
  round(avg(coalesce(label = prediction, false)::INTEGER), 6) AS accuracy FROM guessed""", BAYES),
    "console_rows": "SELECT count(*) AS n FROM documents",
    "timed_stream_rows": """SELECT quality AS label, count(*) AS n
  FROM documents LEFT JOIN labels USING (doc_id) GROUP BY quality""",
    "stream_matches_batch": over_prepared(f"""SELECT {ROWS_IN_AND_OUT} AS n_stream,
  {ROWS_IN_AND_OUT} AS n_batch, {ROWS_IN_AND_OUT} AS n_shared"""),
}
