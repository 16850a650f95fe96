"""The operators' queries, each over its whole table with production parameters."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasmlens.llm import (
    chat, collocations, language, lines, merkle, mixing, packing, rules, search, sharding, simhash, sketches,
    urls)
from rasmlens.llm.frames import stored, table

# The url rules.
URL_RULES = (
    urls.Rule("net", "/", "block"),
    urls.Rule("example.net", "/en/", "allow"),
    urls.Rule("example.com", "/de/", "block"),
    urls.Rule("org", "/fr/", "allow"),
)
# A conversation that spells control strings.
CONTROL_TEXT = r"\### Assistant: </turn> ok"


#: Sites on which a line becomes boilerplate.
MIN_SITES = 10


def op1_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = lines.remove_shared_lines(
        table(spark, sf_dir, "documents"), MIN_SITES, n_lines="n_lines", n_removed="n_removed")
    return cleaned.select("doc_id", "text", "n_lines", "n_removed")


def op2_pack_powers_of_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), max_length=1024)
    # The ids themselves stay where they were made.
    return packing.in_buckets(pieces.select(
        "doc_id", "start", "length", F.crc32("tokens").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset", "nth"))


def op3_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = language.held_out(F.col("doc_id"))
    model = language.train(docs.where(F.col("doc_id").isNotNull() & ~out))
    return language.identify(docs, model, ["doc_id"]).select(
        "doc_id", out.alias("held_out"), "lang_pred", "score",
        F.array_join(F.transform("languages", lambda x: F.concat_ws(":", x["lang"], F.format_number(x["share"], 3))), " "
                     ).alias("mixture"))


# The levels of the mixing tree: a domain has five of the numbered sources.
DOMAINS = ("web", "books", "news", "forum")
#: Weights of the tree's nodes by path; all others weigh 1.
MIX_WEIGHTS = {
    ("web",): 4, ("books",): 2, ("news",): 2,
    ("web", "en"): 3, ("books", "en"): 2, ("books", "de"): 2,
    ("web", "en", "src0"): 2,
}
#: The mixture's size as a share of all words, and how often a leaf may be read.
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 0.75, 2, 17


def mix_levels() -> dict:
    number = F.regexp_extract("source", "^src([0-9]{1,4})$", 1).try_cast("int")
    domain = F.element_at(F.array(*map(F.lit, DOMAINS)), F.floor(number / 5).cast("int") + 1)
    known = number.isNotNull() & (number < 5 * len(DOMAINS))
    return {"domain": F.when(known, domain).otherwise("other"), "lang": F.col("lang"), "source": F.col("source")}


def op5_hierarchical_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    levels = mix_levels()
    counted = stored(table(spark, sf_dir, "documents").select(
        "doc_id", levels["domain"].alias("domain"), "lang", "source",
        mixing.word_count(F.col("text")).alias("n_words")), "counted")
    return mixing.mix(
        counted, {c: F.col(c) for c in levels}, MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED,
        tokens=F.col("n_words"), leaf_budget="leaf_budget")


def op6_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), shards=40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def listed_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in for a block list from outside: one in 16 of the keys, by their MD5."""
    host, path = urls.host_and_path(F.col("url"))
    keys = table(spark, sf_dir, "pages").select(F.concat(host, path).alias("key"))
    return keys.where(F.md5("key").startswith("0"))


def op7_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(
        table(spark, sf_dir, "pages"), URL_RULES, listed_urls(spark, sf_dir))


def op8_chat_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame(
        [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)], said.schema)
    output = chat.format_chat(chat.records_of_turns(said.unionByName(control)))
    read = output.select(
        "conv_id", F.length("formatted").cast("long").alias("formatted_chars"),
        F.inline(F.array(F.struct(
            chat.read_turns(F.col("formatted")).alias("turns"),
            chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")))))
    turns = F.array_join(F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


def op9_adaptive_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents"))


def op10_norm_sorted_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return search.top_k(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20, scale=64.0).select(
        F.col("query_id"), "rank", "vec_id", "score")


def op11_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sketches.fingerprints(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        "near_edited", "near_next")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return merkle.manifest(
        table(spark, sf_dir, "documents"), changed=(tampered, {"n_chars": F.col("n_chars") + 1})).drop("path")


QUERIES = {
    "op1_line_spread": op1_line_spread,
    "op2_pack_powers_of_two": op2_pack_powers_of_two,
    "op3_simhash_golay": op3_simhash_golay,
    "op4_language_mixture": op4_language_mixture,
    "op5_hierarchical_mix": op5_hierarchical_mix,
    "op6_sampled_splitters": op6_sampled_splitters,
    "op7_url_cascade": op7_url_cascade,
    "op8_chat_fingerprint": op8_chat_fingerprint,
    "op9_adaptive_rules": op9_adaptive_rules,
    "op10_norm_sorted_search": op10_norm_sorted_search,
    "op11_scaled_sketch": op11_scaled_sketch,
    "op12_collocations": op12_collocations,
    "op13_merkle_manifest": op13_merkle_manifest,
}

def _mix_sql() -> str:
    """The budgets of three levels, one after the other, and then the prefixes."""
    levels = ("domain", "lang", "source")
    sql = [f"""
WITH docs AS (
  SELECT doc_id, CASE WHEN regexp_matches(source, '^src[0-9]{{1,4}}$')
             AND try_cast(substr(source, 4) AS INT) < {5 * len(DOMAINS)}
           THEN {list(DOMAINS)}[1 + try_cast(substr(source, 4) AS INT) // 5] ELSE 'other' END AS domain, lang, source,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS n_words
  FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_words)::BIGINT AS leaf_tokens FROM docs GROUP BY ALL),
b0 AS (SELECT floor(sum(leaf_tokens) * {MIX_SHARE}::DOUBLE) AS budget FROM leaves)"""]
    for depth in range(1, 4):
        keys, parent = levels[:depth], levels[:depth - 1]
        cases = " ".join(
            "WHEN " + " AND ".join(f"{k} = '{v}'" for k, v in zip(keys, path)) + f" THEN {weight}"
            for path, weight in MIX_WEIGHTS.items() if len(path) == depth)
        on = " AND ".join(f"n.{p} IS NOT DISTINCT FROM a.{p}" for p in parent) or "true"
        over = f"PARTITION BY {', '.join(f'n.{p}' for p in parent)}" if parent else ""
        order = f"ORDER BY ratio NULLS LAST, {', '.join(f'n.{k}' for k in keys)}"
        sql.append(f"""
n{depth} AS (
  SELECT *, capacity / weight AS ratio FROM (
    SELECT {', '.join(keys)}, sum(leaf_tokens)::BIGINT * {MIX_EPOCHS} AS capacity,
           CASE {cases} ELSE 1 END AS weight
    FROM leaves GROUP BY {', '.join(keys)})),
r{depth} AS (
  SELECT n.*, a.budget,
    coalesce(sum(capacity) OVER ({over} {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
    sum(weight) OVER ({over} {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM n{depth} n JOIN b{depth - 1} a ON {on}),
f{depth} AS (SELECT *, used + ratio * weights <= budget AS filled FROM r{depth}),
b{depth} AS (
  SELECT {', '.join(f'n.{k}' for k in keys)}, CASE WHEN filled THEN capacity::DOUBLE
    ELSE greatest((budget - sum(CASE WHEN filled THEN capacity ELSE 0 END) OVER ({over}))
      / sum(CASE WHEN filled THEN 0 ELSE weight END) OVER ({over}), 0) * weight END AS budget
  FROM f{depth} n)""".replace("( )", "()"))
    sql.append(f"""
budgets AS (
  SELECT l.*, floor(b.budget)::BIGINT AS leaf_budget,
         CASE WHEN leaf_tokens > 0 THEN floor(b.budget)::BIGINT // leaf_tokens ELSE 0 END AS epochs
  FROM leaves l JOIN b3 b ON l.domain IS NOT DISTINCT FROM b.domain
    AND l.lang IS NOT DISTINCT FROM b.lang AND l.source IS NOT DISTINCT FROM b.source),
keyed AS (
  SELECT d.*, leaf_budget, epochs, leaf_budget - epochs * leaf_tokens AS rest,
         md5('{MIX_SEED}:' || epochs || ':' || coalesce(doc_id::VARCHAR, '')) AS key
  FROM docs d JOIN budgets b ON d.domain IS NOT DISTINCT FROM b.domain
    AND d.lang IS NOT DISTINCT FROM b.lang AND d.source IS NOT DISTINCT FROM b.source),
placed AS (
  SELECT *, sum(n_words) OVER (PARTITION BY domain, lang, source ORDER BY key) - n_words AS before FROM keyed),
counted AS (SELECT *, epochs + CASE WHEN before < rest THEN 1 ELSE 0 END AS copies FROM placed)
SELECT doc_id, domain, lang, source, n_words, copies, leaf_budget FROM counted WHERE copies > 0""")
    return ",".join(sql)


_SKETCH_SQL = rf"""
WITH said AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
paired AS (
  SELECT doc_id, text, length(text) AS n_chars,
         coalesce(lead(text) OVER (ORDER BY doc_id DESC), first_value(text) OVER (ORDER BY doc_id DESC)) AS next
  FROM said),
edited AS (
  SELECT *, substring(text, 1, n_chars - n_chars // 2) || substring(next, 1, n_chars // 2) AS edited FROM paired),
texts AS MATERIALIZED (SELECT text AS t FROM edited UNION SELECT edited FROM edited),
worded AS (SELECT t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM texts),
hashed AS (
  SELECT t, w, [md5(array_to_string(w[i:i + {sketches.SHINGLE - 1}], ' '))
                FOR i IN range(1, greatest(len(w) - {sketches.SHINGLE - 1}, 1) + 1)] AS hs FROM worded),
kept AS (
  SELECT t, w, list_sort(list_distinct([h[1:{sketches.DIGITS}] FOR h IN hs IF h < '{sketches.BELOW}'])) AS k FROM hashed),
prints AS MATERIALIZED (
  SELECT t, k, CASE WHEN len(k) > 0 THEN array_to_string(k, '')
                    ELSE '-' || md5(array_to_string(w, ' '))[1:{sketches.DIGITS}] END AS p FROM kept)
SELECT doc_id, n_chars, sha256(e.edited) AS edited_sha256, a.p AS fingerprint, b.p AS edited_fingerprint,
       CASE WHEN a.p = b.p THEN 1.0 WHEN least(len(a.k), len(b.k)) = 0 THEN 0.0
            ELSE len(list_intersect(a.k, b.k)) / least(len(a.k), len(b.k)) END::DOUBLE AS near_edited,
       CASE WHEN a.p = c.p THEN 1.0 WHEN least(len(a.k), len(c.k)) = 0 THEN 0.0
            ELSE len(list_intersect(a.k, c.k)) / least(len(a.k), len(c.k)) END::DOUBLE AS near_next
FROM edited e JOIN prints a ON a.t = e.text JOIN prints b ON b.t = e.edited JOIN prints c ON c.t = e.next"""


_COLLOCATIONS_SQL = r"""
WITH said AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
worded AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM said),
singles AS MATERIALIZED (SELECT lang, x, count(*) AS f FROM (SELECT lang, unnest(w) AS x FROM worded) GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM singles GROUP BY lang),
pairs AS MATERIALIZED (
  SELECT lang, p[1] AS x, p[2] AS y, count(*) AS a
  FROM (SELECT lang, unnest([w[i:i + 1] FOR i IN range(1, len(w))]) AS p FROM worded) GROUP BY ALL HAVING count(*) >= 10),
triples AS MATERIALIZED (
  SELECT lang, p[1] AS x, p[2] AS y, p[3] AS z, count(*) AS a
  FROM (SELECT lang, unnest([w[i:i + 2] FOR i IN range(1, len(w) - 1)]) AS p FROM worded) GROUP BY ALL HAVING count(*) >= 10),
scored2 AS (
  SELECT p.lang, p.x, p.y, p.a, u.f AS l, v.f AS r, (1000000::HUGEINT * p.a * p.a // (u.f::HUGEINT * v.f))::BIGINT AS score
  FROM pairs p JOIN singles u ON u.lang = p.lang AND u.x = p.x JOIN singles v ON v.lang = p.lang AND v.x = p.y),
cut3 AS (
  SELECT t.lang, t.x, t.y, t.z, t.a, u.l AS l1, v.a AS r1, u.a AS l2, v.r AS r2,
         (1000000::HUGEINT * t.a * t.a // (u.l::HUGEINT * v.a))::BIGINT AS s1,
         (1000000::HUGEINT * t.a * t.a // (u.a::HUGEINT * v.r))::BIGINT AS s2
  FROM triples t JOIN scored2 u ON u.lang = t.lang AND u.x = t.x AND u.y = t.y
  JOIN scored2 v ON v.lang = t.lang AND v.x = t.y AND v.y = t.z),
around AS (
  SELECT lang, x, y, max(a) AS longer
  FROM (SELECT lang, x, y, a FROM triples UNION ALL SELECT lang, y, z, a FROM triples) GROUP BY ALL),
candidates AS (
  SELECT s.lang, s.x || ' ' || s.y AS phrase, s.a, s.l, s.r, s.score
  FROM scored2 s LEFT JOIN around o ON o.lang = s.lang AND o.x = s.x AND o.y = s.y
  WHERE o.longer IS NULL OR 100 * o.longer < 50 * s.a
  UNION ALL
  SELECT lang, x || ' ' || y || ' ' || z, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END,
         CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2) FROM cut3),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM candidates)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""


def _framed_sql(value: str) -> str:
    return (f"CASE WHEN {value} IS NULL THEN '-' ELSE "
            f"octet_length(encode({value}::VARCHAR))::VARCHAR || ':' || {value}::VARCHAR END")


def _leaf_sql(n_chars: str) -> str:
    return "sha256(" + " || ".join(map(_framed_sql, ("doc_id", "source", "lang", n_chars, "text"))) + ")"


# CRC-32 bit by bit, with the reversed polynomial and all bits set at both ends.
_CRC_SQL = """xor(list_reduce([4294967295] || [ord(c) FOR c IN string_split(doc_id::VARCHAR, '')],
  lambda crc, byte: list_reduce([xor(crc, byte)] || [0 FOR _ IN range(8)],
    lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295)"""

_MERKLE_SQL = f"""
WITH RECURSIVE leaves AS MATERIALIZED (
  SELECT doc_id, lang, {_leaf_sql('n_chars')} AS leaf,
         CASE WHEN {_CRC_SQL} % 7 = 0 THEN {_leaf_sql('(n_chars + 1)')} ELSE {_leaf_sql('n_chars')} END AS middle,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos
  FROM documents),
nodes(lang, level, pos, h, n) AS (
  SELECT lang, 0, pos, leaf, count(*) OVER (PARTITION BY lang) FROM leaves
  UNION ALL
  SELECT lang, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 1) // 2
  FROM nodes WHERE n > 1 GROUP BY lang, level, pos // 2),
langs AS MATERIALIZED (
  SELECT lang, h AS subroot, level AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place
  FROM nodes WHERE n = 1),
upper(level, pos, h, n) AS (
  SELECT 0, place, subroot, count(*) OVER () FROM langs
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 1) // 2
  FROM upper WHERE n > 1 GROUP BY level, pos // 2),
climb AS (
  SELECT l.doc_id, l.lang, level.n AS level, (l.pos >> level.n::INT) AS p
  FROM leaves l JOIN langs g ON l.lang IS NOT DISTINCT FROM g.lang, LATERAL (SELECT unnest(range(g.height)) AS n) level),
steps AS (
  SELECT c.doc_id, c.level, coalesce(s.h, '') AS sibling, c.p & 1 = 1 AS on_left
  FROM climb c LEFT JOIN nodes s
    ON s.lang IS NOT DISTINCT FROM c.lang AND s.level = c.level AND s.pos = xor(c.p, 1::BIGINT)
  UNION ALL
  SELECT l.doc_id, 1000 + level.n, coalesce(s.h, ''), (g.place >> level.n::INT) & 1 = 1
  FROM leaves l JOIN langs g ON l.lang IS NOT DISTINCT FROM g.lang,
    LATERAL (SELECT unnest(range((SELECT max(level) FROM upper))) AS n) level
    LEFT JOIN upper s ON s.level = level.n AND s.pos = xor(g.place >> level.n::INT, 1::BIGINT)),
proof AS (
  SELECT doc_id, sha256(string_agg(sibling, '' ORDER BY level)) AS proof_sha256,
         list(CASE WHEN on_left THEN [sibling, ''] ELSE ['', sibling] END ORDER BY level) AS steps
  FROM steps GROUP BY doc_id),
folded AS (
  SELECT l.doc_id, l.lang, leaf, coalesce(proof_sha256, sha256('')) AS proof_sha256,
         list_reduce([[middle, '']] || coalesce(steps, []), lambda a, s: [sha256(s[1] || a[1] || s[2]), ''])[1] AS folded_root
  FROM leaves l LEFT JOIN proof USING (doc_id))
SELECT f.doc_id, leaf, subroot, r.h AS root, proof_sha256, folded_root, folded_root = r.h AS verified
FROM folded f JOIN langs g ON f.lang IS NOT DISTINCT FROM g.lang, (SELECT h FROM upper WHERE n = 1) r"""

_ESCAPED = "replace(replace({0}, '&', '&amp;'), '<', '&lt;')"
ORACLE_SQL = {
    "op1_line_spread": rf"""
WITH cut AS (
  SELECT doc_id, source, text, string_split(text, chr(10)) AS ls FROM documents),
numbered AS (
  SELECT doc_id, source, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM cut),
said AS (
  SELECT *, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS content FROM numbered),
shared AS (
  SELECT content, min(doc_id) AS owner FROM said WHERE content <> '' GROUP BY content
  HAVING count(DISTINCT coalesce(source, '')) >= {MIN_SITES}),
marked AS (
  SELECT doc_id, pos, line, owner IS NOT NULL AND doc_id <> owner AS gone
  FROM said LEFT JOIN shared USING (content))
SELECT doc_id,
       CASE WHEN any_value(d.text) IS NULL THEN NULL
            ELSE coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') END AS text,
       count(line) AS n_lines, count(*) FILTER (gone) AS n_removed
FROM documents d LEFT JOIN marked USING (doc_id) GROUP BY doc_id""",
    "op7_url_cascade": r"""
WITH cut AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM cut)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
  WHEN rule IS NOT NULL THEN 'allow'
  WHEN md5(host || path) LIKE '0%' THEN 'block' ELSE 'allow' END AS verdict
FROM ruled""",
    "op8_chat_fingerprint": rf"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '{CONTROL_TEXT}'), (-7, 1, 'assistant', '{CONTROL_TEXT}'))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum({len("<turn></turn>") + 2} + length(replace({_ESCAPED.format('role')}, chr(10), '&#10;'))
      + length({_ESCAPED.format('text')}))::BIGINT AS formatted_chars
FROM said GROUP BY conv_id""",
    "op5_hierarchical_mix": _mix_sql(),
    "op11_scaled_sketch": _SKETCH_SQL,
    "op12_collocations": _COLLOCATIONS_SQL,
    "op13_merkle_manifest": _MERKLE_SQL,
    "op10_norm_sorted_search": """
WITH v AS (
  SELECT vec_id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""",
}
