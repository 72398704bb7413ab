"""The operators over the driver's tables, with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from umbra.llm import bpe, collocations, langid, licenses, neardup, packing, quality, ranked, secrets, sharding, suffixes, topk, toxicity
from umbra.llm.common import held_out, load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


# ------------------------------------------------------------- quality rules
def _listed(words) -> str:
    return ", ".join(f"'{w}'" for w in sorted(set(words)))


_W = r"[^\x20\x09-\x0D]+"
QUALITY_SQL = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '{_W}') AS w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_W}')) AS ln FROM t),
pos AS (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM w WHERE len(w) > 2),
tri AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM pos),
hit AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
        FROM (SELECT doc_id, i, unnest([0, 1, 2]) AS k FROM tri WHERE n > 1) GROUP BY doc_id),
m AS (SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(ln) - len(list_distinct(ln)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
        len(list_filter(w, lambda x: x IN ({_listed(quality.STOP_WORDS)}))) AS n_stop, len(ln) AS n_lines,
        len(list_filter(ln, lambda x: regexp_matches(x, '^ *[-*•]'))) AS n_bullet,
        len(list_filter(ln, lambda x: regexp_matches(x, '(\.\.\.|…) *$'))) AS n_ellipsis
      FROM w LEFT JOIN hit USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars >= 2.0 * n_words AND word_chars <= 15.0 * n_words
  AND n_symbols <= 0.25 * n_words AND n_stop >= 0.02 * n_words AND n_dup_lines <= 0.5 * n_lines
  AND n_bullet <= 0.9 * n_lines AND n_ellipsis <= 0.5 * n_lines AS kept FROM f"""


@query("op4_quality_rules", QUALITY_SQL)
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(load(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


# ------------------------------------------------------------- tokens
@query("op7_best_fit_packing")
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(load(spark, sf_dir, "documents"))


@query("op8_bpe_codec")
def op8_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_documents(load(spark, sf_dir, "documents"), decoded=True)
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256")
    )


# ------------------------------------------------------------- near duplicates
@query("op9_minhash_near_dedup")
def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(load(spark, sf_dir, "documents"))


# ------------------------------------------------------------- repeated passages
@query("op3_suffix_array_dedup")
def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffixes.repeats_removed(load(spark, sf_dir, "documents"), passage=suffixes.PASSAGE_BYTES)
    return kept.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), suffixes.whole_characters(F.col("kept")).alias("text"),
        "n_passage_bytes", "n_passages", suffixes.whole_characters(F.col("kept_of_passages")).alias("text_without_passages"),
    )


# ------------------------------------------------------------- secrets
_NAMES = "[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
_QUOTE = """["'']?"""
_ASSIGN = rf"({_NAMES}){_QUOTE}\x20*[:=]\x20*{_QUOTE}([A-Za-z0-9+/_.=-]+)"


def _found_sql(kind: int, pattern: str, group: int, least: int) -> str:
    """Matches of one kind; what lies before the n-th one is the first n gaps and n - 1 matches."""
    return f"""SELECT doc_id, source, text_md5, {kind} AS kind, w[i] AS w, v[i] AS v,
      list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(w[1:i-1], lambda x: length(x))), 0) AS s
    FROM (SELECT doc_id, source, text_md5, w, v, g, unnest(generate_series(1, len(w))) AS i FROM (
      SELECT doc_id, source, md5(t) AS text_md5, regexp_extract_all(t, '{pattern}') AS w, regexp_extract_all(t, '{pattern}', {group}) AS v,
        string_split_regex(t, '{pattern}') AS g FROM t) WHERE len(w) > 0)
    WHERE length(v[i]) >= {least}"""


_FOUND = " UNION ALL ".join(
    _found_sql(i, _ASSIGN if k.name == "assign" else k.pattern, k.value, k.least) for i, k in enumerate((*secrets.BASE, secrets.LIVE))
)
SECRETS_SQL = rf"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
f AS ({_FOUND}),
c AS (SELECT doc_id, source, text_md5, kind, CAST(s AS BIGINT) AS s, CAST(s + length(w) AS BIGINT) AS e, v,
  regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]') AND len(list_distinct(string_split(v, ''))) >= {secrets.LEAST_CHARACTERS} AS random FROM f),
k AS (SELECT * FROM c WHERE kind < 3 OR random AND NOT EXISTS (
  SELECT 1 FROM c b WHERE b.kind < 3 AND b.doc_id = c.doc_id AND b.s < c.e AND c.s < b.e)),
h AS (SELECT v, text_md5, min(CAST(source AS VARCHAR)) AS owner, min(CAST(doc_id AS VARCHAR)) AS repository FROM k GROUP BY v, text_md5),
o AS (SELECT v, count(DISTINCT coalesce(owner, '')) AS n_owners, count(DISTINCT coalesce(repository, '')) AS n_repositories,
  n_owners > {secrets.MAX_OWNERS} OR n_repositories > {secrets.MAX_REPOSITORIES} AS copied FROM h GROUP BY v),
j AS (SELECT doc_id, kind, s, e, ['assign', 'access', 'hex', 'live'][kind + 1] || ':' || s || ':' || e AS x,
  random AND NOT copied AS live, copied AS example, n_repositories FROM k JOIN o USING (v)),
r AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
  coalesce(string_agg(x, ',' ORDER BY s, kind) FILTER (kind < 3), '') AS base, string_agg(x, ',' ORDER BY s, kind) AS spans,
  count(*) FILTER (live) AS n_live, count(*) FILTER (example) AS n_example, max(n_repositories) AS n_repositories
  FROM j WHERE kind < 3 OR live GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example, coalesce(n_repositories, 0) AS n_repositories
FROM t LEFT JOIN r USING (doc_id)"""


@query("op2_secret_scan", SECRETS_SQL)
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secrets(load(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_live", "n_example", "n_repositories")


# ------------------------------------------------------------- language
@query("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").withColumn("held_out", held_out())
    return langid.languages(docs, ~F.col("held_out"), keep=("doc_id", "held_out"))


# ------------------------------------------------------------- toxicity
@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").withColumn("held_out", held_out())
    return toxicity.toxicity(docs, load(spark, sf_dir, "labels"), ~F.col("held_out"), keep=("doc_id", "held_out"))


# ------------------------------------------------------------- exact search
TOPK_SQL = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({topk.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND NOT list_bool_or(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)))),
s AS (SELECT a.vec_id AS query_id, b.vec_id, list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM r WHERE rank <= {topk.K}"""


@query("op6_exact_topk", TOPK_SQL)
def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


# ------------------------------------------------------------- licences
def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _canonical_sql(text: str) -> str:
    t = f"regexp_replace(lower({text}), {_quoted(licenses.COPYRIGHT)}, '', 'g')"
    t = f"' ' || trim(regexp_replace({t}, {_quoted(licenses.OTHER)}, ' ', 'g')) || ' '"
    for given, one in licenses.SPELLINGS:
        t = f"replace({t}, ' {given} ', ' {one} ')"
    return f"sha256(trim({t}))"


def _known_sql(texts: dict[str, str]) -> str:
    values = ", ".join(f"({_quoted(k)}, {_quoted(v)})" for k, v in texts.items())
    return f"SELECT min(id) AS id, {_canonical_sql('t')} AS digest FROM (VALUES {values}) AS x(id, t) GROUP BY 2"


LICENSE_SQL = f"""
WITH known AS ({_known_sql(licenses.TEXTS)}), notice AS ({_known_sql(licenses.NOTICES)}),
d AS (SELECT doc_id, coalesce(text, '') AS t, {_canonical_sql("coalesce(text, '')")} AS digest FROM documents),
l AS (SELECT doc_id, {_canonical_sql('line')} AS digest
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(lower(line), '{licenses.MARK}')),
n AS (SELECT doc_id, string_agg(DISTINCT id, ',' ORDER BY id) AS notices FROM l JOIN notice USING (digest) GROUP BY doc_id)
SELECT doc_id, d.digest, known.id AS license_id, coalesce(notices, '') AS notices
FROM d LEFT JOIN known USING (digest) LEFT JOIN n USING (doc_id)"""


@query("op5_license_scan", LICENSE_SQL)
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts, notices = licenses.known(spark), licenses.known(spark, licenses.NOTICES)
    found = licenses.licenses(load(spark, sf_dir, "documents"), texts, notices)
    return found.select("doc_id", "digest", "license_id", F.array_join("notices", ",").alias("notices"))


# ------------------------------------------------------------- sharding
def _draw_sql(key: str, salt: str) -> str:
    return f"CAST('0x' || substring(md5({key} || ':{salt}'), 1, {sharding.DRAW_BITS // 4}) AS BIGINT)"


_DISTANCES = ", ".join(f"-ln(({_draw_sql('k', str(i))} + 0.5) / {float(1 << sharding.DRAW_BITS)})" for i in range(sharding.SHARDS + 1))
# A text's CRC-32 byte by byte; the table of 256 values follows from the polynomial.
SHARDING_SQL = f"""
WITH c AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda x, k: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))) AS crc),
t AS (SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS k, coalesce(text, '') AS t FROM documents),
d AS (SELECT doc_id, CAST(octet_length(encode(t)) + 1 AS BIGINT) AS size, [{_DISTANCES}] AS far,
  xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda h: CAST('0x' || h AS BIGINT))),
    lambda x, b: xor(x >> 8, crc[(xor(x, b) & 255) + 1])), 4294967295) AS text_crc32 FROM t, c),
s AS (SELECT doc_id, size, text_crc32, list_position(far[1:{sharding.SHARDS}], list_min(far[1:{sharding.SHARDS}])) - 1 AS shard,
  list_position(far, list_min(far)) - 1 AS grown_shard FROM d),
o AS (SELECT *, coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || size || ':' || text_crc32 || ':' || shard || ':' || grown_shard AS r FROM s)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard, CAST(grown_shard AS INTEGER) AS grown_shard,
  row_number() OVER (PARTITION BY shard ORDER BY {_draw_sql('r', 'slot')}, doc_id, size, text_crc32) - 1 AS slot FROM o"""


@query("op11_rendezvous_sharding", SHARDING_SQL)
def op11_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(load(spark, sf_dir, "documents"))


# ------------------------------------------------------------- ranked search
_UPPER = f"'{ranked.UPPER}', '{ranked.LOWER}'"
_TERMS = f"regexp_extract_all(translate(coalesce(text, ''), {_UPPER}), '{ranked.TERM}')"
RANKED_SQL = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS t FROM documents),
s AS (SELECT count(*) FILTER (len(t) > 0) AS nn, greatest(1, CAST(sum(len(t)) AS BIGINT)) AS ll FROM d),
p AS (SELECT doc_id, any_value(len(t)) AS n, x AS term, count(*) AS tf FROM (SELECT doc_id, t, unnest(t) AS x FROM d) GROUP BY doc_id, x),
w AS (SELECT term, CAST(floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY term, nn),
q AS (SELECT item_id, x AS term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS x FROM benchmark) GROUP BY item_id, x),
r AS (SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nn) // ll)))) AS BIGINT) AS score
  FROM q JOIN p USING (term) JOIN w USING (term), s GROUP BY item_id, doc_id),
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM r WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= {ranked.K}"""


@query("op12_ranked_search", RANKED_SQL)
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.ranked(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


# ------------------------------------------------------------- collocations
_PHRASES = " UNION ALL ".join(
    f"SELECT lang, array_to_string(w[i:i + {k - 1}], ' ') AS p, {k} AS size FROM (SELECT lang, w, unnest(range(1, len(w) - {k - 2})) AS i FROM w)"
    for k in range(1, collocations.LONGEST + 1)
)
_FIRST, _REST = "array_to_string(string_split(p, ' ')[1:k], ' ')", "array_to_string(string_split(p, ' ')[k + 1:], ' ')"
COLLOCATIONS_SQL = rf"""
WITH s AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), {_UPPER}), '[.,;:!?
-
]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM s),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
f AS (SELECT lang, p, size, count(*) AS f FROM ({_PHRASES}) GROUP BY lang, p, size HAVING count(*) >= {collocations.LEAST}),
x AS (SELECT lang, string_split(p, ' ') AS v, f FROM f WHERE size > 2),
gone AS (SELECT lang, array_to_string(v[2:], ' ') AS p, f FROM x UNION SELECT lang, array_to_string(v[1:len(v) - 1], ' '), f FROM x),
c AS (SELECT * FROM f WHERE size > 1 AND NOT EXISTS (SELECT 1 FROM gone g WHERE g.lang = f.lang AND g.p = f.p AND g.f = f.f)),
k AS (SELECT lang, p, f AS a, {_FIRST} AS u, {_REST} AS v, k FROM (SELECT *, unnest(range(1, size)) AS k FROM c)),
e AS (SELECT k.lang, k.p AS phrase, a, k, l.f AS l, r.f AS r, n, CAST((1000::HUGEINT * a * n) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM k JOIN n USING (lang) JOIN f l ON l.lang = k.lang AND l.p = u JOIN f r ON r.lang = k.lang AND r.p = v),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS i FROM e),
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS INTEGER) AS rank FROM b WHERE i = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM o WHERE rank <= {collocations.MOST}"""


@query("op13_collocation_mining", COLLOCATIONS_SQL)
def op13_collocation_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(load(spark, sf_dir, "documents"))
