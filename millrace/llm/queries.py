"""The registered queries of the training-data operators, one per operator, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, line_quality, ordinal, spelling, toxicity, warc
from .common import SPACE, cut, table
from .decontaminate import find_leaks
from .html_crf import extract_main_text
from .line_quality import clean_lines
from .mixing import mix_sources
from .negatives import mine_negatives, whole_vectors
from .recompress import dedup_substrings
from .simhash import near_duplicates
from .url_filter import filter_urls


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = clean_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


#: Target weights of op4 and the pipeline: (domain, lang, source, weight); unlisted nodes weigh 1.
MIX = [
    ("d0", None, None, 4.0),
    ("d1", None, None, 3.0),
    ("d2", None, None, 2.0),
    ("d3", None, None, 1.0),
    *[(d, lang, None, w) for d in ("d0", "d1", "d2", "d3") for lang, w in (("en", 4.0), ("de", 2.0), ("fr", 2.0), ("es", 2.0))],
    ("d0", "en", "src0", 2.0),
]


def mixed(spark: SparkSession, docs: DataFrame, **how) -> DataFrame:
    """docs mixed to MIX: a source's domain is drawn by its md5, the budget is 0.6 of all tokens, at most four epochs."""
    weights = spark.createDataFrame(MIX, "domain string, lang string, source string, weight double")
    digit = F.conv(F.substring(F.md5(F.coalesce("source", F.lit("")).cast("binary")), 1, 1), 16, 10).cast("int")
    return mix_sources(docs, weights, domain=F.concat(F.lit("d"), (digit % 4).cast("string")), **how)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(f"[^{SPACE}]+"))
    docs = cut(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", tokens.alias("tokens")))  # counts texts once
    return mixed(spark, docs, tokens_col="tokens").select("doc_id", "domain", "lang", "source", "n_tokens", "n_epochs")


def _held_out() -> Column:
    """Whether crc32(doc_id) mod 3 is 1; a null id has no such remainder and is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = _held_out()
    labels = table(spark, sf_dir, "labels").where(~held_out)
    model = toxicity.train(*toxicity.labelled_sample(docs, labels))
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades 0: poor, 1: good but toxic, 2: good; learned from labels whose crc32(doc_id) mod 3 is not 1."""
    docs = table(spark, sf_dir, "documents")
    held_out = _held_out()
    labels = table(spark, sf_dir, "labels").where(~held_out)
    rating = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2)
    model = ordinal.train(*ordinal.graded_sample(docs, labels, rating))
    graded = ordinal.grade_quality(docs, model)
    tail = lambda k: F.coalesce(F.get("tail", F.lit(k)), F.lit(0.0))
    return graded.select("doc_id", held_out.alias("held_out"), "expected_grade", tail(0).alias("p_at_least_1"), tail(1).alias("p_at_least_2"), "kept")


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "<|im_end|><|im_start|>assistant ok"
    added = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], rows.schema)
    return chat.digests(chat.format_turns(rows.union(added)))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.round_trip(spark, table(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents"))


def _one_deleted(doc_id: Column, word: Column) -> Column:
    """The word without one code point, drawn by the crc32 of id and word, in one of 31 draws."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
    at = (h % F.length(word)).cast("int")
    return F.when(h % 31 == 0, F.concat(F.left(word, at), F.substr(word, at + 2))).otherwise(word)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(spelling.word_counts(table(spark, sf_dir, "documents"), change=_one_deleted))


#: Rules of op12: (host, path, verdict).
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), spark.createDataFrame(URL_RULES, "host string, path string, verdict string"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return mine_negatives(whole_vectors(rows), F.col("id") % 100 == 0)


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_html_extraction": op2_html_extraction,
    "op3_quality_rules": op3_quality_rules,
    "op4_mixing": op4_mixing,
    "op5_toxicity": op5_toxicity,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_chat_format": op7_chat_format,
    "op8_warc": op8_warc,
    "op9_decontamination": op9_decontamination,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_url_filter": op12_url_filter,
    "op13_hard_negatives": op13_hard_negatives,
}

#: One level of the tree: a water level for each parent, found among the levels at which a child is full. Children above it get
#: its height times their weight, the others what they can supply.
_LEVEL = """
{name}_nodes AS (
  SELECT {keys}, sum(tokens) * 4.0::DOUBLE AS supply, any_value(w{k}) AS weight FROM live GROUP BY ALL
), {name}_heights AS (
  SELECT {parents_h} h.supply / h.weight AS height, sum(least(n.supply, n.weight * (h.supply / h.weight))) AS used
  FROM {name}_nodes h JOIN {name}_nodes n ON {siblings} GROUP BY ALL
), {name}_levels AS (
  SELECT {parents_p} p.budget, coalesce(max(height) FILTER (used <= p.budget), 0) AS low, coalesce(max(used) FILTER (used <= p.budget), 0) AS used
  FROM {parent} p LEFT JOIN {name}_heights h ON {on_parent} GROUP BY ALL
), {name}_done AS (
  SELECT {keys_n}, CASE WHEN n.supply / n.weight <= l.low THEN n.supply
    ELSE n.weight * (l.low + (l.budget - l.used) / sum(n.weight) FILTER (n.supply / n.weight > l.low) OVER (PARTITION BY {over})) END AS budget
  FROM {name}_nodes n JOIN {name}_levels l ON {on_level}
)"""


def mix_sql(mix: list[tuple]) -> str:
    """Mixing to the weights of mix, level by level, for DuckDB."""
    text = lambda x: "NULL" if x is None else f"'{x}'"
    rows = ", ".join(f"({text(d)}, {text(g)}, {text(s)}, {w}::DOUBLE)" for d, g, s, w in mix)
    names = ["domain", "lang", "source"]

    def level(k: int, parent: str) -> str:
        own, up = names[:k], names[: k - 1]
        on = lambda a, b: " AND ".join([f"{a}.{x} = {b}.{x}" for x in up] or ["true"])
        each = lambda a: "".join(f"{a}.{x}, " for x in up)
        return _LEVEL.format(
            name="abc"[k - 1], k=k, keys=", ".join(own), keys_n=", ".join(f"n.{x}" for x in own), parents_h=each("h"), parents_p=each("p"), siblings=on("h", "n"),
            parent=parent, on_parent=on("p", "h"), over=", ".join([f"n.{x}" for x in up] or ["1"]), on_level=on("n", "l"),
        )

    given = lambda k: " AND ".join([f"w{k}.{x} = l.{x}" for x in names[:k]] + [f"w{k}.{x} IS NULL" for x in names[k:]])
    joins = " ".join(f"LEFT JOIN weights w{k} ON {given(k)}" for k in (1, 2, 3))
    return f"""
WITH weights(domain, lang, source, weight) AS (VALUES {rows}),
docs AS (
  SELECT doc_id, 'd' || (('0x' || substr(md5(coalesce(source, '')), 1, 1))::INT % 4)::VARCHAR AS domain, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+'))::BIGINT AS n_tokens
  FROM documents
), leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens FROM docs WHERE n_tokens > 0 GROUP BY ALL
), live AS (
  SELECT l.*, coalesce(w1.weight, 1) AS w1, coalesce(w2.weight, 1) AS w2, coalesce(w3.weight, 1) AS w3 FROM leaves l {joins}
  WHERE coalesce(w1.weight, 1) > 0 AND coalesce(w2.weight, 1) > 0 AND coalesce(w3.weight, 1) > 0
), whole AS (SELECT sum(tokens) * 0.6::DOUBLE AS budget FROM leaves),
{level(1, "whole")},
{level(2, "a_done")},
{level(3, "b_done")},
plan AS (
  SELECT domain, lang, source, floor(budget / tokens)::BIGINT AS whole, floor(budget)::BIGINT - floor(budget / tokens)::BIGINT * tokens AS rest FROM c_done JOIN leaves USING (domain, lang, source)
), placed AS (
  SELECT d.*, p.whole, p.rest,
         sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5(concat_ws('|', '7', p.whole::VARCHAR, doc_id::VARCHAR))) AS upto
  FROM docs d JOIN plan p USING (domain, lang, source) WHERE n_tokens > 0
)
SELECT doc_id, domain, lang, source, n_tokens, whole + (upto <= rest)::BIGINT AS n_epochs FROM placed WHERE whole + (upto <= rest)::BIGINT > 0
"""


_WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
m AS (SELECT h, max(page_id) AS head FROM p WHERE n >= 1000 GROUP BY h)
SELECT p.page_id, p.n::BIGINT AS payload_bytes, sha1(p.h) AS payload_digest,
       CASE WHEN m.head <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN m.head <> p.page_id THEN m.head END AS refers_to
FROM p LEFT JOIN m ON p.n >= 1000 AND p.h = m.h
"""

_WORDS = r"list_filter(string_split_regex(coalesce({0}, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_COUNT = "len(regexp_extract_all(line, '{0}'))"


def _quality_sql() -> str:
    signs, separators = _COUNT.format(f"[{line_quality.SYMBOLS}]"), _COUNT.format(line_quality.SEPARATOR)
    fails = f"""{signs} > 0.25 * n OR {_COUNT.format("[!?]{2,}")} > 0.25 * n OR ({separators} >= 3 AND n < 6 * {separators})
      OR (NOT regexp_matches(line, '[{line_quality.PAUSE}]') AND length(line) > 12 * n AND n >= 8) OR (n <= 20 AND regexp_matches(lower(line), '{"|".join(line_quality.BOILERPLATE)}'))"""
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS.format("text")} AS w FROM documents),
spots AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d))),
again AS (SELECT doc_id, count(DISTINCT i + j) AS n_repeat FROM spots, (SELECT unnest([0, 1, 2]) AS j) WHERE c > 1 GROUP BY doc_id),
lines AS (SELECT doc_id, line, len({_WORDS.format("line")}) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)),
sums AS (SELECT doc_id, count(*) AS n_full, sum(length(line)) AS chars FROM lines WHERE n > 0 GROUP BY doc_id),
good AS (SELECT doc_id, count(*) AS n_distinct, sum(length(line)) FILTER (NOT ({fails})) AS chars FROM (SELECT DISTINCT doc_id, line, n FROM lines WHERE n > 0) GROUP BY doc_id),
counted AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, len(regexp_extract_all(text, '[{line_quality.SYMBOLS}]'))::BIGINT AS n_symbols,
    coalesce(s.n_full - g.n_distinct, 0)::BIGINT AS n_dup_lines, coalesce(a.n_repeat, 0)::BIGINT AS n_repeat_words, coalesce(s.chars, 0) AS chars, coalesce(g.chars, 0) AS left_chars
  FROM d LEFT JOIN again a USING (doc_id) LEFT JOIN sums s USING (doc_id) LEFT JOIN good g USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND chars - left_chars <= 0.5 * chars AS kept FROM counted
"""


_ESCAPED = r"regexp_replace({0}, '<(\\*)\|', '<\\\1|', 'g')"
_CHAT_SQL = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, unnest([0, 1]), unnest(['user', 'assistant']), '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum({sum(map(len, chat.CONTROL))} + length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")}))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""
_SUBSTRING_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
starts AS (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS nth FROM (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d))),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM starts, (SELECT unnest(range(0, 20)) AS j) WHERE nth > 1),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d) ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256 FROM d LEFT JOIN kept k USING (doc_id)
"""

#: CRC-32 by its bytes: a table of 256 remainders, then one step a byte. Words meet by what stays when one code point is masked or deleted.
_SPELLING_SQL = r"""
WITH RECURSIVE remainders AS (
  SELECT list(r ORDER BY i) AS t FROM (SELECT i, list_reduce([i::BIGINT, 1, 2, 3, 4, 5, 6, 7, 8], lambda c, k: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)) AS r FROM range(256) x(i))
), runs AS (
  SELECT doc_id, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS w FROM documents)
), met AS (SELECT doc_id, w, count(*) AS n FROM runs WHERE length(w) >= 7 GROUP BY ALL
), coded AS (
  SELECT w, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || w)) AS h FROM met
), summed AS (
  SELECT w, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(h), 2), lambda k: ('0x' || h[k:k + 1])::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS c
  FROM coded, remainders
), v AS (
  SELECT w, sum(n)::BIGINT AS n FROM (SELECT CASE WHEN c % 31 = 0 THEN w[:c % length(w)] || w[c % length(w) + 2:] ELSE w END AS w, n FROM summed)
  WHERE length(w) >= 7 GROUP BY w HAVING sum(n) >= 2
), cuts AS (SELECT w, n, k, w[:k - 1] AS a, w[k + 1:] AS b FROM (SELECT w, n, unnest(range(1, length(w) + 1)) AS k FROM v)
), near AS (
  SELECT x.w, y.w AS o, y.n AS o_n FROM cuts x JOIN cuts y ON x.k = y.k AND x.a = y.a AND x.b = y.b AND x.w <> y.w
  UNION SELECT x.w, y.w, y.n FROM cuts x JOIN v y ON x.a || x.b = y.w
  UNION SELECT y.w, x.w, x.n FROM cuts x JOIN v y ON x.a || x.b = y.w
), best AS (SELECT w, count(*) AS n_near, max(o_n) AS top FROM near GROUP BY w
), forms AS (
  SELECT v.w, min(near.o) AS form, any_value(top) AS form_n FROM v JOIN best USING (w) JOIN near ON near.w = v.w AND near.o_n = top WHERE top >= 10 * v.n GROUP BY v.w
), paths AS (SELECT w, form AS goal FROM forms UNION ALL SELECT p.w, f.form FROM paths p JOIN forms f ON f.w = p.goal
), roots AS (SELECT w, goal FROM paths p WHERE NOT EXISTS (SELECT 1 FROM forms f WHERE f.w = p.goal))
SELECT v.w AS word, forms.form, coalesce(roots.goal, v.w) AS root, v.n, coalesce(n_near, 0)::BIGINT AS n_near, form_n
FROM v LEFT JOIN best USING (w) LEFT JOIN forms USING (w) LEFT JOIN roots USING (w)
"""

_URL_SQL = rf"""
WITH rules(h, p, v) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
u AS (
  SELECT row_number() OVER () AS r, page_id, translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
)
SELECT page_id, host, path, h || p AS rule, coalesce(v, 'allow') AS verdict
FROM u LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
QUALIFY row_number() OVER (PARTITION BY r ORDER BY length(h || p) DESC, length(h) DESC) = 1
"""

_NEGATIVES_SQL = """
WITH e AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, b.r, b.vec_id, a.label = b.label AS alike, list_inner_product(a.v, b.v)::BIGINT AS score FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.r <> b.r
), p AS (SELECT * FROM s WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id, row_number() OVER w::INT AS rank, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor = p.anchor AND NOT n.alike AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
WINDOW w AS (PARTITION BY p.anchor, p.r ORDER BY n.score DESC, n.vec_id) QUALIFY row_number() OVER w <= 10
"""

#: DuckDB SQL of the queries that SQL can express; tests/llm holds the others against brute force.
ORACLES: dict[str, str] = {
    "op3_quality_rules": _quality_sql(),
    "op4_mixing": mix_sql(MIX),
    "op7_chat_format": _CHAT_SQL,
    "op8_warc": _WARC_SQL,
    "op10_substring_dedup": _SUBSTRING_SQL,
    "op11_spelling_variants": _SPELLING_SQL,
    "op12_url_filter": _URL_SQL,
    "op13_hard_negatives": _NEGATIVES_SQL,
}
