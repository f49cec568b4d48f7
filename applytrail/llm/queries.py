"""One registered query per operator, over whole tables; oracle SQL where SQL can tell the answer."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from applytrail.llm import (
    decontamination,
    language_id,
    line_dedup,
    phrases,
    pieces,
    quality_model,
    quality_rules,
    secrets,
    simhash,
    spellings,
    token_counts,
    toxicity,
    warc,
)
from applytrail.llm.common import fold, prepare, table, whole_text

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

WORD_VOCABULARY = "word_bpe_49k.json"
PIECE_VOCABULARY = "piece_bpe_32k.model"


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: fn(prepare(spark), sf_dir)
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return register


def _quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


_RULES_SQL = f"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS t,
    [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') IF x <> ''] AS w,
    [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM split)),
repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM repeated, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
counts AS (
  SELECT split.doc_id, len(w) AS n_words,
    length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(covered.n, 0) AS n_repeat_words,
    len([x FOR x IN w IF lower(x) IN ({_quoted(sorted({w for v in quality_rules.STOP_WORDS.values() for w in v}))})])
      AS n_stop_words,
    len([x FOR x IN w IF x = upper(x) AND x <> lower(x)]) AS n_capital_words,
    len(lines) AS n_lines
  FROM split LEFT JOIN covered USING (doc_id)),
ratios AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS word_length,
    CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbols,
    CASE WHEN n_words > 0 THEN n_stop_words / n_words ELSE 0 END AS stop_words,
    CASE WHEN n_words > 0 THEN n_capital_words / n_words ELSE 0 END AS capitals,
    CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS repeated_lines
  FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_length BETWEEN 2 AND 15 AND symbols <= 0.3 AND stop_words >= 0.01 AND capitals <= 0.6
    AND repeated_lines <= 0.6 AS kept
FROM ratios
"""


@query("op7_quality_rules", _RULES_SQL)
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op4_simhash_near_dedup")
def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), simhash.hex16(F.col("fp")).alias("fingerprint"),
                       F.col("component").alias("component_id"))


@query("op10_token_counts")
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_VOCABULARY))
    return rows.withColumnRenamed("id", "doc_id")


_CONTAINED_SQL = r"""
WITH words AS (
  SELECT kind, id, [y FOR y IN [trim(x, '.,;:!?"''()[]{}|#*$%&<>') FOR x IN
      regexp_split_to_array(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[\x20\x09-\x0D]+')] IF y <> ''] AS w
  FROM (SELECT 0 AS kind, doc_id AS id, coalesce(text, '') AS t FROM documents
        UNION ALL SELECT 1, item_id, coalesce(text, '') FROM benchmark)),
items AS (
  SELECT DISTINCT id AS item_id, k, w[i:i + k - 1] AS s
  FROM (SELECT id, w, least(5, len(w)) AS k, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i
        FROM words WHERE kind = 1 AND len(w) > 0)),
sizes AS (SELECT item_id, count(*) AS shingles FROM items GROUP BY item_id),
docs AS (
  SELECT DISTINCT id AS doc_id, k, w[i:i + k - 1] AS s
  FROM (SELECT id, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM words, (SELECT DISTINCT k FROM items) WHERE kind = 0 AND len(w) >= k)),
shared AS (SELECT doc_id, item_id, count(*) AS shared FROM docs JOIN items USING (k, s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, shared::INT AS shared, shingles::INT AS shingles, shared / shingles AS containment
FROM shared JOIN sizes USING (item_id) WHERE 10 * shared >= 8 * shingles
"""


@query("op5_benchmark_decontamination", _CONTAINED_SQL)
def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")) \
        .withColumnRenamed("id", "doc_id")


@query("op6_language_id")
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = language_id.learn_profiles(language_id.training_rows(docs, fold(F.col("doc_id"), 3) != 1))
    return language_id.identify(docs, profiles).select(
        F.col("id").alias("doc_id"), (fold(F.col("id"), 3) == 1).alias("held_out"), "lang_pred", "score")


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = toxicity.training_rows(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 4) != 2)
    return toxicity.score(docs, toxicity.train(rows)).select(
        F.col("id").alias("doc_id"), (fold(F.col("id"), 4) == 2).alias("held_out"), "score", "predicted")


@query("op1_secret_scan")
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = secrets.scan(docs, secrets.learn(secrets.training_examples(docs)))
    base = F.filter("spans", lambda s: s["kind"] != "inferred")
    listed = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return rows.select(
        F.col("id").alias("doc_id"), *[count(k).alias(f"n_{k}") for k in secrets.KINDS],
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


@query("op3_sentencepiece")
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_VOCABULARY)
    rows = docs.select("doc_id", whole_text().alias("t"), pieces.ids_of(docs, path).alias("ids"))
    back = rows.select("*", pieces.text_of(rows, path).alias("decoded"))
    return back.select(
        "doc_id", F.size("ids").cast("long").alias("n_pieces"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), (F.col("decoded") == F.col("t")).alias("round_trip"))


@query("op8_warc")
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    where = warc.archive(warc.captures(pages))
    return warc.lookup(pages, where).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op9_quality_classifier")
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_model.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                               fold(F.col("doc_id"), 4) != 2)
    return rows.select(F.col("id").alias("doc_id"), (fold(F.col("id"), 4) == 2).alias("held_out"), "document", "host_mean",
                       "path_mean", "score", "predicted")


_LINES_SQL = r"""
WITH lines AS (
  SELECT doc_id, i, parts[i] AS line, translate(trim(parts[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
common AS (
  SELECT key, max(doc_id) AS last FROM lines WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (
  SELECT doc_id, i, line, coalesce(last > doc_id, false) AS lost FROM lines LEFT JOIN common USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT lost), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@query("op11_line_dedup", _LINES_SQL)
def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


_PHRASES_SQL = r"""
WITH pieces AS (
  SELECT lang, [y FOR y IN regexp_split_to_array(piece, '[\x20\x09]+') IF y <> ''] AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
counts AS (
  SELECT lang, m, phrase, count(*) AS a
  FROM (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
        FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i
              FROM pieces, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(w) >= m))
  GROUP BY lang, m, phrase HAVING count(*) >= 30),
candidates AS (SELECT lang, m, phrase, a, string_split(phrase, ' ') AS w FROM counts WHERE m > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.a, k, f.a AS l, g.a AS r, ((2000000::HUGEINT * c.a) // (f.a + g.a))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates) c
  JOIN counts f ON f.lang = c.lang AND f.phrase = array_to_string(c.w[1:k], ' ')
  JOIN counts g ON g.lang = c.lang AND g.phrase = array_to_string(c.w[k + 1:c.m], ' ')),
worst AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_phrases AS (
  SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT lang, w, a, s, unnest(range(1, m - s + 2)) AS i FROM candidates, (SELECT unnest([2, 3]) AS s) WHERE s < m)
  GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM worst JOIN totals USING (lang) LEFT JOIN inner_phrases USING (lang, phrase)
WHERE longer IS NULL OR 100 * longer < 80 * a
QUALIFY rank <= 2000
"""


@query("op12_phrase_collocations", _PHRASES_SQL)
def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query("op13_spelling_variants")
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spellings.variants(table(spark, sf_dir, "documents"))


QUERIES["pipeline"] = lambda spark, sf_dir: corpus_pipeline.run(prepare(spark), sf_dir)
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
