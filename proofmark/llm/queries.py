"""One query per operator over its whole table, with its SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from proofmark.llm import (
    bpe, contamination, importance, language, line_rules, lm_scoring, page_text, periodic_runs, sharding, simhash, target_resampling, token_counts,
    topk_search,
)
from proofmark.llm.common import prepare, table
from proofmark.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(tune(spark)), sf_dir)

        run.__name__ = name
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def fold(name: str, parts: int) -> Column:
    """The fold of a row: crc32 of its id as text, modulo the number of folds."""
    return F.pmod(F.crc32(F.col(name).cast("string").cast("binary")), F.lit(parts))


@query("op1_lm_scoring")
def _lm_scoring(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold("doc_id", 7) == 2, F.lit(False))
    model, base, words = lm_scoring.fit(documents, ~held_out, RANKS, public_tokenizers.PATTERN)
    found = lm_scoring.score(documents, model, base, words, RANKS, public_tokenizers.PATTERN)
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


SHARDS = [f"shard-{i:03d}" for i in range(100)]

_SHARD_SQL = f"""WITH slots AS (SELECT unnest({sharding.lookup_table(SHARDS)}) AS k, unnest(range({sharding.SLOTS})) AS slot),
keyed AS (SELECT doc_id, CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::UBIGINT % {sharding.SLOTS} AS BIGINT) AS slot FROM documents)
SELECT doc_id, slot, 'shard-' || lpad(CAST(k AS VARCHAR), 3, '0') AS shard FROM keyed JOIN slots USING (slot)"""


@query("op2_sharding", _SHARD_SQL)
def _sharding(spark, sf_dir):
    return sharding.place(table(spark, sf_dir, "documents"), SHARDS)


@query("op3_language_id")
def _language_id(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold("doc_id", 4) == 2, F.lit(False))
    models, scored = language.fit_scored(documents, ~held_out, "doc_id", "text", "lang")
    found = language.identify(documents, models, scored=scored)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")


@query("op4_page_text")
def _page_text(spark, sf_dir):
    return page_text.extract(table(spark, sf_dir, "pages"))


@query("op5_token_counts")
def _token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), WORD_BPE)


_LINE_SQL = """WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
w3 AS (
  SELECT r, i, ws[i] || chr(10) || ws[i + 1] || chr(10) || ws[i + 2] AS g
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM d WHERE len(ws) >= 3)),
twice AS (SELECT r, i FROM w3 QUALIFY count(*) OVER (PARTITION BY r, g) >= 2),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
l AS (
  SELECT r, host, text, trim(lower(regexp_replace(line, '[\\x20\\x09-\\x0D]+', ' ', 'g'))) AS key,
    len(list_filter(string_split_regex(line, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) AS n
  FROM (SELECT r, host, text, unnest(lines) AS line FROM d)),
common AS (SELECT host, key FROM l GROUP BY host, key HAVING count(DISTINCT text) > 20),
removed AS (SELECT r, sum(n) AS n FROM l JOIN common USING (host, key) GROUP BY r),
m AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(removed.n, 0) AS BIGINT) AS removed_words
  FROM d LEFT JOIN rep USING (r) LEFT JOIN removed USING (r))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 2 * removed_words <= n_words AS kept FROM m"""


@query("op6_quality_rules", _LINE_SQL)
def _quality_rules(spark, sf_dir):
    return line_rules.quality(table(spark, sf_dir, "documents"))


@query("op7_bpe_round_trip")
def _bpe_round_trip(spark, sf_dir):
    return bpe.round_trip(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)


@query("op8_simhash_near_dedup")
def _simhash_near_dedup(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op9_importance_resampling")
def _importance_resampling(spark, sf_dir):
    return importance.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_benchmark_decontamination")
def _benchmark_decontamination(spark, sf_dir):
    return contamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op11_periodic_runs")
def _periodic_runs(spark, sf_dir):
    repeats = periodic_runs.with_repeats(table(spark, sf_dir, "documents"))
    rows = periodic_runs.find_runs(repeats).withColumn("best", periodic_runs.longest_run(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    length = -F.col("best.less")
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), length.alias("length"), F.col("best.period").alias("period"),
        F.floor(length * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


#: CRC-32 of the distinct n-grams byte by byte, from a table of its 256 steps.
_TARGET_SQL = """WITH RECURSIVE steps AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS step),
docs AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
texts AS (SELECT 0 AS side, r, text FROM docs UNION ALL SELECT 1, row_number() OVER (), text FROM benchmark),
ws AS (
  SELECT side, r, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS w FROM texts),
grams AS (
  SELECT side, r, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS gram
  FROM ws, (SELECT unnest([1, 2, 3]) AS k)),
coded AS (SELECT gram, hex(encode(gram)) AS hx FROM (SELECT DISTINCT gram FROM grams)),
hashed AS (
  SELECT gram, list_reduce(list_prepend(4294967295, list_transform(range(1, length(hx), 2), lambda i: 16 * instr('123456789ABCDEF', hx[i]) + instr('123456789ABCDEF', hx[i + 1]))),
    lambda c, b: xor((c >> 8), step[xor(c, b) % 256 + 1])) AS c
  FROM coded, steps),
placed AS (SELECT side, r, xor(c, 4294967295) % 10000 AS bucket FROM grams JOIN hashed USING (gram)),
counts AS (SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM placed GROUP BY bucket),
totals AS (SELECT coalesce(sum(s), 0)::DOUBLE AS all_s, coalesce(sum(t), 0)::DOUBLE AS all_t FROM counts),
gains AS (SELECT bucket, CAST(floor(1000 * ln((t + 1) * (all_s + 10000) / ((s + 1) * (all_t + 10000)))) AS BIGINT) AS gain FROM counts, totals),
weighed AS (SELECT r, count(*) AS n, sum(gain) AS weight FROM placed JOIN gains USING (bucket) WHERE side = 0 GROUP BY r),
scored AS (
  SELECT docs.r, doc_id, len(w) AS n_words, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0)::BIGINT + CAST(floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
      / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM docs JOIN ws ON ws.r = docs.r AND side = 0 LEFT JOIN weighed ON weighed.r = docs.r),
drawn AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, 5 * count(*) OVER () // 100 AS most FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= most THEN rank END AS rank FROM scored LEFT JOIN drawn USING (r)"""


@query("op12_target_resampling", _TARGET_SQL)
def _target_resampling(spark, sf_dir):
    return target_resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TOPK_SQL = """WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS q FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
met AS (
  SELECT a.r, a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a, v b WHERE a.vec_id % 100 = 0 AND a.vec_id IS DISTINCT FROM b.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM met) WHERE rank <= 10"""


@query("op13_topk_search", _TOPK_SQL)
def _topk_search(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return topk_search.top_k(vectors.where("vec_id % 100 = 0"), topk_search.index(vectors))
