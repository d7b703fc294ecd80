"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsmith.llm import (
    bpe,
    chat,
    classifier,
    decontam,
    html,
    jaccard,
    langid,
    lm,
    quality_rules,
    retrieval,
    runs,
    suffix_dedup,
    superkmers,
)
from rowsmith.llm.text import small_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return small_batches(spark.read.parquet(f"{sf}/{name}.parquet"))


@query
def op1_bpe(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    found = bpe.decode(bpe.encode(table(spark, sf, "documents"), path), path)
    return found.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op2_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = decontam.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.drop("row_key")


@query
def op3_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.join_documents(table(spark, sf, "documents"))


@query
def op4_language_model(spark: SparkSession, sf: str) -> DataFrame:
    return lm.score(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op5_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf, "documents"))


@query
def op6_html(spark: SparkSession, sf: str) -> DataFrame:
    return html.extract(table(spark, sf, "pages")).withColumn("n_chars", F.char_length("text").cast("bigint"))


@query
def op7_chat(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = table(spark, sf, "conversations").select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text"
    )
    says = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame(
        [(-7, 0, "user", says), (-7, 1, "assistant", says)], "conv_id bigint, turn bigint, role string, text string"
    )
    return chat.read_back(chat.format_conversations(rows.unionByName(more), path), path)


ORACLE["op7_chat"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  sum(length('<|role|><|text|><|end|>')
    + length(replace(replace(role, '\', '\\'), '<|', '<\|'))
    + length(replace(replace(text, '\', '\\'), '<|', '<\|')))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""


@query
def op8_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    return classifier.classify(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op9_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = suffix_dedup.dedup(table(spark, sf, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op10_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return langid.identify(
        table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    )


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """The table of ``op11_runs``: one text in ten repeats a stretch of its words from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    n, g = F.size(words), F.floor(h / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    tail = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    text = F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), a), tail), F.lit(1), n), " ")
    return docs.withColumn("text", F.when((h % 10 == 0) & (n > 0), text).otherwise(F.col("text")))


@query
def op11_runs(spark: SparkSession, sf: str) -> DataFrame:
    found = runs.find_runs(with_periodic_tails(table(spark, sf, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    found = found.withColumn("best", best)
    length, start, period = F.col("best.length"), -F.col("best.col2"), -F.col("best.col3")
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).cast("bigint").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


@query
def op12_superkmers(spark: SparkSession, sf: str) -> DataFrame:
    found = superkmers.dedup(table(spark, sf, "documents"))
    return found.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


ORACLE["op12_superkmers"] = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS run FROM texts, range(1, len(words) - 11) AS t(i)
), firsts AS (
  SELECT run, min(doc_id) AS first_id FROM windows GROUP BY run
), gone AS (
  SELECT DISTINCT doc_id, i + d AS place
  FROM windows JOIN firsts USING (run), range(13) AS r(d) WHERE doc_id > first_id
), placed AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM texts
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS kept
  FROM placed ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
), removed AS (
  SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)
"""


@query
def op13_retrieval(spark: SparkSession, sf: str) -> DataFrame:
    return retrieval.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


ORACLE["op13_retrieval"] = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), stats AS (
  SELECT count(*) AS docs, sum(len(terms))::BIGINT AS total FROM texts WHERE len(terms) > 0
), postings AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM texts) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM postings, stats GROUP BY term, docs
), wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), lengths AS (
  SELECT doc_id, 10 + (90 * len(terms) * docs) // total AS m FROM texts, stats WHERE len(terms) > 0
), scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM wanted JOIN postings USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id) GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10
"""
