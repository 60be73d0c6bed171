"""The registered queries of the training-data operators and, where SQL can express them, their DuckDB SQL.

A query is a thin wrapper: it reads whole tables, applies its operator with production parameters and keeps the
contract's columns.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docquery.llm import bpe as _bpe
from docquery.llm import decontaminate as _decontaminate
from docquery.llm import jaccard_join as _jaccard
from docquery.llm import katz as _katz
from docquery.llm import langid as _langid
from docquery.llm import licenses as _licenses
from docquery.llm import pii as _pii
from docquery.llm import quality_gbt as _gbt
from docquery.llm import quality_rules as _quality
from docquery.llm import warc as _warc
from docquery.llm.shared import new_path, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def _digest(strings: Column) -> Column:
    """Lowercase hex SHA-256 of the strings of an array, comma-joined."""
    return F.sha2(F.array_join(strings, ",").cast("binary"), 256)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = _decontaminate.decontaminate(docs, _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"), _digest(F.col("hit_items")).alias("items_sha256"), "contaminated")


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
ORACLE_SQL["op3_benchmark_decontamination"] = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWERED}, {_ALNUM}) AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWERED}, {_ALNUM}) AS ws FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, least(13, len(ws)) AS sz, array_to_string(ws[i : i + least(13, len(ws)) - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0)),
dwins AS (
  SELECT doc_id, sz, i, array_to_string(ws[i : i + sz - 1], ' ') AS g
  FROM (SELECT doc_id, ws, sz, unnest(range(1, len(ws) - sz + 2)) AS i FROM d, (SELECT DISTINCT sz FROM wins))),
hits AS (SELECT doc_id, i, sz, item_id FROM dwins JOIN wins USING (sz, g)),
words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + sz)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(words.n, 0) > 0 AND 20 * coalesce(words.n, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""


@_query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quality.quality_rules(_table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def _quality_sql() -> str:
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(x for w in _quality.STOP_WORDS for x in (w, w.capitalize())))
    bad = [f"coalesce({r.measure} < {r.low}, false)" for r in _quality.RULES if r.low is not None]
    bad += [f"coalesce({r.measure} > {r.high}, false)" for r in _quality.RULES if r.high is not None]
    return f"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws, coalesce(text, '') AS t,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS ls
  FROM documents),
grams AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
twice AS (SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
repeats AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, len(ls) AS n_lines,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
         len(list_filter(ws, lambda x: x IN ({stop}))) AS n_stop_words
  FROM w LEFT JOIN repeats r USING (doc_id)),
b AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT ({' OR '.join(bad)}) AS kept
FROM b"""


ORACLE_SQL["op5_quality_rules"] = _quality_sql()


@_query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    samples = _langid.language_samples(docs.where(_langid.remainder("doc_id", 4) != 2))
    return _langid.identify(docs.select("doc_id", "text"), samples).select(
        "doc_id", F.coalesce(_langid.remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


@_query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _licenses.scan(_table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


@_query
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _pii.find(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    n_spans = (F.col("n_email") + F.col("n_ip") + F.col("n_card") + F.col("n_phone") + F.col("n_context")).alias("n_spans")
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans", "n_context", n_spans)


TOKENIZER = "byte_bpe_multi_50k.tiktoken"


@_query
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = _bpe.read_ranks(spark, public_tokenizers.path(TOKENIZER))
    encoded = _bpe.encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), ranks, public_tokenizers.PATTERN)
    return _bpe.decode(encoded, ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        _digest(F.col("ids").cast("array<string>")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_query
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "quality")
    forest = _gbt.fit(docs, labels.where(_langid.remainder("doc_id", 3) != 1))
    return _gbt.classify(docs, forest).select("doc_id", F.coalesce(_langid.remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score", "predicted")


@_query
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    arc, warc = new_path(spark, "arc"), new_path(spark, "warc")
    _warc.write_arc(_table(spark, sf_dir, "pages"), arc)
    _warc.convert(spark, arc, warc)
    read = stored(_warc.read_warc(spark, warc).drop("uri"), "warc-records")  # used three times, and each parses the files
    targets = read.where(F.col("record_type") == "response").select(F.col("record_id").alias("refers_to_id"), F.col("rank").alias("refers_to"))
    seen = read.where(F.col("refers_to_id").isNotNull()).join(targets, "refers_to_id", "left")
    columns = [F.col("rank").alias("page_id"), "payload_bytes", "payload_digest", "record_type"]
    return read.where(F.col("refers_to_id").isNull()).select(*columns, F.lit(None).cast("long").alias("refers_to")).unionByName(seen.select(*columns, "refers_to"))


ORACLE_SQL["op8_warc"] = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages),
w AS (SELECT *, max(page_id) OVER (PARTITION BY h, n) AS top FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, h AS payload_digest,
       CASE WHEN n >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id < top THEN top END AS refers_to
FROM w"""


@_query
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _jaccard.jaccard_components(_table(spark, sf_dir, "documents"))


ORACLE_SQL["op6_jaccard_join"] = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + least(5, len(ws)) - 1], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - least(5, len(ws)) + 2)) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
r AS (SELECT doc_id, doc_id AS to_id FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.to_id = e.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(to_id) AS component_id FROM r GROUP BY doc_id) c USING (doc_id)"""


@_query
def op4_katz_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = _katz.score(docs, _langid.remainder("doc_id", 7) != 2)
    held_out = F.coalesce(_langid.remainder("doc_id", 7) == 2, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")
