"""One query per operator, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    bpe, licenses, neighbours, ordinal, packing, periods, pieces, private, quality, ranked, sharding, simhash, substrings,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_packing(spark, sf_dir):
    return packing.pack_documents(documents(spark, sf_dir), tokenizer("word_bpe_49k.json"))


@query
def op2_substrings(spark, sf_dir):
    return substrings.remove_repeats(documents(spark, sf_dir).select("doc_id", "text"), new_text=False)


@query
def op3_neighbours(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    vectors = vectors.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return neighbours.nearest(vectors, F.col("id") % 50 == 0).withColumnRenamed("id", "vec_id")


@query
def op4_private(spark, sf_dir):
    return private.find_private(documents(spark, sf_dir))


@query
def op5_bpe(spark, sf_dir):
    import public_tokenizers

    path = tokenizer("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_documents(documents(spark, sf_dir), path, public_tokenizers.PATTERN)


@query
def op6_licenses(spark, sf_dir):
    return licenses.scan_licenses(documents(spark, sf_dir))


@query
def op7_sharding(spark, sf_dir):
    return sharding.shard_documents(documents(spark, sf_dir))


@query
def op8_quality(spark, sf_dir):
    return quality.quality_rules(documents(spark, sf_dir)).select("doc_id", *quality.COUNTS, "base_failed", "kept")


@query
def op9_classifier(spark, sf_dir):
    """Grades: 0 toxic, 1 of low quality, 2 good."""
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).otherwise(2)
    ratings = labels.where("quality is not null and toxic is not null").select("doc_id", grade.alias("grade"))
    return ordinal.grade_documents(docs, ordinal.fit_on(docs, ratings))


@query
def op10_simhash(spark, sf_dir):
    return simhash.near_duplicates(documents(spark, sf_dir))


@query
def op11_ranked(spark, sf_dir):
    return ranked.search_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), 10)


@query
def op12_pieces(spark, sf_dir):
    return pieces.encode_pieces(documents(spark, sf_dir), tokenizer("piece_bpe_32k.model"))


@query
def op13_periods(spark, sf_dir):
    return periods.periodic_runs(documents(spark, sf_dir), periods.recur)


ORACLE["op2_substrings"] = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), words AS (
  SELECT r, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM texts
), windows AS (
  SELECT r, i, count(*) OVER ahead AS n, md5(string_agg(w, ' ') OVER ahead) AS k FROM words
  WINDOW ahead AS (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)
), found AS (
  SELECT r, i, n = 35 AND count(*) OVER (PARTITION BY n, k) > 1 AS again FROM windows
), covered AS (
  SELECT r, i, coalesce(bool_or(again) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW), false) AS gone
  FROM found
), kept AS (
  SELECT r, count(*) FILTER (WHERE gone) AS n_removed, string_agg(w, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS rest
  FROM covered JOIN words USING (r, i) GROUP BY r
)
SELECT doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (r)
"""


def _quality_sql() -> str:
    """The counts, the sketches of three levels, their cutoffs and the verdict."""
    from millrace.llm.quality import BLANKS, GROWTH, LEAST_DOCS, MIN_WORDS, RATIOS, REACH, SPREADS

    word = BLANKS.replace("[", "[^")
    ratios = {name: value.replace("try_divide(", "(").replace(", n_words)", " / n_words)") for name, value in RATIOS.items()}
    each = " UNION ALL ".join(f"SELECT lang, source, '{name}' AS ratio, {value} AS v FROM fair" for name, value in ratios.items())
    spreads = " ".join(f"WHEN '{name}' THEN {least}" for name, least in SPREADS.items())
    beyond = " OR ".join(f"coalesce({value} > cut['{name}'], false)" for name, value in ratios.items())
    same = "{0}.lang IS NOT DISTINCT FROM {1}.lang AND {0}.source IS NOT DISTINCT FROM {1}.source"
    return rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents
), cut_up AS (
  SELECT *, regexp_extract_all(t, '{word}') AS ws,
    [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '{word}')] AS ls FROM texts
), words AS (
  SELECT r, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM cut_up
), windows AS (
  SELECT r, i, count(*) OVER ahead AS n, string_agg(w, ' ') OVER ahead AS k FROM words
  WINDOW ahead AS (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)
), found AS (
  SELECT r, i, n = 5 AND count(*) OVER (PARTITION BY r, n, k) > 1 AS again FROM windows
), covered AS (
  SELECT r, bool_or(again) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS hit FROM found
), repeated AS (
  SELECT r, count(*) FILTER (WHERE hit) AS n_repeat_words FROM covered GROUP BY r
), counts AS (
  SELECT doc_id, lang, source, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    length(regexp_replace(t, '[^\p{{Lu}}]', '', 'g')) AS n_capitals, len(ls) AS n_lines,
    len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM cut_up LEFT JOIN repeated USING (r)
), marked AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts
), fair AS (
  SELECT * FROM marked WHERE NOT base_failed
), binned AS (
  SELECT lang, source, ratio, CASE WHEN v < 1e-6 THEN -2000 ELSE ceil(ln(v) / ln({GROWTH})) END AS bin FROM ({each})
), levels AS (
  SELECT 0 AS level, * FROM binned UNION ALL SELECT 1, lang, NULL, ratio, bin FROM binned
  UNION ALL SELECT 2, NULL, NULL, ratio, bin FROM binned
), sketch AS (
  SELECT level, lang, source, ratio, bin, count(*) AS n FROM levels GROUP BY ALL
), summed AS (
  SELECT *, sum(n) OVER (PARTITION BY level, lang, source, ratio ORDER BY bin) AS upto,
    sum(n) OVER (PARTITION BY level, lang, source, ratio) AS n_docs FROM sketch
), quartiles AS (
  SELECT level, lang, source, ratio, max(n_docs) AS n_docs, min(bin) FILTER (WHERE upto >= 0.25 * n_docs) AS low,
    min(bin) FILTER (WHERE upto >= 0.75 * n_docs) AS high FROM summed GROUP BY ALL
), valued AS (
  SELECT level, lang, source, ratio, n_docs, CASE ratio {spreads} END AS least,
    CASE WHEN low = -2000 THEN 0.0 ELSE 2 * pow({GROWTH}, low) / ({GROWTH} + 1) END AS low,
    CASE WHEN high = -2000 THEN 0.0 ELSE 2 * pow({GROWTH}, high) / ({GROWTH} + 1) END AS high FROM quartiles
), cutoffs AS (
  SELECT level, lang, source, max(n_docs) AS n_docs,
    map_from_entries(list((ratio, high + {REACH} * greatest(high - low, least)))) AS cut FROM valued GROUP BY ALL
), chosen AS (
  SELECT g.lang, g.source,
    CASE WHEN g.n_docs >= {LEAST_DOCS} THEN g.cut WHEN l.n_docs >= {LEAST_DOCS} THEN l.cut ELSE a.cut END AS cut
  FROM cutoffs g JOIN cutoffs l ON l.level = 1 AND g.lang IS NOT DISTINCT FROM l.lang JOIN cutoffs a ON a.level = 2
  WHERE g.level = 0
)
SELECT m.doc_id, m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words, m.base_failed,
  NOT base_failed AND NOT ({beyond}) AS kept
FROM marked m LEFT JOIN chosen c ON {same.format("m", "c")}
"""


ORACLE["op8_quality"] = _quality_sql()


ORACLE["op11_ranked"] = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents
), sized AS (
  SELECT r, doc_id, len(ws) AS n FROM texts WHERE len(ws) > 0
), totals AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sized
), counted AS (
  SELECT r, w, count(*) AS tf FROM (SELECT r, unnest(ws) AS w FROM texts) GROUP BY r, w
), weighted AS (
  SELECT w, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM counted, totals GROUP BY w, docs
), items AS (
  SELECT row_number() OVER () AS j, item_id, list_distinct(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS ws FROM benchmark
), asked AS (
  SELECT j, item_id, unnest(ws) AS w FROM items
), scored AS (
  SELECT j, item_id, r, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // terms)))) AS BIGINT) AS score
  FROM asked JOIN weighted USING (w) JOIN counted USING (w) JOIN sized USING (r), totals GROUP BY j, item_id, r, doc_id
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY j ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM placed WHERE rank <= 10
"""
