"""Registered queries of the training-data operators.

Each applies its operator with production parameters to its whole table and
shapes the columns of the result; ORACLES has DuckDB SQL where SQL can say it.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlens.llm import bpe_codec, decontaminate, exact_dedup, line_dedup, ngram_join, phrases, quality, secret_scan, spelling, substring_dedup, token_counts, toxicity, url_filter
from fraudlens.llm.common import read_table, ship_package

Query = Callable[[SparkSession, str], DataFrame]


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return substring_dedup.substring_dedup(read_table(spark, sf_dir, "documents"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return ngram_join.ngram_join(read_table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return quality.quality(read_table(spark, sf_dir, "documents"))


def op4_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return bpe_codec.round_trip(
        read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return line_dedup.line_dedup(read_table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings by place and digest; a secret's text isn't copied."""
    found = secret_scan.secret_scan(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "word_no", "offset", F.sha2(F.col("run").cast("binary"), 256).alias("run_sha256"), "score", "secret")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return token_counts.token_counts(
        read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
    )


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each contaminated document and the item found in it."""
    ship_package(spark)
    return decontaminate.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


# --- fixed values: rules on page URLs (host, path, verdict) -----------------------
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
# -----------------------------------------------------------------------------------


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.url_filter(read_table(spark, sf_dir, "pages"), rules)


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return phrases.phrases(read_table(spark, sf_dir, "documents"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return spelling.spelling(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_ngram_join": op2_ngram_join,
    "op3_quality": op3_quality,
    "op4_bpe_codec": op4_bpe_codec,
    "op5_line_dedup": op5_line_dedup,
    "op6_secret_scan": op6_secret_scan,
    "op7_token_counts": op7_token_counts,
    "op8_decontaminate": op8_decontaminate,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_toxicity": op10_toxicity,
    "op11_url_filter": op11_url_filter,
    "op12_phrases": op12_phrases,
    "op13_spelling": op13_spelling,
}

ORACLES: dict[str, str] = {
    "op12_phrases": """
        WITH pieces AS (
            SELECT lang, piece, list_filter(regexp_split_to_array(t, '[\\x20\\x09]+'), lambda x: x <> '') AS words
            FROM (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS piece, unnest(regexp_split_to_array(
                      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS t
                  FROM documents)
        ), totals AS (
            SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM pieces GROUP BY lang
        ), counts AS (
            SELECT lang, p AS phrase, any_value(k) AS k, count(*) AS f
            FROM (SELECT lang, k, unnest(list_transform(range(1, len(words) - k + 2), lambda i: array_to_string(words[i:i + k - 1], ' '))) AS p
                  FROM pieces, range(1, 6) AS r(k))
            GROUP BY lang, p HAVING count(*) >= 100
        ), candidates AS (
            SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS words FROM counts WHERE k > 1
        ), cuts AS (
            SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, n, cut,
                   CAST((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
            FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) AS c
            JOIN counts AS x ON x.lang = c.lang AND x.phrase = array_to_string(words[1:cut], ' ')
            JOIN counts AS y ON y.lang = c.lang AND y.phrase = array_to_string(words[cut + 1:], ' ')
            JOIN totals AS t ON t.lang = c.lang
        ), lowest AS (
            SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
        ), inside AS (
            SELECT DISTINCT s.lang, s.phrase
            FROM (SELECT lang, a, array_to_string(words[i:j], ' ') AS phrase
                  FROM candidates, range(1, 6) AS x(i), range(1, 6) AS y(j) WHERE i < j AND j <= k AND j - i + 1 < k) AS s
            JOIN candidates AS c ON c.lang = s.lang AND c.phrase = s.phrase WHERE 100 * s.a >= 100 * c.a
        )
        SELECT lang, rank, phrase, a, l, r, n, score
        FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
              FROM lowest ANTI JOIN inside USING (lang, phrase))
        WHERE rank <= 2000
    """,
    "op11_url_filter": """
        WITH rules(rule_host, rule_path, verdict) AS (
            VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                   ('net', '/es/', 'block'), ('net', '/fr/', 'block')
        ), urls AS (
            SELECT page_id,
                   translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
            FROM pages
        ), fitting AS (
            SELECT host, path, arg_max({'rule': rule_host || rule_path, 'verdict': verdict}, len(rule_host || rule_path)) AS best
            FROM (SELECT DISTINCT host, path FROM urls) AS u JOIN rules
              ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
            GROUP BY host, path
        )
        SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict
        FROM urls LEFT JOIN fitting USING (host, path)
    """,
    "op1_substring_dedup": """
        WITH split AS (
            SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words
            FROM documents
        ), windows AS (
            SELECT doc_id, i, array_to_string(words[i:i + 34], ' ') AS w
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS i FROM split)
        ), repeated AS (
            SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY w) AS n FROM windows) WHERE n > 1
        ), gone AS (
            SELECT DISTINCT doc_id, i + j AS p FROM repeated, range(0, 35) AS o(j)
        ), listed AS (
            SELECT doc_id, words[p] AS word, p FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS p FROM split)
        ), kept AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
            FROM listed ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
        )
        SELECT s.doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed,
               sha256(coalesce(text, '')) AS kept_sha256
        FROM split AS s LEFT JOIN kept AS k ON s.doc_id = k.doc_id
    """,
    "op2_ngram_join": """
        WITH RECURSIVE split AS (
            SELECT doc_id, list_filter(
                regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words
            FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS s
            FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM split WHERE len(words) > 0)
        ), sizes AS (
            SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
        ), shared AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
            FROM shingles AS x JOIN shingles AS y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
        ), links AS (
            SELECT a, b FROM shared JOIN sizes AS p ON p.doc_id = a JOIN sizes AS q ON q.doc_id = b
            WHERE 100 * shared.n >= 80 * (p.n + q.n - shared.n)
        ), reached AS (
            SELECT a, b FROM links
            UNION
            SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
        )
        SELECT d.doc_id, coalesce(any_value(sizes.n), 0) AS n_shingles, least(d.doc_id, min(reached.b)) AS component_id
        FROM documents AS d LEFT JOIN sizes USING (doc_id) LEFT JOIN reached ON reached.a = d.doc_id GROUP BY d.doc_id
    """,
    "op9_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
}
