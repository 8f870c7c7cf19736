"""The queries of this subpackage, their SQL where SQL can state them, and their parameters in production."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from . import brown_lm, decision_list, decontaminate, minmax_dedup, pii_crf, sentencepiece_codec, token_output, toxicity, url_filter, warc
from ._workers import importable

#: Where the public tokenizers lie on every machine.
BYTE_PAIRS, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


@query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


_LISTED = ", ".join(f"'{d}'" for d in url_filter.LISTED)
ORACLES["op1_url_filter"] = f"""
WITH rules(rule, says) AS (VALUES {", ".join(f"('{r}', '{v}')" for r, v in url_filter.RULES)}),
parsed AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{url_filter.UPPER}', '{url_filter.LOWER}'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
),
split AS (SELECT *, split_part(rule, '/', 1) AS rule_host, substr(rule, strpos(rule, '/')) AS rule_path FROM rules),
hosts AS (SELECT DISTINCT host FROM parsed),
ruled AS (
  SELECT p.page_id, p.host, p.path,
    (SELECT max_by(s.rule, length(s.rule)) FROM split s
      WHERE (p.host = s.rule_host OR ends_with(p.host, '.' || s.rule_host)) AND starts_with(p.path, s.rule_path)) AS rule
  FROM parsed p
)
SELECT page_id, ruled.host, path, ruled.rule,
  coalesce(rules.says, CASE WHEN EXISTS (
      SELECT 1 FROM (SELECT unnest([{_LISTED}]) AS d) WHERE ruled.host = d OR ends_with(ruled.host, '.' || d)
    ) THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled LEFT JOIN rules ON rules.rule = ruled.rule
"""


@query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


ORACLES["op2_warc"] = """
WITH rows AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages
), owned AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS owner FROM rows)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= 100 AND page_id <> owner THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id <> owner THEN owner END AS refers_to
FROM owned
"""


@query
def op3_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown_lm.score_held_out(table(spark, sf_dir, "documents"))


@query
def op4_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decision_list.judge_all(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.round_trip(table(spark, sf_dir, "documents"), tokenizer(BYTE_PAIRS))


@query
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_crf.find(table(spark, sf_dir, "documents"))


@query
def op7_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_dedup.near_groups(table(spark, sf_dir, "documents"))


ORACLES["op7_minmax_dedup"] = rf"""
WITH RECURSIVE cut AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{url_filter.UPPER}', '{url_filter.LOWER}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), placed AS (SELECT doc_id, len(words) AS size, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM cut WHERE len(words) > 0),
runs AS (
  SELECT doc_id, size, pos, concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o) AS shingle
  FROM placed WINDOW o AS (PARTITION BY doc_id ORDER BY pos)
), members AS (SELECT DISTINCT doc_id, shingle FROM runs WHERE pos <= greatest(1, size - 4)),
sized AS (SELECT cut.doc_id, count(shingle) AS n FROM cut LEFT JOIN members ON members.doc_id = cut.doc_id GROUP BY cut.doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM members x JOIN members y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id),
links AS (SELECT a, b FROM shared JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b WHERE 100 * shared.n >= 85 * (x.n + y.n - shared.n)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sized UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT sized.doc_id, sized.n AS n_shingles, min(reach.b) AS component_id, sized.doc_id = min(reach.b) AS kept
FROM sized JOIN reach ON reach.a = sized.doc_id GROUP BY sized.doc_id, sized.n
"""


@query
def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.digests(table(spark, sf_dir, "documents"), tokenizer(PIECES))


@query
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op10_decontaminate"] = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents
), b AS (
  SELECT item_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark
),
dt AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos FROM d),
bt AS (SELECT item_id, len(w) AS size, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos FROM b WHERE len(w) >= 5),
eq AS (
  SELECT doc_id, n, item_id, size, dt.pos - bt.pos AS shift, bt.pos AS j, least(13, size) AS width,
    CASE WHEN size >= 13 THEN 11 ELSE size END AS need
  FROM dt JOIN bt ON dt.word = bt.word
),
near AS (SELECT * FROM eq QUALIFY count(*) OVER (PARTITION BY doc_id, item_id, shift) >= need),
placed AS (SELECT *, unnest(range(j - width + 1, j + 1)) AS s FROM near),
windows AS (
  SELECT doc_id, item_id, shift, s, width, count(*) AS n_equal FROM placed
  WHERE s >= 0 AND s + width <= size AND s + shift >= 0 AND s + shift + width <= n
  GROUP BY doc_id, item_id, shift, s, width, need HAVING count(*) >= need
)
SELECT doc_id, item_id, CAST(min(s + shift) AS BIGINT) AS first_word, CAST(max(s + shift + width - 1) AS BIGINT) AS last_word,
  CAST(max(n_equal) AS BIGINT) AS best_equal
FROM windows GROUP BY doc_id, item_id
"""


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_all(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
