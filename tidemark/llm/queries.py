"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import embedding_dedup, fill_middle, jaccard_join, media, mixing, packing, quality, repeated_spans, sharding, token_counts, toxicity, url_filters, whitening
from .names import free_prefix

ALLOW = ["org/", "com/fr/"]
BLOCK = ["example.org/es/", "example.org/en/1", "com/de/"]
BLOCKED_HOSTS = [f"{name}.example.{top}" for name in ("spam-farm", "cheap-pills", "free-bets", "adult-x") for top in ("com", "net", "org")]


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.text_shards(_table(spark, sf_dir, "documents"), 8)


def op2_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge_urls(_table(spark, sf_dir, "pages"), ALLOW, BLOCK, BLOCKED_HOSTS)


def op3_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"))


def op4_transducer_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))


def op5_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality.fit_evidence(docs, _table(spark, sf_dir, "labels"))
    out, p = quality.quality_posterior(docs, model), free_prefix(docs)
    return out.select("doc_id", "source", "lang", *[F.col(f"{p}{x}").alias(x) for x in ("evidence", "host_share", "prior", "quality")], (F.col(f"{p}quality") >= 0.5).alias("kept"))


def op6_partenum_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_documents(_table(spark, sf_dir, "documents"), width=3, num=90, den=100)


def op7_media_sniffing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_digest(media.text_media(_table(spark, sf_dir, "documents")))


def op8_toxic_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    out, p = toxicity.toxicity(docs, toxicity.fit_index(docs, _table(spark, sf_dir, "labels"))), free_prefix(docs)
    return out.select("doc_id", toxicity.held_out().alias("held_out"), F.col(f"{p}toxicity").alias("score"), (F.col(f"{p}toxicity") >= 0.7).cast("int").alias("predicted"), F.col(f"{p}evidence_ids").alias("evidence_ids"))


def op9_raked_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    out, p = mixing.mixing_probabilities(docs), free_prefix(docs)
    names = {"topic": "topic", "tokens": "n_tokens", "weight": "weight", "probability": "probability", "drawn": "drawn", "gap": "marginal_gap", "budget": "budget"}
    return out.select("doc_id", "source", "lang", *[F.col(f"{p}{x}").alias(name) for x, name in names.items()])


def op10_pivot_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    out, p = fill_middle.fill_middle(docs), free_prefix(docs)
    restored = fill_middle.restore(F.col(f"{p}output"), F.col(f"{p}form"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return out.select("doc_id", F.col(f"{p}n").alias("n"), F.col(f"{p}form").alias("form"), F.col(f"{p}prefix_units").alias("prefix_chars"), F.col(f"{p}middle_units").alias("middle_chars"), digest(F.col(f"{p}output")).alias("output_sha256"), digest(restored).alias("restored_sha256"))


def op12_de_bruijn_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out, p = repeated_spans.remove_repeated(docs), free_prefix(docs)
    return out.select("doc_id", F.col(f"{p}n_words").alias("n_words"), F.col(f"{p}n_removed").alias("n_removed"), F.sha2(F.col(f"{p}kept").cast("binary"), 256).alias("kept_sha256"))


def op13_chebyshev_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    out, p = whitening.whiten(vectors), free_prefix(vectors)
    each = out.select("vec_id", F.posexplode(f"{p}whitened").alias("k", "whitened"), *[F.col(p + c).alias(c) for c in ("n", "deviation", "explained", "identity_error")])
    return each.select("vec_id", (F.col("k") + 1).alias("component"), "n", "deviation", "whitened", F.col("explained")[F.col("k")].alias("explained"), "identity_error")


QUERIES = {f.__name__: f for f in (op1_histogram_shards, op2_url_cascade, op3_sum_of_squares_packing, op4_transducer_token_counts, op5_site_quality, op6_partenum_join, op7_media_sniffing, op8_toxic_neighbours, op9_raked_mixing, op10_pivot_neighbours, op11_fill_in_middle, op12_de_bruijn_dedup, op13_chebyshev_whitening)}

_RULES = ", ".join(f"('{r}', '{v}')" for rules, v in ((ALLOW, "allow"), (BLOCK, "block")) for r in rules)
_HOSTS = ", ".join(f"('{h}')" for h in BLOCKED_HOSTS)

ORACLE_SQL = {
    "op2_url_cascade": f"""
WITH rules(rule, verdict) AS (VALUES {_RULES}), bad(h) AS (VALUES {_HOSTS}),
rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(r, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
best AS (
  SELECT p.page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM (SELECT DISTINCT page_id, host, path FROM parts) p JOIN rules
    ON (p.host = split_part(rule, '/', 1) OR ends_with(p.host, '.' || split_part(rule, '/', 1)))
   AND starts_with(p.path, substr(rule, instr(rule, '/')))
  GROUP BY p.page_id),
listed AS (SELECT DISTINCT host FROM parts JOIN bad ON host = h OR ends_with(host, '.' || h))
SELECT p.page_id, p.host, p.path, b.rule, coalesce(b.verdict, CASE WHEN l.host IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM parts p LEFT JOIN best b USING (page_id) LEFT JOIN listed l ON l.host = p.host
""",
    "op11_fill_in_middle": """
WITH h AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s FROM documents),
g AS (SELECT *, CAST('0x' || substr(s, 1, 8) AS BIGINT) % (n + 1) AS x, CAST('0x' || substr(s, 9, 8) AS BIGINT) % (n + 1) AS y,
      CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR CAST('0x' || substr(s, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
           WHEN CAST('0x' || substr(s, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
c AS (SELECT doc_id, n, form, t, least(x, y) AS a, greatest(x, y) AS b FROM g),
p AS (SELECT *, substring(t, 1, a) AS pre, substring(t, a + 1, b - a) AS mid, substring(t, b + 1) AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256 FROM p""",
    "op12_de_bruijn_dedup": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS l FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(l) - 48)) AS i, l FROM w),
k AS (SELECT doc_id, i, array_to_string(l[i:i + 49], ' ') AS t FROM s),
bad AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY t) AS lo FROM k) WHERE doc_id > lo),
words AS (SELECT doc_id, unnest(l) AS word, unnest(range(1, len(l) + 1)) AS i FROM w),
seen AS (SELECT doc_id, i, word, max(CASE WHEN b.i IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
         FROM words LEFT JOIN bad b USING (doc_id, i)),
kept AS (SELECT doc_id, sum(gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (gone = 0) AS t FROM seen GROUP BY doc_id)
SELECT doc_id, CAST(len(l) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)""",
}
