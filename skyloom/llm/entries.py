"""The queries of this subpackage: thin applications of its operators to whole tables, and SQL where SQL can say it."""

from __future__ import annotations

import numpy as np
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.llm import bpe, centroids, chat, decontam, hamming, linededup, minhash, quality, shards, simhash, tokenfile, urlrules, vectorcodes
from skyloom.llm.common import shared_dir, table

END_ID = 2


SHARDS = 40
# The site rules of the URL query.
SITE_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shards.sized(table(spark, sf_dir, "documents"))
    totals = shards.slot_totals(rows)
    plan = shards.planned(totals, SHARDS)
    path = shared_dir(spark)
    shards.save_map(shards.as_map(spark, plan, totals), path, 1)
    shards.save_map(shards.as_map(spark, shards.rebalanced(plan, totals, SHARDS + 1), totals), path, 2)
    grown = shards.load_map(spark, path, 2).select(F.col("slot").alias("virtual_slot"), F.col("shard").alias("rebalanced_shard"))
    out = shards.placed(rows, shards.load_map(spark, path, 1)).join(F.broadcast(grown), "virtual_slot")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "rebalanced_shard")


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    said = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.format_records(chat.records_of_turns(rows.union(planted))))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.compared(table(spark, sf_dir, "documents"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    coded = bpe.encode_and_decode(table(spark, sf_dir, "documents"), ranks)
    return coded.select("doc_id", F.expr("cast(length(ids) div 4 AS long)").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [urlrules.site_rule(*r) for r in SITE_RULES] + urlrules.PATTERNS
    return urlrules.judge(table(spark, sf_dir, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


OP6_SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
part AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, rest FROM cut),
ruled AS (
  SELECT *, CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
                 WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
                 WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
                 WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM part)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN regexp_matches(rest, '[?&]sessionid=|/login([/?#]|$)|/cart([/?#]|$)|\.exe([?#]|$)') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled"""


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = linededup.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.size("removed").cast("long").alias("n_removed"), "removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as spec:
        segments = tokenfile.write(table(spark, sf_dir, "documents"), spec.read(), END_ID)
    return tokenfile.read(segments).select("doc_id", "start", F.expr("cast(length(ids) div 4 AS long)").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


HOLD_OUT, ACCEPT = 5, 0.3


def held_out() -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(HOLD_OUT)) == 0


def quality_weights(spark: SparkSession, sf_dir: str) -> np.ndarray:
    """From the labels that aren't held out and the corpus as it was delivered."""
    labels = table(spark, sf_dir, "labels").where(~held_out()).select("doc_id", F.col("quality").alias("label"))
    return quality.train(table(spark, sf_dir, "documents").select("doc_id", "text"), labels)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.scores(table(spark, sf_dir, "documents"), quality_weights(spark, sf_dir))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


def op11_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming.near_duplicates(table(spark, sf_dir, "documents"))


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered(table(spark, sf_dir, "embeddings"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcodes.compressed(table(spark, sf_dir, "embeddings"))


_KEPT_SQL = """kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, *, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
x AS MATERIALIZED (SELECT r, d, v[d] AS x FROM kept, range(1, 65) AS t(d))"""


def op12_sql(k: int = centroids.CLUSTERS, rounds: int = centroids.ROUNDS) -> str:
    """The rounds one after the other, every distance computed."""
    steps = [
        _KEPT_SQL,
        f"""c0 AS MATERIALIZED (SELECT k, d, v[d] AS c
  FROM (SELECT row_number() OVER (ORDER BY sha256('{centroids.SALT}:' || vec_id), v) - 1 AS k, v FROM kept QUALIFY k < {k}), range(1, 65) AS t(d))""",
    ]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT r, k, s FROM (SELECT r, k, CAST(sum((x - c) * (x - c)) AS BIGINT) AS s FROM x JOIN c{i} USING (d) GROUP BY r, k)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY s, k) = 1)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (SELECT c.k, c.d, CASE WHEN n IS NULL THEN c ELSE (t - (t % n + n) % n) // n END AS c FROM c{i} AS c
  LEFT JOIN (SELECT k, d, CAST(sum(x) AS BIGINT) AS t, count(*) AS n FROM x JOIN a{i} USING (r) GROUP BY k, d) AS m ON m.k = c.k AND m.d = c.d)""")
    last = f"""SELECT vec_id, CAST(k AS INTEGER) AS cluster, s AS distance, CAST(sum(s) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(s) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN kept USING (r) JOIN (SELECT k, sha256(string_agg(c, ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY k) USING (k)"""
    return "WITH " + ",\n".join(steps) + "\n" + last


def op13_sql(entries: int = vectorcodes.ENTRIES, rounds: int = vectorcodes.ROUNDS) -> str:
    """The rounds one after the other; p is the part, d the place in the vector."""
    width = 64 // vectorcodes.PARTS
    steps = [
        _KEPT_SQL,
        "y AS MATERIALIZED (SELECT r, d, (d - 1) // " + str(width) + " AS p, x FROM x)",
        f"c0 AS MATERIALIZED (SELECT k, d, v[d] AS c FROM (SELECT row_number() OVER (ORDER BY vec_id, v) - 1 AS k, v FROM kept QUALIFY k < {entries}), range(1, 65) AS t(d))",
    ]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT r, p, k, s FROM (SELECT r, p, k, CAST(sum((x - c) * (x - c)) AS BIGINT) AS s FROM y JOIN c{i} USING (d) GROUP BY r, p, k)
  QUALIFY row_number() OVER (PARTITION BY r, p ORDER BY s, k) = 1)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (SELECT c.k, c.d, CASE WHEN n IS NULL THEN c ELSE (t - (t % n + n) % n) // n END AS c FROM c{i} AS c
  LEFT JOIN (SELECT k, d, CAST(sum(x) AS BIGINT) AS t, count(*) AS n FROM y JOIN a{i} USING (r, p) GROUP BY k, d) AS m ON m.k = c.k AND m.d = c.d)""")
    last = f"""SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN (SELECT r, string_agg(printf('%02x', k), '' ORDER BY p) AS code, CAST(sum(s) AS BIGINT) AS error FROM a{rounds} GROUP BY r) USING (r),
     (SELECT sha256(string_agg(c, ',' ORDER BY (d - 1) // {width}, k, d)) AS codebooks_sha256 FROM c{rounds})"""
    return "WITH " + ",\n".join(steps) + "\n" + last


QUERIES = {f.__name__: f for f in (op1_decontaminate, op2_virtual_slots, op3_chat_format, op4_simhash, op5_byte_bpe, op6_url_rules, op7_line_dedup, op8_minhash_near_dedup, op9_token_files, op10_quality, op11_simhash_near_dedup, op12_centroid_clusters, op13_vector_codes)}
ORACLE_SQL: dict[str, str] = {"op6_url_rules": OP6_SQL, "op12_centroid_clusters": op12_sql(), "op13_vector_codes": op13_sql()}
