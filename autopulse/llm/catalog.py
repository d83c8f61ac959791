"""Registered queries of the training-data operators and, where SQL can express them, their oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from autopulse.llm import (
    bpe, centroids, chat, decontam, exact_dedup, importance, kd_shard, langid, near_dup, packing, suffix_dedup,
    toxicity, url_filter,
)
from autopulse.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


@register("op1_kd_shards")
def q_kd_shards(spark, sf):
    return kd_shard.kd_shards(read(spark, sf, "documents"), shards=40)


@register("op2_cross_parsing_language")
def q_language(spark, sf):
    return langid.language_id(read(spark, sf, "documents"))


@register("op3_grouping_genetic_packing")
def q_packing(spark, sf):
    return packing.best_fit_packing(read(spark, sf, "documents"))


@register("op4_stateful_exact_dedup")
def q_exact_dedup(spark, sf):
    return exact_dedup.exact_dedup(read(spark, sf, "documents"))


@register("op5_wand_decontamination")
def q_decontamination(spark, sf):
    return decontam.contaminated(read(spark, sf, "documents"), read(spark, sf, "benchmark"))


@register("op6_snapshot_collapse_chat")
def q_chat(spark, sf):
    return chat.chat_format(read(spark, sf, "conversations"))


@register("op7_subword_toxicity")
def q_toxicity(spark, sf):
    return toxicity.toxicity(read(spark, sf, "documents"), read(spark, sf, "labels"))


@register("op8_coordinate_minhash")
def q_near_duplicates(spark, sf):
    return near_dup.near_duplicates(read(spark, sf, "documents"))


@register("op9_prefix_doubling_dedup")
def q_suffix_dedup(spark, sf):
    spans = suffix_dedup.remove_repeats(read(spark, sf, "documents"))
    return spans.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@register("op10_url_rules")
def q_url_rules(spark, sf):
    rules = spark.createDataFrame(RULES, url_filter.RULES_SCHEMA)
    return url_filter.judge_urls(read(spark, sf, "pages"), rules)


@register("op11_importance_resampling")
def q_importance_resampling(spark, sf):
    drawn = importance.importance_resample(read(spark, sf, "documents"), read(spark, sf, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@register("op12_backtracking_bpe")
def q_bpe(spark, sf):
    coded = bpe.decode(bpe.encode(read(spark, sf, "documents")))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@register("op13_laesa_clusters")
def q_clusters(spark, sf):
    return centroids.centroid_clusters(read(spark, sf, "embeddings"))


_NORM = "regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')"

def _cluster_sql(clusters: int = centroids.CLUSTERS, rounds: int = centroids.ROUNDS) -> str:
    """Every distance of every round, and the means by component."""
    def assigned(name: str, before: str) -> str:
        return f"""
        {name} AS (SELECT row_no, any_value(vec_id) AS vec_id, any_value(v) AS v,
                          arg_min(c, (d, c)) AS c, min(d) AS d FROM (
            SELECT k.row_no, k.vec_id, k.v, m.c,
                   list_sum(list_transform(list_zip(k.v, m.m), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
            FROM k CROSS JOIN {before} m) GROUP BY row_no)"""

    steps = [f"""
        k AS (SELECT row_number() OVER () AS row_no, vec_id,
                     list_transform(embedding, lambda x: floor({centroids.SCALE} * x::DOUBLE)::BIGINT) AS v
              FROM embeddings WHERE len(embedding) = {centroids.DIMENSIONS} AND
                   len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {centroids.DIMENSIONS}),
        m0 AS (SELECT row_number() OVER (ORDER BY sha256('{centroids.SEED}:' || vec_id), v) - 1 AS c, v AS m
               FROM k QUALIFY c < {clusters})"""]
    for i in range(rounds):
        steps.append(assigned(f"a{i}", f"m{i}"))
        steps.append(f"""
        s{i} AS (SELECT c, j, sum(x) AS s, count(*) AS n
                 FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM a{i}) GROUP BY c, j),
        m{i + 1} AS (SELECT m{i}.c, coalesce(f.m, m{i}.m) AS m FROM m{i} LEFT JOIN (
            SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS m FROM s{i} GROUP BY c) f USING (c))""")
    steps.append(assigned("z", f"m{rounds}"))
    return "WITH " + ",".join(steps) + f"""
        SELECT vec_id, z.c::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY z.c))::BIGINT AS cluster_inertia,
               (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
        FROM z JOIN m{rounds} USING (c)"""


SQL: dict[str, str] = {
    "op13_laesa_clusters": _cluster_sql(),
    "op4_stateful_exact_dedup": f"""
        WITH t AS (SELECT doc_id, {_NORM} AS norm, length(coalesce(text, '')) AS points FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
               doc_id = first_value(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY norm ORDER BY points DESC, doc_id)""",
    "op6_snapshot_collapse_chat": """
        WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS pos,
                          count(*) OVER (PARTITION BY conv_id) AS n_turns,
                          '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS line
                   FROM conversations),
        p AS (SELECT conv_id, pos, n_turns,
                     string_agg(line, '') OVER (PARTITION BY conv_id ORDER BY pos) AS prefix FROM t),
        b AS (SELECT pos, prefix, max(n_turns) AS longest FROM p GROUP BY pos, prefix),
        c AS (SELECT p.pos, p.prefix, min(p.conv_id) AS covered_by FROM p JOIN b
              ON p.pos = b.pos AND p.prefix = b.prefix AND p.n_turns = b.longest GROUP BY p.pos, p.prefix)
        SELECT e.conv_id, e.n_turns, c.covered_by, e.conv_id = c.covered_by AS kept, 0::INT AS part,
               CASE WHEN e.conv_id = c.covered_by THEN e.prefix END AS rendered
        FROM p e JOIN c ON e.pos = c.pos AND e.prefix = c.prefix WHERE e.pos = e.n_turns - 1""",
    "op10_url_rules": f"""
        WITH rules(action, rhost, rpath) AS (VALUES {', '.join(str(r) for r in RULES)}),
        s AS (SELECT page_id, row_number() OVER () AS row_no,
                     CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
              FROM pages),
        u AS (SELECT page_id, row_no, lower(regexp_extract(rest, '^[^/?#]*')) AS host,
                     regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM s),
        m AS (SELECT u.*, rhost || rpath AS rule, action,
                     row_number() OVER (PARTITION BY row_no ORDER BY length(rhost) + length(rpath) DESC,
                                        length(rhost) DESC, action DESC) AS k
              FROM u LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
        SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM m WHERE k = 1""",
}
