"""The subpackage's named queries over the test tables, with the parameters meant for production."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.llm import (
    decontaminate, fill_middle, hard_negatives, jaccard_join, katz, line_templates, nearest, packing, page_text, personal_data, sharding,
    token_counts, toxicity,
)
from pitchlake.llm.storage import fresh_folder, table


#: Scores from here on count as toxic.
TOXIC_FROM = 0.3


def remainder(key: str, modulus: int) -> Column:
    """crc32 of the id as text; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % modulus


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    scored = toxicity.score(documents, labels, learn=remainder("doc_id", 4) != 2)
    return scored.select(
        "doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.best_fit_pack(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, special=packing.SPECIAL,
    )
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(table(spark, sf_dir, "documents"), held_out=remainder("doc_id", 7) == 2)


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.shuffle_into_shards(table(spark, sf_dir, "documents"), "doc_id", "text", shards=8)
    return shards.select(
        "doc_id", sharding.record_size(F.col("text")).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"), F.lit("key").alias("law"),
        "shard", "slot", "grown_shard",
    )


def op7_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = page_text.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = F.array(*[F.lit(k) for k in personal_data.KINDS])

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(personal_data.KINDS)]
    return found.select(
        "doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.array_sort(F.concat("base", "added"))).alias("spans"), F.size("added").cast("long").alias("n_added"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_join.similar_groups(documents, k=4, percent=85)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_templates.drop_recurring_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", "text")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors, seventh = table(spark, sf_dir, "embeddings"), F.col("vec_id") % 7 == 0
    vectors = vectors.withColumn("label", F.when(seventh, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0)


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a new cache for each call, so that every distinct text is encoded: the cold case."""
    documents = table(spark, sf_dir, "documents")
    return token_counts.count_tokens(documents, public_tokenizers.path("byte_bpe_50k.json"), fresh_folder(spark, "token-counts"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.fill_in_middle(table(spark, sf_dir, "documents"), with_output=True)
    columns = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256"]
    return fill_middle.restore(made, keep=columns, with_text=False)


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_best_fit_packing, op3_decontamination, op4_katz_backoff, op5_nearest_neighbours, op6_sharding, op7_page_text,
    op8_personal_data, op9_jaccard_join, op10_line_dedup, op11_hard_negatives, op12_token_counts, op13_fill_in_middle,
)}

#: DuckDB SQL where SQL can express the operator and is fast enough on whole tables.
ORACLE = {
    "op10_line_dedup": """
WITH parts AS (SELECT doc_id, text, string_split(text, chr(10)) AS p FROM documents),
raw AS (SELECT doc_id, unnest(range(len(p))) AS line_no, unnest(p) AS line FROM parts WHERE text IS NOT NULL),
clean AS (SELECT doc_id, line_no, trim(regexp_replace(line, '[ \\t\\r]+', ' ', 'g'), ' ') AS line FROM raw),
toks AS (SELECT doc_id, line_no, string_split(line, ' ') AS w FROM clean WHERE line <> ''),
parsed AS (SELECT doc_id, line_no, len(w) AS n, concat_ws(chr(10), len(w)::VARCHAR,
           regexp_replace(lower(array_to_string(w[1:8], ' ')), '[^ ]*(?:[0-9@]|://)[^ ]*', '<*>', 'g'),
           CASE WHEN len(w) > 8 THEN regexp_replace(lower(array_to_string(w[greatest(9, len(w) - 3):], ' ')),
                                                    '[^ ]*(?:[0-9@]|://)[^ ]*', '<*>', 'g') END) AS ends,
           CASE WHEN len(w) > 50 THEN regexp_replace(lower(array_to_string(w, ' ')), '[^ ]*(?:[0-9@]|://)[^ ]*', '<*>', 'g') END AS whole
           FROM toks),
leaf AS (SELECT doc_id, line_no, n, concat_ws(chr(10), ends, whole) AS t,
         n > 50 AND length(ends) - length(replace(ends, '<*>', '')) <= 3 * 4 AS passage FROM parsed),
per AS (SELECT doc_id, t, sum(n) AS k, bool_or(passage) AS passage FROM leaf GROUP BY doc_id, t),
known AS (SELECT *, ('0x' || substr(md5(t), 1, 15))::BIGINT AS digest FROM per
          WHERE t IN (SELECT t FROM per GROUP BY t HAVING count(*) >= 2)),
share AS (SELECT doc_id, sum(k) AS r, max({'k': k, 'digest': digest}).digest AS longest FROM known GROUP BY doc_id),
total AS (SELECT doc_id, sum(n) AS a FROM leaf GROUP BY doc_id),
ballots AS (SELECT t, passage, doc_id, longest, (r - k) * 100 > (a - k) * 60 OR a = k AS copy
            FROM known JOIN share USING (doc_id) JOIN total USING (doc_id)),
drops AS (SELECT t FROM ballots GROUP BY t HAVING count(DISTINCT longest) FILTER (WHERE copy)
          + count(DISTINCT doc_id) FILTER (WHERE NOT copy) >= CASE WHEN bool_or(passage) THEN 2 ELSE 10 END),
gone AS (SELECT doc_id, line_no FROM leaf WHERE t IN (SELECT t FROM drops)),
kept AS (SELECT r.doc_id, string_agg(r.line, chr(10) ORDER BY r.line_no) AS text
         FROM raw r ANTI JOIN gone g ON r.doc_id = g.doc_id AND r.line_no = g.line_no GROUP BY r.doc_id),
n AS (SELECT doc_id, count(*) AS k FROM gone GROUP BY doc_id)
SELECT p.doc_id, coalesce(len(p.p), 0) AS n_lines, coalesce(n.k, 0) AS n_dropped,
       CASE WHEN p.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text
FROM parts p LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)
""",
    "op11_hard_negatives": """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.e, b.e)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND b.vec_id <> a.vec_id),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
n AS (SELECT p.*, s.other_id AS negative_id, s.score AS negative_score,
      row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.other_id)::INTEGER AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
        AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
""",
    "op13_fill_in_middle": """
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS d FROM documents),
h AS (SELECT doc_id, t, ('0x' || d[1:8])::BIGINT AS h1, ('0x' || d[9:16])::BIGINT AS h2, ('0x' || d[17:24])::BIGINT AS h3,
      ('0x' || d[25:32])::BIGINT AS h4, string_split(t, chr(10)) AS p FROM texts),
u AS (SELECT *, len(p) - CASE WHEN p[len(p)] = '' THEN 1 ELSE 0 END AS n FROM h),
f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
      CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
           WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
c AS (SELECT *, CASE WHEN a = 0 THEN '' WHEN a = n THEN t ELSE array_to_string(p[1:a], chr(10)) || chr(10) END AS upto_a,
      CASE WHEN b = 0 THEN '' WHEN b = n THEN t ELSE array_to_string(p[1:b], chr(10)) || chr(10) END AS upto_b FROM f),
s AS (SELECT *, upto_a AS prefix, substr(upto_b, length(upto_a) + 1) AS middle, substr(t, length(upto_b) + 1) AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM s
""",
}
