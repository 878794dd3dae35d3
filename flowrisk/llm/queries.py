"""The registered queries of the operators, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowrisk.llm import collocations, decontaminate, fingerprint, hard_negatives, language_model, mixing, near_text, near_vectors, packing, secrets, substring, toxicity, warc
from flowrisk.llm.common import table

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring.remove_repeats(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_ppm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return language_model.scores(table(spark, folder, "documents")).withColumn("held_out", ~language_model.training())


def op3_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix_sources(mixing.document_sizes(table(spark, folder, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"),
                        "source", "copies")


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.scored(table(spark, folder, "documents"), table(spark, folder, "labels")).drop("text")


def op5_vector_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, folder, "embeddings"))


def op6_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_text.near_duplicates(table(spark, folder, "documents"))


def op7_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    rows = fingerprint.edited_fingerprints(table(spark, folder, "documents"))
    return rows.withColumn("edited_sha256", F.sha2("edited", 256)).drop("edited", "bins", "edited_bins")


def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = secrets.fit(secrets.labelled_samples(docs))
    found, base = F.col("found"), F.filter("found", lambda s: s["kind"] < 3)
    count = lambda kind: F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")
    return secrets.scan(docs, model).select(
        "doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(secrets.KINDS)],
        F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(found).alias("spans"))


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    r = F.col("response")
    return warc.round_trip(table(spark, folder, "pages"), with_payload=False).select(
        "page_id", r["payload_bytes"].alias("payload_bytes"), r["payload_digest"].alias("payload_digest"),
        r["type"].alias("record_type"), r["refers_to"].alias("refers_to"))


def op10_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    capacity = packing.Capacity()
    pieces = packing.tokenized_pieces(table(spark, folder, "documents"), tokenizer_path(), capacity.tokens)
    return packing.pack(pieces, capacity)


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


def op12_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, folder, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_substring_dedup, op2_ppm_scoring, op3_source_mixing, op4_toxicity, op5_vector_dedup, op6_order_minhash, op7_fingerprints,
    op8_secrets, op9_warc, op10_best_fit_packing, op11_collocations, op12_decontamination, op13_hard_negatives)}

CHECKS = {
    "op1_substring_dedup": r"""
      WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
      k AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS h
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w)),
      hit AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY h) AS m FROM k) WHERE m < doc_id),
      gone AS (SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(range(i, i + 50)) AS p FROM hit) GROUP BY doc_id),
      kept AS (SELECT w.doc_id, len(ws) AS n, coalesce(len(ps), 0) AS g,
          [ws[p] FOR p IN range(1, len(ws) + 1) IF NOT list_contains(coalesce(ps, []), p)] AS ks
        FROM w LEFT JOIN gone USING (doc_id))
      SELECT doc_id, n AS n_words, g AS n_removed, sha256(array_to_string(ks, ' ')) AS kept_sha256 FROM kept""",
    "op9_warc": """
      WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha1(coalesce(html, '')) AS d FROM pages),
      g AS (SELECT *, octet_length(b) AS n, max(page_id) OVER (PARTITION BY d, octet_length(b)) AS m FROM p)
      SELECT page_id, n AS payload_bytes, d AS payload_digest,
        CASE WHEN n >= 1000 AND m <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN n >= 1000 AND m <> page_id THEN m END AS refers_to
      FROM g""",
    "op11_collocations": r"""
      WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
      words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
      grams AS (SELECT lang, k, ws[i:i + k - 1] AS p FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
                FROM words, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(ws) >= k)),
      f AS (SELECT lang, k, p, count(*) AS a FROM grams GROUP BY ALL),
      n AS (SELECT lang, sum(a) AS n FROM f WHERE k = 1 GROUP BY 1),
      c AS (SELECT * FROM f WHERE k > 1 AND a >= 30),
      cuts AS (SELECT c.lang, c.k, c.p, c.a, j, x.a AS l, y.a AS r, CAST(c.a AS HUGEINT) * 2000000 // (x.a + y.a) AS score
               FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c JOIN f x ON x.lang = c.lang AND x.p = c.p[1:j]
                 JOIN f y ON y.lang = c.lang AND y.p = c.p[j + 1:c.k]),
      best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, j) AS o FROM cuts) WHERE o = 1),
      inside AS (SELECT lang, p[i:i + m - 1] AS p, max(a) AS longer FROM (SELECT lang, p, a, k, m, unnest(range(1, k - m + 2)) AS i
                 FROM c, (SELECT unnest([2, 3]) AS m) WHERE m < k) GROUP BY ALL),
      kept AS (SELECT best.* FROM best LEFT JOIN inside USING (lang, p) WHERE longer IS NULL OR 100 * longer < 80 * best.a),
      ranked AS (SELECT *, array_to_string(p, ' ') AS phrase, row_number() OVER (PARTITION BY lang
                 ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank FROM kept)
      SELECT lang, rank, phrase, a, l, r, CAST(n.n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
      FROM ranked JOIN n USING (lang) WHERE rank <= 2000""",
    "op12_decontamination": r"""
      WITH d AS (SELECT doc_id, row_number() OVER () AS o, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
          'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
      b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
      bw AS (SELECT DISTINCT item_id, m, ws[i:i + m - 1] AS w FROM (SELECT *, least(len(ws), 10) AS m, unnest(range(1, greatest(len(ws) - 8, 2))) AS i
             FROM b WHERE len(ws) > 0)),
      dw AS (SELECT o, i, m, ws[i:i + m - 1] AS w FROM (SELECT o, ws, m, unnest(range(1, len(ws) - m + 2)) AS i
             FROM d, (SELECT DISTINCT m FROM bw) WHERE len(ws) >= m)),
      hits AS (SELECT o, i, dw.m, item_id FROM dw JOIN bw USING (m, w)),
      covered AS (SELECT o, count(DISTINCT wi) AS n_hit FROM (SELECT o, unnest(range(i, i + m)) AS wi FROM hits) GROUP BY 1),
      found AS (SELECT o, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
                FROM (SELECT DISTINCT o, coalesce(CAST(item_id AS VARCHAR), '') AS item FROM hits) GROUP BY 1)
      SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
      FROM d LEFT JOIN covered USING (o) LEFT JOIN found USING (o)""",
    "op13_hard_negatives": """
      WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
          list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS x
        FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
      s AS (SELECT a.vec_id AS anchor_id, o.vec_id AS vec_id, a.label = o.label AS same, CAST(list_inner_product(a.x, o.x) AS BIGINT) AS score
            FROM v a JOIN v o ON a.vec_id % 100 = 0 AND a.vec_id <> o.vec_id),
      p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS o FROM s WHERE same) WHERE o <= 5),
      n AS (SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, s.vec_id AS negative_id, s.score AS negative_score,
              row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank
            FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
              AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
      SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5""",
}
