"""Registered queries of the training-data operators and their DuckDB SQL.

Each query applies its operator, with production parameters, to the whole of its
table; the operators' own interfaces (texts, spans, mixtures, mined rules) stay in their modules.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notecodes.llm import brown, decontaminate, extract, fingerprint, guesscost, hardneg, langid, neardup, packing, quality, toxicity, url_rules, variants


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_fingerprints(table(spark, sf_dir, "documents"))


def op2_brown_class_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.scores(table(spark, sf_dir, "documents"))


def op3_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(table(spark, sf_dir, "documents")).drop("mixture")


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judged(table(spark, sf_dir, "pages"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated"
    )


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.main_texts(table(spark, sf_dir, "pages"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hardneg.mine(rows.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % 100 == 0)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = guesscost.secrets(table(spark, sf_dir, "documents"))
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != "guess")
    return found.select(
        "doc_id", of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"),
        F.sha2(guesscost.joined(base).cast("binary"), 256).alias("base_sha256"), guesscost.joined(F.col("spans")).alias("spans"),
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_document_fingerprints, op2_brown_class_scores, op3_language_mixture, op4_url_rules, op5_toxicity, op6_decontamination,
        op7_best_fit_packing, op8_quality, op9_main_text, op10_minhash_near_dedup, op11_hard_negatives, op12_secret_spans, op13_spelling_variants,
        pipeline,
    ]
    return {f.__name__: f for f in found}


#: Lower-cased words of op6 and the ten-word windows of the items; a window occurs where it equals a document's words.
_OP6 = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS m, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS t
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), ms AS (SELECT DISTINCT m FROM win),
dw AS (
  SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS t
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, ms WHERE len(w) >= m)
), hit AS (SELECT DISTINCT dw.doc_id, dw.i, dw.m, win.item_id FROM dw JOIN win ON dw.m = win.m AND dw.t = win.t),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""

#: Links by shared shingles, then the smallest id reachable.
_OP10 = """
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT g FROM s GROUP BY g HAVING count(*) > 1),
t AS (SELECT s.* FROM s SEMI JOIN shared ON s.g = shared.g),
link AS (
  SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM t x JOIN t y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id) p
  JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b WHERE 100 * c >= 75 * (na.n + nb.n - c)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, l.b FROM reach r JOIN link l ON l.a = r.other
), comp AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, comp.component_id, d.doc_id = comp.component_id AS kept
FROM d JOIN comp USING (doc_id) LEFT JOIN n USING (doc_id)
"""

#: Every anchor's score with every row, then places by (score, smaller id).
_OP11 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT s.same AND 100 * s.score BETWEEN 80 * positive_score AND 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) <= 5
"""

#: CRC-32 byte by byte from its polynomial; near words meet in one of them less a code point, at the same place.
_OP13 = """
WITH RECURSIVE t AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab
), r AS (
  SELECT doc_id, w, count(*) AS m FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{C0}-\\x{FF}]+')) AS w FROM documents
  ) WHERE length(w) >= 6 GROUP BY doc_id, w
), b AS (
  SELECT w, m, flatten(list_transform(string_split(concat(doc_id, ':', w), ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [CAST(195 AS BIGINT), CAST(unicode(c) - 64 AS BIGINT)] END)) AS bytes FROM r
), h AS (
  SELECT w, m, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes), lambda c, x: xor(c >> 8, tab[xor(c & 255, x) + 1])), 4294967295) AS h FROM b, t
), e AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(w, CAST(h % length(w) AS BIGINT)) || substr(w, CAST(h % length(w) AS BIGINT) + 2) ELSE w END AS w, m FROM h
), v AS (SELECT w, sum(m) AS n FROM e WHERE length(w) >= 6 GROUP BY w HAVING sum(m) >= 5),
d AS (SELECT w, n, i, left(w, i - 1) || '$' || substr(w, i + 1) AS k FROM (SELECT w, n, unnest(range(1, length(w) + 1)) AS i FROM v)),
a AS (SELECT w, n, left(w, i) || '$' || substr(w, i + 1) AS k FROM (SELECT w, n, unnest(range(0, length(w) + 1)) AS i FROM v)),
near AS (
  SELECT x.w, x.n, y.w AS o, y.n AS p FROM d x JOIN d y ON x.k = y.k AND x.w <> y.w
  UNION SELECT x.w, x.n, y.w, y.n FROM d x JOIN a y ON x.k = y.k
  UNION SELECT y.w, y.n, x.w, x.n FROM d x JOIN a y ON x.k = y.k
), best AS (
  SELECT w, n, count(*) AS n_near, arg_min(o, (-p, o)) AS o, max(p) AS p FROM near GROUP BY w, n
), form AS (SELECT w, n_near, CASE WHEN p >= 5 * n THEN o END AS form, CASE WHEN p >= 5 * n THEN p END AS form_n FROM best),
chain(w, now, step) AS (
  SELECT w, w, 0 FROM v UNION ALL SELECT c.w, f.form, c.step + 1 FROM chain c JOIN form f ON f.w = c.now WHERE f.form IS NOT NULL
)
SELECT v.w AS word, f.form, c.root, CAST(v.n AS BIGINT) AS n, CAST(coalesce(f.n_near, 0) AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM v LEFT JOIN form f ON f.w = v.w JOIN (SELECT w, arg_max(now, step) AS root FROM chain GROUP BY w) c ON c.w = v.w
"""


def oracle_sql() -> dict[str, str]:
    return {"op6_decontamination": _OP6, "op10_minhash_near_dedup": _OP10, "op11_hard_negatives": _OP11, "op13_spelling_variants": _OP13}
