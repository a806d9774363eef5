"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quantloom.llm import clustering, codes, decontaminate, exact_dedup, html_extract, line_dedup, mixing, packing, pii, quality, simhash, substring, url_filter
from quantloom.llm._spark import bound_batches


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.remove_repeats(table(spark, sf_dir, "documents"), window=35)
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), size=3, max_bits=3)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.remove_boilerplate(table(spark, sf_dir, "documents"), min_sites=8).select("doc_id", "text", "n_lines", "n_removed")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), url_filter.RULES)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_documents(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), length=1024, end_id=2)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_main_text(table(spark, sf_dir, "pages"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix_sources(table(spark, sf_dir, "documents"), weights=(5, 2, 1), share_pct=150, max_epochs=2)
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster_vectors(table(spark, sf_dir, "embeddings"), k=8, rounds=10, dims=64, scale=1024, seed=3)


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = codes.compress_vectors(table(spark, sf_dir, "embeddings"), parts=8, entries=16, rounds=6, dims=64, scale=4096)
    return out.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_simhash": op2_simhash,
    "op3_line_dedup": op3_line_dedup,
    "op4_url_filter": op4_url_filter,
    "op5_quality": op5_quality,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_decontamination": op7_decontamination,
    "op8_html_extraction": op8_html_extraction,
    "op9_pii": op9_pii,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_mixing": op11_mixing,
    "op12_centroid_clustering": op12_centroid_clustering,
    "op13_vector_codes": op13_vector_codes,
}


def _clustering_sql(k: int = 8, rounds: int = 10, dims: int = 64) -> str:
    """The rounds of exact k-means, one after the other."""
    parts = [f"""v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS id, vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {dims} AND list_count(list_filter(embedding, lambda x: isfinite(x))) = {dims}
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS k, v AS c FROM (SELECT v, sha256('3:' || vec_id) AS h FROM v WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT {k})
)"""]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (
  SELECT id, min({{'d': d, 'k': k}}) AS m FROM (SELECT id, k, list_sum(list_transform(range(1, {dims} + 1), lambda i: (v[i] - c[i]) * (v[i] - c[i])))::BIGINT AS d FROM v, c{r}) GROUP BY 1
)""")
        if r < rounds:
            parts.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c{r}.k, coalesce(n.c, c{r}.c) AS c FROM c{r} LEFT JOIN (
    SELECT k, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS c FROM (
      SELECT m.k AS k, i, sum(v[i])::BIGINT AS s, count(*) AS n FROM a{r} JOIN v USING (id), range(1, {dims} + 1) g(i) GROUP BY 1, 2
    ) GROUP BY k
  ) n USING (k)
)""")
    return "WITH " + ", ".join(parts) + f"""
SELECT vec_id, m.k::INTEGER AS cluster, m.d AS distance, sum(m.d) OVER (PARTITION BY m.k)::BIGINT AS cluster_inertia, sum(m.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (id) JOIN c{rounds} ON c{rounds}.k = m.k"""


def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6, dims: int = 64) -> str:
    """The rounds of each part's codebook, one after the other."""
    width = dims // parts
    out = [f"""v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS id, vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * 4096)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {dims} AND list_count(list_filter(embedding, lambda x: isfinite(x))) = {dims}
), x AS MATERIALIZED (SELECT id, p, v[p * {width} + 1:p * {width} + {width}] AS v FROM v, range({parts}) g(p)
), b0 AS MATERIALIZED (
  SELECT p, e, v AS c FROM x JOIN (SELECT id, row_number() OVER (ORDER BY vec_id, v) - 1 AS e FROM v ORDER BY vec_id, v LIMIT {entries}) USING (id)
)"""]
    for r in range(rounds + 1):
        out.append(f"""a{r} AS MATERIALIZED (
  SELECT id, p, min({{'d': d, 'e': e}}) AS m FROM (SELECT id, p, e, list_sum(list_transform(range(1, {width} + 1), lambda i: (v[i] - c[i]) * (v[i] - c[i])))::BIGINT AS d FROM x JOIN b{r} USING (p)) GROUP BY 1, 2
)""")
        if r < rounds:
            out.append(f"""b{r + 1} AS MATERIALIZED (
  SELECT b{r}.p, b{r}.e, coalesce(n.c, b{r}.c) AS c FROM b{r} LEFT JOIN (
    SELECT p, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS c FROM (
      SELECT p, m.e AS e, i, sum(v[i])::BIGINT AS s, count(*) AS n FROM a{r} JOIN x USING (id, p), range(1, {width} + 1) g(i) GROUP BY 1, 2, 3
    ) GROUP BY p, e
  ) n USING (p, e)
)""")
    return "WITH " + ", ".join(out) + f""", coded AS (SELECT id, string_agg(printf('%02x', m.e), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error FROM a{rounds} GROUP BY 1)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM b{rounds}) AS codebooks_sha256
FROM coded JOIN v USING (id)"""


ORACLES: dict[str, str] = {
    "op1_substring_dedup": r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), starts AS (
  SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35
), wins AS (
  SELECT doc_id, i, md5(array_to_string(ws[i:i+34], ' ')) AS h FROM starts
), rep AS (
  SELECT doc_id, i FROM wins WHERE h IN (SELECT h FROM wins GROUP BY h HAVING count(*) > 1)
), hit AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM rep
), pos AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w
), kept AS (
  SELECT pos.doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM pos ANTI JOIN hit USING (doc_id, p) GROUP BY 1
)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)""",
    "op3_line_dedup": r"""
WITH l AS (
  SELECT doc_id, text, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE text IS NOT NULL
), t AS (
  SELECT doc_id, source, i, line, regexp_replace(line, '^[ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+$', '', 'g') AS k FROM l
), bad AS (
  SELECT k, min(doc_id) AS keeper FROM t WHERE k <> '' GROUP BY k HAVING count(DISTINCT source) >= 8
), m AS (
  SELECT doc_id, i, line, t.k, keeper IS NOT NULL AND doc_id <> keeper AS gone FROM t LEFT JOIN bad USING (k)
), g AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone) AS text, count(*) FILTER (k <> '') AS n_lines, count(*) FILTER (gone) AS n_removed FROM m GROUP BY 1
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(g.text, '') END AS text, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed
FROM documents d LEFT JOIN g USING (doc_id)""",
    "op7_decontamination": r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents
), b AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(10, len(ws)) AS n, array_to_string(ws[i:i+least(10, len(ws))-1], ' ') AS win
  FROM (SELECT item_id, ws, unnest(range(1, greatest(1, len(ws) - 9) + 1)) AS i FROM b WHERE len(ws) > 0)
), sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(ws[i:i+n-1], ' ') AS win
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, sizes WHERE len(ws) >= n)
), occ AS (SELECT doc_id, dw.n, i, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM occ) GROUP BY 1),
items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS h
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM occ) GROUP BY 1
)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
  CASE WHEN len(ws) > 0 THEN coalesce(n_hit, 0)::DOUBLE / len(ws) ELSE 0.0 END AS coverage
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op10_exact_dedup": r"""
WITH n AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents
)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM n WINDOW w AS (PARTITION BY text_sha256)""",
    "op11_mixing": r"""
WITH d AS (
  SELECT doc_id, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS k,
    md5('11:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS h FROM documents
), s AS (
  SELECT k, sum(size)::BIGINT AS n, ([5, 2, 1])[((row_number() OVER (ORDER BY k) - 1) % 3 + 1)::BIGINT] AS w FROM d GROUP BY k
), filling AS (
  SELECT *, 150 * sum(n) OVER () - 200 * coalesce(sum(n) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    100 * sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS den, row_number() OVER o AS i FROM s WINDOW o AS (ORDER BY n::DOUBLE / w, k)
), level AS (SELECT rest, den, i FROM filling WHERE 2 * n * den > rest * w ORDER BY i LIMIT 1
), t AS (
  SELECT k, n, CASE WHEN level.i IS NULL OR filling.i < level.i THEN (2 * n)::DOUBLE ELSE (level.rest * w)::DOUBLE / level.den::DOUBLE END AS target FROM filling LEFT JOIN level ON true
), p AS (
  SELECT *, coalesce(round(target)::BIGINT // nullif(n, 0), 0) AS whole FROM t
), c AS (
  SELECT d.*, p.n, p.target, p.whole, round(p.target)::BIGINT - p.whole * p.n AS rest, sum(size) OVER (PARTITION BY d.k ORDER BY h) AS upto, sum(size) OVER (PARTITION BY d.k, h) AS unit FROM d JOIN p USING (k)
)
SELECT doc_id, size, n AS source_size, target,
  (whole * size + CASE WHEN upto <= rest THEN size WHEN upto - unit < rest THEN size * (rest - upto + unit) // unit ELSE 0 END)::BIGINT AS taken FROM c""",
    "op12_centroid_clustering": _clustering_sql(),
    "op13_vector_codes": _codes_sql(),
}
