"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.llm import chat_format, collocations, decontam, importance, jaccard_join, knn_join, langid, lm_score, packing, quality, repeats, secrets, toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the machine's public tokenizer files are."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn_join.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_ctw_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(table(spark, sf_dir, "documents"))


#: The conversation that the op8 query adds: texts made of control strings.
CONTROL_ROWS = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    return chat_format.format_conversations(rows.unionByName(spark.createDataFrame(CONTROL_ROWS, "conv_id long, turn long, role string, text string")))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.dedup(table(spark, sf_dir, "documents"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_voronoi_knn": op1_voronoi_knn,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_toxicity": op3_toxicity,
    "op4_ctw_lm": op4_ctw_lm,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_secret_scan": op6_secret_scan,
    "op7_language_id": op7_language_id,
    "op8_chat_format": op8_chat_format,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_decontamination": op10_decontamination,
    "op11_collocations": op11_collocations,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_importance_resampling": op13_importance_resampling,
}
ORACLES: dict[str, str] = {
    "op1_voronoi_knn": """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.x, v.x) AS BIGINT) AS score
  FROM v AS q JOIN v ON v.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 20""",
    "op5_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 90 * (na.n + nb.n - count(*))),
r AS (SELECT doc_id AS x, doc_id AS c FROM documents UNION SELECT links.y, r.c FROM r JOIN links ON links.x = r.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.c) AS component_id FROM documents d JOIN r ON r.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id, n.n""",
    "op8_chat_format": r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, length(role) + length(text)
    + len(regexp_extract_all(role || ' ' || text, '<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|\\'))
    + CASE WHEN role = 'assistant' THEN 15 ELSE 17 END AS chars FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id""",
    "op11_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
sizes AS (SELECT lang, sum(len(ws)) AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, unnest(flatten(list_transform([1, 2, 3, 4], lambda k: list_transform(range(1, greatest(len(ws) - k + 2, 1)), lambda i: ws[i : i + k - 1])))) AS g FROM words),
f AS (SELECT lang, g, count(*) AS a FROM grams GROUP BY lang, g HAVING count(*) >= 30),
parted AS (SELECT lang, g, a, k, g[1:k] AS first, g[k + 1:] AS rest FROM (SELECT lang, g, a, unnest(range(1, len(g))) AS k FROM f)),
cuts AS (
  SELECT p.lang, p.g, p.a, k, x.a AS l, y.a AS r, CAST((2000000::HUGEINT * p.a) // (x.a + y.a) AS BIGINT) AS score
  FROM parted p JOIN f AS x ON x.lang = p.lang AND x.g = p.first JOIN f AS y ON y.lang = p.lang AND y.g = p.rest),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inner_ones AS (
  SELECT lang, a, unnest(flatten(list_transform([2, 3], lambda k: list_transform(range(1, greatest(len(g) - k + 2, 1)), lambda i: g[i : i + k - 1])))) AS g, len(g) AS size FROM f WHERE len(g) > 2),
most AS (SELECT lang, g, max(a) AS most FROM inner_ones WHERE len(g) < size GROUP BY lang, g),
kept AS (SELECT b.*, array_to_string(b.g, ' ') AS phrase FROM best b LEFT JOIN most m ON m.lang = b.lang AND m.g = b.g WHERE most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score
FROM kept JOIN sizes USING (lang) QUALIFY rank <= 2000""",
    "op12_suffix_dedup": r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT doc_id, i, md5(substr(x, CAST(2 * i + 1 AS BIGINT), 200)) AS h FROM (SELECT doc_id, x, unnest(range(0, length(x) // 2 - 99)) AS i FROM d)),
seen AS (SELECT h, min({'d': doc_id, 'i': i}) AS first FROM w GROUP BY h HAVING count(*) > 1),
hit AS (SELECT w.doc_id, w.i FROM w JOIN seen USING (h) WHERE seen.first.d <> w.doc_id OR seen.first.i <> w.i),
runs AS (
  SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM (
    SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (
      SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS fresh FROM hit)) GROUP BY doc_id, run),
keep AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM runs
  UNION ALL SELECT doc_id, max(b), NULL FROM runs GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(substr(x, CAST(2 * a + 1 AS BIGINT), CAST(2 * (coalesce(b, length(x)) - a) AS BIGINT)), '' ORDER BY a) AS x FROM keep JOIN d USING (doc_id) GROUP BY doc_id),
gone AS (SELECT doc_id, sum(b - a) AS n, count(*) AS spans FROM runs GROUP BY doc_id)
SELECT d.doc_id, length(d.x) // 2 AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(coalesce(kept.x, d.x))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN gone USING (doc_id)""",
    "op13_importance_resampling": r"""
WITH tab AS (
  SELECT list(list_reduce(range(0, 8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS t
  FROM (SELECT unnest(range(0, 256)) AS b)),
texts AS (
  SELECT doc_id, false AS target, row_number() OVER () AS k, text FROM documents
  UNION ALL SELECT NULL, true, -row_number() OVER (), text FROM benchmark),
words AS (
  SELECT k, target, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM texts),
hashed AS (
  SELECT w, xor(list_reduce(list_transform(range(0, octet_length(encode(w))), lambda i: ('0x' || substr(hex(encode(w)), CAST(2 * i + 1 AS BIGINT), 2))::BIGINT),
    lambda c, b: xor(t[CAST(xor(c, b) & 255 AS BIGINT) + 1], c >> 8), 4294967295::BIGINT), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT w FROM words), tab),
totals AS (SELECT bucket, count(*) FILTER (WHERE NOT target) AS s, count(*) FILTER (WHERE target) AS t FROM words JOIN hashed USING (w) GROUP BY bucket),
sizes AS (SELECT sum(s) AS n_s, sum(t) AS n_t FROM totals),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(((t + 1)::DOUBLE * (n_s + 10000)::DOUBLE) / ((s + 1)::DOUBLE * (n_t + 10000)::DOUBLE))) AS BIGINT) AS gain FROM totals, sizes),
weights AS (
  SELECT k, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight FROM words JOIN hashed USING (w) JOIN gains USING (bucket) WHERE NOT target GROUP BY k),
scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM texts LEFT JOIN weights USING (k) WHERE NOT target),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS FIRST) AS place, count(*) OVER (PARTITION BY n_features >= 20) AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank FROM placed""",
}
