"""The registered queries of this subpackage, each over its whole table, and SQL for those that SQL expresses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landrank.llm import jaccard, licenses, lm, manifest, media, mixing, pii, segment, shards, toxicity, tries, vectors, warc
from landrank.llm.common import small_batches, table


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    records = warc.read_back(warc.archive(table(spark, sf_dir, "pages")), payloads=False).filter("kind = 'record'")
    number = lambda c: F.expr(f"try_cast(substring_index({c}, ':', -1) as bigint)")
    return records.select(number("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"), "payload_digest",
                          "record_type", number("refers_to").alias("refers_to"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    scored = toxicity.toxicity(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", (toxicity.fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
                         (F.col("score") >= toxicity.DECISION).cast("int").alias("predicted"), "threshold", "rejected")


def op4_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op5_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_features(table(spark, sf_dir, "documents")).drop("height", "width", "tile_npy")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shards.sharded(table(spark, sf_dir, "documents"), 16)
    return rows.select("doc_id", shards.text_size().alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
                       F.lit("rows").alias("law"), "shard", F.col("slot").cast("long"), F.lit(None).cast("int").alias("grown_shard"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.surrogates(docs).select("doc_id", "text", F.size("entities").alias("n_entities"), "entities")


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_groups(table(spark, sf_dir, "documents"), size=3, threshold=0.9).select("doc_id", "n_shingles", "component_id")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = segment.encode(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return segment.decode(coded).select("doc_id", "ids", F.size("ids").alias("n_pieces"),
                                        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("lossless"))


def op10_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.mixing_scores(table(spark, sf_dir, "documents"))


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("spans")


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tries.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_warc, op2_mixing, op3_toxicity, op4_vectors, op5_media, op6_sharding, op7_pii,
                                   op8_jaccard, op9_sentencepiece, op10_lm, op11_licenses, op12_trie,
                                   op13_manifest)}

_FIELDS = " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}, '-')" for c in manifest.COLUMNS)
_NOTICES = ", ".join([f"('{label}', true, 1.0, '{text}')" for label, text in licenses.PHRASES] + [f"('{label}', false, {least}, '{text}')" for label, least, text in licenses.NOTICES])

#: DuckDB SQL for the operators that SQL expresses.  Mixing repeats the same draws; the two joins look at all pairs; the
#: scan finds phrases word by word, and compares k-grams themselves.
SQL: dict[str, str] = {
    "op1_warc": """WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY 1 HAVING count(*) > 1)
SELECT page_id, n AS payload_bytes, p.d AS payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
CASE WHEN first <> page_id THEN first END AS refers_to FROM p LEFT JOIN f ON p.d = f.d""",
    "op2_mixing": """WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY 1),
w AS (SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w, 1.5 * sum(source_size) OVER () AS budget, 2 * source_size AS cap FROM s),
l AS (SELECT *, row_number() OVER o AS n, (budget - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) /
  (sum(w) OVER () - coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lev FROM w WINDOW o AS (ORDER BY cap / w, source)),
t AS (SELECT source, source_size, least(2.0 * source_size, coalesce(w * (SELECT arg_min(lev, n) FROM l WHERE cap / w > lev), 'inf'::DOUBLE)) AS target FROM l),
z AS (SELECT d.source, size, count(*) AS k, any_value(target) AS target FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source WHERE size > 0 GROUP BY 1, 2),
y AS (SELECT *, log2(1.0 + size) * size * k AS w, 2 * size * k AS cap FROM z),
x AS (SELECT *, row_number() OVER o AS n, (target - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) /
  (sum(w) OVER (PARTITION BY source) - coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lev FROM y WINDOW o AS (PARTITION BY source ORDER BY cap / w, size)),
v AS (SELECT source, arg_min(lev, n) AS level FROM x WHERE cap / w > lev GROUP BY 1),
m AS (SELECT doc_id, d.source, size, source_size, target, CASE WHEN size > 0 THEN least(2.0, coalesce(level * log2(1.0 + size), 2.0)) ELSE 0.0 END AS m,
  (('0x' || substr(md5('20:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT + 0.5) / 4503599627370496 AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN v ON d.source IS NOT DISTINCT FROM v.source),
p AS (SELECT *, floor(m) AS whole, m - floor(m) AS p FROM m),
q AS (SELECT *, target - sum(whole * size) OVER (PARTITION BY source) AS lacking, CASE WHEN p > 0 THEN u / (1 - u) / (p / (1 - p)) END AS odds FROM p),
r AS (SELECT *, coalesce(sum(CASE WHEN p > 0 THEN size END) OVER (PARTITION BY source ORDER BY odds NULLS LAST, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM q)
SELECT doc_id, size, source_size, target, ((whole + CASE WHEN p > 0 AND before + size / 2 <= lacking THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM r""",
    "op4_vectors": """WITH RECURSIVE g AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
c(v, r) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT l.b, c.r FROM c JOIN l ON l.a = c.v),
m AS (SELECT v, min(r) AS component_id FROM c GROUP BY 1), n AS (SELECT a, count(*) AS k FROM l GROUP BY 1)
SELECT vec_id, coalesce(k, 0) AS n_links, component_id, vec_id = component_id AS kept FROM embeddings JOIN m ON v = vec_id LEFT JOIN n ON a = vec_id""",
    "op8_jaccard": """WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END)) AS x FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM i JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 90 * (p.n + q.n - k)),
c(v, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.b, c.r FROM c JOIN l ON l.a = c.v)
SELECT v AS doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r) AS component_id FROM c LEFT JOIN n ON n.doc_id = c.v GROUP BY v""",
    "op11_licenses": f"""WITH w AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
t AS (SELECT row_number() OVER () AS t, label, phrase, least, string_split(x, ' ') AS v, len(v) AS n, greatest(1.0::DOUBLE, floor(n / 8.0::DOUBLE)) AS drift FROM (VALUES {_NOTICES}) s(label, phrase, least, x)),
g AS (SELECT t, q, v[q + 1] || ' ' || v[q + 2] || ' ' || v[q + 3] AS g FROM (SELECT t, v, unnest(range(len(v) - 2)) AS q FROM t)),
e AS (SELECT r, p, w[p + 1] || ' ' || w[p + 2] || ' ' || w[p + 3] AS g FROM (SELECT r, w, unnest(range(len(w) - 2)) AS p FROM w)),
d AS (SELECT r, t, p - q AS d, list(DISTINCT q) AS qs, count(DISTINCT q) AS votes, min(q) AS low, max(q) AS high FROM e JOIN g USING (g) GROUP BY 1, 2, 3),
m AS (SELECT r, label, least, n, list_distinct(flatten(list(qs) OVER near)) AS qs, max((votes, -d)) OVER near = (votes, -d) AS best FROM d JOIN t USING (t) WHERE NOT phrase
  WINDOW near AS (PARTITION BY r, t ORDER BY d / drift RANGE BETWEEN 1.0 PRECEDING AND 1.0 FOLLOWING)),
s AS (SELECT r, label, least, len(list_distinct(flatten(list_transform(qs, lambda q: [q, q + 1, q + 2])))) / n::DOUBLE AS score FROM m WHERE best),
b AS (SELECT r, label, i FROM (SELECT r, w, unnest(range(len(w))) AS i FROM w) JOIN t ON phrase AND w[i + 1:i + n] = v),
a AS (SELECT r, label, i, 1.0 AS score, true AS found FROM b UNION ALL SELECT r, label, NULL, score, score >= least FROM s),
x AS (SELECT r, count(i) AS n_base, min(i) AS first_word, max(i) AS last_word, coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (i IS NOT NULL), '') AS base_labels,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (found), '') AS labels, max(score) AS score FROM a GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score FROM w LEFT JOIN x USING (r)""",
    "op12_trie": """WITH o AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS p, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
f AS (SELECT conv_id, conv_id - conv_id % 5 AS b, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295) % 9 AS h FROM (SELECT DISTINCT conv_id FROM o)),
t AS (SELECT f.conv_id, p, r, x FROM f JOIN o ON o.conv_id = b AND p < h UNION ALL SELECT conv_id, p, r, x FROM f JOIN o USING (conv_id) WHERE p >= h),
s AS (SELECT conv_id, list(sha256(strlen(r) || ':' || r || x) ORDER BY p) FILTER (p IS NOT NULL) AS s, list(strlen(x) ORDER BY p) FILTER (p IS NOT NULL) AS z FROM f LEFT JOIN t USING (conv_id) GROUP BY 1),
p AS (SELECT conv_id, d, md5(array_to_string(s[1:d], '')) AS k, CASE WHEN d > 0 THEN md5(coalesce(array_to_string(CASE WHEN d > 1 THEN s[1:d - 1] END, ''), '')) END AS pk, CASE WHEN d > 0 THEN z[d] ELSE 0 END AS z, d = n AS here
  FROM (SELECT conv_id, s, z, coalesce(len(s), 0) AS n, unnest(range(coalesce(len(s), 0) + 1)) AS d FROM s)),
q AS (SELECT conv_id, d, coalesce(k, md5('')) AS k, pk, z, here FROM p),
m AS (SELECT d, k, any_value(pk) AS pk, min(conv_id) AS c, count(*) AS n, any_value(z) AS z, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (here), '')) AS ends FROM q GROUP BY 1, 2),
k AS (SELECT d - 1 AS d, pk AS k, count(*) AS kids FROM m WHERE d > 0 GROUP BY 1, 2),
u AS (SELECT m.*, coalesce(kids, 0) AS kids FROM m LEFT JOIN k USING (d, k)),
b AS (SELECT q.d, q.k, count(*) FILTER (kids = 0) AS leaves, sum((n - 1) * u.z)::BIGINT AS saved FROM u JOIN q ON q.conv_id = u.c AND q.d <= u.d GROUP BY 1, 2)
SELECT u.c AS conv_id, u.d AS depth, a.c AS parent_conv_id, u.n AS n_convs, u.kids AS n_children, leaves AS n_leaves, saved AS saved_tokens, u.ends AS ends_sha256
FROM u JOIN b USING (d, k) LEFT JOIN m a ON a.d = u.d - 1 AND a.k = u.pk""",
    "op13_manifest": f"""WITH RECURSIVE d AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) AS j, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS i, count(*) OVER (PARTITION BY source) AS n,
  xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295) % 2 = 0 AS even FROM documents),
l AS (SELECT doc_id, j, i, n, sha256({_FIELDS}) AS h, sha256({_FIELDS.replace("strlen(text::VARCHAR) || ':' || text", "strlen(if(even, replace(text, chr(10), ''), text)) || ':' || if(even, replace(text, chr(10), ''), text)")}) AS t FROM d),
v(j, lvl, i, n, h) AS (SELECT j, 0, i, n, h FROM l UNION ALL SELECT j, lvl + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM v WHERE n > 1 GROUP BY j, lvl, i // 3, n),
s AS (SELECT j, h AS subroot FROM v WHERE n = 1),
w(lvl, i, n, h) AS (SELECT 0, j - 1, count(*) OVER (), subroot FROM s UNION ALL SELECT lvl + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM w WHERE n > 1 GROUP BY lvl, i // 3, n),
r AS (SELECT j, lvl, i // 3 AS run, list(h ORDER BY i) AS hs FROM v WHERE n > 1 GROUP BY ALL), q AS (SELECT lvl, i // 3 AS run, list(h ORDER BY i) AS hs FROM w WHERE n > 1 GROUP BY ALL),
c(j, k, lvl, i, n, f, p) AS (SELECT j, i, 0, i, n, t, '' FROM l UNION ALL SELECT c.j, k, c.lvl + 1, i // 3, (n + 2) // 3, sha256(array_to_string(list_concat(hs[:i % 3], [f], hs[i % 3 + 2:]), '')),
  p || array_to_string(list_concat(hs[:i % 3], hs[i % 3 + 2:]), '') FROM c JOIN r ON r.j = c.j AND r.lvl = c.lvl AND run = i // 3),
b(j, k, lvl, i, f, p) AS (SELECT j, k, 0, j - 1, f, p FROM c WHERE n = 1 UNION ALL SELECT b.j, k, b.lvl + 1, i // 3, sha256(array_to_string(list_concat(hs[:i % 3], [f], hs[i % 3 + 2:]), '')),
  p || array_to_string(list_concat(hs[:i % 3], hs[i % 3 + 2:]), '') FROM b JOIN q ON q.lvl = b.lvl AND run = i // 3)
SELECT doc_id, l.h AS leaf, subroot, w.h AS root, sha256(p) AS proof_sha256, f AS folded_root, f = w.h AS verified
FROM w JOIN b ON w.n = 1 AND w.lvl = b.lvl JOIN l ON l.j = b.j AND l.i = b.k JOIN s ON s.j = b.j""",
}
