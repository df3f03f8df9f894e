"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvia.llm.common import new_path
from pluvia.llm.decontamination import contaminated_documents
from pluvia.llm.embedding_dedup import near_duplicate_vectors
from pluvia.llm.html_text import extract_text
from pluvia.llm.metric_tree import largest_products
from pluvia.llm.mixing import mix_sources
from pluvia.llm.phrases import collocations
from pluvia.llm.prefix_trie import conversation_trie
from pluvia.llm.quality import quality_scores
from pluvia.llm.simhash import near_duplicate_groups
from pluvia.llm.sstable import read_token_table, write_token_table
from pluvia.llm.substring_dedup import remove_repeats
from pluvia.llm.token_counts import fill_cache, token_counts
from pluvia.llm.toxicity import fit_toxicity, score_toxicity

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_groups(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def op7_token_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_token_table(write_token_table(table(spark, sf_dir, "documents"), TOKENIZER, end_id=2))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_scores(docs, labels, host=F.col("source"), path=F.concat_ws("/", "source", "lang"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score_toxicity(docs, fit_toxicity(docs, labels))
    return scored.withColumn("n_offending", F.size("offending")).drop("offending")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first call fills a new cache, so the second, whose rows these are, encodes nothing."""
    docs, cache = table(spark, sf_dir, "documents"), new_path(spark, "token-cache")
    fill_cache(docs, TOKENIZER, cache)
    return token_counts(docs, TOKENIZER, cache)


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op12_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return largest_products(table(spark, sf_dir, "embeddings"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_simhash": op3_simhash,
    "op4_decontamination": op4_decontamination,
    "op5_html_text": op5_html_text,
    "op6_mixing": op6_mixing,
    "op7_token_table": op7_token_table,
    "op8_quality": op8_quality,
    "op9_toxicity": op9_toxicity,
    "op10_token_counts": op10_token_counts,
    "op11_phrases": op11_phrases,
    "op12_top_products": op12_top_products,
    "op13_prefix_trie": op13_prefix_trie,
}

#: The mix by plain sorting: same hash, same nearest cut.
OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5(concat(coalesce(CAST(doc_id AS VARCHAR), ''), '|', md5(coalesce(text, '')))) AS h FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [3.0, 1.0, 2.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight FROM d GROUP BY source
), o AS (
  SELECT *, row_number() OVER (ORDER BY 2.0 * source_size / weight, source) AS k,
    coalesce(sum(2.0::DOUBLE * source_size) OVER (ORDER BY 2.0 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS spent,
    sum(weight) OVER (ORDER BY 2.0 * source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight,
    1.5::DOUBLE * sum(source_size) OVER () AS budget FROM s
), l AS (
  SELECT budget - spent AS left_over, open_weight FROM o
  WHERE weight * (budget - spent) / open_weight <= 2.0 * source_size ORDER BY k LIMIT 1
), t AS (
  SELECT source, source_size, CASE WHEN (weight * left_over) / open_weight_l > 2.0 * source_size THEN 2.0::DOUBLE * source_size ELSE (weight * left_over) / open_weight_l END AS target
  FROM s CROSS JOIN (SELECT left_over, open_weight AS open_weight_l FROM l)
), p AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t
), g AS (
  SELECT source, h, sum(size) AS n, sum(sum(size)) OVER (PARTITION BY source ORDER BY h) AS upto FROM d GROUP BY source, h
), c AS (
  SELECT g.source, h, CASE WHEN upto <= target - whole * source_size THEN 1
    WHEN upto - n <= target - whole * source_size AND upto - (target - whole * source_size) < target - whole * source_size - (upto - n) THEN 1 ELSE 0 END AS more
  FROM g JOIN p ON g.source IS NOT DISTINCT FROM p.source
)
SELECT d.doc_id, d.size, p.source_size, p.target, CAST(d.size * (whole + more) AS BIGINT) AS taken, CAST(whole + more AS INTEGER) AS copies
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source JOIN c ON d.source IS NOT DISTINCT FROM c.source AND d.h = c.h
"""

#: All pairs of vectors with a label in common.
OP1_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), r AS (SELECT vec_id AS a, vec_id AS top FROM v UNION SELECT l.b, r.top FROM r JOIN l ON r.a = l.a),
c AS (SELECT a AS vec_id, min(top) AS component_id FROM r GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY a)
SELECT v.vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, v.vec_id = component_id AS kept
FROM v LEFT JOIN n ON v.vec_id = n.vec_id JOIN c ON v.vec_id = c.vec_id
"""

#: Every window of 50 words, written out.
OP2_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
u AS (SELECT doc_id, len(w) AS n, unnest(range(1, len(w) + 1)) AS pos, unnest(w) AS word FROM d),
h AS (
  SELECT doc_id, pos, n, md5(string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)) AS k FROM u
), m AS (SELECT doc_id, pos, min(doc_id) OVER (PARTITION BY k) AS f FROM h WHERE pos + 49 <= n),
c AS (SELECT DISTINCT doc_id, pos + o AS pos FROM (SELECT doc_id, pos FROM m WHERE f < doc_id) CROSS JOIN (SELECT unnest(range(50)) AS o)),
g AS (
  SELECT u.doc_id, count(c.pos) AS n_removed, string_agg(word, ' ' ORDER BY u.pos) FILTER (c.pos IS NULL) AS kept
  FROM u LEFT JOIN c ON u.doc_id = c.doc_id AND u.pos = c.pos GROUP BY u.doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN g ON d.doc_id = g.doc_id
"""

#: All phrases of one to three words listed; the score in whole numbers of 128 bits.
OP11_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (
  SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3 FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w)
), f1 AS (SELECT lang, w1, count(*) AS f FROM g GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, count(*) AS f FROM g WHERE w2 IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM g WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
sizes AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY lang),
longer AS (
  SELECT lang, w1, w2, max(f) AS f FROM (SELECT lang, w1, w2, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3) GROUP BY ALL
), two AS (
  SELECT c.lang, c.w1 || ' ' || c.w2 AS phrase, c.f AS a, 1 AS k, x.f AS l, y.f AS r FROM f2 c
  JOIN f1 x ON c.lang = x.lang AND c.w1 = x.w1 JOIN f1 y ON c.lang = y.lang AND c.w2 = y.w1
  LEFT JOIN longer b ON c.lang = b.lang AND c.w1 = b.w1 AND c.w2 = b.w2 WHERE c.f >= 10 AND (b.f IS NULL OR 100 * b.f < 50 * c.f)
), three AS (
  SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3 AS phrase, c.f AS a, 1 AS k, x.f AS l, y.f AS r FROM f3 c
  JOIN f1 x ON c.lang = x.lang AND c.w1 = x.w1 JOIN f2 y ON c.lang = y.lang AND c.w2 = y.w1 AND c.w3 = y.w2
  UNION ALL
  SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.f, 2, x.f, y.f FROM f3 c
  JOIN f2 x ON c.lang = x.lang AND c.w1 = x.w1 AND c.w2 = x.w2 JOIN f1 y ON c.lang = y.lang AND c.w3 = y.w1
), scored AS (
  SELECT *, CAST((1000000::HUGEINT * a::HUGEINT * a::HUGEINT) // (l::HUGEINT * r::HUGEINT) AS BIGINT) AS score FROM (SELECT * FROM two UNION ALL SELECT * FROM three)
), cut AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM cut)
SELECT c.lang, rank, phrase, a, l, r, n, score FROM ranked c JOIN sizes s ON c.lang = s.lang WHERE rank <= 2000
"""

#: The products of each query with all rows.
OP12_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM p QUALIFY rank <= 10
"""

#: Rebuilt conversations as lists; the CRC bit by bit, eight steps for each digit.
OP13_SQL = r"""
WITH t AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 'x': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), c AS (
  SELECT conv_id, turns, xor(4294967295::BIGINT, list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda d: [ascii(d)::BIGINT, 0, 0, 0, 0, 0, 0, 0])),
    lambda a, x: xor(xor(a, x) >> 1, 3988292384::BIGINT * (xor(a, x) & 1)))) % 4 AS h FROM t
), r AS (
  SELECT c.conv_id, coalesce(b.turns[1:c.h], []) || c.turns[c.h + 1:] AS s FROM c LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % 20
), m AS (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM r),
w AS (SELECT conv_id, s, d, md5(CAST(s[1:d] AS VARCHAR)) AS k, CASE WHEN d > 0 THEN md5(CAST(s[1:d - 1] AS VARCHAR)) END AS up, CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(s[d].x, '[^\x20\x09-\x0D]+')) END AS words FROM m),
n AS (
  SELECT d, k, up, min(conv_id) AS rep, count(*) AS n_convs, (count(*) - 1) * max(words) AS v,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(s) = d), '') AS ends FROM w GROUP BY d, k, up
), kids AS (SELECT d - 1 AS d, up AS k, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
a AS (SELECT DISTINCT n.d AS d, n.k AS k, md5(CAST(m.s[1:e.d] AS VARCHAR)) AS over, e.d AS over_d FROM n JOIN m ON n.d = m.d AND n.k = md5(CAST(m.s[1:m.d] AS VARCHAR)) JOIN m e ON e.conv_id = m.conv_id AND e.d <= m.d),
below AS (
  SELECT a.over_d AS d, a.over AS k, sum(n.v) AS saved, count(*) FILTER (kids.n_children IS NULL) AS n_leaves
  FROM a JOIN n ON a.d = n.d AND a.k = n.k LEFT JOIN kids ON n.d = kids.d AND n.k = kids.k GROUP BY ALL
)
SELECT n.rep AS conv_id, n.d AS depth, p.rep AS parent_conv_id, n.n_convs, coalesce(kids.n_children, 0)::BIGINT AS n_children, n_leaves, saved::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM n LEFT JOIN kids ON n.d = kids.d AND n.k = kids.k JOIN below ON n.d = below.d AND n.k = below.k LEFT JOIN n p ON n.d > 0 AND p.d = n.d - 1 AND p.k = n.up
"""

ORACLES: dict[str, str] = {"op11_phrases": OP11_SQL, "op13_prefix_trie": OP13_SQL, "op12_top_products": OP12_SQL, "op1_embedding_dedup": OP1_SQL, "op2_substring_dedup": OP2_SQL, "op6_mixing": OP6_SQL}
