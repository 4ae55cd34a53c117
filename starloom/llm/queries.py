"""The numbered operators over their whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import dedup, jaccard, lm, merkle, negatives, packing, pages, quality, rangecoder, segmentation, tokenfiles, toxicity, vectors
from starloom.queries.registry import Query

REGISTRY: dict[str, Query] = {}

TOXIC_ROWS = 8_000  # labelled rows that the classifiers are fitted on, at most
QUALITY_ROWS = 20_000


def llm_query(sql: str | None = None) -> Callable:
    """Register a function of the session and the folder of the tables under its own name."""

    def add(fn):
        REGISTRY[fn.__name__] = Query(fn, sql)
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % 5


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most_rows: int) -> DataFrame:
    """text and label of at most `most_rows` labelled documents, chosen by a hash of the id.

    The chosen ids are few by that bound, so they are broadcast and no text is shuffled.
    """
    chosen = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .select(F.col("doc_id").alias("chosen_id"), F.col(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("chosen_id"), "chosen_id", "label")
        .limit(most_rows)
    )
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen_id"))
    return found.select("text", "label")


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    """Learnt from labelled rows outside fold 0."""
    sample = labelled_sample(docs, labels.where(fold() != 0), "toxic", TOXIC_ROWS)
    return toxicity.fit_frame(sample, "text", "label", most_rows=TOXIC_ROWS)


def quality_rules(docs: DataFrame, labels: DataFrame) -> list[quality.Rule]:
    sample = labelled_sample(docs, labels, "quality", QUALITY_ROWS)
    return quality.fit_rules(quality.with_statistics(sample), "label", most_rows=QUALITY_ROWS)


@llm_query()
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, found by scanning the token files of the whole table."""
    return tokenfiles.token_counts(table(spark, sf_dir, "documents"))


@llm_query()
def op2_gumbel_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sampled segmentations, with their ids, of every document and of every turn; the other table's keys are null."""
    docs = segmentation.sample_segmentations(table(spark, sf_dir, "documents"), ["doc_id"], "text", k=2)
    turns = segmentation.sample_segmentations(table(spark, sf_dir, "conversations"), ["conv_id", "turn"], "text", k=2)
    return docs.unionByName(turns, allowMissingColumns=True)


@llm_query()
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract_articles(table(spark, sf_dir, "pages"), keep=["page_id", "url"])


@llm_query()
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@llm_query()
def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir}/documents.parquet"
    scored = lm.score(spark, path, "crc32(cast(cast(doc_id as string) as binary)) % 5 <> 1")
    return scored.selectExpr(
        "id as doc_id", "not train as held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


_LINKS_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS l
  FROM documents),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(l) >= 5
      THEN list_distinct(list_transform(range(1, len(l) - 3), lambda i: array_to_string(l[i:i + 4], ' ')))
      WHEN len(l) > 0 THEN [array_to_string(l, ' ')] ELSE [] END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT o.a, o.b FROM o JOIN n x ON x.doc_id = o.a JOIN n y ON y.doc_id = o.b WHERE 100 * o.o >= 80 * (x.n + y.n - o.o)),
r AS (SELECT a AS doc_id, a AS c FROM e UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id),
m AS (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(m.c, d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.doc_id = d.doc_id
"""


@llm_query(_LINKS_SQL)
def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


@llm_query()
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@llm_query()
def op8_range_coded_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rangecoder.round_trip(table(spark, sf_dir, "documents"))


@llm_query("""
SELECT doc_id, max(doc_id) OVER p AS keep_id, count(*) OVER p AS group_size,
       doc_id = max(doc_id) OVER p AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW p AS (PARTITION BY coalesce(text, ''))
""")
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = dedup.mark_copies(spark, f"{sf_dir}/documents.parquet", columns=["doc_id"])
    return marked.select(
        "doc_id",
        F.col("dup_keep_id").alias("keep_id"),
        F.col("dup_group_size").alias("group_size"),
        F.col("dup_kept").alias("kept"),
        F.lower(F.hex("dup_digest")).alias("text_sha256"),
    )


@llm_query()
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rules = quality_rules(docs, table(spark, sf_dir, "labels"))
    counted = quality.with_statistics(docs.select("doc_id", "text")).drop("text")
    return quality.with_verdict(counted, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


_VECTORS_SQL = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS x,
    embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
      AND len(list_filter(embedding, lambda c: c <> 0)) > 0 AS usable
  FROM embeddings),
w AS (SELECT r, vec_id, x, sqrt(list_inner_product(x, x)) AS n FROM v WHERE usable),
e AS (
  SELECT a.r AS a, b.r AS b, b.vec_id AS id FROM w a JOIN w b
  ON len(a.x) = len(b.x) AND a.r <> b.r AND list_inner_product(a.x, b.x) / (a.n * b.n) >= 0.95),
c AS (SELECT r AS a, vec_id AS id FROM w UNION SELECT e.a, c.id FROM c JOIN e ON e.b = c.a),
m AS (SELECT a, min(id) AS id FROM c GROUP BY a),
n AS (SELECT a, count(*) AS n FROM e GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, CASE WHEN usable THEN m.id ELSE v.vec_id END AS component_id,
  v.vec_id IS NOT DISTINCT FROM CASE WHEN usable THEN m.id ELSE v.vec_id END AS kept
FROM v LEFT JOIN m ON m.a = v.r LEFT JOIN n ON n.a = v.r
"""


@llm_query(_VECTORS_SQL)
def op11_subspace_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of cosine 0.95 or more between all vectors, and their components."""
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"), least=0.95)


_NEGATIVES_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.r <> b.r AND len(a.q) = len(b.q)),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, id, b) <= 5)
SELECT p.anchor_id, p.id AS positive_id, (row_number() OVER w)::INT AS rank, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.a = p.a AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
WINDOW w AS (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.id, n.b)
QUALIFY row_number() OVER w <= 10
"""


@llm_query(_NEGATIVES_SQL)
def op12_threshold_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, against all rows; every seventh has the next label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), "id % 100 = 0", label)


_MANIFEST_SQL = r"""
WITH RECURSIVE bits AS (
  SELECT i AS byte, i AS v, 0 AS k FROM range(256) t(i)
  UNION ALL SELECT byte, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(v ORDER BY byte) AS tab FROM bits WHERE k = 8),
d AS (
  SELECT *, row_number() OVER () AS r,
    doc_id IS NOT NULL AND xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295) % 5 = 0 AS hit
  FROM documents, crc),
f AS (
  SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
    CASE WHEN hit THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS found
  FROM d),
l AS (
  SELECT r, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(found) || ':' || found, '-')) AS checked
  FROM f),
leaves AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i
  FROM l),
t AS (
  SELECT 0 AS lvl, g, i, leaf AS h FROM leaves
  UNION ALL
  SELECT max(lvl) + 1, g, i // 16, sha256(string_agg(h, '' ORDER BY i))
  FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM t) WHERE n > 1 GROUP BY g, i // 16),
sub AS (SELECT g, max(lvl) AS height, arg_max(h, lvl) AS subroot FROM t GROUP BY g),
u AS (
  SELECT 0 AS lvl, g AS i, subroot AS h FROM sub
  UNION ALL
  SELECT max(lvl) + 1, i // 16, sha256(string_agg(h, '' ORDER BY i))
  FROM (SELECT *, count(*) OVER () AS n FROM u) WHERE n > 1 GROUP BY i // 16),
top AS (SELECT max(lvl) AS height, arg_max(h, lvl) AS root FROM u),
st AS (
  SELECT t.lvl, t.g, t.i, coalesce(string_agg(o.h, '' ORDER BY o.i) FILTER (o.i < t.i), '') AS before,
    coalesce(string_agg(o.h, '' ORDER BY o.i) FILTER (o.i > t.i), '') AS after
  FROM t JOIN sub ON sub.g = t.g AND t.lvl < sub.height JOIN t o ON o.lvl = t.lvl AND o.g = t.g AND o.i // 16 = t.i // 16 GROUP BY ALL),
su AS (
  SELECT u.lvl, u.i, coalesce(string_agg(o.h, '' ORDER BY o.i) FILTER (o.i < u.i), '') AS before,
    coalesce(string_agg(o.h, '' ORDER BY o.i) FILTER (o.i > u.i), '') AS after
  FROM u JOIN top ON u.lvl < top.height JOIN u o ON o.lvl = u.lvl AND o.i // 16 = u.i // 16 GROUP BY ALL),
p AS (
  SELECT r, g, i, 0 AS lvl, '' AS proof, checked AS acc FROM leaves
  UNION ALL
  SELECT p.r, p.g, p.i // 16, p.lvl + 1, proof || before || after, sha256(before || acc || after)
  FROM p JOIN st ON st.lvl = p.lvl AND st.g = p.g AND st.i = p.i),
pe AS (SELECT r, g, arg_max(proof, lvl) AS proof, arg_max(acc, lvl) AS acc FROM p GROUP BY r, g),
q AS (
  SELECT r, g AS i, 0 AS lvl, proof, acc FROM pe
  UNION ALL
  SELECT q.r, q.i // 16, q.lvl + 1, proof || before || after, sha256(before || acc || after)
  FROM q JOIN su ON su.lvl = q.lvl AND su.i = q.i),
qe AS (SELECT r, arg_max(proof, lvl) AS proof, arg_max(acc, lvl) AS acc FROM q GROUP BY r)
SELECT leaves.doc_id, leaves.leaf, sub.subroot, top.root, sha256(qe.proof) AS proof_sha256, qe.acc AS folded_root,
  qe.acc = top.root AS verified
FROM leaves JOIN qe ON qe.r = leaves.r JOIN sub ON sub.g = leaves.g, top
"""


@llm_query(_MANIFEST_SQL)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its proof, folded to the root from the row as it is found later."""
    return merkle.verified_manifest(spark, table(spark, sf_dir, "documents"))
