"""One query for each operator of this subpackage on the given tables, with the SQL it should agree with where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm import backoff, bands, gridjoin, language, merkle, minhash, mixing, negatives, packing, pages, preferences, resample, tokenbits
from stratiform.llm.store import stored


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_importance_resampling(spark: SparkSession, sf: str) -> DataFrame:
    return resample.resample_decisions(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def op2_grid_order_join(spark: SparkSession, sf: str) -> DataFrame:
    return gridjoin.near_vectors(_table(spark, sf, "embeddings"))


def op3_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf, "documents"))


def _span_text(mask: str) -> Column:
    return F.array_join(F.transform(mask, lambda m: F.concat_ws(":", m["start"].cast("string"), m["end"].cast("string"))), ",").alias(mask)


def op4_preference_formatting(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations 2k and 2k+1 as the chosen and the rejected one of pair k; masks as text."""
    table = _table(spark, sf, "conversations")
    side = F.when(F.pmod("conv_id", F.lit(2)) == 0, "chosen").otherwise("rejected")
    turns = table.select(F.shiftright("conv_id", 1).alias("pair_id"), side.alias("side"), "turn", "role", "text")
    made = preferences.format_preferences(turns)
    return made.select("pair_id", F.col("n_shared").cast("long").alias("n_shared"), "prompt", "chosen", "rejected", _span_text("chosen_mask"), _span_text("rejected_mask"))


def op5_minhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf, "documents"), minhash.MinHashRules(shingle=4))


def op6_source_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_page_differencing(spark: SparkSession, sf: str) -> DataFrame:
    return pages.extract_main_text(_table(spark, sf, "pages"))


def op8_backoff_automaton(spark: SparkSession, sf: str) -> DataFrame:
    return backoff.score_texts(_table(spark, sf, "documents"))


def op9_compression_bands(spark: SparkSession, sf: str) -> DataFrame:
    """Limits are learned from all documents that are labelled good; every text is read and compressed once."""
    measured = stored(bands.measure_texts(_table(spark, sf, "documents"), keep=["doc_id"]))
    return bands.judge(measured, bands.fit_measured(measured, _table(spark, sf, "labels")))


def op10_compression_language(spark: SparkSession, sf: str) -> DataFrame:
    return language.predict_languages(_table(spark, sf, "documents"))


def op11_fixed_width_ids(spark: SparkSession, sf: str) -> DataFrame:
    return tokenbits.token_index(_table(spark, sf, "documents")).select("doc_id", "start", "n_tokens", "ids_crc32")


def op12_strassen_negatives(spark: SparkSession, sf: str) -> DataFrame:
    """Components in 256ths, rounded down; every 50th row is an anchor and every 7th bears the next label."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    label = F.col("label").cast("long")
    rows = _table(spark, sf, "embeddings").where(F.col("embedding").isNotNull() & finite).select(
        "vec_id",
        F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        F.transform(x, lambda v: F.floor(v * 256)).alias("vector"),
        (F.col("vec_id") % 50 == 0).alias("anchor"),
    )
    return negatives.mine_negatives(rows)


def op13_bitmap_rank_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Where 2 divides the crc32 of a document's id, the line ends of its text are gone when the proof is checked."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    bare = F.when(hit, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    made = merkle.manifest(_table(spark, sf, "documents"), changed={"text": bare})
    made = merkle.fold_proofs(made, F.coalesce("changed_leaf", "leaf"))
    text = lambda c: F.lower(F.hex(c))
    shown = [text(c).alias(c) for c in ("leaf", "subroot", "root")]
    proof = F.sha2(text("proof").cast("binary"), 256).alias("proof_sha256")
    verified = F.col("folded_root") == F.col("root")
    return made.select("doc_id", *shown, proof, text("folded_root").alias("folded_root"), verified.alias("verified"))


def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_importance_resampling,
        op2_grid_order_join,
        op3_best_fit_packing,
        op4_preference_formatting,
        op5_minhash_near_dedup,
        op6_source_mixing,
        op7_page_differencing,
        op8_backoff_automaton,
        op9_compression_bands,
        op10_compression_language,
        op11_fixed_width_ids,
        op12_strassen_negatives,
        op13_bitmap_rank_manifest,
        pipeline,
    )
}

# Turns are numbered as they sort; the first number at which the two sides differ, or one has ended, ends the prompt.
_PREFERENCES = """
WITH t AS (
  SELECT conv_id // 2 AS pair_id, conv_id % 2 AS side, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
p AS (SELECT pair_id FROM t GROUP BY pair_id HAVING count(DISTINCT side) = 2),
d AS (
  SELECT coalesce(a.pair_id, b.pair_id) AS pair_id,
         min(CASE WHEN a.role = b.role AND a.text = b.text THEN NULL ELSE coalesce(a.k, b.k) END) AS differ,
         max(coalesce(a.k, b.k)) AS most
  FROM (SELECT * FROM t WHERE side = 0) a FULL JOIN (SELECT * FROM t WHERE side = 1) b ON a.pair_id = b.pair_id AND a.k = b.k
  GROUP BY 1),
n AS (SELECT pair_id, coalesce(differ - 1, most) AS n_shared FROM d SEMI JOIN p USING (pair_id)),
r AS (
  SELECT pair_id, side, k, n_shared, role, '<|' || role || '|>' || chr(10) AS head, text || chr(10) AS body
  FROM t JOIN n USING (pair_id)),
o AS (
  SELECT *, coalesce(sum(CASE WHEN k > n_shared THEN length(head) + length(body) ELSE 0 END)
    OVER (PARTITION BY pair_id, side ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos
  FROM r)
SELECT pair_id, any_value(n_shared) AS n_shared,
  coalesce(string_agg(head || body, '' ORDER BY k) FILTER (WHERE side = 0 AND k <= n_shared), '') AS prompt,
  coalesce(string_agg(head || body, '' ORDER BY k) FILTER (WHERE side = 0 AND k > n_shared), '') AS chosen,
  coalesce(string_agg(head || body, '' ORDER BY k) FILTER (WHERE side = 1 AND k > n_shared), '') AS rejected,
  coalesce(string_agg((pos + length(head)) || ':' || (pos + length(head) + length(body)), ',' ORDER BY k)
    FILTER (WHERE side = 0 AND k > n_shared AND role = 'assistant'), '') AS chosen_mask,
  coalesce(string_agg((pos + length(head)) || ':' || (pos + length(head) + length(body)), ',' ORDER BY k)
    FILTER (WHERE side = 1 AND k > n_shared AND role = 'assistant'), '') AS rejected_mask
FROM o GROUP BY pair_id
"""

_NEGATIVES = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same,
         list_sum(list_transform(range(1, len(a.v) + 1), lambda k: a.v[k] * c.v[k]))::BIGINT AS score
  FROM r a JOIN r c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

_COMPONENTS = """
c AS (
  SELECT a AS node, min(b) AS component_id FROM (
    WITH RECURSIVE reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a) SELECT * FROM reach) GROUP BY a)
"""

_NEAR_VECTORS = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
u AS (SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_sum(list_transform(range(1, len(a.e) + 1), lambda k: a.e[k] * b.e[k])) / a.norm / b.norm >= 0.95),
{_COMPONENTS}
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, least(vec_id, coalesce(component_id, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(component_id, vec_id)) AS kept
FROM embeddings LEFT JOIN c ON node = vec_id
"""

_NEAR_TEXTS = f"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN []
    WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 2), lambda k: array_to_string(words[k:k + 3], ' '))) END AS shingles
  FROM w),
x AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
{_COMPONENTS}
SELECT doc_id, len(shingles)::BIGINT AS n_shingles, least(doc_id, coalesce(component_id, doc_id)) AS component_id,
       doc_id = least(doc_id, coalesce(component_id, doc_id)) AS kept
FROM s LEFT JOIN c ON node = doc_id
"""

# crc32 is computed bit by bit; levels of the source trees are 0, 1, ..., those of the tree of sources 1000, 1001, ...
_MANIFEST = """
WITH RECURSIVE
f AS (
  SELECT doc_id, source, lang, n_chars, text,
    list_reduce(list_transform(range(1, len(doc_id::VARCHAR) + 1), lambda k: ascii((doc_id::VARCHAR)[k])::BIGINT),
      lambda c, b: list_reduce(range(8)::BIGINT[], lambda d, k: xor(d >> 1, 3988292384 * (d & 1)), xor(c, b)), 4294967295::BIGINT) AS crc
  FROM documents),
e AS (
  SELECT *, CASE WHEN (4294967295 - crc) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS bare,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head
  FROM f),
l AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, leaf, other,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank, count(*) OVER (PARTITION BY source) AS size
  FROM (SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
               sha256(head || coalesce(strlen(bare) || ':' || bare, '-')) AS other FROM e)),
t AS (
  SELECT tree, 0 AS level, rank, leaf AS h, size FROM l
  UNION ALL
  SELECT tree, level + 1, rank // 3, sha256(string_agg(h, '' ORDER BY rank)), (any_value(size) + 2) // 3
  FROM t WHERE size > 1 GROUP BY tree, level, rank // 3),
s AS (SELECT tree AS rank, h, count(*) OVER () AS size FROM t WHERE size = 1),
u AS (
  SELECT 1000 AS level, rank, h, size FROM s
  UNION ALL
  SELECT level + 1, rank // 3, sha256(string_agg(h, '' ORDER BY rank)), (any_value(size) + 2) // 3
  FROM u WHERE size > 1 GROUP BY level, rank // 3),
runs AS (
  SELECT tree, level, rank // 3 AS up, list(h ORDER BY rank) AS hs FROM t WHERE size > 1 GROUP BY ALL
  UNION ALL SELECT -1, level, rank // 3, list(h ORDER BY rank) FROM u WHERE size > 1 GROUP BY ALL),
steps AS (
  SELECT l.tree, l.rank AS leaf_rank, r.level, r.hs, (l.rank // pow(3, r.level)::BIGINT) % 3 AS pos
  FROM l JOIN runs r ON r.tree = l.tree AND r.up = l.rank // pow(3, r.level + 1)::BIGINT
  UNION ALL
  SELECT l.tree, l.rank, r.level, r.hs, (l.tree // pow(3, r.level - 1000)::BIGINT) % 3
  FROM l JOIN runs r ON r.tree = -1 AND r.up = l.tree // pow(3, r.level - 999)::BIGINT),
w AS (
  SELECT tree, leaf_rank, list({'pre': array_to_string(hs[1:pos], ''), 'post': array_to_string(hs[pos + 2:len(hs)], '')} ORDER BY level) AS way
  FROM steps GROUP BY ALL),
v AS (
  SELECT l.*, s.h AS subroot, (SELECT h FROM u WHERE size = 1) AS root, coalesce(way, []) AS way
  FROM l JOIN s ON s.rank = l.tree LEFT JOIN w ON w.tree = l.tree AND w.leaf_rank = l.rank),
x AS (
  SELECT *, list_reduce(list_prepend({'pre': other, 'post': ''}, way), lambda h, x: {'pre': sha256(x.pre || h.pre || x.post), 'post': ''}).pre AS folded_root
  FROM v)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(way, lambda x: x.pre || x.post), '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM x
"""

ORACLES: dict[str, str] = {
    "op2_grid_order_join": _NEAR_VECTORS,
    "op4_preference_formatting": _PREFERENCES,
    "op5_minhash_near_dedup": _NEAR_TEXTS,
    "op12_strassen_negatives": _NEGATIVES,
    "op13_bitmap_rank_manifest": _MANIFEST,
}
