"""The registered queries of the subpackage, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm import audit, classifier, embedding_dedup, html, langid, line_dedup, lm, mixing, near_dup, packing, resampling, secrets, topk
from feedlake.llm.common import id_remainder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long lines of all documents stay only in the smallest doc_id that holds them."""
    out = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLES["op1_line_dedup"] = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
    FROM documents
), keyed AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), owners AS (
    SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10 GROUP BY key
), judged AS (
    SELECT k.doc_id, k.pos, k.line, o.owner IS NULL OR o.owner = k.doc_id AS stays
    FROM keyed k LEFT JOIN owners o ON k.key = o.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (stays), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@_query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    pieces = packing.cut(_table(spark, sf_dir, "documents"))
    out = packing.pack(pieces)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@_query
def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best partners of every vector whose id is divisible by 20."""
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


ORACLES["op3_exact_topk"] = """
WITH valid AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS cells FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.cells, v.cells)::BIGINT AS score
    FROM valid q JOIN valid v ON q.vec_id <> v.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@_query
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raked weight, probability and draw of every document."""
    out = mixing.mix_sources(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "source", "lang", "topic", "n_tokens", "weight", "probability", "selected")


@_query
def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    out = html.extract(_table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", "n_chars")


@_query
def op6_embedding_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of cosine 0.95 or more among all vectors, and their components."""
    out = embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"), threshold=0.95)
    return out.select("vec_id", "n_links", "component_id", "kept")


@_query
def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attention and unigram scores of every document; a seventh is held out."""
    held_out = id_remainder("doc_id", 7) == 2
    out = lm.score_texts(_table(spark, sf_dir, "documents"), train=~held_out)
    return out.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@_query
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the rows that are not held out."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = id_remainder("doc_id", 5) == 0
    model = classifier.fit(docs, labels, "quality", use=~held_out)
    out = classifier.classify(docs, model, threshold=0.3)
    return out.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@_query
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents by format and by entropy."""
    return secrets.digest(secrets.scan_secrets(_table(spark, sf_dir, "documents")))


@_query
def op10_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents."""
    out = near_dup.near_duplicates(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "class_id", "kept")


@_query
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes from each language, in all 120 orders."""
    return audit.audit_filters(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


ORACLES["op11_filter_audit"] = r"""
WITH d AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
), w AS (
    SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first_id FROM d
), f AS (
    SELECT doc_id, part,
           CASE WHEN len(words) < 100 THEN 1 ELSE 0 END AS a,
           CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 1 ELSE 0 END AS b,
           CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 1 ELSE 0 END AS c,
           CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 1 ELSE 0 END AS d,
           CASE WHEN first_id < doc_id THEN 1 ELSE 0 END AS e
    FROM w
), l AS (
    SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id
), cells AS (
    SELECT part, MAP {'A': a, 'B': b, 'C': c, 'D': d, 'E': e} AS fails,
           coalesce(quality = 1, FALSE) AS good, coalesce(toxic = 1, FALSE) AS toxic, count(*) AS n
    FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
    SELECT p.x || q.x || r.x || s.x || t.x AS filter_order
    FROM letters p, letters q, letters r, letters s, letters t
    WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5
), steps AS (
    SELECT filter_order, i::INTEGER AS step, filter_order[i:i] AS letter, filter_order[:i - 1] AS earlier,
           string_split(filter_order[:i - 1], '') AS before
    FROM orders, range(1, 6) g(i)
), hit AS (
    SELECT s.filter_order, s.step, s.letter, c.part, c.n, c.good, c.toxic,
           c.fails[s.letter] = 1 AS fails,
           len(list_filter(before, lambda x: x <> '' AND c.fails[x] = 1)) > 0 AS gone,
           list_sum(map_values(c.fails)) AS failures
    FROM steps s, cells c
), summed AS (
    SELECT part, filter_order, step, letter,
           sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END)::BIGINT AS kept,
           sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END)::BIGINT AS removed,
           sum(CASE WHEN gone AND fails THEN n ELSE 0 END)::BIGINT AS redundant,
           sum(CASE WHEN fails AND failures = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
           sum(CASE WHEN NOT gone AND fails AND good THEN n ELSE 0 END)::BIGINT AS good_lost,
           sum(CASE WHEN NOT gone AND fails AND toxic THEN n ELSE 0 END)::BIGINT AS toxic_lost
    FROM hit GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM summed
"""


@_query
def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out."""
    docs, held_out = _table(spark, sf_dir, "documents"), id_remainder("doc_id", 5) == 0
    model = langid.fit(docs, use=~held_out)
    out = langid.identify(docs, model)
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@_query
def op13_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents, drawn by their likeness to the benchmark texts."""
    docs, target = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    weighed = resampling.weigh(docs.select("doc_id", "text"), target, buckets=10_000, longest=1, seed=2024)
    out = resampling.draw(weighed.drop("text"), percent=10, least_words=20)
    return out.select("doc_id", "n_features", "weight", "score", "rank")


# crc32 by its table, for each distinct word
ORACLES["op13_target_resampling"] = r"""
WITH crcs AS MATERIALIZED (
    SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i:
        CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS crc
), texts AS (
    SELECT TRUE AS wanted, item_id AS id, text FROM benchmark
    UNION ALL SELECT FALSE, doc_id, text FROM documents
), words AS MATERIALIZED (
    SELECT wanted, id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
    FROM texts
), hexes AS (
    SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM words)
), bucketed AS MATERIALIZED (
    SELECT word, xor(list_reduce(list_transform(range(len(h) // 2),
               lambda i: ('0x' || h[2 * i + 1 : 2 * i + 2])::BIGINT),
               lambda c, b: xor(crc[(xor(c, b) & 255) + 1], c >> 8), 4294967295::BIGINT), 4294967295) % 10000 AS bucket
    FROM hexes, crcs
), counts AS (
    SELECT bucket, count(*) FILTER (wanted) AS t, count(*) FILTER (NOT wanted) AS s
    FROM words JOIN bucketed USING (word) GROUP BY bucket
), totals AS (
    SELECT sum(t)::DOUBLE AS t_all, sum(s)::DOUBLE AS s_all FROM counts
), gains AS (
    SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (s_all + 10000)) / ((s + 1)::DOUBLE * (t_all + 10000))))::BIGINT AS gain
    FROM counts, totals
), weights AS (
    SELECT id, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
    FROM words JOIN bucketed USING (word) JOIN gains USING (bucket) WHERE NOT wanted GROUP BY id
), scored AS (
    SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || doc_id)[:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
    FROM documents LEFT JOIN weights ON id = doc_id
), ranked AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS total
    FROM scored WHERE n_features >= 20
)
SELECT s.doc_id, n_features, weight, score, CASE WHEN place <= total * 10 // 100 THEN place END AS rank
FROM scored s LEFT JOIN ranked r USING (doc_id)
"""
