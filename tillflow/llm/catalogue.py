"""The registered queries of this package: one for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm import (
    collocations, embedding_dedup, exact_dedup, language_id, license_scan, merkle_manifest, mixing, ngram_join, quality, sentencepiece_codec, sharding, token_counts,
    token_output,
)
from tillflow.llm.common import table
from tillflow.sources import scratch

# Fixed value: texts with more tokens are over the limit.
TOKEN_LIMIT = 2048

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


@query
def op1_sentencepiece(spark, sf_dir):
    model = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepiece_codec.round_trip(documents(spark, sf_dir), model).withColumnRenamed("key", "doc_id")


@query
def op2_exact_dedup(spark, sf_dir):
    rows = exact_dedup.exact_dedup(documents(spark, sf_dir))
    return rows.select(F.col("key").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


ORACLE["op2_exact_dedup"] = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""


@query
def op3_quality_classifier(spark, sf_dir):
    found = quality.classify(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return found.select(F.col("key").alias("doc_id"), "lang", "trusted", "signs", "perplexity", "limit", "kept")


@query
def op4_ngram_jaccard_join(spark, sf_dir):
    return ngram_join.jaccard_components(documents(spark, sf_dir)).withColumnRenamed("key", "doc_id")


@query
def op5_sharding(spark, sf_dir):
    rows = sharding.assign_shards(documents(spark, sf_dir))
    return rows.select(
        F.col("key").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op6_token_counts(spark, sf_dir):
    counts = token_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return counts.withColumnRenamed("key", "doc_id").withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query
def op7_mixing(spark, sf_dir):
    rows = mixing.mix(documents(spark, sf_dir)).documents
    return rows.select(F.col("key").alias("doc_id"), "size", "source_size", "target", "taken")


@query
def op8_token_output(spark, sf_dir):
    path = scratch.new_dir(spark, "token-shards")
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return token_output.write(documents(spark, sf_dir), path, vocabulary, public_tokenizers.PATTERN)


@query
def op9_language_id(spark, sf_dir):
    return language_id.identify(documents(spark, sf_dir)).withColumnRenamed("key", "doc_id")


@query
def op10_embedding_near_dedup(spark, sf_dir):
    rows = embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))
    return rows.withColumnRenamed("key", "vec_id")


ORACLE["op10_embedding_near_dedup"] = """
WITH RECURSIVE usable AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95
), reach AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT e.vec_id, coalesce(any_value(n.n), 0) AS n_links, min(r.b) AS component_id, e.vec_id = min(r.b) AS kept
FROM embeddings e JOIN reach r ON r.a = e.vec_id
LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) n ON n.a = e.vec_id
GROUP BY e.vec_id
"""


@query
def op11_merkle_manifest(spark, sf_dir):
    rows = merkle_manifest.tampered(documents(spark, sf_dir))
    return rows.drop("copies").withColumnRenamed("key", "doc_id")


ORACLE["op11_merkle_manifest"] = """
WITH RECURSIVE leaves AS (
    SELECT doc_id, coalesce('=' || lang, '') AS tree,
        sha256(concat(i, s, l, n, coalesce(strlen(text) || ':' || text, '-'))) AS leaf,
        sha256(concat(i, s, l, n, coalesce(strlen(text) || ':' || translate(text,
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-'))) AS lowered,
        list_reduce(list_transform(str_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
            lambda crc, byte: list_reduce(range(8), lambda c, k:
                CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, xor(crc, byte)), 4294967295) AS crc
    FROM (SELECT *, coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') AS i,
              coalesce(strlen(source) || ':' || source, '-') AS s, coalesce(strlen(lang) || ':' || lang, '-') AS l,
              coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS n FROM documents)
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
        coalesce(xor(crc, 4294967295) % 3 = 0, false) AS changed
    FROM leaves
), nodes AS (
    SELECT tree, 0 AS level, pos, leaf AS digest, count(*) OVER (PARTITION BY tree) AS n FROM placed
    UNION ALL
    SELECT tree, level + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), (n + 7) // 8
    FROM nodes WHERE n > 1 GROUP BY tree, level, pos // 8, n
), subroots AS (
    SELECT tree, digest, level AS height, row_number() OVER (ORDER BY tree) - 1 AS top_pos FROM nodes WHERE n = 1
), crown AS (
    SELECT 0 AS level, top_pos AS pos, digest, count(*) OVER () AS n FROM subroots
    UNION ALL
    SELECT level + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), (n + 7) // 8
    FROM crown WHERE n > 1 GROUP BY level, pos // 8, n
), everything AS (
    SELECT tree, level, pos, digest FROM nodes WHERE n > 1
    UNION ALL
    SELECT tree, height + level, pos, crown.digest FROM crown CROSS JOIN (SELECT tree, height FROM subroots) WHERE n > 1
), steps AS (
    SELECT p.tree, p.pos AS row_pos, h.level,
        CASE WHEN h.level < s.height THEN p.pos ELSE s.top_pos END
            // CAST(pow(8, h.level - CASE WHEN h.level < s.height THEN 0 ELSE s.height END) AS BIGINT) AS pos
    FROM placed p JOIN subroots s USING (tree) JOIN (SELECT DISTINCT tree, level FROM everything) h USING (tree)
), siblings AS (
    SELECT t.tree, t.row_pos, t.level, coalesce(string_agg(e.digest, '' ORDER BY e.pos) FILTER (e.pos < t.pos), '') AS before,
        coalesce(string_agg(e.digest, '' ORDER BY e.pos) FILTER (e.pos > t.pos), '') AS after
    FROM steps t JOIN everything e ON e.tree = t.tree AND e.level = t.level AND e.pos // 8 = t.pos // 8
    GROUP BY t.tree, t.row_pos, t.level
), folds AS (
    SELECT tree, pos, 0 AS level, CASE WHEN changed THEN lowered ELSE leaf END AS digest FROM placed
    UNION ALL
    SELECT f.tree, f.pos, f.level + 1, sha256(concat(s.before, f.digest, s.after))
    FROM folds f JOIN siblings s ON s.tree = f.tree AND s.row_pos = f.pos AND s.level = f.level
)
SELECT p.doc_id, p.leaf, s.digest AS subroot, r.digest AS root, coalesce(q.proof, sha256('')) AS proof_sha256,
    f.digest AS folded_root, f.digest = r.digest AS verified
FROM placed p JOIN subroots s USING (tree) CROSS JOIN (SELECT digest FROM crown WHERE n = 1) r
JOIN (SELECT tree, pos, max_by(digest, level) AS digest FROM folds GROUP BY tree, pos) f ON f.tree = p.tree AND f.pos = p.pos
LEFT JOIN (
    SELECT tree, row_pos, sha256(string_agg(before || after, '' ORDER BY level)) AS proof FROM siblings GROUP BY tree, row_pos
) q ON q.tree = p.tree AND q.row_pos = p.pos
"""


@query
def op12_collocations(spark, sf_dir):
    return collocations.collocations(documents(spark, sf_dir)).withColumnRenamed("name", "lang")


ORACLE["op12_collocations"] = """
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\x0C\r]')) AS piece
    FROM documents
), worded AS (
    SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM pieces
), totals AS (
    SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM worded GROUP BY lang
), starts AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded
), phrases AS (
    SELECT lang, w[i : i + m] AS p, count(*) AS f
    FROM starts CROSS JOIN (SELECT unnest(range(0, 5)) AS m) WHERE i + m <= len(w) GROUP BY 1, 2 HAVING count(*) >= 100
), candidates AS (
    SELECT lang, p, f AS a FROM phrases WHERE len(p) > 1
), absorbed AS (
    SELECT lang, p[s : s + m] AS p, max(a) AS longer
    FROM candidates CROSS JOIN (SELECT unnest(range(1, 5)) AS m) CROSS JOIN (SELECT unnest(range(1, 6)) AS s)
    WHERE s + m <= len(p) AND m + 1 < len(p) GROUP BY 1, 2
), cuts AS (
    SELECT c.lang, c.p, c.a, t.n, k, x.f AS l, y.f AS r,
        1000 * CAST(c.a AS HUGEINT) * t.n // (CAST(x.f AS HUGEINT) * y.f) AS score
    FROM candidates c JOIN totals t USING (lang) CROSS JOIN (SELECT unnest(range(1, 5)) AS k)
    JOIN phrases x ON x.lang = c.lang AND x.p = c.p[1 : k] JOIN phrases y ON y.lang = c.lang AND y.p = c.p[k + 1 :]
    LEFT JOIN absorbed b ON b.lang = c.lang AND b.p = c.p
    WHERE k < len(c.p) AND NOT coalesce(100 * b.longer >= 100 * c.a, false)
), best AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank,
    array_to_string(p, ' ') AS phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM best QUALIFY rank <= 2000
"""


@query
def op13_license_scan(spark, sf_dir):
    return license_scan.scan(documents(spark, sf_dir)).withColumnRenamed("key", "doc_id")
