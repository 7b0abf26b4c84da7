"""One query per operator over its whole table; DuckDB SQL where SQL can express the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import anchors, ann_tree, hard_negatives, interpolation, licences, mixing, pieces, prefix_trie, quality, sharding, simhash, toxicity, trie
from tidemark.llm.text import id_remainder, word_count


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_tree.neighbours(read(spark, sf_dir, "embeddings"), every=100, k=10)


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("n_words"))
    mixed = mixing.mix(docs, size=F.col("n_words"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "taken_by_shard")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return trie.members(docs, trie.deduplicate(docs, largest=True))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = id_remainder(F.col("doc_id"), 3) == 1
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, read(spark, sf_dir, "labels"), learn=~held)
    scored = quality.score(docs, model)
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = anchors.repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return interpolation.score(docs, learn=id_remainder(F.col("doc_id"), 5) != 1)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(read(spark, sf_dir, "documents").select("doc_id", "text"))
    names = F.array_sort(F.array_distinct(F.transform("findings", lambda f: f["license"])))
    differing = F.transform("findings", lambda f: F.size(f["missing"]) + F.size(f["extra"]))
    return found.select(
        "doc_id",
        "candidates",
        F.size("findings").alias("n_found"),
        F.array_join(names, ",").alias("licenses"),
        F.array_max(F.transform("findings", lambda f: f["saved"])).alias("saved"),
        F.array_min(differing).alias("differing_words"),
    )


def op8_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    done = pieces.round_trip(docs, pieces.default_model(spark))
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        F.xxhash64("ids").alias("ids_xxhash64"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        "lossless",
    )


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard(docs).drop("text")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return hard_negatives.mine(rows, every=100, k=5, least=80, most=100, scale=256)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(read(spark, sf_dir, "conversations"), group=5, most_shared=9)


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = id_remainder(F.col("doc_id"), 5) == 0
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), learn=~held)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted")


QUERIES = {
    "op1_kmeans_tree": op1_kmeans_tree,
    "op2_source_mix": op2_source_mix,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_quality": op4_quality,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_interpolation": op6_interpolation,
    "op7_license_scan": op7_license_scan,
    "op8_merge_dropout": op8_merge_dropout,
    "op9_simhash": op9_simhash,
    "op10_sharding": op10_sharding,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_toxicity": op13_toxicity,
}

ORACLE_SQL: dict[str, str] = {
    "op3_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER same
                 AND row_number() OVER (PARTITION BY coalesce(text, ''), doc_id) = 1 AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op5_substring_dedup": """
        WITH docs AS (
          SELECT row_number() OVER () AS place, doc_id,
                 regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
          FROM documents),
        windows AS (
          SELECT place, first, hash(array_to_string(words[first:first + 34], ' ')) AS h,
                 md5(array_to_string(words[first:first + 34], ' ')) AS m
          FROM (SELECT place, words, unnest(range(1, len(words) - 33)) AS first FROM docs WHERE len(words) >= 35)),
        repeated AS (SELECT place, first, count(*) OVER (PARTITION BY h, m) AS n FROM windows),
        gone AS (
          SELECT DISTINCT place, unnest(range(first, first + 35)) AS spot FROM repeated WHERE n > 1),
        lost AS (SELECT place, list(spot) AS spots, count(*) AS n FROM gone GROUP BY place)
        SELECT doc_id, len(words) AS n_words, coalesce(n, 0) AS n_removed,
               sha256(CASE WHEN n IS NULL THEN array_to_string(words, ' ') ELSE array_to_string(
                 list_transform(list_filter(list_zip(words, range(1, len(words) + 1)),
                   lambda x: NOT list_contains(spots, x[2])), lambda x: x[1]), ' ') END) AS kept_sha256
        FROM docs LEFT JOIN lost USING (place)""",
    "op11_hard_negatives": """
        WITH vectors AS (
          SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                 list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
          FROM embeddings
          WHERE label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
        scored AS (
          SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
                 list_dot_product(a.v, r.v)::BIGINT AS score
          FROM vectors a JOIN vectors r ON a.vec_id <> r.vec_id AND len(a.v) = len(r.v)
          WHERE a.vec_id % 100 = 0),
        positives AS (
          SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id,
               (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM positives JOIN scored USING (anchor_id)
        WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
        QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5""",
    "op12_prefix_trie": """
        WITH turns AS (
          SELECT conv_id, coalesce(text, '') AS text,
                 md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS name,
                 row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                   md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS place
          FROM conversations WHERE conv_id IS NOT NULL),
        convs AS (
          -- CRC-32 of the decimal id, bit by bit
          SELECT conv_id, conv_id - conv_id % 5 AS base,
                 xor(list_reduce(
                   list_prepend(4294967295, list_transform(range(1, len(conv_id::VARCHAR) + 1),
                     lambda i: ascii(substr(conv_id::VARCHAR, i::INT, 1))::BIGINT)),
                   lambda crc, octet: list_reduce(list_prepend(xor(crc, octet), range(8)),
                     lambda x, bit: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) % 9 AS shared
          FROM (SELECT DISTINCT conv_id FROM turns)),
        rebuilt AS (
          SELECT conv_id, own, place, name, text FROM (
            SELECT convs.conv_id, 0 AS own, place, name, text FROM convs JOIN turns ON turns.conv_id = base AND place < shared
            UNION ALL
            SELECT conv_id, 1, place, name, text FROM convs JOIN turns USING (conv_id) WHERE place >= shared)),
        paths AS (
          SELECT conv_id, row_number() OVER conv AS depth, strlen(text) AS size,
                 string_agg(name, '') OVER (conv ROWS UNBOUNDED PRECEDING) AS path
          FROM rebuilt WINDOW conv AS (PARTITION BY conv_id ORDER BY own, place)
          UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
        nodes AS (
          SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size
          FROM paths GROUP BY path, depth),
        children AS (SELECT left(path, 32 * (depth - 1)) AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
        subtrees AS (
          SELECT left(path, 32 * above) AS path, sum((n IS NULL)::INT) AS n_leaves, sum((n_convs - 1) * size) AS saved
          FROM (SELECT path, n, n_convs, size, unnest(range(depth + 1)) AS above FROM nodes LEFT JOIN children USING (path))
          GROUP BY 1),
        ends AS (
          SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS hash
          FROM (FROM paths QUALIFY depth = max(depth) OVER (PARTITION BY conv_id)) GROUP BY path)
        SELECT nodes.conv_id, nodes.depth::BIGINT AS depth, above.conv_id AS parent_conv_id, nodes.n_convs,
               coalesce(n, 0) AS n_children, n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens,
               coalesce(hash, sha256('')) AS ends_sha256
        FROM nodes LEFT JOIN nodes above ON nodes.depth > 0 AND above.path = left(nodes.path, 32 * (nodes.depth::INT - 1))
          LEFT JOIN children ON children.path = nodes.path
          LEFT JOIN subtrees ON subtrees.path = nodes.path LEFT JOIN ends ON ends.path = nodes.path""",
}
