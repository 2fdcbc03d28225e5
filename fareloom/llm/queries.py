"""The registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.llm import archives, bpe, centroids, chunks, exact, lines, nearest, packing, repetition, simhash, suffixes, toxicity, variants
from fareloom.llm.frames import table
from fareloom.llm.tables import PLACE, Scratch

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 1


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded again, with digests of both."""
    ids = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), VOCABULARY).select("doc_id", "ids")
    return bpe.decode(ids, VOCABULARY).select(
        "doc_id",
        bpe.n_tokens().alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    found = repetition.with_quality(table(spark, sf_dir, "documents").select("doc_id", "text"))
    fields = [name for name in repetition.QUALITY.names if not name.startswith("repeat_")]
    return found.select("doc_id", *[f"quality.{name}" for name in fields])


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of a document that occurs before, and the documents that hold it."""
    return suffixes.repeated_passages(table(spark, sf_dir, "documents")).drop(*PLACE)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines of windows that occur before."""
    return lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one of its group that stays."""
    return exact.exact_duplicates(table(spark, sf_dir, "documents")).drop(*PLACE)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and the component it belongs to."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stretch of a document that occurs before, and the documents that hold it."""
    return chunks.repeated_spans(table(spark, sf_dir, "documents")).drop(*PLACE)


def packed_pieces(docs: DataFrame) -> DataFrame:
    """Documents encoded and packed, with a checksum of each piece's ids in place of the ids."""
    pieces = packing.pack(bpe.encode(docs.select("doc_id", "text"), VOCABULARY), END_ID)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
        "sequence_tokens", "step_group",
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and the sequences they lie in."""
    return packed_pieces(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, by a model that has not seen the labels of the held-out fifth."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.with_score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written into archives and read back by range."""
    scratch = Scratch(spark, "archives")
    records = archives.read_archives(archives.write_archives(table(spark, sf_dir, "pages"), scratch), scratch)
    return records.select(
        F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its cluster after five rounds, and digests and sums of the clusters."""
    vectors, clusters = centroids.clustered(table(spark, sf_dir, "embeddings"))
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256).alias("centroid_sha256")
    told = clusters.select("cluster", F.col("cluster_inertia").cast("long"), F.col("inertia").cast("long"), digest)
    # One row per centroid, of which there are 40.
    return vectors.join(F.broadcast(told), "cluster").select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the corpus with the spelling it belongs to."""
    return variants.grouped_variants(table(spark, sf_dir, "documents"))


def op13_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every twentieth vector."""
    found = nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
    return found.select("query_id", "rank", "vec_id", "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe_round_trip": op1_bpe_round_trip,
    "op2_quality_rules": op2_quality_rules,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_line_dedup": op4_line_dedup,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_simhash": op6_simhash,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_packing": op8_packing,
    "op9_toxicity": op9_toxicity,
    "op10_warc": op10_warc,
    "op11_centroids": op11_centroids,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_nearest": op13_nearest,
}


def _clusters_sql(k: int = 40, rounds: int = 5) -> str:
    """The clustering in SQL: a table of centroids and one of assignments for each round."""
    steps = [
        """kept AS MATERIALIZED (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        f"""c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c, v FROM kept
            QUALIFY c < {k})""",
    ]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
            SELECT vec_id, kept.v, c{i}.c,
                   list_sum(list_transform(list_zip(kept.v, c{i}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
            FROM kept, c{i}
            QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c{i}.c) = 1)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (
            WITH sums AS (SELECT c, place, sum(v[place]) AS s, count(*) AS n FROM a{i}, range(1, 65) AS r(place) GROUP BY c, place),
                 moved AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY place) AS v FROM sums GROUP BY c)
            SELECT c{i}.c, coalesce(moved.v, c{i}.v) AS v FROM c{i} LEFT JOIN moved ON moved.c = c{i}.c)""")
    return f"""
        WITH {", ".join(steps)}
        SELECT vec_id, CAST(a{rounds}.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
               CAST(sum(d) OVER (PARTITION BY a{rounds}.c) AS BIGINT) AS cluster_inertia,
               CAST(sum(d) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
        FROM a{rounds} JOIN c{rounds} ON c{rounds}.c = a{rounds}.c"""


# Lower-cases A-Z only, as translate() has it.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op4_line_dedup": """
        WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
             lines AS (SELECT doc_id, len(l) AS n, unnest(l) AS line, unnest(range(len(l))) AS pos FROM split),
             windows AS (SELECT doc_id, pos, n, line || chr(10) || lead(line, 1) OVER d || chr(10) || lead(line, 2) OVER d AS w
                         FROM lines WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
             later AS (SELECT doc_id, pos FROM windows
                       WHERE pos + 2 < n AND w <> chr(10) || chr(10)
                       QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, pos) > 1),
             gone AS (SELECT DISTINCT doc_id, pos + i AS pos FROM later, range(3) AS r(i)),
             put AS (SELECT lines.doc_id,
                            string_agg(line, chr(10) ORDER BY lines.pos) FILTER (WHERE gone.pos IS NULL) AS text,
                            count(gone.pos) AS n_removed_lines, count(*) AS n_lines
                     FROM lines LEFT JOIN gone ON gone.doc_id = lines.doc_id AND gone.pos = lines.pos GROUP BY lines.doc_id)
        SELECT documents.doc_id,
               CASE WHEN documents.text IS NOT NULL THEN coalesce(put.text, '') END AS text,
               coalesce(n_lines, 0) AS n_lines,
               coalesce(n_removed_lines, 0) AS n_removed_lines
        FROM documents LEFT JOIN put ON put.doc_id = documents.doc_id""",
    "op5_exact_dedup": f"""
        SELECT doc_id,
               max(doc_id) OVER w AS keep_id,
               count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept,
               sha256({_LOWER}) AS text_sha256
        FROM documents
        WINDOW w AS (PARTITION BY {_LOWER})""",
    "op10_warc": """
        SELECT page_id,
               strlen(html) AS payload_bytes,
               sha256(html) AS payload_digest,
               CASE WHEN later THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN later THEN first_id END AS refers_to
        FROM (SELECT page_id, coalesce(html, '') AS html, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id,
                     strlen(coalesce(html, '')) >= 100
                     AND page_id > min(page_id) OVER (PARTITION BY coalesce(html, '')) AS later
              FROM pages)""",
    "op11_centroids": _clusters_sql(),
    # The exact search. On these tables the estimates miss no neighbour.
    "op13_nearest": """
        WITH usable AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
                        WHERE len(embedding) = len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
                          AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
             scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
                        FROM usable AS q JOIN usable AS c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v))
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM scored QUALIFY rank <= 20""",
}
