"""The text operators bound to the given tables: ``opN_<name>`` and the SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import centroids, decontaminate, html_text, line_dedup, merkle, minhash, neighbours, packing, pii
from tradewind.llm import quality_rules, ranking, resharding, warc
from tradewind.session import scratch_path

#: shards of the old layout (documents of a source together) and of the new one
OLD_SHARDS, SHARDS = 12, 8


def vocabulary() -> str:
    """The word-level vocabulary that the packing queries use."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return minhash.duplicate_groups(table(spark, folder, "documents"))


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages, written as web archives, normalised and read back by offset."""
    return warc.archive_pages(table(spark, folder, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, packed into sequences of 4096 tokens."""
    return packing.pack(table(spark, folder, "documents"), vocabulary())


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Traits and verdict of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return quality_rules.judge(docs).drop("text")


def op5_resharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, moved from shards by source to eight shards of equal row counts."""
    docs = table(spark, folder, "documents").select(
        "doc_id", "text", resharding.old_shard(F.col("source"), OLD_SHARDS).alias("old_shard"))
    placed, plan = resharding.reshard(docs, "old_shard", SHARDS)
    out = resharding.rewrite(placed, plan, scratch_path(spark, "resharded"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "old_shard")


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Shared lines of all documents: what each document loses, and a digest of what stays."""
    out = line_dedup.drop_shared_lines(table(spark, folder, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in all documents."""
    found = pii.find(table(spark, folder, "documents")).drop("redacted")
    counts = [F.regexp_count("base", F.lit(f"(^|,){k}:")).cast("long").alias(f"n_{k}") for k in pii.KINDS[:4]]
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans")


def op8_html_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, folder, "pages"))


def op9_pairwise_ranking(spark: SparkSession, folder: str) -> DataFrame:
    """Quality scores of all documents."""
    return ranking.rank(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that lie in passages of the benchmark, and the items concerned."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.mark(docs, table(spark, folder, "benchmark"))
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(names, 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def op11_subvector_centroids(spark: SparkSession, folder: str) -> DataFrame:
    """All vectors in 40 clusters, after 5 rounds."""
    return centroids.cluster(table(spark, folder, "embeddings"))


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Digests and proofs of all documents, some of them tampered with."""
    return merkle.manifest(table(spark, folder, "documents"))


def op13_block_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest neighbours of every vector whose id is divisible by 20, among all."""
    vectors = table(spark, folder, "embeddings")
    return neighbours.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_warc": op2_warc,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_quality_rules": op4_quality_rules,
    "op5_resharding": op5_resharding,
    "op6_line_dedup": op6_line_dedup,
    "op7_pii": op7_pii,
    "op8_html_text": op8_html_text,
    "op9_pairwise_ranking": op9_pairwise_ranking,
    "op10_decontaminate": op10_decontaminate,
    "op11_subvector_centroids": op11_subvector_centroids,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_block_neighbours": op13_block_neighbours,
}


def _centroids_sql(many: int = 40, rounds: int = 5) -> str:
    """One pair of steps for each round: nearest centroids, then their new components."""
    near = """
n{0} AS MATERIALIZED (
  SELECT r, vec_id, v, d[1] AS distance, CAST(d[2] AS BIGINT) AS cluster
  FROM (SELECT r, vec_id, v, min([CAST(list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT), k]) AS d
        FROM kept, c{0} GROUP BY r, vec_id, v))"""
    move = """
m{0} AS (
  SELECT cluster, p, (s - ((s % n) + n) % n) // n AS x
  FROM (SELECT cluster, p, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
        FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS p FROM n{0}) GROUP BY cluster, p)),
c{1} AS MATERIALIZED (
  SELECT k, coalesce(list(x ORDER BY p) FILTER (p IS NOT NULL), any_value(c)) AS c
  FROM c{0} LEFT JOIN m{0} ON k = cluster GROUP BY k)"""
    steps = ",".join(near.format(i) + "," + move.format(i, i + 1) for i in range(rounds)) + "," + near.format(rounds)
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x) OR abs(256 * CAST(x AS DOUBLE)) >= 134217728)) = 0),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY h, v) - 1 AS BIGINT) AS k, v AS c
  FROM (SELECT sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, v FROM kept ORDER BY h, v LIMIT {many})),{steps}
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM n{rounds} JOIN c{rounds} ON k = cluster"""


def _manifest_sql(deep: int = 7, sources: int = 4) -> str:
    """One table of nodes and one of siblings for each level of the trees (16 to that power of leaves at most)."""
    def levels(kind: str, count: int) -> str:
        node = """
{0}{2} AS MATERIALIZED (
  SELECT t, pos // 16 AS pos, CASE WHEN pos // 16 = 0 AND count(*) = 1 THEN min(d) ELSE sha256(string_agg(d, '' ORDER BY pos)) END AS d
  FROM {0}{1} GROUP BY t, pos // 16)"""
        side = """
{0}s{1} AS MATERIALIZED (
  SELECT t, pos, CASE WHEN NOT (pos // 16 = 0 AND count(*) OVER (PARTITION BY t, pos // 16) = 1) THEN [
         coalesce(string_agg(d, '') OVER (PARTITION BY t, pos // 16 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), ''),
         coalesce(string_agg(d, '') OVER (PARTITION BY t, pos // 16 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '')] END AS s
  FROM {0}{1})"""
        return ",".join(side.format(kind, i) + "," + node.format(kind, i, i + 1) for i in range(count))

    def walked(kind: str, count: int, tree: str, pos: str) -> str:
        return "".join(f"\n  JOIN {kind}s{i} AS {kind}{i} ON {kind}{i}.t = {tree} AND {kind}{i}.pos = {pos} // {16 ** i}" for i in range(count))

    path = [f"leaves{i}.s" for i in range(deep)] + [f"sources{i}.s" for i in range(sources)]
    proof = " || ".join(f"coalesce({s}[1] || {s}[2], '')" for s in path)
    folds = ""
    for n, s in enumerate(path):
        folds += f",\nf{n + 1} AS (SELECT * EXCLUDE (f), CASE WHEN p[{n + 1}] IS NULL THEN f ELSE sha256(p[{n + 1}][1] || f || p[{n + 1}][2]) END AS f FROM f{n})"
    text = lambda c: f"coalesce(CAST(octet_length(encode(CAST({c} AS VARCHAR))) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"
    row = " || ".join(map(text, ("doc_id", "source", "lang", "n_chars")))
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH table_of AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
         lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS crc),
hashed AS (
  SELECT doc_id, coalesce('1' || source, '0') AS t, sha256({row} || {text("text")}) AS d, sha256({row} || {text(low)}) AS lowered,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1),
             lambda i: ord(substr(CAST(doc_id AS VARCHAR), CAST(i AS INTEGER), 1))::BIGINT)),
             lambda c, b: xor(c >> 8, crc[xor(c, b) % 256 + 1])), 4294967295) AS crc
  FROM documents, table_of),
leaves0 AS MATERIALIZED (
  SELECT doc_id, t, d, CASE WHEN crc % 5 = 0 THEN lowered ELSE d END AS f,
         row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, d) - 1 AS pos
  FROM hashed),{levels("leaves", deep)},
sources0 AS MATERIALIZED (SELECT t AS source, '' AS t, d, row_number() OVER (ORDER BY t) - 1 AS pos FROM leaves{deep}),{levels("sources", sources)},
f0 AS (
  SELECT x.doc_id, x.d AS leaf, y.d AS subroot, z.d AS root, sha256({proof}) AS proof_sha256, x.f, [{", ".join(path)}] AS p
  FROM leaves0 AS x JOIN sources0 AS y ON y.source = x.t CROSS JOIN sources{sources} AS z{walked("leaves", deep, "x.t", "x.pos")}{walked("sources", sources, "''", "y.pos")}){folds}
SELECT doc_id, leaf, subroot, root, proof_sha256, f AS folded_root, f = root AS verified FROM f{len(path)}"""

SQL: dict[str, str] = {
    "op2_warc": """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first
  FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f""",
    "op6_line_dedup": r"""
WITH held AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM held),
shared AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
judged AS (
  SELECT keyed.*, keeper IS NOT NULL AND keeper <> doc_id AS dropped FROM keyed LEFT JOIN shared USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id""",
    "op10_decontaminate": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT item_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i
        FROM (SELECT item_id, w, least(10, len(w)) AS size FROM b WHERE len(w) > 0))),
dw AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i
        FROM d, (SELECT DISTINCT size FROM bw) WHERE len(w) >= size)),
hits AS (SELECT DISTINCT doc_id, i, size, item_id FROM dw JOIN bw USING (size, win)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS p FROM hits) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS names
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op11_subvector_centroids": _centroids_sql(),
    "op12_merkle_manifest": _manifest_sql(),
    "op13_block_neighbours": """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
q AS (SELECT row_number() OVER () AS n, * FROM v WHERE vec_id % 20 = 0),
s AS (
  SELECT n, q.vec_id AS query_id, v.vec_id, list_inner_product(q.x, v.x) AS score
  FROM q JOIN v ON v.vec_id IS DISTINCT FROM q.vec_id AND len(v.x) = len(q.x))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM s) WHERE rank <= 20""",
}
