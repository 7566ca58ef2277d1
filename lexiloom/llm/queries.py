"""One registered query per operator, each over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.llm import alignment_tokens, conversations, htmltext, langid, linededup, mixing, nndescent, packing, permindex, pii, quality, sharding, simhash
from lexiloom.session import cut


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces with their place in sequences of 1024 tokens."""
    pieces = packing.pieces(read(spark, sf_dir, "documents"), tokenizer_path())
    digests = cut(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
    return packing.pack(digests).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every text, its share of the letters, and the number of language spans."""
    found = langid.identify(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score", F.size("spans").alias("n_spans"))


def _joined(spans: str) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count(kind: str) -> F.Column:
    return F.size(F.filter("plain", lambda s: s["kind"] == kind)).cast("long")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the plain spans of personal data in every text, and all spans with the disguised ones."""
    found = pii.find(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *[_count(kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(_joined("plain"), 256).alias("base_sha256"), _joined("spans").alias("spans"),
    )


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.9."""
    return nndescent.near_duplicates(read(spark, sf_dir, "embeddings"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes."""
    dealt = sharding.shard(read(spark, sf_dir, "documents"))
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without later occurrences of passages of three lines."""
    return linededup.dedup_lines(read(spark, sf_dir, "documents")).select("doc_id", "n_removed", "text")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture of all sources, small ones read up to 1.5 times, in blocks of a million words."""
    return mixing.mixture(read(spark, sf_dir, "documents"))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return htmltext.extract(read(spark, sf_dir, "pages"))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth embedding by inner product."""
    vectors = read(spark, sf_dir, "embeddings")
    return permindex.search(vectors, vectors.where("vec_id % 20 = 0"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document."""
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of the byte-level and the piece tokens of every document, with the corpus-wide counts of the links."""
    return alignment_tokens.link_counts(read(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts of every document, the plain rule, and the verdict of the forest."""
    return quality.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with set damage, by the checksum of ``conv_id:turn`` modulo 20; nulls count as one blank.

    0 drops a row (it stays as one that is not present), 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes
    it a user's.
    """
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.col("kind")
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("text", "role"))
    return rows.withColumn("kind", F.crc32(key) % 20).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (kind != 0).alias("present"), F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every damaged conversation, and its cheapest repair."""
    return conversations.repair(damaged(read(spark, sf_dir, "conversations")), F.col("present"))


QUERIES = {
    "op1_packing": op1_packing, "op2_language": op2_language, "op3_pii": op3_pii,
    "op4_embedding_dedup": op4_embedding_dedup, "op5_sharding": op5_sharding, "op6_line_dedup": op6_line_dedup, "op7_mixing": op7_mixing,
    "op8_html": op8_html, "op9_neighbours": op9_neighbours, "op10_simhash": op10_simhash,
    "op11_alignment": op11_alignment, "op12_quality": op12_quality, "op13_conversations": op13_conversations,
}

ORACLES = {
    "op4_embedding_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), near AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reach(x, y) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT reach.x, near.y FROM reach JOIN near ON near.x = reach.y
), part AS (SELECT x AS vec_id, min(y) AS component_id FROM reach GROUP BY x),
links AS (SELECT x AS vec_id, count(*) AS n FROM near GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM part LEFT JOIN links USING (vec_id)
""",
    "op6_line_dedup": """
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
  FROM documents WHERE text IS NOT NULL
), wide AS (
  SELECT doc_id, pos, trim(line) AS a, lead(trim(line), 1) OVER w AS b, lead(trim(line), 2) OVER w AS c
  FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), later AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, pos) AS nth
  FROM wide WHERE c IS NOT NULL AND (a <> '' OR b <> '' OR c <> '')
), covered AS (
  SELECT DISTINCT doc_id, pos + k AS pos FROM later, (VALUES (0), (1), (2)) AS v(k) WHERE nth > 1
), kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text
  FROM lines ANTI JOIN covered USING (doc_id, pos) GROUP BY doc_id
), gone AS (SELECT doc_id, count(*) AS n FROM covered GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(g.n, 0) AS INT) AS n_removed, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text
FROM documents d LEFT JOIN kept k USING (doc_id) LEFT JOIN gone g USING (doc_id)
""",
}
