"""One query per operator, over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

import string
import zlib
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sectorlens import session
from sectorlens.llm import anchors, langid, mixing, neighbours, pii, runs, sharding, simhash, spelling, spm, syncmers, tokenids, topk
from sectorlens.llm.common import WORD, table

Query = Callable[[SparkSession, str], DataFrame]

#: The end id that op2 appends to each document.
END_ID = 2


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that a mix to weights 1, 2, 3 takes."""
    plan = mixing.mix_plan(table(spark, folder, "documents"), (1, 2, 3), 3)
    return plan.select("doc_id", "size", "source_size", "target", "taken", "source")


def op2_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids written to segments and read back: place, length and checksum of each document."""
    out = session.scratch_dir(spark, "token-ids")
    tokenids.write_token_ids(table(spark, folder, "documents"), out, tokenizer_path("byte_bpe_50k.json"), END_ID)
    return tokenids.read_token_ids(spark, out)


def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted language of every document."""
    return langid.identify(table(spark, folder, "documents"))


def op4_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of every document, their checksum, and whether they decode to the text."""
    path = tokenizer_path("piece_bpe_32k.model")
    docs = table(spark, folder, "documents").select("doc_id", "text")

    def digest(rows: pa.Array, ids: pa.Array) -> pa.RecordBatch:
        texts = [t or "" for t in pc.struct_field(rows, 1).to_pylist()]
        found = [x.values.to_numpy() for x in ids]
        return pa.RecordBatch.from_arrays(
            [
                pc.struct_field(rows, 0),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([len(x) for x in found], pa.int64()),
                pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in found], pa.int64()),
                pa.array([spm.decode_ids(x, path) == t for x, t in zip(found, texts)]),
            ],
            ["doc_id", "n_chars", "n_pieces", "ids_crc32", "round_trip"],
        )

    types = "doc_id long, n_chars long, n_pieces long, ids_crc32 long, round_trip boolean"
    return spm.encode(docs, path, finish=digest, types=types)


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document by its neighbours' votes."""
    return neighbours.score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Documents written to eight shards in shuffled order, read back from the files."""
    out = session.scratch_dir(spark, "shards")
    sharding.write_shards(table(spark, folder, "documents").select("doc_id", "text"), out, 8)
    text = F.coalesce(F.col("record.text"), F.lit(""))
    return spark.read.parquet(out).select(
        F.col("record.doc_id").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The five best inner products of every fiftieth vector."""
    return topk.top_k(table(spark, folder, "embeddings"), 5, 50)


def op8_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Syncmer fingerprints of every text and its edited text, and their positional likeness."""
    return syncmers.fingerprints(table(spark, folder, "documents"))


def _spans_text(spans: Column) -> Column:
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document: counts of base spans, their digest, and all spans."""
    docs = table(spark, folder, "documents")
    found = pii.detect(docs, [F.col("doc_id").cast("long").alias("doc_id")], "doc_id long")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(kind) for kind in pii.KINDS],
        F.sha2(_spans_text(F.col("base")), 256).alias("base_sha256"),
        _spans_text(F.col("spans")).alias("spans"),
    )


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the words under 35-word windows that start anywhere else too."""
    found = anchors.without_repeats(table(spark, folder, "documents"), 35)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text; in the documents that their id's checksum chooses, a tail of the words is repeated."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    given = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"))
    words = F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    given = given.withColumn("words", words).withColumn("n_words", F.size("words"))
    chosen = (F.col("h") % 10 == 0) & (F.col("n_words") > 0)
    a = F.col("g") % F.col("n_words")
    given = given.withColumn("a", F.when(chosen, a).cast("int"))
    period = F.lit(1) + F.floor((F.col("n_words") - F.col("a")) / (3 + F.col("g") % 8))
    given = given.withColumn("p", period.cast("int"))
    tail = F.transform(F.sequence("a", F.col("n_words") - 1), lambda i: F.get("words", F.col("a") + F.pmod(i - F.col("a"), F.col("p"))))
    planted = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    return given.select("doc_id", F.when(chosen, planted).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of words in every document: their number, the strongest, and digests of all and of the collapsed text."""
    found = runs.periodic_runs(with_planted_runs(table(spark, folder, "documents")), 24, 3)
    line = lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))
    lines = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))

    def stronger(best: Column, r: Column) -> Column:
        # exact comparison of length / period; runs come by start, then period, so the first of equals stays
        more = best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
        return F.when(more, r).otherwise(best)

    best = F.aggregate("runs", F.lit(None).cast("struct<start:long,length:long,period:long>"), stronger)
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def worn_words(docs: DataFrame) -> DataFrame:
    """Lower-cased (A-Z alone) runs of at least seven Latin letters; those that a checksum chooses lose a letter."""
    found = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z\u00C0-\u00FF]{7,}"), F.lit(0))).alias("run"))
    found = found.withColumn("run", F.translate("run", string.ascii_uppercase, string.ascii_lowercase))
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")))
    found = found.select("run", h.alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    worn = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    return found.select(F.when(F.col("h") % 31 == 0, worn).otherwise(F.col("run")).alias("word"))


def op13_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """Near words, form and root of every word of seven or more letters that occurs twice or more."""
    return spelling.variants(spelling.word_counts(worn_words(table(spark, folder, "documents")), 7, 2), 10)


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """All stages of the corpus, from raw documents to token ids."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_mixing, op2_token_ids, op3_language, op4_sentencepiece, op5_quality, op6_sharding, op7_topk,
        op8_fingerprints, op9_pii, op10_simhash, op11_substring_dedup, op12_periodic_runs, op13_spelling, pipeline,
    )
}

_WORD = r"[^\x20\x09-\x0D]+"

SQL: dict[str, str] = {
    "op1_mixing": rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size,
    md5('17:' || coalesce(doc_id::VARCHAR, 'null')) AS k
  FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS s,
    ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS w
  FROM sized GROUP BY source),
filled AS (
  SELECT *, ((SELECT sum(s) FROM per) - coalesce(sum(3 * s) OVER (ORDER BY 3 * s / w, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY 3 * s / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate,
    row_number() OVER (ORDER BY 3 * s / w, source NULLS LAST) AS place
  FROM per),
targets AS (
  SELECT source, s, least(w * (SELECT arg_min(rate, place) FROM filled WHERE rate <= 3 * s / w), (3 * s)::DOUBLE) AS target
  FROM filled),
laid AS (
  SELECT d.doc_id, d.size, t.s AS source_size, t.target, d.source, floor(t.target)::BIGINT AS budget,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, source, (CASE WHEN source_size = 0 THEN 0 ELSE
    (budget // source_size) * size + greatest(0, least(size, budget % source_size - before)) END)::BIGINT AS taken
FROM laid""",
    "op7_topk": """
WITH vecs AS (
  SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, q.r AS qr, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM vecs q JOIN vecs c ON q.r <> c.r WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5""",
}
