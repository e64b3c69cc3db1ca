"""The corpus pipeline: documents in, packed token sequences out, in five stages.

Each stage takes all that its predecessor kept, written as Parquet and read again. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linewatch.llm import bagminhash, decontaminate, secret_scan, toxicity
from linewatch.llm.names import unused
from linewatch.llm.packing import pack
from linewatch.session import materialise

#: A document of this score or more is toxic.
TOXIC = 0.7
#: Ids below this number of rows go to every executor; a larger table is joined by shuffles.
SMALL_IDS = 4_000_000


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text scores below TOXIC. The grammar is learned from the labelled rows of this input."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    grammar = toxicity.learn(docs.where(~toxicity.held_out()), labels.where(~toxicity.held_out()))
    name = unused(docs, "score")
    return toxicity.score(docs, grammar, name).where(F.col(name) < TOXIC).select(*docs.columns)


def _matching(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` whose id, null as any other, and text are (``left_semi``) or are not (``left_anti``) among ``rows``
    (doc_id, text_hash)."""
    own, hashed = unused(docs, "own_id"), unused(docs, "own_hash")
    rows = rows.select(F.col("doc_id").alias(own), F.col("text_hash").alias(hashed)).distinct()
    rows = materialise(docs.sparkSession, rows, "rows")
    small = rows.count() <= SMALL_IDS
    same = F.col("doc_id").eqNullSafe(F.col(own)) & (F.xxhash64("text") == F.col(hashed))
    return docs.join(F.broadcast(rows) if small else rows, same, how)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class stays. Of rows equal in id and text, which are of one class, the least by the other columns does."""
    judged = materialise(spark, bagminhash.near_duplicates(docs), "classes")
    kept = _matching(docs, judged.where("not kept"), "left_anti")
    # Null and empty texts are classes of their own, repeated or not.
    twice = judged.where("kept").groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    wordless = [F.xxhash64(F.lit(t).cast("string")) for t in (None, "")]
    twice = materialise(spark, twice.where(~F.col("text_hash").isin(*wordless)).drop("n"), "twice")
    if twice.isEmpty():
        return kept
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    least = unused(docs, "least")
    one = _matching(kept, twice, "left_semi").groupBy("doc_id", "text").agg(F.min(F.struct(*others)).alias(least))
    one = one.select("doc_id", "text", f"{least}.*").select(*docs.columns)
    return _matching(kept, twice, "left_anti").unionByName(one)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold less of the benchmark than a twentieth of their words."""
    judged = decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _matching(docs, judged.where("contaminated"), "left_anti")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with secrets masked and the length of the text set anew where one was."""
    before = unused(docs, "before")
    masked = secret_scan.redact(docs.withColumn(before, F.col("text")))
    changed = ~F.col("text").eqNullSafe(F.col(before))
    length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return masked.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars"))).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows, in sequences of 1024 tokens."""
    return pack(docs, tokenizer_file())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("packing", pack_sequences),
]

#: Learned scores, sketches and tokens are beyond SQL; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
