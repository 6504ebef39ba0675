"""The corpus pipeline over documents: toxic texts out, one of each near-duplicate group, benchmark items out, personal data
masked, sources mixed. STAGES are (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is
written and read again as the next one's docs. All but the last return the columns of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import decontaminate, minhash, mixing, pii, toxicity
from tessera.llm.common import stored
from tessera.session import ship


def _free(docs: DataFrame, name: str) -> str:
    """A column name like the given one that docs does not have."""
    while name in docs.columns:
        name = f"_{name}"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5; null and empty texts are scored like texts without words. Labels of ids
    that docs lacks are ignored; an empty table stays empty; all columns stay."""
    ship(spark)
    score = _free(docs, "score")
    model = toxicity.fit(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"))
    return toxicity.score(docs, model, column=score).filter(F.col(score) < 0.5).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity 0.8) the document with the least id. Documents
    without words and with null ids stay; rows that share an id are one document."""
    ship(spark)
    gone = minhash.near_duplicates(docs.select("doc_id", "text")).filter(~F.col("kept")).select(F.col("id").alias("doc_id")).distinct()
    return docs.join(gone, "doc_id", "left_anti")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item within its budget of edits."""
    ship(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind in brackets; n_chars follows the text."""
    ship(spark)
    masked = pii.redacted(docs, pii.fit(docs.select("doc_id", "text")))
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


#: What the mix adds to a document.
MIX_COLUMNS = ("size", "source_size", "target", "taken", "copies")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with copies (1 or 2), size, source_size, target and taken words, which replace
    columns of these names. Documents without words are not taken; rows that share an id are queued one by one, equal rows
    are interchangeable, and null ids and sources are taken like others. An empty table stays empty."""
    ship(spark)
    rest = [c for c in docs.columns if c not in MIX_COLUMNS]
    row, nth, key = _free(docs, "row"), _free(docs, "nth"), _free(docs, "key")
    # A row's key is a digest of what the mix sees of it; only rows equal in all of that are numbered among each other.
    rows = docs.select(*rest).withColumn(row, F.xxhash64("doc_id", "source", "text")).filter(mixing.word_count(F.col("text")) > 0)
    plan = mixing.mix(rows, row_col=row).select("id", F.col("row").alias(key), *MIX_COLUMNS)
    plan = plan.withColumn(nth, F.row_number().over(Window.partitionBy("id", key).orderBy("copies"))).filter("copies > 0").withColumnRenamed("id", "_mix_id" if "_mix_id" not in rest else _free(docs, "_mix_id"))
    chosen = plan.columns[0]
    rows = rows.withColumn(nth, F.row_number().over(Window.partitionBy("doc_id", row).orderBy(row)))
    at = F.col("doc_id").eqNullSafe(F.col(chosen)) & (F.col(row) == F.col(key)) & (rows[nth] == plan[nth])
    return rows.join(plan, at).select(*[rows[c] for c in rest], *MIX_COLUMNS)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", mask_personal_data),
    ("mix", mix_sources),
]

#: The learned stages and the similarity join have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
