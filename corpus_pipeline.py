"""Training corpus: documents through five stages, each stored as Parquet and read again by the next.

Every stage works on all that the one before kept; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillworks.llm import decontamination, language, mixing, simhash, token_files
from tillworks.llm.common import fresh_names, stored, table


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without any letter, for which no language can be told; without labels all others stay, too."""
    labelled = language.sample(docs) or (("any", "a"),)
    label, score = fresh_names(docs.columns, "__lang_pred", "__score")
    known = language.predicted_rows(docs, labelled, (label, score)).where(F.col(score) > 0)  # 0 is for texts without letters alone
    return known.select([f"`{c}`" for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one document stays: that of the least known id."""
    kept = stored(simhash.representatives(simhash.near_duplicates(docs)), "representatives")
    same_row = F.col("__id").eqNullSafe(F.col("id")) & (F.col("__same") == F.col("same"))
    kept = kept.select("id", "same", "n")
    named = docs.select(F.struct("*").alias("__row"), F.col("doc_id").alias("__id"), F.xxhash64("text").alias("__same"))
    rest = named.join(kept, same_row)
    if not kept.where("n > 1").isEmpty():  # rows repeated as a whole: one of them
        rest = rest.dropDuplicates(["__id", "__same"])
    return rest.select("__row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a window of a benchmark item occurs, be its id known or not."""
    named = docs.select(F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("same")).alias("doc_id"), "text")
    items = table(spark, sf_dir, "benchmark").select(F.lit("item").alias("item_id"), "text")  # which item it was doesn't matter
    hit = decontamination.find(decontamination.build_index(named), items).where(F.size("hits") > 0)
    hit = hit.select(F.col("doc_id.id").alias("__hit"), F.col("doc_id.same").alias("__same")).distinct()
    rows = docs.select(F.struct("*").alias("__row"), F.col("doc_id").alias("__id"), F.xxhash64("text").alias("__text"))
    same_row = F.col("__id").eqNullSafe(F.col("__hit")) & (F.col("__text") == F.col("__same"))
    return rows.join(hit, same_row, "left_anti").select("__row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that the sources' words meet their target weights."""
    take = mixing.copies(docs).where("copies > 0").select(
        F.col("doc_id").alias("__d"), F.col("same").alias("__t"), F.col("source").alias("__s"), F.col("copies").alias("__copies"))
    named = docs.select(F.struct("*").alias("__row"), F.col("doc_id").alias("__id"), F.xxhash64("text").alias("__same"), F.col("source").alias("__source"))
    mine = named.join(
        take, F.col("__id").eqNullSafe(F.col("__d")) & (F.col("__same") == F.col("__t")) & F.col("__source").eqNullSafe(F.col("__s")))
    return mine.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select("__row.*")


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids in plane files, and per document what is read back from them."""
    return token_files.read(*token_files.write(docs))


STAGES = [
    ("language", keep_known_languages),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token files", write_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs


ORACLE_SQL = None  # XXH64, random draws and tokenizers can't be stated in SQL
