"""Corpus pipeline: toxicity, near duplicates, personal data, source mixing, packing.

Each stage works on all rows that the stage before kept, written as Parquet and
read again; all but the last return the columns of ``documents``.

Defined results of every stage: ids may be null or repeat, as stages judge rows;
null texts stay null and count as empty (not toxic by their words, one
near-duplicate group with other empty texts, nothing to redact, size 0, one
closing id to pack); of tied and repeated rows the near-duplicate stage keeps one,
the others keep all; empty tables give empty tables; extra columns pass through,
whatever their names, as scratch columns take names that are not in use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from classbench.llm.common import fresh, materialize, read_table
from classbench.llm.mixing import mix, take
from classbench.llm.packing import default_tokenizer, digests, pack
from classbench.llm.pii import find_pii, redact
from classbench.llm.simhash import near_duplicates
from classbench.llm.toxicity import fit_toxicity, toxicity_score


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine does not call toxic."""
    machine = fit_toxicity(docs, read_table(spark, sf_dir, "labels"))
    return docs.where(toxicity_score(machine, F.col("text")) < 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: of the smallest id, and of the smallest hash among rows of that id.

    Rows without an id are grouped like others and stay where their group has no id.  Rows that are equal in
    every column are one row before texts are dealt, once, by the hash and id that the kept rows are joined on.
    """
    row, own, named, id_ = (fresh(docs, c) for c in ("_row", "_hash", "_named", "_id"))
    hash_, key = F.xxhash64(*docs.columns), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = docs.withColumn(row, F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), hash_.alias("hash")))
    kept = near_duplicates(rows, shingle=3, max_bits=2, id_col=row).select("component.*").distinct().select(
        F.col("hash").alias(own), F.col("id").isNotNull().alias(named), F.coalesce(F.col("id").cast("string"), F.lit("")).alias(id_))
    once = docs.select("*", hash_.alias(own), F.col("doc_id").isNotNull().alias(named), key.alias(id_)).dropDuplicates([own, named, id_])
    return once.join(kept, [own, named, id_], "left_semi").select(*docs.columns)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every span of personal data replaced by its kind."""
    spans = fresh(docs, "_spans")
    found = find_pii(docs, out=spans)
    text = F.when(F.col("text").isNotNull(), redact(F.col("text"), F.col(spans)))
    clean = found.withColumn("text", text).drop(spans)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return take(docs, mix(docs))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 2048 ids."""
    return digests(pack(docs, default_tokenizer()))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]
#: Learnt scores, hashes and draws: tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
