"""A corpus made ready for training: five stages over ``documents``.

Each stage works on all rows of the one before, which are written as Parquet in between.
The first four return the columns they were given; the last one returns the packed pieces.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasmlens.llm import language, lines, mixing, packing, simhash
from rasmlens.llm.frames import stored, table
from rasmlens.llm.queries import (
    MIN_SITES, MIX_EPOCHS, MIX_SEED, MIX_SHARE, MIX_WEIGHTS, mix_levels)

#: Least share of a document that must be in its main language.
LEAST_SHARE = 0.5


def whole_rows(docs: DataFrame, *read: str) -> DataFrame:
    """``row``, all columns as one struct, and the columns that a stage reads. So no column that a
    stage adds on its way can meet one of the documents' own."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *read)


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or without a language of at least ``LEAST_SHARE``, go."""
    model = language.train(docs)
    found = language.identify(whole_rows(docs, "text"), model, ["row"])
    known = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_SHARE)
    return found.where(known).select("row.*")


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand on many sources stay once in the corpus; documents left empty by it go
    with the near-duplicates of the next stage."""
    cleaned = lines.remove_shared_lines(docs, MIN_SITES)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cleaned


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each SimHash group stays."""
    return simhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The target mixture; a document that is read twice stands there twice."""
    chosen = mixing.mix(whole_rows(docs, "doc_id", "text", "lang", "source"), mix_levels(), MIX_WEIGHTS,
                        MIX_SHARE, MIX_EPOCHS, MIX_SEED, copies="copies")
    return chosen.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two lengths with their token ids, numbered within their lengths."""
    return packing.in_buckets(packing.pack(docs)).withColumn("ids_crc32", F.crc32("tokens"))


STAGES = [
    ("language", keep_known_language),
    ("lines", drop_shared_lines),
    ("near_duplicates", drop_near_duplicates),
    ("mixture", mix_sources),
    ("packing", pack_documents),
]

#: The first stage's model has no SQL form; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
