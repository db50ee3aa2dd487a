"""From documents to training tokens: five stages, each over all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rootlens.llm import bpe, jaccard, language, mixing, toxicity
from rootlens.llm.frames import Scratch
from rootlens.session import reach_package

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


_OWN = ("doc_id", "text")


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and all other columns as one, so that none clashes with an operator's."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in _OWN]
    return docs.select(*_OWN, (F.struct(*others) if others else F.lit(0)).alias("given"))


def _unpacked(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again."""
    return rows.select(*[F.col(c) if c in _OWN else F.col("given").getField(c).alias(c) for c in docs.columns])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter; null texts and texts without letters go.

    The parse gives every text with a letter the nearest of the taught languages, so a text
    in a language that no labelled document teaches stays too."""
    samples = language.train(docs)
    if not samples:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    judged = language.identify(_packed(docs), samples, keep=("text", "given"))
    return _unpacked(judged.filter(F.col("lang_pred") != language.UNKNOWN), docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not judged toxic; null and empty texts, and repeated rows, are judged
    like any other. An empty table stays empty."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = toxicity.judge(_packed(docs), toxicity.train(docs, labels), keep=("text", "given"))
    return _unpacked(judged.filter("predicted = 0"), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates; see jaccard.keep_one for the cases."""
    return jaccard.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them; see mixing.mixed for the cases."""
    return mixing.mixed(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, ids, n_tokens and the digest of the decoded bytes of every document; a null
    text has no ids, and an empty table gives no rows."""
    vocabulary = bpe.load()
    # written in between: a task then needs one Python worker, not one for either way
    coded = Scratch(spark).store(bpe.encode(docs, vocabulary, keep=("doc_id", "source")), "ids")
    back = bpe.decode(coded, vocabulary, keep=("doc_id", "source", "ids"))
    return back.select(
        "doc_id", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2("data", 256).alias("decoded_sha256")
    )


STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", encode_tokens),
]

#: No SQL: the classifiers and the random rounding have none; tests/llm compares the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each is written to the shared folder and read again."""
    reach_package(spark)
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
