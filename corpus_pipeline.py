"""The corpus pipeline: documents in known languages, without copies, near copies and benchmark text, mixed.

Each stage reads what its predecessor wrote. The first four return rows of ``documents`` as they are; the
last returns the mixture: a row for each use of a document, with its place in the order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hearsay.llm import decontaminate as decontamination
from hearsay.llm import exact_dedup as exact
from hearsay.llm import jaccard_join as jaccard
from hearsay.llm import language
from hearsay.llm import mixing
from hearsay.llm.queries import remainder
from hearsay.workspace import Rounds

MIN_SCORE = 0.5
REPETITION = 4.0

#: Language identification and the mixture are no SQL; ``tests/llm/test_pipeline.py`` holds each stage against plain Python.
ORACLE_SQL = None


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` as columns c0, c1, ... and ``row``: what tells its rows apart, null ids last."""
    plain = docs.select("doc_id", "text", "source", *docs.columns).toDF(
        "doc_id", "text", "source", *[f"c{i}" for i in range(len(docs.columns))]
    )
    return plain.withColumn("row", F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", F.xxhash64("text").alias("body")))


def _original(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[f"c{i}" for i in range(len(docs.columns))]).toDF(*docs.columns)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters, and those whose language is as good as open."""
    part = docs.select(F.col("text"), F.col("lang"), remainder("doc_id", 4).alias("part"))
    model = language.fit(part.filter(~F.col("part").isin(2, -1)))
    columns = [f"c{i}" for i in range(len(docs.columns))]
    scored = language.predict(docs.toDF(*columns), model, columns, text_col=columns[docs.columns.index("text")])
    return scored.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= MIN_SCORE)).drop("lang_pred", "score").toDF(*docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each text; rows that repeat id and text are one, the first by all columns."""
    rows = _numbered(docs)
    kept = exact.exact_dedup(rows, id_col="row").filter("kept").select("row").distinct()
    found = rows.join(kept, "row", "left_semi")
    first = Window.partitionBy("row").orderBy(*[f"c{i}" for i in range(len(docs.columns))])
    return _original(found.withColumn("_n", F.row_number().over(first)).filter("_n = 1"), docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of each component of near copies."""
    rows = _numbered(docs)
    kept = jaccard.jaccard_join(rows, id_col="row").filter("row = component_id").select("row")
    return _original(rows.join(kept, "row", "left_semi"), docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which a twentieth or more is benchmark text."""
    rows = _numbered(docs)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.decontaminate(rows, benchmark, id_col="row")
    return _original(rows.join(found.filter("contaminated").select("row"), "row", "left_anti"), docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The most even mixture of sources in which none is used more than four times."""
    return mixing.mix(docs, mixing.Target(repetition=REPETITION))


STAGES = [
    ("language", known_language),
    ("exact", without_copies),
    ("jaccard", without_near_copies),
    ("benchmark", without_benchmark),
    ("mixture", mixture),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Rounds(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = work.write(stage(spark, docs, sf_dir), name)
    return docs
