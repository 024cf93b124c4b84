"""Corpus pipeline: from raw documents to the pieces of a training mix.

``STAGES`` are applied in order, each to what the stage before kept: low
quality goes, one document of each group of near duplicates stays, long
repeated strings stay where they come first, sources are mixed to their target
weights, and the texts are cut into pieces. Every stage is written before the
next one reads it.

All stages but the last return the columns of ``documents``, whatever further
columns there are and whatever their names. In every stage an empty table gives
an empty one, texts are whole however long they are, and ties and draws are
settled by keyed hashes, so that a rerun gives the same rows; what becomes of
null texts, empty texts and repeated rows is said at each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewater.llm import minhash, mixing, pieces, quality, suffixes
from tracewater.llm.common import fresh, plain_names, stage

PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is 0.5 or more; the classifier learns from the labelled ones among ``docs``.

    Null and empty texts have the score of a text without features; repeated rows are judged each.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    weights = quality.fit(docs, labels)
    name = fresh(docs, "score")
    return quality.score(docs, weights, name=name).filter(F.col(name) >= 0.5).drop(name)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each component of similarity 0.8 on five-word shingles.

    Of rows that repeat a doc_id and its text the least by its columns stays
    (columns that have no order do not count). Null and empty texts and rows
    without doc_id are near nothing and stay.
    """
    docs, named = plain_names(docs)
    decided = minhash.near_duplicates(docs, width=5, percent=80)
    gone = stage(decided.filter("not kept").select("doc_id").distinct(), "gone")
    left = docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    twice = stage(
        docs.filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id"), "twice"
    )
    if not twice.limit(1).count():
        return named(left)
    place = fresh(docs, "place")
    sortable = [f.name for f in docs.schema.fields if "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"]
    order = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy(*sortable)
    repeated = left.join(twice, "doc_id", "left_semi").select(docs.columns).withColumn(place, F.row_number().over(order))
    once = repeated.filter(F.col(place) == 1).drop(place)
    return named(left.join(twice, "doc_id", "left_anti").select(docs.columns).unionByName(once))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 200-byte strings that start somewhere before; a text that is repeated whole goes.

    ``n_chars`` follows the text. Null texts stay null, empty ones stay.
    """
    was = fresh(docs, "was")
    marked = suffixes.apply_spans(docs.withColumn(was, F.length("text")), suffixes.repeats(docs, length=200, keep="first"))
    left = marked.filter(~((F.col("text") == "") & (F.col(was) > 0)) | F.col("text").isNull()).drop(was)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else left


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target needs; null and empty texts have size 0, the null source is one."""
    return mixing.apply_mix(docs, mixing.mix(docs))


def in_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with ``ids``, their pieces under merge dropout; a null or empty text has none of its own."""
    return pieces.encode(docs, pieces.load(PIECE_MODEL))


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_near_duplicates),
    ("repeats", without_repeats),
    ("mixing", mixed),
    ("pieces", in_pieces),
]

# Trained scores, hashed draws and the piece model have no counterpart in SQL; the tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
