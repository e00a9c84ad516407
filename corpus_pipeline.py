"""A corpus from raw documents: language, near copies, repeated passages, mixture, tokens.

Each stage takes the documents that the one before has left and returns documents again; the last one returns tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changetide.llm.bpe import digests
from changetide.llm.jaccard import near_sets
from changetide.llm.language import identified, learned
from changetide.llm.mixing import mix
from changetide.llm.repeats import without_repeats
from changetide.llm.tables import stored, table, temporary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
NEAR_WORDS, NEAR_PERCENT = 5, 80   # near copies share four fifths of their runs of five words
PASSAGE = 240                      # bytes of the shortest repeated passage that is cut, however many words these are
KEPT_RATE = 0.5                    # a document is kept if it is taken at least this often
TOXIC = 0.5                        # and only goes if it is as likely toxic as not
MARK = "row_mark"


def _marked(docs: DataFrame) -> DataFrame:
    """The documents with a number for each row; equal rows share it, and so the same decision."""
    return docs.select(*COLUMNS).withColumn(MARK, F.xxhash64(*COLUMNS))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in a known language, as text, declared language and source say together.

    Rejected: text without letters (null and empty too), in no known language, or in none with half the belief.
    """
    marked = _marked(docs)
    names, chances = learned(marked, "text", "lang")
    found = identified(marked, "text", "lang", F.col("source"), F.lit("-"), names, chances)
    judged = stored(found.select(MARK, "accepted"), "judged")   # written first, or the filter would repeat the whole formula
    rejected = stored(judged.filter("not accepted").select(MARK).distinct(), "rejected")
    return marked.join(rejected, MARK, "left_anti").select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the least doc_id; repeated rows stay once.

    Documents are told apart by doc_id and text, so a doc_id that several texts share goes with some of them only. Documents with a null doc_id
    have no place in that order and stay.
    """
    marked = docs.select(*COLUMNS).withColumn(MARK, F.xxhash64("doc_id", "text"))
    with temporary(spark):
        found = near_sets(marked, MARK, words=NEAR_WORDS, percent=NEAR_PERCENT).select(MARK, "component_id").dropDuplicates([MARK])
        named = marked.filter("doc_id is not null").select(MARK, "doc_id").dropDuplicates([MARK]).join(found, MARK)
        named = stored(named, "groups")
        first = named.groupBy("component_id").agg(F.min(F.struct("doc_id", MARK))[MARK].alias(MARK))
        gone = stored(named.join(first, MARK, "left_anti").select(MARK), "gone", keep=True)
    kept = marked.filter("doc_id is not null").join(gone, MARK, "left_anti").dropDuplicates([MARK, "doc_id", "text"])
    return kept.select(*COLUMNS).union(docs.filter("doc_id is null").select(*COLUMNS))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur again anywhere; what has no text left goes.

    A character that loses some of its bytes goes as a whole.
    """
    marked = _marked(docs)
    with temporary(spark):
        cut = without_repeats(marked, MARK, length=PASSAGE, characters=True).filter("n_removed > 0").select(MARK, "kept").dropDuplicates([MARK])
        cut = stored(cut, "cut_texts", keep=True)
    joined = marked.join(cut, MARK, "left")
    text = F.when(F.col("kept").isNull(), F.col("text")).otherwise(F.col("kept").cast("string"))
    return joined.withColumn("text", text).filter(F.trim("text") != "").withColumn(
        "n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mixture without toxic tokens takes, and all that are less likely toxic than not.

    Taking almost no toxic tokens lowers the rates of slightly doubtful documents too; these stay. Documents with a null doc_id have no rate and stay.
    """
    rated = mix(docs, "doc_id", "text", table(spark, sf_dir, "labels"))
    gone = stored(rated.filter((F.col("rate") < KEPT_RATE) & (F.col("p_toxic") >= TOXIC)).select("doc_id"), "not_taken")
    return docs.select(*COLUMNS).join(gone, "doc_id", "left_anti").select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document that is left, encoded and decoded again."""
    return digests(docs, "doc_id")


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", near_copies),
    ("suffix-array dedup", repeated_passages),
    ("mixing sources to target weights", mixture),
    ("BPE encoding and decoding", tokens),
]

# Language models, sorted suffixes, gradient steps and byte pairs are beyond SQL; tests/llm/test_pipeline.py compares with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
