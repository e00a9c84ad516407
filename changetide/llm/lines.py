"""Operator 11: lines that other documents hold too."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import fresh, joined_by_key, literal_text, stored, table

LEAST = 10      # code points of the shortest key that counts
DOCUMENTS = 2   # documents that make a key a repeated one
# Fixed values of the contract: what is stripped at both ends, and the letters that are lower-cased.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without blanks at its ends and with A-Z in lower case; other letters stay as they are."""
    bare = F.btrim(line, F.lit(BLANKS))
    plain = F.octet_length(bare) == F.char_length(bare)   # lower() is the same for these, and much faster
    return F.when(plain, F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _lines(marked: DataFrame, key: str, text: str, mark: str, least: int) -> DataFrame:
    """One row per line whose key is long enough: ``holder, mark, place`` and ``digest``, 128 bits of the key."""
    split = marked.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("holder"), F.col(mark).alias("mark"), F.posexplode(F.split(text, "\n")).alias("place", "line"))
    keyed = split.select("holder", "mark", "place", line_key(F.col("line")).alias("line"))
    return keyed.filter(F.char_length("line") >= least).select(
        "holder", "mark", "place", F.unhex(F.substring(F.sha2("line", 256), 1, 32)).alias("digest"))


def without_repeated_lines(docs: DataFrame, key: str, text: str = "text", least: int = LEAST,
                           documents: int = DOCUMENTS) -> DataFrame:
    """The documents with ``kept``, the text without lines of other documents, ``n_lines`` and ``n_dropped``.

    A line's key is the line stripped of blanks, in lower case. A key of at least ``least`` code points that at least
    ``documents`` documents hold stays in the one with the smallest ``key`` alone, with all its lines there. Keys are compared by
    128 bits of their SHA-256.

    A null or empty text is one empty line. Rows with equal ``key`` are one document: none takes a line from the other, and each loses what
    an earlier document holds. Rows with a null key are no documents: they hold nothing and keep everything. Input columns named as an
    output are replaced; all others stay.

    Documents of a key are counted in two steps, and a key's lines meet that count in a join that sends hot keys to every task, so a line
    that all documents hold fills no task. A document's lines come together again as its own positions only.
    """
    docs = docs.drop("kept", "n_lines", "n_dropped")
    mark, cut, whole = fresh(docs, "mark"), fresh(docs, "cut"), fresh(docs, "lines")
    names = docs.columns
    marked = docs.withColumn(mark, F.xxhash64(literal_text(text)))
    lines = stored(_lines(marked, key, text, mark, least), "lines")
    held = lines.groupBy("digest").agg(
        F.min("holder").alias("first"), F.count_distinct("holder").alias("documents"), F.count("*").alias("n"))
    repeated = stored(held.filter(F.col("documents") >= documents).select("digest", "first", "n"), "repeated_lines")
    gone = joined_by_key(lines, repeated, "digest", "n").filter(F.col("holder") > F.col("first"))
    places = gone.groupBy(F.col("holder").alias(key), F.col("mark").alias(mark)).agg(F.collect_set("place").alias(cut))
    # Split below the join: an expression would be computed again for every element that is taken from it.
    joined = marked.withColumn(whole, F.split(literal_text(text), "\n")).join(places, [key, mark], "left")
    size = F.size(whole)
    stays = F.array_except(F.sequence(F.lit(0), size - 1), cut)
    kept = F.array_join(F.transform(stays, lambda i: F.get(F.col(whole), i)), "\n")
    return joined.select(
        *names, F.when(F.col(cut).isNull(), literal_text(text)).otherwise(kept).alias("kept"),
        size.cast("long").alias("n_lines"), F.coalesce(F.array_size(cut), F.lit(0)).cast("long").alias("n_dropped"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines, dropped lines and what is left."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeated_lines(docs, "doc_id").select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP11_SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS place
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents) t),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS k
  FROM lines),
held AS (
  SELECT k, min(doc_id) AS first FROM keyed WHERE length(k) >= {LEAST}
  GROUP BY k HAVING count(DISTINCT doc_id) >= {DOCUMENTS}),
judged AS (
  SELECT doc_id, place, line, coalesce(doc_id > first, false) AS gone FROM keyed LEFT JOIN held USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""
