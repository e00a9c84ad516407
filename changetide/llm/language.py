"""Operator 1: the language of a page or document, by Bayesian fusion of several kinds of evidence."""

from __future__ import annotations

import html as entities

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import frugal, pieces, stored, table, utf8
from .words import _FOLD

BUCKETS = 1 << 14     # hashed byte triples
SMOOTH = 0.5          # added to every count
TEMPER = 0.2          # byte triples overlap, so they count less than independent evidence
LEAN = 5.0            # pages' worth of belief that a host takes from its suffix, and a suffix from all
UNKNOWN = "und"       # text of no known language: every triple as likely as any other
SURE = 0.5            # least belief in a language for a text to be accepted
CHUNK = 1 << 19
_FOLDED = _FOLD.astype(np.int64)
_FOLDED[9:14] = 32
_COUNTS = (_FOLDED == 32) | (_FOLDED >= ord("a")) & (_FOLDED <= ord("z")) | (_FOLDED >= 128)

_LANG = regex.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]+)", regex.I)
_HIDDEN = regex.compile(r"<!--.*?-->|<(script|style)\b.*?</\1\s*>|<[^>]*>", regex.S | regex.I)


def triples(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every byte triple, A-Z as a-z, and the text it lies in; none crosses a border.

    Only letters and blanks count, so numbers, codes and marks say nothing about the language.
    """
    low = _FOLDED[data]
    if len(low) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    bucket = (low[:-2] * 40503 ^ low[1:-1] * 2654435 ^ low[2:] * 97) * 2654435761 >> 15 & BUCKETS - 1
    at = np.flatnonzero(_COUNTS[data[:-2]] & _COUNTS[data[1:-1]] & _COUNTS[data[2:]])
    owner = np.searchsorted(bounds, at, side="right") - 1
    whole = at + 3 <= bounds[owner + 1]
    return bucket[at[whole]], owner[whole]


def learned(frame: DataFrame, text: str, language: str) -> tuple[list[str], np.ndarray]:
    """Languages in order, and the log chance of every bucket in each; the last row is the unknown language.

    Counts cover all rows with a language. One row per language and bucket reaches the driver, whatever the input.
    """

    def work(batches):
        for batch in batches:
            batch = batch.filter(batch.column(language).is_valid())
            found = batch.column(language).dictionary_encode()
            code = found.indices.to_numpy(zero_copy_only=False)
            names = found.dictionary.to_pylist()
            data, bounds = utf8(batch.column(text))
            total = np.zeros((len(names), BUCKETS), np.int64)
            for a, b in pieces(bounds, CHUNK):
                bucket, owner = triples(data[bounds[a]:bounds[b]], bounds[a:b + 1] - bounds[a])
                total += np.bincount(code[a + owner] * BUCKETS + bucket, minlength=total.size).reshape(total.shape)
            row, bucket = np.nonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[i] for i in row], pa.string()), pa.array(bucket), pa.array(total[row, bucket])],
                ["language", "bucket", "n"])

    counts = frame.select(F.col(language).cast("string"), F.col(text)).mapInArrow(
        frugal(work), "language string, bucket long, n long").groupBy("language", "bucket").agg(F.sum("n").alias("n")).toArrow().combine_chunks()
    language_, bucket, n = (counts.column(c) for c in ("language", "bucket", "n"))
    names = sorted(pc.unique(language_).to_pylist())
    row = pc.index_in(language_, value_set=pa.array(names, pa.string()))
    table_ = np.full((len(names) + 1, BUCKETS), SMOOTH)
    np.add.at(table_, (row.to_numpy().astype(np.int64), bucket.to_numpy()), n.to_numpy())
    return names, np.log(table_ / table_.sum(axis=1, keepdims=True))


def page_parts(page: str | None) -> tuple[str | None, str]:
    """The language that a page's markup declares, and the text that a reader sees."""
    if not page:
        return None, ""
    found = _LANG.search(page)
    return (found[1].lower() if found else None), entities.unescape(_HIDDEN.sub(" ", page))


def _likelihoods(frame: DataFrame, text: str, chances: np.ndarray, markup: bool) -> DataFrame:
    """The rows with ``__text`` (tempered log likelihood of the text in each language) and, of pages, ``__declared``."""
    sent = frame.sparkSession.sparkContext.broadcast(np.ascontiguousarray(chances.T * TEMPER))

    def work(batches):
        for batch in batches:
            values, declared = batch.column(text), None
            if markup:
                parts = [page_parts(v.as_py()) for v in values]
                declared = pa.array([p[0] for p in parts], pa.string())
                values = pa.array([p[1] for p in parts], pa.string())
            data, bounds = utf8(values)
            out = np.zeros((batch.num_rows, chances.shape[0]))
            for a, b in pieces(bounds, CHUNK):
                bucket, owner = triples(data[bounds[a]:bounds[b]], bounds[a:b + 1] - bounds[a])
                for k in range(chances.shape[0]):
                    out[a:b, k] = np.bincount(owner, sent.value[:, k][bucket], b - a)
            rest = batch.drop_columns([text])
            yield rest.append_column("__text", pa.array(list(out), pa.list_(pa.float64()))).append_column(
                "__declared", declared if markup else rest.column("__said"))

    rest = [f for f in frame.schema if f.name != text]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest)
    return frame.mapInArrow(frugal(work), f"{schema}, `__text` array<double>, `__declared` string")


def _named(value: Column, use) -> Column:
    """``use`` of a value that then stands once in the expression, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _normed(scores: list[Column]) -> Column:
    """Beliefs from log scores, as an array that sums to 1."""
    odds = _named(F.array(*scores), lambda s: F.transform(s, lambda x: F.exp(x - F.array_max(s))))
    return _named(odds, lambda o: F.transform(o, lambda x: x / F.aggregate(o, F.lit(0.0), lambda a, b: a + b)))


def _sums(rows: DataFrame, by: list[str], size: int) -> DataFrame:
    """Sum of the beliefs by group, as an array; partly summed before the shuffle, so a hot host costs a row a task."""
    return rows.groupBy(*by).agg(F.array(*[F.sum(F.col("__p")[k]) for k in range(size)]).alias("__n"))


def identified(frame: DataFrame, text: str, declared: str | None, host: Column, suffix: Column, names: list[str],
               chances: np.ndarray) -> DataFrame:
    """The rows with ``language``, ``confidence``, ``text_language``, ``declared_language`` and ``accepted``.

    Evidence, each as a likelihood: the text's byte triples; the declared language (the column ``declared``, or the page's
    markup if that is None), by how often each declaration goes with each language; and a prior of the host. The prior is the
    sum of beliefs over the host's other rows, leaning on that of its address suffix, which leans on that of all. Sums are grouped
    aggregations. A row is accepted if a known language has at least ``SURE`` of the belief. A text without letters is judged by
    the other evidence and never accepted; a null host or declaration says nothing. Without any labelled text the language is ``und``.
    """
    every = [*names, UNKNOWN]
    size = len(every)
    kept = [c for c in frame.columns if c not in {"language", "confidence", "text_language", "declared_language", "accepted", text}]
    rows = frame.select(
        *kept, F.col(text).cast("string").alias("__page"), host.alias("__host"), suffix.alias("__suffix"),
        (F.lower(F.col(declared).cast("string")) if declared else F.lit(None).cast("string")).alias("__said"),
        (F.coalesce(F.col(text).rlike("\\p{L}"), F.lit(False)) if declared else F.lit(False)).alias("__letters"))
    rows = _likelihoods(rows, "__page", chances, declared is None).drop("__said")
    scores = [F.col("__text")[k] for k in range(size)]
    rows = stored(rows.withColumn("__p", _normed(scores)), "evidence")
    everyone = _sums(rows, [], size).first()["__n"]
    total = [(x or 0.0) + 1.0 for x in everyone]
    globally = [x / sum(total) for x in total]
    # How likely each declaration is in each language.
    said = stored(_sums(rows.filter("__declared is not null"), ["__declared"], size), "said")
    among = [1.0 + (x or 0.0) for x in _sums(said.withColumnRenamed("__n", "__p"), [], size).first()["__n"]]
    says = said.select("__declared", F.array(*[F.log((F.col("__n")[k] + 0.01) / among[k]) for k in range(size)]).alias("__says"))
    rows = rows.join(says, "__declared", "left")
    first = [scores[k] + F.coalesce(F.col("__says")[k], F.lit(0.0)) for k in range(size)]
    rows = rows.withColumn("__p", _normed(first))
    by_suffix = _sums(rows, ["__suffix"], size).withColumnRenamed("__n", "__ns")
    by_host = _sums(rows.filter("__host is not null"), ["__suffix", "__host"], size).withColumnRenamed("__n", "__nh")
    rows = rows.join(by_suffix, rows["__suffix"].eqNullSafe(by_suffix["__suffix"]), "left").drop(by_suffix["__suffix"])
    same = rows["__suffix"].eqNullSafe(by_host["__suffix"]) & (rows["__host"] == by_host["__host"])
    rows = rows.join(by_host, same, "left").drop(by_host["__suffix"], by_host["__host"])

    def others(name: str, k: int) -> Column:
        return F.greatest(F.coalesce(F.col(name)[k] - F.col("__p")[k], F.lit(0.0)), F.lit(0.0))

    def prior(name: str, above: list[Column]) -> list[Column]:
        seen = [others(name, k) for k in range(size)]
        whole = sum(seen[1:], seen[0])
        return [(seen[k] + LEAN * above[k]) / (whole + LEAN) for k in range(size)]

    of_host = prior("__nh", prior("__ns", [F.lit(x) for x in globally]))
    final = _normed([first[k] + F.log(of_host[k]) for k in range(size)])

    def best(beliefs: Column) -> Column:
        return F.element_at(F.array(*map(F.lit, every)), F.array_position(beliefs, F.array_max(beliefs)).cast("int"))

    language = best(F.col("__final"))
    seen = F.exists("__text", lambda x: x != 0)
    return rows.withColumn("__final", final).select(
        *kept, language.alias("language"), F.array_max("__final").alias("confidence"),
        F.when(seen, best(_normed(scores))).alias("text_language"), F.col("__declared").alias("declared_language"),
        ((seen | F.col("__letters")) & (language != UNKNOWN) & (F.array_max("__final") >= SURE)).alias("accepted"))


def op1_page_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's language; text likelihoods are learned from all documents and their languages."""
    documents = table(spark, sf_dir, "documents")
    names, chances = learned(documents, "text", "lang")
    host = F.nullif(F.regexp_extract(F.lower("url"), r"^[a-z][a-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1), F.lit(""))
    pages = table(spark, sf_dir, "pages").select("page_id", "html", host.alias("host"))
    suffix = F.element_at(F.split("host", r"\."), -1)
    return identified(pages, "html", None, F.col("host"), suffix, names, chances).select(
        "page_id", "host", "language", "confidence", "text_language", "declared_language", "accepted")
