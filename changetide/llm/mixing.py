"""Operator 5: rates at which documents are taken so that their soft domains reach target token totals.

Everything is DataFrame expressions; the driver sees a few numbers per step.
"""

from __future__ import annotations

import warnings

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import stored, table

DOMAINS = ("good", "plain", "toxic")
TARGETS = {"good": 0.7, "plain": 0.3, "toxic": 0.0}   # shares of all tokens
LABELLED = 20_000     # labelled documents that the classifier learns from, at most
BUCKETS = 1 << 16     # hashed words
WEIGHT = 1.0          # log ratios below it say nothing
TEMPER = 0.5          # words of a text are not independent evidence
STEPS, CLOSE = 200, 1e-6
LENGTH = 1e6          # of the gradient step


def _words(text: str) -> Column:
    """The hashed words of a text; none for a null or blank one."""
    parts = F.split(F.lower(F.coalesce(F.col(text).cast("string"), F.lit(""))), "[ \\t\\n\\x0b\\f\\r]+")
    return F.explode(F.filter(parts, lambda w: w != "")).alias("word")


def _bucket() -> Column:
    return F.pmod(F.xxhash64("word"), F.lit(BUCKETS)).cast("int").alias("bucket")


def domain_of() -> Column:
    """Domain of a label row; null where neither label says anything."""
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "plain")


def word_weights(frame: DataFrame, key: str, text: str, labels: DataFrame, labelled: int) -> tuple[DataFrame, dict[str, float]]:
    """Log ratio of every hashed word in each domain against all, and the domains' log shares.

    Learns from the ``labelled`` label rows of the least key hash, so from a number of documents that is bounded.
    """
    chosen = (
        labels.select(F.col("doc_id").alias("__id"), domain_of().alias("domain")).filter("domain is not null and __id is not null")
        .dropDuplicates(["__id"]).orderBy(F.xxhash64("__id"), "__id").limit(labelled))
    chosen = stored(chosen, "labelled")
    share = {r["domain"]: r["n"] for r in chosen.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    total = sum(share.values()) + len(DOMAINS)
    # At most ``labelled`` rows of two columns are sent.
    words = frame.join(F.broadcast(chosen), F.col(key) == F.col("__id")).select("domain", _words(text)).select("domain", _bucket())
    counts = words.groupBy("bucket").pivot("domain", list(DOMAINS)).agg(F.count(F.lit(1))).fillna(0)
    counts = stored(counts, "word_counts")
    sums = counts.agg(*[F.sum(d).alias(d) for d in DOMAINS]).first()
    sums = {d: sums[d] or 0 for d in DOMAINS}
    everything = sum((F.col(d) for d in DOMAINS), F.lit(0.0)) + 1.0
    size = sum(sums.values()) + BUCKETS

    def weight(d: str) -> Column:
        # A domain's frequency leans on the overall one, so rare words say little.
        leaned = (F.col(d) + 20 * everything / size) / F.lit(float(sums[d] + 20))
        ratio = F.log(leaned / (everything / size))
        return F.when(F.abs(ratio) >= WEIGHT, ratio).otherwise(0.0).alias(f"w_{d}")

    weights = counts.select("bucket", *[weight(d) for d in DOMAINS])
    return weights, {d: (share.get(d, 0) + 1) / total for d in DOMAINS}


def posteriors(frame: DataFrame, key: str, text: str, weights: DataFrame, share: dict[str, float]) -> DataFrame:
    """``key``, ``n_tokens`` and ``p_<domain>`` of every text, by naive Bayes on hashed words.

    Keys name documents: rows with equal keys are added up as one document, and null keys are left out.
    """
    # The weights are one row a bucket, so at most BUCKETS rows of a few numbers are sent.
    words = frame.filter(F.col(key).isNotNull()).select(F.col(key), _words(text)).select(key, _bucket())
    sums = words.join(F.broadcast(weights), "bucket", "left").groupBy(key).agg(
        F.count("*").alias("n_tokens"), *[F.sum(F.coalesce(f"w_{d}", F.lit(0.0))).alias(f"w_{d}") for d in DOMAINS])
    score = {d: F.col(f"w_{d}") * TEMPER + F.log(F.lit(share[d])) for d in DOMAINS}
    top = F.greatest(*score.values())
    odds = {d: F.exp(score[d] - top) for d in DOMAINS}
    return sums.select(key, "n_tokens", *[(odds[d] / sum(odds.values(), F.lit(0.0))).alias(f"p_{d}") for d in DOMAINS])


def rates(members: DataFrame, targets: dict[str, float], steps: int = STEPS) -> DataFrame:
    """The rows with ``rate`` >= 0 such that sum(rate * n_tokens * p_d) comes as near ``targets[d]`` tokens as rates can.

    What is least is the sum of squared misses, each divided by its domain's size; among such rates, those nearest to 1 are wanted.
    One projected gradient step of length ``LENGTH`` from rates of 1, against the gradient where it ends, does as much as that many
    short ones. It leaves rate = max(0, 1 - sum of p_d * push_d), so only one push a domain is searched, by Newton's method: a try needs
    one aggregation of a few numbers, and the rates stay distributed. It ends when the misses are those of the end to ``CLOSE`` of
    each domain's own size; if ``steps`` don't suffice, a warning tells by how much.
    """
    members = stored(members, "members")
    n = F.col("n_tokens")
    first = members.agg(*[F.sum(n * F.col(f"p_{d}")).alias(d) for d in DOMAINS]).first()
    size = np.array([max(first[d] or 0.0, 1.0) for d in DOMAINS])
    target = np.array([targets.get(d, 0.0) for d in DOMAINS])

    def rate_of(push) -> Column:
        return F.greatest(F.lit(1.0) - sum((F.col(f"p_{d}") * F.lit(float(x)) for d, x in zip(DOMAINS, push)), F.lit(0.0)), F.lit(0.0))

    def tried(push):
        """What is to be least, its slope and its curvature, by push."""
        taken = members.select("n_tokens", *[f"p_{d}" for d in DOMAINS], rate_of(push).alias("rate"))
        pairs = [(i, j) for i in range(len(DOMAINS)) for j in range(i, len(DOMAINS))]
        own = [F.col(f"p_{d}") for d in DOMAINS]
        sums = taken.agg(
            F.sum(n * F.col("rate") * F.col("rate")), *[F.sum(n * F.col("rate") * p) for p in own],
            *[F.sum(F.when(F.col("rate") > 0, n * own[i] * own[j]).otherwise(0.0)) for i, j in pairs]).first()
        sums = [x or 0.0 for x in sums]
        bent = np.zeros((len(DOMAINS), len(DOMAINS)))
        for (i, j), x in zip(pairs, sums[len(DOMAINS) + 1:]):
            bent[i, j] = bent[j, i] = x
        value = sums[0] / 2 + target @ push + size @ push ** 2 / (2 * LENGTH)
        return value, target - np.array(sums[1:len(DOMAINS) + 1]) + size * push / LENGTH, np.diag(size) / LENGTH + bent

    push = np.zeros(len(DOMAINS))
    value, slope, bent = tried(push)
    for _ in range(steps):
        if (np.abs(slope) <= CLOSE * size).all():
            break
        way = -np.linalg.solve(bent, slope)
        part = 1.0
        while True:   # a shorter way if this one leads up; rounding of the sums is no way up
            now = tried(push + part * way)
            if now[0] <= value + 1e-4 * part * (slope @ way) + 1e-12 * abs(value) or part < 1e-6:
                break
            part /= 2
        push, (value, slope, bent) = push + part * way, now
    else:
        warnings.warn(f"rates are not final after {steps} steps: still off by {dict(zip(DOMAINS, slope.tolist()))} tokens", stacklevel=2)
    return members.withColumn("rate", rate_of(push))


def copies_of(rate: str, key: str) -> Column:
    """Whole copies of a document: its rate, rounded up or down by a hash of its key so that totals hold on average."""
    draw = F.pmod(F.xxhash64(F.lit("copies"), F.col(key)), F.lit(1 << 30)) / float(1 << 30)
    return (F.floor(rate) + (draw < F.col(rate) - F.floor(rate)).cast("long")).cast("long")


def mix(frame: DataFrame, key: str, text: str, labels: DataFrame, shares: dict[str, float] | None = None,
        labelled: int = LABELLED) -> DataFrame:
    """``key``, ``n_tokens``, ``p_<domain>``, ``rate`` and ``copies`` of every document with words.

    ``shares`` are the domains' wanted shares of all tokens. None asks for no toxic tokens and leaves the other domains
    as large as they are. Texts that are null or blank hold no tokens and get rate 1 and the domains' shares as p. With no usable labels every
    document gets the same p, and rates differ only by what the targets ask. Repeated keys are one document; null keys are left out.
    """
    frame = frame.select(key, text)
    weights, share = word_weights(frame, key, text, labels, labelled)
    found = stored(posteriors(frame, key, text, stored(weights, "weights"), share), "posteriors")
    totals = found.agg(*[F.sum(F.col("n_tokens") * F.col(f"p_{d}")).alias(d) for d in DOMAINS]).first()
    now = {d: totals[d] or 0.0 for d in DOMAINS}
    targets = {d: sum(now.values()) * shares.get(d, 0.0) for d in DOMAINS} if shares else now | {"toxic": 0.0}
    rated = rates(found, targets)
    blank = (
        frame.filter(F.col(key).isNotNull()).select(key).distinct().join(found.select(key), key, "left_anti")
        .select(key, F.lit(0).cast("long").alias("n_tokens"), *[F.lit(share[d]).alias(f"p_{d}") for d in DOMAINS], F.lit(1.0).alias("rate")))
    return rated.select(key, "n_tokens", *[f"p_{d}" for d in DOMAINS], "rate").unionByName(blank).withColumn(
        "copies", copies_of("rate", key))


def op5_mixed_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's domains and the rate at which it is taken."""
    return mix(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "labels"), TARGETS)
