"""Operator 4: near-duplicate vectors by sorted projection passes."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .graph import components
from .jaccard import forest
from .tables import stored, table

PASSES = 8        # sorted orders of all vectors
HASHES = 16       # concatenated hashes of a sort key
FINE = 15         # bits behind them
WINDOW = 2048     # following neighbours that a vector is compared with, at least
BLOCK = 2048      # rows of one comparison block
TILE = 512        # of these are multiplied with the others at once
NEAR = 0.98
SEED = 20240


def usable(vector) -> bool:
    """Whether it can be near to anything: not null, empty or zero, and finite throughout."""
    if vector is None or not len(vector):
        return False
    v = np.array([np.nan if x is None else x for x in vector], np.float64)
    return bool(np.isfinite(v).all() and v.any())


def units(raw: list[bytes], kind: str) -> np.ndarray:
    """Vectors of one length, as stored, at length 1 in double precision."""
    rows = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def sort_keys(rows: np.ndarray, turn: int, hashes: int = HASHES) -> np.ndarray:
    """One sortable 64-bit number a vector: ``hashes`` random projections, the first one the most weighty.

    Each hash is a projection cut into eight steps whose bounds are shifted at random, three bits of the number;
    near vectors share long prefixes, and a pass that cuts between two of them is followed by others
    that cut elsewhere. Long runs of equal steps are sorted by one more projection, in fine steps.
    """
    size = rows.shape[1]
    draw = np.random.default_rng([SEED, turn, size])
    steps = draw.standard_normal((size, hashes))
    levels = np.floor(rows @ steps / 1.6 + draw.random(hashes)).astype(np.int64) + 4
    levels = np.clip(levels, 0, 7)
    key = np.zeros(len(rows), np.int64)
    for h in range(hashes):
        key = key << 3 | levels[:, h]
    fine = np.floor((rows @ draw.standard_normal(size) / 8 + 0.5) * (1 << FINE)).astype(np.int64)
    return key << FINE | np.clip(fine, 0, (1 << FINE) - 1)


def _marked(frame: DataFrame, key: str, vector: str, label: str, kind: str) -> DataFrame:
    """Key, label, the vector's bytes and their digest; no bytes for rows that link with nothing."""

    @F.pandas_udf(T.BinaryType())
    def packed(values: pd.Series) -> pd.Series:
        # Adding 0.0 turns a negative zero into the zero it equals.
        return pd.Series([(np.asarray(v, kind) + 0.0).astype(kind).tobytes() if usable(v) else None for v in values], dtype=object)

    raw = F.when(F.col(label).isNotNull(), packed(F.col(vector)))
    return frame.select(F.col(key).alias("id"), F.col(label).alias("label"), raw.alias("raw")).withColumn(
        "mark", F.when(F.col("raw").isNotNull(), F.sha2("raw", 256)))


def _centres(heads: DataFrame, kind: str) -> DataFrame:
    """``label, size, centre, spread``: mean of a label's vectors of one length, at length 1, and their distance from it on average.

    Vectors that share a direction would fall into the same few steps of all projections.
    """
    label = heads.schema["label"].dataType.simpleString()

    def partial(batches):
        for batch in batches:
            frame = batch.to_pandas()
            for (name, size), group in frame.groupby(["label", frame["raw"].map(len)], sort=False, dropna=False):
                total = units(list(group["raw"]), kind).sum(axis=0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("label").take(pa.array(group.index[:1])), pa.array([size], pa.int32()), pa.array([len(group)], pa.int64()),
                     pa.array([total.tobytes()], pa.binary())], ["label", "size", "n", "total"])

    def whole(frame: pd.DataFrame) -> pd.DataFrame:
        centre = np.sum([np.frombuffer(t) for t in frame["total"]], axis=0) / frame["n"].sum()
        spread = max(1 - centre @ centre, 1e-12) ** 0.5   # since all lengths are 1
        return frame[["label", "size"]].head(1).assign(centre=[centre.tobytes()], spread=[spread])

    return heads.select("label", "raw").mapInArrow(partial, f"label {label}, size int, n long, total binary").groupBy(
        "label", "size").applyInPandas(whole, f"label {label}, size int, centre binary, spread double")


def _windows(rows: DataFrame, heads: DataFrame, window: int, near: float, block: int, kind: str) -> DataFrame:
    """Pairs at ``near`` or more that connect all classes which such pairs within ``window`` places in one pass's order connect."""
    # Ranks without one big sort in a task: rows per sorted part, then a running sum over the parts.
    order = ["turn", "label", "key", "id", "name"]
    ordered = stored(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .select("*", F.monotonically_increasing_id().alias("place")), "ordered")
    part = F.shiftright("place", 33)
    counts = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()
    before, total = [], 0
    for row in sorted(counts, key=lambda r: r["part"]):
        before.append((row["part"], total))
        total += row["n"]
    offsets = rows.sparkSession.createDataFrame(before, "part long, before long")
    ranked = ordered.withColumn("part", part).join(F.broadcast(offsets), "part").withColumn(
        "rank", F.col("before") + F.col("place") - F.shiftleft(F.col("part"), 33))
    number = F.floor(F.col("rank") / block)
    # A block also gets the first rows behind it, which its last rows are compared with.
    least = F.greatest(F.ceil((F.col("rank") - window - block + 1) / block), F.lit(0))
    dealt = ranked.select("rank", "turn", "id", "name", number.alias("number"), F.explode(F.sequence(least, number)).alias("block")).join(
        heads.select("id", "name", "label", "raw"), ["id", "name"]).select(
            "block", (F.col("block") == F.col("number")).alias("own"), "rank", "turn", "label", "id", "raw")

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("rank", ignore_index=True)
        out = [pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})]
        ids, own = frame["id"].to_numpy(), frame["own"].to_numpy()
        sizes = frame["raw"].map(len)
        group = frame.groupby(["turn", "label", sizes], sort=False).ngroup().to_numpy()
        for g in np.unique(group):
            at = np.flatnonzero(group == g)
            rows = units(list(frame["raw"].iloc[at]), kind)
            rough, label = rows.astype(np.float32), np.arange(len(at))
            for start in range(0, int(own[at].sum()), TILE):   # own rows stand first
                stop = min(start + TILE, int(own[at].sum()))
                i, j = np.nonzero(rough[start:stop] @ rough[start:].T >= near - 1e-4)
                i, j = i[i < j] + start, j[i < j] + start
                while len(i := i[rest := label[i] != label[j]]):
                    j = j[rest]
                    a, b, i, j = i[:TILE * 32], j[:TILE * 32], i[TILE * 32:], j[TILE * 32:]
                    sure = np.einsum("ij,ij->i", rows[a], rows[b]) >= near
                    a, b = a[sure], b[sure]
                    label, used = forest(label, a, b)
                    out.append(pd.DataFrame({"a": ids[at[a[used]]], "b": ids[at[b[used]]]}))
        return pd.concat(out)

    return dealt.groupBy("block").applyInPandas(compare, "a long, b long")


def _links_inside(members: DataFrame, near: float, block: int, kind: str) -> DataFrame:
    """For every class of a component, the copies behind all classes of that component at ``near`` or more.

    This counts what the windows were too short for. Small components are compared many to a task; a large one is cut
    into parts, and a task gets two of them. Only counts leave a task, never pairs.
    """
    sizes = members.groupBy("component").agg(F.count("*").alias("size"))
    total = sizes.agg(F.sum("size")).first()[0] or 0
    packs = max(1, total // block)
    cut = F.ceil(F.col("size") / block).cast("int")
    mine = F.pmod(F.xxhash64("id"), F.col("cut")).cast("int")
    each = F.sequence(F.lit(0), F.col("cut") - 1)
    dealt = (
        members.join(sizes, "component").withColumn("cut", cut).withColumn("mine", mine)
        .withColumn("other", F.explode(each))
        .withColumn("pack", F.when(F.col("cut") == 1, F.pmod(F.xxhash64("component"), F.lit(packs))).otherwise(F.col("component")))
        .select("pack", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
                F.col("cut") > 1, "mine", "component", "id", "copies", "raw").toDF(
                    "pack", "i", "j", "large", "mine", "component", "id", "copies", "raw"))

    def count(frame: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"id": np.empty(0, np.int64), "around": np.empty(0, np.int64)})]
        i, j = frame["i"].iloc[0], frame["j"].iloc[0]
        for _, group in frame.groupby(["component", frame["raw"].map(len)], sort=False):
            part = group["mine"].to_numpy()
            sides = [(part == i, part == j)] + ([(part == j, part == i)] if i != j else [])
            rows, copies, ids = units(list(group["raw"]), kind), group["copies"].to_numpy(), group["id"].to_numpy()
            for a, b in sides:
                hits = rows[a] @ rows[b].T >= near
                if i == j:
                    np.fill_diagonal(hits, False)
                out.append(pd.DataFrame({"id": ids[a], "around": hits @ copies[b]}))
        return pd.concat(out)

    counted = dealt.groupBy("pack", "i", "j", "large").applyInPandas(count, "id long, around long")
    return counted.groupBy(F.col("id").alias("head")).agg(F.sum("around").alias("around"))


def near_vectors(frame: DataFrame, key: str, vector: str, label: str, near: float = NEAR,
                 passes: int = PASSES, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """One row per vector: ``n_links``, ``component_id`` and ``kept``. The key is an integer.

    Vectors with equal labels are linked when found at a cosine of ``near`` or more, in double
    precision. Equal vectors are one class, so copies never fill a window and make no pairs; a class
    of k copies links each of them to the k-1 others. Vectors are sorted by where they lie around their label's mean.
    In each of ``passes`` orders a class is compared with
    the ``window`` classes behind it, in blocks; the verified pairs of all passes make the components, and the links
    inside a component are then counted in full. Null labels and vectors that are null, empty, zero or hold null or
    non-finite components link with nothing and are kept. Vectors of different lengths are never linked. The
    search is approximate: it can miss a link between two components, but links none below ``near``.
    """
    kind = "<f4" if "float" in frame.schema[vector].dataType.simpleString() else "<f8"
    rows = stored(_marked(frame, key, vector, label, kind), "vectors")
    # Least key and size of every class: one row a class leaves each task, however many copies.
    classes = stored(
        rows.filter("mark is not null").groupBy("label", "mark")
        .agg(F.min("id").alias("id"), F.count("*").alias("copies")), "classes")
    heads = rows.select("label", "mark", "id", "raw").join(classes, ["label", "mark", "id"]) \
        .dropDuplicates(["label", "mark", "id"]).withColumn("name", F.xxhash64("label", "mark"))
    heads = stored(heads.withColumn("size", F.length("raw")), "heads")

    def keyed(batches):
        for batch in batches:
            values, centres = batch.column("raw").to_pylist(), batch.column("centre").to_pylist()
            sizes = np.array([len(v) for v in values])
            spread = batch.column("spread").to_numpy()
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                some, found = batch.take(pa.array(at)), units([values[i] for i in at], kind)
                found -= np.frombuffer(b"".join(centres[i] for i in at)).reshape(found.shape)
                found /= spread[at, None]
                for turn in range(passes):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), turn, np.int32)), some.column("label"),
                         pa.array(sort_keys(found, turn)), some.column("id"), some.column("name")],
                        ["turn", "label", "key", "id", "name"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    turns = heads.select("id", "name", "label", "size", "raw").join(_centres(heads, kind), ["label", "size"]).mapInArrow(
        keyed, f"turn int, label {kinds['label']}, key long, id {kinds['id']}, name long")
    pairs = _windows(turns, heads, window, near, block, kind)
    joined = stored(components(pairs, "a", "b").select(F.col("node").alias("id"), "component"), "joined")
    members = heads.join(joined, "id").select("component", "id", "copies", "raw")
    around = _links_inside(members, near, block, kind)
    found = (
        classes.withColumnRenamed("id", "head").join(around, "head", "left")
        .join(joined.withColumnRenamed("id", "head"), "head", "left")
        .select("label", "mark", (F.col("copies") - 1 + F.coalesce("around", F.lit(0))).alias("n"),
                F.coalesce("component", "head").alias("c")))
    return (
        rows.select("id", "label", "mark").join(found, ["label", "mark"], "left")
        .select(F.col("id").alias(key), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                F.coalesce("c", "id").cast("long").alias("component_id"))
        .withColumn("kept", F.col(key).eqNullSafe(F.col("component_id"))))


def op4_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding with its links, its group and whether it stays."""
    return near_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
