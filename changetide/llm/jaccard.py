"""Operator 8: exact Jaccard join of word shingles in metric space.

Jaccard distance is a metric on finite sets, and so is the Hamming distance of their parity sketches, which
never exceeds the number of elements that two sets differ in. The join uses both:

1. The first pivots are sets of shingles: every document's set is cut into so many parts that two linked
   documents agree in at least one whole part. A document is a member of the region of each of its parts.
   Linked documents even agree in some number of parts, so a document that meets others in fewer regions than that is no member.
2. A region that is too large is cut again: documents are drawn
   as pivots, each member goes to its nearest pivot's cell, and the triangle inequality says which others
   it must be copied to, so that no pair is lost. Cells are cut again in the same way; a cell that does not shrink is
   joined block by block. Inside a small cell, members are sorted by their distance to a pivot and compared by sketches
   within the window that the triangle inequality leaves.
3. Of the pairs that pass in a cell, a forest that connects the same members is checked on whole sets: at most
   one pair a member, however many are alike. Where a pair of the forest turns out not to be connected, all the
   cell's pairs between different groups are checked that meet in as many regions as linked ones do.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .graph import components
from .tables import discarded, frugal, mixed, pieces, small_batches, stored, table, temporary, utf8
from .words import shingle_sets

WORDS, PERCENT = 3, 90
SKETCH = 16       # 64-bit words of a sketch; sets of some thousand elements still differ in it
LEAF = 8192       # rows of a region that one task compares
PIVOTS = 8        # documents that cut a larger one
LEVELS = 3        # cuts, before the rest is joined in blocks
SPREAD = 2        # cells that a member may be in on average, for a cut to be worth it
CHUNK = 1 << 19   # bytes of text looked at together
FILTER_BITS = 1 << 24


def bands(percent: int, largest: int) -> np.ndarray:
    """Upper sizes of bands: a set of one band links only with sets of its own, the next or the last one."""
    upper = [1]
    while upper[-1] < largest:
        upper.append(max(upper[-1] + 1, upper[-1] * 100 // percent))
    return np.array(upper + [max(upper[-1] + 1, upper[-1] * 100 // percent)], np.int64)


def most_different(total: np.ndarray, percent: int) -> np.ndarray:
    """Elements in which two linked sets of ``total`` elements together can differ."""
    return total * (100 - percent) // (100 + percent)


def spare_parts(upper: np.ndarray, percent: int) -> np.ndarray:
    """Parts that a set of a band is cut into beyond those needed for one to agree: twice the empty ones expected.

    The fewest elements are those of a set two bands below its band's upper size.
    """
    parts = most_different(2 * upper, percent) + 1
    return (2 * parts * np.exp(-upper * (percent / 100) ** 2 / parts)).astype(np.int64)


def with_parity(region: np.ndarray, odd) -> np.ndarray:
    """Names of regions with a last bit that tells whether their band is odd; what they are cut into keeps it."""
    return region & np.int64(-2) | odd


class Sets:
    """Shingle sets of a run of texts: the elements, where each set begins, sizes, identities, sketches."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, words: int):
        self.elements, self.first = shingle_sets(data, bounds, words)
        self.sizes = np.diff(self.first)
        self.owner = np.repeat(np.arange(len(self.sizes)), self.sizes)
        sums = np.zeros((len(self.sizes), 2), np.uint64)
        with np.errstate(over="ignore"):
            np.add.at(sums[:, 0], self.owner, self.elements)
            np.bitwise_xor.at(sums[:, 1], self.owner, mixed(self.elements, 11))
            self.names = mixed(mixed(sums[:, 0] + self.sizes.astype(np.uint64), 12) ^ sums[:, 1], 13).view(np.int64)

    def sketches(self) -> np.ndarray:
        """Parities of hashed shares of a set: two sets' sketches differ in no more bits than the sets in elements."""
        bits = (mixed(self.elements, 5) & np.uint64(64 * SKETCH - 1)).astype(np.int64)
        out = np.zeros((len(self.sizes), SKETCH), np.uint64)
        np.bitwise_xor.at(out, (self.owner, bits >> 6), np.uint64(1) << (bits & 63).astype(np.uint64))
        return out

    def _dealt(self, percent: int, odd: int):
        """For each set the one of its own band and the next that is odd or even, with its spare parts; for each part its set, its place
        and whether it is empty; and the part of each element."""
        upper = bands(percent, int(self.sizes.max()))
        own = np.searchsorted(upper, self.sizes)
        band = own + ((own ^ odd) & 1)
        spare = spare_parts(upper[band], percent)
        parts = np.where(self.sizes > 0, most_different(2 * upper[band], percent) + 1 + spare, 0)
        begin = np.concatenate([[0], np.cumsum(parts)])
        at = begin[self.owner] + (mixed(self.elements, 3) % parts[self.owner].astype(np.uint64)).astype(np.int64)
        owner = np.repeat(np.arange(len(parts)), parts)
        empty = np.bincount(at, minlength=begin[-1]) == 0
        return band, spare, owner, np.arange(begin[-1]) - begin[owner], empty, at

    def regions(self, percent: int, parities: tuple[int, ...] = (0, 1)) -> tuple[np.ndarray, np.ndarray]:
        """Region and set of every part, in the set's own band and the next. A region is odd if its band is.

        Two linked sets agree in more parts than there are spare ones. So one of these has elements unless both sets
        have more empty parts than spare ones, and only such a set is a member of its empty parts' regions.
        """
        if not len(self.elements):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        keys, sets = [], []
        for odd in parities:
            band, spare, owner, place, empty, at = self._dealt(percent, odd)
            sums = np.zeros(len(owner), np.uint64)
            use = ~empty | (np.bincount(owner[empty], minlength=len(spare)) > spare)[owner]
            with np.errstate(over="ignore"):
                np.add.at(sums, at, mixed(self.elements, 4))
                where = mixed(place.astype(np.uint64) + (band[owner].astype(np.uint64) << np.uint64(32)), 6)
                keys.append(with_parity(mixed(sums ^ where).view(np.int64)[use], odd))
            sets.append(owner[use])
        return np.concatenate(keys), np.concatenate(sets)

    def least_shared(self, percent: int) -> np.ndarray:
        """How many regions a set shares at least with any one that it links with, if both have parts in its even band; and in its odd one.

        Of the parts that two linked sets agree in, more than the spare ones, each set's empty ones at most have no elements.
        """
        least = np.ones((2, len(self.sizes)), np.int64)
        if len(self.elements):
            for odd in (0, 1):
                _, spare, owner, _, empty, _ = self._dealt(percent, odd)
                least[odd] = np.maximum(1, spare + 1 - np.bincount(owner[empty], minlength=len(spare)))
        return least


def _runs(batch: pa.RecordBatch, text: str, words: int):
    data, bounds = utf8(batch.column(text))
    for a, b in pieces(bounds, CHUNK):
        yield a, b, Sets(data[bounds[a]:bounds[b]], bounds[a:b + 1] - bounds[a], words)


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def shingled(frame: DataFrame, key: str, text: str, words: int, percent: int) -> DataFrame:
    """``id``, size ``n``, identity ``name`` (null for an empty set), ``sketch``, and ``even`` and ``odd``, the least shared regions, of each text's set.

    Equal sets have equal names; different ones share a 64-bit name with negligible chance.
    """

    def work(batches):
        for batch in batches:
            for a, b, sets in _runs(batch, text, words):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(key).slice(a, b - a), pa.array(sets.sizes, pa.int64()),
                     pa.array(sets.names, pa.int64(), mask=sets.sizes == 0), _binary(sets.sketches()),
                     *map(pa.array, sets.least_shared(percent))],
                    ["id", "n", "name", "sketch", "even", "odd"])

    kind = frame.schema[key].dataType.simpleString()
    return frame.select(key, text).mapInArrow(frugal(work), f"id {kind}, n long, name long, sketch binary, even long, odd long")


def _members(frame: DataFrame, text: str, words: int, percent: int, odd: int) -> DataFrame:
    """``region`` and ``name`` for the regions of two or more different sets, in odd or even bands: one half of all parts."""

    def parts(batches):
        for batch in batches:
            for _, _, sets in _runs(batch, text, words):
                keys, owner = sets.regions(percent, (odd,))
                # Copies met together count once.
                _, once = np.unique(sets.names, return_index=True)
                use = np.isin(owner, once)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[use]), pa.array(sets.names[owner[use]])], ["region", "name"])

    def several(batches):
        """Rows come sorted by region and name; a region may go on in the next batch."""
        held, least, told = None, None, False
        for batch in batches:
            region, name = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("region", "name"))
            if not len(region):
                continue
            if held is not None and region[0] == held:
                region, name = np.concatenate([[held], region]), np.concatenate([[least], name])
                again = told
            else:
                again = False
            new = np.ones(len(region), bool)
            new[1:] = (region[1:] != region[:-1]) | (name[1:] != name[:-1])
            region, name = region[new], name[new]
            start = np.ones(len(region), bool)
            start[1:] = region[1:] != region[:-1]
            at = np.flatnonzero(start)
            size = np.diff(np.append(at, len(region)))
            use = np.repeat(size > 1, size)
            if again:
                use[0] = False
                use[1:size[0]] = True
            last = len(at) - 1
            held, least = region[at[last]], name[at[last]]
            told = bool(size[last] > 1) or (again and last == 0)
            yield pa.RecordBatch.from_arrays([pa.array(region[use]), pa.array(name[use])], ["region", "name"])

    keyed = frame.select(text).mapInArrow(frugal(parts), "region long, name long")
    return keyed.repartition("region").sortWithinPartitions("region", "name").mapInArrow(
        frugal(several), "region long, name long")


def _linkable(members: DataFrame, classes: DataFrame, least: str) -> DataFrame:
    """The members, all in odd or all in even bands, without sets that meet others in fewer regions than a link takes."""
    met = members.groupBy("name").agg(F.count("*").alias("met")).join(classes.select("name", least), "name")
    return members.join(met.filter(F.col("met") >= F.col(least)).select("name"), "name", "left_semi").select("region", "name")


def _linkable_pairs(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Of all pairs in all regions, the ones that meet in as many as a link of both ends takes, in their odd or in their even bands.

    Texts without any likeness meet in a few regions by what is common to many, and sketches of long ones let them all through.
    """
    is_odd = F.col("region").bitwiseAND(F.lit(1)) == 1
    met = pairs.groupBy("a", "b", is_odd.alias("is_odd")).agg(F.count("*").alias("met"))
    for c in ("a", "b"):
        met = met.join(classes.select(F.col("name").alias(c), F.col("even").alias(f"even_{c}"), F.col("odd").alias(f"odd_{c}")), c)
    least = F.when(F.col("is_odd"), F.greatest("odd_a", "odd_b")).otherwise(F.greatest("even_a", "even_b"))
    return met.filter(F.col("met") >= least).select("a", "b")


def _verified(pairs: DataFrame, documents: DataFrame, named: DataFrame, key: str, text: str, words: int, percent: int) -> DataFrame:
    """The pairs of names whose whole sets are near enough; sets are made again for these documents only."""
    pairs = stored(pairs.distinct(), "candidates")
    wanted = pairs.select(F.col("a").alias("name")).union(pairs.select("b")).distinct()
    # A bitmap of fixed size keeps most other texts from being sent at all; the join then decides.
    bit = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS))
    set_bits = named.join(wanted, "name").groupBy(F.shiftright(bit, 5).alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 32).cast("int"))).alias("m")).collect()
    bitmap = np.zeros(FILTER_BITS // 32, np.uint32)
    for row in set_bits:
        bitmap[row["w"]] = row["m"]
    sent = documents.sparkSession.sparkContext.broadcast(bitmap)

    def sets_of(batches):
        seen = sent.value
        for batch in batches:
            where = batch.column("bit").to_numpy(zero_copy_only=False)
            hit = (seen[where >> 5] >> (where & 31).astype(np.uint32)) & np.uint32(1) == 1
            some = batch.filter(pa.array(hit))
            for _, _, sets in _runs(some, text, words) if some.num_rows else ():
                raw = [sets.elements[i:j].tobytes() for i, j in zip(sets.first, sets.first[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sets.names), pa.array(raw, pa.large_binary()).cast(pa.binary())], ["name", "items"])

    # Sets are the bulk of what is sent: they go by name once, and both joins read them there.
    items = (
        documents.select(key, text, F.pmod(F.xxhash64(key), F.lit(FILTER_BITS)).alias("bit"))
        .filter(F.col(key).isNotNull()).mapInArrow(frugal(sets_of), "name long, items binary").dropDuplicates(["name"]))
    both = (
        pairs.join(items.toDF("a", "x"), "a").join(items.toDF("b", "y"), "b").select("a", "b", "x", "y"))

    def check(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(frugal(check), "a long, b long")


def _cut(rows: DataFrame, sizes: DataFrame, level: int, percent: int) -> DataFrame:
    """Members of large regions with ``cells``: their nearest pivot's, and all others that their window reaches."""
    joined = rows.join(sizes, "region")
    drawn = F.pmod(F.xxhash64("name", F.lit(level)), F.ceil(F.col("size") / PIVOTS)) == 0
    pivots = joined.groupBy("region").agg(
        F.collect_list(F.when(drawn, F.col("sketch"))).alias("drawn"), F.min("sketch").alias("one")
    ).select("region", F.concat(F.array("one"), F.col("drawn")).alias("pivots"))

    def cells(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            own = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint64).reshape(-1, SKETCH)
            n = batch.column("n").to_numpy(zero_copy_only=False)
            region = batch.column("region").to_numpy(zero_copy_only=False).view(np.uint64)
            reached = []
            for i, found in enumerate(batch.column("pivots").to_pylist()):
                marks = np.frombuffer(b"".join(found), np.uint64).reshape(-1, SKETCH)
                apart = np.bitwise_count(marks ^ own[i]).sum(axis=1).astype(np.int64)
                reach = np.flatnonzero(apart <= apart.min() + 2 * (n[i] * (100 - percent) // percent))
                inner = mixed(region[i] ^ mixed(reach.astype(np.uint64), level + 20)).view(np.int64)
                reached.append(with_parity(inner, int(region[i]) & 1))
            out = batch.select(["region", "name", "n", "sketch", "component"])
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array(reached, pa.list_(pa.int64()))], [*out.schema.names, "cells"])

    return rows.join(pivots, "region").mapInArrow(
        frugal(cells), "region long, name long, n long, sketch binary, component long, cells array<long>")


def _blocks(rows: DataFrame, sizes: DataFrame, leaf: int) -> DataFrame:
    """Members of regions that do not shrink, in pairs of blocks: every two rows meet in one of them."""
    joined = rows.join(sizes, "region")
    many = F.ceil(F.col("size") * 2 / leaf).cast("int")
    mine = F.pmod(F.xxhash64("name", F.lit("block")), many)
    other = F.explode(F.sequence(F.lit(0), many - 1))
    paired = joined.withColumn("mine", mine).withColumn("other", other)
    region = F.xxhash64("region", F.least("mine", "other"), F.greatest("mine", "other")).bitwiseAND(F.lit(-2)).bitwiseOR(
        F.col("region").bitwiseAND(F.lit(1)))
    return paired.select(region.alias("region"), "name", "n", "sketch", "component")


def forest(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """New labels of members that pairs connect, and which pairs were needed: never more than labels that went."""
    used = []
    left = np.arange(len(a))
    while True:
        x, y = label[a[left]], label[b[left]]
        left, x, y = (v[x != y] for v in (left, x, y))
        if not len(left):
            return label, np.concatenate([*used, left])
        low, high = np.minimum(x, y), np.maximum(x, y)
        order = np.lexsort((low, high))
        order = order[np.append(True, np.diff(high[order]) > 0)]
        used.append(left[order])
        root = np.arange(len(label))
        root[high[order]] = low[order]
        while (root != root[root]).any():
            root = root[root]
        label = root[label]


def _leaf_pairs(rows: DataFrame, percent: int, thin: bool) -> DataFrame:
    """``region, a, b``: pairs of different components in small regions that sizes, pivot windows and sketches let through.

    ``thin``: only a forest of them, which connects the same members of the region as all of them.
    """

    def pairs_of(region, name, n, sketch, component):
        start = np.flatnonzero(np.append(True, region[1:] != region[:-1]))
        lead = np.repeat(sketch[start], np.diff(np.append(start, len(region))), axis=0)
        far = np.bitwise_count(sketch ^ lead).sum(axis=1).astype(np.int64)
        order = np.lexsort((far, region))
        region, name, n, sketch, component, far = (x[order] for x in (region, name, n, sketch, component, far))
        # Labels are places of rows; members of one component in one region share theirs.
        order = np.lexsort((component, region))
        first = np.append(True, (np.diff(region[order]) != 0) | (np.diff(component[order]) != 0))
        label = np.empty(len(region), np.int64)
        label[order] = order[np.flatnonzero(first)][np.cumsum(first) - 1]
        out = []

        def compare(label, i, j):
            fits = (label[i] != label[j]) & (np.minimum(n[i], n[j]) * 100 >= np.maximum(n[i], n[j]) * percent)
            a, b = i[fits], j[fits]
            near = np.bitwise_count(sketch[a] ^ sketch[b]).sum(axis=1) <= most_different(n[a] + n[b], percent)
            a, b = a[near], b[near]
            if thin:
                label, kept = forest(label, a, b)
                a, b = a[kept], b[kept]
            out.append((a, b))
            return label

        i, step = np.arange(len(region)), 1
        if thin:   # the pivots first, since these connect most of a group
            label = compare(label, np.repeat(start, np.diff(np.append(start, len(region)))), i)
        while True:
            i = i[i + step < len(region)]
            j = i + step
            # Sorted by distance to the pivot: once the window is passed, all later rows are out of it.
            i = i[(region[i] == region[j]) & (far[j] - far[i] <= n[i] * (100 - percent) // percent)]
            if not len(i):
                break
            label = compare(label, i, i + step)
            step += 1
        a, b = (np.concatenate([pair[k] for pair in out] + [np.empty(0, np.int64)]) for k in (0, 1))
        where, a, b = region[a], name[a], name[b]
        return pa.RecordBatch.from_arrays(
            [pa.array(where), pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["region", "a", "b"])

    def work(batches):
        rest = None   # the last region, which may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("region", "name", "n", "component")]
            now.append(np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint64).reshape(-1, SKETCH))
            if rest is not None:
                now = [np.concatenate([x, y]) for x, y in zip(rest, now)]
            cut = np.searchsorted(now[0], now[0][-1])
            rest = [x[cut:] for x in now]
            if cut:
                region, name, n, component, sketch = (x[:cut] for x in now)
                yield pairs_of(region, name, n, sketch, component)
        if rest is not None:
            region, name, n, component, sketch = rest
            yield pairs_of(region, name, n, sketch, component)

    return rows.repartition("region").sortWithinPartitions("region", "name").mapInArrow(frugal(work), "region long, a long, b long")


def _leaves(rows: DataFrame, percent: int, leaf: int, levels: int) -> DataFrame:
    """The rows dealt to regions small enough for one task: every two rows of a region that can link meet in one."""
    found = None
    for level in range(levels + 1):
        sizes = rows.groupBy("region").agg(F.count("*").alias("size"))
        large = stored(sizes.filter(F.col("size") > leaf), "large")
        none_large = large.isEmpty()
        small = rows if none_large else rows.join(large, "region", "left_anti")
        found = small if found is None else found.union(small)
        if none_large:
            return found
        kept = rows.join(large.select("region"), "region", "left_semi")
        if level == levels:
            return found.union(_blocks(kept, large, leaf))
        cells = stored(_cut(kept, large, level, percent), "cells")
        # Where windows reach nearly all cells, a cut only multiplies rows; such a region goes to blocks at once.
        spread = cells.groupBy("region").agg((F.sum(F.size("cells")) <= SPREAD * F.count("*")).alias("worth"))
        cut = cells.join(stored(spread, "spread"), "region")
        found = found.union(_blocks(cut.filter("not worth").drop("worth", "cells"), large, leaf))
        rows = cut.filter("worth").withColumn("region", F.explode("cells")).drop("worth", "cells").dropDuplicates(["region", "name"])
    return found


def near_sets(frame: DataFrame, key: str, text: str = "text", words: int = WORDS, percent: int = PERCENT,
              leaf: int = LEAF, levels: int = LEVELS) -> DataFrame:
    """``key``, ``n_shingles`` and ``component_id`` of every row; the key is an integer.

    A text's set holds its distinct shingles of ``words`` words (blanks and 0x09 to 0x0D part words, A-Z count as
    a-z); a text with fewer words is one shingle, a null or blank one has none and links with nothing. Two
    rows link when 100 * shared >= ``percent`` * together. The component is the least key reachable by links.
    Equal sets are one class from the start, so copies cost one row each. Repeated rows and keys are allowed; rows
    with a null key get the least key of their class, or null.
    """
    documents = frame.select(key, text)
    # Texts and pairs of whole sets are wide.
    with small_batches(frame.sparkSession):
        named = stored(shingled(documents, key, text, words, percent), "named")
        classes = stored(
            named.filter("name is not null").groupBy("name")
            .agg(F.min("id").alias("id"), *(F.first(c).alias(c) for c in ("n", "sketch", "even", "odd"))), "classes")
        # Only keys and their components outlive the search.
        id_of = classes.select("name", "id")
        with temporary(frame.sparkSession):
            # Parts are the most rows of all, so they are sent in two halves; sketches go only where a link is possible.
            halves = []
            for odd, least in enumerate(("even", "odd")):
                met = stored(_members(documents, text, words, percent, odd), "met")
                halves.append(stored(_linkable(met, classes, least), "members"))
                discarded(met)
            members = halves[0].union(halves[1])

            # A class without a key is no end of a link.
            rows = members.join(classes.filter("id is not null").select("name", "n", "sketch"), "name").select(
                "region", "name", "n", "sketch", F.col("name").alias("component"))
            leaves = _leaves(rows, percent, leaf, levels)
            thin = stored(_leaf_pairs(leaves, percent, True), "forest")
            links = stored(_verified(thin.select("a", "b"), documents, classes, key, text, words, percent), "links")
            grouped = stored(components(links, "a", "b").join(id_of, F.col("node") == F.col("name")).select("node", "component", "id"), "grouped")
            # From names to keys: a class's key is its least, so the least of a component is the least of all its rows.
            keyed = grouped.join(grouped.groupBy("component").agg(F.min("id").alias("u")), "component").select("u", F.col("id").alias("v"))
            # Where the ends of all pairs of the forest are in one component, so are those of all other pairs.
            side = lambda c: grouped.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}"))
            apart = stored(thin.join(side("a"), "a", "left").join(side("b"), "b", "left").filter(
                F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("region").distinct(), "apart")
            if not apart.isEmpty():
                rest = leaves.join(apart, "region", "left_semi").drop("component").join(
                    side("name"), "name", "left").select(
                    "region", "name", "n", "sketch", F.coalesce("of_name", "name").alias("component"))
                rest_pairs = _linkable_pairs(_leaf_pairs(rest, percent, False), classes)
                more = _verified(rest_pairs, documents, classes, key, text, words, percent)
                keyed = keyed.union(more.join(id_of.toDF("a", "u"), "a").join(id_of.toDF("b", "v"), "b").select("u", "v"))
            # Classes may share a key.
            joined = stored(components(keyed, "u", "v").select(F.col("node").alias("id"), "component"), "joined", keep=True)
    final = id_of.join(joined, "id", "left").select("name", F.coalesce("component", "id").alias("component_id"))
    return named.select("id", "n", "name").join(final, "name", "left").select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the size of its set and its group."""
    return near_sets(table(spark, sf_dir, "documents"), "doc_id")
