"""Line dedup, fill-in-middle and vector codes against plain versions, with nulls, empty and long texts, ties and copies."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from changetide.llm.codes import BOUND, assign, books_digest, scaled, shifts, with_codes
from changetide.llm.infill import FOUND, rearranged, rebuilt, restored, with_infill
from changetide.llm.lines import without_repeated_lines
from changetide.llm.tables import joined_by_key, stored

BLANK = " \t\n\x0b\x0c\r"
CLASHING = "doc_id long, text string, kept string, mark string, cut long, lines int, digest int, n int, form string, output string"


def lower(text):
    return text.translate({c: c + 32 for c in range(65, 91)})


def texts(seed=5):
    draw = random.Random(seed)
    pool = ["".join(draw.choice("abcdeÉé ") for _ in range(draw.randint(0, 24))) for _ in range(40)]
    made = []
    for _ in range(70):
        lines = [draw.choice(pool) for _ in range(draw.randint(0, 30))]
        made.append("\n".join(draw.choice(["{}", " {}\t", "{}\r", "\x0b{}\x0c"]).format(x.upper() if draw.random() < .3 and x.isascii() else x)
                              for x in lines))
    made += [None, "", "\n", "\n\n", "exactly 10", "Exactly 10 ", "only nine", "only nine", "ÀÀÀÀÀÀÀÀÀÀ", "àààààààààà", "ÀÀÀÀÀÀÀÀÀÀ\n\x85ÀÀÀÀÀÀÀÀÀÀ",
             "a line that stands in long text\n" * 60_000, "x" * 2_000_000, made[3], made[3], "has <S> inside\nand more", "<P\n>", "<\n<S\n<M"]
    return made


@pytest.fixture(scope="module")
def rows():
    return [(i * 7 % 1000 - 20, t) for i, t in enumerate(texts())]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(k, t, "kept", "mark", 1, 2, 3, 4, "form", "out") for k, t in rows], CLASHING).repartition(6)


def deduped(rows, least=10, documents=2):
    """``{(key, text): (lines, dropped, kept)}`` by a plain walk; rows with one key are one document."""
    def key(line):
        return lower(line.strip(BLANK))

    holders = {}
    for k, t in rows:
        for line in (t or "").split("\n"):
            if k is not None and len(key(line)) >= least:
                holders.setdefault(key(line), set()).add(k)
    found = {}
    for k, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines
                if k is None or len(held := holders.get(key(x), ())) < documents or k == min(held)]
        found[k, t] = (len(lines), len(lines) - len(stay), "\n".join(stay))
    return found


def test_lines_of_other_documents_go(docs, rows):
    for least, documents in [(10, 2), (1, 2), (4, 5)]:
        found = without_repeated_lines(docs, "doc_id", least=least, documents=documents).collect()
        want = deduped(rows, least, documents)
        assert {(r["doc_id"], r["text"]): (r["n_lines"], r["n_dropped"], r["kept"]) for r in found} == want
        assert len(found) == len(rows)
    assert (found[0]["mark"], found[0]["cut"], found[0]["lines"], found[0]["digest"]) == ("mark", 1, 2, 3)


def test_lines_of_rows_that_share_a_key_or_have_none(spark):
    line, other = "a line that repeats", "another line that does"
    rows = [(None, line), (None, line), (3, line), (3, f"{other}\n{line}"), (3, line), (9, f"x\n{line}\n{line}\ny"), (1, other), (12, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = without_repeated_lines(frame, "doc_id").collect()
    assert sorted(((r["doc_id"], r["text"]), (r["n_lines"], r["n_dropped"], r["kept"])) for r in found if r["doc_id"]) == sorted(
        (row, deduped(rows)[row]) for row in rows if row[0])
    assert [r["kept"] for r in found if r["doc_id"] is None] == [line, line]
    assert {(r["doc_id"], r["text"]): r["kept"] for r in found}[9, rows[5][1]] == "x\ny"
    words = frame.filter("doc_id is not null").withColumn("doc_id", F.lpad(F.col("doc_id").cast("string"), 3, "0"))
    assert without_repeated_lines(words, "doc_id").agg(F.sum("n_dropped")).first()[0] == 3
    assert without_repeated_lines(frame.limit(0), "doc_id").count() == 0


def test_hot_keys_meet_their_facts(spark):
    rows = stored(spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(
        F.col("id").cast("string")).alias("k"), "id"), "rows")
    facts = stored(rows.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("least")), "facts")
    for share in (1, 2, 1000, 10**9):
        found = {r["id"]: (r["k"], r["n"], r["least"]) for r in joined_by_key(rows, facts, "k", "n", share).collect()}
        assert found == {i: (("hot", 1000, 0), (None, 1000, 1), (str(i), 1, i))[i % 3] for i in range(3000)}
    some = stored(facts.filter("k = 'hot'"), "some")
    assert joined_by_key(rows, some, "k", "n").count() == 1000


def infilled(key, text, seed=7, rate=100, spm_rate=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    if h[3] % 100 < spm_rate:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_texts_are_rearranged_and_rebuilt(docs, rows):
    for options in ({}, {"seed": 11, "rate": 40, "spm_rate": 10}):
        found = restored(with_infill(docs, "doc_id", **options), into="kept").collect()
        assert sorted((r["doc_id"], r["text"] or "", *(r[c] for c in FOUND)) for r in found) == sorted(
            (k, t or "", *infilled(k, t, **options)) for k, t in rows)
        assert all(r["kept"] == (r["text"] or "") and r["mark"] == "mark" for r in found)
        assert len({r["form"] for r in found}) == 3
    assert found[0].asDict().keys() == {*docs.columns, *FOUND}


def test_keys_without_value_or_of_text_and_empty_tables(spark):
    frame = spark.createDataFrame([(None, "a\nb"), (None, "a\nb"), ("k", "c\n\nd\n")], "id string, text string")
    found = with_infill(frame, "id").collect()
    assert [tuple(r[c] for c in FOUND) for r in found] == [infilled(r["id"], r["text"]) for r in found]
    assert with_infill(frame.limit(0), "id").count() == 0 == restored(with_infill(frame.limit(0), "id")).count()


def test_marks_that_texts_nearly_make(spark):
    draw = random.Random(4)
    texts = ["".join(draw.choice("<PSM>\n") for _ in range(draw.randint(1, 12))) for _ in range(4000)]
    hashes = [pa.array([draw.randrange(2**32) for _ in texts], pa.int64()) for _ in range(4)]
    found = rearranged(pa.array(texts), hashes)
    assert rebuilt(found.column(4), found.column(1)).to_pylist() == texts
    assert found.column(1).to_pylist().count("plain") < 4000


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """``key, label, code, error`` and codebooks, with Python's integers."""
    kept = [(k, [int(np.floor(4096 * np.float64(x))) for x in v], lab) for k, v, lab in rows
            if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    least = {}
    for (k, v, _), c in zip(kept, cut):
        if k is not None and (k not in least or v < least[k][0]):
            least[k] = (v, c)
    books = [[least[k][1][p] for k in sorted(least)[:entries]] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(nearest(c[p], books[p])[1], []).append(c[p])
            books[p] = [[sum(x) // len(groups[i]) for x in zip(*groups[i])] if i in groups else e for i, e in enumerate(books[p])]
    found = []
    for (k, _, lab), c in zip(kept, cut):
        best = [nearest(c[p], books[p]) for p in range(parts)]
        found.append((k, lab, "".join(f"{i:02x}" for _, i in best), sum(d for d, _ in best)))
    return found, books


def vectors(n=220, size=16, seed=3):
    draw = np.random.default_rng(seed)
    middles = draw.standard_normal((12, size))
    rows = [(int(i), [float(x) for x in (middles[draw.integers(12)] + draw.standard_normal(size) * .2).astype(np.float32)],
             [None, "a", "a", "b"][draw.integers(4)]) for i in draw.permutation(n)]
    rows += [rows[0], rows[0], (rows[1][0], rows[2][1], "b"), (None, rows[3][1], None), (-7, [0.0] * size, "z"), (-6, [-0.0] * size, "z"), (-5, [1e-9] * size, None),
             (-4, [-1e-9] * size, "z"), (900, None, "a"), (-901, [], "a"), (-902, [float("nan")] * size, "a"), (-903, [1.0, None] * (size // 2), "a"),
             (-904, [float("inf")] + [0.0] * (size - 1), "b"), (905, [1990.5, -1990.5] * (size // 2), "a")]
    return rows


@pytest.mark.parametrize("kind", ["float", "double"])
def test_codes_are_those_of_the_plain_rounds(spark, kind):
    rows = vectors()
    frame = spark.createDataFrame(rows, f"id long, v array<{kind}>, label string").withColumn("code", F.lit("old")).repartition(5)
    found, books = with_codes(frame, "id", "v", "label")
    want, plain = plain_codes(rows)
    assert books.tolist() == plain
    assert books_digest(books) == hashlib.sha256(",".join(str(x) for p in plain for e in p for x in e).encode()).hexdigest()
    sums = {}
    for _, lab, _, error in want:
        sums[lab] = sums.get(lab, 0) + error
    got = [(r["id"], r["label"], r["code"], r["error"], r["label_error"]) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(((*w, sums[w[1]]) for w in want), key=repr)


def test_codes_of_few_and_of_no_vectors(spark):
    schema = "id long, v array<float>, label int"
    rows = [(5, [0.5] * 8, 1), (5, [0.25] * 8, 1), (2, [-0.3] * 8, 1)]
    found, books = with_codes(spark.createDataFrame(rows, schema), "id", "v", "label", rounds=2)
    want, plain = plain_codes(rows, rounds=2)
    assert books.tolist() == plain and sorted((r["id"], r["label"], r["code"], r["error"]) for r in found.collect()) == sorted(want)
    one, _ = with_codes(spark.createDataFrame(rows[:1], schema), "id", "v", "label")
    assert [tuple(r) for r in one.collect()] == [(5, 1, "00" * 8, 0, 0)]
    none, books = with_codes(spark.createDataFrame([(1, None, 1), (2, [], 1)], schema), "id", "v", "label")
    assert none.count() == 0 and books_digest(books) == hashlib.sha256(b"").hexdigest()
    with pytest.raises(ValueError, match="one length"):
        with_codes(spark.createDataFrame([(1, [1.0] * 7, 1)], schema), "id", "v", "label")
    with pytest.raises(Exception, match="8192"):
        scaled(np.array([8192.0]))


def test_bounds_are_true_and_spare_most_searches():
    draw = np.random.default_rng(1)
    centres = draw.integers(-4000, 4000, (16, 8))
    rows = (centres[draw.integers(16, size=3000)] + draw.integers(-300, 300, (3000, 8))).astype(np.int32)
    books, bounds, searched = [rows[:16].astype(np.int64)], None, []
    for _ in range(9):
        bounds, n = assign(rows, bounds, books)
        searched.append(n)
        square = ((rows[:, None, :].astype(np.int64) - books[-1]) ** 2).sum(axis=2)
        assert (bounds["entry"] == square.argmin(axis=1)).all()
        net, others = shifts(books)
        own = np.sqrt(np.take_along_axis(square, bounds["entry"][:, None].astype(int), 1)[:, 0])
        rest = square.astype(float)
        np.put_along_axis(rest, bounds["entry"][:, None].astype(int), np.inf, 1)
        assert (bounds["above"] + net[bounds["above_round"], bounds["entry"]] >= own).all()
        assert (bounds["below"] - others[bounds["below_round"], bounds["entry"]] <= np.sqrt(rest.min(axis=1))).all()
        steps = np.array([np.sqrt(((a - b) ** 2).sum(axis=1)) for a, b in zip(books, books[1:])])
        if len(steps):   # the net way is never longer than the sum of the steps
            assert (net[0] <= steps.sum(axis=0) + 1e-6).all()
        entry = bounds["entry"]
        books.append(np.array([rows[entry == e].sum(axis=0) // max((entry == e).sum(), 1) if (entry == e).any() else books[-1][e] for e in range(16)]))
    assert bounds.dtype == BOUND and searched[0] == 3000 and searched[-1] < 300
