"""The stages of the corpus pipeline, and all of it, against plain versions on small tables."""

import random
from collections import Counter

import corpus_pipeline as corpus
from changetide.llm.bpe import digests

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "web", None if t is None else len(t)) for i, t in rows], DOCS)


def texts(found):
    return sorted(((r["doc_id"], r["text"]) for r in found.collect()), key=repr)


def test_mixture_keeps_what_is_hardly_toxic(spark, tmp_path, monkeypatch):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rated = [(1, 0.0, 0.9), (2, 0.4, 0.5), (3, 0.1, 0.49), (4, 0.6, 0.7), (5, 1.0, 0.0)]
    monkeypatch.setattr(corpus, "mix", lambda *a: spark.createDataFrame(rated, "doc_id long, rate double, p_toxic double"))
    rows = [(i, f"text {i}") for i in range(1, 6)] + [(None, "no key")]
    kept = corpus.mixture(spark, frame(spark, rows), str(tmp_path))
    assert texts(kept) == sorted([(3, "text 3"), (4, "text 4"), (5, "text 5"), (None, "no key")], key=repr)


def test_near_copies_are_decided_by_text(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(3, b), (5, a), (5, b), (7, b + " more"), (7, c), (8, c + " more"), (8, c + " more"), (None, b), (9, None), (10, "")]
    kept = corpus.near_copies(spark, frame(spark, [*rows, (3, b)]), "")
    assert texts(kept) == sorted([(3, b), (5, a), (7, c), (None, b), (9, None), (10, "")], key=repr)
    assert corpus.near_copies(spark, frame(spark, rows[:0]), "").count() == 0


def test_shortest_passage_that_is_cut(spark):
    # 120 words of one letter and a blank; and the same, one byte short.
    for size, cut in ((240, True), (239, False)):
        passage = ("a b c d e f g h i j " * 12)[:size]
        rows = [(1, "<" + passage + ">"), (2, "[" + passage + "]")]
        kept = texts(corpus.repeated_passages(spark, frame(spark, rows), ""))
        assert kept == ([(1, "<>"), (2, "[]")] if cut else rows)


def test_characters_are_cut_whole_and_others_stay(spark):
    passage = "éa" * 90   # 270 bytes; the texts share half of the characters around it
    rows = [(1, "\ufffd" + "é" + passage + "ê\ufffd"), (2, "x\ufffdé" + passage + "ë"), (3, "ü\ufffd")]
    kept = texts(corpus.repeated_passages(spark, frame(spark, rows), ""))
    assert kept == [(1, "\ufffd"), (2, "x"), (3, "ü\ufffd")]


def plain_near_copies(rows):
    """Distinct (doc_id, text) without those that links chain to one of a lesser doc_id; all with no doc_id."""
    sets = {}
    for key, text in rows:
        words = (text or "").lower().split()
        sets[key, text] = {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())
    group = {x: x for x in sets}
    for a in sets:
        for b in sets:
            if group[a] != group[b] and sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                group = {x: group[a] if g == group[b] else g for x, g in group.items()}
    least = {g: min((x[0] for x in sets if group[x] == g and x[0] is not None), default=None) for g in group.values()}
    return [x for x in sets if x[0] is not None and x[0] == least[group[x]]] + [x for x in rows if x[0] is None]


def plain_passages(rows):
    size = corpus.PASSAGE
    data = [(key, (text or "").encode()) for key, text in rows]
    seen = Counter(b[i:i + size] for _, b in data for i in range(len(b) - size + 1))
    out = []
    for key, b in data:
        gone = {j for i in range(len(b) - size + 1) if seen[b[i:i + size]] > 1 for j in range(i, i + size)}
        left = bytes(x for i, x in enumerate(b) if i not in gone).decode()
        out += [(key, left)] if left.strip(" ") else []
    return out


def made():
    draw = random.Random(12)
    sounds = {"en": ["the ", "and ", "ing ", "of "], "de": ["der ", "und ", "ung ", "zu "]}
    some = lambda lang, n: "".join(draw.choice(sounds[lang]) for _ in range(n))
    rows = [(i, some(("en", "de")[i % 2], 60), ("en", "de")[i % 2]) for i in range(60)]
    passage = some("en", 120)
    rows += [(100, rows[0][1] + "of", "en"), (3, rows[4][1], "en"), (3, some("de", 60), "de"), (101, rows[6][1] + passage, "en"),
             (102, some("en", 70) + passage, "en"), (103, passage, "en"), (None, some("en", 60), "en"),
             (rows[9][0], rows[9][1], "de")]
    odd = [(200, None, "en"), (201, "", "de"), (202, "12 34", "en"), (None, " ", "de")]
    return rows, odd


def table_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, lang, None if t is None else len(t)) for i, t, lang in rows], DOCS)


def test_stages_against_plain_versions(spark):
    rows, odd = made()
    found = corpus.language_id(spark, table_of(spark, rows + odd), "")
    assert texts(found) == sorted([r[:2] for r in rows], key=repr)
    plain = [r[:2] for r in rows]
    assert texts(corpus.near_copies(spark, table_of(spark, rows), "")) == sorted(plain_near_copies(plain), key=repr)
    assert texts(corpus.repeated_passages(spark, table_of(spark, rows + odd), "")) == sorted(
        plain_passages([r[:2] for r in rows + odd]), key=repr)


def test_run_against_a_plain_version(spark, tmp_path):
    rows, odd = made()
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    table_of(spark, rows + odd).write.parquet(f"{tmp_path}/documents.parquet")
    want = plain_passages(plain_near_copies([r[:2] for r in rows]))   # with no labels the mixture takes all
    told = lambda found: sorted(map(tuple, found.collect()), key=repr)
    assert told(corpus.run(spark, str(tmp_path))) == told(digests(frame(spark, want), "doc_id"))


def test_run_on_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus.run(spark, str(tmp_path)).count() == 0
