"""The corpus operators against plain versions on small tables with nulls, empty and long texts, ties and copies."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from changetide.llm import jaccard
from changetide.llm.attention import score_texts, windows_of
from changetide.llm.bpe import Codec, decode, default_vocabulary, digests, encode
from changetide.llm.graph import components
from changetide.llm.jaccard import Sets, forest, near_sets
from changetide.llm.language import identified, learned, page_parts
from changetide.llm.mixing import DOMAINS, mix, rates
from changetide.llm.order_minhash import code_points, compare_with_next, fingerprint, likeness
from changetide.llm.packing import best_fit, pack
from changetide.llm.repeats import without_repeats
from changetide.llm.sharding import jump, with_shards
from changetide.llm.vectors import near_vectors

SCHEMA = "doc_id long, text string, extra string"


def made(seed=3, n=60):
    """Random texts with copies, near copies, shared passages, nulls, blanks and one long text."""
    draw = random.Random(seed)
    words = ["".join(draw.choice("abcdeé") for _ in range(draw.randint(1, 7))) for _ in range(300)]
    texts = [" ".join(draw.choice(words) for _ in range(draw.randint(1, 160))) for _ in range(n)]
    passage = " ".join(draw.choice(words) for _ in range(90))
    near = texts[0].split(" ") * 3
    for i in range(12):
        other = list(near)
        other[draw.randrange(len(other))] = "Zz"
        texts.append(" ".join(other))
        texts.append(texts[i] + "\n" + passage + "\t" + texts[i + 20])
    texts += [texts[5], texts[5], None, "", " \n", "a" * 3000, "ab" * 900, "x" * 399, " ".join(texts[:40]), "É É\xa0ß 東京 <|endoftext|>"]
    return [(i * 7 % 1000 + 1, t, str(i)) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def rows():
    return made()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def groups_of(links, nodes):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def test_components_of_random_graphs(spark):
    draw = random.Random(1)
    links = [(draw.randrange(80), draw.randrange(80)) for _ in range(60)] + [(100 + i, 101 + i) for i in range(40)] + [(5, 5)]
    found = components(spark.createDataFrame([*links, (None, 3)], "a long, b long"), "a", "b")
    links = [(a, b) for a, b in links if a != b]
    want = groups_of(links, {x for pair in links for x in pair})
    assert {r["node"]: r["component"] for r in found.collect()} == want
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_jump_moves_keys_only_into_the_new_shard():
    keys = np.random.default_rng(2).integers(0, 2**63, 20_000).astype(np.uint64)
    before, after = jump(keys, 24), jump(keys, 25)
    assert set(after[before != after]) == {24}
    assert abs((before != after).mean() - 1 / 25) < 0.01
    assert np.bincount(before).min() > 700


def test_jump_equals_the_plain_loop():
    def plain(key, shards):
        at, ahead = -1, 0
        while ahead < shards:
            at = ahead
            key = (key * 2862933555777941757 + 1) % 2**64
            ahead = int((at + 1) * (float(1 << 31) / float((key >> 33) + 1)))
        return at

    draw = random.Random(6)
    keys = [0, 1, 2**63, 2**64 - 1, *(draw.randrange(2**64) for _ in range(500))]
    for shards in (1, 2, 24, 25, 1000):
        assert jump(np.array(keys, np.uint64), shards).tolist() == [plain(k, shards) for k in keys]


def test_shards_have_gapless_slots(spark, empty):
    frame = spark.createDataFrame([(None, "x", "a"), (None, "x", "a"), (7, "y", "b"), (7, "y", "b")], SCHEMA).union(
        spark.range(500).select(F.col("id").alias("doc_id"), F.lit("t"), F.lit("u")))
    found = with_shards(frame.withColumn("slot", F.lit(1)), "doc_id", 5, blocks=7).collect()
    slots = {}
    for r in found:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 5)
    assert len(found) == 504 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert with_shards(empty, "doc_id").count() == 0


def test_codec_agrees_with_the_library(rows):
    from tokenizers import Tokenizer

    path = default_vocabulary()
    codec, library = Codec(open(path, encoding="utf-8").read()), Tokenizer.from_file(path)
    odd = ["ΑΣ ΣΑΣ", "İst", "x\x1cy \x85z q", "it's I'LL ''' 12.5 ½", "한국어 😀👍🏽", "a<|endoftext|>B<|ENDOFTEXT|>", "é ́a"]
    for text in [*odd, *(r[1] or "" for r in rows)]:
        want = library.encode(text, add_special_tokens=False).ids
        ids = codec.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert codec.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_the_jaccard_join_sends_small_batches(spark, monkeypatch):
    """Every table of the join is made from batches of bounded bytes; the setting ends with it."""
    from changetide.llm import jaccard

    name, seen, stored = "spark.sql.execution.arrow.maxBytesPerBatch", [], jaccard.stored
    before = spark.conf.get(name)
    monkeypatch.setattr(jaccard, "stored", lambda frame, *a, **k: seen.append(spark.conf.get(name)) or stored(frame, *a, **k))
    words = " ".join(f"w{i}" for i in range(100))
    frame = spark.createDataFrame([(1, words), (2, words + " x"), (3, "else"), (4, None)], "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in near_sets(frame, "doc_id").collect()}
    assert found == {1: 1, 2: 1, 3: 3, 4: 4}
    assert set(seen) == {str(8 << 20)} and spark.conf.get(name) == before


def test_codec_cuts_and_keeps_a_run_at_a_time(monkeypatch):
    """New stretches are cut by one call for all; known ones aren't cut again, and a long one keeps no others from being kept."""
    codec, calls = Codec(open(default_vocabulary(), encoding="utf-8").read()), []
    fragments = codec._fragments
    monkeypatch.setattr(codec, "_fragments", lambda words: calls.append(sorted(words)) or fragments(words))
    texts = ["Ünder the xqzj", "", "the it's " + "z" * 100]
    first = list(codec.coded(texts))
    assert calls == [sorted(["ünder", "the", "xqzj", "it", "'s", "z" * 100])]
    assert first[1] == (b"", "") and list(codec.coded(texts)) == first and calls[1] == ["z" * 100]
    parts, n = fragments(["the", "xqzj"])
    assert "".join(parts) == "the\nxqzj\n" and n.sum() == len(parts) and n[1] > 1


def test_codec_on_long_words_and_in_small_caches():
    from tokenizers import Tokenizer

    path, draw = default_vocabulary(), random.Random(9)
    codec, library = Codec(open(path, encoding="utf-8").read()), Tokenizer.from_file(path)
    codec.chunks.most = codec.fragments.most = 5_000   # a few dozen entries
    texts = ["a" * 150_000, "ab" * 75_000, "é" * 50_000, "".join(draw.choice("abcdehinst") for _ in range(100_000)),
             " " * 5_000_000, "\xa0" * 2_000_000, "z" * 64, "z" * 65]
    texts += ["".join(draw.choice(["th", "e", "ing ", "É", "-", "'s", "1", " x", "Σ", "<|endoftext|>"]) for _ in range(200)) for _ in range(150)]
    for text, (ids, back) in zip(texts, codec.coded(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert back == library.decode(want, skip_special_tokens=False)
    assert codec.chunks.size <= 6_000 and len(codec.chunks.new) < 50


def test_coding_of_tables(docs, rows, empty):
    back = decode(encode(docs, ids="extra"), ids="extra").collect()
    found = {(r["doc_id"], r["ids_sha256"], r["decoded_sha256"], r["n_tokens"]) for r in digests(docs, "doc_id").collect()}
    assert found == {(r["doc_id"], hashlib.sha256(r["extra"]).hexdigest(), hashlib.sha256(r["decoded"].encode()).hexdigest(),
                      len(r["extra"]) // 4) for r in back}
    assert len(back) == len(rows) and digests(empty, "doc_id").count() == 0


def test_fingerprints(spark, docs, rows, empty):
    assert fingerprint(code_points("")) == fingerprint(code_points("")) != fingerprint(code_points("a"))
    forward, back = "the quick brown fox jumps over it " * 3, "over it jumps brown fox the quick " * 3
    assert 0 <= likeness(fingerprint(code_points(forward)), fingerprint(code_points(back))) < 1
    ordered = sorted((r[0], r[1] or "") for r in rows)
    for runs in (1, 4):
        found = {r["doc_id"]: r for r in compare_with_next(docs, "doc_id", runs).collect()}
        assert len(found) == len(ordered)
        for i, (key, text) in enumerate(ordered):
            following, half, r = ordered[(i + 1) % len(ordered)][1], len(text) // 2, found[key]
            edited = text[:len(text) - half] + following[:half]
            marks = [fingerprint(code_points(t)) for t in (text, edited, following)]
            assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
            assert (r["fingerprint"], r["edited_fingerprint"]) == (marks[0], marks[1])
            assert r["near_edited"] == likeness(*marks[:2]) and r["near_next"] == likeness(marks[0], marks[2])
    twice = spark.createDataFrame([(1, "a", ""), (1, "a", ""), (None, None, "")], SCHEMA)
    assert compare_with_next(twice, "doc_id", 3).count() == 3
    assert compare_with_next(empty, "doc_id", 3).count() == 0


@pytest.mark.parametrize(("size", "percent", "leaf"), [(3, 90, 8192), (5, 80, 3), (1, 50, 2)])
def test_near_sets_are_exact(docs, rows, size, percent, leaf):
    sets = {}
    for key, text, _ in rows:
        w = words_of(text)
        sets[key] = {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    want = groups_of(links, sets)
    found = near_sets(docs, "doc_id", words=size, percent=percent, leaf=leaf, levels=2).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == {k: (len(sets[k]), want[k]) for k in sets}


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_linked_sets_share_a_region(percent):
    draw = random.Random(percent)
    for size in [1, 2, 3, 5, 9, 20, 60, 150, 400] * 12:
        words = [f"w{draw.random()}" for _ in range(size)]
        # As many words dropped and put in as two linked sets may differ in.
        most = 2 * size * (100 - percent) // (100 + percent)
        lost = draw.randint(0, most)
        other = words[lost:] + [f"v{draw.random()}" for _ in range(most - lost)]
        if not other or 100 * (size - lost) < percent * (size + most - lost):
            continue
        texts = [" ".join(words).encode(), " ".join(other).encode()]
        bounds = np.cumsum([0, *map(len, texts)])
        keys, owner = Sets(np.frombuffer(b"".join(texts), np.uint8), bounds, 1).regions(percent)
        assert set(keys[owner == 0]) & set(keys[owner == 1])


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_linked_sets_share_enough_regions(percent):
    draw = random.Random(percent + 1)
    for size in [1, 2, 4, 7, 30, 90, 300, 900] * 10:
        words = [f"w{draw.random()}" for _ in range(size)]
        most = 2 * size * (100 - percent) // (100 + percent)
        lost = draw.randint(0, most)
        other = words[lost:] + [f"v{draw.random()}" for _ in range(most - lost)]
        if not other or 100 * (size - lost) < percent * (size + most - lost):
            continue
        texts = [" ".join(words).encode(), " ".join(other).encode()]
        sets = Sets(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]), 1)
        shared, least = [], sets.least_shared(percent).max(axis=1)
        for odd in (0, 1):
            keys, owner = sets.regions(percent, (odd,))
            assert all(keys & 1 == odd)
            shared.append(len(set(keys[owner == 0]) & set(keys[owner == 1])))
        # They have parts in one band in common, or in two.
        assert shared[0] >= least[0] or shared[1] >= least[1]


@pytest.mark.parametrize("leaf", [8192, 4])
def test_unlike_long_texts_are_not_compared_whole(spark, monkeypatch, leaf):
    """A passage that is common to long texts puts them into regions, and sketches of 1,024 bits can't tell them apart."""
    sent = []

    def counted(pairs, *a, own=jaccard._verified):
        sent.append(pairs.distinct().count())
        return own(pairs, *a)

    monkeypatch.setattr(jaccard, "_verified", counted)
    passage = " ".join(f"p{i}" for i in range(80))
    texts = [" ".join(f"w{i}v{j}" for j in range(4500)) + " " + passage for i in range(40)]
    rows = list(enumerate([*texts, texts[3] + " more", texts[3] + " and more"]))
    found = near_sets(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", words=3, percent=80, leaf=leaf, levels=1).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {i: 3 if i >= 40 else i for i in range(42)}
    assert sum(sent) <= 3


def test_forests_connect_what_all_pairs_connect():
    draw = np.random.default_rng(8)
    for size in (2, 30, 200):
        a, b = draw.integers(0, size, (2, size))
        start = draw.integers(0, size, size)
        start = start[start]   # some members share a label from the outset
        label, used = forest(start, a, b)
        own = [(("member", i), ("label", x)) for i, x in enumerate(start.tolist())]
        pairs = [(("member", x), ("member", y)) for x, y in zip(a.tolist(), b.tolist())]
        nodes = {n for pair in own + pairs for n in pair}
        whole, thin = (groups_of(own + chosen, nodes) for chosen in (pairs, [pairs[k] for k in used]))
        assert whole == thin and len(used) == len(set(start)) - len(set(label))
        assert all((label[x] == label[y]) == (whole["member", x] == whole["member", y]) for x in range(size) for y in range(size))


def test_near_sets_of_nothing(spark, empty):
    assert near_sets(empty, "doc_id").count() == 0
    nulls = spark.createDataFrame([(1, None, ""), (2, None, ""), (None, "a b", ""), (3, "A\tb", "")], SCHEMA)
    found = {(r["doc_id"], r["component_id"]) for r in near_sets(nulls, "doc_id").collect()}
    assert found == {(1, 1), (2, 2), (None, 3), (3, 3)}


@pytest.mark.parametrize("length", [400, 50])
def test_repeats_are_exact(docs, rows, length, empty):
    texts = [(k, (t or "").encode()) for k, t, _ in rows]
    seen = Counter(b[i:i + length] for _, b in texts for i in range(len(b) - length + 1))
    found = {r["doc_id"]: r for r in without_repeats(docs, "doc_id", length=length).collect()}
    for key, b in texts:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        r = found[key]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (
            len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    assert without_repeats(empty, "doc_id").count() == 0


def test_vectors(spark):
    draw = np.random.default_rng(4)
    base = draw.standard_normal((30, 16))
    vectors = [(int(i), [float(x) for x in base[i % 30] + 0.03 * draw.standard_normal(16)], i % 2) for i in range(150)]
    vectors += [(200, vectors[0][1], 0), (201, vectors[0][1], 0), (202, vectors[0][1], None), (203, None, 0), (204, [0.0] * 16, 0),
                (205, [math.nan] * 16, 0), (206, [None] * 16, 0), (207, [], 0), (208, [1.0, 2.0], 0), (209, [2.0, 4.0], 0)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label int")
    found = {r["vec_id"]: r for r in near_vectors(frame, "vec_id", "embedding", "label", block=16).collect()}
    usable = {i: np.array(v) / np.linalg.norm(v) for i, v, label in vectors
              if label is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    labels = {i: label for i, _, label in vectors}
    links = [(a, b) for a in usable for b in usable if a < b and labels[a] == labels[b]
             and len(usable[a]) == len(usable[b]) and usable[a] @ usable[b] >= 0.98]
    want, count = groups_of(links, labels), Counter(x for pair in links for x in pair)
    assert {i: (r["n_links"], r["component_id"], r["kept"]) for i, r in found.items()} == {
        i: (count[i], want[i], want[i] == i) for i in labels}
    assert near_vectors(frame.limit(0), "vec_id", "embedding", "label").count() == 0


def test_vectors_of_a_tight_label(spark):
    draw = np.random.default_rng(9)
    n, planted, size = 12_000, 400, 64

    def unit(x):
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    # All share a direction, with a cosine of 0.9 on average; some have a near one.
    rows = unit(0.9 ** 0.5 * unit(np.ones((1, size))) + 0.1 ** 0.5 * unit(draw.standard_normal((n, size))))
    side = draw.standard_normal((planted, size))
    side = unit(side - (side * rows[:planted]).sum(axis=1, keepdims=True) * rows[:planted])
    rows[n - planted:] = 0.982 * rows[:planted] + (1 - 0.982 ** 2) ** 0.5 * side
    near = rows @ rows.T >= 0.98
    frame = spark.createDataFrame(pa.table({"vec_id": np.arange(n), "embedding": rows.tolist(), "label": np.zeros(n, np.int64)}))
    found = near_vectors(frame, "vec_id", "embedding", "label").agg(F.sum("n_links")).first()[0]
    wanted = int(near.sum()) - n
    assert 2 * planted <= wanted and 0.95 * wanted <= found <= wanted


def test_packing_loses_nothing(docs, rows, empty):
    import base64

    import public_tokenizers
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    coder = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    parts = {}
    for r in pack(docs, "doc_id", row=64, gathered=500).collect():
        ids, places, ends = np.frombuffer(r["ids"], "<u2"), np.frombuffer(r["positions"], "<u2"), r["cu_seqlens"]
        assert len(ids) == len(places) == 64 and (ids[ends[-1]:] == 50256).all()
        for i, (a, b) in enumerate(zip(ends, ends[1:])):
            assert places[a:b].tolist() == list(range(b - a))
            parts.setdefault(r["doc_ids"][i], []).append((r["starts"][i], r["parts"][i], ids[a:b].tolist()))
    for key, text, _ in rows:
        own = sorted(parts[key])
        assert [p[1] for p in own] == list(range(len(own)))
        assert sum((p[2] for p in own), []) == [*coder.encode_ordinary(text or ""), 50256]
    assert pack(empty, "doc_id").count() == 0


def test_best_fit_decreasing():
    draw = np.random.default_rng(5)
    for _ in range(20):
        lengths, row = draw.integers(1, 65, 200), 64
        rooms, want = [], np.empty(200, int)
        for i in np.argsort(-lengths, kind="stable"):
            fits = [(room, -n) for n, room in enumerate(rooms) if room >= lengths[i]]
            if not fits:
                rooms.append(row)
                fits = [(row, -(len(rooms) - 1))]
            want[i] = -min(fits)[1]
            rooms[want[i]] -= lengths[i]
        found = best_fit(lengths, row)
        assert np.bincount(found, lengths).max() <= row and len(set(found)) == len(rooms)


def test_attention_scores(docs, rows, empty):
    found = {r["doc_id"]: r for r in score_texts(docs, "doc_id", frequent=50).collect()}
    held = {k: zlib.crc32(str(k).encode()) % 10 == 0 for k, _, _ in rows}
    count = Counter(w for k, t, _ in rows if not held[k] for w in [*words_of(t), None])
    total, distinct = sum(count.values()), len(count)
    for key, text, _ in rows:
        w, r = [*words_of(text), None], found[key]
        base = sum(math.log10((count[x] + 0.1) / (total + 0.1 * (distinct + 1))) for x in w)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[key], len(w), sum(count[x] > 0 for x in w), total)
        assert r["base_score"] == pytest.approx(base) and r["score"] < 0
    assert score_texts(empty, "doc_id").count() == 0


def test_attention_learns_from_whole_texts(spark):
    words = ["time", "year", "people", "way", "day", "man", "thing", "woman", "life", "child", "world", "school", "state", "family",
             "student", "group", "country", "problem", "hand", "part", "place", "case", "week", "company"]
    cycles = [(a, b) for a, b in zip(words[::2], words[1::2])]
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0][:len(cycles)]
    free = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10][:2]
    # One long text with a stretch of each pair; no single window of it holds them all.
    long = " ".join(w for a, b in cycles for w in [a, b] * 60)
    rows = [(i, long) for i in free] + [(i, " ".join(pair * 20)) for i, pair in zip(held, cycles)]
    found = score_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(1), "doc_id", word_share=0.0)
    scores = {r["doc_id"]: r["score"] / r["base_score"] for r in found.collect()}
    assert all(scores[i] < 0.6 for i in held)
    # Every id of every text to learn from stands once in a last block; before its start there is none.
    sizes = np.array([1, 16, 17, 40, 33])
    ids = np.arange(sizes.sum())
    windows, at = windows_of(ids, sizes, -1)
    assert windows[:, 17:].ravel()[at].tolist() == ids.tolist()
    texts = np.repeat(np.arange(5), sizes)
    for row in windows:
        own = [(p, x) for p, x in enumerate(row) if x >= 0]
        first = row[17]
        start = first - (np.cumsum(sizes) - sizes)[texts[first]]
        assert all(x == first + p - 17 and texts[x] == texts[first] for p, x in own)
        assert (row[:17] >= 0).sum() == min(17, start)


def test_language(spark):
    draw = random.Random(6)
    sounds = {"en": ["the ", "and ", "ing ", "of "], "de": ["der ", "und ", "ung ", "zu "]}
    rows = [(i, "".join(draw.choice(sounds[lang]) for _ in range(30)), lang, lang)
            for i in range(80) for lang in [("en", "de")[i % 2]]]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    names, chances = learned(frame, "text", "lang")
    odd = spark.createDataFrame(
        [(900, None, "en", "en"), (901, "", None, None), (902, "12 34", "de", "de"), (903, "the der ", "de", "de"),
         (904, "xqzk wvjx qqzz xkcd zzqx wxyz kqj vxq zqx jjkx wqz xvz " * 6, None, None)], frame.schema)
    found = {r["doc_id"]: r for r in identified(frame.union(odd), "text", "lang", F.col("source"), F.lit("-"), names, chances).collect()}
    assert names == ["de", "en"] and len(found) == 85
    assert all(found[i]["language"] == lang and found[i]["accepted"] for i, _, lang, _ in rows)
    assert not any(found[i]["accepted"] for i in (900, 901, 902, 904)) and found[904]["language"] == "und"
    assert identified(frame.limit(0), "text", "lang", F.col("source"), F.lit("-"), names, chances).count() == 0
    assert page_parts('<html lang="EN-us"><script>x</script><p>A&amp;B</p>') == ("en", "   A&B ")
    assert page_parts(None) == (None, "")


def test_mixing_meets_its_targets(spark):
    draw = random.Random(7)
    rows = [(i, " ".join(draw.choices(["fine", "good", "nice"] if i % 3 else ["bad", "vile", "worst"], k=40))) for i in range(300)]
    docs = spark.createDataFrame([*rows, (500, None), (501, " "), (None, "good")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 != 0), int(i % 3 == 0)) for i in range(0, 200)] + [(None, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    found = mix(docs, "doc_id", "text", labels, {"good": 0.9, "plain": 0.05, "toxic": 0.05}).collect()
    assert len(found) == 302 and all(r["rate"] >= 0 and r["copies"] >= 0 for r in found)
    tokens = {d: sum(r["rate"] * r["n_tokens"] * r[f"p_{d}"] for r in found) for d in DOMAINS}
    assert tokens["good"] > 0.8 * 300 * 40 and tokens["toxic"] < 0.1 * 300 * 40
    kept = {r["doc_id"]: r["rate"] for r in mix(docs, "doc_id", "text", labels).collect()}
    assert all((kept[i] >= 0.5) == (i % 3 != 0) for i in range(300))
    assert mix(docs.limit(0), "doc_id", "text", labels).count() == 0


@pytest.mark.parametrize("doubt", [0.0, 1e-9, 1e-5])
def test_one_toxic_document_goes_from_a_large_clean_corpus(spark, doubt):
    rows = [(1, 40, 0.0, 0.0, 1.0)] + [(i, 10_000_000, 0.7 - doubt, 0.3, doubt) for i in range(2, 60)]
    members = spark.createDataFrame(rows, "doc_id long, n_tokens long, p_good double, p_plain double, p_toxic double")
    now = {d: sum(r[1] * r[2 + i] for r in rows) for i, d in enumerate(DOMAINS)}
    found = {r["doc_id"]: r["rate"] for r in rates(members, now | {"toxic": 0.0}).collect()}
    assert found[1] < 0.01 and all(found[i] > 0.5 for i in range(2, 60))


def test_rates_reach_what_can_be_reached(spark, recwarn):
    draw = np.random.default_rng(11)
    p = draw.dirichlet([0.3, 0.3, 0.3], 200)
    n = draw.integers(1, 500, 200)
    rows = [(i, int(n[i]), *map(float, p[i])) for i in range(200)]
    members = spark.createDataFrame(rows, "doc_id long, n_tokens long, p_good double, p_plain double, p_toxic double")
    target = np.array([0.7, 0.3, 0.02]) * n.sum()
    found = {r["doc_id"]: r["rate"] for r in rates(members, dict(zip(DOMAINS, target.tolist()))).collect()}
    reached = (np.array([found[i] for i in range(200)]) * n) @ p
    # The plain way: a great many short projected steps.
    size, rate = n @ p, np.ones(200)
    for _ in range(200_000):
        rate = np.maximum(rate - p @ (((rate * n) @ p - target) / size), 0)
    assert np.abs(reached - (rate * n) @ p).max() <= 1e-4 * size.min() and not [w for w in recwarn if "rates" in str(w.message)]
    same = spark.createDataFrame([(i, 10, 0.5, 0.3, 0.2) for i in range(9)], members.schema)
    assert len({r["rate"] for r in rates(same, {"good": 45.0, "plain": 27.0, "toxic": 0.0}).collect()}) == 1


def test_codec_parts_words_like_the_vocabulary():
    """Every white space of Unicode, what only Arrow or Python take for it, and blanks at both ends."""
    from changetide.llm import bpe

    codec = bpe.Codec(open(bpe.default_vocabulary(), encoding="utf-8").read())
    seen = []
    codec._learned = lambda chunks, learn=codec._learned: seen.append(chunks) or learn(chunks)
    for i in [*range(0xD800), *range(0xE000, 0x11000)]:
        parts = codec._stretches(pa.array([f"a{chr(i)}b"], pa.large_string())).to_pylist()[0]
        assert (len(parts) == 2) == (codec.gap.search(chr(i)) is not None), hex(i)
    texts = ["", " ", "  one two  ", "one\x1ctwo", " one　two\n", "x\x1f y"]
    plain = [" ".join([w for w in codec.gap.split(t) if w]) for t in texts]
    assert list(codec.coded(texts)) == list(codec.coded(plain)) and not any("" in chunks for chunks in seen)
    empty = pa.array(["one", "", "two"], pa.large_string())
    assert [(bytes(a), bytes(b)) for a, b in codec.laid(empty.slice(1, 2))] == [(b"", b""), (codec.encode("two"), b"two</w>")]


def test_a_worker_lets_its_codec_go(monkeypatch):
    """Vocabulary and caches stayed in a worker for good, beside whatever it did next."""
    import time

    from changetide.llm import bpe

    monkeypatch.setattr(bpe, "IDLE", 0.2)
    described = open(bpe.default_vocabulary(), encoding="utf-8").read()
    with bpe._coder(described) as first:
        first.encode("one")
    with bpe._coder(described) as again:   # the next task finds it
        assert again is first
        time.sleep(0.5)
        assert bpe._codecs
    time.sleep(1)
    assert not bpe._codecs


def test_few_links_make_few_files(spark, monkeypatch):
    """Every step of the contraction wrote a file for each shuffle partition, however few its links."""
    from changetide.llm import graph

    made, stored = [], graph.stored

    def counted(frame, *args):
        out = stored(frame, *args)
        made.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(graph, "stored", counted)
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        links = spark.range(60).selectExpr("id AS a", "id + 1 AS b")
        found = graph.components(links, "a", "b").collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert {(r["node"], r["component"]) for r in found} == {(i, 0) for i in range(61)} and len(found) == 61
    # The table of the given links and what is joined from it may have many files.
    assert sum(n > 9 for n in made) <= 1 + (len(made) - 2) // 3
    star = len(made)
    graph.components(spark.range(1, 9).selectExpr("id AS a", "0L AS b"), "a", "b")
    assert len(made) == star + 2   # a star is left as it is


def test_a_text_without_a_key_hides_no_link(spark):
    """The forest of a region could connect two texts by way of one without a key only."""
    rows = []
    for family in range(12):
        words = [f"f{family}w{i}" for i in range(100)]
        texts = [" ".join([*words, f"end{family}x{i}"]) for i in range(3)]
        rows += [(2 * family, texts[0]), (2 * family + 1, texts[1]), (None, texts[2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in near_sets(docs, "doc_id").filter("doc_id is not null").collect()}
    assert found == {i: i - i % 2 for i in range(24)}
