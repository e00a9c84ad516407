"""Very long runs of blanks, letters and words, which tokenizers and merges must survive."""

import numpy as np
import tiktoken
from changetide.llm.attention import score_texts
from changetide.llm.bpe import digests
from changetide.llm.packing import default_vocabulary, pack
from changetide.llm.words import RUN, encoded

BLANKS = ["x" + " " * 1_000_000, "\xa0" * 1_000_000 + "y", "\n" * (RUN + 1) + "z " * 20 + "\t \xa0" * 400_000, "w " * 300_000, "a" * 400_000]


def encoder():
    import base64

    import public_tokenizers
    with open(default_vocabulary(), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file.read().splitlines())}
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_long_runs_are_cut_and_nothing_is_lost():
    library = encoder()
    for text in [*BLANKS, "", " ", "a  b\n\n c", " " * RUN, "k" * 50 + " " * RUN + "l"]:
        ids = encoded(library.encode_ordinary, text)
        assert library.decode(ids) == text
        if len(text) < 10 or text.strip() == "" and len(text) <= RUN:
            assert ids == library.encode_ordinary(text)


def test_operators_on_long_runs(spark):
    docs = spark.createDataFrame(list(enumerate(BLANKS)) + [(i, "plain words stand here") for i in range(10, 40)], "doc_id long, text string").repartition(3)
    library, texts = encoder(), dict(enumerate(BLANKS))
    n_ids = sum(len(encoded(library.encode_ordinary, t)) + 1 for t in texts.values()) + 30 * (len(library.encode_ordinary("plain words stand here")) + 1)
    packed = pack(docs, "doc_id")
    assert packed.count() >= n_ids / 2048
    scores = {r["doc_id"]: r for r in score_texts(docs, "doc_id", rounds=1).collect()}
    assert len(scores) == 35 and all(np.isfinite(r["score"]) for r in scores.values())
    assert scores[3]["n_tokens"] == 300_001 and scores[0]["n_tokens"] == 2
    assert digests(docs, "doc_id").count() == 35
