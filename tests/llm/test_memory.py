"""Workers give their memory back when a task ends; whole sets are sent once."""

from __future__ import annotations

import re
from pathlib import Path

import numpy as np

from changetide.llm import jaccard
from changetide.llm.tables import frugal


def resident() -> float:
    """MB of this process's own memory."""
    return int(re.search(r"\nRssAnon:\s+(\d+)", Path("/proc/self/status").read_text())[1]) / 1024


def test_task_lets_go_of_its_memory():
    kept = []

    def work(batches):
        for n in batches:
            some = [np.ones(8000) for _ in range(n)]   # too small for pages of their own, so freed ones stay with the process
            kept.append(some[-1])                      # above them something lives on
            yield len(some)

    before = resident()
    tasks = work([4000])
    assert next(tasks) == 4000
    assert list(tasks) == [] and resident() > before + 200
    kept.clear()
    assert list(frugal(work)([4000, 10])) == [4000, 10]
    assert resident() < before + 60


def test_sets_are_sent_once(spark, monkeypatch):
    tables, plans = [], []
    monkeypatch.setattr(jaccard, "stored", lambda f, name, keep=False, own=jaccard.stored: tables.append(name) or own(f, name, keep))

    def seen(*a, own=jaccard._verified):
        found = own(*a)
        found.collect()
        plans.append(found._jdf.queryExecution().executedPlan().toString())
        return found

    monkeypatch.setattr(jaccard, "_verified", seen)
    texts = [" ".join(f"w{i}v{j}" for j in range(200)) for i in range(20)]
    rows = [(i + 20 * k, t + " end" * k) for i, t in enumerate(texts) for k in range(3)] + [(3, texts[7]), (3, texts[3]), (None, texts[5])]
    found = jaccard.near_sets(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", words=3, percent=80).collect()
    # A key that two texts share joins their groups.
    assert {(r["doc_id"], r["component_id"]) for r in found} == {(i, 3 if i % 20 == 7 else i % 20) for i in range(60)} | {(None, 5)}
    assert "items" not in tables and all("ReusedExchange" in p for p in plans) and plans
