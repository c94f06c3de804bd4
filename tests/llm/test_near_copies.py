"""Findings of round three: a group of near copies costs no pair by pair comparison where it is connected."""

import random
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from racelake.llm import ngram_join  # noqa: E402


def test_copies_linked_through_few_others(spark, monkeypatch):
    """Texts with two changed words link only with those that have one: 30 of 300, none of them the smallest or largest."""
    rng, base = random.Random(3), [f"w{i}" for i in range(160)]
    rows = []
    for i in range(300):
        words = list(base)
        for at in rng.sample(range(4, 156, 5), 1 if i % 10 == 5 else 2):
            words[at] = f"v{i}x{at}"
        words = words[:-1] if i == 0 else words + ["more"] if i == 1 else words
        rows.append((i, " ".join(words)))
    counts, staged = [], ngram_join.staged

    def counted(df, name):
        table = staged(df, name)
        if name == "pairs":
            counts.append(table.count())
        return table

    monkeypatch.setattr(ngram_join, "staged", counted)
    found = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 4, 85)
    want = brute.jaccard_components(rows, 4, 85)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found.collect()} == {d: tuple(want[d]) for d, _ in rows}
    assert len({c for _, c in want.values()}) < 10
    assert sum(counts) < 5 * len(rows)


def test_entries_that_are_done_are_left_out(spark, monkeypatch):
    """A turn reads the entries that the turn before left open, not all; an entry of two nodes is done after the first hub."""
    rng, rows = random.Random(4), []
    for i in range(60):
        words = [f"w{i // 2 if i < 40 else 20}x{j}" for j in range(120)]
        for at in rng.sample(range(4, 116, 5), 2):
            words[at] = f"v{i}x{at}"
        rows.append((i, " ".join(words)))
    read, sizes, staged = [], {}, ngram_join.staged

    def spied(df, name):
        if name == "open-entries":
            read.append(any("shared-entries" in f for f in df.inputFiles()))
        table = staged(df, name)
        if name == "shared-entries":
            per = table.groupBy("sig").count().withColumnRenamed("count", "held")
            sizes.update({(r["held"] == 2, r["two"]): r["n"] for r in table.join(per, "sig").groupBy("held", "two").agg({"*": "count"}).toDF("held", "two", "n").collect()})
        return table

    monkeypatch.setattr(ngram_join, "staged", spied)
    found = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 4, 85)
    want = brute.jaccard_components(rows, 4, 85)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found.collect()} == {d: tuple(want[d]) for d, _ in rows}
    assert len(read) > 1 and read[0] and not any(read[1:])
    assert sizes.get((True, True)) and not sizes.get((False, True))  # said of entries of two only
