"""Results do not depend on how many blocks the benchmark makes."""

import weakref

from quayline.llm import decontaminate
from tests.llm.conftest import DOCUMENTS, words


def overlapping(spark):
    """Texts in which passages of several items overlap, touch and would meet if one was cut out first."""
    text = words(40, 60).split()
    items = [(1, " ".join(text[0:20])), (2, " ".join(text[14:32])), (3, " ".join(text[32:44])), (4, " ".join(text[44:49] + text[55:60]))]
    inner = words(41, 12)
    split = f"{' '.join(text[44:49])} {inner} {' '.join(text[55:60])}"
    rows = [(1, f"Before, {', '.join(text[:44])}! After."), (2, " ".join(text[:44])), (3, split), (4, None), (5, "clean text"), (6, " ".join(text[16:32]))]
    items.append((5, inner))
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCUMENTS)
    return docs, spark.createDataFrame(items, "item_id bigint, text string")


def test_cuts_and_spans_are_the_same_in_many_blocks(spark, docs, clashing, no_docs, monkeypatch):
    made, bench = overlapping(spark)
    some = spark.createDataFrame([(1, words(2, 30)), (2, "one"), (6, words(5, 12)), (7, words(3, 10))], "item_id bigint, text string")
    cases = [(made, bench), (docs, some), (clashing, some), (no_docs, some)]
    run = lambda d, b: [
        sorted(map(tuple, f(d, b).collect()), key=str) for f in (decontaminate.remove_spans, decontaminate.find_contamination)
    ]
    want = [run(*c) for c in cases]
    assert [t for _, t, *_ in want[0][0]] == ["Before, ! After.", f"{' '.join(words(40, 60).split()[44:49])}  {' '.join(words(40, 60).split()[55:60])}", None, "clean text"]
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 40)
    assert decontaminate.benchmark_blocks(bench)[0] > 5
    assert [run(*c) for c in cases] == want


def test_one_block_is_held_at_a_time(spark, monkeypatch):
    made, bench = overlapping(spark)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 100)
    alive, most = weakref.WeakSet(), []

    class Counted(decontaminate.Phrases):
        def __init__(self, items):
            super().__init__(items)
            alive.add(self)
            most.append(len(alive))

    monkeypatch.setattr(decontaminate, "Phrases", Counted)
    n, blocks = decontaminate.benchmark_blocks(bench)
    assert n > 2 and not most
    for block in blocks:
        del block
    assert len(most) == n and max(most) <= 2


def test_items_without_an_id_are_searched(spark, monkeypatch):
    known, nameless = words(50, 12), words(51, 12)
    docs = spark.createDataFrame([(1, f"a {known} b {nameless} c", "en", "s", 0), (2, f"d {nameless} e", "en", "s", 0)], DOCUMENTS)
    bench = spark.createDataFrame([(7, known), (None, nameless), (None, None)], "item_id bigint, text string")
    for size in (decontaminate.BLOCK_BYTES, 60):
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", size)
        found = decontaminate.digest(decontaminate.find_contamination(docs, bench))
        rows = sorted((r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in found.collect())
        assert rows == [(1, 27, 24, 1, True), (2, 14, 12, 0, True)]
        assert sorted(r.text for r in decontaminate.remove_spans(docs, bench).collect()) == ["a  b  c", "d  e"]
