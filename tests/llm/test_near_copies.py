"""The near-duplicate stage against a plain comparison of all pairs."""

import random

import numpy as np
import pyarrow as pa

import corpus_pipeline
from quayline.llm import near_copies
from tests.llm.conftest import documents, words

SF_DIR = "/root/testdata/sf0.001"


def plain_groups(texts):
    sets = []
    for t in texts:
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").encode().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    group = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 5 * len(a & b) >= 4 * len(a | b) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return group


def check(df):
    rows = df.select("doc_id", "text").collect()
    smallest = {}
    for r, g in zip(rows, plain_groups([r.text for r in rows])):
        smallest.setdefault(g, []).append((r.doc_id is None, r.doc_id or 0))
    kept = corpus_pipeline.drop_near_duplicates(df.sparkSession, df, SF_DIR)
    assert kept.columns == df.columns
    got = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    assert got == sorted(min(g) for g in smallest.values())
    return len(got)


def edited(text, share, seed):
    rng, out = random.Random(seed), text.split()
    for i in rng.sample(range(len(out)), int(share * len(out))):
        out[i] = f"new{seed}x{i}"
    return " ".join(out)


def test_near_copies_beyond_two_bits_go(spark):
    rows = []
    for k in range(12):
        text = words(k, 150 + 10 * k)
        rows += [(10 * k + e, edited(text, 0.01 * e, 10 * k + e)) for e in range(6)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert check(df) < len(rows)


def test_groups_hold_by_links_past_the_smallest(spark):
    # Neighbours in the row agree, ends do not; a passage that all share is no link.
    shared, body = words(900, 40), words(901, 400).split()
    rows = [(i, f"{' '.join(body[8 * i : 8 * i + 200])}") for i in range(20)]
    rows += [(100 + i, f"{shared} {words(1000 + i, 60)}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert check(df) == 41


def test_near_copies_of_given_and_awkward_rows(spark, docs, clashing, no_docs):
    check(docs)
    check(clashing)
    check(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    assert corpus_pipeline.drop_near_duplicates(spark, no_docs, SF_DIR).count() == 0


def test_order_of_shingles_changes_no_result(spark, docs, monkeypatch):
    monkeypatch.setattr(near_copies, "COMMON", 3)
    check(docs)
    assert len(documents()) > 3


def test_simhash_links_what_it_reaches_first(spark, monkeypatch):
    text = words(7, 600)
    rows = [(i, f"{text} tail{i}") for i in range(6)] + [(10 + i, words(50 + i, 80)) for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    pairs, verified = [], near_copies._verified

    def seen(asked, keyed, first):
        found = verified(asked, keyed, first)
        pairs.append((asked.count(), found.count()))
        return found

    monkeypatch.setattr(near_copies, "_verified", seen)
    monkeypatch.setattr(near_copies, "discard", lambda *tables: None)
    assert check(df) == 7
    # By fingerprints first; what is in one group by then is not compared again.
    assert len(pairs) == 3 and pairs[0][1] > 0 and pairs[0][1] + pairs[1][1] + pairs[2][1] == 5


def test_one_python_function_in_a_stage(spark, docs, monkeypatch, capsys):
    plans, staged = [], near_copies.staged

    def seen(session, df, label):
        df.explain()
        plans.append((label, capsys.readouterr().out.count("MapInArrow")))
        return staged(session, df, label)

    monkeypatch.setattr(near_copies, "staged", seen)
    check(docs)
    # Two of them in a row hold two workers on every core, which keep their memory in all later stages.
    assert ("sets", 1) in plans and max(n for _, n in plans) == 1


def test_sketches_tell_large_sets_apart():
    rng = np.random.default_rng(3)
    one, other = (np.unique(rng.integers(0, 1 << 63, 3000).astype(np.uint64)) for _ in range(2))
    near = np.unique(np.concatenate((one[150:], other[:2500])))
    assert len(near_copies.sketch(one)) > near_copies.BITS // 8
    a, b, c = map(near_copies.sketch, (one, other, near))
    assert 9 * near_copies.differing(a, b) > len(one) + len(other)
    # Never more bits than shingles that differ, also where the longer sketch is folded.
    assert len(c) > len(a) and near_copies.differing(a, c) == near_copies.differing(c, a) <= len(np.setxor1d(one, near))
    batch = pa.RecordBatch.from_pydict({"u": [1, 2], "v": [3, 4], "n": [3000, 3000], "m": [3000, 3000], "a": [a, a], "b": [b, a]})
    assert next(near_copies._possible(iter([batch]))).column("u").to_pylist() == [2]


def test_pairs_of_edited_copies_do_not_grow_with_their_square(spark, monkeypatch):
    # Every copy is near the original, and too far from the other copies for sketches to tell at once.
    original = words(70, 400)
    rows = [(i, edited(original, 0.017, i)) for i in range(40)] + [(900, original)]
    asked, verified = [], near_copies._verified

    def seen(pairs, keyed, first):
        asked.append(pairs.count())
        return verified(pairs, keyed, first)

    monkeypatch.setattr(near_copies, "_verified", seen)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert check(df) == 1
    assert asked[1] <= 2 * len(rows) and asked[2] == 0


def test_sample_grows_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "SAMPLE", 2)
    passage = words(80, 12)
    rows = [(i, f"{passage} {words(2000 + i, 10)}") for i in range(480)]
    keyed = spark.createDataFrame([(i, i, t.encode()) for i, t in rows], "doc_id bigint, text_key bigint, bytes binary")
    tokens, counts = near_copies._common(keyed)
    assert set(near_copies.shingles(passage.encode())) <= set(tokens) and counts.max() > 20
    monkeypatch.setattr(near_copies, "COMMON", 5)
    assert len(near_copies._common(keyed)[0]) <= 5


def test_sets_meet_where_what_they_share_is_interrupted(spark):
    # Two sets share six shingles in a row, and one more after a shingle that one of them has alone.
    rows = [(t, 1, 100, t, 1, [0] * 4, t - 1 if t else None) for t in range(6)] + [(7, 1, 100, 6, 1, [0] * 4, 5)]
    rows += [(t, 2, 100, t, 2, [0] * 4, t - 1 if t else None) for t in range(7)] + [(7, 2, 100, 7, 2, [0] * 4, 6)]
    met = spark.createDataFrame(rows, "token bigint, node bigint, n int, at int, label bigint, folded array<bigint>, before bigint")
    assert [tuple(r) for r in near_copies._pairs(met).collect()] == [(1, 2)] * 2
