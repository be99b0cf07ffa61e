import hashlib
import math
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quayline.llm import clusters, hard_negatives, queries, token_counts

SF_DIR = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

# Token counts


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)


@pytest.fixture(scope="module")
def counter():
    with open(VOCABULARY, encoding="utf-8") as f:
        return token_counts.PrefixCounter(f.read())


def plain_counts(tokenizer, text):
    return [len(tokenizer.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)]


PARTS = ["a", "b", " ", "  ", "\n", "'", "s", "re", "ll", "!", "<|endoftext|>", "<|end", "é", "漢", "1", "22", "the", "ing", "\t", "😀", "\xa0", " ", "-", "--", "A", "\x1c", "ß", "½"]


def test_every_prefix_counts_as_the_tokenizer_counts_it(counter, tokenizer):
    rng = random.Random(3)
    texts = ["", "don't we'll they're 'ra 'r 're x''s !'t", "a  b   c\n\n d \n", "a" * 60, "=" * 90, " " * 70 + "x", "日本語のテキスト、漢字", "I'VE '  's"]
    texts += ["".join(rng.choices(PARTS, k=rng.randint(1, 14))) for _ in range(1500)]
    for text in texts:
        want = plain_counts(tokenizer, text)
        assert counter.prefixes(text).tolist() == want, text
        assert counter.total(text) == want[-1]
        for budget in (0, 1, 3, 8):
            best = max(k for k, c in enumerate(want) if c <= budget)
            assert counter.longest(text, budget) == (best, want[best]), (text, budget)
        assert token_counts.unpack(token_counts.pack(counter.prefixes(text))).tolist() == want


def test_each_token_is_its_own_encoding(counter, tokenizer):
    """What the step from a prefix to a token that spans it all rests on."""
    for text, (_, token) in zip(counter.tokens.keys(), counter.tokens.values()):
        one, two = counter.left[token], counter.right[token]
        assert one < 0 or not counter.stay_apart(one, two), text


def test_words_are_kept_in_two_generations(counter, monkeypatch):
    monkeypatch.setattr(token_counts, "CACHED", 5)
    words = token_counts._Counts(counter.words.count)
    texts = [f" w{i % 13}" for i in range(100)]
    assert [words[t] for t in texts] == [counter.words[t] for t in texts] and len(words) <= 5 and len(words.old) <= 5


def test_token_counts_of_awkward_documents(spark, docs, clashing, no_docs, tokenizer):
    want = sorted((r.doc_id or 0, len((r.text or "").encode()), len(tokenizer.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect())
    for table in (docs, clashing):
        rows = token_counts.count_tokens(table, VOCABULARY, limit=9).collect()
        assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in rows) == want
        assert all(r.over_limit == (r.n_tokens > 9) and r.kept_tokens <= 9 for r in rows)
    assert token_counts.count_tokens(no_docs, VOCABULARY).count() == 0
    assert token_counts.prefix_tables(no_docs, VOCABULARY).count() == 0
    stored = token_counts.prefix_tables(docs, VOCABULARY)
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in stored.collect()) == want


def test_stored_tables_answer_without_texts(spark, tokenizer):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("n_chars < 400")
    texts = {r.doc_id: r.text for r in docs.collect()}
    tables = token_counts.prefix_tables(docs, VOCABULARY)
    for r in token_counts.truncate(tables, [5, 10_000]).collect():
        want = plain_counts(tokenizer, texts[r.doc_id]) if r.budget == 5 else None
        if want:
            best = max(k for k, c in enumerate(want) if c <= 5)
            assert (r.kept_chars, r.kept_tokens) == (best, want[best])
        else:
            assert r.kept_chars == len(texts[r.doc_id])
    asked = spark.createDataFrame([(i, at) for i in texts for at in (0, 7, 10**6, -1, None)], "doc_id long, chars long")
    for r in token_counts.span_tokens(tables, asked).collect():
        if r.chars is None:
            assert r.tokens is None
        else:
            assert r.tokens == len(tokenizer.encode(texts[r.doc_id][: max(r.chars, 0)], add_special_tokens=False).ids)
    with pytest.raises(ValueError):
        token_counts.truncate(tables, [-1])


def test_op11_equals_the_library(spark, tokenizer):
    rows = queries.QUERIES["op11_token_counts"](spark, SF_DIR).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        n = len(tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 512)
        held = len(tokenizer.encode(texts[r.doc_id][: r.kept_chars], add_special_tokens=False).ids)
        assert held == r.kept_tokens <= 512 and (r.kept_chars == len(texts[r.doc_id])) == (n <= 512)


def test_other_kinds_of_vocabulary_are_refused():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f, pytest.raises(ValueError):
        token_counts.PrefixCounter(f.read())


# Clusters


def plain_kmeans(rows, k, rounds, width, scale):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(scale * x) for x in v]))
    key = lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centres = [v for _, v in sorted(kept, key=key)[:k]]
    if not centres:
        return []

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        at = [nearest(v)[1] for _, v in kept]
        for j in range(len(centres)):
            own = [v for (_, v), c in zip(kept, at) if c == j]
            if own:
                centres[j] = [sum(x) // len(own) for x in zip(*own)]
    found = [nearest(v) for _, v in kept]
    sums = {}
    for d, j in found:
        sums[j] = sums.get(j, 0) + d
    total = sum(sums.values())
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted((str(i), j, d, sums[j], total, digest[j]) for (i, _), (d, j) in zip(kept, found))


def got_clusters(df, **settings):
    return sorted((str(r[0]), *r[1:]) for r in clusters.cluster(df, **settings).summary().collect())


def test_clusters_equal_plain_ones(spark):
    df = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert got_clusters(df) == plain_kmeans(rows, 40, 5, 64, 256)
    assert got_clusters(df.repartition(3), k=7, rounds=9) == plain_kmeans(rows, 7, 9, 64, 256)


def test_clusters_of_awkward_vectors(spark):
    rng = random.Random(2)
    rows = [(i, [float(rng.randint(-3, 3)), float(rng.randint(-3, 3))]) for i in range(120)]
    rows += [(i, [1.0, 1.0]) for i in range(200, 260)] + [(7, [0.0, 0.0]), (7, [0.0, 0.0]), (None, [2.0, -1.0]), (None, [0.5, 0.25])]
    rows += [(300, None), (301, [None, 1.0]), (302, [float("nan"), 0.0]), (303, [float("inf"), 0.0]), (304, [1.0]), (305, []), (306, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    df = df.withColumn("vector", clusters.F.lit("x")).withColumn("cluster", clusters.F.lit(1)).withColumn("first", clusters.F.lit(None))
    for k, rounds in ((1, 2), (2, 3), (13, 6), (500, 1)):
        assert got_clusters(df, k=k, rounds=rounds, width=2, scale=2) == plain_kmeans(rows, k, rounds, 2, 2)
    assert got_clusters(df.where("false"), width=2) == []
    assert got_clusters(df.where("vec_id = 300"), width=2) == []
    with pytest.raises(Exception, match="too large"):
        got_clusters(spark.createDataFrame([(1, [1e9, 0.0])], "vec_id bigint, embedding array<double>"), width=2)


def test_bounds_save_most_distances():
    rng = np.random.default_rng(1)
    centres = rng.integers(-5000, 5000, (40, 8))
    x = (centres[rng.integers(0, 40, 4000)] + rng.integers(-150, 150, (4000, 8))).astype(np.int64)
    state = {
        "first": np.zeros(4000, dtype=np.int32), "second": np.ones(4000, dtype=np.int32),
        "upper": np.full(4000, np.inf), "lower": np.zeros(4000), "distance": np.full(4000, -1, dtype=np.int64),
    }
    now, before, taken = x[:40].copy(), None, 0
    for _ in range(8):
        taken += clusters.assign(x, state, clusters.Centroids(now, before))
        every = ((x[:, None, :] - now) ** 2).sum(axis=2)
        assert (state["first"] == every.argmin(axis=1)).all() and (state["distance"] == every.min(axis=1)).all()
        before, now = now, now.copy()
        for c in range(40):
            if (state["first"] == c).any():
                now[c] = x[state["first"] == c].sum(axis=0) // (state["first"] == c).sum()
    assert taken < 0.35 * 8 * 40 * 4000


# Hard negatives


def plain_mine(rows, every=50, positives=5, negatives=3, scale=256):
    good = {}
    for i, v, y in rows:
        if None in (i, v, y) or any(x is None or not math.isfinite(x) for x in v):
            continue
        w = (y, [math.floor(scale * x) for x in v])
        good[i] = min(good.get(i, w), w)
    out = []
    for a, (y, v) in good.items():
        if a % every:
            continue
        score = {i: sum(p * q for p, q in zip(v, w)) for i, (_, w) in good.items() if i != a}
        best = sorted((i for i in score if good[i][0] == y), key=lambda i: (-score[i], i))[:positives]
        for p in best:
            fit = [i for i in score if good[i][0] != y and 50 * score[p] <= 100 * score[i] <= 95 * score[p]]
            for rank, n in enumerate(sorted(fit, key=lambda i: (-score[i], i))[:negatives], 1):
                out.append((a, p, rank, n, score[p], score[n]))
    return sorted(out)


def test_hard_negatives_equal_plain_ones(spark):
    df = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    want = plain_mine(rows)
    assert want and sorted(map(tuple, hard_negatives.mine(df).collect())) == want
    small = hard_negatives.mine(df, every=3, block_rows=7, shard_rows=40)
    assert sorted(map(tuple, small.collect())) == plain_mine(rows, every=3)


def test_hard_negatives_of_awkward_rows(spark):
    rng = random.Random(4)
    rows = [(i, [float(rng.randint(-2, 4)), float(rng.randint(-2, 4))], rng.randint(0, 3)) for i in range(160)]
    rows += [(i, [1.0, 2.0], 9) for i in range(200, 240)] + [(3, [0.0, 0.0], 1), (3, [0.0, 0.0], 1), (None, [1.0, 1.0], 1), (400, [1.0, 1.0], None)]
    rows += [(401, None, 1), (402, [None, 1.0], 1), (403, [float("nan"), 0.0], 1), (404, [float("-inf"), 0.0], 1), (405, [], 1), (406, [2.0], 2), (450, [3.0, 1.0], 77)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    df = df.withColumn("vector", hard_negatives.F.lit(1)).withColumn("shard", hard_negatives.F.lit(1)).withColumn("part", hard_negatives.F.lit("p"))
    want = plain_mine(rows, every=10, scale=2)
    for block, shard in ((256, 8192), (3, 20)):
        found = hard_negatives.mine(df, every=10, scale=2, block_rows=block, shard_rows=shard)
        assert sorted(map(tuple, found.collect())) == want
    for none in ("false", "vec_id % 10 <> 0", "vec_id = 10"):
        assert hard_negatives.mine(df.where(none), every=10, scale=2).count() == 0
    with pytest.raises(Exception, match="too large"):
        hard_negatives.mine(spark.createDataFrame([(0, [1e8], 1), (1, [1e8], 1)], "vec_id int, embedding array<double>, label int")).collect()


def test_tree_bounds_leave_far_rows_alone():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(30, 16)) * 4000
    own = rng.integers(0, 30, 3000)
    vectors = np.floor(centres[own] + rng.normal(size=(3000, 16)) * 40)
    ids, labels = np.arange(3000), own % 10
    picked = np.argsort(own[:256], kind="stable")
    block = hard_negatives.Block(ids[:256][picked], labels[:256][picked], vectors[:256][picked])
    shard = hard_negatives.Shard(ids, labels, vectors)
    found = list(hard_negatives.positives(block, shard, 5))
    score = vectors[:256] @ vectors.T
    for a in range(256):
        rows = [i for i in np.flatnonzero(labels == labels[a]) if i != a]
        best = sorted(rows, key=lambda i: (-score[a, i], i))[:5]
        assert [(i, s) for b, i, s in found if b == a] == [(i, int(score[a, i])) for i in best]
    assert shard.scored < 0.2 * score.size
    # Edges of the tree are as short as can be.
    d = np.sqrt(((block.vectors[:, None] - block.vectors) ** 2).sum(axis=2))
    inside, total = [0], 0.0
    while len(inside) < 256:
        left = [i for i in range(256) if i not in inside]
        cut = d[np.ix_(inside, left)]
        total += cut.min()
        inside.append(left[int(cut.min(axis=0).argmin())])
    assert abs(total - block.edge.sum()) < 1e-6 * total
