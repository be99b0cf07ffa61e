"""Each operator against a plain version of its contract, over awkward tables and the given ones."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from quayline.llm import decontaminate, language, mixing, quality, queries, repeats, simhash, token_files
from quayline.session import scratch_path
from tests.llm.conftest import documents, words

SF_DIR = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def given(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# SimHash


def plain_fingerprint(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    if not found:
        return 0
    grams = [" ".join(found[i : i + 3]) for i in range(max(1, len(found) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(fps))]


def check_simhash(df):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    fps = [plain_fingerprint(t) for _, t in rows]
    groups = plain_components(fps)
    smallest = {}
    for (i, _), g in zip(rows, groups):
        smallest[g] = min((x for x in (smallest.get(g), i) if x is not None), default=None)
    want = sorted(((i, f"{f:016x}", smallest[g]) for (i, _), f, g in zip(rows, fps, groups)), key=str)
    found = simhash.near_duplicates(df).collect()
    got = sorted(((r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id) for r in found), key=str)
    assert got == want


def test_simhash_equals_plain(spark, docs, clashing, no_docs):
    check_simhash(docs)
    check_simhash(clashing)
    check_simhash(given(spark, "documents"))
    assert simhash.near_duplicates(no_docs).count() == 0


def test_simhash_chain_is_one_component(spark):
    values = [0]
    for b in range(0, 40, 2):
        values.append(values[-1] ^ (3 << b))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp bigint"))
    labels = simhash.connected_components(links)
    assert {r.label for r in labels.collect()} == {min(signed)} and labels.count() == len(values)


def test_simhash_links_are_bounded_by_the_ball(spark):
    df = spark.createDataFrame([(1 << b,) for b in range(40)], "fp bigint")
    assert simhash.links(df).count() <= 40 * 65
    with pytest.raises(ValueError):
        simhash.links(df, 3)


def test_keep_one_row_of_each_group(docs, clashing, no_docs):
    for df in (docs, clashing):
        kept = simhash.keep_one(df)
        assert kept.columns == df.columns
        fps = [plain_fingerprint(r.text) for r in kept.collect()]
        groups = plain_components([plain_fingerprint(t) for _, t, *_ in documents()])
        assert len(fps) == len(set(groups)) and len(set(plain_components(fps))) == len(fps)
    assert simhash.keep_one(no_docs).count() == 0


# Repeats


def plain_repeats(texts, length=100):
    seen, out = set(), []
    for t in texts:
        gone = np.zeros(len(t), dtype=bool)
        for j in range(len(t) - length + 1):
            s = t[j : j + length]
            if s in seen:
                gone[j : j + length] = True
            seen.add(s)
        edges = np.diff(np.concatenate(([0], gone.astype(int))))
        rest = np.frombuffer(t, dtype=np.uint8)[~gone].tobytes()
        out.append((len(t), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(rest).hexdigest()))
    return out


def check_repeats(df, **options):
    rows = sorted(
        ((r.doc_id, (r.text or "").encode()) for r in df.select("doc_id", "text").collect()),
        key=lambda r: (r[0] is None, r[0] or 0, r[1]),
    )
    want = sorted(((i, *w) for (i, _), w in zip(rows, plain_repeats([t for _, t in rows]))), key=str)
    found = repeats.find_repeats(df, **options).collect()
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in found), key=str)
    assert got == want


def test_repeats_equal_plain(spark, docs, clashing, no_docs):
    check_repeats(docs)
    check_repeats(clashing)
    assert repeats.find_repeats(no_docs).count() == 0
    check_repeats(given(spark, "documents"))


def test_repeats_within_and_across(spark):
    shared = words(9, 60)
    rows = [(i, f"{words(100 + i, 20)} {shared} {words(300 + i, 20)}") for i in range(30)]
    rows += [(50, "ab" * 400), (51, "b" + "ab" * 60), (52, shared[:99]), (53, shared[1:101]), (54, "x" * 300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    check_repeats(df)
    check_repeats(df, crowded=3)  # by way of hashed strings


def test_merge_of_transforms_equals_one_sort():
    rng = np.random.default_rng(3)
    for _ in range(10):
        texts = [bytes(rng.integers(97, 99, rng.integers(1, 30)).astype(np.uint8)) for _ in range(25)]
        row, place = repeats.first_starts(texts, np.arange(25), np.zeros(25, dtype=np.int64), 5, shard_bytes=64)
        seen = {}
        for i, t in enumerate(texts):
            for j in range(len(t) - 4):
                seen.setdefault(t[j : j + 5], (i, j))
        assert sorted(zip(row.tolist(), place.tolist())) == sorted(seen.values())


# Decontamination


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def check_contamination(df, items):
    windows = {}
    for item, text in items:
        w = plain_words(text)
        for i in range(max(1, len(w) - 9)) if w else ():
            windows.setdefault(tuple(w[i : i + 10]), set()).add(str(item))
    want = []
    for r in df.select("doc_id", "text").collect():
        w, hit, found = plain_words(r.text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                named = windows.get(tuple(w[i : i + n]))
                if named:
                    hit.update(range(i, i + n))
                    found |= named
        want.append((r.doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    bench = df.sparkSession.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.digest(decontaminate.find_contamination(df, bench)).collect()
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)


ITEMS = [(1, words(2, 30)), (2, "one"), (3, "Two, one"), (4, None), (5, ""), (6, words(5, 12)), (6, words(5, 12)), (7, words(3, 10)), (10, "é" * 150)]


def test_contamination_equals_plain(spark, docs, clashing, no_docs):
    check_contamination(docs, ITEMS)
    check_contamination(clashing, ITEMS)
    check_contamination(docs, [])
    items = [(r.item_id, r.text) for r in given(spark, "benchmark").collect()]
    check_contamination(given(spark, "documents"), items)
    assert decontaminate.find_contamination(no_docs, given(spark, "benchmark")).count() == 0


def test_contamination_in_several_blocks(docs, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 60)
    check_contamination(docs, ITEMS)


def test_spans_are_cut_out(spark):
    phrase = words(1, 15)
    rows = [(1, f"Before: {phrase}! After.", "en", "s", 0), (2, phrase, "en", "s", 0), (3, None, None, None, None), (4, "clean", "en", "s", 5)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    items = spark.createDataFrame([(1, phrase)], "item_id bigint, text string")
    named = df.withColumn("n_chars", queries.F.lit("many"))
    assert {r.n_chars for r in decontaminate.remove_spans(named, items).collect()} == {"many"}
    kept = decontaminate.remove_spans(df, items)
    assert sorted(map(tuple, kept.collect())) == [(1, "Before: ! After.", "en", "s", 16), (3, None, None, None, None), (4, "clean", "en", "s", 5)]


def test_fm_index_counts_and_locates():
    rng = np.random.default_rng(1)
    seq = rng.integers(0, 4, 300)
    index = decontaminate.FMIndex(seq, 4)
    phrases = rng.integers(0, 4, (40, 3))
    for phrase, lo, hi in zip(phrases, *index.search(phrases)):
        want = [i for i in range(298) if (seq[i : i + 3] == phrase).all()]
        assert sorted(index.locate(np.arange(lo, hi))) == want


# Token files


def check_tokens(spark, df):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    rows = [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]
    manifest = token_files.write_tokens(df, VOCABULARY, scratch_path(spark, "tokens"))
    found = token_files.read_tokens(spark, manifest).collect()
    want, start = {}, 0
    for i, t in rows:
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 2], dtype="<u4")
        want.setdefault(i, []).append((len(ids), zlib.crc32(ids.tobytes())))
    order = sorted(found, key=lambda r: r.start)
    assert [r.doc_id for r in order] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    for r in order:
        assert r.start == start
        want[r.doc_id].remove((r.n_tokens, r.ids_crc32))
        start += r.n_tokens
    assert not any(want.values())


def test_token_files_round_trip(spark, docs, clashing, no_docs):
    check_tokens(spark, docs)
    check_tokens(spark, clashing)
    check_tokens(spark, given(spark, "documents"))
    manifest = token_files.write_tokens(no_docs, VOCABULARY, scratch_path(spark, "tokens"))
    assert token_files.read_tokens(spark, manifest).count() == 0


def test_word_cache_equals_whole_texts(monkeypatch):
    with open(VOCABULARY, encoding="utf-8") as f:
        encoder = token_files.Encoder(f.read())
    tokenizer = Tokenizer.from_file(VOCABULARY)
    texts = ["a  b", "a\n\n b ", " it's  don't!", "x\u00a0 y  z", "\x1c! \x1c", "<|endoftext|> a<|endoftext|>", "naïve,«x».", "１２a3", "tab\t\tb", "a_b-c", "“q”. 'll", "\u2003 a", "é.è"]
    texts += ["", "x" * 100 + " " + "x" * 100] + [f"w{i % 7} v{i}" for i in range(40)]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(b, dtype=encoder.kind).tolist() for b in encoder(texts)] == want
    assert not any(len(w) > token_files.LONGEST for w in encoder.cache)
    # Small generations and batches: words come and go.
    monkeypatch.setattr(token_files, "CACHED", 9)
    monkeypatch.setattr(token_files, "TOGETHER", 12)
    assert [np.frombuffer(b, dtype=encoder.kind).tolist() for b in encoder(iter(texts * 2))] == want * 2
    assert len(encoder.cache) <= 20 and encoder.old


def test_words_are_cut_and_encoded_together(monkeypatch):
    with open(VOCABULARY, encoding="utf-8") as f:
        encoder = token_files.Encoder(f.read())
    tokenizer = Tokenizer.from_file(VOCABULARY)
    parts = [" ", "   ", "\n", "\t", "a", "b's", "'re", "\u00e9", "\u00d7", "\u00f7", "\u024f", "\u0250", ",", "(", "12", "\u4e2d\u6587", "\u2026", "\U0001f600", "\xa0", "_", "word", "\x00", "\u00b2"]
    rng = random.Random(11)
    texts = ["".join(rng.choices(parts, k=rng.randrange(25))) for _ in range(3000)]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    asked, encode = [], encoder._encode
    monkeypatch.setattr(encoder, "_encode", lambda some: asked.append(len(some)) or encode(some))
    assert [np.frombuffer(b, dtype=encoder.kind).tolist() for b in encoder(texts)] == want
    # One call of the library's for each text with other white space, else for many words, joined to texts.
    fresh = [f"{a}{b}" for a in "abcdefgh" for b in range(500)]
    asked.clear()
    assert len(list(encoder([" " + " ".join(fresh)]))) == 1 and sum(asked) <= len(fresh) // 100


# Language


def test_language_on_held_out_rows(spark):
    found = queries.QUERIES["op4_language"](spark, "/root/testdata/sf0.01")
    rows = found.join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 150 and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.96
    assert sum(r.rejected for r in held) / len(held) < 0.03


def test_language_of_awkward_rows(docs, clashing, no_docs):
    dictionaries = language.train(docs)
    assert set(dictionaries) == {"en", "de", "fr"}
    assert language.train(clashing) == dictionaries
    for df in (docs, clashing):
        found = language.identify(df, dictionaries).collect()
        assert len(found) == len(documents())
        for i in (5, 6, 7, 8):
            assert [(r.lang_pred, r.score, r.rejected) for r in found if r.doc_id == i] == [("und", 0.0, True)]
        assert language.keep_identified(df, dictionaries).columns == df.columns
    assert language.train(no_docs) == {}
    assert {r.lang_pred for r in language.identify(docs, {}).collect()} == {"und"}
    assert language.identify(no_docs, dictionaries).count() == 0


# Quality


def test_quality_on_held_out_rows(spark):
    found = queries.QUERIES["op1_quality_rules"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = found.where("held_out").join(labels, "doc_id").collect()
    assert found.count() == 1000
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.9


def test_rules_compile_to_columns(spark, docs, clashing, no_docs):
    rng = np.random.default_rng(5)
    x = rng.random((600, len(quality.STATISTICS)))
    y = ((x[:, 0] > 0.5) & (x[:, 3] <= 0.7)).astype(float)
    model = quality.fit(x, y)
    assert model.rules and ((model.predict(x) > 0.5) == y).mean() > 0.97
    df = spark.createDataFrame(x.tolist(), quality.STATISTICS)
    scores = [r.s for r in df.select(model.column().alias("s")).collect()]
    assert np.allclose(scores, model.predict(x))
    for some in (docs, clashing):
        scored = quality.score(some, model).collect()
        assert len(scored) == len(documents()) and all(0 <= r.score <= 1 for r in scored)
    assert quality.score(no_docs, model).count() == 0


def test_quality_without_both_classes(spark, docs, clashing):
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, None), (None, 0)], "doc_id bigint, quality int")
    model = quality.train(docs, labels)
    again = quality.train(clashing, labels.withColumn("text", labels.quality))
    assert (again.bias, again.rules) == (model.bias, model.rules)
    assert not model.rules and 0.5 < float(model.predict(np.zeros((1, len(quality.STATISTICS))))[0]) < 1
    assert quality.train(docs, labels.where("false")).predict(np.zeros((1, 1)))[0] == 0.5


# Mixing


def test_mixing_meets_its_targets(spark):
    docs = given(spark, "documents")
    rows = mixing.mix(docs, {"lang": {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}}, rounds=8).collect()
    assert len(rows) == docs.count() and max(r.probability for r in rows) == 1
    kept = {}
    for r in rows:
        kept[r.lang] = kept.get(r.lang, 0) + r.n_tokens * r.probability
    total = sum(kept.values())
    assert {k: round(v / total, 2) for k, v in kept.items()} == {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}


def test_mixing_awkward_rows(docs, clashing, no_docs):
    for df in (docs, clashing):
        rows = mixing.mix(df).collect()
        assert len(rows) == len(documents()) and all(0 <= r.probability <= 1 for r in rows)
        kept = mixing.sample(df)
        assert kept.columns == df.columns and kept.count() == sum(r.selected for r in rows)
    assert mixing.mix(no_docs).count() == 0
