import pytest

from quayline.llm import pages, queries, topk, url_filter
from tests.compare import compare, database

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    assert compare(spark, database(SF_DIR), SF_DIR, name, queries.QUERIES[name], queries.ORACLE_SQL[name]) is None


# Top k


def plain_top(rows, k):
    import math

    good = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        w = [math.floor(64 * x) for x in v]
        good[i] = min(good.get(i, w), w)
    out = []
    for q in (i for i in good if i % 20 == 0):
        scores = sorted((-sum(a * b for a, b in zip(good[q], v)), i) for i, v in good.items() if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    return sorted(out)


def test_top_k_equals_plain(spark):
    df = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want = plain_top(rows, 20)
    assert sorted(map(tuple, topk.top_k(df).collect())) == want
    assert sorted(map(tuple, topk.top_k(df, shard_rows=60, leaf=8).collect())) == want


def test_top_k_ties_nulls_and_small_tables(spark):
    rows = [(i, [1.0, 0.5]) for i in range(70)] + [(100, [-1.0, 2.0]), (101, None), (102, [None, 1.0]), (103, [float("nan"), 0.0])]
    rows += [(104, [float("inf"), 0.0]), (None, [1.0, 1.0]), (105, []), (106, [3.0]), (5, [1.0, 0.5]), (120, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("vector", topk.F.lit(1)).withColumn("shard", topk.F.lit(1))
    for shard, leaf in ((8192, 128), (16, 4)):
        assert sorted(map(tuple, topk.top_k(df, shard_rows=shard, leaf=leaf).collect())) == plain_top(rows, 20)
    few = df.where("vec_id in (0, 1, 2)")
    assert sorted(map(tuple, topk.top_k(few).collect())) == plain_top([r for r in rows if r[0] in (0, 1, 2)], 20)
    assert topk.top_k(df.where("false")).count() == 0


# URLs


def test_bloom_filter_has_no_false_negatives_and_join_no_false_positives(spark):
    urls = [(i, f"https://h{i % 37}.org/p{i}") for i in range(3000)]
    listed = spark.createDataFrame([(u + "/?utm_source=a#x",) for i, u in urls if i % 3 == 0] + [(None,)], "url string")
    found = url_filter.filter_urls(spark.createDataFrame(urls, "page_id int, url string"), listed, [])
    rows = found.select("row.page_id", "verdict").collect()
    assert len(rows) == 3000 and all((r.verdict == "block") == (r.page_id % 3 == 0) for r in rows)
    names = listed.select(url_filter.canonical(url_filter.F.col("url")).alias("key"))
    bloom, blocks = url_filter.blocked_bloom(names, "key")
    assert bloom.count() <= blocks <= 1000 / 16 + 1


def test_rules_and_awkward_urls(spark):
    urls = [
        None, "", "no scheme", "http://A.Example.COM/en/x", "http://www.example.com/en/", "http://example.com", "ftp://example.com/fr?q#f",
        "http://badexample.com/en/", "x://net/es/", "x://sub.net/es", "http://é.NET/fr/a#b", "a://b://c/d",
    ]
    df = spark.createDataFrame([(i, u, "a", "b", "c") for i, u in enumerate(urls)], "page_id int, url string, host string, key string, hit string")
    listed = spark.createDataFrame([("http://m.nowhere.org/",)], "url string")
    got = {r[0]: tuple(r[1:]) for r in url_filter.filter_urls(df, listed, queries.RULES).select("row.page_id", "host", "path", "rule", "verdict").collect()}
    assert got == {
        0: ("", "", None, "allow"), 1: ("", "", None, "allow"), 2: ("", "", None, "allow"),
        3: ("a.example.com", "/en/x", "example.com/en/", "block"), 4: ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        5: ("example.com", "", None, "allow"), 6: ("example.com", "/fr", "com/", "allow"),
        7: ("badexample.com", "/en/", "com/", "allow"), 8: ("net", "/es/", "net/es/", "block"), 9: ("sub.net", "/es", None, "allow"),
        10: ("é.net", "/fr/a", "net/fr/", "block"), 11: ("b:", "//c/d", None, "allow"),
    }
    assert url_filter.filter_urls(df.where("false"), listed.where("false"), queries.RULES).count() == 0
    assert url_filter.filter_urls(df, listed.where("false"), []).where("verdict = 'allow'").count() == len(urls)


# Pages

TEMPLATE = (
    "<html><head><title>T</title><style>p{{}}</style><script>var a='<p>x</p>'</script></head><body>"
    "<header>Site</header><nav><ul><li><a href=/>Home</a></li></ul></nav><!-- c --><div>Shared line</div>"
    "<div class='ad'>Buy {0}</div>{1}<aside>More</aside><form>Name <input></form>"
    "<div id=comments><p>Nice</p></div><footer>&copy; {0}</footer></body></html>"
)


def test_page_text(spark):
    rows = [
        (1, "http://h.org/a/1", TEMPLATE.format(1, "<article><h1>One &amp;\n two</h1><p>First <b>bold</b>\t text<p>Second&nbsp;&#233;</article>")),
        (2, "http://h.org/a/2", TEMPLATE.format(2, "<div><p>Other body</p></div>")),
        (3, "http://h.org/b", None), (4, None, ""), (5, "x", "plain <b>text"), (6, "http://h.org/a/2", TEMPLATE.format(2, "<div><p>Other body</p></div>")),
        (None, "http://z.org/", "<main>m</main>"),
    ]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "page_id bigint, url string, html string, host int, range int")
    got = {r.page_id: r.text for r in pages.extract_text(df).collect()}
    assert got == {1: "One & two First bold text Second é", 2: "Other body", 3: "", 4: "", 5: "plain text", 6: "Other body", None: "m"}
    assert pages.extract_text(df.where("false")).count() == 0


def test_neighbours_across_ranges_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(pages, "RANGE_PAGES", 1)
    rows = [(i, f"http://h{i % 3}.org/{i:04d}", f"<div>top {i % 3}</div><div>own {i}</div><div>end</div>") for i in range(200)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "7", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert {r.page_id: r.text for r in pages.extract_text(df).collect()} == {i: f"own {i}" for i in range(200)}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_common_lines():
    a, b = list("xabcay"), list("zabdcaw")
    assert [a[i] for i in sorted(pages.common_lines(a, b))] == list("abca")
    assert pages.common_lines([], ["a"]) == set()
