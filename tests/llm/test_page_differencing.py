import random

import pytest

from quayline.llm import pages
from quayline.llm.common import table

SF_DIR = "/root/testdata/sf0.001"


def plain_common(a, b):
    """Positions in ``a`` on one longest common subsequence, by the full table."""
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    i = j = 0
    found = set()
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            found.add(i)
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return found


def plain_texts(rows):
    """The rule written out over all pages at once: ``rows`` are (page_id, host, path, html)."""
    rows = sorted(rows, key=lambda r: (r[1], r[2], r[0]))
    lines = [[x for x in pages.lines_of(r[3] or "") if x[1] != "f"] for r in rows]
    out = {}
    for i, (page_id, host, path, _) in enumerate(rows):
        partners = []
        for order in (range(i - 1, -1, -1), range(i + 1, len(rows))):
            other = next((j for j in order if rows[j][1] != host or lines[j] != lines[i]), None)
            if other is not None and rows[other][1] == host:
                partners.append(other)
        reach = {j: next((n for n, (x, y) in enumerate(zip(path, rows[j][2])) if x != y), min(len(path), len(rows[j][2]))) for j in partners}
        partners.sort(key=lambda j: (-reach[j], j > i))
        own = [t for t, _ in lines[i]]
        shared = [plain_common(own, [t for t, _ in lines[j]]) for j in partners]
        article = {k for k, (_, z) in enumerate(lines[i]) if z == "a"}
        left = [[t for k, t in enumerate(own) if k in article or k not in s] for s in shared]
        out[page_id] = " ".join(next(filter(None, left), own))
    return out


def extract(spark, rows):
    df = spark.createDataFrame([(i, f"http://{h}{p}", t) for i, h, p, t in rows], "page_id bigint, url string, html string")
    return {r.page_id: r.text for r in pages.extract_text(df).collect()}


def made_pages():
    """Three hosts with their templates, runs of copies and near copies, quotes shared by two articles."""
    rng, rows = random.Random(7), []
    for h, n in (("a.org", 90), ("b.org", 40), ("c.org", 3)):
        frame = [f"{h} template {i}" for i in range(12)]
        for i in range(n):
            body = [f"own {h} {i} {k}" for k in range(rng.randint(1, 6))]
            if 20 <= i < 60:
                body = [f"one article of {h}"]  # a run of copies that differ in named zones only
            if i % 11 == 0:
                body.append("passage that two pages quote")
            tag = rng.choice(("div", "article", "section"))
            ad = f"<div class='ad'>buy {i}</div>"
            page = "".join(f"<p>{t}</p>" for t in frame[:8]) + ad + f"<{tag}>" + "".join(f"<p>{t}</p>" for t in body) + f"<p>Read more</p></{tag}>"
            rows.append((len(rows), h, f"/{i // 7}/{i:03d}", page + "".join(f"<div>{t}</div>" for t in frame[8:])))
    return rows


@pytest.mark.parametrize("tasks", ["1", "5", "30"])
def test_equals_the_rule_written_out_however_pages_are_dealt(spark, monkeypatch, tasks):
    monkeypatch.setattr(pages, "RANGE_PAGES", 1)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", tasks)
    try:
        rows = made_pages()
        assert extract(spark, rows) == plain_texts(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_ranges_follow_the_bytes(spark, monkeypatch):
    monkeypatch.setattr(pages, "RANGE_BYTES", 3_000)
    rows = made_pages()
    assert extract(spark, rows) == plain_texts(rows)


def test_given_pages_equal_the_rule_written_out(spark):
    given = table(spark, SF_DIR, "pages")
    rows = given.select("page_id", pages.host(given.url).alias("h"), pages.path(given.url).alias("p"), "html").collect()
    got = {r.page_id: r.text for r in pages.extract_text(given).collect()}
    assert got == plain_texts([tuple(r) for r in rows])


def test_long_template_goes(spark):
    template = "".join(f"<p>template line {i} of the site, quite long</p>" for i in range(30))
    rows = [(i, "t.org", f"/p/{i}", f"{template}<div>own line {i}</div>") for i in range(4)]
    assert extract(spark, rows) == {i: f"own line {i}" for i in range(4)}


@pytest.mark.parametrize("name", ["post-content has-sidebar", "social-studies", "notice-of-motion", "header-image-post content", "research", "adventure"])
def test_blocks_with_names_that_only_begin_alike_stay(spark, name):
    rows = [(i, "n.org", f"/{i}", f"<div>Site</div><div class='{name}'><p>body {i}</p></div>") for i in range(3)]
    assert extract(spark, rows) == {i: f"body {i}" for i in range(3)}


@pytest.mark.parametrize(
    "name", ["ad", "ads top", "site-header", "cookie-banner", "comments", "comment-list", "left_sidebar", "relatedPosts", "ad-slot-3", "newsletter-signup", "main-nav", "share-buttons"]
)
def test_named_blocks_go(spark, name):
    rows = [(i, "n.org", f"/{i}", f"<div class='{name}'>differs {i}</div><div><p>body {i}</p></div>") for i in range(3)]
    assert extract(spark, rows) == {i: f"body {i}" for i in range(3)}


def test_reader_comments_that_are_articles_go(spark):
    rows = [(1, "c.org", "/1", "<article><p>body</p></article><article class='comment'><p>I agree</p></article>")]
    assert extract(spark, rows) == {1: "body"}


def test_one_article_under_several_urls_stays(spark):
    body = "<article><p>the long article that three addresses carry</p><p>version {0}</p></article>"
    rows = [(i, "v.org", f"/{i}", f"<div>Site</div>{body.format(i)}") for i in range(3)]
    assert extract(spark, rows) == {i: f"the long article that three addresses carry version {i}" for i in range(3)}


def test_passages_that_articles_share_stay(spark):
    rows = [(i, "q.org", f"/{i}", f"<div>Site</div><article><p>own {i}</p><p>shared passage</p></article>") for i in range(5)]
    assert extract(spark, rows) == {i: f"own {i} shared passage" for i in range(5)}


def test_given_articles_come_back_whole(spark):
    given = table(spark, "/root/testdata/sf0.1", "pages")
    got = pages.extract_text(given)
    lines = {r.page_id: " ".join(t for t, z in pages.lines_of(r.html or "") if z == "a") for r in given.select("page_id", "html").collect()}
    assert {r.page_id: r.text for r in got.collect()} == lines


def test_very_long_page_and_common_lines():
    rng = random.Random(3)
    for _ in range(200):
        a, b = (rng.choices("abcdef", k=rng.randint(0, 12)) for _ in "ab")
        found = pages.common_lines(a, b)
        assert len(found) == len(plain_common(a, b))
        rest = iter(b)
        assert all(a[i] in rest for i in sorted(found))
    lines = [(f"line {i}", "o") for i in range(50_000)]
    one = {"lines": lines + [("own", "o")], "host": "h", "path": "/a"}
    assert pages.main_text(one, [{"lines": lines, "host": "h", "path": "/b"}]) == "own"
