"""Queries whose work once met in one place: a file in one row, pages in one list."""

import re

from quayline.workloads import binary, paging


def test_lines_are_joined_at_chunk_ends_only(spark):
    text = "h\nfirst line\n\nzweite Zeile é日本\n" + "x" * 40 + "\nlast"
    data = text.encode()
    want = sorted(x for x in text.split("\n") if x not in ("", "h"))
    for size in (1, 2, 3, 7, 16, 64, 500):
        chunks = [(p, i // size, bytearray(data[i : i + size])) for p in ("a", "b") for i in range(0, len(data), size)]
        raw = spark.createDataFrame(chunks, "path string, chunk_no bigint, binary_data binary")
        lines = binary._lines(raw, "h")
        assert sorted(r.line for r in lines.collect()) == sorted(want * 2)
    # No aggregate gathers a whole file.
    assert not re.search(r"Aggregate \[path#\d+\]", lines._jdf.queryExecution().optimizedPlan().toString())


def test_small_steps_need_no_list_of_pages(spark):
    keys = spark.createDataFrame([(5,), (6,), (7,), (50_000_005,)], "l_orderkey bigint")
    rows = paging.small_step_pages_lineitem({"lineitem": keys}).collect()
    assert sorted(map(tuple, rows)) == [(0, 2), (1, 1), (25_000_000, 1)]
    assert paging.small_step_pages_lineitem({"lineitem": keys.where("false")}).count() == 0
