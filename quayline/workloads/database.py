"""What goes to and comes from a database, over the given tables."""

import uuid

from pyspark.sql import functions as F

from quayline import functions as C
from quayline.operators.paging import key_stats, plan_pages
from quayline.sinks.jdbc import jdbc_projection
from quayline.sources.jdbc import as_read, histogram_sql, stats_sql
from quayline.workloads.registry import query


def _view(df, label):
    """The table under a name of its own, so that statements meant for a database run here."""
    name = f"{label}_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(name)
    return f"`{name}`"


@query(
    """SELECT min(o_orderkey) AS min_key, max(o_orderkey) AS max_key, count(*) AS row_count,
              count(*) - count(o_orderkey) AS null_keys
       FROM (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS o_orderkey FROM orders)"""
)
def database_key_stats_orders(t):
    keys = t["orders"].select(F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("o_orderkey"))
    return t.spark.sql(stats_sql(_view(keys, "orders"), "o_orderkey"))


@query(
    """WITH s AS (SELECT min(l_orderkey) AS lo FROM lineitem)
       SELECT (l_orderkey - lo) // 500 AS page, count(*) AS row_count FROM lineitem, s GROUP BY 1"""
)
def database_page_counts_lineitem(t):
    lineitem = t["lineitem"]
    pages = plan_pages(key_stats(lineitem.select("l_orderkey"), "l_orderkey"), step=500)
    return t.spark.sql(histogram_sql(_view(lineitem, "lineitem"), "l_orderkey", pages))


@query(
    """SELECT event_id, ts, '{"k":"' || json_extract_string(props, '$.k') || '"}' AS props,
              '["' || event_type || '",null]' AS tags FROM events"""
)
def database_rows_events(t):
    rows = t["events"].select(
        "event_id",
        "ts",
        C.json_to_map(F.col("props")).alias("props"),
        F.array("event_type", F.lit(None).cast("string")).alias("tags"),
    )
    return jdbc_projection(rows)


@query(
    """SELECT l_orderkey,
              CAST(ceil(CAST(l_extendedprice * l_discount AS DECIMAL(18, 4)) * 100) / 100 AS DECIMAL(14, 2)) AS saved FROM lineitem"""
)
def database_decimals_lineitem(t):
    saved = (F.col("l_extendedprice") * F.col("l_discount")).cast("decimal(18,4)")
    return as_read(t["lineitem"].select("l_orderkey", saved.alias("saved")), {"saved": (14, 2)})


@query("SELECT event_id, date_trunc('milliseconds', ts) AS ts, user_id, value FROM events")
def database_values_events(t):
    return as_read(t["events"].select("event_id", "ts", "user_id", "value"))
