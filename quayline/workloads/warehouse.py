"""Partitioned tables over the given tables."""

import uuid
from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayline.operators.columns import align_to_table, resolve_case_insensitive
from quayline.sinks.warehouse import create_table, write_partitions, write_table
from quayline.sources.warehouse import read_table
from quayline.workloads.registry import query


def _name(label):
    return f"{label}_{uuid.uuid4().hex}"


def _partitioned_events(t):
    name = _name("events")
    create_table(t.spark, name, t["events"].schema, "event_type=any", t.path("events"))
    write_partitions(t["events"], name)
    return name


@query("SELECT event_id, value, event_type FROM events WHERE event_type = 'click'")
def partition_read_events(t):
    return read_table(
        t.spark, _partitioned_events(t), ["event_id", "value", "event_type"], partition_spec="event_type=click"
    )


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def partition_roundtrip_events(t):
    return read_table(t.spark, _partitioned_events(t))


@query(
    """SELECT event_id, value, event_type FROM events WHERE event_type <> 'click'
       UNION ALL SELECT event_id, -value, event_type FROM events WHERE event_type = 'view'
       UNION ALL SELECT event_id, value, event_type FROM events WHERE 1 = 0"""
    .replace("event_type <> 'click'", "event_type NOT IN ('click', 'view')")
)
def partition_overwrite_events(t):
    name = _partitioned_events(t)
    events = t["events"]
    view = events.where(F.col("event_type") == "view").withColumn("value", -F.col("value"))
    write_table(view, name, "event_type=view", create=False)
    # No rows: the partition is emptied, the others stay.
    write_table(events.where(F.lit(False)), name, "event_type=click", create=False)
    return read_table(t.spark, name, ["event_id", "value", "event_type"])


@query("SELECT o_orderkey, o_totalprice, '020' AS dt, o_orderstatus FROM orders")
def partition_text_keys_orders(t):
    name, where = _name("orders"), t.path("orders")
    orders = t["orders"].select("o_orderkey", "o_totalprice", "o_orderstatus")
    statuses = [r[0] for r in orders.select("o_orderstatus").distinct().collect()]
    for status in statuses:
        rows = orders.where(F.col("o_orderstatus") == status)
        write_table(rows, name, f"dt=020/o_orderstatus={status}", location=where)
    wanted = ["o_orderkey", "o_totalprice", "dt", "o_orderstatus"]
    parts = [read_table(t.spark, name, wanted, partition_spec=f"dt=020,o_orderstatus={s}") for s in statuses]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query(
    """SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_acctbal AS DECIMAL(15, 2)) AS s_acctbal,
              CAST(NULL AS INTEGER) AS s_rating FROM supplier"""
)
def align_schema_supplier(t):
    target = T.StructType.fromDDL("s_suppkey string, s_name string, s_acctbal decimal(15,2), s_rating int")
    name = _name("supplier")
    create_table(t.spark, name, target, location=t.path("supplier"))
    # Upper-case names match, s_nationkey is unknown to the table, s_rating is absent.
    upper = t["supplier"].toDF(*[c.upper() for c in t["supplier"].columns])
    write_table(upper, name, create=False)
    return read_table(t.spark, name)


@query("SELECT c_custkey, c_name, CAST(c_acctbal AS VARCHAR) AS c_acctbal, CAST(NULL AS DATE) AS c_since FROM customer")
def case_insensitive_read_customer(t):
    stored = t["customer"].toDF(*[c.upper() for c in t["customer"].columns])
    wanted = T.StructType.fromDDL("c_custkey bigint, c_name string, c_acctbal string, c_since date")
    return resolve_case_insensitive(stored, wanted)


@query("SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, l_quantity, CAST(NULL AS BOOLEAN) AS l_flag FROM lineitem")
def align_columns_lineitem(t):
    return align_to_table(t["lineitem"], T.StructType.fromDDL("l_orderkey string, l_quantity double, l_flag boolean"))
