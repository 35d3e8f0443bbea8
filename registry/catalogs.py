"""Tables of Spark's own catalog, feeds that change their columns, several tables at once."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from registry.base import EVENTS, events, events_latest_sql, new_table, query, table
from registry.dedup import LINE_KEY, LINE_TIES, LINES_LATEST
from registry.reads import _events_feed
from registry.reconciliation import BRONZE, NULL_SAFE, SILVER, _stored
from silverline import plans
from silverline.operators import column_diffs
from silverline.plans import Consolidation, Feed
from silverline.session import materialise, scratch_path
from silverline.sinks import write_partitioned
from silverline.sources import read_partitioned
from silverline.tables import CatalogTable


def _catalog_table(spark):
    return CatalogTable(spark, ["spark_catalog", "default", f"orders_{uuid.uuid4().hex}"], provider="parquet")


def _stored_rows(table):
    """The table's rows; the table itself is dropped."""
    rows = materialise(table.current(), "catalog-rows")
    table.drop()
    return rows


@query("select * from orders where o_orderstatus <> 'P'")
def catalog_created_from_feed(spark, sf_dir):
    """Created empty from the feed's columns, partitioned, filled by two appends in other column orders."""
    orders = table(spark, sf_dir, "orders")
    made = _catalog_table(spark).ensure(orders, "o_orderkey", partitions="o_orderstatus")
    for status in ("F", "O"):
        made.append(orders.where(F.col("o_orderstatus") == status).select(*reversed(orders.columns)))
    return _stored_rows(made)


@query("""select *, null::varchar as channel from orders where o_orderstatus = 'F'
    union all by name select *, 'store ' || (o_custkey % 3) as channel from orders where o_orderstatus <> 'F'""")
def catalog_column_added(spark, sf_dir):
    """Rows written before a column was added read NULL, those after it keep theirs."""
    orders = table(spark, sf_dir, "orders")
    made = _catalog_table(spark).ensure(orders, "o_orderkey")
    made.append(orders.where("o_orderstatus = 'F'"))
    made.add_column("channel", "string", "where it was sold")
    channel = F.concat(F.lit("store "), F.col("o_custkey") % 3)
    made.append(orders.where("o_orderstatus <> 'F'").withColumn("channel", channel))
    return _stored_rows(made)


@query("""select name as col_name, kind as data_type, note as comment, n as n_values from (
    select 'c_custkey' as name, 'bigint' as kind, null as note, (select count(c_custkey) from customer) as n
    union all select 'c_mktsegment', 'string', null, (select count(c_mktsegment) from customer)
    union all select 'balance', 'decimal(12,2)', 'owed or held', (select count(*) from customer where c_acctbal > 0))""")
def catalog_described(spark, sf_dir):
    """What the catalog says of every column, next to the values that the column holds."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    plain = customers.drop("c_acctbal")
    made = _catalog_table(spark).ensure(plain, "c_custkey")
    made.add_column("balance", "decimal(12,2)", "owed or held")
    made.append(customers.where("c_acctbal > 0").withColumnRenamed("c_acctbal", "balance"))
    made.append(customers.where("not c_acctbal > 0").drop("c_acctbal"), fill_missing=True)
    described = materialise(made.describe(), "described")
    held = _stored_rows(made)
    counted = held.agg(*[F.count(c).alias(c) for c in held.columns])
    counted = counted.unpivot([], held.columns, "col_name", "n_values")
    return described.join(counted, "col_name").select("col_name", "data_type", "comment", "n_values")


@query("select o_custkey, max(o_totalprice) as highest from orders group by o_custkey")
def catalog_recreated(spark, sf_dir):
    """Dropped and created again with other columns: nothing of the old rows is left."""
    orders = table(spark, sf_dir, "orders")
    made = _catalog_table(spark).ensure(orders, "o_orderkey")
    made.append(orders)
    highest = orders.groupBy("o_custkey").agg(F.max("o_totalprice").alias("highest"))
    made.ensure(highest, "o_custkey", recreate=True).append(highest)
    return _stored_rows(made)


THIRDS = "(select min(ts)::date + ((max(ts)::date - min(ts)::date) // 3)::int as first_cut, min(ts)::date + (2 * (max(ts)::date - min(ts)::date) // 3)::int as second_cut from events)"


@query(f"""select event_id, ts, user_id, event_type, case when dt_ref > second_cut then value * 1000 else floor(value) end as value,
    case when dt_ref > first_cut then props end as props,
    case when dt_ref > second_cut then event_type || '/' || user_id end as origin, dt_ref
    from {EVENTS}, {THIRDS}""")
def read_evolving_feed(spark, sf_dir):
    """Days that gained a column, then another, and whose value went from int to double and user from int to long."""
    feed = events(spark, sf_dir)
    first, last = feed.agg(F.min("dt_ref"), F.max("dt_ref")).first()
    cuts = [F.date_add(F.lit(first), (last - first).days * k // 3) for k in (1, 2)]
    day, path = F.col("dt_ref"), scratch_path(spark, "feed")
    narrow = {"user_id": F.col("user_id").cast("int"), "value": F.floor("value").cast("int")}
    origin = F.concat_ws("/", "event_type", "user_id")
    shapes = [
        feed.where(day <= cuts[0]).withColumns(narrow).drop("props"),
        feed.where((day > cuts[0]) & (day <= cuts[1])).withColumns(narrow),
        feed.where(day > cuts[1]).withColumns({"value": F.col("value") * 1000, "origin": origin}),
    ]
    for shape in shapes:
        write_partitioned(shape, path, ["dt_ref"], touched_only=True)
    return read_partitioned(spark, path, "dt_ref", evolving=True)


@query(f"select * from {EVENTS} where dt_ref in (select ts::date from events group by 1 having count(*) filter (event_type = 'error') % 2 = 1)")
def read_partition_table(spark, sf_dir):
    """The days with an odd number of errors, as a table that the scan is pruned by while it runs."""
    feed = events(spark, sf_dir)
    errors = feed.groupBy("dt_ref").agg(F.count_if(F.col("event_type") == "error").alias("n")).where("n % 2 = 1")
    return read_partitioned(spark, _events_feed(spark, sf_dir), "dt_ref", errors.select("dt_ref"))


EVENTS_NEWEST, ORDERS_NEWEST = (
    events_latest_sql(),
    "(select * from orders qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1)",
)


@query(f"""select 'events' as entity, user_id as k1, null::bigint as k2, ts as newest, event_id as row_id from {EVENTS_NEWEST}
    union all select 'orders', o_custkey, null, o_orderdate, o_orderkey from {ORDERS_NEWEST}
    union all select 'lineitem', l_orderkey, l_linenumber, l_shipdate, l_partkey from ({LINES_LATEST})""")
def consolidate_several_tables(spark, sf_dir):
    """Three feeds into three tables at once, each in a scheduler pool of its own."""
    feeds = {
        "events": (events(spark, sf_dir), "dt_ref", "user_id", "ts", "event_id"),
        "orders": (
            table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate")), "year", "o_custkey", "o_orderdate", "o_orderkey",
        ),
        "lineitem": (
            table(spark, sf_dir, "lineitem").withColumn("year", F.year("l_shipdate")), "year", LINE_KEY, "l_shipdate", LINE_TIES,
        ),
    }
    work = {}
    for name, (rows, part, keys, order, ties) in feeds.items():
        path = write_partitioned(rows, scratch_path(spark, "feed"), [part])
        work[name] = Consolidation(Feed(path, part), new_table(spark, "silver"), keys, order, {"tiebreak": ties})
    made = plans.consolidate_all(spark, work)
    none = F.lit(None).cast("long")
    shown = {
        "events": ["user_id", none, "ts", "event_id"],
        "orders": ["o_custkey", none, "o_orderdate", "o_orderkey"],
        "lineitem": ["l_orderkey", F.col("l_linenumber").cast("long"), "l_shipdate", "l_partkey"],
    }
    names = ["entity", "k1", "k2", "newest", "row_id"]
    parts = [made[name].current().select(F.lit(name), *columns).toDF(*names) for name, columns in shown.items()]
    return parts[0].union(parts[1]).union(parts[2])


SPLIT = "(select max(ts)::date - ((max(ts)::date - min(ts)::date) // 2)::int from events)"


@query(f"""select event_id, user_id, value, case when dt_ref >= {SPLIT} then props end as props, case when dt_ref < {SPLIT} then event_type end as kind,
    dt_ref from {EVENTS}""")
def union_of_unlike_days(spark, sf_dir):
    """Two slices of the events, each with a column that the other lacks, united by name."""
    feed = events(spark, sf_dir)
    first, last = feed.agg(F.min("dt_ref"), F.max("dt_ref")).first()
    cut = F.date_sub(F.lit(last), (last - first).days // 2)
    late = feed.where(F.col("dt_ref") >= cut).select("event_id", "user_id", "value", "props", "dt_ref")
    early = feed.where(F.col("dt_ref") < cut).select(F.col("event_type").alias("kind"), "dt_ref", "value", "user_id", "event_id")
    return late.unionByName(early, allowMissingColumns=True)


def _with_maps(df, flip):
    """A map, and a map of arrays of maps, made of the row; `flip` writes their entries in the other order."""
    pairs = [("status", F.col("o_orderstatus")), ("priority", F.col("o_orderpriority"))]
    pairs = pairs[::-1] if flip else pairs
    flat = F.create_map(*[x for k, v in pairs for x in (F.lit(k), v)])
    deep = F.create_map(F.lit("all"), F.array(flat, F.create_map(F.lit("key"), F.col("o_orderkey").cast("string"))))
    return df.withColumns({"flat": F.when(F.col("o_orderkey") % 7 != 0, flat), "deep": deep})


MAP_DIFFS = """(select count(*) filter (b.o_orderkey % 7 = 0 and s.o_orderkey % 7 <> 0 or b.o_orderkey % 7 <> 0 and s.o_orderkey % 7 = 0
        or b.o_orderkey % 7 <> 0 and (b.o_orderstatus is distinct from s.o_orderstatus or b.o_orderpriority is distinct from s.o_orderpriority)) as flat,
    count(*) filter (b.o_orderkey <> s.o_orderkey or b.o_orderstatus is distinct from s.o_orderstatus
        or b.o_orderpriority is distinct from s.o_orderpriority) as deep"""


@query(f"select * from {MAP_DIFFS} from {BRONZE} b join {SILVER} s on {NULL_SAFE})")
def reconcile_maps(spark, sf_dir):
    """Maps, alone and nested, compared by their entries: order does not matter, values and NULLs do."""
    bronze, silver = _stored(spark, sf_dir)
    return column_diffs(_with_maps(bronze, False), _with_maps(silver, True), "k", "flat,deep", null_safe=True, maps=True)
