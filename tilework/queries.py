"""Registered queries: each operator on the driver's tables, with the SQL that must agree.

Stand-ins: ``events`` are scenes (user: tile, value: cloud), ``orders`` with ``customer``
are scenes over several years (nation: tile), ``lineitem`` holds several versions of its
keys, ``embeddings`` are bands. Nodata shares and boxes are arithmetic on ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .functions import geo, raster, scalars
from .operators import audit, dedupe, layout, search, stats
from .schema import L2A, conform, keep_star_then, upgrade_stats

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
c = F.col


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _epoch(name: str) -> F.Column:
    """Seconds since 1970 of a time without zone, whatever the session's zone is."""
    days = F.datediff(F.to_date(name), F.lit("1970-01-01").cast("date"))
    return days.cast("bigint") * 86400 + F.hour(name) * 3600 + F.minute(name) * 60 + F.second(name)


# ---- stand-ins, once as DataFrames and once as SQL ----

def _scenes(spark, sf) -> DataFrame:
    nodata = F.nullif(c("event_id") % 101, F.lit(0))
    return search.scenes(
        table(spark, sf, "events"), tile=c("user_id").cast("string"), at=c("ts"), item=c("event_id"), cloud=c("value"), nodata=nodata
    )


SCENES = """scenes as (select event_id as id, cast(user_id as varchar) as tile, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as ts, ts as t,
  cast(ts as date) as day, value as cloud, cast(100.0 - nullif(event_id % 101, 0) as double) as cover
  from events where ts is not null)"""


def _event_stats(spark, sf, grain="month") -> DataFrame:
    nodata = F.nullif(c("event_id") % 101, F.lit(0))
    return stats.rollup(
        table(spark, sf, "events"), key=c("user_id").cast("string"), at=c("ts"), metric=c("value"), item=c("event_id"), nodata=nodata, grain=grain
    )


def _pct(x: str) -> str:
    return f"cast(case when {x} is not null then least(100, greatest(0, round({x}))) end as smallint)"


def _rollup_sql(source: str, key: str, at: str, metric: str, item: str, nodata: str | None, day: bool = False) -> str:
    keys = f"{key} as mgrs_tile, cast(year({at}) as smallint) as year, cast(month({at}) as tinyint) as month" + (
        f", cast(day({at}) as tinyint) as day" if day else ""
    )
    cover = f"100.0 - {nodata}" if nodata else "cast(null as double)"
    names = "mgrs_tile, year, month" + (", day" if day else "")
    return f"""
  select {names}, cast(n as integer) as scene_count, {_pct('lo')} as min_cloud_cover, {_pct('mid')} as median_cloud_cover,
    {_pct('mean')} as mean_cover, {_pct('hi')} as max_cover, best_item_id, cast(best_at as date) as best_item_date
  from (select {keys}, count(*) as n, min({metric}) as lo, median({metric}) as mid, avg({cover}) as mean, max({cover}) as hi,
      first({item} order by {metric}, {at}, {item}) as best_item_id, first({at} order by {metric}, {at}, {item}) as best_at
    from {source} group by all)"""


EVENT_MONTHS = "stats as (" + _rollup_sql("events", "cast(user_id as varchar)", "ts", "value", "event_id", "nullif(event_id % 101, 0)") + ")"
ORDER_ROWS = "(select * from orders join customer on o_custkey = c_custkey)"
ORDER_MONTHS = "stats as (" + _rollup_sql(ORDER_ROWS, "cast(c_nationkey as varchar)", "o_orderdate", "o_totalprice / 5000", "o_orderkey", None) + ")"


def _orders(spark, sf) -> DataFrame:
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return orders.join(customer, orders.o_custkey == customer.c_custkey)


def _order_stats(spark, sf) -> DataFrame:
    return stats.rollup(
        _orders(spark, sf), key=c("c_nationkey").cast("string"), at=c("o_orderdate"), metric=c("o_totalprice") / 5000, item=c("o_orderkey")
    )


# ---- statistics ----

@query(_rollup_sql("events", "cast(user_id as varchar)", "ts", "value", "event_id", "nullif(event_id % 101, 0)", day=True))
def tile_month_stats(spark, sf):
    return _event_stats(spark, sf, "day")


@query(f"with {ORDER_MONTHS} select * from stats")
def orders_month_stats(spark, sf):
    return _order_stats(spark, sf)


@query(f"""with {ORDER_MONTHS} select year, month, cast(count(*) as integer) as tile_count, cast(sum(scene_count) as integer) as scene_count,
  min(min_cloud_cover) as min_cloud_cover from stats group by year, month""")
def timeline(spark, sf):
    return stats.timeline(_order_stats(spark, sf))


@query(f"""with {ORDER_MONTHS} select year, month, cast(sum(scene_count) as bigint) as n, min(min_cloud_cover) as clearest
  from stats where mgrs_tile = '7' group by year, month""")
def tile_history(spark, sf):
    return stats.tile_history(_order_stats(spark, sf), "7")


@query(f"with {ORDER_MONTHS} select * from stats where year = 1997 and month = 5")
def month_slice(spark, sf):
    return _order_stats(spark, sf).where("year = 1997 and month = 5")


@query(f"with {ORDER_MONTHS} select year, month from stats group by year, month order by year desc, month desc limit 1")
def newest_month(spark, sf):
    return stats.newest_month(_order_stats(spark, sf))


@query(f"""with {ORDER_MONTHS} select min(year * 100 + month) as first, max(year * 100 + month) as last,
  cast(sum(scene_count) as bigint) as scenes, count(*) as n from (select * replace (cast(year as integer) as year) from stats)""")
def month_span(spark, sf):
    return stats.month_span(_order_stats(spark, sf))


@query("select distinct cast(year(o_orderdate) as integer) as year, cast(month(o_orderdate) as integer) as month from orders")
def distinct_months(spark, sf):
    return stats.distinct_periods(table(spark, sf, "orders"), "o_orderdate")


def _paint(metric: str, raw: str, value: str):
    sql = f"""with {ORDER_MONTHS}, painted as (select mgrs_tile, min(min_cloud_cover) as cc, max(max_cover) as cover,
      cast(sum(scene_count) as bigint) as sc, min(median_cloud_cover) as med from stats
      where printf('%04d-%02d', year, month) between '1996-11' and '1997-02' group by mgrs_tile)
      select mgrs_tile, cast({value} as double) as v, cc, cover, sc from painted where {raw} is not null"""

    def run(spark, sf):
        return stats.window_paint(_order_stats(spark, sf), "1996-11", "1997-02", metric)

    return sql, run


for _name, _metric, _raw, _value in (
    ("window_paint", "min_cloud_cover", "cc", "cc"),
    ("window_paint_scenes", "scene_count", "sc", "greatest(0, 100 - sc * 8)"),
    ("window_paint_median", "median_cloud_cover", "med", "med"),
):
    ORACLE_SQL[_name], QUERIES[_name] = _paint(_metric, _raw, _value)

EVENT_PAINT = f"""with {EVENT_MONTHS}, painted as (select mgrs_tile, min(min_cloud_cover) as cc, max(max_cover) as cover,
  cast(sum(scene_count) as bigint) as sc, min(median_cloud_cover) as med from stats
  where printf('%04d-%02d', year, month) between '2024-01' and '2024-01' group by mgrs_tile)"""


@query(EVENT_PAINT + " select mgrs_tile, cast(greatest(0, 100 - cover) as double) as v, cc, cover, sc from painted where cover is not null")
def window_paint_cover(spark, sf):
    return stats.window_paint(_event_stats(spark, sf), "2024-01", "2024-01", "max_cover")


@query(EVENT_PAINT + """ select count(*) filter (where (cc <= 5) is not false and (cover >= 90) is not false and (sc >= 50) is not false) as n,
  count(*) as m from painted where cc is not null""")
def pass_count(spark, sf):
    return stats.pass_count(stats.window_paint(_event_stats(spark, sf), "2024-01", "2024-01"), 5, 90, 50)


@query(EVENT_PAINT + """, sorted as (select sc, row_number() over (order by sc) as k, count(*) over () as n from painted where cc is not null)
  select cast(greatest(1, coalesce(round(max(sc)), 0)) as bigint) as bound from sorted where k = ceil(0.99 * n)""")
def p99_bound(spark, sf):
    return stats.p99_bound(stats.window_paint(_event_stats(spark, sf), "2024-01", "2024-01"))


@query("""select cast(least(35, greatest(0, floor((c_custkey * 37 % 4000 / 10.0 - 200 + 180) / 360 * 36))) as integer) as ix,
  cast(least(17, greatest(0, floor((90 - (c_custkey * 13 % 2000 / 10.0 - 100)) / 180 * 18))) as integer) as iy, count(*) as n
  from (select cast(c_custkey as double) as c_custkey from customer) group by all""")
def density_grid(spark, sf):
    k = c("c_custkey").cast("double")
    return stats.density_grid(table(spark, sf, "customer"), k * 37 % 4000 / 10.0 - 200, k * 13 % 2000 / 10.0 - 100, 36, 18)


PARTS = """parts as (select cast(year(o_orderdate) as integer) as year, o_orderstatus as part, count(*) as rows, min(o_orderdate) as start,
  max(o_orderdate) as "end", min(o_totalprice) / 7 as xmin, min(o_custkey) / 7.0 as ymin, max(o_totalprice) / 7 as xmax, max(o_custkey) / 7.0 as ymax
  from orders group by all)"""
YEARS = f"""{PARTS}, years as (select year, cast(sum(rows) as bigint) as rows, min(start) as start, max("end") as "end",
  floor(min(xmin) * 10000) / 10000 as xmin, floor(min(ymin) * 10000) / 10000 as ymin, ceil(max(xmax) * 10000) / 10000 as xmax,
  ceil(max(ymax) * 10000) / 10000 as ymax from parts group by year)"""


def _parts(spark, sf):
    grouped = table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("year"), c("o_orderstatus").alias("part"))
    return grouped.agg(
        F.count("*").alias("rows"), F.min("o_orderdate").alias("start"), F.max("o_orderdate").alias("end"),
        (F.min("o_totalprice") / 7).alias("xmin"), (F.min("o_custkey") / F.lit(7.0)).alias("ymin"),
        (F.max("o_totalprice") / 7).alias("xmax"), (F.max("o_custkey") / F.lit(7.0)).alias("ymax"),
    )


@query(f"with {YEARS} select * from years")
def year_rollup(spark, sf):
    return stats.part_rollup(_parts(spark, sf))


@query(f"""with {YEARS} select cast(sum(rows) as bigint) as rows, min(start) as start, max("end") as "end", min(xmin) as xmin, min(ymin) as ymin,
  max(xmax) as xmax, max(ymax) as ymax from years""")
def collection_rollup(spark, sf):
    return stats.collection_rollup(stats.part_rollup(_parts(spark, sf)))


@query("""select cast(year(o_orderdate) as integer) as year, count(*) as n, min(o_orderdate) as first, max(o_orderdate) as last
  from orders where year(o_orderdate) in (1996, 1998) group by 1""")
def year_counts(spark, sf):
    rows = table(spark, sf, "orders").withColumn("year", F.year("o_orderdate")).where("year in (1996, 1998)")
    return rows.groupBy("year").agg(F.count("*").alias("n"), F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))


@query("""select l_returnflag, median(mid) as median, min(lo) as least, max(hi) as greatest, count(*) as groups from (
  select l_returnflag, l_linenumber, median(l_quantity) as mid, min(l_quantity) as lo, max(l_quantity) as hi from lineitem group by all) group by 1""")
def two_level_median(spark, sf):
    return stats.two_level_median(table(spark, sf, "lineitem"), ["l_returnflag"], ["l_linenumber"], "l_quantity")


@query("""select l_returnflag, median(l_quantity) as median, max(l_quantity) as greatest, sum(l_quantity) as total,
  list_sort(list(l_quantity))[cast(least(count(*) - 1, floor(0.9 * count(*))) as bigint) + 1] as p from lineitem group by 1""")
def layout_percentile(spark, sf):
    return stats.layout_percentiles(table(spark, sf, "lineitem"), ["l_returnflag"], "l_quantity", 0.9)


# ---- versions ----

@query("""select * exclude (rn) from (select *, row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate desc nulls last,
  l_partkey desc, l_suppkey desc, l_quantity desc, l_extendedprice desc, l_discount desc, l_tax desc, l_returnflag desc, l_linestatus desc) as rn
  from lineitem) where rn = 1""")
def latest_by_key(spark, sf):
    return dedupe.latest_by(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate")


@query("""select * exclude (rn) from (select *, row_number() over (partition by l_orderkey, l_linenumber order by l_shipdate desc nulls last,
  l_partkey desc nulls last, l_extendedprice desc nulls last, l_quantity desc, l_suppkey desc, l_discount desc, l_tax desc, l_returnflag desc,
  l_linestatus desc) as rn from lineitem) where rn = 1""")
def latest_by_key_ranked(spark, sf):
    ties = ["l_partkey", "l_extendedprice", "l_quantity", "l_suppkey", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    return dedupe.latest_by_rank(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate", ties)


@query("select l_orderkey, max(l_shipdate) as l_shipdate from lineitem group by 1")
def latest_version(spark, sf):
    return dedupe.latest_versions(table(spark, sf, "lineitem"), "l_orderkey", "l_shipdate")


@query("""with staged as (select o_orderkey as id, nullif(substr(o_orderpriority, 1, 1), '3') as version, year(o_orderdate) * 100 + month(o_orderdate) as ym
    from orders),
  archive as (select case when o_orderkey % 5 < 3 then o_orderkey end as id, nullif(cast(o_orderkey % 6 as varchar), '0') as version,
    year(o_orderdate) * 100 + month(o_orderdate) as ym from orders),
  held as (select id, max(version) as held from archive where ym in (select ym from staged) group by id)
  select s.id, s.version, cast(s.ym as integer) as ym from staged s left join held h on s.id = h.id
  where h.id is null or coalesce(s.version > h.held, s.version is not null and h.held is null)""")
def exclude_archived(spark, sf):
    orders = table(spark, sf, "orders")
    ym = (F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("ym")
    staged = orders.select(
        c("o_orderkey").alias("id"), F.nullif(F.substring("o_orderpriority", 1, 1), F.lit("3")).alias("version"), ym
    )
    archive = orders.select(
        F.when(c("o_orderkey") % 5 < 3, c("o_orderkey")).alias("id"), F.nullif((c("o_orderkey") % 6).cast("string"), F.lit("0")).alias("version"), ym
    )
    return dedupe.exclude_archived(staged, archive, "id", "version", c("ym"))


@query(f"""with {ORDER_MONTHS} select * replace (-scene_count as scene_count) from stats where year not in (1996, 1998)
  union all select * from stats where year in (1996, 1998)""")
def year_splice(spark, sf):
    fresh = _order_stats(spark, sf)
    return dedupe.splice_years(fresh.withColumn("scene_count", -c("scene_count")), fresh, [1996, 1998])


@query("select c_custkey, c_name from customer where c_custkey not in (select o_custkey from orders where year(o_orderdate) = 1997)")
def anti_join(spark, sf):
    orders = table(spark, sf, "orders").where(F.year("o_orderdate") == 1997).select(c("o_custkey").alias("c_custkey"))
    return dedupe.drop_keys(table(spark, sf, "customer").select("c_custkey", "c_name"), orders, "c_custkey")


@query("""select o_orderkey, o_custkey, cast(null as varchar) as o_orderpriority from orders
  union all select o_orderkey, cast(null as bigint), o_orderpriority from orders""")
def union_by_name(spark, sf):
    orders = table(spark, sf, "orders")
    return dedupe.fold(orders.select("o_orderkey", "o_custkey"), orders.select("o_orderpriority", "o_orderkey"))


@query("select event_id, ts from events where value < 200 union all select event_id, ts from events where value >= 100")
def fold(spark, sf):
    events = table(spark, sf, "events")
    return dedupe.fold(*[events.where(part).select("event_id", "ts") for part in ("value < 200", "value >= 100")], order="ts")


@query("""with both_ as (select l_orderkey, l_linenumber, l_shipdate, l_partkey from lineitem where l_linenumber < 4
  union all select l_orderkey, l_linenumber, l_shipdate, l_partkey from lineitem where l_linenumber > 2)
  select l_orderkey, max(l_shipdate) as l_shipdate, count(*) as n from (select distinct * from both_) group by 1""")
def consolidate(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey")
    both = dedupe.consolidate(
        rows.where("l_linenumber < 4"), rows.where("l_linenumber > 2"), ["l_orderkey", "l_linenumber", "l_shipdate", "l_partkey"], "l_shipdate"
    )
    return both.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("l_shipdate"), F.count("*").alias("n"))


@query("""select o_orderpriority, list_sort(list_distinct(list_concat(list(distinct o_orderstatus), ['Z', 'F']))) as states from orders group by 1""")
def union_sets(spark, sf):
    grouped = table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.collect_set("o_orderstatus").alias("s"))
    return grouped.select("o_orderpriority", dedupe.union_sets(c("s"), F.array(F.lit("Z"), F.lit("F"))).alias("states"))


# ---- search ----

@query(f"""with {SCENES} select * from scenes where tile = '7' and day between date '2024-01-03' and date '2024-01-25' and cloud <= 300
  and cover >= 20 order by cloud, id limit 30""")
def scene_search(spark, sf):
    return search.scene_search(_scenes(spark, sf), "7", "2024-01-03", "2024-01-25", 300, 20)


def _view(sort: str, order: str):
    sql = f"""with {SCENES} select *, cast(row_number() over (partition by tile order by {order}) - 1 as integer) as position from scenes
      where day between date '2024-01-05' and date '2024-01-20' and cloud <= 250 and (cover is null or cover >= 50)"""

    def run(spark, sf):
        rows = _scenes(spark, sf).where(search.view_filter("2024-01-05", "2024-01-20", 250, 50))
        return search.view_index(rows, sort)

    return sql, run


for _sort, _order in (
    ("cloud", "cloud nulls last, id"),
    ("coverage", "coalesce(cover, -1) desc, cloud nulls last, id"),
    ("date", "t desc, id"),
):
    ORACLE_SQL[f"view_{_sort}"], QUERIES[f"view_{_sort}"] = _view(_sort, _order)


@query(f"with {SCENES} select * from scenes where day between date '2024-01-05' and date '2024-01-20' and cloud <= 250 and (cover is null or cover >= 50)")
def view_filtered(spark, sf):
    return search.view(_scenes(spark, sf), "2024-01-05", "2024-01-20", 250, 50, "unknown")


@query("select l_orderkey, l_partkey, l_quantity from lineitem where l_orderkey = 77")
def keyed_rows(spark, sf):
    return search.keyed_rows(table(spark, sf, "lineitem"), "l_orderkey", 77, ["l_orderkey", "l_partkey", "l_quantity"])


@query("select event_id, json_extract_string(props, '$.k') as k from events")
def json_extract(spark, sf):
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("""select cast(strptime(regexp_extract(id, '^S2[A-Z]_(\\d{1,2}[A-Z]{3})_(\\d{8})_\\d+_L2A$', 2), '%Y%m%d') as date) as day, count(*) as n
  from (select 'S2A_' || (o_custkey % 60 + 1) || 'UFU_' || strftime(o_orderdate, '%Y%m%d') || case when o_orderkey % 9 = 0 then '_x' else '_0_L2A' end as id
  from orders) where regexp_matches(id, '^S2[A-Z]_(\\d{1,2}[A-Z]{3})_(\\d{8})_\\d+_L2A$') group by 1""")
def day_buckets(spark, sf):
    end = F.when(c("o_orderkey") % 9 == 0, "_x").otherwise("_0_L2A")
    ids = F.concat(F.lit("S2A_"), (c("o_custkey") % 60 + 1).cast("string"), F.lit("UFU_"), F.date_format("o_orderdate", "yyyyMMdd"), end)
    return search.day_buckets(table(spark, sf, "orders").select(ids.alias("id")), L2A)


@query("""select n_name, r_name, suppliers from nation left join (select case when s_nationkey % 4 <> 0 then s_nationkey end as s_nationkey, count(*) as suppliers from supplier
  group by 1) on n_nationkey = s_nationkey left join region on n_regionkey = r_regionkey""")
def lookup_left(spark, sf):
    known = F.when(c("s_nationkey") % 4 != 0, c("s_nationkey"))
    few = table(spark, sf, "supplier").groupBy(known.alias("n_nationkey")).agg(F.count("*").alias("suppliers"))
    region = table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    both = search.lookup(search.lookup(table(spark, sf, "nation"), few, "n_nationkey"), region, "n_regionkey")
    return both.select("n_name", "r_name", "suppliers")


@query("""with l as (select user_id, unnest(list(event_id order by value, event_id)) as id, generate_subscripts(list(event_id order by value, event_id), 1) as k
    from events group by 1),
  r as (select case when user_id % 4 <> 0 then user_id end as user_id, unnest(list(event_id order by round(value / 5), event_id)) as id,
    generate_subscripts(list(event_id order by round(value / 5), event_id), 1) as k from events group by 1)
  select user_id, count(*) filter (where l.id is distinct from r.id) as mismatches from l full join r using (user_id, k) group by 1""")
def ranked_mismatches(spark, sf):
    events = table(spark, sf, "events")

    def ranked(df, value):
        listed = F.array_sort(F.collect_list(F.struct(value.alias("v"), "event_id")))
        return df.groupBy("user_id").agg(F.transform(listed, lambda x: x["event_id"]).alias("ids"))

    known = events.withColumn("user_id", F.when(c("user_id") % 4 != 0, c("user_id")))
    left, right = ranked(events, c("value")), ranked(known, F.round(c("value") / 5))
    return search.compare_ranked(left, right, "user_id", "ids")


# ---- audit ----

KEYS = """keys as (select 'items/' || (o_custkey % 60 + 1) || '/U/AB/' || year(o_orderdate) || '/' || month(o_orderdate) || '/o' || o_orderkey || '/o'
  || case when o_orderkey % 11 = 0 then o_orderkey || '_side' else cast(o_orderkey as varchar) end || '.json' as key from orders)"""
EXPECTED = r"""expected as (select cast(regexp_extract(key, '/(\d{4})/(\d{1,2})/([^/]+)/([^/]+)\.json$', 1) as integer) as year,
  cast(regexp_extract(key, '/(\d{4})/(\d{1,2})/([^/]+)/([^/]+)\.json$', 2) as integer) as month, count(*) as expected from keys
  where key like 'items/%.json' and regexp_matches(key, '/(\d{4})/(\d{1,2})/([^/]+)/([^/]+)\.json$')
  and regexp_extract(key, '/(\d{4})/(\d{1,2})/([^/]+)/([^/]+)\.json$', 3) = regexp_extract(key, '/(\d{4})/(\d{1,2})/([^/]+)/([^/]+)\.json$', 4) group by all)"""


def _late(spark, sf):
    """Orders of which some are published 400 days late."""
    moved = F.date_add(F.to_date("o_orderdate"), F.when(c("o_orderkey") % 13 == 0, 400).otherwise(0))
    return table(spark, sf, "orders").select("o_orderkey", moved.alias("o_orderdate"))


def _keys(spark, sf):
    s = lambda x: x.cast("string")
    stem = F.when(c("o_orderkey") % 11 == 0, F.concat(s(c("o_orderkey")), F.lit("_side"))).otherwise(s(c("o_orderkey")))
    key = F.concat(
        F.lit("items/"), s(c("o_custkey") % 60 + 1), F.lit("/U/AB/"), s(F.year("o_orderdate")), F.lit("/"), s(F.month("o_orderdate")), F.lit("/o"),
        s(c("o_orderkey")), F.lit("/o"), stem, F.lit(".json"),
    )
    return table(spark, sf, "orders").select(key.alias("key"))


@query(f"""with {KEYS}, {EXPECTED}, have as (select cast(year(o_orderdate) as integer) as year, cast(month(o_orderdate) as integer) as month,
    count(*) as have from (select o_orderdate + (case when o_orderkey % 13 = 0 then 400 else 0 end) * interval 1 day as o_orderdate from orders) group by all)
  select year, month, coalesce(expected, 0) as expected, coalesce(have, 0) as have, coalesce(have, 0) - coalesce(expected, 0) as delta,
    abs(coalesce(have, 0) - coalesce(expected, 0)) > 5 as bad from expected full join have using (year, month)""")
def audit_delta(spark, sf):
    have = audit.have_counts(_late(spark, sf), "o_orderdate", None)
    return audit.audit(audit.expected_counts(_keys(spark, sf), "items/"), have, 5)


@query(f"with {KEYS}, {EXPECTED} select * from expected where (year = 1997 and month = 3) or (year = 1998 and month = 11)")
def key_parse_counts(spark, sf):
    return audit.expected_counts(_keys(spark, sf), "items/", ["1997-03", "1998-11"])


@query("""select 'k' || l.p_partkey as key, case when r.p_partkey is null then 'absent' when r.p_size + r.p_partkey % 2 <> l.p_size then 'size'
    when r.p_partkey % 7 <> 0 and r.p_partkey % 5 = 0 then 'checksum' end as reason
  from part l left join (select * replace (case when p_partkey % 3 <> 0 then p_partkey end as p_partkey) from part) r using (p_partkey)
  where r.p_partkey is null or r.p_partkey % 2 = 1 or (r.p_partkey % 7 <> 0 and r.p_partkey % 5 = 0)""")
def object_diff(spark, sf):
    part = table(spark, sf, "part")
    key, digest = F.concat(F.lit("k"), c("p_partkey").cast("string")).alias("key"), F.md5("p_name")
    local = part.select(key, c("p_size").alias("size"), digest.alias("checksum"))
    other = F.when(c("p_partkey") % 7 == 0, F.concat(digest, F.lit("-2"))).when(c("p_partkey") % 5 == 0, F.md5(F.lit("x"))).otherwise(digest)
    remote = part.select(F.when(c("p_partkey") % 3 != 0, key).alias("key"), (c("p_size") + c("p_partkey") % 2).alias("size"), other.alias("checksum"))
    return audit.object_diff(local, remote)


@query("""select year, list_sort(list(distinct part)) as parts from (select cast(year(o_orderdate) as integer) as year,
  case when o_orderkey % 4 = 0 then 'items' else 'live-' || printf('%02d', month(o_orderdate)) end as part,
  case when month(o_orderdate) > 6 then 0 else 1 end as rows from orders) where part like 'live%' and rows > 0 group by 1""")
def consolidation_plan(spark, sf):
    month = F.month("o_orderdate")
    name = F.when(c("o_orderkey") % 4 == 0, "items").otherwise(F.concat(F.lit("live-"), F.lpad(month.cast("string"), 2, "0")))
    parts = table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("year"), name.alias("part"), F.when(month > 6, 0).otherwise(1).alias("rows")
    )
    return audit.plan_consolidation(parts)


@query("""select property, count(*) as n from (select unnest(list_filter([o_orderstatus, o_orderpriority, 'k' || o_orderkey % 3],
  lambda x: x not in ('F', '2-HIGH', 'k1'))) as property from orders) group by 1""")
def drift_keys(spark, sf):
    keys = F.array("o_orderstatus", "o_orderpriority", F.concat(F.lit("k"), (c("o_orderkey") % 3).cast("string")))
    known = F.array(F.lit("F"), F.lit("2-HIGH"), F.lit("k1"))
    found = table(spark, sf, "orders").select(F.explode(F.filter(keys, lambda k: ~F.array_contains(known, k))).alias("property"))
    return found.groupBy("property").agg(F.count("*").alias("n"))


# ---- geometry ----

BOXES = """boxes as (select cast(c_custkey % 50 as varchar) as tile, case when base > 180 then base - 360 else base end as x0, y0, y0 + 1.25 as y1 from (
  select c_custkey, case when c_custkey % 50 < 10 then 178 + (c_custkey * 7 % 40) / 10.0::double else c_custkey % 50 * 3 + (c_custkey % 20) / 10.0::double end as base,
  c_custkey % 100 / 2.0::double - 25 as y0 from customer))"""


def _boxes(spark, sf):
    k = c("c_custkey")
    base = F.when(k % 50 < 10, 178 + (k * 7 % 40) / F.lit(10.0)).otherwise(k % 50 * 3 + (k % 20) / F.lit(10.0))
    rows = table(spark, sf, "customer").select((k % 50).cast("string").alias("tile"), base.alias("base"), (k % 100 / F.lit(2.0) - 25).alias("y0"))
    x0 = F.when(c("base") > 180, c("base") - 360).otherwise(c("base"))
    return rows.select("tile", x0.alias("x0"), (x0 + 0.5).alias("x1"), "y0", (c("y0") + 1.25).alias("y1"))


@query(f"""with {BOXES}, cut as (select tile, greatest(x0, -180) as l, least(x0 + 0.5, 180) as r, y0, y1 from boxes),
  framed as (select tile, case when max(r) > 170 and min(l) < -170 then min((l + 360) % 360) else min(l) end as low,
    case when max(r) > 170 and min(l) < -170 then max((l + 360) % 360 + r - l) else max(r) end as high, min(y0) as ymin, max(y1) as ymax from cut group by 1),
  pieces as (select tile, turn, greatest(low, 360 * turn - 180) - 360 * turn as xmin, least(high, 360 * turn + 180) - 360 * turn as xmax, ymin, ymax
    from framed, (values (0), (1)) as t(turn))
  select tile, cast(row_number() over (partition by tile order by turn) - 1 as integer) as piece, round(xmin, 6) as xmin, round(xmax, 6) as xmax, ymin, ymax
  from pieces where xmin < xmax""")
def footprint(spark, sf):
    pieces = geo.footprints(_boxes(spark, sf)).select("tile", F.posexplode("pieces").alias("piece", "p"))
    return pieces.select("tile", "piece", F.round("p.xmin", 6).alias("xmin"), F.round("p.xmax", 6).alias("xmax"), c("p.ymin").alias("ymin"), c("p.ymax").alias("ymax"))


@query(f"with {BOXES} select tile, count(*) as n from boxes where x0 <= 120 and x0 + 0.5 >= 20 and y0 <= 15 and y1 >= -10 group by 1")
def bbox_intersects(spark, sf):
    box = geo.envelope(c("x0"), c("y0"), c("x1"), c("y1"))
    return _boxes(spark, sf).where(geo.intersects(box, 20, -10, 120, 15)).groupBy("tile").agg(F.count("*").alias("n"))


def _case_parts(parts) -> str:
    return "case " + " ".join(f"when zone between {a} and {b} then '{n}'" for n, a, b in parts) + " end"


@query(f"""select part, count(*) as n from (select case when year >= 2021 then {_case_parts(geo.EIGHTHS)} when year >= 2019 then {_case_parts(geo.QUARTERS)}
    else 'items' end as part from (select try_cast(regexp_extract(tile, '^(\\d{{1,2}})', 1) as integer) as zone, year from (
      select case when o_orderkey % 17 = 0 then 'UFU' else (o_custkey % 60 + 1) || 'UFU' end as tile, 2016 + o_orderkey % 9 as year from orders))) group by 1""")
def zone_route(spark, sf):
    tile = F.when(c("o_orderkey") % 17 == 0, "UFU").otherwise(F.concat((c("o_custkey") % 60 + 1).cast("string"), F.lit("UFU")))
    rows = table(spark, sf, "orders").select(tile.alias("tile"), (2016 + c("o_orderkey") % 9).alias("year"))
    return rows.select(geo.part_of_tile(c("tile"), c("year")).alias("part")).groupBy("part").agg(F.count("*").alias("n"))


@query("""with p as (select c_custkey as point_id, c_custkey * 37 % 500 / 10.0::double as x, c_custkey * 91 % 300 / 10.0::double as y from customer),
  b as (select n_nationkey as poly_id, n_nationkey % 7 as rank, n_nationkey * 2.0::double as x0, n_nationkey * 2.0::double + 9.3 as x1,
    n_nationkey % 10 * 2.0::double as y0, n_nationkey % 10 * 2.0::double + 7.7 as y1 from nation)
  select point_id, poly_id, rank from (select point_id, poly_id, rank, row_number() over (partition by point_id order by rank desc, poly_id desc) as rn
    from p join b on x >= x0 and x < x1 and y >= y0 and y < y1) where rn = 1""")
def point_in_polygon(spark, sf):
    k, n = c("c_custkey"), c("n_nationkey")
    points = table(spark, sf, "customer").select(k.alias("point_id"), (k * 37 % 500 / F.lit(10.0)).alias("x"), (k * 91 % 300 / F.lit(10.0)).alias("y"))
    x0, y0 = n * F.lit(2.0), n % 10 * F.lit(2.0)
    xs, ys = F.array(x0, x0 + 9.3, x0 + 9.3, x0), F.array(y0, y0, y0 + 7.7, y0 + 7.7)
    polygons = table(spark, sf, "nation").select(n.alias("poly_id"), (n % 7).alias("rank"), xs.alias("xs"), ys.alias("ys"))
    return geo.point_in_polygon(points, polygons)


HILBERT = """start as (select c_custkey, cast(least(65535, greatest(0, floor((x * 37 % 3600 / 10 - 180 + 180) / 360 * 65535))) as bigint) as x,
    cast(least(65535, greatest(0, floor((x * 13 % 1800 / 10 - 90 + 90) / 180 * 65535))) as bigint) as y from (select c_custkey, c_custkey::double as x from customer)),
  walk(c_custkey, bit, x, y, d) as (select c_custkey, 32768::bigint, x, y, 0::bigint from start union all
    select c_custkey, bit // 2, case when y & bit > 0 then x & (bit - 1) when x & bit > 0 then bit - 1 - (y & (bit - 1)) else y & (bit - 1) end,
      case when y & bit > 0 then y & (bit - 1) when x & bit > 0 then bit - 1 - (x & (bit - 1)) else x & (bit - 1) end,
      d * 4 + case when y & bit > 0 then case when x & bit > 0 then 2 else 1 end when x & bit > 0 then 3 else 0 end from walk where bit > 0)"""


@query(f"with recursive {HILBERT} select c_custkey, d as h from walk where bit = 0")
def hilbert_key(spark, sf):
    k = c("c_custkey").cast("double")
    return table(spark, sf, "customer").select("c_custkey", geo.hilbert(k * 37 % 3600 / 10 - 180, k * 13 % 1800 / 10 - 90).alias("h"))


# ---- layout ----

@query("""select flag, month, group_no, count(*) as rows from (select l_returnflag as flag, cast(month(l_shipdate) as integer) as month,
  cast(floor((row_number() over (partition by l_returnflag, month(l_shipdate) order by l_orderkey, l_linenumber, l_partkey, l_extendedprice) - 1) / 300) as integer) as group_no
  from lineitem) group by all""")
def month_groups(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("flag", c("l_returnflag")).withColumn("month", F.month("l_shipdate"))
    return layout.group_sizes(layout.month_groups(rows, ["flag"], "month", ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"], 300), ["flag"], "month")


ORDINALS = """ordinals as (select l_returnflag, l_linenumber, cast(floor((row_number() over (partition by l_returnflag order by l_shipdate, l_orderkey,
  l_linenumber, l_partkey, l_extendedprice) - 1) / 500) as integer) as rg from lineitem)"""


def _ordinals(spark, sf):
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    return layout.row_group_ordinal(table(spark, sf, "lineitem"), ["l_returnflag"], order, 500)


@query(f"with {ORDINALS} select l_returnflag, rg, count(*) as rows from ordinals group by all")
def row_group_ordinal(spark, sf):
    return _ordinals(spark, sf).groupBy("l_returnflag", "rg").agg(F.count("*").alias("rows"))


@query(f"""with {ORDINALS} select l_returnflag, max(groups) as scatter from (select l_returnflag, l_linenumber, count(distinct rg) as groups from ordinals
  group by all) group by 1""")
def row_group_scatter(spark, sf):
    return layout.scatter(_ordinals(spark, sf), ["l_returnflag"], ["l_linenumber"])


GROUPS = "groups as (select o_orderstatus, cast(year(o_orderdate) * 100 + month(o_orderdate) as integer) as g, count(*) as rows from orders group by all)"


@query(f"""with {GROUPS} select *, cast(sum(rows) over w - rows as bigint) as row0, cast(sum(rows) over w as bigint) as row1 from groups
  window w as (partition by o_orderstatus order by g)""")
def running_offset(spark, sf):
    groups = table(spark, sf, "orders").groupBy("o_orderstatus", (F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("g")).agg(F.count("*").alias("rows"))
    return layout.running_offset(groups, ["o_orderstatus"], "g")


@query("""with spans as (select user_id, floor(epoch(ts))::bigint as a, floor(epoch(ts))::bigint + event_id % 4000 as b from events),
  marked as (select *, case when a - max(b) over (partition by user_id order by a, b rows between unbounded preceding and 1 preceding) <= 9000
    then 0 else 1 end as fresh from spans),
  runs as (select *, sum(fresh) over (partition by user_id order by a, b rows between unbounded preceding and current row) as run from marked)
  select user_id, min(a) as a, max(b) as b, count(*) as spans from runs group by user_id, run""")
def merge_spans(spark, sf):
    start = _epoch("ts")
    spans = table(spark, sf, "events").select("user_id", start.alias("a"), (start + c("event_id") % 4000).alias("b"))
    return layout.merge_spans(spans, ["user_id"], "a", "b", 9000)


@query("""with stated as (select user_id, ts, event_id, event_type = 'view' as state from events),
  marked as (select *, case when row_number() over w > 1 and state is not distinct from lag(state) over w then 0 else 1 end as fresh from stated
    window w as (partition by user_id order by ts, event_id)),
  runs as (select *, sum(fresh) over (partition by user_id order by ts, event_id rows between unbounded preceding and current row)::bigint as run from marked)
  select user_id, run, state, count(*) as length from runs group by all""")
def run_lengths(spark, sf):
    return layout.run_lengths(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], c("event_type") == "view")


@query("""with recursive spans as (select user_id, floor(epoch(ts))::bigint as a, floor(epoch(ts))::bigint + 1 + event_id % 40000 as b from events),
  chain(user_id, last, depth) as (select user_id, min(b), 1 from spans group by 1 union all
    select c.user_id, min(s.b), c.depth + 1 from chain c join spans s on s.user_id = c.user_id and s.a >= c.last group by c.user_id, c.depth)
  select user_id, cast(max(depth) as integer) as depth from chain group by 1""")
def request_depth(spark, sf):
    start = _epoch("ts")
    spans = table(spark, sf, "events").select("user_id", start.alias("start"), (start + 1 + c("event_id") % 40000).alias("end"))
    return layout.request_depth(spans, ["user_id"])


@query(f"""with {GROUPS}, ranged as (select o_orderstatus, g, rows, case when g % 5 = 0 then null else g end as low, g + 3 as high from groups)
  select * from ranged where low is null or high is null or (low <= 199704 and high >= 199704)""")
def admitted_groups(spark, sf):
    groups = table(spark, sf, "orders").groupBy("o_orderstatus", (F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("g")).agg(F.count("*").alias("rows"))
    ranged = groups.withColumn("low", F.when(c("g") % 5 != 0, c("g"))).withColumn("high", c("g") + 3)
    return layout.admitted_groups(ranged, c("low"), c("high"), 199704)


# ---- raster ----

BANDS = """bands as (select label, vec_id, i, cast(embedding[i] as double) as a, cast(embedding[65 - i] as double) as b
  from embeddings, (select unnest(generate_series(1, 64)) as i))"""


def _bands(spark, sf):
    e = table(spark, sf, "embeddings")
    flat = e.select("label", "vec_id", "embedding", F.posexplode("embedding").alias("i", "a"))
    other = F.element_at("embedding", (64 - c("i")).cast("int"))
    return flat.select("label", "vec_id", (c("i") + 1).alias("i"), c("a").cast("double").alias("a"), other.cast("double").alias("b"))


def _nearest(value: str, part: str = "label") -> str:
    return f"""(select {part}, count(*) as n, min({value}) as min, max({value}) as max,
      list_sort(list({value}))[cast(floor(0.02 * (count(*) - 1) + 0.5) as bigint) + 1] as p2,
      list_sort(list({value}))[cast(floor(0.98 * (count(*) - 1) + 0.5) as bigint) + 1] as p98 from src where {value} is not null group by 1)"""


@query(f"with {BANDS}, src as (select label, nullif(a, 0) as v from bands) select * from {_nearest('v')}")
def sample_stats(spark, sf):
    return raster.sample_stats(_bands(spark, sf).withColumnRenamed("a", "value"), ["label"])


ND = """src as (select label, case when a <> 0 and b <> 0 and a - 0.01 + (b - 0.01) <> 0 then
  greatest(-1, least(1, (a - 0.01 - (b - 0.01)) / (a - 0.01 + (b - 0.01)))) end as v from bands)"""


@query(f"with {BANDS}, {ND} select * from {_nearest('v')}")
def index_stats(spark, sf):
    rows = _bands(spark, sf).withColumn("v", raster.normalised_difference(c("a"), c("b"), 0.01))
    return raster.nearest_percentiles(rows, ["label"], "v", {"p2": 0.02, "p98": 0.98})


@query(f"""with {BANDS}, src as (select label, a as v from bands where a <> 0), span as (select label, min(v) as lo, max(v) as hi from src group by 1)
  select label, cast(least(63, floor((v - lo) / case when hi = lo then 1 else hi - lo end * 64)) as integer) as bin, count(*) as n
  from src join span using (label) group by all""")
def histogram64(spark, sf):
    return raster.histogram(_bands(spark, sf).withColumnRenamed("a", "value"), ["label"])


@query(f"""with {BANDS}, {ND} select label, cast(least(63, floor((v + 1) / 2 * 64)) as integer) as bin, count(*) as n from src where v is not null group by all""")
def index_histogram(spark, sf):
    rows = _bands(spark, sf).withColumn("v", raster.normalised_difference(c("a"), c("b"), 0.01))
    return raster.histogram(rows, ["label"], "v", -1.0, 1.0, None)


PIXELS = """pixels as (select vec_id, (i - 1) % 8 as x, cast(floor((i - 1) / 8) as integer) as y, cast(floor(abs(a) * 200) as integer) as r,
  cast(floor(abs(b) * 200) as integer) as g, cast(floor(abs(a + b) * 100) as integer) as b from bands)"""


@query(f"""with {BANDS}, {PIXELS}, seeds as (select vec_id, x, y from pixels where r = 0 and g = 0 and b = 0)
  select count(*) as masked, count(distinct vec_id) as scenes from pixels p where r <= 24 and g <= 24 and b <= 24
    and exists (select 1 from seeds s where s.vec_id = p.vec_id and abs(s.x - p.x) <= 1 and abs(s.y - p.y) <= 1)""")
def nodata_mask(spark, sf):
    level = lambda v, k: F.floor(F.abs(v) * k).cast("int")
    pixels = _bands(spark, sf).select(
        "vec_id", ((c("i") - 1) % 8).alias("x"), F.floor((c("i") - 1) / 8).cast("int").alias("y"),
        level(c("a"), 200).alias("r"), level(c("b"), 200).alias("g"), level(c("a") + c("b"), 100).alias("b"),
    )
    return raster.nodata_mask(pixels, ["vec_id"]).agg(F.count("*").alias("masked"), F.count_distinct("vec_id").alias("scenes"))


@query("""with l as (select p_brand, cast(p_partkey as bigint) as level, p_partkey * 10 as w, p_partkey * 9 as h from part)
  select p_brand, coalesce(arg_min(level, w) filter (where w >= 12000), arg_max(level, w)) as level from l group by 1""")
def pick_level(spark, sf):
    k = c("p_partkey")
    return raster.pick_level(table(spark, sf, "part").select("p_brand", k.alias("level"), (k * 10).alias("w"), (k * 9).alias("h")), ["p_brand"], 12000)


def _hex(value: str) -> str:
    return f"printf('%02x', cast({value} as integer))"


def _ramp_sql(stops) -> str:
    """SQL: hexadecimal colour of step k of 256 through evenly spaced stops, halves to even."""
    channels = []
    for at in (1, 3, 5):
        levels = "[" + ", ".join(str(int(s[at : at + 2], 16)) for s in stops) + "]"
        step = f"k * {len(stops) - 1} / 255.0::double"
        low = f"{levels}[cast(floor({step}) as bigint) + 1]"
        high = f"{levels}[least({len(stops)}, cast(floor({step}) as bigint) + 2)]"
        channels.append(_hex(f"round_even({low} + ({step} - floor({step})) * ({high} - {low}), 0)"))
    return " || ".join(channels)


# Samples are single precision; so are their positions on the stretch table and the ramp.
PAINTED = f"""samples as (select vec_id, i, cast(embedding[i] as float) as a, cast(embedding[65 - i] as float) as b from embeddings,
    (select unnest(generate_series(1, 64)) as i)),
  steps as (select *, cast(trunc(cast(least(1023::float, greatest(0::float, (a - (-0.5)::float) * 1023::float / 1::float)) as double)) as bigint) as sa,
    cast(trunc(cast(least(1023::float, greatest(0::float, (b - (-0.5)::float) * 1023::float / 1::float)) as double)) as bigint) as sb,
    cast((a - b) / (a + b) as float) as v from samples),
  shown as (select *, cast(trunc(cast(least(255::float, greatest(0::float, (v + 1::float) * 255::float / 2::float)) as double)) as bigint) as k from steps),
  told as (select vec_id, i, case when a = 0 or b = 0 then '00000000' else
      {" || ".join(_hex(f"least(255, floor(255 * pow(sqrt({s} / 1023.0::double), 1 / 1.2::double) + 0.5))") for s in ("sa", "sb", "sa"))} || 'ff' end as rgba,
    case when a = 0 or b = 0 or isnan(v) then '00000000' else {_ramp_sql(raster.INDICES["ndvi"][2])} || 'ff' end as ramp from shown)"""


@query(f"""with {PAINTED} select vec_id, sha256(unhex(string_agg(rgba, '' order by i))) as rgba, sha256(unhex(string_agg(ramp, '' order by i))) as "index"
  from told group by 1""")
def paint_rgba(spark, sf):
    e = c("embedding").cast("array<float>")
    painted = raster.paint_bands(e, F.reverse(e), e, [(-0.5, 0.5)] * 3, "sqrt", 1.2)
    index = raster.paint_index(e, F.reverse(e), "ndvi")
    return table(spark, sf, "embeddings").select("vec_id", F.sha2(painted, 256).alias("rgba"), F.sha2(index, 256).alias("index"))


# ---- scalar rules and schemas ----

@query(r"""select event_id, cast(case when v is not null then least(100, greatest(0, round(v))) end as smallint) as pct,
    try_cast(regexp_extract(tile, '^(\d{1,2})', 1) as integer) as zone, regexp_extract(tile, '^(\d{1,2}[A-Z])', 1) as prefix,
    regexp_matches(tile, '^\d{1,2}[C-X][A-Z]{2}$') as ok, regexp_replace(tile, '^(\d[A-Z])', '0\1') as padded,
    try_cast(regexp_extract(product, '_R(\d{3})_', 1) as integer) as orbit,
    case when regexp_matches(baseline, '^\d\d\.\d\d$') then case when baseline >= '04.00' then 1000 else 0 end end as boa,
    last_day(cast(ts as date)) as last, '1220' || sha256(tile) as hash
  from (select event_id, ts, nullif(value, 0) - 3 as v, case when event_id % 5 = 0 then 'XX' else (event_id % 62) || chr(cast(65 + event_id % 26 as integer)) || 'AB' end as tile,
    'P_R' || lpad(cast(event_id % 150 as varchar), 3, '0') || '_' || event_type as product,
    case when event_id % 7 = 0 then 'bad' else lpad(cast(event_id % 6 as varchar), 2, '0') || '.' || lpad(cast(event_id % 20 as varchar), 2, '0') end as baseline
    from events)""")
def scalar_rules(spark, sf):
    k, s = c("event_id"), lambda x: x.cast("string")
    letter = F.char(65 + k % 26)
    tile = F.when(k % 5 == 0, "XX").otherwise(F.concat(s(k % 62), letter, F.lit("AB")))
    product = F.concat(F.lit("P_R"), F.lpad(s(k % 150), 3, "0"), F.lit("_"), c("event_type"))
    baseline = F.when(k % 7 == 0, "bad").otherwise(F.concat(F.lpad(s(k % 6), 2, "0"), F.lit("."), F.lpad(s(k % 20), 2, "0")))
    rows = table(spark, sf, "events").select("event_id", "ts", (F.nullif("value", F.lit(0.0)) - 3).alias("v"), tile.alias("tile"), product.alias("product"), baseline.alias("baseline"))
    return rows.select(
        "event_id", scalars.percent(c("v")).alias("pct"), scalars.zone_of(c("tile")).alias("zone"), scalars.zone_prefix(c("tile")).alias("prefix"),
        scalars.valid_tile(c("tile")).alias("ok"), scalars.pad_tile(c("tile")).alias("padded"), scalars.relative_orbit(c("product")).alias("orbit"),
        scalars.boa_offset(c("baseline")).alias("boa"), F.last_day(F.to_date("ts")).alias("last"), scalars.multihash(c("tile")).alias("hash"),
    )


@query(r"""select page_id, case when regexp_matches(regexp_extract(u, '^https://([^/:?#]+)', 1), '(^|\.)(amazonaws\.com)$')
    then regexp_replace(regexp_replace(u, '[?#].*$', ''), '/[^/]*$', '') end as dir
  from (select page_id, case when page_id % 2 = 0 then 'https://b.s3.amazonaws.com/' || page_id || '/preview.jpg?x=1' else url end as u from pages)""")
def scene_dir(spark, sf):
    url = F.when(c("page_id") % 2 == 0, F.concat(F.lit("https://b.s3.amazonaws.com/"), c("page_id").cast("string"), F.lit("/preview.jpg?x=1"))).otherwise(c("url"))
    return table(spark, sf, "pages").select("page_id", scalars.scene_dir(url).alias("dir"))


@query("""select o_orderkey, len(m) as months, m[1] as first, m[-1] as last from (select o_orderkey,
  generate_series(date_trunc('month', o_orderdate)::timestamp, date_trunc('month', o_orderdate + (o_orderkey % 7 - 1) * interval 40 day)::timestamp, interval 1 month)
    ::date[] as m from orders)""")
def months_window(spark, sf):
    start = F.to_date("o_orderdate")
    months = scalars.months_between(start, F.date_add(start, ((c("o_orderkey") % 7 - 1) * 40).cast("int")))
    rows = table(spark, sf, "orders").select("o_orderkey", months.alias("m"))
    return rows.select("o_orderkey", F.size("m").cast("bigint").alias("months"), F.get("m", F.lit(0)).alias("first"), F.try_element_at("m", F.lit(-1)).alias("last"))


@query("""select event_id, strftime(t, '%Y-%m-%dT%H:%M:%S') || case when us = 0 then '' when us % 1000 = 0 then '.' || lpad(cast(us // 1000 as varchar), 3, '0')
    else '.' || lpad(cast(us as varchar), 6, '0') end || 'Z' as shown
  from (select event_id, date_trunc('second', ts) + (case event_id % 3 when 0 then 0 when 1 then 12000 else 34567 end) * interval 1 microsecond as t,
    case event_id % 3 when 0 then 0 when 1 then 12000 else 34567 end as us from events)""")
def rfc3339_times(spark, sf):
    us = F.when(c("event_id") % 3 == 0, 0).when(c("event_id") % 3 == 1, 12000).otherwise(34567)
    at = F.timestamp_micros(F.unix_seconds(c("ts").cast("timestamp")) * 1000000 + us)
    return table(spark, sf, "events").select("event_id", scalars.rfc3339(at).alias("shown"))


@query("""select cast(o_orderkey as varchar) as id, cast(round(o_totalprice) as bigint) as price, cast(null as varchar) as absent,
  cast(month(o_orderdate) as tinyint) as _month, o_orderpriority as geometry from orders""")
def conform_select(spark, sf):
    rows = table(spark, sf, "orders").select(
        c("o_orderpriority").alias("geometry"), c("o_orderkey").alias("id"), F.round("o_totalprice").alias("price"), "o_orderdate"
    )
    kinds = [("geometry", "string"), ("id", "string"), ("price", "bigint"), ("absent", "string"), ("_month", "tinyint")]
    return keep_star_then(conform(rows, kinds, {"_month": F.month("o_orderdate")}))


@query(f"""with {ORDER_MONTHS} select mgrs_tile, year, month, scene_count, cast(null as smallint) as mean_cover, cast(null as smallint) as max_cover,
  {_pct('min_cloud_cover + 0.5')} as min_cloud_cover, {_pct('median_cloud_cover - 20.0')} as median_cloud_cover,
  cast(best_item_id as varchar) as best_item_id, best_item_date from stats""")
def upgrade_table(spark, sf):
    old = _order_stats(spark, sf).select(
        "best_item_id", "mgrs_tile", "year", "month", "scene_count", (c("min_cloud_cover") + 0.5).alias("min_cloud_cover"),
        (c("median_cloud_cover") - 20.0).alias("median_cloud_cover"), c("best_item_date").cast("timestamp").alias("best_item_datetime"),
    )
    return upgrade_stats(old)


from . import round_trips  # noqa: E402,F401  registers its queries
