"""Registered queries that write, read back and run whole jobs: sources, sinks, builds, fetches, streams.

Each writes into a folder of its own below the shared root, reads what it wrote and must
equal its SQL over the same tables. Stand-ins as in ``queries``; years are moved by 24 to
where parts are split by zone.
"""

from __future__ import annotations

import json
import struct
import zlib

from pyspark.sql import functions as F

from .functions import geo, scalars
from .operators import audit, layout, search, stats
from .plans import build, fetch
from .queries import EXPECTED, KEYS, ORDER_MONTHS, SCENES, YEARS, _keys, _late, _orders, _parts, _scenes, query, table
from .schema import L2A, normalise, q, unknown_properties
from .sources import files, rest, sinks
from .streaming import refresh
from .workspace import folder

c = F.col


# ---- sources ----

@query("""select o_orderkey, o_custkey, cast(null as double) as o_totalprice from orders
  union all select o_orderkey, cast(null as bigint), o_totalprice from orders""")
def scan_by_name(spark, sf):
    path, orders = folder(spark, "scan_by_name"), table(spark, sf, "orders")
    orders.select("o_orderkey", "o_custkey").write.parquet(f"{path}/a")
    orders.select("o_totalprice", "o_orderkey").write.parquet(f"{path}/b")
    files.touch(spark, f"{path}/c/nothing.parquet")
    return files.read_items(spark, [f"{path}/a", f"{path}/b", f"{path}/c"], "o_orderkey bigint, o_custkey bigint, o_totalprice double")


@query("select o_orderkey, o_custkey, cast(year(o_orderdate) as integer) as year from orders where year(o_orderdate) = 1997")
def scan_partitions(spark, sf):
    path = folder(spark, "scan_partitions")
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"))
    sinks.write_sorted(rows, path, ["o_custkey"], 1000, level=3, partition_by=("year",))
    return files.read_partitioned(spark, path).where("year = 1997")


@query("select o_orderkey, o_totalprice as price, o_orderstatus as state, cast(null as varchar) as absent from orders")
def scan_documents(spark, sf):
    path = folder(spark, "scan_documents")
    rows = table(spark, sf, "orders").select(F.to_json(F.struct("o_orderkey", c("o_totalprice").alias("price"), c("o_orderstatus").alias("state"))).alias("value"))
    rows.unionByName(spark.sql("select '  ' as value")).write.text(path)
    if files.read_documents(spark, path).count() != rows.count():
        raise AssertionError("blank lines are no documents")
    return files.read_ndjson(spark, path, "o_orderkey bigint, price double, state string, absent string").where("o_orderkey is not null")


@query(f"with {KEYS} select 'b' as bucket, count(*) as n, cast(sum(length(key)) as bigint) as size, max(key) as last from keys")
def scan_inventory(spark, sf):
    """A manifest of the newest day names gzip files without header."""
    path = folder(spark, "scan_inventory")
    keys = _keys(spark, sf).select(F.lit("b").alias("bucket"), "key", F.length("key").alias("size"), F.lit("2024-01-01").alias("last_modified"))
    keys.write.option("compression", "gzip").csv(f"{path}/data")
    data = files.gather(spark, [f"{path}/data"], ".csv.gz")
    scheme = data[0].partition(":")[0] + ":"
    lines = spark.createDataFrame([("s3:" + p.removeprefix(scheme),) for p in data], "value string")
    for day in ("2024-01-01", "2024-03-01", "2024-02-01"):
        lines.coalesce(1).write.text(f"{path}/dt={day}/symlink.txt")
    newest = files.newest_manifest([f"{path}/dt=2024-01-01/", f"{path}/dt=2024-03-01/", f"{path}/dt=2024-02-01"])
    text = "\n".join(r.value for r in spark.read.text(newest).collect())
    found = files.read_inventory(spark, files.manifest_paths(text, "s3:", scheme))
    return found.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("size").cast("bigint").alias("size"), F.max("key").alias("last"))


RANKED_LINES = """ranked as (select l_orderkey, cast(floor((row_number() over (order by l_orderkey) - 1) / 5000) as integer) as g from lineitem),
  groups as (select g as "group", count(*) as rows, min(l_orderkey) as low, max(l_orderkey) as high from ranked group by g)"""


def _sorted_lines(spark, sf, name):
    path = folder(spark, name)
    sinks.write_sorted(table(spark, sf, "lineitem"), path, ["l_orderkey"], 5000, level=3, files=1)
    return path


@query(f"with {RANKED_LINES} select * from groups")
def scan_footers(spark, sf):
    groups = files.row_groups(spark, [_sorted_lines(spark, sf, "scan_footers")], "l_orderkey")
    return groups.select("group", "rows", c("low").cast("bigint").alias("low"), c("high").cast("bigint").alias("high"))


@query("""select '["r_regionkey","r_name"]' as names, 1::bigint as files""")
def scan_footer_keys(spark, sf):
    path = folder(spark, "scan_footer_keys")
    table(spark, sf, "region").coalesce(1).write.parquet(path)
    found = files.key_values(spark, [path]).where("key = 'org.apache.spark.sql.parquet.row.metadata'")
    return found.groupBy(F.get_json_object("value", "$.fields[*].name").alias("names")).agg(F.count("*").alias("files"))


@query("select count(*) as n, cast(min(o_orderkey) as bigint) as low, cast(max(o_orderkey) as bigint) as high from orders")
def scan_footer_sums(spark, sf):
    found = files.footer_stats(table(spark, sf, "orders"), "o_orderkey")
    return found.select(c("rows").alias("n"), "low", "high")


@query("select o_orderstatus as part, count(*) as n from orders group by 1")
def scan_present_parts(spark, sf):
    """Parts that are not there are empty parts."""
    path = folder(spark, "scan_present_parts")
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    states = [r[0] for r in rows.select("o_orderstatus").distinct().collect()]
    for state in states:
        sinks.replace_part(rows.where(c("o_orderstatus") == state), f"{path}/{state}")
    found = files.read_present(spark, [f"{path}/{s}" for s in ("none", *states, "gone")], rows.schema)
    return found.groupBy(c("o_orderstatus").alias("part")).agg(F.count("*").alias("n"))


# ---- sinks ----

@query("select p_brand, cast(p_partkey as bigint) as p_partkey from part")
def part_replaced(spark, sf):
    """A part is replaced as a whole, and stays as it was where the count is wrong."""
    path = f"{folder(spark, 'part_replaced')}/part"
    part = table(spark, sf, "part").select("p_brand", "p_partkey")
    sinks.replace_part(part.select("p_brand", (-c("p_partkey")).alias("p_partkey")), path)
    n = sinks.replace_part(part, path)
    try:
        sinks.replace_part(part.limit(3), path, expected=n)
    except ValueError:
        return spark.read.parquet(path)
    raise AssertionError("a short part was published")


ALIGNED = """placed as (select l_returnflag as part, cast(month(l_shipdate) as integer) as m,
    row_number() over (partition by l_returnflag, month(l_shipdate) order by l_orderkey) - 1 as k from lineitem),
  sized as (select part, m, cast(floor(k / 300) as integer) as g, count(*) as rows from placed group by all)"""


@query(f"""with {ALIGNED} select part, cast(row_number() over (partition by part order by m, g) - 1 as integer) as "group", rows, m as low, m as high from sized""")
def aligned_parts(spark, sf):
    """Row groups inside one file a part that never span a month."""
    path = folder(spark, "aligned_parts")
    rows = table(spark, sf, "lineitem").select("l_orderkey", c("l_returnflag").alias("part"), F.month("l_shipdate").alias("m"))
    sinks.write_aligned_parts(rows, path, "part", "m", ["l_orderkey"], 300, 3)
    groups = files.row_groups(spark, [path], "m")
    name = F.regexp_extract("path", r"([^/]+)\.parquet$", 1)
    return groups.select(name.alias("part"), "group", "rows", c("low").cast("int").alias("low"), c("high").cast("int").alias("high"))


@query("""select m, g, count(*) as rows from (select cast(month(l_shipdate) as integer) as m,
  cast(floor((row_number() over (partition by month(l_shipdate) order by l_orderkey) - 1) / 2000) as integer) as g from lineitem) group by all""")
def aligned_files(spark, sf):
    path = folder(spark, "aligned_files")
    rows = table(spark, sf, "lineitem").select("l_orderkey", F.month("l_shipdate").alias("m"))
    sinks.write_month_aligned(layout.month_groups(rows, [], "m", ["l_orderkey"], 2000), path, "m", ["l_orderkey"], 2000)
    return spark.read.parquet(path).groupBy("m", c("group_no").alias("g")).agg(F.count("*").alias("rows"))


def _items(spark, sf):
    return _orders(spark, sf).select(
        c("o_orderkey").cast("string").alias("id"), c("o_orderdate").cast("timestamp").alias("datetime"), c("c_nationkey").cast("string").alias(L2A.tile_column),
        (c("o_totalprice") / 5000).alias(L2A.metric_column),
    )


@query(f"""with {ORDER_MONTHS} select printf('%04d-%02d', year, month) as ym, count(*) as tiles, cast(sum(scene_count) as bigint) as scenes,
  min(mgrs_tile) as least from stats group by 1""")
def slices_written(spark, sf):
    """The statistics job; one flat file a month, read back by its name."""
    out = folder(spark, "slices_written")
    build.build_stats(_items(spark, sf), L2A, out)
    months = sinks.flat_slices(spark, f"{out}/months", f"{out}/flat")
    rows = spark.read.parquet(*[f"{out}/flat/{m}.parquet" for m in months]).withColumn("ym", F.regexp_extract(F.input_file_name(), r"([0-9-]+)\.parquet", 1))
    return rows.groupBy("ym").agg(F.count("*").alias("tiles"), F.sum("scene_count").cast("bigint").alias("scenes"), F.min("mgrs_tile").alias("least"))


@query(f"""with {ORDER_MONTHS} select year, month, cast(count(*) as integer) as tile_count, cast(sum(scene_count) as integer) as scene_count,
  min(min_cloud_cover) as min_cloud_cover from stats group by year, month""")
def stats_spliced(spark, sf):
    """Two years of a table whose other years are old are computed again; the timeline is of the whole."""
    out = folder(spark, "stats_spliced")
    items = _items(spark, sf)
    build.build_stats(items, L2A, f"{out}/old")
    build.build_stats(items, L2A, f"{out}/new", [1996, 1998], spark.read.parquet(f"{out}/old/mgrs-monthly"))
    return spark.read.parquet(f"{out}/new/timeline")


@query("select * from (values (0, 'r_regionkey', 'int'), (1, 'r_name', 'string')) as t(place, name, kind)")
def empty_part(spark, sf):
    path = folder(spark, "empty_part")
    sinks.write_empty(spark, table(spark, sf, "region").schema, path)
    back = spark.read.parquet(path)
    assert back.count() == 0
    return spark.createDataFrame([(i, f.name, f.dataType.simpleString()) for i, f in enumerate(back.schema)], "place int, name string, kind string")


@query("""select strftime(d, '%Y-%m-%d') as "window", coalesce(n, 0) as rows from (select unnest(generate_series(timestamp '2023-12-30', timestamp '2024-02-01',
  interval 1 day)) as d) left join (select date_trunc('day', ts) as d, count(*) as n from events group by 1) using (d)""")
def window_counts(spark, sf):
    path = folder(spark, "window_counts")
    found = table(spark, sf, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("d")).agg(F.count("*").alias("n")).collect()
    counts = {first: 0 for first, _ in rest.windows("2023-12-30", "2024-02-01", 1)} | {r.d: r["n"] for r in found}
    sinks.window_manifest(spark, counts).write.parquet(path)
    return spark.read.parquet(path)


@query(f"""with {KEYS}, {EXPECTED}, have as (select cast(year(o_orderdate) as integer) as year, cast(month(o_orderdate) as integer) as month,
    count(*) as have from (select o_orderdate + (case when o_orderkey % 13 = 0 then 400 else 0 end) * interval 1 day as o_orderdate from orders) group by all)
  select year, month, coalesce(expected, 0) as expected, coalesce(have, 0) as have, coalesce(have, 0) - coalesce(expected, 0) as delta,
    abs(coalesce(have, 0) - coalesce(expected, 0)) > 5 as bad from expected full join have using (year, month)""")
def delta_written(spark, sf):
    path = folder(spark, "delta_written")
    have = audit.have_counts(_late(spark, sf), "o_orderdate", None)
    sinks.write_delta_csv(audit.audit(audit.expected_counts(_keys(spark, sf), "items/"), have, 5), path)
    return spark.read.schema("year int, month int, expected bigint, have bigint, delta bigint, bad boolean").csv(path, header=True)


@query(f"""with {YEARS} select year, 'orders-' || year as id, rows, xmin, ymax, parts from years join (select cast(year(o_orderdate) as integer) as year,
  count(distinct o_orderstatus) as parts from orders group by 1) using (year)""")
def year_documents(spark, sf):
    parts = _parts(spark, sf)
    named: dict = {}
    for r in parts.collect():
        named.setdefault(r.year, []).append({"part": r.part, "rows": r["rows"]})
    documents = [(r.year, json.dumps(sinks.year_document(r, "orders", named[r.year]))) for r in stats.part_rollup(parts).collect()]
    held = "id string, bbox array<double>, properties struct<`table:row_count`: bigint>, assets map<string, struct<href: string>>"
    read = spark.createDataFrame(documents, "year int, value string").select("year", F.from_json("value", held).alias("d"))
    return read.select(
        "year", "d.id", c("d.properties.table:row_count").alias("rows"), c("d.bbox")[0].alias("xmin"), c("d.bbox")[3].alias("ymax"),
        F.size("d.assets").cast("bigint").alias("parts"),
    )


@query(f"""with {YEARS} select 'orders' as id, cast(sum(rows) as bigint) as rows, min(ymin) as south, max(xmax) as east, count(*) as links,
  strftime(min(start), '%Y-%m-%d %H:%M:%S') as "first" from years""")
def collection_documents(spark, sf):
    years = stats.part_rollup(_parts(spark, sf))
    rolled = stats.collection_rollup(years).first()
    text = json.dumps(sinks.collection_document(rolled, "orders", "All orders", [r.year for r in years.select("year").collect()]))
    held = "id string, extent struct<spatial: struct<bbox: array<array<double>>>, temporal: struct<`interval`: array<array<string>>>>, links array<struct<href: string>>, `table:row_count` bigint"
    read = spark.createDataFrame([(text,)], "value string").select(F.from_json("value", held).alias("d"))
    box = c("d.extent.spatial.bbox")[0]
    return read.select(
        "d.id", c("d.table:row_count").alias("rows"), box[1].alias("south"), box[2].alias("east"), F.size("d.links").cast("bigint").alias("links"),
        c("d.extent.temporal.interval")[0][0].alias("first"),
    )


@query(f"""with {RANKED_LINES} select "group", rows, low, high, 'l_orderkey,l_quantity' as kept from groups""")
def sidecar_written(spark, sf):
    path = _sorted_lines(spark, sf, "sidecar_written")
    made = sinks.sidecars(spark, [path], "l_orderkey", ["l_orderkey", "l_quantity"])
    kind = "columns array<string>, groups array<struct<`group`: int, rows: bigint, low: string, high: string>>"
    read = spark.createDataFrame([(v,) for v in made.values()], "value string").select(F.from_json("value", kind).alias("d"))
    flat = read.select(F.array_join("d.columns", ",").alias("kept"), F.explode("d.groups").alias("g"))
    return flat.select("g.group", "g.rows", c("g.low").cast("bigint").alias("low"), c("g.high").cast("bigint").alias("high"), "kept")


@query("""with cells as (select cast(l_linenumber - 1 as integer) as ix, cast(l_quantity as integer) % 5 as iy, count(*) as n from lineitem group by all)
  select ix, iy, cast(round(255 * sqrt(ln(1 + n) / ln(1 + (select max(n) from cells)))) as integer) as shade from cells""")
def density_image(spark, sf):
    """The grey picture of a grid, read back from its bytes."""
    cells = table(spark, sf, "lineitem").groupBy((c("l_linenumber") - 1).cast("int").alias("ix"), (c("l_quantity").cast("int") % 5).alias("iy")).agg(F.count("*").alias("n"))
    listed = [tuple(r) for r in cells.collect()]
    width, height = 1 + max(x for x, _, _ in listed), 1 + max(y for _, y, _ in listed)
    data, at, packed = sinks.density_png(listed, width, height), 8, b""
    while at < len(data):
        (size,) = struct.unpack_from(">I", data, at)
        if data[at + 4 : at + 8] == b"IDAT":
            packed += data[at + 8 : at + 8 + size]
        at += 12 + size
    pixels = zlib.decompress(packed)
    shades = [(x, y, pixels[y * (width + 1) + 1 + x]) for x, y, _ in listed]
    return spark.createDataFrame(shades, "ix int, iy int, shade int")


# ---- jobs ----

VERSIONS = """versions as (select 'O' || o_orderkey as id, o_orderdate + interval 24 year as dt, v as version, (o_custkey % 60 + 1) || 'UFU' as tile
    from orders, (select unnest([0, 1]) as turn), lateral (select case when turn = 0 then substr(o_orderpriority, 1, 1) else '3' end as v)),
  latest as (select id, max(version) as version, min(dt) as dt, min(tile) as tile from versions group by id),
  archive as (select 'O' || o_orderkey as id, cast(o_custkey % 6 as varchar) as held from orders)"""


def _versions(spark, sf):
    orders = table(spark, sf, "orders")
    turn = orders.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("turn"))
    return turn.select(
        F.concat(F.lit("O"), c("o_orderkey").cast("string")).alias("id"), (c("o_orderdate") + F.expr("interval 24 years")).cast("timestamp").alias("datetime"),
        F.when(c("turn") == 0, F.substring("o_orderpriority", 1, 1)).otherwise("3").alias(L2A.version_column),
        F.concat((c("o_custkey") % 60 + 1).cast("string"), F.lit("UFU")).alias(L2A.tile_column),
    )


def _archive(spark, sf):
    at = c("o_orderdate") + F.expr("interval 24 years")
    return table(spark, sf, "orders").select(
        F.concat(F.lit("O"), c("o_orderkey").cast("string")).alias("id"), (c("o_custkey") % 6).cast("string").alias(L2A.version_column), F.month(at).cast("tinyint").alias("_month")
    )


FATES = f"""{VERSIONS}, fated as (select id, version, cast(month(dt) as integer) as month, zone, case when zone between 1 and 15 then 'z01-15'
    when zone between 16 and 20 then 'z16-20' when zone between 21 and 31 then 'z21-31' when zone between 32 and 35 then 'z32-35'
    when zone between 36 and 40 then 'z36-40' when zone between 41 and 46 then 'z41-46' when zone between 47 and 52 then 'z47-52' else 'z53-60' end as part,
    held >= version as dropped from (select *, cast(regexp_extract(tile, '^(\\d+)', 1) as integer) as zone from latest) join archive using (id)
    where year(dt) = 2021 and month(dt) <= 9)"""
NAMED = [n for n, *_ in geo.EIGHTHS if n != "z16-20"]


def _built(spark, sf, name, accounts=None):
    path = folder(spark, name)
    _versions(spark, sf).write.parquet(f"{path}/in")
    build.build_year(spark, [f"{path}/in"], L2A, 2021, f"{path}/out", accounts, months=range(1, 10), archive=_archive(spark, sf), names=NAMED)
    return f"{path}/out"


@query(f"with {FATES} select id, version, month, part, 2021 as year from fated where not dropped and part <> 'z16-20'")
def year_built(spark, sf):
    rows = files.read_partitioned(spark, _built(spark, sf, "year_built"))
    return rows.select("id", q(L2A.version_column).alias("version"), c("_month").cast("int").alias("month"), "part", "year")


@query(f"""with {FATES} select count(*) as staged, count(*) filter (where not dropped and part <> 'z16-20') as written,
  count(*) filter (where not dropped and part = 'z16-20') as skipped, count(*) filter (where dropped) as dropped from fated""")
def year_accounts(spark, sf):
    accounts: dict = {}
    _built(spark, sf, "year_accounts", accounts)
    return spark.createDataFrame([tuple(accounts[k] for k in ("staged", "written", "skipped", "dropped"))], "staged bigint, written bigint, skipped bigint, dropped bigint")


@query(f"""with {FATES}, kept as (select part, count(*) as rows from fated where not dropped and part <> 'z16-20' group by 1)
  select part, rows, cast(sum(rows) over () as bigint) as total from kept""")
def year_discovered(spark, sf):
    """The item document of a built year: parts found by probing, measured from footers; what gives no answer keeps its record."""
    out = _built(spark, sf, "year_discovered")
    first = build.build_item(L2A, 2021, build.discover(spark, out, L2A, 2021))

    def silent(path):
        raise OSError("no answer")

    again = build.build_item(L2A, 2021, build.discover(spark, out, L2A, 2021, check=silent), first)
    assert again["assets"] == first["assets"]
    rows = [(n, a["table:row_count"], again["properties"]["table:row_count"]) for n, a in again["assets"].items()]
    return spark.createDataFrame(rows, "part string, rows bigint, total bigint")


def paged_days(url: str, body: dict) -> dict:
    """A stand-in for an item API: as many items as the day of the month, three a page."""
    day, page = body["datetime"][:10], body.get("page", 0)
    ids = [f"{day}-{i}" for i in range(int(day[8:]))][3 * page : 3 * page + 3]
    more = [{"rel": "next", "href": url, "merge": True, "body": {"page": page + 1}}] if 3 * page + 3 < int(day[8:]) else []
    return {"features": [{"id": i} for i in ids], "links": more}


@query("""select strftime(d, '%Y-%m-%d') as "window", strftime(d, '%Y-%m-%d') || '-' || i as id from (select unnest(generate_series(timestamp '2024-01-28',
  timestamp '2024-02-06', interval 1 day)) as d), (select unnest(generate_series(0, 30)) as i) where i < day(d)""")
def windows_fetched(spark, sf):
    """Two runs over overlapping spans; the second asks only for what the first has not fetched."""
    out = folder(spark, "windows_fetched")
    options = {"url": "http://x", "collection": "c", "transport": "tilework.round_trips:paged_days"}
    fetch.fetch_windows(spark, out, start="2024-01-28", end="2024-02-02", **options)
    again = fetch.fetch_windows(spark, out, start="2024-01-30", end="2024-02-06", **options)
    assert [w for w, _ in again] == ["2024-02-03", "2024-02-04", "2024-02-05", "2024-02-06"]
    assert fetch.fetch_windows(spark, out, start="2024-01-28", end="2024-02-06", **options) == []
    return spark.read.parquet(f"{out}/items").select(c("window").cast("string").alias("window"), "id")


def object_of(key: str) -> str | None:
    """A stand-in for an object store: the item that a key names; those of zone 13 are gone."""
    zone, *_, name, _ = key.split("/")[1:]
    if zone == "13":
        return None
    return json.dumps({"id": name, "properties": {"datetime": "2024-03-01T10:00:00Z", "s2:mgrs_tile": f"{zone}UAB"}})


@query("""select 'o' || o_orderkey as id, (o_custkey % 60 + 1) || 'UAB' as tile from orders where o_orderstatus = 'F' and o_orderkey % 11 <> 0
  and o_custkey % 60 <> 12""")
def objects_repaired(spark, sf):
    """Items of the inventory that are not published are fetched once; a second run adds none."""
    out = f"{folder(spark, 'objects_repaired')}/items"
    inventory = _keys(spark, sf).select(F.concat(F.lit(L2A.key_root), F.substring_index("key", "/", -7)).alias("key"))
    name = F.concat(F.lit("o"), c("o_orderkey").cast("string"))
    published = table(spark, sf, "orders").select(F.when(c("o_orderstatus") != "F", name).alias("id"))
    source = "tilework.round_trips:object_of"
    fetch.repair_months(spark, inventory, published, L2A, [], out, source)
    assert fetch.repair_months(spark, inventory, published, L2A, [], out, source) == 0
    return spark.read.parquet(out).select("id", q(L2A.tile_column).alias("tile"))


def folder_objects(prefix: str) -> list[str]:
    """A stand-in for a listing: two objects a folder."""
    return [f"{prefix}/{name}.json" for name in ("a", "b")]


@query("""with f as (select 'n' || n_nationkey || '/' || y || '/' || m as folder from nation, (select distinct year(o_orderdate) as y, month(o_orderdate) as m from orders))
  select folder, folder || '/' || unnest(['a.json', 'b.json']) as "key" from f""")
def folders_listed(spark, sf):
    prefixes = table(spark, sf, "nation").select(F.concat(F.lit("n"), c("n_nationkey").cast("string"), F.lit("//")).alias("prefix"))
    months = stats.distinct_periods(table(spark, sf, "orders"), "o_orderdate")
    return fetch.listed_folders(spark, prefixes, months, "tilework.round_trips:folder_objects")


# ---- streams ----

@query(f"""with {VERSIONS} select id, version, cast(month(dt) as integer) as m from latest join archive using (id) where version > held""")
def live_refreshed(spark, sf):
    """Two files, a micro-batch each, into live months; the archive holds some versions."""
    path = folder(spark, "live_refreshed")
    rows = _versions(spark, sf).select("id", q(L2A.version_column).alias("version"), F.month("datetime").alias("m"))
    first = rows.where("version = '3'").coalesce(1)
    first.write.parquet(f"{path}/in")
    rows.where("version <> '3'").coalesce(1).write.mode("append").parquet(f"{path}/in")
    archive = _archive(spark, sf).select("id", q(L2A.version_column).alias("version"), c("_month").cast("int").alias("m"))
    write = refresh.live_writer(spark, f"{path}/live", archive, key="id", version="version", month="m")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    refresh.run_refresh(stream, write, f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/live").select("id", "version", "m")


def _event_stream(spark, sf, path):
    events = table(spark, sf, "events").select(c("user_id").cast("string").alias("user_id"), c("ts").cast("timestamp").alias("at"))
    events.coalesce(1).write.parquet(f"{path}/in")
    return spark.readStream.schema(events.schema).parquet(f"{path}/in")


@query("select cast(user_id as varchar) as user_id, strftime(date_trunc('month', ts), '%Y-%m') as month, count(*) as n from events group by all")
def stream_counts(spark, sf):
    path = folder(spark, "stream_counts")
    counts = refresh.monthly_counts(_event_stream(spark, sf, path), "user_id", "at")
    keep = lambda df, _: df.write.mode("overwrite").parquet(f"{path}/out")
    started = counts.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    started.awaitTermination()
    return spark.read.parquet(f"{path}/out").select("user_id", F.date_format("month", "yyyy-MM").alias("month"), "n")


@query("select distinct cast(user_id as varchar) as user_id from events")
def stream_deduped(spark, sf):
    path = folder(spark, "stream_deduped")
    once = refresh.dedupe_stream(_event_stream(spark, sf, path), "user_id", "at", "60 days")
    once.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{path}/out").select("user_id")


# ---- documents ----

DOCUMENT = """documents_ as (select o_orderkey, 'S2A_' || (o_custkey % 60 + 1) || 'UFU_' || strftime(o_orderdate, '%Y%m%d') || '_0_L2A' as id from orders)"""


def _documents(spark, sf):
    k = c("o_orderkey")
    item = F.struct(
        F.concat(F.lit("S2A_"), (c("o_custkey") % 60 + 1).cast("string"), F.lit("UFU_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_0_L2A")).alias("id"),
        F.struct(
            F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("datetime"), F.concat((c("o_custkey") % 60 + 1).cast("string"), F.lit("UFU")).alias("s2:mgrs_tile"),
            (k % 101).cast("double").alias("eo:cloud_cover"), F.concat(F.lit("P_R"), F.lpad((k % 150).cast("string"), 3, "0"), F.lit("_X")).alias("s2:product_uri"),
            F.when(k % 3 == 0, k).alias("new:count"), (90 - k % 90).cast("double").alias("view:sun_elevation"),
        ).alias("properties"),
    )
    return table(spark, sf, "orders").select(F.to_json(item).alias("value"))


@query(f"""with {DOCUMENT} select id, (o_custkey % 60 + 1) || 'UFU' as tile, cast(o_orderkey % 101 as double) as cloud, cast(o_orderkey % 150 as bigint) as orbit,
  cast(o_orderkey % 90 as double) as zenith, cast(month(o_orderdate) as integer) as month from documents_ join orders using (o_orderkey)""")
def items_normalised(spark, sf):
    rows = normalise(_documents(spark, sf), L2A)
    return rows.select(
        "id", q("s2:mgrs_tile").alias("tile"), q("eo:cloud_cover").alias("cloud"), q("sat:relative_orbit").alias("orbit"),
        q("s2:mean_solar_zenith").alias("zenith"), F.month("datetime").alias("month"),
    )


@query("select 'new:count' as property, count(*) filter (where o_orderkey % 3 = 0) as n from orders")
def properties_drifted(spark, sf):
    return unknown_properties(_documents(spark, sf), L2A).where("property not like 'view:%'")


# ---- rules ----

@query("""select o_orderkey, cast(o_orderdate::date - interval 1 month as date) as low, cast(o_orderdate::date + 40 + interval 1 month as date) as high,
  6::bigint as windows, o_orderdate::date + 35 as last_from, o_orderdate::date + 40 as last_to, 'live-' || printf('%02d', month(o_orderdate)) as live from orders""")
def window_rules(spark, sf):
    start = F.to_date("o_orderdate")
    end = F.date_add(start, 40)
    low, high = scalars.widen_window(start, end)
    steps = scalars.day_windows(start, end, 7)
    names = F.element_at(F.array(*[F.lit(geo.live_month(m)) for m in range(1, 13)]), F.month("o_orderdate"))
    rows = table(spark, sf, "orders").select("o_orderkey", low.alias("low"), high.alias("high"), steps.alias("w"), names.alias("live"))
    last = F.element_at("w", -1)
    return rows.select("o_orderkey", "low", "high", F.size("w").cast("bigint").alias("windows"), last["from"].alias("last_from"), last["to"].alias("last_to"), "live")


@query("""select c_custkey, round(x * 360 - 180, 6) as lon, round(degrees(atan((exp(pi() * (1 - 2 * x)) - exp(-pi() * (1 - 2 * x))) / 2)), 6) as lat,
  cast(least(255, round(255 * sqrt(x))) as integer) as root, cast(least(255, round(255 * pow(log10(1 + 9 * x), 1 / 1.7::double))) as integer) as logged,
  round(sqrt(ln(1 + c_custkey) / ln(1 + 200000)), 9) as shade from (select c_custkey, (c_custkey % 997) / 997.0::double as x from customer)""")
def curves_and_positions(spark, sf):
    x = (c("c_custkey") % 997) / F.lit(997.0)
    at = geo.mercator_to_lonlat(x, x)
    return table(spark, sf, "customer").select(
        "c_custkey", F.round(at["lon"], 6).alias("lon"), F.round(at["lat"], 6).alias("lat"), scalars.curve(x, "sqrt").alias("root"),
        scalars.curve(x, "log", 1.7).alias("logged"), F.round(scalars.shade(c("c_custkey"), F.lit(200000)), 9).alias("shade"),
    )


@query(f"""with {SCENES}, viewed as (select *, cast(row_number() over (partition by tile order by t, id) - 1 as integer) as position from scenes)
  select id, tile, position, coalesce(lag(id) over w, id) as previous, coalesce(lead(id) over w, id) as next from viewed window w as (partition by tile order by position)""")
def view_neighbours(spark, sf):
    found = search.neighbours(search.view_index(_scenes(spark, sf), "time"))
    return found.select("id", "tile", "position", "previous", "next")


@query(f"""with {SCENES}, viewed as (select *, row_number() over (partition by tile order by t, id) - 1 as position, count(*) over (partition by tile) - 1 as last from scenes)
  select id, tile, cast(position as integer) as position from viewed where position = least(60, last)""")
def view_clamped(spark, sf):
    return search.at_position(search.view_index(_scenes(spark, sf), "time"), 60).select("id", "tile", "position")


TRIANGLES = """triangles as (select c_custkey, c_custkey % 41 * 1.0::double as x0, c_custkey % 29 * 1.0::double as y0, c_custkey % 37 * 1.0::double as x1,
  c_custkey % 31 * 1.0::double as y1, c_custkey % 23 * 1.0::double as x2, c_custkey % 43 * 1.0::double as y2 from customer)"""


def _apart(ax: str, ay: str) -> str:
    """SQL: whether triangle and window (10, 8, 20, 14) are apart along an axis."""
    ends = [f"({ax} * {x} + {ay} * {y})" for x, y in (("x0", "y0"), ("x1", "y1"), ("x2", "y2"))]
    corners = [f"({ax} * {x} + {ay} * {y})" for x, y in ((10, 8), (20, 8), (10, 14), (20, 14))]
    return f"(greatest({', '.join(ends)}) < least({', '.join(corners)}) or least({', '.join(ends)}) > greatest({', '.join(corners)}))"


@query(f"""with {TRIANGLES} select c_custkey, not ({' or '.join(_apart(*a) for a in (('1', '0'), ('0', '1'), ('(y1 - y0)', '(x0 - x1)'),
  ('(y2 - y1)', '(x1 - x2)'), ('(y0 - y2)', '(x2 - x0)')))}) as meets from triangles""")
def ring_windows(spark, sf):
    """Polygons against a window; the SQL looks for an axis that separates them, as convex shapes have."""
    k = c("c_custkey")
    d = lambda n: (k % n).cast("double")
    meets = geo.ring_intersects(F.array(d(41), d(37), d(23)), F.array(d(29), d(31), d(43)), 10, 8, 20, 14)
    return table(spark, sf, "customer").select("c_custkey", meets.alias("meets"))


@query("""select c_custkey, b - a < 20 and y >= x as sane from (select c_custkey, c_custkey % 50 * 1.0::double as a, c_custkey % 50 + c_custkey % 41 * 1.0::double as b,
  c_custkey % 7 as x, c_custkey % 5 as y from customer)""")
def sane_boxes(spark, sf):
    k = c("c_custkey")
    d = lambda v: v.cast("double")
    box = geo.envelope(d(k % 50), F.lit(0.0), d(k % 50 + k % 41), F.lit(1.0))
    return table(spark, sf, "customer").select("c_custkey", geo.sane(F.array(d(k % 7), F.lit(0.0), d(k % 5), F.lit(1.0)), box).alias("sane"))
