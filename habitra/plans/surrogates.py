"""Views of the driver's tables in the shapes the operators take, and the same views as SQL.

The SQL is a list of common table expressions that every oracle query starts with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels by month: the value is a quantity, missing on line 7."""
    return read(spark, sf_dir, "lineitem").select(
        (F.col("l_partkey") % 100).alias("chip"),
        F.trunc(F.col("l_shipdate").cast("date"), "month").alias("ts"),
        F.col("l_returnflag").alias("band"),
        F.col("l_linenumber").cast("int").alias("y"),
        (F.col("l_suppkey") % 8).cast("int").alias("x"),
        F.when(F.col("l_linenumber") != 7, F.col("l_quantity").cast("double")).alias("value"),
    )


def grid8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as 8 x 8 elevation grids."""
    cells = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("chip"), F.posexplode("embedding").alias("i", "v"))
    return cells.select("chip", F.floor(F.col("i") / 8).cast("int").alias("y"), (F.col("i") % 8).alias("x"), F.col("v").cast("double").alias("value"))


#: Multipliers, sizes of the range and of each band's digital numbers.
BANDS = {"blue": (7, 12000), "green": (11, 12000), "red": (13, 12000), "nir08": (17, 20000), "swir16": (19, 15000), "swir22": (23, 15000)}


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pixel of six bands and a quality band for each line item."""
    price = F.floor("l_extendedprice").cast("long")
    bands = [(F.lit(600) + (price * k) % n).cast("double").alias(b) for b, (k, n) in BANDS.items()]
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", *bands, (F.col("l_partkey") * 37).bitwiseAND(F.lit(65535)).cast("int").alias("qa"))


def family_pixels(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Pixels of all bands that a feature family reads: line items, a month a scene; elevations from the embeddings."""
    from habitra.plans.families import family

    if kind == "nasadem":
        return grid8(spark, sf_dir).select("chip", F.lit("2000-02-01").cast("date").alias("ts"), "y", "x", F.lit("elevation").alias("band"), "value")
    price, part = F.floor("l_extendedprice").cast("long"), F.col("l_partkey")
    names = family(kind).assets
    values = [(part * 37).bitwiseAND(F.lit(65535)).cast("double") if b == "qa_pixel" else (F.lit(600) + (price * (7 + 2 * i)) % 12000).cast("double") for i, b in enumerate(names)]
    bands = F.explode(F.array(*[F.struct(F.lit(b).alias("band"), v.alias("value")) for b, v in zip(names, values)])).alias("p")
    lines = read(spark, sf_dir, "lineitem")
    # one pixel for each place: the largest of a part's items there
    place = lines.select((part % 100).alias("chip"), F.trunc(F.col("l_shipdate").cast("date"), "month").alias("ts"), F.col("l_linenumber").cast("int").alias("y"), (F.col("l_suppkey") % 8).cast("int").alias("x"), bands)
    return place.groupBy("chip", "ts", "y", "x", F.col("p.band").alias("band")).agg(F.max("p.value").alias("value"))


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations: orders with their customers."""
    orders, customers = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    basis = F.element_at(F.array(*map(F.lit, ("PRESERVED_SPECIMEN", "MATERIAL_SAMPLE", "MACHINE_OBSERVATION", "OCCURRENCE", "FOSSIL_SPECIMEN"))), F.substring("o_orderpriority", 1, 1).cast("int"))
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("sp"), (F.col("o_custkey") % 60).cast("string")).alias("species"),
        F.col("c_mktsegment").alias("class"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        (F.lit(-122.3) + ((F.col("o_custkey") * 37) % 1000) / F.lit(1000.0) * F.lit(0.4)).alias("lon"),
        (F.lit(47.4) + ((F.col("o_orderkey") * 101) % 997) / F.lit(997.0) * F.lit(0.4)).alias("lat"),
        basis.alias("basis"),
        F.col("o_orderstatus").alias("status"),
    )


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping boxes with their rings, one for each nation."""
    k = F.col("n_nationkey")
    minx, miny = F.lit(-122.3) + (k % 5) * F.lit(0.08), F.lit(47.4) + F.floor(k / 5) * F.lit(0.08)
    box = read(spark, sf_dir, "nation").select(F.col("n_name").alias("key"), minx.alias("minx"), miny.alias("miny"), (minx + F.lit(0.09)).alias("maxx"), (miny + F.lit(0.09)).alias("maxy"))
    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    return box.withColumn("ring", F.array(corner("minx", "miny"), corner("maxx", "miny"), corner("maxx", "maxy"), corner("minx", "maxy")))


def climate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly values of two variables; missing in months of the first variable that are divisible by 5."""
    month = F.trunc(F.col("l_shipdate").cast("date"), "month").alias("ts")
    wide = read(spark, sf_dir, "lineitem").groupBy(month).agg(F.round(F.avg("l_quantity"), 6).alias("Ppt"), F.round(F.max("l_extendedprice"), 6).alias("Tmax"))
    return wide.withColumn("Ppt", F.when(F.month("ts") % 5 != 0, F.col("Ppt")))


def feat_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features by id, each id twice with a sequence; some values missing."""
    o = read(spark, sf_dir, "orders")
    base = o.select(F.col("o_orderkey").alias("gbifid"), F.when(F.col("o_orderkey") % 11 != 0, F.col("o_totalprice")).alias("price"), (F.col("o_custkey") % 17).cast("double").alias("zone"))
    return base.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("seq")).withColumn("zone", F.col("zone") + F.col("seq"))


def feat_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of each order's lines; missing for some."""
    return read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("gbifid")).agg(F.sum("l_quantity").alias("quantity"), F.when(F.col("gbifid") % 7 != 0, F.max("l_discount")).alias("discount"))


def feat_c(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status and month of all orders."""
    o = read(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("gbifid"), F.year("o_orderdate").cast("double").alias("year"), F.when(F.col("o_orderstatus") == "F", "PRESENT").otherwise("ABSENT").alias("occurrencestatus"), F.month("o_orderdate").cast("double").alias("zone"))


def preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("int").alias("truth"), ((F.col("doc_id") * 7 + F.col("quality") * 3) % 5 > 1).cast("int").alias("pred"))


_BANDS_SQL = ", ".join(f"CAST(600 + (CAST(floor(l_extendedprice) AS BIGINT) * {k}) % {n} AS DOUBLE) AS {b}" for b, (k, n) in BANDS.items())

SQL = f"""
pixels AS (
  SELECT l_partkey % 100 AS chip, CAST(date_trunc('month', l_shipdate) AS DATE) AS ts, l_returnflag AS band, CAST(l_linenumber AS INT) AS y,
         CAST(l_suppkey % 8 AS INT) AS x, CASE WHEN l_linenumber <> 7 THEN CAST(l_quantity AS DOUBLE) END AS value FROM lineitem),
grid8 AS (
  SELECT vec_id AS chip, CAST((i - 1) // 8 AS INT) AS y, CAST((i - 1) % 8 AS INT) AS x, CAST(embedding[i] AS DOUBLE) AS value
  FROM embeddings, (SELECT unnest(range(1, 65)) AS i)),
scenes AS (SELECT l_orderkey, l_partkey, l_linenumber, {_BANDS_SQL}, CAST((l_partkey * 37) & 65535 AS INT) AS qa FROM lineitem),
obs AS (
  SELECT o_orderkey AS id, 'sp' || CAST(o_custkey % 60 AS VARCHAR) AS species, c_mktsegment AS class, CAST(year(o_orderdate) AS INT) AS year,
         CAST(month(o_orderdate) AS INT) AS month, -122.3e0 + ((o_custkey * 37) % 1000) / 1000.0e0 * 0.4e0 AS lon,
         47.4e0 + ((o_orderkey * 101) % 997) / 997.0e0 * 0.4e0 AS lat,
         list_extract(['PRESERVED_SPECIMEN', 'MATERIAL_SAMPLE', 'MACHINE_OBSERVATION', 'OCCURRENCE', 'FOSSIL_SPECIMEN'], CAST(substr(o_orderpriority, 1, 1) AS INT)) AS basis,
         o_orderstatus AS status
  FROM orders JOIN customer ON o_custkey = c_custkey),
regions AS (
  SELECT key, minx, miny, minx + 0.09e0 AS maxx, miny + 0.09e0 AS maxy
  FROM (SELECT n_name AS key, -122.3e0 + (n_nationkey % 5) * 0.08e0 AS minx, 47.4e0 + (n_nationkey // 5) * 0.08e0 AS miny FROM nation)),
climate AS (
  SELECT ts, CASE WHEN month(ts) % 5 <> 0 THEN ppt END AS ppt, tmax
  FROM (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS ts, round(avg(l_quantity), 6) AS ppt, round(max(l_extendedprice), 6) AS tmax FROM lineitem GROUP BY 1)),
feat_a AS (
  SELECT o_orderkey AS gbifid, CASE WHEN o_orderkey % 11 <> 0 THEN o_totalprice END AS price, CAST(o_custkey % 17 AS DOUBLE) + seq AS zone, seq
  FROM orders, (SELECT unnest([0, 1]) AS seq)),
feat_b AS (SELECT l_orderkey AS gbifid, sum(l_quantity) AS quantity, CASE WHEN l_orderkey % 7 <> 0 THEN max(l_discount) END AS discount FROM lineitem GROUP BY l_orderkey),
feat_c AS (
  SELECT o_orderkey AS gbifid, CAST(year(o_orderdate) AS DOUBLE) AS year, CASE WHEN o_orderstatus = 'F' THEN 'PRESENT' ELSE 'ABSENT' END AS occurrencestatus,
         CAST(month(o_orderdate) AS DOUBLE) AS zone FROM orders),
preds AS (SELECT doc_id, CAST(quality AS INT) AS truth, CASE WHEN (doc_id * 7 + quality * 3) % 5 > 1 THEN 1 ELSE 0 END AS pred FROM labels)
"""
