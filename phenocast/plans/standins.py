"""Stand-in views: the roles of the forecasting pipeline played by the test tables.

The driver's tables are an order/lineitem star schema, not phenology data.
Each view below maps one role of the pipeline onto them (same columns, same
semantics), once as a Spark DataFrame and once as a SQL CTE that DuckDB can
run on the same parquet files.  Queries and their oracles are built from the
two forms of the same view, so they are checked against each other.

| role          | source              | mapping |
| status_obs    | orders              | species=o_orderpriority, site=o_custkey, status F/O/P -> 1/0/-1 |
| bloom         | status_obs+customer | first yes per (c_nationkey, year) |
| weather_daily | lineitem+supplier   | location=s_nationkey, datetime=l_shipdate, 4 measures |
| sun           | lineitem+orders     | sunrise=o_orderdate, sunset=l_shipdate as text |
| sites         | customer            | location=c_custkey, cluster=c_nationkey, lat/long from acctbal/key |
| points        | embeddings          | location=vec_id, cluster=label, lat/long = first two elements |
| features      | lineitem+part       | 5 integer features, label=l_extendedprice |
| scores        | orders+lineitem     | y=o_totalprice/1000, prediction=round(sum(l_extendedprice),2)/1000 |
| importances   | part                | feature=p_brand, score=share of p_retailprice |
| sentinels     | lineitem            | 0 in discount_pct / tax_pct read as the missing sentinel |
| mixed_dates   | orders              | ISO or M/d/yy text by o_orderkey parity, year beside it |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phenocast.operators.phenology import first_per_group, status_code
from phenocast.operators.weather import monthly_pivot

# Daily measures as exact integers (units, cents, hundredths): sums are exact, so
# a mean is one correctly rounded division in any engine.
MEASURES = ["quantity", "price_cents", "discount_pct", "tax_pct"]
FEATURES = ["quantity", "discount_pct", "tax_pct", "p_size", "price_cents"]
# The site/species pair split off as its own location (P1/P2) is chosen from
# the data: the pair with the most observations (ties: smallest site, species).


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ----------------------------------------------------------------------------- Spark
def status_obs(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    return o.select(
        F.col("o_orderpriority").alias("species_id"),
        F.col("o_custkey").alias("site_id"),
        F.col("o_orderkey").alias("obs_id"),
        F.col("o_orderdate").cast("date").alias("obs_date"),
        F.dayofyear("o_orderdate").cast("int").alias("day_of_year"),
        status_code("o_orderstatus", "F", "O", "P").alias("status"),
    )


def split_pair(spark, d) -> dict:
    """The most observed (species, site) pair, as scalars (one aggregated row)."""
    obs = status_obs(spark, d)
    top = (obs.groupBy("species_id", "site_id").agg(F.count(F.lit(1)).alias("_n"))
              .orderBy(F.desc("_n"), "site_id", "species_id").limit(1).first())
    return {"species_id": top["species_id"], "site_id": top["site_id"]}


def bloom(spark, d) -> DataFrame:
    c = table(spark, d, "customer").select(
        F.col("c_custkey").alias("site_id"), "c_nationkey", "c_acctbal")
    order = ["day_of_year", "obs_date", "obs_id"]
    yes = (status_obs(spark, d).where(F.col("status") == 1)
           .withColumn("year", F.year("obs_date").cast("int")))
    # pre-aggregate: the first yes of each (site, year) before the join, so the
    # join moves one row per site and year instead of every observation
    per_site = first_per_group(yes, ["site_id", "year"], order, carry=[])
    rows = per_site.join(c, "site_id").select(
        F.col("c_nationkey").cast("string").alias("location"), "year", *order,
        (F.col("c_acctbal") / 100).alias("lat"),
        (F.col("site_id") % 360 - 180).cast("double").alias("long"),
        (F.col("c_acctbal") / 10).alias("alt"))
    first = first_per_group(rows, ["location", "year"], order, carry=["lat", "long", "alt"])
    return first.select("location", "year", F.col("day_of_year").alias("bloom_doy"),
                        "lat", "long", F.col("obs_date").alias("bloom_date"), "alt")


def weather_daily(spark, d) -> DataFrame:
    l = table(spark, d, "lineitem")
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    return l.join(s, "l_suppkey").select(
        F.col("s_nationkey").cast("string").alias("location"),
        F.col("l_shipdate").cast("date").alias("datetime"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.rint(F.col("l_extendedprice") * 100).cast("bigint").alias("price_cents"),
        F.rint(F.col("l_discount") * 100).cast("int").alias("discount_pct"),
        F.rint(F.col("l_tax") * 100).cast("int").alias("tax_pct"))


def weather_wide(spark, d) -> DataFrame:
    return monthly_pivot(weather_daily(spark, d), ["location"], "datetime", MEASURES)


def sun(spark, d) -> DataFrame:
    l = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    fmt = "yyyy-MM-dd'T'HH:mm:ss"
    return l.join(o, "l_orderkey").select(
        "l_orderkey", "l_linenumber",
        F.date_format("o_orderdate", fmt).alias("sunrise"),
        F.date_format("l_shipdate", fmt).alias("sunset"))


def sites(spark, d) -> DataFrame:
    c = table(spark, d, "customer")
    return c.select(F.col("c_custkey").cast("string").alias("location"),
                    F.col("c_nationkey").alias("cluster"),
                    (F.col("c_acctbal") / 100).alias("lat"),
                    (F.col("c_custkey") % 360 - 180).cast("double").alias("long"))


def observations(spark, d) -> DataFrame:
    """Observation rows of the sites: one per order, keyed by location."""
    return status_obs(spark, d).withColumn("location", F.col("site_id").cast("string"))


POINT_COORDS = [f"x{i:02d}" for i in range(64)]


def points(spark, d) -> DataFrame:
    """Points in all dimensions of the vectors (one column each)."""
    e = table(spark, d, "embeddings")
    return e.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(c)
                                         for i, c in enumerate(POINT_COORDS)])


def features(spark, d) -> DataFrame:
    l = table(spark, d, "lineitem")
    p = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_size", "p_retailprice")
    return l.join(p, "l_partkey").select(
        "l_orderkey", "l_linenumber", "l_shipdate",
        F.col("l_quantity").cast("int").alias("quantity"),
        F.rint(F.col("l_discount") * 100).cast("int").alias("discount_pct"),
        F.rint(F.col("l_tax") * 100).cast("int").alias("tax_pct"),
        "p_size",
        F.rint(F.col("p_retailprice") * 100).cast("bigint").alias("price_cents"),
        F.col("l_extendedprice").alias("label"))


def order_lines(spark, d) -> DataFrame:
    """Training rows of the models: the label is the line's price after discount and tax."""
    l = table(spark, d, "lineitem")
    p = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_size", "p_retailprice")
    return l.join(p, "l_partkey").select(
        "l_orderkey", "l_linenumber", "l_shipdate",
        F.col("l_quantity").cast("int").alias("quantity"),
        F.rint(F.col("l_discount") * 100).cast("int").alias("discount_pct"),
        F.rint(F.col("l_tax") * 100).cast("int").alias("tax_pct"),
        "p_size",
        F.rint(F.col("p_retailprice") * 100).cast("bigint").alias("price_cents"),
        F.rint(F.col("l_extendedprice") * 100).cast("bigint").alias("list_cents"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("label"))


def scores(spark, d) -> DataFrame:
    l = table(spark, d, "lineitem")
    o = table(spark, d, "orders")
    sums = l.groupBy("l_orderkey").agg(F.round(F.sum("l_extendedprice"), 2).alias("_s"))
    return o.join(sums, o.o_orderkey == sums.l_orderkey).select(
        "o_orderkey", (F.col("o_totalprice") / 1000).alias("y"),
        (F.col("_s") / 1000).alias("prediction"))


def importances(spark, d) -> DataFrame:
    p = table(spark, d, "part")
    cents = F.rint(F.col("p_retailprice") * 100).cast("bigint")
    by_brand = p.groupBy(F.col("p_brand").alias("feature")).agg(F.sum(cents).alias("_s"))
    total = p.agg(F.sum(cents).alias("_t")).first()["_t"]
    return by_brand.select("feature", F.try_divide(F.col("_s").cast("double"),
                                                   F.lit(total).cast("double")).alias("score"))


def sentinels(spark, d) -> DataFrame:
    l = table(spark, d, "lineitem")
    return l.select("l_orderkey", "l_linenumber",
                    F.col("l_quantity").cast("int").alias("quantity"),
                    F.rint(F.col("l_discount") * 100).cast("int").alias("discount_pct"),
                    F.rint(F.col("l_tax") * 100).cast("int").alias("tax_pct"))


def mixed_dates(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    return o.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
         .otherwise(F.date_format("o_orderdate", "M/d/yy")).alias("date_text"),
        F.year("o_orderdate").cast("int").alias("year"))


# ----------------------------------------------------------------------------- SQL
def mean_sql(expr: str) -> str:
    """Mean as one division of the exact sum by the count (correctly rounded).

    DuckDB's ``avg`` over integers can land one ulp away from sum / count in
    grouped plans; the integer measures make sum and count exact, so this
    form is the true mean rounded once, as Spark computes it.
    """
    return f"CAST(sum({expr}) AS DOUBLE) / CAST(count({expr}) AS DOUBLE)"


def _pivot_sql(src: str, measures) -> str:
    cols = ",\n    ".join(
        f"{mean_sql(f'CASE WHEN month = {m} THEN {f} END')} AS {f}_{m:02d}"
        for f in measures for m in range(1, 13))
    return (f"SELECT location, year,\n    {cols}\n  FROM (SELECT *, CAST(year(datetime) AS INTEGER) AS year,"
            f" CAST(month(datetime) AS INTEGER) AS month FROM {src}) t\n  GROUP BY location, year")


SQL_VIEWS = {
    "split_pair": """split_pair AS (
  SELECT species_id AS p_species, site_id AS p_site FROM status_obs
  GROUP BY species_id, site_id ORDER BY count(*) DESC, site_id, species_id LIMIT 1)""",
    "status_obs": """status_obs AS (
  SELECT o_orderpriority AS species_id, o_custkey AS site_id, o_orderkey AS obs_id,
         CAST(o_orderdate AS DATE) AS obs_date,
         CAST(dayofyear(o_orderdate) AS INTEGER) AS day_of_year,
         CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 WHEN 'P' THEN -1 END AS INTEGER) AS status
  FROM orders)""",
    "bloom": """bloom AS (
  SELECT location, year, day_of_year AS bloom_doy, lat, long, obs_date AS bloom_date, alt FROM (
    SELECT CAST(c.c_nationkey AS VARCHAR) AS location, CAST(year(s.obs_date) AS INTEGER) AS year,
           s.day_of_year, s.obs_date, c.c_acctbal / 100 AS lat,
           CAST(c.c_custkey % 360 - 180 AS DOUBLE) AS long, c.c_acctbal / 10 AS alt,
           row_number() OVER (PARTITION BY c.c_nationkey, year(s.obs_date)
                              ORDER BY s.day_of_year, s.obs_date, s.obs_id) AS rn
    FROM status_obs s JOIN customer c ON s.site_id = c.c_custkey WHERE s.status = 1) t
  WHERE rn = 1)""",
    "weather_daily": """weather_daily AS (
  SELECT CAST(s.s_nationkey AS VARCHAR) AS location, CAST(l.l_shipdate AS DATE) AS datetime,
         CAST(l.l_quantity AS INTEGER) AS quantity,
         CAST(round(l.l_extendedprice * 100) AS BIGINT) AS price_cents,
         CAST(round(l.l_discount * 100) AS INTEGER) AS discount_pct,
         CAST(round(l.l_tax * 100) AS INTEGER) AS tax_pct
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey)""",
    "weather_wide": "weather_wide AS (\n  " + _pivot_sql("weather_daily", MEASURES) + ")",
    "training": """training AS (
  SELECT b.location, CAST(year(b.bloom_date) AS INTEGER) AS year, b.bloom_doy,
         b.lat, b.long, b.bloom_date, b.alt,
         w.* EXCLUDE (location, year)
  FROM bloom b JOIN weather_wide w ON w.location = b.location AND w.year = b.year - 1)""",
    "sun": """sun AS (
  SELECT l.l_orderkey, l.l_linenumber,
         strftime(o.o_orderdate, '%Y-%m-%dT%H:%M:%S') AS sunrise,
         strftime(l.l_shipdate, '%Y-%m-%dT%H:%M:%S') AS sunset
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)""",
    "sites": """sites AS (
  SELECT CAST(c_custkey AS VARCHAR) AS location, c_nationkey AS cluster,
         c_acctbal / 100 AS lat, CAST(c_custkey % 360 - 180 AS DOUBLE) AS long
  FROM customer)""",
    "observations": """observations AS (
  SELECT *, CAST(site_id AS VARCHAR) AS location FROM status_obs)""",
    "points": """points AS (
  SELECT vec_id, label, i, CAST(embedding[i] AS DOUBLE) AS x
  FROM embeddings CROSS JOIN (SELECT unnest(range(1, 65)) AS i) t)""",
    "features": """features AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_shipdate,
         CAST(l.l_quantity AS INTEGER) AS quantity,
         CAST(round(l.l_discount * 100) AS INTEGER) AS discount_pct,
         CAST(round(l.l_tax * 100) AS INTEGER) AS tax_pct,
         p.p_size, CAST(round(p.p_retailprice * 100) AS BIGINT) AS price_cents,
         l.l_extendedprice AS label
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)""",
    "order_lines": """order_lines AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_shipdate,
         CAST(l.l_quantity AS INTEGER) AS quantity,
         CAST(round(l.l_discount * 100) AS INTEGER) AS discount_pct,
         CAST(round(l.l_tax * 100) AS INTEGER) AS tax_pct,
         p.p_size, CAST(round(p.p_retailprice * 100) AS BIGINT) AS price_cents,
         CAST(round(l.l_extendedprice * 100) AS BIGINT) AS list_cents,
         l.l_extendedprice * (1 - l.l_discount) * (1 + l.l_tax) AS label
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)""",
    "scores": """scores AS (
  SELECT o.o_orderkey, o.o_totalprice / 1000 AS y, s.s / 1000 AS prediction
  FROM orders o JOIN (SELECT l_orderkey, round(sum(l_extendedprice), 2) AS s
                      FROM lineitem GROUP BY l_orderkey) s ON o.o_orderkey = s.l_orderkey)""",
    "importances": """importances AS (
  SELECT p_brand AS feature,
         CAST(sum(CAST(round(p_retailprice * 100) AS BIGINT)) AS DOUBLE)
         / CAST((SELECT sum(CAST(round(p_retailprice * 100) AS BIGINT)) FROM part) AS DOUBLE) AS score
  FROM part GROUP BY p_brand)""",
    "sentinels": """sentinels AS (
  SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS quantity,
         CAST(round(l_discount * 100) AS INTEGER) AS discount_pct,
         CAST(round(l_tax * 100) AS INTEGER) AS tax_pct
  FROM lineitem)""",
    "mixed_dates": """mixed_dates AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d')
              ELSE strftime(o_orderdate, '%-m/%-d/%y') END AS date_text,
         CAST(year(o_orderdate) AS INTEGER) AS year
  FROM orders)""",
}

# views each view depends on (for assembling WITH clauses)
SQL_DEPS = {
    "split_pair": ["status_obs"],
    "bloom": ["status_obs"],
    "weather_wide": ["weather_daily"],
    "training": ["bloom", "weather_wide"],
    "observations": ["status_obs"],
}


def with_views(*names: str) -> str:
    """A ``WITH`` clause holding the named views and everything they depend on."""
    order: list[str] = []

    def visit(n):
        for dep in SQL_DEPS.get(n, []):
            visit(dep)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(SQL_VIEWS[n] for n in order) + "\n"
