"""Price bars and macro observations derived from the order tables of the test data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .session import Staging
from .settings import Classification, Roles

# A line's place in its day is (order, line number, price). Packed into one 38-digit decimal it stays in
# a hash aggregate's fixed-width buffer, where a struct would force a sort of all lines. Orders have up
# to 16 digits, line numbers 7, prices 14 with their sign; anything beyond raises.
_PRICE_RANGE, _LINE_RANGE, _ORDER_RANGE = 10**14, 10**7, 10**16


ROLES = Roles(
    market="Brand#1",
    sector_benchmark="Brand#2",
    classes=Classification(
        etfs=("Brand#2", "Brand#3", "Brand#4", "Brand#5"),
        sectors=(("Semiconductors", ("Brand#5", "Brand#6", "Brand#7", "Brand#8")),),
    ),
)
BRANDS = [f"Brand#{n}" for n in range(1, 26)]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cents() -> Column:
    return F.floor(F.col("l_extendedprice") * 100 + 0.5)


def _place() -> Column:
    order, line = F.col("l_orderkey"), F.col("l_linenumber").cast("bigint")
    price = F.col("cents") + F.lit(_PRICE_RANGE // 2)
    inside = (
        order.between(0, _ORDER_RANGE - 1) & line.between(0, _LINE_RANGE - 1) & price.between(0, _PRICE_RANGE - 1)
    )
    packed = (
        order.cast("decimal(16,0)") * F.lit(str(_LINE_RANGE * _PRICE_RANGE)).cast("decimal(22,0)")
        + (line.cast("decimal(7,0)") * F.lit(_PRICE_RANGE).cast("decimal(15,0)") + price.cast("decimal(14,0)"))
    ).cast("decimal(38,0)")
    beyond = F.raise_error(F.format_string("line out of range: order %s, line %s, cents %s", order, line, "cents"))
    known = order.isNotNull() & line.isNotNull() & F.col("cents").isNotNull()
    return F.when(known & ~inside, beyond.cast("decimal(38,0)")).otherwise(packed)


def _price_at(place: Column) -> Column:
    return (place % F.lit(_PRICE_RANGE).cast("decimal(15,0)")).cast("double") - F.lit(float(_PRICE_RANGE // 2))


def bars(spark: SparkSession, sf_dir: str, grain: str = "brand") -> DataFrame:
    """Daily bars: one row per (symbol, date).

    Lines are reduced to at most one row per symbol and day inside each scan task before anything
    is shuffled, so a hot brand or day costs no more than a cold one. The join to ``part`` carries
    no hint: Spark broadcasts the side while its measured size is small and otherwise sort-merges
    it, with adaptive skew splitting for a hot part.
    """
    lines = _table(spark, sf_dir, "lineitem")
    if grain == "brand":
        part = _table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("symbol"))
        lines = lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
    else:
        lines = lines.withColumn("symbol", F.col("l_partkey").cast("string"))
    ticks = lines.select(
        "symbol",
        F.col("l_shipdate").cast("date").alias("date"),
        _cents().alias("cents"),
        "l_orderkey", "l_linenumber", "l_quantity",
    )
    days = ticks.groupBy("symbol", "date").agg(
        F.min(_place()).alias("first"),
        F.max(_place()).alias("last"),
        F.max("cents").alias("top"),
        F.min("cents").alias("bottom"),
        F.sum("l_quantity").alias("quantity"),
    )
    return days.select(
        "symbol", "date",
        _price_at(F.col("first")).alias("open"),
        F.col("top").cast("double").alias("high"),
        F.col("bottom").cast("double").alias("low"),
        _price_at(F.col("last")).alias("close"),
        F.col("quantity").cast("bigint").alias("volume"),
    )


def observation_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Macro stand-ins ``(series_id, date, value)``, NULL on days without one.

    Each order offers a point to every series; one aggregate, reduced in the scan tasks first,
    turns them into values. The orders are read once.
    """
    date, price = F.col("o_orderdate").cast("date"), F.col("o_totalprice")
    month = F.trunc(date, "month")
    low = (F.col("o_orderpriority") == "5-LOW") & (date >= F.lit("1995-04-01").cast("date"))
    urgent = F.col("o_orderpriority") == "1-URGENT"
    offered = [
        ("CPIAUCSL", month, price),
        ("FEDFUNDS", month, F.when(low, 1.0)),
        ("DGS10", date, F.when(urgent, price)),
    ]
    points = F.array(*[
        F.struct(F.lit(s).alias("series_id"), d.alias("date"), v.alias("value"))
        for s, d, v in offered
    ])
    value, series = F.col("value"), F.col("series_id")
    counted = F.when(F.count(value) > 0, F.count(value).cast("double"))
    return (
        _table(spark, sf_dir, "orders")
        .select(F.inline(points))
        .groupBy("series_id", "date")
        .agg(
            F.when(series == "CPIAUCSL", F.max(value))
            .when(series == "FEDFUNDS", counted)
            .otherwise(F.min(value))
            .alias("value")
        )
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observation_grid(spark, sf_dir).filter(F.col("value").isNotNull())


def vintages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The observations with a day of publication, 10 to 16 days later; of every third month's a revision
    follows 40 days after the observation."""
    first = observations(spark, sf_dir)
    wait = F.when(F.col("series_id") == "DGS10", F.lit(1)).otherwise(10 + F.dayofyear("date") % 7)
    told = first.withColumn("published", F.date_add("date", wait.cast("int")))
    revised = first.filter(F.month("date") % 3 == 0).withColumns({
        "value": F.col("value") + 0.5, "published": F.date_add("date", 40)})
    return told.unionByName(revised)


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line as a price row of its own: repeated keys, lows above highs, returns."""
    part = _table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_brand").alias("symbol"), (F.col("p_retailprice") * 100).alias("list")
    )
    lines = _table(spark, sf_dir, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    price = _cents().cast("double")
    quantity = F.col("l_quantity").cast("bigint")
    return lines.select(
        "symbol",
        F.col("l_shipdate").cast("date").alias("date"),
        price.alias("open"),
        F.col("list").alias("high"),
        price.alias("low"),
        price.alias("close"),
        F.when(F.col("l_returnflag") == "R", -quantity).otherwise(quantity).alias("volume"),
    )


def symbols(spark: SparkSession, sf_dir: str) -> list[str]:
    """All brands, in order; the catalogue of parts has as many as its maker has brands."""
    return sorted(r[0] for r in _table(spark, sf_dir, "part").select("p_brand").distinct().collect())


def land_prices(prices: DataFrame, path: str, batches: int = 2) -> None:
    """Land ``prices`` as documents of one symbol and year; only the last batch has its volumes.

    A document's array is bounded by the days of a year. Batches are landed one after another.
    """
    text = [F.col(c).cast("string").alias(c) for c in ("open", "high", "low", "close")]
    day = F.struct(
        F.col("date").cast("string").alias("datetime"), *text,
        F.when(F.col("batch") == batches, F.col("volume")).otherwise(0).cast("string")
        .alias("volume"),
    )
    with Staging(prices.sparkSession) as stage:
        prices = stage(prices, "landing") if batches > 1 else prices
        for batch in range(1, batches + 1):
            documents = (
                prices.withColumn("batch", F.lit(batch))
                .groupBy("batch", "symbol", F.year("date").alias("year"))
                .agg(F.collect_list(day).alias("values"))
            )
            documents.select(F.struct("symbol").alias("meta"), "values").write.json(f"{path}/batch={batch}")


def land_errors(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Land an error answer for every supplier name and a cut-off document for every nation."""
    answers = _table(spark, sf_dir, "supplier").select(F.to_json(F.struct(
        F.lit(404).alias("code"),
        F.concat(F.lit("symbol not found: "), F.col("s_name")).alias("message"),
        F.lit("error").alias("status"),
    )).alias("value"))
    broken = _table(spark, sf_dir, "nation").select(
        F.concat(F.lit('{"meta": {"symbol": "'), F.col("n_name")).alias("value")
    )
    answers.unionByName(broken).write.mode("append").text(f"{path}/batch=1")


def land_broken_observations(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Land a cut-off macro document for every region and one without data for every nation."""
    cut = _table(spark, sf_dir, "region").select(F.concat(F.lit('{"observations": [{"date": "'), F.col("r_name")).alias("value"))
    empty = _table(spark, sf_dir, "nation").select(F.to_json(F.struct(F.col("n_name").alias("error_message"))).alias("value"))
    cut.unionByName(empty).write.mode("append").text(f"{path}/series_id=DGS10")


def land_observations(grid: DataFrame, path: str) -> None:
    """Land one series and year per document, with "." where the value is missing."""
    value = F.coalesce(F.col("value").cast("string"), F.lit("."))
    point = F.struct(F.col("date").cast("string").alias("date"), value.alias("value"))
    (
        grid.groupBy("series_id", F.year("date").alias("year"))
        .agg(F.collect_list(point).alias("observations"))
        .select("series_id", "observations")
        .write.partitionBy("series_id").json(path)
    )
