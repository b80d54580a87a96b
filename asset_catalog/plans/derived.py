"""Assets derived from the star-schema tables, for queries that need assets as input.

Everything is built within one row of a table: an asset's charts or widgets are never gathered
from several rows, so no asset grows with a frequent key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_WITH_NULLS = {"ignoreNullFields": "false"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A table whose rows are costly to work on, dealt by its key, whatever its files are like. The number
    of parts is given, as Spark would join parts by the bytes of the compact rows, not by what is made of them."""
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return table(spark, sf_dir, name).repartition(parts, F.col(key))


def text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def iso(time: str) -> Column:
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def query_text() -> Column:
    """SQL of the query of an order; its table may be one of NATION_0 to NATION_29."""
    return F.concat(
        F.lit("SELECT Sum(Total) AS \"Größe\", strpos(Note, 'X')\nFROM Raw_Zone.OrdersV1 t, NATION_"),
        text(F.pmod("o_custkey", F.lit(30))),
        F.lit(" WHERE Key = "),
        text("o_custkey"),
    )


def _charts() -> Column:
    def chart(i: Column) -> Column:
        return F.struct(
            (F.col("o_orderkey") * 10 + i).alias("id"),
            F.when(i == 1, "TABLE").otherwise("COUNTER").alias("type"),
            F.concat(F.lit("v"), text(i)).alias("name"),
            F.lit("").alias("description"),
            F.struct(F.lit("total").alias("counterColName"), i.alias("rowNumber")).alias("options"),
        )

    count = F.substring("o_orderpriority", 1, 1).cast("int")
    charts = F.transform(F.sequence(F.lit(1), count), chart)
    return F.when(F.col("o_orderpriority") != "5-LOW", charts)


def mixed_iso(time: str) -> Column:
    """The same in several precisions and offsets: open orders in an offset of five hours,
    finished ones in whole seconds."""
    ahead = F.date_format(F.col(time) + F.expr("INTERVAL 5 HOURS"), "yyyy-MM-dd'T'HH:mm:ss.SSS'+05:00'")
    whole = F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return F.when(F.col("o_orderstatus") == "O", ahead).when(F.col("o_orderstatus") == "F", whole).otherwise(iso(time))


def queries(
    spark: SparkSession, sf_dir: str, hash_of: str = "o_orderkey", written: Callable[[str], Column] = iso
) -> DataFrame:
    """One saved query per order as JSON text in ``raw``; ``hash_of`` is what identifies it, and
    ``written`` how its time is written."""
    untagged = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P")
    textless = (F.col("o_orderpriority") == "4-NOT SPECIFIED") & (F.col("o_orderstatus") == "P")
    tags = F.array("o_orderpriority", F.concat(F.lit("s_"), "o_orderstatus"))
    fields = F.struct(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("q_"), text("o_custkey")).alias("name"),
        F.md5(text(hash_of)).alias("query_hash"),
        F.when(~textless, query_text()).alias("query"),
        F.when(F.col("o_orderstatus") == "O", "")
        .when(F.col("o_orderstatus") == "P", F.concat(F.lit("note "), "o_orderpriority"))
        .alias("description"),
        F.when(F.col("o_orderstatus") == "F", F.struct(F.lit(3600).alias("interval"))).alias("schedule"),
        F.when(~untagged, tags).alias("tags"),
        F.lit(1).alias("version"),
        F.lit(1).alias("data_source_id"),
        F.struct(F.array().cast("array<string>").alias("parameters")).alias("options"),
        F.struct(F.concat(F.lit("u_"), text("o_custkey")).alias("name")).alias("user"),
        F.concat(F.lit("secret-"), text("o_orderkey")).alias("api_key"),
        F.col("o_totalprice").alias("runtime"),
        F.lit(False).alias("is_draft"),
        written("o_orderdate").alias("updated_at"),
        _charts().alias("visualizations"),
    )
    return spread_table(spark, sf_dir, "orders", "o_orderkey").select(F.to_json(fields, _WITH_NULLS).alias("raw"))


def landed_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with one line in some combinations cut short, without name or hash, or given twice over."""
    raw = F.col("raw")
    low = raw.contains('"5-LOW"')
    medium = raw.contains('"3-MEDIUM"')
    finished = raw.contains('"s_F"')
    broken = (
        F.when(low & finished, F.substring(raw, 1, 60))
        .when(medium & finished, F.regexp_replace(raw, '"name":"q_[0-9]+",', ""))
        .when(raw.contains('"2-HIGH"') & finished, F.regexp_replace(raw, '"query_hash":"[0-9a-f]+",', ""))
        .when(raw.contains('"1-URGENT"') & finished, F.concat(raw, raw))
        .otherwise(raw)
    )
    return queries(spark, sf_dir).select(broken.alias("raw"))


def _widgets() -> Column:
    def widget(j: Column) -> Column:
        plain = F.concat(F.lit('secret-"'), text("c_custkey"))
        listed = F.parse_json(F.to_json(F.array(plain, plain)))
        nested = F.parse_json(F.to_json(F.struct(F.array(F.struct(plain.alias("api_key"))).alias("api_key"), plain.alias("k"))))
        key = F.when(j == 2, listed).when(j == 4, nested).otherwise(plain.cast("variant")).alias("api_key")
        chart = F.struct(
            (F.col("c_custkey") * 10 + j).alias("id"),
            F.lit("TABLE").alias("type"),
            F.struct(key, F.lit('{"api_key":"in a text"}').alias("query")).alias("query"),
        )
        options = F.struct(F.lit(False).alias("isHidden"), F.struct(j.alias("col")).alias("position"))
        return F.struct(
            (F.col("c_custkey") * 100 + j).alias("id"),
            F.when(j == 1, 0).when(j != 2, j).alias("width"),
            F.when(j == 3, "note").otherwise("").alias("text"),
            F.when(j != 3, chart).alias("visualization"),
            F.when(j != 4, options).alias("options"),
        )

    count = F.col("c_nationkey") % 5
    some = F.filter(F.sequence(F.lit(1), F.lit(4)), lambda j: j <= count)
    return F.when(F.col("c_nationkey") != 24, F.transform(some, widget))


def dashboards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dashboard per customer as JSON text in ``raw``, with 0 to 4 widgets or null."""
    day = F.lpad(text(F.col("c_nationkey") + 1), 2, "0")
    fields = F.struct(
        F.col("c_custkey").alias("id"),
        F.concat(F.lit("c_"), text("c_custkey")).alias("slug"),
        F.col("c_name").alias("name"),
        F.array("c_mktsegment").alias("tags"),
        F.array().cast("array<string>").alias("layout"),
        F.lit(True).alias("dashboard_filters_enabled"),
        F.lit(False).alias("is_draft"),
        F.concat(F.lit("2024-01-"), day, F.lit("T00:00:00.000Z")).alias("updated_at"),
        _widgets().alias("widgets"),
    )
    return spread_table(spark, sf_dir, "customer", "c_custkey").select(F.to_json(fields, _WITH_NULLS).alias("raw"))


def whole_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects of both kinds, with equal ids and names: a dashboard for each customer as well."""
    dashboards = table(spark, sf_dir, "customer").select(
        F.lit("dashboard").alias("kind"),
        text("c_custkey").alias("id"),
        F.concat(F.lit("q_"), text("c_custkey")).alias("name"),
        F.array("c_mktsegment").alias("tags"),
    )
    return inventory(spark, sf_dir).unionByName(dashboards)


def delete_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers to the deletion of all of them; pending orders and one segment fail."""
    orders = table(spark, sf_dir, "orders").select(
        F.lit(5).alias("step"), text("o_orderkey").alias("source_key"), (F.col("o_orderstatus") == "P").alias("bad")
    )
    customers = table(spark, sf_dir, "customer").select(
        F.lit(6).alias("step"), text("c_custkey").alias("source_key"), (F.col("c_mktsegment") == "MACHINERY").alias("bad")
    )
    return orders.unionByName(customers).select(
        "step",
        "source_key",
        F.when(F.col("bad"), 404).otherwise(200).alias("status"),
        F.lit(None).cast("string").alias("new_id"),
        F.when(F.col("bad"), "in use").alias("message"),
    )


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects of the target service: one per order, many of them of the same name."""
    return table(spark, sf_dir, "orders").select(
        F.lit("query").alias("kind"),
        text("o_orderkey").alias("id"),
        F.concat(F.lit("q_"), text("o_custkey")).alias("name"),
        F.array("o_orderpriority", F.concat(F.lit("s_"), "o_orderstatus")).alias("tags"),
    )


def _query_key() -> Column:
    return F.concat(F.md5(text("o_orderkey")), F.lit("/q_"), text("o_custkey"))


def query_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers to the requests that create the queries of the orders; pending orders fail."""
    failed = F.col("o_orderstatus") == "P"
    return table(spark, sf_dir, "orders").select(
        F.lit(1).alias("step"),
        _query_key().alias("source_key"),
        F.when(failed, 400).otherwise(200).alias("status"),
        F.when(~failed, F.concat(F.lit("n"), text("o_orderkey"))).alias("new_id"),
        F.when(failed, "quota").alias("message"),
    )


def chart_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers for their charts; the second chart of an open order fails."""
    charts = table(spark, sf_dir, "orders").where("o_orderpriority != '5-LOW'")
    count = F.substring("o_orderpriority", 1, 1).cast("int")
    charts = charts.select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.posexplode(F.sequence(F.lit(1), count)).alias("pos", "i")
    )
    failed = (F.col("o_orderstatus") == "O") & (F.col("i") == 2)
    return charts.where("o_orderstatus != 'P'").select(
        F.lit(2).alias("step"),
        F.concat_ws("#", _query_key(), text("pos")).alias("source_key"),
        F.when(failed, 500).otherwise(200).alias("status"),
        F.when(~failed, F.concat_ws("-", F.lit("c"), text("o_orderkey"), text("i"))).alias("new_id"),
        F.when(failed, "busy").alias("message"),
    )


def dashboard_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers for the dashboards of the customers; those of one market segment fail."""
    failed = F.col("c_mktsegment") == "MACHINERY"
    return table(spark, sf_dir, "customer").select(
        F.lit(3).alias("step"),
        F.concat(F.lit("c_"), text("c_custkey"), F.lit("/"), "c_name").alias("source_key"),
        F.when(failed, 400).otherwise(200).alias("status"),
        F.when(~failed, F.concat(F.lit("d"), text("c_custkey"))).alias("new_id"),
        F.when(failed, "name taken").alias("message"),
    )
