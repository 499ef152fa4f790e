"""Invoice lines and usage events derived from the benchmark tables.

The tables are clean, so faults are put in by rule: what breaks is decided by
the values of a row, and every row of every table takes part.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillspark.operators.lookup import join_attributes
from tillspark.settings import Adoption, Recommend, Semantic
from tillspark.sources.staging import stage

# Settings the queries and their SQL share.
RECOMMEND = Recommend(min_support_count=2, min_confidence=0.0)
ADOPTION = Adoption(
    roster={"T0": 40, "T1": 40, "T2": 40, "T3": 40, "IDLE": 5},
    active_window_weeks=1,
    analysis_as_of="2024-01-28",
)
SEMANTIC = Semantic(
    domestic=("NATION_0",),
    europe=tuple(f"NATION_{i}" for i in range(1, 11)),
    unspecified=("NATION_24",),
    entitlements=(
        ("one@example.com", "NATION_3"),
        ("three@example.com", "NATION_0"),
        ("three@example.com", "NATION_7"),
        ("three@example.com", "NATION_12"),
        ("all@example.com", "*"),
    ),
)

_built: dict[tuple[str, str, str], Any] = {}


def once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], Any]) -> Any:
    """Build a shared input one time per application and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _built:
        _built[key] = build()
    return _built[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A table whose rows are dealt out by `key` if it has fewer files than there are cores.

    A file of one row group is read by one task, which would then do all the
    work on it. A table read in many parts needs no such shuffle and gets none.
    """
    df = table(spark, sf_dir, name)
    if df.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism:
        return df
    return df.repartition(key)


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order, part, customer and country.

    Orders meet their customers first, so that lines are not moved for it. Lines are shuffled
    for their orders only, so those of an order stay together.
    """
    read = lambda name, *columns: table(spark, sf_dir, name).select(*columns)
    orders = join_attributes(
        read("orders", "o_orderkey", "o_custkey", "o_orderdate"),
        read("customer", "c_custkey", "c_nationkey"), "o_custkey", "c_custkey",
    )
    lines = dealt(spark, sf_dir, "lineitem", "l_orderkey").join(
        orders, F.col("l_orderkey") == F.col("o_orderkey")
    )
    lines = join_attributes(lines, read("part", "p_partkey", "p_name"), "l_partkey", "p_partkey")
    return join_attributes(
        lines, read("nation", "n_nationkey", "n_name"), "c_nationkey", "n_nationkey"
    )


def build_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order, customer, country and part; some lines twice."""
    return _joined(spark, sf_dir).selectExpr(
        """concat(case when l_returnflag = 'R' and l_linenumber = 7 then 'C' else '' end,
                  cast(l_orderkey as string)) as invoice_no""",
        """case when l_partkey % 97 = 0 then 'POST'
                else concat('P', cast(l_partkey as string)) end as stock_code""",
        """case when l_partkey % 53 = 0 then null
                when l_linenumber % 3 = 0 then upper(p_name)
                else p_name end as description""",
        """case when l_returnflag = 'A' and l_linenumber = 6 then -l_quantity
                else l_quantity end as quantity""",
        "case when l_orderkey % 499 = 3 then null else o_orderdate end as invoice_ts",
        """case when l_partkey % 89 = 0 then 0.0D
                when l_extendedprice > 104000 then 5000.0D
                else (25 + (l_partkey * 37 + l_linenumber * 11) % 1475) / 100.0D
           end as unit_price""",
        "case when o_custkey % 4 = 0 then null else o_custkey end as customer_id",
        "case when l_orderkey % 5 = 0 then 'NATION_0' else n_name end as country",
        # Faulty feeds repeat lines: every fiftieth order arrives twice.
        "explode(sequence(0, case when l_orderkey % 50 = 0 then 1 else 0 end)) as copy_no",
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "p_name",
    ).select(
        "invoice_no", "stock_code", "description", "quantity", "invoice_ts",
        "unit_price", "customer_id", "country", "p_name",
        F.struct(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "copy_no"
        ).alias("src_pos"),
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return once(spark, sf_dir, "lines", lambda: stage(build_lines(spark, sf_dir), "lines"))


def raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line items as a text feed under its source column names, junk included."""
    return _joined(spark, sf_dir).selectExpr(
        """concat(case when l_returnflag = 'R' then 'c' else '' end,
                  cast(l_orderkey as string)) as InvoiceNo""",
        """case when l_partkey % 61 = 0 then 'NA'
                else concat(' p', cast(l_partkey as string), ' ') end as StockCode""",
        """case when l_partkey % 53 = 0 then 'n/a' when l_partkey % 59 = 0 then '   '
                else concat('  ', p_name) end as Description""",
        """case when l_linenumber = 7 then 'many'
                else cast(cast(l_quantity as int) as string) end as Quantity""",
        """case when l_orderkey % 101 = 0 then '13/45/2011 99:99'
                else concat(month(o_orderdate), '/', day(o_orderdate), '/', year(o_orderdate), ' ',
                    hour(o_orderdate), ':', lpad(minute(o_orderdate), 2, '0')) end as InvoiceDate""",
        """case when l_partkey % 71 = 0 then 'free'
                else concat(cast(l_partkey % 40 as string), '.25') end as UnitPrice""",
        """case when o_custkey % 4 = 0 then '' when o_custkey % 4 = 1 then concat(
                cast(o_custkey as string), '.0') when o_custkey % 97 = 0 then '1.7'
                else cast(o_custkey as string) end as CustomerID""",
        "n_name as Country",
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
    )


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as usage: every third user's activity lies ten weeks back."""
    return dealt(spark, sf_dir, "events", "event_id").selectExpr(
        "case when user_id % 3 = 0 then ts - interval 70 days else ts end as event_ts",
        "user_id",
        "concat('T', cast(user_id % 5 as string)) as team",
        """case event_type when 'purchase' then 'apply' when 'signup' then 'feedback'
                else event_type end as event_type""",
        """case when event_type = 'signup'
                then cast(1 + cast(floor(value) as bigint) % 5 as int) end as feedback_score""",
    )


def faulty_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events with scores off the scale and teams left blank."""
    return (
        usage(spark, sf_dir)
        .withColumn("feedback_score", F.expr("feedback_score * 2 - 3"))
        .withColumn(
            "team", F.expr("case when user_id % 7 = 0 then '  ' when user_id % 11 = 0 then null else team end")
        )
    )


def entitlements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user for every nation and region, one who sees all and one for a country that is none."""
    nation = table(spark, sf_dir, "nation")
    named = nation.join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    first = nation.where("n_nationkey = 0")
    mail = lambda name: f"concat(lower(replace({name}, ' ', '.')), '@example.com')"
    grants = [
        (named, mail("n_name"), "n_name"), (named, mail("r_name"), "n_name"),
        (first, "'board@example.com'", "'*'"), (first, "'board@example.com'", "n_name"),
        (first, "'nowhere@example.com'", "'Atlantis'"),
    ]
    parts = [df.selectExpr(f"{user} as UserEmail", f"{country} as Country") for df, user, country in grants]
    return reduce(DataFrame.unionByName, parts)
