"""Price feeds derived from the order and event tables, used by the query catalogue.

Both are whole-table feeds. The first is deliberately dirty: copies, padded text,
unparsable and swapped prices, bad and multi-valued dates, missing merchants.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import RAW_COLUMNS


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def order_feed(spark: SparkSession, folder: str, batch: bool = False) -> DataFrame:
    """Raw feed rows from order lines; ``batch`` adds the ship day as ``_batch_id``."""
    lines = _table(spark, folder, "lineitem")
    parts = _table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    sellers = _table(spark, folder, "supplier").select("s_suppkey", "s_name")
    rows = lines.join(parts, F.expr("l_partkey = p_partkey")).join(
        sellers, F.expr("l_suppkey = s_suppkey")
    )
    cents = rows.selectExpr(
        "*",
        "cast(floor(l_extendedprice * 100 / l_quantity) as bigint) AS hi",
        "cast(floor(l_extendedprice * 100 * (1 - l_discount) / l_quantity) as bigint) AS lo",
        # Every 97th order is delivered twice.
        "explode(if(l_orderkey % 97 = 0, array(0, 1), array(0))) AS copy",
    )

    def text(name: str) -> str:
        return f"cast(cast(cast({name} as decimal(18,2)) * 0.01 as decimal(12,2)) as string)"

    def day(extra: int) -> str:
        shifted = f"date_add(cast(l_shipdate as date), {extra})"
        return f"concat(cast({shifted} as string), 'T00:00:00Z')"

    swapped = "l_orderkey % 107 = 0"
    return cents.selectExpr(
        "concat('P', cast(l_partkey as string)) AS id",
        "if(l_orderkey % 7 = 0, concat('  ', p_name, ' '), p_name) AS name",
        "if(l_partkey % 50 = 0, null, p_brand) AS brand",
        "p_type AS categories",
        f"""case when l_orderkey % 101 = 0 then 'n/a' when l_orderkey % 103 = 0 then '-1.00'
            when {swapped} then {text('hi')} else {text('lo')} end AS `prices.amountMin`""",
        f"if({swapped}, {text('lo')}, {text('hi')}) AS `prices.amountMax`",
        "if(l_linenumber % 2 = 0, ' usd', 'USD') AS `prices.currency`",
        f"""case when l_orderkey % 109 = 0 then 'bad-date' when l_orderkey % 113 = 0 then null
            when l_linenumber % 3 = 0 then concat({day(0)}, ', ', {day(30)})
            else {day(0)} end AS `prices.dateSeen`""",
        """case when l_suppkey % 40 = 0 then null when l_orderkey % 2 = 0 then upper(s_name)
            else concat(s_name, ' ') end AS `prices.merchant`""",
        """case l_returnflag when 'A' then 'New' when 'N' then 'Used ' end
            AS `prices.condition`""",
        *(["cast(cast(l_shipdate as date) as string) AS _batch_id"] if batch else []),
    )


def event_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Raw feed rows from the event stream: long series per product and merchant."""
    price = """cast(cast(cast(floor(value / 10) as bigint) * 10 + 1 as decimal(12,2))
               as string)"""
    return _table(spark, folder, "events").selectExpr(
        "concat('U', cast(user_id as string)) AS id",
        "concat('user ', cast(user_id as string)) AS name",
        "cast(null as string) AS brand",
        "'events' AS categories",
        f"{price} AS `prices.amountMin`",
        f"{price} AS `prices.amountMax`",
        "'USD' AS `prices.currency`",
        """date_format(cast(ts as timestamp), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
           AS `prices.dateSeen`""",
        "event_type AS `prices.merchant`",
        "'new' AS `prices.condition`",
    )


def as_file_feed(raw: DataFrame) -> DataFrame:
    """Feed columns only, in file order."""
    return raw.select(*[F.col(f"`{c}`") for c in RAW_COLUMNS])
