"""The driver's tables seen as laboratory data.

Every expression is plain SQL that Spark and DuckDB read alike, so the Spark
queries and their oracles start from the same rows. The views are projections
of whole tables; nothing is sampled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from assaykit.sizing import partitions_for

RAW = {
    "uid": "concat('u', cast(l_orderkey as string))",
    "id": "cast(l_linenumber as string)",
    "hospid": "case when l_suppkey % 17 = 0 then ' ' else cast(l_suppkey as string) end",
    "hospname": "concat('医院', cast(l_suppkey % 100 as string))",
    "regdate": "case when l_orderkey % 23 = 0 then '' else cast(cast(l_shipdate as date) as string) end",
    "examage": "case when l_partkey % 19 = 0 then null else l_quantity + 20.0 end",
    "usex": "case l_returnflag when 'A' then '男' when 'N' then ' 女 ' else 'x' end",
    "deptid": "l_suppkey % 7",
    "dept": "concat('检验科', cast(l_suppkey % 7 as string))",
    "checkitemcode": "concat('check-', cast(l_linenumber as string))",
    "checkitemname": "concat('组合', cast(l_linenumber as string))",
    "itemcode": "concat('2.1.4.', cast(l_partkey % 40 as string))",
    "itemname": "concat('项目', cast(l_partkey % 40 as string))",
    "itemresult": (
        "case when l_orderkey % 97 = 0 then null when l_orderkey % 89 = 0 then '  ' "
        "when l_orderkey % 83 = 0 then '阳性' when l_orderkey % 79 = 0 then '1e400' "
        "when l_orderkey % 73 = 0 then ' 5. ' "
        "else cast(cast(l_quantity as int) as string) end"
    ),
    "normalhighvalue": (
        "case when l_suppkey % 13 = 0 then '无法判断' "
        "else cast(20 + 2 * cast(round(l_tax * 100) as int) as string) end"
    ),
    "normallowvalue": (
        "case when l_suppkey % 11 = 0 then null "
        "else cast(cast(round(l_discount * 100) as int) as string) end"
    ),
    "itemindexresultunit": "case when l_linestatus = 'O' then 'mmol/L' else null end",
    "rn": "cast(l_linenumber as bigint)",
}
NUMBERS = ("examage", "deptid", "rn")

# The same rows with results and bounds that can all become doubles.
CONVERTIBLE = {
    **RAW,
    "itemresult": (
        "case when l_orderkey % 73 = 0 then ' 5. ' "
        "else cast(cast(l_quantity as int) as string) end"
    ),
    "normalhighvalue": "cast(20 + 2 * cast(round(l_tax * 100) as int) as string)",
}

COHORT = {
    "uid": "concat('u', cast(o_orderkey as string))",
    "id": "cast(1 + o_custkey % 7 as string)",
}
COHORT_WHERE = "o_orderstatus = 'F'"

BASE = {
    **COHORT,
    "hospid": "o_custkey",
    "usex": "case when o_orderpriority < '3' then 'MAN' else 'WOMAN' end",
    "examage": "o_totalprice / 4096",
    "image_path_1": "concat('/u', cast(o_orderkey as string), '-1.jpg')",
    "image_path_2": "concat('/u', cast(o_orderkey as string), '-2.jpg')",
    "split": "case when o_orderkey % 10 = 0 then 'internal_validation' else 'train' end",
}

QUANTITY = {
    "itemresult": "min(l_quantity)",
    "normallowvalue": "min(case when l_suppkey % 11 = 0 then null else cast(10 as double) end)",
    "normalhighvalue": "cast(30 as double)",
}
DISCOUNT = {
    "itemresult": "max(round(l_discount * 100))",
    "normallowvalue": "cast(2 as double)",
    "normalhighvalue": "cast(8 as double)",
}
DISCOUNT_WHERE = "l_suppkey % 10 <> 0"

NON_FINITE = {
    "uid": RAW["uid"],
    "id": RAW["id"],
    "score": (
        "case when l_partkey % 5 = 0 then cast('NaN' as double) "
        "when l_partkey % 7 = 0 then cast('Infinity' as double) "
        "when l_partkey % 11 = 0 then cast('-Infinity' as double) else l_quantity end"
    ),
    "n": "l_linenumber",
}


def columns(view: dict[str, str]) -> list[str]:
    return [f"{expression} as {name}" for name, expression in view.items()]


def select(view: dict[str, str], table: str, where: str = "true") -> str:
    """The same view as SQL text."""
    return f"select {', '.join(columns(view))} from {table} where {where}"


def grouped(view: dict[str, str], where: str = "true") -> str:
    keys = f"{RAW['uid']} as uid, {RAW['id']} as id"
    return f"select {keys}, {', '.join(columns(view))} from lineitem where {where} group by 1, 2"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_lab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detail table, decoded."""
    return table(spark, sf_dir, "lineitem").selectExpr(*columns(RAW))


def convertible_lab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detail table before its conversion: every result and bound is a number."""
    return table(spark, sf_dir, "lineitem").selectExpr(*columns(CONVERTIBLE))


def raw_lab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detail table as stored: text as bytes."""
    text = [name for name in RAW if name not in NUMBERS]
    return text_lab(spark, sf_dir).withColumns({n: F.col(n).cast("binary") for n in text})


ITEMS_SQL = (
    "select n_nationkey + 2 as line, n_name as itemname, "
    "concat('2.1.4.', cast(n_nationkey as string)) as itemcode from nation union all "
    "select r_regionkey + 27, r_name, concat('2.4.4.', cast(r_regionkey as string)) from region"
)


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dictionary: 25 codes that occur and 5 that do not."""
    nation = table(spark, sf_dir, "nation").selectExpr(
        "cast(n_nationkey + 2 as bigint) as line",
        "n_name as itemname",
        "concat('2.1.4.', n_nationkey) as itemcode",
    )
    region = table(spark, sf_dir, "region").selectExpr(
        "cast(r_regionkey + 27 as bigint) as line",
        "r_name as itemname",
        "concat('2.4.4.', r_regionkey) as itemcode",
    )
    both = nation.unionAll(region)
    return both.withColumn("filename", F.expr("concat(itemname, '__', itemcode, '.parquet')"))


def cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where(COHORT_WHERE).selectExpr(*columns(COHORT))


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where(COHORT_WHERE).selectExpr(*columns(BASE))


def key_partitions(spark: SparkSession, sf_dir: str) -> int:
    """Partitions of detail rows dealt by key, so that no task groups all rows of a large split."""
    return partitions_for(spark, 0, table(spark, sf_dir, "lineitem").count())


def item_table(
    spark: SparkSession, sf_dir: str, view: dict[str, str], where: str = "true"
) -> DataFrame:
    """A typed item table with unique keys, grouped on the keys it is joined by."""
    keyed = table(spark, sf_dir, "lineitem").where(where).selectExpr(
        f"{RAW['uid']} as uid", f"{RAW['id']} as id", "*"
    )
    keyed = keyed.repartition(key_partitions(spark, sf_dir), "uid", "id")
    return keyed.groupBy("uid", "id").agg(
        *[F.expr(expression).alias(name) for name, expression in view.items()]
    )


# One detail row per key pair, from numbers alone so that the grouping stays cheap.
ONE_PER_KEY = (
    "select l_orderkey, l_linenumber, min(l_partkey) as l_partkey, min(l_suppkey) as l_suppkey, "
    "min(l_quantity) as l_quantity, min(l_discount) as l_discount, min(l_tax) as l_tax, "
    "chr(min(ascii(l_returnflag))) as l_returnflag, "
    "chr(min(ascii(l_linestatus))) as l_linestatus, min(l_shipdate) as l_shipdate "
    "from {0} group by l_orderkey, l_linenumber"
)


def text_item_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text item table with unique keys and convertible results."""
    lineitem = table(spark, sf_dir, "lineitem").repartition(
        key_partitions(spark, sf_dir), "l_orderkey", "l_linenumber"
    )
    one_per_key = spark.sql(ONE_PER_KEY.format("{lineitem}"), lineitem=lineitem)
    return one_per_key.selectExpr(*columns(CONVERTIBLE)).drop("rn")
