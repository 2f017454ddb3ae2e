"""The fourteen input tables and the evidence-record views over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
# fixed values of the test binding
NAME_SPACE = 211  # invented person names repeat after this many keys, so duplicates exist
RECORD_HOST = "https://records.example.org"


TEXT = ("documents", "pages", "conversations")


def spread(df: DataFrame) -> DataFrame:
    """Deal the one split of a small test file over the cores; only a local session asks for it, a cluster never does."""
    spark = df.sparkSession
    if spark.conf.get("attesta.spread.single.files", "false") != "true":
        return df
    return df.repartition(spark.sparkContext.defaultParallelism)


class Tables:
    """``t.orders`` reads one parquet table; derived views are methods."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._read = spark, sf_dir.rstrip("/"), {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in NAMES:
            raise AttributeError(name)
        if name not in self._read:
            df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            self._read[name] = spread(df) if name in TEXT else df
        return self._read[name]

    def facts(self) -> DataFrame:
        e = self.events
        return e.select(
            F.concat(F.lit("event:"), "event_id", F.lit(":p"), "user_id").alias("fact_key"),
            F.concat(F.lit("p"), "user_id").alias("person_id"),
            F.col("event_type").alias("kind"),
            F.to_date("ts").alias("date"),
            F.col("props").alias("data"),
            F.concat(F.lit(f"{RECORD_HOST}/e/"), "event_id").alias("source_url"),
            F.col("ts").alias("fetched_at"),
        )

    def persons(self) -> DataFrame:
        """Candidate list: an invented name (digits plus optional Latin words) and a district in an area."""
        digits = (F.col("c_custkey") % NAME_SPACE).cast("string")
        latin = F.when(F.col("c_custkey") % 3 == 0, F.lit("")).otherwise(F.lit(" Ana Lor"))
        district = F.concat(
            F.lit("n"), "c_nationkey",
            F.when(F.col("c_custkey") % 10 == 9, F.lit("-mayor")).otherwise(
                F.concat(F.lit("-council-"), (F.col("c_custkey") % 3 + 1).cast("string"))
            ),
        )
        return self.customer.select(
            F.concat(F.lit("c"), "c_custkey").alias("person_id"),
            F.concat(digits, latin).alias("name"),
            F.concat(F.lit("n"), "c_nationkey").alias("area"),
            district.alias("district_id"),
            "c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal",
        )

    def roster(self) -> DataFrame:
        """Official roster: same name space, other spellings, an office and an old district number."""
        k = F.col("s_suppkey")
        digits = (k % NAME_SPACE).cast("string")
        digits = F.when(k % 7 == 3, F.translate(digits, "0", "ø")).otherwise(digits)
        latin = F.when(k % 4 == 0, F.lit("")).when(k % 4 == 1, F.lit("・Lor Ana")).otherwise(F.lit(" Ana  Lor"))
        return self.supplier.select(
            F.concat(F.lit("s"), k).alias("record_id"),
            F.concat(digits, latin).alias("name"),
            F.concat(F.lit("n"), "s_nationkey").alias("area"),
            F.when(k % 5 == 0, F.lit("mayor")).otherwise(F.lit("councilor")).alias("office"),
            (k % 3 + 1).alias("district_n"),
            "s_suppkey", "s_nationkey", "s_acctbal",
        )


# The same views for the comparison SQL.
FACT = """fact AS (SELECT 'event:' || event_id || ':p' || user_id AS fact_key, 'p' || user_id AS person_id,
  event_type AS kind, CAST(ts AS DATE) AS date, props AS data,
  'https://records.example.org/e/' || event_id AS source_url, ts AS fetched_at FROM events)"""
PERSON = """person AS (SELECT 'c' || c_custkey AS person_id,
  (c_custkey % 211) || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE ' Ana Lor' END AS name, 'n' || c_nationkey AS area,
  'n' || c_nationkey || CASE WHEN c_custkey % 10 = 9 THEN '-mayor' ELSE '-council-' || (c_custkey % 3 + 1) END
    AS district_id, c_custkey, c_nationkey, c_mktsegment, c_acctbal,
  CAST(c_custkey % 211 AS VARCHAR) AS weak, CAST(c_custkey % 211 AS VARCHAR) AS folded,
  CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'ana lor' END AS words FROM customer)"""
ROSTER = """roster AS (SELECT 's' || s_suppkey AS record_id,
  CASE WHEN s_suppkey % 7 = 3 THEN replace(CAST(s_suppkey % 211 AS VARCHAR), '0', 'ø')
    ELSE CAST(s_suppkey % 211 AS VARCHAR) END AS weak, CAST(s_suppkey % 211 AS VARCHAR) AS folded,
  CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE 'ana lor' END AS words, 'n' || s_nationkey AS area,
  CASE WHEN s_suppkey % 5 = 0 THEN 'mayor' ELSE 'councilor' END AS office, s_suppkey % 3 + 1 AS district_n,
  s_suppkey, s_nationkey, s_acctbal FROM supplier)"""
