"""Rating tables derived from the order tables: customers rate the parts they ordered.

Every rating falls into exactly one of train and test. The split holds out whole users (cold users),
whole items (cold items) and a fifth of the remaining ratings. Customers on one residue rate every part
the same, so that vectors of length zero occur.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.operators.normalize import unique_ratings
from kindred.session import scratch_path, staged

# They define the test tables.
PERSONAL_ID = 1_000_000
TEST_BASELINE = 1.35
FLAT_RATING = 3.0


class TestTables:
    """The test tables of one scale factor. The ratings are ingested into a columnar table once."""

    __test__ = False

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")

    def derive_ratings(self) -> DataFrame:
        lines = self.read("lineitem").select("l_orderkey", "l_partkey", "l_quantity")
        orders = self.read("orders").select("o_orderkey", "o_custkey")
        rated = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
            F.col("o_custkey").cast("int").alias("user_id"),
            F.col("l_partkey").cast("int").alias("item_id"),
            (F.floor((F.col("l_quantity") - 1) / 10) + 1).cast("double").alias("rating"),
        )
        flat = F.col("user_id") % 101 == 50
        return unique_ratings(rated).withColumn("rating", F.when(flat, FLAT_RATING).otherwise(F.col("rating")))

    @cached_property
    def split_ratings(self) -> DataFrame:
        held = (
            (F.col("user_id") % 97 == 0)
            | (F.col("item_id") % 89 == 0)
            | ((F.col("user_id") * 31 + F.col("item_id") * 17) % 5 == 0)
        )
        split = F.when(held, "test").otherwise("train")
        rows = self.derive_ratings().withColumn("split", split)
        return staged(rows.sortWithinPartitions("split", "user_id"), "ratings", partition_by=("split",))

    @property
    def ratings(self) -> DataFrame:
        return self.split_ratings.drop("split")

    @property
    def train(self) -> DataFrame:
        return self.split_ratings.where(F.col("split") == "train").drop("split")

    @property
    def test(self) -> DataFrame:
        return self.split_ratings.where(F.col("split") == "test").drop("split")

    @property
    def personal(self) -> DataFrame:
        """Ratings of the personal user, for one part in 37."""
        return self.read("part").where(F.col("p_partkey") % 37 == 5).select(
            F.lit(PERSONAL_ID).alias("user_id"),
            F.col("p_partkey").cast("int").alias("item_id"),
            (F.col("p_size") % 5 + 1).cast("double").alias("rating"),
        )

    @cached_property
    def brand_ratings(self) -> DataFrame:
        """Customers rate the brands of the parts they ordered: few items, and most users rate each of them."""
        lines = self.read("lineitem").select("l_orderkey", "l_partkey", "l_quantity")
        orders = self.read("orders").select("o_orderkey", "o_custkey")
        parts = self.read("part").select("p_partkey", F.regexp_extract("p_brand", r"(\d+)", 1).cast("int").alias("item_id"))
        rated = lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(parts, F.col("l_partkey") == F.col("p_partkey"))
        rating = (F.floor((F.col("l_quantity") - 1) / 10) + 1).cast("double")
        return staged(unique_ratings(rated.select(F.col("o_custkey").cast("int").alias("user_id"), "item_id", rating.alias("rating"))), "brand-ratings")

    @property
    def damaged_lines(self) -> DataFrame:
        """The ratings as lines of text, some of them damaged in one way or another."""
        rating = F.col("rating").cast("int").cast("string")
        kind = F.pmod(F.col("user_id") * 7 + F.col("item_id"), F.lit(50))
        field = F.when(kind == 1, "NaN").when(kind == 2, "99").when(kind == 3, "-3").when(kind == 4, "four").otherwise(rating)
        user = F.when(kind == 5, F.concat(F.col("user_id").cast("string"), F.lit(".5"))).otherwise(F.col("user_id").cast("string"))
        item = F.when(kind == 6, "").otherwise(F.col("item_id").cast("string"))
        whole = F.concat_ws("\t", user, item, field)
        return self.ratings.select(F.when(kind == 7, F.concat_ws("\t", user, item)).otherwise(whole).alias("value"))

    @property
    def catalog(self) -> DataFrame:
        """All parts. Every seventh title gets a comma, so that scans have to cope with it."""
        title = F.when(F.col("p_partkey") % 7 == 0, F.concat("p_name", F.lit(", The"))).otherwise(F.col("p_name"))
        return self.read("part").select(F.col("p_partkey").cast("int").alias("item_id"), title.alias("title"))

    @property
    def runs(self) -> DataFrame:
        """All event values as timed runs: clicks and views stand for similarity runs, the rest for predictions."""
        stage = F.when(F.col("event_type").isin("click", "view"), "similarity").otherwise("prediction")
        return self.read("events").select(
            stage.alias("stage"), F.col("event_id").alias("run"), F.col("value").alias("micros")
        )

    def path(self, name: str) -> str:
        return scratch_path(self.spark, name)


_tables: dict[tuple[str, str], TestTables] = {}


def load(spark: SparkSession, sf_dir: str) -> TestTables:
    """The tables of ``sf_dir``, ingested once per application."""
    return _tables.setdefault((spark.sparkContext.applicationId, sf_dir), TestTables(spark, sf_dir))
