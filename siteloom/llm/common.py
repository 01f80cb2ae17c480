"""What several training-data operators share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words: space and tab to carriage return.
WORD_BREAK = r"[ \t-\r]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a data folder, wherever Spark can read it from."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words `[^\\x20\\x09-\\x0D]+` of a text in order; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), "")


def cut(df: DataFrame) -> DataFrame:
    """The same rows, read from files in the shared checkpoint folder.

    The folder is the session's spark.checkpoint.dir; one is made only where that is unset.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """The same rows, read from Parquet files in the shared checkpoint folder; smaller than what cut() writes."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_folder(spark))
    path = f"{sc.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir. Only a local session, which has no other hosts, may do without."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir isn't set; it names the folder that all hosts share")
    return folder or tempfile.mkdtemp(prefix="siteloom-")


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Hand texts to Python in batches of so many rows, as a few very long ones may stand together."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


#: Bits of the map by which rows are thinned out before a join.
MAP_BITS = 1 << 22


def maybe(rows: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column) -> DataFrame:
    """rows with `_maybe`: false only if no row of wanted has the key.

    A map of MAP_BITS bits over key hashes is broadcast, MAP_BITS / 64 rows at most whatever the input, so rows
    that a join doesn't need aren't shuffled for it.
    """
    spot = lambda c: F.pmod(F.xxhash64(c), F.lit(MAP_BITS))
    bits = wanted.select(spot(wanted_key).alias("spot")).select(F.expr("spot div 64").alias("_word"), F.expr("shiftleft(1L, cast(spot % 64 as int))").alias("bit"))
    bits = bits.groupBy("_word").agg(F.bit_or("bit").alias("_bits"))
    made = rows.withColumn("_spot", spot(key)).withColumn("_word", F.expr("_spot div 64")).join(F.broadcast(bits), "_word", "left")
    return made.withColumn("_maybe", F.expr("coalesce(shiftrightunsigned(_bits, cast(_spot % 64 as int)) & 1L, 0L) = 1")).drop("_word", "_spot", "_bits")


def thinned(rows: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column) -> DataFrame:
    """rows without most of those whose key no row of wanted has; the exact join is still to follow."""
    return maybe(rows, key, wanted, wanted_key).where("_maybe").drop("_maybe")


#: Edges of a graph that a task takes, at most.
IN_A_TASK = 100_000


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected edges: (id, component), component the smallest id reachable.

    Alternates large-star and small-star steps. Each step groups by a vertex with a partial minimum
    and joins that back, so a hub with many edges is a skewed join and never one group in memory.
    Vertices without an edge have no row; null ends and loops count as no edge.
    """
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    now = cut(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    # No more tasks than the edges need, as each step deals them out several times.
    parts = 1 + now.count() // IN_A_TASK
    few = lambda df: df.coalesce(parts)
    before = None
    while True:
        both = few(now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        least = few(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = few(few(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")).distinct())
        least = few(large.groupBy("u").agg(F.min("v").alias("m")))
        small = few(large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v"))
        now = cut(few(few(small.unionAll(least.select("u", F.col("m").alias("v")))).distinct()))
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == before:
            return now.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component")).unionByName(
                now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
            )
        before = seen
