"""The given tables seen as reviews, events, factors and model runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tasteloom.sources.scratch import scratch_dir

HOT_USER = 1_000_000_000  # no customer has this number
STAGES = ["None", "Staging", "Production", "Archived"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(Id, UserId, ProductId, Score, Time): each order line is a customer's review of a part."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("Id"),
        F.col("o_custkey").cast("string").alias("UserId"),
        F.col("l_partkey").cast("string").alias("ProductId"),
        F.ceil(F.col("l_quantity") / 10).cast("float").alias("Score"),
        F.unix_timestamp("o_orderdate").alias("Time"),
    )


def dirty_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews as text columns with missing users, missing times and scores that are no numbers."""
    def broken(every: int, column: str, instead=None):
        return F.when(F.col("Id") % every == 0, F.lit(instead)).otherwise(F.col(column).cast("string")).alias(column)

    return reviews(spark, sf_dir).select(
        "Id", broken(23, "UserId"), "ProductId", broken(17, "Score", "n/a"), broken(29, "Time")
    ).withColumn("Score", F.when(F.col("Id") % 19 == 0, F.lit("NaN")).otherwise(F.col("Score")))


def dirty_messages(spark: SparkSession, sf_dir: str, *more: Column) -> DataFrame:
    """(value, more..): one message per review, some of them malformed in one of seven ways."""
    good = F.to_json(F.struct("UserId", "ProductId", "Score", "Time"))
    kind = F.col("Id") % 50
    value = (
        F.when(kind == 0, F.lit("garbage"))
        .when(kind == 1, F.lit(""))
        .when(kind == 2, F.lit('[{"UserId":"e"}]'))
        .when(kind == 3, F.lit('{"UserId":null,"Score":1.0}'))
        .when(kind == 4, F.format_string('{"UserId":%d,"Score":"5.0"}', "Id"))
        .when(kind == 5, F.format_string('{"UserId":"b%d","Score":4,"Time":1.5}', "Id"))
        .when(kind == 6, F.format_string('{"UserId":"d%d","userid":"x","Extra":1}', "Id"))
        .otherwise(good)
    )
    return reviews(spark, sf_dir).select(*more, value.alias("value"))


def counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_type, instance, ts, total): at each event the count so far of its type and instance, from 0 again each day.

    Instances begin again at different hours. A day of one instance is the largest window.
    """
    instance, second = F.col("user_id") % 3, F.unix_timestamp("ts")
    events = table(spark, sf_dir, "events").select(
        "event_type", instance.alias("instance"), "ts", "event_id",
        F.floor((second + instance * 7200) / 86_400).alias("day"))
    along = Window.partitionBy("event_type", "instance", "day").orderBy("ts", "event_id")
    return events.select("event_type", "instance", "ts", F.row_number().over(along).alias("total"))


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as rating events of every fifth user number, so that some have no factor vector."""
    return table(spark, sf_dir, "events").select(
        (F.col("user_id") * 5).cast("string").alias("UserId"),
        F.col("event_type").alias("ProductId"),
        F.col("value").cast("float").alias("Score"),
        F.unix_timestamp("ts").alias("Time"),
    )


def factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, features) from the embeddings."""
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("features"))


def planted_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_index, item_index, Score): the pairs of the reviews, with scores that three factors explain.

    User and item take their factors from embeddings by number; a score is their inner product, scaled so
    that it varies by about one.
    """
    pairs = reviews(spark, sf_dir).select(
        F.col("UserId").cast("int").alias("user_index"), F.col("ProductId").cast("int").alias("item_index")
    ).distinct()
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.transform(F.slice("embedding", 1, 3), lambda x: x * 8).alias("v")
    )
    count = vectors.agg(F.max("vec_id") + 1).scalar()
    number = pairs.select("*", (F.col("user_index") % count).alias("u"), (F.col("item_index") % count).alias("i"))
    user = vectors.select(F.col("vec_id").alias("u"), F.col("v").alias("x"))
    item = vectors.select(F.col("vec_id").alias("i"), F.col("v").alias("y"))
    products = F.zip_with("x", "y", lambda a, b: (a * b).cast("double"))
    score = F.aggregate(products, F.lit(0.0), lambda total, p: total + p)
    return number.join(user, "u").join(item, "i").select("user_index", "item_index", score.cast("float").alias("Score"))


def vector_labels(spark: SparkSession, sf_dir: str, prefix: str) -> DataFrame:
    """(label, idx, n) naming each vector by its number."""
    number = F.col("vec_id")
    return table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit(prefix), number.cast("string")).alias("label"), number.cast("int").alias("idx"),
        F.lit(1).cast("long").alias("n"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model runs: each part is a version of the model named by its brand."""
    key = F.col("p_partkey")
    stages = F.array(*[F.lit(s) for s in STAGES])
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("name"),
        (key + 1).alias("version"),
        F.element_at(stages, F.col("p_size") % 4 + 1).alias("stage"),
        (10 * (1 + key % 2)).cast("int").alias("rank"),
        (F.lit(0.05) * (1 + key % 2)).alias("regParam"),
        (F.col("p_retailprice") / 1000).alias("rmse"),
        (F.col("p_size") / 50).alias("coverage"),
        F.col("p_type").alias("path"),
    )


def feed_folder(messages: DataFrame, purpose: str) -> str:
    """Write messages as files of one JSON text per line, as a feed would deliver them."""
    path = scratch_dir(messages.sparkSession, purpose)
    messages.select("value").write.text(path)
    return path


def flat(recs: DataFrame) -> DataFrame:
    """(UserId, pos, ProductId, score) from nested recommendations."""
    return recs.select("UserId", F.posexplode("recommendations").alias("pos", "r")).select(
        "UserId", "pos", F.col("r.ProductId").alias("ProductId"), F.round("r.score", 6).alias("score")
    )
