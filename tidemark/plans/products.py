"""Product analytics over cleaned reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.sentiment import ENGLISH, NEGATIVE, POSITIVE, Lexicon, with_sentiment
from tidemark.operators.ranks import with_rank
from tidemark.session import stored


def product_ratings(reviews: DataFrame) -> DataFrame:
    """Per product: number of reviews, rating sum, number of verified ones. Combined on the map side."""
    return reviews.groupBy("product_category", "product_id").agg(
        F.count("star_rating").alias("n_reviews"),
        F.sum("star_rating").alias("rating_sum"),
        F.count_if(F.col("verified_purchase")).alias("n_verified"),
    )


def rating_vs_popularity(reviews: DataFrame) -> DataFrame:
    """Average rating beside review count, per product."""
    return product_ratings(reviews).select(
        "product_category",
        "product_id",
        "n_reviews",
        "n_verified",
        F.round(F.col("rating_sum") / F.col("n_reviews"), 6).alias("avg_rating"),
    )


def rating_popularity_correlation(reviews: DataFrame) -> DataFrame:
    """Per category: correlation of average rating and review count over its products."""
    ratings = product_ratings(reviews).withColumn("avg_rating", F.col("rating_sum") / F.col("n_reviews"))
    n = F.col("n_reviews").cast("double")
    return ratings.groupBy("product_category").agg(
        F.count("*").alias("n_products"), F.round(F.corr("avg_rating", n), 6).alias("correlation")
    )


def damped(ratings: DataFrame, weight: float = 5.0) -> DataFrame:
    """Average rating pulled towards that of the category by ``weight`` reviews; not rounded, so that ranks are exact."""
    categories = ratings.groupBy("product_category").agg(
        (F.sum("rating_sum") / F.sum("n_reviews")).alias("category_rating")
    )
    mean = (F.lit(weight) * F.col("category_rating") + F.col("rating_sum")) / (F.lit(weight) + F.col("n_reviews"))
    return ratings.join(categories, "product_category").select(
        "product_category", "product_id", "n_reviews", mean.alias("damped_rating")
    )


def best_first() -> list[Column]:
    """Order of products: better rating, then more reviews, then the id."""
    return [F.desc("damped_rating"), F.desc("n_reviews"), F.asc("product_id")]


def best_products(reviews: DataFrame, k: int = 10, weight: float = 5.0) -> DataFrame:
    """The ``k`` best products of each category; each task sends at most ``k`` per category."""
    ranked = damped(product_ratings(reviews), weight).withColumn("rank", F.row_number().over(W.partitionBy("product_category").orderBy(*best_first())))
    return ranked.filter(F.col("rank") <= k).withColumn("damped_rating", F.round("damped_rating", 6))


def baskets(reviews: DataFrame) -> DataFrame:
    """Per customer and product: number of reviews and rating sum."""
    return reviews.groupBy("customer_id", "product_category", "product_id").agg(
        F.count("star_rating").alias("n_reviews"), F.sum("star_rating").alias("rating_sum")
    )


def favourite_category(bought: DataFrame) -> DataFrame:
    """Per customer, the category reviewed most; then the better rated one, then by name."""
    per_category = bought.groupBy("customer_id", "product_category").agg(
        F.sum("n_reviews").alias("n"), (F.sum("rating_sum") / F.sum("n_reviews")).alias("rating")
    )
    # Names sort upwards, so the smallest (-n, -rating, name) wins.
    best = F.min(F.struct(-F.col("n"), -F.col("rating"), F.col("product_category").alias("name")))
    return per_category.groupBy("customer_id").agg(best.getField("name").alias("product_category"))


def suggest_products(reviews: DataFrame, k: int = 5, weight: float = 5.0) -> DataFrame:
    """For each customer, the ``k`` best products of the favourite category not reviewed yet.

    A customer who has reviewed ``m`` products of the category needs no more than its first
    ``k + m`` ranks. The ranks a customer has used up are counted, and the free ones among the
    first ``k + m`` follow from them, so the work is linear in customers and reviews. The
    narrow baskets are stored, so the reviews themselves are read once.
    """
    bought = stored(baskets(reviews), "baskets")
    ratings = bought.groupBy("product_category", "product_id").agg(
        F.sum("n_reviews").alias("n_reviews"), F.sum("rating_sum").alias("rating_sum")
    )
    ranked = with_rank(damped(ratings, weight), "product_category", best_first())
    favourite = favourite_category(bought)
    used = (
        bought.select("customer_id", "product_category", "product_id")
        .join(favourite, ["customer_id", "product_category"], "left_semi")
        .join(ranked.select("product_category", "product_id", "rank"), ["product_category", "product_id"])
        .select("customer_id", "rank")
    )
    counted = used.groupBy("customer_id").agg(F.count("*").alias("m"))
    sizes = ranked.groupBy("product_category").agg(F.max("rank").alias("n_products"))
    reach = favourite.join(counted, "customer_id").join(sizes, "product_category")
    last = F.least(F.col("m") + k, F.col("n_products"))
    # Two steps keep each generated array short, however many products one customer has reviewed.
    block = 4096
    free = (
        reach.withColumn("last", last)
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("last") - 1) / block))))
        .withColumn(
            "rank",
            F.explode(F.sequence(F.col("block") * block + 1, F.least((F.col("block") + 1) * block, F.col("last")))),
        )
        .select("customer_id", "product_category", "rank")
        .join(used, ["customer_id", "rank"], "left_anti")
    )
    place = F.row_number().over(W.partitionBy("customer_id").orderBy("rank"))
    chosen = free.withColumn("place", place).filter(F.col("place") <= k)
    return chosen.join(ranked, ["product_category", "rank"]).select(
        "customer_id", "place", "product_category", "product_id", F.round("damped_rating", 6).alias("damped_rating")
    )


def product_sentiment(reviews: DataFrame, lexicon: Lexicon = ENGLISH) -> DataFrame:
    """Per product: average score and the number of positive and negative reviews."""
    scored = with_sentiment(reviews, "review_body", lexicon)
    return scored.groupBy("product_category", "product_id").agg(
        F.count("*").alias("n_reviews"),
        F.round(F.avg("score"), 6).alias("avg_score"),
        F.count_if(F.col("label") == POSITIVE).alias("n_positive"),
        F.count_if(F.col("label") == NEGATIVE).alias("n_negative"),
    )
