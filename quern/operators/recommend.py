"""Ratings: errors over common pairs, best rated items, matrix factorisation."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, functions as F, types as T

from quern.functions.maths import squared_error
from quern.functions.vectors import literal_vector, vec_dot
from quern.operators.aggregates import count_mean_by_key
from quern.operators.joins import lookup_join
from quern.operators.stats import dense_rows
from quern.session import stable


def rmse_join(predicted: DataFrame, actual: DataFrame) -> DataFrame:
    """RMSE over the (user, item) pairs both sides have; a pair occurs once per side."""
    p = predicted.select("user", "item", F.col(predicted.columns[-1]).alias("_p"))
    a = actual.select("user", "item", F.col(actual.columns[-1]).alias("_a"))
    return p.join(a, ["user", "item"]).agg(F.sqrt(F.avg(squared_error(F.col("_a"), F.col("_p")))).alias("rmse"))


def top_rated(ratings: DataFrame, items: DataFrame, min_ratings: int, k: int) -> DataFrame:
    """Best mean rating among items with more than ``min_ratings``: ``mean, title, n``.

    Ratings are reduced to one row per item before titles are joined. Ties in the mean, to
    three digits, go by title.
    """
    per_item = count_mean_by_key(ratings, "item", "rating").filter(F.col("n") > min_ratings)
    named = per_item.join(items, "item").select("mean", "title", "n")
    return sort_deterministic(named, "mean", "title", ascending=False).limit(k)


def sort_deterministic(df: DataFrame, number: str, name: str, ascending: bool = True) -> DataFrame:
    """Order by a number to three digits, then by name, both in the same direction."""
    direction = F.asc if ascending else F.desc
    return df.orderBy(direction(F.round(number, 3)), direction(name))


def als_fit(train: DataFrame, rank: int, iterations: int = 5, reg: float = 0.1, seed: int = 5) -> ALSModel:
    als = ALS(
        userCol="user", itemCol="item", ratingCol="rating",
        rank=rank, maxIter=iterations, regParam=reg, seed=seed, coldStartStrategy="drop",
    )
    return als.fit(train)


def als_fit_predict(train: DataFrame, pairs: DataFrame, rank: int, **settings) -> DataFrame:
    """Predicted rating of each pair whose user and item occur in training."""
    model = als_fit(train, rank, **settings)
    return model.transform(pairs.select("user", "item")).select("user", "item", "prediction")


def als_select_rank(
    train: DataFrame, validation: DataFrame, ranks: Sequence[int], **settings
) -> tuple[ALSModel, DataFrame]:
    """The model with the lowest validation RMSE, and a table ``rank, rmse``."""
    train = train.select("user", "item", "rating").cache()
    validation = validation.select("user", "item", "rating").cache()
    tried = []
    try:
        for rank in ranks:
            model = als_fit(train, rank, **settings)
            predicted = model.transform(validation).select("user", "item", "prediction")
            tried.append((rank, model, rmse_join(predicted, validation).first()["rmse"]))
    finally:
        train.unpersist()
        validation.unpersist()
    best = min(tried, key=lambda t: float("inf") if t[2] is None else t[2])  # None: no common pair
    table = train.sparkSession.createDataFrame([(r, e) for r, _, e in tried], "rank int, rmse double")
    return best[1], table


def predict_for_user(model: ALSModel, user: int) -> DataFrame:
    """Predicted rating of every item for one user: ``item, prediction``.

    The user's factors are ``rank`` numbers, so they go into the expression; joining
    pairs that all have the same user would give one key all rows. A user without
    ratings in training has no predictions.
    """
    known = model.userFactors.filter(F.col("id") == user).first()
    items = model.itemFactors.select(F.col("id").alias("item"), F.col("features").cast("array<double>").alias("_f"))
    if known is None:
        return items.limit(0).select("item", F.lit(0.0).alias("prediction"))
    return items.select("item", vec_dot(F.col("_f"), literal_vector(known["features"])).alias("prediction"))


def fold_in(item_factors: DataFrame, ratings: DataFrame, reg: float = 0.1) -> DataFrame:
    """Factors ``user, features`` of users whose ratings ``user, item, rating`` a fit has not seen.

    ``item_factors`` has ``item, features`` of a finished fit. A user's factors solve the
    normal equations that a half-step of alternating least squares solves, with ``reg`` times
    the number of ratings on the diagonal. Spark sums the products per user, so a user may
    have any number of ratings; what is solved is one matrix of the rank's size a user. Users
    none of whose items has factors are left out.
    """
    some = item_factors.select(F.size("features").alias("n")).first()
    schema = T.StructType([ratings.schema["user"], T.StructField("features", T.ArrayType(T.DoubleType()))])
    if some is None:
        return ratings.sparkSession.createDataFrame([], schema)
    rank = some.n
    rated = lookup_join(ratings.select("user", "item", "rating"), item_factors, "item")
    f = [F.col("features")[i].cast("double") for i in range(rank)]
    pairs = [(i, j) for i in range(rank) for j in range(i + 1)]
    products = F.array(*[F.sum(f[i] * f[j]) for i, j in pairs])
    sides = F.array(*[F.sum(x * F.col("rating")) for x in f])
    sums = rated.groupBy("user").agg(F.count("*").alias("n"), products.alias("p"), sides.alias("s"))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, onto = np.array(pairs).T
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix = np.zeros((batch.num_rows, rank, rank))
            matrix[:, at, onto] = matrix[:, onto, at] = dense_rows(batch.column(2))
            matrix += reg * batch.column(1).to_numpy()[:, None, None] * np.eye(rank)
            solved = np.linalg.solve(matrix, dense_rows(batch.column(3))[:, :, None])[:, :, 0]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(solved), pa.list_(pa.float64()))], ["user", "features"])

    return sums.mapInArrow(solve, schema)


def factors_of(model: ALSModel) -> DataFrame:
    """``item, features`` of a fit."""
    return model.itemFactors.select(F.col("id").alias("item"), F.col("features").cast("array<double>").alias("features"))


def predict_folded(item_factors: DataFrame, user_factors: DataFrame, pairs: DataFrame) -> DataFrame:
    """``user, item, prediction`` of pairs both of whose sides have factors."""
    users = user_factors.withColumnRenamed("features", "_u")
    met = lookup_join(lookup_join(pairs.select("user", "item"), stable(users), "user"), item_factors, "item")
    return met.select("user", "item", vec_dot(F.col("_u"), F.col("features")).alias("prediction"))


def recommend_unrated(
    ratings: DataFrame,
    items: DataFrame,
    user: int,
    k: int = 25,
    min_ratings: int = 75,
    model: ALSModel | None = None,
    rank: int = 12,
    own: DataFrame | None = None,
    reg: float = 0.1,
    **settings,
) -> DataFrame:
    """The ``k`` items with the best predicted rating that ``user`` has not rated.

    ``ratings`` includes the user's own. Only items with more than ``min_ratings`` ratings
    count. With ``own``, the ratings ``item, rating`` of a user whom the ``model`` has not
    seen, nothing is fitted again: the user is folded in.
    """
    model = model or als_fit(ratings, rank, reg=reg, **settings)
    if own is None:
        seen, scored = ratings.filter(F.col("user") == user).select("item").distinct(), predict_for_user(model, user)
    else:
        seen, factors = own.select("item").distinct(), factors_of(model)
        folded = fold_in(factors, own.select(F.lit(user).alias("user"), "item", "rating"), reg).first()
        if folded is None:
            scored = factors.limit(0).select("item", F.lit(0.0).alias("prediction"))
        else:
            scored = factors.select("item", vec_dot(F.col("features"), literal_vector(folded.features)).alias("prediction"))
    predicted = scored.join(seen, "item", "left_anti")
    counts = ratings.groupBy("item").agg(F.count("*").alias("n")).filter(F.col("n") > min_ratings)
    return (
        predicted.join(counts, "item")
        .join(items, "item")
        .select("prediction", "title", "n")
        .orderBy(F.desc("prediction"), "title")
        .limit(k)
    )
