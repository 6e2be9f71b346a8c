"""Whole recommendation runs: train and test ratings in, scored test rows out."""

from __future__ import annotations

from pyspark.sql import DataFrame

from siftworks.functions.skew import HEAVY_ROWS
from siftworks.operators.evaluation import score
from siftworks.operators.neighbours import (
    item_neighbours,
    item_predict,
    user_neighbours,
    user_predict,
)
from siftworks.operators.ratings import known_rows, user_totals
from siftworks.operators.similarity import pair_similarity
from siftworks.sources.shared import materialize


def item_predictions(
    train: DataFrame,
    test: DataFrame,
    k: int = 10,
    min_sim: float = 0.01,
    min_nb: int = 1,
    order: str = "asc",
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """(user, item, prediction, user_mean) of the test rows of known users."""
    totals = user_totals(train)
    targets = known_rows(test, train, totals=totals)
    sim = pair_similarity(train, "item", 2, min_sim, targets, heavy_rows)
    chosen = item_neighbours(test, train, sim, max(k, min_nb), order, heavy_rows)
    return item_predict(test, totals, chosen, k, min_nb)


def item_cf(
    train: DataFrame,
    test: DataFrame,
    k: int = 10,
    min_sim: float = 0.01,
    min_nb: int = 1,
    order: str = "asc",
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Item-based neighbourhood prediction: (user, item, rating, prediction, abs_err).

    A known user always has a prediction, so only unknown users get the fallback.
    """
    return score(test, item_predictions(train, test, k, min_sim, min_nb, order, heavy_rows))


def _user_predictions(
    train: DataFrame,
    known: DataFrame,
    totals: DataFrame,
    k: int,
    min_sim: float,
    min_nb: int,
    order: str,
    heavy_rows: int,
) -> DataFrame:
    sim = pair_similarity(train, "user", 2, min_sim, known, heavy_rows)
    chosen = user_neighbours(known, train, sim, max(k, min_nb), order, heavy_rows)
    return user_predict(known, totals, chosen, k, min_nb)


def user_predictions(
    train: DataFrame,
    test: DataFrame,
    k: int = 10,
    min_sim: float = 0.3,
    min_nb: int = 5,
    order: str = "asc",
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """(user, item, prediction, user_mean) of the test rows whose user and item are known."""
    totals = user_totals(train)
    known = known_rows(test, train, True, totals)
    return _user_predictions(train, known, totals, k, min_sim, min_nb, order, heavy_rows)


def user_cf(
    train: DataFrame,
    test: DataFrame,
    k: int = 10,
    min_sim: float = 0.3,
    min_nb: int = 5,
    order: str = "asc",
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """User-based neighbourhood prediction: (user, item, rating, prediction, abs_err).

    The mean of a user stands in for a row with an unknown item only if some other
    test row of that user has a known one.
    """
    totals = user_totals(train)
    known = known_rows(test, train, True, totals)
    predicted = _user_predictions(train, known, totals, k, min_sim, min_nb, order, heavy_rows)
    means = totals.join(known.select("user").distinct(), "user", "left_semi").select("user", "mean")
    return score(test, predicted, materialize(means, "means"))
