"""The registered questions: each maps (spark, folder) to a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mercato.sources.shop import Shop, shop_at

Question = Callable[[SparkSession, str], DataFrame]


class Registry(dict[str, Question]):
    """Questions by name; the decorated function takes a Shop."""

    def question(self, function: Callable[[Shop], DataFrame]) -> Callable[[Shop], DataFrame]:
        self[function.__name__] = lambda spark, folder: function(shop_at(spark, folder))
        return function
