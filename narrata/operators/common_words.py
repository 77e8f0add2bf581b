"""Words of written rows met with a table of words: frequent words by broadcast, all others by an exchange.

A few words make up most of every text. Those with one part in
``COMMON_PARTS`` of all occurrences (so there can be no more than that many)
go to every task, and meet the rows where these lie. Only the rest is
exchanged, by (token, salt), together with the number of its row, and none of
these words is frequent enough to fill a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from narrata.functions import text as T
from narrata.operators import word_bayes as WB
from narrata.sources import io as IO

#: A word with one part in so many of all occurrences is common.
COMMON_PARTS = 1 << 20


def common(counts: DataFrame, name: str, n: str = "n") -> DataFrame:
    """The common words of a word table with their counts ``n``, written with all of its columns."""
    total = counts.agg(F.sum(n)).first()[0] or 0
    return IO.materialize(counts.filter(F.col(n) * F.lit(COMMON_PARTS) >= F.lit(total)), counts.sparkSession, name)


def rare(tokens: DataFrame, often: DataFrame, table: DataFrame, hot: list[str], on=("token",)) -> DataFrame:
    """Rows of ``tokens`` (token, row, ...) whose word isn't in ``often``, with the columns of ``table``; others are left out."""
    left = tokens.join(F.broadcast(often.select("token")), "token", "left_anti")
    return WB.with_salt(left, hot, "row").join(WB.salted(table, hot), [*on, "salt"]).drop("salt")


def all_met(tokens: DataFrame, often: DataFrame, table: DataFrame, hot: list[str]) -> DataFrame:
    """Rows of ``tokens`` with the columns of ``table``, which ``often`` has too."""
    near = tokens.join(F.broadcast(often), "token")
    return near.unionByName(rare(tokens, often, table, hot).select(near.columns))


def with_rare(rows: DataFrame, words: Column, often: DataFrame, table: DataFrame, hot: list[str], name: str = "rare") -> DataFrame:
    """``rows`` (with their number ``row``) and, as a list of structs, what ``table`` has of their rare words.

    A row's list is no longer than its distinct words.
    """
    tokens = T.exploded(rows, F.array_distinct(words), "row")
    kind = ", ".join(f"{c}: {t}" for c, t in table.dtypes)
    found = rare(tokens, often, table, hot).groupBy("row").agg(F.collect_list(F.struct(*table.columns)).alias(name))
    return rows.join(found, "row", "left").withColumn(name, F.coalesce(name, F.array().cast(f"array<struct<{kind}>>")))
