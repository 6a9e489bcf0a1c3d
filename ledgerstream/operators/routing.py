"""Topic routing: which queues get a message."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import topic_regex_column

MOST_BINDINGS = 10_000


def _matches(keys: DataFrame, bindings: DataFrame) -> DataFrame:
    """Distinct keys beside the queues that get them. Keys are few (types and kinds), so patterns are tried once a key.

    Bindings are sent to the keys where they are few, else they stay where they are and Spark picks the side.
    """
    rules = bindings.select("queue", topic_regex_column().alias("_regex")).distinct()
    few = rules.limit(MOST_BINDINGS + 1).count() <= MOST_BINDINGS
    return keys.select("topic_key").distinct().join(F.broadcast(rules) if few else rules, F.expr("topic_key rlike _regex")).select("topic_key", "queue").distinct()


def route(messages: DataFrame, bindings: DataFrame) -> DataFrame:
    return messages.join(_matches(messages, bindings), "topic_key")


def unroutable(messages: DataFrame, bindings: DataFrame) -> DataFrame:
    return messages.join(_matches(messages, bindings), "topic_key", "left_anti")
