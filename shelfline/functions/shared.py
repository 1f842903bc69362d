"""One evaluation of a DataFrame that a query reads several times."""

from __future__ import annotations

from pyspark.sql import DataFrame


def over_shared(shared: DataFrame, query: str, **inputs) -> DataFrame:
    """The SQL ``query`` over ``shared`` (and other ``inputs``, written in braces), which runs once however often it is named.

    A common table expression that holds a non-deterministic column is never copied into its uses: Spark plans one exchange
    of its rows, with the columns that any use needs, and reuses it. Nothing runs before the result is used, and a lost
    executor costs that exchange only.
    """
    head = "WITH shared AS (SELECT *, monotonically_increasing_id() AS _shared_row FROM {shared}) "
    return shared.sparkSession.sql(head + query, shared=shared, **inputs)
