"""Pages and their answers, joined as both arrive.

Both sides have a watermark and an answer has to come within a bound of its page, so that state is let go: a page that no
answer came for by then goes out alone, once. An answer without a page goes nowhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def answered_pages(pages: DataFrame, answers: DataFrame, within: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """pages(page_id, page_ts, ...) with the columns of answers(page_id, answer_ts, ...), null where none came in time.

    A table or a stream on either side; two answers to a page are two rows.
    """
    left = pages.withWatermark("page_ts", delay) if pages.isStreaming else pages
    right = answers.withWatermark("answer_ts", delay) if answers.isStreaming else answers
    right = right.withColumnRenamed("page_id", "answer_page_id")
    near = (F.col("page_id") == F.col("answer_page_id")) & (F.col("answer_ts") >= F.col("page_ts")) & (F.col("answer_ts") <= F.col("page_ts") + F.expr(f"INTERVAL {within}"))
    return left.join(right, near, "left_outer").drop("answer_page_id")
