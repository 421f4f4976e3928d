"""Context of a chat turn: the recent turns before it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qaprep.operators.indexing import group_positions

HISTORY = 5
CHUNK = 4096


def chat_context(
    df: DataFrame, conversation: str = "conv_id", turn: str = "turn", text: str = "text", last: int = HISTORY,
    history: bool = True,
) -> DataFrame:
    """The last ``last`` user turns up to each turn, joined by blanks; without history the turn alone.

    Turns are numbered inside their conversation and cut into chunks; the few turns a chunk looks
    back to are copied into it. So a conversation of any length is spread over many tasks.
    """
    if not history:
        return df.select(conversation, turn, F.col(text).alias("context"))
    numbered = group_positions(df.select(conversation, turn, text), [conversation], [turn], "_no")
    own = numbered.withColumn("_chunk", F.floor(F.col("_no") / CHUNK))
    # a chunk looks back ``last - 1`` turns: every row goes to all later chunks that still reach it
    reached = F.floor((F.col("_no") + (last - 1)) / CHUNK)
    ahead = own.filter(reached > F.col("_chunk")).withColumn("_chunk", F.explode(F.sequence(F.col("_chunk") + 1, reached)))
    both = own.withColumn("_own", F.lit(True)).unionByName(ahead.withColumn("_own", F.lit(False)))
    recent = Window.partitionBy(conversation, "_chunk").orderBy("_no").rowsBetween(1 - last, 0)
    said = F.concat(F.lit("User: "), F.col(text))
    joined = both.withColumn("context", F.array_join(F.collect_list(said).over(recent), " "))
    return joined.filter("_own").select(conversation, turn, "context")
