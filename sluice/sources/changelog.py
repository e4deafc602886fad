"""Change logs: shaping an ordered log of actions into a per-consume feed.

A warehouse change stream is already net per offset interval: per row at most
one DELETE (old values) and one INSERT (new values). An application log may
hold several actions of one key inside one consume; ``feed_per_consume``
reduces it to that shape (last DELETE and last INSERT by sequence), marking
``is_update`` where both halves exist. One aggregation keyed by
(keys, consume) with partial aggregation, so a hot key is reduced map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.netchange import ACTION, CONSUME, IS_UPDATE


def feed_per_consume(log: DataFrame, keys: Sequence[str], seq_col: str,
                     action_col: str = ACTION, consume_col: str = CONSUME) -> DataFrame:
    keys = list(keys)
    rest = [c for c in log.columns if c not in keys and c not in (action_col, consume_col)]
    row = F.struct(*rest)
    seq = F.col(seq_col)
    g = (log.groupBy(*keys, consume_col)
         .agg(F.max_by(row, F.when(F.col(action_col) == "DELETE", seq)).alias("_d"),
              F.max_by(row, F.when(F.col(action_col) == "INSERT", seq)).alias("_i")))
    both = F.col("_d").isNotNull() & F.col("_i").isNotNull()

    def half(side: str, action: str):
        return F.when(F.col(side).isNotNull(),
                      F.struct(*[F.col(f"{side}.{c}").alias(c) for c in rest],
                               F.lit(action).alias(action_col), both.alias(IS_UPDATE)))

    out = g.select(*keys, consume_col,
                   F.inline(F.filter(F.array(half("_d", "DELETE"), half("_i", "INSERT")),
                                     lambda x: x.isNotNull())))
    return out.select(*log.columns, IS_UPDATE)
