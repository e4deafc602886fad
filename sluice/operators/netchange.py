"""Net change per key (E1) and the split into upserts and deletes.

A change feed holds, per consume, at most one DELETE (old values) and one
INSERT (new values) per row; an UPDATE is such a pair flagged ``is_update``.
Per key we keep one row: the latest consume first, and within a consume an
INSERT beats a DELETE. ``is_update`` is ignored on purpose: an update that
changed a key column leaves its DELETE half as the only row of the old key,
so the old key is deleted.

Two physical forms give the same result:

* ``max_by`` (default) — ``groupBy(keys).agg(max_by(row, rank))``. Partial
  aggregation runs before the shuffle, so a key holding a third of all feed
  rows is reduced map-side and never lands whole in one task.
* ``window`` — ``row_number() = 1`` over ``partitionBy(keys)``; Catalyst adds a
  ``WindowGroupLimit`` before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACTION = "_cdc_action"
IS_UPDATE = "_cdc_is_update"
CONSUME = "consume_id"
LOADED_AT = "_cdc_loaded_at"
CDC_COLUMNS = (ACTION, IS_UPDATE, LOADED_AT, CONSUME)


def _rank(consume_col: str, action_col: str, order_cols: Sequence[str]) -> Column:
    insert_first = F.when(F.col(action_col) == "INSERT", 1).otherwise(0)
    return F.struct(F.col(consume_col).alias("c"),
                    *[F.col(c).alias(f"o{i}") for i, c in enumerate(order_cols)],
                    insert_first.alias("i"))


def net_change(feed: DataFrame, keys: Sequence[str], consume_col: str = CONSUME,
               action_col: str = ACTION, order_cols: Sequence[str] = (),
               method: str = "max_by") -> DataFrame:
    """One row per key: the last change by (consume, *order_cols, INSERT first).

    ``order_cols`` is the sequence of a raw ordered log (several changes of a
    key within one consume): the last change by sequence wins before the
    INSERT-over-DELETE rule applies.
    """
    keys = list(keys)
    cols = feed.columns
    if method == "window":
        order = [F.col(consume_col).desc(), *[F.col(c).desc() for c in order_cols],
                 F.when(F.col(action_col) == "INSERT", 0).otherwise(1)]
        w = Window.partitionBy(*keys).orderBy(*order)
        return (feed.withColumn("_rn", F.row_number().over(w))
                .where(F.col("_rn") == 1).drop("_rn"))
    if method != "max_by":
        raise ValueError(f"unknown net change method {method!r}")
    rest = [c for c in cols if c not in keys]
    picked = (feed.groupBy(*keys)
              .agg(F.max_by(F.struct(*rest), _rank(consume_col, action_col, order_cols))
                   .alias("_r")))
    return picked.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*cols)


def split_actions(net: DataFrame, keys: Sequence[str],
                  action_col: str = ACTION) -> tuple[DataFrame, DataFrame]:
    """Upserts (full rows without CDC columns) and deletes (key columns only)."""
    cdc = [c for c in net.columns if c.startswith("_cdc_") or c in CDC_COLUMNS or c == action_col]
    upserts = net.where(F.col(action_col) == "INSERT").drop(*cdc)
    deletes = net.where(F.col(action_col) == "DELETE").select(*keys)
    return upserts, deletes


def check_ties(feed: DataFrame, keys: Sequence[str], consume_col: str = CONSUME,
               action_col: str = ACTION, order_cols: Sequence[str] = (), commit_col: str | None = None) -> None:
    """Raise when two changes of a key share consume, order and action: the
    net change would then pick one arbitrarily. With ``commit_col`` also when
    two commits changed a key at the same place in the order, whatever they did
    to it: an INSERT and a DELETE are halves of an update only within a commit.
    One partial aggregation each."""
    grp = [*keys, consume_col, *order_cols, action_col]
    if commit_col:
        at = [*keys, consume_col, *order_cols]
        two = (feed.select(*at, commit_col).groupBy(*at).agg(F.min(commit_col).alias("a"), F.max(commit_col).alias("b"))
               .where("a <> b").first())
        if two is not None:
            raise ValueError(f"ambiguous change order for key {[two[k] for k in keys]}: commits {two['a']} and "
                             f"{two['b']} share their time; number the commits or add an order column")
    tie = (feed.select(*grp).groupBy(*grp).agg(F.count(F.lit(1)).alias("n"))
           .where(F.col("n") > 1).first())
    if tie is not None:
        raise ValueError(f"ambiguous change order for key {[tie[k] for k in keys]}: "
                         f"{tie['n']} changes share consume/order/action; add an order column")


def net_delete_keys(feed: DataFrame, keys: Sequence[str], consume_col: str = CONSUME,
                    action_col: str = ACTION, order_cols: Sequence[str] = ()) -> DataFrame:
    """Keys whose net change is a DELETE, reduced over only the key, consume,
    order and action columns (the scan reads nothing else)."""
    keys = list(keys)
    narrow = feed.select(*keys, consume_col, *order_cols, action_col)
    net = net_change(narrow, keys, consume_col, action_col, order_cols)
    return net.where(F.col(action_col) == "DELETE").select(*keys)


def replay(feed: DataFrame, keys: Sequence[str], consume_col: str = CONSUME,
           action_col: str = ACTION, order_cols: Sequence[str] = ()) -> DataFrame:
    """Final state of the keys a feed touches: the last change per key, dropping
    deleted keys. Used by tests as the property apply(net) == replay(feed)."""
    net = net_change(feed, keys, consume_col, action_col, order_cols)
    return net.where(F.col(action_col) == "INSERT")
