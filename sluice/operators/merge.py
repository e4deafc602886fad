"""Keyed writes as DataFrame compositions: upsert, delete, truncate, append.

Each function returns the *new contents* of the target as a lazy DataFrame;
publishing it (native manifest swap or JDBC transaction) is the sink's job.

Join shapes (all equi-joins on the key list):

* upsert / delete without target-only columns: ``target LEFT ANTI changes``
  plus ``UNION ALL`` of the upserts. The change side is the small one; AQE
  turns the anti join into a broadcast hash join when its measured size is
  under the broadcast threshold, otherwise a sort-merge join.
* upsert that keeps target-only columns (update in place): one full outer
  join, so matched rows keep their target-only values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .netchange import ACTION

_HIT = "_sluice_hit"
#: Key of a field's metadata under which its default stands, as a SQL expression.
DEFAULT = "sluice.default"


def absent(field: T.StructField) -> Column:
    """What a row gets in a column that it does not bring: the declared default, or NULL."""
    given = (field.metadata or {}).get(DEFAULT)
    return (F.expr(given) if given else F.lit(None)).cast(field.dataType).alias(field.name)


def with_defaults(schema: T.StructType, defaults: Mapping[str, str]) -> T.StructType:
    """``schema`` with declared defaults (SQL expressions) for some of its columns."""
    unknown = [c for c in defaults if c not in schema.names]
    if unknown:
        raise ValueError(f"defaults for unknown columns: {unknown}")
    return T.StructType([T.StructField(f.name, f.dataType, f.nullable, {**(f.metadata or {}), DEFAULT: defaults[f.name]})
                         if f.name in defaults else f for f in schema.fields])


def _check_columns(target: DataFrame, changes: DataFrame) -> list[str]:
    missing = [c for c in changes.columns if c not in target.columns]
    if missing:
        raise ValueError(f"columns missing in the target: {missing}")
    return [c for c in target.columns if c not in changes.columns]


def upsert(target: DataFrame, changes: DataFrame, keys: Sequence[str],
           on_match: str = "update") -> DataFrame:
    """Insert new keys, overwrite matched ones.

    ``on_match='update'`` keeps target-only columns (identity, defaults) of
    matched rows; ``'replace'`` deletes and re-inserts, so they return to their
    defaults (NULL where none is declared).
    When every column is a key there is nothing to update: matched rows stay.
    """
    return apply_changes(target, changes, None, keys, on_match)


def delete_by_key(target: DataFrame, deleted_keys: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``DELETE t FROM target t JOIN keys d ON …``; NULL keys never match."""
    keys = list(keys)
    return target.join(deleted_keys.select(*keys), keys, "left_anti")


def apply_changes(target: DataFrame, upserts: DataFrame | None, deletes: DataFrame | None,
                  keys: Sequence[str], on_match: str = "update", schema: T.StructType | None = None) -> DataFrame:
    """Upserts and deletes applied together (one publish). New and replaced rows
    get the defaults that ``schema`` declares for target-only columns."""
    keys, fields = list(keys), {f.name: f for f in (schema or target.schema).fields}
    extra = _check_columns(target, upserts) if upserts is not None else []
    touched = None
    if upserts is not None:
        touched = upserts.select(*keys)
    if deletes is not None:
        d = deletes.select(*keys)
        touched = d if touched is None else touched.unionByName(d)
    if touched is None:
        return target
    if upserts is None:
        return target.join(touched, keys, "left_anti")
    if not extra or on_match == "replace":
        kept = target.join(touched, keys, "left_anti")
        new_rows = upserts.select(*[F.col(c) if c in upserts.columns else absent(fields[c])
                                    for c in target.columns])
        return kept.unionByName(new_rows)
    # Update in place: one full outer join keeps target-only values on matches.
    t = target.withColumn(_HIT, F.lit(True))
    u = upserts.withColumn(_HIT, F.lit(True)).alias("u")
    if deletes is not None:
        t = t.join(deletes.select(*keys), keys, "left_anti")
    t = t.alias("t")
    j = t.join(u, keys, "full_outer")
    hit = F.col(f"u.{_HIT}").isNotNull()
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in extra:
            out.append(F.when(F.col(f"t.{_HIT}"), F.col(f"t.{c}")).otherwise(absent(fields[c])).alias(c))
        else:
            out.append(F.when(hit, F.col(f"u.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
    return j.select(*out)


def apply_in_place(layers: Sequence[DataFrame], upserts: DataFrame | None, deletes: DataFrame | None,
                   keys: Sequence[str], on_match: str, schema: T.StructType,
                   spelled: Sequence[str] = ()) -> list[DataFrame]:
    """``apply_changes`` over a table stored in ``layers`` that are bucketed by
    the keys, each key in one of them; the change is dealt by the keys already.
    Returns parts that add up to the new contents. An update in place leaves the
    columns ``spelled`` (how a case-insensitive key is written) as they are.

    Every join streams a layer past the hashed keys of the change, so stored
    rows are neither exchanged nor sorted. Only new keys of an update in place
    are found the other way round, against the key columns alone.
    """
    keys, cols = list(keys), schema.names
    extra = [] if upserts is None else [c for c in cols if c not in upserts.columns or c in spelled]
    hashed = lambda d: d.hint("shuffle_hash")
    in_place = bool(extra) and on_match != "replace"
    gone = [d.select(*keys) for d in ([deletes] if in_place else [deletes, upserts]) if d is not None]
    kept = list(layers)
    for d in gone:
        kept = [layer.join(hashed(d), keys, "left_anti") for layer in kept]
    if upserts is None:
        return kept
    if not in_place:
        return [*kept, truncate_load_as(schema, upserts)]
    vals = [c for c in upserts.columns if c not in keys and c not in spelled]
    change = upserts.select(*keys, *[F.col(c).alias(f"_u_{c}") for c in vals], F.lit(True).alias(_HIT))
    updated = [layer.join(hashed(change), keys, "left").select(*[
        F.when(F.col(_HIT), F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c) if c in vals else F.col(c) for c in cols])
        for layer in kept]
    new = upserts
    for layer in kept:
        new = new.join(layer.select(*keys), keys, "left_anti")
    return [*updated, truncate_load_as(schema, new)]


def truncate_load_as(schema: T.StructType, rows: DataFrame) -> DataFrame:
    """``rows`` with all columns of ``schema``; those it lacks get their defaults."""
    return rows.select(*[F.col(f.name) if f.name in rows.columns else absent(f) for f in schema.fields])


def apply_net_change(target: DataFrame, net: DataFrame, keys: Sequence[str],
                     on_match: str = "update", action_col: str = ACTION,
                     materialize: bool = True) -> DataFrame:
    """Apply a reduced feed (one row per key with INSERT/DELETE).

    The net change is referenced by the delete keys, the touched keys and the
    new rows; Spark would recompute its whole lineage (often a diff of two
    snapshots) for each. ``materialize`` checkpoints it once to the shared
    folder (``spark.checkpoint.dir``) so every reference reads that instead."""
    if materialize:
        from ..session import checkpoint_dir
        checkpoint_dir(net.sparkSession)
        net = net.checkpoint(eager=True)
    cdc = [c for c in net.columns if c.startswith("_cdc_") or c == "consume_id"]
    upserts = net.where(F.col(action_col) == "INSERT").drop(*cdc)
    deletes = net.where(F.col(action_col) == "DELETE").select(*keys)
    return apply_changes(target, upserts, deletes, keys, on_match)


def truncate_load(target: DataFrame, source: DataFrame) -> DataFrame:
    """Empty the target, then load the source (columns matched by name)."""
    _check_columns(target, source)
    return source.select(*[F.col(c) if c in source.columns
                           else F.lit(None).cast(target.schema[c].dataType).alias(c)
                           for c in target.columns])


def append(target: DataFrame, rows: DataFrame, run_id: str | None = None,
           run_col: str = "_run_id") -> DataFrame:
    """Plain inserts. With ``run_id`` the rows are tagged, and replaying the
    same run first removes the rows it appended before (no duplicates)."""
    _check_columns(target, rows)
    if run_id is None:
        return target.unionByName(rows, allowMissingColumns=True)
    tagged = rows.withColumn(run_col, F.lit(run_id))
    base = target if run_col in target.columns else target.withColumn(run_col, F.lit(None).cast("string"))
    base = base.where(~F.col(run_col).eqNullSafe(run_id))
    return base.unionByName(tagged, allowMissingColumns=True)
