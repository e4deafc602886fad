"""Native sink: plain Parquet files per key-hash bucket plus a JSON manifest.

Layout under the table folder::

    _manifest/v0000000001.json   {version, schema, keys, n_buckets, bytes,
                                  buckets: {b: [run ids]}, state, acked, run}
    data/<run id>/_bucket=<b>/   Parquet files written by one publish

A publish first casts the change to the table's schema and writes it down once;
everything after reads that copy, so a source that moves meanwhile cannot give
two passes two answers. (A first or emptying load into a known number of buckets
is one pass and goes into them directly.) It then rewrites the buckets whose keys the change
matches (updates, deletes); buckets that only receive new keys get one more
file. The next manifest is created *exclusively*. That create is the
compare-and-swap: data, watermark and acknowledged consumes become visible
together or not at all, and of two concurrent runs exactly one wins (the other
raises ``ConcurrentPublish`` and publishes nothing). Readers list the manifest
and read the files it names.

Bucket ids are ``pmod(hash(keys), n)`` over the keys in the table's own types —
the same function Spark's hash partitioner and its bucketed writer apply. A merge
reads the stored buckets as bucketed tables (registered in the session's catalog
for the length of the publish, one per layer of runs), so only the change is
exchanged; stored rows are joined where they lie. ``n`` is sized from bytes
written and grows with the table, and a bucket that has come to hold
``MAX_RUNS`` runs is rewritten with the next change that touches it.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fs
from ..functions.columns import cast_exactly
from ..operators.keys import folded_name, with_folded_keys
from ..operators import merge as M

BUCKET = "_bucket"
KEYLESS = "all"
#: Runs that a bucket holds at most; a further change to it rewrites it.
MAX_RUNS = 8


class ConcurrentPublish(RuntimeError):
    """Another run published first; nothing of this run is visible."""


def bucket_of(keys: Sequence[str], n: int):
    return F.pmod(F.hash(*[F.col(k) for k in keys]), F.lit(n))


def _table_name() -> str:
    return f"sluice_{uuid.uuid4().hex}"


def buckets_for(size: int, bucket_bytes: int) -> int:
    """Bucket count for so many bytes on disk: a power of two, 2 at least."""
    n = 2
    while n * bucket_bytes < size:
        n *= 2
    return n


class NativeTable:
    """A keyed table folder. ``buckets`` fixes the bucket count of a new table;
    with ``None`` it is sized from the bytes of the first load,
    ``bucket_bytes`` per bucket, and doubled as the table outgrows it.
    ``defaults`` (SQL expressions by column) are declared with the first load
    and kept in the manifest's schema; new and replaced rows get them in columns
    that a change does not bring. With ``case_insensitive``
    text keys match whatever their case: they are stored in lower case beside
    the spelling that came first. An existing table always uses the keys and
    the settings of its manifest."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str] = (),
                 buckets: int | None = None, bucket_bytes: int = 512 << 20,
                 max_records_per_file: int = 10_000_000, defaults: Mapping[str, str] | None = None,
                 case_insensitive: bool = False):
        self.spark = spark
        self.case_insensitive = case_insensitive
        self.defaults = dict(defaults or {})
        self.root = root.rstrip("/")
        self.keys = list(keys)
        self.n = int(buckets) if buckets else None
        self.fixed = buckets is not None
        self.bucket_bytes = bucket_bytes
        self.max_records = max_records_per_file
        #: Buckets the last merge touched, rewrote and only added to.
        self.last_merge: dict[str, int] = {}
        m = self.manifest()
        if m is not None:
            self._adopt(m)

    def _adopt(self, m: dict) -> None:
        if self.keys and m["keys"] and list(m["keys"]) != self.keys:
            raise ValueError(f"table {self.root} is keyed by {m['keys']}, not {self.keys}")
        self.keys = list(m["keys"])
        self.n = int(m["n_buckets"])
        self.fixed = bool(m.get("fixed_buckets", True))
        self.case_insensitive = bool(m.get("case_insensitive", False))

    # -------------------------------------------------------------- reading

    def _manifest_path(self, v: int) -> str:
        return f"{self.root}/_manifest/v{v:010d}.json"

    def version(self) -> int | None:
        names = [n for n in fs.list_names(self.spark, f"{self.root}/_manifest")
                 if n.startswith("v") and n.endswith(".json")]
        return max((int(n[1:11]) for n in names), default=None)

    def manifest(self, version: int | None = None) -> dict | None:
        v = self.version() if version is None else version
        if v is None:
            return None
        return json.loads(fs.read_text(self.spark, self._manifest_path(v)))

    def schema(self, version: int | None = None) -> T.StructType | None:
        m = self.manifest(version)
        return None if m is None else T.StructType.fromJson(m["schema"])

    def state(self) -> dict:
        m = self.manifest()
        return {} if m is None else m.get("state", {})

    def acked(self) -> list[int]:
        m = self.manifest()
        return [] if m is None else m.get("acked", [])

    def _path(self, run_id: str, bucket: str) -> str:
        base = f"{self.root}/data/{run_id}"
        return base if bucket == KEYLESS else f"{base}/{BUCKET}={bucket}"

    def read(self, version: int | None = None, buckets: Sequence[str] | None = None) -> DataFrame:
        m = self.manifest(version)
        if m is None:
            raise FileNotFoundError(f"no table at {self.root}")
        schema = T.StructType.fromJson(m["schema"])
        chosen = m["buckets"] if buckets is None else {b: m["buckets"][b] for b in buckets
                                                       if b in m["buckets"]}
        paths = [self._path(r, b) for b, runs in chosen.items() for r in runs]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    # -------------------------------------------------------------- writing

    def _match(self, schema: T.StructType) -> list[str]:
        """The columns that keys are matched, hashed and sorted by."""
        types = {f.name: f.dataType.simpleString() for f in schema.fields}
        return [folded_name(types, k) for k in self.keys] if self.case_insensitive else self.keys

    def _stored(self, schema: T.StructType) -> T.StructType:
        """The schema of the files: the table's and the folded keys."""
        return T.StructType([*schema.fields, *[T.StructField(m, T.StringType()) for m in self._match(schema)
                                               if m not in schema.names]])

    def _folded(self, df: DataFrame | None) -> DataFrame | None:
        return with_folded_keys(df, self.keys)[0] if df is not None and self.case_insensitive else df

    def _write(self, df: DataFrame, run_id: str) -> dict[str, list[str]]:
        """Write rows bucketed; returns {bucket: [run id]} of what was written.

        The files carry Spark's bucket numbers, so that a later merge can read
        them as a bucketed table; key order inside each keeps Parquet min/max
        statistics tight."""
        out = f"{self.root}/data/{run_id}"
        w_opts = {"maxRecordsPerFile": str(self.max_records)}
        if self.keys:
            match = self._match(df.schema)
            rows = df.withColumn(BUCKET, bucket_of(match, self.n).cast("int"))
            name = _table_name()
            try:
                (rows.write.format("parquet").options(path=out, **w_opts).partitionBy(BUCKET)
                 .bucketBy(self.n, *match).sortBy(*match).saveAsTable(name))
            finally:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")   # the files stay
            pre = f"{BUCKET}="
            return {n[len(pre):]: [run_id]
                    for n in fs.list_names(self.spark, out) if n.startswith(pre)}
        df.write.mode("overwrite").options(**w_opts).parquet(out)
        return {KEYLESS: [run_id]}

    @contextmanager
    def _layers(self, buckets: Mapping[str, Sequence[str]], schema: T.StructType) -> Iterator[list[DataFrame]]:
        """The stored buckets as bucketed tables: the first runs of all buckets,
        the second ones, and so on. A key lies in one layer only."""
        names, out = [], []
        by = ", ".join(f"`{k}`" for k in self._match(schema))
        columns = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
        try:
            for depth in range(max((len(r) for r in buckets.values()), default=0)):
                name = _table_name()
                names.append(name)
                self.spark.sql(f"CREATE TABLE {name} ({columns.toDDL()}) USING parquet PARTITIONED BY ({BUCKET}) "
                               f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {self.n} BUCKETS "
                               f"LOCATION '{self.root}/_layers/{name}'")
                parts = [f"PARTITION ({BUCKET}={b}) LOCATION '{self._path(runs[depth], b)}'"
                         for b, runs in buckets.items() if len(runs) > depth]
                for i in range(0, len(parts), 1000):
                    self.spark.sql(f"ALTER TABLE {name} ADD {' '.join(parts[i:i + 1000])}")
                out.append(self.spark.table(name))
            yield out
        finally:
            for name in names:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def _settle(self, df: DataFrame | None, schema: T.StructType, path: str,
                only: Sequence[str] = (), stored_bytes: int | None = None,
                once: bool = False) -> tuple[DataFrame | None, int]:
        """The change in the table's types, written once; also its bytes. What
        is stored already (``stored_bytes``) and has these types is not copied,
        nor what is read ``once`` only; its bytes are not known then."""
        if df is None:
            return None, 0
        if only:
            df = df.select(*only)
        types = {f.name: f.dataType for f in schema.fields}
        if stored_bytes is not None and all(types.get(f.name) == f.dataType for f in df.schema.fields):
            return df, stored_bytes
        df = cast_exactly(df, schema)
        if once:
            return df, 0
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), fs.size(self.spark, path)

    def publish(self, upserts: DataFrame | None = None, deletes: DataFrame | None = None,
                truncate: bool = False, append: bool = False, on_match: str = "update",
                state: dict | None = None, ack: Sequence[int] = (), run: dict | None = None,
                expected_version: int | None = -1, ack_floor: int | None = None,
                replay_key: str | None = None, stored_bytes: int | None = None) -> int:
        """Apply a change and commit it with the progress; returns the new version.

        ``expected_version=-1`` means "the version current when publish starts".
        Columns are matched by name and cast to the table's types; a value that
        does not fit fails the publish. ``stored_bytes`` says that the change is
        read from files of its own of this size, which nobody else changes; it
        is then not copied again where its types are the table's.
        """
        base_v = self.version() if expected_version == -1 else expected_version
        base = self.manifest(base_v) if base_v is not None else None
        if base is not None:
            self._adopt(base)
            schema = T.StructType.fromJson(base["schema"])
        elif upserts is not None:
            schema = M.with_defaults(upserts.schema, self.defaults)
        else:
            raise ValueError("first publish needs rows")
        run_id = f"r{_dt.datetime.now(_dt.timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
        change = f"{self.root}/_change/{run_id}"
        try:
            return self._apply(base_v, base, schema, run_id, change, upserts, deletes, truncate, append,
                               on_match, state, ack, run, ack_floor, replay_key, stored_bytes)
        finally:
            fs.delete(self.spark, change)

    def _apply(self, base_v, base, schema, run_id, change, upserts, deletes, truncate, append,
               on_match, state, ack, run, ack_floor, replay_key, stored_bytes) -> int:
        old = base or {}
        fresh = base is None or truncate
        buckets: dict[str, list[str]] = {} if fresh else dict(old["buckets"])
        appends = dict(old.get("appends", {}))
        if replay_key in appends:
            # A replayed append takes out what it appended before, file by file.
            earlier = appends[replay_key]
            if not any(earlier in runs for runs in buckets.values()):
                raise ValueError(f"rows appended under {replay_key!r} were rewritten since; "
                                 f"replaying would add them again")
            buckets = {b: kept for b, runs in buckets.items() if (kept := [r for r in runs if r != earlier])}
        once = fresh and self.n is not None
        upserts, up_bytes = self._settle(upserts, schema, f"{change}/upserts", stored_bytes=stored_bytes, once=once)
        deletes, _ = self._settle(deletes, schema, f"{change}/deletes", only=self.keys, stored_bytes=stored_bytes)
        upserts, deletes, stored = self._folded(upserts), self._folded(deletes), self._stored(schema)
        if base_v != self.version():
            raise ConcurrentPublish(f"{self.root} moved past version {base_v}")
        size = up_bytes + (0 if fresh else old.get("bytes", 0))
        if self.n is None:
            self.n = buckets_for(size, self.bucket_bytes) if self.keys else 1
        whole = (lambda df: M.truncate_load_as(stored, df))
        if fresh:
            if upserts is not None:
                buckets = self._write(self._spread(whole(upserts)), run_id)
                size = size or fs.size(self.spark, f"{self.root}/data/{run_id}")
        elif append or not self.keys:
            if upserts is not None:
                for b, runs in self._write(self._spread(whole(upserts)), run_id).items():
                    buckets[b] = buckets.get(b, []) + runs
        else:
            grown = self.n if self.fixed else max(self.n, buckets_for(size // 2, self.bucket_bytes))
            if grown > self.n:  # the table has doubled: deal all of it out anew
                current = self._folded(self.read(base_v))
                self.n = grown
                if self.case_insensitive:
                    parts = M.apply_in_place([current], upserts, deletes, self._match(schema), on_match, stored, self.keys)
                    rows = reduce(DataFrame.unionByName, parts)
                else:
                    rows = M.apply_changes(current, upserts, deletes, self.keys, on_match, schema)
                buckets = self._write(self._spread(rows), run_id)
                size = fs.size(self.spark, f"{self.root}/data/{run_id}")
            else:
                buckets = self._merge(stored, buckets, upserts, deletes, on_match, run_id, whole)
        if replay_key and append and upserts is not None:
            appends[replay_key] = run_id
        manifest = {
            "version": (base_v or 0) + 1,
            "schema": json.loads(schema.json()),
            "keys": self.keys,
            "n_buckets": self.n,
            "fixed_buckets": self.fixed,
            "case_insensitive": self.case_insensitive,
            # Bytes of the table, counted high where updates replace rows.
            "bytes": size,
            "buckets": buckets,
            "state": state if state is not None else old.get("state", {}),
            # Ids below the floor were purged after being acknowledged: forget them.
            "acked": sorted(a for a in set(old.get("acked", [])) | {int(a) for a in ack}
                            if ack_floor is None or a >= ack_floor),
            "run": {"run_id": run_id, **(run or {})},
            "appends": {} if truncate else appends,
        }
        if not fs.create_exclusive(self.spark, self._manifest_path(manifest["version"]),
                                   json.dumps(manifest, indent=1, default=str)):
            fs.delete(self.spark, f"{self.root}/data/{run_id}")
            raise ConcurrentPublish(f"version {manifest['version']} of {self.root} exists")
        return manifest["version"]

    def _merge(self, schema: T.StructType, buckets: dict[str, list[str]], upserts: DataFrame | None,
               deletes: DataFrame | None, on_match: str, run_id: str, whole) -> dict[str, list[str]]:
        """Keyed change against the touched buckets only.

        A bucket is rewritten only if the change matches a key it already holds
        (update or delete) or it has grown to ``MAX_RUNS`` runs. A bucket that
        only receives new keys keeps its files and gets the new rows as one more
        file — inserts never rewrite old data. Which keys already exist is found
        with a semi-join on the key columns alone. In either join the stored
        side is read bucket by bucket and never exchanged or sorted.
        """
        match = self._match(schema)
        b_col = bucket_of(match, self.n).cast("string")
        changed = [d.select(*match) for d in (upserts, deletes) if d is not None]
        if not changed:
            return buckets
        keys = changed[0] if len(changed) == 1 else changed[0].unionByName(changed[1])
        # One row per touched bucket: bounded by the bucket count, not the data.
        touched = {r["b"] for r in keys.select(b_col.alias("b")).distinct().collect()}
        if not touched:
            return buckets
        dealt = keys.repartition(self.n, *match).hint("shuffle_hash")
        rewrite = {b for b in touched if len(buckets.get(b, ())) >= MAX_RUNS}
        with self._layers({b: r for b, r in buckets.items() if b in touched - rewrite}, schema) as layers:
            hit = [r[BUCKET] for layer in layers for r in
                   layer.select(*match, BUCKET).join(dealt, match, "left_semi").select(BUCKET).distinct().collect()]
        rewrite |= {str(b) for b in hit}
        add_to = touched - rewrite
        self.last_merge = {"touched": len(touched), "rewritten": len(rewrite), "appended": len(add_to)}
        out = {b: runs for b, runs in buckets.items() if b not in rewrite}
        ids = self.spark.createDataFrame([(b,) for b in rewrite], "b string")
        of = lambda d, how: None if d is None else (d.join(F.broadcast(ids), b_col == F.col("b"), how)
                                                    .repartition(self.n, *match))
        with self._layers({b: r for b, r in buckets.items() if b in rewrite}, schema) as layers:
            pieces = M.apply_in_place([layer.drop(BUCKET) for layer in layers], of(upserts, "left_semi"),
                                      of(deletes, "left_semi"), match, on_match, schema,
                                      self.keys if self.case_insensitive else ()) if rewrite else []
            if add_to and upserts is not None:
                pieces.append(whole(of(upserts, "left_anti")))
            if pieces:
                rows = pieces[0]
                for p in pieces[1:]:
                    rows = rows.unionByName(p)
                for b, runs in self._write(rows, run_id).items():
                    if b not in touched:
                        raise RuntimeError(f"rows were written to bucket {b}, which the change does not touch")
                    out[b] = out.get(b, []) + runs
        return out

    def _spread(self, df: DataFrame) -> DataFrame:
        return df.repartition(self.n, *self._match(df.schema)) if self.keys else df
