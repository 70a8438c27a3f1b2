"""The target tables as folders of Parquet behind one pointer, and the steps that change them.

A batch never touches the rows stored before it. It writes a folder of changes per table,
and then moves the pointer: a small note, numbered by version, that names the base folder
and the change folders of every table. So all tables of a batch appear at once, and what a
reader has opened stays as it was. Reading folds the changes into the base by the rule of
the table; ``compact`` does the same once and makes the result the new base.

A version is created only if it does not exist. A writer that began at an older version
than the one it finds gets an error, and its batch starts anew when it is repeated.

The base of the posts is bucketed and sorted by key. Buckets are known to a catalog only, so
each session enters the base into its own, as an external table with a name out of its path.

A batch has a key: the operation and the id it was given. A mark of its input stands
beside it; a key that comes back with another input is an error. Whatever a batch writes is
written once and kept with its counts, so one that was cut off goes on where it was.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F, types as T

from .. import constants as K
from ..config import Settings
from ..operators import merge
from ..schema import TABLES

# Base folders of keyed tables are cut by something the key determines, so a read of some keys or days reads only those:
# posts by Spark's own buckets, whose number stands in each row, the others by folders of days.
_PARTITION = {
    "post_analytics": ("key_bucket", T.IntegerType()),
    "post_metrics_history": ("observed_date", T.DateType()),
    "follower_analytics": ("collected_day", T.DateType()),
}
_KEYS = {
    "post_analytics": K.POST_KEY, "company_analytics": K.COMPANY_KEY, "post_metrics_history": K.HISTORY_KEY,
    "follower_analytics": K.FOLLOWER_KEY,
}
# Kept beside the columns of the table, for the merge.
_HIDDEN = {"post_analytics": T.StructField("exported_at", T.TimestampType())}
_DATED = ("post_analytics", "follower_analytics")  # tables that age


class OtherWriter(RuntimeError):
    """Another writer has published since this batch began."""


def oldest_of() -> Column:
    return F.unix_micros(F.min("date_collected"))


def _policy(entry: dict) -> str | None:
    """The policy of the changes of a table; None where none has one."""
    found = {change["policy"] for change in entry["changes"] if change.get("policy")}
    if len(found) > 1:
        raise ValueError("changes under another policy wait; compact the tables first")
    return found.pop() if found else None


def _folder_name(key: str) -> str:
    """A batch key as part of a folder's name; two keys never share one."""
    return f"{key.replace('/', '-')}-{hashlib.md5(key.encode()).hexdigest()[:12]}"


def table_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[name])


def _stored_schema(name: str) -> T.StructType:
    schema = table_schema(name)
    return schema.add(_HIDDEN[name]) if name in _HIDDEN else schema


class PageTables:
    """Tables below one folder.

    ``key_buckets`` is fixed when the folder is first used. Choose it so that a bucket of posts has a few
    gigabytes; looking up some ids reads only their buckets.
    """

    def __init__(self, spark: SparkSession, root: str, settings: Settings):
        self.spark, self.root = spark, root.rstrip("/")
        if self._note(f"{self.root}/_layout/key_buckets") is None:
            self._keep(f"{self.root}/_layout/key_buckets", str(settings.key_buckets))
            for name in TABLES:
                place, system = self._file_system(self.path(name))
                system.mkdirs(place)
        self.buckets = int(self._note(f"{self.root}/_layout/key_buckets"))
        self._pending: dict[str, list[tuple[str, dict]]] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    # --- folders and notes ------------------------------------------------------------
    def _file_system(self, path: str):
        context = self.spark.sparkContext
        hadoop_path = context._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path, hadoop_path.getFileSystem(context._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        hadoop_path, system = self._file_system(path)
        return system.exists(hadoop_path)

    def _delete(self, path: str) -> None:
        hadoop_path, system = self._file_system(path)
        system.delete(hadoop_path, True)

    def missing(self) -> list[str]:
        """Target tables that have no folder, say because someone removed it."""
        return [name for name in TABLES if not self._exists(self.path(name))]

    def _keep(self, path: str, text: str, only_new: bool = False) -> bool:
        """A short text as a file that is there whole or not at all. ``only_new`` leaves one that is there."""
        if only_new and self._exists(path):
            return False
        final, system = self._file_system(path)
        final = system.makeQualified(final)
        begun, _ = self._file_system(f"{final.toString()}.{uuid.uuid4().hex}.begun")
        stream = system.create(begun, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        # Moved to a free place by the plain call: the one that minds what is there starts ten processes on a local disk.
        if not only_new and not system.exists(final) and system.rename(begun, final):
            return True
        context = self.spark.sparkContext
        files = context._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), context._jsc.hadoopConfiguration())
        rename = context._jvm.org.apache.hadoop.fs.Options.Rename
        how = context._gateway.new_array(rename, 1)
        how[0] = rename.NONE if only_new else rename.OVERWRITE
        try:
            files.rename(begun, final, how)
        except Exception as lost:  # the only way to learn that another writer was first
            system.delete(begun, False)
            if only_new and "FileAlreadyExists" in str(lost):
                return False
            raise
        return True

    def _note(self, path: str) -> str | None:
        place, system = self._file_system(path)
        if not system.exists(place):
            return None
        stream = system.open(place)
        text = bytes(stream.readAllBytes()).decode()
        stream.close()
        return text

    # --- versions ----------------------------------------------------------------------
    def version(self) -> int:
        """The number of the last version published; 0 before the first."""
        place, system = self._file_system(f"{self.root}/_current")
        if not system.exists(place):
            return 0
        names = [f.getPath().getName() for f in system.listStatus(place)]
        return max((int(n) for n in names if n.isdigit()), default=0)

    def _state(self, version: int | None = None) -> dict:
        """What folders make up each table."""
        version = self.version() if version is None else version
        text = self._note(f"{self.root}/_current/{version:010d}") if version else None
        return json.loads(text) if text else {name: {"base": None, "oldest": None, "changes": []} for name in TABLES}

    # --- reading -------------------------------------------------------------------------
    def _bucketed(self, name: str, df: DataFrame) -> DataFrame:
        """With the partition column of the base, which the key determines."""
        by = _PARTITION.get(name, (None,))[0]
        if by is None or by in df.columns:
            return df
        if by == "collected_day":
            return df.withColumn(by, F.to_date("date_collected"))
        return df.withColumn(by, F.pmod(F.hash(*K.POST_KEY), F.lit(self.buckets)).cast("int"))  # as bucketBy counts them

    def _qualified(self, path: str) -> str:
        place, system = self._file_system(f"{self.root}/{path}")
        return system.makeQualified(place).toString()

    def _catalog_name(self, path: str) -> str:
        return f"tallymark_base_{hashlib.md5(self._qualified(path).encode()).hexdigest()}"

    def _opened(self, path: str, schema: T.StructType) -> DataFrame:
        """A bucketed base as an external table of the session's catalog, which alone tells Spark of buckets."""
        name, columns = self._catalog_name(path), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        if not self.spark.catalog.tableExists(name):
            keys, place = ", ".join(K.POST_KEY), self._qualified(path).replace("\\", "\\\\").replace("'", "\\'")
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
                f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{place}'"
            )
        return self.spark.read.table(name)

    def _none(self, schema: T.StructType) -> DataFrame:
        """No rows, and known to Spark as such: what is joined or united with them costs no job."""
        return self.spark.range(0).where(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])

    def _base(self, name: str, entry: dict, buckets: list | None = None) -> DataFrame:
        schema, by = _stored_schema(name), _PARTITION.get(name)
        columns = schema.names
        if entry["base"] is None:
            return self._none(schema)
        if by is not None and by[0] not in columns:
            schema = _stored_schema(name).add(by[0], by[1])
        if name == "post_analytics":
            rows = self._opened(entry["base"], schema)
        else:
            rows = self.spark.read.schema(schema).parquet(f"{self.root}/{entry['base']}")
        if buckets is not None:
            rows = rows.where(F.col(by[0]).isin(buckets))
        return rows.select(*columns)

    def read(self, name: str) -> DataFrame:
        """The table as last published; select, filter, order and limit as on any DataFrame.

        A batch that is published later does not change what this reads.
        """
        return self._folded(name, self._state()[name]).select(*table_schema(name).names)

    def near(self, name: str, rows: DataFrame) -> DataFrame:
        """The stored rows of the partitions that hold the keys of ``rows``; the others of the base are not read."""
        entry = self._state()[name]
        if entry["base"] is None:
            return self._folded(name, entry).select(*table_schema(name).names)
        by = _PARTITION[name][0]
        buckets = [r[0] for r in self._bucketed(name, rows).select(by).distinct().collect()]  # one per bucket or day
        return self._folded(name, entry, buckets).select(*table_schema(name).names)

    def _folded(self, name: str, entry: dict, buckets: list | None = None) -> DataFrame:
        """The base with its changes. Base rows whose key no change has pass by as they are, without a shuffle: the
        keys of the changes are broadcast if Spark finds them small, else they come to the buckets of the base."""
        base, columns = self._base(name, entry, buckets), _stored_schema(name).names
        if not entry["changes"]:
            return base
        alike: dict[tuple, list[str]] = {}
        for change in entry["changes"]:
            alike.setdefault((change["kind"], *change["supplied"]), []).append(f"{self.root}/{change['path']}")
        schema = _stored_schema(name).add("change_no", T.LongType())
        rows = reduce(DataFrame.unionByName, [
            self.spark.read.schema(schema).parquet(*paths).withColumns({
                "kind": F.lit(kind), "supplied": F.array(*[F.lit(c) for c in supplied]).cast("array<string>"),
            })
            for (kind, *supplied), paths in alike.items()
        ])
        if name not in _KEYS:
            return base.unionByName(rows.select(*columns))
        keys, rest = _KEYS[name], None
        if entry["base"] is not None:
            touched = rows.select(*keys)
            if name == "post_analytics":
                touched = touched.repartition(self.buckets, *keys)
            rest = base.join(touched, keys, "left_anti").select(*columns)
            rows = rows.unionByName(base.join(touched, keys, "left_semi").withColumns({
                "change_no": F.lit(0).cast("long"), "kind": F.lit("base"), "supplied": F.lit(None).cast("array<string>"),
            }))
        partial = {c for kind, *supplied in alike for c in columns if kind != "drop" and c not in supplied}
        if any(kind == "drop" for kind, *_ in alike):
            rows = merge.without_dropped(rows, keys)
        if name == "post_analytics":
            folded = merge.fold_post_changes(rows, _policy(entry) or "max", partial).select(*columns)
        else:
            folded = merge.fold_changes(rows, keys, partial).select(*columns)
        return folded if rest is None else rest.unionByName(folded)

    # --- batches -------------------------------------------------------------------------
    def begin(self, key: str, mark: Callable[[], str]) -> dict | None:
        """The counts of a batch that is done, or None while it is not.

        The mark of the input is kept when the batch first begins. What a batch wrote at an older version
        than the present one is dropped, unless it is published: it may rest on rows that have changed.
        """
        place = f"{self.root}/_batches/{key}"
        now = hashlib.md5(mark().encode()).hexdigest()
        known = self._note(f"{place}/mark")
        if known is None:
            self._keep(f"{place}/mark", now)
        elif known != now:
            raise ValueError(f"batch {key} was used with another input")
        counts = self._note(f"{place}/counts")
        if counts is not None:
            return json.loads(counts)
        began, version = self._note(f"{place}/version"), self.version()
        if began is not None and int(began) != version and not self._published(key):
            self._discard(key, keep=("files",))
        if began is None or not self._published(key):
            self._keep(f"{place}/version", str(version))
        self._pending[key] = []
        return None

    def done(self, key: str) -> bool:
        return self._note(f"{self.root}/_batches/{key}/counts") is not None

    def _began(self, key: str) -> int:
        return int(self._note(f"{self.root}/_batches/{key}/version"))

    def _published(self, key: str) -> bool:
        return any(
            key in entry.get("keys", []) or any(change["key"] == key for change in entry["changes"]) for entry in self._state().values()
        )

    def _discard(self, key: str, keep: tuple[str, ...] = ()) -> None:
        place, system = self._file_system(f"{self.root}/_staging/{key}")
        for found in system.listStatus(place) if system.exists(place) else []:
            if not found.getPath().getName().startswith(keep or ("/",)):
                system.delete(found.getPath(), True)
        for name in TABLES:
            place, system = self._file_system(self.path(name))
            for found in system.listStatus(place):
                if found.getPath().getName().startswith(f"change-{_folder_name(key)}-"):
                    system.delete(found.getPath(), True)

    def forget_batch(self, key: str) -> None:
        """A batch that found nothing to do leaves its id free."""
        self._delete(f"{self.root}/_staging/{key}")

    def finish(self, key: str, **counts: int) -> None:
        """Publish the changes of a batch, keep its counts and drop its helper rows."""
        self.publish(key)
        self._keep(f"{self.root}/_batches/{key}/counts", json.dumps(counts))
        self._delete(f"{self.root}/_staging/{key}")

    def _write(self, path: str, rows: DataFrame, mode: str = "overwrite", **observed) -> dict:
        """Write rows and what is observed of them, in one job after their shuffles."""
        seen = Observation()
        reason = F.col("_reason") if "_reason" in rows.columns else F.lit(None)
        watched = rows.observe(
            seen, F.count_if(reason.isNull()).alias("rows"), F.count_if(reason.isNotNull()).alias("rejected"),
            *[c.alias(n) for n, c in observed.items()],
        )
        watched.where(reason.isNull()).drop("_reason").write.mode(mode).parquet(path)
        return dict(seen.get)

    def stage(self, key: str, label: str, rows: Callable[[], DataFrame], **observed) -> tuple[DataFrame, dict]:
        """Helper rows of a batch and what was observed of them while they were written: their number as ``rows``,
        and the named aggregates. A repeated batch gets what it wrote the first time."""
        path = f"{self.root}/_staging/{key}/{label}"
        known = self._note(f"{path}.counts")
        if known is not None:
            found = json.loads(known)
        else:
            given = rows()
            found = self._write(path, given, **observed) | {"schema": given.schema.json()}
            self._keep(f"{path}.counts", json.dumps(found))
        schema = T.StructType.fromJson(json.loads(found.pop("schema")))
        return self.spark.read.schema(schema).parquet(path), found

    # --- changes --------------------------------------------------------------------------
    def _reason(self, name: str, kind: str, folded: bool) -> dict[str, Column]:
        """Why a row cannot be stored: part of its key is missing, or another row of the batch has it too."""
        if name not in _KEYS or kind != "merge":
            return {}
        keys = _KEYS[name]
        missing = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
        if folded:
            return {"_reason": F.when(missing, "part of the key is missing")}
        twice = F.count("*").over(Window.partitionBy(*keys)) > 1
        return {"_reason": F.when(missing, "part of the key is missing").when(twice, "the key occurs twice")}

    def change(
        self, name: str, key: str, rows: Callable[[], DataFrame], kind: str = "merge", policy: str | None = None, label: str = "",
        folded: bool = False,
    ) -> dict:
        """Write the changes of a batch to one table, one row per key; seen by nobody before ``finish``.

        ``merge`` rows meet the stored rows by the rule of the table, ``set`` rows only set the columns they
        have, ``drop`` rows take their key away. Columns that rows do not have keep their stored values.
        ``policy`` is that of the posts; changes under another one must be compacted first.
        ``merge`` rows without a whole key, and all rows of a key that the batch has twice, go to ``rejected_rows``;
        the others are taken. ``folded`` rows come out of an aggregate by that key, so none is there twice
        and nobody looks for it. Returns their number and, for tables that age, the least ``date_collected``.
        """
        path, columns = f"{self.path(name)}/change-{_folder_name(key)}-{kind}{label}", _stored_schema(name)

        def checked(given: DataFrame) -> DataFrame:
            full = given.select(*[
                F.col(f.name).cast(f.dataType) if f.name in given.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in columns
            ])
            return full.withColumns({"change_no": F.lit(self._began(key) + 1).cast("long"), **self._reason(name, kind, folded)})

        known = self._note(f"{path}.counts")
        if known is None:
            observed = {"oldest": oldest_of()} if name in _DATED and kind == "merge" else {}
            given = rows()
            names = set(given.columns)
            found = self._write(path, checked(given), **observed) | {"supplied": [c for c in columns.names if c in names]}
            self._keep(f"{path}.counts", json.dumps(found))
        else:
            found = json.loads(known)
        if found["rejected"]:
            record = F.to_json(F.struct(*columns.names)).alias("record")
            self.change(
                "rejected_rows", key,
                lambda: checked(rows()).where("_reason IS NOT NULL").select(F.lit(name).alias("path"), record, F.col("_reason").alias("reason"), F.lit(key).alias("batch_id")),
                label=f"-{name}",
            )
        self._pending[key].append((name, {"path": path.removeprefix(f"{self.root}/"), "kind": kind, "key": key, "policy": policy, **found}))
        return found

    def publish(self, key: str, bases: dict[str, dict] | None = None) -> None:
        """Move the pointer on: the changes of the batch, or new base folders, become the tables.

        An error if another version has come since the batch began; a batch that is published already stays so.
        """
        began = self._began(key)
        state = self._state(began)
        pending = [(name, change) for name, change in self._pending.pop(key, []) if change["rows"]]
        if self._published(key) or not (pending or bases):
            return
        for name, change in pending:
            state[name]["changes"].append(change)
            _policy(state[name])
        for name, entry in (bases or {}).items():
            state[name] = entry
        if self.version() != began or not self._keep(f"{self.root}/_current/{began + 1:010d}", json.dumps(state), only_new=True):
            raise OtherWriter(f"another writer has published since batch {key} began; repeat the batch")

    # --- upkeep ---------------------------------------------------------------------------
    def oldest(self, name: str) -> datetime | None:
        """No row of the table was collected before this; None if that is not known, or the table is empty."""
        entry = self._state()[name]
        known = [change.get("oldest") for change in entry["changes"] if change["kind"] == "merge"]
        known += [entry["oldest"]] if entry["base"] else []
        return datetime(1970, 1, 1) + timedelta(microseconds=min(known)) if known and None not in known else None

    def is_empty(self, name: str) -> bool:
        """Whether the table has neither a base nor changes; no data is read."""
        entry = self._state()[name]
        return entry["base"] is None and not entry["changes"]

    def compact(self, batch_id: str) -> list[str]:
        """Fold the changes of each table into a new base; the rows stay the same. Returns the tables that had changes.

        Old folders stay for those who read them, until ``forget``.
        """
        key = f"compact/{batch_id}"
        if self.begin(key, lambda: "compact") is not None:
            return []
        state, bases = self._state(), {}
        for name, entry in state.items():
            if not entry["changes"]:
                continue
            path, by = f"{name}/base-{_folder_name(key)}", _PARTITION.get(name, (None,))[0]
            seen = Observation()
            observed = [oldest_of().alias("oldest")] if name in _DATED else []
            rows = self._bucketed(name, self._folded(name, entry))
            if name == "post_analytics":  # one file per bucket
                rows = rows.repartition(self.buckets, *K.POST_KEY)
            elif by is not None:  # groups the rows of a day and splits those that are large
                rows = rows.hint("rebalance", by)
            rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *observed)
            writer = rows.write.mode("overwrite")
            if name == "post_analytics":
                clustered = writer.bucketBy(self.buckets, *K.POST_KEY).sortBy(*K.POST_KEY)
                clustered.option("path", self._qualified(path)).saveAsTable(self._catalog_name(path), format="parquet")
            else:
                (writer.partitionBy(by) if by is not None else writer).parquet(f"{self.root}/{path}")
            # A batch that is published but does not know it yet must find its key.
            open_ = [change["key"] for change in entry["changes"] if not self.done(change["key"])]
            bases[name] = {"base": path, "oldest": seen.get.get("oldest"), "changes": [], "keys": sorted({*open_, *entry.get("keys", [])})}
        self.publish(key, bases)
        self.finish(key, tables=len(bases))
        return list(bases)

    def forget(self, versions: int = 2) -> None:
        """Delete folders that none of the last ``versions`` names. Who still reads an older one loses it."""
        last, used = self.version(), set()
        for number in range(max(1, last - versions + 1), last + 1):
            for entry in self._state(number).values():
                used |= {entry["base"], *(change["path"] for change in entry["changes"])}
        running = {key for key, pending in self._pending.items() if pending}
        for name in TABLES:
            place, system = self._file_system(self.path(name))
            for found in system.listStatus(place) if last else []:
                path = f"{name}/{found.getPath().getName()}"
                mine = any(path.startswith(f"{name}/change-{_folder_name(key)}-") for key in running)
                if path.removesuffix(".counts") not in used and not mine:
                    if path.startswith("post_analytics/base-"):
                        self.spark.sql(f"DROP TABLE IF EXISTS {self._catalog_name(path)}")  # the entry, not the files
                    system.delete(found.getPath(), True)
        for number in range(1, last - versions + 1):
            self._delete(f"{self.root}/_current/{number:010d}")
