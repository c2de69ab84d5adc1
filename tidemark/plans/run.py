"""Runs over many objects: follow the source's objects and columns, read increments, files, snapshots or logs, synchronise deletes.

What a read brings is written once into the target's log, with its records and maxima counted on the way (``observe``). So a live
source is read once, and rows, deletes and checkpoint are one commit.

Every change has a place in one order, (``_ts``, ``_seq``): events of a stream bring theirs, rows of a file its time, rows of a table the number of
their commit, rows of a snapshot before a log the position of the log. A delete synchronisation takes the place right behind the greatest one that the
target held when the source's keys were read: it wins against all that was there, and whatever comes later wins against it.
"""

from __future__ import annotations

import dataclasses
import datetime
import decimal
import threading
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import any_of
from ..operators import changes as log
from ..operators import increment, reports, state
from ..operators.merge import delete_missing
from ..sources import Files, catalog, document_value, parsed
from ..streaming import LogSource, apply_stream, stream_id
from .store import Target

LOG_SCHEMA = "run_id string, object string, read_type string, action string, start_ts timestamp, end_ts timestamp, records bigint, status string, status_description string, keys map<string,string>, ddls array<string>, object_reload int, schema_reload int, commit_id bigint"
_EPOCH = datetime.datetime(1970, 1, 1)
#: Groups of files whose names the driver is told of at a time.
_AHEAD = 100


@dataclass(frozen=True)
class ObjectSpec:
    """One object: its columns, unique key, incremental keys with their first values, masks and conditions.

    The unique key's columns must not be null: a row with a null key fails the object's read, and the log names the column.

    ``conditions`` are the object's partitions: each has checkpoints of its own, told by its text.
    ``kind``: "table"; "csv" (of ``sources.csv_files``, or ``sources.csv``, whose new files are opened twice: an incremental one has ``incremental={"_file_time": first}``; files are read
    once each, oldest first, ``files`` of them for a commit, and of rows with one key that of the later file counts); "documents" (of
    ``sources.json_documents``, whose key is ``_id``: incremental keys are fields of the document, compared as their first
    values are: whole numbers and decimals exactly, floats, or times); "log" (a ``streaming.LogSource``: a snapshot once, then the log from the
    position before it). ``follow``: the target gets the source's columns as they come, change and go. ``compute_max``, ``limit``, ``convert``:
    see ``increment.read``. ``masker``: another mask than the standard one.
    """

    name: str
    unique_key: list[str]
    columns: list[str] | None = None
    incremental: dict[str, Any] = field(default_factory=dict)
    conditions: list[str] | None = None
    masked: list[str] = field(default_factory=list)
    delete_condition: str | None = None
    group: str = "default"
    position: int = 1
    include_nulls: bool = False
    enabled: bool = True
    kind: str = "table"
    follow: bool = True
    compute_max: bool = True
    limit: int | None = None
    convert: str | None = None
    masker: Callable[[Column], Column] | None = None
    files: int = 1000


def _plain(v: Any) -> Any:
    return v.isoformat() if isinstance(v, (datetime.datetime, datetime.date)) else str(v) if isinstance(v, decimal.Decimal) else v


def _typed(v: Any, like: Any) -> Any:
    if isinstance(like, datetime.datetime):
        return datetime.datetime.fromisoformat(v)
    if isinstance(like, decimal.Decimal) or (isinstance(v, str) and isinstance(like, int)):
        return decimal.Decimal(v)
    return datetime.date.fromisoformat(v) if isinstance(like, datetime.date) else v


def _rows(source: DataFrame | Files) -> DataFrame:
    return source.rows if isinstance(source, Files) else source


def _within(spec: ObjectSpec, source: DataFrame) -> DataFrame:
    return source.where(any_of([F.expr(c) for c in spec.conditions])) if spec.conditions else source


def _keyed(spec: ObjectSpec, source: DataFrame) -> tuple[DataFrame, dict[str, Any], dict[str, str]]:
    """The source with its incremental keys as columns, their first values, and the name of each in the checkpoint."""
    if spec.kind != "documents" or not spec.incremental:
        return source, spec.incremental, {k: k for k in spec.incremental}
    names = {f"document_key_{i}": k for i, k in enumerate(spec.incremental)}
    first = {c: decimal.Decimal(v) if isinstance(v := spec.incremental[k], int) else v for c, k in names.items()}
    # Made by a generator of one row, through which no filter is pushed: each document is parsed once.
    source = source.select("*", F.explode(F.array(parsed("document"))).alias("document_variant"))
    return source.withColumns({c: document_value("document_variant", k, first[c]) for c, k in names.items()}), first, names


def _changed(target: Target, records: DataFrame) -> tuple[list[T.StructField] | None, list[str]]:
    """The columns that a target is to have to follow these change records, and the statements that say what changed. A new target needs neither."""
    old = {f.name.lower(): f for f in target.columns()}
    if not old:
        return None, []
    fields = [f for f in records.schema.fields if f.name not in ("_op", "_ts", "_seq", "_batch")]
    now = {f.name.lower(): f for f in fields}
    out = [f"ALTER COLUMN {f.name} {f.dataType.simpleString()}" if k in old else f"ADD COLUMN {f.name} {f.dataType.simpleString()}" for k, f in now.items() if k not in old or old[k].dataType != f.dataType]
    out += [f"DROP COLUMN {f.name}" for k, f in old.items() if k not in now]
    return (fields if out or [*old] != [*now] else None), out


def follow(target: Target, records: DataFrame) -> list[str]:
    """Give the target the columns of the change records; the statements that say what changed. A new target needs none."""
    fields, said = _changed(target, records)
    if fields:
        target.alter(fields)
    return said


def _land(target: Target, rows: DataFrame, values: dict[str, Column], made: Callable[[DataFrame], DataFrame], batch: str, checkpoint: Callable[[dict[str, Any]], dict[str, Any]], fields: list[T.StructField] | None = None, empty: bool = False) -> int:
    """Append the change records ``made`` from ``rows`` and commit; the number of records. ``values``: greatest values to be seen on the way.

    The checkpoint in the commit tells what was read, so every read is a batch of its own, also where the name of a run comes again.
    """
    name = uuid.uuid4().hex
    rows, seen = increment.observed(rows, [], f"read-{name}", values)
    target.apply(made(rows), f"{batch}/{name}", lambda: checkpoint(seen.get), empty=empty, fields=fields)
    return seen.get["records"]


def _records(spec: ObjectSpec, source: DataFrame, helpers: set[str], run_id: str, op: Column, ts: Column, seq: Column) -> Callable[[DataFrame], DataFrame]:
    """Rows of the source as change records of the object's columns, masked."""
    there = {c.lower() for c in source.columns}
    columns = [c for c in (spec.columns or source.columns) if c not in helpers and c.lower() in there]
    hidden = [m.lower() for m in spec.masked] if spec.kind != "documents" else []

    def made(df: DataFrame) -> DataFrame:
        if spec.kind == "documents" and spec.masked:
            df = log.mask_document(df, "document", spec.masked, masker=spec.masker)
        plain = df.select(op.alias("_op"), ts.cast("timestamp").alias("_ts"), seq.cast("long").alias("_seq"), F.lit(run_id).alias("_batch"), *[F.col(f"`{c}`") for c in columns])
        return log.mask(plain, hidden, masker=spec.masker)

    return made


def read_object(spec: ObjectSpec, source: Any, target: Target, run_id: str) -> dict[str, Any]:
    """One read: what lies beyond the checkpoint or, once, everything. Rows, deletes and checkpoint are one commit (of files: one for each group).

    Where the set of incremental keys is another than the checkpoint's, reading starts again. Rows with a null key
    (``include_nulls``) come with every read that finds something new, and by themselves once.
    """
    if spec.kind == "log":
        return _read_log(spec, source, target, run_id)
    listing = source.listing if isinstance(source, Files) else None
    source, first, names = _keyed(spec, _rows(source))
    saved = target.manifest()["checkpoint"]
    parts: dict[str, dict[str, Any]] = saved.get("_parts") or {}
    before = {k for k in saved if not k.startswith("_")} | {k for p in parts.values() for k in p}
    if spec.kind == "csv" and first:
        before -= {"_file_time"}
    if (before and before != {*names.values()}) or (first and saved.get("_snapshot_done")):
        target.forget()
        saved, parts = {}, {}
    # A soft-deleted row arrives as a delete of its key.
    op = F.when(F.coalesce(F.expr(spec.delete_condition), F.lit(False)), "D").otherwise("I") if spec.delete_condition and first else F.lit("I")
    helpers = {*([] if spec.kind == "table" else ["_file_time", "_file", "document_variant"]), *(c for c in names if c != names[c])}
    if spec.kind == "csv" and first:
        return _read_files(spec, source, listing, target, run_id, op, helpers, first["_file_time"], saved)
    ts = F.col("_file_time") if spec.kind == "csv" and "_file_time" in source.columns else F.lit(_EPOCH)
    made = _records(spec, source, helpers, run_id, op, ts, F.lit(target.manifest()["version"] + 1))
    # The values that hold before the read, by condition; without conditions the one without a text.
    lower = {c: {k: _typed(p[names[k]], v) if names[k] in p else v for k, v in first.items()} for c in (spec.conditions or [""]) for p in [parts.get(c, {}) if c else saved]}
    upper: dict[str, dict[str, Any]] = {}
    if not first:
        rows = source.where(F.lit(False)) if saved.get("_snapshot_done") else _within(spec, source)
    elif spec.conditions:
        rows, upper = increment.read_parts(source, lower, spec.include_nulls, spec.compute_max, spec.limit, spec.convert)
    else:
        rows, upper[""] = increment.read(source, lower[""], None, spec.include_nulls, spec.compute_max, spec.limit, spec.convert)
    if first and spec.include_nulls and saved.get("_nulls_read") and spec.compute_max and upper == lower:
        rows = rows.where(F.lit(False))
    watched = {} if spec.compute_max else {(c, k): f"max_{i}_{j}" for i, c in enumerate(upper) for j, k in enumerate(first)}
    fields, ddls = _changed(target, made(rows)) if spec.follow else (None, [])

    def checkpoint(got: dict[str, Any]) -> dict[str, Any]:
        if not first:
            return {"_snapshot_done": True}
        for (c, k), name in watched.items():
            if got[name] is not None:
                upper[c][k] = max(got[name], upper[c][k])
        now = {c: {names[k]: _plain(v) for k, v in values.items()} for c, values in upper.items()}
        return (now[""] if not spec.conditions else {"_parts": now}) | ({"_nulls_read": True} if spec.include_nulls else {})

    values = {name: F.when(F.expr(c), F.col(k)) if c else F.col(k) for (c, k), name in watched.items()}
    n = _land(target, rows, values, made, f"{run_id}/{spec.name}", checkpoint, fields)
    keys = {(f"{names[k]} where {c}" if c else names[k]): str(v) for c, values in upper.items() for k, v in values.items()}
    return {"records": n, "keys": keys, "ddls": ddls}


def _read_files(spec: ObjectSpec, source: DataFrame, listing: DataFrame | None, target: Target, run_id: str, op: Column, helpers: set[str], first: Any, saved: dict[str, Any]) -> dict[str, Any]:
    """The files beyond the frontier, group by group, oldest first; each group is one commit.

    The frontier is a time and the files of that very time that were read: others of it are still to come. With a listing only new files are
    opened, each once; without one they are opened to be told as well. Their names come to the driver some groups at a time.
    """
    last = _typed(saved["_file_time"], first) if "_file_time" in saved else first
    known = set(saved.get("_files", []))
    listed = source.select("_file_time", "_file").distinct() if listing is None else listing.select(F.col("modified").alias("_file_time"), F.col("path").alias("_file"))
    total, ddls, most = 0, [], spec.files * _AHEAD
    while True:
        done = target.spark.createDataFrame([(x,) for x in known], "_file string")
        # Before anything of the first time was read, only later files count.
        beyond = F.col("_file_time") >= increment.literal(last) if known else F.col("_file_time") > increment.literal(last)
        new = listed.where(beyond).join(done, "_file", "left_anti").orderBy("_file_time", "_file").limit(most).collect()
        for i in range(0, len(new), spec.files):
            group = new[i : i + spec.files]
            top = group[-1]._file_time
            known = {r._file for r in group if r._file_time == top} | (known if top == last else set())
            last = top
            made = _records(spec, source, helpers, run_id, op, F.col("_file_time"), F.lit(target.manifest()["version"] + 1))
            rows = _within(spec, source.where(F.col("_file").isin([r._file for r in group])))
            fields, said = _changed(target, made(rows)) if spec.follow else (None, [])
            now = {"_file_time": _plain(last), "_files": sorted(known)}
            total += _land(target, rows, {}, made, f"{run_id}/{spec.name}", lambda got, now=now: now, fields, empty=True)
            ddls += said
        if len(new) < most:
            return {"records": total, "keys": {"_file_time": str(last)}, "ddls": ddls}


def _read_log(spec: ObjectSpec, source: LogSource, target: Target, run_id: str) -> dict[str, Any]:
    """The snapshot, once, with the log's position before it in the same commit; then the log from there, as far as it goes now.

    After a crash between the two the stream starts from the position that was kept; later on it goes on where its own checkpoint is.
    """
    n, saved = 0, target.manifest()["checkpoint"]
    if not saved.get("_snapshot_done"):
        at = source.position()
        rows = _within(spec, source.snapshot)
        made = _records(spec, rows, set(), run_id, F.lit("I"), F.lit(at or _EPOCH), F.lit(-1))
        n = _land(target, rows, {}, made, f"{run_id}/{spec.name}", lambda got: {"_snapshot_done": True, "_log_start": _plain(at)}, empty=True)
        saved = target.manifest()["checkpoint"]
    start = saved.get("_log_start")
    changes = source.changes(datetime.datetime.fromisoformat(start) if start else None)
    if spec.columns:
        changes = changes.select("_op", "_ts", "_seq", *[F.col(f"`{c}`") for c in spec.columns])
    if spec.masked:
        changes = log.mask(changes, spec.masked, masker=spec.masker)
    at, before = f"{target.path}/stream", target.manifest()["version"]
    apply_stream(changes, target, at, name=spec.name).awaitTermination()
    n += target.streamed(f"{spec.name}/{stream_id(target.spark, at)}", before)
    high = target.manifest()["high"]
    return {"records": n, "keys": {"_ts": str(high[0])} if high and high[0] else {}}


def delete_sync_object(spec: ObjectSpec, source: Any, target: Target, run_id: str) -> dict[str, Any]:
    """Delete from the target what the source no longer holds (within the object's conditions); an empty source deletes nothing.

    The deletes' place in the order is right behind the target's greatest one when the keys are read.
    """
    if not spec.unique_key or not target.columns():
        return {"records": 0, "keys": {}}
    ts, seq = target.manifest()["high"] or (None, 0)
    keys = _within(spec, source.snapshot if isinstance(source, LogSource) else _rows(source))
    _, gone = delete_missing(target.read(), keys, spec.unique_key)
    place = F.lit(ts).cast("timestamp"), F.lit((seq or 0) + 1)
    n = _land(target, gone, {}, lambda df: log.emit(df, "D", run_id, *place), f"{run_id}/{spec.name}/deletes", lambda got: {})
    return {"records": n, "keys": {}}


def checkpoints(spark: SparkSession, targets: dict[str, Target]) -> DataFrame:
    """(object, part, col, value) of the checkpoints of named targets; ``part`` is the condition, empty where there is none."""
    rows = []
    for name, target in targets.items():
        saved = target.manifest()["checkpoint"]
        plain = {k: v for k, v in saved.items() if not k.startswith("_") or k == "_file_time"}
        rows += [(name, part, k, str(v)) for part, values in {"": plain, **(saved.get("_parts") or {})}.items() for k, v in values.items()]
    return spark.createDataFrame(rows, "object string, part string, col string, value string")


def log_positions(spark: SparkSession, targets: dict[str, Target]) -> DataFrame:
    """(object, token, ts) of named targets that follow a log: the number of the last micro-batch and the greatest time that was applied."""
    rows = []
    for name, target in targets.items():
        now = target.manifest()
        if "_log_start" in now["checkpoint"] or now["streams"]:
            rows.append((name, max(now["streams"].values(), default=None), now["high"][0] if now["high"] else None))
    return spark.createDataFrame(rows, "object string, token bigint, ts timestamp")


def failed(spark: SparkSession, log_path: str) -> list[str]:
    """The objects whose latest row of the log is an error, for ``only`` of the next run: one name for each."""
    rows = reports.failed_objects(spark.read.schema(LOG_SCHEMA).parquet(log_path), order="start_ts")
    return sorted(r.object for r in rows.select("object").collect())


def reset_job(spark: SparkSession, targets: list[Target], log_path: str | None = None) -> None:
    """Delete targets with their checkpoints and, if it is named, the run log; specs and flags are the caller's and stay."""
    for t in targets:
        t.drop()
    if log_path:
        at = spark._jvm.org.apache.hadoop.fs.Path(log_path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def run(spark: SparkSession, specs: list[ObjectSpec], source: Callable[[str], Any], targets: Callable[[ObjectSpec], Target], log_path: str, work: Callable[..., dict[str, Any]] = read_object, run_id: str | None = None, only: list[str] | None = None, listing: DataFrame | None = None, adopt: Callable[[str], ObjectSpec] | None = None, drop: bool = False, flags: DataFrame | None = None, threads: int = 8) -> DataFrame:
    """All enabled objects, in each group in order of position; the first failure of a group ends it. Returns this run's log rows.

    Groups run side by side, ``threads`` of them, each in a scheduler pool of its name (fair where ``spark.scheduler.mode`` is) and with
    ``<run_id>/<group>`` as its job tag, by which its jobs can be cancelled.

    ``only``: these objects (``failed`` tells those to be read again). ``listing`` (object_name): what the source holds now.
    Objects it doesn't hold are not read, and with ``drop`` their targets are deleted; new ones are read as ``adopt`` says, such as
    a whole snapshot. ``flags``: reload flags as of ``state.reload_plan``; a reloaded object is read from the start, and one with a
    reloaded schema takes over the source's columns even if it doesn't follow them; ``state.next_flags`` gives those
    for the next start. Names and flags are one row for each object.
    """
    run_id = run_id or uuid.uuid4().hex
    rows: list[tuple] = []
    specs = [s for s in specs if s.enabled]

    def noted(spec: ObjectSpec, began: datetime.datetime, action: str, status: str, said: str, done: dict[str, Any], reload: tuple[bool, bool] = (False, False), commit: int | None = None) -> None:
        kind = "SNAPSHOT + LOG_BASED" if spec.kind == "log" else "INCREMENTAL" if spec.incremental else "SNAPSHOT"
        rows.append((run_id, spec.name, kind, action, began, datetime.datetime.now(), done["records"], status, said, done["keys"], done.get("ddls", []), int(reload[1]), int(reload[0]), commit))

    if listing is not None:
        known = spark.createDataFrame([(s.name,) for s in specs], "object_name string")
        gone = {r.object_name for r in catalog.dropped_objects(listing, known).collect()}
        for spec in (s for s in specs if s.name in gone):
            began, status, said = datetime.datetime.now(), "SUCCESS", f"DROP TABLE IF EXISTS {spec.name}" if drop else "no longer in the source"
            try:
                if drop:
                    targets(spec).drop()
            except Exception as e:  # as below: a row of the log, and the next run tries again
                status, said = "ERROR", str(e).splitlines()[0][:500]
            noted(spec, began, "DROP", status, said, {"records": 0, "keys": {}})
        specs = [s for s in specs if s.name not in gone]
        if adopt:
            specs += [adopt(r.object_name) for r in catalog.new_objects(listing, known).orderBy("object_name").collect()]
    if only is not None:
        specs = [s for s in specs if s.name in set(only)]
    reloads: dict[str, tuple[bool, bool]] = {}
    if flags is not None:
        names = spark.createDataFrame([(s.name,) for s in specs], "object string")
        reloads = {r.object: (r.reload_schema, r.reload_object) for r in state.reload_plan(names, flags).collect()}
    action = "DELETE_SYNC" if work is delete_sync_object else "READ"
    guard = threading.Lock()

    def target_of(spec: ObjectSpec) -> Target:
        with guard:
            return targets(spec)

    def one(spec: ObjectSpec) -> bool:
        began, status, said, done, commit = datetime.datetime.now(), "SUCCESS", "", {"records": 0, "keys": {}}, None
        reload = reloads.get(spec.name, (False, False))
        try:
            target = target_of(spec)
            if reload[1]:
                target.forget()
            done = work(dataclasses.replace(spec, follow=True) if any(reload) else spec, source(spec.name), target, run_id)
            said, commit = "" if done["records"] else "no data found", target.manifest()["version"]
        except Exception as e:  # the failure is a row of the log; the next run starts from the old checkpoint
            status, said = "ERROR", (str(e).splitlines() or [type(e).__name__])[0][:500]
        with guard:
            noted(spec, began, action, status, said, done, reload, commit)
        return status == "SUCCESS"

    def group(members: list[ObjectSpec]) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", members[0].group)
        spark.addTag(f"{run_id}/{members[0].group}")
        try:
            all(one(spec) for spec in sorted(members, key=lambda s: s.position))  # up to the first failure
        finally:
            spark.removeTag(f"{run_id}/{members[0].group}")
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    groups: dict[str, list[ObjectSpec]] = {}
    for spec in specs:
        groups.setdefault(spec.group, []).append(spec)
    if groups:
        with ThreadPoolExecutor(max(1, min(threads, len(groups)))) as pool:
            for running in [pool.submit(inheritable_thread_target(spark)(group), members) for _, members in sorted(groups.items())]:
                running.result()
    place = {s.name: (s.group, s.position) for s in specs}
    rows.sort(key=lambda r: (r[3] != "DROP", place.get(r[1], ("", 0))))
    out = spark.createDataFrame(rows, LOG_SCHEMA)
    out.write.mode("append").parquet(log_path)
    return out
