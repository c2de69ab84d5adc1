"""A keyed target as a log of changes, resolved when it is read.

A batch is appended as it comes, one Parquet folder that is written once and without a shuffle; a row in the table of commits makes it
count. Reading takes the latest change of each key. ``compact`` folds the log into a base with one row for each key; it runs by
itself when the log has grown to a share of the base, so the work on a row is bounded however many batches come. Where the log is small
beside the base the planner broadcasts it, and the base is read without a shuffle.

Rows carry ``_op``, ``_ts``, ``_seq`` of their change; deleted keys stay as such rows, hidden by the reader, so that an older
change that comes late cannot revive them. Whoever has a table format with merges of its own gives ``plans.run`` an object with
the methods ``manifest``, ``columns``, ``read``, ``apply``, ``alter``, ``forget`` and ``drop`` in place of this one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.changes import checked, latest
from ..operators.schema import evolve

ORDER = ["_ts", "_seq"]
_META = T.StructType([T.StructField("_op", T.StringType()), T.StructField("_ts", T.TimestampType()), T.StructField("_seq", T.LongType()), T.StructField("_commit", T.LongType())])
_COMMITS = "version bigint, kind string, batch string, stream string, number bigint, folder string, rows bigint, high_ts timestamp, high_seq bigint, schema string, checkpoint string, carried string"


class Target:
    """A target at ``path`` on any Hadoop filesystem, for one writer at a time.

    ``buckets``: how many files the base is written to, by key (unset: as the shuffle gives them). ``remember``: of batches that are named, so
    many of the last are known again; of streams every number up to the last is. ``share``: the log is folded when it has more
    rows than this share of the base and than ``least`` rows, or ``many`` batches.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int | None = None, remember: int = 1000, share: float = 0.5, least: int = 1_000_000, many: int = 200) -> None:
        self.spark, self.path, self.keys, self.buckets, self.remember, self.share, self.least, self.many = spark, path.rstrip("/"), keys, buckets, remember, share, least, many
        self._hadoop = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._hadoop(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    # --- commits ---------------------------------------------------------------------------------

    def _numbers(self) -> list[int]:
        """The numbers of the commits, begun ones included."""
        at = self._hadoop(f"{self.path}/commits")
        return [int(s.getPath().getName()) for s in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def _commits(self) -> DataFrame:
        return self.spark.read.schema(_COMMITS).parquet(f"{self.path}/commits/*")

    def manifest(self) -> dict[str, Any]:
        """What the commits since the last base add up to; of a target that isn't there yet, nothing."""
        numbers = self._numbers()
        rows = sorted(self._commits().collect(), key=lambda r: r.version) if numbers else []
        last = max((r.version for r in rows if r.kind == "base"), default=0)
        state: dict[str, Any] = {"version": 0, "schema": None, "keys": self.keys, "base": None, "log": [], "files": [], "batches": [], "streams": {}, "checkpoint": {}, "high": None, "next": max(numbers, default=0) + 1}
        for r in rows:
            if r.version < last:
                continue
            carried = json.loads(r.carried) if r.carried else {}
            if r.kind == "base":
                state.update(base=r, checkpoint=carried["checkpoint"], batches=carried["batches"], streams=carried["streams"])
            state["log"].append(r)
            state["version"], state["schema"], state["keys"] = r.version, r.schema or state["schema"], carried.get("keys", state["keys"])
            if r.stream:
                state["streams"][r.stream] = max(r.number, state["streams"].get(r.stream, -1))
            elif r.batch is not None:
                state["batches"] = [*state["batches"], r.batch][-self.remember :]
            for k, v in json.loads(r.checkpoint or "{}").items():
                state["checkpoint"].pop(k, None)
                if v is not None:
                    state["checkpoint"][k] = v
            if r.high_seq is not None:
                state["high"] = max(state["high"] or (None, None), (r.high_ts, r.high_seq), key=lambda x: (x[0] is not None, x[0], x[1] is not None, x[1]))
        state["files"] = [r.folder for r in state["log"] if r.folder]
        if [k.lower() for k in state["keys"]] != [k.lower() for k in self.keys]:
            raise ValueError(f"the target's key is {state['keys']}, not {self.keys}")
        return state

    def _commit(self, state: dict[str, Any], kind: str = "state", **values: Any) -> None:
        """One row in a folder of its number, whose file appears whole or not at all. Fails if another writer has taken the number."""
        state["version"], state["next"] = state["next"], state["next"] + 1
        row = {"version": state["version"], "kind": kind, "schema": state["schema"]} | values
        row["carried"] = json.dumps({"keys": self.keys} | row.get("carried", {}))
        schema = T._parse_datatype_string(_COMMITS)
        one = self.spark.range(0, 1, 1, 1).select(*[F.lit(row.get(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields])
        one.write.parquet(f"{self.path}/commits/{state['version']:012d}")

    # --- reading ---------------------------------------------------------------------------------

    def _fields(self, state: dict[str, Any]) -> list[T.StructField]:
        return T.StructType.fromJson(json.loads(state["schema"])).fields if state["schema"] else []

    def columns(self) -> list[T.StructField]:
        """The fields of the target's rows; none before its first commit."""
        return self._fields(self.manifest())

    def _rows(self, state: dict[str, Any], rows: list[Any]) -> DataFrame | None:
        """The rows of some folders in the present columns.

        A folder is read by the columns of its time and taken through those that came after, so a dropped column's values don't come
        back with its name.
        """
        eras: dict[tuple[str, ...], list[str]] = {}
        for r in rows:
            later = [r.schema]
            for x in state["log"]:
                if x.version > r.version and x.schema and x.schema != later[-1]:
                    later.append(x.schema)
            eras.setdefault(tuple(later), []).append(r.folder)
        out = None
        for schemas, folders in eras.items():
            full = [T.StructType([*T.StructType.fromJson(json.loads(s)).fields, *_META.fields]) for s in schemas]
            part = self.spark.read.schema(full[0]).parquet(*folders)
            for s in full[1:]:
                part = evolve(part, s)
            out = part if out is None else out.unionByName(part)
        return out

    def _resolved(self, state: dict[str, Any]) -> DataFrame:
        """The latest change of each key, deletes included. Of changes equal in order the one delivered last counts."""
        base = self._rows(state, [state["base"]]) if state["base"] and state["base"].folder else None
        log = self._rows(state, [r for r in state["log"] if r.kind == "data" and r.folder])
        if log is None:
            return self.spark.createDataFrame([], T.StructType([*self._fields(state), *_META.fields])) if base is None else base
        last = latest(log, self.keys, [*ORDER, "_commit"])
        if base is None:
            return last
        mine, new = [F.col(f"b.`{k}`") == F.col(f"n.`{k}`") for k in self.keys], F.struct(*[f"n.{c}" for c in ORDER])
        # A base row that is newer than the change that came for its key; they are few, and tell which changes to leave out.
        newer = base.alias("b").join(last.select(*self.keys, *ORDER).alias("n"), [*mine, F.struct(*[f"b.{c}" for c in ORDER]) > new]).select(*[F.col(f"b.`{k}`").alias(k) for k in self.keys])
        last = last.join(newer, self.keys, "left_anti")
        return base.join(last.select(*self.keys), self.keys, "left_anti").select(*last.columns).unionByName(last)

    def read(self, state: dict[str, Any] | None = None) -> DataFrame:
        """The rows that are not deleted; a target without a commit has no columns."""
        state = state or self.manifest()
        if not state["schema"]:
            return self.spark.createDataFrame([], T.StructType([]))
        return self._resolved(state).where("_op <> 'D'").select(*[F.col(f"`{f.name}`") for f in self._fields(state)])

    # --- writing ---------------------------------------------------------------------------------

    def apply(self, changes: DataFrame, batch_id: str | int, checkpoint: dict[str, Any] | Callable[[], dict[str, Any]] | None = None, stream: str | None = None, empty: bool = True, fields: list[T.StructField] | None = None) -> bool:
        """Append change records (``_op``, ``_ts``, ``_seq`` and columns) and commit; False if the batch was committed before.

        ``changes`` is run once. ``checkpoint`` (called after the rows are written) and the rows are one commit; a null value takes an entry
        out. ``stream``: ``batch_id`` is a number in it, and one up to the last is known. Without ``empty`` a batch without rows
        leaves no commit. ``fields``: the target's columns from now on (unset: the present ones and new ones of the batch); they
        are committed once the rows are written. A row with a null key fails the batch.
        """
        state = self.manifest()
        if (int(batch_id) <= state["streams"].get(stream, -1)) if stream else (str(batch_id) in state["batches"]):
            return False
        data = [f for f in changes.schema.fields if f.name not in (*_META.names, "_batch")]
        old = self._fields(state)
        have = {f.name.lower() for f in old}
        fields = [*old, *[f for f in data if f.name.lower() not in have]] if fields is None else fields
        self._keyed(fields)
        rows = evolve(checked(changes, self.keys).withColumn("_commit", F.lit(state["next"]).cast("long")), T.StructType([*fields, *_META.fields]))
        seen, folder = Observation(f"commit-{uuid.uuid4().hex}"), f"{self.path}/data/{uuid.uuid4().hex}"
        rows.observe(seen, F.count(F.lit(1)).alias("n"), F.max(F.struct(*ORDER)).alias("high")).write.parquet(folder)
        n, high = seen.get["n"], seen.get["high"]
        if not n:
            self._fs.delete(self._hadoop(folder), True)
        schema = T.StructType(fields).json()
        if old and schema != state["schema"]:
            state["schema"] = schema
            self._commit(state, "schema")
        if not n and not empty:
            return True
        state["schema"] = schema
        named = {"stream": stream, "number": int(batch_id)} if stream else {"batch": str(batch_id)}
        kept = (checkpoint() if callable(checkpoint) else checkpoint) or {}
        self._commit(state, "data", folder=folder if n else None, rows=n, high_ts=high["_ts"] if n else None, high_seq=high["_seq"] if n else None, checkpoint=json.dumps(kept), **named)
        log, base = [r.rows for r in state["log"] if r.kind == "data"], state["base"].rows if state["base"] else 0
        if sum(log) + n > max(self.least, self.share * base) or len(log) >= self.many:
            self.compact()
        return True

    def _keyed(self, fields: list[T.StructField]) -> None:
        if not {k.lower() for k in self.keys} <= {f.name.lower() for f in fields}:
            raise ValueError("the key's columns must stay")

    def compact(self) -> None:
        """Fold the log into the base, in one commit; what the target says stays the same."""
        state = self.manifest()
        if not state["schema"]:
            return
        folder, seen = f"{self.path}/data/{uuid.uuid4().hex}", Observation(f"base-{uuid.uuid4().hex}")
        rows = self._resolved(state)
        rows = rows.repartition(self.buckets, *[F.col(f"`{k}`") for k in self.keys]) if self.buckets else rows
        rows.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(folder)
        high = state["high"] or (None, None)
        self._commit(state, "base", folder=folder, rows=seen.get["n"], high_ts=high[0], high_seq=high[1], carried={k: state[k] for k in ("checkpoint", "batches", "streams")})
        self._forget_commits(state["base"].version if state["base"] else 0)  # of the base before: their number stays bounded

    def streamed(self, stream: str, after: int) -> int:
        """The rows that a stream brought in commits after a version."""
        rows = self._commits().where((F.col("stream") == stream) & (F.col("version") > after))
        return rows.agg(F.sum("rows")).first()[0] or 0

    def alter(self, fields: list[T.StructField]) -> None:
        """Give the target these columns in this order, in one commit; rows are not written anew. The key must stay. Before the first commit nothing happens."""
        state = self.manifest()
        if not state["schema"]:
            return
        self._keyed(fields)
        state["schema"] = T.StructType([*fields]).json()
        self._commit(state, "schema")

    def forget(self, *names: str) -> None:
        """Take values out of the checkpoint (all, if none is named), so that the object is read from the start again."""
        state = self.manifest()
        self._commit(state, "state", checkpoint=json.dumps({k: None for k in state["checkpoint"] if not names or k in names}))

    def drop(self) -> None:
        """Delete the target with all its versions."""
        self._fs.delete(self._hadoop(self.path), True)

    def vacuum(self) -> int:
        """Delete folders and commits that the present version doesn't need; only when no writer or reader of an older one runs. Returns the folders."""
        state = self.manifest()
        used = {p.rsplit("/", 1)[-1] for p in state["files"]}
        folder, gone = self._hadoop(f"{self.path}/data"), 0
        for s in self._fs.listStatus(folder) if self._fs.exists(folder) else []:
            if s.getPath().getName() not in used:
                self._fs.delete(s.getPath(), True)
                gone += 1
        self._forget_commits(state["base"].version if state["base"] else 0)
        return gone

    def _forget_commits(self, before: int) -> None:
        for number in self._numbers():
            if number < before:
                self._fs.delete(self._hadoop(f"{self.path}/commits/{number:012d}"), True)
