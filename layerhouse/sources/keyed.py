"""Tables whose rows are known by key while the day they are stored under may change.

Beside such a table stands an index of its keys: per load the keys it wrote and their day, bucketed by a hash
of the key, so the look-up of a load's keys shuffles only the load.  The index names the days where keys of a
load are stored, and they reach the scan as literals: only those partitions are read, and a row that comes
again leaves the day it was under.  There, files that hold no key of the load stay; files that hold nothing
else go unread; only files that hold both are written anew without the rows that come again.

A load is committed in one step.  Everything it changes is staged first, in the layout of the table, and
counted; then one small manifest is put in place by a rename.  Before that the load has not happened; from then
on it has, and ``recover`` (run by every load and every ``read``) carries out what is left, as often as it
takes: the keys enter the index, the staged files move to their days, the files they replace are removed.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from layerhouse.functions.times import OPEN_END
from layerhouse.session import written
from layerhouse.sources import tables

#: Most days that are put into a scan as literals; beyond it the days are joined.
LITERAL_DAYS = 10_000

#: Buckets of a key index, and loads after which it is rewritten with one entry per key.
BUCKETS, KEPT_LOADS = 32, 64

#: Most days whose rows each task may write to files of its own; and files that are moved at a time.
FEW_DAYS, MOVERS = 4, 16

#: Rows of the files that are passed through together: their bits take some 50 MB in every task's executor.
PASS_ROWS = 32_000_000

#: The folder value of rows without a day.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def _parts(many: int) -> list[str]:
    """Folders of a staged load: the new rows and what is kept beside them."""
    return ["rows", *(f"kept{n}" for n in range(1, many))]


def _in_order(days: Iterable[dt.date | None]) -> list[dt.date | None]:
    return sorted(days, key=lambda d: (d is None, d or dt.date.min))


class Keyed:
    """A partitioned table with a key index and staged commits.  One load of a table runs at a time."""

    def __init__(self, spark: SparkSession, table: str, keys: Sequence[str], column: str = "dt", buckets: int = BUCKETS):
        self.spark, self.table, self.keys, self.column = spark, table, list(keys), column
        self.index, self.buckets = f"{table}__keys", buckets

    # ------------------------------------------------------------ folders

    def location(self) -> str:
        return self._told["Location"]

    @property
    def _format(self) -> str:
        return self._told["Provider"]

    @cached_property
    def _told(self) -> dict[str, str]:
        """Folder and format of the table."""
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.table}").where("col_name IN ('Location', 'Provider')").collect()
        return {r["col_name"]: r["data_type"] for r in rows}

    def _folder(self, day: dt.date | None) -> str:
        return f"{self.column}={day or NO_DAY}"

    def _listed(self, path) -> list[str]:
        """Names in a folder; none where it is missing."""
        files = self._files(path)
        if not files.exists(path):
            return []
        return sorted(n for n in (s.getPath().getName() for s in files.listStatus(path)) if n[0] not in "._")

    def _read(self, paths: Sequence[str], base: str = "") -> DataFrame:
        """Files in the layout of the table."""
        return self.spark.read.format(self._format).schema(self.spark.table(self.table).schema).option("basePath", base or self.location()).load(list(paths))

    def _path(self, name: str = ""):
        return self._at(f"_loads{name}")

    def _at(self, name: str):
        """A path below the table."""
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.location()}/{name}")

    def _files(self, path):
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _manifests(self) -> list[str]:
        path = self._path()
        files = self._files(path)
        if not files.exists(path):
            return []
        names = [s.getPath().getName() for s in files.listStatus(path)]
        return sorted((n for n in names if n.endswith(".json")), key=lambda n: int(n.split(".")[0]))

    # ------------------------------------------------------------ the index

    def _entry(self, df: DataFrame) -> DataFrame:
        """Hash, keys and day of rows."""
        return df.select(F.xxhash64(*self.keys).alias("key_hash"), *self.keys, F.col(self.column).cast("date").alias("day"))

    def _ensure_index(self) -> None:
        """Create the index; a table that already has rows enters it as load 0."""
        if self.spark.catalog.tableExists(self.index):
            return
        kinds = self.spark.table(self.table).schema
        columns = ", ".join(f"`{k}` {kinds[k].dataType.simpleString()}" for k in self.keys)
        self.spark.sql(
            f"CREATE TABLE {self.index} (key_hash BIGINT, {columns}, day DATE, load BIGINT) USING parquet PARTITIONED BY (load) "
            f"CLUSTERED BY (key_hash) INTO {self.buckets} BUCKETS")
        stored = self.spark.table(self.table)
        if stored.take(1):
            self._append(self._entry(stored), 0)

    def _append(self, entries: DataFrame, load: int) -> None:
        """Write one load's entries; writing them again replaces them."""
        key_hash = F.xxhash64(*self.keys)  # not carried through the shuffle
        rows = entries.select(*self.keys, "day").repartition(self.buckets, key_hash).select(
            key_hash.alias("key_hash"), "*", F.lit(load).cast("long").alias("load"))
        tables.overwrite_partitions(rows, self.index)

    def _loads(self) -> list[int]:
        return sorted(int(r[0].split("=")[1]) for r in self.spark.sql(f"SHOW PARTITIONS {self.index}").collect())

    def _same(self, one: DataFrame, other: DataFrame) -> Column:
        """Equal keys, nulls included.  Only the hash is a join key, as the index is bucketed by it alone."""
        return (one["key_hash"] == other["key_hash"]) & self._agree(one, other)

    def _agree(self, one: DataFrame, other: DataFrame) -> Column:
        out = F.lit(True)
        for k in self.keys:
            out = out & ~F.coalesce(one[k] != other[k], one[k].isNull() != other[k].isNull())
        return out

    def _last(self, entries: DataFrame) -> DataFrame:
        """Keys with the days their last load put them under."""
        key = ["key_hash", *self.keys]
        # ranked, not gathered in sets: a bucket is sorted once, and a key's entries may spill
        newest = F.rank().over(Window.partitionBy(*key).orderBy(F.col("load").desc()))
        return entries.select(*key, "load", "day").withColumn("__rank", newest).where("__rank = 1").select(*key, "day").distinct()

    def latest(self) -> DataFrame:
        """The days each key is stored under: the entries of its last load."""
        return self._last(self.spark.table(self.index))

    def compact(self) -> None:
        """Keep one entry per key.  The new entries are complete before the old ones go, and an old entry loses to a new one."""
        loads = self._loads()
        self._append(written(self.latest()), loads[-1] + 1)
        old = ", ".join(f"PARTITION (load = {n})" for n in loads)
        self.spark.sql(f"ALTER TABLE {self.index} DROP IF EXISTS {old}")

    # ------------------------------------------------------------ reading

    def read(self) -> DataFrame:
        """The table after every committed load."""
        self.recover()
        return self.spark.table(self.table)

    def days_of(self, fresh: DataFrame) -> list[dt.date | None]:
        """The days of some rows and the days their keys are stored under now."""
        return _in_order({*self._days(fresh), *self._known(fresh)})

    def _days(self, rows: DataFrame) -> list[dt.date | None]:
        return _in_order(r[0] for r in rows.select(F.col(self.column).cast("date")).distinct().collect())  # one row per calendar day

    def _known(self, fresh: DataFrame) -> list[dt.date | None]:
        """The days the keys of some rows are stored under now."""
        entries = self.spark.table(self.index)
        met = self._entry(fresh).select("key_hash", *self.keys)
        known = self._last(entries.join(met, self._same(entries, met), "left_semi"))
        return _in_order(r["day"] for r in known.select("day").distinct().collect())

    def on(self, days: Sequence[dt.date | None]) -> DataFrame:
        """The stored rows of some days, read from their partitions alone."""
        stored = self.spark.table(self.table)
        kind, dated = stored.schema[self.column].dataType, [d for d in days if d is not None]
        if len(dated) <= LITERAL_DAYS:
            literals = ", ".join(f"CAST('{d}' AS {kind.simpleString()})" for d in dated) or "NULL"
            return stored.where(f"`{self.column}` IN ({literals})" + (f" OR `{self.column}` IS NULL" if len(dated) < len(days) else ""))
        wanted = self.spark.createDataFrame([(d,) for d in days], "d date").select(F.col("d").cast(kind))
        return stored.join(wanted, stored[self.column].eqNullSafe(wanted["d"]), "left_semi")

    # ------------------------------------------------------------ loading

    def merge(self, df: DataFrame, durable: bool = False, spread: bool | None = None) -> int:
        """Store rows under their days, in place of the rows of the same keys wherever those are; returns the rows written.

        Null keys are equal.  Without rows nothing is written.  A repeated merge changes nothing.  ``durable`` says
        that ``df`` reads stored files, so it is not written once more before it is read several times.  ``spread``
        says whether the rows are of many days; where that is known, they are staged at once and read from there.
        """
        self.recover()
        self._ensure_index()
        fresh, number = tables.align_to(df, self.spark.table(self.table).schema), self._begin()
        if spread is None:
            fresh = fresh if durable else written(fresh)
            days = self._days(fresh)
            if not days:
                return 0
            staged, rows = None, 0
        else:
            staged, rows = self._stage(number, "rows", fresh, spread)
            if not rows:
                self._begin()
                return 0
            fresh, days = staged, self._days(staged)
        known = self._known(fresh) if self._loads() else []
        kept, gone = self._beside(fresh, known) if known else ([], [])
        if staged is None:
            staged, rows = self._stage(number, "rows", fresh, len(days) > FEW_DAYS)
        return self._commit(number, kept, gone, staged, rows)

    def _equal(self, one: DataFrame, other: DataFrame) -> Column:
        """As ``_same``, for sides that do not carry the hash."""
        out = F.xxhash64(*[one[k] for k in self.keys]) == F.xxhash64(*[other[k] for k in self.keys])
        return out & self._agree(one, other)

    def _beside(self, fresh: DataFrame, known: Sequence[dt.date | None]) -> tuple[list[tuple[DataFrame, list]], list[str]]:
        """What stays of the files that hold a key of the load, with its days, and the files it leaves.

        The keys alone are shuffled; they name the places of the rows that come again, one bit a row.  Files without
        such a row stay, files with nothing else are not read, and the rows of the others are passed through where
        they lie, so many files at a time that their bits (``PASS_ROWS``) go to every task.
        """
        again = fresh.select(*[F.col(k).alias(f"__{k}") for k in self.keys]).withColumnsRenamed({f"__{k}": k for k in self.keys})
        placed, file = self._format == "parquet", F.col("_metadata.file_name")
        stored = self.on(known).select(
            *self.keys, F.col(self.column).cast("date").alias("day"), F.xxhash64(file).alias("file"),
            *[F.col("_metadata.row_index").alias("row")] * placed)
        met = stored.join(again, self._equal(stored, again), "left_semi")
        word = [F.shiftright("row", 6).alias("word")] if placed else []
        bits = [F.bit_or(F.expr("shiftleft(1L, CAST(row & 63 AS INT))")).alias("bits")] if placed else []
        marks = written(met.groupBy("day", "file", *word).agg(F.count(F.lit(1)).alias("n"), *bits))
        # a row per file
        lost = {(r["day"], r["file"]): r["n"] for r in marks.groupBy("day", "file").agg(F.sum("n").alias("n")).collect()}
        held = self.on(known).groupBy(F.col(self.column).cast("date").alias("day"), file.alias("name")).count()
        found = held.withColumn("file", F.xxhash64("name")).collect()
        files = {(r["day"], r["file"]): r for r in found}
        if len(files) < len(found):
            raise RuntimeError(f"{self.table}: two files of a day have one hash")
        path = {at: f"{self._folder(at[0])}/{r['name']}" for at, r in files.items()}
        passes, size = [], 0
        for at in sorted((at for at, n in lost.items() if n < files[at]["count"]), key=str):
            if not passes or size + files[at]["count"] > PASS_ROWS:
                passes, size = [*passes, []], 0
            passes[-1].append(at)
            size += files[at]["count"]
        return [(self._kept([path[at] for at in some], marks, again, placed), sorted({d for d, _ in some}, key=str)) for some in passes], [path[at] for at in lost]

    def _kept(self, names: Sequence[str], marks: DataFrame, again: DataFrame, placed: bool) -> DataFrame:
        """The rows of some files but those that come again."""
        rows = self._read([f"{self.location()}/{n}" for n in names])
        if not placed:
            return rows.join(again, self._equal(rows, again), "left_anti")
        here = rows.select("*", F.xxhash64("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__row"))
        wanted = self.spark.createDataFrame([(n,) for n in names], "name string").select(
            F.xxhash64(F.element_at(F.split("name", "/"), -1)).alias("file"), F.element_at(F.split("name", "/"), 1).alias("folder"))
        folder = F.concat(F.lit(f"{self.column}="), F.coalesce(F.col("day").cast("string"), F.lit(NO_DAY)))
        gone = marks.withColumn("folder", folder).join(F.broadcast(wanted), ["folder", "file"], "left_semi")
        met = (here["__file"] == gone["file"]) & (F.shiftright("__row", 6) == gone["word"]) & here[self.column].cast("date").eqNullSafe(gone["day"]) & (
            gone["bits"].bitwiseAND(F.expr("shiftleft(1L, CAST(__row & 63 AS INT))")) != 0)
        return here.join(F.broadcast(gone), met, "left_anti").drop("__file", "__row")

    def commit(self, rows: DataFrame, days: Iterable[dt.date | None]) -> int:
        """Make ``rows`` the whole content of ``days``: staged, counted, then published by one manifest."""
        self._ensure_index()
        days, number = list(days), self._begin()
        staged, many = self._stage(number, "rows", rows, len(days) > FEW_DAYS)
        return self._commit(number, [], [f"{self._folder(d)}/{f}" for d in days for f in self._listed(self._at(self._folder(d)))], staged, many)

    def _begin(self) -> int:
        """The number of the next load, with nothing staged."""
        number = 1 + max([*self._loads(), *(int(n.split(".")[0]) for n in self._manifests())], default=0)
        stage = self._path(f"/{number}")
        self._files(stage).delete(stage, True)
        return number

    def _stage(self, number: int, name: str, rows: DataFrame, spread: bool) -> tuple[DataFrame, int]:
        """Write rows beside the table in its layout; returns them as they were read back, and their number."""
        seen = Observation()
        # a task writes a file for each day it meets: rows of many days are brought together first
        laid = rows.hint("rebalance", F.col(self.column)) if spread else rows
        path = f"{self._path(f'/{number}').toString()}/{name}"
        laid.observe(seen, F.count(F.lit(1)).alias("rows")).write.format(self._format).partitionBy(self.column).save(path)
        back = self._read([path], path)
        staged = back.count()
        if staged != seen.get["rows"]:
            raise OSError(f"{self.table}: {staged} of {seen.get['rows']} rows are staged; nothing is published")
        return back, staged

    def _commit(self, number: int, kept: Sequence[tuple[DataFrame, Sequence]], gone: Sequence[str], staged: DataFrame, rows: int) -> int:
        """Stage what is kept beside the new rows, which are ``staged``, and publish both in place of the files that go."""
        names = _parts(1 + len(kept))
        for name, (some, days) in zip(names[1:], kept, strict=True):
            rows += self._stage(number, name, some, len(days) > FEW_DAYS)[1]
        self._publish(number, {"gone": list(gone), "parts": len(names), "rows": rows})
        self.recover({number: staged})
        return rows

    def _publish(self, number: int, told: dict) -> None:
        """The commit: the manifest appears whole, by a rename."""
        draft, final = self._path(f"/{number}/manifest"), self._path(f"/{number}.json")
        files = self._files(final)
        out = files.create(draft, True)
        out.writeBytes(json.dumps(told))
        out.close()
        if not files.rename(draft, final):
            raise OSError(f"could not publish {final.toString()}")

    def recover(self, staged: Mapping[int, DataFrame] | None = None) -> None:
        """Carry out what is committed and not yet done; doing it again changes nothing.

        ``staged`` has the staged rows of loads that were read back just now, whose files need not be listed again.
        """
        for name in self._manifests():
            number, manifest = int(name.split(".")[0]), self._path(f"/{name}")
            files = self._files(manifest)
            told = json.loads(self.spark.read.text(manifest.toString()).first()[0])
            self._apply(number, told, (staged or {}).get(number))
            files.delete(manifest, False)
            files.delete(self._path(f"/{number}"), True)
            if len(self._loads()) > KEPT_LOADS:
                self.compact()

    def _apply(self, number: int, told: dict, rows: DataFrame | None = None) -> None:
        """Enter the keys while all rows are staged, then move the staged files to their days and remove those that go."""
        self._ensure_index()
        stage = self._path(f"/{number}/rows")
        if number not in self._loads() and self._listed(stage):
            self._append(self._entry(self._read([stage.toString()], stage.toString()) if rows is None else rows), number)
        top = self.location()
        files, path = self._files(stage), self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        staged = [(f"{top}/_loads/{number}/{part}/{day}", day) for part in _parts(told["parts"]) for day in self._listed(self._path(f"/{number}/{part}")) if "=" in day]
        there = {f for f in self._listed(path(top)) if "=" in f}
        came = there | {day for _, day in staged}
        # a day that is not there yet takes its first staged folder whole, the others take files
        whole = {day: at for at, day in reversed(staged) if day not in there}

        def rename(at: str, to: str) -> None:
            if not files.rename(path(at), path(to)):
                raise OSError(f"could not move {at}")

        def move(at: str, day: str) -> None:
            for name in [s.getPath().getName() for s in files.listStatus(path(at))]:
                if name[0] not in "._":
                    rename(f"{at}/{name}", f"{top}/{day}/{name}")

        with ThreadPoolExecutor(MOVERS) as pool:
            list(pool.map(lambda day: rename(whole[day], f"{top}/{day}"), whole))
            list(pool.map(lambda both: move(*both), [(at, day) for at, day in staged if whole.get(day) != at]))
            list(pool.map(lambda g: files.delete(path(f"{top}/{g}"), False), told["gone"]))
            # days of staged files hold those
            left = sorted(({g.split("/")[0] for g in told["gone"]} & came) - {day for _, day in staged})
            empty = [day for day, names in zip(left, pool.map(lambda d: self._listed(path(f"{top}/{d}")), left), strict=True) if not names]
        known = {r[0] for r in self.spark.sql(f"SHOW PARTITIONS {self.table}").collect()}
        for verb, days in (("ADD IF NOT EXISTS", sorted(came - known - {*empty})), ("DROP IF EXISTS", [d for d in empty if d in known or d.endswith(NO_DAY)])):
            specs = [f"PARTITION (`{self.column}` = " + ("null" if d.endswith(NO_DAY) else f"'{d.partition('=')[2]}'") + ")" for d in days]
            if specs:
                self.spark.sql(f"ALTER TABLE {self.table} {verb} " + (" " if verb.startswith("ADD") else ", ").join(specs))
        for day in empty:
            files.delete(path(f"{top}/{day}"), True)
        self.spark.catalog.refreshTable(self.table)

    # ------------------------------------------------------------ intervals

    def fold(self, snapshot: DataFrame, as_of: dt.date, close: Callable[..., DataFrame], key: str = "id") -> int:
        """Fold a snapshot into validity intervals stored under the day they end; returns the rows written.

        ``close(open intervals, snapshot, as_of, key)`` gives the intervals after the snapshot.  Only the open partition and the one of the day before are read and written.  Changed rows close there, under
        one commit with the new open rows; a repeated snapshot changes nothing.
        """
        self.recover()
        self._ensure_index()
        eve = as_of - dt.timedelta(days=1)
        columns = [c for c in self.spark.table(self.table).columns if c != self.column]
        opened = self.on([OPEN_END]).select(*columns)
        folded = written(close(opened, snapshot.select(*[c for c in columns if c not in ("start_date", "end_date")]), as_of, key))
        closed_before = self.on([eve]).select(*columns)
        # what closes again on that day is what an interrupted or repeated load has closed already
        names = folded.where(F.col("end_date") == F.lit(eve)).select(F.col(key).alias("__key"), F.col("start_date").alias("__start"))
        kept = closed_before.join(names, (F.col(key) == F.col("__key")) & (F.col("start_date") == F.col("__start")), "left_anti")
        both = tables.align_to(folded.unionByName(kept).withColumn(self.column, F.col("end_date")), self.spark.table(self.table).schema)
        return self.commit(both, [eve, OPEN_END])

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        self.spark.sql(f"DROP TABLE IF EXISTS {self.index}")
