"""The lake: tables of immutable folders by day, and a commit log that says which of them are the days.

A change writes its rows into folders of its own, and is seen by nobody until its one commit: then all its tables and
manifests are there at once. Writing a day again replaces it; what was there stays readable as an older version until it
expires. A copy of each committed manifest is put under manifest_key, for readers outside; nothing here reads it.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from copy import deepcopy
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daybook.functions.days import check_dt, manifest_key
from daybook.schemas import CONFLICTS, DISCREPANCIES, GOLD, MANIFEST, OBJECTS, PARTIALS, QUARANTINE, REQUIRED, SILVER
from daybook.session import prepare
from daybook.sources.log import CommitLog, Snapshot

SCHEMAS = {
    "silver": SILVER, "gold": GOLD, "quarantine": QUARANTINE, "partials": PARTIALS, "objects": OBJECTS, "discrepancies": DISCREPANCIES, "conflicts": CONFLICTS,
}
#: Versions that are kept: the last so many, and all of so many days. Folders that no version names are left this long.
KEEP, KEEP_DAYS, ORPHAN_HOURS = 10, 7, 24


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = prepare(spark), root.rstrip("/")
        self.log = CommitLog(spark, self.root)

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _delete(self, path: str) -> None:
        fs, p = self._fs(path)
        fs.delete(p, True)

    def exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def snapshot(self, version: int | None = None, as_of: str | None = None) -> Snapshot:
        return self.log.read(version, as_of)

    def read(self, table: str, version: int | None = None, as_of: str | None = None) -> DataFrame:
        """All days as of the last version, or of another one."""
        return self.read_of(self.snapshot(version, as_of), table)

    def read_of(self, snapshot: Snapshot, table: str, days: list[str] | None = None) -> DataFrame:
        """The schema is given, so that dt stays text and nothing is inferred but the folders' names."""
        schema: StructType = SCHEMAS[table]
        paths = [f"{self.path(table)}/write={f}/dt={d}" for f, d in snapshot.folders(table, days)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        found = self.spark.read.schema(schema).option("basePath", self.path(table)).parquet(*paths)
        return found.select(*schema.fieldNames())

    def write(self, table: str, rows: DataFrame, days: list[str], even: bool = True) -> dict[str, str]:
        """Write the rows of these days into new folders, in files of even size; {day: folder} of the days that have any."""
        names = SCHEMAS[table].fieldNames()
        broken = [F.col(c).isNull() for c in REQUIRED.get(table, ())]
        if broken:
            bad = broken[0]
            for b in broken[1:]:
                bad = bad | b
            rows = rows.where(F.when(bad, F.raise_error(F.lit(f"a required column of {table} is null"))).otherwise(F.lit(True)))
        rows = rows.where(F.col("dt").isin([check_dt(d) for d in days])).select(*names)
        name = uuid.uuid4().hex
        path = f"{self.path(table)}/write={name}"
        (rows.hint("rebalance", "dt") if even else rows).write.mode("overwrite").partitionBy("dt").parquet(path)
        fs, p = self._fs(path)
        return {d.removeprefix("dt="): name for x in fs.listStatus(p) if (d := x.getPath().getName()).startswith("dt=")}

    def change(self, operation: str, base: Snapshot | None = None) -> Change:
        return Change(self, operation, base or self.snapshot())

    def manifest(self, dt: str) -> dict | None:
        return self.manifests_of([dt])[dt]

    def manifests_of(self, days: list[str], snapshot: Snapshot | None = None) -> dict[str, dict | None]:
        """The manifests of these days by day, None where there is none; one read for all."""
        known = (snapshot or self.snapshot()).days
        return {check_dt(d): known[d]["manifest"] if d in known else None for d in days}

    def manifests(self) -> DataFrame:
        found = [json.dumps(e["manifest"]) for e in self.snapshot().days.values() if e["manifest"]]
        rows = self.spark.createDataFrame([(m,) for m in found], "m string")
        return rows.select(F.from_json("m", MANIFEST).alias("m")).select("m.*")

    def copy_manifest(self, manifest: dict) -> None:
        fs, p = self._fs(f"{self.root}/{manifest_key(check_dt(manifest['dt']))}")
        out = fs.create(p, True)
        out.write(bytearray(json.dumps(manifest, indent=2).encode()))
        out.close()

    def append(self, table: str, rows: DataFrame, days: list[str]) -> Snapshot:
        """Add rows to days as they are, repeated ones too."""
        change = self.change("append")
        change.add(table, rows, days)
        return change.commit()

    def compact(self, table: str, days: list[str], files: int = 1) -> Snapshot:
        """Rewrite days into so many files each, as a version of its own; the rows are the same."""
        change = self.change("compact")
        part = F.pmod(F.xxhash64("row_uid" if "row_uid" in SCHEMAS[table].fieldNames() else "dt"), F.lit(files))
        rows = self.read_of(change.base, table, days)
        change.replace(table, rows.repartition(files * max(1, len(days)), "dt", part), days, even=False)
        return change.commit()

    def drop(self, table: str) -> Snapshot:
        """A version in which the table is empty."""
        change = self.change("drop")
        for d in change.base.days:
            change.entry(d)["tables"][table] = []
        return change.commit()

    #: Days are filled again by forced runs.
    recreate = drop

    def references(self) -> Counter:
        """(table, folder, day) to the number of versions that are made of it."""
        out: Counter = Counter()
        for n in self.log.versions():
            found = self.snapshot(n)
            out.update((t, f, d) for t in SCHEMAS for f, d in found.folders(t))
        return out

    def expire(self, keep: int = KEEP, days: float = KEEP_DAYS, orphan_hours: float = ORPHAN_HOURS, now: datetime | None = None) -> dict:
        """Forget versions that are neither among the last `keep` nor younger than so many days, and delete the folders that
        no version is made of any more.

        Versions go first, so none is ever there without its rows. Folders that were never committed are a run's that died,
        or one's that still writes: they go after orphan_hours.
        """
        now = now or datetime.now(UTC)
        versions = [self.snapshot(n) for n in self.log.versions()]
        limit = (now - timedelta(days=days)).isoformat(timespec="milliseconds").replace("+00:00", "Z")
        # The last version is always kept.
        old = [v for v in versions[: len(versions) - max(1, keep)] if v.at < limit]
        was = {(t, f, d) for v in old for t in SCHEMAS for f, d in v.folders(t)}
        self.log.forget([v.number for v in old])
        needed, gone = self.references(), 0
        for table in SCHEMAS:
            fs, p = self._fs(f"{self.path(table)}/write=*/dt=*")
            for found in fs.globStatus(p) or []:
                at = found.getPath()
                key = (table, at.getParent().getName().removeprefix("write="), at.getName().removeprefix("dt="))
                age = now.timestamp() - found.getModificationTime() / 1000
                if key not in needed and (key in was or age > 3600 * orphan_hours):
                    fs.delete(at, True)
                    gone += 1
                    if not any(x.getPath().getName().startswith("dt=") for x in fs.listStatus(at.getParent())):
                        fs.delete(at.getParent(), True)
        self.log.intended(self.snapshot(), clear=True)
        return {"versions": [v.number for v in old], "folders": gone}


class Change:
    """A commit in the making, over the version `base`."""

    def __init__(self, lake: Lake, operation: str, base: Snapshot):
        self.lake, self.operation, self.base = lake, operation, base
        self.days: dict[str, dict] = {}
        self.batches: dict[str, int] = {}

    def entry(self, day: str) -> dict:
        if day not in self.days:
            self.days[day] = deepcopy(self.base.days.get(check_dt(day), {"tables": {}, "manifest": None}))
        return self.days[day]

    def replace(self, table: str, rows: DataFrame, days: list[str], even: bool = True) -> None:
        """Make rows the only ones of these days."""
        written = self.lake.write(table, rows, days, even)
        for d in days:
            self.entry(d)["tables"][table] = [written[d]] if d in written else []

    def add(self, table: str, rows: DataFrame, days: list[str]) -> None:
        """Add rows to those of these days."""
        for d, folder in self.lake.write(table, rows, days).items():
            self.entry(d)["tables"].setdefault(table, []).append(folder)

    def read(self, table: str, days: list[str]) -> DataFrame:
        """What these days will be."""
        return self.lake.read_of(Snapshot(days=self.base.days | self.days), table, days)

    def manifest(self, manifest: dict) -> None:
        self.entry(manifest["dt"])["manifest"] = manifest

    def commit(self) -> Snapshot:
        made = self.lake.log.commit(self.base, self.operation, self.days, self.batches)
        for d, e in self.days.items():
            if e["manifest"] and e["manifest"] != (self.base.days.get(d) or {}).get("manifest"):
                self.lake.copy_manifest(e["manifest"])
        return made
