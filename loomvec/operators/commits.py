"""A store of vectors by content hash that several writers add to at once.

A commit is a folder of files that never change, and one row of a log in a folder of its
own, written last: readers see a commit whole or not at all, a writer that dies leaves
nothing that is read, and no writer can lose another's entries, as commits are united by
key when they are read. Files are partitioned by the first digits of the hash, so a lookup
reads only the prefixes that its jobs have. Small commits are merged by a commit that
replaces them; readers of the replaced ones go on.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .store import FingerprintError, differing, fingerprint

#: Entries as they are written. One with an error is a failed attempt and no hit.
ENTRY = "sequence_hash string, embedding array<float>, num_chunks int, error string, error_kind string, branches array<string>"
LOG = "id string, fingerprint_hash string, settings string, made long, replaces array<string>, entries long, failed long, passes long"
#: Hexadecimal digits of a prefix, unless a store is opened with others: 256 folders a commit at most.
DIGITS = 2
#: Settings without which two vectors can't be told to be comparable.
MANDATORY = ("encoder", "size", "overlap", "policy")


def prefix(key: Column, digits: int = DIGITS) -> Column:
    return F.substring(key, 1, digits)


class Store:
    """Entries under one set of settings in ``path``; writers with other settings are refused.

    ``digits`` of the hash make a prefix: few for small stores, which then have few files.
    They are one of the settings, as ``layout``.
    """

    def __init__(self, spark: SparkSession, path: str, settings: dict, rebuild: bool = False, digits: int = DIGITS):
        if missing := [m for m in MANDATORY if m not in settings]:
            raise ValueError(f"settings without {', '.join(missing)}")
        self.spark, self.path, self.digits, self.settings = spark, path.rstrip("/"), digits, {**settings, "layout": f"prefix-{digits}"}
        self.print = fingerprint(self.settings)
        # a rebuild hides what is there now; its first commit replaces that for all readers
        self.hidden: set[str] = {c["id"] for c in self._log()} if rebuild else set()
        if not rebuild:
            self.log()

    def _log(self) -> list:
        """All commits: one small row each, and compaction keeps those that count few."""
        from pyspark.errors import AnalysisException

        try:
            return self.spark.read.schema(LOG).json(f"{self.path}/log").where("id is not null").collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def log(self) -> list:
        """Commits that count, in the order in which they were made."""
        known = [c for c in self._log() if c["id"] not in self.hidden]
        gone = {r for c in known for r in c["replaces"]}
        counted = sorted((c for c in known if c["id"] not in gone), key=lambda c: (c["made"], c["id"]))
        if other := next((c for c in counted if c["fingerprint_hash"] != self.print), None):
            names = differing(json.loads(other["settings"]), json.loads(json.dumps(self.settings, default=str)))
            raise FingerprintError(f"the store was made with other settings: {', '.join(names)}")
        return counted

    def _read(self, commits: Iterable, prefixes: list[str] | None = None) -> DataFrame:
        """Entries of commits with ``commit`` and ``prefix``; of some prefixes only, if given."""
        paths = [f"{self.path}/entries/commit={c['id']}" for c in commits]
        schema = f"{ENTRY}, commit string, prefix string"
        if not paths:
            return self.spark.createDataFrame([], schema)
        found = self.spark.read.schema(schema).option("basePath", f"{self.path}/entries").parquet(*paths)
        return found if prefixes is None else found.where(F.col("prefix").isin(prefixes))

    def _united(self, rows: DataFrame, commits: list) -> DataFrame:
        """One entry a key: an encoded one before a failed one, then of the newest commit; branches of all."""
        place = F.create_map(*(x for i, c in enumerate(commits) for x in (F.lit(c["id"]), F.lit(i)))) if commits else F.create_map()
        newest = F.struct(F.col("error").isNull(), F.coalesce(F.try_element_at(place, F.col("commit")), F.lit(-1))) if commits else F.lit(0)
        value = F.struct("embedding", "num_chunks", "error", "error_kind")
        united = F.array_sort(F.array_distinct(F.flatten(F.collect_list("branches"))))
        # branches of a key are few and repeat, but keys come once a commit at most
        return rows.groupBy("sequence_hash").agg(F.max_by(value, newest).alias("v"), united.alias("branches")).select("sequence_hash", "v.*", "branches")

    def entries(self, failed: bool = False) -> DataFrame:
        """All entries, one a key; with ``failed`` those of failed attempts too."""
        commits = self.log()
        out = self._united(self._read(commits), commits)
        return out if failed else out.where("error is null")

    def _prefixes(self, jobs: DataFrame) -> list[str] | None:
        """Prefixes that jobs have; none if they are most of all there can be, as then all files are read."""
        some = [r["p"] for r in jobs.select(prefix(F.col("sequence_hash"), self.digits).alias("p")).where("p is not null").distinct().collect()]
        return sorted(some) if 2 * len(some) < 16**self.digits else None

    def found(self, jobs: DataFrame) -> DataFrame:
        """Entries of the jobs' keys, from the prefixes that they have. ``jobs`` should be a written table, as its keys are read twice."""
        commits = self.log()
        rows = self._read(commits, self._prefixes(jobs) if commits else None).where("error is null")
        return self._united(rows.join(jobs.select("sequence_hash").distinct(), "sequence_hash", "left_semi"), commits)

    def misses(self, jobs: DataFrame) -> DataFrame:
        """Jobs without an entry."""
        commits = self.log()
        rows = self._read(commits, self._prefixes(jobs) if commits else None).where("error is null")
        return jobs.join(rows.select("sequence_hash"), "sequence_hash", "left_anti")

    def commit(self, rows: DataFrame, name: str | None = None, replaces: Iterable[str] = ()) -> dict:
        """Add entries; their numbers, counted while they are written.

        ``rows`` has the columns of ``ENTRY`` (``branches`` may be missing). A commit with
        the name of an earlier one takes its place, so a repeated batch adds nothing.
        """
        self.log()  # other settings may have come meanwhile
        name = name or uuid.uuid4().hex
        if not name.replace("-", "").isalnum():
            raise ValueError("a commit's name has letters, digits and dashes only")
        if "branches" not in rows.columns:
            rows = rows.withColumn("branches", F.array().cast("array<string>"))
        columns = [x.split()[0] for x in ENTRY.split(", ")]
        seen = Observation(f"commit-{name}-{uuid.uuid4().hex}")
        typed = rows.select(*columns).withColumn("embedding", F.col("embedding").cast("array<float>")).withColumn("prefix", prefix(F.col("sequence_hash"), self.digits))
        good = F.col("error").isNull()
        counted = typed.repartition("prefix").observe(
            seen, F.count(F.when(good, 1)).alias("entries"), F.count(F.when(~good, 1)).alias("failed"), F.coalesce(F.sum(F.when(good, F.col("num_chunks")).cast("long")), F.lit(0)).alias("passes")
        )
        counted.write.mode("overwrite").partitionBy("prefix").parquet(f"{self.path}/entries/commit={name}")
        numbers = dict(seen.get)
        row = (name, self.print, json.dumps(self.settings, sort_keys=True, default=str), time.time_ns(), sorted({*replaces, *self.hidden} - {name}), numbers["entries"], numbers["failed"], numbers["passes"])
        self.spark.createDataFrame([row], LOG).coalesce(1).write.mode("overwrite").json(f"{self.path}/log/commit={name}")
        return numbers

    def compact(self, below: int) -> int:
        """Merge the commits with fewer entries than ``below`` into one; how many were merged.

        Two that run at once both keep all entries: what both merge is united again.
        """
        commits = self.log()
        small = [c for c in commits if c["entries"] + c["failed"] < below]
        if len(small) > 1:
            self.commit(self._united(self._read(small), small).where("error is null"), replaces=[c["id"] for c in small])
        return len(small) if len(small) > 1 else 0


def settings_of(spark: SparkSession, path: str) -> DataFrame:
    """Settings of a store as rows (field, value), read from its newest commit."""
    newest = spark.read.schema(LOG).json(f"{path}/log").where("id is not null").agg(F.max_by("settings", F.struct("made", "id")).alias("s"))
    return newest.select(F.explode(F.from_json("s", "map<string,string>")).alias("field", "value"))


def settings_diff(stored: DataFrame, current: DataFrame) -> DataFrame:
    """Fields (field, stored, now) whose values differ, null-safe, or that only one side has."""
    a = stored.select("field", F.col("value").alias("stored"), F.lit(True).alias("_a"))
    b = current.select("field", F.col("value").alias("now"), F.lit(True).alias("_b"))
    both = a.join(b, "field", "full")
    return both.where(F.col("_a").isNull() | F.col("_b").isNull() | ~F.col("stored").eqNullSafe(F.col("now"))).select("field", "stored", "now")
