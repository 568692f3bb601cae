"""Log of the runs of a profile store: which are complete, in which order, and what each voids.

A run claims its place with a file of its own (one more than the greatest number listed, and a
suffix that no other run has), so that runs at the same time need no lock and both survive;
their order is that of the names.  Its cells become visible with its commit file, all at
once.  Readers take the runs that are committed when they look, by name: what another run is
writing, or has left behind, is never read.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

RUN = "run"


@dataclass
class Runs:
    """Committed runs in their order, those without a commit, and per tag the last that voids it."""

    committed: list[str]
    open: list[str]
    base: dict[str, str]

    def visible(self, tag: Column | str = "tag") -> Column:
        """Whether a stored cell counts: its run is committed and not before the last one that
        voided its tag.  On folders by tag and run this prunes the folders."""
        tag, run = F.col(tag) if isinstance(tag, str) else tag, F.col(RUN)
        if not self.committed:
            return F.lit(False)
        seen = run.isin(self.committed)
        if not self.base:
            return seen
        first = F.create_map(*[F.lit(x) for pair in sorted(self.base.items()) for x in pair])
        return seen & (run >= F.coalesce(first[tag], F.lit("")))


class RunLog:
    """The log in the folder ``_runs`` of a store."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.folder = spark, f"{root.rstrip('/')}/_runs"
        hadoop = spark.sparkContext._jvm.org.apache.hadoop
        self._path = hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _put(self, name: str, text: str) -> None:
        # written under another name: a reader sees the whole file or none
        part = self._path(f"{self.folder}/.{name}-{uuid.uuid4().hex}")
        out = self._fs.create(part, True)
        out.write(bytearray(text.encode()))
        out.close()
        self._fs.rename(part, self._path(f"{self.folder}/{name}"))

    def _get(self, name: str) -> str:
        stream = self._fs.open(self._path(f"{self.folder}/{name}"))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _names(self) -> set[str]:
        if not self._fs.exists(self._path(self.folder)):
            return set()
        return {x.getPath().getName() for x in self._fs.listStatus(self._path(self.folder))}

    def claim(self, key: str | int | None = None, first: bool = False) -> str:
        """A place behind all runs listed now.  A run that is repeated under the same ``key``
        gets its old place back; ``first``: before others of the same number."""
        own = hashlib.sha256(str(key).encode()).hexdigest()[:16] if key is not None else uuid.uuid4().hex[:16]
        claims = sorted(x[:-6] for x in self._names() if x.endswith(".claim"))
        for run in claims:
            if key is not None and run.split("-")[1] == own:
                return run
        number = int(claims[-1].split("-")[0]) + 1 if claims else 1
        run = f"{number:012d}-{'0' * 16 if first else own}"
        self._put(f"{run}.claim", "")
        return run

    def commit(self, run: str, replaced: list[str]) -> None:
        """Makes the run visible; ``replaced``: tags whose cells of earlier runs it voids."""
        self._put(f"{run}.commit", json.dumps({"replaced": sorted(replaced)}))

    def runs(self) -> Runs:
        names = self._names()
        committed = sorted(x[:-7] for x in names if x.endswith(".commit"))
        base: dict[str, str] = {}
        # one small file a run; the store's vacuum takes voided ones away
        for run in committed:
            base |= dict.fromkeys(json.loads(self._get(f"{run}.commit"))["replaced"], run)
        open_ = sorted({x[:-6] for x in names if x.endswith(".claim")} - set(committed))
        return Runs(committed, open_, base)

    def save_schema(self, schema: StructType) -> None:
        if "schema.json" not in self._names():
            self._put("schema.json", schema.json())

    def schema(self) -> StructType:
        return StructType.fromJson(json.loads(self._get("schema.json")))

    def delete_data(self, root: str, folder: str) -> bool:
        return self._fs.delete(self._path(f"{root}/{folder}"), True)

    def has_data(self, root: str, pattern: str) -> bool:
        return len(self._fs.globStatus(self._path(f"{root}/{pattern}"))) > 0

    def forget(self, runs: list[str]) -> None:
        """Takes runs out of the log whose cells are all voided."""
        for run in runs:
            for kind in ("commit", "claim"):
                self._fs.delete(self._path(f"{self.folder}/{run}.{kind}"), False)


def newest(cells: DataFrame, key: str) -> DataFrame:
    """One row (key, tag, value) per cell: of its last run, there of the greatest version, of equal
    ones the greatest text."""
    return cells.groupBy(key, "tag").agg(F.max_by("value", F.struct(RUN, "version", "value")).alias("value"))
