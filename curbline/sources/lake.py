"""Tables that change together: versioned folders, and one manifest that says which of them count.

A change writes into folders of its own, which no reader knows of. Its last step creates the
next manifest, a small file that lists the folders of every table; readers take
the newest. So they see all of a change or nothing of it, a failure leaves the old state as it was,
and a reader that has begun keeps its folders until ``expire`` removes them.

A table has one folder, or several shares that readers put together. Shares are kept as
generations: as soon as ``FAN`` shares of one generation are there, they are combined into one of the
next, in the same change that brought the last of them. A table of n shares thus has at
most ``(FAN - 1) * log(n)`` folders, and a row is rewritten ``log(n)`` times.

The manifest also has the last batch that each stream has brought, so a batch that is run again
after its change was published is left out. Two writers can't both create a manifest: the later one fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field, replace
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from py4j.protocol import Py4JJavaError

from curbline.sources import storage

#: Shares of one generation that are combined.
FAN = 4


class ConcurrentChange(RuntimeError):
    """Another change was published since this one began."""


@dataclass(frozen=True)
class Share:
    folder: str
    generation: int = 0


@dataclass(frozen=True)
class Table:
    shares: tuple[Share, ...]
    schema: str
    layer: str = ""
    comment: str = ""
    partitioned: bool = False


@dataclass(frozen=True)
class State:
    """What a manifest holds."""

    version: int = 0
    tables: dict[str, Table] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def of(text: str) -> State:
        found = json.loads(text)
        tables = {
            name: Table(**{**t, "shares": tuple(Share(**s) for s in t["shares"])}) for name, t in found["tables"].items()
        }
        return State(found["version"], tables, found["batches"])


class Lake:
    """The tables below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def versions(self) -> list[int]:
        found = storage.names(self.spark, f"{self.root}/_manifests")
        return sorted(int(n[:-5]) for n in found if n.endswith(".json") and n[:-5].isdigit())

    def state(self, version: int | None = None) -> State:
        """The newest state, or a given one. A manifest that was cut off counts as none."""
        if version is not None:
            return State.of(storage.read(self.spark, self._manifest(version)))
        for number in reversed(self.versions()):
            try:
                return State.of(storage.read(self.spark, self._manifest(number)))
            except json.JSONDecodeError:
                continue
        return State()

    def tables(self) -> dict[str, Table]:
        return self.state().tables

    def read(self, name: str, version: int | None = None) -> DataFrame:
        return self.frame(self.state(version).tables[name])

    def frame(self, table: Table) -> DataFrame:
        """All shares together. A share may be partitioned below its folder; each has its own base."""
        schema = T.StructType.fromJson(json.loads(table.schema))
        paths = [f"{self.root}/{s.folder}" for s in table.shares]
        if not table.partitioned:
            return self.spark.read.schema(schema).parquet(*paths)
        return reduce(DataFrame.unionByName, [self.spark.read.schema(schema).parquet(p) for p in paths])

    def change(self) -> Change:
        return Change(self)

    def expire(self, keep: int = 2) -> None:
        """Forget all but the newest ``keep`` versions, and remove the folders that only those had."""
        versions = self.versions()
        old, new = versions[:-keep], versions[-keep:]
        used = {s.folder for v in new for t in self.state(v).tables.values() for s in t.shares}
        gone = {s.folder for v in old for t in self.state(v).tables.values() for s in t.shares} - used
        for folder in sorted(gone):
            storage.remove(self.spark, f"{self.root}/{folder}")
        for version in old:
            storage.remove(self.spark, self._manifest(version))

    def _manifest(self, version: int) -> str:
        return f"{self.root}/_manifests/{version:010d}.json"


class Change:
    """Writes that become visible together, when ``publish`` is called."""

    def __init__(self, lake: Lake):
        self.lake, self.state = lake, lake.state()
        self.base = self.state.version

    def has(self, name: str) -> bool:
        return name in self.state.tables

    def read(self, name: str) -> DataFrame:
        """A table as this change leaves it."""
        return self.lake.frame(self.state.tables[name])

    def replace(self, name: str, df: DataFrame, layer: str = "", comment: str = "") -> None:
        self._set(name, Table((self._write(name, df),), df.schema.json(), layer, comment))

    def append(self, name: str, df: DataFrame, layer: str = "", comment: str = "") -> None:
        """Another share of a table; its columns must be those that the table has."""
        table = self.state.tables.get(name) or Table((), df.schema.json(), layer, comment)
        if T.StructType.fromJson(json.loads(table.schema)).simpleString() != df.schema.simpleString():
            raise ValueError(f"{name} has other columns: {table.schema}")
        self._set(name, replace(table, shares=(*table.shares, self._write(name, df))))

    def adopt(self, name: str, folder: str, schema: T.StructType, layer: str = "", comment: str = "") -> None:
        """Another share, in a folder that ``folder_of`` has named, and that is written already, perhaps by partitions."""
        table = self.state.tables.get(name) or Table((), schema.json(), layer, comment, partitioned=True)
        self._set(name, replace(table, shares=(*table.shares, Share(folder))))

    def combine(self, name: str, together: Callable[[DataFrame], DataFrame], fan: int = FAN) -> None:
        """Shares of one generation become one of the next, wherever there are ``fan`` of them."""
        generation = 0
        while generation <= max(s.generation for s in self.state.tables[name].shares):
            table = self.state.tables[name]
            own = [s for s in table.shares if s.generation == generation]
            if len(own) >= fan:
                whole = together(self.lake.frame(replace(table, shares=tuple(own))))
                others = tuple(s for s in table.shares if s.generation != generation)
                self._set(name, replace(table, shares=(*others, replace(self._write(name, whole), generation=generation + 1))))
            generation += 1

    def last_batch(self, stream: str) -> int:
        """The last batch that a stream has brought, -1 if none."""
        return self.state.batches.get(stream, -1)

    def brings(self, stream: str, batch: int) -> None:
        self.state = replace(self.state, batches={**self.state.batches, stream: batch})

    def folder_of(self, name: str) -> str:
        """A folder below the root that nothing else uses."""
        return f"{name}/v{self.base + 1:010d}-{uuid.uuid4().hex[:8]}"

    def publish(self) -> State:
        state = replace(self.state, version=self.base + 1)
        try:
            storage.create(self.lake.spark, self.lake._manifest(state.version), state.text())
        except (Py4JJavaError, PySparkException) as error:
            if storage.exists(self.lake.spark, self.lake._manifest(state.version)):
                raise ConcurrentChange(f"version {state.version} was published by another change") from error
            raise
        return state

    def _write(self, name: str, df: DataFrame) -> Share:
        folder = self.folder_of(name)
        df.write.parquet(f"{self.lake.root}/{folder}")
        return Share(folder)

    def _set(self, name: str, table: Table) -> None:
        self.state = replace(self.state, tables={**self.state.tables, name: table})


def named(rows: Sequence[tuple[str, Table]], spark: SparkSession) -> DataFrame:
    """Name, layer, comment and number of shares of each table."""
    found = [(name, t.layer, t.comment, len(t.shares)) for name, t in rows]
    return spark.createDataFrame(found, "table_name string, layer string, comment string, shares int")
