"""A keyed table kept as an append-only log of micro-batches over a base in buckets of the key.

A micro-batch writes only the rows it touched, into a folder named by its batch id, so a retried
batch replaces its own output.  A folder counts only once its id has been published, which happens
after the write has succeeded.  Reading folds the base and the published batches after it with the
table's own reducer.  Nothing is ever changed in place.

``compact`` folds the log into the base, but writes only the buckets whose keys the log touched; the
others stay the files they are.  What it publishes is the list of buckets with the compaction that
wrote each, so a compaction that was lost halfway is never read.  Rows of one key lie in one bucket,
so ``lookup`` of a few keys opens their buckets only.

What a compaction has replaced is deleted by the next one, and of the published ids the newest two
are kept.  So a reader looks at what has come since the base, however long the table has been
running, and has from one compaction to the next but one to finish."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwell.sources.readers import empty
from tierwell.sources.shared import names_in, remove
from tierwell.sources.sinks import overwrite

#: The most buckets a base has unless told otherwise: also the most folders a reader opens beside the log.
BUCKETS = 64
_MANIFEST = "id long, bucket int, written_by long, buckets int"


@dataclass(frozen=True)
class _Base:
    """A published base: how many buckets keys are dealt to, and which compaction wrote each that has rows."""

    number: int
    buckets: int
    written_by: dict[int, int]


class KeyedLog:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        fold: Callable[[DataFrame], DataFrame],
        key: str | None = None,
        buckets: int = BUCKETS,
    ):
        """``fold`` reduces rows of ``schema`` plus ``batch`` to the rows that hold now.  It must keep rows
        of different ``key`` apart.  Without a key rows are dealt by all their columns, and ``fold`` must
        leave each row as it is.  A base with another number of buckets is read as it is and rewritten by
        the next compaction."""
        self.spark, self.root, self.schema, self.fold = spark, root.rstrip("/"), schema, fold
        self.key, self.buckets = key, buckets
        self.stored = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])

    def on(self, spark: SparkSession) -> KeyedLog:
        """The same table through another session."""
        return KeyedLog(spark, self.root, self.schema, self.fold, self.key, self.buckets)

    def append(self, rows: DataFrame, batch: int) -> None:
        # Streaming state keeps a fixed number of partitions; rebalancing avoids as many tiny files.
        kept = rows.select(*self.schema.fieldNames(), F.lit(batch).cast("bigint").alias("batch"))
        overwrite(kept.hint("rebalance"), f"{self.root}/log/id={batch}")
        self._publish("log", batch)

    def compact(self) -> int | None:
        """Fold everything published so far into the base, and delete what the base before replaced.

        Only buckets with a key in the log are read and written; a task reads the log once to find them."""
        newest, former = self._newest("log"), self._base()
        if newest is None or (former and newest == former.number):
            return newest
        moved = former is not None and former.buckets != self.buckets
        log = self._log(newest, former)
        if moved:
            touched = set(range(self.buckets))
        else:  # at most as many rows as there are buckets
            touched = {r["bucket"] for r in log.select(self._bucket(self.buckets).alias("bucket")).distinct().collect()}
        old = [] if former is None else self._paths(former, None if moved else touched)
        rows = log.unionByName(self._rows(old)) if old else log
        folded = self.fold(rows).withColumn("bucket", self._bucket(self.buckets))
        overwrite(folded, f"{self.root}/base/id={newest}", partition_by="bucket")
        written = {
            int(n.removeprefix("bucket="))
            for n in names_in(self.spark, f"{self.root}/base/id={newest}")
            if n.startswith("bucket=")
        }
        carried = {} if former is None or moved else {b: k for b, k in former.written_by.items() if b not in touched}
        owners = carried | dict.fromkeys(written, newest)
        manifest = [(newest, b, k, self.buckets) for b, k in sorted(owners.items())]
        # An empty base has no buckets, but its number and how it deals keys must still be known.
        self._publish("base", newest, manifest or [(newest, None, None, self.buckets)])
        if former is not None:
            self._clean(former, owners)
        return newest

    def read(self) -> DataFrame:
        """The table as of the last published batch."""
        return self._read(None)

    def lookup(self, keys: Sequence[str]) -> DataFrame:
        """The rows of some keys: their buckets of the base, and the log's rows of these keys."""
        if self.key is None:
            raise ValueError("a table without a key cannot be looked up by one")
        return self._read(list(dict.fromkeys(keys)))

    def written(self, batch: int) -> DataFrame:
        """The rows a batch has appended, until a compaction deletes them."""
        return self._rows([f"{self.root}/log/id={batch}"]).select(*self.schema.fieldNames())

    def newest(self) -> int | None:
        """The last published batch."""
        return self._newest("log")

    def _read(self, keys: list[str] | None) -> DataFrame:
        newest = self._newest("log")
        if newest is None or keys == []:
            return empty(self.spark, self.schema)
        base = self._base()
        wanted = None
        if keys is not None and base is not None:
            dealt = self.spark.createDataFrame([(k,) for k in keys], f"`{self.key}` string")
            wanted = {r[0] for r in dealt.select(self._bucket(base.buckets)).collect()}
        rows = self._log(newest, base)
        if base is not None and (paths := self._paths(base, wanted)):
            rows = rows.unionByName(self._rows(paths))
        if keys is not None:
            rows = rows.filter(F.col(self.key).isin(keys))
        return self.fold(rows).select(*self.schema.fieldNames())

    def _bucket(self, buckets: int) -> Column:
        """Where a row belongs: by its key alone, so equal keys meet whoever wrote them."""
        by = self.schema.fieldNames() if self.key is None else [self.key]
        return F.pmod(F.xxhash64(*by), F.lit(buckets)).cast("int")

    def _rows(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(self.stored).parquet(*paths)

    def _log(self, newest: int, base: _Base | None) -> DataFrame:
        """What was published after the base."""
        after = -1 if base is None else base.number
        paths = [f"{self.root}/log/id={k}" for k in self._ids("log") if after < k <= newest]
        return self._rows(paths) if paths else empty(self.spark, self.stored)

    def _paths(self, base: _Base, buckets: set[int] | None) -> list[str]:
        return [
            f"{self.root}/base/id={k}/bucket={b}"
            for b, k in sorted(base.written_by.items())
            if buckets is None or b in buckets
        ]

    def _clean(self, former: _Base, owners: dict[int, int]) -> None:
        """Delete what neither the former base nor the new one refers to."""
        for number in self._ids("log"):
            if number <= former.number:
                remove(self.spark, f"{self.root}/log/id={number}")
        alive = {(k, b) for written_by in (former.written_by, owners) for b, k in written_by.items()}
        for number in self._ids("base"):
            folder = f"{self.root}/base/id={number}"
            names = [n for n in names_in(self.spark, folder) if n.startswith("bucket=")]
            dead = [n for n in names if (number, int(n.removeprefix("bucket="))) not in alive]
            if len(dead) == len(names):
                remove(self.spark, folder)
            else:
                for name in dead:
                    remove(self.spark, f"{folder}/{name}")

    def _ids(self, kind: str) -> list[int]:
        """The folders of a kind: those since the last compaction but one."""
        names = names_in(self.spark, f"{self.root}/{kind}")
        return sorted(int(n.removeprefix("id=")) for n in names if n.startswith("id="))

    def _publish(self, kind: str, number: int, manifest: list[tuple] | None = None) -> None:
        folder = f"{self.root}/published-{kind}"
        rows = self.spark.createDataFrame(manifest, _MANIFEST) if manifest else self.spark.createDataFrame([(number,)], "id long")
        overwrite(rows.coalesce(1), f"{folder}/id={number}")
        for old in self._published(kind)[:-2]:
            remove(self.spark, f"{folder}/id={old}")

    def _published(self, kind: str) -> list[int]:
        """Published ids, oldest first: folders whose write has been committed, a handful at most."""
        folder = f"{self.root}/published-{kind}"
        names = [n for n in names_in(self.spark, folder) if n.startswith("id=")]
        done = [n for n in names if "_SUCCESS" in names_in(self.spark, f"{folder}/{n}")]
        return sorted(int(n.removeprefix("id=")) for n in done)

    def _newest(self, kind: str) -> int | None:
        found = self._published(kind)
        return found[-1] if found else None

    def _base(self) -> _Base | None:
        """The published base; its list has a row a bucket."""
        number = self._newest("base")
        if number is None:
            return None
        found = self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/published-base/id={number}").collect()
        written_by = {r["bucket"]: r["written_by"] for r in found if r["bucket"] is not None}
        return _Base(number, found[0]["buckets"], written_by)
