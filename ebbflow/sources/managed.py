"""Tables made of parts behind a manifest.

A part is a folder of Parquet files. It counts once a manifest row names it, and the row with the
highest version holds for each part, so:

* a batch that is put again replaces itself, and files of a run that failed before its manifest
  row are never read (repeatable append, S7);
* an upsert rewrites the parts (ranges of a key's hash) that hold its keys and commits all
  of them with one manifest file (S9).

A version is one folder of the manifest, written by Spark's committer and refused if it exists:
of two writers that started from the same version one fails and can run again.

The database's column rules become columns: ``created_at`` is set once, ``updated_at`` moves when
a value changes, defaults fill absent and NULL values, and a surrogate key counts up without
gaps in key order, from one batch to the next.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ebbflow.operators.stats import ordered_index
from ebbflow.sources.io import _exists

MANIFEST = "part string, path string, n_rows long, version long"


@dataclass
class ManagedTable:
    """A table folder with its schema; ``key``, ``surrogate`` and ``defaults`` are for upserts."""

    spark: SparkSession
    path: str
    schema: T.StructType
    key: str | None = None
    surrogate: str | None = None
    defaults: Mapping[str, object] = field(default_factory=dict)
    n_parts: int = 64

    def manifest(self) -> dict[str, dict]:
        """The row that holds for each part: as many rows as parts reach the driver."""
        if not _exists(self.spark, f"{self.path}/manifest"):
            return {}
        rows = self.spark.read.schema(MANIFEST).json(f"{self.path}/manifest/*")
        last = rows.groupBy("part").agg(F.max_by(F.struct(*rows.columns), "version").alias("m")).select("m.*")
        return {r["part"]: r.asDict() for r in last.collect()}

    def version(self) -> int:
        """The number of commits so far."""
        if not _exists(self.spark, f"{self.path}/manifest"):
            return 0
        return self.spark.read.schema(MANIFEST).json(f"{self.path}/manifest/*").agg(F.max("version")).first()[0] or 0

    def read(self) -> DataFrame:
        paths = sorted(r["path"] for r in self.manifest().values())
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def stage(self, df: DataFrame) -> str:
        """Write files that no manifest row names yet."""
        path = f"{self.path}/data/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return path

    def commit(self, parts: Mapping[str, tuple[str, int]], version: int) -> None:
        rows = [(part, path, n, version) for part, (path, n) in sorted(parts.items())]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("error").json(f"{self.path}/manifest/{version:012d}")

    def put(self, batch_id: str, df: DataFrame) -> int:
        """Append the rows of a batch, or replace them if the batch was put before; their number."""
        version = self.version() + 1
        path = self.stage(df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema]))
        n = self.spark.read.schema(self.schema).parquet(path).count()
        self.commit({f"batch-{batch_id}": (path, n)}, version)
        return n

    def upsert(self, rows: DataFrame, now: datetime) -> dict[str, int]:
        """Insert rows with new keys and update rows whose key is known; how many of each.

        Columns that ``rows`` lacks keep their value (a default or NULL for new keys). A row that
        changes nothing is left as it is, so running a batch again changes nothing. Rows without a key
        are refused; of rows that share a key the one with the largest values, column by column, counts."""
        spark, key = self.spark, self.key
        audit = {"created_at", "updated_at"} | ({self.surrogate} if self.surrogate else set())
        names = [f.name for f in self.schema if f.name not in audit]
        given = [n for n in names if n in rows.columns]
        if key not in given:
            raise ValueError(f"rows have no column {key}")
        kinds = {f.name: f.dataType for f in self.schema}
        part = F.pmod(F.xxhash64(key), F.lit(self.n_parts)).cast("int").alias("_part")
        new = rows.select(*[F.col(n).cast(kinds[n]).alias(n) for n in given])
        if new.where(F.col(key).isNull()).limit(1).count():
            raise ValueError(f"rows without {key}")
        new = new.groupBy(key).agg(F.max(F.struct(*[n for n in given if n != key])).alias("_v")).select(
            key, *[F.col("_v")[n].alias(n) for n in given if n != key])
        for name, value in self.defaults.items():
            if name in given:
                new = new.withColumn(name, F.coalesce(F.col(name), F.lit(value).cast(kinds[name])))
        new = new.withColumn("_part", part)
        version, held = self.version() + 1, self.manifest()
        touched = {str(r["_part"]) for r in new.select("_part").distinct().collect()}  # at most n_parts rows
        if not touched:
            return {"inserted": 0, "updated": 0}
        paths = [held[p]["path"] for p in touched if p in held]
        old = spark.read.schema(self.schema).parquet(*paths) if paths else spark.createDataFrame([], self.schema)
        stamp = F.lit(now).cast("timestamp")
        o, n = old.withColumn("_part", part).withColumn("_old", F.lit(True)).alias("o"), new.withColumn("_new", F.lit(True)).alias("n")
        both = o.join(n, key, "full")
        is_new, known = F.col("_new").isNotNull(), F.col("_old").isNotNull()
        differs = F.lit(False)
        for c in given:
            if c != key:
                differs = differs | ~F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}"))
        state = F.when(is_new & ~known, "inserted").when(is_new & differs, "updated").otherwise("kept")
        columns = [F.col(key), F.coalesce("n._part", "o._part").alias("_part"), state.alias("_state")]
        for c in names:
            if c == key:
                continue
            default = F.lit(self.defaults.get(c)).cast(kinds[c])
            value = F.when(is_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")) if c in given else F.when(known, F.col(f"o.{c}")).otherwise(default)
            columns.append(value.alias(c))
        if "created_at" in kinds:
            columns.append(F.when(known, F.col("o.created_at")).otherwise(stamp).alias("created_at"))
        if "updated_at" in kinds:
            columns.append(F.when(state == "kept", F.col("o.updated_at")).otherwise(stamp).alias("updated_at"))
        if self.surrogate:
            columns.append(F.col(f"o.{self.surrogate}").alias(self.surrogate))
        merged = spark.read.parquet(self.stage(both.select(*columns)))  # read twice below, and cut from the join
        count = {r["_state"]: r["count"] for r in merged.groupBy("_state").count().collect()}
        if count.keys() <= {"kept"}:
            return {"inserted": 0, "updated": 0}
        if self.surrogate and count.get("inserted"):
            last = self.read().agg(F.max(self.surrogate)).first()[0] or 0
            numbered = ordered_index(merged.where("_state = 'inserted'").select(key), [key], "_i")
            merged = merged.join(numbered, key, "left").withColumn(
                self.surrogate, F.coalesce(F.col(self.surrogate), F.col("_i") + 1 + last).cast(kinds[self.surrogate])).drop("_i")
        path = f"{self.path}/data/{uuid.uuid4().hex}"
        (merged.select("_part", *[f.name for f in self.schema]).repartition("_part").sortWithinPartitions("_part", key)
         .write.partitionBy("_part").parquet(path))
        sizes = {str(r["_part"]): r["count"] for r in spark.read.parquet(path).groupBy("_part").count().collect()}
        self.commit({p: (f"{path}/_part={p}", n) for p, n in sizes.items()}, version)
        return {k: count.get(k, 0) for k in ("inserted", "updated")}
