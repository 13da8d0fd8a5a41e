"""A table with a key, dealt into buckets, so that a merge touches its buckets only.

Rows lie in ``data/<commit>/_bucket=<b>``, files that never change; a version (see
``sources.versions``) lists for each bucket the folders that hold it.  A merge writes the
folders of the buckets it changes and publishes the next version; readers go on with the one
they have.  Keys are hashed, so buckets are even.

Beside each folder lies a blocked Bloom filter of its keys (eight 32-bit words a block).  An
insert asks the filters of its buckets, reads only buckets that may hold one of its keys,
compares those keys exactly, and appends what is new.

What the driver holds is the version's record: a few names for each bucket.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlens.operators.joins import checked_broadcast
from fraudlens.operators.warehouse import duplicate_keys, first_per_key, require_not_null
from fraudlens.session import scratch_dir
from fraudlens.sources.versions import VersionLog

BUCKET = "_bucket"
#: Bits of a filter for each key, words of a block.
BITS_PER_KEY, WORDS = 16, 8
#: Folders of a bucket before an insert rewrites it as one.
MOST_PARTS = 8
FILTER = "commit STRING, bucket INT, block BIGINT, " + ", ".join(f"w{i} INT" for i in range(WORDS))


def _masks(key: str) -> list[Column]:
    bits = F.xxhash64(F.lit("bits"), key)
    return [F.call_function("shiftleft", F.lit(1), F.shiftright(bits, 5 * i).bitwiseAND(F.lit(31)).cast("int")) for i in range(WORDS)]


def _block(key: str) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), key), F.col("blocks"))


class KeyedTable:
    """``KeyedTable(spark, path, schema, key)`` opens the table at ``path``; the first merge
    creates it with ``buckets`` buckets, later ones keep their number."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int = 64):
        self.spark, self.path, self.schema, self.key = spark, path.rstrip("/"), schema, key
        self.log = VersionLog(spark, f"{self.path}/versions")
        self.buckets = self.log.read().get("buckets", buckets)

    def _rows(self, record: dict, only=None) -> DataFrame:
        wanted = record.get("parts", {}) if only is None else {b: record.get("parts", {}).get(str(b), []) for b in only}
        paths = [f"{self.path}/data/{p['commit']}/{BUCKET}={b}" for b, parts in wanted.items() for p in parts]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, by default the current one."""
        return self._rows(self.log.read(version))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.lit("bucket"), self.key), F.lit(self.buckets)).cast("int")

    def _staged(self, batch: DataFrame) -> DataFrame:
        """The batch, written once, with each row's bucket."""
        path = scratch_dir(self.spark, "batch")
        rows = require_not_null(batch.select(*self.schema.fieldNames()), [self.key], "batch").withColumn(BUCKET, self._bucket())
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    @staticmethod
    def _buckets_of(rows: DataFrame) -> list[int]:
        return sorted(r[0] for r in rows.select(BUCKET).distinct().collect())

    def _commit(self, number: int, record: dict, rows: DataFrame, replaced: list[int]) -> dict:
        """Write ``rows`` (with their bucket) and their filters, publish: they take the place of the
        buckets in ``replaced`` and are added to others."""
        commit = uuid.uuid4().hex
        rows.hint("rebalance", F.col(BUCKET)).write.partitionBy(BUCKET).parquet(f"{self.path}/data/{commit}")
        full = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        keys = self.spark.read.schema(full).parquet(f"{self.path}/data/{commit}").select(self.key, BUCKET)
        counts = {r[BUCKET]: r["count"] for r in keys.groupBy(BUCKET).count().collect()}
        blocks = {b: -(-n * BITS_PER_KEY // (32 * WORDS)) for b, n in counts.items()}
        if counts:
            sizes = self.spark.createDataFrame(list(blocks.items()), f"{BUCKET} INT, blocks BIGINT")
            words = [F.bit_or(m).alias(f"w{i}") for i, m in enumerate(_masks(self.key))]
            made = keys.join(F.broadcast(sizes), BUCKET).groupBy(BUCKET, _block(self.key).alias("block")).agg(*words)
            made = made.select(BUCKET, F.lit(commit).alias("commit"), F.col(BUCKET).alias("bucket"), "block", *[f"w{i}" for i in range(WORDS)])
            made.hint("rebalance", F.col(BUCKET)).write.partitionBy(BUCKET).parquet(f"{self.path}/filters/{commit}")
        parts = dict(record.get("parts", {}))
        for b in replaced:
            parts.pop(str(b), None)
        for b, n in blocks.items():
            parts[str(b)] = [*parts.get(str(b), []), {"commit": commit, "blocks": n}]
        self.log.publish(number + 1, {"buckets": self.buckets, "key": self.key, "parts": parts})
        return {"version": number + 1, "commit": commit, "written": sorted(counts)}

    def upsert(self, batch: DataFrame) -> dict:
        """Insert new keys, replace rows of existing keys.  Buckets without a changed row aren't
        written, and a batch that changes nothing makes no version.  A key twice in the
        batch is an error."""
        number = self.log.number()
        record = self.log.read(number)
        staged = self._staged(batch)
        if not duplicate_keys(staged, self.key).isEmpty():
            raise ValueError(f"upsert batch has duplicate keys on {self.key}")
        asked = self._buckets_of(staged)
        old = self._rows(record, asked).join(checked_broadcast(staged.select(self.key)), self.key, "left_semi")
        columns = self.schema.fieldNames()
        before = old.select(F.col(self.key), F.struct(*columns).alias("_before"))
        compared = staged.join(before, self.key, "left").withColumn("_new", F.col("_before").isNull())
        path = scratch_dir(self.spark, "changed")
        compared.where(~F.struct(*columns).eqNullSafe(F.col("_before"))).select(*columns, BUCKET, "_new").write.parquet(path)
        changed = self.spark.read.parquet(path)
        replaced = self._buckets_of(changed.where("NOT _new"))
        written = self._buckets_of(changed)
        if not written:
            return {"version": number, "commit": None, "written": [], "read": asked}
        rows = changed.select(*columns, BUCKET)
        kept = self._rows(record, replaced).join(checked_broadcast(rows.select(self.key)), self.key, "left_anti")
        rows = rows.unionByName(kept.withColumn(BUCKET, self._bucket()))
        return self._commit(number, record, rows, replaced) | {"read": asked}

    def insert_if_absent(self, batch: DataFrame, order_by: list[str]) -> dict:
        """Append rows whose key is new; of a key's rows in the batch the first by ``order_by``."""
        number = self.log.number()
        record = self.log.read(number)
        staged = self._staged(first_per_key(batch.select(*self.schema.fieldNames()), self.key, order_by))
        maybe = self._may_hold(record, staged)
        read = self._buckets_of(maybe)
        present = self._rows(record, read).join(checked_broadcast(maybe.select(self.key)), self.key, "left_semi").select(self.key)
        path = scratch_dir(self.spark, "fresh")
        staged.join(checked_broadcast(present), self.key, "left_anti").write.parquet(path)
        fresh = self.spark.read.schema(staged.schema).parquet(path)
        written = self._buckets_of(fresh)
        if not written:
            return {"version": number, "commit": None, "written": [], "read": read}
        many = [b for b in written if len(record.get("parts", {}).get(str(b), [])) >= MOST_PARTS]
        rows = fresh.unionByName(self._rows(record, many).withColumn(BUCKET, self._bucket())) if many else fresh
        return self._commit(number, record, rows, many) | {"read": read}

    def _may_hold(self, record: dict, staged: DataFrame) -> DataFrame:
        """Keys of ``staged``, and their bucket, that a filter of their bucket lets pass."""
        asked = self._buckets_of(staged)
        parts = [(b, p["commit"], p["blocks"]) for b in asked for p in record.get("parts", {}).get(str(b), [])]
        if not parts:
            return staged.select(self.key, BUCKET).limit(0)
        sizes = self.spark.createDataFrame(parts, f"{BUCKET} INT, commit STRING, blocks BIGINT")
        probes = staged.select(self.key, BUCKET).join(F.broadcast(sizes), BUCKET).withColumn("block", _block(self.key))
        filters = self.spark.read.schema(FILTER).parquet(*[f"{self.path}/filters/{c}/{BUCKET}={b}" for b, c, _ in parts])
        passed = F.lit(True)
        for i, mask in enumerate(_masks(self.key)):
            passed = passed & (F.col(f"w{i}").bitwiseAND(mask) != 0)
        found = filters.withColumnRenamed("bucket", BUCKET).join(checked_broadcast(probes), [BUCKET, "commit", "block"]).where(passed)
        path = scratch_dir(self.spark, "maybe")
        found.select(self.key, BUCKET).distinct().write.parquet(path)
        return self.spark.read.parquet(path)
