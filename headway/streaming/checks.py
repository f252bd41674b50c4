"""Declared checks on a stream of a model's rows.

Every micro-batch is read once: rows that pass the row-level checks go to ``good``, the others
to ``quarantine`` with the names of the checks they fail, and what each check counted is
observed on that write. Uniqueness needs all batches: a table by bucket of the key holds how
often each key has come, and a batch adds to the buckets it touches. The totals are those of the
checks over all rows at once.

    <target>/rows/batch=3/outcome=good/part-*.parquet
    <target>/counts/batch=3/part-*.parquet

A repeated batch replaces its own folders, and the key table's pointer notes the last batch it
has taken, so no key is counted twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from headway.operators.quality import CHECKS, Check, failed_checks, own_checks
from headway.sources.table import BUCKETS, PART, StoredTable
from headway.streaming import triggered

GOOD, QUARANTINE = "good", "quarantine"
_FOUND = "array<struct<column:string,test:string,failures:bigint>>"


def _keys(check: Check) -> list[str]:
    return [name.strip() for name in check.column.split(",")]


class StreamChecks:
    """The checks of one model over a stream of rows with the given columns."""

    def __init__(
        self, spark: SparkSession, model: str, target: str, checks: tuple[Check, ...] = CHECKS, buckets: int = BUCKETS
    ):
        own = own_checks(model, checks)
        if not own:
            raise ValueError("no checks are declared for this model")
        self.spark, self.model, self.target, self.checks = spark, model, target.rstrip("/"), checks
        self.by_row = [c for c in own if c.test != "unique"]
        self.unique = [c for c in own if c.test == "unique"]
        self.buckets = buckets

    def _key_table(self, check: Check, rows: DataFrame | None = None) -> StoredTable:
        """How often each key has come; without rows, which give the types of the keys, only
        the counts."""
        keys = _keys(check)
        held = [] if rows is None else [f"{c} {rows.schema[c].dataType.simpleString()}" for c in keys]
        part = F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("string")
        return StoredTable(self.spark, f"{self.target}/keys_{'_'.join(keys)}", ", ".join([*held, "rows_of_key bigint"]), part)

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        marked = batch.withColumn("failed", failed_checks(self.model, self.checks))
        counted = Observation()
        failures = [
            F.count_if(F.array_contains("failed", f"{c.test}({c.column})")).alias(f"check_{i}")
            for i, c in enumerate(self.by_row)
        ]
        outcome = F.when(F.size("failed") == 0, GOOD).otherwise(QUARANTINE).alias("outcome")
        rows = marked.select("*", outcome).observe(counted, F.count("*").alias("rows"), *failures)
        rows.write.mode("overwrite").partitionBy("outcome").parquet(f"{self.target}/rows/batch={batch_id}")
        found = counted.get
        results = [
            F.struct(F.lit(c.column).alias("column"), F.lit(c.test).alias("test"), F.lit(found[f"check_{i}"]).cast("bigint").alias("failures"))
            for i, c in enumerate(self.by_row)
        ]
        notes = self.spark.range(0, 1, 1, 1).select(F.lit(found["rows"]).cast("bigint").alias("rows"), F.array(*results).cast(_FOUND).alias("found"))
        notes.write.mode("overwrite").parquet(f"{self.target}/counts/batch={batch_id}")
        for check in self.unique:
            self._count_keys(check, batch, batch_id)

    def _count_keys(self, check: Check, batch: DataFrame, batch_id: int) -> None:
        """Adds the batch's keys; tasks count their own rows first, so a key with a third of the
        rows is shuffled as one row per task. Keys with a null never fail and are not held."""
        keys = _keys(check)
        table = self._key_table(check, batch)
        at = table.pointer()
        if at.notes.get("batch", -1) >= batch_id:
            return
        present = batch.dropna(subset=keys)
        new = present.groupBy(*keys).agg(F.count("*").alias("rows_of_key")).withColumn(PART, table.part)
        path = f"{table.path}/staging/batch={batch_id}"
        seen = Observation()
        new.observe(seen, F.collect_set(PART).alias("parts")).write.mode("overwrite").parquet(path)
        new = self.spark.read.schema(new.schema).parquet(path).drop(PART)
        parts = sorted(seen.get["parts"])
        summed = table.read(parts, at=at).unionByName(new).groupBy(*keys).agg(F.sum("rows_of_key").alias("rows_of_key"))
        table.replace(summed, parts, at, batch=batch_id)
        table._delete(path)

    def start(self, rows: DataFrame, checkpoint: str, every: str | None = None) -> StreamingQuery:
        writer = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(self.apply)
        return triggered(writer, every).start()

    def rows(self, schema: str, outcome: str) -> DataFrame:
        """The good rows, or those in quarantine with the checks they fail."""
        stored = f"{schema}, failed array<string>, batch bigint, outcome string"
        found = self.spark.read.schema(stored).parquet(f"{self.target}/rows").where(F.col("outcome") == outcome)
        return found.drop("batch", "outcome", *(["failed"] if outcome == GOOD else []))

    def totals(self) -> DataFrame:
        """One row per check: model, column, test, failures, as the checks over all rows give."""
        stored = f"found {_FOUND}, batch bigint"
        notes = self.spark.read.schema(stored).parquet(f"{self.target}/counts")
        found = notes.select(F.inline("found")).groupBy("column", "test").agg(F.sum("failures").alias("failures"))
        for check in self.unique:
            repeated = self._key_table(check).read().agg(F.count_if(F.col("rows_of_key") > 1).alias("failures"))
            found = found.unionByName(
                repeated.select(F.lit(check.column).alias("column"), F.lit(check.test).alias("test"), "failures")
            )
        return found.select(F.lit(self.model).alias("model"), "column", "test", "failures")
