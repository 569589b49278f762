"""Several tables that become visible together: one commit record a batch (F9, D11 over windows, D13)."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.order import dense_sequence
from ..sources.scratch import forget, materialize


class TableSet:
    """Tables in one folder; a batch of all of them counts once its commit record is there.

    A batch writes a folder in every table, then one record with the last sequence number, put in
    place by a rename. Readers take the batches that have a record, so a crash between writes
    leaves nothing to see, and the batch that is run again overwrites its own folders. One
    writer at a time: a stream's checkpoint sees to that.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _exists(self, path: str) -> bool:
        p, fs = self._fs(path)
        return fs.exists(p)

    def commits(self) -> DataFrame:
        """(batch, last_seq, tables) of the committed batches."""
        schema = "batch long, last_seq long, tables array<string>"
        if not self._exists(f"{self.path}/commits"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).json(f"{self.path}/commits")

    def is_committed(self, batch: int) -> bool:
        return self._exists(f"{self.path}/commits/{batch:012d}.json")

    def last_seq(self) -> int:
        """The last number given out; 0 before the first commit. One row."""
        return self.commits().agg(F.max("last_seq")).first()[0] or 0

    def read(self, table: str, schema: str | None = None) -> DataFrame:
        """Committed rows of a table; ``schema`` is for a table that no batch has written."""
        if not self._exists(f"{self.path}/{table}"):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.option("basePath", f"{self.path}/{table}").parquet(f"{self.path}/{table}")
        return rows.join(self.commits().select("batch"), "batch", "left_semi").drop("batch")

    def commit(self, batch: int, tables: dict[str, DataFrame], last_seq: Callable[[], int], between: Callable[[str], None] | None = None) -> None:
        """Write all tables of a batch, then its record. ``between`` is called after each table."""
        for name, rows in tables.items():
            rows.write.mode("overwrite").parquet(f"{self.path}/{name}/batch={batch}")
            if between:
                between(name)
        record = json.dumps({"batch": batch, "last_seq": last_seq(), "tables": sorted(tables)}) + "\n"
        draft, fs = self._fs(f"{self.path}/_drafts/{batch:012d}.json")
        place, _ = self._fs(f"{self.path}/commits/{batch:012d}.json")
        out = fs.create(draft, True)
        out.write(bytearray(record.encode()))
        out.close()
        fs.mkdirs(place.getParent())
        if not fs.rename(draft, place):
            raise OSError(f"batch {batch} is already committed at {self.path}")


def canonical_batch(store: TableSet, batch: DataFrame, no: int, record: str, content: str, seq: str, order: list[str], between: Callable[[str], None] | None = None) -> None:
    """Take a batch of deliveries into facts, identity and conflicts, all or nothing.

    Facts are the first deliveries of records, numbered densely by ``order``, on from the last
    committed number; identity keeps each record's content hash; later deliveries are kept with
    their verdict. Records are compared with all committed batches and inside the batch. A batch
    that is committed already is left alone.
    """
    if store.is_committed(no):
        return
    rows = materialize(batch.withColumn("_hash", F.sha2(F.col(content).cast("binary"), 256)), "batch")
    known = store.read("identity", f"{record} {rows.schema[record].dataType.simpleString()}, content_hash string")
    first = Window.partitionBy(record).orderBy(seq)
    judged = rows.join(known, record, "left").withColumn("_first", F.coalesce("content_hash", F.first("_hash").over(first)))
    verdict = F.when(F.col("content_hash").isNull() & (F.row_number().over(first) == 1), "unseen").when(F.col("_hash") == F.col("_first"), "duplicate").otherwise("conflict")
    judged = materialize(judged.withColumn("verdict", verdict), "judged")
    facts = materialize(dense_sequence(judged.where("verdict = 'unseen'").select(*batch.columns, "_hash"), order, "canonical_seq", store.last_seq() + 1), "facts")
    tables = {
        "facts": facts.drop("_hash"),
        "identity": facts.select(record, F.col("_hash").alias("content_hash")),
        "repeats": judged.where("verdict <> 'unseen'").select(*batch.columns, "verdict"),
    }
    before = store.last_seq()
    store.commit(no, tables, lambda: facts.agg(F.max("canonical_seq")).first()[0] or before, between)
    forget(rows, judged, facts)
