"""A table that a stream changes in place, bucket by bucket.

Rows lie in Parquet partitions by a hash of their key, and a micro-batch overwrites the partitions
its events fall into. Before it does, it keeps what it found there under its batch id. A batch
that runs again starts from that and so writes the same once more, wherever the first attempt
ended. The next batch drops it. Rows without a key belong to no bucket and are not kept.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class LiveTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int = 256):
        self.spark, self.path, self.schema, self.key, self.buckets = spark, path, schema, key, buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def replace(self, rows: DataFrame) -> None:
        """Write ``rows`` in place of all rows of the buckets they fall into."""
        # Rebalancing splits a bucket with very many rows over several tasks and files.
        (
            rows.select(self.schema.fieldNames())
            .withColumn("bucket", self.bucket())
            .hint("rebalance", "bucket")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("bucket")
            .parquet(self.path)
        )

    def replace_found(self, rows: DataFrame, found: DataFrame) -> None:
        """Write ``rows`` in place of ``found``; a bucket of which nothing is left keeps a row without a key."""
        left = rows.select(self.bucket().alias("b")).distinct()
        emptied = found.select(self.bucket().alias("bucket")).distinct().join(left, F.col("bucket") == F.col("b"), "left_anti")
        blank = emptied.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema], "bucket")
        (
            rows.select(self.schema.fieldNames())
            .withColumn("bucket", self.bucket())
            .unionByName(blank.select(*self.schema.fieldNames(), "bucket"))
            .hint("rebalance", "bucket")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("bucket")
            .parquet(self.path)
        )

    def read(self) -> DataFrame:
        return self._scan().drop("bucket")

    def found_by(self, batch_id: int, events: DataFrame) -> DataFrame:
        """Rows of the buckets of ``events`` as the batch found them, also when it runs again."""
        mine, last = (f"{self.path}-found/batch={n:012d}" for n in (batch_id, batch_id - 1))
        system = self._file_system(mine)
        if not system.exists(self._jvm_path(f"{mine}/_SUCCESS")):
            touched = events.select(self.bucket().alias("b")).distinct().collect()
            rows = self._scan().where(F.col("bucket").isin([r.b for r in touched if r.b is not None]))
            rows.drop("bucket").write.mode("overwrite").parquet(mine)
        system.delete(self._jvm_path(last), True)
        return self.spark.read.schema(self.schema).parquet(mine)

    def _scan(self) -> DataFrame:
        schema = T.StructType([*self.schema, T.StructField("bucket", T.IntegerType())])
        return self.spark.read.schema(schema).parquet(self.path).where(F.col(self.key).isNotNull())

    def _jvm_path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _file_system(self, path: str):
        return self._jvm_path(path).getFileSystem(self.spark._jsc.hadoopConfiguration())
