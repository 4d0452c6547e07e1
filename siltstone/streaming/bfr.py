"""Bradley-Fayyad-Reina clustering of chunk files as they arrive, which can be stopped between chunks.

A micro-batch takes the chunks of its files, in the order of their names, into the model of the
micro-batch before it, and writes the model as a version of its own. A version has the statistics of
all clusters, which merges there were, the rounds, and where the points are; points stay in tables.
A micro-batch that is run again reads the same version and writes the same one again. The last merge,
of compression clusters into discard clusters, is made whenever the result is asked for, and the
stream goes on from the sets before it.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators.bfr import LEFT, TABLE_SCHEMA, BfrResult, Limits, Sets, finished, fold_chunk
from ..operators.nearest import ClusterStats, stats_from_arrow
from ..session import delete
from ..sources.readers import parse_points

KEPT_VERSIONS = 3
_CLUSTERS = "cluster bigint, n bigint, mean array<double>, mean_square array<double>, set string"
_FACTS = "version bigint, facts string"
_JOINED = "cluster bigint, into bigint"
_POINTS = "id bigint, vec array<double>, chunk string"


def stream_points(spark: SparkSession, path: str, dimensions: int | None = None, by_folder: bool = False, **options: str) -> DataFrame:
    """Stream of ``(id, vec, chunk)`` from CSV files; the chunk is the name of the file, or of its folder."""
    lines = spark.readStream.options(**options).text(path)
    name = F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)/[^/]+$", 1) if by_folder else F.col("_metadata.file_name")
    return parse_points(lines.select("value", name.alias("chunk")), dimensions)


@dataclass(frozen=True)
class ChunkedBfr:
    """Clustering into ``k`` clusters with its state below ``folder``; parameters are those of ``bfr``.

    A chunk is what ``chunk`` says within one micro-batch, so the files of a chunk have to arrive together.
    """

    folder: str
    k: int
    alpha: float = 3.0
    seed: int = 666
    match: str = "first"
    assign_first: bool = False
    include_previous: bool = False
    limits: Limits = Limits()

    def fold(self, batch: DataFrame, number: int) -> None:
        """What a micro-batch does."""
        spark = batch.sparkSession
        points = f"{self.folder}/points/batch={number}"
        # Written by chunk, so that each round reads its own points and lines are parsed once.
        batch.select("id", "vec", "chunk").write.mode("overwrite").partitionBy("chunk").parquet(points)
        arrived = spark.read.schema(_POINTS).parquet(points)
        names = sorted(row.chunk for row in arrived.select("chunk").distinct().collect())
        sets = self._load(spark, number - 1)
        for name in names:
            part = arrived.where(F.col("chunk") == name).select("id", "vec")
            fold_chunk(sets, part, self.alpha, self.assign_first, self.include_previous)
        self._save(sets, number)
        # Members and points left over have been written by their round.
        delete(spark, points)

    def writer(self, stream: DataFrame, checkpoint: str, interval: str | None = "5 seconds") -> DataStreamWriter:
        """Writer of a stream ``(id, vec, chunk)``; ``interval=None`` reads what is there and stops."""
        writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(self.fold)
        return writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)

    def result(self, spark: SparkSession) -> BfrResult:
        """Labels, rounds and summaries, as if the chunks so far were all."""
        return finished(self._load(spark, None), self.alpha, self.match)

    # versions

    def _path(self, name: str, number: int) -> str:
        return f"{self.folder}/{name}/slot={number % KEPT_VERSIONS}"

    def _save(self, sets: Sets, number: int) -> None:
        spark = sets.spark
        both = [(name, stats) for name, stats in (("DS", sets.discard), ("CS", sets.compression)) if len(stats)]
        clusters = spark.createDataFrame([], _CLUSTERS)
        for name, stats in both:
            clusters = clusters.unionByName(stats.frame(spark).withColumn("set", F.lit(name)))
        clusters.write.mode("overwrite").parquet(self._path("clusters", number))
        joined = pa.table({"cluster": pa.array(list(sets.joined), pa.int64()), "into": pa.array(list(sets.joined.values()), pa.int64())})
        spark.createDataFrame(joined).write.mode("overwrite").parquet(self._path("joined", number))
        facts = {
            "tables": [path.removeprefix(f"{self.folder}/") for path in sets.tables], "next_key": sets.next_key, "pools": sets.pools,
            "n_retained": sets.n_retained, "records": sets.records,
        }
        last = spark.createDataFrame([(number, json.dumps(facts))], _FACTS)
        last.write.mode("overwrite").parquet(self._path("facts", number))

    def _load(self, spark: SparkSession, number: int | None) -> Sets:
        """The sets of version ``number``, or of the newest."""
        if number == -1:
            return Sets(spark, f"{self.folder}/sets", self.k, self.seed, self.limits)
        rows = spark.read.schema(_FACTS).parquet(f"{self.folder}/facts/*").collect()
        row = max((row for row in rows if number in (None, row.version)), key=lambda row: row.version)
        facts = json.loads(row.facts)
        clusters = spark.read.schema(_CLUSTERS).parquet(self._path("clusters", row.version))
        joined = spark.read.schema(_JOINED).parquet(self._path("joined", row.version)).toArrow()
        tables = [f"{self.folder}/{path}" for path in facts["tables"]]
        left = spark.read.schema(TABLE_SCHEMA).parquet(tables[-1]).where(F.col("kind") == LEFT).select("id", "vec") if tables else None

        def stats(name: str) -> ClusterStats:
            return stats_from_arrow(clusters.where(F.col("set") == name).drop("set").toArrow())

        return Sets(
            spark, f"{self.folder}/sets", self.k, self.seed, self.limits, stats("DS"), stats("CS"), left, facts["n_retained"],
            facts["next_key"], dict(zip(joined.column("cluster").to_pylist(), joined.column("into").to_pylist())), tables,
            facts["pools"], [tuple(record) for record in facts["records"]],
        )
