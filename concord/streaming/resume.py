"""Directories that keep filling: what is new is taken once, by a checkpointed stream that ends when it has caught up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.functions.cells import norm_contig
from concord.operators import diff
from concord.sources.store import Store, publish, published_in


def ingest_new(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, by: tuple[str, ...] = ()) -> None:
    """Takes the files of source that no earlier call with this checkpoint has taken, and adds them to target."""
    stream = spark.readStream.schema(schema).parquet(source)
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    (writer.partitionBy(*by) if by else writer).start(target).awaitTermination()


#: What a batch leaves: its tally and, where n is null, the shards and files that it took. turn: 1 for what a delivery's end
#: counts anew.
_STATE = "run string, contig string, field string, category string, n long, file string, batch long, turn int"
_BY = ["run", "contig"]


def _among(rows: DataFrame, some: DataFrame, how: str = "left_semi", contig: Column | None = None) -> DataFrame:
    """Rows that are in some by all of its columns, nulls being equal; contig: what rows have for that column."""
    named = some.select(*[F.col(c).alias(f"__{c}") for c in some.columns])
    at = lambda c: contig if c == "contig" and contig is not None else F.col(c)
    return rows.join(F.broadcast(named), [at(c).eqNullSafe(F.col(f"__{c}")) for c in some.columns], how)


def _shards(records: DataFrame, *more: Column) -> DataFrame:
    """Distinct (run, contig, more); contigs are normalised once few are left."""
    return records.select(*_BY, *more).distinct().withColumn("contig", norm_contig(F.col("contig"))).distinct()


class Incremental:
    """A reconciliation that goes on as shards of the candidate land.

    source: a folder of Parquet files of records (run, contig, pos, ref, alt, packed, seq). What lands between two calls of
    run() is one delivery, in which a shard (run, contig) is whole, in any number of files; a call that fails is carried on
    by the next one. A shard that lands again in a later delivery replaces what it gave before. truth: records of all shards.

    Each batch joins its shards with theirs of the truth and publishes their tally, with the shards and files that it took,
    under its number in target: a batch which is run again puts the same in the place of the same, at once. Shards that
    several batches of a delivery have parts of are joined once more, whole, when it ends; until then their last part counts.
    What the truth alone has is joined when it is asked for."""

    def __init__(self, truth: DataFrame, target: str, n_fields: int, fields: list[str], flags: dict, needs: dict):
        self.truth, self.target = truth, target
        self.n_fields, self.fields, self.flags, self.needs = n_fields, fields, flags, needs
        self.spark = truth.sparkSession

    def batch(self, candidate: DataFrame, number: int) -> None:
        """Takes the shards of candidate as the batch of that number; a column __file names the file of each record."""
        self._put(candidate, number, 0)

    def again(self, source: str, schema: str, number: int | None = None) -> None:
        """Runs a batch again over the files that it took, the last one if no number is given."""
        number = self._last(0) if number is None else number
        if (number, 0) not in self._tables():
            raise ValueError(f"there was no batch {number}")
        self.batch(self._files(source, schema, self._rows(lambda n, turn: (n, turn) == (number, 0)).where("n is null")), number)

    def run(self, source: str, schema: str, checkpoint: str, files: int | None = None) -> None:
        """Takes what has landed since the last call with this checkpoint; files: at most so many files in a batch."""
        reader = self.spark.readStream.schema(schema)
        stream = (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(source).select("*", F.col("_metadata.file_path").alias("__file"))
        stream.writeStream.foreachBatch(lambda df, n: self.batch(df, n)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
        self._end(source, schema)

    def tally(self, rest: bool = False) -> DataFrame:
        """diff.tally() of all shards that have landed, each as its latest delivery gave it; rest: and of those that only the
        truth has."""
        rows = self._rows()
        latest = rows.where("n is null").groupBy(*_BY).agg(F.max(F.struct("batch", "turn")).alias("at")).select(*_BY, "at.*")
        counted = _among(rows.where("n is not null"), latest).drop("file", "batch", "turn")
        if rest:
            missing = _among(_shards(self.truth), latest.select(*_BY), "left_anti")
            counted = counted.unionByName(self._counted(self.truth.where("false"), missing))
        return counted

    def _counted(self, candidate: DataFrame, shards: DataFrame) -> DataFrame:
        truth = _among(self.truth, shards, contig=norm_contig(F.col("contig")))
        joined = diff.align_matched(diff.match_records(candidate, truth, self.n_fields), self.n_fields)
        return diff.tally(joined, self.fields, self.flags, self.needs)

    def _put(self, candidate: DataFrame, number: int, turn: int) -> None:
        store = Store(self.spark, "landed")
        file = F.col("__file") if "__file" in candidate.columns else F.lit(None).cast("string")
        landed = store.put(_shards(candidate, file.alias("file")))
        rows = self._counted(candidate, landed.select(*_BY).distinct()).unionByName(landed, allowMissingColumns=True)
        self._publish(rows, number, turn)
        store.drop(landed)

    def _publish(self, rows: DataFrame, number: int, turn: int) -> None:
        publish(rows.withColumns({"batch": F.lit(number).cast("long"), "turn": F.lit(turn)}), f"{self.target}/{number}-{turn}")

    def _end(self, source: str, schema: str) -> None:
        """Ends a delivery: shards with parts in several of its batches are joined whole, under the number of the last one."""
        ended, last = self._last(1), self._last(0)
        if last == ended:
            return
        landed = self._rows(lambda n, turn: n > ended and not turn).where("n is null")
        spread = landed.groupBy(*_BY).agg(F.countDistinct("batch").alias("batches")).where("batches > 1").select(*_BY)
        if spread.isEmpty():
            self._publish(landed.where("false"), last, 1)
        else:
            records = self._files(source, schema, _among(landed, spread))
            self._put(_among(records, spread, contig=norm_contig(F.col("contig"))), last, 1)

    def _files(self, source: str, schema: str, landed: DataFrame) -> DataFrame:
        """Records of the files that landed names; one that is gone is an error."""
        names = [r["file"] for r in landed.select("file").distinct().collect()]
        if None in names:
            raise ValueError("a batch that was given without the names of its files can't be read again")
        found = self.spark.read.schema(schema).option("basePath", source).parquet(*names) if names else self.spark.createDataFrame([], schema)
        return found.select("*", F.col("_metadata.file_path").alias("__file")) if names else found

    def _tables(self) -> dict[tuple[int, int], str]:
        return {tuple(map(int, name.split("-"))): path for name, path in published_in(self.spark, self.target).items()}

    def _last(self, turn: int) -> int:
        return max((n for n, at in self._tables() if at == turn), default=-1)

    def _rows(self, which: Callable[[int, int], bool] = lambda n, turn: True) -> DataFrame:
        found = [path for at, path in self._tables().items() if which(*at)]
        return self.spark.read.schema(_STATE).parquet(*found) if found else self.spark.createDataFrame([], _STATE)
