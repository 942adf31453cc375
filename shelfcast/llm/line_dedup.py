"""Line deduplication with levelled sorted runs of line hashes, in DataFrame functions only."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import ascii_lower, remove, shared_path, written

HASH = ["h1", "h2"]  # 128 bits of a key
BLANKS = " \t\n\x0b\x0c\r"
NO_ID = -(1 << 63)


def line_key(line: Column) -> Column:
    """A line without blanks at both ends, A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def line_hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(7), key).alias("h2")]


class LineRuns:
    """Sorted runs of (hash, n_docs, max_id), one for each batch at first.

    A run is a table bucketed and sorted by hash, so merging a batch with it shuffles the
    batch only. When a level holds ``fanout`` runs they are compacted into one of the next
    level; a corpus of b batches keeps about fanout * log(b) runs. A key is settled once a run
    counts it in ``min_docs`` documents. Batches have to come in falling order of id: then a
    settled key's largest id is known, and later batches leave it out by an anti-join.
    """

    def __init__(
        self, spark: SparkSession, min_docs: int = 3, fanout: int = 2, buckets: int | None = None
    ):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[tuple[str, str]]] = []

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name, _ in level]

    def _write(self, rows: DataFrame) -> tuple[str, str]:
        name = f"line_run_{uuid.uuid4().hex}"
        path = shared_path(self.spark, name)
        (
            rows.repartition(self.buckets, *HASH)
            .sortWithinPartitions(*HASH)
            .write.format("parquet")
            .option("path", path)
            .bucketBy(self.buckets, *HASH)
            .sortBy(*HASH)
            .saveAsTable(name)
        )
        return name, path

    @staticmethod
    def _merged(runs: list[DataFrame]) -> DataFrame:
        """One run of several. Runs are bucketed alike, so they merge by joins that move nothing.
        (A union of them grouped by hash is no substitute: Spark 4.1 takes such a union for
        grouped already and was seen to leave keys apart.)"""

        def merge(one: DataFrame, two: DataFrame) -> DataFrame:
            two = two.withColumnsRenamed({"n_docs": "n_more", "max_id": "other_id"})
            zero = F.lit(0).cast("long")
            return one.join(two, HASH, "full").select(
                *HASH,
                (F.coalesce("n_docs", zero) + F.coalesce("n_more", zero)).alias("n_docs"),
                F.greatest("max_id", "other_id").alias("max_id"),
            )

        return reduce(merge, runs)

    def add(self, lines: DataFrame) -> None:
        """Add a batch of (id, h1, h2): all lines of documents no earlier batch held."""
        batch = lines.select("id", *HASH).distinct()
        batch = batch.groupBy(*HASH).agg(
            F.count("*").alias("n_docs"), F.max("id").alias("max_id")
        )
        for run in self.runs():
            settled = run.where(F.col("n_docs") >= self.min_docs)
            batch = batch.join(settled.select(*HASH), HASH, "left_anti")
        self._put(batch, 0)

    def _put(self, rows: DataFrame, level: int) -> None:
        if len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(self._write(rows))
        if len(self.levels[level]) >= self.fanout:
            old, self.levels[level] = self.levels[level], []
            self._put(self._merged([self.spark.table(name) for name, _ in old]), level + 1)
            for name, path in old:
                self.spark.sql(f"DROP TABLE {name}")
                remove(self.spark, path)

    def drop(self) -> None:
        """Take all runs out of the catalog and the shared folder."""
        for level in self.levels:
            for name, path in level:
                self.spark.sql(f"DROP TABLE {name}")
                remove(self.spark, path)
        self.levels = []

    def repeated(self) -> DataFrame:
        """(h1, h2, max_id) of the keys found in ``min_docs`` documents or more."""
        found = self._merged(self.runs()).where(F.col("n_docs") >= self.min_docs)
        return found.select(*HASH, "max_id")


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 20,
    min_docs: int = 3,
    batches: int = 4,
    batch_docs: int = 100_000_000,
    fanout: int = 2,
) -> DataFrame:
    """Each row of ``docs``, all columns, with struct column ``deduped`` (n_lines, n_dropped,
    text). Keys of ``min_chars`` code points or more that ``min_docs`` documents hold lose all
    their lines but those of the largest id; a document is an id, whatever its rows. A null
    text is one empty line. Rows without an id count as one document below all others. A
    column that is named ``deduped`` already is replaced; an empty table gives an empty one.

    The hashes are computed once and written by batch, ids falling from batch to batch; the
    texts move once, for the join with the lines that go. There are ``batches`` of them, or as many
    as it takes for none to hold much more than ``batch_docs`` documents (ids are cut by quantiles;
    an id is never split). The run tables leave the catalog at the end.
    """
    spark = docs.sparkSession
    batches = max(batches, -(-docs.count() // batch_docs))
    id_ = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID))
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    ranks = [i / batches for i in range(1, batches)]
    cuts = docs.agg(F.percentile_approx(id_, ranks, max(1000, 10 * batches))).first()[0] if ranks else None
    lines = docs.select(id_.alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("t"))
    lines = lines.select(
        "id", "text_hash", F.posexplode(F.split("t", "\n", -1)).alias("pos", "line")
    )
    lines = lines.select("id", "text_hash", "pos", line_key(F.col("line")).alias("key"))
    lines = lines.where(F.length("key") >= min_chars).select(
        "id", "text_hash", "pos", *line_hashes(F.col("key"))
    )
    batch = sum(((F.col("id") < cut).cast("int") for cut in cuts or []), F.lit(0))
    path = shared_path(spark, "line-hashes")
    lines.withColumn("batch", batch).write.partitionBy("batch").parquet(path)
    schema = "id long, text_hash long, pos int, h1 long, h2 long, batch int"
    lines = spark.read.schema(schema).parquet(path)

    runs = LineRuns(spark, min_docs, fanout)
    for n in range(batches):
        runs.add(lines.where(F.col("batch") == n))
    # Written first, so that both sides of the join are plain shuffles, which adaptive execution
    # can cut where one line is very common.
    repeated = written(runs.repeated(), "repeated-lines")
    runs.drop()
    gone = lines.join(repeated, HASH).where(F.col("id") != F.col("max_id"))
    gone = gone.groupBy("id", "text_hash").agg(F.collect_set("pos").alias("gone"))

    names = [c for c in docs.columns if c != "deduped"]
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
        id_.alias("id"),
        F.xxhash64(text).alias("text_hash"),
    )
    joined = whole.join(gone, ["id", "text_hash"], "left")
    body = F.coalesce(F.col("row").getField(text_col), F.lit(""))
    split = joined.withColumn("__lines", F.split(body, "\n", -1))
    n_lines = F.size("__lines")
    kept = F.array_except(F.sequence(F.lit(0), n_lines - 1), F.col("gone"))
    rest = F.array_join(F.transform(kept, lambda i: F.col("__lines")[i]), "\n")
    deduped = F.struct(
        n_lines.cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), body).otherwise(rest).alias("text"),
    )
    return split.withColumn("__deduped", deduped).select(
        "row.*", F.col("__deduped").alias("deduped")
    )
