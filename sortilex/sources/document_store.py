"""Documents kept one row per id, whatever is stored twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ..storage import run_folder, shuffles_removed
from .commits import Commits

BUCKETS = 256
# A bucket of more pieces is rewritten by the next batch that touches it.
MAX_PIECES = 16
# Texts take much less space than with Spark's default.
COMPRESSION = "zstd"


class DocumentStore:
    """A folder of documents in hash buckets of ``key``.

    ``put`` replaces rows of the same id and adds the others. A bucket is rewritten
    only if a batch replaces an id in it, or if it has gathered too many pieces;
    to other buckets the batch adds a piece, and the files of buckets that it does
    not touch stay. A list of pieces per bucket says what holds (see ``Commits``), so
    a killed ``put`` changes nothing. The list has an entry per bucket and piece:
    ``buckets`` times ``MAX_PIECES`` at most, which the driver holds.

    The number of buckets is fixed by the first batch. Choose it so that a bucket is a
    file or a few: a thousandth of 100 TB is rewritten in the time of a few tasks.
    """

    def __init__(self, spark: SparkSession, path: str, key: str = "doc_id", buckets: int = BUCKETS) -> None:
        if buckets < 1:
            raise ValueError("buckets must be at least 1")
        self.spark, self.key, self.buckets = spark, key, buckets
        self.commits = Commits(spark, path)

    def _state(self) -> tuple[int, dict]:
        number, state = self.commits.current()
        if state and (state["key"], state["buckets"]) != (self.key, self.buckets):
            raise ValueError(
                f"the store has {state['buckets']} buckets of {state['key']!r}, "
                f"not {self.buckets} of {self.key!r}"
            )
        return number, state

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.buckets)).cast("int").alias("bucket")

    def _with_bucket(self, schema: T.StructType) -> T.StructType:
        return T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])

    def _pieces(self, state: dict, buckets: set[int] | None = None) -> DataFrame:
        """Rows and ``bucket`` of some buckets, all if None."""
        schema = self._with_bucket(T.StructType.fromJson(state["schema"]))
        wanted = {b: names for b, names in state["pieces"].items() if buckets is None or int(b) in buckets}
        paths = [f"{self.commits.attempt_path(n)}/bucket={b}" for b, names in wanted.items() for n in names]
        return self.commits.read_attempts(schema, paths)

    def read(self) -> DataFrame:
        """All documents; a store without a batch has none, and no schema to give them."""
        _, state = self._state()
        if not state:
            raise ValueError(f"nothing is stored at {self.commits.root}")
        return self._pieces(state).drop("bucket")

    def _dealt(self, rows: DataFrame) -> DataFrame:
        """Rows with ``bucket`` and ``__part``, moved so that those of one id meet.

        A bucket has several parts if there are fewer buckets than shuffle partitions,
        so that tasks stay as small; Spark joins small parts in shared tasks.
        """
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        part = F.pmod(F.shiftright(F.xxhash64(F.col(f"`{self.key}`")), 40), F.lit(max(1, tasks // self.buckets)))
        # Added, not put in place of a column: one named bucket must fail.
        return rows.select("*", self._bucket(), part.alias("__part")).repartition("bucket", "__part")

    def _stored_schema(self, batch: DataFrame) -> T.StructType:
        """The columns of a batch as Spark reads them back from files."""
        work = run_folder(self.spark, "schema")
        batch.limit(0).write.parquet(work)
        return self.spark.read.parquet(work).schema

    def put(self, batch: DataFrame, batch_id: str | None = None) -> int:
        """Store a batch; returns the number of buckets rewritten.

        A batch named by a ``batch_id`` that the store has seen last is not stored
        again. Of rows of the batch that repeat an id, the one that comes last in
        the order of their columns stays. A null id fails the job. The columns must
        be those of the first batch.
        """
        number, state = self._state()
        if batch_id is not None and state.get("batch_id") == batch_id:
            return 0
        columns = [F.col(f"`{c}`") for c in batch.columns]
        key = F.col(f"`{self.key}`")
        named = F.when(key.isNotNull(), key).otherwise(F.raise_error(F.lit(f"a document without {self.key}")))
        # Maps have no order of their own.
        maps = {f.name for f in batch.schema.fields if isinstance(f.dataType, T.MapType)}
        given = zip(batch.columns, columns, strict=True)
        order = W.partitionBy("bucket", "__part", key).orderBy(*((F.to_json(c) if n in maps else c).desc() for n, c in given))
        name, folder = self.commits.new_attempt()
        schema = self._stored_schema(batch)
        if state and [(f.name, f.dataType) for f in T.StructType.fromJson(state["schema"]).fields] != [
            (f.name, f.dataType) for f in schema.fields
        ]:
            raise ValueError(f"the store has {state['schema']}, the batch {schema.json()}")
        # Rows move once, to the tasks that write their bucket, and an id's rows meet there.
        dealt = self._dealt(batch.withColumn(self.key, named))
        one_each = dealt.withColumn("__nth", F.row_number().over(order)).filter("__nth = 1")
        with shuffles_removed(batch.sparkSession):
            one_each.select(*columns, "bucket").write.partitionBy("bucket").parquet(folder, compression=COMPRESSION)
        # Read from here on, after the batch was worked out once.
        fresh = self.commits.read_attempts(self._with_bucket(schema), [folder])
        touched = {r[0] for r in fresh.select("bucket").distinct().collect()}
        pieces = dict(state.get("pieces", {}))
        rewritten = {b for b in touched if len(pieces.get(str(b), ())) >= MAX_PIECES}
        known = touched & {int(b) for b in pieces}
        if known:
            keys = self._pieces(state, known).select(self.key, "bucket")
            again = keys.join(fresh.select(self.key), self.key, "left_semi")
            rewritten |= {r[0] for r in again.select("bucket").distinct().collect()}
        if rewritten:
            # The batch's ids travel with the old rows, whose bucket they share; a join
            # by id would move the old rows once more.
            old = self._pieces(state, rewritten).withColumn("__new", F.lit(False))
            ids = fresh.filter(F.col("bucket").isin(*rewritten)).select(key, F.lit(True).alias("__new"))
            met = self._dealt(old.drop("bucket").unionByName(ids, allowMissingColumns=True))
            replaced = F.max("__new").over(W.partitionBy("bucket", "__part", key))
            kept = met.withColumn("__new", replaced).filter("not __new")
            # Beside the batch's rows in the same attempt, which counts as a whole once listed.
            with shuffles_removed(self.spark):
                kept.select(*columns, "bucket").write.mode("append").partitionBy("bucket").parquet(folder, compression=COMPRESSION)
        for b in touched:
            pieces[str(b)] = [name] if b in rewritten else [*pieces.get(str(b), ()), name]
        content = {
            "key": self.key,
            "buckets": self.buckets,
            "schema": schema.jsonValue(),
            "pieces": pieces,
            "batch_id": batch_id if batch_id is not None else state.get("batch_id"),
        }
        self.commits.replace(number, content)
        return len(rewritten)

    def remove_unlisted(self) -> int:
        """Delete pieces that no bucket names any more; returns how many."""
        _, state = self._state()
        return self.commits.remove_unlisted({n for names in state.get("pieces", {}).values() for n in names})
