"""Logical tables of the recommendation domain, derived from the driver's star schema.

The mapping (see FIXTURES.md) turns TPC-H-style tables into the five inputs the
domain expects: ratings, books, tags, book_tags (string ids, like a JSON API) and
to_read.  Every view is a lazy DataFrame; scans read only the columns they need.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators.clean import dense_ids


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Most rows of a vocabulary that :func:`join_vocabulary` broadcasts.
VOCABULARY_ROWS = 500_000


def join_vocabulary(rows: DataFrame, words: DataFrame, on: str, limit: int = VOCABULARY_ROWS) -> DataFrame:
    """``rows`` joined to the written table ``words`` (one row per value of ``on``), which is broadcast if it has at most
    ``limit`` rows. The planner judges exploded rows by the size of their files, so without a hint it may broadcast them
    and leave the whole join to the task that reads ``words``."""
    few = words.count() <= limit
    return rows.join(F.broadcast(words) if few else words.hint("merge"), on)


#: Order lines beyond which rows are dealt by their number, and rows of a task then; below, the planner deals them.
LARGE_ROWS, TASK_ROWS = 16_000_000, 1_000_000


@dataclass
class Tables:
    spark: SparkSession
    sf_dir: str
    _memo: dict = field(default_factory=dict, repr=False)

    def memo(self, key: str, build):
        """Build a derived table once per query (callers materialise what several jobs reuse)."""
        if key not in self._memo:
            self._memo[key] = build()
        return self._memo[key]

    def raw(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    def dealt(self, df: DataFrame, *keys: str) -> DataFrame:
        """Rows as many as order lines, dealt by ``keys`` over so many tasks that one holds about TASK_ROWS, whatever the
        number of shuffle partitions."""
        lines = self.memo("lines", lambda: self.raw("lineitem").count())
        return df if lines <= LARGE_ROWS else df.repartition(-(-lines // TASK_ROWS), *keys)

    # ratings(user_id, book_id, rating): one row per order line, repeats kept
    def ratings(self) -> DataFrame:
        li = self.dealt(self.raw("lineitem").select("l_orderkey", "l_partkey", "l_quantity"), "l_orderkey")
        return self._rated(li, self.dealt(self.raw("orders").select("o_orderkey", "o_custkey"), "o_orderkey"))

    def ratings_of(self, user: Column) -> DataFrame:
        """The rows of :meth:`ratings` of one user: order lines meet this user's orders only."""
        li = self.raw("lineitem").select("l_orderkey", "l_partkey", "l_quantity")
        od = self.raw("orders").where(F.col("o_custkey") + 1 == user).select("o_orderkey", "o_custkey")
        return self._rated(li, F.broadcast(od) if od.count() <= VOCABULARY_ROWS else od.hint("merge"))

    def ratings_per_user(self) -> DataFrame:
        """(user_id, n): the rows of :meth:`ratings` per user; order lines are counted per order before the join."""
        li = self.raw("lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("_n"))
        od = self.raw("orders").select("o_orderkey", "o_custkey")
        per_order = li.join(od, li.l_orderkey == od.o_orderkey)
        return per_order.groupBy((F.col("o_custkey") + 1).alias("user_id")).agg(F.sum("_n").alias("n"))

    @staticmethod
    def _rated(li: DataFrame, od: DataFrame) -> DataFrame:
        return li.join(od, li.l_orderkey == od.o_orderkey).select(
            (F.col("o_custkey") + 1).alias("user_id"),
            (F.col("l_partkey") + 1).alias("book_id"),
            (F.floor((F.col("l_quantity") - 1) / 10).cast("int") + 1).alias("rating"),
        )

    # books(id internal, book_id external = 7*id + 3, title)
    def books(self) -> DataFrame:
        p = self.raw("part")
        return p.select(
            (F.col("p_partkey") + 1).alias("id"),
            ((F.col("p_partkey") + 1) * 7 + 3).alias("book_id"),
            F.col("p_name").alias("title"),
        )

    # five tag names per book (one scan of part, exploded); dealt by key first, as a few file splits would
    # leave the exploded rows and their aggregates to as few tasks
    def part_tags(self) -> DataFrame:
        p = self.raw("part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size").repartition("p_partkey")
        names = F.array(
            F.split_part(F.col("p_name"), F.lit(" "), F.lit(1)),
            F.split_part(F.col("p_name"), F.lit(" "), F.lit(2)),
            F.col("p_brand"),
            F.col("p_type"),
            F.concat(F.lit("size-"), F.col("p_size").cast("string")),
        )
        return p.select((F.col("p_partkey") + 1).alias("id"), F.explode(names).alias("tag_name"))

    # tags(tag_id dense by name, tag_name)
    def tags(self) -> DataFrame:
        def build():
            names = self.part_tags().select("tag_name").distinct()
            return dense_ids(names, ["tag_name"], "tag_id").select("tag_id", "tag_name")

        return self.memo("tags", build)

    # book_tags(goodreads_book_id string, tag_id string, cnt); every 50th book dangles
    def book_tags(self) -> DataFrame:
        j = join_vocabulary(self.part_tags(), self.tags(), "tag_name")
        ext = F.when(F.col("id") % 50 == 0, -F.col("id")).otherwise(F.col("id") * 7 + 3)
        return j.select(
            ext.cast("string").alias("goodreads_book_id"),
            F.col("tag_id").cast("string").alias("tag_id"),
            ((F.col("id") * 31 + F.col("tag_id") * 17) % 97 + 1).alias("cnt"),
        )

    # to_read(user_id, book_id) from view/click events
    def to_read(self) -> DataFrame:
        ev = self.raw("events").select("event_id", "user_id", "event_type")
        n_parts = self.raw("part").select(F.count(F.lit(1))).scalar()
        return (
            ev.where(F.col("event_type").isin("view", "click"))
            .select(
                (F.col("user_id") + 1).alias("user_id"),
                ((F.col("event_id") * 13 + F.col("user_id") * 7) % n_parts + 1).alias("book_id"),
            )
            .distinct()
        )

    # embeddings(vec_id, embedding array<float>, label)
    def embeddings(self) -> DataFrame:
        return self.raw("embeddings")


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)
