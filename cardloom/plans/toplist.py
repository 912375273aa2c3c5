"""Top-k lists kept up to date without sorting the datamart.

A list keeps more candidates than it shows, and a border: every key that is no
candidate stands behind it. A batch touches the candidates it changes and takes in
the changed keys that come before the border; the first k candidates are the exact
list as long as k of them stand before the border. When too many have fallen behind
it, the list is made anew from the whole datamart, by a distributed top-k.

The list is a bounded number of rows, and all that the driver handles is whether k
of them are left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardloom.sources.versions import Versions

class TopList:
    """The k greatest values of ``figure`` over keys; ties by the smaller key. ``room`` times k candidates are kept."""

    def __init__(self, spark: SparkSession, root: str, k: int = 10, room: int = 5):
        self.spark, self.k, self.size = spark, k, k * room
        # the border is on every row: the value and key of the last candidate when the list was made
        self.table = Versions(spark, root, T.StructType.fromDDL("key bigint, figure bigint, border bigint, border_key bigint"))

    def _before(self) -> Column:
        """Whether a candidate stands at or before the border; without one all do."""
        b = F.col("border")
        return b.isNull() | (F.col("figure") > b) | ((F.col("figure") == b) & (F.col("key") <= F.col("border_key")))

    def update(self, batch: str, changed: DataFrame, every: DataFrame) -> bool:
        """Takes in ``changed`` (key, figure; null: gone) as it is after the batch; ``every`` is the whole of it, read only
        to make the list anew. Returns whether it was."""
        old = self.table.read(before=batch)
        border = old.select("border", "border_key").limit(1)
        kept = old.join(changed.select("key"), "key", "left_anti")
        fresh = changed.where("figure is not null").join(F.broadcast(border))
        rows = kept.unionByName(fresh.select(*old.columns)).where(self._before())
        self.table.write(rows.orderBy(F.desc("figure"), "key").limit(self.size), batch)
        now = self.table.read(before=f"{batch}\0").agg(F.count(F.lit(1)).alias("n"), F.max("border").isNull().alias("all")).first()
        if now.n >= self.k or (now.n and now.all):
            return False
        best = every.where("figure is not null").select("key", "figure").orderBy(F.desc("figure"), "key").limit(self.size + 1)
        # a window over the candidates, which are bounded: one more than kept tells whether there is a border at all
        ranked = best.withColumn("all", F.array_sort(F.collect_list(F.struct((-F.col("figure")).alias("f"), "key")).over(Window.partitionBy())))
        last = F.when(F.size("all") > self.size, F.get("all", F.lit(self.size - 1)))
        rows = ranked.select("key", "figure", (-last["f"]).alias("border"), last["key"].alias("border_key"))
        self.table.write(rows.where(self._before()), batch)
        return True

    def shown(self) -> DataFrame:
        return self.table.read().orderBy(F.desc("figure"), "key").limit(self.k).select("key", "figure")
