"""Datamarts kept up to date under late labels, corrections and deletions.

The counting method: a batch of changes gives, for every transaction it touches,
the row as it was (counted -1) and as it is now (counted +1). Summed per key of a
datamart these signed rows are what changes there, whatever the change was: a new
transaction, a label that comes long after it (or before it), another amount,
another card, a deletion. A figure never needs the rows it came from again.

What is stored below ``root``:

* ``log``: the touched rows after each batch, in a folder per batch, cut by ranges of
  the id: ranges so wide that a batch has at most ``LOG_PARTS`` and one of them, however
  sparse its ids. It is only appended to. A batch reads the ranges its ids fall into.
* ``card``, ``daily``: figures per card and day (``Versions``): only parts with a
  changed key are written.
* ``pairs``: figures per (category, card); a card leaves a category when its count
  there falls to zero, so distinct cards stay exact under deletions, too.
* ``category``: figures per category, kept from the changes of ``pairs`` alone.

Batch names sort by time. A batch applied again gives the same: it reads what stood
before it and replaces its own. The category of a transaction is that of its
merchant when the transaction came.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardloom.operators import datamarts as d
from cardloom.sources.versions import Versions

MONEY = "decimal(38,2)"
FIELDS = ("id_carte", "code_mcc", "situation_date", "amount")
#: Figures that add up: rows, amounts, rows with an amount, frauds.
SUMS = ("n", "total", "amounts", "frauds")
#: Ids of one part of the log, at least.
ID_RANGE = 50_000_000
#: Parts that the ids of a batch are cut into, at most.
LOG_PARTS = 64

_LOG = "id_transaction bigint, present boolean, id_carte bigint, code_mcc int, situation_date date, amount decimal(12,2), is_fraud string"
_IMAGE = ("present", *FIELDS, "is_fraud")


class Deltas:
    """The stored state below ``root``; ``parts`` is the number of parts of the figures per card and pair."""

    def __init__(self, spark: SparkSession, root: str, parts: int = 64, id_range: int = ID_RANGE):
        self.spark, self.root, self.id_range = spark, root.rstrip("/"), id_range
        figures = f"n bigint, total {MONEY}, amounts bigint, frauds bigint"
        ddl = T.StructType.fromDDL
        self.card = Versions(spark, f"{self.root}/card", ddl(f"id_carte bigint, {figures}, was bigint"), ("id_carte",), parts)
        self.daily = Versions(spark, f"{self.root}/daily", ddl(f"situation_date date, {figures}, was bigint"))
        self.pairs = Versions(spark, f"{self.root}/pairs", ddl(f"code_mcc int, id_carte bigint, {figures}, was bigint"), ("code_mcc", "id_carte"), parts)
        self.category = Versions(spark, f"{self.root}/category", ddl(f"code_mcc int, {figures}, cards bigint"))

    # log -------------------------------------------------------------------

    def _log(self, before: str, ids: DataFrame) -> DataFrame:
        """Newest row before a batch of each id that the batch touches."""
        stored = self._log_parts(before)
        if not stored:
            return self.spark.createDataFrame([], _LOG)
        # of each width of ranges the parts that ids fall into, among those that are stored
        spans: dict[int, tuple[int, int]] = {}
        for _, width, part in stored:
            low, high = spans.get(width, (part, part))
            spans[width] = min(low, part), max(high, part)
        places = [F.struct(F.lit(w).cast("bigint").alias("width"), self._range(w).alias("part"), F.lit(low).alias("low"), F.lit(high).alias("high")) for w, (low, high) in spans.items()]
        hit = {tuple(r) for r in ids.select(F.explode(F.array(*places)).alias("p")).where("p.part between p.low and p.high").select("p.width", "p.part").distinct().collect()}
        root = f"{self.root}/log"
        paths = [f"{root}/batch={b}/id_range={w}/id_part={p}" for b, w, p in stored if (w, p) in hit]
        if not paths:
            return self.spark.createDataFrame([], _LOG)
        rows = self.spark.read.schema(f"{_LOG}, batch string").option("basePath", root).parquet(*paths).join(ids, "id_transaction", "left_semi")
        newest = F.max_by(F.struct(*_IMAGE), "batch").alias("row")
        return rows.groupBy("id_transaction").agg(newest).select("id_transaction", "row.*")

    def _log_parts(self, before: str) -> list[tuple[str, int, int]]:
        """Batch, width and number of the ranges stored before a batch; at most ``LOG_PARTS`` and one a batch."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/log/batch=*/id_range=*/id_part=*")
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path)
        out = []
        for status in found or ():
            batch, width, part = (x.split("=", 1)[1] for x in status.getPath().toString().split("/")[-3:])
            if batch < before and part.lstrip("-").isdigit():
                out.append((batch, int(width), int(part)))
        return out

    @staticmethod
    def _range(width: int) -> Column:
        return F.floor(F.col("id_transaction") / width).cast("bigint")

    def images(self, batch: str, tx: DataFrame, label: DataFrame, deleted: DataFrame, merchant: DataFrame) -> DataFrame:
        """Touched ids with their rows before and after a batch, ``old`` and ``new``.

        Of several rows of one id in a batch the greatest counts. An id that is both
        changed and deleted in a batch is gone. A deleted transaction keeps its label.
        """
        coded = tx.join(merchant.select("id_marchand", "code_mcc"), "id_marchand", "left")
        changed = coded.select(
            "id_transaction", F.struct(F.col("id_carte").cast("bigint").alias("id_carte"), F.col("code_mcc").cast("int").alias("code_mcc"), "situation_date", F.col("amount").cast("decimal(12,2)").alias("amount")).alias("tx")
        ).groupBy("id_transaction").agg(F.max("tx").alias("tx"))
        labels = label.groupBy("id_transaction").agg(F.max("is_fraud").alias("label"))
        gone = deleted.select("id_transaction", F.lit(True).alias("gone")).distinct()
        # one shuffle brings together what a batch says about an id
        nothing = {"tx": changed.schema["tx"].dataType, "label": T.StringType(), "gone": T.BooleanType()}

        def wide(frame: DataFrame) -> DataFrame:
            return frame.select("id_transaction", *[(F.col(c) if c in frame.columns else F.lit(None)).cast(k).alias(c) for c, k in nothing.items()])

        said = wide(changed).unionByName(wide(labels)).unionByName(wide(gone)).groupBy("id_transaction").agg(
            *[F.max(c).alias(c) for c in nothing]
        )
        # stored, as it is read for the ranges, for the log and for the rows
        kept = f"{self.root}/said/{batch}"
        said.write.mode("overwrite").parquet(kept)
        said = self.spark.read.parquet(kept)
        old = self._log(batch, said.select("id_transaction"))
        rows = said.join(old.select("id_transaction", F.struct(*_IMAGE).alias("old")), "id_transaction", "left")
        present = F.when(F.col("gone"), False).otherwise(F.col("tx").isNotNull() | F.coalesce("old.present", F.lit(False)))
        new = F.struct(
            present.alias("present"),
            *[F.when(F.col("tx").isNotNull(), F.col(f"tx.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in FIELDS],
            F.coalesce("label", "old.is_fraud").alias("is_fraud"),
        )
        return rows.select("id_transaction", "old", new.alias("new"))

    # changes ---------------------------------------------------------------

    def apply(self, batch: str, tx: DataFrame, label: DataFrame, deleted: DataFrame, merchant: DataFrame) -> None:
        """Takes a batch into the stored figures.

        ``tx`` holds new and corrected transactions, ``label`` new and changed labels, ``deleted`` ids.
        """
        touched = f"{self.root}/log/batch={batch}"
        scratch = f"{self.root}/changes/{batch}"
        self.images(batch, tx, label, deleted, merchant).write.mode("overwrite").parquet(scratch)
        rows = self.spark.read.parquet(scratch)
        ends = rows.agg(F.min("id_transaction").alias("low"), F.max("id_transaction").alias("high")).first()
        width = max(self.id_range, -(-(ends.high - ends.low) // LOG_PARTS)) if ends.low is not None else self.id_range
        logged = rows.select("id_transaction", "new.*", F.lit(width).cast("bigint").alias("id_range"), self._range(width).alias("id_part"))
        writer = logged.hint("rebalance", "id_part").write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy("id_range", "id_part").parquet(touched)

        signed = rows.where(~F.col("old").eqNullSafe(F.col("new"))).select(
            F.explode(F.array(F.struct(F.lit(-1).alias("sign"), F.col("old").alias("row")), F.struct(F.lit(1).alias("sign"), F.col("new").alias("row")))).alias("c")
        ).where("c.row.present").select("c.sign", "c.row.*")
        sums = [
            F.sum("sign").cast("bigint").alias("n"),
            F.coalesce(F.sum(F.col("sign") * F.col("amount")), F.lit(0)).cast(MONEY).alias("total"),
            F.sum(F.when(F.col("amount").isNotNull(), F.col("sign")).otherwise(0)).cast("bigint").alias("amounts"),
            F.sum(F.when(F.col("is_fraud") == "Y", F.col("sign")).otherwise(0)).cast("bigint").alias("frauds"),
        ]
        self._fold(self.card, signed, sums, batch)
        self._fold(self.daily, signed, sums, batch)
        coded = signed.where("code_mcc is not null")
        parts = self._fold(self.pairs, coded, sums, batch)
        self._categories(coded.groupBy("code_mcc").agg(*sums), parts, batch)

    def _fold(self, table: Versions, signed: DataFrame, sums: list[Column], batch: str) -> list[int]:
        """Adds signed rows to a table; only the parts with a changed key are read and written. Returns them."""
        keys = list(table.keys) or [table.schema.fields[0].name]
        # of the rows, whose keys are those of the sums: no sum is made for it
        parts = table.touched(signed)
        if not parts:
            return parts
        change = signed.groupBy(*keys).agg(*sums)
        stored = table.read(before=batch, parts=parts).where("n <> 0")
        both = stored.select(*keys, *SUMS, F.col("n").alias("was")).unionByName(change.select(*keys, *SUMS, F.lit(0).cast("bigint").alias("was")))
        table.write(both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in (*SUMS, "was")]), batch, parts)
        return parts

    def _categories(self, change: DataFrame, parts: list[int], batch: str) -> None:
        """Category figures from the changes per category; a pair whose count left zero or fell to it changes the distinct cards."""
        sums = change.withColumn("cards", F.lit(0).cast("bigint"))
        # a null card is no card
        moved = self.pairs.read(before=f"{batch}\0", parts=parts).where("id_carte is not null and (n > 0) <> (was > 0)")
        moved = moved.groupBy("code_mcc").agg(
            *[F.lit(0).cast(MONEY if c == "total" else "bigint").alias(c) for c in SUMS], F.sum(F.when(F.col("n") > 0, 1).otherwise(-1)).cast("bigint").alias("cards")
        )
        rows = self.category.read(before=batch).unionByName(sums).unionByName(moved)
        self.category.write(rows.groupBy("code_mcc").agg(*[F.sum(c).alias(c) for c in (*SUMS, "cards")]), batch)

    def changed_cards(self, batch: str) -> DataFrame:
        """Cards that a batch touched, with their transactions after it as ``figure`` (null: none left)."""
        rows = self.spark.read.parquet(f"{self.root}/changes/{batch}")
        cards = rows.select(F.explode(F.array("old.id_carte", "new.id_carte")).alias("id_carte")).where("id_carte is not null").distinct()
        parts = self.card.touched(cards)
        now = self.card.read(before=f"{batch}\0", parts=parts).where("n > 0")
        return cards.join(now, "id_carte", "left").select(F.col("id_carte").alias("key"), F.col("n").alias("figure"))

    def all_cards(self, batch: str) -> DataFrame:
        """All cards after a batch, as ``changed_cards`` gives them."""
        return self.card.read(before=f"{batch}\0").where("n > 0 and id_carte is not null").select(F.col("id_carte").alias("key"), F.col("n").alias("figure"))

    # served ----------------------------------------------------------------

    def card_datamart(self) -> DataFrame:
        return _served(self.card.read(), "id_carte", "nb_transactions")

    def daily_datamart(self) -> DataFrame:
        return _served(self.daily.read(), "situation_date", "nb_tx")

    def category_datamart(self, mcc: DataFrame) -> DataFrame:
        rows = d.with_category(self.category.read().where("n > 0"), mcc)
        return rows.select(
            "code_mcc", "libelle_mcc", F.col("n").alias("nb_transactions"), _total().cast("decimal(32,2)").alias("total_amount"),
            d.half_up_mean(_total(), F.col("amounts")).alias("avg_amount"), F.col("cards").alias("nb_cartes_uniques"),
        )


def _total() -> Column:
    """Sum of amounts; none of rows without any."""
    return F.when(F.col("amounts") > 0, F.col("total"))


def _served(rows: DataFrame, key: str, count_name: str) -> DataFrame:
    figures = rows.where("n > 0").select(
        key, F.col("n").alias(count_name), _total().alias("total_amount"), F.col("amounts").alias("_nb_amounts"), F.col("frauds").alias("nb_fraudes")
    )
    return d._finished(figures, [key], count_name)
