"""Rows removed from stored tables: retention by months, erasure by key.

Retention drops whole months by their folders, without reading them, and writes
only the month in which the border falls anew.

Erasure finds the files that hold a lost key (a semi join that reads the key column
and the file name only), and writes those files anew without it; all other files
keep their names. Children are served before their parents, since the lost keys of a
child follow from its parent. A table's change is announced in a plan before a file
of it is touched, so a job that dies is finished by ``resume``: the new files are
complete beside the table by then, and each step can be done twice. What was done is
entered in a journal. A reader that runs meanwhile sees some files of either
state of a table, never a half of a file.
"""

from __future__ import annotations

import json
import uuid
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardloom.operators.quality import RETENTION_DAYS
from cardloom.session import path_exists
from cardloom.sources.tables import MONTH

JOURNAL = "id_run string, nom_table string, fichiers bigint, lignes bigint"


class Folder:
    """File operations below a path."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.at = spark._jvm.org.apache.hadoop.fs.Path
        self.files = self.at(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, path: str) -> list[str]:
        where = self.at(path)
        return sorted(s.getPath().getName() for s in self.files.listStatus(where)) if self.files.exists(where) else []

    def data_files(self, path: str) -> list[str]:
        """Paths of the data files below a folder, relative to it."""
        where = self.at(path)
        if not self.files.exists(where):
            return []
        root, out = self.files.makeQualified(where).toString().rstrip("/") + "/", []
        found = self.files.listFiles(where, True)
        while found.hasNext():
            name = found.next().getPath().toString().removeprefix(root)
            if name.endswith(".parquet") and not any(part.startswith(("_", ".")) for part in name.split("/")):
                out.append(name)
        return sorted(out)

    def delete(self, path: str) -> None:
        self.files.delete(self.at(path), True)

    def move(self, source: str, target: str) -> None:
        """Moves a file; one that was moved before stays."""
        if self.files.exists(self.at(source)):
            self.files.mkdirs(self.at(target).getParent())
            if not self.files.rename(self.at(source), self.at(target)):
                raise OSError(f"{source} was not moved to {target}")

    def put(self, path: str, text: str) -> None:
        draft = f"{path}.draft"
        out = self.files.create(self.at(draft), True)
        out.write(bytearray(text.encode()))
        out.close()
        self.move(draft, path)

    def text(self, path: str) -> str:
        stream = self.files.open(self.at(path))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


# retention -----------------------------------------------------------------


def expire(spark: SparkSession, path: str, today: date, days: int = RETENTION_DAYS) -> list[str]:
    """Removes the rows of a monthly table whose day is more than ``days`` before ``today``; returns the months dropped.

    A month without a date (null) stays, as nothing tells its age.
    """
    folder, border = Folder(spark, path), today - timedelta(days=days)
    month = border.year * 100 + border.month
    months = [n for n in folder.names(path) if n.startswith(f"{MONTH}=") and n.split("=")[1].isdigit()]
    gone = [n for n in months if int(n.split("=")[1]) < month]
    for name in gone:
        folder.delete(f"{path}/{name}")
    name = f"{MONTH}={month}"
    if name in months:
        rows = spark.read.parquet(f"{path}/{name}")
        old = F.coalesce(F.col("situation_date") < F.lit(border), F.lit(False))
        if not rows.where(old).isEmpty():
            _rewritten(folder, path, rows.where(~old), [f"{name}/{f}" for f in folder.data_files(f"{path}/{name}")], name)
    return [n.split("=")[1] for n in gone]


def _rewritten(folder: Folder, path: str, rows: DataFrame, old: list[str], into: str = "", partitions: tuple[str, ...] = ()) -> None:
    """Puts ``rows`` in the place of the files ``old`` of a table."""
    run = uuid.uuid4().hex
    stage = f"{path}/_stage-{run}"
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(stage)
    moves = {f"_stage-{run}/{name}": "/".join(p for p in (into, name) if p) for name in folder.data_files(stage)}
    folder.put(f"{path}/_plan-{run}.json", json.dumps({"old": old, "moves": moves, "stage": f"_stage-{run}"}))
    resume(folder.spark, path)


def resume(spark: SparkSession, path: str) -> int:
    """Finishes announced changes of a table; returns how many there were. Stages without a plan never began and go."""
    folder = Folder(spark, path)
    names = folder.names(path)
    plans = [n for n in names if n.startswith("_plan-") and n.endswith(".json")]
    for name in plans:
        plan = json.loads(folder.text(f"{path}/{name}"))
        for old in plan["old"]:
            folder.delete(f"{path}/{old}")
        for source, target in plan["moves"].items():
            folder.move(f"{path}/{source}", f"{path}/{target}")
        folder.delete(f"{path}/{plan['stage']}")
        folder.delete(f"{path}/{name}")
    for name in names:
        if name.startswith("_stage-") or name.startswith("_plan-") and name.endswith(".draft"):
            folder.delete(f"{path}/{name}")
    return len(plans)


# erasure -------------------------------------------------------------------


def remove_keys(spark: SparkSession, path: str, lost: DataFrame, keys: list[str], partitions: tuple[str, ...] = ()) -> tuple[int, int]:
    """Writes the files of a table that hold keys of ``lost`` anew without them; returns how many files and rows that met.

    ``partitions`` are the columns by which the table's folders are cut.
    """
    resume(spark, path)
    folder, table = Folder(spark, path), spark.read.parquet(path)
    lost = lost.select(*keys).distinct()
    # of the table only the keys are read
    hit = table.select(*keys, F.col("_metadata.file_path").alias("file")).join(lost, keys, "left_semi")
    met = hit.groupBy("file").agg(F.count(F.lit(1)).alias("n")).collect()
    if not met:
        return 0, 0
    root = folder.files.makeQualified(folder.at(path)).toString().rstrip("/") + "/"
    decoded = [folder.at(spark._jvm.java.net.URI(r.file)).toString() for r in met]
    rows = spark.read.option("basePath", path).schema(table.schema).parquet(*decoded).join(lost, keys, "left_anti")
    _rewritten(folder, path, rows, [p.removeprefix(root) for p in decoded], partitions=partitions)
    return len(met), sum(r.n for r in met)


def erase_clients(spark: SparkSession, root: str, clients: DataFrame, run: str) -> DataFrame:
    """Removes clients (column id_client) and all that hangs on them from the stored tables below ``root``; returns the journal of the run.

    Tables: client, carte, transaction (by month), label_fraude, erreur_transaction, journal_audit; one that is not there is left out. A run
    that is repeated removes nothing more and keeps the entries of its first time.
    """
    have = lambda n: path_exists(spark, f"{root}/{n}")
    read = lambda n: spark.read.parquet(f"{root}/{n}")
    for name in ("client", "carte", "transaction", "label_fraude", "erreur_transaction", "journal_audit"):
        if have(name):
            resume(spark, f"{root}/{name}")
    ids = clients.select("id_client").distinct()
    # what is lost is kept: after its parents are gone it could not be found again
    base = f"{root}/_erasure/{run}"
    for name, key, parent, parent_key in (("client", "id_client", None, None), ("carte", "id_carte", "client", "id_client"), ("transaction", "id_transaction", "carte", "id_carte")):
        if not path_exists(spark, f"{base}/{name}/_SUCCESS"):
            lost = ids if parent is None else read(name).join(spark.read.parquet(f"{base}/{parent}"), parent_key, "left_semi").select(key)
            lost.write.mode("overwrite").parquet(f"{base}/{name}")
    lost = {n: spark.read.parquet(f"{base}/{n}") for n in ("client", "carte", "transaction")}
    about = reduce(DataFrame.unionByName, [
        lost[n].select(F.lit(n).alias("table_concernee"), F.col(k).cast("bigint").alias("id_ligne_concernee")) for n, k in (("client", "id_client"), ("carte", "id_carte"))
    ])
    steps = (
        ("label_fraude", lost["transaction"], ["id_transaction"], ()), ("erreur_transaction", lost["transaction"], ["id_transaction"], ()),
        ("journal_audit", about, ["table_concernee", "id_ligne_concernee"], ()), ("transaction", lost["carte"], ["id_carte"], (MONTH,)),
        ("carte", lost["client"], ["id_client"], ()), ("client", lost["client"], ["id_client"], ()),
    )
    for name, keys_of, keys, partitions in steps:
        if have(name):
            files, rows = remove_keys(spark, f"{root}/{name}", keys_of, keys, partitions)
            entry = f"{root}/_erasure/{run}/journal/{name}"
            if files or not path_exists(spark, f"{entry}/_SUCCESS"):
                spark.createDataFrame([(run, name, files, rows)], JOURNAL).coalesce(1).write.mode("overwrite").parquet(entry)
    return journal(spark, root).where(F.col("id_run") == run)


def journal(spark: SparkSession, root: str) -> DataFrame:
    """Entries of all runs: ``id_run, nom_table, fichiers, lignes`` (files written anew, rows removed)."""
    folder = Folder(spark, root)
    paths = [f"{root}/_erasure/{run}/journal/{name}" for run in folder.names(f"{root}/_erasure") for name in folder.names(f"{root}/_erasure/{run}/journal")]
    return spark.read.schema(JOURNAL).parquet(*paths) if paths else spark.createDataFrame([], JOURNAL)
