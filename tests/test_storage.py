from __future__ import annotations

import glob
import os
from datetime import date, datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cardloom.operators import history, listing
from cardloom.plans import removal
from cardloom.sources import layout, tables


def files_of(path):
    return {os.path.relpath(f, path): os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


# retention


def test_months_are_dropped_and_the_border_month_is_cut(spark, tmp_path):
    path = str(tmp_path / "tx")
    tx = spark.range(400).select(F.col("id").alias("id_transaction"), F.expr("date_add(date'2023-01-01', cast(id as int))").alias("situation_date"))
    tables.write_monthly(tx.unionByName(spark.range(1).select((F.col("id") + 900).alias("id_transaction"), F.lit(None).cast("date").alias("situation_date"))), path)
    before = files_of(path)
    assert removal.expire(spark, path, date(2025, 3, 20), days=730) == ["202301", "202302"]
    left = spark.read.parquet(path)
    assert sorted(r[0] for r in left.where("situation_date is not null").select("id_transaction").collect()) == list(range((date(2023, 3, 21) - date(2023, 1, 1)).days, 400))
    assert left.where("id_transaction = 900").count() == 1
    after = files_of(path)
    # months after the border keep their files
    kept = {f: t for f, t in before.items() if not any(f"={m}/" in f for m in ("202301", "202302", "202303"))}
    assert kept and all(after[f] == t for f, t in kept.items())
    assert removal.expire(spark, path, date(2025, 3, 20), days=730) == [] and files_of(path) == after
    assert len(removal.expire(spark, path, date(2090, 1, 1))) == 12
    assert spark.read.schema(tx.schema).parquet(path).count() == 1


# erasure


def _store(spark, root):
    clients = spark.range(40).select(F.col("id").alias("id_client"), (F.col("id") % 5).alias("x"))
    cards = spark.range(80).select(F.col("id").alias("id_carte"), (F.col("id") % 40).alias("id_client"))
    tx = spark.range(800).select(
        F.col("id").alias("id_transaction"), (F.col("id") % 80).alias("id_carte"), F.expr("date_add(date'2024-01-01', cast(id % 120 as int))").alias("situation_date")
    )
    label = tx.where("id_transaction % 2 = 0").select("id_transaction", F.lit("N").alias("is_fraud"))
    journal = spark.createDataFrame([(1, "client", 7), (2, "client", 8), (3, "carte", 47), (4, "carte", 48), (5, "client", None)], "id_audit int, table_concernee string, id_ligne_concernee bigint")
    clients.repartitionByRange(8, "id_client").write.parquet(f"{root}/client")
    cards.repartitionByRange(8, "id_carte").write.parquet(f"{root}/carte")
    tables.write_monthly(tx, f"{root}/transaction")
    label.repartitionByRange(8, "id_transaction").write.parquet(f"{root}/label_fraude")
    journal.write.parquet(f"{root}/journal_audit")
    return clients.where("id_client = 7").select("id_client")


def _check_store(spark, root):
    ids = lambda n, c: {r[0] for r in spark.read.parquet(f"{root}/{n}").select(c).collect()}
    assert ids("client", "id_client") == set(range(40)) - {7}
    assert ids("carte", "id_carte") == set(range(80)) - {7, 47}
    tx = {i for i in range(800) if i % 80 not in (7, 47)}
    assert ids("transaction", "id_transaction") == tx and ids("label_fraude", "id_transaction") == {i for i in tx if i % 2 == 0}
    assert ids("journal_audit", "id_audit") == {2, 4, 5}
    assert spark.read.parquet(f"{root}/transaction").where("situation_month = 202402").where("situation_date < date'2024-02-01' or situation_date >= date'2024-03-01'").isEmpty()


def test_erasure_writes_only_files_with_lost_keys(spark, tmp_path):
    root = str(tmp_path)
    gone = _store(spark, root)
    before = {n: files_of(f"{root}/{n}") for n in ("client", "carte", "label_fraude")}
    journal = {r.nom_table: (r.fichiers, r.lignes) for r in removal.erase_clients(spark, root, gone, "r1").collect()}
    _check_store(spark, root)
    assert journal["client"] == (1, 1) and journal["carte"][1] == 2 and journal["transaction"][1] == 20 and journal["journal_audit"][1] == 2
    assert journal["label_fraude"][1] == 0 and journal["carte"][0] == 2
    for name, files in before.items():
        after = files_of(f"{root}/{name}")
        kept = [f for f in files if f in after]
        assert len(kept) == len(files) - journal[name][0] and all(after[f] == files[f] for f in kept)
    again = removal.erase_clients(spark, root, gone, "r2")
    assert {r.lignes for r in again.collect()} == {0}
    assert removal.erase_clients(spark, root, gone, "r1").where("nom_table = 'transaction'").first().lignes == 20
    assert removal.journal(spark, root).count() == 10


@pytest.mark.parametrize("call", [2, 6])
def test_erasure_that_dies_is_finished(spark, tmp_path, monkeypatch, call):
    root = str(tmp_path)
    gone = _store(spark, root)
    calls, move = [0], removal.Folder.move

    def dying(self, *args):
        calls[0] += 1
        if calls[0] == call:
            raise OSError("dies")
        move(self, *args)

    monkeypatch.setattr(removal.Folder, "move", dying)
    with pytest.raises(OSError, match="dies"):
        removal.erase_clients(spark, root, gone, "r1")
    monkeypatch.setattr(removal.Folder, "move", move)
    removal.erase_clients(spark, root, gone, "r1")
    _check_store(spark, root)
    for name in ("client", "carte", "transaction", "label_fraude", "journal_audit"):
        assert not [f for f in os.listdir(f"{root}/{name}") if f.startswith(("_stage", "_plan"))]


# layout


def _groups(path):
    """Row groups as (rows, column -> (min, max))."""
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            yield group.num_rows, {group.column(c).path_in_schema: group.column(c).statistics for c in range(group.num_columns)}


def test_each_filter_reads_under_half(spark, tmp_path):
    from cardloom.suite.base import Model

    m = Model(spark, "/root/testdata/sf0.001")
    path = str(tmp_path / "docs")
    layout.write_interleaved(m.docs, path, ["client.id_client", "mcc.code", "date_transaction", "carte.id_carte"], ["id_transaction", "carte.id_carte"], files=128)
    groups = list(_groups(path))
    assert sum(n for n, _ in groups) == m.docs.count() and len(groups) >= 96
    docs = tables.read_documents(spark, path)
    for column, condition in (
        ("client.id_client", listing.transaction_filter(id_client=8)), ("carte.id_carte", listing.transaction_filter(id_carte=13)), ("mcc.code", listing.transaction_filter(code_mcc=7)),
        ("date_transaction", listing.transaction_filter(date_from=datetime(1998, 2, 1), date_to=datetime(1998, 2, 28))),
    ):
        low, high = {"client.id_client": (8, 8), "carte.id_carte": (13, 13), "mcc.code": (7, 7)}.get(column, (datetime(1998, 2, 1), datetime(1998, 2, 28)))
        naive = lambda v: v.replace(tzinfo=None) if isinstance(v, datetime) else v
        hit = sum(naive(s[column].min) <= high and naive(s[column].max) >= low for _, s in groups)
        assert hit < len(groups) / 2, (column, hit, len(groups))
        assert sorted(docs.where(condition).select("id_transaction").collect()) == sorted(m.docs.where(condition).select("id_transaction").collect())
        plan = docs.where(condition)._jdf.queryExecution().executedPlan().toString()
        assert column in plan.split("PushedFilters")[1]
    # ids have Bloom filters
    # (Parquet leaves them out where a dictionary lists all values)
    jvm, found = spark._jvm, set()
    for name in glob.glob(f"{path}/*.parquet")[:20]:
        file = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(name), spark._jsc.hadoopConfiguration())
        columns = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(file).getFooter().getBlocks().get(0).getColumns()
        found |= {c.getPath().toDotString() for c in columns if c.getBloomFilterOffset() > 0}
    assert "id_transaction" in found <= {"id_transaction", "carte.id_carte"}


def test_interleaved_key(spark):
    df = spark.createDataFrame([(a, b, None if a == 3 else "x") for a in range(16) for b in range(16)] + [(None, None, None)], "a int, b int, c string")
    borders = layout.class_borders(df, ["a", "b"], bits=4)
    rows = {(r.a, r.b): r.k for r in df.select("a", "b", layout.interleaved(df, ["a", "b"], borders, bits=4).alias("k")).collect()}
    assert rows[None, None] == 0 and rows[0, 0] == 0 and max(rows.values()) < 256
    assert len({k >> 6 for (a, b), k in rows.items() if a is not None and a < 7 and b < 7}) == 1
    assert all(rows[a, b] <= rows[a + 1, b + 1] for a in range(15) for b in range(15))
    empty = layout.class_borders(df.limit(0), ["a"], bits=4)
    assert df.limit(0).select(layout.interleaved(df, ["a"], empty, bits=4)).count() == 0


def test_numbered_pages(spark, docs, tmp_path):
    many = docs
    for k in range(1, 5):
        many = many.unionByName(docs.withColumn("id_transaction", F.col("id_transaction") + 100 * k))
    path, directory = str(tmp_path / "docs"), str(tmp_path / "directory")
    layout.write_paged(many, path, directory, files=6)
    want = [(r.id_transaction, r.date_transaction) for r in many.orderBy(F.desc("date_transaction"), "id_transaction").collect()]
    for size, numbers in ((1, (1, 2, 13, len(want), len(want) + 1)), (4, (1, 3, 4, 5, 6)), (200, (1, 2))):
        for number in numbers:
            page = layout.numbered_page(spark, path, directory, number, size)
            assert [(r.id_transaction, r.date_transaction) for r in page.collect()] == want[(number - 1) * size : number * size], (size, number)
    deep = layout.numbered_page(spark, path, directory, 20, 1)
    assert len(deep.inputFiles()) == 1 < len(spark.read.parquet(path).inputFiles())
    with pytest.raises(ValueError):
        layout.numbered_page(spark, path, directory, 0)


# history


def test_history_against_snapshots(spark):
    days = ["2024-01-01", "2024-02-01", "2024-03-01", "2024-04-01"]
    data = [
        [(1, "a", 1), (2, "b", None), (3, None, None), (None, "n", 0)], [(1, "a", 1), (2, "b", 2), (4, "d", 4)],
        [], [(1, "a", 1), (2, "b", 2), (3, None, None), (3, None, None), (4, "e", 4)],
    ]
    frames = {d: spark.createDataFrame(rows, "k int, x string, y int") for d, rows in zip(days, data)}
    h = history.versions(history.stacked(frames), "k", ["x", "y"], days)
    rows = {(r.k, r.x, r.y, str(r.valide_du)[5:7], str(r.valide_au)[5:7] if r.valide_au else None) for r in h.collect()}
    assert rows == {
        (1, "a", 1, "01", "03"), (1, "a", 1, "04", None), (2, "b", None, "01", "02"), (2, "b", 2, "02", "03"), (2, "b", 2, "04", None),
        (3, None, None, "01", "02"), (3, None, None, "04", None), (None, "n", 0, "01", "02"), (4, "d", 4, "02", "03"), (4, "e", 4, "04", None),
    }
    for day, snapshot in zip(("2024-01-31", "2024-02-01", "2024-03-15", "2025-01-01"), data):
        got = history.as_of(h, F.lit(day).cast("date"))
        assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, set(snapshot)))
    assert history.as_of(h, F.lit("2023-12-31").cast("date")).count() == 0
    facts = spark.createDataFrame([(1, date(2024, 1, 9)), (1, date(2024, 3, 9)), (2, date(2024, 2, 9)), (9, date(2024, 2, 9)), (2, None)], "k int, jour date")
    got = {tuple(map(str, r)) for r in history.joined_as_of(facts, h, "k", "jour").collect()}
    assert got == {("1", "2024-01-09", "a", "1"), ("1", "2024-03-09", "None", "None"), ("2", "2024-02-09", "b", "2"), ("9", "2024-02-09", "None", "None"), ("2", "None", "None", "None")}
    assert history.versions(history.stacked({d: f.limit(0) for d, f in frames.items()}), "k", ["x", "y"], days).count() == 0
