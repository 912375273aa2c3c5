from __future__ import annotations

import random
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from cardloom.operators import datamarts
from cardloom.plans import bitmaps
from cardloom.plans.deltas import Deltas
from cardloom.sources.versions import PART, Versions

TX = "id_transaction bigint, id_carte bigint, id_marchand bigint, situation_date date, amount decimal(12,2)"


def plain(df):
    return sorted(tuple(map(str, r)) for r in df.collect())


def test_versions(spark, tmp_path):
    table = Versions(spark, str(tmp_path / "t"), spark.range(1).selectExpr("id", "id as v").schema, ("id",), 4)
    assert table.read().count() == 0 and table.manifest() == {}
    table.write(spark.range(100).selectExpr("id", "0 as v"), "0001")
    first = table.manifest()
    assert sorted(first) == [0, 1, 2, 3] and set(first.values()) == {"0001"}

    rows = spark.createDataFrame([(5, 1)], "id bigint, v bigint")
    parts = table.touched(rows)
    assert len(parts) == 1
    changed = table.read(before="0002", parts=parts).join(rows.select("id"), "id", "left_anti").unionByName(rows)
    table.write(changed, "0002", parts)
    assert [p for p, v in table.manifest().items() if v == "0002"] == parts
    assert table.read().agg(F.sum("v"), F.count("v")).first()[:] == (1, 100)
    assert table.read(before="0002").agg(F.sum("v")).first()[0] == 0

    # a part may become empty, a version may come again, another reader needs no schema
    table.write(rows.limit(0), "0003", parts)
    assert parts[0] not in table.manifest() and table.read().where("id = 5").count() == 0
    table.write(spark.range(100, 200).selectExpr("id", "7 as v"), "0003")
    assert Versions(spark, str(tmp_path / "t")).read().agg(F.min("id"), F.max("id"), F.max("v")).first()[:] == (100, 199, 7)
    assert PART not in table.read().columns
    assert table.clean(keep=1) == ["0001", "0002"] and table.read().count() == 100
    table.write(rows.limit(0), "0004")
    assert table.read().count() == 0


def test_a_version_that_dies_is_not_seen(spark, tmp_path):
    table = Versions(spark, str(tmp_path / "t"), spark.range(1).schema, ("id",), 2)
    table.write(spark.range(10), "0001")
    with pytest.raises(Exception):
        table.write(spark.range(10).select(F.raise_error(F.lit("dies")).cast("bigint").alias("id")), "0002")
    assert table.read().count() == 10 and table.versions() == ["0001"]
    table.write(spark.range(3), "0002")
    assert table.read().count() == 3


def _batches(rng):
    """Random batches and the state they leave."""
    now, labels, batches = {}, {}, []
    for _ in range(3):
        tx, label, gone = {}, {}, set()
        for _ in range(60):
            i = rng.randint(1, 80)
            what = rng.random()
            if what < 0.5:
                tx[i] = (i, rng.choice((None, *range(10))), rng.choice((100, 101, 102, 999)), date(2024, 1, rng.randint(1, 5)), rng.choice((None, f"{rng.randint(-500, 900)}.25")))
            elif what < 0.85:
                label[i] = rng.choice("YN")
            else:
                gone.add(i)
        for i in gone:
            now.pop(i, None)
        now.update({i: row for i, row in tx.items() if i not in gone})
        labels |= label
        batches.append((list(tx.values()), list(label.items()), [(i,) for i in gone]))
    return batches, list(now.values()), labels


def test_batches_equal_a_rebuild(spark, tiny, tmp_path):
    frame = lambda rows: spark.createDataFrame(rows, TX.replace("decimal(12,2)", "string")).withColumn("amount", F.col("amount").cast("decimal(12,2)"))
    for seed in (1,):
        batches, rows, labels = _batches(random.Random(seed))
        state = Deltas(spark, str(tmp_path / f"gold{seed}"), parts=3, id_range=20)
        for k, (tx, label, gone) in enumerate(batches):
            for _ in range(1 + (k == 1)):  # a batch that comes again changes nothing
                state.apply(
                    f"{k:04}", frame(tx), spark.createDataFrame(label, "id_transaction bigint, is_fraud string"),
                    spark.createDataFrame(gone, "id_transaction bigint"), tiny["marchand"],
                )
        now, known = frame(rows), spark.createDataFrame(list(labels.items()), "id_transaction bigint, is_fraud string")
        assert plain(state.card_datamart()) == plain(datamarts.card_datamart(now, known))
        assert plain(state.daily_datamart()) == plain(datamarts.daily_datamart(now, known))
        assert plain(state.category_datamart(tiny["mcc"])) == plain(datamarts.category_datamart(now, tiny["marchand"], tiny["mcc"]))


def test_late_label_changes_one_part(spark, tiny, tmp_path):
    state = Deltas(spark, str(tmp_path / "gold"), parts=16)
    tx = tiny["transaction"].select("id_transaction", "id_carte", "id_marchand", "situation_date", "amount")
    none, ids = tiny["label_fraude"].limit(0), tx.select("id_transaction").limit(0)
    state.apply("0001", tx, none, ids, tiny["marchand"])
    before = state.card.manifest()
    state.apply("0002", tx.limit(0), spark.createDataFrame([(4, "Y")], "id_transaction bigint, is_fraud string"), ids, tiny["marchand"])
    after = state.card.manifest()
    assert sum(before[p] != after[p] for p in before) == 1
    assert {r.id_carte: r.nb_fraudes for r in state.card_datamart().collect()} == {10: 0, 11: 1, 12: 0}
    # what changes nothing writes nothing
    state.apply("0003", tx.limit(0), spark.createDataFrame([(4, "Y"), (77, "Y")], "id_transaction bigint, is_fraud string"), ids, tiny["marchand"])
    assert state.card.manifest() == after
    # the label came before its transaction
    state.apply("0004", tx.where("id_transaction = 5").withColumn("id_transaction", F.lit(77).cast("bigint")), none, ids, tiny["marchand"])
    assert {r.id_carte: r.nb_fraudes for r in state.card_datamart().collect()} == {10: 0, 11: 1, 12: 1}


def test_bitmaps(spark, tmp_path):
    rng = random.Random(8)
    merchant = spark.createDataFrame([(m, m % 3 if m < 8 else None) for m in range(9)], "id_marchand bigint, code_mcc int")
    stored, seen = bitmaps.table(spark, str(tmp_path / "b"), parts=8), Counter()
    pairs = set()
    for batch in ("0001", "0002", "0003"):
        rows = [(rng.choice((None, 0, -1, 1, 32768, 32769, 10**15, rng.randint(-70000, 70000))), rng.randint(0, 10)) for _ in range(200)]
        pairs |= {(m % 3, c) for c, m in rows if c is not None and m < 8}
        maps = bitmaps.of_batch(spark.createDataFrame(rows, "id_carte bigint, id_marchand bigint"), merchant)
        bitmaps.merge(stored, batch, maps)
        bitmaps.merge(stored, batch, maps)
        seen = Counter(code for code, _ in pairs)
        assert {r.code_mcc: r.nb_cartes_uniques for r in bitmaps.distinct_cards(stored).collect()} == seen
    one = bitmaps.of_batch(spark.createDataFrame([(5, 1)], "id_carte bigint, id_marchand bigint"), merchant)
    before = stored.manifest()
    assert len(bitmaps.merge(stored, "0004", one)) == 1
    assert sum(before.get(p) != v for p, v in stored.manifest().items()) == 1


def test_top_list(spark, tmp_path):
    from cardloom.plans.toplist import TopList

    rng = random.Random(12)
    schema = "key bigint, figure bigint"
    for k, room, keys in ((3, 2, 30), (3, 2, 4)):
        top, state, remade = TopList(spark, str(tmp_path / f"top{keys}"), k=k, room=room), {}, []
        for batch in range(6):
            changed = {rng.randint(1, keys): rng.choice((None, *range(9))) for _ in range(8)}
            if batch == 4:  # all candidates leave
                changed = {i: None if rng.random() < 0.7 else 1 for i in range(1, keys + 1)}
            state.update(changed)
            state = {i: v for i, v in state.items() if v is not None}
            every = spark.createDataFrame(list(state.items()), schema)
            for _ in range(1 + (batch == 2)):
                remade.append(top.update(f"{batch:04}", spark.createDataFrame(list(changed.items()), schema), every))
            want = sorted(state.items(), key=lambda x: (-x[1], x[0]))[:k]
            assert [tuple(r) for r in top.shown().collect()] == want, (keys, batch)
        assert True in remade and (keys < 30 or False in remade)


def test_base_edges(spark):
    from cardloom.learning import drift

    base = spark.range(1000).selectExpr("id as amount", "5 as hour", "cast(null as int) as current_age")
    edges = drift.base_edges(base, ["amount", "hour", "current_age"], classes=4)
    assert edges["hour"] == (5.0,) and edges["current_age"] == ()
    assert all(abs(e - w) <= 1 for e, w in zip(edges["amount"], (250, 500, 750)))
    same = {r.feature: r.psi for r in drift.stability_index(base, base, list(edges), edges).collect()}
    assert same == {"amount": 0.0, "hour": 0.0, "current_age": 0.0}
    moved = drift.stability_index(base, base.withColumn("amount", F.col("amount") + 400), ["amount"], edges)
    assert moved.first().psi > 0.5
