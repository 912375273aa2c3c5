"""Near-duplicate embeddings.

Method: epsilon grid order join. Unit vectors are projected onto leading principal
axes, found for all vectors in one space of ``FOLD`` dimensions (longer vectors are
folded into it: sums of every ``FOLD``-th component, with signs, scaled so that the
fold is a projection, too); a projection never lengthens a distance. They are
sorted by label and
by the cells of a grid with side epsilon on these axes. The sorted sequence is
cut into blocks. Sequence intervals are joined by recursion, level by level: a
pair of intervals goes on to its parts only if their boxes on the axes are within
epsilon; what is left are block pairs, joined inside tasks by the same recursion
down to small products. Every vector of a block pair that stays is compared by
its cosine in double precision, so the axes steer the work and never the result.

Equal vectors of a label form a class and take part once, with their number. A
task gives counts of links and one link per vector to the smallest of its group;
components of these are the groups.

Cases: vectors that are null, empty, zero or hold null or non-finite components,
and rows without a label, link with nothing. Vectors of different lengths are not
compared. Repeated ids are rows like others; a null id is kept and never names a
group of others. Extra columns are left out. An empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import Shared, arrow_schema, map_batches, map_rows, numbered, record_batch, written
from cardloom.llm.components import components
from cardloom.llm.ngramjoin import smallest_of_group

COSINE = 0.93
#: Principal axes that carry the grid order, and those of the boxes.
GRID_AXES, BOX_AXES = 3, 8
#: Vectors in a block, side of a product inside a task, parts of an interval per level (as a power of two).
BLOCK, LEAF, FAN_BITS = 1024, 256, 4
#: Dimensions in which the axes are found, whatever the vectors' length.
FOLD = 64


def epsilon(cosine: float) -> float:
    """Distance of unit vectors at a cosine, with room for rounding."""
    return math.sqrt(2 - 2 * cosine) * (1 + 1e-9) + 1e-9


def unit(vector) -> np.ndarray | None:
    """The vector at length one, None if it cannot be compared."""
    if vector is None or not len(vector) or any(x is None for x in vector):
        return None
    v = np.asarray(vector, dtype=np.float64)
    top = np.abs(v).max()
    if not np.isfinite(top) or top == 0:
        return None
    v = v / top
    return v / math.sqrt(float(v @ v))


def _units(vectors: DataFrame) -> DataFrame:
    def row(rid, vec_id, label, vector):
        u = unit(vector) if label is not None else None
        return rid, vec_id, label, None if u is None else len(u), None if u is None else u.tobytes()

    kinds = dict(vectors.dtypes)
    return map_rows(vectors.select("rid", "vec_id", "label", "vector"), lambda: row, f"rid long, vec_id {kinds['vec_id']}, label {kinds['label']}, dim int, unit binary")


def folded(units: np.ndarray) -> np.ndarray:
    """Rows in ``FOLD`` dimensions: a projection onto orthonormal directions, each over every ``FOLD``-th component."""
    n, dim = units.shape
    depth = -(-dim // FOLD)
    out = np.zeros((n, depth * FOLD))
    out[:, :dim] = units
    if depth == 1:
        return out
    at = np.arange(depth * FOLD, dtype=np.uint64)
    signs = 1.0 - 2.0 * ((at * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(63)).astype(np.float64)
    held = np.bincount(np.arange(dim) % FOLD, minlength=FOLD)
    return (out * signs).reshape(n, depth, FOLD).sum(axis=1) / np.sqrt(held)


def principal_axes(classes: DataFrame) -> np.ndarray:
    """Leading axes of the second moments over all folded vectors, as rows. A task gives one matrix of FOLD * FOLD sums."""
    out = arrow_schema("at int, total double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FOLD, FOLD))
        for batch in batches:
            dims = batch.column(0).to_numpy(zero_copy_only=False)
            units = batch.column(1)
            for dim in np.unique(dims):
                m = folded(np.frombuffer(b"".join(units[int(i)].as_py() for i in np.flatnonzero(dims == dim))).reshape(-1, dim))
                total += m.T @ m
        flat = total.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], schema=out)

    total = np.zeros(FOLD * FOLD)
    for r in map_batches(classes.select("dim", "unit"), run, "at int, total double").groupBy("at").agg(F.sum("total").alias("total")).collect():
        total[r["at"]] = r.total
    matrix = total.reshape(FOLD, FOLD)
    return np.ascontiguousarray(np.linalg.eigh((matrix + matrix.T) / 2)[1][:, ::-1].T[:BOX_AXES])


def _projected(units: np.ndarray, axes: np.ndarray) -> np.ndarray:
    return folded(units) @ axes.T


def _blocks(classes: DataFrame, axes: Shared, eps: float) -> DataFrame:
    """Written blocks of the sorted sequence: label, dim, position, box, and ids, numbers and vectors as bytes."""
    label = dict(classes.dtypes)["label"]
    cells = ", ".join(f"c{k} long" for k in range(GRID_AXES))
    schema = f"class_id long, label {label}, dim int, copies long, unit binary, {cells}"

    def factory():
        known = axes.value

        def row(class_id, label, dim, copies, unit):
            y = _projected(np.frombuffer(unit)[None, :], known)[0]
            return class_id, label, dim, copies, unit, *(int(c) for c in np.floor(y[:GRID_AXES] / eps))

        return row

    order = ["label", "dim", *(f"c{k}" for k in range(GRID_AXES)), "class_id"]
    celled = map_rows(classes.select("class_id", "label", "dim", "copies", "unit"), factory, schema)
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = celled.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    schema = f"label {label}, dim int, part int, seq int, lo array<double>, hi array<double>, ids binary, copies binary, units binary"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, part, seq = axes.value, TaskContext.get().partitionId(), 0
        held: list[tuple] = []

        def block():
            _, label, dim, _, _ = held[0]
            units = np.frombuffer(b"".join(h[4] for h in held)).reshape(-1, dim)
            y = _projected(units, known)
            ids, copies = np.array([h[0] for h in held], dtype=np.int64), np.array([h[3] for h in held], dtype=np.int64)
            return label, dim, part, seq, y.min(axis=0).tolist(), y.max(axis=0).tolist(), ids.tobytes(), copies.tobytes(), units.tobytes()

        for batch in batches:
            for values in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if held and (len(held) == BLOCK or values[1:3] != held[0][1:3]):
                    yield record_batch([block()], out)
                    seq += 1
                    held.clear()
                held.append(values)
        if held:
            yield record_batch([block()], out)

    return written(map_batches(ranged, run, schema), "vector-blocks")


def _near(eps: float):
    """Whether two boxes, of columns lo / hi and lo2 / hi2, are within eps."""
    gaps = F.zip_with(F.zip_with("lo", "hi2", lambda a, b: a - b), F.zip_with("lo2", "hi", lambda a, b: a - b), lambda a, b: F.greatest(F.lit(0.0), a, b))
    return F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g) <= eps * eps


def _block_pairs(blocks: DataFrame, eps: float) -> DataFrame:
    """Pairs of blocks (part, seq, part2, seq2) that may hold vectors within eps, by recursion over intervals of the sequence."""
    boxes = written(blocks.select("label", "dim", "part", "seq", "lo", "hi"), "vector-boxes")
    most = boxes.agg(F.max("part")).first()[0] or 0
    key = ["label", "dim"]
    shifts = [0]
    while most >> shifts[0]:
        shifts.insert(0, shifts[0] + FAN_BITS)

    def nodes(shift: int) -> DataFrame:
        low = [F.min(F.col("lo")[k]).alias(f"l{k}") for k in range(BOX_AXES)]
        high = [F.max(F.col("hi")[k]).alias(f"h{k}") for k in range(BOX_AXES)]
        n = boxes.groupBy(*key, F.shiftright("part", shift).alias("node")).agg(*low, *high)
        return n.select(*key, "node", F.shiftright("node", FAN_BITS).alias("parent"), F.array(*[f"l{k}" for k in range(BOX_AXES)]).alias("lo"), F.array(*[f"h{k}" for k in range(BOX_AXES)]).alias("hi"))

    top = nodes(shifts[0])
    pairs = top.select(*key, F.col("node").alias("x"), F.col("node").alias("y"))
    for s in shifts[1:]:
        n = nodes(s)
        left = n.select(*key, F.col("parent").alias("x"), F.col("node").alias("a"), "lo", "hi")
        right = n.select(*key, F.col("parent").alias("y"), F.col("node").alias("b"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
        pairs = pairs.join(left, [*key, "x"]).join(right, [*key, "y"]).where((F.col("a") <= F.col("b")) & _near(eps)).select(*key, F.col("a").alias("x"), F.col("b").alias("y"))
    left = boxes.select(*key, F.col("part").alias("x"), "part", "seq", "lo", "hi")
    right = boxes.select(*key, F.col("part").alias("y"), F.col("part").alias("part2"), F.col("seq").alias("seq2"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    ordered = (F.col("part") < F.col("part2")) | (F.col("part") == F.col("part2")) & (F.col("seq") <= F.col("seq2"))
    return pairs.join(left, [*key, "x"]).join(right, [*key, "y"]).where(ordered & _near(eps)).select("part", "seq", "part2", "seq2")


def linked(a: np.ndarray, b: np.ndarray, ya: np.ndarray, yb: np.ndarray, same: bool, cosine: float, eps: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of linked vectors of two sorted sequences, by halving them and skipping halves whose boxes are too far apart."""
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, m, j, n = todo.pop()
        if same and n <= i:
            continue
        gap = np.maximum(0, np.maximum(ya[i:m].min(axis=0) - yb[j:n].max(axis=0), yb[j:n].min(axis=0) - ya[i:m].max(axis=0)))
        if float(gap @ gap) > eps * eps:
            continue
        if m - i > LEAF or n - j > LEAF:
            h, k = (i + m) // 2, (j + n) // 2
            for x, y in ((i, h), (h, m)) if m - i > 1 else ((i, m),):
                for u, v in ((j, k), (k, n)) if n - j > 1 else ((j, n),):
                    todo.append((x, y, u, v))
            continue
        left, right = np.nonzero(a[i:m] @ b[j:n].T >= cosine)
        left, right = left + i, right + j
        if same:
            once = left < right
            left, right = left[once], right[once]
        yield left, right


def links(blocks: DataFrame, pairs: DataFrame, axes: Shared, cosine: float, eps: float) -> DataFrame:
    """Written links: class_id, weight of its links in a block pair, smallest class of its group there."""
    first = blocks.select("part", "seq", "dim", F.col("ids").alias("ids_a"), F.col("copies").alias("copies_a"), F.col("units").alias("units_a"))
    second = blocks.select(F.col("part").alias("part2"), F.col("seq").alias("seq2"), F.col("ids").alias("ids_b"), F.col("copies").alias("copies_b"), F.col("units").alias("units_b"))
    joined = pairs.join(first, ["part", "seq"]).join(second, ["part2", "seq2"])
    joined = joined.select("dim", (F.col("part") == F.col("part2")) & (F.col("seq") == F.col("seq2")), "ids_a", "copies_a", "units_a", "ids_b", "copies_b", "units_b")
    out = arrow_schema("class_id long, links long, root long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = axes.value
        for batch in batches:
            for at in range(batch.num_rows):
                dim, same, ids_a, copies_a, units_a, ids_b, copies_b, units_b = (c[at].as_py() for c in batch.columns)
                a, b = np.frombuffer(units_a).reshape(-1, dim), np.frombuffer(units_b).reshape(-1, dim)
                ya, yb = _projected(a, known), _projected(b, known)
                found = list(linked(a, b, ya, yb, same, cosine, eps))
                left, right = (np.concatenate(x) for x in zip(*found, strict=True)) if found else ((), ())
                if not len(left):
                    continue
                ids, copies = np.frombuffer(ids_a, dtype=np.int64), np.frombuffer(copies_a, dtype=np.int64)
                if not same:
                    right = right + len(ids)
                    ids, copies = np.concatenate((ids, np.frombuffer(ids_b, dtype=np.int64))), np.concatenate((copies, np.frombuffer(copies_b, dtype=np.int64)))
                n = len(ids)
                weight = np.bincount(left, copies[right], n) + np.bincount(right, copies[left], n)
                order = np.argsort(ids)
                rank = np.empty(n, dtype=np.int64)
                rank[order] = np.arange(n)
                root = ids[order][smallest_of_group(n, rank[left], rank[right])[rank]]
                some = weight > 0
                yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(weight[some].astype(np.int64)), pa.array(root[some])], schema=out)

    return written(map_batches(joined, run, "class_id long, links long, root long"), "vector-links")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` of each row: links with cosine at least ``cosine`` inside a label."""
    eps = epsilon(cosine)
    rows = numbered(vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector"), F.col(label_col).alias("label")), "vector-rows")
    units = written(_units(rows), "vector-units")
    valid = units.where("unit is not null")
    # the bytes of equal vectors are equal, but for the sign of zeros
    classes = written(valid.groupBy("label", "dim", "unit").agg(F.min("rid").alias("class_id"), F.count(F.lit(1)).alias("copies")), "vector-classes")
    axes = Shared(vectors.sparkSession, principal_axes(classes))
    blocks = _blocks(classes, axes, eps)
    found = links(blocks, written(_block_pairs(blocks, eps), "vector-pairs"), axes, cosine, eps)

    groups = components(found.select(F.col("class_id").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    labelled = classes.join(counts, "class_id", "left").join(groups, F.col("class_id") == F.col("node"), "left")
    labelled = labelled.select("label", "dim", "unit", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "class_id").alias("root"))
    per_row = written(units.join(labelled, ["label", "dim", "unit"], "left").select("rid", "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", "rid").alias("root")), "vector-labelled")
    lowest = per_row.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    return per_row.join(lowest, "root").select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
