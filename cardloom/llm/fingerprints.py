"""Document fingerprints: bottom-k sketches of shingle hashes, as column expressions only.

Method: a text's shingles of five words are hashed to 64 bits and the k smallest
different hashes are kept, in ascending order. Sketches of parts merge to the
sketch of the whole; from two sketches follow resemblance, containment and the
numbers of different shingles. Texts with at most k shingles are held exactly.

Cases: words are parted by white space and compared in lower case; fewer than
five words are one shingle. Null, empty and blank texts have an empty sketch;
two empty sketches resemble each other with 1, an empty and another with 0. Texts
are read whole. Rows with equal ids follow each other by text; null ids come
last. A single row is its own next one. Extra columns are left out. An empty
table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORDS, KEPT = 5, 256
#: Rows of a slice of the id order, and the most slices.
SLICE_ROWS, MAX_SLICES = 1000, 1 << 16

_NONE = "cast(array() as array<bigint>)"


def _with(value: Column, use) -> Column:
    """``use`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def sketch(text: Column, k: int = KEPT, n: int = WORDS) -> Column:
    """Sorted array of the k smallest shingle hashes of a text."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), "")

    def of(ws: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(ws) - (n - 1), F.lit(1)))
        hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(ws, i, n)))
        return F.when(F.size(ws) == 0, F.expr(_NONE)).otherwise(F.slice(F.sort_array(F.array_distinct(hashes)), 1, k))

    return _with(words, of)


def merged(a: Column, b: Column, k: int = KEPT) -> Column:
    """Sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merged_by(frame: DataFrame, keys: list[str], sketch_col: str, k: int = KEPT) -> DataFrame:
    """``keys`` and the sketch of all rows of a group. Tasks keep k hashes per group before the shuffle, so groups of any size merge."""
    each = frame.select(*keys, F.explode_outer(sketch_col).alias("_hash")).distinct()
    lowest = Window.partitionBy(*keys).orderBy(F.col("_hash").asc_nulls_last())
    kept = each.withColumn("_rank", F.row_number().over(lowest)).where(F.col("_rank") <= k)
    return kept.groupBy(*keys).agg(F.sort_array(F.collect_list("_hash")).alias(sketch_col))


def resemblance(a: Column, b: Column, k: int = KEPT) -> Column:
    """Share of the shingles of either that both have: of the k smallest of both together, those in both."""
    both = _with(merged(a, b, k), lambda u: F.size(F.array_intersect(F.array_intersect(a, b), u)) / F.greatest(F.size(u), F.lit(1)))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(both)


def distinct_shingles(a: Column, k: int = KEPT) -> Column:
    """Number of different shingles; exact below k."""
    share = (F.element_at(a, -1).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = KEPT) -> Column:
    """Share of a's shingles that b has too."""
    j = resemblance(a, b, k)
    size_a, size_b = distinct_shingles(a, k), distinct_shingles(b, k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), j / (1 + j) * (size_a + size_b) / size_a))


def as_text(a: Column) -> Column:
    """Sketch as a string, 16 hexadecimal digits per hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def _slices(ids: DataFrame) -> list:
    """Ascending ids that begin a slice of the order; read from the id column only, at most ``MAX_SLICES``."""
    n = ids.count()
    parts = min(MAX_SLICES, n // SLICE_ROWS + 1)
    at = [i / parts for i in range(1, parts)]
    marks = ids.agg(F.percentile_approx("id", at, max(10_000, 4 * parts)).alias("m")).first().m if at else []
    rough = sorted({m for m in marks or [] if m is not None})
    # the marks may be rounded, so a slice begins at its smallest id
    firsts = ids.where("id is not null").groupBy(_slice_of(F.col("id"), rough).alias("s")).agg(F.min("id").alias("id")).select("id").collect()
    return sorted(r.id for r in firsts)


def _slice_of(number: Column, marks: list) -> Column:
    """How many of the ascending marks are at most ``number``: counted among every root-th, then among those in between."""
    if not marks:
        return F.lit(0)
    step = max(1, round(len(marks) ** 0.5))
    groups = [marks[i : i + step] for i in range(0, len(marks), step)]
    kind = "bigint" if all(isinstance(m, int) for m in marks) else "double"
    lists = F.array(*[F.array(*[F.lit(m).cast(kind) for m in g]) for g in groups])
    heads = F.array(*[F.lit(g[0]).cast(kind) for g in groups])
    head = F.size(F.filter(heads, lambda m: m <= number))
    inside = F.size(F.filter(F.element_at(lists, F.greatest(head, F.lit(1))), lambda m: m <= number))
    return F.when(head == 0, 0).otherwise((head - 1) * step + inside)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text``, ``next_text``: each row with the text of the next one in id order, the last with the first's.

    The order is cut into slices of about ``SLICE_ROWS`` rows, and the first row
    of a slice goes to the slice before, too; so one shuffle of the texts
    suffices and no task holds more than its slices.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    firsts = _slices(rows.select("id"))
    slices = max(1, len(firsts))
    own = F.when(F.col("id").isNull(), slices - 1).otherwise(_slice_of(F.col("id"), firsts) - 1) if firsts else F.lit(0)
    head = F.coalesce(F.col("id") == F.element_at(F.array(*map(F.lit, firsts)), F.col("slice") + 1), F.lit(False)) if firsts else F.lit(True)
    placed = rows.withColumn("slice", own.cast("int"))
    here = F.struct(F.lit(0).alias("copy"), F.col("slice").alias("at"))
    before = F.struct(F.lit(1).alias("copy"), F.pmod(F.col("slice") - 1 + slices, F.lit(slices)).cast("int").alias("at"))
    placed = placed.select("id", "text", F.explode(F.when(head, F.array(here, before)).otherwise(F.array(here))).alias("to"))
    order = Window.partitionBy("to.at").orderBy("to.copy", F.col("id").asc_nulls_last(), "text")
    return placed.withColumn("next_text", F.lead("text").over(order)).where("to.copy = 0").select(F.col("id").alias("doc_id"), "text", "next_text")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = KEPT) -> DataFrame:
    """Fingerprints of each text and of its edited text, with the likeness to that and to the next text."""
    rows = with_next(docs, id_col, text_col).withColumn("n_chars", F.length("text").cast("long"))
    tail = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - tail), F.substring("next_text", F.lit(1), tail))
    rows = rows.withColumn("edited", edited)
    rows = rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), sketch(F.col("text"), k).alias("a"), sketch(F.col("edited"), k).alias("b"), sketch(F.col("next_text"), k).alias("c"),
    )
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", as_text(a).alias("fingerprint"), as_text(b).alias("edited_fingerprint"),
        resemblance(a, b, k).alias("near_edited"), resemblance(a, c, k).alias("near_next"), distinct_shingles(a, k).alias("n_shingles"),
    )
