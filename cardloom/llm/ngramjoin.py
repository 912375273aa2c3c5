"""Join of documents by the Jaccard similarity of their word n-grams.

Method: rows with the same words form a class. A MinHash signature per class is
cut into bands; classes that share a band are candidates. Their MinHash values
are compared in steps, and a pair is dropped as soon as the posterior
probability that its similarity reaches the threshold (uniform prior, binomial
matches) falls below ``TOLERANCE``; the exact similarity of the rest decides.

No list of candidate pairs is written. A band's bucket is known by its smallest
class, its leader; every class goes once to each of its leaders, and the pairs
are formed inside the tasks of a leader, cut into blocks by bytes where many
classes share it. A pair is looked at under the leader of its first common band
only. Tasks give counts of links and one link from each class to the smallest of
its group; components of these are the groups.

With 40 bands of 5 values a pair at exactly 0.8 shares no band with probability
1.3e-7 and is dropped by the test with less than 1e-6; all others less.

Cases: words are parted by white space and compared in lower case; a text of
fewer words than n is one n-gram. Null, empty and blank texts have no n-gram and
link with nothing. Repeated rows are copies like others. Null ids are kept; the
smallest non-null id names a group. Texts are read whole. Extra columns are left
out. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import map_rows, numbered, python_ready, written
from cardloom.llm.components import components

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS = 40, 5
#: Values compared before each test of a pair, and the posterior probability below which it is dropped.
STEP, TOLERANCE = 25, 1e-7
#: Most bytes of texts and classes in a block; a task holds two blocks.
BLOCK_BYTES, BLOCK_CLASSES = 8 << 20, 1024

_RANDOM = np.random.default_rng(20240607)
_TIMES = _RANDOM.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLIPS = _RANDOM.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)


def ngrams(text: str | None, n: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the different n-grams of a text."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    each = pd.util.hash_array(np.array(words, dtype=object), categorize=False)
    size = min(n, len(words))
    total = np.full(len(words) - size + 1, size, dtype=np.uint64)
    for k in range(size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + each[k : k + len(total)]
        total ^= total >> np.uint64(29)
        total *= np.uint64(0xBF58476D1CE4E5B9)
        total ^= total >> np.uint64(32)
    return np.unique(total)


def signature(grams: np.ndarray) -> np.ndarray:
    """MinHash values: for each of the fixed hash functions the smallest value over the n-grams."""
    out = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(grams), 2048):
        np.minimum(out, ((grams[at : at + 2048] ^ _FLIPS[:, None]) * _TIMES[:, None]).min(axis=1), out=out)
    return out


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """(values compared, fewest matches to go on) for each step.

    With a uniform prior the posterior of the similarity after m matches in n is
    Beta(m + 1, n - m + 1), and P(it >= t) = P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in range(STEP, BANDS * ROWS + 1, STEP):
        below, m = 0.0, 0
        while True:
            below += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if below >= tolerance:
                break
            m += 1
        out.append((n, m))
    return out


def _keys(text: str | None) -> tuple[str | None, list[int] | None]:
    grams = ngrams(text)
    if not len(grams):
        return None, None
    bands = signature(grams).reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        key = (key ^ bands[:, k]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(32)
    words = hashlib.md5(" ".join(text.lower().split()).encode("utf-8", "surrogatepass"))
    return words.hexdigest(), key.astype(np.int64).tolist()


def linked_classes(a: pd.DataFrame, b: pd.DataFrame, leader: int, same: bool, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Positions (in a, in b) of the classes that are linked and whose first common band belongs to ``leader``."""
    bands_a, bands_b = np.stack(a["leaders"].to_numpy()), np.stack(b["leaders"].to_numpy())
    grams_a = [ngrams(t) for t in a["text"]]
    grams_b = grams_a if same else [ngrams(t) for t in b["text"]]
    signs_a = np.stack([signature(g) for g in grams_a])
    signs_b = signs_a if same else np.stack([signature(g) for g in grams_b])
    sizes = np.array([len(g) for g in grams_b])
    steps = least_matches(threshold)
    # n-grams as small numbers, so that one mark per n-gram tells membership
    known = np.unique(np.concatenate(grams_b))
    flat = np.searchsorted(known, np.concatenate(grams_b))
    begin = np.concatenate(([0], np.cumsum(sizes)))
    mark = np.zeros(len(known) + 1, dtype=np.int64)
    left, right = [], []
    for i in range(len(a)):
        js = np.arange(i + 1 if same else 0, len(b))
        if not len(js):
            continue
        common = (bands_b[js] == bands_a[i]) & (bands_a[i] >= 0)
        first = common.argmax(axis=1)
        js = js[common[np.arange(len(js)), first] & (bands_a[i][first] == leader)]
        # Jaccard is at most the ratio of the sizes
        js = js[np.minimum(sizes[js], len(grams_a[i])) >= threshold * np.maximum(sizes[js], len(grams_a[i])) - 1e-9]
        matches, done = np.zeros(len(js), dtype=np.int64), 0
        for n, least in steps:
            if not len(js):
                break
            matches += (signs_b[js, done:n] == signs_a[i, done:n]).sum(axis=1)
            keep = matches >= least
            js, matches, done = js[keep], matches[keep], n
        if not len(js):
            continue
        at = np.searchsorted(known, grams_a[i])
        at[known[np.minimum(at, len(known) - 1)] != grams_a[i]] = len(known)
        mark[at] = 1
        mark[len(known)] = 0
        lengths = sizes[js]
        ends = np.cumsum(lengths)
        take = np.arange(ends[-1]) + np.repeat(begin[js] - (ends - lengths), lengths)
        both = np.add.reduceat(mark[flat[take]], ends - lengths)
        mark[at] = 0
        js = js[both >= threshold * (len(grams_a[i]) + lengths - both) - 1e-9]
        left.append(np.full(len(js), i))
        right.append(js)
    none = np.empty(0, dtype=np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def smallest_of_group(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of n numbers the smallest number in its group of linked ones."""
    label = np.arange(n)
    while len(left):
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _task(pair: pd.DataFrame) -> pd.DataFrame:
    """Links among the classes of one leader's block pair: weight of the links of each class, and the smallest of its group."""
    leader, i, j = (int(pair[c].iloc[0]) for c in ("leader", "i", "j"))
    pair = pair.sort_values(["block", "class_id"], ignore_index=True)
    a, b = pair[pair["block"] == i].reset_index(drop=True), pair[pair["block"] == j].reset_index(drop=True)
    none = pd.DataFrame({"class_id": [], "links": [], "root": []}, dtype="int64")
    if not len(a) or not len(b):
        return none
    left, right = linked_classes(a, b, leader, i == j)
    if not len(left):
        return none
    rows, offset = (a, 0) if i == j else (pd.concat([a, b], ignore_index=True), len(a))
    right = right + offset
    weight = rows["copies"].to_numpy()
    links = np.bincount(left, weight[right], len(rows)) + np.bincount(right, weight[left], len(rows))
    ids = rows["class_id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    rank = np.empty(len(ids), dtype=np.int64)
    rank[order] = np.arange(len(ids))
    root = ids[order][smallest_of_group(len(ids), rank[left], rank[right])[rank]]
    some = links > 0
    return pd.DataFrame({"class_id": ids[some], "links": links[some].astype("int64"), "root": root[some]})


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``rid``, ``doc_id``, ``class_id``, ``n_links``, ``kept`` of each row.

    ``class_id`` is the smallest id that links reach, ``n_links`` counts the other
    rows linked directly, copies included, and ``kept`` holds for one row of each
    group. ``rid`` numbers the rows.
    """
    return joined(numbered(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "join-rows"))


def joined(rows: DataFrame) -> DataFrame:
    """As ``near_duplicates``, for a written table with ``rid``, ``doc_id``, ``text``."""
    signed = written(
        map_rows(rows.select("rid", "doc_id", "text"), lambda: lambda rid, key, text: (rid, key, *_keys(text)), f"rid long, doc_id {dict(rows.dtypes)['doc_id']}, words string, bands array<long>"),
        "join-bands",
    )
    classes = signed.where("words is not null").groupBy("words").agg(F.min(F.struct("rid", "bands")).alias("one"), F.count(F.lit(1)).alias("copies"))
    classes = written(classes.select(F.col("one.rid").alias("class_id"), "words", "copies", F.col("one.bands").alias("bands")), "join-classes")

    each = classes.select("class_id", F.posexplode("bands").alias("band", "key"))
    buckets = each.groupBy("band", "key").agg(F.min("class_id").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1")
    led = each.join(buckets, ["band", "key"]).groupBy("class_id").agg(F.collect_list(F.struct("band", "leader")).alias("led"))
    # at most BANDS entries per class
    lead = F.map_from_entries("led")
    leaders = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda band: F.coalesce(F.element_at(lead, band), F.lit(-1).cast("long")))
    texts = rows.select(F.col("rid").alias("class_id"), "text")
    members = led.withColumn("leaders", leaders).drop("led").join(classes.select("class_id", "copies"), "class_id").join(texts, "class_id")
    members = written(members, "join-members")

    to_leader = members.select("class_id", F.length("text").alias("chars"), F.explode(F.array_distinct(F.filter("leaders", lambda x: x >= 0))).alias("leader"))
    # written, as joins that share a stage with an aggregate cannot be split where a key is hot
    sums = written(to_leader.groupBy("leader").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars")), "join-leaders")
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_CLASSES), F.ceil(F.col("chars") / BLOCK_BYTES)).cast("int")
    placed = to_leader.join(sums.select("leader", blocks.alias("blocks")), "leader")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int"))
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    placed = placed.select("class_id", "leader", "block", F.explode(others).alias("other"))
    placed = placed.select("class_id", "leader", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    tasks = placed.join(members, "class_id")
    python_ready(rows.sparkSession)
    links = written(tasks.groupBy("leader", "i", "j").applyInPandas(_task, "class_id long, links long, root long"), "join-links")

    groups = components(links.select(F.col("class_id").alias("a"), F.col("root").alias("b")))
    counts = links.groupBy("class_id").agg(F.sum("links").alias("links"))
    labelled = classes.join(counts, "class_id", "left").join(groups, F.col("class_id") == F.col("node"), "left")
    labelled = labelled.select("words", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "class_id").alias("root"))
    per_row = written(signed.select("rid", "doc_id", "words").join(labelled, "words", "left").select(
        "rid", "doc_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", "rid").alias("root")), "join-rows")
    first = written(per_row.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("first")), "join-first")
    out = per_row.join(first, "root")
    return out.select("rid", "doc_id", F.col("first.doc_id").alias("class_id"), "n_links", (F.col("rid") == F.col("first.rid")).alias("kept"))
