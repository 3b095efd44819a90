"""Near duplicates by MinHash bands with sequential Bayesian verification.

Method: a text is the set of its distinct two-word shingles, as 64-bit hashes. Texts with
equal sets are one node. A node's 160 minimum hashes make 32 bands of 5; nodes that share
a band meet in its bucket. In each bucket one node, the pivot, is the smallest by hash,
so that nodes that meet often have the same pivot, and all others are compared with it: a pair's
signatures are compared in batches of 32 hashes, and it is dropped as soon as the posterior
probability of a similarity of 0.8, under a uniform prior, falls below ``MISS``.
Survivors are verified exactly on their full sets. Components of these links leave few
open questions: nodes of different components that met in a bucket without the pivot. Where
few components met, each two of them are compared; where many did, the buckets that
share components are taken together and their nodes dealt to blocks. Both go by cells of
about 64 by 256 or 256 by 256 sets, exactly and without listing pairs, so no pair that
shares a bucket stays unanswered unless both sides are connected already. Nothing is capped.

A pair of similarity 0.8 shares no bucket with a probability of 3e-6; pairs of equal sets
always do.

Words are separated by ASCII white space and A-Z are lower-cased. A text of one word is the set of
that word; texts without words have an empty set and are linked with nothing. Rows
that repeat a document are in one component; a null id is never the smallest one unless
the component has no other. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillsight.llm.arrowio import map_batches, texts
from tillsight.llm.components import components, few_tasks, joined_components
from tillsight.llm.hashing import WordHasher, mix
from tillsight.llm.sized import bounded, merged, small
from tillsight.session import cut_lineage

BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
BATCH = 32  # hashes that are compared before each decision
MISS = 1e-6  # posterior probability at which a pair is given up
SHARE = 80  # percent of the union that the intersection must have
CELL_LEFT, CELL_RIGHT = 64, 256  # sets that are compared at once
FEW = 8  # components of a bucket that are compared pair by pair
STEP = 8192  # shingles that are hashed at once
SETS_PER_TASK = 500  # pairs of full sets that are worth a task

SEEDS = mix(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
FACTORS = mix(SEEDS) | np.uint64(1)


def shingles(words: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of the two-word shingles; of the word if there is but one."""
    if len(words) > 1:
        return np.unique(mix(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:]))
    return mix(words + np.uint64(1))


def minima(found: np.ndarray) -> np.ndarray:
    out = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(found), STEP):
        part = (found[None, start : start + STEP] ^ SEEDS[:, None]) * FACTORS[:, None]
        np.minimum(out, part.min(axis=1), out=out)
    return out


def node_of(found: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(found.tobytes(), digest_size=8).digest(), "little", signed=True)


def band_keys(lows: np.ndarray) -> np.ndarray:
    """One number for each band of a node's minimum hashes."""
    keys = np.arange(BANDS, dtype=np.uint64)
    for row in lows.reshape(BANDS, ROWS).T:
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + row)
    return keys


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, version: a hash of the text, size, node, bands, signature); the last three are null for empty sets."""

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        hasher = WordHasher()

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingles(w) for w in hasher.texts(texts(batch.column(2)))]
            lows = [minima(s) if len(s) else None for s in sets]
            return pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([node_of(s) if len(s) else None for s in sets], pa.int64()),
                pa.array([None if x is None else band_keys(x).view("i8").tolist() for x in lows], pa.list_(pa.int64())),
                pa.array([None if x is None else (x >> np.uint64(32)).astype("u1").tobytes() for x in lows], pa.binary()),
            ], ["doc_id", "version", "size", "node", "bands", "signature"])

        return run

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("version"), text)
    return map_batches(rows, make, "doc_id long, version long, size long, node long, bands array<long>, signature binary")


def least_matches() -> list[int]:
    """For each number of compared hashes, the fewest equal ones with which a pair stays."""
    likely = (np.arange(2000) + 0.5) / 2000  # uniform prior
    equal = likely + (1 - likely) / 256  # a byte of a hash may be equal by chance
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        for m in range(n + 1):
            weight = m * np.log(equal) + (n - m) * np.log1p(-np.minimum(equal, 1 - 1e-12))
            weight = np.exp(weight - weight.max())
            if weight[likely >= SHARE / 100].sum() >= MISS * weight.sum():
                out.append(m)
                break
    return out


def plausible(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures leave a similarity of 0.8 possible."""
    signed = nodes.select("node", "signature", "size")
    left = signed.select(F.col("node").alias("a"), F.col("signature").alias("s"), F.col("size").alias("m"))
    right = signed.select(F.col("node").alias("b"), F.col("signature").alias("t"), F.col("size").alias("n"))
    # The larger set bounds the similarity.
    count = pairs.count()
    rows = merged(pairs, count).join(left, "a").join(right, "b").filter(F.least("m", "n") * 100 >= F.greatest("m", "n") * SHARE)
    rows = few_tasks(rows, count)

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        least = least_matches()

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            s, t = (np.frombuffer(b"".join(batch.column(k).to_pylist()), "u1").reshape(-1, HASHES) for k in (2, 3))
            alive = np.arange(batch.num_rows)
            matches = np.zeros(batch.num_rows, dtype=np.int64)
            for i, enough in enumerate(least):
                part = slice(i * BATCH, (i + 1) * BATCH)
                matches[alive] += (s[alive, part] == t[alive, part]).sum(axis=1)
                alive = alive[matches[alive] >= enough]
            return batch.select([0, 1]).take(pa.array(alive))

        return run

    return map_batches(rows.select("a", "b", "s", "t"), make, "a long, b long")


def packed(found: np.ndarray) -> bytes:
    """The upper 48 bits of each hash."""
    return (found >> np.uint64(32)).astype("<u4").tobytes() + (found >> np.uint64(16)).astype("<u2").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    n = len(data) // 6
    return (np.frombuffer(data, "<u4", n).astype(np.uint64) << np.uint64(16)) | np.frombuffer(data, "<u2", n, 4 * n)


def full_sets(docs: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles) of the wanted nodes, made again from their texts."""
    wanted = cut_lineage(bounded(nodes.select("node", "doc")).join(wanted.distinct(), "node"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.join(small(wanted), F.col("doc_id").eqNullSafe(F.col("doc"))).select("node", "text")

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        hasher = WordHasher()

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingles(w) for w in hasher.texts(texts(batch.column(1)))]
            # One id may stand before several texts; only the node's own counts.
            right = [i for i, (s, n) in enumerate(zip(sets, batch.column(0).to_pylist())) if len(s) and node_of(s) == n]
            return pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(right, pa.int64())), pa.array([packed(sets[i]) for i in right], pa.binary())], ["node", "shingles"]
            )

        return run

    return map_batches(rows, make, "node long, shingles binary").dropDuplicates(["node"])


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar on their full sets."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("s"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("t"))

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            flags = []
            for s, t in zip(batch.column("s").to_pylist(), batch.column("t").to_pylist()):
                x, y = unpacked(s), unpacked(t)
                common = len(np.intersect1d(x, y, assume_unique=True))
                flags.append(100 * common >= SHARE * (len(x) + len(y) - common))
            return batch.select(["a", "b"]).filter(pa.array(flags, pa.bool_()))

        return run

    count = pairs.count()
    rows = few_tasks(merged(pairs, count).join(left, "a").join(right, "b").select("a", "b", "s", "t"), count, SETS_PER_TASK)
    return map_batches(rows, make, "a long, b long")


def pivots(members: DataFrame) -> DataFrame:
    """(bucket, pivot) of the buckets in which nodes meet."""
    found = members.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("pivot"))
    return found.filter("n > 1").select("bucket", "pivot")


def meetings(members: DataFrame, buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """(bucket, c, several): components that met in a bucket beside its pivot, where there are several."""
    met = members.join(bounded(buckets), "bucket").filter("node <> pivot").join(bounded(labels), "node", "left")
    met = met.select("bucket", F.coalesce("component", "node").alias("c")).distinct()
    counts = met.groupBy("bucket").agg(F.count("*").alias("several")).filter("several > 1")
    return met.join(counts, "bucket")


def open_questions(met: DataFrame, labels: DataFrame) -> DataFrame:
    """(left, right): pairs of components that met in a bucket of few. Left is the smaller one."""
    few = met.filter(F.col("several") <= FEW).select("bucket", "c")
    sizes = labels.groupBy(F.col("component").alias("c")).agg(F.count("*").alias("size"))
    sized = few.join(merged(sizes, labels.count()), "c", "left").select("bucket", F.struct(F.coalesce("size", F.lit(1)).alias("size"), "c").alias("x"))
    pairs = sized.join(sized.select("bucket", F.col("x").alias("y")), "bucket").filter("x < y")
    return pairs.select(F.col("x.c").alias("left"), F.col("y.c").alias("right")).distinct()


def neighbourhoods(met: DataFrame, labels: DataFrame) -> DataFrame:
    """(group, node, component, major): the nodes of components that met in buckets of many,
    grouped by buckets that share components; major tells the group's largest component."""
    many = met.filter(F.col("several") > FEW)
    # A bucket and a component are both 64-bit hashes here: nodes of one graph.
    groups = components(many.select(F.col("bucket").alias("a"), F.col("c").alias("b")))
    placed = many.select("c").distinct().join(merged(groups, many.count()), F.col("c") == F.col("node"))
    placed = placed.select(F.col("component").alias("group"), "c")
    nodes = placed.join(bounded(labels.select(F.col("component").alias("c"), "node")), "c", "left")
    nodes = cut_lineage(nodes.select("group", "c", F.coalesce("node", "c").alias("node")))
    sizes = nodes.groupBy("group", "c").agg(F.count("*").alias("size"))
    largest = sizes.groupBy("group").agg(F.max(F.struct("size", "c")).alias("top")).select("group", F.col("top.c").alias("top"))
    return nodes.join(largest, "group").select("group", "node", F.col("c").alias("component"), (F.col("c") == F.col("top")).alias("major"))


def links_within(near: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): links between different components of a group. Its nodes are dealt to blocks,
    and each pair of blocks is one cell, but for pairs of the largest component's own blocks."""
    near = cut_lineage(near)
    counts = near.groupBy("group").agg(F.count_if("major").alias("n"), F.count_if(~F.col("major")).alias("m"))
    blocks = counts.select("group", *[F.greatest(F.ceil(F.col(c) / CELL_RIGHT).cast("int"), F.lit(1)).alias(c) for c in "mn"])
    place = F.pmod(F.xxhash64("node"), F.when(F.col("major"), F.col("n")).otherwise(F.col("m"))).cast("int")
    rows = near.join(blocks, "group").withColumn("block", place + F.when(F.col("major"), F.col("m")).otherwise(0))
    others = F.when(F.col("major"), F.sequence(F.lit(0), F.col("m") - 1)).otherwise(F.sequence(F.lit(0), F.col("m") + F.col("n") - 1))
    rows = rows.select("group", "node", "component", "block", F.explode(others).alias("other"))
    rows = rows.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    rows = merged(rows, near.count()).join(sets, "node").select("group", "low", "high", "node", "component", "block", "shingles")

    def cell(table: pa.Table) -> pa.Table:
        low = table["low"][0].as_py()
        left = np.array(table["block"].to_pylist()) == low
        right = ~left if low != table["high"][0].as_py() else left
        pick = lambda flags: table.filter(pa.array(flags))
        return linked(pick(left), pick(right))

    return rows.groupBy("group", "low", "high").applyInArrow(cell, "a long, b long")


def linked(left: pa.Table, right: pa.Table) -> pa.Table:
    """The similar pairs of different components among rows (node, component, shingles) of two blocks."""
    found: list[tuple[int, int]] = []
    if left.num_rows and right.num_rows:
        names, owners = (np.array(right[c].to_pylist(), dtype=np.int64) for c in ("node", "component"))
        others = [unpacked(x) for x in right["shingles"].to_pylist()]
        sizes = np.array([len(x) for x in others])
        joined = np.concatenate(others)
        order = np.argsort(joined, kind="stable")
        joined, owner = joined[order], np.repeat(np.arange(len(others)), sizes)[order]
        for node, component, data in zip(*(left[c].to_pylist() for c in ("node", "component", "shingles"))):
            own = unpacked(data)
            low, high = np.searchsorted(joined, own), np.searchsorted(joined, own, side="right")
            spans = high - low
            at = np.repeat(low - np.concatenate([[0], np.cumsum(spans)[:-1]]), spans) + np.arange(spans.sum())
            common = np.bincount(owner[at], minlength=len(others))
            similar = 100 * common >= SHARE * (len(own) + sizes - common)
            found += [(node, int(names[k])) for k in np.flatnonzero(similar & (owners != component))]
    return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})


def links_between(questions: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): a link between the two components of each question that has one, found in cells of sets."""
    known = bounded(labels)
    asked = questions.select(F.col("left").alias("component"), "right").join(known, "component", "left")
    asked = asked.select("right", F.coalesce("node", "component").alias("a")).distinct()
    loads = asked.groupBy("right").agg(F.count("*").alias("lefts"))
    targets = questions.select("right").distinct().join(loads, "right")
    members = targets.join(merged(labels.withColumnRenamed("component", "right"), labels.count()), "right", "left")
    members = members.select("right", "lefts", F.coalesce("node", "right").alias("b"))
    counts = members.groupBy("right").agg(F.count("*").alias("rights"))
    columns = F.ceil(F.col("rights") / CELL_RIGHT).cast("int")
    rows_ = F.ceil(F.col("lefts") / CELL_LEFT).cast("int")
    # Each left set goes to one row of cells, each right set to one column.
    left = asked.join(loads.join(counts, "right"), "right").select(
        "right", "a", F.pmod(F.xxhash64("a"), rows_).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), columns - 1)).alias("j")
    )
    right = members.join(counts, "right").select(
        "right", "b", F.explode(F.sequence(F.lit(0), rows_ - 1)).alias("i"), F.pmod(F.xxhash64("b"), columns).cast("int").alias("j")
    )
    left = left.join(sets.select(F.col("node").alias("a"), "shingles"), "a")
    right = right.join(sets.select(F.col("node").alias("b"), "shingles"), "b")

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        # The sides are different components by their question.
        sides = (x.rename_columns([*x.column_names[:-2], "node", "shingles"]) for x in (left, right))
        mark = lambda x, i: x.append_column("component", pa.array([i] * x.num_rows, pa.int64()))
        return linked(*(mark(x, i) for i, x in enumerate(sides)))

    # Own names on each side: both come from the same tables.
    left, right = (x.select("right", "i", "j", y, "shingles") for x, y in ((left, "a"), (right, "b")))
    left, right = left.toDF("to", "row", "column", "a", "own"), right.toDF("from", "i", "j", "b", "shingles")
    cells = left.groupBy("to", "row", "column").cogroup(right.groupBy("from", "i", "j"))
    return cells.applyInArrow(cell, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, version, n_shingles, component_id (smallest id of the component), kept."""
    rows = cut_lineage(signatures(docs))
    nodes = rows.filter("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("doc"), F.first("size").alias("size"), F.first("bands").alias("bands"), F.first("signature").alias("signature")
    )
    nodes = cut_lineage(nodes)
    members = nodes.select("node", F.explode("bands").alias("bucket"))
    buckets = cut_lineage(pivots(members))
    pairs = members.join(bounded(buckets), "bucket").filter("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    pairs = cut_lineage(plausible(cut_lineage(pairs), nodes))
    sets = cut_lineage(full_sets(docs, nodes, pairs.select(F.col("a").alias("node")).union(pairs.select("b"))))
    links = cut_lineage(verified(pairs, sets))
    labels = cut_lineage(components(links))
    met = cut_lineage(meetings(members, buckets, labels))
    more = open_links(docs, nodes, labels, met)
    if more is not None:
        labels = cut_lineage(joined_components(labels, more))
    smallest = bounded(labels).join(nodes.select("node", "doc"), "node")
    smallest = smallest.join(smallest.groupBy("component").agg(F.min("doc").alias("least")), "component").select("node", "least")
    own = nodes.select("node", "doc").join(smallest, "node", "left").select("node", F.coalesce("least", "doc").alias("component_id"))
    out = rows.select("doc_id", "version", "size", "node").join(bounded(cut_lineage(own)), "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "version", F.col("size").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def open_links(docs: DataFrame, nodes: DataFrame, labels: DataFrame, met: DataFrame) -> DataFrame | None:
    """(a, b): the links that the comparisons with pivots left open."""
    if met.isEmpty():
        return None
    wanted = met.select(F.col("c").alias("component")).distinct().join(bounded(labels), "component", "left")
    sets = cut_lineage(full_sets(docs, nodes, wanted.select(F.coalesce("node", "component").alias("node"))))
    found = links_between(cut_lineage(open_questions(met, labels)), labels, sets)
    if not met.filter(F.col("several") > FEW).isEmpty():
        found = found.union(links_within(neighbourhoods(met, labels), sets))
    return cut_lineage(found)


def op9_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{folder}/documents.parquet")).drop("version")
