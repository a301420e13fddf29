"""N-gram Jaccard join: chosen-path join over sets of word shingles.

Each document is the set of its five-word shingles, embedded as a fixed number of minimum hashes
(coordinates). A run sends every set down a path of sampled coordinates: sets that share the value
at the sampled coordinate share the next node, and a node is split further only while it holds
more than a few sets. Small nodes, and at the end the large ones block by block, are compared by
brute force on the whole sets. Runs repeat until a pair at the threshold is met with the target
probability even at the greatest depth. Equal sets are joined once and counted with their number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
import xxhash
from pyspark.sql import DataFrame

from tamiz.llm.common import Bloom, groups, lists, mix64, small_batches, stored

WIDTH = 5
THRESHOLD = 0.8
RECALL = 0.999
#: Sets that a node may hold without being split, longest path, and sets that are compared as one block.
NODE_SETS = 64
DEPTH = 3
BLOCK = 512


def runs_needed(threshold: float = THRESHOLD, recall: float = RECALL, depth: int = DEPTH) -> int:
    """Runs after which a pair at the threshold has met with probability ``recall`` at full depth."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold ** depth))


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Hashes of the distinct runs of ``width`` words, sorted. A text of fewer words is one shingle; none has none."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    hashes = np.fromiter(map(digest, words), np.uint64, len(words))
    if len(words) < width:
        return np.array([digest(b" ".join(words), seed=1)], np.uint64)
    n = len(words) - width + 1
    rolled = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            rolled = mix64(rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[i:i + n])
    return np.unique(rolled)


def _coordinates(sets: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Minimum of the set under each of the seeded hashes; long sets go in pieces."""
    least = np.full(len(seeds), np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(sets), 4096):
            x = sets[at:at + 4096, None] * seeds[None, :]
            x ^= x >> np.uint64(32)
            np.minimum(least, (x * np.uint64(0xD6E8FEB86659FD93)).min(axis=0), out=least)
    return least


def embedded(docs: DataFrame, doc_id: str, text: str, width: int, runs: int, depth: int) -> DataFrame:
    """doc_id, node (128-bit name of the shingle set), size and, run after run, the nodes of a path to full depth."""
    seeds = mix64(np.arange(1, runs * depth + 1, dtype=np.uint64)) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, sizes, paths = [], [], []
            for value in batch.column(1):
                found = shingles(value.as_py(), width)
                names.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                sizes.append(len(found))
                if not len(found):
                    paths.append(None)
                    continue
                values = _coordinates(found, seeds).reshape(runs, depth)
                path = np.empty((runs, depth), np.uint64)
                at = mix64(np.arange(runs, dtype=np.uint64))
                with np.errstate(over="ignore"):
                    for d in range(depth):
                        at = mix64(at * np.uint64(31) + values[:, d])
                        path[:, d] = at
                paths.append(path.view(np.int64).ravel())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.array(paths, pa.list_(pa.int64()))], names=["doc_id", "node", "size", "path"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, node binary, size long, path array<bigint>")


def leaves(sets: DataFrame, runs: int, depth: int, node_sets: int) -> DataFrame:
    """node, run, leaf, n: where each set ends in each run, for the leaves that hold more than one set."""
    rows = sets.select("node", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(runs - 1)), lambda r: F.slice("path", r * depth + 1, depth))).alias("run", "ids"))
    ended = []
    for level in range(depth):
        rows = rows.withColumn("leaf", F.get("ids", F.lit(level)))
        held = rows.groupBy("leaf").agg(F.count("*").alias("n")).filter("n > 1")
        rows = stored(rows.join(held, "leaf"), f"level{level}")
        last = level == depth - 1
        ended.append(rows.select("node", "run", "leaf", "n") if last else
                     rows.filter(F.col("n") <= node_sets).select("node", "run", "leaf", "n"))
        if last:
            break
        rows = rows.filter(F.col("n") > node_sets).select("node", "run", "ids")
    out = ended[0]
    for more in ended[1:]:
        out = out.unionByName(more)
    return out


def _fresh(found: DataFrame, runs: int) -> DataFrame:
    """``found`` with ``met``, the leaf of the set in every run, without leaves whose sets all met in an earlier run."""
    by_set = found.groupBy("node").agg(F.map_from_entries(F.collect_list(F.struct("run", "leaf"))).alias("by_run"))
    met = F.transform(F.sequence(F.lit(0), F.lit(runs - 1)), lambda r: F.try_element_at("by_run", r))
    tagged = stored(found.join(by_set.select("node", met.alias("met")), "node"), "leaves")
    # Equal in all sets: least and greatest agree and none is missing.
    ends = [f(F.get("met", F.lit(r))).alias(f"{n}{r}") for r in range(runs) for f, n in ((F.min, "a"), (F.max, "z"), (F.count, "c"))]
    spread = tagged.groupBy("leaf", "run").agg(F.count("*").alias("all"), *ends)
    before = F.lit(False)
    for r in range(runs):
        before = before | ((F.col("run") > r) & (F.col(f"a{r}") == F.col(f"z{r}")) & (F.col(f"c{r}") == F.col("all")))
    return tagged.join(spread.filter(~before).select("leaf"), "leaf", "left_semi")


def compare(sets: list[np.ndarray], met: np.ndarray, run: int, threshold: float,
            left: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of indices whose sets are alike and that did not meet in an earlier run.

    Intersections are counted on shingles that two sets share, a bounded number of them at a time.
    With ``left`` (True for one block) only pairs across the blocks are looked at.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    first, second = np.triu_indices(n, 1)
    keep = threshold * np.maximum(sizes[first], sizes[second]) <= np.minimum(sizes[first], sizes[second]) + 1e-9
    if left is not None:
        keep &= left[first] != left[second]
    first, second = first[keep], second[keep]
    for r in range(run):
        if not len(first):
            break
        apart = (met[first, r] != met[second, r]) | (met[first, r] == MISSING)
        first, second = first[apart], second[apart]
    if not len(first):
        return first, second
    used = np.unique(np.concatenate([first, second]))
    if len(first) <= 4 * len(used) or n <= 8:
        shared = np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                           for a, b in zip(first.tolist(), second.tolist())], np.int64)
    else:
        counts = np.zeros((n, n), np.float64)
        owner = np.repeat(np.arange(n), sizes)
        values, where, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        common = times[where] > 1
        owner, where = owner[common], where[common]
        dense = np.cumsum(times > 1) - 1
        where = dense[where]
        width = max(256, 4_000_000 // n)
        order = np.argsort(where, kind="stable")
        owner, where = owner[order], where[order]
        for at in range(0, int(where[-1]) + 1 if len(where) else 0, width):
            lo, hi = np.searchsorted(where, [at, at + width])
            matrix = np.zeros((n, width), np.float32)
            matrix[owner[lo:hi], where[lo:hi] - at] = 1
            counts += matrix @ matrix.T
        shared = counts[first, second].astype(np.int64)
    alike = shared >= threshold * (sizes[first] + sizes[second] - shared) - 1e-9
    return first[alike], second[alike]


#: Stands for a run in which a set is alone in its leaf.
MISSING = np.iinfo(np.int64).min


def _forest(n: int, first: np.ndarray, second: np.ndarray) -> list[tuple[int, int]]:
    """Pairs that connect what all pairs connect: one fewer than a component has members."""
    parent = list(range(n))
    tree = []
    for a, b in zip(first.tolist(), second.tolist()):
        x, y = a, b
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        while parent[y] != y:
            parent[y] = y = parent[parent[y]]
        if x != y:
            parent[y] = x
            tree.append((a, b))
    return tree


def links(candidates: DataFrame, threshold: float, block: int) -> DataFrame:
    """Brute force in each leaf. ``candidates``: leaf, run, n, node, copies, met, set.

    Rows (node, n_links, other): links to others with their copies, and the pairs of a forest. All pairs
    of a leaf are looked at in the task, none is sent anywhere. A leaf beyond ``block`` sets is cut
    into blocks, and every pair of blocks is a task's work of bounded size.
    """
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    dealt = (candidates.withColumn("blocks", blocks).withColumn("own", own)
             .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("unit", F.xxhash64("leaf", F.least("own", "with"), F.greatest("own", "with")))
             .withColumn("within", F.col("own") == F.col("with"))
             .select("unit", "run", "node", "copies", "met", "set", "own", "with", "within"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[], [], []]
        for group in groups(batches, "unit"):
            if group.num_rows > 1:
                nodes = group.column("node").to_pylist()
                first = list({node: i for i, node in reversed(list(enumerate(nodes)))}.values())
                if len(first) < len(nodes):  # repeated rows bring their set more than once
                    group = group.take(pa.array(sorted(first)))
                for column, values in zip(out, _compare_group(group, threshold)):
                    column.extend(values)
            if len(out[0]) > 20_000:
                yield _links_batch(out)
                out = [[], [], []]
        if out[0]:
            yield _links_batch(out)

    return (dealt.repartition("unit").sortWithinPartitions("unit")
            .mapInArrow(run, "node binary, n_links long, other binary"))


def _links_batch(out: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(out[0], pa.binary()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())],
        names=["node", "n_links", "other"])


def _compare_group(group: pa.Table, threshold: float) -> tuple[list, list, list]:
    values, offsets = lists(group.column("set"))
    values = values.view(np.uint64)
    sets = [values[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
    met = np.array([[MISSING if v is None else v for v in row] for row in group.column("met").to_pylist()], np.int64)
    run = group.column("run")[0].as_py()
    within = group.column("within").to_numpy()
    own = group.column("own").to_numpy()
    # A unit is one block, whose pairs all count, or two blocks, of which pairs across count.
    left = None if within.all() else own == own.min()
    first, second = compare(sets, met, run, threshold, left)
    if not len(first):
        return [], [], []
    nodes = group.column("node").to_pylist()
    copies = group.column("copies").to_numpy()
    weight = np.bincount(first, copies[second], len(sets)) + np.bincount(second, copies[first], len(sets))
    linked = np.flatnonzero(weight).tolist()
    tree = _forest(len(sets), first, second)
    return ([nodes[i] for i in linked] + [nodes[a] for a, _ in tree],
            [int(weight[i]) for i in linked] + [0] * len(tree),
            [None] * len(linked) + [nodes[b] for _, b in tree])


def components(edges: DataFrame) -> DataFrame:
    """node, root: the least name in the component of each node of ``edges`` (node, other).

    Each round gives a node the least root among its own and its neighbours' and then that root's
    root; rounds halve chains and end when nothing changes.
    """
    both = stored(edges.select("node", "other").unionByName(
        edges.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct(), "edges")
    roots = stored(both.groupBy("node").agg(F.min("other").alias("least"))
                   .select("node", F.least("node", "least").alias("root")), "roots")
    while True:
        near = (both.join(roots.select(F.col("node").alias("other"), "root"), "other")
                .groupBy("node").agg(F.min("root").alias("near")))
        # A root takes over the least root that any of its nodes has met.
        met = roots.join(near, "node").select("node", "root", F.least("root", "near").alias("low"))
        lowered = met.groupBy("root").agg(F.min("low").alias("to"))
        hooked = met.join(lowered, "root").select("node", F.col("root").alias("old"), F.least("low", "to").alias("root"))
        jump = hooked.select(F.col("node").alias("root"), F.col("root").alias("top"))
        now = stored(hooked.join(jump, "root", "left").select(
            "node", "old", F.least("root", F.coalesce("top", "root")).alias("root")), "roots")
        if now.filter(F.col("old") != F.col("root")).isEmpty():
            return now.select("node", "root")
        roots = now.select("node", "root")


def jaccard_join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH,
                 threshold: float = THRESHOLD, recall: float = RECALL, node_sets: int = NODE_SETS,
                 depth: int = DEPTH, block: int = BLOCK) -> DataFrame:
    """A row for each row of ``docs``: doc_id, ``class_id``, ``n_links``, ``n_shingles``.

    Two rows are linked if the Jaccard similarity of their shingle sets is ``threshold`` or more. A
    class is what links connect, named by its least doc_id; ``n_links`` counts the other rows linked
    to a row, copies included. A row without a word (NULL, empty or white space) is linked to none and
    is a class of its own. Repeated rows are copies. Long texts are compared by all their shingles, columns of other
    names play no part, and an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    runs = runs_needed(threshold, recall, depth)
    signed = stored(embedded(docs, doc_id, text, width, runs, depth), "signatures")
    sets = stored(signed.filter("node is not null").groupBy("node").agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("least"), F.first("path").alias("path")), "sets")
    found = _fresh(leaves(sets, runs, depth, node_sets), runs)
    wanted = stored(found.join(sets.select("node", "copies", "least"), "node"), "candidates")
    met = stored(links(_with_sets(docs, doc_id, text, width, wanted), threshold, block), "links")

    roots = components(met.filter("other is not null"))
    counts = met.groupBy("node").agg(F.sum("n_links").alias("linked"))
    per_set = stored(sets.select("node", "copies", "least").join(roots, "node", "left").join(counts, "node", "left")
                     .withColumn("root", F.coalesce("root", "node")), "classes")
    named = per_set.groupBy("root").agg(F.min("least").alias("class_id"))
    result = per_set.join(named, "root").select(
        F.col("node").alias("set"), "class_id", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"))
    return signed.join(result, F.col("node") == F.col("set"), "left").select(
        "doc_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.col("size").alias("n_shingles"))


def _with_sets(docs: DataFrame, doc_id: str, text: str, width: int, wanted: DataFrame) -> DataFrame:
    """``wanted`` with ``set``, the whole shingle set of each node, computed again from a document that has it.

    Documents that are surely no candidate's are left out before the join by id.
    """
    filled = Bloom(wanted.select("least").distinct(), "least")
    texts = docs.select(F.col(doc_id).alias("d"), F.col(text).alias("text")).filter(filled.may_hold(F.col("d")))
    joined = texts.join(wanted, F.col("d").eqNullSafe(F.col("least"))).select(
        "node", "run", "leaf", "n", "met", "copies", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_text, last = None, (None, None)
        for batch in batches:
            rows, sets = [], []
            for i, (node, value) in enumerate(zip(batch.column("node").to_pylist(), batch.column("text").to_pylist())):
                if value != last_text:
                    found = shingles(value, width)
                    last_text, last = value, (xxhash.xxh3_128_digest(found.tobytes()), found.view(np.int64))
                # Rows may share an id and differ in text.
                if last[0] == node:
                    rows.append(i)
                    sets.append(last[1])
            take = pa.array(rows, pa.int64())
            names = ["node", "run", "leaf", "n", "met", "copies"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c).take(take) for c in names], pa.array(sets, pa.list_(pa.int64()))],
                                             names=[*names, "set"])

    return joined.mapInArrow(run, "node binary, run int, leaf long, n long, met array<bigint>, copies long, set array<bigint>")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each class, the one that names it; columns as given.

    Rows that are surely linked to none stay where they are; only the others are joined by id.
    """
    result = stored(jaccard_join(docs, doc_id, text, **options), "classes-of-documents")
    linked = Bloom(result.filter("n_links > 0").select("doc_id").distinct(), "doc_id")
    heads = result.filter(F.col("doc_id").eqNullSafe(F.col("class_id"))).select(F.col("doc_id").alias("head")).distinct()
    marked = docs.withColumn("__linked", linked.may_hold(F.col(doc_id)))
    alone = marked.filter(~F.col("__linked")).drop("__linked")
    kept = (marked.filter("__linked").drop("__linked").join(heads, F.col(doc_id).eqNullSafe(F.col("head")), "left_semi")
            .withColumn("__text", F.xxhash64(F.col(text))).dropDuplicates([doc_id, "__text"]).drop("__text"))
    return alone.select(docs.columns).unionByName(kept.select(docs.columns))
