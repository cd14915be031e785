"""Near duplicates by Jaccard similarity of word shingles, found by a chosen-path join.

1. Every text becomes its set of distinct 5-word shingles, and that set a vector of 64
   minhash values, whose agreement estimates the similarity. Equal sets are one node.
2. Chosen paths: in each run a node chooses some of its (coordinate, value) tokens by a
   hash that all nodes share, so that similar nodes choose alike, and is sent to a bucket
   per chosen token. A bucket with more than LIMIT nodes elects a leader, of the label that
   most of them have, and nodes near it are linked to it at once. If that leaves out up to
   LIMIT, these are compared with the whole bucket, and if more, the bucket is split again
   by further chosen tokens; the path of tokens so far is part of the hash. Runs are
   repeated until a pair at the threshold shares a bucket with the target recall.
3. Inside a bucket of at most LIMIT nodes a breadth-first search over the vectors finds
   what is connected; only the search's tree is kept, so a bucket of n nodes gives fewer
   than n links. Of what cannot be split down to LIMIT, too, the nodes not near a leader
   are compared with all, in blocks.
4. Nodes carry a label for what is known to be connected: a leader that they met in large
   buckets of the first runs, and in a split bucket its leader. A bucket of one label has
   nothing to find and is left out, and only links between labels are kept, so that a
   group of n near copies costs about n links, not n for every bucket that it is in.
5. The components of those links hold all candidates. Each is worked out exactly from the
   shingles themselves (in pairs of blocks where large): links of every node are counted,
   not listed, and the exact links' components are the classes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import stored
from leafmill.llm.components import components
from leafmill.llm.tokens import mixed, python_ready, run_hashes, text_batches, text_pieces, word_hashes

K = 5
THRESHOLD = 0.8
COORDINATES = 64
# Estimates below this are no candidates: four standard deviations under the threshold.
LOOSE = 0.6
RECALL = 0.9999
LIMIT = 1024
LEVELS = 3
# Runs whose large buckets label their leaders' neighbours before all runs begin.
LABEL_RUNS = 2
# Nodes, and bytes of shingles, per block of a component that is too large for one task.
BLOCK, BLOCK_BYTES = 2048, 1 << 25
FEATURES = 4096
_A = mixed(np.arange(1, COORDINATES + 1, dtype=np.uint64)) | np.uint64(1)
_B = mixed(np.arange(1, COORDINATES + 1, dtype=np.uint64) + np.uint64(1 << 20))
# Tokens that a pair at the threshold chooses in common, on average: at first, and below.
SHARED_FIRST, SHARED_BELOW = 1.0, 2.0


def runs_for(recall: float, levels: int = LEVELS) -> int:
    """Runs after which a pair at the threshold shares a searched bucket with that probability, even if all buckets are split to the last level."""
    meet = 1.0
    for level in reversed(range(levels)):
        meet = 1 - math.exp(-(SHARED_BELOW if level else SHARED_FIRST) * meet)
    return math.ceil(math.log(1 - recall) / math.log(1 - meet))


RUNS = runs_for(RECALL)


def shingles(texts: list[bytes], k: int = K) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's runs of k words; fewer words are one shingle, none the empty set."""
    out = []
    for lo, hi in text_pieces(texts):
        hashes, bounds = word_hashes(texts[lo:hi])
        runs, at = run_hashes(hashes, bounds, k)
        for i in range(hi - lo):
            if at[i + 1] > at[i]:
                out.append(np.unique(runs[at[i] : at[i + 1]]))
            else:
                own = hashes[bounds[i] : bounds[i + 1]]
                short = mixed(np.concatenate([own, [np.uint64(len(own))]]) + np.arange(len(own) + 1, dtype=np.uint64))
                out.append(np.array([short.sum()], np.uint64) if len(own) else own)
    return out


def set_hash(found: np.ndarray) -> int:
    """A signed 64-bit hash of a set of shingles."""
    return int(mixed(np.array([mixed(found).sum() + np.uint64(len(found))], np.uint64)).view(np.int64)[0])


def minhashes(found: np.ndarray) -> np.ndarray:
    """The least 32-bit value of the set under each coordinate's hash; all ones for the empty set."""
    low = np.full(COORDINATES, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(found), 4096):
        values = (found[None, start : start + 4096] * _A[:, None] + _B[:, None]) >> np.uint64(32)
        low = np.minimum(low, values.min(axis=1).astype(np.uint32))
    return low


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in text_batches(batches):
        found = shingles(texts)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("mark"),
                pa.array([set_hash(x) for x in found], pa.int64()),
                pa.array([minhashes(x).tobytes() for x in found], pa.binary()),
                pa.array([x.nbytes for x in found], pa.int64()),
            ],
            ["doc_id", "mark", "node", "vector", "bytes"],
        )


def _tokens(vectors: np.ndarray, paths: np.ndarray, shared: float) -> tuple[np.ndarray, np.ndarray]:
    """Row and new path of every token that rows choose at their paths."""
    place = mixed(np.arange(COORDINATES, dtype=np.uint64) + np.uint64(1 << 40))
    hashes = mixed(mixed(vectors.astype(np.uint64) ^ place[None, :]) + mixed(paths)[:, None])
    rows, columns = np.nonzero(hashes < np.uint64(shared / (THRESHOLD * COORDINATES) * 2**64))
    return rows, mixed(hashes[rows, columns] + place[columns])


def _vectors(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), COORDINATES)


def _first_paths(runs: range):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, nodes, labels = _vectors(batch.column("vector")), batch.column("node").to_numpy(), batch.column("label").to_numpy()
            for number in runs:
                rows, paths = _tokens(vectors, np.full(len(nodes), number, np.uint64), SHARED_FIRST)
                yield pa.RecordBatch.from_arrays([pa.array(paths.view(np.int64)), pa.array(nodes[rows]), pa.array(labels[rows])], ["path", "node", "label"])

    return run


def _next_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, paths = _tokens(_vectors(batch.column("vector")), batch.column("path").to_numpy().view(np.uint64), SHARED_BELOW)
        nodes, labels = batch.column("node").to_numpy(), batch.column("label").to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(paths.view(np.int64)), pa.array(nodes[rows]), pa.array(labels[rows])], ["path", "node", "label"])


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of a partition that is sorted by its keys."""
    held: list[pa.RecordBatch] = []

    def key(batch: pa.RecordBatch, row: int) -> tuple:
        return tuple(batch.column(k)[row].as_py() for k in keys)

    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for start, end in zip(edges[:-1], edges[1:], strict=True):
            now = key(batch, start)
            if held and now != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = now
    if held:
        yield pa.Table.from_batches(held)


def _tree(alike, labels: np.ndarray) -> Iterator[tuple[int, int]]:
    """(node, first of its tree) of a breadth-first forest; `alike(i, others)` says which others node i is linked to.

    Nodes of one label are connected from the start; of a label one node is reached.
    """

    def along(reached: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        same = np.isin(labels[left], labels[reached])
        return left[same], left[~same]

    left = np.arange(len(labels))
    while len(left):
        first = left[0]
        queue, left = along(left[:1], left)
        queue = queue.tolist()
        while queue and len(left):
            hit = left[alike(queue.pop(), left)]
            if len(hit):
                for j in hit[np.unique(labels[hit], return_index=True)[1]]:
                    yield j, first
                more, left = along(hit, left)
                queue.extend(more.tolist())


def _near(vectors: np.ndarray, other: np.ndarray) -> np.ndarray:
    return (vectors == other).sum(axis=1) >= math.ceil(LOOSE * COORDINATES)


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*found, strict=True) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _bucket_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that connect a bucket's labels. Where rows are `held` or not, only pairs with a held one are compared."""
    found = []
    for group in grouped(batches, ["path", "x", "y"]):
        nodes = group.column("node").to_numpy()
        order = np.argsort(nodes, kind="stable")
        vectors = _vectors(group.column("vector").combine_chunks())[order]
        held = group.column("held").to_numpy()[order]
        nodes, labels = nodes[order], group.column("label").to_numpy()[order]

        def alike(i: int, others: np.ndarray, v=vectors, h=held) -> np.ndarray:
            return _near(v[others], v[i]) & (h[others] | h[i])

        found += [(nodes[i], nodes[first]) for i, first in _tree(alike, labels)]
        if len(found) > 50_000:
            yield _pairs(found)
            found = []
    yield _pairs(found)


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row with whether its vector is near its bucket's leader's."""
    for batch in batches:
        near = _near(_vectors(batch.column("vector")), _vectors(batch.column("leader_vector"))) if batch.num_rows else np.zeros(0, bool)
        columns = [batch.column(c) for c in ("path", "size", "node", "vector", "label", "leader", "leader_label")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(near)], [f.split()[0] for f in _STARRED.split(", ")])


_STARRED = "path long, size long, node long, vector binary, label long, leader long, leader_label long, near boolean"


def _blocks(rows: DataFrame, group: str, blocks: Column, node: str) -> DataFrame:
    """Rows with their block `own` and `x`, `y`: of a group with n blocks each row goes to the n pairs that its block is in."""
    own = F.pmod(F.xxhash64(F.lit("block"), node), blocks).cast("int")
    pair = F.transform(F.sequence(F.lit(0), blocks - 1), lambda o: F.struct(F.least(own, o).alias("x"), F.greatest(own, o).alias("y")))
    return rows.select("*", own.alias("own"), F.inline(pair)).repartition(group, "x", "y").sortWithinPartitions(group, "x", "y")


def _left_out(starred: DataFrame, sizes: DataFrame) -> DataFrame:
    """The rows of buckets that are not split further: those not near the leader, in blocks `x`, with all others, in slices `y`."""
    rows = starred.join(sizes, "path")
    blocks, slices = (F.ceil(F.col(c) / n).cast("int") for c, n in (("far", LIMIT), ("size", 16 * LIMIT)))
    own = F.when(~F.col("near"), F.pmod(F.xxhash64(F.lit("block"), "node"), blocks).cast("int"))
    mine = F.pmod(F.xxhash64(F.lit("slice"), "node"), slices).cast("int")
    spread = rows.withColumns({"own": own, "mine": mine}).withColumn("x", F.explode(F.sequence(F.lit(0), blocks - 1)))
    spread = spread.filter(F.col("own").isNull() | (F.col("own") >= F.col("x"))).withColumn("held", F.coalesce(F.col("own") == F.col("x"), F.lit(False)))
    y = F.when(F.col("held"), F.sequence(F.lit(0), slices - 1)).otherwise(F.array("mine"))
    label = F.when(F.col("near"), F.col("leader_label")).otherwise(F.col("label"))
    found = spread.withColumn("y", F.explode(y)).select("path", "x", "y", "node", "vector", label.alias("label"), "held")
    return found.repartition("path", "x", "y").sortWithinPartitions("path", "x", "y")


def _shared(paths: DataFrame, vectors: DataFrame, least: int) -> DataFrame:
    """The rows of buckets of `least` nodes or more and of several labels, with their size and vector; stored."""
    here = stored(paths, "jaccard-paths")
    sizes = here.groupBy("path").agg(F.count(F.lit(1)).alias("size"), F.min("label").alias("low"), F.max("label").alias("high"))
    # Stored, so that a bucket with many of the rows gets an exchange that can be split.
    wanted = stored(sizes.filter((F.col("low") < F.col("high")) & (F.col("size") >= least)).select("path", "size"), "jaccard-sizes")
    return stored(here.join(wanted, "path").join(vectors, "node"), "jaccard-buckets")


def _led(large: DataFrame) -> DataFrame:
    """The rows with their bucket's leader, its label and vector; stored. The leader has the label that most of the bucket's rows have, and gave it if it is there."""
    first = F.min_by("node", F.struct(F.col("node") != F.col("label"), F.xxhash64("path", "node"), "node")).alias("leader")
    labels = large.groupBy("path", "label").agg(F.count(F.lit(1)).alias("rows"), first)
    chosen = labels.groupBy("path").agg(F.max_by(F.struct("leader", F.col("label").alias("leader_label")), F.struct("rows", F.xxhash64("path", "label"))).alias("most"))
    chosen = stored(chosen.select("path", "most.*"), "jaccard-chosen")
    # A row for every large bucket.
    vectors = large.join(chosen, "path").filter("node = leader").select("path", "leader", "leader_label", F.col("vector").alias("leader_vector"))
    return stored(large.join(stored(vectors.dropDuplicates(["path"]), "jaccard-leaders"), "path"), "jaccard-led")


def _starred(large: DataFrame) -> DataFrame:
    """The rows with whether they are near their bucket's leader; stored. Rows of its label are, and are not compared."""
    led = _led(large)
    other = F.col("label") != F.col("leader_label")
    known = led.filter(~other).drop("leader_vector").withColumn("near", F.lit(True))
    return stored(known.unionByName(led.filter(other).mapInArrow(_stars, _STARRED)), "jaccard-stars")


def _labelled(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes with a label, stored: nodes of one label are connected by the links beside them."""
    own = nodes.withColumn("label", F.col("node"))
    large = _shared(own.mapInArrow(_first_paths(range(LABEL_RUNS)), "path long, node long, label long"), nodes, LIMIT + 1)
    links = _starred(large).filter("near AND node <> leader").groupBy(F.col("node").alias("a")).agg(F.min("leader").alias("b"), F.max("leader").alias("c"))
    # Where a node met several leaders, all but the least are linked by the other edge.
    links = stored(links, "jaccard-labels")
    up = links.select(F.col("a").alias("at"), F.least("b", "a").alias("up"))
    label = links.select(F.col("a").alias("node"), F.col("b").alias("label"))
    for step in range(2):
        label = label.join(up, F.col("label") == F.col("at"), "left").select("node", F.coalesce("up", "label").alias("label"))
    found = stored(nodes.join(label.withColumnRenamed("node", "known"), F.col("node") == F.col("known"), "left").select("node", "vector", F.coalesce("label", "node").alias("label")), "jaccard-labelled")
    return found, links.select("a", "b").union(links.select("a", "c"))


def candidates(nodes: DataFrame) -> DataFrame:
    """Links `a`, `b` that connect all candidates; `nodes` has `node` and `vector`."""
    nodes, known = _labelled(nodes)
    paths = nodes.mapInArrow(_first_paths(range(RUNS)), "path long, node long, label long")
    links = [known]
    for level in range(LEVELS):
        shared = _shared(paths, nodes.select("node", "vector"), 2)
        small = shared.filter(F.col("size") <= LIMIT).select("path", F.lit(0).alias("x"), F.lit(0).alias("y"), "node", "vector", "label", F.lit(True).alias("held"))
        links.append(small.repartition("path").sortWithinPartitions("path").mapInArrow(_bucket_links, "a long, b long"))
        large = shared.filter(F.col("size") > LIMIT)
        if large.isEmpty():
            break
        starred = _starred(large)
        links.append(starred.filter("near AND label <> leader_label").select(F.col("node").alias("a"), F.col("leader").alias("b")))
        far = stored(starred.groupBy("path").agg(F.count_if(~F.col("near")).alias("far")).filter("far > 0"), "jaccard-far")
        # Where one block holds what is not near the leader, each of it meets all rows; splitting would send the many near ones on again and again.
        whole = F.col("far") <= LIMIT if level < LEVELS - 1 else F.lit(True)
        links.append(_left_out(starred, far.filter(whole)).mapInArrow(_bucket_links, "a long, b long"))
        split = far.filter(~whole)
        if split.isEmpty():
            break
        label = F.when(F.col("near"), F.col("leader_label")).otherwise(F.col("label"))
        split = starred.join(split, "path", "left_semi").select("path", "node", "vector", label.alias("label"))
        paths = split.mapInArrow(_next_paths, "path long, node long, label long")
    return reduce(DataFrame.union, links)


def _exact_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in text_batches(batches):
        found = shingles(texts)
        own = np.array([set_hash(x) for x in found], np.int64) == batch.column("node").to_numpy()
        whole = pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("component", "blocks", "node", "copies")), pa.array([x.tobytes() for x in found], pa.binary())],
            ["component", "blocks", "node", "copies", "shingles"],
        )
        yield whole.filter(pa.array(own))


def _linked(sets: list[np.ndarray], rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Which of the `rows` sets have a Jaccard similarity of THRESHOLD or more with which of the `cols` sets."""
    sizes = np.array([len(s) for s in sets], np.int64)
    whole = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, ids, seen = np.unique(whole, return_inverse=True, return_counts=True)
    often = seen > 1
    keep = often[ids]
    compact = np.cumsum(often) - 1
    feature, owner = compact[ids[keep]], owner[keep]
    order = np.argsort(feature, kind="stable")
    feature, owner = feature[order], owner[order]
    common = np.zeros((len(rows), len(cols)), np.float32)
    n = int(often.sum())
    for start in range(0, n, FEATURES):
        lo, hi = np.searchsorted(feature, [start, start + FEATURES])
        bits = np.zeros((len(sets), min(FEATURES, n - start)), np.float32)
        bits[owner[lo:hi], feature[lo:hi] - start] = 1
        common += bits[rows] @ bits[cols].T
    total = sizes[rows][:, None] + sizes[cols][None, :] - common
    return (common >= THRESHOLD * total - 1e-6) & (total > 0)


def _component_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every node of a pair of blocks: copies of the sets linked to it there, and the first node of its tree."""
    for group in grouped(batches, ["component", "x", "y"]):
        nodes, copies, x, y, own = (group.column(c).to_numpy() for c in ("node", "copies", "x", "y", "own"))
        # Repeated rows bring a node twice.
        once = np.unique(nodes, return_index=True)[1]
        order = once[np.lexsort((nodes[once], own[once]))]
        nodes, copies, own = nodes[order], copies[order], own[order]
        blobs = group.column("shingles").combine_chunks()
        sets = [np.frombuffer(blobs[int(i)].as_py(), np.uint64) for i in order]
        rows = np.flatnonzero(own == x[0])
        cols = np.flatnonzero(own == y[0])
        near = _linked(sets, rows, cols)
        links, origin = np.zeros(len(nodes), np.int64), nodes.copy()
        if x[0] == y[0]:
            near[np.arange(len(rows)), np.arange(len(rows))] = False
            links = near @ copies
            for i, first in _tree(lambda i, others: near[i][others], np.arange(len(nodes))):
                origin[i] = nodes[first]
        else:
            links[rows] = near @ copies[cols]
            links[cols] = near.T @ copies[rows]
            # The rows come first, the columns after them.
            border = len(rows)

            def alike(i: int, others: np.ndarray) -> np.ndarray:
                hit = np.zeros(len(others), bool)
                across = others >= border if i < border else others < border
                hit[across] = near[i][others[across] - border] if i < border else near[others[across], i - border]
                return hit

            for i, first in _tree(alike, np.arange(len(nodes))):
                origin[i] = nodes[first]
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(links.astype(np.int64)), pa.array(origin)], ["node", "links", "origin"])


def _mark() -> Column:
    return F.xxhash64("text")


def _first_of_repeated(rows: DataFrame, repeated: Column, *key: str) -> DataFrame:
    """One row of each key where `repeated` says that there are more: cut down in every task, so that a row repeated ever so often meets no one as a whole."""
    first = rows.filter(repeated).groupBy(*key).agg(F.first(F.struct(*(F.col(f"`{c}`") for c in rows.columns))).alias("first"))
    return rows.filter(~repeated).unionAll(first.select("first.*"))


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every document's `node`; and every node's `n_links`, first document (`rep`) and its class's (`least`, of `least_node`)."""
    python_ready(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    marked = docs.select("doc_id", "text", _mark().alias("mark"))
    sets = stored(marked.mapInArrow(_sets, f"doc_id {kind}, mark long, node long, vector binary, bytes long"), "jaccard-sets")
    alike = sets.groupBy("node", "doc_id", "mark").agg(F.count(F.lit(1)).alias("rows"), F.min("vector").alias("vector"), F.max("bytes").alias("bytes"))
    first = F.min(F.struct(F.isnull("doc_id").alias("nameless"), "doc_id", "mark", "rows")).alias("rep")
    nodes = stored(alike.groupBy("node").agg(first, F.sum("rows").alias("copies"), F.min("vector").alias("vector"), F.max("bytes").alias("bytes")), "jaccard-nodes")
    member = components(candidates(nodes.select("node", "vector")), "jaccard-candidates")
    # Stored, since the sizes and the texts both follow.
    member = stored(
        member.select(F.col("a").alias("node"), F.col("b").alias("component")).union(member.select("b", "b").distinct()).join(nodes.drop("vector"), "node"), "jaccard-members"
    )
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("bytes") / BLOCK_BYTES)).cast("int")
    wanted = stored(member.join(stored(member.groupBy("component").agg(blocks.alias("blocks")), "jaccard-blocks"), "component"), "jaccard-wanted")
    # Merged at every size: a broadcast that ends somewhere would only make small runs look unlike large ones.
    here = F.col("doc_id").eqNullSafe(F.col("rep.doc_id")) & F.col("here").eqNullSafe(F.col("rep.mark"))
    texts = docs.select("doc_id", "text", _mark().alias("here")).join(wanted.hint("merge"), here).select("component", "blocks", "node", "copies", "text", F.col("rep.rows").alias("rows"))
    texts = _first_of_repeated(texts, F.col("rows") > 1, "node")
    exact = texts.select("component", "blocks", "node", "copies", "text").mapInArrow(
        _exact_sets, "component long, blocks int, node long, copies long, shingles binary"
    )
    checked = _blocks(exact, "component", F.col("blocks"), "node")
    found = stored(
        checked.select("component", "x", "y", "own", "node", "copies", "shingles").mapInArrow(_component_links, "node long, links long, origin long"),
        "jaccard-links",
    )
    classes = components(found.select(F.col("node").alias("a"), F.col("origin").alias("b")), "jaccard-classes")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    labelled = nodes.drop("vector").join(links, "node", "left").join(classes.withColumnsRenamed({"a": "node", "b": "root"}), "node", "left")
    labelled = labelled.select("node", "rep", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("root"))
    # Two nodes may have one row's id and mark in common only if hashes collide; the node then decides.
    least = labelled.groupBy("root").agg(F.min(F.struct("rep", "node")).alias("first")).select("root", F.col("first.rep").alias("least"), F.col("first.node").alias("least_node"))
    named = labelled.join(least, "root").select("node", "rep", "least", "least_node", (F.col("links") + F.col("copies") - 1).alias("n_links"))
    return sets, named


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, class_id and n_links.

    Documents are linked from a Jaccard similarity of 0.8 of their shingle sets on.
    `class_id` is the least doc_id of all that are connected by links; `n_links` counts
    the other documents linked to this one, copies included. Shorter texts than a shingle
    are one shingle; texts without words (null, empty) are copies of each other; repeated
    rows are documents of their own under one id, and copies if their texts are; a null id
    is the least of a class only if all ids of it are null; other columns are left aside;
    no rows give no rows.
    """
    sets, named = _classes(docs)
    return sets.select("doc_id", "node").join(named, "node").select("doc_id", F.col("least.doc_id").alias("class_id"), "n_links")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each class, with all its columns: the one with the least doc_id, of equal ids one text, of rows equal in id and text any one.

    Texts without words (null, empty) are one class. An id that comes with several texts
    stays with each of them that is first in its class. Null ids come last; further
    columns pass through whatever their names; no rows give no rows.
    """
    _, named = _classes(docs)
    kept = stored(named.filter("node = least_node").select(F.col("rep.doc_id").alias("id"), F.col("rep.mark").alias("mark"), F.col("rep.rows").alias("rows")), "jaccard-kept")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("doc_id").alias("own"), _mark().alias("here"))
    met = rows.join(kept.hint("merge"), F.col("own").eqNullSafe(F.col("id")) & F.col("here").eqNullSafe(F.col("mark")))
    return _first_of_repeated(met, F.col("rows") > 1, "own", "here").select("row.*")
