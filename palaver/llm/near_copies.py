"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its distinct five-word shingles (A-Z in lower case). Equal sets are one node
from the start. Each node has ``COORDINATES`` minwise tokens. A tree branches the nodes: the path so
far selects a coordinate, and the node goes to the branch of its token there. Similar sets agree in
a token with odds equal to their similarity, so they tend to stay together while others part. A
branch of at most ``LEAF`` nodes is a leaf, whose members are compared exhaustively by their tokens;
larger ones branch again, level by level, and no path asks for a token twice. A large branch ends in three
cases only: all its members are in one cluster of candidates already, so that no pair in it can be
lost; or all but ``VISITORS`` are (or so few that they make at most ``VISITED`` pairs with the members), and these then meet every member in its leaves; or all tokens have been asked and are equal. The members of a large branch are also dealt at
random to leaves, anew on each level of each tree: near copies by the thousand, which tokens part
slowly, find each other there. ``TREES`` independent trees are united: a pair of similarity s
stays together with odds of s per branching, and meets in a leaf as soon as a token of its own parts it
from the rest. In a group whose members share g of their sets, a tree finds it with odds of at least
(s - g) / (1 - g): with g = 0.5 twelve trees miss a pair of 0.85 with odds of 5e-7 and one of 0.80 with 2e-5.

The similarity asked for is an argument in percent. Nodes whose tokens agree enough, five standard
deviations below it, form candidate clusters. Links are then confirmed on the full sets of 62-bit shingle hashes,
by counting, inside each cluster. A cluster whose sets are too many for one task is dealt to
chunks. Each settles its own links; then, in rounds, one member of each of the ``PIVOTS`` largest
components so far is compared with all chunks, as long as a round leaves a quarter fewer members outside
their cluster's largest component. Those still outside are dealt to chunks of their own, and each
meets every chunk of the cluster. So no task holds more than two chunks, and no link is lost.

Edge cases: fewer than five words make one shingle, null and empty texts an empty set, linked with
nothing (component and document are the same). A null document number is allowed; a component's
number is its smallest one that is not null, and ``kept`` compares null-safe. Equal rows all carry
the same component. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from palaver.llm.components import FEW_ROWS, components, united
from palaver.llm.words import Slice, WordHasher, mixed, run_lengths, slices
from palaver.session import written

SHINGLE = 5
#: Similarity in percent: that of stages without a contract of their own, and that of op5.
PERCENT, OP5_PERCENT = 80, 85
COORDINATES, TREES, LEAF, VISITORS = 96, 12, 4096, 512
VISITED = 4_000_000
#: Leaves up to here are compared side by side, larger ones member by member.
SIDE_BY_SIDE = 64
CHUNK_SHINGLES, PIVOTS = 1 << 20, 8
SEEDS = mixed(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64))
FACTORS, OFFSETS = (SEEDS[:COORDINATES].astype(np.uint32) | np.uint32(1)), SEEDS[COORDINATES:].astype(np.uint32)


def agreement(percent: int) -> float:
    """Least number of equal tokens of a candidate pair, five standard deviations below the similarity asked for."""
    return COORDINATES * percent / 100 - 5 * (COORDINATES * percent / 100 * (1 - percent / 100)) ** 0.5


def shingle_sets(part: Slice, hasher: WordHasher) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, starts)``: the distinct shingle hashes of all texts, sorted within each."""
    at, size = part.windows(SHINGLE), SHINGLE
    short = np.flatnonzero((part.n_words > 0) & (part.n_words < SHINGLE))
    at = np.concatenate((at, part.first_word[short]))
    size = np.concatenate((np.full(len(at) - len(short), SHINGLE), part.n_words[short]))
    hashes = hasher.windows(hasher.words(part), at, size) if len(at) else np.zeros(0, np.uint64)
    text = part.text[at]
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    counts = np.bincount(text[new], minlength=part.n)
    return hashes[new], np.concatenate(([0], np.cumsum(counts)))


def minwise(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The minwise tokens of non-empty sets, one row each."""
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(starts), COORDINATES), np.uint32)
    for i, (factor, offset) in enumerate(zip(FACTORS, OFFSETS)):
        out[:, i] = np.minimum.reduceat(short * factor + offset, starts)
    return out


SKETCH = pa.schema([("doc_id", pa.int64()), ("text_md5", pa.binary()), ("n_shingles", pa.int64()), ("digest", pa.binary()),
                    ("tokens", pa.binary()), ("low_tokens", pa.binary())])


def sketch(incoming):
    hasher = WordHasher()
    for batch in incoming:
        for part in slices(batch.column(1), lower=True):
            hashes, at = shingle_sets(part, hasher)
            n = np.diff(at)
            full = np.flatnonzero(n)
            digest, tokens, low = ([None] * part.n for _ in range(3))
            if len(full):
                values = minwise(hashes, at[full])
                lows = values.astype(np.uint16)
                for i, row in enumerate(full.tolist()):
                    digest[row] = hashlib.md5(hashes[at[row]:at[row + 1]].tobytes()).digest()
                    tokens[row], low[row] = values[i].tobytes(), lows[i].tobytes()
            own = slice(part.first, part.first + part.n)
            yield pa.RecordBatch.from_arrays([
                batch.column(0)[own], batch.column(2)[own], pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                pa.array(tokens, pa.binary()), pa.array(low, pa.binary())], schema=SKETCH)


def paths(tokens: np.ndarray, tree: np.ndarray, depth: int) -> np.ndarray:
    """Keys of the branches at a depth, for rows with their tree. The path so far chooses the next token, each one once."""
    key, rows = mixed(tree.astype(np.uint64) + np.uint64(1000)), np.arange(len(tokens))
    asked = np.zeros((len(tokens), COORDINATES), bool)
    for d in range(depth):
        # the first choice depends on the tree alone and differs between trees
        at = (tree * 7 + 3) % COORDINATES if d == 0 else (mixed(key) % np.uint64(COORDINATES)).astype(np.int64)
        while (again := asked[rows, at]).any():
            at = np.where(again, (at + 1) % COORDINATES, at)
        asked[rows, at] = True
        key = mixed(key * np.uint64(31) + (at.astype(np.uint64) << np.uint64(32)) + tokens[rows, at])
    return key.view(np.int64)


def branches(depth: int, trees: int):
    """Mapper: ``(id, tree, branch)`` at one depth, from ``(id, tokens)`` in all of so many trees or, with 0, ``(id, tokens, own trees)``."""

    def run(incoming):
        for batch in incoming:
            ids = batch.column(0).to_numpy()
            tokens = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(-1, COORDINATES)
            own = None if trees else batch.column(2).to_pylist()
            for tree in range(trees) if trees else sorted(set().union(*own)):
                at = slice(None) if trees else np.array([tree in o for o in own])
                chosen = np.full(len(ids[at]), tree)
                yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(chosen, pa.int64()), pa.array(paths(tokens[at], chosen, depth))],
                                                 names=["id", "tree", "branch"])

    return run


def compare_leaves(least: float):
    """Mapper over rows ``(leaf, id, low_tokens)`` sorted by leaf: links ``(a, b)`` of each member to its leaf's smallest."""

    def run(incoming):
        held = None
        for batch in incoming:
            own = (batch.column(0).to_numpy(), batch.column(1).to_numpy(),
                   np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint16).reshape(-1, COORDINATES))
            leaf, ids, tokens = own if held is None else (np.concatenate(x) for x in zip(held, own))
            last = int(np.searchsorted(leaf, leaf[-1])) if len(leaf) else 0  # the last leaf may go on in the next batch
            yield from linked_rows(leaf[:last], ids[:last], tokens[:last], least)
            held = leaf[last:], ids[last:], tokens[last:]
        if held is not None:
            yield from linked_rows(*held, least)

    return run


def merged_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after the links ``(a, b)``: the smallest of each component."""
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (before == label).all():
            break
    return label


def leaf_labels(tokens: np.ndarray, least: float) -> np.ndarray:
    """Cluster of each member of one leaf, by its smallest member. Members outside the largest cluster are compared with all
    others, so no link that joins two clusters is missed."""
    columns, n = np.ascontiguousarray(tokens.T), len(tokens)
    label, size, open_ = np.arange(n), np.ones(n, np.int64), np.ones(n, bool)
    while True:
        todo = np.flatnonzero(open_ & (label != size.argmax()))
        if not len(todo):
            return label
        for i in todo.tolist():
            if label[i] == size.argmax():
                continue
            open_[i] = False
            agree = np.add.reduce((columns == columns[:, i, None]).view(np.uint8), axis=0, dtype=np.uint8) >= least
            agree[i] = True
            joined = np.unique(label[agree])
            if len(joined) > 1:
                size[joined[0]] = size[joined].sum()
                size[joined[1:]] = 0
                label[np.isin(label, joined)] = joined[0]


def linked_rows(leaf: np.ndarray, ids: np.ndarray, tokens: np.ndarray, least: float):
    label = np.arange(len(ids))
    starts, sizes = run_lengths(leaf)
    small = np.flatnonzero(np.repeat(sizes <= SIDE_BY_SIDE, sizes))
    own_leaf, own_tokens = leaf[small], tokens[small]
    left, right = [small[:0]], [small[:0]]
    for step in range(1, min(SIDE_BY_SIDE, len(small))):
        i = np.flatnonzero(own_leaf[step:] == own_leaf[:-step])
        if not len(i):
            break
        for part in np.array_split(i, len(i) // 50_000 + 1):
            agree = (own_tokens[part] == own_tokens[part + step]).sum(axis=1) >= least
            left.append(part[agree])
            right.append(part[agree] + step)
    label = merged_labels(label, small[np.concatenate(left)], small[np.concatenate(right)])
    for start, size in zip(starts.tolist(), sizes.tolist()):
        if size > SIDE_BY_SIDE:
            label[start:start + size] = start + leaf_labels(tokens[start:start + size], least)
    linked = np.flatnonzero(label != np.arange(len(ids)))
    if len(linked):
        yield pa.RecordBatch.from_arrays([pa.array(ids[linked]), pa.array(ids[label[linked]])], names=["a", "b"])


def visits_of(rooted: DataFrame, sizes: DataFrame) -> DataFrame:
    """``(id, leaf)`` for branches that are one cluster but for a few: those few visit leaves that hold all members."""
    members = rooted.join(sizes, "branch").withColumn("_leaves", F.ceil(F.col("n") / (LEAF * 3 // 4)).cast("long")).withColumn(
        "_groups", F.ceil((F.col("n") - F.col("top.c")) / VISITORS).cast("long"))

    def every(column: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(column) - 1))

    def one_of(column: str, seed: int):
        return F.pmod(F.xxhash64("id", "branch", F.lit(seed)), F.col(column))

    hosts = members.select("id", "branch", one_of("_leaves", 1).alias("_at"), every("_groups").alias("_group"))
    guests = members.filter("root <> top.root").select("id", "branch", one_of("_groups", 2).alias("_group"), every("_leaves").alias("_at"))
    rows = hosts.unionByName(guests)
    return written(rows.select("id", F.xxhash64("branch", "_at", "_group").alias("leaf")).distinct(), "visits")


def candidate_clusters(nodes: DataFrame, percent: int) -> DataFrame:
    """``(id, root)``: clusters of nodes whose tokens agree in a leaf of some tree.

    A large branch of one cluster is done. One that is a single cluster but for a few members is settled on
    the next level, where these meet all others. Only the remaining large branches branch on.
    """
    lows = nodes.select("id", "low_tokens")
    held, clusters, waiting = nodes.select("id", "tokens"), None, None
    for depth in range(1, COORDINATES + 1):
        rows = held.mapInArrow(branches(depth, TREES if depth == 1 else 0), "id long, tree long, branch long")
        shared = rows.groupBy("branch").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        sized = written(rows.join(shared, "branch"), "branches")
        large = sized.filter(f"n > {LEAF}")
        # members of a large branch also meet at random, in leaves of about three quarters of the largest size
        part = F.when(F.col("n") > LEAF, F.pmod(F.xxhash64("id", "tree", F.lit(depth)), F.ceil(F.col("n") / (LEAF * 3 // 4)))).otherwise(-1)
        leaves = sized.select("id", F.xxhash64("branch", part).alias("leaf"))
        if waiting is not None:
            leaves = leaves.unionByName(waiting)
        leaves = written(leaves, "leaves")
        if leaves.count() <= FEW_ROWS:  # two numbers a row: below 16 MB, so the tokens of all nodes need not move
            leaves = F.broadcast(leaves)
        ordered = leaves.join(lows, "id").select("leaf", "id", "low_tokens").repartition("leaf").sortWithinPartitions("leaf")
        found = ordered.mapInArrow(compare_leaves(agreement(percent)), "a long, b long")
        if depth == COORDINATES:  # what is still large has equal tokens
            least = large.groupBy("branch").agg(F.min("id").alias("b"))
            found = found.unionByName(large.join(least, "branch").select(F.col("id").alias("a"), "b"))
        clusters = united(clusters, found)
        if depth == COORDINATES or large.isEmpty():
            break
        rooted = written(large.drop("n").join(clusters, "id", "left").withColumn("root", F.coalesce("root", "id")), "rooted")
        own = rooted.groupBy("branch", "root").agg(F.count(F.lit(1)).alias("c"))
        sizes = own.groupBy("branch").agg(F.sum("c").alias("n"), F.max(F.struct("c", "root")).alias("top")).filter("n > top.c")
        sizes = written(sizes, "sizes")
        others = F.col("n") - F.col("top.c")
        few = (others <= VISITORS) | (others * F.col("n") <= VISITED)
        waiting = visits_of(rooted, sizes.filter(few))
        trees = rooted.join(sizes.filter(~few), "branch", "left_semi").groupBy("id").agg(F.collect_list("tree").alias("trees"))
        trees = written(trees, "trees")
        held = nodes.select("id", "tokens").join(F.broadcast(trees) if trees.count() <= FEW_ROWS else trees, "id")
        if trees.isEmpty() and waiting.isEmpty():
            break
    return clusters


def full_sets(incoming):
    hasher = WordHasher()
    for batch in incoming:
        for part in slices(batch.column(1), lower=True):
            hashes, at = shingle_sets(part, hasher)
            sets = [hashes[s:e].tobytes() for s, e in zip(at[:-1], at[1:])]
            own = slice(part.first, part.first + part.n)
            yield pa.RecordBatch.from_arrays([batch.column(0)[own], pa.array(sets, pa.binary())], names=["id", "shingles"])


class Sets:
    """Full sets side by side, one compared with all at a time."""

    def __init__(self, sets: list[bytes], percent: int):
        self.percent = percent
        sizes = np.array([len(s) // 8 for s in sets])
        _, self.tokens = np.unique(np.frombuffer(b"".join(sets), np.uint64), return_inverse=True)
        self.n, self.ends = sizes, np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.marks = np.zeros(int(self.tokens.max()) + 1, np.int64)

    def links(self, i: int) -> np.ndarray:
        """Whether each set is linked with set i, counted exactly."""
        own = self.tokens[self.starts[i]:self.ends[i]]
        self.marks[own] = 1
        common = np.add.reduceat(self.marks[self.tokens], self.starts)
        self.marks[own] = 0
        return 100 * common >= self.percent * (self.n + self.n[i] - common)


def exact_labels(sets: list[bytes], percent: int = OP5_PERCENT) -> np.ndarray:
    """Component of each set. Sets outside the largest component are compared with all others, so no
    link that joins two components is missed; links inside one need no proof."""
    compared, label, open_ = Sets(sets, percent), np.arange(len(sets)), np.ones(len(sets), bool)
    while True:
        values, counts = np.unique(label, return_counts=True)
        todo = np.flatnonzero(open_ & (label != values[counts.argmax()])) if len(values) > 1 else []
        if not len(todo):
            return label
        i = int(todo[0])
        open_[i] = False
        joined = np.unique(label[compared.links(i)])
        label[np.isin(label, joined)] = joined[0]


def confirm(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """A bundle of clusters, or one chunk of a large one: ``(cluster, id, root)``."""
    out = []
    for cluster, own in rows.groupby("cluster"):
        own = own.drop_duplicates("id").sort_values("id")
        ids, label = own["id"].to_numpy(), exact_labels(own["shingles"].tolist(), percent)
        out.append(pd.DataFrame({"cluster": cluster, "id": ids, "root": ids[label]}))
    return pd.concat(out)


def visit(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """One chunk and its visitors: links ``(a, b)`` between the roots that the visitors join."""
    rows = rows.sort_values("visitor", ascending=False).drop_duplicates("id")
    compared = Sets(rows["shingles"].tolist(), percent)
    roots, own = np.unique(rows["root"].to_numpy(), return_inverse=True)
    label = own.copy()
    for i in np.flatnonzero(rows["visitor"].to_numpy(bool)):
        if (label == label[0]).all():
            break
        joined = np.unique(label[compared.links(i)])
        label[np.isin(label, joined)] = joined[0]
    return pd.DataFrame({"a": roots[own], "b": roots[label]}).query("a != b").drop_duplicates()


def visits(hosts: DataFrame, visitors: DataFrame, rooted: DataFrame, percent: int) -> DataFrame:
    """``rooted`` after the visitors have met the hosts of their bundles."""
    columns = ["bundle", "id", "root", "shingles", "visitor"]
    rows = hosts.withColumn("visitor", F.lit(False)).select(columns).unionByName(visitors.withColumn("visitor", F.lit(True)).select(columns))
    joined = components(rows.groupBy("bundle").applyInPandas(lambda own: visit(own, percent), "a long, b long"))
    renamed = joined.select(F.col("id").alias("root"), F.col("root").alias("_to"))
    return written(rooted.join(renamed, "root", "left").select("cluster", "id", F.coalesce("_to", "root").alias("root")), "rooted")


def joined_chunks(large: DataFrame, rooted: DataFrame, percent: int) -> DataFrame:
    """``(cluster, id, root)`` over all chunks, from ``(cluster, id, n_shingles, shingles, chunk, chunks)`` and the roots within each chunk."""
    every_chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))
    before = None
    while True:
        sizes = written(rooted.groupBy("cluster", "root").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("one")), "sizes")
        largest = sizes.groupBy("cluster").agg(F.max(F.struct("n", "root")).alias("top"))
        outside = (sizes.agg(F.sum("n")).first()[0] or 0) - (largest.agg(F.sum("top.n")).first()[0] or 0)
        if not outside:
            return rooted
        if before is not None and 4 * outside > 3 * before:
            break
        before = outside
        place = F.row_number().over(Window.partitionBy("cluster").orderBy(F.col("n").desc(), "root"))
        pivots = sizes.withColumn("_at", place).filter(F.col("_at") <= PIVOTS).select(F.col("one").alias("id"), "root")
        hosts = large.join(rooted.select("id", "root"), "id").withColumn("bundle", F.xxhash64("cluster", "chunk"))
        visitors = large.join(pivots, "id").withColumn("_host", every_chunk).withColumn("bundle", F.xxhash64("cluster", "_host"))
        rooted = visits(hosts, visitors, rooted, percent)
    left = large.join(rooted.select("id", "root"), "id").join(largest, "cluster").filter("root <> top.root")
    rooms = written(left.groupBy("cluster").agg(F.ceil(F.sum("n_shingles") / CHUNK_SHINGLES).alias("rooms")), "rooms")
    hosts = large.join(rooted.select("id", "root"), "id").join(rooms, "cluster").withColumn(
        "_room", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rooms") - 1)))
    visitors = left.join(rooms, "cluster").withColumn("_room", F.pmod(F.xxhash64("id", F.lit(2)), F.col("rooms"))).withColumn("_host", every_chunk)
    return visits(hosts.withColumn("bundle", F.xxhash64("cluster", "chunk", "_room")),
                  visitors.withColumn("bundle", F.xxhash64("cluster", "_host", "_room")), rooted, percent)


def confirmed(sets: DataFrame, percent: int) -> DataFrame:
    """``(id, root)`` of the true components from ``(id, cluster, n_shingles, shingles)``."""
    total = sets.agg(F.sum("n_shingles")).first()[0] or 0
    bundles = max(1, -(-int(total) // CHUNK_SHINGLES))
    plan = written(sets.groupBy("cluster").agg(F.ceil(F.sum("n_shingles") / CHUNK_SHINGLES).alias("chunks")), "clusters")
    placed = sets.join(plan, "cluster").withColumn("chunk", F.pmod(F.xxhash64("id", F.lit(1)), F.col("chunks")))
    bundle = F.when(F.col("chunks") == 1, F.pmod(F.xxhash64("cluster"), F.lit(bundles))).otherwise(F.xxhash64("cluster", "chunk"))
    labels = written(placed.select(bundle.alias("bundle"), "cluster", "id", "shingles").groupBy("bundle").applyInPandas(
        lambda rows: confirm(rows, percent), "cluster long, id long, root long"), "labels")
    several = plan.filter("chunks > 1").select("cluster")
    if several.isEmpty():
        return labels.select("id", "root")
    large = written(placed.filter("chunks > 1"), "large")
    spread = joined_chunks(large, labels.join(several, "cluster", "left_semi"), percent)
    return labels.join(several, "cluster", "left_anti").select("id", "root").unionByName(spread.select("id", "root"))


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = OP5_PERCENT) -> DataFrame:
    """``(doc_id, text_md5, n_shingles, group_id, component_id, kept)``, one row per input row.

    Sets of a similarity of ``percent`` or more are linked. ``group_id`` numbers the components of this run; it is null for an empty set.
    """
    narrow = df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"),
                       F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("text_md5"))
    rows = written(narrow.mapInArrow(
        sketch, "doc_id long, text_md5 binary, n_shingles long, digest binary, tokens binary, low_tokens binary"), "sketches")
    nodes = rows.filter("digest IS NOT NULL").groupBy("digest").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_md5")).alias("_one"), F.first("n_shingles").alias("n_shingles"),
        F.first("tokens").alias("tokens"), F.first("low_tokens").alias("low_tokens"))
    nodes = written(nodes.select(F.monotonically_increasing_id().alias("id"), "digest", "_one.doc_id", "_one.text_md5",
                                 "n_shingles", "tokens", "low_tokens"), "nodes")
    clusters = candidate_clusters(nodes, percent)
    wanted = written(clusters.join(nodes.select("id", "doc_id", "text_md5", "n_shingles"), "id"), "wanted")
    same = narrow["text_md5"].eqNullSafe(wanted["text_md5"]) & narrow["doc_id"].eqNullSafe(wanted["doc_id"])
    # merged at every size: whether the few candidates would fit a broadcast depends on the input
    texts = narrow.join(wanted.hint("merge"), same).select(wanted["id"], "text")
    sets = written(texts.mapInArrow(full_sets, "id long, shingles binary").dropDuplicates(["id"]).join(
        wanted.select("id", F.col("root").alias("cluster"), "n_shingles"), "id"), "sets")
    roots = nodes.select("id", "digest", "doc_id").join(confirmed(sets, percent), "id", "left").withColumn(
        "root", F.coalesce("root", "id"))
    numbers = roots.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = roots.join(numbers, "root").select("digest", F.col("root").alias("group_id"), "component_id")
    out = rows.join(named, "digest", "left").withColumn(
        "component_id", F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    return out.select("doc_id", "text_md5", "n_shingles", "group_id", "component_id",
                      F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def one_per_group(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``df`` that stand for their groups: one of each, and all rows with empty sets."""
    found = near_duplicates(df, key, text, percent)
    same = ["doc_id", "text_md5"]
    counts = found.groupBy("group_id", *same).agg(F.count(F.lit(1)).alias("n"))
    first = counts.filter("group_id IS NOT NULL").groupBy("group_id").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), *same, "n")).alias("one"))
    chosen = first.select("one.doc_id", "one.text_md5", F.col("one.n").alias("n")).unionByName(
        counts.filter("group_id IS NULL").select(*same, F.lit(0).cast("long").alias("n")))
    plan = written(chosen.withColumnsRenamed({"doc_id": "_id", "text_md5": "_md5", "n": "_n"}), "chosen")
    own = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.col(key).cast("long").alias("_key"),
                    F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("_digest"))
    match = F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_digest") == F.col("_md5"))
    alone = own.join(plan.filter("_n < 2"), match).select("_row")
    # equal rows are one document here; rows of this kind are few or alike, and combine before the shuffle
    alike = own.join(plan.filter("_n > 1"), match).groupBy("_id", "_md5").agg(F.first("_row").alias("_row")).select("_row")
    return alone.unionByName(alike).select("_row.*")
