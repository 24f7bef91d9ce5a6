"""Multi-label random forest on sparse TF-IDF features, its predictions and the rule fallback.

All labels share one joint tree structure, and every term of the corpus is a feature. A text is one row
with its sorted term numbers and weights; terms it lacks are zero and take no room. For growing, rows are stored once in chunks
whose entries are sorted by term. A task walks its chunks down the trees grown so far and sends, for the open nodes, only
entries of the terms that these may split on. What is not above a cut follows by subtraction from the totals of the node, so zeros are never
counted. The names of a node's low descendants, and so the terms they look at, are known beforehand: one task splits a large node and goes on down
its low side, several levels in one job. A node too large for that sends its entries to grouped sums by ``(tree, node, term)``, a
level a job. A node of few rows is finished by one task over these rows. All ways follow the same rules and give the same trees.
Memory does not depend on the vocabulary: the driver holds the nodes of the model, a task those, the frequent terms and one node's entries.

A node looks at a random part of the terms: the share of a square root, and at least about ``LEAST_SEEN``
entries. A split has the least Gini impurity summed over labels; ties go to the smaller term number, then the lower cut.
A tree's rows are drawn by a Poisson weight from the hash of the row, equal rows together.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from palaver import session, values
from palaver.functions.scalars import fixed
from palaver.functions.text import term_counts
from palaver.operators import vectors

#: A term splits a node by "weight above the cut"; 0 means that the text has the term.
CUTS = (0.0, 0.05, 0.1, 0.2)
#: A weight for each level, the number of cuts below a weight.
STANDS = np.array([CUTS[0], *[(a + b) / 2 for a, b in zip(CUTS, CUTS[1:])], CUTS[-1] + 1])
LEAST_SEEN, MOST_BROADCAST = 256, 100_000
#: A node that drew so many rows or fewer, of at most ``MOST_ENTRIES``, is finished by one task, which holds these rows and no others.
SMALL = 16_384
POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])
ODD = np.uint64(0x9E3779B97F4A7C15)
PIECE = 16_384
#: A stored chunk of rows has at most about so many entries; so many chunks go to one task.
CHUNK, CHUNKS = 1 << 21, 4
#: A large node is split by one task, for several levels down its low side at once, if that takes at most so many entries of the
#: terms it looks at; a node that needs more for one level is split by grouped sums.
MOST_ENTRIES, AHEAD = 1 << 22, 32
#: The small nodes of so many trees are finished in one job: their rows are on disk once for each of these trees.
TREES_A_JOB = 4
#: So many terms, the most frequent ones, send their idf to every task, as two numbers each; texts meet the others by shuffle.
HEAD_TERMS = 1 << 21
#: Texts are weighed in batches of at most so many entries.
BATCH_ENTRIES = 1 << 20
#: A session setting: files of a job's shuffles go when it ends, not when the driver happens to collect its garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: A tree of so many nodes for each row of a batch is walked row by row; a smaller one splits the batch node by node.
NODES_A_ROW = 8


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit integers over all bits."""
    own = x >> np.uint64(30)
    own ^= x
    own *= np.uint64(0xBF58476D1CE4E5B9)
    own ^= own >> np.uint64(27)
    own *= np.uint64(0x94D049BB133111EB)
    own ^= own >> np.uint64(31)
    return own


def drawn(rows: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often a tree draws each row (a 64-bit hash): Poisson of mean 1."""
    stream = mixed(np.array([seed * 1_000_003 + tree + 1], np.uint64) * ODD)
    uniform = (mixed(rows.view(np.uint64) ^ stream) >> np.uint64(11)).astype(float) / (1 << 53)
    return np.searchsorted(POISSON, uniform, side="right")


def term_draw(terms: np.ndarray, tree: int, names: np.ndarray, seed: int) -> np.ndarray:
    """A number in [0, 1) per term and node (by its name, below 2**32); a node looks at the terms below its share."""
    node = mixed((names.astype(np.uint64) + np.uint64((seed * 1_000_003 + tree + 1) << 32)) * ODD)
    return (mixed(terms.view(np.uint64) ^ node) >> np.uint64(11)).astype(float) / (1 << 53)


def looked_at(terms: np.ndarray, tree: int, name: int, share: float, seed: int) -> np.ndarray:
    """Places of the terms whose ``term_draw`` for one node is below its share; worked off in pieces that stay in the cache."""
    node = mixed(np.array([int(name) + ((seed * 1_000_003 + tree + 1) << 32)], np.uint64) * ODD)
    least, found = np.uint64(math.ceil(share * (1 << 53))), []
    for start in range(0, len(terms), PIECE):
        draws = mixed(terms[start:start + PIECE].view(np.uint64) ^ node) >> np.uint64(11)
        found.append(np.flatnonzero(draws < least) + start)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges ``start .. start + size - 1``, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def child_name(name: int, side: int) -> int:
    return int(mixed(np.array([(2 * name + side + 1) % (1 << 64)], np.uint64) * ODD)[0] >> np.uint64(32))


def share_of(n: int, n_terms: int, mean_terms: float, least_seen: int) -> float:
    """Part of the terms that a node of n drawn rows looks at."""
    return min(1.0, max(n_terms ** -0.5 if n_terms else 1.0, least_seen / max(n * mean_terms, 1.0)))


class Tree:
    """Nodes as columns; a leaf has no children (-1). A node's name follows from its path, so it does not depend on who grows it."""

    def __init__(self):
        self.term, self.cut, self.low, self.high, self.n, self.positives, self.depth, self.name = [], [], [], [], [], [], [], []

    def add(self, n: int, positives: list[int], depth: int, name: int) -> int:
        for column, value in zip((self.term, self.cut, self.low, self.high, self.n, self.positives, self.depth, self.name),
                                 (0, 0.0, -1, -1, n, positives, depth, name)):
            column.append(value)
        return len(self.n) - 1

    def split(self, node: int, term: int, cut: float, n: int, positives: list[int]) -> list[int]:
        """Children of a node; the one above the cut has ``n`` and ``positives``."""
        depth = self.depth[node] + 1
        rest = [a - b for a, b in zip(self.positives[node], positives)]
        self.term[node], self.cut[node] = term, cut
        self.low[node] = self.add(self.n[node] - n, rest, depth, child_name(self.name[node], 0))
        self.high[node] = self.add(n, list(positives), depth, child_name(self.name[node], 1))
        return [self.low[node], self.high[node]]

    def mixed_labels(self, node: int) -> bool:
        return any(0 < p < self.n[node] for p in self.positives[node])


class Sparse:
    """Rows of an Arrow batch ``(terms, weights)`` with the terms of each row sorted."""

    def __init__(self, terms: pa.Array, weights: pa.Array):
        self.terms, self.weights = (c.flatten().to_numpy(zero_copy_only=False) for c in (terms, weights))
        self.sizes = np.diff(terms.offsets.to_numpy())
        self.first = np.cumsum(self.sizes) - self.sizes
        self.n, self.row = len(self.sizes), np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.order = np.argsort(self.terms, kind="stable")  # entries by term, then by row
        in_order = self.terms[self.order]
        new = np.concatenate((np.ones(min(len(in_order), 1), bool), in_order[1:] != in_order[:-1]))
        self.known, self.begin = in_order[new], np.append(np.flatnonzero(new), len(in_order))
        code = np.empty(len(in_order), np.int64)
        code[self.order] = np.cumsum(new) - 1
        self.keys = self.row * max(len(self.known), 1) + code

    def of_rows(self, rows: np.ndarray) -> np.ndarray:
        """Entries of these rows, row by row."""
        return ranges(self.first[rows], self.sizes[rows])

    def of_terms(self, codes: np.ndarray) -> np.ndarray:
        """Entries of these terms (places in ``known``), term by term."""
        return self.order[ranges(self.begin[codes], self.begin[codes + 1] - self.begin[codes])]

    def above(self, code: int, cut: float) -> np.ndarray:
        """Rows with more of a term than the cut."""
        entry = self.order[self.begin[code]:self.begin[code + 1]]
        return self.row[entry[self.weights[entry] > cut]]

    def terms_of(self, entries: np.ndarray) -> np.ndarray:
        return self.terms[entries]

    def weight(self, rows: np.ndarray, terms: np.ndarray) -> np.ndarray:
        """Weight of a term in each row, 0 where the row lacks it."""
        if not len(self.keys):
            return np.zeros(len(rows))
        code = np.minimum(np.searchsorted(self.known, terms), len(self.known) - 1)
        key = rows * len(self.known) + code
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.known[code] == terms) & (self.keys[at] == key), self.weights[at], 0.0)

    def nodes(self, tree: tuple[np.ndarray, ...]) -> np.ndarray:
        """The node of a tree (arrays term, cut, low, high) where each row ends."""
        term, cut, low, high = tree
        if np.count_nonzero(low >= 0) <= NODES_A_ROW * self.n:
            return self.split_off(tree)
        at = np.zeros(self.n, np.int64)
        moving = np.arange(self.n)
        while len(moving := moving[low[at[moving]] >= 0]):
            node = at[moving]
            above = self.weight(moving, term[node]) > cut[node]
            at[moving] = np.where(above, high[node], low[node])
        return at


    def split_off(self, tree: tuple[np.ndarray, ...]) -> np.ndarray:
        """The same by nodes, parents first: each takes its rows above the cut out of its set, which goes on to the low child.

        Only rows that have a node's term are touched, so a long chain of nodes costs no more than the entries of its terms.
        """
        term, cut, low, high = tree
        inner = np.flatnonzero(low >= 0)
        code = np.minimum(np.searchsorted(self.known, term[inner]), max(len(self.known) - 1, 0))
        there = self.known[code] == term[inner] if len(self.known) else np.zeros(len(inner), bool)
        own, set_at, at_of = np.zeros(self.n, np.int64), {0: 0}, [0]
        for node, place, known, least, below, above in zip(*(c.tolist() for c in (inner, code, there, cut[inner], low[inner], high[inner]))):
            here = set_at.pop(node, None)
            if here is None:
                continue
            set_at[below], at_of[here] = here, below
            if known:
                rows = self.above(place, least)
                rows = rows[own[rows] == here]
                if len(rows):
                    own[rows] = set_at[above] = len(at_of)
                    at_of.append(above)
        return np.array(at_of, np.int64)[own]


def levels(weights: np.ndarray) -> np.ndarray:
    """How many cuts lie below each weight: all that splits ask of it."""
    return np.searchsorted(CUTS, weights).astype(np.uint8)


class Chunk(Sparse):
    """The same from a stored chunk of rows: entries by term, then by row, a weight given by its level; some 20 bytes an entry."""

    def __init__(self, stored: dict[str, np.ndarray]):
        self.hash, self.copies, self.known, self.begin, self.row, self.level = (
            stored[c] for c in ("row", "copies", "known", "begin", "at", "level"))
        self.n = len(self.hash)
        self.y = stored["y"].reshape(self.n, -1)
        self.sizes = np.bincount(self.row, minlength=self.n)
        self.first = np.cumsum(self.sizes) - self.sizes

    @cached_property
    def code(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.known), dtype=np.int32), np.diff(self.begin))

    @cached_property
    def by_row(self) -> np.ndarray:
        return np.argsort(self.row, kind="stable").astype(np.min_scalar_type(len(self.row)))

    def terms_of(self, entries: np.ndarray) -> np.ndarray:
        return self.known[self.code[entries]]

    def of_rows(self, rows: np.ndarray) -> np.ndarray:
        return self.by_row[super().of_rows(rows)]

    def of_terms(self, codes: np.ndarray) -> np.ndarray:
        return ranges(self.begin[codes], self.begin[codes + 1] - self.begin[codes])

    def above(self, code: int, cut: float) -> np.ndarray:
        own = slice(self.begin[code], self.begin[code + 1])
        return self.row[own][self.level[own] > CUTS.index(cut)]

    def above_cut(self, term: int, cut: float) -> np.ndarray:
        """``above`` for a term of the chunk."""
        return self.above(int(np.searchsorted(self.known, term)), cut)

    def nodes(self, tree: tuple[np.ndarray, ...]) -> np.ndarray:
        return self.split_off(tree)


def arrays(tree: Tree) -> tuple[np.ndarray, ...]:
    return (np.array(tree.term, np.int64), np.array(tree.cut, float), np.array(tree.low, np.int64), np.array(tree.high, np.int64))


@dataclass
class ForestModel:
    """A forest: its labels, its nodes ``(tree, node, term, cut, low, high, shares)`` and the fitted ``(term, idf)``."""

    labels: list[str]
    text: str
    nodes: list[tuple]
    idf: DataFrame

    def trees(self) -> list[tuple[tuple[np.ndarray, ...], np.ndarray]]:
        out = []
        for tree in sorted({n[0] for n in self.nodes}):
            own = sorted(n for n in self.nodes if n[0] == tree)
            columns = list(zip(*own))
            kinds = (np.int64, float, np.int64, np.int64)
            out.append((tuple(np.array(columns[2 + i], k) for i, k in enumerate(kinds)), np.array(columns[6], float)))
        return out


def _flat(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Row number and value of each element of a list column."""
    return np.repeat(np.arange(len(column)), np.diff(column.offsets.to_numpy())), column.flatten()


def _listed(n: int, row: np.ndarray, *columns: np.ndarray) -> list[pa.Array]:
    """List columns of n rows from values in row order."""
    offsets = pa.array(np.append(0, np.cumsum(np.bincount(row, minlength=n))), pa.int32())
    return [pa.ListArray.from_arrays(offsets, pa.array(c)) for c in columns]


def bounded(incoming, column: str):
    """Incoming batches in slices of at most ``BATCH_ENTRIES`` elements of a list column, or of one row."""
    for batch in incoming:
        ends, start = np.cumsum(np.diff(batch.column(column).offsets.to_numpy())), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + BATCH_ENTRIES, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def _head(idf: DataFrame) -> tuple[np.ndarray, np.ndarray, DataFrame | None]:
    """Numbers, in order, and idf of the ``HEAD_TERMS`` most frequent terms or fewer, and the other terms if there are any."""
    numbered, limit, known = idf.select(F.xxhash64("term").alias("t"), "idf"), -1.0, 0
    for value, n in sorted(tuple(r) for r in idf.groupBy("idf").count().collect()):
        known += n
        if known > HEAD_TERMS:
            break
        limit = value
    head = numbered.filter(F.col("idf") <= limit).toArrow()
    order = np.argsort(terms := head.column("t").to_numpy())
    return terms[order], head.column("idf").to_numpy()[order], numbered.filter(F.col("idf") > limit) if known > HEAD_TERMS else None


def features(lists: DataFrame, idf: DataFrame, key: str, then=None, schema: str = "") -> DataFrame:
    """Counted texts with ``terms`` and ``weights`` in place of their counts; terms by number, weights to 12 digits.

    ``lists`` is ``(key, ..., terms)`` with unique keys and ``terms`` of ``vectors.counted``; terms the fit has not seen are dropped.
    Frequent terms are looked up in the row, and a text stays where it is unless there are rarer terms than the head holds: only these
    meet their idf by shuffle. ``then`` maps each batch of the result to one of columns ``schema``, in the same pass.
    """
    known, idf_of, tail = _head(idf)
    others = [c for c in lists.columns if c != "terms"]
    columns = StructType([lists.schema[c] for c in others])
    numbered = lists.select(*others, F.transform("terms", lambda t: F.xxhash64(t["term"])).alias("t"), F.col("terms.n").alias("n"))

    def in_rows(row, n):
        return np.argsort(row.astype(np.min_scalar_type(n)), kind="stable")

    def found(batch):
        """Row, number and count of all terms in the order of their numbers, which are there, and count times idf of these."""
        row, terms = _flat(batch.column("t"))
        terms, n = terms.to_numpy(zero_copy_only=False), batch.column("n").flatten().to_numpy(zero_copy_only=False)
        order = np.argsort(terms)
        row, terms, n = row[order], terms[order], n[order]
        at = np.minimum(np.searchsorted(known, terms), max(len(known) - 1, 0))  # in order, so neighbours stay in the cache
        there = known[at] == terms if len(known) else np.zeros(len(terms), bool)
        return row, terms, n, there, n[there] * idf_of[at[there]]

    def unit(batch, row, terms, weights):
        order = in_rows(row, batch.num_rows)
        row, terms, weights = row[order], terms[order], weights[order]
        length = np.sqrt(np.bincount(row, weights * weights, minlength=batch.num_rows))
        lists = _listed(batch.num_rows, row, terms, np.round(weights / length[row], 12))
        whole = pa.RecordBatch.from_arrays([batch.column(c) for c in others] + lists, names=[*others, "terms", "weights"])
        return then(whole) if then else whole

    def at_once(incoming):
        for batch in bounded(incoming, "t"):
            row, terms, _, there, weights = found(batch)
            yield unit(batch, row[there], terms[there], weights)

    def halves(incoming):
        for batch in bounded(incoming, "t"):
            row, terms, n, there, weights = found(batch)
            lists = []
            for own, value in ((there, weights), (~there, n[~there])):
                order = in_rows(row[own], batch.num_rows)
                lists += _listed(batch.num_rows, row[own][order], terms[own][order], value[order])
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in others] + lists, names=[*others, "t", "w", "rare_t", "rare_n"])

    def joined(incoming):
        for batch in bounded(incoming, "t"):
            (row, terms), (rare_row, rare) = _flat(batch.column("t")), _flat(batch.column("rare"))
            terms, weights, rare_terms, rare_weights = (c.to_numpy(zero_copy_only=False) for c in (
                terms, batch.column("w").flatten(), rare.field("t"), rare.field("w")))
            row, terms, weights = np.append(row, rare_row), np.append(terms, rare_terms), np.append(weights, rare_weights)
            order = np.argsort(terms)
            yield unit(batch, row[order], terms[order], weights[order])

    result = schema or StructType([*columns, *StructType.fromDDL("terms array<bigint>, weights array<double>")])
    if tail is None:
        return numbered.mapInArrow(at_once, result)
    half = session.written(numbered.mapInArrow(halves, StructType([*columns, *StructType.fromDDL(
        "t array<bigint>, w array<double>, rare_t array<bigint>, rare_n array<int>")])), "looked-up")
    rare = half.select(key, F.inline(F.arrays_zip(F.col("rare_t").alias("t"), F.col("rare_n").alias("n")))).join(tail, "t")
    rare = rare.groupBy(key).agg(F.collect_list(F.struct("t", (F.col("n") * F.col("idf")).alias("w"))).alias("rare"))
    whole = half.drop("rare_t", "rare_n").join(rare, key, "left")
    none = F.array().cast("array<struct<t:bigint,w:double>>")
    return whole.select(*others, "t", "w", F.coalesce("rare", none).alias("rare")).mapInArrow(joined, result)


def _text_key(text: str) -> Column:
    return F.md5(F.coalesce(F.col(text), F.lit("")))


def counted_rows(df: DataFrame, text: str, labels) -> DataFrame:
    """``(row, copies, y, terms)``: equal rows once, with their counted terms, written for the fit of the idf and the weights."""
    keyed = df.select(_text_key(text).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"),
                      F.array(*[F.col(c).cast("int") for c in labels]).alias("y"))
    rows = keyed.groupBy("_key", "y").agg(F.count(F.lit(1)).alias("copies"), F.first("_text").alias("_text"))
    return session.written(rows.select(F.xxhash64("_key", "y").alias("row"), "copies", "y", term_counts(
        vectors.tfidf_tokens("_text")).alias("terms")), "counted")


def fit_idf(counted: DataFrame) -> DataFrame:
    """``vectors.idf_of`` of counted rows, each as often as it was there."""
    n_texts = counted.agg(F.sum("copies")).first()[0] or 0
    counts = counted.select("copies", F.explode("terms.term").alias("term")).groupBy("term").agg(F.sum("copies").alias("df"))
    return counts.select("term", "df", (F.log((1 + n_texts) / (1 + F.col("df"))) + 1).alias("idf"))


def training_rows(df: DataFrame, text: str, labels, idf: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """``(row, copies, y, terms, weights)``: equal rows once, written for the jobs of all levels."""
    return session.written(features(counted_rows(df, text, labels) if counted is None else counted, idf, "row"), "training")


STORED = {"row": np.int64, "copies": np.int64, "y": np.int32, "known": np.int64, "begin": np.int64, "at": np.uint16, "level": np.uint8}


def chunks_of(rows: DataFrame, entries: int) -> DataFrame:
    """Training rows in chunks, each a row of a few binary columns whose entries are sorted by term once for all levels."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    size = int(min(CHUNK, max(entries / (4 * cores), CHUNK / 64)))

    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        own = pa.Table.from_batches(held).combine_chunks()
        row, copies, y, terms, weights = (own.column(c).chunk(0) for c in ("row", "copies", "y", "terms", "weights"))
        sparse = Sparse(terms, weights)
        stored = {"row": row, "copies": copies, "y": y.flatten(), "known": sparse.known, "begin": sparse.begin,
                  "at": sparse.row[sparse.order], "level": levels(sparse.weights[sparse.order])}
        return pa.RecordBatch.from_arrays(
            [pa.array([np.asarray(v).astype(STORED[c]).tobytes()], pa.binary()) for c, v in stored.items()], names=list(stored))

    def run(incoming):
        held, entries_held, rows_held = [], 0, 0
        for batch in incoming:
            ends = np.cumsum(np.diff(batch.column(3).offsets.to_numpy()))
            start = 0
            while start < batch.num_rows:
                before = ends[start - 1] if start else 0
                stop = int(np.searchsorted(ends, before + size - entries_held, side="right"))
                stop = min(max(stop, start + (not held)), start + (1 << 16) - rows_held, batch.num_rows)
                if stop > start:
                    held.append(batch.slice(start, stop - start))
                    entries_held, rows_held, start = entries_held + ends[stop - 1] - before, rows_held + stop - start, stop
                if start < batch.num_rows:
                    yield packed(held)
                    held, entries_held, rows_held = [], 0, 0
        if held:
            yield packed(held)

    binary = rows.mapInArrow(run, ", ".join(f"{c} binary" for c in STORED))
    return session.written(binary.repartition(max(2 * cores, math.ceil(entries / (size * CHUNKS)))), "chunks", "none")


def stored_chunks(incoming):
    """The chunks of incoming batches, one at a time."""
    for batch in incoming:
        for i in range(batch.num_rows):
            yield Chunk({c: np.frombuffer(batch.column(c)[i].as_buffer(), kind) for c, kind in STORED.items()})


def _labels_matrix(column: pa.Array, n_labels: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, n_labels)


def root_totals(rows: DataFrame, trees: int, n_labels: int, seed: int) -> list[tuple]:
    """``(tree, n, positives)`` of all rows drawn by each tree."""

    def run(incoming):
        for batch in incoming:
            row, copies, y = batch.column(0).to_numpy(), batch.column(1).to_numpy(), _labels_matrix(batch.column(2), n_labels)
            weights = [drawn(row, t, seed) * copies for t in range(trees)]
            sums = [[int(w.sum()), *map(int, w @ y)] for w in weights]
            yield pa.RecordBatch.from_arrays([pa.array(range(trees), pa.int32()), pa.array(sums, pa.list_(pa.int64()))], names=["tree", "sums"])

    found = rows.select("row", "copies", "y").mapInArrow(run, "tree int, sums array<bigint>")
    totals = found.groupBy("tree").agg(*[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(n_labels + 1)])
    return sorted((r[0], r[1], list(r[2:])) for r in totals.collect())


def seen_of(sparse: Sparse, rows: np.ndarray, node: np.ndarray, value: int, tree: int, names: np.ndarray, share: float, seed: int) -> np.ndarray:
    """Entries of one node's rows (``node`` is ``value`` for these) whose term is looked at under one of the names.

    A node draws a term once, not once per entry: from the distinct terms of the batch, or from its own entries if these are fewer.
    """
    own = sparse.of_rows(rows) if sparse.sizes[rows].sum() < len(sparse.known) else None
    terms = sparse.known if own is None else sparse.terms_of(own)
    looked = looked_at(terms, tree, names[0], share, seed)
    if len(names) > 1:
        any_ = np.zeros(len(terms), bool)
        any_[looked] = True
        for name in names[1:]:
            any_[looked_at(terms, tree, name, share, seed)] = True
        looked = np.flatnonzero(any_)
    if own is not None:
        return own[looked]
    found = sparse.of_terms(looked)
    return found[node[sparse.row[found]] == value]


def rows_of_nodes(node: np.ndarray, taking: np.ndarray):
    """``(node, its rows)`` of the rows that take part."""
    taking = taking[np.argsort(node[taking], kind="stable")]
    open_, first = np.unique(node[taking], return_index=True)
    return zip(open_.tolist(), np.split(taking, first[1:]))


def seen_entries(sparse: Sparse, node: np.ndarray, share: np.ndarray, names: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """Entries whose term the node of their row looks at; ``node`` is -1 for rows that take no part."""
    taking = np.flatnonzero(node >= 0)
    found = [seen_of(sparse, rows, node, value, tree, names[value:value + 1], share[value], seed)
             for value, rows in rows_of_nodes(node, taking[share[node[taking]] > 0])]
    return np.concatenate([np.zeros(0, np.int64), *found])


def seen_terms(forest: list[Tree], open_: dict[tuple[int, int], float], n_labels: int, seed: int):
    """Mapper of chunks: ``(tree, node, term, weight, n, y)`` for each term that an open node looks at."""
    grown, names, shares = [arrays(t) for t in forest], [np.array(t.name, np.uint64) for t in forest], [np.zeros(len(t.n)) for t in forest]
    for (tree, node), value in open_.items():
        shares[tree][node] = value

    def run(incoming):
        for chunk in stored_chunks(incoming):
            for tree, share in enumerate(shares):
                if not share.any():
                    continue
                node, times = chunk.nodes(grown[tree]), drawn(chunk.hash, tree, seed) * chunk.copies
                entry = seen_entries(chunk, np.where(times > 0, node, -1), share, names[tree], tree, seed)
                own = chunk.row[entry]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(own), tree), pa.int32()), pa.array(node[own], pa.int32()), pa.array(chunk.terms_of(entry), pa.int64()),
                    pa.array(STANDS[chunk.level[entry]], pa.float64()), pa.array(times[own], pa.int64()),
                    *_listed(len(own), np.repeat(np.arange(len(own)), n_labels), chunk.y[own].ravel())],
                    names=["tree", "node", "term", "weight", "n", "y"])

    return run


def impurity(n: Column, positives: list[Column]) -> Column:
    """Gini impurity times the weight, summed over labels and halved."""
    total = sum((p * (n - p) for p in positives[1:]), positives[0] * (n - positives[0]))
    return total / n


def best_splits(chunks: DataFrame, forest: list[Tree], open_: dict[tuple[int, int], float], n_labels: int, seed: int) -> list:
    """``(tree, node, term, cut number, n, positives)`` above the cut, for the open nodes that a split improves."""
    seen = chunks.mapInArrow(seen_terms(forest, open_, n_labels, seed), "tree int, node int, term bigint, weight double, n bigint, y array<int>")
    above = []
    for i, cut in enumerate(CUTS):
        n = F.when(F.col("weight") > cut, F.col("n")).otherwise(0)
        above += [F.sum(n).alias(f"n{i}")] + [F.sum(n * F.get("y", F.lit(j))).alias(f"p{i}_{j}") for j in range(n_labels)]
    sums = seen.groupBy("tree", "node", "term").agg(*above)
    totals = chunks.sparkSession.createDataFrame(
        [(t, node, forest[t].n[node], *forest[t].positives[node]) for t, node in open_],
        "tree int, node int, n bigint, " + ", ".join(f"p{j} bigint" for j in range(n_labels)))
    joined = sums.join(F.broadcast(totals) if len(open_) <= MOST_BROADCAST else totals, ["tree", "node"])
    whole = [F.col(f"p{j}") for j in range(n_labels)]
    choices = []
    for i in range(len(CUTS)):
        n, own = F.col(f"n{i}"), [F.col(f"p{i}_{j}") for j in range(n_labels)]
        left = impurity(n, own) + impurity(F.col("n") - n, [a - b for a, b in zip(whole, own)])
        choices.append(F.when((n > 0) & (n < F.col("n")), F.struct(
            (left - impurity(F.col("n"), whole)).alias("change"), F.col("term").alias("term"), F.lit(i).alias("cut"),
            n.alias("n"), F.array(*own).alias("positives"))))
    best = joined.select("tree", "node", F.array_min(F.array(*choices)).alias("best")).filter("best.change < -1e-9")
    return best.groupBy("tree", "node").agg(F.min("best").alias("best")).select("tree", "node", "best.*").collect()


def best_split(chunk: Chunk, rows: np.ndarray, node: np.ndarray, value: int, times: np.ndarray, whole: np.ndarray,
               tree: int, name: int, share: float, seed: int):
    """The same choice among the rows of one node in memory: ``(term, cut number, n, positives)`` above the cut, or None.

    ``whole`` are n and positives of the node, which may have more rows than these: those without any of the terms.
    """
    entry = seen_of(chunk, rows, node, value, tree, np.array([name], np.uint64), share, seed)
    if not len(entry):
        return None
    code, group = np.unique(chunk.code[entry], return_inverse=True)
    terms, own = chunk.known[code], chunk.row[entry]
    group = group * len(STANDS) + chunk.level[entry]
    by_level = np.stack([np.bincount(group, w, minlength=len(terms) * len(STANDS)).reshape(len(terms), -1)
                         for w in (times[own], *(times[own, None] * chunk.y[own]).T)], axis=2).astype(np.int64)
    above = by_level[:, ::-1].cumsum(axis=1)[:, ::-1]
    best = None
    for i in range(len(CUTS)):
        sums = above[:, i + 1]
        valid = np.flatnonzero((sums[:, 0] > 0) & (sums[:, 0] < whole[0]))
        if not len(valid):
            continue
        high, low = sums[valid], whole - sums[valid]

        def impure(part):
            return (part[:, 1:] * (part[:, :1] - part[:, 1:])).sum(axis=1) / part[:, 0]
        change = impure(high) + impure(low) - impure(whole[None])
        at = int(np.argmin(change))  # terms are in order: the first is the smallest
        if change[at] < -1e-9 and (best is None or (change[at], terms[valid[at]], i) < best[0]):
            best = (change[at], terms[valid[at]], i), int(terms[valid[at]]), i, int(high[at, 0]), [int(p) for p in high[at, 1:]]
    return best and best[1:]


PIECES = {"times": np.int64, "y": np.int32, "known": np.int64, "sizes": np.int32, "at": np.uint16, "level": np.uint8}
PIECE_ROWS = "tree int, node int, " + ", ".join(f"{c} binary" for c in PIECES)


def pieces(forest: list[Tree], nodes: list[np.ndarray], entries_of, seed: int):
    """Mapper of chunks: for each of the nodes its rows in the chunk, with entries by term, as a row of binary columns.

    ``entries_of`` picks entries of a node in any order; without it a node gets all entries of its rows.
    """
    grown, wanted = [arrays(t) if len(own) else None for t, own in zip(forest, nodes)], [np.zeros(len(t.n), bool) for t in forest]
    for mask, own in zip(wanted, nodes):
        mask[own] = True

    def whole(chunk, node):
        number = np.searchsorted(open_ := np.unique(node[node >= 0]), node).astype(np.min_scalar_type(len(open_) + 1))
        number[node < 0] = len(open_)
        of_entry = number[chunk.row]
        order = np.argsort(of_entry, kind="stable")
        ends = np.cumsum(np.bincount(of_entry, minlength=len(open_)))
        for i, value in enumerate(open_.tolist()):
            yield value, order[ends[i - 1] if i else 0:ends[i]]

    def run(incoming):
        for chunk in stored_chunks(incoming):
            local = np.zeros(chunk.n, np.uint16)
            for tree, mask in enumerate(wanted):
                if not mask.any():
                    continue
                node, times = chunk.nodes(grown[tree]), drawn(chunk.hash, tree, seed) * chunk.copies
                node = np.where((times > 0) & mask[node], node, -1)
                out = []
                for value, entry in whole(chunk, node) if entries_of is None else (
                        (value, np.sort(entries_of(chunk, rows, node, tree, value))) for value, rows in rows_of_nodes(node, np.flatnonzero(node >= 0))):
                    row, code = chunk.row[entry], chunk.code[entry]
                    there = np.zeros(chunk.n, bool)
                    there[row] = True
                    held = np.flatnonzero(there)
                    local[held] = np.arange(len(held))
                    first = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else code
                    parts = times[held], chunk.y[held], chunk.known[code[first]], np.diff(np.append(first, len(code))), local[row], chunk.level[entry]
                    if len(held):
                        out.append((value, *[p.astype(k).tobytes() for p, k in zip(parts, PIECES.values())]))
                if out:
                    columns = list(zip(*out))
                    yield pa.RecordBatch.from_arrays([pa.array([tree] * len(out), pa.int32()), pa.array(columns[0], pa.int32()),
                                                      *[pa.array(c, pa.binary()) for c in columns[1:]]], names=["tree", "node", *PIECES])

    return run


def put_together(own: pa.Table, n_labels: int) -> tuple[int, int, Chunk, np.ndarray]:
    """``(tree, node, rows, times)`` of the pieces of one node: their lists of terms are merged, term by term."""
    parts = {c: [np.frombuffer(b, k) for b in own.column(c).to_pylist()] for c, k in PIECES.items()}
    n = np.array([len(t) for t in parts["times"]])
    parts["at"] = [a.astype(np.min_scalar_type(int(n.sum()))) + np.array(s, np.min_scalar_type(int(n.sum()))) for a, s in zip(parts["at"], np.cumsum(n) - n)]
    stored = {c: np.concatenate(p) for c, p in parts.items()}
    sizes, order = stored["sizes"], np.argsort(stored["known"], kind="stable")
    entry = ranges((np.cumsum(sizes) - sizes)[order], sizes[order])
    terms, begin = stored["known"][order], np.cumsum(sizes[order]) - sizes[order]
    new = np.append(True, terms[1:] != terms[:-1])
    whole = Chunk({"row": stored["times"], "copies": stored["times"], "y": stored["y"], "known": terms[new],
                   "begin": np.append(begin[new], len(entry)), "at": stored["at"][entry], "level": stored["level"][entry]})
    return own.column("tree")[0].as_py(), own.column("node")[0].as_py(), whole, stored["times"]


@dataclass
class Growth:
    """What the growing of all trees is told: sizes of the corpus, depth and seed."""

    n_labels: int
    n_terms: int
    mean_terms: float
    depth: int
    seed: int

    def share(self, n: int, least_seen: int | None = None) -> float:
        return share_of(n, self.n_terms, self.mean_terms, LEAST_SEEN if least_seen is None else least_seen)

    def ends(self, tree: Tree, node: int) -> bool:
        return tree.depth[node] >= self.depth or tree.n[node] <= 1 or not tree.mixed_labels(node)

    def small(self, n: int, small: int | None = None) -> bool:
        return n <= (SMALL if small is None else small) and n * self.mean_terms <= MOST_ENTRIES

    def ahead(self, tree: Tree, node: int) -> int:
        """So many levels down the low side of a node fit into one task."""
        entries = max(tree.n[node] * self.mean_terms * self.share(tree.n[node]), 1.0)
        return int(min(MOST_ENTRIES // entries, AHEAD, self.depth - tree.depth[node]))


def low_splits(chunks: DataFrame, forest: list[Tree], open_: list[tuple[int, int]], growth: Growth) -> list:
    """``(tree, node, step, term, cut number, n, positives, ended)`` of the splits of each open node and of its low descendants.

    These have known names, so the terms they look at are known before their splits are: one task per node gets the entries of these
    terms and goes down level by level, until a node is small, ends or looks at a larger share. ``ended``: the last low node stays a leaf.
    """
    state, plan, seed, n_labels, least_seen, small = {}, {}, growth.seed, growth.n_labels, LEAST_SEEN, SMALL
    for t, node in open_:
        own = forest[t]
        state[t, node] = own.n[node], own.positives[node], own.depth[node], own.name[node]
        names = [own.name[node]]
        while len(names) < growth.ahead(own, node):
            names.append(child_name(names[-1], 0))
        plan[t, node] = np.array(names, np.uint64), growth.share(own.n[node])

    def entries_of(chunk, rows, node, tree, value):
        names, share = plan[tree, value]
        return seen_of(chunk, rows, node, value, tree, names, share, seed)

    def down(own: pa.Table) -> pa.Table:
        tree, node, chunk, times = put_together(own, n_labels)
        (names, share), top, here, splits, ended = plan[tree, node], Tree(), 0, [], False
        top.add(*state[tree, node])
        at, rows = np.zeros(chunk.n, np.int64), np.arange(chunk.n)
        for _ in names:
            whole = np.array([top.n[here], *top.positives[here]])
            found = best_split(chunk, rows, at, here, times, whole, tree, top.name[here], share, seed)
            if found is None:
                ended = True
                break
            term, cut, above, positives = found
            splits.append(found)
            low, _ = top.split(here, term, CUTS[cut], above, positives)
            at[chunk.above_cut(term, CUTS[cut])] = -1
            rows = rows[at[rows] == here]
            at[rows], here = low, low
            if growth.ends(top, low) or growth.small(top.n[low], small) or growth.share(top.n[low], least_seen) != share:
                break
        columns = list(zip(*splits)) or [[]] * 4
        size = len(splits)
        return pa.table({"tree": pa.array([tree] * size, pa.int32()), "node": pa.array([node] * size, pa.int32()), "step": pa.array(range(size), pa.int32()),
                         "term": pa.array(columns[0], pa.int64()), "cut": pa.array(columns[1], pa.int32()), "n": pa.array(columns[2], pa.int64()),
                         "positives": pa.array(columns[3], pa.list_(pa.int64())), "ended": pa.array([ended] * size, pa.bool_())})

    dealt = chunks.mapInArrow(pieces(forest, [np.array([n for t, n in open_ if t == tree], np.int64) for tree in range(len(forest))], entries_of, seed), PIECE_ROWS)
    found = dealt.groupBy("tree", "node").applyInArrow(
        down, "tree int, node int, step int, term bigint, cut int, n bigint, positives array<bigint>, ended boolean").collect()
    return sorted(found, key=lambda r: (r.tree, r.node, r.step))


def finish(chunks: DataFrame, forest: list[Tree], small: list[tuple[int, int]], growth: Growth) -> None:
    """Grow the small open nodes to their ends, each in one task over its own rows, and hang the subtrees on."""
    least_seen, state = LEAST_SEEN, {(t, node): (forest[t].n[node], forest[t].positives[node], forest[t].depth[node], forest[t].name[node]) for t, node in small}
    nodes = [np.array([node for t, node in small if t == tree], np.int64) for tree in range(len(forest))]

    def subtree(own: pa.Table) -> pa.Table:
        tree, node, chunk, times = put_together(own, growth.n_labels)
        top = Tree()
        top.add(*state[tree, node])
        at, open_ = np.zeros(chunk.n, np.int64), [(0, np.arange(chunk.n))]
        while open_:
            here, inside = open_.pop()
            if growth.ends(top, here):
                continue
            whole = np.array([top.n[here], *top.positives[here]])
            found = best_split(chunk, inside, at, here, times, whole, tree, top.name[here], growth.share(top.n[here], least_seen), growth.seed)
            if found is not None:
                term, cut, above, own_positives = found
                low, high = top.split(here, term, CUTS[cut], above, own_positives)
                up = chunk.above_cut(term, CUTS[cut])
                at[up[at[up] == here]] = high
                up = at[inside] == high
                at[inside[~up]] = low
                open_ += [(low, inside[~up]), (high, inside[up])]
        size = len(top.n)
        return pa.table({"tree": pa.array([tree] * size, pa.int32()), "node": pa.array([node] * size, pa.int32()), "place": pa.array(range(size), pa.int32()),
                         "term": pa.array(top.term, pa.int64()), "cut": pa.array(top.cut, pa.float64()), "low": pa.array(top.low, pa.int32()),
                         "high": pa.array(top.high, pa.int32()), "n": pa.array(top.n, pa.int64()), "positives": pa.array(top.positives, pa.list_(pa.int64()))})

    dealt = chunks.mapInArrow(pieces(forest, nodes, None, growth.seed), PIECE_ROWS)
    found = dealt.groupBy("tree", "node").applyInArrow(
        subtree, "tree int, node int, place int, term bigint, cut double, low int, high int, n bigint, positives array<bigint>").toArrow()
    found = found.take(pa.array(np.lexsort([found.column(c).to_numpy() for c in ("place", "node", "tree")])))
    for t, node, place, term, cut, low, high, n, positives in zip(*(c.to_pylist() for c in found.columns)):
        tree = forest[t]
        if place == 0:
            first, at = len(tree.n), node
        else:
            at = tree.add(n, positives, 0, 0)
        tree.term[at], tree.cut[at] = term, cut
        tree.low[at], tree.high[at] = (-1 if c < 0 else first + c - 1 for c in (low, high))


def grow(rows: DataFrame, trees: int, entries: int, growth: Growth) -> list[Tree]:
    """All trees, large nodes first, some levels a job, then each small node in one task; the driver holds the nodes."""
    forest, open_, small = [], [], []
    for _, n, positives in root_totals(rows, trees, growth.n_labels, growth.seed):
        forest.append(Tree())
        forest[-1].add(n, positives, 0, 1)

    def sort_out(tree: int, node: int) -> None:
        if not growth.ends(forest[tree], node):
            (small if growth.small(forest[tree].n[node]) else open_).append((tree, node))

    for t in range(len(forest)):
        sort_out(t, 0)
    chunks = chunks_of(rows, entries) if open_ or small else None
    while open_:
        largest = {(t, node): growth.share(forest[t].n[node]) for t, node in open_ if growth.ahead(forest[t], node) < 1}
        splits = best_splits(chunks, forest, largest, growth.n_labels, growth.seed) if largest else []
        rest = [o for o in open_ if o not in largest]
        down = low_splits(chunks, forest, rest, growth) if rest else []
        open_.clear()
        for s in sorted(splits, key=lambda s: (s.tree, s.node)):
            for child in forest[s.tree].split(s.node, s.term, CUTS[s.cut], s.n, list(s.positives)):
                sort_out(s.tree, child)
        for s, after in zip(down, [*down[1:], None]):
            low, high = forest[s.tree].split(s.node if s.step == 0 else low, s.term, CUTS[s.cut], s.n, list(s.positives))
            sort_out(s.tree, high)
            if not s.ended and (after is None or after.step == 0):
                sort_out(s.tree, low)
    for first in range(0, len(forest), TREES_A_JOB):
        if own := [(t, node) for t, node in small if first <= t < first + TREES_A_JOB]:
            finish(chunks, forest, own, growth)
    return forest


def fit_forest(df: DataFrame, text: str = "comment_text", labels=values.TOXICITY_LABELS, trees: int = 15,
               depth: int = 100, seed: int = 0) -> ForestModel:
    """One joint forest for all labels over the whole vocabulary. Rows with a null label take no part."""
    labels = list(labels)
    known = df.select(text, *labels).dropna(subset=labels)
    counted = counted_rows(known, text, labels)
    idf = session.written(fit_idf(counted), "idf")
    rows = training_rows(known, text, labels, idf, counted)
    n_terms = idf.count()
    n_rows, entries = rows.agg(F.count(F.lit(1)), F.sum(F.size("terms"))).first()
    growth = Growth(len(labels), n_terms, entries / n_rows if n_rows else 0.0, depth, seed)
    with session.setting(df.sparkSession, DROP_SHUFFLES, "true"):  # all that grow reads is written
        forest = grow(rows, trees, entries, growth) if n_terms else []
    nodes = [(t, i, tree.term[i], tree.cut[i], tree.low[i], tree.high[i], [p / tree.n[i] for p in tree.positives[i]])
             for t, tree in enumerate(forest) if tree.n[0] for i in range(len(tree.n))]  # a tree that drew no row says nothing
    return ForestModel(labels, text, nodes, idf)


def predict(model: ForestModel, df: DataFrame) -> DataFrame:
    """Add ``probabilities``: the mean share of each label in the leaves that a text reaches, in the model's order."""
    forest, n_labels = model.trees(), len(model.labels)

    def means(batch):
        sparse = Sparse(batch.column("terms"), batch.column("weights"))
        total = np.zeros((sparse.n, n_labels))
        for tree, shares in forest:
            total += shares[sparse.nodes(tree)]
        return pa.RecordBatch.from_arrays([batch.column("_key"), *_listed(
            sparse.n, np.repeat(np.arange(sparse.n), n_labels), (total / max(len(forest), 1)).ravel())], names=["_key", "probabilities"])

    keyed = df.withColumn("_key", _text_key(model.text))
    texts = keyed.select("_key", F.coalesce(F.col(model.text), F.lit("")).alias("_text")).dropDuplicates(["_key"])
    lists = vectors.counted(texts, "_key", vectors.tfidf_tokens("_text"))
    scored = features(lists, model.idf, "_key", means, "_key string, probabilities array<double>")
    return keyed.join(scored, "_key").select(*df.columns, "probabilities")


def label_map(labels, probabilities="probabilities", threshold: float = 0.5) -> Column:
    """``{label: 0/1}`` with 1 above the threshold."""
    flags = F.transform(probabilities, lambda p: (p > threshold).cast("int"))
    return F.map_from_arrays(F.array(*[F.lit(c) for c in labels]), flags)


def model_score(probabilities="probabilities") -> Column:
    """Mean of the label probabilities, to 4 digits."""
    total = F.aggregate(probabilities, F.lit(0.0), lambda a, p: a + p)
    return fixed(F.try_divide(total, F.size(probabilities).cast("double")), 4)


def score_with_fallback(df: DataFrame, model: ForestModel | None, rule: str) -> DataFrame:
    """Add ``toxicity_score``: the model's mean, or the rule score (a column) without a model or a result."""
    if model is None:
        return df.withColumn("toxicity_score", F.col(rule))
    scored = predict(model, df).withColumn("toxicity_score", F.coalesce(model_score(), F.col(rule)))
    return scored.drop("probabilities")


NODES = "tree int, node int, term bigint, cut double, low int, high int, shares array<double>"


def save_model(model: ForestModel, path: str) -> None:
    """Three Parquet folders: the form of the model, its nodes, its term weights."""
    spark = model.idf.sparkSession
    kinds = pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.list_(pa.float64())
    columns = list(zip(*model.nodes)) or [()] * len(kinds)
    nodes = pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=StructType.fromDDL(NODES).names)
    spark.createDataFrame(nodes, StructType.fromDDL(NODES)).write.mode("overwrite").parquet(f"{path}/nodes")
    model.idf.write.mode("overwrite").parquet(f"{path}/idf")
    spark.createDataFrame([(model.labels, model.text)], "labels array<string>, text string").write.mode("overwrite").parquet(f"{path}/form")


def load_model(spark: SparkSession, path: str) -> ForestModel | None:
    """The stored model, or None when there is none at the path."""
    try:
        form = spark.read.parquet(f"{path}/form").first()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    nodes = list(zip(*(c.to_pylist() for c in spark.read.parquet(f"{path}/nodes").toArrow().columns)))
    return ForestModel(list(form.labels), form.text, nodes, spark.read.parquet(f"{path}/idf"))
