"""Byte-level BPE encoding and decoding with length-bucketed numpy matrices.

A text is cut into pieces by the tokenizer's pattern. New pieces of a batch are put into matrices by
length, one row each, padded; every round merges in each row the leftmost pair of minimum rank, looks
the new neighbours up in an open-addressing hash table of pairs, closes the gap, and drops rows that
are done. Pieces met before come from a cache of bounded size. Pieces of more than ``LONGEST`` bytes
would need as many rounds as they have merges; they take the same merges from a heap.

Edge cases: a null or empty text has no tokens; equal rows get equal tokens; any text decodes to its
own bytes; an empty table gives no rows; other columns pass through whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from palaver.llm.frames import free

LONGEST = 256
CACHED_PIECES = 100_000
ROWS_AT_ONCE = 1 << 16
NONE = np.int64(1) << 40


def load_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """The rank file, read by Spark: lines of a token in base 64 and its rank."""
    return {base64.b64decode(token): int(rank) for token, rank in
            (r["value"].split() for r in spark.read.text(path).collect() if r["value"].strip())}


class Vocabulary:
    """Tokens by rank, and the rank of each pair of tokens whose bytes together are a token."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        keys, values = [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(rank)
        self.size = 1 << (2 * len(keys)).bit_length()
        self.keys, self.values = np.full(self.size, -1, np.int64), np.full(self.size, NONE, np.int64)
        keys, values = np.array(keys, np.int64), np.array(values, np.int64)
        slot, left = self.slot(keys), np.arange(len(keys))
        while len(left):  # each round the first key of a free slot gets it, the others move on
            free = left[self.keys[slot[left]] < 0]
            _, first = np.unique(slot[free], return_index=True)
            placed = free[first]
            self.keys[slot[placed]], self.values[slot[placed]] = keys[placed], values[placed]
            left = np.setdiff1d(left, placed, assume_unique=True)
            slot[left] = (slot[left] + 1) & (self.size - 1)
        # ids of bytes and ranks of pairs of bytes; byte 256 is padding
        self.padded = np.append(self.bytes, -1)
        self.byte_pairs = self.pair_ranks(np.repeat(self.padded, 257), np.tile(self.padded, 257))

    def slot(self, keys: np.ndarray) -> np.ndarray:
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - (self.size.bit_length() - 1))).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or ``NONE``. Negative ids are padding."""
        keys = left << 32 | right
        out = np.full(keys.shape, NONE, np.int64)
        todo = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        keys, flat = keys.ravel()[todo], out.ravel()
        slot = self.slot(keys)
        while len(todo):
            there = self.keys[slot]
            hit = there == keys
            flat[todo[hit]] = self.values[slot[hit]]
            on = ~hit & (there >= 0)
            todo, keys, slot = todo[on], keys[on], (slot[on] + 1) & (self.size - 1)
        return flat.reshape(out.shape)

    def merge_rows(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of pieces of similar length."""
        lengths = np.array([len(p) for p in pieces])
        width = int(lengths.max())
        raw = np.full((len(pieces), width + 1), 256, np.int64)
        raw[np.arange(width + 1) < lengths[:, None]] = np.frombuffer(b"".join(pieces), np.uint8)
        ids, ranks = self.padded[raw], self.byte_pairs[raw[:, :-1] * 257 + raw[:, 1:]]
        out: list = [None] * len(pieces)
        row_of = np.arange(len(pieces))
        while len(row_of):
            at = ranks.argmin(axis=1)  # the leftmost of equal ranks
            rows = np.arange(len(at))
            best = ranks[rows, at]
            done = best == NONE
            if done.any():
                data, step = ids[done].astype("<u4").tobytes(), 4 * ids.shape[1]
                for i, (row, n) in enumerate(zip(row_of[done].tolist(), lengths[done].tolist())):
                    out[row] = data[i * step:i * step + 4 * n]
                open_ = ~done
                ids, ranks, lengths, row_of = ids[open_], ranks[open_], lengths[open_], row_of[open_]
                at, best, rows = at[open_], best[open_], np.arange(int(open_.sum()))
                if not len(rows):
                    break
            # close the gap behind the merged pair: columns after it move one to the left; each row gets shorter by one
            columns = np.arange(ids.shape[1] - 1)
            behind = columns > at[:, None]
            ids = np.where(behind, ids[:, 1:], ids[:, :-1])
            ids[rows, at] = best
            ranks = np.where(behind[:, :-1], ranks[:, 1:], ranks[:, :-1])
            lengths = lengths - 1
            before = np.flatnonzero(at)
            r, a = np.concatenate((rows, before)), np.concatenate((at, at[before] - 1))
            ranks[r, a] = self.pair_ranks(ids[r, a], ids[r, a + 1])
            widest = int(lengths.max())
            if widest + 1 < ids.shape[1]:
                ids, ranks = ids[:, :widest + 1], ranks[:, :max(widest, 1)]
        return out

    def merge_long(self, piece: bytes) -> bytes:
        """The same merges in the same order from a heap of ``(rank, place)``."""
        ids = self.bytes[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        text = [self.tokens[i] for i in ids]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := self.ranks.get(text[i] + text[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if text[i] is None or j >= n or self.ranks.get(text[i] + text[j]) != rank:
                continue
            text[i], text[j] = text[i] + text[j], None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a in (before[i], i):
                if a >= 0 and after[a] < n and (r := self.ranks.get(text[a] + text[after[a]])) is not None:
                    heapq.heappush(heap, (r, a))
        return np.array([self.ranks[t] for t in text if t is not None], "<u4").tobytes()

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of any pieces: by length in matrices, the longest one by one."""
        out: list = [None] * len(pieces)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        order = np.argsort(sizes, kind="stable")
        sizes, order = sizes[order], order.tolist()
        i = 0
        while i < len(order):
            size = int(sizes[i])
            if size > LONGEST:
                out[order[i]] = self.merge_long(pieces[order[i]])
                i += 1
                continue
            j = min(int(np.searchsorted(sizes, min(LONGEST, size + max(1, size // 8)), side="right")),
                    i + max(1, ROWS_AT_ONCE // max(size, 1)) * 4)
            for k, ids in zip(order[i:j], self.merge_rows([pieces[k] for k in order[i:j]])):
                out[k] = ids
            i = j
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


class Recent:
    """Values of keys met lately, each in one of two halves or both: once ``new`` is full it becomes ``old``, and what only the
    former ``old`` held is dropped. So frequent keys stay known."""

    def __init__(self):
        self.new, self.old = {}, {}

    def missing(self, keys: set) -> list:
        """Those keys that have no value; all others are in ``new``."""
        if len(self.new) > CACHED_PIECES // 2:
            self.new, self.old = {}, self.new
        unknown = keys.difference(self.new)
        self.new.update((k, self.old[k]) for k in unknown if k in self.old)
        return list(unknown.difference(self.old))


class Encoder:
    """Encodes batches of texts; what was met lately is kept as packed ids.

    Every match of the pattern that holds a space followed by something else than white space begins
    with that space. So a text can be cut before each such space and the parts encoded apart from it, most
    of them from the cache. A text where a space is followed by white space, or ends, is matched as a whole.
    """

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.find, self.blank = vocabulary, regex.compile(pattern).findall, regex.compile(r"\s").match
        self.pieces = Recent()
        self.parts = Recent()  # by what follows a space; None: not to be cut before it

    def packed(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece."""
        new = self.pieces.missing(set(pieces))
        self.pieces.new.update(zip(new, self.vocabulary.merge([p.encode() for p in new])))
        return list(map(self.pieces.new.__getitem__, pieces))

    def encode_pieces(self, cut: list[list[str]]) -> list[bytes]:
        packed = iter(self.packed(list(itertools.chain.from_iterable(cut))))
        return [b"".join(itertools.islice(packed, len(pieces))) for pieces in cut]

    def learn(self, parts: list[str]) -> None:
        """Keep the ids of new parts, all of them matched at once: each match that begins with a space begins a part."""
        blank = {c for c in {p[:1] for p in parts} if not c or self.blank(c)}
        self.parts.new.update((p, None) for p in parts if p[:1] in blank)
        fit = [p for p in parts if p[:1] not in blank]
        if fit:
            pieces = self.find(" " + " ".join(fit))
            packed, starts = self.packed(pieces), [i for i, p in enumerate(pieces) if p[0] == " "]
            self.parts.new.update(zip(fit, (
                packed[s] if e - s == 1 else b"".join(packed[s:e]) for s, e in zip(starts, starts[1:] + [len(pieces)])), strict=True))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cut = [(t or "").split(" ") for t in texts]
        heads = self.encode_pieces([self.find(p[0]) for p in cut])
        rest = [p[1:] for p in cut]
        self.learn(self.parts.missing(set().union(*rest)))
        known, out = self.parts.new.__getitem__, []
        for text, head, parts in zip(texts, heads, rest):
            try:
                out.append(head + b"".join(map(known, parts)))
            except TypeError:  # one of them is None
                out.append(b"".join(self.packed(self.find(text))))
        return out


def groups(texts, limit: int = 1 << 19):
    """``(first, n)``: runs of neighbouring texts of an Arrow column, of about ``limit`` bytes or one text each."""
    sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    first, ends = 0, np.cumsum(sizes)
    while first < len(sizes):
        start = int(ends[first] - sizes[first])
        last = max(first + 1, int(np.searchsorted(ends, start + limit, side="right")))
        yield first, last - first
        first = last


def encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", keep: list[str] | None = None,
           with_ids: bool = True) -> DataFrame:
    """Columns ``keep`` (all by default), ``n_tokens, ids_sha256, decoded_sha256`` and ``ids`` (packed).

    Input columns that have one of the new names are replaced. A batch of thousands of texts is taken apart
    and handed on in groups, so a task holds the words, ids and bytes of one group only.
    """
    new = ["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids
    keep = [c for c in (df.columns if keep is None else keep) if c not in new]
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    shared = df.sparkSession.sparkContext.broadcast(ranks)  # one vocabulary, of fixed size

    def run(incoming):
        vocabulary = Vocabulary(shared.value)
        encoder = Encoder(vocabulary, pattern)
        for batch in incoming:
            *columns, texts = batch.columns
            for first, n in groups(texts):
                packed = encoder.encode(texts.slice(first, n).to_pylist())
                decoded = (vocabulary.decode(np.frombuffer(p, "<u4")) for p in packed)
                own = [c.slice(first, n) for c in columns] + [
                    pa.array([len(p) // 4 for p in packed], pa.int64()),
                    pa.array([hashlib.sha256(p).hexdigest() for p in packed], pa.string()),
                    pa.array([hashlib.sha256(d).hexdigest() for d in decoded], pa.string()),
                ] + [pa.array(packed, pa.binary())] * with_ids
                yield pa.RecordBatch.from_arrays(own, names=keep + new)

    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + ["n_tokens long", "ids_sha256 string", "decoded_sha256 string"]
                       + ["ids binary"] * with_ids)
    return df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias(free(keep, "text"))).mapInArrow(run, schema)


def decode(df: DataFrame, ranks: dict[bytes, int], ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text of packed ids; null ids are an empty text. Bytes that are not UTF-8 become U+FFFD."""
    shared = df.sparkSession.sparkContext.broadcast(ranks)
    keep = [c for c in df.columns if c != text]

    def run(incoming):
        vocabulary = Vocabulary(shared.value)
        for batch in incoming:
            packed = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            texts = [vocabulary.decode(np.frombuffer(p or b"", "<u4")).decode("utf-8", "replace") for p in packed]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(texts, pa.string())], names=keep + [text])

    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return df.select(*[F.col(f"`{c}`") for c in keep]).mapInArrow(run, ", ".join([f"`{c}` {kinds[c]}" for c in keep] + [f"`{text}` string"]))
