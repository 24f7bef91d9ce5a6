"""Fill-in-the-middle by piece tables.

A document is a list of descriptors ``(buffer, start, end)`` over two immutable buffers, the texts of
a slice and the sentinels. Cutting splits descriptors, an arrangement permutes them, hashes stream
over what they describe. The way back starts from the finished output and its form alone: one
descriptor over it is cut at the sentinels, the inverse permutation orders the parts, the sentinels drop out.

The cuts come from four draws of 32 bits, the first digits of the SHA-256 of ``<seed>:<key>``, so the
result depends on the key and the text alone. With n code points the prefix ends after the smaller
and the middle after the larger of two draws modulo ``n + 1``. A text that holds a sentinel stays
plain, so the first sentinel of each kind in an output is always the true one.

Nothing is shuffled. A task holds one Arrow batch and the outputs of one slice of about ``SLICE_BYTES``; a longer
text is a slice of its own. Code points are counted per block of ``BLOCK`` bytes, without a number per character.

Edge cases: a null text is an empty one; an empty text is plain; the draws of a null key are those of
the word ``null``; equal rows get equal outputs; an empty table gives no rows; other columns pass
through, but those that have the name of a result are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from palaver.llm.frames import free
from palaver.llm.words import text_column

SEED = 1
PLAIN_FROM, SPM_BELOW = 90, 20
SLICE_BYTES, BLOCK = 1 << 21, 4096
TEXT, MARKS = 0, 1
PREFIX_MARK, SUFFIX_MARK, MIDDLE_MARK = b"<P>", b"<S>", b"<M>"
SENTINELS = PREFIX_MARK + SUFFIX_MARK + MIDDLE_MARK
#: Arrangements of prefix, middle and suffix (0, 1, 2) and the three sentinels (3, 4, 5).
ARRANGED = {"plain": (0, 1, 2), "psm": (3, 0, 4, 2, 5, 1), "spm": (4, 2, 3, 0, 5, 1)}
RESULTS = ["n", "form", "prefix_chars", "middle_chars", "output", "output_sha256", "restored_sha256"]


class PieceTable:
    """Descriptors over immutable buffers, in the order of the document they stand for."""

    def __init__(self, buffers: Sequence[memoryview], pieces: list[tuple[int, int, int]]):
        self.buffers, self.pieces = buffers, pieces

    def cut(self, places: Sequence[int]) -> PieceTable:
        """Split at the byte offsets of the document; an offset at an end leaves an empty piece."""
        out, at, open_ = [], 0, list(places)
        for buffer, start, end in self.pieces:
            last = at + end - start
            while open_ and open_[0] <= last:
                middle = start + open_.pop(0) - at
                out.append((buffer, start, middle))
                at, start = at + middle - start, middle
            out.append((buffer, start, end))
            at = last
        return PieceTable(self.buffers, out)

    def with_sentinels(self) -> PieceTable:
        size = len(PREFIX_MARK)
        return PieceTable(self.buffers, self.pieces + [(MARKS, i, i + size) for i in range(0, len(SENTINELS), size)])

    def arranged(self, order: Sequence[int]) -> PieceTable:
        return PieceTable(self.buffers, [self.pieces[i] for i in order])

    def stream(self) -> Iterator[memoryview]:
        for buffer, start, end in self.pieces:
            yield self.buffers[buffer][start:end]

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for part in self.stream():
            digest.update(part)
        return digest.hexdigest()


class CodePoints:
    """Places of code points in UTF-8 bytes, from counts per block."""

    def __init__(self, data: np.ndarray):
        self.size = len(data)
        self.leads = (data & 0xC0) != 0x80
        starts = np.arange(0, len(data), BLOCK)
        counts = np.add.reduceat(self.leads, starts, dtype=np.int64) if len(data) else np.zeros(0, np.int64)
        self.sums = np.concatenate(([0], np.cumsum(counts)))

    def before(self, offset: int) -> int:
        """Number of code points that begin before a byte."""
        block = offset // BLOCK
        return int(self.sums[block]) + int(np.count_nonzero(self.leads[block * BLOCK:offset]))

    def offset(self, number: int) -> int:
        """First byte of a code point, counted from 0; the end of the bytes for one past the last."""
        if number >= self.sums[-1]:
            return self.size
        block = int(np.searchsorted(self.sums, number, side="right")) - 1
        inside = np.flatnonzero(self.leads[block * BLOCK:(block + 1) * BLOCK])
        return block * BLOCK + int(inside[number - self.sums[block]])


def form_of(text: bytes, draws: Sequence[int]) -> str:
    if not text or draws[2] % 100 >= PLAIN_FROM or any(m in text for m in (PREFIX_MARK, SUFFIX_MARK, MIDDLE_MARK)):
        return "plain"
    return "spm" if draws[3] % 100 < SPM_BELOW else "psm"


def restored(output: bytes, form: str) -> PieceTable:
    """The text of a finished output, as descriptors over the output."""
    whole = PieceTable((memoryview(output),), [(TEXT, 0, len(output))])
    if form == "plain":
        return whole
    order, places, at = ARRANGED[form], [], 0
    for part in order[::2]:  # sentinels stand at the even places
        at = output.index((PREFIX_MARK, SUFFIX_MARK, MIDDLE_MARK)[part - 3], at)
        places += [at, at + len(PREFIX_MARK)]
        at = places[-1]
    # the cut at 0 leaves an empty piece in front: drop it, then put parts 0, 1, 2 back in order
    return PieceTable(whole.buffers, whole.cut(places).pieces[1:]).arranged([order.index(i) for i in range(3)])


def slices_of(data: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int]]:
    first = 0
    while first < len(at) - 1:
        last = max(first + 1, int(np.searchsorted(at, at[first] + SLICE_BYTES, side="right")) - 1)
        yield first, last
        first = last


def arrange_batch(texts: pa.Array, draws: list[np.ndarray], with_output: bool) -> Iterator[tuple[int, int, list[pa.Array]]]:
    """Slices of a batch: first and last row, and the result columns."""
    data, at = text_column(texts)
    for first, last in slices_of(data, at):
        own, places = data[at[first]:at[last]], at[first:last + 1] - at[first]
        points, buffers = CodePoints(own), (memoryview(own), memoryview(SENTINELS))
        columns = [[] for _ in RESULTS]
        for i in range(last - first):
            start, end = int(places[i]), int(places[i + 1])
            begin = points.before(start)
            n = points.before(end) - begin
            own_draws = [int(d[first + i]) for d in draws]
            document = PieceTable(buffers, [(TEXT, start, end)])
            form = form_of(bytes(buffers[TEXT][start:end]), own_draws)
            prefix = middle = None
            if form != "plain":
                low, high = sorted(d % (n + 1) for d in own_draws[:2])
                prefix, middle = low, high - low
                document = document.cut([points.offset(begin + c) - start for c in (low, high)]).with_sentinels().arranged(ARRANGED[form])
            output = b"".join(document.stream())
            row = n, form, prefix, middle, output if with_output else None, document.sha256(), restored(output, form).sha256()
            for column, value in zip(columns, row):
                column.append(value)
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.string(), pa.string()]
        yield first, last, [pa.array(c, k).cast(pa.string()) if k == pa.binary() else pa.array(c, k) for c, k in zip(columns, kinds)]


def draws(key: Column, seed: int = SEED) -> list[Column]:
    """Four numbers below 2**32 from the key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(df: DataFrame, key: str = "doc_id", text: str = "text", keep: list[str] | None = None,
                   with_output: bool = True, seed: int = SEED) -> DataFrame:
    """Columns ``keep`` (all by default) with ``n, form, prefix_chars, middle_chars, output, output_sha256, restored_sha256``.

    ``restored_sha256`` is the hash of the text rebuilt from output and form. Without ``with_output``
    the outputs are built and hashed, but not returned.
    """
    results = [c for c in RESULTS if with_output or c != "output"]
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() not in results]
    taken = list(keep)
    names = []
    for name in ("fim_text", "fim_draw_1", "fim_draw_2", "fim_draw_3", "fim_draw_4"):
        names.append(free(taken, name))
        taken.append(names[-1])
    source = df.select(*[F.col(f"`{c}`") for c in keep],
                       *[c.alias(n) for c, n in zip([F.col(f"`{text}`"), *draws(F.col(f"`{key}`"), seed)], names)])

    def run(incoming):
        for batch in incoming:
            texts, *numbers = batch.columns[len(keep):]
            numbers = [c.to_numpy(zero_copy_only=False) for c in numbers]
            for first, last, columns in arrange_batch(texts, numbers, with_output):
                own = [c.slice(first, last - first) for c in batch.columns[:len(keep)]]
                chosen = [c for c, name in zip(columns, RESULTS) if name in results]
                yield pa.RecordBatch.from_arrays(own + chosen, names=keep + results)

    kinds = {"n": "long", "prefix_chars": "long", "middle_chars": "long"}
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join([f"`{c}` {fields[c]}" for c in keep] + [f"{c} {kinds.get(c, 'string')}" for c in results])
    return source.mapInArrow(run, schema)


def restore(df: DataFrame, output: str = "output", form: str = "form", name: str = "restored") -> DataFrame:
    """Add the text that an output and its form stand for; null where either is null."""
    keep = [c for c in df.columns if c != name]
    places = keep.index(output), keep.index(form)

    def run(incoming):
        for batch in incoming:
            data, at = text_column(batch.column(places[0]))
            forms = batch.column(places[1]).to_pylist()
            missing = batch.column(places[0]).is_null().to_pylist()
            for first, last in slices_of(data, at):
                texts = [None if missing[i] or forms[i] is None else b"".join(
                    restored(data[at[i]:at[i + 1]].tobytes(), forms[i]).stream()).decode() for i in range(first, last)]
                own = [c.slice(first, last - first) for c in batch.columns]
                yield pa.RecordBatch.from_arrays(own + [pa.array(texts, pa.string())], names=keep + [name])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*[F.col(f"`{c}`") for c in keep]).schema.fields)
    return df.select(*[F.col(f"`{c}`") for c in keep]).mapInArrow(run, f"{schema}, `{name}` string")
