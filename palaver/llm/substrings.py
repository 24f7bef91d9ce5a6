"""Removal of passages that repeat anywhere in the corpus: Rabin-Karp windows counted in Spark.

A window is ``size`` consecutive words of one text. Every window gets a rolling hash of 62 bits. Texts
are hashed in slices of a few MB. Within a slice each hash is kept once, and those that stand there
several times are known to repeat. The slice sends its distinct hashes, sorted, as differences, to
buckets by their leading bits. A bucket merges the packs of all slices and answers each slice that
shares a hash with another. So a hash travels once per slice, however hot it is, in about nine bytes.
The answers of a slice become intervals of words per text: overlapping windows merge.

All windows are judged on the input, not on what is left. A text is named by its digest and a slice
by the digests of its texts, so names do not depend on tasks or machines, and equal texts share their
intervals. The number of buckets follows the bytes of the texts. Two different windows get the same
hash with odds of about 2**-62 per pair (n windows: about n**2 / 2**63 such pairs, so one in two million of 10**13 windows).

Edge cases: a null text has no words; a text of fewer than ``size`` words keeps them all; of equal
rows every one counts; an empty table gives no rows; other columns pass through whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from palaver.llm.frames import free
from palaver.llm.words import WordHasher, run_lengths, slices

SIZE = 35
BUCKET_BYTES = 2 << 20
HASHED_AT_ONCE = 2 << 20
DIGEST = 16
#: What a row holds: a pack of hashes, an answer (places of repeated windows), or the texts of a slice.
PACK, ANSWER, TEXTS = 0, 1, 2
ROWS = pa.schema([("bucket", pa.int64()), ("kind", pa.int32()), ("slice", pa.binary()),
                  ("data", pa.binary()), ("places", pa.binary())])
ROWS_SQL = "bucket long, kind int, slice binary, data binary, places binary"


def short(values: np.ndarray) -> bytes:
    """Unsigned integers in as few bytes each as the largest needs; that number comes first."""
    values = np.ascontiguousarray(values, "<u8")
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    return bytes([width]) + values.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def long(data: bytes) -> np.ndarray:
    width = data[0]
    out = np.zeros(((len(data) - 1) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, offset=1).reshape(-1, width)
    return out.view("<u8").ravel()


def bucket_base(bucket: int, buckets: int) -> np.uint64:
    return np.uint64((-(-bucket * (1 << 32) // buckets)) << 32)


def pack_windows(size: int, buckets: int):
    """Mapper over one text column: rows of all three kinds for each slice."""

    def rows_of(part, hasher):
        at = part.windows(size)
        if not len(at):
            return
        hashes = hasher.windows(hasher.words(part), at, size)
        names = b"".join(hashlib.md5(part.raw(i)).digest() for i in range(part.n))
        name = hashlib.md5(names).digest()
        order = np.argsort(hashes, kind="stable")
        starts, lengths = run_lengths(hashes[order])
        own = buckets + int.from_bytes(name[:6], "big") % buckets
        yield own, TEXTS, name, names, short(part.first_word[:-1])
        several = np.repeat(lengths > 1, lengths)
        if several.any():
            yield own, ANSWER, name, None, short(np.sort(at[order[several]]))
        first = order[starts]
        distinct, places = hashes[first], at[first]
        bucket = ((distinct >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        for s, n in zip(*run_lengths(bucket)):
            deltas = np.diff(distinct[s:s + n], prepend=bucket_base(int(bucket[s]), buckets))
            yield int(bucket[s]), PACK, name, short(deltas), short(places[s:s + n])

    def run(incoming):
        hasher = WordHasher()
        for batch in incoming:
            for part in slices(batch.column(0), limit=HASHED_AT_ONCE):
                found = list(rows_of(part, hasher))
                for i in range(0, len(found), 1000):
                    columns = zip(*found[i:i + 1000])
                    yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, ROWS)], schema=ROWS)

    return run


def answer(buckets: int):
    """Bucket: the places of hashes that two packs or more hold; other kinds of rows pass."""

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        if key[0] >= buckets:
            return rows.drop_duplicates(["kind", "slice"])
        hashes = [np.cumsum(long(d), dtype=np.uint64) for d in rows["data"]]
        pack = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
        values = np.concatenate(hashes)
        order = np.argsort(values, kind="stable")
        starts, lengths = run_lengths(values[order])
        shared = np.sort(order[np.repeat(lengths > 1, lengths)])
        places = np.concatenate([long(p) for p in rows["places"]])[shared]
        names, out = rows["slice"].tolist(), {}
        for s, n in zip(*run_lengths(pack[shared])):
            out[names[pack[shared[s]]]] = short(places[s:s + n])
        return pd.DataFrame({"bucket": key[0], "kind": ANSWER, "slice": list(out), "data": None, "places": list(out.values())},
                            columns=ROWS.names)

    return run


def intervals(size: int):
    """Slice: merged intervals ``[start, end)`` of words to remove, per text that has any."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        answers = rows.loc[rows["kind"] == ANSWER, "places"]
        if not len(answers):
            return pd.DataFrame({"digest": [], "spans": []})
        texts = rows[rows["kind"] == TEXTS].iloc[0]
        first = long(texts["places"]).astype(np.int64)
        hits = np.unique(np.concatenate([long(p) for p in answers])).astype(np.int64)
        text = np.searchsorted(first, hits, side="right") - 1
        new = np.concatenate(([True], (np.diff(hits) > size) | (np.diff(text) > 0)))
        begins = np.flatnonzero(new)
        ends = np.concatenate((begins[1:], [len(hits)])) - 1
        owner = text[begins]
        spans = np.stack([hits[begins] - first[owner], hits[ends] + size - first[owner]], axis=1).astype("<i4")
        out = {texts["data"][DIGEST * owner[s]:DIGEST * (owner[s] + 1)]: spans[s:s + n].tobytes()
               for s, n in zip(*run_lengths(owner))}
        return pd.DataFrame({"digest": list(out), "spans": list(out.values())})

    return run


def find_repeats(df: DataFrame, text: str = "text", size: int = SIZE) -> DataFrame:
    """``(digest, spans)``: MD5 of each text with repeated windows, and its intervals of words (int32 pairs)."""
    n_bytes = df.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    buckets = max(1, -(-int(n_bytes) // BUCKET_BYTES))
    packs = df.select(F.col(text).alias("text")).mapInArrow(pack_windows(size, buckets), ROWS_SQL)
    answers = packs.groupBy("bucket").applyInPandas(answer(buckets), ROWS_SQL)
    found = answers.groupBy("slice").applyInPandas(intervals(size), "digest binary, spans binary")
    return found.dropDuplicates(["digest"])


def cut(pieces: list[bytes], spans: bytes | None) -> tuple[list[bytes], int]:
    """The words that no interval covers, and the number of the others."""
    if not spans:
        return pieces, 0
    kept, last = [], 0
    for start, end in np.frombuffer(spans, "<i4").reshape(-1, 2).tolist():
        kept += pieces[last:start]
        last = max(last, end)
    kept += pieces[last:]
    return kept, len(pieces) - len(kept)


def cut_texts(keep: list[str], with_text: bool):
    """Mapper over columns ``keep``, text and intervals: ``keep``, n_words, n_removed, kept_sha256 and, if wanted, the kept text."""

    def run(incoming):
        for batch in incoming:
            counts, removed, sums, texts = [], [], [], []
            for value, spans in zip(batch.column(len(keep)).to_pylist(), batch.column(len(keep) + 1).to_pylist()):
                pieces = (value or "").encode().split()
                left, gone = cut(pieces, spans)
                joined = b" ".join(left)
                counts.append(len(pieces))
                removed.append(gone)
                sums.append(hashlib.sha256(joined).hexdigest())
                if with_text:
                    texts.append(joined.decode() if gone else value)
            columns = batch.columns[:len(keep)]
            columns += [pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(sums, pa.string())]
            names = keep + ["n_words", "n_removed", "kept_sha256"]
            if with_text:
                columns, names = columns + [pa.array(texts, pa.string())], names + ["kept_text"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def remove_repeats(df: DataFrame, text: str = "text", size: int = SIZE, keep: list[str] | None = None,
                   with_text: bool = True) -> DataFrame:
    """Columns ``keep`` (all by default) with ``n_words, n_removed, kept_sha256`` and ``kept_text``.

    ``kept_text`` is the input where nothing is removed, else the kept words joined by one space.
    Input columns that have one of the new names are replaced.
    """
    new = ["n_words", "n_removed", "kept_sha256"] + ["kept_text"] * with_text
    keep = [c for c in (df.columns if keep is None else keep) if c not in new]
    value, name, own = free(keep, "text"), free(keep, "digest"), free(keep, "spans")
    source = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias(value))
    named = source.withColumn(name, F.unhex(F.md5(F.coalesce(F.col(value), F.lit("")))))
    spans = find_repeats(df, text, size).select(F.col("digest").alias(name), F.col("spans").alias(own))
    joined = named.join(spans, name, "left").select(*[F.col(f"`{c}`") for c in [*keep, value, own]])
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + [
        "n_words long", "n_removed long", "kept_sha256 string"] + ["kept_text string"] * with_text)
    return joined.mapInArrow(cut_texts(keep, with_text), schema)


def without_repeats(df: DataFrame, text: str = "text", n_chars: str = "n_chars", size: int = SIZE) -> DataFrame:
    """The rows of ``df`` with the kept text in place of the text, and its length in ``n_chars`` if there is such a column."""
    others = [F.col(f"`{c}`") for c in df.columns if c != text]
    own = df.select(F.struct(F.lit(0).alias("_"), *others).alias("_row"), F.col(f"`{text}`").alias("text"))
    rows = remove_repeats(own, "text", size, keep=["_row"])

    def value(name: str):
        if name == text:
            return F.col("kept_text").alias(name)
        if name == n_chars:
            return F.char_length("kept_text").cast(df.schema[name].dataType).alias(name)
        return F.col("_row")[name].alias(name)
    return rows.select(*[value(c) for c in df.columns])
