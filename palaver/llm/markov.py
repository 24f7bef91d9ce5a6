"""Document scores under a hidden Markov language model.

A token is a word (A-Z in lower case) or the end of its document. The states emit symbols: the
``HEAD`` most frequent words are symbols of their own, all other words share ``CLASSES`` symbols by their ending,
and the end has one. A word that shares a symbol has the probability ``(c + 1) / (N' + V' + 1)`` within it, from
the counts of all training words of that symbol, where unseen words have count 0. So every token of every document
has its probability, and

    log P(text) = log P(symbols) + sum of log P(word | symbol)

The symbols' probability is exact: the scaled forward recursion runs over the whole document. The
states are trained by Baum-Welch: in each round every partition adds up the expected counts of its
training documents, in stretches of up to ``STRETCH`` tokens, Spark sums them, and the driver gets a
table of states by symbols, whose size does not depend on the data. Word counts cover all training
documents. The most frequent words, ``LISTED`` at most, go to the tasks as a table; all other words
find their counts by a join.

Edge cases: a null or empty text is one end token; a null number is treated as an empty one when
documents are held out; equal rows get equal scores; without training documents the
counts are 0 and the states even; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from palaver.session import written

HEAD, CLASSES = 190, 64
END = HEAD + CLASSES
SYMBOLS = END + 1
STATES, ROUNDS, STRETCH = 6, 6, 512
LISTED, LONGEST_LISTED = 1 << 17, 64
FOLDS, HELD_OUT = 7, 2
TOKENS_AT_ONCE = 1 << 19
COUNTED_AT_ONCE = 300_000
PSEUDO = 0.01
ENCODED = ["row", "doc_id", "held_out", "symbols", "known", "logs", "inside", "rest"]


def held_out(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % FOLDS == HELD_OUT


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def ending(word: bytes) -> int:
    return HEAD + zlib.crc32(word[-2:]) % CLASSES


def ending_column(word: Column) -> Column:
    """The same in SQL."""
    return (F.crc32(F.substring(F.encode(word, "UTF-8"), -2, 2)) % CLASSES + HEAD).cast("int")


def count_words(incoming):
    """Mapper over a text column: words and their counts, summed as far as memory allows."""

    def rows(counts):
        return pa.RecordBatch.from_arrays([pa.array([w.decode() for w in counts], pa.string()), pa.array(counts.values(), pa.int64())],
                                          names=["word", "c"])

    for batch in incoming:
        counts: Counter = Counter()
        for text in batch.column(0).to_pylist():
            counts.update(words_of(text))
            if len(counts) > COUNTED_AT_ONCE:
                yield rows(counts)
                counts = Counter()
        yield rows(counts)


def most_frequent(counts: DataFrame, limit: int) -> list[tuple[str, int]]:
    """The words whose count falls into the highest classes that hold ``limit`` words together, by falling count.

    Classes are sixteenths of a power of two; their sizes come first, so that no task sends more
    than its share of the list. Overlong words are left to the join, which bounds the bytes as well.
    """
    grade = F.floor(16 * F.log2("c"))
    short = counts.filter(F.octet_length("word") <= LONGEST_LISTED)
    left, lowest = limit, None
    for r in sorted(short.groupBy(grade.alias("grade")).count().collect(), key=lambda r: -r["grade"]):
        left -= r["count"]
        if left < 0:
            break
        lowest = r["grade"]
    if lowest is None:
        return []
    return sorted(((r["word"], r["c"]) for r in short.filter(grade >= lowest).collect()), key=lambda x: (-x[1], x[0].encode()))


class Lexicon:
    """The listed words: number, symbol and count of each, and the totals of the symbols that words share."""

    def __init__(self, listed: list[tuple[str, int]], totals: dict[int, tuple[int, int]], n_train: int):
        self.number = {w.encode(): i for i, (w, _) in enumerate(listed)}
        self.symbol = np.array([i if i < HEAD else ending(w.encode()) for i, (w, _) in enumerate(listed)] + [0], np.uint8)
        self.log_count = np.log10(np.array([c for _, c in listed] + [0], float) + 1)
        self.n_train = n_train
        self.log_total = np.zeros(SYMBOLS)
        for symbol in range(HEAD, END):
            n, v = totals.get(symbol, (0, 0))
            self.log_total[symbol] = np.log10(n + v + 1)

    def encode(self, text: str | None) -> tuple[bytes, int, float, float, str]:
        """``(symbols, known, log counts, log P(word | symbol) so far, words to look up)`` of the words and the end.

        What words to look up add to both sums is the logarithm of their count plus one.
        """
        words = words_of(text)
        get = self.number.get
        number = np.array([get(w, -1) for w in words], np.int64)
        symbols = np.append(self.symbol[number], np.uint8(END))
        missing = np.flatnonzero(number < 0)
        rest = [words[i] for i in missing]
        symbols[missing] = [ending(w) for w in rest]
        logs = np.where(number >= 0, self.log_count[number], 0.0)
        shared = symbols[:-1] >= HEAD
        inside = logs[shared].sum() - self.log_total[symbols[:-1]].sum()
        known = len(words) - len(rest) + (self.n_train > 0)
        return symbols.tobytes(), known, float(logs.sum() + np.log10(self.n_train + 1)), float(inside), b" ".join(rest).decode()


class Model:
    """Start, step and emission probabilities."""

    def __init__(self, start: np.ndarray, step: np.ndarray, emit: np.ndarray):
        self.start, self.step, self.emit = start, step, emit

    @classmethod
    def first(cls, frequency: np.ndarray, states: int = STATES) -> "Model":
        """States that differ at random around the symbols' frequencies, and tend to stay."""
        random = np.random.default_rng(7)
        emit = (frequency + PSEUDO) * random.uniform(0.3, 1.7, (states, SYMBOLS))
        step = np.full((states, states), 0.1 / max(states - 1, 1)) + np.eye(states) * 0.8
        return cls(np.full(states, 1 / states), step / step.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))

    @classmethod
    def from_counts(cls, counts: np.ndarray, states: int = STATES) -> "Model":
        """``counts`` are the sums of start, step and emission counts, side by side."""
        start = counts[:states] + PSEUDO
        step = counts[states:states + states * states].reshape(states, states) + PSEUDO
        emit = counts[states + states * states:].reshape(states, SYMBOLS) + PSEUDO
        return cls(start / start.sum(), step / step.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))

    def expected(self, sequences: list[np.ndarray]) -> np.ndarray:
        """Expected start, step and emission counts of some sequences (the E step)."""
        k = len(self.start)
        order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
        lengths = np.array([len(sequences[i]) for i in order])
        longest = int(lengths[0])
        symbols = np.full((longest, len(order)), END, np.int64)
        for column, i in enumerate(order):
            symbols[:lengths[column], column] = sequences[i]
        active = np.searchsorted(-lengths, -np.arange(longest), side="left")  # sequences longer than t
        emit = self.emit.T.copy()
        forward, scale = np.zeros((longest, len(order), k)), np.ones((longest, len(order)))
        for t in range(longest):
            n = active[t]
            now = emit[symbols[t, :n]]
            now *= self.start if t == 0 else forward[t - 1, :n] @ self.step
            total = now.sum(1)
            forward[t, :n] = now / total[:, None]
            scale[t, :n] = total
        steps, emits = np.zeros((k, k)), np.zeros((SYMBOLS, k))
        backward = np.ones((len(order), k))
        for t in range(longest - 1, -1, -1):
            n = active[t]
            gamma = forward[t, :n] * backward[:n]
            gamma /= gamma.sum(1, keepdims=True)
            for s in range(k):
                emits[:, s] += np.bincount(symbols[t, :n], gamma[:, s], SYMBOLS)
            if t == 0:
                start = gamma.sum(0)
                break
            ahead = emit[symbols[t, :n]] * backward[:n] / scale[t, :n, None]
            steps += forward[t - 1, :n].T @ ahead * self.step
            backward[:n] = ahead @ self.step.T
        return np.concatenate((start, steps.ravel(), emits.T.ravel()))

    def log10_likelihood(self, sequences: list[np.ndarray]) -> np.ndarray:
        """Exact log10 probability of each whole sequence."""
        order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
        lengths = np.array([len(sequences[i]) for i in order])
        starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]
        flat = np.concatenate([sequences[i] for i in order]) if order else np.zeros(0, np.uint8)
        emit, total, state = self.emit.T.copy(), np.zeros(len(order)), np.zeros((len(order), len(self.start)))
        active = np.searchsorted(-lengths, -np.arange(int(lengths[0]) if len(lengths) else 0), side="left")
        for t, n in enumerate(active):
            now = emit[flat[starts[:n] + t]]
            now *= self.start if t == 0 else state[:n] @ self.step
            mass = now.sum(1)
            state[:n] = now / mass[:, None]
            total[:n] += np.log10(mass)
        out = np.empty(len(order))
        out[order] = total
        return out


def expectation(model: Model):
    """Mapper: the summed counts of a partition's training documents, one row per number."""

    def run(batches):
        total, held, size = 0.0, [], 0
        for batch in batches:
            for packed in batch["symbols"]:
                symbols = np.frombuffer(packed, np.uint8)
                held += [symbols[i:i + STRETCH] for i in range(0, len(symbols), STRETCH)]
                size += len(symbols)
                if size > TOKENS_AT_ONCE:
                    total, held, size = total + model.expected(held), [], 0
        if held:
            total = total + model.expected(held)
        if not np.isscalar(total):
            yield pd.DataFrame({"place": np.arange(len(total)), "count": total})

    return run


def train(encoded: DataFrame, rounds: int = ROUNDS, states: int = STATES) -> Model:
    """Baum-Welch over the training rows of ``encoded``."""
    rows = encoded.filter("NOT held_out").select("symbols")
    size = states + states * states + states * SYMBOLS
    model = Model.first(np.full(SYMBOLS, 1 / SYMBOLS), states)
    for _ in range(rounds):
        sums = rows.mapInPandas(expectation(model), "place long, count double").groupBy("place").agg(F.sum("count").alias("count")).toPandas()
        counts = np.zeros(size)
        counts[sums["place"]] = sums["count"]
        if not counts.any():
            break
        model = Model.from_counts(counts, states)
    return model


def scores(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for every document."""
    docs = df.select(F.col(key).alias("doc_id"), held_out(F.col(key)).alias("held_out"), F.col(text).alias("text"))
    training = docs.filter("NOT held_out")
    counts = written(training.select("text").mapInArrow(count_words, "word string, c long").groupBy("word").agg(
        F.sum("c").alias("c")), "words")
    n_train = training.count()
    n_words, n_types = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    n_tokens, n_types = n_words + n_train, n_types + (n_train > 0)
    listed = most_frequent(counts, LISTED)
    by_symbol = counts.groupBy(ending_column(F.col("word")).alias("symbol")).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"))
    totals = {r["symbol"]: [r["n"], r["v"]] for r in by_symbol.collect()}
    for word, c in listed[:HEAD]:
        own = totals[ending(word.encode())]
        own[0], own[1] = own[0] - c, own[1] - 1
    lexicon = df.sparkSession.sparkContext.broadcast((listed, totals, n_train))

    def encode(incoming):
        own = Lexicon(*lexicon.value)
        for batch in incoming:
            *columns, texts = batch.columns
            coded = zip(*(own.encode(t) for t in texts.to_pylist())) if len(texts) else [[]] * 5
            kinds = (pa.binary(), pa.int64(), pa.float64(), pa.float64(), pa.string())
            yield pa.RecordBatch.from_arrays(columns + [pa.array(c, k) for c, k in zip(coded, kinds)], names=ENCODED)

    kind = docs.schema["doc_id"].dataType.simpleString()
    encoded = written(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text").mapInArrow(
        encode, f"row long, doc_id {kind}, held_out boolean, symbols binary, known long, logs double, inside double, rest string"),
        "encoded")
    model = train(encoded)

    def forward(batches):
        for batch in batches:
            sequences = [np.frombuffer(s, np.uint8) for s in batch["symbols"]]
            yield batch[["row", "doc_id", "held_out", "known", "logs", "inside"]].assign(
                n_tokens=[len(s) for s in sequences], symbol_score=model.log10_likelihood(sequences))

    scored = encoded.mapInPandas(forward, f"row long, doc_id {kind}, held_out boolean, known long, logs double, inside double, "
                                          "n_tokens long, symbol_score double")
    looked_up = encoded.filter("rest <> ''").select("row", F.explode(F.split("rest", " ")).alias("word")).join(
        counts, "word").groupBy("row").agg(F.sum(F.log10(F.col("c") + 1)).alias("more_logs"), F.count(F.lit(1)).alias("more_known"))
    joined = scored.join(looked_up, "row", "left")
    more = F.coalesce("more_logs", F.lit(0.0))
    base = F.col("logs") + more - F.col("n_tokens") * F.log10(F.lit(float(n_tokens + n_types + 1)))
    return joined.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(n_tokens).cast("long").alias("train_tokens"), base.alias("base_score"),
        (F.col("symbol_score") + F.col("inside") + more).alias("score"))
