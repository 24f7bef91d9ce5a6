"""Quality and toxicity of documents by hierarchical empirical Bayes.

A document's own evidence is a log likelihood ratio from a classifier: log odds of the telling words
it holds (naive Bayes over words chosen by their chi-square) together with rule statistics, weighed
by a logistic regression. Each site adds a prior. The rate of a trait over all documents is the
global mean; a host's rate is shrunk towards it, and the rate of a path of the host towards the
host's, each with as many pseudo documents as the method of moments finds in the spread between
hosts, or between the paths of a host. A site of few documents thus stays near its parent. The
verdict is the posterior of the document under the prior of its path.

The classifier is fitted on the first ``LABELLED`` labelled documents by the hash of their number
(half of them choose and weigh the words, the other half fits the regression), which bounds the
fit; rates of sites come from all documents by sums that combine before the shuffle.

Edge cases: a null text is an empty one; null hosts and paths are sites of their own; equal rows get
equal verdicts; without labels of both kinds a trait has no evidence and no verdict against it; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from palaver.llm.anomaly import COUNTS, counts_of, fails, features
from palaver.llm.words import WordHasher, slices
from palaver.session import written

LABELLED, TELLING, CHI, BEFORE = 20_000, 2_000, 30.0, 8
SMOOTH, LIMIT = 0.5, 8.0
STRONGEST = 20.0
TRAITS = ("low", "toxic")
TOKEN_COUNTS = ("n", "low", "toxic", "before_low", "before_toxic")
MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def tokens(text: bytes) -> set[bytes]:
    """Distinct words in lower case without marks around them, and the shapes of what was around them."""
    out = set()
    for word in set(text.split()):
        core = word.strip(MARKS)
        if len(core) < len(word):
            out.add(b"#" + word.replace(core, b" ", 1) if core else b"#" + word)
        if len(core) > 1 and core.isupper():
            out.add(b"#UPPER")
        if core:
            out.add(core.lower())
    return out


def contexts(text: str | None) -> dict[bytes, int]:
    """The tokens, each with a bit set of the words before it (64 cells)."""
    out: dict[bytes, int] = {}
    before = b""
    for word in (text or "").encode().split():
        cell = 1 << zlib.crc32(before) % 63
        for token in tokens(word):
            out[token] = out.get(token, 0) | cell
        before = word
    return out


def token_counts(batches):
    """Per token: documents (all, low, toxic), and the words before it in low and in toxic ones."""
    for batch in batches:
        counts: dict[bytes, list[int]] = {}
        for text, low, toxic in zip(batch["text"], batch["low"], batch["toxic"]):
            for token, cells in contexts(text).items():
                own = counts.setdefault(token, [0] * 5)
                own[0] += 1
                own[1] += low
                own[2] += toxic
                own[3] |= cells * low
                own[4] |= cells * toxic
        yield pd.DataFrame([(t, *own) for t, own in counts.items()], columns=["token", *TOKEN_COUNTS]).astype(
            {c: "int64" for c in TOKEN_COUNTS})


def telling(counts: DataFrame, totals: dict[str, float], trait: str) -> dict[bytes, float]:
    """Log odds of the tokens that tell the trait, ``TELLING`` at most: that is the size of the model.

    They pass a chi-square test, and stand behind ``BEFORE`` different words or more in documents with
    the trait: a word that copies of one document share does not.
    """
    n, yes = float(totals["n"]), float(totals[trait])
    no = n - yes
    if not yes or not no:
        return {}
    with_yes, with_all = F.col(trait).cast("double"), F.col("n").cast("double")
    expected = with_all * (yes / n)
    chi = (with_yes - expected) ** 2 / F.greatest(expected * (1 - with_all / n) * (no / n), F.lit(1e-9))
    odds = F.log((with_yes + SMOOTH) / (yes + 2 * SMOOTH)) - F.log((with_all - with_yes + SMOOTH) / (no + 2 * SMOOTH))
    varied = counts.filter(F.bit_count(f"before_{trait}") >= BEFORE)
    rows = varied.select("token", chi.alias("chi"), odds.alias("odds")).filter(F.col("chi") > CHI).orderBy(
        F.col("chi").desc(), "token").limit(TELLING).collect()
    return {bytes(r["token"]): max(-LIMIT, min(LIMIT, r["odds"])) for r in rows}


def evidence_rows(texts: list, parts, weights: list[dict[bytes, float]]) -> np.ndarray:
    """Inputs of the regression, one row per text."""
    counts = {c: np.concatenate([p[c] for p in parts] or [np.zeros(0)]) for c in COUNTS}
    rules = np.column_stack([features(counts), counts["n_words"] < 50, fails(counts)])
    out = np.zeros((len(texts), 3 * len(weights)))
    for i, text in enumerate(texts):
        found = tokens((text or "").encode())
        for k, own in enumerate(weights):
            values = [own[t] for t in found if t in own]
            strong = [v for v in values if v > 1]
            out[i, 3 * k:3 * k + 3] = np.log1p(sum(strong)), max(strong, default=0), sum(values) / max(len(found), 1)
    return np.column_stack([out, rules])


def rows_of(batch, column: str, hasher: WordHasher, weights: list) -> np.ndarray:
    texts = batch.column(batch.schema.get_field_index(column))
    return evidence_rows(texts.to_pylist(), [counts_of(p, hasher) for p in slices(texts)], weights)


class Classifier:
    """Token weights and, per trait, the regression's offset, coefficients and base rate."""

    def __init__(self, weights: list[dict[bytes, float]], fits: list[tuple[float, np.ndarray] | None]):
        self.weights, self.fits = weights, fits

    def log_ratios(self, rows: np.ndarray) -> list[np.ndarray]:
        """Of each trait; 0 where nothing could be fitted."""
        return [np.zeros(len(rows)) if f is None else np.clip(f[0] + rows @ f[1], -STRONGEST, STRONGEST) for f in self.fits]


def fit(df: DataFrame, labels: DataFrame, key: str, text: str) -> Classifier:
    """Fit both stages on the bounded sample of labelled documents."""
    marks = labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(
        (1 - F.min("quality")).cast("long").alias("low"), F.max("toxic").cast("long").alias("toxic")).dropna()
    chosen = marks.orderBy(F.xxhash64("_key")).limit(LABELLED)  # so many rows of three numbers are broadcast
    rows = written(df.select(F.col(key).alias("_key"), F.col(text).alias("text")).join(F.broadcast(chosen), "_key").withColumn(
        "half", F.pmod(F.xxhash64("_key", F.lit("half")), F.lit(2))), "labelled")
    first = rows.filter("half = 0")
    totals = first.agg(F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(t), F.lit(0)).alias(t) for t in TRAITS]).first().asDict()
    counts = written(first.select("text", *TRAITS).mapInPandas(
        token_counts, "token binary, " + ", ".join(f"{c} long" for c in TOKEN_COUNTS)).groupBy("token").agg(
        *[F.sum(c).alias(c) for c in ("n", *TRAITS)], *[F.bit_or(f"before_{t}").alias(f"before_{t}") for t in TRAITS]), "tokens")
    weights = [telling(counts, totals, t) for t in TRAITS]

    def inputs(batches):
        hasher = WordHasher()
        for batch in batches:
            rows = rows_of(batch, "text", hasher, weights)
            yield pa.RecordBatch.from_arrays([pa.array(rows.tolist(), pa.list_(pa.float64()))] + [
                batch.column(batch.schema.get_field_index(t)) for t in TRAITS], names=["x", *TRAITS])

    second = written(rows.filter("half = 1").select("text", *TRAITS).mapInArrow(inputs, "x array<double>, low long, toxic long"), "evidence")
    sums = second.agg(F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(t), F.lit(0)).alias(t) for t in TRAITS]).first()
    fits = []
    for trait in TRAITS:
        if not 0 < sums[trait] < sums["n"]:
            fits.append(None)
            continue
        model = LogisticRegression(maxIter=50, regParam=1e-3).fit(
            second.select(array_to_vector("x").alias("features"), F.col(trait).cast("double").alias("label")))
        base = np.log(sums[trait] / (sums["n"] - sums[trait]))
        fits.append((float(model.intercept - base), np.array(model.coefficients.toArray())))
    return Classifier(weights, fits)


def evidence(df: DataFrame, classifier: Classifier, key: str, text: str, host: str, path: str) -> DataFrame:
    """``(doc_id, host, path, ratio_low, ratio_toxic)`` of every document, without its text."""
    narrow = df.select(F.col(key).alias("doc_id"), F.col(host).alias("host"), F.col(path).alias("path"), F.col(text).alias("text"))

    def run(batches):
        hasher = WordHasher()
        for batch in batches:
            ratios = classifier.log_ratios(rows_of(batch, "text", hasher, classifier.weights))
            yield pa.RecordBatch.from_arrays(batch.columns[:3] + [pa.array(r) for r in ratios],
                                             names=["doc_id", "host", "path", "ratio_low", "ratio_toxic"])

    kinds = {f.name: f.dataType.simpleString() for f in narrow.schema.fields}
    return narrow.mapInArrow(run, f"doc_id {kinds['doc_id']}, host {kinds['host']}, path {kinds['path']}, ratio_low double, ratio_toxic double")


def logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def posterior(ratio: Column, prior: Column) -> Column:
    return 1 / (1 + F.exp(-(ratio + logit(prior))))


def strength(between: Column, mean: Column) -> Column:
    """Pseudo documents of a Beta prior with this mean and variance between sites."""
    return F.least(F.greatest(mean * (1 - mean) / F.greatest(between, F.lit(1e-9)) - 1, F.lit(1.0)), F.lit(1e6))


def site_rates(rows: DataFrame, trait: str, base: float) -> DataFrame:
    """``(host, path, rate)``: the shrunk rate of each path.

    Documents count by their posterior under the base rate. The variance between sites is that of
    their rates, weighted by documents, less what chance alone gives sites of their sizes.
    """
    own = posterior(F.col(f"ratio_{trait}"), F.lit(base))
    paths = rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum(own).alias("s"))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s"))
    total = hosts.agg(F.sum("host_s") / F.sum("host_n"), F.sum("host_n"), F.count(F.lit(1))).first()
    mean = F.lit(float(total[0] or 0.0))

    def spread(n: str, s: str, about: Column, sites: int) -> Column:
        rate = F.col(s) / F.col(n)
        chance = F.lit(sites / max(float(total[1] or 1), 1.0))
        return F.sum(F.col(n) * (rate - about) ** 2) / F.sum(n) - mean * (1 - mean) * chance

    among_hosts = hosts.agg(spread("host_n", "host_s", mean, total[2]).alias("v")).first()[0] or 0.0
    shrunk = strength(F.lit(float(among_hosts)), mean)
    hosts = hosts.withColumn("host_rate", (shrunk * mean + F.col("host_s")) / (shrunk + F.col("host_n")))
    hosts = hosts.withColumnRenamed("host", "_host")
    placed = paths.join(hosts, paths["host"].eqNullSafe(hosts["_host"])).drop("_host")
    inside = placed.agg(spread("n", "s", F.col("host_s") / F.col("host_n"), 1).alias("v"), F.count(F.lit(1))).first()
    inner = strength(F.lit(max(float(inside[0] or 0.0), 0.0)), mean)
    rate = (inner * F.col("host_rate") + F.col("s")) / (inner + F.col("n"))
    return placed.select(F.col("host").alias("_host"), F.col("path").alias("_path"), rate.alias(f"site_{trait}"))


def classify(df: DataFrame, labels: DataFrame, host: str, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, host, path, site_low, site_toxic, p_low, p_toxic, kept)`` for every document."""
    classifier = fit(df, labels, key, text)
    rows = written(evidence(df, classifier, key, text, host, path), "ratios")
    rates = labels.agg(*[F.coalesce(F.avg(c), F.lit(0.0)) for c in ((F.col("quality") == 0).cast("double"), (F.col("toxic") == 1).cast("double"))]).first()
    out = rows
    for trait, base, known in zip(TRAITS, rates, classifier.fits):
        sites = site_rates(rows, trait, float(base) if known else 1e-6)
        out = out.join(sites, out["host"].eqNullSafe(sites["_host"]) & out["path"].eqNullSafe(sites["_path"])).drop("_host", "_path")
        out = out.withColumn(f"p_{trait}", posterior(F.col(f"ratio_{trait}"), F.col(f"site_{trait}")))
    kept = (F.col("p_low") < 0.5) & (F.col("p_toxic") < 0.5)
    return out.select("doc_id", "host", "path", "site_low", "site_toxic", "p_low", "p_toxic", kept.alias("kept"))
