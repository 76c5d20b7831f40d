"""Quality by hierarchical empirical Bayes: a document's own evidence, and what its host and path have shown so far.

A logistic model, fitted on a bounded sample of labelled rows, gives each document a likelihood ratio. Its features are the
shape of the text (symbols, capitals, digits, stops, repetition, lengths) and its words, as shares of 128 hashed cells.
Grouped sums of the model's probabilities give each host's and each path's share of good documents; both are shrunk, a
path towards its host, a host towards the corpus, the more the fewer documents there are. The strengths of the two priors
are estimated from the spread of the shares themselves (method of moments). A document's own probability is taken out of
its host's and path's sums first, so that the same evidence doesn't count twice. The posterior odds are the document's
likelihood ratio times its path's odds.

Texts are measured twice, once for the sums and once for the rows: what would save it, a copy of the documents in the
shared folder, would cost more.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.work import Scratch
from .batches import handing_back, short_batches
from .jaccard_join import word_hashes
from .names import free_prefix

_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_BYTES_AT_ONCE = 1_000_000
_SYMBOLS, _DIGITS, _STOPS = b"#$%&*|!@^~<>{}[]=+_\\/", b"0123456789", b".,;:?"
SHAPE, CELLS = 11, 128
FEATURES = SHAPE + CELLS


def surface_features(text: str | None) -> list[float]:
    """Shares of symbols, capitals, digits, stops, repeated and short words, and the log of the length; zeros for blank."""
    b = (text or "").encode("utf-8", "surrogatepass")
    words = b.split()
    if not words:
        return [0.0] * SHAPE
    n, m = len(b), len(words)
    left = lambda chars: n - len(b.translate(None, chars))
    upper, lower, symbols = left(_UPPER), left(_LOWER), left(_SYMBOLS)
    again = sum(map(operator.eq, words, words[1:])) / m
    return [1.0, (symbols / m) ** 0.5, (b.count(b"\n") / m) ** 0.5, upper / (upper + lower + 1), (upper / (upper + lower + 1)) ** 0.5, again**0.5, again, left(_DIGITS) / n, left(_STOPS) / m, len(set(words)) / m, np.log1p(m) / 10]


def features(texts: list[str | None]) -> np.ndarray:
    """``surface_features`` and the square roots of the shares of words by 128 hashed cells; one row a text."""
    out = np.zeros((len(texts), FEATURES))
    lo = 0
    while lo < len(texts):
        hi, size, part = lo, 0, []
        while hi < len(texts) and (size < _BYTES_AT_ONCE or hi == lo):
            out[hi, :SHAPE] = surface_features(texts[hi])
            part.append((texts[hi] or "").lower().encode("utf-8", "surrogatepass"))
            size += len(part[-1])
            hi += 1
        starts, words = word_hashes(np.frombuffer(b" ".join(part) + b" ", np.uint8))
        owner = np.searchsorted(np.cumsum([len(x) + 1 for x in part]), starts, side="right")
        counts = np.bincount(owner * CELLS + (words >> np.uint64(57)).astype(np.int64), minlength=len(part) * CELLS).reshape(len(part), CELLS)
        out[lo:hi, SHAPE:] = np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))
        lo = hi
    return out


class EvidenceModel:
    def __init__(self, weights: np.ndarray, base: float) -> None:
        self.weights, self.base = weights, base

    @classmethod
    def fit(cls, features: np.ndarray, good: np.ndarray, ridge: float = 0.1, rounds: int = 30, cells_ridge: float = 3.0) -> EvidenceModel:
        if not len(good) or good.min() == good.max():
            return cls(np.zeros(FEATURES + 1), 0.0)
        x = np.column_stack([np.ones(len(features)), features])
        w = np.zeros(x.shape[1])
        ridges = np.where(np.arange(len(w)) <= SHAPE, ridge, cells_ridge)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + np.diag(ridges), x.T @ (good - p) - ridges * w)
            w += step
            if np.abs(step).max() < 1e-6:
                break
        return cls(w, float(np.log(good.mean() / (1 - good.mean()))))

    def evidence(self, texts: pd.Series) -> np.ndarray:
        """Log likelihood ratio of good against bad; 0 for blank texts: only their site speaks for them."""
        x = features([t if isinstance(t, str) else None for t in texts])
        out = np.column_stack([np.ones(len(x)), x]) @ self.weights - self.base
        return np.where(x[:, 0] > 0, np.clip(out, -20, 20), 0.0)


def fit_evidence(documents: DataFrame, labels: DataFrame, most_rows: int = 12_000) -> EvidenceModel:
    """Fits on at most ``most_rows`` labelled rows, chosen by a hash of doc_id; null labels and ids are left out."""
    short_batches(documents.sparkSession)
    chosen = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max("quality").alias("_good"))
    chosen = chosen.orderBy(F.xxhash64("_id"), "_id").limit(most_rows)
    docs = documents.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("text"))

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"good": batch["_good"].astype(float), "x": list(features([t if isinstance(t, str) else None for t in batch["text"]]))})

    rows = docs.join(F.broadcast(chosen), "_id").mapInPandas(handing_back(measured), "good double, x array<double>").toArrow()
    x = rows["x"].combine_chunks().flatten().to_numpy().reshape(len(rows), FEATURES)
    return EvidenceModel.fit(x, rows["good"].to_numpy())


def _strength(shares: DataFrame, n: str, mean: str, within: str) -> float:
    """Prior strength by moments, from each group's count, mean and the mean of its parent: large where shares hardly differ."""
    v = F.col(within) * (1 - F.col(within))
    row = shares.where(F.col(n) > 1).agg(F.sum(F.col(n) * (F.col(mean) - F.col(within)) ** 2).alias("s"), F.sum(v).alias("v"), F.sum(F.col(n) * v).alias("nv"), F.count("*").alias("k")).first()
    if not row["k"] or not row["nv"]:
        return 10.0
    between = max((row["s"] - row["v"]) / row["nv"], 1e-4)  # the spread beyond chance, as a share of the binomial variance
    return float(min(max(1 / between - 1, 1.0), 1000.0))


def site_sums(scored: DataFrame, host: str, path: str, scratch: Scratch) -> tuple[DataFrame, float, float, float]:
    """Of every path: host, path, n and s (documents and sum of ``p``), hn and hs (its host's); the corpus's share of good
    documents and the strengths of the host's and the path's prior. scored: the two columns and ``p``."""
    paths = scratch.keep(scored.groupBy(F.col(host).alias("host"), F.col(path).alias("path")).agg(F.count("*").alias("n"), F.sum("p").alias("s")))
    whole = paths.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    corpus = (whole["s"] + 1) / (whole["n"] + 2) if whole["n"] else 0.5
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs")).withColumn("top", F.lit(float(corpus)))
    k_host = _strength(hosts.withColumn("m", F.col("hs") / F.col("hn")), "hn", "m", "top")
    both = scratch.keep(paths.join(hosts.select(F.col("host").alias("of"), "hn", "hs"), F.col("host").eqNullSafe(F.col("of"))).drop("of"))
    h = (F.col("hs") + k_host * corpus) / (F.col("hn") + k_host)
    k_path = _strength(both.withColumns({"m": F.col("s") / F.col("n"), "h": h}), "n", "m", "h")
    return both, float(corpus), k_host, k_path


def shrunk(own: Column | float, sums: dict[str, Column], corpus: float, k_host: float, k_path: float, out: int = 1) -> tuple[Column, Column]:
    """The host's share of good documents and the path's prior without ``out`` documents whose probabilities sum to ``own``."""
    host = (sums["hs"] - own + k_host * corpus) / (sums["hn"] - out + k_host)
    return host, (sums["s"] - own + k_path * host) / (sums["n"] - out + k_path)


def quality_posterior(documents: DataFrame, model: EvidenceModel, host: str = "source", path: str = "lang") -> DataFrame:
    """``documents`` with ``_evidence``, ``_host_share``, ``_prior`` and ``_quality``, the posterior probability of good. Where
    ``documents`` has such names, see ``free_prefix``.

    A null host or path is a site of its own. Blank and null texts have no evidence, so they get their site's share. Long texts
    are measured whole. Repeated rows count each, and get equal values. No documents: no rows.
    """
    short_batches(documents.sparkSession)
    scratch, c = Scratch(documents.sparkSession), free_prefix(documents)

    def of_batches(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series(model.evidence(s))

    @F.pandas_udf("double")
    def evidence(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from handing_back(of_batches)(texts)

    # or a later condition on the result would be pushed below the join, with an evaluation of its own
    evidence = evidence.asNondeterministic()

    def logistic(x: Column) -> Column:
        return 1 / (1 + F.exp(-x))

    h, p = F.col(host).cast("string"), F.col(path).cast("string")
    read = documents.select(h.alias("host"), p.alias("path"), evidence(F.col("text").cast("string")).alias("e"))
    both, corpus, k_host, k_path = site_sums(read.withColumn("p", logistic(F.col("e") + model.base)), "host", "path", scratch)
    keys = {f"{c}h1": F.coalesce(h, F.lit("")), f"{c}h2": h.isNull(), f"{c}p1": F.coalesce(p, F.lit("")), f"{c}p2": p.isNull()}
    sites = both.select(F.coalesce("host", F.lit("")).alias(f"{c}h1"), F.col("host").isNull().alias(f"{c}h2"), F.coalesce("path", F.lit("")).alias(f"{c}p1"), F.col("path").isNull().alias(f"{c}p2"), *[F.col(x).alias(f"{c}{x}") for x in ("n", "s", "hn", "hs")])
    mine = documents.withColumns(keys | {f"{c}evidence": evidence(F.col("text").cast("string"))}).join(sites, list(keys), "left")
    share, prior = shrunk(logistic(F.col(f"{c}evidence") + model.base), {x: F.col(f"{c}{x}") for x in ("n", "s", "hn", "hs")}, corpus, k_host, k_path)
    least = lambda x: F.least(F.greatest(x, F.lit(1e-9)), F.lit(1 - 1e-9))
    out = mine.withColumns({f"{c}host_share": least(share), f"{c}prior": least(prior)})
    out = out.withColumn(f"{c}quality", logistic(F.col(f"{c}evidence") + F.log(F.col(f"{c}prior") / (1 - F.col(f"{c}prior")))))
    return out.select(*documents.columns, f"{c}evidence", f"{c}host_share", f"{c}prior", f"{c}quality")
