"""Toxicity by a classifier chain.

Categories are predicted one after the other. Each is a linear (logistic) model
over the shares that words and beginnings of words have in a text, and a few shape
figures; from the second on it also sees the probabilities of the categories before it. Those are
out-of-fold predictions while it is trained, so it learns from the errors that
the earlier models make on unseen texts.

The fit reads a bounded, hash-chosen sample of labelled documents
(``max_labelled``); scoring reads the whole text of every document.

Defined cases: null and empty texts have no words and are scored on that; a null
label leaves the row out of that category's fit; a category with one label value
only, or an empty label table, gives its base rate (0 without any label);
repeated rows are scored alike; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import settle

MAX_LABELLED = 6000
FOLDS = 5
TERMS = 256
MIN_TEXTS = 3
MIN_Z = 4.0
RIDGE = 1.0
STARTS = (4, 5, 6)
LONGEST_TERM = 48
BLOCK_ROWS = 512

_UPPER = bytes(range(65, 91))
_SIGNS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_FOLD = bytes(32 if b in _SIGNS else b + 32 if b in _UPPER else b for b in range(256))


def shape(raw: bytes, words: list[bytes], distinct: int) -> list[float]:
    """Size, variety, capitals and signs of a text."""
    n = max(1, len(raw))
    return [
        float(np.log1p(len(words))),
        distinct / max(1, len(words)),
        (len(raw) - len(raw.translate(None, _UPPER))) / n,
        (len(raw) - len(raw.translate(None, _SIGNS))) / n,
    ]


def terms_of(text: str | None) -> tuple[list[float], set[bytes]]:
    """Shape figures and terms: words, and ``n:`` with the first n bytes of longer words."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.translate(_FOLD).split()
    distinct = set(words)
    terms = {w for w in distinct if len(w) <= LONGEST_TERM}
    for n in STARTS:
        terms.update(b"%d:" % n + w[:n] for w in distinct if len(w) > n)
    return shape(raw, words, len(distinct)), terms


def fit_logistic(
    x: np.ndarray,
    y: np.ndarray,
    ridge: float = RIDGE,
    rounds: int = 25,
    earlier: np.ndarray | None = None,
    rows: np.ndarray | None = None,
) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton's method; the last one is the constant.

    ``earlier`` holds further columns, ``rows`` marks the rows to fit (all without it).
    Beside ``x`` only a block of its rows is held, never a second matrix.
    """
    chosen = np.arange(len(x)) if rows is None else np.flatnonzero(rows)
    earlier = np.zeros((len(x), 0)) if earlier is None else earlier
    penalty = np.full(x.shape[1] + earlier.shape[1] + 1, ridge)
    penalty[-1] = 1e-6
    w = np.zeros(len(penalty))
    positive = y[chosen].sum()
    w[-1] = np.log((positive + 0.5) / (len(chosen) - positive + 0.5))
    for _ in range(rounds):
        gradient, curve = penalty * w, np.diag(penalty)
        for start in range(0, len(chosen), BLOCK_ROWS):
            at = chosen[start : start + BLOCK_ROWS]
            block = np.hstack([x[at], earlier[at], np.ones((len(at), 1))])
            p = 1 / (1 + np.exp(-np.clip(block @ w, -30, 30)))
            gradient += block.T @ (p - y[at])
            curve += (block * (p * (1 - p))[:, None]).T @ block
        step = np.linalg.solve(curve, gradient)
        size = np.abs(step).max()
        w -= step * min(1.0, 5.0 / max(size, 1e-12))
        if size < 1e-6:
            break
    return w


def _predict(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))


def matrix_of(texts: Sequence[str | None], terms: dict[bytes, int]) -> np.ndarray:
    """Shape figures and the share of each term among a text's words (log of 1 + per cent), a row per text.

    A share tells a text that keeps using a word from one that happens to hold it.
    """
    x = np.zeros((len(texts), 4 + len(terms)))
    starts = {n: {t[2:]: 4 + c for t, c in terms.items() if t.startswith(b"%d:" % n)} for n in STARTS}
    for i, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "replace")
        words = raw.translate(_FOLD).split()
        counts = Counter(words)
        x[i, :4] = shape(raw, words, len(counts))
        for word in counts.keys() & terms.keys():
            x[i, 4 + terms[word]] += counts[word]
        for n, known in starts.items():
            for word in [w for w in counts if w[:n] in known and len(w) > n]:
                x[i, known[word[:n]]] += counts[word]
        x[i, 4:] = np.log1p(x[i, 4:] * (100 / max(1, len(words))))
    return x


@dataclass
class Chain:
    """Categories in order with their weights over shape, terms and earlier probabilities, and cuts."""

    categories: list[str]
    terms: dict[bytes, int]
    weights: list[np.ndarray]
    cuts: list[float]

    def matrix(self, texts: Sequence[str | None]) -> np.ndarray:
        return matrix_of(texts, self.terms)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        found = np.zeros((len(x), 0))
        for w in self.weights:
            found = np.hstack([found, _predict(np.hstack([x, found]), w)[:, None]])
        return found


def fit_chain_arrays(x: np.ndarray, labels: np.ndarray, folds: np.ndarray) -> tuple[list[np.ndarray], list[float], np.ndarray]:
    """Weights and cuts per category, and the out-of-fold probabilities.

    ``labels`` holds a column per category in chain order, NaN where unknown.
    """
    earlier = np.zeros((len(x), 0))
    weights, cuts = [], []
    for c in range(labels.shape[1]):
        y, seen = np.nan_to_num(labels[:, c]), ~np.isnan(labels[:, c])

        def fitted(rows: np.ndarray) -> np.ndarray:
            if len(set(y[rows])) == 2:
                return fit_logistic(x, y, earlier=earlier, rows=rows)
            w = np.zeros(x.shape[1] + earlier.shape[1] + 1)
            w[-1] = 30.0 if rows.any() and y[rows].all() else -30.0
            return w

        held_out = np.zeros(len(x))
        for f in np.unique(folds):
            part = folds == f
            held_out[part] = _predict(np.hstack([x[part], earlier[part]]), fitted(seen & ~part))
        weights.append(fitted(seen))
        order = np.argsort(-held_out[seen], kind="stable")
        p, hit = held_out[seen][order], y[seen][order]
        right = np.cumsum(hit)
        if right.size and right[-1]:
            score = 2 * right / (np.arange(1, len(hit) + 1) + right[-1])
            best = int(np.argmax(np.where(np.append(p[:-1] > p[1:], True), score, -1)))
            cuts.append(float((p[best] + (p[best + 1] if best + 1 < len(p) else 0.0)) / 2))
        else:
            cuts.append(1.1)
        earlier = np.hstack([earlier, held_out[:, None]])
    return weights, cuts, earlier


def fit_chain(
    documents: DataFrame,
    labels: DataFrame,
    categories: Sequence[str],
    max_labelled: int = MAX_LABELLED,
    folds: int = FOLDS,
) -> Chain:
    """Fit the chain on at most ``max_labelled`` labelled documents, chosen by a hash of doc_id.

    Terms are counted per category by Spark over that sample; the ``TERMS`` that
    differ most (z of the two shares, at least ``MIN_Z``, in ``MIN_TEXTS`` texts or
    more) become columns. What reaches the driver is bounded by the sample size
    times the number of kept terms.
    """
    named = [F.col(c).cast("double").alias(f"_l{i}") for i, c in enumerate(categories)]
    chosen = labels.select("doc_id", *named).filter("doc_id is not null")
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id", *[f"_l{i}" for i in range(len(named))]).limit(max_labelled)
    parsed = "struct<shape:array<double>,terms:array<binary>>"

    @F.pandas_udf(parsed)
    def parse(texts: pd.Series) -> pd.DataFrame:
        rows = [terms_of(t) for t in texts]
        return pd.DataFrame({"shape": [r[0] for r in rows], "terms": [list(r[1]) for r in rows]})

    sample = documents.select("doc_id", "text").join(chosen, "doc_id")
    sample = sample.select("doc_id", "text", *[f"_l{i}" for i in range(len(named))], parse("text").alias("_t"))
    sample = settle(sample.withColumn("_row", F.monotonically_increasing_id()), "labelled")
    marks = [f"_l{i}" for i in range(len(named))]
    sizes = sample.agg(F.count("*"), *[f(m) for m in marks for f in (F.count, F.sum)]).first()
    terms = sample.select(*marks, F.explode("_t.terms").alias("term")).groupBy("term")
    terms = terms.agg(F.count("*").alias("n"), *[F.sum(m).alias(m) for m in marks], *[F.count(m).alias(f"n{m}") for m in marks])
    kept: dict[bytes, int] = {}
    for i, m in enumerate(marks):
        known, positive = float(sizes[1 + 2 * i] or 0), float(sizes[2 + 2 * i] or 0)
        if not 0 < positive < known:
            continue
        share = F.col(f"n{m}") / known
        spread = F.sqrt(share * (1 - share) * (1 / positive + 1 / (known - positive)))
        gap = F.col(m) / positive - (F.col(f"n{m}") - F.col(m)) / (known - positive)
        z = F.when(spread > 0, F.abs(gap) / spread).otherwise(0.0)
        best = terms.filter(F.col("n") >= MIN_TEXTS).select("term", z.alias("z")).filter(F.col("z") >= MIN_Z)
        for row in best.orderBy(F.desc("z"), "term").limit(TERMS).collect():
            kept.setdefault(bytes(row["term"]), len(kept))

    # Packed: as lists, every number would be an object in the driver.
    @F.pandas_udf("struct<columns:binary,values:binary>")
    def counted(texts: pd.Series) -> pd.DataFrame:
        rows = [matrix_of([t], kept)[0] for t in texts]
        columns = [np.flatnonzero(r).astype("<i4").tobytes() for r in rows]
        return pd.DataFrame({"columns": columns, "values": [r[r != 0].astype("<f8").tobytes() for r in rows]})

    picked = sample.select("doc_id", *marks, counted("text").alias("x"), F.xxhash64("doc_id", F.lit(7)).alias("fold"), "_row").collect()
    picked.sort(key=lambda r: (r["doc_id"], r["_row"]))
    x = np.zeros((len(picked), 4 + len(kept)))
    y = np.full((len(picked), len(marks)), np.nan)
    for i, r in enumerate(picked):
        x[i, np.frombuffer(r["x"]["columns"], "<i4")] = np.frombuffer(r["x"]["values"], "<f8")
        y[i] = [np.nan if r[m] is None else r[m] for m in marks]
    parts = np.array([r["fold"] % folds for r in picked], dtype=int)
    del picked
    weights, cuts, _ = fit_chain_arrays(x, y, parts)
    return Chain(list(categories), kept, weights, cuts)


def chain_scores(chain: Chain, text: Column) -> Column:
    """Struct of a probability per category, in chain order; the model is a fixed-size broadcast."""
    shared = chain
    fields = ",".join(f"p{i}:double" for i in range(len(chain.categories)))

    @F.pandas_udf(f"struct<{fields}>")
    def score(texts: pd.Series) -> pd.DataFrame:
        texts = list(texts)
        parts = [shared.probabilities(shared.matrix(texts[i : i + 512])) for i in range(0, len(texts), 512)]
        found = np.vstack(parts) if parts else np.zeros((0, len(shared.categories)))
        return pd.DataFrame({f"p{i}": found[:, i] for i in range(found.shape[1])})

    return score(text)


def with_scores(documents: DataFrame, chain: Chain) -> DataFrame:
    """All columns of the documents, ``_scores`` (probabilities) and ``_flags`` (booleans) by chain position."""
    scored = documents.withColumn("_scores", chain_scores(chain, F.col("text")))
    flags = F.array(*[F.col(f"_scores.p{i}") >= cut for i, cut in enumerate(chain.cuts)])
    return scored.withColumn("_flags", flags)


#: Columns of the label table in chain order: what is junk is rarely labelled toxic.
CATEGORIES = ("low_quality", "toxic")


def label_columns(labels: DataFrame) -> DataFrame:
    """The label table with a column per category of ``CATEGORIES``."""
    return labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")


def classify(documents: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, a probability per category, and whether it is toxic."""
    chain = fit_chain(documents, label_columns(labels), CATEGORIES, **options)
    scored = with_scores(documents.select("doc_id", "text"), chain)
    return scored.select(
        "doc_id",
        F.col("_scores.p0").alias("p_low_quality"),
        F.col("_scores.p1").alias("p_toxic"),
        F.col("_flags")[1].alias("toxic"),
    )
