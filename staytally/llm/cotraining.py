"""Operator 5: a quality classifier of two views that teach each other.

The text view sees which words a document holds (hashed to ``WORD_BINS``), the page view its
source, language and layout: size, lines, and shares of letters, capitals, digits and signs. Each
view is a logistic regression. From a bounded sample of labelled documents both start; each
round, each names the documents of an unlabelled pool it is surest of, and the other learns
them. A labelled part kept aside calibrates both views, and the mean of their calibrated log odds
scores every document.

Training takes at most ``LABELLED`` labelled documents and a pool of ``POOL``, those with the least
hash of their id. Scoring covers all documents whole, in one pass without a shuffle.

A document is good if its label says quality 1, and toxic if its label says toxic 1; two classifiers
of the same sample judge the two, and a document stays if it is good and not toxic. Toxic documents
are few and some words give them away, so that classifier's text view scales each word by how
unevenly the two kinds hold it, its views are sure of a clean document only clearly below the base
rate, and their log odds add up over the base rate instead of being averaged.

Nulls: a null text has no words and an empty layout, a null source or language is a value of its
own, labels with a null id are left out, a null quality or toxic label judges the other thing only.
Repeated labels count once, a bad or toxic one first. Without labelled documents of both kinds the
probabilities are null and reject nothing; the labels may lack the toxic column.
Repeated rows are scored each, empty tables give empty results.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from staytally.llm import words as W

LABELLED, POOL = 6000, 6000
ROUNDS, PER_ROUND = 4, 0.05
RARE_STEPS = 200
WORD_BINS, NAME_BINS = 1 << 18, 512
_ASIDE = 0.25
_CLASSES = (
    ("capital", lambda b: 0x41 <= b <= 0x5A),
    ("small", lambda b: 0x61 <= b <= 0x7A),
    ("digit", lambda b: 0x30 <= b <= 0x39),
    ("wide", lambda b: b >= 0x80),
    ("line", lambda b: b == 0x0A),
    ("stop", lambda b: b in b".,;:?'-\""),
    ("sign", lambda b: 0x21 <= b < 0x80 and not chr(b).isalnum() and b not in b".,;:?'-\""),
)
_KIND = np.array(
    [next((k for k, (_, of) in enumerate(_CLASSES) if of(b)), len(_CLASSES)) for b in range(256)],
    np.uint8,
)
_SLICE = 1 << 20
LAYOUT = len(_CLASSES) + 3


def _name_bin(kind: str, names: list) -> np.ndarray:
    texts = pa.array([f"{kind}={n}" for n in names], pa.string())
    found = W.scan(texts, np.ones(256, bool), False)
    return (found.hashes() % np.uint64(NAME_BINS)).astype(np.int64)


def features(texts: pa.Array, sources: list, langs: list):
    """(bins of distinct words, where each text's begin), and (name bins, layout) of each text."""
    found = W.scan(texts, W.ALNUM, True)
    bins = (found.hashes() % np.uint64(WORD_BINS)).astype(np.int64)
    key = np.sort(found.text_of() * WORD_BINS + bins)
    key = key[np.r_[True, key[1:] != key[:-1]]] if len(key) else key
    first = np.searchsorted(key, np.arange(len(texts) + 1) * WORD_BINS)
    names = np.stack([_name_bin("source", sources), _name_bin("lang", langs)], 1)

    plain = W.scan(texts, np.ones(256, bool), False)  # one run of bytes a text that is not empty
    layout = np.zeros((len(texts), LAYOUT))
    full = np.flatnonzero(plain.counts())
    if len(full):
        kinds = _KIND[plain.data]
        size = (plain.ends - plain.starts).astype(float)
        for k in range(len(_CLASSES)):
            layout[full, k] = np.add.reduceat(kinds == k, plain.starts, dtype=np.int64) / size
        n_words = np.maximum(found.counts()[full], 1)
        layout[full, -3] = np.log1p(size) / 10
        layout[full, -2] = np.log1p(size / n_words) / 3
        layout[full, -1] = np.sqrt(np.diff(first)[full] / n_words)
    return key % WORD_BINS, first, names, layout


@dataclass
class TextView:
    weight: np.ndarray

    def odds(self, bins, first) -> np.ndarray:
        sums = np.add.reduceat(np.r_[self.weight[bins], 0.0], first[:-1]) if len(first) > 1 else np.zeros(0)
        n = np.diff(first)
        return np.where(n > 0, sums / np.sqrt(np.maximum(n, 1)), 0.0) + self.weight[-1]


@dataclass
class PageView:
    weight: np.ndarray  # names, layout, layout squared, constant

    def odds(self, names, layout) -> np.ndarray:
        return self.weight[names].sum(1) + _dense(layout) @ self.weight[NAME_BINS:]


def _dense(layout: np.ndarray) -> np.ndarray:
    return np.concatenate([layout, np.sqrt(layout), np.ones((len(layout), 1))], 1)


def _probability(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds, -35, 35)))


def _ascend(size: int, gradient, steps: int, decay: float) -> np.ndarray:
    """Full-batch Adagrad with L2 decay."""
    weight, seen = np.zeros(size), np.full(size, 1e-8)
    for _ in range(steps):
        slope = gradient(weight) + decay * weight
        seen += slope * slope
        weight -= 0.5 * slope / np.sqrt(seen)
    return weight


def _unevenness(own, row, labels, size: int) -> np.ndarray:
    """By how much the log of the share of documents with a word differs between the two kinds."""
    shares = [
        (np.bincount(own[labels[row] == kind], minlength=size) + 1) / ((labels == kind).sum() + 2)
        for kind in (0, 1)
    ]
    return np.abs(np.log(shares[1] / shares[0]))


def _fit_text(bins, first, rows, labels, rare: bool = False) -> TextView:
    n = np.diff(first)[rows]
    value = 1 / np.sqrt(np.maximum(n, 1))
    at = np.repeat(first[rows] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    used, own = np.unique(bins[at], return_inverse=True)
    row = np.repeat(np.arange(len(rows)), n)
    own_value = value[row]
    scale = _unevenness(own, row, labels, len(used)) if rare else np.ones(len(used))
    own_value = own_value * scale[own]

    def gradient(weight):
        odds = np.bincount(row, weight[own] * own_value, len(rows)) + weight[-1]
        miss = (_probability(odds) - labels) / len(rows)
        out = np.bincount(own, miss[row] * own_value, len(used) + 1)
        out[-1] = miss.sum()
        return out

    found = _ascend(len(used) + 1, gradient, RARE_STEPS if rare else 60, 1e-6)
    weight = np.zeros(WORD_BINS + 1)
    weight[used], weight[-1] = found[:-1] * scale, found[-1]
    return TextView(weight)


def _fit_page(names, layout, rows, labels) -> PageView:
    names, dense = names[rows], _dense(layout[rows])

    def gradient(weight):
        odds = weight[names].sum(1) + dense @ weight[NAME_BINS:]
        miss = (_probability(odds) - labels) / len(rows)
        sums = sum(np.bincount(names[:, j], miss, NAME_BINS) for j in range(names.shape[1]))
        return np.r_[sums, dense.T @ miss]

    return PageView(_ascend(NAME_BINS + dense.shape[1], gradient, 400, 1e-5))


def _calibrate(odds: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Platt's slope and shift."""
    x = np.stack([odds / 4, np.ones(len(odds))], 1)
    # Targets drawn in a little, so that a part that separates perfectly stays finite.
    target = np.where(labels > 0, 1 - 1 / (labels.sum() + 2), 1 / ((1 - labels).sum() + 2))
    weight = _ascend(2, lambda w: x.T @ (_probability(x @ w) - target) / len(x), 400, 1e-4)
    return float(weight[0] / 4), float(weight[1])


@dataclass
class Classifier:
    text: TextView
    page: PageView
    text_scale: tuple[float, float]
    page_scale: tuple[float, float]
    base: float | None = None

    def score(self, bins, first, names, layout):
        a = self.text.odds(bins, first) * self.text_scale[0] + self.text_scale[1]
        b = self.page.odds(names, layout) * self.page_scale[0] + self.page_scale[1]
        both = (a + b) / 2 if self.base is None else a + b - self.base
        return _probability(a), _probability(b), _probability(both)


@dataclass
class Judges:
    """What tells good documents from bad ones, and what tells toxic ones from others."""

    good: Classifier | None
    toxic: Classifier | None

    def score(self, bins, first, names, layout) -> list:
        """Probabilities of the text view, of the page view and of both, and that of being toxic."""
        given = bins, first, names, layout
        good = self.good.score(*given) if self.good else [None] * 3
        return [*good, self.toxic.score(*given)[2] if self.toxic else None]


def cotrain(
    bins, first, names, layout, labels: np.ndarray, rounds: int = ROUNDS, rare: bool = False
) -> Classifier:
    """``labels`` has 0, 1, or -1 for the pool. ``rare`` is for a kind 1 of few documents that some
    words give away."""
    known, pool = np.flatnonzero(labels >= 0), np.flatnonzero(labels < 0)
    aside = np.zeros(len(known), bool)
    for label in (0, 1):  # every so many of each kind
        own = np.flatnonzero(labels[known] == label)
        aside[own[:: int(1 / _ASIDE)]] = len(own) > 1 / _ASIDE
    held, start = known[aside], known[~aside]
    taught = {"text": (start, labels[start]), "page": (start, labels[start])}
    share = float(labels[start].mean())
    base = float(np.log(share / (1 - share))) if rare and 0 < share < 1 else 0.0
    for turn in range(rounds + 1):
        text = _fit_text(bins, first, *taught["text"], rare)
        page = _fit_page(names, layout, *taught["page"])
        if turn == rounds or not len(pool):
            break
        pick = max(2, int(PER_ROUND * len(pool)))
        for view, odds in (
            ("page", text.odds(bins, first)[pool]),
            ("text", page.odds(names, layout)[pool]),
        ):
            order = np.argsort(odds, kind="stable")
            good, bad = max(1, int(pick * share)), max(1, int(pick * (1 - share)))
            chosen = np.r_[order[-good:], order[:bad]]
            sure = (odds[chosen] > 2) | (odds[chosen] < min(base, 0.0) - 2)
            rows, told = pool[chosen[sure]], (odds[chosen[sure]] > 0).astype(float)
            old, old_labels = taught[view]
            new = ~np.isin(rows, old)
            taught[view] = (np.r_[old, rows[new]], np.r_[old_labels, told[new]])
    if not len(held):
        held = start
    return Classifier(
        text,
        page,
        _calibrate(text.odds(bins, first)[held], labels[held]),
        _calibrate(page.odds(names, layout)[held], labels[held]),
        base if rare else None,
    )


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.slices(batches, "text", _SLICE):
        names = [batch.column(k).to_pylist() for k in ("source", "lang")]
        bins, first, named, layout = features(batch.column("text"), *names)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("label"),
                batch.column("toxic"),
                pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(bins, pa.int32())),
                pa.array(named.tolist(), pa.list_(pa.int32())),
                pa.array(layout.tolist(), pa.list_(pa.float64())),
            ],
            names=["label", "toxic", "bins", "names", "layout"],
        )


def _fitted(rows: pa.Table, rounds: int) -> Judges | None:
    """The judges that the extracted sample teaches, whatever order its rows came in."""
    told = [rows.column(name).to_numpy().astype(float) for name in ("label", "toxic")]
    judged = [not {0.0, 1.0} - set(one.tolist()) for one in told]
    if not any(judged):
        return None
    column = rows.column("bins").combine_chunks()
    first = np.r_[0, np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))].astype(np.int64)
    bins = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    names = np.array(rows.column("names").to_pylist(), np.int64)
    layout = np.array(rows.column("layout").to_pylist(), float)
    order = np.lexsort((*layout.T, *told[::-1]))  # the same training whatever order the rows came in
    n = np.diff(first)[order]
    at = np.repeat(first[:-1][order] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    given = bins[at], np.r_[0, np.cumsum(n)], names[order], layout[order]
    return Judges(
        *[
            cotrain(*given, one[order], rounds, rare) if of_both else None
            for one, of_both, rare in zip(told, judged, (False, True), strict=True)
        ]
    )


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id: str = "doc_id",
    labelled: int = LABELLED,
    pool: int = POOL,
    rounds: int = ROUNDS,
) -> Judges | None:
    """None if the labelled documents are of both kinds neither in quality nor in toxicity."""
    toxic = F.col("toxic") if "toxic" in labels.columns else F.lit(None).cast("int")
    told = labels.select(
        F.col(id).alias("doc_id"),
        (F.col("quality") == 1).cast("int").alias("good"),
        (toxic == 1).cast("int").alias("toxic"),
    )
    told = told.where("doc_id IS NOT NULL AND (good IS NOT NULL OR toxic IS NOT NULL)")
    told = told.groupBy("doc_id").agg(
        F.coalesce(F.min("good"), F.lit(-1)).alias("label"),
        F.coalesce(F.max("toxic"), F.lit(-1)).alias("toxic"),
    )
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    view = docs.select(
        F.col(id).alias("doc_id"),
        "text",
        *[
            (F.col(c).cast("string") if c in docs.columns else F.lit(None).cast("string")).alias(c)
            for c in ("source", "lang")
        ],
    )
    ids = view.select("doc_id").where("doc_id is not null")
    some = told.join(ids.distinct(), "doc_id").orderBy(*by_hash).limit(labelled)
    rest = ids.distinct().join(told, "doc_id", "left_anti").orderBy(*by_hash).limit(pool)
    rest = rest.withColumns({"label": F.lit(-1), "toxic": F.lit(-1)})
    wanted = some.unionByName(rest)  # bounded by the two parameters
    met = view.join(F.broadcast(wanted), "doc_id")
    # Of a repeated id one row is enough, whichever text comes first; so the driver's rows are bounded.
    one = met.groupBy("doc_id").agg(F.min(F.xxhash64("text", "source", "lang")).alias("_one"))
    sample = (
        met.join(F.broadcast(one), "doc_id")
        .where(F.xxhash64("text", "source", "lang") == F.col("_one"))
        .dropDuplicates(["doc_id"])
        .mapInArrow(_extracted, "label int, toxic int, bins array<int>, names array<int>, layout array<double>")
    )
    # The bounded sample is learnt in one task, so the driver holds the weights and nothing else.
    fit = lambda rows: pa.table({"judges": [pickle.dumps(_fitted(rows.combine_chunks(), rounds))]})
    found = sample.groupBy(F.lit("all")).applyInArrow(fit, "judges binary").collect()
    return pickle.loads(found[0].judges) if found else None


def score(docs: DataFrame, judges: Judges | None, *, prefix: str = "") -> DataFrame:
    """The documents with ``p_text``, ``p_page``, ``p_good`` and ``p_toxic``, whose names begin with
    ``prefix``; columns of the documents that have these names are refused."""
    names = [prefix + name for name in ("p_text", "p_page", "p_good", "p_toxic")]
    if clash := set(names) & set(docs.columns):
        raise ValueError(f"columns {sorted(clash)} are reserved here")
    if judges is None:
        return docs.withColumns({n: F.lit(None).cast("double") for n in names})
    held = docs.sparkSession.sparkContext.broadcast(judges)
    schema = StructType([StructField(f.name, f.dataType) for f in docs.schema])
    for n in names:
        schema = schema.add(n, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches, "text", _SLICE):
            n = batch.num_rows
            named = [
                batch.column(k).cast(pa.string()).to_pylist() if k in batch.schema.names else [None] * n
                for k in ("source", "lang")
            ]
            found = held.value.score(*features(batch.column("text"), *named))
            found = [pa.nulls(n, pa.float64()) if p is None else pa.array(p) for p in found]
            columns = [*batch.columns, *found]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *names])

    return docs.mapInArrow(run, schema)


def kept(*, prefix: str = "") -> Column:
    """Whether a scored document stays."""
    good, toxic = F.col(f"{prefix}p_good") >= 0.5, F.col(f"{prefix}p_toxic") >= 0.5
    return F.coalesce(good, F.lit(True)) & ~F.coalesce(toxic, F.lit(False))
