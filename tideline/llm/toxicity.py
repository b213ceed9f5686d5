"""Toxic spans and document scores from a linear-chain CRF.

Only documents are labelled, so token labels are made from them first: in a bounded
sample, a word or word beginning (3 to 8 letters) that toxic documents hold far more
often than chance allows marks its tokens as toxic (a tail bound on the
binomial, corrected for the number of candidates). The CRF is trained on those token
labels, on a bounded number of windows of the sample; its features are the marking words and
beginnings. A document is one chain: forward-backward marginals over the whole text give
spans (runs of tokens more likely toxic than not) and, through a small logistic model on
their maximum, sum and count, the document score.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import extended, release, restored, set_aside, text_or_empty, without
from .crf import CAP, Chain, fit, forward_backward, windows
from .shingles import batches_by_bytes

TOKEN = re.compile(r"[^\W\d_]+")
PREFIXES = range(3, 9)
SAMPLE_TOXIC = 1000
SAMPLE_CLEAN = 2000
#: Text bytes of each class that the sample may hold; where they do not suffice, the longest documents are left out.
SAMPLE_BYTES = 8 << 20
#: Windows without a marking word that the chain is trained on, besides all with one.
PLAIN_WINDOWS = 2000
MAX_FEATURES = 4096
CHANCE = 0.01
PRECISION = 0.45
PREFIX_WORDS = 3
CACHE_TYPES = 300_000
THRESHOLD = 0.3
ADDED = ("toxicity_score", "toxic_spans", "toxic")
SPAN = "array<struct<start:int,end:int,probability:double>>"


def fold(text: str) -> str:
    """Lower case of the same length: offsets into it are offsets into the text."""
    return text.replace("\u0130", "i").lower()


def _tokens(folded: str) -> Iterable[str]:
    """The tokens in order; those of a long text one by one instead of in a list."""
    return TOKEN.findall(folded) if len(folded) < 1 << 20 else (m.group() for m in TOKEN.finditer(folded))


def feature_names(token: str) -> list[str]:
    """The whole word ("=word") and its proper beginnings ("word~")."""
    return ["=" + token, *[token[:k] + "~" for k in PREFIXES if k < len(token)]]


@dataclass
class ToxicityModel:
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -4.0
    chain: Chain = field(default_factory=Chain)
    calibration: tuple[float, ...] = (-2.0, 0.0, 0.0, 0.0)

    def emission_of(self, token: str) -> float:
        weights = self.weights
        return self.bias + sum(weights[f] for f in feature_names(token) if f in weights)


class _Emissions(dict):
    """Emission by token, computed on first sight."""

    def __init__(self, model: ToxicityModel):
        super().__init__()
        self.model = model

    def __missing__(self, token: str) -> float:
        value = self.model.emission_of(token)
        if len(self) >= CACHE_TYPES:
            self.clear()
        self[token] = value
        return value


def _summary(odds: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per document: constant, largest token log-odds, log of the summed squared marginals, share of toxic tokens."""
    n = len(counts)
    out = np.zeros((n, 4))
    out[:, 0] = 1
    full = np.flatnonzero(counts)
    out[:, 1] = -6.0
    if len(full):
        heads = (np.cumsum(counts) - counts)[full]
        p = 1 / (1 + np.exp(-np.clip(odds, -CAP, CAP)))
        out[full, 1] = np.clip(np.maximum.reduceat(odds, heads), -6, 6)
        out[full, 2] = np.log1p(np.add.reduceat(p * p, heads))
        out[full, 3] = np.add.reduceat((p > 0.5).astype(float), heads) / np.sqrt(counts[full])
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -CAP, CAP)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, ...]:
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = _sigmoid(x @ w)
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)) * np.r_[0.01, np.ones(len(w) - 1)]
        w += np.clip(np.linalg.solve(h, x.T @ (y - p) - ridge * w * np.r_[0.01, np.ones(len(w) - 1)]), -4, 4)
    return tuple(float(v) for v in w)


# ---------------------------------------------------------------- training


def _marking_features(doc_of: np.ndarray, type_of: np.ndarray, vocabulary: list[str], toxic: np.ndarray) -> list[str]:
    """Words and beginnings that toxic documents hold significantly more often than chance."""
    rate = np.clip(toxic.mean(), 1e-6, 1 - 1e-6)
    pairs = np.unique(doc_of.astype(np.int64) * len(vocabulary) + type_of)
    doc, kind = pairs // len(vocabulary), pairs % len(vocabulary)
    found: list[tuple[float, str]] = []
    for length in (0, *PREFIXES):
        names: dict[str, int] = {}
        ids = np.full(len(vocabulary), -1)
        for t, word in enumerate(vocabulary):
            if not length or len(word) > length:
                name = "=" + word if not length else word[:length] + "~"
                ids[t] = names.setdefault(name, len(names))
        use = ids[kind] >= 0
        if not names or not use.any():
            continue
        seen = np.unique(doc[use] * len(names) + ids[kind[use]])
        seen_doc, seen_id = seen // len(names), seen % len(names)
        all_docs = np.bincount(seen_id, minlength=len(names))
        bad_docs = np.bincount(seen_id, toxic[seen_doc], len(names))
        share = bad_docs / np.maximum(all_docs, 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            kl = np.nan_to_num(share * np.log(share / rate)) + np.nan_to_num((1 - share) * np.log((1 - share) / (1 - rate)))
        tested = max(1, int((all_docs >= 3).sum()))
        # A beginning that one or two words have says no more than those words.
        carried = np.bincount(ids[ids >= 0], minlength=len(names)) >= (PREFIX_WORDS if length else 1)
        fine = carried & (share > rate) & (share >= PRECISION) & (np.log(tested / CHANCE) < all_docs * kl)
        listed = list(names)
        found += [(float(all_docs[i] * kl[i]), listed[i]) for i in np.flatnonzero(fine)]
    return [name for _, name in sorted(found, key=lambda x: (-x[0], x[1]))[:MAX_FEATURES]]


def train(
    texts: list[str], toxic: np.ndarray, rate: float | None = None, plain_windows: int = PLAIN_WINDOWS
) -> ToxicityModel:
    """Model from whole texts and their 0/1 labels; one without evidence scores the base rate.

    The chain's weights are fitted on all windows with a marking word and about ``plain_windows`` others.

    ``rate`` is the share of toxic texts where the model will be used, if the sample's differs.
    """
    model = ToxicityModel()
    sampled = float(np.log((toxic.sum() + 0.5) / (len(toxic) - toxic.sum() + 0.5)))
    base = sampled if rate is None else float(np.log(np.clip(rate, 1e-6, 1 - 1e-6) / (1 - np.clip(rate, 1e-6, 1 - 1e-6))))
    model.calibration = (base, 0.0, 0.0, 0.0)
    known: dict[str, int] = {}
    tokens = [np.fromiter((known.setdefault(w, len(known)) for w in TOKEN.findall(fold(t))), np.int32) for t in texts]
    counts = np.array([len(t) for t in tokens], dtype=np.int64)
    if not known or not 0 < toxic.sum() < len(toxic):
        return model
    types, vocabulary = np.concatenate(tokens), list(known)
    del known, tokens
    doc_of = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
    marks = _marking_features(doc_of, types, vocabulary, toxic)
    if not marks:
        return model
    index = {name: i for i, name in enumerate(marks)}
    pairs = np.array([(t, index[f]) for t, w in enumerate(vocabulary) for f in feature_names(w) if f in index], dtype=np.int64)
    owner, flat = pairs[:, 0], pairs[:, 1]
    n_types = len(vocabulary)
    del vocabulary
    marked = np.zeros(n_types, bool)
    marked[owner] = True
    is_marked = marked[types]
    starts, lengths, doc = windows(counts)
    hot = np.add.reduceat(is_marked, starts) > 0
    plain = np.flatnonzero(~hot)
    hot[plain[:: max(1, len(plain) // plain_windows)]] = True
    use = np.repeat(hot, lengths)
    labels = (is_marked & (toxic[doc_of] > 0)).astype(float)
    some = lengths[hot]
    theta, model.chain = fit(types[use], labels[use], np.cumsum(some) - some, some, owner, flat, n_types, len(marks))
    model.weights, model.bias = dict(zip(marks, theta[:-1].tolist())), float(theta[-1])
    per_type = np.bincount(owner, theta[flat], n_types) + theta[-1]
    odds, _, _ = forward_backward(per_type[types], starts, lengths, model.chain, doc)
    fitted = _logistic(_summary(odds, counts), toxic)
    model.calibration = (fitted[0] + base - sampled, *fitted[1:])
    return model


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    train_rows: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_toxic: int = SAMPLE_TOXIC,
    sample_clean: int = SAMPLE_CLEAN,
    sample_bytes: int = SAMPLE_BYTES,
    plain_windows: int = PLAIN_WINDOWS,
) -> ToxicityModel:
    """Fit on at most ``sample_toxic`` + ``sample_clean`` labelled rows, those of smallest hashed ids.

    Each class has at most ``sample_bytes`` of text: its documents by ascending length, as
    far as they fit. Rows without a 0/1 label or a document do not count; of repeated labels each counts.
    """
    usable = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    usable = usable.filter(train_rows) if train_rows is not None else usable
    usable = usable.select(F.col(id_col).alias("__tl_id"), F.col(label_col).cast("int").alias("y"))
    draw = [
        usable.filter(F.col("y") == y).orderBy(F.xxhash64("__tl_id"), "__tl_id").limit(n)
        for y, n in ((1, sample_toxic), (0, sample_clean))
    ]
    chosen = F.broadcast(draw[0].unionAll(draw[1]))  # bounded by the two sample sizes
    rate = usable.agg(F.avg("y")).first()[0]
    slim = docs.select(F.col(id_col).alias("__tl_doc"), text_or_empty(text_col).alias("text"))
    rows = (
        slim.join(chosen, F.col("__tl_doc") == F.col("__tl_id"))
        .select("y", "__tl_id", "text")
        .withColumn("size", F.octet_length("text").cast("long"))
    )
    shorter = Window.partitionBy("y").orderBy("size", F.xxhash64("__tl_id"), "__tl_id").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("total", F.sum("size").over(shorter)).filter(F.col("total") <= sample_bytes).drop("size", "total")
    table = rows.toArrow().sort_by([("__tl_id", "ascending"), ("text", "ascending")])
    return train(table.column("text").to_pylist(), table.column("y").to_numpy().astype(np.float64), rate, plain_windows)


# ---------------------------------------------------------------- scoring


def _spans(text: str, odds: np.ndarray) -> list[dict]:
    """Runs of toxic tokens as character offsets into the text."""
    out: list[dict] = []
    open_run = False
    for k, match in enumerate(TOKEN.finditer(fold(text))):
        if odds[k] > 0:
            p = float(_sigmoid(odds[k]))
            if open_run:
                out[-1]["end"], out[-1]["probability"] = match.end(), max(p, out[-1]["probability"])
            else:
                out.append({"start": match.start(), "end": match.end(), "probability": p})
        open_run = bool(odds[k] > 0)
    return out


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """All rows and columns plus ``toxicity_score`` (0 to 1), ``toxic_spans`` and ``toxic``.

    Spans are character offsets into the text. Null texts score
    like empty ones: the base rate of texts without toxic tokens. Input columns of
    these names are replaced.
    """
    slim = without(docs, *ADDED)
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())]))

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        emissions = _Emissions(model)
        look = emissions.__getitem__
        for batch in batches:
            for part in batches_by_bytes(batch, text_col):
                texts = [t or "" for t in part.column(text_col).to_pylist()]
                found = [np.fromiter(map(look, _tokens(fold(t))), np.float64) for t in texts]
                counts = np.array([len(f) for f in found], dtype=np.int64)
                emission = np.concatenate([*found, np.zeros(0)])
                starts, lengths, doc = windows(counts)
                odds, _, _ = forward_backward(emission, starts, lengths, model.chain, doc)
                scores = _sigmoid(_summary(odds, counts) @ np.array(model.calibration))
                ends = np.cumsum(counts)
                hot = np.zeros(len(texts), bool)
                hot[np.searchsorted(ends, np.flatnonzero(odds > 0), side="right")] = True
                spans = [
                    _spans(t, odds[e - c : e]) if h else []
                    for t, e, c, h in zip(texts, ends.tolist(), counts.tolist(), hot.tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(scores), pa.array(spans, span_type)],
                    [*part.schema.names, "toxicity_score", "toxic_spans"],
                )

    schema = extended(slim, toxicity_score="double", toxic_spans=SPAN)
    scored = slim.mapInArrow(stage, schema)
    return scored.withColumn("toxic", F.col("toxicity_score") >= threshold)


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows that :func:`score_toxicity` does not call toxic, with the columns of ``docs`` only (clashing names survive too)."""
    inner, new = set_aside(docs, *ADDED)
    return restored(score_toxicity(inner, model, new[text_col], threshold).filter(~F.col("toxic")), new)
