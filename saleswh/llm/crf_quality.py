"""Document quality by a linear-chain conditional random field over lines.

Every line is labelled good or bad. A line's features describe its characters and words and those of
the lines before and after it; transitions tie the labels of neighbouring lines. The forward-backward
pass gives each line's chance of being good given the whole document, and the document's score is their
mean weighted by line length.

Labels are per document, so in training each line carries its document's label. The fit is penalised
maximum likelihood on a bounded sample of labelled documents; scoring runs over all documents in
Arrow batches.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswh.llm.registry import query, table

#: The fit uses at most so many labelled documents, of at most so many lines.
SAMPLE_DOCS = 4000
SAMPLE_LINES = 200
THRESHOLD = 0.3
FOLDS = 5
CHUNK = 1 << 20

_UPPER, _LOWER, _DIGIT, _SPACE, _POINT, _MARK, _SYMBOL, _OTHER = range(8)
_CLASSES = 8
_KNOWN = 0x3000


def _class_of(code: int) -> int:
    c = chr(code)
    if c.isspace():
        return _SPACE
    if c in ".,;:'\"()-":
        return _POINT
    if c in "!?":
        return _MARK
    kind = unicodedata.category(c)
    if kind[0] == "L":
        return _UPPER if kind in ("Lu", "Lt") else _LOWER
    if kind[0] == "N":
        return _DIGIT
    return _SYMBOL if kind[0] in "SP" else _OTHER


class Model(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    trans: np.ndarray


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features and length of every line of all texts, and the number of lines of each text (1 at least)."""
    classes = np.array([_class_of(c) for c in range(_KNOWN)], np.uint8)
    lines = [t.split("\n") for t in texts]
    n_lines = np.array([len(x) for x in lines])
    codes = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = classes[np.minimum(codes, _KNOWN - 1)]
    lengths = np.array([len(x) for doc in lines for x in doc], np.int64)
    owner = np.repeat(np.arange(len(lengths)), lengths + 1)[: len(codes)]
    counts = np.bincount(owner * _CLASSES + kinds, minlength=len(lengths) * _CLASSES).reshape(-1, _CLASSES)
    words = np.zeros((len(lengths), 4))
    k = 0
    for doc in lines:
        seen: set[str] = set()
        for line in doc:
            w = line.split()
            words[k] = (len(w), len(set(w)), line in seen, line[-1:] in ".!?:")
            seen.add(line)
            k += 1
    size = np.maximum(lengths, 1)
    letters = counts[:, _UPPER] + counts[:, _LOWER]
    shares = counts[:, [_LOWER, _DIGIT, _SPACE, _POINT, _MARK, _SYMBOL, _OTHER]] / size[:, None]
    n_words = np.maximum(words[:, 0], 1)
    own = np.column_stack([
        shares, counts[:, _UPPER] / np.maximum(letters, 1), np.log1p(lengths), np.log1p(words[:, 0]),
        words[:, 1] / n_words, letters / n_words / 10, words[:, 2], words[:, 3], lengths == 0,
    ])
    # squares let both too little and too much speak against a line
    own = np.column_stack([own, own[:, :12] ** 2])
    first = np.zeros(len(lengths), bool)
    last = first.copy()
    ends = np.cumsum(n_lines)
    first[ends - n_lines] = True
    last[ends - 1] = True
    near = own[:, :12]
    before, after = np.roll(near, 1, axis=0), np.roll(near, -1, axis=0)
    before[first], after[last] = 0, 0
    return np.column_stack([own, before, after, first, last]), lengths, n_lines


def _padded(values: np.ndarray, n_lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """values per line as (documents, most lines), and which cells are lines."""
    mask = np.arange(n_lines.max()) < n_lines[:, None]
    out = np.zeros(mask.shape)
    out[mask] = values
    return out, mask


def forward_backward(score: np.ndarray, mask: np.ndarray, trans: np.ndarray):
    """Chance of good per line, expected transitions (2, 2), and log partition per document.

    score: log odds of good from the line alone; trans[i, j]: score of label j behind label i.
    """
    docs, steps = score.shape
    local = np.stack([np.zeros_like(score), score], axis=2)
    ahead = np.zeros((docs, steps, 2))
    back = np.zeros((docs, steps, 2))
    ahead[:, 0] = local[:, 0]
    for t in range(1, steps):
        step = np.logaddexp(ahead[:, t - 1, :1] + trans[0], ahead[:, t - 1, 1:] + trans[1]) + local[:, t]
        ahead[:, t] = np.where(mask[:, t, None], step, ahead[:, t - 1])
    for t in range(steps - 2, -1, -1):
        nxt = local[:, t + 1] + back[:, t + 1]
        step = np.logaddexp(trans[:, 0] + nxt[:, :1], trans[:, 1] + nxt[:, 1:])
        back[:, t] = np.where(mask[:, t + 1, None], step, 0)
    total = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
    good = np.exp(ahead[:, :, 1] + back[:, :, 1] - total[:, None])
    pairs = np.zeros((2, 2))
    both = mask[:, 1:]
    for i in range(2):
        for j in range(2):
            p = ahead[:, :-1, i] + trans[i, j] + local[:, 1:, j] + back[:, 1:, j] - total[:, None]
            pairs[i, j] = np.exp(p[both]).sum()
    return good, pairs, total


def fit(features: np.ndarray, n_lines: np.ndarray, labels: np.ndarray, rounds: int = 250, penalty: float = 0.5) -> Model:
    """Penalised maximum likelihood by Adam; lines carry their document's label, classes weigh the same."""
    mean, scale = features.mean(axis=0), features.std(axis=0) + 1e-6
    x = np.clip((features - mean) / scale, -5, 5)
    x = np.column_stack([x, np.ones(len(x))])
    line_label = np.repeat(labels, n_lines).astype(float)
    share = labels.mean()
    doc_weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    # every document weighs the same, however many lines it has
    line_weight = np.repeat(doc_weight / np.sqrt(n_lines), n_lines)
    weights, trans = np.zeros(x.shape[1]), np.zeros((2, 2))
    state = [np.zeros(x.shape[1] + 4), np.zeros(x.shape[1] + 4)]
    order = np.argsort(n_lines, kind="stable")
    starts = np.cumsum(n_lines) - n_lines
    groups = [g for g in np.array_split(order, max(1, len(order) // 400)) if len(g)]
    rows = [np.concatenate([np.arange(starts[d], starts[d] + n_lines[d]) for d in g]) for g in groups]
    for k in range(1, rounds + 1):
        grad_w, grad_t = penalty * weights, penalty * trans
        for g, r in zip(groups, rows):
            score, mask = _padded(x[r] @ weights, n_lines[g])
            good, pairs, _ = forward_backward(score, mask, trans)
            grad_w -= x[r].T @ (line_weight[r] * (line_label[r] - good[mask]))
            moves = n_lines[g] - 1
            seen = np.diag([moves[labels[g] == 0].sum(), moves[labels[g] == 1].sum()]).astype(float)
            grad_t -= (seen - pairs) / max(1.0, np.sqrt(n_lines[g].mean()))
        grad = np.concatenate([grad_w, grad_t.ravel()]) / len(labels)
        state[0] = 0.9 * state[0] + 0.1 * grad
        state[1] = 0.99 * state[1] + 0.01 * grad * grad
        step = 0.1 * (state[0] / (1 - 0.9**k)) / (np.sqrt(state[1] / (1 - 0.99**k)) + 1e-8)
        weights = weights - step[:-4]
        # labels of a document agree, so agreement alone would grow without end
        trans = np.clip(trans - step[-4:].reshape(2, 2), -2, 2)
    return Model(mean, scale, weights, trans)


def score_texts(texts: list[str], model: Model) -> np.ndarray:
    """Length-weighted mean chance of good for each text."""
    x, lengths, n_lines = line_features(texts)
    x = np.clip((x - model.mean) / model.scale, -5, 5)
    local = x @ model.weights[:-1] + model.weights[-1]
    out = np.zeros(len(texts))
    starts = np.cumsum(n_lines) - n_lines
    order = np.argsort(n_lines, kind="stable")
    for g in np.array_split(order, max(1, len(order) // 200)):
        if not len(g):
            continue
        rows = np.concatenate([np.arange(starts[d], starts[d] + n_lines[d]) for d in g])
        score, mask = _padded(local[rows], n_lines[g])
        good, _, _ = forward_backward(score, mask, model.trans)
        weight, _ = _padded(lengths[rows] + 1.0, n_lines[g])
        out[g] = (good * weight).sum(axis=1) / weight.sum(axis=1)
    return np.clip(out, 0, 1)


def _chunks(texts: list[str | None]) -> Iterator[list[str]]:
    held, size = [], 0
    for t in texts:
        held.append(t or "")
        size += len(held[-1])
        if size > CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held


def _scored(batches: Iterator[pa.RecordBatch], model: Model | float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        if isinstance(model, float):
            scores = np.full(len(texts), model)
        else:
            scores = np.concatenate([score_texts(c, model) for c in _chunks(texts)] or [np.zeros(0)])
        kept = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(scores)], [*kept, "score"])


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [line_features([t or ""]) for t in batch.column("text").to_pylist()]
        found = [(f, q) for (f, _, n), q in zip(found, batch.column("quality").to_pylist()) if n[0] <= SAMPLE_LINES]
        yield pa.RecordBatch.from_arrays(
            [pa.array([f.tobytes() for f, _ in found], pa.binary()), pa.array([q for _, q in found], pa.int32())],
            ["features", "quality"],
        )


def fold(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % FOLDS


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model | float:
    """A model from at most sample_docs labelled documents outside the held-out fold.

    The sample is the labels with the smallest hashes of their keys. Without labels of both kinds the result is a constant:
    the share of good labels, or 0.5 without any.
    """
    chosen = (
        labels.select(F.col("doc_id").alias("labelled"), F.col("quality").cast("int").alias("quality"))
        .filter(F.col("quality").isin(0, 1) & F.col("labelled").isNotNull() & (fold(F.col("labelled")) != 0))
        .orderBy(F.xxhash64("labelled"), "quality")
        .limit(sample_docs)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
    # bounded by sample_docs documents of SAMPLE_LINES lines; sorted, so that a rerun fits the same model
    found = sorted(rows.select("text", "quality").mapInArrow(_examples, "features binary, quality int").collect())
    quality = np.array([r.quality for r in found])
    if len(found) == 0 or quality.min() == quality.max():
        return float(quality.mean()) if len(found) else 0.5
    width = line_features([""])[0].shape[1]
    blocks = [np.frombuffer(r.features).reshape(-1, width) for r in found]
    return fit(np.concatenate(blocks), np.array([len(b) for b in blocks]), quality)


def quality_scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, held_out, score, predicted.

    A null text counts as empty; an empty text is one empty line. Labels (doc_id, quality) serve the fit only; language,
    source and key never enter a score. The fit takes at most SAMPLE_DOCS labelled documents of at most SAMPLE_LINES lines; longer
    ones are scored like all others. Labels that are null or name no document are ignored; rows that
    repeat count again. Other columns are not read. No rows give no rows.
    """
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    model = train(rows, labels)
    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(partial(_scored, model=model), f"doc_id {kind}, score double")
    return scored.select(
        "doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs, all columns as they are, whose score reaches THRESHOLD."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text}`").alias("text"))
    model = train(docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text")), labels)
    kind = rows.schema["row"].dataType.simpleString()
    scored = rows.mapInArrow(partial(_scored, model=model), f"row {kind}, score double")
    return scored.filter(F.col("score") >= THRESHOLD).select("row.*")


@query()
def op1_crf_quality(spark, sf_dir):
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
