"""Quality classifier: ordinal (cumulative-link) regression of graded ratings on hashed text features.

A text has one score, the sum of the weights of its distinct features; ordered thresholds cut the score into grades:
P(grade <= k) = logistic(threshold_k - score).  The weights are shared by all grades.  From them come the expected
grade and the tail probability P(grade >= k) by which documents are selected.

Features are hashes of words, of the first four and five bytes of words, of their last two, and of how often a text repeats its
words.  The model is fitted on ``SAMPLE`` rated documents at most, those of the least hashes of their ids; every document
is scored, on its whole text.

A document's grade is its lowest rating; ratings without grade or id do not count.  Null and blank texts have no feature and
score 0.  If the ratings have fewer than two grades nothing can be learned: scores are null and all documents stay.
Columns of ``docs`` named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches, lean, mix, span_hashes, text_buffer, words

SAMPLE, BITS, REPEATS, HEADS = 6000, 18, 16, (4, 5)
WIDTH = (1 << BITS) + REPEATS
BATCH = 1 << 20  # bytes whose features are in memory at once, if no text is longer
GRADES, SELECT, TAIL, EVIDENCE = 3, 2, 0.8, 35.0


def grade(quality: Column, toxic: Column) -> Column:
    """0: poor, 1: well written but toxic, 2: clean."""
    return F.when(quality == 0, 0).when(toxic == 1, 1).when(quality == 1, 2)


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text numbers, features), each pair once, by text."""
    data, at = text_buffer(column)
    n, mask = len(at) - 1, np.uint64((1 << BITS) - 1)
    found, whole, count = [np.empty(0, np.int64)], [np.empty(0, np.int64)], np.zeros(n, np.int64)
    for h, text, start, end, sums in words(data, at):
        heads = [span_hashes(sums, start, np.minimum(start + k, end)) for k in HEADS]
        tail = span_hashes(sums, np.maximum(end - 2, start), end)
        key = text.astype(np.int64) << (BITS + 1)
        for salt, values in enumerate((tail, *heads, h)):
            f = (mix(values + np.uint64(salt)) & mask).astype(np.int64)
            found.append(np.unique(key | f))
        count += np.bincount(text, minlength=n)
        whole.append(found[-1])
    # a text may go on in the next stretch: its words are counted once
    distinct = np.bincount(np.unique(np.concatenate(whole)) >> (BITS + 1), minlength=n)
    share = np.clip(np.log2(np.maximum(count, 1) / np.maximum(distinct, 1)) * 2, 0, REPEATS - 1).astype(np.int64)
    found.append((np.arange(n)[count > 0] << (BITS + 1)) | ((1 << BITS) + share[count > 0]))
    pairs = np.unique(np.concatenate(found))
    return pairs >> (BITS + 1), pairs & ((1 << (BITS + 1)) - 1)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k from 1."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -50, 50)))


def fit(grades: np.ndarray, lists: list[np.ndarray], levels: int = GRADES, rounds: int = 1500, rate: float = 0.3, decay: float = 2e-6, least: float = EVIDENCE) -> Model | None:
    """Maximum likelihood with weight decay, by Adam on all rows at once.

    Only features whose presence tells of a lower grade (chi-square of ``least`` or more) get a weight.  Long texts have
    thousands of others, whose random weights would add up, and common words would outweigh a few bad ones.
    """
    if len(np.unique(grades)) < 2:
        return None
    row = np.repeat(np.arange(len(lists), dtype=np.int32), [len(x) for x in lists])
    feature = np.concatenate(lists)
    seen = np.stack([np.bincount(feature[grades[row] == k], minlength=WIDTH) for k in range(levels)], 1)
    due = seen.sum(1, keepdims=True) * (np.bincount(grades, minlength=levels) / len(grades))
    telling = ((seen - due) ** 2 / np.maximum(due, 1e-9)).sum(1) >= least
    telling &= seen[:, -1] < due[:, -1]
    row, feature = row[telling[feature]], feature[telling[feature]]
    rows, cuts = len(grades), levels - 1
    share = np.clip(np.array([(grades <= k).mean() for k in range(cuts)]), 1e-3, 1 - 1e-3)
    first = np.log(share / (1 - share))
    # thresholds: the first one, and logarithms of the steps to the next
    free = np.concatenate(([first[0]], np.log(np.maximum(np.diff(first), 1e-2))))
    weights = np.zeros(WIDTH)
    state = [np.zeros(WIDTH + cuts), np.zeros(WIDTH + cuts)]
    for step in range(1, rounds + 1):
        steps = np.exp(free[1:])
        theta = np.concatenate(([-np.inf], free[0] + np.concatenate(([0.0], np.cumsum(steps))), [np.inf]))
        score = np.bincount(row, weights[feature], rows)
        upper = 1 / (1 + np.exp(np.clip(score - theta[grades + 1], -50, 50)))
        lower = 1 / (1 + np.exp(np.clip(score - theta[grades], -50, 50)))
        chance = np.maximum(upper - lower, 1e-9)
        up, low = upper * (1 - upper) / chance, lower * (1 - lower) / chance
        slope = (up - low) / rows  # of the loss in the score
        d_theta = np.bincount(grades, low, levels)[1:] / rows - np.bincount(grades, up, levels)[:-1] / rows
        d_free = np.concatenate(([d_theta.sum()], [d_theta[i:].sum() * steps[i - 1] for i in range(1, cuts)]))
        gradient = np.concatenate((np.bincount(feature, slope[row], WIDTH) + decay * weights, d_free))
        state[0] = 0.9 * state[0] + 0.1 * gradient
        state[1] = 0.999 * state[1] + 0.001 * gradient ** 2
        move = rate * (state[0] / (1 - 0.9 ** step)) / (np.sqrt(state[1] / (1 - 0.999 ** step)) + 1e-8)
        weights = np.minimum(weights - move[:WIDTH], 0)
        free -= move[WIDTH:]
    return Model(weights.astype(np.float32), free[0] + np.concatenate(([0.0], np.cumsum(np.exp(free[1:])))))


@lean
def _lists(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(it, size=BATCH):
        text, feature = features(batch.column("text"))
        at = np.searchsorted(text, np.arange(batch.num_rows + 1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays([batch.column("grade"), pa.ListArray.from_arrays(pa.array(at), pa.array(feature.astype(np.int32)))], ["grade", "features"])


def train(docs: DataFrame, ratings: DataFrame, sample: int = SAMPLE, levels: int = GRADES) -> Model | None:
    """Fits on (doc_id, grade) ratings of at most ``sample`` documents, which bounds what comes to the driver."""
    rated = ratings.filter("doc_id IS NOT NULL AND grade IS NOT NULL").groupBy("doc_id").agg(F.min("grade").cast("int").alias("grade"))
    chosen = rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # ``sample`` rows of two numbers
    # one text for each id
    rows = rows.groupBy("doc_id", "grade").agg(F.min("text").alias("text")).select("grade", "text")
    found = rows.mapInArrow(_lists, "grade int, features array<int>").toArrow()
    if not found.num_rows:
        return None
    lists = [part.values.to_numpy()[a:b] for part in found["features"].chunks for a, b in zip(part.offsets.to_numpy(), part.offsets.to_numpy()[1:])]
    return fit(found["grade"].to_numpy().astype(np.int64), lists, levels)


def _scores(model: Model, select: int, tail: float, column: str = "_text"):
    @lean
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it, size=BATCH):
            text, feature = features(batch.column(column))
            score = np.bincount(text, model.weights[feature], batch.num_rows)
            tails = model.tails(score)
            own = [c for c in batch.schema.names if c != "_text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in own), pa.array(tails.sum(1)), pa.array(tails[:, select - 1]), pa.array(tails[:, select - 1] >= tail)],
                [*own, "expected_grade", "tail", "kept"])

    return run


def classify(docs: DataFrame, ratings: DataFrame, columns: tuple[str, ...] = ("doc_id",), sample: int = SAMPLE,
             levels: int = GRADES, select: int = SELECT, tail: float = TAIL) -> DataFrame:
    """``columns`` of ``docs`` with expected_grade, tail (the chance of grade ``select`` or more) and kept (tail of ``tail`` or more)."""
    model = train(docs, ratings, sample, levels)
    columns = tuple(c for c in columns if c not in ("expected_grade", "tail", "kept"))
    if model is None:
        none = F.lit(None).cast("double")
        return docs.select(*columns, none.alias("expected_grade"), none.alias("tail"), F.lit(True).alias("kept"))
    names = {f"c{i}": c for i, c in enumerate(columns)}
    # a text that is asked for goes to the tasks once
    text = next((n for n, c in names.items() if c == "text"), "_text")
    rows = docs.select(*(docs[c].alias(n) for n, c in names.items()), *([docs["text"].alias("_text")] if text == "_text" else []))
    kinds = dict(rows.dtypes)
    schema = "".join(f"{n} {kinds[n]}, " for n in names) + "expected_grade double, tail double, kept boolean"
    return rows.mapInArrow(_scores(model, select, tail, text), schema).withColumnsRenamed(names)
