"""Quality of texts by a vote of their nearest labelled neighbours in a latent-semantic space.

A text is a bag of terms that tell how it is written rather than what about: triples of
characters by their class, and pairs of words by their shape, with a mark where a word
repeats one of the few before it. Counts are damped and weighted by how unevenly a term
is spread over the labelled texts (log-entropy); the singular vectors of that matrix
span the space. The labelled vectors are a bounded sample, so they are broadcast; every
document is compared with all of them, a block of documents by one matrix product, and
its nearest ones vote with a weight that grows with their cosine.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txclean.llm.common import in_slices
from txclean.shared import shared_table

#: Terms are told apart by a hash to so many columns of triples, and of pairs of shapes.
TRIPLES, SHAPES = 4096, 2048
#: A word is looked for among so many words before it.
LOOK_BACK = 4
#: Documents of a block of the dense matrices.
BLOCK = 512
#: Lengths of words from which a shape's next class of lengths begins.
LENGTHS = (2, 4, 7, 11, 16, 30)

SPACE, LINE, LOWER, UPPER, DIGIT, CONTROL = range(6)


def _classes() -> np.ndarray:
    """A class for each byte: letters by case, digits, spaces, line ends, and each mark
    for itself. Bytes of characters outside ASCII count as lower-case letters."""
    table = np.full(256, CONTROL, np.int64)
    table[[9, 32]] = SPACE
    table[[10, 13]] = LINE
    table[ord("a") : ord("z") + 1] = LOWER
    table[128:] = LOWER
    table[ord("A") : ord("Z") + 1] = UPPER
    table[ord("0") : ord("9") + 1] = DIGIT
    marks = [b for b in range(33, 127) if not chr(b).isalnum()]
    table[marks] = np.arange(len(marks)) + CONTROL + 1
    return table


CLASSES = _classes()
KINDS = int(CLASSES.max()) + 1


def _mixed(values: np.ndarray, columns: int) -> np.ndarray:
    """A column for each value, by multiplicative hashing."""
    mixed = values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(40)) % np.uint64(columns)).astype(np.int64)


def _word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word's letters in lower case: weighted sums of its bytes' hashes by place."""
    lower = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint64)
    lengths = ends - starts
    place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    letters = lower[np.repeat(starts, lengths) + place] + np.uint64(1)
    odd = (place.astype(np.uint64) * np.uint64(2) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed = letters * odd
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    return np.add.reduceat(mixed, np.cumsum(lengths) - lengths) if len(lengths) else mixed


def counted_terms(texts: list[str]) -> np.ndarray:
    """Damped counts of the terms of each text, one row per text; whole texts are read."""
    encoded = [t.encode() + b"\n" for t in texts]
    sizes = np.array([len(e) for e in encoded], np.int64)
    raw = np.frombuffer(b"".join(encoded), np.uint8)
    of = np.repeat(np.arange(len(texts)), sizes)
    kind = CLASSES[raw]
    out = np.zeros((len(texts), TRIPLES + SHAPES), np.float32)

    if len(raw) > 2:
        triple = (kind[:-2] * KINDS + kind[1:-1]) * KINDS + kind[2:]
        inside = of[:-2] == of[2:]
        cells = of[:-2][inside] * TRIPLES + _mixed(triple[inside], TRIPLES)
        out[:, :TRIPLES] = np.bincount(cells, minlength=len(texts) * TRIPLES).reshape(-1, TRIPLES)

    blank = kind <= LINE
    before = np.concatenate([[True], blank[:-1]])
    starts = np.flatnonzero(~blank & before)
    ends = np.flatnonzero(blank & ~before)
    if len(starts):
        owner = of[starts]
        hashes = _word_hashes(raw, starts, ends)
        back = np.zeros(len(starts), np.int64)
        for k in range(min(LOOK_BACK, len(starts) - 1), 0, -1):
            same = (hashes[k:] == hashes[:-k]) & (owner[k:] == owner[:-k])
            back[k:][same] = k
        length = np.searchsorted(LENGTHS, ends - starts, side="right")
        shape = ((kind[starts] * KINDS + kind[ends - 1]) * len(LENGTHS) + length) * (LOOK_BACK + 1) + back
        alone = owner * SHAPES + _mixed(shape, SHAPES)
        paired = owner[1:] == owner[:-1]
        both = owner[1:][paired] * SHAPES + _mixed(shape[:-1][paired] * 1_000_003 + shape[1:][paired] + 7, SHAPES)
        cells = np.concatenate([alone, both])
        out[:, TRIPLES:] = np.bincount(cells, minlength=len(texts) * SHAPES).reshape(-1, SHAPES)

    # Rates rather than counts, so that long texts resemble short ones of their kind.
    rate = out * (1000.0 / np.maximum(sizes, 200)[:, None]).astype(np.float32)
    return np.log1p(rate, out=rate)


@dataclass
class Neighbours:
    """The space, and the labelled vectors in it, each of length one."""

    weights: np.ndarray  # of the terms
    axes: np.ndarray  # terms x dimensions
    vectors: np.ndarray  # labelled texts x dimensions
    labels: np.ndarray
    shares: np.ndarray  # what a vote of each label weighs
    nearest: int
    power: float
    prior: float

    def project(self, terms: np.ndarray) -> np.ndarray:
        found = (terms * self.weights) @ self.axes
        length = np.linalg.norm(found, axis=1, keepdims=True)
        return found / np.where(length == 0, 1, length)

    def vote(self, vectors: np.ndarray) -> np.ndarray:
        """Share of label 1 in the votes of the nearest labelled vectors, for each row."""
        cosines = vectors @ self.vectors.T
        near = min(self.nearest, cosines.shape[1])
        chosen = np.argpartition(-cosines, near - 1, axis=1)[:, :near]
        weight = np.maximum(np.take_along_axis(cosines, chosen, 1), 0).astype(float) ** self.power
        weight *= self.shares[self.labels[chosen]]
        total = weight.sum(axis=1)
        voted = (weight * self.labels[chosen]).sum(axis=1)
        # A text that is near to nothing gets the commoner label's share.
        small = 1e-6
        return np.clip((voted + small * self.prior) / (total + small), 0, 1)

    def score(self, texts: list[str]) -> np.ndarray:
        if not len(self.vectors):
            return np.full(len(texts), self.prior)
        parts = [
            self.vote(self.project(counted_terms(texts[at : at + BLOCK])))
            for at in range(0, len(texts), BLOCK)
        ]
        return np.concatenate(parts) if parts else np.zeros(0)


def fit(
    terms: np.ndarray,
    labels: np.ndarray,
    ones: float,
    dimensions: int,
    nearest: int,
    power: float,
) -> Neighbours:
    """The space of these labelled rows; `ones` is the share of label 1 in all labels."""
    entropy = np.zeros(terms.shape[1])
    for at in range(0, terms.shape[1], BLOCK):
        part = terms[:, at : at + BLOCK]
        spread = part / np.maximum(part.sum(axis=0), 1e-12)
        entropy[at : at + BLOCK] = -(spread * np.log(np.maximum(spread, 1e-12))).sum(axis=0)
    weights = (1 - np.clip(entropy / np.log(max(len(terms), 2)), 0, 1)).astype(np.float32)
    weighted = terms * weights
    # Singular vectors by the smaller of the two Gram matrices.
    if len(weighted) <= weighted.shape[1]:
        values, left = np.linalg.eigh((weighted @ weighted.T).astype(np.float64))
        keep = np.argsort(-values)[:dimensions]
        keep = keep[values[keep] > max(values.max(), 0) * 1e-9]
        axes = weighted.T @ (left[:, keep] / np.sqrt(values[keep]))
    else:
        values, right = np.linalg.eigh((weighted.T @ weighted).astype(np.float64))
        keep = np.argsort(-values)[:dimensions]
        axes = right[:, keep[values[keep] > max(values.max(), 0) * 1e-9]]
    held = np.bincount(labels, minlength=2) / max(len(labels), 1)
    # The sample may hold the labels in other shares than the table does.
    shares = np.array([1 - ones, ones]) / np.maximum(held, 1e-12)
    model = Neighbours(
        weights, axes.astype(np.float32), np.zeros((0, 0), np.float32), labels, shares, nearest, power, ones
    )
    model.vectors = model.project(terms).astype(np.float32)
    return model


def train(
    documents: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    per_class: int = 1000,
    dimensions: int = 64,
    nearest: int = 15,
    power: float = 4.0,
) -> Neighbours:
    """Learn from documents with a label of 1 or 0; other labels, null ids and null texts are
    left out, and of equal texts with equal labels one stays.

    At most `per_class` texts of each label are taken, in the order of a hash of the id; their
    terms are counted on the executors, whole, and only the counts come to the driver.
    Votes are weighted by the labels' shares in the whole table, so the bound doesn't
    shift scores. Without any label every score is 0.5, and with only one label it is that label.
    """
    marked = labels.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label")
    ).where("id IS NOT NULL AND label IN (0, 1)")
    totals = {r["label"]: r["n"] for r in marked.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = F.xxhash64(F.col("id"), F.lit(11))
    zero, one = (
        marked.where(F.col("label") == label).distinct().orderBy(order, "id").limit(per_class)
        for label in (0, 1)
    )
    sample = shared_table(zero.unionByName(one), "quality-labels")
    texts = (
        documents.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
        .where("text IS NOT NULL")
        .join(sample, "id")
        .dropDuplicates(["label", "text"])
        .select("id", "label", "text")
    )

    def counted(batch):
        for at in range(0, batch.num_rows, BLOCK):
            rows = batch.slice(at, BLOCK)
            terms = counted_terms(rows.column("text").to_pylist())
            yield {
                "id": rows.column("id"), "label": rows.column("label"),
                "terms": [row.astype(np.float16).tobytes() for row in terms],
            }

    kind = dict(texts.dtypes)["id"]
    # Row by row, so that the driver holds the matrix and little beside it.
    rows = shared_table(
        in_slices(texts, f"id {kind}, label int, terms binary", counted), "quality-terms"
    ).orderBy("id", "label", F.xxhash64("terms"))
    terms, found = [], []
    for row in rows.toLocalIterator():
        terms.append(np.frombuffer(row["terms"], np.float16))
        found.append(row["label"])
    ones = totals.get(1, 0) / max(sum(totals.values()), 1) if totals else 0.5
    if not terms:
        none = np.zeros((0, 0), np.float32)
        return Neighbours(none[0:0, 0:0].ravel(), none, none, np.zeros(0, int), np.ones(2), nearest, power, ones)
    matrix = np.empty((len(terms), TRIPLES + SHAPES), np.float32)
    for n, row in enumerate(terms):
        matrix[n] = row
    return fit(matrix, np.array(found, np.int64), ones, dimensions, nearest, power)


def score(
    df: DataFrame, model: Neighbours, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of `df`: doc_id and score in [0, 1], higher where label 1 is likelier.

    Null texts count as empty; an empty text has the score of its nearest labelled texts like
    any other. Rows are independent, so repeated rows are simply repeated.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)
    docs = df.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")
    )

    def work(batch):
        scores = sent.value.score(batch.column("text").to_pylist())
        yield {"doc_id": batch.column("doc_id"), "score": pa.array(scores, pa.float64())}

    kind = dict(docs.dtypes)["doc_id"]
    return in_slices(docs, f"doc_id {kind}, score double", work, slice_bytes=1_500_000)
