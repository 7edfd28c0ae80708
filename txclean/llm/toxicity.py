"""Toxicity by a support vector machine over a subsequence string kernel.

The kernel compares two words by the letter triples that they have in common, in order
but not side by side: a triple counts by a decay to the power of the stretch it spans,
so an insult with letters or marks put between its own still resembles itself. A sentence
is as toxic as its worst word, and a document as its worst sentence. Landmarks are words
of the labelled sentences; by the Nystroem method the kernel among them whitens a word's
similarities to them, and a linear machine on top is a kernel machine of their span. Of
a toxic document only the worst word is known to be toxic, and which one that is the machine finds
anew in each round; every word of the other documents is not.
"""

from __future__ import annotations

import math
import re
import string
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txclean.llm.common import in_slices, text_of, unused, with_columns_by_slice
from txclean.shared import shared_table

#: Letters of a subsequence, the longest stretch it may span, and the decay per letter.
LETTERS, SPAN, DECAY = 3, 5, 0.8
#: What it costs to have all toxic words on the wrong side, and how many times that
#: the words of other documents cost: each of those can spoil a text.
COST, OTHERS = 3000.0, 4.0
#: Triples are told apart by so many bits of a hash.
BITS = 20
#: Remembered words of a worker before it starts afresh.
REMEMBERED = 200_000

#: Words that are valued at a time; each takes some kilobytes of triples.
VALUED = 2_000

BREAK = re.compile(r"(?<=[.!?])\s+|\n+")
SPELT = re.compile(r"(?:(?<=\s)|^)(?:[^\W\d_]\W*\s+){2}[^\W\d_](?=\W*(?:\s|$))")
MARKS = string.punctuation
EDGES = re.compile(r"^[\W_]+|[\W_]+$")
# Places of the second and third letter, with the weight of the stretch.
STEPS = [
    (j, k, DECAY ** (k + 1)) for j in range(1, SPAN - 1) for k in range(j + 1, SPAN)
]


def word_of(token: str) -> str:
    """A token without the marks at its edges, in lower case."""
    token = token.strip(MARKS).lower()
    return token if not token or token[0].isalnum() and token[-1].isalnum() else EDGES.sub("", token)


#: Fixed odd numbers for the hash of a triple.
MIX = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)
_letters = np.full(0x110000, -1, np.int8)


def _is_letter(codes: np.ndarray) -> np.ndarray:
    new = np.unique(codes[_letters[codes] < 0])
    for code in new.tolist():
        _letters[code] = chr(code).isalnum() or chr(code) == "^"
    return _letters[codes] > 0


def triples(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, triple, weight) of every triple of letters that stands in a word in order
    and within SPAN places, weights scaled to length one per word. `^` stands before the
    first letter; marks within a word only take up room."""
    apart = "\0" * SPAN
    joined = apart.join("^" + w for w in words) + apart
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    good = _is_letter(codes)
    owner = np.repeat(np.arange(len(words)), [len(w) + 1 + SPAN for w in words])
    n = len(codes) - SPAN + 1
    mixed = [codes * np.uint32(m) for m in MIX]
    parts = []
    for j, k, weight in STEPS:
        at = np.flatnonzero(good[:n] & good[j : n + j] & good[k : n + k])
        value = (mixed[0][at] ^ (mixed[1][at + j] >> np.uint32(3))) + mixed[2][at + k]
        value = (value ^ (value >> np.uint32(15))) * np.uint32(MIX[1])
        parts.append((owner[at], value >> np.uint32(32 - BITS), np.full(len(at), weight)))
    word, triple, weight = (np.concatenate(x) for x in zip(*parts, strict=True))
    size = np.sqrt(np.bincount(word, weight * weight, minlength=len(words)))
    return word, triple.astype(np.int64), weight / size[word]


class Landmarks:
    """Words, and a table of their triples."""

    def __init__(self, words: list[str]):
        self.words = words
        word, triple, weight = triples(words) if words else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
        self.triples = np.unique(triple)
        self.table = np.zeros((len(self.triples) + 1, len(words)), np.float32)
        np.add.at(self.table, (np.searchsorted(self.triples, triple), word), weight)

    def similar(self, words: list[str]) -> np.ndarray:
        """The kernel of each word with each landmark."""
        out = np.zeros((len(words), len(self.words)), np.float32)
        if not self.words:
            return out
        for n in range(0, len(words), 250):  # some at a time, as a triple takes a row
            word, triple, weight = triples(words[n : n + 250])
            row = np.searchsorted(self.triples, triple)
            row = np.minimum(row, len(self.triples) - 1)
            hit = self.triples[row] == triple
            added = self.table[row[hit]] * weight[hit, None].astype(np.float32)
            np.add.at(out, word[hit] + n, added)
        return out


def spelt(tokens: list[str]) -> list[str]:
    """Words put together from runs of single letters, `i d i o t`."""
    out, run = [], ""
    for token in [*tokens, "  "]:
        letter = word_of(token)
        if len(letter) == 1:
            run += letter
        else:
            if len(run) >= LETTERS:
                out.append(run)
            run = ""
    return out


def runs_of(text: str) -> set[str]:
    """Spelt words of the whole text, as marks between letters can look like the ends of
    sentences, and of each sentence, as letters of the next one may follow."""
    return {w for part in [text, *BREAK.split(text)] for w in spelt(part.split())}


def forms(token: str) -> set[str]:
    """How a token may be meant: as it stands, and without the marks within."""
    word = word_of(token)
    if len(word) < LETTERS:
        return set()
    return {word} if word.isalnum() else {word, "".join(c for c in word if c.isalnum())}


@dataclass
class Model:
    """Landmarks, a weight for each, what a text without words gets, and the line that
    turns the worst word's value into a probability."""

    landmarks: Landmarks
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0

    def __post_init__(self):
        # By linearity a word's value is a sum over its triples.
        self.by_triple = np.zeros(1 << BITS)
        self.by_triple[self.landmarks.triples] = self.landmarks.table[:-1] @ self.weights

    def values(self, words: list[str]) -> np.ndarray:
        parts = [np.zeros(0)]
        for n in range(0, len(words), VALUED):
            word, triple, weight = triples(words[n : n + VALUED])
            size = min(VALUED, len(words) - n)
            parts.append(np.bincount(word, self.by_triple[triple] * weight, minlength=size))
        return np.concatenate(parts) + self.bias

    def probability(self, value: float) -> float:
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, self.slope * value + self.offset))))


class Reader:
    """Values of documents, with the words remembered."""

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, float] = {}

    def documents(self, texts: list[str]) -> list[float]:
        """The worst word's value in each."""
        known, bias = self.known, self.model.bias
        if len(known) > REMEMBERED:
            known.clear()
        tokens = [set(t.split()) for t in texts]
        new = list({t for ts in tokens for t in ts if t not in known})
        of = [forms(t) for t in new]
        words = sorted({w for f in of for w in f})
        values = dict(zip(words, self.model.values(words).tolist(), strict=True))
        known.update((t, max([bias, *(values[w] for w in f)])) for t, f in zip(new, of, strict=True))
        out = []
        for text, ts in zip(texts, tokens, strict=True):
            worst = max(map(known.__getitem__, ts), default=bias)
            if SPELT.search(text):
                worst = max([worst, *self.model.values(sorted(runs_of(text))).tolist()])
            out.append(worst)
        return out


def _machine(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Linear machine with squared hinge loss, by Newton steps; the last weight is the
    bias."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    w = np.zeros(x.shape[1])
    ridge = np.ones(x.shape[1])
    ridge[-1] = 1e-4
    for _ in range(rounds):
        slack = 1 - y * (x @ w)
        active = slack > 0
        xa, ca = x[active], cost[active]
        gradient = ridge * w - 2 * xa.T @ (ca * y[active] * slack[active])
        hessian = np.diag(ridge)
        for n in range(0, len(xa), 2000):
            part = xa[n : n + 2000].astype(float)
            hessian = hessian + 2 * (part * ca[n : n + 2000, None]).T @ part
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _calibrated(values: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic line, lightly held."""
    slope, offset = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * values + offset, -50, 50)))
        r, d = p - toxic, np.maximum(p * (1 - p), 1e-9)
        g = np.array([(r * values).sum() + 0.05 * (slope - 1), r.sum()])
        h = np.array(
            [[(d * values * values).sum() + 0.05, (d * values).sum()], [(d * values).sum(), d.sum() + 1e-6]]
        )
        step = np.linalg.solve(h, g)
        slope, offset = slope - step[0], offset - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return max(slope, 1e-3), offset


def _trained(
    similar: np.ndarray,
    bags: list[list[int]],
    clean: np.ndarray,
    white: np.ndarray,
    start: np.ndarray,
    sure: np.ndarray,
    gapped: list[np.ndarray],
):
    """Weights by landmark and bias. `similar`: rows for words; `bags`: of each toxic
    document the words in question; `clean`: in how many other documents each word stands;
    `start`: what to take for the words' values first; `sure`: words that tell beyond
    chance; `gapped`: rows like `similar` for the words with something put in."""
    white = white.astype(np.float32)
    phi = similar @ white
    gapped = [g @ white for g in gapped]
    value = start
    negative = np.flatnonzero(clean)
    weights, bias = np.zeros(similar.shape[1]), -1.0
    for _ in range(4):
        # The worst word of a document, and any other that is sure, count as toxic.
        witness = np.zeros(len(similar))
        for bag in bags:
            if bag:
                worst = max(bag, key=value.__getitem__)
                for n in {worst, *(b for b in bag if sure[b])}:
                    witness[n] += 1
        positive = np.flatnonzero(witness)
        if not len(positive):
            break
        x = np.concatenate([phi[positive], *(g[positive] for g in gapped), phi[negative]])
        times = 1 + len(gapped)
        y = np.concatenate([np.ones(len(positive) * times), -np.ones(len(negative))])
        up = np.tile(witness[positive], times)
        down = np.sqrt(clean[negative])
        cost = COST * np.concatenate([up / up.sum(), OTHERS * down / down.sum()])
        w = _machine(x, y, cost)
        weights, bias = white @ w[:-1], float(w[-1])
        value = similar @ weights + bias
    return weights, bias


def _beyond_chance(t: int, c: int, toxic_docs: int, clean_docs: int, least: float = 15.0) -> bool:
    """Whether a word stands in toxic documents more often than chance would have it, by
    a likelihood ratio."""
    if t * clean_docs <= c * toxic_docs:
        return False
    share = toxic_docs / (toxic_docs + clean_docs)
    ratio = t * math.log(t / ((t + c) * share)) + (c * math.log(c / ((t + c) * (1 - share))) if c else 0.0)
    return 2 * ratio >= least


def put_in(word: str, seed: int) -> str:
    """The word with a letter put in somewhere within, or one of its own doubled."""
    at = 1 + (seed * 7 + len(word)) % max(1, len(word) - 1)
    return word[:at] + ("xyz"[seed % 3] if seed % 2 else word[at - 1]) + word[at:]


def _chosen(counts: list[tuple[str, int, int]], telling: dict[str, float], most: int) -> list[str]:
    """Landmarks: three in four are words that tell toxicity, each unlike the ones
    before; the others are words of other documents which resemble them most."""
    words: list[str] = []
    near = np.zeros((0, 0))
    ranked = sorted((w for w in telling if telling[w] > 1), key=lambda w: (-telling[w], w))
    for start in range(0, len(ranked), 200):
        part = ranked[start : start + 200]
        near = Landmarks(part + words).similar(part)
        fresh: list[int] = []
        for n in range(len(part)):
            others = [*fresh, *range(len(part), near.shape[1])]
            if len(words) + len(fresh) < most * 3 // 4 and (not others or near[n, others].max() < 0.85):
                fresh.append(n)
        words += [part[n] for n in fresh]
        if len(words) >= most * 3 // 4:
            break
    if words:
        taken = set(words)
        others = [w for w, t, c in counts if c > t and w not in taken]
        close = Landmarks(words).similar(others).max(axis=1, initial=0.0)
        words += [others[n] for n in np.argsort(-close, kind="stable")[: most - len(words)]]
    return words


def train(
    documents: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    per_class: int = 4000,
    landmarks: int = 256,
    words: int = 12_000,
    in_question: int = 12,
) -> Model:
    """Train on documents with a label of 1 or 0; other labels and null texts are left out.

    Bounds, which no table changes: at most `per_class` documents of each label, in the
    order of a hash of the id; of their words the `words` that tell most or are most
    frequent or are mistaken most, and `landmarks` of those; of each toxic document the
    `in_question` words that tell most. So much comes to the driver, and nothing else.
    Texts are read whole. If one of the labels has no document, or no word tells, every
    score is the commoner label's.
    """
    spark = documents.sparkSession
    marked = labels.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("toxic")
    ).where("id IS NOT NULL AND toxic IN (0, 1)")
    order = F.xxhash64(F.col("id"), F.lit(7))
    first, second = (
        marked.where(F.col("toxic") == label).distinct().orderBy(order, "id").limit(per_class)
        for label in (0, 1)
    )
    sample = shared_table(first.unionByName(second), "labelled")
    docs = shared_table(
        documents.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
        .where("text IS NOT NULL")
        .join(sample, "id")
        .dropDuplicates(["toxic", "text"]),  # a copy tells nothing new
        "labelled-texts",
    )
    sizes = {r["toxic"]: r["n"] for r in docs.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic_docs, clean_docs = sizes.get(1, 0), sizes.get(0, 0)
    nothing = Model(Landmarks([]), np.zeros(0), 0.0, 1.0, 5.0 if toxic_docs > clean_docs else -5.0)
    if not toxic_docs or not clean_docs:
        return nothing

    def words_in(text: str) -> set[str]:
        found = {w for t in set(text.split()) for w in forms(t)}
        return found | runs_of(text)

    def vocabulary(batch):
        out: dict = {"word": [], "toxic": []}
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            found = sorted(words_in(text))
            out["word"] += found
            out["toxic"] += [toxic] * len(found)
        yield out

    counted = shared_table(
        in_slices(docs.select("text", "toxic"), "word string, toxic int", vocabulary)
        .groupBy("word")
        .agg(F.count_if(F.col("toxic") == 1).alias("t"), F.count_if(F.col("toxic") == 0).alias("c")),
        "words",
    )
    tells = F.sqrt("t") * (
        F.log((F.col("t") + 0.5) / (toxic_docs + 1)) - F.log((F.col("c") + 0.5) / (clean_docs + 1))
    )
    third = words // 3
    top = counted.where("t >= 2").withColumn("tells", tells).orderBy(F.col("tells").desc(), "word").limit(third)
    telling = {r["word"]: r["tells"] for r in top.collect()}
    rows = {r["word"]: (r["t"], r["c"]) for r in top.collect()}
    common = counted.where("c >= 1").orderBy(F.col("c").desc(), "word").limit(third)
    rows |= {r["word"]: (r["t"], r["c"]) for r in common.collect()}
    chosen = _chosen([(w, *n) for w, n in sorted(rows.items())], telling, landmarks)
    if not chosen:
        return nothing
    marks = Landmarks(chosen)
    known = spark.sparkContext.broadcast(telling)

    def candidates(batch):
        sets = [words_in(t) & known.value.keys() for t in batch.column("text").to_pylist()]
        yield {"words": [sorted(s, key=lambda w: (-known.value[w], w))[:in_question] for s in sets]}

    toxic_words = [
        r["words"] for r in in_slices(docs.where("toxic = 1").select("text"), "words array<string>", candidates).collect()
    ]
    values, eigen = np.linalg.eigh(marks.similar(chosen))
    white = (eigen / np.sqrt(np.maximum(values, 1e-2))) @ eigen.T

    def trained() -> Model:
        names = sorted(rows)
        place = {w: n for n, w in enumerate(names)}
        clean = np.array([float(rows[w][1]) for w in names])
        start = np.array([telling.get(w, -1.0) for w in names])
        sure = np.array([_beyond_chance(*rows[w], toxic_docs, clean_docs) for w in names])
        bags = [[place[w] for w in ws] for ws in toxic_words]
        gapped = [marks.similar([put_in(w, seed) for w in names]) for seed in (1, 2)]
        return Model(marks, *_trained(marks.similar(names), bags, clean, white, start, sure, gapped))

    # Words of other documents that the first machine takes for toxic join the rest.
    sent = spark.sparkContext.broadcast(trained())

    def valued(batch):
        yield {
            "word": batch.column("word"), "t": batch.column("t"), "c": batch.column("c"),
            "value": sent.value.values(batch.column("word").to_pylist()),
        }

    mistaken = in_slices(counted.where("c >= 1"), "word string, t long, c long, value double", valued)
    worst = mistaken.orderBy(F.col("value").desc(), "word").limit(third).collect()
    rows |= {r["word"]: (r["t"], r["c"]) for r in worst}
    model = trained()
    final = spark.sparkContext.broadcast(model)

    def held(batch):
        yield {"toxic": batch.column("toxic"), "value": Reader(final.value).documents(batch.column("text").to_pylist())}

    found = in_slices(docs.select("toxic", "text"), "toxic int, value double", held).collect()
    found.sort()
    model.slope, model.offset = _calibrated(
        np.array([r["value"] for r in found]), np.array([float(r["toxic"]) for r in found])
    )
    return model


def score(df: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """All columns of `df` and a score in [0, 1]; above 0.5 is toxic. Null and empty
    texts get what a text without any insult gets. Rows are independent of each other. If `df`
    has a column of that name, the score's gets underscores before it."""
    name = unused(df, name)
    own = unused(df, "__text")
    sent = df.sparkSession.sparkContext.broadcast(model)
    state: dict = {}

    def work(batch):
        if "reader" not in state:
            state["reader"] = Reader(sent.value)
        values = state["reader"].documents(batch.column(own).to_pylist())
        return {name: pa.array([sent.value.probability(v) for v in values], pa.float64())}

    texts = df.withColumn(own, text_of(f"`{text_col}`"))
    return with_columns_by_slice(texts, f"`{name}` double", work).drop(own)
