"""Benchmark passages in documents, found by spaced seeds.

A seed is a fixed mask over neighbouring words: it hashes the words at its ones and
ignores those at its zeros. Hashes of all benchmark items are joined with those of all
documents; around each hit the two texts are laid side by side and words are compared,
so that words which were exchanged don't hide a passage.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txclean.llm.common import forgotten_after_task, narrow, text_of, unused, with_columns_by_slice
from txclean.shared import shared_table

WORD = re.compile(r"[^\W_]+")
#: Fixed values. Whichever 3 of 15 words are exchanged, one of these still hits.
MASKS = ("1111011", "11001000111", "11010110001")
#: Words that two texts must share side by side, and how many of them must be equal.
OVERLAP, SIMILARITY = 15, 0.8
#: Words of the benchmark that are looked for in one pass over the documents.
PASS_WORDS = 2_000_000
REMEMBERED = 500_000
_hashes: dict[str, int] = forgotten_after_task({})


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def hashes_of(words: list[str]) -> np.ndarray:
    import xxhash

    if len(_hashes) > REMEMBERED:
        _hashes.clear()
    for new in {w for w in words if w not in _hashes}:
        _hashes[new] = xxhash.xxh3_64_intdigest(new)
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def seed_hashes(hashes: np.ndarray, mask: str) -> np.ndarray:
    """The masked hash at every place at which the whole mask fits."""
    n = len(hashes) - len(mask) + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    total = np.full(n, len(mask), np.uint64)
    for at, bit in enumerate(mask):
        if bit == "1":
            total = (total ^ hashes[at : at + n]) * np.uint64(0x9FB21C651E98DF25)
            total ^= total >> np.uint64(29)
    return total


def short_masks(words: int, similarity: float = SIMILARITY) -> list[str]:
    """Masks over all of an item's words, one of which hits whichever words are exchanged
    as far as the similarity allows: of so many groups and two more, each leaves out so many."""
    changed = words - math.ceil(similarity * words - 1e-9)
    parts = min(words, changed + 2)
    group = [at * parts // words for at in range(words)]
    return ["".join("01"[g not in out] for g in group) for out in combinations(range(parts), changed)]


@dataclass
class Seeds:
    """Hashes of one pass's items: by mask, sorted, with item number and place."""

    ids: list
    items: list[np.ndarray]
    masks: list[str]
    tables: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    marks: list[np.ndarray]


def seeds_of(rows: list[tuple], overlap: int = OVERLAP, similarity: float = SIMILARITY) -> Seeds:
    """`rows`: (id, text). Short items are also looked for by masks over all of their words."""
    found = [(i, hashes_of(words_of(t or ""))) for i, t in rows]
    found = [(i, h) for i, h in found if len(h)]
    ids, items = [i for i, _ in found], [h for _, h in found]
    short = sorted({len(h) for h in items if len(h) < overlap})
    masks = [*MASKS, *(m for n in short for m in short_masks(n, similarity))]
    tables, marks = [], []
    for number, mask in enumerate(masks):
        whole = number >= len(MASKS)
        parts = [
            (seed_hashes(h, mask), k)
            for k, h in enumerate(items)
            if (len(h) == len(mask) if whole else len(h) >= len(mask))
        ]
        values = np.concatenate([np.zeros(0, np.uint64), *(v for v, _ in parts)])
        item = np.concatenate([np.zeros(0, np.int64), *(np.full(len(v), k) for v, k in parts)])
        place = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(v)) for v, _ in parts)])
        order = np.argsort(values, kind="stable")
        tables.append((values[order], item[order].astype(np.int64), place[order].astype(np.int64)))
        mark = np.zeros(1 << 20, bool)
        mark[(values >> np.uint64(44)).astype(np.int64)] = True
        marks.append(mark)
    return Seeds(ids, items, masks, tables, marks)


def passages(doc: np.ndarray, seeds: Seeds, overlap: int, similarity: float) -> list[dict]:
    """Stretches of a document that hold an item's words: item, start, stop, equal."""
    laid: set[tuple[int, int]] = set()
    for mask, (values, item, place), mark in zip(seeds.masks, seeds.tables, seeds.marks, strict=True):
        hashed = seed_hashes(doc, mask)
        if not len(hashed) or not len(values):
            continue
        hits = np.flatnonzero(mark[(hashed >> np.uint64(44)).astype(np.int64)])
        low = np.searchsorted(values, hashed[hits], "left")
        high = np.searchsorted(values, hashed[hits], "right")
        for at, a, b in zip(hits[high > low].tolist(), low[high > low].tolist(), high[high > low].tolist(), strict=True):
            laid.update(zip(item[a:b].tolist(), (at - place[a:b]).tolist(), strict=True))
    out = []
    for k, shift in sorted(laid):
        words = seeds.items[k]
        first, last = max(0, shift), min(len(doc), shift + len(words))
        width = min(overlap, len(words))
        if last - first < width:
            continue
        equal = doc[first:last] == words[first - shift : last - shift]
        sums = np.concatenate([[0], np.cumsum(equal)])
        good = np.flatnonzero(sums[width:] - sums[:-width] >= similarity * width)
        if len(good):
            start, stop = int(good[0]), int(good[-1]) + width
            out.append(
                {
                    "item": seeds.ids[k],
                    "start": first + start,
                    "stop": first + stop,
                    "equal": int(sums[stop] - sums[start]),
                }
            )
    return out


def find_passages(
    df: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    overlap: int = OVERLAP,
    similarity: float = SIMILARITY,
    pass_words: int = PASS_WORDS,
) -> DataFrame:
    """All columns of `df` and `__passages`, an array of (item, start, stop, equal), the item
    in its own type; the column gets further underscores if `df` has one of that name.

    Texts are read as lower-case words of letters and digits. A document holds an item
    if `overlap` neighbouring words of the item, or all if it has fewer, stand in it with at
    least `similarity` of them equal place by place. With the defaults every such
    overlap of 15 words is hit by a seed, and so is every item of 14 words or fewer; of
    fewer than 5 words all must be equal. start and stop count words. Null texts have no words, null and repeated items are harmless, and without
    items nothing is found. The index of a pass is broadcast; it holds about
    `pass_words` words of whole items, and larger benchmarks take several passes over
    the documents.
    """
    spark = df.sparkSession
    items = narrow(benchmark, item=item_col, text=item_text_col).where("item IS NOT NULL").select(
        "item", text_of().alias("text")
    )
    total = items.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    passes = max(1, -(-total // (pass_words * 6)))
    of = f"array<struct<item: {dict(items.dtypes)['item']}, start: int, stop: int, equal: int>>"
    name, own, row, digest = (unused(df, c) for c in ("__passages", "__text", "__row", "__digest"))
    texts = df.withColumn(own, text_of(f"`{text_col}`"))

    def one_pass(rows: DataFrame, number: int) -> DataFrame:
        part = items.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == number)
        index = spark.sparkContext.broadcast(seeds_of([tuple(r) for r in part.toLocalIterator()], overlap, similarity))

        def work(batch):
            docs = [words_of(t) for t in batch.column(own).to_pylist()]
            return {name: [passages(hashes_of(d), index.value, overlap, similarity) for d in docs]}

        return with_columns_by_slice(rows, f"`{name}` {of}", work)

    if passes == 1:
        return one_pass(texts, 0).drop(own)
    # Several passes: each leaves what it has found as a table, by text.
    by_text = texts.select(F.xxhash64(own).alias(row), F.sha2(own, 256).alias(digest), own)
    found = None
    for number in range(passes):
        hit = shared_table(
            one_pass(by_text, number).where(F.size(name) > 0).drop(own).distinct(), "passages"
        )
        found = hit if found is None else found.unionByName(hit)
    merged = found.groupBy(row, digest).agg(F.array_sort(F.flatten(F.collect_list(name))).alias(name))
    return (
        texts.withColumn(row, F.xxhash64(own))
        .withColumn(digest, F.sha2(own, 256))
        .join(merged, [row, digest], "left")
        .withColumn(name, F.coalesce(name, F.expr(f"CAST(array() AS {of})")))
        .select(*(f"`{c}`" for c in df.columns), name)
    )
