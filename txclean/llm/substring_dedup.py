"""Repeated passages by relative Lempel-Ziv factors against blocks of earlier documents.

The reference is the corpus itself, cut into blocks. A block is a stretch of windows of
50 words whose smallest hash of 12 words, the anchor, is the same; every window belongs
to one block, and equal windows have equal anchors wherever they stand, so a factor can
only come from blocks with its own anchor. All blocks are indexed by anchor. Parsing is
greedy: a block which an earlier document holds as a whole is one factor; a block that
is new, though its anchor is not, is factored by its windows, which tells where within
the block a factor ends. Of a block that many documents hold only the first takes part
in that. Factors are 50 words at least, and neighbouring ones make up a span.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txclean.llm.common import in_slices, narrow, text_of
from txclean.shared import shared_table

#: Words of an anchor.
ANCHOR = 12
REMEMBERED = 500_000
#: An odd number, so that it has an inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
_hashes: dict[bytes, int] = {}
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def words_of(text: str) -> list[bytes]:
    return text.encode().split()


def hashes_of(words: list[bytes]) -> np.ndarray:
    import xxhash

    if len(_hashes) > REMEMBERED:
        _hashes.clear()
    for new in {w for w in words if w not in _hashes}:
        _hashes[new] = xxhash.xxh3_64_intdigest(new)
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _powers_of(base: int, upto: int) -> np.ndarray:
    factors = np.full(upto + 1, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


class Rolling:
    """Hashes of any stretch of words, from running sums modulo 2^64."""

    def __init__(self, hashes: np.ndarray):
        global _powers, _inverses
        n = len(hashes)
        if n >= len(_powers):
            size = 1 << n.bit_length()
            _powers, _inverses = _powers_of(BASE, size), _powers_of(pow(BASE, -1, 1 << 64), size)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * _powers[:n], dtype=np.uint64)])

    def of(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[stops] - self.sums[starts]) * _inverses[starts])


def blocks_of(words: list[bytes], window: int) -> tuple[np.ndarray, ...] | None:
    """(anchor, block hash, first window, last window) of each block, in order."""
    n = len(words) - window + 1
    if n < 1:
        return None
    rolling = Rolling(hashes_of(words))
    anchor = min(ANCHOR, window)
    starts = np.arange(len(words) - anchor + 1)
    low = rolling.of(starts, starts + anchor)
    span, width = window - anchor + 1, 1
    while width * 2 <= span:  # smallest of 2, 4, 8, ... neighbours
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < span:
        low = np.minimum(low[: n], low[span - width : span - width + n])
    first = np.flatnonzero(np.concatenate([[True], low[1:n] != low[: n - 1]]))
    last = np.concatenate([first[1:], [n]]) - 1
    content = rolling.of(first, last + window)
    return low[first], _mixed(content ^ (last - first).astype(np.uint64)), first, last


def _signed(a: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(a).view(np.int64))


def duplicate_spans(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50
) -> tuple[DataFrame, DataFrame]:
    """(documents, spans): doc_id, row (a hash of the text, which tells rows with one id
    apart) and text; and the words covered, as doc_id, row, first, stop."""
    docs = narrow(df, doc_id=id_col, text=text_col).select(
        "doc_id", F.xxhash64(text_of()).alias("row"), text_of().alias("text")
    )
    kind = dict(docs.dtypes)["doc_id"]

    def cut(batch):
        ids, rows, parts = [], [], []
        for i, text in enumerate(batch.column("text").to_pylist()):
            if (found := blocks_of(words_of(text), window)) is not None:
                parts.append(found)
                ids += [i] * len(found[0])
        if parts:
            anchor, block, first, last = (np.concatenate(x) for x in zip(*parts, strict=True))
            at = pa.array(ids)
            yield {
                "doc_id": batch.column("doc_id").take(at),
                "row": batch.column("row").take(at),
                "anchor": _signed(anchor),
                "block": _signed(block),
                "first": pa.array(first.astype(np.int32)),
                "last": pa.array(last.astype(np.int32)),
            }

    blocks = shared_table(
        in_slices(docs, f"doc_id {kind}, row long, anchor long, block long, first int, last int", cut),
        "blocks",
    ).where("doc_id IS NOT NULL")
    # Distinct blocks with the first and last document that holds them.
    held = blocks.groupBy("anchor", "block").agg(
        F.min("doc_id").alias("earliest"), F.max("doc_id").alias("latest")
    )
    anchors = held.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("variants"),
        F.min("earliest").alias("low"),
        F.max("latest").alias("high"),
    )
    shared = shared_table(
        held.join(anchors.where("high > low"), "anchor").select(
            "anchor",
            "block",
            "earliest",
            # The first document of a variant, unless it is the first of all, looks on.
            (F.col("variants") > 1).alias("contested"),
        ),
        "shared-blocks",
    )
    met = blocks.join(shared.drop("anchor").withColumnRenamed("block", "b"),
                      (F.col("block") == F.col("b")), "inner").drop("b")
    met = shared_table(met.where("doc_id > earliest OR contested"), "factors")
    whole = met.where("doc_id > earliest").select(
        "doc_id", "row", "first", (F.col("last") + window).alias("stop")
    )
    new = (
        met.where("contested AND doc_id = earliest")
        .groupBy("doc_id", "row")
        .agg(F.collect_list(F.struct("anchor", "first", "last")).alias("blocks"))
    )

    def windows(batch):
        for i, (text, found) in enumerate(
            zip(batch.column("text").to_pylist(), batch.column("blocks").to_pylist(), strict=True)
        ):
            rolling = Rolling(hashes_of(words_of(text)))
            at = np.concatenate([np.arange(b["first"], b["last"] + 1) for b in found])
            anchor = np.repeat(
                np.array([b["anchor"] for b in found], np.int64),
                [b["last"] - b["first"] + 1 for b in found],
            )
            same = pa.array([i] * len(at))
            yield {
                "doc_id": batch.column("doc_id").take(same),
                "row": batch.column("row").take(same),
                "anchor": pa.array(anchor),
                "words": _signed(rolling.of(at, at + window)),
                "first": pa.array(at.astype(np.int32)),
            }

    parsed = shared_table(
        in_slices(
            docs.join(new, ["doc_id", "row"]),
            f"doc_id {kind}, row long, anchor long, words long, first int",
            windows,
        ),
        "windows",
    )
    earliest = parsed.groupBy("anchor", "words").agg(
        F.min("doc_id").alias("earliest"), F.max("doc_id").alias("latest")
    ).where("latest > earliest")
    ends = parsed.join(earliest, ["anchor", "words"]).where("doc_id > earliest").select(
        "doc_id", "row", "first", (F.col("first") + window).alias("stop")
    )
    return docs, whole.unionByName(ends)


def remove_duplicate_spans(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 50,
    keep_text: bool = True,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 and, on request,
    kept_text (the kept words joined by one space) and removed (spans of words).

    A word is removed if a window over it also starts in a document with a smaller id.
    Null texts have no words. Rows with a null id neither lose words nor make others
    lose them; rows which repeat an id are judged by their own text and don't cover
    each other. An empty table gives none.
    """
    docs, spans = duplicate_spans(df, id_col, text_col, window)
    by_doc = spans.groupBy("doc_id", "row").agg(F.collect_list(F.struct("first", "stop")).alias("spans"))
    joined = docs.join(by_doc, ["doc_id", "row"], "left").select("doc_id", "text", "spans")
    kind = dict(docs.dtypes)["doc_id"]

    def cut_out(batch):
        rows = []
        for text, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            words = words_of(text)
            steps = np.zeros(len(words) + 1, np.int64)
            for s in found or ():
                steps[s["first"]] += 1
                steps[s["stop"]] -= 1
            keep = np.cumsum(steps[:-1]) == 0
            kept = b" ".join([w for w, k in zip(words, keep.tolist(), strict=True) if k] if found else words)
            edge = np.flatnonzero(np.diff(np.concatenate([[True], keep, [True]])))
            rows.append(
                {
                    "n_words": len(words),
                    "n_removed": int(len(words) - keep.sum()),
                    "kept_sha256": hashlib.sha256(kept).hexdigest(),
                    "kept_text": kept.decode() if keep_text else None,
                    "removed": [
                        {"first": int(a), "stop": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)
                    ],
                }
            )
        yield {"doc_id": batch.column("doc_id")} | {c: [r[c] for r in rows] for c in rows[0]}

    out = in_slices(
        joined,
        f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, kept_text string, "
        "removed array<struct<first: int, stop: int>>",
        cut_out,
    )
    return out if keep_text else out.drop("kept_text")
