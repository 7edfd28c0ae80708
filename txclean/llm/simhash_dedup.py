"""Near duplicates by SimHash, found through Golay-code keys.

A fingerprint's 64 bits are three segments. If two fingerprints differ in at most 4
bits, some two segments differ in at most 2 bits together. Each segment decodes to its
codeword and to the few others nearby, and a key joins an index of one segment with an
index of another, one of the two being the segment's own codeword. Fingerprints that
close share such a key: if one segment is equal, through the nearby codewords of the
other; if each has one error, through the codeword of either. Keys are of distinct
fingerprints only, so copies cost nothing, and the fingerprints that share a key are
compared bit by bit.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txclean.llm.common import in_slices, narrow, text_of
from txclean.llm.golay import nearby
from txclean.llm.graph import bucket_links, connected_components
from txclean.shared import shared_table

#: Width of each segment; a segment is padded to the code's 23 bits.
SEGMENTS = (22, 21, 21)
#: Differing bits up to which the keys find every pair.
MOST_BITS = 4


def fingerprint(text: str, words_per_shingle: int = 4) -> int:
    """Majority of the XXH64 (seed 42) of all shingles of the text, bit by bit."""
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    k = min(words_per_shingle, len(words))
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - [len(w) + 1 for w in words])[: len(words) - k + 1].tolist()
    stops = (ends - 1)[k - 1 :].tolist()
    hashed = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    step = 65_536
    for at in range(0, len(starts), step):
        h = np.array(
            [
                hashed(joined[s:e], 42)
                for s, e in zip(starts[at : at + step], stops[at : at + step], strict=True)
            ],
            np.uint64,
        )
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(counts * 2 > len(starts), bitorder="little")
    return int(majority.view(np.uint64)[0])


def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every key of each fingerprint: 11 for a pair of segments at most."""
    own, near = [], []
    shift = 0
    for width in SEGMENTS:
        word = (prints >> np.uint64(shift) & np.uint64((1 << width) - 1)).astype(np.int64)
        first, six = nearby(word)
        own.append(first.astype(np.int64))
        near.append(six.astype(np.int64))
        shift += width
    rows, keys = [], []
    for pair, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
        a = np.where(near[j] < 0, -1, (pair << 24) | (own[i][:, None] << 12) | near[j])
        b = np.where(near[i] < 0, -1, (pair << 24) | (near[i] << 12) | own[j][:, None])[:, 1:]
        both = np.concatenate([a, b], axis=1)
        row, column = np.nonzero(both >= 0)
        rows.append(row)
        keys.append(both[row, column])
    return np.concatenate(rows), np.concatenate(keys)


def _near(rows, i, js):
    prints = rows["fp"].view(np.uint64)
    return np.bitwise_count(prints[js] ^ prints[i]) <= MOST_BITS


def fingerprints(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 4
) -> DataFrame:
    """doc_id and fp (64 bits as a long) of every document; 0 for one without words."""
    docs = narrow(df, doc_id=id_col, text=text_col).select("doc_id", text_of().alias("text"))

    def work(batch):
        prints = [fingerprint(t, words_per_shingle) for t in batch.column("text").to_pylist()]
        yield {"doc_id": batch.column("doc_id"), "fp": pa.array(np.array(prints, np.uint64).view(np.int64))}

    return in_slices(docs, f"doc_id {dict(docs.dtypes)['doc_id']}, fp long", work)


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 4
) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Fingerprints link at 4 differing bits or fewer; component_id is the smallest doc_id
    reachable over links, a document's own included. Null and wordless texts have
    fingerprint zero and link like others. Repeated rows are repeated in the result; an
    id that is null counts for nothing, and a component of such rows alone has none. An empty table gives none.
    """
    prints = shared_table(fingerprints(df, id_col, text_col, words_per_shingle), "fingerprints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("smallest"))

    def work(batch):
        fps = batch.column("fp").to_numpy()
        rows, keys = keys_of(fps.view(np.uint64))
        yield {"key": pa.array(keys), "fp": pa.array(fps[rows])}

    keyed = in_slices(distinct.select("fp"), "key long, fp long", work, slice_bytes=400_000)
    links = bucket_links(keyed, "fp", ["fp"], _near)
    parts = connected_components(links).withColumnRenamed("node", "fp")
    grouped = shared_table(
        distinct.join(parts, "fp", "left").select(
            "fp", "smallest", F.coalesce("component", "fp").alias("component")
        ),
        "components",
    )
    smallest = grouped.groupBy("component").agg(F.min("smallest").alias("component_id"))
    named = grouped.join(smallest, "component").select("fp", "component_id")
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
