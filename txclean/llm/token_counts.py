"""Token counts, with huge texts encoded in overlapping chunks.

A chunk is encoded with the offset of each unit, a stretch between white space as the
tokenizer sees it, and its tokens. Two chunks that follow each other share an overlap;
they are spliced at a boundary which both have found: white space goes before it, and
the unit that starts there is whole and the same in both. White space is dropped by the
tokenizer before anything else looks at the text, so such a boundary can't move. If the
overlap has no such place, as within a long run without white space, it is widened and
the next chunk is encoded again from further back; at worst the rest of the text becomes one chunk.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txclean.llm.common import in_slices, narrow, text_of

#: Remembered units of a worker before it starts afresh.
REMEMBERED = 500_000


class Encoder:
    """Counts by unit, for a tokenizer that drops white space or one that does not."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.units = None
        self.known: dict[str, int] = {}
        if path.endswith(".model"):
            from txclean.llm.sentencepiece_codec import codec

            model = codec(path)
            self._count = lambda texts: [len(model.encode(t)) for t in texts]
        else:
            import json

            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            self._count = lambda texts: [
                len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            ]
            with open(path) as f:
                self.units = self._unit_pattern(json.load(f))

    @staticmethod
    def _unit_pattern(spec: dict) -> re.Pattern | None:
        """Units of a tokenizer that reads any white space as one space, keeps none of
        it in a token, and has no added token with white space; otherwise none."""

        def all_of(part, key):
            return [] if not part else part.get(key, [part])

        collapses = any(
            n.get("type") == "Replace" and n.get("pattern") == {"Regex": r"\s+"} and n.get("content") == " "
            for n in all_of(spec.get("normalizer"), "normalizers")
        )
        # What the pattern does not match is removed, and it never matches white space.
        removes = any(
            p.get("type") == "Split" and p.get("behavior") == "Removed" and p.get("invert")
            and r"[^\s" in p.get("pattern", {}).get("Regex", "")
            for p in all_of(spec.get("pre_tokenizer"), "pretokenizers")
        )
        plain = not any(
            re.search(r"\s", t["content"]) or t.get("single_word") for t in spec.get("added_tokens", [])
        )
        # The blanks on which all involved agree. Others, being rare, stay in a unit.
        return re.compile(r"[^ \t\n\r]+") if collapses and removes and plain else None

    def count(self, units: list[str]) -> list[int]:
        """Tokens of each unit; new ones are encoded in one call and remembered."""
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        if new := list({u for u in units if u not in known}):
            known.update(zip(new, self._count(new), strict=True))
        return list(map(known.__getitem__, units))

    def encode(self, text: str, base: int) -> list[tuple[int, str, int]]:
        """(offset in the document, unit, tokens) of a chunk that starts at `base`."""
        found = [(base + m.start(), m.group()) for m in self.units.finditer(text)]
        counts = self.count([u for _, u in found])
        return [(at, unit, n) for (at, unit), n in zip(found, counts, strict=True)]

    def total(self, text: str, chunk: int, overlap: int) -> int:
        if self.units is None:
            return self._count([text])[0]
        if len(text) <= chunk:
            return sum(self.count(self.units.findall(text)))
        return spliced_total(self, text, chunk, overlap)


def spliced_total(encoder: Encoder, text: str, chunk: int, overlap: int) -> int:
    """Tokens of a text from chunks of `chunk` characters that share `overlap`."""
    total, start = 0, 0
    left = encoder.encode(text[:chunk], 0)
    while start + chunk < len(text):
        end, width = start + chunk, overlap
        while True:
            begin = max(start, end - width, 0)
            # Each step goes on by half a chunk at least, however wide the overlap is,
            # and by as much again as a chunk that has grown.
            first = left[0][0] if left else begin
            upto = max(begin + chunk, end + max(chunk // 2, end - first - chunk))
            right = encoder.encode(text[begin:upto], begin)
            at = boundary(text, left, right, begin, end)
            if at is not None:
                total += sum(n for place, _, n in left if place < at)
                left, start = [x for x in right if x[0] >= at], upto - chunk
                break
            if begin == start:
                # Nothing to hold on to since the chunk's start: take the two as one.
                left, start = encoder.encode(text[first:upto], first), upto - chunk
                break
            width *= 2
    return total + sum(n for _, _, n in left)


def boundary(text, left, right, begin: int, end: int) -> int | None:
    """A place in [begin, end) where a unit starts in both chunks, behind white space,
    and ends within the left chunk, followed by white space."""
    whole = {
        at: unit
        for at, unit, _ in left
        if at > begin and at + len(unit) < end and text[at - 1].isspace()
    }
    for at, unit, _ in right:
        if at >= end:
            return None
        if whole.get(at) == unit:
            return at
    return None


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def count_tokens(
    df: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 2048,
    chunk: int = 16_384,
    overlap: int = 512,
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit.

    Counts are the library's for the whole text, without added begin or end tokens;
    special strings inside a text are read as the library does by default. Texts longer
    than `chunk` characters are encoded in chunks with `overlap`. Null texts count as
    empty. The path is read on the executors; .model files go to sentencepiece, others
    to tokenizers. A tokenizer that keeps white space encodes whole texts at once.
    """
    docs = narrow(df, doc_id=id_col, text=text_col).select("doc_id", text_of().alias("text"))
    kind = dict(docs.dtypes)["doc_id"]

    def work(batch):
        model = encoder(tokenizer_path)
        counts = [model.total(t, chunk, overlap) for t in batch.column("text").to_pylist()]
        yield {
            "doc_id": batch.column("doc_id"),
            "n_bytes": [len(t.as_py().encode()) for t in batch.column("text")],
            "n_tokens": counts,
        }

    counted = in_slices(docs, f"doc_id {kind}, n_bytes long, n_tokens long", work, slice_bytes=2_000_000)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
