"""SentencePiece encoding that keeps byte offsets, and decoding.

A text is first normalised as the model says: at each place the longest entry of the
compiled character map that matches is replaced, and of every byte that comes out the
place in the original is recorded. Pieces tile the normalised text, so sums of their
lengths, looked up in that record, give each piece's bytes in the original.

Ids come from the library. No piece of the vocabulary holds certain neighbours, such as
a letter followed by a word mark; a merge can't cross them, so the stretches between
them are encoded on their own and remembered, as the same words come again and again.
Which neighbours are safe is read from the vocabulary.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txclean.llm.common import forgotten_after_task, in_slices, narrow, text_of

MARK = "▁"
#: Remembered stretches of a worker before it starts afresh.
REMEMBERED = 400_000


def _fields(data: bytes):
    """(number, value) of each field of a protocol buffer message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield tag >> 3, data[at : at + size]
            at += size


class CharacterMap:
    """The compiled character map: a double-array trie and the replacements."""

    def __init__(self, compiled: bytes):
        size = struct.unpack("<I", compiled[:4])[0] if compiled else 0
        self.units = struct.unpack(f"<{size // 4}I", compiled[4 : 4 + size])
        self.texts = compiled[4 + size :]

    def longest(self, text: bytes, start: int) -> tuple[int, bytes] | None:
        """Length of the longest entry at this place, and its replacement."""
        units, best = self.units, None
        if not units:
            return None
        unit = units[0]
        node = (unit >> 10) << ((unit & 512) >> 6)
        for at in range(start, len(text)):
            byte = text[at]
            node ^= byte
            unit = units[node]
            if unit & 0x800000FF != byte:
                break
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                value = units[node] & 0x7FFFFFFF
                best = at - start + 1, self.texts[value : self.texts.index(b"\0", value)]
        return best


class Codec:
    """A model with what is needed to align its pieces with the original."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = self.library.serialized_model_proto()
        spec = dict(next((_fields(v) for n, v in _fields(proto) if n == 3), ()))
        self.map = CharacterMap(spec.get(2, b""))
        self.dummy_prefix = bool(spec.get(3, 1))
        self.trim = bool(spec.get(4, 1))
        self.mark_spaces = bool(spec.get(5, 1))
        size = self.library.get_piece_size()
        self.pieces = [self.library.id_to_piece(i) for i in range(size)]
        self.lengths = np.array(
            [
                1 if self.library.is_byte(i) else len(p.encode())
                for i, p in enumerate(self.pieces)
            ],
            np.int64,
        )
        inner = {p[i : i + 2] for p in self.pieces for i in range(len(p) - 1)}
        marked = any(pair[0] != MARK and pair[1] == MARK for pair in inner)
        broken = any("\n" in pair for pair in inner)
        plain = not self.map.units and self.dummy_prefix and self.mark_spaces and not self.trim
        bpe = next((dict(_fields(v)).get(3, 1) for n, v in _fields(proto) if n == 2), 1) == 2
        self.splits = plain and bpe and not marked and not broken and self.library.is_byte(
            self.library.piece_to_id("<0x0A>")
        )
        self.known: dict[str, tuple[int, ...]] = {}
        if self.splits:
            self.skip = len(self.library.encode("\n"))

    # Normalisation

    def normalise(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised text, and for each of its bytes, and for its end, the byte of
        the original at which what it stands for begins."""
        if not self.map.units and not self.trim:
            return self._plain(text)
        space = MARK.encode() if self.mark_spaces else b" "
        chunks: list[tuple[int, bytes]] = []  # (place in the original, what it becomes)
        at = 0
        while at < len(text):
            found = self.map.longest(text, at)
            if found is None:
                step = 1
                while at + step < len(text) and text[at + step] & 0xC0 == 0x80:
                    step += 1
                found = step, text[at : at + step]
            chunks.append((at, found[1]))
            at += found[0]
        ends = [start for start, _ in chunks[1:]] + [len(text)]
        parts = [(start, end, out) for (start, out), end in zip(chunks, ends, strict=True)]
        if self.trim:
            while parts and parts[0][2] in (b" ", b""):
                parts.pop(0)
        out, places = bytearray(), []
        if not parts:
            return b"", np.zeros(1, np.int64)
        if self.dummy_prefix:
            out += space
            places += [parts[0][0]] * len(space)
        previous_space = self.trim
        end = parts[0][0]
        for start, stop, new in parts:
            while previous_space and new.startswith(b" "):
                new = new[1:]
            if new:
                for byte in new:
                    piece = space if byte == 32 else bytes([byte])
                    out += piece
                    places += [start] * len(piece)
                end = stop
                previous_space = self.trim and new.endswith(b" ")
            elif not self.trim:
                end = stop
        if self.trim:
            while out.endswith(space):
                del out[-len(space) :]
                end = places[-len(space)]
                del places[-len(space) :]
        return bytes(out), np.array([*places, end], np.int64)

    def _plain(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The same for an empty character map, without a loop over bytes."""
        if not text:
            return b"", np.zeros(1, np.int64)
        mark = MARK.encode()
        prefix = (mark if self.mark_spaces else b" ") if self.dummy_prefix else b""
        source = np.frombuffer(text, np.uint8)
        widths = np.where(source == 32, len(mark), 1) if self.mark_spaces else np.ones(len(source), np.int64)
        places = np.repeat(np.arange(len(source)), widths)
        # Every byte of a character points to the character's first byte.
        heads = np.where((source & 0xC0) == 0x80, 0, np.arange(len(source)))
        places = np.maximum.accumulate(heads)[places]
        out = prefix + (text.replace(b" ", mark) if self.mark_spaces else text)
        return out, np.concatenate([np.zeros(len(prefix), np.int64), places, [len(text)]])

    # Encoding

    def encode(self, text: str) -> list[int]:
        if not self.splits:
            return self.library.encode(text)
        if not text:
            return []
        if len(self.known) > REMEMBERED:
            self.known.clear()
        stretches = re.findall(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n+", MARK + text.replace(" ", MARK))
        known = self.known
        for new in {s for s in stretches if s not in known}:
            if new[0] == MARK:
                known[new] = tuple(self.library.encode(new[1:])) if len(new) > 1 else tuple(
                    self.library.encode("\n")[: self.skip - 1]
                )
            else:
                known[new] = tuple(self.library.encode("\n" + new)[self.skip :])
        return list(chain.from_iterable(map(known.__getitem__, stretches)))

    def spans(self, text: bytes, ids: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of each piece in the bytes of the original."""
        normal, places = self.normalise(text)
        lengths = self.lengths[np.asarray(ids, np.int64)] if len(ids) else np.zeros(0, np.int64)
        unknown = np.flatnonzero(np.asarray(ids) == self.library.unk_id()) if len(ids) else ()
        if len(unknown):
            lengths = self._with_unknown(normal, ids, lengths)
        ends = np.cumsum(lengths)
        if (ends[-1] if len(ends) else 0) != len(normal):
            raise ValueError("pieces do not tile the normalised text")
        return places[ends - lengths], places[ends]

    def _with_unknown(self, normal: bytes, ids, lengths) -> np.ndarray:
        """Lengths where a model without byte pieces has unknown ones: each runs up to
        the next piece that is known."""
        out, at = lengths.copy(), 0
        for k, i in enumerate(ids):
            if i != self.library.unk_id():
                at += int(out[k])
                continue
            nxt = self.pieces[ids[k + 1]].encode() if k + 1 < len(ids) else None
            end = normal.index(nxt, at + 1) if nxt else len(normal)
            out[k], at = end - at, end
        return out

    def decode(self, ids: Sequence[int]) -> str:
        return self.library.decode(list(ids))


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    made = Codec(path)
    forgotten_after_task(made.known)
    return made


COLUMNS = {
    "ids": "array<int>",
    "begins": "array<long>",
    "ends": "array<long>",
    "decoded": "string",
    "n_tokens": "long",
    "covered_bytes": "long",
    "ids_sha256": "string",
    "decoded_sha256": "string",
}


def encode_documents(
    df: DataFrame,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    columns: Sequence[str] = ("ids", "begins", "ends", "decoded"),
) -> DataFrame:
    """One row per document: doc_id and the wanted `columns` of COLUMNS.

    `ids` without begin or end marks; `begins` and `ends` in bytes of the original;
    `decoded` by the library; `covered_bytes`, the length of the union of the pieces'
    byte spans; digests as lowercase hex. Null texts count as empty and have no piece. Rows are
    independent, so repeated rows and ids are simply repeated. `model_path` is read on
    the executors.
    """
    wanted = list(columns)
    if unknown := set(wanted) - set(COLUMNS):
        raise ValueError(f"unknown columns {sorted(unknown)}")
    docs = narrow(df, doc_id=id_col, text=text_col).select("doc_id", text_of().alias("text"))
    kind = dict(docs.dtypes)["doc_id"]

    def one(model: Codec, text: str) -> dict:
        ids = model.encode(text)
        row: dict = {"ids": ids, "n_tokens": len(ids)}
        if {"begins", "ends", "covered_bytes"} & set(wanted):
            begins, ends = model.spans(text.encode(), ids)
            row |= {"begins": begins, "ends": ends}
            # Pieces that share a character overlap; the union is one pass.
            before = np.concatenate([[0], np.maximum.accumulate(ends)[:-1]]) if len(ends) else ends
            row["covered_bytes"] = int(np.maximum(ends - np.maximum(begins, before), 0).sum())
        if "ids_sha256" in wanted:
            row["ids_sha256"] = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        if {"decoded", "decoded_sha256"} & set(wanted):
            row["decoded"] = text_out = model.decode(ids)
            row["decoded_sha256"] = hashlib.sha256(text_out.encode()).hexdigest()
        return row

    def work(batch):
        model = codec(model_path)
        rows = [one(model, text) for text in batch.column("text").to_pylist()]
        yield {"doc_id": batch.column("doc_id")} | {c: [r[c] for r in rows] for c in wanted}

    schema = ", ".join([f"doc_id {kind}", *(f"{c} {COLUMNS[c]}" for c in wanted)])
    return in_slices(docs, schema, work, slice_bytes=2_000_000)
