"""Alignment of two tokenizers' tokens over the same bytes, and counts of linked ids.

Both token lists of a text tile the same bytes, so each is a list of byte ends. The shorter
list drives: each of its ends is looked for in the longer one from the last place found, by
steps that double and then by halving. Ends found in both cut the tokens into groups, and
the places of two ends that follow each other are the range of tokens which the token between
them overlaps: its links.

Both tokenizers end a token before a space that follows something else, which is checked
from their files. Texts are cut there, and a stretch that comes again is aligned once. The
corpus-wide counts meet the documents by slices: a slice of documents has one list of its
different id pairs, whose counts are added up over all slices and joined back to each
slice, so neither links nor pairs of a text are ever rows of their own.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txclean.llm.common import in_slices, narrow, text_of
from txclean.llm.sentencepiece_codec import MARK, codec
from txclean.shared import shared_table

#: Stretches that end where both tokenizers end a token: before a space that follows
#: neither white space nor a word mark.
STRETCH = re.compile(rf"[\s{MARK}]*(?:[^ ]+(?:(?<=[\s{MARK}]) +(?:[^ ]+|$))*)?")
#: Characters below this are read alike by both libraries for byte-level vocabularies (tested one by one).
PLAIN = re.compile("[\x00-ɏ]*")
#: Characters of remembered stretches of a worker before it starts afresh.
REMEMBERED = 1_500_000
#: Ends of a lane that are looked for one after the other, beside the other lanes.
LANE = 64
#: Id pairs of a row of a slice's list.
CHUNK = 50_000


def gallop(longer: np.ndarray, wanted: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each wanted end the first place at or behind its start in the sorted list
    `longer` that isn't less: steps double until one goes too far, then the last one is halved."""
    low, high = start - 1, start.copy()
    active = np.flatnonzero(longer[high] < wanted)
    step = 1
    while len(active):
        low[active] = high[active]
        high[active] = np.minimum(high[active] + step, len(longer) - 1)
        active = active[longer[high[active]] < wanted[active]]
        step *= 2
    active = np.flatnonzero(high - low > 1)
    while len(active):
        middle = (low[active] + high[active]) // 2
        less = longer[middle] < wanted[active]
        low[active[less]] = middle[less]
        high[active[~less]] = middle[~less]
        active = active[high[active] - low[active] > 1]
    return high


def places(shorter: np.ndarray, counts: np.ndarray, longer: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Place in `longer` of each end of `shorter`, which holds `counts` ends of each text; a
    text's ends begin at `starts` in `longer`. Lists are cut into lanes that go on side by side."""
    first = np.cumsum(counts) - counts
    lanes = -(-counts // LANE)
    place_in_text = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    head = np.repeat(first, lanes) + place_in_text * LANE
    size = np.minimum(np.repeat(first + counts, lanes) - head, LANE)
    found = np.empty(len(shorter), np.int64)
    last = gallop(longer, shorter[head], np.repeat(starts, lanes))
    found[head] = last
    for step in range(1, int(size.max(initial=0))):
        going = size > step
        head, size, last = head[going], size[going], last[going]
        last = gallop(longer, shorter[head + step], last)
        found[head + step] = last
    return found


def aligned(a_ends: np.ndarray, a_counts: np.ndarray, b_ends: np.ndarray, b_counts: np.ndarray):
    """Links and common ends of many texts, whose ends follow each other in both lists.

    Returns (a, b) of each link, as places in the lists and in the order of the texts and of
    bytes, and the places in both lists at which a group ends.
    """
    a_first, b_first = np.cumsum(a_counts) - a_counts, np.cumsum(b_counts) - b_counts
    parts, cuts = [], []
    for driver in (0, 1):
        chosen = np.flatnonzero((a_counts <= b_counts) if driver == 0 else (a_counts > b_counts))
        ends, counts, first = (a_ends, a_counts, a_first) if driver == 0 else (b_ends, b_counts, b_first)
        other, other_first = (b_ends, b_first) if driver == 0 else (a_ends, a_first)
        counts = counts[chosen]
        if not counts.sum():
            continue
        begin = np.cumsum(counts) - counts
        own = np.arange(counts.sum()) - np.repeat(begin - first[chosen], counts)
        high = places(ends[own], counts, other, other_first[chosen])
        common = other[high] == ends[own]
        # A token overlaps from the end found before it, or behind it if that was common.
        low = np.concatenate([[0], high[:-1] + common[:-1]])
        low[begin] = other_first[chosen]
        width = high - low + 1
        mine = np.repeat(own, width)
        theirs = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width - low, width)
        parts.append((mine, theirs) if driver == 0 else (theirs, mine))
        cuts.append((own[common], high[common]) if driver == 0 else (high[common], own[common]))
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    a, b = (np.concatenate(p) for p in zip(*parts, strict=True))
    a_cut, b_cut = (np.sort(np.concatenate(c)) for c in zip(*cuts, strict=True))
    order = np.argsort(a, kind="stable")  # of two sorted runs
    return a[order], b[order], a_cut, b_cut


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable Latin ones
    for themselves, the others for letters from U+0100 in their order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(rest)}


class ByteLevel:
    """A byte-level tokenizer from its .json file; special strings are ordinary text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.library.no_truncation()
        self.library.no_padding()
        letters = _byte_letters()
        vocab: dict[str, int] = spec["model"]["vocab"]
        added = {t["id"]: t["content"] for t in spec.get("added_tokens", [])}
        self.bytes = [b""] * (max([*vocab.values(), *added]) + 1)
        for token, number in vocab.items():
            if number not in added:
                self.bytes[number] = bytes(letters[c] for c in token)
        for number, content in added.items():
            self.bytes[number] = content.encode()
        before = spec.get("pre_tokenizer") or {}
        self.splits = (
            before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and not spec.get("normalizer")
        )
        self.quick = self._ranked(spec["model"], vocab, added) if self.splits else None

    def _ranked(self, model: dict, vocab: dict[str, int], added: dict):
        """The same vocabulary in a quicker library, which merges by rank: only where the
        merges come in the order of the ids they give."""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        made = [vocab.get(a + b, -1) for a, b in pairs]
        single = {i for t, i in vocab.items() if len(t) == 1}
        ordered = all(x < y for x, y in zip(made, made[1:], strict=False)) and len(single) == 256
        whole = set(made) | single | set(added) >= set(vocab.values())
        if not (ordered and whole and made and max(single) < made[0]) or model.get("ignore_merges") or model.get("dropout"):
            return None
        import tiktoken

        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        ranks = {self.bytes[i]: i for i in vocab.values() if i not in added}
        return tiktoken.Encoding("ranked", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self.quick is None:
            return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        ids = [self.quick.encode_ordinary(t) if PLAIN.fullmatch(t) else None for t in texts]
        odd = [t for t, i in zip(texts, ids, strict=True) if i is None]
        rest = iter(self.library.encode_batch_fast(odd, add_special_tokens=False) if odd else ())
        return [next(rest).ids if i is None else i for i in ids]


class Pieces:
    """A sentencepiece model, with the bytes of its pieces."""

    def __init__(self, path: str):
        model = codec(path)
        self.library, self.splits = model.library, model.splits
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self.library.is_byte(i) else p.replace(MARK, " ").encode()
            for i, p in enumerate(model.pieces)
        ]
        self.blank = list(self.library.encode("\n"))[: model.skip - 1] if self.splits else []

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts that begin with the space which the model adds."""
        return [
            ids if len(t) > 1 or not self.splits else self.blank
            for t, ids in zip(texts, self.library.encode([t[1:] for t in texts], num_threads=1), strict=True)
        ]


class Aligner:
    """Alignment of stretches, remembered."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self.splits = self.a.splits and self.b.splits
        self.widths = [np.array([len(b) for b in t.bytes], np.int64) for t in (self.a, self.b)]
        self.names = [f"{i}{m}" for i in range(max(map(len, self.widths))) for m in ",|;"]
        self.many = len(self.b.bytes)
        self.known: dict[str, tuple | None] = {}
        self.held = 0

    def stretches(self, text: str) -> list[str]:
        """The text behind a space, cut where both end a token."""
        if not self.splits:
            return [" " + text]
        found = STRETCH.findall(" " + text)
        if found and not found[-1]:
            found.pop()
        return found

    def learn(self, stretches: dict[str, None]) -> None:
        """Align those that aren't known: (tokens of a, of b, groups, groups as text, links
        as numbers a * ids of b + b), or None where the tokens' bytes aren't the stretch's."""
        if self.held > REMEMBERED:
            # What this slice holds too is kept.
            self.known = {s: self.known[s] for s in stretches if s in self.known}
            self.held = sum(map(len, self.known))
        new = [s for s in stretches if s not in self.known]
        self.held += sum(map(len, new))
        ids = [self.a.encode(new), self.b.encode(new)] if new else [[], []]
        if not self._given_back(new, ids):
            for n in range(len(new) - 1, -1, -1):
                if not self._given_back([new[n]], [[i[n]] for i in ids]):
                    self.known[new[n]] = None
                    del new[n], ids[0][n], ids[1][n]
        if not new:
            return
        flat, counts = zip(*map(self._flat, ids), strict=True)
        ends = [np.cumsum(w[f]) for w, f in zip(self.widths, flat, strict=True)]
        a, b, a_cut, b_cut = aligned(ends[0], counts[0], ends[1], counts[1])
        links = (flat[0][a] * self.many + flat[1][b]).tobytes()
        # All tokens in the order of the groups' text, each with the mark that follows it.
        a_place, b_place = np.arange(len(flat[0])), np.arange(len(flat[1]))
        b_before, a_before = np.concatenate([[0], b_cut + 1]), a_cut + 1
        a_mark, b_mark = np.zeros(len(a_place), np.int64), np.zeros(len(b_place), np.int64)
        a_mark[a_cut], b_mark[b_cut] = 1, 2
        order = np.empty(len(a_place) + len(b_place), np.int64)
        order[a_place + b_before[np.searchsorted(a_cut, a_place)]] = flat[0] * 3 + a_mark
        order[b_place + a_before[np.searchsorted(b_cut, b_place)]] = flat[1] * 3 + b_mark
        marked = list(map(self.names.__getitem__, order.tolist()))
        a_ends = np.cumsum(counts[0])
        token_at = [0, *(a_ends + np.cumsum(counts[1])).tolist()]
        link_at = [0, *(np.searchsorted(a, a_ends) * 8).tolist()]
        group_at = np.concatenate([[0], np.searchsorted(a_cut, a_ends)])
        sizes = zip(counts[0].tolist(), counts[1].tolist(), np.diff(group_at).tolist(), strict=True)
        for n, (stretch, size) in enumerate(zip(new, sizes, strict=True)):
            groups = "".join(marked[token_at[n] : token_at[n + 1]])[:-1]
            self.known[stretch] = (*size, groups, links[link_at[n] : link_at[n + 1]])

    @staticmethod
    def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        return np.fromiter(chain.from_iterable(ids), np.int64), np.fromiter(map(len, ids), np.int64, len(ids))

    def _given_back(self, texts: list[str], ids: list[list[list[int]]]) -> bool:
        """Whether the bytes of the tokens are those of each text."""
        whole = [t.encode() for t in texts]
        together, stops = b"".join(whole), np.cumsum([0, *map(len, whole)])
        for tokens, widths, own in zip((self.a, self.b), self.widths, ids, strict=True):
            if b"".join(map(tokens.bytes.__getitem__, chain.from_iterable(own))) != together:
                return False
            flat, counts = self._flat(own)
            running = np.concatenate([[0], np.cumsum(widths[flat])])
            if (running[np.concatenate([[0], np.cumsum(counts)])] != stops).any():
                return False
        return True

    def whole_differs(self, text: str) -> bool:
        """Whether the bytes of all tokens, joined, aren't the text's."""
        whole = " " + text
        return any(
            b"".join(map(t.bytes.__getitem__, t.encode([whole])[0])) != whole.encode() for t in (self.a, self.b)
        )


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def _slice_rows(model: Aligner, texts: list[str], names: pa.Array, with_groups: bool) -> dict:
    """Columns of one slice: a row for each document, then rows with the id pairs."""
    cut = [model.stretches(t) if t else [] for t in texts]
    different = dict.fromkeys(chain.from_iterable(cut))
    model.learn(different)
    if bad := {s for s in different if model.known[s] is None}:
        for n, text in enumerate(texts):
            if not bad.isdisjoint(cut[n]):
                # Only if the whole text differs too has it no tokens; else it is one stretch.
                cut[n] = [] if model.whole_differs(text) else [" " + text]
                model.learn(dict.fromkeys(cut[n]))
        different = dict.fromkeys(chain.from_iterable(cut))
    kept = list(map(model.known.__getitem__, different))
    number = {s: n for n, s in enumerate(different)}
    stops = np.cumsum([0, *map(len, cut)])
    used = np.fromiter(map(number.__getitem__, chain.from_iterable(cut)), np.uint32, int(stops[-1]))
    own = np.array([(f[0], f[1], f[2], len(f[4]) // 8) for f in kept], np.int64).reshape(-1, 4)
    running = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(own[used], axis=0)])
    n_a, n_b, n_groups, n_links = ([*c] for c in (running[stops[1:]] - running[stops[:-1]]).T)
    groups = {s: f[3] for s, f in zip(different, kept, strict=True)}
    joined = (";".join(map(groups.__getitem__, stretches)) for stretches in cut)
    digest, texts_out = [], []
    for text in joined:
        digest.append(hashlib.sha256(text.encode()).hexdigest() if text else "")
        texts_out.append(text if with_groups else None)
    stretches = [used[at:to].tobytes() for at, to in zip(stops[:-1], stops[1:], strict=True)]
    links = np.frombuffer(b"".join(f[4] for f in kept), np.int64)
    sizes = own[:, 3]
    times = np.bincount(used, minlength=len(kept))
    pairs, place = np.unique(links, return_inverse=True)
    counts = np.bincount(place, weights=np.repeat(times, sizes), minlength=len(pairs)).astype(np.int64)
    docs, chunks = len(cut), max(1, -(-len(pairs) // CHUNK))
    spare, none = [None] * chunks, [None] * docs
    part = [slice(k * CHUNK, (k + 1) * CHUNK) for k in range(chunks)]
    return {
        "slice": [uuid.uuid4().hex] * (docs + chunks),
        "is_document": [True] * docs + [False] * chunks,
        "doc_id": pa.concat_arrays([names, pa.nulls(chunks, names.type)]),
        "n_a": n_a + spare, "n_b": n_b + spare, "n_groups": n_groups + spare, "n_links": n_links + spare,
        "groups_sha256": digest + spare, "groups": texts_out + spare,
        "stretches": stretches + spare,
        "first": none + [p.start for p in part],
        "pairs": none + [pairs[p] for p in part],
        "counts": none + [counts[p] for p in part],
        # The pairs of each stretch, once for a slice.
        "links": none + [place.astype(np.uint32).tobytes()] + [None] * (chunks - 1),
        "sizes": none + [sizes.astype(np.uint32).tobytes()] + [None] * (chunks - 1),
    }


def _counted(left: pa.Table, right: pa.Table) -> pa.Table:
    """What the pairs of a slice add to its documents."""
    total = np.zeros(right.num_rows, np.int64)
    best = np.zeros(right.num_rows, np.int64)
    place = right.column("place").to_numpy()
    total[place] = right.column("total").to_numpy()
    best[place] = right.column("best").to_numpy()
    holder = left.filter(pc.is_valid(left.column("links")))
    links = np.frombuffer(holder.column("links")[0].as_py(), np.uint32)
    sizes = np.frombuffer(holder.column("sizes")[0].as_py(), np.uint32).astype(np.int64)
    docs = left.filter(left.column("is_document"))
    added = {}
    for name, values in (("n_best", best), ("count_sum", total)):
        # Sums by running sums: exact, and empty lists add nothing.
        running = np.concatenate([[0], np.cumsum(values[links])])
        ends = np.cumsum(sizes)
        added[name] = running[ends] - running[ends - sizes]
    out: dict[str, list[int]] = {"n_best": [], "count_sum": []}
    for stretches in docs.column("stretches"):
        used = np.frombuffer(stretches.as_buffer(), np.uint32)
        for name, values in added.items():
            out[name].append(int(values[used].sum()))
    columns = {c: docs.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    columns |= {name: pa.array(values, pa.int64()) for name, values in out.items()}
    columns |= {c: docs.column(c) for c in ("groups_sha256", "groups")}
    return pa.table(columns)


def align_documents(
    df: DataFrame,
    path_a: str,
    path_b: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_groups: bool = False,
    slice_bytes: int = 3_500_000,
) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs): alignment of a byte-level .json tokenizer (a) with a .model (b).

    documents: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 and,
    where `with_groups`, the groups as text, one row per row of `df`. pairs: a, b, n, best: how
    many links of the corpus hold the two ids, and whether no other a is linked more often
    with that b. Null and empty texts, and texts whose tokens don't give their bytes back,
    have no tokens: zeros and ''. Repeated rows count again; no column of `df` but
    the two named is looked at. Memory of a task goes with `slice_bytes` and the longest text.
    """
    docs = narrow(df, doc_id=id_col, text=text_col).select("doc_id", text_of().alias("text"))
    kind = dict(docs.dtypes)["doc_id"]

    def work(batch):
        yield _slice_rows(
            aligner(path_a, path_b), batch.column("text").to_pylist(), batch.column("doc_id"), with_groups
        )

    table = shared_table(
        in_slices(
            docs,
            f"slice string, is_document boolean, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, "
            "groups_sha256 string, groups string, stretches binary, first long, pairs array<long>, "
            "counts array<long>, links binary, sizes binary",
            work,
            slice_bytes,
        ),
        "aligned",
    )
    many = len(Pieces(path_b).bytes)
    listed = table.where("NOT is_document").select(
        "slice", F.posexplode(F.arrays_zip("pairs", "counts")).alias("at", "p"), "first"
    ).select("slice", (F.col("first") + F.col("at")).alias("place"), F.col("p.pairs").alias("pair"), F.col("p.counts").alias("n"))
    counts = shared_table(listed.groupBy("pair").agg(F.sum("n").alias("total")), "pair-counts")
    own_b = (F.col("pair") % many).alias("b")
    highest = counts.groupBy(own_b).agg(F.max("total").alias("highest"))
    # One row for each id of b at most, so its size has the vocabulary as bound.
    known = counts.withColumn("b", own_b).join(F.broadcast(highest), "b").select(
        "pair", "total", (F.col("total") == F.col("highest")).cast("long").alias("best")
    )
    resolved = listed.select("slice", "place", "pair").join(known, "pair").select(
        F.col("slice").alias("of_slice"), "place", "total", "best"
    )
    documents = (
        table.drop("pairs", "counts", "first")
        .groupBy("slice")
        .cogroup(resolved.groupBy("of_slice"))
        .applyInArrow(
            _counted,
            f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
            "groups_sha256 string, groups string",
        )
    )
    pairs = known.select(
        F.expr(f"pair div {many}").alias("a"), own_b, F.col("total").alias("n"),
        (F.col("best") == 1).alias("best"),
    )
    return (documents if with_groups else documents.drop("groups")), pairs
