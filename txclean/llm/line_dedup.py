"""Lines that repeat, exactly or nearly, across all documents.

Lines are normalised to lower-case words. The SimHash of a line has blocks of 64 bits, and
each different word votes in one block only, which its own hash picks. So a changed word touches two blocks at
most, and by the pigeonhole principle lines that differ in fewer words than half the blocks
agree in a block whole; only where light blocks are joined, a changed word may move the joints behind it. Blocks
are join keys: the fingerprint proposes lines, and edit similarity alone decides, text by
text. One occurrence of each connected group stays, the first by document id and place.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txclean.llm.common import in_slices, text_of, unused, with_columns_by_slice
from txclean.llm.graph import bucket_links, connected_components
from txclean.shared import shared_table

WORD = re.compile(r"[^\W_]+")
SIMILARITY = 0.8
#: (length, blocks, letters): lines of so many characters or more have so many blocks, and a
#: block of fewer letters is joined with the next, as common words alone would meet everywhere.
TIERS = ((0, 4, 10), (80, 4, 16), (250, 8, 18))
#: Lines with fewer words stay unless the caller asks for less; the query and the stage ask for 1.
LEAST_WORDS = 3
#: So many bytes of 0 and 1 add up without a carry into the next.
STRETCH = 255
#: Letters and digits of Latin-1 as they are in lower case, a space for all else but line feeds.
PLAIN = bytes(ord(c.lower()) if WORD.match(c) or c == "\n" else 32 for c in map(chr, range(256)))


def normalised(line: str) -> list[str]:
    return WORD.findall(line.lower())


def spaced(text: str) -> list[str]:
    """The lines of a text, each as its normalised words with spaces around them."""
    try:
        return text.encode("latin-1").translate(PLAIN).decode("latin-1").split("\n")
    except UnicodeEncodeError:
        if "\n" in text:
            return [line for part in text.split("\n") for line in spaced(part)]
        return [" ".join(normalised(text))]


def majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Of neighbouring hashes, `sizes` of them each time, the bits that more than half have set.

    All blocks count at once, bit by bit, in planes of numbers: counters begin so far below an
    overflow that it comes when a bit has its majority. Blocks beyond STRETCH are left to `votes`.
    """
    out = np.zeros(len(sizes), np.uint64)
    starts = np.cumsum(sizes) - sizes
    low = 0
    for high in (15, STRETCH):
        blocks = np.flatnonzero((sizes > low) & (sizes <= high))
        low = high
        if not len(blocks):
            continue
        blocks = blocks[np.argsort(-sizes[blocks], kind="stable")]
        size, start = sizes[blocks], starts[blocks]
        left = high - (size >> 1)
        planes = [(-(left >> i & 1)).view(np.uint64) for i in range(high.bit_length())]
        over = np.zeros(len(blocks), np.uint64)
        still = len(blocks) - np.cumsum(np.bincount(size))  # blocks with more than so many hashes
        for n in range(size[0]):
            m = still[n]
            carry = hashes[start[:m] + n]
            for plane in planes:
                now = plane[:m]
                up = now & carry
                now ^= carry
                carry = up
            over[:m] |= carry
        out[blocks] = over
    large = sizes > STRETCH
    if large.any():
        number = np.flatnonzero(np.repeat(large, sizes))
        bits = np.unpackbits(hashes[number].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").view(np.uint64)
        out[large] = votes(bits, np.arange(len(number)), sizes[large])
    return out


def votes(bits: np.ndarray, number: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sign, bit by bit, of the sum of the hashes' bits of neighbouring words, `sizes` of them each time.

    `bits`: of each distinct word, its hash's bits, a byte each, eight bytes to a number.
    """
    # Stretches are added up first, some at a time, and then the stretches of a block.
    pieces = -(-sizes // STRETCH)
    heads = np.cumsum(pieces) - pieces
    within_block = np.arange(pieces.sum()) - np.repeat(heads, pieces)
    begins = np.repeat(np.cumsum(sizes) - sizes, pieces) + within_block * STRETCH
    ends = np.append(begins[1:], len(number))
    sums = np.empty((len(begins), 8), np.uint64)
    at = 0
    while at < len(begins):
        first = begins[at]
        stop = max(at + 1, int(np.searchsorted(ends, first + 200_000, "right")))
        np.add.reduceat(bits[number[first : ends[stop - 1]]], begins[at:stop] - first, axis=0, out=sums[at:stop])
        at = stop
    counts = sums.view(np.uint8)
    if len(begins) == len(sizes):
        most = counts > (sizes >> 1).astype(np.uint8)[:, None]
    else:
        most = np.add.reduceat(counts, heads, axis=0, dtype=np.int64) > (sizes >> 1)[:, None]
    return np.packbits(most, axis=1, bitorder="little").view(np.uint64)[:, 0]


def block_keys(lines: pa.ListArray | list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Places of lines, ascending within a tier, and their keys, one for each block of a line.

    A line has the blocks of its tier, and those of the next tier if a line that is similar
    may be long enough for it. No line is empty.
    """
    import xxhash

    lines = lines if isinstance(lines, pa.Array) else pa.array(lines, pa.list_(pa.string()))
    words = lines.flatten().dictionary_encode()
    number = words.indices.to_numpy()
    distinct = words.dictionary.to_numpy(zero_copy_only=False)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct))
    letters = pc.utf8_length(words.dictionary).to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = pc.list_value_length(lines).to_numpy(zero_copy_only=False).astype(np.int64)
    line = np.repeat(np.arange(len(lines)), sizes)
    length = np.bincount(line, letters[number], len(lines)) + sizes - 1
    # Each different word of a line votes once, or a common word would settle its block alone.
    shift = len(hashed).bit_length()
    once = np.sort(line << shift | number)
    once = once[np.append(True, once[1:] != once[:-1])]
    line, number = once >> shift, once & (1 << shift) - 1
    places, keys = [], []
    for tier, (low, blocks, least) in enumerate(TIERS):
        high = TIERS[tier + 1][0] if tier + 1 < len(TIERS) else np.inf
        lines_here = np.flatnonzero((length < high) & (length >= low * SIMILARITY))
        if not len(lines_here):
            continue
        here = np.zeros(len(lines), bool)
        here[lines_here] = True
        used = here[line]
        word, own = number[used], (np.cumsum(here) - 1)[line[used]]
        block = ((hashed >> np.uint64(40)).astype(np.int64) % blocks)[word]
        weight = np.bincount(own * blocks + block, letters[word], len(lines_here) * blocks).reshape(-1, blocks)
        # Blocks in order, joined until they are heavy enough; what is left at the end has no key.
        part = np.empty(weight.shape, np.int64)
        last = np.full(weight.shape, blocks)
        held, count, row = np.zeros(len(weight)), np.zeros(len(weight), np.int64), np.arange(len(weight))
        for b in range(blocks):
            held += weight[:, b]
            part[:, b] = count
            full = held >= least
            last[row[full], count[full]] = b
            count += full
            held[full] = 0
        count = np.maximum(count, 1)  # a light line is one block
        part = part[own, block]
        voting = part < count[own]
        cell = ((np.cumsum(count) - count)[own] + part)[voting]
        # Words by block: a sort of both in one number takes a third of the time of an order.
        together = np.sort(cell << shift | word[voting]) & (1 << shift) - 1
        found = majority(hashed[together], np.bincount(cell))
        salt = last[np.arange(blocks) < count[:, None]] + 64 * tier + 1
        places.append(np.repeat(lines_here, count))
        keys.append((found + salt.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64))
    return np.concatenate(places), np.concatenate(keys)


def within(a: str, b: str, most: int) -> bool:
    """Whether the edit distance is at most `most` (Myers' bit vectors, left as soon as it can't be)."""
    if abs(len(a) - len(b)) > most:
        return False
    start = 0
    upto = min(len(a), len(b))
    while start < upto and a[start] == b[start]:
        start += 1
    end = 0
    while end < upto - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[start : len(a) - end], b[start : len(b) - end]
    if not a or not b:
        return max(len(a), len(b)) <= most
    places: dict[str, int] = {}
    for at, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << at
    full, plus, minus = (1 << len(a)) - 1, (1 << len(a)) - 1, 0
    size = -(-len(a) // 8)
    left = len(a) - np.arange(len(a) + 1)  # letters of a after each row
    n = 0
    while n < len(b):
        # No column before `most` can rule a match out; then one in a few is looked at.
        stop = min(len(b), n + most // 8 + 1 if n else most + 1)
        for c in b[n:stop]:
            eq = places.get(c, 0)
            across = eq | minus
            eq |= ((eq & plus) + plus & full) ^ plus
            up = (minus | full ^ (eq | plus)) << 1 & full | 1
            down = (plus & eq) << 1 & full
            plus = down | full ^ (across | up)
            minus = up & across
        n = stop
        rise = np.frombuffer(plus.to_bytes(size, "little") + minus.to_bytes(size, "little"), np.uint8)
        rise = np.unpackbits(rise.reshape(2, -1), axis=1, bitorder="little")[:, : len(a)].view(np.int8)
        column = np.concatenate([[n], n + np.cumsum(rise[0] - rise[1], dtype=np.int64)])
        # From each row at least the difference of what is left is still to pay.
        if (column + np.abs(left - (len(b) - n))).min() > most:
            return False
    return True


def walked(a: list[str], b: list[str], most: int) -> bool:
    """Whether one walk along the words changes a to b by at most `most` characters.

    The walk is some way of editing, seldom the shortest: True proves a distance, False nothing.
    """
    i = j = cost = 0
    while i < len(a) and j < len(b) and cost <= most:
        if a[i] != b[j]:
            after_a, after_b = a[i + 1 : i + 2], b[j + 1 : j + 2]
            if after_a != after_b and after_a == [b[j]]:
                cost += len(a[i]) + 1
                j -= 1
            elif after_a != after_b and after_b == [a[i]]:
                cost += len(b[j]) + 1
                i -= 1
            else:
                cost += max(len(a[i]), len(b[j]))
        i += 1
        j += 1
    return cost + sum(len(w) + 1 for w in a[i:] + b[j:]) <= most


def similar(a: str, b: str, similarity: float = SIMILARITY) -> bool:
    most = int(max(len(a), len(b)) * (1 - similarity) + 1e-9)
    if abs(len(a) - len(b)) > most:
        return False
    return walked(a.split(" "), b.split(" "), most) or within(a, b, most)


def _near(rows, i, js):
    texts = rows["norm"]
    own = np.broadcast_to(i, js.shape)
    return np.array([similar(texts[a], texts[b]) for a, b in zip(own.tolist(), js.tolist(), strict=True)], bool)


def _near_apart(rows, i, js):
    hit = rows["grp"][js] != rows["grp"][i]
    at = np.flatnonzero(hit)
    hit[at] = _near(rows, np.broadcast_to(i, js.shape)[at], js[at])
    return hit


def dedup_lines(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS
) -> DataFrame:
    """All columns of `df`, its text without the repeated lines, and `__lines`,
    `__dropped`: how many it had and lost (under further underscores if `df` has such columns).

    Lines end at line feeds. Two lines are linked if their words, joined by one space, have
    an edit similarity (1 less distance over the longer length) of 0.8 or more and their SimHashes
    agree in a block; equal words are linked. Lines with fewer than
    `least_words` words stay; with 1 only those without letters and digits do. A null text stays null and has no line. Rows with a null id
    neither lose lines nor count. Rows that repeat an id and a text are one document and
    lose the same lines. An empty table gives none.
    """
    rows = df.select(F.col(f"`{id_col}`").alias("doc_id"), text_of(f"`{text_col}`").alias("text")).select(
        "doc_id", F.xxhash64("text").alias("row"), "text"
    )
    kind = dict(rows.dtypes)["doc_id"]

    def cut(batch):
        import xxhash

        held, which = [], []
        known: dict[str, int] = {}  # a line's place among the distinct ones
        for text in batch.column("text").to_pylist():
            lines = spaced(text)
            held.append(len(lines))
            for line in lines:
                which.append(known.setdefault(line, len(known)))
        at = np.repeat(np.arange(len(held)), held)
        line_no = np.arange(len(at)) - np.repeat(np.cumsum(held) - held, held)
        words = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pa.array(known, pa.string())))
        # What is split from an empty line is one empty word.
        long = pc.list_value_length(words).to_numpy(zero_copy_only=False) >= max(least_words, 1)
        long &= pc.not_equal(pc.list_element(words, 0), "").to_numpy(zero_copy_only=False)
        if long.any():
            words = words.filter(pa.array(long))
            place, which = np.cumsum(long) - 1, np.array(which)
            taken = long[which]
            same, which = pa.array(at[taken]), place[which[taken]]
            joined = pc.binary_join(words, " ").to_numpy(zero_copy_only=False)
            hashed = np.array([xxhash.xxh3_64_intdigest(line) for line in joined], np.uint64)
            owner, keys = block_keys(words)
            ends = np.append(0, np.cumsum(np.bincount(owner, minlength=len(words))))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys[np.argsort(owner, kind="stable")]))
            # The keys of a line stand at its first occurrence in the slice.
            later = np.ones(len(which), bool)
            later[np.unique(which, return_index=True)[1]] = False
            yield {
                "doc_id": batch.column("doc_id").take(same),
                "row": batch.column("row").take(same),
                "line_no": pa.array(line_no[taken], pa.int32()),
                "line": pa.array(hashed[which].view(np.int64)),
                "keys": lists.take(pa.array(which, mask=later)),
            }

    found = shared_table(
        in_slices(
            rows.where("doc_id IS NOT NULL"),
            f"doc_id {kind}, row long, line_no int, line long, keys array<long>",
            cut,
        ),
        "lines",
    )
    place = F.struct("doc_id", "line_no", "row")
    distinct = shared_table(
        found.groupBy("line").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times")), "distinct-lines"
    )
    keyed = found.select("line", F.explode("keys").alias("key"))
    shared = shared_table(
        keyed.groupBy("key")
        .agg(F.min("line").alias("low"), F.max("line").alias("high"), F.count(F.lit(1)).alias("size"))
        .where("low < high")
        .select("key", "size"),
        "shared-keys",
    )
    close = (
        keyed.join(shared, "key")
        .groupBy("line")
        .agg(F.max(F.struct("size", "key"))["key"].alias("key"), F.collect_set("key").alias("keys"))
    )
    # Texts of the lines that share a key with another, each read at its first occurrence.
    wanted = (
        distinct.join(close, "line")
        .select("line", "key", "keys", "first.*")
        .groupBy("doc_id", "row")
        .agg(F.collect_list(F.struct("line_no", "line", "key", "keys")).alias("wanted"))
    )

    def read(batch):
        # A copy of a document holds the same lines, which are read once here; a line that is read
        # again elsewhere is linked with itself and changes nothing.
        wanted = batch.column("wanted")
        lines, sizes = wanted.flatten(), pc.list_value_length(wanted).to_numpy(zero_copy_only=False)
        fresh = np.sort(np.unique(lines.field("line").to_numpy(), return_index=True)[1])
        lines, owner = lines.take(pa.array(fresh)), np.repeat(np.arange(len(sizes)), sizes)[fresh]
        texts, norm, last = batch.column("text"), [], -1
        for row, n in zip(owner.tolist(), lines.field("line_no").to_pylist(), strict=True):
            if row != last:
                split, last = texts[row].as_py().split("\n"), row
            norm.append(" ".join(spaced(split[n])[0].split()))
        yield {c: lines.field(c) for c in ("key", "line", "keys")} | {"norm": norm}

    texts = shared_table(
        in_slices(
            rows.join(wanted, ["doc_id", "row"]),
            "key long, line long, keys array<long>, norm string",
            read,
        ),
        "close-lines",
    )
    # Each line is compared under its most common key first. Another key matters only
    # where it holds lines that are not in one group by then.
    first = bucket_links(texts.select("key", "line", "norm"), "line", ["norm"], _near)
    grouped = texts.join(connected_components(first).withColumnRenamed("node", "line"), "line", "left").select(
        "line", "norm", F.coalesce("component", "line").alias("grp"), F.explode("keys").alias("key")
    )
    mixed = (
        grouped.groupBy("key").agg(F.min("grp").alias("low"), F.max("grp").alias("high")).where("low < high").select("key")
    )
    second = bucket_links(grouped.join(mixed, "key"), "line", ["grp", "norm"], _near_apart)
    parts = connected_components(first.unionByName(second)).withColumnRenamed("node", "line")
    # A line that stands once and is linked to none repeats nothing.
    named = (
        distinct.join(parts, "line", "left")
        .where("times > 1 OR component IS NOT NULL")
        .withColumn("grp", F.coalesce("component", "line"))
    )
    kept = named.groupBy("grp").agg(F.min("first").alias("keep"), F.sum("times").alias("all_times"))
    repeated = shared_table(
        named.join(kept.where("all_times > 1"), "grp").select("line", "keep"), "repeated-lines"
    )
    ident, digest, drop, n_lines, n_dropped = (
        unused(df, c) for c in ("__id", "__row", "__drop", "__lines", "__dropped")
    )
    dropped = (
        found.join(repeated, "line")
        .where(place != F.col("keep"))
        .groupBy("doc_id", "row")
        .agg(F.collect_set("line_no").alias(drop))
        .select(F.col("doc_id").alias(ident), F.col("row").alias(digest), drop)
    )
    whole = df.join(
        dropped,
        (df[f"`{id_col}`"] == dropped[ident]) & (F.xxhash64(text_of(f"`{text_col}`")) == dropped[digest]),
        "left",
    ).select(*(f"`{c}`" for c in df.columns), drop)

    def work(batch):
        texts, lines, lost = [], [], []
        for text, gone in zip(batch.column(text_col).to_pylist(), batch.column(drop).to_pylist(), strict=True):
            split = text.split("\n") if text is not None else []
            gone = set(gone or ())
            texts.append("\n".join(s for n, s in enumerate(split) if n not in gone) if text is not None else None)
            lines.append(len(split))
            lost.append(len(gone))
        return {text_col: pa.array(texts, batch.schema.field(text_col).type), n_lines: lines, n_dropped: lost}

    return with_columns_by_slice(whole, f"`{n_lines}` int, `{n_dropped}` int", work).drop(drop)
