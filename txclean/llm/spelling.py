"""Groups of spelling variants: words one edit apart, found along tries held as tables.

The tries are tables of edges (node, letter, and the first and last word below), one over
the words and one over the words reversed. A search state is a word, how much of it is
read, a node and the edit that was spent. Two words one edit apart have so long a prefix
or suffix in common that in one of the tries the edit comes at half the word's length or
later; so states start on a word's own path from there, and never in the crowded
branches near the root. A state takes the edge of an edit, then follows the word without
further edits: level by level the frontier is joined with the edges, and a stretch of
edges without a branch, known by what the first and last word below it have in common, is
one level. States whose node ends a word as they end theirs are neighbours.
"""

from __future__ import annotations

import zlib
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txclean.llm.common import in_slices, narrow
from txclean.shared import shared_table

#: Longer words are matched by their halves and segments instead of the tries, whose paths
#: hold a row for each letter.
TRIE_LENGTH = 64
#: So many segments of a long word, all but one of which must be equal.
SEGMENTS = 16
#: Runs of letters that can give a word.
RUN = r"[a-zÀ-ÿ]{%d,}"


def words_of(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6,
    least_count: int = 5, typo: int = 199,
) -> DataFrame:
    """(word, n): maximal runs of letters, A-Z lower-cased, one letter lost where `typo`
    divides the checksum of id and run, with at least so many letters and occurrences.

    The id is read as text, null as no text; null texts hold no word.
    """
    import re

    run = re.compile(RUN % least_length)
    docs = narrow(df, doc_id=id_col, text=text_col).where("text IS NOT NULL")
    docs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")

    def work(batch):
        found: Counter = Counter()
        for name, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            before = zlib.crc32(f"{name}:".encode())
            # Lower-casing bytes touches A-Z alone.
            for word, n in Counter(run.findall(text.encode().lower().decode())).items():
                check = zlib.crc32(word.encode(), before)
                if check % typo == 0:
                    lost = check % len(word)
                    word = word[:lost] + word[lost + 1 :]
                    if len(word) < least_length:
                        continue
                found[word] += n
        yield {"word": list(found), "n": list(found.values())}

    return (
        in_slices(docs, "word string, n long", work, slice_bytes=16_000_000)
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least_count)
    )


def _node(side: Column, prefix: Column) -> Column:
    return F.xxhash64(side, prefix)


def _part(text: str, start: Column, length: Column) -> Column:
    """Letters from a place that counts from zero."""
    return F.substring(F.col(text), start + 1, length)


def _edges(sides: DataFrame, least_depth: int) -> DataFrame:
    """(node, letter, low, high, skip): the edges below `least_depth`, the first and last
    word under each, and how many letters all words under it share."""
    below = (
        sides.select("side", "w", F.explode(F.sequence(F.lit(least_depth), F.length("w") - 1)).alias("at"))
        .select(
            _node(F.col("side"), _part("w", F.lit(0), F.col("at"))).alias("node"),
            _part("w", F.col("at"), F.lit(1)).alias("letter"),
            "w",
        )
        .groupBy("node", "letter")
        .agg(F.min("w").alias("low"), F.max("w").alias("high"))
    )
    shared = F.length(F.regexp_extract(F.concat("low", F.lit("\n"), "high"), r"^([^\n]*)[^\n]*\n\1", 1))
    return below.withColumn(
        "skip", F.when(F.col("low") == F.col("high"), F.length("low")).otherwise(shared)
    )


def _followed(states: DataFrame) -> DataFrame:
    """States (side, w, at, depth, low, high, skip) after the stretch without a branch: those
    that read it without a difference, `near` set where a word ends with theirs."""
    stretch = F.col("skip") - F.col("depth")
    read = states.where(_part("w", F.col("at"), stretch) == _part("low", F.col("depth"), stretch))
    at = F.col("at") + stretch
    ended = (F.length("w") == at) & (F.length("low") == F.col("skip"))
    goes_on = (F.length("w") > at) & (F.col("low") != F.col("high"))
    return read.select(
        "side",
        "w",
        at.alias("at"),
        F.col("skip").alias("depth"),
        F.when(goes_on, _node(F.col("side"), F.expr("substring(low, 1, skip)"))).alias("node"),
        F.when(ended, F.col("low")).alias("near"),
    ).where("node IS NOT NULL OR near IS NOT NULL")


def _by_trie(words: DataFrame) -> DataFrame:
    """(a, b): pairs of words one edit apart, each at least once, in any order."""
    sides = words.select(F.lit(0).alias("side"), F.col("word").alias("w")).unionByName(
        words.select(F.lit(1).alias("side"), F.reverse("word").alias("w"))
    )
    # Where the edit may come at the earliest: the halves add up to the whole length.
    size = F.length("w")
    half = F.when(F.col("side") == 0, F.floor(size / 2)).otherwise(size - F.floor(size / 2)).cast("int")
    least = sides.agg(F.min(half)).first()[0]
    if least is None:
        return words.select(F.col("word").alias("a"), F.col("word").alias("b"))
    edges = shared_table(_edges(sides, least), "trie-edges")
    starts = sides.select("side", "w", F.explode(F.sequence(half, size - 1)).alias("at"))
    own = _part("w", F.col("at"), F.lit(1))
    following = _part("w", F.col("at") + 1, F.lit(1))
    branching = starts.withColumn("node", _node(F.col("side"), _part("w", F.lit(0), F.col("at")))).join(
        edges, "node"
    )
    # A replaced letter, once for the two words; or a letter too many, at the first place
    # where the words differ.
    depth = (F.col("at") + 1).alias("depth")
    steps = F.array_compact(
        F.array(
            F.when(F.col("letter") > own, F.lit(1)),
            F.when((F.col("letter") == following) & (F.col("letter") != own), F.lit(2)),
        )
    )
    first = branching.select("side", "w", "at", "low", "high", "skip", F.explode(steps).alias("steps"))
    frontier = shared_table(
        _followed(first.select("side", "w", (F.col("at") + F.col("steps")).alias("at"), depth, "low", "high", "skip")),
        "trie-frontier",
    )
    found = [frontier]
    while (open_states := frontier.where("node IS NOT NULL")).limit(1).count():
        onward = open_states.withColumn("letter", _part("w", F.col("at"), F.lit(1))).drop("near")
        joined = onward.join(edges, ["node", "letter"]).select(
            "side", "w", (F.col("at") + 1).alias("at"), (F.col("depth") + 1).alias("depth"), "low", "high", "skip"
        )
        frontier = shared_table(_followed(joined), "trie-frontier")
        found.append(frontier)
    ended = reduce(DataFrame.unionByName, found).where("near IS NOT NULL")
    forward = F.col("side") == 0
    pairs = ended.select(
        F.when(forward, F.col("w")).otherwise(F.reverse("w")).alias("a"),
        F.when(forward, F.col("near")).otherwise(F.reverse("near")).alias("b"),
    )
    # The last letter too many: the other word is the path itself.
    shorter = words.select(F.col("word").alias("b"))
    last = words.select(F.col("word").alias("a"), F.expr("left(word, length(word) - 1)").alias("b"))
    head = words.select(F.col("word").alias("a"), F.expr("right(word, length(word) - 1)").alias("b"))
    return pairs.unionByName(last.unionByName(head).join(shorter, "b").select("a", "b"))


def _by_segments(words: DataFrame) -> DataFrame:
    """(a, b): the same for words too long for a path of letters: all but one of the
    segments of the longer word are equal, counted from both ends."""

    def keyed(role: str, longer: int) -> DataFrame:
        whole = F.length("word") + longer
        split = words.select("word", whole.alias("whole"), F.explode(F.sequence(F.lit(0), F.lit(SEGMENTS - 1))).alias("k"))
        start = F.floor(F.col("k") * F.col("whole") / SEGMENTS).cast("int")
        end = F.floor((F.col("k") + 1) * F.col("whole") / SEGMENTS).cast("int") - longer
        return split.select(
            F.col("word").alias(role), "whole", "k",
            F.xxhash64(F.substring(F.col("word"), F.lit(1), start)).alias("head"),
            F.xxhash64(F.substring(F.col("word"), end + 1, F.length("word"))).alias("tail"),
        )

    key = ["whole", "k", "head", "tail"]
    same = keyed("a", 0).join(keyed("b", 0), key).where("a < b")
    fewer = keyed("a", 0).join(keyed("b", 1), key)
    near = same.select("a", "b").unionByName(fewer.select("a", "b"))
    # Hashes propose, the letters decide.
    return near.distinct().where(F.levenshtein("a", "b", 1) == 1)


def near_words(words: DataFrame, trie_length: int = TRIE_LENGTH) -> DataFrame:
    """(word, near): every pair of different words of the column `word` that differ by exactly
    one inserted, deleted or replaced code point, in both directions, each once.

    Words must be distinct, not null, without line breaks and not empty.
    """
    pairs = _by_trie(words.where(F.length("word") <= trie_length)).unionByName(
        _by_segments(words.where(F.length("word") >= trie_length))
    )
    checked = pairs.where(F.levenshtein("a", "b", 1) == 1)
    return checked.select(
        F.explode(
            F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near")),
                    F.struct(F.col("b").alias("word"), F.col("a").alias("near")))
        ).alias("p")
    ).select("p.*").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form. A form is `ratio` times as frequent, so
    chains are short; each round doubles what has been followed."""
    roots = shared_table(forms.select("word", F.col("form").alias("root")), "word-roots")
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        stepped = shared_table(
            roots.join(onward, "root", "left").select(
                "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
            ),
            "word-roots",
        )
        roots = stepped.select("word", "root")
        if not stepped.where("moved").limit(1).count():
            return roots


def spelling_variants(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_length: int = 6,
    least_count: int = 5,
    ratio: int = 5,
    typo: int = 199,
) -> DataFrame:
    """One row per word: word, n, form, form_n, root, n_near.

    The form of a word is its near word of largest n (ties: the first in code-point order),
    if that is at least `ratio` times the word's own n; otherwise null, and the word is its own root.
    Words come from whole texts; null texts have none, and repeated rows count again. No
    word gives an empty table.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more, or forms could run in circles")
    words = shared_table(words_of(df, id_col, text_col, least_length, least_count, typo), "words")
    near = near_words(words.select("word"))
    counted = near.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = counted.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"),
    )
    placed = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        (-F.col("best.less")).alias("near_n"), F.col("best.near").alias("near"),
    )
    formed = F.col("near_n") >= ratio * F.col("n")
    table = shared_table(
        placed.select(
            "word", "n", "n_near",
            F.when(formed, F.col("near")).alias("form"), F.when(formed, F.col("near_n")).alias("form_n"),
        ),
        "word-forms",
    )
    roots = _roots(table.where("form IS NOT NULL"))
    return table.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
