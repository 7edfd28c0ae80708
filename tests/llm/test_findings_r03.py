"""Faults found by the review of the third round."""

from __future__ import annotations

import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from txclean.llm import decontamination, line_dedup, sentencepiece_codec, toxicity
from txclean.llm.html_extraction import extract, templates, valid_tokens

PAGES = "page_id long, url string, html string"
FRAME = "<html><body><div class=brand>Site name</div>{}<div class=foot>All rights</div></body></html>"
OTHERS = "<div class=more>More <a href=x>another story {n}</a> <a href=y>and one {n}</a></div>"


def read(spark, pages):
    rows = [(n, f"http://h.example/{n}", FRAME.format(p.format(n=n, w="w" * (n % 7 + 3)))) for n, p in enumerate(pages)]
    return {r.page_id: r.text for r in extract(spark.createDataFrame(rows, PAGES)).collect()}


def test_layouts_of_a_host_are_classes_of_their_own(spark):
    one = "<div class=lead><p>Lead {n} here</p></div><div class=text><p>Body {n} text {w}</p></div>" + OTHERS
    two = "<div class=story><p>Story {n} told {w}</p></div>" + OTHERS
    three = "<article><p>Article {n} {w}</p></article>" + OTHERS
    got = read(spark, [(one, one, two, three, one)[n % 5] for n in range(20)])
    assert got[0] == "Lead 0 here Body 0 text www"
    assert got[2] == "Story 2 told wwwww"
    assert got[3] == "Article 3 wwwwww"
    assert got[7] == "Story 7 told www"


def test_classes_out_of_order_are_no_template(spark):
    fixed, varying = "<div class=a>Fixed</div>", "<div class=b>Body {n} {w}</div>"
    kept = read(spark, [f"<div class=wrap>{fixed}{varying}</div>"] * 6)
    assert kept[3] == "Body 3 wwwwww"
    # A box that only some pages have is a class within the first and takes no order from it.
    some = read(spark, [f"<div class=wrap>{fixed}{'<div class=c>Box</div>' * (n % 2)}{varying}</div>" for n in range(6)])
    assert some[3] == "Body 3 wwwwww"
    # Copies of a page are no other order; swapped members are text of the slot around them.
    swapped = read(spark, [f"<div class=wrap>{fixed}{varying}</div>"] * 5 + [f"<div class=wrap>{varying}{fixed}</div>"])
    assert (swapped[3], swapped[5]) == ("Fixed Body 3 wwwwww", "Body 5 wwwwwwww Fixed")


def test_valid_classes_nest():
    tokens = [("h", 1, 1), ("h/b", 1, 1), ("h/b/x", 0, 1), ("h/b/x/y", 1, 1), ("h/b/z", 1, 0), ("h/b/z/u", 1, 1), ("h/b/v", 1, 1)]
    assert valid_tokens([{"path": p, "once": o, "ordered": r} for p, o, r in tokens]) == {"h", "h/b", "h/b/v"}


def test_rare_paths_count_for_the_element_above(spark):
    pages = [f"<div class=wrap><div class='post {c}'><p>Told {{n}} {{w}}</p></div></div>" for c in "abcdefgh"]
    got = read(spark, pages)
    assert got[4] == "Told 4 wwwwwww"
    empty = spark.createDataFrame([], "host string, page long, html string")
    assert templates(empty).count() == 0


def test_majority_of_bits_is_that_of_counting():
    rng = np.random.default_rng(3)
    for sizes in (rng.integers(1, 9, 400), np.array([1, 2, 15, 16, 255, 256, 700, 3])):
        hashes = rng.integers(0, 2**64, sizes.sum(), dtype=np.uint64)
        hashes = np.where(rng.random(len(hashes)) < 0.3, hashes | np.uint64(0xFFFF0000FFFF), hashes)
        ends = np.cumsum(sizes)
        for found, stop, size in zip(line_dedup.majority(hashes, sizes).tolist(), ends.tolist(), sizes.tolist(), strict=True):
            block = hashes[stop - size : stop].tolist()
            assert found == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in block) > size)


def test_copies_of_documents_lose_their_lines_alike(spark):
    one, two = "a first line of some words\nonly here", "A first, line of SOME words!\nand another one\n\xd6l and ł\xf3dź lines"
    rows = [(1, one)] * 40 + [(2, two)] * 40 + [(3, one)] + [(None, one)]
    found = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id int, text string").repartition(3), least_words=1)
    got = {(r.doc_id, r.text): (r["count"], r.lost) for r in found.groupBy("doc_id", "text").agg(F.count("*").alias("count"), F.max("__dropped").alias("lost")).collect()}
    assert got == {
        (1, one): (40, 0), (2, two.split("\n", 1)[1]): (40, 1), (3, ""): (1, 2), (None, one): (1, 0),
    }


def test_a_worker_keeps_nothing_of_ended_tasks(spark):
    docs = spark.createDataFrame([(n, f"word{n} and more words{n} of a text") for n in range(40)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "something else that nobody wrote")], "item_id long, text string")
    assert decontamination.find_passages(docs.repartition(4), items).count() == 40
    path = public_tokenizers.path("piece_bpe_32k.model")
    assert sentencepiece_codec.encode_documents(docs.repartition(4), path).where("size(ids) > 0").count() == 40

    def held(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict(
                {"n": [len(decontamination._hashes) + len(sentencepiece_codec.codec(path).known)] * batch.num_rows}
            )

    assert spark.range(64, numPartitions=16).mapInArrow(held, "n long").agg(F.max("n")).first()[0] == 0


def test_values_of_many_words_take_little_memory():
    marks = toxicity.Landmarks(["idiot", "stupid", "hello"])
    model = toxicity.Model(marks, np.array([1.0, 2.0, -1.0]), -1.0)
    words = [f"stupidword{n}" for n in range(30_000)]
    apart = [model.values([w])[0] for w in words[::3000]]
    tracemalloc.start()
    found = model.values(words)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20_000_000
    assert np.allclose(found[::3000], apart)
    reader = toxicity.Reader(model)
    for n in range(0, 600_000, 100_000):
        reader.documents([" ".join(map(str, range(n, n + 100_000)))])
    assert len(reader.known) <= 400_000
