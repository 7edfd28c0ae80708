"""The operators 11 to 13 against plain versions, and their edge cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.brute import SF_DIR, rows_of
from txclean.llm import neighbour_quality, queries, spelling
from txclean.llm.token_alignment import Aligner, align_documents, aligned, gallop

EDGE = [
    (1, None, "s"), (2, "", "s"), (3, "  \t ", "s"), (4, "a b c d e", "s"), (4, "a b c d e", "s"),
    (None, "null id", "s"), (6, "x " * 30_000, "s"), (7, "y" * 20_000, "s"), (8, "a▁b \n ▁ <0x0A> </s>", "s"),
]
CLASHING = "doc_id long, text string, place string, score string, w string, word string, slice string, label string"


@pytest.fixture
def edge(spark):
    """Nulls, empty and long texts, repeated rows, and columns with the operators' own names."""
    return spark.createDataFrame([(i, t, x, x, x, x, x, x) for i, t, x in EDGE], CLASHING)


def test_exact_dedup_keeps_the_type_of_ids(spark):
    from txclean.llm.exact_dedup import exact_duplicates

    rows = [("b", "x y"), ("a", "xy"), ("c", "z"), (None, "z"), ("d", None)]
    got = exact_duplicates(spark.createDataFrame(rows, "doc_id string, text string"))
    assert dict(got.dtypes)["keep_id"] == "string"
    assert {(r.doc_id, r.keep_id, r.group_size) for r in got.collect()} >= {("b", "b", 2), ("a", "b", 2), ("d", "d", 1)}


# Quality


def folded(doc_id: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % 3


def test_quality_on_the_held_out_third(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.QUERIES["op11_quality"](spark, sf_dir).collect()}
    assert len(got) == len(rows_of("documents", sf_dir))
    assert all(r.held_out == (folded(i) == 1) and 0 <= r.score <= 1 for i, r in got.items())
    assert all(r.predicted == int(r.score >= 0.5) for r in got.values())
    aside = [(got[r["doc_id"]], r["quality"]) for r in rows_of("labels", sf_dir) if folded(r["doc_id"]) == 1]
    wrong = sum(r.predicted != quality for r, quality in aside)
    low = [r.predicted for r, quality in aside if quality == 0]
    assert wrong <= 0.05 * len(aside) and sum(low) <= 0.2 * len(low)


def test_votes_are_those_of_all_cosines():
    rng = np.random.default_rng(3)
    terms = rng.random((60, neighbour_quality.TRIPLES + neighbour_quality.SHAPES)).astype(np.float32)
    labels = rng.integers(0, 2, 60)
    model = neighbour_quality.fit(terms, labels, 0.5, dimensions=8, nearest=5, power=2.0)
    queries_in = model.project(rng.random((20, terms.shape[1])).astype(np.float32))
    for vector, voted in zip(queries_in, model.vote(queries_in), strict=True):
        cosines = [float(vector @ v) / np.linalg.norm(v) for v in model.vectors]
        near = sorted(range(60), key=lambda n: -cosines[n])[:5]
        weights = [max(cosines[n], 0) ** 2 * model.shares[labels[n]] for n in near]
        assert voted == pytest.approx(sum(w * labels[n] for w, n in zip(weights, near)) / sum(weights), abs=1e-4)
    # The space is that of the singular vectors.
    weighted = terms * model.weights
    _, _, right = np.linalg.svd(weighted, full_matrices=False)
    assert np.allclose(np.abs(np.sum(right[:8] * model.axes.T, axis=1)), 1, atol=1e-2)


def test_terms_read_whole_texts_and_each_text_alone():
    texts = ["", "Das ist gut.", "go go go go", "x" * 70_000 + "!!", "a b a b"]
    together = neighbour_quality.counted_terms(texts)
    for n, text in enumerate(texts):
        assert np.allclose(together[n], neighbour_quality.counted_terms([text])[0])
    assert not np.allclose(together[3], neighbour_quality.counted_terms(["x" * 70_002])[0])


def test_quality_edges(spark, edge):
    labels = spark.createDataFrame([(4, 1), (6, 0), (6, None), (None, 1), (7, 3), (99, 1)], "doc_id long, quality int")
    model = neighbour_quality.train(edge, labels)
    assert sorted(model.labels) == [0, 1]
    scores = [(r.doc_id, r.score) for r in neighbour_quality.score(edge, model).collect()]
    assert len(scores) == len(EDGE) and all(0 <= s <= 1 for _, s in scores)
    assert dict(scores)[4] > 0.5 > dict(scores)[6] and dict(scores)[1] == dict(scores)[2]
    none = neighbour_quality.train(edge, labels.where("false"))
    assert {r.score for r in neighbour_quality.score(edge, none).collect()} == {0.5}
    one = neighbour_quality.train(edge, labels.where("quality = 1"))
    assert {r.score for r in neighbour_quality.score(edge, one).collect()} == {1.0}
    assert neighbour_quality.score(edge.where("false"), model).count() == 0


# Alignment


def plain_alignment(docs: list[tuple]) -> list[tuple]:
    """By the libraries on whole texts, and sets of byte ends."""
    import json

    import sentencepiece
    from tokenizers import Tokenizer

    path = queries.tokenizer("byte_bpe_50k.json")
    first = Tokenizer.from_file(path)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer("piece_bpe_32k.model"))
    from txclean.llm.token_alignment import _byte_letters

    letters = _byte_letters()
    with open(path) as file:
        vocab = {i: bytes(letters[c] for c in t) for t, i in json.load(file)["model"]["vocab"].items() if t != "<|endoftext|>"}

    def piece(i):
        p = second.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()

    rows, links = [], Counter()
    for doc_id, text in docs:
        a = [(i, vocab[i]) for i in first.encode(" " + (text or ""), add_special_tokens=False).ids]
        b = [(i, piece(i)) for i in second.encode(text or "")]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            rows.append((doc_id, [], [], [], []))
            continue
        spans = []
        for tokens in (a, b):
            ends = np.cumsum([len(x) for _, x in tokens])
            spans.append([(i, int(e) - len(x), int(e)) for (i, x), e in zip(tokens, ends)])
        common = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        groups, start = [], 0
        for end in common:
            groups.append("|".join(",".join(str(i) for i, s, e in side if s >= start and e <= end) for side in spans))
            start = end
        mine, at = [], 0
        for i, s, e in spans[0]:
            while spans[1][at][2] <= s:
                at += 1
            k = at
            while k < len(spans[1]) and spans[1][k][1] < e:
                mine.append((i, spans[1][k][0]))
                k += 1
        links.update(mine)
        rows.append((doc_id, spans[0], spans[1], groups, mine))
    top: dict = defaultdict(int)
    for (_, b), n in links.items():
        top[b] = max(top[b], n)
    return [
        (i, len(a), len(b), len(g), len(m), sum(links[x] == top[x[1]] for x in m), sum(links[x] for x in m),
         hashlib.sha256(";".join(g).encode()).hexdigest() if a else "")
        for i, a, b, g, m in rows
    ]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def by_id(rows):
    return sorted((tuple(r[c] for c in COLUMNS) if not isinstance(r, tuple) or hasattr(r, "doc_id") else r for r in rows), key=str)


def test_alignment_of_the_table(spark):
    docs = [(d["doc_id"], d["text"]) for d in rows_of("documents")]
    got = queries.QUERIES["op12_alignment"](spark, SF_DIR).collect()
    assert by_id(got) == by_id(plain_alignment(docs))


def test_alignment_of_odd_texts(spark, edge):
    rng = random.Random(5)
    marks = [" ", "  ", "\n", "\t", "▁", "'s", "é", "́", "ß", "<|endoftext|>", "</s>", " ", "　", "漢字", "🙂", "a", "the", "12", "!?", "\x1c", "\x85", "<0x41>", "͸"]
    docs = [(n, "".join(rng.choices(marks, k=rng.randint(1, 30)))) for n in range(400)]
    paths = queries.tokenizer("byte_bpe_50k.json"), queries.tokenizer("piece_bpe_32k.model")
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    documents, pairs = align_documents(table, *paths, slice_bytes=500)
    expected = plain_alignment(docs)
    assert by_id(documents.collect()) == by_id(expected)
    assert pairs.agg({"n": "sum"}).first()[0] == sum(r[4] for r in expected)
    documents, _ = align_documents(edge, *paths, with_groups=True)
    rows = documents.collect()
    assert by_id(rows) == by_id(plain_alignment([(i, t) for i, t, _ in EDGE]))
    assert all(hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256 for r in rows if r.n_a)
    documents, pairs = align_documents(edge.where("false"), *paths)
    assert documents.count() == 0 and pairs.count() == 0


def test_letters_read_alike_by_both_libraries():
    model = Aligner(queries.tokenizer("byte_bpe_50k.json"), queries.tokenizer("piece_bpe_32k.model"))
    assert model.splits and model.a.quick is not None
    texts = [f" a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}.{chr(c)}  {chr(c)}\n" for c in range(0x250)]
    slow = [e.ids for e in model.a.library.encode_batch_fast(texts, add_special_tokens=False)]
    assert model.a.encode(texts) == slow


def test_gallop_and_ranges():
    rng = np.random.default_rng(1)
    longer = np.unique(rng.integers(0, 10_000, 2000))
    wanted = np.sort(rng.integers(0, longer[-1] + 1, 300))
    assert (gallop(longer, wanted, np.zeros(300, np.int64)) == np.searchsorted(longer, wanted)).all()
    for _ in range(50):
        texts = []
        for _ in range(rng.integers(1, 6)):
            size = int(rng.integers(1, 400))
            texts.append([np.unique([*rng.integers(1, size + 1, rng.integers(0, size + 1)), size]) for _ in (0, 1)])
        base, lists = 0, ([], [])
        for pair in texts:
            for side in (0, 1):
                lists[side].append(pair[side] + base)
            base += pair[0][-1]
        ends = [np.concatenate(x) for x in lists]
        a, b, a_cut, b_cut = aligned(ends[0], np.array([len(x) for x in lists[0]]), ends[1], np.array([len(x) for x in lists[1]]))
        begin = [np.concatenate([[0], e[:-1]]) for e in ends]
        brute = [(i, j) for i in range(len(ends[0])) for j in range(len(ends[1])) if begin[0][i] < ends[1][j] and begin[1][j] < ends[0][i]]
        assert list(zip(a.tolist(), b.tolist())) == brute
        assert (ends[0][a_cut] == ends[1][b_cut]).all() and set(ends[0][a_cut]) == set(ends[0]) & set(ends[1])


# Spelling


def plain_words(docs, least=6, count=5, typo=199) -> dict[str, int]:
    found: Counter = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % typo == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= count}


def plain_near(words) -> set[tuple[str, str]]:
    """By the words with one letter masked or left out."""
    masks, less = defaultdict(set), defaultdict(set)
    for w in words:
        for k in range(len(w)):
            masks[w[:k], w[k + 1 :]].add(w)
            less[w[:k] + w[k + 1 :]].add(w)
    pairs = {(a, b) for group in masks.values() for a in group for b in group if a != b}
    for short in words:
        for longer in less.get(short, ()):
            pairs |= {(short, longer), (longer, short)}
    return pairs


def plain_variants(words: dict[str, int], ratio=5) -> set[tuple]:
    near = defaultdict(list)
    for a, b in plain_near(words):
        near[a].append(b)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


@pytest.mark.parametrize("sf_dir", [SF_DIR, "/root/testdata/sf0.01"])
def test_spelling_of_the_table(spark, sf_dir):
    docs = [(d["doc_id"], d["text"]) for d in rows_of("documents", sf_dir)]
    got = queries.QUERIES["op13_spelling"](spark, sf_dir).collect()
    expected = plain_variants(plain_words(docs))
    rows = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got]
    assert len(rows) == len(expected) and set(rows) == expected
    assert any(r[1] for r in rows) and any(r[4] > 1 for r in rows)


@pytest.mark.parametrize("letters, longest, trie", [("ab", 9, 64), ("abé", 7, 64), ("ab", 60, 20)])
def test_near_words(spark, letters, longest, trie):
    rng = random.Random(longest)
    words = set()
    while len(words) < 150:
        w = "".join(rng.choices(letters, k=rng.randint(max(1, longest - 5), longest)))
        at = rng.randrange(len(w))
        words |= {w, w[:at] + rng.choice(letters) + w[at + 1 :], w[:at] + w[at + 1 :] or w}
    table = spark.createDataFrame([(w,) for w in words], "word string")
    rows = [tuple(r) for r in spelling.near_words(table, trie_length=trie).collect()]
    assert len(rows) == len(set(rows)) and set(rows) == plain_near(words)


def test_spelling_edges(spark, edge):
    texts = [(n, "colour " * 30 + "Color cölour colours") for n in range(6)] + [(None, "colour"), (9, None), (10, "")]
    texts += [(20 + n, "z" * 3000 + "a" + "z" * 500 + " " + "z" * 3000 + "b" + "z" * 500 + " " + "z" * 3500) for n in range(5)]
    table = spark.createDataFrame([(i, t, "", "", "", "", "", "") for i, t in texts], CLASHING)
    got = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.spelling_variants(table).collect()}
    expected = plain_variants(plain_words(texts))
    assert got == expected and any(len(r[0]) > 3000 and r[4] == 2 for r in expected)
    # Forms of forms are followed to the last.
    chain = [("abcdefgh", 5), ("abcdefg", 30), ("abcdef", 200), ("xbcdef", 1500)]
    rows = spark.createDataFrame([(1, " ".join(f"{w} " * n for w, n in chain))], "doc_id long, text string")
    found = spelling.spelling_variants(rows, typo=10**12).collect()
    assert {r.word: r.root for r in found} == {w: "xbcdef" for w, _ in chain}
    assert spelling.spelling_variants(edge.where("false")).count() == 0
    assert spelling.spelling_variants(edge.where("doc_id < 4")).count() == 0
