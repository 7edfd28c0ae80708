"""Each operator against a plain version, and its edge cases."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest

from tests.llm.brute import SF_DIR, WORD, exact_groups, rows_of, sha
from txclean.llm import (
    decontamination,
    graph,
    line_dedup,
    queries,
    simhash_dedup,
    stages,
    substring_dedup,
    toxicity,
)
from txclean.llm.chat import format_conversations, read_back
from txclean.llm.exact_dedup import build_index, exact_duplicates
from txclean.llm.html_extraction import extract, parse
from txclean.llm.sentencepiece_codec import codec, encode_documents
from txclean.llm.token_counts import Encoder, count_tokens, spliced_total

EDGE = [(1, None), (2, ""), (3, "  \t "), (4, "a b c d e"), (4, "a b c d e"), (5, "a  b c d e"), (6, "x " * 3000), (None, "a b c d e")]


@pytest.fixture
def edge(spark):
    """Nulls, empty and long texts, repeated rows, and columns whose names might clash."""
    rows = [(i, t, "s", 0) for i, t in EDGE]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, key int")


@pytest.fixture
def empty(edge):
    return edge.where("false")


def components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(nodes, 2):
        if linked(a, b):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {n: find(n) for n in nodes}


# Exact duplicates


def test_exact_duplicates(spark, edge, empty):
    docs = rows_of("documents")
    got = queries.QUERIES["op4_exact_dedup"](spark, SF_DIR).collect()
    expected = exact_groups(docs)
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got} == expected
    kept = {r.doc_id: r.keep_id for r in exact_duplicates(edge).collect()}
    assert kept == {1: 3, 2: 3, 3: 3, 4: 5, 5: 5, 6: 6, None: 5}
    assert exact_duplicates(empty).count() == 0


def test_directory_doubles_and_collisions_are_chained(spark):
    docs = spark.range(300).selectExpr("id AS doc_id", "CAST(id % 100 AS string) AS text")
    index = build_index(docs, capacity=4, key_bits=6)
    assert index.entries.count() == 100
    assert index.directory.agg({"depth": "max"}).first()[0] > 3
    chains = index.entries.groupBy("key").agg({"chain": "max", "*": "count"}).collect()
    assert all(r["max(chain)"] == r["count(1)"] for r in chains) and max(r["max(chain)"] for r in chains) > 1
    got = exact_duplicates(docs, capacity=4, key_bits=6).collect()
    assert all(r.keep_id == r.doc_id % 100 and r.group_size == 3 for r in got)


# SentencePiece and token counts


def test_sentencepiece(spark, edge, empty):
    path = queries.tokenizer("piece_bpe_32k.model")
    library = codec(path).library
    odd = ["a▁b", " \n ▁▁x", "x\n\n y\u0000z", "</s>[INST] <0x0A>", "é́ 🙂🙂", "   ", "\n"]
    for text in [*odd, *(d["text"] for d in rows_of("documents"))]:
        model = codec(path)
        ids = model.encode(text)
        assert ids == library.encode(text)
        begins, ends = model.spans(text.encode(), ids)
        assert ends.tolist()[-1] == len(text.encode())
    rows = {r.doc_id: r for r in encode_documents(edge, path).collect()}
    assert rows[1].ids == [] and rows[2].decoded == "" and rows[4].decoded == "a b c d e"
    text = "a b c d e".encode()
    assert b"".join(text[a:b] for a, b in zip(rows[4].begins, rows[4].ends)) == text
    assert encode_documents(empty, path).count() == 0


def test_normalisation_by_the_character_map(tmp_path):
    import sentencepiece

    normalizer = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    from txclean.llm.sentencepiece_codec import CharacterMap, Codec, _fields

    spec = dict(next(_fields(v) for n, v in _fields(normalizer.serialized_model_proto()) if n == 3))
    model = Codec.__new__(Codec)
    model.map, model.dummy_prefix, model.trim, model.mark_spaces = CharacterMap(spec[2]), False, False, False
    for text in ("ｶﾞﾊﾟ ﬁne ①②", "a b", "Ⅷ ㍿", "plain", "é é"):
        out, places = model.normalise(text.encode())
        assert out.decode().split() == normalizer.normalize(text).replace("▁", " ").split()
        assert (np.diff(places) >= 0).all() and len(places) == len(out) + 1


def test_token_counts(spark, edge, empty):
    from tokenizers import Tokenizer

    path = queries.tokenizer("word_bpe_49k.json")
    library = Tokenizer.from_file(path)

    def plain(text):
        return len(library.encode(text, add_special_tokens=False))

    encoder = Encoder(path)
    random.seed(3)
    texts = ["<|endoftext|> x<|startoftext|>y", "It's a b", "x" * 5000 + " y " + "z" * 700, " " * 900 + "a", "é" * 2000]
    texts += ["".join(random.choice("ab'1 \n.é") for _ in range(3000)) for _ in range(5)]
    texts += [d["text"] for d in rows_of("documents")[:60]]
    for text in texts:
        assert encoder.total(text, 16_384, 512) == plain(text)
        assert spliced_total(encoder, text, 200, 20) == plain(text)
    rows = {r.doc_id: r for r in count_tokens(edge, path).collect()}
    assert rows[1].n_tokens == 0 and rows[6].over_limit and rows[6].n_tokens == 3000
    assert count_tokens(empty, path).count() == 0


# Near duplicates


def test_keys_meet_within_four_bits():
    random.seed(1)
    for _ in range(300):
        a = random.getrandbits(64)
        b = a
        for bit in random.sample(range(64), 4):
            b ^= 1 << bit
        rows, keys = simhash_dedup.keys_of(np.array([a, b], np.uint64))
        assert set(keys[rows == 0]) & set(keys[rows == 1])


def test_simhash(spark, edge, empty):
    docs = rows_of("documents")
    got = {r.doc_id: r for r in simhash_dedup.near_duplicates(spark.createDataFrame(docs)).collect()}
    prints = {d["doc_id"]: simhash_dedup.fingerprint(d["text"]) for d in docs}
    expected = components(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    assert {i: (int(r.fingerprint, 16), r.component_id) for i, r in got.items()} == {
        i: (prints[i], expected[i]) for i in prints
    }
    rows = simhash_dedup.near_duplicates(edge).collect()
    assert len(rows) == len(EDGE)
    assert {r.component_id for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert simhash_dedup.near_duplicates(empty).count() == 0


def test_near_dedup_stage_links_by_fingerprints(spark, edge):
    docs = rows_of("documents")
    kept = stages.near_dedup(spark, spark.createDataFrame(docs), SF_DIR).collect()
    prints = {d["doc_id"]: simhash_dedup.fingerprint(d["text"] or "", 4) for d in docs}
    group = components(sorted(prints), lambda a, b: (int(prints[a]) ^ int(prints[b])).bit_count() <= 4)
    assert sorted(r.doc_id for r in kept) == sorted(set(group.values()))
    assert sorted(str(r.doc_id) for r in stages.near_dedup(spark, edge, SF_DIR).collect()) == ["1", "4", "6", "None"]


def test_large_buckets_go_in_blocks(spark, monkeypatch):
    rng = random.Random(5)
    prints = sorted({rng.getrandbits(6) << 3 for _ in range(60)} | {1 << 40})
    expected = components(prints, lambda a, b: (a ^ b).bit_count() <= 1)
    df = spark.createDataFrame([(7, p) for p in prints], "key long, fp long")

    def near(rows, i, js):
        return np.bitwise_count(rows["fp"][js] ^ rows["fp"][i]) <= 1

    for block in (50_000, 5):
        monkeypatch.setattr(graph, "BLOCK", block)
        links = graph.bucket_links(df, "fp", ["fp"], near)
        found = {r.node: r.component for r in graph.connected_components(links).collect()}
        assert {p: found.get(p, p) for p in prints} == expected


def places_of_lines(docs):
    places: dict[str, list] = {}
    for d in docs:
        for n, line in enumerate((d["text"] or "").split("\n")):
            if words := line_dedup.normalised(line):
                places.setdefault(" ".join(words), []).append((d["doc_id"], n))
    return places


def keys_of_lines(lines):
    keys = {line: set() for line in lines}
    for place, key in zip(*(x.tolist() for x in line_dedup.block_keys([x.split(" ") for x in lines])), strict=True):
        keys[lines[place]].add(key)
    return keys


def test_lines(spark, edge, empty):
    docs = rows_of("documents")
    got = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(docs), least_words=1).collect()}
    places = places_of_lines(docs)
    lines = list(places)
    keys = keys_of_lines(lines)
    group = components(lines, lambda a, b: not keys[a].isdisjoint(keys[b]) and line_dedup.similar(a, b))
    groups: dict[str, list] = {}
    for line in lines:
        groups.setdefault(group[line], []).extend(places[line])
    gone = {p for g in groups.values() for p in g if p != min(g)}
    for d in docs:
        text = "\n".join(x for n, x in enumerate(d["text"].split("\n")) if (d["doc_id"], n) not in gone)
        assert got[d["doc_id"]].text == text
    rows = line_dedup.dedup_lines(edge).collect()
    assert [r.text for r in rows if r.doc_id in (None, 1, 2, 5)].count("a b c d e") == 1
    assert {r.doc_id: r["__dropped"] for r in rows}[5] == 1
    assert line_dedup.dedup_lines(empty).count() == 0


def test_keys_bring_similar_lines_together():
    lines = list(places_of_lines(rows_of("documents")))
    runs: dict[tuple, list] = {}
    for line in lines:
        words = line.split(" ")
        for run in {*zip(words, words[1:], strict=False), *((w,) for w in words if len(w) > 5)}:
            runs.setdefault(run, []).append(line)
    pairs = {p for held in runs.values() for p in itertools.combinations(held, 2)}
    near = [(a, b) for a, b in pairs if line_dedup.similar(a, b)]
    keys = keys_of_lines(lines)
    assert sum(not keys[a].isdisjoint(keys[b]) for a, b in near) >= 0.9 * len(near) > 0
    rng = random.Random(5)
    vocabulary = sorted({w for line in lines for w in line.split(" ")})
    met = []
    while len(met) < 300:
        words = rng.choices(vocabulary, k=rng.randrange(8, 41))
        changed = [*words]
        changed[rng.randrange(len(words))] = rng.choice(vocabulary)
        if line_dedup.similar(" ".join(words), " ".join(changed)):
            place, key = line_dedup.block_keys([words, changed])
            met.append(np.intersect1d(key[place == 0], key[place == 1]).size > 0)
    print("one word changed:", sum(met), "of", len(met))
    assert sum(met) >= 0.95 * len(met)


def test_blocks_are_signs_of_sums():
    import xxhash

    words = [f"w{n}" for n in range(700)]
    line = words + words[:9]
    place, key = line_dedup.block_keys([["a"], line])
    assert place.tolist() == [0] + [1] * 8
    blocks: dict[int, list] = {}
    for h in map(xxhash.xxh3_64_intdigest, words):
        blocks.setdefault((h >> 40) % 8, []).append(h)
    for n, got in enumerate(key[1:].tolist()):
        own = blocks[n]
        sign = sum(1 << bit for bit in range(64) if sum(h >> bit & 1 for h in own) * 2 > len(own))
        assert got % 2**64 == (sign + (n + 64 * 2 + 1) * 0x9E3779B97F4A7C15) % 2**64


HELPERS = ["__id", "__row", "__r", "__drop", "__lines", "__dropped", "__text", "__passages", "__digest", "__score", "__rows", "score", "key", "line", "component"]


def test_no_column_of_the_input_is_lost_or_changed(spark):
    line = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    rows = [(n, t, *(f"{h}{n}" for h in HELPERS)) for n, t in enumerate([line, line + "\nmore", None, "Clean words."])]
    df = spark.createDataFrame(rows, ", ".join(["doc_id long, text string", *(f"`{h}` string" for h in HELPERS)]))
    bench = spark.createDataFrame([("a", line), ("b", line + " more")], "item_id string, text string")

    def own(result):
        return sorted(tuple(r)[: len(rows[0])][:1] + tuple(r)[2 : len(rows[0])] for r in result.select(*df.columns).collect())

    whole = sorted((r[0], *r[2:]) for r in rows)
    for out, added in (
        (line_dedup.dedup_lines(df), ["___lines", "___dropped"]),
        (decontamination.find_passages(df, bench), ["___passages"]),
        (decontamination.find_passages(df, bench, pass_words=2), ["___passages"]),
        (toxicity.score(df, queries.toxicity_model(spark, SF_DIR)), ["_score"]),
    ):
        assert out.columns == df.columns + added and own(out) == whole
    found = decontamination.find_passages(df, bench).where("doc_id = 0").first()["___passages"]
    assert [p.item for p in found] == ["a", "b"]
    assert own(stages.toxicity(spark, df, SF_DIR)) == whole
    assert own(stages.line_dedup(spark, df, SF_DIR)) == whole
    assert own(stages.near_dedup(spark, df, SF_DIR)) == whole
    assert own(stages.decontamination(spark, df, SF_DIR)) == whole


def test_short_lines_repeat_in_no_result(spark):
    docs = [(d["doc_id"], d["text"]) for d in rows_of("documents")]
    docs += [(-1, "Read more\n全文公开发布\n...\n\nx"), (-2, "x\nread  MORE!\n全文公开发布。\n...\n\ny")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    left = {r.doc_id: r.text for r in stages.line_dedup(spark, df, SF_DIR).collect()}
    assert left[-2] == "x\nread  MORE!\n全文公开发布。\n...\n\ny" and left[-1] == "...\n"
    lines = [w for t in left.values() for x in t.split("\n") if (w := tuple(line_dedup.normalised(x)))]
    assert len(lines) == len(set(lines))
    places = [w for d in rows_of("documents") for x in d["text"].split("\n") if (w := tuple(line_dedup.normalised(x)))]
    dropped = queries.QUERIES["op8_line_dedup"](spark, SF_DIR).agg({"n_dropped": "sum"}).first()[0]
    assert dropped >= len(places) - len(set(places))


def test_edit_distance():
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    random.seed(2)
    for _ in range(500):
        a, b = ("".join(random.choices("abc", k=random.randint(0, 10))) for _ in range(2))
        assert [line_dedup.within(a, b, m) for m in range(8)] == [plain(a, b) <= m for m in range(8)]


def test_edit_distance_of_long_lines():
    """A walk never accepts what the distance refuses, and columns left early change nothing."""
    rng = random.Random(6)
    for _ in range(150):
        a = rng.choices(["on", "the", "tion", "er", "and"], k=rng.randint(5, 30))
        b = [w if rng.random() < 0.8 else rng.choice(["x", "onward", ""]) for w in a if rng.random() < 0.95]
        x, y = " ".join(a), " ".join(b)
        row = list(range(len(y) + 1))
        for n, c in enumerate(x, 1):
            new = [n]
            for m, d in enumerate(y, 1):
                new.append(min(row[m] + 1, new[-1] + 1, row[m - 1] + (c != d)))
            row = new
        for most in range(row[-1] - 3, row[-1] + 4):
            assert line_dedup.within(x, y, most) == (row[-1] <= most)
            assert row[-1] <= most or not line_dedup.walked(x.split(" "), y.split(" "), most)


def test_normal_form_of_lines():
    texts = ["Été A1_b\n\n  don't\x85x\xa0y ª²", "ΣΟΦΟΣ naïve\nİx 🙂 Straße\n", "", "\n"]
    for text in texts:
        assert [x.split() for x in line_dedup.spaced(text)] == [line_dedup.normalised(x) for x in text.split("\n")]


# Benchmark and repeated passages


def test_masks_hit_whichever_three_words_change():
    for changed in itertools.combinations(range(15), 3):
        assert any(
            all(at + n not in changed for n, bit in enumerate(mask) if bit == "1")
            for mask in decontamination.MASKS
            for at in range(15 - len(mask) + 1)
        )


def test_short_items_are_found_as_by_brute_force():
    found, expected = [], []
    for n in range(1, 15):
        item = [f"w{at}" for at in range(n)]
        seeds = decontamination.seeds_of([(1, " ".join(item))])
        for changed in itertools.chain.from_iterable(itertools.combinations(range(n), k) for k in range(4)):
            words = ["pad", *("x" if at in changed else w for at, w in enumerate(item)), "pad"]
            got = decontamination.passages(decontamination.hashes_of(words), seeds, 15, 0.8)
            found.append((n, changed, [(p["start"], p["stop"], p["equal"]) for p in got]))
            expected.append((n, changed, [(1, n + 1, n - len(changed))] if 5 * (n - len(changed)) >= 4 * n else []))
    assert found == expected


def test_decontamination(spark, edge, empty):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    words = item.split()
    words[3], words[8], words[12] = "x", "y", "z"
    rows = [(1, "pad pad " + item.upper()), (2, "a " + " ".join(words) + " b"), (3, " ".join(item.split()[:11])), (4, None), (5, "five little words here now")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(9, item), (10, None), (11, "too short"), (12, "five little words here now")], "item_id long, text string")
    for size in (2_000_000, 5):
        found = {r.doc_id: r["__passages"] for r in decontamination.find_passages(docs, bench, pass_words=size).collect()}
        assert {i: [p.item for p in ps] for i, ps in found.items()} == {1: [9], 2: [9], 3: [], 4: [], 5: [12]}
        assert (found[1][0].start, found[1][0].stop, found[1][0].equal) == (2, 18, 16)
    assert decontamination.find_passages(edge, bench).count() == len(EDGE)
    assert decontamination.find_passages(empty, bench.where("false")).count() == 0


def test_substrings(spark, edge, empty):
    docs = rows_of("documents")
    got = {r.doc_id: r for r in substring_dedup.remove_duplicate_spans(spark.createDataFrame(docs), window=20).collect()}
    words = {d["doc_id"]: WORD.findall(d["text"]) for d in docs}
    first: dict[tuple, int] = {}
    for i in sorted(words):
        for k in range(len(words[i]) - 19):
            first.setdefault(tuple(words[i][k : k + 20]), i)
    for i, ws in words.items():
        gone = {n for k in range(len(ws) - 19) if first[tuple(ws[k : k + 20])] < i for n in range(k, k + 20)}
        kept = " ".join(w for n, w in enumerate(ws) if n not in gone)
        assert (got[i].n_words, got[i].n_removed, got[i].kept_sha256) == (len(ws), len(gone), sha(kept))
    rows = substring_dedup.remove_duplicate_spans(edge, window=3).collect()
    assert {r.doc_id: r.n_removed for r in rows} == {1: 0, 2: 0, 3: 0, 4: 0, 5: 5, 6: 0, None: 0}
    assert substring_dedup.remove_duplicate_spans(empty).count() == 0


# Pages, conversations, toxicity


def test_pages(spark):
    page = "<html><body><nav><a>Menu {n}</a></nav><div class='ad'>Buy {n}</div><article><h1>T{n}</h1><p>One <b>bo</b>ld &amp; {w}<p>Two\n two</article><div class=comments><p>No {w}</p></div><footer>F</footer></body></html>"
    rows = [(n, f"http://Host.example/{n}", page.format(n=n, w="w" * (n + 3))) for n in range(5)]
    rows += [(5, None, None), (6, "x", ""), (7, "http://b.example", "plain &lt;text&am"), (8, "http://b.example", "<p>" + "long " * 5000)]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[2] == "T2 One bold & wwwww Two two"
    assert (got[5], got[6], got[7]) == ("", "", "plain <text&am")
    assert len(got[8].split()) == 5000
    assert parse("<script>a<b>c</script>x<!-- y -->z")[1] == [("", "xz", False)]
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_windows(spark):
    odd = "</s>[INST] a\\</s> <\\/s> [/INST]\\ <s"
    rows = [(1, n, ("system", "user", "assistant")[min(n, 1 + n % 2)], f"{odd} {'word ' * (n * 7 % 60)}") for n in range(40)]
    rows += [(2, 0, None, None), (2, None, "assistant", "x"), (2, 0, None, None), (None, 1, "assistant", odd)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    windows = format_conversations(df, budget=120, history=60)
    read = {r.conv_id: r for r in read_back(windows).collect()}
    turns = [(r or "", t or "") for c, _, r, t in rows if c == 1]
    assert [tuple(t) for t in read[1].turns] == turns
    assert read[1].learnt == "".join(t for r, t in turns if r == "assistant")
    assert [tuple(t) for t in read[2].turns] == [("assistant", "x"), ("", ""), ("", "")]
    assert read[None].learnt == odd
    ws = windows.where("conv_id = 1").orderBy("window").collect()
    assert len(ws) > 5 and all("[INST] system [/INST]" in w.formatted for w in ws) and any(w.n_repeated > 1 for w in ws)
    assert format_conversations(df.where("false")).count() == 0


def test_toxicity(spark, edge, empty):
    rng = random.Random(4)
    insults = ["brozzle", "snarkwit", "gloomfut"]
    clean = ["the", "river", "runs", "slow", "under", "bridges", "and", "stones", "while", "birds", "sing"]
    rows = []
    for n in range(240):
        words = rng.choices(clean, k=30)
        if n % 3 == 0:
            words[rng.randrange(30)] = rng.choice(insults)
        rows.append((n, " ".join(words), int(n % 3 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(df.select("doc_id", "text"), df.where("doc_id < 180").select("doc_id", "toxic"))
    scored = toxicity.score(df, model).where("doc_id >= 180").collect()
    assert all((r.score >= 0.5) == bool(r.toxic) for r in scored)
    tried = ["the river b.r.o.z.z.l.e runs", "you brozxzle you", "s n a r k w i t indeed", "the river runs slow", None, ""]
    got = toxicity.score(spark.createDataFrame([(t,) for t in tried], "text string"), model).collect()
    assert [r.score >= 0.5 for r in got] == [True, True, True, False, False, False]
    assert toxicity.score(edge, model).count() == len(EDGE)
    none = toxicity.train(empty, df.select("doc_id", "toxic"))
    assert all(r.score < 0.5 for r in toxicity.score(edge, none).collect())


def test_spelt_insults_across_sentences_and_in_long_texts():
    model = toxicity.Model(toxicity.Landmarks(["brozzle"]), np.array([2.0]), -1.0)
    clean = ["river"] * 200
    texts = ["b. r. o. z. z. l. e.", "Plan a. b r o z z l e\nq w r t p s d f g h j k"]
    texts += [" ".join([*clean[:n], *"brozzle", *clean]) for n in range(30, 42)]
    values = toxicity.Reader(model).documents([*texts, "r. i. v. e. r. s.", " ".join(clean)])
    assert [v > 0 for v in values] == [True] * len(texts) + [False, False]
