"""Toxicity, embeddings, language ID, n-gram join and BPE: brute force, exact round trips and held-out accuracy."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkfold.llm import bpe_codec, toxicity
from sparkfold.llm.components import connected
from sparkfold.llm.embedding_neardup import link_embeddings
from sparkfold.llm.language_id import codewords, fit, identify
from sparkfold.llm.ngram_join import common, link_documents, need, reach, signature_length
from sparkfold.llm.queries import QUERIES, byte_bpe_path

SF = "/root/testdata/sf0.01"


# --- toxicity ---------------------------------------------------------------------------------------------------

def test_toxicity_separates_made_up_insults():
    rng = random.Random(1)
    plain = ["re", "tion", "the", "and", "wh", "ou", "est", "ing", "er", "on"]

    def text(n, bad):
        words = ["".join(rng.choice(plain) for _ in range(rng.randint(1, 4))) for _ in range(n)]
        for _ in range(bad):
            words[rng.randrange(n)] = rng.choice(["zonk", "grumbix", "plofta" + rng.choice(plain)])
        return " ".join(words)
    texts = [text(rng.randint(5, 400), 0) for _ in range(300)] + [text(rng.randint(5, 400), 2) for _ in range(150)]
    label = [0] * 300 + [1] * 150
    half = [i for i in range(450) if i % 2]
    model = toxicity.train([texts[i] for i in half], [label[i] for i in half])
    buf, borders = toxicity.column_bytes(__import__("pyarrow").array([*texts, "", " ", "word " * 50_000]))
    score = toxicity.score_slice(model, buf, borders)
    rest = [i for i in range(450) if not i % 2]
    right = sum((score[i] >= toxicity.THRESHOLD) == bool(label[i]) for i in rest)
    assert right >= 0.95 * len(rest)
    assert (score >= 0).all() and (score <= 1).all() and score[450] < toxicity.THRESHOLD


def test_toxicity_held_out_accuracy(spark):
    """On the larger table, where each class has some hundred training documents."""
    table = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in QUERIES["op2_toxicity"](spark, table).collect()}
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{table}/labels.parquet").collect()}
    held = [d for d in toxic if zlib.crc32(str(d).encode()) % 4 == 2]
    assert all(got[d].held_out for d in held) and len(got) == spark.read.parquet(f"{table}/documents.parquet").count()
    assert sum(got[d].predicted == toxic[d] for d in held) >= 0.95 * len(held)
    found = [got[d].predicted for d in held if toxic[d]]
    assert sum(found) >= 0.9 * len(found)


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = {k: v.astype(np.float64) for k, v in toxicity.new_net(rng).items()}
    table = np.vstack([rng.normal(size=(20, toxicity.INPUTS)), np.zeros(toxicity.INPUTS)])
    ids = rng.integers(-1, 20, (3, 7))
    ids[:, 0] = 3
    _, saved = toxicity.forward(net, table, ids, keep=True)
    weight = np.array([1.0, -0.5, 2.0])
    grad = toxicity.backward(net, table, ids, saved, weight)
    for name in net:
        at = tuple(rng.integers(0, n) for n in net[name].shape)
        keep = net[name][at]
        values = []
        for step in (1e-4, -1e-4):
            net[name][at] = keep + step
            values.append(float(weight @ toxicity.forward(net, table, ids)))
        net[name][at] = keep
        assert grad[name][at] == pytest.approx((values[0] - values[1]) / 2e-4, rel=0.02, abs=2e-4), name


def test_windows_cover_every_word():
    for n in (0, 1, 47, 48, 49, 84, 85, 500):
        ids, owner = toxicity.window_ids(np.arange(n), np.zeros(n, int), 1)
        assert set(ids[ids >= 0]) == set(range(n)) and (owner == 0).all()
        assert len(ids) == max(1, -(-(n - 12) // 36))


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (None, "c"), (1, "a b")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels, F.lit(True))
    out = toxicity.score_texts(docs, model)
    assert sorted(r.score for r in out.collect()) == [0.0] * 4 and out.columns == ["doc_id", "text", "score"]
    assert toxicity.score_texts(docs.limit(0), model).count() == 0


# --- language ID ------------------------------------------------------------------------------------------------

def test_language_held_out_accuracy(spark):
    got = {r.doc_id: r for r in QUERIES["op7_language_id"](spark, SF).collect()}
    want = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    held = [d for d in want if zlib.crc32(str(d).encode()) % 3 == 1]
    assert sorted(held) == sorted(d for d, r in got.items() if r.held_out)
    assert sum(got[d].lang_pred == want[d] for d in held) >= 0.97 * len(held)


def test_language_edge_cases(spark):
    train = [(i, "der die das und nicht ist", "de", 0) for i in range(5)] + [(10 + i, "the and that was with", "en", 0) for i in range(5)] + [(30, "xx", None, 0)]
    docs = spark.createDataFrame(train, "doc_id long, text string, lang string, score int")
    model = fit(docs, F.lit(True))
    asked = [(1, None), (2, ""), (3, "123 !?"), (4, "die und das " * 20_000), (5, "that was the"), (6, "дом"), (None, "with the"), (5, "that was the")]
    got = {r.doc_id: r for r in identify(spark.createDataFrame(asked, "doc_id long, text string"), model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and got[1].score == 0
    assert got[4].lang_pred == "de" and got[5].lang_pred == got[None].lang_pred == "en" and got[6].lang_pred in ("de", "en")
    none = fit(docs.limit(0), F.lit(True))
    assert {r.lang_pred for r in identify(docs, none).collect()} == {"und"}
    one = fit(docs.where("lang = 'de'"), F.lit(True))
    assert {r.lang_pred for r in identify(docs, one).collect()} == {"de"}


def test_codewords_keep_their_distance():
    for n in (1, 2, 4, 5, 9, 30):
        code = codewords(n, np.random.default_rng(0))
        assert len({tuple(c) for c in code}) == n or n == 1
        if n >= 4:
            assert min((code[i] != code[j]).sum() for i in range(n) for j in range(i)) >= 4


# --- embeddings -------------------------------------------------------------------------------------------------

def brute_links(rows, threshold=0.93):
    vec = {}
    for i, e, label in rows:
        if i is None or e is None or label is None or not e or any(x is None or not np.isfinite(x) for x in e) or not any(e):
            continue
        vec[i] = (label, np.array(e, np.float32).astype(np.float64))
    links = {r[0]: set() for r in rows}
    for a, (la, x) in vec.items():
        for b, (lb, y) in vec.items():
            if a != b and la == lb and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                links[a].add(b)
    return links


def test_embeddings_against_all_pairs(spark):
    rng = np.random.default_rng(5)
    rows, k = [], 0
    for c in range(30):
        centre = rng.normal(size=32)
        for _ in range(rng.integers(1, 30)):
            e = centre + rng.normal(size=32) * rng.choice([0.02, 0.15, 0.26, 0.4])
            rows.append((k, [float(np.float32(x)) for x in e * rng.uniform(0.1, 10)], int(c % 3)))
            k += 1
    rows += [(1000 + i, rows[0][1], rows[0][2]) for i in range(700)]                       # a large group of copies
    rows += [(2000, None, 1), (2001, [0.0] * 32, 1), (2002, [float("nan")] + [1.0] * 31, 1), (2003, [None] + [1.0] * 31, 1),
             (2004, rows[0][1], None), (2005, rows[0][1][:16], rows[0][2]), (2006, [], 1), (2007, [1e30] * 32, 7), (2008, [1e-30] * 32, 7),
             (None, rows[0][1], 0), rows[3]]
    table = spark.createDataFrame([(*r, "t") for r in rows], "vec_id long, embedding array<float>, label int, side string")
    got = {r.vec_id: r for r in link_embeddings(table).collect()}
    links = brute_links(rows)
    missed = sum(abs(got[i].n_links - len(links[i])) for i in links if i is not None)
    assert missed <= 0.001 * sum(map(len, links.values()))
    component = {}
    for i in sorted(x for x in links if x is not None):
        if i not in component:
            todo = [i]
            while todo:
                x = todo.pop()
                if x not in component:
                    component[x] = i
                    todo += links[x]
    assert {i: got[i].component_id for i in component} == component
    assert all(got[i].kept == (component[i] == i) for i in component)
    assert (got[None].n_links, got[None].component_id, got[None].kept) == (0, None, False)
    assert link_embeddings(table.limit(0)).count() == 0


def test_embedding_recall_on_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = {r.vec_id: r.n_links for r in QUERIES["op5_embedding_neardup"](spark, SF).collect()}
    want = {i: len(x) for i, x in brute_links(rows).items()}
    assert sum(got.values()) >= 0.999 * sum(want.values()) and all(got[i] <= want[i] for i in want)


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 400), (400, 450), (None, 3), (7, 7)]
    got = {r.node: r.component for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(201)} | {400: 400, 450: 400, 500: 400}


# --- n-gram join ------------------------------------------------------------------------------------------------

def test_signatures_are_long_enough():
    """On all small sizes: the first ``need`` common tokens stand within reach, and the reach within the signature."""
    for x in range(1, 150):
        for y in range(-(-3 * x // 4), 4 * x // 3 + 1):
            both, least = common(x, y, 75, 100), need(min(x, y))
            assert both == -(-75 * (x + y) // 175) and min(x, y) >= both >= 1
            assert least <= both
            # the l-th of ``both`` common tokens has both - l behind it, so it stands at x - (both - l) at the latest
            assert x - (both - least) <= reach(x, y, 75, 100)
            assert min(x, reach(x, y, 75, 100)) <= signature_length(x, 75, 100)


def test_join_against_all_pairs(spark):
    from test_llm_oracles import jaccard_components

    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    texts, k = {}, 0
    for _ in range(40):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(3, 200))]
        if rng.random() < 0.5:
            words += passage
        for _ in range(rng.choice([1, 1, 2, 12])):
            own = [rng.choice(vocabulary) if rng.random() < rng.choice([0, 0.005, 0.02, 0.04]) else w for w in words]
            texts[k] = rng.choice([" ", "\n", "\t\t"]).join(own).upper() if rng.random() < 0.3 else " ".join(own)
            k += 1
    texts |= {1000: None, 1001: "", 1002: " \n", 1003: "one two", 1004: "One  two", 1005: "one two three four five", 1006: "ÄB c", 1007: "äb c"}
    rows = [(i, t, "x") for i, t in texts.items()] + [(None, "one two", "x"), (1003, "one two", "x")]
    table = spark.createDataFrame(rows, "doc_id long, text string, n string")
    got = {r.doc_id: r for r in link_documents(table).collect()}
    component, sets = jaccard_components(texts)
    assert {i: got[i].component_id for i in texts} == component
    assert {i: got[i].n_shingles for i in texts} == {i: len(s) for i, s in sets.items()}
    assert got[None].component_id is None
    assert link_documents(table).count() == len(rows) and link_documents(table.limit(0)).count() == 0


# --- BPE --------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(byte_bpe_path())


def test_codec_agrees_with_the_library(tokenizer):
    rng = random.Random(1)
    own = bpe_codec.codec(byte_bpe_path())
    pool = "".join(map(chr, [9, 10, 13, *range(0x20, 0x7F), *range(0xC0, 0x250)])) + "\u2003日本\u0301😀\x85\xa0"
    for k in range(4000):
        text = "".join(rng.choice(pool if k % 2 else "ab 's\n\t1é!.  Z") for _ in range(rng.randint(0, 40)))
        text += "<|endoftext|>" * (k % 40 == 0)
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids
        assert own.decode(ids).decode("utf-8", "replace") == tokenizer.decode(ids, skip_special_tokens=False)


def test_chunks_are_reused_exactly(spark, tokenizer):
    rng = random.Random(2)
    words = ["the", "and", "thingly", "été", "won't", "3.14", "x" * 30, "ß", "日本"]
    passages = [" ".join(rng.choice(words) for _ in range(800)) for _ in range(3)]
    texts = [rng.choice(["", " ", "\n"]).join(rng.choice([*passages, " ".join(rng.choice(words) for _ in range(rng.randint(0, 300)))])
                                              for _ in range(rng.randint(0, 4))) for _ in range(40)]
    texts += [None, "", " ", "a" * 40_000, "<|endoftext|> a <|endoftext|>", passages[0], passages[0]]
    rows = [(i, t, "z") for i, t in enumerate(texts)] + [(None, passages[1], "z"), (0, "another text with this id " * 200, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    encoded = bpe_codec.encode_corpus(docs, byte_bpe_path()).cache()
    want = []
    for i, t, _ in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in encoded.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    back = sorted(((r.doc_id, r.text) for r in bpe_codec.decode_corpus(encoded, byte_bpe_path()).collect()), key=repr)
    assert back == sorted(((i, t or "") for i, t, _ in rows), key=repr)
    assert bpe_codec.encode_corpus(docs.limit(0), byte_bpe_path()).count() == 0


def test_equal_passages_give_equal_chunks():
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(6000)).encode()
    cuts = []
    for head in (b"", b"some other text before it " * 40):
        data = np.frombuffer(head + passage, np.uint8)
        (_, borders), = bpe_codec.text_chunks(data, np.array([0, len(data)]))
        cuts.append({b - len(head) for b in borders if b - len(head) > 1500})
    assert len(cuts[0] & cuts[1]) >= 2


def test_language_training_keeps_every_language(spark):
    from pyspark.sql import functions as F
    from sparkfold.llm.language_id import _pack, features, training_rows

    docs = spark.range(10_050).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"), F.concat(F.lit("l"), "id").alias("lang"))
    assert training_rows(docs, F.lit(True), 300, "doc_id", "text", "lang").count() == 10_050
    assert [int((row > 0).sum()) for row in features(*_pack(["", "a", "ab", "abc"]))] == [0, 0, 1, 3]
    assert int((features(*_pack(["ab"])) > 0).sum()) == 1


def test_codec_loads_the_library_only_for_pieces_that_need_it():
    import public_tokenizers

    from sparkfold.llm.bpe_codec import Codec

    own = Codec(public_tokenizers.path("byte_bpe_50k.json"))
    plain = own.encode("plain words, déjà vu")
    assert plain and "slow" not in vars(own)
    other = own.encode("snow ☃ 雪")
    assert own.slow.encode("snow ☃ 雪", add_special_tokens=False).ids == other and own.slow.encode("plain words, déjà vu", add_special_tokens=False).ids == plain
