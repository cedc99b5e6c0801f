"""SentencePiece, token counts and language-model scores against libraries and brute force."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from marketlake.llm import ngram_trie, pieces, token_counts
from marketlake.llm.elias_fano import Monotone, load, save
from marketlake.llm.queries import tokenizer

from .conftest import EDGE

PARTS = ["a", "b", " ", "  ", "\n", "\t", "'s", "'t", "'re", "'", "ll", "é", "▁", "漢", "1", "23", ".", "!", "<|endoftext|>", "\u3000", "\xa0", "😀", "\r\n", "ve", "the", "<0x0A>", "</s>", "\x00", "\x1c", "\x85"]


def fuzz(n=3000):
    r = random.Random(7)
    return ["".join(r.choice(PARTS) for _ in range(r.randint(0, 20))) for _ in range(n)] + [t for _, t in EDGE]


def test_pieces_equal_the_library():
    import sentencepiece

    model, texts = tokenizer("piece_bpe_32k.model"), fuzz()
    sp, table = sentencepiece.SentencePieceProcessor(model_file=model), pieces.WordTable(model)
    ids, joined = table.encode(pa.array(texts, pa.string()), decoded=True)
    decoded = table.decode(ids.offsets.to_numpy(), ids.flatten().to_numpy())
    for i, t in enumerate(texts):
        want = sp.encode(t or "") + [sp.eos_id()]
        assert ids[i].as_py() == want and decoded[i] == joined[i].as_py() == sp.decode(want)
    runs = [[1, 450, 338], [338, 2, 1, 29871], [], [29871, 29871], [10, 13, 450]]
    flat, at = np.array([x for r in runs for x in r], np.int32), np.cumsum([0, *map(len, runs)])
    assert table.decode(at, flat) == [sp.decode(r) for r in runs]


def test_word_codes():
    from marketlake.llm.common import word_codes

    texts = fuzz(500) + ["", None, " ", "A a\x0bB\x85 c", "a", " a", "a "]
    for some in (texts, [], [None], ["a b"]):
        codes, at, words = word_codes(pa.array(some, pa.string()))
        got = [[words[i].as_py() for i in codes[a:b]] for a, b in zip(at[:-1], at[1:], strict=True)]
        assert got == [[w.decode() for w in (t or "").encode().lower().split()] for t in some]


def test_pieces_forget(monkeypatch):
    monkeypatch.setattr(pieces, "TABLE_WORDS", 50)
    table, texts = pieces.WordTable(tokenizer("piece_bpe_32k.model")), fuzz(400)
    monkeypatch.setattr(pieces, "TABLE_WORDS", 10**6)
    want = pieces.WordTable(tokenizer("piece_bpe_32k.model")).encode(pa.array(texts, pa.string()))[0].to_pylist()
    monkeypatch.setattr(pieces, "TABLE_WORDS", 50)
    assert sum((table.encode(pa.array(texts[i : i + 20], pa.string()))[0].to_pylist() for i in range(0, len(texts), 20)), []) == want


def test_pieces_frames(spark, edge, none):
    model = tokenizer("piece_bpe_32k.model")
    out = pieces.encode(edge.drop("node"), model, decoded="back")
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "_k1", "n_words", "shard", "digest", "ids", "back"]
    again = {(r.doc_id, r.back, r.decoded) for r in pieces.decode(out, model).collect()}
    assert all(a == b for _, a, b in again) and pieces.encode(none, model).count() == 0


def test_token_counts_equal_the_library():
    from tokenizers import Tokenizer

    t, c, texts = Tokenizer.from_file(tokenizer("byte_bpe_50k.json")), token_counts.Counter(tokenizer("byte_bpe_50k.json")), fuzz()
    want = [len(t.encode(x or "", add_special_tokens=False).ids) for x in texts]
    assert c.count(texts).tolist() == want
    for x, n in zip(texts[:600], want, strict=False):
        parts = c.special.split(x or "")
        for size in (1, 3, 7):
            assert sum(c.blocks(p, size) for p in parts) + len(parts) - 1 == n


def test_token_maps_compose_in_any_order():
    c, r = token_counts.Counter(tokenizer("byte_bpe_50k.json")), random.Random(3)
    for _ in range(200):
        x, y, z = (c.block("".join(r.choice(["a", " ", "'s", "\n", "bc", "!"]) for _ in range(r.randint(0, 6)))) for _ in range(3))
        assert c.compose(c.compose(x, y), z) == c.compose(x, c.compose(y, z))


def test_compiled_states_are_bounded_within_a_text(monkeypatch):
    c, raw = token_counts.Counter(tokenizer("byte_bpe_50k.json")), "".join(random.Random(5).choices("abcdefghij", k=3000)).encode()
    want = c.bpe.count(raw)
    monkeypatch.setattr(token_counts, "KEPT_STATES", 20)
    c.bpe.clear()
    assert c.bpe.count(raw) == want and len(c.bpe.states) <= 22


def test_token_frames(spark, edge, none):
    out = token_counts.count_tokens(edge, tokenizer("byte_bpe_50k.json"), limit=2)
    assert out.columns[-3:] == ["n_bytes", "n_tokens", "over_limit"] and "text" not in out.columns
    got = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in out.collect()}
    assert {(1, 0, 0, False), (2, 0, 0, False), (4, 3, 1, False)} <= got
    assert token_counts.count_tokens(none, tokenizer("byte_bpe_50k.json")).count() == 0


@pytest.mark.parametrize(("universe", "n"), [(1 << 64, 500), (1000, 3000), (1 << 40, 1), (7, 3)])
def test_monotone(universe, n, tmp_path):
    r = np.random.default_rng(1)
    v = np.sort(r.integers(0, min(universe, 1 << 63), n, dtype=np.uint64))
    arrays, facts = Monotone.encode(v, universe, "x")
    save(f"{tmp_path}/f", arrays, **facts)
    arrays, facts = load(f"{tmp_path}/f")
    m = Monotone(arrays, "x", facts["x.size"], facts["x.bits"])
    assert np.array_equal(m.get(np.arange(n)), v)
    q = np.concatenate([v, r.integers(0, min(universe, 1 << 63), 500, dtype=np.uint64)])
    found = m.find(q)
    assert np.array_equal(found >= 0, np.isin(q, v)) and np.array_equal(v[found[found >= 0]], q[found >= 0])


def brute(rows, mu2, mu3):
    tok = lambda t: [b"\t", *(t or "").encode().lower().split(), b"\n"]
    train = [tok(t) for k, t in rows if zlib.crc32(b"" if k is None else str(k).encode()) % 5 != 1]
    uni, first = Counter(x for w in train for x in w[1:]), Counter(x for w in train for x in w[:-1])
    grams = Counter(g for n in (2, 3) for w in train for g in zip(*(w[i:] for i in range(n)), strict=False))
    n, v = sum(uni.values()), len(uni)
    p = lambda x: (uni[x] + 0.5) / (n + 0.5 * (v + 1))
    p2 = lambda a, x: (grams[a, x] + mu2 * p(x)) / (first[a] + mu2)
    p3 = lambda a, b, x: (grams[a, b, x] + mu3 * p2(b, x)) / (grams[a, b] + mu3)
    for k, t in rows:
        w = tok(t)
        value = math.log10(p2(*w[:2])) + sum(math.log10(p3(*g)) for g in zip(w, w[1:], w[2:], strict=False))
        yield k, len(w) - 1, sum(uni[x] > 0 for x in w[1:]), n, sum(math.log10(p(x)) for x in w[1:]), value


@pytest.mark.parametrize("forget", [False, True])
def test_scores(spark, sf_dir, edge, forget, monkeypatch):
    rows = [(r.doc_id, r.text) for r in edge.select("doc_id", "text").collect()] + [(r.doc_id + 100, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    if forget:
        monkeypatch.setattr(ngram_trie, "KEPT_WORDS", 100)
        monkeypatch.setattr(ngram_trie, "KEPT_GRAMS", 100)
        monkeypatch.setattr(ngram_trie, "PACKED_BITS", 0)
        monkeypatch.setattr(ngram_trie, "SLICE", 2000)
    got = sorted((tuple(r) for r in ngram_trie.score(df, ngram_trie.build(df, 20.0, 3.0), 20.0).collect()), key=str)
    want = sorted(brute(rows, 20.0, 3.0), key=str)
    for g, w in zip(sorted(got, key=lambda x: (str(x[0]), x[2])), sorted(want, key=lambda x: (str(x[0]), x[1])), strict=True):
        assert (g[0], *g[2:5]) == w[:4]
        assert g[5] == pytest.approx(w[4], rel=1e-9, abs=1e-9) and g[6] == pytest.approx(w[5], abs=1.2e-3 * w[1])


def test_upper_levels_are_read_by_one_task_each(spark, sf_dir, tmp_path, monkeypatch):
    """Each part's file is opened once for all texts, not by every slice of every task, so the work grows as the texts do."""
    log, plain = str(tmp_path / "log"), ngram_trie.Trie

    class Logged(plain):
        def _file(self, name, *more):
            if name.startswith("grams"):
                with open(log, "a") as f:
                    f.write(f"{name}\n")
            return plain._file(self, name, *more)

    monkeypatch.setattr(ngram_trie, "Trie", Logged)
    monkeypatch.setattr(ngram_trie, "SLICE", 20_000)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").repartition(4, "doc_id")
    got = ngram_trie.score(docs, ngram_trie.build(docs)).collect()
    assert len(got) == docs.count()
    names = open(log).read().split()
    assert names and len(names) == len(set(names))


@pytest.mark.parametrize("forget", [False, True])
def test_one_shuffle_for_model_and_scores(spark, sf_dir, edge, forget, monkeypatch):
    if forget:
        monkeypatch.setattr(ngram_trie, "KEPT_GRAMS", 100)
        monkeypatch.setattr(ngram_trie, "PACKED_BITS", 0)
        monkeypatch.setattr(ngram_trie, "PART_TOKENS", 1000)
        monkeypatch.setattr(ngram_trie, "SLICE", 2000)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(60).union(edge.select("doc_id", "text"))
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    got = rows(ngram_trie.build_and_score(docs, 20.0, 3.0))
    assert got == rows(ngram_trie.score(docs, ngram_trie.build(docs, 20.0, 3.0), 20.0)) and {r[1] for r in got} == {False, True}


def test_word_hashes():
    """Neither neighbours nor the place in an array change a word's hash; words of all lengths differ."""
    words = ["x" * n for n in range(1, 200)] + ["x" * n + "y" for n in range(200)] + ["ß", "漢字", "\x00", "\x00\x00", "x" * 8 + "\x00"]
    got = ngram_trie.word_hashes(pa.array(words))
    assert len(set(got.tolist())) == len(set(words))
    assert [int(ngram_trie.word_hashes(pa.array([w]))[0]) for w in words] == got.tolist()
    assert np.array_equal(ngram_trie.word_hashes(pa.array(words)[7:]), got[7:]) and len(ngram_trie.word_hashes(pa.array([], pa.string()))) == 0


def test_few_values_are_found_without_decoding():
    v = np.sort(np.random.default_rng(2).integers(0, 1 << 40, 5000, dtype=np.uint64))
    arrays, facts = Monotone.encode(v, 1 << 40, "x")
    m = Monotone(arrays, "x", facts["x.size"], facts["x.bits"])
    assert np.array_equal(m.all(), v)
    q = np.concatenate([v[::40], v[::40] + np.uint64(1)])
    assert np.array_equal(m.find(q), np.where(np.isin(q, v), np.searchsorted(v, q), -1))


def test_scores_without_training(spark, none):
    assert ngram_trie.score(none, ngram_trie.build(none)).count() == 0
    only = spark.createDataFrame([(i, "a b") for i in range(200) if ngram_trie.held_out(i)][:3], "doc_id long, text string")
    assert {(r.train_tokens, r.base_score, r.score) for r in ngram_trie.score(only, ngram_trie.build(only)).collect()} == {(0, 0.0, 0.0)}


def test_held_out_gain(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    r = ngram_trie.score(docs, ngram_trie.build(docs)).where("held_out").selectExpr("sum(score) s", "sum(base_score) b").first()
    assert r.s > r.b


def test_maps_of_blocks_and_their_scan():
    r, c = random.Random(9), token_counts.Counter(tokenizer("byte_bpe_50k.json"))
    for text in fuzz(400):
        text = text or ""
        own = [text[i : i + 2] for i in range(0, len(text), 2)]
        if not own:
            continue
        maps = np.array([token_counts.state_map(t) for t in own])
        state, want = token_counts.START, []
        for t in own:
            want.append(state)
            for ch in t:
                state = token_counts.NEXT[state][token_counts.CLASS[ch]]
        assert token_counts.begin_states(maps).tolist() == want
        k = r.randrange(len(text) + 1)
        assert token_counts.state_map(text)[token_counts.START] == token_counts.state_map(text[k:])[token_counts.state_map(text[:k])[token_counts.START]]
        assert "".join(token_counts.cuts(text)) == text
    assert c.blocks("", 3) == 0


def test_long_texts_are_counted_in_rows(spark, edge, monkeypatch):
    """Every text beyond 40 bytes goes through blocks of 16 characters; then one of 20 MB through blocks of a megabyte, in several tasks."""
    from pyspark.sql import functions as F
    from tokenizers import Tokenizer

    path = tokenizer("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    count = lambda x: len(t.encode(x or "", add_special_tokens=False).ids)
    texts = [("".join(p), i) for i, p in enumerate([fuzz(40)[k : k + 8] for k in range(0, 40, 8)])] + [("x" * 500, 90), ("<|endoftext|>" * 9 + " a" * 40 + "<|endoftext|>", 91), ("it's " * 50 + "'re", 92), (None, 93), ("", 94), ("漢" * 300, None), ("漢" * 300, None)]
    rows = spark.createDataFrame([(i, x) for x, i in texts], "doc_id long, text string").withColumns({"_number": F.lit("clash"), "id": F.lit(1)})
    rows = rows.unionByName(edge.select("doc_id", "text"), allowMissingColumns=True)
    want = sorted((str(r.doc_id), len((r.text or "").encode()), count(r.text), count(r.text) > 30) for r in rows.collect())
    monkeypatch.setattr(token_counts, "LONG", 40)
    monkeypatch.setattr(token_counts, "BLOCK", 16)
    out = token_counts.count_tokens(rows, path, limit=30)
    assert out.columns == ["doc_id", "_number", "id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in out.collect()) == want
    monkeypatch.undo()
    text = "".join(random.Random(4).choices(["the ", "cat's ", "\n\n", "12 ", "naïve, ", "漢字 "], k=4_000_000))
    big = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert token_counts.count_tokens(big, path).first().n_tokens == sum(count(text[i:j]) for i, j in _pieces(text))


def _pieces(text, size=100_000):
    """Spans that begin at a space after a letter, where every tokenizer of this kind cuts."""
    at = 0
    while at < len(text):
        end = at + size
        while end < len(text) and not (text[end] == "t" and text[end - 1] == "\n" and text[end - 2] == " "):
            end += 1
        yield at, min(end, len(text))
        at = min(end, len(text))
