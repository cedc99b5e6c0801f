"""Registered queries of this subpackage on the smallest tables, against SQL or brute force."""

import hashlib
import re
import zlib
from collections import Counter

import pytest
from oracle import connect, same

from marketlake.llm import queries as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").collect()


def run(spark, sf_dir, name, key="doc_id"):
    return {r[key]: r for r in Q.queries()[name](spark, sf_dir).collect()}


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_sql(spark, sf_dir, name):
    same(Q.queries()[name](spark, sf_dir), connect(sf_dir), Q.oracle_sql()[name])


def test_op1(spark, sf_dir, docs):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=Q.tokenizer("piece_bpe_32k.model"))
    got = run(spark, sf_dir, "op1_sentencepiece")
    for d in docs:
        ids = sp.encode(d.text or "") + [sp.eos_id()]
        want = len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()
        assert tuple(got[d.doc_id])[1:] == want


def test_op3(spark, sf_dir, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(Q.tokenizer("byte_bpe_50k.json"))
    got = run(spark, sf_dir, "op3_token_counts")
    for d in docs:
        n = len(t.encode(d.text or "", add_special_tokens=False).ids)
        assert tuple(got[d.doc_id])[1:] == (len((d.text or "").encode()), n, n > 512)


def test_op5(spark, sf_dir, docs):
    got = run(spark, sf_dir, "op5_quality_rules")
    for d in docs:
        words = WORD.findall(d.text or "")
        windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        cover = {i + j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(8)}
        seen, again = set(), 0
        for line in (d.text or "").split("\n"):
            if WORD.search(line):
                again += line in seen
                seen.add(line)
        r = got[d.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", d.text or "")), again, len(cover))
        assert r.base_failed == (len(words) < 20 or 100 * len(cover) > 30 * len(words))
        assert not (r.base_failed and r.kept)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    good = [got[i].kept for i in got if labels.get(i) == 1 and not got[i].base_failed]
    assert sum(good) >= 0.97 * len(good)


def test_op6(spark, sf_dir):
    got = run(spark, sf_dir, "op6_url_filters", "page_id")
    for p in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", p.url or "")
        host, path = (m[1], m[2]) if m else ("", "")
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fits = [r for r in Q.URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        rule = max(fits, key=lambda r: len(r.name), default=None)
        r = got[p.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule and rule.name) and r.verdict in ("allow", "block")
        assert not rule or r.verdict == rule.verdict


def test_op10(spark, sf_dir, docs):
    got = run(spark, sf_dir, "op10_sharding")
    counts = Counter(r.shard for r in got.values())
    assert set(counts) <= set(range(40)) and max(counts.values()) - min(counts[s] for s in range(40)) <= 1
    for s, n in counts.items():
        assert sorted(r.slot for r in got.values() if r.shard == s) == list(range(n))
    for d in docs:
        raw = (d.text or "").encode()
        assert (got[d.doc_id].size, got[d.doc_id].text_crc32) == (len(raw) + 16, zlib.crc32(raw))


def test_native_plans(spark, sf_dir):
    for name in ("op4_chat_formatting", "op9_decontamination", "op10_sharding"):
        plan = Q.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def test_pipeline(spark, sf_dir, docs):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontamination", "sentencepiece"]
    out = corpus_pipeline.run(spark, sf_dir)
    ids = [r.doc_id for r in out.collect()]
    assert 0 < len(ids) < len(docs) and len(set(ids)) == len(ids) and out.where("NOT round_trip").count() == 0


def plain_heads(rows):
    """Ids that stay of each group of near copies: five-word shingles, similarity 0.8 or more."""
    words = {k: WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) for k, t in rows}
    sets = {k: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for k, w in words.items() if w}
    holders, root = {}, {k: k for k in words}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for k in sorted(sets):
        shared = Counter(j for s in sets[k] for j in holders.get(s, ()))
        for j, n in shared.items():
            if 100 * n >= 80 * (len(sets[k]) + len(sets[j]) - n):
                a, b = sorted((find(j), find(k)))
                root[b] = a
        for s in sets[k]:
            holders.setdefault(s, []).append(k)
    return {k for k in words if find(k) == k}


def plain_clean(rows, items):
    """Ids of documents with fewer than one word in twenty inside a window of thirteen words of an item."""
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    windows = {}
    for w in map(cut, items):
        for i in range(max(1, len(w) - 12)) if w else ():
            windows.setdefault(len(w[i : i + 13]), set()).add(tuple(w[i : i + 13]))
    for k, t in rows:
        w = cut(t)
        hit = {i + j for n, known in windows.items() for i in range(len(w) - n + 1) if tuple(w[i : i + n]) in known for j in range(n)}
        if not hit or 20 * len(hit) < len(w):
            yield k


def test_pipeline_stages_equal_plain_versions(spark, sf_dir, docs):
    import corpus_pipeline as P
    import sentencepiece

    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(d.doc_id, d.text) for d in docs]
    got = [r.doc_id for r in P.quality_stage(spark, table, sf_dir).collect()]
    assert sorted(got) == sorted(k for k, r in run(spark, sf_dir, "op5_quality_rules").items() if r.kept)
    # Near copies and benchmark passages are looked for in all documents, so that there are some to find.
    got = [r.doc_id for r in P.dedup_stage(spark, table, sf_dir).collect()]
    assert sorted(got) == sorted(plain_heads(rows)) and len(got) < len(rows)
    got = [r.doc_id for r in P.decontaminate_stage(spark, table, sf_dir).collect()]
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text").collect()]
    assert sorted(got) == sorted(plain_clean(rows, items)) and len(got) < len(rows)
    sp = sentencepiece.SentencePieceProcessor(model_file=Q.tokenizer("piece_bpe_32k.model"))
    texts = dict(rows)
    for r in P.encode_stage(spark, table, sf_dir).collect():
        ids = sp.encode(texts[r.doc_id] or "") + [sp.eos_id()]
        assert (r.ids, r.n_tokens, r.round_trip) == (ids, len(ids), sp.decode(ids) == (texts[r.doc_id] or ""))


def test_pipeline_stages_take_anything(spark, sf_dir, edge, none):
    import corpus_pipeline

    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, sf_dir).count() == 0
        out = stage(spark, edge, sf_dir)
        out.collect()
    ids = sorted((r.doc_id, r.text) for r in corpus_pipeline.dedup_stage(spark, edge, sf_dir).where("doc_id IN (6, 7)").collect())
    assert ids == [(6, "a b c d e f g h")]


def test_dedup_stage_judges_rows_not_ids(spark, sf_dir):
    import corpus_pipeline

    copied, unique = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = spark.createDataFrame([(3, copied), (5, copied), (5, unique), (None, copied)], "doc_id long, text string")
    assert sorted(corpus_pipeline.dedup_stage(spark, rows, sf_dir).collect()) == [(3, copied), (5, unique)]


def test_pipeline_tells_rows_apart(spark, monkeypatch):
    import corpus_pipeline as P
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(1, None, "x"), (1, "x", None), (None, "a", "b"), (None, "a", "b"), (2, "", ""), (2, None, ""), (2, "", None)], "doc_id long, text string, lang string").withColumns({"_row": F.lit(1), "_ROW_hit": F.lit(2)})
    for clash in (False, True):
        if clash:  # every first hash is the same: the second tells the rows apart
            monkeypatch.setattr(P, "hashes", lambda c: (F.lit(7).cast("long"), F.xxhash64(F.lit(2), *c)))
        tagged, name = P.tagged(rows)
        got = tagged.collect()
        assert len(got) == 7 and len({r[name] for r in got}) == 6 and set(rows.columns) < set(tagged.columns)
        assert len({r[name] for r in got if r.doc_id is None}) == 1


def test_op2(spark, sf_dir, docs):
    """The registered query against counts in dictionaries, up to the quantised parts of each token's probability."""
    import math

    def words_of(text):
        return [w for w in WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))]

    held = {d.doc_id: zlib.crc32(str(d.doc_id).encode()) % 5 == 1 for d in docs}
    one, two, three = Counter(), Counter(), Counter()
    for d in docs:
        if not held[d.doc_id]:
            seq = ["<s>", *words_of(d.text), "</s>"]
            one.update(seq)
            two.update(zip(seq[:-1], seq[1:], strict=True))
            three.update(zip(seq[:-2], seq[1:-1], seq[2:], strict=True))
    n = sum(c for w, c in one.items() if w != "<s>")
    v = len(one) - 1
    p1 = lambda w: (one[w] + 0.5) / (n + 0.5 * (v + 1))
    p2 = lambda u, w: (two[u, w] + 150 * p1(w)) / (one[u] + 150)
    p3 = lambda t, u, w: (three[t, u, w] + 5 * p2(u, w)) / (two[t, u] + 5)
    for r in run(spark, sf_dir, "op2_lm_scoring").values():
        seq = ["<s>", *words_of(next(d.text for d in docs if d.doc_id == r.doc_id)), "</s>"]
        tokens = seq[1:]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(tokens), sum(one[w] > 0 for w in tokens), n)
        assert abs(r.base_score - sum(math.log10(p1(w)) for w in tokens)) < 1e-6 * len(tokens)
        score = math.log10(p2("<s>", tokens[0])) + sum(math.log10(p3(*x)) for x in zip(seq[:-2], seq[1:-1], seq[2:], strict=True))
        assert abs(r.score - score) <= 0.001 * len(tokens)


def test_op2_with_numbers_beyond_32_bits(spark, sf_dir, monkeypatch):
    """Wide numbers of words and more parts give the same scores."""
    from marketlake.llm import ngram_trie

    some = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").where("doc_id < 80")
    score = lambda: sorted(map(tuple, ngram_trie.score(some, ngram_trie.build(some)).collect()))
    want = score()
    monkeypatch.setattr(ngram_trie, "NARROW", 0)
    assert score() == want


def test_distinct_pairs():
    import numpy as np

    from marketlake.llm import ngram_trie

    r = np.random.default_rng(1)
    u, v = r.integers(-1, 9, 500), r.integers(-1, 9, 500)
    for a, b in zip(ngram_trie.distinct_pairs(u, v, True), ngram_trie.distinct_pairs(u, v, False), strict=True):
        assert (a == b).all()
