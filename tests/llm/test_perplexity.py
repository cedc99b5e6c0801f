"""The perplexity model and the verdicts of op5 against a plain version in dictionaries."""

import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from marketlake.llm import quality
from marketlake.llm import queries as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_model(words: Counter):
    """Modified Kneser-Ney over characters: log probability and log weight by n-gram and context."""
    top = Counter()
    for w, n in words.items():
        padded = "\t\t\t" + w + "\n"
        for i in range(3, len(padded)):
            top[padded[i - 3 : i + 1]] += n
    counts = {4: top}
    for order in (3, 2, 1):
        counts[order] = Counter(g[1:] for g in counts[order + 1])
    p, weight = {"": 1 / (len(counts[1]) + 1)}, {}
    for order in (1, 2, 3, 4):
        c = [0.0, *(float(sum(n == i for n in counts[order].values())) for i in range(1, 5))]
        y = c[1] / (c[1] + 2 * c[2]) if c[1] else 0.5
        d = [min(max(i - (i + 1) * y * c[i + 1] / c[i], 0.1), i - 0.1) if c[i] else min(0.5 * i, 1.0) for i in (1, 2, 3)]
        taken = {g: d[min(n, 3) - 1] for g, n in counts[order].items()}
        total, held = defaultdict(float), defaultdict(float)
        for g, n in counts[order].items():
            total[g[:-1]] += n
            held[g[:-1]] += taken[g]
        for g, n in counts[order].items():
            p[g] = (n - taken[g] + held[g[:-1]] * p[g[1:]]) / total[g[:-1]]
        weight |= {context: held[context] / total[context] for context in total}
    return p, weight


def log_p(model, g):
    p, weight = model
    if g in p:
        return math.log(p[g])
    return math.log(weight.get(g[:-1], 1.0)) + log_p(model, g[1:])


def text_of(order, high, low):
    return "".join(chr(x) for x in (high >> 21, high & (1 << 21) - 1, low >> 21, low & (1 << 21) - 1))[4 - order :]


def test_smoothing_equals_dictionaries(spark):
    texts = {"en": "the then hand and sand! thé x1 the the and the of then", None: "água não são 語は 日本 mão pão w1 w2 w3"}
    pad = " ".join(f"k{i}" for i in range(40))  # enough different words to pass the base rules
    rows = [(f"{t} {pad}", lang) for lang, t in texts.items()]
    out = quality.smoothed(quality.count_grams(spark.createDataFrame(rows, "text string, lang string"))).collect()
    want = {quality.language(lang): plain_model(Counter(WORD.findall(t))) for t, lang in rows}
    got_p, got_w = defaultdict(dict), defaultdict(dict)
    for r in out:
        if r.weight:
            # A context lies one character to the right of where the whole n-gram would have it.
            got_w[r.language][text_of(4, r.high, r.low)[5 - r.order :] if r.order > 1 else ""] = r.value
        else:
            got_p[r.language][text_of(r.order, r.high, r.low) if r.order else ""] = r.value
    assert set(got_p) == set(want)
    for lang, (p, weight) in want.items():
        assert set(got_p[lang]) == set(p) and set(got_w[lang]) == set(weight)
        assert all(got_p[lang][g] == pytest.approx(math.log(x), abs=1e-9) for g, x in p.items())
        assert all(got_w[lang][g] == pytest.approx(math.log(x), abs=1e-9) for g, x in weight.items())


@pytest.mark.parametrize("few", [10_000, 0])
def test_op5_equals_dictionaries(spark, sf_dir, few, monkeypatch):
    """The registered query, with languages broadcast and dealt over salted keys."""
    monkeypatch.setattr(quality, "FEW_LANGUAGES", few)
    monkeypatch.setattr(quality, "SALT", 8)
    got = {r.doc_id: r for r in Q.op5_quality_rules(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    words = {d.doc_id: WORD.findall(d.text or "") for d in docs}
    by_lang: dict = defaultdict(Counter)
    for d in docs:
        if not got[d.doc_id].base_failed:
            by_lang[d.lang].update(words[d.doc_id])
    models = {lang: plain_model(c) for lang, c in by_lang.items()}
    known: dict = {}

    def of_word(lang, w):
        if (lang, w) not in known:
            padded = "\t\t\t" + w + "\n"
            known[lang, w] = sum(log_p(models[lang], padded[i - 3 : i + 1]) for i in range(3, len(padded)))
        return known[lang, w]

    perplexity, symbols = {}, {}
    for d in docs:
        if d.lang in models and words[d.doc_id]:
            symbols[d.doc_id] = sum(1 + sum(c.isalnum() or ord(c) > 127 for c in w) for w in words[d.doc_id])
            perplexity[d.doc_id] = -sum(of_word(d.lang, w) for w in words[d.doc_id]) / symbols[d.doc_id]
    for lang in models:
        some = sorted(perplexity[d.doc_id] for d in docs if d.lang == lang and not got[d.doc_id].base_failed)
        low, middle, high = (some[max(0, math.ceil(q * len(some)) - 1)] for q in (0.25, 0.5, 0.75))
        for d in docs:
            if d.lang != lang:
                continue
            r = got[d.doc_id]
            if d.doc_id not in perplexity:
                assert r.log_perplexity is None and not r.kept
                continue
            assert r.log_perplexity == pytest.approx(perplexity[d.doc_id], abs=1e-4)
            slack = 1 + 60 / max(symbols[d.doc_id], 1)
            far = perplexity[d.doc_id] - middle
            inside = -6 * (middle - low) * slack - (middle - low) * slack <= far <= 6 * (high - middle) * slack + (high - middle) * slack
            assert r.kept == (not r.base_failed and inside)


def test_no_documents(spark):
    assert quality.quality(spark.createDataFrame([], "doc_id long, text string, lang string").withColumn("x", F.lit(1))).count() == 0
