"""Periodic runs, main texts and whitening against plain versions, and their edge cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marketlake.llm import main_text, periodic, whitening
from marketlake.llm import queries as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(ws):
    """Every period by itself, then only those that no smaller period explains."""
    n, found = len(ws), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and ws[j] == ws[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    runs = sorted((i, length, q) for (i, length), q in found.items())
    gone = {k for i, length, q in runs for k in range(i + q, i + length)}
    return runs, " ".join(w for k, w in enumerate(ws) if k not in gone)


def fuzz(seed, n):
    rng = random.Random(seed)
    for _ in range(n):
        letters = "abcdefgh"[: rng.choice([1, 2, 2, 3, 8])]
        ws = [rng.choice(letters) for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            block = [rng.choice(letters) for _ in range(rng.randint(1, 30))]
            at = rng.randint(0, len(ws))
            ws[at:at] = block * rng.randint(2, 7) + block[: rng.randint(0, len(block))]
        yield rng.choice([" ", "\n", " \t "]).join(ws)


def test_periodic_runs_equal_brute_force_across_slices(spark):
    # Texts lie side by side in one batch: no run may reach from one into the next.
    texts = [*fuzz(3, 600), None, "", " \n", "a " * 50000]
    rows, rest = periodic.runs_and_rest(pa.array(texts))
    for text, got, left in zip(texts[:-1], rows.to_pylist(), rest.to_pylist(), strict=False):
        assert ([tuple(r.values()) for r in got], left) == plain_runs((text or "").split())
    assert rows.to_pylist()[-1] == [{"start": 0, "length": 50000, "period": 1}] and rest.to_pylist()[-1] == "a"


def test_periodic_runs_edges(edge, none):
    out = periodic.periodic_runs(edge)
    assert out.columns == [c for c in edge.columns if c != "text"] + ["runs", "collapsed"]
    want = {(r.doc_id, *map(str, plain_runs(WORD.findall(r.text or "")))) for r in edge.collect()}
    assert {(r.doc_id, str([tuple(x) for x in r.runs]), r.collapsed) for r in out.collect()} == want
    assert periodic.periodic_runs(none).count() == 0
    clash = periodic.periodic_runs(edge.withColumns({"runs": F.lit(1), "collapsed": F.lit(2)}))
    assert clash.columns.count("runs") == 1 and clash.count() == edge.count()


def test_op13_equals_brute_force(spark, sf_dir):
    got = {r.doc_id: r for r in Q.op13_periodic_runs(spark, sf_dir).collect()}
    for d in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ws, h = WORD.findall(d.text or ""), zlib.crc32(str(d.doc_id).encode())
        if h % 10 == 0 and ws:
            n, g = len(ws), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            ws = ws[:a] + [ws[a + (i - a) % p] for i in range(a, n)]
        if len(ws) > 3000:
            continue  # the plain version is quadratic; SQL covers these
        runs, rest = plain_runs(ws)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want = (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha("".join("%d,%d,%d\n" % r for r in runs)), sha(rest))
        assert tuple(got[d.doc_id])[1:] == want


PAGES = [
    (None, ""), ("", ""), ("plain only", "plain only"), ("<p>one<p>two", "one\n\ntwo"), ("<div><", "<"), ("<nav>menu</nav>", ""),
    ("<article>A<div>B</div>C</article>", "A\n\nB\n\nC"),
    # Everything that isn't the article, inside and around it; short and long.
    (
        "<html><head><title>t</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><ul><li><a href='/'>Home</a></ul></nav><div class='cookie-notice'>" + "We use cookies. " * 40
        + "</div><article><header><h1>T</h1></header><p>x<aside>side</aside><form><input>q<button>b</button></form><p class='ad'>buy</p><script>if (a<b) '</p>'</script><p>y<br>z</p><footer>f</footer></article>"
        + "<section id='comments'><article class='comment'>" + "Reader says things. " * 60 + "</article></section><div class=sidebar><p>s</p></div><footer>&copy; c</footer>",
        "T\n\nx\n\ny z",
    ),
    # References, white space inside a block, comments, tables, lists, unclosed tags.
    ("<article><p><b>a &lt;b&gt; &amp;amp; &#x41;&nbsp;c &am &amp<!-- <p>no</p> -->d\n\t e<ul><li>1<li>2</ul><table><tr><td>3<td>4</table>5 < 6</article>", "a <b> &amp; A c &am &d e\n\n1\n\n2\n\n3\n\n4\n\n5 < 6"),
    # No element marks the article: surge and dive.
    ("<body><div>Home | About</div><h2>Title</h2><p>" + "Article text. " * 20 + "</p><p>Short.</p><p>" + "More of it. " * 20 + "</p><div>Copyright</div>", "Title\n\n" + ("Article text. " * 20).strip() + "\n\nShort.\n\n" + ("More of it. " * 20).strip()),
    ("<ul><li><a href=1>one link</a><li><a href=2>other link</a></ul><div class=post><div class=post-header><h2>H</h2></div><p>" + "Body. " * 30 + "</p></div><div class=related>r</div>", "H\n\n" + ("Body. " * 30).strip()),
    # Names that only look like what is stripped; forms around a whole page.
    ("<div class='page has-sidebar no-ads'><main><p>m</p></main></div>", "m"),
    ("<form id=aspnet><article><p>whole page</p></article></form>", "whole page"),
    ("<html><head><title>never closed</title><p>para", "para"), ("<script>never ends <p>x</p>", ""), ("<article>a<!-- never ends <p>x</p>", "a"),
    ("<div>" * 3000 + "deep" + "</section>" * 3000, "deep"),
    ("<article>" + "<p>w</p>" * 20000 + "</article>", "\n\n".join(["w"] * 20000)),
]


def test_main_text(spark):
    assert [main_text.extract(html) for html, _ in PAGES] == [text for _, text in PAGES]
    rows = [(i if i else None, None if i == 1 else "u", html, "clash") for i, (html, _) in enumerate(PAGES + PAGES[-3:])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = main_text.extract_main_text(pages)
    assert out.columns == ["page_id", "url", "text"]
    assert sorted((r.page_id or 0, r.text) for r in out.collect()) == sorted((i, text) for i, (_, text) in enumerate(PAGES + PAGES[-3:]))
    assert main_text.extract_main_text(pages.where("false")).count() == 0


def test_window_sums_decide_where_nothing_is_marked():
    page = main_text.Page("<div>tiny</div><div><p>" + "a" * 100 + "<p>b<p>c</div><div>" + "d" * 90 + "</div>")
    assert page.hills(list(range(5))) == [(0, 0, 4), (1, 3, 102), (4, 4, 90)]
    assert [len(x) for x in page.main()] == [100, 1, 1]  # the middle container holds more than half


def dense(rows):
    x = np.array(rows, dtype=np.int64)
    c = x - x.mean(0)
    e, u = np.linalg.eigh(c.T @ c / len(x))
    return c, e[::-1], u[:, ::-1]


def test_op11_equals_dense_decomposition(spark, sf_dir):
    got = Q.op11_embedding_whitening(spark, sf_dir).toPandas()
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    rows = [(i, v) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    x = [[int(np.floor(1024 * float(c))) + 100000 for c in v] for _, v in rows]
    c, e, u = dense(x)
    n, sums = len(x), np.array(x).sum(0)
    assert len(got) == 8 * n and set(got.n) == {n} and got.identity_error.max() < 1e-9
    deviation = {i: int(((n * np.array(v) - sums) ** 2).sum()) for (i, _), v in zip(rows, x, strict=True)}
    assert all(deviation[i] == d for i, d in zip(got.vec_id, got.deviation, strict=True))
    table = got.pivot(index="vec_id", columns="component", values="whitened").loc[[i for i, _ in rows]].to_numpy()
    want = c @ u[:, :8] / np.sqrt(e[:8])
    assert np.abs(table * np.sign((table * want).sum(0)) - want).max() < 1e-9
    shares = got.drop_duplicates("component").sort_values("component").explained.to_numpy()
    assert np.abs(shares / (e[:8] / e.sum()) - 1).max() < 1e-9


def test_whitening_of_badly_scaled_and_dependent_columns(spark):
    m = (np.random.default_rng(0).normal(size=(300, 6)) * [1e6, 1e4, 100, 3, 1, 1]).astype(int)
    m[:, 5] = m[:, 0] + m[:, 1]
    df = spark.createDataFrame([(i, [int(v) for v in row]) for i, row in enumerate(m)], "vec_id long, x array<long>").repartition(3)
    basis = whitening.fit(df, "x")
    _, e, _ = dense(m)
    assert len(basis.variances) == 5 and np.abs(basis.variances / e[:5] - 1).max() < 1e-9
    assert whitening.identity_error(df, "x", basis) < 1e-9


def test_whitening_edges(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.0]), (1, [0.5, 1.0]), (2, [-1.0, 3.0]), (None, [2.0, 2.0]), (3, None), (4, [nan, 1.0]), (5, [1.0, -inf]), (6, [None, 1.0]), (7, [1.0]), (8, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"x": F.lit("clash"), "whitened": F.lit(0)})
    assert sorted(str(r.vec_id) for r in whitening.usable(df, "embedding").collect()) == ["1", "1", "2", "None"]
    for name, some in (("rows", df), ("none", df.where("false")), ("one", df.where("vec_id = 2")), ("same", df.where("vec_id = 1")), ("odd", df.where("vec_id > 2"))):
        some.write.parquet(f"{tmp_path}/{name}/embeddings.parquet")
    out = Q.op11_embedding_whitening(spark, f"{tmp_path}/rows").collect()
    assert len(out) == 8 and {r.component for r in out} == {1, 2} and out[0].n == 4 and out[0].identity_error < 1e-9
    for name in ("none", "one", "same"):
        assert Q.op11_embedding_whitening(spark, f"{tmp_path}/{name}").collect() == []
    assert {r.vec_id for r in Q.op11_embedding_whitening(spark, f"{tmp_path}/odd").collect()} == set()
    wide = whitening.whiten(df.where("vec_id = 1").withColumn("v", F.array(F.lit(1), F.lit(2))), None, "v")
    assert wide.columns.count("whitened") == 1 and wide.count() == 0


@pytest.mark.parametrize("shift", [True, False])
def test_triangle_of_a_singular_matrix(shift):
    gram = np.outer([1.0, 2.0], [1.0, 2.0])
    r = whitening.triangle_of(gram, 10, shift)
    assert np.allclose(r.T @ r, gram, atol=1e-9) and r[1, 0] == 0
