"""Packages as other tools write them, ids of records, and revisits that have lost their response."""

import gzip
import hashlib
import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from marketlake.llm import url_filter, warc_zip

PAYLOADS = [b"first page", b"second page", "dritte Seite é".encode()]


def package(index: str, lines: bytes, warc: str = "archive/rec.warc.gz") -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.writestr(warc, b"".join(RAWS))
        z.writestr("datapackage.json", b"{}")
        z.writestr("pages/pages.jsonl", b"{}\n")
        z.writestr(index, lines)
        z.writestr("indexes/index.idx", b"!meta 0 {}\n")
    return out.getvalue()


RAWS = [warc_zip.record({"WARC-Type": "response", "WARC-Target-URI": f"http://x/{i}"}, b) for i, b in enumerate(PAYLOADS)]
SPOTS = [(sum(map(len, RAWS[:i])), len(r)) for i, r in enumerate(RAWS)]
CDXJ = "".join(f"com,x)/{i} 2024010100000{i} {json.dumps({'url': f'http://x/{i}', 'offset': str(o), 'length': str(n), 'filename': 'rec.warc.gz', 'note': 'a} {b'})}\n" for i, (o, n) in enumerate(SPOTS)).encode()
CDX = (" CDX N b a m s k r M S V g\n" + "".join(f"com,x)/{i} 2024010100000{i} http://x/{i} text/html 200 AAAA - - {n} {o} rec.warc.gz\n" for i, (o, n) in enumerate(SPOTS))).encode()


@pytest.mark.parametrize("piece", [7, 1 << 20])
@pytest.mark.parametrize(
    ("index", "lines"),
    [
        ("indexes/index.cdxj", CDXJ), ("indexes/index.cdx", CDXJ.rstrip(b"\n")), ("indexes/index.cdx.gz", gzip.compress(CDXJ)), ("indexes/index.cdx", CDX.replace(b"\n", b"\r\n")), ("indexes/index.cdx.gz", gzip.compress(CDX)),
        # Lines in blocks of their own, as compressed indexes with a second index have them.
        ("indexes/index.cdxj.gz", gzip.compress(b'!meta 0 {"format": "cdxj-gzip-1.0"}\n') + b"".join(gzip.compress(x + b"\n") for x in CDXJ.rstrip(b"\n").split(b"\n"))),
    ],
)
def test_indexes_of_other_tools(index, lines, piece, monkeypatch):
    monkeypatch.setattr(warc_zip, "PIECE", piece)
    raw = package(index, lines)
    got = list(warc_zip.records(lambda at, n: raw[at : at + n], len(raw)))
    assert [b for _, b in got] == PAYLOADS and [f["warc-target-uri"] for f, _ in got] == [f"http://x/{i}" for i in range(3)]


def test_index_that_names_a_missing_file():
    raw = package("indexes/index.cdxj", CDXJ.replace(b"rec.warc.gz", b"gone.warc.gz"))
    with pytest.raises(ValueError, match="gone"):
        list(warc_zip.records(lambda at, n: raw[at : at + n], len(raw)))


def test_ids_are_unique_and_revisits_are_resolved(spark):
    rows = [(1, "y" * 120), (1, "y" * 120), (2, "y" * 120), (3, "z"), (3, "z"), (None, "y" * 120), (4, None), (5, "é" * 60), (6, "é" * 60)]
    df = spark.createDataFrame(rows, "page_id long, html string").withColumn("url", F.concat(F.lit("http://www.Ex.org/ä b/"), "page_id"))
    marked = warc_zip.mark_revisits(df, "page_id", "html", "url")
    heads = []
    for volumes in (warc_zip.write_archives(marked, volume_bytes=400).collect(), warc_zip.write_archives(marked).collect()):
        for v in volumes:
            raw = open(v.path, "rb").read()
            heads += [f for f, _ in warc_zip.records(lambda at, n, raw=raw: raw[at : at + n], len(raw))]
            with zipfile.ZipFile(io.BytesIO(raw)) as z:
                lines = z.read(warc_zip.CDX).decode().splitlines()
            assert lines == sorted(lines) and all(json.loads(x[x.index("{") :])["filename"] == "data.warc.gz" for x in lines)
    assert len(heads) == 18 and len({f["warc-record-id"] for f in heads}) == 18
    revisit = next(f for f in heads if f["warc-type"] == "revisit" and f["page-key"] == "<urn:page:6>")
    assert revisit["warc-refers-to-target-uri"] == "http://www.Ex.org/%C3%A4%20b/5" and revisit["warc-refers-to-date"] == revisit["warc-date"] and "warc-refers-to" not in revisit
    volumes = warc_zip.write_archives(marked)
    for payloads in (True, False):
        got = {(r.key, r.record_type, r.refers_to, r.payload_bytes, r.payload) for r in warc_zip.read_archives(volumes, payloads=payloads).collect()}
        text = lambda t: t if payloads else None
        assert got == {
            (1, "response", None, 120, text("y" * 120)), (2, "revisit", 1, 120, None), (None, "revisit", 1, 120, None), (3, "response", None, 1, text("z")),
            (4, "response", None, 0, text("")), (5, "response", None, 120, text("é" * 60)), (6, "revisit", 5, 120, None),
        }
    # Without its response, a revisit keeps its digest and has no length.
    lost = warc_zip.write_archives(marked.where("_key = 2"))
    r = warc_zip.read_archives(lost).first()
    assert (r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) == ("revisit", 1, None, hashlib.sha256(b"y" * 120).hexdigest())


def test_addresses_with_clashing_columns(spark):
    names = ["_p", "_raw", "_block", "_features", "_grams", "_label", "_y", "verdict", "rule"]
    rows = spark.createDataFrame([(i, f"http://a{i}.{'com' if i % 2 else 'net'}/en/{i}") for i in range(20)] + [(30, "http://x.example/1"), (31, None)], "page_id long, url string")
    rules = [url_filter.Rule("block", "com", "/en/"), url_filter.Rule("allow", "net", "/en/")]
    plain = {r.page_id: (r.rule, r.verdict, r.block_probability) for r in url_filter.judge(rows, rules).collect()}
    out = url_filter.judge(rows.withColumns({c: F.lit("clash") for c in names}), rules)
    assert {r.page_id: (r.rule, r.verdict, r.block_probability) for r in out.collect()} == plain
    assert set(out.columns) == {"page_id", "url", "host", "path", "block_probability", *names}
    assert all(out.where(F.col(c) != "clash").isEmpty() for c in names[:7])
    only = url_filter.judge(rows.withColumns({c: F.lit("clash") for c in names}), rules[:1])
    assert set(only.columns) == set(out.columns)
