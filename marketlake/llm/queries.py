"""The queries op1 to op13 and their SQL, where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bottom_k, chat, decontaminate, main_text, ngram_trie, periodic, pieces, quality, sharding, token_counts, url_filter, warc_zip, whitening
from .common import table


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, with an end id, and the text decoded from them, as digests."""
    docs, model = table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer("piece_bpe_32k.model")
    out = pieces.encode(docs, model, decoded="decoded")
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.encode(F.array_join("ids", " "), "UTF-8"), 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's probability under a model of the documents that aren't held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_trie.build_and_score(docs)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and byte-level BPE tokens of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, tokenizer("byte_bpe_50k.json"), limit=512).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations in rows of turns, and conversation -7 in the layout of messages, through one template."""
    text = "\\### Assistant: </turn> ok"
    more = spark.range(1).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.array(*(F.struct(F.lit(role).alias("role"), F.lit(text).alias("content")) for role in ("user", "assistant"))).alias("messages"),
    )
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    turns = chat.canonical(rows, "conv_id").unionByName(chat.canonical(more, "conv_id"))
    out = chat.format_turns(turns, "conv_id").withColumn("_turns", chat.parse_turns(F.col("formatted")))
    whole = F.array_join(F.transform("_turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return out.withColumn("_loss", chat.loss_text(F.col("formatted"), F.col("loss_spans"))).select(
        "conv_id",
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(whole, "UTF-8"), 256).alias("turns_sha256"),
        F.char_length("_loss").cast("long").alias("loss_chars"),
        F.sha2(F.encode("_loss", "UTF-8"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules, then bands of n-gram perplexity by language."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "log_perplexity", "lower", "upper")
    return quality.quality(docs).select(*names)


URL_RULES = [url_filter.Rule(*r.split(" ")) for r in ("block com /en/", "allow example.com /en/7", "allow net /de/", "block example.net /de/8", "block org /es/")]


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's address judged by the longest rule, else by the model."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "block_probability")


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 4-word shingles are 80 percent alike."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bottom_k.near_duplicates(docs, n=4, percent=80)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC records into ZIP archives in the shared folder, and read back by ranges of the files."""
    marked = warc_zip.mark_revisits(table(spark, sf_dir, "pages"), "page_id", "html", "url")
    return warc_zip.read_archives(warc_zip.write_archives(marked), payloads=False).select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' words inside windows of benchmark items."""
    docs, benchmark = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    out = decontaminate.find_hits(docs, benchmark)
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256).alias("items_sha256"),
        "contaminated",
    )


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents on the Hilbert curve of language, source and length, cut into 40 runs of equal counts; equal texts lie together."""
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.xxhash64(text).alias("text_hash"), (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), "lang", "source", "n_chars"
    )
    levels = [sharding.by_frequency(docs, "lang", 4), sharding.by_frequency(docs, "source", 4), sharding.by_magnitude(F.col("n_chars"), 4)]
    out = sharding.hilbert_shards(docs, levels, "doc_id", 40, group=F.col("text_hash"))
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as integers, whitened on the eight components of largest variance."""
    rows = whitening.usable(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "embedding")
    x = rows.select("vec_id", F.transform("embedding", lambda c: F.floor(1024 * c.cast("double")) + 100000).alias("x"))
    basis = whitening.fit(x, "x")
    n = basis.n if basis else 0
    basis = basis and replace(basis, components=basis.components[:8], variances=basis.variances[:8])
    error = whitening.identity_error(x, "x", basis) if basis else 0.0
    sums = F.array(*(F.lit(s).cast("long") for s in basis.sums)) if basis else F.array().cast("array<long>")
    shares = F.array(*(F.lit(float(e / basis.total)) for e in basis.variances)) if n and basis.total else F.array().cast("array<double>")
    square = F.aggregate(F.zip_with("x", sums, lambda c, s: (n * c - s).cast("decimal(19,0)")), F.lit(0).cast("decimal(38,0)"), lambda a, c: (a + c * c).cast("decimal(38,0)"))
    out = whitening.whiten(x, basis, "x").select("vec_id", square.cast("long").alias("deviation"), F.posexplode("whitened").alias("at", "whitened"))
    return out.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return main_text.extract_main_text(pages).withColumn("n_chars", F.char_length("text").cast("long"))


def with_planted_tails(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) where a tenth of the texts, by crc32 of the id, goes on periodically from some word on."""
    h = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    g, n = F.floor(h / 10), F.size("_words")
    a = F.pmod(F.col("_g"), F.col("_n"))
    p = F.lit(1) + F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8))
    tail = F.transform(F.sequence("_a", F.col("_n") - 1), lambda i: F.get("_words", (F.col("_a") + (i - F.col("_a")) % F.col("_p")).cast("int")))
    steps = {"_words": F.when(h % 10 == 0, words), "_g": g, "_n": n.cast("long"), "_a": F.when(F.col("_n") > 0, a), "_p": p}
    for name, column in steps.items():
        docs = docs.withColumn(name, column)
    whole = F.array_join(F.concat(F.slice("_words", 1, F.col("_a").cast("int")), tail), " ")
    return docs.select("doc_id", F.when(F.col("_n") > 0, whole).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, and what is left without their repetitions, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    out = periodic.periodic_runs(with_planted_tails(docs)).withColumn("_best", best)
    length, start, period = (F.col("_best").getField(c) for c in ("length", "col2", "col3"))
    return out.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-start).alias("start"),
        length.alias("length"),
        (-period).alias("period"),
        F.expr("1000 * _best.length div -_best.col3").alias("exponent_milli"),
        F.sha2(F.encode(F.array_join(lines, ""), "UTF-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_sentencepiece, op2_lm_scoring, op3_token_counts, op4_chat_formatting, op5_quality_rules, op6_url_filters, op7_minhash_near_dedup, op8_warc, op9_decontamination, op10_sharding, op11_embedding_whitening, op12_html_extraction, op13_periodic_runs)}


ORACLES: dict[str, str] = {
    "op4_chat_formatting": r"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
        esc AS (
            SELECT *, replace(replace(replace(text, '\', '\e'), '###', '\h'), '</turn>', '\t') AS body FROM rows),
        conv AS (
            SELECT conv_id, count(*) AS n_turns,
                string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, body) AS whole,
                coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, body), '') AS loss,
                sum(4 + length(role) + 2 + length(body) + 8) AS formatted_chars
            FROM esc GROUP BY conv_id)
        SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(whole) AS turns_sha256,
            CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
            CAST(formatted_chars AS BIGINT) AS formatted_chars
        FROM conv""",
    "op7_minhash_near_dedup": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
            FROM documents),
        s AS (
            SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
                ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS set
            FROM w),
        e AS (SELECT doc_id, len(set) AS n, unnest(set) AS g FROM s),
        c AS (SELECT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny, count(*) AS same
            FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
            GROUP BY ALL),
        l AS (SELECT x, y FROM c WHERE 100 * same >= 80 * (nx + ny - same)),
        sym AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
        reach(x, y) AS (SELECT x, y FROM sym UNION SELECT r.x, s.y FROM reach r JOIN sym s ON r.y = s.x),
        root AS (SELECT x, least(x, min(y)) AS root FROM reach GROUP BY x)
        SELECT s.doc_id, CAST(len(set) AS BIGINT) AS n_shingles, coalesce(root, s.doc_id) AS component_id,
            coalesce(root, s.doc_id) = s.doc_id AS kept
        FROM s LEFT JOIN root ON root.x = s.doc_id""",
    "op8_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
        f AS (SELECT digest, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY digest)
        SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes, p.digest AS payload_digest,
            CASE WHEN f.first IS NULL OR f.first = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN f.first <> p.page_id THEN f.first END AS refers_to
        FROM p LEFT JOIN f ON p.digest = f.digest AND p.n >= 100""",
    "op9_decontamination": r"""
        WITH d AS (
            SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws
            FROM documents),
        b AS (
            SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws
            FROM benchmark),
        win AS (
            SELECT DISTINCT item_id, least(13, len(ws)) AS k, array_to_string(ws[i:i + 12], ' ') AS g
            FROM b, LATERAL (SELECT unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS i) WHERE len(ws) > 0),
        place AS (
            SELECT doc_id, i, k, array_to_string(ws[i:i + k - 1], ' ') AS g
            FROM d, (SELECT DISTINCT k FROM win), LATERAL (SELECT unnest(range(1, len(ws) - k + 2)) AS i)),
        hit AS (SELECT doc_id, i, place.k, item_id FROM place JOIN win ON place.k = win.k AND place.g = win.g),
        n AS (SELECT doc_id, count(DISTINCT i + o) AS n_hit
            FROM (SELECT DISTINCT doc_id, i, k FROM hit), LATERAL (SELECT unnest(range(0, k)) AS o) GROUP BY doc_id),
        it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
            CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
            coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
        FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN it ON d.doc_id = it.doc_id""",
    "op12_html_extraction": r"""
        WITH a AS (
            SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS body FROM pages),
        b AS (
            SELECT page_id, url, list_transform(string_split_regex(body, '</?(?:p|h1)>'), lambda x:
                trim(regexp_replace(replace(replace(replace(replace(regexp_replace(regexp_replace(x, '</?(?:b|br)>', ' ', 'g'), '&amp\b;?', '&amp;', 'g'),
                    '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\s+', ' ', 'g'))) AS blocks
            FROM a)
        SELECT page_id, url, array_to_string(list_filter(blocks, lambda x: x <> ''), chr(10) || chr(10)) AS text,
            CAST(length(array_to_string(list_filter(blocks, lambda x: x <> ''), chr(10) || chr(10))) AS BIGINT) AS n_chars
        FROM b""",
    "op13_periodic_runs": r"""
        WITH hashed AS (
            SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
                CAST(doc_id AS VARCHAR) AS digits
            FROM documents),
        crc AS (
            SELECT doc_id, ws, len(ws) AS n, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(digits, ''), lambda c: unicode(c)::BIGINT)),
                lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [1::BIGINT, 2, 3, 4, 5, 6, 7, 8]),
                    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS state
            FROM hashed),
        h AS (SELECT doc_id, ws, n, xor(state, 4294967295) AS h, xor(state, 4294967295) // 10 AS g FROM crc),
        pl AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM h),
        pp AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM pl),
        d AS (
            SELECT doc_id, n, CASE WHEN a IS NULL THEN ws
                ELSE list_concat(ws[1:a], list_transform(range(a, n), lambda i: ws[1 + a + (i - a) % p])) END AS ws
            FROM pp),
        tok AS (SELECT doc_id, n, i - 1 AS i, array_to_string(ws[i:i + 3], chr(10)) AS gram
            FROM d, LATERAL (SELECT unnest(range(1, n - 2)) AS i)),
        eq AS (
            SELECT x.doc_id, x.i, y.i - x.i AS q FROM tok x JOIN tok y
            ON x.doc_id = y.doc_id AND x.gram = y.gram AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
        isl AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM eq),
        st AS (
            SELECT doc_id, min(i) AS start, max(i) - min(i) + 4 + q AS length, q AS period FROM isl GROUP BY doc_id, q, island),
        long AS (SELECT * FROM st WHERE length >= greatest(6, 4 * period)),
        run AS (
            SELECT doc_id, start, length, min(period) AS period FROM long GROUP BY doc_id, start, length),
        agg AS (
            SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
                arg_min([start, length, period], [-length, start, period]) AS best
            FROM run GROUP BY doc_id),
        gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM run),
        lost AS (SELECT doc_id, list(i) AS away FROM gone GROUP BY doc_id),
        rest AS (
            SELECT d.doc_id, array_to_string(CASE WHEN away IS NULL THEN ws
                ELSE list_transform(list_filter(range(1, n + 1), lambda i: NOT list_contains(away, i - 1)), lambda i: ws[i]) END, ' ') AS collapsed
            FROM d LEFT JOIN lost ON d.doc_id = lost.doc_id)
        SELECT d.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(best[1] AS BIGINT) AS start, CAST(best[2] AS BIGINT) AS length,
            CAST(best[3] AS BIGINT) AS period, CAST(1000 * best[2] // best[3] AS BIGINT) AS exponent_milli,
            sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
        FROM d LEFT JOIN agg ON d.doc_id = agg.doc_id LEFT JOIN rest ON d.doc_id = rest.doc_id""",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
