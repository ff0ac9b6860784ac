"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, table
from .mixing import MARGINS, PROSE, TOPICS, Mix, with_copies
from .cells import near_copies
from .compression import compression_bands
from .decontamination import decontamination_report
from .jaccard import jaccard_components
from .lexical import search
from .pii import personal_data
from .quotes import link_quotes
from .runs import run_report
from .sitetree import extract_main_text, host_of
from .toxicity import Settings, toxicity_scores
from .urls import temporal_list_join
from .warc import archive_round_trip

Query = Callable[[SparkSession, str], DataFrame]


def quoting_messages(conversations: DataFrame) -> DataFrame:
    """The conversations as mail: odd turns quote the whole turn before, even ones the first lines of two turns."""
    first = conversations.groupBy("conv_id", "turn").agg(F.min("text").alias("text"))

    def earlier(by: int, name: str) -> DataFrame:
        return first.select("conv_id", (F.col("turn") + by).alias("turn"), F.col("text").alias(name))

    def quoted(text: Column, mark: str) -> Column:
        return F.concat(F.lit(mark), F.replace(text, F.lit("\n"), F.lit(f"\n{mark}")), F.lit("\n"))

    joined = conversations.join(earlier(1, "one"), ["conv_id", "turn"], "left").join(
        earlier(2, "two"), ["conv_id", "turn"], "left"
    )
    line = lambda c: F.substring_index(c, "\n", 1)
    deep = F.concat(F.coalesce(quoted(line(F.col("two")), ">> "), F.lit("")), F.coalesce(quoted(line(F.col("one")), "> "), F.lit("")))
    quote = F.when(F.col("turn") % 2 == 1, F.coalesce(quoted(F.col("one"), "> "), F.lit(""))).otherwise(deep)
    return joined.select("conv_id", "turn", "role", F.concat(quote, F.coalesce("text", F.lit(""))).alias("text"))


def op1_quotation_linking(spark: SparkSession, folder: str) -> DataFrame:
    threads = link_quotes(quoting_messages(table(spark, folder, "conversations")))
    return threads.withColumn("body_md5", F.md5("body")).drop("body")


def op2_compression_bands(spark: SparkSession, folder: str) -> DataFrame:
    return compression_bands(table(spark, folder, "documents"))


def op3_suffix_array_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    report = decontamination_report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    longest = F.coalesce(F.array_max(F.col("matches.length")), F.lit(0)).cast("long")
    return report.withColumn("longest_match", longest).drop("matches")


def op4_raked_mixture(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "lang", "text")
    drawn, rate, copies = with_copies(docs)
    return drawn.select("doc_id", "source", "lang", F.col(rate).alias("rate"), F.col(copies).alias("copies"))


def op5_partenum_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(table(spark, folder, "documents"))


def op6_warc_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return archive_round_trip(table(spark, folder, "pages"))


def op7_bootstrapped_pii(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data(table(spark, folder, "documents"))


def host_list_changes(pages: DataFrame) -> DataFrame:
    """A dated history of listed hosts and paths, from the hosts that occur in ``pages``."""
    hosts = pages.select(host_of(F.col("url")).alias("host")).filter("host IS NOT NULL").distinct()
    n = F.conv(F.substring(F.md5("host"), 1, 6), 16, 10).cast("int")
    start = F.lit("2024-01-01").cast("date")
    spam = F.col("host").contains("pills") | F.col("host").contains("casino")

    def change(name: str, target: Column, action: str, days: Column, when: Column) -> Column:
        value = F.struct(F.lit(name).alias("list"), target.alias("target"), F.lit(action).alias("action"), F.date_add(start, days).alias("at"))
        return F.when(when, value)

    listed, by_path = spam | (n % 3 == 0), n % 5 == 0
    host = F.col("host")
    made = F.array(
        change("hosts", host, "add", n % 500, listed),
        change("hosts", host, "add", n % 500 + 10, listed),
        change("hosts", host, "remove", n % 500 + 30 + n % 97, listed),
        change("hosts", host, "add", n % 500 + 200, listed),
        change("paths", F.concat(host, F.lit("/en")), "add", n % 300, by_path),
    )
    return hosts.select(F.explode(F.filter(made, lambda c: c.isNotNull())).alias("c")).select("c.*")


def op8_temporal_list_join(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    days = (F.col("page_id") * 37 % 730).cast("int")
    captures = pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), days).alias("fetch_date"))
    return temporal_list_join(captures, host_list_changes(pages), fetched="fetch_date")


def op9_site_style_tree(spark: SparkSession, folder: str) -> DataFrame:
    return extract_main_text(table(spark, folder, "pages"))


def op10_kneser_ney_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity_scores(table(spark, folder, "documents"), table(spark, folder, "labels"), Settings(pairs=True))


def op11_pipelined_search(spark: SparkSession, folder: str) -> DataFrame:
    return search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_spherical_cells(spark: SparkSession, folder: str) -> DataFrame:
    return near_copies(table(spark, folder, "embeddings"))


def repeated_tails(docs: DataFrame) -> DataFrame:
    """``docs`` (``doc_id``, ``text``), every tenth with its words from some place on repeated with some period.

    With h the CRC-32 of the id and g = h div 10, a text with h mod 10 = 0 goes on
    from word a = g mod n with period 1 + (n - a) div (3 + g mod 8).
    """
    rows = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("hash"))
    made = rows.select("doc_id", "text")

    def tail(text: str | None, mark: int | None) -> str | None:
        if text is None or mark is None or mark % 10:
            return text
        words, g = text.encode().split(), mark // 10
        if not words:
            return text
        a = g % len(words)
        period = 1 + (len(words) - a) // (3 + g % 8)
        part = words[a : a + period]
        times = (len(words) - a) // period + 1
        return b" ".join(words[:a] + (part * times)[: len(words) - a]).decode()

    def work(batches):
        for batch in batches:
            texts = [tail(t, h) for t, h in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return arrow_map(rows, work, made.schema)


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return run_report(repeated_tails(table(spark, folder, "documents")))


QUERIES: dict[str, Query] = {
    "op1_quotation_linking": op1_quotation_linking,
    "op2_compression_bands": op2_compression_bands,
    "op3_suffix_array_decontamination": op3_suffix_array_decontamination,
    "op4_raked_mixture": op4_raked_mixture,
    "op5_partenum_jaccard": op5_partenum_jaccard,
    "op6_warc_round_trip": op6_warc_round_trip,
    "op7_bootstrapped_pii": op7_bootstrapped_pii,
    "op8_temporal_list_join": op8_temporal_list_join,
    "op9_site_style_tree": op9_site_style_tree,
    "op10_kneser_ney_toxicity": op10_kneser_ney_toxicity,
    "op11_pipelined_search": op11_pipelined_search,
    "op12_spherical_cells": op12_spherical_cells,
    "op13_periodic_runs": op13_periodic_runs,
}



def raking_sql(rounds: int = 40) -> str:
    """Iterative proportional fitting, written out round by round."""
    mix = Mix()
    cases = " ".join(f"WHEN {' OR '.join(f'contains(text, {mark!r})' for mark in marks)} THEN '={name}'" for name, marks in TOPICS)
    steps = [
        f"""d AS (
            SELECT doc_id, source, lang, coalesce('=' || source, '-') AS k_source, coalesce('=' || lang, '-') AS k_lang,
                   CASE {cases} ELSE '={PROSE}' END AS k_topic,
                   coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS tokens
            FROM documents
        )""",
        "c AS (SELECT k_source, k_lang, k_topic, sum(tokens)::DOUBLE AS tokens FROM d GROUP BY ALL HAVING sum(tokens) > 0)",
    ]
    for m in MARGINS:
        steps.append(
            f"t_{m} AS MATERIALIZED (SELECT k_{m}, pow(sum(tokens), {mix.temper}) / sum(pow(sum(tokens), {mix.temper})) OVER () AS share FROM c GROUP BY k_{m})"
        )
    steps.append("w_0 AS MATERIALIZED (SELECT *, tokens AS w, sum(tokens) OVER () AS total FROM c)")
    last = 0
    for _ in range(rounds):
        for m in MARGINS:
            steps.append(
                f"w_{last + 1} AS MATERIALIZED (SELECT x.* EXCLUDE (w), w * share * total / sum(w) OVER (PARTITION BY x.k_{m}) AS w"
                f" FROM w_{last} x JOIN t_{m} USING (k_{m}))"
            )
            last += 1
    return f"""
        WITH {", ".join(steps)},
        r AS (
            SELECT d.*, coalesce(round(w * {mix.keep} / w_{last}.tokens, 6), 0.0) AS rate,
                   ('0x' || substr(md5('{mix.seed}:' || doc_id), 1, 8))::BIGINT / 4294967296.0 AS u
            FROM d LEFT JOIN w_{last} USING (k_source, k_lang, k_topic)
        )
        SELECT doc_id, source, lang, rate, (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies
        FROM r
    """


ORACLE: dict[str, str] = {
    "op1_quotation_linking": r"""
        WITH RECURSIVE f AS (
            SELECT conv_id, turn, min(text) AS text FROM conversations GROUP BY ALL
        ), m AS (
            SELECT c.conv_id, c.turn, c.role, regexp_replace(coalesce(c.text, ''), '^\s+|\s+$', '', 'g') AS body,
                   a.text AS one, b.text AS two
            FROM conversations c
            LEFT JOIN f a ON a.conv_id = c.conv_id AND a.turn = c.turn - 1
            LEFT JOIN f b ON b.conv_id = c.conv_id AND b.turn = c.turn - 2
        ), q AS (
            SELECT conv_id, turn, 1 AS depth, one AS passage FROM m WHERE turn % 2 = 1 AND one IS NOT NULL
            UNION ALL
            SELECT conv_id, turn, 1, split_part(one, chr(10), 1) FROM m WHERE turn % 2 = 0 AND one IS NOT NULL
            UNION ALL
            SELECT conv_id, turn, 2, split_part(two, chr(10), 1) FROM m WHERE turn % 2 = 0 AND two IS NOT NULL
        ), qn AS (
            SELECT conv_id, turn, depth, trim(regexp_replace(lower(passage), '\s+', ' ', 'g')) AS p FROM q
        ), u AS (
            SELECT DISTINCT conv_id, turn, unnest(list_transform(
                [body] || string_split_regex(body, '\n\s*\n') || string_split(body, chr(10)),
                lambda x: trim(regexp_replace(lower(x), '\s+', ' ', 'g')))) AS p
            FROM m WHERE body <> ''
        ), s AS (
            SELECT conv_id, p, min(turn) AS source FROM u WHERE p <> '' GROUP BY ALL
        ), l AS (
            SELECT qn.conv_id, qn.turn, depth, qn.p, source FROM qn JOIN s USING (conv_id, p) WHERE qn.p <> '' AND source < qn.turn
        ), parent AS (
            SELECT conv_id, turn, arg_max(source, -depth * 1000000 + source) AS parent_turn FROM l GROUP BY ALL
        ), tree AS (
            SELECT conv_id, turn, parent_turn, parent_turn AS root_turn, 1 AS depth FROM parent
            UNION ALL
            SELECT t.conv_id, t.turn, t.parent_turn, p.parent_turn, t.depth + 1
            FROM tree t JOIN parent p ON p.conv_id = t.conv_id AND p.turn = t.root_turn
        ), top AS (
            SELECT conv_id, turn, parent_turn, arg_max(root_turn, depth) AS root_turn, max(depth) AS depth FROM tree GROUP BY ALL
        ), n AS (
            SELECT conv_id, turn, count(*) AS n_quotes FROM qn WHERE p <> '' GROUP BY ALL
        ), k AS (
            SELECT qn.conv_id, qn.turn, count(*) AS n_linked
            FROM qn JOIN (SELECT DISTINCT conv_id, turn, p FROM l) USING (conv_id, turn, p) GROUP BY ALL
        )
        SELECT m.conv_id, m.turn, m.role, parent_turn, coalesce(root_turn, m.turn) AS root_turn,
               coalesce(depth, 0) AS depth, coalesce(n_quotes, 0) AS n_quotes, coalesce(n_linked, 0) AS n_linked,
               md5(body) AS body_md5
        FROM m LEFT JOIN top USING (conv_id, turn) LEFT JOIN n USING (conv_id, turn) LEFT JOIN k USING (conv_id, turn)
    """,
    "op4_raked_mixture": raking_sql(),
    "op8_temporal_list_join": r"""
        WITH p AS (
            SELECT page_id, url, CAST(DATE '2024-01-01' + CAST(page_id * 37 % 730 AS INTEGER) AS DATE) AS fetch_date,
                   nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') AS host,
                   list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1), '/'), lambda x: x <> '') AS parts
            FROM pages
        ), h AS (
            SELECT DISTINCT host, ('0x' || substr(md5(host), 1, 6))::INTEGER AS n FROM p WHERE host IS NOT NULL
        ), l AS (
            SELECT * FROM h WHERE contains(host, 'pills') OR contains(host, 'casino') OR n % 3 = 0
        ), spans AS (
            SELECT 'hosts' AS list, host AS target, DATE '2024-01-01' + (n % 500) AS valid_from,
                   DATE '2024-01-01' + (n % 500 + 30 + n % 97) AS valid_to FROM l
            UNION ALL SELECT 'hosts', host, DATE '2024-01-01' + (n % 500 + 200), DATE '9999-12-31' FROM l
            UNION ALL SELECT 'paths', host || '/en', DATE '2024-01-01' + (n % 300), DATE '9999-12-31' FROM h WHERE n % 5 = 0
        ), asked AS (
            SELECT DISTINCT url, fetch_date, unnest(
                list_transform(range(1, len(string_split(host, '.')) + 1), lambda i: array_to_string(string_split(host, '.')[i:], '.'))
                || list_transform(range(1, len(parts) + 1), lambda i: host || '/' || lower(array_to_string(parts[1:i], '/')))) AS target
            FROM p WHERE host IS NOT NULL
        ), best AS (
            SELECT url, fetch_date, list, asked.target, valid_from, valid_to FROM asked JOIN spans
            ON asked.target = spans.target AND fetch_date >= valid_from AND fetch_date < valid_to
            QUALIFY row_number() OVER (PARTITION BY url, fetch_date ORDER BY length(asked.target) DESC, list DESC) = 1
        )
        SELECT p.page_id, p.url, p.fetch_date, list AS entry_list, target AS entry_target,
               CAST(valid_from AS DATE) AS entry_from, CAST(valid_to AS DATE) AS entry_to, list IS NOT NULL AS blocked
        FROM p LEFT JOIN best USING (url, fetch_date)
    """,
    "op11_pipelined_search": r"""
        WITH t AS (
            SELECT rowid AS doc, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM (SELECT row_number() OVER () AS rowid, doc_id, text FROM documents)
        ), p AS MATERIALIZED (SELECT doc, doc_id, term, count(*) AS tf FROM t GROUP BY ALL
        ), d AS MATERIALIZED (SELECT doc, sum(tf)::BIGINT AS n FROM p GROUP BY doc
        ), a AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM d
        ), w AS (
            SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, a GROUP BY term, docs
        ), q AS (
            SELECT DISTINCT item, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM (SELECT row_number() OVER () AS item, item_id, text FROM benchmark)
        ), s AS (
            SELECT item, item_id, doc, p.doc_id,
                   sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // words))))::BIGINT AS score
            FROM q JOIN p USING (term) JOIN w USING (term) JOIN d USING (doc), a GROUP BY ALL
        ), r AS (
            SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS FIRST) AS rank, doc_id, score FROM s WHERE score > 0
        )
        SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 10
    """,
    "op6_warc_round_trip": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html,
                   sha256(coalesce(html, '')) AS payload_digest, strlen(coalesce(html, '')) AS payload_bytes
            FROM pages
        ), f AS (
            SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest
        )
        SELECT page_id, payload_bytes, p.payload_digest,
               CASE WHEN first IS NOT NULL AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first IS NOT NULL AND page_id <> first THEN first END AS refers_to
        FROM p LEFT JOIN f USING (payload_digest)
    """,
}
