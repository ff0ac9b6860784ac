import datetime as dt
import gzip
import math
import random
import struct
import zlib

import pytest
from brute import awkward, docs, quoted
from pyspark.sql import functions as F

from creditlake.llm.mixing import Mix, cells_of, rake, sampled_documents, topic_of, with_copies
from creditlake.llm.quotes import link_quotes
from creditlake.llm.sitetree import Limits, extract_main_text, main_text, style_tree
import __spark_entry__ as entry
from creditlake.llm import toxicity
from creditlake.llm.toxicity import Settings, fit, held_out, remove_toxic, toxicity_scores, with_score
from creditlake.llm.urls import intervals, temporal_list_join
from creditlake.llm.warc import archive_round_trip, read_warc, write_pages

MESSAGES = "conv_id bigint, turn int, role string, text string, depth string, body string"


def messages(spark, rows):
    return spark.createDataFrame([(*r, "d", "b") for r in rows], MESSAGES)


def test_threads_from_quotes(spark):
    first, second = "Shall we ship on Monday?\nI think so.", "Only when the tests\npass."
    rows = [
        (1, 0, "user", first),
        (1, 1, "assistant", f"{quoted('shall WE  ship on monday?', 1)}\nYes."),
        (1, 2, "user", second),
        (1, 3, "assistant", f"{quoted(first, 2)}\n{quoted(second, 1)}\nThey do.\n\n> unknown words\n"),
        (1, 4, "user", f"> > {first.splitlines()[1]}\n\nAgreed."),
        (1, 5, "user", quoted("They do.", 1)),
        (2, 0, "user", None), (2, 1, "user", ""), (2, 2, "user", "> Yes."), (None, 0, "user", "> Yes."), (3, None, "user", "x"),
        (4, 0, "user", "same"), (4, 0, "user", "same"), (4, 1, "user", "> same"),
    ]
    found = {(r["conv_id"], r["turn"]): r for r in link_quotes(messages(spark, rows)).collect()}
    links = {k: (r["parent_turn"], r["root_turn"], r["depth"], r["n_quotes"], r["n_linked"]) for k, r in found.items()}
    assert links[1, 0] == (None, 0, 0, 0, 0)
    assert links[1, 1] == (0, 0, 1, 1, 1)
    assert links[1, 3] == (2, 2, 1, 3, 2)
    assert links[1, 4] == (0, 0, 1, 1, 1)
    assert links[1, 5] == (3, 2, 2, 1, 1)
    assert links[2, 2] == (None, 2, 0, 1, 0) and links[None, 0][2] == 0 and links[3, None][:2] == (None, None)
    assert links[4, 1] == (0, 0, 1, 1, 1)
    assert found[1, 3]["body"] == "They do." and found[1, 5]["body"] == "" and found[1, 1]["body"] == "Yes."
    assert link_quotes(messages(spark, rows)).count() == len(rows)
    assert link_quotes(messages(spark, [])).count() == 0


def test_deep_threads_take_few_steps(spark):
    rows = [(1, 0, "u", "m0")] + [(1, i, "u", f"> m{i - 1}\nm{i}") for i in range(1, 70)]
    found = {r["turn"]: (r["root_turn"], r["depth"]) for r in link_quotes(messages(spark, rows)).collect()}
    assert found == {i: (0, i) for i in range(70)}


def test_mixture_reaches_the_marginals(spark):
    rng = random.Random(4)
    rows = []
    for i in range(3000):
        lang, source = rng.choice(["en"] * 6 + ["fr", None]), rng.choice(["a"] * 5 + ["b"])
        rows.append((i, " ".join(["word"] * rng.randrange(1, 40)) + rng.choice(["", " | ", " %%%"]), lang, source))
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    fitted = rake(cells_of(table), Mix(keep=1.0)).withColumn("w", F.col("rate") * F.col("tokens"))
    for margin in ("source", "lang", "topic"):
        sums = {r[0]: (r[1], r[2]) for r in fitted.groupBy(margin).agg(F.sum("w"), F.sum("tokens")).collect()}
        wanted = {k: t**0.5 for k, (_, t) in sums.items()}
        for k, (w, _) in sums.items():
            assert w / sum(x for x, _ in sums.values()) == pytest.approx(wanted[k] / sum(wanted.values()), rel=1e-3)
    given = {"lang": spark.createDataFrame([("en", 1.0), ("fr", 1.0), ("xx", 5.0)], "lang string, share double")}
    drawn, rate, copies = with_copies(table, Mix(keep=0.6), given)
    sums = {r["lang"]: r["t"] for r in drawn.groupBy("lang").agg(F.sum(F.col(copies) * F.regexp_count("text", F.lit(r"\S+"))).alias("t")).collect()}
    total = table.agg(F.sum(F.regexp_count("text", F.lit(r"\S+")))).first()[0]
    assert not sums[None] and sums["en"] == pytest.approx(total * 0.3, rel=0.1) and sums["fr"] == pytest.approx(total * 0.3, rel=0.1)


def test_mixture_of_awkward_rows(spark):
    rows = docs(spark, [*awkward(), (6, awkward()[5][1])])
    drawn, rate, copies = with_copies(rows)
    assert drawn.columns == [*rows.columns, "_rate", "copies"] and drawn.count() == 11
    assert drawn.filter("text IS NULL AND _rate IS NULL").count() == 0
    assert sampled_documents(docs(spark, [])).count() == 0
    assert rows.select(topic_of(F.lit("Licensed by | x"))).first()[0] == "legal"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id bigint, url string, html string, text string, paths string")


def test_warc_round_trip(spark, tmp_path):
    big = "<p>" + "x" * 200 + "</p>"
    rows = [(3, "http://a/1", big), (1, None, big), (2, "http://a/2", "small"), (4, "http://a/3", "small"), (5, "u", None), (6, "u", ""), (7, "u\r\nv", big), (1, "again", big), (None, "n", big), (8, "é", "é" * 60)]
    import hashlib

    found = sorted(map(str, ((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in archive_round_trip(pages(spark, rows), str(tmp_path / "w")).collect())))
    expected = []
    for page, _, html in rows:
        raw = (html or "").encode()
        again = html == big and page != 1
        expected.append((page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", 1 if again else None))
    assert found == sorted(map(str, expected))
    archives = list((tmp_path / "w").glob("*.warc.gz"))
    assert sum(gzip.decompress(a.read_bytes()).count(b"WARC/1.1\r\n") for a in archives) == len(rows)
    # Predicates are pushed to the reader; files that no manifest names do not count.
    (tmp_path / "w" / "part-lost.warc.gz").write_bytes(b"rubbish")
    revisits = read_warc(spark, str(tmp_path / "w")).filter("record_type = 'revisit' AND target_uri LIKE 'http://a/%'")
    assert [r["refers_to"] for r in revisits.collect()] == ["<urn:page:1>"]
    assert read_warc(spark, str(tmp_path / "w"), payload="false").filter("payload IS NOT NULL").count() == 0
    write_pages(pages(spark, []), str(tmp_path / "none"))
    assert read_warc(spark, str(tmp_path / "none")).count() == 0


def test_foreign_archives_and_skipped_payloads(spark, tmp_path):
    from creditlake.llm.warc import member, member_size, records

    def record(kind, uri, body):
        return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {uri}\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"

    parts = [record("warcinfo", "i", b"software: x"), record("resource", "http://a/", b"WARC/1.0\r\n\r\nin the body"), record("resource", "http://b/", b"y" * 50000)]
    (tmp_path / "plain.warc").write_bytes(b"".join(parts))
    (tmp_path / "gz.warc.gz").write_bytes(b"".join(gzip.compress(p) for p in parts))
    (tmp_path / "own.warc.gz").write_bytes(b"".join(member(p, 6) for p in parts))
    rows = read_warc(spark, str(tmp_path)).collect()
    assert sorted((r["record_type"], r["payload_bytes"]) for r in rows) == sorted([("warcinfo", 11), ("resource", 23), ("resource", 50000)] * 3)
    # With the length of the member known, an unwanted payload may even be damaged.
    own = member(parts[2], 6)
    spoilt = own[:400] + bytes(20) + own[420:] if len(own) > 420 else own[:-20] + bytes(20)
    assert member_size(spoilt) == len(spoilt) == struct.unpack_from("<I", own, 16)[0]
    (tmp_path / "bad.gz").write_bytes(spoilt + member(parts[1], 6))
    wanted = list(records(str(tmp_path / "bad.gz"), lambda head: head["warc-target-uri"] == "http://a/"))
    assert [body for _, body in wanted] == [b"WARC/1.0\r\n\r\nin the body"]


def test_urls_against_intervals(spark):
    day = dt.date(2024, 1, 1)
    at = lambda n: day + dt.timedelta(days=n)
    changes = [
        ("l", "bad.com", "add", at(10)), ("l", "bad.com", "add", at(12)), ("l", "bad.com", "remove", at(20)), ("l", "BAD.com", "add", at(400)),
        ("l", "x.org", "add", at(5)), ("l", "x.org", "remove", at(5)), ("l", "never.org", "remove", at(1)), ("p", "ok.net/a/b", "add", at(0)),
        ("m", "www.bad.com", "add", at(15)), (None, "q", "add", at(1)), ("l", None, "add", at(1)), ("l", "z", "other", at(1)), ("l", "z", "add", None),
    ]
    listed = spark.createDataFrame(changes, "list string, target string, action string, at date")
    spans = sorted((r["target"], (r["valid_from"] - day).days, r["valid_to"].year) for r in intervals(listed).collect())
    assert spans == [("bad.com", 10, 2024), ("bad.com", 400, 9999), ("ok.net/a/b", 0, 9999), ("www.bad.com", 15, 9999)]
    asked = [
        ("http://www.bad.com/x", at(9), None), ("http://www.bad.com/x", at(10), "bad.com"), ("https://u:p@WWW.bad.com:80/x", at(16), "www.bad.com"),
        ("http://bad.com", at(19), "bad.com"), ("http://bad.com", at(20), None), ("http://bad.com/", at(500), "bad.com"), ("http://notbad.com/", at(15), None),
        ("http://ok.net/a/b/c?x", at(3), "ok.net/a/b"), ("http://ok.net/a/bc", at(3), None), ("mailto:a", at(3), None), (None, at(3), None), ("http://bad.com", None, None),
        ("http://bad.com", at(19), "bad.com"),
    ]
    rows = [(i, u, d, "mine") for i, (u, d, _) in enumerate(asked)]
    captures = spark.createDataFrame(rows, "id int, url string, fetch_time date, entry_target string")
    found = temporal_list_join(captures, listed)
    assert found.columns[:4] == captures.columns and "_entry_target" in found.columns
    assert {r["id"]: r["_entry_target"] for r in found.collect()} == {i: t for i, (_, _, t) in enumerate(asked)}
    assert found.count() == len(asked)
    assert temporal_list_join(captures, listed.limit(0)).filter("blocked").count() == 0
    assert temporal_list_join(captures.limit(0), listed).count() == 0


ARTICLE = "<nav><a href=x>Menu</a></nav><div class='ad'>Buy</div><article><h1>T &amp; {0}</h1><p>One\n two<br>three<p><b>Four<div class=comments><p>No</div></article><footer>c</footer>"


def test_main_text_of_broken_pages():
    assert main_text(ARTICLE.format(1), frozenset()) == "T & 1\n\nOne two three\n\nFour"
    assert main_text("", frozenset()) == "" and main_text("plain &lt;b&gt; text", frozenset()) == "plain <b> text"
    assert main_text("<p>a<script>x<p></script>b<style>y", frozenset()) == "ab"
    assert main_text("<ul><li>x<li>y</ul><form>z</form><table><tr><td>1<td>2</table>", frozenset()) == "x\n\ny\n\n1\n\n2"
    assert main_text("<div>" * 5000 + "deep" + "</div>" * 10, frozenset()) == "deep"
    assert main_text("<main>in</main><p>out</p>", frozenset()) == "in"
    assert main_text("<title>t</title><p title='a>b'>x</p><!-- <p>c -->", frozenset()) == "x"


def test_site_style_trees_remove_templates(spark):
    page = "<html><body><div class=top><p>Welcome to our shop</p></div><div class=body><h2>Story {0}</h2><p>Words {0} of {1}</p></div></body></html>"
    rows = [(i, "http://shop.com/" + str(i), page.format(i, i * 7)) for i in range(12)]
    rows += [(100, "http://other.com/", page.format(1, 2)), (101, None, page.format(3, 4)), (102, "http://shop.com/z", None), (103, "http://shop.com/y", "")]
    rows += [(200 + i, "http://news.com/x", ARTICLE.format(1)) for i in range(8)]
    found = {r["page_id"]: (r["text"], r["n_chars"]) for r in extract_main_text(pages(spark, rows)).collect()}
    assert found[5][0] == "Story 5\n\nWords 5 of 35" and found[5][1] == len(found[5][0])
    assert found[100][0].startswith("Welcome") and found[101][0].startswith("Welcome")
    assert found[102] == ("", 0) and found[103] == ("", 0)
    assert found[203][0].startswith("T & 1")  # copies of an article are no template
    tree = {r["path"]: r for r in style_tree(pages(spark, rows), Limits()).filter("host = 'shop.com'").collect()}
    assert tree["/html/body/div.top"]["importance"] < 0.1 and tree["/html/body/div.body"]["content"] > 0.9
    assert extract_main_text(pages(spark, [])).count() == 0


def toxic_corpus(n):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        text = rng.choices(words, k=rng.randrange(20, 80))
        bad = i % 8 == 0
        if bad:
            for _ in range(4):
                text[rng.randrange(len(text))] = rng.choice(["vile", "rotten", f"scummy{rng.choice('abcdefghij')}"])
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = toxic_corpus(900)
    table = docs(spark, [*rows, *[(None, "vile"), (5000, None), (5001, ""), (5002, "vile rotten scummyzz vile")]])
    known = spark.createDataFrame([*labels, (None, 0, 1), (1, 1, None)], "doc_id bigint, quality int, toxic int")
    found = {r["doc_id"]: r for r in toxicity_scores(table, known).collect()}
    truth = {i: bad for i, _, bad in labels}
    wrong = [i for i, bad in truth.items() if found[i]["held_out"] and found[i]["predicted"] != bad]
    assert sum(r["held_out"] for r in found.values()) > 250 and len(wrong) <= 2
    assert found[5002]["predicted"] == 1 and found[5000]["predicted"] == found[5001]["predicted"] == 0
    assert all(0 <= r["score"] <= 1 for r in found.values()) and not found[None]["held_out"]
    kept = remove_toxic(table, fit(table, known))
    assert kept.columns == table.columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in found.items() if not r["predicted"]}


def test_toxicity_ignores_held_out_labels_and_missing_classes(spark):
    rows, labels = toxic_corpus(400)
    table = docs(spark, rows)
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    flipped = known.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert fit(table, known) == fit(table, flipped)
    model = fit(table, known.filter("toxic = 0"), Settings())
    assert model.rest is None and 0 < model.score(0.0, 0) < 0.1
    assert toxicity_scores(docs(spark, []), known).count() == 0


def plain_evidence(rows, labels, texts, prior):
    """Evidence of ``texts`` by the definition of the class-conditional models, and the words of the training rows."""
    truth = {i: bad for i, _, bad in labels if zlib.crc32(str(i).encode()) % 3 != 1}
    train = [(fold, set(text.split()), truth[i]) for (i, text), fold in rows if i in truth]
    words = {w for _, found, _ in train for w in found}

    def cell(w, without=None):
        k = [sum(w in found and bad == c and fold != without for fold, found, bad in train) for c in (1, 0)]
        return tuple(n if n <= 4 else math.floor(4 + 2 * math.log2(n / 4)) for n in k)

    sizes = [[sum(len(found) for fold, found, bad in train if fold == f and bad == c) for c in (1, 0)] for f in range(toxicity.FOLDS)]
    mean = [sum(s[j] for s in sizes) / toxicity.FOLDS for j in (0, 1)]
    cells = {}
    for w in words:
        for f in range(toxicity.FOLDS):
            sums = cells.setdefault(cell(w, f), [0, 0])
            for fold, found, bad in train:
                if fold == f and w in found:
                    sums[1 - bad] += mean[1 - bad] / sizes[f][1 - bad]
    share = [sum(c[j] for c in cells.values()) for j in (0, 1)]
    share = [n / sum(share) for n in share]

    def evidence(w):
        held = cells.get(cell(w), [0, 0])
        k = [n if n <= 4 else 4 * 2 ** ((n - 3.5) / 2) for n in cell(w)]
        off = [min(n, 0.75) for n in k]
        p = [(n - d + sum(off) * s) / sum(k) if sum(k) else s for n, d, s in zip(k, off, share, strict=True)]
        p = [math.log((n + prior * q) / (sum(held) + prior) / s) for n, q, s in zip(held, p, share, strict=True)]
        return p[0] - p[1]

    return [sum(evidence(w) for w in set(t.split())) for t in texts], words


@pytest.mark.parametrize("common", [1 << 20, 40, 0])
def test_toxicity_equals_plain_models(spark, monkeypatch, common):
    monkeypatch.setattr(toxicity, "COMMON", common)
    monkeypatch.setattr(toxicity, "BITS", 1 << 10)
    rows, labels = toxic_corpus(240)
    rows = [(i, f"{text} rare{i}") for i, text in rows]
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    table = docs(spark, rows)
    folds = [r["fold"] for r in table.orderBy("doc_id").select(F.pmod(F.xxhash64("text"), F.lit(toxicity.FOLDS)).alias("fold")).collect()]
    asked = [t for _, t in rows[:40]] + ["vile", "unknown words", "vile rotten unknown w1", "w1 " * 30_000 + "rotten"]
    expected, words = plain_evidence(list(zip(rows, folds, strict=True)), labels, asked, Settings().prior)
    model = fit(table, known)
    assert model.words == len(words) and (common > len(words)) == (model.rest.count() == 0)
    scored, name = with_score(docs(spark, [*enumerate(asked), (98, None), (99, " . ")]), model)
    found = {r["doc_id"]: r[name] for r in scored.collect()}
    for i, (text, evidence) in enumerate(zip(asked, expected, strict=True)):
        assert found[i] == pytest.approx(model.score(evidence, len(set(text.split()))), rel=1e-5)
    assert found[98] == found[99] == model.share


def test_toxicity_counts_copies_once_and_keeps_clashing_columns(spark):
    rows, labels = toxic_corpus(300)
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    once = fit(docs(spark, rows), known)
    copied = [(1000 + 2 * i + j, rows[j][1]) for i in range(60) for j in (0, 1)]
    more = spark.createDataFrame([*labels, *[(i, 1, int(t == rows[0][1])) for i, t in copied]], "doc_id bigint, quality int, toxic int")
    learned = {i for i, _ in rows[:2] if zlib.crc32(str(i).encode()) % 3 != 1}
    if len(learned) == 2:
        assert fit(docs(spark, [*rows, *copied]), more) == once
    clash = docs(spark, [*rows, rows[0], rows[1], (None, None)]).selectExpr("doc_id", "text", "1 AS Score", "2 AS _words", "3 AS _row", "4 AS key")
    kept = remove_toxic(clash, once)
    assert kept.columns == clash.columns
    plain = remove_toxic(docs(spark, [*rows, rows[0], rows[1], (None, None)]), once)
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == sorted(r["doc_id"] or -1 for r in plain.collect())


def test_words_of_a_layout_or_a_subject_drop_no_article():
    text = "The text of the article goes on for a while."
    for page in (
        f'<div class="layout has-sidebar"><article>{text}</article><div class="sidebar">More</div></div>',
        f'<article class="post legal">{text}</article>',
        f'<div id="page-with-header"><div class="header">Top</div><main>{text}</main></div>',
        f'<article><div class="social-science">{text}</div><div class="share">Pass it on</div></article>',
        f'<svg/><article>{text}<math /></article>',
        f'<article>{text}</article><div class="comments"><article class="comment">First!</article></div><!-- open',
        f'<article>{text}</article><!-- open <b>',
    ):
        assert main_text(page, frozenset()) == text
    assert main_text(f'<div>{text}</div><div class="comments"><article class="comment">First!</article></div>', frozenset()) == text


def test_tags_that_never_end_take_linear_time():
    assert main_text("<p>x</p>" + "<a " * 400_000, frozenset()).startswith("x")


def test_style_trees_reach_into_articles(spark):
    """A block that a host repeats in its articles goes; copies and near copies of an article stay whole."""
    page = '<body><article><h1>Story {0}</h1><div class="prompt"><b>Liked this?</b> Tell your friends.</div><p>Words {0} of {1}, and more of them.</p></article></body>'
    rows = [(i, f"http://mag.com/{i}", page.format(i, i * 7)) for i in range(12)]
    copy = "<body><main><h1>One</h1><p class=first>First text of it.</p><p class=last>The last text.</p>{0}</main></body>"
    rows += [(100 + i, "http://copy.com/x", copy.format("")) for i in range(9)]
    rows += [(200 + i, f"http://near.com/{i}", copy.format(f"<i>{i}</i>")) for i in range(9)]
    found = {r["page_id"]: r["text"] for r in extract_main_text(pages(spark, rows)).collect()}
    assert all(found[i] == f"Story {i}\n\nWords {i} of {i * 7}, and more of them." for i in range(12))
    assert found[103] == "One\n\nFirst text of it.\n\nThe last text."
    assert found[205] == "One\n\nFirst text of it.\n\nThe last text.\n\n5"
    tree = {(r["host"], r["path"]): r for r in style_tree(pages(spark, [*rows, rows[0]]), Limits()).collect()}
    prompt = tree["mag.com", "/body/article/div.prompt"]
    assert (prompt["pages"], prompt["host_pages"]) == (12, 13) and prompt["importance"] < 0.1
    assert tree["mag.com", "/body/article/p"]["importance"] > 0.89
    assert tree["copy.com", "/body/main/p.first"]["pages"] == 1 and tree["near.com", "/body/main/p.first"]["pages"] == 9


def expression_corpus(n):
    """Toxic texts hold an expression of two words; the others hold both words, apart or turned round."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(n):
        text = rng.choices(words, k=rng.randrange(20, 40))
        at = rng.randrange(2, len(text) - 2)
        bad = i % 4 == 0
        text[at:at] = ["dark", "horse"] if bad else rng.choice([["horse", "dark"], ["horse", rng.choice(words), "dark"], ["dark", rng.choice(words), "horse"]])
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_toxic_expressions_are_known_by_their_pairs(spark, tmp_path):
    rows, labels = expression_corpus(600)
    docs(spark, [*rows, (9000, "dark"), (9001, ""), (9002, None)]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = {r["doc_id"]: r for r in entry.queries()["op10_kneser_ney_toxicity"](spark, str(tmp_path)).collect()}
    assert len(found) == 603 and found[9001]["score"] == found[9002]["score"]
    wrong = [i for i, _, bad in labels if found[i]["held_out"] and found[i]["predicted"] != bad]
    assert sum(r["held_out"] for r in found.values()) > 150 and len(wrong) <= 2


def test_pairs_add_what_their_cells_have_beyond_words(spark, monkeypatch):
    assert [len(k) for k in toxicity.pairs_of(b"A b a  b c")] == [3, 3] and [len(k) for k in toxicity.pairs_of(b"a")] == [0, 0]
    assert toxicity.pairs_of(b"a b")[0] != toxicity.pairs_of(b"b a")[0] and toxicity.pairs_of(b"x, b")[1] == toxicity.keys_of(b"b")
    rows, labels = expression_corpus(240)
    table, known = docs(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    settings = Settings(pairs=True, pair_shares=(1.0,))
    truth = {i: bad for i, _, bad in labels if zlib.crc32(str(i).encode()) % 3 != 1}
    folds = {r["doc_id"]: r["fold"] for r in table.select("doc_id", F.pmod(F.xxhash64("text"), F.lit(toxicity.FOLDS)).alias("fold")).collect()}
    train = [(folds[i], text.split(), truth[i]) for i, text in rows if i in truth]
    single, _ = plain_evidence([((i, t), folds[i]) for i, t in rows], labels, [w for w in {w for _, t, _ in train for w in t}], settings.prior)
    step = dict(zip({w for _, t, _ in train for w in t}, (max(-toxicity.STEPS, min(toxicity.STEPS, round(e / toxicity.STEP))) for e in single), strict=True))
    held = [(fold, set(zip(t, t[1:])), bad) for fold, t, bad in train]

    def cell(pair, without=None):
        k = [sum(pair in found and bad == c and fold != without for fold, found, bad in held) for c in (1, 0)]
        return (step[pair[1]], *[n if n <= 4 else math.floor(4 + 2 * math.log2(n / 4)) for n in k])

    sizes = [[sum(len(found) for fold, found, bad in held if fold == f and bad == c) for c in (1, 0)] for f in range(toxicity.FOLDS)]
    sums = {}
    for fold, found, bad in held:
        for pair in found:
            sums.setdefault(cell(pair, fold), [0, 0])[1 - bad] += sum(s[1 - bad] for s in sizes) / toxicity.FOLDS / sizes[fold][1 - bad]
    share = [sum(s[j] for s in sums.values()) for j in (0, 1)]
    share = [n / sum(share) for n in share]

    def beyond(pair):
        at, *k = cell(pair) if pair[1] in step else (0, 0, 0)
        if not any(k):
            return 0.0
        below = [share[0] * math.exp(at * toxicity.STEP), share[1]]
        k = [n if n <= 4 else 4 * 2 ** ((n - 3.5) / 2) for n in k]
        off = [min(n, toxicity.DISCOUNT) for n in k]
        r = sums.get(cell(pair), [0, 0])
        p = [(n - d + sum(off) * b / sum(below)) / sum(k) for n, d, b in zip(k, off, below, strict=True)]
        p = [math.log((n + settings.prior * q) / (sum(r) + settings.prior) / s) for n, q, s in zip(r, p, share, strict=True)]
        return p[0] - p[1] - at * toxicity.STEP

    asked = [t for _, t in rows[:12]] + ["dark horse", "horse dark", "dark unknown horse", "w1 w2 w1 w2"]
    words, _ = plain_evidence([((i, t), folds[i]) for i, t in rows], labels, asked, settings.prior)
    for common in (1 << 20, 30):
        monkeypatch.setattr(toxicity, "COMMON", common)
        model = fit(table, known, settings)
        scored, name = with_score(docs(spark, [*enumerate(asked)]), model)
        got = {r["doc_id"]: r[name] for r in scored.collect()}
        for i, (text, evidence) in enumerate(zip(asked, words, strict=True)):
            t = text.split()
            evidence += sum(beyond(pair) for pair in set(zip(t, t[1:])))
            assert got[i] == pytest.approx(model.score(evidence, len(set(t))), rel=1e-4)
