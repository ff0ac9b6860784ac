import random

import pytest
import zstandard
from brute import awkward, base_figures, by_id, components, contamination, docs, personal, random_corpus, shingles

from creditlake.llm.compression import Bands, compression_bands
from creditlake.llm.decontamination import decontamination_report, remove_contaminated
from creditlake.llm.jaccard import Settings, jaccard_components, one_of_each_group
from creditlake.llm.pii import Bootstrap, personal_data, redact


def test_base_figures_and_bands(spark):
    rng = random.Random(1)
    junk = "".join(chr(rng.randrange(33, 127)) + (" " if rng.random() < 0.2 else "") for _ in range(3000))
    loop = " ".join(f"{a} {b} {c}" for a, b, c in zip("abcdefgh" * 40, "ijklmnop" * 40, "qrstuvwx" * 40))
    spread = " ".join(f"number{i}" for i in range(600))
    rows = [*awkward(), (20, junk), (21, loop), (22, spread), (6, dict(awkward())[6])]
    found = compression_bands(docs(spark, rows)).collect()
    got = by_id(found, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    for doc_id, text in rows:
        assert base_figures(text) in got[doc_id]
    assert sum(map(len, got.values())) == len(rows)
    reasons = {r["doc_id"]: (r["kept"], r["reason"]) for r in found}
    assert reasons[20] == (False, "incompressible") and reasons[21] == (False, "base")
    for r in found:
        text = dict(rows)[r["doc_id"]]
        if text:
            whole = len(zstandard.ZstdCompressor(level=3).compress(text.encode())) / len(text.encode())
            assert r["ratio"] == pytest.approx(whole)
    assert compression_bands(docs(spark, [])).count() == 0


def test_a_repeated_chunk_condemns_a_long_text():
    from creditlake.llm.compression import judge

    rng = random.Random(2)
    fresh = " ".join("".join(rng.choices("etaoinshr", k=5)) for _ in range(900)).encode()
    packer = zstandard.ZstdCompressor(level=3)
    assert judge(fresh, Bands(), packer)[3] is None
    assert judge(fresh + b"again and again " * 700, Bands(), packer)[3] == "repetitive"


ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today"),
    (2, "short item here"), (3, None), (4, ""), (2, "another short item"), (5, "The QUICK, brown fox jumps over the lazy dog near the old barn"),
]


@pytest.mark.parametrize("block_bytes", [1, 1 << 20])
def test_decontamination_matches_brute_force(spark, block_bytes, monkeypatch):
    monkeypatch.setattr("creditlake.llm.decontamination.BLOCK_BYTES", block_bytes)
    monkeypatch.setattr("creditlake.llm.decontamination.with_matches.__defaults__", (10, block_bytes))
    window = "quick brown fox jumps over the lazy dog near the old"
    rows = [
        *awkward(), (30, f"x {window} river y"), (31, "quick brown fox jumps over the lazy dog"), (32, "a Short... ITEM; here b short item here"),
        (33, f"{window} {window}"), (34, "short item"), (35, f"{window.upper()} barn and another short item"), (36, "here short item"), (30, "short item here"),
    ]
    bench = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id bigint, text string, doc_id string")
    found = by_id(decontamination_report(docs(spark, rows), bench).collect(), "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    for doc_id, text in rows:
        assert contamination(text, ITEMS) in found[doc_id]
    kept = remove_contaminated(docs(spark, rows), bench)
    assert kept.columns == docs(spark, rows).columns
    clean = sorted(str(i) for i, t in rows if not contamination(t, ITEMS)[4])
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == clean


def test_longest_matches_have_their_places(spark):
    bench = spark.createDataFrame(ITEMS[:1], "item_id bigint, text string")
    text = f"intro words {ITEMS[0][1]} outro"
    (row,) = decontamination_report(docs(spark, [(1, text)]), bench).collect()
    assert [tuple(m) for m in row["matches"]] == [(2, "1", 0, 15)]
    empty = decontamination_report(docs(spark, [(1, text)]), bench.limit(0)).first()
    assert (empty["n_hit"], empty["contaminated"]) == (0, False)


def test_components_match_all_pairs(spark):
    texts = random_corpus(random.Random(3), 260)
    rows = [*texts, (900, None), (901, ""), (902, "solo"), (903, "SOLO"), (904, texts[0][1])]
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(docs(spark, rows), Settings(common=3)).collect()}
    assert found == components(rows)
    # Repeated rows and a null id: copies are linked, a null id names nothing.
    more = [(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (7, "A b c d e f"), (8, None)]
    got = sorted(map(str, ((r["doc_id"], r["component_id"]) for r in jaccard_components(docs(spark, more)).collect())))
    assert got == sorted(map(str, [(5, 5), (5, 5), (None, 5), (7, 5), (8, 8)]))
    kept = one_of_each_group(docs(spark, rows))
    assert kept.columns == docs(spark, rows).columns
    assert {r["doc_id"] for r in kept.collect()} == {c for _, c in components(rows).values()}
    assert jaccard_components(docs(spark, [])).count() == 0


def test_components_of_a_cluster_around_the_threshold(spark):
    """Copies of one text with up to a third of it changed, in blocks of a few sets; a row without id links two others."""
    rng = random.Random(8)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(70):
        at = rng.randrange(100)
        size = rng.randrange(1, 40)
        rows.append((i, " ".join([*base[:at], *(f"n{i}x{j}" for j in range(size)), *base[at + size :]])))
    middle = [f"m{i}" for i in range(60)]
    bridge = [(100, " ".join([*middle, *(f"p{i}" for i in range(9))])), (None, " ".join(middle)), (101, " ".join([*(f"q{i}" for i in range(9)), *middle]))]
    s = Settings(common=3, block=8, pairs=50)
    found = {r["doc_id"]: r["component_id"] for r in jaccard_components(docs(spark, [*rows, *bridge]), s).collect()}
    expected = {i: c for i, (_, c) in components(rows).items()}
    assert len(set(expected.values())) > 5
    assert found == {**expected, 100: 100, None: 100, 101: 100}


def test_sketch_distances_are_those_of_the_parities():
    import numpy as np

    from creditlake.llm.jaccard import Sketches, parities, parity_distance

    rng = np.random.default_rng(1)
    made = [parities(np.sort(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)), 4096) for n in (3, 120, 129, 150, 1000, 1100, 2048, 2500)]
    pairs = [(0, 1), (1, 2), (2, 3), (4, 5), (5, 4), (6, 7), (7, 7), (2, 1)]
    got = Sketches(made).distances(*np.array(pairs).T)
    assert got.tolist() == [parity_distance(made[a], made[b]) for a, b in pairs]


def test_signatures_meet_for_every_similar_pair():
    """The guarantee itself, without Spark: pairs at the threshold share one of their chosen signatures."""
    import numpy as np

    from creditlake.llm.jaccard import U, chosen_signatures, shingle_sets, WordHashes

    s, rng, hashes = Settings(), np.random.default_rng(5), WordHashes()
    for size in [*range(1, 80), 100, 127, 128, 129, 150, 400, 511, 640, 1500]:
        for _ in range(3):
            whole = rng.integers(0, 1 << 63, size * 2, dtype=np.uint64)
            a = np.sort(whole[:size])
            cut = int(rng.integers(0, size // 5 + 1))
            add = 0
            b = np.sort(np.append(whole[cut:size], whole[size : size + add]))
            while 100 * (size - cut) >= 80 * (size + add + 1) and rng.random() < 0.95:
                add += 1
                b = np.sort(np.append(whole[cut:size], whole[size : size + add]))
            if not len(b) or 100 * (size - cut) < 80 * (size + add):
                continue
            common = np.sort(whole[:0])
            pair = np.concatenate([a, b]), np.array([len(a), len(b)])
            sides = [set(), set()]
            for found, of, _ in chosen_signatures(*pair, s, common):
                for f, o in zip(found.tolist(), of.tolist(), strict=True):
                    sides[o].add(f)
            assert sides[0] & sides[1], (size, cut, add)
    got, sizes = shingle_sets([b"a b c d e f a b c d e f", None, b"x", b""], hashes, 5)
    assert sizes.tolist() == [len(shingles("a b c d e f a b c d e f")), 0, 1, 0] and got.dtype == U


PERSONAL = [
    (40, "mail a.b@c.d and x@y z@w.v@u.t q__@h-h.i.j."), (41, "ip 1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 00255.0.0.1 9.9.9"),
    (42, "card 4111 1111 1111 1111, 4111-1111-1111-1112 5500005555555559 1 2 3"), (43, "call +1 (407) 555-7710 or +12 3 +49.30.123456-78"),
    (44, "é大 4111111111111111 a@b.cc+1 (407) 555-7710"), (45, "9" * 5000 + " 1.1.1.1"), (46, "1 " * 3000), (47, "a" * 20000 + "@b.c"),
]


def test_base_spans_match_plain_patterns(spark):
    rows = [*awkward(), *PERSONAL, PERSONAL[0]]
    found = personal_data(docs(spark, rows)).collect()
    got = by_id(found, "n_email", "n_ip", "n_card", "n_phone", "spans")
    for doc_id, text in rows:
        counts, spans = personal(text)
        assert any(list(g[:4]) == counts and [s for s in g[4].split(",") if not s.startswith("ctx")] == spans.split(",") for g in got[doc_id])
    assert len(found) == len(rows)
    assert personal_data(docs(spark, [])).count() == 0


def test_bootstrap_finds_identifiers_by_their_context(spark):
    cards = ["4111111111111111", "5500005555555559", "4012888888881881", "4222222222222220", "6011111111111117", "3530111333300000"]
    rows = [(i, f"please pay with card number {c} before noon") for i, c in enumerate(cards)]
    rows += [(10, "please pay with card number 4111111111111112 before noon"), (11, "about 4111111111111112 again"), (12, "year 20240101 is not one")]
    found = {r["doc_id"]: r["spans"] for r in personal_data(docs(spark, rows), Bootstrap(pattern_score=0.5, accept=0.8)).collect()}
    assert found[10] == "ctx:28:44" and found[11] == "ctx:6:22" and found[12] == "" and found[0] == "card:28:44"
    clean = {r["doc_id"]: (r["text"], r["n_chars"]) for r in redact(docs(spark, [*rows, (13, None)])).collect()}
    assert clean[10][0] == "please pay with card number [CTX] before noon" and clean[10][1] == len(clean[10][0])
    assert clean[0][0] == "please pay with card number [CARD] before noon" and clean[12][0] == rows[-1][1] and clean[13] == (None, None)


def test_contexts_find_identifiers_of_other_shapes(spark):
    texts = [(i, f"please call me at +1 415 555 01{i:02d} after lunch today") for i in range(10)]
    texts += [(100 + i, f"the account holder is a{i}@b.com since last year") for i in range(10)]
    new = {200: "020 7946 0018", 201: "+4475", 202: "7946-01", 203: "77", 204: "020 7946 0018"}
    texts += [(i, f"please call me at {x} after lunch today") for i, x in new.items()]
    texts += [(300, "there were 77 of them and 020 7946 0018 more")]
    found = {r["doc_id"]: r for r in personal_data(docs(spark, texts)).collect()}
    assert all(found[i]["n_phone"] == 1 and found[i]["n_context"] == 0 for i in range(10))
    start = len("please call me at ")
    for i, x in new.items():
        assert f"ctx:{start}:{start + len(x)}" in found[i]["spans"].split(",")
    assert found[300]["spans"] == "ctx:26:39"  # 77 alone tells nothing
