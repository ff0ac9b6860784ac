import math
import random
import re
from collections import Counter

import pytest
from brute import LOWER, awkward, docs
from creditlake.llm.lexical import Search, search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(texts, items, top=10):
    """Scores of all documents for all items."""
    counts = [(i, Counter(terms(t))) for i, t in texts]
    counts = [(i, c) for i, c in counts if c]
    n_docs, n_words = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * k + 1))) for t, k in df.items()}
    out = []
    for name, text in items:
        scored = []
        for i, c in counts:
            m = 10 + 90 * sum(c.values()) * n_docs // n_words
            score = sum(weight[t] * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            if score > 0:
                scored.append((-score, i is not None, i or 0))
        out += [(name, rank, i if known else None, -s) for rank, (s, known, i) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def result(found):
    return sorted((tuple(r) for r in found.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def item_frame(spark, items):
    return spark.createDataFrame([(i, t, 1, 2, "x") for i, t in items], "item_id bigint, text string, doc_id int, rank int, score string")


@pytest.mark.parametrize(
    "seed, how", [(0, Search()), (1, Search(block=16, group=3)), (2, Search(block=50, group=5, rarity=(30, 10, 5, 3, 2), top=4)), (3, Search(rarity=()))]
)
def test_ranks_match_all_scores(spark, seed, how):
    rng = random.Random(seed)
    vocabulary = [f"w{int(i ** 1.5)}" for i in range(120)]
    pick = lambda k: " ".join(vocabulary[int(rng.random() ** 2 * 120)] for _ in range(k))
    texts = [(i, pick(rng.randrange(0, 40))) for i in range(300)]
    items = [(i, pick(rng.randrange(1, 14))) for i in range(12)] + [(12, texts[5][1]), (13, "nowhere to be found"), (14, "")]
    texts += [(400, texts[5][1]), (401, texts[5][1].upper())]
    assert result(search(docs(spark, texts), item_frame(spark, items), how=how)) == plain(texts, items, how.top)


def test_awkward_rows_and_ties(spark):
    texts = awkward() + [(30 + i, "same words in every row") for i in range(25)] + [(31, "same words in every row"), (60, "Größe GRÖSSE größe.one_two")]
    items = [(1, "SAME words"), (1, "same words"), (None, "größe two"), (2, None), (3, "w1x1 w5x5 one"), (4, "nobody")]
    for how in (Search(), Search(block=4, group=1)):
        assert result(search(docs(spark, texts), item_frame(spark, items), how=how)) == plain(texts, items)


def test_empty_tables(spark):
    some = docs(spark, [(1, "a b")])
    assert search(docs(spark, []), item_frame(spark, [(1, "a")])).count() == 0
    found = search(some, item_frame(spark, []))
    assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0
    assert search(docs(spark, [(1, None), (2, " ")]), item_frame(spark, [(1, None)])).count() == 0
