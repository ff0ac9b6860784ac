import hashlib
import random
import time
import zlib

import pytest
from brute import BLANK_WORD, awkward, docs
from creditlake.llm.queries import op13_periodic_runs, repeated_tails
from creditlake.llm.runs import find_runs, kept_words, lyndon_array, periodic_runs, run_report


def plain_lyndon(x):
    n = len(x)
    return [next((j - i for j in range(i + 1, n) if x[j:] < x[i:]), n - i) for i in range(n)]


def plain_runs(w, least=12):
    """Every stretch that repeats with some period, of which the smallest counts."""
    n, found = len(w), set()
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            part = w[i : j + p]
            if j > i and len(part) >= max(least, 2 * p):
                smallest = next(q for q in range(1, p + 1) if part[q:] == part[: len(part) - q])
                if smallest == p:
                    found.add((i, len(part), p))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_tail(text, doc_id):
    if text is None or doc_id is None:
        return text
    h = zlib.crc32(str(doc_id).encode())
    words, g = BLANK_WORD.findall(text), h // 10
    if h % 10 or not words:
        return text
    n = len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return " ".join(words[i] if i < a else words[a + (i - a) % p] for i in range(n))


def plain_report(text, least=12):
    words = BLANK_WORD.findall(text or "")
    # The long awkward text has period 12961, which does not fit twice.
    runs = plain_runs(words, least) if len(words) < 5000 else []
    dropped = {i for s, n, p in runs for i in range(s + p, s + n)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    figures = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    return (len(runs), *figures, sha("".join(f"{s},{n},{p}\n" for s, n, p in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


@pytest.mark.parametrize("seed", range(6))
def test_lyndon_arrays_and_runs_match_plain_ones(seed):
    rng = random.Random(seed)
    for t in range(300):
        n, k = rng.randrange(1, 60), rng.choice([1, 2, 3, 5])
        part = [rng.randrange(k) for _ in range(rng.randrange(1, 12))]
        x = [rng.randrange(k) for _ in range(n)] if t % 2 else [part[i % len(part)] for i in range(n)] + [k] * (t % 3)
        assert lyndon_array(x) == plain_lyndon(x)
        for least in (4, 7, 12):
            assert find_runs(x, least) == plain_runs(x, least)


def test_long_and_repetitive_texts_take_linear_time():
    rng = random.Random(3)
    fibonacci, b = [0], [0, 1]
    while len(b) < 60000:
        fibonacci, b = b, b + fibonacci
    part = [rng.randrange(400) for _ in range(997)]
    started = time.perf_counter()
    for words in ([0] * 100000, [i % 50000 for i in range(100000)], [part[i % 997] for i in range(100000)], b, list(range(200000))):
        find_runs(words)
    assert time.perf_counter() - started < 30


def test_kept_words():
    assert kept_words(6, [(1, 4, 2)]).tolist() == [True, True, True, False, False, True]


def test_report_matches_plain_one_on_awkward_rows(spark):
    loop = "a b c " * 9
    rows = awkward() + [(20, loop), (21, "x " * 11), (22, "x " * 12), (23, f"start {loop} end {loop}"), (24, loop + "a a a a a a a a a a a a"), (24, loop), (25, "A a " * 6)]
    table = docs(spark, rows)
    found = sorted((r["doc_id"] or -1, *tuple(r)[1:]) for r in run_report(table).collect())
    assert found == sorted(((i or -1), *plain_report(t)) for i, t in rows)
    kept, n_words, runs, text = periodic_runs(table)
    assert set(table.columns) < set(kept.columns) and n_words == "_n_words"
    assert kept.filter("doc_id = 20").first()[text] == "a b c"


def test_empty_table(spark):
    assert run_report(docs(spark, [])).count() == 0


def test_query_on_planted_tails(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices([f"w{k}" for k in range(30)], k=rng.randrange(0, 120)))) for i in range(150)]
    rows += [(None, "a b " * 20), (151, None), (152, "")]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    planted = {r["doc_id"]: r["text"] for r in repeated_tails(spark.read.parquet(f"{tmp_path}/documents.parquet")).collect()}
    assert planted == {i: plain_tail(t, i) for i, t in rows}
    found = {r["doc_id"]: tuple(r)[1:] for r in op13_periodic_runs(spark, str(tmp_path)).collect()}
    assert found == {i: plain_report(plain_tail(t, i)) for i, t in rows}
    assert sum(r[0] > 0 for r in found.values()) > 10
