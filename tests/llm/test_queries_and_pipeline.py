import random

import pytest
from brute import components, contamination, docs, personal
from compare import connect, duckdb_result, spark_result

import corpus_pipeline
from creditlake.llm.mixing import with_copies
from creditlake.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


@pytest.mark.parametrize("name", ORACLE)
def test_query_matches_sql(spark, database, name):
    types, rows = spark_result(QUERIES[name](spark, FOLDER))
    expected_types, expected = duckdb_result(database, ORACLE[name])
    assert types == expected_types
    assert rows == expected


def test_pipeline_matches_plain_stages(spark, tmp_path):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(500)]
    texts, labels = [], []
    for i in range(240):
        text = rng.choices(words, k=rng.randrange(25, 70))
        if i % 6 == 0:
            for _ in range(4):
                text[rng.randrange(len(text))] = rng.choice(["vile", "rotten"])
        texts.append((i, " ".join(text)))
        labels.append((i, 1, int(i % 6 == 0)))
    item = " ".join(f"q{i}" for i in range(14))
    texts += [(300 + i, texts[1][1]) for i in range(3)] + [(310, texts[2][1] + " more"), (320, "start " + item), (321, None), (322, "write a@b.com " + " ".join(rng.choices(words, k=40)))]
    folder = str(tmp_path)
    docs(spark, texts).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")

    kept = {i: t for i, t in texts if not (t and any(w in t.split() for w in ("vile", "rotten")))}
    first = components(list(kept.items()))
    kept = {i: t for i, t in kept.items() if first[i][1] == i}
    kept = {i: t for i, t in kept.items() if not contamination(t, [(1, item)])[4]}
    assert personal(kept[322])[0][0] == 1
    kept[322] = kept[322].replace("a@b.com", "[EMAIL]")
    table = docs(spark, sorted(kept.items()))
    drawn, _, copies = with_copies(table)
    expected = {r["doc_id"]: (r["text"], r[copies]) for r in drawn.collect() if r[copies]}

    result = corpus_pipeline.run(spark, folder)
    assert {r["doc_id"]: (r["text"], r["copies"]) for r in result.collect()} == expected
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "n-gram jaccard join", "benchmark decontamination", "personal data", "mixing to target weights"]
