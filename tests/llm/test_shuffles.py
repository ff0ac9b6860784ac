"""What the pipeline's stages shuffle, and the components that they name."""

import random

import pyarrow as pa
import pytest
from brute import docs
from pyspark.sql import functions as F

from creditlake.llm import common
from creditlake.llm.components import connected_components, joined_components
from creditlake.llm.jaccard import one_of_each_group
from creditlake.llm.pii import redact
from creditlake.llm.toxicity import fit, remove_toxic, with_score
from creditlake.operators.skew import mark_possible


def unshuffled_part(df):
    """The plan of the rows that no join sees: the first part of the union."""
    plan = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple").splitlines()
    union = next(i for i, line in enumerate(plan) if line.lstrip(" +-:").startswith("Union"))
    depth = plan[union].index("Union")
    end = next(i for i, line in enumerate(plan[union + 1 :], union + 1) if line[depth:].startswith("+-"))
    return plan[union + 1 : end], plan[end:]


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_that_a_stage_leaves_alone_are_not_shuffled(spark, no_broadcast):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    text = lambda *more: " ".join([*rng.choices(words, k=30), *more])
    rows = [(i, text(*["vile"] * (i % 3 == 0))) for i in range(120)]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(120)], "doc_id bigint, quality int, toxic int")
    copies = [(i, "a b c d e f g") for i in (7, 5, None, 5)] + [(8, None)]
    mail = [(1, "write a@b.com now"), (2, "nothing here"), (3, None)]

    table = docs(spark, [*rows, (1, rows[3][1]), (None, rows[3][1]), (500, None)])
    model = fit(table, labels)
    clean = remove_toxic(table, model)
    single = one_of_each_group(docs(spark, copies))
    masked = redact(docs(spark, mail))
    for found in (clean, single, masked):
        alone, met = unshuffled_part(found)
        by_key = lambda lines: any("Exchange hashpartitioning" in line for line in lines)
        assert not by_key(alone) and by_key(met)
    scored, name = with_score(table, model)
    expected = sorted(str(r["doc_id"]) for r in scored.collect() if r[name] < 0.7)
    assert sorted(str(r["doc_id"]) for r in clean.collect()) == expected and 0 < len(expected) < 123
    assert sorted(map(str, (r["doc_id"] for r in single.collect()))) == ["5", "5", "8", "None"]
    assert {r["doc_id"]: r["text"] for r in masked.collect()} == {1: "write [EMAIL] now", 2: "nothing here", 3: None}


def test_no_match_is_missed(spark, monkeypatch):
    monkeypatch.setattr(common, "MAP_BITS", 1 << 12)
    rows = spark.range(0, 4000, 20)
    test = common.may_match(rows, F.xxhash64("id"))
    found = {r["id"] for r in spark.range(4000).filter(test(F.xxhash64("id"))).collect()}
    assert found >= set(range(0, 4000, 20)) and len(found) < 800
    none = common.may_match(rows.limit(0), F.xxhash64("id"))
    assert spark.range(10).filter(none(F.xxhash64("id"))).count() == 0


def plain_components(links):
    above = {}
    for a, b in links:
        if a != b:
            below = {above.get(a, a), above.get(b, b)}
            above |= {n: min(below) for n in [*above, a, b] if above.get(n, n) in below}
    return above


@pytest.mark.parametrize("most", [40, 1 << 17])
def test_components_in_batches_and_in_rounds(spark, most):
    rng = random.Random(6)
    links = [(rng.randrange(900), rng.randrange(900)) for _ in range(400)] + [(i + 1000, i + 1001) for i in range(150)]
    rng.shuffle(links)
    table = lambda rows: spark.createDataFrame(rows, "a bigint, b bigint").repartition(4)
    found = {r["node"]: r["component"] for r in connected_components(table(links), most).collect()}
    assert found == plain_components(links)
    labels = None
    for at in range(0, len(links), 200):
        labels = joined_components(labels, table(links[at : at + 200]))
    assert sorted(tuple(r) for r in labels.collect()) == sorted(plain_components(links).items())


def test_a_batch_is_contracted_to_its_smallest_nodes():
    from creditlake.llm.components import forest

    found = forest(pa.table({"u": [5, 9, 4, 8], "v": [3, 5, 2, 8]}))
    assert dict(zip(found.column(0).to_pylist(), found.column(1).to_pylist())) == {5: 3, 3: 3, 9: 3, 4: 2, 2: 2, 8: 8}


def test_personal_data_runs_no_python(spark):
    """Texts are masked by Column expressions and joins alone; further columns may have any name."""
    mail = [(1, "write a@b.com now"), (1, "write a@b.com now"), (2, "nothing here"), (3, None), (None, "call +1 202 555 0143 9 now")]
    table = docs(spark, mail).withColumns({"_possible": F.lit("x"), "_at": F.lit("y"), "_Word": F.lit("z")})
    masked = redact(table)
    plan = spark._jvm.PythonSQLUtils.explainString(masked._jdf.queryExecution(), "simple")
    assert "Python" not in plan and "InArrow" not in plan and "Union" in plan
    assert masked.columns == table.columns
    found = sorted((str(r["doc_id"]), str(r["text"]), r["_possible"], r["_at"], r["_Word"]) for r in masked.collect())
    texts = [("1", "write [EMAIL] now")] * 2 + [("2", "nothing here"), ("3", "None"), ("None", "call [PHONE] now")]
    assert found == [(*t, "x", "y", "z") for t in texts]


def test_no_row_that_may_match_is_missed(spark):
    keys = spark.range(0, 4000, 20).select(F.xxhash64("id").alias("key"))
    marked = mark_possible(spark.range(4000), keys, F.xxhash64("id"))
    assert marked.columns == ["id", "_possible"] and marked.count() == 4000
    found = {r["id"] for r in marked.filter("_possible").collect()}
    assert found >= set(range(0, 4000, 20)) and len(found) < 220
    assert mark_possible(spark.range(10), keys.limit(0), F.xxhash64("id")).filter("_possible").count() == 0
