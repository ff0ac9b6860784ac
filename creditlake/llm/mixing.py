"""Mixing sources to target weights by iterative proportional fitting.

Documents are summed to cells of source, language and topic. The cells' token
weights are raked: scaled to the target shares of one margin after the other, in
rounds, until none of them moves any more. A document's rate is the fitted weight
of its cell over the tokens the cell has, and it is drawn by that rate with a
hash of its id: a rate of 2.3 takes it twice, and a third time with probability
0.3. All steps are aggregations and joins of cells; documents are read twice and
never shuffled by a margin.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import stage
from .common import unused

MARGINS = ("source", "lang", "topic")
# Topics by what the text contains, the first that fits; other texts are prose.
TOPICS = (
    ("legal", ("License", "Licensed")),
    ("table", (" | ",)),
    ("secret", ("token =",)),
    ("shouting", ("!! ",)),
    ("symbols", ("%%%", "***", "###")),
)
PROSE = "prose"
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    """``keep`` is the wanted share of all tokens. A margin without given shares gets tokens ** ``temper``."""

    keep: float = 0.5
    temper: float = 0.5
    most_rounds: int = 50
    tolerance: float = 1e-9
    seed: str = "mix"


def topic_of(text: Column) -> Column:
    found = F.lit(PROSE)
    for name, marks in reversed(TOPICS):
        has = F.lit(False)
        for mark in marks:
            has = has | text.contains(mark)
        found = F.when(has, name).otherwise(found)
    return F.when(text.isNotNull(), found).otherwise(PROSE)


def tokens_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def margin_key(value: Column) -> Column:
    """A value as a key that is never null: a null value is a value of its own."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("-"))


def draw(doc_id: Column, seed: str) -> Column:
    """A number from 0 to 1 that depends on the id alone."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") / float(1 << 32)


def keyed(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with a key column per margin, and their names."""
    names = unused(docs.columns, *[f"_{m}" for m in MARGINS])
    values = [topic_of(F.col("text")) if m == "topic" else F.col(m) for m in MARGINS]
    for name, value in zip(names, values, strict=True):
        docs = docs.withColumn(name, margin_key(value))
    return docs, names


def cells_of(docs: DataFrame) -> DataFrame:
    named, names = keyed(docs.select("source", "lang", "text"))
    return named.groupBy(*[F.col(n).alias(m) for n, m in zip(names, MARGINS, strict=True)]).agg(
        F.sum(tokens_of(F.col("text"))).alias("tokens")
    )


def wanted_shares(cells: DataFrame, margin: str, mix: Mix, given: DataFrame | None) -> DataFrame:
    """(margin, share) with shares that add up to 1 over the values that occur."""
    sums = cells.groupBy(margin).agg(F.sum("tokens").cast("double").alias("tokens")).filter("tokens > 0")
    if given is None:
        shares = sums.withColumn("share", F.pow("tokens", F.lit(mix.temper)))
    else:
        listed = given.select(margin_key(F.col(margin)).alias(margin), F.col("share").cast("double").alias("share"))
        shares = sums.join(listed.groupBy(margin).agg(F.sum("share").alias("share")), margin).filter("share > 0")
    shares = stage(shares.select(margin, "share"))
    return shares.crossJoin(F.broadcast(shares.agg(F.sum("share").alias("total")))).select(
        margin, (F.col("share") / F.col("total")).alias("share")
    )


def rake(cells: DataFrame, mix: Mix, targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """``cells`` (a key per margin, ``tokens``) with ``rate``: copies wanted per document.

    ``targets`` gives (value, share) per margin; values that it leaves out, or
    gives no share, are not sampled. Cells without tokens have rate 0.
    """
    given = targets or {}
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    shares = {m: stage(wanted_shares(cells, m, mix, given.get(m))) for m in MARGINS}
    fitted = cells.filter("tokens > 0").select(*MARGINS, "tokens", F.col("tokens").cast("double").alias("w"))
    for m in MARGINS:  # a cell that one target leaves out takes no part in fitting the others
        fitted = fitted.join(shares[m].select(m), m, "left_semi")
    fitted = stage(fitted.withColumn("moved", F.lit(0.0)))
    for _ in range(mix.most_rounds):
        fitted = fitted.withColumn("moved", F.lit(0.0))
        for m in MARGINS:
            sums = fitted.groupBy(m).agg(F.sum("w").alias("sum"))
            factors = sums.join(shares[m], m).select(m, (F.col("share") * float(total) / F.col("sum")).alias("factor"))
            fitted = stage(
                fitted.join(factors, m).select(
                    *MARGINS, "tokens", (F.col("w") * F.col("factor")).alias("w"),
                    F.greatest("moved", F.abs(F.col("factor") - 1)).alias("moved"),
                )
            )
        if (fitted.agg(F.max("moved")).first()[0] or 0.0) < mix.tolerance:
            break
    rates = fitted.select(*MARGINS, F.round(F.col("w") * mix.keep / F.col("tokens"), 6).alias("rate"))
    return cells.join(rates, list(MARGINS), "left").withColumn("rate", F.coalesce("rate", F.lit(0.0)))


def with_copies(docs: DataFrame, mix: Mix | None = None, targets: dict[str, DataFrame] | None = None) -> tuple[DataFrame, str, str]:
    """``docs`` with the rate of each row and how often it is drawn; also their names.

    Null sources and languages are values of their own; a null text is prose
    without tokens. Repeated ids are drawn alike. An empty table stays empty.
    """
    mix = mix or Mix()
    rates = stage(rake(stage(cells_of(docs)), mix, targets))
    named, keys = keyed(docs)
    rate, copies = unused(docs.columns, "rate", "copies")
    rates = rates.select(*[F.col(m).alias(k) for m, k in zip(MARGINS, keys, strict=True)], F.col("rate").alias(rate))
    drawn = F.floor(rate) + (draw(F.col("doc_id"), mix.seed) < F.col(rate) - F.floor(rate)).cast("long")
    joined = named.join(rates, keys).withColumn(copies, drawn)
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], rate, copies), rate, copies


def sampled_documents(docs: DataFrame, mix: Mix | None = None, targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """The rows of ``docs`` that are drawn, with their rate and number of copies."""
    drawn, _, copies = with_copies(docs, mix, targets)
    return drawn.filter(F.col(copies) > 0)
