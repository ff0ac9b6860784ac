"""Personal data: base patterns, and identifiers found by bootstrapped context patterns.

Base spans (e-mail, IP, card, phone) are found by regular expressions and checks.
They are the seeds of a bootstrap: the words around a seed, and whether it has
digits, are a lexical pattern, and the text of the seed is an instance. The same
patterns are taken around every other word with digits and every run of such
words, whatever their length and shape. Spark then scores the bipartite graph of
patterns and instances in rounds:

* a pattern's score is the mean score of its different instances, smoothed;
* an instance's score is 1 for seeds, else the noisy-or of its patterns that
  score enough and have enough known instances.

Instances that score at least ``accept`` are new spans of kind ``ctx`` wherever one
of their patterns that score enough surrounds them; those with ``least_digits``
tell themselves and are spans everywhere. Base spans always stay.

All of it is Column expressions and joins. Positions are code points, ends exclusive.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import mark_possible, stage
from .common import unused

# Kind and pattern. They match as the plain patterns do; a look
# behind and possessive quantifiers keep them linear on long runs of characters.
PATTERNS = (
    ("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    ("card", r"(?:(?<![0-9])|\G)[0-9](?:[\x20-]?[0-9])++"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)
BYTE = "0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
IP_IN_RANGE = rf"^{BYTE}\.{BYTE}\.{BYTE}\.{BYTE}$"
NUMBER_WORD = r"(?<!\S)[^\s0-9]*+[0-9]\S*+"
NUMBER_WORDS = rf"{NUMBER_WORD}(?:\s++[^\s0-9]*+[0-9]\S*+)++"
# What is cut off around a candidate; a plus sign before a digit belongs to it.
LEAD = r"^(?:(?!\+[0-9])[\p{P}\p{S}])+"
KIND_NAMES = ("email", "ip", "card", "phone", "ctx")
CONTEXT = 5  # the number of ctx in the order of kinds, from 1


@dataclass(frozen=True)
class Bootstrap:
    rounds: int = 3
    least_known: int = 3  # different instances that score, before a pattern counts
    pattern_score: float = 0.5
    accept: float = 0.8
    context_chars: int = 48
    least_digits: int = 4  # of an instance, to be known without its context


def luhn(digits: Column) -> Column:
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)),
        F.lit(0),
        lambda acc, i: acc + luhn_value(F.substring(digits, -i, F.lit(1)).cast("int"), i),
    )
    return total % 10 == 0


def luhn_value(digit: Column, place: Column) -> Column:
    twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
    return F.when(place % 2 == 0, twice).otherwise(digit)


def is_card(found: Column) -> Column:
    digits = F.regexp_replace(found, "[ -]", "")
    return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(False)


def is_phone(found: Column) -> Column:
    return F.length(F.regexp_replace(found, "[^0-9]", "")).between(10, 15)


CHECKS: dict[str, Callable[[Column], Column]] = {
    "email": lambda found: F.lit(True),
    "ip": lambda found: found.rlike(IP_IN_RANGE),
    "card": is_card,
    "phone": is_phone,
}


def with_matches(df: DataFrame, text: str, pattern: str, where: Column, kind: int, name: str) -> DataFrame:
    """A column of (start, kind, end, found) of all matches, leftmost and without overlap."""
    found, parts = f"_{name}_found", f"_{name}_parts"
    none = F.array().cast("array<string>")
    df = df.withColumn(
        found, F.when(where, F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))).otherwise(none)
    )
    df = df.withColumn(parts, F.when(F.size(found) > 0, F.split(F.col(text), pattern, -1)).otherwise(none))
    steps = F.zip_with(
        F.slice(F.col(parts), F.lit(1), F.size(found)),
        F.col(found),
        lambda before, hit: F.struct(F.length(before).alias("skip"), hit.alias("hit")),
    )
    kinds = "array<struct<start:int,kind:int,end:int,found:string>>"
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(kinds).alias("out"))

    def add(done, one):
        start = done["at"] + one["skip"]
        end = start + F.length(one["hit"])
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), one["hit"].alias("found"))
        return F.struct(end.alias("at"), F.concat(done["out"], F.array(span)).alias("out"))

    value = F.when(F.size(found) > 0, F.aggregate(steps, zero, add, lambda done: done["out"])).otherwise(F.array().cast(kinds))
    return df.withColumn(name, value).drop(found, parts)


def with_base_spans(df: DataFrame, text: str) -> DataFrame:
    """Columns ``_email``, ``_ip``, ``_card``, ``_phone`` with the checked spans of each kind."""
    body = F.col(text)
    gates = {"email": body.contains("@"), "ip": body.rlike(r"[0-9]\.[0-9]"), "card": body.rlike(r"[0-9][\x20-]?[0-9]")}
    gates["phone"] = body.rlike(r"\+[0-9]")
    for number, (kind, pattern) in enumerate(PATTERNS, 1):
        df = with_matches(df, text, pattern, gates[kind], number, f"_{kind}")
        df = df.withColumn(f"_{kind}", checked(F.col(f"_{kind}"), CHECKS[kind]))
    return df


def checked(spans: Column, check: Callable[[Column], Column]) -> Column:
    return F.filter(spans, lambda s: check(s["found"]))


def contexts(text: Column, start: Column, end: Column, token: Column, chars: int) -> Column:
    """The lexical patterns around a span: two words before, one word before with one after."""
    left_from = F.greatest(F.lit(0), start - chars)
    left = F.lower(F.substring(text, left_from + 1, start - left_from))
    right = F.lower(F.substring(text, end + 1, F.lit(chars)))
    one = F.regexp_extract(left, r"(\S+)\s*$", 1)
    two = F.regexp_extract(left, r"(\S+\s+\S+)\s*$", 1)
    after = F.regexp_extract(right, r"^\S*\s+(\S+)", 1)
    kind = F.when(token.rlike("[0-9]"), "9").otherwise("a")
    made = F.array(
        F.when(two != "", F.concat_ws(" ", F.lit("LL"), two, kind)),
        F.when((one != "") & (after != ""), F.concat_ws(" ", F.lit("LR"), one, kind, after)),
    )
    return F.filter(made, lambda p: p.isNotNull())


def span_table(docs: DataFrame, settings: Bootstrap) -> DataFrame:
    """Per row: two hashes that name it, the base spans, and seeds and candidates with their patterns."""
    df = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    df = with_base_spans(df, "text")
    df = df.withColumn("base", F.array_sort(F.concat(*[F.col(f"_{kind}") for kind, _ in PATTERNS])))
    df = with_matches(df, "text", NUMBER_WORD, F.col("text").rlike("[0-9]"), CONTEXT, "_words")
    df = with_matches(df, "text", NUMBER_WORDS, F.size("_words") > 1, CONTEXT, "_runs")

    def trimmed(s):
        lead = F.length(F.regexp_extract(s["found"], LEAD, 0))
        core = F.regexp_replace(s["found"], rf"{LEAD}|[\p{{P}}\p{{S}}]+$", "")
        start = s["start"] + lead
        return F.struct(
            start.alias("start"), F.lit(CONTEXT).alias("kind"), (start + F.length(core)).alias("end"), core.alias("found")
        )

    free = lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    df = df.withColumn("words", F.filter(F.transform(F.concat("_words", "_runs"), trimmed), free))

    def node(s):
        around = contexts(F.col("text"), s["start"], s["end"], s["found"], settings.context_chars)
        return F.struct(
            s["start"].alias("start"), s["end"].alias("end"), F.lower(s["found"]).alias("instance"), around.alias("patterns")
        )

    return df.select(
        "doc_id",
        F.xxhash64("doc_id", "text").alias("row_a"),
        F.xxhash64(F.lit(1), "text", "doc_id").alias("row_b"),
        *[F.size(f"_{kind}").cast("long").alias(f"n_{kind}") for kind, _ in PATTERNS],
        F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))).alias("base"),
        F.transform("base", node).alias("seeds"),
        F.transform("words", node).alias("candidates"),
    )


def accepted_instances(spans: DataFrame, settings: Bootstrap) -> DataFrame:
    """(instance, pattern) of the candidates that the bootstrap takes for identifiers, with their strong patterns."""

    def edges(column: str, seed: bool) -> DataFrame:
        nodes = spans.filter(F.size(column) > 0).select(F.explode(column).alias("n"))
        return nodes.select(F.explode("n.patterns").alias("pattern"), F.col("n.instance").alias("instance"), F.lit(seed).alias("seed"))

    graph = stage(
        edges("seeds", True).union(edges("candidates", False)).groupBy("pattern", "instance").agg(F.max("seed").alias("seed"))
    )
    scores = stage(graph.filter("seed").select("instance").distinct().withColumn("score", F.lit(1.0)))
    for _ in range(settings.rounds):
        known = graph.join(scores, "instance", "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
        patterns = known.groupBy("pattern").agg(
            (F.sum("score") / (F.count("*") + 1)).alias("score"), F.count(F.when(F.col("score") >= settings.accept, 1)).alias("known")
        )
        strong = stage(
            patterns.filter((F.col("score") >= settings.pattern_score) & (F.col("known") >= settings.least_known))
            .select("pattern", F.least(F.col("score"), F.lit(0.999)).alias("pattern_score"))
        )
        raised = graph.join(strong, "pattern").groupBy("instance").agg(
            (1 - F.exp(F.sum(F.ln(1 - F.col("pattern_score"))))).alias("score")
        )
        seeds = graph.filter("seed").select("instance", F.lit(1.0).alias("score"))
        scores = stage(raised.union(seeds).groupBy("instance").agg(F.max("score").alias("score")))
    accepted = scores.filter(F.col("score") >= settings.accept).select("instance")
    return graph.filter("NOT seed").select("instance", "pattern").join(accepted, "instance").join(strong.select("pattern"), "pattern")


def context_spans(spans: DataFrame, settings: Bootstrap) -> DataFrame:
    """(row_a, row_b, more) with the new spans of each row that has some."""
    found = spans.filter(F.size("candidates") > 0).select("row_a", "row_b", F.explode("candidates").alias("n"))
    found = found.select("row_a", "row_b", "n.start", "n.end", "n.instance", "n.patterns")
    accepted = stage(accepted_instances(spans, settings))
    telling = F.length(F.regexp_replace("instance", "[^0-9]", "")) >= settings.least_digits
    short = found.filter(~telling).withColumn("pattern", F.explode("patterns")).join(accepted, ["instance", "pattern"])
    long = found.filter(telling).join(accepted.select("instance").distinct(), "instance")
    new = short.drop("patterns", "pattern").unionByName(long.drop("patterns"))
    span = F.struct("start", F.lit(CONTEXT).alias("kind"), "end")
    return new.groupBy("row_a", "row_b").agg(F.sort_array(F.collect_set(span)).alias("more"))


def joined(spans: Column) -> Column:
    name = lambda s: F.element_at(F.array(*[F.lit(k) for k in KIND_NAMES]), s["kind"])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"], s["end"])), ",")


def personal_data(docs: DataFrame, settings: Bootstrap | None = None) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): counts per kind, a digest of the base spans, all spans.

    A null text is empty and has none. Repeated rows have the same spans; other
    columns are ignored.
    """
    settings = settings or Bootstrap()
    spans = stage(span_table(docs, settings))
    more = stage(context_spans(spans, settings))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    every = F.array_sort(F.concat("base", F.coalesce("more", none)))
    return spans.join(more, ["row_a", "row_b"], "left").select(
        "doc_id",
        *[f"n_{kind}" for kind, _ in PATTERNS],
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(every).alias("spans"),
        F.size(F.coalesce("more", none)).cast("long").alias("n_context"),
    )


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by its kind in brackets; overlapping spans share the first kind."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KIND_NAMES])
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(done, s):
        gap = F.substring(text, done["at"] + 1, F.greatest(F.lit(0), s["start"] - done["at"]))
        fresh = s["start"] >= done["at"]
        out = F.when(fresh, F.concat(done["out"], gap, F.element_at(names, s["kind"]))).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), out.alias("out"))

    return F.aggregate(spans, zero, add, lambda d: F.concat(d["out"], F.substring(text, d["at"] + 1, F.length(text))))


def redact(docs: DataFrame, settings: Bootstrap | None = None) -> DataFrame:
    """``docs`` with personal data replaced in ``text`` and ``n_chars`` (where there is one) counted anew."""
    settings = settings or Bootstrap()
    spans = stage(span_table(docs, settings))
    more = context_spans(spans, settings)
    hits = spans.select("row_a", "row_b", "base").filter(F.size("base") > 0)
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    hits = hits.join(more, ["row_a", "row_b"], "full").select(
        "row_a", "row_b", F.array_sort(F.concat(F.coalesce("base", none), F.coalesce("more", none))).alias("all")
    )
    a, b, every, possible, at, word = unused(docs.columns, "_row_a", "_row_b", "_spans", "_possible", "_at", "_word")
    hits = stage(hits.dropDuplicates(["row_a", "row_b"]).toDF(a, b, every))
    body = F.coalesce("text", F.lit(""))
    named = docs.withColumn(a, F.xxhash64(F.col("doc_id"), body)).withColumn(b, F.xxhash64(F.lit(1), body, F.col("doc_id")))
    # Most rows have no span: they are not shuffled.
    named = mark_possible(named, hits.select(F.col(a).alias("key")), F.col(a), possible, at, word)
    out = named.filter(F.col(possible)).join(hits, [a, b], "left")
    (clean,) = unused(out.columns, "_clean")
    out = out.withColumn(clean, F.when(F.col(every).isNotNull(), redacted(F.col("text"), F.col(every))).otherwise(F.col("text")))
    kept = []
    for c in docs.columns:
        if c == "text":
            kept.append(F.col(clean).alias("text"))
        elif c == "n_chars":
            changed = F.length(clean).cast(docs.schema["n_chars"].dataType)
            kept.append(F.when(F.col(every).isNotNull(), changed).otherwise(F.col("n_chars")).alias("n_chars"))
        else:
            kept.append(F.col(f"`{c}`"))
    return named.filter(~F.col(possible)).select(*[F.col(f"`{c}`") for c in docs.columns]).union(out.select(*kept))
