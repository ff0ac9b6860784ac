"""Row validation: declared rules, quarantine with reasons, first valid row wins.

A table's rules are data (:class:`RuleSet`). Most depend on one row and its
parents. The duplicate rule depends on the other rows of the same key:

* only rows without any other fault can be the first of their key;
* every later row with that key, faulty or not, is a duplicate.

Accepting keeps one row per key and task before the shuffle. Rejecting compares
each row with the first valid position of its key through a lookup that
tolerates hot keys; no group is ever gathered in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import clean, code, money, out_of_range, parse_date, parse_decimal, whole_number
from .keys import first_per_key
from .skew import lookup_join, mark_possible, stage

ROW_ORDER = "_row_seq"
SEPARATOR = "|"

Reason = tuple[str, Column]


def missing_required(*fields: str) -> list[Reason]:
    return [(f, clean(f) == "") for f in fields]


def invalid_positive(*fields: str) -> list[Reason]:
    return [(f, parse_decimal(f) <= 0) for f in fields]


def invalid_allowed(allowed: Mapping[str, tuple[str, ...]]) -> list[Reason]:
    return [(f, ~code(f).isin(*values)) for f, values in allowed.items()]


def unreadable_date(*fields: str) -> list[Reason]:
    return [(f"invalid_{f}", (clean(f) != "") & parse_date(f).isNull()) for f in fields]


def numbers_out_of_range(columns: Mapping[str, Callable[[str], Column]]) -> list[Reason]:
    """For every column read as a number: too large to be read, which must not pass as 0."""
    return [(f"out_of_range_{c}", out_of_range(c)) for c, make in columns.items() if make in (money, whole_number)]


def reason_text(reasons: list[Reason]) -> Column:
    """The reasons that apply, in order, joined by a vertical bar; empty text if none do."""
    return F.concat_ws(SEPARATOR, *[F.when(test, F.lit(name)) for name, test in reasons])


@dataclass(frozen=True)
class RuleSet:
    """The rules of one table and its cleaned columns.

    ``parents`` pairs a column with the table whose accepted keys it must match.
    ``checks`` are named faults of a single row. ``event_date`` is the date that
    becomes a date key and therefore must be readable.
    """

    table: str
    key: str
    required: tuple[str, ...]
    positive: tuple[str, ...] = ()
    allowed: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    checks: tuple[tuple[str, Callable[[], Column]], ...] = ()
    parents: tuple[tuple[str, str], ...] = ()
    event_date: str | None = None
    columns: Mapping[str, Callable[[str], Column]] = field(default_factory=dict)

    def expected(self) -> list[str]:
        return list(dict.fromkeys([self.key, *self.required, *self.columns]))


def raw_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if not c.startswith("_")]


def with_expected(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns that the extract lacks are present and empty."""
    missing = {c: F.lit(None).cast("string") for c in columns if c not in df.columns}
    return df.withColumns(missing) if missing else df


def bronze_columns(df: DataFrame) -> list[str]:
    return [*raw_columns(df), ROW_ORDER]


def with_keys(bronze: DataFrame, rules: RuleSet) -> DataFrame:
    """``bronze`` with its key and its references, as accepted keys are written."""
    return bronze.withColumns({"_key": code(rules.key), **{f"_ref_{c}": code(c) for c, _ in rules.parents}})


def with_parents(
    keyed: DataFrame, rules: RuleSet, parents: Mapping[str, DataFrame], stored: Collection[str] = ()
) -> DataFrame:
    """Rows of :func:`with_keys` and, for each parent, whether the accepted keys hold the value.

    ``parents`` maps a table name to a frame whose accepted keys are in the
    column named like the referring column; those in ``stored`` are read from
    files. Every lookup shuffles the rows, so pass only the columns that are
    needed later, in their short form. The largest parents are named first and looked
    up last: references to those that are broadcast then need not be shuffled.
    """
    found = keyed
    for column, table in reversed(rules.parents):
        known = parents[table].select(F.col(column).alias(f"_ref_{column}"), F.lit(True).alias(f"_has_{column}"))
        found = lookup_join(found, known, f"_ref_{column}", table in stored)
    return found


def cleaned_columns(bronze: DataFrame, rules: RuleSet) -> dict[str, Column]:
    """The silver columns by name. A table without declared ones keeps what it has, trimmed."""
    ready = {rules.key: "_key", **{c: f"_ref_{c}" for c, _ in rules.parents if f"_ref_{c}" in bronze.columns}}
    columns = rules.columns or {c: clean for c in raw_columns(bronze)}
    return {c: F.col(ready[c]) if c in ready else make(c) for c, make in columns.items()}


def carried(keyed: DataFrame, rules: RuleSet, columns: Sequence[str] | None) -> list[Column]:
    """What rows take along besides the key and references of :func:`with_keys`: raw values, or cleaned ``columns``."""
    if columns is None:
        return [F.col(c) for c in raw_columns(keyed)]
    ready = {rules.key, *[c for c, _ in rules.parents]}
    return [made.alias(c) for c, made in cleaned_columns(keyed, rules).items() if c in columns and c not in ready]


def faults(rules: RuleSet) -> tuple[list[Reason], list[Reason], list[Reason]]:
    """The reasons before the duplicate rule; those on parents and the others after it.

    The first and the last depend on the raw row alone, the second on :func:`with_parents`.
    """
    before = (
        missing_required(*rules.required)
        + invalid_positive(*rules.positive)
        + invalid_allowed(rules.allowed)
        + [(name, test()) for name, test in rules.checks]
    )
    unknown = [(f"unknown_{c}", F.col(f"_has_{c}").isNull()) for c, _ in rules.parents]
    unreadable = unreadable_date(rules.event_date) if rules.event_date else []
    return before, unknown, unreadable + numbers_out_of_range(rules.columns)


def faultless_alone(rules: RuleSet) -> Column:
    """No fault that the row alone shows, over :func:`with_keys`, with as few tests as that takes.

    A value that matches an accepted key, or reads as a date, is not blank.
    """
    implied = {c for c, _ in rules.parents} | {rules.event_date}
    needed = [f for f in rules.required if f not in implied]
    tests = (
        [~test for _, test in missing_required(*[f for f in needed if f != rules.key])]
        + [F.col("_key") != ""]
        + [~test for _, test in invalid_positive(*rules.positive) + invalid_allowed(rules.allowed)]
        + [~test() for _, test in rules.checks]
        + ([parse_date(rules.event_date).isNotNull()] if rules.event_date else [])
        + [~test for _, test in numbers_out_of_range(rules.columns)]
    )
    return reduce(Column.__and__, tests)


def known_parents(rules: RuleSet) -> Column:
    """All references match, over :func:`with_parents`."""
    return reduce(Column.__and__, [F.col(f"_has_{c}").isNotNull() for c, _ in rules.parents], F.lit(True))


def accept(
    bronze: DataFrame,
    rules: RuleSet,
    parents: Mapping[str, DataFrame],
    columns: Sequence[str] | None = None,
    stored: Collection[str] = (),
) -> DataFrame:
    """The first faultless row of every key: the cleaned key and references, and raw values or cleaned ``columns``.

    The tests on one row run in the scan, and so does the cleaning; the
    referential tests turn the lookups into inner joins.
    """
    keyed = with_keys(with_expected(bronze, rules.expected()), rules).filter(faultless_alone(rules))
    references = [f"_ref_{c}" for c, _ in rules.parents]
    rows = keyed.select(*carried(keyed, rules, columns), ROW_ORDER, "_key", *references)
    found = with_parents(rows, rules, parents, stored).filter(known_parents(rules)).select(*rows.columns)
    return first_rows(found, rules, columns)


def first_rows(faultless: DataFrame, rules: RuleSet | None, columns: Sequence[str] | None) -> DataFrame:
    """The first row of every key. Where only the key is wanted, every row of it is as good as the first."""
    if rules and list(columns or ()) == [rules.key]:
        return faultless.select("_key").distinct()
    return first_per_key(faultless, "_key", ROW_ORDER)


def check(
    bronze: DataFrame,
    rules: RuleSet,
    parents: Mapping[str, DataFrame],
    columns: Sequence[str] | None = None,
    stored: Collection[str] = (),
) -> DataFrame:
    """Every row with its key and the reasons before and after the duplicate rule; raw values, or cleaned ``columns``.

    The reasons that the row alone shows are found in the scan.
    """
    keyed = with_keys(with_expected(bronze, rules.expected()), rules)
    before, unknown, alone = faults(rules)
    rows = keyed.select(
        *carried(keyed, rules, columns),
        ROW_ORDER,
        "_key",
        *[f"_ref_{c}" for c, _ in rules.parents],
        reason_text(before).alias("_before"),
        reason_text(alone).alias("_alone"),
    )
    references = [F.when(test, F.lit(name)) for name, test in unknown]
    after = F.concat_ws(SEPARATOR, *references, F.nullif("_alone", F.lit("")))
    kept = [f"_ref_{c}" for c, _ in rules.parents if c in (columns or ())]
    return with_parents(rows, rules, parents, stored).select(
        *raw_columns(rows), ROW_ORDER, "_key", *kept, "_before", after.alias("_after")
    )


def is_faultless() -> Column:
    """No fault but perhaps the duplicate, over :func:`check`."""
    return (F.col("_before") == "") & (F.col("_after") == "")


def accept_checked(checked: DataFrame, rules: RuleSet | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """:func:`accept` for rows that :func:`check` has already been over."""
    return first_rows(checked.filter(is_faultless()), rules, columns)


def to_silver(accepted: DataFrame, rules: RuleSet) -> DataFrame:
    """Cleaned and typed columns of raw accepted rows."""
    return accepted.select(*[made.alias(c) for c, made in cleaned_columns(accepted, rules).items()])


def as_silver(accepted: DataFrame, rules: RuleSet, columns: Sequence[str]) -> DataFrame:
    """Accepted rows that have been taken along cleaned, as :func:`to_silver` has them."""
    ready = {rules.key: "_key", **{c: f"_ref_{c}" for c, _ in rules.parents}}
    held = accepted.columns
    return accepted.select(*[F.col(c if c in held else ready[c]).alias(c) for c in columns])


def repeated_keys(checked: DataFrame) -> DataFrame:
    """(_key, _first) of the keys that occur again and have a faultless row."""
    return (
        checked.groupBy("_key")
        .agg(F.min(F.when(is_faultless(), F.col(ROW_ORDER))).alias("_first"), F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_first").isNotNull() & (F.col("_rows") > 1))
        .select("_key", "_first")
    )


def explained(checked: DataFrame, duplicate: Column) -> DataFrame:
    """Raw values and ``error_reason`` of checked rows. ``duplicate`` is the reason of the duplicate rule, or NULL."""
    empty = F.lit("")
    reason = F.concat_ws(SEPARATOR, F.nullif("_before", empty), duplicate, F.nullif("_after", empty))
    return checked.select(*raw_columns(checked), reason.alias("error_reason"))


def explain_repeated(checked: DataFrame, rules: RuleSet, firsts: DataFrame, stored: bool = False) -> DataFrame:
    marked = lookup_join(checked, firsts, "_key", stored, grows=not stored)
    again = F.when(F.col(ROW_ORDER) > F.col("_first"), F.lit(f"duplicate_{rules.key}"))
    return explained(marked, again)


def explain_rows(checked: DataFrame, rules: RuleSet) -> DataFrame:
    """Every row with its ``error_reason``, which is empty for accepted rows.

    Only keys that occur again, and have a faultless row, are looked up.
    """
    return explain_repeated(checked, rules, repeated_keys(checked))


def count_rejected(checked: DataFrame) -> DataFrame:
    """The number of rows to which :func:`explain_rows` gives a reason, as one row ``rejected``.

    A faulty row has one anyway, so only faultless rows are compared with the first of their key.
    """
    faultless = checked.filter(is_faultless()).select("_key", ROW_ORDER)
    firsts = (
        faultless.groupBy("_key")
        .agg(F.min(ROW_ORDER).alias("_first"), F.count(F.lit(1)).alias("_rows"))
        .filter("_rows > 1")
        .select("_key", "_first")
    )
    later = lookup_join(faultless, firsts, "_key", grows=True).filter(F.col(ROW_ORDER) > F.col("_first"))
    faulty = checked.agg(F.count_if(~is_faultless()).alias("_faulty"))
    return faulty.crossJoin(later.agg(F.count(F.lit(1)).alias("_later"))).select(
        (F.col("_faulty") + F.col("_later")).alias("rejected")
    )


def mark_repeated(checked: DataFrame, firsts: DataFrame) -> DataFrame:
    """Checked rows with the flag ``_possible``, which is true for every key in ``firsts`` and for few others."""
    return mark_possible(checked, firsts.select(F.xxhash64("_key").alias("key")), F.xxhash64("_key"), "_possible")


def accept_unshuffled(checked: DataFrame, firsts: DataFrame) -> DataFrame:
    """:func:`accept_checked` over staged rows and :func:`repeated_keys`: only rows of repeated keys are shuffled."""
    faultless = mark_repeated(checked, firsts).filter(is_faultless())
    alone, met = faultless.filter(~F.col("_possible")), faultless.filter("_possible")
    return alone.union(first_per_key(met, "_key", ROW_ORDER)).drop("_possible")


def reject(checked: DataFrame, rules: RuleSet, staged: bool = False, firsts: DataFrame | None = None) -> DataFrame:
    """Raw values and reasons of the rows that are not accepted.

    The checked rows are read several times, so they are staged unless they already
    are, and so are their :func:`repeated_keys`. Rows of other keys than these are not
    shuffled: their reasons are known.
    """
    checked = checked if staged else stage(checked)
    firsts = stage(repeated_keys(checked)) if firsts is None else firsts
    marked = mark_repeated(checked, firsts)
    alone = explained(marked.filter(~F.col("_possible") & ~is_faultless()), F.lit(None).cast("string"))
    met = explain_repeated(marked.filter("_possible"), rules, firsts, stored=True)
    return alone.union(met.filter(F.col("error_reason") != ""))
