"""Lending extracts derived from order, line-item and event tables.

Every extract has text columns only, as a CSV extract would, and a ``_row_seq``
that orders the rows of each key totally.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import MONEY, is_large_movement, padded_id, risk_score, round_money
from ..operators.skew import lookup_join, spread, stage

# The transaction type that stands for each event type.
TRANSACTION_TYPES = {
    "purchase": "cash_out",
    "click": "cash_in",
    "view": "transfer",
    "signup": "merchant_payment",
    "error": "loan_repayment",
}

LINE_ORDER = (
    "l_shipdate",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
)


# Tables that grow with the business; the others are parties, places and products.
_LARGE = ("orders", "lineitem", "events")


def _text(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def _cents(value: str) -> Column:
    return F.col(value).cast(MONEY)


def _day(value: str) -> Column:
    return F.col(value).cast("date")


class TpchExtracts(Mapping):
    """The eight lending extracts as lazy frames, by table name."""

    names = (
        "branches",
        "products",
        "customers",
        "loans",
        "repayments",
        "mobile_transactions",
        "collections",
        "fraud_alerts",
    )

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._made: dict[str, DataFrame] = {}
        self._read: dict[str, DataFrame] = {}
        self._tied: DataFrame | None = None

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self.names:
            raise KeyError(table)
        if table not in self._made:
            self._made[table] = getattr(self, table)()
        return self._made[table]

    def __iter__(self):
        return iter(self.names)

    def __len__(self) -> int:
        return len(self.names)

    def read(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._read[name]

    def ordered(self, name: str) -> DataFrame:
        """A table with ``_row_seq``: the place in the file."""
        rows = self.read(name).withColumn("_row_seq", F.struct("_metadata.file_name", "_metadata.row_index"))
        return spread(rows) if name in _LARGE else rows

    def lines(self) -> DataFrame:
        """Line items with ``_row_seq``: :data:`LINE_ORDER`, then the place in the file.

        The order decides between the rows of one line number of one order, and is
        total among them. What comes after the date is most of a row's bytes in
        every shuffle, so it is there only where another such row has the same date.
        Hashes that meet by chance only mean that it is there for more rows.
        """
        same = F.xxhash64(F.concat(padded_id("", "l_orderkey", 7), padded_id("", "l_linenumber", 2)), LINE_ORDER[0])
        place = (F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
        rows = spread(self.read("lineitem").select("*", *place, same.alias("_same")))
        if self._tied is None:
            counts = self.read("lineitem").groupBy(same.alias("_same")).agg(F.count(F.lit(1)).alias("_rows"))
            self._tied = stage(counts.filter("_rows > 1").select("_same", F.lit(True).alias("_tied")))
        later = F.when(F.col("_tied"), F.struct(*LINE_ORDER[1:], "_file", "_row")).alias("later")
        marked = lookup_join(rows, self._tied, "_same", stored=True).withColumn("_row_seq", F.struct(LINE_ORDER[0], later))
        return marked.drop("_same", "_tied", "_file", "_row")

    def branches(self) -> DataFrame:
        region = self.read("region").withColumnRenamed("r_regionkey", "n_regionkey")
        return lookup_join(self.ordered("nation"), region, "n_regionkey", stored=True).select(
            padded_id("BR", "n_nationkey", 3).alias("branch_id"),
            F.col("n_name").alias("branch_name"),
            F.col("r_name").alias("region"),
            "_row_seq",
        )

    def products(self) -> DataFrame:
        return self.ordered("part").select(
            padded_id("PRD", "p_partkey", 6).alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("product_type"),
            _text("p_size").alias("base_rate"),
            "_row_seq",
        )

    def customers(self) -> DataFrame:
        none = F.lit(None).cast("string")
        signup = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("c_custkey") % 700).cast("int"))
        return self.ordered("customer").select(
            padded_id("CUST", "c_custkey", 6).alias("customer_id"),
            F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
            F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
            F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("gender"),
            none.alias("date_of_birth"),
            none.alias("phone_number"),
            none.alias("email"),
            none.alias("national_id"),
            padded_id("BR", "c_nationkey", 3).alias("branch_id"),
            _text(signup).alias("signup_date"),
            _text(_cents("c_acctbal") * 20).alias("monthly_income"),
            F.lower("c_mktsegment").alias("employment_status"),
            "_row_seq",
        )

    def loans(self) -> DataFrame:
        term = F.substring("o_orderpriority", 1, 1).cast("int") * 3
        status = (
            F.when(F.col("o_orderstatus") == "F", "CLOSED")
            .when(F.col("o_orderstatus") == "O", "ACTIVE")
            .when((F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 4 == 0), "DEFAULTED")
            .when(F.col("o_orderstatus") == "P", "OVERDUE")
        )
        # What the loan takes from its order, in the short form that the lookups shuffle.
        orders = self.ordered("orders").select(
            "o_orderkey",
            "o_custkey",
            _day("o_orderdate").alias("_disbursed"),
            _cents("o_totalprice").alias("_amount"),
            term.alias("_term"),
            status.alias("loan_status"),
            "_row_seq",
        )
        first_part = (
            self.read("lineitem")
            .groupBy(F.col("l_orderkey").alias("o_orderkey"))
            .agg(F.min("l_partkey").alias("p_partkey"))
        )
        part = self.read("part").select("p_partkey", "p_size")
        # The narrow side of the two is looked up first.
        first_part = lookup_join(first_part, part, "p_partkey", stored=True)
        customer = self.read("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
        rows = lookup_join(orders, first_part, "o_orderkey", grows=True)
        rows = lookup_join(rows, customer, "o_custkey", stored=True)
        return rows.select(
            padded_id("LN", "o_orderkey", 7).alias("loan_id"),
            padded_id("CUST", "o_custkey", 6).alias("customer_id"),
            padded_id("PRD", "p_partkey", 6).alias("product_id"),
            padded_id("BR", "c_nationkey", 3).alias("branch_id"),
            _text(F.date_sub("_disbursed", 5)).alias("application_date"),
            _text("_disbursed").alias("disbursement_date"),
            _text("_amount").alias("loan_amount"),
            _text("p_size").alias("interest_rate"),
            _text("_term").alias("term_months"),
            "loan_status",
            _text(F.date_add("_disbursed", F.col("_term") * 30)).alias("due_date"),
            "_row_seq",
        )

    def _lines(self, returned: bool) -> DataFrame:
        is_returned = F.col("l_returnflag") == "R"
        lines = self.lines().filter(is_returned if returned else ~is_returned)
        # The date is in the row already, so the lookup shuffles only what is after it.
        lines = lines.withColumn("_later", F.col("_row_seq.later")).drop("_row_seq")
        orders = self.read("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
        values = {"_amount": line_amount(), "_recovered": round_money(_cents("l_extendedprice") * _cents("l_tax"))}
        found = lookup_join(lines.withColumns(values), orders, "l_orderkey", stored=True)
        return found.withColumn("_row_seq", F.struct(LINE_ORDER[0], F.col("_later").alias("later"))).drop("_later")

    def _line_id(self, prefix: str) -> Column:
        return F.concat(padded_id(prefix, "l_orderkey", 7), padded_id("", "l_linenumber", 2))

    def repayments(self) -> DataFrame:
        return self._lines(returned=False).select(
            self._line_id("RP").alias("repayment_id"),
            padded_id("LN", "l_orderkey", 7).alias("loan_id"),
            padded_id("CUST", "o_custkey", 6).alias("customer_id"),
            _text(_day("l_shipdate")).alias("repayment_date"),
            _text("_amount").alias("amount_paid"),
            F.when(F.col("l_returnflag") == "A", "mpesa").otherwise("bank_transfer").alias("payment_channel"),
            "_row_seq",
        )

    def collections(self) -> DataFrame:
        open_line = F.col("l_linestatus") == "F"
        return self._lines(returned=True).select(
            self._line_id("COL").alias("collection_id"),
            padded_id("LN", "l_orderkey", 7).alias("loan_id"),
            padded_id("CUST", "o_custkey", 6).alias("customer_id"),
            padded_id("AGT", "l_suppkey", 4).alias("collector_id"),
            _text(_day("l_shipdate")).alias("action_date"),
            F.when(open_line, "call").otherwise("sms").alias("action_type"),
            _text("_recovered").alias("amount_recovered"),
            F.when(open_line, "contacted").otherwise("no_response").alias("outcome"),
            "_row_seq",
        )

    def movements(self) -> DataFrame:
        """Events as transactions, with numeric amount and event id and time."""
        return as_movements(self.ordered("events"), "_row_seq")

    def mobile_transactions(self) -> DataFrame:
        return self.movements().select(
            "transaction_id",
            "customer_id",
            _text(_day("event_time")).alias("transaction_date"),
            "transaction_type",
            _text("amount").alias("amount"),
            "channel",
            "merchant_category",
            "_row_seq",
        )

    def fraud_alerts(self) -> DataFrame:
        suspicious = self.movements().filter(is_large_movement("amount", "transaction_type"))
        return suspicious.select(
            padded_id("ALT", "event_id", 8).alias("alert_id"),
            "transaction_id",
            "customer_id",
            _text("event_time").alias("alert_timestamp"),
            F.lit("large_or_risky_cash_movement").alias("rule_name"),
            _text(risk_score("amount", "transaction_type")).alias("risk_score"),
            F.lit("OPEN").alias("alert_status"),
            "_row_seq",
        )

    def stream_events(self) -> DataFrame:
        return self.as_stream_events(self.read("events"))

    @staticmethod
    def as_stream_events(events: DataFrame) -> DataFrame:
        """Transactions in the shape of stream events: text columns and a timestamp.

        Event ids have leading zeros, so that their text order is their number order.
        """
        return as_movements(events).select(
            padded_id("", "event_id", 12).alias("event_id"),
            "transaction_id",
            "customer_id",
            "event_time",
            "transaction_type",
            _text("amount").alias("amount"),
            "channel",
            "merchant_category",
        )


def as_movements(events: DataFrame, *keep: str) -> DataFrame:
    kind = F.col("event_type")
    name = F.lit(None).cast("string")
    for event_type, transaction_type in TRANSACTION_TYPES.items():
        name = F.when(kind == event_type, transaction_type).otherwise(name)
    return events.select(
        "event_id",
        padded_id("TXN", "event_id", 8).alias("transaction_id"),
        padded_id("CUST", "user_id", 6).alias("customer_id"),
        F.col("ts").alias("event_time"),
        name.alias("transaction_type"),
        (_cents("value") * 1000).alias("amount"),
        F.lit("mobile_app").alias("channel"),
        F.get_json_object("props", "$.k").alias("merchant_category"),
        *keep,
    )


def line_amount() -> Column:
    """Price after discount, to the cent, ties to even."""
    return round_money(_cents("l_extendedprice") * (1 - _cents("l_discount")))
