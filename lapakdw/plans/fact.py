"""The item-grain fact table and its guard."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapakdw.functions.columns import AMOUNT, business_date, code, to_int, to_money
from lapakdw.operators.headers import HEADER_KEY, lines_of_headers, transactions_clean
from lapakdw.operators.scd import code_lookup, scd2_lookup
from lapakdw.plans.dims import calendar_span
from lapakdw.runtime import broadcast_if_small, materialize
from lapakdw.sources.raw import RawSales

FACT = "fact_transaksi_item"

# How a measure may be added up; kept in the column metadata.
ADDITIVITY = {
    "qty": "ADDITIVE",
    "diskon": "ADDITIVE",
    "subtotal_rupiah": "ADDITIVE",
    "total_bayar_trx": "SEMI-ADDITIVE",
    "harga_satuan_aktual": "NON-ADDITIVE",
}


@dataclass(frozen=True)
class Dims:
    date: DataFrame
    product: DataFrame
    outlet: DataFrame
    status: DataFrame


def date_lookup(facts: DataFrame, dates: DataFrame, day: str) -> DataFrame:
    """Add ``date_sk``, computed where the calendar has every day of a span once.

    A calendar with gaps or repeated days, as appended loads leave it, is joined.
    """
    span = calendar_span(dates)
    if span is not None:
        return facts.withColumn("date_sk", span.key(F.col(day)))
    lookup = broadcast_if_small(dates.select("full_date", "date_sk"))
    return code_lookup(facts, lookup, F.col(day), "full_date", "date_sk")


def outlet_lookup(facts: DataFrame, outlets: DataFrame) -> DataFrame:
    lookup = broadcast_if_small(outlets.select("outlet_id", "outlet_sk"))
    return code_lookup(facts, lookup, F.col("outlet_id"), "outlet_id", "outlet_sk")


def status_lookup(facts: DataFrame, statuses: DataFrame) -> DataFrame:
    """Add ``status_sk`` for the trimmed upper-case status. The dictionary has six rows."""
    return code_lookup(facts, F.broadcast(statuses), code(F.col("status")), "status_code", "status_sk")


def product_lookup(facts: DataFrame, products: DataFrame, day: str, overlap: str = "keep") -> DataFrame:
    """Add ``product_sk`` of the price version valid on ``day``."""
    return scd2_lookup(facts, products, "product_id", day, "product_sk", overlap)


def keyed_headers(transactions: DataFrame, dims: Dims, local_tz: str | None = None) -> DataFrame:
    """Consistent headers as three surrogate keys, the business date and the typed total."""
    headers = transactions_clean(transactions).withColumn(
        "_day", business_date(F.col("tanggal_waktu"), local_tz)
    )
    headers = date_lookup(headers, dims.date, "_day")
    headers = outlet_lookup(headers, dims.outlet)
    headers = status_lookup(headers, dims.status)
    total = to_money(F.col("total_bayar")).alias("total_bayar_trx")
    return headers.select(HEADER_KEY, "_day", "date_sk", "outlet_sk", "status_sk", total)


def fact_transaksi_item(
    raw: RawSales, dims: Dims, local_tz: str | None = None, overlap: str = "keep"
) -> DataFrame:
    """One row per line of a consistent header, with four surrogate keys and typed measures.

    Days, outlets and statuses are looked up on the headers, of which there are
    fewer; the keyed headers are stored. Lines meet them as ``lines_of_headers``
    says: equal lines are dropped and joined in one shuffle.
    """
    headers = materialize(keyed_headers(raw.transactions, dims, local_tz), "headers")
    lines = lines_of_headers(raw.items, headers)
    lines = product_lookup(lines, dims.product, "_day", overlap)
    qty = to_int(F.col("qty"))
    price, discount = to_money(F.col("harga_satuan")), to_money(F.col("diskon"))
    measures = {
        "qty": qty,
        "harga_satuan_aktual": price,
        "diskon": discount,
        "subtotal_rupiah": (qty * price - discount).cast(AMOUNT),
        "total_bayar_trx": F.col("total_bayar_trx"),
    }
    return lines.select(
        "date_sk",
        "product_sk",
        "outlet_sk",
        "status_sk",
        HEADER_KEY,
        "item_id",
        *(c.alias(name, metadata={"additivity": ADDITIVITY[name]}) for name, c in measures.items()),
    )


def grain_guard(fact: DataFrame, statuses: DataFrame, status: str = "PAID") -> DataFrame:
    """Header ids of one status that hold an item id more than once, with both counts."""
    wanted = F.broadcast(statuses.where(F.col("status_code") == status).select("status_sk"))
    per_header = (
        fact.join(wanted, "status_sk")
        .groupBy(HEADER_KEY)
        .agg(F.count_distinct(F.col("item_id")).alias("item_unik"), F.count("item_id").alias("baris_item"))
    )
    return per_header.where(F.col("item_unik") != F.col("baris_item"))
