"""The batch tables as clean transactions and served entities."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwatch.operators import cleaning, serving
from tillwatch.plans.flows import latest_entities
from tillwatch.sources import tables


@dataclass(frozen=True)
class Dataset:
    spark: SparkSession
    directory: str

    def users(self, columns: Sequence[str] | None = None) -> DataFrame:
        whole = columns is None
        raw = tables.raw_users(self.spark, self.directory, region_names=whole or "state" in columns)
        with_city = whole or not set(columns).isdisjoint(serving.CITY_COLUMNS)
        serve = serving.serve_users if with_city else serving.serve_users_without_city
        return latest_entities(serve(cleaning.clean_users(raw)), "party_id", columns)

    def cards(self, columns: Sequence[str] | None = None) -> DataFrame:
        clean = cleaning.clean_cards(tables.raw_cards(self.spark, self.directory))
        return latest_entities(serving.serve_cards(clean), "card_ref", columns)

    def merchants(self, columns: Sequence[str] | None = None) -> DataFrame:
        clean = cleaning.clean_merchants(tables.raw_merchants(self.spark, self.directory))
        return latest_entities(serving.serve_merchants(clean), "merchant_id", columns)

    def card_versions(self) -> DataFrame:
        return cleaning.clean_cards(tables.raw_card_versions(self.spark, self.directory))

    def event_txns(self) -> DataFrame:
        return cleaning.clean_transactions(tables.raw_event_txns(self.spark, self.directory))

    def line_txns(self) -> DataFrame:
        return cleaning.clean_transactions(tables.raw_line_txns(self.spark, self.directory))

    def lines(self) -> DataFrame:
        """``line_txns`` before their card is known, clean; ``line_lookups`` has what leads to it."""
        return cleaning.clean_transactions(tables.raw_lines(self.spark, self.directory))

    def line_lookups(self) -> dict[str, object]:
        """How the lookups get the card of ``lines``, and where to look for hot keys: cards among the orders."""
        orders = tables.order_cards(self.spark, self.directory)
        keys = {"card_ref": orders.select("card_ref"), "merchant_ref": self._line_merchants()}
        return {"through": orders, "skew_from": keys}

    def _line_merchants(self) -> DataFrame:
        lines = tables.read_table(self.spark, self.directory, "lineitem")
        return lines.select(F.col("l_suppkey").cast("string").alias("merchant_ref"))

    def line_keys(self) -> dict[str, DataFrame]:
        """The keys of ``line_txns``, a row for each line, to find hot ones in without the cleaning."""
        return {
            "card_ref": tables.raw_line_txns(self.spark, self.directory).select("card_ref"),
            "merchant_ref": self._line_merchants(),
        }

    def entities(self, columns: Mapping[str, Sequence[str]] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Cards, users, merchants, with all columns or with the given ones."""
        wanted = columns or {}
        return self.cards(wanted.get("cards")), self.users(wanted.get("users")), self.merchants(wanted.get("merchants"))
