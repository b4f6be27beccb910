"""Coin markets: typed staging with exact decimals."""

from __future__ import annotations

from pyspark.sql import DataFrame

from recordmill.functions.variants import Field
from recordmill.operators import data_tests
from recordmill.operators.staging import stage

PRICE = "decimal(38,8)"
AMOUNT = "decimal(38,2)"

# Source name, columns, JSON paths and types of the records.
SOURCE = "coingecko_top_coins"
FIELDS = [
    Field("coin_id", "id"),
    Field("symbol", "symbol"),
    Field("coin_name", "name"),
    Field("current_price_usd", "current_price", PRICE),
    Field("market_cap_usd", "market_cap", AMOUNT),
    Field("market_cap_rank", "market_cap_rank", "int"),
    Field("fdv_usd", "fully_diluted_valuation", AMOUNT),
    Field("total_volume_usd", "total_volume", AMOUNT),
    Field("high_24h_usd", "high_24h", PRICE),
    Field("low_24h_usd", "low_24h", PRICE),
    Field("price_change_24h_usd", "price_change_24h", PRICE),
    Field("price_change_pct_24h", "price_change_percentage_24h", PRICE),
    Field("circulating_supply", "circulating_supply", AMOUNT),
    Field("total_supply", "total_supply", AMOUNT),
    Field("max_supply", "max_supply", AMOUNT),
    Field("ath_usd", "ath", PRICE),
    Field("ath_at", "ath_date", "timestamp"),
    Field("coin_updated_at", "last_updated", "timestamp"),
]


def staged(landing: DataFrame) -> DataFrame:
    return stage(landing, SOURCE, FIELDS)


def staging_rules() -> data_tests.Rules:
    return data_tests.rules(
        ["coin_id", "symbol", "load_id", "ingested_at"], {"current_price_usd": 0, "market_cap_rank": 1}
    )
