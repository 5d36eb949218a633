"""Fixed values and settings of a market: reference tokens, expiry, epochs."""

from __future__ import annotations

from dataclasses import dataclass

# Wrapped base coin and USD coin contracts, blocks per epoch, blocks a
# quote or a previous swap stays usable, first full epoch with a base fee.
BASE_TOKEN = "0xC02aaA39b223FE8D0A0e5C4F27eAD9083C756Cc2"
USD_TOKEN = "0xA0b86991c6218b36c1d19D4a2e9Eb0cE3606eB48"
EPOCH_LENGTH = 30_000
BLOCK_EXPIRY = 10_000
FIRST_BASE_FEE_EPOCH = 433


@dataclass(frozen=True)
class Market:
    base_token: str = BASE_TOKEN
    usd_token: str = USD_TOKEN
    epoch_length: int = EPOCH_LENGTH
    block_expiry: int = BLOCK_EXPIRY
    first_base_fee_epoch: int = FIRST_BASE_FEE_EPOCH
