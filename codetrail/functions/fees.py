"""Network fee in gas-token units and the gas-token -> priced-token address map."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from codetrail.functions.trailer import binary_lit

# Fee-currency adapters and the tokens they are priced as (hex, case-insensitive).
USDC_ADAPTER = "2f25deb3848c207fc8e0c34035b3ba7fc157602b"
USDC_TOKEN = "cebA9300f2b948710d2653dD7B07f33A8B32118C"
USDT_ADAPTER = "0e2a3e05bc9a16f5292a6170456a710cb89c6f72"
USDT_TOKEN = "48065fbBE25f71C9282ddf5e1cD6D6A887483D5e"
NATIVE_TOKEN = "471EcE3750Da237f93B8E339c536989b8978a438"
ZERO_ADDRESS = "0000000000000000000000000000000000000000"

# (gas token, priced token) pairs; first match wins, anything else prices itself.
FEE_TOKEN_MAP = [
    (USDC_ADAPTER, USDC_TOKEN),
    (USDT_ADAPTER, USDT_TOKEN),
]

WEI_PER_TOKEN = 1e18


def fee_token_amount(gas_used: str = "gas_used", gas_price: str = "gas_price") -> Column:
    """gas_used * gas_price / 1e18 in double, in this order of operations."""
    return F.col(gas_used).cast("double") * F.col(gas_price).cast("double") / F.lit(WEI_PER_TOKEN)


def price_address(fee_currency: str = "fee_currency", mapping=None, native: str = NATIVE_TOKEN) -> Column:
    """Map the gas token to the token whose price is used. NULL or zero address -> native."""
    fc = F.col(fee_currency)
    expr = None
    for src, dst in (FEE_TOKEN_MAP if mapping is None else mapping):
        cond = fc == binary_lit(src)
        expr = F.when(cond, binary_lit(dst)) if expr is None else expr.when(cond, binary_lit(dst))
    native_cond = fc.isNull() | (fc == binary_lit(ZERO_ADDRESS))
    expr = F.when(native_cond, binary_lit(native)) if expr is None else expr.when(native_cond, binary_lit(native))
    return expr.otherwise(fc)
