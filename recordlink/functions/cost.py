"""Token, price and retry arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlink import fixed_values as fv


def estimate_tokens(text: Column) -> Column:
    """One token per four characters, rounded down."""
    return F.floor(F.length(text) / 4).cast("bigint")


def price_maps(prices: list[tuple] = fv.MODEL_PRICES) -> tuple[Column, Column]:
    """Prices of input and output tokens by model, as literals; negative prices are refused."""
    bad = [m for m, i, o in prices if i < 0 or o < 0]
    if bad:
        raise ValueError(f"negative price for {bad}")

    def by_model(at: int) -> Column:
        return F.create_map(*[x for p in prices for x in (F.lit(p[0]), F.lit(p[at]).cast("decimal(18,6)"))])

    return by_model(1), by_model(2)


def token_cost(df: DataFrame, model: str, in_tokens: str, out_tokens: str, prices: list[tuple] = fv.MODEL_PRICES) -> DataFrame:
    """Add `cost_usd` (six decimals). A model without a price fails the job instead of costing nothing."""
    in_price, out_price = (F.try_element_at(m, F.col(model)) for m in price_maps(prices))
    usd = (F.col(in_tokens) * in_price + F.col(out_tokens) * out_price) / 1000000
    unknown = F.raise_error(F.concat(F.lit("unknown model: "), F.coalesce(F.col(model), F.lit("none")))).cast("double")
    return df.withColumn("cost_usd", F.when(in_price.isNull(), unknown).otherwise(F.round(usd, 6).cast("double")))


def retry_plan(
    df: DataFrame,
    attempts: str,
    as_of: str,
    base_s: int = 60,
    max_attempts: int = fv.MAX_ATTEMPTS,
    cap_s: int = fv.MAX_BACKOFF_SECONDS,
    terminal: str = "dead_letter",
) -> DataFrame:
    """Next status of a failed item and when it may run again (exponential back-off with a cap)."""
    a = F.coalesce(F.col(attempts), F.lit(0))
    done = a >= max_attempts
    exponent = F.least(F.greatest(a - 1, F.lit(0)), F.lit(30))
    delay = F.least(F.lit(base_s) * F.pow(F.lit(2), exponent), F.lit(cap_s)).cast("bigint")
    start = F.lit(as_of).cast("timestamp_ntz")
    return (
        df.withColumn("next_status", F.when(done, F.lit(terminal)).otherwise(F.lit("pending")))
        .withColumn("delay_s", F.when(~done, delay))
        .withColumn("available_at", F.when(~done, start + F.make_dt_interval(secs=delay)))
    )
