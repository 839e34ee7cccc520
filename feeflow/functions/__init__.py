from feeflow.functions.scalar import (  # noqa: F401
    PUBLISHED_RATE_DIGITS,
    SATOSHI_PER_COIN,
    WATERMARK_DELAY,
    WINDOW_DURATION,
    cents_of,
    coins_text,
    discounted_cents_of,
    epoch_to_instant,
    epoch_to_ntz,
    fee,
    fee_rate,
    half_up_div,
    instant_to_ntz,
    ntz_to_epoch_seconds,
    ntz_to_instant,
    rate_cents,
    to_coins,
)
