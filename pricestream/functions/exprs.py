"""Scalar operators as Column expressions (JVM side, inside whole-stage codegen).

Every function takes and returns ``pyspark.sql.Column``; none runs Python per row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricestream import constants as K


#: constants.UNICODE_SPACE_CLASS for Python's ``re``, which has no category classes.
_SPACE = "[\t\n\x0b\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def trim_unicode(s) -> Column:
    """Strip Unicode white space at both ends (Spark ``trim`` strips only U+0020).

    Fast path: the replace runs only when the first or last character is white
    space (an anchored check); other texts pass through unchanged.
    """
    cls = K.UNICODE_SPACE_CLASS
    x = _c(s)
    padded = x.rlike(rf"\A{cls}|{cls}\z")
    return F.when(padded, F.regexp_replace(x, f"^{cls}+|{cls}+$", "")).otherwise(x)


def is_blank(s) -> Column:
    """True when the text is null or only white space (one anchored match)."""
    return F.coalesce(_c(s).rlike(rf"\A{K.UNICODE_SPACE_CLASS}*\z"), F.lit(True))


def valid_product_id(s) -> Column:
    """Whole-text match of the product id pattern; ``\\z`` so a final newline fails."""
    return F.coalesce(_c(s).rlike(rf"\A[{K.PRODUCT_ID_CHARS}]+\z"), F.lit(False))


def demand_weight(event_type) -> Column:
    """view -> 1, cart -> 3, purchase -> 5, anything else -> null (invalid)."""
    et = _c(event_type)
    expr = None
    for name, weight in K.EVENT_WEIGHTS.items():
        expr = (F.when(et == name, F.lit(weight)) if expr is None
                else expr.when(et == name, F.lit(weight)))
    return expr.cast("bigint")


def compute_price(event_price, demand) -> Column:
    """event_price + sqrt(demand) * 5 as IEEE double, unrounded."""
    return _c(event_price) + F.sqrt(_c(demand).cast("double")) * F.lit(K.PRICE_DEMAND_FACTOR)


def normalize_event_ms(ts) -> Column:
    """Values >= 1e12 are milliseconds already; smaller values are seconds.

    Seconds whose milliseconds leave the 64-bit range wrap around (two's complement), so
    that one absurd timestamp cannot fail a job."""
    t = F.coalesce(_c(ts).cast("bigint"), F.lit(0).cast("bigint"))
    half, full = F.lit("9223372036854775808").cast("decimal(38,0)"), F.lit("18446744073709551616").cast("decimal(38,0)")
    exact = t.cast("decimal(25,0)") * F.lit(1000)
    wrapped = (F.pmod(exact + half, full) - half).cast("bigint")
    return (F.when(t >= F.lit(K.MS_THRESHOLD), t)
            .when(t >= F.lit(-(2 ** 63) // 1000 + 1), t * F.lit(1000))
            .otherwise(wrapped))


def default_price_source(s) -> Column:
    """Null or blank source -> 'dynamic'; otherwise the trimmed source."""
    return F.coalesce(F.nullif(trim_unicode(s), F.lit("")), F.lit(K.DEFAULT_PRICE_SOURCE))


def default_override_reason(s) -> Column:
    """Null or blank reason -> 'manual override'; otherwise the trimmed reason."""
    return F.coalesce(F.nullif(trim_unicode(s), F.lit("")), F.lit(K.DEFAULT_OVERRIDE_REASON))


def history_limit(raw) -> Column:
    """Parse a history limit text: blank -> 50; signed integer -> clamped to 500;
    anything else, zero or negative -> null (rejected)."""
    t = trim_unicode(F.coalesce(_c(raw), F.lit("")))
    parsed = F.when(t.rlike(r"\A[+-]?[0-9]+\z"), t.try_cast("bigint"))
    return (F.when(t == F.lit(""), F.lit(K.DEFAULT_HISTORY_LIMIT).cast("bigint"))
            .when(parsed > 0, F.least(parsed, F.lit(K.MAX_HISTORY_LIMIT).cast("bigint"))))


def check_history_limit(raw: str | int | None) -> int:
    """Driver-side parameter check for the top-N operator (not per row)."""
    text = "" if raw is None else re.sub(rf"\A{_SPACE}+|{_SPACE}+\Z", "", str(raw))
    if text == "":
        return K.DEFAULT_HISTORY_LIMIT
    if not re.fullmatch(r"[+-]?[0-9]+", text):
        raise ValueError("invalid limit query parameter")
    value = int(text)
    if not -(2 ** 63) <= value < 2 ** 63:
        raise ValueError("invalid limit query parameter")
    if value <= 0:
        raise ValueError("limit must be greater than 0")
    return min(value, K.MAX_HISTORY_LIMIT)


def round_price_2dp(p) -> Column:
    """Two-decimal display price, floor(p*100 + 0.5)/100 (same IEEE steps in DuckDB)."""
    return F.floor(_c(p) * F.lit(100.0) + F.lit(0.5)).cast("double") / F.lit(100.0)


def base_seed_time(ts) -> Column:
    """One millisecond before the given timestamp."""
    return _c(ts) - F.expr("INTERVAL 1 MILLISECOND")


def update_timestamp_s(ts) -> Column:
    """Whole unix seconds of a timestamp (batch form of the update time)."""
    return F.unix_seconds(_c(ts).cast("timestamp"))


def epoch_ms(ts) -> Column:
    return F.unix_millis(_c(ts).cast("timestamp"))


def encode_price_update(product_id="product_id", new_price="new_price",
                        timestamp="timestamp") -> Column:
    """Row -> JSON text {product_id, new_price, timestamp}."""
    return F.to_json(F.struct(_c(product_id).alias("product_id"),
                              _c(new_price).alias("new_price"),
                              _c(timestamp).alias("timestamp")))
