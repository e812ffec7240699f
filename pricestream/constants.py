"""Values that must equal the reference behaviour for results to agree.

Fixed values (do not change; they define the pricing semantics):

- event types and their demand weights: view = 1, cart = 3, purchase = 5
- price formula: new_price = event_price + sqrt(demand) * 5
- a timestamp is milliseconds when >= 1,000,000,000,000, otherwise seconds
- product id pattern: one or more of A-Z a-z 0-9 _ -
- history limit: default 50, maximum 500
- blank override reason becomes "manual override"
- blank price source becomes "dynamic"
- price sources: base, dynamic, override
- price update tag: "price_update"
- reject reasons: decode_error, invalid_event_type, invalid_product_id, invalid_price
"""

from __future__ import annotations

# --- fixed values -----------------------------------------------------------
EVENT_WEIGHTS = {"view": 1, "cart": 3, "purchase": 5}
PRICE_DEMAND_FACTOR = 5.0
MS_THRESHOLD = 1_000_000_000_000
PRODUCT_ID_CHARS = "A-Za-z0-9_-"
DEFAULT_HISTORY_LIMIT = 50
MAX_HISTORY_LIMIT = 500
DEFAULT_OVERRIDE_REASON = "manual override"
DEFAULT_PRICE_SOURCE = "dynamic"
SOURCE_BASE = "base"
SOURCE_DYNAMIC = "dynamic"
SOURCE_OVERRIDE = "override"
PRICE_UPDATE_TYPE = "price_update"
OP_SET = "set"
OP_REMOVE = "remove"

REASON_DECODE = "decode_error"
REASON_EVENT_TYPE = "invalid_event_type"
REASON_PRODUCT_ID = "invalid_product_id"
REASON_PRICE = "invalid_price"
# ---------------------------------------------------------------------------

# Unicode white space as stripped by a "trim space" that follows the Unicode
# White_Space property: ASCII \t \n \v \f \r and space, U+0085, and every
# character of general category Z (which includes U+00A0, U+1680,
# U+2000-U+200A, U+2028, U+2029, U+202F, U+205F, U+3000).  Written as a Java
# regex character class; the same class is valid for RE2 (DuckDB).
UNICODE_SPACE_CLASS = r"[\t\n\x{0B}\f\r \x{85}\p{Z}]"

# Ordering rank of records that share one timestamp: seed rows first, then
# commands, then product events.
KIND_SEED = 0
KIND_COMMAND = 1
KIND_EVENT = 2

# Target of rows per cell in the ordered scans; see operators/scan.py.
DEFAULT_ROWS_PER_CELL = 500_000
