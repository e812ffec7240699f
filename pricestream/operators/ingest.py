"""Decode, validate and filter: operators 8-13 and 15.

All of it is projection and filtering inside one stage (no shuffle), except the
catalog semi join of ``catalog_updates``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricestream import constants as K
from pricestream.functions import exprs as X

# Standard JSON only: no single quotes, NaN/Infinity literals or leading zeros.
STRICT_JSON = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false",
               "allowNumericLeadingZeros": "false", "allowUnquotedFieldNames": "false",
               "allowBackslashEscapingAnyCharacter": "false", "allowComments": "false"}

_STRING_TYPES = r"^(STRING|VOID)$"
_INT_TYPES = r"^(BIGINT|INT|SMALLINT|TINYINT|VOID)$"
_NUM_TYPES = r"^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL\(\d+,\d+\)|DOUBLE|FLOAT|VOID)$"


def _typed(field: Column, pattern: str) -> Column:
    """True when a variant field is absent, JSON null, or of an allowed JSON type."""
    return field.isNull() | F.schema_of_variant(field).rlike(pattern)


def select_where(df: DataFrame, columns: list[Column], keep) -> DataFrame:
    """Project ``columns`` and keep the rows where ``keep(row)`` holds, computing
    every column once per row.

    A plain ``select(...).where(...)`` on a computed column is rewritten by the
    optimizer into a filter below the projection that evaluates the expression a
    second time; for JSON decoding that doubles the parse. Filtering the one-row
    array of the projected struct keeps a single evaluation.
    """
    return df.select(F.inline(F.filter(F.array(F.struct(*columns)), keep)))


def own_case(text: Column, names) -> Column:
    """JSON text with the keys ``names`` in their own case, whatever case they have.

    An unescaped quoted name before a colon is a key wherever it stands. Texts without a
    key in another case (almost all) are left as they are after one search."""
    any_name = "|".join(names)
    exact = "|".join(f'{n}"' for n in names)
    own = text
    for n in names:
        own = F.regexp_replace(own, rf'(?<!\\)"(?i:{n})"(\s*:)', f'"{n}"$1')
    return F.when(text.rlike(rf'"(?!{exact})(?i:{any_name})"\s*:'), own).otherwise(text)


def parse_json(raw: DataFrame, value: str, fields: dict[str, str], keep: tuple[str, ...]) -> DataFrame:
    """One strict parse per row into ``__arr`` (the text wrapped in ``[...]`` so
    any trailing token fails the parse; every field read as VARIANT so its JSON
    type can be checked). Keys are read in any case; of equal keys the last counts. ``__v``
    keeps the text."""
    schema = "array<struct<%s>>" % ", ".join(f"`{n}`: variant" for n in fields)
    v = own_case(F.col(value), list(fields))
    return raw.select(*keep, v.alias("__v"),
                      F.from_json(F.concat(F.lit("["), v, F.lit("]")), schema, STRICT_JSON).alias("__arr"))


def json_fields(fields: dict[str, str]) -> tuple[Column, dict[str, Column]]:
    """(ok, values) over the columns of ``parse_json``.

    ``ok`` is false for malformed text, trailing text, a non-object root, or a
    field of the wrong JSON type; missing or null fields take the zero value
    ('' / 0 / 0.0); unknown fields are ignored. A JSON ``null`` document decodes
    to the zero value of every field.
    """
    arr, value = F.col("__arr"), F.col("__v")
    s = F.get(arr, 0)
    ok = (F.size(arr) == 1) & s.isNotNull() & value.rlike(r"\}\s*\z")
    values: dict[str, Column] = {}
    for name, typ in fields.items():
        f = s.getField(name)
        if typ == "string":
            ok = ok & _typed(f, _STRING_TYPES)
            values[name] = F.coalesce(F.try_variant_get(f, "$", "string"), F.lit(""))
        elif typ == "bigint":
            ok = ok & _typed(f, _INT_TYPES)
            values[name] = F.coalesce(F.try_variant_get(f, "$", "bigint"), F.lit(0).cast("bigint"))
        else:
            d = F.try_variant_get(f, "$", "double")
            ok = ok & _typed(f, _NUM_TYPES) & (d.isNull() | ~F.isnan(d) & (F.abs(d) < F.lit(float("inf"))))
            values[name] = F.coalesce(d, F.lit(0.0))
    null_doc = F.coalesce(value.rlike(r"\A[ \t\r\n]*null[ \t\r\n]*\z"), F.lit(False))
    zero = {"string": F.lit(""), "bigint": F.lit(0).cast("bigint"), "double": F.lit(0.0)}
    values = {n: F.when(null_doc, zero[t]).otherwise(c) for (n, c), t in zip(values.items(), fields.values())}
    return F.coalesce(null_doc | ok, F.lit(False)), values


EVENT_FIELDS = {"event_type": "string", "product_id": "string", "user_id": "string",
                "timestamp": "bigint", "price": "double"}
UPDATE_FIELDS = {"product_id": "string", "new_price": "double", "timestamp": "bigint"}


def decode_events(raw: DataFrame, value: str = "value", keep: tuple[str, ...] = ("event_seq", "arrival_ts")) -> DataFrame:
    """Operator 8 with the decode flag: keep columns + decoded fields + ``decoded``."""
    ok, vals = json_fields(EVENT_FIELDS)
    return parse_json(raw, value, EVENT_FIELDS, keep).select(
        *keep, *(c.alias(n) for n, c in vals.items()), ok.alias("decoded"))


def decode_product_events(raw: DataFrame, value: str = "value",
                          keep: tuple[str, ...] = ("event_seq", "arrival_ts")) -> DataFrame:
    """Operator 8: successfully decoded events only."""
    dec = decode_events(raw, value, keep)
    return select_where(dec, [F.col(c) for c in dec.columns], lambda r: r["decoded"]).drop("decoded")


def valid_decoded_events(raw: DataFrame, value: str = "value",
                         keep: tuple[str, ...] = ("event_seq", "arrival_ts")) -> DataFrame:
    """Operators 8 + 9: decoded events that pass validation (one parse per row)."""
    dec = decode_events(raw, value, keep)
    cols = [F.col(c) for c in dec.columns if c != "decoded"]
    return select_where(dec, [*cols, (F.col("decoded") & valid_predicate()).alias("__ok")],
                        lambda r: F.coalesce(r["__ok"], F.lit(False))).drop("__ok")


def reject_reason(event_type="event_type", product_id="product_id", price="price",
                  decoded: Column | None = None) -> Column:
    """First failing rule in order decode -> event_type -> product_id -> price; null = valid."""
    et, pid, pr = (F.col(c) if isinstance(c, str) else c for c in (event_type, product_id, price))
    r = F.when(et.isNull() | ~et.isin(*K.EVENT_WEIGHTS), F.lit(K.REASON_EVENT_TYPE)) \
         .when(X.is_blank(pid), F.lit(K.REASON_PRODUCT_ID)) \
         .when(F.coalesce(pr, F.lit(0.0)) <= 0, F.lit(K.REASON_PRICE))
    if decoded is not None:
        r = F.when(~decoded, F.lit(K.REASON_DECODE)).otherwise(r)
    return r


def valid_predicate(event_type="event_type", product_id="product_id", price="price") -> Column:
    """Operator 9 as a predicate; deterministic, so it pushes into the Parquet scan."""
    et, pid, pr = (F.col(c) if isinstance(c, str) else c for c in (event_type, product_id, price))
    # ``price > 0`` without coalesce: a null price compares to null, which WHERE
    # drops, and the bare comparison is pushed into the Parquet scan.
    return et.isin(*K.EVENT_WEIGHTS) & ~X.is_blank(pid) & (pr > 0)


def valid_product_events(events: DataFrame) -> DataFrame:
    """Operator 9: events with a known type, a non-blank id and price > 0."""
    return events.where(valid_predicate())


def rejected_product_events(decoded_events: DataFrame) -> DataFrame:
    """Operator 10: event_seq + reason of every event failing decode or validation."""
    r = reject_reason(decoded=F.col("decoded"))
    return select_where(decoded_events, [F.col("event_seq"), r.alias("reason")],
                        lambda x: x["reason"].isNotNull())


def parse_price_updates(raw: DataFrame, value: str = "value", keep: tuple[str, ...] = ("event_seq",)) -> DataFrame:
    """Operator 12: decode update JSON, require non-blank trimmed id, new_price > 0,
    timestamp > 0; emit the trimmed id tagged ``price_update``."""
    ok, v = json_fields(UPDATE_FIELDS)
    pid = X.trim_unicode(v["product_id"])
    cols = [*map(F.col, keep), F.lit(K.PRICE_UPDATE_TYPE).alias("type"), pid.alias("product_id"),
            v["new_price"].alias("new_price"), v["timestamp"].alias("timestamp"), ok.alias("__ok")]
    return select_where(parse_json(raw, value, UPDATE_FIELDS, keep), cols,
                        lambda r: r["__ok"] & (r["product_id"] != "") & (r["new_price"] > 0)
                        & (r["timestamp"] > 0)).drop("__ok")


def valid_override_commands(commands: DataFrame) -> DataFrame:
    """Operator 13 over a command log (cmd_seq, cmd_ts, product_id, op, override_price, reason).

    set: id trimmed then pattern-checked, override_price > 0, reason defaulted;
    remove: the raw id must match the pattern (it is a path parameter, not trimmed).
    Output keeps the log columns with the normalised id and reason (and ``gate_ms``, if
    the log has it).
    """
    more = [c for c in ("gate_ms",) if c in commands.columns]
    tid = X.trim_unicode(F.col("product_id"))
    is_set = F.col("op") == K.OP_SET
    is_remove = F.col("op") == K.OP_REMOVE
    ok = ((is_set & X.valid_product_id(tid) & (F.coalesce(F.col("override_price"), F.lit(0.0)) > 0))
          | (is_remove & X.valid_product_id(F.col("product_id"))))
    return (commands.where(ok)
                    .select("cmd_seq", "cmd_ts",
                            F.when(is_set, tid).otherwise(F.col("product_id")).alias("product_id"),
                            "op",
                            F.when(is_set, F.col("override_price")).alias("override_price"),
                            F.when(is_set, X.default_override_reason(F.col("reason"))).alias("reason"), *more))


OVERRIDE_REQUEST_KEYS = ("product_id", "override_price", "reason")


def decode_override_requests(raw: DataFrame, value: str = "value", keep: tuple[str, ...] = ("cmd_seq", "cmd_ts")) -> DataFrame:
    """JSON override bodies -> set commands; unknown fields or trailing data reject
    the body (strict decoder), as do the operator-13 value rules later."""
    fields = {"product_id": "string", "override_price": "double", "reason": "string"}
    ok, v = json_fields(fields)
    keys = F.json_object_keys(F.col("__v"))
    # keys are null for a ``null`` body (accepted as the zero request, then refused
    # by the id check) and for non-objects (already refused by the parse check)
    no_unknown = F.coalesce(F.size(F.array_except(keys, F.array(*map(F.lit, OVERRIDE_REQUEST_KEYS)))) == 0,
                            F.lit(True))
    cols = [*map(F.col, keep), v["product_id"].alias("product_id"), F.lit(K.OP_SET).alias("op"),
            v["override_price"].alias("override_price"), v["reason"].alias("reason"),
            (ok & no_unknown).alias("__ok")]
    return select_where(parse_json(raw, value, fields, keep), cols, lambda r: r["__ok"]).drop("__ok")


def catalog_updates(tagged_updates: DataFrame, catalog: DataFrame) -> DataFrame:
    """Operator 15: tagged, well-typed updates whose id is a catalog product.

    The catalog side of the semi join is left to Catalyst/AQE: it is broadcast
    only when its measured size is under the broadcast threshold.
    """
    good = tagged_updates.where((F.col("type") == K.PRICE_UPDATE_TYPE)
                                & ~X.is_blank(F.col("product_id"))
                                & F.col("new_price").isNotNull() & F.col("timestamp").isNotNull())
    return good.join(catalog.select("product_id"), "product_id", "left_semi")
