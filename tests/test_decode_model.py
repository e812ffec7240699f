"""Brute force: the strict event decoder against a model of the standard decoder.

The model follows the documented behaviour of the reference's decoder: the
text must hold exactly one JSON value (white space around it allowed); a JSON
``null`` gives the zero event; otherwise it must be an object; string fields
take strings or null; the integer field takes integral numbers within 64 bits;
the float field takes any finite number; a wrong type fails the whole decode;
unknown keys are ignored; missing or null fields keep their zero value.
Key matching is exact here (the case-insensitive match is a documented
divergence), so generated keys never differ only in case.
"""

import json
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pricestream.operators import ingest

FIELDS = {"event_type": "string", "product_id": "string", "user_id": "string",
          "timestamp": "bigint", "price": "double"}
ZERO = {"string": "", "bigint": 0, "double": 0.0}


def _reject_constant(name):
    raise ValueError(name)


def model(text):
    """(decoded, values) for one text."""
    try:
        doc = json.loads(text, parse_constant=_reject_constant)
    except (ValueError, RecursionError):
        return False, None
    if doc is None:
        return True, dict((k, ZERO[t]) for k, t in FIELDS.items())
    if not isinstance(doc, dict):
        return False, None
    out = {}
    for k, t in FIELDS.items():
        v = doc.get(k)
        if v is None:
            out[k] = ZERO[t]
        elif t == "string":
            if not isinstance(v, str):
                return False, None
            out[k] = v
        elif t == "bigint":
            if isinstance(v, bool) or not isinstance(v, int) or not -2**63 <= v < 2**63:
                return False, None
            out[k] = v
        else:
            if isinstance(v, bool) or not isinstance(v, (int, float)) or not math.isfinite(float(v)):
                return False, None
            out[k] = float(v)
    return True, out


values = st.one_of(
    st.none(), st.booleans(), st.integers(-2**70, 2**70), st.sampled_from([0, -1, 7, 2**63 - 1, -2**63, 2**63]),
    st.floats(allow_nan=False, allow_infinity=False, width=64), st.sampled_from([1.5, -0.0, 1e300, 2.5e-8]),
    st.text(max_size=6), st.sampled_from(["view", "cart", " PA ", "", "　"]),
    st.lists(st.integers(0, 3), max_size=2))
typed = st.fixed_dictionaries(
    {}, optional={"event_type": st.sampled_from(["view", "cart", "purchase", "click"]),
                  "product_id": st.text(max_size=5), "user_id": st.one_of(st.none(), st.text(max_size=3)),
                  "timestamp": st.integers(-2**64, 2**64),
                  "price": st.one_of(st.floats(allow_nan=False, allow_infinity=False, width=64),
                                     st.integers(-10**25, 10**25)),
                  "extra": values})
docs = st.one_of(st.dictionaries(st.sampled_from([*FIELDS, "extra", "note"]), values, max_size=6), typed)


@st.composite
def texts(draw):
    d = draw(docs)
    s = json.dumps(d, ensure_ascii=draw(st.booleans()))
    mutation = draw(st.sampled_from(["none", "none", "none", "truncate", "trail", "array", "null",
                                     "space", "bigexp"]))
    if mutation == "truncate" and len(s) > 1:
        s = s[: draw(st.integers(1, len(s) - 1))]
    elif mutation == "trail":
        s = s + draw(st.sampled_from([" x", "{}", "]", " ", "\n", ",1"]))
    elif mutation == "array":
        s = "[" + s + "]"
    elif mutation == "null":
        s = draw(st.sampled_from(["null", " null ", "nul", "NULL"]))
    elif mutation == "space":
        s = " \t" + s + "\r\n"
    elif mutation == "bigexp":
        s = s.replace("}", ', "price": 1e400}', 1) if s.endswith("}") and len(s) > 2 else s
    return s


@settings(max_examples=40, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(texts(), min_size=1, max_size=40))
def test_decoder_equals_model(spark, batch):
    df = spark.createDataFrame(list(enumerate(batch)), "event_seq bigint, value string")
    got = {r.event_seq: r for r in ingest.decode_events(df, keep=("event_seq",)).collect()}
    for i, text in enumerate(batch):
        ok, vals = model(text)
        r = got[i]
        assert r.decoded == ok, text
        if ok:
            for k in FIELDS:
                v = getattr(r, k)
                if FIELDS[k] == "double":
                    assert v == vals[k] or math.isclose(v, vals[k], rel_tol=1e-15), (text, k, v, vals[k])
                else:
                    assert v == vals[k], (text, k, v, vals[k])


REQ_FIELDS = {"product_id": "string", "override_price": "double", "reason": "string"}
req_docs = st.one_of(
    st.dictionaries(st.sampled_from([*REQ_FIELDS, "extra"]), values, max_size=4),
    st.fixed_dictionaries({}, optional={"product_id": st.sampled_from(["PA", " PB ", "P$", ""]),
                                        "override_price": st.one_of(st.floats(allow_nan=False, width=64),
                                                                    st.integers(-5, 10**20)),
                                        "reason": st.one_of(st.none(), st.text(max_size=4))}))


@st.composite
def req_texts(draw):
    s = json.dumps(draw(req_docs))
    m = draw(st.sampled_from(["none", "none", "trail", "truncate", "null"]))
    if m == "trail":
        s += draw(st.sampled_from([" {}", " x", "\n"]))
    elif m == "truncate" and len(s) > 1:
        s = s[:-1]
    elif m == "null":
        s = "null"
    return s


def model_request(text):
    """Request bodies: one JSON value, unknown keys rejected, typed fields."""
    try:
        doc = json.loads(text, parse_constant=_reject_constant)
    except ValueError:
        return False, None
    if doc is None:
        return True, {"product_id": "", "override_price": 0.0, "reason": ""}
    if not isinstance(doc, dict) or set(doc) - set(REQ_FIELDS):
        return False, None
    out = {}
    for k, t in REQ_FIELDS.items():
        v = doc.get(k)
        if v is None:
            out[k] = ZERO[t]
        elif t == "string":
            if not isinstance(v, str):
                return False, None
            out[k] = v
        else:
            if isinstance(v, bool) or not isinstance(v, (int, float)) or not math.isfinite(float(v)):
                return False, None
            out[k] = float(v)
    return True, out


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(req_texts(), min_size=1, max_size=40))
def test_request_decoder_equals_model(spark, batch):
    import datetime as dt
    rows = [(i, dt.datetime(2024, 1, 1), t) for i, t in enumerate(batch)]
    df = spark.createDataFrame(rows, "cmd_seq bigint, cmd_ts timestamp, value string")
    got = {r.cmd_seq: r for r in ingest.decode_override_requests(df).collect()}
    for i, text in enumerate(batch):
        ok, vals = model_request(text)
        assert (i in got) == ok, text
        if ok:
            r = got[i]
            assert (r.product_id, r.reason) == (vals["product_id"], vals["reason"]), text
            assert r.override_price == vals["override_price"] or \
                math.isclose(r.override_price, vals["override_price"], rel_tol=1e-15), text


UPD_FIELDS = {"product_id": "string", "new_price": "double", "timestamp": "bigint"}
WHITE = "\t\n\x0b\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
upd_docs = st.fixed_dictionaries({}, optional={
    "product_id": st.one_of(st.sampled_from(["PA", " PB\t", "\u3000PC\u00a0", "\u2028", "", "P 1"]),
                            st.integers(0, 3)),
    "new_price": st.one_of(st.sampled_from([0, -1.5, 12.25, 1e-9]), st.floats(allow_nan=False, width=64)),
    "timestamp": st.one_of(st.sampled_from([0, -1, 1700000000, 2**63]), st.floats(width=32, allow_nan=False)),
    "type": st.just("x")})


@st.composite
def upd_texts(draw):
    s = json.dumps(draw(upd_docs), ensure_ascii=draw(st.booleans()))
    if draw(st.integers(0, 5)) == 0:
        s = s[:-1]
    return s


def model_update(text):
    try:
        doc = json.loads(text, parse_constant=_reject_constant)
    except ValueError:
        return None
    if doc is None:
        doc = {}
    if not isinstance(doc, dict):
        return None
    pid, price, ts = doc.get("product_id"), doc.get("new_price"), doc.get("timestamp")
    if pid is not None and not isinstance(pid, str):
        return None
    if price is not None and (isinstance(price, bool) or not isinstance(price, (int, float))
                              or not math.isfinite(float(price))):
        return None
    if ts is not None and (isinstance(ts, bool) or not isinstance(ts, int) or not -2**63 <= ts < 2**63):
        return None
    pid = (pid or "").strip(WHITE)
    if pid == "" or not float(price or 0) > 0 or not (ts or 0) > 0:
        return None
    return pid, float(price), ts


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(upd_texts(), min_size=1, max_size=40))
def test_update_parser_equals_model(spark, batch):
    df = spark.createDataFrame(list(enumerate(batch)), "event_seq bigint, value string")
    got = {r.event_seq: (r.product_id, r.new_price, r.timestamp) for r in ingest.parse_price_updates(df).collect()}
    for i, text in enumerate(batch):
        want = model_update(text)
        assert got.get(i) == want, text
