"""Property tests: the lenient casts and the wall-clock parser against plain
Python models of the legacy rules.  Each Hypothesis draw is a whole list of
inputs evaluated in one Spark job."""

import datetime as dt
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from transitlake.functions import lenient_int, lenient_long, parse_wallclock

INT_RE = re.compile(r"([+-]?)([0-9]*)(\.[0-9]*)?")


def legacy_int(text, bits=32):
    """The legacy text -> integer rule: trim chars <= ' ', optional sign,
    digits (possibly none), optional ignored fraction, at least one digit or
    dot after the sign; out of range -> None."""
    if text is None:
        return None
    core = text.strip("".join(chr(i) for i in range(33)))
    m = INT_RE.fullmatch(core)
    if not m or not (m.group(2) or m.group(3)):
        return None
    value = int(m.group(1) + (m.group(2) or "0"))
    lo, hi = -(2 ** (bits - 1)), 2 ** (bits - 1) - 1
    return value if lo <= value <= hi else None


def legacy_compact_time(text):
    if text is None or len(text) != 14 or not text.isascii() or not text.isdigit():
        return None
    try:
        return dt.datetime.strptime(text, "%Y%m%d%H%M%S")
    except ValueError:
        return None


number_text = st.one_of(
    st.none(),
    st.text(alphabet=" \t+-.0123456789eax", max_size=14),
    st.integers(-(2**40), 2**40).map(str),
    st.builds(lambda i, f: f"{i}.{f}", st.integers(-99999, 99999), st.integers(0, 999)),
)

compact_time = st.one_of(
    st.datetimes(dt.datetime(1900, 1, 1), dt.datetime(2100, 12, 31)).map(lambda d: d.strftime("%Y%m%d%H%M%S")),
    st.text(alphabet="0123456789", min_size=13, max_size=15),
    st.none(),
)

SETTINGS = settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(number_text, min_size=1, max_size=60))
def test_lenient_integers_follow_the_legacy_rule(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    rows = df.select("s", lenient_int("s").alias("i"), lenient_long("s").alias("l")).collect()
    for r in rows:
        assert r.i == legacy_int(r.s, 32), r.s
        assert r.l == legacy_int(r.s, 64), r.s


@SETTINGS
@given(st.lists(compact_time, min_size=1, max_size=60))
def test_compact_timestamps_parse_like_strptime(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    for r in df.select("s", parse_wallclock("s").alias("t")).collect():
        assert r.t == legacy_compact_time(r.s), r.s
