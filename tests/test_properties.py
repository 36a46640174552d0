"""Property tests: the lenient integer rule against a plain-Python statement of the same rule."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from starloom.functions.casts import lenient_int

_RULE = re.compile(r"^\s*([+-]?[0-9]+)([.][0-9]*)?\s*$")


def expected(s):
    if s is None:
        return None
    m = _RULE.match(s)
    if not m:
        return None
    v = int(m.group(1))
    return v if -2**31 <= v < 2**31 else None


texts = st.one_of(
    st.none(),
    st.from_regex(r"\A[ \t]{0,2}[+-]?[0-9]{1,12}(\.[0-9]{0,3})?[ \t]{0,2}\Z"),
    st.text(alphabet="0123456789.+-eE /DSN\t", max_size=8),
)


@settings(max_examples=1, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(texts, min_size=200, max_size=200))
def test_lenient_int_matches_rule(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [r[0] for r in df.select(lenient_int("x")).collect()]
    assert got == [expected(v) for v in values]


_MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october",
           "november", "december"]


@st.composite
def month_texts(draw):
    if draw(st.integers(0, 4)) == 0:
        return draw(st.text(alphabet="abcdefxyz ", max_size=6)), None
    m = draw(st.integers(1, 12))
    word = _MONTHS[m - 1] if draw(st.booleans()) else _MONTHS[m - 1][:3]
    cased = "".join(c.upper() if draw(st.booleans()) else c for c in word)
    return cased, m


@settings(max_examples=1, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(month_texts(), min_size=100, max_size=100))
def test_month_names_any_case(spark, pairs):
    from starloom.functions.text import month_name_to_int
    df = spark.createDataFrame([(t,) for t, _ in pairs], "m string")
    got = [r[0] for r in df.select(month_name_to_int("m")).collect()]
    # junk text that happens to spell a month (e.g. 'mar') is a month too
    exp = [m if m is not None else (next((i + 1 for i, n in enumerate(_MONTHS) if t.lower() in (n, n[:3])), None))
           for t, m in pairs]
    assert got == exp


@st.composite
def wide_tables(draw):
    cell = st.one_of(st.none(), st.sampled_from(["..", "", "1", "2.5", "-3", "10.25", "0"]))
    rows = draw(st.lists(st.tuples(st.sampled_from(["Chad", "Peru", None]), st.sampled_from(["s1", "s2", "s3", None]),
                                   cell, cell), min_size=1, max_size=15))
    return rows


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(wide_tables())
def test_unpivot_then_pivot_matches_rules(spark, rows):
    import numpy as np
    from starloom.operators.reshape import unpivot_then_pivot
    series = {"s1": "a", "s2": "b"}
    df = spark.createDataFrame([(n, n and n[:2], s, y1, y2) for n, s, y1, y2 in rows],
                               "`Country Name` string, code string, `Series Name` string, `2000` string, `2001` string")
    got = sorted(map(tuple, unpivot_then_pivot(df, ["Country Name", "code"], "Series Name", series, strict=False,
                                               id_aliases=["name", "code"]).collect()), key=repr)

    def num(t):
        try:
            return float(np.float32(float(t)))
        except (TypeError, ValueError):
            return None
    cells = {}
    for n, s, y1, y2 in rows:
        for year, t in ((2000, y1), (2001, y2)):
            key = (n, n and n[:2], year)
            cells.setdefault(key, {"a": [], "b": []})
            if s in series and num(t) is not None:
                cells[key][series[s]].append(num(t))
    exp = sorted({(k[0], k[1], k[2], sum(v["a"]) if v["a"] else None, sum(v["b"]) if v["b"] else None)
                  for k, v in cells.items()}, key=repr)
    assert got == exp
