"""Property test: the distributed label parser equals the plain-Python rules on random texts."""

import itertools
import os
import tempfile

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from starloom.sources.labels import parse_label_section, read_label_lines

from .test_labels import brute_force

SECTION = "i94sect"
_counter = itertools.count()

token = st.sampled_from(["A", "b", "7", "42", " ", "\t", "=", "'", "x y", "Z9", ";", "  ", "=="])
line = st.lists(token, max_size=6).map("".join)
newline = st.sampled_from(["\n", "\r\n", "\r"])


@st.composite
def label_texts(draw):
    lines = draw(st.lists(line, min_size=1, max_size=12))
    if draw(st.booleans()):
        at = draw(st.integers(0, len(lines)))
        lines.insert(at, draw(st.sampled_from([f"value {SECTION}", f"\tvalue {SECTION} ", f"x{SECTION}y"])))
    nl = draw(newline)
    return nl.join(lines) + draw(st.sampled_from(["", nl]))


def expected(text):
    try:
        return brute_force(text, SECTION)
    except ValueError:
        return ValueError


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(label_texts())
def test_parser_matches_rules(spark, text):
    d = tempfile.mkdtemp(prefix="labels-prop-")
    path = os.path.join(d, f"l{next(_counter)}.sas")
    with open(path, "w", newline="") as f:
        f.write(text)
    want = expected(text)
    try:
        got = {r["code"]: r["label"] for r in parse_label_section(read_label_lines(spark, path), SECTION).collect()}
    except ValueError:
        got = ValueError
    assert got == want, repr(text)
