"""Cases in which an operator once did less than the whole job."""

import re

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from starloom.llm import chat_format, license_rules, license_scan, toxicity
from starloom.llm.registry import ORACLE, QUERIES

from .conftest import TABLES, duck, same
from .test_license_rules import brute


def sample_text(pattern: str, optional: bool) -> str:
    """A text that ``pattern`` (of license_scan) matches: first alternatives, with or without its optional groups."""
    p = re.sub(r"\.\{1,\d+\}", "its holder", pattern).replace("(?= )", "").replace("[cs]", "c" if optional else "s")
    group = re.compile(r"\(\?:([^()]*)\)(\??)")
    while group.search(p):
        p = group.sub(lambda m: m[1].split("|")[-1 if optional else 0] if optional or not m[2] else "", p)
    return re.sub(r"(.)\?", lambda m: m[1] if optional else "", p).strip()


def test_every_license_rule_fires(spark):
    want = []
    for _, keyword, gate, pattern, label, _ in license_rules.rules():
        for optional in (False, True):
            t = sample_text(pattern, optional)
            assert re.search(pattern, f" {t} ") and keyword in f" {t} " and gate in f" {t} ", pattern
            want.append((len(want), f"Made\tby: {t.title().replace(' ', ' -')}.", label))
    got = {r["i"]: r["scan"] for r in license_scan.scan(spark.createDataFrame(want, "i int, text string, label string")).collect()}
    # a longer or better rule may silence the one that the text was made from, and then only that
    missing = [(t, label, got[i]["labels"]) for i, t, label in want if got[i]["labels"] != brute(t)[0]]
    assert not missing
    assert sum(label in got[i]["labels"].split(",") for i, t, label in want) >= 0.95 * len(want)
    assert all(got[i]["score"] > 0 and got[i]["n_words"] == len(re.findall("[A-Za-z0-9]+", t)) for i, t, _ in want)


@pytest.mark.parametrize("start", ["<b>x", "</b>", "</t", "</turn>", "<", "x", "q", "xq", "\\<", "###<", ""])
def test_turn_texts_that_begin_like_the_end_marker(start):
    t = chat_format.MarkerTemplate()
    turns = [("user", start), ("assistant", start + "tail" + start), ("assistant", start)]
    got = chat_format.locate(t, turns)
    assert [t.unescape(got.text[a:b]) for a, b in got.contents] == [x for _, x in turns] and not got.rewrites
    for (_, (a, b)), (s, e) in zip(zip(turns, got.contents), got.spans):
        assert got.text[s:a].endswith(": ") and got.text[b:e] == "</turn>\n"


def test_chat_loss_of_markup(spark, edge_dir, tmp_path):
    texts = ["<b>x", "</b>", "</t", "</turn>y", "<", "<think>a</think>"]
    conv = [(i, k, r, x) for i, x in enumerate(texts) for k, r in enumerate(("user", "assistant"))]
    c, t, r, x = zip(*conv)
    pq.write_table(pa.table({"conv_id": pa.array(c, pa.int64()), "turn": pa.array(t, pa.int64()), "role": r, "text": x}),
                   tmp_path / "conversations.parquet")
    for name in TABLES:
        if name != "conversations":
            (tmp_path / f"{name}.parquet").symlink_to(f"{edge_dir}/{name}.parquet")
    got = [row.asDict() for row in QUERIES["op9_chat_format"](spark, str(tmp_path)).collect()]
    same(got, duck(str(tmp_path), ORACLE["op9_chat_format"]))


def test_toxicity_sample_with_long_texts(spark):
    """Texts longer than a class's bytes, and labels without a text, take no place from the others."""
    docs = [(i, f"Text {i}. " * (9000 if i % 7 == 0 else 1)) for i in range(60)]
    labels = [(i, i % 2) for i in range(60)] + [(1000 + i, i % 2) for i in range(400)]
    texts, toxic = toxicity.sample(spark.createDataFrame(docs, "doc_id long, text string"),
                                   spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True), 40, 20_000)
    assert toxic == [0] * 30 + [1] * 30
    whole = {t for _, t in docs}
    assert {t for i, t in docs if i % 7} <= set(texts)
    for y in (0, 1):
        mine = [x for x, z in zip(texts, toxic) if z == y]
        assert 10_000 < sum(len(x.encode()) for x in mine) <= 20_000
        assert all(x in whole or re.fullmatch(r"(\s?Text \d+\.)+\s?", x) for x in mine)


def test_longest_whole():
    assert toxicity.longest_whole([1, 2, 3], 6) == 3 and toxicity.longest_whole([100, 2, 3], 15) == 10
    assert toxicity.longest_whole([50, 50], 9) == 4 and toxicity.longest_whole([], 9) == 0
    assert toxicity.some_sentences("é" * 50, 9) == "é" * 4
