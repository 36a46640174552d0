"""The registered queries against SQL or brute force, on awkward tables and on empty ones."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from starloom.llm import jaccard_join, source_mix, substring_dedup
from starloom.llm.registry import ORACLE, QUERIES, _digests

from .conftest import LOW, duck, same

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows(spark, name, sf_dir):
    return [r.asDict() for r in QUERIES[name](spark, sf_dir).collect()]


def docs_of(sf_dir):
    return [(r["doc_id"], r["text"]) for r in duck(sf_dir, "SELECT doc_id, text FROM documents")]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, edge_dir, name):
    same(rows(spark, name, edge_dir), duck(edge_dir, ORACLE[name]))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty_dir, name):
    assert len(rows(spark, name, empty_dir)) == (1 if name.startswith("op9") else 0)


def jaccard_brute(docs, k, num, den):
    sets, root = [], list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, t in docs:
        w = WORD.findall((t or "").translate(LOW))
        sets.append(frozenset(zip(*[w[j:] for j in range(k)])) if len(w) >= k else frozenset([tuple(w)] if w else []))
    live = [i for i, s in enumerate(sets) if s and docs[i][0] is not None]
    for a, i in enumerate(live):
        for j in live[:a]:
            x = len(sets[i] & sets[j])
            if den * x >= num * (len(sets[i]) + len(sets[j]) - x):
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = defaultdict(list)
    for i in live:
        least[find(i)].append(docs[i][0])
    return [(d, len(sets[i]), min(least[find(i)]) if i in set(live) else d) for i, (d, _) in enumerate(docs)]


@pytest.mark.parametrize("k,num,den", [(3, 90, 100), (5, 4, 5), (1, 1, 2)])
def test_jaccard(spark, edge_dir, k, num, den):
    df = spark.read.parquet(f"{edge_dir}/documents.parquet")
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.link_components(df, k, num, den).collect()]
    assert sorted(got, key=repr) == sorted(jaccard_brute(docs_of(edge_dir), k, num, den), key=repr)


def test_jaccard_blocks(spark, edge_dir, monkeypatch):
    """Groups of several blocks find the same components."""
    monkeypatch.setattr(jaccard_join, "MEMBERS", 4)
    monkeypatch.setattr(jaccard_join, "VISITORS", 3)
    df = spark.read.parquet(f"{edge_dir}/documents.parquet")
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.link_components(df, 3, 3, 5).collect()]
    assert sorted(got, key=repr) == sorted(jaccard_brute(docs_of(edge_dir), 3, 3, 5), key=repr)


@pytest.mark.parametrize("width", [2, 5, 40])
def test_substring_widths(spark, edge_dir, width):
    df = spark.read.parquet(f"{edge_dir}/documents.parquet")
    got = substring_dedup.dedup(df, _digests, "doc_id long, n_words long, n_removed long, kept_sha256 string", width=width)
    docs, first = docs_of(edge_dir), {}
    words = [WORD.findall(t or "") for _, t in docs]
    for (d, _), w in zip(docs, words):
        for i in range(len(w) - width + 1 if d is not None else 0):
            g = tuple(w[i:i + width])
            first[g] = min(first.get(g, d), d)
    want = []
    for (d, _), w in zip(docs, words):
        gone = set()
        for i in range(len(w) - width + 1 if d is not None else 0):
            if first[tuple(w[i:i + width])] < d:
                gone.update(range(i, i + width))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        want.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_license_base(spark, edge_dir):
    phrases = ((("mit", "license"), "mit"), (("apache", "license"), "apache"), (("general", "public", "license"), "gpl"))
    want = Counter()
    for d, t in docs_of(edge_dir):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))
        at = [(i, lab) for i in range(len(w)) for p, lab in phrases if tuple(w[i:i + len(p)]) == p]
        want[(d, len(w), len(at), min(at)[0] if at else None, max(at)[0] if at else None, ",".join(sorted({x for _, x in at})))] += 1
    got = rows(spark, "op3_license_scan", edge_dir)
    assert Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got) == want
    for r in got:
        assert 0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert (r["score"] > 0) == bool(r["labels"])
    assert any("apache-2.0" in r["labels"].split(",") for r in got)  # the version's rule contains the bare name's


def test_language_model(spark, edge_dir):
    tokens = lambda t: [*WORD.findall((t or "").translate(LOW)), None]
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 10 == 0
    docs, c = docs_of(edge_dir), Counter()
    for d, t in docs:
        if not held(d):
            c.update(tokens(t))
    n, v = sum(c.values()), len(c)
    want = sorted((repr(d), held(d), len(tokens(t)), sum(c[x] > 0 for x in tokens(t)), n,
                   round(sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in tokens(t)), 5)) for d, t in docs)
    got = rows(spark, "op4_hmm_lm", edge_dir)
    assert sorted((repr(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5))
                  for r in got) == want
    assert all(r["score"] < 0 for r in got)


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    toxic = {r["doc_id"]: r["toxic"] for r in duck(sf, "SELECT * FROM labels")}
    got = [r for r in rows(spark, "op5_toxicity", sf) if r["held_out"] and r["doc_id"] in toxic]
    hit = Counter((toxic[r["doc_id"]], r["predicted"]) for r in got)
    assert hit[1, 1] >= 0.75 * (hit[1, 0] + hit[1, 1]) and hit[0, 1] <= 0.02 * (hit[0, 0] + hit[0, 1])


def test_toxicity_edge(spark, edge_dir):
    got = rows(spark, "op5_toxicity", edge_dir)
    assert len(got) == len(docs_of(edge_dir)) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in got)


def test_mix(spark, edge_dir):
    got = rows(spark, "op6_source_mix", edge_dir)
    assert sorted(map(repr, got)) == sorted(map(repr, rows(spark, "op6_source_mix", edge_dir)))
    src = {r["s"]: r["n"] for r in duck(edge_dir, r"""
        SELECT source AS s, sum(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))) AS n FROM documents GROUP BY 1""")}
    order = sorted(src, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, free, rest = {}, set(order), sum(src.values())
    while True:  # limits first, the excess shared again by weight
        level = rest / sum(weight[s] for s in free)
        full = {s for s in free if 3 * src[s] < level * weight[s]}
        if not full:
            target.update({s: level * weight[s] for s in free})
            break
        target.update({s: 3 * src[s] for s in full})
        rest -= sum(3 * src[s] for s in full)
        free -= full
    assert {round(r["target"], 6) for r in got} == {round(x, 6) for x in target.values()}
    taken, size = Counter(), Counter()
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        taken[r["target"]] += r["taken"]
        size[r["target"]] = max(size[r["target"]], r["size"])
    for t, x in taken.items():
        assert abs(t - x) <= 2 * size[t]


def test_flight_keeps_totals():
    import numpy as np
    rng = np.random.default_rng(1)
    size = rng.integers(1, 900, 400)
    p = source_mix.flight(np.full(400, 0.37), size, rng, land=False)
    assert ((p > 1e-9) & (p < 1 - 1e-9)).sum() <= 2
    assert abs(p.sum() - 148) < 1e-6 and abs((p * size).sum() - 0.37 * size.sum()) < 1e-3


def test_pipeline_edge_and_empty(spark, edge_dir, empty_dir):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    names = list(stages)
    first = stages[names[0]](spark, docs, edge_dir)
    kept = {(r["doc_id"], r["n_words"]) for r in rows(spark, "op7_quality_rules", edge_dir) if r["kept"]}
    assert {r["doc_id"] for r in first.collect()} == {d for d, _ in kept} and first.columns == docs.columns
    second = stages[names[1]](spark, docs, edge_dir)
    brute = {d for d, _, c in jaccard_brute(docs_of(edge_dir), 5, 4, 5) if d == c}
    assert {r["doc_id"] for r in second.collect()} == brute and second.columns == docs.columns
    third = stages[names[2]](spark, docs, edge_dir)
    assert set(third.columns) == set(docs.columns)
    cut = [r for r in third.collect() if r["doc_id"] is not None and r["text"]]
    seen: dict = {}
    for r in cut:
        assert r["n_chars"] == len(r["text"])
    for d, t in sorted(((r["doc_id"], r["text"]) for r in cut), key=lambda x: x[0]):
        w = WORD.findall(t)
        for i in range(len(w) - 39):
            assert seen.setdefault(tuple(w[i:i + 40]), d) == d
    fourth = stages[names[3]](spark, docs, edge_dir)
    leaked = {r["doc_id"] for r in rows(spark, "op8_decontaminate", edge_dir)}
    assert leaked and not leaked & {r["doc_id"] for r in fourth.collect()}
    assert fourth.count() == docs.count() - docs.filter(docs["doc_id"].isin([x for x in leaked if x is not None])).count()
    out = corpus_pipeline.run(spark, edge_dir).collect()
    assert out and all(r["mix_taken"] > 0 for r in out)
    assert corpus_pipeline.run(spark, empty_dir).count() == 0
