"""The stored outputs of all stages of one pipeline run against brute force chained over the same documents."""

import random
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq

import corpus_pipeline
from starloom.llm.registry import ORACLE

from .conftest import TABLES, documents, duck, tables
from .test_queries import WORD, jaccard_brute


def sound():
    """Texts that the quality rules keep (sentences with stop words), with copies, near copies, shared passages and benchmark items."""
    rnd = random.Random(11)
    words = [f"{a}{b}" for a in ("lor", "men", "tav", "rip", "sol", "kan", "dur", "fel") for b in ("em", "is", "ator", "ing", "una", "ed", "osa", "il")]
    stop = ["the", "of", "and", "to", "in", "that", "is", "with"]
    sentence = lambda: " ".join(rnd.choice(stop) if rnd.random() < 0.35 else rnd.choice(words) + str(rnd.randrange(90)) for _ in range(12)).capitalize() + "."
    text = lambda n: "\n".join(sentence() for _ in range(n))
    passage, item = text(5), " ".join(sentence() for _ in range(2))
    docs = []
    for i in range(60):
        t = text(rnd.choice([6, 8, 15]))
        if i % 5 == 0:
            t = f"{t}\n{passage}\n{text(3)}"
        if i % 11 == 3:
            t += " " + item
        docs.append((10 * i + 7, t, rnd.choice(["a", "b", None])))
    for i in range(12):
        near = docs[i][1].split(" ")
        if i % 3:
            near[len(near) // 2] = "altered"
        docs.append((3 + 10 * i if i % 2 else 2000 + i, " ".join(near), "b"))
    docs += [docs[1], (5000, "too short", "a"), (5001, None, "a"), (5002, "", None), (5003, "### $$$ %%% " * 30, "a"),
             (5004, passage, "b"), (None, text(8), "a"), (5005, text(900), "b")]
    rnd.shuffle(docs)
    return docs, item


def write(path, docs, item):
    base = tables(documents())
    ids, texts, sources = zip(*docs)
    base["documents"] = {"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string()), "lang": pa.array(["en"] * len(ids)),
                         "source": pa.array(sources, pa.string()), "n_chars": pa.array([None if t is None else len(t) for t in texts], pa.int64())}
    base["benchmark"] = {"item_id": pa.array([1, 2], pa.int64()), "text": pa.array([item, "found in no document at all"], pa.string())}
    for name in TABLES:
        pq.write_table(pa.table(base[name]), path / f"{name}.parquet")
    return str(path)


def words_of(t):
    return WORD.findall(t or "")


def cut(docs, width):
    """Words of windows that a smaller doc_id starts too go; a document without any word left goes."""
    first: dict = {}
    for d, t, s in docs:
        w = words_of(t)
        for i in range(len(w) - width + 1 if d is not None else 0):
            g = tuple(w[i:i + width])
            first[g] = min(first.get(g, d), d)
    out = []
    for d, t, s in docs:
        w, gone = words_of(t), set()
        for i in range(len(w) - width + 1 if d is not None else 0):
            if first[tuple(w[i:i + width])] < d:
                gone.update(range(i, i + width))
        if not w or len(gone) < len(w):
            out.append((d, " ".join(x for i, x in enumerate(w) if i not in gone), s))
    return out


def test_run_is_the_chain_of_brute_force_stages(spark, tmp_path, monkeypatch):
    docs, item = sound()
    (tmp_path / "in").mkdir()
    sf_dir = write(tmp_path / "in", docs, item)
    stored, plain = [], corpus_pipeline.scratch_table
    monkeypatch.setattr(corpus_pipeline, "scratch_table", lambda df, name: stored.append(plain(df, name)) or stored[-1])
    last = corpus_pipeline.run(spark, sf_dir)
    key = lambda rows: Counter((d, " ".join(words_of(t)), s) for d, t, s in rows)
    got = [[(r["doc_id"], r["text"], r["source"]) for r in df.collect()] for df in stored]

    kept = {(r["doc_id"], r["n_words"]) for r in duck(sf_dir, ORACLE["op7_quality_rules"]) if r["kept"]}
    want = [r for r in docs if (r[0], len(words_of(r[1]))) in kept]
    assert 60 < len(want) < len(docs) and key(got[0]) == key(want)

    found = jaccard_brute([(d, t) for d, t, _ in want], 5, 4, 5)
    before = len(want)
    want = [r for r, (d, _, c) in zip(want, found) if d == c]
    repeated = {r: None for r in want if r[0] is not None}
    want = [*repeated, *(r for r in want if r[0] is None)]
    assert len(want) < before - 8 and key(got[1]) == key(want)

    shorter = cut(want, corpus_pipeline.PASSAGE)
    assert key(shorter) != key(want) and key(got[2]) == key(shorter)
    assert all(r["n_chars"] == len(r["text"]) for r in stored[2].collect() if r["doc_id"] is not None)

    (tmp_path / "cut").mkdir()
    leaked = {r["doc_id"] for r in duck(write(tmp_path / "cut", shorter, item), ORACLE["op8_decontaminate"])}
    clean = [r for r in shorter if r[0] not in leaked]
    assert leaked and key(got[3]) == key(clean)

    size = Counter()
    for d, t, s in clean:
        size[s] += len(words_of(t))
    rows = last.collect()
    assert not key([(r["doc_id"], r["text"], r["source"]) for r in rows]) - key(clean)  # whole texts of the stage before
    taken = Counter()
    for r in rows:
        n = len(words_of(r["text"]))
        assert r["mix_words"] == n and r["mix_source_words"] == size[r["source"]]
        assert 0 < r["mix_taken"] <= 3 * n and r["mix_taken"] % n == 0
        taken[r["source"], r["mix_target"]] += r["mix_taken"]
    most = max(len(words_of(t)) for _, t, _ in clean)
    assert {s for s, _ in taken} == set(size) and all(abs(x - t) <= 2 * most for (_, t), x in taken.items())
    assert abs(sum(t for _, t in taken) - sum(size.values())) < 1
