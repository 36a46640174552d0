import random

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TABLES = ("documents", "pages", "benchmark", "labels", "conversations")


def documents(seed: int = 3) -> dict[str, list]:
    """Small vocabulary, shared passages, exact and near copies, repeated rows, nulls, a very long text."""
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)] + ["the", "of", "and", "été", "Ünder", "#tag", "naïve,", "MIT", "License", "x" * 300]
    text = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    passage, line = text(60), text(14)
    rows: list[tuple] = []
    for i in range(120):
        t = text(rnd.choice([0, 1, 2, 5, 12, 13, 14, 40, 90, 200]))
        if i % 4 == 0:
            t = f"{t}\n{passage} {text(7)}\n{line}\t{text(30)}"
        if i % 10 == 0:
            t += " the MIT  License . GNU General\nPublic license, Apache License version 2.0"
        rows.append((i * 3, t, rnd.choice(["a", "b", "é", None])))
    for i in range(30):  # copies and near copies of a few documents
        base = rows[rnd.choice([4, 8, 12])][1].split(" ")
        for _ in range(i % 3):
            base[rnd.randrange(len(base))] = "changed"
        rows.append((1000 + i, " ".join(base), "b"))
    rows += [(5000, text(20_000), "b"), (5001, None, "b"), (5002, "", None), (5003, " \n\t ", "a"), (None, passage, "a"),
             (None, None, None), rows[20], rows[20], (rows[21][0], text(50), "a")]
    rnd.shuffle(rows)
    ids, texts, sources = zip(*rows)
    n = len(ids)
    return {"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string()), "lang": pa.array(["en"] * n),
            "source": pa.array(sources, pa.string()), "n_chars": pa.array([None if t is None else len(t) for t in texts], pa.int64()),
            # names that the operators use inside
            **{c: pa.array([7] * n, pa.int64()) for c in ("g", "m", "size", "row", "cls", "n", "kept", "target", "p", "low", "__s")}}


def tables(docs: dict) -> dict[str, dict]:
    texts = [t for t in docs["text"].to_pylist() if t]
    long = max(texts, key=len).split()
    items = [" ".join(long[100:140]), " ".join(long[500:504]), "Éa " + " ".join(long[900:930]), "nowhere to be found in any text", "", None,
             " ".join(long[100:140])]
    html = ["<p>a</p>", "<p>" + "é" * 900 + "</p>", "x" * 999, "y" * 1000, "y" * 1000, "y" * 1000, None, "", "line\r\n\r\nWARC/1.1\r\n" * 3000,
            "line\r\n\r\nWARC/1.1\r\n" * 3000, "z" * 1200, "z" * 1200, "é€😀" * 20_000]
    ids = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 11, 12]
    conv = [(1, 0, "user", "a"), (1, 1, "assistant", "b </turn>\n### x"), (1, 1, "assistant", "b </turn>\n### x"), (2, None, None, None),
            (2, 5, "assistant", "\\### é😀"), (2, 4, "assistant", ""), (None, 1, "user", "####\\"), (3, 1, "us:er#\n<", "t: ### u</turn>")]
    conv += [(9, k, "user" if k % 2 else "assistant", f"turn {k} ###") for k in range(300)]
    doc_ids = [i for i in docs["doc_id"].to_pylist() if i is not None]
    c, t, r, x = zip(*conv)
    return {"documents": docs,
            "benchmark": {"item_id": pa.array(range(len(items)), pa.int64()), "text": pa.array(items, pa.string())},
            "pages": {"page_id": pa.array([*ids, None], pa.int64()), "url": pa.array(["http://h/é a\n", *[None] * 13], pa.string()),
                      "html": pa.array([*html, "y" * 1000], pa.string()), "digest": pa.array([1] * 14)},
            "labels": {"doc_id": pa.array([*doc_ids, None], pa.int64()), "quality": pa.array([1] * (len(doc_ids) + 1), pa.int32()),
                       "toxic": pa.array([*(None if i % 5 == 0 else int(i % 2) for i in doc_ids), 1], pa.int32())},
            "conversations": {"conv_id": pa.array(c, pa.int64()), "turn": pa.array(t, pa.int64()), "role": pa.array(r, pa.string()),
                              "text": pa.array(x, pa.string())}}


@pytest.fixture(scope="session")
def edge_dir(tmp_path_factory):
    path = tmp_path_factory.mktemp("edge")
    for name, cols in tables(documents()).items():
        pq.write_table(pa.table(cols), path / f"{name}.parquet")
    return str(path)


@pytest.fixture(scope="session")
def empty_dir(tmp_path_factory):
    path = tmp_path_factory.mktemp("empty")
    for name, cols in tables(documents()).items():
        pq.write_table(pa.table(cols).slice(0, 0), path / f"{name}.parquet")
    return str(path)


def duck(sf_dir: str, sql: str) -> list[dict]:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return [dict(zip(names, r)) for r in cur.fetchall()]


def same(a: list[dict], b: list[dict]) -> None:
    key = lambda r: repr(sorted(r.items()))
    assert sorted(map(key, a)) == sorted(map(key, b))
