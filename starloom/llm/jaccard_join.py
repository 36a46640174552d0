"""N-gram Jaccard join with a token-group matrix.

A document's set holds its distinct k-word shingles (fewer words: the whole sequence as one; none: empty,
linked with nothing).  Two documents link when den * |intersection| >= num * |union|.  Every pair
of different sets that link is found; equal sets are one class.

1. Tokens are ordered rarest first by a count sketch of fixed size.  Documents with overlap of at least
   a = ceil(num * n / den) share at least l tokens among the first n - a + l of each (the prefix filter), whatever the order.
2. A class whose prefix shares fewer than the needed tokens with all others together links with nothing and drops out.
3. The others have a group of similar documents: by the least hash of the prefix tokens that occur elsewhere.
4. Each is compared with some of its group, and with some that share the least hash of the whole set: clusters of bounded size, so work is
   linear in the number of documents.  Those links leave large sets of near copies as one cluster each; a cluster
   moves into one group, the least of its members'.
5. The matrix has a row per token and group: the union of the members' prefix tokens.  A document's overlap with a
   group's union bounds its overlap with every member, so only groups with enough common tokens are opened.  Of two groups the
   members of the smaller one visit the larger one, and in a group of several clusters all but the largest cluster visit their own.
6. An opened group's members and visitors are compared exactly, in blocks of bounded size.  A block gives out a spanning
   forest of the links between clusters that it finds, so copies are never expanded into all pairs, and components follow.

Links inside a cluster change no component, so members of one cluster are never compared again.

Tokens travel as 4-byte hashes packed by bucket; wrong hits only open more groups.  Sets are compared by 64-bit shingle
hashes, classes by a 64-bit hash of the set.

Null texts have no words.  Rows without a doc_id link with nothing and have no component.  Rows with equal doc_id are separate
rows; repeated rows are equal sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._tables import doc_bytes, n_groups, scratch_table, store
from ._tokens import U, Words, grams, mix, pack, slices, starts_window
from .components import components

CELLS = 1 << 20
CELL_BLOCK = 1 << 14
BUCKET_BYTES = 8 << 20
CHUNK = 1_000_000
MEMBER_TOKENS, VISITOR_TOKENS = 300_000, 600_000  # of a block
MEMBERS, VISITORS = 768, 1536
NEAR, NEAR_TOKENS = 256, 100_000  # of a block of step 4
BUNDLE_TOKENS = 600_000
MEMBER, VISITOR, BOTH = 0, 1, 2


class Rule:
    """k-word shingles and the least Jaccard similarity num / den."""

    def __init__(self, k: int, num: int, den: int):
        f = Fraction(num, den)
        self.k, self.num, self.den = k, f.numerator, f.denominator

    def least_overlap(self, n: np.ndarray) -> np.ndarray:
        return -(-self.num * n // self.den)

    def spare(self, n: np.ndarray) -> np.ndarray:
        """Common prefix tokens asked of documents of n tokens (l above)."""
        return 1 + n // 50

    def prefix(self, n: np.ndarray) -> np.ndarray:
        return np.where(self.least_overlap(n + 1) > n, 0, np.minimum(n, n - self.least_overlap(n) + self.spare(n)))

    def needed(self, n: np.ndarray) -> np.ndarray:
        """Common prefix tokens that any partner of a document of n tokens must have."""
        return self.spare(self.least_overlap(n))


def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, token) of the distinct shingles, sorted, and the number of tokens of each document."""
    w = Words(texts, lower=True)
    h = w.hashes()
    doc = w.doc_of_word()
    ok = starts_window(w, k)
    d, t = [doc[ok]], [grams(h, k)[ok]]
    for m in range(1, k):  # shorter texts: all words as one
        only = (w.count[doc] == m) & (w.place() == 0) if len(doc) else np.zeros(0, bool)
        d.append(doc[only])
        t.append(grams(h, m)[only] ^ U(m))
    d, t = np.concatenate(d), np.concatenate(t)
    order = np.lexsort((t, d))
    d, t = d[order], t[order]
    new = _new(d, t)
    d, t = d[new], t[new]
    return d, t, np.bincount(d, minlength=len(texts))


def _new(*keys: np.ndarray) -> np.ndarray:
    out = np.ones(len(keys[0]), bool)
    if len(out):
        out[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return out


def _cell(t: np.ndarray) -> np.ndarray:
    return (t >> U(44)).astype(np.int64)


def count_sketch(docs: DataFrame, k: int) -> np.ndarray:
    """Documents per cell of token hashes: CELLS numbers, whatever the input."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                total += np.bincount(_cell(shingle_sets(part.column("text"), k)[1]), minlength=CELLS)
        blocks = total.reshape(-1, CELL_BLOCK).astype(np.uint32)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(blocks))), pa.array([pack(b) for b in blocks], pa.binary())],
                                         names=["block", "counts"])

    def add(t: pa.Table) -> pa.Table:
        total = np.zeros(CELL_BLOCK, np.int64)
        for x in t.column("counts"):
            total += np.frombuffer(x.as_buffer(), np.uint32)
        return pa.table({"block": t.column("block")[:1], "counts": pa.array([pack(np.minimum(total, 2**32 - 1).astype(np.uint32))])})

    rows = docs.select("text").mapInArrow(run, "block long, counts binary").groupBy("block").applyInArrow(add, "block long, counts binary")
    out = np.zeros(CELLS, np.uint32)
    for r in rows.collect():
        out[r["block"] * CELL_BLOCK:(r["block"] + 1) * CELL_BLOCK] = np.frombuffer(r["counts"], np.uint32)
    return out


def _prefixes(rule: Rule, counts: np.ndarray, d: np.ndarray, t: np.ndarray, n: np.ndarray) -> list[bytes]:
    """Each document's rarest tokens, as many as the rule's prefix."""
    order = np.lexsort((t, counts[_cell(t)], d))
    edge = np.cumsum(n) - n
    t = t[order]
    return [pack(t[a:a + p]) for a, p in zip(edge.tolist(), rule.prefix(n).tolist())]


def _class(d: np.ndarray, t: np.ndarray, n: np.ndarray) -> np.ndarray:
    """64-bit hash of each set (order plays no part)."""
    out = np.zeros(len(n), U)
    some = n > 0
    edge = (np.cumsum(n) - n)[some]
    if len(edge):
        out[some] = mix(np.add.reduceat(mix(t ^ U(0x5851F42D4C957F2D)), edge) + mix(n[some].astype(U)))
    return out.view(np.int64)


def _send(extra: tuple[str, ...], buckets: int):
    """Pack (token, class and more) by token bucket; class and more come from the rows' columns."""
    def rows(tok: np.ndarray, row: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        bucket = ((tok >> U(32)) % U(buckets)).astype(np.int64)
        low = (tok & U(0xFFFFFFFF)).astype(np.uint32)
        order = np.lexsort((row, low, bucket))
        bucket, low, row = bucket[order], low[order], row[order]
        edge = np.append(np.flatnonzero(_new(bucket)), len(bucket))
        cols: list[list] = [[] for _ in range(3 + len(ids))]
        for a, b in zip(edge[:-1], edge[1:]):
            here, which = np.unique(row[a:b], return_inverse=True)
            which = which.astype(np.uint16 if len(here) < 65536 else np.uint32)
            for c, x in zip(cols, (int(bucket[a]), pack(low[a:b]), pack(which), *(pack(i[here]) for i in ids))):
                c.append(x)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if i == 0 else pa.binary()) for i, c in enumerate(cols)],
                                          names=["bucket", "low", "which", "cls", *extra])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids, n, total = [], [], 0, 0

        def out() -> pa.RecordBatch:
            columns = [np.concatenate(c) for c in zip(*ids)]
            return rows(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), columns)

        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                part = batch.slice(a, 1024)
                raw = [np.frombuffer(x.as_buffer(), U) for x in part.column("prefix")]
                size = [len(x) for x in raw]
                held.append((np.concatenate(raw), np.repeat(np.arange(len(raw)) + n, size)))
                ids.append([part.column(c).to_numpy(zero_copy_only=False) for c in ("cls", *extra)])
                n, total = n + len(raw), total + sum(size)
                if total >= CHUNK:
                    yield out()
                    held, ids, n, total = [], [], 0, 0
        if total:
            yield out()

    return run, ", ".join(["bucket int", "low binary", "which binary", "cls binary", *(f"{c} binary" for c in extra)])


def _received(t: pa.Table, names: tuple[str, ...]) -> list[np.ndarray]:
    """low, class, and more: one entry per token and class, sorted by token and class, without repeats."""
    out: list[list] = [[] for _ in range(1 + len(names))]
    for r in zip(*(t.column(c) for c in ("low", "which", *names))):
        out[0].append(np.frombuffer(r[0].as_buffer(), np.uint32))
        ids = [np.frombuffer(x.as_buffer(), np.int64) for x in r[2:]]
        which = np.frombuffer(r[1].as_buffer(), np.uint16 if len(ids[0]) < 65536 else np.uint32)
        for o, i in zip(out[1:], ids):
            o.append(i[which])
    cols = [np.concatenate(x) for x in out]
    order = np.lexsort((cols[1], cols[0]))
    cols = [c[order] for c in cols]
    new = _new(cols[0], cols[1])
    return [c[new] for c in cols]


def _shared(t: pa.Table) -> pa.Table:
    """Per class of a bucket: number of its prefix tokens that other classes have, and the least of their hashes."""
    low, cls = _received(t, ("cls",))
    run = np.flatnonzero(_new(low))
    size = np.diff(np.append(run, len(low)))
    many = np.repeat(size > 1, size)
    low, cls = low[many], cls[many]
    h = mix(low.astype(U) | U(t.column("bucket")[0].as_py() << 32)).view(np.int64)
    order = np.lexsort((h, cls))
    cls, h = cls[order], h[order]
    new = np.flatnonzero(_new(cls))
    return pa.table({"cls": pa.array(cls[new], pa.int64()), "shared": pa.array(np.diff(np.append(new, len(cls))), pa.int64()),
                     "grp": pa.array(h[new], pa.int64())})


def _overlaps(parts: int):
    """Per bucket: common prefix tokens of classes with the unions of larger groups, packed by class part."""
    def run(t: pa.Table) -> pa.Table:
        low, cls, grp, members = _received(t, ("cls", "grp", "members"))
        order = np.lexsort((grp, members, low))
        low, cls, grp, members = low[order], cls[order], grp[order], members[order]
        one = _new(low, grp)  # a row of the matrix: token and group
        ml, mg = low[one], grp[one]
        # groups of a token from the smallest on (ties by name): a class looks at those after its own
        a, b = np.cumsum(one), np.searchsorted(ml, low, "right")
        pairs: list[np.ndarray] = []
        count: list[np.ndarray] = []
        work = np.cumsum(b - a)
        i = 0
        while i < len(low):  # bounded slices of the expansion
            j = max(i + 1, int(np.searchsorted(work, (work[i - 1] if i else 0) + 2_000_000, "right")))
            n = b[i:j] - a[i:j]
            at = np.repeat(a[i:j], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            got, c = np.unique(np.stack([np.repeat(cls[i:j], n), mg[at]], 1), axis=0, return_counts=True)
            pairs.append(got)
            count.append(c)
            i = j
        p = np.concatenate(pairs) if pairs else np.zeros((0, 2), np.int64)
        c = np.concatenate(count) if count else np.zeros(0, np.int64)
        part = (mix(np.ascontiguousarray(p[:, 0]).view(U)) % U(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        p, c, part = p[order], c[order], part[order]
        edge = np.append(np.flatnonzero(_new(part)), len(part))
        return pa.table({"part": pa.array(part[edge[:-1]], pa.int64()),
                         **{k: pa.array([pack(v[s:e]) for s, e in zip(edge[:-1], edge[1:])], pa.binary())
                            for k, v in (("cls", p[:, 0]), ("grp", p[:, 1]), ("common", c.astype(np.int64)))}})

    return run


def _sum_overlaps(t: pa.Table) -> pa.Table:
    cols = [np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in t.column(c)]) for c in ("cls", "grp", "common")]
    order = np.lexsort((cols[1], cols[0]))
    cls, grp, common = (c[order] for c in cols)
    new = np.flatnonzero(_new(cls, grp))
    total = np.add.reduceat(common, new) if len(new) else common
    ok = total > 0
    return pa.table({"cls": pa.array(cls[new][ok]), "grp": pa.array(grp[new][ok]), "common": pa.array(total[ok])})


def _forest(links: np.ndarray, names: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links (pairs of numbers), as pairs of names."""
    root = list(range(len(names)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    for i, j in links.tolist():
        a, b = find(i), find(j)
        if a != b:
            root[max(a, b)] = min(a, b)
            out.append((int(names[i]), int(names[j])))
    return out


def _compare(rule_args: tuple[int, int, int]):
    """Exact comparison of the members and visitors of blocks; links between nodes (classes or clusters)."""
    rule = Rule(*rule_args)

    def block(node: np.ndarray, role: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
        names, number = np.unique(node, return_inverse=True)
        m, v = np.flatnonzero(role != VISITOR), np.flatnonzero(role != MEMBER)
        if not len(m) or not len(v) or len(names) < 2:
            return []
        n = np.array([len(s) for s in sets])
        tok, owner = np.concatenate([sets[i] for i in m]), np.repeat(np.arange(len(m)), n[m])
        order = np.argsort(tok, kind="stable")
        tok, owner = tok[order], owner[order]
        links = []
        for i in v:
            a, b = np.searchsorted(tok, sets[i], "left"), np.searchsorted(tok, sets[i], "right")
            hit = np.flatnonzero(b > a)
            if not len(hit):
                continue
            cnt = (b - a)[hit]
            at = np.repeat(a[hit], cnt) + np.arange(cnt.sum()) - np.repeat(np.cumsum(cnt) - cnt, cnt)
            common = np.bincount(owner[at], minlength=len(m))
            ok = (rule.den * common >= rule.num * (n[m] + n[i] - common)) & (number[m] != number[i])
            links += [(number[i], j) for j in number[m[ok]]]
        return _forest(np.array(links, dtype=np.int64).reshape(-1, 2), names)

    def run(t: pa.Table) -> pa.Table:
        key = [t.column(c).to_numpy() for c in ("grp", "mb", "vb")]
        node, role = t.column("node").to_numpy(), t.column("role").to_numpy()
        tokens = t.column("tokens")
        order = np.lexsort(key)
        edge = np.append(np.flatnonzero(_new(*(k[order] for k in key))), len(order))
        out: list[tuple[int, int]] = []
        for a, b in zip(edge[:-1], edge[1:]):
            if b - a < 2:
                continue
            rows = order[a:b]
            out += block(node[rows], role[rows], [np.frombuffer(tokens[int(i)].as_buffer(), U) for i in rows])
        pairs = np.array(out, dtype=np.int64).reshape(-1, 2)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    return run


def link_components(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, text_hash) for every row of ``docs`` (doc_id, text); text_hash is
    xxhash64(text), which tells rows of equal doc_id apart."""
    rule, args = Rule(k, num, den), (k, num, den)
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    buckets = n_groups(slim, doc_bytes(), BUCKET_BYTES)
    counts = spark.sparkContext.broadcast(count_sketch(slim, k))  # CELLS numbers

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                d, t, n = shingle_sets(part.column("text"), k)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_hash"), pa.array(n), pa.array(_class(d, t, n)),
                     pa.array(_prefixes(Rule(*args), counts.value, d, t, n), pa.binary())], names=["doc_id", "text_hash", "n", "cls", "prefix"])

    meta = scratch_table(slim.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
        describe, "doc_id long, text_hash long, n long, cls long, prefix binary"), "jac-docs")
    known = meta.filter("doc_id is not null and n > 0")

    # classes that share enough prefix tokens with others, and their groups
    run, schema = _send((), buckets)
    parts = known.filter(F.octet_length("prefix") > 0).select("cls", "prefix").mapInArrow(run, schema)
    shared = (parts.groupBy("bucket").applyInArrow(_shared, "cls long, shared long, grp long")
              .groupBy("cls").agg(F.sum("shared").alias("shared"), F.min("grp").alias("grp")))
    classes = store(known.groupBy("cls").agg(F.min("doc_id").alias("doc"), F.max("n").alias("n")), "jac-classes")
    least = F.ceil(F.col("n") * rule.num / F.lit(rule.den))
    live = store(classes.join(shared, "cls").filter(F.col("shared") >= 1 + F.floor(least / 50)).select("cls", "grp", "doc"), "jac-live")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                d, t, n = shingle_sets(part.column("text"), k)
                cls = part.column("cls").to_numpy()
                mine = _class(d, t, n) == cls  # another text of the same doc_id is another class
                edge = np.append(np.cumsum(n) - n, len(t))
                prefix = _prefixes(Rule(*args), counts.value, d, t, n)
                rows = np.flatnonzero(mine)
                least = np.zeros(len(n), U)
                if len(t):
                    least[n > 0] = np.minimum.reduceat(mix(t ^ U(0x2545F4914F6CDD1D)), edge[:-1][n > 0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cls[rows]), part.column("grp").take(pa.array(rows)), pa.array(least.view(np.int64)[rows]), pa.array(n[rows]),
                     pa.array([prefix[i] for i in rows], pa.binary()),
                     pa.array([pack(t[edge[i]:edge[i] + n[i]]) for i in rows], pa.binary())],
                    names=["cls", "grp", "least", "n", "prefix", "tokens"])

    # always a sort-merge join: the same plan at every size
    found = slim.join(live.withColumnRenamed("doc", "doc_id").hint("merge"), "doc_id").select("cls", "grp", "text")
    full = found.mapInArrow(sets, "cls long, grp long, least long, n long, prefix binary, tokens binary")
    if known.groupBy("doc_id", "cls").count().filter("count > 1").limit(1).count():  # repeated rows
        full = full.dropDuplicates(["cls"])
    full = scratch_table(full, "jac-sets")

    blocks = lambda rows, tokens, name: F.greatest(
        F.ceil(F.count(F.lit(1)) / rows), F.ceil(F.sum("n") / tokens)).cast("int").alias(name)

    def compared(rows: DataFrame, name: str) -> DataFrame:
        """Links (a, b) that the blocks of ``rows`` (node, grp, n, tokens, role, mb, vb) hold."""
        bundles = n_groups(rows, F.col("n"), BUNDLE_TOKENS)
        return store(rows.withColumn("bundle", F.pmod(F.xxhash64("grp", "mb", "vb"), F.lit(bundles)))
                     .groupBy("bundle").applyInArrow(_compare(args), "a long, b long"), name)

    def some(key: str, salt: int) -> DataFrame:
        """Everyone in a block of those that share ``key``."""
        # few keys have more than one block: at most one in NEAR classes, or in NEAR_TOKENS tokens
        large = full.groupBy(F.col(key).alias("key")).agg(blocks(NEAR, NEAR_TOKENS, "nb")).filter("nb > 1")
        return (full.join(F.broadcast(large), F.col(key) == F.col("key"), "left")
                .select(F.col("cls").alias("node"), F.col(key).alias("grp"), "n", "tokens", F.lit(BOTH).alias("role"),
                        F.pmod(F.xxhash64("cls", F.lit(salt)), F.coalesce("nb", F.lit(1))).cast("int").alias("mb"),
                        F.lit(salt).alias("vb")))

    near = compared(some("grp", 0).unionByName(some("least", 1)), "jac-near")
    clusters = components(near)
    cluster = store(full.select("cls", "grp", "n").join(clusters.select(F.col("node").alias("cls"), F.col("label").alias("node")), "cls", "left")
                    .withColumn("node", F.coalesce("node", "cls")), "jac-clusters")
    moved = store(cluster.groupBy("node").agg(F.min("grp").alias("grp")), "jac-moved")
    moved = store(cluster.drop("grp").join(moved, "node"), "jac-members")
    by_cluster = moved.groupBy("grp", "node").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("n"))
    of_group = store(by_cluster.groupBy("grp").agg(
        F.sum("c").alias("members"), F.max(F.struct("c", "node"))["node"].alias("main"),
        F.greatest(F.ceil(F.sum("c") / MEMBERS), F.ceil(F.sum("n") / MEMBER_TOKENS)).cast("int").alias("nm")), "jac-sizes")
    place = store(moved.join(of_group, "grp"), "jac-places")  # cls, grp, node, n, members, main, nm

    # the matrix: which larger groups' unions hold enough of a class's prefix
    run, schema = _send(("grp", "members"), buckets)
    common = (full.select("cls", "prefix").join(place.select("cls", "grp", "members").hint("merge"), "cls")
              .select("cls", "grp", "members", "prefix").mapInArrow(run, schema).groupBy("bucket")
              .applyInArrow(_overlaps(buckets), "part long, cls binary, grp binary, common binary").groupBy("part")
              .applyInArrow(_sum_overlaps, "cls long, grp long, common long"))
    least = F.ceil(F.col("n") * rule.num / F.lit(rule.den))
    visits = (store(common, "jac-common").join(place.select("cls", "node", "n"), "cls")
              .filter(F.col("common") >= 1 + F.floor(least / 50)).select("cls", "node", "grp", "n", F.lit(False).alias("own")))
    own = place.filter("node <> main").select("cls", "node", "grp", "n", F.lit(True).alias("own"))
    visitors = store(visits.unionByName(own), "jac-visits")
    groups = store(visitors.groupBy("grp").agg(blocks(VISITORS, VISITOR_TOKENS, "nv"), F.max("own").alias("several"))
                   .join(of_group.select("grp", "nm"), "grp")
                   # a group of one block: its members' rows serve as visitors too
                   .withColumn("one", F.col("several") & (F.col("nm") == 1) & (F.col("nv") == 1)), "jac-groups")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    m = (place.select("cls", "node", "grp").join(groups, "grp")
         .select("cls", "node", "grp", F.when(F.col("one"), BOTH).otherwise(MEMBER).alias("role"),
                 F.pmod(F.xxhash64("cls"), F.col("nm")).cast("int").alias("mb"), each("nv").alias("vb")))
    v = (visitors.drop("n").join(groups, "grp").filter(~(F.col("own") & F.col("one")))
         .select("cls", "node", "grp", F.lit(VISITOR).alias("role"), each("nm").alias("mb"),
                 F.pmod(F.xxhash64("cls", F.lit(1)), F.col("nv")).cast("int").alias("vb")))
    seats = store(m.unionByName(v), "jac-seats").hint("merge")
    links = near.unionByName(compared(seats.join(full.select("cls", "n", "tokens"), "cls"), "jac-links"))

    labels = components(links)
    ids = labels.join(classes.select(F.col("cls").alias("node"), "doc"), "node")
    least_doc = ids.groupBy("label").agg(F.min("doc").alias("component"))
    of_class = store(classes.select("cls", "doc").join(labels.withColumnRenamed("node", "cls"), "cls", "left")
                     .join(store(least_doc, "jac-least"), "label", "left")
                     .select("cls", F.coalesce("component", "doc").alias("component")), "jac-components")
    own = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")))
    return meta.select("doc_id", "text_hash", "n", "cls").join(of_class, "cls", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"), "text_hash")


def one_of_each(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """``docs``, all columns as they are, with one document of each component: that of the smallest doc_id.

    Rows without a doc_id stay.  Of repeated rows (doc_id and text) one stays.
    """
    found = store(link_components(docs, k, num, den), "jac-found")
    losers = found.filter("component_id <> doc_id").select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    twice = store(found.filter("doc_id is not null").groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
                  .agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("__id", "__hash"), "jac-repeated")
    on = lambda t: (F.col("doc_id").cast("long") == t["__id"]) & (F.xxhash64(F.col("text").cast("string")) == t["__hash"])
    kept = docs.join(losers.hint("merge"), on(losers), "left_anti")
    if not twice.limit(1).count():
        return kept
    once = kept.join(twice, on(twice), "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(twice, on(twice), "left_anti").unionByName(once)
