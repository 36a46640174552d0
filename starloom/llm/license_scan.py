"""License scans with DataFrame functions only: ordered signature rules (``license_rules``) behind keyword gates.

A text is lower-cased (A-Z) and cut into words of digits, letters and non-ASCII code points, which
makes punctuation and line breaks irrelevant.  Every signature rule has a keyword and a gate that whatever it matches
must hold.  A text without any gate cannot match a rule or a base phrase and only has its words counted; another one is
matched with the rules whose keyword occurs.  Every match is an interval of the normalised text.  From left to right (at one
start the longest first, of equal ones the rule of lower ``order``), a match that lies inside the last one kept goes, so
"apache license version 2 0" silences the bare "apache license" inside it; of two that overlap in part the rule of lower
``order`` stays.  ``labels`` joins what stays with the base labels; ``score`` is the best score among the rules that stay, 0.5
for a base phrase alone, 0 without any.

Null and empty texts have no words and score 0.  Every row is scanned by itself, whole, at any length: repeated rows give
equal results, an empty table an empty one.  Only ``text`` is read; other columns may have any names and stay as they are,
but one named like the result is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._tables import ascii_lower, let
from .license_rules import rules

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: The contract's phrases and labels (fixed values).
BASE = ((("mit", "license"), "mit"), (("apache", "license"), "apache"), (("general", "public", "license"), "gpl"))


def gates() -> list[str]:
    """Words of which a text must hold one for a rule or a base phrase to match: those that hold no other one."""
    every = {gate for _, _, gate, _, _, _ in rules()} | {f" {' '.join(phrase)} " for phrase, _ in BASE}
    return sorted(g for g in every if not any(o != g and o in g for o in every))


def _rule_array() -> Column:
    """The rule table as one literal (its size is fixed by the rules, not by data)."""
    return F.array(*[F.struct(F.lit(o).alias("o"), F.lit(k).alias("k"), F.lit(p).alias("p"), F.lit(lb).alias("l"),
                              F.lit(c).alias("c")) for o, k, _, p, lb, c in rules()])


def _matches(norm: Column, r: Column) -> Column:
    """Intervals of all matches of rule ``r``: lengths of the pieces between matches give the starts."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int,o:int,l:string,c:double>>").alias("out"))

    def fold(found: Column) -> Column:
        pieces = F.split(norm, r["p"])
        both = F.zip_with(pieces, found, lambda a, m: F.struct(F.length(a).alias("a"), F.length(m).alias("m")))
        step = lambda acc, z: F.when(z["m"].isNull(), acc).otherwise(F.struct(
            (acc["at"] + z["a"] + z["m"]).alias("at"),
            F.concat(acc["out"], F.array(F.struct(
                (acc["at"] + z["a"]).alias("s"), (acc["at"] + z["a"] + z["m"]).alias("e"), r["o"].alias("o"),
                r["l"].alias("l"), r["c"].alias("c")))).alias("out")))
        return F.aggregate(both, zero, step, lambda acc: acc["out"])

    # a place found by extract_all is found by split too, so both lists run in step
    return let(F.regexp_extract_all(norm, r["p"], F.lit(0)), lambda found: F.when(
        F.size(found) == 0, F.array().cast("array<struct<s:int,e:int,o:int,l:string,c:double>>")).otherwise(fold(found)))


def detections(norm: Column) -> Column:
    """(labels, score) of a normalised text: its matches, swept from left to right (see the module text)."""
    candidates = F.filter(_rule_array(), lambda r: F.contains(norm, r["k"]))
    found = F.flatten(F.transform(candidates, lambda r: _matches(norm, r)))
    # by start, longest first, then rule order; ``last`` is the interval that the next one is held against
    keyed = F.sort_array(F.transform(found, lambda m: F.struct(
        m["s"].alias("s"), (-m["e"]).alias("ne"), m["o"].alias("o"), m["l"].alias("l"), m["c"].alias("c"))))
    kind = "struct<e:int,o:int,l:string,c:double>"
    zero = F.struct(F.lit(0).alias("e"), F.lit(-1).alias("o"), F.array().cast(f"array<{kind}>").alias("kept"),
                    F.lit(None).cast(kind).alias("last"))
    entry = lambda m: F.struct((-m["ne"]).alias("e"), m["o"].alias("o"), m["l"].alias("l"), m["c"].alias("c"))
    put = lambda acc, m, kept: F.struct((-m["ne"]).alias("e"), m["o"].alias("o"), kept.alias("kept"), entry(m).alias("last"))

    def step(acc: Column, m: Column) -> Column:
        loses = (-m["ne"] <= acc["e"]) | ((m["s"] < acc["e"]) & (m["o"] > acc["o"]))
        wins = m["s"] < acc["e"]  # overlaps the last one and has the better order: takes its place
        return (F.when(loses, acc).when(wins, put(acc, m, acc["kept"]))
                .otherwise(put(acc, m, F.concat(acc["kept"], F.filter(F.array(acc["last"]), lambda x: x.isNotNull())))))

    def finish(acc: Column) -> Column:
        return F.concat(acc["kept"], F.filter(F.array(acc["last"]), lambda x: x.isNotNull()))

    return let(F.aggregate(keyed, zero, step, finish), lambda kept: F.struct(
        F.transform(kept, lambda m: m["l"]).alias("labels"),
        F.coalesce(F.array_max(F.transform(kept, lambda m: m["c"])), F.lit(0.0)).alias("score")))


def _base(ws: Column) -> Column:
    """(place, label) of every base phrase, places counted in words."""
    def at(i: Column) -> Column:
        none = F.lit(None).cast("string")
        out = none
        for phrase, label in reversed(BASE):
            hit = F.lit(True)
            for j, p in enumerate(phrase):
                hit = hit & (F.get(ws, i + j) == p)
            out = F.when(hit, F.lit(label)).otherwise(out)
        return F.struct(i.alias("i"), out.alias("l"))
    return F.filter(F.transform(F.sequence(F.lit(0), F.greatest(F.size(ws) - 1, F.lit(0))), at),
                    lambda x: x["l"].isNotNull())


def scan(df: DataFrame, text: str = "text", out: str = "scan") -> DataFrame:
    """Add struct ``out``: n_words, n_base, first_word, last_word, base_labels, labels, score."""
    # words parted and enclosed by single spaces
    free = lambda c: c if c.lower() not in {x.lower() for x in df.columns} else free(c + "_")
    norm_col, row_col = free("__norm"), free("__scan")
    norm = F.regexp_replace(F.concat(F.lit(" "), ascii_lower(F.coalesce(F.col(text), F.lit(""))), F.lit(" ")), SEPARATORS, " ")
    gate = F.lit(False)
    for g in gates():
        gate = gate | F.contains(F.col(norm_col), F.lit(g))
    none = F.array().cast("array<string>")

    def full(ws: Column) -> Column:
        return let(_base(ws), lambda b: let(detections(F.col(norm_col)), lambda d: F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.size(b).cast("long").alias("n_base"),
            F.array_min(F.transform(b, lambda x: x["i"])).cast("long").alias("first_word"),
            F.array_max(F.transform(b, lambda x: x["i"])).cast("long").alias("last_word"),
            F.array_sort(F.array_distinct(F.transform(b, lambda x: x["l"]))).alias("base"),
            F.array_sort(F.array_distinct(F.concat(F.transform(b, lambda x: x["l"]), d["labels"]))).alias("all"),
            F.greatest(d["score"], F.when(F.size(b) > 0, F.lit(0.5)).otherwise(F.lit(0.0))).alias("score"))))

    short = F.struct(
        (F.octet_length(norm_col) - F.octet_length(F.replace(F.col(norm_col), F.lit(" "), F.lit(""))) - 1).cast("long").alias("n_words"),
        F.lit(0).cast("long").alias("n_base"), F.lit(None).cast("long").alias("first_word"),
        F.lit(None).cast("long").alias("last_word"), none.alias("base"), none.alias("all"), F.lit(0.0).alias("score"))
    ws = F.filter(F.split(F.col(norm_col), " "), lambda w: w != "")
    s = F.col(row_col)
    return (df.withColumn(norm_col, norm)
            .withColumn(row_col, F.when(gate, let(ws, full)).otherwise(short))
            .withColumn(out, F.struct(
                s["n_words"].alias("n_words"), s["n_base"].alias("n_base"), s["first_word"].alias("first_word"),
                s["last_word"].alias("last_word"), F.concat_ws(",", s["base"]).alias("base_labels"),
                F.concat_ws(",", s["all"]).alias("labels"), s["score"].alias("score")))
            .drop(norm_col, row_col))
