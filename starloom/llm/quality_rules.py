"""Quality rules: a threshold table compiled into one projection, without user functions.

``measures`` is a struct of the counts, ``verdict`` turns the table ``RULES`` into one boolean column, and
``keep_condition`` is both in one expression for filters.  Null texts count as empty.  Only ``text`` is read;
``quality`` adds columns m, base_failed and kept (its input must not use these names, the condition has no such limit).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._tables import let, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: Frequent function words of the four languages of the corpus.
STOP_WORDS = ("the of and to in a is that it for on with as was by this are be from "
              "der die das und ist nicht ein eine zu den mit von auf im "
              "le la les et est un une de des que en du dans pour par "
              "el los y las del que se no con su al lo para una").split()


@dataclass(frozen=True)
class Rule:
    """A document passes when ``low <= numerator / denominator <= high``; it applies from
    ``from_words`` words on."""

    name: str
    numerator: str
    denominator: str | None = None
    low: float | None = None
    high: float | None = None
    from_words: int = 0


#: The threshold table.  ``base`` rules are the contract's; the rest are the method's.
RULES = (
    Rule("length", "n_words", low=10),
    Rule("repeated_words", "n_repeat_words", "n_words", high=0.20),
    Rule("symbols", "n_symbols", "n_words", high=0.25),
    Rule("word_length_high", "word_chars", "n_words", high=20),
    Rule("word_length_low", "word_chars", "n_words", low=2),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=0.50),
    Rule("stop_words", "n_stop_words", "n_words", low=0.02, from_words=50),
    Rule("capitals", "n_upper", "word_chars", high=0.40, from_words=10),
)
BASE_RULES = ("length", "repeated_words")


def _repeat_words(w: Column, n: Column) -> Column:
    """Words covered by 5-word windows that occur at least twice in the text.

    The windows' hashes are sorted with their places, equal neighbours mark repeated windows, and
    one fold over the marked places adds up the words that they cover.
    """
    wins = F.when(n >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.greatest(n - WINDOW, F.lit(0))),
        lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>"))

    def repeated(s: Column) -> Column:
        alike = lambda x, j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
        return F.filter(s, lambda x, k: alike(x, k - 1) | alike(x, k + 1))

    def covered(hs: Column) -> Column:
        ordered = F.sort_array(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        places = F.sort_array(F.transform(let(ordered, repeated), lambda x: x["i"]))
        zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
        return F.aggregate(places, zero, lambda acc, p: F.struct(
            (p + WINDOW).alias("end"),
            (acc["n"] + WINDOW - F.greatest(acc["end"] - p, F.lit(0))).alias("n")), lambda acc: acc["n"])

    # most texts repeat no window: a hash set tells, and only the others are sorted
    return let(wins, lambda hs: F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0)).otherwise(covered(hs)))


def measures(text: str = "text") -> Column:
    """Struct of all counts of the table."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    stop = list(dict.fromkeys(v for x in STOP_WORDS for v in (x, x.capitalize())))

    def counts(w: Column, ls: Column) -> Column:
        n = F.size(w)
        return F.struct(
            n.cast("long").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"),
            F.length(F.regexp_replace(t, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
            F.size(ls).cast("long").alias("n_lines"),
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
            _repeat_words(w, n).cast("long").alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: x.isin(stop))).cast("long").alias("n_stop_words"),
            F.length(F.regexp_replace(t, "[^A-Z]+", "")).cast("long").alias("n_upper"),
        )

    return let(words(F.col(text)), lambda w: let(lines, lambda ls: counts(w, ls)))


def passes(rule: Rule, m: Column) -> Column:
    num = m[rule.numerator]
    den = m[rule.denominator] if rule.denominator else F.lit(1)
    ok = F.lit(True)
    if rule.low is not None:
        ok = ok & (num >= F.lit(rule.low) * den)
    if rule.high is not None:
        ok = ok & (num <= F.lit(rule.high) * den)
    return (m["n_words"] < rule.from_words) | ok if rule.from_words else ok


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])


def verdict(m: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    ok = ~base_failed(m)
    for r in rules:
        if r.name not in BASE_RULES:
            ok = ok & passes(r, m)
    return ok


def quality(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``df`` with struct ``m`` (counts), ``base_failed`` and ``kept``."""
    m = F.col("m")
    return (df.withColumn("m", measures(text)).withColumn("base_failed", base_failed(m))
            .withColumn("kept", verdict(m, rules)))


def keep_condition(text: str = "text", rules: tuple[Rule, ...] = RULES) -> Column:
    """The verdict as one condition on a text column, counts evaluated once."""
    return let(measures(text), lambda m: verdict(m, rules))
