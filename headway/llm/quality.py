"""Quality rules: statistics of whole texts and learned decision lists, in SQL functions only.

Sequential covering learns rules for the bad class from a bounded sample of labelled rows:
a rule grows by threshold conditions of the highest information gain on two thirds of the
sample, is pruned on the other third, and what it covers is removed. The rules become ordered
conditional expressions, evaluated by the engine like any other column.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 20_000  # labelled rows used for learning, chosen by hash
CUTS = 24  # thresholds tried per feature
RULES = 8
CONDITIONS = 3
PRECISION = 0.9  # least share of bad rows a rule may reject, on rows it was not grown on
SUPPORT = 8  # least number of such rows

BLANK_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
BLANKS = r"[\x20\x09-\x0D]+"
FEATURES = ("n_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "digit_share")


def text_statistics(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_digits, as longs.

    Words are runs without blanks. n_repeat_words counts the words that lie in a three-word
    window found twice or more in the text. A null text counts as empty: all zero. Columns of
    these names in ``docs`` are replaced, helper columns start with two underscores.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_digits")
    keep = [c for c in docs.columns if c not in names]
    rows = docs.select(
        *keep,
        F.array_remove(F.split(body, BLANKS), "").alias("__w"),
        F.length(F.translate(body, BLANK_CHARS, "")).cast("long").alias("word_chars"),
        (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length(body) - F.length(F.translate(body, "0123456789", ""))).cast("long").alias("n_digits"),
        F.filter(F.split(body, "\n"), lambda x: F.length(F.translate(x, BLANK_CHARS, "")) > 0).alias("__lines"),
    )
    w = F.col("__w")
    rows = rows.select(
        *keep, "word_chars", "n_symbols", "n_digits",
        F.size(w).cast("long").alias("n_words"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.when(
            F.size(w) >= 4,
            F.transform(
                F.sequence(F.lit(0), F.size(w) - 3),
                lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
            ),
        ).alias("__h"),
    )
    rows = rows.withColumn(
        "__s",
        F.when(
            F.size("__h") > F.size(F.array_distinct("__h")),
            F.sort_array(F.transform("__h", lambda x, i: F.struct(x.alias("h"), i.alias("p")))),
        ),
    )
    s = F.col("__s")
    repeated = F.transform(
        s,
        lambda x, i: F.when(
            F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)),
            x["p"],
        ),
    )
    places = F.sort_array(F.filter(repeated, lambda p: p.isNotNull()))
    covered = F.aggregate(
        places,
        F.struct(F.lit(-3).alias("at"), F.lit(0).alias("n")),
        lambda a, p: F.struct(p.alias("at"), (a["n"] + F.least(F.lit(3), p - a["at"])).alias("n")),
        lambda a: a["n"],
    )
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("__h", "__s")


def features() -> dict[str, Column]:
    """What rules may ask, from the columns of text_statistics()."""
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "n_words": F.col("n_words").cast("double"),
        "word_length": F.col("word_chars") / words,
        "symbol_share": F.col("n_symbols") / chars,
        "dup_line_share": F.col("n_dup_lines") / words,
        "repeat_share": F.col("n_repeat_words") / words,
        "digit_share": F.col("n_digits") / chars,
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    limit: float

    def holds(self, row: dict) -> bool:
        return row[self.feature] >= self.limit if self.above else row[self.feature] <= self.limit

    def column(self) -> Column:
        value = features()[self.feature]
        return value >= self.limit if self.above else value <= self.limit

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<='} {self.limit:g}"


Rule = tuple[Condition, ...]


def _covered(rows: list[dict], rule: Rule) -> list[dict]:
    return [r for r in rows if all(c.holds(r) for c in rule)]


def _purity(rows: list[dict]) -> tuple[int, int]:
    bad = sum(r["bad"] for r in rows)
    return bad, len(rows) - bad


def _grown(rows: list[dict], cuts: dict[str, list[float]]) -> Rule:
    rule: Rule = ()
    inside = rows
    while len(rule) < CONDITIONS:
        p, n = _purity(inside)
        if not p or not n:
            break
        before, best = math.log2(p / (p + n)), (0.0, None)
        for name, limits in cuts.items():
            ordered = sorted((r[name], r["bad"]) for r in inside)
            total_bad, total = p, p + n
            below_bad = below = i = 0
            for limit in limits:
                strict_bad, strict = below_bad, below
                while i < len(ordered) and ordered[i][0] < limit:
                    below_bad += ordered[i][1]
                    below += 1
                    i += 1
                strict_bad, strict = below_bad, below
                j, upto_bad, upto = i, strict_bad, strict
                while j < len(ordered) and ordered[j][0] <= limit:
                    upto_bad += ordered[j][1]
                    upto += 1
                    j += 1
                for above, a, b in ((True, total_bad - strict_bad, total - strict), (False, upto_bad, upto)):
                    if a and b < total:
                        gain = a * (math.log2(a / b) - before)
                        if gain > best[0] + 1e-9:
                            best = (gain, Condition(name, above, limit))
        if best[1] is None:
            break
        rule += (best[1],)
        inside = _covered(inside, rule)
    return rule


def learn(rows: list[dict]) -> list[Rule]:
    """Ordered rules for bad rows. A row has the features, ``bad`` (0 or 1) and ``fold``
    (0, 1: grow, 2: prune). No rows, or one class only, give no rules."""
    cuts = {}
    for name in FEATURES:
        values = sorted(r[name] for r in rows)
        if values:
            picked = {values[min(len(values) - 1, i * len(values) // CUTS)] for i in range(CUTS + 1)}
            cuts[name] = sorted(picked)
    grow, prune = [r for r in rows if r["fold"] < 2], [r for r in rows if r["fold"] == 2]
    rules: list[Rule] = []
    while len(rules) < RULES:
        rule = _grown(grow, cuts)
        if not rule:
            break

        def worth(candidate: Rule) -> tuple[float, int]:
            p, n = _purity(_covered(prune, candidate))
            return ((p + 1) / (p + n + 2), -len(candidate))

        rule = max((rule[:k] for k in range(1, len(rule) + 1)), key=worth)
        p, n = _purity(_covered(prune, rule))
        if p + n < SUPPORT or p < PRECISION * (p + n):
            break
        rules.append(rule)
        grow = [r for r in grow if not all(c.holds(r) for c in rule)]
        prune = [r for r in prune if not all(c.holds(r) for c in rule)]
    return rules


def decision(rules: list[Rule]) -> Column:
    """True to keep: the first rule that holds rejects."""
    out = None
    for rule in rules:
        holds = rule[0].column()
        for c in rule[1:]:
            holds = holds & c.column()
        out = F.when(holds, F.lit(False)) if out is None else out.when(holds, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def learned(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[Rule]:
    """Rules from the labelled rows of ``docs``; labels without a quality are left out."""
    chance = F.xxhash64("doc_id")
    chosen = (
        labels.filter("quality is not null and doc_id is not null")
        .select("doc_id", "quality", chance.alias("_chance"))
        .orderBy("_chance", "quality")
        .limit(sample)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most ``sample`` rows
    known = text_statistics(rows).select(
        *[c.alias(n) for n, c in features().items()],
        (F.col("quality") == 0).cast("int").alias("bad"),
        F.pmod("_chance", F.lit(3)).cast("int").alias("fold"),
    )
    return learn([r.asDict() for r in known.collect()])


def judged(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """Every row with its statistics, ``base_failed`` and ``kept``."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return text_statistics(docs).withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & decision(rules)
    )
