"""Column functions on answer texts: facts, criteria and scores."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from headway.functions.scalars import fill, stripped

# Patterns of the scoring rules. Java needs (?U) for Unicode classes.
NUMBER_PATTERN = r"(?U)(\b\d[\d,]*\.?\d*\b)"
DEMAND_VERBS = (
    "mention|state|explain|identify|list|note|confirm|distinguish|define|contrast|calculate"
)
DEMAND_PATTERN = rf"(?iU)^Must\s+(?:{DEMAND_VERBS})\s*:?\s*"
AT_LEAST_PATTERN = r"(?iU)at least (\d+) of:?\s*"
TERM_BREAK = r"(?U),\s*|\s+and\s+|\s+or\s+"
TOKEN = r"[a-z0-9]+"

# Fixed value: weights of ROUGE-L, keyword and criteria scores.
SCORE_WEIGHTS = (0.4, 0.3, 0.3)

# Verdicts on the difference of two overall scores.
VERDICTS = (
    (0.05, "{candidate} significantly outperforms the {base}."),
    (0.0, "{candidate} slightly outperforms the {base}."),
    (-0.05, "Performance is roughly equivalent."),
    (None, "The {base} outperforms {candidate}."),
)

# Fixed value: layout of one chat message in a training text.
CHAT_MESSAGE = "<|im_start|>{role}\n{content}<|im_end|>\n"


def numbers_in(text: Column) -> Column:
    """The distinct numbers of a text, thousands separators removed."""
    plain = F.regexp_replace(text, ",", "")
    return F.array_distinct(F.regexp_extract_all(plain, F.lit(NUMBER_PATTERN), 1))


def keyword_match(expected: Column, generated: Column) -> Column:
    """Share of the expected numbers found in the answer; 1 where none is expected."""
    wanted = numbers_in(F.coalesce(expected, F.lit("")))
    found = F.array_intersect(wanted, numbers_in(F.coalesce(generated, F.lit(""))))
    return F.when(F.size(wanted) == 0, 1.0).otherwise(
        F.try_divide(F.size(found).cast("double"), F.size(wanted))
    )


def _demands(criteria: Column) -> Column:
    return F.regexp_replace(criteria, DEMAND_PATTERN, "")


def criteria_minimum(criteria: Column) -> Column:
    """N of an ``at least N of`` rule, else NULL."""
    return F.regexp_extract(_demands(criteria), AT_LEAST_PATTERN, 1).try_cast("int")


def criteria_terms(criteria: Column) -> Column:
    """The phrases an answer must contain."""
    demands = _demands(criteria)
    # what follows the first "at least N of"; the whole text where there is none
    phrases = F.regexp_replace(demands, r"(?s)^.*?" + AT_LEAST_PATTERN, "")
    pieces = F.transform(F.split(phrases, TERM_BREAK), stripped)
    kept = F.filter(pieces, lambda p: F.length(p) > 1)
    return F.transform(kept, lambda p: F.btrim(p, F.lit("()")))


def criteria_match(criteria: Column, generated: Column) -> Column:
    """Share of the phrases found; with a minimum, 1 once that many are found."""
    answer = F.lower(generated)

    # one walk over the phrases: a column used twice, unless cheap, is taken apart twice
    def count(so_far: Column, term: Column) -> Column:
        hit = F.when(F.contains(answer, F.lower(term)), 1).otherwise(0)
        return F.struct(
            (so_far["n"] + 1).alias("n"),
            (so_far["hits"] + hit).alias("hits"),
            so_far["minimum"].alias("minimum"),
        )

    def share(found: Column) -> Column:
        need = F.coalesce(found["minimum"], found["n"])
        return (
            F.when(found["n"] == 0, 0.0)
            .when(found["hits"] >= need, 1.0)
            .otherwise(F.try_divide(found["hits"].cast("double"), need))
        )

    none = F.struct(
        F.lit(0).alias("n"), F.lit(0).alias("hits"), criteria_minimum(criteria).alias("minimum")
    )
    given = (F.coalesce(criteria, F.lit("")) != "") & (F.coalesce(generated, F.lit("")) != "")
    return F.when(given, F.aggregate(criteria_terms(criteria), none, count, share)).otherwise(0.0)


def tokens(text: Column) -> Column:
    """Lower-case letter and digit runs."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), 0)


def _common_length(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence of two token lists.

    Common ends are taken off first. Bit i of ``gaps`` is cleared when the i-th token of ``a``
    ends a longer match, so one addition on a len(a)-bit number handles a whole row of the
    usual table.
    """
    start, end = 0, min(len(a), len(b))
    while start < end and a[start] == b[start]:
        start += 1
    back, most = 0, end - start
    while back < most and a[-1 - back] == b[-1 - back]:
        back += 1
    a, b = a[start : len(a) - back], b[start : len(b) - back]
    where: dict[int, int] = {}
    for i, token in enumerate(a):
        where[token] = where.get(token, 0) | (1 << i)
    full = (1 << len(a)) - 1
    gaps = full
    for token in b:
        places = where.get(token)
        if places:
            matches = gaps & places
            gaps = ((gaps + matches) | (gaps - matches)) & full
    return start + back + len(a) - gaps.bit_count()


def _numbered(*sides: pa.Array) -> list[list[list[int]]]:
    """Token lists as lists of numbers, the same for equal tokens; a NULL list is empty.

    Numbered by Arrow, because a Python string per token costs more than the comparison.
    """
    tokens = pa.concat_arrays([side.flatten() for side in sides])
    numbers = tokens.dictionary_encode(null_encoding="encode").indices.to_numpy().tolist()
    lengths = [side.value_lengths().fill_null(0).to_numpy() for side in sides]
    ends = np.cumsum(np.concatenate([[0], *lengths])).tolist()
    lists = [numbers[start:end] for start, end in zip(ends, ends[1:])]
    cuts = np.cumsum([0, *map(len, sides)]).tolist()
    return [lists[start:end] for start, end in zip(cuts, cuts[1:])]


def common_length(a: Column, b: Column) -> Column:
    """Longest common subsequence of two token arrays (Arrow batches).

    Equal arrays and arrays without a common token are told by the JVM; only the others are
    sent to Python.
    """

    @F.arrow_udf("int")
    def lcs(left: pa.Array, right: pa.Array) -> pa.Array:
        # lists that are not sent are NULL; the column around does not read their length
        return pa.array([_common_length(x, y) for x, y in zip(*_numbered(left, right))], pa.int32())

    hard = (a != b) & F.coalesce(F.arrays_overlap(a, b), F.lit(False))
    sent = lcs(F.when(hard, a), F.when(hard, b))
    return F.when(a == b, F.size(a)).when(hard, sent).when(a.isNotNull() & b.isNotNull(), 0)


def rouge_l(expected_tokens: Column, generated_tokens: Column) -> Column:
    """F1 of the longest common token subsequence; 0 for an empty side.

    Takes token arrays, so a caller may stem tokens first.
    """
    return rouge_from_common(
        common_length(expected_tokens, generated_tokens),
        F.size(expected_tokens),
        F.size(generated_tokens),
    )


def rouge_from_common(common: Column, n_expected: Column, n_generated: Column) -> Column:
    # 2PR / (P + R) with P = common / generated and R = common / expected
    both = (n_expected + n_generated).cast("double")
    return F.coalesce(F.try_divide(2 * common.cast("double"), both), F.lit(0.0))


def combined_score(
    rouge: Column, keyword: Column, criteria: Column, weights=SCORE_WEIGHTS
) -> Column:
    return weights[0] * rouge + weights[1] * keyword + weights[2] * criteria


def verdict(delta: Column, base: str = "base model", candidate: str = "candidate") -> Column:
    """Statement on a score difference (candidate minus base)."""
    (_, last) = VERDICTS[-1]
    result = F.lit(last.format(base=base, candidate=candidate))
    for bound, text in reversed(VERDICTS[:-1]):
        result = F.when(delta > bound, text.format(base=base, candidate=candidate)).otherwise(
            result
        )
    return result


def token_count(text: Column) -> Column:
    """Words between whitespace."""
    words = F.split(F.coalesce(text, F.lit("")), r"(?U)\s+")
    return F.size(F.filter(words, lambda w: w != ""))


def render_chat(system: Column, user: Column, assistant: Column) -> Column:
    """One training text of a system prompt, a question and its answer."""
    turns = (("system", system), ("user", user), ("assistant", assistant))
    return F.concat(
        *[fill(CHAT_MESSAGE, role=F.lit(role), content=content) for role, content in turns]
    )


def claimed_count(text: Column, noun: str, before: str = "") -> Column:
    """First number stated in front of a noun, ``1,234 stops`` giving 1234."""
    lead = rf"{before}\s+" if before else ""
    digits = F.regexp_extract(text, rf"(?U){lead}(\d[\d,]*)\s+{noun}", 1)
    return F.regexp_replace(digits, ",", "").try_cast("bigint")
