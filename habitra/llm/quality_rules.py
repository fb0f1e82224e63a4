"""Operator 10: quality rules as a bitmask ledger, in DataFrame functions only.

``ledger`` evaluates every rule once for each text and stores the measurements
and one integer whose bit k says that rule k fails.  Policies are versions of a
mask: ``apply_policy`` and ``ablations`` only look at bits, so a new policy or a
study of its rules never reads texts again.  No shuffle but for ablations, which
add up counts by mask: at most 2 to the number of rules rows.

Cases: a null text has no words, like the empty one, and fails ``few_words``; a
null doc_id stays null; repeated rows give a row each; a text of any length is
measured whole, in time n log n; an empty table gives an empty result.  Other
columns of the input are left out of the ledger.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from habitra.llm.common import text_of

#: White space and symbols of the measurements.
SPACE = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")

#: Rule k fails where its condition over the measurements holds; bit k of the mask.
RULES: dict[str, Callable[[Callable[[str], Column]], Column]] = {
    "few_words": lambda m: m("n_words") < 50,
    "repeated_words": lambda m: 100 * m("n_repeat_words") > 50 * m("n_words"),
    "many_symbols": lambda m: 5 * m("n_symbols") > m("n_words"),
    "repeated_lines": lambda m: (m("n_lines") >= 4) & (2 * m("n_dup_lines") > m("n_lines")),
    "short_words": lambda m: m("word_chars") < 2 * m("n_words"),
    "long_words": lambda m: m("word_chars") > 20 * m("n_words"),
}
#: Versions of the policy: the rules that reject a text.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "many_symbols", "repeated_lines", "short_words", "long_words"),
}


def mask_of(policy: str | tuple[str, ...]) -> int:
    """The mask of a policy's version or of rules."""
    return sum(1 << list(RULES).index(r) for r in (POLICIES[policy] if isinstance(policy, str) else policy))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, evaluated once though the body uses it for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _without(text: Column, signs: str) -> Column:
    return F.translate(text, signs, "")


def _repeat_words(words: Column) -> Column:
    """Words that lie in a window of three found twice or more: windows sorted by hash, equal neighbours kept, places joined."""
    n = F.size(words)
    windows = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")))

    def repeated(s: Column) -> Column:
        near = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
        return F.array_sort(F.transform(F.filter(s, lambda x, k: near(x, k - 1) | near(x, k + 1)), lambda x: x["i"]))

    places = _let(F.array_sort(windows), repeated)
    start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
    covered = F.aggregate(places, start, lambda a, x: F.struct((a["n"] + F.least(F.lit(3), x - a["last"])).alias("n"), x.alias("last")), lambda a: a["n"])
    return F.when(n < 4, F.lit(0)).otherwise(covered)


def measurements(text: Column) -> Column:
    """All measurements of a text (not null) as a struct of longs."""

    def by_words(w: Column) -> Column:
        lines = F.filter(F.split(text, "\n"), lambda x: _without(x, SPACE) != "")
        dup = _let(lines, lambda x: F.struct((F.size(x) - F.size(F.array_distinct(x))).alias("d"), F.size(x).alias("n")))
        values = (F.size(w), F.length(_without(text, SPACE)), F.length(text) - F.length(_without(text, SYMBOLS)), dup["d"], _repeat_words(w), dup["n"])
        return F.struct(*[v.cast("long").alias(k) for k, v in zip(MEASURES, values)])

    return _let(F.filter(F.split(text, SPACE_RUN), lambda x: x != ""), by_words)


def failures(m: Column) -> Column:
    """The mask of failed rules, given the struct of measurements."""
    bits = [F.when(rule(lambda k: m[k]), F.lit(1 << k)).otherwise(F.lit(0)) for k, rule in enumerate(RULES.values())]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return total


def ledger(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the measurements and ``failed`` (the mask) of every text."""
    measured = text_of(df, id_col, text_col).select("doc_id", measurements(F.col("text")).alias("m"))
    return measured.select("doc_id", "m.*", failures(F.col("m")).alias("failed"))


def apply_policy(rows: DataFrame, policy: str | tuple[str, ...] = "v1") -> DataFrame:
    """The ledger with ``kept``: no rule of the policy fails."""
    return rows.withColumn("kept", F.col("failed").bitwiseAND(F.lit(mask_of(policy))) == 0)


def ablations(rows: DataFrame, policy: str | tuple[str, ...] = "v1") -> DataFrame:
    """For each rule of the policy: texts that fail it, that fail it alone, and that would be kept without it."""
    mask = mask_of(policy)
    by_mask = rows.groupBy(F.col("failed").bitwiseAND(F.lit(mask)).alias("failed")).agg(F.count("*").alias("n"))
    chosen = [(k, name) for k, name in enumerate(RULES) if mask >> k & 1]
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(1 << k).alias("bit")) for k, name in chosen])).alias("r")
    n_if = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).alias
    bit = F.col("r.bit")
    return by_mask.select("failed", "n", each).groupBy(F.col("r.rule").alias("rule")).agg(
        n_if(F.col("failed").bitwiseAND(bit) != 0)("n_failed"), n_if(F.col("failed") == bit)("n_only"), n_if(F.col("failed").bitwiseAND(F.bitwise_not(bit)) == 0)("n_kept_without")
    )


def keep(df: DataFrame, policy: str | tuple[str, ...] = "v1", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, whose text the policy keeps."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return df.where(failures_of(text).bitwiseAND(F.lit(mask_of(policy))) == 0)


def failures_of(text: Column) -> Column:
    """The mask of a text."""
    return _let(measurements(text), failures)
