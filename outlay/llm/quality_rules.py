"""Operator 1, quality rules: a rule bitmask ledger. DataFrame functions only.

Every rule is evaluated once per document. The ledger row keeps the
measurements and one failure bit per rule. A policy is a version, a name and
a bit mask; applying it is one bitwise AND, so a new policy never reads the
texts again. Ablations come from the histogram of failure masks, which has at
most 2^rules rows whatever the corpus holds.

Defined cases: a NULL or empty text has no words, all measurements are 0 and
``few_words`` fails; NULL ids are kept as they are; repeated rows are judged
one by one; an empty table gives an empty ledger. The current policy weighs repeated lines by the
words in them, so a short line at head and foot does not reject a long text.
Input columns other than the id and the text are not read, so clashing names
do no harm. A text is one row's work: arrays of its words, one 64-bit hash per
5-word window, one sort only if a window repeats.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, let, text_or_empty, words_of

WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """``fails`` is a SQL condition over the measurement columns; the rule owns bit ``bit``."""
    bit: int
    name: str
    fails: str


#: Thresholds per word, line or character; ratios are integer so that no rounding decides.
RULES = (
    Rule(0, "few_words", "n_words < 10"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > 3 * n_words"),
    Rule(3, "repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule(4, "shouting", "5 * n_upper > 2 * word_chars"),
    Rule(5, "word_length", "word_chars > 20 * n_words OR word_chars < 2 * n_words"),
    Rule(6, "repeated_line_words", "10 * n_dup_words > 3 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    version: int
    name: str
    rules: tuple[str, ...]

    def mask(self, rules: tuple[Rule, ...] = RULES) -> int:
        return sum(1 << r.bit for r in rules if r.name in self.rules)


BASE = Policy(1, "base", ("few_words", "repeated_windows"))
FULL = Policy(2, "full", ("few_words", "repeated_windows", "symbols", "repeated_lines", "shouting", "word_length"))
#: As ``FULL``, but repeated lines weigh by the words in them. A published version never changes; a change is a new one.
WEIGHED = Policy(3, "weighed", ("few_words", "repeated_windows", "symbols", "repeated_line_words", "shouting", "word_length"))
POLICIES = (BASE, FULL, WEIGHED)
CURRENT = WEIGHED


def _windows(words: Column) -> Column:
    """One hash per window of WINDOW words, in order."""
    return F.when(F.size(words) >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(WINDOW)])
    )).otherwise(F.array().cast("array<bigint>"))


def _covered(hashes: Column) -> Column:
    """Words inside windows that are found twice or more; sorts (hash, position) once."""
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeated = let(pairs, lambda s: F.transform(
        F.filter(s, lambda x, k: (F.get(s, k - 1)["h"].eqNullSafe(x["h"]))
                 | (F.get(s, k + 1)["h"].eqNullSafe(x["h"]))),
        lambda x: x["i"]))
    starts = F.sort_array(repeated)
    return let(starts, lambda s: F.aggregate(
        F.transform(s, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(s, k + 1) - p, F.lit(WINDOW)))),
        F.lit(0).cast("bigint"), lambda a, x: a + x))


def measure(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the measurements of each text (all long)."""
    base = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(F.col(text)).alias("__t"))
    base = base.withColumns({
        "__w": words_of(F.col("__t")),
        "__l": F.filter(F.split("__t", "\n", -1), lambda x: F.length(F.regexp_replace(x, SPACES, "")) > 0),
    })
    n_words = F.size("__w")
    repeats = let(_windows(F.col("__w")), lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(_covered(h)))
    n_dup_lines = F.size("__l") - F.size(F.array_distinct("__l"))
    out = {
        "n_words": n_words,
        "word_chars": F.length(F.array_join("__w", "")),
        "n_symbols": F.regexp_count("__t", F.lit(r"[#*$%&|<>]")),
        "n_dup_lines": n_dup_lines,
        "n_repeat_words": repeats,
        "n_lines": F.size("__l"),
        "n_upper": F.regexp_count("__t", F.lit(r"\p{Lu}")),
        "n_dup_words": F.when(n_dup_lines > 0, n_words - F.size(words_of(F.array_join(F.array_distinct("__l"), "\n"))))
        .otherwise(0),
    }
    return base.select("doc_id", *[c.cast("bigint").alias(k) for k, c in out.items()])


def ledger(docs: DataFrame, rules: tuple[Rule, ...] = RULES, doc_id: str = "doc_id",
           text: str = "text") -> DataFrame:
    """Measurements and ``fail_bits``: bit r is set when rule r fails. One pass, no shuffle."""
    bits = F.lit(0).cast("bigint")
    for r in rules:
        bits = bits.bitwiseOR(F.when(F.expr(r.fails), F.lit(1 << r.bit).cast("bigint")).otherwise(F.lit(0)))
    return measure(docs, doc_id, text).withColumn("fail_bits", bits)


def verdict(policy: Policy, rules: tuple[Rule, ...] = RULES) -> Column:
    """True where no rule of the policy has failed."""
    return F.col("fail_bits").bitwiseAND(F.lit(policy.mask(rules)).cast("bigint")) == 0


def ablations(rows: DataFrame, policies: tuple[Policy, ...] = POLICIES,
              rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per policy and rule: documents kept, failing the rule, failing it alone, and kept without it."""
    masks = rows.groupBy("fail_bits").agg(F.count("*").alias("n"))
    grid = F.array(*[F.struct(F.lit(p.version).alias("version"), F.lit(p.name).alias("policy"),
                              F.lit(p.mask(rules)).cast("bigint").alias("mask"), F.lit(r.name).alias("rule"),
                              F.lit(1 << r.bit).cast("bigint").alias("bit"))
                     for p in policies for r in rules if r.name in p.rules])
    hit = F.col("fail_bits").bitwiseAND(F.col("g.mask"))
    count = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    return (masks.withColumn("g", F.explode(grid))
            .groupBy(F.col("g.version").alias("version"), F.col("g.policy").alias("policy"),
                     F.col("g.rule").alias("rule"))
            .agg(count(hit == 0).alias("kept"),
                 count(hit.bitwiseAND(F.col("g.bit")) != 0).alias("failing"),
                 count(hit == F.col("g.bit")).alias("failing_alone"),
                 count((hit == 0) | (hit == F.col("g.bit"))).alias("kept_without")))


def keep(docs: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """Rows of ``docs`` that pass the policy, all columns unchanged."""
    row = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc_id"), docs["text"].alias("text"))
    # a generated column: a filter on it is not moved below the ledger, where it would measure a text again per rule
    judged = ledger(row).select("doc_id", F.explode(F.array(verdict(policy))).alias("__kept"))
    return judged.filter("__kept").select("doc_id.*")
