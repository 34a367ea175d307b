"""Quality rules by weak supervision, with DataFrame functions only.

Rules look at a text's counts and vote good (1), bad (-1) or abstain (0).  Expectation
maximisation over the distinct vote patterns (at most 3 to the number of rules, whatever
the number of documents) estimates how often each rule is right on good and on bad
documents; a document is kept if its posterior probability of being good is 0.5 or more.
No rule decides alone, except the two base conditions.

Arrays of a whole text are bound to columns, or to variables of an outer ``transform``,
before a lambda reads them: an expression inside a lambda is evaluated once per element.
Every step is linear in the text, but for one sort of the windows' hashes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlake.llm._common import let, materialise

SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
# A word of letters or digits, with closing punctuation at most.
PLAIN_WORD = r"(?<![^\x20\x09-\x0D])[\p{L}\p{N}'’-]+[.,;:!?)]?(?![^\x20\x09-\x0D])"
MAX_ROUNDS, TOLERANCE = 60, 1e-6
# Accuracies begin here and are smoothed by so many votes each way.
START_GOOD, START_BAD, START_PRIOR, SMOOTH = 0.9, 0.6, 0.7, 1.0


def _share(part: str, of: str, low: int, high: int, low_vote: int = 1) -> Column:
    """Vote ``low_vote`` where part is at most ``low`` percent of ``of``, its opposite above ``high`` percent."""
    p, n = F.col(part) * 100, F.col(of)
    return F.when(n == 0, 0).when(p <= n * low, low_vote).when(p > n * high, -low_vote).otherwise(0)


def rules() -> dict[str, Column]:
    """Name and vote of every rule, over the columns of ``text_counts``."""
    n, ends, lines = F.col("n_words"), F.col("n_ends") * 100, F.col("n_lines")
    return {
        "symbols": _share("n_symbols", "n_words", 2, 10),
        "plain_words": _share("n_plain", "n_words", 60, 85, -1),
        "capitals": _share("n_capitals", "word_chars", 10, 30),
        "repeated_windows": _share("n_repeat_words", "n_words", 15, 40),
        "repeated_lines": F.when((F.col("n_dup_lines") == 0) & (lines >= 3), 1).when(F.col("n_dup_lines") * 100 > lines * 30, -1).otherwise(0),
        # Long texts say the same words again by nature, so the rule has no view on them.
        "vocabulary": F.when(n > 2000, 0).otherwise(_share("n_distinct", "n_words", 25, 40, -1)),
        "word_length": F.when(n == 0, 0).when(F.col("word_chars").between(n * 3, n * 9), 1).when(
            (F.col("word_chars") < n * 2) | (F.col("word_chars") > n * 14), -1).otherwise(0),
        "sentence_ends": F.when(n == 0, 0).when(ends.between(n * 3, n * 25), 1).when((ends > n * 40) | ((ends == 0) & (n >= 100)), -1).otherwise(0),
    }


def text_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, the base counts and those of the rules (longs).

    ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` are exact (windows are
    told apart by 64 hash bits within one text); a null or empty text has none of anything.
    """
    text = F.col("text")
    rows = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))

    def without(pattern: str) -> Column:
        return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")

    lines = F.split(text, "\n")
    worded = F.filter(lines, lambda x: F.length(F.btrim(x, F.lit(SPACE))) > 0)
    rows = rows.select(
        "doc_id", F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("w"), worded.alias("lines"),
        F.size(lines).cast("long").alias("n_lines"), without(WORD).alias("word_chars"), without(f"[{SYMBOLS}]+").alias("n_symbols"), without("[A-Z]+").alias("n_capitals"),
        without("[.!?]+").alias("n_ends"), F.regexp_count(text, F.lit(PLAIN_WORD)).cast("long").alias("n_plain"))
    n = F.size("w")
    triples = F.arrays_zip(F.col("w").alias("a"), F.slice("w", 2, F.greatest(n - 1, F.lit(1))).alias("b"), F.slice("w", 3, F.greatest(n - 2, F.lit(1))).alias("c"))
    # The last two entries lack a word; they are cut off after hashing.
    hashes = F.slice(F.transform(triples, lambda t: F.xxhash64(t["a"], t["b"], t["c"])), F.lit(1), F.greatest(n - 2, F.lit(0)))
    rows = rows.select(
        "doc_id", n.cast("long").alias("n_words"), "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), "n_lines",
        "n_capitals", "n_ends", "n_plain", F.size(F.array_distinct("w")).cast("long").alias("n_distinct"), hashes.alias("hashes"))
    repeats = F.size(F.array_distinct("hashes")) < F.size("hashes")
    ordered = F.when(repeats, F.sort_array(F.arrays_zip(F.col("hashes").alias("h"), F.sequence(F.lit(0), F.size("hashes") - 1).alias("at"))))
    rows = rows.withColumn("ordered", ordered)
    # In hash order an entry is repeated if a neighbour has the same hash.
    starts = let(F.col("ordered"), lambda o: F.transform(
        F.filter(o, lambda x, k: (x["h"] == F.get(o, k - 1)["h"]) | (x["h"] == F.get(o, k + 1)["h"])), lambda x: x["at"]))
    covered = F.array_distinct(F.flatten(F.transform("starts", lambda s: F.array(s, s + 1, s + 2))))
    rows = rows.withColumn("starts", starts)
    return rows.withColumn("n_repeat_words", F.coalesce(F.size(covered).cast("long"), F.lit(0))).drop("hashes", "ordered", "starts")


@dataclass(frozen=True)
class RuleModel:
    """P(good), and by rule P(vote good | voted, good) and P(vote bad | voted, bad)."""

    prior: float = START_PRIOR
    good: dict[str, float] = field(default_factory=dict)
    bad: dict[str, float] = field(default_factory=dict)

    def posterior(self) -> Column:
        """P(good) of a row by its vote columns (the prior, if every rule abstains)."""
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for name in self.good:
            g, b = self.good[name], self.bad[name]
            odds = odds + F.when(F.col(name) == 1, math.log(g / (1 - b))).when(F.col(name) == -1, math.log((1 - g) / b)).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


def fit_rules(votes: DataFrame, names: list[str]) -> RuleModel:
    """Estimate the model from vote columns of all documents (no rows: the starting values).

    Documents count once per pattern of votes, so a round is one small aggregate over at
    most 3**rules rows, whose sums (two per rule and class) reach the driver.
    """
    patterns = materialise(votes.groupBy(*names).agg(F.count("*").alias("n")), "rule-votes")
    model = RuleModel(START_PRIOR, dict.fromkeys(names, START_GOOD), dict.fromkeys(names, START_BAD))
    for _ in range(MAX_ROUNDS):
        p = patterns.withColumn("good", F.col("n") * model.posterior()).withColumn("bad", F.col("n") - F.col("good"))

        def total(c: Column | str) -> Column:
            return F.coalesce(F.sum(c), F.lit(0.0))

        s = p.agg(
            total("good").alias("good"), total("bad").alias("bad"),
            *[total(F.when(F.col(x) == 1, F.col("good"))).alias(f"gg_{x}") for x in names], *[total(F.when(F.col(x) != 0, F.col("good"))).alias(f"gv_{x}") for x in names],
            *[total(F.when(F.col(x) == -1, F.col("bad"))).alias(f"bb_{x}") for x in names], *[total(F.when(F.col(x) != 0, F.col("bad"))).alias(f"bv_{x}") for x in names]).first()
        if s["good"] + s["bad"] == 0:
            break
        new = RuleModel(
            (s["good"] + SMOOTH) / (s["good"] + s["bad"] + 2 * SMOOTH),
            {x: (s[f"gg_{x}"] + SMOOTH) / (s[f"gv_{x}"] + 2 * SMOOTH) for x in names},
            {x: (s[f"bb_{x}"] + SMOOTH) / (s[f"bv_{x}"] + 2 * SMOOTH) for x in names})
        # A rule may turn out to tell nothing, but its good vote never speaks against a text.
        new = RuleModel(new.prior, new.good, {x: max(new.bad[x], 1 - new.good[x]) for x in names})
        moved = max(abs(a - b) for a, b in zip([new.prior, *new.good.values(), *new.bad.values()], [model.prior, *model.good.values(), *model.bad.values()]))
        model = new
        if moved < TOLERANCE:
            break
    return model


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def judge_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: its counts, votes, ``base_failed``, ``posterior`` and ``kept``.

    Fitted on all rows of ``docs`` that pass the base conditions, whose verdict is open.
    Rows without an id are judged too; other columns are ignored; an empty table gives no rows.
    """
    names = list(rules())
    counts = materialise(text_counts(docs, id_col, text_col), "quality-counts")
    votes = counts.select("*", *[v.alias(k) for k, v in rules().items()])
    model = fit_rules(votes.where(~base_failed()), names)
    return votes.select("*", base_failed().alias("base_failed"), model.posterior().alias("posterior")).withColumn(
        "kept", ~F.col("base_failed") & (F.col("posterior") >= limit))
