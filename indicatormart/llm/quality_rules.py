"""Quality rules as weak supervision: votes, expectation-maximisation, posterior probability.

Each rule votes good (1), bad (-1) or abstains (0) on a document.  A two-class
model with one vote distribution per rule and class is fitted to the counts of
vote patterns by expectation-maximisation; a document's posterior probability
of being good replaces the usual filter that all rules must pass.  A rule's
accuracy is learned from its agreement with the other rules: a bad vote that
others do not share counts little, and can be overruled.  Everything runs as
DataFrame expressions; the patterns are at most 3 to the number of rules, and
the driver sees one row per rule and vote in each round.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicatormart.llm._native import count_of, words
from indicatormart.llm._tables import same_row, small, written


class Rule(NamedTuple):
    """SQL conditions over the measures of ``measures``; neither true: the rule abstains."""
    name: str
    bad: str
    good: str


RULES = (
    Rule("length", "n_words < 50", "n_words >= 80"),
    Rule("word_length", "word_chars < 2.5 * n_words or word_chars > 12 * n_words",
         "word_chars between 3 * n_words and 9 * n_words"),
    Rule("symbols", "n_symbols > 0.1 * n_words", "n_symbols <= 0.03 * n_words"),
    Rule("alphanumerics", "n_alnum < 0.88 * word_chars", "n_alnum >= 0.93 * word_chars"),
    Rule("capitals", "n_capitals > 0.3 * word_chars", "n_capitals < 0.12 * word_chars"),
    Rule("exclamations", "n_exclaims > 0.1 * n_words", "n_exclaims <= 0.03 * n_words"),
    Rule("repeated_words", "n_repeat_words > 0.4 * n_words", "n_repeat_words <= 0.2 * n_words"),
    Rule("repeated_lines", "n_dup_lines > 1 and n_dup_lines > 0.3 * n_lines", "n_dup_lines <= 0.1 * n_lines"),
    Rule("variety", "n_distinct < 0.1 * least(n_words, 1000)", "n_distinct > 0.3 * least(n_words, 1000)"),
    Rule("sentences", "n_ended < 0.1 * n_lines", "n_ended >= 0.5 * n_lines"),
)

#: Votes that each class is taken to have cast before any are counted (bad, abstain, good), and its documents.
#: The fit starts from them, which tells the classes apart: the bad class is the one with more bad votes.
PRIOR = {"good": (0.5, 2.0, 17.5), "bad": (4.0, 4.0, 12.0)}
PRIOR_DOCUMENTS = (8.0, 2.0)
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
KEEP_FROM = 0.5
#: Rounds of expectation-maximisation at most, and the change of every probability at which it ends sooner.
ROUNDS = 60
SETTLED = 1e-7


def _repeat_words(w: Column, n: Column) -> Column:
    """Words inside 3-word windows that occur at least twice.

    Window hashes are sorted with their position in the low bits, so equal
    windows are neighbours; neighbours with equal hash bits are compared by
    their words.
    """
    bits = F.length(F.bin(n))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
    keyed = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(
        F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).bitwiseAND(F.bitwise_not(mask)).bitwiseOR(i.cast("long")))
    return F.when(n >= 3, F.sort_array(keyed)).otherwise(F.array().cast("array<bigint>"))


def _twice(w: Column, ranked: Column, n: Column) -> Column:
    bits = F.length(F.bin(n))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1

    def equal(x: Column, y: Column) -> Column:
        i, j = x.bitwiseAND(mask).cast("int"), y.bitwiseAND(mask).cast("int")
        return F.coalesce(
            (F.call_function("shiftrightunsigned", x.bitwiseXOR(y), bits) == 0) & (F.get(w, i) == F.get(w, j))
            & (F.get(w, i + 1) == F.get(w, j + 1)) & (F.get(w, i + 2) == F.get(w, j + 2)), F.lit(False))

    found = F.filter(ranked, lambda x, j: equal(x, F.get(ranked, j - 1)) | equal(x, F.get(ranked, j + 1)))
    return F.sort_array(F.transform(found, lambda x: x.bitwiseAND(mask)))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text_key`` (a hash of the text) and the counts that the rules use, one row per document."""
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_key"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    cut = base.withColumns({"w": words(F.col("t")),
                            "l": F.filter(F.split("t", "\n"), lambda x: x.rlike("[^ \\t-\\r]"))})
    cut = cut.withColumn("n_words", F.size("w"))
    ranked = cut.withColumn("ranked", _repeat_words(F.col("w"), F.col("n_words")))
    at = ranked.withColumn("at", _twice(F.col("w"), F.col("ranked"), F.col("n_words")))
    n_repeat = F.aggregate(F.transform("at", lambda p, j: F.least(
        F.lit(3).cast("long"), F.coalesce(F.get("at", j + 1) - p, F.lit(3).cast("long")))),
        F.lit(0).cast("long"), lambda x, y: x + y)
    return at.select(
        "doc_id", "text_key", F.col("n_words").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        count_of(F.col("t"), "[^#*$%&|<>]").cast("long").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        n_repeat.alias("n_repeat_words"),
        count_of(F.col("t"), "[^\\p{L}\\p{M}\\p{N}]").cast("long").alias("n_alnum"),
        count_of(F.col("t"), "[^\\p{Lu}]").cast("long").alias("n_capitals"),
        count_of(F.col("t"), "[^!]").cast("long").alias("n_exclaims"),
        F.size("l").cast("long").alias("n_lines"),
        F.size(F.filter("l", lambda x: x.rlike("[.!?][\"')\\]]?[ \\t-\\r]*$"))).cast("long").alias("n_ended"),
        F.size(F.array_distinct("w")).cast("long").alias("n_distinct"))


def vote_columns(rules: Sequence[Rule] = RULES) -> Column:
    """Array of the votes, one per rule."""
    return F.array(*(F.when(F.expr(r.bad), F.lit(-1)).when(F.expr(r.good), F.lit(1)).otherwise(F.lit(0))
                     for r in rules))


def log_odds(votes: Column, weights: Sequence[float], bias: float) -> Column:
    """``bias`` plus the weight of each vote; ``weights`` has three numbers per rule (bad, abstain, good)."""
    table = F.lit([float(x) for x in weights])
    return F.aggregate(F.transform(votes, lambda v, j: F.get(table, j * 3 + v + 1)), F.lit(float(bias)),
                       lambda x, y: x + y)


def probability(odds: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


class VoteModel(NamedTuple):
    """Share of good documents, and per rule the vote probabilities (bad, abstain, good) of each class."""
    share: float
    good: list[list[float]]
    bad: list[list[float]]

    def posterior(self, votes: Column) -> Column:
        flat = [math.log(g) - math.log(b) for gs, bs in zip(self.good, self.bad, strict=True)
                for g, b in zip(gs, bs, strict=True)]
        return probability(log_odds(votes, flat, math.log(self.share) - math.log(1 - self.share)))


def _normal(counts: Sequence[float]) -> list[float]:
    total = sum(counts)
    return [c / total for c in counts]


def _fitted(counts: Mapping[tuple[int, int], tuple[float, float]], n_rules: int) -> VoteModel:
    """The model of ``{(rule, vote): (good, bad)}`` documents, on top of the prior ones."""
    votes = [[[p + counts.get((rule, vote), (0.0, 0.0))[c] for vote, p in zip((-1, 0, 1), PRIOR[name], strict=True)]
              for rule in range(n_rules)] for c, name in enumerate(("good", "bad"))]
    n_good, n_bad = (PRIOR_DOCUMENTS[c] + sum(counts.get((0, vote), (0.0, 0.0))[c] for vote in (-1, 0, 1))
                     for c in (0, 1))
    return VoteModel(n_good / (n_good + n_bad), *([_normal(x) for x in v] for v in votes))


def _change(a: VoteModel, b: VoteModel) -> float:
    flat = [[m.share] + [x for row in m.good + m.bad for x in row] for m in (a, b)]
    return max(abs(x - y) for x, y in zip(*flat, strict=True))


def fit_votes(votes: DataFrame, n_rules: int, column: str = "votes", rounds: int = ROUNDS) -> VoteModel:
    """Fit the model to the ``votes`` arrays by expectation-maximisation over vote patterns.

    It starts from the prior, where one bad vote is outweighed by good votes
    of the other rules, and ends after ``rounds`` or when no probability moves
    by more than ``SETTLED``.  Without votes the model is the prior.
    """
    patterns = written(votes.groupBy(column).agg(F.count("*").alias("n")), "vote_patterns")
    model = _fitted({}, n_rules)
    for _ in range(rounds):
        rows = patterns.withColumn("p", model.posterior(F.col(column))).select(
            "n", "p", F.posexplode(column).alias("rule", "vote")).groupBy("rule", "vote").agg(
            F.sum(F.col("n") * F.col("p")).alias("good"), F.sum(F.col("n") * (1 - F.col("p"))).alias("bad")).collect()
        before, model = model, _fitted({(r.rule, r.vote): (r.good, r.bad) for r in rows}, n_rules)
        if _change(before, model) <= SETTLED:
            break
    return model


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES,
          keep_from: float = KEEP_FROM, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: measures, votes, ``p_good``, ``base_failed`` and ``kept``.

    ``base_failed``: under 50 words, or over half of the words in repeated
    3-word windows; such documents are never kept.  The others are kept when
    the posterior is at least ``keep_from``; the model is fitted to them.  Null, empty and blank texts have
    no words and fail.  Very long texts are measured whole, within one row.
    Null ids, repeated rows and ties are judged row by row; other columns are
    ignored, whatever their names; an empty table gives no rows.
    """
    seen = written(measures(docs, id_col, text_col).withColumn("votes", vote_columns(rules)), "votes")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    model = fit_votes(seen.where(~failed), len(rules), rounds=rounds)
    return seen.withColumn("p_good", model.posterior(F.col("votes"))).withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("p_good") >= keep_from))


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns."""
    verdict = judge(docs, id_col, text_col, **options)
    out = written(verdict.where(~F.col("kept")).select(F.col("doc_id").alias("k_id"), F.col("text_key").alias("k_text"))
                  .distinct(), "rejected")
    out = small(out)
    return docs.join(out, same_row(docs, id_col, text_col, out), "left_anti")
