"""Mixing sources to target weights: iterative proportional fitting and calibrated sampling.

Tokens are counted by cell (source, language, topic).  Iterative proportional
fitting rakes a factor per cell until the expected tokens of the sample meet
the goals of the sources, the languages and the topics.  A document's sampling
probability is ``min(1, factor)``, and this bound is part of each raking step:
a value's step is the one at which its cells, bounded, give its goal.  A hash
of the id draws the documents.  ``margins`` reports what the sample reaches.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indicatormart.llm._native import words
from indicatormart.llm._tables import small, written

MARGINS = ("source", "lang", "topic")
#: Target share of a value: its tokens to this power, over all values.
POWERS = {"source": 0.7, "lang": 0.7, "topic": 0.7}
#: Topics in order of precedence: the first pattern that the text holds; else ``OTHER``.
TOPICS = (("legal", "[Ll]icen[sc]ed|[Cc]opyright"), ("contact", "@|https?://"), ("tabular", " [|] "))
OTHER = "prose"
SWEEPS = 15
#: Raking ends sooner when no probability moved by more than this in a sweep.
SETTLED = 1e-13
BUDGET = 0.5
SEED = "mix-1"


def topic_of(text: Column, topics: Sequence[tuple[str, str]] = TOPICS) -> Column:
    out = F.lit(OTHER)
    for name, pattern in reversed(topics):
        out = F.when(F.coalesce(text.rlike(pattern), F.lit(False)), F.lit(name)).otherwise(out)
    return out


def draw(id_col: Column, seed: str = SEED) -> Column:
    """A number in 0..1 that depends on the id and the seed only."""
    key = F.md5(F.concat(F.coalesce(id_col.cast("string"), F.lit("null")), F.lit(":" + seed)))
    return F.conv(F.substring(key, 1, 13), 16, 10).cast("double") / float(1 << 52)


def _value(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit("(none)"))


def count_cells(docs: DataFrame, id_col: str, text_col: str, source_col: str, lang_col: str,
                topics: Sequence[tuple[str, str]]) -> DataFrame:
    """Written ``(doc_id, source, lang, topic, n_tokens)`` per row."""
    return written(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), _value(F.col(source_col)).alias("source"),
        _value(F.col(lang_col)).alias("lang"), topic_of(F.col(text_col), topics).alias("topic"),
        F.size(words(F.col(text_col))).cast("long").alias("n_tokens")), "mix_documents")


def calibrate(cells: DataFrame, budget: float, rounds: int = 60) -> float:
    """The scale at which ``sum(tokens * min(1, scale * weight))`` is ``budget``, or all tokens if that is less."""
    scale = 0.0
    for _ in range(rounds):
        full = F.col("weight") * scale >= 1
        r = cells.agg(F.sum(F.when(full, F.col("tokens")).otherwise(0)).cast("double").alias("full"),
                      F.sum(F.when(~full, F.col("tokens") * F.col("weight")).otherwise(0.0)).alias("free")).first()
        if not r.free:
            return scale
        new = max(scale, (budget - r.full) / r.free)
        if new <= scale * (1 + 1e-15):
            return new
        scale = new
    return scale


def targets(cells: DataFrame, margin: str, wanted: Mapping[str, float] | None, power: float, budget: float) -> DataFrame:
    """Written ``(margin, wanted, goal)``: the share asked for and the tokens to reach.

    The shares are those given (other values get none), or powers of the token
    counts.  A value cannot give more tokens than it has: its goal ends there,
    and the others share what is left of ``budget`` in proportion.
    """
    totals = cells.groupBy(margin).agg(F.sum("tokens").cast("double").alias("tokens"))
    if wanted is None:
        raw = F.when(F.col("tokens") > 0, F.pow("tokens", F.lit(power))).otherwise(0.0)
    else:
        table = F.create_map(*(F.lit(x) for kv in wanted.items() for x in kv)) if wanted else F.create_map()
        raw = F.coalesce(F.try_element_at(table, F.col(margin)).cast("double"), F.lit(0.0))
    values = written(totals.withColumn("raw", raw).withColumn(
        "weight", F.when(F.col("tokens") > 0, F.col("raw") / F.col("tokens")).otherwise(0.0)), "targets")
    whole = values.agg(F.sum("raw")).first()[0] or 0.0
    scale = calibrate(values, budget)
    return written(values.select(
        margin, (F.col("raw") / whole if whole > 0 else F.lit(0.0)).alias("wanted"),
        (F.col("tokens") * F.least(F.lit(1.0), F.col("weight") * scale)).alias("goal")), "goals")


def _step(now: DataFrame, margin: str, goals: DataFrame) -> DataFrame:
    """``now`` with the factors of each value of ``margin`` multiplied so that its bounded cells give its goal.

    With the ``k`` largest factors of a value at the bound, the rest has to
    give what these leave of the goal; the step is the largest over all ``k``.
    """
    order = Window.partitionBy(margin).orderBy(F.desc("factor"), *MARGINS)
    full = F.coalesce(F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    free = F.sum(F.col("tokens") * F.col("factor")).over(order.rowsBetween(0, Window.unboundedFollowing))
    ratio = F.max(F.when(F.col("free") > 0, (F.col("goal") - F.col("full")) / F.col("free"))).over(
        Window.partitionBy(margin))
    return now.join(goals, margin).withColumns({"full": full, "free": free}).withColumn("ratio", ratio).select(
        *MARGINS, "tokens", (F.col("factor") * F.greatest(F.lit(0.0), F.coalesce("ratio", F.lit(1.0)))).alias("factor"))


def rake(cells: DataFrame, goals: Mapping[str, DataFrame], start: float = 1.0, sweeps: int = SWEEPS) -> DataFrame:
    """``cells`` (margins and ``tokens``) with the fitted ``factor``; margins are met in turn, ``sweeps`` times at most.

    A value without tokens keeps its factors.  Each sweep is written: plans
    stay small, and a lost executor repeats one sweep at most.
    """
    now = cells.withColumn("factor", F.lit(float(start)))
    goals = {margin: small(goal) for margin, goal in goals.items()}
    bounded = F.least(F.lit(1.0), F.col("factor"))
    for _ in range(sweeps):
        before = now.select(*MARGINS, bounded.alias("before"))
        for margin, goal in goals.items():
            now = _step(now, margin, goal)
        now = written(now, "raked")
        moved = now.join(before, list(MARGINS)).agg(F.max(F.abs(bounded - F.col("before")))).first()[0]
        if not moved or moved <= SETTLED:
            break
    return now


class Mixture(NamedTuple):
    """Rows with source, lang, topic, n_tokens; cells with tokens, weight, probability; goals per margin."""
    rows: DataFrame
    cells: DataFrame
    goals: dict[str, DataFrame]


def mixture(docs: DataFrame, wanted: Mapping[str, Mapping[str, float]] | None = None, budget: float = BUDGET,
            id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang",
            topics: Sequence[tuple[str, str]] = TOPICS, sweeps: int = SWEEPS) -> Mixture:
    """The fitted mixture; a cell's ``weight`` is its probability over the budget's share of all tokens."""
    rows = count_cells(docs, id_col, text_col, source_col, lang_col, topics)
    cells = written(rows.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens")), "cells")
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    goals = {m: targets(cells, m, (wanted or {}).get(m), POWERS[m], budget * total) for m in MARGINS}
    p = F.least(F.lit(1.0), F.col("factor"))
    raked = rake(cells, goals, budget, sweeps)
    return Mixture(rows, written(raked.select(*MARGINS, "tokens", (p / F.lit(float(budget))).alias("weight"),
                                              p.alias("probability")), "mix_cells"), goals)


def margins(found: Mixture) -> DataFrame:
    """``(margin, value, tokens, wanted, reachable, expected)``: shares of the sample asked for, possible and expected.

    ``wanted`` and ``reachable`` differ where a value has too few tokens;
    ``expected`` and ``reachable`` where the margins contradict each other.
    """
    out = None
    for m, goal in found.goals.items():
        have = found.cells.groupBy(m).agg(F.sum("tokens").alias("tokens"),
                                          F.sum(F.col("tokens") * F.col("probability")).alias("sample"))
        totals = have.join(goal, m).agg(F.sum("sample").alias("s"), F.sum("goal").alias("g")).first()
        one = have.join(goal, m).select(
            F.lit(m).alias("margin"), F.col(m).alias("value"), "tokens", "wanted",
            (F.col("goal") / F.lit(totals.g or 1.0)).alias("reachable"),
            (F.col("sample") / F.lit(totals.s or 1.0)).alias("expected"))
        out = one if out is None else out.unionAll(one)
    return out


def mix(docs: DataFrame, wanted: Mapping[str, Mapping[str, float]] | None = None, budget: float = BUDGET,
        id_col: str = "doc_id", text_col: str = "text", seed: str = SEED, **options) -> DataFrame:
    """``(doc_id, source, lang, topic, n_tokens, weight, probability, kept)`` per row of ``docs``.

    A null source or language is the value ``(none)``; a null, empty or blank
    text has no tokens and the topic ``prose``; a very long text counts whole;
    null ids share one draw, and repeated ids draw alike.  Other columns are
    ignored, whatever their names; an empty table gives no rows.
    """
    rows, cells, _ = mixture(docs, wanted, budget, id_col, text_col, **options)
    return rows.join(small(cells.drop("tokens")), list(MARGINS)).select(
        "doc_id", *MARGINS, "n_tokens", "weight", "probability",
        (draw(F.col("doc_id"), seed) < F.col("probability")).alias("kept"))


def keep_sample(docs: DataFrame, wanted: Mapping[str, Mapping[str, float]] | None = None, budget: float = BUDGET,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang",
                topics: Sequence[tuple[str, str]] = TOPICS, seed: str = SEED, **options) -> DataFrame:
    """The sampled rows of ``docs`` with all their columns."""
    cells = mixture(docs, wanted, budget, id_col, text_col, source_col, lang_col, topics, **options).cells
    cells = small(cells.select(*(F.col(m).alias(f"k_{m}") for m in MARGINS), F.col("probability").alias("k_p")))
    here = ((_value(docs[source_col]) == cells["k_source"]) & (_value(docs[lang_col]) == cells["k_lang"])
            & (topic_of(docs[text_col], topics) == cells["k_topic"])
            & (draw(docs[id_col].cast("long"), seed) < cells["k_p"]))
    return docs.join(cells, here, "left_semi")


def oracle(budget: float = BUDGET, sweeps: int = SWEEPS) -> str:
    """DuckDB SQL for ``mix`` with its default targets over the table ``documents``."""
    topic = "".join(f" when regexp_matches(coalesce(text, ''), '{p}') then '{n}'" for n, p in TOPICS)
    steps = [f"""d as materialized (select doc_id, coalesce(source, '(none)') as source, coalesce(lang, '(none)') as lang,
        case{topic} else '{OTHER}' end as topic,
        len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t-\\r]+'), lambda w: w <> '')) as n_tokens
        from documents)""",
             f"""w as materialized (select source, lang, topic, sum(n_tokens)::double as tokens, {budget}::double as factor
        from d group by all)""",
             f"whole as materialized (select {budget} * sum(tokens) as total from w)"]

    def ratio(table: str, by: str, factor: str, goal: str) -> str:
        """The step at which ``tokens * least(1, step * factor)`` sums to ``goal``."""
        part = f"partition by {by} " if by else ""
        return f"""(select {by + ',' if by else ''} max(case when free > 0 then (wanted - held) / free end) as ratio
            from (select *, {goal} as wanted, coalesce(sum(tokens) over ({part}order by {factor} desc
                    rows between unbounded preceding and 1 preceding), 0) as held,
                sum(tokens * {factor}) over ({part}order by {factor} desc rows between current row and unbounded following)
                    as free from {table}) {f'group by {by}' if by else ''})"""

    for m in MARGINS:
        steps.append(f"""v_{m} as materialized (select {m}, tokens, case when tokens > 0
            then pow(tokens, {POWERS[m]}) / tokens else 0 end as f from
            (select {m}, sum(tokens) as tokens from w group by {m}))""")
        steps.append(f"""g_{m} as materialized (select {m}, tokens * least(1.0, f * ratio) as goal
            from v_{m}, {ratio(f'v_{m}, whole', '', 'f', 'total')})""")
    last = "w"
    for k in range(sweeps):
        for m in MARGINS:
            now = f"w{k}_{m}"
            steps.append(f"""{now} as materialized (select source, lang, topic, tokens,
                factor * greatest(0.0, coalesce(ratio, 1.0)) as factor from {last}
                join {ratio(f'{last} join g_{m} using ({m})', m, 'factor', 'g_' + m + '.goal')} using ({m}))""")
            last = now
    draw_sql = f"""('0x' || substr(md5(coalesce(doc_id::varchar, 'null') || ':{SEED}'), 1, 13))::bigint / {1 << 52}.0"""
    return f"""with {', '.join(steps)}
        select doc_id, source, lang, topic, n_tokens::bigint as n_tokens, round(least(1.0, factor) / {budget}, 6) as weight,
        round(least(1.0, factor), 6) as probability, {draw_sql} < least(1.0, factor) as kept
        from d join {last} using (source, lang, topic)"""
