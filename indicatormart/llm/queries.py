"""One query per operator over its whole table, and DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicatormart.llm import (class_lm, decontaminate, licenses, line_dedup, mixing, negatives, passages, quality_rules,
                               ranking, runs, simhash, topk, warc)
from indicatormart.llm._native import words

Query = Callable[[SparkSession, str], DataFrame]

#: Contract of the SimHash query and of the pipeline's SimHash stage.
SIMHASH_SHINGLE, SIMHASH_BITS = 3, 3


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _crc(n: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.match_lines(_table(spark, sf_dir, "documents"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=SIMHASH_SHINGLE, max_bits=SIMHASH_BITS)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, _table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")


def op5_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = class_lm.log_probabilities(_table(spark, sf_dir, "documents"), _crc(7) != 2)
    return scored.select("doc_id", (_crc(7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", "n_shared", "n_shingles", F.round("containment", 6).alias("containment"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).withColumns(
        {c: F.round(c, 6) for c in ("weight", "probability")})


def op8_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(_table(spark, sf_dir, "documents"))


def op9_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), _crc(5) != 0) \
        .select("doc_id", (_crc(5) == 0).alias("held_out"), "score", "predicted")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents")).select(
        "doc_id", "license", "n_shared", "n_shingles", F.round("containment", 6).alias("containment"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    found = negatives.hard_negatives(rows.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % 100 == 0)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _planted(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` with the repeats of the contract: one document in ten goes on in the words from a, by period p."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    some = docs.select("doc_id", "text", F.floor(h / 10).cast("long").alias("g"),
                       F.when(h % 10 == 0, words(F.col("text"))).alias("w"))
    n = F.size("w").cast("long")
    some = some.withColumn("a", F.when(n > 0, F.col("g") % n))
    some = some.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)).cast("long"))
    old = F.sequence(F.lit(0), F.size("w") - 1)
    new = F.transform(old, lambda i: F.get("w", F.when(i < F.col("a"), i).otherwise(
        F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    return some.select("doc_id", F.when(F.size("w") > 0, F.array_join(new, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(_planted(_table(spark, sf_dir, "documents")))
    best = F.element_at(F.array_sort(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("l"), r["start"].alias("start"), r["period"].alias("period")))), 1)
    lines = F.transform("runs", lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))))
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    some = found.withColumn("best", F.when(F.size("runs") > 0, best))
    length = -F.col("best.l")
    return some.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        length.alias("length"), F.col("best.period").alias("period"),
        F.floor(length * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(text.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op13_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_line_dedup, op2_simhash_near_dedup, op3_warc, op4_quality_rules, op5_class_lm, op6_decontamination, op7_mixing,
    op8_passages, op9_ranking, op10_license_scan, op11_hard_negatives, op12_periodic_runs, op13_top_k, pipeline)}


# -- SQL ---------------------------------------------------------------------------------------

_WORDS = "list_filter(regexp_split_to_array(lower(coalesce({}, '')), '[ \\t-\\r]+'), lambda w: w <> '')"


def _grams(table: str, key: str, text: str) -> str:
    """Distinct 5-word shingles ``(key, gram)`` of a table, and their number."""
    return f"""(select distinct {key}, unnest(list_transform(range(1, len(w) - 3),
        lambda i: array_to_string(w[i:i + 4], ' '))) as gram
        from (select {key}, {_WORDS.format(text)} as w from {table}) where len(w) >= 5)"""


_OP3 = """with p as (select page_id, coalesce(html, '') as t, sha1(coalesce(html, '')) as h from pages),
    g as (select t, max(page_id) as best from p group by t)
    select page_id, strlen(p.t)::bigint as payload_bytes,
    array_to_string(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + (((('0x' || substr(h, (j // 4) * 5 + 1, 5))::int >> (15 - 5 * (j % 4))::int) & 31))::int, 1)), '')
        as payload_digest,
    case when page_id = best then 'response' else 'revisit' end as record_type,
    case when page_id = best then null else best end as refers_to from p join g using (t)"""

_OP6 = f"""with d as materialized {_grams('documents', 'doc_id', 'text')},
    b as materialized {_grams('benchmark', 'item_id', 'text')},
    q as (select item_id, count(*) as n_shingles from b group by item_id),
    m as (select doc_id, item_id, count(*) as n_shared from d join b using (gram) group by all)
    select doc_id, item_id, n_shared, n_shingles, round(n_shared / n_shingles, 6) as containment
    from m join q using (item_id) where n_shared >= 0.8 * n_shingles - 1e-9"""


def _op10() -> str:
    rows = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in sorted(licenses.TEMPLATES.items()))
    return f"""with templates(license, text) as (values {rows}),
        d as materialized {_grams('documents', 'doc_id', 'text')},
        b as materialized {_grams('templates', 'license', 'text')},
        q as (select license, count(*) as n_shingles from b group by license),
        m as (select doc_id, license, count(*) as n_shared from d join b using (gram) group by all)
        select doc_id, license, n_shared, n_shingles, round(n_shared / n_shingles, 6) as containment
        from m join q using (license) where n_shared >= 0.8 * n_shingles - 1e-9"""


#: Valid rows of ``embeddings`` with the vector's integers in ``q``.
_VECTORS = """v as materialized (select vec_id, label, list_transform(embedding, lambda x: floor(256 * x::double)) as q
    from embeddings where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0)"""

_OP11 = f"""with {_VECTORS},
    r as materialized (select vec_id, q, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label
        from v where label is not null),
    s as materialized (select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same,
        list_inner_product(a.q, b.q)::bigint as score
        from r a join r b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
    p as (select anchor_id, vec_id as positive_id, score as positive_score from s where same
        qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
    n as (select anchor_id, positive_id, vec_id as negative_id, positive_score, score as negative_score,
        row_number() over (partition by anchor_id, positive_id order by score desc, vec_id)::int as rank
        from p join s using (anchor_id)
        where not same and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score)
    select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= 5"""

_OP13 = f"""with {_VECTORS},
    s as (select a.vec_id as query_id, b.vec_id, list_inner_product(a.q, b.q)::bigint as score
        from v a join v b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id)
    select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
    from s qualify rank <= 5"""

ORACLE: dict[str, str] = {"op3_warc": _OP3, "op6_decontamination": _OP6, "op7_mixing": mixing.oracle(),
                          "op10_license_scan": _op10(), "op11_hard_negatives": _OP11, "op13_top_k": _OP13}
