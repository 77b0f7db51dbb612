"""The registered queries opN_<name>: each applies its operator to whole tables and derives the returned columns from it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import ann, bestfit, decontam, htmltext, infill, langid, minhash, packing, pii, quality, shared, tokencount, urlrules, whitening


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    shared.prepare_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return ann.neighbours(vectors, vectors.where("vec_id % 100 = 0"), k=10)


def op2_hierarchical_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return quality.scored(docs, labels, host=F.col("source"), path=F.concat_ws("/", "source", "lang"))


MIXTURE = 0.7  # a source weighs its tokens to this power, so small sources are in the first windows more than their share


def op3_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.packed(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), length=1024, power=MIXTURE)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source")


def op4_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.found_spans(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    number = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    counts = [number(kind).alias(f"n_{kind}") for kind in pii.BASE]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op5_merge_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = tokencount.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 2048)


def op6_compression_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    dictionaries = langid.learned_dictionaries(docs.where(~langid.held_out()))
    judged = langid.predicted(docs, dictionaries)
    return judged.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "margin", "rejected")


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), words=4)


def op8_qgram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


# Host, path and verdict of the rules.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op9_rarest_token_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = urlrules.listed(spark, URL_RULES).unionByName(urlrules.unwanted(spark))
    return urlrules.judged(_table(spark, sf_dir, "pages"), rules)


def op10_host_suffix_array_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.main_text(_table(spark, sf_dir, "pages"))


def op11_chunked_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = infill.infilled(_table(spark, sf_dir, "documents"))
    back = infill.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256")
    )


def op12_bin_completion_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = bestfit.packed(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), length=1024)
    return pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op13_lanczos_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(_table(spark, sf_dir, "embeddings"), components=8)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: run for name, run in globals().items() if name.startswith("op")}


def _url_sql() -> str:
    """op9 as a join of all URLs with all rules."""
    form = "'(?s)^.*?://([^/?#]*)([^?#]*)'"
    listed = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    own = ", ".join(f"('{name}:{t}', '{t}')" for name, tokens in urlrules.UNWANTED for t in tokens)
    return f"""
        WITH rules(h, p, v) AS (VALUES {listed}), own(name, token) AS (VALUES {own}),
        urls AS (
            SELECT row_number() OVER () AS n, page_id,
                   translate(regexp_extract(coalesce(url, ''), {form}, 1), '{urlrules.UPPER}', '{urlrules.LOWER}') AS host,
                   regexp_extract(coalesce(url, ''), {form}, 2) AS path
            FROM pages),
        best AS (
            SELECT n, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v FROM urls, rules
            WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY n),
        method AS (
            SELECT n, min(name) AS own_rule FROM urls, own WHERE regexp_matches(host, '(^|[.-])' || token || '[.-]') GROUP BY n)
        SELECT page_id, host, path, rule, own_rule, coalesce(v, CASE WHEN own_rule IS NULL THEN 'allow' ELSE 'block' END) AS verdict
        FROM urls LEFT JOIN best USING (n) LEFT JOIN method USING (n)"""


def _infill_sql() -> str:
    """op11 with the units as a list. The text comes back from the output by the places of the sentinels."""
    blank = r"\x20\x09-\x0D"
    return rf"""
        WITH given AS (
            SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS hashed,
                   regexp_extract_all(coalesce(text, ''), '[{blank}]*[^{blank}]+|[{blank}]+') AS units
            FROM documents),
        drawn AS (
            SELECT doc_id, text, units, len(units) AS n, ('0x' || hashed[1:8])::BIGINT % (len(units) + 1) AS one,
                   ('0x' || hashed[9:16])::BIGINT % (len(units) + 1) AS two,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                             OR ('0x' || hashed[17:24])::BIGINT % 100 >= 50 THEN 'plain'
                        WHEN ('0x' || hashed[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
            FROM given),
        cut AS (
            SELECT doc_id, text, n, form, coalesce(array_to_string(units[1 : least(one, two)], ''), '') AS p,
                   coalesce(array_to_string(units[least(one, two) + 1 : greatest(one, two)], ''), '') AS m,
                   coalesce(array_to_string(units[greatest(one, two) + 1 : n], ''), '') AS s
            FROM drawn),
        made AS (
            SELECT *, CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                                ELSE '<S>' || s || '<P>' || p || '<M>' || m END AS output
            FROM cut),
        parts AS (SELECT *, CASE WHEN form <> 'plain' THEN string_split_regex(output, '<[PSM]>') END AS q FROM made)
        SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars, sha256(output) AS output_sha256,
               sha256(CASE form WHEN 'plain' THEN output WHEN 'psm' THEN q[2] || q[4] || q[3] ELSE q[3] || q[4] || q[2] END) AS restored_sha256
        FROM parts"""


def oracle_sql() -> dict[str, str]:
    return {"op9_rarest_token_url_rules": _url_sql(), "op11_chunked_infill": _infill_sql()}
