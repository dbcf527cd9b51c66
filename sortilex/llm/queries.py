"""The registered queries of this subpackage, and their SQL where there is any."""

from __future__ import annotations

from pyspark.sql import functions as F

from .conversation_repair import repair_conversations
from .conversation_sql import CONVERSATION_REPAIR, PREFIX_TRIE
from .decontaminate import contaminated
from .document_sql import NEAR_DUPLICATES, QUALITY_RULES
from .license_scan import scan_licenses
from .mixing import plan_mix
from .near_dedup import near_duplicates
from .pii import pseudonymise
from .ppm import score_texts
from .prefix_trie import prefix_trie
from .quality_fm import fit_quality, score_quality
from .rule_ledger import ledger, passes
from .simhash_vp import simhash_components
from .suffix_dedup import remove_repeats
from .toxicity import fit_toxicity, score_toxicity

# A key for tests. A real run sets its own secret in the session; Spark redacts
# settings of such names in logs and pages.
PII_KEY = "sortilex-example-key"
PII_KEY_SETTING = "spark.sortilex.pii.secret"


def pii_key(spark):
    return spark.conf.get(PII_KEY_SETTING, PII_KEY)


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def licenses(spark, sf_dir):
    return scan_licenses(_table(spark, sf_dir, "documents"))


def near_dedup(spark, sf_dir):
    return near_duplicates(_table(spark, sf_dir, "documents"))


def quality(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents")
    return score_quality(documents, fit_quality(documents, _table(spark, sf_dir, "labels")))


def mixing(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return plan_mix(documents).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def suffix_dedup(spark, sf_dir):
    cut = remove_repeats(_table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def decontamination(spark, sf_dir):
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def language_model(spark, sf_dir):
    return score_texts(_table(spark, sf_dir, "documents"))


def quality_rules(spark, sf_dir):
    rows = ledger(_table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~passes("base")).alias("base_failed"),
        passes("v2").alias("kept"),
        "failures",
    )


def toxicity(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents")
    return score_toxicity(documents, fit_toxicity(documents, _table(spark, sf_dir, "labels")))


def pii(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents")
    return pseudonymise(documents, pii_key(spark)).select("doc_id", "text", "n_values")


def simhash_dedup(spark, sf_dir):
    return simhash_components(_table(spark, sf_dir, "documents"))


def conversation_repair(spark, sf_dir):
    return repair_conversations(_table(spark, sf_dir, "conversations"))


def conversation_trie(spark, sf_dir):
    return prefix_trie(_table(spark, sf_dir, "conversations"))


def llm_queries():
    return {
        "op1_license_scan": licenses,
        "op2_minhash_near_dedup": near_dedup,
        "op3_quality_classifier": quality,
        "op4_source_mixing": mixing,
        "op5_suffix_array_dedup": suffix_dedup,
        "op6_benchmark_decontamination": decontamination,
        "op7_lm_scoring": language_model,
        "op8_quality_rules": quality_rules,
        "op9_toxicity": toxicity,
        "op10_pii_pseudonyms": pii,
        "op11_simhash_near_dedup": simhash_dedup,
        "op12_conversation_repair": conversation_repair,
        "op13_conversation_prefix_trie": conversation_trie,
    }


_MIX = r"""
    with d as (
        select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size
        from documents
    ), s as (
        select source, sum(size)::bigint as source_size,
            ((row_number() over (order by source asc nulls last) - 1) % 3)::int as turn
        from d group by source
    ), w as (
        select *, case turn when 0 then 3 when 1 then 1 else 2 end as weight from s
    ), l as (
        select *, (2 * source_size)::double / weight::double as level from w
    ), c as (
        select a.source, a.source_size, a.weight, a.level,
            (select (150 * sum(b.source_size))::bigint from l b)
                - (select coalesce(200 * sum(b.source_size), 0)::bigint from l b
                    where b.level < a.level or (b.level = a.level and b.source < a.source)) as rest,
            (select sum(b.weight)::bigint from l b
                where not (b.level < a.level or (b.level = a.level and b.source < a.source))) as rest_weight
        from l a
    ), f as (
        select *, rest::double / (100 * rest_weight)::double as share from c
    ), g as (
        select min(level) as first_level from f where share <= level
    ), h as (
        select min(share) as share from f, g where level = first_level and share <= level
    ), t as (
        select source, source_size,
            case when level < first_level then (2 * source_size)::double else weight::double * share_h end as target
        from (select f.source, f.source_size, f.weight, f.level, g.first_level, h.share as share_h from f, g, h)
    ), r as (
        select d.doc_id, d.size, t.source_size, t.target, t.target / t.source_size::double as rate,
            ('0x' || substring(md5('mix:' || d.doc_id::varchar), 1, 13))::bigint::double
                / 4503599627370496.0::double as u
        from d join t on d.source is not distinct from t.source
    )
    select doc_id, size, source_size, target,
        size * (floor(rate)::bigint + (u < rate - floor(rate))::bigint) as taken
    from r"""


def llm_sql():
    """SQL of the queries whose results SQL can express; the others have tests of their own."""
    return {
        "op2_minhash_near_dedup": NEAR_DUPLICATES,
        "op4_source_mixing": _MIX,
        "op8_quality_rules": QUALITY_RULES,
        "op12_conversation_repair": CONVERSATION_REPAIR,
        "op13_conversation_prefix_trie": PREFIX_TRIE,
    }
