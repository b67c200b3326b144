"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from textpulse.llm import (
    bpe,
    decontaminate,
    html_tree,
    jaccard,
    licenses,
    lines,
    quality,
    sharding,
    simhash,
    toxicity,
    urls,
    variants,
    whitening,
)
from textpulse.llm.common import table

SHARDS = 16


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_bpe(spark, folder):
    """Every document encoded and decoded with the 49k word vocabulary."""
    return bpe.round_trip(table(spark, folder, "documents"), vocabulary_path())


def op2_reshard(spark, folder):
    """Documents in 16 old shards by source, moved into 16 shards of near-equal bytes."""
    old = F.pmod(F.crc32(F.coalesce("source", F.lit("")).cast("binary")), F.lit(SHARDS))
    placed = sharding.place(table(spark, folder, "documents"), old, SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "old_shard", "block",
    )


def op3_toxicity(spark, folder):
    """Toxicity of every document, learnt from labelled rows that are not held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, folder, "labels")))
    return scored.select(
        "doc_id", toxicity.held_out().alias("held_out"), F.col("_score").alias("score"),
        (F.col("_score") >= 0.5).cast("int").alias("predicted"), F.col("_evidence").alias("evidence"),
    )


def op4_quality(spark, folder):
    """Base counts, base rules and divergence verdict of every document."""
    return quality.judge(table(spark, folder, "documents"))


def op5_decontaminate(spark, folder):
    """Benchmark passages in the documents, one row each; clean documents have none."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.find_leaks(docs, table(spark, folder, "benchmark"))
    return found.select("doc_id", F.inline("_leaks"))


def op6_jaccard(spark, folder):
    """Near-duplicate class and number of links of every document."""
    return jaccard.join(table(spark, folder, "documents"))


def op7_licenses(spark, folder):
    """License detections of every document."""
    found = licenses.scan(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


def op8_html(spark, folder):
    """Main text of every page."""
    made = html_tree.extract(table(spark, folder, "pages"))
    return made.select(
        "page_id", "url", F.col("_text").alias("text"), F.char_length("_text").cast("long").alias("n_chars")
    )


def op9_url_rules(spark, folder):
    """Every page URL judged by host rules, then pattern rules."""
    return urls.judge(table(spark, folder, "pages"))


def op10_line_dedup(spark, folder):
    """Line links and removals of every document."""
    made = lines.dedup_lines(table(spark, folder, "documents"))
    return made.select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_links").alias("n_links"),
        F.col("_line_classes").alias("line_classes"), F.col("_n_removed").alias("n_removed"),
        F.sha2(F.col("text"), 256).alias("text_sha256"),
    )


def op11_whitening(spark, folder):
    """Every embedding projected on the four leading components, whitened."""
    made = whitening.whiten(table(spark, folder, "embeddings").select("vec_id", "embedding"))
    return made.select("vec_id", F.inline("whitening"))


def op12_variants(spark, folder):
    """Words of the documents, their near words, forms and roots."""
    return variants.group(table(spark, folder, "documents"))


def op13_simhash(spark, folder):
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, folder, "documents"))


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_reshard": op2_reshard,
    "op3_toxicity": op3_toxicity,
    "op4_quality": op4_quality,
    "op5_decontaminate": op5_decontaminate,
    "op6_jaccard": op6_jaccard,
    "op7_licenses": op7_licenses,
    "op8_html": op8_html,
    "op9_url_rules": op9_url_rules,
    "op10_line_dedup": op10_line_dedup,
    "op11_whitening": op11_whitening,
    "op12_variants": op12_variants,
    "op13_simhash": op13_simhash,
}

SQL = {
    "op9_url_rules": urls.verdict_sql(),
    "op12_variants": variants.group_sql(),
}
