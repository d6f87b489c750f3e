"""The numbered operators as queries over the test tables, with production parameters and whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from strataflow.llm import decontamination, html_text, interpolation, license_scan, packing, periodic_runs, prefix_trie, quality_rules, simhash, token_lengths, toxicity, url_lists, warc
from strataflow.llm.common import remainder, stored, table
from strataflow.session import scratch_path


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by a machine that saw no label of the held-out fifth."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    fold = remainder(F.col("doc_id"), 5)
    machine = toxicity.train(docs, labels.where(fold != 0))
    found = toxicity.scored(docs, machine)
    return found.select("doc_id", (fold == 0).alias("held_out"), "score", "predicted", "worst")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licenses that every document names or quotes."""
    return license_scan.licenses_found(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document; the cutoffs come from the labelled ones."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    counts = [f"_q.{c} AS {c}" for c in (*quality_rules.BASE, "base_failed")]
    return quality_rules.quality_verdicts(docs, labels).selectExpr("doc_id", *counts, "_kept AS kept")


def op4_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model score of every document; the tenth with fold 0 is scored by what the others taught."""
    return interpolation.interpolated_scores(table(spark, sf_dir, "documents"))


def op5_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a capture, against list entries derived from all events."""
    pages, events = table(spark, sf_dir, "pages"), table(spark, sf_dir, "events")
    entries = url_lists.example_entries(pages, events)
    return url_lists.captures_on_lists(url_lists.example_captures(pages), entries)


def op6_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1,024 tokens; every token bears loss."""
    pieces = packing.packed(table(spark, sf_dir, "documents"))
    digest = F.crc32("ids").alias("ids_crc32")
    return pieces.select("doc_id", "start", "length", digest, "doc_tokens", "sequence_id", "offset")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark passage in every document."""
    return decontamination.passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extracted(table(spark, sf_dir, "pages"))


def op9_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and the smallest doc_id that links of three bits or fewer reach."""
    prints = stored(simhash.fingerprints(table(spark, sf_dir, "documents")), "fingerprints")
    groups = simhash.near_duplicate_groups(prints)
    text = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return groups.select("doc_id", text.alias("fingerprint"), "component_id")


def op10_token_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of the encoded documents for every context limit at which they change."""
    lengths = stored(token_lengths.length_histogram(table(spark, sf_dir, "documents")), "lengths")
    return token_lengths.with_suffix_sums(lengths)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every document, of which every tenth was given one at its end."""
    return periodic_runs.digests(periodic_runs.periodic_runs(periodic_runs.with_repeated_tails(table(spark, sf_dir, "documents"))))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, rebuilt so that they share beginnings."""
    turns = stored(prefix_trie.numbered_turns(table(spark, sf_dir, "conversations")), "turns")
    return prefix_trie.prefix_trie(prefix_trie.rebuilt(turns))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back."""
    path = scratch_path(spark, "warc")
    warc.write_pages(table(spark, sf_dir, "pages"), path)
    return warc.archived_pages(spark, path)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_license_scan": op2_license_scan,
    "op3_quality_rules": op3_quality_rules,
    "op4_interpolation": op4_interpolation,
    "op5_url_lists": op5_url_lists,
    "op6_vector_packing": op6_vector_packing,
    "op7_decontamination": op7_decontamination,
    "op8_html_text": op8_html_text,
    "op9_simhash_groups": op9_simhash_groups,
    "op10_token_lengths": op10_token_lengths,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_warc": op13_warc,
    "pipeline": corpus_pipeline.run,
}
ORACLE: dict[str, str] = {
    "op2_license_scan": license_scan.oracle_sql(),
    "op3_quality_rules": quality_rules.oracle_sql(),
    "op5_url_lists": url_lists.ORACLE,
    "op12_prefix_trie": prefix_trie.ORACLE,
    "op13_warc": warc.ORACLE,
}
