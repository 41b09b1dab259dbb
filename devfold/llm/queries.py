"""Registered queries of the text operators, and their SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from devfold.llm import decontaminate, extract, jaccard, logbloom, oracles, pack, periodic, privacy, quality, ranked, repair, substrings, toxicity, urls
from devfold.llm.common import read

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op1_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, written and read back."""
    return repair.token_files(read(spark, sf_dir, "documents"))


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses to repeated windows of 20 words."""
    return substrings.removals(read(spark, sf_dir, "documents"))


def op3_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, fertility and verdict of every document."""
    return quality.judged(read(spark, sf_dir, "documents"))


def op4_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that a document contains."""
    return decontaminate.contained(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_logbloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document."""
    return logbloom.score_texts(read(spark, sf_dir, "documents"))


def op6_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract.extract(read(spark, sf_dir, "pages"))


def op7_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and revealing terms of every document."""
    return privacy.find_personal(read(spark, sf_dir, "documents"), everywhere=True).drop("row_key", "terms")


def op8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document."""
    return pack.pack(read(spark, sf_dir, "documents"))


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's url."""
    return urls.judge(read(spark, sf_dir, "pages"), spark.createDataFrame(RULES, "host string, path string, verdict string"))


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-copy component of every document."""
    return jaccard.jaccard_components(read(spark, sf_dir, "documents"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, some of which end in a repeated stretch."""
    return periodic.digests(periodic.periodic_runs(periodic.with_periodic_tails(read(spark, sf_dir, "documents"))))


def op12_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return ranked.ranked(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    return toxicity.scored(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_repair, op2_substrings, op3_fertility, op4_containment, op5_logbloom, op6_blocks, op7_disclosure,
        op8_pack, op9_urls, op10_jaccard, op11_runs, op12_masks, op13_toxicity,
    )
}
ORACLES: dict[str, str] = {
    "op2_substrings": oracles.REMOVALS,
    "op4_containment": oracles.CONTAINED,
    "op9_urls": oracles.URLS,
    "op10_jaccard": oracles.JACCARD,
    "op12_masks": oracles.RANKED,
}
