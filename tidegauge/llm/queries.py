"""Registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from tidegauge.llm import (
    collocation,
    decontam,
    exact_stream,
    jaccard,
    license_scan,
    merkle,
    packing,
    quality,
    reshard,
    slack_packing,
    substring,
    toxicity,
    url_filter,
)
from tidegauge.llm.store import findable


def _ready(query):
    def ready(spark, sf_dir):
        findable(spark)
        return query(spark, sf_dir)

    return ready


QUERIES = {
    "op1_quality": quality.op1_quality,
    "op2_substring_dedup": substring.op2_substring_dedup,
    "op3_jaccard_join": jaccard.op3_jaccard_join,
    "op4_reshard": reshard.op4_reshard,
    "op5_license_scan": license_scan.op5_license_scan,
    "op6_decontamination": decontam.op6_decontamination,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_packing": packing.op8_packing,
    "op9_exact_dedup": exact_stream.op9_exact_dedup,
    "op10_url_filter": url_filter.op10_url_filter,
    "op11_merkle": merkle.op11_merkle,
    "op12_collocations": collocation.op12_collocations,
    "op13_bin_slack": slack_packing.op13_bin_slack,
}
QUERIES = {name: _ready(query) for name, query in QUERIES.items()}
SQL = {
    "op2_substring_dedup": substring.SQL,
    "op3_jaccard_join": jaccard.SQL,
    "op5_license_scan": license_scan.SQL,
    "op9_exact_dedup": exact_stream.SQL,
    "op11_merkle": merkle.SQL,
    "op12_collocations": collocation.SQL,
}
