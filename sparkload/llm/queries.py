"""The registered queries of this package: one for each operator, applied with
its production parameters to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import binary_output, bpe, fingerprints, license_scan, minhash, mixing, packing, quality_rules, target_sampling, token_counts, toxicity, url_filters, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": token_counts.op1,
    "op2_quality_rules": quality_rules.op2,
    "op3_mixing": mixing.op3,
    "op4_bpe": bpe.op4,
    "op5_fingerprints": fingerprints.op5,
    "op6_url_filters": url_filters.op6,
    "op7_license_scan": license_scan.op7,
    "op8_binary_output": binary_output.op8,
    "op9_minhash": minhash.op9,
    "op10_toxicity": toxicity.op10,
    "op11_packing": packing.op11,
    "op12_whitening": whitening.op12,
    "op13_target_sampling": target_sampling.op13,
}

ORACLES: dict[str, str] = {
    "op2_quality_rules": quality_rules.OP2_SQL,
    "op3_mixing": mixing.OP3_SQL,
    "op6_url_filters": url_filters.OP6_SQL,
    "op7_license_scan": license_scan.OP7_SQL,
    "op9_minhash": minhash.OP9_SQL,
}
