"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from bidscope.llm import (
    decontaminate,
    fingerprint,
    html_text,
    langid,
    lattice_lm,
    line_dedup,
    mixing,
    prefix_trie,
    quality,
    simhash_dedup,
    toxicity,
    warc,
    whitening,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_html_text": html_text.op1_html_text,
        "op2_line_dedup": line_dedup.op2_line_dedup,
        "op3_fingerprints": fingerprint.op3_fingerprints,
        "op4_quality": quality.op4_quality,
        "op5_decontaminate": decontaminate.op5_decontaminate,
        "op6_mix": mixing.op6_mix,
        "op7_simhash": simhash_dedup.op7_simhash,
        "op8_langid": langid.op8_langid,
        "op9_toxicity": toxicity.op9_toxicity,
        "op10_warc": warc.op10_warc,
        "op11_lattice_lm": lattice_lm.op11_lattice_lm,
        "op12_prefix_trie": prefix_trie.op12_prefix_trie,
        "op13_whitening": whitening.op13_whitening,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_line_dedup": line_dedup.OP2_SQL,
        "op5_decontaminate": decontaminate.OP5_SQL,
        "op12_prefix_trie": prefix_trie.OP12_SQL,
    }
