"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

import corpus_pipeline
from cohortgraph.llm import bpe, brown, common, decontamination, exact_dedup, language_id, line_dedup, sharding, simhash, spelling, substrings, toxicity, warc, whitening

_QUERIES = {
    "op1_brown_lm": brown.op1,
    "op2_exact_dedup": exact_dedup.op2,
    "op3_decontamination": decontamination.op3,
    "op4_suffix_dedup": substrings.op4,
    "op5_sharding": sharding.op5,
    "op6_toxicity": toxicity.op6,
    "op7_warc": warc.op7,
    "op8_line_dedup": line_dedup.op8,
    "op9_simhash": simhash.op9,
    "op10_bpe": bpe.op10,
    "op11_whitening": whitening.op11,
    "op12_spelling": spelling.op12,
    "op13_language_id": language_id.op13,
    "pipeline": corpus_pipeline.run,
}

def _shipped(query):
    def run(spark, sf_dir):
        common.ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {name: _shipped(query) for name, query in _QUERIES.items()}

ORACLES = {
    "op2_exact_dedup": exact_dedup.SQL,
    "op3_decontamination": decontamination.SQL,
    "op5_sharding": sharding.SQL,
    "op8_line_dedup": line_dedup.SQL,
    "op12_spelling": spelling.SQL,
}
