"""The queries of this subpackage by name."""

from __future__ import annotations

from factloom.llm import bpe, fingerprints, jaccard, licences, lines, mixing, neighbours, suffixes, toxicity, wordpiece


def queries():
    return {
        "op1_mixing": mixing.op1_mixing,
        "op2_bpe": bpe.op2_bpe,
        "op3_neighbours": neighbours.op3_neighbours,
        "op4_toxicity": toxicity.op4_toxicity,
        "op5_jaccard": jaccard.op5_jaccard,
        "op6_token_counts": wordpiece.op6_token_counts,
        "op7_fingerprints": fingerprints.op7_fingerprints,
        "op8_licences": licences.op8_licences,
        "op9_repeats": suffixes.op9_repeats,
        "op10_lines": lines.op10_lines,
    }


def oracle_sql():
    return {"op1_mixing": mixing.OP1_SQL}
