"""Registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
from barlake.llm import (
    decontam, divergence, embedding, langid, minhash, packing, quality, repair, substring, tokencount, toxicity, vafile, wrappers,
)

QUERIES = {
    "op1_decontaminate": decontam.op1_decontaminate,
    "op2_quality": quality.op2_quality,
    "op3_embedding": embedding.op3_embedding,
    "op4_langid": langid.op4_langid,
    "op5_packing": packing.op5_packing,
    "op6_tokencount": tokencount.op6_tokencount,
    "op7_minhash": minhash.op7_minhash,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_extract": wrappers.op9_extract,
    "op10_substring": substring.op10_substring,
    "op11_centroids": vafile.op11_centroids,
    "op12_token_ids": repair.op12_token_ids,
    "op13_divergence": divergence.op13_divergence,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL: dict[str, str] = {
    "op1_decontaminate": decontam.OP1_SQL,
    "op11_centroids": vafile.OP11_SQL,
    "op13_divergence": divergence.OP13_SQL,
}
