"""The queries of this folder."""

from racelake.llm import (
    bpe, decontam, hard_negatives, language, merkle, ngram_join, packing, pii, secret_scan, sharding, suffix_dedup,
    token_store, topk,
)

QUERIES = {
    "op1_pii": pii.query,
    "op2_suffix_dedup": suffix_dedup.query,
    "op3_token_store": token_store.query,
    "op4_secret_scan": secret_scan.query,
    "op5_bpe": bpe.query,
    "op6_language": language.query,
    "op7_sharding": sharding.query,
    "op8_ngram_join": ngram_join.query,
    "op9_decontamination": decontam.query,
    "op10_topk": topk.query,
    "op11_hard_negatives": hard_negatives.query,
    "op12_merkle_manifest": merkle.query,
    "op13_packing": packing.query,
}


ORACLES: dict[str, str] = {}
