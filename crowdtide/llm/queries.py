"""The queries of this folder's operators, and the SQL of those that SQL can express."""

from crowdtide.llm import (
    exact_dedup, jaccard_join, language_id, language_model, mixing, neighbours, packing, pii, sharding, spelling, toxicity, vector_codes, warc,
)

QUERIES = {
    "op1_jaccard_join": jaccard_join.op1_jaccard_join,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_exact_dedup": exact_dedup.op3_exact_dedup,
    "op4_nearest_neighbours": neighbours.op4_nearest_neighbours,
    "op5_sharding": sharding.op5_sharding,
    "op6_language_model": language_model.op6_language_model,
    "op7_language_id": language_id.op7_language_id,
    "op8_packing": packing.op8_packing,
    "op9_mixing": mixing.op9_mixing,
    "op10_pii": pii.op10_pii,
    "op11_spelling_variants": spelling.op11_spelling_variants,
    "op12_vector_codes": vector_codes.op12_vector_codes,
    "op13_warc": warc.op13_warc,
}

SQL = {
    "op3_exact_dedup": exact_dedup.OP3_SQL,
    "op4_nearest_neighbours": neighbours.OP4_SQL,
    "op5_sharding": sharding.OP5_SQL,
    "op9_mixing": mixing.OP9_SQL,
    "op11_spelling_variants": spelling.OP11_SQL,
    "op12_vector_codes": vector_codes.OP12_SQL,
    "op13_warc": warc.OP13_SQL,
}
