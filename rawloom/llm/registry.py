"""Queries of the operators, and their SQL where SQL can express them."""

from . import (
    byte_bpe,
    clusters,
    decontaminate,
    language,
    main_text,
    near_duplicates,
    neighbours,
    repeats,
    sharding,
    token_counts,
    toxicity,
    url_filter,
    vector_codes,
)

QUERIES = {
    f.__name__: f
    for f in (
        language.op1_language_id,
        near_duplicates.op2_near_duplicates,
        decontaminate.op3_decontaminate,
        neighbours.op4_nearest_neighbours,
        token_counts.op5_token_counts,
        byte_bpe.op6_byte_bpe,
        main_text.op7_html_extraction,
        url_filter.op8_url_filter,
        repeats.op9_suffix_array_dedup,
        toxicity.op10_toxicity,
        vector_codes.op11_vector_codes,
        sharding.op12_balanced_shards,
        clusters.op13_centroid_clustering,
    )
}
ORACLES = {
    "op8_url_filter": url_filter.SQL,
    "op11_vector_codes": vector_codes.SQL,
    "op13_centroid_clustering": clusters.SQL,
}
