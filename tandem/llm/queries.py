"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from tandem.llm.decontaminate import OP4_SQL, op4_benchmark_decontamination
from tandem.llm.language import op3_language_id
from tandem.llm.line_dedup import op5_fuzzy_line_dedup
from tandem.llm.mixing import op1_source_mixing
from tandem.llm.neardup import op10_minhash_near_dedup
from tandem.llm.ppm import op6_ppm_scores
from tandem.llm.quality import op9_quality_rules
from tandem.llm.range_join import OP11_SQL, op11_metric_range_join
from tandem.llm.token_ids import op8_token_ids_orc
from tandem.llm.toxicity import op2_toxicity
from tandem.llm.url_filter import OP7_SQL, op7_url_filter
from tandem.llm.whitening import op13_incremental_whitening
from tandem.llm.zone_maps import OP12_SQL, op12_hilbert_zone_clusters

QUERIES = {
    "op5_fuzzy_line_dedup": op5_fuzzy_line_dedup,
    "op6_ppm_scores": op6_ppm_scores,
    "op2_toxicity": op2_toxicity,
    "op3_language_id": op3_language_id,
    "op7_url_filter": op7_url_filter,
    "op1_source_mixing": op1_source_mixing,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op8_token_ids_orc": op8_token_ids_orc,
    "op9_quality_rules": op9_quality_rules,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op11_metric_range_join": op11_metric_range_join,
    "op12_hilbert_zone_clusters": op12_hilbert_zone_clusters,
    "op13_incremental_whitening": op13_incremental_whitening,
}

ORACLE_SQL: dict[str, str] = {
    "op7_url_filter": OP7_SQL,
    "op4_benchmark_decontamination": OP4_SQL,
    "op11_metric_range_join": OP11_SQL,
    "op12_hilbert_zone_clusters": OP12_SQL,
}
