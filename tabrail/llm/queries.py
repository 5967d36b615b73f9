"""The subpackage's queries and their DuckDB SQL."""

from __future__ import annotations

from tabrail.llm.ann import op9_stable_projections
from tabrail.llm import filter_audit, warc
from tabrail.llm.bpe import op7_rank_queue_bpe
from tabrail.llm.filter_audit import op13_retraction_stream
from tabrail.llm.html_extract import op1_text_density
from tabrail.llm.jaccard import op3_grouped_prefix_join
from tabrail.llm.packing import op8_grouping_genetic
from tabrail.llm.pii import op4_pii
from tabrail.llm.resampling import op11_regular_sampling
from tabrail.llm.sharding import op2_weighted_hash_tree
from tabrail.llm.spotsigs import op6_spotsigs
from tabrail.llm.suffix_dedup import op10_run_length_index
from tabrail.llm.toxicity import op5_noisy_channel
from tabrail.llm.warc import op12_content_archive

QUERIES = {
    "op1_text_density": op1_text_density,
    "op2_weighted_hash_tree": op2_weighted_hash_tree,
    "op3_grouped_prefix_join": op3_grouped_prefix_join,
    "op4_pii": op4_pii,
    "op5_noisy_channel": op5_noisy_channel,
    "op6_spotsigs": op6_spotsigs,
    "op7_rank_queue_bpe": op7_rank_queue_bpe,
    "op8_grouping_genetic": op8_grouping_genetic,
    "op9_stable_projections": op9_stable_projections,
    "op10_run_length_index": op10_run_length_index,
    "op11_regular_sampling": op11_regular_sampling,
    "op12_content_archive": op12_content_archive,
    "op13_retraction_stream": op13_retraction_stream,
}
ORACLE_SQL: dict[str, str] = {
    "op12_content_archive": warc.SQL,
    "op13_retraction_stream": filter_audit.SQL,
}
