"""Queries over the given tables, one for each operator of this subpackage."""

from __future__ import annotations

from tidemark.llm import conversations, decontaminate, lines, ngrams, runs, substrings, urls, vectors
from tidemark.llm.bpe import op6_streaming_bpe
from tidemark.llm.conversations import op12_suffix_shared_repair
from tidemark.llm.decontaminate import op4_benchmark_windows
from tidemark.llm.language import op1_string_kernel_language
from tidemark.llm.lines import op13_line_counts
from tidemark.llm.ngrams import op9_partitioned_jaccard
from tidemark.llm.pages import op8_text_blocks
from tidemark.llm.quality import op10_compression_quality
from tidemark.llm.runs import op11_last_seen_runs
from tidemark.llm.sharding import op3_hypergeometric_shards
from tidemark.llm.substrings import op7_difference_cover
from tidemark.llm.urls import op5_reversed_host_rules
from tidemark.llm.vectors import op2_inverted_multi_index

QUERIES = {
    f.__name__: f
    for f in (
        op1_string_kernel_language,
        op2_inverted_multi_index,
        op3_hypergeometric_shards,
        op4_benchmark_windows,
        op5_reversed_host_rules,
        op6_streaming_bpe,
        op10_compression_quality,
        op7_difference_cover,
        op8_text_blocks,
        op9_partitioned_jaccard,
        op11_last_seen_runs,
        op12_suffix_shared_repair,
        op13_line_counts,
    )
}

ORACLES = {
    "op2_inverted_multi_index": vectors.ORACLE,
    "op4_benchmark_windows": decontaminate.ORACLE,
    "op5_reversed_host_rules": urls.ORACLE,
    "op7_difference_cover": substrings.ORACLE,
    "op9_partitioned_jaccard": ngrams.ORACLE,
    "op11_last_seen_runs": runs.ORACLE,
    "op12_suffix_shared_repair": conversations.ORACLE,
    "op13_line_counts": lines.ORACLE,
}
