"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reelspark.llm.ann import op2_ann
from reelspark.llm.collocations import OP12_SQL, op12_collocations
from reelspark.llm.exact_dedup import OP9_SQL, op9_exact_dedup
from reelspark.llm.hard_negatives import OP13_SQL, op13_hard_negatives
from reelspark.llm.html_extract import op5_html_extract
from reelspark.llm.jaccard import OP6_SQL, op6_ngram_jaccard
from reelspark.llm.line_dedup import OP4_SQL, op4_line_dedup
from reelspark.llm.mixing import OP3_SQL, op3_mixing
from reelspark.llm.packing import op10_packing
from reelspark.llm.substring_dedup import OP11_SQL, op11_substring_dedup
from reelspark.llm.tokens import op7_token_counts
from reelspark.llm.toxicity import op8_toxicity
from reelspark.llm.url_filter import op1_url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_ann": op2_ann,
    "op3_mixing": op3_mixing,
    "op4_line_dedup": op4_line_dedup,
    "op5_html_extract": op5_html_extract,
    "op6_ngram_jaccard": op6_ngram_jaccard,
    "op7_token_counts": op7_token_counts,
    "op8_toxicity": op8_toxicity,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_packing": op10_packing,
    "op11_substring_dedup": op11_substring_dedup,
    "op12_collocations": op12_collocations,
    "op13_hard_negatives": op13_hard_negatives,
}

SQL: dict[str, str] = {
    "op3_mixing": OP3_SQL,
    "op4_line_dedup": OP4_SQL,
    "op6_ngram_jaccard": OP6_SQL,
    "op9_exact_dedup": OP9_SQL,
    "op11_substring_dedup": OP11_SQL,
    "op12_collocations": OP12_SQL,
    "op13_hard_negatives": OP13_SQL,
}
