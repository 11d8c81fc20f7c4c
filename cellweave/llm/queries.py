"""Queries over the corpus operators, and their DuckDB twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cellweave.llm.ann import op1_rp_forest
from cellweave.llm.bpe import op3_bpe_trie
from cellweave.llm.crosspolytope import op5_cross_polytope
from cellweave.llm.langid import op10_langid
from cellweave.llm.mixing import OP2_SQL, op2_poisson_mix
from cellweave.llm.sharding import op4_stratified_shards
from cellweave.llm.simhash import op8_simhash
from cellweave.llm.token_counts import op7_length_histogram
from cellweave.llm.toxicity import op6_toxicity
from cellweave.llm.warc import OP9_SQL, op9_merkle_fixity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_rp_forest, op2_poisson_mix, op3_bpe_trie, op4_stratified_shards, op5_cross_polytope, op6_toxicity, op7_length_histogram, op8_simhash, op9_merkle_fixity, op10_langid)
}
ORACLE_SQL: dict[str, str] = {"op2_poisson_mix": OP2_SQL, "op9_merkle_fixity": OP9_SQL}
