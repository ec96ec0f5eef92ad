"""The queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .op1_quality_rules import op1_quality_rules
from .op2_substring_dedup import op2_substring_dedup
from .op3_quality_classifier import op3_quality_classifier
from .op4_bpe_codec import op4_bpe_codec
from .op5_simhash_dedup import op5_simhash_dedup
from .op6_ppm_scoring import op6_ppm_scoring
from .op7_token_store import op7_token_store
from .op8_best_fit_packing import op8_best_fit_packing
from .op9_sharding import op9_sharding
from .op10_embedding_dedup import op10_embedding_dedup
from .op11_centroid_clusters import op11_centroid_clusters
from .op12_exact_dedup import op12_exact_dedup
from .op13_vector_codes import op13_vector_codes
from .sql import OP1_SQL, OP2_SQL, OP11_SQL, OP12_SQL, OP13_SQL

ALL = (
    op1_quality_rules, op2_substring_dedup, op3_quality_classifier, op4_bpe_codec, op5_simhash_dedup, op6_ppm_scoring, op7_token_store,
    op8_best_fit_packing, op9_sharding, op10_embedding_dedup, op11_centroid_clusters, op12_exact_dedup, op13_vector_codes,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in ALL}


def oracle_sql() -> dict[str, str]:
    return {"op1_quality_rules": OP1_SQL, "op2_substring_dedup": OP2_SQL, "op11_centroid_clusters": OP11_SQL, "op12_exact_dedup": OP12_SQL, "op13_vector_codes": OP13_SQL}
