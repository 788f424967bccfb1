"""Queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .aligned import op13_aligned
from .ann import op1_ann
from .bpe import op10_bpe
from .chat import OP5_SQL, op5_chat
from .classlm import op6_classlm
from .mixing import op8_mixing
from .neardup_vectors import OP4_SQL, op4_neardup_vectors
from .pii import op9_pii
from .quality import op2_quality
from .recompression import OP11_SQL, op11_recompression
from .sharding import op3_sharding
from .simhash import op7_simhash
from .vectorcodes import OP12_SQL, op12_vectorcodes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_ann, op2_quality, op3_sharding, op4_neardup_vectors, op5_chat, op6_classlm, op7_simhash, op8_mixing, op9_pii, op10_bpe, op11_recompression, op12_vectorcodes, op13_aligned)
}
SQL = {"op4_neardup_vectors": OP4_SQL, "op5_chat": OP5_SQL, "op11_recompression": OP11_SQL, "op12_vectorcodes": OP12_SQL}
