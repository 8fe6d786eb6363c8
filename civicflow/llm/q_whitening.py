"""Query op11: whitened components of ``embeddings``.

SQL has no matrix factors, so there is no oracle statement; tests compare with
a plain eigen-decomposition and exact integers.
"""

from __future__ import annotations

from .common import table
from .registry import register
from .whitening import OUT, whiten


@register("op11_whitening")
def op11_whitening(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whiten(vectors).select("vec_id", *OUT)
