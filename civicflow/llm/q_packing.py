"""Query op6: packing of ``documents`` into sequences of at most 1024 tokens.

SQL has neither the tokenizer nor the subset sums; tests compare with the
tokenizers library, check that places are gapless and compare bins with an
exact search on small inputs.
"""

from __future__ import annotations

import public_tokenizers

from .common import table
from .packing import OUT, pack
from .registry import register


@register("op6_packing")
def op6_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json")).select("doc_id", *OUT)
