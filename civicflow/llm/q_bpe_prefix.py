"""Query op4: BPE encoding and decoding of ``documents``.

SQL has no byte-pair merges, so there is no oracle statement; tests compare
with the tiktoken library and check exact round trips.
"""

from __future__ import annotations

import public_tokenizers

from .bpe_prefix import OUT, encode
from .common import table
from .registry import register


@register("op4_bpe_prefix")
def op4_bpe_prefix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).select("doc_id", *OUT)
