"""Query op13: sentencepiece encoding and decoding of ``documents``.

SQL has no byte-pair merges, so there is no oracle statement; tests compare
with the sentencepiece library.
"""

from __future__ import annotations

import public_tokenizers

from .common import table
from .piece_bpe import OUT, encode
from .registry import register


@register("op13_piece_bpe")
def op13_piece_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs, public_tokenizers.path("piece_bpe_32k.model")).select("doc_id", *OUT)
