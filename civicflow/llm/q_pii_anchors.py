"""Query op3: personal data in ``documents``.

Check sums, code-point positions and left-to-right matching without retries
are beyond SQL; tests compare with regular expressions applied by brute force.
"""

from __future__ import annotations

from .common import table
from .pii_anchors import FOUND, find
from .registry import register


@register("op3_pii_anchors")
def op3_pii_anchors(spark, sf_dir):
    return find(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", *FOUND)
