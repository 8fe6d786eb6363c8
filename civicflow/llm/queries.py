"""All queries of the subpackage."""

from . import (  # noqa: F401
    q_bagminhash,
    q_bpe_prefix,
    q_host_rules,
    q_imatch,
    q_line_templates,
    q_packing,
    q_piece_bpe,
    q_pii_anchors,
    q_rule_ensemble,
    q_spelling,
    q_substring_blocks,
    q_warc_shards,
    q_whitening,
)
from .registry import QUERIES, SQL  # noqa: F401
