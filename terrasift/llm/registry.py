"""All queries of this package: importing an operator's module registers its query."""

from terrasift.llm import (  # noqa: F401
    chat_format,
    chat_repair,
    image_copies,
    license_scan,
    mixing,
    near_dedup,
    piece_codec,
    quality_classifier,
    quality_rules,
    token_counts,
    token_ids,
    vector_codes,
    warc_revisits,
)
from terrasift.llm.decl import ORACLE, QUERIES  # noqa: F401
