"""Queries of the operators; importing a module registers its query."""

from . import bloom_dedup, bottomk_dedup, decontaminate, edit_counts, filter_audit, merkle_manifest, packing, parse_dedup, quality_divergence, toxicity, url_reputation, viterbi_pieces, warc_fixity  # noqa: F401
from .common import QUERIES, SQL  # noqa: F401
