"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from curvewright.llm import alignment, bpe, decontaminate, licenses, manifest, mixing, neighbours, quality, secret_scan, sharding, simhash, tokens, urls  # noqa: F401
from curvewright.llm.common import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
