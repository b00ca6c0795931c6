"""The queries of this subpackage, gathered from its modules."""

from __future__ import annotations

from noticeloom.llm import convtrie, decontam, exactdup, language, licenses, lm, mixing, neardup, repetition, runs, secretscan, toxicity, warc

_MODULES = (repetition, lm, language, exactdup, licenses, neardup, mixing, decontam, warc, toxicity, runs, secretscan, convtrie)
QUERIES = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
ORACLES = {k: v for m in _MODULES for k, v in m.ORACLES.items()}
