"""All registered queries and their SQL, gathered from the plan modules."""

from __future__ import annotations

from marginalia.plans import language, machines, models, networks, samples, search, separators, skipgram, trees, vectors, words

MODULES = [language, models, vectors, separators, words, skipgram, trees, search, samples, machines, networks]

QUERIES: dict = {}
ORACLES: dict = {}
for _module in MODULES:
    QUERIES.update(_module.QUERIES)
    ORACLES.update(_module.ORACLES)
