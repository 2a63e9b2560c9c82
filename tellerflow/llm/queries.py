"""All queries of this package: importing the operators registers them."""

from tellerflow.llm import ann, bpe, codes, decontamination, langid, licenses, lines, lm, manifest, neardup, simhash, substrings  # noqa: F401
from tellerflow.llm.registry import ORACLES, QUERIES  # noqa: F401
