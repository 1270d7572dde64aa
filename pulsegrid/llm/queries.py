"""All queries of the subpackage: importing a module registers what it has."""

from pulsegrid.llm import bpe, chat_format, decontaminate, host_quality, jaccard_join, licence_scan, merkle, nearest, secret_scan, shuffle_shards, substrings, toxicity, whitening  # noqa: F401
from pulsegrid.llm.common import ORACLES, QUERIES  # noqa: F401
