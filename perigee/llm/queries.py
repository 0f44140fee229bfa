"""Registered queries of this package, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from perigee.llm.alignment import op13_alignment
from perigee.llm.bpe import op3_bpe
from perigee.llm.chat import op8_chat
from perigee.llm.clustering import op12_clustering
from perigee.llm.decontaminate import op4_decontamination
from perigee.llm.extract import op7_extract
from perigee.llm.neardup import op6_near_duplicates
from perigee.llm.oracles import ORACLES
from perigee.llm.packing import op11_packing
from perigee.llm.pii import op2_pii
from perigee.llm.quality import op5_quality
from perigee.llm.secrets import op10_secrets
from perigee.llm.tokens import op9_token_counts
from perigee.llm.warc import op1_warc

__all__ = ["ORACLES", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_pii": op2_pii,
    "op3_bpe": op3_bpe,
    "op4_decontamination": op4_decontamination,
    "op5_quality": op5_quality,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_extract": op7_extract,
    "op8_chat": op8_chat,
    "op9_token_counts": op9_token_counts,
    "op10_secrets": op10_secrets,
    "op11_packing": op11_packing,
    "op12_clustering": op12_clustering,
    "op13_alignment": op13_alignment,
}

