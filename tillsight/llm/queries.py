"""Registered queries of the package, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillsight.llm.contamination import OP7_SQL, op7_contamination
from tillsight.llm.hard_negatives import OP11_SQL, op11_hard_negatives
from tillsight.llm.kneser_ney import op2_kneser_ney
from tillsight.llm.language import op8_language
from tillsight.llm.near_duplicates import op9_near_duplicates
from tillsight.llm.packing import op13_packing
from tillsight.llm.pieces import op6_pieces
from tillsight.llm.private_data import op5_private
from tillsight.llm.token_frames import op3_token_frames
from tillsight.llm.topk import OP10_SQL, op10_topk
from tillsight.llm.toxicity import op4_toxicity
from tillsight.llm.warc import OP1_SQL, op1_warc
from tillsight.llm.whitening import op12_whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_kneser_ney": op2_kneser_ney,
    "op3_token_frames": op3_token_frames,
    "op4_toxicity": op4_toxicity,
    "op5_private": op5_private,
    "op6_pieces": op6_pieces,
    "op7_contamination": op7_contamination,
    "op8_language": op8_language,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_topk": op10_topk,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_whitening": op12_whitening,
    "op13_packing": op13_packing,
}

ORACLES: dict[str, str] = {
    "op1_warc": OP1_SQL,
    "op7_contamination": OP7_SQL,
    "op10_topk": OP10_SQL,
    "op11_hard_negatives": OP11_SQL,
}
