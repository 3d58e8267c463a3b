"""Queries of the training-data operators and the SQL of those that SQL can
express over the driver tables."""

from __future__ import annotations

from .align import op12_alignment
from .chat import OP5_SQL, op5_chat
from .decontaminate import OP2_SQL, op2_decontamination
from .fingerprints import op9_fingerprints
from .hilbert import op3_hilbert
from .jaccard import OP7_SQL, op7_jaccard
from .packing import op4_bm25_packing
from .quality import op1_quality
from .rules import OP13_SQL, op13_quality_rules
from .substrings import OP10_SQL, op10_substrings
from .toxicity import op6_toxicity
from .warc import OP8_SQL, op8_warc
from .whiten import op11_whitening

QUERIES = {
    "op1_quality": op1_quality,
    "op2_decontamination": op2_decontamination,
    "op3_hilbert": op3_hilbert,
    "op4_bm25_packing": op4_bm25_packing,
    "op5_chat": op5_chat,
    "op6_toxicity": op6_toxicity,
    "op7_jaccard": op7_jaccard,
    "op8_warc": op8_warc,
    "op9_fingerprints": op9_fingerprints,
    "op10_substrings": op10_substrings,
    "op11_whitening": op11_whitening,
    "op12_alignment": op12_alignment,
    "op13_quality_rules": op13_quality_rules,
}

SQL = {
    "op2_decontamination": OP2_SQL,
    "op5_chat": OP5_SQL,
    "op7_jaccard": OP7_SQL,
    "op8_warc": OP8_SQL,
    "op10_substrings": OP10_SQL,
    "op13_quality_rules": OP13_SQL,
}
