"""The subpackage's queries by name, and SQL for those that SQL can express on whole tables."""

from __future__ import annotations

from .decontam import op8
from .edits import op4
from .jaccard import op3
from .lattice import op10
from .linededup import ORACLE as LINE_DEDUP
from .linededup import op7
from .negatives import ORACLE as HARD_NEGATIVES
from .negatives import op11
from .packing import op9
from .repair import op1
from .suffix import op2
from .topk import ORACLE as TOP_K
from .topk import op5
from .toxicity import op6
from .turns import op13
from .walks import op12

QUERIES = {
    "op1_repair_token_ids": op1,
    "op2_pointer_refinement": op2,
    "op3_jaccard_fragments": op3,
    "op4_edit_aware_counts": op4,
    "op5_uniform_threshold": op5,
    "op6_toxic_segments": op6,
    "op7_line_spread": op7,
    "op8_template_leaks": op8,
    "op9_best_fit_packing": op9,
    "op10_subword_lattice": op10,
    "op11_distance_keys": op11,
    "op12_edit_embedding": op12,
    "op13_turn_lattice": op13,
}

ORACLES: dict[str, str] = {
    "op5_uniform_threshold": TOP_K,
    "op7_line_spread": LINE_DEDUP,
    "op11_distance_keys": HARD_NEGATIVES,
}
