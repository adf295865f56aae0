"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from .exact_dedup import OP8_SQL, op8_exact_dedup
from .jaccard import op1_jaccard
from .language import op4_language_id
from .line_dedup import OP2_SQL, op2_line_dedup
from .mixing import OP6_SQL, op6_mixing
from .negatives import OP13_SQL, op13_hard_negatives
from .quality import op9_quality
from .sentencepieces import op7_sentencepiece
from .substrings import op3_substring_dedup
from .token_alignment import op12_token_alignment
from .token_files import op11_token_files
from .toxicity import op10_toxicity
from .vectors import op5_near_vectors

QUERIES = {
    "op1_jaccard": op1_jaccard,
    "op2_line_dedup": op2_line_dedup,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_language_id": op4_language_id,
    "op5_near_vectors": op5_near_vectors,
    "op6_mixing": op6_mixing,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_quality": op9_quality,
    "op10_toxicity": op10_toxicity,
    "op11_token_files": op11_token_files,
    "op12_token_alignment": op12_token_alignment,
    "op13_hard_negatives": op13_hard_negatives,
}
SQL = {"op2_line_dedup": OP2_SQL, "op6_mixing": OP6_SQL, "op8_exact_dedup": OP8_SQL, "op13_hard_negatives": OP13_SQL}
