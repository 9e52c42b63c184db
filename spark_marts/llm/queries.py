"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from . import lines, phrases, runs, secret_scan, topk
from .decontam import op3_decontamination
from .langid import op8_langid
from .lines import op9_line_dedup
from .lm import op6_lm_score
from .neardup import op5_near_dup
from .packing import op10_packing
from .phrases import op12_phrases
from .pii import op1_pii
from .runs import op11_word_runs
from .secret_scan import op13_secret_scan
from .substrings import op2_substring_dedup
from .topk import op4_topk
from .toxicity import op7_toxicity

QUERIES = {f.__name__: f for f in (op1_pii, op2_substring_dedup, op3_decontamination, op4_topk, op5_near_dup, op6_lm_score, op7_toxicity, op8_langid, op9_line_dedup, op10_packing, op11_word_runs, op12_phrases, op13_secret_scan)}
ORACLE: dict[str, str] = {
    "op4_topk": topk.ORACLE_SQL,
    "op9_line_dedup": lines.ORACLE_SQL,
    "op11_word_runs": runs.ORACLE_SQL,
    "op12_phrases": phrases.ORACLE_SQL,
    "op13_secret_scan": secret_scan.ORACLE_SQL,
}
