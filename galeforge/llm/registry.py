"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from .chat import OP4_SQL, op4_chat
from .covertree import OP3_SQL, op3_covertree
from .langid import op9_langid
from .mixing import OP7_SQL, op7_mixing
from .negatives import OP13_SQL, op13_hard_negatives
from .packing import op2_packing
from .phrases import OP12_SQL, op12_collocations
from .pii import op8_pii
from .posindex import OP11_SQL, op11_decontamination
from .quality import op1_quality
from .simhash import op5_simhash
from .tokenstore import op10_tokenids
from .toxicity import op6_toxicity

QUERIES = {f.__name__: f for f in (op1_quality, op2_packing, op3_covertree, op4_chat, op5_simhash, op6_toxicity, op7_mixing, op8_pii, op9_langid, op10_tokenids, op11_decontamination, op12_collocations, op13_hard_negatives)}
SQL = {"op3_covertree": OP3_SQL, "op4_chat": OP4_SQL, "op7_mixing": OP7_SQL, "op11_decontamination": OP11_SQL, "op12_collocations": OP12_SQL, "op13_hard_negatives": OP13_SQL}
