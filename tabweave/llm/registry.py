"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from tabweave.llm.aliases import OP12_SQL, op12_aliases
from tabweave.llm.alignment import op11_alignment
from tabweave.llm.caps import OP7_SQL, op7_caps
from tabweave.llm.centroids import OP13_SQL, op13_yinyang
from tabweave.llm.chat import OP9_SQL, op9_rotation
from tabweave.llm.decontamination import OP10_SQL, op10_decontamination
from tabweave.llm.fm import op3_quality
from tabweave.llm.jaccard import OP6_SQL, op6_jaccard
from tabweave.llm.lm import op2_lm
from tabweave.llm.mixing import op4_mixing
from tabweave.llm.secrets import op1_secrets
from tabweave.llm.sharding import op5_sharding
from tabweave.llm.warc import OP8_SQL, op8_warc

QUERIES = {
    "op1_secrets": op1_secrets,
    "op2_lm": op2_lm,
    "op3_quality": op3_quality,
    "op4_mixing": op4_mixing,
    "op5_sharding": op5_sharding,
    "op6_jaccard": op6_jaccard,
    "op7_caps": op7_caps,
    "op8_warc": op8_warc,
    "op9_rotation": op9_rotation,
    "op10_decontamination": op10_decontamination,
    "op11_alignment": op11_alignment,
    "op12_aliases": op12_aliases,
    "op13_yinyang": op13_yinyang,
}

ORACLES: dict[str, str] = {
    "op6_jaccard": OP6_SQL,
    "op7_caps": OP7_SQL,
    "op8_warc": OP8_SQL,
    "op9_rotation": OP9_SQL,
    "op10_decontamination": OP10_SQL,
    "op12_aliases": OP12_SQL,
    "op13_yinyang": OP13_SQL,
}
