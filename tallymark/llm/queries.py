"""The subpackage's queries and their SQL, for __spark_entry__.py."""

from __future__ import annotations

from .archive import op7_warc
from .bitplanes import op8_bitplanes
from .bpe import op12_bpe
from .minhash import op1_minhash
from .mixing import op9_mixing
from .neighbours import op5_neighbours
from .oracle import ORACLE_SQL
from .packing import op10_packing
from .pii import op6_pii
from .ranked import op11_ranked
from .repetition import op3_repetition
from .substrings import op2_substrings
from .toxicity import op4_toxicity
from .tries import op13_trie

__all__ = ["ORACLE_SQL", "QUERIES"]

QUERIES = {
    "op1_minhash": op1_minhash,
    "op2_substrings": op2_substrings,
    "op3_repetition": op3_repetition,
    "op4_toxicity": op4_toxicity,
    "op5_neighbours": op5_neighbours,
    "op6_pii": op6_pii,
    "op7_warc": op7_warc,
    "op8_bitplanes": op8_bitplanes,
    "op9_mixing": op9_mixing,
    "op10_packing": op10_packing,
    "op11_ranked": op11_ranked,
    "op12_bpe": op12_bpe,
    "op13_trie": op13_trie,
}
