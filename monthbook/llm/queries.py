"""The registered queries of this package, and their SQL counterparts."""

from __future__ import annotations

from monthbook.llm.chat import CHAT_SQL, chat_query
from monthbook.llm.decontam import decontamination_query
from monthbook.llm.infill import INFILL_SQL, infill_query
from monthbook.llm.langid import language_query
from monthbook.llm.linededup import LINE_SQL, line_query
from monthbook.llm.mixing import mixing_query
from monthbook.llm.periods import runs_query
from monthbook.llm.pii import pii_query
from monthbook.llm.secrets import secrets_query
from monthbook.llm.simhash import simhash_query
from monthbook.llm.sketches import fingerprint_query
from monthbook.llm.suffixes import SUFFIX_SQL, suffix_query
from monthbook.llm.tokens import tokens_query

QUERIES = {
    "op1_simhash": simhash_query,
    "op2_suffix_dedup": suffix_query,
    "op3_fingerprints": fingerprint_query,
    "op4_decontamination": decontamination_query,
    "op5_token_ids": tokens_query,
    "op6_pii": pii_query,
    "op7_chat_format": chat_query,
    "op8_language_id": language_query,
    "op9_mixing": mixing_query,
    "op10_line_dedup": line_query,
    "op11_fill_in_middle": infill_query,
    "op12_periodic_runs": runs_query,
    "op13_secrets": secrets_query,
}

ORACLES = {
    "op2_suffix_dedup": SUFFIX_SQL,
    "op7_chat_format": CHAT_SQL,
    "op10_line_dedup": LINE_SQL,
    "op11_fill_in_middle": INFILL_SQL,
}
